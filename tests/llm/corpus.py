"""Small tables for the tests: invented words in two languages, with planted copies and passages."""

from __future__ import annotations

import random
import re

LANGUAGES = {"aa": ["ba", "ko", "lim", "ter", "sha", "no", "wid", "re"], "bb": ["ße", "ún", "gré", "yo", "zzi", "qua", "ñu", "xi"]}
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# Names that the operators use themselves.
CLASHING = ["key", "row", "kept", "spans", "left", "start", "stop", "n", "id", "band", "label", "d", "place", "task", "slot", "size", "score", "words"]


def sentence(rng: random.Random, lang: str, words: int) -> str:
    return " ".join("".join(rng.choices(LANGUAGES[lang], k=rng.randint(1, 3))) for _ in range(words))


def text(rng: random.Random, lang: str, words: int) -> str:
    lines = []
    while words > 0:
        lines.append(sentence(rng, lang, min(words, 12)) + ".")
        words -= 12
    return "\n".join(lines)


def benchmark(rng: random.Random) -> list[tuple]:
    rows = [(i, sentence(rng, "aa", 25)) for i in range(8)]
    return [*rows, (8, "Alone word"), (9, None), (10, ""), (None, sentence(rng, "bb", 15)), (0, rows[1][1])]


def documents(seed: int = 1) -> tuple[list[tuple], list[tuple]]:
    """Rows of documents and of a benchmark some of them hold passages of."""
    rng = random.Random(seed)
    items = benchmark(rng)
    passage = text(rng, "aa", 60)
    texts = [(text(rng, lang, rng.randint(30, 160)), lang) for lang in ("aa", "bb") for _ in range(20)]
    rows = []
    for i, (body, lang) in enumerate(texts):
        if i % 5 == 0:
            body = body + "\n" + passage + "\n" + text(rng, lang, 10)
        if i % 7 == 0:
            words = items[i % 8][1].split()
            body = body + " " + " ".join(words[3:18]).upper() + " tail"
        rows.append((3 * i, body, lang))
    for i in range(12):  # copies, some with a few words changed
        source = rows[i][1].split(" ")
        for _ in range(i % 4):
            source[rng.randrange(len(source))] = "zz" + str(rng.randrange(99))
        rows.append((1000 - 7 * i, " ".join(source), rows[i][2]))
    out = [(d, t, lang, f"s{d % 2}", len(t)) for d, t, lang in rows]
    return out, items


def edge_rows() -> list[tuple]:
    """Nulls in every column, empty, blank and very long texts, ties and repeated rows."""
    rng = random.Random(9)
    common = text(rng, "aa", 40)
    long = text(rng, "aa", 30_000)
    return [
        (1, common, "aa", "s0", len(common)),
        (1, common, "aa", "s0", len(common)),
        (2, common, None, None, None),
        (None, common, "aa", "s0", 5),
        (None, None, None, None, None),
        (3, None, "aa", "s1", 0),
        (4, "", "aa", "s1", 0),
        (5, " \n\t ", "bb", "s1", 4),
        (6, long, "aa", "s0", len(long)),
        (7, "a" * 50_000, "aa", "s0", 50_000),
        (8, "漢字かな 🙂 ½ ́ x\u0000y", "bb", "s0", 10),
        (9, "12 34 !!", "bb", "s0", 8),
        (10, "word", "bb", "s1", 4),
        (10, "other word", "bb", "s1", 10),
    ]


def with_extras(df):
    """The same rows with columns named like the operators' own."""
    from pyspark.sql import functions as F

    return df.withColumns({name: F.lit(f"own {name}") for name in CLASHING})


def lowered(value: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), value or "")


def spaced_words(value: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", value or "")
