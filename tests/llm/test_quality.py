"""Base statistics against plain Python; outliers planted in ordinary documents."""

import random
import re
from collections import Counter

import numpy as np

from anaquel.llm import quality
from tests.llm import corpus

COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def statistics(text):
    text = text or ""
    words = corpus.spaced_words(text)
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often, repeated = Counter(windows), set()
    for i, window in enumerate(windows):
        if often[window] > 1:
            repeated.update(range(i, i + 8))
    return len(words), sum(map(len, words)), sum(map(text.count, "#*$%&|<>")), len(lines) - len(set(lines)), len(repeated)


def test_base_statistics(spark):
    rng = random.Random(8)
    phrase = corpus.sentence(rng, "aa", 9)
    texts = [r[1] for r in corpus.documents()[0]] + [r[1] for r in corpus.edge_rows()]
    texts += [f"{phrase} x {phrase}\n{phrase}\n \n{phrase}\r\n🙂 <b>&|", "a " * 50, "a b c d e f g h", "a b c d e f g h " * 2, "\n\n"]
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in quality.base_statistics(df).collect()}
    assert got == {i: statistics(t) for i, t in rows}


def test_outliers_go_and_ordinary_documents_stay(spark):
    rng = random.Random(9)
    rows = []
    for lang in corpus.LANGUAGES:
        for i in range(120):
            body = corpus.text(rng, lang, rng.randint(25, 400))
            if i % 12 == 0:  # every word decorated
                body = " ".join(w + "$$$" for w in body.split())
            rows.append((len(rows), body, lang, "s" if i % 40 != 5 else None, len(body)))
    rows.append((9999, corpus.text(rng, "aa", 60), "cc", "rare", 0))
    judged = {r.doc_id: r for r in quality.judge(spark.createDataFrame(rows, corpus.SCHEMA).repartition(3)).collect()}
    assert all(judged[d].kept == ("$$$" not in text) for d, text, *_ in rows)
    # A language with one document is judged by the whole corpus.
    assert judged[9999].kept and 0 < judged[9999].distance <= quality.CUTOFF < judged[0].distance


def test_moderate_outliers_go(spark):
    """A fifth of symbols, a quarter of repeated words, or many repeated lines, beside clean documents."""
    rng = random.Random(10)
    clean = [corpus.text(rng, "aa", rng.randint(100, 300)) for _ in range(150)]
    odd = []
    for _ in range(3):
        words = corpus.text(rng, "aa", 200).split()
        odd.append(" ".join(w + "#" * round(len(w) / 5) for w in words))
        odd.append(" ".join(words + words[:25] + ["x"] + words[:25]))
        odd.append("\n".join(w for i in range(0, 150, 3) for w in (" ".join(words[i : i + 3]), "so it is" if i % 2 else " ".join(words[i : i + 3]) + "!")))
    rows = [(i, t, "aa", "s", len(t)) for i, t in enumerate(clean + odd)]
    judged = {r.doc_id: r for r in quality.judge(spark.createDataFrame(rows, corpus.SCHEMA).repartition(3)).collect()}
    assert not any(judged[i].base_failed for i in judged)
    assert not any(judged[i].kept for i in range(150, len(rows)))
    assert sum(judged[i].kept for i in range(150)) >= 148


def test_small_groups_are_judged(spark):
    """By all documents of their language, or of the corpus; a lone corpus of a few documents is kept."""
    rng = random.Random(11)
    rows = [(i, corpus.text(rng, "aa", rng.randint(100, 300)), "aa", "large", 0) for i in range(150)]
    rows += [(1000 + i, corpus.text(rng, "aa", rng.randint(100, 300)), "aa", "small", 0) for i in range(10)]
    rows += [(2000, corpus.text(rng, "aa", 200), "cc", None, 0)]
    decorated = " ".join(w + "$$$" for w in corpus.text(rng, "aa", 200).split())
    rows += [(3000, decorated, "aa", "small", 0), (3001, decorated, "cc", None, 0), (3002, decorated, None, "rare", 0)]
    judged = {r.doc_id: r for r in quality.judge(spark.createDataFrame(rows, corpus.SCHEMA).repartition(3)).collect()}
    assert all(r.distance is not None for r in judged.values())
    assert not any(judged[d].kept for d in (3000, 3001, 3002))
    assert judged[2000].kept and sum(judged[1000 + i].kept for i in range(10)) >= 9
    few = quality.judge(spark.createDataFrame(rows[:4], corpus.SCHEMA)).collect()
    assert all(r.kept and r.distance is not None for r in few)


def minimum_by_numpy(x):
    """Mean, covariance and log determinant of the nearest share with the smallest determinant, then the reweighted estimate."""
    floors = np.array(list(quality.FEATURES.values()))
    low = lambda values, share: np.sort(values, axis=0)[int(np.ceil(share * len(values))) - 1]
    middle = low(x, 0.5)
    scale = np.maximum(1.4826 * low(np.abs(x - middle), 0.5), floors)
    z = (x - middle) / scale
    length = (z * z).sum(1, keepdims=True)
    signs = np.divide(z, np.sqrt(length), out=np.zeros_like(z), where=length > 0)
    pulled = np.tanh(z).T @ np.tanh(z)
    spread = np.sqrt(np.diag(pulled))
    both = np.outer(spread, spread)
    correlation = np.divide(pulled, both, out=np.zeros_like(pulled), where=both > 0)
    np.fill_diagonal(correlation, 1.0)

    def factor(covariance):
        lower = np.zeros_like(covariance)
        for i in range(len(floors)):
            for j in range(i + 1):
                rest = covariance[i, j] - lower[i, :j] @ lower[j, :j]
                lower[i, j] = np.sqrt(max(rest, floors[i] ** 2)) if i == j else rest / lower[j, j]
        return lower

    def distances(mean, lower):
        y = np.linalg.solve(lower, (x - mean).T)
        return (y * y).sum(0)

    def moments(inner, consistency):
        lower = factor(np.cov(inner.T, bias=True) * consistency)
        return inner.mean(0), lower, 2 * np.log(np.diag(lower)).sum()

    def step(estimate):
        d = distances(*estimate[:2])
        return moments(x[d <= low(d, quality.SUPPORT)], quality.CONSISTENCY)

    ends = []
    for shape in (np.eye(len(floors)), len(floors) * signs.T @ signs / len(x), correlation):
        estimate = (middle, factor(shape * np.outer(scale, scale)), None)
        for _ in range(quality.STEPS):
            estimate = step(estimate)
        ends.append(estimate)
    seen = [min(ends, key=lambda e: e[2])]
    while True:
        seen.append(step(seen[-1]))
        if not seen[-1][2] < seen[-2][2] - quality.SETTLED:
            break
    best = min(seen, key=lambda e: e[2])
    near = moments(x[distances(*best[:2]) <= quality.NEAR], quality.NEAR_CONSISTENCY)
    return best, distances(*near[:2]), [e[2] for e in ends]


def test_determinants_and_distances_match_numpy(spark):
    """With correlated statistics and a third of far rows on one side, in two groups."""
    rng = np.random.default_rng(5)
    groups = {}
    for key, far in (("a", 0), ("b", 45)):
        mixed = rng.normal(size=(160, 5)) @ rng.normal(size=(5, 5))
        mixed[:far] = mixed[:far] * 0.2 + 9
        groups[key] = mixed
    rows = [(k, i, *map(float, v)) for k, x in groups.items() for i, v in enumerate(x)]
    names = list(quality.FEATURES)
    df = spark.createDataFrame(rows, "key string, i int, " + ", ".join(f"{n} double" for n in names)).coalesce(1)
    best = quality.minimum_determinant(df)
    found = {r.key: r for r in best.collect()}
    judged = quality._distance(df, quality.reweighted(df, best)).collect()
    for key, x in groups.items():
        (mean, lower, logdet), d, ends = minimum_by_numpy(x)
        assert np.isclose(found[key].logdet, logdet, rtol=1e-9) and logdet <= min(ends) + 1e-9
        assert np.allclose([found[key][f"m_{i}"] for i in range(5)], mean)
        assert np.allclose([r.d for r in sorted(judged, key=lambda r: r.i) if r.key == key], d, rtol=1e-6)
    # The far rows are told from the others.
    far = {r.i for r in judged if r.key == "b" and r.d > quality.CUTOFF}
    assert far >= set(range(45)) and len(far) <= 50


def test_the_smallest_determinant_wins(spark):
    """Where the starts end at different determinants, the least of them is the one that goes on."""
    row = lambda key, start, logdet: (key, start, logdet)
    df = spark.createDataFrame([row("a", 0, 1.0), row("a", 1, -2.0), row("a", 2, 0.0), row("b", 1, 5.0), row("b", 2, 5.0)], "key string, start int, logdet double")
    assert {r.key: (r.start, r.logdet) for r in quality._smallest(df).collect()} == {"a": (1, -2.0), "b": (1, 5.0)}
