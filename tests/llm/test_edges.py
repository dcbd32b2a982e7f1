"""Every operator over documents on awkward rows and on an empty table."""

import pytest

from anaquel.llm import bpe, decontam, lang_id, lm_score, minhash, quality, rindex, sharding, token_count
from tests.llm import corpus

OPERATORS = {
    "tokens": lambda docs, items: token_count.count_tokens(docs),
    "language": lambda docs, items: lang_id.identify(docs, lang_id.train(docs)),
    "language, nothing learned": lambda docs, items: lang_id.identify(docs, None),
    "lm": lambda docs, items: lm_score.score(docs, lm_score.train(docs.select("doc_id", "text"))),
    "decontamination": lambda docs, items: decontam.contamination(docs, items),
    "decontamination, no items": lambda docs, items: decontam.contamination(docs, items.limit(0)),
    "suffix": lambda docs, items: rindex.find_repeats(docs),
    "bpe": lambda docs, items: bpe.digests(docs),
    "sharding": lambda docs, items: sharding.assign_shards(docs),
    "minhash": lambda docs, items: minhash.near_duplicates(docs),
    "quality": lambda docs, items: quality.judge(docs),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_a_row_for_every_row(name, edges, empty, items):
    ids = sorted((r.doc_id for r in OPERATORS[name](edges, items).collect()), key=str)
    assert ids == sorted((r[0] for r in corpus.edge_rows()), key=str)
    assert OPERATORS[name](empty, items).collect() == []


def of(df, *columns):
    return {r.doc_id: tuple(r[c] for c in columns) for r in df.collect() if r.doc_id is not None}


def test_null_and_empty_texts(edges, items):
    none = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
    for doc in (3, 4):
        assert of(token_count.count_tokens(edges), "n_bytes", "n_tokens")[doc] == (0, 0)
        assert of(bpe.digests(edges), "n_tokens", "ids_sha256", "decoded_sha256")[doc] == (0, none, none)
        assert of(minhash.near_duplicates(edges), "n_shingles", "component_id", "kept")[doc] == (0, doc, True)
        assert of(sharding.assign_shards(edges), "size", "text_crc32")[doc] == (1, 0)
        assert of(quality.judge(edges), "n_words", "base_failed", "kept")[doc] == (0, True, False)
        assert of(decontam.contamination(edges, items), "n_words", "n_hit")[doc] == (0, 0)


def test_undetermined(edges):
    found = of(lang_id.identify(edges, lang_id.train(edges)), "lang_pred", "score")
    assert all(found[d] == ("und", 0.0) for d in (3, 4, 5, 9))
    assert found[10][0] in ("aa", "bb")


def test_copies_and_repeated_rows(edges):
    near = minhash.near_duplicates(edges).collect()
    assert {(r.component_id, r.kept) for r in near if r.doc_id == 1} == {(1, True)}
    assert [(r.component_id, r.kept) for r in near if r.doc_id == 2] == [(1, False)]
    assert {(r.component_id, r.kept) for r in near if r.doc_id is None} == {(None, True)}
    removed = {}
    for r in rindex.find_repeats(edges).collect():
        removed.setdefault(r.doc_id, set()).add((r.n_removed, r.n_bytes))
    size = len(corpus.edge_rows()[0][1].encode())
    # The row without id comes first; rows equal in id and text are one document, which has an earlier copy.
    assert removed[1] == {(size, size)} and removed[2] == {(size, size)}
    assert removed[None] == {(0, size), (0, 0)}
    assert removed[7] == {(50_000 - 1, 50_000)} or removed[7] == {(50_000, 50_000)}
