"""The stages in turn over a small folder."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from anaquel.llm import catalog
from anaquel.sources.staging import stage
from tests.llm import corpus
from tests.llm.test_decontam import expected as contaminated
from tests.llm.test_minhash import expected as components


@pytest.fixture(scope="module")
def folder(docs, items, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    docs.write.parquet(f"{path}/documents.parquet")
    items.write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages_work_on_what_is_kept(spark, folder, docs):
    frame = spark.read.parquet(f"{folder}/documents.parquet")
    seen = {}
    for name, function in corpus_pipeline.STAGES:
        frame = stage(function(spark, frame, folder), name)
        seen[name] = {r.doc_id: r for r in frame.collect()}
        if name != "byte_bpe":
            assert frame.columns == docs.columns
    rows = [r[:2] for r in corpus.documents()[0]]
    assert set(seen["language_id"]) == {d for d, _ in rows}
    assert set(seen["near_dedup"]) == {d for d, c in components(rows)[1].items() if d == c}
    left = [(d, r.text) for d, r in seen["suffix_dedup"].items()]
    assert {d for d, _ in left} == set(seen["near_dedup"])
    assert sum(len(t) for _, t in left) < sum(len(r.text) for r in seen["near_dedup"].values())
    clean = {d for d, v in contaminated(left, corpus.documents()[1], 10).items() if v[1] == 0}
    assert set(seen["decontamination"]) == clean == set(seen["byte_bpe"])
    run = {r.doc_id: r.ids_sha256 for r in corpus_pipeline.run(spark, folder).collect()}
    assert run == {d: r.ids_sha256 for d, r in seen["byte_bpe"].items()}


def test_awkward_rows_and_empty_tables(spark, folder, edges, empty):
    for frame in (edges, empty):
        for name, function in corpus_pipeline.STAGES:
            frame = stage(function(spark, frame, folder), name)
            if name != "byte_bpe":
                assert frame.columns == edges.columns
    languages = corpus_pipeline.language(spark, edges, folder)
    assert languages.filter(F.col("text").isNull()).count() == 0


def test_registered():
    names = list(catalog.queries())
    assert [n.split("_")[0] for n in names] == [f"op{i}" for i in range(1, 14)] + ["pipeline"]
    assert catalog.oracle_sql().keys() <= set(names)
    assert len(corpus_pipeline.STAGES) == 5
