"""The recurrent network: gradients by differences, held-out accuracy, defined answers."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from anaquel.llm import lang_id
from anaquel.llm.common import crc_fold
from tests.llm import corpus


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(0)
    network = lang_id.Network(["a", "b", "c"])
    for part in (network.ahead, network.back):  # double precision for the differences
        part.inputs = [w.astype(np.float64) for w in part.inputs]
        part.recurrent = [w.astype(np.float64) for w in part.recurrent]
    steps = rng.integers(97, 103, (6, 5)).astype(np.uint8)
    direction, out = network.ahead, rng.standard_normal((lang_id.HIDDEN, 3)).astype(np.float64)
    target = rng.standard_normal((6, 5, 3))

    def loss():
        scores = np.zeros((6, 5, 3))
        direction.add_scores(steps, out, scores, [])
        return float((scores * target).sum())

    kept: list = []
    direction.add_scores(steps, out, np.zeros((6, 5, 3)), kept)
    gradients = direction.backward(steps, kept, target @ out.T)
    for weight, gradient in zip(direction.weights(), gradients):
        for at in [tuple(rng.integers(0, s) for s in weight.shape) for _ in range(12)]:
            if weight.ndim == 2 and weight.shape[0] == 256:
                at = (int(steps.ravel()[rng.integers(30)]), at[1])
            before, step = weight[at], 1e-3
            weight[at] = before + step
            up = loss()
            weight[at] = before - step
            down = loss()
            weight[at] = before
            assert abs((up - down) / (2 * step) - gradient[at]) < 0.02 * (1 + abs(gradient[at]))


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(12)
    rows = [(i, corpus.text(rng, lang, rng.randint(3, 80)), lang, "s", 0) for i, lang in enumerate(["aa", "bb"] * 150)]
    return spark.createDataFrame(rows, corpus.SCHEMA).repartition(3).cache()


def test_held_out_accuracy(labelled):
    network = lang_id.train(labelled)
    found = lang_id.identify(labelled, network).join(labelled.select("doc_id", "lang"), "doc_id")
    held_out = found.filter(crc_fold("doc_id", lang_id.FOLDS) == lang_id.HELD_OUT)
    right = held_out.filter("lang_pred = lang").count() / held_out.count()
    assert right > 0.95 and found.filter("score < 0 or score > 1").isEmpty()


def test_only_the_training_fold_is_learned_from(labelled):
    inside = crc_fold("doc_id", lang_id.FOLDS) != lang_id.HELD_OUT
    strange = labelled.withColumn("lang", F.when(inside, F.col("lang")).otherwise("other"))
    assert lang_id.train(strange).languages == ["aa", "bb"]
    assert lang_id.train(labelled.filter(~inside)) is None


def test_every_byte_gets_probabilities_and_texts_their_mean():
    network = lang_id.Network(["a", "b"])
    text = "hello wörld " * 20
    raw = np.frombuffer(text.encode(), np.uint8)
    pieces = [raw[i : i + lang_id.STEPS] for i in range(0, len(raw), lang_id.STEPS)]
    total = np.zeros(2)
    for piece in pieces:
        steps = np.zeros((lang_id.STEPS, 1), np.uint8)
        steps[: len(piece), 0] = piece
        labels = network.label(steps)
        assert np.allclose(labels.sum(axis=-1), 1, atol=1e-5)
        total += labels[: len(piece), 0].sum(axis=0)
    names, score = lang_id._predict(network, pa.array([text, None, "12 ?"]))
    assert abs(score[0] - (total / len(raw)).max()) < 1e-5 and names[1:] == ["und", "und"] and score[1:].tolist() == [0, 0]


def test_filter_keeps_columns(edges):
    kept = lang_id.keep_identified(edges, lang_id.train(edges), 0.0)
    assert kept.columns == edges.columns
    assert {r.doc_id for r in kept.collect()} == {None, 1, 2, 6, 7, 8, 10}
