import hashlib
import random

import pytest
from pyspark.sql import functions as F

from anaquel.llm.chat import chat_windows, digests, escape, read_back, unescape

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def hostile(rng):
    parts = ["<|", "|>", "<|end|>", "<|turn|>", "<|text|>", "</s>", "[INST]", "[/INST]", "\\", "<\\|", "<<SYS>>", "<", "[", "a b", "\n", "é🙂", "$1", ""]
    return "".join(rng.choices(parts, k=rng.randint(0, 8)))


def conversations(seed=1):
    rng = random.Random(seed)
    rows = []
    for conv in range(40):
        turns = 200 if conv == 7 else rng.randint(1, 9)
        for turn in range(turns):
            role = "system" if turn == 0 and conv % 3 == 0 else rng.choice(["user", "assistant", "tool", hostile(rng)])
            words = 300 if rng.random() < 0.05 else rng.randint(0, 30)
            rows.append((conv, turn, role, " ".join("w" + str(rng.randrange(50)) for _ in range(words)) + hostile(rng)))
    rows += [(None, 0, "user", "x"), (None, 1, "assistant", None), (90, None, None, "y"), (91, 0, "user", "same"), (91, 0, "user", "same"), (92, 0, "system", "only")]
    return rows


def test_escaping_is_reversible(spark):
    rng = random.Random(2)
    texts = [hostile(rng) for _ in range(500)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", escape(F.col("t")).alias("e")).select("t", "e", unescape(F.col("e")).alias("u")).collect()
    assert all(r.t == r.u and "<|" not in r.e and "</s>" not in r.e and "[INST]" not in r.e for r in rows)


@pytest.mark.parametrize("budget,history", [(1024, 256), (60, 15), (40, 0)])
def test_reads_back_to_the_conversations(spark, budget, history):
    rows = conversations()
    df = spark.createDataFrame(rows, SCHEMA).withColumn("tokens", F.lit("own")).repartition(4)
    windows = chat_windows(df, budget, history).cache()
    want = {}
    for conv in {r[0] for r in rows}:
        turns = sorted(((-1 if t is None else t, role or "", text or "") for c, t, role, text in rows if c == conv))
        loss = "".join(x for _, role, x in turns if role == "assistant")
        block = "".join(f"{role}\n{x}\n" for _, role, x in turns)
        want[conv] = (len(turns), hashlib.sha256(block.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in digests(windows).collect()}
    assert got == want
    for r in windows.collect():
        assert r.tokens <= budget or r.turns - r.repeated == 1 or r.repeated <= 1
        assert r.formatted.count("<|turn|>") == r.turns == r.formatted.count("<|end|>")


def test_windows_repeat_system_and_history_without_loss(spark):
    rows = [(1, 0, "system", "be kind")] + [(1, i, "assistant" if i % 2 == 0 else "user", f"t{i} a b c d e f g") for i in range(1, 40)]
    windows = chat_windows(spark.createDataFrame(rows, SCHEMA), 120, 30).orderBy("first_token").collect()
    assert len(windows) > 3 and all(w.formatted.startswith("<|turn|>system<|text|>be kind<|end|>") for w in windows)
    assert windows[0].repeated == 0 and all(w.repeated >= 2 for w in windows[1:])
    losses = [w.formatted[s.start : s.start + s.length] for w in windows for s in w.loss_spans]
    assert losses == [r[3] for r in rows if r[2] == "assistant"]


def test_empty(spark):
    windows = chat_windows(spark.createDataFrame([], SCHEMA))
    assert windows.collect() == [] and read_back(windows).collect() == [] and digests(windows).collect() == []
