"""The library's own session: what a task reads stays, the number of tasks follows the input."""

from anaquel.catalog.queries import REGISTRY, registered
from anaquel.session import INPUT_SHARE, SPLIT_BYTES, STARTING_PARTITIONS, tune
from anaquel.sources.star import star_bytes

FOLDER = "/root/testdata/sf0.001"


def _bytes(spark, key):
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key))


def test_partitions_follow_the_input_and_shares_do_not(spark):
    small, large = tune(spark, 100 * INPUT_SHARE), tune(spark, 600 * INPUT_SHARE)
    assert [int(s.conf.get(STARTING_PARTITIONS)) for s in (small, large)] == [100, 600]
    for key, most in SPLIT_BYTES.items():
        assert _bytes(small, key) == _bytes(large, key) <= most
    assert large.range(1).repartition("id").select("id").count() == 1


def test_the_callers_smaller_shares_and_more_partitions_stay(spark):
    caller = spark.newSession()
    caller.conf.set("spark.sql.shuffle.partitions", "77")
    for key in SPLIT_BYTES:
        caller.conf.set(key, "16k")
    own = tune(caller, INPUT_SHARE)
    assert own.conf.get(STARTING_PARTITIONS) == "77"
    assert [_bytes(own, key) for key in SPLIT_BYTES] == [16 << 10] * len(SPLIT_BYTES)
    assert caller.conf.get(STARTING_PARTITIONS, None) is None


def test_registered_queries_size_their_session_by_the_folder(spark, monkeypatch):
    seen = []
    monkeypatch.setitem(REGISTRY, "doc_counts", lambda own, folder: seen.append(own.conf.get(STARTING_PARTITIONS)))
    monkeypatch.setattr("anaquel.session.INPUT_SHARE", 1000)
    registered()["doc_counts"](spark, FOLDER)
    assert int(seen[0]) == -(-star_bytes(spark, FOLDER) // 1000) > 100
