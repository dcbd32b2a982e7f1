"""Staged tables: the setting around their writes when several threads write."""

from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from anaquel.sources.staging import CLEANUP, stage


@pytest.mark.parametrize("before", [None, "false", "true"])
def test_setting_is_as_before_after_writes_side_by_side(spark, before):
    own = spark.newSession()
    spark.conf.unset(CLEANUP)
    if before is not None:
        own.conf.set(CLEANUP, before)
    kept = own.conf.get(CLEANUP, None)
    with ThreadPoolExecutor(4) as pool:
        counts = list(pool.map(lambda n: stage(own.range(n), "side").count(), range(1, 9)))
    assert counts == list(range(1, 9))
    assert own.conf.get(CLEANUP, None) == kept


def test_setting_is_as_before_after_a_failed_write(spark):
    own = spark.newSession()
    kept = own.conf.get(CLEANUP, None)
    with pytest.raises(PySparkException):
        stage(own.range(3).select(F.raise_error(F.lit("no")).cast("string").alias("x")), "failed")
    assert own.conf.get(CLEANUP, None) == kept
