"""The rule predicates against the Python functions whose results they have to match."""

import datetime
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from anaquel.functions import predicates
from anaquel.plans.rules import MAIL


def errors(spark, values, predicate):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i INT, v STRING")
    return [r.e for r in df.select("i", predicate(F.col("v")).alias("e")).orderBy("i").collect()]


def python_date_error(value):
    try:
        datetime.datetime.strptime(str(value), "%Y-%m-%d")
        return False
    except ValueError:
        return True


def python_range_error(value, low, high):
    try:
        return not low <= int(value) <= high
    except (TypeError, ValueError):
        return True


MAILS = [
    "a@b.c", "a@b.c\n", "a@b.c\r\n", "a@b.c\u0085", "a@b x.c", "a@b", "", None, "x a@b.c", "a@@b.c", "a@b.c.d",
    "ñ@b.c", "a@b.c d", "\ta@b.c",
]


def test_pattern_matches_python_search(spark):
    want = [v is None or not re.search(MAIL, v) for v in MAILS]
    assert errors(spark, MAILS, lambda c: predicates.pattern_error(c, MAIL)) == want


NUMBERS = ["5", " 5 ", "+5", "1", "0", "6", "3.0", "abc", "", None, "5L", "99999999999", "-1", "99999999999999999999999"]


def test_range_matches_python_int(spark):
    want = [python_range_error(v, 1, 5) for v in NUMBERS]
    assert errors(spark, NUMBERS, lambda c: predicates.range_error(c, 1, 5)) == want


DATES = [
    "2024-01-05", "2024-1-5", "2024-02-30", "2024-001-05", "12024-01-01", "24-01-01", "None", None, "2024-01-05 ",
    "2024-01-05T00", "2024/01/05", "+2024-01-05", "0000-01-01", "2024-01-05\n", "2023-02-29", "2024-02-29", "",
    "2024-13-01", "2024-00-10", "2024-1-00", "0001-01-01", "9999-12-31", "2024-01- 5", "2024-1- 9", "2024- 1-05", "2024-01- 0",
    "2024-02- 30", "2024-01-  5", " 2024-01-05",
]


def test_date_matches_python_strptime(spark):
    assert errors(spark, DATES, predicates.date_error) == [python_date_error(v) for v in DATES]


def test_date_column_fails_only_on_null(spark):
    df = spark.createDataFrame([(datetime.date(2024, 1, 5),), (None,)], "v DATE")
    assert [r.e for r in df.select(predicates.date_error(F.col("v")).alias("e")).collect()] == [False, True]


@pytest.mark.parametrize("separator", [",", "/", ".", "|", "$"])
def test_separator_is_literal(spark, separator):
    values = ["a,b", "a / b", "ab", "", None, "a.b", "a|b", "$"]
    want = [bool(v) and separator in v for v in values]
    assert errors(spark, values, lambda c: predicates.separator_error(c, separator)) == want


# One Spark job per example is slow, so each example is a whole list of texts.
texts = st.lists(st.text(alphabet="0123456789-@./ab \n\t", max_size=12), min_size=20, max_size=60)


@settings(max_examples=6, deadline=None)
@given(texts)
def test_predicates_on_random_text(spark, values):
    assert errors(spark, values, lambda c: predicates.pattern_error(c, MAIL)) == [not re.search(MAIL, v) for v in values]
    assert errors(spark, values, predicates.date_error) == [python_date_error(v) for v in values]
    assert errors(spark, values, lambda c: predicates.separator_error(c, "/")) == ["/" in v for v in values]
    assert errors(spark, values, lambda c: predicates.range_error(c, 1, 5)) == [
        python_range_error(v, 1, 5) for v in values
    ]
