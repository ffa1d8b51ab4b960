import datetime

import pytest
from pyspark.sql import functions as F

from visittrail import functions as V
from visittrail.fixed_values import STAGE_LETTERS
from visittrail.functions.sql import register_functions


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def day(text):
    return F.lit(text).cast("date")


@pytest.mark.parametrize("one, other, expected", [
    ("2024-01-01", "2024-01-07", 5),
    ("2024-01-12", "2024-01-01", 10),
    ("2024-01-06", "2024-01-06", 0),
    ("2024-01-05", "2024-01-08", 2),
])
def test_weekdays_of_known_spans(spark, one, other, expected):
    assert value(spark, V.weekdays_between(day(one), day(other))) == expected


def test_weekdays_match_a_count_day_by_day(spark):
    first = datetime.date(2023, 12, 25)
    days = spark.range(60).select(F.date_add(F.lit(first), F.col("id").cast("int")).alias("a"))
    later = spark.range(60).select(F.date_add(F.lit(first), F.col("id").cast("int")).alias("b"))
    counted = F.size(F.filter(
        F.sequence(F.least("a", "b"), F.greatest("a", "b")), lambda d: ~V.is_weekend(d)
    ))
    wrong = days.join(later, F.lit(True)).filter(
        V.weekdays_between(F.col("a"), F.col("b")) != counted
    )
    assert wrong.count() == 0


def test_weekdays_need_both_dates(spark):
    assert value(spark, V.weekdays_between(day(None), day("2024-01-01"))) is None


@pytest.mark.parametrize("text, expected", [
    ("a\tb", "ab"), ("a   b", "a  b"), ("a    b", "a  b"), ("  a\r\n", "a"), ("", ""),
    (None, None), ("a\t \tb", "a b"),
])
def test_clean_text(spark, text, expected):
    assert value(spark, V.clean_text(F.lit(text).cast("string"))) == expected


@pytest.mark.parametrize("start, end, count_start, expected", [
    ("2024-06-01", "2024-06-09", False, 8),
    ("2024-06-01", "2024-06-09", True, 9),
    ("2024-06-01", "2024-06-01", True, 1),
    ("2024-06-02", "2024-06-01", False, 1),
    (None, "2024-06-01", True, None),
    ("2024-06-01", None, False, None),
])
def test_elapsed_days(spark, start, end, count_start, expected):
    assert value(spark, V.elapsed_days(day(start), day(end), count_start)) == expected


def test_visit_of_one_saturday_lasts_a_day(spark):
    assert value(spark, V.visit_length(day("2024-01-06"), day("2024-01-06"))) == 1


def test_period_is_not_padded(spark):
    assert value(spark, V.period_label(day("2020-03-09"))) == "2020.3"


def test_week_starts_on_sunday(spark):
    assert value(spark, V.week_start(day("2024-01-06"))) == datetime.date(2023, 12, 31)


@pytest.mark.parametrize("code, expected", [(1, "S"), (3, "A"), (7, "7"), (None, None)])
def test_decode_keeps_unknown_codes(spark, code, expected):
    assert value(spark, V.decode(F.lit(code).cast("int"), STAGE_LETTERS)) == expected


@pytest.mark.parametrize("stages, wrong", [
    ("S,R,S,A", False), ("S", False), ("R,S,A", True), ("S,S", True), ("S,R,A", True),
    ("S,A,A", True), ("S,A,S", True), (None, None),
])
def test_stage_order(spark, stages, wrong):
    assert value(spark, V.is_bad_stage_order(F.lit(stages).cast("string"))) is wrong


def test_protocol_alias(spark):
    assert value(spark, V.protocol_alias(F.lit("ALTTO"))) == "Novartis (ALTTO) - 380-27"
    assert value(spark, V.protocol_alias(F.lit("other"))) is None


def test_joined_names_skip_nulls_and_repeats(spark):
    names = F.array(F.lit("b"), F.lit(None), F.lit("a"), F.lit("b"))
    assert value(spark, V.joined_names(names)) == "a,b"
    assert value(spark, V.joined_names(F.array(F.lit(None).cast("string")))) is None


def test_functions_in_sql_text(spark):
    register_functions(spark)
    rows = [("a\t b   c\n", "x", datetime.date(2024, 6, d), datetime.date(2024, 6, e)) for d in range(1, 16) for e in (3, 9, 15)]
    rows += [(None, "x", None, datetime.date(2024, 6, 3)), ("a", None, datetime.date(2024, 6, 3), None), ("", "", None, None)]
    table = spark.createDataFrame(rows, "x string, y string, a date, b date")
    found = spark.sql("""
        SELECT clean_text(x), monitor_name(x, y), is_weekend(a), week_start(a),
            weekdays_between(a, b), elapsed_days(a, b, 1), elapsed_days(a, b, 0),
            visit_length(a, b), period_label(a) FROM {t}""", t=table)
    x, y, a, b = (F.col(c) for c in "xyab")
    expected = table.select(
        V.clean_text(x), V.monitor_name(x, y), V.is_weekend(a), V.week_start(a),
        V.weekdays_between(a, b), V.elapsed_days(a, b, True), V.elapsed_days(a, b, False),
        V.visit_length(a, b), V.period_label(a))
    assert list(map(tuple, found.collect())) == list(map(tuple, expected.collect()))
    assert [t for _, t in found.dtypes] == [t for _, t in expected.dtypes]
    assert "Python" not in found._jdf.queryExecution().toString()
