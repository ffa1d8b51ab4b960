"""The functions of the reports for use in SQL text.

They are SQL functions: Spark puts their bodies in place of each call, so nothing runs in Python.
"""

from pyspark.sql import SparkSession

#: Signature, result type and body of each function; later ones use earlier ones.
SQL_FUNCTIONS = [
    ("clean_text(x STRING)", "STRING",
     r"trim(replace(translate(x, '\t\n\r', ''), '  ', ' '))"),
    ("monitor_name(first STRING, last STRING)", "STRING",
     "concat(clean_text(first), ' ', clean_text(last))"),
    ("is_weekend(day DATE)", "BOOLEAN", "dayofweek(day) IN (1, 7)"),
    ("week_start(day DATE)", "DATE", "date_add(day, 1 - dayofweek(day))"),
    ("weekdays_between(one DATE, other DATE)", "INT",
     "abs(datediff(other, one)) + 1"
     " - CAST(abs(datediff(week_start(other), week_start(one))) / 7 * 2 AS INT)"
     " - CAST(dayofweek(least(one, other)) = 1 AS INT)"
     " - CAST(dayofweek(greatest(one, other)) = 7 AS INT)"),
    ("elapsed_days(start DATE, finish DATE, more INT)", "INT",
     "CASE WHEN finish <= start THEN 1 WHEN finish > start"
     " THEN datediff(finish, start) + more END"),
    ("visit_length(start DATE, finish DATE)", "INT",
     "CASE WHEN finish <= start THEN 1 WHEN finish > start"
     " THEN weekdays_between(start, finish) END"),
    ("period_label(day DATE)", "STRING",
     "concat(CAST(year(day) AS STRING), '.', CAST(month(day) AS STRING))"),
]


def register_functions(spark: SparkSession) -> None:
    """Makes clean_text(x), weekdays_between(a, b) and the others known to the session's SQL."""
    for signature, result, body in SQL_FUNCTIONS:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURNS {result} RETURN {body}")
