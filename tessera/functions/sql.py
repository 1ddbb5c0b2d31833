"""The library's expressions as SQL functions, so that whole queries can be SQL text.

``register_sql`` creates temporary SQL functions. They are SQL themselves: Spark
puts their bodies into the plan, where they are optimized and compiled like any
expression; no Python runs.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from tessera.functions import recode as rc


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


_FUNCTIONS = {
    "working_band": (
        "telfs DOUBLE", "STRING",
        f"CASE WHEN telfs >= {rc.WORKING_RANGE[0]}D AND telfs < {rc.WORKING_RANGE[1]}D THEN {_text(rc.WORKING)} ELSE {_text(rc.NOT_WORKING)} END"),
    "sex_band": (
        "tesex DOUBLE", "STRING", f"CASE WHEN tesex = {rc.MALE_CODE}D THEN {_text(rc.MALE)} ELSE {_text(rc.FEMALE)} END"),
    "age_band": (
        "teage DOUBLE", "STRING",
        f"CASE WHEN teage BETWEEN {rc.YOUNG_RANGE[0]}D AND {rc.YOUNG_RANGE[1]}D THEN {_text(rc.YOUNG)} "
        f"WHEN teage > {rc.ELDER_ABOVE}D AND NOT isnan(teage) THEN {_text(rc.ELDER)} ELSE {_text(rc.ACTIVE)} END"),
    "minutes_to_hours": ("minutes DOUBLE", "DOUBLE", "minutes / 60.0D"),
    "has_token": ("body STRING, term STRING", "BOOLEAN", "contains(body, term) AND array_contains(split(body, ' '), term)"),
    "matching_terms": ("body STRING, terms ARRAY<STRING>", "ARRAY<STRING>", "array_intersect(split(body, ' '), terms)"),
    "squared_distance": (
        "x1 DOUBLE, y1 DOUBLE, x2 DOUBLE, y2 DOUBLE", "DOUBLE", "(x1 - x2) * (x1 - x2) + (y1 - y2) * (y1 - y2)"),
}

# Table functions: (parameters, columns, query).
_TABLES = {
    "terms_of": ("body STRING, terms ARRAY<STRING>", "term STRING", "SELECT explode(array_intersect(split(body, ' '), terms)) AS term"),
}


def register_sql(spark: SparkSession, prefix: str = "ts_") -> list[str]:
    """Creates the functions in the session, names behind ``prefix``; returns the names.

    Scalar: working_band, sex_band, age_band (as the recodes of ``functions``),
    minutes_to_hours, has_token, matching_terms, squared_distance. Table, for
    ``LATERAL``: terms_of(text, terms), one row a matching term.
    """
    if not prefix.replace("_", "a").isalnum():
        raise ValueError("prefix must be made of letters, digits and underscores")
    for name, (parameters, returns, body) in _FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{name}({parameters}) RETURNS {returns} RETURN {body}")
    for name, (parameters, columns, query) in _TABLES.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{name}({parameters}) RETURNS TABLE({columns}) RETURN {query}")
    return [prefix + n for n in (*_FUNCTIONS, *_TABLES)]


def class_sum_sql(columns: list[str]) -> str:
    """SQL text of the left-to-right double sum of columns."""
    if not columns:
        raise ValueError("no columns to sum")
    return " + ".join("CAST(`" + c.replace("`", "``") + "` AS DOUBLE)" for c in columns)
