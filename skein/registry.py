"""Where queries over the test tables are registered, and SQL that many of them share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from skein.functions import text

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None):
    """Registers a function of a table reader t(name)."""

    def add(f):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"))
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


# SQL of what many queries share.
def norm(c: str) -> str:
    return f"trim(regexp_replace(upper(replace(strip_accents(coalesce({c}, '')), 'ß', 'ss')), '[^A-Z0-9]+', ' ', 'g'))"


def among(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def clean(c: str) -> str:
    bare = norm(c)
    for p in (r"\bTOIP\s*\d+\b", r"\b(?:OPE|PE)\s*\d+\b", r"\bL2L\s*\d+\b", r"\b\d{3,5}\b"):
        bare = f"regexp_replace({bare}, '{p}', ' ', 'g')"
    return f"array_to_string(list_filter(string_split({bare}, ' '), lambda x: x <> '' AND x NOT IN ({among(text.BUSINESS_STOPWORDS)})), ' ')"


def tokens(c: str) -> str:
    return f"list_distinct(list_filter(string_split({c}, ' '), lambda x: length(x) >= 4))"


def hash16(*parts: str) -> str:
    return f"substr(sha1({' || chr(124) || chr(124) || '.join(norm(p) for p in parts)}), 1, 16)"
