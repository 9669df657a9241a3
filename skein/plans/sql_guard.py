"""Read-only SQL for people: only statements that read run, and results are cut at a limit."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

ALLOWED = {"SELECT", "PRAGMA", "EXPLAIN", "WITH", "SHOW", "DESCRIBE"}
LIMIT = 100
_COMMENT = re.compile(r"\A\s*(?:--[^\n]*(?:\n|\Z)|/\*.*?(?:\*/|\Z))", re.S)
_NODE = re.compile(r"[ :+\-']*\w+")
_WRITES = re.compile("Command|Insert|Create|Drop|Merge|Update|Delete|Overwrite|Truncate|^Set|Alter|Replace")
_READS = re.compile(r"(Explain|Describe|Show)\w*")


def blocked(sql: str, spark: SparkSession | None = None) -> str | None:
    """Why a statement is refused, or None. With a session its parsed plan is looked at as well, so
    that `WITH ... INSERT` is refused too."""
    text = sql
    while m := _COMMENT.match(text):
        text = text[m.end() :]
    word = (text.split() or [""])[0].upper()
    if not word:
        return "BLOCKED: empty statement"
    if word not in ALLOWED:
        return f"BLOCKED: {word} does not only read"
    if spark is not None and word != "PRAGMA":
        tree = spark._jsparkSession.sessionState().sqlParser().parsePlan(text).treeString()
        for line in tree.splitlines():
            name = (_NODE.match(line) or [""])[0].lstrip(" :+-'")
            if _WRITES.search(name) and not _READS.match(name):
                return f"BLOCKED: {name} does not only read"
    return None


def query(spark: SparkSession, sql: str) -> DataFrame:
    """The statement's rows, one more than LIMIT at most, which shows that there are more."""
    if why := blocked(sql, spark):
        raise PermissionError(why)
    return spark.sql(sql).limit(LIMIT + 1)
