"""Writers: tables by schema, ordered delimited exports, reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def write_table(df: DataFrame, path: str, columns: list[str]) -> None:
    """The columns named, in their order; a run again replaces the table."""
    df.select(*columns).write.mode("overwrite").parquet(path)


def write_export(df: DataFrame, path: str, order: list[str | Column]) -> None:
    """Delimited files with headers whose names sort in the order of the rows. Rows are dealt out by
    range, so no task sorts all of them."""
    df.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").csv(path, header=True)


def report(sections: dict[str, DataFrame], limit: int = 100) -> str:
    """A Markdown report of small aggregates, each a table of at most limit rows; a last row says so
    where there are more."""
    out = []
    for title, df in sections.items():
        out += [f"## {title}", "", "| " + " | ".join(df.columns) + " |", "|" + " --- |" * len(df.columns)]
        rows = df.limit(limit + 1).collect()
        out += ["| " + " | ".join("" if v is None else str(v) for v in r) + " |" for r in rows[:limit]]
        if len(rows) > limit:
            out.append(f"| more than {limit} rows |" + " |" * (len(df.columns) - 1))
        out.append("")
    return "\n".join(out)


def write_suggestions(df: DataFrame, path: str) -> None:
    """One JSON object a line, keys sorted, nulls written."""
    df.select(F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}).alias("value")).write.mode("overwrite").text(path)
