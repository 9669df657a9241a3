"""Rows that win: latest, best, top k with quotas, first seen. All ties are broken by columns given."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, Window, functions as F


def best_per_key(df: DataFrame, keys: list[str], order: list[Column], k: int = 1) -> DataFrame:
    """The first k rows of each key in this order. Spark drops rows that cannot win before it
    shuffles (window group limit), so a hot key sends k rows per task."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rank", F.row_number().over(w)).where(F.col("__rank") <= k).drop("__rank")


def max_row_per_key(df: DataFrame, keys: list[str], by: Column, columns: list[str]) -> DataFrame:
    """One row per key, the one with the largest `by` (a struct that holds its tie-breaks). An
    aggregate with a partial step, so it suits keys of any size."""
    row = F.max_by(F.struct(*columns), by).alias("row")
    return df.groupBy(*keys).agg(row).select(*keys, *(F.col(f"row.{c}").alias(c) for c in columns))


def latest_per_key(log: DataFrame, keys: list[str], time: str, tie: str) -> DataFrame:
    """The newest version of each key; equal times: the greater tie."""
    return best_per_key(log, keys, [F.desc(time), F.desc(tie)])


def quota_top(df: DataFrame, keys: list[str], group: str, quotas: dict[str, int], order: list[Column], same: list[str]) -> DataFrame:
    """Per key the first rows of each class by quota, then the first of those that are the same.
    Classes come in the order of quotas; other classes are left out. Adds pick, from 1 per key."""
    place = F.create_map(*(x for i, g in enumerate(quotas) for x in (F.lit(g), F.lit(i))))
    limit = F.create_map(*(x for g, n in quotas.items() for x in (F.lit(g), F.lit(n))))
    known = df.where(F.col(group).isin(list(quotas)))
    ranked = known.withColumn("__in", F.row_number().over(Window.partitionBy(*keys, group).orderBy(*order)))
    kept = ranked.where((F.col("__in") <= max(quotas.values())) & (F.col("__in") <= F.element_at(limit, F.col(group))))
    kept = kept.withColumn("__class", F.element_at(place, F.col(group)))
    once = best_per_key(kept, [*keys, *same], [F.col("__class"), F.col("__in")])
    pick = F.row_number().over(Window.partitionBy(*keys).orderBy("__class", "__in"))
    return once.withColumn("pick", pick).drop("__in", "__class")


def first_seen(df: DataFrame, keys: list[str], ordinal: str) -> DataFrame:
    return best_per_key(df, keys, [F.col(ordinal)])


def stored(df: DataFrame) -> DataFrame:
    """df worked out once and kept in the checkpoint folder, so that all that is made of it sees the
    same rows. The folder is the one that the session names; a temporary one only on one machine."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        named = context.getConf().get("spark.checkpoint.dir", None)
        if not named and not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        context.setCheckpointDir(named or "file://" + tempfile.mkdtemp(prefix="spark-"))
    return df.checkpoint()


def numbered(df: DataFrame, order: list[str], out: str, prefix: str | None = None, width: int = 5) -> DataFrame:
    """Numbers from 1 in this order without a one-task sort: rows are dealt out by range and stored
    with their place; then each partition's numbers start after the rows before it."""
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id())
    dealt = stored(dealt).withColumn("__p", F.shiftright("__at", 33))
    counts = dealt.groupBy("__p").agg(F.count("*").alias("__n"))
    # One row per partition.
    before = counts.withColumn("__base", F.coalesce(F.sum("__n").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    n = F.col("__base") + F.col("__at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    value = n if prefix is None else F.concat(F.lit(prefix), F.when(n < 10**width, F.lpad(n.cast("string"), width, "0")).otherwise(n.cast("string")))
    return dealt.join(F.broadcast(before.select("__p", "__base")), "__p").withColumn(out, value).drop("__p", "__at", "__base")


def batches(df: DataFrame, keys: list[str], order: list[str], size: int, out: str = "batch") -> DataFrame:
    """Batch numbers from 0 per key, each of at most size rows."""
    n = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn(out, F.floor((n - 1) / size).cast("int"))
