"""Helpers that the corpus operators share: scratch tables, bounded Arrow batches, graph components."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach. A cluster names it in spark.checkpoint.dir; only where
    that is unset on one machine (tests) a temporary folder takes its place."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if not current:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        spark.sparkContext.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="spark-"))
        current = spark.sparkContext.getCheckpointDir()
    return current.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/skein-{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Cuts lineage: writes df to the shared folder and reads it back with the same schema."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def packed_rows(docs: DataFrame, *needed: str) -> DataFrame:
    """The whole rows as one column, row_, beside the columns an operator needs, so that columns the
    operator adds cannot clash with others of the rows."""
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row_"), *needed)


def free_name(df: DataFrame, name: str) -> str:
    """name, with as many underscores after it as make it differ from df's columns."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def ascii_lower(column):
    return F.translate(column, ASCII_UPPER, ASCII_LOWER)


def hot_split(n_rows, limit: int):
    """How many chunks keep every one at or below limit rows."""
    return F.greatest(F.lit(1), F.ceil(n_rows / F.lit(limit))).cast("int")


#: A key with more than this share of the rows is hot; so there are fewer hot keys than its inverse.
HOT_SHARE = 1e-3
#: So many rows are no burden to one task.
FEW_ROWS = 10_000


def hot_keys(counts: DataFrame, keys: list[str]) -> DataFrame | None:
    """Of counts (keys and n, rows by key): the hot keys and over how many __salts to deal each out, or
    None if there is none. There are fewer than 1 / HOT_SHARE, so they may be broadcast."""
    total = counts.agg(F.sum("n")).first()[0] or 0
    if total <= FEW_ROWS:
        return None
    hot = counts.where(F.col("n") > total * HOT_SHARE).select(*keys, F.ceil(F.col("n") / (total * HOT_SHARE)).cast("int").alias("__salts"))
    found = hot.collect()
    return counts.sparkSession.createDataFrame(found, hot.schema) if found else None


def dealt_join(rows: DataFrame, small: DataFrame, keys: list[str], hot: DataFrame | None, how: str = "inner") -> DataFrame:
    """rows joined with small, which has one row per key, without a task that gets all rows of a hot
    key: such rows are dealt out over salts, and small's row of the key goes to each of them. rows
    must be a scan of stored files or derived from one row by row, so that a task that is run again
    deals alike; keys are not null."""
    if hot is None:
        return rows.join(small, keys, how)
    salts, mine = F.coalesce("__salts", F.lit(1)), F.col("__id")
    left = rows.withColumn("__id", F.monotonically_increasing_id()).join(F.broadcast(hot), keys, "left")
    left = left.withColumn("__salt", F.pmod(mine, salts.cast("long")).cast("int")).drop("__id", "__salts")
    right = small.join(F.broadcast(hot), keys, "left").withColumn("__salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("__salts")
    return left.join(right, [*keys, "__salt"], how).drop("__salt")


def skew_join(rows: DataFrame, small: DataFrame, keys: list[str], how: str = "inner", counts: DataFrame | None = None) -> DataFrame:
    """dealt_join() by the measured rows of each key."""
    counts = rows.groupBy(*keys).agg(F.count("*").alias("n")) if counts is None else counts
    return dealt_join(rows, small, keys, hot_keys(counts, keys), how)


def below(df: DataFrame, keys: list[str], h: str, want: int) -> DataFrame:
    """Rows of df whose hash h is among about the want smallest distinct ones of their group, and
    surely not fewer than want of those there are: hashes are spread evenly, so the count of a group
    says where to cut. What is left is bounded by want and the groups, however large a group was.
    The groups must be few, as their cuts are broadcast; rows of df do not move."""
    counts = df.groupBy(*keys).agg(F.approx_count_distinct(h, 0.02).alias("__n"))
    # Eight deviations of the draw, and of the count.
    share = F.least(F.lit(1.0), F.lit((want + 8 * want**0.5 + 16) * 1.2) / F.greatest(F.col("__n"), F.lit(1)))
    cut = counts.select(*(F.col(k).alias(f"__{k}") for k in keys), ((share * 2 - 1) * float(2**63)).alias("__cut"))
    same = F.expr(" and ".join(f"`{k}` = `__{k}`" for k in keys))
    return df.join(F.broadcast(cut), same).where(F.col(h).cast("double") <= F.col("__cut")).select(*df.columns)


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """Connected components as (node, root), root the smallest node reachable; nodes without an edge
    are left out. Large-star and small-star rounds: each is a min-aggregate per node joined back to
    the edges, so no neighbourhood is ever gathered; the join deals out the edges of hot nodes.

    Defined results: null ends and self loops are ignored, no edges give no rows.
    """
    spark = edges.sparkSession
    shared_dir(spark)
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    e = e.where((F.col("u") > F.col("v"))).distinct().checkpoint()
    before = None
    for _ in range(max_rounds):
        state = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            break
        before = state
        e = _star(_star(e, large=True), large=False).checkpoint()
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        e.select(F.col("v"), F.col("v")).distinct()
    )


def _star(e: DataFrame, large: bool) -> DataFrame:
    """Large star: every larger neighbour of u points to the least of u and its neighbours.
    Small star: u and every smaller neighbour point to the least of them."""
    both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else e
    low = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"), F.count("*").alias("n"))
    hung = skew_join(both, low.drop("n"), ["u"], counts=low.select("u", "n"))
    if large:
        out = hung.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = hung.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            low.select("u", F.col("m").alias("v"))
        )
    return out.where("u > v").distinct()
