"""Sharding by sampled splitters, with shards of near equal bytes.

Documents are ordered by a key: the hash of the text, then doc_id, then the row. Equal texts thus
stand together and share a shard, except where a shard ends inside their group. A sample, weighted by
size, shows where the key's quantiles by bytes lie; the splitters there cut the documents into
ranges of about equal bytes. A range that holds too many rows all the same, as runs of short texts
do, is subdivided by quantiles of its own rows. Exact sizes of the ranges then place every document
on the line of all bytes, and shards end there to the document. A group of copies, however large, is
cut by doc_id and row like any other run of keys.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from skein.llm.common import written

SHARDS = 16
#: Ranges for each shard, and sampled keys for each range; more ranges for more documents.
RANGES_PER_SHARD = 8
ROWS_PER_RANGE = 200_000
SAMPLES_PER_RANGE = 32
#: Bounds of the sample the driver sees, and of the ranges, whose splitters go to every task.
MAX_SAMPLES = 2_000_000
MAX_RANGES = 65_536
#: Ranges are summed up in runs of so many, then the runs.
RUN = 1024


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32, the hash of the text, and a number for the row."""
    rows = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.xxhash64("text").alias("h"),
    )
    return written(rows.withColumn("row", F.monotonically_increasing_id()), "shard-keys")


def _packed(h, doc_id, row) -> np.ndarray:
    """Keys as 24 bytes that compare like (h, doc_id, row)."""
    out = np.empty((len(h), 3), ">u8")
    for i, x in enumerate((h, doc_id, row)):
        out[:, i] = np.asarray(x, np.int64).view(np.uint64) ^ np.uint64(1 << 63)
    return out.view("S24").ravel()


_NO_ID = -(1 << 63)


def sample(rows: DataFrame, weight: Column, want: int, total: int, *also: str) -> pd.DataFrame:
    """About want rows of a sample in which a row's chance is its share of the total weight, at most
    1: h, doc_id, row and w, what it stands for. The row's hash decides, so the same rows give the
    same sample."""
    chance = weight * F.lit(want / max(total, 1))
    drawn = F.pmod(F.xxhash64("h", "doc_id", "row", F.lit("sample")), F.lit(1 << 30)) / F.lit(float(1 << 30)) < chance
    # A row whose chance would be over 1 stands for that many.
    picked = rows.where(drawn).select("h", F.coalesce("doc_id", F.lit(_NO_ID)).alias("doc_id"), "row", F.greatest(chance, F.lit(1.0)).alias("w"), *also)
    return picked.toPandas().sort_values(["h", "doc_id", "row"])


def quantiles(got: pd.DataFrame, parts: int) -> list[tuple[int, int, int]]:
    """The keys that cut a sorted sample into parts of about equal weight."""
    if got.empty:
        return []
    at = np.cumsum(got["w"].to_numpy())
    cut = np.unique(np.searchsorted(at, at[-1] * np.arange(1, parts) / parts))
    return [tuple(int(x) for x in r) for r in got.iloc[cut[cut < len(got)]][["h", "doc_id", "row"]].to_numpy()]


def ranged(rows: DataFrame, cuts: list[tuple[int, int, int]]) -> DataFrame:
    """rows with range, the number of splitters at or below their key."""
    sent = rows.sparkSession.sparkContext.broadcast(cuts)

    @F.pandas_udf("int")
    def range_of(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        c = np.array(sent.value, np.int64).reshape(-1, 3)
        edges = _packed(c[:, 0], c[:, 1], c[:, 2])
        for h, doc_id, row in batches:
            yield pd.Series(np.searchsorted(edges, _packed(h, doc_id, row), "right").astype(np.int32))

    return rows.withColumn("range", range_of("h", F.coalesce("doc_id", F.lit(_NO_ID)), "row"))


def splitters(rows: DataFrame, shards: int, n: int, total: int, rows_per_range: int = ROWS_PER_RANGE) -> list[tuple[int, int, int]]:
    """Key quantiles by bytes, and in ranges that still hold more than twice the rows they should,
    quantiles by rows."""
    ranges = min(MAX_RANGES, max(shards * RANGES_PER_SHARD, -(-n // rows_per_range)))
    cuts = quantiles(sample(rows, F.col("size"), min(MAX_SAMPLES, ranges * SAMPLES_PER_RANGE), total), ranges)
    fair = max(rows_per_range, -(-n // MAX_RANGES))
    # At most MAX_RANGES rows come to the driver.
    full = {r.range: r.n for r in ranged(rows, cuts).groupBy("range").agg(F.count("*").alias("n")).where(F.col("n") > 2 * fair).collect()}
    if full:
        inside = ranged(rows, cuts).where(F.col("range").isin(list(full)))
        want = min(MAX_SAMPLES, sum(-(-k // fair) for k in full.values()) * SAMPLES_PER_RANGE)
        got = sample(inside, F.lit(1), want, sum(full.values()), "range")
        for r, part in got.groupby("range"):
            cuts += quantiles(part, -(-full[r] // fair))
    return sorted(set(cuts))


def bases(placed: DataFrame) -> DataFrame:
    """range, first_row and first_byte: what lies before each range. Ranges are summed up in runs,
    and the runs, of which there are at most MAX_RANGES / RUN doubled, among themselves."""
    per = placed.groupBy("range").agg(F.count("*").alias("n"), F.sum("size").alias("bytes")).withColumn("run", F.floor(F.col("range") / RUN))
    before = lambda w, c: F.coalesce(F.sum(c).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = per.groupBy("run").agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes"))
    all_, each = Window.orderBy("run"), Window.partitionBy("run").orderBy("range")
    runs = runs.select("run", before(all_, "n").alias("run_row"), before(all_, "bytes").alias("run_byte"))
    per = per.select("run", "range", before(each, "n").alias("row_"), before(each, "bytes").alias("byte_"))
    return per.join(F.broadcast(runs), "run").select("range", (F.col("run_row") + F.col("row_")).alias("first_row"), (F.col("run_byte") + F.col("byte_")).alias("first_byte"))


def shard_of(middle2: Column, shards: int, total: int) -> Column:
    """Of the number whose half is a place on the line of total bytes: its shard, in whole numbers."""
    place = (middle2.cast("decimal(38,0)") * F.lit(shards)).cast("decimal(38,0)")
    return F.least(F.call_function("div", place, F.lit(2 * max(total, 1)).cast("decimal(38,0)")), F.lit(shards - 1)).cast("int")


def assign(docs: DataFrame, shards: int = SHARDS, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, shard and slot (from 0 in each shard).

    Defined results: a null text has no bytes and size 1 and counts as an equal of other null texts;
    null doc_ids come before others; repeated rows have slots of their own; fewer documents than
    shards leave shards empty; an empty table gives no rows; other columns are ignored.
    """
    if shards < 1:
        raise ValueError("at least one shard")
    rows = keyed(docs)
    n, total = rows.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    dealt = written(ranged(rows, splitters(rows, shards, n, total, rows_per_range)), "shard-ranges")
    inside = Window.partitionBy("range").orderBy("h", "doc_id", "row").rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt.join(bases(dealt), "range").select(
        "doc_id", "size", "text_crc32",
        (F.col("first_row") + F.count("*").over(inside)).alias("place"),
        (F.col("first_byte") + F.coalesce(F.sum("size").over(inside), F.lit(0))).alias("byte"),
    )
    # A document goes where the middle of its bytes lies.
    placed = written(placed.withColumn("shard", shard_of(F.col("byte") * 2 + F.col("size"), shards, total)), "shard-places")
    first = placed.groupBy("shard").agg(F.min("place").alias("first"))
    return placed.join(F.broadcast(first), "shard").select("doc_id", "size", "text_crc32", "shard", (F.col("place") - F.col("first")).alias("slot"))


def write_shards(docs: DataFrame, folder: str, shards: int = SHARDS) -> None:
    """Writes whole documents as Parquet, one folder per shard, with their slots. Rows with one doc_id
    and text are one another's equals; rows of one doc_id with different texts keep their own."""
    placed = assign(docs, shards).withColumn("__n", F.row_number().over(Window.partitionBy("doc_id", "text_crc32").orderBy("shard", "slot")))
    own = docs.withColumn("__crc", F.crc32(F.coalesce("text", F.lit("")).cast("binary")))
    own = own.withColumn("__n", F.row_number().over(Window.partitionBy("doc_id", "__crc").orderBy("text")))
    p = placed.select(F.col("doc_id").alias("__id"), F.col("text_crc32").alias("__p"), F.col("__n").alias("__m"), "shard", "slot")
    whole = own.join(p, F.expr("doc_id <=> __id and __crc = __p and __n = __m")).drop("__id", "__p", "__m", "__crc", "__n")
    whole.repartition("shard", F.pmod(F.xxhash64("slot"), F.lit(8))).sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(folder)


def op10_sharding(spark, sf_dir: str) -> DataFrame:
    placed = assign(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
