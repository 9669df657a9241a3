"""SimHash near-duplicates by pigeonhole blocks.

A text's fingerprint is 64 bits, each the majority of that bit over the hashes of its word shingles.
Two fingerprints at Hamming distance k or less, cut into b blocks, agree on at least b - k blocks.
So the join is an equality join on every choice of b - k blocks, and the distance is verified after.

Texts with one fingerprint are one class from the start, and classes are what is joined. Inside a
block key nothing emits all pairs: a key's members are searched breadth first and give a spanning
forest of their links. Keys with more members than CHUNK are cut into chunks, and every pair of
chunks is searched on its own, so no task holds more than two chunks and no pair goes unseen.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from skein.llm.common import components, hot_split, packed_rows, skew_join, written

MAX_BITS = 4
SHINGLE_WORDS = 4
CHUNK = 8192
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_POPCOUNT = getattr(np, "bitwise_count", None) or (lambda x: np.unpackbits(x.view(np.uint8).reshape(-1, 8), axis=1).sum(1))


def fingerprint(data: bytes | None, n: int = SHINGLE_WORDS) -> int:
    """Unsigned fingerprint of UTF-8 text: A-Z lower-cased, words split at ASCII space, shingles of n
    words with repeats, XXH64 seed 42. Fewer words make one shingle; no words, or null, give 0."""
    words = data.translate(_LOWER).split() if data else []
    if len(words) <= n:
        return xxhash.xxh64_intdigest(b" ".join(words), 42) if words else 0
    shingles = map(b" ".join, zip(*(words[i:] for i in range(n))))
    size = len(words) - n + 1
    ones = np.zeros(64, np.int64)
    hashes = map(xxhash.xxh64_intdigest, shingles, repeat(42))
    for done in range(0, size, 65536):
        h = np.fromiter(hashes, np.dtype("<u8"), min(65536, size - done))
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int32)
    return int(np.packbits(2 * ones > size, bitorder="little").view("<u8")[0])


@F.pandas_udf(T.LongType())
def _fingerprints(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for text in texts:
        yield pd.Series(np.array([fingerprint(x) for x in text], np.uint64).view(np.int64))


def with_fingerprint(docs: DataFrame, text: str = "text", out: str = "fp") -> DataFrame:
    """docs with the fingerprint as a signed long (its 64 bits)."""
    return docs.withColumn(out, _fingerprints(F.col(text).cast("binary")))


def scheme(n: int, max_bits: int) -> list[list[tuple[int, int]]]:
    """Choices of blocks as (lowest bit, width) lists. The key grows with the number of classes, so
    that two unrelated classes seldom meet at any input size; any choice is exact."""
    blocks = max_bits + 1
    while True:
        edges = [round(64 * i / blocks) for i in range(blocks + 1)]
        parts = [(a, b - a) for a, b in zip(edges, edges[1:])]
        chosen = [list(c) for c in combinations(parts, blocks - max_bits)]
        if n <= 2 ** min(sum(w for _, w in c) for c in chosen) / 2 or blocks >= 16:
            return chosen
        blocks += 1


def _key(fp, choice, i: int):
    """The bits of the chosen blocks, and which choice it is, as one long or as a pair."""
    key, at = F.lit(0).cast("long"), 0
    for low, width in choice:
        bits = F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << width) - 1).cast("long"))
        key, at = key.bitwiseOR(F.shiftleft(bits, at)), at + width
    return F.struct(F.lit(i).cast("short").alias("c"), key.alias("bits"))


def _forest(fp: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the links between distinct fingerprints."""
    left, edges = fp.view(np.uint64), []
    while left.size > 1:
        todo, left = [left[0]], left[1:]
        while todo and left.size:
            x = todo.pop()
            near = _POPCOUNT(left ^ x) <= max_bits
            if near.any():
                found = left[near]
                edges += [(int(x.view(np.int64)), int(y)) for y in found.view(np.int64)]
                todo += list(found)
                left = left[~near]
    return edges


def _search(max_bits: int):
    """Reads rows that are sorted by group and yields the links of every group; a group is at most
    two chunks long, so what is carried from batch to batch is bounded."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for b in batches:
            b = b if rest is None else pd.concat([rest, b], ignore_index=True)
            if b.empty:
                continue
            group = b[["c", "bits", "i", "j"]].to_numpy()
            starts = np.flatnonzero(np.r_[True, (group[1:] != group[:-1]).any(axis=1)])
            rest = b.iloc[starts[-1] :]
            yield from _edges(b["fp"].to_numpy(), starts, max_bits)
        if rest is not None and len(rest):
            yield from _edges(rest["fp"].to_numpy(), np.array([0, len(rest)]), max_bits)

    return run


def _edges(fp: np.ndarray, starts: np.ndarray, max_bits: int) -> Iterator[pd.DataFrame]:
    """Links of all groups but the last, which may go on in the next batch. Most groups are pairs,
    which are compared all at once."""
    lengths = np.diff(starts)
    two = starts[:-1][lengths == 2]
    near = _POPCOUNT(fp[two].view(np.uint64) ^ fp[two + 1].view(np.uint64)) <= max_bits
    found = list(zip(fp[two][near].tolist(), fp[two + 1][near].tolist()))
    for s, n in zip(starts[:-1][lengths > 2], lengths[lengths > 2]):
        found += _forest(fp[s : s + n], max_bits)
    if found:
        yield pd.DataFrame(found, columns=["a", "b"])


def links(classes: DataFrame, max_bits: int = MAX_BITS, chunk: int = CHUNK) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (column fp) within max_bits that connect the same
    classes as all such links do."""
    choices = scheme(classes.count(), max_bits)
    keys = F.explode(F.array(*[_key(F.col("fp"), c, i) for i, c in enumerate(choices)]))
    keyed = classes.select("fp", keys.alias("k")).select("fp", "k.c", "k.bits")
    met = keyed.groupBy("c", "bits").agg(F.count("*").alias("n")).where("n > 1")
    n = hot_split(F.col("n"), chunk)
    mine = F.pmod(F.xxhash64("fp"), F.col("n_chunks").cast("long")).cast("int")
    dealt = keyed.join(met, ["c", "bits"]).withColumn("n_chunks", n).withColumn("m", mine)
    other = F.explode(F.sequence(F.lit(0), F.col("n_chunks") - 1))
    dealt = dealt.withColumn("o", other).select("c", "bits", F.least("m", "o").alias("i"), F.greatest("m", "o").alias("j"), "fp")
    dealt = dealt.repartition("c", "bits", "i", "j").sortWithinPartitions("c", "bits", "i", "j", "fp")
    return dealt.mapInPandas(_search(max_bits), "a long, b long").distinct()


def fingerprint_components(ids: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Of rows (doc_id, fp): one row per fingerprint (fp, component_id, root), component_id the
    smallest doc_id of the component and root the smallest fingerprint."""
    classes = written(ids.groupBy("fp").agg(F.min("doc_id").alias("low")), "simhash-classes")
    found = components(links(classes.select("fp"), max_bits)).withColumnsRenamed({"node": "fp"})
    rooted = classes.join(found, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    rooted = written(rooted, "simhash-rooted")
    low = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    return skew_join(rooted, low, ["root"]).select("fp", "component_id", "root")


def near_duplicates(docs: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per document: doc_id, fp, component_id and root.

    Defined results: null and empty texts and texts without words have fingerprint 0 and are linked
    to each other; very long texts are read whole; repeated rows are rows of one class. A component
    all of whose doc_ids are null has a null component_id. An empty table gives no rows.
    """
    ids = written(with_fingerprint(docs.select("doc_id", "text")).select("doc_id", "fp"), "simhash-ids")
    return skew_join(ids, fingerprint_components(ids, max_bits), ["fp"]).select("doc_id", "fp", "component_id", "root")


#: So many doc_ids, 8 bytes each, may be sent to every task.
SENT_IDS = 200_000


def _of_ids(rows: DataFrame, ids: DataFrame, n: int, on: str, how: str) -> DataFrame:
    """rows joined with ids, which are broadcast if they are few."""
    return rows.join(F.broadcast(ids) if n <= SENT_IDS else ids, F.expr(on), how)


def drop_near_duplicates(docs: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """docs without all but one document of each component: the one with the smallest doc_id, of
    repeated rows of it the one with the smallest text. Columns stay as they are. Texts move once, to
    meet the doc_ids that stay; rows whose doc_id does not tell them apart move once more.

    Defined results: null and empty texts are one component; a component without a doc_id keeps a row
    without one; an empty table gives no rows; columns of docs are never mistaken for added ones.
    """
    near = written(near_duplicates(docs, max_bits), "simhash-near")
    # Copies with one doc_id are one row from here on.
    low = near.where("doc_id <=> component_id").groupBy("doc_id", "fp", "root").agg(F.count("*").alias("n"))
    n = low.groupBy("root").agg(F.sum("n").alias("of_root"))
    # A doc_id alone says which row to keep if no other row has it, in this component or another.
    single = near.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("m")).where("m = 1").select("doc_id", F.lit(True).alias("single"))
    lone = F.coalesce("single", F.lit(False)) & (F.col("of_root") == 1)
    low = written(low.join(single, "doc_id", "left").join(n, "root").select("doc_id", "fp", "root", lone.alias("lone")), "simhash-low")
    kept = docs.join(low.where("lone").select("doc_id"), "doc_id", "left_semi").select(*(f"`{c}`" for c in docs.columns))
    named = written(low.where("not lone").select(F.col("doc_id").alias("id_"), F.col("fp").alias("fp_"), "root").distinct(), "simhash-again")
    many = named.count()
    if not many:
        return kept
    rows = _of_ids(packed_rows(docs, "doc_id", "text"), named.select("id_").distinct(), many, "doc_id <=> id_", "left_semi")
    mine = _of_ids(with_fingerprint(rows), named, many, "fp = fp_ and doc_id <=> id_", "inner")
    first = mine.groupBy("root").agg(F.min_by("row_", F.struct("text", F.xxhash64("row_"))).alias("row_")).select("row_.*")
    return kept.unionByName(first)


def op3_simhash(spark, sf_dir: str) -> DataFrame:
    near = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return near.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
