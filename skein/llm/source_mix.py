"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Documents fall to blocks of their source by the top bits of a hash, so blocks are random, near equal
in words, and need no sort. A source's target says how often all of its blocks are drawn, and how
many of them once more, in a permuted order; the last one is drawn in part: it is halved by further
bits until few documents are left, of which a subset sum picks those that come nearest. Documents
are drawn whole. The exact numbers of blocks are then split among shards from the root of a tree
down, each split a multivariate hypergeometric draw without replacement; each shard takes the next
run of every source's permuted draws, and its documents are shuffled among themselves.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from skein.llm.common import free_name, packed_rows, written

#: Weights of the sources by code point, repeating, and the mix's size in parts of all sizes.
WEIGHTS, SHARE = (3, 1, 2), Fraction(3, 2)
#: A source gives at most so many times its size.
MOST = 2
SHARDS, SEED = 16, 13
#: Blocks of a corpus, about; a source has at most twice as many. Documents in a block, at least.
BLOCKS, BLOCK_DOCS = 1 << 13, 64
#: So many documents are left to one subset sum, and so many sums are told apart.
LEAF_DOCS, SUMS = 1024, 1 << 20
#: Rows of a list with one row per source, which the driver holds, up to which it goes to every task;
#: beyond, Spark joins by shuffle.
FEW_SOURCES = 100_000
#: Bits of a document's key, the top ones from the document and the last from its row.
BITS, ROW_BITS = 63, 24


def targets(sizes: list[int], weights=WEIGHTS, share=SHARE, most=MOST) -> list[Fraction]:
    """The words each source should give: its weight's part of share times all sizes, at most `most`
    times its size; what is above goes to the others by weight until none is above."""
    total, capped = share * sum(sizes), set()
    while True:
        free = [i for i in range(len(sizes)) if i not in capped]
        left = total - sum(most * sizes[i] for i in capped)
        parts = sum(weights[i % len(weights)] for i in free)
        given = {i: left * weights[i % len(weights)] / parts for i in free}
        above = {i for i in free if given[i] > most * sizes[i]}
        if not above:
            return [given.get(i, Fraction(most * sizes[i])) for i in range(len(sizes))]
        capped |= above


def rows_of(docs: DataFrame, whole: bool = False) -> DataFrame:
    """doc_id, source, size, row and key of each document, and with whole the document as row_. Stored,
    so that all later steps see the same."""
    size = F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
    base = packed_rows(docs, "doc_id", "text", "source") if whole else docs
    rows = base.select("doc_id", "source", size.alias("size"), F.xxhash64("doc_id", "text").alias("h"), F.monotonically_increasing_id().alias("row"), *["row_"] * whole)
    own = F.xxhash64("row").bitwiseAND((1 << ROW_BITS) - 1)
    key = F.shiftrightunsigned(F.col("h").bitwiseAND(-1 << ROW_BITS).bitwiseOR(own), 1)
    return written(rows.withColumn("key", key).drop("h"), "mix-rows")


def _bits(n: int, size: float) -> int:
    """The least number of halvings that bring n down to size."""
    return max(0, int(np.ceil(np.log2(max(n, 1) / max(size, 1)))))


def plan_sources(rows: DataFrame, weights=WEIGHTS, share=SHARE) -> pd.DataFrame:
    """One row per source, as many as the weights are meant for: src (its place), size, target, how often it is
    drawn in full, the rest of words, bits of a block's number."""
    found = rows.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect()
    found.sort(key=lambda r: (r.source is None, r.source or ""))
    want = targets([r.size for r in found], weights, share)
    per_block = sum(r.size for r in found) / BLOCKS
    out = []
    for i, (r, t) in enumerate(zip(found, want)):
        full = int(t // r.size) if r.size else 0
        bits = min(_bits(r.size, per_block), _bits(r.n, BLOCK_DOCS))
        out.append((i, r.source, r.size, float(t), full, round(t - full * r.size), bits))
    return pd.DataFrame(out, columns=["src", "source", "source_size", "target", "full", "rest", "bits"], dtype=object)


def _listed(spark, rows: list[tuple], fields: str) -> DataFrame:
    out = spark.createDataFrame(rows, fields)
    return F.broadcast(out) if len(rows) <= FEW_SOURCES else out


_SOURCES = "src int, source string, source_size long, target double, full int, rest long, bits int"


def dealt(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """rows with what is planned for their source, and their block."""
    joined = rows.alias("r").join(sources.alias("s"), F.expr("r.source <=> s.source")).select("r.*", *(f"s.{c}" for c in sources.columns if c != "source"))
    return joined.withColumn("block", F.expr(f"shiftright(key, {BITS} - bits)"))


def _order(*of) -> list[Column]:
    return [F.xxhash64(*of, F.lit(SEED)), *map(F.col, of)]


def blocks_of(documents: DataFrame) -> DataFrame:
    """src, block, docs, left: the words still wanted once the blocks before it in the permuted order
    are drawn once more, and whole: whether it fits. A source has a bounded number of blocks."""
    sums = documents.groupBy("src", "block").agg(F.sum("size").alias("words"), F.count("*").alias("docs"), F.first("rest").alias("rest"), F.first("full").alias("full"), F.first("bits").alias("bits"))
    before = Window.partitionBy("src").orderBy(*_order("src", "block")).rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("rest") - F.coalesce(F.sum("words").over(before), F.lit(0))
    out = sums.withColumn("left", left).select("src", "block", "docs", "full", "bits", "left", (F.col("words") <= F.col("left")).alias("whole"), "words")
    return written(out, "mix-blocks")


def edges_of(documents: DataFrame, blocks: DataFrame, leaf: int = LEAF_DOCS) -> list[tuple[int, int, int, int, int]]:
    """Of each source whose rest ends inside a block: src, block, the keys from which and up to which
    its subset sum picks, and the words it is to pick; smaller keys of the block are drawn. A block is
    cut by further bits, one pass over the blocks in question for each 12."""
    spark = documents.sparkSession
    found = blocks.where("not whole and left > 0 and left < words")
    todo = [(r.src, r.block, r.block, r.bits, r.docs, r.left) for r in found.where("left > 0").select("src", "block", "bits", "docs", "left").collect()]
    done = []
    while todo:
        small = [x for x in todo if x[4] <= leaf or x[3] >= BITS]
        done += [(i, block, at << (BITS - bits), ((at + 1) << (BITS - bits)) - 1, left) for i, block, at, bits, _, left in small]
        todo = [(*x, min(12, BITS - x[3], _bits(x[4], leaf / 2))) for x in todo if x not in small]
        if not todo:
            break
        cuts = _listed(spark, todo, "src int, edge long, at long, cut int, n long, wanted long, more int")
        inside = documents.select("src", "size", "key").join(cuts, "src").where(F.expr(f"shiftright(key, {BITS} - cut) = at"))
        part = F.expr(f"shiftright(key, {BITS} - cut - more)").alias("part")
        sums = inside.groupBy("src", "edge", "cut", "more", "wanted", part).agg(F.sum("size").alias("words"), F.count("*").alias("docs"))
        before = Window.partitionBy("src").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        sums = sums.withColumn("left", F.col("wanted") - F.coalesce(F.sum("words").over(before), F.lit(0))).where("left > 0 and left < words")
        todo = [(r.src, r.edge, r.part, r.cut + r.more, r.docs, r.left) for r in sums.collect()]
    return done


def nearest_subset(sizes: list[int], want: int) -> list[int]:
    """Places of sizes whose sum is nearest to want (of two, the smaller). At most SUMS sums are told
    apart; larger ones in units."""
    unit = max(1, -(-want // (SUMS // 2)))
    goal, steps = round(want / unit), [round(s / unit) for s in sizes]
    last = np.full(2 * goal + 1, -1, np.int32)
    reached = np.zeros(2 * goal + 1, bool)
    reached[0] = True
    for i, s in enumerate(steps):
        if not 0 < s <= 2 * goal:
            continue
        new = np.flatnonzero(reached[:-s] & ~reached[s:]) + s
        reached[new], last[new] = True, i
        if reached[goal]:
            break
    sums = np.flatnonzero(reached)
    at, out = int(sums[np.argmin(np.abs(sums - goal))]), []
    while at:
        out.append(int(last[at]))
        at -= steps[last[at]]
    return out


def picks(documents: DataFrame, edges: DataFrame) -> DataFrame:
    """row of the documents that the subset sums pick, from at most some LEAF_DOCS of each source."""

    def pick(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["key", "row"])
        return rows.iloc[sorted(nearest_subset(rows["size"].tolist(), int(rows["wanted"].iloc[0])))][["row"]]

    inside = documents.select("src", "row", "size", "key").join(edges, "src").where("key between low and high")
    return inside.select("src", "row", "size", "key", "wanted").groupBy("src").applyInPandas(pick, "row long")


def splitting_tree(quotas: list[int], shards: int = SHARDS, seed: int = SEED) -> np.ndarray:
    """shards x sources: how many of each source's blocks every shard draws. Columns sum to quotas, and
    rows are equal to one block for each level."""
    out = np.zeros((shards, len(quotas)), np.int64)

    def split(low: int, high: int, mine: np.ndarray) -> None:
        if high - low == 1:
            out[low] = mine
            return
        middle = (low + high) // 2
        rng = np.random.default_rng([seed, low, high])
        left = rng.multivariate_hypergeometric(mine, int(mine.sum()) * (middle - low) // (high - low), method="marginals")
        split(low, middle, left)
        split(middle, high, mine - left)

    if len(quotas):
        split(0, shards, np.array(quotas, np.int64))
    return out


def shards_of(blocks: DataFrame, n_sources: int, shards: int = SHARDS) -> DataFrame:
    """src, block, draws: of each time a block is drawn the number, whether in part, and the shard."""
    more = F.when(F.col("whole"), 1).when((F.col("left") > 0), 2).otherwise(0)
    drawn = blocks.withColumn("more", more).select(
        "src", "block", F.explode(F.expr("transform(sequence(0, full), i -> struct(i as pass, i = full and more = 2 as part, i < full or more > 0 as drawn))")).alias("d")
    ).where("d.drawn").select("src", "block", "d.pass", "d.part")
    counts = {r["src"]: r.n for r in drawn.groupBy("src").agg(F.count("*").alias("n")).collect()}
    ends = np.cumsum(splitting_tree([counts.get(i, 0) for i in range(n_sources)], shards), axis=0)
    ends = _listed(blocks.sparkSession, [(i, [int(x) for x in ends[:, i]]) for i in range(n_sources)], "src int, ends array<long>")
    place = F.row_number().over(Window.partitionBy("src").orderBy(*_order("src", "block", "pass"))) - 1
    placed = drawn.withColumn("place", place).join(ends, "src").withColumn("shard", F.expr("cast(size(filter(ends, e -> e <= place)) as int)"))
    return placed.groupBy("src", "block").agg(F.array_sort(F.collect_list(F.struct("pass", "part", "shard"))).alias("draws"))


def drawn(docs: DataFrame, shards: int = SHARDS, weights=WEIGHTS, share=SHARE, whole: bool = False, leaf: int = LEAF_DOCS) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, row, and draws, the number and shard of
    each time the mix takes it; with whole also row_.

    Defined results: null texts have no words and are drawn like others; a null source is a source of
    its own, the last; repeated rows are documents of their own; a source without words is to give
    none; an empty table gives no rows; other columns are ignored. The same files give the same draws.
    """
    spark, rows = docs.sparkSession, rows_of(docs, whole)
    plan = plan_sources(rows, weights, share)
    sources = _listed(spark, [tuple(r) for r in plan.itertuples(index=False)], _SOURCES)
    documents = dealt(rows, sources)
    blocks = blocks_of(documents)
    edges = _listed(spark, edges_of(documents, blocks, leaf), "src int, edge long, low long, high long, wanted long")
    chosen = picks(documents, edges).withColumn("picked", F.lit(True))
    out = documents.join(shards_of(blocks, len(plan), shards), ["src", "block"], "left").join(edges.drop("edge", "high", "wanted"), "src", "left").join(chosen, "row", "left")
    mine = F.coalesce(F.col("picked"), F.lit(False)) | F.coalesce(F.col("key") < F.col("low"), F.lit(False))
    taken = F.filter("draws", lambda d: ~d["part"] | F.col("mine"))
    out = out.withColumn("mine", mine).withColumn("draws", F.coalesce(F.transform(taken, lambda d: F.struct(d["pass"].alias("pass"), d["shard"].alias("shard"))), F.array()))
    return out.select("doc_id", "size", "source_size", "target", "row", "draws", *["row_"] * whole)


def mixed(docs: DataFrame, shards: int = SHARDS, weights=WEIGHTS, share=SHARE) -> DataFrame:
    """The mix: whole documents, once for each draw, with shard, pass (0 for the first time) and turn, by
    which a shard's documents are to be sorted."""
    names = {}
    for n in ("shard", "pass", "turn"):
        names[n] = free_name(docs, n)
    out = drawn(docs, shards, weights, share, whole=True).select("row", "row_", F.explode("draws").alias("d"))
    turn = F.xxhash64("row", "d.pass", F.lit(SEED))
    return out.select("row_.*", F.col("d.shard").alias(names["shard"]), F.col("d.pass").alias(names["pass"]), turn.alias(names["turn"]))


def write_mix(docs: DataFrame, folder: str, shards: int = SHARDS, parts: int = 8) -> None:
    """Writes the mix as Parquet, a folder for each shard of parts files, shuffled within each."""
    out = mixed(docs, shards)
    shard, turn = out.columns[-3], out.columns[-1]
    out.repartition(shard, F.pmod(F.col(turn), F.lit(parts))).sortWithinPartitions(shard, turn).write.partitionBy(shard).parquet(folder)


def op13_source_mix(spark, sf_dir: str) -> DataFrame:
    out = drawn(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.size("draws")).alias("taken"))
