"""Packing of documents into sequences by minimum bin slack.

Only lengths decide what fits, and a length is at most the sequence's. So the search works on a
histogram of lengths, which never has more entries than a sequence has tokens. For each sequence,
subset sums over the lengths left, kept as bits of one integer, show the fullest combination that
contains the longest piece left; the combination is taken out as often as the histogram allows, as
the search would find it again. Each repetition exhausts a length, so the plan is bounded as well.
Every piece then finds its sequence and place from its rank among the pieces of its length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from skein.llm.common import written
from skein.llm.tokens import CACHE_PIECES, encoder

CAPACITY = 2048
END_ID = 0


def fullest(counts: dict[int, int], room: int) -> list[int]:
    """Lengths with the largest sum of at most room; counts: pieces by length. Long pieces first."""
    lengths = sorted((n for n in counts if n <= room and counts[n]), reverse=True)
    mask, reach, steps = (1 << (room + 1)) - 1, 1, []
    for n in lengths:
        left, k = min(counts[n], room // n), 1
        while left:
            take = min(k, left)
            steps.append((n, take, reach))
            reach |= (reach << (n * take)) & mask
            left, k = left - take, 2 * k
        if reach >> room & 1:
            break
    total, chosen = reach.bit_length() - 1, []
    for n, take, before in reversed(steps):
        if not before >> total & 1:
            chosen += [n] * take
            total -= n * take
    return chosen


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[int]]]:
    """(repetitions, lengths of one sequence) in order."""
    counts, out = {n: c for n, c in histogram.items() if c}, []
    while counts:
        top = max(counts)
        counts[top] -= 1
        chosen = [top, *fullest(counts, capacity - top)]
        counts[top] += 1
        need = {n: chosen.count(n) for n in chosen}
        times = min(counts[n] // k for n, k in need.items())
        for n, k in need.items():
            counts[n] -= k * times
            if not counts[n]:
                del counts[n]
        out.append((times, chosen))
    return out


def segments(planned: list[tuple[int, list[int]]]) -> dict[int, list[tuple[int, int, int, int]]]:
    """For each length, runs of ranks: (first rank, first sequence, pieces a sequence, offset)."""
    runs: dict[int, list[tuple[int, int, int, int]]] = {}
    ranks: dict[int, int] = {}
    sequence = 0
    for times, chosen in planned:
        offset = 0
        for n in sorted(set(chosen), reverse=True):
            k = chosen.count(n)
            runs.setdefault(n, []).append((ranks.get(n, 0), sequence, k, offset))
            ranks[n] = ranks.get(n, 0) + times * k
            offset += n * k
        sequence += times
    return runs


def pieces(docs: DataFrame, path: str, kind: str = "word", capacity: int = CAPACITY, end_id: int = END_ID, kept_pieces: int = CACHE_PIECES) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, and task and rank, which count
    the pieces of each length in each task. A null doc_id goes through pandas as 0 beside a flag, as
    pandas would turn whole numbers beside a null into floats."""
    end = end_id.to_bytes(4, "little")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        task, seen, enc = TaskContext.get().partitionId(), {}, encoder(path, kind, kept_pieces)
        for b in batches:
            rows = []
            for doc_id, text, known in zip(b["doc_id"].tolist(), b["text"], b["known"].tolist()):
                ids = enc.encode(text) + end
                for i, at in enumerate(range(0, len(ids), 4 * capacity)):
                    x = ids[at : at + 4 * capacity]
                    n = len(x) // 4
                    rows.append((doc_id, known, i, at // 4, n, zlib.crc32(x), task, seen.get(n, 0)))
                    seen[n] = seen.get(n, 0) + 1
            yield pd.DataFrame(rows, columns=["doc_id", "known", "piece", "start", "length", "ids_crc32", "task", "rank"])

    id_ = F.col("doc_id").cast("long")
    cuts = docs.select(F.coalesce(id_, F.lit(0)).alias("doc_id"), id_.isNotNull().alias("known"), "text").mapInPandas(
        cut, "doc_id long, known boolean, piece int, start long, length long, ids_crc32 long, task int, rank long"
    )
    return cuts.withColumn("doc_id", F.when(F.col("known"), F.col("doc_id"))).drop("known")


def pack(docs: DataFrame, path: str, kind: str = "word", capacity: int = CAPACITY, end_id: int = END_ID, kept_pieces: int = CACHE_PIECES) -> DataFrame:
    """One row per piece with sequence_id and offset, sequences filled to capacity as far as possible.

    Defined results: a null or empty text is its end id alone; a longer text than a sequence is cut,
    whole sequences first; repeated rows are pieces of their own; a null doc_id stays null; an empty
    table gives no rows; columns beyond doc_id and text are ignored. kept_pieces bounds what a worker
    remembers of words met before, and changes no result.
    """
    cut = written(pieces(docs, path, kind, capacity, end_id, kept_pieces), "packing-pieces")
    per_task = cut.groupBy("length", "task").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    offsets = per_task.select("length", "task", F.coalesce(before, F.lit(0)).alias("base"))
    histogram = {r.length: r.n for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs = docs.sparkSession.sparkContext.broadcast(segments(plan(histogram, capacity)))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            sequence, offset = np.zeros(len(b), np.int64), np.zeros(len(b), np.int64)
            length, rank = b["length"].to_numpy(), (b["base"] + b["rank"]).to_numpy()
            for n in np.unique(length):
                mine = np.flatnonzero(length == n)
                first, seq, each, off = np.array(runs.value[n], np.int64).T
                at = np.searchsorted(first, rank[mine], "right") - 1
                past = rank[mine] - first[at]
                sequence[mine] = seq[at] + past // each[at]
                offset[mine] = off[at] + past % each[at] * n
            yield b.drop(columns=["rank", "base"]).assign(sequence_id=sequence, offset=offset)

    known = F.col("doc_id").isNotNull().alias("known")
    placed = cut.join(offsets, ["length", "task"]).select(F.coalesce("doc_id", F.lit(0)).alias("doc_id"), known, "piece", "start", "length", "ids_crc32", "rank", "base").mapInPandas(
        place, "doc_id long, known boolean, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )
    return placed.withColumn("doc_id", F.when(F.col("known"), F.col("doc_id"))).drop("known")


def word_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op5_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), word_vocabulary())
