"""Benchmark decontamination with one Aho-Corasick automaton.

Benchmark items and texts become words: A-Z lower-cased, cut at ASCII characters that are no letter
or digit. A window is 13 consecutive words of an item. Items are laid out in blocks of 7 words from
their first word on, and since 2 * 7 - 1 is 13, every window holds at least one block whole. So the
patterns of the automaton are the blocks, over word numbers, and it has two or three nodes a word of
the benchmark instead of 13 times as many. Each text is scanned once; where a block is met, the words around it are
compared with those around the block in each item, and a common run of 13 words or more is a run of
hit words. An item of fewer than 13 words is a pattern by itself. Places of words in the original are
known, so hits can be given back as spans of it.

A benchmark of more than AUTOMATON_WORDS words gets several automata, each of a slice of its items
(long items are cut into overlapping pieces first). Each slice is collected, built and scanned over
all texts before the next, so no task ever holds two.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from skein.llm.common import ascii_lower, free_name, written

WINDOW_WORDS = 13
#: A text is contaminated if at least one word in so many is hit.
ONE_IN = 20
#: So many words of items go to one automaton. Measured: 200 bytes a word, word table included, so
#: about 300 MB in a Python worker, built in 8 seconds.
AUTOMATON_WORDS = 1_500_000
#: Items are cut into pieces of so many words, each with a window more less one.
PIECE_WORDS = 100_000
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
_WORD = re.compile(rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
#: The same on text columns.
_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(data: bytes | None) -> list[bytes]:
    """Words of UTF-8 text. Folding keeps every byte in its place, and leaves ASCII space alone
    between words."""
    return data.translate(_FOLD).split() if data else []


class Automaton:
    """Blocks and short items as patterns of word numbers. items: (item, words as text)."""

    def __init__(self, items: list[tuple[str, bytes]], window: int = WINDOW_WORDS):
        self.window, self.block = window, (window + 1) // 2
        self.numbers: dict[bytes, int] = {}
        self.names: list[str] = []
        short: dict[tuple[int, ...], set[int]] = {}
        at_of: dict[tuple[int, ...], list[int]] = {}
        # All longer items in a row, with what no text has (-1) around each.
        flat: list[np.ndarray] = [np.full(window, -1, np.int32)]
        starts, owners, size = [], [], window
        places: dict[str, int] = {}
        for item, text in items:
            w = [self.numbers.setdefault(x, len(self.numbers) + 1) for x in words(text)]
            if not w:
                continue
            owner = places.setdefault(item, len(places))
            if len(w) < window:
                short.setdefault(tuple(w), set()).add(owner)
                continue
            starts.append(size)
            owners.append(owner)
            for i in range(0, len(w) - self.block + 1, self.block):
                at_of.setdefault(tuple(w[i : i + self.block]), []).append(size + i)
            flat += [np.array(w, np.int32), np.full(window, -1, np.int32)]
            size += len(w) + window
        self.names = list(places)
        self.flat, self.starts, self.owners = np.concatenate(flat), np.array(starts, np.int64), np.array(owners, np.int64)
        self.digits = max(1, -(-len(self.numbers).bit_length() // 8))
        self.automaton = ahocorasick.Automaton()
        for p in short.keys() | at_of.keys():
            at = at_of.get(p)
            self.automaton.add_word(self._spelled(np.array(p)), (len(p), frozenset(short.get(p, ())), None if at is None else np.array(at, np.int64)))
        self.empty = not (short or at_of)
        if not self.empty:
            self.automaton.make_automaton()

    def _spelled(self, numbers: np.ndarray) -> str:
        """Word numbers as digits of base 256, which are characters of their own at each place. So a
        node of the automaton has 256 successors at most, and looks a digit up among few."""
        out = np.empty((numbers.size, self.digits), "<u4")
        for d in range(self.digits):
            out[:, d] = (numbers >> 8 * d & 255) + 256 * d + 1
        return out.tobytes().decode("utf-32-le")

    def _around(self, n: np.ndarray, a: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of a block met at word a of a text with the numbers n (window zeros around them) and its
        places in items: how many words before and after it the two have in common, up to a window."""
        more = self.window - self.block
        before = n[a + self.window - more : a + self.window][::-1]
        after = n[a + self.window + self.block : a + self.window + self.block + more]
        step = np.arange(more)
        left = self.flat[at[:, None] - 1 - step] == before
        right = self.flat[at[:, None] + self.block + step] == after
        count = lambda same: np.where(same.all(axis=1), more, np.argmin(same, axis=1))
        return count(left), count(right)

    def scan(self, w: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Runs of hit words (first, one past the last) in order and apart, and the items found."""
        if self.empty or not w:
            return [], set()
        get = self.numbers.get
        numbers = np.fromiter((get(x, 0) for x in w), np.int32, len(w))
        runs: list[tuple[int, int]] = []
        found: set[int] = set()
        padded = None
        for end, (n, items, at) in self.automaton.iter(self._spelled(numbers)):
            b = end // self.digits + 1
            a = b - n
            if items:
                runs.append((a, b))
                found |= items
            if at is not None:
                if padded is None:
                    padded = np.zeros(len(w) + 2 * self.window, np.int32)
                    padded[self.window : -self.window] = numbers
                left, right = self._around(padded, a, at)
                good = left + right + self.block >= self.window
                if good.any():
                    runs += {(a - x, b + y) for x, y in zip(left[good].tolist(), right[good].tolist())}
                    found |= set(self.owners[np.searchsorted(self.starts, at[good], "right") - 1].tolist())
        return merged(runs), {self.names[i] for i in found}


def merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Runs in order, those that touch as one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(runs):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def spans(data: bytes, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Runs of words, in order, as spans of characters of the original text."""
    at = [m.span() for m in _WORD.finditer(data.translate(_FOLD))]
    out, done, chars = [], 0, 0
    for a, b in runs:
        start, end = at[a][0], at[b - 1][1]
        first = chars + len(data[done:start].decode("utf-8", "replace"))
        chars = first + len(data[start:end].decode("utf-8", "replace"))
        out.append((first, chars))
        done = end
    return out


def pieces(benchmark: DataFrame, window: int = WINDOW_WORDS, piece: int = PIECE_WORDS) -> DataFrame:
    """item, text (its words, spaced) and n (how many), of items with words. A long item becomes
    pieces that share window - 1 words with the next, so each window is whole in one of them."""
    ws = F.filter(F.regexp_extract_all(ascii_lower(F.col("text")), F.lit(_WORDS), F.lit(0)), lambda x: x != "")
    items = benchmark.where("text is not null").select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"), ws.alias("ws")).where(F.size("ws") > 0)
    # A piece begins where a window does.
    starts = F.sequence(F.lit(0), F.floor(F.greatest(F.size("ws") - window, F.lit(0)) / piece).cast("int"))
    cut = items.select("item", F.explode(F.transform(starts, lambda i: F.slice("ws", i * piece + 1, F.lit(piece + window - 1)))).alias("ws"))
    return cut.select("item", F.array_join("ws", " ").alias("text"), F.size("ws").cast("long").alias("n")).distinct()


def scan(docs: DataFrame, benchmark: DataFrame, limit: int = AUTOMATON_WORDS, window: int = WINDOW_WORDS) -> DataFrame:
    """docs with n_words, n_hit, n_items, items_sha256, contaminated and hits added, hits being spans
    of characters of the text; columns of these names are replaced.

    The benchmark is sent to tasks in slices of about limit words, one after the other. Defined
    results: null and empty texts have no words and are clean; an item without words, or null, matches
    nothing; a null item_id counts as the item `null`; repeated items count once; very long texts are
    read whole; an empty benchmark leaves all clean.
    """
    items = written(pieces(benchmark, window, max(1, min(PIECE_WORDS, limit))), "benchmark-items")
    total = items.agg(F.sum("n")).first()[0] or 0
    n = max(1, -(-total // limit))
    items = items.withColumn("slice", F.pmod(F.xxhash64("item", "text"), F.lit(n)))
    added = ["n_words", "n_hit", "n_items", "items_sha256", "contaminated", "hits"]
    out = docs.drop(*added)
    columns = [f"`{c}`" for c in out.columns]
    text, hit, judge = F.col("text").cast("binary"), free_name(out, "__hit"), F.pandas_udf(judged, _JUDGED)
    if n == 1:
        done = out.withColumn(hit, judge(_searched(items, 0, window)(text)))
        return done.select(*columns, f"{hit}.*")
    # Texts are stored once with a number; each slice says what it finds in which of them.
    number = free_name(out, "__row")
    rows = written(out.withColumn(number, F.monotonically_increasing_id()), "decontamination-rows")
    every = None
    for i in range(n):
        one = rows.select(number, _searched(items, i, window)(text).alias("s"))
        one = written(one if i == 0 else one.where(F.size("s.runs") > 0), "decontamination-found")
        every = one if every is None else every.union(one)
    found = every.groupBy(number).agg(F.struct(F.max("s.n_words").alias("n_words"), F.flatten(F.collect_list("s.runs")).alias("runs"), F.array_distinct(F.flatten(F.collect_list("s.items"))).alias("items")).alias("s"))
    done = rows.join(found.select(number, judge(F.col("s")).alias(hit)), number)
    return done.select(*columns, f"{hit}.*")


_SEARCHED = "n_words long, runs array<struct<a: int, b: int, from: int, to: int>>, items array<string>"


def _searched(items: DataFrame, i: int, window: int):
    """A function of texts (binary) that searches for the items of slice i."""
    mine = items.where(F.col("slice") == i).select("item", "text").collect()
    sent = items.sparkSession.sparkContext.broadcast([(r.item, r.text.encode()) for r in mine])
    built: list[Automaton] = []

    @F.pandas_udf(_SEARCHED)
    def search(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        if not built:
            built.append(Automaton(sent.value, window))
        for text in texts:
            rows = []
            for x in text:
                w = words(x)
                runs, found = built[0].scan(w)
                places = spans(x, runs) if runs else []
                rows.append((len(w), [{"a": a, "b": b, "from": p, "to": q} for (a, b), (p, q) in zip(runs, places)], sorted(found)))
            yield pd.DataFrame(rows, columns=["n_words", "runs", "items"])

    return search


_JUDGED = "n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, hits array<struct<from: int, to: int>>"


def judged(searched: pd.DataFrame) -> pd.DataFrame:
    """What was found by all slices, as the operator's columns."""
    rows = []
    for n, found, items in zip(searched["n_words"], searched["runs"], searched["items"]):
        runs: list[list[int]] = []
        for a, b, p, q in sorted((r["a"], r["b"], r["from"], r["to"]) for r in found):
            if runs and a <= runs[-1][1]:
                runs[-1][1], runs[-1][3] = max(b, runs[-1][1]), max(q, runs[-1][3])
            else:
                runs.append([a, b, p, q])
        hit = sum(b - a for a, b, _, _ in runs)
        sha = hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
        rows.append((n, hit, len(items), sha, hit > 0 and ONE_IN * hit >= n, [{"from": p, "to": q} for _, _, p, q in runs]))
    return pd.DataFrame(rows, columns=["n_words", "n_hit", "n_items", "items_sha256", "contaminated", "hits"])


def op6_decontamination(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = scan(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


#: Every word list and window as the contract states them.
OP6_SQL = """
WITH w AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), []) AS ws FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM benchmark WHERE text IS NOT NULL),
p AS (
  SELECT DISTINCT item, least(len(ws), 13) AS k, array_to_string(ws[i:i + least(len(ws), 13) - 1], ' ') AS pat
  FROM (SELECT item, ws, unnest(generate_series(1, greatest(1, len(ws) - 12))) AS i FROM b WHERE len(ws) > 0)),
ks AS (SELECT DISTINCT k FROM p),
d AS (
  SELECT doc_id, k, i, array_to_string(ws[i:i + k - 1], ' ') AS pat
  FROM (SELECT doc_id, ws, k, unnest(generate_series(1, len(ws) - k + 1)) AS i FROM w, ks WHERE len(ws) >= k)),
m AS (SELECT doc_id, i, d.k, item FROM d JOIN p ON d.k = p.k AND d.pat = p.pat),
h AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + k - 1)) AS j FROM m) GROUP BY 1),
n AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM m GROUP BY 1)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM w LEFT JOIN h USING (doc_id) LEFT JOIN n USING (doc_id)
"""
