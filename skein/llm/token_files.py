"""Token-id shards with keyed access.

A shard is two files: `NAME.ids`, the raw ids of its documents one after the other, and `NAME.idx`,
where each document lies and a minimal perfect hash from keys to documents. The hash is a cascade of
bit arrays: a key that is alone at its bit of a level is settled there, the others go on to the next
level, and a key's number is the count of bits set before its own. Numbers are thus 0 to n - 1
without gaps. Each carries a 32-bit fingerprint, so a lookup of a key that was never stored is told
apart but for one case in 2**32. A lookup reads the header, a few words of the index and one run of
the payload, whatever their sizes.

Layout of `.idx`, all little-endian: magic (8 bytes), header (6 x u64: documents, ids, bytes an id,
keys, levels, null keys), the levels' sizes in bits (u64 each), their bits padded to 64 (u64 words),
counts of bits before each word (u64), fingerprints (u32 by number), documents by number (u32, padded
to 8 bytes), keys (i64 by document), starts (u64 by document and one more).
"""

from __future__ import annotations

import json
import struct
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, functions as F

from skein.llm.common import scratch_path
from skein.llm.tokens import encoder

MAGIC = b"SKTOK\x00\x00\x01"
GAMMA = 1.5
#: A shard is closed at so many ids or documents, whichever comes first.
SHARD_IDS = 1 << 27
SHARD_DOCS = 1 << 22
END_ID = 2


def open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder that all executors share, and the path in it."""
    if "://" not in uri.replace("file:", "", 1) or uri.startswith("file:"):
        rest = uri.removeprefix("file:")
        return pafs.LocalFileSystem(), "/" + rest.lstrip("/") if uri.startswith("file:") else rest
    return pafs.FileSystem.from_uri(uri)


def _mix(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hash(keys: np.ndarray, salt: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return _mix(keys.astype(np.int64).view(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (salt + 1)) & (2**64 - 1)))


class PerfectHash:
    """Minimal perfect hash over distinct 64-bit keys."""

    def __init__(self, sizes: list[int], words: np.ndarray, ranks: np.ndarray, fingerprints: np.ndarray):
        self.sizes, self.words, self.ranks, self.fingerprints = sizes, words, ranks, fingerprints
        self.first = np.cumsum([0, *((s + 63) // 64 for s in sizes)])

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        sizes, parts, left, level = [], [], keys, 0
        while left.size:
            size = max(64, int(left.size * GAMMA))
            at = (_hash(left, level) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            bits = np.zeros((size + 63) // 64 * 64, bool)
            bits[:size] = alone
            parts.append(np.packbits(bits, bitorder="little").view("<u8"))
            sizes.append(size)
            left, level = left[~alone[at]], level + 1
        words = np.concatenate(parts) if parts else np.zeros(0, "<u8")
        ranks = np.cumsum(np.r_[0, np.bitwise_count(words)])[:-1].astype("<u8") if words.size else np.zeros(0, "<u8")
        out = cls(sizes, words, ranks, np.zeros(keys.size, "<u4"))
        out.fingerprints[out.numbers(keys)] = out.fingerprint(keys)
        return out

    @staticmethod
    def fingerprint(keys: np.ndarray) -> np.ndarray:
        return (_hash(keys, 1 << 20) >> np.uint64(32)).astype("<u4")

    def numbers(self, keys: np.ndarray) -> np.ndarray:
        """Each key's number, or -1 where no level has it. Says nothing of keys never stored."""
        out = np.full(keys.size, -1, np.int64)
        todo = np.arange(keys.size)
        for level, size in enumerate(self.sizes):
            at = (_hash(keys[todo], level) % np.uint64(size)).astype(np.int64)
            word, bit = self.first[level] + at // 64, (at % 64).astype(np.uint64)
            w = self.words[word]
            has = (w >> bit) & np.uint64(1) == 1
            below = w & ((np.uint64(1) << bit) - np.uint64(1))
            out[todo[has]] = (self.ranks[word] + np.bitwise_count(below))[has].astype(np.int64)
            todo = todo[~has]
        return out

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Each key's number, or -1 for a key that was never stored."""
        n = self.numbers(keys)
        known = n >= 0
        known[known] = self.fingerprints[n[known]] == self.fingerprint(keys[known])
        return np.where(known, n, -1)


def index_bytes(keys: np.ndarray, nulls: int, starts: np.ndarray, width: int) -> bytes:
    """keys by document, nulls of them null and first; equal keys stand together, and the index
    leads to the first of them."""
    real = keys[nulls:]
    first = np.flatnonzero(np.r_[True, real[1:] != real[:-1]]) if real.size else np.zeros(0, np.int64)
    h = PerfectHash.build(real[first])
    rows = np.zeros(first.size + first.size % 2, "<u4")
    rows[h.numbers(real[first])] = first + nulls
    fingerprints = np.r_[h.fingerprints, np.zeros(first.size % 2, "<u4")]
    head = struct.pack("<6Q", keys.size, int(starts[-1]), width, first.size, len(h.sizes), nulls)
    arrays = [np.array(h.sizes, "<u8"), h.words, h.ranks, fingerprints.astype("<u4"), rows, keys.astype("<i8"), starts.astype("<u8")]
    return MAGIC + head + b"".join(a.tobytes() for a in arrays)


class Index:
    def __init__(self, data: bytes):
        if data[:8] != MAGIC:
            raise ValueError("not a token index")
        docs, self.n_ids, self.width, n, levels, self.nulls = struct.unpack_from("<6Q", data, 8)
        at = 56

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, kind, count, at)
            at += out.nbytes
            return out

        sizes = [int(x) for x in take("<u8", levels)]
        n_words = sum((s + 63) // 64 for s in sizes)
        words, ranks = take("<u8", n_words), take("<u8", n_words)
        self.hash = PerfectHash(sizes, words, ranks, take("<u4", n + n % 2)[:n])
        self.rows = take("<u4", n + n % 2)[:n]
        self.keys, self.starts = take("<i8", docs), take("<u8", docs + 1).astype(np.int64)

    def rows_of(self) -> np.ndarray:
        """The row of each document by way of the hash: its key leads to the first document with that
        key, and documents that share one follow it."""
        real = self.keys[self.nulls :]
        found = self.hash.find(real)
        if (found < 0).any():
            raise ValueError("the index does not know its own keys")
        place = np.arange(real.size)
        first = np.maximum.accumulate(np.where(np.r_[True, real[1:] != real[:-1]], place, 0)) if real.size else place
        return np.r_[np.arange(self.nulls), self.rows[found].astype(np.int64) + place - first]


class Lookup:
    """One key at a time in an open index, of which only what is needed is read: the header once, then
    for each key a word and a count a level until one has it, its fingerprint, row, key and place."""

    def __init__(self, file):
        self.file = file
        head = file.read_at(56, 0)
        if head[:8] != MAGIC:
            raise ValueError("not a token index")
        self.docs, self.n_ids, self.width, n, levels, self.nulls = struct.unpack_from("<6Q", head, 8)
        self.sizes = struct.unpack(f"<{levels}Q", file.read_at(8 * levels, 56))
        self.first = [0]
        for s in self.sizes:
            self.first.append(self.first[-1] + (s + 63) // 64)
        self.words = 56 + 8 * levels
        self.ranks = self.words + 8 * self.first[-1]
        self.fingerprints = self.ranks + 8 * self.first[-1]
        self.rows = self.fingerprints + 4 * (n + n % 2)
        self.keys = self.rows + 4 * (n + n % 2)
        self.starts = self.keys + 8 * self.docs

    def _read(self, kind: str, at: int, count: int = 1) -> np.ndarray:
        return np.frombuffer(self.file.read_at(np.dtype(kind).itemsize * count, at), kind)

    def place(self, key: int) -> tuple[int, int] | None:
        """Where the ids of the first document with this key start and end, or None."""
        k = np.array([key], np.int64)
        for level, size in enumerate(self.sizes):
            at = int(_hash(k, level)[0] % np.uint64(size))
            word = int(self._read("<u8", self.words + 8 * (self.first[level] + at // 64))[0])
            if word >> (at % 64) & 1:
                below = (word & ((1 << (at % 64)) - 1)).bit_count()
                n = int(self._read("<u8", self.ranks + 8 * (self.first[level] + at // 64))[0]) + below
                if int(self._read("<u4", self.fingerprints + 4 * n)[0]) != int(PerfectHash.fingerprint(k)[0]):
                    return None
                row = int(self._read("<u4", self.rows + 4 * n)[0])
                if int(self._read("<i8", self.keys + 8 * row)[0]) != key:
                    return None
                start, end = self._read("<u8", self.starts + 8 * row, 2)
                return int(start), int(end)
        return None


def _dtype(width: int) -> str:
    return f"<u{width}"


class _Shard:
    """Writes one shard under a name of this attempt; close() gives it its own name, so a task that
    is run again leaves the same file and never half of one."""

    def __init__(self, folder: str, name: str, attempt: int, width: int):
        self.fs, path = open_fs(folder)
        self.path, self.name, self.width = f"{path}/{name}", name, width
        self.part = f"{path}/.{name}-{attempt}"
        self.out = self.fs.open_output_stream(self.part + ".ids")
        self.keys, self.sizes, self.nulls, self.n = [], [], 0, 0

    def add(self, key, ids: bytes) -> None:
        x = np.frombuffer(ids, "<u4")
        if self.width < 4 and x.size and int(x.max()) >> 8 * self.width:
            raise ValueError(f"an id of {int(x.max())} does not fit into {self.width} bytes; write with width=4")
        self.out.write(x.astype(_dtype(self.width)).tobytes() if self.width != 4 else ids)
        self.nulls += key is None
        self.keys.append(key or 0)
        self.sizes.append(x.size)
        self.n += x.size

    def full(self) -> bool:
        return self.n >= SHARD_IDS or len(self.keys) >= SHARD_DOCS

    def close(self) -> dict:
        self.out.close()
        keys, starts = np.array(self.keys, np.int64), np.cumsum([0, *self.sizes])
        with self.fs.open_output_stream(self.part + ".idx") as f:
            f.write(index_bytes(keys, self.nulls, starts, self.width))
        for end in (".ids", ".idx"):
            self.fs.move(self.part + end, self.path + end)
        real = keys[self.nulls :]
        return {"name": self.name, "docs": len(keys), "ids": self.n, "nulls": self.nulls, "low": int(real[0]) if real.size else None, "high": int(real[-1]) if real.size else None}


#: Pieces that a writing worker remembers; it writes for long, beside an executor's other workers.
KEPT_PIECES = 300_000


def write(docs: DataFrame, folder: str, path: str, kind: str = "byte", end_id: int = END_ID, width: int = 2, partitions: int | None = None) -> list[dict]:
    """Writes docs in ascending doc_id order as shards and `manifest.json`; returns the manifest: one
    entry per shard, in order, with start, the ids of all documents before it.

    Defined results: a null or empty text is its end id alone; null doc_ids come first and cannot be
    looked up; rows with one doc_id are ordered by their text's hash, and a lookup finds the first;
    an empty table gives an empty manifest; columns beyond doc_id and text are ignored. An id that
    does not fit into width bytes is an error.
    """
    fs, inside = open_fs(folder)
    fs.create_dir(inside, recursive=True)
    end = end_id.to_bytes(4, "little")

    def put(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        c, enc, shard, made = TaskContext.get(), encoder(path, kind, KEPT_PIECES), None, 0
        for b in batches:
            for key, text in zip(b["doc_id"].tolist(), b["text"]):
                if shard is None:
                    shard = _Shard(folder, f"shard-{c.partitionId():06d}-{made:04d}", c.taskAttemptId(), width)
                shard.add(None if pd.isna(key) else int(key), enc.encode(text) + end)
                if shard.full():
                    yield pd.DataFrame([shard.close()]).astype({"low": "Int64", "high": "Int64"})
                    shard, made = None, made + 1
        if shard is not None:
            yield pd.DataFrame([shard.close()]).astype({"low": "Int64", "high": "Int64"})

    keyed = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text", F.col("doc_id").cast("long").alias("k"), F.xxhash64("text").alias("h"))
    # Rows that share doc_id and text are alike, so any of them may come first; the salt lets a run of
    # them be cut.
    order = ["k", "h", F.xxhash64(F.monotonically_increasing_id())]
    dealt = keyed.repartitionByRange(partitions, *order) if partitions else keyed.repartitionByRange(*order)
    done = dealt.sortWithinPartitions("k", "h", "text").select("doc_id", "text").mapInPandas(
        put, "name string, docs long, ids long, nulls long, low long, high long"
    )
    manifest, start = [], 0
    for r in sorted((r.asDict() for r in done.collect()), key=lambda r: r["name"]):
        manifest.append(r | {"start": start})
        start += r["ids"]
    with fs.open_output_stream(f"{inside}/manifest.json") as f:
        f.write(json.dumps({"end_id": end_id, "shards": manifest}).encode())
    return manifest


def manifest_of(folder: str) -> list[dict]:
    fs, inside = open_fs(folder)
    with fs.open_input_stream(f"{inside}/manifest.json") as f:
        return json.loads(f.read())["shards"]


def _index(fs, base: str) -> Index:
    with fs.open_input_stream(base + ".idx") as f:
        return Index(f.read())


def read(spark, folder: str) -> DataFrame:
    """One row per document from the files alone: doc_id, start, n_tokens and ids_crc32. Where a
    document lies is looked up by its key in the shard's hash; the payload is read once, in order."""
    fields = "name string, start long"
    shards = spark.createDataFrame([(r["name"], r["start"]) for r in manifest_of(folder)], fields)

    def get(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, inside = open_fs(folder)
        for b in batches:
            for name, start in zip(b["name"], b["start"]):
                index, crc = _index(fs, f"{inside}/{name}"), []
                sizes, row = np.diff(index.starts), index.rows_of()
                with fs.open_input_stream(f"{inside}/{name}.ids", buffer_size=1 << 20) as f:
                    for n in sizes.tolist():
                        x = f.read(n * index.width)
                        crc.append(zlib.crc32(np.frombuffer(x, _dtype(index.width)).astype("<u4").tobytes()))
                known = np.arange(row.size) >= index.nulls
                yield pd.DataFrame({"doc_id": index.keys, "known": known, "start": start + index.starts[row], "n_tokens": sizes[row], "ids_crc32": np.array(crc, np.int64)[row]})

    n = max(1, min(shards.count(), int(spark.conf.get("spark.sql.shuffle.partitions"))))
    rows = shards.repartition(n).mapInPandas(get, "doc_id long, known boolean, start long, n_tokens long, ids_crc32 long")
    return rows.withColumn("doc_id", F.when(F.col("known"), F.col("doc_id"))).drop("known")


class Reader:
    """Keyed access to a folder of shards; a shard's files are opened when first needed."""

    def __init__(self, folder: str):
        self.fs, self.inside = open_fs(folder)
        self.shards = [r for r in manifest_of(folder) if r["high"] is not None]
        self.highs = [r["high"] for r in self.shards]
        self.open: dict[str, tuple[Lookup, object]] = {}

    def ids(self, key: int) -> np.ndarray | None:
        """The ids of the first document with this key, or None."""
        for r in self.shards[bisect_left(self.highs, key) :]:
            if r["low"] > key:
                return None
            if r["name"] not in self.open:
                base = f"{self.inside}/{r['name']}"
                self.open[r["name"]] = Lookup(self.fs.open_input_file(base + ".idx")), self.fs.open_input_file(base + ".ids")
            index, payload = self.open[r["name"]]
            place = index.place(key)
            if place is not None:
                a, b = (x * index.width for x in place)
                return np.frombuffer(payload.read_at(b - a, a), _dtype(index.width)).astype("<u4")
        return None


def byte_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op4_token_files(spark, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "token-ids")
    write(spark.read.parquet(f"{sf_dir}/documents.parquet"), folder, byte_vocabulary())
    return read(spark, folder)
