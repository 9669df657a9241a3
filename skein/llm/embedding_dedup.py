"""Near-duplicate embeddings by a subspace pigeonhole join.

Unit vectors at cosine c or more are at squared distance 2 - 2c or less. Rotated and split into blocks
of dimensions, two such vectors are, in at least one block, within that block's share of the squared
distance. So every block is range-joined under its share, and the union of what these joins find is
verified by cosine in double precision; no pair is missed. A pair counts only in the first block that
finds it.

The range join of a block goes by cells: each coordinate of the block is cut in two, so a cell is a
word of bits. Two vectors in different cells differ in the bits of some coordinates, and their
distances to the cuts of these, squared and summed, cannot both exceed half the block's budget. So a
vector visits the cells that it can reach for half the budget, the cheaper of two visits the other's
cell (or, at equal costs, the one that comes first), and each pair is compared once.

How far that prunes depends on the vectors. Where they fall into groups, a vector reaches few cells.
Where they fill all directions evenly and are few (below some ten millions), cells fine enough to part
them are narrower than the budget, and a vector reaches most of those that are not empty; comparing a
block's coordinates by matrix products is then cheaper than visits. A task estimates both from a
sample of its own rows and takes the cheaper way; both give the same pairs.

A task holds two chunks of vectors and all blocks; every pair of chunks is one task. Where a sample
says that cells in reach are fewer than chunks, the first bits of the cells deal the vectors out
instead, block by block. Equal vectors are one class with a count from the start. Tasks give back
sums of links and a spanning forest of them, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from skein.llm.common import components, skew_join, written

MIN_COSINE = 0.9
BLOCK_DIMS = 32
#: Bits of a cell at most.
CELL_BITS = 30
#: Vectors of a chunk, at most and at least, and chunks that are made of fewer for the sake of cores.
CHUNK = 98_304
#: Bytes of a chunk's vectors as 64-bit numbers, of which a task holds a few copies; longer vectors make
#: chunks of fewer.
CHUNK_BYTES = CHUNK * 64 * 8
SMALL_CHUNK = 8192
CHUNKS_FOR_CORES = 3
#: Cells that a vector may visit on average in memory; where it would be more, cells get fewer bits.
VISITS = 48
#: Measured nanoseconds of a visit, of a pair met in a cell, and of a pair in a matrix product.
VISIT_NS, MET_NS, PRODUCT_NS = 60, 90, 4
#: Rows of the samples that say which way is cheaper.
SAMPLE = 512
#: Rotated coordinates are 32-bit floats; budgets allow for their rounding.
SLACK = 1e-4
#: Costs are whole numbers, in units of the budget's share of a pair, so that their sums are exact.
_UNIT = 1 << 19
_PAIRS = 1 << 17
_TILE = (512, 4096)


def rotated(unit: np.ndarray) -> np.ndarray:
    """Unit vectors (rows) after three rounds of random signs and a Hadamard transform, padded with
    zeros to a power of two. Additions only, in a fixed order, so that every task gets the same bits."""
    size = 1 << max(0, (unit.shape[1] - 1).bit_length())
    x = np.zeros((len(unit), size))
    x[:, : unit.shape[1]] = unit
    signs = np.random.default_rng(size).choice([-1.0, 1.0], (3, size))
    for s in signs:
        x *= s
        h = 1
        while h < size:
            y = x.reshape(len(x), size // (2 * h), 2, h)
            x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(len(x), size)
            h *= 2
        x /= np.sqrt(size)
    return x.astype(np.float32)


def blocks(size: int) -> list[tuple[int, int]]:
    """(first, one past the last) dimension of each block."""
    return [(a, min(a + BLOCK_DIMS, size)) for a in range(0, size, BLOCK_DIMS)]


def budget(size: int, block: tuple[int, int], min_cosine: float) -> float:
    return max((2 - 2 * min_cosine) * (block[1] - block[0]) / size * (1 + SLACK), 1e-9)


def usable(v):
    """Vectors that can be compared: not null or empty, all components finite, not all zero."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return F.coalesce((F.size(v) > 0) & ~F.exists(v, bad) & F.exists(v, lambda x: x != 0), F.lit(False))


def units(raw: np.ndarray) -> np.ndarray:
    """Rows at length 1, scaled first, so that no square overflows or vanishes."""
    raw = raw.astype(np.float64)
    out = raw / np.abs(raw).max(axis=1, keepdims=True)
    return out / np.sqrt((out * out).sum(axis=1, keepdims=True))


def costs(x: np.ndarray, cut: np.ndarray, limit: float) -> tuple[np.ndarray, np.ndarray]:
    """(bits, cost of leaving each coordinate's side): a pair's costs are within the budget if the
    smaller one is at most _UNIT."""
    away = x.astype(np.float64) - cut
    cost = np.minimum(np.floor(away * away * (2 * _UNIT / limit)), 1 << 29).astype(np.int32)
    return away > 0, cost


def visits(key: np.ndarray, cost: np.ndarray, bits: int, most: float = np.inf) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(row, cell, cost) of all cells in reach of rows with these home cells, home first among them,
    and the bits used: fewer than asked for where the cells would be more than most on average."""
    row, cell, spent = np.arange(key.size, dtype=np.int32), key & ((1 << bits) - 1), np.zeros(key.size, np.int32)
    for j in range(bits):
        price = spent + cost[row, j]
        go = price <= _UNIT
        row, cell, spent = np.r_[row, row[go]], np.r_[cell, cell[go] ^ (1 << j)], np.r_[spent, price[go]]
        if row.size > most * key.size:
            return row, cell & ((2 << j) - 1), spent, j + 1
    return row, cell, spent, bits


def _word(sides: np.ndarray) -> np.ndarray:
    sides = sides[:, :CELL_BITS]
    return (sides.astype(np.int64) << np.arange(sides.shape[1])).sum(axis=1).astype(np.int32)


class _Forest:
    def __init__(self, n: int):
        self.root = np.arange(n)
        self.edges: list[tuple[int, int]] = []

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        """Links a-b. Each round joins every tree to one other, so the rest soon falls together."""
        while True:
            ra, rb = self.root[a], self.root[b]
            open_ = ra != rb
            if not open_.any():
                return
            a, b, ra, rb = a[open_], b[open_], ra[open_], rb[open_]
            to = {}
            _, first = np.unique(ra, return_index=True)
            for i in first:
                x, y = ra[i], rb[i]
                while x in to:
                    x = to[x]
                while y in to:
                    y = to[y]
                if x != y:
                    to[max(x, y)] = min(x, y)
                    self.edges.append((a[i], b[i]))
            for x in sorted(to):
                y = to[x]
                while y in to:
                    y = to[y]
                to[x] = y
            table = np.arange(self.root.size)
            table[list(to)] = list(to.values())
            self.root = table[self.root]


class Group:
    """The vectors of one task. links: for each, how many it is linked with here; forest: a spanning
    forest of these links; compared: how many pairs were compared in a block."""

    def __init__(self, raw: np.ndarray, n: np.ndarray, cid: np.ndarray, min_cosine: float):
        self.unit, self.n, self.cid, self.min_cosine = units(raw), n, cid, min_cosine
        self.rot = rotated(self.unit)
        self.parts = blocks(self.rot.shape[1])
        self.limits = [budget(self.rot.shape[1], p, min_cosine) for p in self.parts]
        self.links, self.forest, self.compared = np.zeros(len(raw), np.int64), _Forest(len(raw)), 0
        #: Tests take the way of cells whatever it costs.
        self.by_cells = False
        #: Of rows that came to this task's cell from their own: bits crossed and their cost.
        self.crossed: np.ndarray | None = None
        self.spent: np.ndarray | None = None

    def near(self, p: np.ndarray, q: np.ndarray, b: int) -> np.ndarray:
        a, z = self.parts[b]
        x = self.rot[p, a:z].astype(np.float64) - self.rot[q, a:z]
        return (x * x).sum(axis=1) <= self.limits[b]

    def search(self, b: int, one: np.ndarray, other: np.ndarray | None = None) -> None:
        """Links between rows one, or between them and rows other, that block b is the first to find."""
        every = one if other is None else np.r_[one, other]
        if one.size == 0 or every.size < 2 or other is not None and other.size == 0:
            return
        a, z = self.parts[b]
        x = self.rot[every, a:z]
        cut = np.median(x, axis=0).astype(np.float64)
        # Coordinates that spread most come first, as the last ones may go unused.
        order = np.argsort(-x.var(axis=0), kind="stable")
        sides, cost = costs(x[:, order], cut[order], self.limits[b])
        key = _word(sides)
        bits = min(z - a, CELL_BITS, max(1, ceil(log2(every.size)) + 2))
        mine = slice(0, one.size)
        theirs = mine if other is None else slice(one.size, every.size)
        some = np.linspace(0, every.size - 1, min(SAMPLE, every.size)).astype(int)
        _, cell, _, bits = visits(key[some], cost[some], bits, VISITS)
        sizes = np.bincount(key & ((1 << bits) - 1), minlength=1 << bits)
        way = every.size / some.size * (cell.size * VISIT_NS + sizes[cell].sum() * MET_NS)
        if not self.by_cells and way > PRODUCT_NS * one.size * (one.size / 2 if other is None else other.size):
            self._products(b, one, one if other is None else other, other is None)
            return
        while True:
            first = visits(key[mine], cost[mine], bits, 2 * VISITS)
            second = first if other is None else visits(key[theirs], cost[theirs], first[3], 2 * VISITS)
            bits = second[3]
            if second[3] == first[3]:
                break
        key &= (1 << bits) - 1
        self._compare(b, every, key, cost, bits, first[:3], 0, theirs, other is None, True)
        if other is not None:
            self._compare(b, every, key, cost, bits, second[:3], one.size, mine, False, False)

    def _products(self, b: int, one: np.ndarray, other: np.ndarray, same: bool) -> None:
        a, z = self.parts[b]
        side = lambda rows: self.rot[rows, a:z]
        half = lambda x: (x * x).sum(axis=1, keepdims=True) / 2
        x, y = side(one), side(other)
        # The product of these is minus half the squared distance.
        left = np.hstack([x, -half(x), np.ones((len(x), 1), np.float32)])
        right = np.ascontiguousarray(np.hstack([y, np.ones((len(y), 1), np.float32), -half(y)]).T)
        least = np.float32(-(self.limits[b] * (1 + 1e-3) + 1e-5) / 2)
        for r in range(0, len(x), _TILE[0]):
            for c in range(r if same else 0, len(y), _TILE[1]):
                tile = left[r : r + _TILE[0]] @ right[:, c : c + _TILE[1]]
                self.compared += tile.size
                p, q = np.divmod(np.flatnonzero(tile >= least), tile.shape[1])
                p, q = p + r, q + c
                if same:
                    p, q = p[p < q], q[p < q]
                for s in range(0, p.size, _PAIRS):
                    i, j = one[p[s : s + _PAIRS]], other[q[s : s + _PAIRS]]
                    ok = self.near(i, j, b)
                    self._count(b, i[ok], j[ok])

    def _compare(self, b, every, key, cost, bits, visit, shift, homes, same, at_home) -> None:
        """Visitors (row + shift, cell, cost) with those at home in the cells."""
        row, cell, spent = visit
        if not at_home:
            away = cell != key[row + shift]
            row, cell, spent = row[away], cell[away], spent[away]
        base = homes.start
        home = np.argsort(key[homes], kind="stable") + base
        sizes = np.bincount(key[homes], minlength=1 << bits)
        starts = np.cumsum(np.r_[0, sizes])
        row = row + shift
        met = sizes[cell]
        some = met > 0
        row, cell, spent, met = row[some], cell[some], spent[some], met[some]
        ends = np.cumsum(met)
        self.compared += int(ends[-1]) if ends.size else 0
        at = 0
        while at < row.size:
            # As many visitors as make so many pairs, one at least.
            stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + _PAIRS, "right")))
            n = met[at:stop]
            v = np.repeat(np.arange(at, stop), n)
            inside = np.arange(v.size) - np.repeat(np.cumsum(n) - n, n)
            for s in range(0, v.size, _PAIRS):
                w = v[s : s + _PAIRS]
                self._check(b, every, key, cost, bits, row[w], home[starts[cell[w]] + inside[s : s + _PAIRS]], cell[w], spent[w], same)
            at = stop

    def _check(self, b, every, key, cost, bits, i, j, cell, spent, same) -> None:
        """Of pairs of visitors i and those at home j, rows of every: links that count here."""
        p, q = every[i], every[j]
        ok = self.near(p, q, b)
        if same:
            ok &= i != j
        i, j, cell, spent = i[ok], j[ok], cell[ok], spent[ok]
        if not i.size:
            return
        crossed = key[i] ^ cell
        back = ((crossed[:, None] >> np.arange(bits) & 1) * cost[j, :bits].astype(np.int64)).sum(axis=1)
        # Both may visit; at home, in a search of rows among themselves, both ways are met.
        ok = (spent < back) | (spent == back) & ((i < j) | (crossed == 0) & (not same))
        self._count(b, every[i[ok]], every[j[ok]])

    def _count(self, b: int, p: np.ndarray, q: np.ndarray) -> None:
        """Of pairs near in block b: those that it is the first to find and that are linked."""
        for e in range(b):
            fresh = ~self.near(p, q, e)
            p, q = p[fresh], q[fresh]
        linked = (self.unit[p] * self.unit[q]).sum(axis=1) >= self.min_cosine
        p, q = p[linked], q[linked]
        if self.crossed is not None:
            ok = self._counts_here(p, q)
            p, q = p[ok], q[ok]
        np.add.at(self.links, p, self.n[q])
        np.add.at(self.links, q, self.n[p])
        self.forest.add(p, q)

    def _counts_here(self, p: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Where cells deal vectors out: of two that visit each other's cells the cheaper one counts."""
        v, h = np.where(self.crossed[p] != 0, p, q), np.where(self.crossed[p] != 0, q, p)
        s = self.crossed[v]
        back = ((s[:, None] >> np.arange(self.cell_cost.shape[1]) & 1) * self.cell_cost[h].astype(np.int64)).sum(axis=1)
        return (s == 0) | (self.spent[v] < back) | (self.spent[v] == back) & (self.cid[v] < self.cid[h])


def _floats(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _cells(min_cosine: float, bits: int):
    """Each vector in its own cell and those it visits, of each block: dims, block, cell, crossed, spent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("dims").to_numpy(zero_copy_only=False)
            for dims in np.unique(sizes):
                mine = batch.filter(pa.array(sizes == dims))
                rot = rotated(units(_floats(mine.column("embedding"), int(dims))))
                for b, (a, z) in enumerate(blocks(rot.shape[1])):
                    sides, cost = costs(rot[:, a:z], np.zeros(z - a), budget(rot.shape[1], (a, z), min_cosine))
                    used = min(bits, z - a)
                    key = _word(sides) & ((1 << used) - 1)
                    row, cell, spent, _ = visits(key, cost, used)
                    for s in range(0, row.size, 4096):
                        r = row[s : s + 4096]
                        out = mine.take(pa.array(r))
                        yield pa.RecordBatch.from_arrays(
                            [out.column("dims"), pa.array(np.full(r.size, b, np.int32)), pa.array(cell[s : s + 4096].astype(np.int32)), pa.array((key[r] ^ cell[s : s + 4096]).astype(np.int32)),
                             pa.array(spent[s : s + 4096]), out.column("cid"), out.column("n"), out.column("embedding")],
                            names=["dims", "block", "cell", "crossed", "spent", "cid", "n", "embedding"],
                        )

    return run


_KEY = ["dims", "block", "cell", "i", "j"]


def searched(table: pa.Table, min_cosine: float, bits: int) -> Group:
    """The links of one task's vectors; block -1 stands for all blocks, without cells."""
    first = {k: table.column(k)[0].as_py() for k in _KEY}
    numbers = lambda c: table.column(c).to_numpy()
    raw = _floats(table.column("embedding").combine_chunks(), first["dims"])
    g = Group(raw, numbers("n"), numbers("cid"), min_cosine)
    part = numbers("m")
    if first["block"] < 0:
        homes, visitors, wanted = np.ones(len(raw), bool), np.zeros(len(raw), bool), range(len(g.parts))
    else:
        g.crossed, g.spent = numbers("crossed"), numbers("spent")
        a, z = g.parts[first["block"]]
        g.cell_cost = costs(g.rot[:, a:z], np.zeros(z - a), g.limits[first["block"]])[1][:, : min(bits, z - a)]
        homes, wanted = g.crossed == 0, [first["block"]]
        visitors = ~homes
    of = lambda kind, c: np.flatnonzero(kind & (part == c))
    i, j = first["i"], first["j"]
    for b in wanted:
        if i == j:
            g.search(b, of(homes, i))
            g.search(b, of(homes, i), of(visitors, i))
        else:
            g.search(b, of(homes, i), np.r_[of(homes, j), of(visitors, j)])
            g.search(b, of(homes, j), of(visitors, i))
    return g


def _search(min_cosine: float, bits: int):
    """Reads rows sorted by group. What is carried from batch to batch is one group, two chunks."""

    def out(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = searched(pa.Table.from_batches(parts), min_cosine, bits)
        some = g.links > 0
        edges = np.array([(g.cid[a], g.cid[b]) for a, b in g.forest.edges], np.int64).reshape(-1, 2)
        none = np.zeros(int(some.sum()), bool)
        a, b = np.r_[g.cid[some], edges[:, 0]], pa.array(np.r_[g.cid[some], edges[:, 1]], mask=np.r_[~none, np.zeros(len(edges), bool)])
        yield pa.RecordBatch.from_arrays([pa.array(a), b, pa.array(np.r_[g.links[some], np.zeros(len(edges), np.int64)])], names=["a", "b", "w"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            k = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in _KEY], axis=1)
            starts = [0, *(np.flatnonzero((k[1:] != k[:-1]).any(axis=1)) + 1).tolist(), len(k)]
            for s, e in zip(starts, starts[1:]):
                if rest and tuple(k[s]) != last:
                    yield from out(rest)
                    rest = []
                rest.append(batch.slice(s, e - s))
                last = tuple(k[s])
        if rest:
            yield from out(rest)

    return run


def reach(classes: DataFrame, bits: int, min_cosine: float) -> float:
    """Rows that a vector becomes if cells of so many bits deal vectors out: cells in reach, over all
    blocks, on average of a sample of the longest vectors."""
    dims = classes.select(F.max(F.size("embedding"))).first()[0]
    some = classes.where(F.size("embedding") == dims).select("embedding").orderBy(F.xxhash64("cid")).limit(SAMPLE).toPandas()["embedding"]
    rot = rotated(units(np.stack(some.to_numpy())))
    total = 0
    for a, z in blocks(rot.shape[1]):
        sides, cost = costs(rot[:, a:z], np.zeros(z - a), budget(rot.shape[1], (a, z), min_cosine))
        total += visits(_word(sides), cost, min(bits, z - a))[0].size
    return total / len(rot)


def links(classes: DataFrame, n: int, min_cosine: float = MIN_COSINE, chunk: int = CHUNK, cell_bits: int | None = None) -> DataFrame:
    """Of n classes (cid, embedding, n): rows (a, null, w), a class and links of it found in one task,
    which add up to all its links to other classes; and rows (a, b, 0), a spanning forest. cell_bits:
    bits of the cells that deal vectors out, 0 for none; by default what moves fewer rows."""
    rows = classes.select(F.size("embedding").alias("dims"), "cid", "n", "embedding")
    widest = classes.agg(F.max(F.size("embedding"))).first()[0] or 1
    chunk = max(1, min(chunk, CHUNK_BYTES // (8 * widest)))
    chunks = max(min(CHUNKS_FOR_CORES, ceil(n / SMALL_CHUNK)), ceil(n / chunk), 1)
    bits = cell_bits or 0
    if cell_bits is None and chunks > CHUNKS_FOR_CORES:
        fine = min(CELL_BITS, ceil(log2(chunks)) + 4)
        bits = fine if reach(classes, fine, min_cosine) < chunks else 0
    cell = ["dims", "block", "cell"]
    if not bits:
        none = F.lit(0)
        rows = rows.select("dims", F.lit(-1).alias("block"), none.alias("cell"), none.alias("crossed"), none.alias("spent"), "cid", "n", "embedding", F.lit(chunks).alias("k"))
    else:
        kind = rows.schema["embedding"].dataType.simpleString()
        rows = rows.mapInArrow(_cells(min_cosine, bits), f"dims int, block int, cell int, crossed int, spent int, cid long, n long, embedding {kind}")
        rows = written(rows, "embedding-cells")
        size = rows.groupBy(*cell).agg(F.count("*").alias("size"), F.min("crossed").alias("home")).where("home = 0 and size > 1")
        rows = skew_join(rows, size.select(*cell, F.ceil(F.col("size") / chunk).cast("int").alias("k")), cell)
    dealt = rows.withColumn("m", F.pmod(F.xxhash64("cid"), F.col("k").cast("long")).cast("int"))
    dealt = dealt.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
    dealt = dealt.select(*cell, F.least("m", "o").alias("i"), F.greatest("m", "o").alias("j"), "m", "crossed", "spent", "cid", "n", "embedding")
    dealt = dealt.repartition(*_KEY).sortWithinPartitions(*_KEY)
    return dealt.mapInArrow(_search(min_cosine, bits), "a long, b long, w long")


def near_duplicates(vectors: DataFrame, min_cosine: float = MIN_COSINE, chunk: int = CHUNK, cell_bits: int | None = None) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id and kept.

    Defined results: vectors that are null, empty, zero or hold a null or non-finite component link
    with nothing and are their own component; so do vectors of different lengths with each other.
    Repeated rows link like any other; a null vec_id stays null and is no component's name unless
    the whole component has none, and is not kept. An empty table gives no rows.

    Rows find their class by 128 bits of hashes of the vector, so vectors themselves move only to be
    grouped and searched.
    """
    kind = vectors.schema["embedding"].dataType.elementType
    # Adding 0 turns -0.0 into 0.0, so that equal vectors have equal hashes.
    plain = F.transform("embedding", lambda x: x + F.lit(0).cast(kind))
    mine = vectors.select("vec_id", plain.alias("embedding"))
    ok = mine.where(usable(F.col("embedding")))
    h = [F.xxhash64("embedding").alias("h1"), F.xxhash64(F.lit(1), "embedding").alias("h2")]
    grouped = ok.groupBy("embedding").agg(F.count("*").alias("n"), F.min("vec_id").alias("low"))
    classes = written(grouped.select("embedding", "n", "low", *h, F.monotonically_increasing_id().alias("cid")), "embedding-classes")
    found = written(links(classes, classes.count(), min_cosine, chunk, cell_bits), "embedding-links")
    sums = found.where("b is null").groupBy(F.col("a").alias("cid")).agg(F.sum("w").alias("w"))
    roots = components(found.where("b is not null").select("a", "b").distinct()).withColumnsRenamed({"node": "cid"})
    rooted = classes.drop("embedding").join(roots, "cid", "left").join(sums, "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    rooted = written(rooted, "embedding-rooted")
    named = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    judged = skew_join(rooted, named, ["root"]).select("h1", "h2", (F.col("n") - 1 + F.coalesce("w", F.lit(0))).cast("long").alias("n_links"), "component_id")
    out = skew_join(ok.select("vec_id", *h), judged, ["h1", "h2"]).select("vec_id", "n_links", "component_id")
    others = mine.where(~usable(F.col("embedding"))).select("vec_id", F.lit(0).cast("long"), "vec_id")
    return out.union(others).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def op8_embedding_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
