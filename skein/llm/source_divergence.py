"""Source divergence audit: how far sources of one language are apart, and by which terms.

Terms of a language are dealt to blocks by hash. A block's counts are a dense group-by-term tile of
64-bit integers, smoothed to exact shares, and broadcasting compares all pairs of groups in it. The
pair matrices of blocks are summed, and each block's best terms per group merged. Groups are dealt to
tiles as well, so a task holds at most two tiles of groups by one block of terms, however many
sources or terms there are.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from skein.llm.common import ASCII_LOWER, ASCII_UPPER, scratch_path, skew_join

#: Documents of a language that a kept term occurs in, at least.
LEAST_DOCS = 3
#: Shares are counted in parts of this. Sums of counts may reach 9e15: shares are divided out in
#: three steps of 1000, so that nothing outgrows 63 bits.
PARTS = 10**9
TOP_TERMS = 200
#: Terms in a block and groups in a tile, about.
BLOCK_TERMS, TILE_GROUPS = 8192, 128
#: Different terms that a counting task remembers before it hands its counts on.
HELD_TERMS = 500_000
#: Numbers in one broadcast comparison.
CELLS = 1 << 21

#: Bytes that belong to no term become spaces, A-Z lower-case letters.
_FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _terms(text: bytes) -> list[bytes]:
    """Runs of non-ASCII characters and ASCII letters: no byte of a longer UTF-8 character is ASCII, so
    bytes can be told apart one by one."""
    return text.translate(_FOLD).split()


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def emptied() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in counts.items():
            terms = list(n)
            for i in range(0, len(terms), 50_000):
                part = terms[i : i + 50_000]
                yield pa.RecordBatch.from_arrays([
                    pa.array([lang] * len(part), pa.string()), pa.array([source] * len(part), pa.string()), pa.array(part, pa.binary()).cast(pa.string()),
                    pa.array([n[t] for t in part], pa.int64()), pa.array([docs[t] for t in part], pa.int64()),
                ], names=["lang", "source", "term", "n", "docs"])
        counts.clear()

    held = 0
    for batch in batches:
        for lang, source, text in zip(*(batch.column(i) for i in range(3))):
            n, docs = counts.setdefault((lang.as_py(), source.as_py()), (Counter(), Counter()))
            held -= len(n)
            found = _terms(text.as_py())
            n.update(found)
            docs.update(set(found))
            held += len(n)
            if held > HELD_TERMS:
                yield from emptied()
                held = 0
    yield from emptied()


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences), docs (documents that hold it), of whole texts; each task
    sums up what it reads."""
    said = lambda c: F.coalesce(c, F.lit(""))
    rows = docs.select(said("lang").alias("lang"), said("source").alias("source"), said("text").cast("binary").alias("text"))
    found = rows.mapInArrow(_counted, "lang string, source string, term string, n long, docs long")
    # One shuffle by language and term serves the sums of groups and those of languages.
    return found.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def kept_terms(docs: DataFrame) -> DataFrame:
    """lang, source, term, n, lang_n (occurrences in the language), and first: whether this is the one
    row that stands for the term in its language. Terms in fewer than LEAST_DOCS documents of their
    language are left out."""
    own = Window.partitionBy("lang", "term")
    counted = term_counts(docs).select("*", F.sum("docs").over(own).alias("lang_docs"), F.sum("n").over(own).alias("lang_n"), F.min("source").over(own).alias("least"))
    kept = counted.where(F.col("lang_docs") >= LEAST_DOCS)
    return _stored(kept.select("lang", "source", "term", "n", "lang_n", (F.col("least") == F.col("source")).alias("first")), "divergence-terms")


def groups(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """Every occurring lang and source with total (occurrences of kept terms), rows (of kept terms),
    and of the language kept (terms), lang_total, tiles and blocks."""
    said = lambda c: F.coalesce(c, F.lit("")).alias(c)
    zero = F.lit(0).cast("long")
    there = docs.select(said("lang"), said("source")).distinct().select("lang", "source", zero.alias("n"), zero.alias("k"), zero.alias("r"))
    found = there.union(kept.groupBy("lang", "source").agg(F.sum("n"), F.count_if("first"), F.count("*")))
    found = _stored(found.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.sum("k").alias("firsts"), F.sum("r").alias("rows")), "divergence-groups")
    parts = lambda n, size: F.greatest(F.ceil(n / F.lit(size)), F.lit(1)).cast("int")
    langs = found.groupBy("lang").agg(F.sum("firsts").alias("kept"), F.sum("total").alias("lang_total"), F.count("*").alias("n"))
    langs = langs.select("lang", "kept", "lang_total", parts(F.col("n"), TILE_GROUPS).alias("tiles"), parts(F.col("kept"), BLOCK_TERMS).alias("blocks"))
    return found.drop("firsts").join(langs, "lang")


def shares(counts: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """1 + floor(PARTS * (counts + 1) / totals), exactly."""
    whole, rest = np.divmod(counts + 1, totals)
    for _ in range(3):
        more, rest = np.divmod(rest * 1000, totals)
        whole = whole * 1000 + more
    return whole + 1


def gaps(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)^2 / q), which is below 1.1e18."""
    d = p - q
    return d * d // q


def pair_matrix(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Sums over all terms of gaps() of every row of p with every row of q."""
    out = np.zeros((len(p), len(q)), np.int64)
    step = max(1, CELLS // max(1, out.size))
    for at in range(0, p.shape[1], step):
        out += gaps(p[:, None, at : at + step], q[None, :, at : at + step]).sum(2)
    return out


_TILE = "lang string, source string, part string, item string, value long, seen long, unseen long, kept long"


def _tile(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """One block of terms of two tiles of groups (or one with itself): a row per ordered pair, with
    seen (terms here) and unseen (the gap of a term that neither has), and the best terms of groups."""
    lang, _, a, b = key
    heads = rows[rows["term"].isna()].sort_values("source")
    cells = rows[rows["term"].notna()]
    codes, terms = pd.factorize(cells["term"], sort=True)
    counts = np.zeros((len(heads), len(terms)), np.int64)
    counts[pd.Index(heads["source"]).get_indexer(cells["source"]), codes] = cells["n"].to_numpy()
    totals = (heads["total"] + heads["kept"]).to_numpy(np.int64)[:, None]
    tile, source = heads["tile"].to_numpy(), heads["source"].to_numpy(object)
    # Without kept terms there is nothing to share.
    p, none = shares(counts, np.maximum(totals, 1)), shares(np.zeros_like(totals), np.maximum(totals, 1))[:, 0]
    out = []
    for left, right in {(a, b), (b, a)}:
        i, j = np.flatnonzero(tile == left), np.flatnonzero(tile == right)
        x, y = (m.ravel() for m in np.meshgrid(i, j, indexing="ij"))
        values, apart = pair_matrix(p[i], p[j]).ravel(), x != y
        x, y = x[apart], y[apart]
        out.append(pd.DataFrame({"source": source[x], "part": "pair", "item": source[y], "value": values[apart], "seen": len(terms), "unseen": gaps(none[x], none[y])}))
    if a == b and len(terms):
        lang_n = np.zeros(len(terms), np.int64)
        lang_n[codes] = cells["lang_n"].to_numpy()
        q = shares(lang_n, np.int64(heads["lang_total"].iloc[0] + heads["kept"].iloc[0]))
        for g in range(len(heads)):
            more = np.flatnonzero((counts[g] > 0) & (p[g] > q))
            value = gaps(p[g, more], q[more])
            best = np.lexsort((more, -value))[:TOP_TERMS]
            out.append(pd.DataFrame({"source": source[g], "part": "term", "item": terms[more[best]], "value": value[best], "seen": 0, "unseen": 0}))
    return pd.concat(out).assign(lang=lang, kept=heads["kept"].iloc[0])[["lang", "source", "part", "item", "value", "seen", "unseen", "kept"]]


def _tiles(kept: DataFrame, found: DataFrame) -> DataFrame:
    """Counts, and the totals of groups as heads, dealt to blocks of terms and pairs of tiles."""
    tile, other = F.expr("pmod(xxhash64(source), tiles)").cast("int"), F.explode(F.expr("sequence(0, tiles - 1)"))
    own = ["lang", "source", "total", "kept", "lang_total"]
    counts = skew_join(kept.drop("first"), found, ["lang", "source"], counts=found.select("lang", "source", F.col("rows").alias("n")))
    counts = counts.select(*own, "term", "n", "lang_n", F.expr("pmod(xxhash64(term), blocks)").cast("int").alias("block"), tile.alias("tile"), other.alias("other"))
    heads = found.select(*own, F.lit(None).cast("string").alias("term"), F.lit(None).cast("long").alias("n"), F.lit(None).cast("long").alias("lang_n"), F.explode(F.expr("sequence(0, blocks - 1)")).alias("block"), "tiles")
    heads = heads.select(*own, "term", "n", "lang_n", "block", tile.alias("tile"), other.alias("other"))
    both = counts.union(heads).withColumns({"a": F.least("tile", "other"), "b": F.greatest("tile", "other")})
    return both.groupBy("lang", "block", "a", "b").applyInPandas(_tile, _TILE)


def audit(docs: DataFrame) -> DataFrame:
    """lang, source, part, item, value, rank: every other source of the language by the distance of its
    term shares, and the group's TOP_TERMS terms above the language's share.

    Defined results: null text, lang and source are empty ones; repeated rows count again; a group
    without kept terms is compared by smoothed shares alone, and by 0 where its language has none; equal
    values rank by item; an empty table gives no rows; other columns are ignored.
    """
    kept = kept_terms(docs)
    found = _stored(groups(docs, kept), "divergence-totals")
    parts = _stored(_tiles(kept, found), "divergence-tiles")
    pairs = parts.where("part = 'pair'").groupBy("lang", "source", "part", "item").agg(
        (F.sum("value") + F.max("unseen") * (F.max("kept") - F.sum("seen"))).alias("value")
    )
    ranked = lambda df: df.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")))
    terms = ranked(parts.where("part = 'term'").select("lang", "source", "part", "item", "value")).where(F.col("rank") <= TOP_TERMS)
    return ranked(pairs).union(terms)


def op12_source_divergence(spark, sf_dir: str) -> DataFrame:
    return audit(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP12_SQL = rf"""WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  regexp_extract_all(translate(coalesce(text, ''), '{ASCII_UPPER}', '{ASCII_LOWER}'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
t AS (SELECT r, lang, source, unnest(ts) AS term FROM d),
k AS (SELECT lang, term FROM (SELECT DISTINCT r, lang, term FROM t) GROUP BY 1, 2 HAVING count(*) >= {LEAST_DOCS}),
c AS (SELECT lang, source, term, count(*) AS n FROM t JOIN k USING (lang, term) GROUP BY ALL),
v AS (SELECT lang, count(*) AS v FROM k GROUP BY 1),
g AS (SELECT lang, source, coalesce(sum(n), 0)::HUGEINT AS n FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN c USING (lang, source) GROUP BY ALL),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + ({PARTS}::HUGEINT * (coalesce(c.n, 0) + 1)) // (g.n + v.v) AS p
  FROM g JOIN k USING (lang) JOIN v USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
q AS (SELECT lang, term, 1 + ({PARTS}::HUGEINT * (sum(c.n) + 1)) // (any_value(t.n) + any_value(v)) AS q FROM c JOIN v USING (lang) JOIN (SELECT lang, sum(n)::HUGEINT AS n FROM g GROUP BY 1) t USING (lang) GROUP BY ALL),
s AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
u AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL SELECT lang, source, 'term', term, ((p - q) * (p - q) // q)::BIGINT FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q)
SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INT) AS rank FROM u QUALIFY part = 'pair' OR rank <= {TOP_TERMS}"""
