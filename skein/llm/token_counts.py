"""Token counts as delta-maintained rollups.

Totals by source, language and tokenizer version are sums, so a change of documents is a change of
totals: an inserted document adds its count, a deleted one takes it off, and a revised one does both.
A batch of such signed counts is summed per group before it is shuffled, then added to the last
totals. A store keeps one folder per version of the totals and one small commit file per version;
readers use the newest version that has a commit. A batch has an id. Its marker, written before the
commit, names the version it aims at, and it counts as applied if that version's commit names the
batch in turn. So applying a batch again changes nothing, a batch that was cut off before its commit
is as if it had never begun, and neither needs more than two small files, however long the history.

Defined results: a null or empty text has no tokens but is a document; null sources and languages are
groups of their own; repeated rows count as often as they occur; an empty batch is committed and
changes nothing; an empty store has no groups; columns beyond those named are ignored. Of two writers
that aim at one version the later one gets an error and changes nothing; it may apply its batch again.
"""

from __future__ import annotations

import hashlib
import json

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from skein.llm.common import scratch_path, skew_join, written

KEYS = ["source", "lang", "tokenizer"]
SUMS = ["n_docs", "n_tokens"]


def words(text: Column) -> Column:
    """Tokens of the version `words-1`: runs of characters that are not ASCII white space."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def words_and_marks(text: Column) -> Column:
    """Tokens of the version `words-2`: runs of letters, digits and characters beyond ASCII, and each
    other printed ASCII character by itself."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[0-9A-Za-z\x80-\x{10FFFF}]+|[!-/:-@\[-`{-~]")), F.lit(0)).cast("long")


def counted(docs: DataFrame, tokenizer: str, count: Column) -> DataFrame:
    """doc_id, source, lang, tokenizer, n_tokens."""
    return docs.select("doc_id", "source", "lang", F.lit(tokenizer).alias("tokenizer"), count.alias("n_tokens"))


def inserts(counts: DataFrame) -> DataFrame:
    return counts.select(*KEYS, F.lit(1).cast("long").alias("n_docs"), "n_tokens")


def deletes(counts: DataFrame) -> DataFrame:
    return counts.select(*KEYS, F.lit(-1).cast("long").alias("n_docs"), (-F.col("n_tokens")).alias("n_tokens"))


def changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """Signed counts that lead from one set of counted documents to another. Documents are matched by
    doc_id and tokenizer; rows that are the same on both sides, as often as they are, give none."""
    key = ["doc_id", *KEYS, "n_tokens"]
    both = old.select(*key, F.lit(-1).alias("sign")).union(new.select(*key, F.lit(1).alias("sign")))
    net = both.groupBy(*key).agg(F.sum("sign").alias("sign")).where("sign <> 0")
    return net.select(*KEYS, F.col("sign").cast("long").alias("n_docs"), (F.col("n_tokens") * F.col("sign")).alias("n_tokens"))


def totals(signed: DataFrame) -> DataFrame:
    """Sums by group. Spark sums each task's rows first, so a hot group is a row per task."""
    return signed.groupBy(*KEYS).agg(*(F.sum(c).alias(c) for c in SUMS))


class Rollup:
    """A folder of totals on any file system that Spark writes to."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.fs = self._path("x").getFileSystem(conf)
        self.context = self.hadoop.FileContext.getFileContext(self._path("x").toUri(), conf)

    def _path(self, name: str):
        return self.hadoop.Path(f"{self.folder}/{name}")

    def _has(self, version: int) -> bool:
        return self.fs.exists(self._path(f"commits/{version}"))

    def _last(self) -> int:
        """The newest version, 0 if there is none. Versions follow each other without gaps, so it is
        found by doubling and halving, not by a list of them all."""
        low, high = 0, 1
        while self._has(high):
            low, high = high, 2 * high
        while high - low > 1:
            middle = (low + high) // 2
            low, high = (middle, high) if self._has(middle) else (low, middle)
        return low

    def _json(self, name: str) -> dict:
        return json.loads(self.spark.read.text(f"{self.folder}/{name}", wholetext=True).first()[0])

    def _put(self, name: str, content: dict) -> None:
        out = self.fs.create(self._path(name), True)
        out.write(bytearray(json.dumps(content).encode()))
        out.close()

    def _marker(self, batch: str) -> str:
        return f"batches/{hashlib.sha256(batch.encode()).hexdigest()}"

    def applied(self, batch: str) -> bool:
        if not self.fs.exists(self._path(self._marker(batch))):
            return False
        # One name for each version that an attempt aimed at; a stalled one takes none away.
        aims = sorted((int(f.getPath().getName()) for f in self.fs.listStatus(self._path(self._marker(batch)))), reverse=True)
        return any(self._has(v) and self._json(f"commits/{v}")["batch"] == batch for v in aims)

    def batches(self) -> list[str]:
        """Ids of the batches that the totals include, in order; reads every commit."""
        return [self._json(f"commits/{v}")["batch"] for v in range(1, self._last() + 1)]

    def read(self) -> DataFrame:
        """The totals; groups without documents or tokens left are not shown."""
        return self._read(self._last())

    def _read(self, version: int) -> DataFrame:
        fields = "source string, lang string, tokenizer string, n_docs long, n_tokens long"
        if not version:
            return self.spark.createDataFrame([], fields)
        return self.spark.read.schema(fields).parquet(f"{self.folder}/{self._json(f'commits/{version}')['data']}")

    def apply(self, batch: str, signed: DataFrame) -> bool:
        """Adds a batch; False, and no change, if it was added before. Totals are written first, then
        the marker, and the commit file last, by a rename that fails where its name is taken: in one
        step on file systems that rename so, such as HDFS."""
        if self.applied(batch):
            return False
        last = self._last()
        version, data = last + 1, scratch_path(self.spark, "x").rsplit("-", 1)[1]
        summed = totals(self._read(last).select(*KEYS, *SUMS).union(totals(signed).select(*KEYS, *SUMS)))
        summed.where("n_docs <> 0 or n_tokens <> 0").write.parquet(f"{self.folder}/totals-{version}-{data}")
        self._put(f"{self._marker(batch)}/{version}", {"batch": batch})
        self._put(f"drafts/{version}-{data}", {"batch": batch, "data": f"totals-{version}-{data}"})
        self.fs.mkdirs(self._path("commits"))
        try:
            self.context.rename(self._path(f"drafts/{version}-{data}"), self._path(f"commits/{version}"), self.spark.sparkContext._gateway.new_array(self.spark.sparkContext._jvm.org.apache.hadoop.fs.Options.Rename, 0))
        except Py4JJavaError as e:
            raise RuntimeError(f"version {version} was committed by another writer; apply the batch again") from e
        return True


def distinct_lines(text: Column) -> Column:
    """The text without lines that repeat an earlier one."""
    return F.array_join(F.array_distinct(F.split(text, "\n")), "\n")


def measured(docs: DataFrame) -> DataFrame:
    """Per document its counts, as it is and without repeated lines, and a digest of its text; no
    text is moved."""
    lines = distinct_lines(F.col("text"))
    counts = docs.select(
        "doc_id", "source", "lang", words(F.col("text")).alias("raw"), words(lines).alias("n_words"), words_and_marks(lines).alias("n_pieces"), F.sha2("text", 256).alias("digest")
    )
    return written(counts, "token-counts")


def without_copies(counts: DataFrame) -> DataFrame:
    """Rows of measured() for one document of each text, the smallest doc_id, or null where no row of
    the text has one. Null texts go. Repeated rows of that doc_id and text stay as they are; rows of
    that doc_id with another text are judged by that text."""
    known = counts.where("digest is not null")
    low = known.groupBy("digest").agg(F.min("doc_id").alias("low"))
    return skew_join(known, low, ["digest"]).where("doc_id <=> low").drop("low")


def op1_token_counts(spark, sf_dir: str) -> DataFrame:
    """Totals after four batches: all documents; the change to a curated corpus, in which copies are
    deleted and documents with repeated lines are revised; the curated corpus under a second version
    of the tokenizer; and the first batch again, which changes nothing."""
    counts = measured(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    raw, kept = counted(counts, "words-1", F.col("raw")), without_copies(counts)
    rollup = Rollup(spark, scratch_path(spark, "token-rollup"))
    rollup.apply("load", inserts(raw))
    rollup.apply("curate", changes(raw, counted(kept, "words-1", F.col("n_words"))))
    rollup.apply("second version", inserts(counted(kept, "words-2", F.col("n_pieces"))))
    rollup.apply("load", inserts(raw))
    return rollup.read()


OP1_SQL = """
WITH low AS (SELECT text AS t, min(doc_id) AS low FROM documents WHERE text IS NOT NULL GROUP BY text),
d AS (SELECT doc_id, source, lang, (SELECT string_agg(line, chr(10) ORDER BY i) FROM
    (SELECT line, min(i) AS i FROM (SELECT unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i) GROUP BY line)) AS text
  FROM documents JOIN low ON text = t AND doc_id IS NOT DISTINCT FROM low),
t AS (SELECT source, lang, len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS w, len(regexp_extract_all(text, '[0-9A-Za-z\\x80-\\x{10FFFF}]+|[!-/:-@\\[-`{-~]')) AS p FROM d)
SELECT source, lang, 'words-1' AS tokenizer, count(*) AS n_docs, CAST(sum(w) AS BIGINT) AS n_tokens FROM t GROUP BY 1, 2
UNION ALL SELECT source, lang, 'words-2', count(*), CAST(sum(p) AS BIGINT) FROM t GROUP BY 1, 2
"""
