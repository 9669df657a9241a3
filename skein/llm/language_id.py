"""Language identification by compression.

Each language gets a zstandard raw-content dictionary made of text known to be in it; in
dictionaries and texts alike, case is folded and what is no letter becomes a space. A text is cut into
chunks, every chunk is compressed with every dictionary, and the language with the fewest bytes in
total wins. A narrow margin between the two best languages is a rejection.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, Window, functions as F

from skein.llm.common import below, free_name

#: Bound of the training sample: so many slices of so many characters for each language, drawn from
#: all slices of all its texts.
SLICES_PER_LANGUAGE = 400
SLICE_CHARS = 400
#: So many languages have their compressors in memory at a time.
LANGUAGES_AT_ONCE = 64
CHUNK_BYTES = 2048
LEVEL = 3
#: A text is rejected if its two best languages differ by a smaller share of its size than this.
MIN_MARGIN = 0.002

_NO_LETTERS = re.compile(r"[\W\d_]+")
#: Word characters of `re` that are neither letters nor digits, such as superscripts and fractions; a
#: class of its own, as `re` looks such a class up in a table. Those beyond U+FFFF, which it does not
#: look up so, are a second class, for texts that have any such character.
_NUMBERS, _FAR_NUMBERS = (
    re.compile("[" + "".join(x for x in map(chr, of) if x.isalnum() and not x.isalpha() and not x.isdecimal()) + "]") for of in (range(0x80, 0x10000), range(0x10000, 0x20000))
)


def _without(numbers: re.Pattern[str], text: str) -> str:
    return numbers.sub(" ", text) if numbers.search(text) else text


def folded(text: str) -> str:
    text = text.lower()
    if not text.isascii():
        text = _without(_NUMBERS, text)
        if len(text.encode("utf-16-le", "surrogatepass")) > 2 * len(text):
            text = _without(_FAR_NUMBERS, text)
    return _NO_LETTERS.sub(" ", text).strip()


def training_slices(docs: DataFrame, usable: Column) -> DataFrame:
    """A bounded sample: texts are cut into slices from end to end, and each language keeps those
    with the smallest hashes of text and place, so every slice of every text has the same chance and
    repeated texts count once. Hashes alone are ranked and shuffled, and cut off by their count before
    that, so no task sees all slices of a language; then the chosen slices are taken from the texts."""
    known = docs.where(usable & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text", F.xxhash64("text").alias("t"))
    last = F.floor((F.greatest(F.length("text"), F.lit(1)) - 1) / SLICE_CHARS).cast("int")
    places = F.sequence(F.lit(0), last)
    hashed = known.select("lang", F.explode(F.transform(places, lambda i: F.xxhash64("t", i))).alias("h"))
    few = below(hashed, ["lang"], "h", SLICES_PER_LANGUAGE).distinct()
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    cut = few.withColumn("r", rank).where(F.col("r") <= SLICES_PER_LANGUAGE).groupBy("lang").agg(F.max("h").alias("cut"))
    chosen = F.filter(places, lambda i: F.xxhash64("t", i) <= F.col("cut"))
    piece = lambda i: F.struct(F.xxhash64("t", i).alias("h"), F.substring("text", i * SLICE_CHARS + 1, F.lit(SLICE_CHARS)).alias("piece"))
    # One row per language, as in the model itself.
    pieces = known.join(F.broadcast(cut), "lang").select("lang", F.explode(F.transform(chosen, piece)).alias("p"))
    return pieces.groupBy("lang", "p.h").agg(F.min("p.piece").alias("piece"))


def fit(docs: DataFrame, usable: Column | None = None) -> dict[str, bytes]:
    """Dictionaries by language, from rows where usable holds and text and lang are not null.

    Repeated texts count once. Without a usable row the model is empty, and every text is `und`.
    """
    usable = F.lit(True) if usable is None else usable
    counts = docs.where(usable & F.col("lang").isNotNull() & F.col("text").isNotNull()).groupBy("lang").count()
    kept = [r.lang for r in counts.orderBy(F.desc("count"), "lang").collect()]
    rows = training_slices(docs, usable).collect() if kept else []
    pieces: dict[str, list[str]] = {k: [] for k in kept}
    for r in sorted(rows, key=lambda r: (r.lang, r.h)):
        pieces[r.lang].append(r.piece)
    return {k: folded("\n".join(v)).encode() for k, v in pieces.items() if any(v)}


def _chunks(data: bytes) -> Iterator[bytes]:
    for i in range(0, len(data), CHUNK_BYTES):
        yield data[i : i + CHUNK_BYTES]


class Classifier:
    """Compressors for each language; languages come in order of their training rows, so equal
    sizes go to the more frequent one. Texts are judged against one group of languages after the
    other, and the best two so far are carried on."""

    def __init__(self, dictionaries: dict[str, bytes]):
        self.languages = list(dictionaries)
        self.contents = list(dictionaries.values())
        self.starts = range(0, len(self.contents), LANGUAGES_AT_ONCE)
        self.held: int | None = None
        self.compressors: list[zstandard.ZstdCompressor] = []

    def _hold(self, start: int) -> None:
        """Compressors of the group of languages from start on take the place of those before."""
        if self.held == start:
            return
        self.compressors = []
        for content in self.contents[start : start + LANGUAGES_AT_ONCE]:
            d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=LEVEL)
            self.compressors.append(
                zstandard.ZstdCompressor(dict_data=d, level=LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False)
            )
        self.held = start

    @staticmethod
    def _data(text: str | None) -> bytes:
        data = folded(text).encode("utf-8", "replace") if text else b""
        # A short text is written again until it fills a line: one match more or less then shows.
        return b" ".join([data] * (64 // len(data) + 1)) if 0 < len(data) < 64 else data

    def judge(self, text: str | None) -> tuple[str, float, float, bool]:
        """(language, score, margin, accepted)."""
        return self.judge_all([text])[0]

    def judge_all(self, texts: Iterable[str | None]) -> list[tuple[str, float, float, bool]]:
        """judge() of each text; a group's compressors are made once for all of them. Texts are folded
        anew for each group, so that no folded copies of them all are held."""
        texts = list(texts)
        best: list[list[tuple[int, int]]] = [[] for _ in texts]
        sizes_of = [0] * len(texts)
        for start in sorted(self.starts, key=lambda x: x != self.held):
            self._hold(start)
            for k, text in enumerate(texts):
                if data := self._data(text):
                    sizes_of[k] = len(data)
                    sizes = [(sum(len(c.compress(x)) for x in _chunks(data)), start + i) for i, c in enumerate(self.compressors)]
                    best[k] = sorted(best[k] + sizes)[:2]
        return [self._verdict(b, n) for b, n in zip(best, sizes_of)]

    def _verdict(self, best: list[tuple[int, int]], n_bytes: int) -> tuple[str, float, float, bool]:
        """From the (size, language) of the best two."""
        if not best:
            return "und", 0.0, 0.0, False
        language = self.languages[best[0][1]]
        if len(best) == 1:
            return language, 1.0, 1.0, True
        margin = (best[1][0] - best[0][0]) / n_bytes
        score = min(1.0, 0.5 + margin * 5)
        return language, score, margin, margin >= MIN_MARGIN


def classify(docs: DataFrame, dictionaries: dict[str, bytes]) -> DataFrame:
    """docs with lang_pred, score, margin and accepted added; columns of these names are replaced.

    Defined results: null text or text without a letter is `und`, score 0, not accepted; so is every
    text if nothing was learned. Very long texts are read whole, chunk by chunk. Repeated rows get
    the same answer each; equal sizes go to the language with more training rows and are rejected.
    """
    model = docs.sparkSession.sparkContext.broadcast(list(dictionaries.items()))
    held: list[Classifier] = []

    @F.pandas_udf("lang_pred string, score double, margin double, accepted boolean")
    def judge(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        if not held:
            held.append(Classifier(dict(model.value)))
        for text in texts:
            rows = held[0].judge_all(text)
            yield pd.DataFrame(rows, columns=["lang_pred", "score", "margin", "accepted"])

    out = docs.drop("lang_pred", "score", "margin", "accepted")
    name = free_name(out, "__lid")
    return out.withColumn(name, judge(F.col("text"))).select(*(f"`{c}`" for c in out.columns), f"{name}.*")


def held_out(doc_id: str = "doc_id") -> Column:
    """Documents that training never sees."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def op2_language_id(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit(docs, ~held_out())
    return classify(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score", "margin", "accepted"
    )
