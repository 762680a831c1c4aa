"""Resampling of documents towards a target distribution by importance weights over hashed n-grams.

A feature is a run of 1 to 3 words of a text (A-Z lower-cased); its bucket is a crc32 of its bytes. A bucket's gain is the
logarithm, in thousandths, of its smoothed share of the target's features over that of the corpus; a document's weight is
the sum of its features' gains. Documents are drawn without replacement by weight plus Gumbel noise from a hash of the id.

Segments are deduplicated: line ends cut the texts into lines, and equal lines of the whole corpus become one row. A distinct
line's features are found once; its counts go into the corpus multiplied by its occurrences, and its weight goes to every
document that has it, as often as it has it. Features that reach over a line end are found in each document and added.

Lines meet documents by two 64-bit hashes. The few lines that are more than a fixed share of all lines (so at most
``HOT_LINES``) are broadcast, all others are joined by a shuffle, so that no line gathers rows in one task. Ranks are
running totals over ranges.

Crc32 is linear: that of ``a b`` is that of ``a`` shifted by the length of `` b``, combined with that of `` b``. So only the
distinct words of a slice are hashed one by one.

Defined results: a null or empty text has no features, weight 0 and no rank unless ``min_words`` is 0; null ids hash as
``null`` and come after equal scores with an id; rows that share an id have the same noise, each its own rank; an empty
target has the smoothed share of nothing; an empty table gives no rows; columns other than id and text are only carried
by ``resample``.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import _LOWER as LOWER
from starmart.llm.common import ALNUM, flat, packed, slices
from starmart.llm.prefix import running_total
from starmart.llm.scratch import Scratch
from starmart.sources.files import store

LINE_END = "\n"
# A line with more than this part of all lines is hot; fewer than so many can be.
HOT_LINES = 4_000
# 2**32 equal steps of the uniform number behind the noise.
STEPS = 4_294_967_296.0


@dataclass(frozen=True)
class Resampling:
    buckets: int = 10_000
    longest: int = 3
    min_words: int = 20
    # Of 100 documents with that many words, draw so many.
    percent: int = 5
    seed: int = 42


_CRC = np.array([zlib.crc32(bytes([b])) for b in range(256)], np.uint32)
# Table of plain crc steps: what a byte does to a register without the constants that zlib puts around it.
_STEP = _CRC ^ _CRC[0]
_shifts: dict[int, np.ndarray] = {}
# Words of up to so many bytes find their tables by length, in one array.
USUAL = 64
_usual: list[np.ndarray] = []


def _shift_table(length: int) -> np.ndarray:
    """For each byte of a crc, what ``length`` more bytes of zeros make of it."""
    if length not in _shifts:
        bits = np.uint32(1) << np.arange(32, dtype=np.uint32)
        images, square, n = bits, _zero_byte(bits), length
        while n:  # a matrix power, as the images of the 32 single bits
            if n & 1:
                images = _apply(square, images)
            square, n = _apply(square, square), n >> 1
        values = np.arange(256, dtype=np.uint32)
        _shifts[length] = np.stack([_apply(images, values << np.uint32(8 * k)) for k in range(4)])
    return _shifts[length]


def _zero_byte(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint32(8)) ^ _STEP[x & np.uint32(255)]


def _apply(images: np.ndarray, x: np.ndarray) -> np.ndarray:
    out = np.zeros_like(x)
    for bit in range(32):
        out ^= np.where(x >> np.uint32(bit) & np.uint32(1), images[bit], np.uint32(0))
    return out


def appended(crc: np.ndarray, tail: np.ndarray, length: np.ndarray) -> np.ndarray:
    """crc32 of texts with tails, from the crc32 of both and the tails' lengths."""
    if not _usual:
        _usual.append(np.stack([_shift_table(n) for n in range(USUAL + 1)]))
    out, usual = tail.copy(), np.minimum(length, USUAL)
    for k in range(4):
        out ^= _usual[0][usual, k, (crc >> np.uint32(8 * k)) & np.uint32(255)]
    for n in np.unique(length[length > USUAL]):
        mine = np.flatnonzero(length == n)
        table, own = _shift_table(int(n)), crc[mine]
        out[mine] = tail[mine]
        for k in range(4):
            out[mine] ^= table[k, (own >> np.uint32(8 * k)) & np.uint32(255)]
    return out


@dataclass
class Words:
    """The words of some texts: crc32 of each alone and behind a space, that tail's length, their text and line."""

    crc: np.ndarray
    tail: np.ndarray
    length: np.ndarray
    text: np.ndarray
    line: np.ndarray

    @classmethod
    def of(cls, texts: pa.Array) -> Words:
        raw, bounds = flat(texts)
        low = LOWER[raw]
        inside = np.concatenate([[False], ALNUM[low], [False]])
        edge = np.zeros(len(raw) + 1, bool)
        edge[bounds] = True
        starts = np.flatnonzero(inside[1:] & (~inside[:-1] | edge))
        ends = np.flatnonzero(inside[:-1] & (~inside[1:] | edge))
        sizes = ends - starts
        held = pa.py_buffer(low[inside[1:-1]])
        offsets = pa.py_buffer(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64))
        found = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, offsets, held])
        numbered = found.dictionary_encode()
        distinct = numbered.dictionary.to_pylist()
        crc = np.array([zlib.crc32(w) for w in distinct], np.uint32)
        tail = np.array([zlib.crc32(b" " + w) for w in distinct], np.uint32)
        index = numbered.indices.to_numpy()
        text = np.searchsorted(bounds, starts, "right") - 1
        return cls(crc[index], tail[index], sizes + 1, text, np.cumsum(raw == ord(LINE_END))[starts])

    def within_lines(self, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Text and crc32 of the runs of each length that no line end cuts."""
        crc = self.crc
        yield self.text, crc
        for n in range(2, longest + 1):
            last = np.arange(n - 1, len(self.crc))
            first = last - (n - 1)
            # ``crc`` has the runs of n - 1 words, from each word with so many behind it.
            crc = appended(crc[: len(last)], self.tail[last], self.length[last])
            mine = (self.text[first] == self.text[last]) & (self.line[first] == self.line[last])
            yield self.text[first][mine], crc[mine]

    def over_line_ends(self, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The same of the runs that a line end cuts."""
        for n in range(2, longest + 1):
            first = np.arange(max(len(self.crc) - n + 1, 0))
            last = first + n - 1
            first = first[(self.text[first] == self.text[last]) & (self.line[first] != self.line[last])]
            crc = self.crc[first]
            for k in range(1, n):
                crc = appended(crc, self.tail[first + k], self.length[first + k])
            yield self.text[first], crc


def _buckets(words: Words, plan: Resampling, crossing: bool) -> tuple[np.ndarray, np.ndarray]:
    """Text and bucket of each feature, by text."""
    found = list(words.over_line_ends(plan.longest) if crossing else words.within_lines(plan.longest))
    text = np.concatenate([np.zeros(0, np.int64), *[t for t, _ in found]])
    bucket = np.concatenate([np.zeros(0, np.uint32), *[c for _, c in found]]) % np.uint32(plan.buckets)
    order = np.argsort(text, kind="stable")
    return text[order], bucket[order]


def _per_text(bucket: np.ndarray, text: np.ndarray, n: int, kind: str) -> tuple[np.ndarray, list[bytes]]:
    """How many buckets each text has, and their bytes."""
    ends = np.searchsorted(text, np.arange(n + 1))
    raw, size = bucket.astype(kind).tobytes(), np.dtype(kind).itemsize
    return np.diff(ends), [raw[size * a : size * b] for a, b in zip(ends[:-1], ends[1:], strict=True)]


def _kind(plan: Resampling) -> str:
    return "<u2" if plan.buckets <= 1 << 16 else "<u4"


def _cells(cells: pa.Array, plan: Resampling) -> tuple[np.ndarray, np.ndarray]:
    """All buckets in a row, and where each row's begin (one more for the end)."""
    raw, bounds = flat(cells.cast(pa.large_binary()))
    return np.frombuffer(raw.tobytes(), _kind(plan)), bounds // np.dtype(_kind(plan)).itemsize


def _find(
    plan: Resampling, crossing: bool, names: tuple[str, ...]
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Adds ``n_words`` and the buckets of the features to the fields ``names`` of ``doc``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            words = Words.of(texts)
            text, bucket = _buckets(words, plan, crossing)
            _, cells = _per_text(bucket, text, len(batch), _kind(plan))
            n_words = np.bincount(words.text, minlength=len(batch)).astype(np.int64)
            doc = batch.column("doc")
            columns = [doc.field(n) for n in names] + [pa.array(n_words), pa.array(cells, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "n_words", "features"])

    return run


def _histogram(plan: Resampling) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Features by bucket, each row's as often as its ``n`` says; one row for a bucket and task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(plan.buckets, np.int64)
        for batch in batches:
            bucket, ends = _cells(batch.column("features"), plan)
            times = np.repeat(batch.column("n").to_numpy(), np.diff(ends))
            # Whole numbers below 2**53 are exact as weights.
            total += np.bincount(bucket, weights=times, minlength=plan.buckets).astype(np.int64)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], names=["bucket", "n"])

    return run


def _counted(found: DataFrame, plan: Resampling) -> DataFrame:
    return found.select("features", "n").mapInArrow(_histogram(plan), "bucket int, n bigint")


def _total(parts: DataFrame, plan: Resampling) -> np.ndarray:
    """Counts of all buckets; their number is a parameter."""
    out = np.zeros(plan.buckets, np.int64)
    for bucket, n in parts.groupBy("bucket").agg(F.sum("n")).collect():
        out[bucket] = n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Of each bucket, in whole thousandths."""
    n, all_corpus, all_target = len(corpus), float(corpus.sum()), float(target.sum())
    ratios = [
        (t + 1.0) * (all_corpus + n) / ((s + 1.0) * (all_target + n))
        for s, t in zip(corpus.tolist(), target.tolist(), strict=True)
    ]
    return np.array([math.floor(1000 * math.log(r)) for r in ratios], np.int64)


def _weigh(
    gain: np.ndarray, plan: Resampling, names: tuple[str, ...]
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bucket, ends = _cells(batch.column("features"), plan)
            sums = np.concatenate([[0], np.cumsum(gain[bucket])])[ends]
            columns = [batch.column(n) for n in names] + [pa.array(np.diff(sums))]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "weight"])

    return run


def _line_hash(line: Column) -> Column:
    """Two 64-bit hashes with different seeds."""
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit(1), line).alias("b"))


def _noise(plan: Resampling, doc_id: Column) -> Column:
    """Gumbel noise in whole thousandths from a hash of the id."""
    digest = F.sha2(F.concat(F.lit(f"{plan.seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))), 256)
    uniform = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") + 0.5) / F.lit(STEPS)
    return F.floor(F.lit(-1000.0) * F.log(-F.log(uniform))).cast("bigint")


def _with_weights(rows: DataFrame, lines: DataFrame, total: int) -> DataFrame:
    """``row`` and the summed weights of its lines, from rows of ``row``, ``line`` and ``times``."""
    hot = lines.filter(F.col("n") > F.lit(total // HOT_LINES)).select("line", F.col("weight").alias("_hot"))
    # At most HOT_LINES rows of 24 bytes by the filter.
    marked = rows.join(F.broadcast(hot), "line", "left")
    known = marked.filter(F.col("_hot").isNotNull()).select("row", (F.col("_hot") * F.col("times")).alias("weight"))
    rest = marked.filter(F.col("_hot").isNull()).select("row", "line", "times")
    found = rest.join(lines.filter(F.col("n") <= F.lit(total // HOT_LINES)).select("line", "weight"), "line")
    found = found.select("row", (F.col("weight") * F.col("times")).alias("weight"))
    return known.unionByName(found).groupBy("row").agg(F.sum("weight").alias("weight"))


def weigh(
    docs: DataFrame, target: DataFrame, plan: Resampling = Resampling(), row: Column | None = None
) -> DataFrame:
    """``row``, ``doc_id``, ``n_words``, ``weight`` and ``score`` of every document (``doc_id``, ``text``).

    ``row`` tells the rows apart; without one, they are numbered.
    """
    scratch = Scratch()
    one = F.lit(1).cast("bigint").alias("n")
    # Lines without a word have no features.
    wordy = F.filter(F.split("text", LINE_END), lambda x: x.rlike(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"))
    hashed = F.transform(wordy, _line_hash)
    number = F.monotonically_increasing_id() if row is None else row
    texts = docs.select(number.alias("row"), "doc_id", "text", hashed.alias("lines"))
    own = f"row bigint, doc_id {docs.schema['doc_id'].dataType.simpleString()}"
    schema = f"{own}, lines array<struct<a:bigint,b:bigint>>, n_words bigint, features binary"
    over = packed(texts).mapInArrow(_find(plan, True, ("row", "doc_id", "lines")), schema)
    over = scratch.store(over, "over_line_ends")
    distinct = docs.select(F.explode(wordy).alias("text")).groupBy("text").agg(F.count(F.lit(1)).alias("n"))
    lines = distinct.select("text", _line_hash(F.col("text")).alias("line"), "n")
    schema = "line struct<a:bigint,b:bigint>, n bigint, n_words bigint, features binary"
    lines = scratch.store(packed(lines).mapInArrow(_find(plan, False, ("line", "n")), schema), "distinct_lines")
    corpus = _counted(lines, plan).unionByName(_counted(over.select("features", one), plan))
    wanted = packed(target.select("text"))
    within, across = (
        wanted.mapInArrow(_find(plan, crossing, ()), "n_words bigint, features binary").select("features", one)
        for crossing in (False, True)
    )
    gain = gains(_total(corpus, plan), _total(_counted(within, plan).unionByName(_counted(across, plan)), plan))
    weighed = lines.select("line", "n", "features").mapInArrow(
        _weigh(gain, plan, ("line", "n")), "line struct<a:bigint,b:bigint>, n bigint, weight bigint"
    )
    weighed = scratch.store(weighed, "line_weights")
    total = weighed.agg(F.sum("n")).first()[0] or 0
    held = over.select("row", F.explode("lines").alias("line")).groupBy("row", "line").agg(F.count(F.lit(1)).alias("times"))
    within_lines = _with_weights(held, weighed, total).withColumnsRenamed({"row": "_row", "weight": "_within"})
    ends = over.select("row", "doc_id", "n_words", "features").mapInArrow(
        _weigh(gain, plan, ("row", "doc_id", "n_words")), f"{own}, n_words bigint, weight bigint"
    )
    out = ends.join(within_lines, F.col("row") == F.col("_row"), "left")
    weight = F.col("weight") + F.coalesce("_within", F.lit(0))
    out = out.select("row", "doc_id", "n_words", weight.alias("weight"))
    out = store(out.withColumn("score", F.col("weight") + _noise(plan, F.col("doc_id"))), "weighed")
    scratch.release()
    return out


def draw(weighed: DataFrame, plan: Resampling = Resampling()) -> DataFrame:
    """Adds ``rank``: the place of the documents that are drawn, by score, null for the others."""
    able = weighed.filter(F.col("n_words") >= plan.min_words)
    chosen = plan.percent * able.count() // 100
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("row")]
    ranked = running_total(able.select("row", "doc_id", "score"), [], order, F.lit(1).cast("bigint"), "_before")
    ranked = ranked.filter(F.col("_before") < chosen).select(
        F.col("row").alias("_row"), (F.col("_before") + 1).alias("rank")
    )
    return weighed.join(ranked, F.col("row") == F.col("_row"), "left").drop("_row")


def digest(drawn: DataFrame, plan: Resampling = Resampling()) -> DataFrame:
    """One row of figures per document."""
    n = F.col("n_words")
    features = sum((F.greatest(n - k, F.lit(0)) for k in range(plan.longest)), F.lit(0))
    return drawn.select("doc_id", features.cast("bigint").alias("n_features"), "weight", "score", "rank")


def resample(docs: DataFrame, target: DataFrame, plan: Resampling = Resampling()) -> DataFrame:
    """The documents drawn, all their columns as they were."""
    rows = store(packed(docs, F.monotonically_increasing_id().alias("row")), "resampled")
    texts = rows.select("row", F.col("doc.doc_id").alias("doc_id"), F.col("doc.text").alias("text"))
    chosen = draw(weigh(texts, target, plan, F.col("row")), plan).filter(F.col("rank").isNotNull())
    return rows.join(chosen.select("row"), "row", "left_semi").select("doc.*")
