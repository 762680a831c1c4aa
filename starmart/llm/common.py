"""Text buffers, words and hashes shared by the corpus operators; all of it works on whole Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Texts are worked on in slices of about this many bytes; one longer text is a slice of its own.
SLICE_BYTES = 4 << 20

# Bytes of `[^\x20\x09-\x0D]+`: everything but ASCII white space.
SPACED = np.ones(256, bool)
SPACED[[0x20, *range(0x09, 0x0E)]] = False

# Bytes of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` once A-Z is lower-cased: digits, a-z, and all of any other script.
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (xor-shift and multiply)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
BASE = 0xD6E8FEB86659FD93  # odd, so it has an inverse modulo 2**64
_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of BASE and of its inverse, modulo 2**64."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, SLICE_BYTES + 1)
        inverse = pow(BASE, -1, 1 << 64)
        _powers[:] = []
        for base in (BASE, inverse):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers.append(np.multiply.accumulate(steps))
    return _powers[0][:n], _powers[1][:n]


def packed(docs: DataFrame, *extra: str) -> DataFrame:
    """All columns of ``docs`` in one struct ``doc``, so that added columns never clash with theirs."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), *extra)


def carried(df: DataFrame, columns: Sequence[str] | None) -> DataFrame:
    """``df`` with only these columns in its ``doc``."""
    if columns is None:
        return df
    return df.withColumn("doc", F.struct(*[F.col(f"doc.`{c}`").alias(c) for c in columns]))


def slices(batches: Iterator[pa.RecordBatch], limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Pieces of the batches with their texts (``doc.text``, null as empty), by bytes of text."""
    for batch in batches:
        texts = pc.struct_field(batch.column("doc"), "text")
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < len(batch):
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(at, to - at), texts.slice(at, to - at)
            at = to


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts in a row, and where each begins (one more entry for the end)."""
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]


def words(raw: np.ndarray, bounds: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the words (A-Z lower-cased), their start bytes, and the index of each text's first word."""
    low = _LOWER[raw]
    inside = kind[low]
    begins = np.zeros(len(raw) + 1, bool)
    begins[bounds] = True
    before = np.concatenate([[False], inside[:-1]]) if len(raw) else inside
    starts = np.flatnonzero(inside & (~before | begins[:-1]))
    after = np.concatenate([inside[1:], [False]]) if len(raw) else inside
    ends = np.flatnonzero(inside & (~after | begins[1:])) + 1
    first = np.searchsorted(starts, bounds)
    return span_hashes(low, starts, ends), starts, first


def span_hashes(low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial hash of each span of bytes, from running sums over pieces of the buffer."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + SLICE_BYTES, "right")))
        zero, end = starts[at], ends[to - 1]
        up, down = powers(int(end - zero) + 1)
        sums = np.zeros(end - zero + 1, np.uint64)
        np.cumsum(BYTE_VALUES[low[zero:end]] * up[: end - zero], out=sums[1:])
        s, e = starts[at:to] - zero, ends[at:to] - zero
        out[at:to] = mix((sums[e] - sums[s]) * down[s])
        at = to
    return out


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All of start, start + 1, ... for each range, one after the other."""
    total = int(lengths.sum())
    steps = np.arange(total) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    return np.repeat(starts, lengths) + steps


def lists(values: pa.Array, counts: np.ndarray) -> pa.Array:
    """A list column: the next ``counts[i]`` values for row i."""
    bounds = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(bounds), values)
