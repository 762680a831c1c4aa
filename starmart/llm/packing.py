"""Packing of token sequences by vector bin packing.

A sequence has limits on three things at once: tokens, segments (pieces of examples) and loss-bearing tokens. An example
is a prompt, which bears no loss, and a text, which does, closed by an end id. A task packs one window of examples after
the other: the open sequence takes the example with the largest dot product of its demands and what the sequence has
left, both as shares of the limits, among those that fit as a whole. When none fits, an example is cut to fill the
sequence. What the last sequence of a window holds goes back to the pool of the next one, so only the end of a task leaves
short sequences. Where cutting is allowed, a sequence that a limit closes before it is full, or that ends a task, is cut to
the largest power of two in it and needs no padding; without cutting, examples above a limit are the only ones cut, and
sequences are padded.

Windows are read where the rows are: nothing is shuffled, a task holds one window and the pieces left from the last. Which
examples share a sequence depends on how the input is split into tasks; every id is in exactly one piece in any case.

A file is Parquet; each of its rows is a sequence: its ids (16 bits each where the vocabulary allows), and the segments
in order.

Defined results: a null or empty text is the end id alone, a null prompt is empty; the strings of added tokens in a text
are those tokens; null ids and rows that share an id are examples of their own; a very long text is cut into full
sequences; an empty table gives no sequences; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from starmart.llm.common import SLICE_BYTES, packed, slices
from starmart.llm.pieces import closed, piece_encoder
from starmart.sources.files import new_location

# Examples of one window, besides the bytes of a slice.
WINDOW_ROWS = 4_096


@dataclass(frozen=True)
class Limits:
    tokens: int = 4096
    segments: int = 256
    loss: int = 4096
    # Whether examples that would fit a sequence by themselves may be cut too.
    cut: bool = True

    def __post_init__(self) -> None:
        if min(self.tokens, self.segments, self.loss) < 1:
            raise ValueError("a sequence needs room for one token")

    @property
    def caps(self) -> np.ndarray:
        return np.array([self.tokens, self.segments, self.loss], np.float64)


@dataclass
class Piece:
    """Ids ``start`` to ``stop`` of an example, and how many of its first ids bear no loss."""

    example: int
    start: int
    stop: int
    prompt: int

    @property
    def tokens(self) -> int:
        return self.stop - self.start

    @property
    def loss(self) -> int:
        return self.stop - min(max(self.start, self.prompt), self.stop)

    def fitting(self, tokens: int, loss: int) -> int:
        """The most first ids of the piece within what a sequence has left."""
        free = max(self.prompt - self.start, 0)
        return min(self.tokens, tokens, free + loss)

    def cut(self, n: int) -> tuple[Piece, Piece]:
        at = self.start + n
        return Piece(self.example, self.start, at, self.prompt), Piece(self.example, at, self.stop, self.prompt)


@dataclass
class Pool:
    """Pieces by equal demands, with the demands of each kind in arrays."""

    limits: Limits
    kinds: dict[tuple[int, int], int] = field(default_factory=dict)
    held: list[list[Piece]] = field(default_factory=list)
    demand: np.ndarray = field(default_factory=lambda: np.zeros((16, 3)))
    open: np.ndarray = field(default_factory=lambda: np.zeros(16, bool))
    size: int = 0

    def add(self, piece: Piece) -> None:
        key = piece.tokens, piece.loss
        kind = self.kinds.setdefault(key, len(self.held))
        if kind == len(self.held):
            self.held.append([])
            if kind == len(self.demand):
                self.demand = np.concatenate([self.demand, np.zeros_like(self.demand)])
                self.open = np.concatenate([self.open, np.zeros_like(self.open)])
            self.demand[kind] = key[0], 1, key[1]
        self.held[kind].append(piece)
        self.open[kind] = True
        self.size += 1

    def take(self, kind: int) -> Piece:
        piece = self.held[kind].pop()
        self.open[kind] = bool(self.held[kind])
        self.size -= 1
        return piece

    def best(self, left: np.ndarray, whole: bool) -> int | None:
        """The kind with the largest dot product of demands and what is left; ``whole``: of those that fit."""
        n = len(self.held)
        demand, able = self.demand[:n], self.open[:n]
        if whole:
            able = able & (demand <= left).all(1)
        if not able.any():
            return None
        return int(np.argmax(np.where(able, demand @ (left / self.limits.caps**2), -1.0)))


def pack(pool: Pool, last: bool) -> Iterator[list[Piece]]:
    """Sequences of the pool's pieces. Unless it is the ``last`` one, what an unfinished sequence holds stays in the pool."""
    limits = pool.limits
    while pool.size:
        bin_: list[Piece] = []
        left = limits.caps.copy()

        def place(piece: Piece, bin_: list[Piece] = bin_, left: np.ndarray = left) -> None:
            bin_.append(piece)
            left -= (piece.tokens, 1, piece.loss)

        while left[0] > 0 and left[1] > 0 and pool.size:
            kind = pool.best(left, whole=True)
            if kind is None and (limits.cut or not bin_):
                kind = pool.best(left, whole=False)
                piece = pool.take(kind)
                n = piece.fitting(int(left[0]), int(left[2]))
                if not n:
                    pool.add(piece)
                    break
                first, rest = piece.cut(n)
                place(first)
                pool.add(rest)
            elif kind is None:
                break
            else:
                place(pool.take(kind))
        length = sum(p.tokens for p in bin_)
        if length < limits.tokens and not pool.size and not last:
            for piece in bin_:
                pool.add(piece)
            return
        if limits.cut and length < limits.tokens:
            spare = length - (1 << (length.bit_length() - 1))
            while spare:
                piece = bin_.pop()
                first, rest = piece.cut(max(piece.tokens - spare, 0))
                spare -= rest.tokens
                if first.tokens:
                    bin_.append(first)
                pool.add(rest)
        yield bin_


SEGMENTS = "array<struct<doc_id: bigint, start: bigint, offset: int, length: int, doc_tokens: bigint, loss: int>>"
SEQUENCE = f"sequence_id bigint, n_tokens int, n_loss int, width int, ids binary, segments {SEGMENTS}"


@dataclass
class _Window:
    """The examples a task holds: their ids, and the pieces not packed yet."""

    ids: list[np.ndarray] = field(default_factory=list)
    doc_ids: list = field(default_factory=list)

    def kept(self, pool: Pool) -> tuple[_Window, Pool]:
        """Only what the pool still has."""
        window, fresh, number = _Window(), Pool(pool.limits), {}
        for piece in sorted((p for held in pool.held for p in held), key=lambda p: (p.example, p.start)):
            if piece.example not in number:
                number[piece.example] = len(window.ids)
                window.ids.append(self.ids[piece.example])
                window.doc_ids.append(self.doc_ids[piece.example])
            fresh.add(Piece(number[piece.example], piece.start, piece.stop, piece.prompt))
        return window, fresh


def _sequences(window: _Window, bins: list[list[Piece]], first: int, kind: str) -> pa.RecordBatch:
    flat = [p for b in bins for p in b]
    sizes = np.array([len(b) for b in bins], np.int64)
    lengths = np.array([p.tokens for p in flat], np.int64)
    ends = np.cumsum(lengths)
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    totals = np.add.reduceat(lengths, bounds[:-1])
    columns = {
        "doc_id": pa.array([window.doc_ids[p.example] for p in flat], pa.int64()),
        "start": pa.array([p.start for p in flat], pa.int64()),
        "offset": pa.array(ends - lengths - np.repeat(np.cumsum(totals) - totals, sizes), pa.int32()),
        "length": pa.array(lengths, pa.int32()),
        "doc_tokens": pa.array([len(window.ids[p.example]) for p in flat], pa.int64()),
        "loss": pa.array([p.loss for p in flat], pa.int32()),
    }
    segments = pa.ListArray.from_arrays(
        pa.array(bounds, pa.int32()), pa.StructArray.from_arrays(list(columns.values()), names=list(columns))
    )
    ids = [np.concatenate([window.ids[p.example][p.start : p.stop] for p in b]).astype(kind).tobytes() for b in bins]
    n = len(bins)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.arange(first, first + n), pa.int64()),
            pa.array(totals, pa.int32()),
            pa.array([sum(p.loss for p in b) for b in bins], pa.int32()),
            pa.array([int(kind[-1])] * n, pa.int32()),
            pa.array(ids, pa.binary()),
            segments,
        ],
        names=["sequence_id", "n_tokens", "n_loss", "width", "ids", "segments"],
    )


def _packed(
    path: str, limits: Limits, end_id: int, window_rows: int
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = piece_encoder(path)
        kind = "<u2" if max(encode.size, end_id + 1) <= 1 << 16 else "<u4"
        window, pool, done, part = _Window(), Pool(limits), 0, 0

        def bins(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal done
            held: list[list[Piece]] = []
            for bin_ in pack(pool, last):
                held.append(bin_)
                if len(held) == 256:
                    yield _sequences(window, held, (part << 33) + done, kind)
                    done, held = done + len(held), []
            if held:
                yield _sequences(window, held, (part << 33) + done, kind)
                done += len(held)

        for batch, texts in slices(batches):
            part = batch.column("part")[0].as_py()
            doc = batch.column("doc")
            prompts = pc.fill_null(pc.struct_field(doc, "prompt").cast(pa.large_string()), "")
            before, before_at = encode.encode(prompts)
            ids, at = closed(*encode.encode(texts), end_id)
            doc_ids = doc.field("doc_id").to_pylist()
            for i, doc_id in enumerate(doc_ids):
                own, prompt = ids[at[i] : at[i + 1]], before[before_at[i] : before_at[i + 1]]
                pool.add(Piece(len(window.ids), 0, len(prompt) + len(own), len(prompt)))
                window.ids.append(np.concatenate([prompt, own]).astype(kind))
                window.doc_ids.append(doc_id)
                if pool.size >= window_rows:
                    yield from bins(False)
                    window, pool = window.kept(pool)
            if sum(map(len, window.ids)) * 4 >= SLICE_BYTES:
                yield from bins(False)
                window, pool = window.kept(pool)
        yield from bins(True)

    return run


def write_packed(
    examples: DataFrame,
    vocabulary: str,
    limits: Limits = Limits(),
    end_id: int = 2,
    prompt: str | None = None,
    window_rows: int = WINDOW_ROWS,
) -> str:
    """Packs the examples (``doc_id``, ``text``, and a ``prompt`` column) and writes the sequences; returns where."""
    spark = examples.sparkSession
    before = (F.col(f"`{prompt}`") if prompt else F.lit(None)).cast("string").alias("prompt")
    rows = packed(examples.select("doc_id", "text", before), F.spark_partition_id().alias("part"))
    path = new_location(spark, "packed")
    rows.mapInArrow(_packed(vocabulary, limits, end_id, window_rows), SEQUENCE).write.parquet(path)
    return path


def read_packed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(StructType.fromDDL(SEQUENCE)).parquet(path)


def ids_of(payload: bytes, width: int) -> np.ndarray:
    return np.frombuffer(payload, f"<u{width}").astype("<u4")


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(len(batch)):
            ids = ids_of(batch.column("ids")[i].as_py(), batch.column("width")[i].as_py()).tobytes()
            own = batch.column("segments")[i].values
            offset, length = (own.field(n).to_numpy().astype(np.int64) for n in ("offset", "length"))
            crc = [zlib.crc32(ids[4 * a : 4 * (a + n)]) for a, n in zip(offset, length, strict=True)]
            sequence = np.full(len(own), batch.column("sequence_id")[i].as_py(), np.int64)
            columns = {
                "doc_id": own.field("doc_id"),
                "start": own.field("start"),
                "length": pa.array(length),
                "ids_crc32": pa.array(crc, pa.int64()),
                "doc_tokens": own.field("doc_tokens"),
                "sequence_id": pa.array(sequence),
                "offset": pa.array(offset),
            }
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def digest(sequences: DataFrame) -> DataFrame:
    """One row of figures per piece, from the written sequences."""
    schema = (
        "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
    )
    return sequences.select("sequence_id", "width", "ids", "segments").mapInArrow(_pieces, schema)
