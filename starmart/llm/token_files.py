"""Token ids in fixed-width bit-packed blocks.

A file is Parquet; each of its rows is a block of whole documents: the ids of the block at ``width`` bits each, packed
little-endian bit by bit (``payload``), the documents' ids, and where in the block each begins (``offsets``, one more
for the end). Id ``i`` of a block is at bit ``i * width``, so any slice unpacks by itself in numpy. ``width`` is the
least that holds the vocabulary. Files follow the ascending order of doc_id; ``read_blocks`` adds each block's first id
in the whole corpus, from the block sizes.

Texts are encoded by their distinct pieces (``pieces``): numbered in Arrow, encoded once, their ids gathered in numpy.

Defined results: a null or empty text is the end id alone; a very long one is in one block, which is then longer than the
others; the string of an added token in a text is that token, as the
library reads it; null ids come first; rows that share an id follow the hash of their text, equal rows each have their
own entry; an empty table gives no blocks; only doc_id and text are read.
"""

from __future__ import annotations

import functools
import os
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmart.llm.common import packed, slices
from starmart.llm.pieces import closed, piece_encoder
from starmart.sources.files import new_location

BLOCK_IDS = 1 << 18
# Words that a task remembers the ids of; the others are encoded again in each slice.
REMEMBERED = 600_000
# Between a letter or number and a mark or line end, and behind a single line end: always between pre-tokens.
_CUT = re.compile(r"(?<=[^\W_])(?=[.,\n])|(?<=[^\W_]\n|[.,]\n)(?=[^\W_])")
# A space that ends the text or that white space follows.
_GAP = re.compile(r" (?=\s|\Z)")
BLOCK = (
    "part int, block int, part_offset bigint, width int, doc_ids array<bigint>, offsets array<bigint>, "
    "n_ids bigint, payload binary"
)


class Encoder:
    """Byte-level BPE of the tokenizers library, by words.

    The vocabulary's pre-tokens never reach over a space that something other than white space follows: the space begins
    a pre-token. Texts are cut there, each piece is encoded once in a slice by the library, and the ids are put together.
    Strings of added tokens come first: they are pieces of their own, and what is between them is cut by itself. If one
    of them takes more than its plain string (white space in or beside it, whole words, normalized text), no text is cut.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.size = self.tokenizer.get_vocab_size()
        added = {t.content: (i, t) for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.known = _Ids({s: np.array([i], np.uint32).tobytes() for s, (i, _) in added.items()})
        self.whole = any(
            t.lstrip or t.rstrip or t.single_word or t.normalized or re.search(r"\s", s) for s, (_, t) in added.items()
        )
        # Of strings that begin at one place, the library takes the longest.
        longest = sorted(added, key=len, reverse=True)
        self.added = re.compile(f"({'|'.join(map(re.escape, longest))})") if added else None

    def pieces(self, text: str) -> list[str]:
        if self.whole:
            return [text]
        if self.added and self.added.search(text):
            return [p for k, s in enumerate(self.added.split(text)) for p in ([s] if k % 2 else self._spaced(s))]
        return self._spaced(text)

    def _spaced(self, text: str) -> list[str]:
        cut = self._careful(text) if _GAP.search(text) else text.split(" ")
        cut[1:] = [" " + p for p in cut[1:]]
        return cut

    @staticmethod
    def _careful(text: str) -> list[str]:
        out = [""]
        for k, piece in enumerate(text.split(" ")):
            if k and (not piece or piece[0].isspace()):
                out[-1] += " " + piece
            elif k:
                out.append(piece)
            else:
                out[0] = piece
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit numbers."""
        if self.whole:
            found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
            return [np.array(e.ids, np.uint32).tobytes() for e in found]
        cuts = [self.pieces(t) for t in texts]
        pieces = {p: _CUT.split(p) for p in set().union(*cuts) if p not in self.known}
        fresh = [p for p in set().union(*pieces.values()) if p not in self.known]
        found = self.tokenizer.encode_batch_fast(fresh, add_special_tokens=False)
        new = {p: np.array(e.ids, np.uint32).tobytes() for p, e in zip(fresh, found, strict=True)}
        known, self.known.rest = self.known, new
        for piece, parts in pieces.items():
            if len(parts) > 1:
                new[piece] = b"".join([known[p] for p in parts])
        out = [b"".join(map(known.__getitem__, c)) for c in cuts]
        if len(known) < REMEMBERED:
            known.update(new)
        return out


class _Ids(dict):
    """Ids of remembered words; ``rest`` has those of the slice at hand."""

    rest: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        return self.rest[piece]


@functools.cache
def encoder(path: str) -> Encoder:
    """One encoder for a worker process; what it remembers serves the next task too."""
    return Encoder(path)


def width_of(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    """The low ``width`` bits of each id, one after the other."""
    if width in (8, 16, 32):
        return ids.astype(f"<u{width // 8}").tobytes()
    out = []
    for at in range(0, len(ids), 1 << 16):
        raw = ids[at : at + (1 << 16)].astype("<u4").view(np.uint8).reshape(-1, 4)
        out.append(np.packbits(np.unpackbits(raw, axis=1, bitorder="little")[:, :width], bitorder="little").tobytes())
    return b"".join(out)


def unpack(payload: bytes, width: int, start: int, stop: int) -> np.ndarray:
    """Ids ``start`` to ``stop`` of a block; only their bytes are touched."""
    if width in (8, 16, 32):
        step = width // 8
        return np.frombuffer(payload, f"<u{step}", stop - start, start * step).astype(np.uint32)
    low = start * width // 8
    raw = np.frombuffer(payload, np.uint8, -(-stop * width // 8) - low, low)
    bits = np.unpackbits(raw, bitorder="little")[start * width - low * 8 :][: (stop - start) * width]
    full = np.zeros((stop - start, 32), np.uint8)
    full[:, :width] = bits.reshape(-1, width)
    return np.packbits(full, axis=1, bitorder="little").view("<u4").reshape(-1)


def _blocks(path: str, end_id: int, block_ids: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = piece_encoder(path)
        width = width_of(encode.size)
        block, before, n, part = 0, 0, 0, 0
        doc_ids: list = []
        held: list[np.ndarray] = []
        sizes: list[np.ndarray] = [np.zeros(1, np.int64)]

        def emit() -> pa.RecordBatch:
            ids, offsets = np.concatenate(held), np.cumsum(np.concatenate(sizes)).tolist()
            row = {"part": part, "block": block, "part_offset": before, "width": width}
            row |= {"doc_ids": doc_ids, "offsets": offsets, "n_ids": len(ids), "payload": pack(ids, width)}
            return pa.RecordBatch.from_pylist([row], schema=_BLOCK_ARROW)

        for batch, texts in slices(batches):
            part = batch.column("part")[0].as_py()
            ids, bounds = closed(*encode.encode(texts), end_id)
            own, at = batch.column("doc").field("doc_id").to_pylist(), 0
            while at < len(own):
                # Up to the document that fills the block.
                to = int(np.searchsorted(bounds, bounds[at] + block_ids - n))
                to = min(max(to, at + 1), len(own))
                doc_ids += own[at:to]
                held.append(ids[bounds[at] : bounds[to]])
                sizes.append(np.diff(bounds[at : to + 1]))
                n, at = n + int(bounds[to] - bounds[at]), to
                if n >= block_ids:
                    yield emit()
                    block, before, n, doc_ids, held = block + 1, before + n, 0, [], []
                    sizes = [np.zeros(1, np.int64)]
        if held:
            yield emit()

    return run


_BLOCK_ARROW = pa.schema(
    [
        ("part", pa.int32()),
        ("block", pa.int32()),
        ("part_offset", pa.int64()),
        ("width", pa.int32()),
        ("doc_ids", pa.list_(pa.int64())),
        ("offsets", pa.list_(pa.int64())),
        ("n_ids", pa.int64()),
        ("payload", pa.binary()),
    ]
)


def write_token_files(docs: DataFrame, vocabulary: str, end_id: int = 0, block_ids: int = BLOCK_IDS) -> str:
    """Encodes the texts with the vocabulary file at ``vocabulary`` and writes the blocks; returns where.

    ``end_id`` closes each document.
    """
    spark = docs.sparkSession
    rows = packed(docs.select("doc_id", "text"))
    order = [F.asc_nulls_first("doc.doc_id"), F.xxhash64("doc.text")]
    parts = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    path = new_location(spark, "token_files")
    parts.mapInArrow(_blocks(vocabulary, end_id, block_ids), BLOCK).write.option("compression", "none").parquet(path)
    return path


def read_blocks(spark, path: str) -> DataFrame:
    """The blocks with ``start``, the number of ids before each."""
    blocks = spark.read.schema(BLOCK).parquet(path)
    sizes = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each file: bounded by the number of write tasks.
    parts = F.broadcast(sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_start")))
    return blocks.join(parts, "part").withColumn("start", F.col("_start") + F.col("part_offset")).drop("_start")


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(len(batch)):
            cell = {name: batch.column(name)[row].as_py() for name in ("start", "width", "doc_ids", "offsets", "payload")}
            ids = unpack(cell["payload"], cell["width"], 0, cell["offsets"][-1]).astype("<u4").tobytes()
            bounds = np.array(cell["offsets"], np.int64)
            crc = [zlib.crc32(ids[4 * a : 4 * b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(cell["doc_ids"], pa.int64()),
                    pa.array(bounds[:-1] + cell["start"]),
                    pa.array(np.diff(bounds)),
                    pa.array(crc, pa.int64()),
                ],
                names=["doc_id", "start", "n_tokens", "ids_crc32"],
            )


def digest(blocks: DataFrame) -> DataFrame:
    """One row of figures per document, from the unpacked blocks."""
    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    return blocks.select("start", "width", "doc_ids", "offsets", "payload").mapInArrow(_documents, schema)
