"""Token counts that follow edits.

A document's text is cut into leaves, runs of pre-tokens of about ``LEAF_CHARS`` characters (see ``token_files``); a
segment tree has the tokens of every subtree. Trees are kept as a table. For a document with edits, only the leaves that an edit touches, with
the one its last character before and first character behind are in and those before that end in white space, are
encoded again, and the sums above them updated.

Defined results: a null text has no tokens; edits (``start``, ``stop``, ``replacement``, in characters of the old text) are
cut to the text, and of overlapping ones those that begin later are skipped; null replacements delete; edits of unknown
ids do nothing; rows that share an id and a text share trees and edits; a very long text has a tree of its own in one row;
only doc_id and text are read, so other columns never clash; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import packed, slices
from starmart.llm.token_files import Encoder, encoder

LEAF_CHARS = 256
# What the registered query edits: mail addresses and long hexadecimal secrets.
REDACTED = {"<mail>": re.compile(r"[\w.+-]+@[\w-]+(?:\.[\w-]+)+"), "<secret>": re.compile(r"\b[0-9a-f]{16,}\b")}
EDITS = "array<struct<start:bigint,stop:bigint,replacement:string>>"


class Tree:
    """Sums over leaves: node ``i`` has the children ``2i`` and ``2i + 1``, the root is 1."""

    def __init__(self, leaves: np.ndarray):
        self.size = 1 << max(len(leaves) - 1, 0).bit_length()
        self.sums = np.zeros(2 * self.size, np.int64)
        self.sums[self.size : self.size + len(leaves)] = leaves
        for level in range(self.size.bit_length() - 2, -1, -1):
            a, b = 1 << level, 2 << level
            self.sums[a:b] = self.sums[2 * a : 2 * b : 2] + self.sums[2 * a + 1 : 2 * b : 2]

    def set(self, leaf: int, value: int) -> None:
        node = self.size + leaf
        change = value - self.sums[node]
        while node:
            self.sums[node] += change
            node //= 2

    @property
    def total(self) -> int:
        return int(self.sums[1])


def _leaves(encode: Encoder, text: str) -> list[str]:
    out, held, size = [], [], 0
    for piece in encode.pieces(text):
        # Not beside the string of an added token: an edit of the string joins it with its neighbours.
        if size >= LEAF_CHARS and piece[:1] == " ":
            out.append("".join(held))
            held, size = [], 0
        held.append(piece)
        size += len(piece)
    return [*out, "".join(held)] if held else out


def _count(encode: Encoder, texts: list[str]) -> list[int]:
    return [len(ids) // 4 for ids in encode.encode(texts)]


def _build(path: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        for batch, texts in slices(batches):
            leaves = [_leaves(encode, t) for t in texts.to_pylist()]
            counts = iter(_count(encode, [leaf for own in leaves for leaf in own]))
            sums = [Tree(np.array([next(counts) for _ in own], np.int64)).sums.tolist() for own in leaves]
            lengths = [[len(leaf) for leaf in own] for own in leaves]
            doc = batch.column("doc")
            columns = [doc.field("doc_id"), doc.field("th"), pa.array(lengths, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(sums, pa.list_(pa.int64()))], names=["doc_id", "th", "chars", "sums"]
            )

    return run


def edited_count(encode: Encoder, text: str, chars: list[int], sums: list[int], edits: list[dict]) -> tuple[int, int, int]:
    """Tokens after the edits, edits made, and characters encoded again."""
    tree = Tree(np.zeros(len(chars), np.int64))
    tree.sums[:] = sums
    bounds = np.concatenate([[0], np.cumsum(chars)]).astype(np.int64)
    regions: list[list] = []  # first leaf, last leaf, parts of the new text, end of the last edit
    done = 0
    for start, stop, new in sorted((max(e["start"], 0), e["stop"], e["replacement"] or "") for e in edits):
        stop = min(max(stop, start), len(text))
        if start > len(text) or done and start < regions[-1][3]:
            continue
        a = max(int(np.searchsorted(bounds, max(start - 1, 0), "right")) - 1, 0)
        b = max(min(int(np.searchsorted(bounds, stop, "right")) - 1, len(chars) - 1), 0)
        a = min(a, max(len(chars) - 1, 0))
        while a and text[bounds[a] - 1].isspace():  # white space up to a new added token is one run
            a -= 1
        if not regions or a > regions[-1][1]:
            regions.append([a, b, [text[bounds[a] : start]], stop])
        else:
            last = regions[-1]
            last[1] = max(last[1], b)
            last[2].append(text[last[3] : start])
            last[3] = stop
        regions[-1][2].append(new)
        done += 1
    fresh = []
    for first, last, parts, end in regions:
        stop = bounds[last + 1] if len(chars) else 0
        fresh.append("".join(parts) + text[end:stop])
    for (first, last, *_), n in zip(regions, _count(encode, fresh), strict=True):
        tree.set(first, n)
        for leaf in range(first + 1, last + 1):
            tree.set(leaf, 0)
    return tree.total, done, sum(map(len, fresh))


def _follow(path: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        for batch, texts in slices(batches):
            out = []
            doc_ids = batch.column("doc").field("doc_id")
            for i, edits in enumerate(batch.column("edits").to_pylist()):
                sums = batch.column("sums")[i].as_py() or [0, 0]
                row = {"doc_id": doc_ids[i].as_py(), "n_tokens": sums[1], "n_edits": 0, "n_tokens_edited": sums[1]}
                row["n_chars_encoded"] = 0
                if edits:
                    chars = batch.column("chars")[i].as_py()
                    total, done, again = edited_count(encode, texts[i].as_py(), chars, sums, edits)
                    row |= {"n_edits": done, "n_tokens_edited": total, "n_chars_encoded": again}
                out.append(row)
            yield pa.RecordBatch.from_pylist(out, schema=_FIGURES)

    return run


_FIGURES = pa.schema([("doc_id", pa.int64())] + [(n, pa.int64()) for n in ("n_tokens", "n_edits", "n_tokens_edited", "n_chars_encoded")])


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.xxhash64("text").alias("th"), "text")


def build_trees(docs: DataFrame, vocabulary: str) -> DataFrame:
    """``doc_id``, hash of the text, and of each row the leaves' characters and the tree's sums."""
    schema = "doc_id bigint, th bigint, chars array<bigint>, sums array<bigint>"
    return packed(_keyed(docs)).mapInArrow(_build(vocabulary), schema)


def edited_counts(docs: DataFrame, trees: DataFrame, edits: DataFrame, vocabulary: str) -> DataFrame:
    """Token counts of the documents before and after ``edits`` (``doc_id``, ``th``, ``edits``)."""
    same = [F.col("d.doc_id").eqNullSafe(F.col("t.doc_id")), F.col("d.th") == F.col("t.th")]
    trees, edits = (kept.dropDuplicates(["doc_id", "th"]) for kept in (trees, edits))
    rows = _keyed(docs).alias("d").join(trees.alias("t"), same, "left")
    same = [F.col("d.doc_id").eqNullSafe(F.col("e.doc_id")), F.col("d.th") == F.col("e.th")]
    rows = rows.join(edits.alias("e"), same, "left")
    doc = F.struct(F.col("d.doc_id").alias("doc_id"), F.col("d.text").alias("text")).alias("doc")
    rows = rows.select(doc, "t.chars", "t.sums", F.col("e.edits").cast(EDITS).alias("edits"))
    figures = "doc_id bigint, n_tokens bigint, n_edits bigint, n_tokens_edited bigint, n_chars_encoded bigint"
    return rows.mapInArrow(_follow(vocabulary), figures)


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("replacement", pa.string())]))
    for batch, texts in slices(batches):
        found = [
            [
                {"start": m.start(), "stop": m.end(), "replacement": new}
                for new, pattern in REDACTED.items()
                for m in pattern.finditer(t)
            ]
            for t in texts.to_pylist()
        ]
        keep = pa.array([bool(f) for f in found])
        doc = batch.column("doc")
        columns = [doc.field("doc_id"), doc.field("th"), pa.array(found, kind)]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "th", "edits"]).filter(keep)


def redactions(docs: DataFrame) -> DataFrame:
    """The edits that put a mark for mail addresses and long secrets."""
    return packed(_keyed(docs)).mapInArrow(_find, f"doc_id bigint, th bigint, edits {EDITS}")
