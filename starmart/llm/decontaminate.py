"""Benchmark decontamination by suffix arrays.

Each slice of the documents is a shard with a suffix array over its words. Every benchmark suffix (a window of
``window`` words at each item word, or a shorter item as a whole) is binary-searched in it, which gives the interval of
all occurrences; each occurrence is followed further to the longest verbatim match. Suffixes whose first two words
begin no benchmark suffix cannot match and are left out of the array. There is no shuffle: the benchmark goes to the
documents, in blocks of at most ``BLOCK_BYTES`` of text, one pass of the same stage for each block.

Defined results: a null or empty text has no words and is clean; a null or empty item has no windows; a null item_id
hits words but is not listed; items that share an id count once; every row is judged by itself, so repeated rows and
repeated ids stay; a very long text is a slice of its own and searched whole; other columns are carried in a struct, so
their names never clash; empty tables give no rows (documents) or clean documents (benchmark).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from starmart.llm.common import ALNUM, flat, lists, packed, ranges, slices, words

# Benchmark text that one pass carries: the bound of what is broadcast.
BLOCK_BYTES = 16 << 20

FOUND = (
    "n_words bigint, spans array<struct<start:bigint,end:bigint>>, items array<string>, "
    "longest struct<item_id:string,item_word:bigint,doc_word:bigint,n_words:bigint>"
)
_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])
_MATCH = pa.struct(
    [("item_id", pa.string()), ("item_word", pa.int64()), ("doc_word", pa.int64()), ("n_words", pa.int64())]
)


class _Index:
    """The suffixes of one block of items, as arrays."""

    def __init__(self, ids: list[str | None], texts: list[str | None], window: int):
        raw, bounds = flat(pa.array([t or "" for t in texts], pa.large_string()))
        hashes, _, first = words(raw, bounds, ALNUM)
        self.ids, self.window = ids, window
        self.vocabulary, codes = np.unique(hashes, return_inverse=True)
        sizes = np.diff(first)
        # Every item is followed by zeros, which equal no word, so that matches end with it.
        padded = sizes + window
        self.item_at = np.concatenate([[0], np.cumsum(padded)])
        self.words = np.zeros(int(padded.sum()) + 1, np.int64)
        self.words[ranges(self.item_at[:-1], sizes)] = codes + 1
        self.suffixes = ranges(self.item_at[:-1], np.maximum(sizes - window + 1, (sizes > 0).astype(np.int64)))
        item = np.searchsorted(self.item_at, self.suffixes, "right") - 1
        length = np.minimum(sizes[item], window)
        keys = _keys(self.words, self.suffixes, window)
        order = np.argsort(keys, kind="stable")
        self.suffixes, item, length, keys = self.suffixes[order], item[order], length[order], keys[order]
        new = np.ones(len(keys), bool)
        new[1:] = (keys[1:] != keys[:-1]) | (length[1:] != length[:-1])
        self.at = np.flatnonzero(new)  # first suffix of each distinct window
        self.count = np.diff(np.append(self.at, len(keys)))
        self.item, self.length = item, length[self.at]
        self.low = keys[self.at]
        high = _columns(self.words, self.suffixes[self.at], window)
        high[np.arange(window)[None, :] >= self.length[:, None]] = 0xFFFFFFFF
        self.high = _bytes(high)
        pairs = self.words[self.suffixes] * (len(self.vocabulary) + 1) + self.words[self.suffixes + 1]
        self.pairs = np.unique(pairs[length >= 2] if window > 1 else pairs[:0])
        single = np.zeros(len(self.vocabulary) + 1, bool)
        single[self.words[self.suffixes[length == 1]]] = True
        self.single = single

    def codes(self, hashes: np.ndarray) -> np.ndarray:
        """Word numbers from 1; 0 for words that no item has."""
        if not len(self.vocabulary):
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at + 1, 0)


def _columns(codes: np.ndarray, at: np.ndarray, window: int) -> np.ndarray:
    out = np.zeros((len(at), window), np.uint32)
    open_ = np.ones(len(at), bool)
    for k in range(window):
        value = codes[np.minimum(at + k, len(codes) - 1)]
        open_ &= value > 0  # nothing behind an unknown word or an end can belong to a match
        out[:, k] = np.where(open_, value, 0)
    return out


def _bytes(columns: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(columns.astype(">u4")).view(f"S{4 * columns.shape[1]}").reshape(-1)


def _keys(codes: np.ndarray, at: np.ndarray, window: int) -> np.ndarray:
    """Sort keys of the suffixes at these places: their first words, big-endian."""
    return _bytes(_columns(codes, at, window))


def _occurrences(index: _Index, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in the shard where a benchmark window occurs, and which one."""
    follower = np.append(codes[1:], 0)
    start = index.single[codes] & (codes > 0)
    if len(index.pairs):
        pair = codes * (len(index.vocabulary) + 1) + follower
        at = np.minimum(np.searchsorted(index.pairs, pair), len(index.pairs) - 1)
        start |= (codes > 0) & (follower > 0) & (index.pairs[at] == pair)
    places = np.flatnonzero(start)
    keys = _keys(codes, places, index.window)
    order = np.argsort(keys, kind="stable")  # the shard's suffix array
    array, keys = places[order], keys[order]
    low = np.searchsorted(keys, index.low, "left")
    high = np.searchsorted(keys, index.high, "right")
    n = np.maximum(high - low, 0)
    return array[ranges(low, n)], np.repeat(np.arange(len(n)), n)


def _longest(index: _Index, codes: np.ndarray, places: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Length of the longest verbatim match that begins at each occurrence, and the benchmark place it matches.

    All benchmark suffixes with the window are followed word by word; a step keeps those that go on as the document does.
    """
    n = index.count[kinds]
    owner = np.repeat(np.arange(len(places)), n)
    other = index.suffixes[ranges(index.at[kinds], n)]
    length = index.length[kinds].copy()
    best = np.full(len(places), np.iinfo(np.int64).max)
    np.minimum.at(best, owner, other)
    depth = length[owner]
    while len(owner):
        a = codes[np.minimum(places[owner] + depth, len(codes) - 1)]
        b = index.words[np.minimum(other + depth, len(index.words) - 1)]
        on = (a == b) & (a > 0)
        owner, other, depth = owner[on], other[on], depth[on] + 1
        if len(owner):
            length[owner] = depth
            head = np.concatenate([[True], owner[1:] != owner[:-1]])
            best[owner[head]] = np.minimum.reduceat(other, np.flatnonzero(head))
    return length, best


def _search(block, window: int, first_block: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = block.value
        for batch, texts in slices(batches):
            raw, bounds = flat(texts)
            hashes, _, first = words(raw, bounds, ALNUM)
            sizes = np.diff(first)
            # A zero after each document keeps matches within it.
            at = first[:-1] + np.arange(len(sizes))
            codes = np.zeros(len(hashes) + len(sizes) + 1, np.int64)
            codes[ranges(at, sizes)] = index.codes(hashes)
            places, kinds = _occurrences(index, codes)
            row = np.searchsorted(at, places, "right") - 1
            spans: list[list] = [[] for _ in sizes]
            items: list[list] = [[] for _ in sizes]
            longest: list[dict | None] = [None] * len(sizes)
            if not first_block:
                for i, old in enumerate(batch.column("found").to_pylist()):
                    spans[i] = [(s["start"], s["end"]) for s in old["spans"]]
                    items[i], longest[i] = old["items"], old["longest"]
            if len(places):
                depth, matched = _longest(index, codes, places, kinds)
                order = np.lexsort((kinds, places))
                for i, group in _groups(row[order], order):
                    begin = places[group] - at[i]
                    spans[i] = _merged(spans[i], begin, index.length[kinds[group]])
                    used = np.unique(kinds[group])
                    found = {index.ids[k] for k in index.item[ranges(index.at[used], index.count[used])]} - {None}
                    items[i] = sorted(found.union(items[i]))
                    top = group[np.argmax(depth[group])]
                    if longest[i] is None or depth[top] > longest[i]["n_words"]:
                        k = int(np.searchsorted(index.item_at, matched[top], "right")) - 1
                        longest[i] = {
                            "item_id": index.ids[k],
                            "item_word": int(matched[top] - index.item_at[k]),
                            "doc_word": int(places[top] - at[i]),
                            "n_words": int(depth[top]),
                        }
            found = pa.StructArray.from_arrays(
                [
                    pa.array(sizes.astype(np.int64)),
                    _span_lists(spans),
                    pa.array(items, pa.list_(pa.string())),
                    pa.array(longest, _MATCH),
                ],
                names=["n_words", "spans", "items", "longest"],
            )
            yield pa.RecordBatch.from_arrays([batch.column("doc"), found], names=["doc", "found"])

    return run


def _groups(rows: np.ndarray, values: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    cuts = np.flatnonzero(np.diff(rows)) + 1
    heads = rows[np.concatenate([[0], cuts])] if len(rows) else []
    return zip(map(int, heads), np.split(values, cuts), strict=True)


def _merged(old: list[tuple[int, int]], begin: np.ndarray, length: np.ndarray) -> list[tuple[int, int]]:
    """Union of the spans, touching ones joined."""
    s = np.concatenate([[a for a, _ in old], begin]).astype(np.int64)
    e = np.concatenate([[b for _, b in old], begin + length]).astype(np.int64)
    order = np.argsort(s, kind="stable")
    s, e = s[order], np.maximum.accumulate(e[order])
    cut = np.flatnonzero(s[1:] > e[:-1]) + 1
    return list(zip(s[np.concatenate([[0], cut])].tolist(), e[np.append(cut - 1, len(e) - 1)].tolist(), strict=True))


def _span_lists(spans: list[list[tuple[int, int]]]) -> pa.Array:
    both = np.array([x for s in spans for x in s], np.int64).reshape(-1, 2)
    values = pa.StructArray.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["start", "end"])
    return lists(values, np.array([len(s) for s in spans], np.int64))


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = 10, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """``doc`` (all columns of the row) and ``found``: words, hit word spans, items and the longest verbatim match."""
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    out = packed(docs)
    for k in range(blocks):
        part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).toArrow()
        index = _Index(part.column("item_id").to_pylist(), part.column("text").to_pylist(), window)
        schema = StructType([out.schema["doc"], StructField("found", StructType.fromDDL(FOUND))])
        out = out.mapInArrow(_search(spark.sparkContext.broadcast(index), window, k == 0), schema)
    return out


def digest(found: DataFrame) -> DataFrame:
    """One row of figures per document."""
    hits = F.aggregate("found.spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        F.col("doc.doc_id").alias("doc_id"),
        F.col("found.n_words").alias("n_words"),
        hits.alias("n_hit"),
        F.size("found.items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("found.items"), ","), 256).alias("items_sha256"),
        (F.size("found.spans") > 0).alias("contaminated"),
        F.col("found.spans").alias("spans"),
        F.col("found.longest").alias("longest"),
    )


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """The documents without any benchmark window, columns as they were."""
    found = find_contamination(docs, benchmark, window)
    return found.filter(F.size("found.spans") == 0).select("doc.*")
