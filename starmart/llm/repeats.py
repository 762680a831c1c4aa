"""Removal of repeated passages by merging Burrows-Wheeler transforms.

A byte goes if it is in a ``LENGTH``-byte string that also starts in a document with a smaller doc_id. Any two equal
strings of that length share their minimizer (the ``GRAM`` bytes with the least hash in them, an anchor), so:

1. each document's anchors are dealt out by hash, with a hash of the bytes around them (the context). Anchors of one id
   are dropped; where all contexts of an anchor are equal, the whole context is repeated;
2. the contexts of the other anchors are dealt out; equal ones fold into one, with the smallest id that has it;
3. in each bucket, contexts are parted by their anchors and form shards. Every shard gets its transform by one suffix sort; the shards' transforms are
   merged by refining their interleave, one symbol deeper with each pass, without sorting suffixes again. The blocks
   after ``LENGTH`` passes are the suffixes with that common prefix: the repeated intervals, each with its smallest id;
4. the spans go back to their documents.

What a bucket finds goes back to the slices that its packets came from, one row for each, and only there to documents.

Buckets grow in number with the input, not in size, up to 2**32 of them. Defined results: a null text is empty; texts shorter than ``LENGTH``
bytes stay whole; null ids come after all others; rows with one id are not repeats of each other, and rows equal in id
and text get the same result; empty tables give no rows; other columns are carried in a struct.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from starmart.llm.common import BYTE_VALUES, SLICE_BYTES, flat, mix, packed, powers, ranges, slices, span_hashes

LENGTH = 50
GRAM = 16
REACH = LENGTH - GRAM  # bytes of context on either side of an anchor
SIDE = 2 * REACH + GRAM
STARTS = SIDE - LENGTH + 1
# Text for each bucket of anchors and of contexts, and contexts for each shard of a bucket.
BUCKET_BYTES = 32 << 20
CONTEXT_BUCKET_BYTES = 8 << 20
SHARD_CONTEXTS = 1_000
# Contexts of a bucket are merged in parts of about so many, by their anchors: what a pass looks up stays in the cache.
PART_CONTEXTS = 4_000
LAST = (1 << 63) - 1
# Minimizers are sought in pieces of so many bytes, whose hashes stay in a core's cache.
PIECE_BYTES = 1 << 16
# Anchors of a bucket meet by so many bytes of their hash; contexts of a wrong match differ and are compared.
HASH_BYTES = 4
# Contexts of a packet; Spark's own codec finds little to save in so short pieces of text.
CODEC = "zstd"
LOW = np.uint64((1 << 8 * HASH_BYTES) - 1)
ALONE = np.uint64(1 << 63)


def _sliding(values: np.ndarray, width: int, reduce: np.ufunc) -> np.ndarray:
    """``reduce`` over each run of ``width`` values, by doubling."""
    out, have = values, 1
    while 2 * have <= width:
        out = reduce(out[:-have], out[have:])
        have *= 2
    rest = width - have
    return reduce(out[: len(out) - rest], out[rest:]) if rest else out


def _eights(raw: np.ndarray, kind: str) -> np.ndarray:
    """The eight bytes from each place on, as one number."""
    out = np.empty(max(len(raw) - 7, 0), np.uint64)
    for k in range(min(8, len(out))):
        out[k::8] = raw[k : k + (len(raw) - k) // 8 * 8].view(kind)
    return out


def anchors(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the minimizers of all strings of ``LENGTH`` bytes within the texts."""
    places, hashes = [], []
    ends = bounds[1:]
    for at in range(0, max(len(raw) - LENGTH + 1, 0), PIECE_BYTES):
        eights = _eights(raw[at : at + PIECE_BYTES + LENGTH - 1], "<u8")
        grams = eights[:-8] * np.uint64(0x9E3779B97F4A7C15)
        grams = ((grams ^ (grams >> np.uint64(32))) + eights[8:]) * np.uint64(0xBF58476D1CE4E5B9)
        high = (grams >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
        least = _sliding(high, REACH + 1, np.minimum)
        # Strings that run over the end of a text do not count.
        for end in ends[slice(*np.searchsorted(ends, [at, at + len(least) + LENGTH]))].tolist():
            least[max(end - LENGTH + 1 - at, 0) : max(end - at, 0)] = 0
        padded = np.zeros(len(least) + 2 * REACH, np.uint32)
        padded[REACH : REACH + len(least)] = least
        found = np.flatnonzero(_sliding(padded, REACH + 1, np.maximum) == high)
        places.append(found + at)
        hashes.append(grams[found])
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    place, first = np.unique(np.concatenate(places), return_index=True)
    # Minima are small numbers: hashed again, they spread evenly.
    return place, mix(np.concatenate(hashes)[first])


def _found(texts: pa.Array) -> tuple[np.ndarray, ...]:
    """The texts' bytes and bounds; of each anchor the hash, the text it is in, and its context's place and size."""
    raw, bounds = flat(texts)
    place, found = anchors(raw, bounds)
    row = np.searchsorted(bounds, place, "right") - 1
    start = np.maximum(place - REACH, bounds[row])
    size = np.minimum(place + GRAM + REACH, bounds[row + 1]) - start
    return raw, bounds, found, row, start, size


def _deal(buckets: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A row for each bucket and slice: anchor hashes, whose they are, and their contexts' hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for n, (batch, texts) in enumerate(slices(batches)):
            raw, _, found, row, start, size = _found(texts)
            context = span_hashes(raw, start, start + size) & np.uint64((1 << 48) - 1)
            new = _first(found, row, context)
            found, row, context = found[new], row[new], context[new]
            more = {"hashes": lambda mine, f=found: _low(f[mine], HASH_BYTES)}
            more |= {"context": lambda mine, c=context: _low(c[mine], 6)}
            yield _rows(buckets, batch, n, found, row, more)

    return run


def _first(found: np.ndarray, row: np.ndarray, context: np.ndarray) -> np.ndarray:
    """Of equal anchors of a text with equal contexts, one."""
    first = np.ones(len(found), bool)
    order = np.argsort(found)
    same = found[order[1:]] == found[order[:-1]]
    twice = order[np.append(same, False) | np.append(False, same)] if len(found) else order
    twice = twice[np.lexsort((context[twice], row[twice], found[twice]))]
    a, b = twice[1:], twice[:-1]
    first[a[(found[a] == found[b]) & (row[a] == row[b]) & (context[a] == context[b])]] = False
    return first


def _low(values: np.ndarray, size: int) -> bytes:
    """The low bytes of each."""
    return np.ascontiguousarray(values).view(np.uint8).reshape(-1, 8)[:, :size].tobytes()


def _wide(raw: list[bytes], size: int) -> np.ndarray:
    narrow = np.frombuffer(b"".join(raw), np.uint8).reshape(-1, size)
    wide = np.zeros((len(narrow), 8), np.uint8)
    wide[:, :size] = narrow
    return wide.view(np.uint64).reshape(-1)


def _rows(
    buckets: int,
    batch: pa.RecordBatch,
    number: int,
    found: np.ndarray,
    row: np.ndarray,
    more: dict[str, Callable[[np.ndarray], bytes]],
) -> pa.RecordBatch:
    """A packet for each bucket with anchors of the slice: by document, its id, text hash and how many follow.

    Anchors come in order of their documents.
    """
    bucket = _bucket(found, buckets)
    order = np.argsort(bucket.astype(np.uint16) if buckets <= 1 << 16 else bucket, kind="stable")
    used, at = np.unique(bucket[order], return_index=True)
    ids, texts = batch.column("id").to_numpy(), batch.column("th").to_numpy()
    name = (batch.column("part")[0].as_py() << 32) + number if len(batch) else 0
    out = []
    for b, mine in zip(used.tolist(), np.split(order, at[1:])[: len(used)], strict=True):
        own, n = np.unique(row[mine], return_counts=True)
        one = {"bucket": b, "slice": name, "ids": ids[own].tobytes(), "ths": texts[own].tobytes()}
        one |= {"n": n.astype(np.uint32).tobytes()}
        one |= {column: value(mine) for column, value in more.items()}
        out.append(one)
    fields = [("bucket", pa.int64()), ("slice", pa.int64())]
    names = ["ids", "ths", "n", *more]
    return pa.RecordBatch.from_pylist(out, schema=pa.schema([*fields, *[(n, pa.binary()) for n in names]]))


def _bucket(found: np.ndarray, buckets: int) -> np.ndarray:
    """From the upper half of the hash, so up to 2**32 buckets."""
    return ((found >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def _named(low: np.ndarray, bucket: np.ndarray | int) -> np.ndarray:
    """An anchor by its bucket and what its bucket knows of its hash."""
    return low | ((np.uint64(bucket) if isinstance(bucket, int) else bucket) & np.uint64((1 << 31) - 1)) << np.uint64(32)


def _column(table: pa.Table, name: str, kind) -> list[np.ndarray]:
    return [np.frombuffer(x, kind) for x in table.column(name).to_pylist()]


@dataclass
class _Bucket:
    """A bucket's documents, packet by packet, and the document of each anchor."""

    ids: np.ndarray
    ths: np.ndarray
    packet: np.ndarray
    slices: np.ndarray
    row: np.ndarray

    @classmethod
    def of(cls, table: pa.Table) -> _Bucket:
        ids, ths, n = (_column(table, name, kind) for name, kind in (("ids", np.int64), ("ths", np.int64), ("n", np.uint32)))
        packet = np.repeat(np.arange(len(ids)), [len(i) for i in ids])
        ids, ths, n = map(np.concatenate, (ids, ths, n))
        return cls(ids, ths, packet, table.column("slice").to_numpy(), np.repeat(np.arange(len(ids)), n))

    def back(self, row: np.ndarray, values: np.ndarray, name: str) -> pa.Table:
        """What was found, a row for each packet: it goes back to the packet's slice."""
        order = np.argsort(row, kind="stable")
        own, at, n = np.unique(row[order], return_index=True, return_counts=True)
        packets, first = np.unique(self.packet[own], return_index=True)
        docs = np.append(first, len(own)).tolist()
        ends = np.append(at, len(row))[docs].tolist()
        values, out = values[order], []
        for k, packet in enumerate(packets.tolist()):
            mine = own[docs[k] : docs[k + 1]]
            one = {"slice": int(self.slices[packet]), "ids": self.ids[mine].tobytes(), "ths": self.ths[mine].tobytes()}
            one |= {"n": n[docs[k] : docs[k + 1]].astype(np.uint32).tobytes()}
            out.append(one | {name: values[ends[k] : ends[k + 1]].tobytes()})
        names = ["ids", "ths", "n", name]
        return pa.Table.from_pylist(out, pa.schema([("slice", pa.int64()), *[(n, pa.binary()) for n in names]]))


def _returned(name: str, size: int) -> Callable[[pa.Table], pa.Table]:
    """Of a slice what its packets brought back, a row for each document; each value has ``size`` bytes."""

    def run(table: pa.Table) -> pa.Table:
        ids, ths, n = (_column(table, c, kind) for c, kind in (("ids", np.int64), ("ths", np.int64), ("n", np.uint32)))
        ids, ths, n = map(np.concatenate, (ids, ths, n))
        raw, ends = b"".join(table.column(name).to_pylist()), np.concatenate([[0], np.cumsum(n, dtype=np.int64)]) * size
        parts: dict[tuple[int, int], list[bytes]] = {}
        for key, a, b in zip(zip(ids.tolist(), ths.tolist(), strict=True), ends[:-1].tolist(), ends[1:].tolist(), strict=True):
            parts.setdefault(key, []).append(raw[a:b])
        columns = [pa.array([k[i] for k in parts], pa.int64()) for i in (0, 1)]
        return pa.table([*columns, pa.array([b"".join(v) for v in parts.values()], pa.binary())], names=["id", "th", name])

    return run


def _shared(table: pa.Table) -> pa.Table:
    """The anchors of each document that another id has too, marked where their contexts are all equal.

    Of marked ones, those of the smallest id itself are left out.
    """
    bucket = _Bucket.of(table)
    found, context = (_wide(table.column(name).to_pylist(), size) for name, size in (("hashes", HASH_BYTES), ("context", 6)))
    order = np.argsort(found, kind="stable")
    found, row, context = found[order], bucket.row[order], context[order]
    heads = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]]))
    size = np.diff(np.append(heads, len(found)))
    who = bucket.ids[row]
    least = np.minimum.reduceat(who, heads)
    several = np.repeat(least != np.maximum.reduceat(who, heads), size)
    alone = np.repeat(np.minimum.reduceat(context, heads) == np.maximum.reduceat(context, heads), size)
    keep = several & (~alone | (who > np.repeat(least, size)))
    found = _named(found, table.column("bucket")[0].as_py())
    return bucket.back(row[keep], np.where(alone, found | ALONE, found)[keep], "anchors")


def _wanted(parts: pa.Array, found: np.ndarray, row: np.ndarray, buckets: int, alone: bool) -> np.ndarray:
    """Which anchors are among those listed for their text."""
    keep, found = np.zeros(len(found), bool), _named(found & LOW, _bucket(found, buckets))
    cuts = np.searchsorted(row, np.arange(len(parts) + 1))
    for i, own in enumerate(parts.to_pylist()):
        if own:
            listed = np.frombuffer(b"".join(own), np.uint64)
            listed = listed[(listed >= ALONE) == alone] & ~ALONE
            mine = slice(cuts[i], cuts[i + 1])
            keep[mine] = np.isin(found[mine], listed)
    return keep


def _contexts(buckets: int, anchor_buckets: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The bytes around the shared anchors, equal ones once, and where they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for n, (batch, texts) in enumerate(slices(batches)):
            raw, bounds, found, row, start, size = _found(texts)
            keep = _wanted(batch.column("anchors"), found, row, anchor_buckets, alone=False)
            found, row, start, size = found[keep], row[keep], start[keep], size[keep]
            text = np.zeros((len(found), SIDE), np.uint8)
            at = np.arange(SIDE)[None, :]
            inside = at < size[:, None]
            # No byte of UTF-8 is above 0xF4, so one up leaves zero for the end.
            text[inside] = raw[(start[:, None] + at)[inside]] + 1

            which = np.zeros(len(found), np.uint32)

            def of(mine: np.ndarray, text=text, which=which) -> bytes:
                own, which[mine] = np.unique(text[mine].view(f"V{SIDE}").reshape(-1), return_inverse=True)
                return pa.compress(own.tobytes(), codec=CODEC, asbytes=True)  # before ``which`` is read

            more = {
                "contexts": of,
                "which": lambda mine, w=which: w[mine].tobytes(),
                "anchor": lambda mine, f=found: _low(f[mine], 1),
                "start": lambda mine, s=start - bounds[row]: s[mine].astype(np.uint32).tobytes(),
            }
            yield _rows(buckets, batch, n, found, row, more)

    return run


def _heads(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of sorted keys, where the run of each begins, and which are in a run of several."""
    new = np.ones(len(keys) + 1, bool)
    new[1:-1] = keys[1:] != keys[:-1]
    head = np.maximum.accumulate(np.where(new[:-1], np.arange(len(keys)), 0))
    return head, np.flatnonzero(~(new[:-1] & new[1:]))


def transform(texts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Burrows-Wheeler transform of strings in rows (zero-padded), with each suffix's row and offset in order.

    Suffixes are sorted by their first eight symbols; where these are equal, by the ranks of the rest, which doubles the
    symbols that are sorted; equal suffixes stay in order of rows.
    """
    side = texts.shape[1]
    size = (texts > 0).sum(1)
    row = np.repeat(np.arange(len(texts)), size + 1)
    offset = ranges(np.zeros(len(texts), np.int64), size + 1)
    # Sorted depths stay below twice the longest suffix, so a rank looked up lies in the row's own padding at most.
    width = 2 * side + 8
    padded = np.zeros((len(texts), width), np.uint8)
    padded[:, :side] = texts
    place = row * width + offset
    keys = _eights(padded.reshape(-1), ">u8")[place]
    order = np.argsort(keys)
    head, tied = _heads(keys[order])
    rank = np.zeros(padded.size, np.uint32)
    rank[place[order]] = head + 1
    depth = 8
    while len(tied):
        own, whole = order[tied], depth > side
        keys = head[tied].astype(np.uint64) << np.uint64(32)
        keys |= (own if whole else rank[place[own] + depth]).astype(np.uint64)
        sort = np.argsort(keys)
        order[tied] = own = own[sort]
        if whole:
            break
        first, several = _heads(keys[sort])
        head[tied] = tied[first]
        rank[place[own]] = tied[first] + 1
        tied = tied[several]
        depth *= 2
    row, offset = row[order], offset[order]
    before = np.where(offset > 0, texts[row, np.maximum(offset - 1, 0)], 0).astype(np.uint8)
    return before, row, offset


def merge(symbols: np.ndarray, step: np.ndarray, rows: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Interleave of suffixes by their first ``depth`` symbols, and the block each is in.

    ``symbols`` are the shards' transforms one after the other, ``step`` leads from a row to that of the suffix one
    symbol longer in the same shard, ``rows`` are where to begin. A pass lists the symbols in the order so far and stably
    moves every suffix behind the symbol before it; suffixes of one block and one symbol form the next block. A suffix
    alone in its block stays alone and is dropped.
    """
    # A row's step and its symbol are looked up at once.
    kind = np.uint32 if len(symbols) <= 1 << 24 else np.uint64
    both = step.astype(kind) << kind(8) | symbols
    block = np.zeros(len(rows), np.uint32)
    for _ in range(depth):
        at = both[rows]
        order = np.argsort(at.astype(np.uint8), kind="stable")
        at, block = at[order], block[order]
        c, rows = at.astype(np.uint8), at >> kind(8)
        new = np.ones(len(rows) + 1, bool)
        new[1:-1] = (c[1:] != c[:-1]) | (block[1:] != block[:-1])
        block = np.cumsum(new[:-1], dtype=np.uint32)
        several = ~(new[:-1] & new[1:])
        rows, block = rows[several], block[several]
    return rows, block


def smallest_ids(texts: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For each context and each of its strings of ``LENGTH`` bytes, the smallest id of a context that has it."""
    whole = np.arange(STARTS)[None, :] + LENGTH <= (texts > 0).sum(1)[:, None]
    out = np.where(whole, ids[:, None], LAST)
    symbols, step, row, offset, before = [], [], [], [], 0
    for at in range(0, len(texts), SHARD_CONTEXTS):
        own, r, o = transform(texts[at : at + SHARD_CONTEXTS])
        lead = np.empty(len(own), np.int64)
        lead[np.argsort(own, kind="stable")] = np.arange(len(own))
        symbols.append(own)
        step.append(lead + before)
        row.append(r + at)
        offset.append(o)
        before += len(own)
    symbols, step, row, offset = map(np.concatenate, (symbols, step, row, offset))
    # After LENGTH passes, suffixes from here on have become those that begin the strings.
    rows, block = merge(symbols, step, np.flatnonzero(offset >= LENGTH), LENGTH)
    if len(rows):
        row, offset = row[rows], offset[rows]
        heads = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
        out[row, offset] = np.repeat(np.minimum.reduceat(ids[row], heads), np.diff(np.append(heads, len(rows))))
    return out


def _spans(table: pa.Table) -> pa.Table:
    """The repeated spans of the bucket's documents."""
    bucket = _Bucket.of(table)
    texts, which, before = [], [], 0
    for own, index in zip(table.column("contexts").to_pylist(), _column(table, "which", np.uint32), strict=True):
        own = pa.decompress(own, (int(index.max()) + 1) * SIDE, codec=CODEC, asbytes=True)
        texts.append(np.frombuffer(own, np.uint8).reshape(-1, SIDE))
        which.append(index.astype(np.int64) + before)
        before += len(texts[-1])
    start = np.concatenate(_column(table, "start", np.uint32)).astype(np.int64)
    both, same = np.unique(np.concatenate(texts).view(f"V{SIDE}").reshape(-1), return_inverse=True)
    texts = both.view(np.uint8).reshape(-1, SIDE)
    which = same[np.concatenate(which)]
    parts = min(-(-len(texts) // PART_CONTEXTS), 256)
    part = (np.concatenate(_column(table, "anchor", np.uint8)).astype(np.uint16) * parts >> 8).astype(np.uint8)
    order = np.argsort(part, kind="stable")
    rows, spans = [], []
    for mine in filter(len, np.split(order, np.searchsorted(part[order], np.arange(1, parts)))):
        at, begin, end = _hits(texts, which[mine], bucket.ids[bucket.row[mine]])
        rows.append(bucket.row[mine[at]])
        spans.append(np.stack([start[mine[at]] + begin, start[mine[at]] + end], axis=1))
    return bucket.back(np.concatenate(rows), np.concatenate(spans), "spans")


def _hits(texts: np.ndarray, which: np.ndarray, who: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where contexts repeat those of smaller ids: which of them, and the spans' begins and ends within it."""
    used, which = np.unique(which, return_inverse=True)
    least = np.full(len(used), LAST, np.int64)
    np.minimum.at(least, which, who)
    smallest = smallest_ids(texts[used], least)
    hit = np.zeros((len(which), STARTS + 2), np.int8)
    hit[:, 1:-1] = smallest[which] < who[:, None]
    turn = np.diff(hit, axis=1)
    at, begin = np.nonzero(turn == 1)
    _, end = np.nonzero(turn == -1)
    return at, begin, end - 1 + LENGTH


def _union(spans: np.ndarray) -> np.ndarray:
    """Spans in order, overlapping and touching ones joined."""
    if not len(spans):
        return spans
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    start, end = spans[:, 0], np.maximum.accumulate(spans[:, 1])
    cut = np.flatnonzero(start[1:] > end[:-1]) + 1
    return np.stack([start[np.concatenate([[0], cut])], end[np.append(cut - 1, len(end) - 1)]], axis=1)


def _cut(buckets: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            parts = batch.column("parts").to_pylist()
            spans = [np.frombuffer(b"".join(p or []), np.int64).reshape(-1, 2) for p in parts]
            listed = np.flatnonzero(batch.column("anchors").is_valid().to_numpy(zero_copy_only=False))
            if len(listed):
                of = pa.array(listed)
                _, bounds, found, row, start, size = _found(texts.take(of))
                keep = _wanted(batch.column("anchors").take(of), found, row, buckets, alone=True) & (size >= LENGTH)
                row, start, size = row[keep], (start - bounds[row])[keep], size[keep]
                cuts = np.searchsorted(row, np.arange(len(listed) + 1))
                both = np.stack([start, start + size], axis=1)
                for i, k in enumerate(listed):
                    spans[k] = np.concatenate([spans[k], both[cuts[i] : cuts[i + 1]]])
            spans = [_union(s) for s in spans]
            kept, removed = [], []
            for text, own in zip(texts.to_pylist(), spans, strict=True):
                raw = text.encode()
                ends = [0, *own[:, 1].tolist()]
                kept.append(b"".join(raw[a:b] for a, b in zip(ends, [*own[:, 0].tolist(), len(raw)], strict=True)))
                removed.append(len(raw) - len(kept[-1]))
            lists = pa.array([s.tolist() for s in spans], pa.list_(pa.list_(pa.int64())))
            digests = [hashlib.sha256(k).hexdigest() for k in kept]
            columns = [batch.column("doc"), pa.array(kept, pa.binary()), lists, pa.array(removed, pa.int64()), pa.array(digests)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc", "kept", "spans", "n_removed", "kept_sha256"])

    return run


def remove_repeats(
    docs: DataFrame, bucket_bytes: int = BUCKET_BYTES, context_bucket_bytes: int = CONTEXT_BUCKET_BYTES
) -> DataFrame:
    """``doc`` (all columns of the row), the bytes that stay (``kept``), the removed ``spans``, ``n_removed``, ``kept_sha256``."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets, context_buckets = (max(1, -(-total // size)) for size in (bucket_bytes, context_bucket_bytes))
    identity = [F.coalesce("doc_id", F.lit(LAST)).cast("bigint").alias("id"), F.xxhash64("text").alias("th")]
    rows = packed(docs, *identity)
    part = F.spark_partition_id().alias("part")
    blobs = "bucket bigint, slice bigint, ids binary, ths binary, n binary"
    back = "slice bigint, ids binary, ths binary, n binary"
    dealt = rows.select("*", part).mapInArrow(_deal(buckets), f"{blobs}, hashes binary, context binary")
    shared = dealt.groupBy("bucket").applyInArrow(_shared, f"{back}, anchors binary")
    shared = shared.groupBy("slice").applyInArrow(_returned("anchors", 8), "id bigint, th bigint, anchors binary")
    # At most a document's own anchors are collected.
    shared = shared.groupBy("id", "th").agg(F.collect_list("anchors").alias("anchors"))
    listed = rows.join(shared, ["id", "th"], "left")
    around = listed.filter("anchors IS NOT NULL").select("*", part).mapInArrow(
        _contexts(context_buckets, buckets), f"{blobs}, contexts binary, which binary, anchor binary, start binary"
    )
    spans = around.groupBy("bucket").applyInArrow(_spans, f"{back}, spans binary")
    spans = spans.groupBy("slice").applyInArrow(_returned("spans", 16), "id bigint, th bigint, spans binary")
    spans = spans.groupBy("id", "th").agg(F.collect_list("spans").alias("parts"))
    cut = listed.join(spans, ["id", "th"], "left").select("doc", "anchors", "parts")
    fields = StructType.fromDDL("kept binary, spans array<array<bigint>>, n_removed bigint, kept_sha256 string").fields
    return cut.mapInArrow(_cut(buckets), StructType([cut.schema["doc"], *fields]))


def digest(found: DataFrame) -> DataFrame:
    """One row of figures per document."""
    return found.select(
        F.col("doc.doc_id").alias("doc_id"),
        (F.octet_length("kept") + F.col("n_removed")).cast("bigint").alias("n_bytes"),
        "n_removed",
        F.size("spans").cast("bigint").alias("n_spans"),
        "kept_sha256",
    )
