"""Bigram language-model scores with stupid backoff, trained on the documents themselves.

Bigrams are dealt out by the hash of their second word, so a bucket has the counts of its bigrams and of its words. An
occurrence that other documents have too takes ``log(others / count of the first word)``, whose divisor is joined from
the count table of the first word's bucket; another one backs off to ``ALPHA`` times the word's share of all words. A
document's own occurrences never count for it, so copies within it don't help. Terms are summed for each document.

Words are `[^\\x20\\x09-\\x0D]+` with A-Z lower-cased. Defined results: a document without words has no score (null); its
first word backs off; a word that no other document has counts ``ALPHA`` times; rows that share an id are one document,
null ids too; a very long text is a slice of its own; only doc_id and text are read, so other columns never clash; an
empty table gives no rows. Hashes are cut to six bytes, a document's sums in a bucket to four.

Between tasks, a slice's bigrams go once with the documents they are in, ids as steps between ascending ones.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import SPACED, flat, packed, slices, words
from starmart.sources.files import store

ALPHA = 0.4
BUCKET_BYTES = 8 << 20
LOW = np.uint64((1 << 48) - 1)
NONE = (1 << 63) - 1


def _six(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values).view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _eight(raw: list[bytes]) -> np.ndarray:
    narrow = np.frombuffer(b"".join(raw), np.uint8).reshape(-1, 6)
    wide = np.zeros((len(narrow), 8), np.uint8)
    wide[:, :6] = narrow
    return wide.view(np.uint64).reshape(-1)


def _small(values: np.ndarray) -> bytes:
    """Counts in the fewest bytes that hold the largest one; the first byte tells how many."""
    kind = np.min_scalar_type(int(values.max(initial=0)))
    return bytes([kind.itemsize]) + values.astype(kind).tobytes()


def _large(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, f"u{raw[0]}", offset=1).astype(np.int64)


def _gaps(ids: np.ndarray) -> bytes:
    """Ascending distinct ids: the first one, then the steps between them."""
    wide = ids.view(np.uint64)
    return wide[:1].tobytes() + _small(np.diff(wide))


def _ids(raw: bytes) -> np.ndarray:
    steps = np.frombuffer(raw, f"u{raw[8]}", offset=9).astype(np.uint64)
    return np.cumsum(np.concatenate([np.frombuffer(raw, np.uint64, 1), steps]), dtype=np.uint64).view(np.int64)


def _bucket(word: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets ascend with the words."""
    return ((word >> np.uint64(16)) * np.uint64(buckets)) >> np.uint64(32)


def _part(ids: np.ndarray, parts: int) -> np.ndarray:
    """Neighbouring ids mostly share a part, so that the steps between them are small."""
    mixed = (ids >> 8).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)


def _cuts(numbers: np.ndarray) -> Iterator[tuple[int, slice]]:
    """The slice of each of these ascending numbers."""
    used, at = np.unique(numbers, return_index=True)
    for number, a, b in zip(used.tolist(), at, [*at, len(numbers)][1:], strict=True):
        yield number, slice(a, b)


def _packets(buckets: int, word: np.ndarray, doc: np.ndarray, before: np.ndarray | None = None) -> list[dict]:
    """For each bucket: its words once, of each the words before it once, how often those come, and in which document."""
    order = np.argsort(word, kind="stable") if before is None else np.lexsort((before, word))
    word, doc = word[order], doc[order]
    before = before if before is None else before[order]
    out = []
    for b, mine in _cuts(_bucket(word, buckets)):
        own, index = np.unique(doc[mine], return_inverse=True)
        pair = np.ones(mine.stop - mine.start, bool)
        pair[1:] = word[mine][1:] != word[mine][:-1]
        if before is not None:
            pair[1:] |= before[mine][1:] != before[mine][:-1]
        pairs = np.flatnonzero(pair)
        kinds, runs = np.unique(word[mine][pairs], return_counts=True)
        one = {"key": b, "ids": _gaps(own), "row": index.astype(_narrow(len(own))).tobytes(), "words": _six(kinds)}
        if before is not None:
            one |= {"runs": _small(runs), "before": _six(before[mine][pairs])}
        out.append(one | {"times": _small(np.diff(pairs, append=len(pair)))})
    return out


def _narrow(n: int) -> type:
    return np.uint16 if n <= 1 << 16 else np.uint32


def _opened(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word, document and, where kept, word before of each occurrence in the bucket, and the documents' ids."""
    ids = [_ids(x) for x in table.column("ids").to_pylist()]
    rows = [np.frombuffer(x, _narrow(len(i))) for x, i in zip(table.column("row").to_pylist(), ids, strict=True)]
    every, index = np.unique(np.concatenate(ids), return_inverse=True)
    at = np.cumsum([0, *map(len, ids)])
    row = np.concatenate([index[r.astype(np.int64) + b] for r, b in zip(rows, at, strict=False)])
    times = np.concatenate([_large(x) for x in table.column("times").to_pylist()])
    word, before = _eight(table.column("words").to_pylist()), np.empty(0, np.uint64)
    if "before" in table.column_names:
        word = np.repeat(word, np.concatenate([_large(x) for x in table.column("runs").to_pylist()]))
        before = np.repeat(_eight(table.column("before").to_pylist()), times)
    return np.repeat(word, times), row, before, every


def _sums(parts: int, ids: np.ndarray, total: np.ndarray, **counts: np.ndarray) -> list[dict]:
    """Figures of these ascending ids, in packets for the parts."""
    order = np.argsort(_part(ids, parts), kind="stable")
    out = []
    for part, mine in _cuts(_part(ids, parts)[order]):
        own = order[mine]
        one = {"kind": "doc", "key": part, "ids": _gaps(ids[own]), "total": total[own].astype(np.float32).tobytes()}
        out.append(one | {name: _small(values[own]) for name, values in counts.items()})
    return out


def _occurrences(buckets: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    schema = pa.schema([("key", pa.int32()), *[(n, pa.binary()) for n in DEALT]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            hashes, _, first = words(*flat(texts), SPACED)
            hashes = (hashes & LOW) | np.uint64(1)
            before = np.concatenate([np.zeros(1, np.uint64), hashes])[: len(hashes)]
            before[first[:-1][np.diff(first) > 0]] = 0
            ids = np.repeat(batch.column("doc").field("id").to_numpy(), np.diff(first))
            yield pa.RecordBatch.from_pylist(_packets(buckets, hashes, ids, before), schema=schema)

    return run


def _groups(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by the keys (the first one decides) and the number of each entry's group in that order."""
    order = np.lexsort(keys[::-1])
    new = np.ones(len(order), bool)
    new[1:] = np.any([k[order][1:] != k[order][:-1] for k in keys], axis=0)
    return order, np.cumsum(new) - 1


def _counts(*keys: np.ndarray) -> np.ndarray:
    """How often each entry's combination of keys comes."""
    order, group = _groups(*keys)
    out = np.empty(len(order), np.int64)
    out[order] = np.bincount(group)[group]
    return out


def _score(buckets: int) -> Callable[[pa.Table], pa.Table]:
    def run(table: pa.Table) -> pa.Table:
        word, row, before, ids = _opened(table)
        own = table.column("key")[0].as_py()
        others = _counts(word, before) - _counts(word, before, row)
        rest = _counts(word) - _counts(word, row)
        seen = (others > 0) & (before > 0)
        terms = np.where(seen, np.log(np.maximum(others, 1)), np.log(np.where(rest > 0, ALPHA * rest, ALPHA * ALPHA)))
        n, backed = np.bincount(row, minlength=len(ids)), np.bincount(row[~seen], minlength=len(ids))
        out = _sums(buckets, ids, np.bincount(row, terms, minlength=len(ids)), n=n, backed=backed)
        kinds, counts = np.unique(word, return_counts=True)
        out.append({"kind": "words", "key": own, "words": _six(kinds), "times": _small(counts), "size": len(word)})
        out += [{"kind": "divide", **p} for p in _packets(buckets, before[seen], ids[row[seen]])]
        return pa.Table.from_pylist(out, schema=_TERMS)

    return run


DEALT = ("ids", "row", "words", "runs", "before", "times")
TERMS = ("ids", "row", "words", "times", "n", "backed", "total")
_TERMS = pa.schema(
    [("kind", pa.string()), ("key", pa.int32()), *[(n, pa.binary()) for n in TERMS], ("size", pa.int64())]
)
PART = ("key", "ids", "n", "backed", "total")
_PART = pa.schema([_TERMS.field(n) for n in PART])


def _divide(buckets: int) -> Callable[[pa.Table], pa.Table]:
    """For each document the logarithms of its first words' counts."""

    def run(table: pa.Table) -> pa.Table:
        kind = table.column("kind").to_numpy(zero_copy_only=False)
        counts = table.filter(pa.array(kind == "words"))
        entries = table.filter(pa.array(kind == "divide"))
        if not len(entries):
            return _PART.empty_table()
        known = _eight(counts.column("words").to_pylist())
        times = np.concatenate([_large(x) for x in counts.column("times").to_pylist()])
        word, row, _, ids = _opened(entries)
        logs = -np.log(times[np.searchsorted(known, word)])
        none = np.zeros(len(ids), np.int64)
        total = np.bincount(row, logs, minlength=len(ids))
        return pa.Table.from_pylist(_sums(buckets, ids, total, n=none, backed=none), schema=_PART)

    return run


def _gathered(table: pa.Table) -> pa.Table:
    """The figures of each document of the part."""
    every, index = np.unique(np.concatenate([_ids(x) for x in table.column("ids").to_pylist()]), return_inverse=True)
    columns = {"id": every}
    for name in ("n", "backed"):
        values = np.concatenate([_large(x) for x in table.column(name).to_pylist()])
        columns[name] = np.bincount(index, values, minlength=len(every)).astype(np.int64)
    values = np.concatenate([np.frombuffer(x, np.float32) for x in table.column("total").to_pylist()])
    return pa.table(columns | {"total": np.bincount(index, values, minlength=len(every))})


def score_documents(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_backed_off`` and ``score``, the mean natural logarithm of a word's score."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-size // bucket_bytes))
    rows = packed(docs.select(F.coalesce("doc_id", F.lit(NONE)).cast("bigint").alias("id"), "text"))
    dealt = rows.mapInArrow(_occurrences(buckets), ", ".join(["key int", *[f"{n} binary" for n in DEALT]]))
    schema = ", ".join(["kind string, key int", *[f"{n} binary" for n in TERMS], "size bigint"])
    terms = store(dealt.groupBy("key").applyInArrow(_score(buckets), schema), "lm_terms")
    divided = terms.filter("kind != 'doc'").select("kind", "key", "ids", "row", "words", "times").groupBy("key")
    divided = divided.applyInArrow(_divide(buckets), "key int, " + ", ".join(f"{n} binary" for n in PART[1:]))
    parts = terms.filter("kind = 'doc'").select(*PART).unionByName(divided)
    scores = parts.groupBy("key").applyInArrow(_gathered, "id bigint, n bigint, backed bigint, total double")
    every = terms.filter("kind = 'words'").agg(F.coalesce(F.sum("size"), F.lit(0)).alias("all")).scalar()
    score = (F.col("total") - F.col("backed") * F.log(every)) / F.col("n")
    named = docs.select("doc_id", F.coalesce("doc_id", F.lit(NONE)).cast("bigint").alias("id"))
    return named.join(scores, "id", "left").select(
        "doc_id",
        F.coalesce("n", F.lit(0)).alias("n_words"),
        F.coalesce("backed", F.lit(0)).alias("n_backed_off"),
        score.alias("score"),
    )
