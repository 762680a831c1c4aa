"""What the search for repeated passages costs in bytes and memory, and that its parts stay exact."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from starmart.llm import repeats
from tests.llm import brute


def _text(rng, size):
    words = ["the", "ening", "thon", "and", "erst", "of", "nd.\n", "éaux"]
    out = ""
    while len(out) < size:
        out += rng.choice(words) + rng.choice(["", " "])
    return out


def _batch(texts, **more):
    ids = pa.array(range(len(texts)), pa.int64())
    doc = pa.StructArray.from_arrays([ids, pa.array(texts, pa.string())], names=["doc_id", "text"])
    columns = {"doc": doc, "id": ids, "th": ids, "part": pa.array([0] * len(texts), pa.int32()), **more}
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def _listed(texts):
    """The texts with the anchors that others have too."""
    dealt = pa.Table.from_batches(repeats._deal(1)(iter([_batch(texts)])))
    returned = repeats._returned("anchors", 8)(repeats._shared(dealt))
    listed = dict(zip(returned["id"].to_pylist(), returned["anchors"].to_pylist(), strict=True))
    return pa.array([[listed[i]] if i in listed else None for i in range(len(texts))], pa.list_(pa.binary()))


def _moved(batches):
    return sum(len(value) for b in batches for row in b.to_pylist() for value in row.values() if isinstance(value, bytes))


def test_packets_hold_few_bytes_for_each_anchor_and_context():
    rng = random.Random(5)
    texts = [_text(rng, 2_000) for _ in range(100)]
    row = repeats._found(pa.array(texts, pa.large_string()))[3]
    dealt = list(repeats._deal(1)(iter([_batch(texts)])))
    assert _moved(dealt) <= 10 * len(row) + 20 * len(texts)
    around = list(repeats._contexts(1, 1)(iter([_batch(texts, anchors=_listed(texts))])))
    occurrences = sum(len(b["which"][0].as_py()) // 4 for b in around)
    assert occurrences > 1_000 and _moved(around) < 0.8 * repeats.SIDE * occurrences


def test_anchors_are_sought_in_small_pieces():
    rng = np.random.default_rng(2)
    raw = rng.integers(97, 123, 2 << 20).astype(np.uint8)
    tracemalloc.start()
    repeats.anchors(raw, np.array([0, len(raw)]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 16 * len(raw)


@pytest.mark.parametrize("letters", [1, 2, 200])
def test_anchors_of_texts_across_pieces(letters, monkeypatch):
    rng = np.random.default_rng(letters)
    raw = rng.integers(0, letters, 4_000).astype(np.uint8)
    bounds = np.concatenate([[0, 0], np.sort(rng.integers(0, 4_001, 30)), [4_000]])
    place, found = repeats.anchors(raw, bounds)
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        one, hashes = repeats.anchors(raw[a:b], np.array([0, b - a]))
        mine = (place >= a) & (place + repeats.GRAM <= b)
        assert (place[mine] - a).tolist() == one.tolist() and found[mine].tolist() == hashes.tolist()
        for start in range(b - a - repeats.LENGTH + 1):
            assert ((one >= start) & (one <= start + repeats.REACH)).any()
    monkeypatch.setattr(repeats, "PIECE_BYTES", 1_000)
    again = repeats.anchors(raw, bounds)
    assert again[0].tolist() == place.tolist() and again[1].tolist() == found.tolist()


@pytest.mark.parametrize("letters", [1, 2, 200])
def test_transform_is_that_of_sorted_suffixes(letters):
    rng = np.random.default_rng(letters)
    texts = rng.integers(1, letters + 1, (60, repeats.SIDE)).astype(np.uint8)
    texts[np.arange(repeats.SIDE)[None, :] >= rng.integers(0, repeats.SIDE + 1, 60)[:, None]] = 0
    texts[10:20] = texts[0]
    strings = [bytes(t).rstrip(b"\0") for t in texts]
    want = sorted((s[o:], i, o) for i, s in enumerate(strings) for o in range(len(s) + 1))
    before, row, offset = repeats.transform(texts)
    assert list(zip(row.tolist(), offset.tolist(), strict=True)) == [(i, o) for _, i, o in want]
    assert before.tolist() == [strings[i][o - 1] if o else 0 for _, i, o in want]


def _passages():
    rng = random.Random(9)
    texts = [_text(rng, rng.randrange(20, 900)) for _ in range(60)]
    for n in range(20, 60):
        other = texts[rng.randrange(n)]
        at = rng.randrange(len(other))
        texts[n] = texts[n][:300] + other[at : at + rng.randrange(40, 300)] + texts[n][300:]
    return texts


def test_contexts_are_merged_in_small_parts(monkeypatch):
    sizes, real = [], repeats.smallest_ids
    monkeypatch.setattr(repeats, "PART_CONTEXTS", 50)
    monkeypatch.setattr(repeats, "smallest_ids", lambda texts, ids: sizes.append(len(texts)) or real(texts, ids))
    texts = _passages()
    repeats._spans(pa.Table.from_batches(repeats._contexts(1, 1)(iter([_batch(texts, anchors=_listed(texts))]))))
    assert sum(sizes) > 250 and max(sizes) < 100


@pytest.mark.parametrize("contexts", [3, repeats.PART_CONTEXTS])
def test_passages_in_many_small_parts(contexts, monkeypatch):
    """All of the contexts in one bucket and in parts of a few, some of them empty."""
    monkeypatch.setattr(repeats, "PART_CONTEXTS", contexts)
    texts = _passages()
    anchors = _listed(texts)
    found = repeats._spans(pa.Table.from_batches(repeats._contexts(1, 1)(iter([_batch(texts, anchors=anchors)]))))
    spans = repeats._returned("spans", 16)(found)
    parts = dict(zip(spans["id"].to_pylist(), spans["spans"].to_pylist(), strict=True))
    parts = pa.array([[parts[i]] if i in parts else None for i in range(len(texts))], pa.list_(pa.binary()))
    (cut,) = repeats._cut(1)(iter([_batch(texts, anchors=anchors, parts=parts)]))
    want = sorted(brute.repeats(list(enumerate(texts))))
    assert cut["kept_sha256"].to_pylist() == [w[4] for w in want] and any(w[2] for w in want)


def test_passages_in_many_small_buckets(spark):
    rows = list(enumerate(_passages()))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = repeats.digest(repeats.remove_repeats(docs, bucket_bytes=700, context_bucket_bytes=300))
    columns = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert sorted(tuple(r) for r in found.select(*columns).collect()) == sorted(brute.repeats(rows))
