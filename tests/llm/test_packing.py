"""Packed sequences against whole encodings and the limits."""

import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from starmart.llm import packing
from starmart.llm.packing import Limits, Piece, Pool
from starmart.llm.queries import PACKED_VOCABULARY, all_queries, vocabulary_path
from tests.llm import brute
from tests.llm.test_edges import ROWS

PATH = vocabulary_path(PACKED_VOCABULARY)
SCHEMA = "doc_id bigint, text string, prompt string, part int, ids string, doc string"


def check_pieces(rows, want):
    """Every id of every example in one piece, sequences without gaps; returns their lengths."""
    parts, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        parts[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    assert set(parts) == {i for i, _ in want}
    for i, ids in want:
        own = sorted(parts[i], key=lambda r: r.start)
        assert [r.start for r in own] == np.cumsum([0] + [r.length for r in own[:-1]]).tolist()
        assert sum(r.length for r in own) == len(ids) and {r.doc_tokens for r in own} == {len(ids)}
        for r in own:
            assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes())
    for own in sequences.values():
        own.sort()
        assert [a for a, _ in own] == np.cumsum([0] + [n for _, n in own[:-1]]).tolist()
    return [sum(n for _, n in own) for own in sequences.values()]


def test_query(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    lengths = check_pieces(all_queries()["op12_pack"](spark, sf_dir).collect(), brute.example_ids(docs, PATH))
    assert max(lengths) == 4096 and all(n & (n - 1) == 0 for n in lengths)
    assert sum(n == 4096 for n in lengths) > 0.8 * sum(lengths) / 4096


@pytest.mark.parametrize("limits", [Limits(), Limits(64, 3, 40), Limits(64, 3, 64, cut=False), Limits(8, 1, 8)])
def test_edges(spark, limits):
    rows = [(100 + k, t) for k, (_, t) in enumerate(ROWS)]
    # A word that no vocabulary entry ends, and strings of added tokens.
    rows += [(200, "a<|endoftext|>B <|startoftext|> c"), (201, "<|ENDOFTEXT|>"), (202, "É é  x y\x1cz")]
    frame = spark.createDataFrame([(*r, "p", 1, "x", "d") for r in rows], SCHEMA)
    path = packing.write_packed(frame, PATH, limits, window_rows=4)
    sequences = packing.read_packed(spark, path)
    lengths = check_pieces(packing.digest(sequences).collect(), brute.example_ids(rows, PATH))
    assert max(lengths) <= limits.tokens
    for r in sequences.collect():
        assert len(r.segments) <= limits.segments and r.n_tokens <= limits.tokens and r.n_loss <= limits.loss
    if limits.cut:
        assert all(n & (n - 1) == 0 for n in lengths)


def test_null_and_repeated_ids(spark):
    rows = [(None, "one"), (None, "one"), (5, "two words"), (5, None)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    out = packing.digest(packing.read_packed(spark, packing.write_packed(frame, PATH))).collect()
    got, want = defaultdict(int), defaultdict(int)
    for r in out:
        got[r.doc_id] += r.length
    for i, ids in brute.example_ids(rows, PATH):
        want[i] += len(ids)
    assert got == want
    none = packing.read_packed(spark, packing.write_packed(frame.limit(0), PATH))
    assert packing.digest(none).count() == 0


def test_prompts_bear_no_loss(spark):
    rows = [(i, f"answer number {i} " * (1 + i % 7), "question " * (i % 11)) for i in range(300)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, q string")
    limits = Limits(128, 6, 64)
    sequences = packing.read_packed(spark, packing.write_packed(frame, PATH, limits, prompt="q")).collect()
    loss = defaultdict(int)
    for r in sequences:
        assert r.n_loss == sum(s.loss for s in r.segments) <= 64 and len(r.segments) <= 6 and r.n_tokens <= 128
        for s in r.segments:
            loss[s.doc_id] += s.loss
    assert loss == {i: len(ids) for i, ids in brute.example_ids([r[:2] for r in rows], PATH)}


@settings(max_examples=60, deadline=None)
@given(
    st.lists(st.tuples(st.integers(1, 90), st.integers(0, 90)), max_size=40),
    st.builds(Limits, st.integers(1, 64), st.integers(1, 8), st.integers(1, 64), st.booleans()),
)
def test_any_pool(examples, limits):
    pool = Pool(limits)
    for i, (n, prompt) in enumerate(examples):
        pool.add(Piece(i, 0, n, min(prompt, n - 1)))
    seen = defaultdict(list)
    for own in packing.pack(pool, last=True):
        tokens = sum(p.tokens for p in own)
        assert 0 < tokens <= limits.tokens and len(own) <= limits.segments and sum(p.loss for p in own) <= limits.loss
        assert not limits.cut or tokens == limits.tokens or tokens & (tokens - 1) == 0
        for p in own:
            seen[p.example] += range(p.start, p.stop)
    assert {i: list(range(n)) for i, (n, _) in enumerate(examples)} == {i: sorted(s) for i, s in seen.items()}


def test_the_fuller_limit_chooses():
    """With loss nearly used up, the example with more prompt goes first though it has fewer tokens."""
    pool = Pool(Limits(100, 10, 50, cut=False))
    for piece in (Piece(0, 0, 48, 0), Piece(1, 0, 30, 29), Piece(2, 0, 2, 0)):
        pool.add(piece)
    first = next(packing.pack(pool, last=True))
    assert {p.example for p in first} == {0, 1} and sum(p.loss for p in first) == 49
