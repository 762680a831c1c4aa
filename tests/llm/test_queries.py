"""Registered corpus queries against brute-force versions on the small tables."""

import zlib

import pytest

import corpus_pipeline
from starmart.llm import near_dup, quality_model
from starmart.llm.queries import all_queries, vocabulary_path
from starmart.llm.token_counts import REDACTED
from tests.llm import brute

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]


@pytest.fixture(scope="module")
def texts(documents):
    return [(d[0], d[1]) for d in documents]


def result(spark, name, *columns):
    return sorted(tuple(r) for r in all_queries()[name](spark, SF_DIR).select(*columns).collect())


def test_contamination(spark, texts):
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    columns = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert result(spark, "op1_decontaminate", *columns) == sorted(brute.contamination(texts, items))


def test_mix(spark, documents):
    want = brute.targets([(d[0], d[3], d[1]) for d in documents])
    source = {d[0]: d[3] for d in documents}
    taken, top = dict.fromkeys(want, 0), dict.fromkeys(want, 0)
    for doc_id, size, source_size, target, words in result(
        spark, "op2_mix_sources", "doc_id", "size", "source_size", "target", "taken"
    ):
        own = source[doc_id]
        assert (source_size, pytest.approx(target)) == want[own] and words in (0, size, 2 * size)
        taken[own], top[own] = taken[own] + words, max(top[own], size)
    for own, (_, target) in want.items():
        assert abs(taken[own] - target) <= 2 * top[own]


def test_lm_score(spark, texts):
    got = result(spark, "op3_lm_score", "doc_id", "n_words", "n_backed_off", "score")
    for mine, theirs in zip(got, sorted(brute.lm_scores(texts)), strict=True):
        assert mine[:3] == theirs[:3] and mine[3] == pytest.approx(theirs[3])


def test_token_files(spark, texts):
    got = result(spark, "op4_token_files", "doc_id", "start", "n_tokens", "ids_crc32")
    assert got == brute.tokens(texts, vocabulary_path())


def test_edited_counts(spark, texts):
    got = result(spark, "op5_edited_token_counts", "doc_id", "n_tokens", "n_edits", "n_tokens_edited")
    assert got == sorted(brute.redacted_counts(texts, vocabulary_path(), REDACTED))


def test_repeats(spark, texts):
    columns = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert result(spark, "op6_remove_repeats", *columns) == sorted(brute.repeats(texts))


def test_shards(spark, texts):
    rows = result(spark, "op7_shard", "doc_id", "size", "text_crc32", "shard", "slot", "grown_shard")
    assert [r[:3] for r in rows] == sorted((d, len(t.encode()) + 1, zlib.crc32(t.encode())) for d, t in texts)
    for shard in range(8):
        slots = sorted(r[4] for r in rows if r[3] == shard)
        assert slots == list(range(len(slots)))
    assert all(r[5] in (r[3], 8) for r in rows)
    assert rows == result(spark, "op7_shard", "doc_id", "size", "text_crc32", "shard", "slot", "grown_shard")


def test_near_duplicates(spark, texts):
    got = result(spark, "op8_near_duplicates", "doc_id", "n_shingles", "component_id", "kept")
    assert got == sorted(brute.components(texts))


def test_quality_score_held_out(spark):
    rows = {r.doc_id: r for r in all_queries()["op9_quality_score"](spark, "/root/testdata/sf0.01").collect()}
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()
    held = [(rows[r.doc_id].predicted, r.quality) for r in labels if rows[r.doc_id].held_out]
    assert len(held) > 50 and sum(p == q for p, q in held) / len(held) > 0.9


def test_quality_score_with_fewer_unlabelled_rows(spark):
    """The fit is stable: held-out verdicts hardly change with the number of unlabelled rows."""
    sf_dir = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    found = {}
    for n in (250, 500, quality_model.UNLABELLED):
        scored = quality_model.digest(quality_model.score_quality(docs, labels, carry=["doc_id"], unlabelled=n))
        found[n] = {r.doc_id: r.predicted for r in scored.collect() if r.held_out}
    whole = found.pop(quality_model.UNLABELLED)
    for some in found.values():
        assert sum(some[i] == p for i, p in whole.items()) > 0.95 * len(whole)


def test_quality_rules(spark, texts):
    columns = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    want = [(d, *(r := brute.rule_counts(t)), r[0] < 50 or 100 * r[4] > 50 * r[0]) for d, t in texts]
    assert result(spark, "op10_quality_rules", *columns) == sorted(want)


def test_pipeline(spark, documents):
    """The stages one after the other, each against what it is given."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = documents
    for name, stage in corpus_pipeline.STAGES:
        before, out = rows, stage(spark, docs, SF_DIR)
        rows = sorted(tuple(r) for r in out.collect())
        if name != "token_files":
            assert out.columns == docs.columns and set(rows) <= set(before)
            docs = spark.createDataFrame(rows, docs.schema)
        if name == "quality_rules":  # too few labels for a cutoff: the base rules alone
            want = {d[0] for d in before if not ((r := brute.rule_counts(d[1]))[0] < 50 or 2 * r[4] > r[0])}
        elif name == "near_duplicates":
            want = {r[0] for r in brute.components([d[:2] for d in before], near_dup.Index().shingle) if r[3]}
        elif name == "decontamination":
            items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
            want = {r[0] for r in brute.contamination([d[:2] for d in before], items) if not r[5]}
        elif name == "token_files":
            assert rows == sorted(brute.tokens([d[:2] for d in before], vocabulary_path()))
        if name in ("quality_rules", "near_duplicates", "decontamination"):
            assert {r[0] for r in rows} == want
