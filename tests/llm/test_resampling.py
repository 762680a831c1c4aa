"""Importance resampling against plain counting of every feature."""

import zlib

import pyarrow as pa
import pytest

from starmart.llm import resampling
from starmart.llm.queries import all_queries
from starmart.llm.resampling import Resampling
from tests.llm import brute
from tests.llm.test_edges import LONG

COLUMNS = ("doc_id", "n_features", "weight", "score", "rank")
SCHEMA = "doc_id bigint, text string, row int, line string, n bigint, weight string, features int, _hot int"


def plain(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


def test_query(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    assert plain(all_queries()["op13_resample"](spark, sf_dir)) == sorted(brute.importance(docs, target), key=repr)


LINE = "One two, three four five six seven eight nine ten eleven twelve"
TEXTS = [None, "", LONG, LONG, " \n\t\n", "solo", "solo\nsolo\n\n...\nTWO words", "Ünï ½ 日本\r\n\U0001f600 " * 20]
TEXTS += ["x" * 700 + " y " + "x" * 700 + "\n" + "x" * 700, f"{LINE}\n{LINE}", "a\nb\nc\nd", "\n" + LINE + "\n"]
TEXTS += [f"{LINE}\n" * (k % 5 + 1) + f"word{k} " * 30 for k in range(40)]


@pytest.mark.parametrize("hot", [4_000, 3])
def test_edges(spark, monkeypatch, hot):
    """With all lines broadcast, and with most of them joined."""
    monkeypatch.setattr(resampling, "HOT_LINES", hot)
    plan = Resampling(buckets=97, percent=30, min_words=3)
    ids = [None, 3, 3, None, *range(10, 10 + len(TEXTS) - 4)]
    rows = list(zip(ids, TEXTS, strict=True))
    frame = spark.createDataFrame([(*r, 1, "l", 2, "w", 3, 4) for r in rows], SCHEMA).repartition(5)
    for target in ([LINE, None, "", "solo\nword3 word3\ntwo"], []):
        wanted = spark.createDataFrame([(t,) for t in target], "text string")
        drawn = resampling.draw(resampling.weigh(frame, wanted, plan), plan)
        want = brute.importance(rows, target, buckets=97, percent=30, min_words=3)
        assert plain(resampling.digest(drawn, plan)) == sorted(want, key=repr)
        chosen = resampling.resample(frame, wanted, plan)
        assert chosen.columns == frame.columns
        assert sorted(repr(r.doc_id) for r in chosen.collect()) == sorted(repr(r[0]) for r in want if r[4])


def test_empty(spark):
    frame = spark.createDataFrame([], "doc_id bigint, text string")
    assert plain(resampling.digest(resampling.draw(resampling.weigh(frame, frame)))) == []


def test_crc_of_joined_words():
    words = ["a", "Ω", "x" * 64, "y" * 65, "z" * 3000, "b"]
    found = resampling.Words.of(pa.array([" ".join(words), "\n".join(words)], pa.large_string()))
    joined = [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
    within = [(t, c) for text, crc in found.within_lines(3) for t, c in zip(text, crc, strict=True)]
    over = [(t, c) for text, crc in found.over_line_ends(3) for t, c in zip(text, crc, strict=True)]
    low = [zlib.crc32(g.encode()) for g in joined]
    assert sorted(c for t, c in within if t == 0) == sorted(low) and not [1 for t, _ in over if t == 0]
    assert sorted(c for t, c in within + over if t == 1) == sorted(low)
