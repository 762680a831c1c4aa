"""Targets of many sources."""

import random
import re

import pytest

from starmart.llm import mixing, prefix
from tests.llm import brute


def rows(n):
    rng = random.Random(n)
    names = [None, *[f"site-{i}" for i in range(n - 1)]]
    return [(i, s, "w " * rng.choice([0, 1, 2, 3, 50])) for i, s in enumerate(names)] + [(n, "site-0", None)]


@pytest.mark.parametrize("weights", [(5, 2, 1), (0.5, 0.2, 0.1), (1, 1000)])
def test_targets(spark, weights):
    own = rows(700)
    docs = spark.createDataFrame(own, "doc_id bigint, source string, text string")
    sizes = docs.select("source", mixing.n_spaced_words(docs.text).alias("size"))
    got = {r.source: (r.source_size, r.target) for r in mixing.source_targets(sizes, weights).collect()}
    want = brute.targets(own, weights)
    assert got.keys() == want.keys()
    for source, (size, target) in want.items():
        assert got[source] == (size, pytest.approx(target))


def test_no_task_sees_every_source(spark, monkeypatch):
    """Windows without a partition run over ``_part``, the totals of the partitions, only."""
    seen, store = [], prefix.store

    def kept(df, name):
        seen.append(df)
        return store(df, name)

    monkeypatch.setattr(prefix, "store", kept)
    sizes = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "source string, size bigint")
    seen.append(mixing.source_targets(sizes))
    plans = "\n".join(df._jdf.queryExecution().analyzed().toString() for df in seen)
    specs = re.findall(r"windowspecdefinition\((\w*)", plans)
    assert set(specs) <= {"_part"}, specs
