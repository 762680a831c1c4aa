"""Many sets a little above and below the similarity, where rounds of stars end and rarest shingles decide."""

import random

import pytest

from starmart.llm import near_dup
from tests.llm import brute


@pytest.mark.parametrize("shingle", [2, 5])
def test_sets_around_the_similarity(spark, monkeypatch, shingle):
    rng, rows = random.Random(3), []
    for group in range(12):
        for _ in range(25):
            words = [f"g{group}w{k}" for k in range(120)]
            for _ in range(rng.choice([1, 3, 5, 6, 7, 8, 10])):
                words[rng.randrange(120)] = f"x{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(words)))
    met = []

    def counted(*args, real=near_dup._across):
        met.append((out := real(*args)).count())
        return out

    monkeypatch.setattr(near_dup, "_across", counted)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = near_dup.digest(near_dup.near_duplicates(docs, near_dup.Index(shingle=shingle)))
    got = sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in found.collect())
    assert got == sorted(brute.components(rows, shingle)) and 1 < len({r[2] for r in got}) < len(rows)
    # Far fewer pairs than the 3,600 of all groups come to be compared.
    assert met and met[0] < 1_000
