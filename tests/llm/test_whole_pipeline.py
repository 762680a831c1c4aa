"""run() of the pipeline on a table with enough labels for cutoffs, and its stages, against plain Python."""

import hashlib
import math
import os
import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

import pytest

import corpus_pipeline
from starmart.llm import mixing, near_dup, quality_rules
from starmart.llm.queries import vocabulary_path
from starmart.sources.files import shared_dir
from tests.llm import brute
from tests.llm.test_edges import ROWS

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
ITEMS = ["one two three four five six seven eight nine ten eleven", "q r s"]


def documents():
    rng, out = random.Random(11), []
    for i in range(1900):
        words = [f"w{rng.randrange(5000)}" for _ in range(rng.randrange(45, 90))]
        for mark, share in (("#", 0.15), ("X", 0.2), ("!", 0.25)):
            if rng.random() < share * (i % 3 == 0):
                k = rng.randrange(1, 45)
                words[:k] = [w + mark * rng.randrange(1, 4) for w in words[:k]]
        if i % 50 == 7:
            words[5:5] = ITEMS[i % 2].split()
        lines = [" ".join(words[:20]), " ".join(words[20:])] + [f"line {i}"] * (rng.randrange(9) if i % 6 == 0 else 1)
        lang = "en" if i < 1500 else rng.choice(["de", None])
        text = "\n".join(lines) if i % 40 else (out[-1][1] + " end" if out else None)
        out.append((i, text, lang, rng.choice(["a", "b", "c", "d", None]), len(text or "")))
    labels = [(i, int(i % 3 > 0 or i % 90 == 0), 0) for i in range(1550)] + [(1, 0, 0), (5000, 1, 0), (None, 1, 0)]
    return out, labels


@pytest.fixture(scope="module")
def case(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("whole"))
    docs, labels = documents()
    items = list(enumerate(ITEMS))
    spark.createDataFrame(docs, DOCS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, docs, labels, items


def ratios(text):
    text = text or ""
    n_words, chars, symbols, dup_lines, repeat_words = brute.rule_counts(text)
    n_lines = sum(1 for line in text.split("\n") if brute.SPACED.search(line))
    counts = {
        "symbols": (symbols, chars),
        "dup_lines": (dup_lines, n_lines),
        "repeats": (repeat_words, n_words),
        "capitals": (len(re.findall("[A-Z]", text)), chars),
        "shouts": (text.count("!"), chars),
    }
    return n_words < 50 or 2 * repeat_words > n_words, {r: n / max(of, 1) for r, (n, of) in counts.items()}


def tail(k, n, p):
    """P(X <= k) of a binomial (n, p), exactly."""
    return sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))


def good(docs, labels):
    """Documents that the rules keep, and the cutoffs by language."""
    quality = {}
    for doc_id, q, _ in labels:
        quality[doc_id] = min(q, quality.get(doc_id, 1))
    found = {d[0]: ratios(d[1]) for d in docs}
    held = defaultdict(dict)
    for doc_id, text, lang, *_ in docs:
        if quality.get(doc_id) == 1 and not found[doc_id][0]:
            held[lang].setdefault(text, found[doc_id][1])
    cutoffs = defaultdict(dict)
    p, allowed = Fraction(5, 100) / 5, Fraction(5, 100) / (len(held) * 5)
    for lang, own in held.items():
        for rule in quality_rules.RULES:
            for cutoff in sorted(quality_rules.CUTOFFS, reverse=True):
                if tail(sum(v[rule] > cutoff for v in own.values()), len(own), p) > allowed:
                    break
                cutoffs[lang][rule] = cutoff
    keeps = {
        d[0]
        for d in docs
        if not found[d[0]][0] and not any(found[d[0]][1][r] > c for r, c in cutoffs.get(d[2], {}).items())
    }
    return [d for d in docs if d[0] in keeps], dict(cutoffs)


def copies(docs, seed=mixing.SEED):
    """doc_id -> copies: one random offset for each source, equal steps in the order of size and then of a hash."""
    md5 = lambda s: hashlib.md5(s.encode()).hexdigest()
    want = brute.targets([(d[0], d[3], d[1]) for d in docs])
    out = {}
    for source, (size, target) in want.items():
        own = [(len(brute.SPACED.findall(d[1] or "")), md5(f"{seed}/{d[0]}"), d[0]) for d in docs if d[3] == source]
        at = int(md5(f"{seed}/" + ("null" if source is None else f"s{source}"))[:12], 16) / 2**48
        rate = target / size if size else 0.0
        for rank, (*_, doc_id) in enumerate(sorted(own)):
            out[doc_id] = math.floor((rank + 1) * rate + at) - math.floor(rank * rate + at)
    return out


def test_cutoffs(spark, case):
    path, docs, labels, _ = case
    kept, cutoffs = good(docs, labels)
    base = sum(not ratios(d[1])[0] for d in docs)
    assert len(cutoffs["en"]) >= 3 and len(set(cutoffs["en"].values())) > 1 and 0 < len(kept) < base
    tables = [spark.read.parquet(f"{path}/{t}.parquet") for t in ("documents", "labels")]
    judged = quality_rules.apply_rules(*tables)
    got = quality_rules.digest(judged).collect()
    assert sorted(r.doc_id for r in got if r.kept) == [d[0] for d in kept]
    chosen = {r.lang: r.cutoffs for r in judged.select("doc.lang", "cutoffs").collect() if r.cutoffs}
    assert chosen == cutoffs


def test_mixing(spark, case):
    _, docs, _, _ = case
    mixed = mixing.mixed_documents(spark.createDataFrame(docs, DOCS)).collect()
    want = {i: n for i, n in copies(docs).items() if n}
    assert set(want.values()) >= {1, 2} and len(want) < len(docs)
    assert Counter(r.doc_id for r in mixed) == want and {tuple(r) for r in mixed} <= set(docs)


def test_run(spark, case):
    path, docs, labels, items = case
    kept, _ = good(docs, labels)
    one = {r[0] for r in brute.components([d[:2] for d in kept], near_dup.Index().shingle) if r[3]}
    single = [d for d in kept if d[0] in one]
    hit = {r[0] for r in brute.contamination([d[:2] for d in single], items) if r[5]}
    clean = [d for d in single if d[0] not in hit]
    assert len(kept) > len(single) > len(clean)
    n = copies(clean)
    mix = [d[:2] for d in clean for _ in range(n[d[0]])]
    got = sorted(map(tuple, corpus_pipeline.run(spark, path).collect()))
    assert got == sorted(brute.tokens(mix, vocabulary_path()))


@pytest.mark.parametrize("rows", [[], ROWS], ids=["none", "rows"])
def test_run_on_odd_tables(spark, tmp_path, rows):
    """Nulls, empty, long and repeated texts, no labels, an empty benchmark, and columns named like the stages' own."""
    names = "doc string, row int, copies int, size bigint, hash string, kept boolean, rid bigint, node int, component int"
    docs = [(i, t, None if k % 2 else "en", ["a", None][k % 2], 0) for k, (i, t) in enumerate(rows)]
    docs += [(50 + k, " ".join(f"v{k}w{n}" for n in range(60 + k)), "de", "b", 1) for k in range(4) if rows]
    full = [(*d, "d", 1, 2, 3, "h", True, 4, 5, 6) for d in docs]
    spark.createDataFrame(full, f"{DOCS}, {names}").write.parquet(f"{tmp_path}/documents.parquet")
    for name, schema in (("labels", "doc_id bigint, quality int, toxic int"), ("benchmark", "item_id bigint, text string")):
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    kept = [d for d in docs if not ratios(d[1])[0]]
    one = {r[0] for r in brute.components([d[:2] for d in kept], near_dup.Index().shingle) if r[3]}
    n = copies([d for d in kept if d[0] in one])
    got = sorted(map(tuple, corpus_pipeline.run(spark, str(tmp_path)).collect()))
    want = brute.tokens([d[:2] for d in kept if d[0] in one for _ in range(n[d[0]])], vocabulary_path())
    assert got == sorted(want) and bool(got) == bool(rows)


def test_a_stage_deletes_what_the_last_one_left(spark, case, tmp_path):
    path, docs, _, _ = case
    before = set(leftovers(spark))
    stored = spark.createDataFrame(docs, DOCS)
    for name, stage in corpus_pipeline.STAGES[1:4]:
        out = stage(spark, stored, path)
        out.write.parquet(f"{tmp_path}/{name}")
        stored = spark.read.parquet(f"{tmp_path}/{name}")
        assert not [p for p in set(leftovers(spark)) - before if name != "near_duplicates" and "near_" in p]
    corpus_pipeline.STAGES[4][1](spark, stored, path).collect()
    assert not [p for p in set(leftovers(spark)) - before if "mix_documents" in p]


def leftovers(spark):
    folder = shared_dir(spark).removeprefix("file:")
    return os.listdir(folder) if os.path.isdir(folder) else []
