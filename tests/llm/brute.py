"""The operators' results by plain Python over lists of rows: the definitions, without their methods."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

ASCII_LOWER = {c: c + 32 for c in range(0x41, 0x5B)}
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")


def contamination(docs, items, window=10):
    """docs: (doc_id, text); items: (item_id, text)."""
    windows = defaultdict(set)
    for item_id, text in items:
        w = ALNUM.findall((text or "").translate(ASCII_LOWER))
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            windows[tuple(w[i : i + n])].add(item_id)
    sizes = sorted({len(w) for w in windows})
    out = []
    for doc_id, text in docs:
        w = ALNUM.findall((text or "").translate(ASCII_LOWER))
        hit, found = set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                ids = windows.get(tuple(w[i : i + n]))
                if ids is not None:
                    hit.update(range(i, i + n))
                    found |= {str(x) for x in ids if x is not None}
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(found), digest, bool(hit)))
    return out


def shingles(text, n):
    w = SPACED.findall((text or "").translate(ASCII_LOWER))
    return {tuple(w)} if 0 < len(w) < n else {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}


def components(docs, n=2, similarity=80):
    """(doc_id, n_shingles, component_id, kept) of (doc_id, text) with distinct ids."""
    sets = [shingles(text, n) for _, text in docs]
    owners = defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            owners[g].append(i)
    parent = list(range(len(docs)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, s in enumerate(sets):
        common = Counter(j for g in s for j in owners[g] if j < i)
        for j, both in common.items():
            if 100 * both >= similarity * (len(s) + len(sets[j]) - both):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    smallest = {}
    for i, (doc_id, _) in enumerate(docs):
        smallest[root(i)] = min(smallest.get(root(i), doc_id), doc_id)
    return [
        (doc_id, len(sets[i]), smallest[root(i)], smallest[root(i)] == doc_id) for i, (doc_id, _) in enumerate(docs)
    ]


def targets(rows, weights=(5, 2, 1)):
    """source -> (source_size, target) of (doc_id, source, text), by resharing again and again."""
    size = defaultdict(int)
    for _, source, text in rows:
        size[source] += len(SPACED.findall(text or ""))
    order = sorted((s for s in size if s is not None)) + ([None] if None in size else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    goal = 1.5 * sum(size.values())
    full = set()
    while True:
        rest = goal - sum(2 * size[s] for s in full)
        open_ = [s for s in order if s not in full]
        total = sum(weight[s] for s in open_)
        target = {s: 2 * size[s] if s in full else rest * weight[s] / total for s in order}
        above = {s for s in open_ if target[s] > 2 * size[s]}
        if not above:
            return {s: (size[s], target[s]) for s in order}
        full |= above


def rule_counts(text):
    text = text or ""
    w = SPACED.findall(text)
    lines = [line for line in text.split("\n") if SPACED.search(line)]
    places = defaultdict(list)
    for i in range(len(w) - 2):
        places[tuple(w[i : i + 3])].append(i)
    hit = {i + k for at in places.values() if len(at) > 1 for i in at for k in range(3)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit))


def tokens(docs, path, end=0):
    """(doc_id, start, n_tokens, crc) of (doc_id, text), by encoding whole texts."""
    import numpy as np
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    out, start = [], 0
    for doc_id, text in sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0)):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, end]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def repeats(docs, length=50):
    """(doc_id, n_bytes, n_removed, n_spans, sha) of (doc_id, text)."""
    first = {}
    raw = [(doc_id, (text or "").encode()) for doc_id, text in docs]
    for doc_id, b in raw:
        for i in range(len(b) - length + 1):
            g = b[i : i + length]
            if g not in first or doc_id < first[g]:
                first[g] = doc_id
    out = []
    for doc_id, b in raw:
        cut = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if first[b[i : i + length]] < doc_id:
                cut[i : i + length] = b"\x01" * length
        spans = len(re.findall(b"\x01+", bytes(cut)))
        kept = bytes(x for x, c in zip(b, cut, strict=True) if not c)
        out.append((doc_id, len(b), sum(cut), spans, hashlib.sha256(kept).hexdigest()))
    return out


def lm_scores(docs, alpha=0.4):
    """(doc_id, n_words, n_backed_off, score) of (doc_id, text) with distinct ids."""
    import math

    texts = [(d, SPACED.findall((t or "").translate(ASCII_LOWER))) for d, t in docs]
    uni = Counter(w for _, own in texts for w in own)
    bi = Counter(p for _, own in texts for p in zip(own, own[1:], strict=False))
    every, out = sum(uni.values()), []
    for doc_id, own in texts:
        u, b, total, backed = Counter(own), Counter(zip(own, own[1:], strict=False)), 0.0, 0
        for before, w in zip([None, *own], own, strict=False):
            others = bi[before, w] - b[before, w]
            if before is not None and others:
                total += math.log(others / uni[before])
                continue
            backed += 1
            rest = uni[w] - u[w]
            total += math.log((alpha * rest if rest else alpha * alpha) / every)
        out.append((doc_id, len(own), backed, total / len(own) if own else None))
    return out


def redacted_counts(docs, path, patterns):
    """(doc_id, n_tokens, n_edits, n_tokens_edited) by editing and encoding whole texts."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)

    def count(text):
        return len(tokenizer.encode(text, add_special_tokens=False).ids)

    out = []
    for doc_id, text in docs:
        text = text or ""
        found = sorted((m.start(), m.end(), new) for new, p in patterns.items() for m in p.finditer(text))
        parts, at, n = [], 0, 0
        for start, stop, new in found:
            if n and start < at:
                continue
            parts += [text[at:start], new]
            at, n = stop, n + 1
        out.append((doc_id, count(text), n, count("".join(parts) + text[at:])))
    return out


def clusters(vectors, k=8, rounds=10, seed=3, dims=64):
    """(vec_id, cluster, distance, cluster inertia, inertia, sha) of (vec_id, vector), in Python's whole numbers."""
    import math

    kept = []
    for i, v in vectors:
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, tuple(math.floor(1024 * x) for x in v)))
    named = [(hashlib.sha256(f"{seed}:{'null' if i is None else i}".encode()).hexdigest(), x) for i, x in kept]
    centroids = [x for _, x in sorted(named)[:k]]

    def nearest(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        own = defaultdict(list)
        for _, x in kept:
            own[nearest(x)[1]].append(x)
        centroids = [
            tuple(sum(column) // len(own[n]) for column in zip(*own[n], strict=True)) if n in own else c
            for n, c in enumerate(centroids)
        ]
    found = [(i, *nearest(x)[::-1]) for i, x in kept]
    inertia = Counter()
    for _, n, d in found:
        inertia[n] += d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return [(i, n, d, inertia[n], sum(inertia.values()), sha[n]) for i, n, d in found]


def importance(docs, target, buckets=10_000, percent=5, min_words=20):
    """(doc_id, n_features, weight, score, rank) of (doc_id, text); ``target`` has texts."""
    import math

    def features(text):
        w = ALNUM.findall((text or "").translate(ASCII_LOWER))
        grams = [" ".join(w[i : i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)]
        return len(w), [zlib.crc32(g.encode()) % buckets for g in grams]

    own = [(i, *features(t)) for i, t in docs]
    s, t = Counter(b for _, _, f in own for b in f), Counter(b for x in target for b in features(x)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [
        math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets))))
        for b in range(buckets)
    ]
    rows = []
    for i, n, f in own:
        h = int(hashlib.sha256(f"42:{'null' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        rows.append((i, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in rows if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    # Rows that share an id and a score take the ranks in any order.
    ranks = defaultdict(list)
    for rank, r in enumerate(able[: percent * len(able) // 100], 1):
        ranks[r].append(rank)
    return [(r[0], *r[2:], ranks[r].pop(0) if ranks[r] else None) for r in rows]


def example_ids(docs, path, end=2):
    """Per (doc_id, text): its ids and the end id."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    return [(i, [*tokenizer.encode(t or "", add_special_tokens=False).ids, end]) for i, t in docs]
