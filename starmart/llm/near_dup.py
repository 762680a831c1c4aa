"""Near-duplicate documents by a multi-index Hamming join over b-bit MinHash signatures.

A signature has ``chunks`` chunks of ``width`` 16-bit minima. If two signatures differ in at most
``chunks * (errors + 1) - 1`` minima, then by the pigeonhole principle some chunk has at most ``errors`` differences, so
with every choice of ``errors`` positions left out of every chunk as index keys, the pair meets under a key. All pairs
under that distance are found; more distant ones mostly too (9 chunks of 5, one error: a pair of Jaccard 0.8 exactly
meets with probability 1 - 6e-6). Links are confirmed on the full shingle sets.

Documents with the same set form a class, and only one of it is indexed. Under a key every class is compared with the
key's smallest one. In further rounds, each key that still has several components compares one drawn class with all that
are not connected with it, while that links a tenth of what it compares. The rest are compared class by class where two
unconnected ones of the open keys share one of their rarest shingles, without which they cannot be similar enough. So a
key that a third of all classes share costs a few comparisons each, and no link that could connect anything is missed.

Defined results: words are `[^\\x20\\x09-\\x0D]+` with A-Z lower-cased; a text of fewer words than a shingle has is one
shingle, a null or empty text has none and is linked with nothing. Rows are told apart by a row number, so repeated rows
are exact copies of each other and rows that share a doc_id with other texts stay apart. ``component_id`` is the smallest
doc_id of the component, null ids last. Empty tables give no rows; other columns are carried in a struct.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from starmart.llm.common import SPACED, flat, mix, packed, slices, words
from starmart.llm.scratch import Scratch


@dataclass(frozen=True)
class Index:
    """Shape of signatures and keys."""

    shingle: int = 5
    similarity: int = 80  # percent
    chunks: int = 9
    width: int = 5
    errors: int = 1

    @property
    def minima(self) -> int:
        return self.chunks * self.width

    @property
    def distance(self) -> int:
        """Signatures this far apart are sure to meet under a key."""
        return self.chunks * (self.errors + 1) - 1


def _shingles(hashes: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all word n-grams, and the index of each text's first one."""
    sizes = np.diff(first)
    counts = np.where(sizes >= n, sizes - n + 1, (sizes > 0).astype(np.int64))
    row = np.repeat(np.arange(len(sizes)), counts)
    begin = np.concatenate([[0], np.cumsum(counts)])
    at = first[:-1][row] + np.arange(begin[-1]) - begin[:-1][row]
    end = first[1:][row]
    out = np.zeros(len(at), np.uint64)
    for k in range(n):
        value = np.where(at + k < end, hashes[np.minimum(at + k, max(len(hashes) - 1, 0))], np.uint64(0))
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + value + np.uint64(k + 1))
    return out, begin


def _multipliers(n: int) -> tuple[np.ndarray, np.ndarray]:
    seeds = mix(np.arange(1, 2 * n + 1, dtype=np.uint64))
    return (seeds[:n].astype(np.uint32) | np.uint32(1)), seeds[n:].astype(np.uint32)


def _sign(index: Index) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors, shifts = _multipliers(index.minima)
        for batch, texts in slices(batches):
            hashes, _, first = words(*flat(texts), SPACED)
            grams, begin = _shingles(hashes, first, index.shingle)
            size, total, xor = (np.zeros(len(texts), t) for t in (np.int64, np.uint64, np.uint64))
            signature = np.zeros((len(texts), index.minima), np.uint16)
            full = np.flatnonzero(np.diff(begin))
            for i in full:
                own = np.unique(grams[begin[i] : begin[i + 1]])
                size[i], total[i], xor[i] = len(own), own.sum(), np.bitwise_xor.reduce(mix(own))
            if len(full):
                short = (grams >> np.uint64(32)).astype(np.uint32)
                for k in range(index.minima):
                    least = np.minimum.reduceat(short * factors[k] + shifts[k], begin[:-1][full])
                    signature[full, k] = (least * np.uint32(0x9E3779B1)) >> np.uint32(16)
            raw = signature.tobytes()
            step = 2 * index.minima
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc"),
                    pa.array(size),
                    pa.array(total.view(np.int64)),
                    pa.array(xor.view(np.int64)),
                    pa.array([raw[step * i : step * i + step] for i in range(len(texts))], pa.binary()),
                ],
                names=["doc", "n_shingles", "set_sum", "set_xor", "signature"],
            )

    return run


def _index_keys(index: Index) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    kept = list(itertools.combinations(range(index.width), index.width - index.errors))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = batch.column("node").to_numpy()
            signature = np.frombuffer(b"".join(batch.column("signature").to_pylist()), np.uint16)
            signature = signature.reshape(len(nodes), index.chunks, index.width).astype(np.uint64)
            keys = []
            for c in range(index.chunks):
                for number, positions in enumerate(kept):
                    key = np.full(len(nodes), c * len(kept) + number + 1, np.uint64)
                    for p in positions:
                        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + signature[:, c, p])
                    keys.append(key)
            both = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(both.view(np.int64)), pa.array(np.tile(nodes, len(keys)))], names=["key", "node"]
            )

    return run


def _shingle_set(text: str, n: int) -> set:
    own = text.encode("utf-8", "surrogatepass").lower().split()
    return {tuple(own)} if 0 < len(own) < n else set(zip(*(own[k:] for k in range(n)), strict=False))


def _confirm(index: Index) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, left = None, set()
        for batch in batches:
            keep = np.zeros(len(batch), bool)
            a, b = batch.column("a").to_pylist(), (x.as_py() for x in batch.column("text_b"))
            texts = batch.column("text_a")
            for i, text in enumerate(b):
                if a[i] != last:
                    last, left = a[i], _shingle_set(texts[i].as_py(), index.shingle)
                right = _shingle_set(text, index.shingle)
                both = len(left & right)
                keep[i] = 100 * both >= index.similarity * (len(left) + len(right) - both)
            yield batch.filter(pa.array(keep)).select(["a", "b"])

    return run


def connected(edges: DataFrame, scratch: Scratch, name: str = "component") -> DataFrame:
    """``node`` and the smallest node of its component, for every node of the edges (``a``, ``b``).

    Large-star and small-star steps in turn: every node's greater, then its smaller neighbours hang themselves on its
    smallest one, until nothing changes. Groups are only reduced by ``min``, never gathered.
    """

    def marks(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    current = scratch.store(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    before = marks(current)
    while before[0]:
        both = current.union(current.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b"))
        large = large.distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        current = scratch.store(small.union(least.select("a", "m")).distinct(), name)
        after = marks(current)
        if after == before:
            break
        before = after
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        current.select("b", "b").distinct()
    )


def _stars(open_: DataFrame, number: int) -> DataFrame:
    """One class of each key, another one each time, with those that are not connected with it."""
    drawn = F.struct(F.xxhash64("node", F.lit(number)).alias("draw"), "node", "component")
    centers = open_.groupBy("key").agg(F.min(drawn).alias("center"))
    met = open_.join(centers, "key").filter("component != center.component")
    return met.select(
        F.least("node", "center.node").alias("a"), F.greatest("node", "center.node").alias("b")
    ).distinct()


def _tokens(index: Index) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            hashes, _, first = words(*flat(texts), SPACED)
            grams, begin = _shingles(hashes, first, index.shingle)
            sets = [np.unique(grams[a:b]) for a, b in itertools.pairwise(begin)]
            nodes = np.repeat(batch.column("doc").field("node").to_numpy(), [len(s) for s in sets])
            tokens = np.concatenate(sets).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(tokens)], names=["node", "token"])

    return run


# Words of 64 parity bits that a set is known by to sets it may be similar to.
PARITY_WORDS = 4


def _parity(word: int) -> Column:
    """Of each of the word's bits, whether an odd number of the set's shingles falls on it."""
    token = F.col("token")
    mine = F.shiftrightunsigned(token, 6).bitwiseAND(F.lit(PARITY_WORDS - 1)) == word
    bit = F.expr("shiftleft(1L, cast(token & 63 AS int))")
    return F.bit_xor(F.when(mine, bit).otherwise(F.lit(0).cast("bigint")))


def _across(open_: DataFrame, texts: DataFrame, index: Index, scratch: Scratch) -> DataFrame:
    """The pairs of unconnected open classes that share one of their rarest shingles.

    Two sets of at least the wanted similarity share a shingle among the first ``n - ceil(similarity * n) + 1`` of each,
    in any common order; in that of rarity, a class with too many shingles of its own meets nothing. Under a shingle,
    only classes outside its most frequent component look for partners. Places in the order and parity bits of whole sets
    rule out most pairs just below the similarity before they are made; none above it.
    """
    nodes = open_.select("node", "component").distinct()
    tokens = packed(texts.join(nodes.select("node"), "node", "left_semi"))
    tokens = scratch.store(tokens.mapInArrow(_tokens(index), "node bigint, token bigint"), "near_tokens")
    seen = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    rarest = tokens.join(seen, "token").groupBy("node").agg(
        F.sort_array(F.collect_list(F.struct("df", "token"))).alias("tokens"),
        F.count(F.lit(1)).alias("n"),
        F.array(*[_parity(word) for word in range(PARITY_WORDS)]).alias("bits"),
    )
    needed = F.ceil(F.col("n") * index.similarity / 100)
    first = F.slice("tokens", 1, (F.col("n") - needed + 1).cast("int"))
    rarest = rarest.select("node", "n", "bits", F.posexplode(first).alias("pos", "t")).filter("t.df > 1")
    rarest = rarest.select("node", "n", "bits", "pos", F.col("t.token").alias("token")).join(nodes, "node")
    rarest = scratch.store(rarest, "near_rarest")
    most = rarest.groupBy("token", "component").agg(F.count(F.lit(1)).alias("c"))
    most = most.groupBy("token").agg(F.max(F.struct("c", "component")).alias("most"), F.count(F.lit(1)).alias("k"))
    few = rarest.join(most.filter("k > 1"), "token").filter("component != most.component")
    x = few.select(
        "token", F.col("most.component").alias("top"), *[F.col(c).alias(f"x_{c}") for c in ("node", "component", "n", "pos", "bits")]
    )
    y = rarest.select("token", *[F.col(c).alias(f"y_{c}") for c in ("node", "component", "n", "pos", "bits")])
    # As many shingles must be common; behind the first common one, enough of them must be left in both.
    common = F.ceil((F.col("x_n") + F.col("y_n")) * index.similarity / (100 + index.similarity))
    enough = F.least(F.col("x_n") - F.col("x_pos"), F.col("y_n") - F.col("y_pos")) >= common
    # Each shingle of only one set turns one parity bit, so as many bits as differ, at least, are not common.
    apart = sum((F.bit_count(F.col("x_bits")[k].bitwiseXOR(F.col("y_bits")[k])) for k in range(PARITY_WORDS)), F.lit(0))
    enough &= apart <= F.col("x_n") + F.col("y_n") - 2 * common
    # Two classes outside the most frequent component look for each other: one of them is enough.
    once = (F.col("y_component") == F.col("top")) | (F.col("x_node") < F.col("y_node"))
    met = x.join(y, "token").filter((F.col("x_component") != F.col("y_component")) & once & enough)
    return met.select(F.least("x_node", "y_node").alias("a"), F.greatest("x_node", "y_node").alias("b")).distinct()


def near_duplicates(docs: DataFrame, index: Index = Index(), lent: Scratch | None = None) -> DataFrame:
    """``doc`` (all columns of the row), ``rid``, ``n_shingles``, ``component_id`` and ``kept_row``: one row of each
    component has it, the first with the component's id.

    ``lent`` takes the tables that the result still reads, to be released once it is stored."""
    scratch = Scratch()
    fields = [StructField(c, LongType()) for c in ("n_shingles", "set_sum", "set_xor")]
    out = packed(docs)
    schema = StructType([out.schema["doc"], *fields, StructField("signature", BinaryType())])
    signed = out.mapInArrow(_sign(index), schema).withColumn("rid", F.monotonically_increasing_id())
    signed = scratch.store(signed, "near_signed")

    same = ["n_shingles", "set_sum", "set_xor"]
    sets = signed.filter("n_shingles > 0").select("rid", "signature", *same)
    nodes = sets.groupBy(*same).agg(F.min(F.struct("rid", "signature")).alias("first"))
    nodes = scratch.store(nodes.select(*same, F.col("first.rid").alias("node"), "first.signature"), "near_nodes")

    keys = nodes.select("node", "signature").mapInArrow(_index_keys(index), "key bigint, node bigint")
    centers = keys.groupBy("key").agg(F.min("node").alias("center"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = scratch.store(keys.join(centers.select("key", "center"), "key"), "near_shared")
    wanted = shared.select("node").distinct()
    texts = signed.select(F.col("rid").alias("node"), F.col("doc.text").alias("text"))
    texts = scratch.store(texts.join(wanted, "node", "left_semi"), "near_texts")

    def confirmed(pairs: DataFrame) -> DataFrame:
        left = texts.withColumnsRenamed({"node": "a", "text": "text_a"})
        right = texts.withColumnsRenamed({"node": "b", "text": "text_b"})
        both = pairs.join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b")
        return scratch.store(both.mapInArrow(_confirm(index), "a bigint, b bigint"), "near_links")

    stars = shared.filter("node != center").select(F.col("center").alias("a"), F.col("node").alias("b")).distinct()
    tried = scratch.store(stars, "near_stars")
    joined = connected(confirmed(tried), scratch)
    open_, number, last = shared.select("key", "node"), 0, False
    while not last:
        loose = open_.join(joined, "node", "left").select(
            "key", "node", F.coalesce("component", "node").alias("component")
        )
        n = loose.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"))
        keyed = n.groupBy("key").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("squares"))
        keyed = scratch.store(keyed.filter("n * n > squares"), "near_open_keys")
        rows, left = keyed.agg(F.sum("n"), F.sum((F.col("n") * F.col("n") - F.col("squares")) / 2)).first()
        if not rows:
            break
        open_ = scratch.store(loose.join(keyed.select("key"), "key", "left_semi"), "near_open")
        number += 1
        last = left <= rows or number > 1 and 10 * linked < tries
        pairs = _across(open_, texts, index, scratch) if last else _stars(open_, number)
        pairs = scratch.store(pairs.join(tried, ["a", "b"], "left_anti"), "near_pairs")
        tried = tried.union(pairs)
        links = confirmed(pairs)
        tries, linked = pairs.count(), links.count()
        joined = connected(joined.select(F.col("component").alias("a"), F.col("node").alias("b")).union(links), scratch)
        open_ = open_.select("key", "node")

    members = signed.select("rid", F.col("doc.doc_id").alias("doc_id"), *same).join(
        nodes.select(*same, "node"), same, "left"
    )
    members = members.join(joined, "node", "left").select(
        "rid", "doc_id", F.coalesce("component", "node", "rid").alias("component")
    )
    members = scratch.store(members, "near_members")
    heads = members.groupBy("component").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rid")).alias("head")
    )
    verdicts = members.join(heads, "component").select(
        "rid", F.col("head.doc_id").alias("component_id"), (F.col("rid") == F.col("head.rid")).alias("kept_row")
    )
    verdicts = scratch.store(verdicts, "near_verdicts")
    scratch.release(signed, verdicts)
    if lent is not None:
        scratch.lend(lent)
    return signed.select("rid", "doc", "n_shingles").join(verdicts, "rid")


def digest(found: DataFrame) -> DataFrame:
    """One row of figures per document; a document is kept if it gives the component its id."""
    return found.select(
        F.col("doc.doc_id").alias("doc_id"),
        "n_shingles",
        "component_id",
        F.coalesce(F.col("doc.doc_id") == F.col("component_id"), F.col("kept_row")).alias("kept"),
    )


def one_of_each(docs: DataFrame, index: Index = Index(), lent: Scratch | None = None) -> DataFrame:
    """One document of each component, columns as they were."""
    return near_duplicates(docs, index, lent).filter("kept_row").select("doc.*")
