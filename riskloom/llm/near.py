"""Near copies at a stated similarity: wide SimHash first, then an exact join for what it leaves.

Linked are texts whose sets of shingles have similarity s (shared over all) or more, all of them,
and those that fingerprints take for such. Texts with equal sets are one node.

Wide SimHash finds most of the links. Two such texts differ in a share of about
p = acos(2 s / (1 + s)) / pi of their SimHash bits; at 0.8 that is 0.15. 64 bits tell such
pairs badly from others, so a fingerprint here has ``WORDS`` words of 64 bits: the first one
is the plain SimHash, the others mix each shingle's hash anew. Two link if all words together
differ in at most that share of bits (similarity is told with a standard error of 0.03, so
some pairs just below s link too).

The words form a ring of segments. A chain of two segments, next to each other or some steps
apart around the ring, that are both equal makes a bucket. Within so wide a distance the
proportional budgets of a whole chain are too large to look up, so the guarantee of a
pigeonring becomes a probability: a chain is as wide as the number of rows has bits, so that
unrelated rows meet about as often at any size, and there are as many chains as it takes for
a pair of exactly the stated similarity to have an equal one with probability ``recall``;
more similar pairs have one more often (at 0.9 almost always). Before the full check, the
first words must be within three standard deviations.

A bucket of more than ``SMALL`` rows emits no pairs. Its members are compared with pivots
chosen by hash; those that link to one leave, the rest meets four times as many in the next
round, until none is left. A member that left is not compared with the rest of this bucket.
Small buckets then check only pairs that these links leave in different components.

What these steps miss is found without chance. With all shingles in one order, a set's
prefix is as many of its first ones as it may lose, and one more: two sets that link share a
shingle of their prefixes. Sets in different components that do, and whose places in
the prefixes leave room for enough more, are candidates. The order puts shingles that are frequent in a
share of the rows last; it decides how many pairs are candidates, never which ones link.

Members of a shingle that have room for no set of the other component are left out before
pairs are formed, so a large component meets a stray set with the few members that may link to it.

Before sets are fetched for the check, their parities are compared: words in which each
shingle flips one bit, with at least a bit for every shingle (in fewer, large sets would all seem
near). A shingle that only one set has changes one bit at most, so sets whose
parities differ in more bits than linked sets may differ in shingles do not link. Parities of
different lengths are compared at the smaller one, to which the longer is folded.

Texts without words have the empty set in common; a null text counts as empty; fewer words
than a shingle has make one shingle.
"""

from __future__ import annotations

import functools
import math
import sys
from collections.abc import Iterator
from fractions import Fraction
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from riskloom.llm.common import Scope, fresh_worker, quoted, scratch, text_of
from riskloom.llm.simhash import components, keep_one, number_rows, row_at, shingle_hashes

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Words of a fingerprint.
WORDS = 16
# Chains share segments, so they meet less often than independent ones: this many more.
SHARED = 1.15
# Rows of a bucket whose pairs are all checked.
SMALL = 8
# Pivots of a large bucket in the first round.
PIVOTS = 4
# One row in so many tells which shingles are frequent: those that often among them, the first so many.
ORDER_SHARE, ORDER_LEAST, ORDER_MOST = 32, 3, 1 << 17


class Shape(NamedTuple):
    """``chains`` chains of two segments of ``bits``; two rows link at ``distance`` or less."""

    bits: int
    chains: int
    distance: int
    first: int  # bits in which the first words may differ


def shape(rows: int, similarity: float = 0.8, recall: float = 0.9) -> Shape:
    apart = math.acos(2 * similarity / (1 + similarity)) / math.pi
    bits = max(8, math.ceil(math.log2(max(rows, 2)) / 2))
    equal = (1 - apart) ** (2 * bits)
    chains = math.ceil(SHARED * math.log(1 - recall) / math.log(1 - equal)) if equal < 1 else 1
    first = math.floor(64 * apart + 3 * math.sqrt(64 * apart * (1 - apart)))
    return Shape(bits, chains, math.floor(64 * WORDS * apart), first)


def _mixed(hashes: np.ndarray, words: int = WORDS) -> np.ndarray:
    """Per hash the hash itself and further ones (the finalizer of SplitMix64), big-endian."""
    x = hashes[:, None] + np.arange(words, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    x[:, 0] = hashes
    return x.astype(">u8")


def wide_fingerprint(text: bytes, words: int = 5, seed: int = 42) -> np.ndarray:
    """``WORDS`` unsigned 64-bit words of majority bits; zeros without words in the text."""
    return _wide(np.array(shingle_hashes(text, words, seed), np.uint64))


def _wide(hashes: np.ndarray) -> np.ndarray:
    totals = np.zeros(64 * WORDS, np.int64)
    # sums of 255 bits fit a byte
    for at in range(0, len(hashes), 255):
        block = _mixed(hashes[at : at + 255])
        totals += np.unpackbits(block.view(np.uint8), axis=1).sum(axis=0, dtype=np.uint8)
    return np.packbits(totals * 2 > len(hashes)).view(">u8").astype(np.uint64)


def _list(parts: list[np.ndarray]) -> pa.ListArray:
    """Lists of bigint out of unsigned arrays."""
    flat = np.concatenate(parts).view(np.int64) if parts else np.zeros(0, np.int64)
    ends = np.cumsum([0] + [len(x) for x in parts]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def _ratio(similarity: float) -> Fraction:
    """The similarity as it is written: 0.8 is 4/5."""
    return Fraction(str(similarity))


def enough(shared: Column, sizes: Column, similarity: float) -> Column:
    """``shared`` over all is the similarity or more, in whole numbers; ``sizes`` is the sum of both sets' sizes."""
    s = _ratio(similarity)
    return shared * F.lit(s.numerator + s.denominator) >= sizes * F.lit(s.numerator)


def frequent(docs: DataFrame, key: str, text: str, words: int = 5, seed: int = 42) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, counts) of shingles that are frequent in a share of the rows, by hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fresh_worker()
        for batch in batches:
            for t in batch.column("text").cast(pa.binary()):
                found = np.unique(np.array(shingle_hashes(t.as_py(), words, seed), np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64))], names=["h"])

    some = docs.where(F.pmod(F.xxhash64(F.col(quoted(key))), F.lit(ORDER_SHARE)) == 0).select(text_of(text).alias("text"))
    counts = some.mapInArrow(run, "h bigint").groupBy("h").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= ORDER_LEAST)
    top = counts.orderBy(F.desc("n"), "h").limit(ORDER_MOST).collect()
    hashes = np.array([r["h"] for r in top], np.int64).view(np.uint64)
    by = np.argsort(hashes)
    return hashes[by], np.array([r["n"] for r in top], np.int64)[by]


def _parity(found: np.ndarray) -> np.ndarray:
    """Which bits the shingles of a set flip an odd number of times; ``WORDS`` words, doubled until no fewer bits than shingles."""
    bits = 64 * WORDS
    while bits < len(found):
        bits *= 2
    odd = np.bincount((found % np.uint64(bits)).astype(np.int64), minlength=bits) % 2
    return np.packbits(odd.astype(bool)).view(">u8").astype(np.uint64)


def _prefix(found: np.ndarray, last: tuple[np.ndarray, np.ndarray], s: Fraction) -> np.ndarray:
    """The first shingles of a set, rare ones first: one of them is in every set that links."""
    if not len(found):
        return found
    hashes, counts = last
    often = np.zeros(len(found), np.int64)
    if len(hashes):
        at = np.minimum(np.searchsorted(hashes, found), len(hashes) - 1)
        often = np.where(hashes[at] == found, counts[at], 0)
    keep = len(found) - -(-len(found) * s.numerator // s.denominator) + 1
    return found[np.lexsort((found, often))[:keep]]


def sketches(docs: DataFrame, key: str, text: str, last: tuple[np.ndarray, np.ndarray], similarity: float, words: int = 5, seed: int = 42) -> DataFrame:
    """(id, set, size, wide, parity, prefix) of every row; ``set`` is a hash of its set of shingles."""
    kind = docs.schema[key].dataType.simpleString()
    s = _ratio(similarity)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fresh_worker()
        for batch in batches:
            names, sizes, wides, odd, firsts = [], [], [], [], []
            for t in batch.column("text").cast(pa.binary()):
                hashes = np.array(shingle_hashes(t.as_py(), words, seed), np.uint64)
                found = np.unique(hashes)
                names.append(xxh64_intdigest(found.tobytes(), seed))
                sizes.append(len(found))
                wides.append(_wide(hashes))
                odd.append(_parity(found))
                firsts.append(_prefix(found, last, s))
            named = pa.array(np.array(names, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), named, pa.array(sizes, pa.int64()), _list(wides), _list(odd), _list(firsts)],
                names=["id", "set", "size", "wide", "parity", "prefix"],
            )

    made = docs.select(F.col(quoted(key)).alias("id"), text_of(text).alias("text"))
    return made.mapInArrow(run, f"id {kind}, set bigint, size bigint, wide array<bigint>, parity array<bigint>, prefix array<bigint>")


def checked(pairs: DataFrame, nodes: DataFrame, texts: DataFrame, similarity: float, words: int = 5, seed: int = 42) -> DataFrame:
    """The pairs (a, b) of ``nodes`` (node, size, parity) whose ``texts`` (place, text) share enough shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fresh_worker()
        for batch in batches:
            found = [np.unique(np.array(shingle_hashes(t.as_py(), words, seed), np.uint64)) for t in batch.column("text").cast(pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column("place"), _list(found)], names=["place", "all"])

    told = pairs.join(nodes.select(F.col("node").alias("a"), F.col("size").alias("size_a"), F.col("parity").alias("parity_a")), "a")
    told = told.join(nodes.select(F.col("node").alias("b"), F.col("size").alias("size_b"), F.col("parity").alias("parity_b")), "b")
    both = F.col("size_a") + F.col("size_b")
    # the most that they can share: what is not shared is at least the bits that differ
    room = (both - _differing_parities("parity_a", "parity_b")) / F.lit(2)
    told = scratch(told.where(enough(room, both, similarity)).select("a", "b"), "told")

    asked = told.select(F.explode(F.array("a", "b")).alias("place")).distinct()
    sets = scratch(texts.join(asked, "place").select("place", text_of("text").alias("text")).mapInArrow(run, "place bigint, all array<bigint>"), "sets")
    whole = told.join(sets.select(F.col("place").alias("a"), F.col("all").alias("all_a")), "a")
    whole = whole.join(sets.select(F.col("place").alias("b"), F.col("all").alias("all_b")), "b")
    shared = F.size(F.array_intersect("all_a", "all_b"))
    return whole.where(enough(shared, F.size("all_a") + F.size("all_b"), similarity)).select("a", "b")


def left_over(nodes: DataFrame, similarity: float) -> DataFrame:
    """(a, b): ``nodes`` (node, root or null for itself, size, prefix) with different roots that may link, each pair once."""
    keyed = nodes.select("node", "root", "size", F.posexplode("prefix").alias("at", "k"))
    # a set goes on to share at most what follows this place, itself included
    member = F.struct("node", "size", (F.col("size") - F.col("at")).alias("room"))
    cells = keyed.repartition("k").groupBy("k", F.coalesce("root", "node").alias("root"))
    room = F.max(F.col("size") - F.col("at")).alias("room")
    cells = cells.agg(F.collect_list(member).alias("all"), F.min("size").alias("least"), F.max("size").alias("most"), room)
    # most shingles are those of one root only
    cells = cells.withColumn("roots", F.count(F.lit(1)).over(Window.partitionBy("k"))).where("roots > 1").drop("roots")
    cells = scratch(cells, "cells")
    s = _ratio(similarity)

    def near(small: str, large: str) -> Column:
        return F.col(small) * s.numerator <= F.col(large) * s.denominator

    def fitting(members: str, least: str) -> Column:
        """Those with room enough for the smallest set of the other cell, or for none there."""
        return F.filter(members, lambda x: enough(x["room"], x["size"] + F.col(least), similarity))

    other = cells.select("k", *[F.col(c).alias(f"{c}_b") for c in ("root", "all", "least", "most", "room")])
    met = cells.join(other, "k").where((F.col("root") < F.col("root_b")) & near("least", "most_b") & near("least_b", "most"))
    met = met.where(enough(F.least("room", "room_b"), F.col("least") + F.col("least_b"), similarity))
    met = met.select(fitting("all", "least_b").alias("all"), fitting("all_b", "least").alias("all_b"))
    # the shorter list first, so that the rows in between are no more than the pairs
    fewer = F.size("all") <= F.size("all_b")
    met = met.select(F.when(fewer, F.col("all")).otherwise(F.col("all_b")).alias("all"), F.when(fewer, F.col("all_b")).otherwise(F.col("all")).alias("all_b"))
    met = met.where(F.size("all") > 0).select(F.explode("all").alias("a"), "all_b").select("a", F.explode("all_b").alias("b"))
    met = met.where(enough(F.least("a.room", "b.room"), F.col("a.size") + F.col("b.size"), similarity))
    return met.select(F.least("a.node", "b.node").alias("a"), F.greatest("a.node", "b.node").alias("b")).distinct()


def _differing(a: str, b: str) -> Column:
    parts = [F.bit_count(F.col(a)[i].bitwiseXOR(F.col(b)[i])) for i in range(WORDS)]
    return functools.reduce(Column.__add__, parts)


def _differing_parities(a: str, b: str) -> Column:
    """Bits that differ, at the length of the shorter one."""
    words = F.least(F.size(a), F.size(b))

    def folded(x: str) -> Column:
        def word(i: Column) -> Column:
            return F.aggregate(F.sequence(i, F.size(x) - 1, words), F.lit(0).cast("long"), lambda odd, j: odd.bitwiseXOR(F.get(F.col(x), j)))

        return F.when(F.size(x) == words, F.col(x)).otherwise(F.transform(F.sequence(F.lit(0), words - 1), word))

    apart = F.zip_with(folded(a), folded(b), lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    return F.aggregate(apart, F.lit(0), lambda total, n: total + n)


def _buckets(wide: str, form: Shape) -> Column:
    """(chain, values of its two segments) of every chain, in one number each."""
    per = 64 // form.bits
    mask = F.lit((1 << form.bits) - 1)
    ring = [F.shiftrightunsigned(F.col(wide)[w], s * form.bits).bitwiseAND(mask) for w in range(WORDS) for s in range(per)]
    values = []
    for chain in range(form.chains):
        steps, at = divmod(chain, len(ring))
        after = ring[(at + steps + 1) % len(ring)]
        values.append(F.shiftleft(ring[at], form.bits).bitwiseOR(after).bitwiseOR(F.lit(chain << 2 * form.bits).cast("long")))
    return F.array(*values)


def links(nodes: DataFrame, form: Shape) -> DataFrame:
    """(a, b): links between distinct first words ``fp`` of ``nodes`` (fp, wide); enough to connect all that are linked."""
    keyed = nodes.select("fp", F.explode(_buckets("wide", form)).alias("k"))
    sizes = keyed.groupBy("k").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    full = scratch(keyed.join(sizes, "k"), "buckets")

    stars = None
    live = scratch(full.where(F.col("n") > SMALL).select("k", "fp").join(nodes, "fp"), "large")
    salts = PIVOTS
    while not live.isEmpty():
        one = live.groupBy("k", F.pmod(F.xxhash64("fp"), F.lit(salts)).alias("salt")).agg(F.min(F.struct("fp", "wide")).alias("pivot"))
        pivots = one.select("k", F.col("pivot.fp").alias("b"), F.col("pivot.wide").alias("wide_b"))
        near = live.join(pivots, "k").where(_differing("wide", "wide_b") <= form.distance)
        near = scratch(near.select("k", F.col("fp").alias("a"), "b"), "near")
        linked = near.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        stars = stars.unionByName(linked) if stars else linked
        live = scratch(live.join(near.select("k", F.col("a").alias("fp")).distinct(), ["k", "fp"], "left_anti"), "large")
        salts *= 4

    # pairs that the stars connect already need no check
    members = full.where(F.col("n") <= SMALL).select("k", "fp")
    if stars:
        rooted = components(stars.distinct()).select(F.col("node").alias("fp"), "root")
        members = members.join(rooted, "fp", "left").select("k", "fp", F.coalesce("root", "fp").alias("root"))
    else:
        members = members.withColumn("root", F.col("fp"))
    lists = members.groupBy("k").agg(F.sort_array(F.collect_list(F.struct("fp", "root"))).alias("all"))
    left = lists.select("all", F.posexplode("all").alias("at", "a"))
    pairs = left.select("a", F.explode(F.slice("all", F.col("at") + 2, F.lit(SMALL))).alias("b")).where("a.root != b.root")
    pairs = pairs.select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b"))
    pairs = pairs.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= form.first).distinct()
    pairs = pairs.join(nodes.select(F.col("fp").alias("a"), F.col("wide").alias("wide_a")), "a")
    pairs = pairs.join(nodes.select(F.col("fp").alias("b"), F.col("wide").alias("wide_b")), "b")
    found = pairs.where(_differing("wide_a", "wide_b") <= form.distance).select("a", "b")
    return (found.unionByName(stars) if stars else found).distinct()


def keep_first(
    docs: DataFrame, key: str = "doc_id", text: str = "text", similarity: float = 0.8, words: int = 5, recall: float = 0.9, seed: int = 42
) -> DataFrame:
    """The rows of ``docs`` that stay: of each component of near copies the one with the smallest id.

    Ties, null ids and repeated ids as in ``simhash.keep_first``; columns of any name are kept.
    """
    rows, place = number_rows(docs)
    form = shape(rows.count(), similarity, recall)
    plain = rows.select(row_at(place, key), F.col(place).alias("place"), F.col(quoted(text)).alias("text"))
    last = frequent(plain, "place", "text", words, seed)
    made = scratch(sketches(plain, "at", "text", last, similarity, words, seed).select("id.place", "id.id", "set", "size", "wide", "parity", "prefix"), "sketches")
    # rows with equal sets are one node, the first of them by place
    firsts = scratch(made.groupBy("set").agg(F.min("place").alias("node")), "firsts")
    nodes = made.withColumnRenamed("place", "node").join(firsts.select("node"), "node", "left_semi")
    placed = made.join(firsts, "set")
    texts = plain.select("place", "text")

    with Scope(docs.sparkSession) as lookup:
        prints = placed.select(F.col("wide")[0].alias("fp"), "wide", "node")
        named = scratch(prints.groupBy("fp").agg(F.min("wide").alias("wide"), F.min("node").alias("least")), "wide")
        told = links(named.select("fp", "wide"), form)
        told = told.join(named.select(F.col("fp").alias("a"), F.col("least").alias("least_a")), "a")
        told = told.join(named.select(F.col("fp").alias("b"), F.col("least").alias("least_b")), "b").select(F.col("least_a").alias("a"), F.col("least_b").alias("b"))
        # equal first words link as well
        equal = prints.select("fp", "node").join(named.select("fp", "least"), "fp").select(F.col("least").alias("a"), F.col("node").alias("b"))
        found = told.unionByName(equal).where("a != b").distinct()
    first = scratch(found, "links")
    lookup.remove()

    with Scope(docs.sparkSession) as lookup:
        rooted = components(first).select("node", "root")
        rest = left_over(nodes.select("node", "size", "prefix").join(rooted, "node", "left"), similarity)
        found = checked(rest, nodes, texts, similarity, words, seed)
    every = scratch(first.unionByName(found), "links")
    lookup.remove()
    return keep_one(rows, place, text, placed.select("place", "id", F.col("node").alias("fp")), lambda _: every)
