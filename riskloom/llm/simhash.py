"""SimHash near-duplicates, found by pigeonring filtering.

A fingerprint has 64 bits in a ring of three segments (22, 21 and 21 bits); two link at a
distance of 2 or less. If they link, some segment starts a chain around the ring whose
cumulative differences stay within the proportional budgets: 0 bits in its first segment,
1 in the first two, 2 in all three (budget of l segments: floor(2 l / 3)). So the first
segment of the chain is equal, and of the two halves of the second, which differ in one
bit at most, one is equal too. (segment, its value, half, its value) is the key of a
bucket: six keys a fingerprint, about 32 bits each. Pairs of a bucket must pass the chain,
budget by budget, before the full Hamming check.

A bucket of more than ``SMALL`` fingerprints emits no pairs. All its members agree in the
key's bits, so two of them link exactly if they are equal after at most one flip each
among the remaining bits: every member joins the hubs of itself and of its one-flip
neighbours, about 33 rows a member, and a hub never has more than 65 members.

Equal fingerprints are one node throughout. Components come from alternating star
contractions over written tables.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from riskloom.llm.common import fresh_worker, quoted, scratch, spare, text_of

cloudpickle.register_pickle_by_value(sys.modules[__name__])

DISTANCE = 2
# (lowest bit, width) of the segments around the ring, and of the two halves of each.
RING = ((0, 22), (22, 21), (43, 21))
SMALL = 64
# Bytes that split words, as one of them; A-Z count as a-z.
FOLD = bytes(32 if b in (9, 10, 11, 12, 13, 32) else b for b in range(256)).lower()


def shingle_hashes(text: bytes, words: int = 3, seed: int = 42) -> list[int]:
    """XXH64 of every shingle, repeats included; nothing without words."""
    found = [w for w in text.translate(FOLD).split(b" ") if w]
    if not found:
        return []
    joined = b" ".join(found)
    if len(found) <= words:
        return [xxh64_intdigest(joined, seed)]
    ends = np.cumsum([len(w) + 1 for w in found]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    last = len(found) - words + 1
    return [xxh64_intdigest(joined[a:b], seed) for a, b in zip(starts[:last].tolist(), ends[words - 1 :].tolist())]


def fingerprint(text: bytes, words: int = 3, seed: int = 42) -> int:
    """Majority bits of the shingles' hashes; 0 without words."""
    hashes = shingle_hashes(text, words, seed)
    if not hashes:
        return 0
    bits = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65_536):
        block = np.array(hashes[at : at + 65_536], ">u8")
        bits += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(bits * 2 > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 3, seed: int = 42) -> DataFrame:
    """(id, fp bigint) of every row; a null text counts as empty."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fresh_worker()
        for batch in batches:
            made = np.array([fingerprint(t, words, seed) for t in batch.column("text").cast(pa.binary()).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(made.view(np.int64))], names=["id", "fp"])

    return docs.select(F.col(quoted(key)).alias("id"), text_of(text).alias("text")).mapInArrow(run, f"id {kind}, fp bigint")


def _bits(fp: Column, low: int, width: int) -> Column:
    return F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << width) - 1))


def _key_masks() -> list[int]:
    """The bits that each of the six keys fixes."""
    masks = []
    for i, (low, width) in enumerate(RING):
        after, size = RING[(i + 1) % len(RING)]
        for at, w in ((after, size // 2), (after + size // 2, size - size // 2)):
            masks.append(((1 << width) - 1) << low | ((1 << w) - 1) << at)
    return masks


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _chain(a: Column, b: Column, i: int) -> Column:
    """The chain that starts at segment i keeps within its budgets, l by l."""
    differs = a.bitwiseXOR(b)
    total, within = F.lit(0), F.lit(True)
    for steps in range(len(RING)):
        total = total + F.bit_count(_bits(differs, *RING[(i + steps) % len(RING)]))
        within = within & (total <= DISTANCE * (steps + 1) // len(RING))
    return within & (F.bit_count(differs) <= DISTANCE)


def links(nodes: DataFrame) -> DataFrame:
    """(a, b): links between distinct fingerprints ``fp``; enough to connect all that are linked.

    Small buckets give every pair of theirs; large ones give each member's link to the
    smallest of each hub, whose members are linked to each other through one-flip neighbours.
    """
    masks = _key_masks()
    fp = F.col("fp")
    keys = F.array(*[F.struct(F.lit(k).alias("k"), fp.bitwiseAND(F.lit(_signed(m))).alias("v")) for k, m in enumerate(masks)])
    keyed = nodes.select("fp", F.explode(keys).alias("key")).select("fp", "key.k", "key.v")
    sizes = keyed.groupBy("k", "v").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    full = scratch(keyed.join(sizes, ["k", "v"]), "buckets")

    lists = full.where(F.col("n") <= SMALL).groupBy("k", "v").agg(F.sort_array(F.collect_list("fp")).alias("all"))
    left = lists.select("k", "all", F.posexplode("all").alias("at", "a"))
    pairs = left.select("k", "a", F.explode(F.slice("all", F.col("at") + 2, F.lit(SMALL))).alias("b"))
    passed = F.lit(False)
    for k in range(len(masks)):
        passed = passed | ((F.col("k") == k) & _chain(F.col("a"), F.col("b"), k // 2))
    pairs = pairs.where(passed).select("a", "b")

    large = full.where(F.col("n") > SMALL)
    flips = F.lit(None)
    for k, m in enumerate(masks):
        free = [0] + [1 << bit for bit in range(64) if not m >> bit & 1]
        flips = F.when(F.col("k") == k, F.array(*[F.lit(_signed(x)).cast("long") for x in free])).otherwise(flips)
    hubs = large.select("fp", "k", "v", F.explode(flips).alias("flip"))
    hubs = hubs.select("fp", "k", fp.bitwiseXOR(F.col("flip")).alias("hub"))
    first = F.min("fp").over(Window.partitionBy("k", "hub"))
    stars = hubs.select(F.col("fp").alias("a"), first.alias("b")).where("a != b")
    ordered = stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return pairs.unionByName(ordered).distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): the smallest node of each connected component with a link.

    Alternates large-star and small-star contraction until the stars stand still.
    """
    now = scratch(edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u != v"), "edges")
    seen = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u != v").distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        kept = down.join(low, "u")
        small = kept.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        now = scratch(small, "edges")
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row; the id keeps its name.

    ``component_id`` is the smallest id that links reach, the row's own included; null ids
    are passed over unless a component has no other. Texts without words share fingerprint 0.
    """
    made = scratch(fingerprints(docs, key, text, words, seed), "fingerprints")
    nodes = scratch(made.groupBy("fp").agg(F.min("id").alias("least")), "nodes")
    rooted = components(links(nodes))
    joined = nodes.join(rooted, nodes["fp"] == rooted["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    best = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = joined.join(best, "root").select("fp", "component_id")
    return made.join(labels, "fp").select(F.col("id").alias(key), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 3, seed: int = 42) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the row with the smallest id, null ids last.

    Of several rows of a component with that id, the one whose text sorts first stays (one
    of equal texts). Rows are told apart by a number of their own, never by their id: equal
    or null ids in other components neither drop nor keep a row.
    """
    rows, place = number_rows(docs)
    made = fingerprints(rows.select(row_at(place, key), F.col(quoted(text)).alias("text")), "at", "text", words, seed)
    made = scratch(made.select("id.place", "id.id", "fp"), "fingerprints")
    return keep_one(rows, place, text, made, links)


def number_rows(docs: DataFrame) -> tuple[DataFrame, str]:
    """The rows with a number of their own, written once, and the name of its column."""
    place = spare(docs, "__place")
    return scratch(docs.withColumn(place, F.monotonically_increasing_id()), "rows"), place


def row_at(place: str, key: str) -> Column:
    return F.struct(F.col(place).alias("place"), F.col(quoted(key)).alias("id")).alias("at")


def keep_one(rows: DataFrame, place: str, text: str, made: DataFrame, link: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Of each component of ``made`` (place, id, fp) under ``link`` the row that ``keep_first`` describes."""
    # the smallest id, how many rows have it, and one of them: of each fingerprint, then of each component
    least = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "n", "place")).alias("least")
    nodes = made.groupBy("fp", "id").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("place"))
    nodes = scratch(nodes.groupBy("fp").agg(least).select("fp", "least.id", "least.n", "least.place"), "nodes")
    rooted = components(link(nodes))
    joined = nodes.join(rooted, nodes["fp"] == rooted["node"], "left").select("fp", "id", "n", "place", F.coalesce("root", "fp").alias("root"))
    joined = scratch(joined, "rooted")
    first = joined.groupBy("root", "id").agg(F.sum("n").alias("n"), F.min("place").alias("place"))
    first = scratch(first.groupBy("root").agg(least).select("root", "least.id", "least.n", "least.place"), "first")

    # only where several rows of a component share its smallest id are texts compared
    tied = first.where("n > 1").select(F.col("root").alias("tied"), F.col("id").alias("tied_id"))
    fps = joined.join(tied, (F.col("root") == F.col("tied")) & F.col("id").eqNullSafe(F.col("tied_id"))).select(F.col("fp").alias("tied_fp"), "tied", "tied_id")
    fps = scratch(fps, "tied")
    several = made.join(fps, (F.col("fp") == F.col("tied_fp")) & F.col("id").eqNullSafe(F.col("tied_id"))).select(F.col("place").alias("at"), "tied")
    texts = rows.select(F.col(place).alias("place"), F.col(quoted(text)).alias("text"))
    chosen = texts.join(several, F.col("place") == F.col("at")).groupBy("tied").agg(F.min(F.struct("text", "place")).alias("least"))
    stay = first.where("n = 1").select("place").unionByName(chosen.select("least.place"))
    return rows.join(stay.withColumnRenamed("place", place), place, "left_semi").drop(place)
