"""Best-two-fit packing of tokenised documents into sequences.

Every document is tokenised whole; only what is longer than a sequence is cut. How pieces
fit together depends on their lengths alone, so the plan is made from one count per length
(``capacity`` rows, whatever the corpus is): fill a bin greedily with the longest pieces
that fit; then see whether replacing its smallest piece by two unpacked ones fills it more
tightly, and take the pair that fits best. The same filling is repeated as often as the
counts allow, so planning takes a bounded number of steps, each of which uses up a length.
The plan says which ranks of a length go to which bins; pieces of a length are ranked by
the partition that made them and their place in it.
"""

from __future__ import annotations

import json
import sys
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
import tokenizers
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import BoundedMemo, process_cache, quoted, scratch, text_of

cloudpickle.register_pickle_by_value(sys.modules[__name__])

CAPACITY = 2048
END_ID = 0
# White space to str.split that the tokenizer takes for ordinary characters.
ODD = regex.compile("[\x1c-\x1f]")


class WordCoder:
    """Ids of a tokenizer whose pre-tokens never span white space, as little-endian 32-bit words.

    Words between white space are looked up in a memo; what is new is encoded by the
    tokenizer itself: pre-token by pre-token, after its own normaliser and pre-tokeniser.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        split = [p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"]
        self.whole = tokenizers.Tokenizer.from_file(path)
        self.added = [t["content"] for t in spec.get("added_tokens", [])]
        self.splits = regex.compile(split[0])
        self.bytewise = tokenizers.pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.pieces = BoundedMemo(self._piece, 250_000)
        self.words = BoundedMemo(self._word, 300_000)

    def _piece(self, piece: str) -> bytes:
        # printable ASCII stands for itself
        seen = piece if piece.isascii() and piece.isprintable() else self.bytewise.pre_tokenize_str(piece)[0][0]
        return np.array([t.id for t in self.whole.model.tokenize(seen)], "<u4").tobytes()

    def _word(self, word: str) -> bytes:
        if word.isascii() or (max(word) < "\u0250" and "\u0130" not in word):
            word = word.lower()  # characters that are composed already, each with one lower case
            if word.isascii() and word.isalpha():
                return self.pieces[word]
        else:
            word = self.whole.normalizer.normalize_str(word)
        return b"".join([self.pieces[p] for p in self.splits.findall(word)])

    def encode(self, text: str) -> bytes:
        # added tokens are found in the text as written, before anything is normalised
        if ODD.search(text) or any(a in text for a in self.added):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return b"".join(map(self.words.__getitem__, text.split()))


def coder(path: str) -> WordCoder:
    return process_cache(("words", path), lambda: WordCoder(path))


def _tokenise(path: str, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = coder(path).encode
        end = np.array([END_ID], "<u4").tobytes()
        seen: Counter = Counter()
        pid = TaskContext.get().partitionId()
        for batch in batches:
            rows, piece, start, length, crc, rank = [], [], [], [], [], []
            for i, t in enumerate(batch.column("text").to_pylist()):
                raw = encode(t) + end
                for k, at in enumerate(range(0, len(raw), 4 * capacity)):
                    part = raw[at : at + 4 * capacity]
                    n = len(part) // 4
                    rows.append(i)
                    piece.append(k)
                    start.append(at // 4)
                    length.append(n)
                    crc.append(zlib.crc32(part))
                    rank.append(seen[n])
                    seen[n] += 1
            ids = batch.column("id").take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
                 pa.array(rank, pa.int64()), pa.array(np.full(len(rows), pid, np.int32))],
                names=["id", "piece", "start", "length", "ids_crc32", "rank", "pid"],
            )

    return run


@dataclass
class Plan:
    """Ranks ``first`` to ``first + times * each`` of ``length`` go to ``times`` bins from ``bin`` on, ``each`` a bin, from ``offset`` on."""

    length: np.ndarray
    first: np.ndarray
    each: np.ndarray
    bin: np.ndarray
    offset: np.ndarray
    bins: int


def plan_bins(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """Best-two-fit over a count per length; identical bins are made in one step."""
    left = np.zeros(capacity + 1, np.int64)
    for n, c in counts.items():
        if not 1 <= n <= capacity:
            raise ValueError(f"a piece of {n} does not fit {capacity}")
        left[n] = c
    used = np.zeros(capacity + 1, np.int64)
    out: list[tuple[int, int, int, int, int]] = []
    bins = 0
    while left.any():
        fill = _fill(left.copy(), capacity)
        times = min(left[n] // k for n, k in fill.items())
        offset = 0
        for n in sorted(fill, reverse=True):
            out.append((n, int(used[n]), fill[n], bins, offset))
            used[n] += times * fill[n]
            left[n] -= times * fill[n]
            offset += n * fill[n]
        bins += int(times)
    table = np.array(out, np.int64).reshape(-1, 5)
    table = table[np.lexsort((table[:, 1], table[:, 0]))]
    return Plan(*table.T, bins)


def _fill(left: np.ndarray, capacity: int) -> Counter:
    """One bin: greedily the longest that fit, then the best two for the smallest."""
    fill: Counter = Counter()
    gap = capacity
    while gap:
        fits = np.flatnonzero(left[: gap + 1])
        if not len(fits):
            break
        n = int(fits[-1])
        k = min(int(left[n]), gap // n)
        fill[n] += k
        left[n] -= k
        gap -= n * k
    if gap:
        smallest = min(fill)
        pair = _best_two(left, gap + smallest)
        if pair and sum(pair) > smallest:
            fill[smallest] -= 1
            for n in pair:
                fill[n] += 1
            fill += Counter()
    return fill


def _best_two(left: np.ndarray, room: int) -> tuple[int, int] | None:
    """The two unpacked lengths of the largest sum within ``room``."""
    have = np.flatnonzero(left[: room + 1])
    best = None
    for a in have[::-1].tolist():
        if best and 2 * a <= sum(best):
            break
        under = have[: np.searchsorted(have, min(a, room - a), "right")]
        if len(under) and under[-1] == a and left[a] < 2:
            under = under[:-1]
        if len(under) and (best is None or a + int(under[-1]) > sum(best)):
            best = (a, int(under[-1]))
            if sum(best) == room:
                break
    return best


def pack(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset), a row for each piece.

    A null text counts as empty: a piece of the end id alone. Repeated rows and null ids are
    packed like all others. Sequences are numbered from 0 and filled gapless from offset 0.
    """
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(quoted(key)).alias("id"), text_of(text).alias("text"))
    made = rows.mapInArrow(_tokenise(path, capacity), f"id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, rank bigint, pid int")
    made = scratch(made, "pieces")
    counts = made.groupBy("length", "pid").agg(F.count(F.lit(1)).alias("n"))
    total = counts.groupBy("length").agg(F.sum("n").alias("n")).collect()  # one row per length at most
    plan = plan_bins({r["length"]: r["n"] for r in total}, capacity)
    # ranks of a length go on from partition to partition
    before = F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select("length", "pid", before.alias("before"))
    ranked = made.join(offsets, ["length", "pid"]).withColumn("rank", F.col("rank") + F.col("before"))
    placed = ranked.select("id", "piece", "start", "length", "ids_crc32", "rank")
    return placed.mapInArrow(_place(plan), f"id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint").withColumnRenamed("id", key)


def _place(plan: Plan):
    scale = 1 << 40

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = plan.length * scale + plan.first
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            i = np.searchsorted(at, length * scale + rank, "right") - 1
            inside = rank - plan.first[i]
            sequence = plan.bin[i] + inside // plan.each[i]
            offset = plan.offset[i] + inside % plan.each[i] * length
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence), pa.array(offset)], names=["id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return run
