"""Phrases of two and three words that occur together, by language.

Pass 1 finds a superset of the frequent n-grams (one word and phrases) with Misra-Gries
summaries. Tasks hash the n-grams of a few megabytes of text at a time, count equal hashes and
hand on one row per block and hash partition, so a phrase that holds a third of all
occurrences is one number per block. A hash partition knows its mass; its summary has more
counters than mass divided by the threshold, so whatever is lost by merging is below the
threshold and each n-gram that is frequent enough keeps a positive counter. Partitions have
about ``PART`` occurrences, so their number grows with the text and their size does not.

Survivors are marked in a bit map of at most ``MAP_BITS`` bits, the only thing broadcast: each
partition marks its own range of it. A wrong mark costs work, never a result.

Pass 2 counts the marked n-grams exactly, by their words and not by hashes: ids of words inside
a block, then text. What is frequent is kept; parts of a phrase are looked up with a join that
spreads hot keys; all else are aggregations with partial combination. Scores are quotients of
38-digit decimals without fraction.

Words are compared after A-Z became lower-case. A null or empty text has no words, a null
language counts as ``und``. Very long texts are read in windows that repeat two words; repeated
rows count each time. Ids are not used. Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from riskloom.llm.common import quoted, scratch, text_of
from riskloom.operators.relational import lookup_join, salt_parts

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Bytes of text that are tokenised at once, of one language.
BLOCK = 2 << 20
# Bytes of all languages that wait for a block.
WAITING = 8 << 20
# Occurrences of n-grams, about, in a hash partition of pass 1.
PART = 2 << 20
# N-gram hashes that are combined before they leave a task.
COMBINE = 2 << 20
MAP_BITS = 1 << 28
LONGEST = 3

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
WORD, SPACE, BREAK = 0, 1, 2
KIND = np.full(256, WORD, np.uint8)
KIND[list(b" \t")] = SPACE
KIND[list(b".,;:!?\n\x0b\x0c\r")] = BREAK


def _windows(text: bytes) -> Iterator[tuple[bytes, int]]:
    """(piece, words at its start that an earlier piece has counted) of a text, whole if it is short."""
    if len(text) <= BLOCK:
        yield text, 0
        return
    kinds = KIND[np.frombuffer(text, np.uint8)]
    start, done = 0, 0
    while True:
        after = max(start + BLOCK, done + 1)
        gap = np.flatnonzero(kinds[after : after + BLOCK] != WORD)
        if not len(gap):
            gap = np.flatnonzero(kinds[after:] != WORD)
        end = after + int(gap[0]) if len(gap) else len(text)
        inside = kinds[start:end] == WORD
        firsts = np.flatnonzero(inside & ~np.r_[False, inside[:-1]])
        yield text[start:end], int(np.searchsorted(firsts, done - start))
        if end >= len(text):
            return
        # the last words go on in front of the next piece
        carried = firsts[-(LONGEST - 1) :]
        start, done = (start + int(carried[0]) if len(carried) else end), end


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[tuple[bytes, int]]]]:
    """Texts gathered by language into blocks of bounded size."""
    waiting: dict[str, list[tuple[bytes, int]]] = {}
    sizes: dict[str, int] = {}
    for batch in batches:
        texts = batch.column("text").cast(pa.binary())
        for lang, text in zip(batch.column("lang").to_pylist(), texts):
            for piece, seen in _windows(text.as_py()):
                waiting.setdefault(lang, []).append((piece, seen))
                sizes[lang] = sizes.get(lang, 0) + len(piece) + 1
                if sizes[lang] >= BLOCK:
                    yield lang, waiting.pop(lang)
                    del sizes[lang]
        while sum(sizes.values()) >= WAITING:
            lang = max(sizes, key=sizes.get)
            yield lang, waiting.pop(lang)
            del sizes[lang]
    yield from waiting.items()


class Block:
    """The words of a block: ids in order of occurrence, the words of the ids, and where pieces go on."""

    def __init__(self, lang: str, pieces: list[tuple[bytes, int]]):
        self.lang = lang
        data = np.frombuffer(b"\n".join(p for p, _ in pieces).translate(LOWER), np.uint8)
        kinds = KIND[data]
        inside = kinds == WORD
        edge = np.diff(np.concatenate(([0], inside.view(np.int8), [0])))
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        offsets = np.zeros(len(starts) + 1, np.int32)
        np.cumsum(ends - starts, out=offsets[1:])
        words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])])
        coded = words.dictionary_encode()
        self.ids = coded.indices.to_numpy().astype(np.int64)
        self.words = coded.dictionary
        breaks = np.cumsum(kinds == BREAK, dtype=np.int32)
        place = breaks[starts]
        joined = place[1:] == place[:-1] if len(place) else np.zeros(0, bool)
        fresh = np.ones(len(starts), bool)
        at = 0
        for piece, seen in pieces:
            if seen:
                first = np.searchsorted(starts, at)
                fresh[first : first + seen] = False
            at += len(piece) + 1
        self.count = int(fresh.sum())
        # first words of the n-grams whose last word is counted here
        self.first = [np.flatnonzero(fresh)]
        self.first.append(np.flatnonzero(joined & fresh[1:]))
        self.first.append(np.flatnonzero(joined[:-1] & joined[1:] & fresh[2:]) if len(joined) > 1 else np.zeros(0, np.int64))

    def hashes(self) -> list[np.ndarray]:
        """A 64-bit hash of each n-gram, for n of 1, 2, 3."""
        salt = xxh64_intdigest(self.lang.encode("utf-8", "surrogatepass"), 7)
        known = np.fromiter((xxh64_intdigest(w, salt) for w in self.words.to_pylist()), np.uint64, len(self.words))
        h = known[self.ids]
        one = h[self.first[0]]
        two = _mix(h[self.first[1]] * np.uint64(0x9E3779B97F4A7C15) + h[self.first[1] + 1])
        a = self.first[2]
        three = _mix(_mix(h[a] * np.uint64(0xC2B2AE3D27D4EB4F) + h[a + 1]) * np.uint64(0x165667B19E3779F9) + h[a + 2])
        return [one, two, three]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def _combine(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and what they add up to; keys without counts are sorted already."""
    if not len(keys):
        return keys, np.zeros(0, np.int64)
    if counts is not None:
        order = np.argsort(keys)
        keys, counts = keys[order], counts[order]
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    sums = np.diff(np.r_[starts, len(keys)]) if counts is None else np.add.reduceat(counts, starts)
    return keys[starts], sums.astype(np.int64)


def _bounds(parts: int) -> np.ndarray:
    """First hash of each partition but the first."""
    return np.array([(i << 64) // parts for i in range(1, parts)], np.uint64)


def _summaries(parts: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Per block and hash partition: mass, keys that occur once, other keys, their counts."""

    def rows(keys: np.ndarray) -> pa.RecordBatch:
        keys, counts = _combine(keys)
        cut = np.r_[0, np.searchsorted(keys, _bounds(parts)), len(keys)]
        out: list[tuple] = []
        for part in np.flatnonzero(np.diff(cut)):
            k, c = keys[cut[part] : cut[part + 1]], counts[cut[part] : cut[part + 1]]
            out.append((int(part), int(c.sum()), k[c == 1].tobytes(), k[c > 1].tobytes(), c[c > 1].tobytes()))
        columns = list(zip(*out)) if out else [[]] * 5
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int64()), *[pa.array(c, pa.binary()) for c in columns[2:]]],
            names=["part", "mass", "once", "often", "counts"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[np.ndarray] = []
        for lang, pieces in _blocks(batches):
            waiting.extend(Block(lang, pieces).hashes())
            if sum(map(len, waiting)) >= COMBINE:
                keys, waiting = np.concatenate(waiting), []
                keys.sort()
                yield rows(keys)
        if waiting:
            yield rows(np.sort(np.concatenate(waiting)))

    return run


class Summary:
    """A mergeable Misra-Gries summary: at most ``capacity`` counters, each too low by at most ``lost``."""

    def __init__(self, capacity: int):
        self.capacity, self.lost = capacity, 0
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def merge(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.keys, self.counts = _combine(np.concatenate([self.keys, keys]), np.concatenate([self.counts, counts]))
        over = len(self.keys) - self.capacity
        if over > 0:
            # capacity + 1 counters give up the same amount at once
            least = int(np.partition(self.counts, over - 1)[over - 1])
            self.lost += least
            kept = self.counts > least
            self.keys, self.counts = self.keys[kept], self.counts[kept] - least

    def at_least(self, threshold: int) -> np.ndarray:
        """Keys that may occur so often."""
        return self.keys[self.counts + self.lost >= threshold]


def _survivors(parts: int, bits: int, least: int) -> Callable[[pa.Table], pa.Table]:
    def run(group: pa.Table) -> pa.Table:
        part = group.column("part")[0].as_py()
        mass = pc.sum(group.column("mass")).as_py()
        summary = Summary(mass // least + 1)
        keys: list[np.ndarray] = []
        counts: list[np.ndarray] = []

        def flush() -> None:
            if keys:
                summary.merge(np.concatenate(keys), np.concatenate(counts))
                keys.clear()
                counts.clear()

        for once, often, many in zip(group.column("once"), group.column("often"), group.column("counts")):
            o = np.frombuffer(once.as_py(), np.uint64)
            keys += [o, np.frombuffer(often.as_py(), np.uint64)]
            counts += [np.ones(len(o), np.int64), np.frombuffer(many.as_py(), np.int64)]
            if sum(map(len, keys)) >= max(1 << 18, len(summary.keys)):
                flush()
        flush()
        place = (summary.at_least(least) >> np.uint64(64 - bits)).astype(np.int64)
        # bytes of the map that this partition marks; neighbours may share the byte at an end
        low = ((part << 64) // parts >> (64 - bits)) // 8
        high = ((((part + 1) << 64) // parts - 1) >> (64 - bits)) // 8
        marks = np.zeros(high - low + 1, np.uint8)
        np.bitwise_or.at(marks, place // 8 - low, (1 << (place % 8)).astype(np.uint8))
        return pa.table({"low": pa.array([low], pa.int64()), "marks": pa.array([marks.tobytes()], pa.binary()), "survivors": pa.array([len(place)], pa.int64())})

    return run


def _counts(marked: object, bits: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(lang, words, phrase, n) of the marked n-grams by block; words 0 gives all words of the block."""

    def some(lang: str, n: int, phrases: pa.Array, counts: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(counts), pa.string()), pa.array(np.full(len(counts), n, np.int32)), phrases.cast(pa.binary()), pa.array(counts, pa.int64())],
            names=["lang", "words", "phrase", "n"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = np.frombuffer(marked.value, np.uint8)
        for lang, pieces in _blocks(batches):
            block = Block(lang, pieces)
            yield some(lang, 0, pa.array([b""], pa.binary()), np.array([block.count]))
            size = len(block.words)
            for n, (first, h) in enumerate(zip(block.first, block.hashes()), 1):
                at = (h >> np.uint64(64 - bits)).astype(np.int64)
                first = first[(marks[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0]
                if not len(first):
                    continue
                # exact: an n-gram is the number that its word ids spell, pairs renumbered if they are many
                code = block.ids[first]
                if n >= 2:
                    code = code * size + block.ids[first + 1]
                pairs = None
                if n == 3:
                    if size**3 >= 1 << 62:
                        pairs, code = np.unique(code, return_inverse=True)
                    code = code * size + block.ids[first + 2]
                code, counts = _combine(np.sort(code))
                ids = []
                for _ in range(n - 1 if pairs is None else 1):
                    code, last = np.divmod(code, size)
                    ids.append(last)
                if pairs is not None:
                    code, last = np.divmod(pairs[code], size)
                    ids.append(last)
                ids.append(code)
                phrase = pc.binary_join_element_wise(*[block.words.take(pa.array(i)) for i in reversed(ids)], b" ") if n > 1 else block.words.take(pa.array(ids[0]))
                for i in range(0, len(counts), 1 << 16):
                    yield some(lang, n, phrase.slice(i, 1 << 16), counts[i : i + (1 << 16)])

    return run


def survivors_map(docs: DataFrame, least: int) -> tuple[bytes, int, int]:
    """(bit map, its number of bits as a power of two, marked n-grams) for ``docs`` (lang, text)."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    mass = size // 2  # three n-grams in some six bytes
    parts = max(1, -(-mass // PART))
    bits = min(MAP_BITS.bit_length() - 1, max(16, (8 * mass // least).bit_length()))
    made = docs.mapInArrow(_summaries(parts), "part int, mass bigint, once binary, often binary, counts binary")
    found = made.groupBy("part").applyInArrow(_survivors(parts, bits, least), "low bigint, marks binary, survivors bigint")
    marks, kept = np.zeros((1 << bits) // 8, np.uint8), 0
    for r in found.toLocalIterator():  # a bit map of bounded size, in pieces
        piece = np.frombuffer(r["marks"], np.uint8)
        marks[r["low"] : r["low"] + len(piece)] |= piece
        kept += r["survivors"]
    return marks.tobytes(), bits, kept


def frequent_ngrams(docs: DataFrame, least: int = 10, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, words, phrase, a): exact occurrences of all n-grams of up to three words with at least ``least``.

    Rows with ``words`` 0 and an empty phrase hold the number of words of a language.
    """
    if least < 1:
        raise ValueError("least is 1 or more")
    docs = docs.select(F.coalesce(F.col(quoted(lang)).cast("string"), F.lit("und")).alias("lang"), text_of(text).alias("text"))
    marks, bits, _ = survivors_map(docs, least)
    shared = docs.sparkSession.sparkContext.broadcast(marks)
    counted = docs.mapInArrow(_counts(shared, bits), "lang string, words int, phrase binary, n bigint")
    totals = counted.groupBy("lang", "words", "phrase").agg(F.sum("n").alias("a"))
    return totals.where((F.col("words") == 0) | (F.col("a") >= least)).withColumn("phrase", F.col("phrase").cast("string"))


def score(a: str, left: str, right: str) -> str:
    """SQL for floor(1000000 a a / (l r)) without rounding: 38 digits hold it for counts below 10^16."""
    wide = "cast({} as decimal(38,0))"
    return f"(cast(1000000 as decimal(38,0)) * {wide.format(a)} * {wide.format(a)}) div ({wide.format(left)} * {wide.format(right)})"


def collocations(docs: DataFrame, least: int = 10, share: int = 50, top: int = 2000, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of the ``top`` phrases of two and three words per language.

    A phrase is dropped if a longer one that holds it reaches ``share`` percent of its occurrences.
    The lowest score over the cuts counts, of equal ones the first cut. Order: score, occurrences, phrase.
    """
    known = scratch(frequent_ngrams(docs, least, text, lang), "phrases")
    word = [F.substring_index("phrase", " ", 1), F.substring_index(F.substring_index("phrase", " ", 2), " ", -1), F.substring_index("phrase", " ", -1)]
    two, three = known.where("words = 2"), known.where("words = 3")
    head, tail = F.substring_index("phrase", " ", 2), F.concat_ws(" ", word[1], word[2])

    def asks(rows: DataFrame, **parts: object) -> DataFrame:
        listed = F.array(*[F.struct(F.lit(slot).alias("slot"), part.alias("part")) for slot, part in parts.items()])
        return rows.select("lang", "phrase", F.explode(listed).alias("ask")).select("lang", "phrase", "ask.slot", "ask.part")

    asked = asks(two, l1=word[0], r1=word[2]).unionByName(asks(three, l1=word[0], r1=tail, l2=head, r2=word[2]))
    sides = known.where("words between 1 and 2").select("lang", F.col("phrase").alias("part"), F.col("a").alias("f"))
    answered = lookup_join(asked, sides, ["lang", "part"], "phrase", how="inner")
    holders = three.select("lang", F.explode(F.array(head, tail)).alias("phrase"), F.lit("over").alias("slot"), F.col("a").alias("f"))
    own = known.where("words >= 2").select("lang", "phrase", F.lit("a").alias("slot"), F.col("a").alias("f"))
    cells = answered.select("lang", "phrase", "slot", "f").unionByName(holders).unionByName(own)
    rows = cells.groupBy("lang", "phrase").agg(*[F.max(F.when(F.col("slot") == s, F.col("f"))).alias(s) for s in ("a", "l1", "r1", "l2", "r2", "over")])
    rows = rows.where(F.col("over").isNull() | (F.col("over").cast("decimal(38,0)") * 100 < F.col("a").cast("decimal(38,0)") * share))
    rows = rows.select("*", F.expr(score("a", "l1", "r1")).alias("s1"), F.expr(f"case when l2 is not null then {score('a', 'l2', 'r2')} end").alias("s2"))
    second = F.col("s2") < F.col("s1")
    rows = rows.select(
        "lang", "phrase", "a", F.when(second, F.col("l2")).otherwise(F.col("l1")).alias("l"), F.when(second, F.col("r2")).otherwise(F.col("r1")).alias("r"),
        F.when(second, F.col("s2")).otherwise(F.col("s1")).alias("score"),
    )
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(salt_parts(rows))))
    few = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= top)
    best = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    words = known.where("words = 0").select("lang", F.col("a").alias("n"))
    return lookup_join(best, words, ["lang"], "phrase").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
