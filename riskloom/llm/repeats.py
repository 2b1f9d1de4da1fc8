"""Removal of byte strings that occur in an earlier document, by suffix order.

A string of 50 bytes can only repeat where its seed (the 24 bytes of it that hash lowest)
repeats, so suffixes need to be sorted only around seeds that two documents share:

1. Equal texts are one text with the smallest id: within a task before the shuffle, then
   in the group of its hash. Copies of it lose all they have.
2. Each group sends the hashes of its seeds, packed, to the bucket of the hash, and learns
   which ones other documents have too.
3. It sends the bytes of the windows around those, equal ones once, to the bucket, where all
   texts around one seed are a problem. Their suffixes are sorted by linear grouping
   (``lyndon``); neighbours in that order that share 50 bytes form a class, whose smallest
   id decides. A problem of many texts is first split by 13 bytes beside the seed, on the
   side where a window is sure to reach that far.
4. The group gets back the spans that an earlier document covers, and cuts them out.

What is shuffled per text is one packed row per pair of group and bucket, and each text
once. No step compares all pairs, drops or caps anything.
"""

from __future__ import annotations

import hashlib
import pickle
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm import lyndon, seeds
from riskloom.llm.common import fresh_worker, partitions, quoted, text_of
from riskloom.llm.seeds import GRAM, LENGTH

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Ids behind all others stand for null: a document without id is never the earlier one.
NO_ID = np.iinfo(np.int64).max
SIDE = (LENGTH - GRAM) // 2
# Texts of a problem above which it is split, and bytes that are sorted side by side.
MANY, SORTED = 64, 1 << 19
_HASH_BITS = 39


def _pack(*arrays: object) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(pickle.dumps(arrays, 5))


def _unpack(blob: bytes) -> tuple:
    return pickle.loads(zstandard.ZstdDecompressor().decompress(blob))


def _pack_sorted(values: np.ndarray) -> bytes:
    """Ascending 40-bit numbers, byte by byte: the high bytes compress well."""
    return _pack(np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].T))


def _unpack_sorted(blob: bytes) -> np.ndarray:
    (planes,) = _unpack(blob)
    wide = np.zeros((planes.shape[1], 8), np.uint8)
    wide[:, :5] = planes.T
    return wide.reshape(-1).view("<u8")


def _collapse(groups: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: dict[bytes, int] = {}  # the smallest id this task has sent for a text
        for batch in batches:
            ids = batch.column("id").fill_null(int(NO_ID)).to_numpy()
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            shas = [hashlib.sha256(t).digest() for t in texts]
            take, bare = [], []
            for i, (s, d) in enumerate(zip(shas, ids.tolist())):
                if s not in sent or d < sent[s]:
                    bare.append(s in sent)  # a smaller id follows without the text
                    sent[s] = d
                    take.append(i)
            yield pa.RecordBatch.from_pydict(
                {"g": [int.from_bytes(shas[i][:4], "little") % groups for i in take], "sha": [shas[i] for i in take],
                 "id": ids[take], "text": [None if b else texts[i] for i, b in zip(take, bare)]},
                schema=pa.schema([("g", pa.int32()), ("sha", pa.binary()), ("id", pa.int64()), ("text", pa.binary())]),
            )

    return run


def _texts(table: pa.Table) -> tuple[list[bytes], list[bytes], np.ndarray]:
    """(hash, text, smallest id) of a group's texts, by hash: the same numbers whenever it is read."""
    fresh_worker()
    known: dict[bytes, list] = {}
    for s, d, t in zip(*(table.column(c).to_pylist() for c in ("sha", "id", "text"))):
        seen = known.setdefault(s, [d, t])
        seen[0] = min(seen[0], d)
        seen[1] = t if seen[1] is None else seen[1]
    shas = sorted(known)
    return shas, [known[s][1] for s in shas], np.array([known[s][0] for s in shas], np.int64)


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashes >> np.uint64(_HASH_BITS)) % np.uint64(buckets)).astype(np.int64)


def _short(hashes: np.ndarray) -> np.ndarray:
    return hashes & np.uint64((1 << _HASH_BITS) - 1)


_BLOBS = pa.schema([("bucket", pa.int32()), ("g", pa.int32()), ("blob", pa.binary())])


def _blobs(rows: list[tuple[int, int, bytes]]) -> pa.Table:
    return pa.Table.from_pylist([dict(zip(_BLOBS.names, r)) for r in rows], schema=_BLOBS)


def _send_seeds(buckets: int):
    def run(table: pa.Table) -> pa.Table:
        _, texts, _ = _texts(table)
        parts = [(w, h) for w, _, _, _, h in seeds.blocks(texts)]
        if not parts or not sum(len(w) for w, _ in parts):
            return _blobs([])
        who, hashes = (np.concatenate(x) for x in zip(*parts))
        by = np.lexsort((who, hashes))
        who, hashes = who[by], hashes[by]
        head = np.ones(len(who), bool)
        head[1:] = hashes[1:] != hashes[:-1]
        # seen in two documents of this group already
        several = np.logical_or.reduceat(np.concatenate([[False], (who[1:] != who[:-1]) & ~head[1:]]), np.flatnonzero(head))
        hashes = hashes[head]
        bucket = _bucket(hashes, buckets)
        value = _short(hashes) << np.uint64(1) | several.astype(np.uint64)
        by = np.lexsort((value, bucket))
        bucket, value = bucket[by], value[by]
        g = table.column("g")[0].as_py()
        cuts = np.flatnonzero(np.diff(bucket)) + 1
        firsts = bucket[np.concatenate([[0], cuts])].tolist()
        return _blobs([(b, g, _pack_sorted(v)) for b, v in zip(firsts, np.split(value, cuts))])

    return run


def _find_shared(table: pa.Table) -> pa.Table:
    values = [_unpack_sorted(b) for b in table.column("blob").to_pylist()]
    every = np.concatenate(values)
    h = every >> np.uint64(1)
    by = np.argsort(h, kind="stable")
    h, several = h[by], (every[by] & np.uint64(1)).astype(bool)
    same = h[1:] == h[:-1]
    several[1:] |= same
    several[:-1] |= same
    shared = np.zeros(len(every), bool)
    shared[by] = several
    cuts = np.cumsum([len(v) for v in values])[:-1]
    out = [(b, g, _pack_sorted(v[s] >> np.uint64(1))) for b, g, v, s in zip(table.column("bucket").to_pylist(), table.column("g").to_pylist(), values, np.split(shared, cuts)) if s.any()]
    return _blobs(out)


def _send_windows(buckets: int):
    def run(table: pa.Table, shared: pa.Table) -> pa.Table:
        if not table.num_rows or not shared.num_rows:
            return _blobs([])
        _, texts, ids = _texts(table)
        known = np.sort(np.concatenate([
            _unpack_sorted(v) | np.uint64(b << _HASH_BITS) for b, v in zip(shared.column("bucket").to_pylist(), shared.column("blob").to_pylist())
        ]))
        parts = []
        for part in seeds.blocks(texts):
            hashes = part[4]
            bucket = _bucket(hashes, buckets)
            look = _short(hashes) | bucket.astype(np.uint64) << np.uint64(_HASH_BITS)
            at = np.minimum(np.searchsorted(known, look), len(known) - 1)
            hit = known[at] == look
            parts.append([x[hit] for x in (*part, bucket)])
        who, first, last, gram, hashes, bucket = (np.concatenate(x) for x in zip(*parts))
        by = np.argsort(bucket, kind="stable")
        g = table.column("g")[0].as_py()
        out = []
        for some in np.split(by, np.flatnonzero(np.diff(bucket[by])) + 1):
            if not len(some):
                continue
            # equal windows around a seed once, with all their places
            number: dict[tuple[int, bytes], int] = {}
            grams, which = [], []
            for w, a, z, q, h in zip(*(x[some].tolist() for x in (who, first, last, gram, hashes))):
                key = (h, texts[w][a : z + LENGTH - 1])
                k = number.setdefault(key, len(number))
                if k == len(grams):
                    grams.append(q - a)
                which.append(k)
            which = np.array(which, np.int32)
            owner = ids[who[some]]
            least = np.full(len(number), NO_ID)
            np.minimum.at(least, which, owner)
            strings = [t for _, t in number]
            out.append((int(bucket[some[0]]), g, _pack(
                b"".join(strings), np.fromiter(map(len, strings), np.int32, len(strings)), np.array(grams, np.int16),
                np.array([h for h, _ in number], np.uint64), least, which, owner, who[some].astype(np.int32), first[some],
            )))
        return _blobs(out)

    return run


def earliest(texts: list[bytes], grams: np.ndarray, hashes: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The smallest id that has the same window, for every window of every text, text by text."""
    counts = np.fromiter(map(len, texts), np.int64, len(texts)) - LENGTH + 1
    place = np.cumsum(counts) - counts
    least = np.repeat(ids, counts)
    _, problem, many = np.unique(hashes, return_inverse=True, return_counts=True)
    # (problem, side, bytes beside the seed): text, and which of its windows
    keys: dict[tuple, int] = {}
    parts: list[tuple[int, int, bytes, int, int]] = []
    for i, (p, t, q) in enumerate(zip(problem.tolist(), texts, grams.tolist())):
        if many[p] <= MANY:
            parts.append((keys.setdefault((p,), len(keys)), 0, t, i, 0))
            continue
        middle = q - SIDE + 1  # windows before it hold SIDE bytes left of the seed, the others as many right of it
        if middle > 0:
            end = min(len(t), middle + LENGTH - 1)
            parts.append((keys.setdefault((p, "left", t[q - SIDE : q]), len(keys)), 0, t[:end], i, 0))
        middle = max(0, middle)
        if len(t) - middle >= LENGTH:
            parts.append((keys.setdefault((p, "right", t[q + GRAM : q + GRAM + SIDE]), len(keys)), 0, t[middle:], i, middle))
    sizes = np.bincount([x[0] for x in parts], [len(x[2]) for x in parts], minlength=len(keys))
    # problems of similar size are sorted side by side
    rank = np.empty(len(sizes), np.int64)
    rank[np.argsort(sizes, kind="stable")] = np.arange(len(sizes))
    parts.sort(key=lambda x: rank[x[0]])
    some: list = []
    held = 0
    for k, part in enumerate(parts):
        some.append(part)
        held += len(part[2])
        if k + 1 == len(parts) or held >= SORTED and parts[k + 1][0] != part[0]:
            _classes(some, rank, place, ids, least)
            some, held = [], 0
    return least


def _classes(parts: list, rank: np.ndarray, place: np.ndarray, ids: np.ndarray, least: np.ndarray) -> None:
    """Sort the suffixes of some problems; lower ``least`` to the smallest id of each class."""
    texts = [x[2] for x in parts]
    order, data, begins = lyndon.suffix_order(texts, np.array([rank[x[0]] for x in parts]))
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    inside = np.full(len(data), -1, np.int64)
    owner = np.repeat(np.arange(len(texts)), sizes)
    offset = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    inside[np.repeat(begins, sizes) + offset] = np.where(offset + LENGTH <= sizes[owner], owner, -1)
    at = order[inside[order] >= 0]  # the windows, in suffix order
    if not len(at):
        return
    who = inside[at]
    head = np.ones(len(at), bool)
    problem = np.array([x[0] for x in parts])[who]
    steps = np.arange(LENGTH)
    for a in range(1, len(at), 50_000):
        z = min(len(at), a + 50_000)
        ahead = data[at[a - 1 : z][:, None] + steps]
        head[a:z] = (ahead[1:] != ahead[:-1]).any(axis=1) | (problem[a:z] != problem[a - 1 : z - 1])
    text = np.array([x[3] for x in parts])[who]
    window = at - begins[who] + np.array([x[4] for x in parts])[who]
    heads = np.flatnonzero(head)
    lowest = np.repeat(np.minimum.reduceat(ids[text], heads), np.diff(np.append(heads, len(at))))
    np.minimum.at(least, place[text] + window, lowest)


def _find_spans(table: pa.Table) -> pa.Table:
    number: dict[tuple[int, bytes], int] = {}
    grams: list[int] = []
    least: list[int] = []
    places = []
    for b, g, blob in zip(*(table.column(c).to_pylist() for c in ("bucket", "g", "blob"))):
        joined, sizes, gram, hashes, first_id, which, owner, who, first = _unpack(blob)
        ends = np.cumsum(sizes).tolist()
        here = []
        for a, z, q, h, d in zip([0, *ends[:-1]], ends, gram.tolist(), hashes.tolist(), first_id.tolist()):
            k = number.setdefault((h, joined[a:z]), len(number))
            if k == len(grams):
                grams.append(q)
                least.append(d)
            elif d < least[k]:
                least[k] = d
            here.append(k)
        places.append((b, g, np.array(here)[which], owner, who, first))
    texts = [t for _, t in number]
    hashes = np.array([h for h, _ in number], np.uint64)
    lowest = earliest(texts, np.array(grams), hashes, np.array(least, np.int64))
    counts = np.fromiter(map(len, texts), np.int64, len(texts)) - LENGTH + 1
    base = np.cumsum(counts) - counts
    out = []
    for b, g, which, owner, who, first in places:
        n = counts[which]
        flat = lyndon._ranges(base[which], n)
        row = np.repeat(np.arange(len(which)), n)
        late = lowest[flat] < owner[row]
        window = flat - base[which][row]
        keep = np.flatnonzero(late)
        if not len(keep):
            continue
        row, window = row[keep], window[keep]
        new = np.ones(len(keep), bool)
        new[1:] = (row[1:] != row[:-1]) | (window[1:] != window[:-1] + 1)
        heads = np.flatnonzero(new)
        tails = np.append(heads[1:], len(keep)) - 1
        r = row[heads]
        out.append((b, g, _pack(who[r], first[r] + window[heads], first[r] + window[tails] + LENGTH)))
    return _blobs(out)


def _merge(who: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of covered bytes, by text."""
    by = np.lexsort((start, who))
    who, start, end = who[by], start[by], end[by]
    far = np.maximum.accumulate(end + (who << 40)) - (who << 40)
    new = np.ones(len(who), bool)
    new[1:] = (who[1:] != who[:-1]) | (start[1:] > far[:-1])
    heads = np.flatnonzero(new)
    tails = np.append(heads[1:], len(who)) - 1
    return who[heads], start[heads], far[tails]


_RESULT = pa.schema([("sha", pa.binary()), ("first", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.binary())])


def _cut(whole_characters: bool, give_text: bool):
    def run(table: pa.Table, spans: pa.Table) -> pa.Table:
        if not table.num_rows:
            return _RESULT.empty_table()
        shas, texts, ids = _texts(table)
        cuts: dict[int, list[tuple[int, int]]] = {}
        if spans.num_rows:
            found = [_unpack(b) for b in spans.column("blob").to_pylist()]
            who, start, end = _merge(*(np.concatenate(x).astype(np.int64) for x in zip(*found)))
            for w, s, e in zip(who.tolist(), start.tolist(), end.tolist()):
                cuts.setdefault(w, []).append((s, e))
        rows = []
        for i, t in enumerate(texts):
            kept, at, removed, n = [], 0, 0, 0
            for s, e in cuts.get(i, ()):
                if whole_characters:
                    while s < e and t[s] & 0xC0 == 0x80:
                        s += 1
                    while s < e < len(t) and t[e] & 0xC0 == 0x80:
                        e -= 1
                if s < e:
                    kept.append(t[at:s])
                    at, removed, n = e, removed + e - s, n + 1
            left = b"".join([*kept, t[at:]])
            rows.append((shas[i], int(ids[i]), removed, n, hashlib.sha256(left).hexdigest(), left if give_text else None))
        return pa.Table.from_pylist([dict(zip(_RESULT.names, r)) for r in rows], schema=_RESULT)

    return run


def _results(docs: DataFrame, key: str, text: str, whole_characters: bool, give_text: bool) -> DataFrame:
    """One row per distinct text: (sha, first, n_removed, n_spans, kept_sha256, kept)."""
    n = partitions(docs.sparkSession)
    rows = docs.select(_id(docs, key).alias("id"), text_of(text).alias("text"))
    dealt = rows.mapInArrow(_collapse(2 * n), "g int, sha binary, id bigint, text binary").repartition(n, "g")
    blobs = "bucket int, g int, blob binary"
    shared = dealt.groupBy("g").applyInArrow(_send_seeds(n), blobs).groupBy("bucket").applyInArrow(_find_shared, blobs)
    windows = dealt.groupBy("g").cogroup(shared.groupBy("g")).applyInArrow(_send_windows(n), blobs)
    spans = windows.groupBy("bucket").applyInArrow(_find_spans, blobs)
    return dealt.groupBy("g").cogroup(spans.groupBy("g")).applyInArrow(
        _cut(whole_characters, give_text), "sha binary, first bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary"
    )


def _id(docs: DataFrame, key: str) -> Column:
    if docs.schema[key].dataType.typeName() not in ("byte", "short", "integer", "long"):
        raise TypeError(f"{key} must be an integer: documents are ordered by it")
    return F.col(quoted(key)).cast("long")


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row; the id keeps its name.

    Removed is each byte that lies in a string of 50 bytes which begins in a document with a
    smaller id too. Null texts count as empty. A null id is never the smaller one. Rows with
    equal ids are equally early, so they take nothing from each other.
    """
    made = _results(docs, key, text, False, False).drop("kept")
    rows = docs.select(quoted(key), _id(docs, key).alias("__id"), F.unhex(F.sha2(text_of(text), 256)).alias("sha"), F.octet_length(text_of(text)).cast("long").alias("n_bytes"))
    copy = (F.coalesce("__id", F.lit(int(NO_ID))) > F.col("first")) & (F.col("n_bytes") >= LENGTH)
    joined = rows.join(made, "sha")
    return joined.select(
        quoted(key), "n_bytes",
        F.when(copy, F.col("n_bytes")).otherwise(F.col("n_removed")).alias("n_removed"),
        F.when(copy, F.lit(1).cast("long")).otherwise(F.col("n_spans")).alias("n_spans"),
        F.when(copy, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.col("kept_sha256")).alias("kept_sha256"),
    )


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", n_chars: str | None = "n_chars") -> DataFrame:
    """``docs`` with repeated strings cut from ``text``, character by whole character.

    All rows and columns stay; ``n_chars``, where there is such a column, counts anew. A null
    text stays null.
    """
    made = _results(docs, key, text, True, True).select("sha", "first", "kept")
    # the row travels as one struct: no column name can clash
    packed = docs.select(
        F.struct(*map(quoted, docs.columns)).alias("row"), F.unhex(F.sha2(F.col(quoted(text)), 256)).alias("sha"),
        F.octet_length(quoted(text)).alias("n_bytes"), _id(docs, key).alias("id"), F.col(quoted(text)).isNull().alias("none"),
    )
    joined = packed.where("not none").join(made, "sha")
    copy = (F.coalesce("id", F.lit(int(NO_ID))) > F.col("first")) & (F.col("n_bytes") >= LENGTH)
    out = joined.withColumn("left", F.when(copy, F.lit("")).otherwise(F.col("kept").cast("string")))

    def cell(c: str) -> Column:
        if c == text:
            return F.col("left").alias(c)
        if c == n_chars:
            return F.length("left").cast(docs.schema[c].dataType).alias(c)
        return F.col(f"row.{quoted(c)}").alias(c)

    return out.select(*map(cell, docs.columns)).unionByName(packed.where("none").select("row.*"))
