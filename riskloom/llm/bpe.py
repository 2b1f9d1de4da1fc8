"""Byte-level BPE over rank files, in parallel inside a document.

A document longer than one chunk is cut into overlapping chunks, which are pre-tokenised
in parallel. A match of the pattern depends only on the text from its start onwards, so
once two neighbouring chunks have a pre-token boundary at the same place of their overlap
they agree from there on. The first such place ends one piece and begins the next; a chunk
that never agrees with its predecessor is joined to it, and so are those behind it. The pieces, each a whole number of
pre-tokens, are encoded in parallel and put together in order. Documents of one chunk are
one piece. Long texts that occur repeatedly are encoded once.

Decoding concatenates the raw bytes of the tokens: an id may hold part of a character.
"""

from __future__ import annotations

import base64
import hashlib
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import partitions, process_cache, quoted, text_of

cloudpickle.register_pickle_by_value(sys.modules[__name__])

CHUNK, OVERLAP = 32_768, 1_024


def encoding(path: str, pattern: str) -> tuple[tiktoken.Encoding, list[str]]:
    """The tokenizer of a rank file and its ids as decimal text; read once per worker."""

    def make() -> tuple[tiktoken.Encoding, list[str]]:
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        names = [str(i) for i in range(max(ranks.values()) + 1)]
        return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), names

    return process_cache(("bpe", path, pattern), make)


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """All columns of ``docs`` and ``ids`` array<int>; a null text counts as empty."""
    return _whole(docs, path, pattern, text, chunk, overlap, False)


def digests(docs: DataFrame, path: str, pattern: str, text: str = "text", keep: list[str] | None = None, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """The columns ``keep`` with n_tokens, ids_sha256 and decoded_sha256 (of the decoded ids)."""
    return _whole(docs if keep is None else docs.select(*map(quoted, [*dict.fromkeys([*keep, text])])), path, pattern, text, chunk, overlap, True, keep)


def decode(rows: DataFrame, path: str, pattern: str, ids: str = "ids", to: str = "bytes") -> DataFrame:
    """Adds the raw bytes of an array of ids (null: null); unknown ids raise."""
    kept = [c for c in rows.columns if c != to]
    schema = ", ".join([f"{quoted(f.name)} {f.dataType.simpleString()}" for f in rows.select(*map(quoted, kept)).schema] + [f"{quoted(to)} binary"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, _ = encoding(path, pattern)
        for batch in batches:
            raw = [None if v is None else coder.decode_bytes(v) for v in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(raw, pa.binary())], names=[*kept, to])

    return rows.select(*map(quoted, kept), F.col(quoted(ids)).alias("__ids")).mapInArrow(run, schema)


def boundaries(text: str, pattern: str, start: int, whole: bool) -> list[int]:
    """Starts of the pre-tokens; of a chunk that does not end its document, only those the cut cannot touch."""
    found = [m.start() for m in regex.finditer(pattern, text)]
    if not whole:  # the last two matches may look beyond the end
        found = found[:-2]
    return [start + i for i in found]


def _whole(docs, path, pattern, text, chunk, overlap, digest, keep=None) -> DataFrame:
    if not 0 < overlap < chunk:
        raise ValueError("the overlap must be shorter than a chunk")
    names = docs.columns if keep is None else keep
    made = "n_tokens bigint, ids_sha256 string, decoded_sha256 string" if digest else "ids array<int>"
    row = docs.select(*map(quoted, names)).schema.simpleString()
    rows = docs.select(F.struct(*map(quoted, names)).alias("row"), text_of(text).alias("text"))
    short = rows.where(F.length("text") <= chunk).mapInArrow(_encode_short(path, pattern, digest), f"row {row}, r struct<{_colons(made)}>")
    long = rows.where(F.length("text") > chunk).select("row", "text", F.sha2("text", 256).alias("key"))
    known = _long(long.select("key", "text"), path, pattern, chunk, overlap, digest, made)
    joined = long.select("row", "key").join(known, "key").select("row", "r")
    out = short.unionByName(joined)
    extra = [c for c in ("n_tokens", "ids_sha256", "decoded_sha256", "ids") if c in made.replace(",", "").split()]
    return out.select(*[F.col(f"row.{quoted(c)}").alias(c) for c in names if c not in extra], *[F.col(f"r.{c}").alias(c) for c in extra])


def _colons(fields: str) -> str:
    return ", ".join(f.strip().replace(" ", ":", 1) for f in fields.split(","))


def _result(values: list[tuple[int, str, str]] | list[np.ndarray], digest: bool) -> pa.StructArray:
    if not digest:
        return pa.StructArray.from_arrays([pa.array(values, pa.list_(pa.int32()))], names=["ids"])
    n, a, b = zip(*values) if values else ((), (), ())
    return pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())], names=["n_tokens", "ids_sha256", "decoded_sha256"])


def _encode_short(path: str, pattern: str, digest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, names = encoding(path, pattern)
        for batch in batches:
            out = []
            for t in batch.column("text").to_pylist():
                ids = coder.encode_ordinary(t)
                if digest:
                    listed = ",".join([names[i] for i in ids]).encode()
                    out.append((len(ids), hashlib.sha256(listed).hexdigest(), hashlib.sha256(coder.decode_bytes(ids)).hexdigest()))
                else:
                    out.append(ids)
            yield pa.RecordBatch.from_arrays([batch.column("row"), _result(out, digest)], names=["row", "r"])

    return run


def _cut(chunk: int, overlap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, text in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist()):
                starts = range(0, len(text), chunk)
                for at in range(0, len(starts), 16):  # a document at a time, in small batches
                    some = starts[at : at + 16]
                    yield pa.RecordBatch.from_pydict(
                        {"key": [key] * len(some), "c": [s // chunk for s in some], "whole": [s + chunk + overlap >= len(text) for s in some],
                         "text": [text[s : s + chunk + overlap] for s in some]},
                        schema=pa.schema([("key", pa.string()), ("c", pa.int64()), ("whole", pa.bool_()), ("text", pa.string())]),
                    )

    return run


def _pretokenise(pattern: str, chunk: int, overlap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            heads, tails = [], []
            for c, whole, t in zip(*(batch.column(x).to_pylist() for x in ("c", "whole", "text"))):
                found = boundaries(t, pattern, c * chunk, whole)
                heads.append([b for b in found if b < c * chunk + overlap])
                tails.append([b for b in found if b >= (c + 1) * chunk])
            lists = [pa.array(x, pa.list_(pa.int64())) for x in (heads, tails)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *lists], names=[*batch.schema.names, "heads", "tails"])

    return run


def _encode_pieces(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, _ = encoding(path, pattern)
        for batch in batches:
            ids = [np.array(coder.encode_ordinary(t), "<i4").tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("piece"), pa.array(ids, pa.binary())], names=["key", "piece", "ids"])

    return run


def _assemble(path: str, pattern: str, digest: bool):
    """Pieces of a document arrive in order; the digests are updated piece by piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, names = encoding(path, pattern)
        key, state = None, None

        def done() -> pa.RecordBatch:
            value = (state[0], state[1].hexdigest(), state[2].hexdigest()) if digest else np.concatenate(state[3])
            return pa.RecordBatch.from_arrays([pa.array([key]), _result([value], digest)], names=["key", "r"])

        for batch in batches:
            for k, raw in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist()):
                if k != key:
                    if key is not None:
                        yield done()
                    key, state = k, [0, hashlib.sha256(), hashlib.sha256(), []]
                ids = np.frombuffer(raw, "<i4")
                if digest:
                    listed = ",".join([names[i] for i in ids.tolist()]).encode()
                    state[1].update(b"," + listed if state[0] and len(ids) else listed)
                    state[2].update(coder.decode_bytes(ids.tolist()))
                    state[0] += len(ids)
                else:
                    state[3].append(ids)
        if key is not None:
            yield done()

    return run


def _long(long: DataFrame, path, pattern, chunk, overlap, digest, made) -> DataFrame:
    n = partitions(long.sparkSession)
    texts = long.dropDuplicates(["key"])
    chunks = texts.mapInArrow(_cut(chunk, overlap), "key string, c bigint, whole boolean, text string")
    chunks = chunks.repartition(n, "key", "c")
    marked = chunks.mapInArrow(_pretokenise(pattern, chunk, overlap), "key string, c bigint, whole boolean, text string, heads array<bigint>, tails array<bigint>")
    # where chunk c agrees with its predecessor: computed from the overlaps alone
    marks = marked.select("key", "c", "heads", F.lag("tails").over(Window.partitionBy("key").orderBy("c")).alias("before"), "text")
    met = marks.withColumn("met", F.when(F.col("c") == 0, F.lit(0).cast("long")).otherwise(F.array_min(F.array_intersect("heads", "before"))))
    order = Window.partitionBy("key").orderBy("c")
    # two chunks may agree on a wrong boundary if the first of them never met its own predecessor
    sure = F.min(F.col("met").isNotNull()).over(order.rowsBetween(Window.unboundedPreceding, 0))
    synced = met.withColumn("at", F.when(sure, F.col("met")))
    placed = synced.select(
        "key", "c", "text", "at",
        F.last("at", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("piece"),
        F.lead("at").over(order).alias("next_at"),
        F.lead("c").over(order).alias("next_c"),
    )
    begin = F.coalesce(F.col("at") - F.col("c") * chunk, F.lit(0))
    end = F.when(F.col("next_c").isNull(), F.length("text")).when(F.col("next_at").isNull(), F.lit(chunk)).otherwise(F.col("next_at") - F.col("c") * chunk)
    cut = placed.select("key", "piece", "c", F.substring("text", (begin + 1).cast("int"), (end - begin).cast("int")).alias("text"))
    joined = cut.groupBy("key", "piece").agg(F.array_sort(F.collect_list(F.struct("c", "text"))).alias("parts"))
    pieces = joined.select("key", "piece", F.concat_ws("", F.col("parts.text")).alias("text"))
    coded = pieces.mapInArrow(_encode_pieces(path, pattern), "key string, piece bigint, ids binary")
    ordered = coded.repartition(n, "key").sortWithinPartitions("key", "piece")
    return ordered.mapInArrow(_assemble(path, pattern, digest), f"key string, r struct<{_colons(made)}>")
