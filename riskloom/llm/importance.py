"""Quality by importance resampling.

Two generative models of hashed byte n-grams: one counts all documents (raw), one a
sample of labelled good ones (target). A document's log weight is its log-likelihood
ratio, the sum over its n-grams. A ``power`` above 0 divides it by that power of their
number: with 0.5 the weights of long and short documents have noise of one size, with 1
they are means. Adding Gumbel noise to the log weights and taking
the k largest draws k documents without replacement in proportion to the weights. The
noise hashes seed and id: a recomputed task draws the same.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import quoted, scratch, text_of
from riskloom.operators.order import dense_positions

cloudpickle.register_pickle_by_value(sys.modules[__name__])

GRAM, BUCKETS = 4, 1 << 16
TARGET_ROWS = 20_000


def grams(text: bytes) -> np.ndarray:
    """The bucket of every n-gram of bytes."""
    data = np.frombuffer(text, np.uint8).astype(np.uint32)
    n = len(data) - GRAM + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    h = data[:n].copy()
    for k in range(1, GRAM):
        h = h * np.uint32(0x01000193) + data[k : k + n]
    return ((h * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for text, good in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("good").to_pylist()):
            found = np.bincount(grams(text), minlength=BUCKETS)
            raw += found
            if good:
                target += found
    some = np.flatnonzero(raw)
    yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(raw[some]), pa.array(target[some])], names=["bucket", "raw", "target"])


def fit(docs: DataFrame, good: DataFrame, key: str = "doc_id", text: str = "text", target_rows: int = TARGET_ROWS) -> np.ndarray:
    """Log ratio per bucket. ``good`` holds ids of target documents; of them the ``target_rows``
    with the lowest hashes are used, the raw counts cover every document."""
    known = good.select(F.col(quoted(key)).alias("chosen")).where("chosen is not null").distinct()
    chosen = known.orderBy(F.xxhash64("chosen"), "chosen").limit(target_rows).withColumn("good", F.lit(True))
    slim = docs.select(F.col(quoted(key)).alias("id"), text_of(text).alias("text"))
    rows = slim.join(F.broadcast(chosen), F.col("id") == F.col("chosen"), "left").select("text", F.coalesce("good", F.lit(False)).alias("good"))
    counts = rows.mapInArrow(_count, "bucket int, raw bigint, target bigint").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for r in counts.collect():  # one row per bucket
        raw[r["bucket"]], target[r["bucket"]] = r["raw"], r["target"]
    return np.log((target + 1) / (target.sum() + BUCKETS)) - np.log((raw + 1) / (raw.sum() + BUCKETS))


def weigh(docs: DataFrame, ratio: np.ndarray, key: str = "doc_id", text: str = "text", power: float = 0.0) -> DataFrame:
    """(id, log_weight) of every row; null and empty texts weigh 0."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for t in batch.column("text").cast(pa.binary()).to_pylist():
                found = grams(t)
                out.append(float(ratio[found].sum() / len(found) ** power) if len(found) else 0.0)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(out, pa.float64())], names=["id", "log_weight"])

    return docs.select(F.col(quoted(key)).alias("id"), text_of(text).alias("text")).mapInArrow(run, f"id {kind}, log_weight double")


def gumbel(key: Column, seed: int) -> Column:
    unit = (F.pmod(F.xxhash64(F.lit(seed), key), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    return -F.log(-F.log(unit))


def resample(docs: DataFrame, good: DataFrame, share: float, key: str = "doc_id", text: str = "text", seed: int = 11, power: float = 0.0) -> DataFrame:
    """(doc_id, log_weight, draw, selected) of every row; the rows of the largest draws are selected.

    ceil(share x rows) are. Equal draws (repeated ids with equal weights) go by the place in
    the order, so the number selected is exact; null ids draw like any other.
    """
    if not 0 <= share <= 1:
        raise ValueError("share lies between 0 and 1")
    made = weigh(docs, fit(docs, good, key, text), key, text, power)
    made = scratch(made.select("id", "log_weight", (F.col("log_weight") + gumbel(F.col("id"), seed)).alias("draw")), "draws")
    total = made.count()
    placed = dense_positions(made, ["draw", "id", "log_weight"], ["draw"], "place")
    most = int(np.ceil(share * total))
    return placed.select(F.col("id").alias(key), "log_weight", "draw", (F.col("place") < most).alias("selected"))
