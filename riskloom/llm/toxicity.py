"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on toxic and one on ordinary text. A document
is cut into windows, one for every run of letters and digits. Every window is compressed under both dictionaries. How many bytes the toxic one saves means
different things for a short and a long window, so the pair (window length, bytes saved)
is the cell that a window falls in, and a ridge-regularised logistic regression on the
shares and counts of the cells calibrates all their thresholds together.

Window lengths depend on the window alone, so a worker remembers those it has compressed.
"""

from __future__ import annotations

import sys
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256
from math import sqrt

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import BoundedMemo, arrow_map, process_cache, quoted, text_of

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Windows are runs of letters, digits and bytes of longer characters; A-Z count as a-z.
FOLD = bytes(b if bytes([b]).isalnum() or b > 127 else 32 for b in range(256)).lower()
LENGTHS, LOW, SAVED = 12, 4, 16
CELLS = LENGTHS * SAVED
DICTIONARY_BYTES = 16384
# Labelled rows of each class that the fit may look at.
TOXIC_ROWS, ORDINARY_ROWS = 2000, 4000
RIDGE = 1.0
# The ordinary dictionary is trained on this share of the sampled ordinary texts, so that the
# calibration also sees texts the dictionary does not know, and on every STRIDE-th window of
# them. (All windows: more false alarms on held-out rows, 0.0026 against 0.0004 of check_s.)
ORDINARY_SHARE, STRIDE = 0.5, 13
# A window tells if its share of toxic documents is higher by so many standard errors, and if
# at least so many toxic documents have it (fewer in a small sample: 1 + an eighth of it).
TELLING_ERRORS, TELLING_DOCUMENTS = 5, 8


@dataclass(frozen=True)
class ToxicityModel:
    """Two dictionaries and the calibration; ``None`` dictionaries score a constant."""

    toxic: bytes | None
    ordinary: bytes | None
    center: np.ndarray | None
    scale: np.ndarray | None
    weights: np.ndarray | None
    constant: float = 0.0

    def key(self) -> str:
        return sha256((self.toxic or b"") + b"|" + (self.ordinary or b"")).hexdigest()


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    params = zstandard.ZstdCompressionParameters(
        window_log=14, hash_log=14, chain_log=14, search_log=6, min_match=3, target_length=8,
        strategy=zstandard.STRATEGY_LAZY2, write_checksum=0, write_content_size=0, write_dict_id=0,
    )
    data = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    data.precompute_compress(compression_params=params)
    return zstandard.ZstdCompressor(dict_data=data, compression_params=params)


def _cells(model: ToxicityModel) -> BoundedMemo:
    def make() -> BoundedMemo:
        toxic, ordinary = _compressor(model.toxic), _compressor(model.ordinary)

        def cell(window: bytes) -> int:
            framed = (b" " + window + b" ") * 3
            saved = len(ordinary.compress(framed)) - len(toxic.compress(framed))
            return min(len(window), LENGTHS - 1) * SAVED + max(0, min(SAVED - 1, saved + LOW))

        return BoundedMemo(cell)

    return process_cache(("toxicity", model.key()), make)


def windows(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


def features(text: bytes, cells: BoundedMemo) -> np.ndarray:
    """Shares and counts of the cells, and three summaries of the bytes saved."""
    inside = windows(text) or [b""]
    found = np.fromiter(map(cells.__getitem__, inside), np.int64, len(inside))
    counts = np.bincount(found, minlength=CELLS)
    saved = found % SAVED - LOW
    summary = [saved.max(), saved.mean(), saved.sum() / sqrt(len(found))]
    return np.concatenate([np.sqrt(counts / len(found)), np.log1p(counts), summary])


def _train(samples: list[bytes]) -> bytes:
    """A trained dictionary; too few samples for the trainer serve as they are."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=48, d=6, level=3).as_bytes()
    except zstandard.ZstdError:
        return (b"".join(samples)[-DICTIONARY_BYTES:]).ljust(8, b" ")


def _telling_windows(toxic: list[bytes], ordinary: list[bytes]) -> list[bytes]:
    """Occurrences, in toxic text, of windows that clearly more toxic than ordinary documents have."""
    in_toxic = Counter(w for x in toxic for w in set(windows(x)))
    in_ordinary = Counter(w for x in ordinary for w in set(windows(x)))
    n, m = len(toxic), len(ordinary)

    def telling(w: bytes) -> bool:
        a, b = in_toxic[w], in_ordinary[w]
        p = (a + b + 1) / (n + m + 2)
        return len(w) >= 3 and a >= min(TELLING_DOCUMENTS, 1 + n // 8) and a / n - b / m > TELLING_ERRORS * sqrt(p * (1 - p) * (1 / n + 1 / m))

    keep = {w for w in in_toxic if telling(w)}
    return [b" " + w + b" " for x in toxic for w in windows(x) if w in keep]


def _regress(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    x = np.c_[x, np.ones(len(x))]
    w = np.zeros(x.shape[1])
    ridge = RIDGE * weight.sum() / 100
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(h, x.T @ (weight * (p - y)) + ridge * w)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit_texts(toxic: list[str], ordinary: list[str], toxic_weight: float = 1.0, ordinary_weight: float = 1.0) -> ToxicityModel:
    """Fit on texts in memory. Without both classes the model scores 0 (or 1, if all are toxic)."""
    a = [x.encode() for x in dict.fromkeys(toxic)]
    b = [x.encode() for x in dict.fromkeys(ordinary)]
    if not a or not b:
        return ToxicityModel(None, None, None, None, None, 1.0 if a else 0.0)
    every = [(b" " + w + b" ") for x in b[: int(len(b) * ORDINARY_SHARE) + 1] for w in windows(x)[::STRIDE]]
    told = _telling_windows(a, b) or [b" " + w + b" " for x in a for w in windows(x)]
    model = ToxicityModel(_train(told), _train(every or [b" "]), None, None, None)
    cells = _cells(model)
    x = np.array([features(t, cells) for t in a + b])
    y = np.r_[np.ones(len(a)), np.zeros(len(b))]
    center, scale = x.mean(0), np.maximum(x.std(0), 0.02)
    weight = np.r_[np.full(len(a), toxic_weight), np.full(len(b), ordinary_weight)]
    return ToxicityModel(model.toxic, model.ordinary, center, scale, _regress((x - center) / scale, y, weight))


def fit(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", key: str = "doc_id", text: str = "text",
    toxic_rows: int = TOXIC_ROWS, ordinary_rows: int = ORDINARY_ROWS,
) -> ToxicityModel:
    """Fit on a bounded sample: of each class the labelled rows whose key hashes lowest.

    Rows with a null key, label or text teach nothing; of rows that share an id, the text
    that sorts first does. The class sizes of all ``labels`` weigh the sample.
    """
    known = labels.where(F.col(quoted(key)).isNotNull()).select(F.col(quoted(key)).alias("key"), F.col(quoted(label)).alias("y"))
    sizes = {r["y"]: r["n"] for r in known.where("y in (0, 1)").groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    picked = {}
    for y, most in ((1, toxic_rows), (0, ordinary_rows)):
        chosen = known.where(F.col("y") == y).select("key").distinct().orderBy(F.xxhash64("key"), "key").limit(most)
        rows = docs.join(F.broadcast(chosen), docs[quoted(key)] == chosen["key"], "left_semi")
        # one text an id, however often a table repeats it: at most ``most`` rows reach the driver
        once = rows.groupBy(F.col(quoted(key)).alias("key")).agg(F.min(quoted(text)).alias("text")).where("text is not null")
        picked[y] = [r[0] for r in once.orderBy(F.xxhash64("key"), "key").select("text").collect()]
    heavy = {y: sizes.get(y, 0) / max(1, min(sizes.get(y, 0), most)) for y, most in ((1, toxic_rows), (0, ordinary_rows))}
    return fit_texts(picked[1], picked[0], heavy[1], heavy[0])


def score(docs: DataFrame, model: ToxicityModel, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all if None) with ``score`` and ``predicted`` behind them.

    Null texts count as empty; an empty text has the score of one empty window. Columns
    named score or predicted that the input has already are replaced.
    """
    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() not in ("score", "predicted")]
    fields = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in docs.select(*map(quoted, kept)).schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = _cells(model) if model.weights is not None else None
        for batch in batches:
            scores = []
            for value in batch.column(batch.num_columns - 1).cast(pa.binary()).to_pylist():
                if cells is None:
                    scores.append(model.constant)
                else:
                    x = (features(value or b"", cells) - model.center) / model.scale
                    z = float(x @ model.weights[:-1] + model.weights[-1])
                    scores.append(1 / (1 + float(np.exp(-max(-30.0, min(30.0, z))))))
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            columns += [pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, "score", "predicted"])

    rows = docs.select(*map(quoted, kept), text_of(text).alias("__text"))
    return arrow_map(rows, run, f"{fields + ', ' if fields else ''}score double, predicted int")


def held_out(key: str = "doc_id") -> Column:
    """True for rows that never teach: crc32 of the key as text is a multiple of 5 (null: false)."""
    return F.coalesce(F.crc32(F.col(quoted(key)).cast("string").cast("binary")) % 5 == 0, F.lit(False))
