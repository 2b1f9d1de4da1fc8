"""Small helpers that the operators share."""

from __future__ import annotations

import ctypes
import functools
import gc
import sys
import types
import uuid
from collections.abc import Callable, Iterator
from contextvars import ContextVar

import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.session import fresh_path, prepare

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Rows of one Arrow batch that a task hands on, at most.
BATCH = 2000
# Column metadata that names the run a table came from.
MARK = "scratch_scope"


def process_cache(key: object, make: Callable[[], object]) -> object:
    """A value that outlives the task in its Python worker (models, vocabularies, memos).

    A new value takes the place of what other operators left in the worker, so that their
    memos do not add up over the stages of a job.
    """
    store = _store()
    if key not in store:
        fresh_worker()
        store[key] = make()
    return store[key]


def _store() -> dict:
    return sys.modules.setdefault("_llm_process_cache", types.ModuleType("_llm_process_cache")).__dict__


def fresh_worker() -> None:
    """Drop what other operators left in this Python worker and hand freed memory back, once a task."""
    store = _store()
    task = TaskContext.get()
    mine = task.taskAttemptId() if task else None
    if mine is not None and store.get("task") == mine:
        return
    store["task"] = mine
    for old in [k for k in store if isinstance(k, tuple)]:
        del store[old]
    gc.collect()
    pa.default_memory_pool().release_unused()
    if sys.platform.startswith("linux"):
        # what the C library keeps of freed memory counts against the executor's limit
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)


class BoundedMemo(dict):
    """A memo of a pure function that forgets everything once it holds ``most`` entries."""

    def __init__(self, make: Callable[[object], object], most: int = 400_000):
        super().__init__()
        self.make, self.most = make, most

    def __missing__(self, key: object) -> object:
        if len(self) >= self.most:
            self.clear()
        value = self[key] = self.make(key)
        return value


def text_of(col: str) -> Column:
    return F.coalesce(F.col(quoted(col)).cast("string"), F.lit(""))


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def spare(df: DataFrame, name: str) -> str:
    """``name``, or a longer one if the frame has a column of that name already."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def arrow_map(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    return df.mapInArrow(fn, schema)


def spread(df: DataFrame, *keys: Column) -> DataFrame:
    """Deal rows over the shuffle partitions by a key."""
    return df.repartition(partitions(df.sparkSession), *keys)


def partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


class Scope:
    """The scratch tables of one run, which it alone removes."""

    def __init__(self, spark: SparkSession):
        self.spark, self.name, self.paths = spark, uuid.uuid4().hex, []

    def __enter__(self) -> "Scope":
        self.token = _SCOPE.set(self)
        return self

    def __exit__(self, *error: object) -> None:
        _SCOPE.reset(self.token)

    def remove(self) -> None:
        for path in self.paths:
            place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(place, True)
        self.paths = []


_SCOPE: ContextVar[Scope | None] = ContextVar("scope", default=None)


def scratch(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read again; the table belongs to the open scope, if there is one."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    if scope := _SCOPE.get():
        scope.paths.append(path)
    return spark.read.schema(df.schema).parquet(path)


def stage(fn: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """A stage of a pipeline that cleans up behind the one before it.

    The result carries the name of its scope as metadata of its columns, which Parquet keeps. A
    later stage whose documents are read from files that carry it knows by that name that the
    result has been written, and removes just those tables; those of others stay.
    """

    @functools.wraps(fn)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark = prepare(spark)
        known = spark.sparkContext.__dict__.setdefault("_llm_scopes", {})
        for name in {f.metadata.get(MARK) for f in docs.schema.fields} & set(known):
            held = " ".join(docs.inputFiles())
            if not any(path.rsplit("/", 1)[-1] in held for path in known[name].paths):
                known.pop(name).remove()
        with Scope(spark) as own:
            out = fn(spark, docs, sf_dir)
        known[own.name] = own
        return out.select(*[F.col(quoted(f.name)).alias(f.name, metadata={**f.metadata, MARK: own.name}) for f in out.schema.fields])

    return run
