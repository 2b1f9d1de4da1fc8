"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(cores: str | int = "*", app: str = "riskloom", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # small test tables still use all cores
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "128k")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def prepare(spark: SparkSession) -> SparkSession:
    """Fix the settings that results depend on and make sure checkpoints have a home."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    shared_folder(spark)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only a local master, where
    driver and executors are one process, may fall back to a temporary folder.
    """
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or getattr(sc, "_riskloom_folder", None)
    if not folder:
        current = sc.getCheckpointDir()
        if current:
            folder = current
        elif sc.master.startswith("local"):
            folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        else:
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        sc._riskloom_folder = folder
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(folder)
    return folder


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing has written to yet."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and go on from the files.

    Later reads prune columns, know the table's size, and survive a lost executor.
    """
    path = fresh_path(df.sparkSession, "cut")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_cut(df: DataFrame) -> None:
    """Remove the files of a table that ``cut`` wrote and nothing reads any more."""
    spark = df.sparkSession
    for path in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        if path.rsplit("/", 1)[-1].startswith("cut-"):
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(place, True)


def checkpoint(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: unlike a table it keeps rows in their partitions and order."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
