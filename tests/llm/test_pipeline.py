import corpus_pipeline
import duckdb
import pytest

from riskloom.llm import queries
from riskloom.llm.common import scratch
from riskloom.session import fresh_path

SMALL = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_feed_each_other(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    odd = spark.createDataFrame([(None, None, "en", None, None), (10**9, "", None, "s", 0), (10**9 + 1, "X " * 50_000, "en", "s", 100_000)], docs.schema)
    docs = docs.unionByName(odd).unionByName(docs.limit(3))
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = scratch(stage(spark, docs, SMALL), "test")
        assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
        docs = out
        counts.append(docs.count())
    assert counts == sorted(counts, reverse=True) and counts[-1] > 0.5 * counts[0]
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL)
    assert packed.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact dedup", "simhash near-dedup", "suffix-array dedup", "best-fit packing"]


def test_empty_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = scratch(stage(spark, docs, SMALL), "test")
        assert docs.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).count() == 0


def test_runs_keep_their_hands_off_each_other(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    lazy = {name: queries.QUERIES[name](spark, SMALL) for name in ("op2_exact_dedup", "op4_simhash", "op5_packing")}
    first = [docs, docs]
    stages = corpus_pipeline.STAGES
    results = [None, None]
    for _, stage in stages[1:4]:
        # both runs start a stage before either result is written
        for i in (0, 1):
            results[i] = stage(spark, first[i], SMALL)
        for i in (0, 1):
            first[i] = spark.read.parquet(written(results[i]))
    assert first[0].count() == first[1].count() > 0
    packed = stages[4][1](spark, first[0], SMALL)
    for name, frame in lazy.items():
        assert frame.count() >= docs.count(), name
    assert packed.count() >= first[0].count()


def written(df):
    path = fresh_path(df.sparkSession, "test")
    df.write.parquet(path)
    return path


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "conversations", "pages"):
        con.execute(f"create view {table} as select * from '{SMALL}/{table}.parquet'")
    want = con.execute(queries.SQL[name])
    columns = [c[0] for c in want.description]
    got = queries.QUERIES[name](spark, SMALL).select(*columns).collect()
    assert sorted(map(tuple, got)) == sorted(want.fetchall())


def test_registered():
    assert sorted(int(k[2:].split("_")[0]) for k in queries.QUERIES) == list(range(1, 14))
