import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline as pipeline
from linepulse.llm import registry
from linepulse.session import work_path
from tests.llm.cases import docs, messy
from tests.test_registry import _canon

SF = "/root/testdata/sf0.001"


def test_queries_are_registered():
    assert [sum(q.startswith(f"op{n}_") for q in registry.QUERIES) for n in range(1, 11)] == [1] * 10
    assert {*registry.QUERIES, "pipeline"} <= set(entry.queries())
    assert [n for n, _ in pipeline.STAGES] == ["toxicity", "line_dedup", "simhash", "decontamination", "packing"]


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = registry.QUERIES[name](spark, SF)
    cur = con.execute(registry.ORACLE_SQL[name])
    assert _canon(df.columns, [tuple(r) for r in df.collect()]) == _canon(
        [d[0] for d in cur.description], cur.fetchall())


@pytest.fixture(scope="module")
def folder(spark):
    path = work_path(spark, "test_pipeline", unique=True)
    line = "this passage of some words is found in two documents and goes from the second"
    bench = " ".join(f"item{i}" for i in range(20))
    rows = messy() + [(300, line + "\nand here is something of its own kind", "en", "s", 1),
                      (301, line + "\nwhile this one says another thing entirely", "en", "s", 1),
                      (302, "one question: " + bench, "en", "s", 1)]
    rows += [(400 + i, ("vile " if i % 2 else "some ") + f"text number {i} of the labelled ones", "en", "s", 1)
             for i in range(40)]
    docs(spark, rows).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(400 + i, 1, i % 2) for i in range(40)],
                          "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, bench)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages_take_effect_and_keep_columns(spark, folder):
    found = spark.read.parquet(f"{folder}/documents.parquet").withColumn("severity", F.lit(1)).withColumn(
        "n_hit", F.lit("mine"))
    kept = {}
    for name, apply in pipeline.STAGES:
        out = apply(spark, found, folder)
        if name != "packing":
            assert out.dtypes == found.dtypes
        path = work_path(spark, "test_stage", unique=True)
        out.write.parquet(path)
        found = spark.read.parquet(path)
        kept[name] = {r.doc_id: r for r in found.collect()}
    assert not {400 + i for i in range(1, 40, 2)} & set(kept["toxicity"])
    assert {400 + i for i in range(0, 40, 2)} <= set(kept["toxicity"])
    assert kept["line_dedup"][301].text == "while this one says another thing entirely"
    assert 2 not in kept["line_dedup"] and 1 in kept["line_dedup"]
    assert 302 in kept["simhash"] and 302 not in kept["decontamination"]
    assert set(kept["packing"]) == set(kept["decontamination"])


def test_run_is_the_stages(spark, folder):
    got = pipeline.run(spark, folder)
    assert {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"} == set(got.columns)
    assert got.count() > 0


def test_empty_tables(spark):
    path = work_path(spark, "test_empty", unique=True)
    docs(spark, []).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    assert pipeline.run(spark, path).count() == 0
    for name, query in registry.QUERIES.items():
        assert query(spark, path).count() == 0, name
