import os
import zipfile
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from pairloom.plans import pipeline
from pairloom.sources import tables
from pairloom.sources.scratch import discard, stash


def test_sources_and_lists(spark, tmp_path):
    for k in (1, 2, 3):
        (tmp_path / f"train_source{k}.tsv").write_text(f'entity_id\tbusiness_name\tbusiness_address\tcountry\nS{k}-1\t"odd\t\tus\nS{k}-2\tx\ty\tfr\n')
    found = tables.read_sources(spark, str(tmp_path), "train").orderBy("idx").collect()
    assert [r.idx for r in found] == list(range(6)) and [r.entity_id for r in found] == ["S1-1", "S1-2", "S2-1", "S2-2", "S3-1", "S3-2"]
    assert found[0].business_name == '"odd' and found[0].business_address == ""
    (tmp_path / "t.tsv").write_text("source1_entity_id\tmatched_entity_ids\nS1-1\tS2-1, S3-2\nS1-2\t\n")
    truth = tables.read_truth(spark, str(tmp_path / "t.tsv"))
    assert sorted(map(tuple, truth.collect())) == [("S1-1", "S2-1"), ("S1-1", "S3-2")]
    records = tables.read_sources(spark, str(tmp_path), "train")
    assert sorted(map(tuple, pipeline.with_ids(truth, records).collect())) == [(0, 2), (0, 5)]
    lists = {r.id: r.ids for r in tables.read_id_lists(spark, str(tmp_path / "t.tsv")).collect()}
    assert lists == {"S1-1": ["S2-1", "S3-2"], "S1-2": []}


def test_write_lists(spark, tmp_path):
    ids = spark.createDataFrame([("S1-1",), ("S1-2",)], "k string")
    groups = spark.createDataFrame([("S1-1", "b", 2.0), ("S1-1", "a", 1.0), ("S1-1", "a", 3.0)], "k string, v string, o double")
    tables.write_tsv(tables.id_lists(ids, groups, "k", "v", "o", "list").coalesce(1).orderBy("k"), str(tmp_path / "out"))
    text = next((tmp_path / "out").glob("*.csv")).read_text()
    assert text == "k\tlist\nS1-1\ta,b\nS1-2\t\n"


def test_package(tmp_path):
    (tmp_path / "code" / "__pycache__").mkdir(parents=True)
    (tmp_path / "code" / "a.py").write_text("x")
    (tmp_path / "code" / "__pycache__" / "a.pyc").write_text("x")
    (tmp_path / "r.tsv").write_text("x")
    names = pipeline.package({"output/r.tsv": str(tmp_path / "r.tsv")}, str(tmp_path / "code"), str(tmp_path / "z.zip"))
    assert names == ["code/a.py", "output/r.tsv"] == sorted(zipfile.ZipFile(tmp_path / "z.zip").namelist())


@pytest.mark.parametrize("partitions", ["8", "64"])
def test_dense_idx_of_wide_rows(spark, tmp_path, partitions):
    """Many wide rows in many ranges, written and read back: every number once, in order."""
    n, old = 600_000, spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        wide = F.concat(*(F.sha2(F.concat(F.col("id"), F.lit(str(k))), 256) for k in range(3)))
        rows = spark.range(n).select((F.col("id") * 7919 % n).alias("k"), wide.alias("wide"), (F.col("id") % 3).alias("g")).repartition(16)
        tables.with_dense_idx(rows, ["g", "k"]).write.parquet(str(tmp_path / "out"))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    out = spark.read.parquet(str(tmp_path / "out"))
    assert tuple(out.agg(F.count("*"), F.countDistinct("idx"), F.min("idx"), F.max("idx")).first()) == (n, n, 0, n - 1)
    step = out.select("g", "k", "idx", F.lag("idx").over(Window.partitionBy("g").orderBy("k")).alias("before")).filter("before IS NOT NULL AND idx <= before")
    assert step.isEmpty()


def test_dense_idx_of_few_rows(spark):
    rows = spark.createDataFrame([(2, "a"), (1, "b"), (2, "a"), (None, "c")], "k int, t string")
    assert sorted((r.idx, r.k) for r in tables.with_dense_idx(rows, ["k"]).collect()) == [(0, None), (1, 1), (2, 2), (3, 2)]
    assert tables.with_dense_idx(rows.limit(0), ["k"]).isEmpty()


def test_stash(spark):
    keys = ["spark.sql.classic.shuffleDependency.fileCleanup.enabled", "spark.sql.execution.arrow.maxBytesPerBatch"]
    before = [spark.conf.get(k) for k in keys]
    made = stash(spark.range(10).repartition(3, "id"), "test")
    assert made.count() == 10 and [spark.conf.get(k) for k in keys] == before
    spark.conf.set(keys[1], "1m")  # a setting of the session's own stays
    discard(stash(spark.range(10), "test"))
    assert spark.conf.get(keys[1]) == "1m"
    spark.conf.unset(keys[1])
    with ThreadPoolExecutor(4) as pool:
        discard(*pool.map(lambda k: stash(spark.range(50).repartition(3), f"t{k}"), range(8)))
    assert [spark.conf.get(k) for k in keys] == before
    path = made.inputFiles()[0].removeprefix("file:")
    assert os.path.exists(path)
    discard(made)
    assert not os.path.exists(path)
