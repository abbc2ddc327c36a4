import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from pairloom import cli
from pairloom.operators import matcher
from pairloom.plans import evaluate, pipeline
from pairloom.sources import tables, world
from pairloom.streaming.score import link_stream
from pairloom.operators.normalize import normalize

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def same(value):
    return None if value != value else round(value, 6) if isinstance(value, float) else value


@pytest.mark.parametrize("name", ["norm_tokens_distinct", "norm_addr_tokens", "block_union_channels", "set_overlap", "select_expected_f", "metrics_by_country", "validate_lists"])
def test_oracle(spark, sf_dir, name):
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    got = entry.queries()[name](spark, sf_dir)
    expected = con.execute(f"SELECT {', '.join(got.columns)} FROM ({entry.oracle_sql()[name]})").fetchall()
    key = lambda rows: sorted(repr([None if v is None else same(v) for v in r]) for r in rows)
    assert key(got.collect()) == key(expected)


def test_entry(spark):
    assert not entry.entry(spark).isEmpty()
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_train_and_predict(spark, sf_dir, tmp_path):
    raw, truth = world.noisy_world(spark, sf_dir)
    settings = pipeline.Settings(rounds=8, model={"maxDepth": 4, "minInstancesPerNode": 5}, val_fraction=0.4)
    folder = f"file://{tmp_path}/work"  # a URL: what the flows keep goes to any file system
    report = pipeline.train(spark, raw, truth, folder, settings)
    assert report["pair_recall"] > 0.5 and report["macro_f05"] > 0.5
    rule = tables.load_json(spark, f"{folder}/decision.json")
    assert rule["rule"] == report["rule"]["rule"] and tables.load_json(spark, f"{folder}/report.json")["pair_recall"] == report["pair_recall"]
    matches, candidates = pipeline.predict(spark, raw, folder, str(tmp_path / "out"), rule)
    asked = raw.filter("src = 1").select(F.col("entity_id").alias("id"))
    assert matches.count() == candidates.count() == asked.count()
    out = [str(tmp_path / "out" / n) for n in ("matching_results", "candidate_pairs")]
    passed, text = evaluate.validate(spark, out[0], ["source1_entity_id", "matched_entity_ids"], asked, raw.filter("src <> 1").select(F.col("entity_id").alias("id")), out[1])
    assert passed and "WARN" not in text
    errors = pipeline.analyze(spark, folder, rule)
    assert errors["by_country"].count() >= 1 and errors["false_negatives_sample"].count() == min(pipeline.ERRORS, errors["false_negatives"].count())


def test_command_line_with_embeddings(spark, sf_dir, tmp_path):
    """prepare, embed, features, fit, then all, and the parts that read what they wrote."""
    raw, truth = world.noisy_world(spark, sf_dir)
    named = lambda df: df.select("entity_id", "business_name", "business_address", "country")
    for prefix in ("train", "test"):
        for k, path in enumerate(tables.source_paths(str(tmp_path), prefix), 1):
            tables.write_tsv(named(raw.filter(F.col("src") == k)), path)
    ids = raw.select("idx", "entity_id")
    pairs = truth.join(ids.toDF("s1_idx", "a"), "s1_idx").join(ids.toDF("cand_idx", "b"), "cand_idx")
    tables.write_tsv(pairs.groupBy("a").agg(F.array_join(F.collect_list("b"), ",").alias("matched_entity_ids")).withColumnRenamed("a", "source1_entity_id"), str(tmp_path / "train_ground_truth.tsv"))
    folder = str(tmp_path / "work")
    options = ["--data-dir", str(tmp_path), "--work-dir", folder, "--output-dir", str(tmp_path / "out"), "--model-dir", str(tmp_path / "model"), "--k-embed", "3", "--rounds", "6", "--early-stop", "2", "--val-frac", "0.4", "--skip-existing"]
    for command in ("embed", "features", "fit", "all", "analyze"):
        assert cli.main([command, *options]) == 0
    assert {"emb_cos", "label", "fold"} <= set(spark.read.parquet(f"{folder}/features").columns)
    assert spark.read.parquet(f"{folder}/candidates").filter("from_extra").count() > 0
    importance = spark.read.csv(f"{folder}/importance", header=True, schema="feature string, gain double").collect()
    assert [r.gain for r in importance] == sorted((r.gain for r in importance), reverse=True) and len(importance) == 73
    assert (tmp_path / "model").exists() and cli.main(["validate", str(tmp_path / "out" / "matching_results"), "--data-dir", str(tmp_path), "--candidates", str(tmp_path / "out" / "candidate_pairs"), "--check-ids"]) == 0
    assert cli.main(["score", str(tmp_path / "out" / "matching_results"), str(tmp_path / "out" / "matching_results")]) == 0
    (tmp_path / "code").mkdir()
    (tmp_path / "code" / "a.py").write_text("x")
    assert cli.main(["package", str(tmp_path / "z.zip"), "--code-dir", str(tmp_path / "code"), "--file", f"a.tsv={tmp_path}/code/a.py"]) == 0


def test_early_stopping(spark):
    """Noise after a few useful trees: the model ends at the round with the least loss on the validation fold."""
    rng = np.random.default_rng(2)
    x, noise = rng.random(600), rng.random(600)
    label = ((x > 0.5) ^ (rng.random(600) < 0.2)).astype(int)
    rows = [(i, i, float(x[i]), float(noise[i]), int(label[i]), "val" if i % 3 == 0 else "fit") for i in range(600)]
    pairs = spark.createDataFrame(rows, "s1_idx long, cand_idx long, x double, noise double, label int, fold string").cache()
    small = {"maxDepth": 4, "minInstancesPerNode": 1, "stepSize": 0.3}
    model = matcher.train(pairs, ["x", "noise"], rounds=64, early_stop=4, **small)
    whole = matcher.train(pairs, ["x", "noise"], rounds=64, early_stop=0, **small)
    assert 0 < matcher.train(pairs, ["x", "noise"], rounds=64, **small).stages[1].getNumTrees < 64  # Spark's own stop
    n = model.stages[1].getNumTrees
    assert 0 < n < 64 == whole.stages[1].getNumTrees
    held = model.stages[0].transform(matcher.with_vector_inputs(pairs.filter("fold = 'val'").withColumn("label", F.col("label").cast("double")), ["x", "noise"])[0])
    losses = model.stages[1].evaluateEachIteration(held)
    assert len(losses) == n and min(losses) == losses[-1]
    p = [r.p for r in matcher.predict(model, pairs).orderBy("s1_idx").collect()]
    assert len(p) == 600 and all(0 <= v <= 1 for v in p)
    assert [r.feature for r in matcher.feature_importance(model).collect()][0] == "x"
    with pytest.raises(ValueError, match="noise"):
        matcher.predict(model, pairs.drop("noise"))


def test_stream(spark, sf_dir, tmp_path):
    records = world.records(spark, sf_dir).limit(120).cache()
    records.filter("src = 1").coalesce(1).write.parquet(str(tmp_path / "in"))
    pool = normalize(records.filter("src <> 1"))
    got = []
    stream = spark.readStream.schema(records.schema).parquet(str(tmp_path / "in"))
    link_stream(stream, pool, lambda df, n: got.extend(df.collect()), str(tmp_path / "cp")).awaitTermination(120)
    from pairloom.operators.blocking import generate_candidates

    whole = generate_candidates(normalize(records)).drop("from_extra").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, whole))
