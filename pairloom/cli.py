"""python -m pairloom.cli train|predict|all|prepare|block|embed|features|fit|analyze|score|validate|package ..."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import functions as F

from pairloom.operators import blocking, matcher, sampling
from pairloom.operators.normalize import normalize
from pairloom.plans import evaluate, pipeline
from pairloom.session import build
from pairloom.sources import tables


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="pairloom", description="Record linkage on Spark.")
    commands = top.add_subparsers(dest="command", required=True)
    for name in ("train", "predict", "all", "prepare", "block", "embed", "features", "fit", "analyze"):
        p = commands.add_parser(name)
        p.add_argument("--data-dir", default="dataset")
        p.add_argument("--work-dir", default="work")
        p.add_argument("--output-dir", default="output")
        p.add_argument("--model-dir", default=None, help="default: model, below the work folder")
        p.add_argument("--master", default="local[*]")
        p.add_argument("--skip-existing", action="store_true")
        p.add_argument("--val-frac", type=float, default=0.2)
        p.add_argument("--sample-frac", type=float, default=1.0)
        p.add_argument("--feature-s1-frac", type=float, default=1.0)
        p.add_argument("--s1-frac", type=float, default=1.0)
        for channel, k in blocking.K.items():
            p.add_argument(f"--k-{channel}", type=int, default=k)
        p.add_argument("--k-embed", type=int, default=0, help="neighbours by embedding; 0: no such channel")
        p.add_argument("--max-cands", type=int, default=blocking.MAX_CANDIDATES)
        p.add_argument("--max-df-frac", type=float, default=blocking.MAX_DF_FRACTION)
        p.add_argument("--max-df", type=int, default=None)
        p.add_argument("--neg-frac", type=float, default=1.0)
        p.add_argument("--rounds", type=int, default=matcher.ROUNDS)
        p.add_argument("--early-stop", type=int, default=matcher.EARLY_STOP)
        p.add_argument("--learning-rate", type=float, default=0.05)
    p = commands.add_parser("score")
    p.add_argument("predicted")
    p.add_argument("truth")
    p = commands.add_parser("validate")
    p.add_argument("file")
    p.add_argument("--data-dir", default="dataset")
    p.add_argument("--prefix", default="test")
    p.add_argument("--column", default="matched_entity_ids")
    p.add_argument("--candidates", default=None, help="candidate lists that matches should be in")
    p.add_argument("--check-ids", action="store_true")
    p = commands.add_parser("package")
    p.add_argument("out")
    p.add_argument("--code-dir", default=".")
    p.add_argument("--file", action="append", default=[], help="a file that must be there, as NAME=PATH", metavar="NAME=PATH")
    return top


def settings_of(a: argparse.Namespace) -> pipeline.Settings:
    return pipeline.Settings(
        val_fraction=a.val_frac, sample_fraction=a.sample_frac, feature_s1_fraction=a.feature_s1_frac, k={c: getattr(a, f"k_{c}") for c in blocking.K},
        max_candidates=a.max_cands, max_df_fraction=a.max_df_frac, negative_fraction=a.neg_frac, rounds=a.rounds, learning_rate=a.learning_rate, skip_existing=a.skip_existing,
        max_df=a.max_df, early_stop=a.early_stop, model_dir=a.model_dir, embed_k=a.k_embed,
    )


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    if a.command == "package":
        print("\n".join(pipeline.package(dict(x.split("=", 1) for x in a.file), a.code_dir, a.out)))
        return 0
    spark = build(getattr(a, "master", "local[*]"))
    if a.command == "score":
        evaluate.score_lists(tables.read_id_lists(spark, a.predicted), tables.read_id_lists(spark, a.truth)).show()
        return 0
    if a.command == "validate":
        test = tables.read_sources(spark, a.data_dir, a.prefix)
        valid = test.filter("src <> 1").select(F.col("entity_id").alias("id")) if a.check_ids else None
        required = test.filter("src = 1").select(F.col("entity_id").alias("id"))
        passed, report = evaluate.validate(spark, a.file, ["source1_entity_id", a.column], required, valid, a.candidates)
        print(report)
        return 0 if passed else 1
    settings, work = settings_of(a), pipeline.Work(spark, a.work_dir, a.skip_existing)
    if a.command in ("train", "all", "prepare", "block", "embed", "features"):
        raw = tables.read_sources(spark, a.data_dir, "train")
        truth = pipeline.with_ids(tables.read_truth(spark, f"{a.data_dir}/train_ground_truth.tsv"), raw)
        if a.command == "prepare":
            pipeline.prepare(work, raw, truth, settings)
        elif a.command == "embed":
            pipeline.embed(work, pipeline.prepare(work, raw, truth, settings)[0], settings)
        elif a.command == "features":
            pipeline.training_features(work, *pipeline.prepare(work, raw, truth, settings), settings)
        elif a.command == "block":
            records = normalize(raw, romanized=True)
            asked = records.filter("src = 1").filter(sampling.sampled(F.col("idx"), a.s1_frac, 5)).select("idx")
            found = blocking.generate_candidates(records, s1=asked, k=settings.k, most=settings.max_candidates, max_df_fraction=settings.max_df_fraction, max_df=settings.max_df)
            own = asked.withColumnRenamed("idx", "s1_idx")
            blocking.blocking_report(found, truth.join(own, "s1_idx", "left_semi"), sampling.s1_meta(raw, truth).join(own, "s1_idx", "left_semi")).show()
        else:
            print(pipeline.train(spark, raw, truth, a.work_dir, settings))
    if a.command == "fit":
        pipeline.fit(work, spark.read.parquet(work.path("features")), settings)
    if a.command in ("predict", "all"):
        rule = tables.load_json(spark, work.path("decision.json"))
        pipeline.predict(spark, tables.read_sources(spark, a.data_dir, "test"), a.work_dir, a.output_dir, rule, settings)
    if a.command == "analyze":
        for name, table in pipeline.analyze(spark, a.work_dir, tables.load_json(spark, work.path("decision.json"))).items():
            print(name)
            table.show(20, truncate=60)
            tables.write_tsv(table, f"{a.output_dir}/{name}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
