"""The linkage flow on some 630,000 short records: the scale of the sampled world that the published two minutes are for.

Records come from line items: names and addresses of a few words, 110,000 source-1 records with up to four noisy copies each, and
distractors. Prints seconds by step and the candidates' recall as one JSON line. WORLD_S1 (source-1 records), BENCH_SF_DIR and BENCH_CPUS change the run.
"""

from __future__ import annotations

import json
import os
import sys
import time

os.environ.setdefault("PYSPARK_PYTHON", sys.executable)

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.operators import blocking, decide, features, matcher, sampling
from pairloom.operators.normalize import normalize
from pairloom.session import build
from pairloom.sources import world
from pairloom.sources.scratch import stash

SYLLABLES = ["ba", "co", "di", "fu", "ge", "ha", "jo", "ki", "lu", "me", "na", "po", "ri", "su", "te", "vo"]


def word(key, salt: str, syllables: int = 3):
    """A made-up word from a key: its md5 digits as syllables."""
    digest = F.md5(F.concat(key.cast("string"), F.lit(salt)))
    table = F.array(*map(F.lit, SYLLABLES))
    return F.concat(*(F.get(table, F.conv(F.substring(digest, k + 1, 1), 16, 10).cast("int")) for k in range(syllables)))


def short_records(spark: SparkSession, sf_dir: str, n_s1: int) -> DataFrame:
    """idx, entity_id, src, country, business_name, business_address of line items: n_s1 of source 1 and about three times as many distractors."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    idx = (F.col("l_orderkey") * 8 + F.col("l_linenumber")).cast("long")
    rows = lines.withColumn("idx", idx).dropDuplicates(["idx"]).withColumn("h", sampling.hash_bucket(F.col("idx"), 21, 1_000_000))
    total = rows.count()
    first, last = int(1e6 * n_s1 / total), int(1e6 * min(1.0, 3.7 * n_s1 / total))
    src = F.when(F.col("h") < first, 1).otherwise(2 + F.col("h") % 2).cast("tinyint")
    names = F.concat_ws(" ", word(F.col("idx"), "n"), word(F.col("l_suppkey"), "s"), word(F.col("l_partkey") % 300, "k", 2))
    address = F.concat_ws(" ", (F.col("idx") % 4999 + 1).cast("string"), word(F.col("l_partkey"), "a"), F.lit("street,"), word(F.col("l_suppkey") % 97, "t"))
    return rows.filter(F.col("h") < last).select(
        "idx", F.concat(F.lit("S"), src.cast("string"), F.lit("-"), F.col("idx").cast("string")).alias("entity_id"), src.alias("src"),
        F.when(F.col("l_suppkey") % 5 < 3, "us").otherwise("india").alias("country"), names.alias("business_name"), address.alias("business_address"),
    )


def main() -> None:
    sf_dir, n_s1 = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), int(os.environ.get("WORLD_S1", "110000"))
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build(f"local[{cpus}]", 32, "bench-world", **{"spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    began = time.perf_counter()

    def step(name: str, made):
        nonlocal began
        seconds[name] = round(time.perf_counter() - began, 1)
        print(name, seconds[name], file=sys.stderr)
        began = time.perf_counter()
        return made

    raw, truth = world.with_noisy_copies(short_records(spark, sf_dir, n_s1))
    raw, truth = stash(raw, "raw"), stash(truth, "truth")
    step("world", raw.count())
    records = step("normalize", stash(normalize(raw), "records"))
    meta = stash(sampling.s1_meta(raw, truth), "meta")
    candidates = step("block", stash(blocking.generate_candidates(records).drop("from_extra"), "candidates"))
    report = blocking.blocking_report(candidates, truth, meta).first().asDict()
    step("report", None)
    pairs = step("features", stash(features.build_features(candidates, records, truth, meta), "features"))
    rounds = int(os.environ.get("WORLD_ROUNDS", "20"))
    model = step("fit", matcher.train(pairs, features.feature_columns(pairs), 0.1, rounds, 0))
    scored = step("predict", stash(matcher.predict(model, pairs.filter("fold = 'val'"), 0.1), "scored"))
    best = decide.tune(scored, meta.filter("fold = 'val'")).first()
    step("tune", None)
    found = {"records": raw.count(), "s1": meta.count(), "pairs": candidates.count(), "rounds": rounds, "macro_f05": best.macro_f05, **report}
    print(json.dumps({"metric": "linkage_world_seconds", "value": round(sum(seconds.values()) - seconds["world"], 1), "unit": "sec", "steps": seconds, "cpus": int(cpus), **found}))


if __name__ == "__main__":
    main()
