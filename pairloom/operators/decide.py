"""From probabilities to match lists: one-to-one assignment, decision rules, their tuning and metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The grid of the tuner. Fixed values.
THRESHOLDS = (0.3, 0.4, 0.5, 0.55, 0.6, 0.65, 0.7, 0.75, 0.8, 0.85, 0.9)
MIN_P = (0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9)
AMBIGUITY = (0.0, 0.05, 0.15, 0.3)
MAX_K = 15


def best_owner(scored: DataFrame) -> DataFrame:
    """Each candidate at its best source-1 record, with its lead over the second best (its own p if there is none)."""
    cand = Window.partitionBy("cand_idx")
    ranked = scored.withColumn("_r", F.row_number().over(cand.orderBy(F.desc("p"), "s1_idx")))
    second = F.max(F.when(F.col("_r") == 2, F.col("p"))).over(cand)
    return ranked.withColumn("lead", F.col("p") - F.coalesce(second, F.lit(0.0))).filter("_r = 1").drop("_r")


def one_to_one(scored: DataFrame, ambiguity: float = 0.0) -> DataFrame:
    """Pairs of best_owner(); with ambiguity > 0 only those that lead by as much, so near-ties go to nobody."""
    owned = best_owner(scored)
    return (owned.filter(F.col("lead") >= ambiguity) if ambiguity > 0 else owned).drop("lead")


def select_threshold(scored: DataFrame, t: float) -> DataFrame:
    return scored.filter(F.col("p") >= t)


def expected_f(scored: DataFrame, min_p: Column, keys: list[str], max_k: int = MAX_K) -> DataFrame:
    """Pairs kept by expected F0.5, per group of `keys`: the shortest prefix by p with the largest expectation, if it beats silence."""
    own = Window.partitionBy(*keys)
    order = own.orderBy(F.desc("p"), "cand_idx")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    ranked = scored.filter(F.col("p") >= min_p / 2).withColumns({"_k": F.row_number().over(order), "_cum": F.sum("p").over(upto), "_tot": F.sum("p").over(own), "_none": F.product(1 - F.col("p")).over(own)})
    ranked = ranked.withColumn("_ef", 1.25 * F.col("_cum") / (0.25 * F.col("_tot") + F.col("_k")))
    ranked = ranked.withColumn("_best", F.max("_ef").over(own))
    ranked = ranked.withColumn("_best_k", F.min(F.when(F.col("_ef") == F.col("_best"), F.col("_k"))).over(own))
    kept = (F.col("_k") <= F.col("_best_k")) & (F.col("_k") <= max_k) & (F.col("p") >= min_p) & (F.col("_best") > F.col("_none"))
    return ranked.filter(kept).drop("_k", "_cum", "_tot", "_none", "_ef", "_best", "_best_k")


def select_expected_f(scored: DataFrame, min_p: float = 0.05, max_k: int = MAX_K) -> DataFrame:
    return expected_f(scored, F.lit(min_p), ["s1_idx"], max_k)


def apply_rule(scored: DataFrame, rule: dict) -> DataFrame:
    """One-to-one, then the rule: {"rule": "threshold" | "expected_f", "t" | "min_p": x, "amb": y}."""
    owned = one_to_one(scored, rule.get("amb", 0.0))
    return select_threshold(owned, rule["t"]) if rule["rule"] == "threshold" else select_expected_f(owned, rule["min_p"])


def entity_f05(n_true: Column, n_pred: Column, tp: Column) -> Column:
    """F0.5 of one entity; a singleton scores 1 for silence and 0 else."""
    return F.when(n_true == 0, (n_pred == 0).cast("double")).when(n_pred == 0, 0.0).otherwise(1.25 * tp / (0.25 * n_true + n_pred))


def per_entity(predicted: DataFrame, meta: DataFrame) -> DataFrame:
    """meta (s1_idx, n_true and others) with n_pred, tp and f05; predicted has s1_idx and label."""
    counts = predicted.groupBy("s1_idx").agg(F.count("*").alias("n_pred"), F.sum("label").alias("tp"))
    joined = meta.join(counts, "s1_idx", "left").withColumns({"n_pred": F.coalesce("n_pred", F.lit(0)), "tp": F.coalesce("tp", F.lit(0))})
    return joined.withColumn("f05", entity_f05(F.col("n_true"), F.col("n_pred"), F.col("tp")))


def macro_f05(predicted: DataFrame, meta: DataFrame) -> DataFrame:
    return per_entity(predicted, meta).agg(F.avg("f05").alias("macro_f05"))


def breakdown_columns() -> list[Column]:
    alone = F.col("n_true") == 0
    return [
        F.round(F.avg(F.when(alone, (F.col("n_pred") == 0).cast("double"))), 4).alias("singleton_acc"),
        F.round(F.avg(F.when(~alone, (F.col("n_pred") == 0).cast("double"))), 4).alias("nonsingleton_empty_pred"),
        F.round(F.sum("tp") / F.greatest(F.sum("n_pred"), F.lit(1)), 4).alias("pair_precision"),
        F.round(F.sum("tp") / F.greatest(F.sum("n_true"), F.lit(1)), 4).alias("pair_recall"),
    ]


def breakdown(predicted: DataFrame, meta: DataFrame) -> DataFrame:
    return per_entity(predicted, meta).agg(*breakdown_columns())


def metrics_by(predicted: DataFrame, meta: DataFrame, column: str) -> DataFrame:
    """Macro F0.5 and breakdown of each value of a column of `meta`."""
    return per_entity(predicted, meta).groupBy(column).agg(F.count("*").alias("n"), F.round(F.avg("f05"), 6).alias("macro_f05"), *breakdown_columns())


def tune(scored: DataFrame, meta: DataFrame) -> DataFrame:
    """Every rule of the grid with its macro F0.5, best first, in one job.

    The owner of a candidate does not depend on the rule, so it is found once; each pair then meets the rules, a literal table of 84 rows.
    """
    grid = [("threshold", t, a) for t in THRESHOLDS for a in AMBIGUITY] + [("expected_f", m, a) for m in MIN_P for a in AMBIGUITY]
    spark = scored.sparkSession
    rules = spark.createDataFrame([(i, *g) for i, g in enumerate(grid)], "grid int, rule string, value double, amb double")
    met = best_owner(scored).crossJoin(F.broadcast(rules)).filter((F.col("amb") == 0) | (F.col("lead") >= F.col("amb")))
    by_threshold = met.filter("rule = 'threshold' AND p >= value").select("grid", "s1_idx", "label")
    by_expectation = expected_f(met.filter("rule = 'expected_f'"), F.col("value"), ["grid", "s1_idx"]).select("grid", "s1_idx", "label")
    counts = by_threshold.unionByName(by_expectation).groupBy("grid", "s1_idx").agg(F.count("*").alias("n_pred"), F.sum("label").alias("tp"))
    # Entities without a prediction under a rule score by n_true alone, so they need no row for each rule.
    totals = meta.agg(F.count("*").alias("_n"), F.sum((F.col("n_true") == 0).cast("double")).alias("_alone"))
    scores = counts.join(meta.select("s1_idx", "n_true"), "s1_idx").groupBy("grid").agg(
        F.sum(entity_f05(F.col("n_true"), F.col("n_pred"), F.col("tp"))).alias("_f"), F.sum((F.col("n_true") == 0).cast("double")).alias("_spoken")
    )
    joined = rules.join(scores, "grid", "left").crossJoin(totals)
    value = (F.coalesce("_f", F.lit(0.0)) + F.col("_alone") - F.coalesce("_spoken", F.lit(0.0))) / F.col("_n")
    return joined.select("grid", "rule", "value", "amb", F.round(value, 6).alias("macro_f05")).orderBy(F.desc("macro_f05"), "grid")
