"""Scoring of id lists, checks of output files, and error analysis."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pairloom.sources import tables
from pairloom.sources.scratch import stash

EXAMPLES = 5


def f_beta(precision: Column, recall: Column, beta: float = 0.5) -> Column:
    """0 where both are 0."""
    b = beta * beta
    return F.when(precision + recall > 0, (1 + b) * precision * recall / (b * precision + recall)).otherwise(0.0)


def score_entities(predicted: DataFrame, truth: DataFrame) -> DataFrame:
    """(id, n_true, n_pred, tp, score) of every truth entity; both tables are (id, ids). Extra predictions don't count."""
    joined = truth.select("id", F.col("ids").alias("_t")).join(predicted.select("id", F.col("ids").alias("_p")), "id", "left")
    n_true, n_pred = F.size("_t"), F.size(F.coalesce("_p", F.array().cast("array<string>")))
    tp = F.size(F.array_intersect("_t", F.coalesce("_p", F.array().cast("array<string>"))))
    found = joined.select("id", n_true.alias("n_true"), n_pred.alias("n_pred"), tp.alias("tp"), F.col("_p").isNull().alias("missing"))
    value = F.when(F.col("n_true") == 0, (F.col("n_pred") == 0).cast("double")).when(F.col("n_pred") == 0, 0.0).otherwise(f_beta(F.col("tp") / F.greatest(F.col("n_pred"), F.lit(1)), F.col("tp") / F.greatest(F.col("n_true"), F.lit(1))))
    return found.withColumn("score", value)


def score_lists(predicted: DataFrame, truth: DataFrame, strict: bool = True) -> DataFrame:
    """One row: macro F0.5, entities, singletons and singletons that are right. strict: every truth entity must be predicted."""
    scores = score_entities(predicted, truth)
    if strict and not scores.filter("missing").isEmpty():
        raise ValueError(f"no prediction for {[r.id for r in scores.filter('missing').orderBy('id').limit(EXAMPLES).collect()]}")
    alone = F.col("n_true") == 0
    return scores.agg(F.round(F.avg("score"), 6).alias("macro_f05"), F.count("*").alias("n"), F.sum(alone.cast("long")).alias("n_singletons"), F.sum((alone & (F.col("n_pred") == 0)).cast("long")).alias("n_singletons_right"))


def violations(lists: DataFrame, required: DataFrame, valid: DataFrame | None = None) -> DataFrame:
    """(rule, n, examples) for every broken rule: how many ids break it, and the first EXAMPLES of them.

    lists: rows (id, list) as they are in the file; required, valid: (id).
    """
    items = lists.select("id", F.explode(F.split("list", ",")).alias("item")).filter("item <> ''")
    own = items.filter(F.startswith("item", F.lit("S1-")))
    odd = items.filter(~F.col("item").rlike("^S[123]-"))
    found = {
        "duplicate_row": lists.groupBy("id").agg(F.count("*").alias("n")).filter("n > 1").select("id"),
        "repeated_id": lists.filter(F.size(F.split("list", ",")) != F.size(F.array_distinct(F.split("list", ",")))).select("id"),
        "self_match": own.select(F.col("item").alias("id")),
        "wrong_prefix": odd.select(F.col("item").alias("id")),
        "missing_row": required.select("id").join(lists.select("id"), "id", "left_anti"),
        "extra_row": lists.select("id").join(required.select("id"), "id", "left_anti"),
    }
    if valid is not None:
        known = items.filter(F.col("item").rlike("^S[23]-")).select(F.col("item").alias("id"))
        found["unknown_id"] = known.join(valid.select("id"), "id", "left_anti")
    broken = functools.reduce(DataFrame.unionByName, (ids.select(F.lit(rule).alias("rule"), "id") for rule, ids in found.items()))
    broken = stash(broken.distinct(), "violations")
    ranked = broken.withColumn("k", F.row_number().over(Window.partitionBy("rule").orderBy("id"))).filter(F.col("k") <= EXAMPLES)
    examples = ranked.groupBy("rule").agg(F.sort_array(F.collect_list("id")).alias("examples"))
    return broken.groupBy("rule").agg(F.count("*").alias("n")).join(examples, "rule").select("rule", "n", "examples")


def header_errors(spark: SparkSession, path: str, expected: list[str]) -> list[str]:
    """What is wrong with the first line of an id-list file, or of the files of a folder; empty if nothing is."""
    if not tables.exists(spark, path):
        return ["missing_file"]
    wrong = set()
    for header in tables.first_lines(spark, path) or [None]:
        if not header:
            wrong.add("empty_file")
        elif "\t" not in header and "," in header:
            wrong.add("comma_separated")
        elif [c.strip().lower() for c in header.split("\t")] != expected:
            wrong.add("wrong_header")
    return sorted(wrong)


def read_rows(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(rows (id, list), malformed lines) of an id-list file or folder without headers."""
    lines = tables.read_lines(spark, path).select("value")
    key, rest = tables.split_line()
    split = lines.select("value", key.alias("id"), F.trim(rest).alias("list"))
    return split.filter("list IS NOT NULL").select("id", "list"), split.filter("list IS NULL AND trim(value) <> ''").select("value")


def not_candidates(matches: DataFrame, candidates: DataFrame) -> DataFrame:
    """(id, ids) matched without being candidates: a warning, not an error. Both tables are (id, ids)."""
    joined = matches.select("id", "ids").join(candidates.select("id", F.col("ids").alias("_c")), "id", "left")
    return joined.select("id", F.array_except("ids", F.coalesce("_c", F.array().cast("array<string>"))).alias("ids")).filter(F.size("ids") > 0)


def counted(examples: list[str], n: int) -> str:
    """How many there are, and up to EXAMPLES of them."""
    return f"{n} ({', '.join(sorted(examples)[:EXAMPLES])}{', ...' if n > EXAMPLES else ''})"


def validate(spark: SparkSession, path: str, expected: list[str], required: DataFrame, valid: DataFrame | None = None, candidates: str | None = None) -> tuple[bool, str]:
    """(passed, report) of one id-list file or folder. candidates: a file of candidate lists; matches outside them are warned of."""
    fatal = header_errors(spark, path, expected)
    if fatal:
        return False, f"FAIL {path}: {', '.join(fatal)}"
    rows, malformed = read_rows(spark, path)
    found = [f"{r.rule}: {counted(r.examples, r.n)}" for r in violations(rows, required, valid).orderBy("rule").collect()]
    bad = malformed.count()
    if bad:
        found.append(f"malformed_row: {counted([r.value for r in malformed.orderBy('value').limit(EXAMPLES).collect()], bad)}")
    report = f"FAIL {path}: " + "; ".join(found) if found else f"PASS {path}"
    if candidates is not None:
        if not tables.exists(spark, candidates):
            report += f"\nWARN no file {candidates}: matches are not compared with candidates"
        else:
            outside = not_candidates(tables.read_id_lists(spark, path), tables.read_id_lists(spark, candidates))
            n = outside.count()
            if n:
                report += f"\nWARN matches that are no candidates: {counted([r.id for r in outside.orderBy('id').limit(EXAMPLES).collect()], n)}"
    return not found, report


def false_positives(predicted: DataFrame, records: DataFrame, n: int = 50) -> DataFrame:
    """The n most certain wrong pairs with their raw texts: a report of fixed size."""
    return _with_texts(predicted.filter("label = 0").orderBy(F.desc("p"), "s1_idx", "cand_idx").limit(n).select("s1_idx", "cand_idx", "p"), records)


def false_negatives(truth: DataFrame, predicted: DataFrame, scored: DataFrame) -> DataFrame:
    """(s1_idx, cand_idx, p) of true pairs that were not predicted; p is null where blocking missed the pair."""
    missed = truth.select("s1_idx", "cand_idx").join(predicted.select("s1_idx", "cand_idx"), ["s1_idx", "cand_idx"], "left_anti")
    return missed.join(scored.select("s1_idx", "cand_idx", "p"), ["s1_idx", "cand_idx"], "left")


def _with_texts(pairs: DataFrame, records: DataFrame) -> DataFrame:
    slim = records.select("idx", "business_name", "business_address")
    left, right = (slim.toDF(key, f"name_{k}", f"address_{k}") for k, key in ((1, "s1_idx"), (2, "cand_idx")))
    return pairs.join(left, "s1_idx", "left").join(right, "cand_idx", "left")
