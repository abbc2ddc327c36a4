"""Quality classifier: a sparse rule ensemble.

Statistics of a text are Spark column expressions. On a bounded sample of labelled rows, small boosted regression trees are
grown over the statistics; every path from a root to a node is a conjunctive rule (statistic <= or > cut, and so on). A logistic
regression with a lasso penalty over these rules keeps few of them. The kept rules compile to Spark column expressions, and
the score of a text is the logistic function of the sum of the weights of the rules that hold for it.

Scale. Scoring is one narrow pass of JVM expressions: no shuffle, no Python. Learning takes at most SAMPLE labelled rows, the first by a hash of
doc_id, whose statistics go to the driver.

Defined results. Null text counts as empty; an empty text has zero in all statistics and is scored by the same rules. Null labels are left
out; of several labels of a doc_id the lowest counts, and of several rows of a doc_id the one with the least statistics teaches. Equal texts have equal scores. With no labels, or labels of one kind only, the score is
the labels' mean (0.5 without any). An empty table gives an empty table. Input columns named as an added column are replaced;
labels, lang, source and doc_id are no input of a score.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.llm.common import SPACES, crc_bucket

SAMPLE = 20_000
TREES = 40
DEPTH = 3
STEP = 0.15
LEAST_ROWS = 15
#: Penalties tried, largest first; the one with the least loss on a tenth of the sample is taken.
PENALTIES = (0.02, 0.01, 0.005, 0.002, 0.001)
ACCEPT = 0.3
FOLDS = 5

COUNTS = ("chars", "words", "distinct_words", "lines", "distinct_lines", "upper", "letters", "digits", "marks", "stops", "repeats")
Rule = tuple[tuple[str, bool, float], ...]  # (statistic, greater, cut), all of them to hold


def statistics(text: Column, words: Column, lines: Column) -> dict[str, Column]:
    """First-level counts of a text, its words and its lines; ratios() makes the statistics of them."""
    count = lambda pattern: F.regexp_count(text, F.lit(pattern))
    again = F.zip_with(words, F.slice(words, 2, F.greatest(F.size(words), F.lit(1))), lambda a, b: F.when(a == b, F.length(a)).otherwise(0))
    return {
        "chars": F.length(text),
        "words": F.size(words),
        "distinct_words": F.size(F.array_distinct(words)),
        "lines": F.size(lines),
        "distinct_lines": F.size(F.array_distinct(lines)),
        "upper": count(r"\p{Lu}"),
        "letters": F.length(F.regexp_replace(text, r"[^\p{L}]+", "")),
        "digits": count("[0-9]"),
        "marks": count(r"[#*$%&|<>!=_~^\\{}\[\]@+/]"),
        "stops": count("[.,;:?]"),
        "repeats": F.aggregate(again, F.lit(0), lambda s, x: s + x),
    }


def ratios(found: dict[str, Column]) -> dict[str, Column]:
    """The statistics that rules are made of, each a number without bound on the text's length."""
    per = lambda a, b: found[a] / F.greatest(found[b], F.lit(1))
    return {
        "log_words": F.log1p(found["words"].cast("double")),
        "distinct_share": per("distinct_words", "words"),
        "word_length": per("letters", "words"),
        "upper_share": per("upper", "letters"),
        "letter_share": per("letters", "chars"),
        "digit_share": per("digits", "chars"),
        "mark_share": per("marks", "chars"),
        "marks_per_word": per("marks", "words"),
        "stops_per_word": per("stops", "words"),
        "line_repeats": 1 - per("distinct_lines", "lines"),
        "words_per_line": per("words", "lines"),
        "repeat_share": per("repeats", "chars"),
    }


def with_statistics(docs: DataFrame) -> DataFrame:
    """`docs` with a struct `_s` of the statistics."""
    text = F.coalesce(F.col("text"), F.lit(""))
    # Words and lines are columns of their own, so that what is made of them does not split the text again.
    parts = F.struct(F.filter(F.split(text, SPACES), lambda w: w != "").alias("words"), F.filter(F.split(text, "\n"), lambda x: F.trim(x) != "").alias("lines"))
    split = docs.withColumn("_p", parts)
    first = split.withColumn("_f", F.struct(*(c.alias(n) for n, c in statistics(text, F.col("_p.words"), F.col("_p.lines")).items())))
    named = {n: F.col(f"_f.{n}") for n in COUNTS}
    return first.withColumn("_s", F.struct(*(c.cast("double").alias(n) for n, c in ratios(named).items()))).drop("_f", "_p")


# -- learning, on the driver ----------------------------------------------------------------------------------------------------------------


def grow(x: np.ndarray, residual: np.ndarray, names: list[str], cuts: list[np.ndarray], depth: int, path: Rule, rows: np.ndarray, rules: dict[Rule, None], out: np.ndarray) -> None:
    """Grow one regression tree on `rows`; adds the path of each node to `rules` and the leaves' means to `out`."""
    if path:
        rules[tuple(sorted(path))] = None
    best = None
    if depth and len(rows) >= 2 * LEAST_ROWS:
        r = residual[rows]
        total, n = r.sum(), len(rows)
        for j, c in enumerate(cuts):
            if not len(c):
                continue
            bins = np.searchsorted(c, x[rows, j], side="left")  # bin k: cut k-1 < value <= cut k
            counts = np.cumsum(np.bincount(bins, minlength=len(c) + 1))[:-1]
            sums = np.cumsum(np.bincount(bins, weights=r, minlength=len(c) + 1))[:-1]
            ok = (counts >= LEAST_ROWS) & (n - counts >= LEAST_ROWS)
            if ok.any():
                gain = np.where(ok, sums**2 / np.maximum(counts, 1) + (total - sums) ** 2 / np.maximum(n - counts, 1), -np.inf)
                k = int(gain.argmax())
                if best is None or gain[k] > best[0] + 1e-12:
                    best = (gain[k], j, float(c[k]))
        if best is not None and best[0] <= total**2 / n + 1e-9:
            best = None
    if best is None:
        out[rows] = residual[rows].mean() if len(rows) else 0.0
        return
    _, j, cut = best
    low = x[rows, j] <= cut
    grow(x, residual, names, cuts, depth - 1, (*path, (names[j], False, cut)), rows[low], rules, out)
    grow(x, residual, names, cuts, depth - 1, (*path, (names[j], True, cut)), rows[~low], rules, out)


def simplify(rule: Rule) -> Rule:
    """One bound for each side of a statistic: the tighter one."""
    tight: dict[tuple[str, bool], float] = {}
    for name, greater, cut in rule:
        old = tight.get((name, greater), cut)
        tight[name, greater] = max(old, cut) if greater else min(old, cut)
    return tuple(sorted((n, g, c) for (n, g), c in tight.items()))


def extract_rules(x: np.ndarray, y: np.ndarray, names: list[str]) -> list[Rule]:
    """The distinct rules of TREES boosted trees (logistic loss)."""
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0.01, 0.99, 63)))[:] for j in range(x.shape[1])]
    base = math.log(y.mean() / (1 - y.mean()))
    score, rules, rows = np.full(len(y), base), {}, np.arange(len(y))
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-score))
        out = np.zeros(len(y))
        grow(x, y - p, names, cuts, DEPTH, (), rows, rules, out)
        score += STEP * out / max(1e-3, float((p * (1 - p)).mean()))
        score = np.clip(score, -8, 8)
    return sorted({simplify(r) for r in rules})


def holds(rules: list[Rule], x: np.ndarray, names: list[str]) -> np.ndarray:
    """One column of 0 and 1 for each rule."""
    at = {n: j for j, n in enumerate(names)}
    return np.array([np.logical_and.reduce([(x[:, at[n]] > c) if g else (x[:, at[n]] <= c) for n, g, c in r]) for r in rules], float).T.reshape(len(x), len(rules))


def lasso_logistic(z: np.ndarray, y: np.ndarray, penalty: float, start: np.ndarray | None = None, rounds: int = 600) -> np.ndarray:
    """Weights (the intercept, unpenalised, first) by accelerated proximal gradient steps."""
    a = np.column_stack([np.ones(len(z)), z])
    step = 4.0 * len(y) / (np.linalg.norm(a, 2) ** 2 + 1e-9)
    w = np.zeros(a.shape[1]) if start is None else start.copy()
    v, t = w.copy(), 1.0
    for _ in range(rounds):
        g = a.T @ (1 / (1 + np.exp(-(a @ v))) - y) / len(y)
        new = v - step * g
        new[1:] = np.sign(new[1:]) * np.maximum(np.abs(new[1:]) - step * penalty, 0)
        t2 = (1 + math.sqrt(1 + 4 * t * t)) / 2
        v, w, t = new + (t - 1) / t2 * (new - w), new, t2
    return w


def learn_rules(x: np.ndarray, y: np.ndarray, names: list[str]) -> tuple[float, list[tuple[Rule, float]]]:
    """(intercept, [(rule, weight)]) of the sparse ensemble; rows come in the order of their hash."""
    if not len(y) or y.min() == y.max():
        mean = float(np.clip(y.mean(), 0.01, 0.99)) if len(y) else 0.5
        return math.log(mean / (1 - mean)), []
    rules = extract_rules(x, y, names)
    z = holds(rules, x, names)
    if not rules:
        return math.log(y.mean() / (1 - y.mean())), []
    test = np.arange(len(y)) % 10 == 0
    best, w = None, None
    for penalty in PENALTIES:
        w = lasso_logistic(z[~test], y[~test], penalty, w, rounds=300)
        s = np.clip(w[0] + z[test] @ w[1:], -30, 30)
        loss = float(np.mean(np.log1p(np.exp(s)) - y[test] * s)) if test.any() else 0.0
        if best is None or loss < best[0] - 1e-4:
            best = (loss, penalty, w)
    w = lasso_logistic(z, y, best[1], best[2])
    return float(w[0]), [(r, float(c)) for r, c in zip(rules, w[1:]) if abs(c) > 1e-6]


# -- on the cluster -----------------------------------------------------------------------------------------------------------------


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[float, list[tuple[Rule, float]]]:
    """The ensemble of at most `sample` labelled rows of `docs`, none of the held-out fold."""
    chosen = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").filter(crc_bucket(F.col("doc_id"), FOLDS) != 0)
    chosen = chosen.groupBy(F.col("doc_id").alias("_id")).agg(F.min("quality").cast("double").alias("_y"))
    chosen = chosen.withColumn("_digest", F.md5(F.col("_id").cast("string"))).orderBy("_digest", "_id").limit(sample)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))
    names = list(ratios({n: F.lit(1) for n in COUNTS}))
    # Of the rows of a doc_id the one with the least statistics teaches, so `sample` bounds the rows.
    least = with_statistics(rows).groupBy("_id", "_digest", "_y").agg(F.min("_s").alias("_s"))
    table = least.select("_digest", "_y", *(F.col(f"_s.{n}").alias(n) for n in names)).toPandas().sort_values(["_digest", *names])
    return learn_rules(table[names].to_numpy(float), table["_y"].to_numpy(float), names)


def compile_rules(model: tuple[float, list[tuple[Rule, float]]]) -> Column:
    """The score as a column expression over the statistics `_s`."""
    intercept, rules = model
    total = F.lit(intercept)
    for rule, weight in rules:
        holds_ = None
        for name, greater, cut in rule:
            c = F.col(f"_s.{name}") > cut if greater else F.col(f"_s.{name}") <= cut
            holds_ = c if holds_ is None else holds_ & c
        total = total + F.when(holds_, F.lit(weight)).otherwise(0.0)
    return 1 / (1 + F.exp(-total))


def score(docs: DataFrame, model: tuple[float, list[tuple[Rule, float]]]) -> DataFrame:
    """`docs` with score (0 to 1, higher is better) and predicted (1: accepted)."""
    scored = with_statistics(docs.drop("score", "predicted")).withColumn("score", compile_rules(model))
    return scored.withColumn("predicted", (F.col("score") >= ACCEPT).cast("int")).drop("_s")


def accept(docs: DataFrame, model: tuple[float, list[tuple[Rule, float]]]) -> DataFrame:
    """The documents that the classifier accepts; columns of `docs`, whatever their names."""
    packed = docs.select("text", F.struct(*docs.columns).alias("_row"))
    # A generator is no place to push the filter through, so statistics and score are made once, by the projections below it.
    judged = score(packed, model).select("_row", F.explode_outer(F.array("predicted")).alias("_accepted"))
    return judged.filter("_accepted = 1").select("_row.*")


def query(spark, sf_dir: str) -> DataFrame:
    """op2: the score of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, model).select("doc_id", (crc_bucket(F.col("doc_id"), FOLDS) == 0).alias("held_out"), "score", "predicted")
