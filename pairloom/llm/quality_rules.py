"""Quality rules whose cutoffs are risk-controlled.

Each rule is a statistic of a text that is larger for worse texts. Its cutoffs are chosen from labelled documents so that, in each
stratum (a band of text length), all rules together reject at most RISK of the documents labelled good. Labelled documents are split by
hash: one half proposes, the other half, the holdout, certifies. The possible cutoffs of a rule are quantiles (LEVELS) of its values over the
stratum's proposing documents labelled good. Proposals are a sequence of settings, each a level for some of the rules: it begins
without rules, and each step lowers the cutoff of one rule, the one whose change catches most documents labelled bad for each good one it
rejects more; it ends when nothing more is caught, or more than RISK of the proposing good documents are rejected. A setting is certified if the
upper Clopper-Pearson bound on its joint rate of false rejections is below RISK, that is if the binomial probability of as few
false rejections or fewer among the stratum's good holdout documents, were their rate RISK, is at most DELTA / strata. Settings are tested
in their order, and testing ends at the first that fails (a fixed sequence needs no correction of its own); strata are corrected
for by Bonferroni. So with probability 1 - DELTA no stratum's rules together exceed the risk. The last certified setting of a
stratum is used; a stratum without one, as where it has too few labels, rejects nothing by these rules.

Scale. The base statistics come from one narrow Arrow pass; the rules are column expressions over them. All labelled rows take part:
their counts, not their texts, are joined with the labels. The proposed quantiles are exact; they are found by counting values in BINS bins and
going on inside the bins that hold a wanted rank. The driver sees counts of bins and of patterns (which level of each rule is the
first to reject a row; their number is bounded by rules and levels), never rows, and the cutoffs (rules times strata numbers) go back as literals.

Defined results. Null, empty and blank texts have no words: all counts 0, base_failed, so not kept. Labels that are null are left out;
of several labels of a doc_id the lowest counts. Without labels no rule has a cutoff, so kept is the opposite of base_failed. Repeated
rows are each judged. An empty table gives an empty table. Input columns named as an added column are replaced.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairloom.llm.common import annotate, discard, stash

RISK = 0.02
DELTA = 0.05
#: Bins that a bracket of values is counted in, each time it is narrowed.
BINS = 256
#: Levels of a rule's cutoff, the mildest first: these quantiles over the documents labelled good.
LEVELS = (1.0, 0.9995, 0.999, 0.998, 0.997, 0.996, 0.995, 0.994, 0.992, 0.99, 0.985, 0.98)
#: Strata: bands of the number of words.
STRATA = (100, 300, 1000)
SYMBOLS = b"#*$%&|<>"
_NOT_SYMBOLS = bytes(c for c in range(256) if c not in SYMBOLS)
_BLANKS = bytes([32, 9, 10, 11, 12, 13])
_CONTINUED = bytes(range(0x80, 0xC0))
NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
ADDED = T.StructType([T.StructField(n, T.LongType()) for n in NAMES])


def repeat_words(words: list[bytes], n: int = 3) -> int:
    """Words inside windows of n words that are found twice or more, the first one included."""
    if len(words) <= n:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    size = len(words) - n + 1
    key, spread = ids[:size], max(len(numbers), 1)
    for k in range(1, n):
        if spread >= 1 << 31:
            _, key = np.unique(key, return_inverse=True)
            spread = int(key.max()) + 1
        key, spread = key * len(numbers) + ids[k : k + size], spread * len(numbers)
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    again = np.zeros(size, bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    if not again.any():
        return 0
    covered = np.zeros(len(words), bool)
    for k in range(n):
        covered[k : k + size] |= again
    return int(covered.sum())


def base_counts(text: bytes | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of one text."""
    if not text:
        return 0, 0, 0, 0, 0
    words = text.split()
    seen: set[bytes] = set()
    dup = 0
    if b"\n" in text:
        for line in text.split(b"\n"):
            if line in seen:
                dup += 1
            elif line.strip():
                seen.add(line)
    return len(words), len(text.translate(None, _BLANKS + _CONTINUED)), len(text.translate(None, _NOT_SYMBOLS)), dup, repeat_words(words)


def base_statistics(docs: DataFrame) -> DataFrame:
    """`docs` with the base counts of the text."""

    def run(texts: list[bytes | None]) -> list[pa.Array]:
        return [pa.array(column, pa.int64()) for column in zip(*map(base_counts, texts))]

    return annotate(docs, run, ADDED)


def rules() -> dict[str, Column]:
    """Statistics of which a large value speaks against a text."""
    per_word = F.greatest(F.col("n_words"), F.lit(1))
    mean = F.col("word_chars") / per_word
    return {
        "symbols": F.col("n_symbols") / per_word,
        "duplicate_lines": F.col("n_dup_lines") / per_word,
        "repeated_words": F.col("n_repeat_words") / per_word,
        "long_words": mean,
        "short_words": -mean,
    }


def stratum() -> Column:
    found = F.lit(len(STRATA))
    for k in reversed(range(len(STRATA))):
        found = F.when(F.col("n_words") < STRATA[k], k).otherwise(found)
    return found


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) of a binomial, summed outwards from its largest term until terms are below any digit of the sum."""
    top = min(k, int((n + 1) * p))
    log = math.lgamma(n + 1) - math.lgamma(top + 1) - math.lgamma(n - top + 1) + top * math.log(p) + (n - top) * math.log1p(-p)
    terms, t = [1.0], 1.0
    for i in range(top, 0, -1):
        t *= i * (1 - p) / ((n - i + 1) * p)
        if t < 1e-30:
            break
        terms.append(t)
    t = 1.0
    for i in range(top, k):
        t *= (n - i) * p / ((i + 1) * (1 - p))
        if t < 1e-30:
            break
        terms.append(t)
    return min(1.0, math.exp(log) * math.fsum(terms))


Cutoffs = dict[tuple[str, int], float]  # (rule, stratum) -> cutoff: values above it are rejected
#: Of each rule the first level that rejects a row (len(LEVELS): none does).
Pattern = tuple[int, ...]
#: Of each rule the level in use, -1 for none.
Setting = tuple[int, ...]


def rejected(rows: dict[Pattern, int], setting: Setting) -> int:
    """How many rows any rule of the setting rejects."""
    return sum(n for pattern, n in rows.items() if any(first <= level for first, level in zip(pattern, setting)))


def settings_for(good: dict[Pattern, int], bad: dict[Pattern, int], n_rules: int, risk: float) -> list[Setting]:
    """The sequence of settings that the proposing documents give; ties go to the milder level, then to the earlier rule."""
    most = risk * sum(good.values())
    found: list[Setting] = []
    now, caught, lost = (-1,) * n_rules, 0, 0
    while True:
        best = None
        for rule in range(n_rules):
            for level in range(now[rule] + 1, len(LEVELS)):
                setting = (*now[:rule], level, *now[rule + 1 :])
                more, cost = rejected(bad, setting) - caught, rejected(good, setting)
                if more > 0 and cost <= most:
                    rate = more / (cost - lost + 1)
                    if best is None or (-rate, level, rule) < best[0]:
                        best = ((-rate, level, rule), setting, caught + more, cost)
        if best is None:
            return found
        _, now, caught, lost = best
        found.append(now)


def certify(tested: dict[int, list[tuple[int, int]]], risk: float, delta: float) -> dict[int, int]:
    """stratum -> its last certified setting, of (rejected, all) good holdout documents of each setting in their order."""
    certified: dict[int, int] = {}
    for s, settings in tested.items():
        for k, (n_rejected, held) in enumerate(settings):
            if not held or binomial_tail(n_rejected, held, risk) > delta / len(tested):
                break
            certified[s] = k
    return certified


def choose(counts: dict[tuple[int, bool, bool], dict[Pattern, int]], cutoffs: dict[tuple[str, int], list[float]], names: list[str], risk: float, delta: float) -> Cutoffs:
    """Cutoffs from the patterns' counts by (stratum, good, holdout) and the cutoffs of all levels by (rule, stratum)."""
    strata = sorted({s for _, s in cutoffs})
    settings = {s: settings_for(counts.get((s, True, False), {}), counts.get((s, False, False), {}), len(names), risk) for s in strata}
    held = {s: counts.get((s, True, True), {}) for s in strata}
    certified = certify({s: [(rejected(held[s], x), sum(held[s].values())) for x in settings[s]] for s in strata}, risk, delta)
    return {(rule, s): cutoffs[rule, s][level] for s, k in certified.items() for rule, level in zip(names, settings[s][k]) if level >= 0}


def choose_cutoffs(values: dict[str, np.ndarray], strata: np.ndarray, good: np.ndarray, holdout: np.ndarray, risk: float = RISK, delta: float = DELTA) -> Cutoffs:
    """What learn_cutoffs() finds, for arrays of labelled documents."""
    known = np.unique(strata[good & ~holdout]).tolist()
    cutoffs = {(r, s): [float(np.quantile(v[good & ~holdout & (strata == s)], q, method="higher")) for q in LEVELS] for r, v in values.items() for s in known}
    counts: dict[tuple[int, bool, bool], dict[Pattern, int]] = {}
    for i in range(len(good)):
        if strata[i] in known:
            s = int(strata[i])
            pattern = tuple(next((k for k, c in enumerate(cutoffs[r, s]) if v[i] > c), len(LEVELS)) for r, v in values.items())
            own = counts.setdefault((s, bool(good[i]), bool(holdout[i])), {})
            own[pattern] = own.get(pattern, 0) + 1
    return choose(counts, cutoffs, list(values), risk, delta)


def quantiles(found: DataFrame, points: tuple[float, ...] = LEVELS, bins: int = BINS) -> dict[tuple[str, int], list[float]]:
    """For each rule and stratum its quantiles at `points` (the next value above, as numpy's "higher"); `found` is (rule, s, value)."""
    spark = found.sparkSession
    known: dict[tuple[str, int, int], float] = {}  # (rule, stratum, rank) -> value
    ranks: dict[tuple[str, int], list[int]] = {}
    # (rule, stratum, least, greatest value) -> ranks inside, as pairs of the rank there and the rank in all
    wanted: dict[tuple[str, int, float, float], set[tuple[int, int]]] = {}
    for r in found.groupBy("rule", "s").agg(F.count("*").alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi")).collect():
        ranks[r.rule, r.s] = [math.ceil((r.n - 1) * q) for q in points]
        wanted[r.rule, r.s, r.lo, r.hi] = {(k, k) for k in ranks[r.rule, r.s]}
    while wanted:
        known |= {(rule, s, k): lo for (rule, s, lo, hi), inside in wanted.items() if lo == hi for _, k in inside}
        brackets = sorted(w for w in wanted if w[2] < w[3])
        if not brackets:
            break
        table = spark.createDataFrame([(k, *w) for k, w in enumerate(brackets)], "k int, _rule string, _s int, lo double, hi double")
        # broadcast: at most one row for each rule, stratum and point
        inside = found.join(F.broadcast(table), (F.col("rule") == F.col("_rule")) & (F.col("s") == F.col("_s")) & F.col("value").between(F.col("lo"), F.col("hi")))
        place = F.floor((F.col("value") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins)
        counted = inside.groupBy("k", place.alias("bin")).agg(F.count("*").alias("n"), F.min("value").alias("least"), F.max("value").alias("most")).collect()
        narrowed: dict[tuple[str, int, float, float], set[tuple[int, int]]] = {}
        below = [0] * len(brackets)
        for r in sorted(counted, key=lambda r: (r.k, r.bin)):
            rule, s, lo, hi = brackets[r.k]
            own = {(x - below[r.k], k) for x, k in wanted[rule, s, lo, hi] if 0 <= x - below[r.k] < r.n}
            if own:
                narrowed[rule, s, r.least, r.most] = own
            below[r.k] += r.n
        wanted = narrowed
    return {(rule, s): [known[rule, s, k] for k in own] for (rule, s), own in sorted(ranks.items())}


def learn_from_counts(counted: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA) -> Cutoffs:
    """Cutoffs from all labelled documents of `counted` (doc_id and the base counts)."""
    chosen = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy(F.col("doc_id").alias("_id")).agg(F.min("quality").alias("_quality"))
    # The labels are a table before the join, so AQE can split a doc_id that very many rows have.
    labelled = stash(chosen, "labels")
    half = F.conv(F.substring(F.md5(F.col("_id").cast("string")), 1, 1), 16, 10).cast("int") % 2
    rows = counted.filter(~base_failed()).join(labelled, F.col("doc_id") == F.col("_id"))
    rows = stash(rows.select(*(c.alias(f"r_{n}") for n, c in rules().items()), stratum().alias("s"), (half == 1).alias("h"), (F.col("_quality") == 1).alias("good")), "labelled")
    discard(labelled)
    each = F.explode(F.array(*(F.struct(F.lit(n).alias("rule"), F.col(f"r_{n}").alias("value")) for n in rules())))
    cutoffs = quantiles(rows.filter("good AND NOT h").select("s", each.alias("r")).select("r.rule", "s", "r.value"))

    def first_level(rule: str) -> Column:
        found = F.lit(len(LEVELS))
        for (name, s), levels in cutoffs.items():
            if name == rule:
                own = F.lit(len(LEVELS))
                for k in reversed(range(len(levels))):
                    own = F.when(F.col(f"r_{rule}") > levels[k], k).otherwise(own)
                found = F.when(F.col("s") == s, own).otherwise(found)
        return found

    counts: dict[tuple[int, bool, bool], dict[Pattern, int]] = {}
    patterns = rows.groupBy("s", "good", "h", *(first_level(n).alias(f"l_{n}") for n in rules())).agg(F.count("*").alias("n"))
    for r in patterns.collect():
        counts.setdefault((r.s, r.good, r.h), {})[tuple(r[f"l_{n}"] for n in rules())] = r.n
    discard(rows)
    return choose(counts, cutoffs, list(rules()), risk, delta)


def learn_cutoffs(docs: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA) -> Cutoffs:
    """Cutoffs from all labelled documents of `docs` (doc_id, text)."""
    return learn_from_counts(base_statistics(docs.select("doc_id", "text")), labels, risk, delta)


def judge(counted: DataFrame, cutoffs: Cutoffs) -> DataFrame:
    """`counted` (rows with the base counts) with base_failed, rejected_by (the rules that reject it) and kept."""
    checks = []
    for rule, value in rules().items():
        cutoff = F.lit(None).cast("double")
        for (name, s), c in sorted(cutoffs.items()):
            if name == rule:
                cutoff = F.when(stratum() == s, F.lit(c)).otherwise(cutoff)
        checks.append(F.when(value > cutoff, F.lit(rule)))
    marked = counted.withColumn("base_failed", base_failed()).withColumn("rejected_by", F.array_compact(F.array(*checks)))
    return marked.withColumn("kept", ~F.col("base_failed") & (F.size("rejected_by") == 0))


def apply_rules(docs: DataFrame, cutoffs: Cutoffs) -> DataFrame:
    """`docs` with the base counts, base_failed, rejected_by and kept."""
    return judge(base_statistics(docs.drop("base_failed", "rejected_by", "kept")), cutoffs)


def query(spark, sf_dir: str) -> DataFrame:
    """op7: base counts and verdict of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    counted = stash(base_statistics(docs).select("doc_id", *NAMES), "counts")
    cutoffs = learn_from_counts(counted, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return judge(counted, cutoffs).select("doc_id", *NAMES, "base_failed", "kept")
