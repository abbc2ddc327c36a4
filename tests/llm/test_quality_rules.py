import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from pairloom.llm import quality_rules as Q


def slow(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts = Counter(windows)
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup, len({i + j for i, w in enumerate(windows) if counts[w] > 1 for j in range(3)})


def test_base_counts(plain):
    texts = [t for _, t, _, _ in plain] + ["a b c a b c", "a a a a", "x\n\n \nx\nx \nx", "é é é é", "<|># *\x1c$"]
    for text in texts:
        assert Q.base_counts(text.encode() if text is not None else None) == slow(text)


def test_binomial_tail():
    assert Q.binomial_tail(0, 10, 0.5) == pytest.approx(0.5**10)
    assert Q.binomial_tail(10, 10, 0.3) == pytest.approx(1.0)


def exact_bound(k, n, delta):
    """Upper Clopper-Pearson bound by bisection over the binomial sum."""
    low, high = 0.0, 1.0
    for _ in range(60):
        p = (low + high) / 2
        low, high = (p, high) if sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1)) > delta else (low, p)
    return high


def test_certificates_by_brute_force():
    rng = np.random.default_rng(1)
    for _ in range(20):
        counts = {s: [(min(int(k), int(n)), int(n)) for k in np.sort(rng.integers(0, 12, 5))] for s, n in enumerate(rng.integers(0, 500, 3))}
        expected = {}
        for s, levels in counts.items():
            ok = [bool(n) and exact_bound(k, n, 0.05 / 3) <= 0.03 for k, n in levels]
            if ok[0]:
                expected[s] = (ok + [False]).index(False) - 1
        assert Q.certify(counts, 0.03, 0.05) == expected


def test_joint_risk_is_controlled():
    """Over many draws, the rules of a stratum together hardly ever reject more than the risk."""
    broken, used = 0, 0
    for seed in range(60):
        rng = np.random.default_rng(seed)
        n = 4000
        strata, good = rng.integers(0, 2, n), rng.random(n) < 0.8
        values = {f"r{k}": rng.random(n) for k in range(4)}
        cutoffs = Q.choose_cutoffs(values, strata, good, np.arange(n) % 2 == 1, risk=0.05)
        # independent uniform values: the true joint rate is known
        rates = [1 - math.prod(cutoffs.get((r, s), 1.0) for r in values) for s in (0, 1) if any(s == t for _, t in cutoffs)]
        used += len(rates)
        broken += any(x > 0.05 for x in rates)
    assert broken <= 60 * Q.DELTA + 3 and used > 100


def test_edge_rows(spark, docs, none, plain):
    labels = spark.createDataFrame([(i, 1) for i in range(40)] + [(1, None), (None, 1)], "doc_id long, quality int")
    cutoffs = Q.learn_cutoffs(docs, labels)
    found = Q.apply_rules(docs, cutoffs).collect()
    assert sorted(tuple(r[n] for n in Q.NAMES) for r in found) == sorted(slow(t) for _, t, _, _ in plain)
    assert all(not r.kept for r in found if r.base_failed) and all(r.base_failed for r in found if not (r.text or "").strip())
    assert Q.apply_rules(none, cutoffs).isEmpty()
    assert Q.learn_cutoffs(docs, labels.limit(0)) == {}
    assert Q.apply_rules(docs, {("symbols", 1): -1.0}).filter("n_words BETWEEN 100 AND 299 AND kept").isEmpty()


def test_clean_documents_stay(spark):
    sf = "/root/testdata/sf0.1"
    found = Q.query(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("NOT base_failed").toPandas()
    assert found.kept[found.quality == 1].mean() > 0.97 and found.kept[found.quality == 0].mean() < 0.5


def test_all_labelled_rows_choose_cutoffs(spark):
    """More labels than the 40,000 that were once the most: cutoffs are those of all rows."""
    n = 44_000
    words = F.expr("concat_ws(' ', transform(sequence(1, 51), x -> concat('w', hash(id, x))), repeat('# ', int(pmod(hash(id), 1000) * pmod(hash(id, 7), 1000) / 20000)))")
    docs = spark.range(n).select(F.col("id").alias("doc_id"), words.alias("text")).unionByName(spark.range(3).select(F.lit(5).cast("long").alias("doc_id"), F.lit("x " * 60).alias("text")))
    labels = spark.range(n).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 9 == 0, 0).otherwise(1).alias("quality")).unionByName(spark.createDataFrame([(7, 0)], "doc_id long, quality int"))
    table = Q.base_statistics(docs).filter(~Q.base_failed()).select("doc_id", *(c.alias(k) for k, c in Q.rules().items()), Q.stratum().alias("s"), F.md5(F.col("doc_id").cast("string")).substr(1, 1).alias("h")).toPandas()
    good = (table.doc_id % 9 != 0) & (table.doc_id != 7)
    expected = Q.choose_cutoffs({k: table[k].to_numpy(float) for k in Q.rules()}, table.s.to_numpy(), good.to_numpy(), table.h.map(lambda x: int(x, 16) % 2 == 1).to_numpy())
    assert expected and Q.learn_cutoffs(docs, labels) == expected


def test_quantiles_are_exact(spark):
    rng = np.random.default_rng(2)
    groups = {("a", 0): rng.random(700), ("a", 1): np.round(rng.random(90), 1), ("b", 0): -np.exp(40 * rng.random(400)), ("b", 3): np.array([2.5])}
    found = spark.createDataFrame([(r, s, float(x)) for (r, s), v in groups.items() for x in v], "rule string, s int, value double")
    expected = {g: np.quantile(v, Q.LEVELS, method="higher").tolist() for g, v in groups.items()}
    assert Q.quantiles(found, bins=4) == Q.quantiles(found) == expected


def test_binomial_tail_of_many():
    slow = lambda k, n, p: sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
    for k, n, p in ((0, 30, 0.02), (3, 300, 0.02), (9, 300, 0.02), (200, 900, 0.3)):
        assert Q.binomial_tail(k, n, p) == pytest.approx(slow(k, n, p))
    assert Q.binomial_tail(20_000_000, 1_000_000_000, 0.02) == pytest.approx(0.5, abs=1e-3)
