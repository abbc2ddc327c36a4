import math
import unicodedata

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

from pairloom.llm import quality_model as Q
from pairloom.llm.common import crc_bucket


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    found = Q.query(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("held_out").toPandas()
    good, bad = found.score[found.quality == 1].to_numpy(), found.score[found.quality == 0].to_numpy()
    assert (good[:, None] > bad[None]).mean() > 0.97
    assert ((found.score >= 0.3).astype(int) == found.predicted).all()
    assert found.score.between(0, 1).all()


def test_labels_of_the_held_out_fold_teach_nothing(spark, sf_dir):
    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    wrong = labels.withColumn("quality", F.when(crc_bucket(F.col("doc_id"), 5) == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert Q.fit(docs, labels) == Q.fit(docs, wrong)


def test_compiled_rules_equal_numpy(spark, sf_dir):
    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    intercept, rules = model = Q.fit(docs, labels)
    names = list(Q.ratios({n: F.lit(1) for n in Q.COUNTS}))
    table = Q.with_statistics(docs).select("doc_id", *(F.col(f"_s.{n}").alias(n) for n in names)).toPandas().set_index("doc_id")
    z = Q.holds([r for r, _ in rules], table[names].to_numpy(float), names)
    expected = 1 / (1 + np.exp(-(intercept + z @ np.array([w for _, w in rules]))))
    got = Q.score(docs, model).select("doc_id", "score").toPandas().set_index("doc_id").loc[table.index]
    assert np.allclose(got.score, expected)


def test_edge_rows(spark, docs, none, plain):
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(1, 0), (2, None), (None, 1)], "doc_id long, quality int")
    model = Q.fit(docs, labels)
    found = Q.score(docs, model).collect()
    assert len(found) == len(plain) and all(0 <= r.score <= 1 for r in found)
    assert len({r.score for r in found if not (r.text or "")}) == 1
    assert Q.accept(docs, model).columns == docs.columns
    assert Q.score(none, model).isEmpty()
    no_labels = labels.limit(0)
    assert [r.score for r in Q.score(docs, Q.fit(docs, no_labels)).limit(2).collect()] == [pytest.approx(0.5)] * 2


def test_repeated_rows_crowd_out_no_other(spark, sf_dir):
    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    own = labels.filter(crc_bucket(F.col("doc_id"), 5) != 0).orderBy(F.md5(F.col("doc_id").cast("string"))).first().doc_id
    again = docs.filter(F.col("doc_id") == own).crossJoin(spark.range(150)).drop("id")
    expected = Q.fit(docs, labels, sample=60)
    assert expected[1] and Q.fit(again.unionByName(docs).coalesce(1), labels, sample=60) == expected


def slow_statistics(text):
    """The statistics of a text, letter by letter and word by word."""
    text = text or ""
    words = [w for w in regex.split(r"[\x20\x09-\x0D]+", text) if w]
    lines = [x for x in text.split("\n") if x.strip(" ")]
    repeats, spans = 0, [(m.start(), m.end()) for m in regex.finditer(r"\S+", text, regex.ASCII)]
    for (a, b), (c, d) in zip(spans, spans[1:]):
        repeats += (b - a) * (text[a:b] == text[c:d])
    n = {
        "chars": len(text), "words": len(words), "distinct_words": len(set(words)), "lines": len(lines), "distinct_lines": len(set(lines)),
        "upper": sum(unicodedata.category(c) == "Lu" for c in text), "letters": sum(unicodedata.category(c)[0] == "L" for c in text),
        "digits": sum(c in "0123456789" for c in text), "marks": sum(c in "#*$%&|<>!=_~^\\{}[]@+/" for c in text), "stops": sum(c in ".,;:?" for c in text), "repeats": repeats,
    }
    per = lambda a, b: n[a] / max(n[b], 1)
    return {
        "log_words": math.log1p(n["words"]), "distinct_share": per("distinct_words", "words"), "word_length": per("letters", "words"), "upper_share": per("upper", "letters"),
        "letter_share": per("letters", "chars"), "digit_share": per("digits", "chars"), "mark_share": per("marks", "chars"), "marks_per_word": per("marks", "words"),
        "stops_per_word": per("stops", "words"), "line_repeats": 1 - per("distinct_lines", "lines"), "words_per_line": per("words", "lines"), "repeat_share": per("repeats", "chars"),
    }


def slow_score(text, model):
    intercept, rules = model
    s = slow_statistics(text)
    total = intercept + sum(w for rule, w in rules if all((s[n] > c) if greater else (s[n] <= c) for n, greater, c in rule))
    return 1 / (1 + math.exp(-total))


def test_scores_against_brute_force(spark, docs):
    """Every document of the smallest data, and the edge rows, scored by the rules in plain Python."""
    sf = "/root/testdata/sf0.001"
    documents = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    model = Q.fit(documents, spark.read.parquet(f"{sf}/labels.parquet"))
    assert model[1]
    for table in (documents, docs.select("doc_id", "text")):
        for r in Q.score(table, model).collect():
            assert r.score == pytest.approx(slow_score(r.text, model), abs=1e-9) and r.predicted == int(r.score >= 0.3)
