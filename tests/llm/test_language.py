import math
import unicodedata

import numpy as np
import pytest
from pyspark.sql import functions as F

from pairloom.llm import language as L
from pairloom.llm.common import crc_bucket


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    truth = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    found = L.query(spark, sf).join(truth, "doc_id").filter("held_out").toPandas()
    assert (found.lang_pred == found.lang).mean() > 0.97 and found.score.between(0, 1).all()


def test_held_out_rows_teach_nothing(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    wrong = docs.withColumn("lang", F.when(crc_bucket(F.col("doc_id"), 3) == 1, "xx").otherwise(F.col("lang")))
    a, b = L.fit(docs), L.fit(wrong)
    assert a.families == b.families and (a.weights == b.weights).all()


def test_letters():
    assert L.has_letter("12 é".encode()) and L.has_letter("日".encode()) and L.has_letter(b"x")
    assert not L.has_letter("12 ½ !".encode()) and not L.has_letter(b"") and not L.has_letter(None)


def test_long_texts_in_pieces(monkeypatch):
    text = ("the quick brown fox é " * 400).encode()
    whole = L.counts_of(text)
    monkeypatch.setattr(L, "_PIECE", 37)
    assert (L.counts_of(text) == whole).all()


def test_edge_rows(docs, none, plain):
    model = L.fit(docs)
    found = L.identify(docs, model).collect()
    assert len(found) == len(plain)
    for r in found:
        assert (r.lang_pred == "und") == (not any(map(str.isalpha, r.text or "")))
        assert 0 <= r.score <= 1
    assert L.identify(none, model).isEmpty()
    assert {r.lang_pred for r in L.identify(docs, L.fit(none)).collect()} == {"und"}


def test_repeated_rows_crowd_out_no_other(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    own = docs.filter(crc_bucket(F.col("doc_id"), L.FOLDS) != L.HELD_OUT).orderBy(F.md5(F.col("doc_id").cast("string"))).first().doc_id
    again = docs.filter(F.col("doc_id") == own).crossJoin(spark.range(300)).drop("id")
    a, b = L.fit(docs, sample=40), L.fit(again.unionByName(docs).coalesce(1), sample=40)
    assert a.families == b.families and (a.weights == b.weights).all()


def slow_vector(text):
    """Shares of hashed n-grams, one n-gram at a time."""
    plain = [32] + [c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in text.encode()] + [32]
    counts = [0] * L.DIMENSIONS
    if b"  " in text.encode():  # runs of two blanks shrink, from the left
        squeezed = []
        for c in plain:
            if squeezed[-1:] == [32] and c == 32:
                squeezed.pop()
                squeezed.append("pair")
            else:
                squeezed.append(c)
        plain = [32 if c == "pair" else c for c in squeezed]
    for k in (1, 2, 3):
        for i in range(len(plain) - k + 1):
            number = 0
            for c in plain[i : i + k]:
                number = (number << 8 | c) & 0xFFFFFFFF
            h = (number * 2654435761 + (k - 1) * 0x9E3779B1) & 0xFFFFFFFF
            counts[h >> 32 - L.BITS] += 1
    roots = [math.sqrt(c) for c in counts]
    norm = math.sqrt(sum(r * r for r in roots))
    return [r / max(norm, 1e-9) for r in roots]


def slow_prediction(text, learned):
    """Family by the largest margin, then votes of the pairs inside it."""
    if not text or not any(unicodedata.category(c)[0] == "L" for c in text):
        return "und"
    x = slow_vector(text)
    margin = lambda w: sum(a * b for a, b in zip(x, w[:-1].tolist())) + float(w[-1])
    families = learned["families"]
    family = max(families, key=lambda f: margin(learned["first"][f])) if learned["first"] else next(iter(families))
    members = families[family]
    votes, sums = dict.fromkeys(members, 0), dict.fromkeys(members, 0.0)
    for (a, b), w in learned["pairs"].items():
        if a in votes:
            m = margin(w)
            votes[a if m >= 0 else b] += 1
            sums[a] += m
            sums[b] -= m
    return min(members, key=lambda g: (-votes[g], -sums[g], g))


def test_predictions_against_brute_force(spark):
    rows = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang").collect()]
    x = np.array([L.vector(t.encode()) for _, t, _ in rows[:120]])
    learned = L.learn(x, [g for _, _, g in rows[:120]])
    model = L.Model(learned)
    texts = [t for _, t, _ in rows[120:160]] + ["", None, "12 #", "É", "a  b", "Ünder   der"]
    for text in texts:
        if text and len(text) < 6000:
            assert L.vector(text.encode()) == pytest.approx(slow_vector(text), abs=1e-5)
        assert model.predict(text.encode() if text is not None else None)[0] == slow_prediction(text, learned)
