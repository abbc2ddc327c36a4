import re
from collections import defaultdict

import duckdb
import pytest

from pairloom.llm import mixing


def water_fill(sizes, weights, cap):
    """Reshare what is above the cap by weight, again and again."""
    total, capped = sum(sizes.values()), set()
    while True:
        left = total - sum(cap * sizes[s] for s in capped)
        free = {s: weights[s] for s in sizes if s not in capped}
        share = {s: left * w / sum(free.values()) for s, w in free.items()}
        above = {s for s in share if share[s] > cap * sizes[s]}
        if not above:
            return {s: share.get(s, cap * sizes[s]) for s in sizes}
        capped |= above


def test_mix(docs, plain):
    sizes = defaultdict(int)
    for _, text, _, source in plain:
        sizes[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    order = sorted((s for s in sizes if s is not None)) + [None]
    target = water_fill(sizes, {s: i % 3 + 1 for i, s in enumerate(order)}, 3)
    found = mixing.mix_sources(docs).collect()
    assert len(found) == len(plain)
    taken = defaultdict(int)
    for r in found:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(target[r.source])
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
    assert {s: taken[s] for s in sizes} == {s: round(target[s]) for s in sizes}
    again = mixing.mix_sources(docs.repartition(2)).collect()
    assert sorted((r.doc_id or 0, r.size, r.taken) for r in again) == sorted((r.doc_id or 0, r.size, r.taken) for r in found)


def test_weights_and_documents(spark, docs):
    weights = spark.createDataFrame([("s0", 5), ("s1", 1)], "source string, weight long")
    mixed = mixing.mixed_documents(docs, weights=weights)
    assert mixed.columns == docs.columns
    assert mixed.filter("text IS NULL OR trim(text) = ''").isEmpty()
    assert max(r["count"] for r in mixed.filter("doc_id < 150").groupBy("doc_id").count().collect()) <= 3


def test_empty(none):
    assert mixing.mix_sources(none).isEmpty() and mixing.mixed_documents(none).isEmpty()


def test_sql(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf_dir}/documents.parquet')")
    got = mixing.query(spark, sf_dir)
    expected = con.execute(f"SELECT {', '.join(got.columns)} FROM ({mixing.ORACLE})").fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(expected)
