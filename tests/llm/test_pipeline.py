import re
import zlib

import duckdb
import numpy as np
from test_decontaminate import slow as slow_hits
from test_quality_model import slow_score
from test_simhash import kept_slowly
from tokenizers import Tokenizer

import corpus_pipeline as C
from pairloom.llm import decontaminate, mixing, quality_model, simhash, tokens


def test_stages_take_effect(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = quality_model.fit(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    good = C.quality(spark, docs, sf)
    assert {r.doc_id for r in good.collect()} == {r.doc_id for r in quality_model.score(docs, model).filter("predicted = 1").collect()}
    single = C.near_duplicates(spark, good, sf)
    reps = {r.component_id for r in simhash.near_duplicates(good).collect()}
    assert sorted(r.doc_id for r in single.collect()) == sorted(reps)
    clean = C.decontamination(spark, single, sf)
    hits = {r.doc_id for r in decontaminate.find_contamination(single, spark.read.parquet(f"{sf}/benchmark.parquet")).filter("n_hit > 0").collect()}
    assert {r.doc_id for r in clean.collect()} == reps - hits
    mixed = C.mix(spark, clean, sf)
    assert mixed.columns == docs.columns
    taken = {r.doc_id: r for r in mixing.mix_sources(clean).collect()}
    copies = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    for i, r in taken.items():
        assert abs(copies.get(i, 0) * r.size - r.taken) <= r.size / 2
    last = C.token_ids(spark, mixed, sf)
    assert last.count() == mixed.count() and [c for c in last.columns] == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert [n for n, _ in C.STAGES] and len(C.STAGES) == 5


def test_edge_rows(spark, docs, none, tmp_path):
    spark.createDataFrame([(i, i % 4 and 1) for i in range(40)], "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, "aa bb cc dd")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for table in (docs, none):
        out = table
        for name, stage in C.STAGES[:-1]:
            out = stage(spark, out, str(tmp_path))
            assert out.columns == docs.columns, name
        assert C.STAGES[-1][1](spark, out, str(tmp_path)).count() == out.count()


def test_no_swallowed_imports():
    assert not re.search(r"except\s+ImportError", open(C.__file__).read())


def slow_pipeline(rows, labels_model, items):
    """The rows of run(), stage by stage, in plain Python and SQL: (doc_id, start, n_tokens, ids_crc32)."""
    good = [r for r in rows if slow_score(r[1], labels_model) >= 0.3]
    kept = set(kept_slowly([(r[0], r[1]) for r in good]))
    single = [r for r in good if (r[0], r[1]) in kept]
    hits = {i: k for i, _, k, _ in slow_hits(single, items)}
    clean = [r for r in single if hits[r[0]] == 0]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", [(i, t, s) for i, t, _, s in clean])
    taken = {i: (size, n) for i, size, n in con.execute(f"SELECT doc_id, size, taken FROM ({mixing.ORACLE})").fetchall()}
    tokenizer, out, start = Tokenizer.from_file(tokens.tokenizer_path()), [], 0
    for i, t, *_ in sorted(clean):
        size, n = taken[i]
        ids = [*tokenizer.encode(t, add_special_tokens=False).ids, 2]
        for _ in range(int(n / size + 0.5) if size else 0):
            out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
            start += len(ids)
    return out


def test_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in docs.collect()]
    model = quality_model.fit(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    expected = slow_pipeline(rows, model, items)
    assert 50 < len(expected)
    assert sorted(tuple(r) for r in C.run(spark, sf).select("doc_id", "start", "n_tokens", "ids_crc32").collect()) == sorted(expected)
