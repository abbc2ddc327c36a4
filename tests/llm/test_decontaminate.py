import re

import duckdb

from pairloom.llm import decontaminate as D

SCHEMA = "item_id long, text string"


def slow(plain, items):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    out = []
    for i, text, *_ in plain:
        w, hit, ids = words(text), set(), set()
        for item, t in items:
            v = words(t)
            size = min(10, len(v))
            windows = {tuple(v[s : s + size]) for s in range(len(v) - size + 1)} if v else set()
            for s in range(len(w) - size + 1):
                if tuple(w[s : s + size]) in windows:
                    hit |= set(range(s, s + size))
                    ids.add(item)
        out.append((-1 if i is None else i, len(w), len(hit), sorted(str(x) for x in ids if x is not None)))
    return sorted(out)


def items_of(plain):
    w = plain[0][1].split()
    return [(1, " ".join(w[3:18])), (2, plain[42][1]), (3, plain[3][1].upper() + "!"), (4, "w"), (5, ""), (6, None), (7, "w w w"), (2, plain[42][1]), (None, " ".join(plain[5][1].split()[:12])), (9, "日本, É"), (10, " ".join(plain[51][1].split()[10:45]))]


def got(df):
    return sorted((-1 if r.doc_id is None else r.doc_id, r.n_words, r.n_hit, r.hit_items) for r in df.collect())


def test_against_brute_force(spark, docs, plain):
    items = items_of(plain)
    benchmark = spark.createDataFrame(items, SCHEMA)
    expected = slow(plain, items)
    assert sum(r[2] > 0 for r in expected) > 8
    assert got(D.find_contamination(docs, benchmark)) == expected
    # the same in blocks of a few words, merged
    assert got(D.find_contamination(docs, benchmark, block_words=20)) == expected
    clean = D.decontaminate(docs, benchmark)
    assert clean.columns == docs.columns and clean.count() == sum(r[2] == 0 for r in expected)


def test_empty(spark, docs, none, plain):
    empty = spark.createDataFrame([], SCHEMA)
    assert {r[2] for r in got(D.find_contamination(docs, empty))} == {0}
    assert D.find_contamination(none, spark.createDataFrame(items_of(plain), SCHEMA)).isEmpty()


def test_sql(spark, sf_dir):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    found = D.query(spark, sf_dir)
    assert sorted(map(tuple, found.collect())) == sorted(con.execute(f"SELECT {', '.join(found.columns)} FROM ({D.ORACLE})").fetchall())
