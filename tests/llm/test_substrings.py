import hashlib
import random

import duckdb
import numpy as np

from pairloom.llm import substrings as S


def slow(rows):
    seen, out = set(), {}
    for i, text in sorted(rows):
        b = (text or "").encode()
        mask = bytearray(len(b))
        for p in range(len(b) - 99):
            if b[p : p + 100] in seen:
                mask[p : p + 100] = b"\1" * 100
            seen.add(b[p : p + 100])
        out[i] = bytes(c for c, m in zip(b, mask) if not m)
    return out


def test_against_brute_force(spark):
    rng = random.Random(3)
    base = ["".join(rng.choices("ab", k=400)) for _ in range(4)]
    rows = []
    for i in range(60):
        text = "".join(rng.choice(base)[rng.randint(0, 150) : rng.randint(200, 400)] + rng.choice(["", "é", "a" * rng.randint(0, 250), "yz" * rng.randint(0, 90)]) for _ in range(rng.randint(0, 6)))
        rows.append((i * 3 - 20, text if i % 11 else None))
    df = spark.createDataFrame([(*r, "clash", 1, 2) for r in rows], "doc_id long, text string, copy string, place int, key int")
    expected = slow(rows)
    assert {r.doc_id: bytes(r.kept) for r in S.remove_repeats(df.repartition(3)).collect()} == expected


def test_edge_rows(docs, none, plain):
    unique = [(i, t) for i, t, _, _ in plain if i is not None and i < 150]
    expected = slow(unique)
    found = S.remove_repeats(docs.filter("doc_id < 150"))
    assert {r.doc_id: hashlib.md5(bytes(r.kept)).digest() for r in found.collect()} == {i: hashlib.md5(k).digest() for i, k in expected.items()}
    rows = S.remove_repeats(docs).collect()  # with null and repeated ids
    assert len(rows) == len(plain)
    assert len({bytes(r.kept) for r in rows if r.doc_id == 150}) == 1
    assert S.remove_repeats(none).isEmpty()


def corpus(rng, n):
    base = ["".join(rng.choices("ab", k=400)) for _ in range(4)] + ["".join(rng.choices("abcdefghij ", k=700))]
    for i in range(n):
        text = "".join(rng.choice(base)[rng.randint(0, 150) : rng.randint(200, 700)] + rng.choice(["", "é", "a" * rng.randint(0, 250), "yz" * rng.randint(0, 190), "pqr" * rng.randint(0, 90)]) for _ in range(rng.randint(0, 6)))
        yield i * 3 - 20, text if i % 11 else None


def test_parts_and_pieces_of_long_texts(spark, monkeypatch):
    rng = random.Random(5)
    text = "".join(rng.choices("abc", k=900))
    with monkeypatch.context() as m:
        m.setattr(S, "_PART", 300)
        rows = [(1, text + text[100:700]), (2, "x" + text)]
        (_, ends, rs, os), *rest = S.blocks_of([t.encode() for _, t in rows])
        assert not rest
        covered = {(int(r), int(o) + s) for r, o, e, b in zip(rs, os, ends, [0, *ends]) for s in range(int(e - b) - 99)}
        assert covered == {(k, s) for k, (_, t) in enumerate(rows) for s in range(len(t) - 99)}
    # phrases that lie over the borders of pieces
    long = "".join(rng.choices("abcdef", k=3 * S.PIECE + 50))
    rows = [(1, long), (2, "z" + long[S.PIECE - 130 : S.PIECE + 120] + "w" + long[2 * S.PIECE - 60 : 2 * S.PIECE + 41]), (3, "q" + long[S.PIECE + 5 :] + long[:300])]
    found = S.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id: bytes(r.kept) for r in found.collect()} == slow(rows)


def test_triggers_of_many_phrases(spark):
    """Shards that hold few phrases: triggers are dealt to several, and their classes meet again."""
    rng = random.Random(8)
    line = "".join(rng.choices("abcdefgh", k=104))
    rows = [*corpus(rng, 40), *((1000 + i, "".join(rng.choices("xyz", k=rng.randint(0, 90))) + line + "".join(rng.choices("xyz", k=90))) for i in range(80))]
    rest = S.parsed(S.identified(spark.createDataFrame(rows, "doc_id long, text string"))[1])[1]
    assert rest.agg({"p": "max"}).first()[0] > 40
    expected = slow(rows)
    for shard in (7, 64):
        found = S.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), shard)
        assert {r.doc_id: bytes(r.kept) for r in found.collect()} == expected


def test_suffix_array():
    rng = random.Random(9)
    data = "".join(rng.choices("ab", k=300)) * 2 + "a" * 400
    starts = np.array(rng.sample(range(len(data) - 99), 700))
    order, heads = S.suffix_array(np.frombuffer(data.encode(), np.uint8), starts)
    strings = [data[a : a + 100] for a in starts[order].tolist()]
    assert strings == sorted(strings)
    assert heads.tolist() == [k for k, t in enumerate(strings) if not k or t != strings[k - 1]]


def test_periodic_texts_are_few_phrases(spark):
    rows = [(1, "a" * 1_000_000), (2, "ab" * 250_000), (3, "x" + "a" * 5000), (4, "abcdefg" * 40_000 + "ab" * 300)]
    rows.append((5, "ba" * 400 + "gabcdef" * 100))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    known = S.identified(df)[1]
    assert S.parse(known).count() < 0.002 * sum(len(t) for _, t in rows)
    expected = {i: len(k) for i, k in slow(rows).items()}
    assert {r.doc_id: len(r.kept) for r in S.remove_repeats(df).collect()} == expected


def test_triggers_do_not_depend_on_blocks():
    rng = random.Random(4)
    text = "".join(rng.choices("ab ", k=5000)).encode()
    alone = {(s - 0, t) for s, n, t, _ in zip(*(a.tolist() for a in S.phrases(np.frombuffer(text, np.uint8), np.array([len(text)]))))}
    before = b"q" * 70_000
    start, _, trigger, _ = S.phrases(np.frombuffer(before + text, np.uint8), np.array([len(before), len(before) + len(text)]))
    later = {(s - len(before), t - len(before)) for s, t in zip(start.tolist(), trigger.tolist()) if s >= len(before)}
    assert later == alone


def test_sql(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    found = S.query(spark, sf)
    expected = con.execute(f"SELECT {', '.join(found.columns)} FROM ({S.ORACLE})").fetchall()
    assert sorted(map(tuple, found.collect())) == sorted(expected) and sum(r[2] for r in expected) > 0
