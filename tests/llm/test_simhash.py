import random

import duckdb
import numpy as np
import pytest
import xxhash

from pairloom.llm import simhash as S
from pairloom.llm.graph import connected_components


def slow_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 3]), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(nodes, linked):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in nodes:
        for b in nodes:
            if a < b and linked(a, b):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {n: find(n) for n in nodes}


def test_against_brute_force(docs, plain):
    prints = [slow_fingerprint(t) for _, t, _, _ in plain]
    root = components(set(prints), lambda a, b: (a ^ b).bit_count() <= 3)
    least = {}
    for (i, *_), f in zip(plain, prints):
        if i is not None:
            least[root[f]] = min(i, least.get(root[f], i))
    expected = sorted((-1 if i is None else i, f, least.get(root[f], -1)) for (i, *_), f in zip(plain, prints))
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.fp % (1 << 64), -1 if r.component_id is None else r.component_id) for r in S.near_duplicates(docs).collect())
    assert got == expected


def near_fingerprints(rng, radius):
    fps = [rng.getrandbits(64) for _ in range(700)]
    for _ in range(600):  # neighbours, dense groups among them
        f = rng.choice(fps[-200:] if rng.random() < 0.5 else fps)
        fps.append(f ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, radius))))
    shared = rng.getrandbits(32)  # and many that share a half, or nearly
    for _ in range(400):
        f = shared | rng.getrandbits(32) << 32
        fps += [f, f ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, radius)))]
    return np.unique(np.array(fps, np.uint64))


def pairs_of(fps, radius):
    return {(int(a), int(b)) for i, a in enumerate(fps) for b in fps[i + 1 :][np.bitwise_count(fps[i + 1 :] ^ a) <= radius]}


@pytest.mark.parametrize("radius", [1, 2, 3, 4, 5, 6])
def test_trees_lose_no_link(spark, radius):
    fps = near_fingerprints(random.Random(radius), radius)
    pairs = pairs_of(fps, radius)
    parts = []
    S.route(S.build_trees(fps[::3], 16, radius), fps, np.arange(len(fps)), [0], parts)
    met = set()
    for _, rows in parts:
        members = set(fps[rows].tolist())
        met |= {p for p in pairs if p[0] in members and p[1] in members}
    assert met == pairs and len(parts) > 20 and max(len(r) for _, r in parts) < len(fps) / 2
    root = components(fps.tolist(), lambda a, b: (a, b) in pairs)
    u, v = S.shard_links(fps, 16, radius)
    assert len(u) < 8 * len(fps)  # forests, not all pairs
    df = spark.createDataFrame([(x,) for x in fps.view(np.int64).tolist()], "fp long")
    found = {r.node % (1 << 64): r.root % (1 << 64) for r in connected_components(S.links(df, radius, 500, 32)).collect()}
    least = lambda f: min((g for g in root if root[g] == root[f]), key=lambda x: x if x < 1 << 63 else x - (1 << 64))
    alone = {f for f in root if sum(r == root[f] for r in root.values()) == 1}
    assert found == {f: least(f) for f in root if f not in alone}


def test_links_at_three_bits_and_not_at_four(spark):
    base = 0x0123456789ABCDEF
    fps = [base, base ^ 0b111, base ^ (0b1111 << 40), base ^ 0b111 ^ (0b111 << 20)]
    df = spark.createDataFrame([(x if x < 1 << 63 else x - (1 << 64),) for x in fps], "fp long")
    found = connected_components(S.links(df, sample=2)).collect()
    assert {r.node for r in found} == {fps[0], fps[1], fps[3]} and {r.root for r in found} == {min(fps[0], fps[1], fps[3])}


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (7, 7), (101, 100)], "u long, v long")
    found = {r.node: r.root for r in connected_components(edges).collect()}
    assert found == {i: 0 for i in range(61)} | {100: 100, 101: 100}


def test_one_document_of_each_group_stays(docs, none, plain):
    kept = S.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(150) == 1 and not set(range(100, 106)) & set(ids) and set(range(6)) <= set(ids)
    assert S.drop_near_duplicates(none).isEmpty() and S.near_duplicates(none).isEmpty()


def kept_slowly(rows):
    """One row of each component: least doc_id (null last), fingerprint as a signed number, text hash; here texts of an id and fingerprint are equal."""
    prints = {t: slow_fingerprint(t) for _, t in rows}
    root = components(set(prints.values()), lambda a, b: (a ^ b).bit_count() <= 3)
    best = {}
    for i, t in rows:
        f = prints[t]
        key = (i is None, i or 0, f if f < 1 << 63 else f - (1 << 64))
        best[root[f]] = min(best.get(root[f], (key, t)), (key, t), key=lambda x: x[0])
    return sorted((k[1] if not k[0] else 0, t) for k, t in best.values())


def test_rows_are_kept_by_component(spark):
    text = lambda k: " ".join(f"w{k}x{i * i % 97}" for i in range(60))
    a, b, c, d = map(text, (1, 2, 3, 4))
    tables = [
        [(1, a), (5, b), (5, c), (5, a), (5, c), (7, b), (None, a), (None, d)],
        [(5, a), (5, b)],  # unlike texts of one id
        [(2, b), (5, a), (5, b)],
        [(1, a), (None, a), (None, c)],
        [(None, a), (None, a), (None, b)],
        [(3, a)] * 4 + [(3, b), (9, b), (None, None), (4, ""), (4, " ")],
    ]
    for rows in tables:
        kept = S.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
        found, expected = sorted((r.doc_id or 0, r.text or "") for r in kept), [(i, t or "") for i, t in kept_slowly(rows)]
        assert [(i, t.strip()) for i, t in found] == [(i, t.strip()) for i, t in expected]


def test_kept_rows_against_brute_force(docs, plain):
    rows = [(i, t) for i, t, _, _ in plain]
    kept = sorted((r.doc_id or 0, slow_fingerprint(r.text)) for r in S.drop_near_duplicates(docs).collect())
    assert kept == sorted((i, slow_fingerprint(t)) for i, t in kept_slowly(rows))


def test_xxh64_in_sql():
    rng = random.Random(1)
    texts = sorted({"".join(rng.choices("abcdé 日z", k=rng.randint(1, 90))) for _ in range(300)})
    con = duckdb.connect()
    con.execute("CREATE TABLE q (t VARCHAR)")
    con.executemany("INSERT INTO q VALUES (?)", [(t,) for t in texts])
    assert dict(con.execute(S._xxh64("q")).fetchall()) == {t: xxhash.xxh64_intdigest(t.encode(), 42) for t in texts}


def test_sql(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf_dir}/documents.parquet')")
    found = S.query(spark, sf_dir)
    assert sorted(map(tuple, found.collect())) == sorted(con.execute(f"SELECT {', '.join(found.columns)} FROM ({S.ORACLE})").fetchall())
