import numpy as np
from pyspark.sql import functions as F

from pairloom.functions.similarity import SINGLE, STRING_FEATURES
from pairloom.operators import blocking as B
from pairloom.operators import features as P
from pairloom.operators import sampling
from pairloom.operators.normalize import normalize
from pairloom.plans import registry
from pairloom.sources import world


def make(spark):
    rows = [(i, 1, "us", f"alpha{i} stone works", f"{i + 10} mill road, town") for i in range(4)]
    rows += [(10 + i, 2, "us", f"alpha{i} stone works ltd", f"{i + 10} mill rd, town") for i in range(4)]
    rows += [(20, 3, "fr", "alpha0 stone works", "10 mill road, town"), (21, 2, "us", "", "")]
    return normalize(spark.createDataFrame(rows, "idx int, src int, country string, business_name string, business_address string")).cache()


def test_candidates(spark):
    found = make(spark)
    candidates = B.generate_candidates(found).cache()
    best = {r.s1_idx: r.cand_idx for r in candidates.filter("blk_rank = 1").collect()}
    assert best == {i: 10 + i for i in range(4)}
    assert candidates.filter("cand_idx = 20").isEmpty()  # another country
    bounds = candidates.agg(F.min("blk_name"), F.max("blk_name"), F.min("blk_addr"), F.max("blk_addr")).first()
    assert min(bounds) >= 0 and max(bounds) <= 1.0 + 1e-6
    # a sample of the query side is the whole result, restricted
    asked = found.filter("idx = 1").select("idx")
    part = B.generate_candidates(found, s1=asked).drop("from_extra").collect()
    assert sorted(part) == sorted(candidates.filter("s1_idx = 1").drop("from_extra").collect())


def test_extra_pairs_pass_the_cap(spark):
    found = make(spark)
    extra = spark.createDataFrame([(0, 21), (0, 20)], "s1_idx int, cand_idx int")
    kept = B.generate_candidates(found, extra, most=1)
    rows = {(r.s1_idx, r.cand_idx): r for r in kept.collect()}
    assert rows[0, 21].from_extra and (0, 20) not in rows
    assert {k for k in rows if k[0] == 0} == {(0, 10), (0, 21)}


def test_frequency_cap(spark):
    rows = [(i, 2, "us", "common thing", "") for i in range(20)] + [(100, 1, "us", "common thing", "")]
    schema = "idx int, src int, country string, business_name string, business_address string"
    assert B.generate_candidates(normalize(spark.createDataFrame(rows, schema))).count() == 20  # at the cap
    rows.append((50, 2, "us", "common thing", ""))
    assert B.generate_candidates(normalize(spark.createDataFrame(rows, schema))).isEmpty()  # above it


def test_bigrams(spark):
    df = spark.createDataFrame([(["a", "12", "b", "c"],), (["a"],), ([],)], "t array<string>")
    assert [r[0] for r in df.select(B.bigrams(F.col("t"))).collect()] == [["b_c"], [], []]


def test_features(spark):
    found = make(spark)
    candidates = B.generate_candidates(found).drop("from_extra")
    rows = P.build_features(candidates, found).collect()
    exact = next(r for r in rows if (r.s1_idx, r.cand_idx) == (2, 12))
    assert exact.nc_exact == 1 and exact.nm_tset == 100 and exact.house_eq == 1 and exact.street_eq == 1 and exact.legal_eq is None
    assert exact.cx_nm_tset_rank == 1 and exact.cx_s1_n_strong_name >= 1 and exact.cand_is_s3 == 0
    names = P.feature_columns(P.build_features(candidates, found))
    assert len([n for n in names if not n.startswith(("blk_", "cx_"))]) == 51 and len(names) == 72


def test_sampling(spark, sf_dir):
    ids = spark.range(2000)
    share = ids.filter(sampling.sampled(F.col("id"), 0.3, 5)).count() / 2000
    assert 0.25 < share < 0.35
    assert ids.repartition(7).filter(sampling.sampled(F.col("id"), 0.3, 5)).count() == share * 2000


def test_rounds_find_the_same(spark, sf_dir, monkeypatch):
    found = normalize(world.records(spark, sf_dir)).select("idx", "src", "country", "name_tokens", "name_skel", "name_compact", "street_key", "addr_ids", "addr_numbers", "addr_tokens").cache()
    extra = found.filter("src = 1").select(F.col("idx").alias("s1_idx"), (F.col("idx") + 1).alias("cand_idx"))
    whole = B.generate_candidates(found, extra)
    tables = []
    monkeypatch.setattr(B, "KEYS", 0)
    monkeypatch.setattr(B, "PAIRS", 400)
    monkeypatch.setattr(B, "stash", lambda df, name, f=B.stash: tables.append(name) or f(df, name))
    parts = B.generate_candidates(found, extra)
    assert tables.count("postings") == B.KEY_ROUNDS and tables.count("candidates") > 3 and "scores" not in tables
    assert sorted(parts.collect()) == sorted(whole.collect())


def test_one_sort_ranks_all_channels(spark):
    rows = [(s, c, round((s * 31 + c * 17) % 7 / 10, 6) if c % 3 == 0 else 0.0, round((s * 13 + c * 29) % 11 / 10, 6), c == 59) for s in range(3) for c in range(60)]
    got = B.ranked_candidates(spark.createDataFrame(rows, "s1_idx long, cand_idx long, blk_name double, blk_addr double, from_extra boolean"), {"name": 3, "addr": 4, "both": 5}, 0)
    want = set()
    for s in range(3):
        own = [(c, {"name": n, "addr": a, "both": round(n + a, 6)}, x) for t, c, n, a, x in rows if t == s]
        rank = {(k, c): i for k in ("name", "addr", "both") for i, (c, v, _) in enumerate(sorted(own, key=lambda r: (-r[1][k], r[0])), 1) if v[k] > 1e-6}
        for c, _, x in own:
            ranks = tuple(r if (r := rank.get((k, c), 99)) <= most else most + 1 for k, most in (("name", 3), ("addr", 4), ("both", 5)))
            if x or ranks != (4, 5, 6):
                want.add((s, c, *ranks))
    assert {(r.s1_idx, r.cand_idx, r.blk_rank_name, r.blk_rank_addr, r.blk_rank_both) for r in got.collect()} == want


def test_report_reads_tables(spark, sf_dir, monkeypatch):
    tables = []
    monkeypatch.setattr(registry, "stash", lambda df, name, f=registry.stash: tables.append(name) or f(df, name))
    made = []
    monkeypatch.setattr(B, "generate_candidates", lambda *a, f=B.generate_candidates: made.append(f(*a)) or made[-1])
    registry.block_report(spark, sf_dir)
    assert tables == ["truth"]  # it is used twice, as are the candidates
    assert "Exchange" not in made[0]._jdf.queryExecution().executedPlan().toString()


def test_truth_by_digest(spark):
    rows = [(1, 1, "us", "a", "b"), (2, 1, "us", "a", "b"), (3, 2, "us", "a", "b"), (4, 3, "fr", "a", "b"), (5, 2, "us", "ab", ""), (6, 1, "us", "", "ab"), (7, 1, "us", None, "x"), (8, 2, "us", None, "x"), (9, 3, None, "a", "b")]
    found = spark.createDataFrame(rows, "idx int, src int, country string, business_name string, business_address string")
    assert [tuple(r) for r in world.truth(found).collect()] == [(1, 3)]
    plan = world.truth(found)._jdf.queryExecution().optimizedPlan().toString().split("Join")[0] + world.truth(found)._jdf.queryExecution().executedPlan().toString()
    assert "sha2" in plan


def test_overlaps_in_blocks(spark, sf_dir, monkeypatch):
    found = normalize(world.records(spark, sf_dir)).select("idx", "country", "business_name", *P.RECORD_COLUMNS).cache()
    pairs = B.generate_candidates(found).select("s1_idx", "cand_idx")
    want = P.pair_table(pairs, found).select("s1_idx", "cand_idx", "addr_empty_1", "addr_empty_2", *(c.alias(n) for n, c in P.set_features().items()))
    tables = []
    monkeypatch.setattr(P, "BLOCK", 4000)
    monkeypatch.setattr(P, "stash", lambda df, name, f=P.stash: tables.append(name) or f(df, name))
    got = P.overlap_table(pairs, found, P.SETS | {"aid": "addr_ids"}, ("addr_empty",))
    assert tables.count("overlaps") > 2
    got = got.select("s1_idx", "cand_idx", "addr_empty_1", "addr_empty_2", *(c.alias(n) for p in P.SETS for n, c in P.overlap_shares(p).items()), "aid_inter")
    assert want.columns == got.columns and sorted(map(str, want.collect())) == sorted(map(str, got.collect()))


def test_masked_overlaps_come_from_numbers(spark, sf_dir, monkeypatch):
    made = []
    monkeypatch.setattr(P, "overlap_table", lambda *a, f=P.overlap_table: made.append(f(*a)) or made[-1])
    found = registry.missing_mask(spark, sf_dir)
    assert not [n for n, kind in made[0].dtypes if kind.startswith("array")]
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    empty = found.join(made[0].select("s1_idx", "cand_idx", (F.col("addr_empty_1") | F.col("addr_empty_2")).alias("empty")), ["s1_idx", "cand_idx"])
    assert empty.filter("empty AND (atok_jac IS NOT NULL OR atok_cont1 IS NOT NULL OR atok_cont2 IS NOT NULL)").isEmpty() and found.count() == empty.count()


def test_features_in_blocks(spark, sf_dir, monkeypatch):
    """No pair is dealt with its texts, and the features are those of the pairs one by one."""
    found = normalize(world.records(spark, sf_dir)).cache()
    pairs = B.generate_candidates(found).select("s1_idx", "cand_idx", "blk_score")
    tables = []
    monkeypatch.setattr(P, "TEXTS", 3000, raising=False)
    monkeypatch.setattr(P, "stash", lambda df, name, f=P.stash: tables.append(name) or f(df, name))
    got = P.base_features(pairs, found)
    assert tables.count("base") > 2 and "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    rows = {(r.s1_idx, r.cand_idx): r for r in got.collect()}
    assert len(rows) == got.count() == pairs.count()
    others = P.set_features() | P.house_features() | P.equality_features() | P.size_and_flag_features()
    texts = P.pair_table(pairs, found).withColumns(others).collect()
    for r in sorted(texts, key=lambda r: len(r.addr_norm_1) + len(r.addr_norm_2))[:60]:
        own = rows[r.s1_idx, r.cand_idx]
        empty = r.addr_empty_1 or r.addr_empty_2
        for feature, column, kind in STRING_FEATURES:
            value = None if feature in P.ADDRESS_ONLY and empty else SINGLE[kind](r[f"{column}_1"], r[f"{column}_2"])
            assert own[feature] == value or abs(own[feature] - value) < 1e-9, feature
        assert all(own[n] == (None if n in P.ADDRESS_ONLY and empty else r[n]) for n in others)


def test_lists_are_ranked_as_pairs_are(spark, sf_dir, monkeypatch):
    """Candidates by lists are those of ranked_candidates() by pairs, and no pair becomes a row before."""
    found = normalize(world.records(spark, sf_dir)).cache()
    extra = found.filter("src = 1").select(F.col("idx").alias("s1_idx"), (F.col("idx") + 3).alias("cand_idx"))
    keys = B.record_keys(found).cache()
    scores = B.pair_scores(keys, B.key_weights(keys, found)).drop("country")
    more = B.within_country(extra, found).distinct().withColumn("x", F.lit(True))
    scores = scores.join(more, ["s1_idx", "cand_idx"], "full_outer").fillna(0.0).select("s1_idx", "cand_idx", "blk_name", "blk_addr", F.coalesce("x", F.lit(False)).alias("from_extra"))
    plans = []
    monkeypatch.setattr(B, "stash", lambda df, name, f=B.stash: plans.append((name, df._jdf.queryExecution().optimizedPlan().toString())) or f(df, name))
    for k, most in ((B.K, B.MAX_CANDIDATES), ({"name": 2, "addr": 3, "both": 4}, 5), ({"name": 1, "addr": 1, "both": 1}, 0)):
        got = B.generate_candidates(found, extra, k=k, most=most)
        want = B.ranked_candidates(scores, k, most).select(got.columns)
        assert got.count() > 50 and sorted(got.collect()) == sorted(want.collect())
    assert all(plan.count("Generate explode") == 1 for name, plan in plans if name == "candidates")


def test_shared_words_in_slots():
    """Hashes of one slot, the hash zero and negative ones, and records without words."""
    rng = np.random.default_rng(3)
    pool = np.concatenate(([0, 5, 5 + P.SLOTS, 5 + 2 * P.SLOTS, -1, -P.SLOTS, ~0 ^ P.SLOTS], rng.integers(-(2**63), 2**63 - 1, 20)))
    table = ~np.arange(P.SLOTS)
    sets = [[rng.choice(pool, n, replace=False) for n in rng.integers(0, 12, 2)] for _ in range(30)]
    words, sizes = np.concatenate([x for s in sets for x in s]), np.array([[len(x) for x in s] for s in sets])
    begins = np.concatenate(([0], np.cumsum(sizes.ravel())))
    ends = begins[np.arange(30)[:, None] * 2 + np.arange(3)]
    for n in (0, 1, 9, len(pool)):
        own, ask = rng.choice(pool, n, replace=False), rng.choice(30, 12)
        got = P._shared_words(ask, words, ends, own, table)
        assert got.tolist() == [[len(set(x.tolist()) & set(own.tolist())) for x in sets[i]] for i in ask]
        assert (table == ~np.arange(P.SLOTS)).all()


def test_overlaps_deal_nothing(spark, sf_dir, monkeypatch):
    plans = []
    monkeypatch.setattr(P, "stash", lambda df, name, f=P.stash: plans.append((name, df._jdf.queryExecution().executedPlan().toString())) or f(df, name))
    registry.set_overlap(spark, sf_dir).count()
    assert "overlaps" in dict(plans) and not [name for name, plan in plans if name == "overlaps" and ("Exchange" in plan or "Join" in plan)]
