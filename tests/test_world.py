import random

from pyspark.sql import functions as F

from pairloom.functions import similarity as S
from pairloom.operators import matcher
from pairloom.plans import registry
from pairloom.sources import world


class Trained(Exception):
    pass


def test_classifier_sees_whole_records(spark, sf_dir, monkeypatch):
    seen = {}

    def train(pairs, features, *args, **params):
        seen["params"] = (args, params)
        raise Trained

    monkeypatch.setattr(matcher, "train", train)
    monkeypatch.setattr(registry, "normalize", lambda records, f=registry.normalize: seen.update(records=records) or f(records))
    try:
        registry.gbt_predict(spark, sf_dir)
    except Trained:
        pass
    assert seen["params"] == ((), {})  # matcher.PARAMS as they are
    columns = ["idx", "business_name", "business_address"]
    got = seen["records"].filter("idx < 10000000000").select(columns).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, world.records(spark, sf_dir).select(columns).collect()))


def test_a_dropped_word_leaves_all_others(spark):
    name = " ".join(f"w{i}" for i in range(150))
    base = spark.range(40).select(F.col("id").alias("idx"), F.lit("S1").alias("entity_id"), F.lit(1).cast("tinyint").alias("src"), F.lit("en").alias("country"), F.lit(name).alias("business_name"), F.lit("a b").alias("business_address"))
    made, _ = world.with_noisy_copies(base)
    lengths = {len(r.business_name.split()) for r in made.filter("src <> 1").collect()}
    assert lengths == {149, 150, 151}


def slow_partial(a, b):
    """Every window of the longer string, those at the ends shorter."""
    short, long = sorted((a, b), key=len)
    windows = lambda x, y: max(S.ratio(x, y[max(0, s) : s + len(x)]) for s in range(1 - len(x), len(y)))
    return max(windows(short, long), windows(long, short) if len(a) == len(b) else 0.0)


def test_partial_skips_no_better_window():
    rng = random.Random(5)
    for _ in range(300):
        a, b = ("".join(rng.choices("abcde ", k=rng.randint(1, 40))) for _ in range(2))
        b = b + a[3:20] + b if rng.random() < 0.4 else b
        assert S.partial(a, b) == slow_partial(a, b)
