import pytest

from pairloom.operators import decide as D
from pairloom.plans import evaluate as E


def pairs(spark, rows):
    return spark.createDataFrame(rows, "s1_idx int, cand_idx int, p double, label int")


def ids(df):
    return sorted((r.s1_idx, r.cand_idx) for r in df.collect())


def test_one_to_one_and_ambiguity(spark):
    scored = pairs(spark, [(1, 10, 0.9, 1), (2, 10, 0.85, 0), (2, 11, 0.2, 1), (3, 12, 0.02, 0)])
    assert ids(D.one_to_one(scored)) == [(1, 10), (2, 11), (3, 12)]
    # a near-tie goes to nobody; a lone candidate below the gap goes as well
    assert ids(D.one_to_one(scored, 0.1)) == [(2, 11)]


def test_ties_go_to_the_smaller_record(spark):
    assert ids(D.one_to_one(pairs(spark, [(2, 10, 0.5, 1), (1, 10, 0.5, 0)]))) == [(1, 10)]


def test_rules(spark):
    scored = pairs(spark, [(1, 10, 0.95, 1), (1, 11, 0.1, 0), (2, 12, 0.97, 1), (3, 13, 0.06, 0), (4, 14, 1.0, 1)])
    assert ids(D.select_threshold(scored, 0.5)) == [(1, 10), (2, 12), (4, 14)]
    assert ids(D.select_expected_f(scored)) == [(1, 10), (2, 12), (4, 14)]
    meta = spark.createDataFrame([(1, 1), (2, 1), (3, 0), (4, 1)], "s1_idx int, n_true int")
    chosen = D.apply_rule(scored, {"rule": "expected_f", "min_p": 0.05, "amb": 0.0})
    assert D.macro_f05(chosen, meta).first().macro_f05 == 1.0
    assert D.breakdown(chosen, meta).first().singleton_acc == 1.0


def test_tune_agrees_with_each_rule(spark):
    rows = [(s, 10 * s + c, ((s * 37 + c * 11) % 100) / 100.0, (s + c) % 2) for s in range(12) for c in range(5)] + [(s, 500, s / 20, 0) for s in range(12)]
    scored = pairs(spark, rows)
    meta = spark.createDataFrame([(s, sum(r[3] for r in rows if r[0] == s)) for s in range(14)], "s1_idx int, n_true int")
    grid = D.tune(scored, meta).collect()
    assert len(grid) == 84
    for r in grid[::17]:
        rule = {"rule": r.rule, "t" if r.rule == "threshold" else "min_p": r.value, "amb": r.amb}
        assert D.macro_f05(D.apply_rule(scored, rule), meta).first().macro_f05 == pytest.approx(r.macro_f05, abs=1e-6)


def test_score_lists(spark):
    truth = spark.createDataFrame([("S1-1", ["a", "b"]), ("S1-2", []), ("S1-3", []), ("S1-4", ["c"])], "id string, ids array<string>")
    predicted = spark.createDataFrame([("S1-1", ["a", "b", "x"]), ("S1-2", []), ("S1-3", ["y"]), ("S1-4", []), ("S1-9", ["z"])], "id string, ids array<string>")
    scores = {r.id: r.score for r in E.score_entities(predicted, truth).collect()}
    assert scores["S1-1"] == pytest.approx(0.714, abs=5e-4)
    assert (scores["S1-2"], scores["S1-3"], scores["S1-4"]) == (1.0, 0.0, 0.0)
    with pytest.raises(ValueError):
        E.score_lists(predicted.filter("id <> 'S1-1'"), truth)


def test_validate(spark, tmp_path):
    path = tmp_path / "m.tsv"
    required = spark.createDataFrame([("S1-1",), ("S1-2",), ("S1-3",)], "id string")
    path.write_text("source1_entity_id\tmatched_entity_ids\nS1-1\tS2-1,S3-1\nS1-2\t\nS1-3\tS2-9\n")
    head = ["source1_entity_id", "matched_entity_ids"]
    assert E.validate(spark, str(path), head, required) == (True, f"PASS {path}")
    path.write_text("source1_entity_id\tmatched_entity_ids\nS1-1\tS2-1,S2-1\nS1-1\tS1-2,Q-1\nS1-7\t\nbroken\n")
    passed, report = E.validate(spark, str(path), head, required)
    assert not passed
    for rule in ("duplicate_row", "repeated_id", "self_match", "wrong_prefix", "missing_row: 2", "extra_row", "malformed_row: 1"):
        assert rule in report
    path.write_text("a,b\n")
    assert E.header_errors(spark, str(path), head) == ["comma_separated"]
    assert E.header_errors(spark, str(tmp_path / "none"), head) == ["missing_file"]
