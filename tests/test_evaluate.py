"""Checks of files and lists, on what write_tsv() writes and on broken files."""

from pairloom.plans import evaluate as E
from pairloom.plans import pipeline
from pairloom.sources import tables

HEADER = ["source1_entity_id", "matched_entity_ids"]


def ids(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "id string")


def test_written_folders_pass(spark, tmp_path):
    rows = [(f"S1-{i}", f"S2-{i},S3-{i}" if i % 2 else "") for i in range(8)]
    path = str(tmp_path / "out")
    tables.write_tsv(spark.createDataFrame(rows, "source1_entity_id string, matched_entity_ids string").repartition(3), path)
    assert len(tables.first_lines(spark, path)) == 3
    good, bad = E.read_rows(spark, path)
    assert sorted(map(tuple, good.collect())) == rows and bad.isEmpty()
    assert E.validate(spark, path, HEADER, ids(spark, *(r[0] for r in rows))) == (True, f"PASS {path}")
    assert {r.id: r.ids for r in tables.read_id_lists(spark, path).collect()} == {k: v.split(",") if v else [] for k, v in rows}


def test_examples_and_totals(spark, tmp_path):
    path = tmp_path / "m.tsv"
    lines = ["S1-1\tS2-1,S2-1", "S1-1\tS2-2", "S1-2\tS1-9,X-1", "no tab", "S1-99\t"]
    path.write_text("\t".join(HEADER) + "\n" + "\n".join(lines) + "\n")
    required = ids(spark, "S1-1", "S1-2", *(f"S1-1{k}" for k in range(7)))
    passed, report = E.validate(spark, str(path), HEADER, required, ids(spark, "S2-1"))
    assert not passed
    found = dict(part.split(": ", 1) for part in report.split(f"FAIL {path}: ")[1].split("; "))
    assert found == {
        "duplicate_row": "1 (S1-1)", "repeated_id": "1 (S1-1)", "self_match": "1 (S1-9)", "wrong_prefix": "1 (X-1)", "extra_row": "1 (S1-99)", "unknown_id": "1 (S2-2)",
        "missing_row": "7 (S1-10, S1-11, S1-12, S1-13, S1-14, ...)", "malformed_row": "1 (no tab)",
    }


def test_headers(spark, tmp_path):
    def header(text):
        (tmp_path / "h.tsv").write_text(text)
        return E.header_errors(spark, str(tmp_path / "h.tsv"), HEADER)

    assert header("Source1_Entity_ID\tmatched_entity_ids \nx\ty\n") == []
    assert header("a,b\n") == ["comma_separated"] and header("a\tb\n") == ["wrong_header"] and header("") == ["empty_file"]
    assert E.header_errors(spark, str(tmp_path / "none.tsv"), HEADER) == ["missing_file"]
    assert E.validate(spark, str(tmp_path / "none.tsv"), HEADER, ids(spark))[0] is False


def test_matches_outside_candidates_are_a_warning(spark, tmp_path):
    for name, rows in (("m", "S1-1\tS2-1,S2-2\nS1-2\tS2-1\n"), ("c", "S1-1\tS2-1\n")):
        (tmp_path / name).write_text("\t".join(HEADER) + "\n" + rows)
    passed, report = E.validate(spark, str(tmp_path / "m"), HEADER, ids(spark, "S1-1", "S1-2"), candidates=str(tmp_path / "c"))
    assert passed and report.endswith("WARN matches that are no candidates: 2 (S1-1, S1-2)")
    assert "WARN no file" in E.validate(spark, str(tmp_path / "m"), HEADER, ids(spark, "S1-1", "S1-2"), candidates=str(tmp_path / "x"))[1]


def test_last_row_of_an_id_counts(spark, tmp_path):
    (tmp_path / "l.tsv").write_text("\t".join(HEADER) + "\nS1-1\tS2-9\nS1-2\nS1-1\tS2-1, S2-1,S2-2\n")
    assert {r.id: r.ids for r in tables.read_id_lists(spark, str(tmp_path / "l.tsv")).collect()} == {"S1-1": ["S2-1", "S2-2"], "S1-2": []}


def test_json(spark, tmp_path):
    path = f"file://{tmp_path}/sub/d.json"
    tables.save_json(spark, {"t": 0.5, "é": [1]}, path)
    assert tables.load_json(spark, path) == {"t": 0.5, "é": [1]}


def test_a_country_is_a_folder(spark, tmp_path):
    """One folder and the wanted columns are read."""
    rows = spark.createDataFrame([(1, "us", "a", "b"), (2, "fr", "c", "d")], "idx int, country string, x string, y string")
    table = pipeline.Work(spark, str(tmp_path)).table("t", lambda: rows, "country")
    found = table.filter("country = 'fr' AND x > 'a'").select("idx")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(country" in plan and "PushedFilters: [IsNotNull(x), GreaterThan(x,a)]" in plan and "ReadSchema: struct<idx:int,x:string>" in plan
    assert [r.idx for r in found.collect()] == [2]


def test_leak_guard(spark):
    truth = spark.createDataFrame([(1, 10), (2, 20), (3, 30)], "s1_idx int, cand_idx int")
    meta = spark.createDataFrame([(1, "fit"), (2, "val"), (3, "fit")], "s1_idx int, fold string")
    raw = spark.createDataFrame([(i, n) for i, n in ((1, "a"), (2, "b"), (3, "c"), (10, "ж"), (20, "б"), (30, "z"))], "idx int, business_name string")
    assert sorted(r.s1_idx for r in pipeline.fit_pairs(truth, meta).collect()) == [1, 3]
    assert [tuple(r) for r in pipeline.name_pairs(truth, meta, raw).collect()] == [("a", "ж")]
