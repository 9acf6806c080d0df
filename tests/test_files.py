import json

import pytest

from kinspan.operators import profile, validate
from kinspan.schema import Paths
from kinspan.sources import tsv

SCHEMA = "entity_id string, business_name string, business_address string, country string"


def test_tsv_round_trip(spark, tmp_path):
    rows = [("S1-1", 'A "quoted" name', "", "NA"), ("S1-2", "", "tab, comma", "US")]
    path = f"{tmp_path}/s.tsv"
    tsv.write_tsv(spark.createDataFrame(rows, SCHEMA), path)
    assert open(path).read().splitlines()[0] == "entity_id\tbusiness_name\tbusiness_address\tcountry"
    assert sorted(map(tuple, tsv.load_source(spark, path).collect())) == rows
    assert tsv.load_source(spark, path, 1).count() == 1
    with pytest.raises(ValueError, match="matched_entity_ids"):
        tsv.load_truth(spark, path)


def test_json_report_and_paths(spark, tmp_path, monkeypatch):
    tsv.write_json(spark.createDataFrame([(1, "é")], "n int, s string"), f"{tmp_path}/a/x.json")
    assert tsv.read_json(f"{tmp_path}/a/x.json") == {"n": 1, "s": "é"} and "é" in open(f"{tmp_path}/a/x.json").read()
    tsv.write_profile_report({"t": {"rows": 3}}, f"{tmp_path}/r.md")
    assert "- rows: 3" in open(f"{tmp_path}/r.md").read()
    tsv.package({"x.json": f"{tmp_path}/a/x.json", "all": f"{tmp_path}/a"}, f"{tmp_path}/z.zip")
    monkeypatch.setenv("KINSPAN_DATA_ROOT", "/data")
    assert str(Paths().source("train", 2)) == "/data/train/train_source2.tsv" and str(Paths(data="/d").truth()).startswith("/d/")
    with pytest.raises(FileNotFoundError):
        Paths(data=str(tmp_path)).discover("test")


def write(path, text):
    path.write_text(text)
    return str(path)


def rules(df):
    return {(r.rule): (r.severity, r.n, r.examples) for r in df.collect()}


def test_validator_finds_each_fault(spark, tmp_path):
    s1 = write(tmp_path / "s1.tsv", "entity_id\tbusiness_name\nS1-1\ta\nS1-2\tb\nS1-3\tc\n\n")
    s2 = write(tmp_path / "s2.tsv", "entity_id\tx\nS2-1\ta\n")
    good = write(tmp_path / "m.tsv", "source1_entity_id\tmatched_entity_ids\nS1-1\tS2-1\nS1-2\t\nS1-3\t\n")
    assert validate.passed(validate.validate_files(spark, good, None, s1, [s2]))
    bad = write(tmp_path / "b.tsv", "Source1_Entity_ID \tmatched_entity_ids\nS1-1\tS2-1,S2-1\nS1-1\tS1-7\nno tab\nS1-2\tQ-1,\nS1-9\tS3-5\n\n")
    cand = write(tmp_path / "c.tsv", "source1_entity_id\tcandidate_entity_ids\nS1-1\t\nS1-2\t\nS1-3\t\n")
    got = rules(validate.validate_files(spark, bad, cand, s1, [s2]))
    assert {k: v[1] for k, v in got.items()} == {"malformed_row": 1, "duplicate_row": 1, "duplicate_id_in_list": 1, "self_match": 1, "wrong_prefix": 2, "missing_required": 1, "extra_row": 1, "unknown_id": 1, "not_a_candidate": 3}
    assert got["not_a_candidate"][0] == "warning" and got["missing_required"][2] == "S1-3"


def test_malformed_rows_have_their_line_numbers(spark, tmp_path):
    s1 = write(tmp_path / "s1.tsv", "entity_id\n" + "".join(f"S1-{i}\n" for i in range(200)))
    (tmp_path / "m").mkdir()
    part = lambda lo, hi: "source1_entity_id\tmatched_entity_ids\n" + "".join(f"S1-{i}\t\n" if i != 150 else "broken\n" for i in range(lo, hi))
    write(tmp_path / "m" / "part-0.tsv", part(0, 90))
    write(tmp_path / "m" / "part-1.tsv", part(90, 200))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    try:
        got = rules(validate.validate_files(spark, str(tmp_path / "m"), None, s1))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got["malformed_row"] == ("error", 1, "line 000062: broken") and got["missing_required"][2] == "S1-150" and "extra_row" not in got


def test_command_line(spark, tmp_path, capsys):
    s1 = write(tmp_path / "s1.tsv", "entity_id\nS1-1\n")
    s2 = write(tmp_path / "s2.tsv", "entity_id\nS2-1\n")
    good = write(tmp_path / "g.tsv", "source1_entity_id\tmatched_entity_ids\nS1-1\tS2-1\n")
    bad = write(tmp_path / "b.tsv", "source1_entity_id\tmatched_entity_ids\nS1-1\tS2-9\n")
    assert validate.main(["--matching", good, "--source1", s1, "--check-ids", s2]) == 0 and capsys.readouterr().out.endswith("PASS\n")
    assert validate.main(["--matching", bad, "--source1", s1, "--check-ids", s2]) == 1 and "unknown_id (1): S2-9" in capsys.readouterr().out


def test_sources_are_found_below_the_data_folder(tmp_path):
    for i in (1, 2, 3):
        (tmp_path / "deep" / str(i)).mkdir(parents=True)
        write(tmp_path / "deep" / str(i) / f"test_source{i}.tsv", "x")
    assert Paths(data=str(tmp_path)).discover("test")["source2"] == tmp_path / "deep" / "2" / "test_source2.tsv"


@pytest.mark.parametrize(("text", "rule"), [("", "empty_file"), ("source1_entity_id,matched_entity_ids\n", "comma_separated"), ("a\tb\n", "unexpected_header")])
def test_headers_that_stop(spark, tmp_path, text, rule):
    s1 = write(tmp_path / "s1.tsv", "entity_id\nS1-1\n")
    got = rules(validate.validate_files(spark, write(tmp_path / "m.tsv", text), None, s1))
    assert got[rule][0] == "error" and got["ids_not_checked"][0] == "warning"
    assert "missing_file" in rules(validate.validate_files(spark, f"{tmp_path}/none.tsv", None, s1))


def test_profiles(spark):
    r = spark.createDataFrame([("S1-1", "ab", "1 x", "US"), ("S1-1", "é", "", ""), ("S1-2", "ab", "y", "US")], SCHEMA)
    p = profile.profile_source(r).first()
    assert (p.row_count, p.duplicate_entity_ids, p.duplicate_business_name_rows, p.empty_address, p.empty_country, p.names_with_non_ascii, p.addresses_with_digits) == (3, 1, 1, 1, 1, 1, 1)
    assert p.name_len_p95 == 2.0 and {x.country: x.n for x in profile.country_distribution(r).collect()} == {"US": 2, "": 1}
    t = profile.profile_truth(spark.createDataFrame([("a", "x,y"), ("b", "")], "source1_entity_id string, matched_entity_ids string")).first()
    assert (t.n_singleton, t.n_multi_match, t.avg_match_count, t.max_match_count) == (1, 1, 1.0, 2)
    assert json.dumps(p.asDict())
