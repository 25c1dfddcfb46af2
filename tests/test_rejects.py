"""Faults of positional files: what is rejected, why, and that the typed reader agrees."""

import pytest
from frames import rows

from rulecast.plans import jobs
from rulecast.plans.offers import offer_checks
from rulecast.sources.readers import check_offer_control, read_offer_control, read_positional_csv
from rulecast.sources.rejects import check_positional_csv
from rulecast.sources.schemas import OFFER_CONTROL

SCHEMA = "name string, n int, x double, note string"
LINES = [
    "NAME,n,x,note",
    "good,1,2.5,text",
    "empty,,,",
    'quoted,1,2,"a, b"',
    "word,one,2,t",
    "both,1.5,two,t",
    "",
    "short,1",
    "long,1,2,t,more",
    ",1,2,t",
    "wide,99999999999,2,t",
    "blank, 7,2,t",
    "good,1,2.5,text",
]


@pytest.fixture
def path(tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("\n".join(LINES) + "\n")
    return str(tmp_path / "in")


def test_every_line_is_a_title_accepted_or_rejected(spark, path):
    checked = check_positional_csv(spark, path, SCHEMA, ("name", "NAME"))
    accepted = rows(checked.rows)
    lines = {r.line for r in checked.rejected.collect()}
    assert accepted == sorted([("good", 1, 2.5, "text")] * 2 + [("empty", None, None, None), ("quoted", 1, 2.0, 'a, b')], key=repr)
    assert lines == {x for x in LINES if x} - {"NAME,n,x,note", "good,1,2.5,text", "empty,,,", 'quoted,1,2,"a, b"'}
    faults = {(r.line.split(",")[0], r.field, r.value, r.reason) for r in checked.rejected.collect()}
    assert faults == {
        ("word", "n", "one", "not a value of type int"),
        ("both", "n", "1.5", "not a value of type int"),
        ("both", "x", "two", "not a value of type double"),
        ("short", None, None, "number of fields"),
        ("long", None, None, "number of fields"),
        ("", "name", None, "missing"),
        ("wide", "n", "99999999999", "not a value of type int"),
        ("blank", "n", " 7", "not a value of type int"),
    }


def test_rejected_fields_are_null_in_the_table(spark, path):
    table = {r.name: r for r in read_positional_csv(spark, path, SCHEMA, ("name", "NAME")).collect()}
    checked = check_positional_csv(spark, path, SCHEMA, ("name", "NAME"))
    typed = [r for r in checked.rejected.collect() if r.reason.startswith("not a value")]
    assert typed and all(table[r.line.split(",")[0]][r.field] is None for r in typed)
    assert all(table[r.name] == r for r in checked.rows.collect())


def test_plan_is_one_pass(spark, path):
    plan = check_positional_csv(spark, path, SCHEMA, ("name", "NAME")).rejected._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("FileScan") == 1


def offer(**change):
    names = [part.split()[0] for part in OFFER_CONTROL.replace("\n", " ").split(",")]
    base = dict.fromkeys(names, "1") | {"offer": "mgm", "start_year": "2017", "end_year": "2017"}
    return ",".join((base | change).get(n, "") for n in names)


def test_days_and_thresholds_of_offers(spark, tmp_path):
    (tmp_path / "offers.csv").write_text(
        "\n".join([offer(), offer(offer="feb", end_month="2", end_day="30"), offer(offer="part", start_day=""), offer(offer="cost", max_cps="low")])
        + "\n"
        + offer(offer="none", start_year="", start_month="", start_day="", min_ctr="")
        + "\n"
    )
    path, table, rejected = str(tmp_path / "offers.csv"), str(tmp_path / "table"), str(tmp_path / "rejected")
    found = check_offer_control(spark, path, offer_checks()).rejected
    assert rows(found.select("field", "value", "reason")) == sorted(
        [("end_date", "2017-2-30", "no such day"), ("start_date", "2017-1-", "no such day"), ("max_cps", "low", "not a number")], key=repr
    )
    jobs.upload_offer_control(spark, path, table, rejected=rejected)
    assert spark.read.parquet(table).count() == 5 and spark.read.parquet(rejected).count() == 3
    assert spark.read.parquet(table).where("offer = 'feb' and end_date is null").count() == 1
    jobs.upload_offer_control(spark, path, table, strict=True)
    assert {r.offer for r in spark.read.parquet(table).collect()} == {"mgm", "none"}
    assert read_offer_control(spark, path).count() == 5


def test_a_file_without_lines(spark, tmp_path):
    (tmp_path / "none.csv").write_text("")
    checked = check_offer_control(spark, str(tmp_path / "none.csv"), offer_checks())
    assert checked.rows.count() == 0 and checked.rejected.count() == 0
