import datetime as dt

import pytest

from rulecast.plans import jobs
from rulecast.plans.audience import (
    audience_competitors,
    audience_not_recent,
    audience_recent_own,
    cluster_reach,
    model_reach,
)
from rulecast.plans.clusters import (
    cluster_brand,
    cluster_model_list,
    cluster_rules,
    shape_device_clusters,
)
from rulecast.sources.readers import read_device_clusters
from frames import rows


@pytest.mark.parametrize(
    "model, vendor, cluster, label",
    [
        ("SM-J700F", "samsung", 1.0, "1_SS"), ("A1601", "oppo", 1.0, "1_OTH"),
        ("SM-J200GU", "samsung", 2.0, "2_SS"), ("Smart 4G Speedy 4.0", "true", 2.0, "2_OEM"),
        ("X", "oppo", 2.0, "2_OTH"), ("GT-I8552", "samsung", 3.0, "3"),
        ("GT-N7100", "samsung", 4.0, "4"), ("SM-N920C", "samsung", 5.0, "5"),
        ("n1", None, 1.0, "1"), ("n2", None, 2.0, "2_OTH"), ("h", "oppo", 6.5, "6.5"), ("u", "oppo", None, None),
    ],
)
def test_cluster_labels(spark, model, vendor, cluster, label):
    df = spark.createDataFrame([(model, vendor, cluster)], "model string, vendor string, cluster double")
    assert cluster_brand(df).first().cluster_brand == label


def test_cluster_file_to_rules(spark, tmp_path):
    title = "MODEL,REACH,MARKETING_NAME,VENDOR,P,Y,M,T,D,C,H,W,A,K"
    tail = "250,2015,6,2015.5,5.5,13,1280,720,1.6"
    (tmp_path / "c.csv").write_text(
        f"{title}\nSM-J700F,9,galaxy,samsung,{tail},1\nB2 ,8,b,oppo,{tail},1\nA1601,7,f1s,oppo,{tail},1\n"
        f"C3,1,c,oppo,{tail},3\nD4,1,d,,{tail},3\n"
    )
    clusters = shape_device_clusters(read_device_clusters(spark, str(tmp_path)))
    assert len(clusters.columns) == 13 and "reach" not in clusters.columns
    labelled = cluster_brand(clusters)
    assert rows(cluster_rules(labelled)) == [
        ("1_OTH", 'userAgent(".*(?i)(a1601|b2).*")'),
        ("1_SS", 'userAgent(".*(?i)(sm-j700f).*")'),
        ("3", 'userAgent(".*(?i)(c3).*")'),
    ]
    assert dict(rows(cluster_model_list(labelled)))["1_OTH"] == "A1601,B2 "


DATASET = """device_id string, model string, vendor string, user_agent string, id_type string,
event_source string, carrier string, year int, month int, day int"""
AD, IDFA = "HARDWARE_ANDROID_AD_ID", "HARDWARE_IDFA"


def seen(i, carrier, agent="sm-j700f", day="2017-01-20", kind=AD, source="app", model="m", vendor="v"):
    d = dt.date.fromisoformat(day)
    return (i, model, vendor, agent, kind, source, carrier, d.year, d.month, d.day)


def dataset(spark, *items):
    return spark.createDataFrame(list(items), DATASET)


WINDOW = ("2017-01-16", "2017-02-28")


def test_audience_lists(spark):
    df = dataset(
        spark, seen("a", "T"), seen("a", "T"), seen("a", "OWN"), seen("b", "A", day="2015-01-01"),
        seen("b", "OWN", day="2017-01-15"), seen("c", "A", kind="COOKIE"), seen("c", "OWN", kind="COOKIE"),
        seen(None, "T"), seen("e", "Z"), seen("f", None),
    )
    others = audience_competitors(df, ["T", "A"])
    assert rows(others) == sorted(
        [("a", "m", AD, "app"), ("b", "m", AD, "app"), ("c", "m", "COOKIE", "app"), (None, "m", AD, "app")],
        key=repr,
    )
    own = audience_recent_own(df, ["OWN"], WINDOW)
    assert rows(own) == [("a",)]
    assert {r[0] for r in rows(audience_not_recent(others, own))} == {"b", "c", None}


def test_audience_job(spark, tmp_path):
    source, out = str(tmp_path / "seen"), str(tmp_path / "audience")
    dataset(spark, seen("a", "T"), seen("a", "OWN"), seen("b", "T"), seen("b", "T")).write.parquet(source)
    jobs.build_audience(spark, source, out, ["OWN"], ["T", "A"], WINDOW)
    assert rows(spark.read.parquet(out)) == [("b", "m", AD, "app")]


def test_reach_excludes_own_ids_of_the_same_cluster_only(spark):
    df = dataset(
        spark,
        seen("a", "T", "SM-J700F x"), seen("a", "OWN", "gt-9"),          # own, but another cluster
        seen("b", "T", "sm-j700f"), seen("b", "OWN", "sm-j700f"),         # own, same cluster
        seen("c", "T", "sm-j700f"), seen("c", "OWN", "sm-j700f", "2017-01-15"),  # own too early
        seen("d", "A", "sm-j700f and gt-9"), seen("d", "A", "sm-j700f"),  # two clusters, one id
        seen("e", "T", "sm-j700f", kind="COOKIE"), seen(None, "T", "sm-j700f"), seen("g", "T", None),
    )
    patterns = {"1": "(?i)(sm-j700f|sm-j5)", "2": "(?i)(gt-9)", "3": "(?i)(nothing)"}
    for materialized in (True, False):
        got = cluster_reach(df, patterns, ["OWN"], ["T", "A"], WINDOW, materialized=materialized)
        assert rows(got) == [("1", 3), ("2", 1)]
    windowed = cluster_reach(df, patterns, ["OWN"], ["T", "A"], WINDOW, other_window=("2016-01-01", "2016-12-31"))
    assert rows(windowed) == []


def test_reach_patterns_are_regular_expressions_unless_literal(spark):
    df = dataset(spark, seen("a", "T", "FE171CG K01N"), seen("b", "T", "fe171cg (k01n)"), seen("c", "T", "405++"))
    tokens = "fe171cg (k01n)|405+"
    as_regex = cluster_reach(df, {"0": f"(?i)({tokens})"}, ["OWN"], ["T"], WINDOW)
    assert rows(as_regex) == [("0", 2)]  # a and c
    literal = cluster_reach(df, {"0": tokens}, ["OWN"], ["T"], WINDOW, literal=True)
    assert rows(literal) == [("0", 2)]  # b and c


def test_model_reach_is_ordered(spark):
    df = dataset(
        spark, *(seen(i, "T", "x1", kind=IDFA, vendor="Apple", model="iPhone 6") for i in "abca"),
        *(seen(i, "T", "x2", kind=IDFA, vendor="Apple", model="iPhone 5") for i in "abcd"),
        seen("a", "T", "x1", kind=AD, vendor="Apple"), seen("a", "T", "x1", "2016-01-01", IDFA, vendor="Apple"),
    )
    got = model_reach(df, IDFA, "Apple", "app", 2017).collect()
    assert [tuple(r) for r in got] == [("iPhone 5", "x2", 4), ("iPhone 6", "x1", 3)]
