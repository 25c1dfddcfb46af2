from rulecast.plans.catalog import device_catalog, device_properties, match_catalog
from frames import ANDROID_UA, rows

SYNCS = """header struct<platform: string, user_agent: string,
  incoming_ids: array<struct<sightings_by_id_type: map<string, int>>>>,
partner_id bigint, year int, month int"""

ATLAS = """dvc_techname string, popularity int, brand string, dvc_commercname string,
release_year string, release_month string, release_price string, screensize string, cluster int"""


def sync(agent, platform="ANDROID", ids=({"COOKIE": 1},), partner=2177, month=(2016, 11)):
    return ((platform, agent, [(m,) for m in ids]), partner, *month)


def test_device_catalog_filters_and_dedups(spark):
    android = ANDROID_UA.format("SM-J700F")
    df = spark.createDataFrame(
        [
            sync(android), sync(android, ids=({"OTHER": 1}, {"COOKIE": 2})), sync(android + "/2"),
            sync(ANDROID_UA.format("other"), ids=({"OTHER": 1},)),
            sync(ANDROID_UA.format("none"), ids=()),
            sync(ANDROID_UA.format("partner"), partner=1),
            sync(ANDROID_UA.format("early"), month=(2016, 9)),
            sync(ANDROID_UA.format("late"), month=(2017, 1)),
            sync("Mozilla/5.0 (Windows NT)", platform="COMPUTER"),
            sync("Mozilla (iPhone; Windows Phone 8; NOKIA; Lumia 9)", platform="iphone"),
        ],
        SYNCS,
    )
    assert rows(device_catalog(df, "COOKIE", (2016, 10), (2016, 12))) == [
        ("computer", "COMPUTER"), ("sm-j700f", "ANDROID"), ("windows_phone", "WINDOWS_PHONE"),
    ]


def atlas(spark, *items):
    full = [(n, p, "b", c, "2015", "May", price, "5", 3) for n, p, c, price in items]
    return spark.createDataFrame(full, ATLAS)


def names(spark, *items):
    return spark.createDataFrame([(n,) for n in items], "dvc_techname string")


def test_match_takes_the_best_rank(spark):
    table = atlas(spark, ("sm-j700", 5, None, None), ("sm-j", 9, None, None), ("sm-j700f", 7, None, None), ("sm_g", 1, None, None))
    got = rows(match_catalog(names(spark, "sm-j700f", "sm-j1", "sm-g5", "htc", "htc", None), table))
    assert got == sorted([("sm-j700f", 5), ("sm-j1", 9), ("sm-g5", 1), ("htc", None), (None, None)], key=repr)


def test_properties_overrides_and_prices(spark):
    table = atlas(spark, ("lenny", 1, "wiko lenny", "99"), ("vivo", 2, None, None), ("x", 3, "ex", "null"))
    matched = match_catalog(
        names(spark, "lenny", "lenny2", "vivo x", "lg smart", "lg 5", "zzz", "xa"), table
    )
    got = {r.dvc_techname_raw: r for r in device_properties(matched, table, with_extra=False).collect()}
    assert len(got) == 7
    assert (got["lenny"].dvc_techname, got["lenny"].dvc_commercname, got["lenny"].release_year,
            got["lenny"].release_month, got["lenny"].release_price) == ("lenny", "lenny", "2014", "August", "99")
    assert got["lenny2"].release_year == "2015" and got["lenny2"].release_month == "September"
    assert (got["vivo x"].dvc_techname, got["vivo x"].dvc_commercname) == ("vivo", "vivo x")
    assert got["vivo x"].release_price == "340"
    assert got["lg smart"].release_price == "80" and got["lg 5"].release_price == "270"
    assert got["zzz"].release_price is None and got["zzz"].dvc_techname == "zzz"
    assert got["xa"].release_price == "null" and got["xa"].popularity == 3.0


def test_equal_ranks_give_every_atlas_row(spark):
    table = atlas(spark, ("ab", 4, "one", "1"), ("cd", 4, "two", "2"))
    found = device_properties(match_catalog(names(spark, "abx"), table), table, with_extra=False)
    assert sorted(r.dvc_commercname for r in found.collect()) == ["one", "two"]


def test_extra_devices(spark):
    table = atlas(spark, ("ab", 4, "one", "1"))
    found = device_properties(match_catalog(names(spark, "abx"), table), table)
    extra = {r.dvc_techname_raw: r for r in found.collect() if r.popularity == 0}
    assert len(extra) == 11 and extra["asusx013d"].release_price == "null"
    assert extra["iphone os 10"].cluster == 11 and extra["asusz00ad"].release_price == "370"
