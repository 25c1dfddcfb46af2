import pytest
from pyspark.sql import functions as F

from rulecast.functions.device_names import catalog_name, device_name
from rulecast.functions.platform import fix_platform, platform_class

MOZ = "Mozilla/5.0 "
FEEDBACK_CASES = [
    ("COMPUTER", MOZ + "(Windows NT 6.1)", "COMPUTER"),
    ("IPAD", MOZ + "(iPad; CPU OS 9_3 like Mac OS X)", "IPAD"),
    ("iPhone", MOZ + "(iPhone; CPU iPhone OS 9_3_2 like Mac OS X)", "iPhone"),
    ("IPHONE", MOZ + "(iPhone; CPU iPhone OS 9_3_2 like Mac OS X)", "iphone os 9"),
    ("IPHONE", MOZ + "(iPhone; CPU iPhone OS 10 like Mac OS X)", "iphone os 10 "),
    ("IPHONE", MOZ + "(iPhone; U; CPU iPhone OS 4_1 like Mac OS X; en-us)", "iphone os 4"),
    ("IPHONE", MOZ + "(iPhone; CPU OS 8_1 like Mac OS X)", "os 8"),
    ("ANDROID", MOZ + "(iPhone; CPU OS 8_1 like Mac OS X)", "mozilla"),
    ("IPHONE", MOZ + "(iPod touch; CPU iPhone OS 7_0 like Mac OS X)", "ipod"),
    ("IPHONE", MOZ + "(null) [FBAN/FBIOS;FBDV/iPhone7,2;FBMD/iPhone]", "iphone7"),
    ("IPHONE", MOZ + "(null) [FBAN/FBIOS;FBDV/iPhone]", ""),
    ("ANDROID", MOZ + "(Android; Mobile; rv:40.0) Gecko", "unidentified android"),
    ("ANDROID", MOZ + "(Android; Tablet; rv:40.0) Gecko", "unidentified tablet"),
    ("ANDROID", "x mobile rv[0-9][0-9].[0-9] gecko", "unidentified android"),
    ("ANDROID", MOZ + "(Linux; Android 5.1.1; SM-J700F Build/LMY47X) AppleWebKit", "sm-j700f"),
    ("ANDROID", MOZ + "(Linux; Android 6.0; A1601 Build/MRA58K) AppleWebKit", "a1601"),
    ("ANDROID", MOZ + "(Linux; Android 7; XT_10 Build/N) AppleWebKit", "xt10"),
    ("ANDROID", MOZ + "(Linux; U; Android 4.4.2; th-th; SAMSUNG GT-I9500/V1 Linux/3.4)", "gt-i9500"),
    ("ANDROID", MOZ + "(Linux; U; Android 4.4.2; fr-fr; GT-I9500 Build/K)", "fr-fr gt-i9500"),
    ("ANDROID", MOZ + "(Linux; Android 5.0; Lenovo A7000-a Build/LRX)", "a7000-a"),
    ("ANDROID", MOZ + "(Linux; Android 5.0; i-STYLE 7.7 DTV Build/LRX)", "i-style 7.7 dtv"),
    ("ANDROID", MOZ + "(Linux; Android 5.0; I_STYLE 7 Build/LRX)", ""),
    ("ANDROID", MOZ + "(Linux; Android 4.2; vivo X3 dual sim Build/K)", "vivo x3"),
    ("ANDROID", MOZ + "(Linux; Android 5.0; X9) AppleWebKit/537 Chrome", "x9"),
    ("WINDOWS_PHONE", MOZ + "(Windows Phone 8.0; Trident/6.0; NOKIA; Lumia 920)", "lumia 920"),
    ("iphone", MOZ + "(Windows Phone 8.1; ARM; Microsoft; Lumia 640) like iPhone OS", "lumia 640"),
    (None, MOZ + "(Linux; Android 6.0; A1601 Build/M)", "a1601"),
    ("ANDROID", None, None),
    ("COMPUTER", None, "COMPUTER"),
]

CATALOG_CASES = [
    ("COMPUTER", MOZ + "(Windows NT 6.1)", "computer"),
    (None, MOZ + "(X11)", None),
    ("ANDROID", "IRIS405", "iris405"),
    ("ANDROID", MOZ + "(Linux; Android 5.1.1; SM_J700F Build/LMY47X)", "sm_j700f"),
    ("ANDROID", MOZ + "(Linux; U; Android 4.4.2; fr-fr; GT-I9500 Build/K)", "gt-i9500"),
    ("ANDROID", MOZ + "(Linux; Android 5.0; X9) AppleWebKit/537 Chrome", "x9"),
    ("ANDROID", MOZ + "(Linux; Android 5.0; x30dual Build/L)", "x30"),
    ("ANDROID", MOZ + "(Linux; Android 5.0; lava dual5 Build/L)", ""),
    ("ANDROID", MOZ + "(Linux; Android 5.0; X5 by Acme Build/L)", "x5"),
    ("ANDROID", MOZ + "(Linux; Android 5.0; ab-1 Z9 Build/L)", "z9"),
    ("IPHONE", MOZ + "(iPhone; CPU iPhone OS 9_3_2 like Mac OS X)", "9"),
    ("WINDOWS_PHONE", MOZ + "(Windows Phone 8.0; NOKIA; Lumia 920)", "920"),
]


def named(spark, cases, build):
    rows = spark.createDataFrame(
        [(i, p, a) for i, (p, a, _) in enumerate(cases)], "i int, platform string, agent string"
    )
    fixed = fix_platform(F.col("platform"), F.col("agent"))
    named = rows.select("i", build(fixed, F.col("agent")).alias("name"))
    return [r.name for r in named.orderBy("i").collect()]


def test_feedback_names(spark):
    assert named(spark, FEEDBACK_CASES, device_name) == [c[2] for c in FEEDBACK_CASES]


def test_catalog_names(spark):
    names = named(
        spark,
        CATALOG_CASES,
        lambda fixed, agent: catalog_name(fixed, platform_class(F.col("platform")), agent),
    )
    assert names == [c[2] for c in CATALOG_CASES]


@pytest.mark.parametrize(
    "platform, expected",
    [("ANDROID", "ANDROID"), ("FEATURE_PHONE", "ANDROID"), ("IPHONE", "IPHONE"),
     ("iphone", "PC_OTHERS"), ("IPAD", "PC_OTHERS"), (None, "PC_OTHERS")],
)
def test_platform_class(spark, platform, expected):
    row = spark.createDataFrame([(platform,)], "p string").select(platform_class(F.col("p")))
    assert row.first()[0] == expected
