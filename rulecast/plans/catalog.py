"""Device catalogue: names seen in id syncs, matched to known device properties."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from rulecast.functions.device_names import catalog_name
from rulecast.functions.platform import fix_platform, platform_class
from rulecast.functions.text import contains_any, first_match
from rulecast.operators.nested import any_map_has_key
from rulecast.operators.prefixes import best_prefix_rank
from rulecast.operators.skew import salted_join
from rulecast.sources.readers import in_months

# Partners whose id syncs count.
PARTNERS = (2177, 2243, 2248)

# Price of devices without one, by a mark in their name; the first mark wins.
PRICE_MARKS = (
    ("80", ("iris", "lava", "smart", "true", "dtac", "joey", "blade", "eagle")),
    ("130", ("i-mobile", "i-style")),
    ("340", ("vivo",)),
    ("125", ("asus",)),
    ("470", ("htc",)),
    ("270", ("lg",)),
    ("300", ("huawei",)),
    ("370", ("sm-", "gt-")),
    ("400", ("x9009",)),
    ("130", ("wiko",)),
)

# Devices whose own name is their commercial name, with their release.
OWN_NAMES = {"lenny": ("2014", "August"), "lenny2": ("2015", "September")}

# Devices the catalogue lacks.
EXTRA_COLUMNS = (
    "dvc_techname_raw", "popularity", "dvc_techname", "brand", "dvc_commercname",
    "release_year", "release_month", "release_price", "screensize", "cluster",
)
EXTRA_DEVICES = (
    ("iphone os 5", 0.0, "iphone os 5", "apple", "iphone os 5", "2011", "September", "750", "3.5", 11),
    ("iphone os 6", 0.0, "iphone os 6", "apple", "iphone os 6", "2012", "September", "750", "4", 11),
    ("iphone os 7", 0.0, "iphone os 7", "apple", "iphone os 7", "2013", "September", "750", "4", 11),
    ("iphone os 8", 0.0, "iphone os 8", "apple", "iphone os 8", "2014", "September", "750", "4.7", 11),
    ("iphone os 9", 0.0, "iphone os 9", "apple", "iphone os 9", "2015", "September", "750", "5", 11),
    ("iphone os 10", 0.0, "iphone os 10", "apple", "iphone os 10", "2016", "September", "750", "5", 11),
    ("asust00j", 0.0, "asust00j", "asus", "zenfone 5", "2014", "April", "130", "5", 13),
    ("asusz00ad", 0.0, "asusz00ad", "asus", "zenfone 2", "2015", "March", "370", "5.5", 13),
    ("asusz010d", 0.0, "asusz010d", "asus", "zenfone max", "2016", "January", "170", "5.5", 13),
    ("asusz00ld", 0.0, "asusz00ld", "asus", "zenfone 2 laser", "2015", "September", "220", "5.5", 13),
    ("asusx013d", 0.0, "asusx013d", "asus", "zenfone go", "2016", "May", "null", "5.5", 13),
)


def device_catalog(
    id_syncs: DataFrame,
    id_type: str,
    first_month: tuple[int, int],
    last_month: tuple[int, int],
    partners=PARTNERS,
) -> DataFrame:
    """Distinct device names and platforms of id syncs that hold an id of the given type.

    User agents are made distinct before they are turned into names.
    """
    raw, agent = F.col("header.platform"), F.col("header.user_agent")
    seen = (
        id_syncs.where(
            in_months(first_month, last_month)
            & F.col("partner_id").isin(*partners)
            & any_map_has_key("header.incoming_ids", "sightings_by_id_type", id_type)
        )
        .groupBy(
            fix_platform(raw, agent).alias("platform"),
            platform_class(raw).alias("raw_class"),
            agent.alias("user_agent"),
        )
        # Reading the count keeps this step; a bare DISTINCT would be merged into the one below.
        .agg(F.count("*").alias("seen"))
        .where("seen > 0")
    )
    name = catalog_name(F.col("platform"), F.col("raw_class"), F.col("user_agent"))
    return seen.select(name.alias("dvc_techname"), "platform").distinct()


def match_catalog(names: DataFrame, atlas: DataFrame) -> DataFrame:
    """The best popularity rank among the atlas names each device name starts with."""
    matched = best_prefix_rank(names, atlas, "dvc_techname", "dvc_techname", "popularity")
    return matched.withColumnRenamed("dvc_techname", "dvc_techname_raw")


def attach_by_rank(matched: DataFrame, atlas: DataFrame) -> DataFrame:
    """All atlas rows of the winning rank; names without a rank keep one row of NULLs.

    Names without a rank would all meet in one partition; the salt spreads them.
    """
    properties = atlas.select(
        "popularity", "dvc_techname", "brand", "dvc_commercname", "release_year", "release_month",
        "release_price", "screensize", "cluster",
    )
    return salted_join(matched, properties, ["popularity"], F.col("dvc_techname_raw"), "left")


def impute_price(name, price):
    """A missing price by the first mark found in the device name."""
    rules = [(contains_any(name, marks), F.lit(value)) for value, marks in PRICE_MARKS]
    return F.coalesce(price, first_match(rules))


def extra_devices(spark: SparkSession) -> DataFrame:
    kinds = {"popularity": "double", "cluster": "int"}
    schema = ", ".join(f"{c} {kinds.get(c, 'string')}" for c in EXTRA_COLUMNS)
    return spark.createDataFrame(list(EXTRA_DEVICES), schema)


def device_properties(matched: DataFrame, atlas: DataFrame, with_extra: bool = True) -> DataFrame:
    """Properties per device name, with the hand-kept corrections and additions."""
    raw = F.col("dvc_techname_raw")

    def owned(column: str, values):
        return first_match([(raw == n, F.lit(v)) for n, v in values.items()], F.col(column))

    own = {name: name for name in OWN_NAMES}
    found = attach_by_rank(matched, atlas).select(
        raw,
        F.col("popularity").cast("double").alias("popularity"),
        F.coalesce(owned("dvc_techname", own), raw).alias("dvc_techname"),
        "brand",
        F.coalesce(owned("dvc_commercname", own), raw).alias("dvc_commercname"),
        owned("release_year", {n: y for n, (y, _) in OWN_NAMES.items()}).alias("release_year"),
        owned("release_month", {n: m for n, (_, m) in OWN_NAMES.items()}).alias("release_month"),
        impute_price(raw, F.col("release_price")).alias("release_price"),
        F.col("screensize").cast("string").alias("screensize"),
        F.col("cluster").cast("int").alias("cluster"),
    )
    if not with_extra:
        return found
    return found.unionByName(extra_devices(matched.sparkSession))
