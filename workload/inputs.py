"""The jobs' inputs, derived from the driver tables.

Each input is one SELECT in the SQL that Spark and DuckDB share, so both start from the same rows.
Nested inputs are then built from flat columns: Spark gets real arrays, structs and maps, the SQL
side multiplies rows by the counts those arrays were built from.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

# A device name per part: marks of brands, a few names with a meaning of their own.
DEVICE = """
case when p.p_partkey % 101 = 7 then 'COMPUTER'
     when p.p_partkey % 103 = 8 then 'IPAD'
     when p.p_partkey % 53 = 9 then 'iphone os ' || cast(6 + p.p_size % 5 as string)
     when p.p_partkey % 107 = 10 then null
     when p.p_partkey % 211 = 11 then 'vivo'
     when p.p_partkey % 197 = 12 then 'lenny'
     when p.p_partkey % 199 = 13 then 'th--1 ' || p.p_name || ' dual sim'
     when p.p_partkey % 89 = 20 then 'www.shop.com' || replace(p.p_name, ' ', '-')
     when p.p_partkey % 89 = 21 then 'sprd-' || replace(p.p_name, ' ', '_')
     when p.p_partkey % 89 = 22 then 'th-1 ' || p.p_name
     when p.p_partkey % 89 = 23 then replace(p.p_name, ' ', '_') || ' opera mini'
     when p.p_partkey % 89 = 24 then replace(p.p_name, ' ', '_') || '-orange th'
     else case p.p_partkey % 12
              when 0 then 'iris' when 1 then 'i-mobile ' when 2 then 'vivo ' when 3 then 'asus_'
              when 4 then 'htc ' when 5 then 'lg-' when 6 then 'huawei ' when 7 then 'sm-'
              when 8 then 'x9009' when 9 then 'wiko ' else '' end
          || replace(p.p_name, ' ', '-') || cast(p.p_partkey % 5000 as string)
end"""

AGENT = """
case (e.user_id + e.k) % 13
  when 4 then 'Mozilla/5.0 (Linux; U; Android 4.4.2; th-th; SAMSUNG ' || e.model || '/V1 Linux/3.4) AppleWebKit/534.30'
  when 5 then 'Mozilla/5.0 (iPhone; CPU iPhone OS ' || cast(7 + e.user_id % 4 as string) || '_1_2 like Mac OS X) AppleWebKit/600.1.4'
  when 6 then 'Mozilla/5.0 (iPod touch; CPU iPhone OS 7_0 like Mac OS X)'
  when 7 then 'Mozilla/5.0 (compatible; MSIE 10.0; Windows Phone 8.0; ARM; Touch; NOKIA; Lumia ' || cast(e.user_id % 10 as string) || '20)'
  when 8 then 'Mozilla/5.0 (iPhone) (null) [FBAN/FBIOS;FBAV/6.0;FBDV/iPhone6,' || cast(e.user_id % 3 as string) || ']'
  when 9 then 'Mozilla/5.0 (Android; Mobile; rv:40.0) Gecko/40.0'
  when 10 then 'Mozilla/5.0 (Android; Tablet; rv:38.0) Gecko/38.0'
  when 11 then null
  when 12 then 'iris405'
  else 'Mozilla/5.0 (Linux; Android 5.1.1; SM-' || e.model || ' Build/LMY47V) AppleWebKit/537.36 Mobile'
end"""

PLATFORM = """
case e.user_id % 9
  when 0 then 'ANDROID' when 1 then 'IPHONE' when 2 then 'COMPUTER' when 3 then 'IPAD'
  when 4 then 'WINDOWS_PHONE' when 5 then 'ANDROID_TABLET' when 6 then 'iPhone'
  when 7 then 'FEATURE_PHONE' end"""

# One row per event with the handset of its user (the part with the user's number).
HANDSETS = """
select e.event_id, e.ts, e.user_id, e.event_type, e.value,
       cast(regexp_extract(e.props, '[0-9]+', 0) as int) as k,
       coalesce(replace(p.p_name, ' ', '_'), 'plain') || cast(e.user_id % 50 as string) as model,
       coalesce(p.p_name, 'plain') as name, coalesce(p.p_brand, 'none') as brand
from {events} e left join {part} p on p.p_partkey = e.user_id"""

FLAT_TAPS = f"""
select e.ts, {PLATFORM} as platform, {AGENT} as user_agent,
       e.k % 4 as n_ids, e.k % 3 as n_cat, 1 + e.k % 2 as n_ref,
       case e.event_type when 'view' then 'impression' else e.event_type end as action_id,
       case e.event_id % 7 when 0 then 191243 when 1 then 199183 when 2 then 241982
            when 3 then 238642 when 4 then 226384 when 5 then 1 else 217118 end as tactic_id,
       case e.event_id % 4 when 0 then 5413 when 1 then 9999 else 5138 end as campaign_id,
       year(e.ts) as year, month(e.ts) as month, day(e.ts) as day
from ({HANDSETS}) e"""

FLAT_EVENTS = f"""
select e.ts, {PLATFORM} as platform, {AGENT} as user_agent, e.k % 4 as n_ids,
       case e.event_type when 'signup' then 'undefined' when 'purchase' then 'form-submit'
            else e.event_type end as action_id,
       case when e.event_id % 10 = 9 then '1' else '2868' end as property_id,
       case e.event_id % 8
         when 0 then 'http://www.kaidee.com/specialoffer/booster.html?x=' || cast(e.k as string)
         when 1 then 'http://www.kaidee.com/specialoffer/mnp-huawei-p9-lite.html'
         when 2 then 'https://m.facebook.com/specialoffer/Sim-Nice-Number-v2.html'
         when 3 then 'https://pantip.com/specialoffer/special-package.html'
         when 4 then 'http://kaidee.com/specialoffer/MGM-lite.html'
         when 5 then 'http://kaidee.com/specialoffer/mnp-free-device'
         when 6 then null
         else 'http://example.org/other/page.html' end as referrer_url,
       year(e.ts) as year, month(e.ts) as month, day(e.ts) as day
from ({HANDSETS}) e"""

FLAT_SYNCS = f"""
select {PLATFORM} as platform, {AGENT} as user_agent, e.k % 4 as n_ids, e.k % 3 as kind,
       case e.event_id % 5 when 0 then 2177 when 1 then 2243 when 2 then 2248 else 1 end as partner_id,
       year(e.ts) as year, month(e.ts) as month
from ({HANDSETS}) e"""

SIGHTINGS = f"""
select case when e.event_id % 97 = 5 then null else e.user_id end as device_id,
       e.name as model, e.brand as vendor, {AGENT} as user_agent,
       case e.event_id % 3 when 0 then 'HARDWARE_ANDROID_AD_ID' when 1 then 'HARDWARE_IDFA'
            else 'COOKIE' end as id_type,
       e.event_type as event_source,
       case when e.user_id % 4 = 0 and e.k % 2 = 0 then 'OWN'
            when e.k % 10 = 3 then null
            else 'OTHER-' || cast(e.k % 4 as string) end as carrier,
       year(e.ts) as year, month(e.ts) as month, day(e.ts) as day
from ({HANDSETS}) e"""

OFFERS_RAW = """
select 'offer-' || cast(case when s.s_suppkey % 40 = 39 then s.s_suppkey - 1 else s.s_suppkey end as string) as offer,
       cast(case when s.s_suppkey % 13 = 12 then null else floor(s.s_suppkey / 2) end as int) as uc1_priority,
       cast(case s.s_suppkey % 4 when 3 then null when 2 then 0 else 1 end as int) as active_flg_kd,
       cast(case s.s_suppkey % 5 when 4 then null when 3 then 0 else 1 end as int) as active_flg_fb,
       cast(case s.s_suppkey % 3 when 2 then null when 1 then 0 else 1 end as int) as active_flg_pt,
       cast(4 + s.s_suppkey % 3 as double) as screen_size,
       cast(4990 + s.s_suppkey as int) as rrp, cast(s.s_suppkey * 10 as int) as apollo_price,
       cast(599 as int) as min_pack,
       cast(2016 + s.s_suppkey % 2 as string) as start_year,
       cast(1 + s.s_suppkey % 3 as string) as start_month,
       cast(1 + s.s_suppkey % 28 as string) as start_day,
       '2017' as end_year, cast(1 + s.s_suppkey % 12 as string) as end_month,
       case when s.s_suppkey % 29 = 28 then null else cast(1 + s.s_suppkey % 27 as string) end as end_day,
       cast(case when s.s_suppkey % 17 = 16 then null else 2000 + (s.s_suppkey % 40) * 500 end as int) as target_rlp_min,
       cast(case when s.s_suppkey % 19 = 18 then null else 3500 + (s.s_suppkey % 40) * 500 end as int) as target_rlp_max,
       case when s.s_suppkey % 23 = 22 then 'n/a' else '0.005' end as min_ctr,
       cast(1 + s.s_suppkey % 9 as string) as min_landings,
       case when s.s_suppkey % 6 = 4 then '5' else cast(1 + s.s_suppkey % 4 as string) end as min_submits,
       '0.05' as min_s2l,
       case when s.s_suppkey % 3 = 0 then '0.2' else '30' end as max_cps
from {supplier} s"""

_FAULTY = {
    "rrp": "case when apollo_price % 110 = 50 then 'n/a' when apollo_price % 130 = 20 then '4,990' else cast(rrp as string) end",
    "end_month": "case when apollo_price % 90 = 10 then '13' else end_month end",
    "end_day": "coalesce(end_day, '1')",
}
_TYPED = """uc1_priority active_flg_kd active_flg_fb active_flg_pt screen_size rrp apollo_price min_pack start_year start_month
start_day end_year end_month end_day target_rlp_min target_rlp_max min_ctr min_landings min_submits min_s2l max_cps""".split()
FAULTY_OFFERS = f"""
select offer, {", ".join(f"{_FAULTY.get(c, f'cast({c} as string)')} as {c}" for c in _TYPED)}
from ({OFFERS_RAW}) o"""

PROPERTIES = f"""
select {DEVICE} as dvc_techname,
       case when p.p_partkey % 401 = 5 then '1e300' when p.p_partkey % 401 = 6 then '-1e300'
            when p.p_partkey % 17 = 3 then 'null' when p.p_partkey % 19 = 4 then null
            else cast(40 + p.p_size * 10 + p.p_partkey % 7 as string) end as release_price
from {{part}} p"""

ATLAS = f"""
select case when p.p_partkey % 61 = 60 then '%-' || substr(p.p_name, 1, 3)
            when p.p_partkey % 37 = 36 then 'sm_' || substr(p.p_name, 1, 4)
            when p.p_partkey % 59 = 58 then '________________' || substr('____', 1, p.p_size % 4)
            else substr({DEVICE}, 1, 8 + p.p_size % 9) end as dvc_techname,
       p.p_partkey - cast(p.p_partkey % 50 = 1 as int) as popularity, p.p_brand as brand,
       case when p.p_partkey % 5 = 4 then null else p.p_type end as dvc_commercname,
       cast(2010 + p.p_size % 7 as string) as release_year, 'May' as release_month,
       case when p.p_partkey % 3 = 0 then null else cast(40 + p.p_size * 10 as string) end as release_price,
       cast(3 + p.p_size % 4 as string) as screensize, cast(p.p_size % 14 as int) as cluster
from {{part}} p"""

CLUSTERS = """
select 'M' || upper(substr(p.p_name, 1, 1)) || substr(p.p_name, 2, 20) || cast(p.p_partkey as string) || ' ' as model,
       p.p_name as marketing_name,
       case p.p_brand when 'Brand#1' then 'samsung' when 'Brand#2' then 'samsung'
            when 'Brand#3' then 'true' when 'Brand#4' then 'ais' when 'Brand#5' then null
            else 'oppo' end as vendor,
       cast(case when p.p_size = 50 then null when p.p_size = 49 then 6.5 else p.p_size % 8 end as double) as cluster
from {part} p"""

# Alternatives of ten clusters, 99 to 636 of them at 2,000 parts: models as user agents have them,
# with regular expressions among them, and numbers.
CLUSTER_TOKENS = """
select case when p.p_partkey % 200 < 63 then '0' when p.p_partkey % 200 < 91 then '1_SS'
            when p.p_partkey % 200 < 109 then '1_OTH' when p.p_partkey % 200 < 126 then '2_SS'
            when p.p_partkey % 200 < 142 then '2_OEM' when p.p_partkey % 200 < 156 then '3'
            when p.p_partkey % 200 < 168 then '4' when p.p_partkey % 200 < 179 then '5'
            when p.p_partkey % 200 < 190 then '6' else '7' end as cluster,
       case p.p_partkey % 7
         when 0 then 'SM-' || replace(p.p_name, ' ', '_') || cast(p.p_partkey % 50 as string)
         when 1 then replace(p.p_name, ' ', '.') || cast(p.p_partkey % 50 as string) || ' build'
         when 2 then replace(p.p_name, ' ', '(_)') || cast(p.p_partkey % 50 as string) || '/'
         when 3 then replace(p.p_name, ' ', '_+') || cast(p.p_partkey % 50 as string) || '+'
         when 4 then 'ia ' || cast(p.p_partkey % 1000 as string) || '20'
         when 5 then 'rm-' || cast(p.p_partkey as string)
         else replace(p.p_name, ' ', '_') || cast(p.p_partkey % 50 as string) end as token
from {part} p"""

FEEDBACK = f"""
select cast(l.l_shipdate as date) as sighted_date,
       case when l.l_orderkey % 50 = 49 then null else 'offer-' || cast(l.l_suppkey as string) end as offer,
       case l.l_returnflag when 'A' then 'kd' when 'R' then 'fb' else 'pt' end as source,
       'ANDROID' as hl_platform, {DEVICE} as dvc_techname,
       case when l.l_linenumber = 7 then null when l.l_quantity > 45 then 0
            else cast(l.l_quantity as bigint) * 20 end as imps,
       case when l.l_linenumber = 7 then null else cast(l.l_linenumber as bigint) - 1 end as clicks,
       case when l.l_linestatus = 'F' then null else cast(l.l_linenumber as bigint) * 2 end as landings,
       case when l.l_linestatus = 'F' then null else cast(l.l_quantity as bigint) % 5 end as submits
from {{lineitem}} l join {{part}} p on p.p_partkey = l.l_partkey"""

TABLES = ("events", "part", "supplier", "lineitem", "pages", "orders")


def derive(spark: SparkSession, sf_dir: str, query: str) -> DataFrame:
    """Run one of the shared SELECTs on the driver tables."""
    used = [t for t in TABLES if "{" + t + "}" in query]
    frames = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in used}
    return spark.sql(query, **frames)


def sql_for(query: str) -> str:
    """The same SELECT with the tables' own names."""
    return query.format(**{t: t for t in TABLES})


def _epoch_ms():
    days = F.unix_date(F.to_date("ts")).cast("bigint")
    seconds = days * 86400 + F.hour("ts") * 3600 + F.minute("ts") * 60 + F.second("ts").cast("int")
    return (seconds * 1000).alias("created_at")


def _pairs(key: str, count: str, other: str):
    def pair(k, v):
        return F.struct(F.lit(k).alias("key"), v.alias("value"))

    repeated = F.array_repeat(pair(key, F.col("user_agent")), F.col(count))
    return F.concat(repeated, F.array(pair(other, F.lit("x"))))


def _ids():
    one = F.struct(F.lit("id").alias("value"), F.lit(1).alias("kind"))
    return F.array_repeat(one, F.col("n_ids")).alias("incoming_ids")


def taps(spark: SparkSession, sf_dir: str) -> DataFrame:
    header = F.struct(
        _epoch_ms(),
        "platform",
        "user_agent",
        _ids(),
        _pairs("ext_cat", "n_cat", "page").alias("query_params"),
        _pairs("Referer", "n_ref", "Host").alias("http_headers"),
    )
    flat = derive(spark, sf_dir, FLAT_TAPS)
    return flat.select(
        header.alias("header"), "action_id", "tactic_id", "campaign_id", "year", "month", "day"
    )


def tracked_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    header = F.struct(_epoch_ms(), "platform", "user_agent", "referrer_url", _ids())
    flat = derive(spark, sf_dir, FLAT_EVENTS)
    return flat.select(header.alias("header"), "action_id", "property_id", "year", "month", "day")


def id_syncs(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.concat(F.lit("KIND_"), F.col("kind").cast("string"))
    seen = F.struct(F.create_map(kind, F.lit(1)).alias("sightings_by_id_type"))
    ids = F.array_repeat(seen, F.col("n_ids")).alias("incoming_ids")
    flat = derive(spark, sf_dir, FLAT_SYNCS)
    return flat.select(
        F.struct("platform", "user_agent", ids).alias("header"), "partner_id", "year", "month"
    )


def feedback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(spark, sf_dir, FEEDBACK)


def properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(spark, sf_dir, PROPERTIES)


def offers_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(spark, sf_dir, OFFERS_RAW)


def atlas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(spark, sf_dir, ATLAS)


def clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(spark, sf_dir, CLUSTERS)


def sightings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(spark, sf_dir, SIGHTINGS)
