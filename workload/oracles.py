"""The registered queries in plain SQL, written for clarity and run by DuckDB.

Fixed values (patterns, word lists, codes) come from the library; the logic is stated anew.
"""

from functools import reduce

from rulecast.functions import device_names as d
from rulecast.functions import offers as o
from rulecast.functions import platform as p
from rulecast.functions import text as t
from rulecast.plans import catalog as c
from rulecast.plans import rules as r
from workload import inputs
from workload.queries import ONE_DAY, OTHERS, OWN, PATTERNS, RECENT, RUN_DATE, WINDOWS


def q(value) -> str:
    return "'" + str(value).replace("'", "''") + "'"


def words(values) -> str:
    return ", ".join(q(v) for v in values)


def cut(expr: str, *patterns: str) -> str:
    return reduce(lambda e, x: f"regexp_replace({e}, {q(x)}, '', 'g')", patterns, expr)


def any_of(expr: str, marks) -> str:
    return "(" + " or ".join(f"contains({expr}, {q(m)})" for m in marks) + ")"


MOBILE = words([*p.ANDROID_CLASS, p.IPHONE])
FIXED = f"""case when lower(platform) = 'iphone' and {any_of('lower(user_agent)', p.WINDOWS_PHONE_MARKS)}
    then 'WINDOWS_PHONE' else platform end"""


def hl(platform: str) -> str:
    return f"""case when {platform} in ({words(p.ANDROID_CLASS)}) then 'ANDROID'
    when {platform} = 'IPHONE' then 'IPHONE' else 'PC_OTHERS' end"""


def android(agent: str, s: d.NameStyle) -> str:
    model = cut(agent, d.ANDROID_HEAD, s.build_tail, s.locale_head, d.PATH_TAIL)
    return cut(f"trim({model})", s.not_kept, d.VENDOR_HEAD, *s.last_tails)


A = "lower(user_agent)"
SHARED_NAMES = f"""
    when contains({A}, 'cpu iphone os') and contains({A}, 'ipod') and lower(platform) = 'iphone' then 'ipod'
    when contains({A}, 'cpu iphone os') or contains({A}, 'iphone; u; cpu iphone')
      or (contains({A}, 'iphone; cpu os') and lower(platform) = 'iphone') then {cut(A, *d.IOS_CUTS)}
    when contains({A}, '(null) [fban') and contains({A}, 'fbdv/iphone') and lower(platform) = 'iphone'
      then regexp_extract({cut(A, d.IN_APP_HEAD)}, {q(d.IN_APP_MODEL)}, 0)
    when {any_of(A, d.HIDDEN_PHONE_MARKS)} then 'unidentified android'
    when {any_of(A, d.HIDDEN_TABLET_MARKS)} then 'unidentified tablet'"""

FEEDBACK_NAME = f"""case when platform not in ({MOBILE}) then platform
    when platform = 'WINDOWS_PHONE' then trim({cut(A, *d.WINDOWS_PHONE_CUTS)})
    {SHARED_NAMES}
    else trim({android(A, d.FEEDBACK)}) end"""

CATALOG_NAME = "lower(trim(" + cut(
    f"""case when raw_class = 'PC_OTHERS' then platform {SHARED_NAMES}
    when {A} in ({words(d.BARE_MODELS)}) then {A} else {android(A, d.CATALOG)} end""",
    d.CATALOG_TAIL,
    d.CATALOG_HEAD,
) + "))"

TACTICS = " ".join(f"when {k} then {q(v)}" for k, v in o.TACTIC_OFFERS.items())
CAMPAIGNS = " ".join(f"when {k} then {q(v)}" for k, v in o.CAMPAIGN_SOURCES.items())
IDS = ", ".join(str(k) for k in o.CAMPAIGN_SOURCES)


def referrer_offer(url: str) -> str:
    marks = " ".join(f"when contains({url}, {q(m)}) then {q(v)}" for m, v in o.REFERRER_OFFERS)
    return f"case {marks} else lower({cut(url, *o.REFERRER_CUTS)}) end"


def referrer_source(url: str) -> str:
    marks = " ".join(f"when contains({url}, {q(m)}) then {q(v)}" for m, v in o.REFERRER_SOURCES)
    return f"case {marks} else 'oth' end"


TAPS = inputs.sql_for(inputs.FLAT_TAPS)
EVENTS = inputs.sql_for(inputs.FLAT_EVENTS)
SYNCS = inputs.sql_for(inputs.FLAT_SYNCS)
SIGHTINGS = inputs.sql_for(inputs.SIGHTINGS)
PROPERTIES = inputs.sql_for(inputs.PROPERTIES)
ATLAS = inputs.sql_for(inputs.ATLAS)
CLUSTERS = inputs.sql_for(inputs.CLUSTERS)

KEYS = "sighted_date, offer, source, hl_platform, dvc_techname, year, month, day"


def tap_side(source: str, unnest: bool) -> str:
    many = ", unnest(range(n_ids)) a(x), unnest(range(n_cat)) b(y), unnest(range(n_ref)) c(z)"
    once = "" if unnest else " and n_ids > 0 and n_cat > 0 and n_ref > 0"
    return f"""
select {KEYS}, cast(sum(case when action_id = 'impression' then 1 else 0 end) as bigint) as imps,
       cast(sum(case when action_id = 'click' then 1 else 0 end) as bigint) as clicks
from (select *, {hl('platform')} as hl_platform, {FEEDBACK_NAME} as dvc_techname
      from (select cast(ts as date) as sighted_date, case tactic_id {TACTICS} end as offer,
                   {source} as source, {FIXED} as platform, user_agent, action_id, year, month, day
            from ({TAPS}) raw{many if unnest else ''}
            where campaign_id in ({IDS}) and action_id in ('impression', 'click'){once}))
group by all"""


EVENT_SIDE = f"""
select {KEYS}, cast(sum(case when action_id = 'undefined' then 1 else 0 end) as bigint) as landings,
       cast(sum(case when contains(action_id, 'submit') then 1 else 0 end) as bigint) as submits
from (select *, {hl('platform')} as hl_platform, {FEEDBACK_NAME} as dvc_techname,
             {referrer_offer('referrer_url')} as offer, {referrer_source('referrer_url')} as source
      from (select cast(ts as date) as sighted_date, {FIXED} as platform, user_agent, action_id,
                   referrer_url, year, month, day
            from ({EVENTS}) raw, unnest(range(n_ids)) a(x)
            where property_id = '2868' and (action_id = 'undefined' or contains(action_id, 'submit'))
              and contains(referrer_url, 'specialoffer')))
group by all"""

OFFER_CONTROL = f"""
select offer, uc1_priority, active_flg_kd, active_flg_fb, active_flg_pt, screen_size, rrp,
       apollo_price, min_pack, start_year,
       cast(start_year || '-' || lpad(start_month, 2, '0') || '-' || lpad(start_day, 2, '0') as date) as start_date,
       cast(end_year || '-' || lpad(end_month, 2, '0') || '-' || lpad(end_day, 2, '0') as date) as end_date,
       coalesce(target_rlp_min, -99999) as target_rlp_min,
       coalesce(target_rlp_max, 99999) as target_rlp_max,
       min_ctr, min_landings, min_submits, min_s2l, max_cps
from ({inputs.sql_for(inputs.OFFERS_RAW)})"""

ACTIVE = f"""
select * from ({OFFER_CONTROL})
where start_date <= date '{RUN_DATE}' and end_date > date '{RUN_DATE}'
  and (active_flg_kd is not null or active_flg_fb is not null or active_flg_pt is not null)"""

TERMS = """offer, uc1_priority, active_flg_kd, active_flg_fb, active_flg_pt,
       min_ctr, min_landings, min_submits, min_s2l, max_cps"""

CONTROL_DEVICES = f"""
select distinct {TERMS}, dvc_techname,
       concat_ws(' and ', 'CTR>=' || min_ctr, 'submits>=' || min_submits, 'S2L>=' || min_s2l,
                 'CPS<=' || max_cps) as feedback_cond
from ({ACTIVE}) a join ({PROPERTIES}) b
  on try_cast(release_price as double) * 40 between target_rlp_min and target_rlp_max"""

OFFER_ACTIVITY = """
select offer, count(distinct sighted_date) as launch_days,
       count(distinct case when submits > 0 then dvc_techname end) as converting_devices
from history where offer is not null group by offer"""

RULE_STEPS = f"""
with history as ({inputs.sql_for(inputs.FEEDBACK)}),
control as ({CONTROL_DEVICES}),
listed as (select distinct {TERMS}, feedback_cond from control),
activity as ({OFFER_ACTIVITY}),
rated as (
  select offer, source, dvc_techname, sum(imps) as imps, sum(clicks) as clicks,
         sum(landings) as landings, sum(submits) as submits
  from history where offer is not null group by all),
renamed as (
  select *, replace(replace(dvc_techname, 'COMPUTER', 'windows nt'), 'IPAD', 'ipad') as name from rated),
success as (
  select distinct h.offer, name as dvc_techname
  from renamed h join activity using (offer) join listed l using (offer)
  where launch_days >= 3 and converting_devices >= 20 and submits >= try_cast(min_submits as double)
    and (source = 'fb'
         or (case when imps = 0 then clicks > 0 and try_cast(min_ctr as double) is not null
                  else clicks / imps >= try_cast(min_ctr as double) end
             and submits <> 0 and imps * 3 / (1000 * submits) <= try_cast(max_cps as double)))),
landing as (
  select distinct h.offer, name as dvc_techname
  from (select offer, dvc_techname, any_value(name) as name, sum(landings) as landings
        from renamed group by offer, dvc_techname) h
  join activity using (offer) join listed l using (offer)
  where launch_days >= 3 and landings >= try_cast(min_landings as double)
    and h.offer in (select offer from success group by offer having count(distinct dvc_techname) < 20)),
judged as (
  select s.offer, s.dvc_techname from success s
  where s.offer not in (select offer from landing)
  union select offer, dvc_techname from landing),
chosen as (
  select distinct l.offer, j.dvc_techname from listed l left join judged j on l.offer = j.offer),
channels as (
  select * from (values ('kd', 'kd', null), ('kd_app', 'kd', 'iphone; ios'),
                        ('fb', 'fb', 'apple iphone'), ('pt', 'pt', null)) v(channel, flag, ios)),
entries as (
  select distinct channel, ios, {TERMS.split('min_ctr')[0].strip().rstrip(',')}, dvc_techname
  from control, channels
  where case flag when 'kd' then active_flg_kd when 'fb' then active_flg_fb else active_flg_pt end = 1),
wanted as (
  select e.channel, e.uc1_priority, coalesce(c.dvc_techname, e.dvc_techname) as name, ios
  from entries e left join chosen c on e.offer = c.offer),
won as (
  select channel, min(uc1_priority) as uc1_priority, name
  from (select channel, uc1_priority,
               case when ios is null then name
                    else regexp_replace(name, 'iphone os (?:1)?[0-9]', ios, 'g') end as name
        from wanted)
  group by channel, name),
tokens as (
  select distinct w.channel as source, e.offer, w.uc1_priority, {cut('w.name', t.TOKEN_HEAD, t.TOKEN_TAIL)} as dvc_techname
  from won w join (select distinct channel, offer, uc1_priority from entries) e
    on w.channel = e.channel and w.uc1_priority = e.uc1_priority)
"""


def rules(exclusions, extra: str = "") -> str:
    return f"""{RULE_STEPS}
select source, offer, uc1_priority,
       'userAgent(".*(?i)(' || string_agg(trim(dvc_techname), '|' order by trim(dvc_techname)) || ').*")' as rule{extra}
from tokens where length(dvc_techname) > 2 and dvc_techname not in ({words(exclusions)})
group by source, offer, uc1_priority"""


NAMES = f"select distinct lower(dvc_techname) as name from ({PROPERTIES})"
MATCHED = f"""
select name as dvc_techname_raw, min(popularity) as popularity
from ({NAMES}) n left join (select popularity, dvc_techname from ({ATLAS})) a
  on n.name like a.dvc_techname || '%' escape '\\'
group by name"""

PRICES = " ".join(
    f"when {any_of('NAME', marks)} then {q(price)}" for price, marks in c.PRICE_MARKS
)


def imputed(name: str, price: str) -> str:
    return f"coalesce({price}, case {PRICES.replace('NAME', name)} end)"


def own(column: str, values) -> str:
    whens = " ".join(f"when {q(n)} then {q(v)}" for n, v in values.items())
    return f"case m.dvc_techname_raw {whens} else a.{column} end"


EXTRA = ", ".join("(" + ", ".join(q(v) if isinstance(v, str) else str(v) for v in row) + ")" for row in c.EXTRA_DEVICES)
OWN_YEAR = {n: y for n, (y, _) in c.OWN_NAMES.items()}
OWN_MONTH = {n: m for n, (_, m) in c.OWN_NAMES.items()}
OWN_NAME = {n: n for n in c.OWN_NAMES}

DEVICE_PROPERTIES = f"""
select m.dvc_techname_raw, cast(m.popularity as double) as popularity,
       coalesce({own('dvc_techname', OWN_NAME)}, m.dvc_techname_raw) as dvc_techname, brand,
       coalesce({own('dvc_commercname', OWN_NAME)}, m.dvc_techname_raw) as dvc_commercname,
       {own('release_year', OWN_YEAR)} as release_year, {own('release_month', OWN_MONTH)} as release_month,
       {imputed('m.dvc_techname_raw', 'release_price')} as release_price, screensize, cluster
from ({MATCHED}) m left join ({ATLAS}) a on m.popularity = a.popularity
union all
select * from (values {EXTRA}) v({', '.join(c.EXTRA_COLUMNS)})"""

LABELLED = f"""
select *, case when cluster = 1 and vendor = 'samsung' then '1_SS'
               when cluster = 1 and vendor <> 'samsung' then '1_OTH'
               when cluster = 2 and vendor = 'samsung' then '2_SS'
               when cluster = 2 and vendor in ('ais', 'true', 'i-mobile', 'zte', 'lava') then '2_OEM'
               when cluster = 2 then '2_OTH'
               when cluster = round(cluster) then cast(cast(cluster as bigint) as string)
               else cast(cluster as string) end as cluster_brand
from ({CLUSTERS})"""

COMPETITORS = f"""
select distinct device_id, model, id_type, event_source from ({SIGHTINGS})
where carrier in ({words(OTHERS)})"""
IN_WINDOW = f"make_date(year, month, day) between date '{RECENT[0]}' and date '{RECENT[1]}'"
HARDWARE = "id_type in ('HARDWARE_ANDROID_AD_ID', 'HARDWARE_IDFA')"
RECENT_OWN = f"""
select distinct device_id from ({SIGHTINGS})
where carrier in ({words(OWN)}) and {IN_WINDOW} and {HARDWARE}"""

PATTERN_ROWS = ", ".join(f"({q(k)}, {q(v)})" for k, v in PATTERNS.items())
REACH = f"""
with seen as (select * from ({SIGHTINGS}) where {HARDWARE}),
hits as (
  select cluster, device_id, carrier, year, month, day
  from seen join (values {PATTERN_ROWS}) v(cluster, pattern) on regexp_matches(user_agent, pattern))
select cluster, count(distinct device_id) as reach
from hits h
where carrier in ({words(OTHERS)}) and not exists (
  select 1 from hits own where own.cluster = h.cluster and own.device_id = h.device_id
    and own.carrier in ({words(OWN)}) and {IN_WINDOW})
group by cluster having count(distinct device_id) > 0"""

AGENTS_OF_CLUSTERS = f"""
select distinct user_agent, cluster
from (select distinct user_agent from ({SIGHTINGS})) join ({inputs.sql_for(inputs.CLUSTER_TOKENS)})
  on regexp_matches(user_agent, '(?i)' || token)"""

ORACLES = {
    "offer_control": OFFER_CONTROL,
    "active_offers": ACTIVE,
    "control_devices": CONTROL_DEVICES,
    "offer_list": f"select distinct {TERMS}, feedback_cond from ({CONTROL_DEVICES})",
    "offer_activity": f"with history as ({inputs.sql_for(inputs.FEEDBACK)}) {OFFER_ACTIVITY}",
    "success_devices": f"{RULE_STEPS} select * from success",
    "landing_devices": f"{RULE_STEPS} select * from landing",
    "landing_override": f"{RULE_STEPS} select * from judged",
    "feedback_devices": f"{RULE_STEPS} select * from chosen",
    "channel_devices": f"{RULE_STEPS} select * from tokens where length(dvc_techname) > 2",
    "daily_rules": rules(
        r.DAILY_EXCLUSIONS, f", {int(RUN_DATE[:4])} as year, {int(RUN_DATE[5:7])} as month, {int(RUN_DATE[8:])} as day"
    ),
    "rules_one_day": rules(r.ONE_DAY_EXCLUSIONS),
    "price_only_rules": rules(r.DAILY_EXCLUSIONS).replace(
        "left join judged j on l.offer = j.offer", "left join judged j on false"
    ),
    "tap_feedback": tap_side("'kd'", True),
    "tap_feedback_by_campaign": tap_side(f"case campaign_id {CAMPAIGNS} end", False),
    "event_feedback": EVENT_SIDE,
    "feedback_backfill": f"""
with t as ({tap_side("'kd'", True)}), e as ({EVENT_SIDE})
select {KEYS}, imps, clicks, landings, submits
from t full outer join e using ({KEYS})""",
    "unnested_taps": f"""
select action_id, tactic_id, count(*) as n
from ({TAPS}) raw, unnest(range(n_ids)) a(x), unnest(range(n_cat)) b(y), unnest(range(n_ref)) c(z)
group by action_id, tactic_id""",
    "device_names": f"""
select *, {FEEDBACK_NAME} as dvc_techname
from (select distinct {FIXED} as platform, user_agent from ({TAPS}))""",
    "catalog_names": f"""
select platform, user_agent, {CATALOG_NAME} as dvc_techname
from (select distinct platform, user_agent, {hl('platform')} as raw_class from ({SYNCS}))""",
    "platform_classes": f"""
select platform, count(*) as n, {hl('platform')} as hl_platform
from (select {FIXED} as platform from ({TAPS})) group by platform""",
    "tactic_offers": f"""
select tactic_id, case tactic_id {TACTICS} end as offer, case campaign_id {CAMPAIGNS} end as source,
       count(*) as n
from ({TAPS}) group by tactic_id, campaign_id""",
    "referrer_offers": f"""
select referrer_url, {referrer_offer('referrer_url')} as offer,
       {referrer_source('referrer_url')} as source, count(*) as n
from ({EVENTS}) group by referrer_url""",
    "page_offers": f"""
select page_id, {referrer_offer('url')} as offer, {referrer_source('url')} as source,
       {cut('lower(url)', t.TOKEN_HEAD, t.TOKEN_TAIL)} as token
from pages""",
    "device_catalog": f"""
select distinct {CATALOG_NAME} as dvc_techname, platform
from (select {FIXED} as platform, {hl('platform')} as raw_class, user_agent
      from ({SYNCS}) raw, unnest(range(n_ids)) a(x)
      where partner_id in ({', '.join(map(str, c.PARTNERS))}) and kind = 1 and year = 2024)""",
    "match_catalog": MATCHED,
    "rank_lookup": f"""
select m.dvc_techname_raw, m.popularity, a.* exclude (popularity)
from ({MATCHED}) m left join ({ATLAS}) a on m.popularity = a.popularity""",
    "device_properties": DEVICE_PROPERTIES,
    "price_imputation": f"""
select dvc_techname, {imputed('dvc_techname', 'release_price')} as release_price from ({PROPERTIES})""",
    "text_prices": f"""
select dvc_techname, count(try_cast(release_price as double)) as priced,
       max(try_cast(release_price as double)) as highest
from ({PROPERTIES}) group by dvc_techname""",
    "cluster_labels": LABELLED,
    "cluster_brand_rules": f"""
select cluster_brand,
       'userAgent(".*(?i)(' || string_agg(trim(lower(model)), '|' order by trim(lower(model))) || ').*")' as rule
from ({LABELLED}) group by cluster_brand""",
    "cluster_model_list": f"""
select cluster_brand, string_agg(model, ',' order by model) as rule
from ({LABELLED}) group by cluster_brand""",
    "audience_competitors": COMPETITORS,
    "audience_recent_own": RECENT_OWN,
    "audience_not_recent": f"""
select c.* from ({COMPETITORS}) c left join ({RECENT_OWN}) o on c.device_id = o.device_id
where o.device_id is null""",
    "cluster_reach": REACH,
    "cluster_reach_long_rules": REACH.replace(
        f"from seen join (values {PATTERN_ROWS}) v(cluster, pattern) on regexp_matches(user_agent, pattern)",
        f"from seen join ({AGENTS_OF_CLUSTERS}) using (user_agent)",
    ),
    "agents_of_clusters": AGENTS_OF_CLUSTERS,
    "model_reach": f"""
select model, user_agent, count(distinct device_id) as reach from ({SIGHTINGS})
where id_type = 'HARDWARE_IDFA' and vendor = 'Brand#2' and event_source = 'click' and year = 2024
group by model, user_agent order by reach desc""",
}

def in_window(days) -> str:
    return f"make_date(year, month, day) between date '{days[0]}' and date '{days[1]}'"


ORACLES |= {
    "daily_rules_from_state": ORACLES["daily_rules"],
    "offer_activity_from_state": ORACLES["offer_activity"],
    "feedback_totals_from_state": f"""
select offer, source, dvc_techname, cast(sum(imps) as bigint) as imps, cast(sum(clicks) as bigint) as clicks,
       cast(sum(landings) as bigint) as landings, cast(sum(submits) as bigint) as submits, max(submits > 0) as converted
from ({inputs.sql_for(inputs.FEEDBACK)}) where offer is not null group by offer, source, dvc_techname""",
    "model_reach_windows": " union all ".join(
        f"""select model, user_agent, count(distinct device_id) as reach, '{w[0]}' as first_day from ({SIGHTINGS})
where id_type = 'HARDWARE_IDFA' and vendor = 'Brand#2' and event_source = 'click' and {in_window(w)}
group by model, user_agent having count(device_id) > 0"""
        for w in WINDOWS
    ),
    "cluster_reach_windows": " union all ".join(
        f"select *, '{w[0]}' as first_day from ({ORACLES['cluster_reach_long_rules'].replace(IN_WINDOW, in_window(w))})"
        for w in WINDOWS
    ),
    "offer_control_file": ORACLES["offer_control"],
    "rejected_offer_fields": f"""
with f as ({inputs.sql_for(inputs.FAULTY_OFFERS)}), short as (select offer from f where apollo_price::int % 70 = 30),
more as (select * from f where apollo_price::int % 70 = 40), lines as (select * from f union all select * from more)
select offer, 'rrp' as field, rrp as value, 'not a value of type int' as reason from lines
where rrp is not null and not regexp_full_match(rrp, '[0-9]+')
union all select offer, 'end_date', '2017-13-' || end_day, 'no such day' from lines where end_month = '13'
union all select offer, 'min_ctr', min_ctr, 'not a number' from lines where min_ctr = 'n/a'
union all select offer, null, null, 'number of fields' from short
union all select offer, null, null, 'number of fields' from more""",
    "accepted_offers": OFFER_CONTROL.replace(
        f"({inputs.sql_for(inputs.OFFERS_RAW)})",
        f"""(select * replace (coalesce(end_day, '1') as end_day) from ({inputs.sql_for(inputs.OFFERS_RAW)})
        where apollo_price % 110 <> 50 and apollo_price % 130 <> 20 and apollo_price % 90 <> 10 and min_ctr <> 'n/a')""",
    ),
    # The reader drops rows without a vendor, as it tells title rows by that column.
    "cluster_file": f"""
select a.cluster_brand, a.rule, b.rule as models
from ({ORACLES["cluster_brand_rules"]}) a join ({ORACLES["cluster_model_list"]}) b using (cluster_brand)""".replace(
        f"from ({LABELLED})", f"from ({LABELLED}) where vendor is not null"
    ),
    "feedback_table": ORACLES["feedback_backfill"],
    "feedback_one_day": f"""
select f.* from ({ORACLES["feedback_backfill"]}) f, range(2) where sighted_date = date '{ONE_DAY}'""",
    "exported_rules": f"""
select *, row_number() over (order by source, uc1_priority nulls first, offer) as line
from ({ORACLES["daily_rules"]})""",
    "previewed_rules": f"select least(count(*), 10) as n from ({ORACLES['daily_rules']})",
}
