"""Small hand-made inputs in the layouts the jobs read."""

import datetime as dt

TAPS = """
header struct<created_at: bigint, platform: string, user_agent: string,
  incoming_ids: array<struct<value: string>>,
  query_params: array<struct<key: string, value: string>>,
  http_headers: array<struct<key: string, value: string>>>,
action_id string, tactic_id bigint, campaign_id bigint, year int, month int, day int"""

EVENTS = """
header struct<created_at: bigint, platform: string, user_agent: string, referrer_url: string,
  incoming_ids: array<struct<value: string>>>,
action_id string, property_id string, year int, month int, day int"""

FEEDBACK = """sighted_date date, offer string, source string, hl_platform string,
dvc_techname string, imps bigint, clicks bigint, landings bigint, submits bigint"""

ANDROID_UA = "Mozilla/5.0 (Linux; Android 5.1.1; {} Build/LMY47X) AppleWebKit"


def ms(day, hour=12):
    moment = dt.datetime.fromisoformat(day).replace(hour=hour, tzinfo=dt.timezone.utc)
    return int(moment.timestamp() * 1000)


def tap(action="impression", day="2017-02-01", tactic=241985, campaign=5138, ids=1, cats=1, refs=1,
        platform="ANDROID", agent=ANDROID_UA.format("SM-J700F"), sighted=None):
    y, m, d = (int(x) for x in day.split("-"))
    header = (
        ms(sighted or day), platform, agent, [("i",)] * ids,
        [("ext_cat", "c")] * cats + [("page", "1")], [("Referer", "r")] * refs + [("Host", "h")],
    )
    return (header, action, tactic, campaign, y, m, d)


def event(action="undefined", day="2017-02-01", url="http://kaidee.com/specialoffer/mgm.html", ids=1,
          platform="ANDROID", agent=ANDROID_UA.format("SM-J700F"), prop="2868"):
    y, m, d = (int(x) for x in day.split("-"))
    return ((ms(day), platform, agent, url, [("i",)] * ids), action, prop, y, m, d)


def control_row(offer, priority=1, kd=1, fb=1, pt=1, low=-99999, high=99999, start="2017-01-01",
                end="2017-03-01", ctr="0.005", landings="1", submits="1", s2l="0.05", cps="30"):
    return (offer, priority, kd, fb, pt, dt.date.fromisoformat(start), dt.date.fromisoformat(end),
            low, high, ctr, landings, submits, s2l, cps)


CONTROL = """offer string, uc1_priority int, active_flg_kd int, active_flg_fb int,
active_flg_pt int, start_date date, end_date date, target_rlp_min int, target_rlp_max int,
min_ctr string, min_landings string, min_submits string, min_s2l string, max_cps string"""

PROPERTIES = "dvc_techname string, release_price string"


def history(offer, devices, source="kd", days=3, imps=100, clicks=10, landings=5, submits=2):
    """Feedback rows of some devices, spread over the first days of the year."""
    return [
        (dt.date(2017, 1, 1 + i % days), offer, source, "ANDROID", d, imps, clicks, landings, submits)
        for i, d in enumerate(devices)
    ]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
