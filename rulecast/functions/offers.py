"""Offer and channel names derived from campaign codes and referrers."""

from collections.abc import Mapping
from itertools import chain

from pyspark.sql import Column, functions as F

from rulecast.functions.text import contains_any, cut, first_match

# Tactic ids of each offer.
OFFER_TACTICS = {
    "mnp-device-discount-samsung": (186858, 191242),
    "mnp-free-device": (191243,),
    "tariff": (191244,),
    "booster": (199183,),
    "mnp-samsung-galaxy-j2": (197236, 213768, 241984),
    "mnp-samsung-galaxy-j5": (200320,),
    "mnp-samsung-galaxy-a5": (201014,),
    "mnp-asus-zenfone-45": (203164, 217118),
    "mnp-oppo-mirror5": (214301,),
    "mnp-free-dtac-pocket-wifi": (217958,),
    "mnp-vivo-v5": (223067,),
    "mnp-free-dtac-phone-s2": (221701,),
    "mnp-samsung-galaxy-j5-prime": (222299, 231134, 231808, 231809, 238494, 238495, 238496),
    "mnp-asus-zenfone-55": (224006, 231132, 231810, 231811),
    "mnp-samsung-galaxy-j2-prime": (
        226384, 232254, 232255, 232257, 238491, 238492, 238493, 238924, 241140, 241141,
    ),
    "mnp-samsung-galaxy-j7-prime": (232303, 232259, 232260, 232261, 238498, 238501, 238502),
    "mnp-huawei-mate9": (231135, 231805, 231806),
    "sim-platinum-number": (231460, 231812, 231813),
    "sim-nice-number": (231461, 231814, 231815, 241982),
    "lucky-number": (231462, 231816, 231817),
    "mnp-huawei-p9": (232262, 232263, 232264, 241136, 241137, 241138, 241983),
    "mnp-samsung-galaxy-note5": (234395, 234396, 234397),
    "mgm": (238642, 238644, 238645, 241985),
}
TACTIC_OFFERS = {t: offer for offer, tactics in OFFER_TACTICS.items() for t in tactics}

# Channel of each campaign.
CAMPAIGN_SOURCES = {5138: "kd", 5413: "pt"}

# Referrer marks of offers whose page is not named after them.
REFERRER_OFFERS = (
    ("special-package", "tariff"),
    ("asus-zenfone-45", "mnp-asus-zenfone-45"),
    ("mnp-huawei-p9", "mnp-huawei-p9"),
)
# The page name lies between these.
REFERRER_CUTS = (r"(?s)^.*specialoffer/", r"(?s)\.html.*", r"(?s)-lite.*", r"(?s)-v[0-9].*")

# Referrer marks of channels.
REFERRER_SOURCES = (("kaidee", "kd"), ("pantip", "pt"), ("facebook", "fb"))
OTHER_SOURCE = "oth"


def code_lookup(code: Column, names: Mapping[int, str]) -> Column:
    """The name of a numeric code; NULL for a code that is not listed."""
    pairs = chain.from_iterable((F.lit(k).cast("bigint"), F.lit(v)) for k, v in names.items())
    return F.try_element_at(F.create_map(*pairs), code.cast("bigint"))


def tactic_to_offer(tactic_id: Column, names: Mapping[int, str] = TACTIC_OFFERS) -> Column:
    return code_lookup(tactic_id, names)


def campaign_to_source(campaign_id: Column, names: Mapping[int, str] = CAMPAIGN_SOURCES) -> Column:
    return code_lookup(campaign_id, names)


def referrer_to_offer(url: Column) -> Column:
    """Offer of the landing page that sent the event."""
    named = [(contains_any(url, (mark,)), F.lit(offer)) for mark, offer in REFERRER_OFFERS]
    return first_match(named, F.lower(cut(url, *REFERRER_CUTS)))


def referrer_to_source(url: Column) -> Column:
    """Channel of the landing page that sent the event."""
    marks = [(contains_any(url, (mark,)), F.lit(source)) for mark, source in REFERRER_SOURCES]
    return first_match(marks, F.lit(OTHER_SOURCE))
