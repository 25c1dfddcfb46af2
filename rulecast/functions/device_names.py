"""Device names cut out of user agents.

Two styles exist. ``FEEDBACK`` names the device of a tap or landing, ``CATALOG`` names it for the
property catalogue; they differ in locale patterns, in whether ``_`` survives and in the last cuts.
Both are a sequence of deletions on the lower-cased user agent.
"""

from dataclasses import dataclass

from pyspark.sql import Column, functions as F

from rulecast.functions.platform import WINDOWS_PHONE, is_not_mobile
from rulecast.functions.text import contains_any, cut, first_match

# What each cut removes. ``^.*`` cuts remove everything up to the last mark.
ANDROID_HEAD = r"(?s)^.*android [0-9](?:.[0-9](?:.[0-9])?)?; "
BUILD_TAIL = r"(?s)(?: build|; android/|/v[0-9] linux|v_td|_td/v[0-9]|i_style).*"
BUILD_TAIL_CATALOG = (
    r"(?s)(?: build|; android/|\) applewebkit|/v[0-9] linux|v_td|_td/v[0-9]|i_style).*"
)
LOCALE_HEAD = (
    r"(?s)^.*(?:(?:th|en|zh|zz)[-_]"
    r"(?:gb|au|ph|th|us|cn|nz|tw|fi|jp|za|sg|ie|zz);? |nokia; )"
)
LOCALE_HEAD_CATALOG = r"(?s)^.*(?:[a-z][a-z][-_][a-z][a-z];? |nokia; )"
PATH_TAIL = r"(?s)(?:/|linux).*"
NOT_KEPT = r"[^0-9a-z\- .]"
NOT_KEPT_CATALOG = r"[^0-9a-z\- _.]"
VENDOR_HEAD = r"(?s)^.*(?:samsung[- ]|lenovo |microsoft |th- )"
FLAVOUR_TAIL = r"(?s)(?:like|lollipop).*"
ENGINE_TAIL = r"(?s) applewebkit.*"
DUAL_SIM_TAIL = r"(?s) dual sim.*"
CATALOG_TAIL = r"(?s)(?:by|cr|u2 |_?dual).*"
CATALOG_HEAD = r"(?s)^.*[a-z][a-z]-?[0-9]? "

# Cuts for Windows phones.
WINDOWS_PHONE_CUTS = (
    r"(?s)^.*(?:microsoft|nokia); ",
    r"(?s)\) like iphone.*",
    r"(?s);.*",
    r"(?s)\).*",
    ENGINE_TAIL,
    DUAL_SIM_TAIL,
)

# Cuts and marks for Apple devices.
IOS_CUTS = (r"(?s)^.*iphone;(?: u;)? cpu ", r"(?s)like mac os.*", r"(?s)_.*")
IN_APP_HEAD = r"(?s)^.*fbdv/"
IN_APP_MODEL = r"iphone[0-9]"

IOS_MARK, IPOD_MARK = "cpu iphone os", "ipod"
OTHER_IOS_MARK, IPHONE_IOS_MARK = "iphone; u; cpu iphone", "iphone; cpu os"
IN_APP_MARKS = ("(null) [fban", "fbdv/iphone")

# Browsers that hide the device. LIKE has no character classes, so the marks with
# brackets stand for themselves.
HIDDEN_PHONE_MARKS = ("android; mobile; rv", "mobile rv[0-9][0-9].[0-9] gecko")
HIDDEN_TABLET_MARKS = ("android; tablet; rv", "tablet rv[0-9][0-9].[0-9] gecko")

# User agents that consist of the model alone.
BARE_MODELS = ("iris405", "iris700")


@dataclass(frozen=True)
class NameStyle:
    build_tail: str
    locale_head: str
    not_kept: str
    last_tails: tuple[str, ...]


FEEDBACK = NameStyle(
    BUILD_TAIL, LOCALE_HEAD, NOT_KEPT, (FLAVOUR_TAIL, ENGINE_TAIL, DUAL_SIM_TAIL)
)
CATALOG = NameStyle(BUILD_TAIL_CATALOG, LOCALE_HEAD_CATALOG, NOT_KEPT_CATALOG, (FLAVOUR_TAIL,))


def android_model(agent: Column, style: NameStyle) -> Column:
    """The model between the Android version and the build of a lower-cased user agent."""
    model = F.trim(cut(agent, ANDROID_HEAD, style.build_tail, style.locale_head, PATH_TAIL))
    return cut(model, style.not_kept, VENDOR_HEAD, *style.last_tails)


def _apple_and_hidden(platform: Column, agent: Column):
    """Branches both styles share, in order."""
    def has(mark):
        return F.contains(agent, F.lit(mark))

    on_iphone = F.lower(platform) == "iphone"
    ios = has(IOS_MARK)
    other_ios = has(OTHER_IOS_MARK) | (has(IPHONE_IOS_MARK) & on_iphone)
    in_app = has(IN_APP_MARKS[0]) & has(IN_APP_MARKS[1])
    return [
        (ios & has(IPOD_MARK) & on_iphone, F.lit(IPOD_MARK)),
        (ios | other_ios, cut(agent, *IOS_CUTS)),
        (in_app & on_iphone, F.regexp_extract(cut(agent, IN_APP_HEAD), IN_APP_MODEL, 0)),
        (contains_any(agent, HIDDEN_PHONE_MARKS), F.lit("unidentified android")),
        (contains_any(agent, HIDDEN_TABLET_MARKS), F.lit("unidentified tablet")),
    ]


def device_name(platform: Column, user_agent: Column) -> Column:
    """Feedback-style name; ``platform`` is the corrected platform."""
    agent = F.lower(user_agent)
    windows = (platform == WINDOWS_PHONE, F.trim(cut(agent, *WINDOWS_PHONE_CUTS)))
    return first_match(
        [(is_not_mobile(platform), platform), windows, *_apple_and_hidden(platform, agent)],
        F.trim(android_model(agent, FEEDBACK)),
    )


def catalog_name(platform: Column, raw_class: Column, user_agent: Column) -> Column:
    """Catalogue-style name; ``raw_class`` is the class of the uncorrected platform."""
    agent = F.lower(user_agent)
    bare = [(agent == model, F.lit(model)) for model in BARE_MODELS]
    name = first_match(
        [(raw_class == "PC_OTHERS", platform), *_apple_and_hidden(platform, agent), *bare],
        android_model(agent, CATALOG),
    )
    return F.lower(F.trim(cut(name, CATALOG_TAIL, CATALOG_HEAD)))
