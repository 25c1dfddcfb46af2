"""Platform names."""

from pyspark.sql import Column, functions as F

from rulecast.functions.text import contains_any

# Platforms reported under the ANDROID class, and the one iPhone platform.
ANDROID_CLASS = (
    "ANDROID",
    "ANDROID_TABLET",
    "WINDOWS_PHONE",
    "WINDOWS_TABLET",
    "BLACKBERRY",
    "FEATURE_PHONE",
)
IPHONE = "IPHONE"
WINDOWS_PHONE = "WINDOWS_PHONE"

# User-agent marks of a Windows phone that reports itself as an iPhone.
WINDOWS_PHONE_MARKS = ("windows phone", "lumia")


def fix_platform(platform: Column, user_agent: Column) -> Column:
    """Correct Windows phones that report the iPhone platform."""
    disguised = (F.lower(platform) == "iphone") & contains_any(
        F.lower(user_agent), WINDOWS_PHONE_MARKS
    )
    return F.when(disguised, F.lit(WINDOWS_PHONE)).otherwise(platform)


def platform_class(platform: Column) -> Column:
    """ANDROID, IPHONE or PC_OTHERS; an unknown or missing platform is PC_OTHERS."""
    return (
        F.when(platform.isin(*ANDROID_CLASS), F.lit("ANDROID"))
        .when(platform == IPHONE, F.lit("IPHONE"))
        .otherwise(F.lit("PC_OTHERS"))
    )


def is_not_mobile(platform: Column) -> Column:
    """True for a known platform that is no phone or tablet; NULL stays NULL."""
    return ~platform.isin(*ANDROID_CLASS, IPHONE)
