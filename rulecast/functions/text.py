"""Text helpers shared by device names, offer names and rules."""

from functools import reduce

from pyspark.sql import Column, functions as F

# What a device token loses before it enters a rule.
TOKEN_HEAD = r"(?s)^.*(?:.com|sprd-|[a-z][a-z]-[0-9]? |th--1 )"
TOKEN_TAIL = r"(?s)(?:dual| opera|-orange).*"

# The wrapper around the alternatives of a rule.
RULE_OPEN = 'userAgent(".*(?i)('
RULE_CLOSE = ').*")'


def cut(text: Column, *patterns: str) -> Column:
    """Delete every match of each pattern, in the order given."""
    return reduce(lambda t, p: F.regexp_replace(t, F.lit(p), F.lit("")), patterns, text)


def contains_any(text: Column, tokens) -> Column:
    """True when one of the literal tokens occurs in the text."""
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(t)) for t in tokens])


def first_match(branches, default: Column | None = None) -> Column:
    """The value of the first ``(condition, value)`` pair that holds."""
    (condition, value), *rest = branches
    chain = reduce(lambda c, b: c.when(b[0], b[1]), rest, F.when(condition, value))
    return chain if default is None else chain.otherwise(default)


def clean_token(name: Column) -> Column:
    """A device name reduced to the part that identifies it in a user agent."""
    return cut(name, TOKEN_HEAD, TOKEN_TAIL)


def rule_text(alternatives: Column) -> Column:
    """Wrap ``a|b|c`` as a user-agent rule; NULL stays NULL."""
    return F.concat(F.lit(RULE_OPEN), alternatives, F.lit(RULE_CLOSE))


def rule_pattern(rule: Column) -> Column:
    """The bare regular expression inside a rule made by :func:`rule_text`."""
    inner = F.substr(rule, F.lit(len(RULE_OPEN) + 1))
    return F.concat(F.lit("(?i)("), F.left(inner, F.length(inner) - len(RULE_CLOSE)), F.lit(")"))
