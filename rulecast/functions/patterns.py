"""Cheaper regular expressions for long lists of models.

A cluster's pattern has hundreds of alternatives, and an engine that backtracks tries each of them at
every position. Alternatives with a common beginning are tried once when that beginning is written
once. Only whether a text matches is kept, not which alternative does.
"""

import re

OPEN, CLOSE = "(?i)(", ")"
PLAIN = re.compile(r"[0-9a-z _\-,/]+")
PLAIN_OR_ANY = re.compile(r"[0-9a-z _\-.,/]+")


def quoted(tokens: str) -> str:
    """A case-insensitive pattern of ``|``-separated tokens that match themselves."""
    return _alternatives(tokens.split("|"), PLAIN, re.escape)


def factored(pattern: str) -> str:
    """``(?i)(a|b|…)`` with common beginnings written once; other patterns as they are."""
    if not (pattern.startswith(OPEN) and pattern.endswith(CLOSE)):
        return pattern
    tokens = pattern[len(OPEN) : -len(CLOSE)].split("|")
    if not all(tokens) or not all(map(_stands_alone, tokens)):
        return pattern
    return _alternatives(tokens, PLAIN_OR_ANY, str)


def _alternatives(tokens: list[str], plain: re.Pattern, other) -> str:
    """Tokens of ``plain`` characters share their beginnings; the rest is passed through ``other``."""
    shared = {t for t in tokens if t.isascii() and plain.fullmatch(t.lower())}
    tree: dict = {}
    for token in sorted(t.lower() for t in shared):
        _add(tree, token)
    parts = [other(t) for t in tokens if t not in shared]
    return OPEN + "|".join([_text(tree), *parts] if tree else parts) + CLOSE


def _stands_alone(token: str) -> bool:
    """False where the ``|`` next to the token was inside a group, a class or an escape."""
    if "\\" in token:
        return False
    try:
        re.compile(token)
    except re.error:
        return False
    return True


def _add(tree: dict, token: str) -> None:
    """Insert a token; one that continues a token already there adds nothing to match."""
    for character in token:
        if "" in tree:
            return
        tree = tree.setdefault(character, {})
    tree[""] = {}


def _text(tree: dict) -> str:
    branches = [c + _text(rest) if "" not in rest else c for c, rest in tree.items()]
    return branches[0] if len(branches) == 1 else "(?:" + "|".join(branches) + ")"
