"""Word lists as literal patterns, and the filters made of them. Lists are the caller's data."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _quoted(term: str) -> str:
    return re.sub(r"([\\.^$|?*+()\[\]{}])", r"\\\1", term)


def any_substring(text: Column, terms: Iterable[str]) -> Column:
    """Whether the lower-cased text contains a term; null counts as empty."""
    pattern = "|".join(_quoted(t.lower()) for t in terms)
    return F.lower(F.coalesce(text, F.lit(""))).rlike(pattern) if pattern else F.lit(False)


def any_padded(text: Column, terms: Iterable[str]) -> Column:
    """The same on the text with single spaces, one before and one behind, so that a term may end in a space."""
    spaced = F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"\s+", " ")), F.lit(" "))
    return any_substring(spaced, terms)


def boundary_pattern(terms: Iterable[str]) -> str:
    """One pattern for the terms as whole words (letters of any script count), the longest first."""
    return r"(?iU)\b(?:" + "|".join(_quoted(t) for t in sorted(set(terms), key=lambda t: (-len(t), t))) + r")\b"


def any_word(text: Column, terms: Iterable[str]) -> Column:
    """Whether a term stands in the text as a whole word, whatever its case."""
    return F.coalesce(text, F.lit("")).rlike(boundary_pattern(terms))


def matched_layers(layers: dict[str, Column]) -> Column:
    """The names of the layers that match, joined by a plus; empty if none does."""
    return F.concat_ws("+", *[F.when(test, F.lit(name)) for name, test in layers.items()])


def tiered(title: Column, text: Column, exclude: Iterable[str], safe: Iterable[str], ambiguous: Iterable[str], confirm: Iterable[str], head: int = 500) -> Column:
    """The tier that keeps an article, or null: an excluded title rejects; a safe title keeps; an ambiguous title keeps
    only if the text's head confirms it; else the head alone may keep."""
    confirmed = any_word(F.substring(text, 1, head), confirm)
    return (
        F.when(any_word(title, exclude), F.lit(None).cast("string"))
        .when(any_word(title, safe), "safe_title")
        .when(any_word(title, ambiguous), F.when(confirmed, "confirmed_title"))
        .when(confirmed, "text")
    )


def matches_up_to(text: Column, patterns: Iterable[str], most: int = 2) -> Column:
    """How many of the patterns match, ``most`` at the most."""
    count = F.lit(0)
    for p in patterns:
        count = count + F.coalesce(text, F.lit("")).rlike(f"(?i){p}").cast("int")
    return F.least(count, F.lit(most))


def anchored(body: Column, journal: Column, anchors: str, journals: Iterable[str]) -> Column:
    """``anchor`` where the body matches, else ``journal`` where the journal's name has a word, else null."""
    return F.when(F.coalesce(body, F.lit("")).rlike(f"(?i){anchors}"), "anchor").when(any_substring(journal, journals), "journal")


def trigger_without_anchor(trigger_text: Column, anchor_text: Column, trigger: str, anchor: str) -> Column:
    """Whether the trigger matches and no anchor does."""
    return F.coalesce(trigger_text, F.lit("")).rlike(f"(?i){trigger}") & ~F.coalesce(anchor_text, F.lit("")).rlike(f"(?i){anchor}")


def model_selected(name: Column, filters: Iterable[str]) -> Column:
    """Whether a model's name has one of the plain words (if there are any) and none of those behind a ``!``."""
    filters = list(filters)
    wanted, banned = [f for f in filters if not f.startswith("!")], [f[1:] for f in filters if f.startswith("!")]
    keep = any_substring(name, wanted) if wanted else F.lit(True)
    return keep & ~any_substring(name, banned) if banned else keep
