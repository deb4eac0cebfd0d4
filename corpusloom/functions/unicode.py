"""Unicode normal forms, which Spark has no built-in function for, as Arrow-batched functions."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from corpusloom.functions import text as T


@F.pandas_udf(StringType())
def nfkc(text: pd.Series) -> pd.Series:
    """Compatibility composition."""
    return text.map(lambda t: unicodedata.normalize("NFKC", t), na_action="ignore")


@F.pandas_udf(StringType())
def nfkd(text: pd.Series) -> pd.Series:
    """Compatibility decomposition."""
    return text.map(lambda t: unicodedata.normalize("NFKD", t), na_action="ignore")


def beyond_ascii(form, text: Column, raw: Column) -> Column:
    """A normal form of a text that was made of ``raw`` by leaving out characters or lower-casing; one in ASCII is its own, and
    doesn't travel to a Python worker."""
    return F.coalesce(form(F.when(raw.rlike(r"[^\x00-\x7F]"), text)), text)


def clean_text(text: Column) -> Column:
    """Tags, citations, compatibility forms, control characters and white space cleaned; null if nothing is left, and
    blank texts as they are."""
    cleaned = T.fix_whitespace(T.drop_control(beyond_ascii(nfkc, T.strip_citations(T.strip_html(text)), text)))
    # the one-element array binds what is cleaned, which is then computed once
    filled = F.transform(F.array(cleaned), lambda c: F.when(c != "", c))[0]
    return F.when(~text.rlike(r"\S"), text).otherwise(filled)


def folded_title_key(title: Column) -> Column:
    """Key of a title with accents folded to their letters, without spaces at the ends."""
    kept = T.drop(beyond_ascii(nfkd, F.lower(T.strip(title)), title), r"[^a-z0-9 ]")
    return T.strip(F.regexp_replace(kept, r"\s+", " "))
