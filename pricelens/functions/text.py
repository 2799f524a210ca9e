"""Title, slug and name normalisation.

Unicode normal forms have no built-in Spark function; one Arrow UDF covers
them.  It sees a null in place of every text that is all ASCII, which has no
other form.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .expr import ColumnLike, col


@F.pandas_udf(T.StringType())
def nfkc(values: pd.Series) -> pd.Series:
    return values.map(lambda v: None if v is None else unicodedata.normalize("NFKC", v))


@F.pandas_udf(T.StringType())
def nfkd(values: pd.Series) -> pd.Series:
    return values.map(lambda v: None if v is None else unicodedata.normalize("NFKD", v))


def _folded(form, text: Column) -> Column:
    """Normal form of a text; ASCII texts are their own and do not go through Python."""
    return F.coalesce(form(F.when(text.rlike(r"[^\x00-\x7F]"), text)), text)


def norm_title_basic(title: ColumnLike) -> Column:
    """Title key without compatibility folding: lower case, letters and digits."""
    lowered = F.lower(F.coalesce(col(title), F.lit("")))
    return F.regexp_replace(lowered, r"[^\p{L}\p{N}]+", "")


def norm_title(title: ColumnLike) -> Column:
    """Title key: legal marks dropped, compatibility forms folded."""
    lowered = F.lower(F.coalesce(col(title), F.lit("")))
    folded = _folded(nfkc, F.regexp_replace(lowered, "[™®©℠]", ""))
    return F.regexp_replace(folded, r"[^\p{L}\p{N}]+", "")


def with_title_key(df: DataFrame, name: str = "title_key", title: str = "title", key=norm_title) -> DataFrame:
    """Add a title's key; only rows whose title is not all ASCII go through Python.

    A Python step takes every row of its input to a worker and back, even if it
    has nothing to do there, so the rows are parted before it: a title of ASCII
    letters has the plain key.  Other key functions are applied as they are.
    """
    if key is not norm_title:
        return df.withColumn(name, key(title))
    odd = F.coalesce(F.col(title).rlike(r"[^\x00-\x7F]"), F.lit(False))
    return df.where(~odd).withColumn(name, norm_title_basic(title)).unionByName(df.where(odd).withColumn(name, norm_title(title)))


# Suffixes that still name the same game, fixed values.
EDITION_SUFFIXES = ("fornintendoswitch", "nintendoswitchedition")


def edition_keys(key: ColumnLike) -> Column:
    """The keys a candidate title answers to: itself and itself without a
    known edition suffix."""
    k = col(key)
    stripped = F.regexp_extract(k, r"^(.*)(?:" + "|".join(EDITION_SUFFIXES) + ")$", 1)
    return F.filter(F.array_distinct(F.array(k, stripped)), lambda x: x != "")


def loose_title(title: ColumnLike) -> Column:
    """Case and spacing folded, punctuation kept."""
    return F.lower(F.trim(F.regexp_replace(_folded(nfkc, F.coalesce(col(title), F.lit(""))), r"\s+", " ")))


def slugify(title: ColumnLike, length: int = 64) -> Column:
    plain = F.regexp_replace(_folded(nfkd, F.coalesce(col(title), F.lit(""))), r"\p{M}+", "")
    words = F.regexp_replace(F.lower(plain), "&", " and ")
    dashed = F.regexp_replace(F.regexp_replace(words, "[^a-z0-9]+", "-"), "^-+|-+$", "")
    return F.regexp_replace(F.substring(dashed, 1, length), "-+$", "")


# Company form words dropped from an organisation name, fixed values.
COMPANY_WORDS = ("incorporated", "inc", "ltd", "limited", "llc", "corp", "corporation", "co")


def org_key(name: ColumnLike) -> Column:
    """Organisation name without company form words, single spaced."""
    lowered = F.lower(F.coalesce(col(name), F.lit("")))
    bare = F.regexp_replace(lowered, r"\b(?:" + "|".join(COMPANY_WORDS) + r")\b", "")
    return F.trim(F.regexp_replace(bare, r"[^\p{L}\p{N}]+", " "))


# Words that mark something other than a base game, fixed values.
CALENDAR_JUNK = r"(?i)\b(demo|playtest|soundtrack|dlc|art\s*book|trailer)\b"
CANDIDATE_NOISE = (
    r"(?i)\b(demo|soundtrack|playtest|dedicated server|season pass|upgrade pack|artbook)\b|\bdlc\b"
)


def junk_title(title: ColumnLike, pattern: str = CALENDAR_JUNK) -> Column:
    return F.coalesce(col(title).rlike(pattern), F.lit(False))


def parse_release(text: ColumnLike) -> tuple[Column, Column]:
    """(date, month) of a store's release text; vague texts give nulls."""
    t = F.trim(col(text))
    short = F.regexp_replace(t, r"([A-Za-z]{3})[a-z]*", "$1")
    titled = F.initcap(short)
    date = F.coalesce(
        F.when(titled.rlike(r"^\d{1,2} +[A-Z][a-z]{2},? +\d{4}$"),
               F.try_to_date(F.regexp_replace(titled, r"[, ]+", " "), "d MMM yyyy")),
        F.when(titled.rlike(r"^[A-Z][a-z]{2} +\d{1,2},? +\d{4}$"),
               F.try_to_date(F.regexp_replace(titled, r"[, ]+", " "), "MMM d yyyy")),
    )
    month_only = F.when(
        titled.rlike(r"^[A-Z][a-z]{2} +\d{4}$"),
        F.try_to_date(F.concat(F.lit("1 "), F.regexp_replace(titled, " +", " ")), "d MMM yyyy"),
    )
    return date, F.date_format(F.coalesce(date, month_only), "yyyy-MM")
