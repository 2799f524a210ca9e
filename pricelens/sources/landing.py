"""The landed response table and helpers to open response bodies.

Fetching is someone else's job.  A landed row is
(source, key, fetched_at, final_url, body).  Every parser reads bodies with a
narrow schema, so fields nobody asks for are never built, and keeps rejected
rows with a reason instead of dropping them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expr import ColumnLike, col

RAW_DDL = "source string, key string, fetched_at timestamp, final_url string, body string"


def once(value: Column) -> Column:
    """Mark a costly value (a parsed body) to be computed once per row.

    Filters above a projection are rewritten in terms of its inputs and pushed
    down, which would parse a body again for every test; a generator's output
    is left alone.  Selecting ``once(x).alias("x")`` keeps one row per row.
    """
    return F.explode(F.array(value))


# A document that is one object whose first name is a plain number.
FIRST_ID = r'^[ \t\r\n]*\{[ \t\r\n]*"([0-9]{1,19})"[ \t\r\n]*:'


def id_head(body: ColumnLike) -> Column:
    """A body's text up to its first name, if that is an id, else empty."""
    return F.regexp_extract(F.substring(col(body), 1, 64), FIRST_ID, 0)


def first_id(body: ColumnLike, head: Column | None = None) -> tuple[Column, Column]:
    """The first name of a body keyed by ids, and the body with that name left empty.

    The JSON reader is slow on names it has not met before, and ids are such
    names in nearly every body.  Later names stay; bodies of another shape stay
    as they are and have no first id.  ``head`` is ``id_head`` where known.
    """
    head = id_head(body) if head is None else head
    rest = F.substr(col(body), F.length(head) + 1)
    own = F.when(head != "", F.split_part(head, F.lit('"'), F.lit(2)))
    return own, F.when(head != "", F.concat(F.lit('{"":'), rest)).otherwise(col(body))


def id_entries(raw: DataFrame, schema: str, name: str, value: str, *keep: ColumnLike) -> DataFrame:
    """One row per entry of bodies that are an object keyed by ids."""
    own, body = first_id("__body", F.col("__head"))
    heads = raw.select(*keep, F.col("body").alias("__body"), once(id_head("body")).alias("__head"))
    entries = heads.select(*[c for c in heads.columns if c != "__body"], F.posexplode(F.from_json(body, schema)).alias("__at", "__name", value))
    first = (F.col("__at") == 0) & (F.col("__name") == "")
    return entries.withColumn(name, F.when(first, F.coalesce(own, "__name")).otherwise(F.col("__name"))).drop("__head", "__at", "__name")


def script_body(html: ColumnLike, attribute: str) -> Column:
    """Text of the first script tag carrying the given attribute pattern."""
    return F.regexp_extract(col(html), rf"(?is)<script\b(?=[^>]*\b{attribute})[^>]*>(.*?)</script>", 1)


def script_bodies(html: ColumnLike, attribute: str) -> Column:
    return F.regexp_extract_all(col(html), F.lit(rf"(?is)<script\b(?=[^>]*\b{attribute})[^>]*>(.*?)</script>"), F.lit(1))


NEXT_DATA = "id=[\"']__NEXT_DATA__[\"']"
LD_JSON = "type=[\"']application/ld\\+json[\"']"


def without_raw_text(html: ColumnLike) -> Column:
    """HTML without comments, scripts and styles."""
    return F.regexp_replace(
        col(html), r"(?is)<(?:!--.*?-->|script\b[^>]*>.*?</script\s*>|style\b[^>]*>.*?</style\s*>)", "")


def attribute(tag: ColumnLike, name: str) -> Column:
    """Value of an attribute of one opening tag, null when absent."""
    return F.when(col(tag).rlike(rf"(?is)\s{name}\s*=\s*[\"']"), attribute_text(tag, name))


def attribute_text(tag: ColumnLike, name: str) -> Column:
    """Value of an attribute of one opening tag, empty when absent; the tag is searched once."""
    return unescape(F.regexp_extract(col(tag), rf"(?is)\s{name}\s*=\s*([\"'])(.*?)\1", 2))


# Entities that occur in store markup, fixed values.
ENTITIES = (("&quot;", '"'), ("&#39;", "'"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&"))


def unescape(text: ColumnLike) -> Column:
    out = col(text)
    for entity, char in ENTITIES:
        out = F.replace(out, F.lit(entity), F.lit(char))
    return out


def strip_tags(html: ColumnLike) -> Column:
    return F.trim(F.regexp_replace(unescape(F.regexp_replace(col(html), "<[^>]+>", " ")), r"\s+", " "))


def keys_are(json_text: ColumnLike, *names: str) -> Column:
    """The JSON object has exactly these keys."""
    wanted = F.array(*[F.lit(n) for n in sorted(names)])
    return F.coalesce(F.array_sort(F.json_object_keys(col(json_text))) == wanted, F.lit(False))


def clean_url(url: ColumnLike, host: str, path_shape: str) -> Column:
    """Capture of the path of an https url on one host without credentials,
    query or fragment; empty otherwise."""
    host_shape = host.replace(".", r"\.")
    return F.regexp_extract(col(url), rf"^https://{host_shape}{path_shape}$", 1)
