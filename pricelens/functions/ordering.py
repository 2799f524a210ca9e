"""Ranking and row numbering that never gathers one hot key, or the whole
table, in a single task."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .expr import ColumnLike, col

#: A total order is cut into the square of this number of ranges.
PARTS = 32
#: Rows of the sample that the cuts are taken from.
SAMPLE = 16 * PARTS * PARTS
#: Rows of a group that one task may number by itself.
HOT = 100_000


class Key(NamedTuple):
    """A sort key whose direction is known, so that two rows can be compared by it."""

    name: ColumnLike
    descending: bool = False

    @property
    def value(self) -> Column:
        return col(self.name)

    def order(self) -> Column:
        return self.value.desc() if self.descending else self.value.asc()


def down(value: ColumnLike) -> Key:
    return Key(value, True)


#: How a column shows that it is a sort expression.
SORT = re.compile(r"^Column<'(.*) (ASC|DESC) NULLS (FIRST|LAST)'>$", re.DOTALL)


def keys_of(order: Sequence[Column | Key | str]) -> list[Key]:
    """Sort keys; a plain column or name is ascending.

    A sort expression such as ``F.col("x").desc()`` is taken apart by its text;
    ``Key`` and ``down`` say the same without that.  Where its nulls are not at
    the end that its direction puts them, their place is a key of its own.
    """
    keys: list[Key] = []
    for k in order:
        found = SORT.match(repr(k)) if isinstance(k, Column) else None
        if found is None:
            keys.append(k if isinstance(k, Key) else Key(k))
            continue
        value, descending, last = F.expr(found[1]), found[2] == "DESC", found[3] == "LAST"
        if descending != last:
            keys.append(Key(value.isNull(), not last))
        keys.append(Key(value, descending))
    return keys


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1,
                  rank: str | None = None) -> DataFrame:
    """First ``n`` rows of every key in the given order.

    The filter sits right on ``row_number``, so Spark cuts every key down to
    ``n`` rows inside each map task before the shuffle (window group limit).
    """
    name = rank or "__rn"
    w = Window.partitionBy(*keys).orderBy(*order)
    out = df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= n)
    return out if rank else out.drop(name)


def _splitters(df: DataFrame, keys: Sequence[Key]) -> DataFrame:
    """One row with ``cuts``: at most PARTS * PARTS sorted keys of the table.

    The sample is the rows with the smallest hashes: the same rows whenever the
    plan runs, whatever the partitioning, and of fixed size.
    """
    names = [f"k{i}" for i in range(len(keys))]
    values = df.select(*[k.value.alias(name) for name, k in zip(names, keys)])
    sample = values.withColumn("h", F.xxhash64(*names)).orderBy("h").limit(SAMPLE)
    # the windows and the array see the sample only
    by = Window.orderBy(*[Key(name, k.descending).order() for name, k in zip(names, keys)])
    place = sample.withColumn("n", F.row_number().over(by)).withColumn("of", F.count(F.lit(1)).over(Window.partitionBy()))
    step = lambda n: F.floor(n * PARTS * PARTS / F.col("of"))
    cut = place.where((F.col("n") == 1) | (step(F.col("n") - 1) > step(F.col("n") - 2)))
    return cut.agg(F.sort_array(F.collect_list(F.struct("n", *names))).alias("cuts"))


def _reached(keys: Sequence[Key], cut: Column) -> Column:
    """Whether a row stands at or behind a cut."""
    behind, equal = F.lit(False), F.lit(True)
    for i, k in enumerate(keys):
        other = cut[f"k{i}"]
        # ascending keys have nulls first, descending ones last
        more = F.when(k.value.isNull(), F.lit(False)).when(other.isNull(), F.lit(True)).otherwise(k.value > other)
        less = F.when(other.isNull(), F.lit(False)).when(k.value.isNull(), F.lit(True)).otherwise(k.value < other)
        behind = behind | (equal & (less if k.descending else more))
        equal = equal & k.value.eqNullSafe(other)
    return behind | equal


def ranged(df: DataFrame, order: Sequence[Column | Key | str], name: str = "__range") -> DataFrame:
    """Number of the range of a total order that a row lies in, rows in order never going back.

    Nothing runs here: the cuts are a scalar subquery of the plan itself, and a
    row's place among them is found by halving.  A range holds about one part in
    PARTS * PARTS of the rows.
    """
    keys = keys_of(order)
    with_cuts = df.withColumn("cuts", F.coalesce(_splitters(df, keys).scalar(), F.array()))
    halves = F.array(*[F.lit(PARTS * PARTS >> i) for i in range((PARTS * PARTS).bit_length())])
    # the number of cuts that the row stands at or behind
    found = F.aggregate(halves, F.lit(0), lambda at, half: F.when(
        (at + half <= F.size("cuts")) & _reached(keys, F.try_element_at("cuts", at + half)), at + half).otherwise(at))
    return with_cuts.withColumn(name, found).drop("cuts")


def group_row_number(df: DataFrame, keys: Sequence[str], order: Sequence[Column | Key | str], name: str = "rn") -> DataFrame:
    """1-based position inside every group, for groups of any size; no job runs before the result's own.

    The order of (keys, order) is cut into ranges; a row's position is that in
    its range plus the group's rows in earlier ranges.  Only a group that reaches
    over a cut has such rows, so the offsets are at most one row per range.
    ``order`` must be unique inside a group, and the rows of ``df`` the same
    whenever it is read.
    """
    order = keys_of(order)
    laid = ranged(df, [*keys, *order])
    inside = Window.partitionBy("__range", *keys).orderBy(*[k.order() for k in order])
    counts = laid.groupBy("__range", *keys).agg(F.count(F.lit(1)).alias("__rows"))
    before = Window.partitionBy(*keys).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("__before", F.sum("__rows").over(before)).where(F.col("__before") > 0)
    offsets = offsets.select(F.col("__range").alias("__r"), *[F.col(k).alias(f"__g{i}") for i, k in enumerate(keys)], "__before")
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__g{i}")) for i, k in enumerate(keys)], F.col("__range") == F.col("__r"))
    out = laid.withColumn("__in", F.row_number().over(inside)).join(F.broadcast(offsets), same, "left")
    return out.withColumn(name, F.col("__in") + F.coalesce("__before", F.lit(0))).select(*df.columns, name)


def small_group_row_number(df: DataFrame, keys: Sequence[str], order: Sequence[Column | Key | str], name: str = "rn", hot: int = HOT) -> DataFrame:
    """``group_row_number`` where nearly all groups are small.

    A group of at most ``hot`` rows is numbered by one window, which costs a
    fraction of finding each row's range; larger ones, of which there are at
    most the table's rows over ``hot``, are numbered by ranges.
    """
    order = keys_of(order)
    large = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows")).where(F.col("__rows") > hot)
    large = F.broadcast(large.select(*[F.col(k).alias(f"__h{i}") for i, k in enumerate(keys)]))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__h{i}")) for i, k in enumerate(keys)])
    inside = Window.partitionBy(*keys).orderBy(*[k.order() for k in order])
    small = df.join(large, same, "left_anti").withColumn(name, F.row_number().over(inside).cast("bigint"))
    return small.unionByName(group_row_number(df.join(large, same, "left_semi"), keys, order, name))


def global_row_number(df: DataFrame, order: Sequence[Column | Key | str], name: str = "rn") -> DataFrame:
    """1-based position of every row in one total order, computed in parallel.

    A window without a partition key would move the table into one task; here
    such a window runs over one row per range.  ``order`` must end in a unique key.
    """
    return group_row_number(df, [], order, name)


def paginate(df: DataFrame, order: Sequence[Column | Key | str], size: int = 100) -> DataFrame:
    """Add the 1-based page number of every row in the listing order."""
    numbered = global_row_number(df, order, "__rn")
    page = (F.floor((F.col("__rn") - 1) / F.lit(size)) + 1).cast("int")
    return numbered.withColumn("page", page).drop("__rn")


def page_slice(df: DataFrame, page: int) -> DataFrame:
    return df.where(F.col("page") == page)


def page_count(df: DataFrame, size: int = 100) -> DataFrame:
    total = F.count(F.lit(1))
    pages = F.greatest(F.lit(1), F.ceil(total / F.lit(size)).cast("int"))
    return df.agg(total.alias("n_rows"), pages.alias("pages"))


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """Report of the first ``k`` rows (planned as TakeOrderedAndProject)."""
    return df.orderBy(*order).limit(k)
