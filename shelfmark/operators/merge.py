"""Merge policies: how fields of rows that are one thing become one row.

"Falsy" and "blank" differ for booleans and numbers only: blank-fill leaves ``false`` in place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.functions import fixed_values as V


def is_truthy(c: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.BooleanType):
        return F.coalesce(c, F.lit(False))
    if isinstance(kind, T.ArrayType):
        return c.isNotNull()
    return F.coalesce(c != ("" if isinstance(kind, T.StringType) else 0), F.lit(False))


def falsy_fill(target: Column, source: Column, kind: T.DataType) -> Column:
    return F.when(is_truthy(source, kind) & ~is_truthy(target, kind), source).otherwise(target)


def blank_fill(target: Column, source: Column, kind: T.DataType) -> Column:
    empty = target.isNull() | (target == "") if isinstance(kind, T.StringType) else target.isNull()
    return F.when(is_truthy(source, kind) & empty, source).otherwise(target)


def overwrite_defined(target: Column, source: Column) -> Column:
    return F.coalesce(source, target)


def overwrite_truthy(target: Column, source: Column, kind: T.DataType) -> Column:
    return F.when(is_truthy(source, kind), source).otherwise(target)


def union_ordered(target: Column, source: Column) -> Column:
    """All of the left, then what is new on the right; untouched if nothing is new."""
    left = F.coalesce(target, F.array().cast("array<string>"))
    new = F.array_except(F.coalesce(source, F.array().cast("array<string>")), left)
    return F.when(F.size(new) > 0, F.array_union(left, new)).otherwise(target)


def append_absent(target: Column, source: Column) -> Column:
    """As union_ordered, but repeats that the left has stay."""
    left = F.coalesce(target, F.array().cast("array<string>"))
    new = F.array_except(F.coalesce(source, F.array().cast("array<string>")), left)
    return F.when(F.size(new) > 0, F.concat(left, new)).otherwise(target)


def fill_if_empty(target: Column, source: Column) -> Column:
    return F.when(F.coalesce(F.size(target), F.lit(0)) <= 0, source).otherwise(target)


def prefer(first: Column, second: Column) -> Column:
    """The first of two strings that says something: which source of one value is believed before the other."""
    return F.coalesce(F.nullif(first, F.lit("")), F.nullif(second, F.lit("")))


POLICIES = {"falsy": falsy_fill, "blank": blank_fill, "overwrite": overwrite_truthy}
PLAIN = {"defined": overwrite_defined, "union": union_ordered, "append": append_absent, "if_empty": fill_if_empty}


def merge_columns(joined: DataFrame, policy: dict[str, str], target: str = "t", source: str = "s") -> dict[str, Column]:
    """A merged column for each field of ``policy``, over a join aliased ``target`` and ``source``."""
    out = {}
    for field, name in policy.items():
        t, s = F.col(f"{target}.{field}"), F.col(f"{source}.{field}")
        out[field] = POLICIES[name](t, s, joined.select(t).schema[0].dataType) if name in POLICIES else PLAIN[name](t, s)
    return out


def first_truthy(field: str, kind: T.DataType, order: str = "_ord") -> Column:
    """Ordered aggregate: the first truthy value, else the first row's."""
    c = F.col(field)
    picked = F.min_by(c, F.when(is_truthy(c, kind), F.col(order)))
    return F.coalesce(picked, F.min_by(c, F.col(order)))


def ordered_append(field: str, order: str = "_ord") -> Column:
    """Ordered aggregate of arrays: the first row's as it is, then values not seen before."""
    lists = F.array_sort(F.collect_list(F.when(F.col(field).isNotNull(), F.struct(F.col(order).alias("o"), F.col(field).alias("v")))))
    first = F.coalesce(F.min_by(F.col(field), F.col(order)), F.array().cast("array<string>"))
    rest = F.array_distinct(F.flatten(F.transform(lists, lambda x: x["v"])))
    got = F.concat(first, F.array_except(rest, first))
    return F.when(F.size(got) > 0, got).otherwise(F.min_by(F.col(field), F.col(order)))


def merge_by_handle(catalog: DataFrame, merge_fields: tuple[str, ...] = V.MERGE_FIELDS, handle: str = "handle", arrays: tuple[str, ...] = ("series",)) -> DataFrame:
    """One row a handle, at its first row's place; rows without a handle pass through.

    Core fields are the first row's, ``merge_fields`` fill up from later rows, arrays append. Partial
    aggregates run before the shuffle; a group's arrays are the only thing that is gathered.
    """
    kinds = {f.name: f.dataType for f in catalog.schema.fields}
    none = ~F.coalesce(F.col(handle) != "", F.lit(False))
    aggs = []
    for name in catalog.columns:
        if name == handle:
            continue
        if name in arrays:
            aggs.append(ordered_append(name).alias(name))
        elif name in merge_fields:
            aggs.append(first_truthy(name, kinds[name]).alias(name))
        else:
            aggs.append(F.min_by(F.col(name), F.col("_ord")).alias(name))
    merged = catalog.filter(~none).groupBy(handle).agg(*aggs)
    return merged.select(*catalog.columns).unionByName(catalog.filter(none))
