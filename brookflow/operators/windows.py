"""Numbering, suffixes, de-duplication and ordered lists. Every order has an explicit tie-breaker."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def _first(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    return df.withColumn("_nth", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where("_nth = 1").drop("_nth")


def keep_first(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """The first row of each key."""
    return _first(df, keys, order)


def keep_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key occurs once."""
    return df.withColumn("_n", F.count(F.lit(1)).over(W.partitionBy(*keys))).where("_n = 1").drop("_n")


def unique_codes(df: DataFrame, code: str, order: str) -> DataFrame:
    """The first of a code keeps it, later ones get _1, _2, ...; null counts as the empty code."""
    c = F.coalesce(F.col(code), F.lit(""))
    nth = F.row_number().over(W.partitionBy(c).orderBy(order)) - 1
    return df.withColumn("_nth", nth).withColumn(code, F.when(F.col("_nth") > 0, F.concat(c, F.lit("_"), F.col("_nth").cast("string"))).otherwise(c)).drop("_nth")


def duplicate_suffix(df: DataFrame, code: str, order: str, status: str | None = None) -> DataFrame:
    """Every code that occurs more than once becomes code-0, code-1, ... in order; with `status` such rows are marked "split"."""
    each = W.partitionBy(code)
    many = F.count(F.lit(1)).over(each) > 1
    out = df.withColumn("_many", many).withColumn("_nth", F.row_number().over(each.orderBy(order)) - 1)
    if status:
        out = out.withColumn(status, F.when(F.col("_many"), F.lit("split")).otherwise(F.col(status)))
    return out.withColumn(code, F.when(F.col("_many"), F.concat(code, F.lit("-"), F.col("_nth").cast("string"))).otherwise(F.col(code))).drop("_many", "_nth")


def shifted_sum(df: DataFrame, key: str, order: str, value: str, out: str) -> DataFrame:
    """1 plus the sum of the earlier rows' values."""
    before = W.partitionBy(key).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    return df.withColumn(out, (1 + F.coalesce(F.sum(value).over(before), F.lit(0))).cast("long"))


def tributary_rank(df: DataFrame, node: str, number: str, order: str) -> DataFrame:
    """Numbers that clash at a node go up, in order."""
    return df.withColumn(number, (F.col(number) + F.row_number().over(W.partitionBy(node, number).orderBy(order)) - 1).cast("long"))


def numbered(df: DataFrame, key: str, order: str, out: str, first: Column | int = 1) -> DataFrame:
    """Consecutive numbers within a key."""
    return df.withColumn(out, (F.row_number().over(W.partitionBy(key).orderBy(order)) - 1 + first).cast("long"))


def run_ids(df: DataFrame, order: str, key: str, out: str) -> DataFrame:
    """Runs of equal keys along an order within `part`; the run goes up where the key changes."""
    along = W.partitionBy("part").orderBy(order)
    change = (F.col(key) != F.lag(key).over(along)).cast("long")
    return df.withColumn("_change", F.coalesce(change, F.lit(0))).withColumn(out, F.sum("_change").over(along.rowsBetween(W.unboundedPreceding, 0))).drop("_change")


def pair_shortest(df: DataFrame, a: str, b: str, length: str, order: str) -> DataFrame:
    """The shortest row of each unordered pair."""
    return keep_first(df.withColumn("_lo", F.least(a, b)).withColumn("_hi", F.greatest(a, b)), ["_lo", "_hi"], [length, order]).drop("_lo", "_hi")


def group_minimum(df: DataFrame, key: str, value: str) -> DataFrame:
    """Rows that hold their key's least value."""
    return df.withColumn("_min", F.min(value).over(W.partitionBy(key))).where(F.col(value) == F.col("_min")).drop("_min")


def ordered_list(df: DataFrame, key: str, value: str, order: str, out: str) -> DataFrame:
    """(key, list in order, n)."""
    made = df.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(value).alias("v")))).alias("_l"))
    return made.select(key, F.transform("_l", lambda s: s["v"]).alias(out), F.size("_l").alias("n"))


def first_by(df: DataFrame, key: str, order: list[str], values: list[str]) -> DataFrame:
    """The values of the least row of each key, by one partial aggregate."""
    fields = list(dict.fromkeys([*order, *values]))
    return df.groupBy(key).agg(F.min(F.struct(*fields)).alias("_m")).select(key, *(F.col(f"_m.{v}").alias(v) for v in values))
