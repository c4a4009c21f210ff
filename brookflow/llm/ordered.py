"""Rows of keyed sequences in order, in blocks that split a long sequence over tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brookflow.llm.common import staged

#: A block has 2**BITS neighbouring rows of the global order at most.
BITS = 12

#: The white space of the contracts: the blank and the characters 9 to 13.
BLANKS = " \t\n\x0b\f\r"


def conversation_key(conv_id: str = "conv_id") -> Column:
    """The id's decimal text; one blank for null, so that rows without an id are one conversation."""
    return F.coalesce(F.col(conv_id).cast("string"), F.lit(" "))


def in_order(df: DataFrame, *order: str) -> DataFrame:
    """df, staged, with `at`: numbers that ascend in the order given (nulls first). Range partitions and not keys are the tasks, so one key may fill many."""
    parts = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    by = [F.col(c).asc_nulls_first() for c in order]
    return staged(df.repartitionByRange(parts, *by).sortWithinPartitions(*by).withColumn("at", F.monotonically_increasing_id()), "ordered")


def block(bits: int) -> Column:
    """The block of a row of in_order: neighbours only, as numbers of different partitions differ in higher bits."""
    return F.shiftright("at", bits)
