"""Networks, points, lines and grids derived from the driver's tables, in Spark SQL and in DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_BOTH = {
    "net_edges": "select concat('P', p_partkey) code, p_partkey node_start, p_partkey {div} 2 node_end, cast(p_size as double) own, p_retailprice length from part where p_partkey >= 1"
    " union all select concat('Q', p_partkey), p_partkey, p_partkey {div} 3, cast(0 as double), p_retailprice from part where p_partkey >= 7 and p_partkey % 7 = 0",
    "net_nodes": "select p_partkey node_id, cast((p_partkey * 37) % 1009 as double) x, cast((p_partkey * 91) % 997 as double) y from part",
    "pts_a": "select c_custkey id, cast((c_custkey * 17) % 1000 as double) x, cast((c_custkey * 29) % 1000 as double) y from customer",
    "pts_b": "select s_suppkey id, cast((s_suppkey * 53) % 1000 as double) x, cast((s_suppkey * 71) % 1000 as double) y from supplier",
    "cells": "select o_orderkey {div} 100 r, o_orderkey % 100 c, o_totalprice v, o_custkey % 25 zone from orders",
}
_SPARK = {
    "lines": "select vec_id id, transform(sequence(0, 31), i -> named_struct('x', cast(embedding[2 * i] as double), 'y', cast(embedding[2 * i + 1] as double))) coords from embeddings",
    "tracks": "select user_id id, transform(array_sort(collect_list(struct(ts, event_id, value))), e -> named_struct('x', cast(e.event_id as double), 'y', e.value)) coords from events group by user_id",
}
_DUCK = {
    "lines": "select vec_id id, list_transform(range(0, 32), lambda i: {'x': CAST(embedding[2 * i + 1] AS DOUBLE), 'y': CAST(embedding[2 * i + 2] AS DOUBLE)}) coords from embeddings",
    "tracks": "select user_id id, list({'x': CAST(event_id AS DOUBLE), 'y': value} order by ts, event_id) coords from events group by user_id",
}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The derived view, over freshly read tables."""
    text = _BOTH[name].format(div="div") if name in _BOTH else _SPARK[name]
    for t in ("part", "customer", "supplier", "orders", "embeddings", "events"):
        if f"from {t}" in text:
            text = text.replace(f"from {t}", f"from {{{t}}}")
    used = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("part", "customer", "supplier", "orders", "embeddings", "events") if f"{{{t}}}" in text}
    return spark.sql(text, **used)


def duck(*names: str) -> str:
    """A WITH clause of the views for DuckDB."""
    return "WITH " + ", ".join(f"{n} AS ({_BOTH[n].format(div='//') if n in _BOTH else _DUCK[n]})" for n in names)
