"""Joining facts to a dimension when a few keys hold much of the facts."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Tasks that merge the sketches of all map tasks before the last one does.
_MERGERS = 256
# What a sketch may follow at most.
_MOST_TRACKED = 1_000_000


def small(df: DataFrame) -> bool:
    """Whether Spark will broadcast the frame in a join, by its estimate of the bytes it reads."""
    limit = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold")
    if limit.startswith("-"):
        return False
    most = df.sparkSession._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(limit)
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(size)) <= most


def bucketed(df: DataFrame, keys: Sequence[str]) -> bool:
    """Whether the frame reads files bucketed on the keys only, so that a join on them leaves it where it is."""

    def on_keys(leaf) -> bool:
        relation = leaf.relation() if leaf.getClass().getSimpleName() == "LogicalRelation" else None
        if relation is None or relation.getClass().getSimpleName() != "HadoopFsRelation":
            return False
        spec = relation.bucketSpec()
        return spec.isDefined() and spec.get().bucketColumnNames().mkString("\n") == "\n".join(keys)

    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return leaves.length() > 0 and all(on_keys(leaves.apply(n)) for n in range(leaves.length()))


def _code(keys: Sequence[str]) -> Column:
    return F.xxhash64(*keys)


def hot_keys(facts: DataFrame, keys: Sequence[str]) -> dict[int, int]:
    """The hot keys of one set of key columns; see :func:`hot_keys_of`."""
    return hot_keys_of(facts, [keys])[0]


def hot_keys_of(facts: DataFrame, key_sets: Sequence[Sequence[str]]) -> list[dict[int, int]]:
    """For each set of key columns, the keys with more rows than an average shuffle partition.

    Keys are given by hash code, with the number of partitions' worth of rows
    they extend over. There are fewer of them than shuffle partitions, and the
    sketches are sized by that number. One pass over all key columns, merged in
    two steps; nothing is shuffled by key. A sketch may miss a key near the
    limit, which only affects where rows are joined, never the result.
    """
    parts = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tracked = min(_MOST_TRACKED, max(2000, 10 * parts))
    names = [f"_sketch{n}" for n in range(len(key_sets))]
    row = (
        facts.select(*[_code(keys).alias(f"_code{n}") for n, keys in enumerate(key_sets)])
        .groupBy((F.spark_partition_id() % _MERGERS).alias("_merger"))
        .agg(
            F.count("*").alias("n"),
            *[
                F.expr(f"approx_top_k_accumulate(_code{n}, {tracked})").alias(name)
                for n, name in enumerate(names)
            ],
        )
        # Grouped on a constant, so that no rows give no sketch.
        .groupBy(F.lit(0).alias("_all"))
        .agg(
            F.sum("n").alias("n"),
            *[F.expr(f"approx_top_k_combine({name}, {tracked})").alias(name) for name in names],
        )
        .select(
            "n",
            *[
                F.expr(f"approx_top_k_estimate({name}, {min(parts, tracked)})").alias(name)
                for name in names
            ],
        )
        .first()
    )
    if row is None:
        return [{} for _ in key_sets]
    return [
        {
            t["item"]: math.ceil(t["count"] * parts / row["n"])
            for t in row[name]
            if t["count"] * parts > row["n"] and t["count"] > 1
        }
        for name in names
    ]


def join_dimension(
    facts: DataFrame,
    dimension: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    spread_by: Sequence[str] | None = None,
    hot_in: DataFrame | None = None,
    hot: dict[int, int] | None = None,
) -> DataFrame:
    """Join facts to rows that are unique on the key, without hot tasks.

    Where the dimension is small enough to be broadcast, or no key is hot, this is
    a plain join, and in the first case the facts are not looked through. Otherwise the facts of a hot key
    are dealt out by a hash of ``spread_by`` (by default the whole row) and its
    dimension row is repeated once per share; all shares together are at most
    as many as there are shuffle partitions and hot keys. Every fact still meets
    exactly one copy of its dimension row.

    ``spread_by`` should tell facts apart, such as their own key. ``hot_in`` is
    the table whose key columns are looked through, by default the facts: name
    it where the facts are themselves the result of a join. ``hot`` gives the
    hot keys where the caller has found them. The key columns must have the same
    names and types on both sides.
    """
    fact_types, dimension_types = dict(facts.dtypes), dict(dimension.dtypes)
    for key in keys:
        if fact_types[key] != dimension_types[key]:
            raise ValueError(
                f"{key} is {fact_types[key]} in the facts, {dimension_types[key]} in the dimension"
            )
    if hot is None:
        # A dimension that is broadcast meets the facts where they are.
        broadcast = how in ("inner", "left", "left_semi", "left_anti") and small(dimension)
        hot = {} if broadcast else hot_keys(facts if hot_in is None else hot_in, keys)
    if not hot:
        return facts.join(dimension, list(keys), how)
    # Fewer rows than shuffle partitions.
    shares = F.broadcast(
        facts.sparkSession.createDataFrame(list(hot.items()), "_code long, _shares long")
    )

    def with_shares(df: DataFrame) -> DataFrame:
        coded = df.withColumn("_code", _code(keys)).join(shares, "_code", "left")
        return coded.withColumn("_shares", F.coalesce("_shares", F.lit(1).cast("bigint")))

    dealt = with_shares(facts).withColumn(
        "_share", F.pmod(F.xxhash64(*(spread_by or facts.columns)), "_shares")
    )
    repeated = with_shares(dimension).withColumn(
        "_share", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_shares") - 1))
    )
    joined = dealt.drop("_code", "_shares").join(
        repeated.drop("_code", "_shares"), [*keys, "_share"], how
    )
    return joined.drop("_share")
