"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardhouse.llm.common import written


def connected(links: DataFrame) -> DataFrame:
    """(node, comp) of every node in the links (a, b); comp is the component's smallest node.

    Each round writes its links to the shared folder. A large star links every
    greater neighbour of a node to the least one around it, a small star every
    smaller one; what is left when nothing changes is one star for each
    component. Minima are taken before the shuffle; a node with many links is
    met by a join, which splits it.
    """
    now = written(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(),
        "links",
    )
    mark = None
    while True:
        both = now.union(now.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (
            both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        )
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = (
            small.select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v"))
            .where("u <> v")
            .union(least)
            .distinct()
        )
        now = written(small, "links")
        said = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if said == mark:
            break
        mark = said
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("comp")).union(roots)
