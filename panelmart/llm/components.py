"""Connected components by alternating stars, on Spark throughout."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelmart.llm.common import cut_lineage


def components(links: DataFrame) -> DataFrame:
    """``id`` and ``component`` (smallest id reachable) of all ids in the
    links (columns a, b).  Self links and repeats do no harm; no links: none.

    Each round points every id's larger neighbours at its smallest one, then
    its smaller neighbours, until every component is a star.  The links of
    a round are a written table; hot ids are joined by Spark's skew handling.
    """
    pairs = links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    pairs = cut_lineage(pairs, "links")
    mark = None
    while True:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        pairs = cut_lineage(small, "links")
        seen = pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == mark:
            break
        mark = seen
    return pairs.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
        pairs.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
