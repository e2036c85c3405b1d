"""Dense, stable surrogate keys.

A key map gives each natural key a number.  Keys that the map has keep their
numbers; new ones get the next numbers, gapless and in key order.  They are
numbered by range partitions: each partition counts its keys, a running sum
over the partitions' counts gives each one's first number, so that no task
sees more than its range.  Unlike a hash, two keys never share a number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelmart.session import cut_lineage


def number(rows: DataFrame, order: list[str], name: str, first=0) -> DataFrame:
    """``rows`` with gapless numbers in ``order``, from ``first`` on.  The
    rows must differ in ``order``; they are written once, sorted by ranges."""
    stored = cut_lineage(rows.repartitionByRange(*order).sortWithinPartitions(*order)
                         .withColumn("_row", F.monotonically_increasing_id()), "numbered")
    stored = stored.withColumn("_part", F.shiftright("_row", 33))
    parts = stored.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_start"))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)  # a row per partition
    parts = parts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_start"))
    return (stored.join(F.broadcast(parts.select("_part", "_before")), "_part")
            .withColumn(name, (F.col("_row") + F.col("_before") + F.lit(first)).cast("long"))
            .select(*rows.columns, name))


def extend(keys: DataFrame, known: DataFrame | None, on: list[str], name: str = "fact_id") -> DataFrame:
    """The key map with all of ``keys`` in it: columns ``on`` and ``name``.

    ``known`` is the map so far (None: none).  Numbers begin at 1.  Null
    values in a key are values like others; repeated keys get one number.
    """
    keys = keys.select(*on).distinct()
    if known is None:
        return number(keys, on, name, 1)
    same = None
    for c in on:
        both = keys[c].eqNullSafe(known[c])
        same = both if same is None else same & both
    new = keys.join(known, same, "left_anti")
    top = known.agg(F.coalesce(F.max(name), F.lit(0))).first()[0]
    return known.select(*on, name).unionByName(number(new, on, name, top + 1))


def attach(rows: DataFrame, keymap: DataFrame, on: list[str], name: str = "fact_id") -> DataFrame:
    """``rows`` with their numbers in front; every key must be in the map."""
    same = None
    for c in on:
        both = rows[c].eqNullSafe(keymap[c])
        same = both if same is None else same & both
    plain = [rows[c] for c in rows.columns if c != name]
    return rows.join(keymap, same, "left").select(keymap[name], *plain)
