"""Vector bin packing of documents into shards.

Groups of equal texts are weighed in bytes, tokens and rows.  Each group goes
to the shard where the dot product of its weights with the shard's residual
capacity is highest, largest groups first.  Groups are packed in blocks, one
task each; the blocks' bins are then packed in the same way, level by level,
until one block is left.  A group that is large beside a shard is first
split into chunks, so that a text with a third of all rows spreads evenly.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelmart.llm.common import cut_lineage, prepare, rank_within

SHARDS = 40
OVERHEAD = 16
#: A group is split where it holds more than this part of a shard.
PART_OF_SHARD = 32
#: Groups packed in one task, and bins of lower blocks packed in one task.
BLOCK = 20_000
DIMENSIONS = ["bytes", "tokens", "rows"]


def vector_pack(weights: np.ndarray, bins: int) -> np.ndarray:
    """Bin of each row of ``weights`` (items x dimensions).

    Items go in falling order of their largest share of a bin; each to the
    bin with the highest dot product of item and residual capacity, ties to
    the lower bin.
    """
    total = weights.sum(axis=0).astype(float)
    share = weights / np.where(total > 0, total / bins, 1.0)
    left = np.ones((bins, weights.shape[1]))
    out = np.empty(len(weights), np.int32)
    for i in np.argsort(-share.max(axis=1), kind="stable"):
        out[i] = b = int(np.argmax(left @ share[i]))
        left[b] -= share[i]
    return out


def _pack_level(items: DataFrame, key: list[str], bins: int) -> DataFrame:
    """Pack each ``block`` of ``items`` (key, block, DIMENSIONS): adds bin."""
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in items.schema
                       if f.name in [*key, "block", *DIMENSIONS])

    def pack(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values(key, kind="stable", ignore_index=True)
        return block.assign(bin=vector_pack(block[DIMENSIONS].to_numpy(np.int64), bins))

    pack.__annotations__ = {"block": pd.DataFrame, "return": pd.DataFrame}
    return items.select(*key, "block", *DIMENSIONS).groupBy("block").applyInPandas(
        pack, f"{fields}, bin int")


def shard(docs: DataFrame, shards: int = SHARDS, overhead: int = OVERHEAD) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot of every row.

    Reads doc_id and text only.  Size is the UTF-8 bytes of the text (null:
    none) plus ``overhead``; tokens are counted as runs of non-blanks.  A null
    text counts as the empty text in its crc and its group.  Repeated rows
    are separate rows; an empty table gives an empty result.
    """
    prepare(docs.sparkSession)
    text = F.coalesce("text", F.lit(""))
    rows = cut_lineage(docs.select(
        F.col("doc_id").cast("long"),
        (F.octet_length(text) + overhead).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.regexp_count(text, F.lit(r"\S+")).cast("long").alias("tokens"),
        F.unhex(F.md5(text)).alias("text_md5"), F.monotonically_increasing_id().alias("number")), "shard_rows")
    weights = [F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"),
               F.count(F.lit(1)).alias("rows")]
    groups = rows.groupBy("text_md5").agg(*weights)
    total = groups.agg(*[F.sum(c).alias(c) for c in DIMENSIONS], F.count(F.lit(1)).alias("n")).first()
    # at most shards * PART_OF_SHARD groups a dimension can be above the limit
    chunks = F.greatest(*[F.ceil(F.col(c) * (shards * PART_OF_SHARD / max(total[c] or 1, 1)))
                          for c in ("bytes", "rows")])
    large = (groups.where("rows > 1").select("text_md5", F.least(chunks, "rows").cast("int").alias("chunks"))
             .where("chunks > 1"))
    rows = (rows.join(F.broadcast(large), "text_md5", "left")
            .withColumn("chunk", F.coalesce(F.pmod(F.xxhash64("number"), "chunks"), F.lit(0)).cast("int")))
    blocks = max(1, -(-(total["n"] or 0) // BLOCK))
    key = ["text_md5", "chunk"]
    items = rows.groupBy(*key).agg(*weights).withColumn(
        "block", F.pmod(F.xxhash64(*key), F.lit(blocks)).cast("long"))
    packed = cut_lineage(_pack_level(items, key, shards), "shard_groups")
    where = _merge_blocks(packed, blocks, shards)
    placed = packed.select(*key, "block", "bin").join(where, ["block", "bin"]).select(*key, "shard")
    out = cut_lineage(rows.join(placed, key).select("doc_id", "size", "text_crc32", "shard"), "sharded")
    return rank_within(out, ["shard"], ["doc_id", "text_crc32"], "slot")


def _merge_blocks(packed: DataFrame, blocks: int, shards: int) -> DataFrame:
    """block, bin -> shard: pack the blocks' bins, some blocks at a time."""
    sums = [F.sum(c).alias(c) for c in DIMENSIONS]
    where = packed.select("block", "bin").distinct().withColumns(
        {"top": F.col("block"), "shard": F.col("bin")})
    level = packed.groupBy("block", "bin").agg(*sums)
    per = max(2, BLOCK // shards)
    while blocks > 1:
        blocks = -(-blocks // per)
        level = level.withColumnsRenamed({"block": "from", "bin": "from_bin"}).withColumn(
            "block", F.floor(F.col("from") / per).cast("long"))
        level = cut_lineage(_pack_level(level, ["from", "from_bin"], shards), "shard_level")
        step = level.select(F.col("from").alias("top"), F.col("from_bin").alias("shard"),
                            F.col("block").alias("to"), F.col("bin").alias("to_bin"))
        where = where.join(step, ["top", "shard"]).select(
            "block", "bin", F.col("to").alias("top"), F.col("to_bin").alias("shard"))
        level = level.groupBy("block", "bin").agg(*sums)
    return where.select("block", "bin", "shard")
