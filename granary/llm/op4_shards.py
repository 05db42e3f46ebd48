"""Sharding by weighted rendezvous hashing of stable record keys.

Every shard scores every key, ``ln(u) / weight`` with u from 52 bits of md5(key|shard); the highest score takes the
record (ties: the smaller shard). A further shard only adds a score, so it takes records into itself and moves none
between the others; a shard's weight is its expected share.

Slots number a shard's rows from 0 without gaps. They need no task that holds a whole shard: rows fall into
``buckets`` hash ranges a shard, the ranges' counts (``shards * buckets`` rows at most, which bounds the broadcast)
give each range its offset, and a window numbers the rows of one range.

Defined cases: a null key counts as the text ``null``; a null text has no bytes (size 1, crc32 0); equal keys meet in one
shard and repeated rows each get a slot of their own; an empty table gives no rows. A third of all rows under one key
still spread over ranges, which also hash the text's crc32 and size; wholly identical rows are counted first and share a range as one row; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import Plain

#: Copies of one row that are written out together.
RUN = 10_000


def _hash52(key: Column, salt: str) -> Column:
    return F.conv(F.substring(F.md5(F.concat(key, F.lit(f"|{salt}"))), 1, 13), 16, 10).cast("long")


def rendezvous(key: Column, weights: list[float]) -> Column:
    """Index of the shard with the highest score."""
    scores = [F.struct((F.log((_hash52(key, str(i)) + F.lit(0.5)) / F.lit(float(2**52))) / F.lit(float(w))).alias("s"), F.lit(-i).alias("i")) for i, w in enumerate(weights)]
    best = F.greatest(*scores) if len(scores) > 1 else scores[0]
    return -best["i"]


def shard_table(docs: DataFrame, weights: list[float], key: str = "doc_id", text: str = "text", grown_weight: float | None = None, buckets: int = 2048) -> DataFrame:
    """One row a record: key, size, text_crc32, law, shard, slot, grown_shard (with one more shard of grown_weight)."""
    p = Plain(docs)
    own = F.col(p[key])
    name = F.coalesce(own.cast("string"), F.lit("null"))
    grown = weights + [grown_weight if grown_weight is not None else weights[-1]]
    body = F.coalesce(F.col(p[text]), F.lit(""))
    rows = p.df.select(own.alias("doc_id"), name.alias("_key"), (F.octet_length(body).cast("long") + 1).alias("size"), F.crc32(body.cast("binary")).alias("text_crc32"))
    # Identical rows are counted before anything moves and come apart again at the end.
    rows = rows.groupBy("doc_id", "_key", "size", "text_crc32").agg(F.count("*").alias("_times"))
    rows = rows.withColumn("shard", rendezvous(F.col("_key"), weights).cast("int")).withColumn("grown_shard", rendezvous(F.col("_key"), grown).cast("int"))
    spread = F.concat_ws("|", F.col("_key"), F.col("text_crc32"), F.col("size"))
    rows = rows.withColumn("_bucket", F.pmod(_hash52(spread, "slot"), F.lit(buckets).cast("long")).cast("int"))
    counts = rows.groupBy("shard", "_bucket").agg(F.sum("_times").alias("n"))
    before = F.sum("n").over(W.partitionBy("shard").orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1))
    offsets = counts.select("shard", "_bucket", F.coalesce(before, F.lit(0)).cast("long").alias("_offset"))
    inside = F.sum("_times").over(W.partitionBy("shard", "_bucket").orderBy("_key", "text_crc32", "size").rowsBetween(W.unboundedPreceding, -1))
    numbered = rows.withColumn("_n", F.coalesce(inside, F.lit(0)))
    out = numbered.join(F.broadcast(offsets), ["shard", "_bucket"])  # at most len(weights) * buckets rows
    # Copies come apart by runs of RUN, so that no array grows with their number.
    out = out.withColumn("_run", F.explode(F.expr(f"sequence(0L, (_times - 1) div {RUN})")))
    out = out.withColumn("_copy", F.explode(F.expr(f"sequence(_run * {RUN}, least((_run + 1) * {RUN}, _times) - 1)")))
    out = out.withColumn("slot", F.col("_offset") + F.col("_n") + F.col("_copy"))
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
