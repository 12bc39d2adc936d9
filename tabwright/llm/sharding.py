"""Sharding by a two-pass external shuffle: scatter records into memory-sized buckets, then Fisher-Yates in each.

Pass 1 deals records evenly to buckets by a seeded hash of id and text; Spark's shuffle holds the buckets on disk. Pass 2
reads a bucket at a time, puts it into an order that does not depend on how it arrived, and permutes it with ``shuffle``,
which is Spark's Fisher-Yates. Buckets end to end are one random order of the corpus, cut into shards of equal counts.
Only DataFrame functions are used.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabwright.functions.columns import quoted
from tabwright.functions.stage import materialise

SEED = 42
#: Bytes of records that one bucket holds on average (a longer document makes its bucket longer).
BUCKET_BYTES = 16 << 20
#: What a record counts beside its text.
RECORD_BYTES = 16
#: More buckets than this share partitions, one after the other.
MOST_PARTITIONS = 20_000
#: Offsets of so many buckets may be broadcast (16 bytes each).
BROADCAST_BUCKETS = 1_000_000


def record_size(text: Column) -> Column:
    return F.coalesce(F.octet_length(text.cast("string")), F.lit(0)).cast("long") + RECORD_BYTES


@dataclass(frozen=True)
class _Deal:
    """Records with their bucket, the number of buckets and of records, and what each bucket holds."""

    records: DataFrame
    buckets: int
    rows: int
    held: DataFrame


def _deal(docs: DataFrame, id_col: str, text_col: str, seed: int, bucket_bytes: int) -> _Deal:
    text = F.coalesce(quoted(text_col).cast("string"), F.lit(""))
    size = record_size(quoted(text_col))
    total = docs.agg(F.sum(size).alias("bytes"), F.count("*").alias("rows")).first()
    buckets = max(1, -(-(total.bytes or 0) // bucket_bytes))

    def dealt(df: DataFrame, *salt: str) -> tuple[DataFrame, DataFrame]:
        mark = F.xxhash64(F.lit(seed), quoted(id_col), text, *map(quoted, salt))
        row = F.struct(*[quoted(c) for c in docs.columns]).alias("row")
        records = df.select(F.pmod(mark, F.lit(buckets)).alias("bucket"), mark.alias("mark"), size.alias("size"), row)
        held = records.groupBy("bucket").agg(F.count("*").alias("n"), (F.sum("size") - F.max("size")).alias("bytes"))
        return records, materialise(held)

    records, held = dealt(docs)
    fullest = held.agg(F.max("bytes")).first()[0] or 0
    if fullest > 4 * bucket_bytes and buckets > 1:
        # many rows repeat id and text: each gets a number of its own, written so that no retry deals it anew
        salt = "__salt"
        while salt in docs.columns:
            salt += "_"
        records, held = dealt(materialise(docs.withColumn(salt, F.monotonically_increasing_id())), salt)
    return _Deal(records, buckets, total.rows, held)


def shuffled(
    docs: DataFrame,
    shards: int = 40,
    seed: int = SEED,
    bucket_bytes: int = BUCKET_BYTES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(shard, slot, row): every row of ``docs`` whole, in a random order, cut into ``shards`` parts.

    Counts of shards differ by at most one; slots of a shard run from 0 without gaps. The order depends on rows, seed and
    sizes only. Null ids and texts are hashed like any value, a row that repeats is dealt as often as it occurs, fewer
    rows than shards leave shards empty, an empty table gives no rows. ``row`` is a struct, so no names can clash.
    """
    if shards < 1:
        raise ValueError(f"number of shards must be >= 1, got {shards}")
    deal = _deal(docs, id_col, text_col, seed, bucket_bytes)
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)  # one row for each bucket
    offsets = deal.held.select("bucket", F.coalesce(F.sum("n").over(before), F.lit(0).cast("long")).alias("before"))
    if deal.buckets <= BROADCAST_BUCKETS:
        offsets = F.broadcast(offsets)
    parts = min(deal.buckets, MOST_PARTITIONS)
    scattered = deal.records.select("bucket", "mark", "row").repartition(parts, "bucket")
    # sorted by mark, a bucket is the same list after every run; its groups need no further shuffle
    whole = scattered.sortWithinPartitions("bucket", "mark").groupBy("bucket").agg(F.collect_list("row").alias("rows"))
    mixed = whole.select("bucket", F.shuffle("rows", seed).alias("rows"))
    drawn = mixed.select("bucket", F.posexplode("rows").alias("nth", "row")).join(offsets, "bucket")
    place, count = F.col("before") + F.col("nth"), max(deal.rows, 1)
    numbered = drawn.select(place.alias("place"), F.expr(f"((before + nth) * {shards}L) DIV {count}L").alias("shard"), "row")
    first = F.expr(f"(shard * {count}L + {shards - 1}L) DIV {shards}L")
    return numbered.select(F.col("shard").cast("int").alias("shard"), (F.col("place") - first).alias("slot"), "row")


def write_shards(docs: DataFrame, folder: str, shards: int = 40, seed: int = SEED, **names: str) -> None:
    """Write the shards of ``docs`` as ``folder/shard=<n>`` with columns ``slot`` and ``row``; nulls and empty tables as above."""
    shuffled(docs, shards, seed, **names).write.partitionBy("shard").mode("errorifexists").parquet(folder)
