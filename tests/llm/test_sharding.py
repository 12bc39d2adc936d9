"""Sharding: law, slots, whole rows, buckets against a plain hash, and repeated rows."""

import math

import pytest
import xxhash
from pyspark.sql import functions as F

from tabwright.llm import sharding


def _rows(df):
    return [(r.shard, r.slot, r.row.doc_id, r.row.text) for r in df.collect()]


def _check(found, docs, shards):
    assert sorted((r[2:] for r in found), key=repr) == sorted(((r.doc_id, r.text) for r in docs.collect()), key=repr)
    sizes = [sum(r[0] == s for r in found) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    for s in range(shards):
        assert sorted(r[1] for r in found if r[0] == s) == list(range(sizes[s]))


@pytest.mark.parametrize("shards,bucket_bytes", [(40, 1 << 20), (7, 2000), (1, 500), (500, 5000)])
def test_counts_and_slots(edge_docs, shards, bucket_bytes):
    """Rows with null and repeated ids, repeated rows, and columns with clashing names, in one bucket and in many."""
    docs = edge_docs.withColumns({"shard": F.lit(1), "slot": F.lit("x"), "bucket": F.lit(0), "row": F.lit(None).cast("string")})
    out = sharding.shuffled(docs, shards, bucket_bytes=bucket_bytes)
    assert out.columns == ["shard", "slot", "row"] and out.select("row.*").columns == docs.columns
    _check(_rows(out), docs, shards)


def test_order_is_the_same_for_any_partitioning(edge_docs):
    orders = [sorted(_rows(sharding.shuffled(edge_docs.repartition(n), 5, bucket_bytes=3000)), key=repr) for n in (1, 4, 9)]
    assert orders[0] == orders[1] == orders[2]
    assert orders[0] != sorted(_rows(sharding.shuffled(edge_docs, 5, seed=1, bucket_bytes=3000)), key=repr)


def test_buckets_lie_end_to_end(spark):
    """Places run through the buckets of a hash that is worked out here anew, and inside a bucket they are mixed."""
    texts = [f"text {i} é" * (1 + i % 5) for i in range(600)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    total = sum(len(t.encode()) + sharding.RECORD_BYTES for t in texts)
    buckets = math.ceil(total / 4000)

    def bucket(i):
        h = 42
        for part in ((sharding.SEED).to_bytes(4, "little"), i.to_bytes(8, "little"), texts[i].encode()):
            h = xxhash.xxh64_intdigest(part, h)
        return (h - (1 << 64) if h >> 63 else h) % buckets

    found = sorted(_rows(sharding.shuffled(docs, 1, bucket_bytes=4000)), key=lambda r: r[1])
    dealt = [bucket(r[2]) for r in found]
    assert dealt == sorted(dealt) and len(set(dealt)) > 5
    inside = [[r[2] for r, b in zip(found, dealt, strict=True) if b == k] for k in set(dealt)]
    assert sum(ids != sorted(ids) for ids in inside) > len(inside) / 2


def test_copies_of_one_row_fill_no_bucket(spark):
    """Where a third of all rows are the same in id and text, they are numbered and dealt like the rest."""
    docs = spark.range(9000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("doc_id"))
    docs = docs.withColumn("text", F.when(F.col("doc_id") == 7, F.lit("the same text")).otherwise(F.concat(F.lit("text "), "doc_id")))
    deal = sharding._deal(docs, "doc_id", "text", sharding.SEED, 10_000)
    most, mean = deal.held.agg(F.max("n"), F.avg("n")).first()
    assert most < 2 * mean and deal.buckets > 10
    _check(_rows(sharding.shuffled(docs, 8, bucket_bytes=10_000)), docs, 8)


def test_no_rows_and_written_shards(spark, no_docs, edge_docs, tmp_path):
    assert sharding.shuffled(no_docs).count() == 0
    with pytest.raises(ValueError):
        sharding.shuffled(edge_docs, 0)
    sharding.write_shards(edge_docs, f"{tmp_path}/out", 4)
    back = spark.read.parquet(f"{tmp_path}/out")
    assert back.count() == edge_docs.count() and sorted(r.shard for r in back.select("shard").distinct().collect()) == [0, 1, 2, 3]
