"""Two-pass external shuffle into shards, in native Spark expressions.

Pass one scatters records by a seeded hash of their id into buckets that fit in a
task's memory; pass two permutes each bucket by Fisher-Yates (``shuffle`` of an array,
which draws its indices that way) and lays the buckets end to end.  Shards are equal
cuts of that order, so their row counts differ by at most one.

Record identity is the id; a record without one is scattered by its text.  Repeated
records, ties, empty and very long texts are ordinary records; a table without rows
gives no rows.  Extra columns travel inside one struct, so their names cannot clash.

The order depends on ids, texts, seed and the number of buckets only: every bucket has
a task of its own, is sorted before it is permuted, and the generator starts from the
seed and the bucket's number.  A task that runs again writes the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallygraph.llm.common import parts_for, utf8_size

BUCKET_BYTES = 16 << 20         # text of one bucket; a task holds a few copies of it
BROADCAST_BUCKETS = 100_000     # up to here the table of bucket offsets (16 bytes a row) is broadcast


def shuffled(docs: DataFrame, key: str = "doc_id", text: str = "text", seed: int = 11,
             bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``record`` (struct of all columns), ``position`` from 0 in the shuffled order, ``total`` rows."""
    total, size = docs.agg(F.count(F.lit(1)), F.sum(utf8_size(F.col(text)) + 16)).first()
    buckets = parts_for(size, bucket_bytes)
    by_id = F.xxhash64(F.lit(seed), F.col(key))
    scatter = F.when(F.col(key).isNull(), F.xxhash64(F.lit(seed), F.col(text))).otherwise(by_id)
    numbered = docs.select(F.pmod(scatter, F.lit(buckets)).cast("int").alias("bucket"),
                           F.struct(*[docs[c] for c in docs.columns]).alias("record"))
    gathered = (numbered.repartitionById(buckets, "bucket")
                .sortWithinPartitions("bucket", f"record.{key}", f"record.{text}")
                .groupBy("bucket").agg(F.collect_list("record").alias("records")))
    permuted = gathered.select("bucket", F.shuffle("records", seed).alias("records"))
    offsets = (numbered.groupBy("bucket").count()
               .select("bucket", (F.sum("count").over(Window.orderBy("bucket")) - F.col("count")).alias("before")))
    if buckets <= BROADCAST_BUCKETS:
        offsets = F.broadcast(offsets)
    placed = permuted.join(offsets, "bucket").select("before", F.posexplode("records").alias("at", "record"))
    return placed.select("record", (F.col("before") + F.col("at")).alias("position"),
                         F.lit(total).cast("bigint").alias("total"))


def shards(docs: DataFrame, n_shards: int, key: str = "doc_id", text: str = "text", seed: int = 11,
           bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``record``, ``shard`` and the gapless ``slot`` of every record in its shard."""
    rows = shuffled(docs, key, text, seed, bucket_bytes)
    shard = F.expr(f"position * {n_shards} div total")
    first = F.expr(f"(shard * total + {n_shards - 1}) div {n_shards}")
    return (rows.withColumn("shard", shard.cast("int"))
            .select("record", "shard", (F.col("position") - first).cast("bigint").alias("slot")))


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard; a bucket's task writes its one or few pieces in slot order."""
    sharded.select("record.*", "shard", "slot").write.partitionBy("shard").parquet(path)
