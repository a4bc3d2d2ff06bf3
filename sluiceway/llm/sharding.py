"""Two-pass external shuffle into shards, with DataFrame functions only.

Pass 1 scatters whole records over buckets by a seeded hash; a bucket holds about `bucket_rows` records and
`bucket_bytes` bytes at most on average. Equal records are counted first and take a running number into the
hash, so a record that makes up a third of the input is scattered like any other; a record with more than
`COPIES` copies is dealt out in runs of so many before they are written out. Pass 2 brings each bucket
together and sorts it by a second seeded hash, ties by the record; the sort spills, and besides it a task
holds one bucket. Buckets follow one another; their record counts give each record its place in the whole,
and equal ranges of places are the shards. Only the bucket counts, one row for each bucket, meet in one task.

Law `rows`: the counts of any two shards differ by one at most. `slot` numbers a shard's records from 0
without a gap in their new order. The same input and seed give the same result however the input is
partitioned. Nulls are values like others; an empty table gives an empty result; more shards than
records leave some shards empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Records and bytes in a bucket on average; copies of a record that one task writes out.
BUCKET_ROWS = 4096
BUCKET_BYTES = 4 << 20
COPIES = 1024
SEED = 20_240_607


def _bytes(df: DataFrame) -> Column:
    """About how many bytes a row takes."""
    total = F.lit(8)
    for f in df.schema.fields:
        col = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
            total = total + F.coalesce(F.octet_length(F.to_json(F.struct(col))), F.lit(0))
        elif isinstance(f.dataType, (T.StringType, T.BinaryType)):
            total = total + F.coalesce(F.octet_length(col), F.lit(0))
        else:
            total = total + F.lit(8)
    return total.cast("long")


def bucket_count(df: DataFrame, bucket_rows: int = BUCKET_ROWS, bucket_bytes: int = BUCKET_BYTES) -> tuple[int, int]:
    """How many records there are, and how many buckets keep to both averages."""
    total, size = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(_bytes(df)), F.lit(0))).first()
    return total, max(1, -(-total // bucket_rows), -(-size // bucket_bytes))


def place(df: DataFrame, n_shards: int = 8, seed: int = SEED, bucket_rows: int = BUCKET_ROWS, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """All records and columns of `df` in the struct `record`, with shard int and slot long."""
    names = df.columns
    total, n_buckets = bucket_count(df, bucket_rows, bucket_bytes)
    packed = df.select(F.struct(*[F.col(f"`{n}`") for n in names]).alias("record"))
    counted = packed.groupBy("record").agg(F.count(F.lit(1)).alias("n"))
    few = counted.where(F.col("n") <= COPIES).select("record", F.lit(1).cast("long").alias("low"), F.col("n").alias("high"))
    runs = F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"), F.lit(COPIES).cast("long")))
    many = counted.where(F.col("n") > COPIES).select("record", "n", runs.alias("low")).repartition(F.xxhash64("record", "low"))
    many = many.select("record", "low", F.least(F.col("low") + (COPIES - 1), F.col("n")).alias("high"))
    single = few.unionByName(many).select("record", F.explode(F.sequence("low", "high")).alias("copy"))
    mix = [F.xxhash64(F.lit(seed), F.lit(k), "record", "copy") for k in range(2)]
    scattered = single.select("record", F.pmod(mix[0], F.lit(n_buckets)).cast("long").alias("bucket"), mix[1].alias("key"))
    sizes = scattered.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"))
    before = F.sum("size").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size")
    offsets = sizes.select("bucket", before.alias("offset"))
    at = F.row_number().over(Window.partitionBy("bucket").orderBy("key", "record")) - 1
    placed = scattered.select("bucket", "record", at.alias("at")).join(offsets, "bucket")
    position = F.col("offset") + F.col("at")
    shard = F.expr(f"(offset + at) * {n_shards} div {max(total, 1)}")
    first = F.expr(f"(shard * {total} + {n_shards - 1}) div {n_shards}")
    return placed.select("record", position.alias("position"), shard.cast("int").alias("shard")).select("record", "shard", (F.col("position") - first).cast("long").alias("slot"))


def shard_digests(df: DataFrame, key: str = "doc_id", text: str = "text", n_shards: int = 8, seed: int = SEED, bucket_rows: int = BUCKET_ROWS, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """key, size, text_crc32, law, shard, slot, grown_shard of every placed record, read from the record (null texts count as empty)."""
    content = F.coalesce(F.col(f"record.`{text}`").cast("string"), F.lit(""))
    return place(df, n_shards, seed, bucket_rows, bucket_bytes).select(
        F.col(f"record.`{key}`").alias(key), (F.octet_length(content) + 1).cast("long").alias("size"), F.crc32(content).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(df: DataFrame, path: str, n_shards: int = 8, seed: int = SEED, bucket_rows: int = BUCKET_ROWS, bucket_bytes: int = BUCKET_BYTES) -> None:
    """Write whole records as Parquet, one folder `shard=N` each; `slot` is kept as a column, files of a shard hold ranges of it."""
    placed = place(df, n_shards, seed, bucket_rows, bucket_bytes)
    placed.select("record.*", F.col("slot").alias("_slot"), "shard").sortWithinPartitions("shard", "_slot").write.partitionBy("shard").parquet(path)
