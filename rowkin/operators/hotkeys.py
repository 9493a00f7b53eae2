"""Results per key where a few keys hold most rows: exact offset chunking.

1. Rows are range-sorted by (key, person, id) and written once; the id splits even one person that holds a
   third of all rows, so the files are of nearly equal size whatever the keys are.
2. Each file's rows are counted per key; prefix sums over the files give every (file, key) the number of rows of
   the key before it, and parquet's own row index numbers the rows within a file, so each row has its exact number
   within its key without another sort.
3. A key is cut at multiples of C = ceil(rows / chunks) into chunks of equal size. Only a key with more than C rows
   has more than one; there are fewer than ``chunks`` of those, so their offsets (at most files + chunks rows) are
   broadcast with a proven bound.
4. Chunks are aggregated on their own; since rows of a key are in the order of persons, a chunk's boundary state is
   its first and last person. Chunk states are merged in order: distinct persons add up, less one wherever a chunk
   begins with the person with whom the one before ended.

No task holds more of a key than one file or one chunk, and no row is dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..workspace import dropped, written

CHUNKS = 4096


def key_rollup(rows: DataFrame, key: Column, person: Column, received: Column, row_id: Column, chunks: int = CHUNKS) -> DataFrame:
    """One row per key: key_value, n_rows, n_persons, first_received, last_received.

    Rows whose key is null or '' have no value and give none. ``person`` null or '' counts as no person;
    a null ``received`` is in no minimum or maximum; repeated rows count each; an empty table gives no row.
    """
    slim = rows.select(
        key.alias("key_value"),
        # 128 bits stand for the person: they sort, and take 16 bytes whatever the name is
        F.when(person != "", F.struct(F.xxhash64(person).alias("a"), F.xxhash64(F.lit("rowkin"), person).alias("b"))).alias("person"),
        received.alias("received"),
        row_id.alias("row_id"),
    ).where(F.col("key_value") != "")
    order = ["key_value", "person", "row_id"]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slim = written(slim, "keys")  # else the sample for the ranges computes the keys a second time
    kept = written(slim.repartitionByRange(parts, *order).sortWithinPartitions(*order).drop("row_id"), "hotkeys")
    dropped(slim)
    placed = kept.select(
        "*",
        F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1).cast("int").alias("file"),
        F.col("_metadata.row_index").alias("at"),
    )
    counts = placed.groupBy("key_value", "file").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("start"))
    total = kept.count()
    size = max(1, -(-total // chunks))
    of_key = Window.partitionBy("key_value")
    offsets = (
        counts.withColumn("all", F.sum("n").over(of_key))
        .where(F.col("all") > size)
        .select("key_value", "file", "start", (F.sum("n").over(of_key.orderBy("file")) - F.col("n")).alias("before"))
    )
    number = F.col("before") + F.col("at") - F.col("start")
    chunked = placed.join(F.broadcast(offsets), ["key_value", "file"], "left").withColumn("chunk", F.coalesce(F.floor(number / size), F.lit(0)))
    persons = chunked.groupBy("key_value", "chunk", "person").agg(
        F.count(F.lit(1)).alias("n"), F.min("received").alias("lo"), F.max("received").alias("hi")
    )
    states = persons.groupBy("key_value", "chunk").agg(
        F.sum("n").alias("n"), F.count("person").alias("persons"), F.min("person").alias("head"), F.max("person").alias("tail"),
        F.min("lo").alias("lo"), F.max("hi").alias("hi"),
    )
    carried = F.lag("tail").over(of_key.orderBy("chunk")) == F.col("head")
    return (
        states.withColumn("persons", F.col("persons") - F.coalesce(carried, F.lit(False)).cast("long"))
        .groupBy("key_value")
        .agg(
            F.sum("n").alias("n_rows"),
            F.sum("persons").alias("n_persons"),
            F.min("lo").alias("first_received"),
            F.max("hi").alias("last_received"),
        )
    )
