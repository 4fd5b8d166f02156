"""Shards of near equal bytes by sampled splitters, with DataFrame functions only.

Records are ordered by the hash of their text, so equal texts lie together and form one
unit; a unit of more bytes than a shard can take without harm is divided by the hash of
its ids, and by stored row numbers where an id (or none) repeats in much of it.  Splitters are quantiles of a sample of units drawn in proportion to size.
They cut the order into ranges, and a range that turns out overfull draws splitters of
its own.  Prefix sums over the ranges and inside each range give every unit its exact
place, and a unit goes to the shard that holds its middle byte.

* Null text has no bytes; a record's size is its UTF-8 bytes plus one.
* Repeated rows are records of their own; extra columns are ignored.
* An empty table gives no rows.  One record larger than a shard takes that shard.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from tidemill.session import new_folder

SHARDS = 8
UNIT_SHARE = 0.02     # of a shard: equal texts of more bytes (and more than any record) are divided
REPEATED = 8          # an id with over 1 / REPEATED of that in equal rows is divided by row numbers
PIECES = 64           # of a range, in one cut
RANGE_ROWS = 1 << 20  # aimed at in a range; a smaller table is cut into PIECES ranges
PER_SPLITTER = 32     # sampled units for each splitter
CUTS = 6              # rounds of cutting at most: 64^6 ranges

UNIT = ["a", "b", "sub"]


def _written(df: DataFrame, label: str) -> DataFrame:
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _splitters(rows: DataFrame, full: DataFrame) -> DataFrame:
    """Sorted splitter units of the parts in ``full`` (part, bytes, pieces): (part, cuts).

    A record is drawn with probability size * pieces * PER_SPLITTER / bytes, so the
    sample has some PIECES * PER_SPLITTER keys for a part, whatever its records.
    """
    chance = F.col("size") * F.col("pieces") * F.lit(PER_SPLITTER) / F.col("bytes")
    uniform = F.pmod(F.xxhash64("a", "b", "sub", "key", "copy", F.lit(20)), F.lit(1 << 40)) / F.lit(float(1 << 40))
    drawn = rows.join(F.broadcast(full), "part").where(uniform < chance)
    keys = F.sort_array(F.collect_list(F.struct(*UNIT)))
    picked = "array_distinct(transform(sequence(1, pieces - 1), i -> keys[int(i * size(keys) / pieces)]))"
    return drawn.groupBy("part", "pieces").agg(keys.alias("keys")).select("part", F.expr(picked).alias("cuts"))


def _cut(rows: DataFrame, cuts: DataFrame) -> DataFrame:
    """A part's name is the list of the pieces that led to it, so names sort as keys do."""
    unit = F.struct(*UNIT)
    piece = F.coalesce(F.size(F.filter("cuts", lambda c: c <= unit)), F.lit(0))
    named = rows.join(F.broadcast(cuts), "part", "left").withColumn("part", F.concat("part", F.array(piece)))
    return named.drop("cuts")


def _ranges(rows: DataFrame, total: int, n: int) -> tuple[DataFrame, DataFrame]:
    """Rows with their range, and the ranges with bytes and rows."""
    spark = rows.sparkSession
    target = max(1, min(RANGE_ROWS, n // PIECES))
    rows = rows.withColumn("part", F.array().cast("array<int>"))
    full = spark.createDataFrame([([], total, min(PIECES, max(2, n // target)))], "part array<int>, bytes long, pieces int")
    for _ in range(CUTS):
        rows = _cut(rows, _written(_splitters(rows, full), "shard-cuts"))
        units = rows.groupBy("part", *UNIT).agg(F.sum("size").alias("size"), F.count("*").alias("n"))
        ranges = _written(
            units.groupBy("part").agg(F.sum("size").alias("bytes"), F.sum("n").alias("n"), F.count("*").alias("units")),
            "shard-ranges",
        )
        pieces = F.least(F.lit(PIECES), F.greatest(F.lit(2), F.ceil(F.col("n") / target))).cast("int")
        full = ranges.where((F.col("n") > 4 * target) & (F.col("units") > 1)).select("part", "bytes", pieces.alias("pieces"))
        if full.isEmpty():
            break
    return rows, ranges


def sharded(docs: DataFrame, id: str = "doc_id", text: str = "text", shards: int = SHARDS) -> DataFrame:
    """One row per record: id, size, text_crc32, law (``bytes``), shard, slot, grown_shard (null).

    ``slot`` counts the records of a shard from 0.  Shards differ in bytes by no more
    than a unit, which is at most UNIT_SHARE of a shard or one record.
    """
    body = F.coalesce(docs[text].cast("string"), F.lit(""))
    records = _written(
        docs.select(
            docs[id].alias("key"), (F.octet_length(body) + 1).cast("long").alias("size"),
            F.crc32(body).alias("text_crc32"), F.xxhash64(body).alias("a"), F.xxhash64(body, F.lit(1)).alias("b"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "shard-records",
    )
    sums = records.agg(F.sum("size").alias("bytes"), F.count("*").alias("n"), F.max("size").alias("most")).first()
    total, n = sums["bytes"] or 1, sums["n"]
    cap = max(sums["most"] or 1, int(UNIT_SHARE * total / shards))
    # Fewer than shards / UNIT_SHARE groups can be over the cap, so they fit a broadcast.
    large = records.groupBy("a", "b").agg(F.sum("size").alias("held")).where(F.col("held") > cap)
    large = large.select("a", "b", F.ceil(2 * F.col("held") / cap).alias("fold"))
    rows = records.join(F.broadcast(large), ["a", "b"], "left")
    # Nor can there be more than REPEATED times as many of these.
    same = rows.where("fold IS NOT NULL").groupBy("a", "b", "key").agg(F.sum("size").alias("held"), F.count("*").alias("n"))
    same = same.where((F.col("n") > 1) & (F.col("held") * REPEATED > cap)).select(
        F.col("a").alias("a2"), F.col("b").alias("b2"), F.col("key").alias("key2"), F.lit(True).alias("repeats")
    )
    met = (F.col("a") == F.col("a2")) & (F.col("b") == F.col("b2")) & F.col("key").eqNullSafe(F.col("key2"))
    # Hashes pass over the null that all other rows have here.
    rows = rows.join(F.broadcast(same), met, "left").withColumn("copy", F.when(F.col("repeats"), F.col("row")))
    sub = F.coalesce(F.pmod(F.xxhash64("key", "copy"), F.col("fold")), F.lit(0))
    rows = rows.withColumn("sub", sub).drop("fold", "row", "a2", "b2", "key2", "repeats")

    rows, ranges = _ranges(rows, total, n)
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select("part", F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("before"))
    upto = Window.partitionBy("part").orderBy(*UNIT).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    middle = 2 * (F.col("before") + F.sum("size").over(upto)) - F.sum("size").over(Window.partitionBy("part", *UNIT))
    shard = F.least(F.floor(middle * shards / F.lit(2 * total)), F.lit(shards - 1)).cast("int")
    placed = rows.join(F.broadcast(ranges), "part").withColumn("shard", shard)
    nth = F.row_number().over(Window.partitionBy("part", "shard").orderBy(*UNIT, "key"))
    placed = _written(placed.select("key", "size", "text_crc32", "part", "shard", nth.alias("nth")), "shard-places")
    blocks = placed.groupBy("part", "shard").agg(F.count("*").alias("n"))
    ahead = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("part", "shard", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("ahead"))
    # At most one block more than ranges for each shard.
    return placed.join(F.broadcast(blocks), ["part", "shard"]).select(
        F.col("key").alias(id), "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("ahead") + F.col("nth") - 1).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
