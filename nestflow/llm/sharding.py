"""Shards of bounded size by extendible hashing.

Every row has a string of hash bits: 32 of its key, then bits of its own. The directory maps
prefixes of it to shards. It begins with the empty prefix; a shard over the byte limit is
split by one more bit, and only such a shard, until each fits or holds a single row. As the
last bits differ between rows with the same key, a key with a third of all rows is split as
well. A round counts the bytes of the open shards at the next eight bits, and reads from these
counts where splitting stops; rows of settled shards leave. The rounds read hash bits and sizes
only; the texts are moved once, to their shards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nestflow.llm.base import drop_settled, free_name, settled, settled_paths
from nestflow.workspace import new_folder

KEY_BITS = 32
BITS = 63
ROUND_BITS = 8


def hash_bits(key: Column, row: Column) -> Column:
    """63 bits as a long: 32 of the key's MD5, 31 of a hash of the row's number."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    of_key = F.conv(F.substring(digest, 1, KEY_BITS // 4), 16, 10).cast("bigint")
    rest = BITS - KEY_BITS
    of_row = F.xxhash64(row).bitwiseAND(F.lit((1 << rest) - 1))
    return F.shiftleft(of_key, rest).bitwiseOR(of_row)


def _prefix(bits: Column, depth: int) -> Column:
    # A shift by 64 would be none.
    return F.lit(0).cast("bigint") if depth == 0 else F.shiftright(bits, BITS - depth)


def assign_shards(
    docs: DataFrame, limit: int, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The rows, without the text, with ``n_bytes``, ``shard`` and ``shard_depth``.

    ``shard`` is the shard's prefix as text of 0 and 1, ``shard_depth`` its length. No shard
    has more than ``limit`` bytes of text in UTF-8, but one that holds a single row. A null
    text has no bytes; a null key counts as the empty text. Repeated rows stay and may go to
    different shards. Columns of these three names are replaced, others stay.
    """
    added = ("n_bytes", "shard", "shard_depth")
    kept = [c for c in docs.columns if c != text and c.lower() not in added]
    bits, cell = free_name(docs, "hash_bits"), free_name(docs, "cell")
    n_bytes = F.coalesce(F.octet_length(docs[text]), F.lit(0)).cast("bigint")
    rows = docs.select(*kept, n_bytes.alias("n_bytes"), docs[key].alias(cell))
    rows = rows.select(
        *kept, "n_bytes", hash_bits(F.col(cell), F.monotonically_increasing_id()).alias(bits)
    )
    rows = settled(rows, "sharded-rows", compression="zstd")
    depths = []
    for n, (deepest, cells) in enumerate(_directories(rows, bits, limit, cell)):
        depths.append(free_name(rows, f"depth_{n}"))
        found = cells.filter("shard_depth IS NOT NULL").withColumnRenamed("shard_depth", depths[-1])
        # Few at any size of the table; other rounds' cells grow with it.
        found = F.broadcast(found) if deepest <= 2 * ROUND_BITS else found
        rows = rows.withColumn(cell, _prefix(F.col(bits), deepest)).join(found, cell, "left")
    depth_ = F.coalesce(*map(F.col, depths), F.lit(0)).cast("int")
    assigned = rows.select(*kept, "n_bytes", bits, depth_.alias("shard_depth"))
    digits = F.lpad(F.conv(F.col(bits).cast("string"), 10, 2), BITS, "0")
    shard = F.substring(digits, F.lit(1), F.col("shard_depth"))
    return assigned.select(*kept, "n_bytes", shard.alias("shard"), "shard_depth")


def _directories(rows, bits, limit, cell) -> list[tuple[int, DataFrame]]:
    """For each round its prefixes' bits and its directory; only hash bits and sizes are read."""
    open_, found = rows.select(bits, "n_bytes"), []
    for depth in range(0, BITS, ROUND_BITS):
        deepest = min(depth + ROUND_BITS, BITS)
        cells = settled(_directory(open_, bits, depth, deepest, limit, cell), "shard-directory")
        if not found and cells.isEmpty():
            break
        found.append((deepest, cells))
        if cells.filter("shard_depth IS NULL").isEmpty():
            break
        # In a later round a prefix that was settled before is not there any more.
        still = cells.filter("shard_depth IS NULL").select(cell)
        met = open_.withColumn(cell, _prefix(F.col(bits), deepest)).join(still, cell)
        open_ = settled(met.select(bits, "n_bytes"), "open-rows")
    return found


def _directory(rows, bits, depth, deepest, limit, cell) -> DataFrame:
    """For each prefix of ``deepest`` bits, the depth of its shard, null if still too large."""
    counted = rows.groupBy(_prefix(F.col(bits), deepest).alias(cell)).agg(
        F.sum("n_bytes").alias("bytes"), F.count(F.lit(1)).alias("rows")
    )
    counted = settled(counted, "shard-cells")
    # The open prefix itself is too large, but for the first one.
    ups = F.sequence(F.lit(0), F.lit(deepest - depth - (1 if depth else 0)))
    above = counted.select(cell, "bytes", "rows", F.explode(ups).alias("up"))
    above = above.withColumn("prefix", F.expr(f"shiftright(`{cell}`, up)"))
    last = F.lit(deepest == BITS) & (F.col("up") == 0)
    fits = (F.sum("bytes") <= limit) | (F.sum("rows") == 1) | last
    good = above.groupBy("up", "prefix").agg(fits.alias("fits")).filter("fits").drop("fits")
    least = above.join(good, ["up", "prefix"]).groupBy(cell).agg(
        (F.lit(deepest) - F.max("up")).alias("shard_depth")
    )
    return counted.select(cell).join(least, cell, "left")


def write_shards(
    docs: DataFrame, path: str, limit: int, key: str = "doc_id", text: str = "text"
) -> None:
    """Write the rows as Parquet, a folder per shard, each shard by one task.

    Folders are named ``shard=s`` and the prefix: alone, its digits would be read as a number.
    """
    before = set(settled_paths(docs.sparkSession))
    carried = free_name(docs, "shard_text")
    assigned = assign_shards(docs.withColumn(carried, docs[text]), limit, key, text)
    rows = assigned.withColumnRenamed(carried, text)
    rows = rows.withColumn("shard", F.concat(F.lit("s"), "shard"))
    writer = rows.repartition("shard").write.partitionBy("shard")
    writer.option("compression", "zstd").parquet(path)
    drop_settled(docs.sparkSession, set(settled_paths(docs.sparkSession)) - before)


def round_trip(
    docs: DataFrame, limit: int, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Write the shards to the shared folder and read them back.

    Columns: those of ``assign_shards``, worked out from the texts and folders that were written.
    """
    spark = docs.sparkSession
    folder = new_folder(spark, "shards")
    write_shards(docs, folder, limit, key, text)
    added = ("n_bytes", "shard", "shard_depth")
    kept = [c for c in docs.columns if c != text and c.lower() not in added]
    schema = docs.select(*kept, text, F.lit("").alias("shard")).schema
    back = spark.read.schema(schema).parquet(folder)
    n_bytes = F.coalesce(F.octet_length(back[text]), F.lit(0)).cast("bigint")
    shard = F.substring("shard", 2, BITS)
    depth = F.length(shard).alias("shard_depth")
    return back.select(*kept, n_bytes.alias("n_bytes"), shard.alias("shard"), depth)
