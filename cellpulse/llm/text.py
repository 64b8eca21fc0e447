"""Column expressions and small helpers shared by the text operators.

Words are runs of characters other than space, tab, line feed, vertical tab, form feed and
carriage return. A null text counts as empty.
"""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def whole(text) -> Column:
    """The text, empty where null."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def words(text: Column) -> Column:
    """The words of a text column in order."""
    even = F.translate(text, BLANKS[1:], " " * (len(BLANKS) - 1))
    return F.filter(F.split(even, " "), lambda w: w != "")


def release():
    """Give memory that a finished Arrow task freed back, since workers live on."""
    import ctypes
    import gc

    import pyarrow as pa
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def bitmap(hashes: DataFrame, cells: int) -> DataFrame:
    """One row with ``cells`` bits as an array ``bitmap`` of 64-bit words; ``cells`` is a power
    of two. The bits of all hashes ``h`` are set, so the size is fixed, whatever the rows.
    """
    cell = F.col("h").bitwiseAND(F.lit(cells - 1))
    spots = hashes.select(F.shiftright(cell, 6).alias("word"),
                          F.expr("shiftleft(1L, CAST(h & 63 AS INT))").alias("bit"))
    empty = hashes.sparkSession.range(cells >> 6).select(
        F.col("id").alias("word"), F.lit(0).cast("bigint").alias("bit"))
    packed = spots.union(empty).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    return packed.agg(F.transform(
        F.array_sort(F.collect_list(F.struct("word", "bits"))), lambda s: s["bits"])
        .alias("bitmap"))


def in_bitmap(h: Column, bits: Column, cells: int) -> Column:
    """Whether the bit of a hash is set; other hashes may share it."""
    word = F.get(bits, F.shiftright(h.bitwiseAND(F.lit(cells - 1)), 6).cast("int"))
    return F.getbit(word, h.bitwiseAND(F.lit(63)).cast("int")) == 1


def spread_join(rows: DataFrame, table: DataFrame, keys: list, weight: str = "n") -> DataFrame:
    """Join rows with a stored table of one row per key that counts the key's rows in ``weight``.

    Keys that hold a thousandth of all rows or more, a thousand at most, are broadcast, so no
    task gets a hot key's rows; the others are shuffled.
    """
    total = table.agg(F.sum(weight).alias("t")).collect()[0]["t"] or 0
    hot = F.broadcast(table.where(F.col(weight) * 1000 >= F.lit(total)))
    rest = rows.join(hot.select(*keys), keys, "left_anti").join(table, keys)
    return rows.join(hot, keys).unionByName(rest)
