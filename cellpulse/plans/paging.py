"""Pages of large listings, newest first: by cursor, or by position without sorting the rows before.

Sort columns are descending with null keys last, and together make a row unique.
"""

from pyspark.sql import DataFrame, Window, functions as F

from cellpulse.operators.ordering import rows_between

TOP_ROWS = 50_000  # rows that a top-k may hold in each task
UNITS = ("1 0:0:0", "0 1:0:0", "0 0:1:0", "0 0:0:1")  # a day, an hour, a minute, a second


def sorted_page(df: DataFrame, newest: list, limit: int, skip: int = 0) -> DataFrame:
    return df.orderBy(*[F.desc(c) for c in newest]).offset(skip).limit(limit)


def cursor(row, newest: list) -> dict:
    """Sort keys of a page's last row, from which the next page goes on."""
    return {c: row[c] for c in newest}


def page_after(df: DataFrame, newest: list, after: dict = None, limit: int = 1000) -> DataFrame:
    """The ``limit`` rows that follow the cursor; the first page without one.

    A page costs a top-k of ``limit`` rows however deep it lies. The bound on the first key stands
    alone, so files and row groups with newer rows only are not read.
    """
    if limit < 0:
        raise ValueError("limit must not be negative")
    if after is None:
        return sorted_page(df, newest, limit)
    kinds = dict(df.dtypes)
    later, same = F.lit(False), F.lit(True)
    for c in newest:
        if after[c] is None:  # null keys come last: only equal ones are left
            same = same & F.col(c).isNull()
            continue
        mark = F.lit(str(after[c])).cast(kinds[c])
        later = later | (same & (F.col(c).isNull() | (F.col(c) < mark)))
        same = same & (F.col(c) == mark)
    first = newest[0]
    if after[first] is None:
        bound = F.col(first).isNull()
    else:
        bound = F.col(first).isNull() | (F.col(first) <= F.lit(str(after[first])).cast(kinds[first]))
    return sorted_page(df.where(bound).where(later), newest, limit)


def _narrow(df: DataFrame, time: str, unit: str, skip: int, limit: int):
    """Rows of the units of time that hold the page, and the number of rows before them.

    Rows are counted per unit map-side; the running total goes over units, not rows, and one row
    comes to the driver.
    """
    kind = dict(df.dtypes)[time]
    slot = F.expr(f"(`{time}` - CAST('1970-01-01' AS {kind})) DIV INTERVAL '{unit}' DAY TO SECOND")
    counts = df.groupBy(slot.alias("slot")).agg(
        F.count(F.lit(1)).alias("n"), F.min(time).alias("a"), F.max(time).alias("b"))
    upto = F.sum("n").over(Window.orderBy(F.desc("slot")))
    held = (counts.withColumn("upto", upto)
            .where((F.col("upto") > skip) & (F.col("upto") - F.col("n") < skip + limit))
            .agg(F.min("a").alias("a"), F.max("b").alias("b"), F.min(F.col("upto") - F.col("n"))
                 .alias("before"), F.sum("n").alias("n"),
                 F.coalesce(F.bool_or(F.col("slot").isNull()), F.lit(False)).alias("nulls")).first())
    if held["n"] is None:
        return df.where(F.lit(False)), 0, 0
    inside = F.lit(False)
    if held["a"] is not None:
        low, high = (F.lit(str(held[x])).cast(kind) for x in "ab")
        inside = (F.col(time) >= low) & (F.col(time) <= high)
    if held["nulls"]:
        inside = inside | F.col(time).isNull()
    return df.where(inside), held["before"], held["n"]


def page_at(df: DataFrame, newest: list, limit: int, offset: int,
            top_rows: int = TOP_ROWS) -> DataFrame:
    """Rows ``offset`` to ``offset + limit``, where the first sort column is a time.

    Counts per day, then per hour, minute and second, find the span of time that holds the page
    until a top-k of ``top_rows`` rows covers the rest of the way. If a single second holds more,
    its sort keys alone are ordered over many tasks.
    """
    if offset + limit <= top_rows or not dict(df.dtypes)[newest[0]].startswith("timestamp"):
        return sorted_page(df, newest, limit, offset)
    skip, rows = offset, 0
    for unit in UNITS:
        df, before, rows = _narrow(df, newest[0], unit, skip, limit)
        skip -= before
        if rows == 0 or skip + limit <= top_rows:
            return sorted_page(df, newest, limit, max(skip, 0))
    last = rows - skip  # the ascending order of rows_between, nulls first, is the exact reverse
    return rows_between(df, newest, max(1, last - limit + 1), last).orderBy(
        *[F.desc(c) for c in newest])
