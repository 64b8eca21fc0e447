"""Positions, running totals and exact quantiles over ordered data of any size.

A window without partition columns, or with one hot partition, puts everything in
one task. Here rows are range-partitioned by key *and* order, so a hot key spreads
over many tasks; only one summary row per (key, partition) is combined afterwards.
"""

from pyspark.sql import DataFrame, Window, functions as F

from cellpulse.session import materialise

_ROW_BITS = 33  # monotonically_increasing_id: partition above, row position below


def _range_sorted(df: DataFrame, order: list) -> DataFrame:
    placed = (df.repartitionByRange(*order).sortWithinPartitions(*order)
              .withColumn("_pos", F.monotonically_increasing_id()))
    # Range bounds come from a sample; storing the rows fixes them for every later read.
    return (materialise(placed, "ordered")
            .withColumn("_part", F.shiftright("_pos", _ROW_BITS)))


def _join_spans(rows: DataFrame, spans: DataFrame, keys: list) -> DataFrame:
    renamed = spans.select([F.col(k).alias(f"_span_{k}") for k in keys + ["_part"]]
                           + [c for c in spans.columns if c not in keys + ["_part"]])
    same = F.col("_part") == F.col("_span__part")
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"_span_{key}"))
    return rows.join(renamed, same).drop(*[f"_span_{k}" for k in keys + ["_part"]])


def row_index(df: DataFrame, order: list, keys: list = (), name: str = "row_index") -> DataFrame:
    """Add the 1-based position of each row within its key.

    ``order`` holds column names and must make rows unique, or ties fall as they come.
    """
    keys = list(keys)
    rows = _range_sorted(df, keys + list(order))
    spans = (rows.groupBy(*keys, "_part")
             .agg(F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_rows")))
    earlier = (Window.partitionBy(*keys).orderBy("_part")
               .rowsBetween(Window.unboundedPreceding, -1))
    spans = spans.withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
    return (_join_spans(rows, spans.drop("_rows"), keys)
            .withColumn(name, F.col("_before") + F.col("_pos") - F.col("_first") + 1)
            .drop("_pos", "_part", "_first", "_before"))


def edge(row, order: list, kinds: dict):
    """The order values of a row as a constant that compares like the sort: nulls first."""
    return F.struct(*[(F.lit(None) if row[c] is None else F.lit(str(row[c])))
                      .cast(kinds[c]).alias(c) for c in order])


def rows_between(df: DataFrame, order: list, first: int, last: int) -> DataFrame:
    """Rows at positions ``first`` to ``last`` (from 1, inclusive) of the ordered frame.

    Only the order columns, which must be unique, are sorted, nulls first. The rows at the two
    ends come back, and the full rows are compared with them in place.
    """
    spots = row_index(df.select(*order), order, name="_idx")
    ends = {r["_idx"]: r for r in spots.where(F.col("_idx").isin(first, last)).collect()}
    kinds = dict(df.dtypes)
    if first > last or first not in ends:
        return df.where(F.lit(False))
    out = df.where(F.struct(*order) >= edge(ends[first], order, kinds))
    return out.where(F.struct(*order) <= edge(ends[last], order, kinds)) if last in ends else out


def running_totals(df: DataFrame, order: list, sums: list, keys: list = ()) -> DataFrame:
    """Add ``<c>_cum`` (inclusive running sum) and ``<c>_total`` for each column in ``sums``."""
    keys = list(keys)
    rows = _range_sorted(df, keys + list(order))
    spans = rows.groupBy(*keys, "_part").agg(*[F.sum(c).alias(f"_sum_{c}") for c in sums])
    whole = Window.partitionBy(*keys)
    earlier = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select(
        *keys, "_part",
        *[F.coalesce(F.sum(f"_sum_{c}").over(earlier), F.lit(0)).alias(f"_before_{c}")
          for c in sums],
        *[F.sum(f"_sum_{c}").over(whole).alias(f"{c}_total") for c in sums])
    local = (Window.partitionBy(*keys, "_part").orderBy("_pos")
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = rows.select("*", *[F.sum(c).over(local).alias(f"_local_{c}") for c in sums])
    joined = _join_spans(rows, spans, keys)
    for c in sums:
        joined = joined.withColumn(f"{c}_cum", F.col(f"_local_{c}") + F.col(f"_before_{c}"))
    return joined.drop("_pos", "_part", *[f"_local_{c}" for c in sums],
                       *[f"_before_{c}" for c in sums])


def quantiles(df: DataFrame, value: str, probs: list, keys: list = (),
              names: list = None) -> DataFrame:
    """Exact quantiles with linear interpolation, one row per key.

    Equal values are counted first, so only distinct values are ordered.
    """
    keys = list(keys)
    names = names or [f"q{round(p * 100):02d}" for p in probs]
    counts = (df.where(F.col(value).isNotNull()).groupBy(*keys, value)
              .agg(F.count(F.lit(1)).alias("_n")))
    runs = running_totals(counts, [value], ["_n"], keys)
    aggs = [F.max("_n_total").alias("n")]
    for i, p in enumerate(probs):
        spot = F.lit(float(p)) * (F.col("_n_total") - 1)
        for side, index in (("lo", F.floor(spot)), ("hi", F.ceil(spot))):
            holds = (F.col("_n_cum") > index) & (F.col("_n_cum") - F.col("_n") <= index)
            aggs.append(F.max(F.when(holds, F.col(value))).alias(f"_{side}{i}"))
    out = runs.groupBy(*keys).agg(*aggs)
    cols = []
    for i, (p, name) in enumerate(zip(probs, names)):
        spot = F.lit(float(p)) * (F.col("n") - 1)
        cols.append((F.col(f"_lo{i}") + (spot - F.floor(spot))
                     * (F.col(f"_hi{i}") - F.col(f"_lo{i}"))).alias(name))
    return out.select(*keys, "n", *cols)


def quantile_grid(df: DataFrame, value: str, points: int, keys: list) -> DataFrame:
    """Exact quantiles at ``points`` even shares from 0 to 1, as the array ``marks`` per key.

    Each distinct value names the shares whose lower or upper neighbour it is, so that
    2 * ``points`` rows per key are left, whatever the number of values.
    """
    counts = (df.where(F.col(value).isNotNull()).groupBy(*keys, value)
              .agg(F.count(F.lit(1)).alias("_n")))
    last = points - 1
    runs = running_totals(counts, [value], ["_n"], keys).select(
        *keys, value, F.expr("_n_total - 1").alias("_gap"),
        F.expr("_n_cum - _n").alias("_from"), F.col("_n_cum").alias("_to"))
    # Share i lies at position i * gap / last; whole-number arithmetic keeps it exact.
    low = F.expr(f"""CASE WHEN _gap = 0 THEN sequence(0L, {last}L)
        ELSE filter(sequence((_from * {last} + _gap - 1) div _gap,
                             greatest((_to * {last} + _gap - 1) div _gap - 1,
                                      (_from * {last} + _gap - 1) div _gap)),
                    i -> i <= {last} AND (i * _gap) div {last} >= _from
                         AND (i * _gap) div {last} < _to) END""")
    high = F.expr(f"""CASE WHEN _gap = 0 THEN sequence(0L, {last}L)
        ELSE filter(sequence(greatest(0L, ((_from - 1) * {last}) div _gap),
                             greatest(0L, ((_to - 1) * {last}) div _gap)),
                    i -> i <= {last} AND (i * _gap + {last} - 1) div {last} >= _from
                         AND (i * _gap + {last} - 1) div {last} < _to) END""")
    sides = [runs.select(*keys, "_gap", F.col(value).alias("_v"), F.explode(shares).alias("_i"),
                         F.lit(name).alias("_side"))
             for name, shares in (("lo", low), ("hi", high))]
    both = sides[0].unionByName(sides[1]).groupBy(*keys, "_i", "_gap").agg(
        F.max(F.when(F.col("_side") == "lo", F.col("_v"))).alias("_lo"),
        F.max(F.when(F.col("_side") == "hi", F.col("_v"))).alias("_hi"))
    part = (F.col("_i") * F.col("_gap") % last) / F.lit(float(last))
    mark = F.col("_lo") + part * (F.col("_hi") - F.col("_lo"))
    return (both.groupBy(*keys)
            .agg(F.array_sort(F.collect_list(F.struct("_i", mark.alias("m")))).alias("_m"))
            .select(*keys, F.transform("_m", lambda s: s["m"]).alias("marks")))


def blocks(df: DataFrame, index: str, keys: list = (), before: int = 0, after: int = 0,
           size: int = 100_000) -> DataFrame:
    """Cut an indexed series into blocks of ``size`` rows plus the neighbouring rows.

    Adds ``_block`` and ``_own``; windows partitioned by ``keys + ['_block']`` then see
    ``before`` rows ahead of and ``after`` rows past each owned row, in bounded tasks.
    """
    if max(before, after) > size:
        raise ValueError("block size must cover the window reach")
    home = F.floor((F.col(index) - 1) / size)
    at = (F.col(index) - 1) % size
    targets = F.array_compact(F.array(
        home,
        F.when(at >= size - before, home + 1),
        F.when((at < after) & (home > 0), home - 1)))
    return (df.withColumn("_block", F.explode(targets))
            .withColumn("_own", F.col("_block") == F.floor((F.col(index) - 1) / size)))
