"""Descriptive statistics, tests and distributions over KPI columns.

Plain moments are one map-side reduction to a row per KPI. Orders, ranks and exact
quantiles count equal values first and then work on ordered distinct values.
"""

import math
from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from cellpulse.functions.tails import chi2_tail, normal_score, normal_two_sided
from cellpulse.operators.ordering import quantiles, running_totals
from cellpulse.session import small_table


def long_form(df: DataFrame, kpis: list, keep: list = ()) -> DataFrame:
    keep = list(keep)
    return df.select(*keep, *kpis).unpivot(keep, kpis, "kpi", "value")


def _per_kpi(df: DataFrame, kpis: list, measures: dict, keep: list = ()) -> DataFrame:
    """One row per KPI with the measures, given as SQL texts over ``value``.

    Rows are unpivoted inside the scan stage and reduced map-side to one row per KPI. One
    aggregate with all KPIs side by side would need no unpivoting, but its generated code
    grows too long to be compiled and ran two to six times slower.
    """
    return long_form(df, kpis, keep).groupBy("kpi").agg(
        *[F.expr(text).alias(name) for name, text in measures.items()])


def describe(df: DataFrame, kpis: list, exact: bool = True) -> DataFrame:
    """Count, mean, sample spread, minimum, quartiles and maximum per KPI.

    ``exact=False`` takes the quartiles from a sketch in the same pass.
    """
    measures = {"count": "count(value)", "mean": "avg(value)", "std": "stddev_samp(value)",
                "min": "min(value)", "max": "max(value)"}
    probs, names = [0.25, 0.5, 0.75], ["q25", "q50", "q75"]
    if not exact:
        for p, name in zip(probs, names):
            measures[name] = f"percentile_approx(value, {p}, 10000)"
        return _per_kpi(df, kpis, measures)
    cuts = quantiles(long_form(df, kpis), "value", probs, ["kpi"], names).drop("n")
    return _per_kpi(df, kpis, measures).join(cuts, "kpi", "left")


def mean_difference(df: DataFrame, kpis: list, flag: str = "anomaly") -> DataFrame:
    """Mean per KPI of normal and anomalous rows and the difference in percent."""
    means = _per_kpi(df, kpis, {
        "normal_mean": f"avg(value) FILTER (WHERE `{flag}` = 0)",
        "anomaly_mean": f"avg(value) FILTER (WHERE `{flag}` = 1)"}, [flag])
    gap = F.col("anomaly_mean") - F.col("normal_mean")
    return means.withColumn(
        "difference_pct", F.round(F.try_divide(gap, F.col("normal_mean")) * 100, 2))


def discriminance(means: DataFrame) -> DataFrame:
    """Class and direction of each KPI's difference, strongest first."""
    size = F.abs("difference_pct")
    return means.select(
        "kpi", "difference_pct", size.alias("abs_difference"),
        F.when(size > 50, "high").when(size >= 20, "moderate").when(size < 20, "low")
        .alias("level"),
        F.when(F.col("difference_pct") > 0, "increases").otherwise("decreases").alias("trend")
    ).orderBy(F.desc_nulls_last("abs_difference"), "kpi")


def crosstab(df: DataFrame, a: str, b: str) -> DataFrame:
    """Contingency table in long form; the level ``All`` holds the margins."""
    return (df.where(F.col(a).isNotNull() & F.col(b).isNotNull())
            .cube(a, b).agg(F.count(F.lit(1)).alias("n"))
            .select(F.coalesce(F.col(a).cast("string"), F.lit("All")).alias(a),
                    F.coalesce(F.col(b).cast("string"), F.lit("All")).alias(b), "n"))


def crosstab_wide(df: DataFrame, a: str, b: str, levels: list) -> DataFrame:
    """Contingency table with one column per level of ``b`` and a total."""
    known = df.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    wide = known.groupBy(a).pivot(b, levels).agg(F.count(F.lit(1))).na.fill(0)
    total = reduce(lambda x, y: x + y, [F.col(f"`{level}`") for level in levels])
    return wide.withColumn("All", total)


def chi2(df: DataFrame, a: str, b: str) -> DataFrame:
    """Chi-square test of independence; continuity correction for a 2×2 table."""
    cells = (df.where(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(a, b)
             .agg(F.count(F.lit(1)).cast("double").alias("o")))
    cells = (cells.withColumn("r", F.sum("o").over(Window.partitionBy(a)))
             .withColumn("c", F.sum("o").over(Window.partitionBy(b))))
    row_end = F.row_number().over(Window.partitionBy(a).orderBy(b)) == 1
    col_end = F.row_number().over(Window.partitionBy(b).orderBy(a)) == 1
    # Empty cells add their expectation, and the expectations sum to n, so that
    # sum((o - e)^2 / e) = n * (sum(o^2 / (r * c)) - 1) needs the filled cells only.
    sums = (cells.withColumn("_row", row_end).withColumn("_col", col_end).agg(
        F.sum("o").alias("n"), F.sum(F.col("o") * F.col("o") / (F.col("r") * F.col("c"))).alias("s"),
        F.countDistinct(a).alias("rows"), F.countDistinct(b).alias("cols"),
        F.sum(F.when(F.col("_row"), 1 / F.col("r"))).alias("inv_r"),
        F.sum(F.when(F.col("_col"), 1 / F.col("c"))).alias("inv_c"),
        F.first(F.struct("o", "r", "c")).alias("one")))
    off = F.abs(F.col("one.o") - F.col("one.r") * F.col("one.c") / F.col("n"))
    held = off - F.least(F.lit(0.5), off)
    corrected = held * held * F.col("n") * F.col("inv_r") * F.col("inv_c")
    dof = (F.col("rows") - 1) * (F.col("cols") - 1)
    plain = F.col("n") * (F.col("s") - 1)
    out = sums.select(F.col("n").cast("long").alias("n"),
                      F.when(dof == 1, corrected).otherwise(plain).alias("chi2"),
                      dof.alias("dof"))
    return out.withColumn("p_value", chi2_tail(F.col("chi2"), F.col("dof")))


# ---- ranks ---------------------------------------------------------------

def _rank_sums(df: DataFrame, kpis: list, group: str) -> DataFrame:
    """Per KPI and group: size and rank sum (ties at their mid-rank), with the tie term.

    ``ties`` is the sum of t³ - t over tie groups of the KPI, repeated on each row.
    """
    counted = (long_form(df.where(F.col(group).isNotNull()), kpis, [group])
               .where(F.col("value").isNotNull())
               .groupBy("kpi", "value", group).agg(F.count(F.lit(1)).alias("g")))
    # One entry per group: bounded by the number of groups, not by rows.
    tied = counted.groupBy("kpi", "value").agg(
        F.sum("g").alias("t"), F.collect_list(F.struct(F.col(group).alias("name"), "g")).alias("parts"))
    runs = running_totals(tied, ["value"], ["t"], ["kpi"])
    mid = F.col("t_cum") - F.col("t") + (F.col("t") + 1) / 2.0
    t = F.col("t").cast("double")
    per_kpi = runs.groupBy("kpi").agg(F.sum(t * t * t - t).alias("ties"),
                                      F.max("t_total").alias("n_all"))
    sums = (runs.select("kpi", mid.alias("mid"), F.explode("parts").alias("p"))
            .groupBy("kpi", F.col("p.name").alias("grp"))
            .agg(F.sum("p.g").alias("n"), F.sum(F.col("p.g") * F.col("mid")).alias("rank_sum")))
    return sums.join(per_kpi, "kpi")


def mann_whitney(df: DataFrame, kpis: list, flag: str = "anomaly") -> DataFrame:
    """Two-sided rank test of flag 0 against flag 1 per KPI, normal approximation."""
    def pick(value, name):
        return F.sum(F.when(F.col("grp") == value, F.col(name)))
    both = _rank_sums(df, kpis, flag).groupBy("kpi", "ties", "n_all").agg(
        pick(0, "n").cast("double").alias("n1"), pick(1, "n").cast("double").alias("n2"),
        pick(0, "rank_sum").alias("r1"))
    n = F.col("n_all").cast("double")
    u = F.col("r1") - F.col("n1") * (F.col("n1") + 1) / 2
    product = F.col("n1") * F.col("n2")
    spread = F.sqrt(product / 12 * ((n + 1) - F.try_divide(F.col("ties"), n * (n - 1))))
    larger = F.greatest(F.col("u_statistic"), product - F.col("u_statistic"))
    z = F.try_divide(larger - product / 2 - 0.5, spread)
    return (both.withColumn("u_statistic", u)
            .withColumn("p_value", F.least(F.lit(1.0), normal_two_sided(F.greatest(z, F.lit(0.0)))))
            .select("kpi", "u_statistic", "p_value",
                    (F.col("p_value") < 0.05).alias("significant")))


def kruskal(df: DataFrame, kpis: list, group: str) -> DataFrame:
    """Kruskal-Wallis test across the groups per KPI, corrected for ties."""
    n = F.col("n_all").cast("double")
    sums = _rank_sums(df, kpis, group).groupBy("kpi", "ties", "n_all").agg(
        F.sum(F.col("rank_sum") * F.col("rank_sum") / F.col("n")).alias("s"),
        (F.count(F.lit(1)) - 1).alias("dof"))
    h = F.lit(12.0) / (n * (n + 1)) * F.col("s") - 3 * (n + 1)
    corrected = F.try_divide(h, 1 - F.col("ties") / (n * n * n - n))
    return (sums.where("dof >= 1").withColumn("h_statistic", corrected)
            .withColumn("p_value", chi2_tail(F.col("h_statistic"), F.col("dof")))
            .select("kpi", "h_statistic", "dof", "p_value",
                    (F.col("p_value") < 0.05).alias("significant")))


def normality(df: DataFrame, kpis: list) -> DataFrame:
    """Jarque-Bera statistic over all rows; p = exp(-JB / 2)."""
    shape = _per_kpi(df, kpis, {"n": "count(value)", "skew": "skewness(value)",
                             "excess_kurtosis": "kurtosis(value)"})
    jb = F.col("n") / 6.0 * (F.col("skew") ** 2 + F.col("excess_kurtosis") ** 2 / 4.0)
    return (shape.withColumn("jb", jb).withColumn("p_value", F.exp(-F.col("jb") / 2))
            .withColumn("normal", F.col("p_value") > 0.05))


def best_transform(versions: dict, kpis: list) -> DataFrame:
    """Transform with the smallest Jarque-Bera statistic per KPI."""
    parts = [normality(frame, kpis).select("kpi", F.lit(name).alias("transform"), "jb")
             for name, frame in versions.items()]
    table = reduce(DataFrame.unionByName, parts)
    return table.groupBy("kpi").agg(
        F.min_by("transform", F.struct("jb", "transform")).alias("best_transform"),
        F.min("jb").alias("jb"))


# Increasing functions of a value, defined for every number.
MONOTONE = {"none": "value", "cube_root": "signum(value) * cbrt(abs(value))",
            "log": "signum(value) * ln(1 + abs(value))",
            "square_root": "signum(value) * sqrt(abs(value))"}


RANK_SPAN = 10_000  # ranks of one value that a row stands for before they are laid out


def shapiro_francia(df: DataFrame, kpis: list, transforms: dict = None) -> DataFrame:
    """W statistic of Shapiro and Francia over all rows, per KPI and increasing transform.

    W is the squared correlation of the sorted values with normal scores
    (i - 3/8) / (n + 1/4) of the ranks i. Values are counted first; one ordering of the distinct
    ones serves all transforms, which leave ranks as they are. Ranks of a frequent value are laid
    out in spans over many tasks and reduced in place. ``z`` is Royston's normal approximation,
    made for 5 to 5,000 rows; a KPI with fewer than 5 known values has no ``z``, a constant one no
    ``w``, one without known values no row. NaN counts as unknown.
    """
    transforms = transforms or {"none": "value"}
    counted = (long_form(df, kpis).where(F.col("value").isNotNull() & ~F.isnan("value"))
               .groupBy("kpi", "value").agg(F.count(F.lit(1)).alias("t")))
    runs = running_totals(counted, ["value"], ["t"], ["kpi"])
    spans = runs.select("kpi", "value", "t_total", "t_cum", F.explode(F.expr(
        f"sequence(t_cum - t + 1, t_cum, {RANK_SPAN}L)")).alias("a")).repartition("kpi", "a")
    rank = F.explode(F.expr(f"sequence(a, least(a + {RANK_SPAN - 1}, t_cum))"))
    scored = spans.select("kpi", "value", "t_total", rank.alias("i")).withColumn(
        "m", normal_score((F.col("i") - 0.375) / (F.col("t_total") + 0.25)))
    sums = scored.groupBy("kpi").agg(
        F.count(F.lit(1)).alias("n"), F.var_pop("m").alias("vm"),
        *[F.struct(F.expr(f"covar_pop({text}, m)").alias("xm"),
                   F.expr(f"var_pop({text})").alias("vx")).alias(f"_{name}")
          for name, text in transforms.items()])
    each = F.explode(F.array(*[F.struct(F.lit(name).alias("transform"), F.col(f"_{name}").alias("s"))
                               for name in transforms]))
    w = F.try_divide(F.col("e.s.xm") * F.col("e.s.xm"), F.col("e.s.vx") * F.col("vm"))
    u = F.log(F.col("n"))
    v = F.log(u)
    centre = -1.2725 + 1.0521 * (v - u)
    spread = 1.0308 - 0.26758 * (v + 2 / u)
    z = F.when((F.col("n") >= 5) & (F.col("w") < 1), (F.log(1 - F.col("w")) - centre) / spread)
    return (sums.select("kpi", "n", "vm", each.alias("e"))
            .select("kpi", "e.transform", "n", w.alias("w")).withColumn("z", z)
            .withColumn("normal", F.col("z") < 1.6448536269514722))


def most_normal(scores: DataFrame) -> DataFrame:
    """Transform with the largest W per KPI; the first by name wins a tie."""
    return (scores.where("w IS NOT NULL").groupBy("kpi")
            .agg(F.min_by(F.struct("transform", "w"), F.struct(-F.col("w"), "transform")).alias("b"))
            .select("kpi", F.col("b.transform").alias("best_transform"), F.col("b.w").alias("w")))


# ---- correlation ---------------------------------------------------------

def correlation(df: DataFrame, columns: list) -> DataFrame:
    """Pearson r for each pair of columns, null for a constant one.

    A first pass finds means, counts and constant columns. In the second, each row meets its
    own values: one group per column sums the products with all columns. If a column has
    nulls, each pair uses the rows where both are known.
    """
    columns = list(columns)
    first = {r["kpi"]: r for r in _per_kpi(df, columns, {
        "rows": "count(1)", "known": "count(value)", "mean": "avg(value)", "lo": "min(value)",
        "hi": "max(value)"}).collect()}
    flat = {c for c in columns if c not in first or first[c]["lo"] == first[c]["hi"]}
    live = [c for c in columns if c not in flat]
    whole = all(first[c]["known"] == first[c]["rows"] for c in live)
    rows = df.select(*[(F.col(c) - F.lit(first[c]["mean"])).alias(c) for c in live])
    if whole:
        text = "sum(value * `{y}`)"
    else:
        text = ("try_divide(covar_pop(value, `{y}`), "
                "stddev_pop(CASE WHEN `{y}` IS NOT NULL THEN value END) * "
                "stddev_pop(CASE WHEN value IS NOT NULL THEN `{y}` END))")
    found = {}
    if live:
        sums = (rows.unpivot(live, live, "kpi", "value").groupBy("kpi")
                .agg(*[F.expr(text.format(y=c)).alias(f"p{i}") for i, c in enumerate(live)]))
        for r in sums.collect():  # columns squared numbers
            for i, c in enumerate(live):
                found[r["kpi"], c] = r[f"p{i}"]

    def r(a, b):
        value = found.get((a, b))
        if value is None or not whole:
            return value
        spread = math.sqrt(found[a, a] * found[b, b])
        return value / spread if spread else None
    return small_table(df.sparkSession, "kpi_x string, kpi_y string, r double",
                       [(a, b, r(a, b)) for i, a in enumerate(columns) for b in columns[i + 1:]])


def strong_pairs(matrix: DataFrame, above: float = 0.7) -> DataFrame:
    return (matrix.where(F.abs("r") > above).withColumn("r", F.round("r", 3))
            .orderBy("kpi_x", "kpi_y"))


# ---- distributions -------------------------------------------------------

def histogram(df: DataFrame, column: str, bins: int, by: str = None) -> DataFrame:
    """Equal-width bins over the column's range, the last one closed; empty bins included.

    With ``by``, counts and densities per class over the common range.
    """
    value = F.col(column)
    ends = df.agg(F.min(value).alias("lo"), F.max(value).alias("hi")).first()
    lo, hi = ends["lo"], ends["hi"]
    if lo is None:
        raise ValueError(f"no values in {column}")
    if lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    width = (hi - lo) / bins
    keys = [by] if by else []
    slot = F.least(F.width_bucket(value, F.lit(lo), F.lit(hi), F.lit(bins)), F.lit(bins))
    counts = (df.where(value.isNotNull()).groupBy(*keys, slot.cast("int").alias("bin"))
              .agg(F.count(F.lit(1)).alias("count")))
    if by:
        grid = counts.select(by).distinct()
    else:
        grid = df.sparkSession.range(1)
    grid = grid.select(*keys, F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin"))
    full = (grid.join(counts, keys + ["bin"], "left").na.fill(0, ["count"])
            .withColumn("lower", F.lit(lo) + (F.col("bin") - 1) * width)
            .withColumn("upper", F.lit(lo) + F.col("bin") * width))
    if not by:
        return full
    total = F.sum("count").over(Window.partitionBy(by))
    return full.withColumn("density", F.col("count") / total / width)


def mean_and_median(df: DataFrame, kpis: list) -> DataFrame:
    middle = quantiles(long_form(df, kpis), "value", [0.5], ["kpi"], ["median"]).drop("n")
    return _per_kpi(df, kpis, {"mean": "avg(value)"}).join(middle, "kpi")


def boxplot(df: DataFrame, kpis: list, by: str) -> DataFrame:
    """Quartiles, whiskers within 1.5 interquartile ranges, and outliers per KPI and class."""
    long = long_form(df, kpis, [by]).where(F.col("value").isNotNull())
    counted = long.groupBy("kpi", by, "value").agg(F.count(F.lit(1)).alias("g"))
    cuts = quantiles(long, "value", [0.25, 0.5, 0.75], ["kpi", by], ["q1", "median", "q3"])
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    cuts = cuts.withColumn("lo", F.col("q1") - reach).withColumn("hi", F.col("q3") + reach)
    inside = F.col("value").between(F.col("lo"), F.col("hi"))
    return (counted.join(cuts, ["kpi", by])
            .groupBy("kpi", by, "n", "q1", "median", "q3")
            .agg(F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
                 F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
                 F.sum(F.when(inside, 0).otherwise(F.col("g"))).alias("outliers")))


def percentile_cut(df: DataFrame, score: str, prob: float, reference=None) -> DataFrame:
    """Flag rows whose score exceeds a percentile of the reference rows' scores."""
    base = df if reference is None else df.where(reference)
    cut = quantiles(base, score, [prob], names=["cut"]).first()["cut"]
    return (df.withColumn("cut", F.lit(cut))
            .withColumn("flagged", (F.col(score) > F.lit(cut)).cast("int")))
