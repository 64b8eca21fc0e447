"""Column expressions shared by queries and jobs."""

from pyspark.sql import Column, functions as F

from cellpulse import schema


def as_ntz(moment) -> Column:
    """Literal zone-less timestamp from a datetime, a string or a column; None means now."""
    if moment is None:
        return F.localtimestamp()
    if isinstance(moment, Column):
        return moment
    return F.lit(str(moment)).cast("timestamp_ntz")


def hours_before(moment, hours: int) -> Column:
    return as_ntz(moment) - F.expr(f"interval {int(hours)} hours")


def hour_label(ts: Column) -> Column:
    return F.date_format(ts, "HH:00")


def hour_bucket(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:00")


def date_parts(ts: Column) -> dict:
    """Calendar parts; ``dayofweek`` counts from Monday = 0."""
    return {"year": F.year(ts), "month": F.month(ts), "day": F.dayofmonth(ts),
            "hour": F.hour(ts), "minute": F.minute(ts), "second": F.second(ts),
            "dayofweek": F.weekday(ts), "date": F.to_date(ts)}


def safe_date_parts(text: Column) -> dict:
    """Date parts of a timestamp text.

    Unreadable text gives the fallback date; a missing or empty one gives zeros.
    """
    parsed = text.try_cast("timestamp_ntz")
    blank = text.isNull() | (F.trim(text) == "")
    taken = date_parts(parsed)
    return {name: F.when(blank, 0).otherwise(F.coalesce(taken[name], F.lit(fallback)))
            for name, fallback in zip(schema.DATE_PARTS, schema.FALLBACK_DATE_PARTS)}


def encode(value: Column, classes: list, default: int = 0) -> Column:
    """Code of a label among the sorted classes; unseen or null labels get the default."""
    pairs = []
    for code, name in enumerate(sorted(classes)):
        pairs += [F.lit(name), F.lit(code)]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), value), F.lit(default))


def decode(code: Column, classes: list, default: str) -> Column:
    """Label of a code among the sorted classes."""
    names = F.array(*[F.lit(name) for name in sorted(classes)])
    return F.coalesce(F.when(code >= 0, F.try_element_at(names, (code + 1).cast("int"))),
                      F.lit(default))


def breaches(value: Column, threshold: Column, bad_side: Column) -> Column:
    """True where the value lies strictly on the bad side of its threshold."""
    return F.when(bad_side == "low", value < threshold).otherwise(value > threshold)


def meets(value: Column, threshold: Column, bad_side: Column) -> Column:
    return F.when(bad_side == "low", value >= threshold).otherwise(value <= threshold)


def proximity(value: Column, threshold: Column) -> Column:
    """Relative distance from the threshold, 0 for a zero threshold."""
    return F.coalesce(F.try_divide(F.abs(value - threshold), threshold), F.lit(0.0))


def one_decimal(value: Column) -> Column:
    """Text with one decimal, ties to even on the binary value."""
    return F.call_function("format_number", value, F.lit("0.0"))
