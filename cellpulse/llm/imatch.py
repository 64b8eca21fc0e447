"""I-Match fingerprints with DataFrame functions only.

Terms are the lower-cased words without punctuation. A term belongs to the lexicon if the share
of documents that hold it lies in a band, and two documents hold it at least. A band with a
lowest share bounds the lexicon by (terms per document) / (lowest share), whatever the size of
the corpus; it travels as a bitmap of ``CELLS`` bits (512 KB), in which a term outside the band
may share a cell with one inside. That is the same for every text, so equal texts stay equal.

A fingerprint holds one 16-bit hash for each of 64 randomised subsets of the lexicon: eight
dense ones, which share out all terms, and 56 sparse ones, which share out one term in sixteen.
Each is the hash of the text's sorted distinct terms in that subset; 0 stands for no term. Dense
subsets tell close copies, sparse ones give a graded answer for heavier edits and long texts.
The likeness of two fingerprints is the number of equal hashes over the number of subsets with
a term in either. A text without any lexicon term takes the hash of all its distinct terms.

Documents follow each other by id. They are dealt out by ranges of ids, and the first document
of each range also goes, as a guest, to the range before (of the first range to the last), so
one shuffle of the texts puts every document beside the next.

Null text counts as empty. Null ids sort first. Rows that repeat an id follow each other in the
order of a hash of their text. A single document is its own next. An empty table gives an empty
result.
"""

import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from cellpulse.llm.text import BLANKS, bitmap, in_bitmap, whole

DENSE, SPARSE, SPARSE_RATE = 8, 56, 16
CELLS = 1 << 22
LOWEST_SHARE, HIGHEST_SHARE, LEAST_DOCUMENTS = 1 / 4096, 1 / 16, 2
RANGES_PER_PARTITION = 8
PUNCTUATION = ".,;:!?\"'()[]{}"


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def term_hashes(text: Column) -> Column:
    """Hashes of the distinct terms of a text."""
    plain = F.translate(F.lower(text), BLANKS[1:] + PUNCTUATION, " " * (len(BLANKS) - 1))
    kept = F.filter(F.split(plain, " "), lambda w: w != "")
    return F.array_distinct(F.transform(kept, lambda w: F.xxhash64(w)))


def lexicon(docs: DataFrame, lowest: float = LOWEST_SHARE, highest: float = HIGHEST_SHARE,
            least: int = LEAST_DOCUMENTS) -> DataFrame:
    """One row with the bitmap of lexicon cells, as 64-bit words in order."""
    total = docs.count()
    held = (docs.select(F.explode(term_hashes(F.col("text"))).alias("h"))
            .groupBy("h").agg(F.count(F.lit(1)).alias("n"))
            .where((F.col("n") >= max(least, lowest * total)) & (F.col("n") <= highest * total)))
    return bitmap(held, CELLS)


def fingerprint(text: Column, bits: Column) -> Column:
    """The 64 subset hashes of a text."""
    def known(h):
        return in_bitmap(h, bits, CELLS)

    def code(hashes, seed):
        return (F.pmod(F.xxhash64(hashes, F.lit(seed)), F.lit(65535)) + 1).cast("int")

    def part(h, shift, n):
        return F.pmod(F.shiftrightunsigned(h, shift), F.lit(n))

    def subsets(hashes, shift, n, first):
        def one(j):
            return _let(F.filter(hashes, lambda h: part(h, shift, n) == j),
                        lambda own: F.when(F.size(own) == 0, 0).otherwise(
                            code(own, first)))
        return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), one)

    def of_lexicon(own, every):
        return F.when(F.size(own) == 0, _let(
            code(F.sort_array(every), 3), lambda c: F.array_repeat(c, DENSE + SPARSE))
        ).otherwise(F.concat(
            subsets(own, 24, DENSE, 1),
            _let(F.filter(own, lambda h: part(h, 28, SPARSE_RATE) == 0),
                 lambda few: subsets(few, 33, SPARSE, 2))))
    return _let(term_hashes(text), lambda every: _let(
        F.sort_array(F.filter(every, known)), lambda own: of_lexicon(own, every)))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal hashes among the subsets that hold a term in either text."""
    def both(x, y):
        pairs = F.zip_with(x, y, lambda p, q: F.when((p == 0) & (q == 0), 0)
                           .when(p == q, 1001).otherwise(1))
        return F.aggregate(pairs, F.lit(0), lambda s, v: s + v)
    return _let(both(a, b), lambda n: F.floor(n / 1000) / (n - 1000 * F.floor(n / 1000)))


def as_text(codes: Column) -> Column:
    """Four hexadecimal digits per subset."""
    return F.array_join(F.transform(codes, lambda c: F.lpad(F.lower(F.hex(c)), 4, "0")), "")


def _longs(values: list) -> Column:
    return F.expr("CAST(array(" + ", ".join(f"{v}L" if v >= -(1 << 63) + 1 else
                                            "bigint('-9223372036854775808')" for v in values)
                  + ") AS array<bigint>)")


def _range_of(order: Column, bounds: list) -> Column:
    """Number of bounds that are not above the value, in two steps of about their root."""
    if not bounds:
        return F.lit(0)
    step = max(1, int(len(bounds) ** 0.5))
    every, coarse = _longs(bounds), _longs(bounds[::step])

    def fine(c):
        start = F.greatest(c - 1, F.lit(0)) * step
        return start + F.size(F.filter(F.slice(every, start + 1, step), lambda b: b <= order))
    return _let(F.size(F.filter(coarse, lambda b: b <= order)), fine)


def beside_next(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, text) dealt out so that each range holds its documents and, as a guest
    that sorts last, the document after them."""
    spark = docs.sparkSession
    rows = docs.select("doc_id", "text", F.coalesce(
        F.col("doc_id").cast("bigint"), F.lit(-(1 << 63))).alias("_order"))
    ranges = RANGES_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    marks = rows.agg(F.percentile_approx(
        "_order", [i / ranges for i in range(1, ranges)], 20 * ranges).alias("m")).first()["m"]
    bounds = sorted(set(marks or []))
    rows = rows.withColumn("_range", _range_of(F.col("_order"), bounds).cast("int"))
    # The smallest id of each range; as many rows as ranges.
    heads = sorted((r["_range"], r["head"]) for r in
                   rows.select("_range", "_order").groupBy("_range")
                   .agg(F.min("_order").alias("head")).collect())
    if not heads:
        return rows.withColumn("_guest", F.lit(False)).withColumn("_tie", F.xxhash64("text"))
    head, before = [0] * (len(bounds) + 1), [0] * (len(bounds) + 1)
    for i, (at, first) in enumerate(heads):
        head[at], before[at] = first, heads[i - 1][0]
    own = F.struct(F.col("_range").alias("r"), F.lit(False).alias("g"))
    guest = F.struct(F.get(_longs(before), F.col("_range")).cast("int").alias("r"),
                     F.lit(True).alias("g"))
    places = F.when(F.col("_order") == F.get(_longs(head), F.col("_range")),
                    F.array(own, guest)).otherwise(F.array(own))
    return rows.select("doc_id", "text", "_order", F.xxhash64("text").alias("_tie"),
                       F.explode(places).alias("_p")).select(
        "doc_id", "text", "_order", "_tie", F.col("_p.r").alias("_range"),
        F.col("_p.g").alias("_guest"))


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text",
                 share: int = 4) -> DataFrame:
    """Fingerprints of all texts and of the texts whose last ``1 / share`` is replaced by the
    beginning of the next document."""
    slim = docs.select(F.col(f"`{key}`").alias("doc_id"), whole(f"`{text}`").alias("text"))
    with _shared_value(slim.sparkSession, "ARRAY<BIGINT>", lexicon(slim)) as bits:
        return _compared(slim, bits, share)


@contextmanager
def _shared_value(spark: SparkSession, kind: str, row: DataFrame):
    """The only value of a one-row frame as a constant; expressions made inside keep it."""
    name = f"shared_{uuid.uuid4().hex}"
    row.createOrReplaceTempView(name)
    spark.sql(f"DECLARE VARIABLE {name} {kind}")
    try:
        spark.sql(f"SET VAR {name} = (SELECT * FROM {name})")
        yield F.expr(name)
    finally:
        spark.sql(f"DROP TEMPORARY VARIABLE {name}")
        spark.catalog.dropTempView(name)


def _compared(slim: DataFrame, bits: Column, share: int) -> DataFrame:
    order = Window.partitionBy("_range").orderBy("_guest", "_order", "_tie")
    size = F.char_length("text")
    cut = F.floor(size / share).cast("int")
    paired = beside_next(slim).withColumn("_next", F.lead("text").over(order))
    edited = paired.withColumn("_edited", F.concat(
        F.substring(F.col("text"), F.lit(1), size - cut),
        F.substring(whole("_next"), F.lit(1), cut)))
    marked = edited.select(
        "doc_id", "_range", "_guest", "_order", "_tie", size.cast("bigint").alias("n_chars"),
        F.sha2("_edited", 256).alias("edited_sha256"),
        fingerprint(F.col("text"), bits).alias("_own"),
        F.when(~F.col("_guest"), fingerprint(F.col("_edited"), bits)).alias("_changed"))
    return (marked.withColumn("_after", F.lead("_own").over(order))
            .where(~F.col("_guest")).select(
                "doc_id", "n_chars", "edited_sha256", as_text(F.col("_own")).alias("fingerprint"),
                as_text(F.col("_changed")).alias("edited_fingerprint"),
                likeness(F.col("_own"), F.col("_changed")).alias("near_edited"),
                likeness(F.col("_own"), F.col("_after")).alias("near_next")))
