"""Quality rules on cross-document line frequency, with DataFrame functions only.

Lines are normalised (lower case, blanks and digits reduced) and hashed. Per host, the number
of distinct documents that hold a line is counted; exact copies of a text count as one document,
so that copies do not make each other's lines look like boilerplate. A line held by more than
``max_documents`` of them, or by more than ``max_share`` of the host's distinct documents and
``LEAST_DOCUMENTS`` at least, is boilerplate and removed. A document is rejected if fewer than ``min_left`` of its words remain.

One pass over the texts stores per document the base figures and its line hashes; everything
after that works on hashes. Line hashes are made distinct inside a document and counted map-side,
so a line that every document holds is one row per task.

Null text counts as empty (no words: base_failed). A null host is a host of its own. Repeated
rows are judged each on its own. An empty table gives an empty result.
"""

from pyspark.sql import Column, DataFrame, functions as F

from cellpulse.llm.text import BLANK_RUN, whole, words
from cellpulse.session import materialise

SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
MAX_DOCUMENTS = 50
MAX_SHARE = 0.02
LEAST_DOCUMENTS = 3
MIN_LEFT = 0.5


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def window_hashes(hashes: Column, size: int = WINDOW) -> Column:
    """Hash of every window of ``size`` words, from the array of word hashes."""
    starts = F.when(F.size(hashes) >= size, F.sequence(F.lit(1), F.size(hashes) - (size - 1))
                    ).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.xxhash64(F.slice(hashes, i, size)))


def repeat_words(windows: Column, size: int = WINDOW) -> Column:
    """Words that lie in windows found twice or more in the text, from its window hashes.

    Only texts with equal windows are sorted. Each repeated window adds the words up to the
    start of the next one, its whole length at most.
    """
    def spots(ordered):
        def same(i, j):
            return F.coalesce(F.get(ordered, i)["h"] == F.get(ordered, j)["h"], F.lit(False))
        marked = F.transform(ordered, lambda x, i: F.when(
            same(i, i - 1) | same(i, i + 1), x["i"]))
        return F.sort_array(F.filter(marked, lambda i: i.isNotNull()))

    def covered(at):
        steps = F.transform(at, lambda p, k: F.least(
            F.lit(size), F.coalesce(F.get(at, k + 1) - p, F.lit(size))))
        return F.aggregate(steps, F.lit(0).cast("bigint"), lambda a, b: a + b)
    ordered = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"),
                                                                      i.alias("i"))))
    return F.when(F.size(F.array_distinct(windows)) < F.size(windows),
                  _let(_let(ordered, spots), covered)).otherwise(F.lit(0).cast("bigint"))


def base_figures(docs: DataFrame, keep: list) -> DataFrame:
    """One pass over the texts: base figures and distinct line hashes with their words."""
    cut = docs.withColumn("_words", words(F.col("_text"))).withColumn(
        "_lines", F.filter(F.split("_text", "\n"), lambda l: F.trim(F.translate(
            l, "\t\x0b\x0c\r", "    ")) != ""))
    hashed = cut.withColumn("_hashes", F.transform("_words", lambda w: F.xxhash64(w)))
    with_windows = hashed.withColumn("_windows", window_hashes(F.col("_hashes")))
    normal = F.transform("_lines", lambda l: F.struct(
        F.xxhash64(F.regexp_replace(F.regexp_replace(F.lower(l), BLANK_RUN, " "), "[0-9]+", "0"))
        .alias("h"),
        F.size(words(l)).cast("bigint").alias("w")))
    return with_windows.select(
        *keep, F.xxhash64("_text").alias("_copy"),
        F.size("_words").cast("bigint").alias("n_words"),
        F.char_length(F.regexp_replace("_text", BLANK_RUN, "")).cast("bigint").alias("word_chars"),
        (F.char_length("_text") - F.char_length(F.translate("_text", SYMBOLS, "")))
        .cast("bigint").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint")
        .alias("n_dup_lines"),
        repeat_words(F.col("_windows")).alias("n_repeat_words"),
        normal.alias("_marks"))


def judge(docs: DataFrame, key: str = "doc_id", host: str = "source", text: str = "text",
          max_documents: int = MAX_DOCUMENTS, max_share: float = MAX_SHARE,
          min_left: float = MIN_LEFT) -> DataFrame:
    """Base figures, ``base_failed``, words left and ``kept`` of every document."""
    slim = docs.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{host}`").alias("host"),
                       whole(f"`{text}`").alias("_text"))
    rows = materialise(
        base_figures(slim, ["doc_id", "host"])
        .withColumn("_row", F.monotonically_increasing_id()), "line-quality")

    marks = F.array_distinct(F.transform("_marks", lambda m: m["h"]))
    distinct = (rows.select("host", "_copy", marks.alias("hashes"))
                .groupBy("host", "_copy").agg(F.first("hashes").alias("hashes")))
    sizes = distinct.groupBy("host").agg(F.count(F.lit(1)).alias("documents"))
    # A host's documents are its texts; its size goes with the counts of its lines.
    counts = (distinct.select("host", F.explode("hashes").alias("h"))
              .groupBy("host", "h").agg(F.count(F.lit(1)).alias("n"))
              .where(F.col("n") >= min(LEAST_DOCUMENTS, max_documents + 1)))
    common = (counts.join(sizes, counts["host"].eqNullSafe(sizes["host"]))
              .where((F.col("n") > max_documents) | (F.col("n") >= LEAST_DOCUMENTS)
                     & (F.col("n") > max_share * F.col("documents")))
              .select(counts["host"].alias("_host"), F.col("h").alias("_h")))

    lines = rows.select("_row", "host", F.explode("_marks").alias("m")).select(
        "_row", "host", F.col("m.h").alias("h"), F.col("m.w").alias("w"))
    removed = (lines.join(common, lines["host"].eqNullSafe(common["_host"])
                          & (lines["h"] == common["_h"]))
               .groupBy("_row").agg(F.sum("w").alias("_gone")))
    gone = F.coalesce(F.col("_gone"), F.lit(0))
    failed = ((F.col("n_words") < MIN_WORDS)
              | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))
    return rows.join(removed, "_row", "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        gone.alias("n_common_words"), failed.alias("base_failed"),
        (~failed & (F.col("n_words") - gone >= min_left * F.col("n_words"))).alias("kept"))
