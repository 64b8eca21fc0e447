"""Mixing sources to target weights, with DataFrame functions only.

1. The words of each source, document after document, are packed into blocks of ``block`` words.
   A document's place in its source's stream is a running total over range-sorted rows, so a
   source with a third of all rows is spread over many tasks.
2. A source's target is its share by weight of ``ratio`` times all words, at most ``limit`` times
   its own words; the excess goes to the other sources by weight until none is above.
3. The mix is a row of block slots, cut into output shards of ``shard`` slots. In each shard the
   sources' slots are one multinomial draw: every slot draws a source with chances in proportion
   to the slots it should have. Draws beyond a source's whole number of slots are handed to the
   sources that drew too few, so the totals over all shards meet the targets.
4. Slot j of a source reads block perm(j mod blocks), where perm is a pseudorandom permutation
   of the source's block indices, another one for each pass over the source. Blocks are joined
   by that index.

``mixed_blocks`` returns the mix itself, a row per slot with its shard and the block's text;
``mix_sizes`` gives per document the words taken and the first slot that holds some of them;
``mixed_documents`` keeps documents together. Another ``draw`` moves blocks between shards and
leaves targets and taken words as they are.

Everything follows from hashes of a seed, so reruns agree. Null text has no words. A null source
is a source of its own and sorts last. Repeated rows are documents of their own. Sources without
a word have target 0 and take nothing. An empty table gives an empty result.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from cellpulse.llm.text import BLANK_RUN, WORD, whole, words
from cellpulse.operators.ordering import row_index, running_totals
from cellpulse.session import materialise

WEIGHTS = (3, 1, 2)
ROUNDS = 8      # of the permutation, and one more for each doubling of the blocks


@dataclass(frozen=True)
class Settings:
    weights: tuple = WEIGHTS    # in order of the source names, repeating
    ratio: float = 1.5
    limit: int = 2
    block: int = 64             # words
    shard: int = 8192           # slots
    seed: int = 17
    draw: int = 0               # another number gives other multinomial draws


def _uniform(*cols) -> Column:
    """A number in [0, 1) from a hash."""
    return F.shiftrightunsigned(F.xxhash64(*cols), 11) * F.lit(2.0 ** -53)


def sized(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text",
          row: str = None) -> DataFrame:
    """Stored rows (row, doc_id, source, size): words per document, without the texts.

    ``row`` names a column that tells rows apart; without it, rows are numbered.
    """
    count = F.size(words(whole(f"`{text}`"))).cast("bigint")
    slim = docs.select(F.col(f"`{key}`").alias("doc_id"),
                       F.col(f"`{source}`").cast("string").alias("source"), count.alias("size"),
                       (F.col(f"`{row}`") if row else F.monotonically_increasing_id())
                       .alias("row"))
    return materialise(slim, "sizes")


def targets(sizes: DataFrame, s: Settings) -> DataFrame:
    """One row per source: no, source_size, target, blocks and slots."""
    sums = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    # Null last, the others by code point: UTF-8 bytes sort like code points.
    named = sums.withColumn("_null", F.col("source").isNull()).withColumn(
        "_name", F.coalesce("source", F.lit("")))
    ranked = row_index(named, ["_null", "_name"], name="no").drop("_null", "_name")
    weights = F.array(*[F.lit(float(w)) for w in s.weights])
    rows = ranked.withColumn(
        "weight", F.get(weights, ((F.col("no") - 1) % len(s.weights)).cast("int"))
    ).withColumn("most", F.col("source_size") * F.lit(float(s.limit)))
    rows = materialise(rows.withColumn("_full", F.col("most") / F.col("weight")), "sources")
    total = rows.agg(F.sum("source_size").alias("n")).first()["n"] or 0
    # In order of most / weight, a source is full if the level left to the rest is no lower.
    runs = running_totals(rows, ["_full", "no"], ["most", "weight"])
    spread = F.lit(total * s.ratio)
    left = spread - (F.col("most_cum") - F.col("most"))
    level = left / (F.col("weight_total") - (F.col("weight_cum") - F.col("weight")))
    levels = runs.withColumn("_level", level)
    # The level at which the first source stays below its limit holds for all that follow.
    settled = levels.where(F.col("_level") < F.col("_full")).agg(
        F.min_by("_level", F.struct("_full", "no")).alias("_at"))
    at = settled.first()
    share = (F.lit(None).cast("double") if at["_at"] is None
             else F.lit(float(at["_at"])) * F.col("weight"))
    target = (F.col("most") if at["_at"] is None else F.least(F.col("most"), share))
    blocks = F.ceil(F.col("source_size") / s.block)
    return materialise(rows.select(
        "source", "no", "source_size", target.alias("target"), blocks.alias("blocks"),
        F.least(s.limit * blocks, F.ceil(target / s.block)).alias("slots")), "targets")


def _by_interval(points: DataFrame, at: str, spans: DataFrame, keep: list) -> DataFrame:
    """Join each point with the span [lo, hi) that holds it; spans do not overlap.

    Points and spans meet in cells of equal width, as many as there are spans on average four
    times over, so a point is compared with the few spans of its cell.
    """
    bounds = spans.agg(F.max("hi").alias("top"), F.count(F.lit(1)).alias("n")).first()
    width = max(1, -(-int(bounds["top"] or 0) // max(1, 4 * bounds["n"])))
    cells = spans.select("lo", "hi", *keep, F.explode(F.sequence(
        F.floor(F.col("lo") / width), F.floor((F.col("hi") - 1) / width))).alias("_cell"))
    cell = F.floor(F.col(at) / width)
    return (points.withColumn("_cell", cell).join(cells, "_cell")
            .where((F.col(at) >= F.col("lo")) & (F.col(at) < F.col("hi"))).drop("_cell"))


def slots(sources: DataFrame, s: Settings) -> DataFrame:
    """The mix: one row (shard, slot, no, j) per block slot; j counts a source's slots."""
    spark = sources.sparkSession
    runs = materialise(
        running_totals(sources.where("slots > 0").select("no", "blocks", "slots"),
                       ["no"], ["slots"])
        .select("no", "blocks", "slots", (F.col("slots_cum") - F.col("slots")).alias("lo"),
                F.col("slots_cum").alias("hi")), "spans")
    total = runs.agg(F.max("hi").alias("n")).first()["n"] or 0
    every = spark.range(total).select(
        (F.col("id") / s.shard).cast("bigint").alias("shard"), F.col("id").alias("slot"))
    drawn = every.withColumn("_at", F.least(
        F.lit(total - 1), F.floor(_uniform(F.lit(s.seed), F.lit(s.draw), "slot") * total)))
    counted = materialise(_by_interval(drawn, "_at", runs, ["no"]).select(
        "shard", "slot", "no"), "draws")
    # Number the draws of each source: inside the shard, and over the shards before.
    tally = counted.groupBy("no", "shard").agg(F.count(F.lit(1)).alias("n"))
    earlier = running_totals(tally, ["shard"], ["n"], ["no"]).select(
        "no", "shard", (F.col("n_cum") - F.col("n")).alias("_before"),
        F.col("n_total").alias("_drawn"))
    inside = Window.partitionBy("no", "shard").orderBy("slot")
    placed = (counted.withColumn("_i", F.row_number().over(inside))
              .join(earlier, ["no", "shard"])
              .select("shard", "slot", "no",
                      (F.col("_before") + F.col("_i") - 1).alias("j"), "_drawn"))
    placed = materialise(placed, "placed")
    totals = placed.groupBy("no").agg(F.max("_drawn").alias("drawn"))
    gaps = (runs.select("no", "slots").join(totals, "no", "left")
            .withColumn("drawn", F.coalesce("drawn", F.lit(0)))
            .withColumn("over", F.greatest(F.col("drawn") - F.col("slots"), F.lit(0)))
            .withColumn("under", F.greatest(F.col("slots") - F.col("drawn"), F.lit(0))))
    sums = materialise(running_totals(gaps, ["no"], ["over", "under"]), "gaps")
    known = placed.drop("_drawn").join(
        sums.select("no", "slots", (F.col("over_cum") - F.col("over")).alias("_first")), "no")
    kept = known.where(F.col("j") < F.col("slots")).select("shard", "slot", "no", "j")
    spare = known.where(F.col("j") >= F.col("slots")).select(
        "shard", "slot", (F.col("_first") + F.col("j") - F.col("slots")).alias("_at"))
    wanting = sums.where("under > 0").select(
        F.col("no"), "drawn", (F.col("under_cum") - F.col("under")).alias("lo"),
        F.col("under_cum").alias("hi"))
    moved = _by_interval(spare, "_at", wanting, ["no", "drawn"]).select(
        "shard", "slot", "no", (F.col("drawn") + F.col("_at") - F.col("lo")).alias("j"))
    return kept.union(moved)


def permuted(rows: DataFrame, s: Settings, index: str = "_x") -> DataFrame:
    """Replace ``index`` by its place in a permutation of 0 .. blocks - 1 given by (no, pass).

    Each round pairs x with (k - x) mod blocks and swaps the pair or not by a hash of the
    pair, which keeps it one to one for any number of blocks. A round doubles the places that
    x can reach, so the rounds grow with the logarithm of the blocks.
    """
    blocks, own = F.col("blocks"), F.col("_own")

    def step(x, r):
        other = F.pmod(F.pmod(F.xxhash64(own, r), blocks) - x, blocks)
        swap = F.xxhash64(own, -r, F.greatest(x, other))
        return F.when(swap.bitwiseAND(F.lit(1)) == 1, other).otherwise(x)
    rounds = F.sequence(F.lit(1), F.length(F.bin(blocks)) + ROUNDS)
    known = rows.withColumn("_own", F.xxhash64(F.lit(s.seed), "no", "pass"))
    return known.withColumn(index, F.aggregate(
        rounds, F.col(index).cast("bigint"), step)).drop("_own")


def placements(sources: DataFrame, s: Settings) -> DataFrame:
    """The block that each slot of the mix reads: (shard, slot, no, index)."""
    mix = (slots(sources, s).join(sources.select("no", "blocks"), "no")
           .withColumn("pass", F.floor(F.col("j") / F.col("blocks")))
           .withColumn("_x", F.col("j") % F.col("blocks")))
    return permuted(mix, s).select("shard", "slot", "no", F.col("_x").alias("index"))


def block_counts(sources: DataFrame, s: Settings) -> DataFrame:
    """How often the mix takes each block, and its first slot: (no, index, times, first_slot)."""
    return placements(sources, s).groupBy("no", "index").agg(
        F.count(F.lit(1)).alias("times"), F.min("slot").alias("first_slot"))


def parts(sizes: DataFrame, sources: DataFrame, s: Settings) -> DataFrame:
    """Stretches of a document that lie in one block: (row, no, index, first, words, at).

    ``first`` counts words in the document, ``at`` in the block.
    """
    stream = running_totals(sizes.where("size > 0"), ["doc_id", "row"], ["size"], ["source"])
    numbered = stream.join(sources.select(F.col("source").alias("_s"), "no"),
                           F.col("source").eqNullSafe(F.col("_s")))
    start = F.col("size_cum") - F.col("size")
    spread = numbered.select(
        "row", "no", start.alias("start"), F.col("size_cum").alias("end"),
        F.explode(F.sequence(F.floor(start / s.block),
                             F.floor((F.col("size_cum") - 1) / s.block))).alias("index"))
    first = F.greatest(F.col("start"), F.col("index") * s.block)
    last = F.least(F.col("end"), (F.col("index") + 1) * s.block)
    return spread.select("row", "no", "index", (first - F.col("start")).alias("first"),
                         (last - first).alias("words"),
                         (first - F.col("index") * s.block).alias("at"))


def mix(docs: DataFrame, s: Settings = Settings(), key: str = "doc_id", source: str = "source",
        text: str = "text", row: str = None) -> tuple:
    """(sizes, sources, taken parts) of the mix; parts carry ``times`` >= 1."""
    sizes = sized(docs, key, source, text, row)
    sources = targets(sizes, s)
    taken = parts(sizes, sources, s).join(block_counts(sources, s), ["no", "index"])
    return sizes, sources, taken


def mix_sizes(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Per document: size, source_size, target and the words the mix takes of it.

    ``first_shard`` and ``first_slot`` name its first place in the mix, null if nothing is taken.
    """
    sizes, sources, taken = mix(docs, s)
    words = taken.groupBy("row").agg(F.sum(F.col("words") * F.col("times")).alias("_taken"),
                                     F.min("first_slot").alias("first_slot"))
    named = sources.select(F.col("source").alias("_s"), "source_size", "target")
    return (sizes.join(words, "row", "left")
            .join(named, F.col("source").eqNullSafe(F.col("_s")))
            .select("doc_id", "size", "source_size", "target",
                    F.coalesce("_taken", F.lit(0)).alias("taken"),
                    (F.col("first_slot") / s.shard).cast("bigint").alias("first_shard"),
                    "first_slot"))


def mixed_blocks(docs: DataFrame, s: Settings = Settings(), key: str = "doc_id",
                 source: str = "source", text: str = "text") -> DataFrame:
    """The mix as it is read: (shard, slot, source, text), one row per slot.

    A block's text is its words in order, with one space between them.
    """
    slim = materialise(docs.select(
        F.col(f"`{key}`").alias("doc_id"), F.col(f"`{source}`").cast("string").alias("source"),
        F.col(f"`{text}`").alias("text"), F.monotonically_increasing_id().alias("row")),
        "documents")
    sizes = sized(slim, row="row")
    sources = targets(sizes, s)
    spans = parts(sizes, sources, s).groupBy("row").agg(
        F.collect_list(F.struct("no", "index", "at", "first", "words")).alias("spans"))
    held = slim.join(spans, "row").select("spans", words(whole("text")).alias("all"))
    pieces = held.select(F.inline(F.transform("spans", lambda p: F.struct(
        p["no"].alias("no"), p["index"].alias("index"), p["at"].alias("at"),
        F.array_join(F.slice("all", (p["first"] + 1).cast("int"), p["words"].cast("int")), " ")
        .alias("piece")))))
    blocks = pieces.groupBy("no", "index").agg(F.array_join(F.transform(
        F.sort_array(F.collect_list(F.struct("at", "piece"))), lambda p: p["piece"]), " ")
        .alias("text"))
    names = sources.select("no", "source")
    return (placements(sources, s).join(blocks, ["no", "index"]).join(names, "no")
            .select("shard", "slot", "source", "text"))


def mixed_documents(docs: DataFrame, s: Settings = Settings(), key: str = "doc_id",
                    source: str = "source", text: str = "text",
                    n_chars: str = "n_chars") -> DataFrame:
    """The mix as documents: one row for each pass that takes words of a document.

    A row's text is the document's stretches in the blocks taken in that pass, in order and
    with the blanks after their words; a document taken whole keeps its text. Columns unchanged,
    ``n_chars`` follows the text. Documents of which the mix takes nothing are gone.
    """
    row, spans, taken_row = "_row", "_spans", "_taken_row"
    while {row, spans, taken_row} & set(docs.columns):
        row, spans, taken_row = "_" + row, "_" + spans, "_" + taken_row
    stored = materialise(docs.withColumn(row, F.monotonically_increasing_id()), "documents")
    _, _, taken = mix(stored, s, key, source, text, row)
    per_row = taken.groupBy(F.col("row").alias(taken_row)).agg(
        F.sort_array(F.collect_list(F.struct("first", "words", "times"))).alias(spans))
    joined = stored.join(per_row, F.col(f"`{row}`") == F.col(taken_row))
    passes = F.explode(F.sequence(F.lit(0), F.array_max(F.transform(
        spans, lambda p: p["times"])).cast("int") - 1))
    kept = joined.select(*[F.col(f"`{c}`") for c in docs.columns], spans, passes.alias(row))
    own = kept.withColumn(spans, F.filter(spans, lambda p: p["times"] > F.col(f"`{row}`")))
    body = F.col(f"`{text}`")
    tokens = F.regexp_extract_all(body, F.lit(f"{WORD}{BLANK_RUN[:-1]}*"), 0)
    held = F.aggregate(spans, F.lit(0).cast("bigint"), lambda n, p: n + p["words"])
    cut = F.element_at(F.transform(F.array(tokens), lambda all_: F.when(
        F.size(all_) == held, body).otherwise(F.array_join(F.flatten(F.transform(
            spans, lambda p: F.slice(all_, (p["first"] + 1).cast("int"),
                                     p["words"].cast("int")))), ""))), 1)
    out = own.withColumn(text, cut)
    return out.select(*[F.char_length(F.col(f"`{text}`")).cast(kind).alias(n) if n == n_chars
                        else F.col(f"`{n}`") for n, kind in docs.dtypes])
