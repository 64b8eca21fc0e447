"""Phrase collocations counted on a prefix-free parse.

Texts are lower-cased in A-Z only, split at ``[.,;:!?\\x0A-\\x0D]`` into pieces and these at
space and tab into words. Everything is counted per language (null: ``und``).

1. *Parse.* A window of ``max_words - 1`` words whose hash is 0 modulo ``modulus`` ends a chunk
   and opens the next, which therefore overlap by that window. A text's first word opens a chunk
   and its last word closes one, so that equal passages give equal chunks wherever they stand.
   The dictionary holds each distinct chunk once, with the number of its parses.
2. *Count.* Only distinct chunks are read; an n-gram counts as often as its chunk was parsed. An
   n-gram belongs to the chunk in which it starts before the closing window, so those in an
   overlap are counted once. A chunk that closes a text ends with a line feed and owns all.
3. *Levels.* Words, pairs and longer phrases are counted by 64-bit hash first. A phrase is only
   counted if both its shorter parts may reach ``min_count``, which a bitmap of at most
   ``MOST_CELLS`` bits tells; it lets others pass too, but loses none. Phrases whose hashes
   reach the limit are then counted by their words, so counts are exact.
4. *Score.* Each cut of a candidate takes the counts of its two parts. Parts that make up a
   thousandth of all counts or more, at most 1,000 a length, are broadcast, so that no task
   gets all candidates that begin with one word.

Null texts are empty, and texts without a word add nothing. Repeated rows count each time. Ties
go by the smallest cut, then by count and UTF-8 order of the phrase. An empty table gives an
empty result. Other columns are not read. A text without a trigger is one chunk, however long.
"""

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window, functions as F

from cellpulse.llm.near_dedup import _mix, _powers
from cellpulse.llm.text import bitmap
from cellpulse.session import materialise

MOST_CELLS = 1 << 26   # bits
SLICE = 1 << 20        # bytes of text handled at once


@dataclass(frozen=True)
class Settings:
    max_words: int = 3
    min_count: int = 10
    covered: int = 50      # percent of a candidate's count in a longer one that drops it
    top: int = 2000
    modulus: int = 16


_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_KINDS = bytes(1 if b in b" \t" else 2 if b in b".,;:!?\n\x0b\x0c\r" else 0 for b in range(256))


class _Words:
    """The words of several byte strings, with hash, owner and whether a break follows."""

    def __init__(self, parts: list):
        import numpy as np
        data = b"\n".join(parts) + b"\n"
        self.codes = np.frombuffer(data, np.uint8)
        kind = np.frombuffer(data.translate(_KINDS), np.uint8)
        self.solid = kind == 0
        edges = np.flatnonzero(np.diff(self.solid.view(np.int8), prepend=0, append=0))
        self.starts, self.ends = edges[::2], edges[1::2]
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        offsets = np.cumsum(sizes + 1) - sizes - 1
        self.owner = np.searchsorted(offsets, self.starts, "right") - 1
        cuts = np.cumsum(kind == 2)
        n = len(self.starts)
        self.broken = np.ones(n, bool)
        if n:
            self.broken[:-1] = cuts[self.starts[1:] - 1] > cuts[self.ends[:-1] - 1]
        up, down, table = _powers(len(data) + 1)
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(table[self.codes] * up[:len(data)], out=total[1:])
        self.hashes = _mix((total[self.ends] - total[self.starts]) * down[self.starts]
                           + (self.ends - self.starts).astype(np.uint64))
        # End of each owner's words.
        self.last = np.searchsorted(self.owner, np.arange(len(parts)), "right")

    def joined(self):
        """All words with one space or, at a break, one line feed after each; their offsets."""
        import numpy as np
        codes, keep = self.codes.copy(), self.solid.copy()
        codes[self.ends] = np.where(self.broken, 10, 32)
        keep[self.ends] = True
        return codes[keep].tobytes(), np.concatenate(
            ([0], np.cumsum(self.ends - self.starts + 1)))


def _slices(rows, size):
    held, length = [], 0
    for row in rows:
        held.append(row)
        length += size(row)
        if length >= SLICE:
            yield held
            held, length = [], 0
    if held:
        yield held


def chunks(texts: list, settings: Settings) -> list:
    """(text number, chunk) of the parse of lower-cased texts, as bytes."""
    import numpy as np
    words, wide = _Words(texts), settings.max_words - 1
    n = len(words.starts)
    if not n:
        return []
    opens = np.zeros(n, bool)
    opens[0] = True
    opens[1:] = words.owner[1:] != words.owner[:-1]
    if wide and n >= wide:
        window = np.zeros(n - wide + 1, np.uint64)
        for i in range(wide):
            window = _mix(window * np.uint64(0x9FB21C651E98DF25)
                          + words.hashes[i:i + len(window)])
        inside = words.owner[:len(window)] == words.owner[wide - 1:]
        opens[:len(window)] |= inside & (window % np.uint64(settings.modulus) == 0)
    first = np.flatnonzero(opens)
    owner = words.owner[first]
    stop = np.append(first[1:], n) + wide
    final = np.append(owner[1:] != owner[:-1], True)
    stop = np.where(final, words.last[owner], stop)
    buffer, at = words.joined()
    return [(o, buffer[a:b]) for o, a, b in zip(
        owner.tolist(), at[first].tolist(), (at[stop] - ~final).tolist())]


def dictionary(docs: DataFrame, settings: Settings, text: str = "text",
               lang: str = "lang") -> DataFrame:
    """Stored distinct chunks (lang, chunk, n) with their number of parses."""
    slim = docs.select(F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"),
                       F.col(f"`{text}`").alias("text")).where("text IS NOT NULL")

    def run(batches):
        import pyarrow as pa
        for batch in batches:
            rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            for some in _slices(rows, lambda r: len(r[1])):
                found = chunks([t.encode("utf-8", "replace").translate(_LOWER)
                                for _, t in some], settings)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([some[i][0] for i, _ in found], pa.string()),
                     pa.array([c for _, c in found], pa.binary())], names=["lang", "chunk"])
    parsed = slim.mapInArrow(run, "lang string, chunk binary")
    return materialise(parsed.groupBy("lang", "chunk").agg(F.count(F.lit(1)).alias("n")),
                       "chunks")


def _in_bits(hashes, bits):
    import numpy as np
    cell = hashes & np.uint64(len(bits) * 64 - 1)
    return (bits[(cell >> np.uint64(6)).astype(np.int64)] >> (hashes & np.uint64(63))
            & np.uint64(1)).astype(bool)


class _Grams:
    """The n-grams of some chunks: hash and weight per level, kept if their parts may be."""

    def __init__(self, rows: list, settings: Settings, filters: list, levels: int):
        import hashlib

        import numpy as np
        wide = settings.max_words - 1
        self.words = words = _Words([c for _, c, _ in rows])
        self.rows = rows
        n = len(words.starts)
        weights = np.array([w for _, _, w in rows], np.int64)
        final = np.array([c.endswith(b"\n") for _, c, _ in rows], bool)
        known = {}
        for name in {r[0] for r in rows}:
            known[name] = int.from_bytes(
                hashlib.blake2b(name.encode("utf-8", "replace"), digest_size=8).digest())
        seed = np.array([known[r[0]] for r in rows], np.uint64)
        at = np.arange(n)
        owned = final[words.owner] | (at < words.last[words.owner] - wide)
        self.weight = weights[words.owner]
        self.hashes, self.spots = [], []
        x = seed[words.owner]
        whole = np.ones(n, bool)       # no break inside
        usual = np.ones(n, bool)       # every part may be frequent
        for k in range(levels):
            if k:
                whole = whole[:-1] & ~words.broken[k - 1:n - 1]
                usual = usual[:-1] & usual[1:] & whole
                x = x[:max(0, n - k)]
            x = _mix(x * np.uint64(0x9FB21C651E98DF25) + words.hashes[k:] + np.uint64(k))
            self.hashes.append(x)
            self.spots.append(np.flatnonzero(usual & whole & owned[:len(x)]))
            if k < len(filters):
                usual = usual & whole & _in_bits(x, filters[k])

    def sums(self, k: int, spots=None):
        """Distinct hashes of level ``k`` with a position and the sum of weights of each."""
        import numpy as np
        spots = self.spots[k] if spots is None else spots
        if not len(spots):
            return np.empty(0, np.uint64), spots, np.empty(0, np.int64)
        x = self.hashes[k][spots]
        order = np.argsort(x, kind="stable")
        x, spots = x[order], spots[order]
        new = np.flatnonzero(np.append(True, x[1:] != x[:-1]))
        return x[new], spots[new], np.add.reduceat(self.weight[spots], new)


def _rows(batch):
    return zip(*(batch.column(i).to_pylist() for i in range(3)))


def _frequent(parsed: DataFrame, settings: Settings, filters: list) -> bytes:
    """Bitmap of the hashes of the next level's phrases that reach the limit."""
    spark, k = parsed.sparkSession, len(filters)
    shared = spark.sparkContext.broadcast(filters)

    def run(batches):
        import numpy as np
        import pyarrow as pa
        held = [np.frombuffer(b, np.uint64) for b in shared.value]
        for batch in batches:
            for some in _slices(_rows(batch), lambda r: len(r[1])):
                x, _, n = _Grams(some, settings, held, k + 1).sums(k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x.view(np.int64)), pa.array(n)], names=["h", "n"])
    counted = parsed.mapInArrow(run, "h bigint, n bigint").groupBy("h").agg(F.sum("n").alias("n"))
    often = materialise(counted.where(F.col("n") >= settings.min_count).select("h"), "hashes")
    cells, wanted = 1 << 16, min(MOST_CELLS, 16 * often.count())
    while cells < wanted:
        cells *= 2
    import numpy as np
    return np.asarray(bitmap(often, cells).toPandas().iloc[0, 0], np.int64).tobytes()


def phrase_counts(parsed: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Stored (lang, phrase, words, f) of all phrases that reach the limit.

    Rows with ``words`` 0 hold the number of words of each language.
    """
    filters = []
    for _ in range(settings.max_words):
        filters.append(_frequent(parsed, settings, filters))
    shared = parsed.sparkSession.sparkContext.broadcast(filters)

    def run(batches):
        import numpy as np
        import pyarrow as pa
        held = [np.frombuffer(b, np.uint64) for b in shared.value]
        for batch in batches:
            for some in _slices(_rows(batch), lambda r: len(r[1])):
                grams = _Grams(some, settings, held, settings.max_words)
                buffer, at = grams.words.joined()
                lang, phrase, words, f = [], [], [], []
                owner = grams.words.owner
                totals = np.zeros(len(some), np.int64)
                np.add.at(totals, owner[grams.spots[0]], grams.weight[grams.spots[0]])
                per_lang = {}
                for (name, _, _), n in zip(some, totals.tolist()):
                    per_lang[name] = per_lang.get(name, 0) + n
                for name, n in per_lang.items():
                    lang.append(name)
                    phrase.append(b"")
                    words.append(0)
                    f.append(n)
                for k in range(settings.max_words):
                    spots = grams.spots[k]
                    spots = spots[_in_bits(grams.hashes[k][spots], held[k])]
                    _, spots, n = grams.sums(k, spots)
                    lang += [some[o][0] for o in owner[spots].tolist()]
                    phrase += [buffer[a:b] for a, b in zip(
                        at[spots].tolist(), (at[spots + k + 1] - 1).tolist())]
                    words += [k + 1] * len(spots)
                    f += n.tolist()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(lang, pa.string()), pa.array(phrase, pa.binary()),
                     pa.array(words, pa.int32()), pa.array(f, pa.int64())],
                    names=["lang", "phrase", "words", "f"])
    rows = parsed.mapInArrow(run, "lang string, phrase binary, words int, f bigint")
    counted = rows.groupBy("lang", "phrase", "words").agg(F.sum("f").alias("f"))
    return materialise(counted.where((F.col("f") >= settings.min_count) | (F.col("words") == 0))
                       .withColumn("phrase", F.col("phrase").cast("string")), "phrases")


def _with_part(cuts: DataFrame, known: DataFrame, usual: DataFrame, part: str,
               name: str) -> DataFrame:
    """Add the count of a part; counts of the most usual parts are broadcast."""
    keys = ["lang", part]
    often = F.broadcast(usual.select("lang", F.col("phrase").alias(part),
                                     F.col("f").alias(name)))
    other = known.select("lang", F.col("phrase").alias(part), F.col("f").alias(name))
    rest = cuts.join(often, keys, "left_anti").join(other, keys)
    return cuts.join(often, keys).unionByName(rest)


def scored(counted: DataFrame) -> DataFrame:
    """(lang, phrase, words, a, l, r, score) of each candidate at its lowest cut."""
    known = counted.where("words > 0")
    total = known.agg(F.sum("f").alias("n")).collect()[0]["n"] or 0
    usual = known.where(F.col("f") * 1000 >= F.lit(total))
    cuts = (counted.where("words > 1").withColumnRenamed("f", "a")
            .withColumn("k", F.explode(F.expr("sequence(1, words - 1)")))
            .withColumn("_first", F.expr("substring_index(phrase, ' ', k)"))
            .withColumn("_rest", F.expr("substring_index(phrase, ' ', k - words)")))
    both = _with_part(_with_part(cuts, known, usual, "_first", "l"), known, usual, "_rest", "r")
    wide = {c: f"CAST({c} AS DECIMAL(19, 0))" for c in "alr"}
    score = F.expr(f"CAST(({wide['a']} * {wide['a']} * CAST(1000000 AS DECIMAL(7, 0)))"
                   f" div ({wide['l']} * {wide['r']}) AS BIGINT)")
    best = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("best")
    return both.groupBy("lang", "phrase", "words", "a").agg(best).select(
        "lang", "phrase", "words", "a", "best.l", "best.r", "best.score")


def uncovered(candidates: DataFrame, settings: Settings) -> DataFrame:
    """Candidates without a longer one that holds their words often enough."""
    pieces = F.expr("""flatten(transform(sequence(2, words - 1), n ->
        transform(sequence(1, words - n + 1), i ->
            array_join(slice(split(phrase, ' '), i, n), ' '))))""")
    inner = (candidates.where("words > 2")
             .select("lang", F.explode(pieces).alias("phrase"), "a")
             .groupBy("lang", "phrase").agg(F.max("a").alias("_longer")))
    return (candidates.join(inner, ["lang", "phrase"], "left")
            .where(F.coalesce(100 * F.col("_longer") < settings.covered * F.col("a"),
                              F.lit(True))).drop("_longer"))


def collocations(docs: DataFrame, settings: Settings = Settings(), text: str = "text",
                 lang: str = "lang") -> DataFrame:
    """Each language's best phrases: (lang, rank, phrase, a, l, r, n, score)."""
    counted = phrase_counts(dictionary(docs, settings, text, lang), settings)
    left = uncovered(scored(counted), settings)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = left.withColumn("rank", F.row_number().over(order)).where(
        F.col("rank") <= settings.top)
    totals = counted.where("words = 0").select("lang", F.col("f").alias("n"))
    return best.join(totals, "lang").select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")


COLLOCATIONS_SQL = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                  'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), words AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), grams AS (
    SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2),
                                          lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
    FROM words, (VALUES (1), (2), (3)) AS sizes(k) WHERE len(w) >= k
), counts AS MATERIALIZED (
    SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL
), totals AS (
    SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counts WHERE k = 1 GROUP BY lang
), candidates AS (
    SELECT *, string_split(phrase, ' ') AS w FROM counts WHERE k > 1 AND f >= 10
), cuts AS MATERIALIZED (
    SELECT lang, phrase, k, f AS a, i AS cut, array_to_string(w[1:i], ' ') AS head,
           array_to_string(w[i + 1:], ' ') AS rest
    FROM candidates, (VALUES (1), (2)) AS spots(i) WHERE i < k
), heads AS MATERIALIZED (
    SELECT c.*, p.f AS l FROM cuts c JOIN counts p ON p.lang = c.lang AND p.phrase = c.head
), parts AS MATERIALIZED (
    SELECT c.*, q.f AS r, 1000000::HUGEINT * a * a // (l::HUGEINT * q.f) AS score
    FROM heads c JOIN counts q ON q.lang = c.lang AND q.phrase = c.rest
), best AS (
    SELECT * FROM parts
    QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), inner_pairs AS (
    SELECT lang, phrase, max(f) AS longer FROM (
        SELECT lang, array_to_string(w[1:2], ' ') AS phrase, f FROM candidates WHERE k = 3
        UNION ALL SELECT lang, array_to_string(w[2:3], ' '), f FROM candidates WHERE k = 3)
    GROUP BY ALL
), ranked AS (
    SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC,
                                   encode(b.phrase)) AS place
    FROM best b LEFT JOIN inner_pairs p ON p.lang = b.lang AND p.phrase = b.phrase
    WHERE b.k = 3 OR p.longer IS NULL OR 100 * p.longer < 50 * b.a
)
SELECT r.lang, place AS rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score
FROM ranked r JOIN totals t ON t.lang = r.lang WHERE place <= 2000
"""
