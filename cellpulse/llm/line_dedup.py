"""Line dedup by pairwise alignment.

Overlapping documents are found through shared rare line hashes: every line opens a run of
itself and the following lines up to ``min_words`` words, and the hash of a run is rare by its
length. Two documents share a block of at least that many words only if they share a run, so
no block is missed. A run's first holder, the document of smallest id, is paired with each later
holder: the number of pairs follows the number of lines, not the square of a group, and nothing
needs a cap for runs that thousands of documents hold.

A pair is aligned by patience diff on its common lines: lines unique in both documents, longest
increasing sequence, then the same between two matches, and equal neighbours at both ends.
Common blocks, runs of matched lines adjacent in both documents, are deleted from the later
document if they hold ``min_words`` words. One alignment leaves passages in another order and
second copies; the rest of the later document is searched for every run of ``min_words`` words
that the earlier one holds, and these blocks go too.

Lines are compared by the 128-bit hash of their words; lines without a word do not count and go
with the block around them. Null text has no lines and stays null. Rows that repeat an id are
one document if their texts are equal; other texts of the same id are ordered by a hash. Null
ids sort first. An empty table gives an empty result.
"""

from bisect import bisect_left

from pyspark.sql import DataFrame, functions as F

from cellpulse.llm.text import release
from cellpulse.session import materialise

MIN_WORDS = 30
SLICE = 1 << 22  # characters of text whose lines are held at once
_LINES = ("doc bigint, tie bigint, at int, raw int, h1 bigint, h2 bigint, w int, "
          "r1 bigint, r2 bigint")


def _signed(value: int) -> tuple:
    """A 128-bit number as two signed 64-bit ones."""
    high, low = value >> 64, value & (1 << 64) - 1
    return high - (1 << 64 if high >> 63 else 0), low - (1 << 64 if low >> 63 else 0)


def line_rows(text: str, min_words: int) -> list:
    """(position, raw line number, hash, words, run hash or None) of each line with a word."""
    from xxhash import xxh3_128_digest, xxh3_128_intdigest
    rows = []
    for raw, line in enumerate(text.encode().split(b"\n")):
        parts = line.split()
        if parts:
            rows.append((raw, xxh3_128_digest(b" ".join(parts)), len(parts)))
    out, end, held = [], 0, 0
    for at, (raw, digest, w) in enumerate(rows):
        while end < len(rows) and held < min_words:
            held += rows[end][2]
            end += 1
        run = (xxh3_128_intdigest(b"".join(d for _, d, _ in rows[at:end]))
               if held >= min_words else None)
        out.append((at, raw, int.from_bytes(digest, "big"), w, run))
        held -= w
    return out


def lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Stored line table of rows (doc, tie, text)."""
    def run(batches):
        import pyarrow as pa
        names = ["doc", "tie", "at", "raw", "h1", "h2", "w", "r1", "r2"]
        kinds = [pa.int32()] * 2 + [pa.int64()] * 2 + [pa.int32()] + [pa.int64()] * 2
        def as_batch(batch, owner, columns):
            return pa.RecordBatch.from_arrays(
                [batch.column(i).take(pa.array(owner, pa.int64())) for i in (0, 1)]
                + [pa.array(c, k) for c, k in zip(columns, kinds)], names=names)
        for batch in batches:
            owner, columns, read = [], [[] for _ in kinds], 0
            for i in range(len(batch)):
                text = batch.column(2)[i].as_py() or ""
                for at, raw, h, w, r in line_rows(text, min_words):
                    owner.append(i)
                    for column, value in zip(columns, (
                            at, raw, *_signed(h), w, *(_signed(r) if r is not None
                                                       else (None, None)))):
                        column.append(value)
                read += len(text)
                if read >= SLICE:
                    yield as_batch(batch, owner, columns)
                    owner, columns, read = [], [[] for _ in kinds], 0
            yield as_batch(batch, owner, columns)
        release()
    return materialise(docs.mapInArrow(run, _LINES), "lines")


def overlapping(found: DataFrame) -> DataFrame:
    """Distinct pairs (doc, tie, doc0, tie0): a document and the first holder of a run of it."""
    me = F.struct("doc", "tie")
    runs = found.where("r1 IS NOT NULL")
    first = (runs.groupBy("r1", "r2").agg(F.min(me).alias("first"), F.max(me).alias("last"))
             .where("first <> last").drop("last"))
    return (runs.join(first, ["r1", "r2"]).where(me != F.col("first"))
            .select("doc", "tie", F.col("first.doc").alias("doc0"),
                    F.col("first.tie").alias("tie0")).distinct())


def _increasing(pairs: list) -> list:
    """Longest sequence of pairs increasing on both sides; pairs come sorted by the first."""
    tops, heads, back = [], [], [None] * len(pairs)
    for i, (_, b) in enumerate(pairs):
        at = bisect_left(tops, b)
        if at == len(tops):
            tops.append(b)
            heads.append(i)
        else:
            tops[at], heads[at] = b, i
        back[i] = heads[at - 1] if at else None
    out, i = [], heads[-1] if heads else None
    while i is not None:
        out.append(pairs[i])
        i = back[i]
    return out[::-1]


def patience(a: list, b: list) -> list:
    """Matched index pairs of two sequences of line hashes."""
    matched, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            matched.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            matched.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        once = []
        for seq, lo, hi in ((a, a0, a1), (b, b0, b1)):
            spots, twice = {}, set()
            for i in range(lo, hi):
                if seq[i] in spots:
                    twice.add(seq[i])
                spots[seq[i]] = i
            once.append({h: i for h, i in spots.items() if h not in twice})
        anchors = _increasing([(i, once[1][h]) for h, i in once[0].items() if h in once[1]])
        if not anchors:
            continue
        matched += anchors
        ends = [(a0 - 1, b0 - 1), *anchors, (a1, b1)]
        todo += [(x + 1, u, y + 1, v) for (x, y), (u, v) in zip(ends, ends[1:])]
    return sorted(matched)


def common_blocks(later: list, earlier: list, min_words: int) -> list:
    """(first raw, last raw, words) of blocks to delete from the later document.

    Both sides list the common lines in order: ``later`` as (position, hash, raw, words),
    ``earlier`` as (position, hash). Matches whose positions step by one form a block. What the
    alignment leaves of the later document is searched for runs of the earlier one.
    """
    blocks, last = [], None
    for i, j in patience([x[1] for x in later], [x[1] for x in earlier]):
        at, spot = later[i][0], earlier[j][0]
        if last and at == last[0] + 1 and spot == last[1] + 1:
            blocks[-1].append(later[i])
        else:
            blocks.append([later[i]])
        last = at, spot
    blocks = [b for b in blocks if sum(x[3] for x in b) >= min_words]
    gone = {x[0] for b in blocks for x in b}
    blocks += moved_blocks([x for x in later if x[0] not in gone], earlier, min_words)
    return sorted((b[0][2], b[-1][2], sum(x[3] for x in b)) for b in blocks)


def _run_end(lines: list, words: list, start: int, min_words: int) -> int:
    """End of the shortest run of adjacent lines from ``start`` with ``min_words``, or 0."""
    held = 0
    for end in range(start, len(lines)):
        if lines[end][0] != lines[start][0] + end - start:
            return 0
        held += words[end]
        if held >= min_words:
            return end + 1
    return 0


def moved_blocks(left: list, earlier: list, min_words: int) -> list:
    """Blocks of ``left`` that the earlier document holds anywhere: moved or repeated ones.

    No run of ``min_words`` that both hold remains outside the blocks.
    """
    words = [x[3] for x in left]
    ends = [_run_end(left, words, i, min_words) for i in range(len(left))]
    if not any(ends):
        return []
    size = {x[1]: x[3] for x in left}
    words = [size.get(h, min_words) for _, h in earlier]
    spots = {}
    for j in range(len(earlier)):
        end = _run_end(earlier, words, j, min_words)
        if end:
            spots.setdefault(tuple(h for _, h in earlier[j:end]), j)
    blocks, i = [], 0
    while i < len(left):
        j = spots.get(tuple(x[1] for x in left[i:ends[i]])) if ends[i] else None
        if j is None:
            i += 1
            continue
        first, shift = i, j - i
        i, step = ends[i], earlier[j][0] - left[i][0]
        while (i < len(left) and i + shift < len(earlier) and left[i][0] == left[i - 1][0] + 1
               and left[i][1] == earlier[i + shift][1]
               and earlier[i + shift][0] == left[i][0] + step):
            i += 1
        blocks.append(left[first:i])
    return blocks


def deletions(found: DataFrame, pairs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Blocks to delete: (doc, tie, cuts) with cuts an array of (first raw, last raw, words)."""
    per_line = F.sort_array(F.collect_list(F.struct("at", "raw"))).alias("spots")
    grouped = materialise(found.groupBy("doc", "tie", "h1", "h2").agg(
        F.max("w").alias("w"), per_line), "line-spots")
    early = grouped.select(F.col("doc").alias("doc0"), F.col("tie").alias("tie0"), "h1", "h2",
                           F.transform("spots", lambda s: s["at"]).alias("spots0"))
    same = [F.col("l.doc").eqNullSafe(F.col("p.doc")), F.col("l.tie") == F.col("p.tie")]
    wanted = (grouped.alias("l").join(pairs.alias("p"), same)
              .select("l.*", "doc0", "tie0").alias("w"))
    common = wanted.join(early.alias("e"), [
        F.col("w.doc0").eqNullSafe(F.col("e.doc0")), F.col("w.tie0") == F.col("e.tie0"),
        F.col("w.h1") == F.col("e.h1"), F.col("w.h2") == F.col("e.h2")])
    dealt = (common.select("w.doc", "w.tie", "w.doc0", "w.tie0", "w.h1", "w.h2", "w.w",
                           "w.spots", "spots0")
             .repartition("doc", "tie", "doc0", "tie0")
             .sortWithinPartitions("doc", "tie", "doc0", "tie0"))

    def run(batches):
        import pyarrow as pa
        pair, later, earlier = None, [], []

        def close():
            return [(pair[0], pair[1], *cut) for cut in
                    common_blocks(sorted(later), sorted(earlier), min_words)] if pair else []

        def as_batch(rows):
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
            return pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)],
                names=["doc", "tie", "first", "last", "words"])
        for batch in batches:
            out = []
            for doc, tie, doc0, tie0, h1, h2, w, spots, spots0 in zip(
                    *(c.to_pylist() for c in batch.columns)):
                if (doc, tie, doc0, tie0) != pair:
                    out += close()
                    pair, later, earlier = (doc, tie, doc0, tie0), [], []
                later += [(s["at"], (h1, h2), s["raw"], w) for s in spots]
                earlier += [(s, (h1, h2)) for s in spots0]
            yield as_batch(out)
        yield as_batch(close())
    cuts = dealt.mapInArrow(run, "doc bigint, tie bigint, first int, last int, words int")
    return cuts.groupBy("doc", "tie").agg(
        F.sort_array(F.collect_set(F.struct("first", "last"))).alias("cuts"))


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text",
          min_words: int = MIN_WORDS, cut_lines: str = "_cut_lines") -> DataFrame:
    """All rows and columns with the deleted blocks gone from ``text``.

    Adds the number of deleted lines under the name ``cut_lines``; a text whose every word went
    is empty.
    """
    slim = docs.select(F.col(f"`{key}`").cast("bigint").alias("doc"),
                       F.xxhash64(F.col(f"`{text}`")).alias("tie"),
                       F.col(f"`{text}`").alias("text"))
    found = lines(slim, min_words)
    pairs = materialise(overlapping(found), "line-pairs")
    cuts = deletions(found, pairs, min_words).alias("c")
    old = F.col(f"d.`{text}`")
    body = F.split(old, "\n")
    left = F.filter(body, lambda line, i: ~F.exists(
        "c.cuts", lambda c: (i >= c["first"]) & (i <= c["last"])))
    rest = F.array_join(left, "\n")
    rest = F.when(F.trim(F.translate(rest, "\t\n\x0b\x0c\r", " " * 5)) == "", "").otherwise(rest)
    same = F.col("c.cuts").isNull()
    joined = docs.alias("d").join(cuts, [
        F.col(f"d.`{key}`").cast("bigint").eqNullSafe(F.col("c.doc")),
        F.xxhash64(old) == F.col("c.tie")], "left")
    return joined.select(
        *[F.when(same, old).otherwise(rest).alias(n) if n == text else F.col(f"d.`{n}`")
          for n in docs.columns],
        F.when(same, 0).otherwise(F.size(body) - F.size(left)).alias(cut_lines))


def without_repeats(docs: DataFrame, text: str = "text", n_chars: str = "n_chars",
                    **options) -> DataFrame:
    """The documents without passages that an earlier one holds; columns unchanged.

    A document whose every word went is a copy and dropped; ``n_chars`` follows the text.
    """
    mark = "_cut_lines"
    while mark in docs.columns:
        mark = "_" + mark
    out = dedup(docs, text=text, cut_lines=mark, **options)
    cut = F.col(f"`{mark}`") > 0
    left = F.col(f"`{text}`") != ""
    size = F.when(cut, F.char_length(F.col(f"`{text}`"))).otherwise(F.col(f"`{n_chars}`"))
    return out.where(~cut | left).select(
        *[size.cast(kind).alias(n) if n == n_chars else F.col(f"`{n}`") for n, kind in docs.dtypes])
