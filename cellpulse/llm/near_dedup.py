"""Near-duplicate documents by an LSH forest over MinHash signatures.

Words are lower-cased in A-Z only. A document's set holds its distinct shingles of ``shingle``
words; with fewer words, the whole sequence is its one shingle; without words the set is empty
and linked with nothing. Documents are linked if 100 * common >= 80 * united shingles.

1. One pass makes per document the size and a 128-bit hash of its set and a MinHash signature of
   ``trees`` x ``depth`` values. Documents with equal sets are one class, represented by the
   smallest id.
2. Each tree sorts the classes by its own stretch of the signature. Rows are range-partitioned,
   so a region of any size spreads over tasks by its deeper values; a region cut by a partition's
   edge is closed by linking the edge rows of the parts.
3. Candidates are neighbours of longest common prefix. In round one every row meets the smallest
   id of each region it lies in, at every depth that the region needs: a region of a single row
   ends the descent. In round two rows meet the row before them in sorted order, where the two
   are not connected yet. Neither lists the pairs of a region, and both cover regions of any size
   at full depth.
4. Candidates whose signatures agree too little for the threshold (six standard deviations
   below) are dropped; the others are confirmed on their full shingle sets, rebuilt from the
   texts. Components of confirmed links give the groups.
5. Both rounds may miss a link in a region whose members are not connected, as in a family that
   shares a passage and stays below the threshold. There the depth adapts: a region of more than
   ``crowd`` rows is sorted on by up to ``deeper`` further values, as far as it stays larger. In
   each leaf, the signatures of all members that are not connected are compared in tiles. This
   returns the members that have a likely partner, not the pairs. A member's home is the smallest
   id it shares a leaf with; if two likely partners have different homes, the one of the larger
   home visits the other's. Homes with their visitors are joined in tiles on full sets.

With J = 0.8, 24 trees and four values, a pair shares no full-depth region with a chance of
3e-6, and none at the first value with 2e-17. In a leaf of the greatest depth, eight values, that
chance is 0.012 for J = 0.8 and 0.004 for J = 0.82.

Null text counts as empty. Rows that repeat an id are one document, linked through any of its
texts. Rows without an id are linked with nothing and kept. An empty table gives an empty result.
"""

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from cellpulse.llm.text import bitmap, in_bitmap, release, spread_join
from cellpulse.llm.tiles import joined
from cellpulse.operators.density import connected
from cellpulse.session import materialise


MOST_CELLS = 1 << 27   # bits
MOST_POWERS = 1 << 21  # entries of the tables that a worker keeps


@dataclass(frozen=True)
class Settings:
    shingle: int = 4
    percent: int = 80
    trees: int = 24
    depth: int = 4
    deeper: int = 4             # further values that divide crowded regions, 16 bits each
    crowd: int = 1024           # rows of a region, members of a tile
    hashes: int = 1 << 21       # in the sets of a tile
    seed: int = 5


_BLANK = bytes(0 if b in b" \t\n\x0b\x0c\r" else 1 for b in range(256))
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_TABLES = {}


def _mix(x):
    """Finalizer that spreads every bit of 64-bit numbers."""
    import numpy as np
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int):
    """Powers of an odd base and of its inverse modulo 2**64, and one number per byte."""
    import numpy as np
    if n > MOST_POWERS:     # longer texts make their own, which go with them
        base = 0x9E3779B97F4A7C15
        up, down = np.full(n, base, np.uint64), np.full(n, pow(base, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        return np.multiply.accumulate(up), np.multiply.accumulate(down), _powers(1)[2]
    if len(_TABLES.get("up", ())) < n:
        size = max(n, 1 << 16)
        base = 0x9E3779B97F4A7C15
        for name, factor in (("up", base), ("down", pow(base, -1, 1 << 64))):
            steps = np.full(size, factor, np.uint64)
            steps[0] = 1
            _TABLES[name] = np.multiply.accumulate(steps)
        _TABLES["byte"] = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return _TABLES["up"], _TABLES["down"], _TABLES["byte"]


def word_hashes(text: str):
    """One 64-bit hash per word, in order."""
    import numpy as np
    data = text.encode("utf-8", "replace").translate(_LOWER)
    codes = np.frombuffer(data, np.uint8)
    solid = np.frombuffer(data.translate(_BLANK), np.int8)
    edges = np.flatnonzero(np.diff(solid, prepend=0, append=0))
    starts, ends = edges[::2], edges[1::2]
    up, down, table = _powers(len(codes) + 1)
    total = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(table[codes] * up[:len(codes)], out=total[1:])
    return _mix((total[ends] - total[starts]) * down[starts]
                + (ends - starts).astype(np.uint64))


def shingle_set(text, size: int):
    """Sorted distinct 64-bit shingle hashes of a text."""
    import numpy as np
    words = word_hashes(text) if text else np.empty(0, np.uint64)
    if not len(words):
        return words
    width = min(size, len(words))
    n = len(words) - width + 1
    out = np.full(n, np.uint64(width), np.uint64)
    for i in range(width):
        out = _mix(out * np.uint64(0x9FB21C651E98DF25) + words[i:i + n])
    return np.unique(out)


def _permutations(s: Settings):
    import numpy as np
    rng = np.random.default_rng(s.seed)
    n = s.trees * s.depth
    return (rng.integers(0, 1 << 31, n, np.uint32) * np.uint32(2) + np.uint32(1),
            rng.integers(0, 1 << 32, n, np.uint64).astype(np.uint32))


def signature(shingles, factors, shifts):
    """Smallest value of the set under each permutation, as unsigned 32-bit numbers."""
    import numpy as np
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    best = None
    for at in range(0, len(short), 4096):
        low = (factors[:, None] * short[None, at:at + 4096] + shifts[:, None]).min(axis=1)
        best = low if best is None else np.minimum(best, low)
    return best


def signatures(docs: DataFrame, s: Settings) -> DataFrame:
    """Stored rows (doc_id, n_shingles, set_a, set_b, signature) of rows (doc_id, text)."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        factors, shifts = _permutations(s)
        for batch in batches:
            size, a, b, marks = [], [], [], []
            for text in batch.column(1).to_pylist():
                found = shingle_set(text, s.shingle)
                size.append(len(found))
                a.append(int(found.sum(dtype=np.uint64).astype(np.int64)))
                b.append(int(np.bitwise_xor.reduce(_mix(found + np.uint64(1))).astype(np.int64))
                         if len(found) else 0)
                marks.append(signature(found, factors, shifts).astype("<u4").tobytes()
                             if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(size, pa.int64()), pa.array(a, pa.int64()),
                 pa.array(b, pa.int64()), pa.array(marks, pa.binary())],
                names=["doc_id", "n_shingles", "set_a", "set_b", "signature"])
        release()
    return materialise(docs.mapInArrow(
        run, "doc_id bigint, n_shingles bigint, set_a bigint, set_b bigint, signature binary"),
        "signatures")


def _tree_rows(leads: DataFrame, s: Settings) -> DataFrame:
    """Sorted rows (tree, v0 .. v3, deep, node) of every class in every tree.

    ``deep`` packs the further values, which other trees lend: the i-th one is a value of the
    tree i * (i + 1) / 2 places on, so that no two trees share a stretch of them.
    """
    values = [f"v{d}" for d in range(s.depth)]
    lent = [(i * (i + 1) // 2, i % s.depth) for i in range(1, s.deeper + 1)]

    def run(batches):
        import numpy as np
        import pyarrow as pa
        for batch in batches:
            n = len(batch)
            marks = np.frombuffer(b"".join(batch.column(1).to_pylist()), "<u4")
            marks = marks.reshape(n * s.trees, s.depth).view("<i4")
            trees = marks.reshape(n, s.trees, s.depth)
            deep = np.zeros((n, s.trees), np.int64)
            for hop, at in lent:
                low = np.roll(trees[:, :, at], -hop, axis=1).astype(np.int64) & 0xFFFF
                deep = (deep << 16) | low
            node = np.repeat(batch.column(0).to_numpy(), s.trees)
            tree = np.tile(np.arange(s.trees, dtype="int32"), n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(tree), *[pa.array(np.ascontiguousarray(marks[:, d]))
                                   for d in range(s.depth)],
                 pa.array(deep.reshape(-1)), pa.array(node)],
                names=["tree", *values, "deep", "node"])
    rows = leads.select("node", "signature").mapInArrow(
        run, "tree int, " + ", ".join(f"{v} int" for v in values) + ", deep bigint, node bigint")
    order = ["tree", *values, "deep", "node"]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order)


def _neighbours(leads: DataFrame, s: Settings) -> DataFrame:
    """Stored candidates (a, b, round) with a < b from one walk over the sorted trees.

    ``round`` 1: smallest id of a region; 2: row before. Each task also returns its first row
    and, for every depth, the smallest id of the region open at its end (``edge`` rows; 3, 4),
    and every row of a leaf of three or more with the leaf's smallest id (5).
    """
    width = s.depth + 1

    def run(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        held = list(batches)
        kinds = [pa.int64()] * 2 + [pa.int32()] * 2 + [pa.list_(pa.int32())]
        names = ["a", "b", "round", "part", "edge"]

        def as_batch(a, b, number, edges=None):
            n = len(a)
            return pa.RecordBatch.from_arrays(
                [pa.array(a, kinds[0]), pa.array(b, kinds[1]),
                 pa.array(np.full(n, number, "int32")), pa.array(np.full(n, part, "int32")),
                 pa.array(edges if edges is not None else [None] * n, kinds[4])], names=names)
        n = sum(len(b) for b in held)
        if not n:
            return
        held = pa.Table.from_batches(held)
        keys = [held.column(i).to_numpy() for i in range(width)]
        deep, node = (held.column(i).to_numpy() for i in (width, width + 1))
        new = np.zeros(n, bool)
        new[0] = True
        ends = []
        for d in range(width):      # tree alone is no region; it only bounds the others
            new[1:] |= keys[d][1:] != keys[d][:-1]
            starts = np.flatnonzero(new)
            least = np.minimum.reduceat(node, starts)
            if d:
                hub = np.repeat(least, np.diff(np.append(starts, n)))
                other = hub != node
                yield as_batch(hub[other], node[other], 1)
                ends.append((int(least[-1]), d))
                if d == 1:
                    follows = ~new[1:]
                    low = np.minimum(node[1:], node[:-1])[follows]
                    high = np.maximum(node[1:], node[:-1])[follows]
                    yield as_batch(low, high, 2)
        # Leaves: regions of full depth, divided by further values while they are crowded.
        for d in range(s.deeper + 1):
            starts = np.flatnonzero(new)
            sizes = np.diff(np.append(starts, n))
            if d == s.deeper or sizes.max() <= s.crowd:
                break
            value = deep >> np.int64(16 * (s.deeper - 1 - d))
            new[1:] |= np.repeat(sizes > s.crowd, sizes)[1:] & (value[1:] != value[:-1])
        inside = np.repeat(sizes >= 3, sizes)
        hub = np.repeat(np.minimum.reduceat(node, starts), sizes)
        yield as_batch(hub[inside], node[inside], 5)
        first = [int(k[0]) for k in keys]
        last = [int(k[-1]) for k in keys]
        # First row with its keys, and per depth the hub of the region that is still open.
        yield as_batch([int(node[0])], [0], 3, [first])
        yield as_batch([e for e, _ in ends] + [int(node[-1])], [d for _, d in ends] + [0], 4,
                       [last] * (len(ends) + 1))
    return materialise(_tree_rows(leads, s).mapInArrow(
        run, "a bigint, b bigint, round int, part int, edge array<int>"), "neighbours")


def _edge_pairs(found: DataFrame) -> list:
    """Pairs that join regions cut by the edges of parts; a few rows per part reach the driver.

    A region that runs through whole parts is joined part by part.
    """
    firsts, lasts = {}, {}
    for r in found.where("round IN (3, 4)").collect():
        if r["round"] == 3:
            firsts[r["part"]] = (r["a"], r["edge"])
        else:
            lasts.setdefault(r["part"], []).append((r["a"], r["b"], r["edge"]))
    parts, pairs = sorted(firsts), set()
    for before, after in zip(parts, parts[1:]):
        node, keys = firsts[after]
        for hub, depth, last in lasts[before]:
            reach = max(depth, 1) + 1
            if last[:reach] == keys[:reach] and hub != node:
                pairs.add((min(hub, node), max(hub, node)))
    return sorted(pairs)


def _likely(pairs: DataFrame, leads: DataFrame, s: Settings) -> DataFrame:
    """The pairs whose signatures agree enough for the threshold, short of six deviations."""
    n, j = s.trees * s.depth, s.percent / 100.0
    least = int(n * j - 6 * (n * j * (1 - j)) ** 0.5)
    brief = materialise(_brief(leads.select("node", "signature"), n), "brief")
    both = (pairs.join(brief.select(F.col("node").alias("a"), F.col("brief").alias("x")), "a")
            .join(brief.select(F.col("node").alias("b"), F.col("brief").alias("y")), "b"))

    def run(batches):
        import numpy as np
        import pyarrow as pa
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8)
                    .reshape(-1, n) for i in (3, 4))
            yield pa.RecordBatch.from_arrays(batch.columns[:3], names=["a", "b", "round"]).filter(
                pa.array((x == y).sum(axis=1) >= least, pa.bool_()))
    return materialise(both.select("a", "b", "round", "x", "y").mapInArrow(
        run, "a bigint, b bigint, round int"), "likely")


def _tiled(members: DataFrame, s: Settings, columns: list) -> DataFrame:
    """Rows (region, low, high, slot, *columns) of ``members`` (region, node, size, ...) in tiles.

    A region of at most ``crowd`` members is one tile. The members of a larger one go to slots
    by hash, and every pair of slots is a tile, so two members meet in one tile.
    """
    sizes = materialise(members.groupBy("region").agg(
        F.count(F.lit(1)).alias("n"), F.sum("size").alias("_hashes")), "regions")
    large = (F.col("n") > s.crowd) | (F.col("_hashes") > s.hashes)
    slots = F.when(large, F.greatest(F.ceil(2 * F.col("n") / s.crowd),
                                     F.ceil(2 * F.col("_hashes") / s.hashes))).otherwise(1)
    slotted = (spread_join(members, sizes, ["region"]).withColumn("_slots", slots.cast("bigint"))
               .withColumn("slot", F.pmod(F.xxhash64("node"), F.col("_slots"))))
    return slotted.withColumn("_other", F.explode(F.sequence(
        F.lit(0).cast("bigint"), F.col("_slots") - 1))).select(
        "region", F.least("slot", "_other").alias("low"),
        F.greatest("slot", "_other").alias("high"), "slot", *columns)


_TILE = ["region", "low", "high"]


def _tiles(batches):
    """(key, rows) of each tile of sorted rows, across the edges of batches."""
    tile, held = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if row[:3] != tile:
                if held:
                    yield tile, held
                tile, held = row[:3], []
            held.append(row[3:])
    if held:
        yield tile, held


def _guests(members: DataFrame, brief: DataFrame, s: Settings) -> DataFrame:
    """Stored (region, node): in which homes a member must be compared on its full set.

    ``members`` (region, node, size, label, home) of leaves; those with a likely partner of
    another label go to the smaller home of the two.
    """
    n, j = s.trees * s.depth, s.percent / 100.0
    least = int(n * j - 6 * (n * j * (1 - j)) ** 0.5)
    rows = (_tiled(members, s, ["node", "label", "home"]).join(brief, "node")
            .select(*_TILE, "slot", "node", "label", "home", "brief")
            .repartition(*_TILE).sortWithinPartitions(*_TILE, "slot", "node"))

    def run(batches):
        import numpy as np
        import pyarrow as pa
        for (_, low, high), held in _tiles(batches):
            slot, node, label, home = (np.array([r[i] for r in held], np.int64) for i in range(4))
            marks = np.frombuffer(b"".join(r[4] for r in held), np.uint8).reshape(-1, n)
            x, y = np.flatnonzero(slot == low), np.flatnonzero(slot == high)
            out = set()
            step = max(1, (1 << 22) // (n * max(1, len(y))))
            for at in range(0, len(x), step):
                some = x[at:at + step]
                near = (marks[some][:, None, :] == marks[y][None, :, :]).sum(axis=2) >= least
                near &= label[some][:, None] != label[y][None, :]
                for side, others, table in ((some, y, near), (y, some, near.T)):
                    for i in np.flatnonzero(table.any(axis=1)).tolist():
                        where = np.unique(np.minimum(home[side[i]], home[others[table[i]]]))
                        out.update((h, int(node[side[i]])) for h in where.tolist())
            out = sorted(out)
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in out], pa.int64()) for i in (0, 1)],
                names=["region", "node"])
    return materialise(rows.mapInArrow(run, "region bigint, node bigint").distinct(), "guests")


def _crowded_links(leaves: DataFrame, leads: DataFrame, labels: DataFrame, docs: DataFrame,
                   s: Settings) -> DataFrame:
    """Stored links (a, b) of members of leaves (region, node) that the labels leave apart."""
    known = leaves.distinct().join(labels, "node")
    known = materialise(known, "leaves")
    split = known.groupBy("region").agg(
        F.count(F.lit(1)).alias("n"), F.min("label").alias("_low"),
        F.max("label").alias("_high")).where("_low < _high").drop("_low", "_high")
    parts = materialise(spread_join(known, materialise(split, "split"), ["region"]).drop("n"),
                        "parts")
    homes = parts.groupBy("node").agg(F.min("region").alias("home"))
    brief = _brief(leads.join(homes, "node", "left_semi").select("node", "signature"),
                   s.trees * s.depth)
    guests = _guests(parts.join(homes, "node").withColumn("size", F.lit(1)), brief, s)
    texts = materialise(_texts_of(docs, guests.select(F.col("node").alias("doc_id")).distinct())
                        .select(F.col("doc_id").alias("node"), "text"), "texts")
    members = guests.join(labels, "node").join(
        texts.groupBy("node").agg(F.max(F.length("text")).alias("_chars")), "node")
    members = materialise(members.select(      # a word and its blank are two characters or more
        "region", "node", "label", (F.col("_chars") / 2 + 1).cast("bigint").alias("size")),
        "members")
    rows = (_tiled(members, s, ["node", "label"]).join(texts, "node")
            .select(*_TILE, "slot", "node", "label", "text")
            .repartition(*_TILE).sortWithinPartitions(*_TILE, "slot", "node"))

    def run(batches):
        import pyarrow as pa
        for (_, low, high), held in _sets(batches):
            pairs = joined(held, low != high, s.percent, False) if len(held) > 1 else []
            pairs = [(min(p), max(p)) for p in pairs if p[0] != p[1]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)], names=["a", "b"])

    def _sets(batches):
        tile, held = None, []
        for batch in batches:
            for region, low, high, slot, node, label, text in zip(
                    *(c.to_pylist() for c in batch.columns)):
                if (region, low, high) != tile:
                    if held:
                        yield tile, held
                    tile, held = (region, low, high), []
                found = shingle_set(text, s.shingle)
                if len(found):
                    held.append((node, label, slot, found))
        if held:
            yield tile, held
    return materialise(rows.mapInArrow(run, "a bigint, b bigint"), "crowded").distinct()


def _brief(rows: DataFrame, n: int) -> DataFrame:
    """One byte of every signature value."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        for batch in batches:
            marks = np.frombuffer(b"".join(batch.column(1).to_pylist()), "<u4")
            marks = (marks ^ (marks >> 16)).astype(np.uint8).reshape(-1, n)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([m.tobytes() for m in marks], pa.binary())],
                names=["node", "brief"])
    return rows.mapInArrow(run, "node bigint, brief binary")


def confirmed(pairs: DataFrame, texts: DataFrame, s: Settings) -> DataFrame:
    """The pairs (a, b) that reach the threshold on their full shingle sets."""
    both = (pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("x")), "a")
            .join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("y")), "b"))

    def run(batches):
        import numpy as np
        import pyarrow as pa
        recent = {}

        def set_of(text):
            if text not in recent:
                if len(recent) >= 64:
                    recent.pop(next(iter(recent)))
                recent[text] = shingle_set(text, s.shingle)
            return recent[text]
        for batch in batches:
            good = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                p, q = set_of(x), set_of(y)
                common = len(np.intersect1d(p, q, assume_unique=True))
                good.append(100 * common >= s.percent * (len(p) + len(q) - common) > 0)
            yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["a", "b"]).filter(
                pa.array(good, pa.bool_()))
    return materialise(both.select("a", "b", "x", "y").mapInArrow(run, "a bigint, b bigint"),
                       "links").distinct()


def components(docs: DataFrame, key: str = "doc_id", text: str = "text",
               settings: Settings = Settings()) -> DataFrame:
    """Rows (doc_id, n_shingles, component_id, kept), one per row of ``docs``."""
    s, spark = settings, docs.sparkSession
    slim = docs.select(F.col(f"`{key}`").cast("bigint").alias("doc_id"),
                       F.col(f"`{text}`").alias("text"))
    marked = signatures(slim, s)
    linked = marked.where("n_shingles > 0 AND doc_id IS NOT NULL")
    sets = ["set_a", "set_b", "n_shingles"]
    classes = materialise(linked.groupBy(*sets).agg(F.min("doc_id").alias("node")), "classes")
    leads = materialise(
        linked.join(classes.withColumnRenamed("node", "doc_id"), ["doc_id", *sets], "left_semi")
        .select(F.col("doc_id").alias("node"), "signature").distinct(), "leads")
    found = _neighbours(leads, s)
    pairs = found.where("round < 3").select("a", "b", "round")
    edges = _edge_pairs(found)
    if edges:
        pairs = pairs.union(spark.createDataFrame([(a, b, 1) for a, b in edges],
                                                  "a bigint, b bigint, round int"))
    pairs = _likely(pairs.groupBy("a", "b").agg(F.min("round").alias("round")), leads, s)
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    texts = materialise(_texts_of(slim, materialise(nodes, "nodes")), "texts")
    links = confirmed(pairs.where("round = 1").select("a", "b"), texts, s)
    labels = _labelled(leads, links)
    # Round two: neighbours in sorted order that round one left in different groups.
    apart = (pairs.where("round = 2")
             .join(labels.select(F.col("node").alias("a"), F.col("label").alias("la")), "a")
             .join(labels.select(F.col("node").alias("b"), F.col("label").alias("lb")), "b")
             .where("la <> lb").select("a", "b"))
    more = confirmed(apart, texts, s)
    members = linked.join(classes, sets).where("node <> doc_id").select(
        F.col("node").alias("a"), F.col("doc_id").alias("b"))
    labels = _labelled(leads, links.union(more))
    leaves = found.where("round = 5").select(F.col("a").alias("region"), F.col("b").alias("node"))
    crowded = _crowded_links(leaves, leads, labels, slim, s)
    every = links.union(more).union(crowded).union(members)
    groups = connected(every)
    return marked.join(groups.withColumnRenamed("node", "doc_id"), "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("label", "doc_id").alias("component_id"),
        F.coalesce(F.col("doc_id") == F.coalesce("label", "doc_id"), F.lit(True)).alias("kept"))


def _texts_of(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Texts of the documents named in ``nodes``."""
    near = _among(docs.where(F.col("text").isNotNull()), nodes, "doc_id")
    return near.join(nodes, "doc_id", "left_semi")


def _among(rows: DataFrame, nodes: DataFrame, key: str) -> DataFrame:
    """The rows whose key is in ``nodes`` and few others, without a shuffle.

    A bitmap of the keys, sixteen bits a key and ``MOST_CELLS`` at most, keeps most other texts
    out of the shuffle that follows.
    """
    cells = 1 << 16
    wanted = min(MOST_CELLS, 16 * nodes.count())
    while cells < wanted:
        cells *= 2
    bits = bitmap(nodes.select(F.xxhash64(key).alias("h")), cells).scalar()
    return rows.where(in_bitmap(F.xxhash64(key), bits, cells))


def _labelled(leads: DataFrame, links: DataFrame) -> DataFrame:
    """Stored label of every class representative under the links."""
    return materialise(leads.select("node").distinct().join(
        connected(links).withColumnRenamed("label", "_label"), "node", "left").select(
        "node", F.coalesce("_label", "node").alias("label")), "labels")


def one_per_group(docs: DataFrame, key: str = "doc_id", text: str = "text",
                  settings: Settings = Settings()) -> DataFrame:
    """The documents that are the smallest id of their group; columns unchanged."""
    extra = components(docs, key, text, settings).where("NOT kept").select("doc_id").distinct()
    same = F.col(f"d.`{key}`") == F.col("x.doc_id")
    return docs.alias("d").join(extra.alias("x"), same, "left_anti")
