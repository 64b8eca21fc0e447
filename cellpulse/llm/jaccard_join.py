"""Exact Jaccard join of documents in metric space.

Words are lower-cased in A-Z only; a document's set holds its distinct shingles of ``shingle``
words, or its whole sequence where it has fewer. Two documents link if
100 * common >= ``percent`` * united, that is at a Jaccard distance of r = 1 - percent / 100 or
less. The distance is a metric. Documents with equal sets are one class.

1. *Far classes.* Of two linked sets each lacks r of its size at most, so the smallest r + l of
   the sorted hashes of both share l. Hashes that one class alone holds are counted by owner in
   one aggregate; a class with too few others within that prefix links with nothing and goes.
2. *Pivots.* The least class that holds a hash of the shortest such prefix (l = 1) is the pivot
   of that hash. Linked classes share such a hash, so they are both in the region of its pivot.
   Each class is compared with its home, the pivot with most of its hashes, and linked classes
   are labelled by component. A region in which all have one label has nothing left to find.
3. *Recursion.* A region too large for a task takes ``pivots`` of its members. Each member goes
   to the nearest one's cell and, since partners are within r, to every cell whose pivot is no
   further than the nearest plus 2 r (triangle inequality). Cells are regions of the next level,
   until they are small. A region stays whole if one cell would hold more than three quarters.
4. *Join.* A region that cannot be divided is cut into tiles by hash: every pair of slots is one
   task, and each pair of members meets in exactly one tile. A task counts common hashes through
   an index of its members' sets and returns links between components that it has not yet
   joined (with ``every_link``, all links), never all pairs. Before texts travel to the tiles,
   members are compared by parity marks, which bound the difference of two sets from below:
   those without a possible partner of another label stay out (exact).

Nothing is sampled but the choice of pivots, on which the result does not depend. Regions,
pivots and labels that hold a thousandth of all rows are joined by broadcast (a thousand rows at
most); the rows of a hot region are salted.

Null text counts as empty; documents without a word are linked with nothing. Rows that repeat an
id are one document, linked through any of its texts. Rows without an id are linked with nothing.
An empty table gives an empty result; other columns are not read.
"""

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from cellpulse.llm.near_dedup import _among, _mix, _texts_of, _tiles, shingle_set
from cellpulse.llm.text import spread_join
from cellpulse.llm.tiles import joined, parity, suspects
from cellpulse.operators.density import connected
from cellpulse.session import materialise


@dataclass(frozen=True)
class Settings:
    shingle: int = 5
    percent: int = 80
    pivots: int = 16
    members: int = 2048            # of a region joined by one task
    hashes: int = 1 << 21          # in the sets of such a region
    salted: int = 2048             # members of a region compared with pivots by one task


def least_common(n: int, percent: int) -> int:
    """Least number of common hashes of a set of ``n`` with a partner."""
    return -(-n * percent // 100)


def prefix(n: int, percent: int, shared: int = 1) -> int:
    """Length of the prefix in which a set shares ``shared`` hashes with every partner."""
    return min(n, n - least_common(n, percent) + shared)


def spread(n: int) -> int:
    """Shared hashes asked of the longer prefix, a tenth of the set.

    More would drop more classes, but shuffle more: with three tenths, half of all hashes.
    """
    return max(1, n // 10)


def class_of(found) -> int:
    """64-bit key of a set."""
    import numpy as np
    total = _mix(found + np.uint64(len(found))).sum(dtype=np.uint64)
    return int(_mix(np.array([total]))[0].astype(np.int64))


def _per_text(s: Settings, emit):
    """Arrow function over rows (key, text) that gives ``emit(key, set, text)`` rows in columns."""
    def run(batches):
        for batch in batches:
            held, length = [], 0
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows = emit(key, shingle_set(text, s.shingle), text)
                held.append(rows)
                length += len(rows[0])
                if length >= 1 << 17:
                    yield _merged(held)
                    held, length = [], 0
            if held:
                yield _merged(held)

    def _merged(held):
        import numpy as np
        import pyarrow as pa
        columns = [np.concatenate(c) for c in zip(*held)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns],
                                          names=[f"c{i}" for i in range(len(columns))])
    return run


def sets(docs: DataFrame, s: Settings) -> DataFrame:
    """Stored rows (doc_id, n_shingles, cls), one per row of (doc_id, text); cls 0: empty."""
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches):
        import pyarrow as pa
        for batch in batches:
            size, key = [], []
            for text in batch.column(1).to_pylist():
                found = shingle_set(text, s.shingle)
                size.append(len(found))
                key.append(class_of(found) if len(found) else 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(size, pa.int64()), pa.array(key, pa.int64())],
                names=["doc_id", "n_shingles", "cls"])
    return materialise(docs.mapInArrow(run, f"doc_id {kind}, n_shingles bigint, cls bigint"),
                       "sets")


def _postings(texts: DataFrame, s: Settings, length) -> DataFrame:
    """Rows (h, cls) of the first ``length(n)`` hashes of every set; of (key, text) rows."""
    def emit(key, found, text):
        import numpy as np
        some = found[:length(len(found))]
        return (some.view(np.int64),
                np.full(len(some), class_of(found) if len(found) else 0, np.int64))
    return texts.mapInArrow(_per_text(s, emit), "c0 bigint, c1 bigint").select(
        F.col("c0").alias("h"), F.col("c1").alias("cls"))


def near_classes(docs: DataFrame, marked: DataFrame, s: Settings) -> DataFrame:
    """Stored classes (cls, doc_id) that may have a partner, with their least document."""
    p = s.percent
    posts = _postings(docs, s, lambda n: prefix(n, p, spread(n)))
    alone = (posts.groupBy("h").agg(F.min("cls").alias("cls"), F.max("cls").alias("top"))
             .where("cls = top").groupBy("cls").agg(F.count(F.lit(1)).alias("own")))
    n, least = F.col("n"), F.ceil(F.col("n") * p / 100)
    asked = F.greatest(F.lit(1), F.floor(F.col("n") / 10))
    held = F.least(n, n - least + asked)
    # The smallest partner has percent of the size, and asks for less.
    need = F.greatest(F.lit(1), F.floor(F.floor(n * p / 100) / 10))
    classes = marked.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("cls").agg(
        F.max("n_shingles").alias("n"), F.min("doc_id").alias("doc_id"))
    return materialise(
        classes.join(alone, "cls", "left")
        .where(held - F.coalesce("own", F.lit(0)) >= need).select("cls", "doc_id"), "near-classes")


def _class_texts(docs: DataFrame, classes: DataFrame, s: Settings) -> DataFrame:
    """Stored (cls, n, mark, text) of the named classes; ``mark``: parity mark of the set."""
    kept = _texts_of(docs, classes.select("doc_id"))

    def run(batches):
        import pyarrow as pa
        for batch in batches:
            found = [shingle_set(t, s.shingle) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([class_of(f) if len(f) else 0 for f in found], pa.int64()),
                 pa.array([len(f) for f in found], pa.int64()),
                 pa.array([parity(f) for f in found], pa.binary()), batch.column(1)],
                names=["cls", "n", "mark", "text"])
    return materialise(kept.select("doc_id", "text").mapInArrow(
        run, "cls bigint, n bigint, mark binary, text string").where("n > 0"), "class-texts")


def _common(a, b) -> int:
    import numpy as np
    if len(a) > len(b):
        a, b = b, a
    spots = np.searchsorted(b, a)
    return int((b[np.minimum(spots, len(b) - 1)] == a).sum())


def windows(members: DataFrame, pivots: DataFrame, texts: DataFrame, s: Settings) -> DataFrame:
    """Stored (region, cls, pivot, near) for each member and each cell it belongs to.

    ``members`` (region, cls) are compared with the ``pivots`` (region, pivot) of their region,
    a bounded number. A member belongs to the nearest pivot's cell and to those within 2 r of
    that distance; ``near`` marks pivots that it links with. Members of a hot region are salted,
    and each part gets the pivots.
    """
    members = materialise(members, "members")
    sizes = materialise(members.groupBy("region").agg(F.count(F.lit(1)).alias("n")), "sizes")
    parts = F.floor(F.col("n") / s.salted) + 1
    salted = spread_join(members, sizes, ["region"]).select(
        "region", F.pmod(F.xxhash64("cls"), parts).alias("salt"), F.lit(1).alias("kind"), "cls")
    copied = pivots.join(sizes, "region").select(
        "region", F.explode(F.sequence(F.lit(0).cast("bigint"), parts - 1)).alias("salt"),
        F.lit(0).alias("kind"), F.col("pivot").alias("cls"))
    rows = (salted.unionByName(copied).join(texts.select("cls", "text"), "cls")
            .select("region", "salt", "kind", "cls", "text")
            .repartition("region", "salt").sortWithinPartitions("region", "salt", "kind", "cls"))
    reach = 2 * (100 - s.percent) / 100 + 1e-9

    def run(batches):
        import numpy as np
        import pyarrow as pa
        group, held = None, {}
        for batch in batches:
            out = []
            for region, salt, kind, cls, text in zip(*(c.to_pylist() for c in batch.columns)):
                if (region, salt) != group:
                    group, held = (region, salt), {}
                found = held.get(cls)
                if found is None:
                    found = shingle_set(text, s.shingle)
                if kind == 0:
                    held[cls] = found
                    continue
                names = list(held)
                both = [_common(found, held[p]) for p in names]
                sizes = [len(found) + len(held[p]) - c for p, c in zip(names, both)]
                far = [1 - c / u for c, u in zip(both, sizes)]
                limit = min(far, default=0) + reach
                out += [(region, cls, p, 100 * c >= s.percent * u)
                        for p, c, u, d in zip(names, both, sizes, far) if d <= limit]
            kinds = [pa.int64()] * 3 + [pa.bool_()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)],
                names=["region", "cls", "pivot", "near"])
    return materialise(rows.mapInArrow(
        run, "region bigint, cls bigint, pivot bigint, near boolean"), "windows")


def _labels(links: DataFrame) -> DataFrame:
    return materialise(connected(links).select(F.col("node").alias("cls"), "label"), "labels")


def _open_regions(members: DataFrame, s: Settings) -> DataFrame:
    """Stored (region, n, hashes) of the regions that hold more than one label."""
    return materialise(
        members.groupBy("region").agg(
            F.count(F.lit(1)).alias("n"), F.sum("size").alias("hashes"),
            F.min("label").alias("low"), F.max("label").alias("high"))
        .where("low < high").drop("low", "high"), "regions")


def _suspected(tiles: DataFrame, texts: DataFrame, s: Settings) -> DataFrame:
    """Stored rows of ``tiles`` whose parity mark allows a link with another label in the tile."""
    key = ["region", "low", "high"]
    names = [*key, "slot", "cls", "label"]
    rows = (tiles.join(texts.select("cls", "n", "mark"), "cls").select(*names, "n", "mark")
            .repartition(*key).sortWithinPartitions(*key, "cls"))

    def run(batches):
        import numpy as np
        import pyarrow as pa
        for tile, held in _tiles(batches):
            marked = [(label, slot, n, mark) for slot, _, label, n, mark in held]
            kept = np.flatnonzero(suspects(marked, tile[1] != tile[2], s.percent)).tolist()
            yield pa.RecordBatch.from_arrays(
                [pa.array([v] * len(kept), pa.int64()) for v in tile]
                + [pa.array([held[k][i] for k in kept], pa.int64()) for i in range(3)],
                names=names)
    return materialise(rows.mapInArrow(run, ", ".join(f"{c} bigint" for c in names)), "suspects")


def _tile_links(members: DataFrame, texts: DataFrame, s: Settings, every: bool) -> DataFrame:
    """Stored links (a, b) within the tiles of ``members`` (region, cls, label, slots)."""
    slot = F.pmod(F.xxhash64("cls"), "slots")
    tiles = members.withColumn("slot", slot).withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("slots") - 1))).select(
        "region", F.least("slot", "other").alias("low"), F.greatest("slot", "other").alias("high"),
        "slot", "cls", "label")
    key = ["region", "low", "high"]
    tiles = _suspected(tiles, texts, s)
    wanted = materialise(tiles.select("cls").distinct(), "wanted")
    rows = (tiles.join(_among(texts, wanted, "cls").select("cls", "text"), "cls")
            .select(*key, "slot", "cls", "label", "text").repartition(*key).sortWithinPartitions(*key, "cls"))

    def run(batches):
        import pyarrow as pa
        tile, held = None, []

        def close():
            pairs = joined(held, tile[1] != tile[2], s.percent, every) if len(held) > 1 else []
            return pa.RecordBatch.from_arrays(
                [pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)], names=["a", "b"])
        for batch in batches:
            for region, low, high, slot, cls, label, text in zip(
                    *(c.to_pylist() for c in batch.columns)):
                if (region, low, high) != tile:
                    if held:
                        yield close()
                    tile, held = (region, low, high), []
                if not held or held[-1][0] != cls:
                    held.append((cls, label, slot, shingle_set(text, s.shingle)))
        if held:
            yield close()
    return materialise(rows.mapInArrow(run, "a bigint, b bigint"), "links")


def class_links(docs: DataFrame, marked: DataFrame, s: Settings = Settings(),
                every_link: bool = False) -> DataFrame:
    """Distinct links (a, b), a < b, between classes: all of them, or enough to connect them."""
    classes = near_classes(docs, marked, s)
    texts = _class_texts(docs, classes, s)
    posts = materialise(_postings(texts.select("cls", "text"), s,
                                  lambda n: prefix(n, s.percent)), "postings")
    leads = materialise(
        posts.groupBy("h").agg(F.min("cls").alias("region"), F.max("cls").alias("top"),
                               F.count(F.lit(1)).alias("n"))
        .where("region < top").drop("top"), "leads")
    shared = materialise(spread_join(posts, leads, ["h"]).groupBy("region", "cls").agg(
        F.count(F.lit(1)).alias("shared")), "shared")
    home = shared.where("region <> cls").groupBy("cls").agg(
        F.max(F.struct("shared", F.expr("-region").alias("r"), "region")).alias("h"))
    home = materialise(home.select(F.col("h.region").alias("region"), "cls"), "homes")
    star = windows(home, home.select("region", F.col("region").alias("pivot")).distinct(),
                   texts, s)
    links = star.where("near").select(F.col("pivot").alias("a"), F.col("cls").alias("b"))
    sized = shared.select("region", "cls").join(
        texts.groupBy("cls").agg(F.max("n").alias("size")), "cls")
    if every_link:
        members = sized.withColumn("label", F.col("cls"))
    else:
        members = sized.join(_labels(links), "cls", "left").withColumn(
            "label", F.coalesce("label", "cls"))
    members = materialise(members.select("region", "cls", "size", "label"), "members")
    ready = []
    large = (F.col("n") > s.members) | (F.col("hashes") > s.hashes)
    flat = F.lit(False)
    while True:
        regions = _open_regions(members, s)
        slots = F.greatest(F.ceil(2 * F.col("n") / s.members),
                           F.ceil(2 * F.col("hashes") / s.hashes))
        here = spread_join(members, regions, ["region"])
        ready.append(here.where(~large | flat).select(
            "region", "cls", "label",
            F.when(large, slots).otherwise(1).cast("bigint").alias("slots")))
        rest = here.where(large & ~flat)
        if rest.limit(1).count() == 0:
            break
        rest = materialise(rest, "large")
        members, flat = _divided(rest, texts, s)
    tiles = ready[0]
    for more in ready[1:]:
        tiles = tiles.unionByName(more)
    found = links.union(_tile_links(tiles, texts, s, every_link))
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _divided(rest: DataFrame, texts: DataFrame, s: Settings) -> tuple:
    """Members of the cells of large regions, and the test for regions that cannot be divided.

    A region stays whole, under a negative number, if one cell would hold more than three
    quarters of it.
    """
    spot = F.struct(F.xxhash64("cls", "region").alias("spot"), "cls")
    low = F.sort_array(F.collect_set("cls")).alias("names")
    # The pivots: members of least hash, found by shares of the region's members.
    share = F.expr(f"abs(xxhash64(cls, region)) % n < {4 * s.pivots}")
    some = rest.where(share).groupBy("region").agg(low)
    least = rest.groupBy("region").agg(F.min(spot)["cls"].alias("one"))
    pivots = least.join(some, "region", "left").select(
        "region", F.explode(F.array_distinct(F.concat(
            F.array("one"), F.slice(F.coalesce("names", F.array().cast("array<bigint>")),
                                    1, s.pivots - 1)))).alias("pivot"))
    wanted = materialise(rest.select("cls").distinct(), "wanted")     # pivots are members
    cells = windows(rest.select("region", "cls"), pivots, _among(texts, wanted, "cls"), s)
    sizes = rest.groupBy("region").agg(F.first("n").alias("whole"), F.count(F.lit(1)).alias("n"))
    cell_sizes = materialise(cells.groupBy("region", "pivot").agg(F.count(F.lit(1)).alias("n")),
                             "cells")
    flat = cell_sizes.groupBy("region").agg(F.max("n").alias("most"))
    sizes = materialise(sizes.join(flat, "region").withColumn(
        "flat", F.col("most") * 4 > F.col("whole") * 3), "divided")
    known = materialise(spread_join(rest.select("region", "cls", "size", "label"),
                                    sizes.select("region", "n", "flat"), ["region"]), "known")
    whole = known.where("flat").select(
        (-F.abs(F.xxhash64("region"))).alias("region"), "cls", "size", "label")
    parts = known.where("NOT flat").join(cells.select("region", "cls", "pivot"),
                                         ["region", "cls"]).select(
        F.abs(F.xxhash64("region", "pivot")).alias("region"), "cls", "size", "label")
    return materialise(whole.unionByName(parts), "members"), F.col("region") < 0


def components(docs: DataFrame, key: str = "doc_id", text: str = "text",
               settings: Settings = Settings()) -> DataFrame:
    """Rows (doc_id, n_shingles, component_id), one per row of ``docs``."""
    slim = docs.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    marked = sets(slim, settings)
    links = class_links(slim, marked, settings)
    linked = marked.where("n_shingles > 0 AND doc_id IS NOT NULL")
    # Texts of one id.
    ids = (linked.groupBy("doc_id").agg(F.min("cls").alias("a"), F.max("cls").alias("top"))
           .where("a < top").drop("top"))
    same = linked.join(ids, "doc_id").where("a <> cls").select("a", F.col("cls").alias("b"))
    labels = _labels(links.union(same))
    classes = linked.groupBy("cls").agg(F.min("doc_id").alias("least"),
                                        F.count(F.lit(1)).alias("n"))
    classes = materialise(
        classes.join(labels, "cls", "left").withColumn("label", F.coalesce("label", "cls")),
        "classes")
    groups = classes.groupBy("label").agg(F.min("least").alias("component_id"))
    grouped = materialise(classes.join(groups, "label").select("cls", "n", "component_id"),
                          "groups")
    inside = spread_join(linked, grouped, ["cls"]).select(
        "doc_id", "n_shingles", "component_id")
    outside = marked.where("n_shingles = 0 OR doc_id IS NULL").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return inside.unionByName(outside)


def links(docs: DataFrame, key: str = "doc_id", text: str = "text",
          settings: Settings = Settings()) -> tuple:
    """All links between classes (a, b), by their keys, and each document's class (doc_id, cls)."""
    slim = docs.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    marked = sets(slim, settings)
    return (class_links(slim, marked, settings, every_link=True),
            marked.select("doc_id", "n_shingles", "cls"))
