import random
import re

from cellpulse.llm import jaccard_join as m
from cellpulse.llm.tiles import parity, suspects


def shingles(text, size=5):
    low = (text or "").translate({i: i + 32 for i in range(65, 91)})
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    return (frozenset(tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1)))
            if words else frozenset())


def near(p, q, percent=80):
    both = len(p & q)
    return both > 0 and 100 * both >= percent * (len(p) + len(q) - both)


def brute(records, size=5):
    rows = [(r[0], shingles(r[1], size)) for r in records]
    parent = {i: i for i, _ in rows}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for x, (i, p) in enumerate(rows):
        for j, q in rows[:x]:
            if None not in (i, j) and near(p, q):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return sorted(((i, len(p), root(i)) for i, p in rows), key=str)


def check(spark, rows, settings=m.Settings(), parts=6):
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(parts)
    got = sorted(map(tuple, m.components(frame, settings=settings).collect()), key=str)
    assert got == brute(rows)


def test_groups_match_brute_force(docs, records, no_docs):
    out = m.components(docs)
    assert out.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted(map(tuple, out.collect()), key=str) == brute(records)
    assert m.components(no_docs).count() == 0


def family(rng, start, members, words, edits):
    base = [f"b{start}x{i}" for i in range(words)]
    out = []
    for i in range(members):
        text = base.copy()
        for _ in range(rng.randrange(edits)):
            text[rng.randrange(words)] = f"e{start}x{i}x{rng.randrange(99)}"
        out.append((start + i, " ".join(text)))
    return out


def mixed(rng):
    rows = family(rng, 0, 60, 120, 9) + family(rng, 100, 40, 300, 20)
    common = " ".join(f"c{i}" for i in range(60))
    rows += [(200 + i, common + " " + " ".join(f"o{i}x{k}" for k in range(15 + i % 30)))
             for i in range(60)]
    rows += [(300 + i, f"Short {'A' if i % 2 else 'a'}") for i in range(6)]
    base = [f"k{i}" for i in range(120)]
    for i in range(60):         # far ends of the chain are not near
        base = base.copy()
        base[rng.randrange(len(base))] = f"z{i}"
        rows.append((400 + i, " ".join(base)))
    return rows


def test_regions_divided_many_times_change_nothing(spark):
    rows = mixed(random.Random(4))
    check(spark, rows, m.Settings(members=8, hashes=2000, pivots=3, salted=5))


def test_near_pairs_in_a_dense_family_below_the_limit(spark):
    rng, rows = random.Random(9), []
    common = " ".join(f"c{i}" for i in range(170))
    for i in range(400):        # about 0.78 to each other
        own = [f"o{i}x{k}" for k in range(21)]
        rows.append((2 * i, f"{common} {' '.join(own)}"))
        if i % 10 == 0:
            own[rng.randrange(12):] = [f"p{i}x{k}" for k in range(6)]
            rows.append((2 * i + 1, f"{common} {' '.join(own)}"))
    check(spark, rows, m.Settings(members=64))


def test_every_link_between_classes(spark):
    rows = mixed(random.Random(6)) + [(900, "a b c d e f"), (901, "A b c d E f")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    pairs, members = m.links(frame, settings=m.Settings(members=16, pivots=4))
    cls = {r["doc_id"]: r["cls"] for r in members.collect()}
    sets = {cls[i]: shingles(t) for i, t in rows}
    keys = sorted(sets)
    want = {(a, b) for x, b in enumerate(keys) for a in keys[:x] if near(sets[a], sets[b])}
    got = [tuple(r) for r in pairs.collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_text_ids(spark):
    rows = [("b", "one two three four five six"), ("a", "One two three four five six"), ("c", None)]
    frame = spark.createDataFrame(rows, "name string, body string")
    got = {tuple(r) for r in m.components(frame, "name", "body").collect()}
    assert got == {("a", 2, "a"), ("b", 2, "a"), ("c", 0, "c")}


def test_few_hashes_and_texts_are_shuffled(spark, monkeypatch):
    """Texts that only share a passage stay out of the tiles, and most hashes out of the shuffle."""
    rng, rows = random.Random(3), []
    common = " ".join(f"c{i}" for i in range(100))
    for i in range(120):        # about 0.5 to each other, in one region
        rows.append((i, common + " " + " ".join(f"o{i}x{k}" for k in range(50 + i % 7))))
    rows += family(rng, 500, 8, 200, 9)
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    stored = {}
    keep = m.materialise

    def counted(df, name="frame"):
        stored[name] = keep(df, name)
        return stored[name]
    monkeypatch.setattr(m, "materialise", counted)
    got = sorted(map(tuple, m.components(frame).collect()), key=str)
    assert got == brute(rows)
    sets = {r["cls"]: r["doc_id"] for r in stored["sets"].collect()}
    assert all(sets[r["cls"]] >= 500 for r in stored["suspects"].collect())
    assert m.prefix(1000, 80, m.spread(1000)) <= 300


def test_marks_drop_no_partner():
    """Members left out have no partner of another label: against brute force, all widths."""
    import numpy as np
    rng = np.random.default_rng(8)
    sets = []
    for n in (1, 2, 5, 30, 31, 32, 33, 120, 128, 255, 256, 300, 9000, 20000):
        base = rng.integers(0, 1 << 64, n, np.uint64, endpoint=False)
        for share in (1.0, 0.97, 0.9, 0.85, 0.81, 0.8, 0.7, 0.4):
            own = rng.integers(0, 1 << 64, int(n * (1 - share) + n * rng.random() * 0.1), np.uint64)
            sets.append(np.unique(np.concatenate((base[:max(1, round(n * share))], own))))
    members = [(i % 40, i % 3, len(x), parity(x)) for i, x in enumerate(sets)]
    for across in (False, True):
        kept = suspects(members, across, 80)
        want = np.zeros(len(sets), bool)
        for i, x in enumerate(sets):
            for j, y in enumerate(sets[:i]):
                if members[i][0] != members[j][0] and (
                        not across or members[i][1] != members[j][1]):
                    both = len(np.intersect1d(x, y))
                    if 100 * both >= 80 * (len(x) + len(y) - both):
                        want[[i, j]] = True
        assert want.any() and not (want & ~kept).any()
        assert kept.sum() < len(sets)
