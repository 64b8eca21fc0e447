import random
import re

import numpy as np

from cellpulse.llm import near_dedup as m


def shingles(text):
    low = (text or "").translate({i: i + 32 for i in range(65, 91)})
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(words[i:i + 4]) for i in range(max(1, len(words) - 3))} if words else set()


def brute(records):
    sets, parent = [(r[0], shingles(r[1])) for r in records], {}
    for i, _ in sets:
        parent[i] = i

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for x, (i, p) in enumerate(sets):
        for j, q in sets[:x]:
            if p and q and None not in (i, j) and 100 * len(p & q) >= 80 * len(p | q):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: (len(p), root(i)) for i, p in sets}


def check(out, records):
    want = brute(records)
    assert len(out) == len(records)
    for r in out:
        n, group = want[r["doc_id"]]
        assert (r["n_shingles"], r["component_id"]) == (n, group)
        assert r["kept"] == (r["doc_id"] == group)


def test_groups_match_brute_force(docs, records, no_docs):
    check(m.components(docs).collect(), records)
    assert m.components(no_docs).count() == 0


def test_chains_and_large_groups(spark):
    rng = random.Random(4)
    rows, base = [], [f"b{i}" for i in range(120)]
    for i in range(150):        # edits pile up: far ends of the chain are not near
        base = base.copy()
        base[rng.randrange(len(base))] = f"e{i}"
        rows.append((i, " ".join(base)))
    common = " ".join(f"c{i}" for i in range(60))
    for i in range(150, 260):   # a long passage in common, not near
        rows.append((i, common + " " + " ".join(f"o{i}x{k}" for k in range(40 + i % 30))))
    rows += [(300 + i, f"Short {'A' if i % 2 else 'a'}") for i in range(6)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    check(m.components(frame).collect(), rows)


def test_one_document_of_each_group_stays(docs, records):
    out = m.one_per_group(docs)
    assert out.columns == docs.columns
    want = brute(records)
    assert (sorted(-1 if r["doc_id"] is None else r["doc_id"] for r in out.collect())
            == sorted(-1 if r[0] is None else r[0] for r in records if want[r[0]][1] == r[0]))


def test_signatures_estimate_the_likeness():
    s = m.Settings(trees=64)
    factors, shifts = m._permutations(s)
    words = [f"w{i}" for i in range(1000)]
    a = m.shingle_set(" ".join(words), 4)
    b = m.shingle_set(" ".join(words[100:] + [f"v{i}" for i in range(100)]), 4)
    j = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    same = (m.signature(a, factors, shifts) == m.signature(b, factors, shifts)).mean()
    assert abs(same - j) < 0.1


def family(n, pairs):
    """Documents that share 170 words at a likeness of 0.78, ``pairs`` of them near each other."""
    shared = " ".join(f"c{i}" for i in range(170))
    own = [[f"o{i}x{k}" for k in range(23)] for i in range(n)]
    for p in range(pairs):      # the partner is anywhere, not beside
        own[n - 1 - p] = own[p][:8] + own[n - 1 - p][8:]
    return [(i, shared + " " + " ".join(own[i])) for i in range(n)]


def family_recall(spark, n, pairs, settings):
    rows = family(n, pairs)
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = {r["doc_id"]: r["component_id"] for r in m.components(frame, settings=settings).collect()}
    for i in range(pairs, n - pairs):
        assert got[i] == i
    assert all(got[n - 1 - p] in (p, n - 1 - p) for p in range(pairs))
    return sum(got[n - 1 - p] == p for p in range(pairs)) / pairs


def test_links_inside_a_dense_family_are_found(spark):
    a, b = (shingles(text) for _, text in (family(900, 90)[0], family(900, 90)[899]))
    assert 100 * len(a & b) >= 80 * len(a | b)
    a, b = (shingles(text) for _, text in (family(900, 90)[0], family(900, 90)[400]))
    assert 100 * len(a & b) < 80 * len(a | b)
    assert family_recall(spark, 900, 90, m.Settings()) >= 0.98
    assert family_recall(spark, 900, 90, m.Settings(crowd=100)) >= 0.95    # deep leaves, tiles
