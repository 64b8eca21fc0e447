import re

import pytest
from pyspark.sql import functions as F

from cellpulse.llm import mixing as m


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def wanted(records):
    sizes = {}
    for r in records:
        sizes[r[3]] = sizes.get(r[3], 0) + size(r[1])
    names = sorted(sizes, key=lambda n: (n is None, n or ""))
    weight = {n: (3, 1, 2)[i % 3] for i, n in enumerate(names)}
    target, free = {}, set(names)
    left = 1.5 * sum(sizes.values())
    while free:
        level = left / sum(weight[n] for n in free)
        full = {n for n in free if level * weight[n] > 2 * sizes[n]}
        if not full:
            target.update({n: level * weight[n] for n in free})
            break
        for n in full:
            target[n] = 2.0 * sizes[n]
            left -= target[n]
        free -= full
    return sizes, target


SMALL = m.Settings(block=8, shard=64)


def test_targets_and_taken_words(docs, records, no_docs):
    out = m.mix_sizes(docs, SMALL).collect()
    sizes, target = wanted(records)
    assert len(out) == len(records)
    source = {r[0]: r[3] for r in records}
    taken = dict.fromkeys(sizes, 0)
    for r in out:
        name = source[r["doc_id"]]
        assert r["source_size"] == sizes[name]
        assert r["target"] == pytest.approx(target[name])
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[name] += r["taken"]
    for name in sizes:
        assert abs(taken[name] - target[name]) <= 2 * SMALL.block
    again = m.mix_sizes(docs, SMALL).collect()
    assert sorted(map(str, again)) == sorted(map(str, out))
    assert m.mix_sizes(no_docs, SMALL).count() == 0


def test_permutation_is_one_to_one(spark):
    for blocks in (1, 2, 7, 64, 1000):
        rows = spark.range(blocks).select(
            F.lit(3).alias("no"), F.lit(1).alias("pass"), F.lit(blocks).cast("bigint")
            .alias("blocks"), F.col("id").alias("_x"))
        got = [r["_x"] for r in m.permuted(rows, SMALL).collect()]
        assert sorted(got) == list(range(blocks))
        assert blocks < 60 or got != list(range(blocks))


def test_slots_meet_the_whole_numbers(spark):
    sources = spark.createDataFrame(
        [(1, 40, 60), (2, 500, 450), (3, 3, 6), (4, 0, 0)], "no int, blocks bigint, slots bigint")
    rows = m.slots(sources, SMALL).collect()
    assert sorted(r["slot"] for r in rows) == list(range(516))
    for no, n in ((1, 60), (2, 450), (3, 6)):
        assert sorted(r["j"] for r in rows if r["no"] == no) == list(range(n))


def test_mixed_documents_hold_the_taken_words(docs, records, no_docs):
    out = m.mixed_documents(docs, SMALL)
    assert out.columns == docs.columns
    words = {}
    texts = {}
    for r in records:
        texts.setdefault(r[0], set()).add(r[1])
    for r in out.collect():
        words[r["doc_id"]] = words.get(r["doc_id"], 0) + size(r["text"])
        assert r["n_chars"] == len(r["text"])
        if size(r["text"]) == size(next(iter(texts[r["doc_id"]]))):
            assert r["text"] in texts[r["doc_id"]]
    taken = {}
    for r in m.mix_sizes(docs, SMALL).collect():
        taken[r["doc_id"]] = taken.get(r["doc_id"], 0) + r["taken"]
    assert words == {i: n for i, n in taken.items() if n}
    assert m.mixed_documents(no_docs, SMALL).count() == 0


def test_blocks_of_the_mix_follow_the_draws(docs, records, no_docs):
    per_draw = {}
    for draw in (0, 1):
        s = m.Settings(block=8, shard=64, draw=draw)
        blocks = m.mixed_blocks(docs, s).collect()
        assert sorted(r["slot"] for r in blocks) == list(range(len(blocks)))
        assert all(r["shard"] == r["slot"] // s.shard for r in blocks)
        counted = {r["doc_id"]: 0 for r in m.mix_sizes(docs, s).collect()}
        first, taken = {}, {}
        for r in m.mix_sizes(docs, s).collect():
            counted[r["doc_id"]] += r["taken"]
            assert (r["first_slot"] is None) == (r["taken"] == 0)
            assert r["taken"] == 0 or r["first_shard"] == r["first_slot"] // s.shard
        for r in blocks:
            taken[r["source"]] = taken.get(r["source"], 0) + size(r["text"])
            first.setdefault(r["shard"], []).append((r["source"] or "", r["text"]))
        assert sum(taken.values()) == sum(counted.values())
        per_draw[draw] = counted, taken, first
    (counted, taken, shards), (counted_1, taken_1, shards_1) = per_draw[0], per_draw[1]
    assert counted == counted_1 and taken == taken_1
    assert any(sorted(shards[i]) != sorted(shards_1[i]) for i in shards)
    assert sorted(sum(shards.values(), [])) == sorted(sum(shards_1.values(), []))
    assert m.mixed_blocks(no_docs, SMALL).count() == 0


def test_blocks_hold_the_words_of_their_source(docs, records):
    streams = {}
    for r in sorted((r for r in records if r[0] not in (None, 5)), key=lambda r: r[0]):
        streams.setdefault(r[3], set()).update(re.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))
    extra = {w for r in records if r[0] in (None, 5) for w in size_words(r[1])}
    for r in m.mixed_blocks(docs, SMALL).collect():
        found = size_words(r["text"])
        assert 0 < len(found) <= SMALL.block
        assert set(found) <= streams[r["source"]] | extra


def size_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")
