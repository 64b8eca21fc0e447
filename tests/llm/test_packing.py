import functools
import zlib

import numpy as np
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cellpulse.llm import packing as m


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 200), max_size=20))
def test_plan_fills_every_slot_once(counts):
    plan = m.plan_counts(counts, 64)
    places = {}
    ranks = {n: set() for n in counts}
    for length, rank, n, first, offset in plan:
        for k in range(n):
            ranks[length].add(rank + k)
            places.setdefault(first + k, []).append((offset, length))
    assert all(ranks[n] == set(range(c)) for n, c in counts.items())
    for spots in places.values():
        end = 0
        for offset, length in sorted(spots):
            assert offset == end
            end += length
        assert end <= 64
    total = sum(n * c for n, c in counts.items())
    assert sorted(places) == list(range(len(places)))
    # Any two sequences hold more than one could, or the later would not have been opened.
    assert len(places) <= max(min(1, total), 2 * total // 64)


def fewest(sizes, capacity):
    """Least number of sequences, by filling one with every choice that holds the longest."""
    if not sizes:
        return 0
    best, (first, *rest) = len(sizes), sizes
    for mask in range(1 << len(rest)):
        some = [x for i, x in enumerate(rest) if mask >> i & 1]
        if first + sum(some) <= capacity:
            left = [x for i, x in enumerate(rest) if not mask >> i & 1]
            best = min(best, 1 + fewest(left, capacity))
    return best


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=7))
def test_plan_is_near_the_optimum(sizes):
    counts = {n: sizes.count(n) for n in sizes}
    used = {row[3] + k for row in m.plan_counts(counts, 20) for k in range(row[2])}
    best = fewest(sorted(sizes, reverse=True), 20)
    assert best <= len(used) <= best * 11 / 9 + 2 / 3


def test_plan_is_independent_of_the_number_of_documents():
    sizes = [len(m.plan_counts({length: n for length in range(1, 400)}, 4096))
             for n in (10 ** 5, 10 ** 9)]
    assert sizes[1] < 1.1 * sizes[0] < 40_000


def test_pieces_round_trip(docs, records, no_docs):
    out = m.pack(docs, capacity=512).toPandas()
    tokenizer = Tokenizer.from_file(m.default_tokenizer())
    want = []
    for r in records:
        ids = np.array(tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [1], "<u4")
        want += [(-1 if r[0] is None else r[0], k, at, len(ids[at:at + 512]),
                  zlib.crc32(ids[at:at + 512].tobytes()))
                 for k, at in enumerate(range(0, len(ids), 512))]
    got = out.fillna({"doc_id": -1})[["doc_id", "piece", "start", "length", "ids_crc32"]]
    assert sorted(map(tuple, got.astype(int).values.tolist())) == sorted(want)
    for _, rows in out.groupby("sequence_id"):
        rows = rows.sort_values("offset")
        assert list(rows["offset"]) == [0, *rows["length"].cumsum()[:-1]]
        assert rows["length"].sum() <= 512
    assert out["sequence_id"].nunique() <= 1 + out["length"].sum() / 512 * 1.05
    assert m.pack(no_docs).count() == 0


def test_full_cache_changes_nothing():
    texts = ["one two three two", "two\nfour Five <|endoftext|> FIVE", ""]
    whole = m.WordEncoder(m.default_tokenizer()).encode(texts)
    long = ["x" * 100_000, "one " + "y" * 70 + " two"]
    for room in (0, 300, None):
        small = m.WordEncoder(m.default_tokenizer(), room)
        assert [small.encode([t])[0] for t in texts] == whole
        again = [small.encode([t])[0] for t in long + long]
        assert again[:2] == again[2:] and all(len(w) <= 64 for w in small.known)


class Counted:
    """A tokenizer that counts the inputs it gets."""

    def __init__(self, tokenizer):
        self.tokenizer, self.inputs = tokenizer, 0

    def encode_batch_fast(self, inputs, **options):
        self.inputs += len(inputs)
        return self.tokenizer.encode_batch_fast(inputs, **options)


def test_words_are_encoded_once_and_side_by_side():
    words = [a + b + c for a in "bdfgklmnpr" for b in "aeiouéяž" for c in "stvwxzbdfg"]
    texts = [" ".join(w + mark for w in words) for mark in ("", ",", ".", "!!", "'", "<|")]
    encoder = m.WordEncoder(m.default_tokenizer())
    encoder.tokenizer = Counted(encoder.tokenizer)
    got = encoder.encode(texts)
    assert encoder.tokenizer.inputs < 20
    tokenizer = Tokenizer.from_file(m.default_tokenizer())
    assert got == [np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes()
                   for t in texts]


ODD = [chr(c) for c in [*range(128), *range(0xa0, 0x180), *range(0x400, 0x490), 0x301, 0x307,
                        0x3a3, 0x4e2d, 0x3002, 0xd55c, 0x1100, 0x1161, 0xb2, 0x2028, 0x3000,
                        0xfb01, 0x1f600, 0x200d]]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.one_of(
    st.sampled_from(ODD), st.sampled_from(["the", "Ing", "'s", "'re", "<|endoftext|>", " ", "\n",
                                           "İ.", "é,", "á!"])), max_size=40).map("".join),
    max_size=6), st.sampled_from([0, 500, None]), st.booleans())
def test_ids_are_those_of_whole_texts(texts, room, closing):
    encoder, closes = _encoder()
    encoder.known, encoder.room = {}, 10 ** 6 if room is None else room
    # Models that close no words are encoded word by word.
    encoder.closes = closes if closing else np.zeros_like(closes)
    want = [np.array(encoder.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes()
            for t in texts]
    assert encoder.encode(texts) == want
    assert encoder.encode(texts[::-1]) == want[::-1]


@functools.cache
def _encoder():
    made = m.WordEncoder(m.default_tokenizer())
    return made, made.closes


def test_a_text_column_without_a_type_is_empty(docs):
    out = m.pack(docs.withColumn("text", F.lit(None))).toPandas()
    assert len(out) == docs.count() and set(out["length"]) == {1}


def test_groups_of_texts_hold_every_row_once():
    import pyarrow as pa
    for texts in ([], [None], ["", None, "abc"], ["x" * 9, "y", "", "zz" * 30, None, "w"]):
        groups = list(m._small_groups(pa.array(texts, pa.string()), 10))
        assert [t for g in groups for t in g.to_pylist()] == texts
        assert all(sum(len(t or "") for t in g.to_pylist()[:-1]) < 10 for g in groups)
