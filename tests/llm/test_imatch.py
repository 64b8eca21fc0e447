import hashlib
import re

from pyspark.sql import functions as F

from cellpulse.llm import imatch as m


def terms(text):
    plain = text.lower().translate(str.maketrans("", "", m.PUNCTUATION))
    return {w for w in re.split(r"[\x20\x09-\x0D]+", plain) if w}


def test_edited_texts_and_equal_prints(docs, records):
    out = m.fingerprints(docs.where("doc_id IS NOT NULL AND doc_id <> 5")).collect()
    texts = {r[0]: r[1] or "" for r in records if r[0] not in (None, 5)}
    ids = sorted(texts)
    by_id = {r["doc_id"]: r for r in out}
    assert sorted(by_id) == ids
    for at, i in enumerate(ids):
        text, after = texts[i], texts[ids[(at + 1) % len(ids)]]
        cut = len(text) // 4
        edited = text[:len(text) - cut] + after[:cut]
        assert by_id[i]["n_chars"] == len(text)
        assert by_id[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        if edited == text:
            assert by_id[i]["near_edited"] == 1.0
        assert 0 <= by_id[i]["near_edited"] <= 1 and 0 <= by_id[i]["near_next"] <= 1
    prints = {}
    for i in ids:
        assert prints.setdefault(texts[i], by_id[i]["fingerprint"]) == by_id[i]["fingerprint"]
    near = by_id[111]["fingerprint"], by_id[7]["fingerprint"]
    same = sum(a == b != "0000" for a, b in zip(*(re.findall("....", x) for x in near)))
    assert same >= 10


def test_repeated_null_and_single_rows(docs, no_docs, records):
    rows = m.fingerprints(docs).collect()
    assert len(rows) == len(records)
    assert len({r["fingerprint"] for r in rows if r["doc_id"] == 5}) == 1
    one = m.fingerprints(docs.where("doc_id = 3")).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0
    assert m.fingerprints(no_docs).count() == 0


def test_lexicon_holds_the_band(spark):
    frame = spark.createDataFrame([(f"all w{i % 10} once{i}",) for i in range(40)], "text string")
    bits = m.lexicon(frame, 2 / 40, 8 / 40).first()["bitmap"]
    assert len(bits) == m.CELLS // 64
    cells = {w: spark.range(1).select(F.xxhash64(F.lit(w))).first()[0] & (m.CELLS - 1)
             for w in [f"w{i}" for i in range(10)] + ["all"] + [f"once{i}" for i in range(40)]}
    held = {w for w, c in cells.items() if bits[c >> 6] >> (c & 63) & 1}
    assert held == {f"w{i}" for i in range(10)}


def test_ranges_pair_every_row_with_the_next(spark):
    frame = spark.range(0, 5000, 7).select(F.col("id").alias("doc_id"),
                                           F.col("id").cast("string").alias("text"))
    rows = m.beside_next(frame).collect()
    ranges = {}
    for r in rows:
        ranges.setdefault(r["_range"], []).append((r["_guest"], r["doc_id"]))
    pairs = {}
    for members in ranges.values():
        members.sort()
        assert [g for g, _ in members].count(True) == 1
        pairs.update({a[1]: b[1] for a, b in zip(members, members[1:]) if not a[0]})
    ids = list(range(0, 5000, 7))
    assert pairs == dict(zip(ids, ids[1:] + ids[:1]))
