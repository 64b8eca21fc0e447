import random
import re
from collections import Counter

from hypothesis import given, settings, strategies as st

from cellpulse.llm import collocations as m

LOWER = {i: i + 32 for i in range(65, 91)}


def brute(rows, s):
    """Phrases per language counted word by word."""
    counts, totals = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, s.max_words + 1):
                counts.setdefault(lang, Counter()).update(
                    tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, found in counts.items():
        cands = {p: n for p, n in found.items() if len(p) > 1 and n >= s.min_count}
        longer = Counter()
        for p, n in cands.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    longer[p[i:i + k]] = max(longer[p[i:i + k]], n)
        rows = []
        for p, a in cands.items():
            if longer[p] and 100 * longer[p] >= s.covered * a:
                continue
            score, k = min((1000000 * a * a // (found[p[:k]] * found[p[k:]]), k)
                           for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), found[p[:k]], found[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, left, right, totals[lang], -score)
                for i, (score, a, p, left, right) in enumerate(sorted(rows)[:s.top])]
    return sorted(out)


def result(docs, s):
    out = m.collocations(docs, s)
    assert out.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(map(tuple, out.collect()))


def test_phrases_match_brute_force(spark, docs, records, no_docs):
    rows = [(r[1], r[2]) for r in records]
    for s in (m.Settings(min_count=2, modulus=4), m.Settings(), m.Settings(2, 3, 50, 5, 2),
              m.Settings(4, 2, 70, 100, 3)):
        want = brute(rows, s)
        assert want and result(docs, s) == want
    assert m.collocations(no_docs).count() == 0


def test_repeats_breaks_and_covered_phrases(spark):
    rng = random.Random(2)
    rows = [("x " * 3000, "en"), ("New York. New York City!\tnew york", "en"), (None, "en"), ("", None),
            ("...", None), (" a  a\x0ba b", None), ("one", "de")]
    vocabulary = "new york city of the bigé apple A.b c,d é".split(" ")
    for i in range(200):
        rows.append((rng.choice([" ", "\t", "  "]).join(rng.choices(vocabulary, k=30)), "en"))
        rows.append(("the same words of every text " * 4, ["de", None, "en"][i % 3]))
    frame = spark.createDataFrame(rows, "text string, lang string").repartition(5)
    s = m.Settings()
    assert result(frame, s) == brute(rows, s)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["a", "b", "c", "d.", "e", "\n"]), max_size=25),
                max_size=6), st.integers(1, 5), st.integers(1, 4))
def test_every_phrase_is_owned_by_one_chunk(texts, modulus, widest):
    s = m.Settings(max_words=widest, modulus=modulus)
    texts = [" ".join(t).encode() for t in texts]
    parsed = [("en", c, 1) for _, c in m.chunks(texts, s)] if texts else []
    want = Counter()
    for text in texts:
        for piece in re.split(rb"[.\n]", text):
            words = piece.split()
            for k in range(1, widest + 1):
                want.update(b" ".join(words[i:i + k]) for i in range(len(words) - k + 1))
    got = Counter()
    if parsed:
        grams = m._Grams(parsed, s, [], 1)
        buffer, at = grams.words.joined()
        for k in range(widest):
            # Without a filter every level keeps its whole phrases.
            full = m._Grams(parsed, s, [b] * k if (b := _all_bits()) is not None else [], k + 1)
            for i in full.spots[k]:
                got[buffer[at[i]:at[i + k + 1] - 1]] += 1
    assert got == want


def _all_bits():
    import numpy as np
    return np.full(1024, 2 ** 64 - 1, np.uint64)
