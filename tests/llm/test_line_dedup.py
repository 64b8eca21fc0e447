from hypothesis import given, settings, strategies as st

from cellpulse.llm import line_dedup as m


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 6), max_size=25), st.lists(st.integers(0, 6), max_size=25))
def test_patience_matches_are_equal_and_increasing(a, b):
    pairs = m.patience(a, b)
    assert all(a[i] == b[j] for i, j in pairs)
    assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))
    if a == b:
        assert len(pairs) == len(a)


def test_blocks_need_adjacent_lines():
    later = [(0, "a", 0, 9), (1, "b", 2, 9), (3, "c", 5, 30)]
    assert m.common_blocks(later, [(4, "a"), (5, "b"), (9, "c")], 18) == [(0, 2, 18), (5, 5, 30)]
    assert m.common_blocks(later, [(4, "a"), (6, "b")], 18) == []


def _runs(text, least):
    lines = [" ".join(x.split()) for x in (text or "").split("\n") if x.split()]
    for a in range(len(lines)):
        n = 0
        for b in range(a, len(lines)):
            n += len(lines[b].split())
            if n >= least:
                yield tuple(lines[a:b + 1])
                break


def test_no_passage_is_left_twice_and_none_is_lost(docs, records):
    out = m.dedup(docs).collect()
    assert len(out) == len(records)
    first = {}
    for r in sorted(out, key=lambda r: -1 if r["doc_id"] is None else r["doc_id"]):
        for run in _runs(r["text"], m.MIN_WORDS):
            assert first.setdefault(run, r["doc_id"]) == r["doc_id"]
    lines = {x for r in records for x in (r[1] or "").split("\n")}
    left = {x for r in out for x in (r["text"] or "").split("\n")}
    assert {x for x in lines if x.strip()} <= left
    by_id = {r["doc_id"]: r for r in out}
    assert by_id[111]["text"] == by_id[7]["text"] or by_id[111]["_cut_lines"] > 0
    assert by_id[125]["text"] is None and by_id[126]["text"] == ""
    for i in range(90):
        assert by_id[i]["_cut_lines"] == 0


def test_stage_keeps_columns_and_drops_emptied(docs, no_docs):
    out = m.without_repeats(docs)
    assert out.columns == docs.columns
    rows = out.collect()
    ids = [r["doc_id"] for r in rows]
    assert 111 not in ids and 7 in ids and 126 in ids and ids.count(5) == 2
    assert all(r["n_chars"] == len(r["text"] or "") for r in rows)
    assert m.without_repeats(no_docs).count() == 0


def _passage(name, lines=4):
    return "\n".join(" ".join(f"{name}{k}x{j}" for j in range(10)) for k in range(lines))


def test_swapped_and_repeated_passages_go(spark):
    p, q = _passage("p"), _passage("q")
    rows = [(1, f"{p}\nown one\n{q}"), (2, f"{q}\nown two\n{p}"), (3, f"{p}\nown three\n{p}"),
            (4, f"p0x0\n{p}\n{p}\n{q}\nown four\n{q}\n{p}")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r["doc_id"]: r["text"] for r in m.dedup(frame).collect()}
    assert got == {1: rows[0][1], 2: "own two", 3: "own three", 4: "p0x0\nown four"}


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=25), st.lists(st.integers(0, 4), max_size=25))
def test_no_common_run_remains(a, b):
    shared = set(a) & set(b)
    later = [(i, h, i, 1 + h % 2) for i, h in enumerate(a) if h in shared]
    earlier = [(i, h) for i, h in enumerate(b) if h in shared]
    cuts = m.common_blocks(later, earlier, 3)
    gone = [i for first, last, _ in cuts for i in range(first, last + 1)]
    assert len(gone) == len(set(gone))
    held = {tuple(b[i:k]) for i in range(len(b)) for k in range(i + 1, len(b) + 1)}
    for i in range(len(a)):
        for k in range(i + 1, len(a) + 1):
            if sum(1 + h % 2 for h in a[i:k]) >= 3 and not set(gone) & set(range(i, k)):
                assert tuple(a[i:k]) not in held
    for first, last, words in cuts:
        assert tuple(a[first:last + 1]) in held and words >= 3


def test_own_words_stay_however_few(spark):
    long = _passage("p", 40)
    rows = [(1, long, 0), (2, f"{long}\nown words", 0), (3, f"{long}\n \n", 0)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, n_chars bigint")
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in m.without_repeats(frame).collect()}
    assert got == {1: (long, 0), 2: ("own words", 9)}
