import re
from collections import Counter

from pyspark.sql import functions as F

from cellpulse.llm import line_quality as m


def base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(8)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")),
            len(lines) - len(set(lines)), len(covered))


def test_base_figures(docs, records, no_docs):
    out = m.judge(docs).collect()
    assert len(out) == len(records)
    got = sorted(str((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"],
                      r["n_dup_lines"], r["n_repeat_words"])) for r in out)
    assert got == sorted(str((r[0], *base(r[1]))) for r in records)
    for r in out:
        failed = r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"]
        assert r["base_failed"] == failed and not (failed and r["kept"])
    assert m.judge(no_docs).count() == 0


def test_overlapping_repeats(spark):
    texts = ["a b c d e f g h a b c d e f g h", " ".join(["x"] * 30), "a b c d e f g h i " * 3,
             " ".join(f"w{i}" for i in range(100)), "1 2 3 4 5 6 7 8 9 0 z 2 3 4 5 6 7 8 9 0 1"]
    frame = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)],
                                  "doc_id bigint, text string, source string")
    got = {r["doc_id"]: r["n_repeat_words"] for r in m.judge(frame).collect()}
    assert got == {i: base(t)[4] for i, t in enumerate(texts)}


def named(*numbers):
    return "x".join(chr(97 + n // 26) + chr(97 + n % 26) for n in numbers)


def test_common_lines_deplete_but_copies_do_not(spark):
    rows = []
    for i in range(200):
        own = "\n".join(" ".join(named(i, k, j) for j in range(12)) for k in range(3))
        common = "\n".join(" ".join("menu" + named(k, j) for j in range(20)) for k in range(4))
        rows.append((i, own + "\n" + common if i < 80 else own, "site"))
    rows += [(1000 + i, rows[150][1], "site") for i in range(300)]
    rows += [(5000, rows[0][1], "other"), (5001, rows[0][1], None)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    kept = {r["doc_id"] for r in m.judge(frame).collect() if r["kept"]}
    assert kept.isdisjoint(range(80)) and set(range(80, 200)) <= kept
    assert {1000, 1299, 5000, 5001} <= kept


def test_small_and_hot_hosts_lose_their_footers(spark):
    def page(i, footer):
        own = "\n".join(" ".join(named(i % 676, i // 676, k, j) for j in range(8)) for k in range(3))
        return own + "\n" + "\n".join(" ".join(f"{footer}{named(k, j)}" for j in range(12))
                                      for k in range(3)) if footer else own
    rows = [(i, page(i, "small"), "small") for i in range(40)]
    rows += [(1000 + i, page(i, "hot" if i < 60 else ""), "hot") for i in range(6000)]
    rows += [(9000 + i, page(i, "pair" if i < 2 else ""), "few") for i in range(10)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    out = {r["doc_id"]: r for r in m.judge(frame).collect()}
    gone = {i for i, r in out.items() if r["n_common_words"]}
    assert gone == {*range(40), *range(1000, 1060)}
    assert all(out[i]["n_common_words"] == 36 and not out[i]["kept"] for i in gone)
    assert all(r["kept"] for i, r in out.items() if i not in gone)


def test_no_python_in_the_plan(docs):
    plan = m.base_figures(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("_text")),
                          ["doc_id"])._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
