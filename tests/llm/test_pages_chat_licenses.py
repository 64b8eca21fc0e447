import duckdb
import pytest

from cellpulse.llm import chat, license_scan, main_text


@pytest.fixture(scope="module")
def tree(spark):
    return main_text.fit_tree(spark)


def test_labelled_table_is_learned(tree):
    rows = main_text.labelled_blocks()
    assert 80 < len(rows) <= 200
    assert sum(main_text.is_main(tree, x) == y for y, x in rows) >= 0.98 * len(rows)


@pytest.mark.parametrize("html, text", [
    (None, ""), ("", ""), ("<nav><a>Home</a></nav>", ""),
    ("<article><p>One &amp; two.&nbsp; x\n y<br>z<p>End</article><footer>f</footer>",
     "One & two. x y z\nEnd"),
    ("<article><h1>T</h1><script>var a='</p>';</script><style>p{}</style><!-- c --><p>B"
     "<div class=ad>Buy now</div><p>C</article>", "T\nB\nC"),
    ("<aside>side</aside><main><p>Only</main><form>mail <input></form>"
     "<section id=comments><article><p>I do not agree with a single word of it at all"
     "</article></section>", "Only"),
    ("<article><p>never closed <b>bold", "never closed bold"),
    ("<p title=\"a > b\">a long paragraph of more than a dozen plain words without any link here "
     "at all</p>", "a long paragraph of more than a dozen plain words without any link here at all"),
])
def test_main_text(tree, html, text):
    assert main_text.page_text(html, tree) == text


def test_every_page_has_a_row(spark, tree):
    pages = spark.createDataFrame(
        [(1, "u", "<article><p>Hé &#233;</article>", "x"), (2, None, None, "x"),
         (1, "u", "<article><p>Hé &#233;</article>", "x")],
        "page_id bigint, url string, html string, text string")
    rows = sorted(main_text.extract(pages, ["page_id", "url"], tree=tree).collect(), key=str)
    assert [(r["page_id"], r["text"], r["n_chars"]) for r in rows] == [
        (1, "Hé é", 4), (1, "Hé é", 4), (2, "", 0)]
    assert main_text.extract(pages.limit(0), ["page_id"], tree=tree).count() == 0


def test_chat_matches_sql_and_splits_long_dialogues(spark):
    rows = [(1, 0, "system", "be kind"), (1, 1, "ann", "hi <|end|>"), (1, 2, "bob", "hello"),
            (1, 3, "ann", None), (1, 3, "ann", None), (2, 0, None, "x"), (2, None, "", "y"),
            (3, 0, "system", "alone"), (None, 1, "zoë", "ñ"), (4, 1, "a", "w" * 40000),
            (4, 2, "b", "v" * 10), (4, 3, "a", "u" * 40000)]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = chat.render(frame.withColumn("size", frame["turn"])).toPandas()
    db = duckdb.connect()
    db.register("conversations", frame.toPandas())
    db.execute("CREATE VIEW c AS SELECT conv_id::BIGINT conv_id, turn::BIGINT turn, role, text "
               "FROM conversations")
    want = db.execute(chat.RENDER_SQL.replace("FROM conversations)", "FROM c)")).df()
    got["conv_id"], want["conv_id"] = got["conv_id"].fillna(-1), want["conv_id"].fillna(-1)
    order = ["conv_id", "speaker", "piece"]
    got, want = (x.sort_values(order).reset_index(drop=True)[sorted(x.columns)].astype(str)
                 for x in (got, want))
    got["conv_id"] = got["conv_id"].astype(float)
    want["conv_id"] = want["conv_id"].astype(float)
    assert got.equals(want)
    for r in chat.render(frame).collect():
        for span in filter(None, r["spans"].split(",")):
            a, b = map(int, span.split("-"))
            assert r["text"][:a].endswith("<|assistant|>\n") and r["text"][a:b].endswith(chat.END)
    assert max(r["piece"] for r in chat.render(frame).collect()) >= 1
    assert chat.render(frame.limit(0)).count() == 0


def test_licenses_are_found_and_mentions_are_not(docs, no_docs, spark):
    model = license_scan.fit(docs, sample=40)
    good = {"Released under the MIT License.": "mit", "All rights reserved.": "proprietary",
            "Licensed under the Apache License, Version 2.0 (the \"License\")": "apache-2.0",
            "This work is licensed under the GNU General Public License, version 3.": "gpl",
            "Licensed under CC BY-NC 4.0.": "cc-by-nc", "Licensed under CC BY-SA 4.0": "cc-by-sa"}
    for line, family in good.items():
        assert model.classify(line)[0] == family, line
    for line in ("The driving license office opens at nine.", "mit der Zeit", "", "apache",
                 "The general public reserved all rights to complain about the license fee."):
        assert model.classify(line)[0] == license_scan.UNKNOWN, line
    rows = {r["doc_id"]: r for r in license_scan.scan(docs, model=model).collect()}
    assert (rows[132]["families"], rows[132]["n_license"], rows[132]["lines"]) == ("mit", 1, [0])
    assert rows[125]["n_paragraphs"] == 0 and rows[0]["n_license"] == 0
    assert license_scan.scan(no_docs, model=model).count() == 0
    assert license_scan.fit(no_docs).classify("Released under the MIT License.")[0] == "mit"
