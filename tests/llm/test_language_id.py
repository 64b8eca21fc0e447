import zlib

from cellpulse.llm import language_id as m

SMALL = m.Settings(sample=40, rounds=3, shards=2)


def test_held_out_rows_are_recognised(docs, records):
    rows = {r["doc_id"]: r for r in m.identify(docs, SMALL).collect()}
    assert len(rows) == len({r[0] for r in records})
    truth = {r[0]: r[2] for r in records}
    checked = [i for i in range(110) if zlib.crc32(str(i).encode()) % 3 == 1]
    assert all(rows[i]["held_out"] for i in checked)
    assert sum(rows[i]["held_out"] for i in rows) < len(rows) / 2
    right = sum(rows[i]["lang_pred"] == truth[i] for i in checked)
    assert right >= 0.95 * len(checked)
    assert all(0 <= r["score"] <= 1 for r in rows.values())
    for i in (125, 126, 127, 128):      # null, empty, blanks, no letter
        assert (rows[i]["lang_pred"], rows[i]["score"]) == ("und", 0.0)
    assert rows[None]["lang_pred"] == "fr"


def test_nothing_to_learn_from(docs, no_docs):
    assert m.identify(no_docs, SMALL).count() == 0
    blank = docs.withColumn("lang", docs["lang"].substr(99, 1)).where("lang IS NULL")
    assert {r["lang_pred"] for r in m.identify(blank, SMALL).collect()} <= {"und"}


def test_rejected_rows_go_and_columns_stay(docs):
    model = m.fit(docs, ~m.held_out(), settings=SMALL)
    kept = m.keep_known(docs, model)
    assert kept.columns == docs.columns
    ids = {r["doc_id"] for r in kept.select("doc_id").collect()}
    assert ids.isdisjoint({125, 126, 127, 128}) and set(range(110)) <= ids


def test_weights_are_sparse(docs):
    model = m.fit(docs, settings=SMALL)
    assert 0 < (model.weights != 0).mean() < 0.5
    assert model.languages == ["de", "en", "fr"]
