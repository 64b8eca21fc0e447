import re
import zlib

import numpy as np
from pyspark.sql import functions as F
from test_near_dedup import brute
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from cellpulse.llm import packing


def test_every_stage_acts_and_keeps_clean_documents(spark, docs, records, tmp_path):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "line_dedup", "minhash_near_dedup", "source_mixing",
                     "best_fit_packing"]
    seen, frame = [], docs
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / f"{number}.parquet")
        stage(spark, frame, None).write.parquet(path)
        frame = spark.read.parquet(path)
        if number < 4:
            assert frame.columns == docs.columns
        seen.append([r["doc_id"] for r in frame.select("doc_id").collect()])
    assert set(range(110)) <= set(seen[0]) and 126 not in seen[0]
    assert set(range(110)) <= set(seen[1]) and 111 not in seen[1]
    before = spark.read.parquet(str(tmp_path / "1.parquet")).select("doc_id", "text").collect()
    groups = brute(before)
    assert sorted(seen[2], key=str) == sorted((i for i in seen[1] if groups[i][1] == i), key=str)
    assert set(range(110)) <= set(seen[2]) and 113 not in seen[2]
    assert set(seen[3]) <= set(seen[2])
    pieces = frame.toPandas()
    mixed = spark.read.parquet(str(tmp_path / "3.parquet")).collect()
    tokenizer = Tokenizer.from_file(packing.default_tokenizer())
    sums = []
    for r in mixed:
        ids = np.array(tokenizer.encode(r["text"], add_special_tokens=False).ids + [1], "<u4")
        sums += [zlib.crc32(ids[at:at + 4096].tobytes()) for at in range(0, len(ids), 4096)]
    assert sorted(pieces["ids_crc32"]) == sorted(sums)


def test_near_copies_are_judged_by_five_words(spark, docs):
    words = [f"w{i}" for i in range(80)]
    near = [*words[:20], "x", *words[21:50], "y", *words[51:]]      # 69/85 by four, 66/86 by five
    nearer = [*words[:20], "z", *words[21:]]
    frame = spark.createDataFrame(
        [(1, " ".join(words)), (2, " ".join(near)), (3, " ".join(nearer))],
        "doc_id bigint, text string").union(docs.select("doc_id", "text").where("doc_id >= 10"))
    sets = {r["doc_id"]: r["text"] for r in frame.collect()}
    got = {r["doc_id"] for r in corpus_pipeline.distinct_documents(spark, frame, None).collect()}
    assert got == {i for i, root in by_five_words(sets).items() if i == root}
    assert {1, 2} <= got and 3 not in got


def by_five_words(texts):
    sets, group = {}, {i: i for i in texts}
    for i, text in texts.items():
        parts = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
        sets[i] = {tuple(parts[k:k + 5]) for k in range(max(1, len(parts) - 4))} if parts else set()
    for i, p in sets.items():
        for j, q in sets.items():
            if i < j and p and q and 100 * len(p & q) >= 80 * len(p | q) and group[i] != group[j]:
                low, high = sorted((group[i], group[j]))
                group = {k: low if g == high else g for k, g in group.items()}
    return group


def test_queries_are_registered():
    names = entry.queries()
    assert "pipeline" in names
    for number in range(1, 11):
        assert sum(n.startswith(f"op{number}_") for n in names) == 1


def test_stages_bound_what_a_worker_gets_at_once(spark):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.unset(name)
    docs = spark.range(24, numPartitions=1).select("id", F.repeat(F.lit("a"), 1 << 20).alias("text"))

    def sizes(batches):
        import pyarrow as pa
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["n"])

    @corpus_pipeline.bounded_batches
    def measured(spark, docs, sf_dir):
        return docs.mapInArrow(sizes, "n bigint")
    try:
        got = [r["n"] for r in measured(spark, docs, None).collect()]
        assert sum(got) >= 24 << 20 and max(got) <= corpus_pipeline.BATCH_BYTES + (2 << 20)
        assert all(hasattr(stage, "__wrapped__") for _, stage in corpus_pipeline.STAGES)
        spark.conf.set(name, "64m")         # the session's own bound stays
        measured(spark, docs, None)
        assert spark.conf.get(name) == "64m"
    finally:
        spark.conf.unset(name)
