"""From raw documents to packed token sequences.

Each stage takes (spark, docs, sf_dir); its result is written as Parquet and read again as the
documents of the next one.
"""

import functools

from cellpulse.llm import language_id, line_dedup, mixing, near_dedup, packing
from cellpulse.session import materialise


CACHED_BYTES = 32 << 20   # of encoded words per worker, beside the other stages' memory
BATCH_BYTES = 4 << 20      # of rows that travel to a worker at once


def bounded_batches(stage):
    """The stage with Arrow batches bounded in bytes, unless the session has a bound of its own.

    Without one a batch takes 10,000 rows of any length, and both executor and worker hold it.
    The bound stays, since a stage's result may be computed after it returns.
    """
    @functools.wraps(stage)
    def run(spark, docs, sf_dir):
        name = "spark.sql.execution.arrow.maxBytesPerBatch"
        if spark.conf.get(name, None) is None:
            spark.conf.set(name, BATCH_BYTES)
        return stage(spark, docs, sf_dir)
    return run


@bounded_batches
def known_language(spark, docs, sf_dir):
    """Documents whose language is recognised; learned from their own labels."""
    return language_id.keep_known(docs, language_id.fit(docs, ~language_id.held_out()))


@bounded_batches
def unrepeated_lines(spark, docs, sf_dir):
    """Documents without the passages that an earlier one holds."""
    return line_dedup.without_repeats(docs)


@bounded_batches
def distinct_documents(spark, docs, sf_dir):
    """One document of each group of near copies, by shingles of five words."""
    return near_dedup.one_per_group(docs, settings=near_dedup.Settings(shingle=5))


@bounded_batches
def mixed_sources(spark, docs, sf_dir):
    """The sources in the target mix."""
    return mixing.mixed_documents(docs)


@bounded_batches
def packed_sequences(spark, docs, sf_dir):
    """Pieces with their places in token sequences."""
    return packing.pack(docs, cached_bytes=CACHED_BYTES)


STAGES = [
    ("language_id", known_language),
    ("line_dedup", unrepeated_lines),
    ("minhash_near_dedup", distinct_documents),
    ("source_mixing", mixed_sources),
    ("best_fit_packing", packed_sequences),
]

# The classifier, the signatures and the tokenizer have no form in SQL.
ORACLE_SQL = None


def run(spark, sf_dir):
    """Apply the stages to the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
