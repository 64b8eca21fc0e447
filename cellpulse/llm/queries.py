"""The registered queries of the text operators, each over its whole table."""

from pyspark.sql import functions as F

from cellpulse.llm import (chat, collocations, imatch, jaccard_join, language_id, license_scan,
                           line_dedup, line_quality, main_text, mixing, near_dedup, packing, repair)
from cellpulse.llm.text import table


def language(spark, folder):
    return language_id.identify(table(spark, folder, "documents"))


def aligned_lines(spark, folder):
    out = line_dedup.dedup(table(spark, folder, "documents"))
    return out.select("doc_id", "text", F.char_length("text").cast("bigint").alias("n_chars"),
                      F.col("_cut_lines").cast("bigint").alias("n_cut_lines"))


def fingerprints(spark, folder):
    return imatch.fingerprints(table(spark, folder, "documents"))


def best_fit_packing(spark, folder):
    return packing.pack(table(spark, folder, "documents"))


def licenses(spark, folder):
    return license_scan.scan(table(spark, folder, "documents"))


def source_mix(spark, folder):
    return mixing.mix_sizes(table(spark, folder, "documents"))


def perspectives(spark, folder):
    return chat.render(table(spark, folder, "conversations"))


def quality(spark, folder):
    return line_quality.judge(table(spark, folder, "documents"))


def near_duplicates(spark, folder):
    return near_dedup.components(table(spark, folder, "documents"))


def html_extraction(spark, folder):
    return main_text.extract(table(spark, folder, "pages"), ["page_id", "url"])


def phrases(spark, folder):
    return collocations.collocations(table(spark, folder, "documents"))


def jaccard_links(spark, folder):
    return jaccard_join.components(table(spark, folder, "documents"))


def structure(spark, folder):
    return repair.audit(table(spark, folder, "conversations"))


QUERIES = {
    "op1_language_id": language,
    "op2_line_dedup": aligned_lines,
    "op3_imatch_fingerprints": fingerprints,
    "op4_best_fit_packing": best_fit_packing,
    "op5_license_scan": licenses,
    "op6_source_mixing": source_mix,
    "op7_chat_perspectives": perspectives,
    "op8_line_frequency_quality": quality,
    "op9_lsh_forest_near_dedup": near_duplicates,
    "op10_html_extraction": html_extraction,
    "op11_phrase_collocations": phrases,
    "op12_jaccard_metric_join": jaccard_links,
    "op13_structure_repair": structure,
}
ORACLES = {
    "op7_chat_perspectives": chat.RENDER_SQL,
    "op11_phrase_collocations": collocations.COLLOCATIONS_SQL,
}
