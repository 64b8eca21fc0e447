"""Chat formatting by perspective rotation, with DataFrame functions only.

For every participant of a conversation the whole dialogue is rendered once, with that speaker
as assistant, the other speakers as users who carry their names, and system messages as context.
The loss mask covers what the assistant says: the content and its end mark.

Every message of every perspective gets its place in the rendered dialogue as a running total
over range-sorted rows, so a conversation of any length spreads over tasks. The text comes in
pieces: a piece holds the whole messages that start within the same stretch of ``piece``
characters. Usual conversations are one piece; none is ever gathered whole in a task.

A null or empty role speaks as ``unknown``. Null text is an empty message. Marks inside a text
are broken up, so that a text cannot open a turn. Messages go by turn (null first), ties by role
and text; repeated rows are messages of their own. A null conversation id is a conversation of
its own. A conversation of system messages alone has no participant and no row. An empty table
gives an empty result.
"""

from pyspark.sql import DataFrame, functions as F

from cellpulse.llm.text import whole
from cellpulse.operators.ordering import running_totals

SYSTEM, UNKNOWN = "system", "unknown"
END = "<|end|>\n"
PIECE = 32768


def perspectives(turns: DataFrame, conv: str = "conv_id", turn: str = "turn",
                 role: str = "role", text: str = "text") -> DataFrame:
    """One row per message and participant: its header, content and whether it is trained on."""
    said = F.coalesce(F.nullif(F.trim(F.col(f"`{role}`")), F.lit("")), F.lit(UNKNOWN))
    rows = turns.select(F.col(f"`{conv}`").alias("conv_id"), F.col(f"`{turn}`").alias("turn"),
                        said.alias("role"),
                        F.replace(whole(f"`{text}`"), F.lit("<|"), F.lit("< |")).alias("content"))
    speakers = rows.where(F.col("role") != SYSTEM).select(
        F.col("conv_id").alias("_conv"), F.col("role").alias("speaker")).distinct()
    both = rows.join(speakers, F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv")
    own = F.col("role") == F.col("speaker")
    header = (F.when(F.col("role") == SYSTEM, F.lit("<|system|>\n"))
              .when(own, F.lit("<|assistant|>\n"))
              .otherwise(F.concat(F.lit("<|user name="), F.replace(
                  F.col("role"), F.lit("|>"), F.lit("| >")), F.lit("|>\n"))))
    return both.withColumn("header", header).withColumn("trained", own)


def render(turns: DataFrame, piece: int = PIECE, **columns) -> DataFrame:
    """Rows (conv_id, speaker, piece, start, text, n_messages, spans, n_trained).

    ``start`` is the piece's place in the dialogue, ``spans`` the trained stretches of the piece
    as ``from-to`` in characters, to exclusive.
    """
    rows = perspectives(turns, **columns).withColumn(
        "size", (F.char_length("header") + F.char_length("content") + len(END)).cast("bigint"))
    placed = running_totals(rows, ["turn", "role", "content"], ["size"], ["conv_id", "speaker"])
    start = F.col("size_cum") - F.col("size")
    placed = placed.select(
        "conv_id", "speaker", F.floor(start / piece).alias("piece"), F.struct(
            start.alias("at"), F.concat("header", "content", F.lit(END)).alias("text"),
            F.char_length("header").alias("head"), F.col("size"), "trained").alias("m"))
    grouped = placed.groupBy("conv_id", "speaker", "piece").agg(
        F.array_sort(F.collect_list("m")).alias("ms"))
    first = F.element_at("ms", 1)["at"]
    own = F.filter("ms", lambda m: m["trained"])
    return grouped.select(
        "conv_id", "speaker", "piece", first.alias("start"),
        F.array_join(F.transform("ms", lambda m: m["text"]), "").alias("text"),
        F.size("ms").cast("bigint").alias("n_messages"),
        F.array_join(F.transform(own, lambda m: F.concat(
            (m["at"] - first + m["head"]).cast("string"), F.lit("-"),
            (m["at"] - first + m["size"]).cast("string"))), ",").alias("spans"),
        F.aggregate(own, F.lit(0).cast("bigint"), lambda n, m: n + m["size"] - m["head"])
        .alias("n_trained"))


RENDER_SQL = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(nullif(trim(role), ''), '{UNKNOWN}') AS role,
         replace(coalesce(text, ''), '<|', '< |') AS content
  FROM conversations),
speakers AS (SELECT DISTINCT conv_id, role AS speaker FROM turns WHERE role <> '{SYSTEM}'),
rotated AS (
  SELECT t.*, speaker, role = speaker AS trained,
         CASE WHEN role = '{SYSTEM}' THEN '<|system|>' || chr(10)
              WHEN role = speaker THEN '<|assistant|>' || chr(10)
              ELSE '<|user name=' || replace(role, '|>', '| >') || '|>' || chr(10)
         END AS header
  FROM turns t JOIN speakers s ON t.conv_id IS NOT DISTINCT FROM s.conv_id),
sized AS (
  SELECT *, length(header) + length(content) + {len(END)} AS size FROM rotated),
placed AS (
  SELECT *, (sum(size) OVER (PARTITION BY conv_id, speaker
                             ORDER BY turn NULLS FIRST, role, content
                             ROWS UNBOUNDED PRECEDING) - size)::BIGINT AS spot
  FROM sized),
pieces AS (
  SELECT *, spot // {PIECE} AS piece,
         min(spot) OVER (PARTITION BY conv_id, speaker, spot // {PIECE}) AS first
  FROM placed)
SELECT conv_id, speaker, piece, first AS start,
       string_agg(header || content || '<|end|>' || chr(10), '' ORDER BY spot) AS text,
       count(*) AS n_messages,
       coalesce(string_agg(CASE WHEN trained THEN (spot - first + length(header))::VARCHAR
                || '-' || (spot - first + size)::VARCHAR END, ',' ORDER BY spot), '') AS spans,
       sum(CASE WHEN trained THEN size - length(header) ELSE 0 END)::BIGINT AS n_trained
FROM pieces GROUP BY conv_id, speaker, piece, first
"""
