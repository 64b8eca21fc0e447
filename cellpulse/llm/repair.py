"""Repair of conversation structure by iterative-deepening A*.

A conversation is legal if its roles' initials read ``(s?(ua)+)?``. Edits: Keep costs 0, Rerole
to user or assistant 2, Delete 3, Insert of an empty user or assistant turn 2; a truncated turn
that stays adds 1. Blank and duplicate turns must be deleted. The repair is the cheapest list of
edits, and among those the one whose initials are least in ASCII order.

1. Turns are ordered across tasks (range partitions by conversation and turn), so a conversation
   of any size spreads; the first holder of a (role, text) comes from an aggregate. Turns are cut
   into blocks of ``BLOCK``.
2. Each block gets its cheapest cost from every state of the grammar to every other. Read from
   the end, these give the cost to go at each block's end, with four numbers held at a time.
3. *Search.* In each block, from each state in which it may be entered, depth-first search tries
   edits in the order D, I, K, R under a cost bound that grows by one; a node fails if its cost,
   the forced costs of the rows left and the least cost to go pass the bound. A table holds the
   largest budget with which a (row, state) failed. The first accepting path is the answer: in
   that order it is the least in ASCII. An insert belongs to the block of the row it precedes, so
   no block's edits are a prefix of another choice and the blocks' answers add up.
4. Read from the start, the exit state of a block picks the answer of the next one.

Hashing a repaired conversation is sequential: its turns pass one task in order, as a stream that
holds the hash and the edits' initials, not the texts.

Null role and text count as one space. Turns sort nulls first, then by role and by the text's
hash; equal rows are duplicates. A role whose first character is not s, u or a, or an empty role,
cannot be kept. Null conversation ids are one conversation. A conversation without turns needs
no edit; an empty table gives an empty result. Other columns are not read.
"""

import hashlib

from pyspark.sql import DataFrame, functions as F

from cellpulse.operators.ordering import row_index
from cellpulse.session import materialise

BLOCK = 64
START, SYSTEM, USER, ASSISTANT = range(4)   # what was read last
CLOSING = (0, 4, 2, 0)                      # cost of the inserts that end a conversation
DELETE, INSERT, REROLE = 3, 2, 2
# One letter per turn: initial s, u, a or o (other), upper case if truncated, x if it must go.
_KEEPS = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER,
          (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
_LEGAL = {"su", "ua", "au"}


def _next(state: int) -> int:
    """State after a user or assistant turn where the grammar wants one."""
    return ASSISTANT if state == USER else USER


def _kept(state: int, turn: str):
    return None if turn == "x" else _KEEPS.get((state, turn.lower()))


def transfer(turns: str) -> list:
    """Cheapest cost of a block's edits by state before and after it, 16 numbers."""
    out = []
    for entry in range(4):
        cost = [None] * 4
        cost[entry] = 0
        for turn in turns:
            for _ in range(3):      # inserts before the turn
                for state in range(4):
                    if cost[state] is not None:
                        after, price = _next(state), cost[state] + INSERT
                        if cost[after] is None or price < cost[after]:
                            cost[after] = price
            new = [None if c is None else c + DELETE for c in cost]
            if turn != "x":
                stays = int(turn.isupper())
                for state, c in enumerate(cost):
                    if c is not None:
                        kept = _kept(state, turn)
                        for after, price in ((kept, c + stays),
                                             (_next(state), c + stays + REROLE)):
                            if after is not None and (new[after] is None or price < new[after]):
                                new[after] = price
            cost = new
        out += [-1 if c is None else c for c in cost]
    return out


def search(turns: str, entry: int, to_go: list) -> tuple:
    """Cheapest edits of a block, least in ASCII order, and the state after them."""
    n, least = len(turns), min(to_go)
    forced = [0] * (n + 1)
    for i in range(n - 1, -1, -1):
        forced[i] = forced[i + 1] + (DELETE if turns[i] == "x" else int(turns[i].isupper()))
    failed = {}

    def walk(i, state, budget):
        if budget < forced[i] + least or failed.get((i, state), -1) >= budget:
            return None
        if i == n:
            return ("", state) if to_go[state] <= budget else None
        turn = turns[i]
        stays = int(turn.isupper())
        kept = _kept(state, turn)
        steps = [("D", i + 1, state, DELETE), ("I", i, _next(state), INSERT)]
        if kept is not None:
            steps.append(("K", i + 1, kept, stays))
        if turn != "x":
            steps.append(("R", i + 1, _next(state), REROLE + stays))
        for edit, at, after, price in steps:
            found = walk(at, after, budget - price)
            if found:
                return edit + found[0], found[1]
        failed[i, state] = max(budget, failed.get((i, state), -1))
        return None
    bound = forced[0] + least
    while True:
        found = walk(0, entry, bound)
        if found:
            return found
        bound += 1


def damage(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
           text: str = "text") -> DataFrame:
    """Rows (conv, turn, role, text) with the planned faults put in; ``conv`` is a text key."""
    given = rows.select(F.col(f"`{conv}`").cast("string").alias("c"),
                        F.col(f"`{turn}`").cast("bigint").alias("turn"),
                        *[F.coalesce(F.col(f"`{n}`").cast("string"), F.lit(" ")).alias(a)
                          for n, a in ((role, "role"), (text, "text"))])
    spot = F.concat(F.coalesce("c", F.lit(" ")), F.lit(":"),
                    F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    fault = F.crc32(spot.cast("binary")) % 20
    body = (F.when(fault == 1, "").when(fault == 2, F.translate("text", ".!?", ""))
            .otherwise(F.col("text")))
    who = F.when(fault == 4, "user").otherwise(F.col("role"))
    copies = F.when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return given.where(fault != 0).select(
        _conv_key(F.col("c")).alias("conv"), "turn", who.alias("role"), body.alias("text"),
        F.explode(copies).alias("copy")).drop("copy")


def _conv_key(conv):
    return F.coalesce(F.concat(F.lit("="), conv.cast("string")), F.lit(""))


def _turns(rows: DataFrame) -> tuple:
    """Stored ordered rows (conv, row, role, text), and their slim form with ``turn`` letters.

    The slim rows hold (conv, row, index, turn, letter, fault) with ``index`` from 1.
    """
    order = ["conv", "turn", "role", "digest"]
    stored = materialise(
        rows.withColumn("digest", F.sha2(F.col("text").cast("binary"), 256))
        .repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("row", F.monotonically_increasing_id()), "turns")
    solid = F.rtrim(F.translate("text", "\t\n\x0b\x0c\r", " " * 5))
    slim = materialise(stored.select(
        "conv", "row", "turn", "role", "digest", (F.trim(solid) == "").alias("empty"),
        (~F.substring(solid, -1, 1).isin(".", "!", "?")).alias("open")), "slim-turns")
    first = slim.groupBy("conv", "role", "digest").agg(F.min("row").alias("row")).select(
        "row", F.lit(True).alias("new"))
    marked = slim.join(first, "row", "left")
    fault = (F.when(F.col("empty"), "blank").when(F.col("new").isNull(), "duplicate")
             .when(F.col("open"), "truncated"))
    initial = F.substring("role", 1, 1)
    kind = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    marked = marked.select(
        "conv", "row", "turn", kind.alias("initial"), fault.alias("fault"),
        F.when(fault.isin("blank", "duplicate"), "x").when(fault == "truncated", F.upper(kind))
        .otherwise(kind).alias("letter"))
    return stored, row_index(marked, ["row"], ["conv"], "index")


def _blocks(turns: DataFrame) -> DataFrame:
    """Stored blocks (conv, block, rows, turns, initials, costs)."""
    some = F.sort_array(F.collect_list(F.struct("index", "row", "letter", "initial"))).alias("s")
    cut = F.floor((F.col("index") - 1) / BLOCK).alias("block")
    parts = turns.groupBy("conv", cut).agg(some).select(
        "conv", "block", F.expr("transform(s, x -> x.row)").alias("rows"),
        F.expr("array_join(transform(s, x -> x.letter), '')").alias("turns"),
        F.expr("array_join(transform(s, x -> x.initial), '')").alias("initials"))

    def run(batches):
        import pyarrow as pa
        for batch in batches:
            costs = [transfer(t) for t in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(costs, pa.list_(pa.int64()))],
                names=["conv", "block", "rows", "turns", "initials", "costs"])
    return materialise(parts.mapInArrow(
        run, "conv string, block bigint, rows array<bigint>, turns string, initials string, "
             "costs array<bigint>"), "blocks")


def _answers(blocks: DataFrame) -> DataFrame:
    """Stored (conv, block, last, cost, edits, exits): the edits for every state of entry.

    ``last`` marks a conversation's last block; ``cost`` is the whole cost, on its first one.
    """
    def costs_to_go(batches):
        import pyarrow as pa
        conv, ahead = None, None
        for batch in batches:
            out = []
            for name, block, costs in zip(*(batch.column(i).to_pylist() for i in range(3))):
                last = name != conv
                if last:
                    conv, ahead = name, list(CLOSING)
                here = [min(c + ahead[after] for after, c in enumerate(costs[4 * s:4 * s + 4])
                            if c >= 0) for s in range(4)]
                out.append((name, block, last, ahead, here[START] if block == 0 else None))
                ahead = here
            kinds = [pa.string(), pa.int64(), pa.bool_(), pa.list_(pa.int64()), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)],
                names=["conv", "block", "last", "to_go", "cost"])
    ahead = (blocks.select("conv", "block", "costs").repartition("conv")
             .sortWithinPartitions("conv", F.desc("block"))
             .mapInArrow(costs_to_go, "conv string, block bigint, last boolean, "
                                      "to_go array<bigint>, cost bigint"))

    def solve(batches):
        import pyarrow as pa
        for batch in batches:
            edits, exits = [], []
            for block, to_go, turns in zip(*(batch.column(i).to_pylist() for i in (1, 4, 5))):
                # A conversation is entered at its start only in its first block.
                found = [search(turns, s, to_go) if s == START or block else ("", START)
                         for s in range(4)]
                edits.append([f[0] for f in found])
                exits.append([f[1] for f in found])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array(edits, pa.list_(pa.string())),
                 pa.array(exits, pa.list_(pa.int32()))],
                names=["conv", "block", "last", "cost", "edits", "exits"])
    both = blocks.select("conv", "block", "turns").join(ahead, ["conv", "block"])
    return materialise(
        both.select("conv", "block", "last", "cost", "to_go", "turns").mapInArrow(
            solve, "conv string, block bigint, last boolean, cost bigint, edits array<string>, "
                   "exits array<int>"), "answers")


def _chosen(blocks: DataFrame, answers: DataFrame) -> DataFrame:
    """Stored (conv, block, rows, edits, illegal, cost) with the edits that the repair makes."""
    def run(batches):
        import pyarrow as pa
        conv, state, before = None, START, ""
        for batch in batches:
            out = []
            for name, block, last, cost, edits, exits, initials, rows in zip(
                    *(c.to_pylist() for c in batch.columns)):
                if name != conv:
                    conv, state, before = name, START, ""
                chain = before + initials
                illegal = sum(chain[i:i + 2] not in _LEGAL for i in range(len(chain) - 1))
                chosen, state, before = edits[state], exits[state], initials[-1]
                if last:
                    chosen += "I" * (CLOSING[state] // INSERT)
                out.append((name, block, rows, chosen, illegal, cost))
            kinds = [pa.string(), pa.int64(), pa.list_(pa.int64()), pa.string(), pa.int64(),
                     pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)],
                names=["conv", "block", "rows", "edits", "illegal", "cost"])
    joined = answers.join(blocks.select("conv", "block", "initials", "rows"), ["conv", "block"])
    return materialise(
        joined.repartition("conv").sortWithinPartitions("conv", "block").mapInArrow(
            run, "conv string, block bigint, rows array<bigint>, edits string, illegal bigint, "
                 "cost bigint"), "chosen")


def repaired_turns(stored: DataFrame, chosen: DataFrame) -> DataFrame:
    """Each turn with its edits: (conv, row, edits, role, text) sorted within conversations.

    ``edits`` holds the inserts before the turn, its own edit and, on the last turn, the inserts
    after it. Turns and edits meet by sorting, in one shuffle.
    """
    parts = F.expr("regexp_extract_all(edits, 'I*[DKR](I+$)?', 0)")
    # Inserts close a conversation only at its end; a block's edits end with a turn's.
    edits = chosen.select("conv", F.explode(F.arrays_zip(F.col("rows").alias("row"),
                                                         parts.alias("part"))).alias("z"))
    edits = edits.select("conv", F.col("z.row").alias("row"), F.lit(0).alias("kind"),
                         F.col("z.part").alias("edits"), F.lit(None).cast("string").alias("role"),
                         F.lit(None).cast("string").alias("text"))
    texts = stored.select("conv", "row", F.lit(1).alias("kind"),
                          F.lit(None).cast("string").alias("edits"), "role", "text")
    return edits.union(texts).repartition("conv").sortWithinPartitions("conv", "row", "kind")


def _digests(merged: DataFrame) -> DataFrame:
    """(conv, audit, sha256) of repaired conversations, read as a stream."""
    def run(batches):
        import pyarrow as pa
        conv, state, audit, digest, part = None, START, [], None, ""

        def as_batch(rows):
            return pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], pa.string()) for i in range(3)],
                names=["conv", "audit", "repaired_sha256"])

        def add(role, body):
            if audit_lines[0]:
                digest.update(b"\n")
            audit_lines[0] += 1
            digest.update(f"{role}:{body}".encode("utf-8", "replace"))
        audit_lines = [0]
        for batch in batches:
            out = []
            for name, kind, edits, role, text in zip(
                    *(batch.column(i).to_pylist() for i in (0, 2, 3, 4, 5))):
                if name != conv:
                    if conv is not None:
                        out.append((conv, "".join(audit), digest.hexdigest()))
                    conv, state, audit, digest = name, START, [], hashlib.sha256()
                    audit_lines[0] = 0
                if kind == 0:
                    part = edits
                    continue
                audit.append(part)
                for edit in part:
                    if edit == "D":
                        continue
                    if edit == "K":
                        add(role, text)
                        state = _KEEPS[state, role[:1]]
                        continue
                    state = _next(state)
                    add("user" if state == USER else "assistant", text if edit == "R" else "")
            yield as_batch(out)
        if conv is not None:
            yield as_batch([(conv, "".join(audit), digest.hexdigest())])
    return merged.mapInArrow(run, "conv string, audit string, repaired_sha256 string")


def repair(rows: DataFrame) -> tuple:
    """Repair rows (conv, turn, role, text).

    Returns the report (conv, faults, cost, audit, hash) of every conversation with a turn, and
    the turns with their edits.
    """
    stored, turns = _turns(rows.select("conv", "turn", "role", "text"))
    turns = materialise(turns, "turn-letters")
    blocks = _blocks(turns)
    chosen = _chosen(blocks, _answers(blocks))
    merged = repaired_turns(stored, chosen)
    faults = ["blank", "duplicate", "truncated"]
    per_turn = turns.groupBy("conv", "turn").agg(
        *[F.count_if(F.col("fault") == f).alias(f) for f in faults])
    counts = per_turn.groupBy("conv").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps"),
        *[F.sum(f).alias(f) for f in faults])
    costs = chosen.groupBy("conv").agg(F.sum("illegal").alias("illegal"),
                                       F.max("cost").alias("cost"))
    return counts.join(costs, "conv").join(_digests(merged), "conv"), merged


def audit(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
          text: str = "text") -> DataFrame:
    """The repair report of every conversation after the planned damage."""
    report, _ = repair(damage(rows, conv, turn, role, text))
    every = rows.select(F.col(f"`{conv}`").alias("conv_id")).distinct().withColumn(
        "conv", _conv_key(F.col("conv_id")))
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return every.join(report, "conv", "left").select(
        "conv_id", *[F.coalesce(n, F.lit(0)).cast("bigint").alias(n) for n in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256))
        .alias("repaired_sha256"))
