import hashlib
import random
import re
import zlib

from hypothesis import given, settings, strategies as st

from cellpulse.llm import repair as m

BLANK = " \t\n\x0b\x0c\r"
NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}


def cheapest(turns):
    """(cost, audit) by relaxing all (row, last role) until nothing changes."""
    n = len(turns)
    best = {(n, ""): (0, ""), (n, "a"): (0, "")}
    changed = True
    while changed:
        changed = False
        for i in range(n, -1, -1):
            for state in ("", "s", "u", "a"):
                steps = [(2, "I", i, NEXT[state])]
                if i < n:
                    initial, fault = turns[i]
                    steps.append((3, "D", i + 1, state))
                    if fault not in ("blank", "duplicate"):
                        stays = int(fault == "truncated")
                        steps.append((2 + stays, "R", i + 1, NEXT[state]))
                        if initial and state + initial in ("s", "u", "su", "ua", "au"):
                            steps.append((stays, "K", i + 1, initial))
                for price, edit, at, after in steps:
                    if (at, after) in best:
                        c, tail = best[at, after]
                        new = (c + price, edit + tail)
                        if (i, state) not in best or new < best[i, state]:
                            best[i, state], changed = new, True
    return best[0, ""]


def brute(rows):
    """Report per conversation, each handled alone."""
    convs = {}
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        spot = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault = zlib.crc32(spot.encode()) % 20
        kept = convs.setdefault(conv, [])
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        role = "user" if fault == 4 else role
        if fault:
            kept += [(turn, role, text)] * (2 if fault == 3 else 1)
    out = []
    for conv, kept in convs.items():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1],
                                 hashlib.sha256(r[2].encode()).hexdigest()))
        turns, seen, counts = [], set(), dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        for _, role, text in kept:
            solid = text.rstrip(BLANK)
            fault = ("blank" if not solid.strip(BLANK) else "duplicate" if (role, text) in seen
                     else "truncated" if solid[-1] not in ".!?" else None)
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            turns.append((role[:1], fault))
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
        cost, audit = cheapest(turns)
        lines, state, left = [], "", iter(kept)
        for edit in audit:
            _, role, text = next(left) if edit != "I" else (None, None, "")
            if edit == "D":
                continue
            if edit != "K":
                role = {"u": "user", "a": "assistant"}[NEXT[state]]
            state = role[0]
            lines.append(f"{role}:{text}")
        numbers = [t for t, _, _ in kept if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out.append((conv, gaps, *counts.values(), illegal, cost, audit, digest))
    return out


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))


KINDS = ("conv_id bigint, turn bigint, role string, text string, block int, row int, conv int, "
         "index int, audit string")


def frame(spark, rows, parts=5):
    return spark.createDataFrame([(*r, 1, 2, 3, 4, "z") for r in rows], KINDS).repartition(parts)


def random_rows(rng, convs, most):
    rows = []
    for conv in range(convs):
        for turn in range(rng.randrange(most)):
            role = rng.choices(["user", "assistant", "system", "tool", "", None],
                               [6, 6, 2, 1, 1, 1])[0]
            text = rng.choice(["Yes.", "No", "x?\n", " \t", "", "Why so. \x0b", None, "long. " * 3])
            rows.append((conv, turn * rng.choice([1, 1, 1, 2]) if rng.random() > .05 else None,
                         role, f"{text}{rng.choice(['', turn])}" if text else text))
    return rows


def test_reports_match_brute_force(spark):
    rng = random.Random(1)
    rows = random_rows(rng, 150, 9) + [(None, 0, "user", "Hi."), (None, 1, "assistant", "Oh."),
                                       (900, None, None, None), (901, 0, "system", "Only.")]
    # Ties: equal turns with other texts, and repeated rows.
    rows += [(902, 3, "user", f"t{i % 3}.") for i in range(7)]
    gone = next(i for i in range(1000, 9999) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    rows.append((gone, 0, "user", "dropped"))
    out = m.audit(frame(spark, rows))
    assert out.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal",
                           "cost", "audit", "repaired_sha256"]
    assert ordered(map(tuple, out.collect())) == ordered(brute(rows))
    assert m.audit(frame(spark, rows).limit(0)).count() == 0


def test_long_conversation_spreads_over_blocks(spark):
    rng = random.Random(3)
    rows = []
    for turn in range(700):
        role = "user" if turn % 2 else "assistant"
        if rng.random() < .1:
            role = rng.choice(["system", "user", "assistant"])
        rows.append((7, turn, role, rng.choice([f"t{turn}.", f"t{turn}.", f"o{turn}", "same."])))
    rows += [(8, t, "system", f"s{t}") for t in range(200)]
    rows.append((9, 0, "user", "é " * 200_000 + "."))
    got = ordered(map(tuple, m.audit(frame(spark, rows, 7)).collect()))
    assert got == ordered(brute(rows))


@settings(max_examples=200, deadline=None)
@given(st.text("suaoSUAOx", max_size=14), st.integers(0, 3), st.lists(st.integers(0, 9), min_size=4,
                                                                     max_size=4))
def test_search_finds_the_cheapest_cost(turns, entry, to_go):
    edits, state = m.search(turns, entry, to_go)
    costs = m.transfer(turns)[4 * entry:4 * entry + 4]
    price = sum({"D": 3, "I": 2, "K": 0, "R": 2}[e] for e in edits)
    stayed = [e for e in edits if e != "I"]
    assert len(stayed) == len(turns)
    price += sum(t.isupper() for t, e in zip(turns, stayed) if e != "D")
    assert price + to_go[state] == min(c + g for c, g in zip(costs, to_go) if c >= 0)
