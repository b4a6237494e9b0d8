"""Conversation repair against a plain search, on hard conversations and on conversations cut into pieces."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from boxoffice.llm import turn_repair
from boxoffice.llm.queries import op12_turn_repair
from boxoffice.llm.turn_repair import damaged, digests, repair, solve
from conftest import SF

ROWS = "conv_id long, turn long, role string, text string"
SPACE = " \t\n\x0b\x0c\r"


def brute_edits(symbols):
    """Every edit string, from the front: (cost, initials) least for each sequence state, as plain tuples.

    ``symbols`` are (initial, must go, truncated).
    """
    state_of = {"": "", "s": "s", "u": "u", "a": "a"}
    states = {"": (0, "")}

    def put(found, state, way):
        if state not in found or way < found[state]:
            found[state] = way

    def follows(state, letter):
        return letter == "s" and state == "" or letter == "u" and state in ("", "s", "a") or letter == "a" and state == "u"

    def inserted(found):
        for _ in range(3):
            for state, (cost, said) in list(found.items()):
                for letter in "ua":
                    if follows(state, letter):
                        put(found, letter, (cost + 5, said + "I"))
        return found

    for initial, gone, cut in symbols:
        before, states = inserted(dict(states)), {}
        for state, (cost, said) in before.items():
            put(states, state, (cost + 2, said + "D"))
            if not gone:
                if initial in state_of and initial and follows(state, initial):
                    put(states, initial, (cost + 5 * cut, said + "K"))
                for letter in "ua":
                    if follows(state, letter):
                        put(states, letter, (cost + 1 + 5 * cut, said + "R"))
    final = inserted(dict(states))
    return min(way for state, way in final.items() if state in ("", "a"))


def brute(rows):
    """The result row of one conversation, from its (turn, role, text) rows after damage."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(r[2].encode()).hexdigest()))
    seen, symbols, counts = set(), [], [0, 0, 0]
    for _, role, text in rows:
        ended = text.rstrip(SPACE)
        fault = 0 if not ended else 1 if (role, text) in seen else 2 if ended[-1] not in ".!?" else None
        seen.add((role, text))
        if fault is not None:
            counts[fault] += 1
        symbols.append((role[:1], fault in (0, 1), fault == 2))
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
    turns = [r[0] for r in rows if r[0] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    cost, audit = brute_edits(symbols)
    kept = len(audit) - audit.count("D")
    lines, at = [], 0
    for edit in audit:
        row = None if edit == "I" else rows[at]
        at += edit != "I"
        if edit != "D":
            role = row[1] if edit == "K" else ("user", "assistant")[(len(lines) - kept % 2) % 2]
            lines.append(f"{role}:{row[2] if row else ''}")
    assert re.fullmatch("(s?(ua)+)?", "".join(line[:1] for line in lines))
    return gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()


def test_solve_equals_a_plain_search():
    rng = random.Random(5)
    for _ in range(600):
        runs = [(rng.randrange(9), rng.choice([1, 1, 2, 3, 7, 20])) for _ in range(rng.randrange(6))]
        symbols = [((*turn_repair.INITIALS, "x")[s // 2] if s < 8 else "u", s == 8, s % 2 == 1) for s, n in runs for _ in range(n)]
        cost, audit, state = solve(runs)
        assert (cost, audit + ("", "II", "I", "")[state]) == brute_edits(symbols)


def test_long_runs_cost_what_their_powers_say():
    cost, audit, _ = solve([(0, 1), (8, 300_000), (4, 1)])
    assert (cost, audit) == (600_000, "K" + "D" * 300_000 + "K")
    cost, audit, _ = solve([(0, 100_001)])
    assert (cost, audit[-3:]) == brute_edits([("u", False, False)] * 11)[:1] + ("RKR",) or cost == 50_002


def random_rows(rng, conv, n):
    roles = ["user", "assistant", "system", "tool", "", "  ", None, "Ünder", "assistants"]
    texts = ["a.", "b?", "b", " ", "", None, "c!\n", "d \x0b", "é.", "x" * 50]
    weights = [9, 9, 3, 1, 1, 1, 1, 1, 1]
    return [
        (conv, rng.choice([None, *range(12)]), rng.choices(roles, weights)[0], rng.choice(texts)) for _ in range(n)
    ]


def after_damage(rows):
    found = {}
    for conv, turn, role, text in rows:
        there = found.setdefault(conv, [])
        role, text = (" " if v is None else v for v in (role, text))
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault = zlib.crc32(key.encode()) % 20
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        there += [(turn, "user" if fault == 4 else role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    return found


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def check(spark, rows, frame):
    found = digests(repair(damaged(frame))).collect()
    expected = {conv: brute(left) for conv, left in after_damage(rows).items()}
    assert {r.conv_id: tuple(r[name] for name in COLUMNS) for r in found} == expected
    assert len(found) == len(expected)


@pytest.mark.parametrize("small", [False, True])
def test_repair_equals_brute_force(spark, monkeypatch, small):
    rng = random.Random(3)
    rows = [row for conv in [None, *range(60)] for row in random_rows(rng, conv, rng.choice([1, 2, 5, 9, 40]))]
    rows += rows[:100] + [(900, 1, "user", None)]  # repeated rows
    if small:  # nothing may be broadcast
        monkeypatch.setattr(turn_repair, "BROADCAST_ROWS", 0)
    check(spark, rows, spark.createDataFrame(rows, ROWS).repartition(5))


def test_a_conversation_with_most_rows_is_repaired_in_pieces(spark):
    rng = random.Random(4)
    rows = [(7, turn, rng.choice(["user", "assistant", "system"]), f"{rng.randrange(6000)}.") for turn in range(9000)]
    rows += [(conv, turn, ("user", "assistant")[turn % 2], f"{turn}.") for conv in (1, 8, 9) for turn in range(8)]
    frame = spark.createDataFrame(rows, ROWS)
    pieces = repair(damaged(frame))
    assert pieces.where("conv_id = 7").count() >= 3 and pieces.where("conv_id = 7 AND whole").count() == 0
    check(spark, rows, frame)


def test_repaired_turns_keep_their_texts(spark):
    rows = [(1, 1, "system", "s."), (1, 2, "user", "q?"), (1, 3, "user", "r?"), (1, 4, "assistant", " "), (2, 1, "bot", "x.")]
    found = {r.conv_id: r for r in repair(spark.createDataFrame(rows, ROWS)).collect()}
    assert [tuple(t) for t in found[1].turns] == [("system", "s."), ("user", "q?"), ("assistant", "r?")]
    assert (found[1].audit, found[1].cost) == ("KKRD", 3)
    assert (found[2].audit, found[2].turns, found[2].cost) == ("D", [], 2)


def test_empty_tables_other_names_and_dropped_conversations(spark):
    assert digests(repair(damaged(spark.createDataFrame([], ROWS)))).count() == 0
    clash = "piece long, whole string, digest string, part int, times int, audit string, conv string"
    rows = [(5, 1, "user", "hi.", 1, "w", "d", 2, 3, "a", "c"), (5, 2, "assistant", "yes.", 1, "w", "d", 2, 3, "a", "c")]
    found = repair(spark.createDataFrame(rows, f"{ROWS}, {clash}")).collect()
    assert [(r.audit, r.whole) for r in found] == [("KK", True)]
    gone = next(t for t in range(1000) if zlib.crc32(f"6:{t}".encode()) % 20 == 0)
    found = digests(repair(damaged(spark.createDataFrame([(6, gone, "user", "x.")], ROWS)))).collect()
    assert [tuple(r[n] for n in COLUMNS) for r in found] == [(0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())]


def test_query_equals_brute_force_on_the_small_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    expected = {conv: brute(left) for conv, left in after_damage(rows).items()}
    found = op12_turn_repair(spark, SF).collect()
    assert {r.conv_id: tuple(r[name] for name in COLUMNS) for r in found} == expected


def test_texts_that_repeat_are_found_once_per_conversation(spark):
    rows = [(1, t, "user", "same.") for t in range(40)] + [(2, 0, "user", "same.")]
    found = digests(repair(spark.createDataFrame(rows, ROWS))).select("conv_id", "duplicate").orderBy("conv_id").collect()
    assert [tuple(r) for r in found] == [(1, 39), (2, 0)]
    assert repair(spark.createDataFrame(rows, ROWS)).agg(F.count("*")).first()[0] >= 2
