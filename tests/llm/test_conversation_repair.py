import hashlib
import itertools
import random
import re
import zlib

import pytest

from costlens.llm import queries
from costlens.llm.conversation_repair import cheapest_edits, damage, repair, repaired_messages, rows_of

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string, cost string, audit string"
WELL_FORMED = re.compile("(s?(ua)+)?")


def all_repairs(rows, most_inserts):
    """(cost, audit, messages) of every way to edit ``rows`` (role, text, fault)."""
    for edits in itertools.product("DKua", repeat=len(rows)):
        for places in itertools.product(range(most_inserts + 1), repeat=len(rows) + 1):
            if sum(places) > most_inserts:
                continue
            for names in itertools.product(("user", "assistant"), repeat=sum(places)):
                new, cost, audit, out = iter(names), 0, "", []
                for (role, text, fault), edit, n in zip([*rows, (None, None, None)], [*edits, ""], places):
                    for _ in range(n):
                        out.append((next(new), ""))
                        cost, audit = cost + 3, audit + "I"
                    if edit == "D":
                        cost, audit = cost + 4, audit + "D"
                    elif edit:
                        if fault in ("blank", "duplicate"):
                            break
                        cost += 3 * (fault == "truncated") + 3 * (edit != "K")
                        audit += "K" if edit == "K" else "R"
                        out.append(({"u": "user", "a": "assistant"}.get(edit, role), text))
                else:
                    if WELL_FORMED.fullmatch("".join(r[:1] or "-" for r, _ in out)):
                        yield cost, audit, out


def by_places(rows):
    """Cheapest (cost, audit) by dynamic programming over rows and automaton places."""
    start, after = 0, {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}

    def closed(best):
        for _ in range(4):
            for q, (cost, audit) in list(best.items()):
                for initial in "ua":
                    if (q, initial) in after:
                        to, new = after[q, initial], (cost + 3, audit + "I")
                        best[to] = min(best.get(to, new), new)
        return best

    best = closed({start: (0, "")})
    for role, _, fault in rows:
        step = {}
        for q, (cost, audit) in best.items():
            moves = [(q, 4, "D")]
            if fault not in ("blank", "duplicate"):
                more = 3 * (fault == "truncated")
                moves += [(after[q, i], more, "K") for i in [role[:1]] if (q, i) in after]
                moves += [(after[q, i], more + 3, "R") for i in "ua" if (q, i) in after]
            for to, c, letter in moves:
                new = (cost + c, audit + letter)
                step[to] = min(step.get(to, new), new)
        best = closed(step)
    return min(best[q] for q in (0, 3) if q in best)


def codes(rows):
    kind = {None: 0, "truncated": 1, "blank": 2, "duplicate": 2}
    return bytes(4 * kind[f] + "sua".find(r[:1] or "-") % 4 for r, _, f in rows)


def test_small_conversations_equal_every_possible_repair():
    rng = random.Random(11)
    for _ in range(60):
        rows = [(rng.choice(["system", "user", "assistant", "tool"]), "x", rng.choice([None, None, "truncated", "blank"])) for _ in range(rng.randrange(4))]
        want = min((cost, audit) for cost, audit, _ in all_repairs(rows, 3))
        assert cheapest_edits(codes(rows)) == want == by_places(rows)


def test_long_conversations_in_blocks_equal_dynamic_programming():
    rng = random.Random(5)
    for n, block in [(0, 3), (1, 1), (7, 1), (40, 3), (200, 64), (400, 16), (1500, 64)] + [(rng.randrange(30), rng.randrange(1, 9)) for _ in range(150)]:
        rows = [(rng.choice(["system", "user", "assistant", "user", "assistant", "tool"]), "x", rng.choice([None] * 6 + ["truncated", "blank"])) for _ in range(n)]
        assert cheapest_edits(codes(rows), block) == by_places(rows)


def test_bad_long_conversations_take_time_in_proportion():
    for row in (("system", "", None), ("user", "", "truncated"), ("tool", "", None)):
        cost, audit = cheapest_edits(codes([row] * 20_000))
        assert len(audit.replace("I", "")) == 20_000 and cost > 0


def expected(table, damaged=True):
    """The contract in plain loops, from (conv_id, turn, role, text) rows."""
    out = {}
    for conv in {r[0] for r in table}:
        rows = []
        for _, turn, role, text in [r for r in table if r[0] == conv]:
            role, text = " " if role is None else role, " " if text is None else text
            how = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20 if damaged else 9
            if how == 0:
                continue
            text = "" if how == 1 else re.sub("[.!?]", "", text) if how == 2 else text
            rows += [(turn, "user" if how == 4 else role, text)] * (2 if how == 3 else 1)
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))
        turns = [t for t, _, _ in rows if t is not None]
        seen, faults = set(), []
        for _, role, text in rows:
            black = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = "blank" if not black else "duplicate" if (role, text) in seen else "truncated" if black[-1] not in ".!?" else None
            seen.add((role, text))
            faults.append(fault)
        cost, audit = by_places([(r, t, f) for (_, r, t), f in zip(rows, faults)])
        messages, at, left = [], iter(rows), ""
        for edit in audit:
            place = "".join(r[:1] for r, _ in messages)
            role, text = ("assistant" if place.endswith("u") else "user", "") if edit == "I" else next(at)[1:]
            if edit == "R":
                role = "assistant" if place.endswith("u") else "user"
            if edit != "D":
                messages.append((role, text))
        assert WELL_FORMED.fullmatch("".join(r[:1] for r, _ in messages))
        initials = [r[:1] for _, r, _ in rows]
        out[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit, messages,
        )
    return out


def check(got, want):
    assert len(got) == len(want)
    for r in got:
        *counts, audit, messages = want[r.conv_id]
        text = "\n".join(f"{role}:{text}" for role, text in messages)
        assert (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit) == (*counts, audit)
        assert r.repaired_sha256 == hashlib.sha256(text.encode()).hexdigest()


def odd_table():
    rng = random.Random(3)
    texts = ["Hi.", "Yes!", "no", "", " \t\n", "what?", "end. \n", "é", " ", "...", None, "x\ny.", "a:b"]
    roles = ["system", "user", "assistant", "tool", "", None, "User", "agent"]
    rows = [(c, rng.choice([None, *range(12)]), rng.choice(roles), rng.choice(texts)) for c in range(200) for _ in range(rng.randrange(1, 12))]
    rows += [(None, None, None, None), (None, 1, "user", "a."), (-5, 1 << 40, "user", "a."), (-5, -(1 << 40), "user", "a.")]
    rows += [(777, t % 9, "user", "same.") for t in range(300)] + [(778, 3, "assistant", "long " * 400_000)]
    return rows


def test_damaged_tables_equal_plain_loops(spark):
    df = spark.createDataFrame([(*r, "x", "y") for r in odd_table()], SCHEMA).repartition(5)
    check(repair(damage(df)).collect(), expected(odd_table()))


def test_rows_as_they_are_and_the_repaired_messages(spark):
    table = odd_table()
    rows = rows_of(spark.createDataFrame([(*r, "x", "y") for r in table], SCHEMA).repartition(5))
    want = expected(table, damaged=False)
    check(repair(rows).collect(), want)
    got = {}
    for r in sorted(repaired_messages(rows).collect(), key=lambda r: r.position):
        got.setdefault(r.conv_id, []).append((r.role, r.text))
        assert r.position == len(got[r.conv_id])
    assert got == {conv: w[-1] for conv, w in want.items() if w[-1]}


def test_conversations_without_rows_left(spark):
    ids = [c for c in range(400) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    got = repair(damage(spark.createDataFrame([(c, 0, "user", "a.", "x", "y") for c in ids], SCHEMA))).collect()
    assert len(got) == len(ids) > 5
    for r in got:
        assert (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit) == (0, 0, 0, 0, 0, 0, "")
        assert r.repaired_sha256 == hashlib.sha256(b"").hexdigest()


def test_empty_table(spark):
    assert repair(damage(spark.createDataFrame([], SCHEMA))).collect() == []
    assert repaired_messages(rows_of(spark.createDataFrame([], SCHEMA))).collect() == []


@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.1"])
def test_query_equals_plain_loops_on_the_whole_table(spark, sf):
    table = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    check(queries.op11_conversation_repair(spark, sf).collect(), expected(table))
