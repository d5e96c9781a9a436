import hashlib
import itertools
import zlib

import duckdb
import pytest

from chaintally.llm import conversation_repair as cr

SCHEMA = "conv_id long, turn long, role string, text string, cost long, gone string"
STEPS = {("E", "s"): "S", ("E", "u"): "U", ("S", "u"): "U", ("U", "a"): "A", ("A", "u"): "U"}


def cheapest(turns):
    """(cost, audit) over all edits, by exhaustive search with the costs of the states reached so far."""
    best = {"E": (0, "")}

    def inserted(states):
        out = dict(states)
        for _ in range(2):
            for (a, i), b in STEPS.items():
                if a in out and i != "s":
                    new = (out[a][0] + 2, out[a][1] + "I")
                    out[b] = min(out.get(b, new), new)
        return out

    for initial, goes, cut in turns:
        after = {}
        for state, (cost, audit) in inserted(best).items():
            moves = [(state, 3, "D")]
            if not goes:
                moves += [(b, cut + 2 * (i != initial), "K" if i == initial else "R")
                          for (a, i), b in STEPS.items() if a == state and (i == initial or i != "s")]
            for b, more, letter in moves:
                after[b] = min(after.get(b, (1 << 40, "")), (cost + more, audit + letter))
        best = after
    return min(v for k, v in inserted(best).items() if k in "EA")


def plain(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        kept = []
        for _, turn, role, text in (r[:4] for r in rows if r[0] == conv):
            kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
            role, text = " " if role is None else role, " " if text is None else text
            if kind:
                text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
                kept += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).digest()))
        turns, seen, counts = [], set(), {"b": 0, "d": 0, "t": 0}
        for _, role, text in kept:
            solid = text.strip(" \t\n\v\f\r")
            fault = "b" if not solid else "d" if (role, text) in seen else "t" if solid[-1] not in ".!?" else ""
            seen.add((role, text))
            counts[fault or "b"] += bool(fault)
            turns.append((role[:1], fault in ("b", "d") and bool(fault), fault == "t"))
        cost, audit = cheapest(turns)
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in itertools.pairwise(turns))
        numbers = [t for t, _, _ in kept if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        repaired, at, state = [], iter(kept), "E"
        for letter in audit:
            role, text = ("user" if state != "U" else "assistant"), ""
            if letter != "I":
                _, own, text = next(at)
                role = own if letter == "K" else role
            if letter != "D":
                repaired.append(f"{role}:{text}")
                state = STEPS[state, role[:1]]
        out[conv] = (gaps, counts["b"], counts["d"], counts["t"], illegal, cost, audit,
                     hashlib.sha256("\n".join(repaired).encode()).hexdigest())
    return out


def found(df):
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return {r["conv_id"]: tuple(r[n] for n in names) for r in cr.repair(cr.damage(df)).collect()}


ROLES = ["user", "assistant", "system", "tool", None, "", "ünknown"]
TEXTS = ["Yes.", "No!", "cut off", "", None, " \t\n", "ends here?  ", "x"]


def random_rows(n_conversations, longest, seed):
    import random

    rng = random.Random(seed)
    return [(c, t if rng.random() < 0.9 else rng.choice([None, 3, 90]), rng.choice(ROLES[:2] * 3 + ROLES), rng.choice(TEXTS[:2] * 4 + TEXTS) if rng.random() < 0.3
             else f"turn {rng.random()}.", 0, "x") for c in range(n_conversations) for t in range(rng.randint(1, longest))]


def test_matches_exhaustive_search(spark):
    rows = random_rows(150, 9, 1) + [(None, t, "user", "hello.", 0, None) for t in (1, 2, None)] + [(-5, None, None, None, 0, None)] * 3
    assert found(spark.createDataFrame(rows, SCHEMA).repartition(3)) == plain(rows)


@pytest.mark.parametrize("segment", [1, 3, 64])
def test_segments_join_exactly(monkeypatch, segment):
    import random

    monkeypatch.setattr(cr, "SEGMENT", segment)
    rng = random.Random(segment)
    for _ in range(200):
        turns = [(rng.choice("suuuaaat "), rng.random() < 0.15, rng.random() < 0.15) for _ in range(rng.randint(0, 14))]
        turns = [(i, goes, cut and not goes) for i, goes, cut in turns]
        repair = cr.Repair()
        for t in turns:
            repair.add(t)
        assert repair.end() == cheapest(turns), turns


def test_bands_keep_the_least_cost():
    """A table filled in the incumbent's band tells what the whole table tells."""
    import random

    rng = random.Random(5)
    for _ in range(300):
        turns = tuple((rng.choice("suua"), rng.random() < 0.2, False) for _ in range(rng.randint(0, 8)))
        goal = cr.target(cr.NOTHING, rng.random() < 0.3, rng.randint(0, 9))
        whole = cr.align(turns, goal, 1000, True)
        if whole[0] < cr.FAR:
            assert cr.align(turns, goal, whole[0], True) == whole
            assert cr.align(turns, goal, whole[0] - 1, True) == (cr.FAR, "")


def test_one_long_conversation(spark):
    rows = random_rows(1, 2000, 3)[:2000] + random_rows(1, 2000, 4)
    assert found(spark.createDataFrame(rows, SCHEMA).repartition(4)) == plain(rows)


def test_empty_table_and_clashing_columns(spark):
    assert found(spark.createDataFrame([], SCHEMA)) == {}
    rows = [(1, 1, "user", "Hi.", 9, "mine"), (1, 2, "assistant", "Yes.", 9, None)]
    assert found(spark.createDataFrame(rows, SCHEMA)) == plain(rows)


def test_sql_agrees_on_the_test_tables(spark):
    path = "/root/testdata/sf0.01"
    want = duckdb.sql(cr.OP12_SQL.replace("FROM conversations", f"FROM '{path}/conversations.parquet'"))
    got = cr.op12_conversation_repair(spark, path).select(*want.columns).collect()
    assert sorted(map(tuple, got)) == sorted(want.fetchall())
