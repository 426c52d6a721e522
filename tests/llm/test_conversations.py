"""Conversation repair against a plain search over all edit strings."""

import hashlib
import random
import zlib

import pytest

from quarry.llm import common, conversations

SCHEMA = "conv_id long, turn long, role string, text string, ck string, shard int, gid long"
SPACES = " \t\n\x0b\x0c\r"


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if fault == 1:
            text = ""
        if fault == 2:
            text = "".join(c for c in text if c not in ".!?")
        if fault == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    return out


def cheapest(rows):
    """(cost, audit, lines) of the cheapest edits, least audit first; rows: (role, text, fault)."""
    nxt = {0: 2, 1: 2, 2: 3, 3: 2}
    end = {0: (0, ""), 1: (6, "II"), 2: (3, "I"), 3: (0, "")}
    best = [end]
    for role, _, fault in reversed(rows):
        after, stale = best[0], 3 * (fault == "truncated")
        here = {}
        for q in range(4):
            found = [(4 + after[q][0], "D" + after[q][1])]
            if fault not in ("blank", "duplicate"):
                found.append((3 + stale + after[nxt[q]][0], "R" + after[nxt[q]][1]))
                to = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}.get(role[:1], {}).get(q)
                if to is not None:
                    found.append((stale + after[to][0], "K" + after[to][1]))
            here[q] = min(found)
        for _ in range(4):
            here = {q: min(here[q], (3 + here[nxt[q]][0], "I" + here[nxt[q]][1])) for q in here}
        best.insert(0, here)
    cost, audit = best[0][0]
    lines, q, at = [], 0, 0
    for letter in audit:
        if letter in "IR":
            q = nxt[q]
            lines.append(("user:" if q == 2 else "assistant:") + (rows[at][1] if letter == "R" else ""))
        elif letter == "K":
            q = {"s": 1, "u": 2, "a": 3}[rows[at][0][0]]
            lines.append(f"{rows[at][0]}:{rows[at][1]}")
        at += letter != "I"
    return cost, audit, lines


def expected(rows):
    convs = {r[0]: [] for r in rows}
    for r in damaged(rows):
        convs[r[0]].append(r)
    out = {}
    for conv, part in convs.items():
        part.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        seen, marked = set(), []
        for _, _, role, text in part:
            bare = text.rstrip(SPACES)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
            seen.add((role, text))
            marked.append((role, text, fault))
        turns = [r[1] for r in part if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        faults = [m[2] for m in marked]
        first = [m[0][:1] for m in marked]
        cost, audit, lines = cheapest(marked)
        out[conv] = (
            gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"),
            sum(x + y not in ("su", "ua", "au") for x, y in zip(first, first[1:])), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return out


def conversations_of(seed, convs, longest):
    rng = random.Random(seed)
    rows = []
    for conv in range(convs):
        for turn in range(rng.randint(1, longest)):
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None])
            text = rng.choice(["Fine.", "What?", "cut of", "", " \t", None, "Yes!\n", "é.", f"{rng.random()}."])
            rows.append((conv, None if rng.random() < 0.03 else turn + (rng.random() < 0.1), role, text))
    return rows


def run(spark, rows):
    table = spark.createDataFrame([r + ("x", 7, 9) for r in rows], SCHEMA).repartition(3)
    got = conversations.audit(table).collect()
    assert len(got) == len({r.conv_id for r in got})
    return {r.conv_id: tuple(r)[1:] for r in got}


@pytest.mark.parametrize("shard_rows", [20_000, 40])
def test_equal_to_a_plain_search(spark, monkeypatch, shard_rows):
    """Also with conversations that are split over many shards (one holds a third of all rows)."""
    monkeypatch.setattr(conversations, "SHARD_ROWS", shard_rows)
    rows = conversations_of(1, 60, 12) + [(1000 + c, t, r, x) for c, t, r, x in conversations_of(2, 1, 400)]
    rows += [(2000, t, "user", "Same.") for t in range(90)] + [(None, 3, "user", "No id."), (None, None, None, None)]
    rows += [(3000, 5, "user", "One turn.")] * 30 + [(4000, 1, "assistant", "long " * 50_000 + "end.")]
    assert run(spark, rows) == expected(rows)


def test_dropped_conversations_and_empty_tables(spark):
    gone = next(c for c in range(100) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    assert run(spark, [(gone, 0, "user", "Hi.")]) == {gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    assert run(spark, []) == {}


def test_blocks_agree_with_single_steps():
    tables, rng = conversations.Tables(), random.Random(3)
    for _ in range(200):
        symbols = [rng.randrange(9) for _ in range(rng.randint(0, 23))]
        vector, cost = 0, 0
        for s in reversed(symbols):
            costs = conversations._before(tables.vectors[vector], s)
            vector, cost = tables.vectors.index(tuple(c - min(costs) for c in costs)), cost + min(costs)
        seen, total = tables.walk(tables.blocks(symbols), 0)
        assert (seen[-1], total) == (vector, cost)
        move, added, exits = tables.summary(symbols)
        assert (move[0], added[0]) == (vector, cost)
        for v in range(len(tables.vectors)):
            for q in range(4):
                assert exits[v * 4 + q] == tables.trace(symbols, v, q)[2]


def test_query_runs_on_its_table(spark):
    path = "/root/testdata/sf0.001"
    from quarry.llm import registry

    rows = [tuple(r) for r in common.table(spark, path, "conversations").select("conv_id", "turn", "role", "text").collect()]
    got = {r.conv_id: tuple(r)[1:] for r in registry.QUERIES["op13_four_russians"](spark, path).collect()}
    assert got == expected(rows)
