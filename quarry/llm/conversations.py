"""Repair of conversation structure by Four-Russians block tables.

A conversation should read ``(system? (user assistant)+)?``.  Rows may be kept
(0), given the other role (3) or deleted (4, required for blank and duplicate
rows), and empty user or assistant rows inserted (3); a truncated row that stays
costs 3 more.  The cheapest edits are a shortest path over rows x four states.

Costs-to-go of the four states, less their least, form one of a few *vectors*.
A row is one of nine symbols; for every vector and every block of ``BLOCK``
symbols a table built once holds the vector before the block, the cost added and
the state in which the cheapest edits leave it.  A conversation is walked from
its end by one lookup per block; blocks are then expanded backward, row by row,
and traced forward, taking at each step the least letter that lies on a cheapest
path, which gives the least audit string of all cheapest ones.

Rows are dealt by ranges of (conversation, turn, role, text) to shards, so a very
long conversation spreads over many tasks.  A shard's part of it becomes a
function on vectors and states, composed over the shards; each shard then traces
its own rows.  Only the results of such a conversation, its audit string and the
digest of its repaired text, are joined in one row.

Cases: a null conversation id is one conversation; nulls in role and text are one
space; rows of a null turn come first; rows of one turn are ordered by role, text
(its first 64 characters, then a digest); a role that starts with none of s, u
and a (an empty one too) can only be changed or deleted; equal rows repeat one
another, so all but one are duplicates; texts of any length are read whole, one
shard at a time; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm import common

BLOCK = 4
SHARD_ROWS, SHARD_BYTES = 20_000, 8 << 20
DELETED, PAD, SYMBOLS = 0, 9, 10  # 1..8: class (s, u, a, other) x truncated
INSERT = RECAST = 3
DELETE = 4
STALE = 3  # for a truncated row that stays
AFTER = (2, 2, 3, 2)  # state after an inserted or recast row: user, but after a user assistant
KEPT = ({0: 1}, {0: 2, 1: 2, 3: 2}, {2: 3}, {})  # class -> state -> state
TAIL = ("", "II", "I", "")  # edits that end a conversation in each state
END = (0, 6, 3, 0)  # their costs
LEGAL = ("su", "ua", "au")

COUNTS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long"
PART = f"ck string, shard int, split boolean, {COUNTS}, audit string, lines string, sha string"
SUMMARY = (
    "ck string, shard int, move array<int>, added array<long>, exits array<int>, blank long, duplicate long, truncated long,"
    " illegal long, head string, tail string, turns long, low long, high long"
)
ENTRY = f"ck string, shard int, vector int, state int, last boolean, {COUNTS}"


def _before(vector: tuple[int, ...], symbol: int) -> tuple[int, ...]:
    """Costs-to-go before a row, given those after it."""
    if symbol == PAD:
        return vector
    costs = [DELETE + c for c in vector]
    if symbol != DELETED:
        kind, stale = divmod(symbol - 1, 2)
        for q in range(4):
            costs[q] = min(costs[q], RECAST + STALE * stale + vector[AFTER[q]])
            if q in KEPT[kind]:
                costs[q] = min(costs[q], STALE * stale + vector[KEPT[kind][q]])
    for _ in range(3):
        costs = [min(c, INSERT + costs[AFTER[q]]) for q, c in enumerate(costs)]
    return tuple(costs)


def _edits(vector: tuple[int, ...], symbol: int, state: int) -> tuple[str, int]:
    """The least letters of cheapest edits from ``state`` through a row, and the state after."""
    if symbol == PAD:
        return "", state
    costs, letters = _before(vector, symbol), ""
    kind, stale = divmod(symbol - 1, 2)
    while True:
        if costs[state] == DELETE + vector[state]:
            return letters + "D", state
        if costs[state] == INSERT + costs[AFTER[state]]:
            letters, state = letters + "I", AFTER[state]
        elif state in KEPT[kind] and costs[state] == STALE * stale + vector[KEPT[kind][state]]:
            return letters + "K", KEPT[kind][state]
        else:
            return letters + "R", AFTER[state]


class Tables:
    """Transitions of all vectors by single symbols and by blocks of ``BLOCK`` symbols."""

    def __init__(self) -> None:
        self.vectors, known = [END], {END: 0}
        step, added = [], []
        for v in self.vectors:  # grows while vectors are found
            step.append([])
            added.append([])
            for s in range(SYMBOLS):
                w = _before(v, s)
                low = min(w)
                w = tuple(c - low for c in w)
                if w not in known:
                    known[w] = len(self.vectors)
                    self.vectors.append(w)
                step[-1].append(known[w])
                added[-1].append(low)
        self.step, single = np.array(step), np.array(added)
        self.letters = [[[_edits(v, s, q) for q in range(4)] for s in range(SYMBOLS)] for v in self.vectors]
        after = np.array([[[e[1] for e in row] for row in rows] for rows in self.letters])
        codes = np.arange(SYMBOLS**BLOCK)
        digits = [codes // SYMBOLS**i % SYMBOLS for i in range(BLOCK)]
        right = [np.broadcast_to(np.arange(len(self.vectors))[:, None], (len(self.vectors), len(codes)))]
        self.added = np.zeros(right[0].shape, dtype=np.int64)
        for i in range(BLOCK - 1, -1, -1):  # a block is read from its end
            self.added = self.added + single[right[-1], digits[i]]
            right.append(self.step[right[-1], digits[i]])
        self.move, self.added = right[-1].astype(np.uint8), self.added.astype(np.int32)
        states = np.broadcast_to(np.arange(4), self.move.shape + (4,))
        for i in range(BLOCK):
            states = after[right[BLOCK - 1 - i][..., None], digits[i][:, None], states]
        self.exits = states.astype(np.uint8)

    def blocks(self, symbols: list[int]) -> list[int]:
        """Codes of the blocks of a run of symbols, the last one filled up."""
        filled = np.array(symbols + [PAD] * (-len(symbols) % BLOCK), dtype=np.int64).reshape(-1, BLOCK)
        return (filled @ SYMBOLS ** np.arange(BLOCK)).tolist()

    def walk(self, codes: list[int], vector: int) -> tuple[list[int], int]:
        """The vectors after each block, from the end to the start (the last one stands
        before the first block), and the cost added."""
        seen, cost = [vector], 0
        for code in reversed(codes):
            cost += int(self.added[vector, code])
            vector = int(self.move[vector, code])
            seen.append(vector)
        return seen, cost

    def trace(self, symbols: list[int], vector: int, state: int) -> tuple[list[str], list[int], int]:
        """Letters of each row, the state before each row, and the state after all."""
        codes = self.blocks(symbols)
        seen, _ = self.walk(codes, vector)
        letters, states = [], []
        for b in range(len(codes)):
            inside = symbols[b * BLOCK:(b + 1) * BLOCK]
            right = [seen[len(codes) - 1 - b]]
            for s in reversed(inside[1:]):
                right.append(int(self.step[right[-1], s]))
            for s, v in zip(inside, reversed(right)):
                states.append(state)
                edit, state = self.letters[v][s][state]
                letters.append(edit)
        return letters, states, state

    def summary(self, symbols: list[int]) -> tuple[list[int], list[int], list[int]]:
        """A run as a function: for every vector after it the vector before and the cost
        added, and for every vector and state before it the state after."""
        codes, n = self.blocks(symbols), len(self.vectors)
        seen, added = [np.arange(n)], np.zeros(n, dtype=np.int64)
        for code in reversed(codes):
            added = added + self.added[seen[-1], code]
            seen.append(self.move[seen[-1], code])
        states = np.broadcast_to(np.arange(4), (n, 4))
        for b, code in enumerate(codes):
            states = self.exits[seen[len(codes) - 1 - b][:, None], code, states]
        return seen[-1].tolist(), added.tolist(), states.reshape(-1).tolist()


def damage(rows: DataFrame) -> DataFrame:
    """The rows of the exercise: crc32 of ``conv_id:turn`` modulo 20 drops a row (0),
    empties its text (1), strips its sentence ends (2), repeats it (3) or makes it a user's (4)."""
    space = F.lit(" ")
    row = common.narrow(rows, conv_id="long", turn="long", role="string", text="string")
    where = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), space), F.coalesce(F.col("turn").cast("string"), space))
    row = row.withColumn("fault", F.crc32(where.cast("binary")) % 20).withColumn("text", F.coalesce("text", space))
    return row.filter("fault <> 0").select(
        "conv_id", "turn",
        F.when(F.col("fault") == 4, "user").otherwise(F.coalesce("role", space)).alias("role"),
        F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def _key(conv_id: str = "conv_id") -> Column:
    return F.coalesce(F.col(conv_id).cast("string"), F.lit(" "))


def dealt(rows: DataFrame) -> DataFrame:
    """Rows in order, in shards of consecutive rows (``gid`` numbers them), written."""
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()
    shards = max(1, -(-size["n"] // SHARD_ROWS), -(-(size["bytes"] or 0) // SHARD_BYTES))
    bare = F.expr(r"rtrim(' \u0009\u000a\u000b\u000c\u000d', text)")
    digest = F.unhex(F.sha2(F.concat_ws("\u0000", "role", "text").cast("binary"), 256))
    marked = (
        rows.withColumn("tie", F.monotonically_increasing_id())
        .select(_key().alias("ck"), F.coalesce("turn", F.lit(0)).alias("turn"), F.col("turn").isNull().alias("no_turn"), "role", "text",
                digest.alias("digest"), (bare == "").alias("blank"), (~F.right(bare, F.lit(1)).isin(".", "!", "?")).alias("cut"), "tie")
        .withColumn("start", F.substring("text", 1, 64))
    )
    order = ["ck", F.desc("no_turn"), "turn", "role", "start", "digest", "tie"]
    in_order = marked.repartitionByRange(shards, *order).sortWithinPartitions(*order)
    return common.stash(
        in_order.select(F.spark_partition_id().alias("shard"), F.monotonically_increasing_id().alias("gid"),
                        *[c for c in marked.columns if c not in ("start", "tie")]), "turns")


def _faults(rows: list[dict], late: set[bytes]) -> list[str]:
    """First fault of each row of one conversation's part; ``late``: digests met in earlier parts."""
    seen, out = set(late), []
    for r in rows:
        out.append("blank" if r["blank"] else "duplicate" if r["digest"] in seen else "truncated" if r["cut"] else "")
        seen.add(r["digest"])
    return out


def _symbols(rows: list[dict], faults: list[str]) -> list[int]:
    kinds = {"s": 0, "u": 1, "a": 2}
    return [DELETED if f in ("blank", "duplicate") else 1 + 2 * kinds.get(r["role"][:1], 3) + (f == "truncated") for r, f in zip(rows, faults)]


def _illegal(initials: list[str]) -> int:
    return sum(x + y not in LEGAL for x, y in zip(initials, initials[1:]))


def _turns(rows: list[dict]) -> tuple[int, int | None, int | None]:
    turns = [r["turn"] for r in rows if not r["no_turn"]]
    return len(set(turns)), min(turns, default=None), max(turns, default=None)


def _gaps(distinct: int, low: int | None, high: int | None) -> int:
    return 0 if low is None else high - low + 1 - distinct


def _lines(rows: list[dict], letters: list[str], states: list[int]) -> list[str]:
    out = []
    for r, edits, state in zip(rows, letters, states):
        for e in edits:
            if e in "IR":
                state = AFTER[state]
                out.append(("user:" if state == 2 else "assistant:") + (r["text"] if e == "R" else ""))
            elif e == "K":
                out.append(f"{r['role']}:{r['text']}")
    return out


def _closing(state: int) -> list[str]:
    return ["user:", "assistant:"][2 - len(TAIL[state]):]


def _rows(table: pa.Table) -> list[dict]:
    return table.sort_by("gid").to_pylist()


def _summarise(tables: Tables, part: pa.Table, late: pa.Table) -> pa.Table:
    rows = _rows(part)
    if not rows:
        return pa.Table.from_pylist([], schema=_arrow(SUMMARY))
    faults = _faults(rows, set(late["digest"].to_pylist()))
    move, added, exits = tables.summary(_symbols(rows, faults))
    initials = [r["role"][:1] for r in rows]
    turns, low, high = _turns(rows)
    return pa.Table.from_pylist([{
        "ck": rows[0]["ck"], "shard": rows[0]["shard"], "move": move, "added": added, "exits": exits,
        "blank": faults.count("blank"), "duplicate": faults.count("duplicate"), "truncated": faults.count("truncated"),
        "illegal": _illegal(initials), "head": initials[0], "tail": initials[-1], "turns": turns, "low": low, "high": high,
    }], schema=_arrow(SUMMARY))


def _compose(tables: Tables, parts: pa.Table) -> pa.Table:
    """Entry of each part of one conversation; its counts stand on the first part."""
    rows = sorted(parts.to_pylist(), key=lambda r: r["shard"])
    vector, cost, out = 0, 0, []
    for r in reversed(rows):
        r["vector"] = vector
        cost += r["added"][vector]
        vector = r["move"][vector]
    cost += tables.vectors[vector][0]
    state = 0
    for r in rows:
        out.append({"ck": r["ck"], "shard": r["shard"], "vector": r["vector"], "state": state, "last": False})
        state = r["exits"][r["vector"] * 4 + state]
    out[-1]["last"] = True
    lows = [r["low"] for r in rows if r["low"] is not None]
    # a turn that ends one part and begins the next was counted in both
    dated = [r for r in rows if r["low"] is not None]
    distinct = sum(r["turns"] for r in rows) - sum(a["high"] == b["low"] for a, b in zip(dated, dated[1:]))
    out[0] |= {k: sum(r[k] for r in rows) for k in ("blank", "duplicate", "truncated", "illegal")}
    out[0]["illegal"] += sum(a["tail"] + b["head"] not in LEGAL for a, b in zip(rows, rows[1:]))
    out[0] |= {"cost": cost, "gaps": _gaps(distinct, min(lows, default=None), max((r["high"] for r in dated), default=None))}
    return pa.Table.from_pylist(out, schema=_arrow(ENTRY))


def _finish(tables: Tables, shard: pa.Table, extra: pa.Table) -> pa.Table:
    """Traces all conversations of a shard; ``extra``: entries of its split ones, digests met before."""
    entries, late = {}, {}
    for e in extra.to_pylist():
        if e["digest"] is None:
            entries[e["ck"]] = e
        else:
            late.setdefault(e["ck"], set()).add(e["digest"])
    rows, out, at = _rows(shard), [], 0
    while at < len(rows):
        ck, end = rows[at]["ck"], at
        while end < len(rows) and rows[end]["ck"] == ck:
            end += 1
        part, entry, at = rows[at:end], entries.get(ck), end
        faults = _faults(part, late.get(ck, set()))
        symbols = _symbols(part, faults)
        letters, states, state = tables.trace(symbols, entry["vector"] if entry else 0, entry["state"] if entry else 0)
        lines, audit = _lines(part, letters, states), "".join(letters)
        if entry is None or entry["last"]:
            lines, audit = lines + _closing(state), audit + TAIL[state]
        if entry:
            out.append({k: entry[k] for k in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")} | {
                "ck": ck, "shard": part[0]["shard"], "split": True, "audit": audit, "lines": "\n".join(lines) if lines else None})
            continue
        seen, cost = tables.walk(tables.blocks(symbols), 0)
        out.append({
            "ck": ck, "shard": part[0]["shard"], "split": False, "gaps": _gaps(*_turns(part)), "blank": faults.count("blank"),
            "duplicate": faults.count("duplicate"), "truncated": faults.count("truncated"), "illegal": _illegal([r["role"][:1] for r in part]),
            "cost": cost + tables.vectors[seen[-1]][0], "audit": audit, "sha": hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        })
    return pa.Table.from_pylist(out, schema=_arrow(PART))


def _arrow(ddl: str) -> pa.Schema:
    """Arrow schema of the few types used here."""
    kinds = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "boolean": pa.bool_(),
             "array<int>": pa.list_(pa.int32()), "array<long>": pa.list_(pa.int64())}
    return pa.schema([(name, kinds[kind]) for name, kind in (field.split() for field in ddl.split(","))])


def repair(rows: DataFrame) -> DataFrame:
    """conv_id, counts of faults, cost, audit string and digest of the repaired text of
    every conversation with rows (columns conv_id, turn, role, text)."""
    turns, tables = dealt(rows), Tables()
    shards = turns.groupBy("ck").agg(F.min("shard").alias("first"), F.max("shard").alias("last")).filter("first < last").select("ck")
    split = common.stash(shards, "split-conversations")  # at most one a shard begins
    of_split = turns.join(split, "ck", "left_semi")
    met = of_split.groupBy("ck", "digest", "shard").agg(F.count(F.lit(1)).alias("n"))
    first = of_split.groupBy("ck", "digest").agg(F.min("shard").alias("first"))
    late = common.stash(met.join(first, ["ck", "digest"]).filter("shard > first").select("ck", "shard", "digest"), "late-copies")
    narrow = of_split.select("ck", "shard", "gid", "turn", "no_turn", F.substring("role", 1, 1).alias("role"), "digest", "blank", "cut")
    parts = narrow.groupBy("ck", "shard").cogroup(late.groupBy("ck", "shard")).applyInArrow(lambda part, met: _summarise(tables, part, met), SUMMARY)
    entry = common.stash(parts.groupBy("ck").applyInArrow(lambda found: _compose(tables, found), ENTRY), "entries")
    extra = entry.withColumn("digest", F.lit(None).cast("binary")).unionByName(late, allowMissingColumns=True)
    out = common.stash(turns.groupBy("shard").cogroup(extra.groupBy("shard")).applyInArrow(lambda shard, more: _finish(tables, shard, more), PART), "repaired")
    names = [c.split()[0] for c in COUNTS.split(", ")]
    whole = out.filter("not split").select("ck", *names, "audit", F.col("sha").alias("repaired_sha256"))
    pieces = F.sort_array(F.collect_list(F.struct("shard", "audit", "lines")))
    joined = (
        out.filter("split").groupBy("ck").agg(*[F.max(c).alias(c) for c in names], pieces.alias("p"))
        .select("ck", *names, F.array_join("p.audit", "").alias("audit"), F.sha2(F.array_join("p.lines", "\n").cast("binary"), 256).alias("repaired_sha256"))
    )
    return whole.unionByName(joined).select(F.col("ck").try_cast("long").alias("conv_id"), *names, "audit", "repaired_sha256")


def audit(conversations: DataFrame) -> DataFrame:
    """``repair`` of the damaged conversations, one row for every original conversation;
    those without rows left have zeros, an empty audit and the digest of the empty text."""
    names = [c.split()[0] for c in COUNTS.split(", ")]
    fixed = repair(damage(conversations)).withColumn("ck", _key()).drop("conv_id")
    ids = common.narrow(conversations, conv_id="long").distinct().withColumn("ck", _key())
    return ids.join(fixed, "ck", "left").select(
        "conv_id", *[F.coalesce(c, F.lit(0)).alias(c) for c in names], F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )
