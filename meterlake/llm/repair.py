"""Repair of the structure of conversations by an auction shortest-path algorithm.

A repair is a path through a lattice: after i rows the repaired dialogue has ended in nothing, a system, a user or an assistant
turn, and each edit is an arc with a whole cost: K keeps the next row, R gives it another role, D deletes it, I inserts an
empty turn. The auction works on node prices. The end of the path is extended along the arc with the least cost plus
price; where that is more than the node's own price, the price is raised to it and the path contracts by a node. Prices never
exceed the true distance to the end, so once the path arrives, every arc of every cheapest path is tight (its cost is
the difference of its prices). Among the tight arcs that lead on to the end, the least letter at each node gives the first of the cheapest repairs.

A long lattice is auctioned off in blocks of rows from its end, each block's exits at the prices of the next block's entries. A
conversation beyond ``CHUNK`` rows is cut into chunks: each chunk is solved for all four states it may be entered in, the cheapest way
through all chunks fixes the entries, and no task holds more than a chunk of rows. Only the digest of a
repaired conversation, which has to be taken in order, and its audit, one letter per edit, pass through one task, row by row.

Order: turn (null first), role, digest of the text, equal rows in any order.
Defined results: a null role or text counts as one space, in the key of the damage a null conv_id or turn does too; a null conv_id is a
conversation of its own; a role whose first letter is none of s, u, a has to be changed or deleted; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.llm.chat import running_sums
from meterlake.llm.common import pieces, stored

CHUNK = 4096
BLOCK = 16
FAULTS = ("none", "truncated", "blank", "duplicate")
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3

# States: what the repaired dialogue ends with.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
#: The turn that may be made after each state (a system turn can only be kept).
MADE = (USER, USER, ASSISTANT, USER)
#: State reached from each state by keeping a row with a given initial.
KEPT = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
#: Turns that have to follow at the end, and their cost.
ENDINGS = ("", "ua", "a", "")
END_PRICES = tuple(INSERT * len(e) for e in ENDINGS)
ROLES = {"u": "user", "a": "assistant"}
_LETTER = "-sua"


# ---------------------------------------------------------------- the auction


def arcs(codes: str, row: int, state: int) -> list[tuple[str, int, int]]:
    """Letter, cost and target of the arcs of a node, letters ascending. A code is a row's initial, upper case if truncated, ``!`` if it must go."""
    if row == len(codes):
        return []
    code = codes[row]
    out = [("D", DELETE, 4 * (row + 1) + state), ("I", INSERT, 4 * row + MADE[state])]
    if code != "!":
        late = TRUNCATED if code.isupper() or code == "?" else 0
        kept = KEPT[state].get(code.lower())
        if kept:
            out.append(("K", KEEP + late, 4 * (row + 1) + kept))
        out.append(("R", REROLE + late, 4 * (row + 1) + MADE[state]))
    return out


Ends = tuple[int | None, int | None, int | None, int | None]


@lru_cache(maxsize=1 << 16)
def auctioned(codes: str, ends: Ends) -> tuple[int | None, ...]:
    """Prices of all nodes of a block whose exits cost ``ends`` (None: closed), by an auction from each of the four entries.

    The price of an entry is its distance to the end. A node from which no open exit can be reached takes no part and has no price.
    """
    last, exit_node = 4 * len(codes), 4 * len(codes) + 4
    graph = [[(cost, to) for _, cost, to in arcs(codes, n // 4, n % 4)] for n in range(last)]
    graph += [[(end, exit_node)] if end is not None else [] for end in ends]
    open_nodes = {exit_node}
    for row in range(len(codes), -1, -1):
        for _ in range(4):  # insertions stay within a row's nodes, along fewer than four arcs
            open_nodes.update(n for n in range(4 * row, 4 * row + 4) if any(to in open_nodes for _, to in graph[n]))
    graph = [[(cost, to) for cost, to in out if to in open_nodes] for out in graph]
    least = min(end for end in ends if end is not None)
    prices = [least if n in open_nodes else None for n in range(exit_node)] + [0]
    for entry in range(4):
        if entry not in open_nodes:
            continue
        path = [entry]
        while path[-1] != exit_node:
            node = path[-1]
            offer, to = min((cost + prices[to], to) for cost, to in graph[node])
            if prices[node] < offer:
                prices[node] = offer
                if len(path) > 1:
                    path.pop()
            else:
                path.append(to)
    return tuple(prices)


@lru_cache(maxsize=1 << 16)
def traced(codes: str, ends: Ends, entry: int) -> tuple[tuple[tuple[str, str], ...], int]:
    """The first of the cheapest paths of a block: letter and turn made or kept ('' for a deletion) of each edit, and the exit."""
    prices, rows = auctioned(codes, ends), len(codes)
    leads = {4 * rows + s for s in range(4) if ends[s] is not None and prices[4 * rows + s] == ends[s]}

    def tight(node: int) -> Iterator[tuple[str, int]]:
        for letter, cost, to in arcs(codes, node // 4, node % 4):
            if prices[node] is not None and prices[to] is not None and prices[node] == cost + prices[to]:
                yield letter, to

    for row in range(rows - 1, -1, -1):
        nodes = [4 * row + s for s in range(4)]
        for _ in nodes:
            leads.update(n for n in nodes if any(to in leads for _, to in tight(n)))
    out, node = [], entry
    while node < 4 * rows:
        letter, node = next((letter, to) for letter, to in tight(node) if to in leads)
        out.append((letter, "" if letter == "D" else _LETTER[node % 4]))
    return tuple(out), node % 4


def solved(codes: str, ends: Ends, entries: tuple[int, ...]) -> tuple[Ends, list[tuple[list[tuple[str, str]], int]]]:
    """Prices of the entries, and for each of ``entries`` the edits and the exit, block by block."""
    blocks, prices = [], tuple(ends)
    for start in range((max(len(codes), 1) - 1) // BLOCK * BLOCK, -1, -BLOCK):
        block, base = codes[start : start + BLOCK], min(p for p in prices if p is not None)
        relative = tuple(None if p is None else p - base for p in prices)
        blocks.append((block, relative))
        prices = tuple(None if p is None else p + base for p in auctioned(block, relative)[:4])
    found = []
    for state in entries:
        edits: list[tuple[str, str]] = []
        for block, relative in reversed(blocks):
            part, state = traced(block, relative, state)
            edits += part
        found.append((edits, state))
    return prices, found


def by_row(edits: list[tuple[str, str]]) -> list[tuple[str, str, str]]:
    """For each row: the turns inserted before it, its letter and its turn."""
    out, before = [], ""
    for letter, turn in edits:
        if letter == "I":
            before += turn
        else:
            out.append((before, letter, turn))
            before = ""
    return out


# ---------------------------------------------------------------- rows


def conversation_key() -> Column:
    return F.coalesce(F.col("conv_id").cast("string"), F.lit(" "))


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows after damage by a hash of conversation and turn: dropped, emptied, cut short, repeated or given to the user."""
    turn = F.coalesce(F.col("turn").cast("string"), F.lit(" "))
    rows = conversations.select(
        "conv_id", "turn",
        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
        (F.crc32(F.concat(conversation_key(), F.lit(":"), turn)) % 20).alias("damage"),
    )
    damage = F.col("damage")
    text = F.when(damage == 1, "").when(damage == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.when(damage == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.where(damage != 0).select(
        "conv_id", "turn", F.when(damage == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.explode(copies).alias("copy")
    ).drop("copy")


def ordered(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """conv, conv_id, turn, role and text with the position in the conversation and the first fault of each row."""
    last = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    numbered = rows.select(
        conversation_key().alias("conv"), "conv_id", F.col("turn").cast("long").alias("turn"), "role", "text",
        F.sha2("text", 256).alias("digest"), last.alias("last"), F.monotonically_increasing_id().alias("row"), F.lit(1).cast("long").alias("one"),
    )
    numbered = numbered.withColumn("known", F.col("turn").isNotNull())
    placed = stored(spark, running_sums(spark, numbered, ["conv"], ["known", "turn", "role", "digest", "row"], position="one"), "turns")
    # A text's first row is one row per text, found by an aggregate and joined by place, so no text is a hot key.
    firsts = placed.where("last <> ''").groupBy("conv", "role", "digest").agg(F.min("position").alias("position"))
    firsts = firsts.select("conv", "position", F.lit(True).alias("first"))
    ends = F.col("last").isin(".", "!", "?")
    fault = F.when(F.col("last") == "", "blank").when(F.col("first").isNull(), "duplicate").when(~ends, "truncated").otherwise("none")
    return placed.join(firsts, ["conv", "position"], "left").select("conv", "conv_id", "position", "turn", "role", "text", fault.alias("fault"))


def _chunks(rows: DataFrame, size: int) -> DataFrame:
    """conv, chunk, its rows' codes in order, and how many chunks the conversation has."""
    initial = F.substring("role", 1, 1)
    known = F.when(initial.isin("s", "u", "a"), initial).otherwise(".")
    late = F.when(known == ".", "?").otherwise(F.upper(known))
    code = F.when(F.col("fault").isin("blank", "duplicate"), "!").when(F.col("fault") == "truncated", late).otherwise(known)
    each = rows.select("conv", F.floor(F.col("position") / size).alias("chunk"), "position", code.alias("code"))
    chunks = each.groupBy("conv", "chunk").agg(F.sort_array(F.collect_list(F.struct("position", "code"))).alias("codes"))
    chunks = chunks.select("conv", "chunk", F.array_join("codes.code", "").alias("codes"))
    return chunks.join(chunks.groupBy("conv").agg(F.max("chunk").alias("last")), "conv")


EDITS = "conv string, position long, before string, letter string, made string, after string"


def _edit_rows(conv: str, first: int, edits: list[tuple[str, str]], after: str) -> list[tuple]:
    rows = by_row(edits)
    stop = len(rows) - 1
    return [(conv, first + i, b, letter, turn, after if i == stop else "") for i, (b, letter, turn) in enumerate(rows)]


def _edit_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string()]
    columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(columns, ["conv", "position", "before", "letter", "made", "after"])


def edits(spark: SparkSession, rows: DataFrame, size: int = CHUNK) -> DataFrame:
    """For each row of ``ordered``: turns inserted before it, its letter, the turn it becomes, and turns inserted after the last."""
    chunks = stored(spark, _chunks(rows, size), "chunks")

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for conv, codes in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                _, ((found, end),) = solved(codes, END_PRICES, (NOTHING,))
                out += _edit_rows(conv, 0, found, ENDINGS[end])
                if len(out) > size:
                    yield _edit_batch(out)
                    out = []
            if out:
                yield _edit_batch(out)

    short = chunks.where("last = 0").select("conv", "codes").mapInArrow(whole, EDITS)
    return short.unionByName(_long_edits(spark, chunks.where("last > 0"), size))


def _long_edits(spark: SparkSession, chunks: DataFrame, size: int) -> DataFrame:
    """Edits of conversations of many chunks: the chunks' crossings, the way through them, then each chunk by itself."""

    def crossings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            costs = []
            for codes in batch.column(2).to_pylist():
                to_exit = [solved(codes, tuple(0 if s == e else None for s in range(4)), ())[0] for e in range(4)]
                costs.append([-1 if to_exit[e][s] is None else to_exit[e][s] for s in range(4) for e in range(4)])
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(costs, pa.list_(pa.int64()))], ["conv", "chunk", "costs"])

    def priced(frame):
        """Prices at the end of each chunk; the rows are one per chunk of one conversation."""
        frame = frame.sort_values("chunk")
        prices, ends = END_PRICES, []
        for costs in frame["costs"][::-1]:
            ends.append(list(prices))
            prices = tuple(min(int(costs[4 * s + e]) + prices[e] for e in range(4) if costs[4 * s + e] >= 0) for s in range(4))
        return frame[["conv", "chunk"]].assign(ends=ends[::-1])

    def exits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            reached = [
                [end for _, end in solved(codes, tuple(ends), (0, 1, 2, 3))[1]]
                for codes, ends in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(reached, pa.list_(pa.int32()))], ["conv", "chunk", "exits"])

    def entered(frame):
        """The state each chunk is entered in."""
        frame = frame.sort_values("chunk")
        state, entries = NOTHING, []
        for ways in frame["exits"]:
            entries.append(state)
            state = int(ways[state])
        return frame[["conv", "chunk"]].assign(entry=entries)

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for conv, chunk, codes, ends, entry, last in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                _, ((found, end),) = solved(codes, tuple(ends), (entry,))
                yield _edit_batch(_edit_rows(conv, chunk * size, found, ENDINGS[end] if chunk == last else ""))

    costs = chunks.select("conv", "chunk", "codes").mapInArrow(crossings, "conv string, chunk long, costs array<long>")
    ends = costs.groupBy("conv").applyInPandas(priced, "conv string, chunk long, ends array<long>")
    ends = stored(spark, chunks.join(ends, ["conv", "chunk"]), "chunk-prices")
    ways = ends.select("conv", "chunk", "codes", "ends").mapInArrow(exits, "conv string, chunk long, exits array<int>")
    entries = ways.groupBy("conv").applyInPandas(entered, "conv string, chunk long, entry int")
    return ends.join(entries, ["conv", "chunk"]).select("conv", "chunk", "codes", "ends", "entry", "last").mapInArrow(chosen, EDITS)


def repair_plan(spark: SparkSession, rows: DataFrame, size: int = CHUNK) -> DataFrame:
    """Rows (conv_id, turn, role, text and others are not read) with position, fault and edits."""
    placed = stored(spark, ordered(spark, rows), "ordered")
    return placed.join(edits(spark, placed, size), ["conv", "position"])


def repaired(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """The repaired dialogues: conv_id, place, role, text and inserted of every turn; place orders the turns of a conversation."""
    plan = repair_plan(spark, rows)

    def made(turns: str, at: int) -> str:
        return (
            f"transform(filter(split({turns}, ''), t -> t <> ''), (t, i) -> named_struct('step', {at} + i, 'role', "
            "CASE t WHEN 'u' THEN 'user' ELSE 'assistant' END, 'text', '', 'inserted', true))"
        )

    role = "CASE WHEN letter = 'K' THEN role WHEN made = 'u' THEN 'user' ELSE 'assistant' END"
    own = f"IF(letter = 'D', array(), array(named_struct('step', 100, 'role', {role}, 'text', text, 'inserted', false)))"
    turns = F.expr(f"concat({made('before', 0)}, {own}, {made('after', 101)})")
    each = plan.select("conv_id", "position", F.explode(turns).alias("t"))
    return each.select("conv_id", F.struct("position", F.col("t.step").alias("step")).alias("place"), "t.role", "t.text", "t.inserted")


AUDITS = (
    "conv string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
)


class _Audit:
    """What is known of a conversation after some of its rows."""

    def __init__(self) -> None:
        self.faults = dict.fromkeys(FAULTS, 0)
        self.turns, self.low, self.high, self.seen = 0, None, None, None
        self.before: str | None = None
        self.illegal = self.cost = 0
        self.letters = bytearray()
        self.digest, self.any = hashlib.sha256(), False

    def _say(self, role: str, text: str) -> None:
        self.digest.update(("\n" if self.any else "").encode() + f"{role}:{text}".encode())
        self.any = True

    def _insert(self, turns: str) -> None:
        for turn in turns:
            self.letters += b"I"
            self.cost += INSERT
            self._say(ROLES[turn], "")

    def add(self, turn: int | None, role: str, text: str, fault: str, before: str, letter: str, made: str, after: str) -> None:
        self.faults[fault] += 1
        if turn is not None and turn != self.seen:
            self.turns, self.seen = self.turns + 1, turn
            self.low, self.high = turn if self.low is None else self.low, turn
        if self.before is not None and self.before + role[:1] not in ("su", "ua", "au"):
            self.illegal += 1
        self.before = role[:1]
        self._insert(before)
        self.letters += letter.encode()
        if letter == "D":
            self.cost += DELETE
        else:
            self.cost += (REROLE if letter == "R" else KEEP) + (TRUNCATED if fault == "truncated" else 0)
            self._say(ROLES[made] if letter == "R" else role, text)
        self._insert(after)

    def row(self, conv: str) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        faults = [self.faults[f] for f in ("blank", "duplicate", "truncated")]
        return (conv, gaps, *faults, self.illegal, self.cost, self.letters.decode(), self.digest.hexdigest())


def audited(spark: SparkSession, conversations: DataFrame, size: int = CHUNK) -> DataFrame:
    """The audit of every conversation after damage: counts of faults, cost and letters of the repair, digest of its result."""
    plan = repair_plan(spark, damaged(conversations), size)

    def audit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state, done = None, _Audit(), []

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            names = [f.split()[0] for f in AUDITS.split(", ")]
            kinds = [pa.string() if f.endswith("string") else pa.int64() for f in AUDITS.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

        for batch in pieces(batches, "text"):
            for key, _, *values in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key != conv:
                    if conv is not None:
                        done.append(state.row(conv))
                    conv, state = key, _Audit()
                state.add(*values)
            if done:
                yield batch_of(done)
                done = []
        if conv is not None:
            yield batch_of([state.row(conv)])

    wanted = plan.select("conv", "position", "turn", "role", "text", "fault", "before", "letter", "made", "after")
    found = wanted.repartition("conv").sortWithinPartitions("conv", "position").mapInArrow(audit, AUDITS)
    every = conversations.select("conv_id").distinct().withColumn("conv", conversation_key())
    counts = [F.coalesce(c, F.lit(0)).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = hashlib.sha256().hexdigest()
    return every.join(found, "conv", "left").select(
        "conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256")
    )
