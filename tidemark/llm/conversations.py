"""Conversations repaired at the least cost, by Hirschberg's divide and conquer.

The rows of a conversation are taken by turn (a missing one first), then role, then a digest of
the text. Each row's first fault counts: blank, duplicate (role and text seen earlier) or
truncated (its last character but white space is none of ``.!?``). What is left must have role
initials ``(s?(ua)+)?``. A row is kept at cost 0, gets the role user or assistant at 1, or is
deleted at 2, as blank and duplicate rows must be; an empty user or assistant row is inserted
anywhere at 5; a truncated row that is not deleted adds 5. Of the cheapest repairs the one counts
whose audit, the initials of its edits in order (D, I, K, R), is the ASCII-least.

Four states say what may follow: nothing yet, after a system row, after a user row, after an
assistant row. Inserted rows belong to the row that they stand before, so a row's edits are one
token, and no token begins another one. To repair rows lo to hi, costs run forward from lo and
backward from hi and meet in the middle. Beside its cost each state of the forward side has the
rank of its least audit among the four: audits of equally many rows that differ do so before
either ends, so of the crossings whose costs add up to the least the one of least rank is the
audit-least. Both halves are repaired alike. That takes linear space.

A conversation of any length is spread: rows are range-partitioned by conversation and turn and
cut into blocks of at most ``block_rows``. A block stands for its rows as a four by four matrix
of costs and ranks, and blocks are crossed by the same method as rows are; then each block is
repaired for itself. Only matrices of one conversation meet in a task. Copies of a row are
counted, not sent. (A digest of a whole conversation is sequential: ``text_digests`` streams the
rows of each conversation through one task, holding none.)

A null role or text is one space, a null turn comes first, rows without a conversation id are one
conversation, whose id stays null. Rows with an empty role, or one of another initial, can only
change roles or go. A conversation without rows has zeros and an empty audit; other columns are
not looked at. Gaps that no long holds are the largest one.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache
from typing import NamedTuple

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ASCII_SPACE, NULL_ID, durable, id_of

NEVER = 1 << 60
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_INITIALS = "sua"
_OTHER = 3
_TRUNCATED = 4  # added to the code of the initial
_FORCED = 8  # blank or duplicate
_LONGEST = 2**63 - 1

_AFTER_USER = {_START: _USER, _SYSTEM: _USER, _ASSISTANT: _USER}
_AFTER_ASSISTANT = {_USER: _ASSISTANT}
_KEEPS = ({_START: _SYSTEM}, _AFTER_USER, _AFTER_ASSISTANT, {})
_REROLES = _AFTER_USER | _AFTER_ASSISTANT  # also what an inserted row does
# What it takes to end in a state.
_ENDS = ["", "II", "I", ""]
END_COSTS = [5 * len(each) for each in _ENDS]


class Item(NamedTuple):
    """A row, or a block of rows: moves (from, to, cost, rank), and tokens of a single row.

    The rank orders the moves from one state by their audits.
    """

    moves: list[tuple[int, int, int, int]]
    tokens: dict[tuple[int, int], tuple[int, str]]


def _row_item(code: int) -> Item:
    best: dict[tuple[int, int], tuple[int, str]] = {}

    def offer(before: int, after: int, cost: int, token: str) -> None:
        best[before, after] = min(best.get((before, after), (NEVER, "")), (cost, token))

    for before in range(4):
        offer(before, before, 2, "D")
        if code == _FORCED:
            continue
        extra = 5 if code >= _TRUNCATED else 0
        state = before
        for inserted in range(3):
            if (after := _KEEPS[code % _TRUNCATED].get(state)) is not None:
                offer(before, after, 5 * inserted + extra, "I" * inserted + "K")
            offer(before, _REROLES[state], 5 * inserted + 1 + extra, "I" * inserted + "R")
            state = _REROLES[state]
    return Item(_ranked({pair: (cost, token) for pair, (cost, token) in best.items()}), best)


def _ranked(best: dict) -> list[tuple[int, int, int, int]]:
    moves = []
    for before in range(4):
        of_state = sorted((order, after, cost) for (at, after), (cost, order) in best.items() if at == before)
        moves += [(before, after, cost, rank) for rank, (_, after, cost) in enumerate(of_state)]
    return moves


ROWS = [_row_item(code) for code in range(_FORCED + 1)]


def forward(items: Sequence[Item], lo: int, hi: int, start: int) -> tuple[list[int], list[int]]:
    """Least costs to each state after rows lo to hi, and the ranks of their least audits."""
    costs, ranks = [NEVER] * 4, [0] * 4
    costs[start] = 0
    for at in range(lo, hi):
        reached, orders = [NEVER] * 4, [0] * 4
        for before, after, cost, rank in items[at].moves:
            if costs[before] < NEVER:
                total, order = costs[before] + cost, ranks[before] * 4 + rank
                if (total, order) < (reached[after], orders[after]):
                    reached[after], orders[after] = total, order
        in_order = sorted(orders)
        costs, ranks = reached, [in_order.index(order) for order in orders]
    return costs, ranks


def backward(items: Sequence[Item], lo: int, hi: int, ends: list[int]) -> list[int]:
    """Least costs from each state before row lo to the end behind hi."""
    for at in range(hi - 1, lo - 1, -1):
        costs = [NEVER] * 4
        for before, after, cost, _ in items[at].moves:
            costs[before] = min(costs[before], cost + ends[after])
        ends = costs
    return ends


def crossings(items: Sequence[Item], start: int, ends: list[int]) -> list[int]:
    """The state after each item, of the audit-least of the cheapest ways."""
    states: list[int] = []

    def cross(lo: int, hi: int, start: int, ends: list[int]) -> None:
        middle = max(lo + 1, (lo + hi) // 2)
        costs, ranks = forward(items, lo, middle, start)
        rest = backward(items, middle, hi, ends)
        state = min(range(4), key=lambda at: (costs[at] + rest[at], ranks[at]))
        if hi - lo == 1:
            states.append(state)
            return
        cross(lo, middle, start, [0 if at == state else NEVER for at in range(4)])
        cross(middle, hi, state, ends)

    if items:
        cross(0, len(items), start, ends)
    return states


@lru_cache(maxsize=100_000)
def block_matrix(codes: bytes) -> tuple[tuple[int, ...], tuple[int, ...]]:
    """Costs and ranks from each state (4) to each (4) over the rows of a block."""
    items = [ROWS[code] for code in codes]
    found = [forward(items, 0, len(items), start) for start in range(4)]
    return tuple(c for costs, _ in found for c in costs), tuple(r for _, ranks in found for r in ranks)


def block_item(costs: Sequence[int], ranks: Sequence[int]) -> Item:
    pairs = [(before, after) for before in range(4) for after in range(4)]
    moves = [(*pair, int(c), int(r)) for pair, c, r in zip(pairs, costs, ranks, strict=True) if c < NEVER]
    return Item(moves, {})


@lru_cache(maxsize=100_000)
def repair_block(codes: bytes, start: int, end: int) -> tuple[int, list[str], str, list[int]]:
    """Cost, token of each row, token of the end, state after each row. End -1 is any that may be."""
    items = [ROWS[code] for code in codes]
    ends = END_COSTS if end < 0 else [0 if at == end else NEVER for at in range(4)]
    states = crossings(items, start, ends)
    steps = [item.tokens[pair] for item, pair in zip(items, zip([start, *states], states), strict=True)]
    last = states[-1] if states else start
    closing = _ENDS[last] if end < 0 else ""
    return sum(cost for cost, _ in steps) + 5 * len(closing), [token for _, token in steps], closing, states


# On Spark

_BLOCKS = (
    "conv long, part int, seq int, codes binary, roles array<string>, marks binary, "
    "costs array<long>, ranks array<int>, first_initial int, last_initial int, "
    "first_turn long, last_turn long, n_turns long, blank long, duplicate long, truncated long, illegal long"
)
_SOLVED = "conv long, part int, seq int, start int, end int, joint_illegal long, joint_turn long"
_REPAIRED = (
    "conv long, part int, seq int, audit string, cost long, "
    "edits array<struct<edit:string,role:string,key_role:string,mark:binary>>"
)
_NEXT = {(0, 1), (1, 2), (2, 1)}  # su, ua, au


def damage(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) with faults by the CRC-32 of ``conv_id:turn`` modulo 20:
    0 drops a row, 1 empties its text, 2 removes ``.!?``, 3 repeats it, 4 sets the role user.
    Nulls are one space there and as role and text."""
    names = [F.coalesce(F.col(name).cast("string"), F.lit(" ")) for name in ("conv_id", "turn", "role", "text")]
    fault = F.crc32(F.concat(names[0], F.lit(":"), names[1]).cast("binary")) % 20
    text = F.when(fault == 1, "").when(fault == 2, F.translate(names[3], ".!?", "")).otherwise(names[3])
    copies = F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1)
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.when(fault == 4, "user").otherwise(names[2]).alias("role"),
        text.alias("text"),
        F.explode(F.array_repeat(F.lit(0), copies)).alias("copy"),
    ).drop("copy")


def _marked(rows: DataFrame) -> DataFrame:
    space = F.lit(" ")
    texts = rows.select(
        id_of("conv_id").alias("conv"),
        id_of("turn").alias("turn"),
        F.coalesce("role", space).alias("role"),
        F.coalesce("text", space).alias("text"),
    )
    return texts.withColumn("mark", F.unhex(F.md5(F.col("text").cast("binary"))))


def _code() -> Column:
    initial = F.left("role", F.lit(1))
    code = F.lit(_OTHER)
    for number, letter in enumerate(_INITIALS):
        code = F.when(initial == letter, number).otherwise(code)
    last = F.right(F.rtrim(F.col("text"), F.lit(ASCII_SPACE)), F.lit(1))
    return (
        F.when(last == "", code + _FORCED)
        .when(last.isin(".", "!", "?"), code)
        .otherwise(code + _TRUNCATED)
        .cast("int")
    )


def _cut(block_rows: int):
    """Blocks of the rows of one partition, which come in order."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part = TaskContext.get().partitionId()
        held: list[tuple] = []  # turn, role, mark, code, copies, first
        conv, seq = None, 0

        def block() -> tuple:
            codes, roles, marks, initials = bytearray(), [], bytearray(), []
            blank = duplicate = truncated = illegal = 0
            turns = set()
            for turn, role, mark, code, copies, first in held:
                initial = code % _TRUNCATED
                illegal += copies - 1
                if initials and (initials[-1], initial) not in _NEXT:
                    illegal += 1
                initials[:] = [initials[0] if initials else initial, initial]
                if turn != NULL_ID:
                    turns.add(turn)
                if code >= _FORCED:
                    blank += copies
                    codes += bytes([_FORCED]) * copies
                    continue
                duplicate += copies - first
                if first:
                    truncated += code >= _TRUNCATED
                    codes.append(code)
                    roles.append(role)
                    marks += mark
                codes += bytes([_FORCED]) * (copies - first)
            costs, ranks = block_matrix(bytes(codes))
            return (
                conv, part, seq, bytes(codes), roles, bytes(marks), costs, ranks, initials[0], initials[1],
                min(turns, default=None), max(turns, default=None), len(turns), blank, duplicate, truncated, illegal,
            )

        names = [each.split()[0] for each in _BLOCKS.split(", ")]
        for batch in batches:
            out = []
            columns = [batch[name].tolist() for name in ("conv", "turn", "role", "mark", "code", "copies", "first")]
            for at, *row in zip(*columns, strict=True):
                if held and (at != conv or len(held) >= block_rows):
                    out.append(block())
                    seq, held = seq + 1, []
                conv = at
                held.append((*row[:5], int(row[5])))
            yield _frame(out, names)
        if held:
            yield _frame([block()], names)

    return cut


def _frame(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    """Objects, so that whole numbers beside nulls stay whole."""
    return pd.DataFrame(rows, columns=names, dtype=object)


def _solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Start and end state of every block; the blocks of a conversation come in order."""
    names = [each.split()[0] for each in _SOLVED.split(", ")]
    conv, held = None, []  # part, seq, costs, ranks, first and last initial, first and last turn

    def solved() -> list[tuple]:
        states = crossings([block_item(block[2], block[3]) for block in held], _START, END_COSTS)
        out, before, turn = [], None, None
        for at, (start, block) in enumerate(zip([_START, *states], held, strict=False)):
            end = -1 if at == len(held) - 1 else states[at]
            illegal = int(before is not None and (before, block[4]) not in _NEXT)
            known = block[6] is not None
            out.append((conv, block[0], block[1], start, end, illegal, int(known and block[6] == turn)))
            before, turn = block[5], block[7] if known else turn
        return out

    columns = ("conv", "part", "seq", "costs", "ranks", "first_initial", "last_initial", "first_turn", "last_turn")
    for batch in batches:
        out = []
        for at, *block in zip(*[batch[name].tolist() for name in columns], strict=True):
            if held and at != conv:
                out += solved()
                held = []
            conv = at
            block[6:] = [None if pd.isna(turn) else turn for turn in block[6:]]
            held.append(tuple(block))
        yield _frame(out, names)
    if held:
        yield _frame(solved(), names)


def _reconstruct(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = [each.split()[0] for each in _REPAIRED.split(", ")[:5]] + ["edits"]
    columns = ("conv", "part", "seq", "codes", "roles", "marks", "start", "end")
    new_role = {_USER: "user", _ASSISTANT: "assistant"}
    for batch in batches:
        out = []
        for conv, part, seq, codes, roles, marks, start, end in zip(*[batch[c].tolist() for c in columns], strict=True):
            cost, tokens, closing, states = repair_block(bytes(codes), start, end)
            edits, live, before = [], 0, start
            for code, token, after in zip(codes, tokens, states, strict=True):
                for letter in token[:-1]:
                    before = _REROLES[before]
                    edits.append((letter, new_role[before], None, None))
                if code != _FORCED:
                    if token[-1] != "D":
                        role = roles[live] if token[-1] == "K" else new_role[after]
                        edits.append((token[-1], role, roles[live], marks[16 * live : 16 * live + 16]))
                    live += 1
                before = after
            for letter in closing:
                before = _REROLES[before]
                edits.append((letter, new_role[before], None, None))
            out.append((conv, part, seq, "".join(tokens) + closing, cost, edits))
        yield _frame(out, names)


class Repaired(NamedTuple):
    """``summary``: one row per conversation (conv, gaps, blank, duplicate, truncated, illegal,
    cost, audit); ``rows``: the repaired rows (conv, part, seq, at, edit, role, text), in the
    order of these numbers."""

    summary: DataFrame
    rows: DataFrame


def repair(rows: DataFrame, *, block_rows: int = 4096) -> Repaired:
    """The repair of conversations given as rows (conv_id, turn, role, text); a null conversation
    id is ``NULL_ID`` in the results."""
    marked = _marked(rows)
    counted = marked.groupBy("conv", "turn", "role", "mark", _code().alias("code")).agg(F.count("*").alias("copies"))
    keys = ["conv", "turn", "role", "mark"]
    seen_first = counted.groupBy("conv", "role", "mark").agg(F.min("turn").alias("turn"), F.lit(True).alias("first"))
    known = durable(counted.join(seen_first, keys, "left").withColumn("first", F.col("first").isNotNull()))
    in_order = known.repartitionByRange(*keys).sortWithinPartitions(*keys)
    blocks = durable(in_order.mapInPandas(_cut(block_rows), _BLOCKS))

    place = ["conv", "part", "seq"]
    matrices = blocks.drop("codes", "roles", "marks").repartition("conv").sortWithinPartitions(*place)
    solved = matrices.mapInPandas(_solve, _SOLVED)
    joined = durable(blocks.drop("costs", "ranks").join(solved, place))
    repaired = durable(
        joined.select(*place, "codes", "roles", "marks", "start", "end").mapInPandas(_reconstruct, _REPAIRED)
    )

    sums = joined.groupBy("conv").agg(
        *[F.sum(name).alias(name) for name in ("blank", "duplicate", "truncated")],
        F.sum(F.col("illegal") + F.col("joint_illegal")).alias("illegal"),
        (
            F.max("last_turn").cast("decimal(38,0)")
            - F.min("first_turn")
            + 1
            - F.sum(F.col("n_turns") - F.col("joint_turn"))
        ).alias("gaps"),
    )
    audits = repaired.groupBy("conv").agg(
        F.sum("cost").alias("cost"), F.sort_array(F.collect_list(F.struct("part", "seq", "audit"))).alias("audits")
    )
    summary = sums.join(audits, "conv").select(
        "conv",
        F.least(F.coalesce("gaps", F.lit(0)), F.lit(_LONGEST)).cast("long").alias("gaps"),
        "blank", "duplicate", "truncated", "illegal", "cost",
        F.array_join("audits.audit", "").alias("audit"),
    )

    edits = repaired.select(*place, F.posexplode("edits").alias("at", "each")).select(*place, "at", "each.*")
    texts = marked.groupBy("conv", "role", "mark").agg(F.first("text").alias("text"))
    texts = texts.withColumnsRenamed({"role": "key_role"})
    kept = edits.join(texts, ["conv", "key_role", "mark"], "left")
    return Repaired(summary, kept.select(*place, "at", "edit", "role", F.coalesce("text", F.lit("")).alias("text")))


def text_digests(rows: DataFrame) -> DataFrame:
    """(conv, sha256) of the repaired rows of each conversation, ``role:text`` joined by newlines."""
    lines = rows.select(
        "conv", "part", "seq", "at", F.concat("role", F.lit(":"), "text").cast("binary").alias("line")
    )

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from hashlib import sha256

        conv, running = None, None
        for batch in batches:
            out = []
            for at, line in zip(batch["conv"].tolist(), batch["line"].tolist(), strict=True):
                if running is not None and at == conv:
                    running.update(b"\n")
                else:
                    if running is not None:
                        out.append((conv, running.hexdigest()))
                    conv, running = at, sha256()
                running.update(line)
            yield _frame(out, ["conv", "sha256"])
        if running is not None:
            yield _frame([(conv, running.hexdigest())], ["conv", "sha256"])

    ordered = lines.repartition("conv").sortWithinPartitions("conv", "part", "seq", "at")
    return ordered.mapInPandas(digest, "conv long, sha256 string")
