"""Repair of conversations against a plain search of the least cost and audit."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from tidemark.llm import conversations

SCHEMA = "conv_id long, turn long, role string, text string, conv string, mark string, part int"
SPACE = " \t\n\x0b\x0c\r"
SF_DIR = "/root/testdata/sf0.01"


def damaged(rows):
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault = zlib.crc32(key.encode()) % 20
        if fault == 1:
            text = ""
        if fault == 2:
            text = "".join(c for c in text if c not in ".!?")
        if fault == 4:
            role = "user"
        yield from [(turn, role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)


def repair(rows):
    """Costs to the end from every row and state, then the least letter that keeps to them."""
    rows = sorted(rows, key=lambda row: (row[0] is not None, row[0] or 0, row[1], hashlib.md5(row[2].encode()).digest()))
    seen, faults = set(), []
    for _, role, text in rows:
        body = text.strip(SPACE)
        fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
        faults.append(fault)
        seen.add((role, text))
    follow = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}

    def moves(at, state):
        for letter, role in (("I", "user"), ("I", "assistant")):
            if (state, role[0]) in follow:
                yield "I", 5, at, follow[state, role[0]], (role, "")
        if at < len(rows):
            _, role, text = rows[at]
            yield "D", 2, at + 1, state, None
            if faults[at] not in ("blank", "duplicate"):
                extra = 5 * (faults[at] == "truncated")
                if (state, role[:1]) in follow:
                    yield "K", extra, at + 1, follow[state, role[:1]], (role, text)
                for new in ("user", "assistant"):
                    if (state, new[0]) in follow:
                        yield "R", 1 + extra, at + 1, follow[state, new[0]], (new, text)

    left = {(len(rows), ""): 0, (len(rows), "a"): 0, (len(rows), "s"): 10, (len(rows), "u"): 5}
    for at in range(len(rows) - 1, -1, -1):
        for _ in range(4):  # inserted rows stay at the same place
            for state in ("", "s", "u", "a"):
                left[at, state] = min(
                    left.get((to, after), 10**9) + cost for _, cost, to, after, _ in moves(at, state)
                )
    at, state, audit, out, total = 0, "", "", [], left[0, ""]
    while at < len(rows) or left[at, state]:
        letter, cost, to, after, row = min(
            move for move in moves(at, state) if left[move[2], move[3]] + move[1] == left[at, state]
        )
        at, state, audit = to, after, audit + letter
        out += [row] if row else []
    initials = [role[:1] for _, role, _ in rows]
    illegal = sum(pair not in (("s", "u"), ("u", "a"), ("a", "u")) for pair in zip(initials, initials[1:], strict=False))
    turns = {turn for turn, _, _ in rows if turn is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    sha = hashlib.sha256("\n".join(f"{role}:{text}" for role, text in out).encode()).hexdigest()
    counts = [faults.count(name) for name in ("blank", "duplicate", "truncated")]
    return (gaps, *counts, illegal, total, audit, sha)


def expected(rows):
    of_conv = {}
    for row in rows:
        of_conv.setdefault(row[0], []).append(row)
    return {(conv, *repair(list(damaged(each)))) for conv, each in of_conv.items()}


def random_rows(conversations_, longest, seed):
    pick = random.Random(seed)
    roles = ["user", "assistant", "system", "tool", "", "usher", None]
    texts = ["Yes.", "No", "", " \n", "Why?", "Go on!\t", None, "Déjà vu.", "a" * 5000 + "."]
    rows = []
    for conv in [*range(conversations_), None]:
        n = pick.randint(1, longest)
        for at in range(n):
            odd = pick.random() < 0.3
            role = pick.choice(roles) if odd else ("user", "assistant")[at % 2]
            text = pick.choice(texts) if odd else f"Text {at}."
            turn = pick.choice([None, at, 3]) if pick.random() < 0.1 else at
            rows.append((conv, turn, role, text))
            if pick.random() < 0.05:
                rows += [rows[-1]] * 2
    return rows


def query(spark, rows, block_rows=4096):
    table = spark.createDataFrame([(*row, "x", "y", 1) for row in rows], SCHEMA)
    repaired = conversations.repair(conversations.damage(table), block_rows=block_rows)
    digests = conversations.text_digests(repaired.rows)
    found = repaired.summary.join(digests, "conv", "left").collect()
    return {
        (
            None if r.conv == -(2**63) else r.conv, r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost,
            r.audit, r.sha256 or hashlib.sha256(b"").hexdigest(),
        )
        for r in found
    }


@pytest.mark.parametrize("block_rows", [1, 3, 4096])
def test_repairs_match_a_plain_search(spark, block_rows):
    rows = random_rows(60, 25, 5)
    want = {row for row in expected(rows) if row[0] is None or list(damaged([r for r in rows if r[0] == row[0]]))}
    assert query(spark, rows, block_rows) == want


def test_crossings_match_a_plain_search_on_every_short_row_of_codes():
    import itertools

    for size in range(1, 5):
        for codes in itertools.product(range(9), repeat=size):
            cost, tokens, closing, _ = conversations.repair_block(bytes(codes), 0, -1)
            # All ways through the tokens of each row.
            ways = [(0, "", 0)]
            for code in codes:
                ways = [
                    (c + cost_, audit + token, after)
                    for c, audit, state in ways
                    for (before, after), (cost_, token) in conversations.ROWS[code].tokens.items()
                    if before == state
                ]
            ends = conversations.END_COSTS
            best = min((c + ends[state], audit + "I" * (ends[state] // 5)) for c, audit, state in ways)
            assert (cost, "".join(tokens) + closing) == best


def test_a_long_conversation_is_spread_over_blocks(spark):
    rows = [(1, at, ("user", "assistant")[at % 2], f"Text {at % 700}.") for at in range(5000)]
    rows += [(1, 7, "user", "Copy.")] * 500
    assert query(spark, rows, block_rows=64) == expected(rows)


def test_query_over_the_whole_table(spark):
    table = spark.read.parquet(f"{SF_DIR}/conversations.parquet")
    rows = [tuple(row) for row in table.select("conv_id", "turn", "role", "text").collect()]
    got = contract.queries()["op11_conversation_repair"](spark, SF_DIR)
    assert got.columns == [
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"
    ]
    assert {tuple(row) for row in got.collect()} == expected(rows)


def test_conversations_without_rows(spark, folder):
    path = folder("tables")
    # Turn 18 of conversation 0 is dropped, so nothing is left of it.
    [dropped] = [t for t in range(100) if zlib.crc32(f"0:{t}".encode()) % 20 == 0][:1]
    table = spark.createDataFrame([(0, dropped, "user", "Hi.", "x", "y", 1)], SCHEMA)
    table.write.parquet(f"{path}/conversations.parquet")
    got = contract.queries()["op11_conversation_repair"](spark, path).collect()
    assert [tuple(row) for row in got] == [(0, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    empty = folder("none")
    table.where(F.lit(False)).write.parquet(f"{empty}/conversations.parquet")
    assert contract.queries()["op11_conversation_repair"](spark, empty).count() == 0
