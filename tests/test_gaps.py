"""Missing, repeated and overlapping ranges against a walk over all numbers."""

import random

import pytest

from tidemark.operators import gaps

STORED = "stream string, offset long, writer string"
EXPECTED = "stream string, first long, last long"


def walk(rows, expected):
    streams = {}
    for stream, offset, writer in rows:
        if stream is not None and offset is not None:
            streams.setdefault(stream, {}).setdefault(offset, []).append(writer)
    bounds = {stream: (first, last) for stream, first, last in expected}
    found = set()
    for stream in streams.keys() | bounds.keys():
        held = streams.get(stream, {})
        numbers = [*held, *bounds.get(stream, ())]
        run = None
        for at in range(min(numbers), max(numbers) + 2):
            writers = held.get(at, [])
            kind = "overlap" if len(set(writers)) > 1 else "repeated" if len(writers) > 1 else None
            kind = kind if writers else "missing" if at <= max(numbers) else None
            if run and run[0] != kind:
                found.add((stream, run[0], run[1], at - 1, at - run[1], run[2]))
                run = None
            if kind:
                run = (kind, run[1] if run else at, (run[2] if run else 0) + len(writers))
    return found


@pytest.mark.parametrize("bits, seed", [(1, 1), (2, 2), (3, 3), (16, 4)])
def test_ranges_match_a_walk(spark, monkeypatch, bits, seed):
    monkeypatch.setattr(gaps, "BITS", bits)
    pick = random.Random(seed)
    rows = [(None, 3, "a"), ("s", None, "a"), ("alone", 70, "a"), ("below", -5, "a"), ("below", -3, None)]
    for stream in "pqr":
        at = pick.randint(0, 40)
        while at < 600:
            rows += [(stream, at, pick.choice("ab")) for _ in range(pick.choice([1, 1, 1, 2, 3]))]
            at += pick.choice([1, 1, 1, 1, 2, 17])
    expected = [("p", 0, 700), ("q", 50, 60), ("empty", 5, 9)]
    frame = spark.createDataFrame(rows, STORED)
    got = gaps.audit(frame, spark.createDataFrame(expected, EXPECTED)).collect()
    assert len(got) == len(set(got))
    assert {tuple(row) for row in got} == walk(rows, expected)
    assert {tuple(row) for row in gaps.audit(frame).collect()} == walk(rows, [])


def test_nothing_stored(spark):
    none = spark.createDataFrame([], STORED)
    assert gaps.audit(none).count() == 0
    [row] = gaps.audit(none, spark.createDataFrame([("s", 1, 4)], EXPECTED)).collect()
    assert tuple(row) == ("s", "missing", 1, 4, 4, 0)


def test_numbers_of_a_stream_are_spread(spark):
    frame = spark.range(10).selectExpr("string(id % 2) AS stream", "id AS offset", "'w' AS writer")
    plan = gaps.audit(frame)._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    # All but the last level of gaps and of islands are dealt by block, too.
    assert sum("block" in line.split("windowspecdefinition(")[1].split("ASC")[0] for line in windows) >= 2 * gaps.LEVELS
    assert "SinglePartition" not in plan
