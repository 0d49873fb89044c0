import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators import envelopes

MESSAGES = [
    '{"data":[{"c":["1","8"],"p":10,"s":"A","t":1714567890123,"v":1.5}],"type":"trade"}',
    '{"data":[{"c":null,"p":"x","s":"B","t":1714567890999,"v":2}],"type":"trade"}',
    '{"data":[{"p":3.5,"s":"A","t":"bad","v":1}],"type":"trade"}',
    '{"data":[{"p":4.5,"s":"A","t":1714567891000}],"type":"trade"}',
    '{"type":"ping"}',
    '{"data":[],"type":"trade"}',
    '{"data":null}',
    "garbage",
    None,
    '{"data":[{"p":1,"s":"A","t":1,"v":1},{"p":2,"s":"B","t":2,"v":2}],"type":"trade"}',
]


def messages(spark, values=MESSAGES):
    numbered = [(i, v.encode() if v is not None else None) for i, v in enumerate(values)]
    return spark.createDataFrame(numbered, "message_id int, value binary")


def test_parse_follows_the_null_rules(spark):
    ticks = envelopes.parse_envelopes(messages(spark), keep=["message_id"], with_position=True)
    assert [tuple(r) for r in ticks.orderBy("message_id", "position").collect()] == [
        (0, 0, "A", 10.0, 1.5, 1714567890123),
        (1, 0, "B", None, 2.0, 1714567890999),
        (2, 0, "A", 3.5, 1.0, None),
        (3, 0, "A", 4.5, None, 1714567891000),
        (9, 0, "A", 1.0, 1.0, 1),
        (9, 1, "B", 2.0, 2.0, 2),
    ]


def test_parse_without_extras_has_the_tick_columns(spark):
    ticks = envelopes.parse_envelopes(messages(spark))
    assert ticks.columns == ["symbol", "price", "volume", "timestamp"]
    assert ticks.count() == 6


def test_bad_messages_are_told_from_empty_ones(spark):
    bad = envelopes.bad_messages(messages(spark))
    assert {r.message_id for r in bad.collect()} == {1, 2, 7}


def test_encoded_message_has_the_feed_layout(spark):
    row = spark.createDataFrame([("A", 1.5, 2.0, 7)], "s string, p double, v double, t bigint")
    tick = envelopes.tick_struct(F.col("s"), F.col("p"), F.col("v"), F.col("t"))
    [message] = envelopes.encode_envelopes(row, [tick]).collect()
    assert json.loads(message.value) == {
        "data": [{"p": 1.5, "s": "A", "t": 7, "v": 2.0}],
        "type": "trade",
    }


def test_allow_list(spark):
    ticks = envelopes.parse_envelopes(messages(spark))
    assert {r.symbol for r in envelopes.allow_symbols(ticks, ["B", "C"]).collect()} == {"B"}


ticks_lists = st.lists(
    st.tuples(
        st.one_of(st.none(), st.text(st.characters(exclude_categories=["Cs"]), max_size=8)),
        st.one_of(st.none(), st.floats(allow_nan=False, allow_infinity=False)),
        st.one_of(st.none(), st.floats(allow_nan=False, allow_infinity=False)),
        st.one_of(st.none(), st.integers(-(2**63), 2**63 - 1)),
    ),
    min_size=1,
    max_size=200,
)


@settings(
    max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(ticks_lists)
def test_parse_undoes_encode(spark, rows):
    numbered = [(i, *row) for i, row in enumerate(rows)]
    df = spark.createDataFrame(
        numbered, "n int, symbol string, price double, volume double, timestamp bigint"
    )
    tick = envelopes.tick_struct(*[F.col(c) for c in ("symbol", "price", "volume", "timestamp")])
    encoded = envelopes.encode_envelopes(df, [tick, tick], keep=["n"])
    parsed = envelopes.parse_envelopes(encoded, keep=["n"], with_position=True)
    got = sorted(tuple(r) for r in parsed.select("n", "position", *df.columns[1:]).collect())
    want = [(n, i, *rest) for n, *rest in numbered for i in (0, 1)]
    assert [tuple(map(repr, r)) for r in got] == [tuple(map(repr, r)) for r in want]
