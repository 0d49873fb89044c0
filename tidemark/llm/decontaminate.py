"""Documents that hold passages of benchmark items, found by spaced-seed hashing.

Texts become words: runs of letters and digits in lower case. A fixed mask selects some of the
words of a window and ignores the rest, so that a window with replaced words still has the same
hash as the original if only ignored positions changed; several masks ignore different ones.
Windows of documents are joined with those of the items by hash. The hits of a document and an
item with the same displacement are then verified word by word: in the longest stretch from one
hit to another, or to itself, at least ``least_match`` of the words must agree, and along the
whole item at least ``least_words``, or that share of the words of a shorter item. A passage is
found whatever lies between it and the next one.

Before the join two bitmaps of bounded size, of the items' words and of their window hashes, rule
out nearly all windows where they are made; they have false positives only, which the join and
the check remove. Everything is built-in expressions.

Nulls: null texts have no words. Rows without an id are searched, too, and reported with a null
id. Items shorter than a mask are found where a document holds all their words in a row, whatever
stands around them; items without words are not searched for. Repeated items and rows are reported each, repeated pairs of ids once. An empty table on
either side gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import durable, numbered, place, text_of

# Eight of twelve words are selected, each ignored position being another mask's.
MASKS = ("111011001101", "110101110011", "101100111110")
SPAN = 12
_MOST_BITS = 1 << 20
_ROW = ("row_id", "row_hash")


def word_hashes(text: Column) -> Column:
    words = F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")
    return F.transform(words, lambda word: F.xxhash64(word))


def _once(after: str = "0L") -> Column:
    """A number, never negative, that keeps Spark from working out the columns beside it again
    in each place of their use: as it is not deterministic, filters that ask for it stay above.
    """
    return (F.monotonically_increasing_id() + F.expr(after)).alias("once")


def _selected(mask: str) -> list[int]:
    return [at for at, chosen in enumerate(mask) if chosen == "1"]


def _window_hash(mask: int, words: str = "words") -> str:
    chosen = ", ".join(f"{words}[i + {at}]" for at in _selected(MASKS[mask]))
    return f"xxhash64({mask}, {chosen})"


def _windows(mask: int, words: str = "words", where: str = "true") -> str:
    """An array of (hash, pos) of the windows of one mask at which ``where`` holds."""
    starts = f"filter(sequence(0, size({words}) - {SPAN}), i -> {where})"
    windows = f"transform({starts}, i -> struct({_window_hash(mask, words)} as hash, i as pos))"
    return f"if(size({words}) >= {SPAN}, {windows}, array())"


def _whole(length: int, where: str = "true") -> str:
    """An array of (hash, pos) of the windows of ``length`` words at which ``where`` holds."""
    chosen = ", ".join(f"words[i + {at}]" for at in range(length))
    starts = f"filter(sequence(0, size(words) - {length}), i -> {where})"
    windows = f"transform({starts}, i -> struct(xxhash64({-length}, {chosen}) as hash, i as pos))"
    return f"if(size(words) >= {length}, {windows}, array())"


def _longest_stretch(least_match: float) -> str:
    """(n_words, item_start) of the longest stretch between hits, of several the first, in which
    the share of the words agrees; null if there is none. Positions count from ``first``.

    The hits are those windows of which a mask's words agree. Only documents whose words from the
    first to the last hit fail as a whole come here.
    """
    same = "transform(sequence(first, last - 1), j -> doc_words[cast(j + shift as int)] = words[j])"
    masks = (" and ".join(f"same[i + {at}]" for at in _selected(mask)) for mask in MASKS)
    is_hit = " or ".join(f"({mask})" for mask in masks)
    hits = f"if(size(same) >= {SPAN}, filter(sequence(0, size(same) - {SPAN}), i -> {is_hit}), cast(array() as array<int>))"
    # Agreeing words before each position, and after the last.
    sums = "aggregate(same, array(0), (sums, x) -> concat(sums, array(element_at(sums, -1) + int(x))))"
    passes = f"sums[b + {SPAN}] - sums[a] >= (b + {SPAN} - a) * {least_match!r}D"
    last = f"array_max(filter(hits, b -> b >= a and {passes}))"
    each = f"transform(hits, a -> struct({last} + {SPAN} - a as n_words, -a as start))"
    best = f"array_max(filter({each}, x -> x.n_words is not null))"

    def let(name: str, value: str, body: str) -> str:
        return f"transform(array({value}), {name} -> {body})[0]"

    found = f"if(best is null, null, struct(best.n_words as n_words, cast(first - best.start as int) as item_start))"
    return let("same", same, let("hits", hits, let("sums", sums, let("best", best, found))))


class _Bitmap:
    """Which hashes may be there: each sets two of a bounded number of bits."""

    def __init__(self, values: DataFrame, column: str) -> None:
        wanted = 32 * max(1, values.count())
        self.longs = min(_MOST_BITS, max(1 << 12, 1 << math.ceil(math.log2(wanted)))) // 64
        pairs = ", ".join(f"named_struct('at', {at}, 'bit', {bit})" for at, bit in self._places(column))
        each = values.select(F.expr(f"inline(array({pairs}))"))
        rows = each.groupBy("at").agg(F.expr("bit_or(shiftleft(1L, bit))").alias("bits"))
        bits = dict(rows.collect())  # at most ``longs`` rows
        # One literal, which the optimizer turns into an array before the query runs.
        listed = ",".join(str(bits.get(at, 0)) for at in range(self.longs))
        self.array = f"from_json('[{listed}]', 'array<bigint>')"

    def _places(self, value: str) -> list[tuple[str, str]]:
        """The two places of a hash, from bits of it that do not overlap."""
        return [
            (
                f"cast(shiftrightunsigned({value}, {skip + 6}) & {self.longs - 1} as int)",
                f"cast(shiftrightunsigned({value}, {skip}) & 63 as int)",
            )
            for skip in (0, 32)
        ]

    def holds(self, value: str) -> str:
        tests = (f"(shiftright({self.array}[{at}], {bit}) & 1L) = 1L" for at, bit in self._places(value))
        return "(" + " and ".join(tests) + ")"


def leaks(
    docs: DataFrame,
    items: DataFrame,
    *,
    least_match: float = 0.8,
    least_words: int = 13,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
) -> DataFrame:
    """One row per row of ``docs`` and item that it holds a passage of.

    Columns: row_id, row_hash (of the text), item_id, doc_start and item_start (word positions
    of the window of the passage's first hit), n_words (from there to the end of the last hit of
    the longest stretch that passes) and n_matched (words that agree along the whole item).
    """
    item_words = durable(
        items.select(
            F.col(item_column).alias("item_id"),
            word_hashes(text_of(item_text_column)).alias("words"),
            _once(),
        ).where((F.size("words") > 0) & (F.col("once") >= 0))
    )
    short = item_words.where(F.size("words") < SPAN).select(F.size("words").alias("n")).distinct()
    lengths = sorted(row.n for row in short.collect())  # fewer than SPAN
    of_short = (f"if(size(words) = {length}, {_whole(length)}, array())" for length in lengths)
    every = ", ".join([*(_windows(mask) for mask in range(len(MASKS))), *of_short])
    windows = item_words.select("item_id", F.expr(f"concat({every})").alias("windows"), _once())
    seeds = durable(windows.where("once >= 0").select("item_id", F.inline("windows")).withColumnRenamed("pos", "item_pos"))
    known_words = _Bitmap(item_words.select(F.explode("words").alias("word")).distinct(), "word")
    known_seeds = _Bitmap(seeds.select("hash").distinct(), "hash")

    rows = docs.select(
        F.col(id_column).cast("long").alias("row_id"),
        F.xxhash64(text_of(text_column)).alias("row_hash"),
        word_hashes(text_of(text_column)).alias("words"),
        _once(),
    )
    known = F.expr(f"transform(words, w -> {known_words.holds('w')})").alias("known")
    rows = rows.select(*_ROW, "words", known, _once("once"))
    found = []
    for mask in range(len(MASKS)):
        all_known = " and ".join(f"known[i + {at}]" for at in _selected(MASKS[mask]))
        found.append(f"filter({_windows(mask, where=all_known)}, w -> {known_seeds.holds('w.hash')})")
    for length in lengths:
        all_known = " and ".join(f"known[i + {at}]" for at in range(length))
        found.append(f"filter({_whole(length, where=all_known)}, w -> {known_seeds.holds('w.hash')})")
    hits = rows.select(*_ROW, "words", F.expr(f"concat({', '.join(found)})").alias("hits"), _once("once"))
    # A small share of all documents. Equal rows are searched once.
    hit = durable(hits.where((F.size("hits") > 0) & (F.col("once") >= 0)).drop("once").dropDuplicates(list(_ROW)))

    pairs = (
        hit.select(*_ROW, F.inline("hits"))
        .join(seeds, "hash")
        .groupBy(*_ROW, "item_id", (F.col("pos") - F.col("item_pos")).alias("shift"))
        .agg(F.min("item_pos").alias("first"), (F.max("item_pos") + SPAN).alias("last"))
    )
    same_row = [F.col(f"p.{name}").eqNullSafe(F.col(f"h.{name}")) for name in _ROW]
    with_words = (
        pairs.alias("p")
        .join(hit.alias("h"), same_row[0] & same_row[1])
        .select("p.*", F.col("h.words").alias("doc_words"))
        .join(item_words.select("item_id", "words").distinct(), "item_id")
        .withColumn("last", F.least("last", F.size("words")))  # a short item is its own window
    )
    # Counts of agreeing words from item word a to before b, where the document has a word.
    agree = "size(filter(sequence({a}, {b} - 1), j -> j + shift >= 0 and j + shift < size(doc_words) and doc_words[cast(j + shift as int)] = words[j]))"
    counted = with_words.select(
        *_ROW,
        "item_id",
        "shift",
        "first",
        "last",
        "words",
        "doc_words",
        F.expr(agree.format(a="first", b="last")).alias("near"),
        F.expr(agree.format(a="0", b="size(words)")).alias("n_matched"),
        F.least(F.lit(least_words), F.ceil(F.size("words") * F.lit(least_match))).alias("needed"),
        _once(),
    ).where((F.col("once") >= 0) & (F.col("n_matched") >= F.col("needed")))
    stretch = F.when(
        F.col("near") >= (F.col("last") - F.col("first")) * F.lit(least_match),
        F.struct((F.col("last") - F.col("first")).alias("n_words"), F.col("first").alias("item_start")),
    ).otherwise(F.expr(_longest_stretch(least_match)))
    verified = (
        counted.select(*_ROW, "item_id", "shift", "n_matched", stretch.alias("stretch"), _once())
        .where((F.col("once") >= 0) & F.col("stretch").isNotNull())
        .select(
            *_ROW,
            "item_id",
            (F.col("stretch.item_start") + F.col("shift")).cast("int").alias("doc_start"),
            "stretch.item_start",
            "stretch.n_words",
            "n_matched",
        )
    )
    best = F.max(F.struct("n_matched", "n_words", -F.col("doc_start"), -F.col("item_start"))).alias("best")
    return verified.groupBy(*_ROW, "item_id").agg(best).select(
        *_ROW,
        "item_id",
        (-F.col("best.col3")).alias("doc_start"),
        (-F.col("best.col4")).alias("item_start"),
        "best.n_words",
        "best.n_matched",
    )


def drop_leaking(
    docs: DataFrame, items: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", **options
) -> DataFrame:
    """``docs`` without the rows that hold a passage of an item; all columns stay, whatever they
    are called."""
    rows, id_column, text_column = numbered(docs), place(docs, id_column), place(docs, text_column)
    leaking = leaks(rows, items, id_column=id_column, text_column=text_column, **options)
    found = leaking.select("row_id", "row_hash").distinct()
    same = rows[id_column].cast("long").eqNullSafe(found["row_id"]) & (
        F.xxhash64(F.coalesce(rows[text_column], F.lit(""))) == found["row_hash"]
    )
    return rows.join(found, same, "left_anti").toDF(*docs.columns)
