"""Connected components of a distributed list of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import durable

_HOT_KEYS = 1000


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b); the component is its smallest node.

    Alternates large-star and small-star steps until nothing changes: each step replaces links
    by links to the smallest neighbour, so their number never grows, and a node with many links
    is met only by a minimum, which combines before the shuffle, and by a broadcast of the few
    nodes of that kind.
    """
    stars = durable(_ordered(links.select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi"))))
    before = None
    while (now := _digest(stars)) != before:
        before, n = now, now[0]
        passed_on = durable(_large_star(stars, n))  # read several times
        stars = durable(_small_star(passed_on, n))
    nodes = stars.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
    roots = stars.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
    return nodes.unionByName(roots)


def join_by_few(rows: DataFrame, of_keys: DataFrame, key: str, n_rows: int) -> DataFrame:
    """``rows`` joined with a table of one row per key, which tells in ``n`` how many rows a key has.

    Keys of more than one in 1000 of the ``n_rows`` rows are broadcast, of which there are fewer
    than 1000, so that their rows stay where they are; all other rows meet in a shuffle. ``rows``
    is read twice.
    """
    hot = F.broadcast(of_keys.where(F.col("n") * _HOT_KEYS > n_rows).drop("n"))
    others = rows.join(hot.select(key), key, "left_anti")
    return rows.join(hot, key).unionByName(others.join(of_keys.drop("n"), key))


def _large_star(stars: DataFrame, n: int) -> DataFrame:
    """Each node passes its larger neighbours on to its smallest neighbour, or itself."""
    larger = stars.select(F.col("lo").alias("at"), F.col("hi").alias("other"))
    both = larger.unionByName(stars.select(F.col("hi").alias("at"), F.col("lo").alias("other")))
    least = both.groupBy("at").agg(
        F.min("other").alias("least"), F.count_if(F.col("other") > F.col("at")).alias("n")
    )
    passed = join_by_few(larger, least, "at", n)
    return _ordered(passed.select(F.least("at", "least").alias("lo"), F.col("other").alias("hi")))


def _small_star(stars: DataFrame, n: int) -> DataFrame:
    """Each node links its smaller neighbours, and itself, to the smallest of them.

    ``n`` is the number of ``stars`` or more.
    """
    least = stars.groupBy("hi").agg(F.min("lo").alias("least"), F.count("*").alias("n"))
    joined = join_by_few(stars, least, "hi", n)
    smaller = joined.select(F.col("least").alias("lo"), F.col("lo").alias("hi"))
    return _ordered(smaller.unionByName(least.select(F.col("least").alias("lo"), "hi")))


def _ordered(links: DataFrame) -> DataFrame:
    return links.where("lo < hi").distinct()


def _digest(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("lo", "hi"))).first())
