"""Near-duplicate groups of documents by the Hamming distance of SimHash fingerprints.

Distinct fingerprints are dealt to shards by vantage-point trees and searched in each shard by
smaller trees of the same kind. A node of a tree holds a vantage point and a radius: what lies
within the radius goes one way, the rest the other. By the triangle inequality a fingerprint can
only have neighbours on the far side if its own distance to the vantage point is within the
search radius of the boundary; only then is it sent there, too, as a query.

A search radius of 4 of 64 bits prunes little, as unrelated fingerprints lie at 32 +- 4 bits
from any vantage point. So there is one tree per block of bits, distances being counted inside
the block: two fingerprints within 4 bits are within 4 // 3 = 1 bit in one of three blocks. A
pair found in any block is then checked on all 64 bits. With ``blocks=1`` there is one tree over
whole fingerprints. Results are the same, and exact, for every number of blocks.

A shard returns a spanning forest of its links, never all pairs of a dense group, and exact
copies are one fingerprint before any search, so groups of any size stay small.

Nulls: a null text is empty. A text without words has fingerprint zero and is linked like any
other. A null id is never a component id unless all ids of its component are null. Repeated
rows are kept, each with its component. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import durable, id_of, id_or_null, numbered, one_in, place, text_of
from tidemark.llm.components import connected_components, join_by_few

SEED = 42
_BLOCK = 1 << 15
_LEAF = 192
_PAIRS = 1 << 21


def fingerprint(text: str, width: int) -> int:
    """Bit i is set if it is set in over half of the hashes of all shingles of ``width`` words."""
    import xxhash

    # Words end at space and at tab to carriage return, and only A-Z are lower-cased: what
    # bytes do by themselves.
    words = text.encode().lower().split()
    n = max(1, len(words) - width + 1) if words else 0
    if n == 0:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[: n - 1] + 1))
    ends = ends[-n:]
    counts = np.zeros(64, np.int64)
    for at in range(0, n, _BLOCK):
        spans = zip(starts[at : at + _BLOCK].tolist(), ends[at : at + _BLOCK].tolist(), strict=True)
        hashes = [xxhash.xxh64_intdigest(joined[i:j], SEED) for i, j in spans]
        bits = np.array(hashes, np.uint64).view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(bits, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(
    docs: DataFrame, width: int, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """(id, text_hash, fp) per row; ``fp`` holds the 64 bits as a signed number."""
    rows = numbered(docs).select(
        id_of(place(docs, id_column)).alias("id"), text_of(place(docs, text_column)).alias("text")
    ).withColumn("text_hash", F.xxhash64("text"))

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            fps = np.array([fingerprint(text, width) for text in batch["text"]], np.uint64)
            yield batch[["id", "text_hash"]].assign(fp=fps.view(np.int64))

    signed = rows.mapInPandas(sign, "id long, text_hash long, fp long")
    return signed.select(id_or_null("id"), "text_hash", "fp")


# Trees


@dataclass
class Node:
    """A split by the distance to ``vantage``, or a leaf of one or more slots."""

    vantage: int = 0
    radius: int = 0
    near: Node | None = None
    far: Node | None = None
    first_slot: int = 0
    slots: int = 0


@dataclass
class Tree:
    mask: int
    reach: int  # the search radius inside the block
    root: Node


def block_masks(blocks: int) -> list[int]:
    edges = [64 * i // blocks for i in range(blocks + 1)]
    return [(1 << hi) - (1 << lo) for lo, hi in zip(edges, edges[1:], strict=False)]


def _distances(points: np.ndarray, vantage: int, mask: int) -> np.ndarray:
    return np.bitwise_count((points ^ np.uint64(vantage)) & np.uint64(mask))


def _best_split(points: np.ndarray, mask: int, reach: int, tries: int) -> tuple | None:
    """The vantage point and radius whose larger side, with the queries sent to it, is smallest."""
    best, n = None, len(points)
    for vantage in points[:: max(1, n // tries)][:tries].tolist():
        below = np.cumsum(np.bincount(_distances(points, vantage, mask), minlength=66))
        for radius in range(64):
            inside = below[radius]
            if inside < n / 16 or n - inside < n / 16:
                continue
            larger = max(below[min(65, radius + reach)], n - (below[radius - reach] if radius >= reach else 0))
            if larger < 0.9 * n and (best is None or larger < best[0]):
                best = (larger, vantage, radius)
    return best and best[1:]


def build_trees(
    sample: np.ndarray, total: int, max_distance: int, blocks: int, per_shard: int
) -> tuple[list[Tree], int]:
    """One tree per block, split until a leaf is expected to hold ``per_shard`` fingerprints.

    A leaf that cannot be split gets several slots, so that no task holds more than its share.
    """
    slots = 0

    def grow(points: np.ndarray, mask: int, reach: int) -> Node:
        nonlocal slots
        expected = total * len(points) / max(1, len(sample))
        if expected > per_shard and len(points) >= 16 and (split := _best_split(points, mask, reach, 8)):
            inside = _distances(points, split[0], mask) <= split[1]
            near, far = grow(points[inside], mask, reach), grow(points[~inside], mask, reach)
            return Node(*split, near, far)
        leaf = Node(first_slot=slots, slots=max(1, round(expected / per_shard)))
        slots += leaf.slots
        return leaf

    reach = max_distance // blocks
    trees = [Tree(mask, reach, grow(sample, mask, reach)) for mask in block_masks(blocks)]
    return trees, slots


def _homes(points: np.ndarray, tree: Tree) -> np.ndarray:
    """The slot in which each point is kept."""
    slots = np.zeros(len(points), np.int64)

    def walk(node: Node, rows: np.ndarray) -> None:
        if not len(rows):
            return
        if node.slots:
            spread = (points[rows] * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)
            slots[rows] = node.first_slot + (spread % np.uint64(node.slots)).astype(np.int64)
            return
        inside = _distances(points[rows], node.vantage, tree.mask) <= node.radius
        walk(node.near, rows[inside])
        walk(node.far, rows[~inside])

    walk(tree.root, np.arange(len(points)))
    return slots


def _visits(points: np.ndarray, homes: np.ndarray, tree: Tree) -> Iterator[tuple[np.ndarray, int]]:
    """Rows to send as queries to a slot: of each pair, the one with the lower home visits."""

    def walk(node: Node, rows: np.ndarray) -> Iterator[tuple[np.ndarray, int]]:
        if not len(rows):
            return
        if node.slots:
            for slot in range(node.first_slot, node.first_slot + node.slots):
                if len(visitors := rows[homes[rows] < slot]):
                    yield visitors, slot
            return
        distance = _distances(points[rows], node.vantage, tree.mask).astype(np.int64)
        yield from walk(node.near, rows[distance <= node.radius + tree.reach])
        yield from walk(node.far, rows[distance > node.radius - tree.reach])

    yield from walk(tree.root, np.arange(len(points)))


# Search inside a shard


class Forest:
    """Links, cut down to a spanning forest whenever many have come together."""

    def __init__(self) -> None:
        self.a: list[np.ndarray] = []
        self.b: list[np.ndarray] = []
        self.held = 0

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        self.a.append(a)
        self.b.append(b)
        self.held += len(a)
        if self.held > _PAIRS:
            nodes, roots = self.stars()
            self.a, self.b, self.held = [nodes], [roots], len(nodes)

    def stars(self) -> tuple[np.ndarray, np.ndarray]:
        """Each node that has a smaller one in its component, and the smallest."""
        if not self.held:
            return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        a, b = np.concatenate(self.a), np.concatenate(self.b)
        nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
        a, b = at[: len(a)], at[len(a) :]
        label = np.arange(len(nodes))
        while (label[a] != label[b]).any():
            low = np.minimum(label[a], label[b])
            np.minimum.at(label, label[a], low)
            np.minimum.at(label, label[b], low)
            while (label[label] != label).any():
                label = label[label]
        moved = label != np.arange(len(nodes))
        return nodes[moved], nodes[label[moved]]


def link(data: np.ndarray, queries: np.ndarray, mask: int, reach: int, most: int, found: Forest) -> None:
    """Links inside ``data`` and from ``queries`` to it that are within ``reach`` in the block."""
    if len(data) > _LEAF and (split := _best_split(data, mask, reach, 3)):
        vantage, radius = split
        of_data = _distances(data, vantage, mask).astype(np.int64)
        of_queries = _distances(queries, vantage, mask).astype(np.int64)
        inside = of_data <= radius
        link(data[inside], queries[of_queries <= radius + reach], mask, reach, most, found)
        across = data[inside & (of_data > radius - reach)]
        beyond = np.concatenate([queries[of_queries > radius - reach], across])
        link(data[~inside], beyond, mask, reach, most, found)
        return
    step = max(1, _PAIRS // max(1, len(data)))
    for at in range(0, len(data), step):
        near = np.bitwise_count(data[at : at + step, None] ^ data[None, at:]) <= most
        i, j = np.nonzero(near)
        apart = i < j
        found.add(data[at + i[apart]], data[at + j[apart]])
    for at in range(0, len(queries), step):
        i, j = np.nonzero(np.bitwise_count(queries[at : at + step, None] ^ data[None, :]) <= most)
        found.add(queries[at + i], data[j])


def near_links(
    distinct: DataFrame,
    max_distance: int,
    *,
    blocks: int = 3,
    per_shard: int = 8192,
    sample_size: int = 1 << 16,
) -> DataFrame:
    """Links (a, b) that connect just those distinct fingerprints ``fp`` which are near.

    The trees are fitted to one in eight fingerprints, or about ``sample_size`` of them if those
    are fewer; every fingerprint is dealt and searched. Only fitted trees are sent to the tasks.
    """
    total = distinct.count()
    # Chosen by a hash, so the same for any order of rows. Fingerprints are distinct.
    chosen = one_in(distinct.select("fp"), max(8, -(-total // sample_size)), "fp")
    sample = np.sort(chosen.toPandas()["fp"].to_numpy(np.int64)).view(np.uint64)
    sample = np.random.default_rng(1).permutation(sample)
    trees, slots = build_trees(sample, total, max_distance, blocks, per_shard)
    first = [_first_slot(tree.root) for tree in trees]

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            points = batch["fp"].to_numpy(np.int64).view(np.uint64)
            for tree in trees:
                homes = _homes(points, tree)
                visits = list(_visits(points, homes, tree))
                rows = np.concatenate([np.arange(len(points)), *(rows for rows, _ in visits)])
                away = [np.full(len(rows), slot) for rows, slot in visits]
                slot = np.concatenate([homes, *away])
                home = np.arange(len(slot)) < len(points)
                yield pd.DataFrame({"slot": slot, "fp": points[rows].view(np.int64), "home": home})

    def search(shard: pd.DataFrame) -> pd.DataFrame:
        tree = trees[int(np.searchsorted(first, shard["slot"].iloc[0], side="right")) - 1]
        points, home = shard["fp"].to_numpy(np.int64).view(np.uint64), shard["home"].to_numpy(bool)
        found = Forest()
        link(np.sort(points[home]), np.sort(points[~home]), tree.mask, tree.reach, max_distance, found)
        a, b = found.stars()
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    shards = distinct.mapInPandas(deal, "slot long, fp long, home boolean").groupBy("slot")
    return shards.applyInPandas(search, "a long, b long")


def _first_slot(node: Node) -> int:
    return node.first_slot if node.slots else _first_slot(node.near)


def near_duplicates(
    docs: DataFrame,
    *,
    width: int = 4,
    max_distance: int = 4,
    id_column: str = "doc_id",
    text_column: str = "text",
    **search: int,
) -> DataFrame:
    """(id, text_hash, fp, component, component_id) per row of ``docs``.

    ``component_id`` is the smallest id that occurs in the component, and ``component`` the
    fingerprint, as a signed number, which has it, or the smallest of those: never null.
    """
    signed = durable(fingerprints(docs, width, id_column, text_column))
    distinct = durable(signed.groupBy("fp").agg(F.min("id").alias("least_id"), F.count("*").alias("n")))
    # A node is named by its least id first, a missing one coming last. So the smallest node of a
    # component says its id, and no stage has to bring all nodes of a component together.
    unknown = F.col("least_id").isNull()
    node = F.struct(unknown.alias("unknown"), F.coalesce("least_id", F.lit(0)).alias("id"), "fp")
    named = distinct.select("fp", node.alias("node"), "n")
    links = durable(near_links(distinct, max_distance, **search))
    n_links = links.count()
    # A few fingerprints may have most of the links, or most of the rows.
    for end in ("a", "b"):
        counts = links.groupBy(F.col(end).alias("fp")).agg(F.count("*").alias("n"))
        found = named.drop("n").join(counts, "fp").withColumnsRenamed({"fp": end, "node": f"node_{end}"})
        links = join_by_few(links, found, end, n_links)
    grouped = connected_components(links.select(F.col("node_a").alias("a"), F.col("node_b").alias("b")))
    of_fp = named.join(grouped, "node", "left").select(
        "fp", F.coalesce("component", "node").alias("least"), "n"
    )
    component_id = F.when(~F.col("least.unknown"), F.col("least.id"))
    return join_by_few(signed, of_fp, "fp", signed.count()).select(
        "id", "text_hash", "fp", F.col("least.fp").alias("component"), component_id.alias("component_id")
    )


def keep_one_of_each(
    docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", **options: int
) -> DataFrame:
    """The rows of ``docs`` with one row per component: that of the smallest id, then text hash.

    A null id comes last. All columns stay, whatever they are called.
    """
    groups = near_duplicates(docs, id_column=id_column, text_column=text_column, **options)
    best = F.min(F.struct(F.col("id").isNull().alias("unknown"), "id", "text_hash")).alias("best")
    kept = groups.groupBy("component").agg(best).select(
        F.coalesce("best.id", F.lit(0)).alias("row_id"),
        F.col("best.unknown").alias("row_unknown"),
        F.col("best.text_hash").alias("row_hash"),
    )
    keys = kept.columns
    row_id = F.col(place(docs, id_column)).cast("long")
    rows = numbered(docs).withColumns(
        {
            "row_id": F.coalesce(row_id, F.lit(0)),
            "row_unknown": row_id.isNull(),
            "row_hash": F.xxhash64(text_of(place(docs, text_column))),
        }
    )
    # Repeated rows have the same key and meet again without a further shuffle.
    once = rows.join(kept, keys, "left_semi").dropDuplicates(keys)
    return once.select(*numbered(docs).columns).toDF(*docs.columns)
