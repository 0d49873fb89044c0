"""Token sequences of nearly equal length, packed by Karmarkar-Karp multiway differencing.

A document that is longer than the capacity gives full sequences of its own; what is left of it
is an item, or two equal ones if it is longer than half a sequence. The items of a group of
documents are packed together: each starts as a partial partition, one window holding it and the
others empty. The two partitions with the largest imbalance (longest less shortest window) are
merged again and again, the longest windows of one with the shortest of the other, so that
imbalances cancel out. If a window of the last partition exceeds the capacity, the number of
windows rises and the group is packed again.

A group is a run of rows of one partition with about ``group_tokens`` tokens, so packing needs
no shuffle and a task holds one group; text never waits for other partitions.

Nulls: a null text is empty and gives the end id alone; a null id stays null. Repeated rows are
packed each for itself. An empty table gives no sequences; other columns are not looked at.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tidemark.llm.common import id_of, id_or_null, text_of
from tidemark.llm.encoding import PieceEncoder

_NODE = 32  # bits of a node's number
_NODES = (1 << _NODE) - 1
PIECES = (
    "id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
)


def differencing(sizes: Sequence[int], windows: int) -> tuple[list[int], list[list[int]]]:
    """Sums of the windows, longest first, and the items of each, by merging partitions of opposed
    imbalance.

    A partition lists its windows that are not empty, shortest first, each as one number: its
    sum, and below that the node of a tree that holds its items.
    """
    n = len(sizes)
    left: list[int] = []  # the two halves of every inner node
    right: list[int] = []
    heap = [(-int(size), item, [int(size) << _NODE | item]) for item, size in enumerate(sizes)]
    heapq.heapify(heap)
    for turn in range(n, 2 * n - 1):
        _, _, a = heapq.heappop(heap)
        _, _, b = heapq.heappop(heap)
        # The longest windows of one meet the shortest of the other. Where both have one, the
        # shortest ``both`` of each are put together in opposite order; the others stay alone.
        both = max(0, len(a) + len(b) - windows)
        merged = a[both:] + b[both:]
        for x, y in zip(a[:both][::-1], b, strict=False):
            merged.append(((x >> _NODE) + (y >> _NODE)) << _NODE | (n + len(left)))
            left.append(x & _NODES)
            right.append(y & _NODES)
        merged.sort()  # a few runs in order, which costs little more than reading them
        shortest = merged[0] >> _NODE if len(merged) == windows else 0
        heapq.heappush(heap, (shortest - (merged[-1] >> _NODE), turn, merged))

    held = heap[0][2][::-1]
    items = []
    for window in held:
        open_, found = [window & _NODES], []
        while open_:
            if (at := open_.pop()) < n:
                found.append(at)
            else:
                open_ += [left[at - n], right[at - n]]
        items.append(sorted(found))
    return [window >> _NODE for window in held], items


def pack(sizes: list[int], capacity: int) -> list[list[int]]:
    """Windows of items, none over capacity; sizes must be from 1 to ``capacity``."""
    if not sizes:
        return []
    total = sum(sizes)
    windows = -(-total // capacity)
    while True:
        sums, items = differencing(sizes, windows)
        if sums[0] <= capacity:
            return items
        # As many as would do if the longest window kept its share of the total.
        windows = max(windows + 1, -(-windows * sums[0] // capacity))


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    *,
    capacity: int = 2048,
    group_tokens: int = 1 << 20,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per piece of a document: its ids, as little-endian unsigned 32-bit integers, from
    ``start`` of the document's ``doc_tokens``, and its sequence and offset in there."""
    rows = docs.select(id_of(id_column).alias("id"), text_of(text_column).alias("text"))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = PieceEncoder.shared(tokenizer)
        end = end_id.to_bytes(2, "little")
        next_sequence = TaskContext.get().partitionId() << 40
        out: list[tuple] = []
        items: list[tuple] = []  # id, start, ids, tokens of the document
        held = 0

        def packed() -> pd.DataFrame:
            nonlocal next_sequence, out, items, held
            for window in pack([len(item[2]) for item in items], capacity):
                offset = 0
                for item in (items[i] for i in window):
                    out.append((*item, next_sequence, offset))
                    offset += len(item[2])
                next_sequence += 1
            frame = pd.DataFrame(
                {
                    "id": [piece[0] for piece in out],
                    "start": [piece[1] for piece in out],
                    "length": [len(piece[2]) for piece in out],
                    "ids": [piece[2].astype("<u4").tobytes() for piece in out],
                    "doc_tokens": [piece[3] for piece in out],
                    "sequence_id": [piece[4] for piece in out],
                    "offset": [piece[5] for piece in out],
                }
            )
            out, items, held = [], [], 0
            return frame

        for batch in batches:
            for doc_id, text in zip(batch["id"], batch["text"], strict=True):
                ids = np.frombuffer(encoder.encode([text])[0] + end, dtype="<u2")
                tail = len(ids) - len(ids) % capacity
                for start in range(0, tail, capacity):
                    piece = ids[start : start + capacity]
                    out.append((doc_id, start, piece, len(ids), next_sequence, 0))
                    next_sequence += 1
                rest = len(ids) - tail
                middle = tail + (rest if 2 * rest <= capacity else -(-rest // 2))
                for start, stop in ((tail, middle), (middle, len(ids))):
                    if start < stop:
                        items.append((doc_id, start, ids[start:stop], len(ids)))
                held += len(ids)
                if held >= group_tokens:
                    yield packed()
        if out or items:
            yield packed()

    return rows.mapInPandas(place, PIECES).withColumn("id", id_or_null("id"))
