"""Row ids of the raw trade table."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SEPARATOR = "\x1f"
_NULL_MARK = "\x1e"


def stable_id(*identity: Column) -> Column:
    """Hash of the identifying columns: a replayed row gets the same id again.

    Put the message identity (topic, partition, offset; or file and line) and the position
    inside the message first, or equal trades of different messages share an id.
    """
    # concat_ws leaves nulls out, which would let ("a", null, "b") and ("a", "b") meet.
    parts = [F.coalesce(c.cast("string"), F.lit(_NULL_MARK)) for c in identity]
    return F.sha2(F.concat_ws(_SEPARATOR, *parts), 256)


def random_id() -> Column:
    """A UUID per row. Replays give new ids, so a replayed batch appears as new rows."""
    return F.expr("uuid()")


def event_time_id(ts: Column) -> Column:
    """Event time as text: all trades of one millisecond share the id."""
    return ts.cast("string")
