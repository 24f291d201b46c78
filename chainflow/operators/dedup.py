"""Re-emit suppression (T01 / F12) and message dedup."""

from __future__ import annotations

from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

_LONGS = StructType([StructField("_entry", ArrayType(LongType())), StructField("_exit", ArrayType(LongType()))])


def suppress_recent(sightings: DataFrame, keys: list[str], ts: str, interval_s: int,
                    tiebreak: list[str] | None = None, segment_s: int | None = None) -> DataFrame:
    """Emit a sighting iff its key was never emitted or was last *emitted* at
    least ``interval_s`` earlier (T01).

    The rule depends on the last emitted time, not the last seen one.  A key's time is cut into segments, each
    handled by itself, so that a hot key is spread over tasks:

    1. Of a key's sightings in one second the first (by ``tiebreak``) can be emitted; the others go, map-side first.
    2. A segment has a *transfer function*: entry state -> exit state, where a state is the last
       emitted time.  An entry state decides which sighting of the segment's first ``interval_s`` seconds is emitted first;
       from there on pointers to the next emitted sighting lead to the last one.  That is a table of ``interval_s`` rows at most.
    3. The tables are composed in order of the segments, key by key; this scan sees tables, not sightings.
    4. Each segment emits its sightings from the entry state that it turned out to have.

    Times are whole seconds; rows without a time are left out; an interval of 0 emits all.
    """
    tiebreak = tiebreak or []
    cols = [*keys, ts, *tiebreak]
    seen = sightings.select(*cols).filter(F.col(ts).isNotNull())
    if interval_s <= 0:
        return seen
    segment_s = segment_s or max(8 * interval_s, 3600)
    if tiebreak:
        first = seen.groupBy(*keys, ts).agg(F.min(F.struct(*tiebreak)).alias("_first")).select(*keys, ts, "_first.*")
    else:
        first = seen.distinct()
    segments = first.groupBy(*keys, F.floor(F.col(ts) / segment_s).cast("long").alias("_segment")).agg(
        F.array_sort(F.collect_list(F.struct(ts, *tiebreak))).alias("_rows"))
    n = len(keys)

    def times_of(rows: pa.ListArray):
        """(start, end, times) of each list, in the flat child array."""
        offsets = rows.offsets.to_numpy()
        times = rows.values.field(0).to_numpy(zero_copy_only=False)
        return [(a, b, times[a:b]) for a, b in zip(offsets.tolist(), offsets.tolist()[1:])]

    def transfer(batches):
        for batch in batches:
            entries, exits = [], []
            for (_, _, t), segment in zip(times_of(batch.column(n + 1)), batch.column(n).to_pylist()):
                m = len(t)
                after = np.searchsorted(t, t + interval_s)
                last = np.where(after < m, after, np.arange(m))
                while (last[last] != last).any():
                    last = last[last]
                enough = int(np.searchsorted(t, segment * segment_s + interval_s)) + 1
                entries.append(t[:enough].tolist())
                exits.append(t[last[:enough]].tolist())
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:n + 1], pa.array(entries, longs), pa.array(exits, longs)],
                                             [*keys, "_segment", "_entry", "_exit"])

    def compose(batches):
        key, last = None, None
        for batch in batches:
            states = []
            for *own, entry, exit_ in zip(*(c.to_pylist() for c in (*batch.columns[:n], *batch.columns[n + 1:]))):
                if own != key:
                    key, last = own, None
                states.append(last)
                at = 0 if last is None else int(np.searchsorted(entry, last + interval_s))
                if at < len(entry):
                    last = exit_[at]
            yield pa.RecordBatch.from_arrays([*batch.columns[:n + 1], pa.array(states, pa.int64())], [*keys, "_segment", "_last"])

    def emit(batches):
        for batch in batches:
            owner, picked = [], []
            for i, ((start, _, t), last) in enumerate(zip(times_of(batch.column(n)), batch.column(n + 1).to_pylist())):
                at = 0 if last is None else int(np.searchsorted(t, last + interval_s))
                while at < len(t):
                    owner.append(i)
                    picked.append(start + at)
                    at = int(np.searchsorted(t, t[at] + interval_s))
            rows = batch.column(n).values.take(pa.array(picked, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*(c.take(pa.array(owner, pa.int64())) for c in batch.columns[:n]), *rows.flatten()], cols)

    fields = {f.name: f for f in segments.schema.fields}
    head = StructType([fields[k] for k in (*keys, "_segment")])
    tables = segments.mapInArrow(transfer, StructType([*head.fields, *_LONGS.fields]))
    states = (tables.repartition(*keys).sortWithinPartitions(*keys, "_segment")
              .mapInArrow(compose, StructType([*head.fields, StructField("_last", LongType())])))
    left, right = segments.alias("l"), states.alias("r")
    same = reduce(and_, [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in (*keys, "_segment")])
    entered = left.join(right, same).select(*(f"l.{k}" for k in keys), "l._rows", "r._last")
    return entered.mapInArrow(emit, seen.schema)


def dedup_message(df: DataFrame, key: str = "messageId", first_by: str | None = None) -> DataFrame:
    """Batch form of T02: one row per message id.

    With ``first_by`` the earliest delivery is kept via ``min_by`` (partial
    aggregation, and the same row on every retry of a lost task); without it
    Spark's ``dropDuplicates`` keeps any one copy.
    """
    if first_by is None:
        return df.dropDuplicates([key])
    others = [c for c in df.columns if c != key]
    first = df.groupBy(key).agg(F.min_by(F.struct(*others), F.struct(first_by, *others)).alias("_r"))
    return first.select(key, "_r.*")


def dedup_message_stream(df: DataFrame, key: str, event_time: str, delay: str = "10 minutes") -> DataFrame:
    """Streaming form of T02: dedup within the watermark; state is evicted."""
    return df.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key])
