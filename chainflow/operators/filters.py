"""Filters and predicates (F01-F12).  All push down or stay narrow."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chainflow.functions import scalar as C


def nonempty_id(df: DataFrame, col: str = "subnetId") -> DataFrame:
    """Skip rows with an empty or missing id."""
    return df.filter(F.col(col).isNotNull() & (F.col(col) != ""))


def topic_arity_filter(df: DataFrame, topic: str = "topic", min_parts: int = 3) -> DataFrame:
    """Keep topics with at least ``min_parts`` dot segments."""
    return df.filter(C.topic_arity(topic) >= min_parts)


def time_range(df: DataFrame, ts: str, start: int | None = None, end: int | None = None) -> DataFrame:
    """Half-open ``[start, end)`` on Unix seconds; a bound ≤ 0 or None is open."""
    cond = F.lit(True)
    if start is not None and start > 0:
        cond = cond & (F.col(ts) >= start)
    if end is not None and end > 0:
        cond = cond & (F.col(ts) < end)
    return df.filter(cond)


def block_range(df: DataFrame, start: int | None = None, end: int | None = None,
                col: str = "blockNumber") -> DataFrame:
    """Inclusive ``[start, end]`` on block numbers; a bound ≤ 0 or None is open."""
    n = F.col(col).cast("bigint")
    cond = F.lit(True)
    if start is not None and start > 0:
        cond = cond & (n >= start)
    if end is not None and end > 0:
        cond = cond & (n <= end)
    return df.filter(cond)


def event_signature(logs: DataFrame, signatures: list[str], topic0: str = "topic0") -> DataFrame:
    """Keep logs whose topic0 is listed; an empty list keeps all."""
    if not signatures:
        return logs
    return logs.filter(F.lower(F.col(topic0)).isin([s.lower() for s in signatures]))


def has_event_signature(logs_col: str, signatures: list[str]) -> Column:
    """Transaction-level form of F10: any nested log carries a listed topic0."""
    if not signatures:
        return F.lit(True)
    sigs = [s.lower() for s in signatures]
    return F.exists(F.coalesce(F.col(logs_col), F.array()),
                    lambda l: F.lower(l["topic0"]).isin(sigs))


def signature_gate(df: DataFrame, enforce: bool = False, flag: str = "signature_valid") -> DataFrame:
    """Drop bad-signature rows only when enforcing; lenient by default."""
    return df.filter(F.col(flag)) if enforce else df


def newheads_filter(decoded: DataFrame) -> DataFrame:
    """F02 (see sources.decode.newheads_filter)."""
    from chainflow.sources.decode import newheads_filter as _f
    return _f(decoded)
