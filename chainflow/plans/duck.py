"""DuckDB expression helpers for oracle SQL (mirrors of chainflow.functions)."""

from __future__ import annotations


def vwd(v: str, d) -> str:
    """value / 10^d as exact text (mirror of scalar.value_with_decimals).

    ``d`` is an int or a SQL expression.
    """
    if isinstance(d, int) and d <= 0:
        return v
    p = f"lpad({v}, cast(greatest(length({v}), {d} + 1) AS integer), '0')"
    shifted = f"(left({p}, length({p}) - {d}) || '.' || right({p}, {d}))"
    out = f"regexp_replace(regexp_replace({shifted}, '0+$', ''), '\\.$', '')"
    return out if isinstance(d, int) else f"CASE WHEN {d} <= 0 THEN {v} ELSE {out} END"


def part(topic: str, i: int) -> str:
    """1-based dot segment, NULL when absent (mirror of scalar.topic_part)."""
    return (f"CASE WHEN len(string_split({topic}, '.')) >= {i} "
            f"THEN string_split({topic}, '.')[{i}] END")


def arity(topic: str) -> str:
    return f"len(string_split({topic}, '.'))"


# Valid webhook deliveries: every order whose body is not truncated, twice
# when it is one of the repeated messages (mirror of feeds.webhook_raw).
DELIVERIES = """(SELECT t.*, r.copy FROM orders_tx t
  JOIN (SELECT 1 AS copy UNION ALL SELECT 2 AS copy) r
    ON r.copy = 1 OR t.orderKey % 10 = 0
  WHERE t.orderKey % 97 <> 0)"""
