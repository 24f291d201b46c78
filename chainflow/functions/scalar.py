"""Scalar functions (C01-C13), all as built-in Column expressions.

Nothing here runs Python per row: each function returns a Column that stays
inside whole-stage codegen.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DIGITS = r"^[0-9]+$"
LIMB = 26                       # digits per limb of a 78-digit (256-bit) amount
LIMB_BASE = 10 ** LIMB
_DEC = "decimal(38,0)"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with ``columns``, each computed once a row.

    The planner moves a filter below the columns it reads, and computes them there a second time.
    It does not move one below a generator; this one makes one row of each row.
    """
    return df.select("*", F.inline(F.array(F.struct(*(c.alias(n) for n, c in columns.items())))))


# --- C01 / C02: webhook signatures -----------------------------------------

def _hmac_pads(secret: str) -> tuple[bytes, bytes]:
    """HMAC-SHA256 inner/outer key pads (RFC 2104), made once on the driver."""
    key = secret.encode("utf-8")
    if len(key) > 64:
        key = hashlib.sha256(key).digest()
    key = key.ljust(64, b"\0")
    return bytes(b ^ 0x36 for b in key), bytes(b ^ 0x5C for b in key)


def hmac_sha256_hex(body, secret: str) -> Column:
    """hex(HMAC-SHA256(body, secret)) from two sha2 calls; body is text or binary."""
    ipad, opad = _hmac_pads(secret)
    data = _c(body).cast("binary")
    inner = F.unhex(F.sha2(F.concat(F.lit(ipad), data), 256))
    return F.sha2(F.concat(F.lit(opad), inner), 256)


def signature_of(body, secret: str) -> Column:
    """The header value a correct sender puts: ``sha256=<hex>``."""
    return F.concat(F.lit("sha256="), hmac_sha256_hex(body, secret))


def signature_header(*headers) -> Column:
    """First non-empty of the candidate signature headers."""
    return F.coalesce(*[F.nullif(_c(h), F.lit("")) for h in headers])


def signature_valid(body, header, secret: str) -> Column:
    """True iff the header equals the expected signature; NULL header -> False."""
    return F.coalesce(_c(header) == signature_of(body, secret), F.lit(False))


# --- C03 / C04: exact amounts ------------------------------------------------

def uint(x) -> Column:
    """Digit string -> decimal(38,0); NULL when not digits or wider than 38."""
    s = _c(x)
    return F.when(s.rlike(DIGITS), s.try_cast(_DEC))


def uint256_limbs(x) -> list[Column]:
    """Split a digit string (≤ 78 digits) into three 26-digit decimal limbs."""
    s = F.when(_c(x).rlike(DIGITS) & (F.length(_c(x)) <= 3 * LIMB), F.lpad(_c(x), 3 * LIMB, "0"))
    return [F.substring(s, 1 + i * LIMB, LIMB).try_cast(_DEC) for i in range(3)]


def uint256_sum(x) -> Column:
    """Exact sum of 256-bit digit strings as a digit string (aggregate).

    Each limb is summed in decimal(38,0), leaving 12 digits of headroom for
    carries (10^12 rows per group), then carries are propagated low to high.
    """
    hi, mid, lo = (F.sum(limb) for limb in uint256_limbs(x))
    base = F.lit(str(LIMB_BASE)).cast(_DEC)

    def carry(total):
        rest = total % base
        # total - rest is a multiple of the base, so the division is exact
        return ((total - rest) / base).cast(_DEC), rest

    lo_carry, lo_rest = carry(lo)
    mid_carry, mid_rest = carry(mid + lo_carry)
    hi_total = (hi + mid_carry).cast(_DEC)
    text = F.concat(hi_total.cast("string"),
                    F.lpad(mid_rest.cast(_DEC).cast("string"), LIMB, "0"),
                    F.lpad(lo_rest.cast(_DEC).cast("string"), LIMB, "0"))
    stripped = F.regexp_replace(text, "^0+", "")
    return (F.when(hi.isNull(), F.lit(None).cast("string"))
            .when(stripped == "", F.lit("0")).otherwise(stripped))


def _digits_of(totals: list[Column], width: int) -> Column:
    """Limb totals, highest first -> digit string; each total keeps its low
    ``width`` digits and carries the rest up (one fold, so the plan stays linear)."""
    base = F.lit(str(10 ** width)).cast(_DEC)
    start = F.struct(F.lit(0).cast(_DEC).alias("carry"), F.lit("").alias("text"))

    def step(acc, limb):
        total = (limb + acc["carry"]).cast(_DEC)
        rest = (total % base).cast(_DEC)
        # total - rest is a multiple of the base, so the division is exact
        return F.struct(((total - rest) / base).cast(_DEC).alias("carry"),
                        F.concat(F.lpad(rest.cast("string"), width, "0"), acc["text"]).alias("text"))

    text = F.aggregate(F.array(*reversed(totals)), start, step,
                       lambda acc: F.concat(acc["carry"].cast("string"), acc["text"]))
    return F.regexp_replace(text, "^0+(?=.)", "")


def _limbs(x, n: int, width: int) -> list[Column]:
    s = F.when(_c(x).rlike(DIGITS) & (F.length(_c(x)) <= n * width), F.lpad(_c(x), n * width, "0"))
    return [F.substring(s, 1 + i * width, width).try_cast(_DEC) for i in range(n)]


def digits_sum(x, digits: int) -> Column:
    """Exact sum of digit strings of up to ``digits`` digits, as text (aggregate)."""
    return _digits_of([F.sum(limb) for limb in _limbs(x, -(-digits // LIMB), LIMB)], LIMB)


def digits_times(x, factor, digits: int = 104) -> Column:
    """Exact product of a digit string and a whole decimal of up to 27 digits, as text."""
    f = _c(factor).cast("decimal(27,0)")
    return _digits_of([(limb.cast("decimal(10,0)") * f).cast(_DEC) for limb in _limbs(x, -(-digits // 10), 10)], 10)


def value_with_decimals(value, decimals) -> Column:
    """``value / 10^decimals`` as exact text, by moving the decimal point."""
    v, d = _c(value), _c(decimals)
    padded = F.lpad(v, F.greatest(F.length(v), d + 1), F.lit("0"))
    n = F.length(padded)
    int_part = padded.substr(F.lit(1), n - d)
    frac = padded.substr(n - d + 1, d)
    shifted = F.concat(int_part, F.lit("."), frac)
    trimmed = F.regexp_replace(F.regexp_replace(shifted, "0+$", ""), r"\.$", "")
    return F.when(~v.rlike(DIGITS), F.lit(None).cast("string")) \
        .when(d <= 0, v).otherwise(trimmed)


# --- C05 - C08: numbers, times, durations -----------------------------------

def hex_quantity(x) -> Column:
    """``0x``-prefixed hex quantity -> bigint (≤ 63 bits; leading zeros allowed)."""
    s = _c(x)
    return F.when(s.rlike("^0[xX]0*([0-9a-fA-F]{1,15}|[1-7][0-9a-fA-F]{15})$"),
                  F.conv(F.regexp_replace(s, "^0[xX]0*(?=.)", ""), 16, 10).cast("bigint"))


def to_hex_quantity(x) -> Column:
    return F.concat(F.lit("0x"), F.lower(F.hex(_c(x).cast("bigint"))))


def epoch_to_ts(x) -> Column:
    return F.timestamp_seconds(_c(x))


def ts_to_epoch(x) -> Column:
    return F.unix_seconds(_c(x).cast("timestamp"))


def rfc3339(ts) -> Column:
    """RFC 3339 text of a UTC timestamp (``...Z``), as Go's Time.Format."""
    return F.date_format(_c(ts).cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ssXXX")


def go_duration(seconds) -> Column:
    """Whole seconds as Go's Duration.String(): 1800 -> 30m0s, 3600 -> 1h0m0s."""
    s = _c(seconds).cast("bigint")
    h, m, r = F.floor(s / 3600), F.floor(s % 3600 / 60), s % 60
    hs, ms, rs = (c.cast("string") for c in (h, m, r))
    return (F.when(h > 0, F.concat(hs, F.lit("h"), ms, F.lit("m"), rs, F.lit("s")))
            .when(m > 0, F.concat(ms, F.lit("m"), rs, F.lit("s")))
            .otherwise(F.concat(rs, F.lit("s"))))


# --- C09 - C12: topics, JSON, time buckets ----------------------------------

def topic_part(topic, index: int) -> Column:
    """1-based dot-separated segment of a topic name; NULL when absent."""
    return F.try_element_at(F.split(_c(topic), r"\."), F.lit(index))


def topic_arity(topic) -> Column:
    return F.size(F.split(_c(topic), r"\."))


def wildcard_regex(pattern: str) -> str:
    """``a.b.*`` -> ``^a\\.b\\.[^.]+$``: one ``*`` stands for one dot-free segment."""
    parts = pattern.split(".")
    out = []
    for p in parts:
        out.append("[^.]+" if p == "*" else "".join("\\" + ch if not ch.isalnum() and ch != "_" else ch for ch in p))
    return "^" + r"\.".join(out) + "$"


def json_decode(text, schema: str) -> Column:
    return F.from_json(_c(text), schema)


def json_encode(struct, keep_nulls: bool = False) -> Column:
    opts = {"ignoreNullFields": "false"} if keep_nulls else {}
    return F.to_json(_c(struct), opts)


GRAINS = ("hour", "day", "week", "month")


def interval_trunc(ts, grain: str) -> Column:
    if grain not in GRAINS:
        raise ValueError(f"grain must be one of {GRAINS}")
    return F.date_trunc(grain, _c(ts).cast("timestamp"))


# --- C13: transaction participants ------------------------------------------

def tx_participants(tx: str | None = None) -> Column:
    """Distinct non-empty lower-cased addresses touched by one transaction.

    From/to of the transaction, both parties of every transfer and internal
    transaction, and each log's emitting address.
    """
    p = (tx + ".") if tx else ""

    def parties(arr):
        return F.flatten(F.transform(F.coalesce(F.col(p + arr), F.array()),
                                     lambda x: F.array(x["from"], x["to"])))

    every = F.flatten(F.array(
        F.array(F.col(p + "from"), F.col(p + "to")),
        parties("erc20Transfers"), parties("erc721Transfers"), parties("erc1155Transfers"),
        parties("internalTransactions"),
        F.transform(F.coalesce(F.col(p + "logs"), F.array()), lambda x: x["address"]),
    ))
    return F.array_distinct(F.filter(F.transform(every, lambda a: F.lower(a)),
                                     lambda a: a.isNotNull() & (a != "")))
