"""Working fixtures: chain-shaped views over the driver's parquet tables.

Every view is one SQL template rendered for two dialects: Spark (run with
``spark.sql(text, **dataframes)``) and DuckDB (the oracle, as a CTE).  The
same text in both engines is what makes the oracle comparison meaningful.
The views only reshape the given tables, so their size grows with them.

Nested, JSON and signed forms (transactions_nested, webhook_raw, ...) are
built from these flat views with the DataFrame API in ``feeds.py``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
               "lineitem", "events")


@dataclass(frozen=True)
class Dialect:
    name: str  # "spark" or "duckdb"

    def t(self, view: str) -> str:
        """Reference to another view or table."""
        return "{" + view + "}" if self.name == "spark" else view

    def q(self, ident: str) -> str:
        return f"`{ident}`" if self.name == "spark" else f'"{ident}"'

    def sha(self, expr: str) -> str:
        return f"sha2({expr}, 256)" if self.name == "spark" else f"sha256({expr})"

    def div(self, a: str, b: str) -> str:
        return f"({a} div {b})" if self.name == "spark" else f"({a} // {b})"

    def epoch_s(self, ts: str) -> str:
        if self.name == "spark":
            return f"(unix_micros(cast({ts} AS timestamp)) div 1000000)"
        return f"(epoch_us({ts}) // 1000000)"

    def epoch_div(self, ts: str, seconds: int) -> str:
        us = seconds * 1_000_000
        if self.name == "spark":
            return f"(unix_micros(cast({ts} AS timestamp)) div {us})"
        return f"(epoch_us({ts}) // {us})"


SPARK = Dialect("spark")
DUCK = Dialect("duckdb")


def _cents(expr: str) -> str:
    return f"cast(round({expr} * 100) AS bigint)"


def _addr(expr: str, prefix: str = "0x", width: int = 40, pad: str = "0") -> str:
    return f"'{prefix}' || lpad(cast({expr} AS string), {width}, '{pad}')"


# ---------------------------------------------------------------------------
# View templates.  Each returns SQL text for dialect D.
# ---------------------------------------------------------------------------

def _transactions(D: Dialect) -> str:
    q, ep, blk = D.q, D.epoch_s("ts"), D.epoch_div("ts", 1800)
    price = _cents("value")
    # nonce = per-sender sequence number.  In Spark it is added afterwards by
    # a segmented row number (a hot sender is never one task); DuckDB, the
    # single-node oracle, uses the plain window.
    nonce = ("user_id AS _user, ts AS _ts, event_id AS _eid" if D.name == "spark" else
             "cast(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS string) AS nonce")
    return f"""
SELECT cast(user_id % 5 AS string) AS chainId,
  cast({ep} AS bigint) AS blockTimestamp,
  cast({blk} AS string) AS blockNumber,
  '0x' || {D.sha("cast(event_id AS string)")} AS txHash,
  '0x' || {D.sha("cast(user_id % 5 AS string) || ':' || cast(" + blk + " AS string)")} AS blockHash,
  {_addr("user_id")} AS {q("from")},
  CASE event_type WHEN 'signup' THEN ''
    WHEN 'purchase' THEN {_addr("event_id % 37", "0xc", 39)}
    WHEN 'click' THEN {_addr("event_id % 11", "0xc", 39)}
    ELSE {_addr("(user_id * 7 + event_id) % 500")} END AS {q("to")},
  CASE WHEN event_type IN ('purchase', 'click') THEN '0xa9059cbb'
       WHEN event_type = 'signup' THEN '0x6080' ELSE '0x' END AS input,
  CASE WHEN event_type = 'error' THEN '0' ELSE '1' END AS txStatus,
  cast(21000 + 1000 * (event_id % 50) AS string) AS gas,
  cast(25000000000 + {price} * 1000000 AS string) AS gasPrice,
  cast(21000 + 1000 * (event_id % 50) - 500 * (event_id % 7) AS string) AS receiptGasUsed,
  cast(25000000000 + {price} * 1000000 AS string) AS receiptEffectiveGasPrice,
  CASE WHEN {price} = 0 THEN '0' ELSE cast({price} AS string) || '0000000000000000' END AS value,
  cast(row_number() OVER (PARTITION BY user_id % 5, {blk} ORDER BY ts, event_id) - 1 AS int) AS transactionIndex,
  {nonce}
FROM {D.t("events")}"""


def _blocks(D: Dialect) -> str:
    return f"""
SELECT chainId, blockNumber, max(blockTimestamp) AS blockTimestamp, max(blockHash) AS blockHash,
  cast(count(*) AS int) AS txCount, '25000000000' AS baseFee, '8000000' AS gasLimit,
  cast(sum(cast(receiptGasUsed AS bigint)) AS string) AS gasUsed,
  cast(sum(cast(receiptGasUsed AS decimal(38,0)) * cast(receiptEffectiveGasPrice AS bigint)) AS string) AS feesSpent,
  '0x' || {D.sha("chainId || ':' || cast(cast(blockNumber AS bigint) - 1 AS string)")} AS parentHash
FROM {D.t("transactions")} GROUP BY chainId, blockNumber"""


def _block_reports(D: Dialect) -> str:
    # Blocks as several nodes report them: rival branches over three heights, half of
    # them extended by the next block, some parents that nobody reports, and repeats.
    n, at = "cast(blockNumber AS bigint)", "cast({} AS string)"
    rival = "'0x' || " + D.sha("chainId || ':rival:' || " + at)
    return f"""
SELECT chainId, blockNumber, blockHash, CASE
    WHEN {n} % 22 = 6 THEN {rival.format(n + " - 1")}
    WHEN {n} % 13 = 7 THEN '0x' || {D.sha("chainId || ':lost:' || blockNumber")}
    ELSE parentHash END AS parentHash
FROM {D.t("blocks")}
UNION ALL
SELECT chainId, blockNumber, {rival.format(n)}, CASE WHEN {n} % 11 = 3 THEN parentHash ELSE {rival.format(n + " - 1")} END
FROM {D.t("blocks")} CROSS JOIN (SELECT 1 AS copy UNION ALL SELECT 2) c
WHERE {n} % 11 IN (3, 4, 5) AND (copy = 1 OR {n} % 5 = 0)"""


_LINES_ORDER = "l_linenumber, l_partkey, l_suppkey, l_extendedprice"


def _lines(D: Dialect) -> str:
    """The raw columns that children are made of, a row per line of a known order."""
    return f"""
  SELECT l_orderkey AS orderKey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
    l_returnflag, l_linestatus, o_custkey, o_orderdate
  FROM {D.t("lineitem")} JOIN {D.t("orders")} ON l_orderkey = o_orderkey"""


def _child_columns(D: Dialect, log_index: str, x: str = "", o: str = "") -> dict[str, str]:
    """name -> expression of a child's columns; ``x`` and ``o`` are the prefixes of its line's and its order's columns."""
    # Spark pads by whole copies of the pad: a long one is one copy, not one for each zero.
    pad = "0" * 40 if D.name == "spark" else "0"
    return {
        "transactionHash": f"'0x' || {D.sha(f'{_O} || cast({x}orderKey AS string)')}",
        "logIndex": f"cast({log_index} AS int)",
        "kind": f"CASE {x}l_returnflag WHEN 'N' THEN 'erc20' WHEN 'A' THEN 'erc721' ELSE 'erc1155' END",
        "from": f"CASE WHEN {x}l_linestatus = 'O' THEN '0x' || lpad('', 40, '0') ELSE {_addr(x + 'l_suppkey', pad=pad)} END",
        "to": _addr(o + "o_custkey", pad=pad),
        "tokenAddress": _addr(f"{x}l_partkey % 200", "0xe", 39, pad),
        "tokenId": f"cast({x}l_partkey AS string)",
        "value": f"cast({_cents(x + 'l_extendedprice')} AS string) || '0000'",
        "internalTxType": f"CASE {x}l_linenumber % 3 WHEN 0 THEN 'CREATE' WHEN 1 THEN 'CALL' ELSE 'SELFDESTRUCT' END",
        "blockTimestamp": f"cast({D.epoch_s(o + 'o_orderdate')} AS bigint)",
        "orderKey": f"{x}orderKey",
        "lineStatus": f"{x}l_linestatus",
        "gasUsed": f"cast(cast({x}l_quantity * 1000 AS bigint) AS string)",
    }


_O = "'o'"
_LINE_COLUMNS = ("l_orderkey AS orderKey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, "
                 "l_returnflag, l_linestatus")
ROWS_A_TASK = 250_000  # lines that a task sorts by their order; some 40 MB
_COPIES_ORDER = "PARTITION BY o_orderkey ORDER BY o_custkey, o_orderdate"
_WHOLE = "ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING"


def _children(D: Dialect) -> str:
    number = f"""row_number() OVER (PARTITION BY orderKey
       ORDER BY {_LINES_ORDER}) - 1"""
    if D.name == "spark":
        # Lines are numbered before the join, so that the sort of the window is that
        # of the join as well: a line is shuffled and sorted once, in raw columns.
        # An order's n-th copy of line i is child i * copies + n.
        cols = ",\n  ".join(f"{e} AS {D.q(n)}" for n, e in _child_columns(D, "_n").items())
        return f"""
SELECT {cols}
FROM (SELECT *, _line * _copies + _copy AS _n FROM
  (SELECT *, {number} AS _line
   FROM (SELECT {_LINE_COLUMNS} FROM {D.t("lineitem")} WHERE l_orderkey IS NOT NULL) AS lines) AS numbered
  JOIN (SELECT o_orderkey, o_custkey, o_orderdate, row_number() OVER ({_COPIES_ORDER}) - 1 AS _copy,
      count(*) OVER ({_COPIES_ORDER} {_WHOLE}) AS _copies
    FROM {D.t("orders")} WHERE o_orderkey IS NOT NULL) AS known ON orderKey = o_orderkey)"""
    text = {n: f"{e} AS {D.q(n) if n in ('from', 'to') else n}" for n, e in _child_columns(D, number).items()}
    text["orderKey"] = "orderKey"
    head = ",\n  ".join(t for n, t in text.items() if n not in ("orderKey", "lineStatus", "gasUsed"))
    return f"""
SELECT {head},
  {text["orderKey"]}, {text["lineStatus"]},
  {text["gasUsed"]}
FROM ({_lines(D)}) AS lines"""


def nested_lines(D: Dialect = SPARK) -> str:
    """(orderKey, lines) in Spark SQL: the raw lines of each order key as one array, in the order of their log index.

    An order's lines (bounded in number) are numbered and collected in one order, so nothing is sorted again; the
    structs are made above the first window, so that they are not shuffled beside their columns.
    """
    pack = "orderKey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_returnflag, l_linestatus"
    w = f"PARTITION BY orderKey ORDER BY {_LINES_ORDER}"
    return f"""
SELECT orderKey, lines FROM (
  SELECT orderKey, _n, collect_list(struct({pack})) OVER ({w} {_WHOLE}) AS lines
  FROM (SELECT *, row_number() OVER ({w}) AS _n
    FROM (SELECT {_LINE_COLUMNS} FROM {D.t("lineitem")} WHERE l_orderkey IS NOT NULL) AS lines) AS numbered)
WHERE _n = 1"""


def orders_with_copies(D: Dialect = SPARK) -> str:
    """``orders`` in Spark SQL with ``copies``: customer and date of all orders of the key, one where keys don't repeat."""
    return f"""
SELECT *, collect_list(CASE WHEN o_orderkey IS NOT NULL THEN struct(o_custkey, o_orderdate) END)
  OVER ({_COPIES_ORDER} {_WHOLE}) AS copies
FROM {D.t("orders")}"""


def parties_of_copies(copies: str) -> str:
    """Spark expression: what children take from their order, as structs; made once an order, not once a line."""
    cols = _child_columns(SPARK, "0", o="y.")
    return f"transform({copies}, y -> named_struct('to', {cols['to']}, 'blockTimestamp', {cols['blockTimestamp']}))"


def children_of_lines(lines: str, parties: str, tx_hash: str) -> str:
    """Spark expression: the children of an order, as structs, from its raw lines, ``parties_of_copies`` and its hash."""
    cols = _child_columns(SPARK, f"i * size({parties}) + j", "x.")
    cols |= {"transactionHash": tx_hash, "to": "y.to", "blockTimestamp": "y.blockTimestamp"}
    pairs = ", ".join(f"'{n}', {e}" for n, e in cols.items())
    return f"flatten(transform({lines}, (x, i) -> transform({parties}, (y, j) -> named_struct({pairs}))))"


def _orders_tx(D: Dialect, more: str = "") -> str:
    """Flat parent transaction of each order (the children's parent); ``more``: further columns of ``orders`` to keep."""
    q = D.q
    return f"""
SELECT '0x' || {D.sha("'o' || cast(o_orderkey AS string)")} AS txHash,
  o_orderkey AS orderKey,
  cast(o_custkey % 5 AS string) AS chainId,
  cast({D.div(D.epoch_s("o_orderdate"), "86400")} AS string) AS blockNumber,
  cast({D.epoch_s("o_orderdate")} AS bigint) AS blockTimestamp,
  {_addr("o_custkey")} AS {q("from")},
  {_addr("o_orderkey % 37", "0xc", 39)} AS {q("to")},
  cast({_cents("o_totalprice")} AS string) || '0000000000000000' AS value,
  CASE WHEN o_orderstatus = 'P' THEN '0' ELSE '1' END AS txStatus,
  '0xa9059cbb' AS input,
  cast(21000 + 1000 * (o_orderkey % 50) AS string) AS receiptGasUsed,
  '25000000000' AS gasPrice{more}
FROM {D.t("orders")}"""


def _sightings(D: Dialect) -> str:
    return f"""
SELECT chainId, blockNumber, blockTimestamp, txHash FROM {D.t("transactions")}"""


def _chains(D: Dialect) -> str:
    return f"""
SELECT cast(n_nationkey AS string) AS chainId, 'OK' AS status, n_name AS chainName,
  'chain of ' || n_name AS description,
  'p' || lpad(cast(n_nationkey AS string), 8, '0') AS platformChainId,
  cast(n_regionkey AS string) AS subnetId, 'evm' AS vmId, 'EVM' AS vmName,
  'https://explorer.example/' || cast(n_nationkey AS string) AS explorerUrl,
  'https://rpc.example/' || cast(n_nationkey AS string) AS rpcUrl,
  'wss://rpc.example/' || cast(n_nationkey AS string) AS wsUrl,
  n_nationkey % 5 = 0 AS isTestnet, n_nationkey % 4 = 3 AS private,
  'https://logo.example/' || cast(n_nationkey AS string) AS chainLogoUri,
  CASE n_nationkey % 3 WHEN 0 THEN 'erc20,erc721' WHEN 1 THEN 'erc20' ELSE '' END AS features,
  n_name || ' Token' AS tokenName, 'T' || cast(n_nationkey AS string) AS tokenSymbol,
  cast(18 AS int) AS tokenDecimals,
  'https://logo.example/t' || cast(n_nationkey AS string) AS tokenLogoUri,
  'native token of ' || n_name AS tokenDescription
FROM {D.t("nation")}"""


def _chain_details(D: Dialect) -> str:
    return f"""
SELECT chainId, chainName, rpcUrl, wsUrl, isTestnet, tokenSymbol, tokenDecimals
FROM {D.t("chains")} WHERE cast(chainId AS int) % 7 <> 0"""


def _subnets(D: Dialect) -> str:
    return f"""
SELECT CASE WHEN r_regionkey = 4 THEN '' ELSE cast(r_regionkey AS string) END AS subnetId,
  r_regionkey AS regionKey, r_name AS subnetName
FROM {D.t("region")}"""


def _blockchains(D: Dialect) -> str:
    return f"""
SELECT 'bc' || cast(n_nationkey AS string) AS blockchainId, 'evm' AS vmId,
  CASE WHEN n_regionkey = 4 THEN '' ELSE cast(n_regionkey AS string) END AS subnetId,
  n_regionkey AS regionKey
FROM {D.t("nation")}"""


def _validators(D: Dialect) -> str:
    return f"""
SELECT 'NodeID-' || cast(s_suppkey AS string) AS nodeId,
  cast(1704067200 + s_suppkey * 3600 AS bigint) AS startTime,
  cast(1704067200 + s_suppkey * 3600 + 31536000 AS bigint) AS endTime,
  cast({_cents("abs(s_acctbal)")} AS string) || '0000000' AS stakeAmount,
  CASE WHEN s_suppkey % 7 = 0 THEN NULL ELSE cast(90 + s_nationkey % 10 AS bigint) END AS uptime
FROM {D.t("supplier")}"""


def _delegators(D: Dialect) -> str:
    return f"""
SELECT {_addr("c_custkey")} AS delegator,
  'NodeID-' || cast(c_custkey % 10 AS string) AS nodeId,
  cast({_cents("abs(c_acctbal)")} AS string) || '0000000' AS stakeAmount,
  cast(1704067200 + c_custkey * 60 AS bigint) AS startTime,
  cast(1704067200 + c_custkey * 60 + 1209600 AS bigint) AS endTime,
  {_addr("c_custkey", "0xd", 39)} AS rewardAddress
FROM {D.t("customer")}"""


def _bridge_txs(D: Dialect) -> str:
    return f"""
SELECT 'b' || cast(o_orderkey AS string) AS id,
  'C' || cast(o_orderkey % 4 AS string) AS sourceChain,
  'C' || cast({D.div("o_orderkey", "4")} % 4 AS string) AS destChain,
  o_orderpriority AS asset,
  cast({_cents("o_totalprice")} AS string) AS amount,
  {_addr("o_custkey")} AS sender,
  {_addr("o_orderkey % 1000")} AS receiver,
  o_orderstatus AS status,
  cast({D.epoch_s("o_orderdate")} AS bigint) AS blockTimestamp
FROM {D.t("orders")}"""


def _tokens(D: Dialect) -> str:
    return f"""
SELECT address, name, symbol, decimals, logoUri, price, currencyCode FROM (
  SELECT {_addr("p_partkey % 200", "0xe", 39)} AS address, p_name AS name,
    upper(replace(p_name, ' ', '')) AS symbol, cast(6 + p_size % 13 AS int) AS decimals,
    'https://logo.example/p' || cast(p_partkey AS string) AS logoUri,
    p_retailprice AS price, 'usd' AS currencyCode,
    row_number() OVER (PARTITION BY p_partkey % 200 ORDER BY p_partkey) AS rn
  FROM {D.t("part")}) AS ranked
WHERE rn = 1"""


def _watch_addresses(D: Dialect) -> str:
    return f"""
SELECT {_addr("c_custkey")} AS address FROM {D.t("customer")} WHERE c_custkey % 20 = 0"""


def orders_tx_with(columns: str) -> str:
    """``orders_tx`` in Spark SQL with more columns of ``orders``."""
    return _orders_tx(SPARK, f", {columns}")


# The 28 declared event types, in declaration order, and the
# one extra type no topic is registered for (exercises the unmapped drop).
EVENT_TYPES = [
    "block.created", "block.updated",
    "chain.created", "chain.updated",
    "transaction.created", "transaction.updated",
    "erc20.transfer", "erc721.transfer", "erc1155.transfer",
    "log.created",
    "internal_tx.created",
    "validator.created", "validator.updated",
    "delegator.created", "delegator.updated",
    "subnet.created", "subnet.updated",
    "blockchain.created", "blockchain.updated",
    "teleporter.created", "teleporter.updated",
    "token.created", "token.updated",
    "metrics.updated",
    "metrics.activity.updated", "metrics.performance.updated",
    "metrics.gas.updated", "metrics.cumulative.updated",
]
UNKNOWN_EVENT_TYPE = "mempool.pending"


def _event_log(D: Dialect) -> str:
    types = EVENT_TYPES + [UNKNOWN_EVENT_TYPE]
    arr = ", ".join(f"'{t}'" for t in types)
    n = len(types)
    if D.name == "spark":
        pick = f"element_at(array({arr}), cast(event_id % {n} AS int) + 1)"
    else:
        pick = f"([{arr}])[event_id % {n} + 1]"
    return f"""
SELECT event_id AS eventId, {pick} AS event_type,
  cast(user_id % 5 AS string) AS chainId, props AS data,
  cast({D.epoch_s("ts")} AS bigint) AS eventTime
FROM {D.t("events")}"""


def _topic_messages(D: Dialect) -> str:
    return f"""
SELECT CASE WHEN event_type = 'error' THEN 'chain.errors'
    ELSE 'chain.' || CASE event_type WHEN 'view' THEN 'blocks' WHEN 'click' THEN 'transactions'
                      ELSE 'logs' END || '.' || cast(user_id % 5 AS string) END AS topic,
  cast(event_id % 3 AS int) AS {D.q("partition")},
  event_id AS {D.q("offset")},
  cast(user_id AS string) AS {D.q("key")},
  CASE WHEN event_id % 50 = 0 THEN substr(props, 1, 4) ELSE props END AS {D.q("value")},
  cast({D.epoch_s("ts")} AS bigint) AS eventTime
FROM {D.t("events")}"""


def _subscriptions(D: Dialect) -> str:
    # One live client per supplier; every second one re-subscribes later.
    # A few take every chain or every topic, most a chain of their own.
    topic = "CASE (s_suppkey + {0}) % 4 WHEN 0 THEN 'blocks' WHEN 1 THEN 'transactions' WHEN 2 THEN 'logs' ELSE '*' END"
    chain = ("CASE WHEN (s_suppkey + {0}) % 400 = 7 THEN '' WHEN (s_suppkey + {0}) % 400 = 8 THEN '*' "
             "ELSE cast((s_suppkey + {0}) % 200 AS string) END")
    return f"""
SELECT 'c' || cast(s_suppkey AS string) AS clientId, {topic.format(0)} AS subTopic, {chain.format(0)} AS subChain,
  cast(1 AS bigint) AS subTime
FROM {D.t("supplier")}
UNION ALL
SELECT 'c' || cast(s_suppkey AS string), {topic.format(1)}, {chain.format(1)},
  cast(1704067200 + s_suppkey % 30 * 86400 AS bigint)
FROM {D.t("supplier")} WHERE s_suppkey % 2 = 0"""


# name -> (template, dependencies)
VIEWS: dict[str, tuple] = {
    "transactions": (_transactions, ("events",)),
    "blocks": (_blocks, ("transactions",)),
    "block_reports": (_block_reports, ("blocks",)),
    "children": (_children, ("lineitem", "orders")),
    "orders_tx": (_orders_tx, ("orders",)),
    "sightings": (_sightings, ("transactions",)),
    "chains": (_chains, ("nation",)),
    "chain_details": (_chain_details, ("chains",)),
    "subnets": (_subnets, ("region",)),
    "blockchains": (_blockchains, ("nation",)),
    "validators": (_validators, ("supplier",)),
    "delegators": (_delegators, ("customer",)),
    "bridge_txs": (_bridge_txs, ("orders",)),
    "tokens": (_tokens, ("part",)),
    "watch_addresses": (_watch_addresses, ("customer",)),
    "event_log": (_event_log, ("events",)),
    "topic_messages": (_topic_messages, ("events",)),
    "subscriptions": (_subscriptions, ("supplier",)),
}


def view_sql(name: str, dialect: Dialect) -> str:
    return VIEWS[name][0](dialect)


def _closure(names) -> list[str]:
    """Views needed for ``names`` in dependency order (base tables excluded)."""
    order: list[str] = []

    def visit(n):
        if n in BASE_TABLES or n in order:
            return
        for dep in VIEWS[n][1]:
            visit(dep)
        order.append(n)

    for n in names:
        visit(n)
    return order


def duck_with(body: str, *views: str) -> str:
    """DuckDB oracle text: the needed views as CTEs, then ``body``."""
    needed = _closure(views)
    if not needed:
        return body.strip()
    ctes = ",\n".join(f"{n} AS ({view_sql(n, DUCK)})" for n in needed)
    return f"WITH {ctes}\n{body.strip()}"


class Fixtures:
    """Lazily built Spark views over one scale-factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        # All times are UTC Unix seconds; the parquet timestamps are zone-less.
        # Pin the session zone so epoch, truncation and RFC 3339 text do not
        # depend on the machine's or the caller's default zone.
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._cache: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._cache[name]

    def by_order(self, rows_a_task: int | None = None) -> dict[str, DataFrame]:
        """``lineitem`` and ``orders``, dealt by order key over as many tasks as their counted rows need, a core each at least.

        Left to itself Spark joins small partitions up to a size as shuffled, and such a task sorts several times
        that; what it sorts here is bounded by rows, whatever the session's settings, so that nothing is spilled.
        Both are dealt alike, so windows and joins by the key shuffle no more.
        """
        lines, orders = self.table("lineitem"), self.table("orders")
        tasks = -(-max(lines.count(), orders.count()) // (rows_a_task or ROWS_A_TASK))
        if tasks > 1:
            tasks = max(tasks, self.spark.sparkContext.defaultParallelism)
            lines, orders = lines.repartition(tasks, "l_orderkey"), orders.repartition(tasks, "o_orderkey")
        return {"lineitem": lines, "orders": orders}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.view(name)

    def view(self, name: str) -> DataFrame:
        if name in BASE_TABLES:
            return self.table(name)
        if name not in self._cache:
            template, deps = VIEWS[name]
            frames = self.by_order() if name == "children" else {d: self.view(d) for d in deps}
            df = self.spark.sql(template(SPARK), **frames)
            self._cache[name] = _SPARK_POST.get(name, lambda x: x)(df)
        return self._cache[name]


def _add_nonce(tx: DataFrame) -> DataFrame:
    from pyspark.sql import functions as F
    from chainflow.operators.timeline import segmented_row_number
    hour = F.floor(F.unix_micros(F.col("_ts").cast("timestamp")) / 3_600_000_000)
    cols = [c for c in tx.columns if not c.startswith("_")]
    numbered = segmented_row_number(tx, "_user", hour, ["_ts", "_eid"], "_n")
    return numbered.select(*cols, (F.col("_n") - 1).cast("string").alias("nonce"))


_SPARK_POST = {"transactions": _add_nonce}
