"""DuckDB SQL stating the expected result of each registered query directly
from the driver tables (``orders``, ``lineitem``, ``events``, ``customer``),
without repeating the encode/decode steps of the Spark side. Column names and
types match the Spark output; wide decimals compare as text.
"""
from __future__ import annotations

# -- shared views over the driver tables (same bindings as plans/fixtures.py)
_KST = "(ts + INTERVAL 9 HOUR)"
_FMT = "'%Y-%m-%d %H:%M:%S'"

TX = f"""tx AS (
  SELECT o_orderkey, o_custkey, o_orderstatus,
    '0x' || sha256(CAST(o_orderkey AS VARCHAR)) AS transactionHash,
    o_orderkey % 50 AS transactionIndex,
    o_orderkey // 50 AS blockNumber,
    '0x' || lpad(lower(hex(o_custkey)), 40, '0') AS "from",
    '0x' || lpad(lower(hex((o_custkey * 7 + 1) % 1500)), 40, '0') AS "to",
    CAST(CAST(round(o_totalprice * 100) AS HUGEINT) * CAST(1000000000000000000 AS HUGEINT) AS VARCHAR) AS value,
    o_orderkey % 1000 AS nonce,
    21000 + o_orderkey % 1000 AS gas,
    CAST(round(o_totalprice) AS BIGINT) * 1000000000 AS gasPrice,
    CASE WHEN o_orderstatus = 'F' THEN '0x1' ELSE '0x0' END AS status,
    o_orderdate + to_seconds(o_orderkey % 86400) AS ts
  FROM orders)"""

# typed KST time of the raw rows ('' for o_orderkey % 10 = 0 -> null)
TXT = f"""txt AS (
  SELECT *, CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE {_KST} END AS kts FROM tx)"""

H = f"""h AS (
  SELECT event_id, user_id, event_type, ts,
    '0x' || sha256(CAST(event_id AS VARCHAR)) AS transactionHash,
    event_id // 5 AS blockNumber,
    '0x' || lpad(lower(hex(user_id)), 40, '0') AS "from",
    '0x' || lpad(lower(hex((user_id * 7 + 1) % 1500)), 40, '0') AS "to",
    CAST(CAST(round(value * 100) AS HUGEINT) * CAST(10000000000000000 AS HUGEINT) AS VARCHAR) AS value,
    event_type AS status,
    strftime({_KST}, {_FMT}) AS timestamp,
    strftime({_KST}, '%Y') AS year, strftime({_KST}, '%m') AS month,
    strftime({_KST}, '%d') AS day, strftime({_KST}, '%H') AS hour
  FROM events)"""

HI = """hi AS (SELECT max(o_orderkey) // 50 AS hi FROM orders)"""
PRESENT = """present AS (SELECT DISTINCT o_orderkey // 50 AS block FROM orders WHERE (o_orderkey // 50) % 13 <> 0)"""
MISSING = """missing AS (
  SELECT g.generate_series AS block FROM hi, generate_series(1, hi.hi) g
  WHERE g.generate_series NOT IN (SELECT block FROM present))"""

HOLDER = """hr AS (
  SELECT c_custkey, c_name,
    '0x' || lpad(lower(hex(c_custkey)), 40, '0') AS address,
    CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS VARCHAR) AS eth_balance,
    CAST(CAST(c_acctbal / 10000 AS DECIMAL(12,6)) AS VARCHAR) || '%' AS percentage
  FROM customer)"""
HOLDER_KEPT = """kept AS (
  SELECT CASE WHEN c_custkey % 13 = 0 THEN 'N/A' ELSE address END AS address, eth_balance, percentage
  FROM hr WHERE c_custkey % 11 <> 0 AND c_custkey % 5 <> 0 AND c_custkey % 7 <> 0)"""

LOGS = """lg AS (
  SELECT l.*, row_number() OVER (PARTITION BY l_orderkey
           ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice) - 1 AS pos
  FROM lineitem l)"""

ATT = """att AS (
  SELECT b.block, a.attempt, ((b.block + a.attempt) % 3 <> 0) AND (b.block % 29 <> 0) AS ok
  FROM (SELECT DISTINCT o_orderkey // 50 AS block FROM orders) b, range(0, 5) a(attempt))"""
FIRST_OK = f"""{ATT}, fs AS (
  SELECT block, min(CASE WHEN ok THEN attempt END) AS first_ok_attempt FROM att GROUP BY block)"""

DAILY = """daily AS (
  SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS price_date,
    CAST(sum(CASE WHEN event_type = 'purchase' THEN CAST(value AS DECIMAL(18,2)) END) AS DOUBLE)
      / count(CASE WHEN event_type = 'purchase' THEN 1 END) AS usd,
    1000.0 + CAST(sum(CASE WHEN event_type = 'view' THEN CAST(value AS DECIMAL(18,2)) END) AS DOUBLE)
      / count(CASE WHEN event_type = 'view' THEN 1 END) AS fx
  FROM events GROUP BY 1)"""

HOURS = """hours AS (
  SELECT generate_series AS hour_ts FROM generate_series(
    (SELECT date_trunc('hour', min(ts)) FROM events), (SELECT date_trunc('hour', max(ts)) FROM events),
    INTERVAL 1 HOUR)),
  hk AS (SELECT hour_ts, strftime(hour_ts + INTERVAL 9 HOUR, '%Y') AS year,
    strftime(hour_ts + INTERVAL 9 HOUR, '%m') AS month, strftime(hour_ts + INTERVAL 9 HOUR, '%d') AS day,
    strftime(hour_ts + INTERVAL 9 HOUR, '%H') AS hour FROM hours)"""

BLOCK_TS = """bt AS (SELECT event_id // 5 AS block, min(ts) AS ts FROM events GROUP BY 1)"""


def _raw26(view: str) -> str:
    """The 26 columns of the items of ``view`` (k, page, transactionHash, transactionIndex,
    blockNumber, from, to, value, timestamp), as fixtures.page_item defines them."""
    addr = lambda e: f"'0x' || lpad(lower(hex({e})), 40, '0')"
    sha = lambda e, p: f"'0x' || sha256('{p}' || CAST({e} AS VARCHAR))"
    log = f"""concat_ws(':', {addr('k + i')}, transactionHash, transactionIndex, {sha('blockNumber', 'block-')}, blockNumber,
      '0x' || lower(hex(k * i)), i, CASE WHEN i % 2 = 0 THEN 'true' ELSE 'false' END, {sha('k + i', 'topic-')},
      CASE WHEN i % 2 = 1 THEN concat_ws(':', 'Transfer', 'event Transfer(address,uint256)', 'Transfer(address,uint256)', {sha('k', 'event-')},
        'to/address/' || "to" || ',value/uint256/' || CAST(k * i AS VARCHAR)) END)"""
    return f"""transactionHash, CAST(transactionIndex AS VARCHAR) AS transactionIndex, {sha('blockNumber', 'block-')} AS blockHash,
  blockNumber, "from", "to", value, '0x' AS input, CASE WHEN k % 3 = 0 THEN '0xa9059cbb' END AS functionSelector,
  CAST(k % 1000 AS VARCHAR) AS nonce, CAST(21000 + k % 1000 AS VARCHAR) AS gas, CAST((k % 50 + 1) * 1000000000 AS VARCHAR) AS gasPrice,
  CASE WHEN k % 4 <> 0 THEN CAST((k % 50 + 1) * 1000000000 + 2000000000 AS VARCHAR) END AS maxFeePerGas,
  '1000000000' AS maxPriorityFeePerGas, CAST(21000 + k % 500 AS VARCHAR) AS gasUsed, CAST(k * 21000 AS VARCHAR) AS cumulativeGasUsed,
  CAST((k % 50 + 1) * 1000000000 AS VARCHAR) AS effectGasPrice, CAST(NULL AS VARCHAR) AS contractAddress, '2' AS type,
  CASE WHEN k % 7 = 0 THEN '0' ELSE '1' END AS status, '0x00' AS logsBloom, timestamp,
  CASE WHEN k % 3 = 0 THEN '{{"method":"transfer","note":"전송 ' || CAST(k AS VARCHAR) || '","args":[{{"name":"to","value":"' || "to" || '"}}]}}' END AS decodedInput,
  CASE WHEN k % 4 <> 0 THEN "to" || ':' || {sha('k', 'slot-')} END AS accessList,
  CASE WHEN k % 5 = 0 THEN concat_ws(':', '0x1', k % 1000, "from", '0x0', {sha('k', 'r-')}, {sha('k', 's-')}) END AS authorizationList,
  CASE WHEN page = 0 THEN array_to_string(list_transform(range(1, k % 3 + 1), lambda i: {log}), ';') END AS logs
FROM {view}"""


def W(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _label(expr: str) -> str:
    """Zero-padded to 8 digits, never cut."""
    return f"printf('%08d', {expr})"


def _chunk(expr: str, size: int) -> str:
    return (f"{_label(f'({expr} // {size}) * {size}')} || '_' || {_label(f'({expr} // {size}) * {size} + {size - 1}')}")


def _kst_text(ts: str) -> str:
    return f"strftime({ts} + INTERVAL 9 HOUR, {_FMT})"


def _completeness(size: int) -> str:
    return f"""SELECT CAST({size} AS BIGINT) AS chunk_size, c AS chunk_id,
      CAST(greatest(c * {size}, 1) AS BIGINT) AS chunk_start, CAST(least(c * {size} + {size - 1}, hi.hi) AS BIGINT) AS chunk_end,
      (SELECT count(*) FROM present p WHERE p.block // {size} = c AND p.block BETWEEN 1 AND hi.hi) AS n_present,
      (SELECT count(*) FROM present p WHERE p.block // {size} = c AND p.block BETWEEN 1 AND hi.hi)
        = least(c * {size} + {size - 1}, hi.hi) - greatest(c * {size}, 1) + 1 AS is_complete
    FROM hi, generate_series(0, hi.hi // {size}) g(c)"""


SQL: dict[str, str] = {}

# ------------------------------------------------------------------ sources
SQL["scan_nested_tx"] = W(TX) + """
SELECT transactionHash, CAST(blockNumber AS VARCHAR) AS blockNumber, value, status,
  coalesce(n, 0) AS n_logs, CAST(coalesce(s, 0) AS BIGINT) AS sum_log_index, o_orderkey % 4 <> 0 AS has_access_list
FROM tx LEFT JOIN (SELECT l_orderkey, count(*) AS n, sum(l_linenumber) AS s FROM lineitem GROUP BY 1) l
  ON l.l_orderkey = tx.o_orderkey"""

SQL["scan_hour_partition"] = W(H) + """
SELECT transactionHash, "from", status, timestamp, year, month, day, hour FROM h
WHERE year = '2024' AND month = '01' AND day = '15' AND hour = '09'"""

_DAYKEYS = ("CAST(year(kts) AS VARCHAR) AS year, CAST(month(kts) AS VARCHAR) AS month, "
            "CAST(day(kts) AS VARCHAR) AS day")

SQL["scan_day_range"] = W(TX, TXT) + f"""
SELECT transactionHash, blockNumber, {_DAYKEYS} FROM txt
WHERE CAST(kts AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1997-12-31'"""

SQL["scan_holders_csv"] = W(HOLDER) + """
SELECT address, eth_balance, percentage, TIMESTAMP '2025-07-01 00:00:00' AS inserted_at FROM hr"""

SQL["scan_jsonl_gz"] = W(TX) + f"""
SELECT transactionHash, CAST(blockNumber AS VARCHAR) AS blockNumber, CAST(transactionIndex AS VARCHAR) AS transactionIndex,
  "from", "to", value, status, CASE WHEN o_orderkey % 10 = 0 THEN '' ELSE {_kst_text('ts')} END AS timestamp, CAST(NULL AS VARCHAR) AS bad_line
FROM tx WHERE o_orderkey % 97 <> 0
UNION ALL
SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, '{{"transactionHash":"' || left(transactionHash, 20) FROM tx WHERE o_orderkey % 97 = 0"""

SQL["flatten_tx_pages"] = W(TX) + f""",
p AS (SELECT *, o_orderkey AS k, transactionIndex // 20 AS page FROM tx WHERE (blockNumber + transactionIndex // 20) % 17 <> 0),
f AS (SELECT * REPLACE (bts AS ts), strftime(bts + INTERVAL 9 HOUR, {_FMT}) AS timestamp FROM (
  SELECT *, first_value(ts) OVER (PARTITION BY blockNumber, page ORDER BY transactionIndex) AS bts FROM p))
SELECT blockNumber AS block, page, epoch_us(ts) // 1000000 AS block_ts, {_raw26('f')}"""

# items of fixtures.hour_pages: one page per block of events, stamped with its first time
HOUR_ITEMS = f"""hb AS (
  SELECT event_id AS k, 0 AS page, transactionHash, event_id % 5 AS transactionIndex, blockNumber, "from", "to", value,
    first_value(ts) OVER (PARTITION BY blockNumber ORDER BY event_id) AS bts FROM h),
hi26 AS (SELECT *, strftime(bts + INTERVAL 9 HOUR, {_FMT}) AS timestamp, strftime(bts + INTERVAL 9 HOUR, '%Y') AS year,
    strftime(bts + INTERVAL 9 HOUR, '%m') AS month, strftime(bts + INTERVAL 9 HOUR, '%d') AS day, strftime(bts + INTERVAL 9 HOUR, '%H') AS hour FROM hb)"""

SQL["hourly_batch"] = W(H, HOUR_ITEMS) + f"""
SELECT year, month, day, hour, count(*) OVER (PARTITION BY year, month, day, hour) AS hour_rows,
  count(*) OVER (PARTITION BY year, month, day, hour) AS loaded_rows, {_raw26('hi26')}"""

SQL["flatten_rpc_blocks"] = W(TX) + """
SELECT transactionHash, blockNumber, transactionIndex, nonce,
  CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE gas END AS gas, value FROM tx"""

SQL["flatten_rpc_receipts"] = """
SELECT l_orderkey // 50 AS blockNumber,
  row_number() OVER (PARTITION BY l_orderkey // 50 ORDER BY l_orderkey % 50, l_linenumber, l_partkey, l_suppkey,
                     l_shipdate, l_extendedprice) - 1 AS ord,
  '0x' || sha256(CAST(l_orderkey AS VARCHAR)) AS transactionHash,
  CAST(round(l_extendedprice) AS BIGINT) AS gasUsed,
  CASE WHEN l_linenumber % 2 = 1 THEN '0x1' ELSE '0x0' END AS status
FROM lineitem"""

SQL["stage_semistructured"] = W(TX, LOGS) + """
SELECT transactionHash, coalesce(n, 0) AS n_logs, CAST(l_linenumber AS BIGINT) AS first_log_index,
  '0x' || lpad(lower(hex(l_suppkey)), 40, '0') AS first_log_address,
  CASE WHEN l_linenumber <> 3 THEN '0x' || sha256(CAST(l_suppkey AS VARCHAR)) END AS first_log_topic,
  CASE WHEN l_linenumber = 2 THEN false ELSE l_returnflag = 'R' END AS first_log_removed,
  CASE WHEN o_orderkey % 4 <> 0 THEN '0x' || sha256('slot-' || CAST(o_orderkey AS VARCHAR)) END AS first_slot,
  o_orderkey % 4 = 0 AS access_list_missing
FROM tx LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) l ON l.l_orderkey = tx.o_orderkey
LEFT JOIN lg ON lg.l_orderkey = tx.o_orderkey AND lg.pos = 0"""

SQL["scan_price_fx"] = W(DAILY) + """
SELECT price_date, usd AS price_usd_raw, fx AS fx_rate FROM daily"""

SQL["extract_holder_rows"] = W(HOLDER, HOLDER_KEPT) + "SELECT address, eth_balance, percentage FROM kept"

SQL["source_status"] = W(H, HOURS) + """,
have AS (SELECT DISTINCT year, month, day, hour FROM h)
SELECT hk.year, hk.month, hk.day, hk.hour,
  CASE WHEN hk.hour = '04' OR have.year IS NULL THEN 'missing' WHEN hk.hour = '03' THEN 'empty' ELSE 'ready' END AS status
FROM hk LEFT JOIN have USING (year, month, day, hour)"""

# -------------------------------------------------------------------- sinks
SQL["write_conformed"] = W(TX) + f"""
SELECT transactionHash,
  CASE WHEN o_orderkey % 2 = 0 THEN CAST(gasPrice + 2000000000 AS VARCHAR) END AS maxFeePerGas,
  CASE WHEN o_orderkey % 9 = 0 THEN '' ELSE CAST(gas AS VARCHAR) END AS gas,
  CASE WHEN o_orderkey % 10 = 0 THEN '' ELSE {_kst_text('ts')} END AS timestamp
FROM tx"""

SQL["write_hour_partitions"] = W(H) + "SELECT transactionHash, status, year, month, day, hour FROM h"

SQL["write_day_partitions"] = W(TX, TXT) + f"SELECT transactionHash, {_DAYKEYS} FROM txt"

SQL["write_block_chunks"] = W(TX) + f"SELECT transactionHash, {_chunk('blockNumber', 100)} AS chunk FROM tx"

SQL["manifest_empty"] = W(H, HOURS) + """,
c AS (SELECT year, month, day, hour, count(*) AS n FROM h WHERE hour <> '03' GROUP BY ALL)
SELECT hk.year, hk.month, hk.day, hk.hour, coalesce(c.n, 0) AS n_rows, coalesce(c.n, 0) = 0 AS is_empty
FROM hk LEFT JOIN c USING (year, month, day, hour)"""

SQL["write_holders_csv"] = W(HOLDER, HOLDER_KEPT) + """
SELECT address, eth_balance, percentage, TIMESTAMP '2025-07-01 00:00:00' AS inserted_at FROM kept"""

SQL["load_skip_existing"] = W(H) + """
SELECT transactionHash, CASE WHEN day <= '15' THEN status ELSE upper(status) END AS status,
  year, month, day, hour FROM h"""

SQL["load_replace_partition"] = W(H) + """
SELECT transactionHash AS transactionhash,
  CASE WHEN day BETWEEN '10' AND '12' THEN upper(status) ELSE status END AS transaction_status,
  year AS key_year, month AS key_month, day AS key_day, hour AS key_hour FROM h"""

SQL["load_replace_range"] = W(H) + """,
r AS (SELECT date_trunc('second', ts) AS timestamp, value, "from", "to", blockNumber,
        CASE WHEN event_type = 'purchase' THEN '1' ELSE '0' END AS st FROM h)
SELECT timestamp, value, "from", "to", blockNumber,
  CASE WHEN timestamp >= TIMESTAMP '2024-01-10 00:00:00' AND timestamp < TIMESTAMP '2024-01-12 00:00:00'
       THEN st ELSE '0' END AS status
FROM r"""

SQL["load_upsert_key"] = W(DAILY) + """
SELECT price_date, round(usd, 4) AS price_usd,
  CASE WHEN day(CAST(price_date AS DATE)) BETWEEN 10 AND 20 THEN round(usd * fx, 4) END AS price_krw
FROM daily"""

SQL["load_truncate"] = W(HOLDER, HOLDER_KEPT) + """
SELECT address, eth_balance, percentage, TIMESTAMP '2025-07-02 00:00:00' AS inserted_at FROM kept"""

_HIST_COLS = f"""transactionHash AS transactionhash, blockNumber AS blocknumber, "from" AS transaction_from,
  "to" AS transaction_to, value, status AS transaction_status,
  CAST(year(kts) AS VARCHAR) AS key_year, CAST(month(kts) AS VARCHAR) AS key_month,
  CAST(day(kts) AS VARCHAR) AS key_day, kts AS transaction_timestamp"""

SQL["load_insert_absent"] = W(TX, TXT) + f"""
SELECT {_HIST_COLS} FROM txt
WHERE CAST(kts AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1997-06-30'"""

SQL["purge_hour_range"] = W(H) + """
SELECT side, transactionHash, year, month, day, hour FROM h, (VALUES ('lake'), ('warehouse')) s(side)
WHERE date_trunc('hour', ts) NOT BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-06 23:00:00'"""

SQL["register_partitions"] = W(H) + "SELECT year, month, day, hour, count(*) AS n_rows FROM h GROUP BY ALL"

SQL["ingest_state"] = W(HI, PRESENT, MISSING) + """
SELECT CAST(CASE WHEN (SELECT min(block) FROM missing) IS NULL THEN (SELECT hi + 1 FROM hi)
  ELSE greatest(1, ((SELECT min(block) FROM missing) // 10) * 10) END AS BIGINT) AS next_fetch_block"""

SQL["failed_blocks"] = "SELECT DISTINCT o_orderkey // 50 AS block FROM orders WHERE (o_orderkey // 50) % 29 = 0"

SQL["compact_chunks"] = W(TX, HI, PRESENT, MISSING) + """
SELECT transactionHash, CASE WHEN blockNumber // 10 IN (SELECT block // 10 FROM missing) THEN 'staged' ELSE
  printf('%08d', (blockNumber // 10) * 10 + 9) || '_' || printf('%08d', (blockNumber // 10) * 10) END AS chunk
FROM tx, hi
WHERE blockNumber BETWEEN 1 AND hi.hi"""

# -------------------------------------------------------------- projections
SQL["tx_project_hourly"] = W(H) + f"""
SELECT transactionHash AS transactionhash, blockNumber AS blocknumber, "from" AS transaction_from,
  "to" AS transaction_to, value, status AS transaction_status, year AS key_year, month AS key_month,
  day AS key_day, hour AS key_hour, date_trunc('second', ts + INTERVAL 9 HOUR) AS transaction_timestamp FROM h"""

SQL["tx_project_historical"] = W(TX, TXT) + f"SELECT {_HIST_COLS} FROM txt"

SQL["tx_project_realtime"] = W(H) + """
SELECT date_trunc('second', ts) AS timestamp, value, "from", "to", blockNumber,
  CASE WHEN event_type = 'purchase' THEN '1' ELSE '0' END AS status FROM h"""

SQL["tx_conform"] = W(TX, H, HOUR_ITEMS) + f""",
old AS (
  SELECT '23' AS form, transactionHash, CAST(transactionIndex AS VARCHAR) AS transactionIndex,
    '0x' || sha256('block-' || CAST(blockNumber AS VARCHAR)) AS blockHash, blockNumber, "from", "to", value, '0x' AS input,
    CAST(NULL AS VARCHAR) AS functionSelector, CAST(nonce AS VARCHAR) AS nonce,
    CASE WHEN o_orderkey % 9 = 0 THEN '' ELSE CAST(gas AS VARCHAR) END AS gas, CAST(gasPrice AS VARCHAR) AS gasPrice,
    CASE WHEN o_orderkey % 2 = 0 THEN CAST(gasPrice + 2000000000 AS VARCHAR) END AS maxFeePerGas,
    CAST(1000000000 + (o_orderkey % 7) * 100000000 AS VARCHAR) AS maxPriorityFeePerGas, CAST(21000 + o_orderkey % 500 AS VARCHAR) AS gasUsed,
    CAST(o_orderkey * 21000 AS VARCHAR) AS cumulativeGasUsed, CAST(gasPrice AS VARCHAR) AS effectGasPrice,
    CAST(NULL AS VARCHAR) AS contractAddress, '0x2' AS type, status, '0x00' AS logsBloom,
    CASE WHEN o_orderkey % 10 = 0 THEN '' ELSE {_kst_text('ts')} END AS timestamp, CAST(NULL AS VARCHAR) AS decodedInput,
    CAST(NULL AS VARCHAR) AS accessList, CAST(NULL AS VARCHAR) AS authorizationList, CAST(NULL AS VARCHAR) AS logs FROM tx)
SELECT * FROM old UNION ALL BY NAME SELECT '26' AS form, {_raw26('hi26')}"""

SQL["tx_fill_text"] = W(TX) + f"""
SELECT transactionHash,
  CASE WHEN o_orderkey % 2 = 0 THEN CAST(gasPrice + 2000000000 AS VARCHAR) ELSE '' END AS maxFeePerGas,
  CASE WHEN o_orderkey % 9 = 0 THEN '' ELSE CAST(gas AS VARCHAR) END AS gas, '' AS contractAddress,
  CASE WHEN o_orderkey % 10 = 0 THEN '' ELSE {_kst_text('ts')} END AS timestamp
FROM tx"""

SQL["tx_typed"] = W(TX, TXT) + """
SELECT transactionHash, CAST(transactionIndex AS INTEGER) AS transactionIndex, blockNumber,
  CAST(nonce AS INTEGER) AS nonce, CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE gas END AS gas, gasPrice,
  kts AS timestamp FROM txt"""

SQL["tx_typed_optional"] = W(TX) + """
SELECT transactionHash, CASE WHEN o_orderkey % 2 = 0 THEN gasPrice + 2000000000 END AS maxFeePerGas,
  1000000000 + (o_orderkey % 7) * 100000000 AS maxPriorityFeePerGas, gasPrice AS effectGasPrice FROM tx"""

SQL["kst_hour_keys"] = W(H) + "SELECT transactionHash, year, month, day, hour FROM h"

SQL["day_keys"] = W(TX, TXT) + f"SELECT transactionHash, {_DAYKEYS} FROM txt"

SQL["nested_defaults"] = W(TX, LOGS) + """
SELECT transactionHash, CAST(CASE WHEN o_orderkey % 4 = 0 THEN 0 ELSE 1 END AS BIGINT) AS n_access, pos,
  CASE WHEN l_orderkey IS NULL THEN NULL WHEN l_linenumber = 2 THEN false ELSE l_returnflag = 'R' END AS removed,
  CAST(CASE WHEN l_orderkey IS NULL THEN NULL WHEN l_linenumber = 3 THEN 0 ELSE 2 END AS BIGINT) AS n_topics
FROM tx LEFT JOIN lg ON l_orderkey = o_orderkey"""

SQL["stamp_block_time"] = W(TX) + f"""
SELECT transactionHash, blockNumber,
  CASE WHEN blockNumber % 23 = 0 THEN '1970-01-01 09:00:00'
       ELSE strftime(min(ts) OVER (PARTITION BY blockNumber) + INTERVAL 9 HOUR, {_FMT}) END AS timestamp
FROM tx"""

SQL["filter_time_range"] = W(TX, TXT) + """
SELECT transactionHash, kts AS timestamp FROM txt
WHERE kts >= TIMESTAMP '1996-01-01 00:00:00' AND kts < TIMESTAMP '1997-01-01 00:00:00'"""

# -------------------------------------------------------------------- joins
_LAST_RECEIPT = """lr AS (
  SELECT l_orderkey, arg_max(l_linenumber, (l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice)) AS ln,
    arg_max(l_extendedprice, (l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice)) AS px,
    count(*) AS n
  FROM lineitem GROUP BY 1),
bad AS (SELECT DISTINCT o_orderkey // 50 AS block FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem))"""

SQL["merge_tx_receipts"] = W(TX) + "," + _LAST_RECEIPT + f"""
SELECT transactionHash, CAST(blockNumber AS VARCHAR) AS blockNumber, value,
  CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE CAST(gas AS VARCHAR) END AS gas,
  CAST(CAST(round(px) AS BIGINT) AS VARCHAR) AS gasUsed,
  CASE WHEN ln % 2 = 1 THEN '1' ELSE '0' END AS status, n AS n_logs,
  CASE WHEN blockNumber % 23 = 0 THEN '1970-01-01 09:00:00'
       ELSE strftime(min(ts) OVER (PARTITION BY blockNumber) + INTERVAL 9 HOUR, {_FMT}) END AS timestamp
FROM tx JOIN lr ON lr.l_orderkey = tx.o_orderkey
WHERE blockNumber NOT IN (SELECT block FROM bad)"""

SQL["blocks_with_unmatched_tx"] = """
SELECT o_orderkey // 50 AS blockNumber, count(*) AS n_unmatched FROM orders
WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem) GROUP BY 1"""

_TARGETS = """targets AS (
  SELECT generate_series AS target_ts FROM generate_series(
    (SELECT date_trunc('hour', min(ts)) FROM events), (SELECT date_trunc('hour', max(ts)) FROM events), INTERVAL 1 HOUR))"""

SQL["asof_block_before"] = W(BLOCK_TS, _TARGETS) + """
SELECT target_ts, (SELECT block FROM bt WHERE bt.ts <= target_ts ORDER BY bt.ts DESC, block DESC LIMIT 1) AS block
FROM targets"""

SQL["asof_block_after"] = W(BLOCK_TS, _TARGETS) + """
SELECT target_ts, (SELECT block FROM bt WHERE bt.ts >= target_ts ORDER BY bt.ts ASC, block ASC LIMIT 1) AS block
FROM targets"""

SQL["join_block_header"] = SQL["stamp_block_time"]

SQL["daily_price"] = W(DAILY) + """
SELECT price_date, round(usd, 4) AS price_usd, round(usd * fx, 4) AS price_krw FROM daily"""

SQL["missing_blocks"] = W(HI, PRESENT, MISSING) + "SELECT block FROM missing"

SQL["retry_subset"] = W(TX, HI, PRESENT, MISSING) + """
SELECT transactionHash, blockNumber FROM tx WHERE blockNumber IN (SELECT block FROM missing)"""

_PROFILE = """prof AS (
  SELECT "from" AS address, min(blockNumber) AS first_seen_block, min(ts) AS first_seen_timestamp,
    count(*) AS total_tx_count, CAST(sum(CAST(value AS HUGEINT)) AS VARCHAR) AS total_value, min(o_custkey) AS ck
  FROM tx GROUP BY 1)"""

SQL["new_holders"] = W(TX, _PROFILE) + """
SELECT address, first_seen_block, first_seen_timestamp, total_tx_count, total_value FROM prof WHERE ck % 3 = 0"""

# ------------------------------------------------------------- aggregations
SQL["count_per_hour"] = W(H) + "SELECT year, month, day, hour, count(*) AS n_rows FROM h GROUP BY ALL"

SQL["count_per_chunk"] = W(TX) + f"SELECT {_chunk('blockNumber', 100)} AS chunk, count(*) AS n_rows FROM tx GROUP BY 1"

SQL["next_block_asc"] = W(HI, PRESENT, MISSING) + """
SELECT CAST(CASE WHEN (SELECT min(block) FROM missing) IS NULL THEN (SELECT hi + 1 FROM hi)
  ELSE greatest(1, (CAST(ceil((SELECT min(block) FROM missing) / 7.0) AS BIGINT) - 1) * 7 + 1) END AS BIGINT) AS next_block"""

SQL["next_block_desc"] = W(HI, PRESENT, MISSING) + """
SELECT CAST(coalesce((SELECT max(block) FROM missing), 0) AS BIGINT) AS next_block,
  CAST(coalesce((SELECT min(block) FROM present, hi WHERE block BETWEEN 1 AND hi.hi) - 1, (SELECT hi FROM hi)) AS BIGINT)
    AS next_block_reference"""

SQL["chunk_completeness"] = W(HI, PRESENT) + _completeness(7) + "\nUNION ALL\n" + _completeness(10)

SQL["page_reconcile"] = W(TX) + """,
cnt AS (SELECT blockNumber, count(*) AS n FROM tx GROUP BY 1),
kept AS (SELECT * FROM tx WHERE (blockNumber + transactionIndex // 20) % 17 <> 0)
SELECT k.blockNumber AS block, c.n AS reported, count(*) AS received,
  CAST(ceil(c.n / 20.0) AS BIGINT) AS pages_expected, count(DISTINCT transactionIndex // 20) AS pages_received,
  count(*) <> c.n AS mismatch
FROM kept k JOIN cnt c USING (blockNumber) GROUP BY k.blockNumber, c.n"""

SQL["last_per_key"] = """
WITH r AS (
  SELECT l_orderkey // 50 AS blockNumber, '0x' || sha256(CAST(l_orderkey AS VARCHAR)) AS transactionHash,
    row_number() OVER (PARTITION BY l_orderkey // 50 ORDER BY l_orderkey % 50, l_linenumber, l_partkey, l_suppkey,
                       l_shipdate, l_extendedprice) - 1 AS ord,
    CAST(round(l_extendedprice) AS BIGINT) AS gasUsed,
    CASE WHEN l_linenumber % 2 = 1 THEN '0x1' ELSE '0x0' END AS status
  FROM lineitem)
SELECT blockNumber, transactionHash, max(ord) AS ord, arg_max(gasUsed, ord) AS gasUsed, arg_max(status, ord) AS status
FROM r GROUP BY 1, 2"""

SQL["address_profile"] = W(TX, _PROFILE) + """
SELECT address, first_seen_block, first_seen_timestamp, total_tx_count, total_value FROM prof"""

SQL["chunk_throughput"] = W(TX) + """,
m AS (SELECT blockNumber AS block, CASE WHEN blockNumber % 11 = 0 THEN 0 ELSE count(*) END AS n_tx,
        1 + blockNumber % 7 AS seconds FROM tx WHERE blockNumber % 13 <> 0 GROUP BY 1)
SELECT block // 10 AS chunk_id, CAST(sum(n_tx) AS BIGINT) AS n_rows, CAST(sum(seconds) AS BIGINT) AS seconds,
  round(sum(n_tx) / nullif(sum(seconds), 0), 4) AS tx_per_sec
FROM m GROUP BY 1"""

# -------------------------------------------------------------------- sorts
SQL["sort_block_tx"] = W(TX) + f"""
SELECT {_chunk('blockNumber', 100)} AS chunk,
  row_number() OVER (PARTITION BY blockNumber // 100 ORDER BY blockNumber, transactionIndex, transactionHash) AS pos,
  transactionHash FROM tx"""

SQL["top_holders"] = W(HOLDER) + """,
ranked AS (
  SELECT *, CASE WHEN c_custkey % 13 = 0 THEN 'N/A' ELSE address END AS shown FROM hr
  ORDER BY CAST(eth_balance AS DECIMAL(38,8)) DESC, shown, c_custkey + 1 LIMIT 1000)
SELECT shown AS address, eth_balance, CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE percentage END AS percentage
FROM ranked WHERE c_custkey % 11 <> 0 AND c_custkey % 5 <> 0 AND c_custkey % 7 <> 0"""

SQL["chunk_plan_asc"] = W(HI) + """
SELECT k - 1 AS chunk_no, CAST(greatest((k - 1) * 7 + 1, 1) AS BIGINT) AS chunk_start,
  CAST(least(k * 7, hi.hi) AS BIGINT) AS chunk_end
FROM hi, generate_series(1, CAST(ceil(hi.hi / 7.0) AS BIGINT)) g(k)"""

SQL["chunk_plan_desc"] = W(HI) + """
SELECT i AS chunk_no, CAST(greatest(hi.hi - i * 10 - 9, 1) AS BIGINT) AS chunk_start, CAST(hi.hi - i * 10 AS BIGINT) AS chunk_end
FROM hi, generate_series(0, (hi.hi - 1) // 10) g(i)"""

# --------------------------------------------------------------------- sets
SQL["union_retry"] = W(TX, FIRST_OK) + """
SELECT transactionHash, blockNumber, first_ok_attempt AS attempt
FROM tx JOIN fs ON fs.block = tx.blockNumber WHERE first_ok_attempt IS NOT NULL"""

SQL["recovered_blocks"] = W(FIRST_OK) + """
SELECT block FROM att WHERE attempt = 0 AND NOT ok
EXCEPT SELECT block FROM fs WHERE first_ok_attempt IS NULL"""

SQL["repeated_cursors"] = W(TX) + """,
pg AS (SELECT blockNumber, transactionIndex // 20 AS page, count(*) OVER (PARTITION BY blockNumber) AS n FROM tx),
p AS (SELECT DISTINCT blockNumber, page, n FROM pg WHERE (blockNumber + page) % 17 <> 0 AND page < (n - 1) // 20)
SELECT blockNumber AS block,
  'c' || CAST(blockNumber AS VARCHAR) || '_' || CAST(CASE WHEN blockNumber % 4 = 0 THEN 1 ELSE page + 1 END AS VARCHAR) AS nextCursor,
  count(*) AS n_seen
FROM p GROUP BY 1, 2 HAVING count(*) > 1"""

SQL["holder_registry"] = W(TX, _PROFILE, HOLDER) + """
SELECT address, 'top_holder_snapshot' AS note, CAST(NULL AS TIMESTAMP) AS detected_at,
  CAST(NULL AS BIGINT) AS first_seen_block, CAST(NULL AS BIGINT) AS total_tx_count
FROM hr WHERE c_custkey % 3 <> 0
UNION ALL
SELECT address, 'new_holder_detected', TIMESTAMP '2025-07-01 00:00:00', first_seen_block, total_tx_count
FROM prof WHERE ck % 3 = 0"""

# ----------------------------------------------------------------- scalars
SQL["hex_to_decimal"] = W(TX) + "SELECT transactionHash, value, CAST(gasPrice AS VARCHAR) AS gasPrice FROM tx"

SQL["hex_to_long"] = W(TX) + """
SELECT transactionHash, nonce, CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE gas END AS gas, gasPrice FROM tx"""

SQL["long_to_hex"] = "SELECT DISTINCT o_orderkey // 50 AS blockNumber, '0x' || lower(hex(o_orderkey // 50)) AS block_hex FROM orders"

SQL["hex_ts_to_kst"] = W(TX) + f"""
SELECT blockNumber, CASE WHEN blockNumber % 23 = 0 THEN '1970-01-01 09:00:00' ELSE strftime(min(ts) + INTERVAL 9 HOUR, {_FMT}) END
  AS timestamp FROM tx GROUP BY 1"""

SQL["epoch_to_kst"] = W(TX) + f"SELECT transactionHash, {_kst_text('ts')} AS timestamp FROM tx"

SQL["epoch_ns_to_ts"] = W(H) + "SELECT transactionHash, date_trunc('second', ts) AS timestamp FROM h"

SQL["pad_block_label"] = W(TX) + """
SELECT transactionHash, printf('%08d', blockNumber) AS label,
  CAST(month(ts + INTERVAL 9 HOUR) AS VARCHAR) AS month, CAST(day(ts + INTERVAL 9 HOUR) AS VARCHAR) AS day FROM tx"""

SQL["align_hour"] = W(H) + """
SELECT transactionHash, date_trunc('hour', ts) - INTERVAL 1 HOUR AS from_ts, date_trunc('hour', ts) AS to_ts FROM h"""

SQL["hour_series"] = W(HOURS.split("),\n  hk AS")[0] + ")") + "SELECT hour_ts FROM hours"

SQL["day_series"] = """
SELECT CAST(generate_series AS DATE) AS day FROM generate_series(
  (SELECT min(o_orderdate) FROM orders), (SELECT max(o_orderdate) FROM orders), INTERVAL 1 DAY)"""

SQL["decoded_to_json"] = W(TX) + """
SELECT transactionHash, '전송 ' || CAST(transactionIndex AS VARCHAR) AS note, CAST(2 AS BIGINT) AS n_args, value FROM tx"""

SQL["status_flag"] = W(TX) + "SELECT transactionHash, CASE WHEN o_orderstatus = 'F' THEN '1' ELSE '0' END AS status FROM tx"

SQL["convert_logs"] = W(LOGS) + """
SELECT '0x' || sha256(CAST(l_orderkey AS VARCHAR)) AS transactionHash, pos,
  '0x' || lpad(lower(hex(l_suppkey)), 40, '0') AS contractAddress, l_orderkey // 50 AS blockNumber,
  CAST(l_linenumber AS BIGINT) AS logIndex,
  CASE WHEN l_linenumber = 2 THEN false ELSE l_returnflag = 'R' END AS removed,
  CAST(CASE WHEN l_linenumber = 3 THEN 0 ELSE 2 END AS BIGINT) AS n_topics
FROM lg"""

SQL["empty_array_to_null"] = """
SELECT '0x' || sha256(CAST(o_orderkey AS VARCHAR)) AS transactionHash,
  o_orderkey NOT IN (SELECT l_orderkey FROM lineitem) AS logs_is_null FROM orders"""

SQL["shard_blocks"] = "SELECT DISTINCT o_orderkey // 50 AS block, (o_orderkey // 50 + 1) % 4 AS lane FROM orders"

# ------------------------------------------------------------------ streams
SQL["stream_hourly_load"] = SQL["tx_project_hourly"]

SQL["stream_hour_counts"] = "SELECT date_trunc('hour', ts) AS window_start, count(*) AS n_rows FROM events GROUP BY 1"

SQL["late_rows_split"] = W(H) + """
SELECT transactionHash, date_trunc('hour', ts + INTERVAL 10 MINUTE) AS slot_start,
  ts >= date_trunc('hour', ts + INTERVAL 10 MINUTE) AND ts < date_trunc('hour', ts + INTERVAL 10 MINUTE) + INTERVAL 1 HOUR AS in_slot
FROM h"""

SQL["stream_dedupe"] = W(H) + "SELECT transactionHash, ts FROM h"

SQL["stream_resume"] = W(H) + "SELECT transactionHash, year, month, day, hour FROM h"

SQL["recover_rounds"] = W(FIRST_OK) + "SELECT block, first_ok_attempt FROM fs WHERE first_ok_attempt IS NOT NULL"
