"""Reference SQL per query, straight from the tables, without any line parsing."""

from catalogue.queries import OUTLIER_COINS, SERIES_FIRST, SERIES_LAST
from catalogue.standin import STRAY_TEXT

# Generation transactions: first output, all outputs and their number per order.
_COINBASE = """
coinbase AS (
  SELECT l_orderkey,
         arg_min(CAST(l_extendedprice AS DECIMAL(18,8)),
                 (l_linenumber, l_partkey, l_suppkey, l_extendedprice)) AS first_value
  FROM lineitem GROUP BY l_orderkey
)"""

# Fees by the fixed rules.
_PARITY = f"""
WITH {_COINBASE},
fees AS (
  SELECT 210000 + o_orderkey AS height,
         CAST(first_value - 25 AS DECIMAL(18,8)) AS fee_btc
  FROM orders JOIN coinbase ON l_orderkey = o_orderkey
)
"""

_SUBSIDY = """CASE WHEN {h} // 210000 >= 64 THEN 0::BIGINT
  ELSE 5000000000::BIGINT >> CAST({h} // 210000 AS INTEGER) END"""


def _coin(satoshi: str) -> str:
    return f"CAST(CAST({satoshi} AS DECIMAL(28,8)) * 0.00000001 AS DECIMAL(18,8))"


def _satoshi(coins: str) -> str:
    return f"CAST(CAST({coins} AS DECIMAL(28,8)) * 100000000 AS BIGINT)"


def _era_fees(height: str) -> str:
    fee = f"CAST(first_value - {_coin(_SUBSIDY.format(h=f'({height})'))} AS DECIMAL(18,8))"
    return f"""
WITH {_COINBASE},
era AS (
  SELECT {height} AS height, {fee} AS fee_btc
  FROM orders JOIN coinbase ON l_orderkey = o_orderkey
),
fees AS (SELECT height, fee_btc, {_satoshi("fee_btc")} AS fee_sat FROM era)
"""


_TX = "sha256(CAST(o_orderkey AS VARCHAR))"
_PRICE_SAT = "CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 100 AS BIGINT)"
_ID = "(props->>'$.k')"
_RECORD = (
    f"""'{{"id":' || {_ID} || ',"event":' || event_id || ',"user":' || user_id"""
    """ || ',"type":"' || event_type || '"}'"""
)
_LATEST_JSON = (
    f"SELECT {_ID} AS rowkey, arg_max({_RECORD}, event_id) AS value FROM events GROUP BY 1"
)
_EXPLORER_TEXT = f"""
SELECT CAST(210000 + o_orderkey AS VARCHAR) AS height_text,
       CAST({_PRICE_SAT} AS VARCHAR) AS fee_text,
       ' ' || CAST({_PRICE_SAT} AS VARCHAR) AS fee_text_padded
FROM orders"""
_HEADERS = """
SELECT sha256('h' || o_orderkey) AS hash,
       o_custkey + 1 AS confirmations,
       o_custkey + 1000 AS size,
       210000 + o_orderkey AS height,
       CAST(2 AS INTEGER) AS version,
       o_orderkey * 600 + 1354116278 AS time,
       o_custkey AS nonce,
       lpad(printf('%x', o_custkey), 8, '0') AS bits,
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS difficulty,
       lpad(printf('%x', o_orderkey), 64, '0') AS chainwork,
       CASE WHEN o_orderkey = 0 THEN '' ELSE sha256('h' || (o_orderkey - 1)) END
         AS previousblockhash,
       CASE WHEN o_orderstatus <> 'P' THEN sha256('h' || (o_orderkey + 1)) END AS nextblockhash
FROM orders"""

# Characters between the colons of a printed block, from the lengths of its parts.
_SEGMENTS = """
WITH lines AS (
  SELECT line AS value
  FROM (
    SELECT '{u''hash'': u''' || sha256('h' || o_orderkey)
           || ''', u''confirmations'': ' || (o_custkey + 1)
           || ', u''size'': ' || (o_custkey + 1000)
           || ', u''bits'': u''' || lpad(printf('%x', o_custkey), 8, '0')
           || ''', u''nonce'': ' || o_custkey
           || ', u''tx'': [u''' || sha256('' || o_orderkey)
           || ''', u''' || sha256(o_orderkey || '-1')
           || ''', u''' || sha256(o_orderkey || '-2')
           || '''], u''merkleroot'': u''' || sha256('m' || o_orderkey)
           || ''', u''height'': ' || (210000 + o_orderkey)
           || ', u''version'': 2, u''time'': ' || (o_orderkey * 600 + 1354116278)
           || ', u''difficulty'': Decimal(''' || CAST(o_totalprice AS DECIMAL(18,2))
           || '''), u''chainwork'': u''' || lpad(printf('%x', o_orderkey), 64, '0') || ''''
           || CASE WHEN o_orderkey = 0 THEN '' ELSE ', u''previousblockhash'': u'''
                || sha256('h' || (o_orderkey - 1)) || '''' END
           || ', u''nextblockhash'': '
           || CASE WHEN o_orderstatus = 'P' THEN 'None'
                ELSE 'u''' || sha256('h' || (o_orderkey + 1)) || '''' END
           || '}' AS line
    FROM orders
  )
),
parts AS (SELECT string_split(value, ':') AS p FROM lines
          WHERE contains(value, '''previousblockhash'''))
SELECT CAST(pos - 1 AS INTEGER) AS pos, count(*) AS segments,
       CAST(sum(length(segment)) AS BIGINT) AS characters
FROM (SELECT unnest(p) AS segment, generate_subscripts(p, 1) AS pos FROM parts)
GROUP BY 1"""

ORACLES: dict[str, str] = {
    "q01_fee_node_batch": _PARITY + "SELECT height, fee_btc FROM fees",
    "q02_block_named_parse": f"SELECT 210000 + o_orderkey AS height, {_TX} AS txid FROM orders",
    "q03_fee_explorer_batch": _EXPLORER_TEXT,
    "q04_fee_explorer_units": f"""
SELECT 210000 + o_orderkey AS height, {_PRICE_SAT} AS fee_sat, {_coin(_PRICE_SAT)} AS fee_btc
FROM orders""",
    "q05_coinbase_ref": f"""
SELECT CAST(210000 + o_orderkey AS VARCHAR) AS height_text, {_TX} AS txid FROM orders""",
    "q06_text_normalise": r"""
SELECT doc_id, regexp_replace(text, '[^\x00-\x7F]', '', 'g') AS text FROM documents""",
    "q07_subsidy_by_height": f"""
SELECT o_orderkey * 60 AS height, {_SUBSIDY.format(h="(o_orderkey * 60)")} AS subsidy_sat
FROM orders""",
    "q08_fee_era": _era_fees("o_orderkey * 60") + "SELECT height, fee_btc, fee_sat FROM fees",
    "q09_put_rows": _PARITY + """
SELECT CAST(height AS VARCHAR) AS rowkey, 'tx_fee_col' AS family, 'tx_fee' AS qualifier,
       CAST(fee_btc AS VARCHAR) AS value, 'node' AS source, 'coin' AS unit
FROM fees""",
    "q10_latest_by_key": _LATEST_JSON,
    "q11_json_cells": f"""
SELECT {_ID} AS rowkey, 'cfamily' AS family, 'cats_json' AS qualifier, {_RECORD} AS value
FROM events""",
    "q12_pending_heights": """
SELECT r.range AS height
FROM range(210000, (SELECT 210001 + max(o_orderkey) FROM orders)) r
WHERE r.range NOT IN (SELECT 210000 + l_orderkey FROM lineitem)""",
    "q13_resume_filter": """
SELECT 210000 + o_orderkey AS height FROM orders
WHERE 210000 + o_orderkey > (SELECT (420000 + min(o_orderkey) + max(o_orderkey)) // 2 FROM orders)""",
    "q14_block_headers": _HEADERS,
    "q15_block_tx_edges": f"""
SELECT 210000 + o_orderkey AS height, CAST(0 AS INTEGER) AS pos, {_TX} AS txid FROM orders
UNION ALL SELECT 210000 + o_orderkey, 1, sha256(o_orderkey || '-1') FROM orders
UNION ALL SELECT 210000 + o_orderkey, 2, sha256(o_orderkey || '-2') FROM orders""",
    "q16_reward_all_outputs": """
SELECT 210000 + l_orderkey AS height, sha256(CAST(l_orderkey AS VARCHAR)) AS txid,
       CAST(count(*) AS INTEGER) AS n_outputs,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,8))) AS DECIMAL(28,8)) AS total_value,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,8))) - 25 AS DECIMAL(18,8)) AS fee_btc
FROM lineitem GROUP BY l_orderkey""",
    "q17_fee_series_slice": _PARITY + f"""
SELECT height, fee_btc FROM fees
WHERE height BETWEEN {SERIES_FIRST} AND {SERIES_LAST} ORDER BY height, fee_btc""",
    "q18_fee_series_bucket": _PARITY + """
SELECT height - height % 1000 AS bucket_start, count(*) AS blocks, min(fee_btc) AS min_fee,
       max(fee_btc) AS max_fee, CAST(sum(fee_btc) AS DECIMAL(28,8)) AS sum_fee
FROM fees GROUP BY 1""",
    "q19_fee_topk": _PARITY + """
SELECT height, fee_btc FROM fees ORDER BY fee_btc DESC, height LIMIT 10""",
    "q20_mode_reconcile": _era_fees("210000 + o_orderkey") + f""",
node AS (SELECT height, min(fee_sat) AS node_fee_sat, max(fee_sat) AS node_max
         FROM fees GROUP BY height),
stated AS (SELECT 210000 + o_orderkey AS height, {_PRICE_SAT} AS fee_sat
           FROM orders),
explorer AS (SELECT height, min(fee_sat) AS explorer_fee_sat, max(fee_sat) AS explorer_max
             FROM stated GROUP BY height)
SELECT height, node_fee_sat, explorer_fee_sat,
       node_fee_sat - explorer_fee_sat AS difference_sat,
       CASE WHEN node_fee_sat <> node_max OR explorer_fee_sat <> explorer_max THEN 'ambiguous'
            WHEN node_fee_sat IS NULL THEN 'explorer_only'
            WHEN explorer_fee_sat IS NULL THEN 'node_only'
            WHEN node_fee_sat = explorer_fee_sat THEN 'match' ELSE 'differ' END AS status
FROM node FULL JOIN explorer USING (height)""",
    "q21_quarantine": """
SELECT CASE WHEN o_orderpriority = '1-URGENT' THEN 'stray_text'
            WHEN o_orderpriority = '2-HIGH' THEN 'empty_line'
            WHEN o_orderpriority = '3-MEDIUM' THEN 'truncated'
            WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'F' THEN 'bad_height'
            WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'O' THEN 'bad_txid'
            ELSE CASE WHEN o_orderkey IN (SELECT l_orderkey FROM lineitem) THEN 'ok'
                      ELSE 'missing_transaction' END END AS reason,
       count(*) AS lines
FROM orders GROUP BY 1""",
    "q22_stream_fee_node": _PARITY + "SELECT height, fee_btc FROM fees",
    "q23_stream_fee_explorer": f"""
SELECT height_text AS rowkey, fee_text AS value FROM ({_EXPLORER_TEXT})""",
    "q24_stream_json_upsert": _LATEST_JSON,
    "q25_fee_text_scan": _era_fees("210000 + o_orderkey") + f"""
SELECT height, fee_btc, fee_sat, 'node' AS source FROM fees
UNION ALL
SELECT 210000 + o_orderkey, {_coin(_PRICE_SAT)}, {_PRICE_SAT}, 'explorer' FROM orders""",
    "q26_blocks_by_height": f"""
SELECT 210000 + o_orderkey AS height, sha256('h' || o_orderkey) AS hash,
       sha256('m' || o_orderkey) AS merkleroot
FROM orders WHERE 210000 + o_orderkey >= {SERIES_FIRST}
  AND 210000 + o_orderkey < {SERIES_LAST}""",
    "q27_fee_table_upsert": _era_fees("210000 + o_orderkey") + f""",
puts AS (SELECT height, CAST(fee_btc AS VARCHAR) AS value, 'node' AS source, 'coin' AS unit,
                CASE WHEN height % 2 = 0 THEN 5 ELSE 3 END::BIGINT AS put_id FROM fees
         UNION ALL SELECT 210000 + o_orderkey, CAST({_PRICE_SAT} AS VARCHAR), 'explorer', 'satoshi', 0
         FROM orders)
SELECT CAST(height AS VARCHAR) AS rowkey, 'tx_fee_col' AS family, 'tx_fee' AS qualifier,
       value, source, unit, put_id, source AS put_by
FROM puts""",
    "q28_fee_outliers": _PARITY + f"""
SELECT height, fee_btc FROM fees WHERE fee_btc > {OUTLIER_COINS}""",
    "q29_line_segments": _SEGMENTS,
    "q30_progress_marker": _PARITY + """
SELECT max(height) AS last_block_processed FROM fees""",
    "q31_fee_nested_outputs": f"""
WITH {_COINBASE},
totals AS (SELECT l_orderkey, sum(CAST(l_extendedprice AS DECIMAL(18,8))) AS total FROM lineitem GROUP BY 1)
SELECT 210000 + o_orderkey AS height,
       CAST(first_value - {_coin(_SUBSIDY.format(h="(210000 + o_orderkey)"))} AS DECIMAL(18,8)) AS first_fee,
       CAST(total - {_coin(_SUBSIDY.format(h="(210000 + o_orderkey)"))} AS DECIMAL(18,8)) AS all_fee
FROM orders JOIN coinbase ON coinbase.l_orderkey = o_orderkey
JOIN totals ON totals.l_orderkey = o_orderkey""",
    "q32_text_escapes": r"""
SELECT doc_id, regexp_replace(text, '[^\x00-\x7F]', '', 'g') AS text FROM documents""",
    "q33_rounded_amounts": """
SELECT o_orderkey, CAST(round(CAST(o_totalprice AS DECIMAL(18,2)) * 0.123456789::DECIMAL(10,9), 8)
                        AS DECIMAL(18,8)) AS amount
FROM orders""",
    "q34_quarantine_explorer": """
SELECT CASE o_orderstatus WHEN 'P' THEN 'bad_fee' WHEN 'F' THEN 'bad_height' ELSE 'ok' END AS reason,
       count(*) AS lines
FROM orders GROUP BY 1""",
    "q35_quarantine_json": """
SELECT CASE event_type WHEN 'click' THEN 'no_id' WHEN 'view' THEN 'bad_json' WHEN 'purchase' THEN 'bad_id'
            ELSE 'ok' END AS reason,
       count(*) AS lines
FROM events GROUP BY 1""",
    "q36_corrected_lookup": f"""
WITH {_COINBASE},
totals AS (SELECT l_orderkey, sum(CAST(l_extendedprice AS DECIMAL(18,8))) AS total, count(*) AS n
           FROM lineitem GROUP BY 1)
SELECT 210000 + o_orderkey AS height,
       CAST(first_value + CASE WHEN o_orderkey % 3 = 0 THEN 5 ELSE 0 END AS DECIMAL(18,8)) AS first_value,
       CAST(total - CASE WHEN o_orderkey % 3 = 0 THEN 3 ELSE 0 END AS DECIMAL(28,8)) AS total_value,
       CAST(n AS INTEGER) AS n_outputs,
       CASE WHEN n IS NULL THEN 'missing_transaction' END AS reason
FROM orders LEFT JOIN coinbase ON coinbase.l_orderkey = o_orderkey
LEFT JOIN totals ON totals.l_orderkey = o_orderkey""",
}

ORACLES["q37_redriven_fees"] = _era_fees("210000 + o_orderkey") + """
SELECT CAST(height AS VARCHAR) AS rowkey, CAST(fee_btc AS VARCHAR) AS value, 'node' AS source, 'coin' AS unit,
       CASE WHEN (height - 210000) % 3 = 0 THEN 'redrive' ELSE 'batch' END AS put_by,
       CASE WHEN (height - 210000) % 3 = 0 THEN 1 ELSE 0 END::BIGINT AS put_id
FROM fees"""

ORACLES["q38_pending_ranges"] = """
WITH missing AS (
  SELECT r.range AS height FROM range(210000, (SELECT 210001 + max(o_orderkey) FROM orders)) r
  WHERE r.range NOT IN (SELECT 210000 + l_orderkey FROM lineitem)
), islands AS (SELECT height, height - row_number() OVER (ORDER BY height) AS island FROM missing)
SELECT min(height) AS first, max(height) AS last FROM islands GROUP BY island"""

ORACLES["q39_contiguous_marker"] = """
WITH missing AS (
  SELECT r.range AS height FROM range(210000, (SELECT 210002 + max(l_orderkey) FROM lineitem)) r
  WHERE r.range NOT IN (SELECT 210000 + l_orderkey FROM lineitem)
)
SELECT CASE WHEN min(height) > 210000 THEN min(height) - 1 END AS last_block_processed FROM missing"""

ORACLES["q40_put_counts"] = ORACLES["q21_quarantine"]

ORACLES["q41_header_slice"] = f"""
SELECT height, hash, difficulty, previousblockhash, CASE WHEN height < {SERIES_FIRST + 500} THEN 1 ELSE 0 END::BIGINT AS put_id
FROM ({_HEADERS}) WHERE height >= {SERIES_FIRST} AND height < {SERIES_LAST}"""

ORACLES["q42_headers_of_pending"] = f"""
SELECT height, hash, nonce FROM ({_HEADERS}) WHERE height NOT IN (SELECT 210000 + l_orderkey FROM lineitem)"""

ORACLES["q43_edge_slice"] = f"""
SELECT height, pos, txid FROM ({ORACLES["q15_block_tx_edges"]})
WHERE height >= {SERIES_FIRST} AND height < {SERIES_LAST}"""

ORACLES["q44_buckets_refreshed"] = f"""
WITH {_COINBASE},
totals AS (SELECT l_orderkey, sum(CAST(l_extendedprice AS DECIMAL(18,8))) AS total FROM lineitem GROUP BY 1),
fees AS (
  SELECT 210000 + o_orderkey AS height,
         CAST(CASE WHEN 210000 + o_orderkey >= {SERIES_LAST} THEN total ELSE first_value END
              - {_coin(_SUBSIDY.format(h="(210000 + o_orderkey)"))} AS DECIMAL(18,8)) AS fee_btc
  FROM orders JOIN coinbase ON coinbase.l_orderkey = o_orderkey JOIN totals ON totals.l_orderkey = o_orderkey
)
SELECT height - height % 1000 AS bucket_start, count(*) AS blocks, min(fee_btc) AS min_fee,
       max(fee_btc) AS max_fee, CAST(sum(fee_btc) AS DECIMAL(28,8)) AS sum_fee
FROM fees GROUP BY 1"""

ORACLES["q45_reconcile_by_bucket"] = ORACLES["q20_mode_reconcile"]

ORACLES["q46_positional_series"] = _PARITY + """
SELECT 209999 + row_number() OVER (ORDER BY height, fee_btc) AS position, height, fee_btc FROM fees"""

ORACLES["q47_whole_files"] = ORACLES["q02_block_named_parse"]

ORACLES["q48_bounded_preview"] = _PARITY + """
SELECT height, fee_btc FROM fees ORDER BY height, fee_btc LIMIT 200"""

ORACLES["q49_interval_stream"] = ORACLES["q23_stream_fee_explorer"]

ORACLES["q50_stream_preview"] = """
SELECT CAST(0 AS INTEGER) AS batch, least(200, count(*)) AS shown FROM orders"""
