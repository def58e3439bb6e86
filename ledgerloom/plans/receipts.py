"""Receipt queries: an order is a block, its lines are transactions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.receipts import cumulative_gas, fix_last_receipt, replay_cumulative_gas
from .tables import MESSAGES_SQL, messages

COLUMNS = ["block", "tx", "tx_index", "gas_used", "cumulative_gas_used", "status"]


def receipts_cumulative_gas(spark, sf_dir):
    return cumulative_gas(messages(spark, sf_dir)).select(*COLUMNS)


def replay_gas(spark, sf_dir):
    return replay_cumulative_gas(messages(spark, sf_dir)).select(*COLUMNS)


def last_receipt_fixup(spark, sf_dir):
    receipts = replay_cumulative_gas(messages(spark, sf_dir))
    return fix_last_receipt(receipts, F.col("block") % 2 == 0, F.col("gas_used") + 7).select(*COLUMNS)


_WINDOW = "OVER (PARTITION BY block ORDER BY tx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"

RECEIPTS_SQL = f"""
WITH {MESSAGES_SQL},
kept AS (SELECT *, CAST(sum(CASE WHEN is_evm OR code = 0 THEN gas_used ELSE 0 END) {_WINDOW} AS BIGINT) AS cumulative_gas_used,
                CAST(sum(CASE WHEN is_evm THEN 1 ELSE 0 END) {_WINDOW} - 1 AS BIGINT) AS tx_index
         FROM messages WHERE code = 0 OR over_limit)
SELECT block, tx, tx_index, gas_used, cumulative_gas_used, CAST(CASE WHEN code <> 0 OR failed THEN 0 ELSE 1 END AS INTEGER) AS status
FROM kept WHERE is_evm"""

REPLAY_SQL = f"""
WITH {MESSAGES_SQL}
SELECT block, tx, CAST(count(*) {_WINDOW} - 1 AS BIGINT) AS tx_index, gas_used, CAST(sum(gas_used) {_WINDOW} AS BIGINT) AS cumulative_gas_used,
       CAST(CASE WHEN failed THEN 0 ELSE 1 END AS INTEGER) AS status
FROM messages WHERE (code = 0 OR over_limit) AND is_evm"""

FIXUP_SQL = f"""
WITH r AS ({REPLAY_SQL}),
marked AS (SELECT *, block % 2 = 0 AND row_number() OVER (PARTITION BY block ORDER BY tx_index DESC) = 1 AS is_last FROM r)
SELECT block, tx, tx_index, CASE WHEN is_last THEN gas_used + 7 ELSE gas_used END AS gas_used,
       CASE WHEN is_last THEN cumulative_gas_used + 7 ELSE cumulative_gas_used END AS cumulative_gas_used,
       CAST(CASE WHEN is_last THEN 0 ELSE status END AS INTEGER) AS status
FROM marked"""

QUERIES = {"receipts_cumulative_gas": receipts_cumulative_gas, "replay_cumulative_gas": replay_gas, "last_receipt_fixup": last_receipt_fixup}
ORACLES = {"receipts_cumulative_gas": RECEIPTS_SQL, "replay_cumulative_gas": REPLAY_SQL, "last_receipt_fixup": FIXUP_SQL}
