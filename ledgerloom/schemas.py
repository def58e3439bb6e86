"""Schemas, declared and never inferred."""

from __future__ import annotations

KEY_VALUE = "key binary, key_text string, value binary"
STORE = f"{KEY_VALUE}, db string"
EVENT = "struct<type:string,attributes:array<struct<key:string,value:string>>>"
RESULT = f"struct<code:int,log:string,gas_used:bigint,events:array<{EVENT}>>"
BLOCK = f"height bigint, hash binary, ts timestamp, txs array<binary>, results array<{RESULT}>"
LOG = "struct<address:binary,topics:array<binary>,data:binary,block:bigint,tx_index:bigint,index:bigint>"
RECEIPT = (
    f"status int, cumulative_gas_used bigint, logs_bloom binary, logs array<{LOG}>, transaction_hash binary, gas_used bigint, block_hash binary, "
    "block_number bigint, transaction_index bigint, `from` binary, `to` binary, type int, contract_address binary, effective_gas_price decimal(38,0)"
)
MAPPING = "denom string, kind string, contract binary"
REVERSE = "contract binary, denom string"
KEY_REGISTRY = "address string, key string"
WAL = "version bigint, name string, pairs array<struct<delete:boolean,key:binary,value:binary>>, upgrades array<struct<name:string,rename_from:string,delete:boolean>>"
BLOCK_STATS = "height bigint, n_txs int, ts timestamp"
PARAMS = "ibc_denom string, ibc_timeout bigint, admin string, enable_auto_deployment boolean, max_callback_gas bigint"
GENESIS = f"params struct<{','.join(p.replace(' ', ':', 1) for p in PARAMS.split(', '))}>, external_contracts array<struct<denom:string,contract:string>>, auto_contracts array<struct<denom:string,contract:string>>"
