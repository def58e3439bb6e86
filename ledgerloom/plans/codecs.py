"""Codec queries: hashes, addresses, blooms, ABI and protobuf data, key bounds and display, over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import encoding as X
from ..functions import keys as K
from ..functions import proto
from ..functions.amounts import context_height
from ..functions.denoms import Denoms, channel_name, display_symbol, evm_denom
from ..operators import contracts as C
from ..operators.ledger import genesis_token
from ..operators.patch import eth_hash_of
from . import twins as T
from .tables import local_rows, table


def _sha(column, size=64):
    """The first ``size`` hex digits of a column's SHA-256."""
    return F.substring(F.sha2(column, 256), 1, size)


def _address(column):
    return F.unhex(_sha(column, 40))


def _word(n):
    """32 big-endian bytes of a whole number."""
    return F.unhex(F.lpad(F.hex(n.cast("bigint")), 64, "0"))


# ------------------------------------------------------------------ hashes and addresses


def keccak_topic(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", F.lower(F.hex(X.keccak(F.col("p_name").cast("binary")))).alias("topic"))


def keccak_lengths(spark, sf_dir):
    """Messages of 0 to 135 bytes: every padding of one block."""
    data = F.expr("substring(repeat(sha2(c_name, 256), 3), 1, CAST(c_custkey % 136 AS INT))")
    return table(spark, sf_dir, "customer").select("c_custkey", F.lower(F.hex(X.keccak(data.cast("binary")))).alias("hash"))


def created_addresses(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", X.checksummed(X.contract_address(_address("c_name"), F.col("c_custkey") * 97)).alias("contract"))


def bech32_addresses(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", X.to_bech32(_address("c_name"), "acc").alias("account"), X.to_bech32(_address("c_name"), "accval").alias("validator"))


def bech32_roundtrip(spark, sf_dir):
    """Decoded again, and what a changed last letter decodes to."""
    rows = table(spark, sf_dir, "customer").select("c_custkey", _address("c_name").alias("address")).withColumn("text", X.to_bech32(F.col("address"), "acc"))
    wrong = F.concat(F.expr("substring(text, 1, length(text) - 1)"), F.when(F.right("text", F.lit(1)) == "q", "p").otherwise("q"))
    return rows.select("c_custkey", (X.from_bech32(F.col("text")) == F.col("address")).alias("same"), X.from_bech32(wrong).isNull().alias("refused"))


def address_forms(spark, sf_dir):
    """Hex with and without 0x, bech32 of accounts and validators, and what is no address."""
    digits = _sha("c_name", 40)
    text = F.when(F.col("c_custkey") % 5 == 0, digits).when(F.col("c_custkey") % 5 == 1, F.concat(F.lit("0x"), F.upper(digits))).when(F.col("c_custkey") % 5 == 2, X.to_bech32(F.unhex(digits), "acc"))
    text = text.when(F.col("c_custkey") % 5 == 3, X.to_bech32(F.unhex(digits), "accval")).otherwise(F.col("c_name"))
    rows = table(spark, sf_dir, "customer").select("c_custkey", text.alias("text"))
    return rows.select("c_custkey", F.lower(F.hex(X.address_of(F.col("text"), "acc", "accval"))).alias("address"))


def genesis_storage(spark, sf_dir):
    """Storage slots of a token contract: Keccak of the padded address and the slot's number."""
    rows = genesis_token(table(spark, sf_dir, "supplier").select(_address("s_name").alias("address")), 10**20, 2)
    return rows.select(*[F.lower(F.hex(c)).alias(c) for c in ("address", "key", "value")])


# ------------------------------------------------------------------ blooms


def bloom_member(spark, sf_dir):
    """Suppliers' names against the merged bloom of their nation, and against the next nation's."""
    parts = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", F.col("s_name").cast("binary").alias("item")).withColumn("bloom", X.logs_bloom(F.col("item"), F.array().cast("array<binary>")))
    blooms = parts.groupBy("s_nationkey").agg(X.bloom_or(F.col("bloom")).alias("merged"))
    asked = parts.select("s_suppkey", "item", F.explode(F.array("s_nationkey", (F.col("s_nationkey") + 1) % 25)).alias("s_nationkey"))
    return asked.join(blooms, "s_nationkey").select("s_suppkey", "s_nationkey", X.bloom_contains(F.col("merged"), F.col("item")).alias("member"))


def bloom_union(spark, sf_dir):
    """All 2048 bits: the blooms of each brand's part names, or-ed."""
    parts = table(spark, sf_dir, "part").select("p_brand", X.logs_bloom(F.col("p_name").cast("binary"), F.array(F.col("p_type").cast("binary"))).alias("bloom"))
    return parts.groupBy("p_brand").agg(F.lower(F.hex(X.bloom_or(F.col("bloom")))).alias("bloom"))


# ------------------------------------------------------------------ ABI, numbers and other encodings


def abi_words(spark, sf_dir):
    """Static words, dynamic text and an indexed address of log data."""
    name = F.col("c_name").cast("binary")
    body = F.concat(name, F.expr("unhex(repeat('00', CAST(pmod(-length(c_name), 32) AS INT)))"))
    data = F.concat(F.lit(bytes(12)), _address("c_name"), _word(F.lit(96)), _word(F.col("c_custkey") * 1_000_003), _word(F.length("c_name")), body)
    rows = table(spark, sf_dir, "customer").select("c_custkey", data.alias("data"), F.concat(F.lit(bytes(12)), _address("c_name")).alias("topic"))
    return rows.select(
        "c_custkey", F.lower(F.hex(C.abi_address(F.col("data"), 0))).alias("owner"), C.abi_text(F.col("data"), 1).alias("name"), C.abi_amount(F.col("data"), 2).cast("string").alias("amount"),
        F.lower(F.hex(X.topic_address(F.col("topic")))).alias("indexed"), C.abi_text(F.expr("substring(data, 1, length(data) - 32)"), 1).isNull().alias("cut_off"),
    )


def base64_bodies(spark, sf_dir):
    """Base64 is decoded, other text stays; hex data of odd length is none."""
    odd = F.col("p_partkey") % 3 == 0
    rows = table(spark, sf_dir, "part").select("p_partkey", "p_name", F.when(odd, F.concat(F.lit("-"), F.col("p_name"))).otherwise(F.base64(F.col("p_name").cast("binary"))).alias("text"))
    digits = F.concat(F.lit("0x"), F.hex("p_name"), F.when(odd, "0").otherwise(""))
    return rows.select("p_partkey", X.base64_or_raw(F.col("text")).alias("text"), X.from_hex_data(digits).cast("string").alias("body"))


def block_meta_hash(spark, sf_dir):
    """The block hash in a block's stored head; heads that are cut off have none."""
    meta = F.concat(F.lit(bytes([0x0A, 0x22, 0x0A, 0x20])), F.unhex(F.sha2(F.col("o_orderkey").cast("string"), 256)), F.lit(bytes([0x12, 0])))
    cut = F.when(F.col("o_orderkey") % 7 == 0, F.substring(meta, 1, 34)).otherwise(meta)
    return table(spark, sf_dir, "orders").select("o_orderkey", F.lower(F.hex(proto.block_hash(cut))).alias("hash"))


def with_tx_result(rows, height, index, tx_hash, evm, into):
    """Adds a serialised transaction result with one event that names the hash (if ``evm``).

    Message by message: each level's bytes are a column, since a field's length and its body both read them.
    """
    field = lambda number, body: F.concat(F.unhex(F.lpad(F.hex(F.lit(number << 3 | 2)), 2, "0")), proto.varint_of(F.length(body), 5), body)
    fixed = lambda number, text: F.lit(bytes([number << 3 | 2, len(text)]) + text.encode())
    out = rows.withColumn("_hash", tx_hash.cast("binary"))
    out = out.withColumn("_attribute", F.concat(fixed(1, "ethereumTxHash"), field(2, F.col("_hash"))))
    out = out.withColumn("_event", F.concat(fixed(1, "ethereum_tx"), F.lit(b"\x12\x0a\x0a\x05other\x12\x01x"), field(2, F.col("_attribute"))))
    out = out.withColumn("_result", F.when(evm, field(7, F.col("_event"))).otherwise(F.lit(b"")))
    out = out.withColumn(into, F.concat(F.lit(b"\x08"), proto.varint_of(height), F.lit(b"\x10"), proto.varint_of(index), field(4, F.col("_result"))))
    return out.drop("_hash", "_attribute", "_event", "_result")


def tx_result_decode(spark, sf_dir):
    """Height, index and Ethereum hash of serialised results; every third is no EVM transaction, every 11th is cut off."""
    digest = F.sha2(F.concat_ws("/", "o_orderkey", "o_custkey"), 256)
    named = F.when(F.col("o_orderkey") % 2 == 0, digest).otherwise(F.concat(F.lit("0x"), digest))
    made = with_tx_result(table(spark, sf_dir, "orders"), F.col("o_orderkey"), F.col("o_custkey"), named, F.col("o_orderkey") % 3 != 0, "value")
    rows = made.select("o_orderkey", F.when(F.col("o_orderkey") % 11 == 0, F.lit(b"\x22\x7f\x00")).otherwise(F.col("value")).alias("value"))
    found = rows.withColumn("r", proto.decode_tx_result(F.col("value")))
    return found.select("o_orderkey", F.col("r.height").alias("height"), F.col("r.index").alias("idx"), eth_hash_of(F.col("r.events")).alias("eth_hash"))


def state_change_files(spark, sf_dir):
    """A file per customer's state changes: a length and delimited messages, read back pair by pair."""
    small = lambda n: F.lpad(F.hex(n.cast("bigint")), 2, "0")
    field = lambda number, digits: F.concat(F.lit(f"{number << 3 | 2:02x}"), small(F.length(digits) / 2), digits)
    gone = F.when(F.col("o_orderstatus") == "F", F.lit("1001")).otherwise(F.lit(""))
    body = F.concat(field(1, F.lit(b"bank".hex())), gone, field(3, F.hex(F.col("o_orderkey").cast("string"))), field(4, F.hex(F.col("o_orderpriority"))))
    pairs = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.concat(small(F.length(body) / 2), body).alias("m"))
    files = pairs.groupBy("o_custkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("o_orderkey", "m"))), lambda x: x["m"]), "").alias("all"))
    content = F.concat(X.u64_bytes(F.length("all") / 2), F.unhex("all"))
    found = proto.read_state_files(files.select(F.col("o_custkey").cast("string").alias("path"), content.alias("content")))
    return found.select("path", "position", "store", "deleted", F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))


# ------------------------------------------------------------------ keys


def prefix_bounds(spark, sf_dir):
    """The least key above a prefix: carried over FF bytes, none for FF alone."""
    tail = F.when(F.col("p_partkey") % 4 == 0, F.lit(b"")).when(F.col("p_partkey") % 4 == 1, F.lit(b"\xff")).otherwise(F.lit(b"\xff\xff"))
    prefix = F.concat(F.when(F.col("p_partkey") % 4 == 3, F.lit(b"")).otherwise(F.col("p_name").cast("binary")), tail)
    return table(spark, sf_dir, "part").select("p_partkey", F.lower(F.hex(K.after_prefix_column(prefix))).alias("bound"))


def _shown(spark, sf_dir):
    raw = F.unhex(F.sha2(F.col("p_name"), 256))
    data = F.when(F.col("p_partkey") % 4 == 0, F.col("p_name").cast("binary")).when(F.col("p_partkey") % 4 == 1, raw).when(F.col("p_partkey") % 4 == 2, F.lit(b"")).otherwise(F.substring(raw, 1, 3))
    return table(spark, sf_dir, "part").select("p_partkey", "p_name", data.alias("data"))


def key_display(spark, sf_dir):
    return _shown(spark, sf_dir).select("p_partkey", K.show_key(F.col("data"), 10).alias("shown"))


def value_display(spark, sf_dir):
    return _shown(spark, sf_dir).select("p_partkey", K.show_value(F.col("data"), 8).alias("shown"))


def strategy_names(spark, sf_dir):
    names = ["ask", "skip", "replace", "replace_all", "other"]
    return local_rows(spark, [(n, K.show_strategy(n)) for n in names], "name string, shown string")


SPECS = ["", "123456", "10000-20000", "10000 - 20000", "123456, 234567", "1,2,3,4,5,6", "0", "0-0", "5-", "-123", "20000-10000", "abc", "10-20-30", ",,,", "123456,,234567", "123456,abc"]


def height_specs(spark, sf_dir):
    """Height specs as they are read, shown and refused."""

    def read(text):
        try:
            s = K.parse_heights(text)
            s.validate()
        except ValueError:
            return (text, "error", None, None, None, None)
        return (text, "empty" if s.is_empty else "list" if s.is_list else "range", s.start, s.end, ",".join(map(str, s.heights)), str(s))

    return local_rows(spark, [read(t) for t in SPECS], "spec string, kind string, low long, high long, heights string, shown string")


def database_names(spark, sf_dir):
    """Lists and groups of databases, and which have heights."""
    asked = [("", "app"), ("", "cometbft"), ("", "all"), (" state , tx_index", "app"), ("nope", "all"), ("", "nope"), (",", "all")]

    def read(names, group):
        try:
            return ",".join(K.parse_databases(names, group))
        except ValueError:
            return None

    rows = [(n, g, found := read(n, g), None if found is None else ",".join(d for d in found.split(",") if K.supports_heights(d))) for n, g in asked]
    return local_rows(spark, rows, "names string, `group` string, databases string, with_heights string")


def denom_names(spark, sf_dir):
    """Names made from symbols, channels and contracts, and the height a block's state is of."""
    d = Denoms("source")
    rows = table(spark, sf_dir, "customer")
    return rows.select(
        "c_custkey", display_symbol(F.col("c_mktsegment")).alias("symbol"), channel_name(F.col("c_nationkey")).alias("channel"), evm_denom("evm/", _address("c_name")).alias("evm_denom"),
        d.contract(F.concat(F.lit("gravity0x"), _sha("c_name", 40))).alias("contract"), context_height(F.col("c_custkey")).alias("context"),
    )


QUERIES = {f.__name__: f for f in (
    keccak_topic, keccak_lengths, created_addresses, bech32_addresses, bech32_roundtrip, address_forms, genesis_storage, bloom_member, bloom_union, abi_words, base64_bodies,
    block_meta_hash, tx_result_decode, state_change_files, prefix_bounds, key_display, value_display, strategy_names, height_specs, database_names, denom_names,
)}

_ADDRESS = "substr(sha256({}), 1, 40)"
_BITS = T.let("bh", "{}", "[(CAST(concat(chr(48), chr(120), substr(bh, 1, 4)) AS BIGINT)) & 2047, (CAST(concat(chr(48), chr(120), substr(bh, 5, 4)) AS BIGINT)) & 2047, (CAST(concat(chr(48), chr(120), substr(bh, 9, 4)) AS BIGINT)) & 2047]")
_BYTES = "lower(hex({}))"
_SHOWN = "s AS (SELECT p_partkey, p_name, sha256(p_name) AS h FROM part)"

ORACLES = {
    "keccak_topic": f"SELECT p_partkey, {T.keccak(_BYTES.format('p_name'))} AS topic FROM part",
    "keccak_lengths": f"SELECT c_custkey, {T.keccak(_BYTES.format('substr(repeat(sha256(c_name), 3), 1, CAST(c_custkey % 136 AS INTEGER))'))} AS hash FROM customer",
    "created_addresses": f"SELECT c_custkey, {T.checksum_address(T.created_address(_ADDRESS.format('c_name'), 'c_custkey * 97'))} AS contract FROM customer",
    "bech32_addresses": f"SELECT c_custkey, {T.bech32('acc', _ADDRESS.format('c_name'))} AS account, {T.bech32('accval', _ADDRESS.format('c_name'))} AS validator FROM customer",
    "bech32_roundtrip": "SELECT c_custkey, true AS same, true AS refused FROM customer",
    "address_forms": f"SELECT c_custkey, CASE WHEN c_custkey % 5 < 4 THEN {_ADDRESS.format('c_name')} END AS address FROM customer",
    "genesis_storage": f"SELECT a AS address, {T.keccak(chr(39) + '0' * 24 + chr(39) + ' || a || ' + chr(39) + '2'.rjust(64, '0') + chr(39))} AS key, lpad('56bc75e2d63100000', 64, '0') AS value FROM (SELECT {_ADDRESS.format('s_name')} AS a FROM supplier)",
    "bloom_member": f"""WITH b AS (SELECT s_suppkey, CAST(s_nationkey AS BIGINT) AS n, {_BITS.format(T.keccak(_BYTES.format('s_name')))} AS bits FROM supplier),
        m AS (SELECT n, list(DISTINCT x) AS merged FROM (SELECT n, unnest(bits) AS x FROM b) GROUP BY 1),
        a AS (SELECT s_suppkey, bits, unnest([n, (n + 1) % 25]) AS n FROM b)
        SELECT s_suppkey, CAST(n AS INTEGER) AS s_nationkey, list_has_all(merged, bits) AS member FROM a JOIN m USING (n)""",
    "bloom_union": f"""WITH b AS (SELECT DISTINCT p_brand, unnest(list_concat({_BITS.format(T.keccak(_BYTES.format('p_name')))}, {_BITS.format(T.keccak(_BYTES.format('p_type')))})) AS x FROM part),
        y AS (SELECT p_brand, 255 - x // 8 AS byte, sum(1 << (x % 8)) AS v FROM b GROUP BY 1, 2), e AS (SELECT p_brand, unnest(range(256)) AS byte FROM (SELECT DISTINCT p_brand FROM part))
        SELECT e.p_brand, string_agg(lpad(lower(to_hex(coalesce(CAST(v AS BIGINT), 0))), 2, '0'), '' ORDER BY e.byte) AS bloom FROM e LEFT JOIN y ON e.p_brand = y.p_brand AND e.byte = y.byte GROUP BY 1""",
    "abi_words": f"SELECT c_custkey, {_ADDRESS.format('c_name')} AS owner, c_name AS name, CAST(c_custkey * 1000003 AS VARCHAR) AS amount, {_ADDRESS.format('c_name')} AS indexed, true AS cut_off FROM customer",
    "base64_bodies": "SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN '-' || p_name ELSE p_name END AS text, CASE WHEN p_partkey % 3 <> 0 THEN p_name END AS body FROM part",
    "block_meta_hash": "SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN sha256(CAST(o_orderkey AS VARCHAR)) END AS hash FROM orders",
    "tx_result_decode": """SELECT o_orderkey, CASE WHEN o_orderkey % 11 <> 0 THEN o_orderkey END AS height, CASE WHEN o_orderkey % 11 <> 0 THEN o_custkey END AS idx,
        CASE WHEN o_orderkey % 11 <> 0 AND o_orderkey % 3 <> 0 THEN '0x' || sha256(CAST(o_orderkey AS VARCHAR) || '/' || CAST(o_custkey AS VARCHAR)) END AS eth_hash FROM orders""",
    "state_change_files": """SELECT CAST(o_custkey AS VARCHAR) AS path, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS INTEGER) AS position, 'bank' AS store, o_orderstatus = 'F' AS deleted,
        CAST(o_orderkey AS VARCHAR) AS key, o_orderpriority AS value FROM orders""",
    "prefix_bounds": "WITH h AS (SELECT p_partkey, lower(hex(p_name)) AS h FROM part) SELECT p_partkey, CASE WHEN p_partkey % 4 < 3 THEN substr(h, 1, length(h) - 2) || lpad(lower(to_hex(CAST('0x' || right(h, 2) AS BIGINT) + 1)), 2, '0') END AS bound FROM h",
    "key_display": f"""WITH {_SHOWN} SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN substr(p_name, 1, 10) || CASE WHEN length(p_name) > 10 THEN '...' ELSE '' END WHEN 1 THEN '0x' || substr(h, 1, 1) || '...' || right(h, 1)
        WHEN 2 THEN '<empty>' ELSE CASE WHEN {{odd}} THEN chr(0) ELSE '0x' || substr(h, 1, 6) END END AS shown FROM s""",
    "value_display": f"""WITH {_SHOWN} SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN substr(p_name, 1, 8) || CASE WHEN length(p_name) > 8 THEN '... (' || CAST(length(p_name) - 8 AS VARCHAR) || ' more bytes)' ELSE '' END
        WHEN 1 THEN '0x' || substr(h, 1, 8) || '... (32 total bytes)' WHEN 2 THEN '<empty>' ELSE CASE WHEN {{odd}} THEN chr(0) ELSE '0x' || substr(h, 1, 6) END END AS shown FROM s""",
    "strategy_names": "SELECT * FROM (VALUES ('ask', 'ask'), ('skip', 'skip all'), ('replace', 'replace'), ('replace_all', 'replace all'), ('other', 'unknown')) AS t(name, shown)",
    "height_specs": """SELECT * FROM (VALUES ('', 'empty', 0::BIGINT, 0::BIGINT, '', 'all heights'), ('123456', 'list', 0, 0, '123456', 'height 123456'), ('10000-20000', 'range', 10000, 20000, '', 'heights 10000 to 20000'),
        ('10000 - 20000', 'range', 10000, 20000, '', 'heights 10000 to 20000'), ('123456, 234567', 'list', 0, 0, '123456,234567', 'heights 123456, 234567'), ('1,2,3,4,5,6', 'list', 0, 0, '1,2,3,4,5,6', '6 specific heights'),
        ('0', 'list', 0, 0, '0', 'height 0'), ('0-0', 'empty', 0, 0, '', 'all heights'), ('5-', 'error', NULL, NULL, NULL, NULL), ('-123', 'error', NULL, NULL, NULL, NULL), ('20000-10000', 'error', NULL, NULL, NULL, NULL),
        ('abc', 'error', NULL, NULL, NULL, NULL), ('10-20-30', 'error', NULL, NULL, NULL, NULL), (',,,', 'error', NULL, NULL, NULL, NULL), ('123456,,234567', 'list', 0, 0, '123456,234567', 'heights 123456, 234567'),
        ('123456,abc', 'error', NULL, NULL, NULL, NULL)) AS t(spec, kind, low, high, heights, shown)""",
    "database_names": """SELECT * FROM (VALUES ('', 'app', 'application', ''), ('', 'cometbft', 'blockstore,state,tx_index,evidence', 'blockstore,tx_index'), ('', 'all', 'application,blockstore,state,tx_index,evidence', 'blockstore,tx_index'),
        (' state , tx_index', 'app', 'state,tx_index', 'tx_index'), ('nope', 'all', NULL, NULL), ('', 'nope', NULL, NULL), (',', 'all', NULL, NULL)) AS t(names, "group", databases, with_heights)""",
    "denom_names": f"SELECT c_custkey, lower(c_mktsegment) AS symbol, 'channel-' || CAST(c_nationkey AS VARCHAR) AS channel, 'evm/0x' || upper({_ADDRESS.format('c_name')}) AS evm_denom, '0x' || {_ADDRESS.format('c_name')} AS contract, greatest(c_custkey - 1, 1) AS context FROM customer",
}
# Three bytes count as text only if all are printable.
_PRINTABLE = " AND ".join(f"regexp_matches(substr(h, {2 * i + 1}, 2), '^([2-6][0-9a-f]|7[0-9a-e]|09|0a|0d)$')" for i in range(3))
_TEXT = "decode(unhex(substr(h, 1, 6)))"
for _name in ("key_display", "value_display"):
    ORACLES[_name] = ORACLES[_name].replace("CASE WHEN {odd} THEN chr(0) ELSE", f"CASE WHEN {_PRINTABLE} THEN {_TEXT} ELSE")
