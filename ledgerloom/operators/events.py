"""Events: attribute maps, conversion to logs by descriptor, routing by topic, filters and subscriptions' predicates.

An event is ``struct<type, attributes: array<struct<key, value>>>``; a log has ``address, topics, data``.
Maps are last-wins.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.denoms import snake, snake_case
from ..functions.encoding import abi_pack, bech32_decode, decoded_base64, keccak256, keccak_many, parse_address, topic_word

MOST_INDEXED = 3

# ------------------------------------------------------------------ attribute maps


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body reads it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def last_wins(entries: Column) -> Column:
    """Map of (key, value) entries in which the last entry of a key stands, whatever the session's policy is."""

    def made(e: Column) -> Column:
        keys, values = F.transform(e, lambda x: x["key"]), F.transform(e, lambda x: x["value"])
        value_of = lambda x: lambda k: F.element_at(x["v"], F.array_position(x["k"], k).cast("int"))  # noqa: E731  the first, as they are reversed
        return _let(F.struct(keys.alias("k"), values.alias("v"), F.array_distinct(keys).alias("d")), lambda x: F.map_from_arrays(x["d"], F.transform(x["d"], value_of(x))))

    return _let(F.reverse(F.filter(entries, lambda e: e["key"].isNotNull())), made)


def attribute_map(event: Column, renames: dict[str, str] | None = None) -> Column:
    """Attributes by snake-cased key, the last one of a key stands; ``renames`` copies new <- old."""
    entries = F.transform(event["attributes"], lambda a: F.struct(snake_case(a["key"]).alias("key"), a["value"].alias("value")))
    found = last_wins(entries)
    for new, old in (renames or {}).items():
        found = _let(found, lambda m: F.map_concat(F.map_filter(m, lambda k, _: k != new), F.create_map(F.lit(new), F.try_element_at(m, F.lit(old)))))  # noqa: B023
    return found


def first_event(events: Column, kind: str, matches: Callable[[Column], Column] | None = None) -> Column:
    """Attribute map of the first event of a type (that fulfils ``matches`` on its map); null if there is none."""
    of_kind = F.filter(events, lambda e: e["type"] == kind)
    maps = F.transform(of_kind, lambda e: last_wins(F.transform(e["attributes"], lambda a: F.struct(a["key"].alias("key"), a["value"].alias("value")))))
    return F.get(F.filter(maps, matches) if matches else maps, F.lit(0))


def events_by_type(events: Column) -> Column:
    """Type -> (key -> value) over all events, later ones win; keys and values are base64 or as they are."""

    def made(s: pd.Series) -> pd.Series:
        out = []
        for rows in s:
            found: dict[str, dict[str, str | None]] = {}
            for e in rows if rows is not None else []:
                for a in e["attributes"]:
                    if a["key"] is not None:
                        found.setdefault(e["type"], {})[decoded_base64(a["key"])] = decoded_base64(a["value"])
            out.append(found)
        return pd.Series(out)

    return F.pandas_udf(made, "map<string,map<string,string>>")(events)


# ------------------------------------------------------------------ decoders and descriptors


def as_is(value: str, indexed: bool) -> list:
    return [value]


def unsigned(value: str, indexed: bool) -> list:
    if not re.fullmatch("[0-9]+", value) or int(value) >= 1 << 64:
        raise ValueError(f"not an unsigned number: {value!r}")
    return [int(value)]


def account(value: str, indexed: bool) -> list:
    """20-byte address of any bech32 string; other text stays as it is."""
    found = bech32_decode(value) if value.strip() else None
    return [found[1][-20:].rjust(20, b"\0")] if found and found[1] else [value]


def amount(value: str, indexed: bool) -> list:
    """Coins as (amount, denom) pairs sorted by denomination, or a whole number."""
    coins = []
    for part in value.split(",") if value.strip() else []:
        m = re.fullmatch(r"\s*([0-9]+)\s*([a-zA-Z][a-zA-Z0-9/:._-]{2,127})\s*", part)
        if not m:
            break
        coins.append((int(m[1]), m[2]))
    else:
        return [sorted((c for c in coins if c[0]), key=lambda c: c[1])]
    if not re.fullmatch("[+-]?[0-9]+", value):
        raise ValueError(f"not an amount: {value!r}")
    return [int(value)]


def tokens(value: str, indexed: bool) -> list:
    """Tokens as (amount, (base, [(port, channel)])) from JSON."""
    out = []
    for t in json.loads(value):
        denom = t.get("denom") or {}
        out.append((int(t["amount"]), (denom.get("base", ""), [(h.get("port_id", ""), h.get("channel_id", "")) for h in denom.get("trace") or []])))
    return [out]


def packet_data(account_prefix: str, validator_prefix: str) -> Callable:
    """Hex of a packet's JSON: indexed as sender and receiver, else as one (receiver, sender, coins)."""

    def decode(value: str, indexed: bool) -> list:
        data = json.loads(bytes.fromhex(value))
        receiver = parse_address(data.get("receiver", ""), account_prefix, validator_prefix)
        if receiver is None:
            raise ValueError("receiver is no address")
        if indexed:
            return [data.get("sender", ""), "0x" + receiver.hex()]
        return [(receiver, data.get("sender", ""), [(int(data["amount"]), data.get("denom", ""))])]

    return decode


@dataclass
class Descriptor:
    """An event of an ABI: its signature's hash and its arguments in order."""

    name: str
    inputs: list[tuple[str, str, bool]]  # (name, kind, indexed)
    indexed: list[tuple[str, str]] = field(init=False)
    plain: list[tuple[str, str]] = field(init=False)
    id: bytes = field(init=False)

    def __post_init__(self) -> None:
        self.indexed = [(snake(n), k) for n, k, i in self.inputs if i]
        self.plain = [(snake(n), k) for n, k, i in self.inputs if not i]
        if len(self.indexed) > MOST_INDEXED:
            raise ValueError(f"{self.name} has more than {MOST_INDEXED} indexed arguments")
        self.id = keccak256(f"{self.name}({','.join(k for _, k, _ in self.inputs)})".encode())

    @property
    def type(self) -> str:
        return snake(self.name)


def descriptors(abi: list[dict]) -> dict[str, Descriptor]:
    """Descriptors by event type from an ABI's JSON."""
    made = [Descriptor(e["name"], [(i["name"], i["type"], i.get("indexed", False)) for i in e.get("inputs", [])]) for e in abi if e.get("type") == "event"]
    return {d.type: d for d in made}


class Converter:
    """Native events to logs. Unknown types are dropped; a missing attribute or decoder is an error.

    ``decoders`` maps attribute names to functions (value, indexed) -> values; the one under '' is the default.
    """

    def __init__(self, described: dict[str, Descriptor], decoders: dict[str, Callable], renames: dict[str, str] | None = None) -> None:
        self.described, self.decoders, self.renames = described, decoders, renames or {}

    def _values(self, attrs: dict, arguments: list[tuple[str, str]], indexed: bool) -> list:
        out = []
        for name, _ in arguments:
            if name not in attrs or attrs[name] is None:
                raise ValueError(f"attribute {name} not found")
            decode = self.decoders.get(name) or self.decoders.get("")
            if decode is None:
                raise ValueError(f"no decoder for {name}")
            out += decode(attrs[name], indexed)
        return out

    def parts(self, kind: str, attributes) -> tuple[list, list] | None:
        """(topics, values of the data), or None for an unknown type. A topic that is a hash is given as the bytes to hash, in a tuple."""
        d = self.described.get(kind)
        if d is None:
            return None
        attrs = {snake(k): v for k, v in attributes}
        for new, old in self.renames.items():
            attrs[new] = attrs.get(old)
        topics: list = [d.id]
        for value in self._values(attrs, d.indexed, True):
            if isinstance(value, (list, tuple)):
                raise ValueError("a list is no topic")
            topics.append((value.encode(),) if isinstance(value, str) else topic_word(value, "word"))
        return topics, self._values(attrs, d.plain, False)

    def convert(self, kind: str, attributes) -> tuple[list[bytes], list] | None:
        """(topics, values of the data), or None for an unknown type."""
        found = self.parts(kind, attributes)
        return found and ([keccak256(t[0]) if isinstance(t, tuple) else t for t in found[0]], found[1])

    def rows(self, events: DataFrame, *, strict: bool = False) -> DataFrame:
        """Logs of rows (id, type, attributes): (id, topics, data, values, error).

        ``data`` is packed where all plain arguments are static words, strings or bytes; ``values`` is the JSON of all.
        With ``strict`` the first error fails the job, else it is in ``error``. A batch's topics are hashed at once.
        """

        def shown(v):
            return "0x" + v.hex() if isinstance(v, bytes) else [shown(x) for x in v] if isinstance(v, (list, tuple)) else v

        def convert(batches):
            for pdf in batches:
                out = []
                for i, kind, attributes in zip(pdf["id"], pdf["type"], pdf["attributes"]):
                    try:
                        found = self.parts(kind, [(a["key"], a["value"]) for a in attributes])
                    except ValueError as e:
                        if strict:
                            raise
                        out.append((i, None, None, None, str(e)))
                        continue
                    if found:
                        kinds = [k for _, k in self.described[kind].plain]
                        simple = len(kinds) == len(found[1]) and all(isinstance(v, (int, bytes, str, bool)) and not (isinstance(v, str) and k not in ("string",)) for k, v in zip(kinds, found[1]))
                        out.append((i, found[0], abi_pack(kinds, found[1]) if simple else None, json.dumps(shown(found[1])), None))
                raw = sorted({t[0] for row in out for t in row[1] or [] if isinstance(t, tuple)})
                hashes = dict(zip(raw, keccak_many(raw)))
                done = [(i, topics and [hashes[t[0]] if isinstance(t, tuple) else t for t in topics], *rest) for i, topics, *rest in out]
                yield pd.DataFrame(done, columns=["id", "topics", "data", "values", "error"])

        return events.select(F.col("id").cast("long").alias("id"), "type", "attributes").mapInPandas(convert, "id long, topics array<binary>, data binary, values string, error string")


# ------------------------------------------------------------------ logs


@dataclass(frozen=True)
class Handler:
    """A log handler: its event's topic, how many topics it takes (None: any) and what it is called."""

    topic: bytes
    name: str
    n_topics: int | None = None


def handler_table(spark, handlers: list[Handler]) -> DataFrame:
    """One row per topic; of handlers with one topic the last stands."""
    last = {h.topic: h for h in handlers}
    return spark.createDataFrame([(bytearray(h.topic), h.name, h.n_topics) for h in last.values()], "topic0 binary, handler string, n_topics int")


def route(logs: DataFrame, handlers: DataFrame) -> DataFrame:
    """Logs with a handler for their first topic, in one pass: what a handler emits is not routed again.

    Logs whose number of topics differs from what the handler takes are ignored. Handlers are code, a few
    rows, so they are broadcast.
    """
    keyed = logs.withColumn("topic0", F.get(F.col("topics"), F.lit(0)))
    met = keyed.join(F.broadcast(handlers), "topic0")
    return met.where(F.col("n_topics").isNull() | (F.size("topics") == F.col("n_topics")))


def split_outcomes(handled: DataFrame, decoded: Column, mapped: Column) -> DataFrame:
    """'ok', 'decode_failed' (logged and ignored) or 'error' (a mapping is missing: the transaction fails)."""
    return handled.withColumn("outcome", F.when(~decoded, "decode_failed").when(~mapped, "error").otherwise("ok"))


def new_logs(address: Column, topics: Column, data: Column, position: Column) -> Column:
    """A log derived from an event, numbered on from what the transaction has."""
    return F.struct(address.alias("address"), topics.alias("topics"), data.alias("data"), position.alias("index"))


@dataclass(frozen=True)
class LogFilter:
    """Block range, addresses and topics by position, each a value, a list of alternatives or None for any."""

    from_block: int | None = None
    to_block: int | None = None
    addresses: tuple = ()
    topics: tuple = ()
    range_cap: int = 10_000

    def predicate(self, latest: int | None = None, block: str = "block", address: str = "address", topics: str = "topics") -> Column:
        """Bounds default to the latest block; a range above the cap is an error."""
        low = self.from_block if self.from_block is not None else latest
        high = self.to_block if self.to_block is not None else latest
        if low is not None and high is not None and high - low > self.range_cap:
            raise ValueError(f"block range is above {self.range_cap}")
        out = F.lit(True)
        if low is not None:
            out = out & (F.col(block) >= low)
        if high is not None:
            out = out & (F.col(block) <= high)
        if self.addresses:
            out = out & F.col(address).isin(*self.addresses)
        for i, wanted in enumerate(self.topics):
            if wanted is not None:
                alternatives = wanted if isinstance(wanted, (list, tuple)) else [wanted]
                out = out & F.coalesce(F.get(F.col(topics), F.lit(i)).isin(*alternatives), F.lit(False))
        return out

    def apply(self, logs: DataFrame, cap: int = 10_000, **names) -> DataFrame:
        """At most ``cap`` logs in block order, as the feature says."""
        return logs.where(self.predicate(**names)).orderBy("block", "index").limit(cap)


_CLAUSE = re.compile(r"""\s*([A-Za-z_][\w.]*)\s*(=|<=|>=|<|>|CONTAINS|EXISTS)\s*(?:'([^']*)'|(-?[0-9]+))?\s*""")


def event_query(text: str, attributes: str = "attributes") -> Column:
    """Predicate of ``tm.event='Tx' AND transfer.amount>=5 AND a.b CONTAINS 'x'`` on a map column of attributes."""
    out = F.lit(True)
    for part in re.split(r"\bAND\b", text):
        m = _CLAUSE.fullmatch(part)
        if not m or (m[2] != "EXISTS" and m[3] is None and m[4] is None):
            raise ValueError(f"not a clause: {part.strip()!r}")
        value = F.try_element_at(F.col(attributes), F.lit(m[1]))
        if m[2] == "EXISTS":
            clause = value.isNotNull()
        elif m[2] == "CONTAINS":
            clause = value.contains(m[3] if m[3] is not None else m[4])
        else:
            left, right = (value, F.lit(m[3])) if m[3] is not None else (value.try_cast("bigint"), F.lit(int(m[4])))
            clause = {"=": left == right, "<": left < right, ">": left > right, "<=": left <= right, ">=": left >= right}[m[2]]
        out = out & F.coalesce(clause, F.lit(False))
    return out


# ------------------------------------------------------------------ tokens and traces


def reshape_tokens(tokens: Column) -> Column:
    """Token structs to (amount, (base, trace of (port, channel)))."""
    return F.transform(
        tokens,
        lambda t: F.struct(
            t["amount"].cast("decimal(38,0)").alias("amount"),
            F.struct(t["denom"]["base"].alias("base"), F.transform(t["denom"]["trace"], lambda h: F.struct(h["port_id"].alias("port"), h["channel_id"].alias("channel"))).alias("trace")).alias("denom"),
        ),
    )


def received_trace(trace: Column, source_port: Column, source_channel: Column, port: Column, channel: Column) -> Column:
    """Trace of a received coin: its first hop undone if it came from here, else the receiving hop put before."""
    head = F.get(trace, F.lit(0))
    came_back = F.coalesce((head["port"] == source_port) & (head["channel"] == source_channel), F.lit(False))
    return F.when(came_back, F.slice(trace, 2, F.greatest(F.size(trace) - 1, F.lit(0)))).otherwise(F.concat(F.array(F.struct(port.alias("port"), channel.alias("channel"))), trace))


def voucher(trace: Column, base: Column) -> Column:
    """``ibc/<SHA-256 of the path>``, or the base denomination without a trace."""
    path = F.concat(F.array_join(F.transform(trace, lambda h: F.concat_ws("/", h["port"], h["channel"])), "/"), F.lit("/"), base)
    return F.when(F.size(trace) == 0, base).otherwise(F.concat(F.lit("ibc/"), F.upper(F.sha2(path, 256))))
