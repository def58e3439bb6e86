"""Secret scans with an incremental blob ledger.

Every version of a path is a blob, addressed by the SHA-256 of its text. The ledger has two tables: the history,
one row per (path, blob) ever seen, and the findings, one row per (blob, rule, rule version) that has been scanned, with
its spans. A scan takes the distinct blobs of its input, drops the pairs that the findings have, reads only the rest,
and joins the findings back through the blob address: to the paths of the input, or to every path of the
history (``BlobLedger.history``), so that a secret of an earlier version is still found under its path after
the text has changed. Scans that run at once may add a pair twice; it counts once.

Texts are scanned where they are read; only blobs, rules and spans are shuffled. A task scans a blob once, however many
copies it reads; copies in other tasks are scanned there, and their equal findings merge. With a ledger, blobs are
compared with it first, without their texts, and rows with nothing new are dropped before the scan. A blob that a
third of all paths share is one row of findings per task, and a join that Spark splits on its way back.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from .common import Scratch, local_rows, small_batches

# The rules, in the order in which spans with one start are listed.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
RULES = {"assign": 1, "access": 1, "hex": 1}  # rule -> version
ORDER = ["assign", "access", "hex"]
MIN_VALUE, MIN_ACCESS, MIN_HEX = 12, 18, 16

LEDGER = "blob string, rule string, version int, spans array<struct<start:int,end:int>>"
#: Unseen blobs that are broadcast to the rows that have them; more are joined by shuffle.
MAX_BROADCAST = 500_000

_assign = re.compile(ASSIGN, re.ASCII | re.IGNORECASE)
_access = re.compile(ACCESS)
_hex = re.compile(r"[0-9a-f]{16,}")  # a run of 16 or more is found whole; shorter runs fail anyway


def find_spans(rule: str, text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping matches of one rule, without the ones that are too short."""
    if rule == "assign":
        if ":" not in text and "=" not in text:
            return []
        return [m.span() for m in _assign.finditer(text) if m.end(2) - m.start(2) >= MIN_VALUE]
    if rule == "access":
        return [m.span() for m in _access.finditer(text) if m.end() - m.start() >= MIN_ACCESS] if "AKIA" in text else []
    return [m.span() for m in _hex.finditer(text)]


def _scan(batches):
    """Ledger rows of (blob, text, pending); each blob once."""
    done: set[str] = set()
    for pdf in batches:
        out = []
        for blob, text, pending in zip(pdf["blob"], pdf["text"], pdf["pending"]):
            if blob not in done:
                done.add(blob)
                out += [(blob, x["rule"], x["version"], [{"start": a, "end": b} for a, b in find_spans(x["rule"], text)]) for x in pending]
        yield pd.DataFrame(out, columns=["blob", "rule", "version", "spans"])


def _rules(spark: SparkSession, rules: dict[str, int]) -> DataFrame:
    return local_rows(spark, list(rules.items()), "rule string, version int")


def versions_of(docs: DataFrame, path_col: str, text_col: str) -> DataFrame:
    """(path, blob, text); a null text is an empty blob."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(path_col).alias("path"), F.sha2(text, 256).alias("blob"), text.alias("text"))


def scan_unseen(versions: DataFrame, ledger: DataFrame | None = None, rules: dict[str, int] = RULES) -> DataFrame:
    """New ledger rows for the (blob, rule, version) pairs of ``versions`` that ``ledger`` has not."""
    spark = versions.sparkSession
    small_batches(spark)
    every = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(rules[r]).alias("version")) for r in ORDER if r in rules])
    if ledger is None:
        todo = versions.withColumn("pending", every)
    else:
        current = ledger.join(F.broadcast(_rules(spark, rules)), ["rule", "version"], "left_semi")
        seen = current.groupBy("blob").agg(F.collect_set("rule").alias("seen"))  # at most one entry per rule
        new = versions.select("blob").distinct().join(seen, "blob", "left").withColumn("pending", F.filter(every, lambda x: ~F.array_contains(F.coalesce("seen", F.array().cast("array<string>")), x["rule"])))
        new = Scratch(spark, "unseen").keep(new.where(F.size("pending") > 0).select("blob", "pending"), "blobs")
        todo = versions.join(F.broadcast(new) if new.count() <= MAX_BROADCAST else new, "blob")
    return todo.select("blob", "text", "pending").mapInPandas(_scan, LEDGER).dropDuplicates(["blob", "rule", "version"])


class BlobLedger:
    """A ledger kept as Parquet below ``path``; ``scan`` adds what is new and returns all findings."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def _read(self, name: str, schema: str) -> DataFrame | None:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return None

    def read(self) -> DataFrame | None:
        """All findings, a row per (blob, rule, version); None before the first scan."""
        found = self._read("findings", LEDGER)
        return None if found is None else found.dropDuplicates(["blob", "rule", "version"])

    def versions(self, kind: str = "bigint") -> DataFrame | None:
        """(path, blob) of every version seen; ``kind`` is the type of paths."""
        found = self._read("history", f"path {kind}, blob string")
        return None if found is None else found.distinct()

    def record(self, versions: DataFrame) -> None:
        """Add the (path, blob) pairs that the history has not."""
        seen, new = self.versions(versions.schema["path"].dataType.simpleString()), versions.select("path", "blob").distinct()
        if seen is not None:
            same = (F.col("n.path").eqNullSafe(F.col("s.path"))) & (F.col("n.blob") == F.col("s.blob"))
            new = new.alias("n").join(seen.alias("s"), same, "left_anti")
        new.write.mode("append").parquet(f"{self.path}/history")

    def scan(self, versions: DataFrame, rules: dict[str, int] = RULES, *, history: bool = True) -> DataFrame:
        """Scan the unseen pairs of ``versions`` and return all findings. Without ``history`` no paths are kept."""
        if history:
            self.record(versions)
        scan_unseen(versions, self.read(), rules).write.mode("append").parquet(f"{self.path}/findings")
        return self.read()

    def history(self, rules: dict[str, int] = RULES, kind: str = "bigint") -> DataFrame:
        """Findings of every version of every path ever seen, as ``findings_by_path`` has them."""
        return findings_by_path(self.versions(kind), self.read(), rules)


def findings_by_path(versions: DataFrame, ledger: DataFrame, rules: dict[str, int] = RULES) -> DataFrame:
    """(path, blob, n_assign, n_access, n_hex, spans) for every row of ``versions``, from the ledger."""
    spark = versions.sparkSession
    current = ledger.join(F.broadcast(_rules(spark, rules)), ["rule", "version"], "left_semi").dropDuplicates(["blob", "rule"])
    place = F.array_position(F.array(*[F.lit(r) for r in ORDER]), F.col("rule")).cast("int")
    marked = current.withColumn("marked", F.transform("spans", lambda s: F.struct(s["start"].alias("start"), place.alias("place"), s["end"].alias("end"))))
    per_blob = marked.groupBy("blob").agg(
        *[F.sum(F.when(F.col("rule") == r, F.size("spans")).otherwise(0)).cast("long").alias(f"n_{r}") for r in ORDER],
        F.array_sort(F.flatten(F.collect_list("marked"))).alias("found"),
    )
    label = F.transform("found", lambda s: F.concat_ws(":", F.element_at(F.array(*[F.lit(r) for r in ORDER]), s["place"]), s["start"].cast("string"), s["end"].cast("string")))
    per_blob = per_blob.withColumn("spans", F.array_join(label, ",")).drop("found")
    return versions.select("path", "blob").join(per_blob, "blob", "left")


def scan_secrets(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", ledger_path: str | None = None, rules: dict[str, int] = RULES) -> DataFrame:
    """Secrets in every whole text: (``id_col``, n_assign, n_access, n_hex, base_sha256, spans).

    With ``ledger_path`` the ledger there is used and extended, with its history; without one, a new ledger is kept in the
    shared scratch folder, where no later scan looks for a history. Spans are ``kind:start:end`` in code points, end exclusive, by start and then
    kind. The ledger adds no spans of its own, so ``base_sha256`` is the digest of ``spans``. Null texts
    count as empty; null ids, repeated rows and empty tables give one row per input row; other columns
    are not read.
    """
    spark = docs.sparkSession
    ledger = BlobLedger(spark, ledger_path or f"{Scratch(spark, 'ledger').root}/ledger")
    kept = ledger.scan(versions_of(docs, id_col, text_col), rules, history=ledger_path is not None)
    found = findings_by_path(versions_of(docs, id_col, text_col), kept, rules)
    count = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c)
    spans = F.coalesce("spans", F.lit(""))
    return found.select(F.col("path").alias(id_col), count("n_assign"), count("n_access"), count("n_hex"), F.sha2(spans, 256).alias("base_sha256"), spans.alias("spans"))
