"""License scans: canonical digest lookup of entire texts.

A text is brought to a canonical form: case, copyright lines, list markers, equivalent spellings, punctuation of any
script and white space. The SHA-256 of the form is joined with the digests of known licences, which cover
the usual title lines too. The whole text must be the licence: one that only quotes it has another digest.

The form is made in Python: Unicode classes and a table of spellings are plain there, and the JVM has no large expression to compile.
"""

from __future__ import annotations

import hashlib
import re

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import local_rows, release, small_batches
from .license_digests import DIGESTS
from .license_texts import KNOWN, TITLES

# Spellings that count as one, old -> new, on lower-cased words.
SPELLINGS = {
    "acknowledgement": "acknowledgment", "acknowledgements": "acknowledgments", "analogue": "analog", "analyse": "analyze", "artefact": "artifact", "authorisation": "authorization",
    "authorised": "authorized", "calibre": "caliber", "cancelled": "canceled", "catalogue": "catalog", "categorise": "categorize", "centre": "center",
    "emphasised": "emphasized", "favour": "favor", "favourite": "favorite", "fulfil": "fulfill", "fulfilment": "fulfillment", "initialise": "initialize",
    "judgement": "judgment", "labelling": "labeling", "labour": "labor", "licence": "license", "licenced": "licensed", "licences": "licenses", "maximise": "maximize",
    "merchantibility": "merchantability", "modelled": "modeled", "modelling": "modeling", "modifications": "modification", "offence": "offense", "optimise": "optimize",
    "organisation": "organization", "organise": "organize", "practise": "practice", "programme": "program", "realise": "realize", "recognise": "recognize", "signalling": "signaling",
    "utilisation": "utilization", "whilst": "while", "wilful": "willful", "https": "http",
}
# The same for phrases, applied in this order.
PHRASES = [
    ("sub license", "sublicense"), ("sub licensed", "sublicensed"), ("non infringement", "noninfringement"), ("non commercial", "noncommercial"), ("per cent", "percent"),
    ("copyright owners", "copyright holder"), ("copyright owner", "copyright holder"), ("copyright holders", "copyright holder"),
]
#: A line that opens with the word, the sign or (c), and a year, a name's place or "by", names no terms.
COPYRIGHT = r"(?m)^[ \t]*(?:(?:portions )?copyright\b[ \t]*(?:\(c\)|©|[0-9]|[<\[{]|by\b)|\(c\)[ \t]|©|all rights reserved)[^\n]*$"
#: Numbers, letters and bullets of lists.
MARKER = r"(?m)^[ \t]*(?:[0-9]{1,2}[.)]|\([0-9a-z]{1,2}\)|[a-z][.)]|[*•·-])[ \t]+"

_copyright = re.compile(COPYRIGHT)
_marker = re.compile(MARKER)
_between = re.compile(r"[\W_]+")


def canonical_text(text: str | None) -> str:
    """The canonical form: lower case by single letters, words of letters and digits of any script, one space between."""
    out = (text or "").replace("\r\n", "\n").replace("İ", "i").replace("Σ", "σ").lower()
    out = _marker.sub(" ", _copyright.sub(" ", out))
    words = _between.sub(" ", out).strip(" ").split(" ")
    out = f" {' '.join(map(SPELLINGS.get, words, words))} "
    for old, new in PHRASES:
        out = out.replace(f" {old} ", f" {new} ")
    return out.strip(" ")


def digest_of(text: str | None) -> str:
    return hashlib.sha256(canonical_text(text).encode("utf-8", "surrogatepass")).hexdigest()


def digests_of(name: str, text: str, titles: dict[str, list[str]] = TITLES) -> dict[str, str]:
    """Digest -> name, of the text alone and below each of its title lines."""
    return {digest_of(t): name for t in [text, *(f"{title}\n\n{text}" for title in titles.get(name, []))]}


def known_digests(spark: SparkSession, known: dict[str, str] = KNOWN, digests: dict[str, list[str]] = DIGESTS) -> DataFrame:
    """(digest, license) of texts, and of licences that are known by digest alone."""
    found = {d: name for name, listed in digests.items() for d in listed}
    for name, text in known.items():
        found |= digests_of(name, text)
    return local_rows(spark, sorted(found.items()), "digest string, license string")


def _forms(text: pd.Series) -> pd.DataFrame:
    digests, sizes = [], []
    for t in text:
        form = canonical_text(t)
        digests.append(hashlib.sha256(form.encode("utf-8", "surrogatepass")).hexdigest())
        sizes.append(len(form))
    return pd.DataFrame({"digest": digests, "n_canonical": pd.Series(sizes, dtype="int32")})


def scan_licenses(docs: DataFrame, known: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", max_broadcast: int = 500_000) -> DataFrame:
    """(``id_col``, digest, license, n_canonical) for every row; ``license`` is null where no known licence has the digest.

    Null and empty texts, and texts of punctuation alone, have the digest of the empty form and no licence. ``known``
    (digest, license) is broadcast while it has at most ``max_broadcast`` rows, else joined by shuffle (Spark splits a
    hot digest's side); of several names of one digest the first by name counts. Repeated rows and null ids give one
    row each; an empty table gives none; other columns are not read.
    """
    small_batches(docs.sparkSession)

    def scan(batches):
        for pdf in batches:
            yield pd.concat([pdf[["id"]], _forms(pdf["text"])], axis=1)
        release()

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInPandas(scan, f"id {kind}, digest string, n_canonical int")
    right = known.where("digest is not null").groupBy("digest").agg(F.min("license").alias("license"))
    if right.count() <= max_broadcast:
        right = F.broadcast(right)
    empty = digest_of("")
    return rows.join(right, "digest", "left").select(F.col("id").alias(id_col), "digest", F.when(F.col("digest") != empty, F.col("license")).alias("license"), "n_canonical")
