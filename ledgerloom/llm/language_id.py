"""Language ID with a string kernel: blended-spectrum n-gram presence, Nyström landmarks, kernel ridge.

A text is the set of its character n-grams of 1 to ``ORDER`` letters (lower-cased; what is no letter is one
space), hashed to ``BUCKETS`` presence bits. The kernel of two texts is the cosine of their bits. A
balanced, bounded sample of labelled texts is the training set and its first texts per language are the
landmarks; one-versus-rest ridge regression is solved in the landmarks' span. Scoring is a product of
the batch's sparse presence matrix with ``presence(landmarks) @ weights``, one column per language.

The sample (``per_language`` texts per language and ``most`` in all, twice that before texts without a letter go;
``landmarks`` in all) bounds what reaches the driver: each sampled text, however long, comes as ``BUCKETS / 8`` bytes.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import held, small_batches

ORDER = 4
BUCKETS = 1 << 16
UNKNOWN = "und"


def has_letter(text: str | None) -> bool:
    """Digits, fractions and other numerals are no letters."""
    return bool(text) and any(map(str.isalpha, text))

def _codes(text: str) -> np.ndarray:
    """Code points of the lower-cased letters, other runs as one space, a space at both ends."""
    letters = held("letters", lambda: np.array([i if chr(i).isalpha() else 32 for i in range(0x110000)], np.uint32))
    x = letters[np.frombuffer((" " + text.lower() + " ").encode("utf-32-le", "surrogatepass"), "<u4")]
    other = x == 32
    keep = np.ones(len(x), bool)
    keep[1:] = ~(other[1:] & other[:-1])
    return x[keep]


def present(text: str, bits: np.ndarray) -> np.ndarray:
    """Sorted buckets of the text's n-grams. ``bits`` is a clean bool array of ``BUCKETS``, left clean."""
    x = _codes(text)
    h = np.zeros(len(x), np.uint32)
    for n in range(ORDER):
        if len(x) <= n:
            break
        h = h[: len(x) - n] * np.uint32(0x01000193) + x[n:] * np.uint32(2654435769) + np.uint32(n + 1)
        g = h ^ (h >> np.uint32(15))
        bits[(g * np.uint32(0x85EBCA6B)) >> np.uint32(16)] = True
    found = np.flatnonzero(bits)
    bits[found] = False
    return found


def _packed(text: pd.Series) -> pd.Series:
    bits, out = np.zeros(BUCKETS, bool), []
    for t in text:
        found = present(t, bits)
        bits[found] = True
        out.append(np.packbits(bits).tobytes())
        bits[found] = False
    return pd.Series(out)


def held_out(doc_id: Column) -> Column:
    """True for ids whose CRC-32 as text leaves 2 modulo 4; those are never learned from."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(4)) == 2, F.lit(False))


class Model:
    """Languages and the ``BUCKETS x languages`` weights that presence bits are multiplied with."""

    def __init__(self, languages: list[str], weights: np.ndarray) -> None:
        self.languages, self.weights = languages, weights

    def score(self, texts) -> tuple[list[str], list[float]]:
        bits, names, scores = np.zeros(BUCKETS, bool), [], []
        for start in range(0, len(texts), 64):
            block = [t if has_letter(t) else "" for t in texts[start : start + 64]]
            sets = [present(t, bits) for t in block]
            size = np.array([len(s) for s in sets])
            sums = np.add.reduceat(self.weights[np.concatenate(sets)], np.concatenate([[0], np.cumsum(size)[:-1]]), axis=0) if len(self.languages) else np.zeros((len(block), 1))
            values = sums / np.sqrt(size)[:, None]
            for t, v in zip(block, values):
                if not t or not self.languages:
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                k = int(np.argmax(v))
                names.append(self.languages[k])
                scores.append(float(np.clip((1 + v[k]) / 2, 0, 1)))
        return names, scores


def solve(sets: list[np.ndarray], labels: list[str], landmarks: int, ridge: float) -> Model:
    languages = sorted(set(labels))
    if not languages:
        return Model([], np.zeros((BUCKETS, 1), np.float32))
    share = max(1, landmarks // len(languages))
    taken: dict[str, int] = {}
    chosen = []
    for i, lang in enumerate(labels):
        if taken.get(lang, 0) < share:
            taken[lang] = taken.get(lang, 0) + 1
            chosen.append(i)
    marks = np.zeros((BUCKETS, len(chosen)), np.float32)
    for j, i in enumerate(chosen):
        marks[sets[i], j] = 1 / np.sqrt(len(sets[i]))
    gram = np.stack([marks[s].sum(0, dtype=np.float64) / np.sqrt(len(s)) for s in sets])  # texts x landmarks
    target = np.where(np.array(labels)[:, None] == np.array(languages)[None, :], 1.0, -1.0)
    inner = gram[chosen]
    lhs = gram.T @ gram + ridge * len(sets) * inner + 1e-8 * len(sets) * np.eye(len(chosen))
    return Model(languages, marks @ np.linalg.solve(lhs, gram.T @ target).astype(np.float32))


def train(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = 500, most: int = 20_000, landmarks: int = 256, ridge: float = 1e-4) -> Model:
    """Fit on at most ``per_language`` labelled, not held-out texts per language, and about ``most`` in all.

    The number of languages is that of the distinct values of ``lang_col``. Rows without id, label or a letter are not
    learned from. Ids are drawn first, by hash, without reading a text; then only the drawn texts are read.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where("id is not null and lang is not null")
    rows = rows.where(~held_out(F.col("id"))).withColumn("at", F.xxhash64("id", F.lit(11)))
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}  # a row per language
    if not counts:
        return solve([], [], landmarks, ridge)
    per_language = max(1, min(per_language, most // len(counts)))
    # A share of each language by hash, about four times what is used, then the lowest hashes: twice as many, as some have no letter.
    share = F.lit(0.0)
    for lang, n in counts.items():
        share = F.when(F.col("lang") == lang, F.lit(min(1.0, 4.0 * per_language / n))).otherwise(share)
    some = rows.where(F.pmod("at", F.lit(1 << 24)) < share * (1 << 24)).select("id", "lang", "at").distinct()
    ranked = some.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy("at", "id"))).where(F.col("r") <= 2 * per_language)
    texts = rows.join(F.broadcast(ranked.select("id").distinct()), "id", "left_semi").where(F.col("text").rlike(r"\p{L}"))  # as many as languages times 2 * per_language
    drawn = texts.select("lang", "at", F.pandas_udf(_packed, "binary")("text").alias("bits")).toPandas().sort_values(["at", "bits"], kind="stable")
    sets, labels, taken = [], [], dict.fromkeys(counts, 0)
    for lang, bits in zip(drawn["lang"], drawn["bits"]):
        if taken[lang] < per_language:
            found = np.flatnonzero(np.unpackbits(np.frombuffer(bits, np.uint8)))
            if len(found):
                taken[lang] += 1
                sets.append(found)
                labels.append(lang)
    return solve(sets, labels, landmarks, ridge)


def with_language(docs: DataFrame, model: Model, *, text_col: str = "text", into: str = "_language") -> DataFrame:
    """``docs`` with a struct column (lang_pred, score) predicted from the whole text alone."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("struct<lang_pred:string,score:double>")
    def predict(text: pd.Series) -> pd.DataFrame:
        names, scores = shared.value.score(list(text))
        return pd.DataFrame({"lang_pred": names, "score": scores})

    return docs.withColumn(into, predict(F.col(text_col)))


def identify(docs: DataFrame, model: Model | None = None, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **fit) -> DataFrame:
    """(``id_col``, held_out, lang_pred, score) for every row, over its whole text.

    ``lang_pred`` is a learned language, or ``und`` with score 0 for a null text, one without letters, or
    where nothing could be learned. ``score`` is the winning regression value brought from -1..1 to 0..1.
    Ties go to the first language by name. Null ids count as not held out and are not learned from.
    """
    model = model or train(docs, id_col=id_col, text_col=text_col, lang_col=lang_col, **fit)
    scored = with_language(docs.select(F.col(id_col), F.col(text_col).alias("_text")), model, text_col="_text")
    return scored.select(id_col, held_out(F.col(id_col)).alias("held_out"), F.col("_language.lang_pred").alias("lang_pred"), F.col("_language.score").alias("score"))
