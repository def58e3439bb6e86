"""MinHash near-dedup with fast similarity sketching.

Sketch: in rounds 0..t-1 each shingle is thrown into a hashed bin with its round and hash as value, in
rounds t..2t-1 all shingles are thrown into bin ``round - t``; a bin keeps its least value and a document stops
as soon as its bins are full. So every coordinate fills, long documents need a round or two, and the number of
agreeing coordinates is concentrated as that of t independent minima.

``BANDS`` bands of ``ROWS`` coordinates give the buckets: a pair at similarity 0.75 misses all of them with
probability (1 - 0.75**5)**48 = 2e-6. Each candidate is confirmed on the full shingle sets.

No bucket is expanded into all its pairs. Documents with one shingle set are one class from the start. In a
bucket that spans several components, members are compared with one pivot, the member that shares most buckets
(so the least edited copy of a group), components are merged, and this repeats while it pays. What still differs is
compared across components only: pair by pair in buckets with few such pairs, and block by block, one task per
two blocks of documents, where copies scatter around the threshold in one large group. A component's own members are never
compared again, and no comparison that could link two components is left out.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import GOLDEN, Scratch, WordHashes, blocks_of, held, mix64, release
from .graph import components

WORDS = 5
SIMILAR = 75  # percent
BANDS, ROWS = 48, 5
BINS = BANDS * ROWS
EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
STAR_ROUNDS = 3
#: A bucket with more cross-component pairs than this is compared in blocks of ``BLOCK`` documents.
LARGE = 200
BLOCK = 400
#: Candidate documents whose ids are broadcast to pick their texts; more are joined by shuffle.
MAX_BROADCAST = 1_000_000

SKETCH = "doc_id long, n long, digest binary, bands array<long>"

def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the 5-word shingles; fewer words are one shingle, no words none."""
    hashes = held("word hashes", WordHashes)
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII case and white space only
    if not words:
        return np.zeros(0, np.uint64)
    x = np.frombuffer(b"".join(map(hashes.__getitem__, words)), np.uint64)
    width = min(WORDS, len(x))
    h = np.full(len(x) - width + 1, width, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(width):
            h = (h + x[i : len(x) - width + 1 + i]) * GOLDEN
            h ^= h >> np.uint64(29)
    return np.unique(mix64(h))


def sketch(sets: list[np.ndarray], bins: int = BINS) -> np.ndarray:
    """One row of ``bins`` values per set; sets must not be empty."""
    x = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    out = np.full(len(sets) * bins, EMPTY)
    for i in range(2 * bins):
        with np.errstate(over="ignore"):
            h = mix64(x + np.uint64(i + 1) * GOLDEN)
            value = (np.uint64(i) << np.uint64(53)) | ((h * GOLDEN) >> np.uint64(11))
        at = ((h >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64) if i < bins else i - bins
        np.minimum.at(out, owner * bins + at, value)
        unfilled = (out.reshape(-1, bins) == EMPTY).any(1)
        if not unfilled.any():
            break
        still = unfilled[owner]
        if not still.all():
            x, owner = x[still], owner[still]
    return out.reshape(-1, bins)


def band_keys(rows: np.ndarray) -> np.ndarray:
    """64-bit bucket per document and band; the band's number is part of it."""
    parts = rows.reshape(len(rows), BANDS, ROWS)
    key = np.broadcast_to(mix64(np.arange(1, BANDS + 1, dtype=np.uint64) * GOLDEN), (len(rows), BANDS)).copy()
    for j in range(ROWS):
        key = mix64(key ^ parts[:, :, j])
    return key.view(np.int64)


def _sketches(batches):
    for pdf in batches:
        ids, texts = pdf["doc_id"].to_numpy(), pdf["text"].tolist()
        for a, b in blocks_of(texts, 3_000_000):
            sets = [shingles(t) for t in texts[a:b]]
            some = [i for i, s in enumerate(sets) if len(s)]
            keys = band_keys(sketch([sets[i] for i in some])) if some else np.zeros((0, BANDS), np.int64)
            bands = [None] * len(sets)
            for i, k in zip(some, keys):
                bands[i] = k
            digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
            yield pd.DataFrame({"doc_id": pd.array(ids[a:b], dtype="Int64"), "n": [len(s) for s in sets], "digest": digests, "bands": bands})
    release()


def _confirmed(batches):
    last, set_b = None, None
    for pdf in batches:
        a, b = [], []
        for x, y, text_x, text_y in zip(pdf["a"], pdf["b"], pdf["text_a"], pdf["text_b"]):
            if last != (y, text_y):
                last, set_b = (y, text_y), shingles(text_y)
            set_a = shingles(text_x)
            both = len(np.intersect1d(set_a, set_b, assume_unique=True))
            if 100 * both >= SIMILAR * (len(set_a) + len(set_b) - both) and both:
                a.append(x)
                b.append(y)
        yield pd.DataFrame({"a": np.array(a, np.int64), "b": np.array(b, np.int64)})
    release()


def confirm(pairs: DataFrame, texts: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """The (a, b) of ``pairs`` whose whole texts reach the similarity. ``texts`` has (doc_id, text)."""
    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    return scratch.keep(pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b").mapInPandas(_confirmed, "a long, b long"), name)


def _ratio_fits(n, m):
    return F.least(n, m) * 100 >= F.greatest(n, m) * SIMILAR


def _cross_pairs(rows: DataFrame, key: str) -> DataFrame:
    """Pairs across components within each ``key``; ``rows`` has (key, rep, n, comp, major).

    Every pair across components has a member outside the key's most frequent component.
    """
    minor = rows.where("comp <> major").select(key, F.col("rep").alias("a"), F.col("n").alias("n_a"), F.col("comp").alias("comp_a"))
    other = rows.select(key, F.col("rep").alias("b"), F.col("n").alias("n_b"), F.col("comp").alias("comp_b"))
    met = minor.join(other, key).where((F.col("comp_a") != F.col("comp_b")) & _ratio_fits(F.col("n_a"), F.col("n_b")))
    return met.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _with_major(rows: DataFrame, key: str) -> DataFrame:
    """Rows of keys that span components, with the key's size, its largest component and the rows outside that."""
    per = rows.groupBy(key, "comp").agg(F.count("*").alias("c"))
    per = per.groupBy(key).agg(
        F.sum("c").alias("size"), F.max("c").alias("most"), F.max_by("comp", "c").alias("major"), F.count("*").alias("comps"),
    ).where("comps > 1").withColumn("minor", F.col("size") - F.col("most"))
    return rows.join(per.select(key, "major", "size", "minor"), key)


def link_classes(texts: DataFrame, classes: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component) over class representatives. ``classes`` has (rep, n, bands)."""
    rows = classes.select("rep", "n", F.explode("bands").alias("bucket"))
    shared = rows.groupBy("bucket").agg(F.min("rep").alias("low"), F.max("rep").alias("top"), F.count("*").alias("size")).where("low < top")
    hits = scratch.keep(rows.join(shared.select("bucket", "size"), "bucket"), "hits")
    weights = hits.groupBy("rep").agg(F.sum("size").alias("weight"))
    hits = scratch.keep(hits.join(weights, "rep").select("bucket", "rep", "n", "weight"), "weighted")
    scratch.drop("hits")

    # Only candidates' texts are read again.
    who = hits.select(F.col("rep").alias("doc_id")).distinct()
    texts = scratch.keep(texts.join(F.broadcast(who) if who.count() <= MAX_BROADCAST else who, "doc_id", "left_semi"), "texts")

    links, found, at, paid = None, None, hits, True
    for round_ in range(STAR_ROUNDS + 1):
        if found is None:
            mixed = at.withColumn("comp", F.col("rep"))
        else:
            placed = at.join(found.withColumnRenamed("node", "rep").withColumnRenamed("component", "comp"), "rep", "left").withColumn("comp", F.coalesce("comp", "rep"))
            mixed = scratch.keep(_with_major(placed, "bucket"), f"mixed-{round_}")
            load = mixed.select("bucket", "size", "minor").distinct().agg(F.sum(F.col("size") * F.col("minor")), F.sum("size")).first()
            if not load[0]:
                break
            if load[0] <= 8 * load[1] or round_ == STAR_ROUNDS or not paid:
                small = _cross_pairs(mixed.where(F.col("size") * F.col("minor") <= LARGE), "bucket")
                new = confirm(small, texts, scratch, f"links-{round_}")
                large = mixed.where(F.col("size") * F.col("minor") > LARGE)
                if not large.isEmpty():
                    new = new.union(_block_links(large, texts, scratch))
                return components(links.union(new), scratch, f"found-{round_}")
        # A star in each bucket; later ones have their pivot outside the bucket's largest component.
        pivots = (mixed if found is None else mixed.where("comp <> major")).groupBy("bucket").agg(F.max(F.struct("weight", "rep", "n", "comp")).alias("p"))
        pairs = mixed.join(pivots, "bucket").where((F.col("comp") != F.col("p.comp")) & _ratio_fits(F.col("n"), F.col("p.n")))
        pairs = scratch.keep(pairs.select(F.col("rep").alias("a"), F.col("p.rep").alias("b")).distinct(), f"pairs-{round_}")
        new = confirm(pairs, texts, scratch, f"links-{round_}")
        paid = round_ == 0 or new.count() * 20 > pairs.count()
        links = new if links is None else links.union(new)
        found = components(links, scratch, f"found-{round_}")
        at = mixed.select("bucket", "rep", "n", "weight")
    return found


def _block_links(rows: DataFrame, texts: DataFrame, scratch: Scratch) -> DataFrame:
    """Links across components among documents that share a large bucket: (a, b).

    A unit is a group of documents that large buckets connect, or a single bucket where the group is so loose
    that its buckets together cost less. In a unit, every document outside the major component meets
    every document, as blocks against blocks.
    """
    first = rows.groupBy("bucket").agg(F.min("rep").alias("b"))
    linked = components(rows.join(first, "bucket").select(F.col("rep").alias("a"), "b"), scratch, "groups")
    grouped = scratch.keep(rows.join(linked.withColumnRenamed("node", "rep").withColumnRenamed("component", "unit"), "rep"), "grouped")
    by_bucket = grouped.select("unit", "bucket", "size", "minor").distinct().groupBy("unit").agg(F.sum(F.col("size") * F.col("minor")).alias("bucket_cost"))
    members = scratch.keep(grouped.select("unit", "rep", "n", "comp").distinct(), "unit-members")
    spread = members.groupBy("unit", "comp").agg(F.count("*").alias("c")).groupBy("unit").agg(F.sum("c").alias("size"), F.max("c").alias("most"), F.max_by("comp", "c").alias("major"))
    tight = spread.join(by_bucket, "unit").withColumn("tight", F.col("size") * (F.col("size") - F.col("most")) <= F.col("bucket_cost"))
    whole = members.join(tight.where("tight").select("unit", "size", "most", "major"), "unit")
    whole = whole.select(F.concat(F.lit("g"), F.col("unit")).alias("unit"), "rep", "n", "comp", "major", "size", (F.col("size") - F.col("most")).alias("minor"))
    loose = grouped.join(tight.where("not tight").select("unit"), "unit", "left_semi").select(F.concat(F.lit("b"), F.col("bucket")).alias("unit"), "rep", "n", "comp", "major", "size", "minor")
    units = scratch.keep(whole.union(loose), "units")
    number = lambda count: F.ceil(F.col(count) / BLOCK).cast("int")
    mine = lambda count: F.pmod(F.xxhash64("rep"), number(count)).cast("int")
    every = lambda count: F.explode(F.sequence(F.lit(0), number(count) - 1))
    text = texts.withColumnRenamed("doc_id", "rep")
    left = units.where("comp <> major").withColumn("x", mine("minor")).withColumn("y", every("size")).join(text, "rep")
    right = units.withColumn("y", mine("size")).withColumn("x", every("minor")).join(text, "rep")
    by, names = ["unit", "x", "y"], ["unit", "x", "y", "rep", "comp", "text"]
    left, right = (side.select(*[F.col(c).alias(c) for c in names]) for side in (left, right))

    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        a, b = [], []
        if len(left) and len(right):
            sets = [shingles(t) for t in right["text"]]
            sizes = np.array([len(s) for s in sets])
            ends = np.cumsum(sizes)
            tokens = np.concatenate(sets)
            reps, comps = right["rep"].to_numpy(), right["comp"].to_numpy()
            for rep, comp, t in zip(left["rep"], left["comp"], left["text"]):
                own = shingles(t)
                at = np.minimum(np.searchsorted(own, tokens), len(own) - 1)
                counted = np.concatenate([[0], np.cumsum(own[at] == tokens)])
                both = counted[ends] - counted[ends - sizes]
                near = (100 * both >= SIMILAR * (len(own) + sizes - both)) & (comps != comp)
                some, at_first = np.unique(comps[near], return_index=True)  # one link per component tells all
                b += reps[near][at_first].tolist()
                a += [rep] * len(some)
        return pd.DataFrame({"a": np.array(a, np.int64), "b": np.array(b, np.int64)})

    return scratch.keep(left.groupBy(*by).cogroup(right.groupBy(*by)).applyInPandas(meet, "a long, b long"), "block-links")


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", scratch: Scratch | None = None) -> DataFrame:
    """(``id_col``, n_shingles, component_id, kept) for every row.

    Words are split at ASCII white space, A-Z lower-cased; shingles have five words, a shorter text is one
    shingle, a null text or one without words has none and is linked with nothing. Two documents are linked if
    the Jaccard similarity of their sets is at least 0.75; ``component_id`` is the smallest id reachable.
    Rows that share an id are one node: repeated rows stay together, and differing texts of one id link
    what either is similar to. A null id takes no part: its component is null and it is kept. Ties cannot
    occur: ids order everything. An empty table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark, "near")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sketched = scratch.keep(texts.mapInPandas(_sketches, SKETCH), "sketched")
    member = sketched.select("doc_id", "n", "digest")
    classes = sketched.where("n > 0 and doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("bands").alias("bands"))
    classes = scratch.keep(classes, "classes")
    found = link_classes(texts.where("doc_id is not null"), classes.select("rep", "n", "bands"), scratch)
    # An id may stand for several classes (repeated ids), so classes are linked through their ids too.
    repeated = member.where("n > 0 and doc_id is not null").groupBy("doc_id").agg(F.min("digest").alias("d"), F.max("digest").alias("e")).where("d <> e")
    by_class = classes.select("digest", "rep")
    if not repeated.isEmpty():
        ids = member.join(repeated.select("doc_id"), "doc_id", "left_semi").join(by_class, "digest").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
        found = components(found.select(F.col("node").alias("a"), F.col("component").alias("b")).union(ids), scratch, "ids")
    label = by_class.join(found, by_class["rep"] == found["node"], "left").select("digest", F.coalesce("component", "rep").alias("component"))
    out = member.join(label, "digest", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce(F.when(F.col("n") > 0, F.col("component")), F.col("doc_id")))
    out = out.withColumn("component_id", component)
    return out.select(F.col("doc_id").alias(id_col), F.col("n").alias("n_shingles"), "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))
