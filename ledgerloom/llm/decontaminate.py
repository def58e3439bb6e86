"""Benchmark decontamination by latent semantic retrieval.

Passages are windows of ``WINDOW`` words, half overlapping, over every whole text. Their TF-IDF vectors live in
the benchmark's vocabulary (a word no item has adds nothing to a similarity; idf counts all passages). A
randomised SVD of the passages and items (one distributed pass: each task adds up its part of ``(A'A) omega``,
the parts are summed in two levels, Nyström's formula gives the basis) spans the latent space. Passages whose
latent cosine to an item is at least ``COSINE`` are candidates. A candidate is confirmed by the longest common
subsequence of the item and the words around the passage, and, for paraphrases, of the item's last part (its answer).
Before that, item words around the passage are counted: no subsequence is longer than their number, so a candidate
with too few of them (``may_hold``) is one that the confirmation would refuse.

The benchmark is taken in blocks of ``BLOCK`` items; a block's vocabulary, idf and basis are what is broadcast. Texts
are split once per ``GROUP`` blocks into vocabulary numbers, which the three passes of each block read; nothing is
shuffled but the sums, which come from at most ``TASKS`` tasks and are added ``FAN`` at a time. Frequent words of the
benchmark make up most of a text's words in it; their share of a sum is a product of small dense matrices.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, free_name, local_rows, release

WINDOW = 32
STEP = WINDOW // 2
BLOCK = 2000
RANK, OVERSAMPLE = 128, 16
COSINE = 0.35
WHOLE, PARAPHRASE, ANSWER = 0.8, 0.6, 0.75
STRIPE = 64  # vocabulary rows that are summed together
GROUP = 10  # blocks that share a numbering of the texts
TASKS = 4096  # most tasks that add up sums
FAN = 64  # sums that are added in one task
FREQUENT = 256  # words whose counts are dense in the sums of passages
FEW = 64  # the same in the counts of items' words, of which frequent words have many

MAX_BROADCAST = 1_000_000  # contaminated rows whose ids are broadcast; more are joined by shuffle

HIT = "item_id long, cosine double, lcs double, answer double, first_word int, last_word int"
#: ASCII punctuation and white space part words; letters beyond ASCII stay as they are.
_PARTS = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased words, as UTF-8."""
    return (text or "").lower().encode("utf-8", "surrogatepass").translate(_PARTS).split()


def numbers_of(text: str | None, vocabulary: dict[bytes, int]) -> np.ndarray:
    """Vocabulary number of each word, -1 outside it."""
    words = words_of(text)
    return np.fromiter(map(vocabulary.get, words, repeat(-1)), np.int32, len(words))


def lcs(masks: dict[int, int], n: int, words) -> int:
    """Length of the longest common subsequence, bit-parallel; ``masks`` has each word's places in the item."""
    full = (1 << n) - 1
    v = full
    for w in words:
        if w in masks:
            u = v & masks[w]
            v = ((v + u) | (v - u)) & full
    return n - v.bit_count()


def _masks(words: list[int]) -> dict[int, int]:
    found: dict[int, int] = {}
    for i, w in enumerate(words):
        found[w] = found.get(w, 0) | (1 << i)
    return found


@dataclass
class Block:
    """A block of the benchmark with what its search needs."""

    item_ids: list[int]
    items: list[list[int]]
    vocabulary: dict[bytes, int]
    weight: np.ndarray | None = None  # smoothed idf, never 0
    basis: np.ndarray | None = None  # words x rank, rows scaled by weight
    latent: np.ndarray | None = None  # items x rank, unit rows
    masks: list = field(default_factory=list)
    within: np.ndarray | None = None  # words x items, 1 for an item's words; the last row is for words outside
    renumber: np.ndarray | None = None  # this block's number of each word of the group, -1 outside; the last is for words outside
    frequent: np.ndarray | None = None  # numbers of the words in most passages
    dense: np.ndarray | None = None  # place of each word among them, -1 outside
    first_item: np.ndarray | None = None  # where each word's items begin in ``items_of``
    items_of: np.ndarray | None = None

    def set_frequent(self, df: np.ndarray) -> None:
        self.frequent = np.argsort(-df, kind="stable")[:FREQUENT]
        self.dense = np.full(len(df), -1, np.int64)
        self.dense[self.frequent] = np.arange(len(self.frequent))

    def set_items(self) -> None:
        """Which items have which words, as a table and by word; and what alignment needs of each item."""
        size = len(self.vocabulary)
        self.within = np.zeros((size + 1, len(self.items)), np.uint8)
        for k, words in enumerate(self.items):
            self.within[words, k] = 1
        word, self.items_of = np.nonzero(self.within[:size])
        self.first_item = np.searchsorted(word, np.arange(size + 1))
        for words in self.items:
            tail = words[-max(4, len(words) // 4) :]
            self.masks.append((_masks(words), _masks(tail), len(tail)))

    def confirm(self, words: np.ndarray, k: int, a: int, b: int):
        """(lcs, answer, first, last) of item ``k`` in the words around ``a:b``, or None."""
        n = len(self.items[k])
        lo, hi = max(0, a - n), min(len(words), b + n)
        whole, answer, n_answer = self.masks[k]
        region = words[lo:hi].tolist()
        if lcs(whole, n, region) < PARAPHRASE * n:
            return None
        span, best = n + n // 2, None
        for at in range(0, max(1, len(region) - span + max(1, n // 4)), max(1, n // 4)):
            part = region[at : at + span]
            ratio = lcs(whole, n, part) / n
            if best is None or ratio > best[0]:
                best = (ratio, lcs(answer, n_answer, part) / n_answer, lo + at, min(lo + at + span, hi))
        if best[0] >= WHOLE or (best[0] >= PARAPHRASE and best[1] >= ANSWER):
            return best
        return None


@dataclass
class Windows:
    """Vocabulary words of several texts, by passage block of ``STEP`` words."""

    words: list[np.ndarray]  # per text, -1 outside the vocabulary
    v: np.ndarray  # vocabulary numbers of the words in it
    at: np.ndarray  # their blocks
    starts: np.ndarray  # first block of each text, and the number of blocks


def windows_of(words: list[np.ndarray]) -> Windows:
    sizes = np.array([2 * max(1, -(-len(w) // WINDOW)) for w in words], np.int64)  # even: no passage spans two texts
    starts = np.concatenate([[0], np.cumsum(sizes)])
    x = np.concatenate(words) if words else np.zeros(0, np.int32)
    lengths = np.array([len(w) for w in words], np.int64)
    place = np.arange(len(x)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    at = np.repeat(starts[:-1], lengths) + place // STEP
    keep = x >= 0
    return Windows(words, x[keep], at[keep], starts)


def _pairs_of_blocks(w: Windows) -> tuple[np.ndarray, np.ndarray]:
    """(first block, text) of every passage: each two neighbouring blocks of a text."""
    counts = np.diff(w.starts) - 1
    owner = np.repeat(np.arange(len(counts)), counts)
    first = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts) + w.starts[owner]
    return first, owner


def _by_block(w: Windows, table: np.ndarray) -> np.ndarray:
    """Sums over blocks of the words' rows in ``table``; one more zero block at the end.

    Word by word of all blocks at a time: a block has at most ``STEP`` words of a passage's two.
    """
    return _add_rows(np.zeros((int(w.starts[-1]) + 1, table.shape[1]), table.dtype), w.at, w.v, table)


def _add_rows(out: np.ndarray, at: np.ndarray, v: np.ndarray, table: np.ndarray) -> np.ndarray:
    if len(at):
        edges = np.flatnonzero(np.diff(at, prepend=-1))
        sizes = np.diff(np.append(edges, len(at)))
        for c in range(int(sizes.max())):
            more = edges[sizes > c] + c
            out[at[more]] += table[v[more]]
    return out


def _often(block: Block, at: np.ndarray, v: np.ndarray, n: int, k: int = FREQUENT) -> tuple[np.ndarray, np.ndarray]:
    """Counts of the ``k`` most frequent words in each of ``n`` places, and which words are not among them."""
    k = min(k, len(block.frequent))
    place = block.dense[v]
    often = (place >= 0) & (place < k)
    return np.bincount(at[often] * k + place[often], minlength=n * k).reshape(n, k).astype(np.float32), ~often


def _item_counts(block: Block, w: Windows) -> np.ndarray:
    """Words of each item in each block: items x blocks."""
    n, k = int(w.starts[-1]), len(block.items)
    counts, rest = _often(block, w.at, w.v, n, FEW)
    out = block.within[block.frequent[: counts.shape[1]]].T.astype(np.float32) @ counts.T
    at, v = w.at[rest], w.v[rest]
    sizes = block.first_item[v + 1] - block.first_item[v]
    place = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    items = block.items_of[np.repeat(block.first_item[v], sizes) + place]
    out += np.bincount(items * n + np.repeat(at, sizes), minlength=n * k).reshape(k, n)
    return out


def _unpack(column, renumber: np.ndarray) -> list[np.ndarray]:
    """Words of each text in a block's own numbers."""
    return [renumber[np.frombuffer(b, np.int32)] for b in column]


def _few_tasks(df: DataFrame) -> tuple[DataFrame, int]:
    n = df.rdd.getNumPartitions()
    return (df.coalesce(TASKS), TASKS) if n > TASKS else (df, n)


def _parts(words: list[np.ndarray], most: int = 100_000):
    """Consecutive texts with about ``most`` words."""
    start, held = 0, 0
    for i, w in enumerate(words):
        held += len(w)
        if held >= most:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(words):
        yield start, len(words)


def _idf(numbered: DataFrame, block: Block) -> tuple[int, np.ndarray]:
    """Passages, and passages per vocabulary word, over all texts (non-overlapping passages)."""
    size = len(block.vocabulary)
    shared = numbered.sparkSession.sparkContext.broadcast(block.renumber)

    def count(batches):
        df, total = np.zeros(size, np.int64), 0
        for pdf in batches:
            words = _unpack(pdf["words"], shared.value)
            for a, b in _parts(words):
                w = windows_of(words[a:b])
                key = np.sort((w.at // 2) * size + w.v)
                df += np.bincount(key[np.diff(key, prepend=-1) != 0] % size, minlength=size)
                total += int(w.starts[-1]) // 2
        some = np.flatnonzero(df)
        yield pd.DataFrame({"v": np.append(some, -1).astype(np.int64), "df": np.append(df[some], total)})
        release()

    few, _ = _few_tasks(numbered.select("words"))
    rows = few.mapInPandas(count, "v long, df long").groupBy("v").agg(F.sum("df").alias("df")).collect()  # a row per word of the block
    found = {r["v"]: r["df"] for r in rows}
    return found.get(-1, 0), np.array([found.get(i, 0) for i in range(size)], np.float64)


def _moment(numbered: DataFrame, block: Block, omega: np.ndarray) -> np.ndarray:
    """``(A'A) omega`` over all passages: tasks' sums by stripe of the vocabulary, added ``FAN`` at a time."""
    size, width = omega.shape
    shared = numbered.sparkSession.sparkContext.broadcast((block, (omega * block.weight[:, None]).astype(np.float32)))

    def add_up(batches):
        from pyspark import TaskContext

        block, rows = shared.value
        out = np.zeros((size, width))
        for pdf in batches:
            words = _unpack(pdf["words"], block.renumber)
            for a, b in _parts(words):
                w = windows_of(words[a:b])
                if not len(w.v):
                    continue
                passage = w.at // 2
                n = int(passage[-1]) + 1
                counts, rest = _often(block, passage, w.v, n)
                v, p = w.v[rest], passage[rest]
                y = _add_rows(counts @ rows[block.frequent], p, v, rows)
                out[block.frequent] += counts.T @ y
                order = np.argsort(v, kind="stable")
                v = v[order]
                edges = np.flatnonzero(np.diff(v, prepend=-1))
                if len(edges):
                    out[v[edges]] += np.add.reduceat(y[p[order]], edges, axis=0)
        out *= block.weight[:, None]
        stripes = range(0, size, STRIPE)
        yield pd.DataFrame({"stripe": [s // STRIPE for s in stripes], "salt": TaskContext.get().partitionId(), "part": [out[s : s + STRIPE].tobytes() for s in stripes]})
        release()

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(p) for p in pdf["part"])
        return pd.DataFrame({"stripe": [pdf["stripe"].iloc[0]], "salt": [pdf["salt"].iloc[0] // FAN], "part": [total.tobytes()]})

    schema = "stripe int, salt int, part binary"
    few, n = _few_tasks(numbered.select("words"))
    parts = few.mapInPandas(add_up, schema)
    while True:  # levels of adding, until a stripe has one sum
        parts = parts.groupBy("stripe", F.floor(F.col("salt") / FAN)).applyInPandas(add, schema)
        n = -(-n // FAN)
        if n <= 1:
            break
    out = np.zeros((size, width))
    for r in parts.collect():  # one row per stripe: vocabulary x width numbers in all
        part = np.frombuffer(r["part"]).reshape(-1, width)
        out[r["stripe"] * STRIPE : r["stripe"] * STRIPE + len(part)] = part
    return out


def vocabulary_of(item_ids: list[int], texts: list[str], group: dict[bytes, int] | None = None) -> Block | None:
    """The items as numbers of their own vocabulary; items without words are left out.

    ``group`` numbers the words of several blocks, as the texts are numbered by; without it, the block's are those.
    """
    numbers: dict[bytes, int] = {}
    ids, items = [], []
    for i, t in zip(item_ids, texts):
        words = words_of(t)
        if words:
            ids.append(i)
            items.append([numbers.setdefault(w, len(numbers)) for w in words])
    if not items:
        return None
    renumber = np.full(len(group or numbers) + 1, -1, np.int32)
    for word, n in numbers.items():
        renumber[group[word] if group else n] = n
    block = Block(ids, items, numbers, renumber=renumber)
    block.set_frequent(np.bincount([w for words in items for w in set(words)], minlength=len(numbers)))
    return block


def fit(block: Block, numbered: DataFrame, *, rank: int = RANK, seed: int = 7) -> Block:
    """idf over all passages of ``numbered`` (words), randomised SVD, and the items' latent vectors."""
    items, size = block.items, len(block.vocabulary)
    total, df = _idf(numbered, block)
    block.set_frequent(df)
    block.weight = np.log((1 + total) / (1 + df)) + 1  # at least 1: a leak may make all of an item's words common
    item_rows = np.zeros((len(items), size))
    for k, words in enumerate(items):
        np.add.at(item_rows[k], words, block.weight[words])
    width = min(size, rank + OVERSAMPLE)
    omega, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((size, width)))
    y = _moment(numbered, block, omega)
    own = item_rows.T @ (item_rows @ omega)
    y = y + own * (max(np.abs(y).sum(), 1e-9) / max(np.abs(own).sum(), 1e-9))  # items weigh as much as the corpus
    shift = 1e-7 * np.linalg.norm(y)
    y = y + shift * omega
    inner = omega.T @ y
    values, vectors = np.linalg.eigh((inner + inner.T) / 2)
    good = values > values.max() * 1e-10
    root = vectors[:, good] / np.sqrt(values[good])
    basis, _, _ = np.linalg.svd(y @ root, full_matrices=False)
    basis = basis[:, :rank]
    latent = item_rows @ basis
    norm = np.linalg.norm(latent, axis=1, keepdims=True)
    block.latent = (latent / np.where(norm > 0, norm, 1)).astype(np.float32)
    block.basis = (basis * block.weight[:, None]).astype(np.float32)
    block.set_items()
    return block


def _needs(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By item: its words, how many of them a part must have, and the words of a part."""
    n = np.array([len(i) for i in block.items])
    return n, np.ceil(PARAPHRASE * n - 1e-6), n + n // 2


def near_blocks(block: Block, w: Windows) -> np.ndarray:
    """Items x blocks: whether a passage that begins in the block may have enough of the item's words around it.

    A part of ``span`` words touches ``cover`` blocks, and its region goes ``side`` blocks beyond the passage. Parts are not
    cut off at the ends of a text here, which only lets more through.
    """
    n, need, span = _needs(block)
    cover, side = (np.maximum(span, 2) - 2) // STEP + 2, -(-n // STEP)
    counts = _item_counts(block, w)
    blocks = counts.shape[1]
    sums = np.zeros((len(n), blocks + 1), np.float32)  # whole numbers far below 2**24
    np.cumsum(counts, axis=1, out=sums[:, 1:])
    near = np.zeros((len(n), blocks), bool)
    for c, d in sorted(set(zip(cover.tolist(), side.tolist()))):
        items = np.flatnonzero((cover == c) & (side == d))
        grown = np.repeat(sums[items, -1:], blocks, axis=1)
        if blocks > c:
            grown[:, : blocks - c + 1] = sums[items, c:]
        grown -= sums[items, :-1]
        item, start = np.nonzero(grown >= need[items, None])
        if len(start):
            marks = np.zeros((len(items), blocks + 1), np.int16)
            np.add.at(marks, (item, np.maximum(start - 1 - d, 0)), 1)
            np.add.at(marks, (item, np.minimum(start + d + 1, blocks)), -1)
            near[items] = np.cumsum(marks[:, :-1], axis=1, dtype=np.int16) > 0  # at most 2 * side + 2 are open at once
    return near


def may_hold(block: Block, w: Windows, first: np.ndarray, owner: np.ndarray, items: np.ndarray, near: np.ndarray | None = None) -> np.ndarray:
    """Whether some part that ``confirm`` aligns, at passages ``first`` of texts ``owner``, has ``PARAPHRASE`` of ``items`` in item words.

    Counted over whole blocks at first (``near_blocks``), then word by word over what neighbouring passages of an item
    cover together, from every word on. Words count as often as they occur.
    """
    fits = (near_blocks(block, w) if near is None else near)[items, first]
    some = np.flatnonzero(fits)
    if not len(some):
        return fits
    some = some[np.lexsort((first[some], owner[some], items[some]))]
    item, text = items[some], owner[some]
    n, need, span = (x[item] for x in _needs(block))
    lengths = np.array([len(x) for x in w.words])
    texts, begins = np.concatenate(w.words), np.cumsum(lengths) - lengths
    a = (first[some] - w.starts[text]) * STEP
    low, high = begins[text] + np.maximum(0, a - n), begins[text] + np.minimum(lengths[text], a + WINDOW + n)
    new = np.ones(len(some), bool)
    new[1:] = (item[1:] != item[:-1]) | (low[1:] >= high[:-1])
    group = np.cumsum(new) - 1
    start, end = low[new], high[np.append(np.flatnonzero(new)[1:], len(some)) - 1]
    sizes = end - start
    base = np.cumsum(sizes) - sizes
    here = np.arange(int(sizes.sum()))
    of = np.repeat(np.arange(len(sizes)), sizes)
    held = block.within[texts[here - (base - start)[of]], item[new][of]]
    sums = np.concatenate([[0], np.cumsum(held, dtype=np.int32)])
    good = sums[np.minimum(here + span[new][of], (base + sizes)[of])] - sums[:-1] >= need[new][of]
    found = np.concatenate([[0], np.cumsum(good, dtype=np.int32)])
    at = base[group] - start[group]
    fits[some] = found[at + high] > found[at + low]
    return fits


def search(block: Block, words: list[np.ndarray]) -> list[list[dict]]:
    """Confirmed items of each whole text, given as vocabulary numbers."""
    out: list[list[dict]] = [[] for _ in words]
    part = max(2_000, 8_000_000 // len(block.items))  # words whose items x blocks tables stay near the cache
    for lo, hi in _parts(words, part):
        w = windows_of(words[lo:hi])
        if not len(w.v):
            continue
        first, owner = _pairs_of_blocks(w)
        near = near_blocks(block, w)
        some = np.flatnonzero(near.any(0)[first])
        if not len(some):
            continue
        first, owner = first[some], owner[some]
        asked = np.zeros(int(w.starts[-1]) + 1, bool)
        asked[first] = asked[first + 1] = True
        here = asked[w.at]
        sums = _by_block(Windows(w.words, w.v[here], w.at[here], w.starts), block.basis)
        p = sums[first] + sums[first + 1]
        p /= np.maximum(np.linalg.norm(p, axis=1, keepdims=True), 1e-12)
        cols, rows = np.nonzero(near[:, first] & (block.latent @ p.T >= COSINE))
        if not len(rows):
            continue
        fits = may_hold(block, w, first[rows], owner[rows], cols, near)
        rows, cols = rows[fits], cols[fits]
        starts = (first[rows] - w.starts[owner[rows]]) * STEP
        refused: dict[tuple[int, int], tuple[int, int]] = {}  # stretches of a text that cannot hold an item
        for i, (r, k, start) in enumerate(zip(rows.tolist(), cols.tolist(), starts.tolist())):
            text, n = int(owner[r]), len(block.items[k])
            seen = refused.get((text, k), (0, 0))
            if seen[0] <= start < seen[1]:
                continue
            last, at = start, i + 1  # passages that follow within reach are tried together first
            while at < len(rows) and cols[at] == k and owner[rows[at]] == text and starts[at] - n < last + WINDOW + n:
                last, at = int(starts[at]), at + 1
            if last > start and seen[1] <= start:
                around = w.words[text][max(0, start - n) : last + WINDOW + n].tolist()
                if lcs(block.masks[k][0], n, around) < PARAPHRASE * n:
                    refused[text, k] = (start, last + 1)
                    continue
                refused[text, k] = (last + 1, last + 1)  # not refused as a whole: each passage on its own up to there
            hit = block.confirm(w.words[text], k, start, start + WINDOW)
            if hit:
                cosine = float(p[r] @ block.latent[k])
                out[lo + text].append({"item_id": block.item_ids[k], "cosine": cosine, "lcs": hit[0], "answer": hit[1], "first_word": hit[2], "last_word": hit[3]})
    for hits in out:
        best: dict[int, dict] = {}
        for h in hits:
            if h["item_id"] not in best or (h["lcs"], h["cosine"]) > (best[h["item_id"]]["lcs"], best[h["item_id"]]["cosine"]):
                best[h["item_id"]] = h
        hits[:] = [best[i] for i in sorted(best)]
    return out


def find_leaks(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
               block_items: int = BLOCK, scratch: Scratch | None = None) -> DataFrame:
    """One row per contaminated row of ``docs`` and item: (``id_col``, version, item_id, cosine, lcs, answer, first_word, last_word).

    ``version`` is a hash of the text: it tells rows that share an id apart. Null and empty texts and items match
    nothing. Every row is judged on its own whole text, repeated rows and ids too. Items with one id are
    searched each and the best hit is reported. Items are fetched to the driver block by block, ``block_items``
    at a time. Other columns are not read.
    """
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark, "leaks")
    items = benchmark.select(F.col(item_col).cast("long").alias("i"), F.col(item_text_col).alias("t")).where("i is not null and t is not null")
    n_blocks = max(1, math.ceil(items.count() / block_items))
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("version"), F.col(text_col).alias("text")).where("text is not null")
    found = local_rows(spark, [], f"{id_col} long, version long, {HIT}")
    for first in range(0, n_blocks, GROUP):
        of = {b: items.where(F.pmod(F.xxhash64("i", "t"), F.lit(n_blocks)) == b).orderBy("i", "t").collect() for b in range(first, min(first + GROUP, n_blocks))}
        group: dict[bytes, int] = {}
        for rows in of.values():
            for r in rows:
                for word in words_of(r["t"]):
                    group.setdefault(word, len(group))
        if not group:
            continue
        vocabulary = spark.sparkContext.broadcast(group)
        number = F.pandas_udf(lambda s, v=vocabulary: pd.Series([numbers_of(t, v.value).tobytes() for t in s]), "binary")
        numbered = scratch.keep(texts.select("doc_id", "version", number("text").alias("words")), f"words-{first}")
        for b, rows in of.items():
            block = vocabulary_of([r["i"] for r in rows], [r["t"] for r in rows], group)
            if block is None:
                continue
            shared = spark.sparkContext.broadcast(fit(block, numbered))

            def judge(batches, shared=shared):
                for pdf in batches:
                    hits = search(shared.value, _unpack(pdf["words"], shared.value.renumber))
                    out = [(i, v, *h.values()) for i, v, found in zip(pdf["doc_id"], pdf["version"], hits) for h in found]
                    yield pd.DataFrame(out, columns=["doc_id", "version", "item_id", "cosine", "lcs", "answer", "first_word", "last_word"]).astype({"doc_id": "Int64"})
                release()

            hits = scratch.keep(numbered.mapInPandas(judge, f"doc_id long, version long, {HIT}"), f"hits-{b}")
            found = found.union(hits)
        scratch.drop(f"words-{first}")
    return found


def without_leaks(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", scratch: Scratch | None = None, **options) -> DataFrame:
    """Rows of ``docs`` that hold no item, all columns; see ``find_leaks``."""
    scratch = scratch or Scratch(docs.sparkSession, "leaks")
    found = find_leaks(docs.select(id_col, text_col), benchmark, id_col=id_col, text_col=text_col, scratch=scratch, **options)
    leaked, edition = free_name(docs.columns, "_id"), free_name(docs.columns, "_version")
    bad = scratch.keep(found.select(F.col(id_col).alias(leaked), F.col("version").alias(edition)).distinct(), "contaminated")
    bad = F.broadcast(bad) if bad.count() <= MAX_BROADCAST else bad
    return docs.join(bad, docs[id_col].eqNullSafe(bad[leaked]) & (F.xxhash64(docs[text_col]) == bad[edition]), "left_anti")
