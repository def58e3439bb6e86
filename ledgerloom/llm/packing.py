"""Packing into fixed windows by Karmarkar-Karp multiway differencing.

A document's ids (and its end id) are cut into full windows and one rest. A full window is a sequence of
its own. Rests are dealt into groups of bounded size; in each, k-way differencing merges the two partial
partitions with the widest imbalance, fullest part against emptiest, until one partition into k
near-equal windows remains. k starts at the total over the capacity, rounded up, and rises by one as long
as a window exceeds the capacity.

Words are looked up in a table (the tokenizer drops white space and never merges across it), so each distinct word
is encoded about once per task. A worker holds the table of one task at a time.
"""

from __future__ import annotations

import heapq
import re
import struct
import sys
import unicodedata
import zlib
from array import array

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Memo, Scratch, held, release

NATIVE = sys.byteorder == "little" and array("I").itemsize == 4  # an array of ids is bytes as they are wanted
PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, slot long"
PLACED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def _byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte: itself if printable, else the next free one from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + rest.index(b)) for b in range(256)]


class CoreIds(Memo):
    """Word -> its ids as little-endian uint32 bytes.

    Latin letters in composed form pass the normaliser unchanged but for their case and are one piece, so they
    go to the merge table directly; anything else takes the whole tokenizer.
    """

    LIMIT = 150_000
    LETTERS = _byte_letters()

    def __init__(self, tokenizer_json: str) -> None:
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.merges = self.tokenizer.model
        probe = "wörld"
        self.direct = self._merge(probe) == self.tokenizer.encode(probe, add_special_tokens=False).ids == self.tokenizer.encode("WÖRLD", add_special_tokens=False).ids

    def _merge(self, word: str) -> list[int]:
        return [t.id for t in self.merges.tokenize(word if word.isascii() else "".join(map(self.LETTERS.__getitem__, word.encode())))]

    def make(self, key: str) -> bytes:
        if self.direct and key.isalpha() and (key.isascii() or (max(key) < "\u0130" and unicodedata.is_normalized("NFC", key))):
            ids = self._merge(key.lower())
        else:
            ids = self.tokenizer.encode(key, add_special_tokens=False).ids
        return self.pack(ids)

    @staticmethod
    def pack(ids: list[int]) -> bytes:
        return array("I", ids).tobytes() if NATIVE else struct.pack(f"<{len(ids)}I", *ids)


class WordIds(Memo):
    """As ``CoreIds``, for words as they stand in a text.

    The tokenizer lower-cases and cuts between letters and ASCII punctuation other than the apostrophe:
    so letters followed by such punctuation are looked up apart, and ASCII letters in lower case. Not so where a
    letter's lower case is more than letters (a dotted capital I becomes an i and a mark, which joins the punctuation).
    """

    LIMIT = 400_000
    EDGE = re.compile(r"([^\W\d_]+)([!-&(-/:-;=-@\[-`{-~]+)")  # not < either: special tokens open with it

    def __init__(self, tokenizer_json: str) -> None:
        super().__init__()
        self.core = CoreIds(tokenizer_json)

    def make(self, key: str) -> bytes:
        if key.isalpha():
            return self.core.make(key)  # kept here under its own form
        m = self.EDGE.fullmatch(key)
        if not m or not (m[1].isascii() or m[1].lower().isalpha()):
            return self.core.make(key)
        word = m[1]
        return self.core[word.lower() if word.isascii() else word] + self.core[m[2]]


def encode(text: str, ids: WordIds, end_id: int) -> bytes:
    """Ids of the whole text and the end id, as little-endian uint32 bytes."""
    words = text.replace("\n", " ").split(" ")
    return b"".join(map(ids.__getitem__, words)) + int(end_id).to_bytes(4, "little")


def pieces_of(docs: DataFrame, tokenizer_json: str, capacity: int, end_id: int, id_col: str, text_col: str) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer_json)

    def cut(batches):
        from pyspark import TaskContext

        ids = held(f"words of {zlib.crc32(shared.value.encode())}", lambda: WordIds(shared.value))
        task = TaskContext.get().partitionId()
        n, step = 0, 4 * capacity
        for pdf in batches:
            out = []
            for doc_id, text in zip(pdf["doc_id"], pdf["text"]):
                data = encode(text, ids, end_id) if text else int(end_id).to_bytes(4, "little")
                doc = None if doc_id is None or pd.isna(doc_id) else int(doc_id)
                for a in range(0, len(data), step):
                    part = data[a : a + step]
                    out.append((doc, a // 4, len(part) // 4, zlib.crc32(part), len(data) // 4, (task << 32) + n))
                    n += 1
            yield pd.DataFrame(out, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "slot"]).astype({"doc_id": "Int64"})
        release()  # workers take turns: what one holds between tasks, all would hold

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInPandas(cut, PIECE)


def difference(sizes: list[int], k: int) -> list[list[int]]:
    """Karmarkar-Karp: item numbers of ``k`` parts with near-equal sums."""
    heap = []
    for i, size in enumerate(sizes):
        sums = np.zeros(k, np.int64)
        sums[0] = size
        heap.append((-size, i, sums, [i] + [None] * (k - 1)))
    heapq.heapify(heap)
    tick = len(sizes)
    while len(heap) > 1:
        _, _, a, parts_a = heapq.heappop(heap)
        _, _, b, parts_b = heap[0]
        sums = a + b[::-1]  # both fall: the fullest part of one meets the emptiest of the other
        parts = [y if x is None else x if y is None else (x, y) for x, y in zip(parts_a, reversed(parts_b))]
        order = np.argsort(-sums, kind="stable")
        sums = sums[order]
        heapq.heapreplace(heap, (-int(sums[0] - sums[-1]), tick, sums, [parts[j] for j in order]))
        tick += 1
    found = []
    for node in heap[0][3] if heap else []:
        stack, items = [node], []
        while stack:
            x = stack.pop()
            if isinstance(x, tuple):
                stack += x
            elif x is not None:
                items.append(x)
        found.append(sorted(items))
    return found


def pack_sizes(sizes: list[int], capacity: int) -> list[list[int]]:
    """Item numbers of windows of at most ``capacity``; as few windows as differencing fills."""
    k = max(1, -(-sum(sizes) // capacity))
    while True:
        parts = difference(sizes, k)
        if all(sum(sizes[i] for i in p) <= capacity for p in parts):
            return [p for p in parts if p]
        k += 1


def pack_documents(docs: DataFrame, tokenizer_path: str, *, capacity: int = 4096, end_id: int = 2, windows_per_group: int = 96,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of every document in sequences of at most ``capacity`` ids (see ``PLACED``).

    Each id of a document lies in exactly one piece; offsets in a sequence are gapless from 0. A null or
    empty text is the end id alone. Every input row is packed as a document of its own, repeated ids
    and null ids too (their pieces carry the same or a null ``doc_id``). An empty table gives no rows.
    Groups hold about ``windows_per_group`` windows of rests, so a task's memory does not grow with the
    input; the group comes from the piece's number within its input task, never from a column. Other
    columns are not read.
    """
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as f:  # on the driver; the text is broadcast
        tokenizer_json = f.read()
    scratch = Scratch(spark, "packing")
    pieces = scratch.keep(pieces_of(docs, tokenizer_json, capacity, end_id, id_col, text_col), "pieces")
    total = pieces.agg(F.sum("length")).first()[0] or 0
    groups = max(1, -(-total // (capacity * windows_per_group)))

    def place(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("slot", kind="stable").reset_index(drop=True)
        base = int(pdf["bin"].iloc[0]) << 32
        sizes = pdf["length"].to_numpy()
        full = np.flatnonzero(sizes == capacity)
        rest = np.flatnonzero(sizes < capacity)
        parts = [[int(i)] for i in full]
        if len(rest):
            parts += [[int(rest[i]) for i in p] for p in pack_sizes([int(s) for s in sizes[rest]], capacity)]
        sequence, offset = np.zeros(len(pdf), np.int64), np.zeros(len(pdf), np.int64)
        for number, items in enumerate(parts):
            at = 0
            for i in items:
                sequence[i], offset[i] = base + number, at
                at += sizes[i]
        out = pdf[["doc_id", "start", "length", "ids_crc32", "doc_tokens"]].copy()
        out["sequence_id"], out["offset"] = sequence, offset
        return out

    binned = pieces.withColumn("bin", F.pmod(F.xxhash64("slot"), F.lit(groups)))
    return binned.groupBy("bin").applyInPandas(place, PLACED)
