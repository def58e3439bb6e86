"""Line dedup by pairwise alignment.

A passage is a block of consecutive lines with at least ``MIN_WORDS`` words. Lines that one document alone has are
in no shared passage, so they are counted first, by hash. What is left of a document are stretches of shared lines;
each least window of ``MIN_WORDS`` words in a stretch (the shortest from each line on, and up to each line) is filed
under its rarest line and its digest. Documents that meet there are candidates, and the earliest of them is the partner
of the others: a window that millions share makes one pair per document instead of all pairs, and no window is too
frequent to count. Where they meet is not handed on.

A document is aligned with each partner by patience diff of their windows, and the lines of aligned windows are deleted
from it. What is left is aligned again, forwards and backwards in turn, until nothing aligns: so passages that moved are
found as well, and a passage that the document repeats goes everywhere. Patience aligns at least one pair as long as a
window is common, so a line goes if, and only if, it lies in a passage that an earlier document has too.

What is shuffled is hashes, counts and positions, in proportion to the lines. Texts move once, for the final cut, and
not while the cuts are few enough to be broadcast. A window's digest is made of 128 bits of each of its lines.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, bisect_right

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, release

MIN_WORDS = 50
#: Numbers (ids, runs, partners) that the cuts of all documents may hold to be broadcast: some 32 MB.
MAX_BROADCAST = 2_000_000
LINES = "doc_id long, version long, lines array<long>, checks array<long>, counts array<int>"
WINDOWS = "doc_id long, version long, rare long, window binary"
ALIGNED = "doc_id long, version long, partner long, places array<struct<at:int,words:int>>"
CUT = "doc_id long, version long, cut array<struct<first:int,last:int>>, partners array<long>, cut_lines int, cut_words int"


def lines_of(text: str | None) -> list[str]:
    """Stripped lines that are not blank, in order; positions count these."""
    return [s for s in (x.strip() for x in (text or "").split("\n")) if s]


def version_of(text_col: str):
    """Tells the texts of one id apart; ids are compared beside it."""
    return F.xxhash64(F.col(text_col))


def _hashes(line: str) -> bytes:
    """16 bytes: what a line is looked up by, and what confirms it."""
    return hashlib.blake2b(line.encode("utf-8", "surrogatepass"), digest_size=16).digest()


def _line_rows(batches):
    """A row for each document: two hashes and the number of words of each of its lines."""
    for pdf in batches:
        found, counts = [], []
        for text in pdf["text"]:
            lines = lines_of(text)
            found.append(np.frombuffer(b"".join(map(_hashes, lines)), np.int64).reshape(-1, 2))
            counts.append(np.array([len(x.split()) for x in lines], np.int32))
        yield pd.DataFrame({"doc_id": pdf["doc_id"], "version": pdf["version"], "lines": [f[:, 0].copy() for f in found], "checks": [f[:, 1].copy() for f in found], "counts": counts})
    release()


def windows_of(at: np.ndarray, counts: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Least windows (first index, end index) of ``least`` words over stretches of consecutive positions ``at``.

    From each line on and up to each line; every line of a longer block lies in one that the block holds.
    """
    sums = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
    breaks = np.flatnonzero(np.diff(at, prepend=-2) != 1)
    ends = np.append(breaks[1:], len(at))
    stretch_end = np.repeat(ends, ends - breaks)
    stretch_start = np.repeat(breaks, ends - breaks)
    on = np.searchsorted(sums, sums[:-1] + least, "left")  # end of the shortest window from each line on
    back = np.searchsorted(sums, sums[1:] - least, "right") - 1  # start of the shortest window up to each line
    here = np.arange(len(at))
    forward = np.stack([here, on], 1)[on <= stretch_end]
    backward = np.stack([back, here + 1], 1)[back >= stretch_start]
    return sorted({(int(a), int(b)) for a, b in np.concatenate([forward, backward])})


def _by_place(shared) -> tuple[np.ndarray, ...]:
    """(places, lines, checks, word counts, holders) of a document's shared lines in order; repeated rows count once."""
    rows = np.array([(x["at"], x["line"], x["check"], x["words"], x["holders"]) for x in shared], np.int64)
    rows = rows[np.unique(rows[:, 0], return_index=True)[1]]
    return rows[:, 0], rows[:, 1], rows[:, 2], rows[:, 3], rows[:, 4]


def _in_order(a: list, b: list, i: int, j: int) -> list[tuple[int, int]]:
    """A common subsequence by next occurrence: what patience falls back to where no line is unique."""
    where: dict = {}
    for k, x in enumerate(b):
        where.setdefault(x, []).append(k)
    found, at = [], -1
    for k, x in enumerate(a):
        places = where.get(x)
        if places:
            p = bisect_right(places, at)
            if p < len(places):
                at = places[p]
                found.append((i + k, j + at))
    return found


def patience(a: list, b: list) -> list[tuple[int, int]]:
    """Aligned positions of two sequences, rising in both: unique common items, longest rising run, recursion."""
    found, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        i, m, j, n = todo.pop()
        while i < m and j < n and a[i] == b[j]:
            found.append((i, j))
            i, j = i + 1, j + 1
        while i < m and j < n and a[m - 1] == b[n - 1]:
            m, n = m - 1, n - 1
            found.append((m, n))
        if i >= m or j >= n:
            continue
        count: dict = {}
        for x in a[i:m]:
            count.setdefault(x, [0, 0])[0] += 1
        for x in b[j:n]:
            if x in count:
                count[x][1] += 1
        where = {x: k for k, x in enumerate(b[j:n], j) if count.get(x) == [1, 1]}
        unique = [(k, where[x]) for k, x in enumerate(a[i:m], i) if x in where]
        if not unique:
            if any(c[1] for c in count.values()):
                found += _in_order(a[i:m], b[j:n], i, j)
            continue
        tails, ends, back = [], [], []  # longest rising run of the second positions
        for k, (_, y) in enumerate(unique):
            p = bisect_left(tails, y)
            back.append(ends[p - 1] if p else -1)
            if p == len(tails):
                tails.append(y)
                ends.append(k)
            else:
                tails[p], ends[p] = y, k
        k, chain = ends[-1], []
        while k >= 0:
            chain.append(unique[k])
            k = back[k]
        x, y = i, j
        for p, q in [*reversed(chain), (m, n)]:
            todo.append((x, p, y, q))
            x, y = p, q  # the anchor opens the next stretch as its common prefix
    return sorted(found)


def _items(at: np.ndarray, digests: np.ndarray, counts: np.ndarray, least: int) -> tuple[list[tuple[int, int]], list[bytes]]:
    """The least windows of a document and what their lines are."""
    spans = windows_of(at, counts, least)
    return spans, [digests[a:b].tobytes() for a, b in spans]


def align(mine: list[bytes], theirs: list[bytes], rounds: int | None = None) -> set[bytes]:
    """Items of a document that patience diff aligns with the other's, in at most ``rounds`` alignments, else until nothing aligns.

    The first takes both as they stand. What is left goes on with each item once, against the other forwards and backwards
    in turn: of m items in any order two such alignments take the root of m at least.
    """
    found: set[bytes] = set()
    made = 0
    while rounds is None or made < rounds:
        new = {mine[i] for i, _ in patience(mine, theirs if made < 2 or made % 2 else theirs[::-1])}
        if not new:
            break
        found |= new
        mine = [x for x in dict.fromkeys(mine) if x not in new]
        theirs = [x for x in dict.fromkeys(theirs) if x not in new]
        made += 1
    return found


def _aligned(first: tuple, second: tuple, least: int, rounds: int | None = None) -> list[int]:
    """Indices of the first's lines that go on the second's account; both are (places, digests, word counts)."""
    spans, mine = _items(*first, least)
    found = align(mine, _items(*second, least)[1], rounds)
    return sorted({k for (a, b), x in zip(spans, mine) if x in found for k in range(a, b)})


def passages(anchors: list[tuple[int, int, int]], lines: dict, words: dict, least: int, *, exact: bool = True) -> set[int]:
    """Positions to delete from a document on one partner's account, where only the lines in ``anchors`` are known.

    ``anchors`` are (position here, lines, position there) of windows that both have, ``lines`` and ``words`` what is at a
    position here. Two alignments find blocks in their order and such that moved; with ``exact``, more find the rest.
    """
    here = sorted({p + k for p, n, _ in anchors for k in range(n)})
    there = {q + k: p + k for p, n, q in anchors for k in range(n)}
    number: dict = {}

    def known(places: list[int], of: list[int]) -> tuple:
        digests = np.array([number.setdefault(lines[p], len(number)) for p in of], np.int64)
        return np.array(places, np.int64), digests, np.array([words[p] for p in of], np.int64)

    return {here[i] for i in _aligned(known(here, here), known(sorted(there), [there[q] for q in sorted(there)]), least, None if exact else 2)}


def runs_to_cut(words: dict[int, int]) -> list[tuple[int, int]]:
    """Runs of the lines to delete."""
    runs: list[tuple[int, int]] = []
    for p in sorted(words):
        if runs and runs[-1][1] == p - 1:
            runs[-1] = (runs[-1][0], p)
        else:
            runs.append((p, p))
    return runs


def without(text: str, runs: list[tuple[int, int]]) -> tuple[str, list[tuple[int, int]]]:
    """The text without the lines of ``runs``, and the spans (code points, end exclusive) that went."""
    gone = {i for a, b in runs for i in range(a, b + 1)}
    kept, spans, at, number = [], [], 0, 0
    for line in text.split("\n"):
        end = at + len(line)
        if line.strip():
            if number in gone:
                if spans and spans[-1][1] == at:
                    spans[-1] = (spans[-1][0], end + 1)
                else:
                    spans.append((at, end + 1))
            else:
                kept.append(line)
            number += 1
        else:
            kept.append(line)
        at = end + 1
    return "\n".join(kept), [(a, min(b, len(text))) for a, b in spans]


def cuts(docs: DataFrame, scratch: Scratch, *, min_words: int = MIN_WORDS) -> DataFrame:
    """Rows of ``CUT`` for the documents that lose lines. ``docs`` has (doc_id, text)."""
    named = docs.where("doc_id is not null and text is not null")
    rows = scratch.keep(named.select("doc_id", version_of("text").alias("version"), "text").mapInPandas(_line_rows, LINES), "lines")
    held = rows.select(F.explode(F.array_distinct("lines")).alias("line")).groupBy("line").agg(F.count("*").alias("holders")).where("holders > 1")
    each = rows.select("doc_id", "version", F.posexplode(F.arrays_zip("lines", "checks", "counts")).alias("at", "x"))
    each = each.select("doc_id", "version", "at", F.col("x.lines").alias("line"), F.col("x.checks").alias("check"), F.col("x.counts").alias("words"))
    met = each.join(held, "line").groupBy("doc_id", "version").agg(F.collect_list(F.struct("at", "line", "check", "words", "holders")).alias("shared"), F.sum("words").alias("most"))
    shared = scratch.keep(met.where(F.col("most") >= min_words).drop("most"), "shared")  # fewer words in all make no passage
    scratch.drop("lines")

    def file(batches):
        for pdf in batches:
            out = {c: [] for c in ("doc_id", "version", "rare", "window")}
            for doc_id, version, found in zip(pdf["doc_id"], pdf["version"], pdf["shared"]):
                at, line, check, count, holders = _by_place(found)
                rank = np.lexsort((line, holders)).argsort()
                for (a, b), item in zip(*_items(at, np.stack([line, check], 1), count, min_words)):
                    out["doc_id"].append(doc_id)
                    out["version"].append(version)
                    out["rare"].append(line[a + int(np.argmin(rank[a:b]))])
                    out["window"].append(hashlib.blake2b(item, digest_size=16).digest())
            yield pd.DataFrame(out)
        release()

    windows = scratch.keep(shared.mapInPandas(file, WINDOWS), "windows")
    first = windows.groupBy("rare", "window").agg(F.min(F.struct("doc_id", "version")).alias("first"), F.max("doc_id").alias("last")).where("first.doc_id < last")
    met = windows.join(first.select("rare", "window", "first"), ["rare", "window"]).where("doc_id > first.doc_id")
    pairs = met.groupBy("doc_id", "version").agg(F.collect_set("first").alias("met"))
    # A document's own lines come first: the partner of very many then has rows that Spark splits by their size.
    pairs = pairs.join(shared, ["doc_id", "version"]).select("doc_id", "version", "shared", F.explode("met").alias("met")).select("doc_id", "version", "shared", F.col("met.doc_id").alias("partner"), F.col("met.version").alias("edition"))
    pairs = pairs.join(shared.select(F.col("doc_id").alias("partner"), F.col("version").alias("edition"), F.col("shared").alias("theirs")), ["partner", "edition"])

    def meet(batches):
        for pdf in batches:
            out = []
            for doc_id, version, partner, found, other in zip(pdf["doc_id"], pdf["version"], pdf["partner"], pdf["shared"], pdf["theirs"]):
                (at, *mine, count, _), (there, *theirs, counts, _) = _by_place(found), _by_place(other)
                gone = _aligned((at, np.stack(mine, 1), count), (there, np.stack(theirs, 1), counts), min_words)
                out.append((doc_id, version, partner, [{"at": int(at[i]), "words": int(count[i])} for i in gone]))
            yield pd.DataFrame(out, columns=["doc_id", "version", "partner", "places"])
        release()

    def unite(batches):
        for pdf in batches:
            out = []
            for doc_id, version, partners, places in zip(pdf["doc_id"], pdf["version"], pdf["partners"], pdf["places"]):
                words = {x["at"]: x["words"] for x in places}
                out.append((doc_id, version, [{"first": a, "last": b} for a, b in runs_to_cut(words)], sorted(partners), len(words), sum(words.values())))
            yield pd.DataFrame(out, columns=["doc_id", "version", "cut", "partners", "cut_lines", "cut_words"])
        release()

    lost = pairs.mapInPandas(meet, ALIGNED).where(F.size("places") > 0)
    lost = lost.groupBy("doc_id", "version").agg(F.collect_set("partner").alias("partners"), F.flatten(F.collect_list("places")).alias("places"))
    return scratch.keep(lost.mapInPandas(unite, CUT), "cut")


def _apply(text: pd.Series, cut: pd.Series) -> pd.DataFrame:
    texts, spans = [], []
    for t, c in zip(text, cut):
        if t is None or c is None:
            texts.append(None)
            spans.append(None)
        else:
            new, gone = without(t, [(x["first"], x["last"]) for x in c])
            texts.append(new)
            spans.append([{"start": a, "end": b} for a, b in gone])
    return pd.DataFrame({"text": texts, "spans": spans})


def dedup_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, into: str = "_cut", scratch: Scratch | None = None) -> DataFrame:
    """``docs`` with ``text_col`` cut and a struct ``into`` (lines, words, partners, spans); null where nothing went.

    A column of ``docs`` that is named ``into`` is replaced; no other name clashes. Later means a larger id. Lines
    compare without surrounding white space; blank lines neither align nor break a run. Rows with a null id or text
    pass unchanged and name no partner; an empty text has no lines. Rows that share an id are never compared with each
    other, each of their texts is compared with earlier ids; ties between texts of one earliest id go to the smaller
    hash. Repeated rows are cut alike. An empty table stays empty. Other columns pass through.
    """
    scratch = scratch or Scratch(docs.sparkSession, "lines")
    cut = cuts(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), scratch, min_words=min_words)
    names = [c for c in docs.columns if c != into]
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col(id_col).cast("long").alias("_id"), version_of(text_col).alias("_version"))
    size = cut.agg(F.sum(2 + F.size("cut") + F.size("partners"))).first()[0] or 0
    cut = cut.withColumnRenamed("cut", "_runs")
    if size <= MAX_BROADCAST:  # else the texts are shuffled to their cuts
        cut = F.broadcast(cut)
    met = keyed.join(cut, (keyed["_id"] == cut["doc_id"]) & (keyed["_version"] == cut["version"]), "left")
    old = F.col(f"row.`{text_col}`")
    # Called non-deterministic so that it runs once, whatever is built on its result.
    apply = F.pandas_udf(_apply, "struct<text:string,spans:array<struct<start:int,end:int>>>").asNondeterministic()
    met = met.withColumn("_new", apply(F.when(F.col("_runs").isNotNull(), old), "_runs"))
    text = F.when(F.col("_runs").isNotNull(), F.col("_new.text")).otherwise(old)
    info = F.when(F.col("_runs").isNotNull(), F.struct(F.col("cut_lines").alias("lines"), F.col("cut_words").alias("words"), "partners", F.col("_new.spans").alias("spans")))
    return met.select(*[text.alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in names], info.alias(into))
