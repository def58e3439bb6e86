"""Main-text extraction with wrappers inferred as union-free regular expressions, per host.

A page is read into a stream of structure tokens (block tags with their class, text slots, link slots). For each
host every structure that its pages have is folded (adjacent repeats become a repeated group) and aligned with the wrapper
of those before it, unless that matches it already: what both have stays, what one lacks becomes optional, repeats of
either fold into the other. The wrapper that results is a regular expression without unions. Each of its containers that is
not itself repeated is a group of the expression, so matching all of the host's pages tells what stands where: texts that
all differing pages share are the template's own, the others are slots.

The article is the container whose slots hold the host's prose. From the whole page down, a container is
followed while it has nearly all of that prose and no heading stands beside it, and never below an ``article`` or ``main``
that has it. Every page is matched against its host's wrapper and cut to that container, less the template's
texts. Element names and the names of classes and ids say what is never an article (menus, forms, adverts,
comments); a name that only has such a word among others does so for layout elements, not for headings,
paragraphs, items and cells. A page that its wrapper does not match, or whose host has one page, is cut by
the names alone.

Nothing is learned from a sample. Pages are read where they lie; of each goes on its structure, and a digest and the number of words
of each of its texts. One task per host gets its differing structures only; what all pages share, the words in each
container and pages that are unlike each other are found by every task for its pages and merged, so a host with a
third of all pages is spread like any other, in learning and in extraction. Wrappers are broadcast while they are at most
``MAX_BROADCAST`` hosts, else joined by shuffle.
"""

from __future__ import annotations

import hashlib
import html as references
import json
import re
from collections import Counter
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import held

MAX_BROADCAST = 20_000
#: Share of a container's varying prose that one in it must have to be followed.
NEARLY_ALL = 0.8
#: Differing pages without a common text of their own that it takes to call a text inside the article the template's.
UNLIKE = 4
#: Cells of an alignment table; longer stretches are first cut at tokens that both have once.
TABLE = 4_000_000
#: Containers that are deeper are no groups of the expression, which is nested as they are.
DEEPEST = 60
#: Tokens of a repeated unit before its own repeats are folded.
LONGEST = 16

# Element names by role.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style template noscript iframe svg textarea title select option button audio video canvas".split())
INLINE = set("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark math mfrac mi mn mo mroot mrow msqrt mstyle msub msubsup msup mtext munder nobr object q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
SKIPPED = set("head nav header footer aside form menu dialog fieldset".split())
MAIN = set("article main".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6 hgroup".split())
ENDS_ITSELF = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "body": ({"head"}, {"html"})}
# Names of classes, ids and roles that mark what is no article.
ASIDE_NAMES = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar side-bar menu nav navbar navigation breadcrumb breadcrumbs footer masthead topbar header "
    "site-header page-header site-footer page-footer cookie cookies consent notice notices alert popup modal newsletter subscribe signup login search share sharing social related recommended widget comment comments commentlist "
    "disqus replies respond pagination pager toolbar skip-link contentinfo complementary".split()
)
# Words that mark a layout element whose name begins with one, or ends with one of the second list.
ASIDE_FIRST = ASIDE_NAMES - set("alert header footer login notice notices search".split()) | set("cookie notice-bar".split())
ASIDE_LAST = set("ad ads advert banner breadcrumbs comments consent cookies menu modal nav navbar newsletter notice notices pagination popup promo sidebar toolbar widget".split())
LAYOUT = set("div section ul ol dl table nav aside header footer form main article span".split())
TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"'<]|\"[^\"<]*\"|'[^'<]*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.S)
NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)


def is_aside(name: str, label: str) -> bool:
    """Whether the class, id and role names of an element say that it is no article."""
    for word in label.split():
        if word in ASIDE_NAMES:
            return True
        parts = [p for p in re.split(r"[-_]+", word) if p]
        if name in LAYOUT and len(parts) > 1 and (parts[0] in ASIDE_FIRST or parts[-1] in ASIDE_LAST):
            return True
    return False


@dataclass
class Page:
    """Structure keys in order and, for each block of text, where it stands."""

    keys: list[str] = field(default_factory=list)
    blocks: list[tuple[int, str, bool, bool, bool, bool]] = field(default_factory=list)  # (place, text, aside, in main, all link, in a heading)


def read(html: str | None) -> Page:
    """Tokenise with the usual repairs: implied ends, stray ends ignored, raw elements skipped."""
    page, html = Page(), html or ""
    stack: list[tuple[str, str, bool, bool]] = []  # (name, key, aside, main)
    parts: list[tuple[str, bool]] = []
    depth_link = 0

    def flush() -> None:
        if parts:
            text = " ".join(references.unescape("".join(p for p, _ in parts)).split())
            if text:
                link = all(in_link for p, in_link in parts if p.strip())
                top = stack[-1] if stack else ("", "", False, False)
                page.keys.append("@" if link else "#")
                page.blocks.append((len(page.keys) - 1, text, top[2], top[3], link, any(e[0] in HEADINGS for e in stack[-3:])))
            parts.clear()

    def leave() -> None:
        flush()
        name, key, _, _ = stack.pop()
        page.keys.append("/" + key)

    def close(names: set[str], until: set[str]) -> None:
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] in names:
                while len(stack) > k:
                    leave()
                return
            if stack[k][0] in until:
                return

    at, lower = 0, None
    for m in iter(lambda: TAG.search(html, at), None):
        if m.start() > at:
            parts.append((html[at : m.start()], depth_link > 0))
        at = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            continue
        ends, attrs = (m[1] or m[4]) == "/", m[3] or m[6] or ""
        if name in INLINE:
            if name == "a":
                depth_link = max(0, depth_link + (-1 if ends else 1))
            elif name == "br":
                parts.append((" ", depth_link > 0))
            continue
        if name in RAW:
            if not ends and not attrs.endswith("/"):
                lower = lower if lower is not None else html.lower()  # same length: see below
                found = lower.find("</" + name, at) if len(lower) == len(html) else html.find("</" + name, at)
                at = len(html) if found < 0 else (html.find(">", found) + 1 or len(html))
                parts.append((" ", depth_link > 0))
            continue
        if name in VOID:
            flush()
            continue
        depth_link = 0
        if ends:
            if any(s[0] == name for s in stack):
                while stack[-1][0] != name:
                    leave()
                leave()
            else:
                flush()
            continue
        flush()
        if any(s[0] == "p" for s in stack):
            close({"p"}, {"td", "th", "li", "div", "section", "article", "main", "blockquote"})
        if name in ENDS_ITSELF:
            close(*ENDS_ITSELF[name])
        label = " ".join(x or y or z for x, y, z in NAMES.findall(attrs)).lower() if attrs else ""
        above = stack[-1] if stack else ("", "", False, False)
        main = above[3] or name in MAIN or " main " in f" {label} "
        aside = above[2] or (name in SKIPPED and not (name == "header" and above[3])) or bool(label and name not in ("html", "body") and not (name in MAIN and not above[3]) and is_aside(name, label))
        if name in MAIN and label and re.search(r"(?:^|[\s_-])(?:comments?|repl(?:y|ies)|related|teaser|ads?)(?:$|[\s_-])", label):
            aside = True
        key = name + ("." + re.sub(r"\d+", "0", label).strip() if label else "")
        stack.append((name, key, aside, main and not aside))
        page.keys.append(key)
    if at < len(html):
        parts.append((html[at:], depth_link > 0))
    flush()
    while stack:
        leave()
    return page


class Alphabet:
    """Structure keys and repeated groups as single characters."""

    FIRST, LETTERS = 0x10000, 0x100000

    def __init__(self) -> None:
        self.of: dict[str, str] = {}
        self.key_of: dict[str, str] = {}
        self.groups: dict[str, str] = {}  # character -> body
        self.known: dict[str, str] = {}  # body -> character

    def char(self, key: str) -> str:
        if key not in self.of:
            self.of[key] = chr(self.FIRST + len(self.of) + len(self.groups))
            self.key_of[self.of[key]] = key
        return self.of[key]

    def group(self, body: str) -> str:
        if body not in self.known:
            c = chr(self.FIRST + len(self.of) + len(self.groups))
            self.known[body], self.groups[c] = c, body
        return self.known[body]

    def encode(self, keys: list[str]) -> str:
        return "".join(map(self.char, keys))

    def _depth(self, c: str) -> int:
        """1 for an opening tag, -1 for a closing one, 0 for text and for groups, which are balanced."""
        key = self.key_of.get(c, "#")
        return 0 if key in ("#", "@") else -1 if key.startswith("/") else 1

    def _repeats(self, s: str) -> str:
        """Adjacent repeats of whole elements as groups, leftmost and shortest first."""
        out, i, depths = [], 0, [self._depth(c) for c in s]
        while i < len(s):
            depth, end = 0, i
            for n in range(1, min(LONGEST, (len(s) - i) // 2) + 1):
                depth += depths[i + n - 1]
                if depth < 0:
                    break
                if depth == 0 and s[i : i + n] == s[i + n : i + 2 * n]:
                    unit, end = s[i : i + n], i + 2 * n
                    while s.startswith(unit, end):
                        end += n
                    out.append(unit if unit in self.groups else self.group(unit))
                    break
            if end == i:
                out.append(s[i])
                end = i + 1
            i = end
        return "".join(out)

    def fold(self, s: str) -> str:
        """Adjacent repeats become groups, inner ones first; known groups also absorb single occurrences."""
        while True:
            before = s
            s = self._repeats(s)
            for body, c in list(self.known.items()):
                s = re.sub(f"(?:{re.escape(body)}|{re.escape(c)})+", c, s)
            if s == before:
                return s

    def pattern(self, c: str) -> str:
        return f"(?:{''.join(map(self.pattern, self.groups[c]))})++" if c in self.groups else re.escape(c)


def _pairs(a: str, b: str) -> list[tuple[int, int]]:
    """Places of a longest common subsequence; stretches too long for a table are cut at tokens that both have once."""
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
        if (m - i) * (n - j) > TABLE:
            x, y = a[i:m], b[j:n]
            once = Counter(x), Counter(y)
            anchors = [(p, y.index(c)) for p, c in enumerate(x) if once[0][c] == once[1][c] == 1]
            rising: list[tuple[int, int]] = []
            for anchor in anchors:  # those in order with the last one kept
                if not rising or anchor[1] > rising[-1][1]:
                    rising.append(anchor)
            if not rising:  # halves of one against what the next occurrences of its middle token leave of the other
                p = len(x) // 2
                q = y.find(x[p], len(y) // 2)
                rising = [(p, q)] if q >= 0 else []
            at = (i, j)
            for p, q in rising:
                todo.append((at[0], i + p, at[1], j + q))
                found.append((i + p, j + q))
                at = (i + p + 1, j + q + 1)
            if rising:
                todo.append((at[0], m, at[1], n))
            continue
        best = [[0] * (n - j + 1) for _ in range(m - i + 1)]
        for p in range(m - i - 1, -1, -1):
            row, below, x = best[p], best[p + 1], a[i + p]
            for q in range(n - j - 1, -1, -1):
                row[q] = below[q + 1] + 1 if x == b[j + q] else max(below[q], row[q + 1])
        p = q = 0
        while p < m - i and q < n - j:
            if a[i + p] == b[j + q]:
                found.append((i + p, j + q))
                p, q = p + 1, q + 1
            elif best[p + 1][q] >= best[p][q + 1]:
                p += 1
            else:
                q += 1
    return sorted(found)


def align(a: list[tuple[str, bool]], b: str) -> list[tuple[str, bool]]:
    """Merge a folded page into a wrapper of (character, optional): common ones stay, others become optional."""
    out, i, j = [], 0, 0
    for p, q in [*_pairs("".join(c for c, _ in a), b), (len(a), len(b))]:
        out += [(c, True) for c, _ in a[i:p]] + [(c, True) for c in b[j:q]]
        if p < len(a):
            out.append(a[p])
        i, j = p + 1, q + 1
    return out


def _containers(items: list[str]) -> list[tuple[int, int]]:
    """(first, last) of the layout containers of a wrapper's items, outer ones first."""
    found, stack = [], []
    for i, key in enumerate(items):
        name = key.lstrip("/").split(".")[0]
        if not key or name in ("#", "@"):
            continue
        if not key.startswith("/"):
            stack.append((key, i))
        else:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == key[1:]:
                    if (name in LAYOUT or name in ("body", "td", "center")) and k < DEEPEST:
                        found.append((stack[k][1], i))
                    del stack[k:]
                    break
    return sorted(found, key=lambda x: (x[0], -x[1]))


def _expression(wrapper: list[tuple[str, bool]], alphabet: Alphabet, containers: list[tuple[int, int]]) -> str:
    """The regular expression, with a group for each container."""
    closes = Counter()
    names: dict[int, list[str]] = {}
    for k, (a, b) in enumerate(containers):
        names.setdefault(a, []).append(f"(?P<c{k}>")
        closes[b] += 1
    parts = []
    for i, (c, optional) in enumerate(wrapper):
        parts += names.get(i, [])
        parts.append(f"(?:{alphabet.pattern(c)})?+" if optional else alphabet.pattern(c))
        parts.append(")" * closes[i])
    return "".join(parts)


def _spans(pattern: re.Pattern, keys: list[str], alphabet: dict[str, str]) -> dict[str, tuple[int, int]] | None:
    """Places of the containers in a page that the expression matches; empty where an optional one is absent."""
    m = pattern.fullmatch("".join(alphabet.get(k, "\uffff") for k in keys))
    return None if m is None else {name: m.span(name) for name in pattern.groupindex}


def _digest(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


def brief(page: Page) -> tuple[list[str], list[tuple[int, int, int, bool, bool, bool, bool]]]:
    """What learning needs of a page: its keys and its blocks, with a digest and the number of words for the text."""
    return page.keys, [(place, _digest(text), len(text.split()), *marks) for place, text, *marks in page.blocks]


def learn(shapes: list[list[str]]) -> dict:
    """The wrapper of differing structures: alphabet, expression, and its containers' elements and places."""
    alphabet, wrapper, pattern = Alphabet(), None, None
    for keys in shapes:
        if pattern is not None and pattern.fullmatch("".join(alphabet.of.get(k, "\uffff") for k in keys)):
            continue
        if len(alphabet.of) + len(alphabet.groups) + 2 * len(keys) > alphabet.LETTERS:
            continue  # names without end: there are no more characters, and the page is cut by the names alone
        folded = alphabet.fold(alphabet.encode(keys))
        if wrapper is None:
            wrapper = [(c, False) for c in folded]
        elif "".join(c for c, _ in wrapper) != folded:
            plain = alphabet.fold("".join(c for c, _ in wrapper))  # groups that the new page showed
            if len(plain) != len(wrapper):
                optional = {c for c, o in wrapper if o}
                wrapper = [(c, c in optional) for c in plain]
            wrapper = align(wrapper, folded)
        items = [alphabet.key_of.get(c, "") for c, _ in wrapper]
        containers = _containers(items)
        source = _expression(wrapper, alphabet, containers)
        pattern = re.compile(source, re.S) if source else None
    if wrapper is None:
        return {"alphabet": {}, "pattern": "", "containers": []}
    return {"alphabet": alphabet.of, "pattern": source, "containers": [(items[a].split(".")[0], a, b) for a, b in containers]}


class Survey:
    """What pages of one host show under its wrapper, found for any part of them and merged.

    The first pass finds the texts that all pages share, outside of main elements and in each container. With those known
    (``common``) the second counts words and headings by container and keeps pages that are unlike each other.
    """

    def __init__(self, common: dict[str, list[int]] | None = None) -> None:
        self.n = 0
        self.common = None if common is None else {k: set(v) for k, v in common.items()}
        self.shared: dict[str, set[int]] = {}
        self.kept: dict[str, list[set[int]]] = {}
        self.counts: dict[str, list[int]] = {}  # container -> words, headings, and both in texts that all share outside

    def add(self, blocks: list[tuple], spans: dict[str, tuple[int, int]]) -> None:
        self.n += 1
        found = {"outside": {b[1] for b in blocks if not b[3] and not b[4]}}
        found |= {name: {b[1] for b in blocks if not b[3] and x <= b[0] < y} for name, (x, y) in spans.items() if y > x}
        for name, texts in found.items():
            if self.common is None:
                self._share(name, texts)
            else:
                self._keep(name, texts - self.common.get(name, set()))
        if self.common is None:
            return
        for place, text, words, aside, _, link, heading in blocks:
            if not aside and not link:
                template = text in self.common.get("outside", set())
                for name in [n for n, (x, y) in spans.items() if x <= place < y] + ["page"]:
                    self._count(name, [words, int(heading), words * template, int(heading and template)])

    def _share(self, name: str, texts: set[int]) -> None:
        self.shared[name] = self.shared[name] & texts if name in self.shared else texts

    def _keep(self, name: str, own: set[int]) -> None:
        """Copies and near copies of one article share its texts too; they are not unlike."""
        kept = self.kept.setdefault(name, [])
        if own and len(kept) < UNLIKE and all(10 * len(own & k) <= min(len(own), len(k)) for k in kept):
            kept.append(own)

    def _count(self, name: str, more: list[int]) -> None:
        self.counts[name] = [a + b for a, b in zip(self.counts.get(name, [0] * 4), more)]

    def state(self) -> str:
        return json.dumps({"n": self.n, "shared": {k: list(v) for k, v in self.shared.items()}, "kept": {k: [sorted(x) for x in v] for k, v in self.kept.items()}, "counts": self.counts})

    def merge(self, state: str) -> None:
        other = json.loads(state)
        self.n += other["n"]
        for name, texts in other["shared"].items():
            self._share(name, set(texts))
        for name, sets in other["kept"].items():
            for own in sets:
                self._keep(name, set(own))
        for name, more in other["counts"].items():
            self._count(name, more)


def conclude(learned: dict, survey: Survey) -> str:
    """The wrapper as JSON: alphabet, expression, the article's container, digests of template texts.

    Texts on all pages are the template's if there are ``UNLIKE`` pages whose other texts are their own; else none are.
    """
    template = lambda name: sorted(survey.common.get(name, ())) if len(survey.kept.get(name, ())) >= UNLIKE else []
    known = bool(template("outside"))
    prose = Counter({name: c[0] - c[2] * known for name, c in survey.counts.items()})
    headings = Counter({name: c[1] - c[3] * known for name, c in survey.counts.items()})
    chosen = _choose(learned["containers"], prose, headings) if survey.n > 1 else None
    semantic = bool(chosen) and learned["containers"][int(chosen[1:])][0] in MAIN
    return json.dumps({"alphabet": learned["alphabet"], "pattern": learned["pattern"], "chosen": chosen, "semantic": semantic, "outside": template("outside"), "inside": template(chosen) if chosen else []})


def infer(pages: list[str]) -> str:
    """The wrapper of a host from pages in one place; see ``conclude``."""
    briefs = [brief(read(p)) for p in pages]
    learned = learn([keys for keys, _ in briefs])
    pattern = re.compile(learned["pattern"], re.S)
    met = [(blocks, spans) for keys, blocks in briefs if learned["pattern"] and (spans := _spans(pattern, keys, learned["alphabet"])) is not None]
    first = Survey()
    for blocks, spans in met:
        first.add(blocks, spans)
    second = Survey(first.shared)
    for blocks, spans in met:
        second.add(blocks, spans)
    return conclude(learned, second)


def _choose(containers: list[tuple[str, int, int]], prose: Counter, headings: Counter) -> str | None:
    """The group of the container that holds the host's prose that is not the template's; None for the whole page.

    Only pages unlike each other tell a template: on a host of copies, what they share counts as prose.
    """
    at, inner = "page", [f"c{k}" for k in range(len(containers))]
    within = {f"c{k}": [f"c{o}" for o, (_, x, y) in enumerate(containers) if a < x and y < b] for k, (_, a, b) in enumerate(containers)}
    while prose[at]:
        main = [n for n in inner if containers[int(n[1:])][0] in MAIN and 2 * prose[n] > prose[at]]
        if main:
            return main[0]
        fuller = [n for n in inner if prose[n] >= NEARLY_ALL * prose[at] and headings[n] == headings[at]]
        if not fuller:
            break
        at = fuller[0]
        inner = within[at]
    return None if at == "page" else at


class Wrapper:
    def __init__(self, source: str) -> None:
        found = json.loads(source)
        self.alphabet, self.chosen, self.semantic = found["alphabet"], found["chosen"], found["semantic"]
        self.outside, self.inside = set(found["outside"]), set(found["inside"])
        self.pattern = re.compile(found["pattern"], re.S) if found["pattern"] else None

    def region(self, page: Page) -> tuple[int, int] | None:
        """Places of the article in a page that the wrapper matches."""
        if self.pattern is None or not self.chosen:
            return None
        spans = _spans(self.pattern, page.keys, self.alphabet)
        span = spans[self.chosen] if spans else (0, 0)
        return span if span[1] > span[0] else None  # all of it may be optional


def _among(text: str, template: set[int]) -> bool:
    return bool(template) and _digest(text) in template


def extract(html: str | None, wrapper: Wrapper | None) -> str:
    """The article's blocks in page order, one per line."""
    page = read(html)
    region = wrapper.region(page) if wrapper else None
    kept = [b for b in page.blocks if not b[2]]
    if region:
        inside = [b for b in kept if region[0] <= b[0] < region[1] and not _among(b[1], wrapper.inside)]
        if not wrapper.semantic:  # lists of links and the template's own texts are no article
            inside = [b for b in inside if not b[4] and not _among(b[1], wrapper.outside)] or inside
        kept = inside
    elif any(b[3] for b in kept):
        kept = [b for b in kept if b[3]]
    else:  # no main container: lists of links and the template's own texts are no article
        template = wrapper.outside if wrapper else frozenset()
        kept = [b for b in kept if not b[4] and not _among(b[1], template)] or kept
    return "\n".join(b[1] for b in kept)


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


BRIEF = "host string, hash long, shape long, keys array<string>, blocks array<struct<place:int,text:long,words:int,aside:boolean,main:boolean,link:boolean,heading:boolean>>"
#: Hosts whose surveys a task holds before it hands them on.
HELD = 500


def _read_rows(batches):
    for pdf in batches:
        rows = []
        for host, number, html in zip(pdf["host"], pdf["hash"], pdf["html"]):
            keys, blocks = brief(read(html))
            rows.append((host, number, _digest("\x00".join(keys)), keys, [dict(zip(("place", "text", "words", "aside", "main", "link", "heading"), b)) for b in blocks]))
        yield pd.DataFrame(rows, columns=["host", "hash", "shape", "keys", "blocks"])


def _surveyed(rows: DataFrame, learned: DataFrame) -> DataFrame:
    """(host, state): the surveys of all ``rows`` under ``learned`` (host, learned, common), merged by host."""

    def look(batches):
        held_: dict[str, Survey] = {}
        parsed: dict[str, tuple] = {}

        def hand_on():
            out = pd.DataFrame({"host": list(held_), "state": [x.state() for x in held_.values()]}, dtype=object)
            held_.clear()
            parsed.clear()
            return out

        for pdf in batches:
            for host, keys, blocks, source, common in zip(pdf["host"], pdf["keys"], pdf["blocks"], pdf["learned"], pdf["common"]):
                if host not in held_:
                    if len(held_) >= HELD:
                        yield hand_on()
                    found = json.loads(source)
                    parsed[host] = (re.compile(found["pattern"], re.S), found["alphabet"])
                    held_[host] = Survey(None if common is None else json.loads(common))
                spans = _spans(parsed[host][0], list(keys), parsed[host][1])
                if spans is not None:
                    held_[host].add([(b["place"], b["text"], b["words"], b["aside"], b["main"], b["link"], b["heading"]) for b in blocks], spans)
        yield hand_on()

    met = rows.select(F.col("host").alias("_host"), "keys", "blocks").join(learned, F.col("_host") == F.col("host"))
    return met.select("host", "keys", "blocks", "learned", "common").mapInPandas(look, "host string, state string")


def wrappers(pages: DataFrame, scratch, *, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, wrapper) from all differing pages of each host; equal pages count once."""
    rows = pages.select(host_of(F.col(url_col)).alias("host"), F.col(html_col).alias("html")).where("html is not null").withColumn("hash", F.xxhash64("html"))
    rows = scratch.keep(rows.mapInPandas(_read_rows, BRIEF).dropDuplicates(["host", "hash"]), "briefs")

    def small(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if df.count() <= MAX_BROADCAST else df

    def learned_of(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        found = learn([list(k) for k in pdf.sort_values("shape", kind="stable")["keys"]])
        return pd.DataFrame({"host": [key[0]], "learned": [json.dumps(found)], "common": [None]}, dtype=object)

    def shared_of(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        survey = Survey()
        for state in pdf["state"]:
            survey.merge(state)
        return pd.DataFrame({"of": [key[0]], "common": [json.dumps({k: sorted(v) for k, v in survey.shared.items()})]})

    def concluded(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        survey = Survey(json.loads(pdf["common"].iloc[0]))
        for state in sorted(pdf["state"]):
            survey.merge(state)
        return pd.DataFrame({"host": [key[0]], "wrapper": [conclude(json.loads(pdf["learned"].iloc[0]), survey)]})

    shapes = rows.groupBy("host", "shape").agg(F.first("keys").alias("keys"))
    learned = scratch.keep(shapes.groupBy("host").applyInPandas(learned_of, "host string, learned string, common string"), "learned")
    shared = _surveyed(rows, small(learned)).groupBy("host").applyInPandas(shared_of, "of string, common string")
    shared = scratch.keep(learned.drop("common").join(shared, F.col("host") == F.col("of")).drop("of"), "shared")
    counted = _surveyed(rows, small(shared)).withColumnRenamed("host", "of").join(shared, F.col("host") == F.col("of")).drop("of")
    out = scratch.keep(counted.groupBy("host").applyInPandas(concluded, "host string, wrapper string"), "wrappers")
    scratch.drop("briefs")
    return out


def _wrapper(source: str | None) -> Wrapper | None:
    if source is None:
        return None
    compiled = held("wrappers", dict)
    if source not in compiled:
        if len(compiled) > 2000:
            compiled.clear()
        compiled[source] = Wrapper(source)
    return compiled[source]


def extract_main(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", scratch=None) -> DataFrame:
    """(``id_col``, ``url_col``, text, n_chars) for every row, from the whole HTML.

    ``text`` has the article's blocks (headings, paragraphs, items, cells) in page order, joined by one line
    feed, with character references decoded and white space turned into one space; it is empty where there is
    none, or the HTML is null. ``n_chars`` counts its code points. Pages without a host share the wrapper of the empty
    host. Repeated rows and null ids give one row each; other columns are not read.
    """
    from .common import Scratch

    scratch = scratch or Scratch(pages.sparkSession, "html")
    known = wrappers(pages, scratch, url_col=url_col, html_col=html_col)
    right = known.select(F.col("host").alias("_host"), F.col("wrapper").alias("_wrapper"))
    if known.count() <= MAX_BROADCAST:
        right = F.broadcast(right)
    rows = pages.select(F.col(id_col), F.col(url_col), F.col(html_col).alias("_html")).withColumn("_at", host_of(F.col(url_col)))
    cut = F.pandas_udf(lambda h, w: pd.Series([extract(x, _wrapper(y)) for x, y in zip(h, w)], dtype=object), "string")
    met = rows.join(right, F.col("_at") == F.col("_host"), "left").select(id_col, url_col, cut("_html", "_wrapper").alias("text"))
    return met.select(id_col, url_col, "text", F.length("text").cast("long").alias("n_chars"))
