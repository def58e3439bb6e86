"""Neighbour search, decontamination, wrapper extraction and the pipeline."""

import random

import numpy as np
import pytest

from ledgerloom.llm import ann, decontaminate, html_extract

# ------------------------------------------------------------------ neighbours

VECTORS = "vec_id long, embedding array<float>, list int, code string, q int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, "c", 2) for i, v in rows], VECTORS)


def exact(rows, queries, k=5):
    good = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v) and len(v) == 16]
    out = {}
    for q in queries:
        vq = dict(good).get(q)
        if vq is not None:
            scored = sorted({(-round(float(vq @ v / np.linalg.norm(vq) / np.linalg.norm(v)), 9), i) for i, v in good if i != q})
            out[q] = [i for _, i in scored[:k]]
    return out


def test_neighbours_recall_and_odd_rows(spark):
    rng = np.random.default_rng(8)
    centers = rng.normal(size=(12, 16))
    rows = [(i, [float(x) for x in centers[i % 12] + 0.4 * rng.normal(size=16)]) for i in range(1500)]
    rows += [(2000 + k, rows[0][1]) for k in range(300)]  # one very common vector
    rows += [(5000, None), (5050, [0.0] * 16), (5001, [float("nan")] + [1.0] * 15), (5002, [None] + [1.0] * 15), (5003, [float("inf")] + [1.0] * 15), (5004, [1.0] * 3), (None, rows[1][1])]
    frame = vectors(spark, rows)
    got = {}
    for r in ann.search(frame, frame.where("vec_id % 50 = 0")).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
        assert r.rank == len(got[r.query_id])
    want = exact(rows, [i for i, _ in rows if i is not None and i % 50 == 0])
    assert set(got) == set(want)
    assert np.mean([len(set(got[q]) & set(want[q])) / 5 for q in want]) >= 0.9
    assert got[0] == [2000, 2001, 2002, 2003, 2004]


def test_neighbours_in_a_group_of_thousands_of_near_copies(spark):
    rng = np.random.default_rng(3)
    center = rng.normal(size=16)
    rows = [(i, [float(x) for x in (center + 0.02 * rng.normal(size=16) if i % 3 == 0 else rng.normal(size=16))]) for i in range(7500)]
    frame = vectors(spark, rows)
    got = {}
    for r in ann.search(frame, frame.where("vec_id % 150 = 0 or vec_id % 150 = 1")).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    near = exact(rows, range(0, 7500, 150))
    assert all(got[q] == near[q] for q in near)
    others = exact(rows, range(1, 7500, 150))
    assert np.mean([len(set(got[q]) & set(others[q])) / 5 for q in others]) >= 0.9


def test_neighbours_of_huge_and_tiny_components(spark):
    rows = [(0, [1e200, 0.0]), (1, [1.0, 0.0]), (2, [1e200, 1.0]), (3, [0.0, 1.0]), (4, [1e-200, 1e-200]), (5, [5e-324, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {(r.query_id, r.vec_id): (r["rank"], r.score) for r in ann.search(frame, frame).collect()}
    assert [1, 2, 5, 4, 3] == [i for _, i in sorted((got[0, i][0], i) for i in (1, 2, 3, 4, 5))]
    assert got[0, 1][1] == got[0, 2][1] == got[5, 0][1] == 1.0 and got[0, 3][1] == 0.0
    assert abs(got[0, 4][1] - 0.5**0.5) < 1e-15


@pytest.mark.parametrize("n", [0, 1, 3])
def test_neighbours_in_tiny_tables(spark, n):
    rows = [(i, [float(i + 1), 1.0]) for i in range(n)]
    frame = vectors(spark, rows)
    got = ann.search(frame, frame).collect()
    assert len(got) == n * max(0, n - 1)
    assert all(abs(r.score) <= 1 + 1e-12 for r in got)


# ------------------------------------------------------------------ decontamination


def words(seed, n):
    rng = random.Random(seed)
    return ["".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(n)]


def test_leaks(spark, monkeypatch):
    filler = lambda seed, n: " ".join(random.Random(seed).choice(["the", "of", "and", "in", *words(seed % 7, 40)]) for _ in range(n))
    items = [(k, " ".join(words(100 + k, 12 + 3 * k))) for k in range(12)] + [(90, None), (91, ""), (92, "...")]
    rows = [(i, filler(i, 30 + 7 * i)) for i in range(40)]
    rows += [(100 + k, filler(k, 200) + " " + items[k][1].capitalize() + ". " + filler(k + 1, 100)) for k in range(12)]
    rng = random.Random(3)
    loose = lambda text: " ".join(w if rng.random() > 0.15 else "changed" for w in text.split()[:-5]) + " " + " ".join(text.split()[-5:])
    rows += [(200 + k, filler(k, 90) + " " + loose(items[k][1])) for k in range(6, 12)]
    rows += [(300, None), (301, ""), (302, filler(5, 30_000)), (None, items[3][1]), (303, items[2][1]), (303, items[2][1])]
    docs = spark.createDataFrame([(i, t, 0, "x") for i, t in rows], "doc_id long, text string, item_id int, lcs string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.find_leaks(docs, benchmark).collect()
    found = sorted({(r.doc_id if r.doc_id is not None else -1, r.item_id) for r in got})
    assert found == sorted([(100 + k, k) for k in range(12)] + [(200 + k, k) for k in range(6, 12)] + [(-1, 3), (303, 2)])
    assert sum(r.doc_id == 303 for r in got) == 2
    blocks = decontaminate.find_leaks(docs, benchmark, block_items=5)
    assert sorted({(r.doc_id if r.doc_id is not None else -1, r.item_id) for r in blocks.collect()}) == found
    monkeypatch.setattr(decontaminate, "GROUP", 1)
    monkeypatch.setattr(decontaminate, "FAN", 2)
    blocks = decontaminate.find_leaks(docs.repartition(5), benchmark, block_items=5)
    assert sorted({(r.doc_id if r.doc_id is not None else -1, r.item_id) for r in blocks.collect()}) == found
    kept = decontaminate.without_leaks(docs, benchmark)
    assert kept.columns == docs.columns
    bad = {i for i, _ in found}
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(i) for i, _ in rows if (-1 if i is None else i) not in bad)
    assert decontaminate.find_leaks(docs.where("false"), benchmark).count() == 0
    assert decontaminate.find_leaks(docs, benchmark.where("false")).count() == 0


def leaks(spark, rows, items):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted((r.doc_id, r.item_id) for r in decontaminate.find_leaks(docs, spark.createDataFrame(items, "item_id long, text string")).collect())


def test_an_item_that_leaks_often_is_found_in_every_row(spark):
    item = " ".join(words(500, 20))
    text = lambda seed, n: " ".join(words(1000 + seed, n))
    assert leaks(spark, [(0, text(0, 9) + " " + item), (1, item + " " + text(1, 30)), (2, text(2, 40))], [(7, item)]) == [(0, 7), (1, 7)]
    items = [(7, item), *((k, text(300 + k, 25)) for k in range(20, 40))]
    rows = [(i, f"{text(i, 40)} {item} {text(400 + i, 40)}" if i % 3 == 0 else text(i, 100)) for i in range(90)]
    rows += [(200, text(900, 30) + " " + items[4][1])]
    assert leaks(spark, rows, items) == [(i, 7) for i in range(0, 90, 3)] + [(200, items[4][0])]


def test_paraphrases_without_an_items_rarest_words(spark):
    """12 of an item's 32 words, its rarest, are replaced: the others have a quarter of its squared weight."""
    rng = random.Random(9)
    items, leaked = [], []
    for k in range(12):
        rare, usual = words(2000 + k, 12), [rng.choice(words(3000 + k % 3, 18)) for _ in range(12)]
        body = [w for pair in zip(rare, usual) for w in pair]
        tail = rng.sample(words(3000 + k % 3, 18), 8)
        items.append((k, " ".join(body + tail)))
        leaked.append((k, " ".join(words(5000 + k, 60) + ["other" if w in rare else w for w in body] + tail + words(6000 + k, 60))))
    rows = leaked + [(100 + i, " ".join(words(7000 + i, 40) + words(3000 + i % 3, 18) + words(8000 + i, 40))) for i in range(60)]
    assert leaks(spark, rows, items) == [(k, k) for k in range(12)]


def test_no_pair_that_would_be_confirmed_is_refused_before():
    rng = random.Random(4)
    items = [[rng.choice("abcdefghijklmnop") for _ in range(n)] for n in (1, 2, 5, 9, 17, 33, 50, 90)]
    block = decontaminate.vocabulary_of(list(range(len(items))), [" ".join(i) for i in items])
    block.set_items()
    for item in items:
        texts = []
        for _ in range(20):
            kept = [w for w in item if rng.random() > 0.3]
            around = lambda: [rng.choice("abxyz") for _ in range(rng.randrange(80))]
            texts.append(decontaminate.numbers_of(" ".join(around() + kept + around()), block.vocabulary))
        w = decontaminate.windows_of(texts)
        first, owner = decontaminate._pairs_of_blocks(w)
        first, owner, cols = np.repeat(first, len(items)), np.repeat(owner, len(items)), np.tile(np.arange(len(items)), len(first))
        fits = decontaminate.may_hold(block, w, first, owner, cols)
        for f, t, k, fit in zip(first, owner, cols, fits):
            start = int(f - w.starts[t]) * decontaminate.STEP
            assert fit or not block.confirm(w.words[t], k, start, start + decontaminate.WINDOW)
        assert not fits.all()


def common(a, b):
    """Longest common subsequence by the textbook."""
    row = [0] * (len(b) + 1)
    for x in a:
        last = row
        row = [0]
        for j, y in enumerate(b):
            row.append(last[j] + 1 if x == y else max(last[j + 1], row[j]))
    return row[-1]


def leaks_brute(rows, items):
    """Every stretch of one and a half times an item's words, without any retrieval."""
    found = set()
    for i, text in rows:
        words_ = text.lower().split()
        for k, item in items:
            item = item.split()
            n, span, tail = len(item), len(item) * 3 // 2, item[-max(4, len(item) // 4) :]
            for at in range(len(words_)):
                part = words_[at : at + span]
                if sum(w in item for w in part) >= 0.6 * n:
                    whole = common(item, part) / n
                    if whole >= 0.8 or (whole >= 0.6 and common(tail, part) / len(tail) >= 0.75):
                        found.add((i, k))
                        break
    return found


def test_leaks_against_brute_force_over_all_pairs(spark):
    rng = random.Random(12)
    usual = words(900, 30)
    items = [(k, " ".join(rng.choice(usual) if rng.random() < 0.5 else w for w in words(1000 + k, rng.randrange(8, 45)))) for k in range(15)]
    rows = []
    for i in range(90):
        kept, (k, item) = rng.random() * 0.5 + 0.5, rng.choice(items)
        body = item.split()
        cut = len(body) - max(4, len(body) // 4)
        loose = [w if j >= cut or rng.random() < kept else rng.choice([*usual, "", "new"]) for j, w in enumerate(body)]
        around = lambda: [rng.choice([*usual, *words(rng.randrange(50), 3)]) for _ in range(rng.randrange(120))]
        rows.append((i, " ".join(w for w in [*around(), *loose, *around()] if w)))
    want, got = leaks_brute(rows, items), set(leaks(spark, rows, items))
    assert got <= want and len(got) >= 0.95 * len(want) and len(want) > 40


def test_lcs_is_exact():
    rng = random.Random(6)
    for _ in range(100):
        a, b = [[rng.randrange(5) for _ in range(rng.randrange(1, 90))] for _ in range(2)]
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        assert decontaminate.lcs(decontaminate._masks(a), len(a), b) == best[-1][-1]


# ------------------------------------------------------------------ wrappers


def page(k, n, extra="", tail="</article>"):
    body = "".join(f"<p>Text {k} {i} &amp; <b>more</b>\n  here<br>end.</p>" if i % 2 else f"<p><b>Open {k} {i}.<br>" for i in range(n))
    return f'<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var x="</p>";</script></head><body><nav><ul>{"<li><a href=/x>m</a></li>" * (k % 5)}</ul></nav><!-- ad --><div class="ad">Buy</div>{extra}<article><h1>H {k}</h1>{body}{tail}<footer>&copy; f</footer></body></html>'


def article(k, n):
    return "\n".join([f"H {k}"] + [f"Text {k} {i} & more here end." if i % 2 else f"Open {k} {i}." for i in range(n)])


def test_extraction(spark):
    odd = '<aside class="sidebar">side</aside><div class="cookie-notice"><p>We use cookies</p></div><form><input name=q>Search</form>'
    rows = [(k, f"http://h{k % 2}.org/{k}", page(k, k % 7)) for k in range(40)]
    want = {k: article(k, k % 7) for k in range(40)}
    rows += [(100, "http://h0.org/x", page(100, 3, odd, '<div class="comments"><p>First!</p></div></article>')), (101, None, page(101, 2)), (102, "nothing", None), (103, "http://h1.org", ""), (None, "http://h1.org", "plain <text & more"), (104, "http://h1.org/q", page(104, 4000))]
    want |= {100: article(100, 3), 101: article(101, 2), 102: "", 103: "", None: "plain <text & more", 104: article(104, 4000)}
    rows.append(rows[3])
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, html string, host string, wrapper string")
    got = html_extract.extract_main(frame).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.text == want[r.page_id], r.page_id
        assert r.n_chars == len(r.text)
    assert html_extract.extract_main(frame.where("false")).count() == 0


def test_wrapper_is_union_free_and_general():
    wrapper = html_extract.Wrapper(html_extract.infer([page(1, 3), page(2, 6), page(3, 1, "<aside>x</aside>")]))
    for p in (page(9, 20), page(4, 2, "<aside>other</aside>"), page(6, 1)):
        assert wrapper.region(html_extract.read(p))
    assert "|" not in wrapper.pattern.pattern
    assert wrapper.region(html_extract.read("<table><tr><td>x")) is None


def test_pages_without_a_container_lose_the_template():
    pages = [f"<html><body><div>Site name</div><div><a href=/>Home</a></div><div>Story {k}</div><p>Body {k}</p><div>All rights</div></body></html>" for k in range(6)]
    wrapper = html_extract.Wrapper(html_extract.infer(pages))
    assert html_extract.extract(pages[2], wrapper) == "Story 2\nBody 2"


def test_copies_of_a_hosts_pages_do_not_keep_it_from_a_wrapper(spark):
    pages = [f"<html><body><div>Site name</div><div><a href=/>Home</a></div><div>Story {k}</div><p>Body {k}</p><div>All rights</div></body></html>" for k in range(6)]
    frame = spark.createDataFrame([(k, f"http://h.org/{k}", html) for k, html in enumerate(pages)], "page_id long, url string, html string")
    copies = frame.crossJoin(spark.range(3000).select()).union(frame)
    got = html_extract.extract_main(copies).groupBy("page_id", "text").count().collect()
    assert sorted((r.page_id, r.text) for r in got) == [(k, f"Story {k}\nBody {k}") for k in range(6)]


def test_wrappers_learn_from_every_page(spark):
    """One page in two hundred has a notice that no name tells, and lacks the line that the others share."""
    body = lambda k: "".join(f"<p>{' '.join(words(40 * k + i, 12))}</p>" for i in range(2 + k % 3))
    pages = [f"<html><body><div class=x1><h2>Title {k}</h2>{body(k)}{'' if k == 77 else '<p>Always here</p>'}</div>{f'<div class=x2><p>Once {k}</p></div>' if k == 77 else ''}<div class=x3><p>Seen {k}</p></div></body></html>" for k in range(200)]
    frame = spark.createDataFrame([(k, f"http://h.org/{k}", html) for k, html in enumerate(pages)], "page_id long, url string, html string").repartition(5)
    got = {r.page_id: r.text.split("\n") for r in html_extract.extract_main(frame).collect()}
    for k, lines in got.items():
        assert lines == [f"Title {k}", *(" ".join(words(40 * k + i, 12)) for i in range(2 + k % 3)), *(["Always here"] if k != 77 else [])]


def test_the_wrapper_finds_the_article_that_no_name_tells():
    """Varying texts around it would be kept without the wrapper."""
    rng = random.Random(5)
    story = lambda k, i: " ".join(words(100 * k + i, 25))
    pages, want = [], []
    for k in range(8):
        n = 2 + k % 4
        body = "".join(f"<p>{story(k, i)}</p>" for i in range(n))
        more = "<p>Read on</p>" if k % 2 else ""
        pages.append(f"<html><body><div class=top><p>Visit {rng.random()}</p></div><div class=c1><h2>Title {k}</h2><div class=c2>{body}{more}<p>Printed by us</p></div></div><div class=end><p>Seen {rng.random()}</p></div></body></html>")
        want.append("\n".join([f"Title {k}", *(story(k, i) for i in range(n)), *(["Read on"] if k % 2 else [])]))
    wrapper = html_extract.Wrapper(html_extract.infer(pages))
    assert [html_extract.extract(p, wrapper) for p in pages] == want
    assert all(html_extract.extract(p, None) != x for p, x in zip(pages, want))


def test_a_host_of_near_copies_has_no_template():
    paragraphs = [" ".join(words(k, 20)) for k in range(12)]
    pages = []
    for k in range(10):
        own = [" ".join(words(500 + k, 20)) if i == k else p for i, p in enumerate(paragraphs)]
        pages.append("<html><body><div class=date>" + f"Day {k}" + "</div><article>" + "".join(f"<p>{p}</p>" for p in own) + "</article></body></html>")
    wrapper = html_extract.Wrapper(html_extract.infer(pages))
    for k, p in enumerate(pages):
        assert html_extract.extract(p, wrapper) == "\n".join(" ".join(words(500 + k, 20)) if i == k else x for i, x in enumerate(paragraphs))
    copies = [f"<html><body><div>Day {k}</div><div class=b><p>{paragraphs[0]}</p><p>{paragraphs[1]}</p></div></body></html>" for k in range(3)]
    wrapper = html_extract.Wrapper(html_extract.infer(copies))
    assert all("\n".join(paragraphs[:2]) in html_extract.extract(p, wrapper) for p in copies)


def test_text_in_an_article_is_not_dropped_for_a_word_in_a_name():
    inside = '<h2 id="share-price">Price</h2><div class="section-header"><h2>Section</h2></div><p class="notice-period">Notice</p><p>x <math><mi>a</mi><mo>+</mo></math> y</p><object>kept</object><div class="card-footer">foot</div>'
    outside = '<div class="ad-slot">Buy</div><div class="share-buttons">Tell</div><ul class="related-posts"><li>More</li></ul><div class="comments-area"><p>First</p></div><div class="cookie-notice">Ok</div><aside>side</aside>'
    html = f"<html><body><nav>menu</nav><article><h1>Title</h1>{inside}{outside}<p>End</p></article></body></html>"
    want = "Title\nPrice\nSection\nNotice\nx a+ y\nkept\nfoot\nEnd"
    assert html_extract.extract(html, None) == want
    other = html.replace("Title", "Other title").replace("Price", "Cost")
    wrapper = html_extract.Wrapper(html_extract.infer([html, other]))
    assert html_extract.extract(html, wrapper) == want


def test_alignment_is_longest_and_long_streams_are_cut(monkeypatch):
    rng = random.Random(3)
    for _ in range(100):
        a, b = ("".join(rng.choice("abcdef") for _ in range(rng.randrange(30))) for _ in range(2))
        pairs = html_extract._pairs(a, b)
        assert all(a[i] == b[j] for i, j in pairs) and all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))
        assert len(pairs) == common(a, b)
    monkeypatch.setattr(html_extract, "TABLE", 50)
    for _ in range(100):
        a, b = ("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(60))) for _ in range(2))
        pairs = html_extract._pairs(a, b)
        assert all(a[i] == b[j] for i, j in pairs) and all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))
    long = [f"<html><body><article>{''.join(f'<p>{k} {i}</p><h3>{i}</h3><div class=x{i % 7}>{i}</div>' for i in range(900 + k))}</article></body></html>" for k in range(2)]
    assert html_extract.Wrapper(html_extract.infer(long)).region(html_extract.read(long[1]))


@pytest.mark.parametrize("html", ["<", "<p", "<a href='x", "</p></p>", "<p>&#xZZ; &nosuch; &lt;b&gt;", "<!-- open", "<script>never closed", "<li><li><li>", "<p>" * 3000, "<div>" * 3000, "< notag >"])
def test_broken_html_does_not_fail(html):
    html_extract.extract(html, None)
    html_extract.infer([html, html + "x"])


# ------------------------------------------------------------------ pipeline


def test_pipeline_stages(spark, tmp_path):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    rng = random.Random(11)
    pool = {"en": ["the", "of", "with", *(w + "ing" for w in words(1, 300))], "fr": ["le", "la", "é", *(w + "eaux" for w in words(2, 300))]}
    text = lambda lang, n: " ".join(rng.choice(pool[lang]) for _ in range(n))
    item = " ".join(words(77, 30))
    rows = [(i, text("en" if i % 2 else "fr", 40 + i % 90), "en" if i % 2 else "fr") for i in range(120)]
    passage = text("en", 70)
    rows += [(200, text("en", 30) + "\n" + passage, "en"), (201, text("en", 33) + "\n" + passage, "en")]
    rows += [(210, rows[5][1] + " extra", "en"), (220, text("fr", 50) + " " + item, "fr"), (230, "12345 ---", "en"), (231, None, "en"), (240, text("en", 9000), "en")]
    docs = spark.createDataFrame([(i, t, lang, "s", len(t or "")) for i, t, lang in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    at, kept = docs, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        at = stage(spark, at, str(tmp_path))
        assert at.columns == docs.columns
        kept[name] = {r.doc_id: r.text for r in at.collect()}
    every = {r[0] for r in rows}
    assert set(kept["language_id"]) == every - {230, 231}
    assert set(kept["line_dedup"]) == every - {230, 231}
    assert passage in kept["line_dedup"][200] and passage not in kept["line_dedup"][201]
    assert set(kept["near_dedup"]) == every - {230, 231, 210}
    assert set(kept["decontamination"]) == every - {230, 231, 210, 220}
    packed = corpus_pipeline.run(spark, str(tmp_path))
    assert {r.doc_id for r in packed.collect()} == set(kept["decontamination"])


def test_stages_take_odd_tables(spark, tmp_path):
    """Nulls, repeated rows, empty tables and clashing names, stage by stage."""
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    schema = "doc_id long, text string, lang string, _language string, _cut long, _n int, _id string, _version long, row string"
    text = lambda k: " ".join(words(k, 70))
    rows = [(1, text(1)), (2, text(2)), (2, text(2)), (2, text(3)), (3, None), (None, text(4)), (None, None), (5, text(1)), (6, ""), (7, "?"), (8, text(9) + " " + text(5))]
    docs = spark.createDataFrame([(i, t, "en", "l", 1, 2, "i", 3, "r") for i, t in rows], schema)
    spark.createDataFrame([(0, text(5)), (None, text(1)), (1, None)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    left = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.dtypes == docs.dtypes, name
        left[name] = sorted(((r.doc_id or 0, r.text or "", r["_language"], r["_cut"], r["_n"], r["_id"], r["_version"], r.row) for r in out.collect()))
        assert all(x[2:] == ("l", 1, 2, "i", 3, "r") for x in left[name]), name
        assert stage(spark, docs.where("false"), str(tmp_path)).count() == 0, name
    ids = {name: [x[0] for x in found] for name, found in left.items()}
    assert ids["language_id"] == [0, 1, 2, 2, 2, 5, 8]
    assert ids["line_dedup"] == [0, 0, 1, 2, 2, 2, 3, 6, 7, 8]  # 5 repeats 1 and nothing is left of it
    assert ids["near_dedup"] == [0, 0, 1, 2, 3, 6, 7, 8]
    assert ids["decontamination"] == [0, 0, 1, 2, 2, 2, 3, 5, 6, 7]
    pack = corpus_pipeline.STAGES[-1][1]
    assert sorted(r.doc_id or 0 for r in pack(spark, docs, str(tmp_path)).collect()) == sorted(i or 0 for i, _ in rows)
    assert pack(spark, docs.where("false"), str(tmp_path)).count() == 0
