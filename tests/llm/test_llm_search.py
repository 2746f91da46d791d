"""Top-k search, page text and license scans against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from casebook.llm import dom, html_extract, license_scan, topk

VEC = "vec_id long, embedding array<float>, label int, rank string"


def brute(rows, k=5):
    def ok(v):
        return v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v)

    whole = [(i, [int(np.floor(256 * float(np.float32(x)))) for x in v]) for i, v in rows if i is not None and ok(v)]
    out = []
    for q, v in whole:
        if q % 50 == 0:
            best = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in whole if i != q and len(w) == len(v))[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("shard,block,run", [(8192, 4096, 16), (7, 3, 2)])
def test_top_k(spark, monkeypatch, shard, block, run):
    monkeypatch.setattr(topk, "SHARD", shard)
    monkeypatch.setattr(topk, "BLOCK", block)
    monkeypatch.setattr(topk, "RUN", run)
    rng = np.random.default_rng(3)
    rows = [(k, [float(x) for x in rng.standard_normal(4).round(1)]) for k in range(230)]
    rows += [(300, None), (350, [1.0, None, 2.0, 3.0]), (400, [float("nan")] * 4), (450, [float("inf"), 0.0, 0.0, 0.0]), (500, []),
             (550, [1.0, 2.0]), (551, [2.0, 2.0]), (100, rows[100][1]), (None, [1.0] * 4), (600, [1e9, -1e9, 3.0, 1.0])]
    df = spark.createDataFrame([(i, v, None, "z") for i, v in rows], VEC)
    got = sorted(tuple(r) for r in topk.top_k(df, F.col("vec_id") % 50 == 0).collect())
    # An id that stands twice asks once for each of its rows; their lists are merged, so compare the distinct answers.
    want = brute(rows)
    assert [x for x in got if x[0] != 100] == [x for x in want if x[0] != 100]
    assert {x[2:] for x in got if x[0] == 100} <= {x[2:] for x in want if x[0] == 100}
    assert topk.top_k(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>t</title><script>var a="</p><p>no";</script></head><body>
<nav><ul><li><a href=/x>Menu</a></ul></nav><div class="cookie-notice">We use cookies</div>
<article><h1>Head &amp; line</h1><p>One <b>bold<br>text&nbsp;here<p>Two &lt;b&gt;  words
<form><input><p>Send</form><ul><li>first<li>second</ul><div class=comments><p>Reader says</p></div></article>
<aside><p>Side</p></aside><footer>&copy; end</footer></body></html>"""


def test_page_text(spark):
    rows = [(1, "http://a.org/1", PAGE), (2, None, None), (3, "", ""), (4, "http://b.org", "<p>cut <i>off &am"), (1, "http://a.org/1", PAGE),
            (5, "http://b.org/2", "<article><p>" + "long " * 30000 + "<nav>x"), (6, "http://u@H.org:80/x", "no markup at all")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, text string")
    got = {r.page_id: r for r in html_extract.extract(df).collect()}
    assert got[1].text == "Head & line\n\nOne bold text here\n\nTwo <b> words\n\nfirst\n\nsecond"
    assert got[2].text == got[3].text == "" and got[4].text == "cut off &am"
    assert got[5].n_chars == 5 * 30000 - 1 and got[6].text == "no markup at all" and got[6].host == "h.org"
    assert html_extract.extract(df).count() == 7 and html_extract.extract(df.limit(0)).count() == 0


def test_wrapper_drops_what_a_host_repeats(spark):
    page = "<html><body><div><p>Site slogan everywhere</p></div><div><p>Own text {0}</p><p>More {0} here</p></div></body></html>"
    rows = [(k, "http://same.org/%d" % k, page.format(k)) for k in range(12)] + [(50 + k, "http://same.org/c", page.format(3)) for k in range(30)]
    rows += [(99, "http://other.org", page.format(7))]
    got = {r.page_id: r.text for r in html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[5] == "Own text 5\n\nMore 5 here" and got[60] == "Own text 3\n\nMore 3 here"
    assert got[99].startswith("Site slogan")  # one page alone has no template


def test_wrapper_works_on_articles_too(spark):
    page = ("<body><main><h1>Headline {0}</h1><article><p>Sign up for our letter</p><p>Own text {0}</p><div><p>Buy our book</p></div></article></main>"
            "<div><p>Teaser {0}</p></div></body>")
    rows = [(k, "http://same.org/%d" % k, page.format(k)) for k in range(12)] + [(99, "http://other.org", page.format(7))]
    got = {r.page_id: r.text for r in html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[5] == "Headline 5\n\nOwn text 5"
    assert got[99] == "Headline 7\n\nSign up for our letter\n\nOwn text 7\n\nBuy our book"


def test_headings_that_all_articles_have_stay(spark):
    page = ("<body><h2>Site of the day</h2><article><h1>Title {0}</h1><h2>Abstract</h2><p>Text {0}</p><p>Share this page</p><section><h3>Method <em>and</em> data</h3>"
            "<p>More {0}</p></section></article></body>")
    rows = [(k, "http://same.org/%d" % k, page.format(k)) for k in range(12)]
    got = {r.page_id: r.text for r in html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[5] == "Title 5\n\nAbstract\n\nText 5\n\nMethod and data\n\nMore 5"


def test_no_task_folds_a_whole_host(spark, monkeypatch):
    monkeypatch.setattr(html_extract, "FOLD", 4, raising=False)
    fold = html_extract._fold

    def bounded(key, shapes):
        if len(shapes) > 15:
            raise ValueError("a task folds %d shapes" % len(shapes))
        return fold(key, shapes)

    monkeypatch.setattr(html_extract, "_fold", bounded)
    tags = ["div", "section", "ul", "table", "dl", "pre"]
    rows = [(k, "http://same.org/%d" % k, "<p>Slogan</p>" + "".join(f"<{tags[k // 6**j % 6]}>t{k}x{j}</{tags[k // 6**j % 6]}>" for j in range(4)))
            for k in range(400)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_extract.extract(df).collect()}
    assert got[77] == "t77x0\n\nt77x1\n\nt77x2\n\nt77x3" and len(got) == 400


def test_article_sections_with_names_of_topics():
    page = """<body><div class="social-links"><p>Follow</p></div><article><h2 id="related-work">Related</h2><section id="discussion"><p>Discussed</p>
    </section><p class="market-share">Share <span class="search-terms">found</span></p><div class="social-history"><p>History</p></div>
    <section id="legal"><p>Law</p></section><section class="search-methods"><p>Methods</p></section><div class="advert"><p>Buy</p></div>
    <div class="comments"><p>Reader</p></div><div class="nav"><p>Menu</p></div></article></body>"""
    assert [t for _, _, t in dom.parse(page)[1]] == ["Related", "Discussed", "Share found", "History", "Law", "Methods"]


def matched(a, b):
    """Simple tree matching by its definition."""
    def go(x, y):
        if a.labels[x] != b.labels[y]:
            return 0
        p, q = a.children[x], b.children[y]
        m = [[0] * (len(q) + 1) for _ in range(len(p) + 1)]
        for i in range(len(p)):
            for j in range(len(q)):
                m[i + 1][j + 1] = max(m[i][j + 1], m[i + 1][j], m[i][j] + go(p[i], q[j]))
        return 1 + m[-1][-1]
    return go(0, 0)


def test_tree_matching():
    shapes = ["#(a(b,c),d)", "#(a(c,b),x,d(e))", "#(d,a(b(c)),d)", "#", "#(a(b,b,c),a(b,c))"]
    trees = [dom.Tree.read(s) for s in shapes]
    for s, t in zip(shapes, trees):
        assert t.write() == s
        for u in trees:
            assert sum(x >= 0 for x in dom.align(t, u)) == matched(t, u)
            merged = dom.merge(t, u)
            assert all(x >= 0 for x in dom.align(merged, u))


def license_brute(rows, texts, threshold=80):
    """Every template against every window of every text, by sets of words."""
    split = [(name, family, license_scan.plain_words(text)) for name, family, text in texts]
    out = []
    for i, text in rows:
        words = license_scan.plain_words(text or "")
        good = []
        for t, (name, family, template) in enumerate(split):
            shingles = license_scan.text_shingles(template)
            unit, units = license_scan.window_of(len(template) - 4)
            span = unit * units + 4
            best = max(((len(shingles & license_scan.text_shingles(words[a:a + span])), -a) for a in range(0, len(words), unit)), default=(0, 0))
            if 100 * best[0] >= threshold * len(shingles):
                good.append((best[0] / len(shingles), best[0], best[1], t, name, family, len(shingles), -best[1], -best[1] + span))
        kept = []
        for g in sorted(good, reverse=True):
            beaten = any(g[5] == k[5] and g[4] != k[4] and g[0] < k[0] and g[7] < k[8] and k[7] < g[8] for k in kept)
            if not beaten and all(g[4] != k[4] for k in kept):
                kept.append(g)
        out += [(i or -1, k[4], k[1], k[6], k[7]) for k in kept]
    return sorted(out)


def test_licenses_against_brute_force(spark):
    """The query's operator: its own templates and some made ones, whole, edited, cut, repeated, over window borders."""
    from casebook.llm.licenses import LICENSES

    rng = np.random.default_rng(5)
    texts = [x for x in LICENSES if len(x[2]) < 3000] + [("five", "f", "just five words in here"), ("same", "f", "word " * 20),
                                                         ("sixty", "g", " ".join(f"u{k}" for k in range(60)))]
    noise = lambda n: [f"n{x}" for x in rng.integers(0, 900, int(n))]
    rows = [(1, None), (2, ""), (3, "Released under the MIT License."), (4, "x y\tRELEASED  under\nthe mit LICENSE. z"), (6, "Licensed under the"),
            (3, "Released under the MIT License."), (None, "Licensed under CC BY-NC 4.0."), (8, "Released under the MIT License. " * 3),
            (9, "word " * 500), (10, "five words in here just five words in here")]
    for k in range(160):
        words = license_scan.plain_words(texts[int(rng.integers(0, len(texts)))][2])
        for at in rng.integers(0, len(words), int(rng.integers(0, 1 + len(words) // 12))):
            words[at] = "edit"
        a = int(rng.integers(0, 1 + len(words) // 8))
        rows.append((100 + k, " ".join([*noise(rng.integers(0, 90)), *words[a:], *noise(rng.integers(0, 40))])))
    df = spark.createDataFrame([(i, t, "q") for i, t in rows], "doc_id long, text string, license string").repartition(3)
    got = sorted((r.doc_id or -1, r.license, r.matched, r.shingles, r.first_word) for r in license_scan.licenses(df, texts).collect())
    assert got == license_brute(rows, texts) and len({r[1] for r in got}) > 15 and len(got) > 100
    assert license_scan.licenses(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        license_scan._Licenses((("short", "s", "MIT License"),), 80, 1e-9)


def test_bands_keep_the_stated_chance():
    """A window that holds just enough of a template is missed with the stated chance at most; measured with a great one."""
    rng = np.random.default_rng(3)
    for shingles in (1, 2, 5, 12, 60, 700):
        unit, units = license_scan.window_of(shingles)
        assert unit * units >= shingles + unit - 1 and (unit == license_scan.BASE or 8 * unit <= shingles)
        held, span = -(-shingles * 80 // 100), unit * units
        similar = held / (shingles + span - held)
        assert (1 - similar) ** license_scan.bands_for(shingles, span) <= license_scan.MISS
        bands, missed = license_scan.bands_for(shingles, span, miss=0.05), 0
        odd = rng.integers(0, 1 << 63, bands, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        for _ in range(400):
            window = rng.integers(0, 1 << 63, span, dtype=np.uint64) * np.uint64(2)
            template = np.concatenate([window[:held], rng.integers(0, 1 << 63, shingles - held, dtype=np.uint64)])
            missed += not any((window * o).min() == (template * o).min() for o in odd)
        assert missed <= 400 * 0.05 + 4 * (400 * 0.05 * 0.95) ** 0.5


def test_license_texts(spark, tmp_path):
    from casebook.llm import queries
    from casebook.llm.licenses import LICENSES

    first, whole = {}, {}
    for name, _, text in LICENSES:
        (whole if len(text) > 5000 else first).setdefault(name, text)
    comment = lambda t: "\n".join(f" * {x}" for x in t.split("\n"))
    cases = [(first["Apache-2.0"].replace('"', "\u201c"), {"Apache-2.0"}), ("released under the MIT license and more", {"MIT"}),
             ("This is licensed under the GNU General Public License, version 2.", {"GPL-2.0"}), (comment(first["GPL-3.0"]), {"GPL-3.0"}),
             (first["LGPL-2.1"], {"LGPL-2.1"}), (first["MPL-2.0"], {"MPL-2.0"}), (first["BSD-2-Clause"], {"BSD-2-Clause"}),
             (first["BSD-3-Clause"], {"BSD-3-Clause"}), (first["MIT"] + " x " * 900 + first["GPL-2.0"], {"MIT", "GPL-2.0"}), ("nothing at all in here", set())]
    cases += [("start " * 700 + text + " end" * 300, {name}) for name, text in whole.items()]
    for lead in range(0, 800, 37):  # over window borders, with edits
        words = first["MIT"].split()
        words[20], words[90] = "Thing", "edited"
        cases.append(("w%d " % lead * lead + " ".join(words) + " tail" * 50, {"MIT"}))
    rows = [(k, t) for k, (t, _) in enumerate(cases)] + [(99, None), (98, "")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {}
    for r in queries.op4_license(spark, str(tmp_path)).collect():
        got.setdefault(r.doc_id, set()).add(r.license)
    assert {k: got.get(k, set()) for k, _ in rows} == {**{k: want for k, (_, want) in enumerate(cases)}, 98: set(), 99: set()}
