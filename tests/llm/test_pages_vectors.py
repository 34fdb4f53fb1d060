from __future__ import annotations

import itertools
import math

import numpy as np
import pytest

from acervo.llm import html_extract, topk_index, url_filter


def test_minimum_cut_equals_all_labellings():
    rng = np.random.default_rng(1)
    for _ in range(150):
        n = int(rng.integers(1, 9))
        odds = rng.normal(0, 1.2, n)
        edges = [(i, j, float(rng.random())) for i in range(n) for j in range(i) if rng.random() < 0.5]

        def cost(label):
            return sum(max(0, -o) if k else max(0, o) for o, k in zip(odds, label, strict=True)) + sum(w for i, j, w in edges if label[i] != label[j])  # noqa: B023

        assert cost(html_extract.minimum_cut(odds, edges)) == pytest.approx(min(map(cost, itertools.product([0, 1], repeat=n))))


PAGE = (
    "<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t='</p>';</script></head><body><nav><ul><li><a href='/a'>Menu</a></ul></nav>"
    "<!-- ad --><div class='ad'>Buy this now, it is cheap.</div><div id='cookie-notice'><p>We use cookies.</p></div><article><h1>Head &amp; title</h1>"
    "<p><b>First&nbsp;\n line<br>goes  on.<p>Second <i>one</i>two.</p><form><p>Sign up</p></form><div class='comments'><p>A reader wrote.</p></div><p>Third.</article>"
    "<aside>Related</aside><footer>&copy; me</footer></body></html>"
)


def test_main_text_of_a_page():
    assert html_extract.main_text(PAGE) == "Head & title\nFirst line goes on.\nSecond onetwo.\nThird."
    assert html_extract.main_text("<div class=menu>x</div><p>Text without a container.<p>More of it.") == "Text without a container.\nMore of it."
    assert html_extract.main_text("<nav>only</nav>") == html_extract.main_text("") == html_extract.main_text("<p title=\"open") == ""


@pytest.mark.parametrize(
    ("inside", "want"),
    [
        ("<svg viewBox='0 0 1 1'/>One", "One"), ("<svg><title/><path d='M0'/></svg>One", "One"), ("<math/>One", "One"), ("<object data='x'>One", "One"),
        ("One <math><mi>x</mi>=<mn>2</mn></math>", "One x=2"), ("<object data='x'>Fallback</object> one", "Fallback one"), ("<title-card>Card</title-card> one", "Card one"),
        ("<script>no</script >One", "One"), ("<svg><style>no</style></svg>One", "One"),
    ],
)
def test_only_raw_text_elements_are_skipped(inside, want):
    assert html_extract.main_text(f"<article><p>{inside}</p><p>Two.</p></article>") == f"{want}\nTwo."


@pytest.mark.parametrize(
    "around",
    [
        "<article style='overflow:hidden'>{}</article>", "<main aria-hidden='false'>{}</main>", "<article title='The hidden cost'>{}</article>",
        "<div class='layout has-sidebar'><article>{}</article></div>", "<form action=/x><main>{}</main></form>", "<div class='no-share'>{}</div>",
        "<div class='header-fixed'><div id='content'>{}</div></div>", "<div data-x='class=menu'>{}</div>", "<div class=sidebar><article>{}</article></div>",
        "<form id=aspnet><nav>Menu</nav><div>{}</div></form>", "<body class='with-sidebar'><div class='search'>{}</div><footer>x</footer></body>",
    ],
)
def test_layout_names_do_not_hide_an_article(around):
    text = "<p>The article text, with words.</p><p>More of it, too.</p>"
    assert html_extract.main_text(around.format(text)) == "The article text, with words.\nMore of it, too."


@pytest.mark.parametrize(
    "extra",
    [
        "<div class='comments'><article class='comment'>A reader says, of course, much.</article></div>", "<div hidden><p>Not shown, at all, here.</p></div>",
        "<p aria-hidden=true>Not for readers.</p>", "<div style='display: none'>Nothing of it.</div>", "<ul class='comment-list'><li>First!</li></ul>",
        "<aside><article>Elsewhere on this site.</article></aside>", "<div id=cookie-banner>We use cookies</div>",
    ],
)
def test_what_is_no_article_stays_out(extra):
    assert html_extract.main_text(f"<article><p>The article text, with words.</p><p>More of it, too.</p></article>{extra}") == "The article text, with words.\nMore of it, too."


def test_text_and_neighbours_outweigh_a_hint():
    """No hint is as strong as text and edges together; certainty is."""
    most = html_extract.TEXT_LIMIT + 2 * html_extract.ADJACENT + 2 * html_extract.SIBLING
    assert abs(html_extract.OUTSIDE) < most and html_extract.INSIDE < most < abs(html_extract.CERTAIN)


def test_extract_odd_pages(spark):
    schema = "page_id long, url string, html string, text string, n_chars string"
    many = "<article>" + "<p>word &lt;b&gt;</p>" * 5000 + "</article>"
    rows = [(1, "u", PAGE, "x", "y"), (1, "u", PAGE, "x", "y"), (None, None, None, None, None), (2, None, "", "", ""), (3, "v", many, "x", "y"), (4, "w", "<" * 3000, "x", "y")]
    pages = spark.createDataFrame(rows, schema)
    got = html_extract.extract(pages).collect()
    assert len(got) == 6 and all(r.n_chars == len(r.text) for r in got)
    assert [r.text for r in got if r.page_id == 3] == ["\n".join(["word <b>"] * 5000)] and len({r.text for r in got if r.page_id == 1}) == 1
    assert html_extract.extract(pages.limit(0)).count() == 0


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    tail = rest[cut:]
    end = min((tail.find(c) for c in "?#" if c in tail), default=len(tail))
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut]), tail[:end]


def plain_rule(host, path):
    fits = []
    for verdict, rule in url_filter.RULES:
        name, _, rest = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + rest):
            fits.append((len(rule), rule, verdict))
    return max(fits)[1:] if fits else (None, None)


def test_urls_and_rules(spark):
    urls = [
        None, "", "no scheme", "http://A.Example.ORG/es/1?x", "x://example.org", "x://example.org/", "y://b.example.org/en/12#t", "http://com/fr/", "http://a.com/de/x", "http://acom/de/",
        "http://É.com/fr/a://b", "http://h?q=/a/b", "http://h#/a", "http://a.net/1/22/abc12345/x", "a\nb://c.com/de/\n", "http://a.net/" + "s/" * 300,
    ]
    rows = [(i, u, "x", "y", 1) for i, u in enumerate(urls)] + [(3, urls[3], "x", "y", 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, template string, n int")
    got = url_filter.judge_urls(pages).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.host, r.path) == plain_parts(urls[r.page_id])
        rule, verdict = plain_rule(r.host, r.path)
        assert r.rule == rule and (verdict in (None, r.verdict)) and r.verdict in ("allow", "block")
    assert url_filter.judge_urls(pages.limit(0)).count() == 0


def test_merged_branches_share_what_is_below_them(spark):
    """Sixty users, each with news and spam: one template and one verdict for all spam, also under a user without labels."""
    rows = [("h.com", [f"user{u}", kind, "*"], "block" if kind == "spam" else "allow") for u in range(60) for kind in ("news", "spam") for _ in range(2)]
    rows += [("h.com", ["stranger", kind, "*"], None) for kind in ("news", "spam")]
    frame = spark.createDataFrame(rows, "host string, segments array<string>, verdict string")
    found = {tuple(r.segments[:2]): (r.template, r.purity) for r in url_filter.judge_templates(frame).collect()}
    assert len(found) == 122 and {k[1]: v[0] for k, v in found.items()} == {"news": "h.com/*/news/*", "spam": "h.com/*/spam/*"}
    assert len(set(found.values())) == 2
    assert all((p >= url_filter.REJECT) == (k[1] == "spam") for k, (_, p) in found.items())


def test_a_template_of_blocked_pages_is_rejected(spark):
    rules = (("block", "a.com/bad/1"), ("allow", "a.com/good/1"))
    urls = [f"http://a.com/bad/{n}" for n in [*range(100, 140), *range(200, 220)]] + [f"http://a.com/good/{n}" for n in [*range(100, 140), *range(200, 220)]] + ["http://b.com/x"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {urls[r.page_id]: (r.verdict, r.template) for r in url_filter.judge_urls(pages, rules).collect()}
    assert got["http://a.com/bad/205"] == ("block", "a.com/bad/*") and got["http://a.com/good/205"] == ("allow", "a.com/good/*")
    assert got["http://b.com/x"] == ("allow", "b.com/*")


def plain_top(rows, every, k, kind=np.float32):
    good = []
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            good.append((i, [math.floor(1024 * float(kind(x))) for x in v]))
    out = []
    for q, a in {(i, tuple(v)) for i, v in good if i % every == 0}:
        best = sorted((-max(-(2**63), min(2**63 - 1, sum(x * y for x, y in zip(a, b, strict=True)))), i) for i, b in good if i != q and len(a) == len(b))[:k]
        out += [(q, n, i, -s) for n, (s, i) in enumerate(best, 1)]
    return sorted(out)


def found(df, **kw):
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in topk_index.top_k(df, **kw).collect())


def test_top_k_equals_all_pairs(spark, monkeypatch):
    for name, value in (("ANNULUS", 20), ("ANNULI", 4), ("SLICE", 16), ("BLOCK", 8), ("TILE", 8), ("PIVOTS", 5)):
        monkeypatch.setattr(topk_index, name, value)
    rng = np.random.default_rng(0)
    centre = rng.normal(0, 1, (6, 12))
    rows = [(i, [float(x) for x in centre[i % 6] * rng.choice([0.2, 1, 4]) + rng.normal(0, 0.2, 12)]) for i in range(300)]
    rows += [(i, rows[5][1]) for i in range(1000, 1080)] + [(2000, [0.0] * 12)]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<float>, label int, score string")
    assert found(df, every=20, k=7) == plain_top(rows, 20, 7)


def test_a_repeated_id_is_one_vector_of_the_sample(spark):
    rows = [(i, [float(i % 7), float(i % 5), 1.0]) for i in range(40)]
    make = lambda some: topk_index.whole_vectors(spark.createDataFrame(some, "vec_id long, embedding array<double>"))
    one, many = topk_index.choose_pivots(make(rows)), topk_index.choose_pivots(make(rows + rows[3:4] * 500))
    assert one.keys() == many.keys() and all((one[n] == many[n]).all() for n in one)


def test_top_k_of_odd_rows(spark):
    rows = [
        (0, [1.0, 2.0]), (100, None), (200, [1.0, None]), (300, [float("nan"), 1.0]), (400, [float("inf"), 1.0]), (None, [1.0, 1.0]), (500, [1.0, 2.0]), (500, [1.0, 2.0]),
        (1, [1.0, 2.0]), (2, [-3.0, 0.5]), (3, [9.0]), (600, [9.0]), (700, []), (4, []), (800, [1e15, 1e15]), (5, [2e15, -1e15]), (900, [1.0, 2.0, 3.0]),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = found(df)
    assert got == plain_top(rows, 100, 10, float)
    assert [r for r in got if r[0] == 600] == [(600, 1, 3, 9216 * 9216)] and [r[2] for r in got if r[0] == 700] == [4]
    assert not [r for r in got if r[0] in (100, 200, 300, 400, 900)]
    assert [r[3] for r in got if r[0] == 800][0] == 2**63 - 1
    assert found(df.limit(0)) == []
