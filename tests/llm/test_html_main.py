import html
import math
import re
import time

import numpy as np
import pytest

from brindle.llm import html_main as hm


def text(source, low=frozenset()):
    return hm.Page(source).extract(low)


@pytest.mark.parametrize("source, want", [
    ("", ""), ("plain", "plain"), ("a &lt; b &amp c &#233;&nbsp;d", "a < b & c é d"),
    ("<nav>menu</nav><article><h1>T</h1><p>one<br>two <b>th</b>ree<p>four</article><footer>f</footer>", "T one two three four"),
    ("<article><p>a</p><div class='ad'>x</div><aside>y</aside><form>z</form><section class=\"reader-comments\"><p>c</p></section><p>b</p></article>", "a b"),
    ("<header><h1>Site</h1></header><main><header><h1>T</h1></header><p>x</p></main>", "T x"),
    ("<body class='has-sidebar'><div id=cookieNotice>ok?</div><p>t</p></body>", "t"),
    ("<article>a<script>var t='</p>'; if(a<b){}</script>b<style>p{}</style><!-- <p>c --> d</article>", "a b d"),
    ("<article><p>cut", "cut"), ("<article>1 < 2 <3</article>", "1 < 2 <3"), ("<ul><li>a<li>b</ul>", "a b"),
    ("<article><p title='>'>q</p></article>", "q"), ("<script>never closed", ""), ("<!-- never closed", ""),
    ("<article>x</b></p>y</article></div>z", "x y"), ("<article><ARTICLE class=comment>c</ARTICLE>d</article>", "d"),
])
def test_pages(source, want):
    assert text(source) == want


@pytest.mark.parametrize("source, want", [
    ('<article class="post comments-open"><p>Body</p></article>', "Body"), ('<form id="aspnetForm"><article><p>Body</p></article><input></form>', "Body"),
    ('<div class="post has-comments"><p>Body</p></div>', "Body"), ('<div class="top-story"><p>Body</p></div>', "Body"),
    ('<article><p>Body <span class="share-price">12</span></p></article>', "Body 12"), ('<div class="banner"><article>Body</article></div>', "Body"),
    ('<article>Body<div class="share-buttons">Share</div><div class="notice">n</div><div class="site-search-form">s</div></article>', "Body"),
    ('<section id="comments"><article><p>I say</p></article></section><article>Body</article>', "Body"), ('<main class="with-sidebar">Body<div class="sidebar-left">s</div></main>', "Body"),
    ("<form><p>name</p></form><p>t</p>", "t"), ("<p>a<b>b<div>c</b>d</div>e", "ab cd e"), ("<table><tr><td>a<td>b<tr><td>c</table>", "a b c"), ('<a title="x>y" href=">">q</a><a "b>c', 'qc'),
])
def test_shapes(source, want):
    assert " ".join(text(source).split()) == want


HOSTILE = {
    "unclosed tags": "<a " * 350_000, "quotes": "<a '\"" * 200_000 + ">", "one quote": "<a>" * 200_000 + "<a \">" + "<a>" * 100_000, "deep": "<div>" * 200_000 + "x", "deep texts": "<div>x. " * 100_000,
    "stray ends": "<div>" * 80_000 + "</p>" * 80_000 + "</section>" * 20_000, "svg": "<svg>" * 200_000, "lists": "<ul>" * 80_000 + "<li>" * 120_000, "inline": "<p>" + "<b>" * 120_000 + "<div>" * 80_000,
    "entities": "&amp" * 250_000, "article": "<article>" + "<div>x. " * 100_000, "comments": "<!--" * 250_000, "odd": "<!" * 500_000,
}


@pytest.mark.parametrize("name", HOSTILE)
def test_hostile_megabyte(name):
    """Seconds beside what a plain page of the size takes."""
    def took(source):
        began = time.perf_counter()
        page = hm.Page(source)
        list(page.style_nodes(0))
        page.extract({1})
        return time.perf_counter() - began

    assert took(HOSTILE[name]) < 4 * max(1.0, took("<article>" + "<p>a <b>word.</b></p>" * 50_000))


def site(rng):
    """A host's pages as trees of (tag, class, [text or tree, ...])."""
    fixed = [("div", f"fix{k}", [("p", "", [f"Same words {k}."])]) for k in range(3)]
    out = []
    for k in range(int(rng.integers(2, 9))):
        body = [("p", "", [f"Story {k} says {int(rng.integers(1e9))}."]) for _ in range(int(rng.integers(1, 4)))]
        kids = [("div", "story", body), *[f for f in fixed if rng.random() < 0.8], ("div", "rot", [f"Say {int(rng.integers(3))}"])]
        rng.shuffle(kids := list(kids))
        out.append(("body", "", kids))
    return out


def written(node):
    if isinstance(node, str):
        return node
    return f"<{node[0]}{f' class={node[1]}' * bool(node[1])}>{''.join(map(written, node[2]))}</{node[0]}>"


def by_hand(pages, low):
    """The merged tree of unmarked pages, entropies by plain counting, and the pages' texts without low branches."""
    stats = {}

    def walk(node, path, at):
        path = (*path, node[:2])
        here = at.setdefault(path, [[], []])
        here[0] += [x[0] for x in node[2] if not isinstance(x, str)]
        here[1].append(written(node))
        for x in node[2]:
            if not isinstance(x, str):
                walk(x, path, at)

    for page in {written(p): p for p in pages}.values():
        at = {}
        walk(page, (), at)
        for path, (shape, content) in at.items():
            stats.setdefault(path, []).append((tuple(dict.fromkeys(shape)), tuple(content)))

    def entropy(values):
        n = len(values)
        return sum(-c / n * math.log(c / n) for c in (values.count(v) for v in set(values)))

    importance = {p: 1.0 if len(v) < 2 else max(entropy([x[0] for x in v]), entropy([x[1] for x in v])) / math.log(len(v)) for p, v in stats.items()}

    def kept(node, path):
        path = (*path, node[:2])
        if importance[path] < low:
            return []
        return [y for x in node[2] for y in ([x] if isinstance(x, str) else kept(x, path))]

    return [" ".join(kept(p, ())) for p in pages]


@pytest.mark.parametrize("most", [0, 1000])
def test_tree_against_brute_force(spark, most):
    """Merge, entropy and removal over whole sites, against plain Python on the trees the pages were written from."""
    rng = np.random.default_rng(9)
    sites = {f"h{k}.org": site(rng) for k in range(25)}
    rows, want = [], {}
    for name, pages in sites.items():
        for k, (page, expected) in enumerate(zip(pages, by_hand(pages, hm.LOW))):
            rows.append((len(rows), f"http://{name}/{k}", written(page)))
            want[len(rows) - 1] = expected
    got = {r.page_id: r.text for r in hm.extract(spark.createDataFrame(rows, "page_id long, url string, html string"), broadcast_paths=most).collect()}
    assert got == want
    assert sum("Same words" in t for t in want.values()) < len(rows) / 2 < sum("Story" in t for t in want.values())


def test_long_and_odd():
    assert len(text("<article>" + "<p>word &amp; " * 50_000)) == 50_000 * 7 - 1
    text("<a '" * 20_000)
    text("<div>" * 3000 + "x")


def test_style_tree_removes_what_recurs(spark):
    page = lambda k, h: f"<div class=x><p>Always the same words</p></div><div class=y><p>Story {k} of {h}</p></div>"
    rows = [(k, f"http://h{h}.org/{k}", page(k, h), "x") for h in range(2) for k in range(12)]
    rows += [(99, "http://h0.org/dup", page(1, 0), "x")] * 20
    rows += [(100, None, None, "x"), (101, "http://h0.org/e", "", "x"), (None, None, page(5, 5), "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = hm.extract(pages).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.page_id is not None and r.page_id < 50:
            assert re.fullmatch(r"Story \d+ of \d", r.text), r
        assert r.n_chars == len(r.text)
    assert {r.text for r in got if r.page_id in (100, 101)} == {""}
    assert [r.text for r in got if r.page_id is None] == ["Always the same words Story 5 of 5"]
    assert hm.extract(pages.limit(0)).count() == 0


def test_sst_entropy_against_counts(spark):
    from collections import Counter

    rows = [(k, "http://a/x", f"<div class=z><i>{k % 3}</i></div><p>{k}</p>") for k in range(20)]
    got = {r.path: r for r in hm.style_trees(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    of = hm.Page(rows[0][2])
    div = of.paths[of.tags.index("div")]
    c = Counter(k % 3 for k in range(20))
    want = (math.log(20) - sum(n * math.log(n) for n in c.values()) / 20) / math.log(20)
    assert got[div].importance == pytest.approx(want) and got[div].n_pages == 20


def test_whole_table(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    for r in hm.extract(pages).join(pages.select("page_id", "html"), "page_id").collect():
        inner = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        assert r.text == " ".join(html.unescape(re.sub(r"</?(?:p|h1|br)>", "\n", inner).replace("<b>", "").replace("</b>", "")).split())


def test_style_tree_within_articles(spark):
    page = lambda k, body: f"<div class=ad>{k}</div><article><h1>Title {k % 9}</h1><p>{body}</p><div class=more><p>Read this as well.</p><p>And that.</p></div><p class=lead>End of {k % 9}.</p></article>"
    rows = [(k, "http://a.org/x", page(k, f"Story {k}. It has words of its own, {k * k} of them, and more than what stands below.")) for k in range(9)]
    rows += [(k, "http://a.org/x", page(k, "Story 3. It has words of its own, 9 of them, and more than what stands below.")) for k in range(12, 300, 9)]  # one article
    copies = [(1000 + k, "http://b.org/x", page(9 * k, "All say this. And this.")) for k in range(12)]
    half = [(2000 + k, "http://c.org/x", f"<main><p>{k}</p><div class=body>The same long text on all the pages.</div></main>") for k in range(12)]
    got = {r.page_id: r.text for r in hm.extract(spark.createDataFrame(rows + copies + half, "page_id long, url string, html string")).collect()}
    assert len(got) == len(rows + copies + half)
    for k, t in got.items():
        if k < 1000:
            assert t.startswith(f"Title {k % 9} Story") and t.endswith(f"below. End of {k % 9}."), t
        elif k < 2000:
            assert t == "Title 0 All say this. And this. Read this as well. And that. End of 0."
        else:
            assert t == f"{k - 2000} The same long text on all the pages."


@pytest.mark.parametrize("n", [1, 2, 3, 7, 8])
def test_small_hosts(spark, n):
    rows = [(k, "http://s.org/x", f"<div class=x>Home and more</div><div class=y>Story {k}</div><div class=z>Always the same</div>") for k in range(n)]
    got = [r.text for r in hm.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).orderBy("page_id").collect()]
    assert got == ([f"Story {k}" for k in range(n)] if n > 1 else ["Home and more Story 0 Always the same"])


BODY = "<p>Long real text of the article, which says something.</p>"


@pytest.mark.parametrize("name", ['class="content-sidebar-wrap"', 'class="container sidebar-right"', 'id="nav-layout"', 'class="modal-content"', 'class="signup-page"', 'id="related-work"', 'id="newsletter-archive"'])
@pytest.mark.parametrize("tag", ["article", "main"])
def test_wrappers_with_strong_names_hold_the_article(name, tag):
    page = f"<body><nav>Menu</nav><div {name}><div class=inner><{tag}>{BODY}<div class=comments>c</div></{tag}></div></div><footer>f</footer></body>"
    assert hm.Page(page).extract() == "Long real text of the article, which says something."


def test_strong_names_bind_where_the_article_is_elsewhere():
    cards = "<div class=related><article><p>A card.</p></article></div>"
    assert hm.Page(f"<body><article>{BODY}</article>{cards}</body>").extract() == "Long real text of the article, which says something."
    assert hm.Page(f"<body><div class=text>{BODY}</div>{cards}</body>").extract() == "Long real text of the article, which says something."
    assert hm.Page(f"<body><nav><article>{BODY}</article></nav><p>x</p></body>").extract() == "x"


@pytest.mark.parametrize("name,kept", [("promo-code", True), ("menu-plan", True), ("comment-on-law", True), ("ad-hoc", True), ("related-work", True), ("ad", False), ("ad-slot-2", False), ("related-posts", False), ("newsletter-signup", False), ("comment-body", False), ("sidebar-left", False)])
def test_names_within_articles(name, kept):
    assert hm.Page(f"<article><p>A</p><div class={name}>more</div></article>").extract() == ("A more" if kept else "A")
    assert hm.Page(f"<article><p>A</p></article><article class={name}>more</article>").extract() == ("A more" if kept or name in ("newsletter-signup", "sidebar-left") else "A")


def test_menus_within_articles_are_lists():
    assert hm.Page("<article><p>A</p><menu><li>one</menu></article>").extract() == "A one"
    assert hm.Page("<menu><li>Home</menu><article><p>A</p></article>").extract() == "A"


def test_the_longer_of_main_and_its_articles():
    assert hm.Page("<main><h1>T</h1><p>Long real text</p><article><p>related card</p></article></main>").extract() == "T Long real text related card"
    assert hm.Page("<main><p>Home</p><article><h1>T</h1><p>Long real text</p></article></main>").extract() == "T Long real text"
