"""Main text of web pages by site style trees.

The DOMs of a host's pages are merged: nodes whose paths (tag and class names from the root) agree are one node of the
host's style tree. Such a node has the presentations (sequences of child tags) and contents (own texts) seen in the pages it
stands in, and the importance of its branch is how evenly these spread: entropy over log of the number of pages, the larger
of the two, 1 where a single page has it. Menus, notices and the like look alike on every
page of a host and come out low; branches below LOW are removed from each page.

Two things entropy cannot tell are settled by what the page itself says, as priors of 0 before the tree is asked. A branch whose tag,
role or class names it as a menu, header, footer, sidebar, notice, advert, form or reader comment is noise, however
varied (adverts rotate); a class that tells a state (has-comments, comments-open) or names something else besides (share-price) is
no such name, and a form, or a branch that only looks like noise, is none if it holds the article. Where a page's only article lies below strong names
(content-sidebar-wrap), they are none if it is as long as the rest; within an article a name must consist of words of noise (promo-box, not promo-code), and
a menu element is a list. And where the page marks an article (article, else main; main, too, if it has more text besides its articles), only what lies in it is text. The tree
decides on the rest: on all branches of pages without a marked article, and on the branches within marked ones, where what
recurs on different articles goes. There copies must not pass for notices: a page counts for a branch by the
least hash of the article's sentences outside that branch, so copies count once, and near copies nearly always. And
the body is guarded: the article itself, inline tags, and headings, paragraphs, lists' items and table cells without class or
id stay, and where low branches hold more than half of an article, all of it stays.

Branches to remove come to the pages by a broadcast while they are at most BROADCAST_PATHS rows; beyond that each page's
own nodes look theirs up, so neither a hot host nor many of them gather anywhere. Reading a page takes time in proportion to its length, whatever it holds.

Text: character references decoded; white space within a block one space; blocks joined by one space in page order. Defined
cases: null or empty html and pages without text give ''; null url is a host of its own; a row for each input row; copies
of a page count once in the tree; other columns are not read. Unclosed and stray tags are taken as browsers do, roughly. Only counts
come to the driver.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle.llm.common import bounded_batches, column, stored, tidy

LOW = 0.35
BROADCAST_PATHS = 500_000  # a host's name and a number each: some 50 MB

# Fixed values of HTML: tags by kind.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title iframe noembed noframes xmp noscript template svg".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"tr", "td", "th", "thead"}}
ENDS_P = set("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
STOPS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "thead": {"table"}, "tbody": {"table"}}
BODY = INLINE | set("article main h1 h2 h3 h4 h5 h6 p pre blockquote figure figcaption li dt dd table caption thead tbody tfoot tr td th".split())
# What names noise. A class is noise by any part of STRONG, or if all its parts are of WEAK and PLACES and one of WEAK.
NOISE_TAGS = set("head nav footer aside menu dialog button select datalist object applet canvas audio video map".split()) | RAW
NOISE_ROLES = set("navigation banner contentinfo complementary alert alertdialog dialog menu menubar toolbar".split())
STRONG = set("""
ad ads adv advert adverts advertisement advertising adsense adslot adbox adsbygoogle sponsor sponsored sponsors promo promos promotion promoted
nav navbar navigation menu menus breadcrumb breadcrumbs pager pagination toolbar topbar masthead footer colophon copyright
sidebar sidebars related recommended recommendations cookie cookies consent gdpr newsletter paywall popup modal overlay signup login
searchbox comment comments commentlist disqus
""".split())
WEAK = set("""
banner banners foot aside widget widgets teaser teasers notice notices notification notifications alert alerts subscribe subscription form forms
search share sharing social respond reply replies
""".split())
PLACES = set("""
bar box button buttons link links list icon icons wrapper wrap container inner outer area block section panel row col column item items left right
main site page global primary secondary fixed sticky small large text content group message info count title heading label top bottom
""".split())
#: Within articles, what names of noise hold besides.
NOUNS = set("slot unit units post posts article articles story stories card cards reading news feed body thread author meta avatar date more read up sign reader readers user users latest popular featured our your".split())
ALL_NOISE = STRONG | WEAK | PLACES | NOUNS
OUTER_NAMES = {"header", "head", "top", "bottom"}  # weak, outside the article
ARTICLE_NOISE = {"comment", "comments", "reply", "replies", "teaser", "related", "ad", "ads", "advert", "promo", "sponsored"}
STATES, STATE_ENDS = {"has", "no", "with", "without", "is", "not", "hide", "show"}, {"open", "closed", "enabled", "disabled", "on", "off"}

_NAME = r"<(?P<close>/)?(?P<tag>[A-Za-z][^\s/>]*+)"
_NEVER = r"(?:(?!)(?P<comment>)(?P<odd>))?"  # so that every match has the same groups
_START = re.compile(r"<(?:/?(?P<tag>[A-Za-z])|!--(?P<comment>)|(?P<odd>[!?/]))")
_TAG = re.compile(_NAME + r"""(?P<attrs>(?:[^>"']++|"[^"]*+"|'[^']*+'|["'])*+)>""" + _NEVER)
_PLAIN = re.compile(_NAME + r"(?P<attrs>[^>]*+)>" + _NEVER)
_ATTR = re.compile(r"""(?P<name>class|id|role)\s*+=\s*+(?:"(?P<a>[^"]*+)"|'(?P<b>[^']*+)'|(?P<c>[^\s"'>]++))""", re.IGNORECASE)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")
_SENTENCE = re.compile(r"[.!?\u3002\uff01\uff1f]+")
_HOST = re.compile(r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)")


def host(url: str | None) -> str | None:
    if url is None:
        return None
    m = _HOST.match(url)
    return m[1].lower() if m else ""


class Page:
    """A page's nodes in order. text: (node, text) in page order, node -1 for the end of a block."""

    __slots__ = ("tags", "names", "parents", "paths", "noise", "inside", "text", "_own")

    def __init__(self, source: str):
        self.tags, self.names, self.parents, self.paths = ["#"], [""], [-1], [0]
        self._own, self.inside, self.text = [0], [False], []
        self._read(source)
        self.noise = self._noise()

    def _noise(self) -> list[bool]:
        """For each node, whether it or one above is named as noise; what only looks like it is not if it holds the article.

        A strong name binds where an article is marked elsewhere. Where all lie below such names (content-sidebar-wrap, modal-content), those above the
        longest are none, if that is as long as what the page has besides.
        """
        out = self._named_noise(frozenset())
        if any(t in ("article", "main") and not z for t, z in zip(self.tags, out, strict=True)):
            return out
        inner, rest = [0] * len(self.tags), 0
        for k, t in self.text:
            if k >= 0:
                size = len("".join(t.split()))
                inner[k] += size
                rest += 0 if out[k] else size
        hard = [False]  # below what no name excuses
        for k in range(1, len(self.tags)):
            hard.append(hard[self.parents[k]] or self._own[k] == 3)
        for k in range(len(self.tags) - 1, 0, -1):
            inner[self.parents[k]] += inner[k]
        best = max((k for k, t in enumerate(self.tags) if t in ("article", "main") and not self._own[k] and not hard[k]), key=lambda k: inner[k], default=0)
        if not best or inner[best] < rest or not inner[best]:
            return out
        above, k = set(), self.parents[best]
        while k > 0:
            if self._own[k] == 2:
                above.add(k)
            k = self.parents[k]
        return self._named_noise(above)

    def _named_noise(self, excused: frozenset[int] | set[int]) -> list[bool]:
        holds = [t in ("article", "main") and not z for t, z in zip(self.tags, self._own, strict=True)]
        for k in range(len(holds) - 1, 0, -1):
            if holds[k] and (self._own[k] < 2 or k in excused):
                holds[self.parents[k]] = True
        out = [False]
        for k in range(1, len(holds)):
            own = self._own[k]
            out.append(out[self.parents[k]] or (own > 1 and k not in excused) or (own == 1 and not holds[k]))
        return out

    def _open(self, tag: str, attrs: str, parent: int) -> int:
        names, role = "", ""
        if attrs and "=" in attrs:
            for m in _ATTR.finditer(attrs):
                value = entities.unescape(m["a"] or m["b"] or m["c"] or "")
                if m["name"].lower() == "role":
                    role = value.strip().lower()
                else:
                    names += " " + value
        inside = self.inside[parent] or tag in ("article", "main")
        listed = tag == "menu" and self.inside[parent]  # there a list like others
        own = 3 if (tag in NOISE_TAGS and not listed) or role in NOISE_ROLES or (tag == "header" and not self.inside[parent]) else 1 if tag == "form" or role in ("form", "search") else 0
        if names and own < 3 and tag not in ("html", "body", "main"):
            own = max(own, _named(names, tag, inside))
        self.tags.append(tag)
        self.names.append(names)
        self.parents.append(parent)
        self.paths.append(_hash(f"{tag} {names}", self.paths[parent]))
        self._own.append(own)
        self.inside.append(inside)
        return len(self.tags) - 1

    def _read(self, s: str) -> None:
        at, n = 0, len(s)
        tags, text = self.tags, self.text
        stack, where, blocks = [0], {}, []  # open nodes; their places by tag; the places of those that are not inline
        endless: set[str] = set()  # raw text that is not closed any more

        def last(names) -> int:
            """The place of the innermost open node of these tags, 0 if none."""
            return max((where[t][-1] for t in names if where.get(t)), default=0)

        def close(k: int) -> None:
            for node in stack[k:]:
                where[tags[node]].pop()
            del stack[k:]
            while blocks and blocks[-1] >= k:
                blocks.pop()

        tag_at = _tags(s)
        while at < n:
            m = tag_at(at)
            start = m.start() if m else n
            if start > at:
                text.append((stack[-1], s[at:start]))
            if m is None:
                return
            if m["comment"] is not None:
                end = s.find("-->", m.end())
                at = n if end < 0 else end + 3
                continue
            if m["odd"] is not None:
                end = s.find(">", m.end())
                at = n if end < 0 else end + 1
                continue
            at, tag = m.end(), m["tag"].lower()
            if tag not in INLINE:
                text.append((-1, ""))
            if m["close"]:
                k = last((tag,))
                if k and not (tag in INLINE | {"p", "li"} and last(("article", "main", "body")) > k):
                    close(k)
                continue
            if tag in ENDS_P and blocks and tags[stack[blocks[-1]]] == "p":
                close(blocks[-1])
            if tag in CLOSES:
                k = last(CLOSES[tag])
                if k > last(STOPS.get(tag, ())):
                    close(k)
            if tag in VOID:
                continue
            node = self._open(tag, m["attrs"], stack[-1])
            if tag in RAW and not m["attrs"].endswith("/"):
                end = None if tag in endless else re.compile(rf"</{re.escape(tag)}[\s/>]", re.IGNORECASE).search(s, at)
                if end is None:
                    if tag in ("script", "style", "textarea", "title"):
                        return
                    endless.add(tag)
                    continue
                closed = s.find(">", end.start())
                at = n if closed < 0 else closed + 1
                text.append((-1, ""))
                continue
            if not (m["attrs"].endswith("/") and tag == "svg"):
                where.setdefault(tag, []).append(len(stack))
                if tag not in INLINE:
                    blocks.append(len(stack))
                stack.append(node)

    def main(self) -> list[bool]:
        """For each node, whether it lies in the marked article; all true if none is marked. What a main has besides its articles is
        the article if it is longer than they are."""
        has = {t for t, z in zip(self.tags, self.noise, strict=True) if not z}
        if not has & {"article", "main"}:
            return [True] * len(self.tags)
        articles = self._below(lambda k: self.tags[k] == "article")
        if "main" not in has:
            return articles
        mains = self._below(lambda k: self.tags[k] == "main")
        if "article" not in has:
            return mains
        sizes = [0, 0]
        for k, t in self.text:
            if k >= 0 and mains[k] and not self.noise[k]:
                sizes[articles[k]] += len("".join(t.split()))
        return mains if sizes[0] > sizes[1] else articles

    def _below(self, of) -> list[bool]:
        out = [False]
        for k in range(1, len(self.tags)):
            out.append(out[self.parents[k]] or of(k))
        return out

    def marked(self) -> bool:
        return any(t in ("article", "main") and not z for t, z in zip(self.tags, self.noise, strict=True))

    def extract(self, low: set[int] = frozenset()) -> str:
        kept = self.main()
        removed = self._removed(kept, low) if low else None
        blocks, now = [], []
        for node, t in self.text:
            if node < 0:
                if now:
                    blocks.append("".join(now))
                    now = []
            elif kept[node] and not self.noise[node] and not (removed and removed[node]):
                now.append(t)
        blocks.append("".join(now))
        # a reference may stand across no tag, so each block is decoded whole
        return " ".join(filter(None, (" ".join(entities.unescape(b).split()) for b in blocks)))

    def _removed(self, kept: list[bool], low: set[int]) -> list[bool] | None:
        """For each node, whether the tree removes it; None for no node."""
        if not self.marked():
            return self._below(lambda k: self.paths[k] in low)
        out = self._below(lambda k: kept[k] and self.paths[k] in low and (self.tags[k] not in BODY or bool(self.names[k] and self.tags[k] not in INLINE | {"article", "main"})))
        if not any(out):
            return None
        sizes = [(out[k], len("".join(t.split()))) for k, t in self.text if k >= 0 and kept[k] and not self.noise[k]]
        return out if 2 * sum(n for z, n in sizes if z) <= sum(n for _, n in sizes) else None

    def _ends(self) -> list[int]:
        """For each node the last one below it, or itself: nodes are in page order, so a branch is a run of them."""
        out = list(range(len(self.tags)))
        for k in range(len(out) - 1, 0, -1):
            out[self.parents[k]] = max(out[self.parents[k]], out[k])
        return out

    def _others(self, kept: list[bool]) -> dict[int, int]:
        """For the paths within the marked article the least hash of a sentence of the article outside the path's branches, if any."""
        none = 1 << 64
        least = [none] * len(self.tags)
        for k, t in self.text:
            if k >= 0 and kept[k] and not self.noise[k]:
                for part in _SENTENCE.split(t):
                    words = " ".join(part.split())
                    if words:
                        least[k] = min(least[k], _hash(words) + (1 << 63))
        # least over any run of nodes: rows of runs of length 1, 2, 4, ...
        rows = [least]
        while 2 << len(rows) - 1 <= len(least):
            w, prev = 1 << len(rows) - 1, rows[-1]
            rows.append([min(prev[k], prev[k + w]) for k in range(len(prev) - w)])

        def within(a: int, b: int) -> int:
            if a >= b:
                return none
            j = (b - a).bit_length() - 1
            return min(rows[j][a], rows[j][b - (1 << j)])

        ends, runs = self._ends(), {}
        for k in range(1, len(self.tags)):
            if kept[k] and not self.noise[k]:
                runs.setdefault(self.paths[k], []).append((k, ends[k] + 1))
        found = {}
        for path, own in runs.items():
            at, low = 0, none
            for a, b in own:  # nodes of one path are equally deep: their branches do not overlap
                low, at = min(low, within(at, a)), b
            low = min(low, within(at, len(least)))
            if low < none:
                found[path] = low - (1 << 63)
        return found

    def _contents(self) -> dict[int, int]:
        """A hash of the text of each path's branches, of those that have any."""
        own = [0] * len(self.tags)
        for k, t in self.text:
            if k > 0 and not t.isspace():
                own[k] = _hash(t, own[k]) or 1
        # what a branch says is what its nodes say
        for k in range(len(own) - 1, 1, -1):
            up = self.parents[k]
            if own[k] and up > 0:
                own[up] = _hash(str(own[k]), own[up]) or 1
        out: dict[int, int] = {}
        for k in range(1, len(own)):
            if own[k]:
                out[self.paths[k]] = _hash(str(own[k]), out.get(self.paths[k], 0)) or 1
        return out

    def style_nodes(self, page: int) -> Iterator[tuple[int, int, int, int]]:
        """(page, path, presentation, content) hashes of the distinct paths that are not noise by name; page is what counts once."""
        kept = self.main()
        others = self._others(kept) if self.marked() else {}
        kids: dict[int, list[str]] = {}
        for k in range(1, len(self.tags)):
            kids.setdefault(self.paths[self.parents[k]], []).append(self.tags[k])
        words = self._contents()
        seen = set()
        for k in range(1, len(self.tags)):
            p = self.paths[k]
            if not self.noise[k] and p not in seen and (not self.inside[k] or p in others):
                seen.add(p)
                shape = " ".join(dict.fromkeys(kids.get(p, ())))
                yield others[p] if self.inside[k] else page, p, _hash(shape), words.get(p, 0)


def _hash(text: str, seed: int = 0) -> int:
    """64 bits, as a signed number."""
    h = xxhash.xxh64_intdigest(text.encode("utf-8", "replace"), seed & 0xFFFFFFFFFFFFFFFF)
    return h - (1 << 64) if h >> 63 else h


def _named(names: str, tag: str, inside: bool) -> int:
    """What classes and id say: 2 noise, 1 it may be, 0 nothing."""
    out = 0
    for token in names.split():
        parts = [p.lower() for p in _PART.findall(token)]
        if len(parts) > 1 and (parts[0] in STATES or parts[-1] in STATE_ENDS):
            continue
        own = set(parts)
        if tag == "article":
            out = 2 if own & ARTICLE_NOISE and own <= ALL_NOISE | {p for p in own if p.isdigit()} else out
        elif own & STRONG:
            # within an article a name that says something else besides (promo-code, menu-plan) is none
            if not inside or own <= ALL_NOISE | {p for p in own if p.isdigit()}:
                return 2
        else:
            weak = WEAK if inside else WEAK | OUTER_NAMES
            if own & weak and own <= weak | PLACES | {p for p in own if p.isdigit()}:
                out = max(out, 1)
    return out


def _tags(s: str):
    """From a place on the next tag; once a tag's quotes leave it without an end, quotes mean nothing any more, and where no > follows there are no tags."""
    plain = False
    stop = s.rfind(">")

    def find(at: int):
        nonlocal plain
        while True:
            m = _START.search(s, at)
            if m is None or m["tag"] is None:
                return m
            if m.start() > stop:
                return None
            if not plain:
                whole = _TAG.match(s, m.start())
                if whole:
                    return whole
                plain = True
            return _PLAIN.match(s, m.start())

    return find


def style_trees(pages: DataFrame) -> DataFrame:
    """host, path, n_pages, importance of every node of every host's style tree."""
    bounded_batches(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for url, source in zip(column(batch, "url"), column(batch, "html"), strict=True):
                if source:
                    h = host(url)
                    rows += [(h, *x) for x in Page(source).style_nodes(_hash(source))]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate([pa.string()] + [pa.int64()] * 4)], names=["host", "page", "path", "shape", "content"])

    nodes = pages.select("url", "html").mapInArrow(tidy(run), "host string, page long, path long, shape long, content long").distinct()
    one = nodes.groupBy("host", "path", "shape", "content").agg(F.count("*").alias("c"))

    def spread(of: str, name: str) -> DataFrame:
        by = one.groupBy("host", "path", of).agg(F.sum("c").alias("c"))
        return by.groupBy("host", "path").agg(F.sum("c").alias("n_pages"), (F.log(F.sum("c")) - F.sum(F.col("c") * F.log("c")) / F.sum("c")).alias(name))

    a, b = spread("shape", "h_shape"), spread("content", "h_content").drop("n_pages")
    both = a.join(b, a["host"].eqNullSafe(b["host"]) & (a["path"] == b["path"])).drop(b["host"]).drop(b["path"])
    even = F.greatest("h_shape", "h_content") / F.log("n_pages")
    return both.select("host", "path", "n_pages", F.when(F.col("n_pages") > 1, even).otherwise(1.0).alias("importance"))


def extract(pages: DataFrame, low: float = LOW, broadcast_paths: int = BROADCAST_PATHS) -> DataFrame:
    """page_id, url, text, n_chars for every row of pages (page_id, url, html)."""
    spark = pages.sparkSession
    removed = stored(style_trees(pages).where(F.col("importance") < low).select("host", "path"), "style")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    rows = _with_low(rows, removed, broadcast_paths)
    bounded_batches(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [Page(s).extract(set(p or ())) if s else "" for s, p in zip(column(batch, "html"), column(batch, "low"), strict=True)]
            own = [batch.column(batch.schema.get_field_index(c)) for c in ("page_id", "url")]
            yield pa.RecordBatch.from_arrays([*own, pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return rows.mapInArrow(tidy(run), "page_id long, url string, text string, n_chars long")


def _with_low(rows: DataFrame, removed: DataFrame, most: int) -> DataFrame:
    """rows (page_id, url, html) with low, the paths of removed (host, path) that their host has, or at least those of them that they have."""
    if removed.count() <= most:
        few = removed.groupBy(F.col("host").alias("_host")).agg(F.collect_set("path").alias("low"))
        url = F.lower(F.regexp_extract(F.col("url"), r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))
        return rows.join(F.broadcast(few), F.col("_host").eqNullSafe(url), "left").select("page_id", "url", "html", "low")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [(host(url), of, p) for url, source, of in zip(*(column(batch, c) for c in ("url", "html", "of")), strict=True) if source for p in set(Page(source).paths)]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate((pa.string(), pa.int64(), pa.int64()))], names=["host", "of", "path"])

    rows = rows.withColumn("of", F.xxhash64("url", "html"))
    own = rows.select("url", "html", "of").mapInArrow(tidy(run), "host string, of long, path long").distinct()
    own = own.join(removed.withColumnsRenamed({"host": "_h", "path": "_p"}), F.col("host").eqNullSafe(F.col("_h")) & (F.col("path") == F.col("_p")))
    own = own.groupBy(F.col("of").alias("_of")).agg(F.collect_set("path").alias("low"))
    return rows.join(own, F.col("of") == F.col("_of"), "left").select("page_id", "url", "html", "low")
