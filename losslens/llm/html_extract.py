"""Main text of web pages by paths that a host's pages agree on.

1. Each page is read into containers and text blocks.  What can't be article
   text is never recorded: scripts, styles, forms, menus, asides, page
   headers and footers.  A block counts for its container with its length
   less its link text, and by half for each container further up (to a box of
   4. at most).
2. Containers vote with their share of the page's score for their path: tags
   and classes from the root, with digits generalised.  Votes are summed per
   host and path in Spark; a hot host is pre-aggregated in every task.
3. A host's paths with at least ``MIN_SHARE`` of the best one's votes win, in
   order of votes; its parts are the paths that hold as much of the text
   directly.  Each page is read again with the first winning path that it has
   text under, the article (else main) around it, and all its parts but those
   of other articles; a part above the winner gives its own blocks alone.  A
   page with none of the winning paths uses its own best container and parts.
   The hosts' paths are measured: up to ``PATH_BYTES`` they are broadcast and
   no page moves, beyond that each host's pages are salted over ``SALTS`` tasks.
4. A box whose class, id or role says advert, notice, sidebar, comment and the
   like counts for less (``PENALTY``) and has paths of its own.  It is read
   where its path wins; within the article also where it is a part, unless
   it's for comments.  Such words mean nothing beside ``STATES`` and on body,
   main, headings and paragraphs, and on an article only lower its score,
   unless it's a comment in another article.

White space inside a block becomes one blank, blocks are joined by line feeds.

Defined cases: null or empty html gives an empty text; null urls and urls
without a host vote together; a page without markup is one block; unclosed
and misnested tags close with their parents; repeated rows each get a row;
an empty table gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

import html as html_entities
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from losslens.llm.common import checkpoint

MIN_SHARE = 0.1
PATH_BYTES = 32 << 20  # of all hosts' paths, up to which they are broadcast
SALTS = 64
PENALTY = {"": 1.0, "other": 0.5, "comments": 0.02}

# fixed values: element names of HTML by what they mean for the text
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "noembed", "noframes", "xmp"}
SKIPPED = {"head", "nav", "aside", "form", "footer", "menu", "dialog", "button", "select", "svg", "canvas", "object",
           "audio", "video", "map", "fieldset", "math"}
BLOCKS = {"html", "body", "article", "section", "main", "div", "header", "p", "h1", "h2", "h3", "h4", "h5", "h6",
          "ul", "ol", "li", "dl", "dt", "dd", "table", "thead", "tbody", "tfoot", "tr", "td", "th", "caption",
          "blockquote", "pre", "figure", "figcaption", "address", "hgroup", "details", "summary", "center"} | SKIPPED
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
CONTAINERS = {"body", "article", "section", "main", "div", "td"}
#: a start tag closes these open ones on top of the stack
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th"}, "th": {"td", "th"},
          "tr": {"td", "th", "tr"}}
#: class, id and role don't tell what these hold
PLAIN = {"html", "body", "main", "p", "h1", "h2", "h3", "h4", "h5", "h6"}
# fixed values: words of class, id and role that mark what is hardly the article
COMMENTS = {"comment", "comments", "commentlist", "disqus", "replies", "reply", "respond", "responses"}
OTHER = {"ad", "ads", "adv", "advert", "adverts", "advertisement", "adsense", "adbox", "banner", "breadcrumb",
         "breadcrumbs", "consent", "cookie", "cookies", "footer", "gdpr", "masthead", "menu", "modal", "nav", "navbar",
         "navigation", "newsletter", "notice", "notices", "notification", "pager", "pagination", "popup", "promo",
         "promoted", "related", "search", "share", "sharing", "sidebar", "skip", "social", "sponsor", "sponsored",
         "subscribe", "toolbar", "topbar", "widget", "widgets", "alert", "contentinfo", "complementary", "paywall"}

#: class names with one of these tell of a state, as in comments-open, ad-free, page-with-sidebar
STATES = {"open", "closed", "has", "no", "with", "without", "free", "off"}

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>", re.S)
_ATTR = re.compile(r"(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_WORDS = re.compile(r"[a-z]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Page:
    """Containers (path, parent) and blocks (container, text, link characters)."""

    def __init__(self, source: str):
        self.path, self.parent, self.blocks = ["html"], [-1], []
        self.tag, self.kind, self.starts, self.worth = ["html"], [""], [False], [1.0]  # of each container
        self.text, self.links = [], 0
        self.stack: list[tuple[str, int, bool]] = []  # tag, container, whether it is skipped
        self._read(source)
        self._flush()

    @property
    def _skips(self) -> bool:
        return bool(self.stack) and self.stack[-1][2]

    def _read(self, source: str) -> None:
        at, link, end = 0, False, len(source)
        while at < end:
            m = _TAG.search(source, at)
            self._add(source[at:m.start() if m else end], link)
            if not m:
                break
            at, tag = m.end(), (m[2] or "").lower()
            if not tag:
                continue
            if m[1]:
                if tag == "a":
                    link = False
                elif tag in BLOCKS:
                    self._close(tag)
            elif tag in RAW and not m[3].endswith("/"):
                close = re.compile(f"</{tag}\\b[^>]*>", re.I).search(source, at)
                at = close.end() if close else end
            elif tag == "a":
                link = True
            elif tag in ("br", "hr"):
                self._flush() if tag == "hr" else self._add(" ", link)
            elif tag in BLOCKS:
                self._open(tag, m[3])

    def _add(self, text: str, link: bool) -> None:
        if text and not self._skips:
            text = html_entities.unescape(text) if "&" in text else text
            self.text.append(text)
            self.links += len(text) * link

    def _flush(self) -> None:
        if self.text:
            text = " ".join("".join(self.text).split())
            if text:
                self.blocks.append((self.stack[-1][1] if self.stack else 0, text, self.links))
            self.text, self.links = [], 0

    def _open(self, tag: str, attributes: str) -> None:
        self._flush()
        if self.stack and self.stack[-1][0] == "p":
            self.stack.pop()
        while self.stack and self.stack[-1][0] in CLOSES.get(tag, ()):
            self.stack.pop()
        classes, words, hidden = "", set(), False
        if attributes.strip():
            for name, *values in _ATTR.findall(attributes):
                name, value = name.lower(), next(filter(None, values), "").lower()
                if name == "class":
                    classes = value
                if name == "style":
                    hidden |= bool(_HIDDEN.search(value))
                elif name == "hidden" or name == "aria-hidden" and value == "true":
                    hidden = True
                else:
                    for found in map(set, map(_WORDS.findall, value.split())):
                        words |= found if not found & STATES else set()
        skips, inside = self._skips, [s[0] for s in self.stack]
        skips = skips or hidden or tag in SKIPPED or (
            tag == "header" and "article" not in inside and "main" not in inside)
        container = self.stack[-1][1] if self.stack else 0
        said = "" if tag in PLAIN else "comments" if words & COMMENTS else "other" if words & OTHER else ""
        starts = bool(said) and (tag != "article" or said == "comments" and "article" in inside)
        if not skips and (tag in CONTAINERS or starts):
            kind = self.kind[container]
            if tag in ("article", "main") and kind == "other" and not words & OTHER:
                kind = ""  # an article may lie in a box named after its sidebar
            if starts and kind != "comments":
                kind = said
            name = ".".join([tag, *sorted({re.sub(r"\d+", "#", c) for c in classes.split()})])
            self.path.append(f"{self.path[container]}/{name}" + ("!" + ".".join(sorted(words)) if starts else ""))
            self.parent.append(container)
            self.tag.append(tag)
            self.kind.append(kind)
            self.starts.append(starts)
            if tag in ("article", "main") or starts:
                self.worth.append(PENALTY[kind or said and "other"])
            else:
                self.worth.append(self.worth[container])
            container = len(self.path) - 1
        self.stack.append((tag, container, skips))

    def _close(self, tag: str) -> None:
        self._flush()
        tags = [s[0] for s in self.stack]
        if tag in tags:
            del self.stack[len(tags) - 1 - tags[::-1].index(tag):]

    def own(self) -> dict[int, float]:
        """Score of each container's own blocks."""
        score = defaultdict(float)
        for container, text, links in self.blocks:
            score[container] += max(0, len(text) - links) * self.worth[container]
        return score

    def scores(self) -> dict[int, float]:
        score = defaultdict(float)
        for container, worth in self.own().items():
            score[container] += worth
            while not self.starts[container] and self.parent[container] >= 0:
                container, worth = self.parent[container], worth / 2
                score[container] += worth
        return score

    def parts(self) -> set[str]:
        """Paths that hold much of this page's text directly."""
        votes = defaultdict(float)
        for c, v in self.own().items():
            votes[self.path[c]] += v
        best = max(votes.values(), default=0)
        return {p for p, v in votes.items() if v > 0 and v >= best * MIN_SHARE}

    def text_of(self, base: set[int], parts: set[str]) -> str:
        """Blocks of the article that these containers belong to."""
        article, main = [-1] * len(self.path), [-1] * len(self.path)
        for c, tag in enumerate(self.tag):  # parents come first
            if c:
                article[c] = c if tag == "article" else article[self.parent[c]]
                main[c] = c if tag == "main" else main[self.parent[c]]
        around = {article[c] if article[c] >= 0 else main[c] for c in base if self.kind[c] != "comments"}
        roots, own_articles, above = base | around - {-1}, {article[c] for c in base}, set()
        for c in roots:
            while (c := self.parent[c]) >= 0:
                above.add(c)
        under, near = [False] * len(self.path), [False] * len(self.path)  # near: not just under body
        take = [0] * len(self.path)  # 1 own blocks, 2 those below too
        for c, path in enumerate(self.path):
            up = self.parent[c]
            under[c] = c in roots or up >= 0 and under[up]
            near[c] = c in roots and self.tag[c] not in ("html", "body") or up >= 0 and near[up]
            if c in roots or up >= 0 and take[up] == 2 and not self.starts[c]:
                take[c] = 2
            elif not self.kind[c]:
                if under[c]:
                    take[c] = 2
                elif path in parts and (article[c] < 0 or article[c] in own_articles or -1 in own_articles):
                    take[c] = 1 if c in above else 2
            elif self.kind[c] == "other" and near[c] and path in parts:
                take[c] = 2
        return "\n".join(text for c, text, _ in self.blocks if take[c])


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        votes, owns = defaultdict(float), defaultdict(float)
        for host, source in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
            page = Page(source or "")
            for score, sums in ((page.scores(), votes), (page.own(), owns)):
                total = sum(score.values())
                for container, s in score.items():
                    if s > 0:
                        sums[host, page.path[container]] += s / total
        keys = list(votes)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()),
             pa.array(list(votes.values()), pa.float64()), pa.array([owns.get(k, 0.0) for k in keys], pa.float64())],
            ["host", "path", "votes", "own"])


def extract(source: str, winners: list[str], parts: list[str] = ()) -> tuple[str, str | None]:
    """(text, path it lies under) of one page by its host's winning paths and parts."""
    page, parts = Page(source), set(parts)
    for path in winners:
        base = {c for c, p in enumerate(page.path) if p == path}
        text = page.text_of(base, parts) if base else ""
        if text:
            return text, path
    score = page.scores()
    if not score:
        return "", None
    best = max(score, key=lambda c: (score[c], -c))
    return page.text_of({best}, page.parts()), page.path[best]


def host_of(url: str):
    return F.regexp_extract(F.lower(F.coalesce(F.col(url), F.lit(""))),
                            r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)


def host_paths(pages: DataFrame, url_col: str = "url", html_col: str = "html",
               min_share: float = MIN_SHARE) -> DataFrame:
    """(host, paths, parts): the winning paths of each host, best first, and its parts."""
    votes = (pages.select(host_of(url_col).alias("host"), F.col(html_col).alias("html"))
             .mapInArrow(_votes, "host string, path string, votes double, own double").groupBy("host", "path")
             .agg(*[F.sum(F.round(c, 6).cast("decimal(28,6)")).alias(c) for c in ("votes", "own")]))
    best = votes.groupBy("host").agg(F.max("votes").alias("best"), F.max("own").alias("best_own"))
    wins, part = F.col("votes") >= F.col("best") * min_share, F.col("own") >= F.greatest(F.col("best_own") * min_share, F.lit(1e-6))
    return (votes.join(best, "host").where(wins | part).groupBy("host")
            .agg(F.sort_array(F.collect_list(F.when(wins, F.struct((-F.col("votes")).alias("v"), "path")))).alias("p"),
                 F.sort_array(F.collect_list(F.when(part, F.col("path")))).alias("parts"))
            .select("host", F.col("p.path").alias("paths"), "parts"))


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, path) of every page."""
    def read(sources: pa.Array, winners: pa.Array, parts: pa.Array) -> pa.Array:
        out = [extract(s or "", w or [], p or [])
               for s, w, p in zip(sources.to_pylist(), winners.to_pylist(), parts.to_pylist())]
        return pa.StructArray.from_arrays([pa.array([t for t, _ in out], pa.string()),
                                           pa.array([p for _, p in out], pa.string())], ["text", "path"])

    own = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"),
                       host_of(url_col).alias("host"))
    paths = checkpoint(host_paths(pages, url_col, html_col))
    letters = "aggregate({0}, 0L, (a, p) -> a + length(p) + 16)"
    size = paths.agg(F.sum(F.expr(f"64 + length(host) + {letters.format('paths')} + {letters.format('parts')}"))).first()[0] or 0
    if size <= PATH_BYTES:
        paths = F.broadcast(paths)
    else:  # a host's pages go to many tasks
        paths = paths.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        own = own.withColumn("salt", F.pmod(F.xxhash64("url", "page_id"), F.lit(SALTS)).cast("int"))
    reader = F.arrow_udf(read, "struct<text:string,path:string>")
    return (own.join(paths, [c for c in ("host", "salt") if c in own.columns], "left")
            .withColumn("r", reader("html", "paths", "parts")).select("page_id", "url", "r.text", "r.path"))
