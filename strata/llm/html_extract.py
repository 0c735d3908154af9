"""Main text of web pages by consensus paths per host (operator 5).

1. Each page is parsed and its containers are scored: every text block gives
   its length, less its links, to its parent and half of that to its
   grandparent; article-like containers weigh more. Menus, headers, footers,
   sidebars, notices, adverts, forms, scripts, styles and comments are left out
   by tag, role, and class or id names of boilerplate words only. A subtree with
   such a name that holds over half of the page's unlinked text stays, at half
   its score, unless an article element stands apart from it.
2. The best containers vote for their generalised path: tags with their class
   names from the root, digits removed. Votes are summed per host in Spark
   (partial sums per task, so a host with a third of all pages is one row per
   path and task).
3. Each page is parsed again and the text is taken from the elements at the
   host's best path that the page has, unless that holds less than half of what
   the page's own best container holds (an odd page of its host).
4. From there it climbs to the enclosing article (else main), or without one
   through ancestors below the body that are named like content, hold
   paragraphs or headings of their own or several elements of one label, so
   that titles, leads and sibling sections stay.

Text: character references decoded, inline markup dropped, white space inside
a block turned into one space, blocks joined in page order by one space.

Rows: a null or empty html has an empty text. A null or odd url belongs to the
host ``''``. Repeated pages vote and extract alike. Unclosed and misnested tags
are closed as browsers do for paragraphs and list items; other end tags without
a start are ignored. Only ``page_id``, ``url`` and ``html`` are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import stage, table
from strata.operators.joins import sized_broadcast

#: Containers per page that vote, and paths per host that pages try in turn.
VOTES, PATHS = 3, 5
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby "
    "s samp small span strike strong sub sup time tt u var wbr img".split())
CONTAINERS = frozenset("article main section div td body center".split())
GOOD_TAGS = frozenset("article main".split())
#: Subtrees that never hold text.
DROPPED = frozenset(
    "script style noscript template svg math iframe object canvas audio video head title "
    "button select option textarea input".split())
#: Subtrees without main text, unless they hold most of the page's.
ASIDE = frozenset("nav footer aside form dialog menu header".split())
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar "
                          "dialog alert alertdialog".split())
DROPPED_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored sponsors promo "
    "promotion banner cookie cookies consent gdpr notice notices disclaimer newsletter subscribe "
    "subscription signup login share sharing social related recommended recommendations sidebar "
    "sidebars menu menus nav navbar navigation breadcrumb breadcrumbs footer masthead topbar toolbar "
    "comment comments commentlist disqus respond reply replies popup modal overlay widget widgets "
    "pagination pager skip hidden".split())
#: Words that say nothing about a name's other words. A name marks boilerplate when
#: it consists of these and ``DROPPED_WORDS``; any other word ("related-work") leaves it open.
FRAME_WORDS = frozenset(
    "site page post posts article articles story stories entry entries main top bottom left right center "
    "middle inner outer upper lower box boxes block blocks wrap wrapper container content area areas "
    "section sections list lists item items bar bars link links button buttons btn panel pane form "
    "title heading head header body text row col column columns group unit units slot slots space frame "
    "label icon icons media first second third primary secondary global mobile desktop small large big "
    "fixed sticky to for on and the more your our user users reader thread count meta info message "
    "policy email mail facebook twitter google image images img video print js".split())
#: Words that mark a name whatever else it says, and words that do with a frame word.
STRONG_WORDS = frozenset("comments commentlist disqus ad ads advert adverts advertisement adsense sponsored".split())
BANNER_WORDS = frozenset("cookie cookies consent gdpr newsletter".split())
GOOD_WORDS = frozenset("article content post story entry main text body".split())
#: Blocks that make their parent part of the article.
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre".split())
STATES = frozenset("has with no is without".split())
ENDED_BY_BLOCK = frozenset("p h1 h2 h3 h4 h5 h6".split())
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
            "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
FENCES = frozenset("ul ol dl table article main section div body html td th".split())


class Node:
    __slots__ = ("tag", "label", "words", "parent", "parts", "dropped", "suspect", "score", "in_article")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None):
        self.tag, self.parent, self.parts, self.score = tag, parent, [], 0.0
        self.in_article = bool(parent and (parent.in_article or parent.tag in GOOD_TAGS))
        names = attrs.get("class", "")
        self.words = _words(f"{names} {attrs.get('id', '')}") if names or "id" in attrs else ()
        classes = sorted({c for c in re.sub(r"[0-9]+", "", names.lower()).split() if c})
        self.label = ".".join([tag, *classes])
        self.suspect = False
        self.dropped = bool(parent and parent.dropped) or self._boilerplate(attrs)

    def _boilerplate(self, attrs: dict[str, str]) -> bool:
        if self.tag in DROPPED or "hidden" in attrs or attrs.get("aria-hidden") == "true":
            return True
        if "display:none" in attrs.get("style", "").replace(" ", "").lower() and self.tag not in ("html", "body"):
            return True
        if self.tag in GOOD_TAGS and not self.in_article or self.tag in ("html", "body"):
            return False
        if self.tag in ASIDE and not (self.tag == "header" and self.in_article) \
                or attrs.get("role", "").lower() in DROPPED_ROLES:
            self.suspect = True
            return False
        if self.words and not DROPPED_WORDS.isdisjoint(self.words):
            self.suspect = any(map(_marks_boilerplate, f"{attrs.get('class', '')} {attrs.get('id', '')}".split()))
        return False

    def path(self) -> str:
        labels, node = [], self
        while node.parent:
            labels.append(node.label)
            node = node.parent
        return "/".join(reversed(labels))


def _words(names: str) -> tuple[str, ...]:
    apart = re.sub(r"([a-z])([A-Z])", r"\1 \2", names)
    return tuple(re.findall(r"[a-z]+", apart.lower()))


def _marks_boilerplate(name: str) -> bool:
    """Whether one class or id says that its element is no main text."""
    words = _words(name)
    marked = [w in DROPPED_WORDS and (i == 0 or words[i - 1] not in STATES) for i, w in enumerate(words)]
    said = {w for w, m in zip(words, marked) if m}
    if said & STRONG_WORDS or said & BANNER_WORDS and not FRAME_WORDS.isdisjoint(words):
        return True
    return any(marked) and all(m or w in FRAME_WORDS for m, w in zip(marked, words))


def _titles(header: Node) -> bool:
    """Whether a header outside ``article`` titles the container it stands in: it
    has a heading, mostly unlinked text and no menu, and the container has other
    blocks of text."""
    up = header.parent
    if up is None or up.tag in ("", "html", "body"):
        return False
    headed, pending = False, [header]
    while pending:
        node = pending.pop()
        if node.tag in ("nav", "ul", "ol", "form"):
            return False
        headed = headed or node.tag in PROSE and node.tag[0] == "h"
        pending.extend(p for p in node.parts if p.__class__ is Node)
    if not headed:
        return False
    size = linked = 0
    for node in elements(header):
        n, in_links = _block_size(node) if node.tag not in INLINE else (0, 0)
        size, linked = size + n, linked + in_links
    return size > 2 * linked and _own_prose(up)


def _unlinked(root: Node) -> int:
    """Characters of unlinked text, of suspect subtrees too."""
    size, pending = 0, [root]
    while pending:
        for part in pending.pop().parts:
            if part.__class__ is str:
                size += len(part.strip())
            elif not part.dropped and part.tag != "a":
                pending.append(part)
    return size


def _article_apart(root: Node, suspect: Node) -> bool:
    """Whether an article with text stands elsewhere than in or around ``suspect``."""
    around, up = set(), suspect.parent
    while up:
        around.add(id(up))
        up = up.parent
    pending = [root]
    while pending:
        node = pending.pop()
        if node.tag in GOOD_TAGS and id(node) not in around and _unlinked(node):
            return True
        pending.extend(p for p in node.parts if p.__class__ is Node and p is not suspect
                       and not p.dropped and not p.suspect or id(p) in around)
    return False


class _Tree(HTMLParser):
    """Builds the element tree; ``root`` has the tag ``''``."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.open = Node("", {}, None)
        self.suspects: list[Node] = []

    def _close(self, tags: tuple[str, ...] | frozenset[str], fences: frozenset[str]) -> None:
        node = self.open
        while node.parent and node.tag not in fences:
            if node.tag in tags:
                self.open = node.parent
                return
            node = node.parent

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag not in INLINE and tag not in VOID:
            self._close(ENDED_BY_BLOCK, FENCES)
        if tag in SIBLINGS:
            self._close(SIBLINGS[tag], FENCES - frozenset(SIBLINGS[tag]))
        node = Node(tag, {k: v or "" for k, v in attrs}, self.open)
        self.open.parts.append(node)
        if node.suspect:
            self.suspects.append(node)
        if tag not in VOID:
            self.open = node

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        node = self.open
        while node.parent and node.tag != tag:
            if tag in INLINE and node.tag not in INLINE:
                return                  # an inline end does not close a block
            node = node.parent
        if node.parent:
            self.open = node.parent

    def handle_data(self, data: str) -> None:
        self.open.parts.append(data)


def parse(html: str) -> Node:
    tree = _Tree()
    tree.feed(html)
    tree.close()
    if tree.suspects:
        half = _unlinked(tree.root) / 2
        large = [n for n in tree.suspects if _unlinked(n) > half]
        kept = {id(n) for n in large if not _article_apart(tree.root, n)}
        for node in tree.suspects:
            node.dropped = id(node) not in kept
        for node in tree.suspects:
            if node.dropped and node.tag == "header" and _titles(node):
                node.dropped = node.suspect = False
    return tree.root


def elements(root: Node) -> Iterator[Node]:
    """Elements that may hold main text, in page order."""
    pending = [root]
    while pending:
        node = pending.pop()
        yield node
        pending.extend(p for p in reversed(node.parts)
                       if p.__class__ is Node and not p.dropped)


def text_of(node: Node) -> str:
    """The text of an element: blocks apart, inline elements joined."""
    out, pending = [], [node]
    while pending:
        part = pending.pop()
        if part.__class__ is str:
            out.append(part)
        elif not part.dropped or part is node:
            if part.tag in INLINE:
                pending.extend(reversed(part.parts))
            else:
                pending.append(" ")
                pending.extend(reversed(part.parts))
                out.append(" ")
    return " ".join("".join(out).split())


def _own_prose(node: Node) -> bool:
    """Whether ``node`` itself holds headings, paragraphs or text, mostly unlinked."""
    size = linked = 0
    for part in node.parts:
        if part.__class__ is str:
            size += len(part.strip())
        elif not part.dropped and part.tag in PROSE:
            n, in_links = _block_size(part)
            size, linked = size + n, linked + in_links
    return size > 2 * linked


def whole(node: Node) -> Node:
    """The article that ``node`` is the best part of, or ``node``."""
    above = []
    while node.parent:
        above.append(node)
        node = node.parent
    for tag in ("article", "main"):
        for up in reversed(above):
            if up.tag == tag:
                return up
    best = above[0] if above else node
    for child, up in zip(above, above[1:]):
        if up.tag in ("body", "html"):
            # a title or a lead directly in the body, beside the container
            if up.tag == "body" and _own_prose(up):
                best = up
            break
        alike = any(p is not child and p.__class__ is Node and p.label == child.label for p in up.parts)
        if alike or any(w in GOOD_WORDS for w in up.words) or _own_prose(up):
            best = up
        elif any(p is not child and (p.strip() if p.__class__ is str else not p.dropped and text_of(p))
                 for p in up.parts):
            break
    return best


def _joined(nodes: list[Node]) -> str:
    """The text of the whole articles of ``nodes``, each once, in page order."""
    tops = {id(n): n for n in map(whole, nodes)}
    texts = []
    for node in tops.values():
        up = node.parent
        while up and id(up) not in tops:
            up = up.parent
        if not up:
            texts.append(text_of(node))
    return " ".join(filter(None, texts))


def _block_size(block: Node) -> tuple[int, int]:
    """Characters directly in a block (through inline elements), and of those in links."""
    size = linked = 0
    pending = [(p, False) for p in block.parts]
    while pending:
        part, link = pending.pop()
        if part.__class__ is str:
            n = len(part.strip())
            size += n
            linked += n * link
        elif part.tag in INLINE and not part.dropped:
            link = link or part.tag == "a"
            pending.extend((p, link) for p in part.parts)
    return size, linked


def scored(root: Node) -> list[Node]:
    """Containers with a score, best first (ties: earlier in the page)."""
    found = list(elements(root))
    for node in found:
        if node.tag in INLINE or not node.parent:
            continue
        size, linked = _block_size(node)
        if not size:
            continue
        worth = (size - linked) * (1 - linked / size) * (1.0 if size >= 25 else 0.3)
        if node.tag in CONTAINERS:
            node.score += worth
        up, share = node.parent, 1.0
        while up and up.parent and share > 0.3:
            if up.tag in CONTAINERS:
                up.score += worth * share
                share /= 2
            up = up.parent
    for node in found:
        if node.tag in GOOD_TAGS:
            node.score *= 1.5
        elif any(w in GOOD_WORDS for w in node.words):
            node.score *= 1.25
        if node.suspect:
            node.score *= 0.5
    order = [n for n in found if n.score > 0 and n.tag in CONTAINERS]
    return sorted(order, key=lambda n: -n.score)


def votes(html: str) -> list[tuple[str, float]]:
    """Paths of the best containers with their share of the best score."""
    best = scored(parse(html))[:VOTES]
    return [(n.path(), n.score / best[0].score) for n in best]


def extract(html: str, paths: list[str]) -> str:
    """The main text, at the first of ``paths`` that the page has."""
    root = parse(html)
    best = scored(root)
    top = best[0] if best else None
    for path in paths:
        label = path.rpartition("/")[2]
        at = [n for n in elements(root) if n.label == label and n.path() == path]
        if at:
            text = _joined(at)
            if top is None or (text and 2 * sum(n.score for n in at) >= top.score):
                return text
            break
    return text_of(whole(top) if top is not None else root)


# ---------------------------------------------------------------------------
# Spark
# ---------------------------------------------------------------------------

def host(url: str | Column = "url") -> Column:
    url = F.col(url) if isinstance(url, str) else url
    found = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#]*)", 1)
    return F.coalesce(found, F.lit(""))


def host_paths(pages: DataFrame) -> DataFrame:
    """``host, paths``: the winning paths of each host, best first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, paths, shares = [], [], []
            for where, html in zip(batch.column(0).to_pylist(), batch.column(1)):
                for path, share in votes(html.as_py() or ""):
                    hosts.append(where)
                    paths.append(path)
                    shares.append(share)
            yield pa.RecordBatch.from_arrays(
                [pa.array(hosts, pa.string()), pa.array(paths, pa.string()),
                 pa.array(shares, pa.float64())], ["host", "path", "share"])

    cast = pages.select(host().alias("host"), "html").mapInArrow(
        run, "host string, path string, share double")
    # rounded shares add up alike in any order
    totals = cast.groupBy("host", "path").agg(
        F.sum(F.round(F.col("share") * 1000).cast("long")).alias("votes"))
    order = Window.partitionBy("host").orderBy(F.desc("votes"), "path")
    top = totals.withColumn("place", F.row_number().over(order)).where(F.col("place") <= PATHS)
    return top.groupBy("host").agg(
        F.array_sort(F.collect_list(F.struct("place", "path"))).alias("top")).select(
        "host", F.col("top.path").alias("paths"))


def main_text(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Per page its main text. Runs jobs (the vote)."""
    winners = stage(spark, host_paths(pages), "host-paths")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(html.as_py() or "", paths.as_py() or [])
                     for html, paths in zip(batch.column(2), batch.column(3))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array(list(map(len, texts)), pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html",
                        host().alias("host"))
    known = rows.join(sized_broadcast(winners), "host", "left")
    return known.select("page_id", "url", "html", "paths").mapInArrow(
        run, "page_id long, url string, text string, n_chars long")


def op5_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(spark, table(spark, sf_dir, "pages"))
