"""Main text of web pages by a style tree per site."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from html.parser import HTMLParser

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfsight.llm.registry import query, table, unused, whole_texts
from shelfsight.session import written

LEAST_IMPORTANCE = 0.3
LEAST_PAGES = 5
PRESENTATION = 0.1  # share of the variety of a node's children in its importance

# Element names and name parts as HTML and common usage have them.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q ruby rt rp s samp small span strike strong sub sup "
    "time tt u var".split()
)
UNSEEN = frozenset("head title script style noscript template iframe object svg canvas audio video math".split())
FURNITURE = frozenset("nav footer aside menu dialog button select textarea label legend option optgroup datalist".split())
FORMS = frozenset("form fieldset".split())
CONTENT = frozenset("article main".split())
NOISE_NAMES = frozenset(
    "ad ads adsense advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "copyright disqus footer gdpr login masthead menu modal nav navbar navigation newsletter notice notices pager pagination popup "
    "promo promotion related recommended share sharing sidebar signup social sponsor sponsored subscribe subscription toolbar widget "
    "widgets".split()
)
BOX_NAMES = frozenset(
    "area article bar block body bottom box button buttons center col column container content entry form foot group head header holder "
    "icons inline inner item items left link links list main mobile outer page panel post posts primary right row secondary section site "
    "slot space strip top unit wrap wrapper".split()
)
CLOSED_BY_BLOCK = frozenset(["p"])
CLOSED_BY_SAME = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
}
SCOPES = frozenset("ul ol dl table tr tbody thead tfoot select article main section div body".split())

_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_DIGITS = re.compile(r"\d+")


@lru_cache(maxsize=1 << 16)
def _named_noise(names: str) -> bool:
    """Whether a class, id or role is a name of noise, or is made of such names and names of boxes, as ``ad``, ``ad-slot``
    and ``cookieNotice`` are. Other compounds, as ``notice-period`` or ``has-sidebar``, say nothing."""
    for token in names.split():
        parts = {part.lower() for part in _PARTS.findall(token)}
        if parts & NOISE_NAMES and parts <= NOISE_NAMES | BOX_NAMES:
            return True
    return False


@lru_cache(maxsize=1 << 17)
def _path(above: int, tag: str, names: str) -> int:
    """The place of an element in the style tree: a hash of its tag and names, and of the place of what holds it."""
    style = _DIGITS.sub("0", " ".join(sorted(names.split()))) if names else ""
    return _hash(f"{above}>{tag}.{style}")


class Node:
    __slots__ = ("tag", "path", "parent", "children", "noise", "content", "suspect")

    def __init__(self, tag: str, attrs: dict[str, str | None], parent: Node | None):
        self.tag, self.parent, self.children = tag, parent, []
        names = " ".join(filter(None, (attrs.get("class"), attrs.get("id"), attrs.get("role")))) if attrs else ""
        inside = parent is not None and parent.content
        self.noise = (
            (parent is not None and parent.noise) or tag in UNSEEN or tag in FURNITURE or "hidden" in attrs or (not inside and tag == "header")
        )
        marks = tag in CONTENT or ("role" in attrs and "main" in (attrs["role"] or "").lower().split())
        self.content = inside or marks
        # Names and forms are judged when the whole page is known; a form may be laid around all of it.
        self.suspect = tag in FORMS or (
            bool(names) and tag not in ("html", "body") and (inside or not marks)
            and (_named_noise(names) or (not inside and any(t.lower() == "header" for t in names.split())))
        )
        self.path = _path(parent.path if parent is not None else 0, tag, names)


class Page(HTMLParser):
    """Block elements of a page as a tree whose leaves are texts; inline elements belong to the text around them."""

    def __init__(self, html: str | None):
        super().__init__(convert_charrefs=True)
        self.root = self.open = Node("", {}, None)
        self.text: list[str] = []
        self.feed(html or "")
        self.close()
        self._flush()
        self._judge()

    def _judge(self) -> None:
        """Make noise of forms and of elements named like noise, with what is in them, unless they hold most of what the page has to say.

        That is most words of its marked content, or of the page if it marks none; and if no marked word would
        be left, names count for nothing around marked content.
        """
        nodes = list(self.nodes())
        if not any(node.suspect for node in nodes):
            return
        words: dict[Node, list[int]] = {}  # in the branch: in all, marked, and marked outside of suspects around it
        under: dict[Node, bool] = {}
        for node in nodes:
            outside = node.parent is None or not node.content
            under[node] = (node.parent is not None and under[node.parent]) or (node.suspect and outside)
            n = sum(c.count(" ") + 1 for c in node.children if isinstance(c, str))
            words[node] = [n, n * node.content, n * (node.content and not under[node])]
        for node in reversed(nodes):
            if node.parent is not None:
                words[node.parent] = [x + y for x, y in zip(words[node.parent], words[node], strict=True)]
        total, marked, plain = words[self.root]
        for node in nodes:
            n, n_marked, _ = words[node]
            most = 2 * n_marked > marked if marked else 2 * n > total
            around = n_marked > 0 and not node.content and not plain
            node.noise = (node.parent is not None and node.parent.noise) or (node.suspect and not most and not around)

    def _flush(self) -> None:
        words = "".join(self.text).split()
        self.text.clear()
        if words and not self.open.noise:
            self.open.children.append(" ".join(words))

    def _shut(self, tags, scope: frozenset[str]) -> None:
        """Close the nearest open element with one of the tags, unless an element of the scope is nearer."""
        node = self.open
        while node.parent is not None:
            if node.tag in tags:
                self._flush()
                self.open = node.parent
                return
            if node.tag in scope:
                return
            node = node.parent

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in VOID:
            if tag in ("br", "hr", "img", "wbr"):
                self.text.append("" if tag == "wbr" else " ")
            return
        values = dict(attrs)
        if tag in INLINE:
            node = Node(tag, values, self.open)
            if not (node.noise or node.suspect) or self.open.noise:
                return
        else:
            if tag in CLOSED_BY_SAME:
                self._shut(CLOSED_BY_SAME[tag], SCOPES - {"tr"} if tag == "tr" else SCOPES)
            self._shut(CLOSED_BY_BLOCK, SCOPES)
            self._flush()
            node = Node(tag, values, self.open)
        self._flush()
        self.open.children.append(node)
        self.open = node

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)  # the slash has no meaning in HTML

    def handle_endtag(self, tag: str) -> None:
        if tag in VOID or (tag in INLINE and self.open.tag != tag):
            return
        self._shut((tag,), frozenset())

    def handle_data(self, data: str) -> None:
        if not self.open.noise:
            self.text.append(data)

    def nodes(self) -> Iterator[Node]:
        """All elements that may be seen, in page order."""
        waiting = [self.root]
        while waiting:
            node = waiting.pop()
            if isinstance(node, Node) and not node.noise:
                yield node
                waiting.extend(c for c in reversed(node.children) if isinstance(c, Node))


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text) - (1 << 63)


def _observed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """What each page shows of each node: its texts (of the whole branch) and the styles of its children, each with
    its count; and a digest of the page's body, which is its marked content, or all texts if it marks none."""
    for batch in batches:
        rows = []
        for host, html in zip(batch["host"], batch["html"], strict=True):
            seen: Counter[tuple[int, bool, int]] = Counter()
            paths: dict[Node, list[int]] = {}
            body: list[str] = []
            everything: list[str] = []
            for node in Page(html).nodes():
                above = paths.get(node.parent, []) if node.parent is not None else []
                own = paths[node] = [*above, node.path]
                seen[node.path, False, _hash(" ".join(str(c.path) if isinstance(c, Node) else "#" for c in node.children))] += 1
                for child in node.children:
                    if isinstance(child, str):
                        feature = _hash(child)
                        seen.update((path, True, feature) for path in own)
                        everything.append(child)
                        if node.content:
                            body.append(child)
            path, is_text, feature = zip(*seen, strict=True)
            rows.append((host, _hash("\n".join(body or everything)), path, is_text, feature, list(seen.values())))
        yield pd.DataFrame(rows, columns=["host", "body", "path", "is_text", "feature", "n"])


def style_tree(pages: DataFrame, bodies_once: bool = False) -> DataFrame:
    """The merged style trees of all hosts: ``(host, path, importance, pages)`` for each node (``path`` is a hash).

    The pages of a host are merged by the styles (tag, class, id and role) from the root down. The content of a
    branch is important as far as its texts differ between pages: for each text, the entropy of its spread
    over pages, relative to the highest possible one, is 1 if every page has it and 0 if one page has it; the
    importance is 1 minus the mean over all different texts of the branch. The presentation of a node is
    important as far as its sequences of child styles differ. Counts are combined in tasks and then by host,
    node and feature, so a host with a third of all pages is spread by its texts.

    With ``bodies_once``, pages of a host with equal bodies count as one page (of those, the smallest in what it
    shows), so that copies of an article do not look like a template.
    """
    seen = pages.select("host", "html").mapInPandas(
        _observed, "host string, body long, path array<long>, is_text array<boolean>, feature array<long>, n array<long>"
    )
    shown = F.struct("path", "is_text", "feature", "n")
    if bodies_once:
        seen = seen.groupBy("host", "body").agg(F.min(shown).alias("shown"))
    else:
        seen = seen.select("host", "body", shown.alias("shown"))
    seen = written(seen.select("host", "shown.*"), "page-features")
    hosts = seen.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    each = seen.select("host", F.explode(F.arrays_zip("path", "is_text", "feature", "n")).alias("f")).select("host", "f.*")
    features = each.groupBy("host", "path", "is_text", "feature").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.log(F.col("n"))).alias("n_ln_n")
    )
    spread = F.log(F.col("n")) - F.col("n_ln_n") / F.col("n")
    nodes = features.groupBy("host", "path").agg(
        F.avg(F.when(F.col("is_text"), spread)).alias("repeated"),
        F.sum(F.when(~F.col("is_text"), F.col("n"))).alias("shown"),
        F.sum(F.when(~F.col("is_text"), F.col("n") * F.log(F.col("n")))).alias("shown_ln"),
    )
    variety = F.log(F.col("shown")) - F.col("shown_ln") / F.col("shown")
    top = F.when(F.col("pages") > 1, F.log(F.col("pages")))
    content = 1 - F.coalesce(F.col("repeated") / top, F.lit(0.0))
    presentation = F.least(F.coalesce(variety / top, F.lit(1.0)), F.lit(1.0))
    return nodes.join(hosts, "host").select(
        "host", "path", (PRESENTATION * presentation + (1 - PRESENTATION) * content).alias("importance"), "pages"
    )


def main_text(html: str | None, unimportant: set[int]) -> str:
    """The texts of a page outside unimportant branches, one per line.

    If the page marks its content (``article``, ``main`` or the role ``main``), only texts in it count. A branch is
    removed, inside marked content and outside alike, if it and all branches in it are unimportant.
    """
    page = Page(html)
    nodes = list(page.nodes())
    marked = any(node.content for node in nodes)
    kept = set() if unimportant else set(nodes)
    for node in reversed(nodes if unimportant else []):
        if node in kept or node.path not in unimportant:
            kept.add(node)
            if node.parent is not None:
                kept.add(node.parent)
    found: list[str] = []
    waiting: list[Node | str] = [page.root]
    while waiting:
        node = waiting.pop()
        if isinstance(node, str):
            found.append(node)
        elif node in kept:
            waiting.extend(c for c in reversed(node.children) if isinstance(c, Node) or node.content or not marked)
    return "\n".join(found)


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.lower(F.coalesce(host, F.lit("")))


def extract_main_text(pages: DataFrame, least_importance: float = LEAST_IMPORTANCE, least_pages: int = LEAST_PAGES) -> DataFrame:
    """``pages`` (with ``url`` and ``html``) with ``text`` added, all other columns kept.

    Branches of the :func:`style_tree` of the page's host that lie below ``least_importance`` with all that is in
    them are removed, on hosts with at least ``least_pages`` pages of different bodies. Entropy alone cannot tell an
    advert or a menu whose words change from page to page, so elements whose tag says what they are, or a class, id or
    role made of names of noise and of boxes, have no importance, on any host; names and forms do not count on ``html``,
    ``body`` and what holds most of the text, so a form laid around a page keeps all but its fields. What stays is the text
    of each block with character references decoded and white space as one space.

    Null and empty pages give an empty text; a null or odd url counts as one host of its own. Repeated pages
    give repeated rows, an empty table an empty result. A column of ``pages`` named ``text`` is replaced.
    """
    whole_texts(pages.sparkSession)
    marked = pages.select(host_of(F.col("url")).alias("host"), "html")
    low = style_tree(marked, bodies_once=True).where((F.col("importance") < least_importance) & (F.col("pages") >= least_pages))
    host, paths = unused(pages, "_host"), unused(pages, "_paths")
    low = written(low.groupBy(F.col("host").alias(host)).agg(F.collect_set("path").alias(paths)), "unimportant")

    @F.pandas_udf("string")
    def text(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for html, unimportant in batches:
            yield pd.Series([main_text(h, set() if u is None else set(u)) for h, u in zip(html, unimportant, strict=True)], dtype=object)

    rest = pages.drop("text")
    return rest.join(low, host_of(F.col("url")) == F.col(host), "left").withColumn("text", text("html", paths)).select(
        *[F.col(f"`{c}`") for c in rest.columns], "text"
    )


@query("op5_html_extract")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    found = extract_main_text(table(spark, folder, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
