"""Main text of HTML pages by tree scoring.

A page becomes a tree (implied end tags, void elements, raw text and broken
markup included). Subtrees that are no article text by their tag, role or
class are cut: a class or id counts as noise by its whole name, not by some
word of it (``related-work``, ``category-social``), by its first word only if
the element is mostly links, an id of a heading never, and an article element
only if it is a comment or an advertisement. A compound class of a division, section, list,
form or table counts by its last word (``user-comments``, ``sticky-ad``), inside an
article only if that word can hardly name content or stands beside a word of the
page's frame (``cookie-banner``, ``right-rail``; but ``lunch-menu`` stays). Every paragraph of the rest earns points for its length
and commas and passes them to its ancestors, less at each level; a node's
score is its points discounted by its link density. The best container wins,
and its siblings stay, whatever their length, unless they are mostly links;
headings stay when something under them does. Inside an article or main
element that holds for every level up to it; beside an article element that
stands in the body itself only headings, other articles and what is between
them stay. The text of what stays is returned block by block.

Pages are independent: one ``mapInPandas`` pass, no shuffle, Arrow batches of
bounded size; time is linear in the page.

Defined cases: null or empty html gives an empty text; a page without any
scored paragraph gives the text of its article, main or body; a text outside
tags counts as a block; unclosed tags close where HTML implies it, unclosed
scripts, styles and comments run to the end of the page; repeated rows give
repeated results; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import html as html_lib
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

# HTML element classes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noframes noembed iframe xmp".split())
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
    figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section
    summary table tbody td tfoot th thead tr ul""".split())
CUT = frozenset("""aside audio button canvas datalist dialog embed footer head iframe input map menu nav noscript
    object option script select style svg template textarea title video""".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PARAGRAPHS = frozenset("p pre blockquote td li dd".split())
CONTAINERS = frozenset("div section article main body td center".split())
# What a start tag closes: (tags closed, tags that stop the search).
CLOSES_P = BLOCK - frozenset("body html tbody td tfoot th thead tr caption dd dt li".split()) | {"p"}
IMPLIED = {
    "li": (frozenset(["li"]), frozenset("ul ol menu".split())),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "tr": (frozenset("tr td th".split()), frozenset(["table"])),
    "td": (frozenset("td th".split()), frozenset("tr table".split())),
    "th": (frozenset("td th".split()), frozenset("tr table".split())),
    "option": (frozenset(["option"]), frozenset("select datalist".split())),
}
# Words of class, id and role that mark what is not the article.
NOISE = frozenset("""ad ads adbox adslot advert adverts advertisement advertisements adsense advertising alert banner
    breadcrumb breadcrumbs comment comments commentlist complementary consent contentinfo cookie cookies dialog
    disclaimer discussion disqus footer gdpr login masthead menu menubar modal nav navbar navigation newsletter notice
    notices notification pager pagination popup promo promoted promotion recommended related replies reply respond
    search share sharing sidebar signup skip social sponsor sponsored subscribe subscription tagcloud toolbar topbar
    widget widgets""".split())
KEPT_WORDS = frozenset(["header", "banner"])   # cut only outside an article
# Noise words that articles are also about: an id made of a heading may hold them.
TOPICS = frozenset("""advertisement advertisements advertising alert banner complementary consent cookie cookies dialog
    disclaimer discussion login menu modal navigation newsletter notice notices notification notifications pager
    pagination popup promo promoted promotion recommended related replies reply respond search share sharing signup skip
    social sponsor sponsored subscribe subscription toolbar widget widgets""".split())
# Words that say nothing of the content: with them around, a noise word still is the whole name.
PARTS = frozenset("""area article articles bar block body bottom box btn button buttons center col column container content
    entry form group holder icon icons inner item items left link links list main module outer overlay page panel post
    posts primary region right row secondary section site slot story strip text thread title top unit wrap wrapper""".split())
# A compound class of a part of the page is noise by its first word, by its last one, or by a last word that goes
# with a word of the second list; outside an article the last word is enough.
NOISE_HEADS = frozenset("adsense disqus footer gdpr masthead sidebar".split())
NOISE_TAILS = frozenset("""ad ads advert advertisement adverts breadcrumb breadcrumbs comments commentlist consent footer
    masthead navbar sidebar""".split())
DOUBTFUL_TAILS = frozenset("banner comment header menu modal nav notice notices popup rail".split())
COMPANIONS = frozenset("""ad ads consent cookie cookies copyright desktop facebook fb footer gdpr global left legal main mobile nav
    page privacy reader right side site sticky top user visitor""".split())
PART_TAGS = frozenset("div dl form ol section table ul".split())   # elements whose compound classes are judged so
# What an article element may not be.
NO_ARTICLE = frozenset("ad ads advert advertisement comment comments promo reply sponsored".split())
MANY_LINKS = 0.5   # link density of what is no text
ARTICLE_WORDS = frozenset("article post entry story hentry".split())   # class words of a container that is an article

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*)(?:>|\Z)"
    r"|(?P<text>[^<]+|<)", re.DOTALL)
ATTR = re.compile(r"([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
WORDS = re.compile(r"[a-zA-Z][a-z]*|[A-Z]+")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def _named(name: str, noise: frozenset) -> bool:
    """Whether a class or id as a whole, and not some word of it, is a noise word."""
    if name.lower() in noise:
        return True
    words = [w.lower() for w in WORDS.findall(name)]
    return any(w in noise for w in words) and all(w in noise or w in PARTS or len(w) == 1 for w in words)


def _compound(name: str, in_article: bool) -> bool:
    """Whether the first or last word of a compound class marks a part of the page that is no article text."""
    words = [w.lower() for w in WORDS.findall(name)]
    if len(words) < 2:
        return False
    if words[0] in NOISE_HEADS or words[-1] in NOISE_TAILS:
        return True
    return words[-1] in DOUBTFUL_TAILS and (not in_article or any(w in COMPANIONS for w in words[:-1]))


def _judge(tag: str, attrs: str, in_article: bool) -> tuple[bool, bool, bool]:
    """Whether the attributes of a start tag mark its element as no article text, as an article, or as no article
    text if it is mostly links."""
    if tag in ("html", "body", "main"):
        return False, False, False
    given: dict[str, list[str]] = {}
    for m in ATTR.finditer(attrs):
        name = m[1].lower()
        value = m[2] if m[2] is not None else m[3] if m[3] is not None else m[4] or ""
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return True, False, False
        if name == "style" and HIDDEN.search(value):
            return True, False, False
        if name in ("class", "id", "role"):
            given.setdefault(name, []).extend(value.split())
    noise = NOISE - KEPT_WORDS if in_article else NOISE if tag in HEADINGS else NOISE | KEPT_WORDS
    if any(r.lower() in noise for r in given.get("role", [])):
        return True, False, False
    classes = given.get("class", [])
    article = tag in CONTAINERS and any(c.lower() in ARTICLE_WORDS for c in classes)
    if article or tag == "article":
        return not article and any(c.lower() in NO_ARTICLE for c in classes), article, False
    ids = [] if tag in HEADINGS else given.get("id", [])
    if any(_named(c, noise) for c in classes) or any(_named(i, noise - TOPICS) for i in ids):
        return True, False, False
    if tag in PART_TAGS and any(_compound(c, in_article) for c in classes + (ids if not in_article else [])):
        return True, False, False
    heads = [[w.lower() for w in WORDS.findall(x)] for x in classes + ids]
    if not in_article and any(len(h) > 1 and all(w in noise for w in h) for h in heads):
        return True, False, False
    return False, False, tag not in HEADINGS and any(h and h[0] in noise for h in heads)


class Tree:
    """Flat arrays of a parsed page; children have larger numbers than their parent."""

    __slots__ = ("tag", "parent", "cut", "events", "in_article", "size", "links", "doubt", "_children")

    def __init__(self, page: str):
        self.tag, self.parent, self.cut, self.in_article = ["#root"], [-1], [False], [False]
        self._children: list[list[int]] = []
        self.doubt: list[int] = []   # no article text if mostly links
        self.events: list[tuple[int, str | None]] = []   # (node, text), (node, None) opens, (~node, None) closes
        self._parse(page)
        self._fold()

    def _parse(self, page: str) -> None:
        tags, parents, cut, inside, events = self.tag, self.parent, self.cut, self.in_article, self.events
        stack, open_tags, pos = [0], ["#root"], 0
        count: Counter = Counter()   # of the open tags, so that none is looked for in vain

        def close_to(depth: int) -> None:
            while len(stack) > depth:
                events.append((~stack.pop(), None))
                count[open_tags.pop()] -= 1

        def close_first(which: frozenset, stop: frozenset) -> None:
            """Close from the outermost open tag of ``which`` inside the nearest ``stop``."""
            found, left = 0, sum(count[t] for t in which)
            for i in range(len(open_tags) - 1, 0, -1):
                if not left or open_tags[i] in stop:
                    break
                if open_tags[i] in which:
                    found, left = i, left - 1
            if found:
                close_to(found)

        n = len(page)
        while pos < n:
            m = TOKEN.match(page, pos)
            pos = m.end()
            text = m["text"] or m["cdata"]
            if text:
                if not cut[stack[-1]]:
                    events.append((stack[-1], text if m["cdata"] else html_lib.unescape(text) if "&" in text else text))
                continue
            tag = m["tag"]
            if not tag:
                continue
            tag = tag.lower()
            if m["close"]:
                if tag == "br":
                    events.append((stack[-1], " "))
                elif count[tag]:
                    depth = len(open_tags) - 1
                    # an inline end tag does not close the blocks around it
                    while open_tags[depth] != tag and (tag in BLOCK or open_tags[depth] not in BLOCK):
                        depth -= 1
                    if open_tags[depth] == tag:
                        close_to(depth)
                continue
            if tag in ("html", "body") and count[tag]:
                continue
            if tag in CLOSES_P and count["p"]:
                close_first(frozenset(["p"]), frozenset(["button", "td", "th", "table"]))
            if tag in IMPLIED:
                close_first(*IMPLIED[tag])
            if tag == "body" and count["head"]:
                close_to(open_tags.index("head"))
            if tag in VOID:
                if tag in ("br", "hr", "wbr", "img") and not cut[stack[-1]]:
                    events.append((stack[-1], "" if tag == "wbr" else " "))
                if tag == "hr":
                    events.append((stack[-1], None))
                continue
            up = stack[-1]
            node = len(tags)
            tags.append(tag)
            parents.append(up)
            attrs = m["attrs"]
            noise, article, doubt = _judge(tag, attrs, inside[up]) if attrs and attrs.strip(" /") else (False, False, False)
            if doubt:
                self.doubt.append(node)
            inside.append(inside[up] or article or tag in ("article", "main"))
            cut.append(cut[up] or noise or tag in CUT or tag == "header" and not inside[up])
            events.append((node, None))
            if attrs.endswith("/") and tag not in BLOCK:   # <svg/>, <span/>: nothing inside
                events.append((~node, None))
                continue
            stack.append(node)
            open_tags.append(tag)
            count[tag] += 1
            if tag in RAW:
                end = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(page, pos)
                stop = end.start() if end else n
                if tag == "textarea" or tag == "title":
                    pass   # cut anyway
                pos = stop
        close_to(1)

    def _fold(self) -> None:
        """Forms that hold no article are cut, and doubtful parts that are mostly links; text and link lengths
        are summed up the tree."""
        n = len(self.tag)
        holds = [0] * n
        for i in range(n - 1, 0, -1):
            if not self.cut[i]:
                holds[i] += 3 if self.tag[i] in ("article", "main") else self.tag[i] == "p"
            if self.tag[i] == "form" and holds[i] < 3:
                self.cut[i] = True
            holds[self.parent[i]] += holds[i]
        self._sum()
        links = [i for i in self.doubt if self.size[i] and self.link_density(i) >= MANY_LINKS]
        if links:
            for i in links:
                self.cut[i] = True
            self._sum()

    def _sum(self) -> None:
        n = len(self.tag)
        self.size, self.links = [0] * n, [0] * n
        for i in range(1, n):
            self.cut[i] = self.cut[i] or self.cut[self.parent[i]]
        for i, text in self.events:
            if text and i >= 0 and not self.cut[i]:
                self.size[i] += len(" ".join(text.split()))
        for i in range(n - 1, 0, -1):
            if self.tag[i] == "a":
                self.links[i] = self.size[i]
            self.size[self.parent[i]] += self.size[i]
            self.links[self.parent[i]] += self.links[i]

    def link_density(self, i: int) -> float:
        return self.links[i] / self.size[i] if self.size[i] else 0.0

    def scores(self) -> dict[int, float]:
        """Points of paragraphs passed to ancestors (whole, half, a third, ...), discounted by link density."""
        block = [0] * len(self.tag)   # the block around each node
        for i in range(1, len(self.tag)):
            block[i] = i if self.tag[i] in BLOCK else block[self.parent[i]]
        own: dict[int, list[str]] = {}
        for i, text in self.events:
            if text and i >= 0 and not self.cut[i]:
                own.setdefault(block[i], []).append(text)
        points: dict[int, float] = {}
        for i, texts in own.items():
            text = " ".join("".join(texts).split())
            if not text or self.tag[i] in HEADINGS:
                continue
            gain = 1 + text.count(",") + min(len(text) / 100, 3)
            if self.tag[i] not in PARAGRAPHS:   # text directly in a container counts for the container
                points[i] = points.get(i, 0) + gain
            level, up = 1, self.parent[i]
            while up > 0 and level <= 6:
                points[up] = points.get(up, 0) + gain / level
                up, level = self.parent[up], level + 1
        return {i: p * (1 - self.link_density(i)) for i, p in points.items()}

    def main_nodes(self) -> list[int]:
        """The best container and the siblings that stay, in page order."""
        scores = self.scores()
        prior = {"article": 25.0, "main": 15.0, "body": -5.0, "html": -1e9, "form": -5.0}
        ranked = {i: s + prior.get(self.tag[i], 0.0) for i, s in scores.items()
                  if self.tag[i] in CONTAINERS or self.tag[i] == "form"}
        if ranked:
            best = max(ranked, key=lambda i: (ranked[i], -i))
        else:
            named = [i for t in ("article", "main", "body") for i in range(len(self.tag))
                     if self.tag[i] == t and not self.cut[i] and self.size[i]]
            return named[:1] or [0]
        up = best
        while up > 0:   # the article around the best container is the container
            if self.tag[up] in ("article", "main") and self.size[up] and self.link_density(up) < 0.5:
                best = up
                if self.tag[up] == "article":
                    break
            up = self.parent[up]
        keep = {best}
        marked = self.tag[best] in ("article", "main")
        if best and self.tag[best] != "body" and self.tag[best] != "main":
            keep |= self._siblings(best, marked)
        while self.in_article[self.parent[best]]:   # parts of the article or main element around
            best = self.parent[best]
            if self.tag[best] != "main":
                keep |= self._siblings(best, False) - {best}
        return sorted(keep)

    def _siblings(self, node: int, marked: bool) -> set[int]:
        """The siblings that stay with a kept node: text with few links, and headings of what is kept.

        Beside a marked article right in the body only headings, other articles and what is between them stay."""
        up = self.parent[node]
        level = [i for i in self.children()[up] if i == node or not self.cut[i] and self.size[i]]
        few = {i for i in level if i == node or self.link_density(i) < MANY_LINKS}
        texts = {i for i in few if self.tag[i] not in HEADINGS}
        if marked and self.tag[up] in ("#root", "html", "body"):
            texts = {i for i in texts if i == node or self.tag[i] == "article"}
        keep = set(texts)
        under = [False] * 7   # whether a heading of that level has kept text under it
        for i in reversed(level):
            if i in texts:
                under = [True] * 7
            elif self.tag[i] in HEADINGS:
                rank = int(self.tag[i][1])
                if under[rank] or rank == 1 and i in few:
                    keep.add(i)
                under[rank:] = [False] * (7 - rank)
        low, high = min(keep), max(keep)
        keep |= {i for i in few if low < i < high and self.tag[i] not in HEADINGS}
        return keep

    def children(self) -> list[list[int]]:
        if not self._children:
            self._children = [[] for _ in self.tag]
            for i in range(1, len(self.tag)):
                self._children[self.parent[i]].append(i)
        return self._children

    def text(self) -> str:
        keep = set(self.main_nodes())
        blocks: list[str] = []
        run: list[str] = []
        depth = 1 if 0 in keep else 0

        def flush() -> None:
            block = " ".join("".join(run).split())
            if block:
                blocks.append(block)
            run.clear()

        for i, text in self.events:
            if text is not None:
                if depth and not self.cut[i]:
                    run.append(text)
            else:
                node = i if i >= 0 else ~i
                if self.tag[node] in BLOCK or node in keep:
                    flush()
                if node in keep:
                    depth += 1 if i >= 0 else -1
        flush()
        return "\n".join(blocks)


def main_text(page: str | None) -> str:
    return Tree(page).text() if page else ""


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of each row of ``pages`` (page_id, url, html)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = [main_text(h) if isinstance(h, str) else "" for h in pdf["html"]]
            yield pd.DataFrame({"page_id": pdf["page_id"], "url": pdf["url"], "text": texts,
                                "n_chars": [len(t) for t in texts]})

    rows = pages.selectExpr("cast(page_id as bigint) page_id", "cast(url as string) url", "cast(html as string) html")
    return rows.mapInPandas(run, "page_id bigint, url string, text string, n_chars bigint")
