"""Main text of web pages, with what a site repeats taken out.

Every page is read into elements. An element's subtree is hashed (tag, text and hashes
below), so a menu or notice has the same hash on every page that shows it. Spark counts, per
host, the pages each hash occurs on; subtrees on many pages of a host are template and are
deleted. Elements whose tag, or whose whole class name, id or role says what they are
(menus, forms, scripts, adverts, comments and so on) go too; a name never drops what holds
the main element, the page's article or most of its text. A name says so if its last word
does (``main-menu``, ``post-comments``), or if all of its words belong to such a thing
(``ad-slot``, ``comment-body``); a comment's own ``article`` is no article.

A subtree is template if at least ``least`` different pages of the host, and ``share`` of
them, have it; the page's largest article and what holds it or an h1 never are. Inside an
article, where sites quote and authors repeat themselves, it takes ``wide`` of the host's pages
and an element that wraps others: paragraphs, headings, items and quotations stay. Pages are different if the least hash of three words in a row
is, taken from their article or, where none holds most of the text, from all of it: copies
and near copies of a page count as one and do not make its text template. Per host that is at most elements per page / share hashes, so the list each page is
given is bounded. A host with very many pages is counted by partial aggregates, and the join
is skewed on the side AQE splits.

What is left is cut down to the article or main element that holds most of it; where none
does, to all of them, unless an element beside them holds more than twice the text of the largest.

Pages are parsed twice, before and after the counts.

Defined cases: null html is empty, with empty text; a null url, or one without a host, has
no site to compare with; unclosed, unknown and stray tags are tolerated; an empty table gives an empty result. Other columns are passed by.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape
from itertools import accumulate

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import few_at_once, materialize

#: Pages of a host that make a subtree template: this many, and this share.
LEAST_PAGES, SHARE, WIDE = 5, 0.02, 0.2

#: Elements without an end tag, and those whose content is not markup (fixed values).
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
RAW = frozenset("script style textarea title noscript iframe template xmp".split())

#: Elements that begin and end a block of text.
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main "
    "menu nav ol p pre search section summary table tbody tfoot thead tr ul".split()
)

#: Elements that are never main text, and words of class, id or role that say so.
DROP = frozenset(
    "head script style textarea title noscript iframe template xmp nav aside footer form "
    "button select option input label menu dialog svg canvas object audio video".split()
)
DROP_WORDS = frozenset(
    "ad ads adv advert adverts advertisement sponsor sponsored promo banner cookie cookies "
    "consent gdpr notice notices alert sidebar sidebars widget menu menus nav navbar navigation "
    "breadcrumb breadcrumbs footer header masthead share sharing social newsletter subscribe "
    "signup login popup modal overlay comment comments disqus replies related pagination "
    "pager skip contentinfo complementary".split()
)
#: Words that may stand beside those in one name: any other word makes it another name,
#: unless it comes before.
BESIDE = frozenset(
    "site box block container wrapper wrap list area links buttons bar slot unit space body text "
    "content item items thread form inner outer holder section group row entry meta author".split()
)
#: Words by which a name says what is not there, or beside what it stands.
ELSEWHERE = frozenset(
    "no not has have with without hide hidden above below before after under over".split()
)
#: Links to other texts: one of each, in this order. Headings of the text itself.
OTHER = frozenset("related recommended similar suggested popular recent trending latest more".split())
TEXTS = frozenset("posts articles stories links news reading items content".split())
OWN = frozenset("article post entry story content page title main section".split())
#: Readers' own words.
REPLY = frozenset("comment comments reply replies".split())

#: Elements that stay in an article however many pages have them: they hold text themselves.
TEXT = frozenset(
    "p h1 h2 h3 h4 h5 h6 hgroup li dt dd tr td th caption blockquote pre address figcaption "
    "figure summary".split()
)

#: Open elements that a start tag ends: paragraphs by blocks, items and cells by their like.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}}
ENDS |= {"tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
SCOPE = frozenset("ul ol dl table body html article main section div".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([A-Za-z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)>?"
    r"|([^<]+|<)",
    re.S,
)
MARKS = re.compile(r"(?<![\w-])(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)


def says_drop(name: str) -> bool:
    """Whether a class name, id or role says that its element is not main text."""
    words = [w for w in re.split(r"[^a-z]+", name) if w]
    if not words or not ELSEWHERE.isdisjoint(words):
        return False
    if words[-1] == "header" and not OWN.isdisjoint(words):
        return False
    if any(a in OTHER and b in TEXTS for a, b in zip(words, words[1:])):
        return True
    named = not DROP_WORDS.isdisjoint(words)
    return named and (words[-1] in DROP_WORDS or DROP_WORDS.union(BESIDE).issuperset(words))


def says_reply(name: str) -> bool:
    words = [w for w in re.split(r"[^a-z]+", name) if w]
    return bool(words) and (words[-1] in REPLY or words[0] in REPLY)


class Node:
    __slots__ = ("tag", "seen", "first", "drop", "heading", "inside", "named", "main")

    def __init__(self, tag: str, first: int, drop: bool, inside: bool) -> None:
        self.tag, self.seen, self.first = tag, [], first
        self.drop, self.inside = drop, inside
        self.heading = self.named = self.main = False


class Page:
    """Blocks of text, whether each may be main text and lies in an article, and subtrees.

    subtrees: (hash, first block, end, whether it wraps others) of every element that could
    be template.
    mains, titled, named: (first block, end) of article and main elements (and whether it is a
    main), of those that hold an h1, and of elements that their names would drop.
    """

    def __init__(self, html: str) -> None:
        self.blocks: list[str] = []
        self.keep: list[bool] = []
        self.inside: list[bool] = []
        self.subtrees: list[tuple[int, int, int, bool]] = []
        self.holding: set[int] = set()
        self.mains: list[tuple[int, int, bool]] = []
        self.titled: list[tuple[int, int]] = []
        self.named: list[tuple[int, int]] = []
        self.stack = [Node("", 0, False, False)]
        # open elements by tag, in all and since the innermost of SCOPE
        self.opened: Counter[str] = Counter()
        self.scopes: list[Counter[str]] = [Counter()]
        self.text: list[str] = []
        self.read(html)
        self.drop_named()
        self.count_for()

    def flush(self) -> None:
        if self.text:
            line = " ".join(unescape("".join(self.text)).split())
            self.text = []
            if line:
                node = self.stack[-1]
                self.blocks.append(line)
                self.keep.append(not node.drop)
                self.inside.append(node.inside)
                node.seen.append(line)

    def close(self) -> None:
        node = self.stack[-1]
        if node.tag in BLOCK or node.tag in DROP:
            self.flush()
        self.stack.pop()
        self.opened[node.tag] -= 1
        if node.tag in SCOPE:
            self.scopes.pop()
        else:
            self.scopes[-1][node.tag] -= 1
        parent = self.stack[-1]
        if node.seen:
            value = xxhash.xxh64_intdigest("\x1f".join([node.tag, *node.seen]))
            parent.seen.append(f"{value:x}")
            if node.tag in BLOCK and node.first < len(self.blocks):
                holds = node.tag == "h1" or node.heading
                wraps = node.tag not in TEXT
                self.subtrees.append((value - (1 << 63), node.first, len(self.blocks), wraps))
                if holds:
                    self.holding.add(len(self.subtrees) - 1)
        parent.heading |= node.heading or node.tag == "h1"
        if node.first < len(self.blocks):
            if node.main:
                self.mains.append((node.first, len(self.blocks), node.tag != "article"))
                if node.heading:
                    self.titled.append((node.first, len(self.blocks)))
            # the title of an article stays with it
            if node.named and not (node.inside and node.heading):
                self.named.append((node.first, len(self.blocks)))

    def open(self, tag: str, attributes: str) -> None:
        if tag in BLOCK or tag in DROP:
            self.flush()
        if tag in BLOCK:
            self.end({"p"}, SCOPE)
        if tag in ENDS:
            self.end(ENDS[tag], SCOPE)
        above = self.stack[-1]
        names, main = set(), tag in ("article", "main")
        for mark, value in MARKS.findall(attributes) if attributes else ():
            own = value.strip("\"'").lower().split()
            names.update(own)
            main = main or mark.lower() == "role" and "main" in own
        if tag == "article" and any(map(says_reply, names)):
            main = False
        outer = not (above.inside or main)
        drop = above.drop or tag in DROP or tag == "header" and outer
        inside = above.inside or main and not drop
        node = Node(tag, len(self.blocks), drop, inside)
        node.main = main and not drop
        node.named = not (main or drop or tag in ("html", "body")) and any(map(says_drop, names))
        self.stack.append(node)
        self.opened[tag] += 1
        if tag in SCOPE:
            self.scopes.append(Counter())
        else:
            self.scopes[-1][tag] += 1
        if tag in VOID:
            self.close()

    def end(self, tags: set[str], scope: frozenset[str]) -> None:
        """Close the innermost open element of ``tags``, if none of ``scope`` lies above it.

        ``scope`` is SCOPE or nothing. Tags that are not open cost no search.
        """
        known = self.scopes[-1] if scope else self.opened
        if not any(known[tag] for tag in tags):
            return
        for depth in range(len(self.stack) - 1, 0, -1):
            tag = self.stack[depth].tag
            if tag in tags:
                while len(self.stack) > depth:
                    self.close()
                return
            if tag in scope:
                return

    def read(self, html: str) -> None:
        at = 0
        lower = ""
        while found := TOKEN.match(html, at):
            at = found.end()
            closing, tag, attributes, text = found.groups()
            if text is not None:
                self.text.append(text)
                continue
            if tag is None:
                continue
            tag = tag.lower()
            if closing:
                if tag in BLOCK or tag in DROP:
                    self.flush()
                self.end({tag}, frozenset())
            elif tag == "br":
                self.text.append(" ")
            elif tag in ("td", "th"):
                self.text.append(" ")
                self.open(tag, attributes)
            else:
                self.open(tag, attributes)
                if tag in RAW:
                    lower = lower or html.lower()
                    stop = lower.find(f"</{tag}", at)
                    at = len(html) if stop < 0 else stop
        while len(self.stack) > 1:
            self.close()
        self.flush()

    def sizes(self) -> list[int]:
        """Characters that are kept before every block, and in all."""
        sizes = (len(b) if k else 0 for b, k in zip(self.blocks, self.keep))
        return [0, *accumulate(sizes)]

    def drop_named(self) -> None:
        """Drop by name, but for what holds a main element, the article or most of the text."""
        if not self.named:
            return
        upto = self.sizes()
        free = list(zip(self.keep, self.inside))
        for first, end in self.named:
            if not any(first <= a and b <= end for a, b, _ in self.mains):
                free[first:end] = [(False, False)] * (end - first)
        beside = sum(len(b) for b, (k, i) in zip(self.blocks, free) if k and not i)
        best = max(self.mains, key=lambda x: upto[x[1]] - upto[x[0]], default=(0, 0, False))
        if upto[best[1]] - upto[best[0]] <= beside:
            best = None
        spare = [x for x in self.mains if x[2] or x == best]
        for first, end in self.named:
            most = 2 * (upto[end] - upto[first]) > upto[-1]
            # an article with a title elsewhere is the text, however short
            if any(b <= first or end <= a for a, b in self.titled):
                most = False
            if not most and not any(first <= a and b <= end for a, b, _ in spare):
                self.keep[first:end] = [False] * (end - first)

    def count_for(self) -> None:
        """The text by which pages differ (own); leave out subtrees that hold the main text."""
        upto = self.sizes()
        best = max(self.mains, key=lambda x: upto[x[1]] - upto[x[0]], default=None)
        first, end = 0, len(self.blocks)
        if best and 2 * (upto[best[1]] - upto[best[0]]) > upto[-1]:
            first, end = best[:2]
        self.own = [b for b, k in zip(self.blocks[first:end], self.keep[first:end]) if k]
        self.subtrees = [
            (value, a, b, wraps)
            for i, (value, a, b, wraps) in enumerate(self.subtrees)
            if i not in self.holding and not (best and a <= best[0] and best[1] <= b)
        ]

    def signature(self) -> int:
        """Least hash of three words in a row: near copies of a text mostly share it."""
        words = " ".join(self.own).split()
        three = (" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2)))
        return min(map(xxhash.xxh64_intdigest, three)) - (1 << 63)

    def in_article(self) -> list[bool]:
        """Whether each block lies in an article, or in a main element without any."""
        inside = [False] * len(self.blocks)
        articles = [(a, b) for a, b, is_main in self.mains if not is_main]
        for first, end, is_main in self.mains:
            if not is_main or not any(first <= a and b <= end for a, b in articles):
                inside[first:end] = [True] * (end - first)
        return inside

    def main_text(self, template: frozenset[int], wide: frozenset[int] = frozenset()) -> str:
        """The text without subtrees of ``template``, in articles without those of ``wide``."""
        keep = self.keep = list(self.keep)
        inside = self.in_article()
        for value, first, end, wraps in self.subtrees:
            if value in (wide if inside[first] else template) and (wraps or not inside[first]):
                keep[first:end] = [False] * (end - first)
        upto = self.sizes()

        def size(part: tuple) -> int:
            return upto[part[-1]] - upto[part[-2]]

        mains = [(a, b) for a, b, _ in self.mains]
        best = max(mains, key=lambda x: (size(x), x[1] - x[0]), default=(0, 0))
        if 2 * size(best) > upto[-1]:
            mains = [best]
        else:
            for _, first, end, _ in self.subtrees:
                beside = not any(first < b and a < end for a, b in mains)
                if beside and size((first, end)) > 2 * size(best):
                    mains = []
                    break
        if size(best) and mains:
            inside = [False] * len(keep)
            for first, end in mains:
                inside[first:end] = [True] * (end - first)
            keep = [k and i for k, i in zip(keep, inside)]
        return "\n\n".join(b for b, k in zip(self.blocks, keep) if k)


def host_of(url: Column) -> Column:
    """Host of a url in lower case, without a port; empty if there is none."""
    host = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1)
    return F.coalesce(host, F.lit(""))


def _subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in few_at_once(batches):
        hosts, values, pages = [], [], []
        for host, html in zip(batch.column("host").to_pylist(), batch.column("html")):
            page = Page(html.as_py() or "")
            own = {value for value, *_ in page.subtrees}
            # a null subtree stands for the page itself
            hosts += [host] * (len(own) + 1)
            values += [None, *own]
            pages += [page.signature()] * (len(own) + 1)
        yield pa.record_batch(
            [pa.array(hosts, pa.string()), pa.array(values, pa.int64()), pa.array(pages, pa.int64())],
            ["host", "subtree", "page"],
        )


def templates(
    pages: DataFrame, least: int = LEAST_PAGES, share: float = SHARE, wide: float = WIDE
) -> DataFrame:
    """(host, template, wide): the hashes of subtrees on many different pages of each host, and
    of those on many more of them."""
    on = pages.select(host_of(F.col("url")).alias("host"), "html").filter("host != ''")
    found = on.mapInArrow(_subtrees, "host string, subtree long, page long")
    # two steps of partial aggregates; the second is on what the first left of a page
    counts = found.groupBy("host", "subtree", "page").agg(F.lit(1).alias("one"))
    counts = counts.groupBy("host", "subtree").count().filter(F.col("count") >= least)
    counts = materialize(counts, "html-counts")
    sizes = counts.filter("subtree IS NULL").select("host", F.col("count").alias("pages"))
    many = counts.filter("subtree IS NOT NULL").join(sizes, "host")
    many = many.filter(F.col("count") >= share * F.col("pages"))
    spread = F.when(F.col("count") >= wide * F.col("pages"), F.col("subtree"))
    return many.groupBy("host").agg(
        F.collect_list("subtree").alias("template"), F.collect_list(spread).alias("wide")
    )


def main_text(
    pages: DataFrame, least: int = LEAST_PAGES, share: float = SHARE, wide: float = WIDE
) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    site = materialize(templates(pages, least, share, wide), "html-templates")
    kind = pages.schema["page_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few_at_once(batches):
            lists = zip(*(batch.column(c) for c in ("html", "template", "wide")))
            texts = [
                Page(html.as_py() or "").main_text(*(frozenset(x.as_py() or ()) for x in of_host))
                for html, *of_host in lists
            ]
            yield pa.record_batch(
                [
                    batch.column("page_id"),
                    batch.column("url"),
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                ["page_id", "url", "text", "n_chars"],
            )

    rows = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host"))
    return (
        rows.join(site, "host", "left")
        .select("page_id", "url", "html", "template", "wide")
        .mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
    )
