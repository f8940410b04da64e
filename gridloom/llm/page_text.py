"""Main text of web pages by flat text blocks and a decision tree.

A page is read once, tag by tag, into a flat list of text blocks. A block knows its
words, the share of them in links, the same of the blocks before and after it, and
two things that the markup says: whether it stands in an element made for something
else (a menu, a footer, an advert, a form, reader comments), and whether it stands
inside the page's article. A decision tree, trained by MLlib on a small labelled
table of blocks, tells main text from the rest. The tree becomes one column
expression, so blocks never leave their row and nothing is shuffled.

The labelled table is an input; ``labelled`` is the one that comes with the operator:
pages written by hand below, whose main blocks are marked. A class or id counts
only by its whole words (``ASIDE``).

Text: character references are decoded, white space inside a block becomes one space,
blocks are trimmed and joined in page order by one line feed. Line breaks inside a block
are white space. Scripts, styles, titles, templates, comments and markup are never text.
Unclosed and stray tags are closed as browsers do; a page that ends early ends there.

A null or empty page has an empty text, and so has one whose blocks are all rejected.
Rows that are repeated or without an id are extracted alike. Very long pages are read
whole. Ties don't arise. An empty table gives no rows. Other columns, whatever their
names, are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.ml.classification import DecisionTreeClassificationModel, DecisionTreeClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import ship

#: Elements whose content is no text of the page.
SILENT = frozenset("script style title template noscript svg math iframe object audio video canvas head noembed noframes xmp".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that don't end a block of text.
INLINE = frozenset(
    """a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var
    button label meter output progress select textarea option""".split()
) | (SILENT - {"head"})
IN_HEAD = frozenset("title meta link script style base noscript template".split())
#: Elements made for something else than an article, and roles that say the same.
OTHER = frozenset("nav footer aside form button select textarea option datalist dialog menu fieldset legend label".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar status note".split())
#: Words of classes and ids that say it.
ASIDE = frozenset(
    """ad ads adsbygoogle advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices notification alert alerts popup modal overlay
    disclaimer newsletter subscribe subscription signup login register paywall share sharing social follow related recommended recommendations trending popular sidebar rail widget widgets
    nav navbar navigation menu submenu breadcrumb breadcrumbs pagination pager toolbar topbar masthead footer copyright legal comment comments commentlist disqus reply replies respond
    discussion reviews form search tags toc skip""".split()
)
#: Of these, what an article's own class may say.
IN_ARTICLE = frozenset("ad ads advert advertisement sponsored promo comment comments reply".split())
MAIN = frozenset({"article", "main"})
#: Names that a page without such elements gives its article.
MAIN_NAMES = frozenset("article article-body article-content articlebody entry-content post-content post-body story story-body main-content".split())
#: An element that starts here closes these, if they are open within the same container.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"}}
CONTAINERS = frozenset("html body div article main section table ul ol dl td th nav aside header footer form blockquote menu dialog fieldset details figure".split())
SCOPES = frozenset("html table td th template caption".split())


UNFINISHED = re.compile("<[!/?a-zA-Z]")


def says_aside(tag: str, attrs: dict[str, str | None]) -> bool:
    if tag in OTHER or "hidden" in attrs or (attrs.get("role") or "").lower() in ROLES or (attrs.get("aria-modal") or "").lower() == "true":
        return True
    if tag in ("html", "body", "main"):
        return False
    for name in f"{attrs.get('class') or ''} {attrs.get('id') or ''}".split():
        words = re.sub(r"([a-z])([A-Z])", r"\1 \2", name).lower()
        words = re.split(r"[^a-z]+", words)
        if words[0] not in ("has", "no", "not", "with", "without", "is") and not (IN_ARTICLE if tag == "article" else ASIDE).isdisjoint(words):
            return True
    return False


class Blocks(HTMLParser):
    """Flat text blocks of a page: (text, words, words in links, aside, inside the article, marked as main)."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.out: list[list] = []
        self.stack: list[tuple[str, bool, bool, bool]] = [("", False, False, False)]  # tag, aside, in article, marked
        self.open: Counter = Counter()
        self.silent = 0
        self.links = 0
        self.parts: dict[bool, list[tuple[str, bool]]] = {False: [], True: []}  # by whether an inline element sets them aside

    def end_block(self) -> None:
        _, aside, inside, marked = next(x for x in reversed(self.stack) if x[0] not in INLINE)
        for apart, parts in self.parts.items():
            text = " ".join("".join(t for t, _ in parts).split())
            if text:
                words = len(text.split())
                linked = len("".join(t if in_link else " " for t, in_link in parts).split())
                self.out.append([text, words, min(linked, words), aside or apart, inside, marked])
            parts.clear()

    def pop_to(self, at: int) -> None:
        if any(x[0] not in INLINE for x in self.stack[at:]):
            self.end_block()
        for tag, *_ in self.stack[at:]:
            self.open[tag] -= 1
            self.silent -= tag in SILENT
            self.links -= tag == "a"
        del self.stack[at:]

    def last(self, tags: set[str] | frozenset[str], until: frozenset[str]) -> int:
        """Place of the innermost open element of these, not looking beyond ``until``; 0 if there is none."""
        if any(self.open[t] for t in tags):
            for at in range(len(self.stack) - 1, 0, -1):
                if self.stack[at][0] in tags:
                    return at
                if self.stack[at][0] in until:
                    break
        return 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if self.open["head"] and tag not in IN_HEAD and self.stack[-1][0] == "head":
            self.pop_to(len(self.stack) - 1)
        if tag in VOID:
            if tag == "br":
                self.handle_data(" ")
            elif tag == "hr":
                self.end_block()
            return
        given = dict(attrs)
        if tag == "a" and (at := self.last({"a"}, CONTAINERS)):
            self.pop_to(at)
        if tag not in INLINE:
            self.end_block()
            if at := self.last({"p"}, CONTAINERS):
                self.pop_to(at)
            while tag in CLOSES and (at := self.last(CLOSES[tag], CONTAINERS - CLOSES[tag])):
                self.pop_to(at)
        _, aside, inside, marked = self.stack[-1]
        # a header inside the article holds its own title
        header = tag == "header" or "header" in re.split(r"[^a-z]+", f"{given.get('class') or ''} {given.get('id') or ''}".lower())
        aside = aside or says_aside(tag, given) or (header and not inside and tag not in ("html", "body", *MAIN))
        inside = inside or tag in MAIN or (given.get("role") or "").lower() in MAIN or (given.get("itemprop") or "") == "articleBody" or not MAIN_NAMES.isdisjoint(f"{given.get('class') or ''} {given.get('id') or ''}".lower().split())
        self.stack.append((tag, aside, inside, marked or "data-main" in given))
        self.open[tag] += 1
        self.silent += tag in SILENT
        self.links += tag == "a"

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag in ("svg", "math"):
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag == "br":
            self.handle_data(" ")
        elif at := self.last({tag}, CONTAINERS if tag in INLINE else SCOPES - {tag}):
            self.pop_to(at)
        elif tag == "p":
            self.end_block()

    def handle_data(self, data: str) -> None:
        if not self.silent:
            tag, aside, *_ = self.stack[-1]
            block = next(x for x in reversed(self.stack) if x[0] not in INLINE)
            self.parts[tag in INLINE and aside and not block[1]].append((data, self.links > 0))

    def read(self, html: str) -> list[list]:
        self.feed(html)
        if UNFINISHED.match(self.rawdata) and not self.silent:  # a tag or comment that the page's end cuts off
            self.rawdata = ""
        self.close()
        self.end_block()
        return self.out


#: Inputs of the tree, by name, in the order of a block's ``features``.
FEATURES = ("words", "link_density", "words_before", "link_density_before", "words_after", "link_density_after", "aside", "place")


def described(blocks: list[list]) -> list[list[float]]:
    """FEATURES of each block. place: 1 inside the article, 0 on a page without one, -1 outside of it."""
    article = any(b[4] and not b[3] for b in blocks)
    size = [(0.0, 0.0), *((float(b[1]), b[2] / b[1]) for b in blocks), (0.0, 0.0)]
    return [[*size[i + 1], *size[i], *size[i + 2], float(b[3]), float(b[4]) - float(article and not b[4])] for i, b in enumerate(blocks)]


def _words(n: int, word: str = "word") -> str:
    return " ".join([word] * n)


def _links(*sizes: int) -> str:
    return "".join(f'<li><a href="#">{_words(n)}</a></li>' for n in sizes)


def training_pages() -> list[str]:
    """Pages of the usual layouts; ``data-main`` marks what is main text. Only sizes, links and elements matter to the tree."""
    menu, more = f"<nav><ul>{_links(1, 1, 2, 1)}</ul></nav>", f"<aside><h3>More</h3><p>{_words(30)}</p><ul>{_links(6, 8, 7)}</ul></aside>"
    foot = f"<footer><p>{_words(12)}</p><p>{_words(60)}</p></footer>"
    ads = [f'<div class="ad">{_words(n)}</div>' for n in (2, 9, 25, 70)]
    notes = f'<div class="cookie-notice"><p>{_words(22)}</p><button>{_words(1)}</button></div>'
    comments = f'<section class="comments"><article class="comment"><p>{_words(45)}</p></article><p>{_words(3)}</p></section>'
    form = f'<form><label>{_words(2)}</label><p>{_words(15)}</p></form>'
    text = lambda *sizes: "".join(f"<p>{_words(n)}</p>" for n in sizes)
    linked = f'<p>{_words(20)} <a href="#">{_words(3)}</a> {_words(9)}</p>'
    lone = f'<p><a href="#">{_words(5)}</a></p>'
    article = lambda *parts: "<article data-main>" + "".join(parts) + "</article>"
    plain = lambda *parts: '<div id="content" data-main>' + "".join(parts) + "</div>"
    bare_menu, bare_foot = f"<div><ul>{_links(1, 1, 2, 1, 1)}</ul></div>", f"<div><p>{_words(5)}</p><p><a href='#'>{_words(2)}</a></p></div>"
    head = lambda n: f"<h1>{_words(n)}</h1>"
    pages = [
        menu + ads[0] + article(head(6), text(40, 80, 3, 1, 55)) + foot,
        menu + ads[2] + article(head(12), text(120, 300), linked, text(2)) + more + comments + foot,
        ads[3] + article(f"<header>{head(5)}</header>", text(25), ads[1], text(7, 60), notes, text(33)) + form,
        menu + article(head(4), text(30), lone, text(20), f"<ul><li>{_words(4)}</li><li>{_words(9)}</li></ul>") + comments,
        f"<header>{head(3)}{menu}</header><main data-main>{head(7)}{text(50, 2, 90)}</main>" + more + foot,
        notes + bare_menu + plain(head(8), text(60, 45, 70), linked, text(30)) + bare_foot,
        bare_menu + ads[2] + plain(head(5), text(35, 12, 90, 11, 40)) + more + bare_foot + foot,
        bare_menu + plain(text(24, 31, 28)) + comments + form + bare_foot,
        f"<div>{_words(2)}</div><div>{_words(3)}</div>" + bare_menu + plain(head(10), linked, text(18, 26, 110, 16)) + f"<p>{_words(4)}</p>",
        "<div>" + "".join(f'<p><a href="#">{_words(n)}</a> {_words(2)}</p>' for n in (9, 12, 8, 11)) + "</div>" + plain(text(70, 85)) + bare_foot,
        menu + more + form + foot,
    ]
    for n in (1, 3, 8, 20, 60, 200):  # an article of any size, with and without something before and after it
        pages += [article(text(n)), menu + article(head(n), text(n)) + foot, ads[1] + article(lone, text(n, 1), linked, lone, text(n), lone, text(2), lone), f"<div>{text(n)}</div>" + article(text(2, n, 40)) + f"<p>{_words(n)}</p>"]
        pages += [bare_menu + article(text(n), ads[n % 4], comments) + bare_foot]
    for n in (14, 25, 40, 150):  # no article: long blocks with few links, and short ones between or before them
        pages += [plain(text(n)), bare_menu + plain(head(5), text(n, n)) + bare_foot, menu + plain(text(n), linked, text(3, n)) + more, bare_menu + plain(text(n, 2 * n)), plain(head(3), text(n)) + foot]
    return pages


def labelled(spark: SparkSession) -> DataFrame:
    """(features, label): the blocks of ``training_pages``, 1 where they are main text and not set aside."""
    rows = []
    for page in training_pages():
        blocks = Blocks().read(page)
        rows += [(f, int(b[5] and not b[3])) for f, b in zip(described(blocks), blocks, strict=True)]
    return spark.createDataFrame(rows, "features array<double>, label int")


def train(table: DataFrame, depth: int = 5) -> DecisionTreeClassificationModel:
    """A tree from labelled blocks (features array<double>, label int)."""
    rows = table.select(array_to_vector("features").alias("features"), F.col("label").cast("double").alias("label"))
    return DecisionTreeClassifier(maxDepth=depth, maxBins=64, minInstancesPerNode=1, seed=1).fit(rows)


def as_column(model: DecisionTreeClassificationModel, features: Column) -> Column:
    """The tree's decision as an expression on an array of FEATURES: 2^depth comparisons at most."""

    def decide(node) -> Column:
        if node.subtreeDepth() == 0:
            return F.lit(node.prediction() == 1.0)
        split = node.split()
        return F.when(features[split.featureIndex()] <= split.threshold(), decide(node.leftChild())).otherwise(decide(node.rightChild()))

    return decide(model._call_java("rootNode"))


BLOCK = "array<struct<text:string,features:array<double>>>"
#: Pages that are Python objects at a time.
AT_ONCE = 64


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("text", pa.string()), ("features", pa.list_(pa.float64()))]))
    for batch in batches:
        for at in range(0, batch.num_rows, AT_ONCE):
            part = batch.slice(at, AT_ONCE)
            pages = [Blocks().read(h) if h else [] for h in part.column("html").to_pylist()]
            found = [[{"text": b[0], "features": f} for b, f in zip(p, described(p), strict=True)] for p in pages]
            yield pa.RecordBatch.from_arrays([*part.columns[:2], pa.array(found, kind)], names=["page_id", "url", "blocks"])


def blocks(pages: DataFrame) -> DataFrame:
    """page_id, url and blocks, the page's text blocks with their features in page order."""
    ship(pages.sparkSession)
    given = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return given.mapInArrow(_read, f"page_id long, url string, blocks {BLOCK}")


def main_text(pages: DataFrame, table: DataFrame | None = None) -> DataFrame:
    """Per row: page_id, url, text and n_chars. ``table``: labelled blocks to train on, ``labelled`` by default."""
    model = train(labelled(pages.sparkSession) if table is None else table)
    kept = F.filter("blocks", lambda b: as_column(model, b["features"]))
    out = blocks(pages).select("page_id", "url", F.array_join(F.transform(kept, lambda b: b["text"]), "\n").alias("text"))
    return out.withColumn("n_chars", F.char_length("text").cast("long"))
