"""Main text of web pages: flat text blocks classified by a decision tree.

A page is cut into flat blocks at its block-level tags. Each block has its word
count and link density, those of the blocks before and after it, and four marks
of the elements that are open around it. A decision tree, fitted by Spark ML on
a small table of labelled blocks, decides which blocks belong to the article.
The tree is a few nodes and travels with the tasks; pages are never shuffled.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Callable

from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isohyet.llm.texts import map_texts

FEATURES = ("words", "link_density", "words_before", "link_density_before", "words_after", "link_density_after",
            "in_article", "in_boilerplate", "is_heading", "page_has_article")

# Fixed values of HTML and of common page templates.
RAW = "script style noscript iframe textarea title".split()
FOREIGN = "svg math".split()
# Their text is not the page's. They end with an element around them, if not before.
HIDDEN = frozenset("template object canvas audio video select datalist optgroup option button".split())
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary table tbody "
    "td tfoot th thead tr ul".split())
CONTAINERS = frozenset("article aside body details dialog div dl fieldset figure footer form header li main menu nav ol "
                       "section table td ul".split()) | HIDDEN
ARTICLE = frozenset("article main".split())
# An article in one of these is a teaser; elsewhere it ends the boilerplate that it stands in.
ASIDE = frozenset("nav footer aside menu dialog".split())
BOILERPLATE = frozenset("nav footer aside form menu dialog header fieldset".split())
HINTS = frozenset(
    "ad ads adv advert advertisement adverts alert author banner bio breadcrumb breadcrumbs byline comment comments "
    "consent cookie cookies copyright cta disclaimer discussion disqus dropdown footer gdpr header legal login masthead "
    "menu meta modal nav navbar navigation newsletter notice notices notification overlay pager pagination paywall popup "
    "promo promoted promotion recommended related replies reply respond search share sharing sidebar signup skip social "
    "sponsor sponsored subscribe tags toolbar topbar trending warning widget widgets".split())
# The main name of a class or id is its last part that is not one of these.
PLAIN = frozenset("area block body box container content inner item items link links list outer section wrap wrapper".split())
# Names that begin so tell of what is elsewhere on the page, or of the whole page.
STATES = frozenset("has with without no not non is page".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert form menu menubar".split())

# Inside a tag: anything but its end; an open quote runs to the next one or to the end of the page.
QUOTED = r"\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z)"
INSIDE = rf"(?:[^>\"']|{QUOTED})*+"
UNCLOSED = rf"(?:[^>\"'/]|/(?!>)|{QUOTED})*+"  # nor a slash that ends the element
TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))"
    r"|<(?P<foreign>" + "|".join(FOREIGN) + rf")\b{UNCLOSED}(?:/>|>.*?(?:</(?P=foreign)\b[^>]*+(?:>|\Z)|\Z)|\Z)"
    r"|<(?P<raw>" + "|".join(RAW) + rf")\b{INSIDE}(?:>.*?(?:</(?P=raw)\b[^>]*+(?:>|\Z)|\Z)|\Z)"
    rf"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>{INSIDE})(?:>|\Z)"
    r"|<[!?/][^>]*+(?:>|\Z)",
    re.S | re.I)
ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
PARTS = re.compile(r"[A-Za-z][a-z]*|[A-Z]+")


def is_hint(name: str) -> bool:
    """Whether a class or id names boilerplate."""
    parts = [p.lower() for p in PARTS.findall(name)]
    main = next((p for p in reversed(parts) if p not in PLAIN), "")
    return main in HINTS and parts[0] not in STATES


def marks_of(tag: str, attrs: str, in_article: bool) -> tuple[bool, bool, bool]:
    """Whether an element opens an article, whether it opens boilerplate, and whether it ends the boilerplate around it."""
    article = tag in ARTICLE
    # A header inside an article holds the article's own heading.
    boilerplate = tag in BOILERPLATE and not (tag == "header" and in_article)
    named = False
    if tag not in ("body", "html", "main"):
        for name, *values in ATTRIBUTE.findall(attrs):
            value = "".join(values)
            if name.lower() == "role":
                named |= value.lower() in ROLES
                article |= value.lower() in ("main", "article")
            else:
                named |= any(map(is_hint, value.split()))
    # Names of an article tell of its topics too: they do not make it boilerplate, but a comment stays one.
    return article, boilerplate or named and tag not in ARTICLE, article and not boilerplate and not named


class Block:
    __slots__ = ("text", "words", "linked", "article", "boilerplate", "heading")

    def __init__(self, text, linked, article, boilerplate, heading):
        self.text, self.words, self.linked = text, text.count(" ") + 1, linked
        self.article, self.boilerplate, self.heading = article, boilerplate, heading

    @property
    def link_density(self) -> float:
        return self.linked / self.words


def blocks_of(page: str) -> list[Block]:
    """The flat text blocks of a page, in page order; tags, comments and raw elements are gone."""
    blocks: list[Block] = []
    # Name, opens an article, is in boilerplate, is in an aside, is hidden: the last three hold for all that is inside.
    stack: list[tuple[str, bool, bool, bool, bool]] = []
    open_tags: Counter[str] = Counter()
    open_shown: Counter[str] = Counter()  # those outside of all hidden elements
    articles = 0
    boilerplate = aside = hidden = False
    parts: list[str] = []
    linked: list[str] = []
    in_link, heading = False, False

    def cut() -> None:
        nonlocal parts, linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                words = len(html.unescape("".join(linked)).split())
                blocks.append(Block(text, words, articles > 0, boilerplate, heading))
        parts, linked = [], []

    def take(text: str) -> None:
        if text and not hidden:
            parts.append(text)
            if in_link:
                linked.append(text)

    at = 0
    for m in TOKEN.finditer(page):
        take(page[at:m.start()])
        at = m.end()
        tag = (m["tag"] or "").lower()
        close = bool(m["close"])
        if tag == "a":
            if close or not hidden:
                in_link = not close
                linked.append(" ")
        elif tag in CONTAINERS and close:
            # A hidden element ends with those around it.
            if tag not in HIDDEN and (not hidden or open_shown[tag] and open_tags[tag] == open_shown[tag]):
                cut()
                heading = False
            if open_tags[tag]:
                name = ""
                while name != tag:
                    name, article, *_, own_hidden = stack.pop()
                    open_tags[name] -= 1
                    open_shown[name] -= not own_hidden
                    articles -= article
                boilerplate, aside, hidden = stack[-1][2:] if stack else (False, False, False)
        elif tag in CONTAINERS:
            if tag not in HIDDEN and not hidden:
                cut()
                heading = False
            if tag == "option" and stack and stack[-1][0] == "option":
                continue
            article, opens, ends = marks_of(tag, m["attrs"], articles > 0)
            boilerplate = opens or boilerplate and (aside or not ends)
            aside = aside or tag in ASIDE
            hidden = hidden or tag in HIDDEN
            stack.append((tag, article, boilerplate, aside, hidden))
            open_tags[tag] += 1
            open_shown[tag] += not hidden
            articles += article
        elif tag in BLOCKS and (not hidden or close and stack[-1][0] in ("option", "optgroup")):
            while stack and stack[-1][4] and stack[-1][0] in ("option", "optgroup"):
                name = stack.pop()[0]
                open_tags[name] -= 1
                boilerplate, aside, hidden = stack[-1][2:] if stack else (False, False, False)
            if not hidden:
                cut()
                heading = tag[0] == "h" and tag[1:].isdigit() and not close or heading and tag == "br"
    take(page[at:])
    cut()
    return blocks


def features_of(blocks: list[Block]) -> list[tuple[float, ...]]:
    has_article = float(any(b.article for b in blocks))
    out = []
    for i, b in enumerate(blocks):
        before, after = blocks[i - 1] if i else None, blocks[i + 1] if i + 1 < len(blocks) else None
        out.append((
            float(b.words), b.link_density, float(before.words) if before else 0.0,
            before.link_density if before else 0.0, float(after.words) if after else 0.0,
            after.link_density if after else 0.0, float(b.article), float(b.boilerplate), float(b.heading), has_article,
        ))
    return out


def fit_tree(spark: SparkSession, labelled: list[tuple[tuple[float, ...], int]], max_depth: int = 6) -> tuple:
    """Fit a decision tree on labelled blocks; nested (feature, threshold, left, right), leaves are 0 or 1."""
    rows = [(Vectors.dense(f), float(label)) for f, label in labelled]
    table = spark.createDataFrame(rows, ["features", "label"])
    model = DecisionTreeClassifier(maxDepth=max_depth, minInstancesPerNode=2, seed=7).fit(table)

    def walk(node) -> tuple | int:
        if node.subtreeDepth() == 0:
            return int(node.prediction())
        split = node.split()
        return split.featureIndex(), split.threshold(), walk(node.leftChild()), walk(node.rightChild())

    return walk(model._java_obj.rootNode())


def decide(tree, features: tuple[float, ...]) -> int:
    while isinstance(tree, tuple):
        tree = tree[2] if features[tree[0]] <= tree[1] else tree[3]
    return tree


def main_text(page: str, tree) -> tuple[str, int, int]:
    """The article's text, the blocks kept and all blocks."""
    blocks = blocks_of(page)
    kept = [b.text for b, f in zip(blocks, features_of(blocks)) if decide(tree, f)]
    return " ".join(kept), len(kept), len(blocks)


def extract(pages: DataFrame, tree=None, id_col: str = "page_id", url_col: str = "url",
            html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars, n_kept, n_blocks for every row.

    A null or empty page has an empty text. Repeated rows give repeated
    results, null ids and urls stay null, other columns are left out.
    """
    if tree is None:
        from isohyet.llm.block_labels import labelled_blocks

        tree = fit_tree(pages.sparkSession, labelled_blocks())
    columns = pages.select(
        F.struct(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url")).alias("key"),
        F.coalesce(F.col(html_col), F.lit("")).alias("html"))

    def start() -> Callable:
        def work(keys, texts):
            got = [main_text(t, tree) for t in texts]
            return [[k["page_id"] for k in keys], [k["url"] for k in keys], [g[0] for g in got],
                    [len(g[0]) for g in got], [g[1] for g in got], [g[2] for g in got]]

        return work

    return map_texts(columns, "page_id long, url string, text string, n_chars long, n_kept int, n_blocks int", start)
