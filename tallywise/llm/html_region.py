"""HTML extraction: the best contiguous region of a page by maximum-scoring subsequence.

A page becomes a sequence of tokens: words, and the tags between them. Words
score by where they stand, mostly positive, tags mostly negative; one linear
scan finds the contiguous run of tokens with the largest sum, and the blocks
whose words lie in it are the main text. The weights are log odds learned from
labelled pages: of the ``TRAINING_PAGES`` pages with the smallest hash of id and
url those whose markup has exactly one ``article`` element (its content is the
label), plus the small hand-labelled pages below, which show elements that a
table may lack. Every labelled page counts twice, as it is and as if its
container's tags were plain, so the weights also work where nothing is marked.

Elements that are never main text (scripts, menus, forms, asides, adverts,
notices, comments and so on, by element, ``role`` or words of class and id)
are one token each, whatever their length: their words neither help nor hinder
the scan, and never reach the text. A ``header`` counts as such outside of an
article only. ``main``, or an ``article`` outside of comments and asides, ends
any such element that still stands open around it (pages leave them open).

Blocks: text between block-level tags; inside one, white space becomes one
space; ``br`` is white space, inline tags are nothing. Blocks are joined by one
space. Character references are decoded as HTML5 says (also without
semicolon). Nothing is cut, and a block is taken whole.

Defined cases. Null or empty html, or no positive region: empty text. Text
outside any element counts as a block. Tags left open end with the page; a tag
without ``>`` ends the page, a comment without end too. Ties: the first, then
the longest region. Repeated rows are each extracted. Very long pages take
memory and time in proportion to their length. An empty table gives no rows;
without labelled pages the hand-labelled ones give the weights. Extra columns
pass through ``with_main_text``; added names get a leading underscore where the
table has them already.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywise.llm.common import fresh, with_text_columns

# Kinds of HTML elements.
BLOCK = set("""address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer
form h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol optgroup option p pre section select summary table
tbody td tfoot th thead title tr ul video audio br""".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes".split())
NEVER = {"script": "code", "style": "code", "template": "code", "noscript": "code", "svg": "code", "math": "code",
         "iframe": "code", "object": "code", "canvas": "code", "noembed": "code", "noframes": "code", "xmp": "code",
         "head": "head", "title": "head", "nav": "menu", "menu": "menu", "footer": "footer", "aside": "side",
         "form": "form", "select": "form", "textarea": "form", "button": "form", "fieldset": "form", "datalist": "form",
         "dialog": "notice", "header": "header"}
ROLES = {"navigation": "menu", "menu": "menu", "menubar": "menu", "banner": "header", "contentinfo": "footer",
         "complementary": "side", "search": "form", "form": "form", "alert": "notice", "dialog": "notice",
         "alertdialog": "notice", "status": "notice"}
# Words in class or id that name what an element is for.
HINTS = {"menu": "nav navbar navigation menu menus breadcrumb breadcrumbs pagination pager toolbar toc skip skiplink topbar",
         "header": "header masthead banner siteheader",
         "footer": "footer colophon copyright",
         "side": "sidebar side aside related recommended recommendations widget widgets share sharing social trending teaser teasers",
         "ad": "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion adsense",
         "notice": "cookie cookies consent notice notices gdpr popup modal overlay paywall alert newsletter subscribe subscription",
         "form": "form search login signup signin",
         "comments": "comment comments commentlist disqus reply replies respond discussion"}
#: Words beside a hint that take it back: the article's own header, a wrapper with a sidebar.
OWN, UNDONE = {"article", "post", "entry", "content", "story", "main"}, {"has", "with", "no", "without", "not"}
HINT = {w: role for role, words in HINTS.items() for w in words.split()}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
CONTAINERS = ("article", "main")
IN_HEAD = set("meta title link style script base noscript template".split())
PLAIN_TEXT = set("p li td th dd dt blockquote pre figcaption".split())
KNOWN = BLOCK | VOID | RAW | set(NEVER) | set("""a abbr b bdi bdo cite code data del dfn em font i ins kbd label mark q s samp
small span strong sub sup time tt u var""".split())

_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*+"[^"]*"|=\s*+'[^']*'|=)*+)>""")
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""")
_LETTERS = re.compile("[a-z]+|[A-Z][a-z]*|[A-Z]+")

# Labelled pages written by hand: the content is what stands in the element with data-label.
EXAMPLES = [
    """<body><header><a href="/">Site</a><p>News of the town</p></header><div class="cookie-notice"><p>We use cookies.</p></div>
    <div data-label="1"><h1>Title of it</h1><p>First paragraph of the text, with <a href="/x">a link</a> and more words.</p>
    <ul><li>one item of a list</li><li>and another item</li></ul><p>Second paragraph of the same text, rather longer than
    the first one was.</p><aside>See also these</aside><blockquote>Someone said so.</blockquote><p>The end.</p></div>
    <div><a href="/1">Older</a> <a href="/2">Newer</a></div><section id="comments"><p>I like this text a lot.</p></section></body>""",
    """<body><div><ul><li><a href="/a">Start</a></li><li><a href="/b">Shop</a></li></ul></div><div><span>Log in</span></div>
    <div data-label="1"><h2>A heading</h2><p>Words of the page stand in paragraphs like this one, one after another.</p>
    <table><tr><td>Cell one</td><td>Cell two</td></tr></table><p>More words follow after the table, and then the page is
    over.</p></div><form><label>Mail</label><button>Send</button></form><div><span>Tel. 1 2 3</span></div></body>""",
    """<body><div class="sidebar"><p>Popular now: many people read this.</p></div><section data-label="1"><h1>Report</h1>
    <p>What happened, and where, and when it did.</p><p>What the others say about all of it.</p><div class="ad">Buy this
    now, it is cheap.</div><p>What may come of it in the next days.</p><pre>some text set as it is</pre></section>
    <ul><li><a href="/r1">Related one</a></li><li><a href="/r2">Related two</a></li></ul><div><a href="/tos">Terms</a>
    <a href="/help">Help</a></div></body>""",
    """<body><div><p>Welcome to these pages of ours, which are free for all to read.</p><span>Menu</span></div><ul><li>Plain entry
    of a list</li><li><a href="/1">Linked entry</a></li></ul><article data-label="1"><header><h1>Title of the article</h1>
    </header><p>The text of it begins here and goes on.</p><p>It goes on with <a href="/l">links</a> now and then.</p>
    <ul><li>first point</li><li>second point</li></ul><h2>Part two</h2><p>It ends here.</p><div>In a plain element.</div>
    </article><div>All words that stand here belong to no article.</div><p>Neither do these words here, written below it.</p>
    <h3>More of it</h3><table><tr><td>one</td><td>two</td></tr></table></body>""",
]
#: How often each of them counts.
EXAMPLE_WEIGHT = 5
#: Pages to learn from, at most (more only where ids and urls repeat).
TRAINING_PAGES = 5000
#: Added to both sides of every feature's count: how many tokens it takes to trust a weight.
PRIOR = 4.0
#: Bounds of a weight: no single token decides a page.
STEEPEST = 6.0
#: What a feature is worth before any page is seen: the share of its tokens that is content.
BEFORE = {"w:in": 0.95, "w:none": 0.7, "w:none_link": 0.25, "w:out": 0.05, "t": 0.35, "x": 0.25}
#: A tag never scores above this, a never-main element never below the other.
TAG_AT_MOST, NEVER_AT_LEAST = -0.05, -2.0


def _role(tag: str, attributes: str) -> str:
    """What an element is for, as far as its name, role, class and id say; '' if they don't."""
    found = NEVER.get(tag, "")
    if attributes and tag not in ("html", "body", "main") and not found:
        for name, value in _ATTRIBUTE.findall(attributes):
            name, value = name.lower(), value.strip("\"'")
            if name == "role":
                found = found or ROLES.get(value.strip().lower(), "")
            elif name in ("class", "id"):
                found = found or _hint([x.lower() for x in _LETTERS.findall(value)])
            elif name == "style" and re.search(r"display\s*:\s*none", value, re.I):
                found = found or "code"
        if not found and re.search(r"(?<![\w-])hidden(?![\w=-])", re.sub(r"""=\s*("[^"]*"|'[^']*')""", "", attributes)):
            found = "code"
    return found


def _hint(words: list[str]) -> str:
    for at, word in enumerate(words):
        role = HINT.get(word, "")
        if role and not (at and words[at - 1] in UNDONE) and not (role in ("header", "footer") and OWN.intersection(words)):
            return role
    return ""


def events(page: str) -> Iterator[tuple[str, str, str]]:
    """('text', raw text, ''), ('open', tag, attributes) and ('close', tag, '') in page order, in linear time."""
    at, end, text_from = 0, len(page), 0
    while True:
        i = page.find("<", at)
        if i < 0:
            break
        m = _TAG.match(page, i)
        if m is None and not page.startswith(("<!", "<?", "</"), i):
            if page[i + 1:i + 2].isascii() and page[i + 1:i + 2].isalpha():  # a tag that never ends
                if text_from < i:
                    yield "text", page[text_from:i], ""
                return
            at = i + 1  # a plain sign
            continue
        if text_from < i:
            yield "text", page[text_from:i], ""
        if m is None:
            if page.startswith("<!--", i):
                stop = page.find("-->", i + 2)
                at = end if stop < 0 else stop + 3
            else:
                stop = page.find(">", i)
                at = end if stop < 0 else stop + 1
            text_from = at
            continue
        tag, at = m[2].lower(), m.end()
        yield ("close" if m[1] else "open"), tag, m[3]
        text_from = at
        if tag in RAW and not m[1]:
            closing = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(page, at)
            at = text_from = closing.start() if closing else end
            yield "close", tag, ""
    if text_from < end:
        yield "text", page[text_from:], ""


class _Page:
    """One pass over a page: its tokens, and what is open while it is read."""

    def __init__(self, page: str):
        self.tokens: list[tuple] = []  # kind, in an article, rest, words, block, text, labelled, in main
        self.stack: list[list] = []  # tag, role, labelled, kind of text it holds
        self.named: Counter = Counter()  # open elements by tag
        self.shut: list[int] = []  # places in the stack of elements that are never main text
        self.barred = 0  # of these, the ones that no article ends
        self.block = self.labels = self.articles = self.mains = 0
        for what, name, more in events(page):
            if what == "text":
                self.text(name)
            elif what == "open":
                self.open(name, more)
            else:
                self.close(name)

    def pop(self, n: int) -> None:
        while len(self.stack) > n:
            tag, role, label, _ = self.stack.pop()
            self.named[tag] -= 1
            if role:
                self.shut.pop()
                self.barred -= role in ("comments", "side", "code", "head")
            self.labels -= label

    def mark(self, kind: str, rest: str) -> None:
        if not self.shut:
            self.tokens.append((kind, self.named["article"] > 0, rest, 0, -1, "", self.labels > 0, self.named["main"] > 0))

    def text(self, raw: str) -> None:
        if self.shut:
            return
        text = html.unescape(raw) if "&" in raw else raw
        holds = "link" if self.named["a"] else self.stack[-1][3] if self.stack else "none"
        self.tokens.append(("w", self.named["article"] > 0, holds, len(text.split()), self.block, text, self.labels > 0,
                            self.named["main"] > 0))

    def lift(self) -> None:
        """What is open was left open before the main text."""
        for at in self.shut:
            self.stack[at][1] = ""
        self.shut, self.barred = [], 0

    def end_open(self, name: str) -> None:
        """A new element ends some that are open: the head, a paragraph, a list item."""
        if self.stack and self.stack[-1][0] == "head" and name not in IN_HEAD:
            self.pop(len(self.stack) - 1)
        for ended, by, within in (("p", BLOCK - {"br"}, BLOCK), ("li", {"li"}, {"ul", "ol", "menu"})):
            if name in by and self.named[ended]:
                k = len(self.stack) - 1
                while k >= 0 and self.stack[k][0] != ended and self.stack[k][0] not in within:
                    k -= 1
                if k >= 0 and self.stack[k][0] == ended:
                    self.pop(k)

    def open(self, name: str, more: str) -> None:
        self.end_open(name)
        role = _role(name, more)
        if role == "header" and (self.named["article"] or self.named["main"]):
            role = ""
        container = name in CONTAINERS and not role
        if self.shut and (name in ("main", "body") or container and not self.barred):
            self.lift()
        self.block += name in BLOCK
        self.mark("x" if role else "t", role or "<" + (name if name in KNOWN else "other"))
        if name in VOID:
            return
        article = container and not self.shut and name == "article"
        self.articles += article
        self.mains += container and not self.shut and name == "main"
        above = self.stack[-1][3] if self.stack else "none"
        holds = "heading" if name in HEADINGS else name if name in PLAIN_TEXT else "div" if name in BLOCK else above
        label = article or 'data-label="1"' in more
        if role:
            self.shut.append(len(self.stack))
            self.barred += role in ("comments", "side", "code", "head")
        self.stack.append([name, role, label, holds])
        self.named[name] += 1
        self.labels += label

    def close(self, name: str) -> None:
        self.block += name in BLOCK
        if self.named[name]:
            k = len(self.stack) - 1
            while self.stack[k][0] != name:
                k -= 1
            self.pop(k)
        self.mark("t", (name if name in KNOWN else "other") + ">")

    def features(self, plain: bool = False) -> Iterator[str]:
        """Each token's feature. ``plain``: as if containers were ``div`` elements."""
        holder = 1 if self.articles else 7  # an article, or without any the main element
        far = "none" if plain or not (self.articles or self.mains) else "out"
        for token in self.tokens:
            rest = token[2]
            if plain:
                rest = "<div" if rest in ("<article", "<main") else "div>" if rest in ("article>", "main>") else rest
            yield token[0] + ":" + ("in" if token[holder] and far == "out" else far) + "_" + rest


def count_features(page: str, into: dict[str, list[float]], times: float = 1.0, labelled: bool = False) -> None:
    """Add a labelled page's tokens inside and outside of its content to ``into``; other pages add nothing."""
    read = _Page(page)
    if not labelled and read.articles != 1:
        return
    for plain in (False, True):
        for feature, token in zip(read.features(plain), read.tokens):
            amount = token[3] if token[0] == "w" else 1
            if amount:
                into.setdefault(feature, [0.0, 0.0])[0 if token[6] else 1] += times * amount


def feature_weights(counts: dict[str, list[float]]) -> dict[str, float]:
    """Log odds of content by feature; a tag's never above, a never-main element's never below its bound."""
    return {feature: _weight(feature, *found) for feature, found in counts.items()}


def _weight(feature: str, inside: float = 0.0, outside: float = 0.0) -> float:
    group = feature.split("_")[0]
    share = BEFORE.get(feature, BEFORE.get(group, BEFORE.get(group[0], 0.5)))
    odds = math.log((inside + PRIOR * share) / (outside + PRIOR * (1 - share)))
    if feature[0] == "w":
        return max(-STEEPEST, min(STEEPEST, odds))
    low = NEVER_AT_LEAST if feature[0] == "x" else -STEEPEST
    return max(low, min(TAG_AT_MOST, odds))


def learn_weights(pages: DataFrame, html_column: str = "html") -> dict[str, float]:
    """The weights from the labelled ones of ``TRAINING_PAGES`` pages and the hand-labelled ones (a few hundred numbers)."""
    spot = F.xxhash64("page_id", "url")
    keys = pages.select(spot.alias("spot")).orderBy("spot").limit(TRAINING_PAGES)
    last = keys.agg(F.max("spot")).first()[0]
    counts: dict[str, list[float]] = {}
    for page in EXAMPLES:
        count_features(page, counts, EXAMPLE_WEIGHT, labelled=True)
    if last is None:
        return feature_weights(counts)

    def count(batches):
        found: dict[str, list[float]] = {}
        for batch in batches:
            for page in batch.column(0).to_pylist():
                count_features(page or "", found)
        yield pa.RecordBatch.from_pydict({"feature": list(found), "inside": [v[0] for v in found.values()],
                                          "outside": [v[1] for v in found.values()]},
                                         pa.schema([("feature", pa.string()), ("inside", pa.float64()), ("outside", pa.float64())]))

    learnt = (pages.filter(spot <= last).select(html_column).mapInArrow(count, "feature string, inside double, outside double")
              .groupBy("feature").agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside")))
    for feature, inside, outside in learnt.collect():
        found = counts.setdefault(feature, [0.0, 0.0])
        found[0] += inside
        found[1] += outside
    return feature_weights(counts)


def best_run(scores: list[float]) -> tuple[int, int]:
    """The contiguous run [a, b) with the largest positive sum, the first and then longest of equals; (0, 0) if none."""
    best, found, total, start = 0.0, (0, 0), 0.0, 0
    for at, score in enumerate(scores):
        if total < 0:
            total, start = 0.0, at
        total += score
        if total > best or total == best and found[1] and start == found[0]:
            best, found = total, (start, at + 1)
    return found


def main_text(page: str, weights: dict[str, float]) -> str:
    """The text of the best region's blocks."""
    read = _Page(page)
    scores = [(weights.get(f) if f in weights else _weight(f)) * (t[3] if t[0] == "w" else 1)
              for f, t in zip(read.features(), read.tokens)]
    a, b = best_run(scores)
    kept = {t[4] for t in read.tokens[a:b] if t[3]}
    blocks: dict[int, list[str]] = {}
    for t in read.tokens:
        if t[4] in kept:
            blocks.setdefault(t[4], []).append(t[5])
    return " ".join(" ".join("".join(parts).split()) for parts in blocks.values())


def with_main_text(pages: DataFrame, html_column: str = "html") -> DataFrame:
    """``pages`` with ``text`` and ``n_chars`` of every page's main text."""
    weights = learn_weights(pages, html_column)
    fields = [(fresh(pages, "text"), T.StringType()), (fresh(pages, "n_chars"), T.LongType())]

    def extract(found):
        texts = [main_text(page, weights) for page in found]
        return [texts, [len(t) for t in texts]]

    return with_text_columns(pages, html_column, fields, extract)
