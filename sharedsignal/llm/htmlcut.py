"""Main text of web pages by a minimum cut.

A page is read into blocks of text.  Each block pays one price for being called
content and another for being called boilerplate, from a classifier over its words,
links, tag and the names on its path.  Neighbours in page order and blocks close in
the tree pay for having different labels; closeness goes through one node per
container, with capacities that fall with distance.  Blocks and containers, a source
(content) and a sink (boilerplate) are a flow network, and its minimum cut is the
cheapest labelling.

Blocks that can't be text of the article (scripts, styles, forms, navigation and so on,
by element or by role) are held to the sink.  A class or id that names boilerplate is a
price, lower where the element also has a good name or holds the page's paragraphs and
no part with a good name does; words such as no-sidebar are no names.
"""

from __future__ import annotations

import html as html_entities
import re
from collections import deque

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import pick, table

# Element and attribute names of HTML and of common page templates.
SKIP = frozenset("script style noscript template svg math iframe object canvas audio video select option textarea button head".split())
RAW = frozenset("script style textarea title noscript iframe template".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var wbr img".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BOILER = frozenset("nav header footer aside form menu dialog fieldset".split())
MAIN = frozenset("article main".split())
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 "
                     "h6 header hr main menu nav ol p pre section table ul".split())
BAD_NAMES = re.compile(r"(?:^|[\s_-])(?:ad|ads|advert\w*|banner|sponsor\w*|promo\w*|nav\w*|menu\w*|breadcrumbs?|side-?bar\w*|foot(?:er)?|"
                       r"masthead|site-?header|page-?header|top-?bar|cookies?|consent|gdpr|notice\w*|alert|popup|modal|overlay|newsletter|subscri\w*|"
                       r"signup|login|share|sharing|social|related|recommend\w*|comments?|comment-?list|disqus|respond|replies|reply|"
                       r"reader-?comments?|discussion|pagination|pager|toolbar|widget\w*|skip-?link|copyright|legal|disclaimer|search\w*|tags?|tag-?cloud)"
                       r"(?:$|[\s_-])", re.I)
GOOD_NAMES = re.compile(r"(?:^|[\s_-])(?:article\w*|post|post-?body|entry|entry-?content|content|main|body-?text|story|text|prose)(?:$|[\s_-])", re.I)

#: Parts of a class that say what the page has or lacks.
HAS = re.compile(r"(?:^|[-_])(?:no|has|have|with|without|hide|show)[-_].*", re.I)

TAG = re.compile(r"<(?:!--(.*?)(?:-->|$)|([/!?]?)([a-zA-Z][^\s/>]*)?((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>?)", re.S)
ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role|hidden|style|aria-hidden|itemprop)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
SPACE = re.compile(r"\s+")

#: Prices of the cut, in thousandths.
NEXT, NEAR, HELD = 500, 900, 1 << 40
#: Price of a boilerplate name: in general, and on an element that holds the page's paragraphs.
NAMED, WRAPPER = 9.0, 1.5
#: Least words of a paragraph, and of an article.
PARAGRAPH, ARTICLE = 10, 40


class Node:
    __slots__ = ("tag", "parent", "bad", "good", "named", "links", "depth")

    def __init__(self, tag, parent, bad, good, named=False):
        self.tag, self.parent, self.bad, self.good, self.named = tag, parent, bad, good, named
        self.depth = parent.depth + 1 if parent else 0


class Block:
    __slots__ = ("text", "linked", "node", "leaf")

    def __init__(self, text, linked, node, leaf):
        self.text, self.linked, self.node, self.leaf = text, linked, node, leaf


def blocks_of(page: str) -> list[Block]:
    """Text blocks of a page in order; unclosed and misnested elements are tolerated.

    Inline elements do not end a block; every other element, and ``br``, does.
    """
    root = Node("", None, False, False)
    stack, out, parts = [root], [], []
    linked = anchor = at = 0
    hidden = 0  # depth of the outermost skipped element, else 0

    def close():
        nonlocal linked
        if parts:
            text = SPACE.sub(" ", html_entities.unescape("".join(parts))).strip()
            parts.clear()
            if text:
                node = stack[-1]
                leaf = node
                while leaf.parent and leaf.tag in INLINE:
                    leaf = leaf.parent
                out.append(Block(text, linked, leaf, leaf.tag))
        linked = 0

    end = len(page)
    while at < end:
        lt = page.find("<", at)
        m = TAG.match(page, lt) if lt >= 0 else None
        plain = lt >= 0 and (m is None or (m.group(1) is None and not m.group(3) and m.group(2) not in ("!", "?") and not page.startswith("<!--", lt)))
        stop = end if lt < 0 else lt + 1 if plain else lt
        if stop > at and not hidden:
            parts.append(page[at:stop])
            if anchor:
                linked += stop - at
        if lt < 0:
            break
        if plain:
            at = stop
            continue
        at = m.end()
        if m.group(3) is None:
            continue
        slash, name, attributes = m.group(2), m.group(3).lower(), m.group(4) or ""
        if slash in ("!", "?"):
            continue
        if slash == "/":
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == name:
                    if name not in INLINE or any(s.tag not in INLINE for s in stack[k:]):
                        if name in INLINE:  # an inline end tag does not close blocks inside it
                            break
                        close()
                    del stack[k:]
                    if hidden >= k:
                        hidden = 0
                    break
            if name == "a":
                anchor = 0
            if name == "p" or name == "br":
                close()
            continue
        if name not in INLINE:
            close()
            if name in CLOSES_P:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].tag == "p":
                        del stack[k:]
                        break
                    if stack[k].tag not in INLINE:
                        break
            elif name in ("li", "dt", "dd", "tr", "td", "th", "option"):
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].tag == name:
                        del stack[k:]
                        break
                    if stack[k].tag in ("ul", "ol", "dl", "table", "menu", "tbody", "thead") or (name in ("td", "th") and stack[k].tag == "tr"):
                        break
        if name in VOID or attributes.endswith("/") and name in ("svg", "path"):
            continue
        if name in RAW:
            close_at = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
            at = close_at.end() if close_at else end
            continue
        bad = good = off = named = False
        if attributes:
            for a in ATTRIBUTE.finditer(attributes):
                key, value = a.group(1).lower(), a.group(2) or a.group(3) or a.group(4) or ""
                if key == "hidden" or (key == "aria-hidden" and value == "true") or (key == "style" and "display:none" in value.replace(" ", "")):
                    off = True
                elif key == "role":
                    bad |= value.lower() in ("navigation", "banner", "contentinfo", "complementary", "search", "form", "menu", "dialog", "alert")
                    good |= value.lower() in ("main", "article")
                elif key in ("class", "id"):
                    for word in value.split():
                        word = HAS.sub("", word)
                        if BAD_NAMES.search(word):
                            named = True
                        else:
                            good |= bool(GOOD_NAMES.search(word))
                elif key == "itemprop":
                    good |= value.lower() == "articlebody"
        parent = stack[-1]
        if name in MAIN or name in ("html", "body"):  # their class names describe the page, not the part
            bad = named = False
        stack.append(Node(name, parent, bad or name in BOILER, (good and not bad) or name in MAIN, named))
        if name == "a":
            anchor = 1
        if (name in SKIP or off) and not hidden:
            close()
            hidden = len(stack) - 1
    close()
    return out


def name_prices(blocks: list[Block], inside: list[bool]) -> dict:
    """{element with a boilerplate name: price}.

    An element's price falls with its share of the words in paragraphs, unless parts with
    a good name and no boilerplate name hold an article, and by half with a good name.
    """
    under, every, article = {}, 0, 0
    for b, within in zip(blocks, inside):
        words, held, names, node = b.text.count(" ") + 1, False, [], b.node
        while node is not None:
            held |= node.bad
            if node.named:
                names.append(node)
            node = node.parent
        plain = 0 if held or words < PARAGRAPH or b.linked > 0.3 * len(b.text) else words
        every += plain
        article += plain if within and not names else 0
        for node in names:
            under[node] = under.get(node, 0) + plain
    out = {}
    for node, words in under.items():
        share = words / every if words >= ARTICLE > article else 0.0
        out[node] = min(NAMED / 2 if node.good else NAMED, NAMED * (1 - share) + WRAPPER * share)
    return out


def prices(block: Block, inside: bool, any_main: bool, names: dict) -> tuple[int, int]:
    """(price of calling it boilerplate, price of calling it content), in thousandths."""
    words = block.text.count(" ") + 1
    share = min(1.0, block.linked / max(1, len(block.text)))
    bad, good, node, heads, named = False, False, block.node, False, 0.0
    while node is not None:
        heads |= node.tag == "header" and not bad
        bad |= node.bad and node.tag != "header"
        good |= node.good
        named = max(named, names.get(node, 0.0))
        node = node.parent
    bad |= heads and not good  # a header inside the article heads the article, not the site
    if bad:
        return 0, HELD
    score = 0.2 + 0.08 * min(words, 40) - 4.0 * share
    score += 2.5 if good else -1.5 if any_main else 0.0
    score += 1.2 if block.leaf in ("p", "h1", "h2", "h3", "blockquote", "pre") else 0.0
    score += 0.5 if block.text[-1] in ".!?:;…。”\"" else 0.0
    score = max(-6.0, min(6.0, score - named))
    return (int(1000 * score), 0) if score > 0 else (0, int(-1000 * score))


class Flow:
    """Maximum flow by shortest augmenting phases; node 0 is the source, node 1 the sink."""

    def __init__(self, n):
        self.edges = [[] for _ in range(n)]
        self.to, self.room = [], []

    def add(self, a, b, there, back=0):
        self.edges[a].append(len(self.to))
        self.to.append(b)
        self.room.append(there)
        self.edges[b].append(len(self.to))
        self.to.append(a)
        self.room.append(back)

    def _levels(self):
        level = [-1] * len(self.edges)
        level[0] = 0
        queue = deque([0])
        while queue:
            v = queue.popleft()
            for e in self.edges[v]:
                w = self.to[e]
                if self.room[e] and level[w] < 0:
                    level[w] = level[v] + 1
                    queue.append(w)
        return level

    def cut(self) -> list[bool]:
        """After saturating the network: which nodes are on the source's side."""
        while True:
            level = self._levels()
            if level[1] < 0:
                return [x >= 0 for x in level]
            at = [0] * len(self.edges)
            path, v = [], 0
            while True:
                if v == 1:
                    least = min(self.room[e] for e in path)
                    first = None
                    for k, e in enumerate(path):
                        self.room[e] -= least
                        self.room[e ^ 1] += least
                        if first is None and not self.room[e]:
                            first = k
                    v = self.to[path[first] ^ 1]
                    del path[first:]
                    continue
                edges = self.edges[v]
                while at[v] < len(edges):
                    e = edges[at[v]]
                    if self.room[e] and level[self.to[e]] == level[v] + 1:
                        break
                    at[v] += 1
                if at[v] < len(edges):
                    path.append(edges[at[v]])
                    v = self.to[path[-1]]
                elif v == 0:
                    break
                else:
                    level[v] = -1
                    e = path.pop()
                    v = self.to[e ^ 1]
                    at[v] += 1


def label(blocks: list[Block]) -> list[bool]:
    """Whether each block is content: the minimum cut."""
    if not blocks:
        return []

    def within_main(node):
        while node is not None:
            if node.good:
                return True
            node = node.parent
        return False

    inside = [within_main(b.node) for b in blocks]
    any_main = any(inside)
    names = name_prices(blocks, inside)
    number = {}
    for b in blocks:  # containers that hold blocks, up to the root
        node = b.node
        while node is not None and node not in number:
            number[node] = 2 + len(blocks) + len(number)
            node = node.parent
    flow = Flow(2 + len(blocks) + len(number))
    held = []
    for k, b in enumerate(blocks):
        keep, drop = prices(b, inside[k], any_main, names)
        held.append(drop == HELD)
        if keep:
            flow.add(0, 2 + k, keep)
        if drop:
            flow.add(2 + k, 1, drop)
    for k, b in enumerate(blocks):
        if held[k]:
            continue
        if k + 1 < len(blocks) and not held[k + 1]:
            flow.add(2 + k, 3 + k, NEXT, NEXT)
        flow.add(2 + k, number[b.node], NEAR, NEAR)
    for node, k in number.items():
        if node.parent is not None:
            flow.add(k, number[node.parent], NEAR // (2 + node.depth), NEAR // (2 + node.depth))
    return flow.cut()[2:2 + len(blocks)]


def main_text(page: str | None) -> str:
    """The article of a page: its content blocks in order, joined by one space."""
    if not page:
        return ""
    blocks = blocks_of(page)
    return " ".join(b.text for b, keep in zip(blocks, label(blocks)) if keep)


def extract(pages: DataFrame, html_col: str = "html", text_col: str = "text") -> DataFrame:
    """``pages`` without the html and with its main text in ``text_col`` (replaced if it exists).

    Null, empty and text-free pages give the empty string; every row stays, repeated
    ones too; very long pages are read whole.
    """
    where = pages.columns.index(html_col)
    kept = [k for k, c in enumerate(pages.columns) if c not in (html_col, text_col)]
    schema = T.StructType([pages.schema.fields[k] for k in kept] + [T.StructField(text_col, T.StringType())])

    def run(batches):
        for b in batches:
            for i in range(0, b.num_rows, 500):
                part = b.slice(i, 500)
                text = [main_text(x) for x in part.column(where).to_pylist()]
                yield pa.RecordBatch.from_arrays([*[part.column(k) for k in kept], pa.array(text, pa.string())], names=schema.names)

    return pages.mapInArrow(run, schema)


def query(spark, sf_dir):
    """op1: page_id, url, text, n_chars."""
    pages = pick(table(spark, sf_dir, "pages"), page_id="page_id", url="url", html="html")
    return extract(pages).withColumn("n_chars", F.char_length("text").cast("bigint"))
