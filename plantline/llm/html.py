"""Main text of web pages by composite text density.

A page is parsed into a tree of block elements; inline elements count as tags of
their block. Parts that are never the article (scripts, styles, menus, headers
and footers of the page, hidden elements, and side roles) are left out. Forms, and
elements whose class or id says advert, notice, sidebar or comments, are left out
too unless they hold an article, a main part, a headline, or a large share of the
page's text outside links; words on the layout around (with-sidebar, menu-open)
say nothing. For every node the density is
its characters per tag, adjusted for the share of characters and tags in links;
the sum of the densities of its children is largest for the node that holds the
article's paragraphs. The least density on the path from that node to the body
is the threshold: subtrees beside the path that reach it belong to the text too.
If the node lies in an ``article`` element, everything inside belongs to the text,
and so do further articles, headlines of the ``main`` element around it, and
subtrees beside it that reach the threshold; ``main`` is the border. If it lies in
a ``main`` element only, everything inside belongs to the text. Without an
``article``, the page's headline (its only ``h1`` that is not left out) belongs to
the text wherever it stands. Elements that their own style hides are left out.

Defined results: a null page is an empty one; a page without text gives an empty
string; broken markup never fails, open elements end with the page; character
references are decoded; blanks inside a block become one space, blocks are
joined by one line feed; equal rows are extracted separately; an empty table
gives no rows; other columns pass through unless they carry a name of the result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

RESULT = ("text", "n_chars")
# Elements by their role in HTML. Fixed values.
DROPPED = frozenset(
    "script style noscript template head title nav aside footer form button select textarea input iframe svg canvas"
    " object embed audio video menu dialog".split()
)  # a form only on evidence
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "html body div section article main header p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th"
    " caption blockquote pre figure figcaption address details summary center hgroup".split()
)
ENDS_PARAGRAPH = BLOCKS | {"hr"} | (DROPPED - {"script", "button", "input", "select", "textarea", "svg", "canvas", "object", "embed"})
RAW = frozenset("script style noscript template iframe textarea title svg".split())
#: Open elements that a new one of the kind ends, and the elements that shut them in.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
SIDE = re.compile(
    r"(?:^|[-_\s])(?:ads?|advert\w*|adsense|banner|sponsor\w*|promo\w*|cookies?|consent|gdpr|notices?|popup|modal|newsletter|subscribe"
    r"|side-?bar|menu|nav|navbar|navigation|breadcrumbs?|footer|comments?|respond|disqus|share|sharing|social|related|pagination|pager"
    r"|toolbar|skip-?link|masthead|site-header|page-header)(?:$|[-_\s])",
    re.IGNORECASE,
)
#: Of these, such as hold articles of their own beside that of the page.
OWN_ARTICLES = re.compile(r"(?:^|[-_\s])(?:ads?|advert\w*|sponsor\w*|promo\w*|side-?bar|comments?|respond|disqus|related)(?:$|[-_\s])", re.IGNORECASE)
#: Names that tell what stands beside or above an element.
LAYOUT = re.compile(r"(?:^|.*[-_])(?:with|without|no|has)[-_].*|.*[-_](?:open|opened|closed|collapsed|expanded|visible)", re.IGNORECASE)
#: Percentage of the page's text outside links from which an element is no side part for its name; for OWN_ARTICLES.
LARGE, LARGE_OWN = 50, 75
UNSEEN = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)\b", re.IGNORECASE)
SIDE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar".split())

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|</([A-Za-z][^\s/>]*)[^>]*(?:>|\Z)|<([A-Za-z][^\s/>]*)", re.DOTALL)
_ATTRIBUTE = re.compile(r"""\s*/?\s*([^\s=>/"'][^\s=>/]*)(?:\s*=\s*("[^"]*(?:"|\Z)|'[^']*(?:'|\Z)|[^\s>]*))?""")


class Node:
    __slots__ = ("tag", "parent", "parts", "chars", "link_chars", "tags", "link_tags", "density", "side", "hint")

    def __init__(self, tag: str, parent: Node | None, side: bool = False, hint: str = ""):
        self.tag, self.parent, self.side, self.hint = tag, parent, side, hint
        self.parts: list[Node | str] = []
        self.chars = self.link_chars = self.tags = self.link_tags = 0
        self.density = 0.0


def _tokens(html: str) -> Iterator[tuple[str, str, dict[str, str]]]:
    """(kind, name or text, attributes): text, open and close in page order."""
    at, end = 0, len(html)
    while at < end:
        m = _TAG.search(html, at)
        if m is None:
            yield "text", html[at:], {}
            return
        if m.start() > at:
            yield "text", html[at : m.start()], {}
        at = m.end()
        if m.group(1):
            yield "close", m.group(1).lower(), {}
        elif m.group(2):
            name, attributes = m.group(2).lower(), {}
            while at < end and (a := _ATTRIBUTE.match(html, at)):
                attributes.setdefault(a.group(1).lower(), unescape((a.group(2) or "").strip("\"'")))
                at = a.end()
            stop = html.find(">", at)
            at = end if stop < 0 else stop + 1
            yield "open", name, attributes
            if name in RAW:
                shut = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>?", re.IGNORECASE).search(html, at)
                at = shut.end() if shut else end
                yield "close", name, {}
        elif m.group().startswith("<![CDATA["):
            yield "text", m.group()[9:].removesuffix("]]>"), {}


def _is_side(tag: str, attributes: dict[str, str], opened: Counter[str]) -> bool:
    if (tag in DROPPED and tag != "form") or "hidden" in attributes or attributes.get("aria-hidden") == "true":
        return True
    if tag not in ("html", "body") and UNSEEN.search(attributes.get("style", "")):
        return True
    if tag == "header" and not (opened["article"] or opened["main"]):
        return True
    return tag not in ("html", "body", "article", "main") and attributes.get("role", "").lower() in SIDE_ROLES


def _hint(tag: str, attributes: dict[str, str]) -> str:
    """What speaks for a side part: "own" if it may hold articles of its own, else "side", or nothing."""
    if tag in ("html", "body", "article", "main"):
        return ""
    names = f"{attributes.get('class', '')} {attributes.get('id', '')}".split()
    named = " ".join(n for n in names if not LAYOUT.fullmatch(n))
    if OWN_ARTICLES.search(named):
        return "own"
    return "side" if tag == "form" or attributes.get("role", "").lower() == "form" or SIDE.search(named) else ""


def leave_out(root: Node) -> None:
    """Marks the hinted elements as side parts that hold nothing of an article."""
    order, waiting = [], [(root, 0, False)]
    while waiting:
        node, above, owned = waiting.pop()
        owned = owned or node.hint == "own"
        order.append((node, above, owned))
        inner = above + (node.tag in ("article", "main"))
        waiting += [(p, inner, owned) for p in node.parts if isinstance(p, Node) and not p.side]
    if not any(node.hint for node, _, _ in order):
        return
    marks = sum(node.tag in ("article", "main") for node, _, _ in order)
    free = any(node.tag in ("article", "h1") and not owned for node, _, owned in order)
    held: dict[int, list[int]] = {}  # text outside links, articles and mains, mains, headlines and articles
    for node, _, _ in reversed(order):
        own = held.setdefault(id(node), [0, 0, 0, 0])
        own[0] += sum(len("".join(p.split())) for p in node.parts if isinstance(p, str)) - node.link_chars
        own[1] += node.tag in ("article", "main")
        own[2] += node.tag == "main"
        own[3] += node.tag in ("article", "h1")
        if node.parent is not None:
            up = held.setdefault(id(node.parent), [0, 0, 0, 0])
            for k in range(4):
                up[k] += own[k]
    whole = held[id(root)][0]
    for node, above, _ in order:
        if node.hint:
            text, marked, mains, heads = held[id(node)]
            least = LARGE_OWN if node.hint == "own" else LARGE
            large = text * 100 >= whole * least and text > 0 and marks == marked + above
            node.side = not (mains or large or (heads and (node.hint != "own" or not free)))


def parse(html: str) -> Node:
    root = Node("html", None)
    stack: list[tuple[str, Node]] = [("html", root)]  # open elements, each with its block

    opened = Counter(["html"])  # how many of each are open

    def close(upto: int) -> None:
        while len(stack) > max(1, upto):
            opened[stack.pop()[0]] -= 1

    def enter(tag: str, block: Node) -> None:
        stack.append((tag, block))
        opened[tag] += 1

    for kind, name, attributes in _tokens(html):
        node = stack[-1][1]
        if kind == "text":
            node.parts.append(unescape(name))
            if opened["a"]:
                node.link_chars += len("".join(name.split()))
        elif kind == "close":
            if name == "br":
                node.parts.append(" ")
            for place in range(len(stack) - 1, 0, -1) if opened[name] else ():
                if stack[place][0] == name:
                    close(place)
                    break
                if name not in BLOCKS and stack[place][0] in BLOCKS:
                    break  # an inline end tag does not end the block around it
        else:
            if name in ("html", "body") and (name == "html" or opened["body"]):
                continue
            if name in ENDS_PARAGRAPH:
                for place in range(len(stack) - 1, 0, -1):
                    if stack[place][0] == "p":
                        close(place)
                        break
                    if stack[place][0] in BLOCKS:
                        break
            if name in CLOSES:
                ended, border = CLOSES[name]
                for place in range(len(stack) - 1, 0, -1):
                    if stack[place][0] in border:
                        break
                    if stack[place][0] in ended:
                        close(place)
                        node = stack[-1][1]
                        if stack[-1][0] not in ended:
                            break
            node = stack[-1][1]
            side = _is_side(name, attributes, opened)
            hint = "" if side else _hint(name, attributes)
            if name in VOID:
                node.tags += 1
                node.parts.append(Node("hr", node) if name == "hr" else " " if name == "br" else "")
            elif name in BLOCKS or side or hint:
                block = Node(name, node, side, hint)
                node.parts.append(block)
                enter(name, block)
            else:
                node.tags += 1
                node.link_tags += name == "a"
                enter(name, node)
    leave_out(root)
    return root


def measure(root: Node) -> list[Node]:
    """All nodes that are not left out, parents first, with their sums and densities."""
    nodes, waiting = [], [root]
    while waiting:
        node = waiting.pop()
        nodes.append(node)
        waiting += [p for p in reversed(node.parts) if isinstance(p, Node) and not p.side]
    for node in reversed(nodes):
        for part in node.parts:
            if isinstance(part, str):
                node.chars += len("".join(part.split()))
            elif not part.side:
                node.chars += part.chars
                node.link_chars += part.link_chars
                node.tags += part.tags + 1
                node.link_tags += part.link_tags
    whole = max(1, root.chars)
    for node in nodes:
        tags, links, link_tags = max(1, node.tags), max(1, node.link_chars), max(1, node.link_tags)
        plain = max(1, node.chars - node.link_chars)
        base = math.log(node.chars / plain * node.link_chars + root.link_chars / whole * node.chars + math.e)
        share = node.chars / links * tags / link_tags
        node.density = node.chars / tags * math.log(share + 1) / math.log(base + 1) if node.chars else 0.0
    return nodes


def _inside(node: Node) -> list[Node]:
    path = [node]
    while path[-1].parent is not None:
        path.append(path[-1].parent)
    return path


def content(root: Node) -> list[Node]:
    """The subtrees that hold the main text, in page order."""
    nodes = measure(root)
    total = lambda n: sum(p.density for p in n.parts if isinstance(p, Node) and not p.side)
    best = max(nodes, key=lambda n: (max(total(n), n.density if n.tags == 0 else 0.0), -n.tags))
    path = _inside(best)
    article = next((n for n in path if n.tag == "article"), None)
    around = next((n for n in path if n.tag == "main"), None)
    if article is not None:
        path = path[path.index(article) :]
        if around in path:
            path = path[: path.index(around) + 1]
    elif around is not None:
        return [around]
    elif best.tag == "p" and best.parent is not None and best.parent.parent is not None:
        path = path[1:]
    threshold = min((n.density for n in path), default=0.0)
    on_path, chosen = set(map(id, path)), []

    waiting = [path[-1]]
    while waiting:
        node = waiting.pop()
        if id(node) not in on_path:
            marked = article is not None and (node.tag == "article" or (node.tag == "h1" and around in path))
            take = node.density >= threshold or (marked and node.chars > 0)
        else:
            take = node is path[0]
        if take:
            chosen.append(node)
        elif id(node) in on_path or article is not None:
            waiting += [p for p in reversed(node.parts) if isinstance(p, Node) and not p.side]
    heads = [n for n in nodes if n.tag == "h1" and n.chars > 0]
    if article is None and len(heads) == 1 and not any(n in map(id, _inside(heads[0])) for n in map(id, chosen)):
        # The only headline of the page stands above the parts that follow it.
        place = {id(n): k for k, n in enumerate(nodes)}
        chosen = sorted([*chosen, heads[0]], key=lambda n: place[id(n)])
    return chosen


def block_texts(node: Node) -> list[str]:
    """Texts of the blocks of a subtree, in page order; text on either side of an inner block is a block of its own."""
    found: list[str] = []
    waiting: list = [node]
    held: list[str] = []

    def flush() -> None:
        text = " ".join("".join(held).split())
        held.clear()
        if text:
            found.append(text)

    while waiting:
        part = waiting.pop()
        if part is None:
            flush()
        elif isinstance(part, str):
            held.append(part)
        elif not part.side:
            flush()
            waiting.append(None)
            waiting += reversed(part.parts)
        else:
            held.append(" ")
            if part.tag in ENDS_PARAGRAPH:
                flush()
    flush()
    return found


def main_text(html: str | None) -> str:
    return "\n".join(t for node in content(parse(html or "")) for t in block_texts(node))


def extract(pages: DataFrame) -> DataFrame:
    """Each page, without its html, with its main text and the number of its code points."""
    carried = [c for c in pages.columns if c not in (*RESULT, "html")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h.as_py()) for h in batch.column("html")]
            columns = [*(batch.column(c) for c in carried), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*carried, *RESULT])

    schema = T.StructType([
        *[pages.schema[c] for c in carried], T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())
    ])
    return pages.select(*carried, "html").mapInArrow(run, schema)
