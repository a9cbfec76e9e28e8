"""Reading of HTML: one pass over a page, tolerant of broken markup, linear in its length."""

from __future__ import annotations

import hashlib
import html as references
import re
from functools import lru_cache
from typing import NamedTuple

_QUOTED = r"""(?>[^>"']|"[^"]*"|'[^']*')*+"""
_TOKEN = re.compile(rf"<!--.*?(?:--!?>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)({_QUOTED}|[^>]*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"""(class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_NAMING = re.compile("class|id|role|itemprop", re.I)
_NAME = re.compile(r"[^\W_]+")

# Element names by what HTML says of them.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes template svg".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table "
    "tbody td tfoot th thead tr ul".split()
)
SCOPES = frozenset("button caption html object table td template th".split())
LISTS = frozenset("ul ol dl table select".split())
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "option": ("option",)}
ENDS |= {"td": ("td", "th"), "th": ("td", "th")}
CONTAINERS = frozenset("article body center div main section td".split())
SIDE_TAGS = frozenset("aside button datalist dialog footer form head input menu nav select".split())
SIDE_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form navigation search".split())
SIDE_NAMES = frozenset(
    "ad ads advert advertisement adverts adsense banner breadcrumb breadcrumbs comment comments consent cookie "
    "cookies disqus footer masthead menu modal nav navbar navigation newsletter notice notices pagination popup "
    "promo promotion related respond share sharing sidebar skip social sponsor sponsored subscribe toolbar widget".split()
)
# Kinds of an element: marked as the article, can hold blocks.
MARKED, HOLDS = 1, 2


def hashed(*parts: object) -> int:
    """A signed 64-bit number that stands for the parts."""
    data = "\n".join(map(str, parts)).encode("utf-8", "replace")
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "big", signed=True)


def path_id(path: str) -> int:
    """The number of a path of steps such as ``html>body>div.story``."""
    number = 0
    for step in path.split(">"):
        number = hashed(number, step)
    return number


class Step(NamedTuple):
    """What a start tag says, wherever it stands; ``header`` may still be the article's own."""

    path: int
    kind: int
    side: bool
    named: bool  # a class or id is one of a side element


@lru_cache(maxsize=100_000)
def _step(around: int, tag: str, attributes: str) -> Step:
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)}
    names = found.get("class", "").lower().split()
    roles = set(found.get("role", "").lower().split())
    marked = tag in ("article", "main") or "main" in roles or "articlebody" in found.get("itemprop", "").lower()
    parts = {p for name in [*names, found.get("id", "").lower()] for p in _NAME.findall(name)}
    side = tag in SIDE_TAGS or bool(roles & SIDE_ROLES)
    named = bool(parts & SIDE_NAMES) and not marked and tag != "body"
    step = ".".join([tag, *sorted(re.sub(r"\d+", "", n) for n in names)])
    return Step(hashed(around, step), MARKED * marked + HOLDS * (tag in CONTAINERS), side, named)


class Element:
    __slots__ = ("tag", "path", "parent", "kind", "side", "main", "named", "chars", "best", "depth")

    def __init__(self, tag: str, step: Step, parent: Element | None) -> None:
        self.tag, self.path, self.kind, self.parent, self.named = tag, step.path, step.kind, parent, step.named
        self.main = bool(step.kind & MARKED) or bool(parent and parent.main)  # in the article, as the page marks it
        side = step.side or tag == "header" and not self.main
        self.side = side or bool(parent and parent.side)  # it or an element around it is no main text
        self.depth = parent.depth + 1 if parent else 0
        self.chars = 0  # text in it that is in no side element by tag or role
        self.best = 0  # text of the largest marked element in it, itself among them


class Block(NamedTuple):
    text: str
    element: Element | None  # the innermost one that ends blocks


def read_page(html: str) -> tuple[list[Element], list[Block]]:
    """All elements in the order in which they open, and the blocks of main text.

    A block lies between the borders of block elements, marked and side elements. Side elements
    have no blocks. A side name does not make an element side if it holds the page's largest
    marked element or, on a page without marks, at least half of the text: then it is a wrapper
    of the layout.
    """
    elements: list[Element] = []
    items: list[tuple[str | None, Element | None]] = []  # a text and what is around it; None is a border
    stack: list[Element] = []
    open_at: dict[str, list[int]] = {}  # places in the stack, by tag
    scopes, lists = [-1], [-1]
    lower = None
    at, total, best = 0, 0, 0

    def close(down_to: int) -> None:
        nonlocal best
        while len(stack) > down_to:
            element = stack.pop()
            open_at[element.tag].pop()
            if scopes[-1] == len(stack):
                scopes.pop()
            if lists[-1] == len(stack):
                lists.pop()
            ended(element)

    def ended(element: Element) -> None:
        nonlocal best
        if element.kind & MARKED and not element.side:
            element.best = max(element.best, element.chars)
        best = max(best, element.best)
        if element.parent:
            element.parent.chars += element.chars
            element.parent.best = max(element.parent.best, element.best)
        if borders(element):
            items.append((None, element))

    def borders(element: Element) -> bool:
        return element.tag in BLOCKS or element.side or element.named or bool(element.kind & MARKED)

    while m := _TOKEN.search(html, at):
        start = m.start()
        if start > at:
            text = html[at:start]
            around = stack[-1] if stack else None
            items.append((text, around))
            if not (around and around.side):
                n = len(text.strip())
                total += n
                if around:
                    around.chars += n
        at = m.end()
        tag = m[2]
        if not tag:
            continue
        tag = tag.lower()
        if m[1]:
            if open_at.get(tag):
                close(open_at[tag][-1])
            continue
        if tag in RAW:
            lower = html.lower() if lower is None else lower
            end = lower.find(f"</{tag}", at)
            shut = html.find(">", end) if end >= 0 else -1
            at = shut + 1 if shut >= 0 else len(html)
            continue
        if tag in ENDS:
            nearest = max((open_at[t][-1] for t in ENDS[tag] if open_at.get(t)), default=-1)
            if nearest >= max(scopes[-1], lists[-1], 0):
                close(nearest)
        if tag in BLOCKS and open_at.get("p") and open_at["p"][-1] > scopes[-1]:
            close(open_at["p"][-1])
        parent = stack[-1] if stack else None
        attributes = m[3] if _NAMING.search(m[3]) else ""
        element = Element(tag, _step(parent.path if parent else 0, tag, attributes), parent)
        elements.append(element)
        if borders(element):
            items.append((None, element))
        if tag == "br":
            items.append((" ", parent))
        if tag in VOID or m[3].endswith("/") and tag not in BLOCKS:
            ended(element)
        else:
            if tag in SCOPES:
                scopes.append(len(stack))
            if tag in LISTS:
                lists.append(len(stack))
            open_at.setdefault(tag, []).append(len(stack))
            stack.append(element)
    if at < len(html):
        text, around = html[at:], stack[-1] if stack else None
        items.append((text, around))
        if not (around and around.side):
            total += len(text.strip())
            if around:
                around.chars += len(text.strip())
    close(0)
    for element in elements:
        if element.named:
            wraps = element.best == best if best else 2 * element.chars >= total
            element.side |= not wraps
        if element.parent and element.parent.side:
            element.side = True

    blocks: list[Block] = []
    parts: list[str] = []
    owner: Element | None = None
    for text, element in items:
        if text is not None:
            if not (element and element.side):
                parts.append(text)
                owner = element
            continue
        if element.named and not (element.side or element.tag in BLOCKS or element.kind & MARKED):
            continue  # a wrapper after all
        if parts:
            end_block(blocks, parts, owner)
            parts = []
    end_block(blocks, parts, owner)
    return elements, blocks


def end_block(blocks: list[Block], parts: list[str], owner: Element | None) -> None:
    text = " ".join(references.unescape("".join(parts)).split())
    if text:
        while owner and owner.tag not in BLOCKS and not owner.kind & MARKED:
            owner = owner.parent
        blocks.append(Block(text, owner))
