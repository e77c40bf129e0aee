"""Blocks of text of one HTML page, with their place in the element tree.

A small tolerant walk over tags: unclosed paragraphs, list items and cells close
as browsers close them, stray end tags are ignored, comments and raw-text
elements are skipped."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>?|[^<]+|<",
                   re.S)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
SPLIT = re.compile(r"[^a-z0-9]+")

# fixed values: element kinds of HTML
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rt rp s samp "
                   "small span strike strong sub sup time tt u var".split())
SELF_CLOSING = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
                "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
LISTS = frozenset("ul ol dl table".split())
# fixed values: what is never main text, by element, by a word of class or id, by role
BOILER_TAGS = frozenset("nav footer aside form button select object canvas dialog menu".split())
BOILER_WORDS = frozenset("ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments consent "
                         "cookie cookies disqus footer login menu modal nav navbar navigation newsletter notice "
                         "pagination popup promo related respond search share sharing sidebar signup social sponsor "
                         "sponsored subscribe toolbar widget".split())
BOILER_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu".split())
MAIN_TAGS = frozenset("article main".split())
# fixed values: parts of a class that tell of a page's layout or state, not of what the element is
STATES = frozenset("closed disabled enabled has no not off on open with without".split())

BOILER, OUTSIDE, NEUTRAL, MAIN = 0.0, 0.2, 0.5, 0.8


@dataclass
class Element:
    tag: str
    name: str            # tag and classes
    path: str
    boiler: bool
    main: bool
    children: list[str]


@dataclass
class Block:
    path: str            # names of the enclosing block elements
    parent: str
    holder: Element      # whose children tell the presentation
    boiler: bool
    main: bool
    text: str


def _says_boiler(tag: str, names: str) -> bool:
    """Whether classes and id name boilerplate.  The page itself and main carry layout
    classes only; an article is boilerplate by a whole class, not by a part of one."""
    if tag in ("html", "body", "main"):
        return False
    if tag == "article":
        return not BOILER_WORDS.isdisjoint(names.split())
    parts = (set(SPLIT.split(x)) for x in names.split())
    return any(p & BOILER_WORDS and not p & STATES for p in parts)


def _child(parent: Element, tag: str, attributes: str) -> Element:
    found = {k.lower(): v.strip("\"'").lower() for k, v in ATTRIBUTE.findall(attributes)} if attributes else {}
    kind = found.get("class", "")
    named = bool(found) and _says_boiler(tag, f"{kind} {found.get('id', '')}")
    main = parent.main or tag in MAIN_TAGS or found.get("role") == "main"
    boiler = (parent.boiler or tag in BOILER_TAGS or (tag == "header" and not main) or named
              or found.get("role") in BOILER_ROLES or "hidden" in found
              or "display:none" in found.get("style", "").replace(" ", ""))
    name = ".".join([tag, *sorted(kind.split())])
    parent.children.append(name)
    return Element(tag, name, f"{parent.path}/{name}", boiler, main, [])


def blocks(page: str) -> list[Block]:
    root = Element("", "", "", False, False, [])
    stack, out, text = [root], [], []

    def flush():
        words = html.unescape("".join(text)).split()
        text.clear()
        if words:
            at = max((i for i, e in enumerate(stack) if e.tag not in INLINE), default=0)
            e = stack[at]
            holder = stack[at - 1] if at else e
            out.append(Block(e.path, holder.path, holder, stack[-1].boiler, e.main, " ".join(words)))

    skip, at = "", 0
    while at < len(page):
        if skip:                                   # raw text runs to its own end tag
            end = re.compile(rf"</{re.escape(skip)}\b", re.I).search(page, at)
            skip, at = "", end.start() if end else len(page)
            continue
        m = TOKEN.match(page, at)
        at = m.end()
        tag = m[2]
        if tag is None:
            if m[0][0] != "<" or m[0] == "<":
                text.append(m[0])
            continue
        tag = tag.lower()
        if m[1]:                                   # end tag
            if tag not in INLINE:
                flush()
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
                if tag in INLINE and stack[i].tag not in INLINE:
                    break                          # an inline end tag never closes a block
            continue
        if tag in RAW:
            skip = "" if m[3].endswith("/") else tag
            continue
        if tag in VOID:
            text.append(" ")
            continue
        if tag not in INLINE:
            flush()
            close = SELF_CLOSING.get(tag, {"p"})
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in close:
                    del stack[i:]
                    break
                if stack[i].tag not in INLINE and (stack[i].tag in LISTS or close == {"p"}):
                    break
        stack.append(_child(stack[-1], tag, m[3]))
        if m[3].endswith("/"):
            stack.pop()
    flush()
    return out


def prior(b: Block, has_main: bool) -> float:
    """What the element alone tells: how likely its text is main text."""
    return BOILER if b.boiler else MAIN if b.main else OUTSIDE if has_main else NEUTRAL
