"""Main text of HTML pages by two-pass block rules.

A page is cut into blocks at block-level tags. The first pass decides blocks by link
density, length and stop-word density, and leaves short or middling ones open. The
second gives each open block the label of its nearest decided neighbours. What stands in
menus, notices and the like is never main text. An element named as the article is
evidence: while the page's prose is in it, blocks outside it are out, and its own open
blocks look to its own decided ones.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from millrace.llm.arrow import with_text_columns

# HTML element names, and words of class, id and role attributes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr img".split()
)
RAW = ("script", "style", "noscript", "template", "textarea", "iframe", "noframes", "xmp", "svg", "math")
APART = frozenset(
    "head title nav header footer aside form menu dialog button select option fieldset legend "
    "object canvas audio video map".split()
)
MAIN = frozenset(("article", "main"))
APART_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner sidebar side "
    "nav navbar navigation menu menus breadcrumb breadcrumbs header masthead topbar footer foot bottombar cookie "
    "cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login "
    "share sharing social related recommended recommendations comment comments respondents disqus discussion "
    "replies reply widget widgets pagination pager toolbar copyright disclaimer skip search contentinfo "
    "complementary banner dialog form".split()
)
#: Of these a part of a class name is enough inside an article too; of the others, the whole name.
INNER_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored sidebar nav navbar navigation "
    "breadcrumb breadcrumbs cookie cookies consent gdpr newsletter subscribe signup share sharing comment comments "
    "respondents disqus replies widget widgets pagination pager toolbar".split()
)
COMMENT_WORDS = frozenset("comment comments respondents disqus reply replies".split())
MAIN_WORDS = frozenset("article main content post entry story".split())
STOP_WORDS = frozenset(
    "the of and to in is it that for on are with as this was be by at or an from have not but had they you were "
    "der die und das den von zu mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat "
    "le la les et des de du un une en que qui dans pour est sur pas au par plus il elle se ne ce avec sont "
    "el los las que y en del se por con una para no es su al lo como más pero sus".split()
)

# a quote opens a value only directly behind the equals sign
_VALUE = r"""(?:"[^"]*"|'[^']*'|[^\s>"'][^\s>]*+)"""
_ATTRIBUTE = rf"[^\s/>=]++(?:\s*+=\s*+(?:{_VALUE}|(?=>)))?+"
_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    rf"|<(/?)([a-zA-Z][^\s/>]*+)((?:[\s/]++|{_ATTRIBUTE}|=)*+)>|</?[a-zA-Z][^>]*(?:>|\Z)",
    re.S,
)
_PAIRS = re.compile(rf"([^\s/>=]++)(?:\s*+=\s*+({_VALUE}))?+")
_HIDDEN = re.compile(r"display\s*:\s*none", re.I)
_WORD = re.compile(r"[a-z]+")
_PARAGRAPH = re.compile("p|h[1-6]")
_ENDS_PARAGRAPH = re.compile("p|li|dt|dd|tr|td|th|option|h[1-6]")
_MODIFIERS = ("has-", "with-", "without-", "no-", "has_", "with_", "no_")
_RAW_END = {name: re.compile(rf"</{name}\s*[^>]*>", re.I) for name in RAW}


@dataclass(frozen=True)
class Rules:
    """Thresholds of the first pass, in code points and shares of words or characters."""

    short: int = 70
    long: int = 200
    stop_low: float = 0.15
    stop_high: float = 0.28
    links: float = 0.34
    #: Stop-words of known languages make up so much of a page's words, or its own frequent ones are taken.
    known: float = 0.08
    #: An article may have so many times its text in prose outside it and still be the main element.
    outside: float = 3.0


@dataclass
class Block:
    text: str
    linked: int = 0  # code points inside links
    apart: bool = False  # inside an element that is never main text
    main: bool = False  # inside the element that is named as the article

    @property
    def link_share(self) -> float:
        return self.linked / (len(self.text.replace(" ", "")) or 1)


@dataclass(frozen=True)
class Names:
    """What an element's attributes say of it."""

    apart: bool = False  # some part of a name stands for what is no article
    inner: bool = False  # even inside an article
    comment: bool = False
    main: bool = False
    hidden: bool = False


_NO_NAMES = Names()


def _named(attributes: str) -> Names:
    if not attributes.strip(" \t\r\n\f/"):
        return _NO_NAMES
    parts: set[str] = set()
    whole: set[str] = set()
    hidden = False
    for name, value in _PAIRS.findall(attributes):
        name, value = name.lower(), value.strip("\"'") if value[:1] in "\"'" else value
        if name in ("class", "id", "role"):
            names = [n for n in value.lower().split() if not n.startswith(_MODIFIERS)]
            whole.update(names)
            parts.update(w for n in names for w in _WORD.findall(n))
        elif name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            hidden = True
        elif name == "style" and _HIDDEN.search(value):
            hidden = True
    return Names(
        bool(parts & APART_WORDS),
        bool(parts & INNER_WORDS or whole & APART_WORDS),
        bool(parts & COMMENT_WORDS),
        bool(parts & MAIN_WORDS),
        hidden,
    )


class _Open:
    """The open elements, each with what it makes of its text: apart, main, link.

    Open names are counted, inline ones since the last block element, so that an end tag
    without a start tag is passed over without a look at the stack.
    """

    def __init__(self) -> None:
        self.stack: list[tuple[str, bool, bool, bool]] = []
        self.blocks: Counter[str] = Counter()
        self.runs: list[Counter[str]] = [Counter()]

    def state(self) -> tuple[bool, bool, bool]:
        return self.stack[-1][1:] if self.stack else (False, False, False)

    def push(self, name: str, apart: bool, main: bool, link: bool) -> None:
        self.stack.append((name, apart, main, link))
        if name in INLINE:
            self.runs[-1][name] += 1
        else:
            self.blocks[name] += 1
            self.runs.append(Counter())

    def cut(self, size: int) -> None:
        while len(self.stack) > size:
            name = self.stack.pop()[0]
            if name in INLINE:
                self.runs[-1][name] -= 1
            else:
                self.blocks[name] -= 1
                self.runs.pop()

    def end(self, name: str) -> None:
        """An end tag; an inline one does not close the block elements around it."""
        if (self.runs[-1] if name in INLINE else self.blocks)[name] <= 0:
            return
        k = len(self.stack) - 1
        while self.stack[k][0] != name:
            k -= 1
        self.cut(k)

    def begin(self, name: str) -> None:
        """A block-level start tag ends open paragraphs, and inline elements left open in them."""
        k = len(self.stack)
        if _ENDS_PARAGRAPH.fullmatch(name):
            while k and (self.stack[k - 1][0] in INLINE or _PARAGRAPH.fullmatch(self.stack[k - 1][0])):
                k -= 1
            self.cut(k)
        elif k and self.stack[-1][0] in INLINE:
            while k and self.stack[k - 1][0] in INLINE:
                k -= 1
            if k and self.stack[k - 1][0] == "p":
                self.cut(k - 1)
        if name == "li" and self.stack and self.stack[-1][0] == "li":
            self.cut(len(self.stack) - 1)


def blocks(page: str) -> list[Block]:
    """The page's blocks in order, without markup, comments, scripts and styles."""
    found: list[Block] = []
    held: list[str] = []
    linked = 0
    elements = _Open()

    def close() -> None:
        nonlocal linked
        text = " ".join("".join(held).split())
        if text:
            apart, main, _ = elements.state()
            found.append(Block(text, linked, apart, main))
        held.clear()
        linked = 0

    def add(raw: str) -> None:
        nonlocal linked
        if raw:
            text = html.unescape(raw) if "&" in raw else raw
            held.append(text)
            if elements.state()[2]:
                linked += len("".join(text.split()))

    at = 0
    while True:
        m = _TAG.search(page, at)
        if m is None:
            add(page[at:])
            break
        add(page[at : m.start()])
        at = m.end()
        if not m[2]:
            if m[0].startswith("<![CDATA["):
                add(html.escape(m[0][9:].removesuffix("]]>")))
            continue
        name = m[2].lower()
        if name not in INLINE:
            close()
        if m[1]:
            elements.end(name)
            continue
        if name in RAW and not m[3].endswith("/"):
            end = _RAW_END[name].search(page, at)
            at = end.end() if end else len(page)
            continue
        if name in VOID or m[3].endswith("/"):
            continue
        if name not in INLINE:
            elements.begin(name)
        apart, main, link = elements.state()
        names = _named(m[3])
        structural = name in ("html", "body")
        aside = not structural and (names.comment if name in MAIN else names.inner if main else names.apart)
        if not (apart or aside):
            main = main or name in MAIN or names.main and name in ("div", "section", "td")
        apart = apart or aside or name in APART or names.hidden and not structural
        elements.push(name, apart, main, link or name == "a")
    close()
    return found


def _words(text: str) -> list[str]:
    return [w.strip(".,;:!?()\"'") for w in text.lower().split()]


def stop_words_of(found: Sequence[Block], rules: Rules) -> frozenset[str] | None:
    """Stop-words for a page: of the known languages, or its own most frequent words.

    None where neither makes up enough of the page, as in writing without spaces; density then tells nothing.
    """
    counts = Counter(w for b in found if not b.apart for w in _words(b.text))
    total = sum(counts.values()) or 1
    if sum(n for w, n in counts.items() if w in STOP_WORDS) >= rules.known * total:
        return STOP_WORDS
    own = frozenset(w for w, n in counts.most_common(30) if n >= 3)
    return own if sum(counts[w] for w in own) >= rules.stop_low * total else None


def _density(block: Block, stops: frozenset[str] | None) -> float | None:
    if stops is None:
        return None
    words = _words(block.text)
    return sum(w in stops for w in words) / len(words)


def holds_the_prose(found: Sequence[Block], densities: Sequence[float | None], rules: Rules) -> bool:
    """Whether the element named as the article is the main one: the page's prose is not elsewhere."""
    inside = sum(len(b.text) for b in found if b.main and not b.apart)
    outside = sum(
        len(b.text)
        for b, d in zip(found, densities)
        if not b.main and not b.apart and b.link_share <= rules.links
        and len(b.text) >= rules.long and (d is None or d >= rules.stop_high)
    )
    return inside > 0 and outside <= rules.outside * inside


def first_pass(block: Block, rules: Rules, density: float | None, has_main: bool) -> bool | None:
    """Whether the block is main text; None leaves it to its neighbours.

    ``has_main`` says that the page has a main element. Outside it nothing is main text, and
    inside it nothing is put out: what is no clear prose is left open.
    """
    if block.apart or has_main and not block.main:
        return False
    if block.link_share > rules.links:
        return None if has_main else False
    if len(block.text) < rules.short:
        return None
    if density is None:
        return True if len(block.text) >= rules.long else None
    if density >= rules.stop_high:
        return True
    if density < rules.stop_low:
        return None if has_main or len(block.text) >= rules.long else False
    return True if len(block.text) >= rules.long else None


def second_pass(labels: Sequence[bool | None], groups: Sequence[bool] | None = None) -> list[bool]:
    """Open blocks take the label of the nearest decided neighbours, of their own group if there are groups.

    Where the two sides differ, the nearer one counts, and at equal distance
    main text wins; a group without decided blocks is main text.
    """
    groups = groups or [False] * len(labels)
    out: list[bool] = [False] * len(labels)
    for group in set(groups):
        own = [k for k, g in enumerate(groups) if g == group]
        before: dict[int, tuple[int, bool] | None] = {}
        last = after = None
        for k in own:
            last = (k, labels[k]) if labels[k] is not None else last
            before[k] = last
        for k in reversed(own):
            after = (k, labels[k]) if labels[k] is not None else after
            sides = [(abs(k - x[0]), not x[1]) for x in (before[k], after) if x is not None]
            out[k] = not min(sides)[1] if sides else True
    return out


def judged(page: str | None, rules: Rules = Rules()) -> list[tuple[Block, bool | None, bool]]:
    """The page's blocks, each with the first pass's label and the last one."""
    found = blocks(page or "")
    stops = stop_words_of(found, rules)
    densities = [_density(b, stops) for b in found]
    has_main = holds_the_prose(found, densities, rules)
    first = [first_pass(b, rules, d, has_main) for b, d in zip(found, densities)]
    groups = [has_main and b.main and not b.apart for b in found]
    return list(zip(found, first, second_pass(first, groups)))


def main_text(page: str | None, rules: Rules = Rules()) -> str:
    """The main text, its blocks joined by a space; empty if there is none."""
    return " ".join(b.text for b, _, keep in judged(page, rules) if keep and not b.apart)


def extract_text(
    pages: DataFrame, html: str = "html", text: str = "text", rules: Rules = Rules(), keep_html: bool = False
) -> DataFrame:
    """The pages with their main text, and without ``html`` unless asked for.

    Null and empty pages have an empty text. Whole pages are read, however
    long; malformed markup is taken as browsers do where that matters: open
    elements end with their parents, an open comment or script runs to the
    end. A column named like ``text`` is replaced, repeated rows are pages of
    their own, and an empty table stays empty.
    """
    return with_text_columns(
        pages,
        html,
        [(text, T.StringType())],
        lambda values: [[main_text(p, rules) for p in values]],
        drop=() if keep_html else (html,),
    )
