"""Main-text extraction from HTML by two-pass block rules.

Pass one looks at each block alone. Boilerplate are blocks inside menus,
headers, footers, sidebars, forms and the like, blocks inside containers whose
class or id names an advert, notice, sidebar or comments, and blocks that are
mostly links. Other blocks of some length with enough stop words are content.
What is left is ambiguous. A class that only hints at boilerplate, a copyright
sign or a lone advert label decide a short block or one without stop words,
never a dense one. Names are read as evidence too: where the blocks they spare
are none of them dense or in an article, and hold less text than the long dense
ones they condemn (a page inside one form, say), or none beside short dense ones,
they are wrong and don't count.

Pass two gives every ambiguous block the label of the nearest decided block,
inside an <article> or <main> that of the nearest one there that the text (not
the markup around it) decides. Between two labels a heading looks ahead;
otherwise the nearer one wins, at equal distance content inside an article and
boilerplate elsewhere. An article without a decided block takes its labels from
the page, and is content where the page has none.
"""

from __future__ import annotations

import html as html_lib
import re
import sys
from collections import Counter
from typing import NamedTuple

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Stop words of four languages.
STOP = frozenset(
    """the of and to in a is that it for on was with as be at by this are from or an not have has had but they his her
    which you were their been there will would can if more when who what so no out up into than its about also
    der die und das den von zu mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie
    nach wird bei einer um am sind noch wie einem über einen so zum war haben nur oder aber vor zur bis mehr durch man
    sein wurde sei ich wir ihr
    de la le et les des en un du une que est pour qui dans par plus pas au sur ne se ce il sont avec son aux elle ou
    sa ses mais comme nous vous cette leur tout été être fait
    el que los se del las por con una su para es lo como más pero sus al o este sí porque esta entre cuando muy sin
    sobre también me hasta hay donde quien desde todo nos durante todos uno les ni contra otros ese eso ante ellos""".split()
)
# Tag names.
BLOCK = frozenset(
    """address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer
    form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table
    tbody td tfoot th thead tr ul""".split()
)
DROP = frozenset("nav footer aside menu select button dialog header fieldset".split())
RAW = frozenset("script style noscript template textarea title iframe svg math object canvas audio video head".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
# Words of class names and ids. The first kind names boilerplate, the second hints at it; parts that say
# nothing about a container, parts that make the others a mere property of it, and names of main text.
NAMES = frozenset(
    """ad ads advert adverts advertisement advertisements advertising sponsor sponsored promo cookie cookies consent gdpr notice notices
    popup modal newsletter subscribe signup login comment comments replies disqus respond sidebar breadcrumb breadcrumbs nav navbar
    navigation menu masthead footer pagination pager copyright disclaimer related recommended""".split()
)
HINTS = frozenset("side widget share sharing social header tags skip toolbar search legal alert promotion banner reply".split())
PLAIN = frozenset(
    """list box area block section container wrap wrapper inner outer bar panel content body item items main left right top bottom
    primary secondary fixed sticky overlay thread form text message links group slot unit""".split()
)
PROPERTY = frozenset("has have with without no not is show hide hidden js".split())
TEXT = frozenset("article content post entry story main text".split())
LABELS = frozenset(
    """advertisement|advertising|sponsored|anzeige|werbung|publicité|sponsorisé|publicidad|anuncio|read more|continue reading|weiterlesen|mehr lesen|
lire la suite|en savoir plus|leer más|seguir leyendo""".replace("\n", "").split("|")
)

TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]|=\s*"[^"]*"|=\s*'[^']*'|=)*+)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)""", re.S
)
ATTR = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]*))?""")
STRIP = re.compile(r"[^\w]+|_+")
OWNED = re.compile(r"(?:©|\(c\)|copyright)", re.I)

LONG, SHORT = 200, 70
LINKS, STOPS = 0.33, 0.08
HARD, NAMED, HINTED = 4, 2, 1


class Block(NamedTuple):
    text: str
    linked: int  # characters inside links
    marks: int  # HARD, NAMED and HINTED of the containers around it
    article: int  # number, 0 outside
    tag: str


def name_marks(value: str) -> int:
    """NAMED or HINTED for a class or id."""
    marks, about_text = 0, False
    for token in value.lower().split():
        parts = [x for x in re.split(r"[-_]+", token) if x]
        if not parts or not PROPERTY.isdisjoint(parts):
            continue
        about_text = about_text or token in TEXT
        while len(parts) > 1 and (parts[-1] in PLAIN or parts[-1].isdigit()):
            parts.pop()
        if parts[-1] in NAMES or parts[0] in NAMES:
            marks |= NAMED
        elif not NAMES.isdisjoint(parts) or not HINTS.isdisjoint(parts):
            marks |= HINTED
    return HINTED if marks and about_text else marks


def container_marks(tag: str, attrs: str, in_article: bool) -> int:
    marks = 0
    if tag in DROP:
        marks |= HINTED if tag == "header" and in_article else HARD
    elif tag == "form":
        marks |= NAMED
    seen = set()
    for name, value in ATTR.findall(attrs) if attrs else ():
        name, value = name.lower(), value.strip("\"'")
        if name in seen:
            continue
        seen.add(name)
        if name in ("class", "id") and tag not in ("body", "html", "main"):
            marks |= name_marks(value)
        elif name == "role" and value.lower() in ROLES:
            marks |= NAMED if value.lower() == "form" else HARD
        elif name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            marks |= HARD
    return marks


def plain_text(parts: list[str]) -> str:
    return " ".join(html_lib.unescape("".join(parts)).split())


def parse(page: str) -> list[Block]:
    """Blocks in page order, in one pass over the page."""
    found: list[Block] = []
    stack: list[tuple[str, int, int]] = []  # tag, marks, article
    open_: Counter[str] = Counter()
    parts: list[str] = []
    in_links: list[str] = []
    links, articles, pos = 0, 0, 0
    root = ("body", 0, 0)
    here = root

    def flush() -> None:
        if parts:
            if text := plain_text(parts):
                found.append(Block(text, len(plain_text(in_links)), here[1], here[2], here[0]))
            parts.clear()
            in_links.clear()

    def say(text: str) -> None:
        if text:
            parts.append(text)
            if links:
                in_links.append(text)

    def leave() -> str:
        nonlocal here
        tag = stack.pop()[0]
        open_[tag] -= 1
        here = stack[-1] if stack else root
        return tag

    while m := TOKEN.search(page, pos):
        say(page[pos : m.start()])
        pos = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if m[1]:
            if tag == "a":
                links = max(0, links - 1)
            elif tag in BLOCK:
                flush()
                if open_[tag]:
                    while leave() != tag:
                        pass
                links = 0
            continue
        if tag in RAW and not m[0].endswith("/>"):
            if tag != "head":
                end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, pos)
                pos = end.end() if end else len(page)
            continue
        if tag == "br":
            say(" ")
        elif tag == "a":
            links += 1
        elif tag in BLOCK:
            flush()
            links = 0
            if tag == "hr":
                continue
            if stack and (here[0] == "p" or tag == "li" and here[0] == "li"):
                leave()
            article = here[2]
            if tag in ("article", "main") and not article:
                articles += 1
                article = articles
            here = (tag, here[1] | container_marks(tag, m[3], bool(article)), article)
            stack.append(here)
            open_[tag] += 1
    say(page[pos:])
    flush()
    return found


def stop_share(text: str) -> float:
    words = STRIP.sub(" ", text.lower()).split()
    return sum(w in STOP for w in words) / max(1, len(words))


def own_labels(blocks: list[Block]) -> list[bool | None]:
    """Pass one: content, boilerplate or None for ambiguous."""
    labels: list[bool | None] = []
    spared = condemned = 0
    spares_text = False
    # a page whose own text has hardly a listed word is in another language: there words tell nothing
    free = [b.text for b in blocks if not b.marks & HARD and b.linked <= LINKS * len(b.text)]
    least = STOPS if stop_share(" ".join(free)) >= STOPS / 2 else 0
    for text, linked, marks, article, tag in blocks:
        size = len(text)
        if marks & HARD or linked > LINKS * size:
            labels.append(False)
            continue
        share = stop_share(text)
        dense = tag not in HEADING and size >= SHORT and share >= least
        bare = size < LONG and OWNED.match(text) or "©" in text and not dense or text.lower().strip(" .…>»→:") in LABELS
        if marks & NAMED:
            condemned += size if dense and size >= LONG else int(dense)
        else:
            spared += size
            spares_text = spares_text or dense or article > 0
        if bare or marks & HINTED and not dense and size < LONG and tag not in HEADING:
            labels.append(False)
        elif dense or size >= LONG and tag not in HEADING:
            labels.append(True)  # text of that length with few links is never dropped for its words
        else:
            labels.append(None)
    if spares_text or spared >= condemned:
        return [False if b.marks & NAMED else x for b, x in zip(blocks, labels, strict=True)]
    return labels


def nearest(flags: list[bool]) -> list[tuple[int | None, int | None]]:
    """For each place the nearest earlier and later place whose flag is set."""
    n = len(flags)
    before: list[int | None] = [None] * n
    after: list[int | None] = [None] * n
    for order, out in ((range(n), before), (range(n - 1, -1, -1), after)):
        last = None
        for i in order:
            out[i] = last
            if flags[i]:
                last = i
    return list(zip(before, after, strict=True))


def inherited(i: int, a: int | None, b: int | None, labels: list[bool | None], heading: bool, tie: bool) -> bool | None:
    if a is None or b is None:
        return None if a is None and b is None else labels[b if a is None else a]
    if labels[a] == labels[b] or heading:
        return labels[b]
    return tie if i - a == b - i else labels[a if i - a < b - i else b]


def all_labels(blocks: list[Block]) -> list[bool]:
    """Pass two: ambiguous blocks inherit from their nearest decided neighbours."""
    own = own_labels(blocks)
    everywhere = nearest([x is not None for x in own])
    within: dict[int, tuple[int | None, int | None]] = {}
    members: dict[int, list[int]] = {}
    for i, block in enumerate(blocks):
        if block.article:
            members.setdefault(block.article, []).append(i)
    for places in members.values():
        by_text = [own[i] is not None and not blocks[i].marks & (HARD | NAMED) or own[i] is True for i in places]
        for i, (a, b) in zip(places, nearest(by_text), strict=True):
            within[i] = (None if a is None else places[a], None if b is None else places[b])
    has_content = any(own)
    labels = []
    for i, (block, label) in enumerate(zip(blocks, own, strict=True)):
        if label is None:
            heading = block.tag in HEADING
            if block.article:
                label = inherited(i, *within[i], own, heading, True)
            if label is None and block.article and not has_content:
                label = True
            if label is None:
                label = inherited(i, *everywhere[i], own, heading, False)
        labels.append(bool(label))
    return labels


def extract(page: str | None) -> str:
    """The main text of a page; blocks are joined by an empty line."""
    blocks = parse(page or "")
    return "\n\n".join(b.text for b, label in zip(blocks, all_labels(blocks), strict=True) if label)


def main_text(page: Column) -> Column:
    """The main text of each page; null and empty pages, and pages without content, give the empty text.

    Works row by row over whole pages, whatever their length, in time linear
    in it. Broken markup is read like a browser does as far as blocks go:
    unclosed paragraphs end at the next block, closing tags that close nothing
    are ignored, and a page may stop anywhere, inside a tag too. Dense text
    stays wherever it is, inside an article or not, and so does any long text
    with few links, whatever its language.
    """
    return F.pandas_udf(lambda pages: pd.Series([extract(p) for p in pages], dtype=object), "string")(page)
