"""The main text of web pages by the distribution of text over blocks of lines.

Markup is stripped into lines: a block-level tag ends a line, inline tags leave nothing behind. Each line has a weight, its length. Lines that
are mostly links weigh nothing, nor do elements of scripts, styles, menus, footers, asides, forms and the like, which are left out. Names
of classes say less than tags: one that names page furniture outright takes its element out, one that merely holds such a word quarters
the weight. Where a page marks its article (article, main, or an element by its role, class or id), lines outside of it are left out; of article or
main and an element called content, the one that holds more text besides the other is taken.

On every page, the weights of each `WINDOW` lines in a row are summed. Text surges where sums turn positive and dives where they
are zero again, from the first line of weight to the last one. In a marked article every such stretch is text; elsewhere a stretch is if it has
a share of `SHARE` of the heaviest one's weight, and all stretches between the first and the last of these belong to it. So a line of links
amid the text stays, and a list of links, or links before and behind the text, go. Elsewhere, short lines with a furniture word go from both ends.

If nothing is left that way, class names are not believed, and if there is still nothing, a marked article's lines are taken as they are.

Character references are decoded, white space within a line becomes one space, lines are joined by one space in page
order.

Defined results: a null or empty page, and one without main text, gives the empty text. Unclosed tags end with the element
around them or the page; an unclosed head at the first block-level tag, as do unclosed buttons, frames and other embedded elements. Repeated rows get equal results. An empty table gives an empty result. A page is one row's
work; long ones take time in proportion to their length.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coursetrail.llm.words import pieces_of

WINDOW = 3
SHARE = 1 / 8  # of the heaviest stretch's weight that makes a stretch text, in pages without a marked article
DOUBT = 4  # a doubtful line weighs so many times less

# Names of HTML elements and common marks of page furniture.
BLOCKS = frozenset("""address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption
figure footer form frameset h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre section
summary table tbody td tfoot th thead title tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no markup; unclosed ones take the rest of the page.
RAW = "script style textarea title".split()
#: Elements that hold no page text; unclosed ones end at the next block-level tag.
EMBEDDED = frozenset("noscript template svg canvas iframe object select button audio video".split())
FURNITURE = frozenset("nav footer aside form dialog menu fieldset".split())
ROLES = frozenset("navigation banner complementary contentinfo search dialog alert alertdialog menu menubar form toolbar".split())
#: Words that name page furniture wherever they stand in a class or id.
MARKS = frozenset("""ad ads adv adbox adsbygoogle adsense advert adverts advertisement advertising sponsor sponsored promo consent gdpr popup modal
newsletter subscribe subscription signup share sharing social sidebar rail aside related recommended recommendations breadcrumb breadcrumbs
nav navbar navigation masthead footer comment comments commentlist disqus pagination pager""".split())
#: Words that do so alone or two together, and raise a doubt besides other words.
DOUBTFUL = frozenset("""promotion banner cookie cookies notice notices alert overlay toast widget widgets menu reply replies respond responses discussion
toolbar login search copyright disclaimer skip""".split())
COMMENTS = frozenset("comment comments reply replies".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CONTENT = frozenset("article content entry main post story".split())
NEVER = frozenset("html body main".split())
#: Elements that a following sibling ends.
ENDED_BY = {"p": BLOCKS - {"br"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"},
            "head": BLOCKS - {"head", "html", "title"}}

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<raw>{'|'.join(RAW)})\b(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>(?:.*?</(?P=raw)\s*>|.*\Z)"
    r"|<(?P<close>/?)(?P<name>[a-z][\w:-]*+)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<close2>/?)(?P<name2>[a-z][\w:-]*+)(?P<rest2>[^>]*+)(?:>|\Z)"
    r"|<[!?/][^>]*+(?:>|\Z)"
    r"|(?P<text>[^<]++|<)", re.IGNORECASE | re.DOTALL)
SOME_EMBEDDED = re.compile(rf"<(?:{'|'.join(sorted(EMBEDDED))})\b", re.IGNORECASE)
SINGLE = frozenset("button iframe select".split())  # cannot stand within themselves
ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.IGNORECASE)
PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


def _furniture(name: str, rest: str, in_article: bool, trust: bool) -> int:
    """2 for an element that is page furniture, 1 for one whose class or id raises a doubt."""
    if name in NEVER:
        return 0
    if name in FURNITURE or name in EMBEDDED or name == "head" or name == "header" and not in_article:
        return 2
    if not rest.strip():
        return 0
    doubt = 0
    for key, a, b, c in ATTRIBUTE.findall(rest):
        key, value = key.lower(), a or b or c
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            return 2
        if key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.IGNORECASE):
            return 2
        if key == "role" and value.lower() in ROLES:
            return 2
        if key == "class" or key == "id" and name not in HEADINGS:  # a heading's id is a place to jump to
            for token in value.split():
                words = {w.lower() for w in PARTS.findall(token)}
                if name == "article":
                    words &= COMMENTS
                doubts = words & DOUBTFUL
                if words & MARKS or len(doubts) > 1 or doubts and words == doubts or "header" in words and not in_article and name != "h1":
                    doubt = max(doubt, 2 if trust else 1)
                elif doubts and name in BLOCKS:
                    doubt = max(doubt, 1)
    return doubt


def _is_content(rest: str) -> bool:
    """Whether role, class or id call an element the page's content."""
    for key, a, b, c in ATTRIBUTE.findall(rest):
        value = a or b or c
        if key.lower() == "role" and value.lower() in ("main", "article"):
            return True
        if key.lower() in ("class", "id") and {w.lower() for w in PARTS.findall(value)} & CONTENT:
            return True
    return False


def _left_open(html: str) -> set[int]:
    """Where the embedded elements begin that no end tag closes."""
    opened: dict[str, list[int]] = {name: [] for name in EMBEDDED}
    left: set[int] = set()
    for token in TOKEN.finditer(html) if SOME_EMBEDDED.search(html) else ():
        name = (token["name"] or token["name2"] or "").lower()
        if name not in EMBEDDED or (token["rest"] or token["rest2"] or "").endswith("/"):
            continue
        if token["close"] or token["close2"]:
            if opened[name]:
                opened[name].pop()
            continue
        if name in SINGLE:
            left.update(opened[name])
            opened[name].clear()
        opened[name].append(token.start())
    return left.union(*opened.values())


def lines(html: str, trust: bool = True) -> list[tuple[str, int, int, bool]]:
    """(text, characters of it in links, place, doubt) of each line; furniture is an empty line.

    place: 2 within article or main, plus 1 within an element that is called content; -1 for furniture. Without `trust`, class names raise
    doubts only.
    """
    found: list[tuple[str, int, int, bool]] = []
    parts: list[str] = []
    links = article = link = 0
    skip, depth, skip_from = "", 0, 0
    left_open = _left_open(html)
    loose = False  # whether what is skipped has no end tag of its own
    content, inner = "", 0  # the outermost element that is called content, and how many of its name are open in it
    doubtful, doubts = "", 0  # the same of the outermost doubtful element

    def end() -> None:
        nonlocal links
        found.append((" ".join("".join(parts).split()), links, (2 if article else 0) + (1 if content else 0), bool(doubtful)))
        parts.clear()
        links = 0

    for token in TOKEN.finditer(html):
        text = token["text"]
        if text is not None:
            if not skip:
                text = unescape(text)
                parts.append(text)
                if link:
                    links += len(text.strip())
            continue
        name = (token["name"] or token["name2"] or "").lower()
        if not name:
            continue
        closing, rest = bool(token["close"] or token["close2"]), token["rest"] or token["rest2"] or ""
        if skip:
            if loose:
                depth = depth if name not in BLOCKS else 0
            elif closing:
                if name == skip:
                    depth -= 1
                elif name in ("article", "main", "body") and article == skip_from and name != skip:
                    depth = 0  # the element around it ends
            elif name in ENDED_BY.get(skip, ()) and depth == 1:
                depth = 0
            elif name == skip and name not in VOID and not rest.endswith("/"):
                depth += 1
            if depth > 0:
                continue
            ended, skip = skip, ""
            end()
            if closing and name == ended:
                continue
        if name in BLOCKS:
            end()
        if closing:
            if name in ("article", "main"):
                article = max(0, article - 1)
            elif name == "a":
                link = 0
            if name == content:
                inner -= 1
                content = content if inner else ""
            if name == doubtful:
                doubts -= 1
                doubtful = doubtful if doubts else ""
            continue
        kind = 0 if name in VOID or rest.endswith("/") else _furniture(name, rest, article > 0, trust)
        if kind == 2:
            skip, depth, skip_from = name, 1, article
            loose = token.start() in left_open
            if name not in BLOCKS:
                continue
            end()
            found.append(("", 0, -1, False))
            continue
        if name == doubtful:
            doubts += 1
        elif kind and not doubtful:
            doubtful, doubts = name, 1
        if name in ("article", "main"):
            article += 1
        elif name == "a":
            link = 1
        if name == content:
            inner += 1
        elif not content and rest and name in ("div", "section", "td") and _is_content(rest):
            content, inner = name, 1
    end()
    return found


def stretches(weights: list[int]) -> list[tuple[int, int]]:
    """(begin, end) of the lines from each surge to its dive: where the sums of WINDOW weights in a row are positive, from the first weight to the last."""
    found: list[tuple[int, int]] = []
    window, begin, last = sum(weights[:WINDOW - 1]), None, 0
    for i, weight in enumerate(weights):
        window += weights[i + WINDOW - 1] if i + WINDOW <= len(weights) else 0
        if weight:
            begin, last = i if begin is None else begin, i
        if not window and begin is not None:
            found.append((begin, last + 1))
            begin = None
        window -= weight
    if begin is not None:
        found.append((begin, last + 1))
    return found


def _weight(text: str, linked: int, doubt: bool) -> int:
    if 2 * linked > len(text):
        return 0
    return -(-len(text) // DOUBT) if doubt else len(text)


def _text_of(html: str, trust: bool) -> str:
    every = lines(html, trust)
    mass = [0, 0, 0, 0]
    for text, _, place, _ in every:
        if text:
            mass[place] += len(text)
    marked = 2 if mass[2] + mass[3] and mass[2] + mass[3] >= mass[1] else 1 if mass[1] else 0
    # What is empty because tags follow each other is no line; what was left out as furniture is an empty one.
    every = [line for line in every if (line[0] and (not marked or line[2] & marked)) or line[2] < 0]
    weights = [_weight(text, linked, doubt) for text, linked, _, doubt in every]
    found = stretches(weights)
    if not found:
        return "" if trust or not marked else " ".join(line[0] for line in every if line[0])
    if not marked:
        sums = [sum(weights[a:b]) for a, b in found]
        text = [i for i, n in enumerate(sums) if n >= SHARE * max(sums)]
        found = found[text[0]:text[-1] + 1]
    kept = [line for a, b in found for line in every[a:b] if line[0]]
    if not marked:
        sure = [len(line[0]) for line in kept if not line[3]]
        while sure and kept and kept[0][3] and len(kept[0][0]) * len(sure) < sum(sure):
            del kept[0]
        while sure and kept and kept[-1][3] and len(kept[-1][0]) * len(sure) < sum(sure):
            del kept[-1]
    return " ".join(line[0] for line in kept)


def main_text(html: str | None) -> str:
    return _text_of(html or "", True) or (_text_of(html, False) if html else "")


def extracted(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for every row of pages (page_id, url, html)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches, "html"):
            texts = [main_text(h.as_py()) for h in batch.column("html")]
            yield pa.record_batch({"page_id": batch.column("page_id"), "url": batch.column("url"),
                                   "text": pa.array(texts, pa.string()), "n_chars": pa.array(map(len, texts), pa.int64())})

    return pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", "html").mapInArrow(
        rows, "page_id bigint, url string, text string, n_chars bigint")
