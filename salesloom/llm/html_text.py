"""Main text of HTML pages by two-pass block rules; kept blocks are joined by an empty line.

A page is cut into blocks at block-level tags. The first pass judges each block by its
length, the share of link text and the density of stop words: blocks of link text, of
marked boilerplate (navigation, advert, form ... by tag, role, class or id) or long ones
without stop words are bad, long ones with stop words good, and short ones undecided. In
the second pass an undecided block takes the label of its nearest decided neighbours: both
agree or, where they differ, the nearer one decides, good on a tie. Marked boilerplate is
no neighbour. Where a page marks its article, blocks outside it are bad and blocks inside
need no stop words.

Pages are independent, so nothing is shuffled. Defined cases: null or empty html has an
empty text; unclosed comments, scripts and tags end with the page; markup that closes
nothing is ignored; a quote that opens no value of an attribute, or is never closed, is an
ordinary character of its tag; very long pages are read whole, in one pass; repeated rows are extracted each; an empty table gives no rows; other
columns are not read. Only white space inside blocks and unkept blocks are dropped.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

# Stop words of the languages handled, tag and marker names.
STOP_WORDS = frozenset(
    "the of and a in to is was it for with on as by at from that this be are or an not which have has had but they you "
    "de la le les des et en un une du que est pour dans qui sur au par plus ne pas ce il elle se sont avec "
    "der die das und den von zu mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass "
    "el los las y del una por con no su para al lo como más o pero sus".split()
)
RAW = "script|style|noscript|template|textarea|iframe|svg|math|object|select|option|button|title|canvas|audio|video"
BAD_TAGS = frozenset("nav aside footer form header menu dialog".split())
ARTICLE_TAGS = frozenset("article main".split())
CONTAINERS = frozenset(
    "html body div section article main nav aside footer form header menu dialog ul ol dl table tbody thead tr figure "
    "blockquote details fieldset center address".split()
)
LEAVES = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th pre hr caption figcaption summary legend label".split())
BAD_ROLES = frozenset("navigation banner contentinfo complementary search alert dialog alertdialog menu menubar".split())
BAD_MARKS = frozenset(
    "ad ads adv advert adverts advertisement banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "disclaimer disqus footer header masthead menu modal nav navbar navigation newsletter notice notices pager "
    "pagination popup promo promoted recommended related replies reply share sharing sidebar signup social sponsor "
    "sponsored subscribe subscription toolbar widget".split()
)

TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({RAW})\b[^>]*>.*?(?:</\1\s*>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>=]++|=\s*\"[^\"]*\"|=\s*'[^']*'|=)*)(?:>|\Z)|<[!?][^>]*(?:>|\Z)",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)
WORD = re.compile(r"[^\W\d_]+")
LONG = 40
LINK_SHARE = 0.5
STOP_DENSITY = 0.05


@dataclass
class Block:
    text: str
    link_chars: int
    marked_bad: bool
    in_article: bool


def marks_bad(name: str, attributes: str, in_article: bool) -> bool:
    """A header inside an article holds its heading; outside, the site's."""
    if name in BAD_TAGS and not (name == "header" and in_article):
        return True
    if not attributes.strip():
        return False
    for key, value in ATTRIBUTE.findall(attributes):
        key, value = key.lower(), value.strip("\"'").lower()
        if key == "hidden" or key == "aria-hidden" and value == "true":
            return True
        if key == "role" and value in BAD_ROLES:
            return True
        if key == "style" and "display:none" in value.replace(" ", ""):
            return True
        if key in ("class", "id") and BAD_MARKS & set(re.split(r"[\s_-]+", value)):
            return True
    return False


def blocks(page: str) -> tuple[list[Block], bool]:
    """Blocks in page order, and whether the page marks an article."""
    found: list[Block] = []
    stack: list[tuple[str, bool, bool]] = []  # tag, marked bad, in an article
    parts: list[str] = []
    links = at = 0
    in_link = leaf_bad = has_article = False

    def close() -> None:
        nonlocal links, leaf_bad
        text = " ".join("".join(parts).split())
        if text:
            _, bad, article = stack[-1] if stack else ("", False, False)
            found.append(Block(text, links, bad or leaf_bad, article))
        parts.clear()
        links, leaf_bad = 0, False

    for token in TOKEN.finditer(page):
        if token.start() > at:
            text = html.unescape(page[at : token.start()])
            parts.append(text)
            links += len(text.strip()) * in_link
        at = token.end()
        name = (token.group(3) or "").lower()
        if not name:
            if token.group(1) and token.group(1).lower() not in ("script", "style", "noscript", "template"):
                parts.append(" ")
            continue
        closing = bool(token.group(2))
        if name == "a":
            in_link = not closing
        elif name == "br":
            parts.append("\n")
        elif name in CONTAINERS:
            close()
            in_link = False
            if not closing:
                _, bad, article = stack[-1] if stack else ("", False, False)
                has_article |= name in ARTICLE_TAGS
                inside = article or name in ARTICLE_TAGS
                stack.append((name, bad or marks_bad(name, token.group(4), article), inside))
            elif any(name == open_name for open_name, _, _ in stack):
                while stack.pop()[0] != name:
                    pass
        elif name in LEAVES:
            close()
            in_link = False
            if not closing:
                leaf_bad = marks_bad(name, token.group(4), False)
    if at < len(page):
        parts.append(html.unescape(page[at:]))
    close()
    return found, has_article


def first_label(block: Block, has_article: bool) -> bool | None:
    """True for good, False for bad, None where neighbours decide."""
    if block.marked_bad or has_article and not block.in_article:
        return False
    if block.link_chars > LINK_SHARE * len(block.text):
        return False
    if len(block.text) < LONG:
        return None
    if block.in_article:
        return True
    words = WORD.findall(block.text.lower())
    stops = sum(word in STOP_WORDS for word in words)
    return bool(words) and stops >= STOP_DENSITY * len(words)


def labels(found: list[Block], has_article: bool) -> list[bool]:
    """Labels after both passes."""
    first = [first_label(block, has_article) for block in found]
    n = len(found)
    # Distance to, and label of, the nearest decided unmarked block on either side.
    near: list[list[tuple[int, bool] | None]] = []
    for order in (range(n), range(n - 1, -1, -1)):
        seen: list[tuple[int, bool] | None] = [None] * n
        last = None
        for k in order:
            seen[k] = last and (abs(k - last[0]), last[1])
            if first[k] is not None and not found[k].marked_bad:
                last = (k, first[k])
        near.append(seen)
    out = []
    for k, label in enumerate(first):
        if label is None:
            sides = [side for side in (near[0][k], near[1][k]) if side]
            closest = min((distance for distance, _ in sides), default=0)
            label = any(good for distance, good in sides if distance == closest) if sides else True
            label = label or found[k].in_article
        out.append(label)
    return out


def main_text(page: str | None) -> str:
    found, has_article = blocks(page or "")
    return "\n\n".join(block.text for block, good in zip(found, labels(found, has_article), strict=True) if good)


def extract(pages: DataFrame, keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """``keep`` columns, text and n_chars of every page."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pages.select(*keep).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py()) for page in batch.column("_html")]
            columns = [*[batch.column(name) for name in keep], pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*keep, "text", "n_chars"])

    source = pages.select(*keep, pages["html"].alias("_html"))
    return source.mapInArrow(run, f"{fields}, text string, n_chars long")
