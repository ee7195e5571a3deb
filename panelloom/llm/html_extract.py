"""Main text of a web page by line-block distribution.

Markup is stripped to lines, one for each block element, and each line gets a weight. A window slides
over the lines and sums the weights of the next few. The text surges where the sum rises over the
threshold, from the line on with which the rise begins, and dives at a line of no weight from which the
sum is not over the threshold any more. What stands between a surge and its dive is the main text.

The weight of a line is the length of its text. Elements and class names weigh in: menus, page headers and
footers, side bars, notices, adverts, forms and reader comments, like scripts and styles, are lines of no
text and no weight; where a page names its article, a line in it weighs the threshold more and a line
outside nothing. On pages without one, lines that are mostly links, short items of lists and copyright
lines weigh nothing either. In an article class names count on containers only: a headline or a paragraph
is text whatever its class, and an article's own header belongs to it.

Defined cases: a null or empty page has an empty text; unclosed elements end with the page, with
their parent or, paragraphs, with the next block; a quote that is never closed ends with its tag, a tag that is never closed with the page; text
without any block element is one block; a page whose lines weigh less than the threshold in sum is main text
as a whole, but for lines of no weight; whole pages are read, of whatever length, in linear time;
repeated rows are extracted one by one; an empty table gives an empty result.
"""

from __future__ import annotations

import html as _html
import re
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import portions

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)
    |<(script|style|noscript|template|svg|textarea|select|iframe|title)\b[^>]*>.*?(?:</\1\s*>|\Z)
    |<[/!?]?[a-zA-Z](?:[^>=]++|=\s*+"[^"]*"|=\s*+'[^']*'|=)*+(?:>|\Z)
    |<[!?/][^>]*(?:>|\Z)""",
    re.DOTALL | re.IGNORECASE | re.VERBOSE,
)
_NAME = re.compile(r"</?([a-zA-Z][a-zA-Z0-9-]*)")
_MARK = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.IGNORECASE)
BLOCKS = set("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
CONTAINERS = set("aside center details dialog div dl fieldset footer form header menu nav ol section table ul".split())
CHROME = set("nav header footer aside form menu dialog button label head".split())
CHROME_WORDS = set("ad ads advert advertisement advertising banner breadcrumb breadcrumbs comment comments cookie cookies consent disclaimer footer form header login masthead menu menubar modal nav navbar navigation newsletter notice popup promo promoted promotion related search share sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split())
ARTICLE_WORDS = set("article".split())
ITEMS = set("li td th dt dd".split())
#: Outside an article, list items below this length that end like no sentence weigh nothing.
SHORT_ITEM = 30
_WORDS = re.compile(r"[a-z]+|[A-Z][a-z]*")
_SPACE = re.compile(r"\s+")
_RIGHTS = re.compile(r"(?:©|\(c\)|copyright\b|all rights reserved\b)", re.IGNORECASE)


class Line(NamedTuple):
    """A block of text, or (without text) what is left of page furniture."""

    text: str
    inside: bool = False  # in the article
    linked: int = 0  # characters of links
    item: bool = False  # an item of a list or table


def _marks(tag: str) -> set[str]:
    return {w.lower() for m in _MARK.finditer(tag) for w in _WORDS.findall(m[1] or m[2] or m[3] or "")}


def is_furniture(name: str, marks: set[str], inside: bool) -> bool:
    """Whether an element, by its name and the words of its class, is none of the text around it."""
    if name in ("html", "body", "article", "main"):
        return False
    if inside:  # the element is in an article or is named one
        words = marks & CHROME_WORDS - {"header"}
        return name in CHROME - {"header", "label"} or name in CONTAINERS and bool(words)
    return name in CHROME or bool(marks & CHROME_WORDS)


def page_lines(page: str) -> list[Line]:
    """Lines in page order; neighbouring furniture is one line without text."""
    lines: list[Line] = []
    parts: list[str] = []
    stack: list[tuple[str, bool, bool]] = []  # element, furniture within, article within
    open_: dict[str, int] = {}
    paragraph = None  # place of an open paragraph: any block ends it
    at = linked = links = 0

    def flush():
        nonlocal linked
        if parts:
            text = _SPACE.sub(" ", _html.unescape("".join(parts))).strip()
            if text:
                item = next((s[0] for s in reversed(stack) if s[0] in BLOCKS), "") in ITEMS
                lines.append(Line(text, bool(stack) and stack[-1][2], linked, item))
            parts.clear()
        linked = 0

    def gap():
        if lines and lines[-1].text:
            lines.append(Line(""))

    def close(depth: int):
        """End the elements from ``depth`` on."""
        nonlocal paragraph, links
        hidden = stack[-1][1]
        if not hidden and any(s[0] in BLOCKS for s in stack[depth:]):
            flush()
        for s in stack[depth:]:
            open_[s[0]] -= 1
            links -= s[0] == "a"
        del stack[depth:]
        if paragraph is not None and paragraph >= depth:
            paragraph = None
        if hidden and not (stack and stack[-1][1]):
            gap()

    for token in _TOKEN.finditer(page):
        if token.start() > at and not (stack and stack[-1][1]):
            parts.append(page[at : token.start()])
            linked += token.start() - at if links else 0
        at = token.end()
        tag = token[0]
        named = _NAME.match(tag)
        if token[1] or not named:
            continue
        name = named[1].lower()
        if tag[1] == "/":
            if open_.get(name):
                depth = len(stack) - 1
                while stack[depth][0] != name:
                    depth -= 1
                close(depth)
            continue
        if name in BLOCKS:
            if paragraph is not None:
                close(paragraph)
            if not (stack and stack[-1][1]):
                flush()
        elif name in VOID:
            if not (stack and stack[-1][1]):
                parts.append(" ")
            continue
        if name == "hr" or tag.endswith("/>"):
            continue
        above = stack[-1] if stack else ("", False, False)
        marks = _marks(tag) if len(tag) > len(name) + 2 else set()
        inside = above[2] or name in ("article", "main") or bool(marks & ARTICLE_WORDS) or "main" in marks and name == "div"
        furniture = above[1] or is_furniture(name, marks, inside)
        if furniture and not above[1]:
            flush()
            gap()
        stack.append((name, furniture, inside))
        open_[name] = open_.get(name, 0) + 1
        links += name == "a"
        if name == "p":
            paragraph = len(stack) - 1
    if not (stack and stack[-1][1]):
        parts.append(page[at:])
        flush()
    return lines


def line_weights(lines: list[Line], threshold: int) -> list[int]:
    """What each line weighs in the sums of the windows."""
    if any(line.inside for line in lines):
        return [len(line.text) + threshold if line.inside and line.text else 0 for line in lines]

    def alone(line: Line) -> int:
        n = len(line.text)
        menu = 2 * line.linked > n or line.item and n < SHORT_ITEM and line.text[-1] not in ".!?:;\u3002"
        return 0 if not n or menu or _RIGHTS.match(line.text) else n

    weights = [alone(line) for line in lines]
    return [w + threshold if w else 0 for w in weights] if sum(weights) <= threshold else weights


def between_surge_and_dive(weights: list[int], width: int, threshold: int) -> list[bool]:
    """Lines between each surge of the window sums and its dive.

    The sum at a line is that of the ``width`` lines from it on. It surges at a line of some weight where it
    is over ``threshold``; the lines of some weight right before, at which it rises, belong to the surge. It
    dives at a line of no weight where it is not over ``threshold``.
    """
    n = len(weights)
    before = [0]
    for w in weights:
        before.append(before[-1] + w)
    over = [before[min(i + width, n)] - before[i] > threshold for i in range(n)]
    keep = [False] * n
    flows = False
    rise = 0  # first of the lines of some weight that run up to here
    for i in range(n):
        if weights[i]:
            if not flows and over[i]:
                keep[rise:i] = [True] * (i - rise)
                flows = True
        else:
            rise = i + 1
            flows = flows and over[i]
        keep[i] = flows
    return keep


def extract_text(page: str | None, width: int = 3, threshold: int = 80) -> str:
    """Blocks of the main text, with an empty line between them."""
    lines = page_lines(page or "")
    keep = between_surge_and_dive(line_weights(lines, threshold), width, threshold)
    return "\n\n".join(line.text for line, kept in zip(lines, keep, strict=True) if kept and line.text)


def extract(pages: DataFrame, id: str = "page_id", url: str = "url", page: str = "html", width: int = 3, threshold: int = 80) -> DataFrame:
    """One row per row of ``pages``: id, URL, main text and its length in code points."""

    def run(batches):
        for batch in portions(batches, "html"):
            texts = [extract_text(h, width, threshold) for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[id, url, "text", "n_chars"])

    narrow = pages.select(F.col(id), F.col(url).cast("string").alias(url), F.col(page).cast("string").alias("html"))
    return narrow.mapInArrow(run, f"`{id}` {pages.schema[id].dataType.simpleString()}, `{url}` string, text string, n_chars long")
