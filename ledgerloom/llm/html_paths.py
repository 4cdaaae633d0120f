"""Main text of web pages by tag-path ratios.

The text nodes of a page are grouped by their root-to-leaf tag path. Per path the text length and the punctuation per node are
summed; both ratios are smoothed along the page and fused with the path's whole length into one value per path. Element names, roles
and class words that tell of menus, adverts, comments and the like lower a path's value, nothing more; paths whose value reaches a
threshold are content. Headings, list items, cells and other short blocks that stand beside the best of them go with it.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerloom.llm.common import small_batches

#: A path is content if its value reaches this share of the mean over the page's text, which counts by its multipliers.
THRESHOLD = 0.4
#: Short blocks beside the best path go with it unless so much of them is links.
MOST_LINKS = 0.5
#: What a path's value is multiplied by: in a part that is surely no content, in one that may be none, outside the page's article.
SURELY, MAYBE, OUTSIDE = 0.05, 0.5, 0.2
#: Such a word on a paragraph, an item or a cell alone tells less.
MAYBE_ON_TEXT = 0.7
#: Power of a path's share of text in its value.
SHARE = 0.25
#: Weights of the smoothing window over neighbouring text nodes.
KERNEL = np.array([0.06, 0.24, 0.40, 0.24, 0.06])

# Element names and class words (fixed values).
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span strike strong "
    "sub sup time tt u var wbr".split()
)
SKIPPED = frozenset(
    "audio button canvas embed frameset head iframe input map noframes noscript object option script select style svg template textarea "
    "title video".split()
)
LAYOUT = frozenset("aside dialog footer menu nav".split())
RAW = ("script", "style", "textarea", "title", "iframe", "noframes", "noscript", "template", "svg")
TEXTUAL = frozenset("h1 h2 h3 h4 h5 h6 p li dt dd blockquote pre td th caption figcaption article section main".split())
CLOSES_PARAGRAPH = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p "
    "pre section table ul".split()
)
CLOSED_BY_OWN = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}
SURE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adbox adslot sponsor sponsored promo sidebar menu menubar nav navbar navigation "
    "breadcrumb breadcrumbs footer masthead topbar toolbar notice notices cookie cookies consent gdpr popup modal comment comments "
    "commentlist respond reply replies disqus share sharing newsletter subscribe subscription signup login pagination pager".split()
)
MAYBE_WORDS = frozenset("side header banner rail privacy overlay discussion social related recommended promotion search tags widget skip hidden".split())
# Words that do not change what a class name says (fixed values): "comments-area" is about comments, "side-effects" about something else.
NEUTRAL_WORDS = frozenset(
    "area article bar body block bottom box col column container content count desktop feed fixed floating form global group head holder "
    "inner item items large left link links list main mobile module outer page panel post primary right row secondary section site slot "
    "small sticky text thread title top unit wrap wrapper".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert alertdialog toolbar".split())
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<raw>" + "|".join(RAW) + r")\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"""|<(?P<close>/?)(?P<tag>[a-z][^\s/>]*)(?P<attributes>(?:[^"'>]|"[^"]*"|'[^']*')*+>|[^>]*(?:>|\Z))|</[^>]*(?:>|\Z)""",
    re.IGNORECASE | re.DOTALL,
)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.IGNORECASE)
_WORD = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_PUNCTUATION = re.compile(r"[.,;:!?…。，、；：！？]")


class Node(NamedTuple):
    """A run of text: block number, path, text, whether it stands in a link, what its surroundings tell, whether it is in a form."""

    block: int
    path: tuple[str, ...]
    text: str
    linked: bool
    hint: float
    form: bool


def _says(names: str) -> int:
    """What class names or an id say: 2 surely no content, 1 maybe none, 0 nothing."""
    most = 0
    for name in names.split():
        words = set(_WORD.findall(_CAMEL.sub(" ", name).lower()))
        if words <= SURE_WORDS | MAYBE_WORDS | NEUTRAL_WORDS:
            most = max(most, 2 if words & SURE_WORDS else 1 if words & MAYBE_WORDS else 0)
    return most


def _marks(attributes: str) -> tuple[str, int, bool]:
    """The first class of an element, what its names and role say, and whether it is not shown."""
    first, says, unseen = "", 0, False
    for m in _ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name in ("class", "id"):
            first = first or value.split(" ")[0]
            says = max(says, _says(value))
        elif name == "role":
            says = 2 if value.lower() in ROLES else says
        elif name == "hidden":
            unseen = True
        elif name == "aria-hidden":
            unseen = unseen or value.lower() == "true"
        else:
            unseen = unseen or "display:none" in value.replace(" ", "").lower()
    return first, says, unseen


def text_nodes(page: str) -> list[Node]:
    """The page's text nodes outside what is never shown. Inline elements do not end a block and are not part of a path."""
    stack: list[tuple[str, str, bool, float]] = []  # element, its name in the path, whether it skips, what it and those around it tell
    nodes: list[Node] = []
    path: tuple[str, ...] = ()
    block = skipping = links = forms = last = 0

    def pop(to: int) -> None:
        nonlocal skipping, forms, path
        for tag, _, skips, _ in stack[to:]:
            skipping -= skips
            forms -= tag == "form"
        del stack[to:]
        path = tuple(name for _, name, _, _ in stack)

    def add(text: str) -> None:
        if not skipping and text:
            nodes.append(Node(block, path, html.unescape(text) if "&" in text else text, links > 0, stack[-1][3] if stack else 1.0, forms > 0))

    for m in _TOKEN.finditer(page):
        if m.start() > last:
            add(page[last : m.start()])
        last = m.end()
        tag = (m["tag"] or "").lower()
        if not tag:
            if m["raw"]:
                block += m["raw"].lower() not in ("script", "style", "svg", "template")
            continue
        if tag in INLINE:
            if tag == "a":
                links = 0 if m["close"] else 1
            elif tag == "br":
                add(" ")
            elif not m["close"] and m["attributes"] and len(m["attributes"]) > 3 and tag == "span" and not skipping and _marks(m["attributes"])[2]:
                stack.append(("span", "span", True, 1.0))
                skipping += 1
            elif m["close"] and tag == "span" and stack and stack[-1][0] == "span":
                pop(len(stack) - 1)
            continue
        block += 1
        links = 0
        if m["close"]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    pop(k)
                    break
            continue
        if tag in ("html", "body") and any(s[0] == tag for s in stack):
            continue
        if tag in CLOSES_PARAGRAPH:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == "p":
                    pop(k)
                    break
                if stack[k][0] in ("td", "th", "li", "div", "button"):
                    break
        elif tag in CLOSED_BY_OWN:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag or (tag in ("dt", "dd") and stack[k][0] in ("dt", "dd")) or (tag in ("td", "th") and stack[k][0] in ("td", "th")):
                    pop(k)
                    break
                if stack[k][0] in CLOSED_BY_OWN[tag]:
                    break
        elif tag == "body":
            pop(next((k for k, s in enumerate(stack) if s[0] == "head"), len(stack)))
        if tag in VOID or m["attributes"].endswith("/>") and tag not in CLOSES_PARAGRAPH:
            continue
        first, says, unseen = _marks(m["attributes"]) if len(m["attributes"]) > 3 else ("", 0, False)
        if tag in ("html", "body", "main"):
            says = 0
        elif tag in LAYOUT or (tag == "header" and not any(s[0] in ("article", "main") for s in stack)):
            says = 2
        hint = (1.0, MAYBE_ON_TEXT if tag in TEXTUAL and tag not in ("article", "section") else MAYBE, SURELY)[says]
        skips = tag in SKIPPED or unseen
        stack.append((tag, f"{tag}.{first}" if first else tag, skips, min(hint, stack[-1][3]) if stack else hint))
        skipping += skips
        forms += tag == "form"
        path = (*path, stack[-1][1])
    if last < len(page):
        add(page[last:])
    return nodes


def main_text(page: str | None, threshold: float = THRESHOLD) -> str:
    """Content blocks in page order, white space turned into single spaces; '' for NULL and pages without text.

    A form that holds more than half of a page's text is the page, any other is surely no content.
    """
    nodes = [n for n in text_nodes(page or "") if n.text]
    blocks: list[tuple[tuple[str, ...], float, bool, str, int]] = []  # path, hint, in a form, text, characters in links
    k = 0
    while k < len(nodes):
        end = k
        while end < len(nodes) and nodes[end].block == nodes[k].block:
            end += 1
        text = " ".join("".join(n.text for n in nodes[k:end]).split())
        if text:
            linked = sum(len(n.text.strip()) for n in nodes[k:end] if n.linked)
            blocks.append((nodes[k].path, nodes[k].hint, nodes[k].form, text, min(len(text), linked)))
        k = end
    if not blocks:
        return ""
    length = np.array([len(b[3]) for b in blocks], dtype=float)
    form = np.array([b[2] for b in blocks])
    if length[form].sum() <= length.sum() / 2:
        blocks = [(p, min(h, SURELY) if f else h, f, t, n) for p, h, f, t, n in blocks]
    number: dict[tuple[tuple[str, ...], float], int] = {}
    of = np.array([number.setdefault(b[:2], len(number)) for b in blocks])
    marks = np.array([len(_PUNCTUATION.findall(b[3])) for b in blocks], dtype=float)
    linked = np.array([b[4] for b in blocks], dtype=float)
    sums = lambda x: np.bincount(of, weights=x, minlength=len(number))
    count, chars = sums(np.ones(len(of))), sums(length)
    links = sums(linked) / chars

    def smooth(x: np.ndarray) -> np.ndarray:
        padded = np.pad(x, len(KERNEL) // 2, mode="edge")
        return np.convolve(padded, KERNEL, mode="valid")

    ratio, punctuation = smooth((chars / count)[of]), smooth((sums(marks) / count)[of])
    value = sums(ratio * (0.1 + punctuation)) / count * (1 - links) * (chars / chars.max()) ** SHARE
    hint = np.array([h for _, h in number])
    article = np.array([any(name.split(".")[0] in ("article", "main") for name in p) for p, _ in number]) & (hint > SURELY)
    weight = hint * np.where(article, 1.0, OUTSIDE if article.any() else 1.0)
    fused = value * weight
    mean = float((fused * weight * chars).sum() / (weight * weight * chars).sum())
    passes = (fused >= threshold * mean) & (fused > 0)
    best = int(np.argmax(fused * weight * chars))
    if passes[best]:
        # What stands beside the best path: in its article, else under its parent if it is a paragraph or the like, else under itself.
        path = list(number)[best][0]
        kind = [name.split(".")[0] for name in path]
        whole = next((k + 1 for k in range(len(kind) - 1, -1, -1) if kind[k] in ("article", "main")), 0)
        beside = path[:whole] if whole else path[:-1] if path and kind[-1] in TEXTUAL and kind[-1] != "section" else path
        for (p, h), k in number.items():
            if p[: len(beside)] == beside and h >= hint[best] and links[k] <= MOST_LINKS:
                passes[k] |= whole > 0 or not p or p[-1].split(".")[0] in TEXTUAL
    return " ".join(b[3] for b, k in zip(blocks, of, strict=True) if passes[k])


def extract(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars (code points).

    Reads the whole html; NULL, empty and text-free pages give ''. Cut-off pages are read to their end. Repeated rows give one row
    each, and NULL page_ids and urls are kept. Other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "html", 4 << 20):
            texts = [main_text(h.as_py()) for h in batch.column("html")]
            yield pa.record_batch([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    id_type = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url", "html").mapInArrow(run, f"page_id {id_type}, url string, text string, n_chars long")
