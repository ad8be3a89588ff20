"""Main text of web pages by two passes of block rules.

The first pass parts a page into blocks and decides those that it can: by the element they lie in, by their share of
stop words, their length and the share of their text that is linked. Short or unclear blocks are left open. The second pass gives an open block
the label of its nearest decided neighbours. The blocks of many pages are labelled together, by array operations.
"""

from __future__ import annotations

import re
from collections import Counter
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from starlens.llm.common import known, per_slice
from starlens.llm.words import slices

#: Bytes of pages that a worker parts at once; a longer page is one of its own.
TOGETHER = 1 << 21
#: Characters from which a block is long, and under which it is short.
LONG, SHORT = 140, 50
#: Shares of stop words among the words of prose, for long blocks and others.
PROSE, SURE_PROSE = 0.15, 0.25
#: Shares of linked characters above which a block is a list of links, in an article and elsewhere.
ARTICLE_LINKS, OTHER_LINKS = 0.5, 0.25

# Elements of HTML by what they do.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("iframe noembed noframes script style textarea title xmp".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
BLOCK_BUT_P = BLOCK - {"p"}
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
TABLE = frozenset(("table", "caption", "td", "th"))
#: What a new element of a kind ends if it is open, and where the search for it stops.
ENDS = {
    "li": (("li",), ("ul", "ol", "menu", "dir")), "dd": (("dd", "dt"), ("dl",)), "dt": (("dd", "dt"), ("dl",)), "tr": (("tr",), ("table",)),
    "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")), "option": (("option",), ("select", "optgroup")),
    "tbody": (("tbody", "thead", "tfoot"), ("table",)), "thead": (("tbody", "thead", "tfoot"), ("table",)), "tfoot": (("tbody", "thead", "tfoot"), ("table",)),
}
#: Elements, roles and words of class names or ids whose content is no main text.
ASIDE_ELEMENTS = frozenset("aside audio button canvas datalist dialog footer math menu nav noscript object search select svg template video".split())
ASIDE_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar tooltip".split())
ASIDE_WORDS = frozenset(
    "ad ads advert advertisement adverts advertising alert banner breadcrumb breadcrumbs comment commentlist comments consent cookie cookies copyright disqus footer "
    "login masthead menu modal nav navbar navigation newsletter notice notices notification overlay pager pagination popup promo promoted promotion related "
    "respond search share sharing sidebar signup social sponsor sponsored subscribe subscription toolbar".split()
)
#: Names of which an aside word is part although they say something else: ``no-sidebar``, ``comments-open``.
OTHERWISE_BEFORE = frozenset(("has", "no", "with", "without", "hide", "js"))
OTHERWISE_LAST = frozenset(("closed", "disabled", "enabled", "layout", "off", "on", "open"))
CONTENT_NAMES = frozenset("article articlebody articlecontent articletext body bodytext content entry entrycontent maincontent post postbody postcontent pagecontent storybody storycontent".split())
ASIDE_HEADING = re.compile(
    r"\W*(?:\d+\s+)?(?:(?:reader|user)s?'?\s+)?(?:comments?|kommentare?|commentaires?|comentarios?|replies|responses?|related(?: (?:articles?|posts?|stories))?|"
    r"(?:leave|post|write|add) a (?:comment|reply))\W*(?:\d+\W*)?", re.IGNORECASE
)
# The most frequent function words of four languages.
STOP_WORDS = frozenset(
    # English
    "the of and to a in is it that for on are as with was be by this have from or an not at you which but we they his had".split()
    # German
    + "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach bei einer um am".split()
    # French
    + "le la les de des du et à un une est que en dans pour qui par sur au aux ce il se pas plus ne son avec sont ou".split()
    # Spanish
    + "el los las de del y que en un una es por con para su se no lo al como más o pero sus este ha entre cuando".split()
)

OPEN = re.compile(r"<(?:!--|[!?]|/?[A-Za-z]|/)")
TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')|=)*+)>")
COMMENT_END = re.compile(r"--!?>")
TOLD = re.compile(r"(?:class|id|role|hidden|itemprop)", re.IGNORECASE)
ATTRIBUTE = re.compile(r"([^\s=/>\"']++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]++)))?+")
NAME_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
WORD = re.compile(r"[^\W\d_]+")

PLAIN, CONTENT, MAIN, ARTICLE, IN_FORM, ASIDE = range(6)


def named(attributes: str, element: str, marked: bool) -> tuple[bool, int]:
    """Whether attributes put an element aside, and the kind of place they name; ``marked``: inside an article or a main part."""
    aside, place = False, PLAIN
    for name, *values in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), next((v for v in values if v), "")
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            aside = aside or value.lower() not in ("false", "until-found")
        elif name == "role":
            aside = aside or value.strip().lower() in ASIDE_ROLES
            place = max(place, {"article": ARTICLE, "main": MAIN}.get(value.strip().lower(), PLAIN))
        elif name == "itemprop" and value.strip().lower() == "articlebody":
            place = max(place, MAIN)
        elif name in ("class", "id") and element not in ("html", "body", "main"):
            for one in value.split():
                words = [w.lower() for w in NAME_WORDS.findall(one)]
                if words and words[-1] not in OTHERWISE_LAST and (element != "article" or len(words) == 1):  # an article only by a name that says nothing else
                    said = next((w for w in words if w in ASIDE_WORDS or w in OTHERWISE_BEFORE or (w == "header" and not marked)), "")
                    aside = aside or (said != "" and said not in OTHERWISE_BEFORE)
                if "".join(words) in CONTENT_NAMES:
                    place = max(place, CONTENT)
    return aside, place


class Page:
    """Parts one page into blocks: ``blocks`` has (text, place, linked characters, level of the heading or 0)."""

    def __init__(self, page: str):
        self.blocks: list[tuple[str, int, int, int]] = []
        self.stack: list[tuple[str, bool, int]] = []  # name, aside, place
        self.open: Counter[str] = Counter()
        self.asides = self.forms = self.outer_forms = 0
        self.places = [0] * 4
        self.parts: list[str] = []
        self.aside_parts: list[str] = []
        self.begun = False
        self.linked, self.place, self.breaks, self.level = 0, PLAIN, 0, 0
        self.cut: tuple[int, int] | None = None  # depth and level of a heading that begins comments
        self.walk(page)
        self.flush()

    def walk(self, page: str) -> None:
        at = 0
        while True:
            m = OPEN.search(page, at)
            if m is None:
                self.text(page[at:])
                return
            if m.start() > at:
                self.text(page[at : m.start()])
            sign = m.group()
            if sign == "<!--":
                end = COMMENT_END.search(page, m.start() + 2)
                at = end.end() if end else len(page)
            elif sign in ("<!", "<?", "</"):
                at = page.find(">", m.end()) + 1 or len(page)
            else:
                tag = TAG.match(page, m.start())
                if tag is None:  # cut off within a tag
                    return
                at, name = tag.end(), tag[2].lower()
                if tag[1]:
                    self.end(name)
                elif name in RAW:
                    closing = re.compile(rf"</{name}(?=[\s/>])", re.IGNORECASE).search(page, at)
                    if closing is None:
                        return
                    at = page.find(">", closing.end()) + 1 or len(page)
                else:
                    self.start(name, tag[3])

    def text(self, raw: str) -> None:
        if not raw:
            return
        piece = unescape(raw) if "&" in raw else raw
        blank = not piece.strip()
        if not blank:
            self.breaks = 0
        if self.asides or self.cut:
            self.aside_parts.append(piece)
            return
        if not blank and not self.begun:
            self.begun = True
            inside = next((p for p in (ARTICLE, MAIN, CONTENT) if self.places[p]), PLAIN)
            self.place = IN_FORM if self.forms > self.outer_forms else inside
        self.parts.append(piece)
        if self.open["a"] and not blank:
            self.linked += len("".join(piece.split()))

    def flush(self) -> None:
        """The end of a block."""
        text = " ".join("".join(self.parts).split()) if self.parts else ""
        aside = " ".join("".join(self.aside_parts).split()) if self.aside_parts else ""
        if text and self.level and ASIDE_HEADING.fullmatch(text):
            aside, text, self.cut = text, "", (len(self.stack) - 1, self.level)
        if text:
            self.blocks.append((text, self.place, self.linked, self.level))
        elif aside:
            self.blocks.append((aside, ASIDE, 0, self.level))
        self.parts, self.aside_parts, self.begun, self.linked, self.place, self.breaks = [], [], False, 0, PLAIN, 0

    def start(self, name: str, attributes: str) -> None:
        if name == "br":
            self.breaks += 1
            if self.breaks == 2:
                self.flush()
            else:
                (self.aside_parts if self.asides or self.cut else self.parts).append(" ")
            return
        if name in BLOCK:
            self.flush()
            if self.open["p"]:
                self.close(("p",), BLOCK_BUT_P)
            if name in ENDS and any(self.open[x] for x in ENDS[name][0]):
                self.close(*ENDS[name])
            if name in HEADINGS and self.cut and int(name[1]) <= self.cut[1]:
                self.cut = None
        if name in VOID:
            return
        if name == "a" and self.open["a"]:
            self.close(("a",), BLOCK)
        elif name not in BLOCK and attributes.endswith("/"):
            return
        aside, place = named(attributes, name, any(self.places[MAIN:])) if TOLD.search(attributes) else (False, PLAIN)
        aside = aside or name in ASIDE_ELEMENTS or (name == "header" and not any(self.places[MAIN:]))
        place = max(place, {"article": ARTICLE, "main": MAIN}.get(name, PLAIN)) if not aside else PLAIN
        if place and not any(self.places):
            self.outer_forms = self.forms
        self.stack.append((name, aside, place))
        self.open[name] += 1
        self.asides += aside
        self.places[place] += place > 0
        self.forms += name == "form"
        if name in HEADINGS:
            self.level = int(name[1])

    def end(self, name: str) -> None:
        if name == "br":
            return self.start(name, "")
        if name in HEADINGS:
            self.flush()
            if any(self.open[h] for h in HEADINGS):
                self.close(tuple(HEADINGS), TABLE)
        elif name in BLOCK:
            self.flush()
            if self.open[name] and name not in ("body", "html"):
                self.close((name,), () if name in TABLE or name in ENDS else TABLE)
        elif self.open[name]:
            self.close((name,), () if name in ASIDE_ELEMENTS else BLOCK)

    def close(self, names: tuple[str, ...], until) -> None:
        """Close the innermost open element of ``names`` and all in it, unless one of ``until`` lies between."""
        at = len(self.stack) - 1
        while at >= 0 and self.stack[at][0] not in names:
            if self.stack[at][0] in until:
                return
            at -= 1
        while len(self.stack) > max(at, 0):
            name, aside, place = self.stack.pop()
            self.open[name] -= 1
            self.asides -= aside
            self.places[place] -= place > 0
            self.forms -= name == "form"
            if name in HEADINGS:
                self.level = 0
            if not any(self.places):
                self.outer_forms = 0
        if self.cut and len(self.stack) < self.cut[0]:
            self.cut = None


def features(pages: list[str]) -> tuple[list[str], dict[str, np.ndarray]]:
    """The texts of all blocks of all pages, and their numbers: page, place, length, shares of stop words and links, heading level."""
    texts: list[str] = []
    rows: list[tuple[int, int, int, float, float, int]] = []
    for i, page in enumerate(pages):
        for text, place, linked, level in Page(page).blocks:
            words = WORD.findall(text.lower())
            stops = sum(map(STOP_WORDS.__contains__, words))
            texts.append(text)
            rows.append((i, place, len(text), stops / len(words) if words else 0.0, linked / (len(text) - text.count(" ")), level))
    columns = zip(*rows, strict=True) if rows else ([] for _ in range(6))
    kinds = (np.int64, np.int64, np.int64, float, float, np.int64)
    return texts, {name: np.array(c, kind) for name, c, kind in zip(("page", "place", "length", "stops", "links", "level"), columns, kinds, strict=True)}


def first_pass(f: dict[str, np.ndarray], pages: int) -> np.ndarray:
    """1 for main text, -1 for none, 0 for open, -2 for blocks that also say nothing about their neighbours.

    Blocks put aside, and if a page marks its article, all outside it, are out. The same goes for the weaker marks (main part, content), if there is no article, and for forms unless
    all is in forms. Of the others, link lists are none; long prose and shorter sure prose is main text; long blocks without stop words outside any marked place are none.
    """
    page, place, length = f["page"], f["place"].copy(), f["length"]
    loose = np.ones(pages, bool)
    loose[page[place < IN_FORM]] = False
    place[(place == IN_FORM) & loose[page]] = PLAIN
    strongest = np.zeros(pages, np.int64)
    inside = place < IN_FORM
    np.maximum.at(strongest, page[inside], place[inside])
    out = ~inside | (place < strongest[page])
    marked = place > PLAIN
    linked = f["links"] > np.where(marked, ARTICLE_LINKS, OTHER_LINKS)
    prose = ((length >= LONG) & (f["stops"] >= PROSE)) | ((length >= SHORT) & (f["stops"] >= SURE_PROSE))
    empty = (length >= LONG) & (f["stops"] < PROSE / 3) & ~marked
    return np.select([out, linked, prose, empty], [-2, -1, 1, -1], 0)


def looking_back(label: np.ndarray, page: np.ndarray, marked: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distance to the last decided block of the same page, its label, and whether there is one; the edge of a marked place stands for main text."""
    at = np.arange(len(label))
    first = np.searchsorted(page, page)
    last = np.maximum.accumulate(np.where(label != 0, at, -1))
    found = last >= first
    gap = np.where(found, at - last, np.where(marked, at - first + 1, 2 * len(label) + 2))
    return gap, np.where(found, label[last], 1), found


def second_pass(first: np.ndarray, page: np.ndarray, level: np.ndarray, marked: np.ndarray) -> np.ndarray:
    """Whether each block is main text: open blocks take the label of the nearest decided block of their page.

    Headings below the first level take that of what follows. At equal distance, and where nothing is decided, a block counts as main text.
    """
    kept = np.flatnonzero(first > -2)  # the others are no neighbours
    label, of, inside = first[kept], page[kept], marked[kept]
    gap_before, before, _ = looking_back(label, of, inside)
    gap_after, after, found = (x[::-1] for x in looking_back(label[::-1], -of[::-1], inside[::-1]))
    nearer = np.where(gap_before < gap_after, before, np.where(gap_after < gap_before, after, np.maximum(before, after)))
    nearer = np.where((level[kept] > 1) & found, after, nearer)
    main = np.zeros(len(first), bool)
    main[kept] = np.where(label != 0, label, nearer) > 0
    return main


def labelled(pages: list[str]) -> tuple[list[str], dict[str, np.ndarray], np.ndarray, np.ndarray]:
    """Texts and features of all blocks, what the first pass says of each, and whether it is main text."""
    texts, f = features(pages)
    first = first_pass(f, len(pages))
    return texts, f, first, second_pass(first, f["page"], f["level"], f["place"] > PLAIN)


def main_text(pages: DataFrame, html: str = "html", text: str = "text") -> DataFrame:
    """All columns of ``pages`` and ``text``: the blocks of the main text in page order, with a line feed between.

    White space inside a block is one space, character references are decoded. Null pages count as empty; pages without main text give an empty string.
    A column called as the new one is replaced.
    """
    if text == html:
        raise ValueError("the text needs another name than the pages")
    source = known(pages, html).drop(text)
    names = source.columns

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, f, _, main = labelled(batch[html].to_pylist())
        kept = np.flatnonzero(main)
        ends = np.searchsorted(f["page"][kept], np.arange(batch.num_rows + 1))
        chosen = [texts[i] for i in kept.tolist()]
        joined = pa.array(["\n".join(chosen[a:b]) for a, b in zip(ends, ends[1:], strict=False)], pa.string())
        return pa.RecordBatch.from_arrays([*(batch[c] for c in names), joined], names=[*names, text])

    return source.mapInArrow(per_slice(lambda x: slices(x, TOGETHER), run, html), f"{source.schema.toDDL()}, {text} string")


def page_blocks(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """One row a block, for inspection: (key, block, text, place, stop_share, link_share, first_label, main)."""
    source = known(pages.select(key, html), html)
    kind = source.select(key).schema.toDDL()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, f, first, main = labelled(batch[html].to_pylist())
        number = np.arange(len(texts)) - np.searchsorted(f["page"], f["page"])
        columns = [batch[key].take(pa.array(f["page"])), pa.array(number), pa.array(texts, pa.string()), pa.array(f["place"]), pa.array(f["stops"]), pa.array(f["links"]), pa.array(first), pa.array(main)]
        return pa.RecordBatch.from_arrays(columns, names=[key, "block", "text", "place", "stop_share", "link_share", "first_label", "main"])

    return source.mapInArrow(per_slice(lambda x: slices(x, TOGETHER), run, html), f"{kind}, block long, text string, place long, stop_share double, link_share double, first_label long, main boolean")
