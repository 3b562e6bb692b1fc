"""HTML extraction (2): the main text of a page by line-block distribution.

* *Strip.* Markup is removed; each block-level element begins a line. Elements
  that are not article text by their kind (scripts, styles, navigation, forms,
  footers, asides ...), and lines that are mostly links, leave ``WIDTH`` empty
  lines. So do those whose class or id says so (adverts, cookie notices,
  comments, sidebars ...), unless their text says otherwise: a block with the
  page's title and most of its text stays, and one whose class only begins like
  furniture's (``ad-hoc``, ``share-price``) stays if it has most of the text or is
  a paragraph, heading or cell that is not mostly links.
* *Distribution.* Text lengths are summed over windows of ``WIDTH`` lines.
* *Surge and dive.* Text runs from a surge, where the sum leaves zero, to a
  dive, where it returns to it. All runs inside ``article`` or ``main`` are
  kept; on a page without them, each run whose sum somewhere exceeds ``SURGE``
  or, on a short page, half of the page's highest sum.
  Text between the points is kept whole, short lines included.

A page is one row of a task, however long; work per page is linear in its length. Comments and the
raw contents of scripts, styles and the like are never read as markup. An
element that is not closed ends where the article or the body does.

A null or empty html has empty text. Character references are decoded; white
space within a block is one space; blocks are joined by one line break.
Repeated rows are extracted alike; null ids and urls are kept; extra columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from govlake.llm.common import pick, table

#: Lines of a window, and the sum that is a surge on a page without article markup, however long the page.
WIDTH, SURGE = 3, 86
#: A line with this share of its text in links, and fewer words than LINK_WORDS, is navigation.
LINK_SHARE, LINK_WORDS = 0.6, 12

# Names of the HTML standard.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav noframes ol optgroup option p pre search section "
    "summary table tbody tfoot thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title xmp noembed noframes iframe".split())
BOILERPLATE = frozenset(
    "head script style noscript template title textarea select button option form fieldset nav menu footer aside dialog iframe object "
    "svg canvas audio video map math xmp noembed noframes search".split()
)
#: Removed without ending the block they are in.
INLINE = frozenset("script style noscript template svg math select button textarea audio video canvas object map".split())
LANDMARKS = frozenset(("article", "main"))
#: Elements whose end tag may be left out, and the start tags that end them.
ENDED_BY = {
    "p": BLOCKS - set("body caption frameset head html legend noframes option optgroup tbody tfoot thead title tr".split()),
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "tbody", "tfoot", "thead"},
    "td": {"td", "th", "tr", "tbody", "tfoot", "thead"},
    "th": {"td", "th", "tr", "tbody", "tfoot", "thead"},
    "option": {"option", "optgroup"},
}
#: Words that name furniture, alone or as the last word of a class or id (``main-nav``).
NAMED = (
    "ads? adverts? advertisements? banners? cookies? consent gdpr notices? alerts? side-?bars? menus? nav navbar navigation breadcrumbs? "
    "footer site-?header page-?header masthead top-?bar comments? commentlist respond disqus replies share sharing social related "
    "recommend(?:ed|ations)? promo promotions? sponsor(?:ed)? newsletter subscribe subscription sign-?up log-?in search pagination pager "
    "popup modal overlay toolbar widgets? hidden sr-only skip-link"
).split()
#: Of these, words that a class may also begin with (``comment-list``) or end with (``top-banner``).
BEGINS = "ads? advert advertisement banner cookie consent gdpr comments? sidebar nav breadcrumb newsletter social share promo sponsored popup modal".split()
ENDS = "ads? advert advertisement banner notice cookie consent comments? sidebar nav menu navigation footer newsletter popup modal promo".split()
#: Words for the parts of furniture; a class that begins with a name and goes on with other words is weaker evidence.
PARTS = (
    "area author bar block body box button buttons col column container content count first footer form frame group header heading holder "
    "icon icons inline inner item items label left link links list main media menu message meta nav panel policy popup right row section "
    "side slot space text thread title toggle tools top unit widget wrap wrapper zone"
).split()
#: First words that tell what a page has or lacks, not what an element is (``no-sidebar``).
STATES = "no not non has have with without is hide show".split()
STATE = re.compile(rf"^(?:{'|'.join(STATES)})[-_]", re.IGNORECASE)
STRONG = re.compile(
    rf"^(?:{'|'.join(NAMED)})$|^(?:{'|'.join(BEGINS)})(?:[-_](?:{'|'.join(BEGINS + ENDS + PARTS)}|[0-9]+))+$|[-_](?:{'|'.join(ENDS)})$", re.IGNORECASE
)
WEAK = re.compile(rf"^(?:{'|'.join(BEGINS)})[-_]", re.IGNORECASE)
#: Elements of running text, which weak evidence removes only if they are mostly links.
RUNNING = frozenset("p h1 h2 h3 h4 h5 h6 dt dd td th blockquote pre span b i em strong".split())
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|</?[A-Za-z][^>]*+>|<[!?][^>]*+>", re.DOTALL)
BAD_TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*)([^>]*)>")
ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?")


KIND, NAME, HINT = 3, 2, 1


def evidence(name: str, attributes: str, inside: bool) -> int:
    """Why an element is no article text: its ``KIND`` (element, role, hidden), a class
    or id that is furniture's ``NAME``, one that only begins like it (``HINT``), or 0."""
    if name in BOILERPLATE or (name == "header" and not inside):
        return KIND
    if not attributes.strip() or name in ("html", "body", "article", "main"):
        return 0
    values = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(attributes)}
    if "hidden" in values or values.get("aria-hidden") == "true":
        return KIND
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", values.get("style", ""), re.IGNORECASE):
        return KIND
    if values.get("role", "") in ("navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "form", "menu"):
        return KIND
    words = [x for k in ("class", "id") for x in values.get(k, "").split() if not STATE.match(x)]
    if any(STRONG.search(x) for x in words):
        return NAME
    return HINT if any(WEAK.search(x) for x in words) else 0


@dataclass
class Suspect:
    """A block with a class like furniture's: characters of its text, how many are in
    links, and whether a heading of the first level is in it."""

    strength: int
    name: str
    depth: int
    chars: int
    linked: int
    heading: bool = False

    def is_text(self, total: int) -> bool:
        """Whether its text is the page's, for all that it is called."""
        most = 2 * self.chars > total
        if self.strength == NAME:
            return most and self.heading
        return most or (self.name in RUNNING and self.linked < LINK_SHARE * self.chars)


class Lines:
    """The lines of a page: text, characters in links, and whether they are in an article."""

    def __init__(self):
        self.text: list[str] = []
        self.linked: list[int] = []
        self.inside: list[bool] = []
        self.parts: list[str] = []
        self.link_chars = 0
        self.suspects: dict[int, Suspect] = {}  # by the place of the start tag
        self.chars = self.linked_chars = 0  # of all lines

    def add(self, data: str, in_link: bool) -> None:
        self.parts.append(data)
        n = len(data.strip())
        self.chars += n
        if in_link:
            self.link_chars += len(data)
            self.linked_chars += n

    def settle(self, pending: list[Suspect], depth: int) -> None:
        """Suspects deeper than the open blocks have ended."""
        while pending and pending[-1].depth > depth:
            s = pending.pop()
            s.chars, s.linked = self.chars - s.chars, self.linked_chars - s.linked

    def end(self, inside: bool) -> None:
        if self.parts:
            words = " ".join(html.unescape("".join(self.parts)).split())
            if words:
                self.text.append(words)
                self.linked.append(self.link_chars)
                self.inside.append(inside)
            self.parts, self.link_chars = [], 0

    def gap(self, inside: bool) -> None:
        self.end(inside)
        if self.text and self.text[-1]:
            self.text += [""] * WIDTH
            self.linked += [0] * WIDTH
            self.inside += [inside] * WIDTH


def lines_of(page: str, weigh: bool = False, text_at: frozenset[int] = frozenset()) -> Lines:
    """The lines of a page without its furniture. ``weigh``: suspects are kept and
    weighed; else they are removed but for those that start at ``text_at``."""
    out = Lines()
    pending: list[Suspect] = []
    at, n = 0, len(page)
    tail = page.rfind(">") + 1  # no tag ends after it
    landmarks: list[str] = []
    links = 0
    opened: list[str] = []  # blocks that are kept
    count: Counter[str] = Counter()  # of opened
    skip: list[str] = []  # names of open elements inside a removed one, itself first
    while at < n:
        if pending:
            out.settle(pending, len(opened))
        m = TOKEN.search(page, at) if at < tail else None
        if m is None:
            comment = page.find("<!--", max(at, tail))  # one that is not closed
            if not skip:
                out.add(page[at : comment if comment >= 0 else n], links > 0)
            break
        if m.start() > at and not skip:
            out.add(page[at : m.start()], links > 0)
        at = m.end()
        if m[2] is None:
            if m[0].startswith("<!--") or m[0][1] in "!?":
                continue
            m = BAD_TAG.match(m[0])  # quotes that do not pair
            if m is None:
                continue
        closing, name, attributes = m[1], m[2].lower(), m[3]
        if name in BLOCKS and not closing and opened and len(skip) < 2 and name in ENDED_BY.get(opened[-1], ()):
            if not skip or name in ENDED_BY.get(skip[0], ()):
                count[opened.pop()] -= 1
        if len(skip) == 1 and not closing and name in ENDED_BY.get(skip[0], ()):
            skip.clear()  # its end tag was left out; this element is its sibling
            out.gap(bool(landmarks))
        if skip:
            if closing:
                if name in skip:
                    while skip.pop() != name:
                        pass
                elif name in landmarks or count[name] or name in ("body", "html"):
                    skip.clear()
            elif name in LANDMARKS and skip[0] not in LANDMARKS and not landmarks:
                skip.clear()  # what was removed was never closed: the article begins
            elif name not in VOID and not attributes.endswith("/"):
                if name == skip[0] or name in BLOCKS and name not in ("p", "li", "option", "tr", "dt", "dd"):
                    skip.append(name)
                if name in RAW:
                    at = raw_end(page, at, name)
                    if skip and skip[-1] == name:
                        skip.pop()
                continue
            if skip:
                continue
            if closing:
                if name not in INLINE:
                    out.gap(bool(landmarks))
                if name in landmarks:
                    close(landmarks, name)
                if count[name]:
                    end_block(opened, count, name)
                continue
        if closing:
            if name == "a":
                links = max(0, links - 1)
            if name in BLOCKS:
                out.end(bool(landmarks))
                links = 0
                if count[name]:
                    end_block(opened, count, name)
            if name in LANDMARKS and name in landmarks:
                close(landmarks, name)
                out.gap(bool(landmarks))
            continue
        strength = evidence(name, attributes, bool(landmarks))
        if strength == HINT and name in RUNNING and name not in BLOCKS:
            strength = 0
        elif 0 < strength < KIND and name in BLOCKS:
            suspect = Suspect(strength, name, len(opened) + 1, out.chars, out.linked_chars)
            out.suspects[m.start()] = suspect
            if weigh:
                pending.append(suspect)
            if weigh or m.start() in text_at:
                strength = 0
        if name == "h1":
            for s in reversed(pending):
                if s.heading:  # and so have those around it
                    break
                s.heading = True
        if strength:
            if name not in INLINE:
                out.gap(bool(landmarks))
            if name in RAW:
                at = raw_end(page, at, name)
            elif name not in VOID and not attributes.endswith("/"):
                skip.append(name)
            continue
        if name in BLOCKS:
            out.end(bool(landmarks))
            opened.append(name)
            count[name] += 1
            if name in LANDMARKS:
                if not landmarks:
                    out.gap(False)
                landmarks.append(name)
        elif name == "a":
            links += 1
        elif name in ("br", "td", "th", "img", "wbr"):
            out.add("" if name == "wbr" else " ", False)
    out.end(bool(landmarks))
    out.settle(pending, -1)
    return out


def read(page: str) -> Lines:
    """The lines of a page; a class is evidence, and the text of the element decides."""
    lines = lines_of(page)
    if lines.suspects:
        weighed = lines_of(page, weigh=True)
        text_at = frozenset(at for at, s in weighed.suspects.items() if s.is_text(weighed.chars))
        if text_at:
            lines = lines_of(page, text_at=text_at)
    return lines


def close(open_names: list[str], name: str) -> None:
    while open_names.pop() != name:
        pass


def end_block(opened: list[str], count: Counter[str], name: str) -> None:
    while (last := opened.pop()) != name:
        count[last] -= 1
    count[name] -= 1


def raw_end(page: str, at: int, name: str) -> int:
    m = re.compile(rf"</{name}\s*>", re.IGNORECASE).search(page, at)
    return m.end() if m else len(page)


def main_text(page: str | None, width: int = WIDTH, surge: int = SURGE) -> str:
    """The blocks between surge and dive points, joined by line breaks."""
    if not page:
        return ""
    lines = read(page)
    marked = any(x and y for x, y in zip(lines.text, lines.inside, strict=True))
    lengths = []
    for text, linked in zip(lines.text, lines.linked, strict=True):
        navigation = not marked and linked >= LINK_SHARE * len(text) and text.count(" ") + 1 < LINK_WORDS
        lengths.append(0 if navigation else len(text))
    # window k sums lines k to k + width - 1; a run goes on while the windows over it do
    sums = [sum(lengths[max(0, k) : k + width]) for k in range(1 - width, len(lengths))]
    least = min(surge, max(sums, default=0) / 2)  # on a short page, half of its highest sum
    kept: list[str] = []
    run: list[int] = []
    peak = 0
    for k, total in enumerate(sums):
        line = k  # the window's last line
        if total:
            if line < len(lengths) and lengths[line]:
                run.append(line)
            peak = max(peak, total)
        if (not total or k == len(sums) - 1) and run:  # dive
            if marked:
                kept += [lines.text[i] for i in run if lines.inside[i]]
            elif peak > least:
                kept += [lines.text[i] for i in run]
            run, peak = [], 0
    return "\n".join(kept)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per page: page_id, url, text and its number of characters."""
    frame = pick(pages, page_id=id_col, url=url_col, html=html_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py()) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    kind = frame.schema["page_id"].dataType.simpleString()
    return frame.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")


def op2_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
