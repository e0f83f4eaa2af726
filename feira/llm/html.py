"""Main text of web pages: two passes of block rules.

A page is cut into blocks at block-level tags. Pass one decides each block by itself: structure that never holds the
article (menus, forms, scripts, asides, footers, what names itself an advert, notice or comment), link density, length
and the share of stop words, looked up in the list that fits the block best. Where no list fits the page (another
language, code, tables), long blocks with few links are good; where one does, long blocks without its words are bad.
Short blocks are ambiguous; in pass two they inherit the label of the nearest decided block of their section, preferring
the article where both sides are equally near.

Within an article element a class or id counts only if it is the name of such a structure as a whole (``comments``,
``related-posts``, not ``related-work``), and links decide only where several of them and nothing else make a row.

A name such as ``sidebar`` may stand on a wrapper around the article itself: if nothing else is the article, an article
or main element inside such a wrapper is.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feira.llm.common import col, ship, small_batches

# Frequent words of four languages.
STOP_WORDS = {
    "en": "the of and to a in is that it was for on are with as be by this at from or an not have which you they",
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus",
    "fr": "de la le et les des en un du une que est pour qui dans par plus sur pas avec il elle au ce se son",
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más pero sus le o",
}
_STOPS = {name: frozenset(words.split()) for name, words in STOP_WORDS.items()}

SKIPPED = frozenset(
    "script style noscript template iframe object embed svg math canvas audio video select button textarea form head "
    "map datalist dialog".split()
)
ASIDE = frozenset("nav footer aside menu".split())
RAW = frozenset("script style textarea title noscript iframe".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary table "
    "tbody td tfoot th thead title tr ul".split()
)
#: Blocks that end an open paragraph; a new one of these also ends its like.
_CLOSES_P = BLOCKS - {"br", "option", "legend", "summary", "caption", "td", "th", "tr", "tbody", "thead", "tfoot"}
_SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_ROLES = (
    "ads? adverts? advertisements? advertising advertorial sponsor(?:ed|s)? promo(?:tion|s)? banner "
    "cookies? consent gdpr notices? popup modal overlay newsletter subscribe subscription signup login "
    "nav(?:bar|igation)? menu breadcrumbs? pagination pager toc sidebar widget related recommend(?:ed|ations)? "
    "trending share sharing social comments? commentlist discussion replies reply respond disqus "
    "footer toolbar copyright disclaimer search outbrain taboola paywall"
).split()
_BAD_NAME = re.compile(rf"(?:^|[\s_-])(?:{'|'.join(_ROLES)})(?:$|[\s_-])", re.IGNORECASE)
#: Inside the article a name has to be a role as a whole, alone or with words that only say what kind of box it is.
_BOX_WORDS = (
    "area article articles bar block body bottom box buttons card container content count entry first form group header "
    "heading icons inline inner item items last left link links list main news outer page panel post posts reader right row section "
    "site slot stories story text thread title top unit user wrap wrapper your"
).split()
_ROLE_ONLY = re.compile(
    rf"(?:(?:{'|'.join(_BOX_WORDS)}|[0-9x]+)[_-]+)*(?:{'|'.join(_ROLES)})(?:[_-]+(?:{'|'.join(_ROLES + _BOX_WORDS)}|[0-9x]+))*",
    re.IGNORECASE,
)
#: Words that stand in no name of a part of an article.
_NEVER = re.compile(
    r"(?:^|[_-])(?:ads?|adverts?|advertisements?|advertorial|sponsored|newsletter|breadcrumbs?|pagination|pager|popup|signup|"
    r"subscribe|commentlist|disqus|outbrain|taboola|paywall|gdpr)(?:$|[_-])",
    re.IGNORECASE,
)
#: Roles that are as well headings of an article; as the id of one of its parts they say nothing.
_ALSO_HEADINGS = re.compile(
    r"consent|discussion|disclaimer|copyright|menu|navigation|notices?|promotion|recommendations|related|repl(?:y|ies)|"
    r"search|shar(?:e|ing)|social|subscription|toc|advertising|cookies?|login|widget|trending",
    re.IGNORECASE,
)
_BAD_OUTSIDE = re.compile(r"(?:^|[\s_-])(?:header|masthead|topbar|skip|legal|tags?|top)(?:$|[\s_-])", re.IGNORECASE)
#: Names of what a wrapper has or lacks, not of what it is: has-sidebar, post-with-comments, no-ads.
_MODIFIER = re.compile(r"(?:^|(?<=\s)|[_-]+)(?:has|have|with|without|no|non|hide)[_-]\S*", re.IGNORECASE)
_BAD_ROLE = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())

LONG, LEAST = 70, 25
STOP_HIGH, STOP_LOW = 0.12, 0.06
STOP_FITS = 0.2  # share in a page's whole text from which a list is that of its language
LINK_MOST = 0.35
LINK_ROW = 0.8  # share from which several links are a menu, be it in an article

#: A tag; quotes count behind an equals sign only, as in browsers. Possessive, so that no text is gone through twice.
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|=)*+)>")
_BARE_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>")
_TAG_START = re.compile(r"</?[a-zA-Z]")
_RAW_END = {tag: re.compile(rf"</{tag}\b[^>]*+>?", re.IGNORECASE) for tag in RAW}
_HUGE_REFERENCE = re.compile(r"&#[0-9]{10,};?")
_ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_SPACE = re.compile(r"\s+")
_WIDE = re.compile(r"[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uac00-\ud7af\uf900-\ufaff\U00020000-\U0003ffff]")
_LETTERS = re.compile(r"[^\W\d_]+")


def _decoded(text: str) -> str:
    """Character references decoded; numbers beyond all characters become the replacement character."""
    return html.unescape(_HUGE_REFERENCE.sub("\ufffd", text))


class Block(NamedTuple):
    text: str
    linked: int  # characters inside links
    section: int  # blocks of the same part of the page
    inside: bool  # in the article or main part
    barred: bool  # in structure that never holds the article
    heading: bool
    listing: bool = False  # preformatted, such as code
    held: bool = False  # in an article or main part that only names of wrappers around it bar
    links: int = 0  # links that begin in it
    article: bool = False  # in an article element


FIXED, NAMED = "fixed", "named"


def _bad_name(attribute: str, value: str, in_article: bool) -> bool:
    """Whether a class or an id says that its element is not the article."""
    value = _MODIFIER.sub(" ", value)
    if in_article:
        if attribute == "class":
            return any(_ROLE_ONLY.fullmatch(t) or _NEVER.search(t) for t in value.split())
        return any(_ROLE_ONLY.fullmatch(t) and not _ALSO_HEADINGS.fullmatch(t) for t in value.split())
    return bool(_BAD_NAME.search(value) or _BAD_OUTSIDE.search(value))


def _barred(tag: str, attributes: str, in_article: bool) -> str:
    """Whether an element never holds the article: by its kind (FIXED), by its class or id only (NAMED), or not ("")."""
    if tag in SKIPPED or tag in ASIDE or (tag == "header" and not in_article):
        return FIXED
    if not attributes.strip() or tag in ("html", "body", "article", "main"):
        return ""
    named = ""
    for m in _ATTRIBUTE.finditer(attributes):
        name = m[1].lower()
        value = m[2] or m[3] or m[4] or ""
        if name in ("class", "id") and _bad_name(name, value, in_article):
            named = NAMED
        if name == "role" and value.lower() in _BAD_ROLE:
            return FIXED
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return FIXED
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.IGNORECASE):
            return FIXED
    return named


def _names_itself_bad(attributes: str) -> bool:
    found = _ATTRIBUTE.finditer(attributes)
    return any(
        m[1].lower() in ("class", "id") and _BAD_NAME.search(_MODIFIER.sub(" ", m[2] or m[3] or m[4] or "")) for m in found
    )


class _Open(NamedTuple):
    """An open element, and what holds for the text in it."""

    tag: str
    barred: str
    inside: str  # the innermost of article and main around, article before main
    held: bool


def _opened(tag: str, attributes: str, parent: _Open) -> _Open:
    own = _barred(tag, attributes, bool(parent.inside))
    barred = FIXED if FIXED in (own, parent.barred) else own or parent.barred
    held = parent.held and not own
    inside = parent.inside
    if tag in ("article", "main"):
        if parent.barred == NAMED and inside != "article" and not (inside and tag == "main"):
            held = held or not _names_itself_bad(attributes)
        inside = "article" if "article" in (tag, inside) else "main"
    return _Open(tag, barred, inside, held)


_ROOT = _Open("", "", "", False)


class _Stack:
    """Open elements, and where those of each kind stand: every step takes constant time for each element it ends."""

    def __init__(self) -> None:
        self.elements: list[_Open] = []
        self.places: dict[str, list[int]] = {}

    @property
    def top(self) -> _Open:
        return self.elements[-1] if self.elements else _ROOT

    def last(self, tags: Iterable[str]) -> int:
        """Place of the innermost open element of these kinds, or -1."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=-1)

    def push(self, element: _Open) -> None:
        self.places.setdefault(element.tag, []).append(len(self.elements))
        self.elements.append(element)

    def end(self, place: int) -> None:
        """Ends the element at this place and all within it."""
        while len(self.elements) > place >= 0:
            self.places[self.elements.pop().tag].pop()


def _tags(page: str) -> Iterator[tuple[int, int, re.Match | None]]:
    """Begin, end and match of each tag (None: comments, declarations and a tag cut off by the end of the page).

    Elements whose content is no markup, such as scripts, end where their closing tag does.

    The page is gone through once: of quoted values that never end only the first is looked for.
    """
    at, size, last = 0, len(page), page.rfind(">")
    tag = _TAG
    while (at := page.find("<", at)) >= 0:
        if page.startswith(("<!", "<?"), at):
            mark = "-->" if page.startswith("<!--", at) else ">"
            found = page.find(mark, at + 2)
            end = size if found < 0 else found + len(mark)
            yield at, end, None
            at = end
        elif at > last:
            starts = [m.start() for m in _TAG_START.finditer(page, at)]
            if starts and page.rfind("<") == starts[-1]:
                yield starts[-1], size, None
            return
        elif _TAG_START.match(page, at):
            m = tag.match(page, at)
            if not m:
                tag = _BARE_TAG
                m = tag.match(page, at)
            end, name = m.end(), m[2].lower()
            if name in RAW and not m[1] and not m[3].endswith("/"):
                closed = _RAW_END[name].search(page, end)
                end = closed.end() if closed else size
            yield at, end, m
            at = end
        else:
            at += 1


def blocks(page: str) -> list[Block]:
    """The page's blocks in order, cut at block-level tags. Unclosed and crossing tags are repaired as browsers do."""
    out: list[Block] = []
    stack = _Stack()
    parts: list[str] = []
    state = {"linked": 0, "links": 0, "section": 0, "heading": False}

    def flush() -> None:
        text = _SPACE.sub(" ", _decoded("".join(parts))).strip()
        if text:
            top, listing = stack.top, stack.last(("pre",)) >= 0
            linked = min(state["linked"], len(text))
            out.append(
                Block(
                    text, linked, state["section"], bool(top.inside), bool(top.barred), state["heading"], listing, top.held,
                    state["links"], top.inside == "article",
                )
            )
        parts.clear()
        state["linked"] = state["links"] = 0

    def text(piece: str) -> None:
        if piece:
            parts.append(piece)
            if stack.last(("a",)) >= 0:
                state["linked"] += len(_SPACE.sub(" ", _decoded(piece)))

    at = 0
    for begin, stop, m in _tags(page):
        text(page[at:begin])
        at = stop
        if not m:
            continue
        tag, closing = m[2].lower(), bool(m[1])
        alone = tag in VOID or m[3].endswith("/")
        if tag in BLOCKS or tag in SKIPPED:
            flush()
        if closing:
            stack.end(stack.last((tag,)))
        else:
            if tag in _CLOSES_P:
                stack.end(stack.last(("p",)))
            if tag in _SAME:
                like = stack.last(_SAME[tag])
                if like > stack.last(("ul", "ol", "dl", "table", "select")):
                    stack.end(like)
            if not alone:
                stack.push(_opened(tag, m[3], stack.top))
                state["links"] += tag == "a"
            if tag in RAW and not alone:
                stack.end(stack.last((tag,)))
        if tag in BLOCKS and tag not in ("p", "br", "b"):
            state["section"] += tag in ("article", "main", "section", "div", "nav", "aside", "header", "footer", "ul", "ol", "table")
        if tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
            state["heading"] = not closing
    text(page[at:])
    flush()
    return out


def stop_share(text: str) -> float:
    """Share of the words that are stop words of the language that fits best."""
    words = [w.lower() for w in _LETTERS.findall(text)]
    if not words:
        return 0.0
    return max(sum(w in stops for w in words) for stops in _STOPS.values()) / len(words)


GOOD, BAD, SHORT = "good", "bad", "short"


def _length(text: str) -> int:
    """Characters, those of scripts that write a word in one or two of them counted three times."""
    return len(text) + 2 * (0 if text.isascii() else len(_WIDE.findall(text)))


def _of_links(b: Block) -> bool:
    """Whether links decide: outside an article element by their density, in one only as a row of several and no prose."""
    if b.linked <= LINK_MOST * len(b.text):
        return False
    return not b.article or (b.links > 1 and b.linked > LINK_ROW * len(b.text) and stop_share(b.text) < STOP_LOW)


def classify(found: list[Block]) -> list[str]:
    """First pass: good, bad, or short (ambiguous)."""
    article = any(b.inside and not b.barred for b in found)
    labels = []
    for b in found:
        if b.barred or (article and not b.inside) or _of_links(b):
            labels.append(BAD)
        elif len(b.text) < LEAST or b.heading:
            labels.append(SHORT)
        else:
            share = stop_share(b.text)
            if share >= (STOP_LOW if len(b.text) > LONG else STOP_HIGH):
                labels.append(GOOD)
            else:
                labels.append(SHORT)
    # Inside an article pass two makes all that is undecided good.
    if not article and SHORT in labels:
        fits = stop_share(" ".join(b.text for b, label in zip(found, labels, strict=True) if label != BAD)) >= STOP_FITS
        for i, b in enumerate(found):
            if labels[i] == SHORT and not b.heading and _length(b.text) > LONG:
                labels[i] = GOOD if not fits else SHORT if b.listing else BAD
        if GOOD not in labels:
            # Tables, verses and lists: many short blocks that are long together.
            sizes: dict[int, int] = {}
            for b, label in zip(found, labels, strict=True):
                if label == SHORT:
                    sizes[b.section] = sizes.get(b.section, 0) + _length(b.text)
            labels = [
                GOOD if label == SHORT and sizes[b.section] > LONG else label for b, label in zip(found, labels, strict=True)
            ]
    return labels


def inherit(found: list[Block], labels: list[str]) -> list[str]:
    """Second pass: a short block takes the label of the nearest decided block.

    Blocks of the same side of the article's border (inside or outside) count as neighbours; among equally near ones a
    good one wins. Without any decided neighbour, a block is good inside the article and bad outside.
    """
    out = list(labels)
    for side in (True, False):
        at = [i for i, b in enumerate(found) if b.inside == side and not b.barred and not _of_links(b)]
        decided = [k for k, i in enumerate(at) if labels[i] != SHORT]
        before = None
        ahead = iter(decided)
        following = next(ahead, None)
        for k, i in enumerate(at):
            if labels[i] != SHORT:
                before = k
                while following is not None and following <= k:
                    following = next(ahead, None)
                continue
            near = [(abs(k - d), labels[at[d]] != GOOD, labels[at[d]]) for d in (before, following) if d is not None]
            out[i] = min(near)[2] if near else GOOD if side else BAD
    return [BAD if x == SHORT else x for x in out]


def _kept(found: list[Block]) -> str:
    labels = inherit(found, classify(found))
    return " ".join(b.text for b, label in zip(found, labels, strict=True) if label == GOOD)


def main_text(page: str | None) -> str:
    """The article's blocks in page order, joined by one blank; empty for a null or empty page."""
    if not page:
        return ""
    found = blocks(page)
    text = _kept(found)
    if any(b.held for b in found) and not any(b.inside and not b.barred and not b.heading for b in found):
        # The longer of the two, as comments beside a text without an article element may be articles of their own.
        text = max(text, _kept([b._replace(barred=b.barred and not b.held) for b in found]), key=len)
    return text


def extract(df: DataFrame, html_col: str = "html", text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """``df`` without the html, with the main text and its number of code points. Columns of those names are replaced.

    One row per row, repeated ones included. Null and empty pages give an empty text. Pages of any size and shape take time
    in proportion to their length.
    """
    ship(df.sparkSession)
    passed = [c for c in df.columns if c.lower() not in (html_col.lower(), text, n_chars)]
    names = [f"c{i}" for i in range(len(passed))]
    work = df.select(*[col(c).alias(n) for c, n in zip(passed, names, strict=True)], col(html_col).cast("string").alias("html"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in small_batches([batch], "html"):
                found = [main_text(h.as_py()) for h in part.column("html")]
                new = [pa.array(found, pa.string()), pa.array(map(len, found), pa.int64())]
                yield pa.RecordBatch.from_arrays([*[part.column(n) for n in names], *new], [*names, "text", "n_chars"])

    schema = work.drop("html").schema.add("text", "string").add("n_chars", "long")
    out = work.mapInArrow(run, schema)
    return out.select(*[F.col(n).alias(c) for c, n in zip(passed, names, strict=True)], F.col("text").alias(text), F.col("n_chars").alias(n_chars))
