"""Main text of web pages by two-pass block rules."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratavox.llm.common import batch_of, configure, table

OUT = "page_id long, url string, text string, n_chars long"

# Elements of HTML, as its standard groups them, and words that often name page furniture in class, id and role.
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " head header hr html legend li main menu nav ol p pre section summary table tbody tfoot thead title tr ul".split()
)
CELL = frozenset("td th br".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template svg iframe textarea object canvas video audio".split())
#: Elements that hold other blocks; a name on one of them says more than one on a heading or a paragraph.
HOLDS = frozenset("div section ul ol dl table header figure details main span".split())
OUTSIDE = frozenset("head title nav aside footer form menu dialog button select label fieldset".split())
FURNITURE = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices"
    " popup modal overlay newsletter subscribe subscription paywall sidebar aside rail menu nav navbar navigation topnav breadcrumb breadcrumbs"
    " footer masthead topbar toolbar comment comments commentlist disqus respond reply replies discussion share sharing social related recommended"
    " recommendations widget widgets login signin signup search searchbox pagination pager copyright legal disclaimer skip hidden alert".split()
)
#: Of these, the words that name furniture when a longer name begins with them, as in ad-slot or comment-list.
LEADING = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr popup modal overlay"
    " newsletter subscribe subscription paywall sidebar menu nav navbar navigation breadcrumb breadcrumbs footer topbar toolbar comment comments"
    " disqus share sharing social related recommended recommendations widget widgets login signin signup pagination pager".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form".split())
# Frequent function words of English, French, German and Spanish.
STOP = frozenset(
    "the of and to a in that is was for it with as on be at by this are from or an not but have had which one you were all they there"
    " le la les de des du un une et est en que qui dans pour sur au aux par pas ce se il elle ne plus avec sont"
    " der die das und ist von zu den mit sich des auf für nicht ein eine dem im als auch es an werden aus er hat"
    " el los las del y que en por con para una su al lo como más o pero sus este ya entre".split()
)

COMMENT = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)", re.S)
TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)")
NAMED = re.compile(r"\b(class|id|role|style|hidden|aria-hidden)(?=[\s=/]|$)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
WORDS = re.compile(r"[^\W\d_]+")
CAMEL = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

#: A block of at least LONG characters is decided by its own words; one of LINKS of its characters in links is not text.
#: Stop words are to be at least STOPS of the words of a long block, HINTED where names hint at furniture.
LONG, LINKS, STOPS, HINTED = 80, 0.4, 0.06, 0.12


def _names(value: str) -> list[list[str]]:
    """The names of a class or id attribute, each as its words in small letters."""
    return [words for name in value.split() if (words := [x.lower() for x in CAMEL.findall(name)])]


def _outside(tag: str, attributes: str, inside: bool) -> int:
    """2 if an element is page furniture by what it is, 1 if its names only hint at that, else 0.

    inside: it lies in an article or main element. A container whose whole name is a furniture word, or begins with a
    telling one, is furniture; other names that hold such a word are hints, which the words of a block can overrule, and
    so are names of headings, paragraphs and items outside an article. Inside one the latter say nothing.
    """
    if tag in OUTSIDE or tag == "header" and not inside:
        return 2
    if not attributes or tag in ("html", "body", "main", "article"):
        return 0
    hint = 0
    for name, *values in NAMED.findall(attributes):
        name, value = name.lower(), "".join(values)
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return 2
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return 2
        if name == "role" and value.lower() in ROLES:
            return 2
        if name in ("class", "id"):
            for words in _names(value):
                whole = len(words) == 1 and words[0] in FURNITURE or words[0] in LEADING or "header" in words and not inside
                if whole and tag in HOLDS:
                    return 2
                hint |= (tag in HOLDS or not inside) and (whole or not FURNITURE.isdisjoint(words))
    return int(hint)


class _Page:
    """The blocks of a page: text, characters in links, the container that they lie in (0 furniture, 1 page, 2 article), hinted or not."""

    def __init__(self, source: str):
        self.blocks: list[tuple[str, int, int, bool]] = []
        self.stack: list[tuple[str, int, bool]] = []
        self.parts: list[str] = []
        self.linked: list[str] = []
        self.links, self.broke = 0, False
        self.kind, self.hint = 1, False
        self.read(source)
        self.close()

    def close(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            self.blocks.append((text, len(" ".join("".join(self.linked).split())), self.kind, self.hint))
        self.parts, self.linked = [], []

    def text(self, raw: str) -> None:
        if raw:
            raw = html.unescape(raw)
            self.broke = self.broke and not raw.strip()
            self.parts.append(raw)
            if self.links:
                self.linked.append(raw)

    def to(self, depth: int) -> None:
        for tag, *_ in self.stack[depth:]:
            self.links -= tag == "a"
        del self.stack[depth:]
        self.kind, self.hint = self.stack[-1][1:] if self.stack else (1, False)

    def find(self, tags: tuple[str, ...], until: tuple[str, ...]) -> int:
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] in tags:
                return i
            if self.stack[i][0] in until:
                break
        return -1

    def start(self, tag: str, attributes: str) -> None:
        if tag == "br":
            if self.broke:
                self.close()
            self.parts.append(" ")
            self.broke = True
            return
        if tag in CELL:
            self.parts.append(" ")
        if tag in BLOCK:
            self.close()
            implied = {"li": (("li",), ("ul", "ol", "menu")), "tr": (("tr",), ("table",)), "dd": (("dd", "dt"), ("dl",)), "dt": (("dd", "dt"), ("dl",))}
            for tags, until in ((("p",), ("div", "article", "section", "td", "th", "li", "blockquote", "aside", "body")), implied.get(tag, ((), ()))):
                if tags and (i := self.find(tags, until)) >= 0:
                    self.to(i)
            if tag == "body" and (i := self.find(("head",), ())) >= 0:
                self.to(i)
        if tag in VOID or attributes.endswith("/") and tag not in BLOCK:
            return
        kind, hint = self.kind, self.hint
        if kind:
            sign = _outside(tag, attributes, kind == 2)
            hint = hint or sign == 1
            if sign == 2:
                kind = 0
            elif tag in ("article", "main"):
                kind = 2
        self.stack.append((tag, kind, hint))
        self.links += tag == "a"
        self.kind, self.hint = kind, hint

    def end(self, tag: str) -> None:
        if tag in BLOCK:
            self.close()
        elif tag in CELL:
            self.parts.append(" ")
        if (i := self.find((tag,), ())) >= 0:
            self.to(i)

    def read(self, source: str) -> None:
        at, n = 0, len(source)
        while at < n:
            low = source.find("<", at)
            if low < 0:
                self.text(source[at:])
                return
            self.text(source[at:low])
            if found := COMMENT.match(source, low):
                at = found.end()
                continue
            found = TAG.match(source, low)
            if not found:
                self.text("<")
                at = low + 1
                continue
            at, ending, tag = found.end(), found[1] or found[4], (found[2] or found[5]).lower()
            if found[5] and not found[0].endswith(">"):
                return  # the page is cut within a tag
            if ending:
                self.end(tag)
            elif tag in RAW:
                close = re.compile(rf"</{re.escape(tag)}\b[^>]*+(?:>|\Z)", re.I).search(source, at)
                at = close.end() if close else n
            else:
                self.start(tag, found[3] or found[6] or "")


def stop_share(text: str) -> float:
    words = WORDS.findall(text.lower())
    return sum(w in STOP for w in words) / len(words) if words else 0.0


def _first_pass(text: str, linked: int, kind: int, hint: bool) -> int:
    """1 good, -1 bad, 0 not decided by the block itself."""
    long, share = len(text) >= LONG, stop_share(text)
    if linked >= LINKS * len(text):  # in an article prose may be full of links; its neighbours decide
        return 0 if kind == 2 and not hint and share >= STOPS and linked < len(text) else -1
    if hint:
        return 1 if long and share >= HINTED else -1
    if not long:
        return -1 if kind == 1 and (linked or "©" in text) else 0
    if kind == 1 and len(text) >= 3 * LONG:
        return 1
    return 1 if share >= STOPS else 0


def _second_pass(labels: list[int], kinds: list[int]) -> list[int]:
    """Undecided blocks take the label of the nearest decided ones."""
    n, out = len(labels), list(labels)
    before, after = [(0, n)] * n, [(0, n)] * n
    for near, order in ((before, range(n)), (after, range(n - 1, -1, -1))):
        label, away = 0, n
        for i in order:
            near[i] = label, away
            label, away = (labels[i], 1) if labels[i] else (label, away + 1)
    for i in range(n):
        if labels[i]:
            continue
        (left, far_left), (right, far_right) = before[i], after[i]
        if kinds[i] == 2:  # in an article only blocks of links tell against a short one
            out[i] = -1 if left == right == -1 else 1
        elif left == right:
            out[i] = left or -1
        elif left and right and far_left == far_right:
            out[i] = 1
        elif not (left and right):
            out[i] = left or right
        else:
            out[i] = left if far_left < far_right else right
    return out


def main_text(source: str) -> str:
    """The article of a page: its good blocks, joined by two line feeds; empty if it has none."""
    blocks = _Page(source).blocks
    read = 2 if any(kind == 2 for *_, kind, _ in blocks) else 1
    blocks = [x for x in blocks if x[2] == read]  # furniture lies in other containers and is no neighbour
    labels = _second_pass([_first_pass(*x) for x in blocks], [x[2] for x in blocks])
    return "\n\n".join(text for (text, *_), label in zip(blocks, labels, strict=True) if label > 0)


def extract_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(x or "") for x in batch.column(2).to_pylist()]
        yield batch_of(OUT, batch.column(0), batch.column(1), texts, [len(x) for x in texts])


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every row of pages.

    First each block is labelled by itself: by its share of link characters, its length and its share of stop words,
    and by where it lies; short blocks, and long ones with few stop words, stay open. Names of elements that merely hold a
    furniture word are one sign among these, which prose overrules. Then open blocks take the label of the nearest decided ones. Where
    a page has an article or main element, only that is read. A null or empty html has empty text. Repeated rows are
    kept, other columns ignored.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(extract_rows, OUT)


def op10_extraction(spark, sf_dir: str) -> DataFrame:
    configure(spark)
    return extract_pages(table(spark, sf_dir, "pages"))
