"""Main text of web pages: streaming parser events, text-to-tag ratios, Gaussian smoothing, threshold clustering.

The parser's events are folded into lines, one per block of text. A line's ratio is its length over the tags met in it;
lines in menus, headers, forms and the like, told by element, role, class or id, have ratio 0. Where the page marks an
article, ratios outside it weigh less (EVIDENCE). The ratios are smoothed over neighbouring lines and cut in two
clusters, one held at 0.

The high lines choose the content. Candidates are the outermost ``article`` elements, the rest of ``main``, and the rest of
the page; the weighted lengths of their high lines are cut in two clusters in the same way, and the candidates of the
upper one are content, the rest of the page only if it is the longest, so teasers beside an article, or articles beside a long text, stay out. Of an article all unmarked
lines belong to the text, short ones too, and so do, if it has no heading, the heading and lead just before it. Of the rest of a page it
is the innermost element that holds all high lines and the heading they stand under. Beside articles, and in such an element,
blocks without high lines that are mostly links or a trail of them are left out. An ``article`` within an article that has
text of its own before it holds a reader's comment.

A class or id only tells what an element is as long as the element is not, or does not hold, the article itself: its words
do not count where most of the text of high lines lies in it and little text, or no title, lies elsewhere. In the content, names
with a word of another kind (``side-effects``) and words with a second meaning (``discussion``) count only when the element's
lines are low, and mostly links or short.

Defined results: a null or empty page gives an empty text; unclosed and stray tags are read as browsers mostly do;
repeated rows each get their result; pages are read whole, whatever their length; further columns are left out.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterloom.llm.common import table

SIGMA = 1.0
EVIDENCE = {"article": 1.0, "main": 0.5, "": 0.1}  # weight of ratios by the element around them, on pages that mark an article
SHORT = 40  # characters of a line that may be a label

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr img".split())
ARTICLE = {"article", "main"}
LANDMARKS = {"html", "body", "article", "main", "nav", "header", "footer", "aside", "form", "table"}
SKIPPED = set("head title script style noscript template nav footer aside form button select textarea iframe object svg canvas dialog menu audio video figure map".split()) - {"figure"}
ROLES = set("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())
WORDS = set(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices alert popup modal overlay "
    "nav navbar navigation menu breadcrumb breadcrumbs sidebar side aside widget footer header masthead topbar toolbar comment comments reply replies disqus discussion "
    "share sharing social related recommended newsletter subscribe subscription signup login search pagination pager".split()
)
TALK = set("comment comments reply replies disqus discussion cookie cookies consent gdpr".split())  # may be longer than an article
BESIDE = set("with without has have no not non hide show".split())  # the word after them tells what is beside the element
TITLED = set("article post entry story content section page title".split())  # their header is the text's, not the site's
DOUBTFUL = set("discussion search social side menu navigation share sharing subscription promotion login".split())  # with a second meaning
PLACES = set(
    "area bar block bottom box button buttons card cards col column container content desktop field form global group icon icons inner item items label large left line link links list "
    "main mobile outer page panel post posts primary region right row secondary section site slot small sticky stories story text title top unit us wrap wrapper zone article entry".split()
)
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
_PARTS = re.compile(r"[a-z]+|[0-9]+")
_TRAIL = re.compile(r"\S\s*[/>»›|·→]\s*\S")
_SENTENCE = re.compile(r"[.!?…。！？][\"'”’»)\]]*$")


def _marked(tag: str, attrs) -> bool:
    """Whether an element is by itself something other than the article, whatever it holds."""
    if tag in SKIPPED:
        return True
    for name, value in attrs:
        value = (value or "").lower()
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and "display:none" in value.replace(" ", ""):
            return True
        if name == "role" and value in ROLES and tag not in {"html", "body", "main"} | HEADINGS:
            return True
    return False


def _words(tag: str, attrs, in_article: bool) -> set[str]:
    """Words of an element's class and id that speak of something other than the article."""
    found: set[str] = set()
    if tag in {"html", "body", "main"} | HEADINGS:
        return found
    for name, value in attrs:
        if name in ("class", "id"):
            for token in (value or "").lower().split():
                parts = _PARTS.findall(token)
                own = {w for before, w in zip(["", *parts], parts) if w in WORDS and before not in BESIDE}
                found |= own - {"header"} if in_article or TITLED.intersection(parts) else own
    return found


def _sure(attrs, words: set[str]) -> bool:
    """Whether a name is made of such words and of words for places only, one of them without a second meaning."""
    for name, value in attrs:
        if name in ("class", "id"):
            for token in (value or "").lower().split():
                parts = set(_PARTS.findall(token))
                if parts & words - DOUBTFUL and all(w in WORDS or w in PLACES or w.isdigit() for w in parts):
                    return True
    return False


class Lines(HTMLParser):
    """Folds events into lines: (text, tags, enclosing elements), and the characters of links in each."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, tuple[int, ...]]] = []
        self.stack: list[tuple[str, int]] = []  # open block elements: tag, number
        self.tags_of: dict[int, str] = {}
        self.marked: set[int] = set()
        self.words: dict[int, set[str]] = {}  # of elements whose class or id speaks of something else
        self.unsure: set[int] = set()  # those of them whose words count only with the support of their lines
        self.links: list[int] = []
        self.in_link, self.linked = False, 0
        self.count = self.tags = 0
        self.buffer: list[str] = []

    def _flush(self) -> None:
        text = " ".join("".join(self.buffer).split())
        self.buffer.clear()
        if text:
            self.lines.append((text, self.tags, tuple(n for _, n in self.stack)))
            self.links.append(min(self.linked, len(text)))
            self.tags = self.linked = 0

    def _open(self, tag: str, attrs) -> None:
        self.count += 1
        self.tags_of[self.count] = tag
        in_article = any(t in ARTICLE for t, _ in self.stack)
        if _marked(tag, attrs) or tag == "header" and not in_article:
            self.marked.add(self.count)
        elif words := _words(tag, attrs, in_article):
            self.words[self.count] = words
            if not _sure(attrs, words):
                self.unsure.add(self.count)
        self.stack.append((tag, self.count))

    def _close(self, tag: str) -> None:
        for k in range(len(self.stack) - 1, -1, -1):
            if self.stack[k][0] == tag:
                del self.stack[k:]
                return
            if self.stack[k][0] in LANDMARKS and tag not in LANDMARKS:
                return

    def handle_starttag(self, tag, attrs):
        self.tags += 1
        self.in_link = self.in_link or tag == "a"
        if tag in INLINE and not (attrs and (_marked(tag, attrs) or _words(tag, attrs, False))):
            return
        if tag in VOID:
            if tag in ("br", "hr"):
                self.buffer.append(" ") if tag == "br" else self._flush()
            return
        self._flush()
        if tag == "p" or tag in ("li", "dt", "dd", "tr", "td", "th", "option"):  # the open one of the kind ends here
            for k in range(len(self.stack) - 1, -1, -1):
                if self.stack[k][0] == tag:
                    del self.stack[k:]
                    break
                if self.stack[k][0] in LANDMARKS or self.stack[k][0] in ("div", "section", "ul", "ol", "dl"):
                    break
        elif tag not in INLINE and self.stack and self.stack[-1][0] == "p":
            self.stack.pop()
        self._open(tag, attrs)

    def handle_startendtag(self, tag, attrs):
        self.tags += 1
        if tag == "br":
            self.buffer.append(" ")
        elif tag not in INLINE and tag not in VOID:  # the slash means nothing on them
            self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        self.tags += 1
        self.in_link = self.in_link and tag != "a"
        if tag in VOID:
            return
        if tag in INLINE and not any(t == tag for t, _ in self.stack):
            return
        self._flush()
        self._close(tag)

    def handle_data(self, data):
        self.buffer.append(data)
        if self.in_link:
            self.linked += len(" ".join(data.split()))


def smooth(values: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    reach = max(1, int(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    padded = np.pad(values, reach, mode="reflect" if len(values) > reach else "edge")
    return np.convolve(padded, kernel / kernel.sum(), mode="valid")


def threshold(values: np.ndarray) -> float:
    """Border between two clusters, one of which stays at 0."""
    centre = values.max(initial=0.0)
    for _ in range(50):
        high = values[values >= centre / 2]
        new = high.mean() if len(high) else 0.0
        if abs(new - centre) < 1e-9:
            break
        centre = new
    return centre / 2


def high_lines(lines, usable: np.ndarray, weight: np.ndarray | float = 1.0) -> np.ndarray:
    """Which of the usable lines belong to the cluster of high ratios."""
    even = smooth(np.array([len(text) / max(1, tags) if u else 0.0 for (text, tags, _), u in zip(lines, usable)]) * weight)
    high = (even >= threshold(even)) & usable
    return high if high.any() else usable


def _comments_in_articles(parser: Lines, marked: np.ndarray) -> np.ndarray:
    """Lines of an article within an article that has high lines of its own before it."""
    kinds, out, told = parser.tags_of, np.zeros(len(marked), bool), set()
    if marked.all() or list(kinds.values()).count("article") < 2:
        return out
    for i, ((_, _, of), high) in enumerate(zip(parser.lines, high_lines(parser.lines, ~marked))):
        articles = [n for n in of if kinds[n] == "article"]
        out[i] = not told.isdisjoint(articles[:-1])
        if high and articles:
            told.add(articles[-1])
    return out


def something_else(parser: Lines, unsure: bool = True) -> np.ndarray:
    """Which lines are marked. Words of a class or id do not count on an element that is or holds the article; unsure ones
    count in an article with the support of their lines, elsewhere as asked."""
    lines, kinds, words = parser.lines, parser.tags_of, dict(parser.words)
    marked = np.array([not parser.marked.isdisjoint(of) for _, _, of in lines], bool)
    marked |= _comments_in_articles(parser, marked)
    if not words or marked.all():
        return marked
    size = np.array([len(text) for text, *_ in lines])
    high = high_lines(lines, ~marked)
    mass = size * high
    title = np.array([any(kinds[n] in ARTICLE or kinds[n] == "h1" for n in of) for _, _, of in lines]) & ~marked
    place: dict[int, list[int]] = {}
    for i, (_, _, of) in enumerate(lines):
        for n in of:
            if n in words:
                place.setdefault(n, []).append(i)
    links = np.array(parser.links)
    for n in parser.unsure & place.keys():
        own = np.array(place[n])
        of = lines[own[0]][2]
        if not unsure or any(kinds[m] in ARTICLE for m in of[: of.index(n)]):
            labels = all(size[i] <= SHORT and not _SENTENCE.search(lines[i][0]) for i in own)
            if not labels and 2 * links[own].sum() < size[own].sum():
                del words[n]
    clean = np.array([words.keys().isdisjoint(of) for _, _, of in lines]) & ~marked
    for n in sorted(place.keys() & words.keys()):  # outer elements first
        own = place[n]
        if 2 * mass[own].sum() <= mass.sum():
            continue
        holds, little = title[own].any(), 10 * size[clean].sum() <= size[~marked].sum()
        if holds and not (title & clean).any() or little and (holds or not words[n] & TALK):
            del words[n]
            clean = np.array([words.keys().isdisjoint(of) for _, _, of in lines]) & ~marked
    return ~clean


def _firm(parser: Lines, high: np.ndarray) -> np.ndarray:
    """High lines that are not so by their neighbours alone (their own ratio is far below the border), nor mostly links."""
    ratio = np.array([len(text) / max(1, tags) for text, tags, _ in parser.lines])
    firm = high & (ratio >= threshold(ratio * high) / 4) & (2 * np.array(parser.links) < [len(text) for text, *_ in parser.lines])
    return firm if firm.any() else high


def _box(parser: Lines, which: np.ndarray) -> int | None:
    """The innermost element, but for those of one line, that holds all these lines."""
    kinds = parser.tags_of
    boxes = [{n for n in of if kinds[n] not in INLINE and kinds[n] not in HEADINGS and kinds[n] not in ("p", "li", "blockquote", "pre", "td")} for (_, _, of), w in zip(parser.lines, which) if w]
    return max(set.intersection(*boxes), default=None)  # numbers grow inwards


def _asides(parser: Lines, usable: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Lines of blocks without high lines that are mostly links, and trails of links ahead of the high lines."""
    lines, links = parser.lines, np.array(parser.links)
    holding = {n for (_, _, of), h in zip(lines, high) if h for n in of}
    blocks: dict[int, list[int]] = {}
    for i, (_, _, of) in enumerate(lines):
        outer = next((n for n in of if n not in holding), None)
        if usable[i] and not high[i] and outer is not None:
            blocks.setdefault(outer, []).append(i)
    out, first = np.zeros(len(lines), bool), int(np.argmax(high))
    for own in blocks.values():
        size = sum(len(lines[i][0]) for i in own)
        trail = own[-1] < first and len(own) == 1 and size <= 2 * SHORT and not parser.tags_of[lines[own[0]][2][-1]] in HEADINGS and _TRAIL.search(lines[own[0]][0])
        if 2 * links[own].sum() > size or trail:
            out[own] = True
    return out


def _with_heading(parser: Lines, chosen: np.ndarray, usable: np.ndarray, first: int) -> None:
    """Add the heading above line ``first`` and the lead between, as long as nothing marked comes between."""
    for k in range(first, -1, -1):
        if not usable[k] or k < first and chosen[k]:
            return
        if any(parser.tags_of[n] in HEADINGS for n in parser.lines[k][2]):
            chosen[k : first + 1] = True
            return


def _region(parser: Lines, usable: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Usable lines in the innermost element that holds all high lines and their heading, but for link blocks."""
    high = _firm(parser, high)
    named = high.copy()
    _with_heading(parser, named, usable, int(np.argmax(high)))
    region = _box(parser, named)
    inside = np.array([region is None or region in of for _, _, of in parser.lines], bool)
    return inside & usable & (named | ~_asides(parser, usable, high))


def _content(parser: Lines, usable: np.ndarray) -> np.ndarray:
    """Which lines are content, as the high lines choose."""
    lines, kinds = parser.lines, parser.tags_of
    group = []
    for _, _, of in lines:
        outer = next((n for n in of if kinds[n] == "article"), None)
        group.append(outer if outer is not None else "main" if any(kinds[n] == "main" for n in of) else "")
    kind = ["article" if isinstance(g, int) else g for g in group]
    if not any(k and u for k, u in zip(kind, usable)):
        return _region(parser, usable, high_lines(lines, usable))
    high = high_lines(lines, usable, np.array([EVIDENCE[k] for k in kind]))
    mass: dict[object, float] = {}
    for g, (text, _, _), h in zip(group, lines, high):
        mass[g] = mass.get(g, 0.0) + len(text) * h
    names = list(mass)
    sure = np.array([mass[g] * EVIDENCE["article" if isinstance(g, int) else g] for g in names])
    best = names[int(np.argmax(sure))]
    if not isinstance(best, int):  # the articles are not the text, so the element is no evidence here
        high = high_lines(lines, usable)
        mass = {g: sum(len(line[0]) for line, x, h in zip(lines, group, high) if x == g and h) for g in names}
        sure = np.array([float(mass[g]) for g in names])
    least = threshold(sure)
    named = {g for g, m in zip(names, sure) if m and m >= least and (g != "" or best == "")}
    within = lambda g: np.array([x == g for x in group], bool) & usable
    chosen = np.zeros(len(lines), bool)
    for g in names:
        if g in named and isinstance(g, int):
            own = within(g)
            chosen |= own
            if not any(kinds[n] in HEADINGS for i in np.flatnonzero(own) for n in lines[i][2]):
                _with_heading(parser, chosen, usable, int(np.argmax(own)))
    if "main" in named:
        chosen |= within("main") & ~_asides(parser, usable, _firm(parser, high & within("main")))
    if "" in named:
        chosen |= _region(parser, within(""), high & within(""))
    return chosen


def main_text(html: str | None) -> str:
    if not html:
        return ""
    parser = Lines()
    parser.feed(html)
    parser.close()
    parser._flush()
    if not parser.lines:
        return ""
    usable = ~something_else(parser)
    freed = ~something_else(parser, unsure=False) if parser.unsure else usable
    if not usable.any():
        usable = freed
    if not usable.any():
        return ""
    chosen = _content(parser, usable)
    if (freed & ~usable).any():  # blocks with unsure names in the element that holds the content and its title
        titles = usable & [any(parser.tags_of[n] == "h1" for n in of) for _, _, of in parser.lines]
        box = _box(parser, chosen | titles)
        more = freed & [box in of for _, _, of in parser.lines]
        if (more & ~usable).any():
            chosen = _content(parser, usable | more)
    return " ".join(text for (text, _, _), c in zip(parser.lines, chosen) if c)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text) for every row."""
    rows = pages.select(F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").alias("url"), F.col(f"`{html_col}`").cast("string").alias("html"))
    text = F.pandas_udf(_texts, "string")
    return rows.select("page_id", "url", text("html").alias("text"))


def _texts(html: pd.Series) -> pd.Series:
    return pd.Series([main_text(x) for x in html], dtype=object)


def op8_html(spark, sf_dir: str) -> DataFrame:
    out = extract(table(spark, sf_dir, "pages"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
