"""Main text of web pages by line-block distribution."""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from statistics import median

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

# Elements of the markup language.
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p "
    "pre section summary table tbody td tfoot th thead tr ul".split())
RAW = frozenset("script style noscript template textarea title iframe noframes xmp annotation "
                "annotation-xml".split())
FURNITURE = frozenset(
    "head nav footer aside form button select dialog menu svg canvas object audio "
    "video map datalist".split())
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split())
FURNITURE_ROLES = frozenset(
    "navigation banner contentinfo complementary search form alert alertdialog dialog menu "
    "menubar note toolbar".split())
# Words of class and id names that mark what is not the article.
FURNITURE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising banner banners sponsor "
    "sponsored promo promotion sidebar sidebars widget widgets menu nav navbar navigation "
    "breadcrumb breadcrumbs cookie cookies consent gdpr notice notices notification alert "
    "newsletter subscribe subscription signup login search related recommended share sharing "
    "social popup modal overlay pagination pager footer masthead topbar toolbar skip".split())
#: Of these, words that authors name their own paragraphs by too.
SAID = frozenset(
    "notice notices notification alert subscribe subscription signup login search menu navigation "
    "related recommended share sharing social promotion banner skip".split())
#: Names of reader comments, whatever their size, and names that mean them where no heading in the
#: element says otherwise.
COMMENT_WORDS = frozenset(
    "comment comments commentlist reply replies respond responses disqus".split())
TALK_WORDS = frozenset("discussion discussions feedback talkback".split())
#: Words that such names are put together with; any other ("no-sidebar") says something else.
NAME_PARTS = frozenset(
    "area bar block body bottom box button buttons card center column container content desktop "
    "first form frame global group header heading holder icon icons inner item items label last "
    "left line link links list main middle mobile module outer page panel policy post posts "
    "primary reader readers region right row secondary section site slot space text thread title "
    "top unit user users visitor articles stories wrap wrapper zone".split())
ARTICLE = frozenset(("article", "main"))
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that hold text rather than other blocks.
TEXT = HEADINGS | frozenset("p li dt dd td th blockquote pre figcaption".split())
COMMENTS_HEADING = re.compile(
    r"(?:\d+\s+|(?:reader|user|visitor)s?'?\s+|all\s+|leave\s+a\s+|post\s+a\s+|add\s+a\s+)?"
    r"(?:comments?|replies|reply)(?:\s*\(?\d+\)?)?\s*:?", re.I)
#: Words that mark furniture only outside an article, whose own heading may carry them.
OUTSIDE_WORDS = frozenset(("header",))

# Elements that may leave out their end tag, and what an end tag does not reach beyond.
TABLE_PARTS = frozenset("caption colgroup tbody td tfoot th thead tr".split())
OPEN_ENDED = TABLE_PARTS | frozenset("p li dd dt option optgroup".split())
ENDS_P = BLOCKS - TABLE_PARTS - {"body", "html", "legend"}
SCOPE = frozenset("applet caption html marquee object table td template th".split())
SPECIAL = BLOCKS | FURNITURE | TABLE_PARTS
#: Which open elements a start tag ends, and what lies beyond its reach.
IMPLIED = {
    **{n: (frozenset(("li",)), SPECIAL - {"address", "div", "p", "li"}) for n in ("li",)},
    **{n: (frozenset(("dd", "dt")), SPECIAL - {"address", "div", "p", "dd", "dt"})
       for n in ("dd", "dt")},
    **{n: (frozenset(("option",)), frozenset(("select", "datalist", "optgroup")))
       for n in ("option", "optgroup")},
    **{n: (frozenset(("td", "th")), frozenset(("table", "template"))) for n in ("td", "th")},
    "tr": (frozenset(("tr", "td", "th", "caption", "colgroup")), frozenset(("table", "template"))),
    **{n: (TABLE_PARTS, frozenset(("table", "template"))) for n in ("tbody", "thead", "tfoot")},
}
#: Elements beyond this depth are kept track of only if they are blocks.
DEPTH = 512
#: Characters outside links in a window that are running text on any page.
DENSE = 40

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|</?[a-zA-Z][^>]*(?:>|\Z)", re.S)
MARK = re.compile(r"""(class|id|role|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""",
                  re.I)
SPACE = re.compile(r"\s+")


def _named_furniture(name: str, words: frozenset) -> bool:
    """Whether a class or id is one of the words, or put together of them and ``NAME_PARTS``."""
    if name in words:
        return True
    parts = [x for x in re.split(r"[^a-z0-9]+", name) if x and not x[0].isdigit()]
    return any(x in words for x in parts) and all(x in words or x in NAME_PARTS for x in parts)


def _is_furniture(name: str, rest: str, inside: bool, e=None, total: int = 0) -> bool:
    """``inside``: within an article; ``e``: the element, where it has content, ``total``: the text
    of the page outside links.

    A name does not count on an element with most of that text, or, within an article, on a heading
    or on running text, which its author may call so. Names of comments always count, but on an
    element that the article itself lies in.
    """
    if name in FURNITURE or (name == "header" and not inside):
        return True
    if not rest or name in ("html", "body"):
        return False
    most = e is not None and 2 * e.held() > total
    own = inside and name in TEXT
    for key, value in MARK.findall(rest):
        key, value = key.lower(), value.strip("\"'").lower()
        if key == "role":
            if value in FURNITURE_ROLES:
                return True
        elif key == "hidden" or key == "aria-hidden":
            if key == "hidden" or value == "true":
                return True
        elif not own or (key == "class" and name not in HEADINGS):
            words = FURNITURE_WORDS if inside else FURNITURE_WORDS | OUTSIDE_WORDS
            for x in value.split():
                if _named_furniture(x, COMMENT_WORDS):
                    if e is None or not e.wraps:
                        return True
                elif _named_furniture(x, TALK_WORDS):
                    if e is not None and name not in TEXT and not e.headed:
                        return True
                elif not most and _named_furniture(x, words):
                    if not (own and e is not None and e.held() >= DENSE
                            and _named_furniture(x, SAID)):
                        return True
    return False


class _Element:
    """``start``, ``end`` and ``cut``: the characters outside links before it, before its end, and
    before the first article in it; ``closed``: whether it ends where the page says; ``wraps``: a
    top heading or an article, which is no comment, lies in it; ``headed``: a heading does;
    ``last``: a heading that none of its rank or above follows in its parent."""

    __slots__ = ("name", "rest", "start", "end", "cut", "closed", "parent", "wraps", "headed", "last")

    def __init__(self, name, rest, start, parent):
        self.name, self.rest, self.start, self.parent = name, rest, start, parent
        self.end = self.cut = None
        self.closed = self.wraps = self.headed = self.last = False

    def held(self) -> int:
        return (self.end if self.closed or self.cut is None else self.cut) - self.start


def page_events(page: str) -> tuple[list[tuple], int]:
    """Texts, starts and ends of elements in page order, and the characters outside links. Elements
    without an end tag end by the rules of the markup language, at the latest with the page."""
    events, stack, open_, headings = [], [], Counter(), []
    plain = in_link = 0
    at, end_of = 0, len(page)

    def add(text):
        nonlocal plain
        if text:
            events.append(("text", text, in_link > 0))
            if not in_link:
                plain += len(text.strip())

    def leave(place, closed):
        while len(stack) > place:
            e = stack.pop()
            open_[e.name] -= 1
            e.end = plain
            e.closed = closed if len(stack) == place else e.name in OPEN_ENDED and closed
            events.append(("end", e, None))

    def find(names, beyond):
        """Place of the innermost open element of these names, or None."""
        if not any(open_[n] for n in names):
            return None
        for i in range(len(stack) - 1, -1, -1):
            if stack[i].name in names:
                return i
            if stack[i].name in beyond:
                return None
        return None

    while at < end_of:
        m = TOKEN.search(page, at)
        if m is None:
            add(page[at:])
            break
        add(page[at:m.start()])
        at = m.end()
        name = m["name"]
        if name is None:
            continue
        name, ends, rest = name.lower(), bool(m["end"]), m["rest"]
        if not ends and name in RAW:
            stop = re.compile(rf"</{name}\s*>|\Z", re.I).search(page, at)
            at = stop.end()
            continue
        if name == "a":
            in_link = max(0, in_link + (-1 if ends else 1))
        elif name == "br":
            events.append(("text", " ", True))
        if name in BLOCKS:
            in_link = 0
        if ends:
            if name in TABLE_PARTS or name == "table":
                beyond = frozenset(("table", "template")) - {name}
            elif name in ("li", "p"):
                beyond = SCOPE | (frozenset(("ol", "ul")) if name == "li" else {"button"})
            else:
                beyond = SCOPE - {name} if name in SPECIAL else SPECIAL
            place = find((name,), beyond)
            if place is not None:
                leave(place, True)
            elif name in BLOCKS:
                events.append(("break", None, None))
            continue
        if name in ENDS_P and (place := find(("p",), SCOPE | {"button"})) is not None:
            leave(place, True)
        if name in IMPLIED:
            while (place := find(*IMPLIED[name])) is not None:
                leave(place, True)
        if name in BLOCKS:
            events.append(("break", None, None))
        if name in VOID or name in ("html", "body"):
            continue
        if name in ARTICLE:
            for e in stack:
                if e.cut is None:
                    e.cut = plain
        if name == "h1" or (name in ARTICLE and not _is_furniture(name, rest, False)):
            for e in stack:
                e.wraps = True
        if name in HEADINGS:
            for e in stack:
                e.headed = True
        if rest.endswith("/") and (name not in BLOCKS or _is_furniture(name, rest, False)):
            continue
        if len(stack) < DEPTH or name in SPECIAL:
            e = _Element(name, rest, plain, stack[-1] if stack else None)
            if name in HEADINGS:
                headings.append(e)
            stack.append(e)
            open_[name] += 1
            events.append(("start", e, None))
    leave(0, False)
    least: dict = {}
    for e in reversed(headings):
        key = id(e.parent)
        e.last = e.name < least.get(key, "h7")
        least[key] = min(e.name, least.get(key, "h7"))
    return events, plain


def page_lines(page: str) -> tuple[list[tuple[str, int, bool]], bool]:
    """``(lines, marked)``: a line per block in page order as (text, its characters outside links,
    whether it lies in an article element), and whether the page has such an element with text.
    Furniture, with all that lies in it, scripts, comments and markup are empty lines. Furniture
    that is not closed ends where an article starts. What follows a last heading "Comments" in its
    element is furniture as well."""
    events, total = page_events(page)
    lines, parts, skips = [], [], []
    linked = plain = depth = 0
    page_end = _Element("", "", 0, None)

    def close():
        nonlocal parts, linked, plain
        # references first, so that a no-break space counts as white space
        text = SPACE.sub(" ", entities.unescape("".join(parts))).strip()
        share = plain / (plain + linked) if plain + linked else 0
        lines.append((text, round(len(text) * share), depth > 0))
        parts, linked, plain = [], 0, 0

    for kind, what, in_link in events:
        if kind == "text":
            if not skips:
                parts.append(what)
                n = len(what.strip())
                if in_link:
                    linked += n
                else:
                    plain += n
            continue
        if kind == "start":
            if skips and (skips[0].closed or not (what.closed or what.name in ARTICLE)):
                continue
            furniture = _is_furniture(what.name, what.rest, depth > 0, what, total)
            if skips and not furniture and what.name in ARTICLE and not any(
                    e.closed for e in skips):
                skips.clear()  # the furniture before an article was never closed
            if furniture:
                if not skips:
                    close()
                skips.append(what)
            elif not skips and what.name in ARTICLE:
                close()
                depth += 1
        elif kind == "end":
            if skips:
                if skips[-1] is what:
                    skips.pop()
                    if not skips:
                        close()
            elif what.name in ARTICLE:
                close()
                depth -= 1
            elif what.name in BLOCKS:
                close()
                if (what.name in HEADINGS and what.last and COMMENTS_HEADING.fullmatch(lines[-1][0])
                        and any(t for t, _, _ in lines[:-1])):
                    lines[-1] = ("", 0, depth > 0)
                    above = what.parent
                    while above is not None and above.held() == what.held():
                        above = above.parent  # a block of the heading alone
                    skips.append(above if above is not None else page_end)
        elif not skips:
            close()
    close()
    return lines, any(t and inside for t, _, inside in lines)


def passages(lines: list[tuple[int, float]], window: int):
    """``(number, characters)`` of lines, cut where ``window`` or more in a row have none."""
    out, none = [], []
    for line in lines:
        if not line[1]:
            none.append(line)
            continue
        if len(none) >= window and out:
            yield out
            out = []
        if len(none) < window:
            out += none
        none = []
        out.append(line)
    if out:
        yield out + (none if len(none) < window else [])


def main_text(page: str | None, window: int = 3, surge: float = 0.125) -> str:
    """The article of a page, one line per block.

    The page is taken as lines (:func:`page_lines`) and the distribution is, for each line, the
    characters outside links of ``window`` lines from it on. A passage reaches from where that sum
    dives to nothing to where it does so again, and is kept if the sum surges anywhere in it: to
    ``surge`` times the median over the page, or to ``DENSE`` characters if that is less.

    On a page that marks its article with an element, the lines in it follow each other, whatever
    stands between them; characters outside it weigh ``surge`` and make passages of their own.
    Lines that are links only are left out, but for those in the element between lines that are kept.
    """
    lines, marked = page_lines(page or "")
    within, stretches, last = [], [], None
    for i, (text, n, inside) in enumerate(lines):
        if text:
            if inside:
                within.append((i, n))
            elif last is not False:
                stretches.append([])
            if not inside:
                stretches[-1].append((i, n * surge if marked else n))
            last = inside
    found = []
    for stretch in [within, *stretches]:
        for passage in passages(stretch, window):
            sums = [sum(n for _, n in passage[k:k + window]) for k in range(len(passage))]
            found.append((passage, [x for x in sums if x]))
    sums = [x for _, own in found for x in own]
    least = max(1, min(surge * median(sums), DENSE)) if sums else 1
    kept = {i for passage, own in found if max(own) >= least
            for i, n in passage if n or lines[i][2]}
    own = [i for i, _ in within if i in kept]
    if own:
        kept.update(i for i, n in within if not n and own[0] < i < own[-1])
    return "\n".join(lines[i][0] for i in sorted(kept))


def extract_text(df: DataFrame, id_col: str = "page_id", url_col: str = "url",
                 html_col: str = "html", window: int = 3, surge: float = 0.125) -> DataFrame:
    """Per row: id, url, ``text`` (empty if there is none), ``n_chars`` (its code points).

    Null pages are empty pages; null ids and urls stay null; repeated rows each give their row;
    other columns are not read. A page that breaks off within a tag loses that tag only, and open
    elements end with the page.
    """
    def run(batches):
        for batch in batches:
            texts = [main_text(h.as_py(), window, surge) for h in batch.column("_html")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), batch.column("_url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())],
                [id_col, url_col, "text", "n_chars"])

    rows = df.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url"),
                     F.col(html_col).alias("_html"))
    schema = StructType([
        StructField(id_col, rows.schema["_id"].dataType),
        StructField(url_col, rows.schema["_url"].dataType),
        StructField("text", StringType()), StructField("n_chars", LongType())])
    return rows.mapInArrow(run, schema)
