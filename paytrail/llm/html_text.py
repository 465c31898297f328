"""Main text of web pages by two passes of block rules.

The first pass looks at each block alone: its length, the share of stop words and the share of
text inside links decide good or bad, or leave a short or unclear block open. In the second
pass an open block takes the label of the nearest decided blocks around it. What nothing speaks
against is kept: only an aside or a share of links makes a block bad by itself, as few stop words
may also mean a language without a list.
"""

import html
import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paytrail.llm.common import shipped

#: Frequent words of the languages served. Fixed values.
STOP_WORDS = frozenset(
    # English
    "a about after all also an and any are as at be because been but by can could did do for from had has have "
    "he her his how i if in into is it its may more most no not of on one only or other our out over she so some "
    "such than that the their them then there these they this to up was we were what when which who will with "
    "would you your "
    # French
    "au aux avec ce ces dans de des du elle en est et eu il ils je la le les leur lui mais me même mes mon ne nos "
    "nous on ou par pas pour qu que qui sa se ses son sur ta te tu un une vos vous été être "
    # German
    "aber als am an auch auf aus bei bin bis bist da das dass dem den der des die ein eine einem einen einer es "
    "für hat ich im ist ja kann man mit nach nicht noch nur oder sie sich sind so um und uns von vor war was wenn "
    "wie wir wird zu zum zur über "
    # Spanish
    "al como con cuando del desde donde el ella en entre era es esta este fue ha hay la las lo los más muy no o "
    "para pero por que se ser si sin sobre su sus también un una y ya".split()
)
#: Elements whose content is never part of the main text. Fixed values of the markup language.
DROPPED = frozenset(
    "script style noscript template svg math iframe object canvas select option textarea button head title".split()
)
BOILERPLATE = frozenset("nav header footer aside form menu dialog".split())
MAIN = frozenset("article main".split())
#: Elements that begin or end a block. Fixed values of the markup language.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th "
    "thead tr ul dialog".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements without content. Fixed values of the markup language.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is plain text up to the end tag, whatever it looks like. Fixed values of the markup language.
RAW = frozenset("script style textarea title iframe noscript template".split())
#: Words in a class, id or label that mark something beside the article; a star stands for any ending. Fixed values.
ASIDE_WORDS = (
    "ad ads advert* adsense alert banner sponsor* promo* sidebar* menu* nav* breadcrumb* footer header masthead cookie* "
    "consent notice gdpr popup modal newsletter subscri* comment* respond replies disqus* related recommend* share "
    "sharing social* widget* login signup search* pagination pager toolbar copyright disclaimer".split()
)
#: Words that say where such a thing is, whose it is or what it is made of. Fixed values.
NEUTRAL_WORDS = frozenset(
    "site main global top bottom left right primary secondary mobile desktop sticky floating js post page user author "
    "skip email google display reader readers visitor article entry privacy box side bar area block button buttons btn "
    "container content dialog fixed form group icon icons inner item items link links list media message outer overlay "
    "panel policy posts articles stories section slot text thread title toggle unit wrap wrapper expand sm md lg xl".split()
)
#: Words beside which a header belongs to the article. Fixed values.
OWN_HEADER = frozenset("post page article entry section".split())
#: ARIA roles of what is beside the article. Fixed values.
ASIDE_ROLES = frozenset(
    "complementary contentinfo banner navigation search alert alertdialog dialog menu menubar form toolbar".split()
)
_ASIDE_WORD = re.compile("|".join(w.replace("*", "[a-z0-9]*") for w in ASIDE_WORDS))
_SIZE = re.compile(r"\d+(?:x\d+)?")
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_NO_DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.I)
_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_FIRST_BLOCK = re.compile(rf"</?(?:{'|'.join(sorted(BLOCKS))})(?=[\s/>])", re.I)
_WORD = re.compile(r"[^\W\d_]+")

GOOD, BAD, OPEN = 1, -1, 0
#: Thresholds of the first pass.
LINK_DENSITY = 0.3
MAIN_LINK_DENSITY = 0.8
SHORT_CHARS = 70
LONG_CHARS = 200
STOP_HIGH = 0.20
STOP_LOW = 0.08


class Block:
    """Text of a block with what the rules need to know of it."""

    __slots__ = ("parts", "linked", "main", "aside", "heading")

    def __init__(self, main, aside, heading):
        self.parts, self.linked, self.main, self.aside, self.heading = [], 0, main, aside, heading

    def text(self):
        return " ".join(html.unescape("".join(self.parts)).split())


def _aside_name(name: str) -> bool:
    """Whether a name says that something is beside the article, in whatever order its words stand.

    One of its words must mark an aside and all others be neutral or a size: ``reader-comments`` and
    ``ad-300x250`` do, ``has-sidebar`` and ``search-results`` do not.
    """
    words = [w for w in re.split(r"[-_:]+", name.lower()) if w]
    marks = {w for w in words if _ASIDE_WORD.fullmatch(w)}
    if words[:2] == ["side", "bar"]:
        marks.add("sidebar")
    rest = [w for w in words if w not in marks]
    if marks == {"header"} and OWN_HEADER.intersection(rest):
        return False
    return bool(marks) and all(w in NEUTRAL_WORDS or _SIZE.fullmatch(w) for w in rest)


def _named_aside(attributes: dict[str, str]) -> bool:
    """Whether the role, a class, the id or the label names something beside the article."""
    if ASIDE_ROLES.intersection(attributes.get("role", "").lower().split()):
        return True
    names = [n for key in ("class", "id") for n in attributes.get(key, "").split()]
    names.append("-".join(attributes.get("aria-label", "").split()))
    return any(map(_aside_name, names))


def _hidden(attributes: dict[str, str]) -> bool:
    return (
        attributes.get("hidden", "false").lower() != "false"
        or attributes.get("aria-hidden", "").lower() == "true"
        or bool(_NO_DISPLAY.search(attributes.get("style", "")))
    )


def _attributes(tag: str) -> dict[str, str]:
    """Attributes by name; of a repeated one the first counts."""
    found: dict[str, str] = {}
    for name, *values in _ATTRIBUTE.findall(tag):
        found.setdefault(name.lower(), "".join(values))
    return found


@lru_cache(maxsize=10_000)
def _marks(tag: str) -> tuple[bool, bool]:
    """(named as an aside, hidden) by the attributes of a start tag."""
    attributes = _attributes(tag)
    return _named_aside(attributes), _hidden(attributes)


class _Scanner:
    """Finds the tags of a page in one pass, however broken: no place is searched twice for one sign."""

    def __init__(self, page: str):
        self.page, self.ahead = page, {}

    def _find(self, sign: str, at: int) -> int:
        """Next place of a sign, -1 for none; what was found ahead is kept."""
        place = self.ahead.get(sign, 0)
        if place == -1 or place >= at and sign in self.ahead:
            return place
        place = self.ahead[sign] = self.page.find(sign, at)
        return place

    def tag(self, at: int):
        """(start, end, slash, name, attributes) of the next tag or comment; its name is empty then."""
        page = self.page
        at = self._find("<", at)
        while at >= 0:
            if page.startswith("<!--", at):
                end = self._find("-->", at + 4)
                return at, end + 3 if end >= 0 else len(page), "", "", ""
            if page.startswith(("<!", "<?"), at):
                end = self._find(">", at)
                return at, end + 1 if end >= 0 else len(page), "", "", ""
            if name := _NAME.match(page, at):
                end = self._close(name.end())
                if end < 0:
                    return None
                return at, end + 1, name[1], name[2], page[name.end() : end]
            at = self._find("<", at + 1)
        return None

    def _close(self, at: int) -> int:
        """Where the tag ends, past quoted values; a quote that is never closed is a sign like any other."""
        while True:
            end = self._find(">", at)
            if end < 0:
                return -1
            quotes = [q for q in (self._find('"', at), self._find("'", at)) if 0 <= q < end]
            if not quotes:
                return end
            opened = min(quotes)
            closed = self._find(self.page[opened], opened + 1)
            at = closed + 1 if closed >= 0 else opened + 1


def _end_of_dropped(page: str, name: str, at: int, ends: dict[str, re.Match | None]) -> int:
    """Where the content of a dropped element ends; ``at`` if its end tag is missing.

    Outside raw text an end tag behind the next element of that name, the body, a main
    element or an article belongs to another. Raw text without an end tag runs to the first block.
    """
    end = ends.get(name)
    if name not in ends or end and end.start() < at:
        end = ends[name] = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
    if name in RAW:
        if end:
            return end.end()
        if name in ("noscript", "template", "iframe"):
            return at
        block = _FIRST_BLOCK.search(page, at)
        return block.start() if block else len(page)
    if not end:
        return at
    own = "" if name in ("svg", "math", "object", "canvas") else f"{name}|"
    other = re.compile(rf"<(?:{own}body|article|main)(?=[\s/>])", re.I).search(page, at, end.start())
    return at if other else end.end()


def blocks(page: str) -> list[tuple[str, float, int, bool, bool]]:
    """(text, link density, number of the main element or 0, aside, heading) of each block, in page order.

    What is named like something beside the article, or is a form, but holds the page's main
    element is no aside. The same holds for an article, if none stands outside all asides:
    else it is a comment or a teaser.
    """
    holders: dict[int, bool] = {}
    found, outside = _blocks(page, frozenset(), holders)
    exempt = frozenset(at for at, sure in holders.items() if sure or not outside)
    return _blocks(page, exempt, {})[0] if exempt else found


def _blocks(page: str, exempt: frozenset[int], holders: dict[int, bool]):
    """The blocks, and whether an article or main element stands outside all asides.

    ``holders`` gets the places of the asides around such elements, true for a main element;
    ``exempt`` has the places of those that are no asides.
    """
    found, stack = [], []
    state = {"main": 0, "aside": 0, "link": 0, "heading": 0, "mains": 0}
    current = Block(0, False, False)
    at, ends = 0, {}

    def close():
        nonlocal current
        if current.parts:
            found.append(current)
        current = Block(state["main"], state["aside"] > 0, state["heading"] > 0)

    def leave(entry):
        name, aside, main, link, _ = entry
        state["aside"] -= aside
        state["link"] -= link
        state["heading"] -= name in HEADINGS
        if main:
            state["main"] = 0

    def add(text):
        if text:
            current.parts.append(text)
            if state["link"]:
                current.linked += len("".join(text.split()))

    scanner = _Scanner(page)
    while tag := scanner.tag(at):
        start, end, slash, name, attributes = tag
        add(page[at:start])
        at = end
        if not name:
            continue
        name = name.lower()
        if slash:
            if name in BLOCKS:
                close()
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), None)
            if depth is not None:
                for entry in reversed(stack[depth:]):
                    leave(entry)
                del stack[depth:]
                if name in BLOCKS:
                    close()
            continue
        if name == "br":
            add("\n")
            continue
        if name in DROPPED:
            if not attributes.endswith("/"):
                at = _end_of_dropped(page, name, at, ends)
            continue
        named, hidden = _marks(attributes)
        aside = name in BOILERPLATE or named or hidden
        if name == "header" and state["main"] and not named:
            aside = False
        if name == "article":
            # A comment or a teaser may be an article, too.
            aside = named
            if aside and start not in exempt:
                holders.setdefault(start, False)
        if name in ("main", "body", "html") or start in exempt:
            aside = False
        if name in BLOCKS:
            if name in ("p", "li") and stack and stack[-1][0] == name:
                leave(stack.pop())
            close()
        if name in VOID or attributes.endswith("/"):
            continue
        if name in MAIN and state["aside"]:
            for entry in stack:
                if entry[4] is not None:
                    holders[entry[4]] = holders.get(entry[4], False) or name == "main"
        main = name in MAIN and not state["main"] and not state["aside"] and not aside
        if main:
            state["mains"] += 1
            state["main"] = state["mains"]
        state["aside"] += aside
        state["link"] += name == "a"
        state["heading"] += name in HEADINGS
        loose = aside and not hidden and (name == "form" or name not in BOILERPLATE)
        stack.append((name, aside, main, name == "a", start if loose else None))
        if name in BLOCKS:
            close()
    rest = page[at:]
    cut = re.search(r"<(?:[a-zA-Z/!]|\Z)", rest)
    add(rest[: cut.start()] if cut else rest)
    close()
    result = []
    for block in found:
        text = block.text()
        if text:
            solid = len(text.replace(" ", ""))
            result.append((text, min(1.0, block.linked / max(1, solid)), block.main, block.aside, block.heading))
    return result, state["mains"] > 0


def first_pass(text: str, link_density: float, main: int, aside: bool) -> int:
    """Label of a block by itself."""
    if aside or link_density > (MAIN_LINK_DENSITY if main else LINK_DENSITY):
        return BAD
    if len(text) < SHORT_CHARS:
        return OPEN
    words = _WORD.findall(text.lower())
    density = sum(w in STOP_WORDS for w in words) / max(1, len(words))
    if density >= STOP_HIGH or (density >= STOP_LOW and len(text) >= LONG_CHARS):
        return GOOD
    # Prose with few stop words is unclear, not bad: its language may have no list.
    return OPEN


def second_pass(labels: list[int], found: list[tuple]) -> list[bool]:
    """Open blocks take the label of their nearest decided neighbours.

    Inside a main element an open block is good, unless it is short and stands between two bad
    blocks of the element without a heading. Elsewhere the nearer neighbour decides, and at equal
    distance the good one. A heading is kept with all
    up to a good block after it, and a long block beside a good one, whatever the distance, if no bad
    block lies between. On a page without any good block all open blocks are kept.
    """
    before, after = [None] * len(labels), [None] * len(labels)
    for side, order in ((before, range(len(labels))), (after, range(len(labels) - 1, -1, -1))):
        seen = None
        for i in order:
            side[i] = seen
            if labels[i] != OPEN:
                seen = i
    some, headed = GOOD in labels, False
    kept = []
    for i, label in enumerate(labels):
        text, _, main, _, heading = found[i]
        # Whether a heading came since the last decided block.
        headed = label == OPEN and (headed or heading)
        if label != OPEN:
            kept.append(label == GOOD)
            continue
        around = [j for j in (before[i], after[i]) if j is not None]
        if main:
            walled = len(around) == 2 and all(labels[j] == BAD and found[j][2] == main for j in around)
            kept.append(not walled or headed or len(text) >= SHORT_CHARS)
            continue
        if not some:
            kept.append(True)
            continue
        good = [abs(j - i) for j in around if labels[j] == GOOD]
        bad = [abs(j - i) for j in around if labels[j] == BAD]
        leads = headed and after[i] is not None and labels[after[i]] == GOOD
        kept.append(bool(good) and (
            leads or len(text) >= SHORT_CHARS or not bad or min(good) <= min(bad)
        ))
    return kept


def main_text(page: str | None) -> str:
    """The blocks kept, in page order, one to a line."""
    found = blocks(page or "")
    labels = [first_pass(*block[:4]) for block in found]
    kept = second_pass(labels, found)
    return "\n".join(block[0] for block, keep in zip(found, kept, strict=True) if keep)


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of each row of ``pages`` (page_id, url, html).

    A null or empty page gives an empty text; repeated rows are extracted again; other
    columns are not looked at. Pages are read where they are, nothing is shuffled.
    """

    def run(batches):
        for batch in batches:
            texts = [main_text(page) for page in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                 pa.array(list(map(len, texts)), pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    rows = shipped(pages).select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html"
    )
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
