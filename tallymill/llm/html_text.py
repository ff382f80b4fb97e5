"""Main text of web pages as the maximum-scoring run of words and tags.

A page is read once into text, start tags and end tags; every step is linear in its
length, whatever it holds. Words and tags have weights: words are positive, tags
negative, and one linear scan finds the contiguous run with the highest sum.

Elements have features, the words of their class, id and role. A feature's weight is
the log-ratio of how often elements with it lie inside and outside of the main text. An
element whose features speak against it is left out of the run, as are those that the
language itself sets apart from an article, such as menus, forms and scripts; the run
goes on behind it. An element that holds all the marked main text of a page, or, where
nothing is marked, most of its words, is never left out: such classes describe a layout.

All weights are counted on labelled pages: pages that mark their main text themselves,
by an ``article`` or ``main`` element. Where a page does so, no run crosses its edges
and none starts anew inside. Common words for adverts, menus and the like start with a
few sightings outside of main texts (``MARKS``); what the pages show is added to them.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: Labelled pages that the weights are counted on, at most.
TRAIN_PAGES = 2000

# Element names of the HTML standard by what they mean here.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr basefont frame keygen command".split()
)
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
NEVER = frozenset(
    "head script style noscript template iframe object applet svg canvas math audio video map nav header footer aside "
    "menu form button select option datalist textarea input label fieldset dialog title noframes noembed frameset".split()
)
MAIN = frozenset(["article", "main"])
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark nobr q rb rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
# Elements whose start ends an open paragraph.
_CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hgroup hr main menu nav ol p pre section table ul".split()
)
# What may stand in a head; anything else ends it.
_IN_HEAD = frozenset("title meta link script style base basefont noscript template".split())
# Elements whose id names what they are, not a place to jump to.
_CONTAINERS = frozenset("div section ul ol dl table td aside nav header footer form iframe body".split())

# Words by which pages commonly name what is not their main text.
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adslot adbox adunit banner banners sponsor sponsored promo promotion "
    "menu navbar nav navigation breadcrumb breadcrumbs sidebar side aside footer foot masthead topbar header toolbar cookie cookies "
    "consent gdpr notice notices alert disclaimer popup modal overlay newsletter subscribe subscription signup login register share "
    "sharing social related recommended recommendations comment comments commentlist disqus respond replies reply discussion pagination "
    "pager search widget widgets copyright legal complementary contentinfo dialog hidden skiplink tags tagcloud toc".split()
)
# What before such a word says that it describes a layout, not the element.
_LAYOUT = frozenset("has no with without show hide is not".split())

_SPACE = re.compile(r"\s+")
_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
# An attribute, with its value in quotes, or without; or what stands in its place.
_ATTRIBUTE = re.compile(r"[\s/]*([^\s/>=][^\s/>=]*)?(?:\s*(=)\s*)?")
_BARE = re.compile(r"[^\s>]*")
_NONE_SHOWN = re.compile(r"display\s*:\s*none", re.I)

#: A tag never adds to a run, and a word of content always does.
TAG_AT_MOST = -0.01
WORD_AT_LEAST = 0.05
#: Tags that the labelled pages do not hold.
TAG_UNKNOWN = -0.5
#: Sightings outside of main texts that a word of ``MARKS`` starts with, and sightings on both sides of any.
MARK_COUNT = 6
ANY_COUNT = 1
#: An element is left out if its features weigh less.
FEATURES_AT_LEAST = -1.0


class Element:
    """A start tag, and where its element ends in the list of a page's tokens."""

    __slots__ = ("name", "attributes", "end", "is_void")

    def __init__(self, name: str, attributes: dict[str, str], is_void: bool):
        self.name, self.attributes, self.is_void, self.end = name, attributes, is_void, 0


class End(str):
    """An end tag."""


Token = str | Element | End


def tokens(page: str) -> list[Token]:
    """A page as text, start tags and end tags. Comments and the contents of scripts and the like are dropped."""
    found: list[Token] = []
    at, size = 0, len(page)
    folded = None
    while at < size:
        start = page.find("<", at)
        if start < 0:
            found.append(page[at:])
            break
        if start > at:
            found.append(page[at:start])
        if page.startswith("<!--", start):
            end = page.find("-->", start + 2)
            other = page.find("--!>", start + 4, end if end >= 0 else size)
            at = other + 4 if other >= 0 else end + 3 if end >= 0 else size
            continue
        if page.startswith("<![CDATA[", start):
            end = page.find("]]>", start)
            at = end + 3 if end >= 0 else size
            continue
        if page[start + 1 : start + 2] in ("!", "?"):
            end = page.find(">", start)
            at = end + 1 if end >= 0 else size
            continue
        closing = page.startswith("/", start + 1)
        match = _NAME.match(page, start + 1 + closing)
        if match is None:
            if closing:  # not a tag, and not text either
                end = page.find(">", start)
                at = end + 1 if end >= 0 else size
            else:
                found.append("<")
                at = start + 1
            continue
        name = match[0].lower()
        attributes, empty, at = _attributes(page, match.end())
        if at < 0:  # the page ends inside of the tag
            break
        if closing:
            found.append(End(name))
            continue
        found.append(Element(name, attributes, empty or name in VOID))
        if name in RAW and not empty:
            folded = page.lower() if folded is None else folded
            # Lower case may change lengths outside of ASCII; then the page is searched as it is.
            text = folded if len(folded) == size else page
            end = text.find("</" + name, at)
            at = end if end >= 0 else size
            found.append(End(name))
    return found


def _attributes(page: str, at: int) -> tuple[dict[str, str], bool, int]:
    """The attributes of a tag from ``at`` on, whether it is closed at once, and where it ends (-1: nowhere)."""
    found: dict[str, str] = {}
    size = len(page)
    while True:
        match = _ATTRIBUTE.match(page, at)
        at = match.end()
        if at >= size:
            return found, False, -1
        if match[2]:
            quote = page[at]
            if quote in "\"'":
                end = page.find(quote, at + 1)
                if end < 0:
                    return found, False, -1
                value, at = page[at + 1 : end], end + 1
            else:
                bare = _BARE.match(page, at)
                value, at = bare[0], bare.end()
            if match[1]:
                found.setdefault(match[1].lower(), value)
        elif match[1]:
            found.setdefault(match[1].lower(), "")
        if page.startswith(">", at):
            return found, page[at - 1] == "/", at + 1


def nested(page: list[Token]) -> None:
    """Set where each element of a page ends: at its end tag, or with what holds it."""
    stack: list[int] = []
    is_open: dict[str, int] = {}

    def close(place: int) -> str:
        element = page[stack.pop()]
        element.end = place
        is_open[element.name] -= 1
        return element.name

    for place, token in enumerate(page):
        if isinstance(token, End):
            if is_open.get(token):
                while close(place) != token:
                    pass
        elif isinstance(token, Element):
            if is_open.get("head") and token.name not in _IN_HEAD:
                while close(place) != "head":
                    pass
            if token.name in _CLOSES_P and stack and page[stack[-1]].name == "p":
                close(place)
            if token.is_void:
                token.end = place
            else:
                stack.append(place)
                is_open[token.name] = is_open.get(token.name, 0) + 1
    while stack:
        close(len(page))


def features(element: Element) -> set[str]:
    """The words of an element's class and role, and of its id where that tells what it is.

    A word made of parts gives its parts too if there are two of them, one each side of
    a hyphen or the like, and the first does not say that they describe a layout.
    """
    attributes = element.attributes
    if not attributes or element.name in ("html", "body"):
        return set()
    values = [attributes.get("class", ""), attributes.get("role", ""), attributes.get("itemtype", "").rpartition("/")[2]]
    if element.name in _CONTAINERS:
        values += [attributes.get("id", ""), attributes.get("aria-label", "")]
    found = set()
    for word in " ".join(values).lower().split():
        found.add(word)
        parts = [part.rstrip("0123456789") for part in re.split(r"[-_.:]+", word) if part]
        if len(parts) <= 2 and parts and parts[0] not in _LAYOUT:
            found.update(parts)
    return found


def is_hidden(element: Element) -> bool:
    attributes = element.attributes
    return bool(attributes) and (
        "hidden" in attributes and attributes["hidden"].lower() != "until-found"
        or attributes.get("aria-hidden", "").lower() == "true"
        or bool(_NONE_SHOWN.search(attributes.get("style", "")))
    )


def feature_weight(feature: str, inside: int, outside: int) -> float:
    """The log-ratio of sightings of a feature inside and outside of main texts."""
    return math.log((inside + ANY_COUNT) / (outside + ANY_COUNT + (MARK_COUNT if feature in MARKS else 0)))


class Block:
    """Text of one block of a page, with what surrounds it."""

    __slots__ = ("text", "words", "inside", "tags")

    def __init__(self, text: str, words: int, inside: bool, tags: list[str]):
        self.text, self.words, self.inside, self.tags = text, words, inside, tags


class Page:
    """The tokens of a page, with running counts of words and of elements that mark main text."""

    def __init__(self, page: str):
        self.tokens = tokens(page)
        nested(self.tokens)
        self.words, self.mains = [0], [0]
        raw = 0
        for place, token in enumerate(self.tokens):
            is_text = type(token) is str
            if isinstance(token, Element) and token.name in NEVER and token.name not in ("header", "form"):
                raw = max(raw, token.end)
            self.words.append(self.words[-1] + (len(token.split()) if is_text and place >= raw else 0))
            self.mains.append(self.mains[-1] + (isinstance(token, Element) and token.name in MAIN))
        self.has_main = self.mains[-1] > 0

    def is_layout(self, place: int) -> bool:
        """Whether an element holds all marked main text, or without any most words of the page."""
        end = self.tokens[place].end
        if self.has_main:
            return self.mains[end] - self.mains[place + 1] == self.mains[-1] and self.tokens[place].name not in MAIN
        return 2 * (self.words[end] - self.words[place]) > self.words[-1]

    def left_out(self, place: int, in_main: bool, weight: Mapping[str, float]) -> bool:
        """Whether an element and all it holds is no main text."""
        element = self.tokens[place]
        if element.name in RAW or element.name == "head":
            return True
        if self.is_layout(place):
            return False
        if element.name in NEVER:
            # The header of an article holds its title.
            return not (element.name == "header" and in_main)
        if is_hidden(element):
            return True
        return sum(weight.get(f"@{f}", feature_weight(f, 0, 0)) for f in features(element)) < FEATURES_AT_LEAST

    def blocks(self, weight: Mapping[str, float] | None) -> list[Block]:
        """The text blocks outside of elements that are left out; without weights just scripts and the like are.

        Each block has the tags since the one before; ``-`` among them stands for an
        element that was left out.
        """
        found: list[Block] = []
        tags: list[str] = []
        parts: list[str] = []
        main_end = skip = 0
        place, size = 0, len(self.tokens)

        def flush(inside: bool) -> None:
            nonlocal tags
            text = _SPACE.sub(" ", html.unescape("".join(parts))).strip()
            parts.clear()
            if text:
                found.append(Block(text, text.count(" ") + 1, inside, tags))
                tags = []

        while place < size:
            token = self.tokens[place]
            inside = place < main_end
            if type(token) is str:
                parts.append(token)
                place += 1
                continue
            # The end tag of a main element still closes a block inside of it.
            if token == "br" if isinstance(token, End) else token.name == "br":
                parts.append(" ")
                place += 1
                continue
            if isinstance(token, End):
                if token not in INLINE:
                    flush(inside or place == main_end)
                    tags.append(str(token))
                place += 1
                continue
            if weight is None:
                skip = token.name in RAW or token.name == "head"
            else:
                skip = not token.is_void and self.left_out(place, inside, weight)
            if skip or token.name not in INLINE:
                flush(inside)
            if skip or token.is_void and token.name in NEVER:
                tags.append("-")
                # The end tag that ends the element goes with it; one of what holds it does not.
                end = token.end
                place = max(end + (end < size and self.tokens[end] == token.name), place + 1)
                continue
            if token.name not in INLINE:
                tags.append(token.name)
            if token.name in MAIN:
                main_end = max(main_end, token.end)
            place += 1
        flush(size <= main_end)
        return found


def counts(page: str) -> dict[tuple[str, bool], int]:
    """Words, tags and features of elements inside and outside of the main text, for a page that marks it.

    Elements that hold all of the main text count as inside.
    """
    parsed = Page(page)
    total: dict[tuple[str, bool], int] = {}
    if not parsed.has_main:
        return total

    def add(name: str, inside: bool, n: int = 1) -> None:
        total[name, inside] = total.get((name, inside), 0) + n

    for block in parsed.blocks(None):
        for tag in block.tags:
            add(tag, block.inside)
        add("", block.inside, block.words)
    main_start = main_end = 0
    for place, token in enumerate(parsed.tokens):
        if isinstance(token, Element):
            if token.name in MAIN:
                if place >= main_end:
                    main_start = place
                main_end = max(main_end, token.end)
            elif token.attributes:
                inside = place < main_end
                most = inside and 2 * (parsed.words[token.end] - parsed.words[place]) > parsed.words[main_end] - parsed.words[main_start]
                holds = most or parsed.is_layout(place)
                for feature in features(token):
                    # Adverts stand in articles too: a common word for them counts as inside only where it names most of one.
                    if holds or not inside or feature not in MARKS:
                        add(f"@{feature}", inside or holds)
    return total


def weights(total: Mapping[tuple[str, bool], int]) -> dict[str, float]:
    """Log-likelihood ratios of inside against outside: words at key ``""``, features at ``@`` and their name."""
    names = {name for name, _ in total if not name.startswith("@")} | {""}
    inside = sum(total.get((name, True), 0) for name in names) + len(names)
    outside = sum(total.get((name, False), 0) for name in names) + len(names)
    result = {}
    for name in names:
        ratio = math.log((total.get((name, True), 0) + 1) / inside) - math.log((total.get((name, False), 0) + 1) / outside)
        result[name] = max(ratio, WORD_AT_LEAST) if name == "" else min(ratio, TAG_AT_MOST)
    if not total:
        result = {"": 1.0}
    # What is left out of a run does not speak against what follows it.
    result["-"] = TAG_AT_MOST
    for name in {name for name, _ in total if name.startswith("@")}:
        result[name] = feature_weight(name[1:], total.get((name, True), 0), total.get((name, False), 0))
    return result


def main_text(page: str, weight: Mapping[str, float]) -> str:
    """The main text of one page: its blocks joined by line breaks, or nothing."""
    parsed = Page(page)
    found = parsed.blocks(weight)
    word = weight.get("", 1.0)
    best, best_at, total, start = 0.0, (0, 0), 0.0, 0
    for i, block in enumerate(found):
        if parsed.has_main and not block.inside:
            total, start = 0.0, i + 1
            continue
        gain = word * block.words
        cost = sum(weight.get(tag, TAG_UNKNOWN) for tag in block.tags)
        # Inside of a marked main text tags take no more than half of what the words behind them earn.
        total += max(cost, -gain / 2) if parsed.has_main else cost
        if total <= 0 and not (parsed.has_main and i > start):
            total, start = 0.0, i
        total += gain
        if total > best:
            best, best_at = total, (start, i + 1)
    return "\n".join(block.text for block in found[slice(*best_at)])


def learn(pages: DataFrame, html_column: str = "html", max_pages: int = TRAIN_PAGES) -> dict[str, float]:
    """Weights from at most ``max_pages`` pages that mark their main text, those with the smallest hashes."""
    page = F.col(html_column)
    marked = pages.filter(page.isNotNull() & page.rlike("(?i)<(article|main)[ >]")).select(
        page.alias("html"), F.xxhash64(page).alias("h")
    )
    # The hashes alone are ordered; the few chosen are then joined with the pages. Of
    # pages that are equal one counts.
    chosen = marked.groupBy("h").agg(F.count(F.lit(1)).alias("n")).orderBy("h").limit(max_pages).select("h")
    marked = marked.join(F.broadcast(chosen), "h").groupBy("h").agg(F.first("html").alias("html")).select("html")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[str, bool], int] = {}
        for batch in batches:
            for text in batch.column("html"):
                for key, n in counts(text.as_py()).items():
                    total[key] = total.get(key, 0) + n
        rows = [(name, inside, n) for (name, inside), n in total.items()]
        columns = zip(*rows) if rows else ((), (), ())
        types = [pa.string(), pa.bool_(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["name", "inside", "n"])

    rows = marked.mapInArrow(counted, "name string, inside boolean, n long").groupBy("name", "inside").agg(F.sum("n").alias("n"))
    return weights({(r.name, r.inside): r.n for r in rows.collect()})


def extracted(
    pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html"
) -> DataFrame:
    """(id, url, ``text``, ``n_chars``) of every page.

    Null html counts as empty, and a page without main text gives an empty text.
    Null or repeated ids each give their row, an empty table gives none, and other
    columns are ignored whatever their names. Nothing but the sample that the
    weights are counted on is shuffled.
    """
    weight = learn(pages, html_column)
    chosen = pages.select(
        F.col(id_column).alias("id"), F.col(url_column).alias("url"), F.coalesce(F.col(html_column), F.lit("")).alias("html")
    )
    id_type, url_type = (chosen.schema[c].dataType.simpleString() for c in ("id", "url"))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py(), weight) for page in batch.column("html")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=["id", "url", "text", "n_chars"],
            )

    found = chosen.mapInArrow(extract, f"id {id_type}, url {url_type}, text string, n_chars long")
    return found.withColumnsRenamed({"id": id_column, "url": url_column})
