"""Main text of web pages by consensus of their host.

On every page each container element gets a score: the text of its blocks, weighted down with distance and
by the share of links, and up for elements that say they hold the article. From the best container the page climbs to the
parent as long as that mostly adds unlinked text beside it (title, first paragraphs, sections), and votes for the
generalised path (tags and classes, digits folded) of where it ends; votes are counted per host in Spark, and
every page is extracted again with the path that won on its host: from the best-scoring element that has it. A page that
lacks that path uses its own best container. Menus, forms, notices and the like are left out wherever they stand. By their class
or id alone, elements are left out if the head word of a name says so, or any word of it and most of their text is links, but not
if the article or most of the page's unlinked text is in them.

Only block elements end a block; all others, unknown ones too, stand within it. Blocks come in page order, white space inside a
block becomes one space, character references are decoded once, and blocks are joined by an empty line. Nothing is cut. A null or
empty page has empty text. Unclosed and crossed tags end where their parent ends; a tag that the end of the page cuts off is
dropped. Time and memory are in proportion to the page, however deep its elements are nested. Pages without
a host vote together. Repeated pages vote as often as they occur; ties go to the path with
more text, then to the first in order of path. An empty table gives no rows. Only id, url and html are read.
"""

from __future__ import annotations

import functools
import html as entities
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.skew import fits_broadcast
from millrace.session import materialize

# Tags and class words by their meaning.
RAW = "script style textarea title xmp iframe noembed noframes".split()
VOID = "area base br col embed hr img input link meta param source track wbr".split()
BLOCK = """
address article aside blockquote body caption center colgroup dd details dialog dir div dl dt fieldset figcaption figure footer form
frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li listing main menu nav ol optgroup option p plaintext pre search section
summary table tbody td tfoot th thead tr ul xmp
""".split()
CONTAINERS = "article body center div main section table tbody td".split()
# Text in one of these beside the chosen container is not taken to go on with it.
APART = "article center div main td th".split()
LEFT_OUT = """
aside button dialog fieldset footer form head iframe input menu nav noscript object script select style svg template textarea title
""".split()
LEFT_OUT_WORDS = """
ad adblock adbox ads advert advertisement advertising adverts alert announcement banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus
footer gdpr login menu modal nav navbar navigation newsletter notice notification overlay pager pagination popup promo promoted promotion
recommended related replies reply share sharing sidebar signup skyscraper social sponsor sponsored subscribe toolbar widget
""".split()
LEFT_OUT_ROLES = "alert banner complementary contentinfo dialog form menu menubar navigation search".split()
HEADER_WORDS = "header masthead topbar".split()
# Words that may stand beside those above in one class or id; any other word makes it a name of something else.
PLACE_WORDS = """
area bar block box bottom buttons center container global inner item items left links list outer page right section site top wrap wrapper
""".split()
# A name that begins so tells a state of the page, not what the element is.
STATE_WORDS = "has hide hides is js no not show shows with without".split()
# Behind a word of those above, one of these makes no other thing of it.
GENERAL_WORDS = """
article articles body button content cta feed form group icon icons label line link message messages module panel post posts slot stories
story strip text this title tool tools unit zone
""".split()
ARTICLE_WORDS = "article body content entry main post story text".split()
# A start tag closes these open elements first, up to the nearest element of the second list.
CLOSES = {
    "li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table"),
    "td": ("td th", "tr table"), "th": ("td th", "tr table"), "option": ("option", "select"),
}

TOKEN = re.compile(
    r"""<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*+(?:>|\Z)|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)"""
    r"""(?P<rest>(?:[^>"'=]++|=\s*+(?>"[^"]*+"|'[^']*+')|[="'])*+)(?:>|\Z)""",
    re.S,
)
# One attribute after the other, each with its whole value.
ATTRIBUTE = re.compile(r"""([^\s"'>/=][^\s>/=]*+)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s>]++))?""", re.S)
WORDS = re.compile(r"[a-z]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
DIGITS = re.compile(r"\d+")
DECAY = (1.0, 0.8, 0.6, 0.45, 0.3, 0.2)
# An inline element may matter by one of these.
TELLING = re.compile(r"class|id\s*=|role|style|hidden", re.I)
_RAW, _VOID, _BLOCK, _CONTAINERS = map(frozenset, (RAW, VOID, BLOCK, CONTAINERS))
_OUT, _OUT_WORDS, _OUT_ROLES = map(frozenset, (LEFT_OUT, LEFT_OUT_WORDS, LEFT_OUT_ROLES))
_HEADER_WORDS, _PLACE_WORDS, _ARTICLE_WORDS = map(frozenset, (HEADER_WORDS, PLACE_WORDS, ARTICLE_WORDS))
_STATE_WORDS, _GENERAL_WORDS, _APART = map(frozenset, (STATE_WORDS, GENERAL_WORDS, APART))
_CLOSES = {k: (frozenset(a.split()), frozenset(b.split())) for k, (a, b) in CLOSES.items()}


@functools.lru_cache(1 << 16)
def names_any(tokens: str, wanted: frozenset, hint: bool = False) -> bool:
    """Whether a class or id names one of the wanted things: by its head, the last word that is not one of place, or by its first
    word if a general one follows. As a ``hint`` any word will do."""
    for token in tokens.split():
        words = WORDS.findall(CAMEL.sub(" ", token).lower())
        if wanted.isdisjoint(words) or words[0] in _STATE_WORDS:
            continue
        core = [w for w in words if w not in _PLACE_WORDS]
        if hint or core[-1] in wanted or core[0] in wanted and all(w in wanted or w in _GENERAL_WORDS for w in core):
            return True
    return False


class Element:
    """``suspect`` elements are left out by a word of theirs, unless the page's text is in them."""

    __slots__ = (
        "tag", "parent", "depth", "name", "out", "bonus", "container", "score", "inside", "in_article", "suspect", "hint", "suspected",
        "size", "linked", "holds", "low", "high", "apart", "heading",
    )

    def __init__(self, tag: str, parent: Element | None, rest: str = ""):
        self.tag, self.parent = tag, parent
        self.depth = 0 if parent is None else parent.depth + 1
        classes, names, role, hidden = "", "", "", False
        if rest:
            for name, value in ATTRIBUTE.findall(rest):
                name, value = name.lower(), value.strip("\"'")
                if name == "class":
                    classes = value
                elif name == "id":
                    names = value
                elif name == "role":
                    role = value.lower()
                elif name == "hidden" or name == "aria-hidden" and value == "true":
                    hidden = True
                elif name == "style" and "display:none" in value.replace(" ", "").lower():
                    hidden = True
        tokens = f"{classes} {names}"
        words = frozenset(WORDS.findall(tokens.lower())) if classes or names else frozenset()
        self.inside = tag in ("article", "main") or parent is not None and parent.inside
        self.in_article = tag == "article" or parent is not None and parent.in_article
        self.out = (
            parent is not None and parent.out or hidden or tag in _OUT or role in _OUT_ROLES or not self.inside and tag == "header"
        )
        self.suspect = bool(words) and (
            tag != "main" and names_any(tokens, _OUT_WORDS) or not self.inside and names_any(tokens, _HEADER_WORDS)
        )
        self.hint = bool(words) and tag != "main" and not self.suspect and names_any(tokens, _OUT_WORDS, True)
        self.suspected = False
        # The length of the unlinked and of the linked text in it, and whether it is or contains an article.
        self.size, self.linked, self.holds = 0, 0, tag in ("article", "main")
        # A cell holds the text only where tables lay out the page.
        self.container = tag in _CONTAINERS and not (tag == "td" and self.inside)
        self.bonus = {"article": 3.0, "main": 2.0}.get(tag, 1.5 if words & _ARTICLE_WORDS and tag != "body" else 1.0)
        self.score = 0.0
        # Its blocks are those from low up to high.
        self.low = self.high = 0
        # The innermost elements around a block in it that stand apart, or are a heading.
        own = tag in _APART and self.bonus == 1.0 or tag in ("article", "main")
        self.apart = self if own else parent.apart if parent is not None else None
        self.heading = self if tag in ("h1", "h2") else parent.heading if parent is not None else None
        self.name = ".".join([tag, *sorted(DIGITS.sub("0", c).replace(">", "") for c in classes.split())])

    def path(self) -> str:
        """The names from the top of the page down to this element."""
        names, at = [], self
        while at is not None:
            names.append(at.name)
            at = at.parent
        return ">".join(reversed(names))


class Page:
    """The blocks of a page outside of what is left out, each with the element that it stands in."""

    def __init__(self, source: str):
        self.blocks: list[tuple[Element, str]] = []
        self.unlinked: list[float] = []
        self.root = Element("body", None)
        self.all = [self.root]
        self.stack = [self.root]
        self.count: dict[str, int] = {}
        # What the parser finds: blocks of pieces, each with its element and whether it is linked.
        self.found: list[tuple[Element, list[tuple[str, Element, bool]]]] = []
        self.text: list[tuple[str, Element, bool]] = []
        self.links = 0
        self.parse(source)
        self.flush()
        self.leave_out()
        self.elements = [e for e in self.all if e.container and not e.out]
        for top, pieces in self.found:
            self.weigh(top, pieces)
        self.add_up()

    def push(self, element: Element) -> None:
        self.stack.append(element)
        self.all.append(element)
        self.count[element.tag] = self.count.get(element.tag, 0) + 1

    def pop_from(self, place: int) -> None:
        for element in self.stack[place:]:
            self.count[element.tag] -= 1
        del self.stack[place:]

    def flush(self) -> None:
        if self.text:
            self.found.append((self.stack[-1], self.text))
            self.text = []

    def leave_out(self) -> None:
        """Suspects go, but for those around the article or most of the unlinked text; all stay if nothing else would be left."""
        if not any(e.suspect or e.hint for e in self.all):
            return
        own = [e.size for e in self.all]
        for e in reversed(self.all[1:]):
            e.parent.size += e.size
            e.parent.linked += e.linked
            e.parent.holds |= e.holds
        # Unlinked text that no name puts in doubt: in articles, and in articles or main.
        clear = clear_main = 0
        for e, size in zip(self.all, own):
            e.suspect |= e.hint and 2 * e.linked > 3 * e.size
            e.suspected = e.suspect or e.parent is not None and e.parent.suspected
            if e.inside and not e.suspected:
                clear_main += size
                clear += size if e.in_article else 0
        total = left = self.root.size
        going = set()
        for e in self.all[1:]:
            if e.parent in going:
                going.add(e)
            elif e.suspect and not e.out:
                around = e.holds and not e.parent.in_article and e.size > clear
                most = 2 * e.size > total and (e.parent.inside or not clear_main)
                if not around and not most:
                    going.add(e)
                    left -= e.size
        if left > 0 or not total:
            for e in going:
                e.out = True

    def weigh(self, top: Element, pieces: list[tuple[str, Element, bool]]) -> None:
        block = " ".join(entities.unescape("".join([text for text, owner, _ in pieces if not owner.out])).split())
        if block:
            linked = sum([len(text) for text, owner, link in pieces if link and not owner.out])
            share = min(1.0, linked / max(1, len(block)))
            place = len(self.blocks)
            self.blocks.append((top, block))
            self.unlinked.append(len(block) * (1 - share))
            if top.high == 0:
                top.low = place
            top.high = place + 1

    def add_up(self) -> None:
        """Scores and ranges of blocks, from the innermost elements up. Text counts less for each container between."""
        steps = len(DECAY)
        worth: dict[Element, list[float]] = {}
        for (top, _), value in zip(self.blocks, self.unlinked):
            worth.setdefault(top, [0.0] * steps)[0] += value
        for e in reversed(self.all):
            if e.high == 0:
                continue
            values = worth.pop(e)
            if e.container:
                e.score = sum(v * d for v, d in zip(values, DECAY))
                values = [0.0, *values[: steps - 2], values[-2] + values[-1]]
            above = e.parent
            if above is not None:
                sums = worth.get(above)
                worth[above] = values if sums is None else [a + b for a, b in zip(sums, values)]
                above.low = e.low if above.high == 0 else min(above.low, e.low)
                above.high = max(above.high, e.high)

    def parse(self, source: str) -> None:
        position = 0
        while True:
            found = TOKEN.search(source, position)
            stop = found.start() if found else len(source)
            if stop > position and not self.stack[-1].out:
                text, top = source[position:stop], self.stack[-1]
                self.text.append((text, top, self.links > 0))
                if self.links:
                    top.linked += len(text.strip())
                else:
                    top.size += len(text.strip())
            if found is None:
                return
            position = found.end()
            tag = found["tag"]
            if tag is None or not source.endswith(">", 0, position):
                continue
            tag = tag.lower()
            if found["end"]:
                self.close(tag)
                continue
            self.open(tag, found["rest"])
            if tag in _RAW:
                end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I).search(source, position)
                position = end.end() if end else len(source)

    def open(self, tag: str, rest: str) -> None:
        if tag in ("html", "body") or tag in _RAW or tag in _VOID:
            if tag in _BLOCK:
                self.flush()
            elif tag == "br":
                self.text.append((" ", self.root, False))
            return
        top = self.stack[-1]
        if tag not in _BLOCK:
            self.links += tag == "a" and not top.out and "href" in rest.lower()
            if rest.endswith("/"):
                return
            if tag in _OUT or TELLING.search(rest):
                element = Element(tag, top, rest)
                if element.out or element.suspect or element.hint:
                    self.push(element)
                    return
            if top.tag == tag and len(self.stack) > 1:
                self.push(Element(tag, top))
            return
        if not top.out:
            # Blocks in what is left out do not tear the text around it.
            self.flush()
            self.links = 0
        # A block ends the paragraph that it stands in, with the inline elements in it.
        if self.count.get("p"):
            at = len(self.stack) - 1
            while at > 0 and self.stack[at].tag not in _BLOCK and self.stack[at].tag not in _OUT:
                at -= 1
            if self.stack[at].tag == "p":
                self.pop_from(at)
        if tag in _CLOSES:
            closed, limit = _CLOSES[tag]
            i = len(self.stack) - 1
            while i > 0 and any(self.count.get(t) for t in closed) and self.stack[i].tag not in limit:
                if self.stack[i].tag in closed:
                    self.pop_from(i)
                i -= 1
        self.push(Element(tag, self.stack[-1], rest))

    def close(self, tag: str) -> None:
        if tag not in _BLOCK:
            if tag == "a" and self.links:
                self.links -= 1
            if self.stack[-1].tag == tag and len(self.stack) > 1:
                self.pop_from(len(self.stack) - 1)
            elif tag in _OUT and self.count.get(tag):
                self.pop_from(max(i for i, e in enumerate(self.stack) if e.tag == tag))
            return
        if not self.stack[-1].out:
            self.flush()
        if self.count.get(tag):
            for i in range(len(self.stack) - 1, 0, -1):
                if self.stack[i].tag == tag:
                    self.pop_from(i)
                    return

    def whole(self, chosen: Element) -> Element:
        """Climbs from the chosen container as long as that adds, for the most part, text that goes on with its own."""
        at = chosen.parent
        # Beyond main nothing belongs to the text, nor what stands beside an article at the top of the page.
        article = chosen.inside
        while at is not None and chosen.tag != "main" and not (article and at is self.root):
            article |= at.inside
            if at.high - at.low > chosen.high - chosen.low:
                if not self.goes_on(chosen, at):
                    break
                chosen = at
            elif at.tag in ("article", "main"):
                chosen = at
            at = at.parent
        return chosen

    def goes_on(self, chosen: Element, at: Element) -> bool:
        """Whether more than half of what ``at`` adds is unlinked and stands beside the chosen, not in containers of
        its own. What lies between a heading and the text counts wherever it stands."""
        size = good = 0.0
        titled = False
        for place in (*range(at.low, chosen.low), *range(chosen.high, at.high)):
            element, block = self.blocks[place]
            # Something between the block and ``at``: the innermost of its kind lies below ``at``.
            apart = element.apart is not None and element.apart.depth > at.depth
            heading = element.heading is not None and element.heading.depth > at.depth
            titled |= heading and self.unlinked[place] > 0
            size += len(block)
            if not apart or titled and place < chosen.low or at.bonus > 1.0:
                good += self.unlinked[place]
        return 2 * good > size

    def best(self, elements: list[Element] | None = None) -> Element:
        """The whole text around the container with the highest score, of all or of some; the outermost of equals."""
        return self.whole(max(self.elements if elements is None else elements, key=lambda e: e.score * e.bonus))

    def with_path(self, path: str) -> list[Element]:
        """The containers with text that have this path. Each name of it is looked for among the children of what had the names
        before, so the paths of other elements are never spelled out."""
        names = path.split(">")
        matched = {self.root} if names[0] == self.root.name else set()
        for e in self.all[1:]:
            if e.parent in matched and e.depth < len(names) and e.name == names[e.depth]:
                matched.add(e)
        return [e for e in self.elements if e in matched and e.high and e.depth == len(names) - 1]

    def extract(self, path: str | None) -> str:
        chosen = self.best((self.with_path(path) if path else []) or None)
        return "\n\n".join(block for _, block in self.blocks[chosen.low : chosen.high])


def host(url: Column) -> Column:
    found = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return F.coalesce(found, F.lit(""))


def page_votes(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """host, path, n: the path of each page's best container and the text under it."""

    @F.pandas_udf("path string, n bigint")
    def vote(sources: pd.Series) -> pd.DataFrame:
        rows = []
        for source in sources:
            page = Page(source)
            best = page.best()
            rows.append((best.path(), int(sum(page.unlinked[best.low : best.high]))))
        return pd.DataFrame(rows, columns=["path", "n"])

    votes = pages.select(host(F.col(url_col)).alias("host"), vote(F.coalesce(F.col(html_col), F.lit(""))).alias("v"))
    return votes.select("host", "v.path", "v.n")


def winning_paths(votes: DataFrame) -> DataFrame:
    """host, path: the path with most votes on each host."""
    counted = votes.where("n > 0").groupBy("host", "path").agg(F.count(F.lit(1)).alias("pages"), F.sum("n").alias("n"))
    order = Window.partitionBy("host").orderBy(F.col("pages").desc(), F.col("n").desc(), "path")
    return counted.withColumn("_rank", F.row_number().over(order)).where("_rank = 1").select("host", "path")


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars, path (the winning path of the host)."""
    paths = materialize(winning_paths(page_votes(pages, url_col, html_col)), "paths")

    @F.pandas_udf("string")
    def extract(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for sources, winners in batches:
            yield pd.Series([Page(s).extract(w) for s, w in zip(sources, winners)], dtype=object)

    source = pages.select(
        F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html")
    )
    side = paths.select(F.col("host").alias("_host"), "path")
    # One path per host: sent to all tasks if that is small, else a shuffle join that splits hot hosts.
    side = F.broadcast(side) if fits_broadcast(side) else side
    joined = source.join(side, host(F.col("url")) == F.col("_host"), "left")
    text = extract(F.col("html"), F.col("path"))
    out = joined.select("page_id", "url", text.alias("text"), "path")
    return out.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"), "path")
