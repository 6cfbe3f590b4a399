"""Main text of web pages: containers are scored per page, hosts vote on the path."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from retaloom.llm.common import stored

# Fixed values of HTML: elements without content, elements that start a block, elements
# whose start ends an open paragraph, elements that are never article text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption dd details dialog div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main nav ol p pre search section "
    "summary table tbody td tfoot th thead tr ul".split())
CLOSED_BY_OWN = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
                 "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
CONTAINERS = frozenset("article body div main section td".split())
NEVER = frozenset(
    "aside button canvas dialog embed footer form head header iframe input math menu nav noscript "
    "object script select style svg template textarea title".split())
ROLES = frozenset("alert banner complementary contentinfo dialog form navigation search".split())
# Words that mark what is not the article, where a class or id begins or ends with them.
NOISE_WORD = (
    r"(?:ads?|advert\w*|banner|breadcrumbs?|comments?|comment-?list|consent|cookies?|disqus|"
    r"footer|gdpr|header|menu|nav|navbar|navigation|newsletter|notices?|pagination|popup|promo\w*|"
    r"related|replies|reply|respond|share|sharing|sidebar|side|social|sponsor\w*|subscribe|tags|"
    r"toolbar|widget)\d*")
NOISE = re.compile(rf"{NOISE_WORD}(?:[-_].*)?|.*[-_]{NOISE_WORD}(?:[-_]?\d+)?", re.IGNORECASE | re.DOTALL)
# Names that tell how something is laid out or in which state, or the head of an article.
STATE = re.compile(
    r"(?:.*[-_])?(?:no|not|has|have|with|without|is|layout)[-_].*|"
    r".*[-_](?:open|opened|closed|enabled|disabled|active|visible|hidden|on|off|left|right|none)|"
    r"(?:entry|post|article|story|title|content|section)[-_]+header", re.IGNORECASE | re.DOTALL)


def is_noise(label: str) -> bool:
    """Whether one of the names in a class or id says that the element is not the article."""
    return any(NOISE.fullmatch(name) and not STATE.fullmatch(name) for name in label.split())


WORTH = 200  # characters of unlinked text from which an element by itself may be the article
ROOT = "#"  # step of what is in no container


class Page(HTMLParser):
    """Blocks of a page in order, each with the innermost container it is in.

    Containers know the one around them and the number of their path, a path is its last step and
    the path before it: nothing is copied along a nesting, so time and memory grow with the
    page alone, however deep it is nested and whatever is left open.
    """

    def __init__(self, spared: frozenset[int] | None = frozenset()) -> None:
        super().__init__(convert_charrefs=True)
        self.spared = spared  # start tags, by number, that are not left out; None: all names
        self.tags = 0
        self.soft: list[tuple[int, int]] = []  # open elements left out by name or as forms: depth, number
        self.hard = 0  # open elements left out for another reason
        self.left_out: dict[int, int] = {}  # start tag left out softly: its unlinked text
        self.around: dict[int, int | None] = {}  # the one of them around it
        self.forms: set[int] = set()
        self.holding: set[int] = set()  # those of them that hold an article or main
        self.plain = 0  # unlinked text that is not left out
        self.has_article = False
        self.open: list[tuple[str, int, bool, bool]] = []  # tag, path, unwanted, softly so
        self.at: dict[str, list[int]] = {}  # places of the open elements of a tag
        self.block_at: list[int] = []  # places of the open blocks
        self.unwanted = 0
        self.words: list[str] = []
        self.linked = self.in_link = 0
        self.blocks: list[tuple[int, str, int]] = []
        self.numbers: dict[tuple[int, str], int] = {(-1, ROOT): 0}  # path before it, step: path
        self.paths: list[tuple[int, str]] = [(-1, ROOT)]
        self.parent: list[int] = [-1]  # of each container, by number; the page itself is 0
        self.path: list[int] = [0]
        self.tag: list[str] = [ROOT]
        self.bad: list[bool] = [False]
        self.inside: list[int] = [0]

    # -- reading

    def _flush(self) -> None:
        text = " ".join("".join(self.words).split())
        if text:
            self.blocks.append((self.inside[-1], text, self.linked))
        self.words, self.linked = [], 0

    def _pop_to(self, depth: int) -> None:
        while len(self.open) > depth:
            tag, _, unwanted, soft = self.open.pop()
            self.at[tag].pop()
            self.unwanted -= unwanted
            if soft:
                self.soft.pop()
            elif unwanted:
                self.hard -= 1
            if tag in BLOCKS:
                self.block_at.pop()
                self._flush()
            if tag in CONTAINERS:
                self.inside.pop()
            self.in_link -= tag == "a"

    def _last_block(self) -> str | None:
        return self.open[self.block_at[-1]][0] if self.block_at else None

    def handle_starttag(self, tag: str, attrs) -> None:
        if tag in VOID:
            if tag == "hr":
                self._flush()
            elif tag == "br" and not self.unwanted:
                self.words.append(" ")
            return
        names = dict(attrs)
        if tag in BLOCKS:
            # A block ends an open paragraph, with whatever inline elements are left open in it.
            if self._last_block() == "p":
                self._pop_to(self.block_at[-1])
            self._flush()
        if tag in CLOSED_BY_OWN:
            if self._last_block() in CLOSED_BY_OWN[tag]:
                self._pop_to(self.block_at[-1])
            elif self.open and self.open[-1][0] in CLOSED_BY_OWN[tag]:
                self._pop_to(len(self.open) - 1)
        label = f"{names.get('class') or ''} {names.get('id') or ''}".strip()
        form = tag == "form"
        hard = (
            tag in NEVER and not form and not (tag == "header" and self.at.get("article"))
            or (names.get("role") or "").lower() in ROLES
            or "hidden" in names or names.get("aria-hidden") == "true")
        self.tags += 1
        by_name = bool(label and tag not in ("html", "body") and self.spared is not None and is_noise(label))
        soft = not hard and (form or by_name) and self.tags not in (self.spared or ())
        unwanted = hard or soft
        if tag in ("article", "main") and not unwanted and not self.hard:
            self.has_article = True
            if self.soft:
                self.holding.add(self.soft[-1][1])
        if soft:
            self.around[self.tags] = self.soft[-1][1] if self.soft else None
            self.soft.append((len(self.open), self.tags))
            self.left_out[self.tags] = 0
            if form:
                self.forms.add(self.tags)
        self.hard += hard
        before = self.open[-1][1] if self.open else 0
        if tag in BLOCKS:
            kind = re.sub(r"\d+", "#", ".".join(sorted((names.get("class") or "").lower().split()))).replace("/", "|")
            step = (before, f"{tag}.{kind}" if kind else tag)
            before = self.numbers.setdefault(step, len(self.paths))
            if before == len(self.paths):
                self.paths.append(step)
            self.block_at.append(len(self.open))
        self.at.setdefault(tag, []).append(len(self.open))
        self.open.append((tag, before, unwanted, soft))
        self.unwanted += unwanted
        self.in_link += tag == "a"
        if tag in CONTAINERS:
            self.parent.append(self.inside[-1])
            self.inside.append(len(self.path))
            self.path.append(before)
            self.tag.append(tag)
            self.bad.append(bool(self.unwanted))

    def handle_endtag(self, tag: str) -> None:
        places = self.at.get(tag)
        if places and (tag in BLOCKS or not self.block_at or places[-1] > self.block_at[-1]):
            self._pop_to(places[-1])

    def handle_data(self, data: str) -> None:
        if not self.unwanted:
            self.words.append(data)
            if self.in_link:
                self.linked += len(data)
            else:
                self.plain += len(data)
        elif self.soft and not self.hard and not self.in_link:
            self.left_out[self.soft[-1][1]] += len(data)

    @classmethod
    def read(cls, html: str) -> Page:
        """The page, with an element kept in spite of its name if it holds an article or main or,
        where the page has none, most of the text; without any regard to names if nothing
        would be left. A form is kept for the same reasons, but not for less text than ``WORTH``."""
        # A tag that the page's end cuts off is no text.
        html = re.sub(r"<[A-Za-z/!][^<>]*\Z", "", html)
        page = cls._parsed(html, frozenset())
        spared = set(page.holding)
        if not page.has_article and page.left_out:
            outer = page.plain + max(page.left_out.values())
            spared |= {k for k, size in page.left_out.items()
                       if 2 * size > outer and not (k in page.forms and size < WORTH)}
        if spared:
            page = cls._parsed(html, frozenset(spared))
        if not page.blocks and page.left_out:
            page = cls._parsed(html, None)
        return page

    @classmethod
    def _parsed(cls, html: str, spared: frozenset[int] | None) -> Page:
        page = cls(spared)
        page.feed(html)
        page.close()
        page._pop_to(0)
        page._flush()
        for number in sorted(page.left_out, reverse=True):  # inner ones first
            outer = page.around[number]
            if outer is not None:
                page.left_out[outer] += page.left_out[number]
                if number in page.holding:
                    page.holding.add(outer)
        page._add_up()
        return page

    # -- choosing

    def _add_up(self) -> None:
        """Per container the text without links: in its own blocks, in all, and halved for each
        container that is between."""
        count = len(self.path)
        self.own, self.full, self.halved = [0.0] * count, [0.0] * count, [0.0] * count
        for number, text, linked in self.blocks:
            self.own[number] += max(0.0, len(text) - 2.0 * linked)
        for number in range(count - 1, -1, -1):  # inner ones first
            self.full[number] += self.own[number]
            self.halved[number] += self.own[number]
            if number:
                outer = self.parent[number]
                self.full[outer] += self.full[number]
                self.halved[outer] += self.halved[number] / 2

    def name(self, path: int) -> str:
        steps = []
        while path > 0:
            path, step = self.paths[path]
            steps.append(step)
        return "/".join(reversed(steps)) or ROOT

    def number(self, name: str | None) -> int | None:
        """The path of a name, if the page has it."""
        if name is None:
            return None
        found = 0
        for step in name.split("/") if name != ROOT else ():
            if (found := self.numbers.get((found, step))) is None:
                return None
        return found

    def _within(self, tag: str) -> list[bool]:
        """Which containers are elements of the tag or lie in one."""
        out = [False] * len(self.path)
        for number in range(1, len(self.path)):
            out[number] = self.tag[number] == tag or out[self.parent[number]]
        return out

    def scores(self, among: list[bool] | None = None) -> dict[int, float]:
        """Text without links in the container's own blocks, by path.

        A block counts in full for its innermost container and for half as much in each
        one further out, so the container that holds the paragraphs wins, not the body.
        """
        found: dict[int, float] = {}
        for number, path in enumerate(self.path):
            if not self.bad[number] and self.halved[number] > 0 and (among is None or among[number]):
                found[path] = found.get(path, 0.0) + self.halved[number]
        return found

    def best(self) -> str | None:
        """The name of the path that the page itself would take."""
        path = self._best()
        return None if path is None else self.name(path)

    def _best(self) -> int | None:
        """The path with the highest score, raised to the container that holds the whole text.

        An article that stands out among the page's articles comes before all scores, and what
        is in a main before what is not: texts beside it, such as remarks of readers, may be longer
        together. Raised: the next one out is taken if it is an article or main, or has blocks
        with text without links of its own, or holds several containers of the path (sections, cells
        of a table). From an article it is only a main with such blocks. The body is taken
        if its own blocks have at least half as much text.
        """
        path = self._leading_article()
        if path is None:
            inner = self._within("main")
            inner_text = sum(v for v, n in zip(self.own, inner) if n)
            scores = self.scores(inner if self._counts(inner_text) else None)
            if not scores:
                return None
            path = min(scores, key=lambda p: (-scores[p], p))  # the first of equal ones
        held = self._held()
        while (outer := self._outer(path, held)) is not None:
            path = outer
        return path

    def _counts(self, text: float) -> bool:
        """Whether so much text may be the page's own: a teaser is shorter, unless all is short."""
        return text >= WORTH or 0 < self.full[0] <= 5 * text

    def _leading_article(self) -> int | None:
        outermost = [n for n in range(1, len(self.path)) if self.tag[n] == "article" and not self.bad[n]]
        nested = self._within("article")
        outermost = [n for n in outermost if not nested[self.parent[n]]]
        ranked = sorted(outermost, key=lambda n: -self.full[n])
        if not ranked or not self._counts(self.full[ranked[0]]):
            return None
        if len(ranked) > 1 and self.full[ranked[0]] < 2 * self.full[ranked[1]]:
            return None  # a list of articles
        return self.path[ranked[0]]

    def _held(self) -> dict[int, list[int]]:
        """Path: its containers with text."""
        out: dict[int, list[int]] = {}
        for number, path in enumerate(self.path):
            if not self.bad[number] and self.full[number] > 0:
                out.setdefault(path, []).append(number)
        return out

    def _outer(self, path: int, held: dict[int, list[int]]) -> int | None:
        own = held.get(path, [])
        if not own or self.tag[own[0]] in ("main", "body", ROOT):
            return None
        text = sum(self.full[n] for n in own)
        tag, parts = self.tag[own[0]], {}
        for number in own:
            parts.setdefault(self.parent[number], []).append(number)
        for number, inner in parts.items():
            if self.bad[number]:
                continue
            outer, more = self.tag[number], self.own[number]
            if outer in ("body", ROOT):
                raised = 2 * more >= text and tag != "article"
            elif tag == "article":
                raised = outer == "main" and more > 0
            else:
                raised = outer in ("article", "main") or more > 0 or len(inner) > 1
            if raised:
                return self.path[number]
        return None

    def _chosen(self, path: int | None) -> list[bool]:
        """Containers of the path and in them; of articles, not those far shorter than the longest."""
        mine = [n for n, p in enumerate(self.path) if p == path and not self.bad[n]]
        if mine and self.tag[mine[0]] == "article":
            longest = max(self.full[n] for n in mine)
            mine = [n for n in mine if 2 * self.full[n] >= longest]
        out = [False] * len(self.path)
        for n in mine:
            out[n] = True
        for n in range(1, len(out)):
            out[n] = out[n] or out[self.parent[n]]
        return out

    def unlinked(self, path: int | None) -> float:
        """Text without links under the containers of that path."""
        return sum(v for v, chosen in zip(self.own, self._chosen(path)) if chosen)

    def article(self, voted: str | None) -> str:
        """The text by the voted path, or by the page's own best one if that has clearly more."""
        own, path = self._best(), self.number(voted)
        if path is not None and (own is None or 2 * self.unlinked(path) >= self.unlinked(own)):
            return self.text(path)
        return self.text(own)

    def text(self, path: int | None) -> str:
        """The blocks under the containers of that path."""
        chosen = self._chosen(path)
        return "\n\n".join(t for n, t, _ in self.blocks if chosen[n])


def _rows(batch: pa.RecordBatch, column: str) -> list[str]:
    return [h or "" for h in batch.column(batch.schema.get_field_index(column)).to_pylist()]


def host_paths(pages: DataFrame) -> DataFrame:
    """host, path: the container path that its pages vote for.

    Every page gives its best path one vote, and its text there as the weight among equal
    votes; votes are summed before the shuffle, so a hot host is a few rows per task.
    """
    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for host, html in zip(batch.column(0).to_pylist(), _rows(batch, "html")):
                page = Page.read(html)
                path = page._best()
                if path is not None:
                    out.append((host, page.name(path), page.unlinked(path)))
            columns = list(zip(*out)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.float64()))],
                names=["host", "path", "score"])

    votes = pages.select("host", "html").mapInArrow(vote, "host string, path string, score double")
    summed = votes.groupBy("host", "path").agg(
        F.count(F.lit(1)).alias("n"), F.sum("score").alias("score"))
    best = Window.partitionBy("host").orderBy(F.desc("n"), F.desc("score"), "path")
    return summed.withColumn("r", F.row_number().over(best)).where("r = 1").select("host", "path")


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page, by its host's path.

    A page with no text there, or less than half of that of its own best path, uses its own. The host is taken from
    the url, in lower case, without port or user. The voted paths are stored first, so
    Spark knows their size when it plans the join.

    Cases: NULL or empty html gives the empty text; NULL urls share one (NULL) host; rows
    that repeat a page are extracted each. Further columns are neither read nor returned.
    """
    host = F.lower(F.regexp_extract(
        F.coalesce(F.col("url"), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    source = pages.select("page_id", "url", "html", host.alias("host"))
    paths = stored(host_paths(source), "paths")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for html, path in zip(_rows(batch, "html"), batch.column(3).to_pylist()):
                out.append(Page.read(html).article(path))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(out, pa.string()),
                 pa.array([len(t) for t in out], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    joined = source.join(paths, "host", "left").select("page_id", "url", "html", "path")
    kind = source.schema["page_id"].dataType.simpleString()
    return joined.mapInArrow(read, f"page_id {kind}, url string, text string, n_chars bigint")
