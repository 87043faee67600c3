"""Main text of web pages by consensus paths of their hosts (operator 2).

1. Each page is parsed, and its article text found: outside boilerplate (menus, headers, footers, sidebars, notices, adverts, forms,
   comments) and lists of links, what is in a container named as an article, what has a first heading, and what is no mere
   label (``LABEL`` characters in one container). A path is generalised: tag and class names with digits removed, from the root down.
2. A page votes for the path of the smallest container that holds all its article text. Spark sums the votes over the host, and the
   path with the most wins. Paths outside it that have no article text on more than half of the host's pages are furniture.
3. Each page is parsed again and its text taken from the containers at the winning path of its host; where article text outside of
   furniture is not in them, from the smallest container that holds all of that.

Defined results: a null page is empty and gives an empty text; so does one without any text outside boilerplate. A null or
odd URL belongs to the host ``""``. Truncated tags and unclosed elements are read as browsers do: an unclosed element ends
with its parent, a paragraph with the next block. Repeated rows and ids are pages of their own; they vote each. Ties go to the
deeper path, then the one that sorts first. Very long pages are read whole. An empty table gives no rows. Other columns,
whatever their names, are ignored.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections import defaultdict

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is not markup.
RAW = frozenset("script style textarea title noscript iframe noframes xmp template svg math".split())
#: Elements that start and end a block of text.
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html "
    "legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements that are never part of an article.
DROPPED = frozenset("nav header footer aside form button select option fieldset input label dialog menu head".split()) | RAW
#: Names (parts of class, id and role) that mark what is not part of an article.
BOILERPLATE = re.compile(
    r"^(ad|ads|adv|advert|advertisement|advertising|adbox|adsense|adslot|banner|sponsor|sponsored|promo|promoted|promotion|nav|navbar|navigation|navi|menu|menubar|breadcrumb|breadcrumbs|header|masthead|topbar|"
    r"footer|foot|bottombar|colophon|copyright|sidebar|side|aside|complementary|contentinfo|rail|widget|widgets|related|recommended|recommendations|comment|comments|commentlist|discussion|disqus|reply|replies|respond|response|responses|reaction|reactions|remark|remarks|talkback|talkbacks|guestbook|feedback|"
    r"cookie|cookies|consent|gdpr|notice|notices|notification|alert|popup|modal|overlay|newsletter|subscribe|subscription|signup|login|signin|register|form|search|searchbox|share|sharing|social|"
    r"pagination|pager|pagenav|skip|toolbar|tooltip|hidden|tags|tagcloud|byline|print)$"
)
GOOD = re.compile(r"^(article|main|content|post|entry|story|body|text|page|articlebody|maincontent|postcontent|entrycontent|articlecontent)$")
#: A name that begins so says what is not there, or is beside: with-sidebar, no-header.
MODIFIERS = frozenset("with without no not has".split())
#: Steps of a path after which a hash stands for those above, so that deep markup doesn't make long paths.
DEEP = 64
#: Less text than this in a container is a label, not an article, unless names or headings say otherwise.
LABEL = 40
#: Names of articles that whole pages have too.
WIDE = frozenset("page body".split())
CONTAINERS = frozenset("article main section div td body center blockquote".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
_LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"(?:^|[\s\"'])(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I | re.S)
_NAMES = re.compile(r"[^\W\d_]+")
#: A start tag that ends an open element of these kinds.
_ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_SCOPE = frozenset("ul ol dl table td th div article section main body html blockquote aside nav header footer form select".split())


def _boilerplate(words: list[str]) -> bool:
    return words[0] not in MODIFIERS and any(map(BOILERPLATE.match, words))


def _judge(values: list[str]) -> tuple[bool, bool]:
    """Whether the names of the attributes of an element mark boilerplate, and whether others of them mark an article.

    Where an attribute begins with a name of an article, and none with one of boilerplate, the rest are modifiers of that article.
    """
    attributes = [[w for name in v.split() if (w := _words(name))] for v in values]
    attributes = [a for a in attributes if a]
    bad = any(_boilerplate(w) for a in attributes for w in a)
    article = [[not _boilerplate(w) and bool(GOOD.match(w[-1])) for w in a] for a in attributes]
    first = any(a[0] for a in article) and not any(_boilerplate(a[0]) for a in attributes)
    return bad and not first, any(map(any, article))


def _words(value: str) -> list[str]:
    """Names of an attribute, lower case, camelCase and dashes apart, and each name joined."""
    out = []
    for name in value.split():
        parts = _NAMES.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", name))
        out += [p.lower() for p in parts] + (["".join(parts).lower()] if len(parts) > 1 else [])
    return out


class _Element:
    __slots__ = ("tag", "parent", "level", "path", "dropped", "link", "linked", "good", "heading", "blocks", "doubtful", "size")

    def __init__(self, tag: str, parent: _Element | None, names: list[str], dropped: bool, kind: str):
        self.tag, self.parent = tag, parent
        self.level = parent.level + 1 if parent else 0
        above = parent.path if parent else ""
        if self.level % DEEP == 0 and parent:
            above = "#" + hashlib.md5(above.encode()).hexdigest()
        self.path = (above + "/" if parent else "") + tag + (f".{kind}" if kind else "")
        self.dropped = dropped or bool(parent and parent.dropped)
        self.link = tag == "a" or bool(parent and parent.link)
        self.good = tag in ("article", "main") or tag not in ("html", "body") and any(GOOD.match(n) and n not in WIDE for n in names)
        self.linked = 0
        self.heading = self.doubtful = False
        self.size = 0


class Page:
    """The blocks of text of a page, each with the innermost container that holds it, outside of boilerplate."""

    def __init__(self, source: str):
        self.blocks: list[tuple[_Element, str]] = []
        self.containers: list[_Element] = []
        self._inline: list[str] = []
        self._named: list[tuple[_Element, bool]] = []  # containers that names mark as boilerplate; whether others mark an article
        self._articles: list[_Element] = []
        root = _Element("", None, [], False, "")
        self._top = root
        at, n = 0, len(source)
        while at < n:
            lt = source.find("<", at)
            if lt < 0:
                self._text(source[at:])
                break
            if lt > at:
                self._text(source[at:lt])
            m = _TOKEN.match(source, lt) or _LOOSE.match(source, lt)
            if m is None:
                self._text("<")
                at = lt + 1
                continue
            at = m.end()
            if not m.lastindex:  # a comment or declaration
                continue
            tag = m[2].lower()
            if m[1]:
                self._close(tag)
            else:
                self._open(tag, m[3])
                if tag in RAW and not m[3].endswith("/"):
                    end = re.compile(rf"</{re.escape(tag)}\s*(?:>|\Z)", re.I).search(source, at)
                    at = end.end() if end else n
                    self._close(tag)
        self._flush()
        if self._named:
            self._settle()

    def _settle(self) -> None:
        """Drops the containers whose names mark boilerplate, but for those that hold what no other part of the page does.

        One stays if names also mark an article and it has as much text as all containers of no such name together, and half of the
        largest one of its kind; or if it holds an article or main element and no other part of the page has one.
        """
        clear = 0
        for e, text in self.blocks:
            up, inside = e, False
            while up is not None:
                up.size += len(text)
                inside = inside or up.doubtful
                up = up.parent
            clear += 0 if inside else len(text)
        within: dict[_Element, int] = defaultdict(int)
        apart = False
        for e in self._articles:
            up, inside = e.parent, False
            while up is not None:
                within[up] += 1
                inside = inside or up.doubtful
                up = up.parent
            apart = apart or not inside
        most = max((e.size for e, article in self._named if article), default=0)
        for e, article in self._named:
            if article and e.size >= max(clear, most / 2) or not apart and within[e]:
                e.doubtful = False
        lost: dict[_Element, bool] = {}

        def gone(e: _Element) -> bool:
            chain = []
            while e is not None and e not in lost:
                chain.append(e)
                e = e.parent
            out = lost[e] if e is not None else False
            for x in reversed(chain):
                out = lost[x] = out or x.doubtful
            return out

        self.blocks = [b for b in self.blocks if not gone(b[0])]
        self.containers = [c for c in self.containers if not gone(c)]

    def _text(self, text: str) -> None:
        top = self._top
        if not top.dropped:
            self._inline.append(text)
            if top.link:
                top.linked += len(text)

    def _flush(self) -> None:
        if self._inline:
            text = " ".join(entities.unescape("".join(self._inline)).split())
            self._inline = []
            if text:
                self.blocks.append((self._top, text))

    def _open(self, tag: str, attributes: str) -> None:
        if tag in BLOCKS:
            self._flush()
            self._end(("p",), tag)
            for k in ("h1", "h2", "h3", "h4", "h5", "h6"):
                if self._top.tag == k:
                    self._top = self._top.parent
        if tag in _ENDS:
            self._end(_ENDS[tag], tag)
        if tag in VOID:
            if tag == "br" and not self._top.dropped:
                self._inline.append(" ")
            return
        names, values, kind, hidden = [], [], "", False
        if attributes and not attributes.isspace():
            for m in _ATTRIBUTE.finditer(attributes):
                key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
                if key in ("class", "id", "role"):
                    words = _words(entities.unescape(value))
                    if key != "id" or tag not in ("h1", "h2", "h3", "h4", "h5", "h6"):  # a heading's id is made of its text
                        names += words
                        values.append(entities.unescape(value))
                    if key == "class" and not kind:
                        kind = ".".join(sorted(set(words)))
                elif key == "hidden" or key == "aria-hidden" and value.lower() == "true" or key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                    hidden = True
        dropped = tag in DROPPED or hidden
        if not dropped and tag not in ("html", "body", "article", "main") and names:
            marked, article = _judge(values)
            dropped = marked and not (any(map(GOOD.match, names)) and tag in ("h1", "h2", "p"))
        doubtful = dropped and tag in CONTAINERS and tag not in DROPPED and not hidden
        heading = dropped and tag == "header" and self._inside("article")
        e = _Element(tag, self._top, [w[-1] for v in values for name in v.split() if (w := _words(name))], dropped and not heading and not doubtful, kind)
        e.heading = heading or self._top.heading
        if e.heading and tag not in ("h1", "h2", "h3", "header", "hgroup", "b", "i", "em", "strong", "span", "a") and not self._heading_above():
            e.dropped = True
        self._top = e
        if tag in CONTAINERS and not e.dropped:
            self.containers.append(e)
            if doubtful:
                e.doubtful = True
                self._named.append((e, article))
            elif tag in ("article", "main") and not _judge(values)[0]:
                self._articles.append(e)

    def _heading_above(self) -> bool:
        e = self._top
        while e is not None and e.heading:
            if e.tag in ("h1", "h2", "h3"):
                return True
            e = e.parent
        return False

    def _inside(self, tag: str) -> bool:
        e = self._top
        while e is not None:
            if e.tag == tag:
                return True
            e = e.parent
        return False

    def _end(self, tags: tuple, new: str) -> None:
        """Closes the nearest open element of ``tags`` that is not beyond an enclosing scope."""
        e = self._top
        while e.parent is not None and (e.tag not in _SCOPE or e.tag in tags):
            if e.tag in tags:
                self._flush()
                self._top = e.parent
                return
            e = e.parent

    def _close(self, tag: str) -> None:
        e = self._top
        while e is not None and e.tag != tag:
            if e.tag in ("td", "th", "table", "article", "main", "body") and tag not in BLOCKS:
                return  # a stray inline end tag
            e = e.parent
        if e is None or e.parent is None:
            if tag == "p":
                self._flush()
            return
        if tag in BLOCKS:
            self._flush()
        self._top = e.parent

    def places(self) -> dict[_Element, int]:
        """The containers that hold article text directly, with its length, less what is in links twice over."""
        own: dict[_Element, int] = defaultdict(int)
        for e, text in self.blocks:
            own[e] += len(text)
        length: dict[_Element, int] = defaultdict(int)
        heads: set[_Element] = set()
        for e, n in own.items():
            c, head = e, False
            while c.parent is not None and c.tag not in CONTAINERS:
                head = head or c.tag == "h1"
                c = c.parent
            n -= 2 * min(n, e.linked)
            if n > 0:
                length[c] += n
                if head:
                    heads.add(c)
        found = {c: n for c, n in length.items() if n >= LABEL or c in heads or self._above(c, lambda e: e.good)}
        return found or dict(length)

    @staticmethod
    def _above(e: _Element | None, test) -> bool:
        while e is not None:
            if test(e):
                return True
            e = e.parent
        return False

    @staticmethod
    def _totals(places: dict[_Element, int]) -> dict[str, int]:
        """The article text at and below each path."""
        out: dict[str, int] = defaultdict(int)
        for c, n in places.items():
            while c is not None:
                if c.parent is None or c.tag in CONTAINERS:
                    out[c.path] += n
                c = c.parent
        return out

    @staticmethod
    def _smallest(totals: dict[str, int]) -> str:
        whole = max(totals.values())
        return max((path for path, n in totals.items() if n == whole), key=lambda p: (p.count("/"), p))

    def votes(self) -> list[tuple[str, int, int]]:
        """Of each path of this page, whether it is the page's vote, and whether it has no article text."""
        totals = self._totals(self.places())
        if not totals:
            return []
        best = self._smallest(totals)
        return [(path, int(path == best), int(path not in totals)) for path in {best, *(c.path for c in self.containers)}]

    def extract(self, path: str | None, furniture: list[str] | None = None) -> str:
        """The text at ``path``, or of the smallest container with all article text, or of the whole page if it has no container."""
        places = self.places()
        if not self.containers or not places:
            return "\n".join(text for e, text in self.blocks if not e.link)
        spare = frozenset(furniture or ())
        kept = {c: n for c, n in places.items() if not spare or not self._above(c, lambda e: e.path in spare)}
        totals = self._totals(kept or places)
        chosen = path if path is not None and totals.get(path, 0) == max(totals.values()) else self._smallest(totals)
        inside: dict[_Element, bool] = {}

        def holds(e: _Element | None) -> bool:
            chain = []
            while e is not None and e not in inside:
                chain.append(e)
                e = e.parent
            out = inside[e] if e is not None else False
            for x in reversed(chain):
                out = inside[x] = out or x.path == chosen and (x.parent is None or x.tag in CONTAINERS)
            return out

        return "\n".join(text for e, text in self.blocks if holds(e))


def host(url: Column) -> Column:
    """The lower-case host of a URL without its port; empty if there is none."""
    found = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.coalesce(F.lower(found), F.lit(""))


def consensus(pages: DataFrame) -> DataFrame:
    """host, the winning path of each host, and the paths of its furniture."""
    from .common import materialise

    def run(batches):
        for batch in batches:
            sums: dict[tuple[str, str], list[int]] = defaultdict(lambda: [0, 0])
            for h, source in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for path, vote, bare in Page(source or "").votes():
                    own = sums[h, path]
                    own[0] += vote
                    own[1] += bare
            if sums:
                columns = [pa.array([k[0] for k in sums]), pa.array([k[1] for k in sums]), *(pa.array([v[i] for v in sums.values()], pa.int64()) for i in (0, 1))]
                yield pa.RecordBatch.from_arrays(columns, ["host", "path", "votes", "bare"])

    votes = pages.select(host(F.col("url")).alias("host"), "html").mapInArrow(run, "host string, path string, votes bigint, bare bigint")
    votes = materialise(votes.groupBy("host", "path").agg(F.sum("votes").alias("votes"), F.sum("bare").alias("bare")), "votes")
    depth = F.length("path") - F.length(F.replace(F.col("path"), F.lit("/"), F.lit("")))
    best = votes.groupBy("host").agg(F.max(F.struct("votes", depth.alias("depth"), "path")).alias("best"), F.sum("votes").alias("pages"))
    best = materialise(best.select("host", F.col("best.path").alias("won"), "pages"), "best")
    # of at most twice as many paths as a page has: each is on more than half of the pages
    apart = ~F.startswith(F.concat("won", F.lit("/")), F.concat("path", F.lit("/"))) & ~F.startswith(F.concat("path", F.lit("/")), F.concat("won", F.lit("/")))
    spare = votes.join(best, "host").where((2 * F.col("bare") > F.col("pages")) & apart).groupBy("host").agg(F.collect_list("path").alias("furniture"))
    return best.join(spare, "host", "left").select("host", F.col("won").alias("path"), "furniture")


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    from .common import materialise

    winners = materialise(consensus(pages), "paths")  # both sides of the join are then plain exchanges, whose hot keys can be split
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", "html").withColumn("host", host(F.col("url")))
    rows = rows.join(winners, "host", "left").select("page_id", "url", "html", "path", "furniture")

    def run(batches):
        for batch in batches:
            texts = [Page(source or "").extract(path, furniture) for source, path, furniture in zip(*(c.to_pylist() for c in batch.columns[2:]))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], ["page_id", "url", "text", "n_chars"])

    return rows.mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")
