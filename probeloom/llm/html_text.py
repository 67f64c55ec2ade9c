"""Main text of web pages by consensus of the pages of a host."""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import materialize
from ..spread import spread_join
from .common import read, slices

#: The winning paths of all hosts are broadcast up to this size; beyond it, those of hosts with very many pages.
BROADCAST_BYTES = 32 << 20

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.S | re.I,
)
#: Elements that go with all they hold. The second kind holds markup, so one that is never closed is taken as empty.
_RAW_TEXT = frozenset("script style iframe textarea title".split())
_RAW = _RAW_TEXT | frozenset("noscript template object svg math select".split())
_RAW_END = {t: re.compile(rf"</{t}(?![^\s/>])[^>]*(?:>|\Z)", re.I) for t in _RAW}
_SELF_CLOSED = re.compile(r"(?:^|[\s\"'])/\s*$")
_ATTR = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that hold other blocks: the candidates for the main text.
_CONTAINERS = frozenset("html body main article section div td center blockquote".split())
_JUNK_TAGS = frozenset("nav footer aside form button menu dialog fieldset audio video canvas map".split())
_JUNK_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar form toolbar".split())
#: Words in class and id attributes that name what isn't part of an article: parts of a class, unless a word before them
#: says that they describe something else, and words that count as whole classes only.
_JUNK_WORDS = re.compile(
    r"(?:^|(?<=[\s_-]))(?<!\bhas[_-])(?<!\bhave[_-])(?<!\bno[_-])(?<!\bnot[_-])(?<!\bwith[_-])(?<!\bwithout[_-])(?<!\bin[_-])(?:(?P<header>headers?)"
    r"|ads?|adverts?|advertisements?|adsense|adslot|banners?|sponsor(?:ed|s)?|promo(?:tion|s)?|cookies?|consent|gdpr|notices?|alerts?|popups?|modals?|overlays?"
    r"|nav|navbar|navigation|menus?|breadcrumbs?|sidebars?|widgets?|footers?|masthead|topbar|toolbar|share|sharing|social|follow|related|recommend(?:ed|ations?)?|teasers?"
    r"|newsletters?|subscri(?:be|ption)|signup|login|search|pag(?:er|ination)|comments?|commentlist|respond|replies|disqus|(?P<discussion>discussion)|copyright|legal|byline|meta"
    r"|(?<!\S)(?:side|rail|foot|more|tags|reply|skip|hidden|is-hidden|print)(?!\S))(?=$|[\s_-])",
    re.I,
)
#: Words that a paragraph of an article may well have.
_MILD = frozenset("notice notices alert alerts promo promos promotion banner banners teaser teasers widget widgets related recommended recommendation recommendations legal more print follow social overlay consent discussion header headers search".split())
#: Links that only lead past the menus.
_SKIPS = re.compile(r"(?<!\S)skip(?:[_-]?(?:link|nav|to)\S*)?(?!\S)", re.I)
#: Whole classes and ids of what readers wrote: it may be longer than the article.
_REPLIES = re.compile(
    r"(?<!\S)(?:(?!(?:has|have|no|not|with|without|in|show|hide|open|allow)[_-])\w+[_-])?comments?(?:[_-]?(?:list|area|section|thread|wrap|wrapper|container|box|block|feed|body|item|entry|content|\d+))?(?!\S)"
    r"|(?<!\S)(?:commentlist|disqus(?:[_-]thread)?|respond|replies|reply)(?!\S)",
    re.I,
)
#: Whole classes and ids that leave no doubt: such an element stays only for an article, main or h1 inside.
_SURE = re.compile(
    r"(?<!\S)(?:ads?|adverts?|advertisements?|adsense|ads?[_-]?(?:slot|box|container|wrapper|banner|unit)|banners?|sponsor(?:ed|s)?|promo(?:tion|s)?|(?:cookies?|consent|gdpr)(?:[_-]\S+)?|popups?|modals?"
    r"|nav|navbar|navigation|menus?|breadcrumbs?|sidebars?|footers?|masthead|topbar|toolbar|share|sharing|newsletters?|subscri(?:be|ption)|signup|login|pagination|copyright)(?!\S)",
    re.I,
)
#: A header by such a name is the article's own, and its headings stay.
_OF_ARTICLE = re.compile(r"(?:^|[\s_-])(?:entry|post|article|story|content)[_-]", re.I)
#: What is junk by its tag or by other words stays if all that goes by it holds more than this share of the page's text outside links.
_MOST, _MOST_WITH_ARTICLE = 0.5, 0.2
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())


def _below(path: str, segment: str) -> str:
    """The path of a container inside another; of a long path the part so far is hashed, so that deep pages stay small."""
    if len(path) > 512:
        path = "#" + hashlib.blake2b(path.encode(errors="surrogatepass"), digest_size=16).hexdigest()
    return f"{path}/{segment[:512]}"


class _Doubtful:
    """An element that may go by its tag, role or state, or by a word in its class or id; all are judged when the page is read.

    past: stands for what follows the beginning of an article inside such an element. If the element is never closed,
    it ended there.
    """

    __slots__ = ("after", "before", "closed", "first", "goes", "key", "kind", "mild", "mine", "open_in", "open_past", "outer", "replied", "replies", "sure")

    def __init__(self, outer: _Doubtful | None, key: str, kind: str):
        self.outer, self.key, self.kind = outer, key, kind  # kind: tag, word or past
        self.replies = self.sure = self.mine = self.mild = self.replied = self.goes = self.closed = False
        self.first = True  # no other of its key around it
        #: text outside links; an article, main or h1; main or h1: until an article begins inside, and from there on
        self.before, self.after = [0, False, False], [0, False, False]

    def holds(self) -> list[int]:
        return [x + y if self.closed else x for x, y in zip(self.before, self.after, strict=True)]


class _Page:
    """Blocks of text of a page in order, and its containers' paths; one pass over the tags, then one over the doubtful elements."""

    def __init__(self, source: str):
        self.paths: list[str] = [""]  # of containers; the first stands for the page
        self.tags: list[str] = [""]
        self.parents: list[int] = [-1]
        self.blocks: list[tuple[int, str, int]] = []  # container, text, characters inside links
        self._flagged: dict[int, int] = {}  # by container: characters left out as junk
        self._doubtful: list[_Doubtful] = []
        self._marks: list[tuple[_Doubtful | None, bool, bool]] = []  # by block: the innermost of them around it, heading or paragraph, in an article
        self._within: _Doubtful | None = None
        self._lead = False
        self._text: list[str] = []
        self._linked = 0
        self._container = self._junk = 0  # junk: depth of inline elements that go
        self._stack: list[tuple[str, int, int, _Doubtful | None, _Doubtful | None]] = []  # tag, container, junk and doubtful before it, its own
        self._places: dict[str, list[int]] = {}  # by tag: where it is open on the stack
        self._walls: list[int] = []  # where blocks other than paragraphs are open
        self._keys: dict[str, int] = {}  # of open doubtful elements
        link = at = 0
        unclosed: set[str] = set()
        while m := _TOKEN.search(source, at):
            if m.start() > at:
                if not self._junk:
                    self._add(source[at : m.start()], link)
                else:
                    self._flag(self._container, len(source[at : m.start()].strip()))
            at = m.end()
            tag = m["tag"]
            if tag is None:
                continue
            tag = tag.lower()
            if tag == "br" or tag == "wbr":
                self._text.append("\n" if tag == "br" else "")
                continue
            if m["end"]:
                if tag == "a":
                    link = max(0, link - 1)
                open_at = self._places.get(tag)
                if tag in _INLINE:
                    # closes its own start if that was kept, but no block around it
                    if open_at and open_at[-1] > (self._walls[-1] if self._walls else -1):
                        if (p := self._places.get("p")) and p[-1] > open_at[-1]:
                            self._flush()
                        self._close(open_at[-1])
                    continue
                if tag == "head" or tag in _RAW:
                    continue
                self._flush()
                self._lead = False
                if open_at:
                    if own := self._stack[open_at[-1]][4]:
                        own.closed = True
                    self._close(open_at[-1])
                    link = 0
                continue
            attrs = m["attrs"]
            if tag == "a":
                link += 1
            if tag in _RAW:
                if tag not in unclosed and not _SELF_CLOSED.search(attrs):
                    end = _RAW_END[tag].search(source, at)
                    if end:
                        at = end.end()
                    elif tag in _RAW_TEXT:
                        at = len(source)
                    else:
                        unclosed.add(tag)
                continue
            if tag == "head":  # of what it may hold only raw elements have text
                continue
            if tag in _INLINE:
                # one that goes is kept on the stack until its end, and so are others of its name inside it
                found = bool(attrs) and bool(self._is_junk(tag, attrs) or (self._skips(attrs) if tag == "a" else self._is_named(tag, attrs)))
                if (found or self._places.get(tag)) and not _SELF_CLOSED.search(attrs):
                    self._open(tag, self._within)
                    self._junk += found
                continue
            self._flush()
            self._lead = False
            if tag in _VOID:
                continue
            if tag in ("p", *_HEADINGS, "li"):  # these end a paragraph that was left open
                if tag != "li" and (p := self._places.get("p")) and p[-1] > (self._walls[-1] if self._walls else -1):
                    self._close(p[-1])
                link = 0
                self._lead = tag != "li"
            self._begin(tag, attrs)
        if at < len(source) and not self._junk:
            self._add(source[at:], link)
        self._flush()
        self._drop_doubtful()

    def _open(self, tag: str, before: _Doubtful | None, own: _Doubtful | None = None) -> None:
        """before: what is around once the element has ended."""
        self._places.setdefault(tag, []).append(len(self._stack))
        if tag != "p" and tag not in _INLINE:
            self._walls.append(len(self._stack))
        if own:
            own.first = not self._keys.get(own.key)
            self._keys[own.key] = self._keys.get(own.key, 0) + 1
            self._doubtful.append(own)
            self._within = own
        self._stack.append((tag, self._container, self._junk, before, own))

    def _close(self, place: int) -> None:
        """The element at a place of the stack ends, and all that is still open in it."""
        while len(self._stack) > place:
            tag, self._container, self._junk, self._within, own = self._stack.pop()
            self._places[tag].pop()
            if self._walls and self._walls[-1] == len(self._stack):
                self._walls.pop()
            if own:
                self._keys[own.key] -= 1

    def _begin(self, tag: str, attrs: str) -> None:
        """A block element opens."""
        inside = bool(self._places.get("article") or self._places.get("main"))
        own = None
        if tag == "header":
            own = _Doubtful(self._within, tag, "tag")
            own.mine = inside
        elif why := self._is_junk(tag, attrs):
            own = _Doubtful(self._within, why, "tag")
        elif named := self._is_named(tag, attrs):
            word = _JUNK_WORDS.search(named) or _REPLIES.search(named)
            key = word[0].lower()
            if not (inside and tag == "p" and key in _MILD):
                own = _Doubtful(self._within, key, "word")
                own.replies, own.sure = bool(_REPLIES.search(named)), bool(_SURE.search(named))
                header = word.re is _JUNK_WORDS and word["header"]
                own.mine = bool(header) and (inside or bool(_OF_ARTICLE.search(named)))
                own.mild = inside and key == "discussion"
        before = self._within
        if tag in ("article", "main", "h1") and self._within and not own:
            if tag != "h1":
                before = _Doubtful(self._within, "", "past")
                self._doubtful.append(before)
                self._within = before
            self._within.before[1] = True
            self._within.before[2] |= tag != "article"
        self._open(tag, before, own)
        if own and own.replies and own.outer:
            own.outer.replied = True
        if tag in _CONTAINERS:
            self.parents.append(self._container)
            self.tags.append(tag)
            self.paths.append(_below(self.paths[self._container], f"{tag}{self._classes(attrs)}"))
            self._container = len(self.paths) - 1

    def _add(self, text: str, link: int) -> None:
        self._text.append(text)
        if link:
            self._linked += len(text)

    def _flag(self, container: int, n: int) -> None:
        self._flagged[container] = self._flagged.get(container, 0) + n

    def _flush(self) -> None:
        if self._text:
            text = " ".join(html.unescape("".join(self._text)).split())
            if text:
                self.blocks.append((self._container, text, min(self._linked, len(text))))
                self._marks.append((self._within, self._lead, bool(self._places.get("article") or self._places.get("main"))))
            self._text = []
        self._linked = 0

    def _drop_doubtful(self) -> None:
        """Of the doubtful elements drop those that can't hold the article: sizes go up the tree once, decisions down once.

        An element by its tag, role or state stays only if no article or main with text is outside all of these, and if
        it has most of the page's text, or an article and a good part of it.
        """
        if not self._doubtful:
            return
        unlinked = [len(text) - linked for _, text, linked in self.blocks]
        for (x, _, _), n in zip(self._marks, unlinked, strict=True):
            if x:
                x.before[0] += n
        for x in reversed(self._doubtful):
            if up := x.outer:
                for i in range(3):
                    if x.kind == "past":
                        up.after[i] += x.before[i] + x.after[i]
                    else:
                        up.before[i] += x.before[i]
                        up.after[i] += x.after[i]
                up.replied |= x.replied
        self._down(lambda x: x.replies or (x.kind == "tag" and not x.mine))
        elsewhere = any(n and article and (x is None or x.open_in[0]) for (x, _, article), n in zip(self._marks, unlinked, strict=True))
        like: dict[str, int] = {}
        for x in self._doubtful:
            if x.first and x.kind != "past":
                like[x.key] = like.get(x.key, 0) + x.holds()[0]
        page = max(sum(unlinked), 1)
        for x in self._doubtful:
            if x.kind == "past":
                continue
            _, core, main = x.holds()
            small = like.get(x.key, 0) <= page * (_MOST_WITH_ARTICLE if core else _MOST)
            if x.kind == "tag":
                x.goes = x.sure = x.mine or elsewhere or small
            elif x.mild:
                x.goes = x.replied
            else:
                x.sure = not main if x.replies else x.sure and not core
                x.goes = x.sure or small

        def left(goes: Callable[[_Doubtful], bool]) -> list[bool]:
            self._down(goes)
            return [x is None or x.open_in[lead] for x, lead, _ in self._marks]

        stays = left(lambda x: x.goes)
        if not any(s and n for s, n in zip(stays, unlinked, strict=True)):  # the page would be empty
            stays = left(lambda x: x.sure)
        for (container, text, _), s in zip(self.blocks, stays, strict=True):
            if not s:
                self._flag(container, len(text))
        self.blocks = [b for b, s in zip(self.blocks, stays, strict=True) if s]

    def _down(self, goes: Callable[[_Doubtful], bool]) -> None:
        """open_in: whether text, and headings or paragraphs, directly inside an element stay; of an article's own header the latter do.

        open_past: the same if only elements that are closed count, for what follows the beginning of an article.
        """
        for x in self._doubtful:
            inside, past = (x.outer.open_in, x.outer.open_past) if x.outer else ((True, True), (True, True))
            if x.kind == "past":
                x.open_in = x.open_past = past
            elif goes(x):
                x.open_in = (False, inside[1] and x.mine)
                x.open_past = (False, past[1] and x.mine) if x.closed else past
            else:
                x.open_in, x.open_past = inside, past

    @staticmethod
    def _attributes(attrs: str) -> dict[str, str]:
        return {k.lower(): a or b or c for k, a, b, c in _ATTR.findall(attrs)} if attrs.strip() else {}

    def _is_junk(self, tag: str, attrs: str) -> str:
        """By what an element goes: its tag, role or state, or nothing."""
        if tag in _JUNK_TAGS:
            return tag
        found = self._attributes(attrs)
        if not found or tag in ("html", "body", "article", "main"):
            return ""
        styled = found.get("style", "").replace(" ", "").lower()
        if "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in styled:
            return "hidden"
        role = found.get("role", "").lower()
        return f"role {role}" if role in _JUNK_ROLES else ""

    def _is_named(self, tag: str, attrs: str) -> str:
        """The class and id of an element if a word in them says that it isn't part of an article; of articles themselves, that readers wrote them."""
        found = self._attributes(attrs)
        if not found or tag in ("html", "body", "main", *_HEADINGS):
            return ""
        named = f"{found.get('class', '')} {found.get('id', '')}".strip()
        if tag == "article":
            return named if named and _REPLIES.search(named) else ""
        return named if named and (_JUNK_WORDS.search(named) or _REPLIES.search(named)) else ""

    def _skips(self, attrs: str) -> bool:
        return bool(_SKIPS.search(self._attributes(attrs).get("class", "")))

    def _classes(self, attrs: str) -> str:
        """The element's classes without numbers, so that pages made from one template agree."""
        named = self._attributes(attrs).get("class", "")
        return "".join(f".{x}" for x in sorted(set(re.sub(r"\d+", "#", named.lower()).split())))

    def scores(self) -> dict[str, int]:
        """By path: text outside links, in full for the container around it and by half for each one further out."""
        own = [0.0] * len(self.paths)
        for container, text, linked in self.blocks:
            weight = float(max(0, len(text) - 2 * linked))
            while container > 0 and weight >= 1:
                own[container] += weight
                container, weight = self.parents[container], weight / 2
        out: dict[str, float] = {}
        for path, x in zip(self.paths, own, strict=True):
            out[path] = max(out.get(path, 0.0), x)
        whole = sum(out.values())
        return {p: round(1000 * x / whole) for p, x in out.items() if x > 0} if whole else {}

    def _widened(self, start: int, gain: list[int]) -> int:
        """The article or main around a container, and further out while that adds mostly text, not links or junk.

        gain: by container, text outside links less the rest below it. Without an article or main all the page's
        containers are open to it, otherwise those up to the main.
        """
        outer = [start]
        while (up := self.parents[outer[-1]]) > 0:
            outer.append(up)
        tags = [self.tags[i] for i in outer]
        marks = [k for k, tag in enumerate(tags) if tag in ("article", "main")]
        best = marks[0] if marks else 0
        last = (tags.index("main") if "main" in tags else best) if marks else len(outer) - 1
        for k in range(best + 1, last + 1):
            if gain[outer[k]] > gain[outer[best]]:
                best = k
        return outer[best]

    def text(self, path: str | None) -> str:
        """The blocks below the path, widened to the whole article; below the page's own best container if it has no such path."""
        if path is None or path not in self.paths:
            votes = self.scores()
            path = min(votes, key=lambda p: (-votes[p], len(p), p)) if votes else ""
        gain = [0] * len(self.paths)
        for container, text, linked in self.blocks:
            gain[container] += len(text) - 2 * linked
        for container, n in self._flagged.items():
            gain[container] -= n
        for i in range(len(gain) - 1, 0, -1):
            gain[self.parents[i]] += gain[i]
        chosen = {self._widened(i, gain) if i else 0 for i, p in enumerate(self.paths) if p == path}
        inside = [i in chosen for i in range(len(self.paths))]
        for i, parent in enumerate(self.parents):
            inside[i] = inside[i] or (parent >= 0 and inside[parent])
        return "\n\n".join(text for container, text, _ in self.blocks if inside[container])


def host_of(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "html"):
        hosts, paths, votes = [], [], []
        for host, source in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
            for path, score in _Page(source or "").scores().items():
                hosts.append(host)
                paths.append(path)
                votes.append(score)
        yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(paths, pa.string()), pa.array(votes, pa.int64())], names=["host", "path", "votes"])


def host_paths(pages: DataFrame) -> DataFrame:
    """host, path and pages: the container path that a host's pages agree on, and about how many they are.

    Every page splits 1000 votes over its containers by score; paths drop numbers in classes. Ties go to the shorter
    path, then to the lesser. Hosts without any text have no row.
    """
    votes = pages.mapInArrow(_votes, "host string, path string, votes long").groupBy("host", "path").agg(F.sum("votes").alias("votes"))
    best = votes.groupBy("host").agg(F.min(F.struct((-F.col("votes")).alias("v"), F.length("path").alias("n"), "path")).alias("best"), F.sum("votes").alias("whole"))
    return best.select("host", F.col("best.path").alias("path"), F.ceil(F.col("whole") / 1000).alias("pages"))


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "html"):
        texts = [_Page(source or "").text(path) for source, path in zip(batch.column("html").to_pylist(), batch.column("path").to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])


def extract_main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars for each row of pages (page_id, url, html).

    text: the blocks of the host's winning container and of the article around it, white space in a block as one space, blocks joined by an empty
    line. Navigation, page headers, footers, asides, adverts, notices, forms, scripts and comments are left out by tag,
    role, class or id. Null and empty html give an empty text; a null url is a host of its own; rows that repeat a
    page_id are extracted each. Other columns are ignored.
    """
    rows = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host"))
    winners = materialize(host_paths(rows.select("host", "html")), "winners")
    size = winners.agg(F.coalesce(F.sum(F.octet_length("host") + F.octet_length("path") + 32), F.lit(0))).first()[0]
    if size <= BROADCAST_BYTES:
        joined = rows.join(F.broadcast(winners.drop("pages")), "host", "left")
    else:
        joined = spread_join(rows, winners, ["host"], "pages", "left")
    return joined.select("page_id", "url", "html", "path").mapInArrow(_texts, "page_id long, url string, text string, n_chars long")


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(read(spark, sf_dir, "pages"))
