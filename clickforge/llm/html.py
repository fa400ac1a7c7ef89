"""HTML extraction by consensus: containers are scored per page, hosts vote on paths, pages are read again by the winners.

A page becomes a tree of elements. Each element that holds text is a container with a path of tags and generalised classes (digits
become ``#``), and a score: characters of text outside links, less what stands in links. Spark adds the scores up by host and path,
so that the path that carries the articles of most pages wins over what is long on one page only. A page is then cut to the
elements at its host's winning path; where it has none, to its own best container, and where no container scores above 0 either, it
stays whole.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickforge.llm.common import BROADCAST_IDS, broadcast_within, stored

#: Fixed lists: elements whose text is never of the article, void elements, blocks, and elements that close an open one of their kind.
SKIPPED = frozenset("script style noscript template svg math head title nav header footer aside form button select option textarea input iframe object canvas dialog menu".split())
RAW = frozenset("script style textarea title noscript iframe".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li "
    "main nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
CLOSES_P = BLOCKS - {"body", "html"}
SELF_CLOSING = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
LISTS = ("ul", "ol", "dl", "table")
CONTAINERS = frozenset("article main section div td body".split())
#: Words of class, id or role that mark what is no part of the article.
NOISE = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|cookie\w*|consent|notice\w*|alert|popup|modal|nav\w*|menu\w*|breadcrumb\w*|sidebar|side|aside|"
    r"foot\w*|head(?:er)?|masthead|comment\w*|disqus|repl(?:y|ies)|respond|related|recommend\w*|share|sharing|social|subscribe|newsletter|signup|login|search|"
    r"widget\w*|pagination|pager|toolbar|legal|copyright|contentinfo|complementary|navigation|hidden)(?:$|[\s_-])", re.IGNORECASE)
NAME = re.compile(r"[A-Za-z][^\s/>]*")
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
STOP = re.compile(r"[>\"']")


class _Scanner:
    """The marks of a page, each character looked at a fixed number of times.

    A mark that nothing ends is remembered: where no ``>`` is ahead, the rest has no tags, and once quotes have swallowed the rest of a
    page, its tags end at the first ``>`` whether quoted or not.
    """

    def __init__(self, page: str):
        self.page = page
        self.quoted = True
        self.closing = {'"': True, "'": True}
        self.raw: dict[str, re.Pattern] = {}

    def __iter__(self) -> Iterator[tuple[str, str, str]]:
        """(kind, name, rest) in page order: data with its text as rest, start tags with their attributes, end tags."""
        page, at, size = self.page, 0, len(self.page)
        begin = 0  # of the data at hand
        while (at := page.find("<", at)) >= 0:
            after = page[at + 1: at + 2]
            if page.startswith("<!--", at):
                stop, kind, name, rest = self._past("-->", at + 4), "", "", ""
            elif page.startswith("<![CDATA[", at):
                stop, kind, name, rest = self._past("]]>", at + 9), "", "", ""
            elif after in ("!", "?"):
                stop, kind, name, rest = self._past(">", at + 2), "", "", ""
            elif after == "/" and (m := NAME.match(page, at + 2)):
                stop, kind, name, rest = self._past(">", m.end()), "end", m[0].lower(), ""
            elif after and (m := NAME.match(page, at + 1)) and (end := self._tag_end(m.end())) >= 0:
                stop, kind, name, rest = end + 1, "start", m[0].lower(), page[m.end(): end]
            else:
                if after and NAME.match(after) and page.find(">", at) < 0:
                    at = self._no_tags(at)
                    continue
                at += 1
                continue
            if begin < at:
                yield "data", "", page[begin:at]
            if kind:
                yield kind, name, rest
            if kind == "start" and name in RAW:
                stop = self._past_raw(name, stop)
            at = begin = stop
        if begin < size:
            yield "data", "", page[begin:]

    def _past(self, mark: str, at: int) -> int:
        end = self.page.find(mark, at)
        return len(self.page) if end < 0 else end + len(mark)

    def _no_tags(self, at: int) -> int:
        """Without a ``>`` ahead only marks that reach to the end of the page can follow: where the first of them begins."""
        m = re.compile(r"<(?:[!?]|/[A-Za-z])").search(self.page, at)
        return m.start() if m else len(self.page)

    def _tag_end(self, at: int) -> int:
        """The place of the ``>`` that ends a start tag, outside quotes if there is one, or -1."""
        plain = self.page.find(">", at)
        if plain < 0 or not self.quoted:
            return plain
        while m := STOP.search(self.page, at):
            if m[0] == ">":
                return m.start()
            close = self.page.find(m[0], m.end()) if self.closing[m[0]] else -1
            self.closing[m[0]] = close >= 0
            at = m.end() if close < 0 else close + 1
        self.quoted = False
        return plain

    def _past_raw(self, name: str, at: int) -> int:
        if name not in self.raw:
            self.raw[name] = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.IGNORECASE)
        m = self.raw[name].search(self.page, at)
        return self._past(">", m.end()) if m else len(self.page)


class _Open:
    __slots__ = ("tag", "path", "skip", "link", "text", "links", "first")

    def __init__(self, tag: str, path: bytes, skip: bool, link: bool, first: int):
        self.tag, self.path, self.skip, self.link, self.first = tag, path, skip, link, first
        self.text = self.links = 0


def _kind(tag: str, named: dict[str, str]) -> str:
    """The tag and its classes, digits generalised."""
    classes = named.get("class", "")
    return tag + "".join("." + c for c in sorted(set(re.sub(r"\d+", "#", classes).split()))) if classes else tag


def _left_out(tag: str, named: dict[str, str]) -> bool:
    """Whether an element's text is never of the article: by its tag, by what its class, id or role say, or because it is hidden."""
    if tag in SKIPPED:
        return True
    if not named:
        return False
    if "hidden" in named or named.get("aria-hidden", "").lower() == "true" or "display:none" in named.get("style", "").replace(" ", "").lower():
        return True
    return tag not in ("html", "body", "article", "main") and bool(NOISE.search(" ".join((named.get("class", ""), named.get("id", ""), named.get("role", "")))))


class _Page:
    """The tree of one page as it is read: open elements, blocks in page order, and the containers that have ended."""

    def __init__(self) -> None:
        self.root = _Open("", b"", False, False, 0)
        self.stack = [self.root]
        self.open_at: dict[str, list[int]] = {}  # where each tag's open elements stand in the stack
        self.blocks: list[str] = []
        self.inline: list[str] = []
        self.done: list[tuple[str, int, int, int]] = []

    def flush(self) -> None:
        if self.inline:
            block = " ".join("".join(self.inline).split())
            self.inline.clear()
            if block:
                self.blocks.append(block)

    def data(self, chunk: str) -> None:
        top = self.stack[-1]
        if not top.skip:
            chunk = entities.unescape(chunk) if "&" in chunk else chunk
            self.inline.append(chunk)
            size = len(chunk) - chunk.count(" ")
            top.text += size
            top.links += size if top.link else 0

    def close_down_to(self, depth: int) -> None:
        while len(self.stack) > depth:
            e = self.stack.pop()
            self.open_at[e.tag].pop()
            if e.tag in CONTAINERS and not e.skip:
                self.done.append((e.path.hex(), e.text - 2 * e.links, e.first, len(self.blocks)))
            self.stack[-1].text += e.text
            self.stack[-1].links += e.links

    def end(self, tag: str) -> None:
        if tag in BLOCKS:
            self.flush()
        if at := self.open_at.get(tag):
            self.close_down_to(at[-1])

    def start(self, tag: str, attributes: str) -> None:
        if tag == "br":
            self.inline.append(" ")
        elif tag in BLOCKS:
            self.flush()
        if tag in VOID:
            return
        if tag in CLOSES_P and (at := self.open_at.get("p")):
            self.close_down_to(at[-1])
        for other in SELF_CLOSING.get(tag, ()):
            at = self.open_at.get(other)
            if at and at[-1] > max((x[-1] for t in LISTS if (x := self.open_at.get(t))), default=-1):
                self.close_down_to(at[-1])
        named = {a.lower(): b or c or d or "" for a, b, c, d in ATTRIBUTE.findall(attributes)} if attributes else {}
        top = self.stack[-1]
        path = hashlib.blake2b(top.path + _kind(tag, named).encode("utf-8", "replace"), digest_size=16).digest()
        if tag in RAW:  # its text has been passed over
            return
        self.open_at.setdefault(tag, []).append(len(self.stack))
        self.stack.append(_Open(tag, path, top.skip or _left_out(tag, named), top.link or tag == "a", len(self.blocks)))

    def finish(self) -> None:
        self.flush()
        self.close_down_to(1)
        self.done.append(("", self.root.text - 2 * self.root.links, 0, len(self.blocks)))


def containers(page: str | None) -> tuple[list[tuple[str, int, int, int]], list[str]]:
    """The containers of a page in the order in which they end, then the whole page, and the page's blocks.

    A container is (path, score, first, stop): its blocks are those from ``first`` up to ``stop``. The path is a digest of the tags and
    classes from the root on; that of the whole page is empty. Noise and skipped elements hold nothing. Empty pages have neither.
    """
    if not page:
        return [], []
    read = _Page()
    for kind, name, rest in _Scanner(page):
        if kind == "data":
            read.data(rest)
        elif kind == "start":
            read.start(name, rest)
        else:
            read.end(name)
    read.finish()
    return read.done, read.blocks


def _best(found: list[tuple[str, int, int, int]]) -> int:
    """The container with the highest score of its own, or the whole page if none is above 0.

    Of nested ones that hold the same blocks it is the innermost, which ends first; one that leaves a block out is never taken instead.
    """
    top = max(score for _, score, _, _ in found)
    if top <= 0:
        return len(found) - 1
    most = max(i for i, (_, score, _, _) in enumerate(found) if score == top)
    return next(i for i, (_, _, first, stop) in enumerate(found) if (first, stop) == found[most][2:])


def path_votes(pages: DataFrame) -> DataFrame:
    """(host, path, score) of every container of ``pages`` (host, html): scores are shares of the page's best."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, paths, scores = [], [], []
            for host, page in zip(batch.column(0), batch.column(1)):
                found, _ = containers(page.as_py())
                if found and (top := max(score for _, score, _, _ in found)) > 0:
                    best: dict[str, float] = {}
                    chosen = found[_best(found)][0]
                    for path, score, _, _ in found:
                        if score > 0:
                            best[path] = max(best.get(path, 0.0), score / top * (1.0 if path == chosen else 0.5))
                    for path, score in best.items():
                        hosts.append(host.as_py())
                        paths.append(path)
                        scores.append(score)
            yield pa.RecordBatch.from_arrays(
                [pa.array(hosts, pa.string()), pa.array(paths, pa.string()), pa.array(scores, pa.float64())], names=["host", "path", "score"])

    return pages.select("host", "html").mapInArrow(run, "host string, path string, score double")


def host_paths(pages: DataFrame) -> DataFrame:
    """(host, path): the path with the most votes of each host; ties go to the smaller path."""
    votes = path_votes(pages).groupBy("host", "path").agg(F.round(F.sum("score"), 6).alias("votes"))
    order = Window.partitionBy("host").orderBy(F.desc("votes"), "path")
    return votes.withColumn("nth", F.row_number().over(order)).where("nth = 1").select("host", "path")


def main_texts(pages: DataFrame) -> DataFrame:
    """(page_id, url, text) of every row of ``pages`` (page_id, url, html; further columns are ignored).

    ``text`` is the article's blocks in page order, joined by a blank line; character references are decoded and white space is one
    space. Null and empty pages, and pages without text outside menus, adverts and the like, have an empty text. Rows that repeat
    a page_id are read one by one; urls without a host vote together.
    """
    read = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")).withColumn(
        "host", F.coalesce(F.lower(F.regexp_extract("url", r"(?s)^.*?://([^/?#]*)", 1)), F.lit("")))
    winners, _ = stored(host_paths(read), "paths")
    joined = read.join(broadcast_within(winners, BROADCAST_IDS // 10), "host", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for page, path in zip(batch.column(2), batch.column(3)):
                found, blocks = containers(page.as_py())
                wanted = path.as_py()
                mine = [(first, stop) for at, _, first, stop in found if at == wanted and first < stop]
                if not mine and found:
                    mine = [found[_best(found)][2:]]
                texts.append("\n\n".join(b for first, stop in mine for b in blocks[first:stop]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    return joined.select("page_id", "url", "html", "path").mapInArrow(run, "page_id long, url string, text string")
