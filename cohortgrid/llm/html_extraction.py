"""Main text of web pages by the paths that the pages of a host agree on.

Each page's containers are scored by how much of its running text they hold and how
little else. The pages of a host vote on paths (tags and classes, with numbers generalised),
a map-side combined aggregation, and the text of every page is then taken from its host's best path. A
page without that path, or without text in it, uses its own best container.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from .arrow import slices
from .url_filter import host_of

#: Winning paths of up to so many bytes are sent to all tasks; of more, pages are joined by host.
MOST_BYTES = 1 << 23

# Fixed names of the markup language.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript template iframe noembed noframes xmp svg math select option button canvas object audio video".split())
BLOCKS = frozenset(
    "html body address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr legend li main menu nav ol p pre search section summary table tbody tfoot thead tr caption ul".split()
)
CELLS = frozenset(("td", "th"))
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
CONTAINERS = frozenset(("html", "body", "article", "main", "section", "div", "td", "center"))
#: Which open elements a start tag ends, and at which it stops looking.
ENDS = {"li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)), "tr": (("tr", "td", "th"), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table"))}

#: Elements that are never main text.
ASIDE = frozenset(("nav", "footer", "aside", "menu", "dialog", "search"))
#: Words of classes, ids and roles of what surrounds a text.
SURROUND = frozenset(
    """ad ads adv advert adverts advertisement advertising adsense adsbygoogle banner sponsor sponsored promo promotion promoted outbrain taboola
    cookie cookies consent gdpr notice notices alert popup modal overlay dialog newsletter subscribe subscription signup signin login paywall
    nav navbar navigation menu menus breadcrumb breadcrumbs topbar toolbar pager pagination header masthead footer sidebar sidebars aside rail
    comment comments commentlist disqus respond reply replies discussion share sharing social related recommended recommendations
    search searchform copyright legal disclaimer complementary contentinfo alertdialog""".split()
)

_OPEN = re.compile(r"<(?:(!--)|([!?])|(/?)([a-zA-Z][^\s/>]*))")
_ATTRIBUTE = re.compile(r"""(?<![\w-])(class|id|role|itemprop|aria-hidden|hidden|style)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?(?=[\s/>]|$)""", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_DIGITS = re.compile(r"\d+")


def _tag_end(text: str, at: int) -> int:
    """Behind the ``>`` that ends the tag, quoted ones not counted; the end of the text if there is none."""
    quote = ""
    while True:
        end = text.find(">", at)
        if end < 0:
            return len(text)
        for q in re.findall(r"[\"']", text[at:end]):
            quote = "" if q == quote else quote or q
        if not quote:
            return end + 1
        close = text.find(quote, end)
        if close < 0:
            return end + 1
        quote, at = "", close + 1


class Page:
    """The blocks of a page: text, length in links, and the open elements around it."""

    def __init__(self, source: str):
        self.tags, self.labels, self.parents = ["#"], [""], [-1]
        self.prose: set[int] = set()
        self.surround: set[int] = set()
        self.headers: set[int] = set()
        self.bonus: set[str] = set()
        self.blocks: list[tuple[str, int, int]] = []
        self._read(source)

    def _element(self, tag: str, attributes: str, parent: int) -> int:
        found = {m[0].lower(): m[1] or m[2] or m[3] for m in _ATTRIBUTE.findall(attributes)} if attributes else {}
        classes = found.get("class", "")
        names = sorted({_DIGITS.sub("#", c.lower()) for c in classes.split() if len(_DIGITS.findall(c)) < 3 and len(c) <= 30})
        node = len(self.tags)
        self.tags.append(tag)
        self.labels.append(".".join((tag, *names)))
        self.parents.append(parent)
        role = found.get("role", "").lower()
        if tag in ("article", "main") or role in ("main", "article") or found.get("itemprop", "").lower() == "articlebody":
            self.prose.add(node)
        if found:
            words = {w.lower() for w in _WORDS.findall(f"{classes} {found.get('id', '')} {role}")}
            words &= SURROUND
            unseen = "hidden" in found or found.get("aria-hidden", "").lower() == "true" or "display:none" in found.get("style", "").replace(" ", "").lower()
            if tag not in ("html", "body") and words == {"header"} and not unseen:
                self.headers.add(node)
            elif unseen or (words and tag not in ("html", "body")):
                self.surround.add(node)
        if tag == "form":
            self.surround.add(node)
        elif tag == "header":
            self.headers.add(node)
        if node in self.prose and node not in self.surround:
            # What holds a whole article only looks like something around it.
            up = parent
            while up > 0:
                if self.tags[up] not in ASIDE:
                    self.surround.discard(up)
                    self.headers.discard(up)
                up = self.parents[up]
        return node

    def _read(self, source: str) -> None:
        path, texts, linked, links, at = [0], [], 0, 0, 0
        muted: list[int] = []

        def flush() -> None:
            nonlocal linked
            if texts:
                block = " ".join("".join(texts).split())
                if block:
                    self.blocks.append((block, linked, path[-1]))
                texts.clear()
            linked = 0

        def add(raw: str) -> None:
            nonlocal linked
            if raw and not muted:
                text = entities.unescape(raw) if "&" in raw else raw
                texts.append(text)
                if links:
                    linked += len(text.strip())

        def close_to(place: int) -> None:
            nonlocal links
            for node in path[place:]:
                links -= self.tags[node] == "a"
            while muted and muted[-1] >= path[place]:
                muted.pop()
            del path[place:]

        while at < len(source):
            m = _OPEN.search(source, at)
            if not m:
                add(source[at:])
                break
            add(source[at : m.start()])
            if m[1]:
                end = source.find("-->", m.end() - 2)
                at = len(source) if end < 0 else end + 3
                continue
            if m[2]:
                end = source.find(">", m.end())
                at = len(source) if end < 0 else end + 1
                continue
            tag, at = m[4].lower(), _tag_end(source, m.end())
            block = tag in BLOCKS
            if m[3]:
                if tag == "br":
                    texts.append(" ")
                for place in range(len(path) - 1, 0, -1):
                    own = self.tags[path[place]]
                    if own == tag:
                        if block:
                            flush()
                        elif tag in CELLS:
                            texts.append(" ")
                        close_to(place)
                        break
                    if not block and (own in BLOCKS or own in CELLS):
                        break
                continue
            if tag in RAW:
                closing = re.compile(f"</{tag}(?=[\\s/>])", re.I).search(source, at)
                # Without an end tag, what is cut off is the rest of a script, but not of a page.
                if closing:
                    at = _tag_end(source, closing.end())
                elif tag in ("script", "style", "textarea", "title", "xmp"):
                    at = len(source)
                if tag not in ("script", "style"):
                    texts.append(" ")
                continue
            if block or tag in CELLS:
                ended, stops = ENDS.get(tag, ((), ()))
                if block:
                    flush()
                else:
                    texts.append(" ")
                for place in range(len(path) - 1, 0, -1):
                    own = self.tags[path[place]]
                    if own == "head" or own in ended or (own == "p" and block):
                        close_to(place)
                        if own == "p" and not ended or own in ended and tag != "tr":
                            break
                    elif own in stops or (not ended and own in BLOCKS):
                        break
            elif tag == "br":
                texts.append(" ")
            if tag in VOID:
                continue
            path.append(self._element(tag, source[m.end() : at - 1], path[-1]))
            links += tag == "a"
            # Blocks are judged by their ancestors at the end, words in a line here.
            if path[-1] in self.surround and not block and tag not in CELLS:
                muted.append(path[-1])
        flush()
        self._place()

    def _place(self) -> None:
        """What the elements around each element make of its blocks, parents first."""
        #: 0: text, 1: header, in which only headings are text, 2: not text.
        state, heading, containers = [0], [False], [("",)]
        for node in range(1, len(self.tags)):
            tag, up = self.tags[node], self.parents[node]
            is_heading = tag in HEADINGS
            if state[up] == 2 or tag in ASIDE or tag == "head" or node in self.surround:
                state.append(2)
            elif node in self.headers:
                state.append(1)
            else:
                state.append(0 if is_heading else state[up])
            heading.append(heading[up] or is_heading)
            path = self.path_of(node) if tag in CONTAINERS else ""
            containers.append(containers[up] if not path or path in containers[up] else (*containers[up], path))
            if path and node in self.prose:
                self.bonus.add(path)
        #: Text, length, length of running text, and the paths of the containers around it.
        self.kept = []
        for text, linked, node in self.blocks:
            if state[node] == 0:
                good = len(text) if 2 * linked < len(text) and (len(text) >= 25 or heading[node]) else 0
                self.kept.append((text, good, containers[node]))

    def path_of(self, node: int) -> str:
        labels = []
        while node > 0:
            if self.tags[node] not in ("html", "body"):
                labels.append(self.labels[node])
            node = self.parents[node]
        return "/".join(reversed(labels))

    def scores(self) -> dict[str, int]:
        """Each container path's score: the harmonic mean of the share of running text it holds and the share running text has in it.

        Of containers with equal shares the deeper is the better, an article better still.
        """
        around: dict[tuple[str, ...], list[int]] = {}
        for text, good, paths in self.kept:
            sums = around.setdefault(paths, [0, 0])
            sums[0] += good
            sums[1] += len(text)
        prose, whole = Counter(), Counter()
        for paths, (good, size) in around.items():
            for path in paths:
                prose[path] += good
                whole[path] += size
        out, total = {}, prose[""]
        for path, own in prose.items():
            if own:
                share, purity = own / total, own / whole[path]
                deep = 2 * min(4, path.count("/") + (path != "")) + (5 if path in self.bonus else 0)
                out[path] = int(20_000 * (50 + deep) * 2 * share * purity / (share + purity))
        return out

    def text(self, path: str) -> str:
        return "\n\n".join(text for text, _, paths in self.kept if path in paths)


def best_path(scores: dict[str, int]) -> str:
    return max(scores, key=lambda p: (scores[p], p), default="")


def page_votes(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(host, path, score)``: of every page with running text the container path of the highest score."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            rows = []
            for host, source in zip(*(batch.column(i).to_pylist() for i in (0, 1))):
                scores = Page(source).scores() if source else {}
                if scores:
                    rows.append((host, best := best_path(scores), scores[best]))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate((pa.string(), pa.string(), pa.int64()))], ["host", "path", "score"])

    rows = pages.select(host_of(F.col(url_col).cast("string")).alias("host"), F.col(html_col).cast("string").alias("html"))
    return rows.mapInArrow(score, "host string, path string, score long")


def host_paths(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(host, path)``: the path that most pages of each host vote for; of equal ones that with the highest sum of scores, then the last by name."""
    votes = page_votes(pages, url_col, html_col).groupBy("host", "path").agg(F.count("*").alias("votes"), F.sum("score").alias("score"))
    return votes.groupBy("host").agg(F.max(F.struct("votes", "score", "path"))["path"].alias("path"))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(page_id, url, text, n_chars)`` of every page, in blocks joined by an empty line.

    A null or empty page, or one without text, gives the empty text. Pages of a null address, or one without ``://``, are of the host with the empty
    name. Every row is a page of its own, repeated or not, whatever its id; an empty table gives no rows. Other columns are ignored, whatever their names.
    """
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    chosen = materialise(host_paths(rows), "host_paths")
    size = chosen.agg(F.sum(F.octet_length("host") + F.octet_length("path") + 64)).first()[0] or 0
    chosen = F.broadcast(chosen) if size <= MOST_BYTES else chosen
    ready = rows.withColumn("host", F.coalesce(host_of(F.col("url")), F.lit(""))).join(chosen, "host", "left")

    def text_of(source: str | None, path: str | None) -> str:
        if not source:
            return ""
        page = Page(source)
        found = page.text(path) if path is not None else ""
        if not found and page.kept:
            found = page.text(best_path(page.scores()))
        return found

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            texts = [text_of(s, p) for s, p in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    kind = rows.schema["page_id"].dataType.simpleString()
    return ready.select("page_id", "url", "html", "path").mapInArrow(take, f"page_id {kind}, url string, text string, n_chars long")
