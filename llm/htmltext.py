"""Main text of web pages by consensus host paths.

The outermost article or main of a page, or the innermost container around all its text outside furniture, votes, with its path
of tags and generalised classes, for its host. Votes are counted in Spark, and every page is then extracted again at
the path that won on its host, so that a page whose own score misleads follows its siblings.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.base import ship, written
from tidemark.operators.skew import salted_lookup

# What HTML says of tags, and the usual names of page furniture.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noframes".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split())
CLOSES = {"li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table"), "td": ("td th", "tr table"), "th": ("td th", "tr table"), "option": ("option", "select")}
CLOSES = {k: (frozenset(a.split()), frozenset(b.split())) for k, (a, b) in CLOSES.items()}
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
CONTAINER = frozenset("html body main article section div td center blockquote figure".split())
FURNITURE = frozenset("head nav footer aside script style noscript iframe button select option textarea title svg math canvas object embed template dialog menu".split())
# Elements that a class or id can name as furniture; headings and paragraphs are none.
NAMED = frozenset("div section ul ol dl table td span a center li".split())
PART = r"(?:[-_]?(?:list|area|section|thread|container|wrapper|wrap|box|block|bar|panel|inner|widget|unit|slot|feed|count|links?|buttons?|form|\d+))*"
# The furniture word is the last of a name ("left-sidebar", "search-box"), and not what a layout has or lacks ("no-sidebar").
FURNITURE_NAME = re.compile(
    r"^(?!(?:no|has|have|with|without|layout|is)[-_])(?:[^-_]+[-_]+)*(?:ads?|adverts?|advertisement|advertising|sponsor(?:ed)?|promo(?:tion)?|banner|sidebar|side|widget|nav|navbar|navigation|menu|breadcrumbs?|header|masthead|topbar|footer|"
    r"discussion|notice|cookies?|consent|gdpr|alert|popup|modal|overlay|newsletter|subscribe|signup|login|share|sharing|social|related|recommended|pagination|pager|search|toolbar|skip|hidden)" + PART + r"$", re.I)
COMMENT_NAME = re.compile(r"^(?:(?:user|post|reader|article|page|blog|visitor|fb)[-_]?)?(?:comments?|commentlist|disqus(?:[-_]thread)?|respond|repl(?:y|ies))(?:[-_]?body)?" + PART + r"$", re.I)
TITLE_NAME = re.compile(r"^(?:article|entry|post|page|content|story|section)[-_]{1,2}header$", re.I)
PLAIN_ID = frozenset("side search notice discussion header banner".split())  # as an id of an element these can name a chapter
AUTHOR_NAME = re.compile(r"(?:^|[-_])(?:author|user|username|byline|avatar|date|time|posted|nick)(?:$|[-_\d])", re.I)
REPLY_NAME = re.compile(r"(?:^|[-_/#?&])(?:reply|replyto|replytocom)(?:$|[-_/\d=?&])", re.I)
REPLY_WORDS = frozenset("reply antworten répondre responder rispondi ответить".split())
FURNITURE_ROLE = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert alertdialog".split())
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*)>", re.S)
ATTRIBUTE = re.compile(r"([^\s=/\"'<>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
SPACE = re.compile(r"[ \t\n\x0b\x0c\r\x1c-\x1f\x85\xa0  -     　]+")


class Page:
    """The elements of a page (parent, tag, path, furniture or not) and its text blocks (element, text, characters in links)."""

    def __init__(self, source: str):
        self.parent, self.tag, self.path, self.skip, self.named, self.remark = [-1], [""], [""], [False], [False], [False]
        self._author, self._reply, self._kind = [False], [False], [()]
        self.blocks: list[tuple[int, str, int]] = []
        self._stack, self._buffer, self._links, self._read = [0], [], 0, []
        at = 0
        while match := TOKEN.search(source, at):
            self._text(source[at:match.start()])
            at = match.end()
            if match[2]:
                tag = match[2].lower()
                if match[1]:
                    self._close(tag)
                else:
                    self._open(tag, match[3] or "")
                    if tag in RAW and not (match[3] or "").rstrip().endswith("/"):
                        end = re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(source, at)
                        at = end.start() if end else len(source)
        self._text(source[at:])
        self._flush()
        self._settle()
        self.own, self.filled = [False] * len(self.tag), [False] * len(self.tag)  # text right in it; text in it or below
        for node, _, _ in self.blocks:
            self.own[node] = True
            while node >= 0 and not self.filled[node]:
                self.filled[node] = True
                node = self.parent[node]
        self.weight = [0.0] * len(self.tag)
        for node, text, linked in self.blocks:
            worth = max(0.0, len(text) - 2.0 * linked)
            while node >= 0:
                self.weight[node] += worth
                node = self.parent[node]

    def _text(self, raw: str) -> None:
        node = self._stack[-1]
        if self.tag[node] in ("a", "button", "span") and len(raw) < 40 and raw.strip().lower() in REPLY_WORDS:
            self._reply[node] = True
        if raw and not self.skip[node]:
            text = html.unescape(raw)
            self._buffer.append((node, text, len(text.strip()) if self._links else 0))

    def _flush(self) -> None:
        if self._buffer:
            self._read.append(self._buffer)
        self._buffer = []

    def _sums(self, worth) -> list[float]:
        """For each element the sum over it and all below of (element, number) pairs."""
        sums = [0.0] * len(self.tag)
        for node, number in worth:
            sums[node] += number
        for x in range(len(sums) - 1, 0, -1):
            sums[self.parent[x]] += sums[x]
        return sums

    def _remarks(self) -> set[int]:
        """Elements that are reader comments by structure: siblings of one tag and class, each with an author or date, a
        reply part and no heading."""
        author, reply = self._sums(enumerate(self._author)), self._sums(enumerate(self._reply))
        heading = self._sums((x, 1) for x in range(len(self.tag)) if self.tag[x] in HEADING)
        alike = {}
        for x in range(1, len(self.tag)):
            if author[x] and reply[x] and not heading[x] and self.tag[x] not in ("html", "body", "main"):
                alike.setdefault((self.parent[x], self._kind[x]), []).append(x)
        return {x for xs in alike.values() if len(xs) > 1 for x in xs}

    def _settle(self) -> None:
        """Drop reader comments, elements named as furniture and forms; the rest makes blocks.

        What holds a title, all articles of a page without one (comments aside) or all of its text is no furniture, nor is a
        form around navigation, as pages of some frameworks lie in one.
        """
        held = self._sums((node, len(text.strip())) for pieces in self._read for node, text, _ in pieces)
        remarks = self._remarks()
        body = [self.tag[x] in ("article", "main") and not self.remark[x] and x not in remarks and held[x] > 0 for x in range(len(self.tag))]
        title = self._sums((x, 1) for x in range(len(self.tag)) if self.tag[x] == "h1" and held[x] > 0)
        inner = self._sums((self.parent[x], 1) for x in range(1, len(self.tag)) if body[x])
        around = self._sums((self.parent[x], 1) for x in range(1, len(self.tag)) if self.tag[x] in ("nav", "header", "footer", "aside"))
        for x in range(1, len(self.tag)):
            free = title[x] or held[x] == held[0]
            whole = not title[0] and inner[x] and inner[x] == inner[0]
            furniture = (self.remark[x] or x in remarks) and not free or self.named[x] and not (free or whole)
            form = self.tag[x] == "form" and not (free or whole or around[x])
            self.skip[x] = self.skip[x] or self.skip[self.parent[x]] or furniture or form
        for pieces in self._read:
            kept = [piece for piece in pieces if not self.skip[piece[0]]]
            text = SPACE.sub(" ", "".join(piece[1] for piece in kept)).strip(" ")
            if text:
                self.blocks.append((kept[-1][0], text, sum(piece[2] for piece in kept)))

    def _pop(self, depth: int) -> None:
        if any(self.tag[x] in BLOCK for x in self._stack[depth:]):
            self._flush()
        self._links -= sum(self.tag[x] == "a" for x in self._stack[depth:])
        del self._stack[depth:]

    def _close(self, tag: str) -> None:
        for depth in range(len(self._stack) - 1, 0, -1):
            if self.tag[self._stack[depth]] == tag:
                self._pop(depth)
                return

    def _open(self, tag: str, attributes: str) -> None:
        if tag == "br":
            if not self.skip[self._stack[-1]]:
                self._buffer.append((self._stack[-1], " ", 0))
            return
        if tag in BLOCK:
            self._flush()
            ends, inside = CLOSES.get(tag, (frozenset(), frozenset()))
            for depth in range(len(self._stack) - 1, 0, -1):
                name = self.tag[self._stack[depth]]
                if name in inside or name != "p" and name not in ends and name in CONTAINER:
                    break
                if name in ends or name == "p":
                    self._pop(depth)
                    break
        if tag in VOID:
            return
        top = self._stack[-1]
        named = {k.lower(): a or b or c or "" for k, a, b, c in ATTRIBUTE.findall(attributes)}
        classes = [re.sub(r"\d+", "#", x) for x in named.get("class", "").split()]
        inner = any(self.tag[x] in ("article", "main") for x in self._stack)
        skip = self.skip[top] or tag in FURNITURE or tag in ("label", "legend") and any(self.tag[x] == "form" for x in self._stack) or tag == "header" and not inner or named.get("role", "").lower() in FURNITURE_ROLE
        if not skip and tag not in ("html", "body", "article", "main"):
            skip = "hidden" in named or named.get("aria-hidden") == "true" or bool(re.search(r"display\s*:\s*none", named.get("style", "")))
        own, name = named.get("class", "").split(), named.get("id", "")
        names = own if name.lower() in PLAIN_ID else [*own, name]
        remark = any(COMMENT_NAME.search(x) for x in names) and (tag in NAMED or tag == "article")
        self.parent.append(top)
        self.tag.append(tag)
        self.path.append(f"{self.path[top]}>{tag}" + "".join(f".{x}" for x in sorted(set(classes))) if tag in CONTAINER else self.path[top])
        self.skip.append(skip)
        self.named.append(tag in NAMED and any(FURNITURE_NAME.search(x) and not TITLE_NAME.search(x) for x in names))
        self.remark.append(remark)
        self._author.append(tag == "time" or any(AUTHOR_NAME.search(x) for x in own))
        self._reply.append(any(REPLY_NAME.search(x) for x in (*own, name, named.get("href", ""))))
        self._kind.append((tag, *sorted(set(classes))))
        self._stack.append(len(self.tag) - 1)
        self._links += tag == "a"

    def best(self) -> int:
        """The outermost article or main elements where those of one path hold most of the text, else the innermost
        container around all of it."""
        outer, inside = {}, [False] * len(self.tag)
        for x in range(1, len(self.tag)):
            inside[x] = inside[self.parent[x]] or self.tag[x] in ("article", "main")
            if inside[x] and not inside[self.parent[x]]:
                outer.setdefault(self.path[x], []).append(x)
        sums = {k: sum(self.weight[x] for x in xs) for k, xs in outer.items()}
        if sums and (most := max(sums, key=sums.get)) and sums[most] > 0 and 2 * sums[most] >= self.weight[0]:
            return outer[most][0]
        children = {}
        for x in range(1, len(self.tag)):
            if self.filled[x]:
                children.setdefault(self.parent[x], []).append(x)
        node = at = 0
        while len(held := children.get(at, ())) == 1 and not self.own[at]:
            at = held[0]
            if self.tag[at] in CONTAINER:
                node = at
        return node

    def text(self, nodes: list[int]) -> str:
        """The blocks from the first to the last of the nodes, in page order."""
        inside, wanted = [False] * len(self.tag), set(nodes)
        for x in range(len(self.tag)):
            inside[x] = x in wanted or x > 0 and inside[self.parent[x]]
        held = [k for k, (at, _, _) in enumerate(self.blocks) if inside[at]]
        return "\n".join(text for _, text, _ in self.blocks[held[0]:held[-1] + 1]) if held else ""

    def at_path(self, paths) -> list[int]:
        """All containers at the first of the paths that the page has with text, else those at its own best one's."""
        for path in (*paths, self.path[self.best()]):
            found = [x for x in range(len(self.tag)) if self.path[x] == path and (self.tag[x] in CONTAINER or not x)]
            if any(self.weight[x] > 0 for x in found):
                return found
        return [self.best()]


def main_text(pages: DataFrame, least_share: float = 0.1) -> DataFrame:
    """(page_id, url, text) per row of ``pages`` (page_id long, url, html).

    Paths with ``least_share`` of a host's votes or more win there, ten at most by that share; a page follows the most
    voted of them that it has, and its own best container where it has none. All containers at that path are kept, with the
    text between them. Reader comments go by name or as repeated siblings with an author or date and a reply part, furniture
    by tag, role or name, whatever its size, unless it holds the title or all of the text. Character references are decoded, white
    space inside a block becomes one space, blocks are trimmed and joined by line feeds in page order.

    Null and empty html give empty text; markup that is broken or cut off is read as far as it goes. Pages with null
    url, or one without a host, vote together. Repeated rows vote and are extracted each. Ties go to the path that sorts first. An
    empty table gives an empty result; other columns are ignored.
    """
    ship(pages.sparkSession)
    host = F.lower(F.regexp_extract(F.coalesce(F.col("url").cast("string"), F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    held = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"), host.alias("host"))

    def vote(batches):
        for batch in batches:
            hosts, paths, scores = [], [], []
            for name, source in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
                page = Page(source or "")
                node = page.best()
                if page.weight[node] > 0:
                    hosts.append(name)
                    paths.append(page.path[node])
                    scores.append(int(page.weight[node]))
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(paths, pa.string()), pa.array(scores, pa.int64())], ["host", "path", "score"])

    votes = held.select("host", "html").mapInArrow(vote, "host string, path string, score long")
    counted = written(votes.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum("score").alias("score")), "path-votes")
    whole = counted.groupBy("host").agg(F.sum("n").alias("all"))
    won = counted.join(whole, "host").where(F.col("n") >= least_share * F.col("all"))
    ranked = F.transform(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("n"), (-F.col("score")).alias("score"), "path"))), lambda x: x["path"])
    paths = won.groupBy("host").agg(ranked.alias("paths"))

    def extract(batches):
        for batch in batches:
            texts = []
            for source, paths in zip(batch.column("html").to_pylist(), batch.column("paths").to_pylist(), strict=True):
                page = Page(source or "")
                texts.append(page.text(page.at_path(paths or ())))
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    return salted_lookup(held, paths, ["host"]).select("page_id", "url", "html", "paths").mapInArrow(extract, "page_id long, url string, text string")
