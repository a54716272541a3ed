"""Main text of HTML pages by consensus of each host's pages.

1. One pass over a page finds its containers: their generalised paths (tags with class words, digits left out), the characters of running text
   below each, and those of links and of boilerplate. A container's score is its share of the page's running text, times the purity of its own
   text, times a preference for tags and classes that name the article. The page votes for its best container's path.
2. Spark counts the votes per host and path, combined in each task first, so that a host with a third of all pages is one row per task and path.
   A host's paths are ranked by votes, then by score.
3. A second pass takes each page's text from the highest ranked of its host's ``RANKS`` paths that holds running text there, and from the page's own best container
   where none does. All elements of that path contribute, in page order.

Left out inside the container: menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and reader comments, known by tag, role, or a
word of their class or id. An element that holds an article, the main element or the top heading is never boilerplate by its class, and a header
inside an article belongs to it. White space (also after decoding) becomes one space, inline tags separate nothing, blocks are joined by a space.

Null and empty pages, and pages without running text, give the empty text. A null or unreadable url counts as one host without a name. Repeated rows
vote once each and get the same text. Unclosed and stray tags, comments and quotes end at the next sensible place; nothing raises. Other columns are
not looked at. No page, host or text is capped.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerlake.llm.common import stored

# Paths per host that the second pass may use, in order of votes; a page without any of them goes by its own scores.
RANKS = 8

TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+>?|<(/?)([a-zA-Z][^\s/<>]*+)((?:[^<>"']++|"[^"]*+"|'[^']*+'|["'])*+)>""", re.S
)
ATTRIBUTE = re.compile(r"""(class|id|role|hidden|itemprop)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))|(?=[\s/]|\Z))""", re.I)
WORD = re.compile(r"[a-z]+")
# Elements whose content is never text of the page.
RAW = frozenset("script style title noscript template iframe svg math textarea select button object canvas audio video".split())
RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*+>?", re.I) for tag in RAW}
# Elements that hold blocks; the first group may be voted for.
CANDIDATES = frozenset("body article main section div td center".split())
HOLDERS = CANDIDATES | frozenset("html nav header footer aside form ul ol dl table figure details dialog fieldset menu blockquote".split())
BREAKS = HOLDERS | frozenset("p h1 h2 h3 h4 h5 h6 li dt dd tr th pre hr br address figcaption caption summary thead tbody tfoot legend".split())
BOILERPLATE_TAGS = frozenset("nav footer aside form dialog menu fieldset".split())
BOILERPLATE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert menu menubar".split())
BOILERPLATE_WORDS = frozenset(
    """ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer gdpr
    header masthead menu modal nav navbar navigation newsletter notice notices pagination pager popup promo promotion related respond share
    sharing sidebar social sponsor sponsored subscribe subscription toolbar widget widgets""".split()
)
ARTICLE_WORDS = frozenset("article articlebody body content entry main post prose story text".split())
NAMED, WORDED, WHOLE = 1.5, 1.2, 0.5  # preference of article and main, of a class such as content, of the body itself


class Page:
    """Elements of one page in page order, with their running text.

    Element 0 stands above all others. ``texts`` holds (element, text, in a link) and None between blocks, elements by number.
    """

    def __init__(self, source: str):
        self.tags, self.parents, self.paths = [""], [-1], [""]
        self.worded, self.suspect, self.holds = [False], [False], [False]
        self.texts: list[tuple[int, str, bool] | None] = []
        self._read(source)
        # Parents come before their children, so one pass backwards tells what an element holds, one forwards what it lies in.
        for i in range(len(self.tags) - 1, 0, -1):
            if self.holds[i] or self.tags[i] in ("article", "main"):
                self.holds[self.parents[i]] = True
        self.dropped, inside = [False], [False]
        for i in range(1, len(self.tags)):
            tag, up = self.tags[i], self.parents[i]
            kept = self.holds[i] or tag in ("html", "body", "article", "main")
            by_tag = tag in BOILERPLATE_TAGS or (tag == "header" and not inside[up])
            self.dropped.append(self.dropped[up] or by_tag or (self.suspect[i] and not kept))
            inside.append(inside[up] or tag in ("article", "main"))

    def _open(self, parent: int, tag: str, attributes: str) -> int:
        words: list[str] = []
        suspect = False
        for name, *values in ATTRIBUTE.findall(attributes) if attributes.strip(" /") else ():
            value, name = "".join(values).lower(), name.lower()
            if name == "role":
                suspect |= value.strip() in BOILERPLATE_ROLES
            elif name == "hidden":
                suspect = True
            else:
                found = WORD.findall(value)
                words += found if name == "class" else ()
                suspect |= not BOILERPLATE_WORDS.isdisjoint(found)
        if tag == "header":
            suspect = False  # decided by where it stands
        self.tags.append(tag)
        self.parents.append(parent)
        self.paths.append(f"{self.paths[parent]}>{'.'.join([tag, *sorted(set(words))])}")
        self.worded.append(not ARTICLE_WORDS.isdisjoint(words))
        self.suspect.append(suspect)
        self.holds.append(False)
        return len(self.tags) - 1

    def _read(self, source: str) -> None:
        stack, links, at = [0], 0, 0
        texts, missing = self.texts, set()
        while match := TAG.search(source, at):
            if match.start() > at:
                texts.append((stack[-1], source[at : match.start()], links > 0))
            at = match.end()
            name = match[2]
            if name is None:
                continue
            tag, closing = name.lower(), bool(match[1])
            if tag in RAW and not closing:
                end = None if tag in missing else RAW_END[tag].search(source, at)
                if end:
                    at = end.end()
                elif tag in ("script", "style"):
                    return  # as browsers read it, all the rest is a script
                else:
                    missing.add(tag)  # an element without an end hides nothing
                continue
            if tag == "a":
                links = 0 if closing else 1
            if tag not in BREAKS:
                continue
            texts.append(None)
            if tag == "h1" and not closing:
                for i in stack:
                    self.holds[i] = True
            if tag not in HOLDERS:
                continue
            links = 0
            if not closing:
                stack.append(self._open(stack[-1], tag, match[3]))
            else:
                for depth in range(len(stack) - 1, 0, -1):
                    if self.tags[stack[depth]] == tag:
                        del stack[depth:]
                        break
        if at < len(source):
            texts.append((stack[-1], source[at:], links > 0))

    def best(self) -> tuple[str, float]:
        """The path of the container with the highest score, the innermost of equals; an empty path without running text."""
        n = len(self.tags)
        good, bad = [0] * n, [0] * n
        for text in self.texts:
            if text is not None:
                size = len(text[1]) - text[1].count(" ")
                (bad if text[2] or self.dropped[text[0]] else good)[text[0]] += size if text[1].strip() else 0
        for i in range(n - 1, 0, -1):
            good[self.parents[i]] += good[i]
            bad[self.parents[i]] += bad[i]
        path, score = "", 0.0
        for i in range(n):
            if not good[i] or self.dropped[i] or (i and self.tags[i] not in CANDIDATES):
                continue
            named = self.tags[i] in ("article", "main")
            weight = NAMED if named else WHOLE if i == 0 or self.tags[i] == "body" else WORDED if self.worded[i] else 1.0
            own = weight * good[i] / good[0] * good[i] / (good[i] + bad[i])
            if own >= score:
                path, score = self.paths[i], own
        return path, score

    def text(self, path: str) -> str:
        """The text of all elements with this path, without boilerplate."""
        inside = [self.paths[0] == path]
        for i in range(1, len(self.tags)):
            inside.append((inside[self.parents[i]] or self.paths[i] == path) and not self.dropped[i])
        # A blank between blocks keeps their words apart; inside a block the runs are put together as they stand.
        runs = [" " if t is None else entities.unescape(t[1]) for t in self.texts if t is None or inside[t[0]]]
        return " ".join("".join(runs).split())


def host_of(url_col: str) -> Column:
    """The host in lower case, empty where the url names none."""
    host = F.regexp_extract(F.col(url_col).cast("string"), r"^\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#]*@)?([^/?#:]*)", 1)
    return F.lower(F.coalesce(host, F.lit("")))


def extract(source: str | None, paths: list[str] | None) -> str:
    """The text below the first of these paths that the page has text for, else below its own best container."""
    if not source:
        return ""
    page = Page(source)
    present = set(page.paths)
    for path in paths or ():
        if path in present and (text := page.text(path)):
            return text
    own, score = page.best()
    return page.text(own) if score else ""


def _vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ballots = [Page(source).best() if source else ("", 0.0) for source in batch.column(1).to_pylist()]
        hosts = batch.column(0).to_pylist()
        cast = [(host, *ballot) for host, ballot in zip(hosts, ballots, strict=True) if ballot[1]]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([c[0] for c in cast], pa.string()),
                pa.array([c[1] for c in cast], pa.string()),
                pa.array([round(c[2] * 1_000_000) for c in cast], pa.int64()),
            ],
            names=["host", "path", "score"],
        )


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [extract(s, p) for s, p in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(texts, pa.string())], names=["page_id", "url", "text"])


def host_votes(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """host, path, votes (pages of the host whose best container has this path) and score (their sum, in millionths)."""
    ballots = pages.select(host_of(url_col).alias("host"), F.col(html_col).cast("string").alias("source")).mapInArrow(
        _vote, "host string, path string, score bigint"
    )
    return ballots.groupBy("host", "path").agg(F.count("*").alias("votes"), F.sum("score").alias("score"))


def main_text(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", ranks: int = RANKS
) -> DataFrame:
    """page_id, url and text of every page.

    The winners are written first. Spark then knows their size: below the session's threshold it sends them to the pages, which stay where they
    are; beyond it the join goes by host, and AQE splits a hot host's pages between tasks.
    """
    order = Window.partitionBy("host").orderBy(F.desc("votes"), F.desc("score"), "path")
    ranked = host_votes(pages, url_col, html_col).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= ranks)
    winners = ranked.groupBy("host").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("rank", "path"))), lambda r: r["path"]).alias("paths")
    )
    winners = stored(winners, "host_paths")
    kind, link = (pages.schema[c].dataType.simpleString() for c in (id_col, url_col))
    rows = pages.select(
        F.col(id_col).alias("page_id"),
        F.col(url_col).alias("url"),
        F.col(html_col).cast("string").alias("source"),
        host_of(url_col).alias("host"),
    )
    return (
        rows.join(winners, "host", "left")
        .select("page_id", "url", "source", "paths")
        .mapInArrow(_extract, f"page_id {kind}, url {link}, text string")
    )
