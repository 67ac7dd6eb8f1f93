"""Main text of web pages, from containers on which the pages of a host agree."""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reshard.llm.common import pieces
from reshard.session import broadcast_if_small

# How elements of HTML behave, and the names pages give to what is not the article.
ATTRIBUTE = re.compile(r"\b(class|id|role|hidden)\b(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.IGNORECASE)
CONTAINERS = frozenset("body main article section div td table tr tbody ul ol dl nav header footer aside form blockquote figure center details fieldset".split())
BLOCKS = CONTAINERS | frozenset("p h1 h2 h3 h4 h5 h6 li dt dd th pre hr address caption figcaption summary legend option thead tfoot head html".split())
ATTRIBUTES = r"(?:\"[^\"]*\"|'[^']*'|[^>\"'])*"
# A button or select that is not closed before the next one of its name ends before the next block.
MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<svg\b{ATTRIBUTES}(?<=/)>"
    rf"|<(?P<raw>script|style|noscript|template|textarea|title|iframe|svg)\b{ATTRIBUTES}>.*?(?:</(?P=raw)\s*>|\Z)"
    rf"|<(?P<short>select|button)\b{ATTRIBUTES}>(?:(?:(?!<(?P=short)\b).)*?</(?P=short)\s*>"
    rf"|.*?(?=<(?P=short)\b|</?(?:{'|'.join(sorted(BLOCKS - {'option'}))})\b|\Z))"
    rf"|<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attributes>{ATTRIBUTES})>"
    r"|<[!?/][^>]*>",
    re.DOTALL | re.IGNORECASE,
)
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
DROPPED_TAGS = frozenset("nav footer aside form fieldset".split())
DROPPED_NAMES = frozenset(
    "ad ads adv advert adverts advertisement sponsor sponsored promo banner nav navbar navigation menu breadcrumb breadcrumbs"
    " footer sidebar aside notice notices cookie cookies consent gdpr popup modal overlay alert newsletter subscribe signup login"
    " comment comments reply replies respond disqus share sharing social related recommended pagination pager widget toolbar skip".split()
)
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert".split())
# A name with one of these says what a page has around it, not what the element is.
MODIFIERS = frozenset("has with without no".split())
# Other people's texts, whatever their length.
COMMENT_NAMES = frozenset("comment comments reply replies respond disqus related recommended".split())
LIKELY_NAMES = frozenset("article content main post entry story body text".split())
# A path wins on a host with this share of its pages' votes; the most voted always wins.
LEAST_VOTES = 0.2


@dataclass
class Container:
    """An element that may hold the article: its generalised path, its blocks (place, text) and its score."""

    path: str
    parent: Container | None
    likely: bool
    tag: str = ""
    dropped: bool = False  # not article text
    spared: bool = False  # and that only if the page has its text elsewhere
    worth: float = 0.0  # characters, less those of links
    blocks: list[tuple[int, str]] = field(default_factory=list)
    score: float = 0.0


def _names(attributes: str) -> tuple[list[str], set[str], set[str], bool]:
    """Class names and id; their parts; the parts of those without modifier; whether the element is marked as something else than text."""
    names, parts, plain, dropped = [], set(), set(), False
    for m in ATTRIBUTE.finditer(attributes):
        kind, value = m[1].lower(), html.unescape((m[2] or "").strip("\"'")).lower()
        if kind == "hidden":
            dropped = True
        elif kind == "role":
            dropped |= value in DROPPED_ROLES
        else:
            for name in value.split():
                names.append(("#" if kind == "id" else ".") + re.sub(r"\d+", "0", name))
                own = re.split(r"[-_]+", name)
                parts.update(own)
                plain.update(own if MODIFIERS.isdisjoint(own) else ())
    return names, parts, plain, dropped


def _settled(found: list[Container]) -> list[Container]:
    """Containers that are not left out, with their scores.

    Where no article or main element with text is left, elements left out by their name or as a form stay if they hold
    one, or more than half of the page's text outside of comments.
    """

    def kept() -> list[Container]:
        out: dict[int, bool] = {}
        for c in found:  # parents come before children
            out[id(c)] = not c.dropped and (c.parent is None or out[id(c.parent)])
        return [c for c in found if out[id(c)]]

    below, holds = {id(c): c.worth for c in found}, {id(c): c.tag in ("article", "main") and not c.dropped for c in found}
    hard: dict[int, bool] = {}
    for c in found:
        hard[id(c)] = c.dropped and not c.spared or c.parent is not None and hard[id(c.parent)]
    for c in reversed(found):
        if c.parent is not None and not hard[id(c)]:
            below[id(c.parent)] += below[id(c)]
            holds[id(c.parent)] |= holds[id(c)] and below[id(c)] > 0
    left = kept()
    if not any(c.tag in ("article", "main") and below[id(c)] > 0 for c in left):
        for c in found:
            if c.spared and not hard[id(c)] and (holds[id(c)] or 2 * below[id(c)] > below[id(found[0])]):
                c.dropped = False
        left = kept()
    for c in left:
        score = c.worth * (1.5 if c.likely else 1)
        c.score += score
        if c.parent is not None:
            c.parent.score += score / 2
    return left


def containers_of(page: str) -> list[Container]:
    """All containers of a page with the text blocks they hold, in page order; what is not article text is left out.

    Blocks count fully for their own container and half for the one around it, without the text of links.
    """
    found: list[Container] = []
    stack: list[tuple[str, Container]] = []  # open containers
    here = Container("", None, False)
    found.append(here)
    parts: list[str] = []
    in_link = link_chars = place = 0

    def close_block() -> None:
        nonlocal parts, link_chars, place
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            here.blocks.append((place, text))
            place += 1
            here.worth += max(0, len(text) - 2 * link_chars)
        parts, link_chars = [], 0

    at = 0
    for m in MARKUP.finditer(page):
        if m.start() > at:
            text = page[at : m.start()]
            parts.append(text)
            link_chars += len(text) if in_link else 0
        at = m.end()
        tag = (m["tag"] or "").lower()
        if not tag:
            continue
        if tag == "br":
            parts.append(" ")
        elif tag == "a":
            in_link = 0 if m["end"] else 1
        if tag not in BLOCKS:
            continue
        close_block()
        in_link = 0
        if tag not in CONTAINERS or tag in VOID:
            continue
        if not m["end"]:
            if tag == "body" and any(t == "body" for t, _ in stack):
                continue
            names, words, plain, dropped = _names(m["attributes"])
            inside = any(t in ("article", "main") for t, _ in stack)
            hard = dropped or tag in DROPPED_TAGS - {"form"} or (tag == "header" and not inside) or bool(plain & COMMENT_NAMES)
            dropped = hard or tag in DROPPED_TAGS or bool(plain & DROPPED_NAMES)
            dropped &= tag not in ("body", "article", "main") or "comment" in words
            path = f"{here.path}>{tag}{''.join(sorted(names))}"
            likely = tag in ("article", "main") or bool(words & LIKELY_NAMES)
            here = Container(path, here, likely, tag, dropped, spared=dropped and not hard)
            found.append(here)
            stack.append((tag, here))
        elif any(t == tag for t, _ in stack):
            while stack.pop()[0] != tag:
                pass
            here = stack[-1][1] if stack else found[0]
    parts.append(page[at:])
    close_block()
    return _settled(found)


def best_path(found: list[Container]) -> str | None:
    """Path with the highest score among a page's containers, the first one of equals; sections, lists, tables and the
    like inside an article lead to the article."""
    scores: Counter[str] = Counter()
    for c in found:
        scores[c.path] += c.score
    return climbed(found, max(scores, key=scores.__getitem__)) if any(scores.values()) else None


def climbed(found: list[Container], path: str) -> str:
    """The path, or that of the nearest container around it that is an article, main or likely one itself."""
    inner = next(c for c in found if c.path == path)
    while inner is not None and (not inner.likely or inner.path.startswith(">body") and inner.parent is found[0]):
        inner = inner.parent
    return path if inner is None else inner.path


def text_at(found: list[Container], path: str) -> str:
    """Blocks in and below the containers of a path, in page order."""
    inside: dict[int, bool] = {}
    blocks = []
    for c in found:  # parents come before children
        inside[id(c)] = c.path == path or (c.parent is not None and inside[id(c.parent)])
        blocks += c.blocks if inside[id(c)] else []
    return "\n\n".join(text for _, text in sorted(blocks))


def main_text(page: str, winners: list[str]) -> str:
    """Text at the first winning path that the page has; else at the page's own best container."""
    found = containers_of(page)
    for path in winners:
        if text := text_at(found, path):
            return text
    own = best_path(found)
    return text_at(found, own) if own is not None else ""


def host_votes(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """host, path, votes: each page votes for the path of its best container."""

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "html"):
            votes = Counter()
            for host, page in zip(piece.column("host").to_pylist(), piece.column("html").to_pylist()):
                path = best_path(containers_of(page or ""))
                if path is not None:
                    votes[host, path] += 1
            columns = [pa.array([h for h, _ in votes], pa.string()), pa.array([p for _, p in votes], pa.string()), pa.array(list(votes.values()), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["host", "path", "votes"])

    rows = pages.select(host_of(url_col).alias("host"), F.col(html_col).alias("html"))
    counted = rows.mapInArrow(vote, "host string, path string, votes bigint")
    return counted.groupBy("host", "path").agg(F.sum("votes").alias("votes"))


def host_of(url_col: str) -> Column:
    """Host in lower case; the empty text where there is none."""
    return F.lower(F.coalesce(F.regexp_extract(url_col, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def winning_paths(votes: DataFrame) -> DataFrame:
    """host, winners: paths with enough of the host's votes, most voted first."""
    ranked = votes.groupBy("host").agg(  # at most 1 / LEAST_VOTES paths are kept of a host
        F.sum("votes").alias("all"), F.max("votes").alias("most")
    )
    kept = votes.join(ranked, "host").where((F.col("votes") >= LEAST_VOTES * F.col("all")) | (F.col("votes") == F.col("most")))
    order = F.array_sort(F.collect_list(F.struct((-F.col("votes")).alias("n"), F.col("path"))))
    return kept.groupBy("host").agg(F.transform(order, lambda s: s["path"]).alias("winners"))


def extract_main_text(
    pages: DataFrame, url_col: str = "url", html_col: str = "html", name: str = "text"
) -> DataFrame:
    """All rows and columns, with the main text of each page; a column of that name is replaced.

    The first pass over the pages scores containers and counts votes per host and path; the second takes the text at
    the winning paths of the page's host. Votes are added up before the shuffle, so a host with a third of all pages is
    no hot key; pages are not shuffled while the hosts are few enough to be broadcast, and joined by shuffle above that.

    NULL and empty pages have empty text, NULL urls share the empty host. Whole pages are read, whatever their length.
    Repeated rows are pages of their own.
    """
    winners = broadcast_if_small(winning_paths(host_votes(pages, url_col, html_col)))
    carried = F.struct(*[F.col(f"`{c}`") for c in pages.columns if c not in (name, html_col)])
    kept = F.col(f"`{html_col}`").alias("html")
    rows = pages.select(carried.alias("row"), kept, host_of(url_col).alias("host"))
    rows = rows.join(winners, "host", "left").select("row", "html", "winners")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "html"):
            texts = [main_text(p or "", w or []) for p, w in zip(piece.column("html").to_pylist(), piece.column("winners").to_pylist())]
            yield pa.RecordBatch.from_arrays([piece.column("row"), pa.array(texts, pa.string())], ["row", "text"])

    schema = rows.select("row").schema.add("text", "string")
    return rows.mapInArrow(extract, schema).select("row.*", F.col("text").alias(name))
