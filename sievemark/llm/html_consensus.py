"""Main text of web pages by consensus of a host's pages.

Every page scores its containers by the text that is theirs and no link, and votes for the generalised path
(tags with classes, numbers taken out) of the best one. Votes are counted per host on Spark; each page is
then read again and gives the text of the article around the containers on the winning path of its host, or around
its own best one if it has none there. Navigation, advertising, forms, comments and the like are left out in both passes.

A null or empty page has empty text; a page without url votes with all others without one. Rows are
independent but for the votes, repeated rows vote each. Ties between paths go to more text, then to the
smaller path. Broken markup never fails: unknown end tags are ignored, missing ones are implied, and a tag
or comment cut off at the end of a page is dropped.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable
from html import unescape
from urllib.parse import urlsplit

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievemark.llm.common import append_columns, flat_rows
from sievemark.session import cut_lineage

# Element names by their role in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split()
)
OPAQUE = "script style noscript template svg math iframe object canvas audio video title textarea select button".split()
SKIPPED = frozenset("nav footer aside form menu dialog fieldset head".split())
CLOSED_BY_SAME = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",)}
# Words in class, id or role that mark what is not the article.
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertisements adsense sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert popup modal "
    "overlay newsletter subscribe subscription signup login share sharing social related recommended recommendations sidebar widget widgets menu nav navbar navigation "
    "breadcrumb breadcrumbs pagination pager footer masthead toolbar comment comments commentlist disqus respond reply replies discussion search contentinfo complementary "
    "skip tags taboola outbrain".split()
)
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<opaque>" + "|".join(OPAQUE) + r")\b.*?(?:</(?P=opaque)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?>[^>\"']+|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)|<(?P<tag2>[a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)",
    re.S | re.I,
)
ATTR = re.compile(r"""([a-zA-Z_:-]+)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
MAX_BROADCAST_HOSTS = 100_000
SALT = 16


def _marks(attrs: str) -> tuple[str, bool]:
    """Generalised class of an element, and whether its attributes mark it as no article."""
    found = {k.lower(): v.strip("\"'") for k, v in ATTR.findall(attrs)}
    text = " ".join(found.get(k, "") for k in ("class", "id", "role"))
    words = {w.lower() for w in WORDS.findall(text)}
    hidden = "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", "")
    names = sorted(re.sub(r"\d+", "N", c) for c in found.get("class", "").split())
    return "".join("." + c for c in names), hidden or bool(words & MARKS) or "header" in words and "article" not in words


class _Element:
    __slots__ = ("tag", "path", "skip", "link", "article")

    def __init__(self, tag, path, skip, link, article):
        self.tag, self.path, self.skip, self.link, self.article = tag, path, skip, link, article


def blocks(html: str):
    """(open element paths, text, characters in links) of every block of text that is not left out, in page order."""
    stack = [_Element("", "", False, False, False)]
    parts: list[str] = []
    linked = at = 0

    def flush():
        nonlocal linked
        text = " ".join("".join(parts).split())
        links, linked = linked, 0
        parts.clear()
        if text and not stack[-1].skip:
            return [(tuple(e.path for e in stack if e.tag not in INLINE and e.tag != "p"), text, links)]
        return []

    def add(raw: str):
        nonlocal linked
        if raw and not stack[-1].skip:
            text = unescape(raw)
            parts.append(text)
            if stack[-1].link:
                linked += len(text)

    def close(k: int):
        out = flush() if any(e.tag not in INLINE for e in stack[k:]) else []
        del stack[k:]
        return out

    for m in TOKEN.finditer(html):
        add(html[at : m.start()])
        at = m.end()
        tag = m["tag"] or m["tag2"]
        if not tag:
            continue
        tag = tag.lower()
        if m["end"]:
            k = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag), 0)
            if k:
                yield from close(k)
            continue
        if tag not in INLINE:
            yield from flush()
            if tag == "p" or tag in CLOSED_BY_SAME or tag not in VOID:
                k = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == "p"), 0)
                if k and tag != "br":
                    yield from close(k)
            if tag in CLOSED_BY_SAME:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag in CLOSED_BY_SAME[tag]:
                        break
                    if stack[i].tag == tag or tag in ("dt", "dd") and stack[i].tag in ("dt", "dd"):
                        yield from close(i)
                        break
        if tag in VOID:
            continue
        top = stack[-1]
        label, marked = _marks(m["attrs"] or "") if m["attrs"] else ("", False)
        if tag in ("html", "body"):
            marked = False
        skip = top.skip or marked or tag in SKIPPED or tag == "header" and not top.article
        path = top.path if tag in INLINE or tag in ("html", "body", "p") else f"{top.path}/{tag}{label}"
        stack.append(_Element(tag, path, skip, top.link or tag == "a", top.article or tag == "article" or tag == "main"))
    add(html[at:])
    yield from flush()


def best_path(html: str | None) -> tuple[str, float]:
    """Path of the container with the most text of its own; what is two levels down counts half."""
    return _best_path(blocks(html or ""))


def _best_path(found: Iterable[tuple[tuple[str, ...], str, int]]) -> tuple[str, float]:
    score: dict[str, float] = defaultdict(float)
    for paths, text, links in found:
        gain = len(text) - 2 * links
        own = list(dict.fromkeys(paths))[::-1]
        # Headings, list items and the like hand their text to the container around them.
        for depth, path in enumerate([p for p in own if not LEAF_PATH.search(p)][:2]):
            score[path] += gain / (1 << depth)
    if not score:
        return "", 0.0
    best = max(score, key=lambda p: (score[p], p))
    return best, max(score[best], 0.0)


LEAF_PATH = re.compile(r"/(?:h[1-6]|li|ul|ol|dl|dt|dd|blockquote|pre|td|th|tr|tbody|thead|table|figure|figcaption|hgroup|header|address)[^/]*\Z")
ARTICLE = re.compile(r"/(?:article|main)(?:\.|\Z)")


def extract(html: str | None, path: str | None) -> str:
    """Text of the article around the containers on ``path``, or around the page's best one if it has none there.

    The article is all that ``article`` and ``main`` elements hold if ``path`` lies in one. Otherwise it is what
    is on ``path``, and what lies beside it or beside a container around it and is for less than half links.
    """
    found = list(blocks(html or ""))
    if path is None or not any(path in paths for paths, _, _ in found):
        path = _best_path(found)[0]
    chain = next((list(dict.fromkeys(paths[: paths.index(path) + 1])) for paths, _, _ in found if path in paths), [])
    if any(_is_article(p, up) for up, p in zip(chain, chain[1:])):
        return " ".join(text for paths, text, _ in found if path in paths or any(_is_article(p, up) for up, p in zip(paths, paths[1:])))
    sizes: dict[str, list[int]] = defaultdict(lambda: [0, 0])
    beside = [next((p for p in paths if p not in chain), paths[-1]) for paths, _, _ in found]
    for place, (_, text, links) in zip(beside, found):
        sizes[place][0] += len(text)
        sizes[place][1] += links
    return " ".join(text for place, (paths, text, _) in zip(beside, found) if path in paths or 2 * sizes[place][1] < sizes[place][0])


def _is_article(path: str, around: str) -> bool:
    return bool(ARTICLE.match(path[len(around) :]))


def host_of(url: str | None) -> str:
    try:
        return urlsplit(url or "").hostname or ""
    except ValueError:
        return ""


def host_paths(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(host, path): the path that most pages of a host vote for."""

    def make():
        def run(urls, pages):
            for u, h in zip(urls, pages):
                path, score = best_path(h)
                if score > 0:
                    yield host_of(u), path, score

        return run

    votes = flat_rows(pages, [url, html], "host string, path string, score double", make)
    counts = votes.groupBy("host", "path").agg(F.count("*").alias("n"), F.round(F.sum("score"), 3).alias("score"))
    return counts.groupBy("host").agg(F.max_by("path", F.struct("n", "score", "path")).alias("path"))


def extract_main_text(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """The rows with ``text`` and ``n_chars`` (code points) in place of the html.

    The winning paths are one short row per host; they are broadcast up to a checked number of hosts, beyond
    that hosts are joined with their pages in ``SALT`` pieces each, so a host with very many pages is spread.
    """
    paths = cut_lineage(host_paths(pages, url, html))
    hosted = append_columns(pages, [url], "_host string", lambda: lambda urls: [[host_of(u) for u in urls]])
    paths = paths.select(F.col("host").alias("_h"), F.col("path").alias("_path"))
    if paths.count() <= MAX_BROADCAST_HOSTS:
        joined = hosted.join(F.broadcast(paths), F.col("_host") == F.col("_h"), "left")
    else:
        hosted = hosted.withColumn("_salt", F.pmod(F.xxhash64(html), F.lit(SALT)).cast("int"))
        paths = paths.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
        joined = hosted.join(paths, (F.col("_host") == F.col("_h")) & (F.col("_salt") == F.col("_s")), "left").drop("_salt", "_s")

    def make():
        def run(htmls, wanted):
            texts = [extract(h, p) for h, p in zip(htmls, wanted)]
            return [texts, [len(t) for t in texts]]

        return run

    return append_columns(joined, [html, "_path"], "text string, n_chars bigint", make).drop(html, "_host", "_h", "_path")
