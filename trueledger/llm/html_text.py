"""Main text of web pages by template deduction.

Pages of one host are made from a template, so the template's tokens (elements at their place in the
page) occur equally often in the same pages. A token's occurrence vector has its count on each page of
the host; tokens with the same vector are an equivalence class. Classes that occur on enough pages and
have enough tokens are valid. The class that occurs once on each page is the skeleton; others nest in
the skeleton's elements. What lies between skeleton elements is a slot. Slots that hold prose are kept
for all pages of the host; those that hold links, forms or furniture are not.

Vectors are never gathered: an aggregate of a hash over pages and counts stands for one, so pages are
read where they lie and only a few rows per page and element move, summed before they do.

Defined results: null html is an empty page; a page without main text has an empty one. Pages with a
null url form one host. Repeated rows are pages like others, an empty table stays empty. Text is never
cut. Columns of the input pass through, whatever their names; one named like the output is replaced.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from dataclasses import dataclass, field

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trueledger.llm.common import Batches, slices, stored, texts_of, unused

#: Share of a host's pages that a valid class occurs on, and its least number of tokens.
SUPPORT, CLASS_TOKENS = 0.2, 2
#: Share of link characters above which a slot is a menu.
LINKS = 0.5

#: Elements whose content is no text.
RAW = {"script", "style", "template", "iframe", "textarea", "title", "noscript", "svg", "object", "select", "canvas", "audio", "video"}
#: Elements that make up the page's frame; only these are part of a place.
FRAME = {"html", "head", "body", "header", "nav", "main", "article", "section", "aside", "footer", "div", "form", "table", "ul", "ol", "dl", "menu", "figure", "fieldset", "dialog", "details", "center"}
#: Elements that are never main text.
FURNITURE = {"head", "nav", "aside", "footer", "form", "menu", "fieldset", "dialog"}
#: Words of class and id names that mark furniture.
MARKS = frozenset(
    "ad ads adsense advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices alert popup modal overlay "
    "newsletter subscribe subscription signup login search menu nav navbar navigation breadcrumb breadcrumbs sidebar rail widget widgets footer header masthead toolbar "
    "comment comments respond reply replies disqus discussion share sharing social related recommended recommendations pagination pager tags".split()
)
#: Inside an article only these rule: as any part of a name, and as a name by itself or with nothing but ``PARTS``.
ARTICLE_MARKS = frozenset("adsense advert adverts advertisement advertising comments disqus newsletter".split())
ARTICLE_NAMES = frozenset("ad ads sponsored comment respond subscribe signup login share sharing sidebar navbar breadcrumb breadcrumbs pagination".split())
#: What the rest of a name says where only its first part is one of these.
PARTS = frozenset("slot slots unit units box boxes banner block blocks container wrapper wrap inner outer area section list form bar button buttons link links zone space widget head header footer title top bottom left right 0".split())
#: Controls within a line of text; theirs ends with them or with the block.
CONTROLS = {"button", "label"}
#: Elements that end a block of text.
BLOCKS = FRAME | {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "dt", "dd", "td", "th", "tr", "caption", "blockquote", "pre", "address", "hr", "figcaption", "summary", "legend", "option", "hgroup", "search", "tbody", "thead", "tfoot"}
VOID = {"br", "hr", "img", "input", "meta", "link", "base", "col", "embed", "source", "track", "wbr", "area"}

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?>[^>=]+|=\s*(?:\"[^\"]*\"|'[^']*')?)*+)>|<[!?][^>]*>", re.S)
_NAMED = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_RAW_END = {tag: re.compile(rf"</{tag}\b[^>]*>", re.I) for tag in RAW}


@dataclass
class Page:
    """Blocks of text with their places, and how often each element stands at a place."""

    blocks: list[tuple[str, str]] = field(default_factory=list)
    tokens: Counter = field(default_factory=Counter)
    chars: Counter = field(default_factory=Counter)
    links: Counter = field(default_factory=Counter)


def _component(tag: str, attributes: str) -> str:
    names = " ".join(a or b or c for a, b, c in _NAMED.findall(attributes)) if attributes else ""
    words = sorted(set(re.sub(r"\d+", "0", names.lower()).split()))
    return ".".join([tag, *(w.replace("/", "_").replace(".", "_") for w in words)])


def parse(html: str) -> Page:
    page = Page()
    stack: list[tuple[str, str]] = []
    place, text, in_link, linked, control = "", [], 0, 0, ""

    def flush() -> None:
        nonlocal linked
        block = " ".join(entities.unescape("".join(text)).split())
        if block:
            page.blocks.append((place, block))
            page.chars[place] += len(block)
            page.links[place] += min(linked, len(block))
        text.clear()
        linked = 0

    at, end = 0, len(html)
    while at < end:
        found = _TOKEN.search(html, at)
        piece = html[at : found.start() if found else end]
        if piece and not control:
            text.append(piece)
            linked += len(piece) if in_link else 0
        if not found:
            break
        at = found.end()
        tag = (found[2] or "").lower()
        if not tag:
            continue
        closing = bool(found[1])
        if tag in RAW:
            if not closing:
                stop = _RAW_END[tag].search(html, at)
                at = stop.end() if stop else end
            continue
        if tag == "a":
            in_link = 0 if closing else 1
        elif tag in ("br", "img"):
            text.append(" ")
        elif tag in CONTROLS:
            control = "" if closing else tag
            text.append(" ")
        if tag in BLOCKS:
            flush()
            in_link, control = 0, ""
        if tag in FRAME:
            if closing:
                if any(t == tag for t, _ in stack):
                    while stack.pop()[0] != tag:
                        pass
            else:
                stack.append((tag, _component(tag, found[3])))
            place = "/".join(c for _, c in stack)
        if not closing and tag not in VOID:
            page.tokens[place if tag in FRAME else f"{place}/{tag}"] += 1
    flush()
    return page


def is_furniture(place: str) -> bool:
    """Whether names alone rule a place out; in an article the slot and its share of links decide about most."""
    inside = False
    for part in place.split("/"):
        tag, *names = part.split(".")
        around, inside = inside, inside or tag in ("article", "main")
        if tag in FURNITURE or (tag == "header" and not inside):
            return True
        if tag in ("html", "body", "article", "main"):
            continue
        for n in names:
            words = re.split(r"[-_:]+", n)
            if around:
                named = words[0] in ARTICLE_NAMES and all(w in PARTS or w in ARTICLE_NAMES or not w for w in words[1:])
                if named or any(w in ARTICLE_MARKS for w in words):
                    return True
            elif any(w in MARKS for w in words):
                return True
    return False


def _is_article(place: str) -> bool:
    return any(part.split(".")[0] in ("article", "main") for part in place.split("/"))


def deduce(tokens: list[tuple[str, int, int, int, int, int]], pages: int) -> dict[str, bool]:
    """Skeleton places of a host, and whether the slot that each one opens is main text.

    ``tokens`` has ``(place, pages, count, vector, chars, link chars)`` of every element of the host's pages.
    """
    classes: dict[int, list[tuple]] = {}
    for t in tokens:
        classes.setdefault(t[3], []).append(t)
    skeleton: dict[str, tuple[int, int]] = {}
    for members in classes.values():
        on, count = members[0][1], members[0][2]
        if on >= max(1, SUPPORT * pages) and (len(members) >= CLASS_TOKENS or on == pages) and on == count:
            skeleton |= {m[0]: (0, 0) for m in members if m[0].rpartition("/")[2].split(".")[0] in FRAME}
    # Tokens of other classes nest in the deepest skeleton element around them and fill its slot.
    for place, _, _, _, chars, links in tokens:
        slot = slot_of(place, skeleton)
        if slot is not None:
            a, b = skeleton[slot]
            skeleton[slot] = (a + chars, b + links)
    prose = {s: chars > 0 and links < LINKS * chars and not is_furniture(s) for s, (chars, links) in skeleton.items()}
    articles = {s for s, good in prose.items() if good and _is_article(s)}
    if articles:
        return {s: s in articles for s in skeleton}
    # Without such an element: the slots that hold most of the prose.
    most = max((skeleton[s][0] for s, good in prose.items() if good), default=0)
    return {s: prose[s] and skeleton[s][0] >= 0.25 * most for s in skeleton}


def slot_of(place: str, skeleton: dict) -> str | None:
    """The deepest skeleton element that is ``place`` or around it."""
    while place and place not in skeleton:
        place = place.rpartition("/")[0]
    return place or None


def main_text(page: Page, slots: dict[str, bool]) -> str:
    """The blocks in the host's main slots; a page that fills none of them is judged by itself."""
    kept = [text for place, text in page.blocks if slots.get(slot_of(place, slots) or "", False) and not is_furniture(place)]
    if not kept and page.blocks:
        own = [(p, 1, 1, i, page.chars[p], page.links[p]) for i, p in enumerate(page.tokens.keys() | page.chars.keys())]
        single = deduce(own, 1)
        kept = [text for place, text in page.blocks if single.get(slot_of(place, single) or "", False) and not is_furniture(place)]
    return "\n\n".join(kept)


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def templates(df: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``host, slots``: for each host a map from skeleton place to whether it opens main text."""

    def run(batches: Batches) -> Batches:
        kinds = pa.schema([("host", pa.string()), ("page", pa.string()), ("place", pa.string()), ("n", pa.int64()), ("chars", pa.int64()), ("links", pa.int64())])
        for batch in slices(batches, 200):
            rows: list[tuple] = []
            for host, ident, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts_of(batch.column(2)), strict=True):
                page = parse(text)
                rows += [(host, ident, p, page.tokens[p], page.chars[p], page.links[p]) for p in page.tokens.keys() | page.chars.keys()]
                rows.append((host, ident, "", 1, 0, 0))
            columns = zip(*rows, strict=True) if rows else [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kinds, strict=True)], schema=kinds)

    # A page is told from others by its address and content, and by a number where both repeat.
    page_name = F.concat_ws(" ", F.xxhash64(url, html), F.monotonically_increasing_id())
    pages = df.select(host_of(F.col(f"`{url}`")).alias("host"), page_name.alias("page"), F.col(f"`{html}`"))
    counted = pages.mapInArrow(run, "host string, page string, place string, n long, chars long, links long")
    tokens = counted.groupBy("host", "place").agg(
        F.count("*").alias("pages"), F.sum("n").alias("n"), F.bit_xor(F.xxhash64("page", "n")).alias("vector"), F.sum("chars").alias("chars"), F.sum("links").alias("links")
    )
    stored_tokens = stored(tokens, "page-tokens")
    per_host = stored_tokens.where("place = ''").select("host", F.col("pages").alias("of"))
    frequent = stored_tokens.where("place <> ''").join(per_host, "host").where(F.col("pages") >= SUPPORT * F.col("of"))

    def group(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = list(pdf[["place", "pages", "n", "vector", "chars", "links"]].sort_values("place").itertuples(index=False, name=None))
        return pd.DataFrame({"host": [pdf["host"].iloc[0]], "slots": [deduce(rows, int(pdf["of"].iloc[0]))]})

    return stored(frequent.groupBy("host").applyInPandas(group, "host string, slots map<string, boolean>"), "page-templates")


def extract(df: DataFrame, found: DataFrame, url: str = "url", html: str = "html", out: str = "text") -> DataFrame:
    """``df`` without ``html`` and with ``out``, the main text, by the templates of ``templates``."""
    kept = [f for f in df.schema.fields if f.name not in (html, out)]
    schema = T.StructType([*kept, T.StructField(out, T.StringType())])
    host, slots, page = (unused(df, n) for n in ("host", "slots", "page"))
    hosts = found.select(F.col("host").alias(host), F.col("slots").alias(slots))
    joined = df.withColumns({host: host_of(F.col(f"`{url}`")), page: F.col(f"`{html}`")}).join(hosts, host, "left")

    def run(batches: Batches) -> Batches:
        for batch in slices(batches, 200):
            texts = [main_text(parse(t), dict(s or ())) for t, s in zip(texts_of(batch.column(len(kept))), batch.column(len(kept) + 1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], pa.array(texts, pa.string())], names=schema.fieldNames())

    return joined.select(*[F.col(f"`{f.name}`") for f in kept], page, slots).mapInArrow(run, schema)
