"""Main text of web pages by equivalence-class template deduction.

1. A tolerant tokenizer turns the whole html into elements and text blocks.  A
   token is an element's path (names with their class, id and role) or a text
   block outside the article and the content element; inline markup and the
   text of the article or content element are data, not tokens.
2. A token's occurrence vector says how often it occurs on each page of its
   host.  Vectors are compared by a sum of per-page hashes, so they are gathered
   by a plain aggregation whatever the number of pages of a host.  Pages of a
   host with the same html are one page.
3. Tokens of a host with equal vectors form an equivalence class.  A class is
   valid if it is frequent (MIN_PAGES pages), holds markup, and the text that
   roles keep differs between its pages, so copies of one page are no evidence.
4. Classes are checked on the order of the tokens of every page.  An ordered class
   repeats its tokens in one order, one occurrence after the other; tokens that
   change their place leave it, and a class whose occurrences interleave is dropped.
   Two classes are nested if every occurrence of one lies apart from the other or
   between two consecutive tokens of it; of two that are not, the one on fewer pages, then
   with fewer tokens, is dropped.  The classes left are the host's template: text tokens in
   them are text that the template prints.
5. What the template leaves are slots, each with the path of its elements.  The
   article's slots give the main text; without an article element, the slots of
   the content element or the body that are not boilerplate, less template text.

A slot's role comes from the elements around it, because on these pages menus,
adverts and footers differ from page to page: occurrence vectors alone would
call them data.  On hosts with few pages no class is frequent and roles decide.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patchlens.llm.common import bounded_broadcast, settle

#: Pages of a host on which a class must occur to count as template.
MIN_PAGES = 5

# --- fixed values: element roles of HTML ---
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby "
             "s samp small span strike strong sub sup time tt u var wbr".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script|style|textarea|title|noscript|iframe|noembed|noframes|xmp|template"
DROPPED = set("script style textarea title noscript iframe noembed noframes xmp template head nav aside footer form "
              "button select option datalist menu dialog object embed svg canvas audio video map".split())
SITE_ONLY = {"header"}
ENDS_P = set("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
             "header hr main menu nav ol p pre section table ul".split())
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
            "th": {"td", "th"}, "option": {"option"}}
SCOPES = set("ul ol dl table article section div body html main aside nav footer header form blockquote".split())
BOILERPLATE = set("ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner "
                  "cookie cookies consent gdpr notice notices alert alerts popup modal overlay newsletter subscribe "
                  "subscription signup sidebar rail widget widgets menu menus nav navbar navigation navi breadcrumb "
                  "breadcrumbs toolbar footer comment comments commentlist respond disqus replies share sharing social "
                  "related recommended recommendations pagination pager login search skip disclaimer".split())
#: Whole class names and ids, of elements that hold others, that are never part of an article.
NEVER_ARTICLE = set("comment comments comment-list commentlist comments-area comments-section reply replies respond disqus "
                    "disqus_thread related related-posts related-articles teaser".split())
NEVER_ARTICLE_IDS = set("comments comment-list comments-area comments-section respond disqus_thread related-posts".split())
#: The same inside an article or content element, where all else is kept.
NOT_IN_ARTICLE = set("ad ads advert adverts advertisement advertising adsense sponsored promo newsletter subscribe signup notice notices "
                     "cookie-notice cookie-banner sidebar share sharing share-buttons social-share breadcrumb breadcrumbs pagination".split())
NOT_IN_ARTICLE_IDS = set("newsletter sidebar cookie-notice cookie-banner".split())
HOLDERS = set("div section ul ol li dl article header footer main".split())
SITE_BOILERPLATE = set("header masthead topbar".split())
ROLES = set("navigation contentinfo complementary search dialog alertdialog alert form menu menubar".split())
SITE_ROLES = {"banner"}
CONTENT = set("content article post story entry maincontent articlebody postbody entrycontent articlecontent "
              "postcontent maintext".split())

_TAG = re.compile(
    rf"<!--(?:>|->|.*?(?:--!?>|$))|<(?P<raw>{RAW})\b(?P<rawattrs>(?:\"[^\"]*\"|'[^']*'|[^'\">])*)>.*?(?:</(?P=raw)\s*[^>]*>|$)"
    r"|<(?P<end>/?)(?P<name>[a-z][^\s/>]*)(?P<attrs>(?:\"[^\"]*\"|'[^']*'|[^'\">])*)>|<(?P<end2>/?)(?P<name2>[a-z][^\s/>]*)[^>]*>"
    r"|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?/][^>]*(?:>|$)",
    re.IGNORECASE | re.DOTALL)
_ATTR = re.compile(r"([^\s=\"'>/]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_MASK = (1 << 63) - 1
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")


@dataclass(slots=True)
class Element:
    name: str
    path: str
    dropped: int  # 0 kept; 1 under a name that may only describe a layout; 2 under an element or name that never holds an article
    article: bool  # inside an article element
    content: bool  # inside another element that marks the content


def _marks(attrs: str) -> dict[str, str]:
    return {m[1].lower(): entities.unescape(m[2] or m[3] or m[4] or "") for m in _ATTR.finditer(attrs)} if "=" in attrs else {}


def _words(value: str) -> set[str]:
    return {w.lower() for w in _WORD.findall(value)}


def _element(name: str, marks: dict[str, str], parent: Element) -> Element:
    names = " ".join(marks[k] for k in ("class", "id") if k in marks)
    role = marks.get("role", "").lower()
    site = not parent.article  # page headers and banners; inside an article they hold its title
    classes, own_id = set(marks.get("class", "").lower().split()), marks.get("id", "").strip().lower()
    holds = name in HOLDERS
    own = 0
    if name in DROPPED or role in ROLES or site and (name in SITE_ONLY or role in SITE_ROLES):
        own = 2
    elif holds and (classes & NEVER_ARTICLE or own_id in NEVER_ARTICLE_IDS):
        own = 2
    elif parent.article or parent.content:
        # whole names only: the text of an article may be about adverts, shares or searching
        own = 1 if holds and (classes & NOT_IN_ARTICLE or own_id in NOT_IN_ARTICLE_IDS) else 0
    elif names and name not in ("html", "body", "main", "article"):
        words = _words(names)
        own = 1 if words & BOILERPLATE or words & SITE_BOILERPLATE else 0
    around = 0 if name == "article" and parent.dropped == 1 else parent.dropped
    content = name == "main" or role == "main" or marks.get("itemprop", "").lower() == "articlebody" or any(
        re.sub(r"[^a-z]", "", c.lower()) in CONTENT for c in names.split())
    path = f"{parent.path}>{name}" + "".join(f"[{marks[k]}]" for k in ("class", "id", "role") if k in marks)
    return Element(name, path, max(own, around), parent.article or name == "article" or role == "article", parent.content or content)


def _closes(stack: list[Element], names: set[str], stop: set[str]) -> None:
    """Close the innermost of ``names`` unless an element of ``stop`` lies between."""
    for k in range(len(stack) - 1, 0, -1):
        if stack[k].name in names:
            del stack[k:]
            return
        if stack[k].name in stop:
            return


def blocks(html: str | None) -> Iterator[tuple[Element, str | None]]:
    """(element, None) where an element starts and (element around it, text) for each text block, in page order."""
    html = html or ""
    stack = [Element("", "", 0, False, False)]
    parts: list[str] = []
    at = 0

    def flush():
        text = " ".join(entities.unescape("".join(parts)).split())
        parts.clear()
        return text

    for m in _TAG.finditer(html):
        if m.start() > at:
            parts.append(html[at: m.start()])
        at = m.end()
        raw = m["raw"]
        name = (raw or m["name"] or m["name2"] or "").lower()
        if not name or raw and raw.lower() in DROPPED or name in INLINE:
            continue
        text = flush()
        if text:
            yield stack[-1], text
        if m["end"] or m["end2"]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].name == name:
                    del stack[k:]
                    break
            continue
        if name in ENDS_P:
            _closes(stack, {"p"}, SCOPES)
        if name in SIBLINGS:
            _closes(stack, SIBLINGS[name], SCOPES)
        element = _element(name, _marks(m["attrs"] or ""), stack[-1])
        yield element, None
        attrs = m["attrs"] or ""
        if name not in VOID and not (attrs.endswith("/") and name in ("svg", "path")):
            stack.append(element)
    if at < len(html):
        parts.append(html[at:])
    text = flush()
    if text:
        yield stack[-1], text


def page_tokens(html: str | None) -> tuple[list[tuple[str, str]], int]:
    """The tokens of the page in its order, and a hash of the text that the roles of its elements keep.

    A token is (element path, '') or (path of a block outside the article and the content element, its text).
    """
    found = []
    kept = 0
    for element, text in blocks(html):
        if text is None:
            found.append((element.path, ""))
            continue
        if not (element.article or element.content):
            found.append((element.path, text))
        if not element.dropped:
            kept = (kept * 1_000_003 + _hash(text)) & _MASK
    return found, kept


def places(tokens: list[int], class_of: dict[int, int]) -> Iterator[tuple[int, int, int, int, bool]]:
    """(class, token, its first and last place in the class's occurrences, whether these follow one another) on one page."""
    seen: dict[int, list[int]] = defaultdict(list)
    for t in tokens:
        if t in class_of:
            seen[class_of[t]].append(t)
    for c, order in seen.items():
        k = len(set(order))
        whole = len(order) % k == 0 and all(len(set(order[i: i + k])) == k for i in range(0, len(order), k))
        at: dict[int, list[int]] = defaultdict(list)
        for i, t in enumerate(order):
            at[t].append(i % k)
        for t, found in at.items():
            yield c, t, min(found), max(found), whole


def crossed(tokens: list[int], member: dict[int, tuple[int, int, int, int]]) -> set[int]:
    """The weaker class of each two that are not nested on a page; ``member``: class, place, tokens and pages by token."""
    weaker: set[int] = set()
    strength: dict[int, tuple] = {}
    opened: list[int] = []
    for t in tokens:
        if t not in member:
            continue
        c, place, size, pages = member[t]
        strength[c] = (pages, size, c)
        if size == 1:
            continue
        if place == 0:
            opened.append(c)
            continue
        if c not in opened:
            continue
        k = opened.index(c)
        # an occurrence that began after c's last token must have ended before this one
        weaker.update(min(c, d, key=strength.get) for d in opened[k + 1:])
        if place == size - 1:
            del opened[k]
    return weaker


def token_key(path: str, text: str) -> str:
    return f"{path}\n{text}" if text else path


def main_text(html: str | None, template: set[str] = frozenset()) -> str:
    """The main text of a page; ``template`` holds the keys of text that the host's template prints."""
    kept: list[tuple[bool, bool, str]] = []
    has_article = has_content = False
    for element, text in blocks(html):
        if element.dropped:
            continue
        has_article |= element.article
        has_content |= element.content
        if text is not None and (element.article or element.content or token_key(element.path, text) not in template):
            kept.append((element.article, element.content, text))
    if has_article:
        return " ".join(t for a, _, t in kept if a)
    if has_content:
        return " ".join(t for _, c, t in kept if c)
    return " ".join(t for _, _, t in kept)


def host_of(url: F.Column) -> F.Column:
    """The url's host in lower case (null or without one: empty, a group of its own)."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def _hash(key: str) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(key.encode("utf-8", "surrogatepass"), 0) - (1 << 63)


def distinct_pages(pages: DataFrame) -> DataFrame:
    """host, page (hash of the html) and html, once for each html of a host.  Only html that repeats is shuffled."""
    narrow = pages.select(host_of(F.col("url")).alias("host"), F.xxhash64(F.coalesce("html", F.lit(""))).alias("page"), "html")
    keys = ["host", "page"]
    repeated = settle(narrow.groupBy(*keys).count().filter("count > 1").select(*keys))
    repeated = bounded_broadcast(repeated, 100 * repeated.count())
    return narrow.join(repeated, keys, "left_anti").unionByName(narrow.join(repeated, keys, "left_semi").dropDuplicates(keys))


def _over_pages(rows: DataFrame, fn, schema: str) -> DataFrame:
    """The rows that ``fn`` yields for each row of ``rows``, given as its values."""
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            types = dict(string=pa.string(), long=pa.int64(), int=pa.int32(), boolean=pa.bool_())
            types |= {f"array<{t}>": pa.list_(v) for t, v in list(types.items())}
            kinds = [types[f.split()[1]] for f in schema.split(", ")]
            for i in range(0, b.num_rows, 256):
                out = [r for values in zip(*(c.to_pylist() for c in b.slice(i, 256).columns)) for r in fn(*values)]
                cols = list(zip(*out)) if out else [[]] * len(kinds)
                yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(cols, kinds)], names=names)

    return rows.mapInArrow(run, schema)


def _with_classes(pages: DataFrame, members: DataFrame, *cols: str) -> DataFrame:
    """host and tokens of each page with its host's classes: an array of ``cols`` of the members."""
    of_host = settle(members.groupBy("host").agg(F.collect_list(F.struct(*cols)).alias("members")))
    size = of_host.agg(F.sum(F.size("members") * 8 * len(cols) + 100)).first()[0] or 0
    fields = [F.col("members")[c].alias(c) for c in cols]
    return pages.select("host", "tokens").join(bounded_broadcast(of_host, size), "host").select("host", "tokens", *fields)


def candidate_classes(pages: DataFrame, min_pages: int) -> DataFrame:
    """The frequent equivalence classes that hold markup and whose pages' text differs: host, class_id, pages, token, is_text."""
    def counts(host, page, tokens, texts, kept):
        return ((host, page, t, x, n, kept) for (t, x), n in Counter(zip(tokens, texts)).items())

    tokens = _over_pages(pages.select("host", "page", "tokens", "texts", "kept"), counts,
                         "host string, page long, token long, is_text boolean, n int, kept long")
    vectors = tokens.groupBy("host", "token", "is_text").agg(
        F.count(F.lit(1)).alias("pages"), F.sum(F.xxhash64("page", "n").cast("decimal(38,0)")).alias("vector"),
        (F.min("kept") != F.max("kept")).alias("differs"))
    vectors = vectors.filter(F.col("pages") >= min_pages)
    member = F.struct("token", "is_text")
    classes = vectors.groupBy("host", "pages", "vector").agg(F.collect_list(member).alias("members"),
                                                             F.bool_or(~F.col("is_text")).alias("has_markup"),
                                                             F.bool_or("differs").alias("differs"))
    return classes.filter("has_markup and differs").select("host", F.xxhash64("host", "vector").alias("class_id"), "pages",
                                               F.inline("members"))


def ordered_classes(pages: DataFrame, members: DataFrame) -> DataFrame:
    """``members`` of ordered classes, with ``place`` (from 0) and ``size``; what is left without markup is no class."""
    def of_page(host, tokens, token, class_id):
        return ((host, *found) for found in places(tokens, dict(zip(token, class_id))))

    found = _over_pages(_with_classes(pages, members, "token", "class_id"), of_page,
                        "host string, class_id long, token long, lo int, hi int, whole boolean")
    keys = ["host", "class_id", "token"]
    steady = found.groupBy(*keys).agg(F.min("lo").alias("at"), F.max("hi").alias("hi"), F.bool_and("whole").alias("whole"))
    kept = members.join(steady.filter("whole and at = hi").select(*keys, "at"), keys)
    member = F.struct("at", "token", "is_text")
    of_class = kept.groupBy("host", "class_id", "pages").agg(F.array_sort(F.collect_list(member)).alias("members"),
                                                             F.bool_or(~F.col("is_text")).alias("has_markup"))
    placed = of_class.filter("has_markup").select("host", "class_id", "pages", F.size("members").alias("size"), F.posexplode("members"))
    return placed.select("host", "class_id", "pages", "size", F.col("pos").alias("place"), "col.token", "col.is_text")


def nested_classes(pages: DataFrame, members: DataFrame) -> DataFrame:
    """``members`` without the weaker of each two classes that are not nested on some page."""
    def of_page(host, tokens, token, *about):
        return ((host, c) for c in crossed(tokens, dict(zip(token, zip(*about)))))

    weaker = _over_pages(_with_classes(pages, members, "token", "class_id", "place", "size", "pages"), of_page, "host string, class_id long")
    return members.join(weaker.distinct(), ["host", "class_id"], "left_anti")


def template_classes(pages: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """The valid equivalence classes: host, class_id, pages (of different html), size, place, token (hash), is_text."""
    def sequence(host, page, html):
        found, kept = page_tokens(html)
        return [(host, page, [_hash(token_key(*t)) for t in found], [bool(t[1]) for t in found], kept)]

    # pages are parsed once; the checks read their token hashes
    seen = settle(_over_pages(distinct_pages(pages).select("host", "page", "html"), sequence,
                              "host string, page long, tokens array<long>, texts array<boolean>, kept long"))
    return nested_classes(seen, settle(ordered_classes(seen, settle(candidate_classes(seen, min_pages)))))


def template_text(pages: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, template): hashes of the text that each host's template prints (no more than one page holds)."""
    found = template_classes(pages, min_pages).filter("is_text")
    return found.groupBy("host").agg(F.collect_list("token").alias("template"))


class _Keys:
    """Membership of a token key in a set of hashes."""

    def __init__(self, hashes):
        self.hashes = set(hashes or ())

    def __contains__(self, key: str) -> bool:
        return bool(self.hashes) and _hash(key) in self.hashes


def extract(pages: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """One row per page: page_id, url, text, n_chars.

    Null or empty html gives an empty text.  Pages without a host are grouped
    together.  Repeated rows stay; an empty table gives an empty result.
    """
    templates = settle(template_text(pages, min_pages))
    size = templates.agg(F.sum(F.size("template") * 8 + 100)).first()[0] or 0
    rows = pages.select("page_id", "url", "html").withColumn("host", host_of(F.col("url")))
    joined = rows.join(bounded_broadcast(templates, size), "host", "left").select("page_id", "url", "html", "template")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(h.as_py(), _Keys(t.as_py())) for h, t in zip(b.column(2), b.column(3))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, type=pa.string())], names=["page_id", "url", "text"])

    schema = joined.select("page_id", "url").schema.add("text", "string")
    return joined.mapInArrow(run, schema).withColumn("n_chars", F.length("text").cast("bigint"))
