"""Main text of pages, with the boilerplate of a host found through its suffix array.

A page is cut into blocks.  Text inside an article (or else the main element) is the page's own,
except for what markup names as navigation, advert, form, comment and the like.  All other text
of a host's pages, words and block marks, forms the host's token stream.  Its suffixes are
sorted as far as their first ``LEAST`` tokens: a group of equal beginnings is an interval of
the suffix array whose common prefix is long enough, and if it holds ``SHARE`` of the host's
distinct pages, two at least, the tokens under it are boilerplate.  Runs that no such interval covers are kept, unless
markup excludes them: all of them on pages without an article, and on others those in the main
element, or all if what lies outside it is the larger part.

Passages also repeat across articles, so removing all repeated text would take article text
away; that is why an article protects its text.

Suffix groups are combined before the shuffle, so a host or a phrase with a third of all pages
is a few rows per task.  Null html is an empty page; a page with a null or
odd url has no host, so nothing of it is boilerplate.  Pages of a host with equal texts are one page when
repeats are counted, whatever their ids and urls, and each has its row.  An empty table gives an empty result.
"""

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from urllib.parse import urlsplit

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, slices, small_batches, tidy

LEAST = 8
PAGES = 64  # at once as lists of blocks
SHARE = 0.05  # of the distinct pages of a host, and two at least
OPEN, EXCLUDED, PROTECTED = 0, 1, 2
# Elements by their role in a page.
RAW = "script style noscript template textarea title iframe xmp noembed noframes"
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small"
    " span strike strong sub sup time tt u var wbr".split()
)
AWAY = set("nav footer aside form button select dialog menu svg canvas object head".split())
AWAY_WORDS = set(
    "ad ads advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs comment comments consent cookie"
    " cookies disqus footer gdpr login masthead menu modal nav navbar navigation newsletter notice pagination pager popup"
    " promo promoted promotion related replies share sharing sidebar social sponsor sponsored subscribe topbar widget".split()
)
AWAY_ROLES = set("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split())
ADVERTS = set("ad ads advert adverts advertisement advertising adsense promoted sponsored".split())
COMMENTS = {"comment", "comments"}
# What else names of such parts are made of, places and kinds of boxes.
PARTS = set(
    "site page main primary secondary top bottom left right post entry article global header footer area banner bar block box"
    " button buttons column container content count feed form group icon icons inner item items link links list media message"
    " outer overlay panel posts row section signup slot thread tools unit widget wrap wrapper".split()
)
# Elements that hold the words of a text themselves.
CONTENT = set("p li dt dd tr td th caption blockquote pre figure figcaption address".split()) | INLINE
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>" + RAW.replace(" ", "|") + r")(?=[\s/>])[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?:[!?/]|[a-z])[^>]*(?:>|\Z)",
    re.IGNORECASE | re.DOTALL,
)
_ATTRIBUTE = re.compile(r"([^\s\"'>/=][^\s>/=]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_SITE_HEADER = re.compile(r"(?:site|page)[-_]+header(?:[-_].*)?", re.DOTALL)


@dataclass
class Page:
    """Blocks of a page in order: text, zone and the element they stand in."""

    blocks: list[tuple[str, int, str]] = field(default_factory=list)
    in_main: list[bool] = field(default_factory=list)

    def text(self) -> str | None:
        """The protected blocks, or None if the page has no article or main element with text."""
        own = [t for t, zone, _ in self.blocks if zone == PROTECTED]
        return "\n".join(own) if own else None

    def stream(self) -> list[str]:
        """Words of the other blocks, each block behind the mark of its element."""
        tokens = []
        for text, zone, element in self.blocks:
            if zone != PROTECTED:
                tokens.append(f"<{element}>")
                tokens += text.split()
        return tokens

    def content(self, host: str) -> int:
        """One number for equal texts on one host."""
        return _suffix_key([host, *(text for text, _, _ in self.blocks)])

    def _uncovered(self, covered: set[int]) -> Iterator[tuple[str, int, bool]]:
        """Text, zone and whether it is in main, of the protected blocks and of the open ones without covered tokens."""
        at = 0
        for (text, zone, _), inside in zip(self.blocks, self.in_main, strict=True):
            if zone == PROTECTED:
                yield text, zone, inside
                continue
            words = text.split()
            left = [w for k, w in enumerate(words, at + 1) if k not in covered]
            at += len(words) + 1
            if zone == OPEN and left:
                yield " ".join(left), zone, inside

    def unique(self, covered: set[int]) -> str:
        """The open blocks without the covered tokens of :meth:`stream`."""
        return "\n".join(text for text, zone, _ in self._uncovered(covered) if zone == OPEN)

    def whole(self, covered: set[int]) -> str:
        """The protected blocks and what belongs to the text of the open ones."""
        found = list(self._uncovered(covered))
        sizes = [0, 0]
        for text, zone, inside in found:
            sizes[zone == PROTECTED or inside] += len(text.split())
        larger = sizes[False] > sizes[True]
        return "\n".join(text for text, zone, inside in found if zone == PROTECTED or inside or larger)


def _attributes(attrs: str) -> list[tuple[str, str]]:
    """Names and values in lower case."""
    return [(name.lower(), "".join(values).lower()) for name, *values in _ATTRIBUTE.findall(attrs)] if attrs else []


def _names(token: str) -> set[str]:
    """The words of a class or an id if all of them are known: "share-buttons" names a part, "share-price" none."""
    words = {w for w in re.split("[-_]+", token) if w and not w.isdigit()}
    return words if words <= AWAY_WORDS | PARTS else set()


def _away(tag: str, attrs: str, inside: bool) -> bool:
    """Whether markup names an element as something else than article text.

    Boxes are judged by class and id, elements that hold words only by a class that names an advert, and
    headings, the body and main elements by neither.
    """
    if tag in AWAY or (tag == "header" and not inside):
        return True
    if tag in ("html", "body", "main"):
        return False
    words = COMMENTS if tag == "article" else ADVERTS if tag in CONTENT else set() if tag in HEADINGS else AWAY_WORDS
    for name, value in _attributes(attrs):
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        if name == "role" and value in AWAY_ROLES:
            return True
        if name == "class" or (name == "id" and tag not in CONTENT):
            tokens = value.split()
            if any(_names(t) & words for t in tokens):
                return True
            if tag not in HEADINGS | CONTENT | {"article"} and (any(map(_SITE_HEADER.fullmatch, tokens)) or ("header" in tokens and {"site", "page"} & set(tokens))):
                return True
    return False


def parse(source: str | None) -> Page:
    """Cut a page into blocks; elements that are not closed end with the element around them."""
    page = Page()
    if not source:
        return page
    stack: list[tuple[str, int, str]] = []  # element, zone inside it, container it belongs to
    standing: Counter[str] = Counter()  # elements of the stack
    parts: list[str] = []
    found: list[tuple[str, int, str, str]] = []
    zone, container, heading = OPEN, "", ""

    def close_block() -> None:
        if parts:
            text = " ".join(entities.unescape("".join(parts)).split())
            parts.clear()
            if text:
                # The header of an article holds its title; the rest of it is no text.
                hidden = zone == OPEN and heading == "" and standing["header"] > 0
                found.append((text, EXCLUDED if hidden else zone, container, heading or (stack[-1][0] if stack else "p")))

    done = 0
    for m in _MARKUP.finditer(source):
        if m.start() > done:
            parts.append(source[done : m.start()])
        done = m.end()
        if m["raw"]:
            continue
        tag = (m["tag"] or "").lower()
        if not tag:
            continue
        if tag in INLINE:
            if not m["end"] and tag not in VOID and _away(tag, m["attrs"], bool(container)):
                close_block()
                stack.append((tag, zone, container))
                standing[tag] += 1
                zone = EXCLUDED
            elif m["end"] and stack and stack[-1][0] == tag:
                close_block()
                _, zone, container = stack.pop()
                standing[tag] -= 1
            continue
        close_block()
        if tag in HEADINGS:
            heading = "" if m["end"] else tag
        if tag in VOID:
            continue
        if m["end"]:
            if standing[tag]:
                while True:
                    element, zone, container = stack.pop()
                    standing[element] -= 1
                    if element == tag:
                        break
            continue
        if tag in ("p", "li", "dt", "dd", "tr", "td", "th", "option", "html", "body") and not m["attrs"].strip():
            continue
        if tag in HEADINGS and not m["attrs"].strip():
            continue
        stack.append((tag, zone, container))
        standing[tag] += 1
        if zone != EXCLUDED and _away(tag, m["attrs"], bool(container)):
            zone = EXCLUDED
        elif tag in ("article", "main") or ("role", "main") in _attributes(m["attrs"]):
            container = "article" if tag == "article" or container == "article" else "main"
    if done < len(source):
        parts.append(source[done:])
    close_block()
    best = "article" if any(c == "article" and z == OPEN for _, z, c, _ in found) else "main"
    for text, z, c, element in found:
        own = c == best or (best == "main" and c == "article")
        page.blocks.append((text, PROTECTED if own and z == OPEN else z, element))
        page.in_main.append(c == "main")
    return page


def _host(url: str | None) -> str:
    try:
        return urlsplit(url or "").hostname or ""
    except ValueError:
        return ""


def _suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per page the hashes of the beginnings of its stream's suffixes."""
    for batch in slices(batches, "html"):
        contents, counts, keys = [], [], []
        hosts = [_host(u) for u in batch.column("url").to_pylist()]
        for host, source in zip(hosts, batch.column("html").to_pylist(), strict=True):
            page = parse(source)
            stream = page.stream()
            contents.append(page.content(host))
            counts.append(len(stream))
            width = min(LEAST, len(stream))
            keys.append([_suffix_key(stream[k : k + width]) for k in range(len(stream) - width + 1)] if stream else [])
        columns = [pa.array(contents, pa.int64()), pa.array(hosts, pa.string())]
        columns += [pa.array(counts, pa.int64()), pa.array(keys, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, ["page", "host", "n_stream", "keys"])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per page its blocks, parsed once, to meet what the suffix array found."""
    for batch in slices(batches, "html"):
        pages = [parse(source) for source in batch.column("html").to_pylist()]
        contents = [p.content(_host(u)) for p, u in zip(pages, batch.column("url").to_pylist(), strict=True)]
        blocks = [
            pa.array([[block[0] for block in p.blocks] for p in pages], pa.list_(pa.string())),
            pa.array([[block[1] for block in p.blocks] for p in pages], pa.list_(pa.int32())),
            pa.array([p.in_main for p in pages], pa.list_(pa.bool_())),
        ]
        columns = [pa.array(contents, pa.int64()), batch.column("page_id"), batch.column("url"), *blocks]
        yield pa.RecordBatch.from_arrays(columns, ["page", "page_id", "url", "texts", "zones", "in_main"])


def _suffix_key(tokens: list[str]) -> int:
    return xxhash.xxh3_64_intdigest("\x00".join(tokens)) - 2**63


def _unique_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (whole.slice(k, PAGES) for whole in batches for k in range(0, whole.num_rows, PAGES)):
        texts = []
        names = ("texts", "zones", "in_main", "at", "n_stream")
        for words, zones, in_main, at, n in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
            covered = {k for start in at or [] for k in range(start, start + min(LEAST, n or 0))}
            texts.append(Page([(t, z, "") for t, z in zip(words, zones, strict=True)], in_main).whole(covered))
        columns = [batch.column(c) for c in ("page_id", "url")] + [pa.array(texts, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text"])


def boilerplate(
    spark: SparkSession, pages: DataFrame, *, html: str = "html", url: str = "url", page_id: str = "page_id"
) -> DataFrame:
    """``page, at, n_stream, n_covered`` of the pages with boilerplate outside an article.

    ``at`` are the places in the page's stream where an interval of the host's suffix array
    begins that holds enough distinct pages; ``n_covered`` counts the tokens under them.  ``page`` is
    the number of :meth:`Page.content`.
    """
    small_batches(spark)
    scratch = Scratch(spark, "suffixes")
    rows = _rows(pages, html, url, page_id).select("url", "html")
    parsed = scratch.store(rows.mapInArrow(tidy(_suffixes), "page long, host string, n_stream long, keys array<long>"))
    placed = parsed.filter("host <> ''")
    suffixes = placed.select("page", "host", F.posexplode("keys").alias("at", "key"))
    once = placed.select("host", "page", F.explode(F.array_distinct("keys")).alias("key")).distinct()
    intervals = once.groupBy("host", "key").agg(F.count("*").alias("n")).filter("n > 1")
    hosts = placed.select("host", "page").distinct().groupBy("host").agg(F.count("*").alias("pages"))
    repeated = intervals.join(hosts, "host").filter(F.col("n") >= F.col("pages") * SHARE).select("host", "key")
    covered = suffixes.join(repeated, ["host", "key"]).groupBy("page").agg(F.array_sort(F.collect_set("at")).alias("at"))
    gaps = F.transform("at", lambda p, k: F.least(F.coalesce(F.get("at", k + 1) - p, F.lit(LEAST)), F.lit(LEAST)))
    total = F.aggregate(gaps, F.lit(0).cast("bigint"), lambda a, x: a + x)
    sizes = parsed.groupBy("page").agg(F.max("n_stream").alias("n_stream"))
    found = covered.join(sizes, "page").select("page", "at", "n_stream", F.least(total, "n_stream").alias("n_covered"))
    found = scratch.store(found)
    scratch.drop(parsed)
    return found


def _rows(pages: DataFrame, html: str, url: str, page_id: str) -> DataFrame:
    return pages.select(
        F.col(f"`{page_id}`").alias("page_id"), F.col(f"`{url}`").cast("string").alias("url"), F.col(f"`{html}`").alias("html")
    )


def extract(
    spark: SparkSession, pages: DataFrame, *, html: str = "html", url: str = "url", page_id: str = "page_id"
) -> DataFrame:
    """``page_id, url, text, n_chars`` with one row per row of ``pages``.

    Pages are parsed for their suffixes and again for their blocks, so that no text is stored; the blocks
    of every page meet what the suffix array found on its host.
    """
    found = boilerplate(spark, pages, html=html, url=url, page_id=page_id)
    rows = _rows(pages, html, url, page_id)
    kind = rows.schema["page_id"].dataType.simpleString()
    blocks = "texts array<string>, zones array<int>, in_main array<boolean>"
    parsed = rows.mapInArrow(tidy(_blocks), f"page long, page_id {kind}, url string, {blocks}")
    texts = parsed.join(found, "page", "left").mapInArrow(tidy(_unique_runs), f"page_id {kind}, url string, text string")
    return texts.withColumn("n_chars", F.length("text").cast("bigint"))
