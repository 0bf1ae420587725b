"""Main text of pages by site template removal.

Each page becomes blocks of text and hashes of its element subtrees. Spark counts on how many pages
of a host (equal ones once) each subtree occurs; one that recurs on many of them is template and goes,
with all the text in it. What is left is judged by its elements: menus, headers, footers, sidebars, notices,
adverts, forms and reader comments go by tag, role or class, and where a page marks its article, only
that is taken. Inside an article only boxes of short texts that are on nearly all pages of the host
are template: a passage that many articles quote stays. What holds a marked article is never template.

A class or id inside an article is no proof, since authors name parts of their text like that too. What
it names goes if it recurs on the host as any subtree may, or if it is a box of short texts beside
other text of the article; a fieldset outside forms is judged alike.

A host with a third of all pages is counted by partial sums and joined by (host, subtree), so no task
gets a host. Pages themselves are never shuffled by host.

Defined results: null or empty html gives an empty text; an unclosed element ends with its parent; an
unparsable url makes a host of its own; repeated rows have equal results; a very long page is read whole in one task.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardflow.llm.tables import saved

MIN_PAGES = 4
MIN_SHARE = 0.2
#: Inside a marked article, only boxes without a longer text than this, on so many of the pages.
BOX_WORDS = 30
BOX_SHARE = 0.9
BOX_TAGS = set("div section ul ol dl table".split())

#: Element names by their part in a page.
RAW = "script style noscript template svg iframe object canvas math textarea title".split()
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s "
    "samp small span strike strong sub sup time tt u var img wbr br".split()
)
IN_HEAD = set(RAW) | set("meta link base head".split())
CHROME_TAGS = set("head nav footer aside form button select option dialog menu fieldset".split())
CHROME_ROLES = set("navigation banner contentinfo complementary search form dialog alert menu".split())
CHROME_WORDS = set(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner "
    "menu nav navbar navigation breadcrumb breadcrumbs header masthead footer sidebar aside widget "
    "cookie cookies consent gdpr notice popup modal overlay newsletter subscribe subscription signup "
    "comment comments reply replies disqus share sharing social related recommended login search form "
    "toolbar pagination pager copyright".split()
)
COMMENT_WORDS = set("comment comments reply replies disqus".split())
#: An article's own head; names that tell a wrapper's layout and not its part.
TITLE_WORDS = {"header", "masthead", "banner"}
STATES = ("has-", "with-", "no-", "is-", "layout-", "page-with")
CLOSED_BY = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
}
SCOPE = set("ul ol dl table body html article section div main nav aside footer header form".split())

#: Makes the hash of a box inside an article one byte longer.
BOX = b"b"

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>" + "|".join(RAW) + r")\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*(?<!/)>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<[!?/][^>]*>"
    r"|(?P<text>[^<]+|<)",
    re.S | re.I,
)
#: For what follows a tag that does not end before the page does: quotes mean nothing there, so that
#: no quote without a partner is looked for again and again up to the end.
PLAIN_TOKEN = re.compile(
    r"<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/<>]*)(?P<attrs>[^<>]*)>|<[!?/][^<>]*>|(?P<text>[^<]+|<)", re.S | re.I
)
NAMES = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
PARTS = re.compile(r"[a-z]+")

SCHEMA = (
    "page_id long, url string, host string, row long, page binary, spots array<binary>, text string, "
    "blocks array<struct<text:string,within:array<int>>>"
)


class _Element:
    __slots__ = ("tag", "main", "chrome", "within", "spot", "parts", "article", "doubts")

    def __init__(self, tag: str, main: int, chrome: int, within: list[int], spot: int | None):
        self.tag, self.main, self.chrome = tag, main, chrome
        self.within, self.spot, self.parts = within, spot, []
        self.article = False
        self.doubts: tuple[int, ...] = ()


def _chrome(tag: str, attrs: str, in_main: bool) -> int:
    """Whether the element is no article text: 0 no, 1 by its class or as a form, which may also wrap
    the whole page, 2 by its tag or role or as reader comments."""
    if tag in CHROME_TAGS - {"form"} or (tag == "header" and not in_main):
        return 2
    found = int(tag == "form")
    for name, a, b, c in NAMES.findall(attrs):
        value = (a or b or c).lower()
        if name.lower() == "role":
            if value in CHROME_ROLES:
                return 2
        elif tag not in ("body", "html", "article", "main"):
            for word in value.split():
                parts = PARTS.findall(word)
                if word.startswith(STATES) or not parts:
                    continue
                if COMMENT_WORDS.intersection((parts[0], parts[-1])):
                    return 2
                if CHROME_WORDS.intersection((parts[-1], "".join(parts))) - (TITLE_WORDS if in_main else set()):
                    found = 1
    return found


def _tokens(source: str) -> Iterator[re.Match[str]]:
    at, pattern = 0, TOKEN
    while m := pattern.match(source, at):
        if pattern is TOKEN and m["text"] == "<" and source[m.end() : m.end() + 1].isalpha():
            pattern = PLAIN_TOKEN
        else:
            at = m.end()
            yield m


def parse(source: str) -> tuple[list[bytes | None], list[tuple[str, int, int, list[int]]], int]:
    """Hashes of the subtrees that may be template, and the blocks: text, whether in a marked
    article, whether in an element that is no article text, and the subtrees it is in."""
    root = _Element("", 0, 0, [], None)
    stack = [root]
    spots: list[bytes] = []
    blocks: list[tuple[str, int, int, list[int], tuple[int, ...]]] = []
    text: list[str] = []
    #: for each element that only its name speaks against: whether it is a box of short texts
    short: list[bool] = []
    has_main = 0
    held: set[int] = set()
    boxes: set[int] = set()

    def flush() -> None:
        if text:
            words = " ".join(html.unescape("".join(text)).split())
            text.clear()
            if words:
                top = next(e for e in reversed(stack) if e.tag not in INLINE)
                top.parts.append(words)
                if words.count(" ") >= BOX_WORDS:
                    held.update(boxes.intersection(stack[-1].within))
                    for d in stack[-1].doubts:
                        short[d] = False
                blocks.append((words, stack[-1].main, stack[-1].chrome, stack[-1].within, stack[-1].doubts))

    def close() -> None:
        e = stack.pop()
        if e.tag in INLINE:
            return
        digest = hashlib.blake2b("\0".join([e.tag, *e.parts]).encode("utf-8", "replace"), digest_size=12).digest()
        parent = next(x for x in reversed(stack) if x.tag not in INLINE)
        parent.parts.append(digest.hex())
        if e.spot is not None:
            spots[e.spot] = digest + BOX if e.spot in boxes else digest

    def close_through(names: set[str], stop: set[str]) -> None:
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag in names:
                while len(stack) > k:
                    close()
                return
            if stack[k].tag in stop:
                return

    for m in _tokens(source):
        if m["text"] is not None:
            if stack[-1].tag == "head" and m["text"].strip():
                close()
            text.append(m["text"])
            continue
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        # a head without an end tag ends where anything else begins
        if stack[-1].tag == "head" and not m["end"] and tag not in IN_HEAD:
            close()
        if tag == "br":
            text.append(" ")
            continue
        if tag not in INLINE:
            flush()
        if m["end"]:
            if tag not in VOID and any(e.tag == tag for e in stack[1:]):
                close_through({tag}, set())
            continue
        if tag in VOID:
            continue
        if tag not in INLINE:
            close_through({"p"}, SCOPE)
            if tag in CLOSED_BY:
                close_through(CLOSED_BY[tag], SCOPE - {"div"})
        if m["attrs"].endswith("/"):
            continue
        up = stack[-1]
        found = _chrome(tag, m["attrs"], up.main > 0)
        doubtful = up.article and tag not in INLINE and (tag == "fieldset" or (found == 1 and tag != "form"))
        chrome = max(up.chrome, 0 if doubtful else found)
        main = up.main
        if not main and chrome < 2:
            if tag in ("article", "main") or re.search(r"role\s*=\s*[\"']?main\b", m["attrs"]):
                # 1 inside such a wrapper: taken where the page marks no other
                main, chrome = 2 - chrome, 0
        article = up.article or (main > 0 and tag == "article")
        if (main and not up.main) or (article and not up.article):
            held.update(up.within)
        has_main = max(has_main, main)
        spot, within = None, up.within
        is_mark = (main and not up.main) or (article and not up.article)
        if tag not in INLINE and not is_mark and tag not in ("html", "body") and (not article or doubtful or tag in BOX_TAGS):
            if article and not doubtful:
                boxes.add(len(spots))
            spot = len(spots)
            spots.append(b"")
            within = [*within, spot]
        stack.append(_Element(tag, main, chrome, within, spot))
        stack[-1].article, stack[-1].doubts = article, up.doubts
        if doubtful:
            stack[-1].doubts += (len(short),)
            short.append(tag in BOX_TAGS or tag == "fieldset")
    flush()
    while len(stack) > 1:
        close()
    # boxes of short texts go, but not all that an article has
    if any(main == has_main and not chrome and not any(short[d] for d in doubts) for _, main, chrome, _, doubts in blocks):
        blocks = [(t, main, max(chrome, *(short[d] for d in doubts), 0), within, ()) for t, main, chrome, within, doubts in blocks]
    # what holds a marked article is no template
    out = [(t, main, int(chrome), [w for w in within if w not in held]) for t, main, chrome, within, _ in blocks]
    return [None if i in held else d for i, d in enumerate(spots)], out, has_main


def _host(url: str | None) -> str:
    try:
        return (urlsplit(url or "").hostname or "").lower()
    except ValueError:
        return ""


def candidates(source: str) -> tuple[list[bytes | None], list[tuple[str, list[int]]]]:
    """Hashes of the subtrees, and the blocks that are article text unless a template holds them."""
    spots, blocks, has_main = parse(source)
    return spots, [(text, within) for text, main, chrome, within in blocks if not chrome and main == has_main]


def _parsed(pages: DataFrame) -> DataFrame:
    """One row for each page. `text` is there where no template can change it, else `blocks` are."""
    block = pa.struct([("text", pa.string()), ("within", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                ids, urls, sources, rows = batch.slice(at, 1000).columns
                spots, texts, blocks, contents = [], [], [], []
                for source in sources:
                    found, kept = candidates(source.as_py() or "")
                    is_open = any(within for _, within in kept)
                    spots.append(found)
                    content = "\0".join([text for text, _ in kept]).encode("utf-8", "replace")
                    contents.append(hashlib.blake2b(content, digest_size=12).digest())
                    texts.append(None if is_open else "\n".join([text for text, _ in kept]))
                    blocks.append([{"text": t, "within": w} for t, w in kept] if is_open else None)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids, urls, pa.array([_host(u) for u in urls.to_pylist()], pa.string()), rows,
                        pa.array(contents, pa.binary()), pa.array(spots, pa.list_(pa.binary())), pa.array(texts, pa.string()), pa.array(blocks, pa.list_(block)),
                    ],
                    names=["page_id", "url", "host", "row", "page", "spots", "text", "blocks"],
                )

    return pages.mapInArrow(run, SCHEMA)


def templates(parsed: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """host, spot: the subtrees that recur on many pages of the host. Pages of equal content count once."""
    once = parsed.groupBy("host", "page").agg(F.min("row").alias("row"))
    seen = (
        parsed.join(once.select("row"), "row", "left_semi")
        .select("host", F.explode(F.array_distinct("spots")).alias("spot"))
        .where(F.col("spot").isNotNull())
        .groupBy("host", "spot")
        .agg(F.count("*").alias("pages"))
        .where(F.col("pages") >= min_pages)
    )
    hosts = once.groupBy("host").agg(F.count("*").alias("of"))
    share = F.when(F.length("spot") > 12, max(BOX_SHARE, min_share)).otherwise(min_share)
    return seen.join(hosts, "host").where(F.col("pages") >= share * F.col("of")).select("host", "spot")


def extract(
    pages: DataFrame,
    id: str = "page_id",
    url: str = "url",
    source: str = "html",
    min_pages: int = MIN_PAGES,
    min_share: float = MIN_SHARE,
) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    parsed = saved(
        _parsed(
            pages.select(
                F.col(id).cast("long").alias("page_id"),
                F.col(url).cast("string").alias("url"),
                F.col(source).alias("html"),
                F.monotonically_increasing_id().alias("row"),
            )
        ),
        "parsed-pages",
    )
    undecided = parsed.where(F.col("text").isNull())
    spots = undecided.select("row", "host", F.posexplode("spots").alias("at", "spot"))
    found = (
        spots.join(templates(parsed, min_pages, min_share), ["host", "spot"])
        .groupBy("row")
        .agg(F.collect_list("at").alias("template"))
    )
    kept = F.filter(
        "blocks", lambda b: F.col("template").isNull() | ~F.arrays_overlap(b["within"], F.col("template"))
    )
    joined = F.array_join(F.transform(kept, lambda b: b["text"]), "\n")
    decided = undecided.join(found, "row", "left").select("page_id", "url", joined.alias("text"))
    return (
        parsed.where(F.col("text").isNotNull())
        .select("page_id", "url", "text")
        .unionByName(decided)
        .withColumn("n_chars", F.length("text").cast("long"))
    )
