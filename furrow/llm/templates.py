"""Main text of web pages: elements that recur across a host's pages, and those that frame an article, are left out."""

from __future__ import annotations

import html
import re

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from furrow.llm.common import kept, partitions, query, table
from furrow.session import scratch_path

# HTML's element classes
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template xmp noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q ruby rb rt rp s samp small span "
    "strike strong sub sup time tt u var wbr picture source".split())
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr main menu nav ol p pre search section summary table ul li dd dt tr td th tbody thead tfoot body".split())
SAME_LEVEL = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table", "tbody", "thead", "tfoot"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}), "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
}

# what frames an article, by element, role and words of its class or id
FRAME_TAGS = frozenset(
    "nav footer aside form script style noscript iframe svg math button select menu dialog template object canvas head title "
    "input textarea map audio video search fieldset datalist".split())
FRAME_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
FRAME_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices "
    "sidebar menu navbar nav navigation breadcrumb breadcrumbs footer masthead comment comments commentlist disqus reply replies respond "
    "share sharing social related recommended newsletter subscribe subscription signup login popup modal overlay widget pagination pager "
    "skip toolbar alert".split())
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6", "hgroup"))
CONTENT_TAGS = frozenset(("article", "main"))

LEAST_PAGES, LEAST_PAGES_INSIDE = 5, 10  # contents of a host that share an element, whatever the host's size
SHORT = 8  # characters; an element with fewer recurs by chance, so it counts together with the block beside it
SALTS = 32  # parts of a recurring element's rows
MOST_LINKED = 0.6

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
_ATTRIBUTE = re.compile(r"""([a-zA-Z_:][-\w:.]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_WORD = re.compile(r"[a-z]+")


def _frames(tag: str, attributes: str, in_content: bool) -> bool:
    if tag in FRAME_TAGS or (tag == "header" and not in_content):
        return True
    if not attributes.strip(" /"):
        return False
    values = {k.lower(): v.strip("\"'").lower() for k, v in _ATTRIBUTE.findall(attributes)}
    if "hidden" in values or values.get("aria-hidden") == "true" or "display:none" in values.get("style", "").replace(" ", ""):
        return True
    if values.get("role") in FRAME_ROLES:
        return True
    if tag in ("html", "body", "article", "main") and not in_content:
        return False
    return not FRAME_WORDS.isdisjoint(_WORD.findall(values.get("class", "") + " " + values.get("id", "")))


class _Element:
    __slots__ = ("tag", "framed", "content", "heading", "digest", "blocks", "block")

    def __init__(self, tag: str, framed: bool, content: bool, heading: bool, block: bool):
        self.tag, self.framed, self.content, self.heading, self.block = tag, framed, content, heading, block
        self.digest = xxhash.xxh3_64(tag)
        self.blocks: list[int] = []


def _signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


def parse(page: str) -> tuple[bool, list[tuple[str, list[int]]]]:
    """(whether the page marks its content, blocks of text): each block's text and the hashes of the elements around it.

    An element's hash covers its name, its text and its children; one with little text has two, with the text of the block
    before and of the one after it, and none at the edges of the page's text. Framing elements, mark-up and comments yield no block;
    where an ``article`` or ``main`` has text, only blocks inside such an element are returned.
    """
    root = _Element("", False, False, False, True)
    stack, blocks, text, linked, short = [root], [], [], [0], []

    def flush() -> None:
        words = " ".join("".join(text).split())
        text.clear()
        links, linked[0] = linked[0], 0
        if words:
            holder = next(e for e in reversed(stack) if e.block)
            h = xxhash.xxh3_64_intdigest(words)
            for e in stack:
                e.blocks.append(len(blocks))
            holder.digest.update(h.to_bytes(8, "little"))
            in_header = any(e.tag == "header" for e in stack) and not any(e.heading for e in stack)
            keep = not any(e.framed for e in stack) and not in_header
            blocks.append([words, [], keep, any(e.content for e in stack), links > MOST_LINKED * len(words)])

    def close() -> None:
        if stack[-1].block:
            flush()
        e = stack.pop()
        h = e.digest.intdigest()
        if e.block and e.tag not in ("html", "body", *CONTENT_TAGS):
            if sum(len(blocks[b][0]) for b in e.blocks) < SHORT:
                short.append((h, e.blocks))
            else:
                for b in e.blocks:
                    blocks[b][1].append(_signed(h))
        stack[-1].digest.update(h.to_bytes(8, "little"))

    def close_to(tags, stop) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in tags:
                while len(stack) > i:
                    close()
                return
            if stack[i].tag in stop:
                return

    def say(raw: str) -> None:
        if raw:
            if "&" in raw:
                raw = html.unescape(raw)
            text.append(raw)
            if any(e.tag == "a" for e in stack):
                linked[0] += len(raw)

    at = 0
    while True:
        m = _TOKEN.search(page, at)
        if m is None:
            say(page[at:])
            break
        say(page[at : m.start()])
        at = m.end()
        tag = (m.group(2) or "").lower()
        if not tag:
            continue
        if m.group(1):
            if tag == "br":
                text.append(" ")
            elif tag not in VOID:
                close_to({tag}, ("article", "main", "body") if tag in INLINE or tag == "p" else ())
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if tag in VOID:
            if tag in INLINE:
                text.append(" " if tag == "br" else "")
            else:
                flush()
            continue
        if tag in SAME_LEVEL:
            own, stop = SAME_LEVEL[tag]
            while any(e.tag in own for e in stack[1:]):
                before = len(stack)
                close_to(own, stop)
                if len(stack) == before:
                    break
        if tag in CLOSES_P:
            close_to({"p"}, ("article", "main", "div", "section", "td", "th", "li", "body", "blockquote", "table", "button"))
        if tag in HEADINGS:
            close_to(HEADINGS - {"hgroup"}, CLOSES_P - HEADINGS)
        if tag == "body":
            close_to({"head"}, ())
        block = tag not in INLINE
        if block:
            flush()
        in_content = any(e.content for e in stack)
        stack.append(_Element(tag, _frames(tag, m.group(3) or "", in_content), tag in CONTENT_TAGS, tag in HEADINGS, block))
        if (m.group(3) or "").endswith("/") and tag not in CLOSES_P and tag not in INLINE and tag not in ("html", "body"):
            close()  # self-closed foreign element
    while len(stack) > 1:
        close()
    flush()
    marked = any(keep and inside for _, _, keep, inside, _ in blocks)
    shown = [b for b, (_, _, keep, inside, links) in enumerate(blocks) if keep and (inside if marked else not links)]
    place = {b: i for i, b in enumerate(shown)}
    for h, own in short:
        at = [place[b] for b in own if b in place]
        if not at:
            continue
        for side, beside in enumerate((at[0] - 1, at[-1] + 1)):
            if 0 <= beside < len(shown):
                both = _signed(xxhash.xxh3_64_intdigest(f"{side} {h} {blocks[shown[beside]][0]}"))
                for b in own:
                    blocks[b][1].append(both)
    return marked, [(blocks[b][0], blocks[b][1]) for b in shown]


def parsed(page: Column) -> Column:
    """(marked, fingerprint of the text, blocks) of a page; null and empty pages have no blocks."""

    @F.pandas_udf("struct<marked:boolean,fingerprint:bigint,blocks:array<struct<text:string,hashes:array<bigint>>>>")
    def of(pages: pd.Series) -> pd.DataFrame:
        out = []
        for p in pages:
            marked, blocks = parse(p) if p else (False, [])
            print_ = xxhash.xxh3_64_intdigest("\0".join(t for t, _ in blocks)) >> 1
            out.append((marked, print_, [{"text": t, "hashes": h} for t, h in blocks]))
        return pd.DataFrame(out, columns=["marked", "fingerprint", "blocks"])

    return of(page)


def element_key(hash_: Column) -> Column:
    """Names an element of a host's pages of one kind."""
    return F.xxhash64("host", "marked", hash_)


def host_templates(pages: DataFrame) -> DataFrame:
    """``key``: elements that recur across pages of a host with different texts, one row each, by ``element_key``.

    Copies of a page count once, by the fingerprint of their text, so an article that a site repeats is no template. In
    pages that mark their content, a template is on 10 or more contents of the host, in other pages on 5 or more, however
    many pages the host has. Null hosts have none.
    """
    hashes = pages.where(F.col("host").isNotNull()).select("host", "marked", "fingerprint", F.explode(F.array_distinct(F.flatten("blocks.hashes"))).alias("hash"))
    seen = hashes.select("marked", "fingerprint", element_key(F.col("hash")).alias("key")).distinct()
    counts = seen.groupBy("key", "marked").agg(F.count(F.lit(1)).alias("n"))
    return counts.where(F.col("n") >= F.when(F.col("marked"), LEAST_PAGES_INSIDE).otherwise(LEAST_PAGES)).select("key")


def _by_row(pages: DataFrame) -> DataFrame:
    """Pages numbered by ``row`` and stored in buckets of it, so that what is found for a row comes to its text, which stays."""
    path = scratch_path(pages.sparkSession, "pages")
    own = f"pages_{path.rsplit('-', 1)[-1]}"
    numbered = pages.withColumn("row", F.monotonically_increasing_id())
    writer = numbered.write.format("parquet").option("compression", "zstd").option("path", path)
    writer.bucketBy(partitions(pages.sparkSession), "row").saveAsTable(own)
    return pages.sparkSession.table(own)


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` of every row: the blocks that are no template of the page's host, joined by blank lines.

    Pages are parsed once; the parsed blocks are stored, hashes are counted per host over all of them, and the blocks
    under a recurring element are dropped. Recurring elements are rows that meet the pages' elements by ``SALTS`` parts
    of each, so neither a large host nor a very common element makes a long list or a long task. Null, empty and
    text-free pages give an empty text; repeated rows are answered one by one.
    """
    host = F.lower(F.regexp_extract(F.col(url_col), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    whole = _by_row(
        pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.nullif(host, F.lit("")).alias("host"), parsed(F.col(html_col)).alias("_p"))
        .select("page_id", "url", "host", "_p.*"))
    # stored with its salts, so that Spark knows its size: a small table travels to the pages, a large one meets them by element
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    templates = kept(host_templates(whole).select("key", salts).select(F.xxhash64("key", "salt").alias("salted")), "templates")
    elements = whole.where(F.col("host").isNotNull()).select("row", "host", "marked", F.explode(F.array_distinct(F.flatten("blocks.hashes"))).alias("hash"))
    salt = F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int")
    found = elements.select("row", "hash", F.xxhash64(element_key(F.col("hash")), salt).alias("salted")).join(templates, "salted", "left_semi")
    recurring = found.groupBy("row").agg(F.collect_list("hash").alias("recurring"))  # at most a page's elements
    drop = F.coalesce("recurring", F.array().cast("array<bigint>"))
    text = F.array_join(F.transform(F.filter("blocks", lambda b: ~F.arrays_overlap(b["hashes"], drop)), lambda b: b["text"]), "\n\n")
    return (whole.select("row", "page_id", "url", "blocks").join(recurring, "row", "left").select("page_id", "url", text.alias("text"))
            .withColumn("n_chars", F.length("text").cast("long")))


@query("op2_site_templates")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))
