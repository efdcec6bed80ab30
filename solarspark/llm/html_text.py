"""Main text of web pages, with what a site repeats on its pages taken out.

Each page is read into blocks of text. All element subtrees of a page, within articles too,
get a hash of their tags, classes and text. Spark counts, for every host, on how many
different contents a subtree occurs; subtrees on many of a host are its template and their
blocks go. The content of a page is the text it would have without this, so that an article
served under several addresses counts once and keeps its text. Only small labelled parts of
an article that hold no paragraph count by address. A plain part of an article, without a
class or id, is taken out only from its beginning or end: a heading, sentence or quotation
that many articles have between their own paragraphs stays. Elements that by their name, role or
class are menus, headers, footers, sidebars, notices, adverts, forms or comments go too.
"""

from __future__ import annotations

import html
import re
from collections import Counter

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged, steps

MANY_PAGES = 4  # a subtree on as many different pages of a host at least is a part of its template

#: The rest of a tag up to its end. Nothing is tried twice, so a tag takes time in proportion to its length.
_REST = re.compile(r"""(?:[^>"']++|"[^"]*+"|'[^']*+'|["'])*+""")
_NAME = re.compile(r"(/?)([a-zA-Z][^\s/>]*+)")
_ATTRIBUTE = re.compile(r"""([a-zA-Z_:][-\w:.]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_RAW = {"script", "style", "noscript", "template", "iframe", "textarea", "title", "xmp", "noembed", "noframes"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_BLOCK = {"address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir",
          "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6",
          "head", "header", "hr", "html", "li", "main", "menu", "nav", "ol", "p", "pre", "section", "summary",
          "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"}
_DROPPED = {"nav", "footer", "aside", "form", "menu", "dialog", "button", "select", "option", "svg",
            "head", "object", "canvas", "audio", "video", "fieldset", "label", "input"} | _RAW
_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "alertdialog", "form", "menu"}
_NAMED = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert\w*|adsense|sponsor\w*|promo\w*|banner\w*|nav|navbar|navigation|menu\w*|"
    r"side-?bar\w*|footer\w*|masthead|cookies?|consent|notices?|gdpr|comments?|disqus|respond|repl(?:y|ies)|"
    r"social|share|sharing|related|recommend\w*|breadcrumbs?|newsletter|subscri\w+|popup|modal|signup|login|"
    r"widgets?|pagination|pager|skip|toolbar|tags?)(?:$|[\s_-])", re.I)
_HEADER = re.compile(r"(?:^|[\s_-])header(?:$|[\s_-])", re.I)
_CLOSES = {"p": {"p"}, "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"},
           "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "option": {"option"}}
_ROOTS = {"", "html", "body", "article", "main"}  # never a template themselves
_PROSE = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "blockquote", "pre", "td", "th", "dd", "dt"}
_SCOPE = {"article", "aside", "body", "div", "html", "main", "ol", "section", "table", "td", "ul", "dl", "blockquote"}


class _Element:
    __slots__ = ("tag", "digest", "dropped", "main", "named", "parent", "number", "length", "prose", "open")

    def __init__(self, tag, parent, attributes, number):
        own = {k.lower(): html.unescape((v or "").strip("\"'")) for k, v in _ATTRIBUTE.findall(attributes)} if attributes else {}
        label = f"{own.get('class', '')} {own.get('id', '')}".strip()
        self.tag, self.parent, self.number = tag, parent, number
        self.named, self.length, self.prose, self.open = bool(label), 0, tag in _PROSE, True
        self.main = (parent.main if parent else False) or tag in ("article", "main") or own.get("role") in ("main", "article")
        hidden = "hidden" in own or own.get("aria-hidden") == "true" or "display:none" in own.get("style", "").replace(" ", "")
        # The header of an article holds its title; any other one is the site's.
        header = not self.main and (tag == "header" or bool(label and _HEADER.search(label)))
        self.dropped = (parent.dropped if parent else False) or (
            tag not in ("html", "body", "article", "main") and (
                tag in _DROPPED or header or own.get("role") in _ROLES or hidden
                or bool(label and _NAMED.search(label))))
        self.digest = xxhash.xxh3_64(f"<{tag} {label}>")


def next_tag(source: str, at: int) -> tuple[int, int, str, str, str] | None:
    """``start, end, closing, name, rest`` of the next tag; comments and the like have no name.

    A tag that the end of the page cuts off takes the rest of the page with it.
    """
    while (at := source.find("<", at)) >= 0:
        if source.startswith("<!--", at):
            end = source.find("-->", at + 4)
            return at, len(source) if end < 0 else end + 3, "", "", ""
        if source.startswith(("<!", "<?"), at):
            return at, source.find(">", at) + 1 or len(source), "", "", ""
        if name := _NAME.match(source, at + 1):
            rest = _REST.match(source, name.end())
            if rest.end() == len(source):
                return at, len(source), "", "", ""
            return at, rest.end() + 1, name[1], name[2].lower(), rest[0]
        at += 1
    return None


def read_page(source: str) -> tuple[list[tuple[str, list[int]]], list[int], list[int], list[int]]:
    """Blocks of a page in order, each a text and the places of the subtrees around it; the
    hashes of all subtrees with text; the places of those that count by address; and the
    places of those that are plain parts of an article wherever they stand.

    Dropped elements give no block; if there is an article, only its blocks are given.
    """
    numbers = 0
    root = _Element("", None, "", 0)
    stack, elements, blocks, text, holder = [root], [], [], [], None
    opened = Counter()

    def flush():
        nonlocal text, holder
        if text:
            whole = " ".join(html.unescape("".join(text)).split())
            text = []
            if whole and not holder.dropped:
                blocks.append((whole, holder))
            holder = None

    def pop():
        element = stack.pop()
        element.open = False
        opened[element.tag] -= 1
        if stack:
            stack[-1].digest.update(element.digest.digest())
            stack[-1].length += element.length
            stack[-1].prose |= element.prose

    def add(piece):
        nonlocal holder
        if piece:
            text.append(piece)
            bare = piece.strip()
            if bare:
                # The innermost element around all of the block.
                if holder is None:
                    holder = stack[-1]
                while not holder.open:
                    holder = holder.parent
                stack[-1].digest.update(bare)
                stack[-1].length += len(bare)

    at, raw_end = 0, len(source)
    while found := next_tag(source, at):
        start, end, closing, tag, rest = found
        add(source[at:start])
        at = end
        if not tag:
            continue
        if not closing:
            if tag == "br":
                add(" ")
                continue
            if tag in _BLOCK or tag in _DROPPED:
                flush()
            closes = _CLOSES.get(tag) or ({"p"} if tag in _BLOCK else None)
            while closes and any(opened[t] for t in closes):
                inner = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag in closes or stack[i].tag in _SCOPE), 0)
                if not inner or stack[inner].tag not in closes:
                    break
                while len(stack) > inner:
                    pop()
            if tag in _VOID:
                continue
            numbers += 1
            element = _Element(tag, stack[-1], rest, numbers)
            if tag in _RAW:
                close = re.compile(rf"</{tag}\b", re.I).search(source, at)
                element.digest.update(source[at:close.start() if close else raw_end])
                stack[-1].digest.update(element.digest.digest())
                at = (source.find(">", close.end()) + 1 if close else 0) or raw_end
            elif not rest.rstrip().endswith("/") or tag in _BLOCK:
                stack.append(element)
                opened[tag] += 1
                elements.append(element)
        else:
            if tag in _BLOCK or tag in _DROPPED:
                flush()
            inner = opened[tag] and next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag), 0)
            if inner and (tag in _BLOCK or not any(e.tag in _BLOCK for e in stack[inner + 1:])):
                while len(stack) > inner:
                    pop()
    add(source[at:])
    flush()
    while len(stack) > 1:
        pop()
    if any(e.main for _, e in blocks):
        blocks = [b for b in blocks if b[1].main]
    places: dict[int, int] = {}
    by_address, place_of, plain, other = set(), {}, set(), set()
    half = sum(len(t) for t, _ in blocks) / 2
    for element in elements:
        if element.length and element.tag not in _ROOTS:
            place = place_of[element.number] = places.setdefault(element.digest.intdigest() - (1 << 63), len(places))
            if element.main and element.named and not element.prose and element.length < half:
                by_address.add(place)
            (plain if element.main and not element.named else other).add(place)
    out = []
    for whole, element in blocks:
        around = []
        while element is not None:
            if element.number in place_of:
                around.append(place_of[element.number])
            element = element.parent
        out.append((whole, around))
    return out, list(places), sorted(by_address), sorted(plain - other)


_BLOCKS = pa.list_(pa.struct([("text", pa.string()), ("around", pa.list_(pa.int32()))]))


def extract_text(pages: DataFrame, many_pages: int = MANY_PAGES) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``pages`` (page_id, url, html).

    If a page has an article or main element, only that is read, else the whole body. A
    null or empty page has the empty text. Pages with a null address share one host. Rows
    that repeat give a row each; empty input gives no rows; other columns are not looked at.
    """
    host = F.coalesce(F.lower(F.regexp_extract("url", r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/@?#]*@)?([^/:?#]*)", 1)), F.lit(""))
    rows = pages.select("page_id", "url", host.alias("host"), "html")

    def parse(batches):
        for batch in steps(batches, "html"):
            found, contents, subtrees, labelled, plain = [], [], [], [], []
            for source in batch.column("html").to_pylist():
                blocks, hashes, by_address, unnamed = read_page(source) if source else ([], [], [], [])
                found.append([{"text": t, "around": a} for t, a in blocks])
                contents.append(xxhash.xxh3_64_intdigest("\n".join(t for t, _ in blocks)) - (1 << 63))
                subtrees.append(hashes)
                labelled.append(by_address)
                plain.append(unnamed)
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), batch.column("host"), pa.array(found, _BLOCKS),
                 pa.array(contents, pa.int64()), pa.array(subtrees, pa.list_(pa.int64())),
                 pa.array(labelled, pa.list_(pa.int32())), pa.array(plain, pa.list_(pa.int32()))],
                names=["page_id", "url", "host", "blocks", "content", "subtrees", "labelled", "plain"])

    parsed = staged(rows.mapInArrow(
        parse, "page_id bigint, url string, host string, blocks array<struct<text:string,around:array<int>>>,"
               " content bigint, subtrees array<bigint>, labelled array<int>, plain array<int>")
        .withColumn("row", F.monotonically_increasing_id()))
    subtree = F.xxhash64("host", "subtree").alias("subtree")
    counted = parsed.select("host", "content", F.xxhash64("url").alias("address"), "labelled",
                            F.posexplode("subtrees").alias("place", "subtree"))
    counted = counted.select(subtree, F.when(F.array_contains("labelled", F.col("place")), F.col("address"))
                             .otherwise(F.col("content")).alias("page")).distinct()
    template = (counted.groupBy("subtree").agg(F.count("*").alias("n"))
                .where(F.col("n") >= many_pages).select("subtree"))
    # Only subtrees around text that is left can still take something away.
    places = parsed.select("row", "host", "subtrees", F.explode(
        F.array_distinct(F.flatten(F.col("blocks.around")))).alias("place"))
    places = places.select("row", "place", F.col("host"), F.get("subtrees", "place").alias("subtree")).select(
        "row", "place", subtree)
    # Staged, so that a small table is known to be small before the texts would be shuffled.
    gone = staged(places.join(template, "subtree").groupBy("row").agg(F.collect_set("place").alias("gone")))
    ready = parsed.join(gone, "row", "left").withColumn("gone", F.coalesce("gone", F.array().cast("array<int>")))
    # A plain part of an article goes only with all that stands before it, or all that follows.
    ready = ready.withColumn("own", F.transform("blocks", lambda b: ~F.arrays_overlap(b["around"], "gone")))
    ready = ready.withColumns({
        "first": F.array_position("own", True), "last": F.size("own") + 1 - F.array_position(F.reverse("own"), True),
        "named": F.array_except("gone", "plain")})
    between = lambda i: (F.col("first") > 0) & (i + 1 > F.col("first")) & (i + 1 < F.col("last"))
    kept = F.filter("blocks", lambda b, i: ~F.arrays_overlap(b["around"], "named") & (
        ~F.arrays_overlap(b["around"], "gone") | between(i)))
    ready = ready.select("page_id", "url", kept.alias("blocks"))
    text = F.concat_ws("\n", F.col("blocks.text")).alias("text")
    return ready.select("page_id", "url", text).select(
        "page_id", "url", "text", F.char_length("text").cast("bigint").alias("n_chars"))
