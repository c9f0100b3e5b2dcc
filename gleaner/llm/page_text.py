"""Main text of web pages, told from the frame around it by comparing neighbours.

Pages of one host are ordered by the path of their URL. Each is laid beside the
pages before and after it, and their text lines are aligned by a longest common
subsequence: what two different pages share is frame, what differs is theirs.
Places in the markup whose lines are shared again and again belong to the frame
of the whole host, also where a single line differs.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner.sources.scratch import stage

# Elements without text of their own, elements around the main text, elements that start a new line.
SILENT = {"script", "style", "template", "noscript", "svg", "iframe", "object", "canvas", "audio", "video", "map", "math", "title", "head", "datalist"}
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "xmp"}
FRAME = {"nav", "footer", "aside", "form", "menu", "button", "select", "textarea", "input", "dialog", "label", "fieldset"}
FRAME_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "alertdialog", "menu", "menubar"}
MAIN = {"article", "main"}
BLOCKS = {
    "address", "article", "aside", "blockquote", "body", "center", "dd", "details", "dialog", "div", "dl", "dt", "fieldset", "figcaption", "figure",
    "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "option", "p",
    "pre", "section", "summary", "table", "tbody", "tfoot", "thead", "tr", "ul", "caption",
}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
SPACED = {"br", "td", "th"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
# Words in a class or id that name parts of the frame, and reader comments.
FRAME_WORDS = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "adsense", "sponsor", "sponsored", "promo", "promotion", "banner", "cookie", "cookies",
    "consent", "gdpr", "notice", "notices", "comment", "comments", "commentlist", "disqus", "respond", "replies", "sidebar", "menu", "nav", "navbar", "navigation",
    "breadcrumb", "breadcrumbs", "footer", "masthead", "share", "sharing", "social", "related", "recommended", "newsletter", "subscribe", "signup", "login",
    "popup", "modal", "widget", "pagination", "pager", "toolbar", "skip", "popular", "trending",
}
# An element that closes others of its kind when it starts, and where that ends.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select", "datalist"}),
}
ENDS_PARAGRAPH = BLOCKS - {"html", "body", "tbody", "thead", "tfoot", "tr", "caption", "legend", "option", "summary"}

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^"'>]++|"[^"]*+"|'[^']*+')*+>|[^>]*(?:>|\Z))""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_NAME = re.compile(r"[a-z]+|\d+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

# A line stands in the frame, in the declared main part, or elsewhere.
OUT, IN, OPEN = 0, 1, 2
# Neighbours that share more of their text are copies of each other, which tells nothing about their frame.
COPY_SHARE = 0.5
# A place of a host is frame when it was compared so often and so large a share of its lines was found next door.
PLACE_LINES, PLACE_SHARE = 4, 0.5
# In a declared main part nearly all lines of a place must be.
DECLARED_PLACE_SHARE = 0.9
# The declared main part is believed unless it holds less than this share of the text outside the frame.
DECLARED_SHARE = 0.2
# Pages compared in one task at a time, in blocks that overlap by one page.
BLOCK = 32


class _Element:
    __slots__ = ("tag", "zone", "place", "hidden")

    def __init__(self, tag: str, zone: int, place: str, hidden: bool):
        self.tag, self.zone, self.place, self.hidden = tag, zone, place, hidden


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(text)}


def _child(tag: str, rest: str, parent: _Element) -> _Element:
    """The element that a start tag opens below ``parent``."""
    zone, place, hidden = parent.zone, f"{parent.place}>{tag}", parent.hidden or tag in SILENT
    if tag in FRAME or (tag == "header" and zone != IN):
        zone = OUT
    elif tag in MAIN and zone == OPEN:
        zone = IN
    if len(rest) > 1:
        given = _attributes(rest)
        names = given.get("class", "") + " " + given.get("id", "")
        words = set(_NAME.findall(_CAMEL.sub(" ", names).lower()))
        if words:
            place += "." + ".".join(sorted(w for w in words if w.isalpha()))
        role = given.get("role", "").lower()
        if tag not in ("html", "body") and (role in FRAME_ROLES or (tag not in MAIN and words & FRAME_WORDS) or words & {"comment", "comments"}):
            zone = OUT
        elif zone == OPEN and (role == "main" or given.get("itemprop", "").lower() == "articlebody"):
            zone = IN
        hidden = hidden or "hidden" in given or given.get("aria-hidden", "").lower() == "true" or "display:none" in given.get("style", "").replace(" ", "").lower()
    return _Element(tag, zone, place, hidden)


def page_lines(source: str) -> list[tuple[str, int, str]]:
    """Text lines of a page in order: text, zone, and place in the markup.

    A line is what stands between the borders of block elements, with
    character references decoded and white space run together. Scripts,
    styles, comments and hidden elements have no lines. Broken markup is read
    on as far as it goes: unclosed elements end with those around them.
    """
    lines: list[tuple[str, int, str]] = []
    root = _Element("", OPEN, "", False)
    stack = [root]
    parts: list[str] = []
    # the line belongs to the innermost block around its first text
    owner = root

    def block() -> _Element:
        for element in reversed(stack):
            if element.tag in BLOCKS or element.zone != root.zone and element.tag not in VOID:
                return element
        return root

    def flush() -> None:
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                lines.append((text, owner.zone, owner.place))
            parts.clear()

    def say(text: str) -> None:
        nonlocal owner
        if text and not stack[-1].hidden:
            home = stack[-1] if stack[-1].zone == OUT else block()
            if parts and home.zone != owner.zone:
                flush()
            if not parts or not "".join(parts).strip():
                owner = home
            parts.append(html.unescape(text) if "&" in text else text)

    def close(count: int) -> None:
        if count:
            if any(e.tag in BLOCKS for e in stack[-count:]):
                flush()
            del stack[-count:]

    def close_until(tags: set[str], stops: set[str]) -> None:
        for depth in range(1, len(stack)):
            tag = stack[-depth].tag
            if tag in tags:
                close(depth)
                return
            if tag in stops:
                return

    at, size = 0, len(source)
    while at < size:
        found = _TAG.search(source, at)
        if found is None:
            say(source[at:])
            break
        say(source[at : found.start()])
        at = found.end()
        tag = (found[2] or "").lower()
        if not tag:
            continue
        if found[1]:
            if tag in ("br", "p") and not any(e.tag == tag for e in stack):
                flush() if tag == "p" else say(" ")
                continue
            for depth in range(1, len(stack)):
                if stack[-depth].tag == tag:
                    close(depth)
                    break
                if stack[-depth].tag in ("article", "main", "body", "table") and tag not in BLOCKS and tag not in ("table", "html"):
                    break
            continue
        if tag in ENDS_PARAGRAPH:
            close_until({"p"}, {"article", "main", "section", "div", "td", "th", "li", "blockquote", "body", "button", "object", "aside", "nav", "footer", "form"})
        if tag in HEADINGS and stack[-1].tag in HEADINGS:
            close(1)
        if tag in CLOSES:
            close_until(*CLOSES[tag])
        if tag == "body":
            # whatever the head left open ends here
            close(sum(e.tag not in ("", "html") for e in stack))
        if tag in BLOCKS:
            flush()
        if tag in SPACED:
            say(" ")
        if tag in VOID:
            continue
        element = _child(tag, found[3].rstrip(">"), stack[-1])
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(source, at)
            if not element.hidden and element.zone != OUT:
                stack.append(element)
                say(source[at : end.start() if end else size])
                stack.pop()
            at = end.end() if end else size
            continue
        stack.append(element)
    flush()
    return lines


def _number(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def read_lines(pages: DataFrame) -> DataFrame:
    """``(page_id, url, lines)`` of ``pages(page_id, url, html)``; a line has text, zone, and hashes of text and place."""
    line_type = pa.struct([("text", pa.string()), ("zone", pa.int32()), ("hash", pa.int64()), ("place", pa.int64())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places: dict[str, int] = {}
        for batch in batches:
            # pages may be long, so few of them are held as lines at a time
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                texts, zones, hashes, spots, offsets = [], [], [], [], [0]
                for source in part.column(2):
                    for text, zone, place in page_lines(source.as_py() or ""):
                        if len(places) > 100_000:
                            places.clear()
                        texts.append(text)
                        zones.append(zone)
                        hashes.append(_number(text))
                        spots.append(places[place] if place in places else places.setdefault(place, _number(place)))
                    offsets.append(len(texts))
                columns = [pa.array(texts, pa.string()), pa.array(zones, pa.int32()), pa.array(hashes, pa.int64()), pa.array(spots, pa.int64())]
                lines = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(columns, fields=list(line_type)))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), lines], ["page_id", "url", "lines"])

    key, url = (pages.schema[c].dataType.simpleString() for c in ("page_id", "url"))
    schema = f"page_id {key}, url {url}, lines array<struct<text: string, zone: int, hash: bigint, place: bigint>>"
    return pages.select("page_id", "url", "html").mapInArrow(read, schema)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host without ``www.``, null where there is none, and a path that sorts near pages side by side.

    Scheme, query, fragment, page suffix and closing slashes do not count, and
    numbers sort by value.
    """
    bare = F.regexp_replace(F.lower(url), r"^\s*(?:[a-z][a-z0-9+.-]*:)?//", "")
    host = F.regexp_replace(F.regexp_extract(bare, r"^([^/?#]+)", 1), r"^www\.", "")
    path = F.regexp_replace(F.regexp_replace(F.regexp_extract(bare, r"^[^/?#]*([^?#]*)", 1), r"/+$", ""), r"\.(?:html?|php|aspx?)$", "")
    # a number is led by its length, so that 9 comes before 10
    parts = F.regexp_extract_all(path, F.lit(r"(\d+|\D+)"), F.lit(1))
    sortable = F.array_join(F.transform(parts, lambda p: F.when(p.rlike(r"^\d"), F.concat(F.lpad(F.char_length(p).cast("string"), 4, "0"), p)).otherwise(p)), "")
    return F.nullif(host, F.lit("")), sortable


def common_lines(left: list[int], right: list[int]) -> list[tuple[int, int]]:
    """Positions of one longest common subsequence of two lists.

    The table's rows are kept as bits of whole numbers, 64 or more cells a
    step. Of all rows only every so many are stored, and those between are
    worked out again on the way back, so that long lists fit in memory.
    """
    head = 0
    while head < len(left) and head < len(right) and left[head] == right[head]:
        head += 1
    tail = 0
    while tail < min(len(left), len(right)) - head and left[-1 - tail] == right[-1 - tail]:
        tail += 1
    found = [(i, i) for i in range(head)]
    a, b = left[head : len(left) - tail], right[head : len(right) - tail]
    known = set(a)
    # lines without a counterpart cannot be aligned
    columns = [j for j, y in enumerate(b) if y in known]
    known = {b[j] for j in columns}
    rows = [i for i, x in enumerate(a) if x in known]
    if rows:
        full = (1 << len(columns)) - 1
        masks: dict[int, int] = {}
        for bit, j in enumerate(columns):
            masks[b[j]] = masks.get(b[j], 0) | 1 << bit

        def below(state: int, row: int) -> int:
            mask = state & masks[a[rows[row]]]
            return ((state + mask) | (state - mask)) & full

        step = max(1, int(len(rows) ** 0.5))
        stored, state = [full], full
        for row in range(len(rows)):
            state = below(state, row)
            if (row + 1) % step == 0:
                stored.append(state)
        # a cleared bit is a column at which the row's count goes up
        matched, bit = [], len(columns) - 1
        for part in range((len(rows) - 1) // step, -1, -1):
            states = [stored[part]]
            for row in range(part * step, min(len(rows), (part + 1) * step)):
                states.append(below(states[-1], row))
            for row in range(part * step + len(states) - 2, part * step - 1, -1):
                now, before = states[row - part * step + 1], states[row - part * step]
                free = ~now & ((1 << (bit + 1)) - 1)
                top = free.bit_length() - 1
                if top < 0:
                    break
                # without this row the count up to here is the same: it is not needed
                if (~before & ((1 << (bit + 1)) - 1)).bit_count() == free.bit_count():
                    continue
                reach = top
                while not masks[a[rows[row]]] >> reach & 1:
                    reach -= 1
                matched.append((head + rows[row], head + columns[reach]))
                bit = reach - 1
            if bit < 0:
                break
        found += reversed(matched)
    return found + [(len(left) - tail + i, len(right) - tail + i) for i in range(tail)]


def _weight(line: dict) -> int:
    """Long lines tell copies apart better than many short ones."""
    return line["n"] * line["n"]


def shared_lines(pages: list[list[dict]], hosts: list) -> tuple[list[list[bool]], list[bool]]:
    """Which lines of each page stand next door too, and whether the page was compared at all.

    ``pages`` are in order; neighbours of one host are aligned. Lines that
    markup already puts in the frame take no part in telling copies.
    """
    shared = [[False] * len(lines) for lines in pages]
    compared = [False] * len(pages)
    for i in range(len(pages) - 1):
        a, b = pages[i], pages[i + 1]
        if hosts[i] != hosts[i + 1] or not a or not b:
            continue
        same = common_lines([x["hash"] for x in a], [x["hash"] for x in b])
        least = min(sum(_weight(x) for x in page if x["zone"] != OUT) for page in (a, b))
        if least and sum(_weight(a[x]) for x, _ in same if a[x]["zone"] != OUT) > COPY_SHARE * least:
            continue
        compared[i] = compared[i + 1] = True
        for x, y in same:
            shared[i][x] = shared[i + 1][y] = True
    return shared, compared


def in_order(keys: DataFrame) -> DataFrame:
    """``(row, host, at)``: pages with a host numbered by host and path, ties by id, URL and content."""
    order = ["host", "path", "page_id", "url", "content", "row"]
    ranged = keys.repartitionByRange(*order).sortWithinPartitions(*order).select("row", "host", F.monotonically_increasing_id().alias("id"))
    ranged = stage(ranged, "page-order")
    part, inside = F.shiftrightunsigned("id", 33), F.col("id").bitwiseAND((1 << 33) - 1)
    # one row per partition
    sizes = ranged.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    return ranged.withColumn("part", part).join(starts, "part").select("row", "host", (F.col("start") + inside).alias("at"))


def compare_neighbours(ordered: DataFrame, block: int = BLOCK) -> DataFrame:
    """``(row, host, at, shared, places, votes)`` of ``ordered(row, host, at, lines)``, lines without text.

    ``shared`` marks the lines outside frame and declared main part that stand
    next door, and is null where there is none. ``votes`` counts per place
    outside the known frame the lines that were compared and those found next
    door; ``places`` names these places of every page. Pages are dealt out in blocks of
    neighbours; the pages at a border go to both blocks, so that the result
    does not depend on how the table is partitioned.
    """
    own = F.floor(F.col("at") / block)
    dealt = ordered.select("*", F.explode(F.array_distinct(F.array(own, F.floor((F.col("at") - 1) / block), F.floor((F.col("at") + 1) / block)))).alias("block"))

    def compare(table: pa.Table) -> pa.Table:
        table = table.sort_by("at")
        ats, hosts, pages = (table.column(c).to_pylist() for c in ("at", "host", "lines"))
        number = table.column("block")[0].as_py()
        shared, compared = shared_lines(pages, hosts)
        keep = [i for i, at in enumerate(ats) if at // block == number]
        votes = []
        for i in keep:
            tally: dict[tuple[int, int], list[int]] = {}
            for line, hit in zip(pages[i], shared[i]) if compared[i] else ():
                if line["zone"] != OUT:
                    cell = tally.setdefault((line["place"], line["zone"]), [0, 0])
                    cell[0] += 1
                    cell[1] += hit
            votes.append([{"place": place, "zone": zone, "lines": n, "hits": hits} for (place, zone), (n, hits) in tally.items()])
        kept = table.select(["row", "host", "at"]).take(pa.array(keep, pa.int64()))
        dropped = [[hit and line["zone"] == OPEN for line, hit in zip(pages[i], shared[i])] for i in keep]
        flags = pa.array([f if any(f) else None for f in dropped], pa.list_(pa.bool_()))
        places = pa.array([sorted({line["place"] for line in pages[i] if line["zone"] != OUT}) for i in keep], pa.list_(pa.int64()))
        vote = pa.struct([("place", pa.int64()), ("zone", pa.int32()), ("lines", pa.int64()), ("hits", pa.int64())])
        return kept.append_column("shared", flags).append_column("places", places).append_column("votes", pa.array(votes, pa.list_(vote)))

    schema = "row bigint, host string, at bigint, shared array<boolean>, places array<bigint>, votes array<struct<place: bigint, zone: int, lines: bigint, hits: bigint>>"
    return dealt.groupBy("block").applyInArrow(compare, schema)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", block: int = BLOCK) -> DataFrame:
    """``(page_id, url, text, n_chars)``: the main text of every row of ``pages``, one line per block.

    Lines that stand next door too, on a page that is not a copy, are dropped,
    and so are those at places of the markup that are frame all over the host.
    What an element's name, role or class calls frame goes as well: menus,
    headers, footers, sidebars, notices, adverts, forms and reader comments.
    Where a page declares its main part, only that part is taken, and a line in
    it goes only if its place is frame all over the host: a passage that two
    articles quote stays. Text is empty where nothing is left. A null html is
    an empty one; a page without a host has no neighbours, and is read by its
    markup alone. Repeated rows count one by one. Other columns are ignored;
    an empty table gives an empty one.

    Texts are written once and met again by row; what is compared are hashes.
    Only pages that comparison takes a line from are joined to their texts.
    """
    named = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    parsed = stage(read_lines(named).withColumn("row", F.monotonically_increasing_id()), "page-lines")
    host, path = host_and_path(F.col("url"))
    hashes = F.transform("lines", lambda x: x["hash"])
    ordered = stage(in_order(
        parsed.select("row", host.alias("host"), path.alias("path"), "page_id", "url", F.xxhash64(hashes).alias("content")).filter(F.col("host").isNotNull())
    ), "page-places")
    light = parsed.select("row", F.transform("lines", lambda x: F.struct(x["zone"].alias("zone"), x["hash"].alias("hash"), x["place"].alias("place"), F.char_length(x["text"]).alias("n"))).alias("lines"))
    seen = stage(compare_neighbours(light.join(ordered, "row"), block), "page-shared")

    # a host's frame is met by stretches of its pages, so that a large host is no single key
    stretch = lambda at: F.floor(at / (block * 64))
    votes = seen.select("host", "at", F.inline("votes"))
    tally = votes.groupBy("host", "place", "zone").agg(F.sum("lines").alias("lines"), F.sum("hits").alias("hits"))
    needed = F.when(F.col("zone") == IN, DECLARED_PLACE_SHARE).otherwise(PLACE_SHARE)
    common = tally.filter((F.col("lines") >= PLACE_LINES) & (F.col("hits") >= needed * F.col("lines")))
    frames = common.groupBy("host").agg(F.array_sort(F.collect_set("place")).alias("frame"))
    reach = ordered.groupBy("host").agg(F.min("at").alias("low"), F.max("at").alias("high"))
    spread = frames.join(reach, "host").select("host", "frame", F.explode(F.sequence(stretch(F.col("low")), stretch(F.col("high")))).alias("stretch"))
    nowhere = F.array().cast("array<bigint>")
    framed = F.array_intersect("places", F.coalesce("frame", nowhere))
    judged = seen.withColumn("stretch", stretch(F.col("at"))).join(spread, ["host", "stretch"], "left").select("row", "shared", framed.alias("frame"))
    # only pages that lose a line by comparison are met again; where they are few, the plan need not move the texts
    judged = stage(judged.filter(F.col("shared").isNotNull() | (F.size("frame") > 0)), "page-judged")
    found = parsed.join(judged, "row", "left").withColumn("frame", F.coalesce("frame", nowhere))
    in_frame = lambda x: F.array_contains("frame", x["place"])
    own = F.filter("lines", lambda x, i: (x["zone"] != OUT) & ~in_frame(x) & ((x["zone"] == IN) | ~F.coalesce(F.get("shared", i), F.lit(False))))
    declared = F.filter("own", lambda x: x["zone"] == IN)
    chars = lambda lines: F.aggregate(lines, F.lit(0).cast("bigint"), lambda n, x: n + F.char_length(x["text"]))
    believed = (chars(declared) > 0) & (chars(declared) >= DECLARED_SHARE * chars(F.col("own")))
    text = F.array_join(F.transform(F.when(believed, declared).otherwise(F.col("own")), lambda x: x["text"]), "\n")
    return (
        found.select("page_id", "url", own.alias("own")).select("page_id", "url", text.alias("text"))
        .withColumn("n_chars", F.char_length("text").cast("bigint"))
    )
