"""Main text of web pages by markup and nearest-URL page differencing.

Markup decides first: scripts, styles, menus, headers, footers, sidebars,
notices, adverts, forms and comments go with all they hold. Where a page marks
its article (``article`` or ``main``), the lines outside go as well. Then every
page is differenced: pages are ordered by host and URL path, each is paired
with the nearest page of its host that has other lines, and their lines are
aligned by longest common subsequence.

A shared line is the template's, and goes, if at least half of the pages of
the host share it, at the same place in the markup, with their own neighbours.
Pages of a host with equal lines count once, with the markup of the first.
In a marked article it takes three such pages, so paragraphs that an article
has in common with some others stay; elsewhere two, and half of the pages of
the URL's folder are enough.
"""

from __future__ import annotations

import html
import re
import zlib
from collections.abc import Iterator
from math import isqrt
from urllib.parse import urlsplit

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from barsignal.llm.common import shared

# Classes of equal pages that meet in one task.
BLOCK = 256
# Pages of a host that must share a line with their neighbours, in a marked article and elsewhere.
LEAST_MARKED, LEAST_OTHER = 3, 2

SILENT = {"script", "style", "template", "noscript", "iframe", "svg", "canvas", "object", "textarea", "title"}
SKIPPED = {"head", "nav", "header", "footer", "aside", "form", "menu", "dialog", "button", "select", "datalist"}
SKIPPED_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "dialog", "menu", "menubar"}
# Words of class and id names ("site-footer", "ad_slot") that mark boilerplate.
SKIPPED_NAMES = {
    "ad", "ads", "adslot", "advert", "adverts", "advertisement", "advertising", "adsense", "sponsor", "sponsored", "promo", "promotion",
    "banner", "nav", "navbar", "navigation", "menu", "header", "masthead", "footer", "sidebar", "aside", "widget", "notice", "notices",
    "cookie", "cookies", "consent", "gdpr", "alert", "popup", "modal", "overlay", "newsletter", "subscribe", "signup", "login",
    "comment", "comments", "disqus", "reply", "replies", "respond", "share", "sharing", "social", "related",
    "recommended", "breadcrumb", "breadcrumbs", "pagination", "pager", "toc", "copyright", "disclaimer", "searchform",
}
# Names of sections of an article, though a word of theirs is above.
KEPT_NAMES = {"related-work", "related_work", "related-works", "related_works"}
ARTICLE = {"article", "main"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "input", "ins",
    "kbd", "label", "mark", "meter", "nobr", "output", "progress", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike",
    "strong", "sub", "sup", "time", "tt", "u", "var", "wbr",
}
# A value is quoted only where it begins with a quote that is closed; a tag ends before any other "<".
VALUE = r"""(?:"([^"]*+)"|'([^']*+)'|([^\s>]*+))"""
ATTRIBUTE = re.compile(rf"""([^\s/><][^\s/><=]*+)(?:\s*+=\s*+{VALUE})?+""")
TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/><]*+)((?:[\s/]++|"
    + ATTRIBUTE.pattern.replace("([^", "(?:[^") + r")*+)(?:>|\Z)", re.S
)

LINES = "page_id long, url string, row bigint, host string, path string, lines array<string>, places array<bigint>, marked boolean"


def _is_skipped(tag: str, attributes: str) -> bool:
    if tag in SKIPPED:
        return True
    if tag in ("html", "body") or not attributes.strip():
        return False
    for name, *values in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values).lower()
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        if name == "role" and value in SKIPPED_ROLES:
            return True
        if name in ("class", "id") and any(
            SKIPPED_NAMES.intersection(re.split("[-_]+", x))
            for x in value.split() if x not in KEPT_NAMES and not re.match("(has|no|with|without)[-_]", x)
        ):
            return True
    return False


def page_lines(source: str | None) -> tuple[list[str], bool]:
    """Lines of a page without boilerplate by markup, and whether they come from a marked article."""
    lines, _, marked = placed_lines(source)
    return lines, marked


def placed_lines(source: str | None) -> tuple[list[str], list[int], bool]:
    """Lines as of ``page_lines``, and of each line a hash of the elements around it."""
    if not source:
        return [], [], False
    inside: list[tuple[str, int]] = []
    outside: list[tuple[str, int]] = []
    stack: list[tuple[str, int, int]] = []  # tag, skipped elements and articles around its content
    parts: list[str] = []
    skipped = article = at = 0

    def close_line() -> None:
        if parts:
            if line := " ".join(html.unescape("".join(parts)).split()):
                place = zlib.crc32(" ".join(x[0] for x in stack).encode("utf-8", "replace"))
                (inside if article else outside).append((line, place))
            parts.clear()

    while at < len(source):
        found = TOKEN.search(source, at)
        if not skipped:
            parts.append(source[at : found.start() if found else len(source)])
        if not found:
            break
        at = found.end()
        tag = (found[2] or "").lower()
        if not tag:
            continue
        if tag in SILENT and not found[1]:
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.I).search(source, at)
            at = end.end() if end else len(source)
            continue
        if tag not in INLINE:
            close_line()
        if found[1]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    if skipped or article:
                        close_line()
                    skipped, article = stack[k][1:]
                    del stack[k:]
                    break
        elif tag not in VOID and not found[3].rstrip().endswith("/"):
            if tag not in INLINE and stack and stack[-1][0] == "p":
                skipped, article = stack.pop()[1:]
            skip = _is_skipped(tag, found[3])
            if skip or tag in ARTICLE:
                close_line()
            if tag not in INLINE or skip:
                stack.append((tag, skipped, article))
            skipped += skip
            article += tag in ARTICLE and not skipped
    close_line()
    found = inside or outside
    return [line for line, _ in found], [place for _, place in found], bool(inside)


def common_lines(a: list, b: list) -> list[int]:
    """Places in ``a`` of a longest common subsequence with ``b``.

    A row of the table of lengths is one integer, whose bit j is 0 where the
    length grows at b[j]. Every isqrt(len(a))-th row is kept and the others
    are made again on the way back, so 20,000 equal lines take seconds.
    """
    at_value: dict = {}
    for j, x in enumerate(b):
        at_value.setdefault(x, []).append(j)
    masks = {}
    for x in set(a) & at_value.keys():
        bits = bytearray(len(b) // 8 + 1)
        for j in at_value[x]:
            bits[j >> 3] |= 1 << (j & 7)
        masks[x] = int.from_bytes(bits, "little")
    if not masks:
        return []
    full = (1 << len(b)) - 1

    def after(row: int, x) -> int:
        up = row & masks.get(x, 0)
        return ((row + up) | (row - up)) & full if up else row

    step = isqrt(len(a)) + 1
    kept, row = [], full
    for i, x in enumerate(a):
        if i % step == 0:
            kept.append(row)
        row = after(row, x)
    out, i, j = [], len(a), len(b)
    block, rows = -1, []
    while i and j:
        if (i - 1) // step != block:
            block = (i - 1) // step
            rows = [kept[block]]
            for x in a[block * step : i]:
                rows.append(after(rows[-1], x))
        at = i - block * step
        j = (~rows[at] & ((1 << j) - 1)).bit_length()  # the last growth of row i
        if j:
            i -= 1
            if rows[at - 1] >> (j - 1) & 1:
                out.append(i)
                j -= 1
    return out[::-1]


def _prefix(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n


def shared_with_neighbour(pages: list[tuple], at: int) -> list[int]:
    """Lines that ``pages[at]`` shares with the nearest page of its host.

    Pages are (rank, host, path, hashes of lines), in order of host and path.
    Nearest is the longest common path, then the earlier page; in this order
    it is one of the two pages beside. Equal pages are one rank.
    """
    rank, host, path, mine = pages[at]
    near = [p for p in pages[max(0, at - 1) : at + 2] if p[1] == host and abs(p[0] - rank) == 1]
    if not near:
        return []
    return common_lines(mine, max(near, key=lambda p: (_prefix(path, p[2]), -p[0]))[3])


def _extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for page, url, row, source in zip(batch["page_id"], batch["url"], batch["row"], batch["html"], strict=True):
            lines, places, marked = placed_lines(source)
            try:
                where = urlsplit(url or "")
                host, path = where.netloc.lower(), where.path
            except ValueError:
                host, path = "", url
            rows.append((page, url, row, host, path, lines, places, marked))
        out = pd.DataFrame(rows, columns=["page_id", "url", "row", "host", "path", "lines", "places", "marked"])
        out["page_id"] = out["page_id"].astype("Int64")
        yield out


def _difference(group: pd.DataFrame) -> pd.DataFrame:
    group = group.sort_values("rank")
    pages = [(r, h, p, list(x)) for r, h, p, x in zip(group["rank"], group["host"], group["path"], group["keys"], strict=True)]
    rows = []
    for at, (row, core) in enumerate(zip(group["row"], group["core"], strict=True)):
        if core and (both := shared_with_neighbour(pages, at)):
            rows.append((row, both))
    return pd.DataFrame(rows, columns=["row", "both"])


def _hashes() -> Column:
    return F.transform("lines", lambda x: F.xxhash64(x))


def template_lines(found: DataFrame) -> DataFrame:
    """(_host, _seq, gone, gone_marked): places of the template's lines in each class of equal pages of a host.

    Only hashes of lines are shuffled: once into classes, once to order them,
    once into blocks of consecutive ranks that overlap by one; then the shared
    lines, counted over host and folder with partial sums.
    """
    keyed = found.where(F.size("lines") > 0).select("row", "host", "path", "places", _hashes().alias("keys"))
    keyed = keyed.withColumn("_seq", F.xxhash64("keys"))
    # Pages of a host with equal lines are one class, which stands where its first page does: however many, they count once.
    first = F.min(F.struct("path", "row", "places"))
    classes = keyed.groupBy("host", "_seq").agg(first.alias("_p"), F.first("keys").alias("keys"))
    classes = classes.select("host", "_seq", "_p.*", "keys")
    ordered = classes.repartitionByRange("host", "path", "row").sortWithinPartitions("host", "path", "row")
    ordered = shared(ordered.select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("_i")), "ordered_pages")
    parts = ordered.groupBy("_part").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    firsts = parts.select("_part", before.alias("_before"))  # one row per partition
    ranked = ordered.join(F.broadcast(firsts), "_part").withColumn("rank", F.col("_before") + F.col("_i"))
    own = F.floor(F.col("rank") / BLOCK)
    blocks = F.array_distinct(F.array(own, F.floor((F.col("rank") - 1) / BLOCK), F.floor((F.col("rank") + 1) / BLOCK)))
    dealt = ranked.select("row", "host", "path", "keys", "rank", own.alias("_own"), F.explode(blocks).alias("block"))
    dealt = dealt.withColumn("core", F.col("_own") == F.col("block")).drop("_own")
    both = dealt.groupBy("block").applyInPandas(_difference, "row bigint, both array<int>")
    folder = F.regexp_extract("path", "^(.*/)[^/]*$", 1)
    lines = ranked.join(both, "row").select("host", folder.alias("folder"), "_seq", "keys", "places", F.explode("both").alias("at"))
    key = F.xxhash64(F.get("keys", F.col("at")), F.get("places", F.col("at")))
    lines = shared(lines.select("host", "folder", "_seq", "at", key.alias("key")), "shared_lines")

    sizes = ordered.groupBy("host", folder.alias("folder")).agg(F.count("*").alias("_n"))
    once = lines.groupBy("host", "folder", "key", "_seq").agg(F.lit(1).alias("_1")).groupBy("host", "folder", "key").agg(F.count("*").alias("_held"))
    in_host = once.groupBy("host", "key").agg(F.sum("_held").alias("_held")).join(sizes.groupBy("host").agg(F.sum("_n").alias("_n")), "host")
    in_host = in_host.where(f"2 * _held >= _n and _held >= {LEAST_OTHER}")
    of_site = in_host.select("host", "key", (F.col("_held") >= LEAST_MARKED).alias("_wide"))
    of_folder = once.join(sizes, ["host", "folder"]).where(f"2 * _held >= _n and _held >= {LEAST_OTHER}").select("host", "folder", "key", F.lit(True).alias("_near"))
    judged = lines.join(of_site, ["host", "key"], "left").join(of_folder, ["host", "folder", "key"], "left").where("_wide is not null or _near")
    return judged.groupBy(F.col("host").alias("_host"), "_seq").agg(
        F.collect_set("at").alias("gone"), F.collect_set(F.when(F.col("_wide"), F.col("at"))).alias("gone_marked")
    )


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url and text (blocks joined by \\n, empty if none) of every row of ``pages``.

    A null or empty html gives an empty text. Equal rows give equal results
    and count as one page of the host; null urls share the empty host.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.xxhash64("page_id", "url", "html").alias("row"), "html")
    found = shared(rows.mapInPandas(_extract, LINES), "page_lines")
    gone = shared(template_lines(found), "template_lines")
    found = found.withColumn("_of", F.xxhash64(_hashes()))
    found = found.join(gone, (F.col("host") == F.col("_host")) & (F.col("_of") == F.col("_seq")), "left")
    drop = F.when(F.col("marked"), F.col("gone_marked")).otherwise(F.col("gone"))
    kept = F.filter("lines", lambda x, i: ~F.array_contains(drop, i))
    text = F.array_join(F.when(drop.isNull(), F.col("lines")).otherwise(kept), "\n")
    return found.select("page_id", "url", text.alias("text"))
