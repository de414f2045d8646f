"""Main text of pages: differencing against the page with the nearest URL, checked by the markup.

A page becomes text lines, one per block. Every page's lines, menus and marked
articles included, are aligned with those of another page by a longest common
subsequence; the shared lines belong to the site, the others are the page's own.
The markup then checks this. Elements that are never main text (menus, forms,
adverts, comments, ...) go, though their lines be the page's own. An article or
main that holds enough of the page's own text is the text, with the shared lines
in it: a line of a story may well stand elsewhere too. Without one, the own lines
are the text. A page with less than a third of its text for itself is weighed by
all its lines.

That other page is the nearest in the order of host and URL path that is not a
near copy, on the side that shares more of the path. Pages are near copies if
their common lines hold two thirds of the characters of the smaller one: what
they share may well be the story. Each distinct page of a host is decided on
once, and equal pages get the same lines. The order is walked through once, range
by range, with the kinds of pages of a range at hand, as hashes of their lines: a
group of near copies of any size costs each member a few comparisons. Over the
ends of a range a page looks on at the nearest ``KINDS`` kinds. A page with no
other kind beside it is decided on by its markup alone. Where pages are aligned
their text is decided on too, and goes back to the rows as positions of lines, if
it differs from what the page alone would give.
"""

from __future__ import annotations

import html as entities
import itertools
import re
from collections import Counter
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import only, shared_folder, written

#: Elements by their part in a page.
BLOCKS = set(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html iframe legend li main menu nav noscript ol optgroup option p pre section select summary table tbody td template textarea tfoot th thead title tr ul".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript iframe xmp noembed noframes".split())
OUTSIDE = set("nav aside form dialog menu button select textarea script style noscript template iframe object svg canvas audio video head footer".split())
PROSE = set("h1 h2 h3 h4 h5 h6 p".split())
#: Whole classes or ids, and roles, that say the same.
OUTSIDE_WORDS = set(
    "ad ads advert adverts advertisement advertising banner promo sponsor sponsored nav navbar navigation menu breadcrumb breadcrumbs sidebar footer masthead "
    "cookie cookies consent notice alert popup modal newsletter subscribe share social related recommended comment comments disqus replies widget toolbar pagination pager copyright".split()
)
OUTSIDE_ROLES = set("navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar toolbar".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*+)>|</?([a-zA-Z][^\s/>]*)[^>]*>", re.S
)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))|([^\s=/"'>]+)""")
ARTICLE, MAIN, PLAIN, OFF = range(4)
#: Kinds of pages (near copies of each other) that a page looks at beyond the ends of its range.
KINDS = 8
BEFORE, AFTER = range(2)
DECIDED, WAITING, ENDS = range(3)


def _is_outside(name: str, attributes: str, in_article: bool) -> bool:
    if name in OUTSIDE or (name == "header" and not in_article):
        return True
    if not attributes or name in ("html", "body", "main"):
        return False
    told = {}
    for key, *values, alone in _ATTRIBUTE.findall(attributes):
        told[(key or alone).lower()] = next((v for v in values if v), "").lower()
    if "hidden" in told or told.get("aria-hidden") == "true" or "display:none" in told.get("style", "").replace(" ", ""):
        return True
    if told.get("role") in OUTSIDE_ROLES:
        return True
    if in_article and name in PROSE:
        return False
    words = set((told.get("class", "") + " " + told.get("id", "")).split())
    if name == "article":
        return bool(words & {"comment", "comments"})
    return bool(words & OUTSIDE_WORDS) or ("header" in words and not in_article)


class Shape(NamedTuple):
    """Where the lines of a page stand."""

    within: list[int]  # three per line: the nearest element around it that is left out (0: none), its article and its main (-1: none)
    holders: list[int]  # of each article and main: the nearest element around it that is left out
    around: list[int]  # the same of each element left out


def page_lines(page: str) -> list[tuple[str, int]]:
    """Text lines of a page, one per block and in page order, each with its region.

    An element that is left out stays if it holds the marked article or main.
    """
    lines, shape = _parsed(page)
    return list(zip(lines, _regions(shape, [len(x) for x in lines])))


def _parsed(page: str) -> tuple[list[str], Shape]:
    lines: list[str] = []
    places: list[int] = []
    # per open element: its name, the nearest element around it that is left out, its article and its main
    stack: list[tuple[str, tuple]] = [("", (0, -1, -1))]
    text: list[str] = []
    around: list[int] = [0]
    holders: list[int] = []

    def close():
        if text:
            line = " ".join(entities.unescape("".join(text)).split())
            if line:
                lines.append(line)
                places.extend(stack[-1][1])
            text.clear()

    at, end = 0, len(page)
    last = page.rfind(">") + 1  # behind it no tag can end, and only a comment can begin
    opened: Counter[str] = Counter()  # names on the stack, so that a foreign end tag is passed over at once
    while at < end:
        found = _TOKEN.search(page, at, last) if at < last else None
        if found is None:
            open_comment = min((i for i in (page.find("<!--", at), page.find("<![CDATA[", at)) if i >= 0), default=end)
            text.append(page[at:open_comment])
            break
        text.append(page[at : found.start()])
        at = found.end()
        closing, name, attributes, broken = found.groups()
        name = (name or broken or "").lower()
        if not name:
            continue
        closing = bool(closing) or page.startswith("</", found.start())
        if name == "br":
            text.append(" ")
            continue
        block = name in BLOCKS
        if block:
            close()
        if closing:
            if opened[name]:
                i = len(stack) - 1
                while stack[i][0] != name:
                    i -= 1
                if stack[-1][1] != stack[i - 1][1]:
                    close()
                opened.subtract(x for x, _ in stack[i:])
                del stack[i:]
        elif name not in VOID:
            if block and stack[-1][0] in ("p", name) and name not in ("div", "section", "ul", "ol", "table", "blockquote", "article") or block and stack[-1][0] == "p":
                opened[stack.pop()[0]] -= 1
            within = stack[-1][1]
            off, article, main = within
            if _is_outside(name, attributes or "", article >= 0):
                close()
                around.append(off)
                within = (len(around) - 1, article, main)
            elif name == "article" and article < 0:
                within = (off, len(holders), main)
                holders.append(off)
            elif name == "main" and main < 0 and article < 0:
                within = (off, article, len(holders))
                holders.append(off)
            if name in RAW:
                over = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>", re.I).search(page, at, last) if at < last else None
                if not within[0] and name not in ("script", "style"):
                    text.append(page[at : over.start() if over else end])
                    close()
                at = over.end() if over else end
            elif not page.endswith("/>", found.start(), at) or block:
                stack.append((name, within))
                opened[name] += 1
    close()
    return lines, Shape(places, holders, around)


def _regions(shape: Shape, sizes: list[int], shared: frozenset | set = frozenset()) -> list[int]:
    """The lines' regions, once it is known which article and main are the text.

    A single article is if it has a quarter of the text, one of several if it has
    half of it; a main if it has a quarter, articles in it included. Articles
    beside a main or an article that is the text are kept with it. Only lines that
    are not ``shared`` have weight, if they are a third of the text.
    """
    within, holders, around = shape
    places = list(zip(within[::3], within[1::3], within[2::3]))
    chars = [0] * len(holders)
    total = whole = 0
    for i, (size, (off, article, main)) in enumerate(zip(sizes, places)):
        whole += 0 if off else size
        if i in shared:
            continue
        total += 0 if off else size
        for holder in (article, main):
            if holder >= 0 and off == holders[holder]:
                chars[holder] += size
    if shared and (3 * total < whole or not total and not any(chars)):
        return _regions(shape, sizes)
    mains = {main for _, _, main in places}
    marked = []
    for is_main in (False, True):
        able = [h for h, n in enumerate(chars) if n and (h in mains) == is_main]
        able = [h for h in able if not holders[h]] or able
        if able:
            best = max(able, key=chars.__getitem__)
            least = 4 if is_main or len(able) == 1 else 2
            if least * chars[best] >= total + (chars[best] if holders[best] else 0):
                marked.append(best)
    kept = {0}
    for holder in marked:
        i = holders[holder]
        while i not in kept:
            kept.add(i)
            i = around[i]
    mains &= set(marked)
    out = []
    for off, article, main in places:
        if off not in kept:
            out.append(OFF)
        elif article >= 0 and marked:
            out.append(ARTICLE)
        else:
            out.append(MAIN if main >= 0 and mains else PLAIN)
    return out


def main_lines(lines: list[tuple], shared: frozenset | set = frozenset()) -> tuple[list, bool]:
    """The lines of the text, and whether they are those that differencing leaves, as no article or main is the text."""
    chosen = [line for line, r in lines if r in (ARTICLE, MAIN)]
    if chosen:
        return chosen, False
    return [line for i, (line, r) in enumerate(lines) if r == PLAIN and i not in shared], True


#: Cells of the table of two pages' shared lines up to which it is held whole, as bits: 8 MB.
WHOLE_TABLE = 1 << 26


def common_lines(a: list[int], b: list[int]) -> list[int]:
    """Positions in ``a`` of a longest common subsequence with ``b``, by bit-parallel rows.

    Only lines that both have are aligned. A big table is halved at the place
    where the lengths of both halves add up to the most, so memory stays linear.
    """
    in_a, in_b = set(a), set(b)
    at = [i for i, x in enumerate(a) if x in in_b]
    a, b = [a[i] for i in at], [x for x in b if x in in_a]
    out: list[int] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        top, bottom, left, right = todo.pop()
        if top == bottom or left == right:
            continue
        if bottom - top == 1 or (bottom - top) * (right - left) <= WHOLE_TABLE:
            out += [at[top + i] for i in _aligned(a[top:bottom], b[left:right])]
            continue
        middle = (top + bottom) // 2
        above = _lengths(a[top:middle], b[left:right])
        below = _lengths(a[middle:bottom][::-1], b[left:right][::-1])[::-1]
        split = left + int((above + below).argmax())
        todo += [(middle, bottom, split, right), (top, middle, left, split)]
    return out


def _rows(a: list[int], b: list[int]):
    """After each line of ``a``: bits that are 0 where a line of ``b`` makes the common subsequence longer."""
    places: dict[int, list[int]] = {}
    for j, x in enumerate(b):
        places.setdefault(x, []).append(j)
    masks = {x: sum(1 << j for j in js) for x, js in places.items()} if len(b) <= 4096 else None
    full = (1 << len(b)) - 1
    state = full
    for x in a:
        # of many lines the masks are made when they are asked for: all at once would not be linear
        met = state & (masks.get(x, 0) if masks is not None else _bits(places.get(x, ()), len(b)))
        state = ((state + met) | (state - met)) & full
        yield state


def _bits(places, n: int) -> int:
    data = bytearray(n // 8 + 1)
    for j in places:
        data[j >> 3] |= 1 << (j & 7)
    return int.from_bytes(data, "little")


def _lengths(a: list[int], b: list[int]):
    """Length of the longest common subsequence of ``a`` with each beginning of ``b``."""
    import numpy as np

    state = (1 << len(b)) - 1
    for state in _rows(a, b):
        pass
    bits = np.unpackbits(np.frombuffer(state.to_bytes(len(b) // 8 + 1, "little"), np.uint8), bitorder="little")[: len(b)]
    return np.concatenate([[0], np.cumsum(1 - bits.astype(np.int64))])


def _aligned(a: list[int], b: list[int]) -> list[int]:
    rows = list(_rows(a, b))
    out, i, j = [], len(a), len(b)
    while i and j:
        if rows[i - 1] >> (j - 1) & 1:
            j -= 1
        else:
            i -= 1
            if not (i and not rows[i - 1] >> (j - 1) & 1):
                out.append(i)
                j -= 1
    return out[::-1]


def main_text(pages: DataFrame, broadcast_rows: int = 200_000) -> DataFrame:
    """``page_id, url, text, n_chars`` for each row of ``pages`` (page_id, url, html).

    Character references are decoded, white space inside a block becomes one
    blank, blocks are joined by an empty line. A null html is an empty page; one
    without main text gives an empty text. A null or odd url belongs to the host
    and path that can be read from it, maybe empty ones. Repeated rows have the
    same text.
    """
    spark, folder = pages.sparkSession, shared_folder(pages.sparkSession, "html")
    rows = only(pages, "page_id", "url", "html")
    rows = rows.withColumn("html", F.coalesce("html", F.lit(""))).withColumn("t1", F.xxhash64("html")).withColumn("t2", F.xxhash64(F.lit(7), "html"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    lined = rows.mapInArrow(_hashes, f"host string, path string, page_id long, t1 long, t2 long, {PAGE}")
    page = ["path", "page_id", "lines", "sizes", *Shape._fields]
    lined = lined.groupBy("host", "t1", "t2").agg(F.min(F.struct(*page)).alias("page"))
    lined = written(lined.select("host", "t1", "t2", "page.*"), f"{folder}/lined")
    # in the order of host and path; a hot host spreads over many ranges
    keys = ["host", "path", "page_id", "t1", "t2"]
    ranges = lined.repartitionByRange(n, *keys).sortWithinPartitions(*keys).withColumn("part", F.spark_partition_id())
    ranges = ranges.select("part", "host", "path", "t1", "t2", "lines", "sizes", *Shape._fields)
    found = written(ranges.mapInArrow(_beside, FOUND), f"{folder}/found")
    ends = found.filter(F.col("state") == ENDS).repartition(1).sortWithinPartitions("part", "side", "rank")  # a few rows per range
    late = ends.mapInArrow(_handed_on, FOUND).unionByName(found.filter(F.col("state") == WAITING))
    late = late.repartition(n, "part").sortWithinPartitions("part", F.desc("state"), "rank").mapInArrow(_late, FOUND)
    decided = found.filter(F.col("state") == DECIDED).unionByName(late)
    # equal pages of several places: the first place with a page to compare with
    best = decided.groupBy("t1", "t2").agg(F.min(F.struct("host", "path", "rank", "side", "kept")).alias("best"))
    kept = written(best.select("t1", "t2", "best.kept").filter(F.col("kept").isNotNull()), f"{folder}/kept")
    if kept.limit(broadcast_rows + 1).count() <= broadcast_rows:
        kept = F.broadcast(kept)  # else by shuffle
    schema = f"page_id {dict(pages.dtypes)['page_id']}, url string, text string, n_chars long"
    return rows.join(kept, ["t1", "t2"], "left").select("page_id", "url", "html", "kept").mapInArrow(_texts, schema)


def _number(line: str) -> int:
    from xxhash import xxh3_64_intdigest

    return xxh3_64_intdigest(line.encode("utf-8", "surrogatepass")) - 2**63


#: The lines of a page by their hashes, their code points and their places (``Shape``).
PAGE = "lines array<long>, sizes array<int>, within array<int>, holders array<int>, around array<int>"


def _hashes(batches):
    import pyarrow as pa

    numbers, whole = pa.list_(pa.int64()), pa.list_(pa.int32())
    kinds = {"host": pa.string(), "path": pa.string(), "page_id": pa.int64(), "t1": pa.int64(), "t2": pa.int64(), "lines": numbers, "sizes": whole, "within": whole, "holders": whole, "around": whole}
    for batch in batches:
        out = []
        for page_id, url, page, t1, t2 in zip(*batch.columns):
            lines, shape = _parsed(page.as_py())
            address = (url.as_py() or "").partition("#")[0].partition("?")[0]
            host, _, path = (address.partition("://")[2] or address).partition("/")
            out.append((host.lower(), path, page_id.as_py(), t1.as_py(), t2.as_py(), [_number(x) for x in lines], [len(x) for x in lines], *shape))
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], kind) for i, kind in enumerate(kinds.values())], list(kinds))


#: DECIDED: the lines of a page that are ``kept`` (null: those that the page alone would give), ``rank`` the fewer the
#: more of the path is shared. WAITING: a page without another kind on ``side`` so far. ENDS: the kinds nearest to a
#: range's end on ``side``, or those beyond it.
FOUND = f"part int, state int, side int, rank int, host string, path string, t1 long, t2 long, {PAGE}, kept array<int>, whole boolean"


class _Page:
    def __init__(self, row: dict):
        self.host, self.path, self.key = row["host"], row["path"], (row["t1"], row["t2"])
        self.lines, self.sizes = row["lines"], row["sizes"]
        self.shape = Shape(*(row[x] for x in Shape._fields))
        #: Parts of the path that the page before it shares with it, once there is one.
        self.nearest = -1
        self.weights: dict[int, int] = {}
        for line, size, region in zip(self.lines, self.sizes, _regions(self.shape, self.sizes)):
            if region != OFF:
                self.weights[line] = self.weights.get(line, 0) + size
        self.size = sum(self.weights.values())

    def common(self, other: _Page) -> int:
        a, b = sorted([self.weights, other.weights], key=len)
        return sum(min(size, b[line]) for line, size in a.items() if line in b)

    def tells(self, other: _Page) -> bool:
        """Whether the two are no near copies, so that lines that both have are not the story."""
        return 3 * self.common(other) < 2 * min(self.size, other.size)

    def same_kind(self, other: _Page) -> bool:
        return 3 * self.common(other) >= 2 * max(self.size, other.size)

    def row(self, part: int, state: int, side: int, rank: int = 0, whole: bool = False) -> tuple:
        return part, state, side, rank, self.host, self.path, *self.key, self.lines, self.sizes, *self.shape, None, whole

    def near(self, other: _Page) -> int:
        import os.path

        return len(os.path.commonprefix([self.path.split("/"), other.path.split("/")]))

    def text(self, shared: frozenset | set = frozenset()) -> list[int]:
        """Positions of the lines that are the text, if ``shared`` ones are the site's."""
        return main_lines(list(enumerate(_regions(self.shape, self.sizes, shared))), shared)[0]

    def against(self, other: _Page, part: int, side: int) -> tuple:
        """The page's text by its differences from another page."""
        shared = set(common_lines(self.lines, other.lines))
        kept = self.text(shared) if shared else None
        if kept is not None and kept == self.text():
            kept = None
        return part, DECIDED, side, -self.near(other), self.host, self.path, *self.key, *[None] * (2 + len(self.shape)), kept, None


def _batches(rows, size: int = 500):
    """Rows of the table ``FOUND`` as batches."""
    import pyarrow as pa

    long, number = pa.int64(), pa.int32()
    kinds = [number] * 4 + [pa.string()] * 2 + [long] * 2 + [pa.list_(long)] + [pa.list_(number)] * 5 + [pa.bool_()]
    names = [field.split()[0] for field in FOUND.split(", ")]
    rows = iter(rows)
    while some := list(itertools.islice(rows, size)):
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in some], kind) for i, kind in enumerate(kinds)], names)


class _Kind:
    def __init__(self):
        self.latest, self.waiting = None, []


def _beside(batches):
    """A range of pages in order, each against the nearest page of another kind on both sides."""

    def rows():
        part = host = first_host = None
        kinds: dict[int, _Kind] = {}  # of the host, the last seen at the end; none is forgotten
        waiting: dict[int, _Kind] = {}  # those of them with waiting pages
        first: list[_Page] = []

        for batch in batches:
            for row in batch.to_pylist():
                page, part = _Page(row), row["part"]
                if page.host != host:
                    # of the host before no page can come any more, in this range or later
                    host, kinds, waiting = page.host, {}, {}
                    first_host = host if first_host is None else first_host
                if not page.size:
                    continue
                near = itertools.islice(reversed(kinds.values()), KINDS)
                own = next((k for k in near if page.same_kind(k.latest)), None)
                # most often the last kind or the one before it
                before = next((k.latest for k in reversed(kinds.values()) if page.tells(k.latest)), None)
                for kind in [k for k in waiting.values() if k is not own and page.tells(k.latest)]:
                    still = []
                    for other in kind.waiting:
                        if not other.tells(page):
                            still.append(other)
                        elif other.near(page) > other.nearest:  # else the page before it decides
                            yield other.against(page, part, AFTER)
                    kind.waiting = still
                    if not still:
                        del waiting[id(kind)]
                if host == first_host and len(first) < KINDS and not any(page.same_kind(x) for x in first):
                    first.append(page)
                own = own or _Kind()
                kinds.pop(id(own), None)
                own.latest = page
                kinds[id(own)] = own
                own.waiting.append(page)
                waiting[id(own)] = own
                if before:
                    page.nearest = page.near(before)
                    yield page.against(before, part, BEFORE)
                elif host == first_host:
                    yield page.row(part, WAITING, BEFORE)
        # another kind may come in the next range
        for kind in waiting.values():
            for page in kind.waiting:
                yield page.row(part, WAITING, AFTER)
        for rank, page in enumerate(first):
            yield page.row(part, ENDS, BEFORE, rank, host == first_host)
        for rank, kind in enumerate(itertools.islice(reversed(kinds.values()), KINDS)):
            yield kind.latest.row(part, ENDS, AFTER, rank, host == first_host)

    yield from _batches(rows())


def _handed_on(batches):
    """For each range the kinds beyond its two ends, the nearest first: all ends in one task."""

    def rows():
        ends: dict[int, tuple[list, list]] = {}
        whole = {}
        for batch in batches:
            for row in batch.to_pylist():
                ends.setdefault(row["part"], ([], []))[row["side"]].append(_Page(row))
                whole[row["part"]] = row["whole"]
        parts = sorted(ends)
        for at, part in enumerate(parts):
            for side, step in ((BEFORE, -1), (AFTER, 1)):
                if not ends[part][side]:
                    continue
                host, met, i = ends[part][side][0].host, [], at + step
                while 0 <= i < len(parts) and len(met) < KINDS:
                    # the near end of the range beyond
                    for page in ends[parts[i]][1 - side]:
                        if page.host == host and len(met) < KINDS and not any(page.same_kind(x) for x in met):
                            met.append(page)
                    if not (whole[parts[i]] and ends[parts[i]][1 - side] and ends[parts[i]][1 - side][0].host == host):
                        break
                    i += step
                for rank, page in enumerate(met):
                    yield page.row(part, ENDS, side, rank)

    yield from _batches(rows())


def _late(batches):
    """Waiting pages against the kinds beyond their range, which come first."""

    def rows():
        part, beyond = None, ([], [])
        for batch in batches:
            for row in batch.to_pylist():
                if row["part"] != part:
                    part, beyond = row["part"], ([], [])
                page = _Page(row)
                if row["state"] == ENDS:
                    beyond[row["side"]].append(page)
                    continue
                other = next((x for x in beyond[row["side"]] if x.host == page.host and page.tells(x)), None)
                if other:
                    yield page.against(other, part, row["side"])

    yield from _batches(rows())


def _texts(batches):
    import pyarrow as pa

    for batch in batches:
        texts = []
        for page, kept in zip(batch.column(2), batch.column(3)):
            lines, shape = _parsed(page.as_py())
            chosen = [lines[i] for i in kept.as_py()] if kept.is_valid else main_lines(list(zip(lines, _regions(shape, [len(x) for x in lines]))))[0]
            texts.append("\n\n".join(chosen))
        columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])
