"""HTML extraction by differencing pages of nearest URLs.

A page is read into lines: the text of one block each, with what the markup says of the block's
place. Pages of a host are ordered by path, and each is paired with its nearest neighbours, the
page before and the page after it. Copies say nothing of the template: pages of which nearly all is
the same as in the first of them form a run, and the neighbours of a page are the last page of the run
before and the first page of the run after its own. Lines are aligned with each neighbour's by longest
common subsequence, and shared lines are deleted as the site's template.

Differencing alone errs on both sides: articles share quotations with neighbours or are copies of
them, and templates hold lines of their own. So it does not delete what the page itself marks as
its article, and what the markup names as navigation, footer, advert and the like goes whether it
is shared or not. Where a page marks no article, differencing decides all the rest.

Ordering needs one shuffle. Hosts are cut into parts at paths taken from a sample, at most `MAX_PARTS` in
all, so a host with a third of all pages is many parts; a task reads a part run by run. Pages at a
part's border are also sent to the adjoining part as its context: hashes of their lines tell which.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import (
    BooleanType, IntegerType, LongType, StringType, StructField, StructType,
)

from panelspark.llm.common import spread
from panelspark.llm.urls import host_and_path

MAX_PARTS = 1 << 16  # borders that the driver holds: some 10 MB
PAGES_PER_PART = 64
COPY_PERCENT = 95
ADDED = ["text", "n_chars", "n_lines", "n_shared", "n_marked"]

# Element names by what they mean here.
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "xmp", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param",
        "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn",
          "em", "font", "i", "ins", "kbd", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small",
          "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "img"}
DROPPED = {"nav", "footer", "aside", "form", "button", "select", "option", "dialog", "menu", "svg",
           "template", "object", "canvas", "audio", "video", "head", "fieldset", "datalist"}
SECTIONS = {"article", "main", "nav", "footer", "aside", "header", "form", "body", "html", "table",
            "section", "dialog"}
UNNAMED = {"html", "body", "article", "main"}
# Words in class, id or role that name what is not the article.
BOILERPLATE = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "adsense", "sponsor",
    "sponsored", "promo", "promotion", "banner", "cookie", "cookies", "consent", "gdpr", "notice",
    "popup", "modal", "overlay", "newsletter", "subscribe", "subscription", "sidebar", "aside",
    "comment", "comments", "respond", "reply", "replies", "disqus", "nav", "navbar", "navigation",
    "menu", "menubar", "breadcrumb", "breadcrumbs", "footer", "masthead", "topbar", "share",
    "sharing", "social", "related", "recommended", "widget", "login", "signup", "search",
    "pagination", "pager", "toolbar", "complementary", "contentinfo", "alert", "disclaimer",
}
# Names that only mean the page's own header outside an article.
PAGE_HEADER = {"header", "banner", "masthead"}
# A name with one of these says what is not there, or what surrounds it.
NEGATED = {"no", "not", "non", "without", "with", "has", "hide", "is"}
# Words that say nothing of a block's content.
LAYOUT = {"box", "block", "container", "wrapper", "wrap", "inner", "outer", "left", "right", "top",
          "bottom", "row", "col", "column", "item", "list", "area", "unit", "slot", "small", "large"}
# Elements that may hold the whole page although they are not content themselves.
WRAPPERS = {"form", "fieldset"}

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)(?:>|\Z)",
    re.DOTALL,
)
_NAMES = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*[\"']?true", re.I)


def _named(attributes: str) -> tuple[set[str], bool]:
    """(words in class, id and role that name what is not the article, whether that is all that
    these attributes say)."""
    found: set[str] = set()
    only = True
    for m in _NAMES.finditer(attributes):
        value = m.group(2) or m.group(3) or m.group(4) or ""
        for name in re.sub(r"([a-z])([A-Z])", r"\1-\2", value).lower().split():
            words = {w for w in re.split(r"[^a-z0-9]+", name) if w}
            if words & NEGATED:
                continue
            unwanted = words & (BOILERPLATE | PAGE_HEADER)
            found |= unwanted
            only &= bool(unwanted) or all(w in LAYOUT or w.isdigit() for w in words)
    return found, only


Line = tuple[str, bool, bool, bool]


def read_lines(page: str | None) -> tuple[list[Line], bool]:
    """(text, in an article, marked as something else, doubtful) of every line with text, in page
    order, and whether the page marks an article.

    Doubtful are lines of an article whose block bears a name like an advert's among others: a
    neighbour has to share them before they go. A form, or a block named like something else, may be
    round the whole page: if all articles lie in such, that is no reason to drop them.
    """
    page = page or ""
    lines: list[tuple[str, int, bool, bool]] = []
    stack: list[tuple[str, int, bool, bool, bool]] = []  # element, article, dropped, firmly, doubtful
    parts: list[str] = []
    outside, article, wrapped = 0, 1, 2
    has_article = False

    def state() -> tuple[int, bool, bool, bool]:
        return stack[-1][1:] if stack else (outside, False, False, False)

    def flush() -> None:
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            parts.clear()
            if text:
                inside, dropped, _, doubtful = state()
                lines.append((text, inside, dropped, doubtful))

    at = 0
    while True:
        m = _TAG.search(page, at)
        parts.append(page[at : m.start()] if m else page[at:])
        if not m:
            break
        at = m.end()
        name = m.group(2)
        if not name:
            continue
        name = name.lower()
        if m.group(1):
            if name in INLINE:
                continue
            flush()
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == name:
                    del stack[depth:]
                    break
                if stack[depth][0] in SECTIONS and name not in SECTIONS:
                    break
            continue
        if name in RAW:
            if name not in INLINE:
                flush()
            if not m.group(3).endswith("/"):
                end = re.compile(rf"</{name}(?=[\s/>]|\Z)[^>]*>?", re.I).search(page, at)
                at = end.end() if end else len(page)
            continue
        if name in INLINE:
            continue
        flush()
        if name in VOID or name in ("p", "br"):
            continue
        inside, dropped, firmly, doubtful = state()
        names, only = _named(m.group(3)) if m.group(3) else (set(), True)
        if name in ("article", "main"):
            if names & {"comment", "comments", "reply"}:
                dropped = firmly = True
            elif not dropped:
                inside = inside or article
                has_article = has_article or inside == article
            elif not firmly and not inside:
                inside, dropped = wrapped, False
        elif name in DROPPED or (name == "header" and not inside):
            dropped, firmly = True, firmly or name not in WRAPPERS
        elif name not in UNNAMED:
            if m.group(3) and _HIDDEN.search(m.group(3)):
                dropped = firmly = True
            if inside:
                names -= PAGE_HEADER
                dropped = dropped or bool(names) and only
                doubtful = doubtful or bool(names) and not only
            else:
                dropped = dropped or bool(names)
        if not m.group(3).endswith("/"):
            stack.append((name, inside, dropped, firmly, doubtful))
    flush()
    if not has_article and any(inside == wrapped and not dropped for _, inside, dropped, _ in lines):
        has_article, article = True, wrapped
    return [
        (text, inside == article, dropped or inside not in (outside, article), doubtful)
        for text, inside, dropped, doubtful in lines
    ], has_article


def common_lines(a: list[str], b: list[str]) -> set[int]:
    """Positions in `a` of a longest common subsequence with `b`, by bit vectors: one whole number
    of len(a) bits per line of `b`."""
    where: dict[str, int] = {}
    for i, line in enumerate(a):
        where[line] = where.get(line, 0) | 1 << i
    b = [line for line in b if line in where]
    full = (1 << len(a)) - 1
    rows, vector = [], full
    for line in b:
        rows.append(vector)
        match = vector & where[line]
        vector = ((vector + match) | (vector - match)) & full
    rows.append(vector)
    # A zero bit i in row j says that line i raised the length against the first j lines of b.
    found, i = set(), len(a) - 1
    for j in range(len(b), 0, -1):
        while i >= 0 and rows[j] >> i & 1:
            i -= 1
        if i < 0:
            break
        if rows[j - 1] >> i & 1:  # line i is matched by line j of b
            found.add(i)
            i -= 1
    return found


def outline(lines: list[Line], has_article: bool) -> dict[int, int]:
    """Hash of each different line that the markup lets stay, and its characters in the page."""
    found: dict[int, int] = {}
    for text, inside, dropped, _ in lines:
        if not dropped and (inside or not has_article):
            key = xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)
            found[key] = found.get(key, 0) + len(text)
    return found


def are_copies(a: dict[int, int], b: dict[int, int]) -> bool:
    """Whether two outlines share nearly all characters of both."""
    both = sum(min(n, b[k]) for k, n in a.items() if k in b)
    return 100 * both >= COPY_PERCENT * max(sum(a.values()), sum(b.values()))


def _borders(keyed: DataFrame) -> DataFrame:
    """(part, host, side, path, page_key, alone, hashes, chars): for the first and the last host of
    each part its first page, the first of its second run, its last page and the last of the run
    before. `alone`: the part is a single run; its first and last page then have their outline."""

    def outlines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pages = [outline(*read_lines(x.as_py())) for x in batch.column("html")]
            for first in range(0, len(pages), 1_000):
                some, own = pages[first : first + 1_000], batch.slice(first, 1_000)
                yield pa.RecordBatch.from_arrays(
                    [own.column("part"), own.column("host"), own.column("path"),
                     own.column("page_key"),
                     pa.array([list(x) for x in some], pa.list_(pa.int64())),
                     pa.array([list(x.values()) for x in some], pa.list_(pa.int64()))],
                    ["part", "host", "path", "page_key", "hashes", "chars"],
                )

    fields = "part int, host string, path string, page_key string"
    rest = "hashes array<bigint>, chars array<bigint>"
    ordered = keyed.mapInArrow(outlines, f"{fields}, {rest}").repartition(
        spread(keyed), "part"
    ).sortWithinPartitions("part", "host", "path", "page_key")
    schema = StructType.fromDDL(f"{fields}, side string, alone boolean, {rest}")
    arrow = to_arrow_schema(schema)

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def told(hosts: list[dict]) -> pa.RecordBatch:
            out = []
            alone = len(hosts) == 1 and hosts[0]["second"] is None
            for host, sides in ((hosts[0], ("first", "second")), (hosts[-1], ("previous", "last"))):
                for side in sides:
                    if host[side] is not None:
                        part, name, path, key, seen = host[side]
                        out.append({
                            "part": part, "host": name, "path": path, "page_key": key, "side": side,
                            "alone": alone, "hashes": list(seen) if alone else None,
                            "chars": list(seen.values()) if alone else None,
                        })
            return pa.RecordBatch.from_pylist(out, schema=arrow)

        hosts: list[dict] = []  # the first and the last host of the part so far
        for batch in batches:
            columns = [batch.column(c) for c in arrow.names[:4] + ["hashes", "chars"]]
            for values in zip(*columns):
                part, host, path, key, hashes, chars = (v.as_py() for v in values)
                page = (part, host, path, key, dict(zip(hashes, chars)))
                if hosts and hosts[-1]["last"][0] != part:
                    yield told(hosts)
                    hosts = []
                if not hosts or hosts[-1]["last"][1] != host:
                    hosts = hosts[:1] + [
                        {"first": page, "second": None, "previous": None, "run": page, "last": page}
                    ]
                    continue
                now = hosts[-1]
                if not are_copies(now["run"][4], page[4]):
                    now["previous"], now["run"] = now["last"], page
                    now["second"] = now["second"] or page
                now["last"] = page
        if hosts:
            yield told(hosts)

    return ordered.mapInArrow(edges, schema)


def _context(borders: list) -> dict[tuple[str, str, str], list[int]]:
    """The other parts that each page at a border is sent to.

    A part gets the page next to it and the nearest one that is no copy of that; a part that is a
    single run is passed over with its copies.
    """
    found: dict[int, dict] = {}
    for r in borders:
        found.setdefault(r["part"], {})[r["side"]] = r
    sent: dict[tuple[str, str, str], list[int]] = {}
    for step, near, far, own in ((1, "last", "previous", "first"), (-1, "first", "second", "last")):
        got: list = []  # of the part before, nearest first
        before = None
        for part in sorted(found)[::step]:
            sides = found[part]
            if before is None or before[near]["host"] != sides[own]["host"]:
                got = []
            elif not before[near]["alone"]:
                got = [before[near], *([before[far]] if far in before else [])]
            else:
                page, rest = before[near], got
                got, print_of = [page], dict(zip(page["hashes"], page["chars"]))
                for other in rest:
                    known = other["hashes"] is not None
                    if known and are_copies(print_of, dict(zip(other["hashes"], other["chars"]))):
                        continue
                    got.append(other)
                    if known:
                        break
            for page in got:
                sent.setdefault((page["host"], page["path"], page["page_key"]), []).append(part)
            before = sides
    return sent


def _cuts(pages: DataFrame) -> list[tuple[str, str, str]]:
    """Borders of the parts: at most MAX_PARTS - 1 (host, path, id), the same for the same pages."""
    n = pages.count()
    wanted = min(MAX_PARTS, n // PAGES_PER_PART)
    if wanted < 2:
        return []
    every = max(1, n // (8 * wanted))  # some eight sampled pages per part
    rows = pages.where(f"pmod(xxhash64(host, path, page_key), {every}) = 0").collect()
    keys = sorted((r["host"], r["path"], r["page_key"]) for r in rows)
    step = len(keys) / wanted
    return sorted({keys[int(i * step)] for i in range(1, wanted)}) if keys else []


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", source: str = "html"):
    """(page_id, url, text, n_chars, n_lines, n_shared, n_marked) of every page.

    `n_shared` lines were shared with a neighbour, `n_marked` named by the markup as something
    else than the article; of both, those in the article stay, but for shared lines of a doubtful
    block. A NULL or empty page has empty text, a page of any length is read whole; a page with NULL
    url, or one without `://`, belongs to the empty host; equal rows are pages of their own and
    copies; a host of copies alone has no neighbours, so its unmarked pages keep what the markup
    does not name; an empty table has no rows; other columns are left out, whatever their names.
    """
    host, path = host_and_path("url")
    rows = pages.select(
        F.col(f"`{page_id}`").alias("page_id"), F.col(f"`{url}`").cast("string").alias("url"),
        F.col(f"`{source}`").cast("string").alias("html"),
    ).selectExpr(
        "page_id", "url", f"{host} AS host", f"{path} AS path",
        "concat(coalesce(CAST(page_id AS STRING), ''), ' ', hex(xxhash64(html))) AS page_key",
        "html",
    )
    cuts = _cuts(rows.select("host", "path", "page_key"))
    kind = StructField("page_id", rows.schema["page_id"].dataType)
    long = [StructField(n, LongType()) for n in ADDED[1:]]
    result = StructType([
        kind, StructField("url", StringType()), StructField("text", StringType()), *long
    ])
    arrow = to_arrow_schema(result)

    fields = [*rows.schema.fields, StructField("part", IntegerType())]
    schema = StructType([*fields, StructField("context", BooleanType())])

    def dealt(sent: dict):
        # The part depends on host, path and key alone; html passes through without being copied to
        # Python objects.
        def part_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            given = set()
            for batch in batches:
                keys = list(zip(*[batch.column(i).to_pylist() for i in (2, 3, 4)]))
                parts = [bisect_right(cuts, k) for k in keys]
                rows, context = list(range(len(keys))), [False] * len(keys)
                for i, k in enumerate(keys):
                    if k in sent and k not in given:  # of equal rows one is enough
                        given.add(k)
                        rows += [i] * len(sent[k])
                        parts += sent[k]
                        context += [True] * len(sent[k])
                yield pa.RecordBatch.from_arrays(
                    [*(batch if len(rows) == len(keys) else batch.take(pa.array(rows))).columns,
                     pa.array(parts, pa.int32()), pa.array(context, pa.bool_())], schema.names,
                )

        return part_of

    sent = _context(_borders(rows.mapInArrow(dealt({}), schema)).collect()) if cuts else {}
    ordered = rows.mapInArrow(dealt(sent), schema).repartition(
        spread(rows), "part"
    ).sortWithinPartitions("part", "host", "path", "page_key")

    def difference(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def runs():
            """(host of a part, first page, last page, pages): a run's pages are its different
            contents, each with the ids and urls of its copies, so that a copy costs no more."""
            group, first, pages, known, last = None, {}, {}, {}, None
            for batch in batches:
                columns = [batch.column(batch.schema.get_field_index(c)) for c in
                           ("page_id", "url", "part", "host", "html", "context")]
                for values in zip(*columns):
                    i, u, part, site, body, context = (v.as_py() for v in values)
                    lines, has_article = read_lines(body)
                    seen = outline(lines, has_article)
                    if pages and (group != (part, site) or not are_copies(first, seen)):
                        yield group, pages, last
                        pages = {}
                    if not pages:
                        group, first, pages, known = (part, site), seen, {}, {}
                    # Pages of a run hold their common lines once in memory.
                    last = (tuple(known.setdefault(line, line) for line in lines), has_article)
                    pages.setdefault(last, []).extend([] if context else [(i, u)])
            if pages:
                yield group, pages, last
            yield None, None, None

        def texts_of(page) -> list[str]:
            return [line[0] for line in page[0]]

        done, size = [], 0
        group, run, before, last = None, None, None, None
        for next_group, next_run, next_last in runs():
            near = run is not None and next_run is not None and next_group == group
            after = texts_of(next(iter(next_run))) if near else None
            for (lines, has_article), owners in (run or {}).items():
                if not owners:
                    continue
                texts = [line[0] for line in lines]
                shared: set[int] = set()
                for other in (before, after):
                    if other is not None:
                        shared |= common_lines(texts, other)
                kept, marked = [], 0
                for k, (text, inside, dropped, doubtful) in enumerate(lines):
                    marked += dropped or (has_article and not inside)
                    differs = k not in shared
                    if not dropped and (inside and (differs or not doubtful) if has_article else differs):
                        kept.append(text)
                text = " ".join(kept)
                for i, u in owners:
                    done.append({
                        "page_id": i, "url": u, "text": text, "n_chars": len(text),
                        "n_lines": len(lines), "n_shared": len(shared), "n_marked": marked,
                    })
                    size += len(text)
                    if size > 1 << 22:
                        yield pa.RecordBatch.from_pylist(done, schema=arrow)
                        done, size = [], 0
            before = texts_of(last) if near else None
            group, run, last = next_group, next_run, next_last
        if done:
            yield pa.RecordBatch.from_pylist(done, schema=arrow)

    return ordered.mapInArrow(difference, result)
