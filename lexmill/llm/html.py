"""Main text of web pages, with site templates removed.

Every page is parsed once.  All block subtrees are hashed on the raw page, before any list is applied, in two ways, and
Spark counts on how many different pages of a host each hash occurs, so that copies of one page count once:

* By their text: host, tag, and the text and digests of the children.  Such a subtree goes if it recurs on
  ``least_pages`` pages (containers outside an article), if that is also ``least_share`` of the host's pages (prose outside
  an article, containers inside one), or if it is ``prose_share`` of them (prose inside one: passages may be quoted).
* By their structure: tag, class, id and role with the shapes of the children, runs of equal ones folded into one, and no
  text.  This meets menus, adverts, notices and footers whose words change from page to page.  A container goes by its
  shape if on its host the shape holds at most ``small`` of the text of the pages that have it, and if it recurs on
  ``least_pages`` pages and ``least_share`` of the host's, or on as many hosts.  The second count serves hosts of few pages
  by the same rule.  Lists and what stands inside an article go by their shape only if at least half their text is links.
  What holds much of a host's text is thereby kept, whatever its shape.

Tags and roles of the contract (script, style, nav, form, ...) go as well, and so do class words for what may be long,
differs from page to page and can't be counted (comments, adverts, related links).
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexmill.llm.scratch import discard, materialise

TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"'=]++|=\s*+(?:"[^"]*+"|'[^']*+')?|["'])*+)>""",
    re.S,
)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
WORD = re.compile(r"[a-z0-9]+")

# Fixed values of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead title tr ul".split()
)
CLOSES_P = BLOCK - frozenset("body caption dd dt head html legend li optgroup option tbody td tfoot th thead title tr".split())
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dd dt td th tr tbody table ul ol dl figcaption caption".split())
SIBLINGS = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu", "dir"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "tr": (frozenset(["tr", "td", "th"]), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "option": (frozenset(["option"]), frozenset(["select", "datalist"])),
}

# Our own lists of what isn't main text.
DROP_TAGS = frozenset("script style textarea title xmp iframe noembed noframes noscript template head nav footer aside form button select datalist svg canvas math object audio video map dialog menu search".split())
DROP_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert status menu menubar toolbar".split())
VARYING_WORDS = frozenset(
    "comment comments disqus respond reply replies ad ads advert adverts advertisement advertising adsense adslot"
    " sponsor sponsored sponsors sidebar related recommended recommendations share sharing pagination pager".split()
)
LISTS = frozenset("ul ol dl table menu".split())
OUTSIDE, MAIN, ARTICLE = 0, 1, 2
ABSOLUTE, SHARE, PROSE_SHARE = 0, 1, 2


def _attributes(text: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for m in ATTRIBUTE.finditer(text):
        value = m.group(2) or ""
        out.setdefault(m.group(1).lower(), entities.unescape(value[1:-1] if value[:1] in "\"'" else value))
    return out


def _unwanted(tag: str, attributes: dict[str, str], in_main: bool, lists: bool) -> bool:
    """Whether an element goes on every host; without ``lists`` only what is no text of a page at all."""
    if not lists:
        return tag in RAW or tag in ("head", "template", "noscript")
    if tag in DROP_TAGS or (tag == "header" and not in_main):
        return True
    if not attributes or tag in ("html", "body"):
        return False
    hidden = "hidden" in attributes or attributes.get("aria-hidden") == "true"
    if hidden or "display:none" in attributes.get("style", "").replace(" ", "").lower():
        return True
    if attributes.get("role", "").lower() in DROP_ROLES:
        return True
    named = _named(attributes)
    if tag in ("article", "main"):
        return "comment" in named or "comments" in named
    return any(w in VARYING_WORDS for w in named)


def _named(attributes: dict[str, str]) -> list[str]:
    return WORD.findall((attributes.get("class", "") + " " + attributes.get("id", "")).lower())


def _signature(tag: str, attributes: dict[str, str]) -> str:
    """Tag, words of class and id without numbers, and role."""
    if not attributes:
        return tag
    named = sorted({w.strip("0123456789") for w in _named(attributes)} - {""})
    return " ".join([tag, *named, attributes.get("role", "").lower()])


def _digest(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode(errors="surrogatepass"), digest_size=8).digest(), "little", signed=True)


class Page:
    """A parsed page: its lines with their regions, the spans of subtrees in them, and the subtrees to count.

    ``spans`` holds (key, first line, line after the last) of subtrees that have text left; ``seen`` maps the key of
    every block subtree of the raw page to the rule of its count; ``shapes`` maps the key of a shape on its host to the
    shape and the letters that its subtrees hold, of ``letters`` in all; ``context`` is the digest of the text before templates
    are deleted, by which copies of one page count once.
    """

    def __init__(self, page: str, host: str | None = None, lists: bool = True):
        self.lists = lists
        self.lines: list[str] = []
        self.regions: list[int] = []
        self.spans: list[tuple[int, int, int]] = []
        self.seen: dict[int, int] = {}
        self.shapes: dict[int, list[int]] = {}
        self.best = OUTSIDE
        self._walk(page, host)
        self.context = _digest("\n".join(self.chosen()))
        self.letters = sum(map(len, self.lines))
        if self.best == OUTSIDE:  # without an article or main element, what holds most of the page's text isn't template
            for key, lo, hi in self.spans:
                if 2 * sum(map(len, self.lines[lo:hi])) > self.letters:
                    self.seen.pop(key, None)

    def chosen(self, gone: list[tuple[int, int]] = ()) -> list[str]:
        """Lines of the articles, else of the main element, else all, without the spans ``gone``."""
        keep = [r >= self.best for r in self.regions]
        for lo, hi in gone:
            keep[lo:hi] = [False] * (hi - lo)
        return [line for line, ok in zip(self.lines, keep) if ok]

    def text(self, template: frozenset[int] = frozenset()) -> str:
        return "\n".join(self.chosen([(lo, hi) for key, lo, hi in self.spans if key in template]))

    def _walk(self, page: str, host: str | None) -> None:
        stack: list[list] = []  # tag, first line, hashed parts, dropped, region opened, signature, shapes, letters, those of links
        now: list[str] = []
        skip = 0
        open_regions = [0, 0, 0]
        at, end = 0, len(page)
        site = f"{host}\x00" if host is not None else None

        def flush() -> None:
            if now:
                line = " ".join("".join(now).split())
                if line:
                    self.lines.append(line)
                    self.regions.append(ARTICLE if open_regions[ARTICLE] else MAIN if open_regions[MAIN] else OUTSIDE)
                now.clear()

        def text(raw: str) -> None:
            if not raw:
                return
            value = entities.unescape(raw) if "&" in raw else raw
            if stack:
                stack[-1][2].append(value)
            if not skip:
                now.append(value)
                if stack:
                    stack[-1][7] += len(value.strip())

        def close() -> None:
            nonlocal skip
            tag, first, parts, dropped, region, signature, shapes, letters, linked = stack.pop()
            block = tag in BLOCK
            if block and not skip:
                flush()
            if region:
                open_regions[region] -= 1
            body = " ".join("".join(parts).split())
            if body:
                key = _digest(f"{site}{tag}\x00{body}")
                if stack:
                    stack[-1][2].append(f"\x01{key:x}\x02")
                if block and not region and tag not in ("html", "body", "head"):
                    inside = open_regions[ARTICLE] or open_regions[MAIN]
                    rule = (PROSE_SHARE if inside else SHARE) if tag in PROSE else SHARE if inside else ABSOLUTE
                    if site is not None:
                        self.seen[key] = max(rule, self.seen.get(key, 0))
                    if not skip and len(self.lines) > first:
                        self.spans.append((key, first, len(self.lines)))
            shape = _digest(f"{signature}({','.join(shapes)})")
            if tag == "a":
                linked = letters
            if stack:
                above = stack[-1]
                if above[6][-1:] != [name := f"{shape:x}"]:
                    above[6].append(name)
                above[7] += letters
                above[8] += linked
            if site is not None and block and not skip and not region and tag not in ("html", "body", "head") and len(self.lines) > first:
                inside = open_regions[ARTICLE] or open_regions[MAIN]
                if (tag not in PROSE and not inside) or ((tag in LISTS or tag not in PROSE) and 2 * linked >= letters):
                    key = _digest(f"{site}\x01{shape:x}")
                    self.spans.append((key, first, len(self.lines)))
                    held = self.shapes.setdefault(key, [shape, 0])
                    held[1] += sum(map(len, self.lines[first:]))
            if dropped:
                skip -= 1

        while at < end:
            lt = page.find("<", at)
            if lt < 0:
                text(page[at:])
                break
            m = TOKEN.match(page, lt)
            if m is None:
                text(page[at : lt + 1])
                at = lt + 1
                continue
            if lt > at:
                text(page[at:lt])
            at = m.end()
            if m.group(2) is None:
                if m.group(0).startswith("<![CDATA["):
                    text(m.group(0)[9:].removesuffix("]]>").replace("&", "&amp;"))
                continue
            tag = m.group(2).lower()
            if m.group(1):
                if tag in VOID:
                    continue
                if any(e[0] == tag for e in reversed(stack)):
                    while stack[-1][0] != tag:
                        close()
                    close()
                continue
            if tag in CLOSES_P:
                for depth in range(len(stack) - 1, -1, -1):
                    if stack[depth][0] == "p":
                        while len(stack) > depth:
                            close()
                        break
                    if stack[depth][0] in ("button", "td", "th", "caption", "object") or (stack[depth][0] in BLOCK):
                        break
            elif tag in SIBLINGS:
                peers, fence = SIBLINGS[tag]
                for depth in range(len(stack) - 1, -1, -1):
                    if stack[depth][0] in fence:
                        break
                    if stack[depth][0] in peers:
                        while len(stack) > depth:
                            close()
                        break
            if tag in VOID:
                if not skip:
                    if tag == "hr":
                        flush()
                    else:
                        now.append(" ")
                if stack:
                    stack[-1][2].append(" ")
                continue
            attributes = _attributes(m.group(3)) if m.group(3) and not m.group(3).isspace() else {}
            dropped = _unwanted(tag, attributes, bool(open_regions[ARTICLE] or open_regions[MAIN]), self.lists)
            region = OUTSIDE
            if not skip and not dropped and self.lists:
                region = ARTICLE if tag == "article" else MAIN if tag == "main" or attributes.get("role", "").lower() == "main" else OUTSIDE
            if not skip and (region or tag in BLOCK):
                flush()
            if dropped:
                skip += 1
            if region:
                self.best = max(self.best, region)
                open_regions[region] += 1
            stack.append([tag, len(self.lines), [], dropped, region, _signature(tag, attributes), [], 0, 0])
            if tag in RAW:
                stop = re.compile(f"</{tag}(?=[\\s/>])", re.I).search(page, at)
                at = stop.start() if stop else end
        while stack:
            close()
        flush()


def host(url: Column) -> Column:
    """Host of a URL in lower case, without user and port; null where there is none."""
    return F.nullif(F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


SPAN_TYPE = pa.list_(pa.struct([("key", pa.int64()), ("lo", pa.int32()), ("hi", pa.int32())]))
SEEN_TYPE = pa.list_(pa.struct([("key", pa.int64()), ("rule", pa.int8())]))
SHAPE_TYPE = pa.list_(pa.struct([("key", pa.int64()), ("shape", pa.int64()), ("held", pa.int64())]))
ELEMENTS = "array<struct<key:long,rule:tinyint>>"
SHAPES = "array<struct<key:long,shape:long,held:long>>"
SPANS = "array<struct<key:long,lo:int,hi:int>>"


def parsed(pages: DataFrame, lists: bool = True) -> DataFrame:
    """kept (the columns but html, as a struct), site, context, lines, regions, best, spans, seen, shapes and letters of each page.

    The only parse: counting reads ``site``, ``context``, ``seen``, ``shapes`` and ``letters``, deleting the others.
    """
    keep = [F.col(f"`{c}`") for c in pages.columns if c != "html"]
    base = pages.select(F.struct(*keep).alias("kept"), host(F.col("url")).alias("host"), F.col("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64(), pa.int64(), pa.list_(pa.string()), pa.binary(), pa.int8(), SPAN_TYPE, SEEN_TYPE, SHAPE_TYPE, pa.int64()]
        names = ["kept", "site", "context", "lines", "regions", "best", "spans", "seen", "shapes", "letters"]
        for batch in batches:
            lo, size, rows = 0, 0, []
            hosts = batch.column(1).to_pylist()
            for i, page in enumerate(batch.column(2)):
                p = Page(page.as_py() or "", hosts[i], lists)
                site = _digest(hosts[i]) if hosts[i] is not None else None
                rows.append((site, p.context, p.lines, bytes(p.regions), p.best, [{"key": k, "lo": a, "hi": b} for k, a, b in p.spans], [{"key": k, "rule": r} for k, r in p.seen.items()], [{"key": k, "shape": h, "held": n} for k, (h, n) in p.shapes.items()], p.letters))
                size += sum(map(len, p.lines))
                if size > 8 << 20 or i + 1 == len(batch):
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, i + 1 - lo), *(pa.array(c, t) for c, t in zip(zip(*rows), types))], names=names)
                    lo, size, rows = i + 1, 0, []

    out = T.StructType([base.schema["kept"]])
    for name, kind in (("site", "long"), ("context", "long"), ("lines", "array<string>"), ("regions", "binary"), ("best", "tinyint"), ("spans", SPANS), ("seen", ELEMENTS), ("shapes", SHAPES), ("letters", "long")):
        out = out.add(T.StructField(name, T.DataType.fromDDL(kind)))
    return base.mapInArrow(run, out)


def site_templates(parsed_pages: DataFrame, least_pages: int = 5, least_share: float = 0.2, prose_share: float = 0.6) -> DataFrame:
    """key of the subtrees that recur on their host by their text; the key of a subtree holds its host."""
    found = parsed_pages.filter("site is not null").select("site", "context", F.explode("seen").alias("e")).select("site", "context", "e.key", "e.rule")
    each = found.groupBy("key", "context").agg(F.max("rule").alias("rule"), F.min("site").alias("site"))
    counted = each.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("rule").alias("rule"), F.min("site").alias("site")).filter(F.col("n") >= least_pages)
    share = F.when(F.col("rule") == ABSOLUTE, F.lit(0.0)).when(F.col("rule") == SHARE, F.lit(least_share)).otherwise(F.lit(prose_share))
    return counted.join(site_sizes(parsed_pages), "site").filter(F.col("n") >= F.col("contexts") * share).select("key")


def shape_templates(parsed_pages: DataFrame, least_pages: int = 5, least_share: float = 0.2, small: float = 0.2) -> DataFrame:
    """key of the shapes that recur on their host, or on several hosts, and hold little of the text there.

    The counts by host are written before they are joined with those of all hosts, so that a shape that every host has is
    a key that adaptive execution can split.
    """
    found = parsed_pages.filter("site is not null").select("site", "context", "letters", F.explode("shapes").alias("e")).select("site", "context", "letters", "e.*")
    each = found.groupBy("key", "context").agg(F.min("site").alias("site"), F.min("shape").alias("shape"), F.max("held").alias("held"), F.max("letters").alias("letters"))
    own = each.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("site").alias("site"), F.min("shape").alias("shape"), F.sum("held").alias("held"), F.sum("letters").alias("letters"))
    own = materialise(own, "shapes")
    pool = own.groupBy("shape").agg(F.count(F.lit(1)).alias("hosts"), F.sum("held").alias("all_held"), F.sum("letters").alias("all_letters"))
    pool = materialise(pool.filter((F.col("hosts") >= least_pages) & (F.col("all_held") <= small * F.col("all_letters"))).select("shape", "hosts"), "pool")
    little = own.filter(F.col("held") <= small * F.col("letters")).join(site_sizes(parsed_pages), "site").join(pool, "shape", "left")
    return little.filter(((F.col("n") >= least_pages) & (F.col("n") >= F.col("contexts") * least_share)) | F.col("hosts").isNotNull()).select("key")


def site_sizes(parsed_pages: DataFrame) -> DataFrame:
    """site and the number of its different contexts."""
    return parsed_pages.filter("site is not null").select("site", "context").distinct().groupBy("site").agg(F.count(F.lit(1)).alias("contexts"))


BROADCAST_ROWS = 1 << 18


def _flags(spans: pa.ListArray, wanted: np.ndarray) -> np.ndarray:
    """Which of the flattened spans have a key of the sorted array ``wanted``."""
    keys = spans.flatten().field("key").to_numpy(zero_copy_only=False)
    if not len(wanted):
        return np.zeros(len(keys), dtype=bool)
    return wanted[np.minimum(np.searchsorted(wanted, keys), len(wanted) - 1)] == keys


def main_text(pages: DataFrame, least_pages: int = 5, least_share: float = 0.2, prose_share: float = 0.6, small: float = 0.2, lists: bool = True, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``pages`` with html replaced by text and n_chars (existing columns of these names are replaced).

    Null and empty html give an empty text; a page whose url has no host has no template.  Broken mark-up is read as
    browsers do where that is simple: open elements end with their parent, comments and raw elements at the end of the
    page.  Repeated rows are pages of their own but count once; long pages are read whole.  Without ``lists`` no tag, role
    or class word decides, articles neither, and counts alone do.  Template keys are broadcast up to ``broadcast_rows`` of
    them and joined beyond.
    """
    base = pages.drop("text", "n_chars")
    table = materialise(parsed(base, lists), "parsed")
    found = site_templates(table, least_pages, least_share, prose_share).unionByName(shape_templates(table, least_pages, least_share, small))
    templates = materialise(found, "templates")
    keys = _bounded(templates, "key", broadcast_rows)
    if keys is None:
        table = _marked(table, templates)
    else:
        discard(templates)
        table = table.withColumn("template", F.lit(None).cast("array<long>"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            spans = col["spans"]
            flat = spans.flatten()
            key, lo, hi = (flat.field(f).to_numpy(zero_copy_only=False) for f in ("key", "lo", "hi"))
            ptr = np.concatenate([[0], np.cumsum(spans.value_lengths().to_numpy(zero_copy_only=False))])
            gone = _flags(spans, keys) if keys is not None else np.zeros(len(key), dtype=bool)
            texts = []
            for i, (lines, regions, best) in enumerate(zip(col["lines"].to_pylist(), col["regions"].to_pylist(), col["best"].to_pylist())):
                own = slice(ptr[i], ptr[i + 1])
                hit = gone[own] if keys is not None else np.isin(key[own], np.array(col["template"][i].as_py() or [], dtype=np.int64))
                keep = np.frombuffer(regions, dtype=np.uint8) >= best
                for a, b in zip(lo[own][hit], hi[own][hit]):
                    keep[a:b] = False
                texts.append("\n".join([line for line, ok in zip(lines, keep) if ok]))
            yield pa.RecordBatch.from_arrays([col["kept"], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["kept", "text", "n_chars"])

    out = T.StructType([table.schema["kept"]]).add("text", "string").add("n_chars", "long")
    table = table.select("kept", "lines", "regions", "best", "spans", "template")
    return table.mapInArrow(run, out).select("kept.*", "text", "n_chars")


def _bounded(table: DataFrame, column: str, most: int) -> np.ndarray | None:
    """The sorted values of a table of at most ``most`` rows, else None."""
    got = table.limit(most + 1).toPandas()[column].to_numpy(dtype=np.int64)  # at most most + 1 rows
    return np.sort(got) if len(got) <= most else None


def _marked(table: DataFrame, templates: DataFrame) -> DataFrame:
    """``table`` with the template keys of each page, by joins alone."""
    rows = materialise(table.withColumn("row", F.monotonically_increasing_id()), "rows")
    each = rows.select("row", F.explode("spans.key").alias("key")).distinct()
    hits = each.join(templates, "key").groupBy("row").agg(F.collect_list("key").alias("template"))  # of one page
    return rows.join(hits, "row", "left").drop("row")
