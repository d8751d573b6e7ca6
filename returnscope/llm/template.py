"""Operator 2: main text of web pages by equivalence-class template deduction.

A page's tokens are the paths of its elements (tags with their class, id and
role words).  A token's occurrence vector is its count on every page of the
host; tokens with equal vectors form an equivalence class.  A class is valid
if it has two tokens or more on two pages or more.  Valid classes nest by
their paths: the class that occurs once on a page is the outer template,
classes that repeat stand inside its slots.  Of the outer template's slots,
the one that holds the main text is taken for the host: an article or main
element if the class has one, else the slot with most paragraph text outside
menus, adverts and the like.  The remaining slots (menus, headers, footers,
sidebars, notices, adverts, forms, reader comments) are dropped, and every
page's text is read from its main slot.  Class, id and role words mark an
element as such a slot by whole words, or compounds of such words and words
for parts of a page; they never count for body, main and article, nor for the
elements around the main slot: a marked element can hold the main slot if it
is named and has more text than the unmarked ones, or if nothing else has
text.  A page without the slot (a host with
one page, another template) is read by the same rule from itself.

Vectors are never laid out: a token carries the xor of a hash per (page,
count), the number of its pages and its total, all of which are partial
aggregates, so a host with a third of all pages is a handful of rows per task
before any shuffle.  One path per host comes out; it is broadcast if there are
at most ``broadcast_hosts`` of them (counted first), else joined with the hosts
salted.  Paths travel as 128-bit hashes, so their length does not matter.

Blocks: text of block elements, entities decoded, white space runs turned into
one space, trimmed, empty blocks left out, joined by newlines in page order.
Defined results: null and empty html have empty text; broken markup is read as
far as it goes; a null url belongs to the host ""; rows that repeat a page_id
are rows of their own.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from returnscope.llm.common import slices, small_batches, written

BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
DROPPED = frozenset(
    "head script style noscript template nav header footer aside form button select option textarea iframe svg canvas object "
    "dialog menu title audio video map datalist noembed noframes".split()
)
#: Words in class, id or role that mark an element as no part of the article.
MARKED = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox adslot banner cookie cookies consent gdpr notice notices popup popover modal "
    "overlay sidebar menu nav navbar navigation breadcrumb breadcrumbs share sharing social related recommended recommendations "
    "comment comments commentlist discussion respond promo promotion sponsor sponsored newsletter subscribe subscription signup login "
    "footer header masthead toolbar pagination pager skip contentinfo complementary search alert disqus outbrain taboola".split()
)
#: Words that form a mark together with one of MARKED ("ad-slot", "share-buttons"); "no-sidebar" or "tag-search" are none.
PARTS = frozenset(
    "slot box container wrapper wrap block unit widget area list bar panel section inner outer left right top bottom primary secondary "
    "main site page global item items button buttons link links icon icons form text message toggle first last".split()
)
MAIN = frozenset("article content post entry story main maincontent articlebody postbody".split())
CLOSES = {  # an opening tag that ends an open element of these
    **dict.fromkeys(BLOCK - {"body", "html"}, frozenset({"p"})),
    "li": frozenset({"li", "p"}), "dt": frozenset({"dt", "dd", "p"}), "dd": frozenset({"dt", "dd", "p"}),
    "tr": frozenset({"tr", "td", "th", "p"}), "td": frozenset({"td", "th", "p"}), "th": frozenset({"td", "th", "p"}),
    "option": frozenset({"option"}), "body": frozenset({"head"}),
}
SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}}
TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>]*+)(>|\Z)|<[!?/][^>]*+(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
WORD = re.compile(r"[a-z]+")
MARK = "!"  # among the words of a path's element: marked as no part of the article
NEVER_MARKED = frozenset("html body main article".split())


def _marks(value: str) -> bool:
    """Whether a word of a class, id or role marks its element."""
    for token in value.split():
        words = WORD.findall(token)
        if not MARKED.isdisjoint(words) and all(w in MARKED or w in PARTS for w in words):
            return True
    return False


class Page:
    """Element paths of a page with their counts, and its blocks of text."""

    def __init__(self, source: str):
        self.count: dict[str, int] = {}
        self.weight: dict[str, int] = {}  # text in paragraphs, by the path around them
        self.blocks: list[tuple[tuple[str, ...], int, bool, str]] = []  # paths around the block, those down to its last mark, dropped, text
        stack: list[tuple[str, str, bool, bool]] = [("", "", False, False)]  # tag, path, dropped, marked
        text: list[str] = []

        def flush() -> None:
            if text:
                line = " ".join("".join(text).split())
                text.clear()
                if line:
                    paths = tuple(x[1] for x in stack[1:] if x[0] in BLOCK)
                    out, side, depth = any(x[2] for x in stack), 0, 0
                    for x in stack[1:]:
                        depth += x[0] in BLOCK
                        if x[3]:
                            side = depth + (x[0] not in BLOCK)
                    self.blocks.append((paths, side, out, line))
                    if not out and stack[-1][0] not in ("a", "li"):
                        for i, p in enumerate(paths[max(side - 1, 0) :], max(side - 1, 0)):
                            self.weight[p] = self.weight.get(p, 0) + len(line) * (i + 1)

        def close(depth: int) -> None:
            if any(x[0] in BLOCK for x in stack[depth:]):
                flush()
            del stack[depth:]

        at, end = 0, len(source)
        while at < end:
            found = TAG.search(source, at)
            if not found:
                self._text(text, source[at:], stack)
                break
            if found.start() > at:
                self._text(text, source[at : found.start()], stack)
            at = found.end()
            tag = (found[2] or found[6] or "").lower()
            if not tag:
                continue
            ending, attributes = found[1] or found[5], found[3] or found[7] or ""
            if not (found[4] or found[8]):
                break  # the page ends inside a tag
            if ending:
                for depth in range(len(stack) - 1, 0, -1):
                    if stack[depth][0] == tag:
                        close(depth)
                        break
                    if tag not in BLOCK and stack[depth][0] in BLOCK and tag != "p":
                        break  # an inline element does not end a block
                continue
            implied = CLOSES.get(tag)
            if implied:
                for depth in range(len(stack) - 1, 0, -1):
                    if stack[depth][0] in SCOPE.get(tag, ()) or stack[depth][0] in BLOCK and stack[depth][0] not in implied:
                        break
                    if stack[depth][0] in implied:
                        close(depth)
                        if tag not in SCOPE:
                            break
            if tag in BLOCK:
                flush()
            elif tag == "br":
                text.append(" ")
            words: list[str] = []
            marked = False
            for name, a, b, c in ATTRIBUTE.findall(attributes) if "=" in attributes else ():
                value = (a or b or c).lower()
                words += WORD.findall(value)
                marked = marked or tag not in NEVER_MARKED and _marks(value)
            label = ".".join([tag, *([MARK] if marked else ()), *sorted(set(words))])
            path = f"{stack[-1][1]}>{label}" if tag in BLOCK or tag in DROPPED else stack[-1][1]
            if path != stack[-1][1]:
                self.count[path] = self.count.get(path, 0) + 1
            if tag in VOID or attributes.endswith("/") and tag not in BLOCK:
                continue
            stack.append((tag, path, tag in DROPPED, marked))
            if tag in RAW:
                stop = re.compile(rf"</{re.escape(tag)}\b[^>]*>?", re.I).search(source, at)
                at = stop.end() if stop else end
                stack.pop()
        flush()

    @staticmethod
    def _text(text: list[str], piece: str, stack: list) -> None:
        text.append(entities.unescape(piece) if "&" in piece else piece)


def _rank(path: str) -> int:
    """How clearly the last element of a path is named as the main text."""
    tag, *words = path.rsplit(">", 1)[-1].split(".")
    if tag == "article":
        return 3
    if tag == "main" or "main" in words:
        return 2
    return int(not MAIN.isdisjoint(words))


def _usable(path: str) -> bool:
    return not any(x.split(".")[0] in DROPPED for x in path.split(">"))


def _tier(path: str) -> int:
    """2: named and not marked, 1: one of both, 0: marked and not named."""
    return int(_rank(path) > 0) + int(not any(MARK in x.split(".")[1:2] for x in path.split(">")))


def _key(path: str) -> str:
    return xxhash.xxh3_128_hexdigest(path)


def main_text(page: Page, key: str | None) -> str:
    """The blocks in the slot of this key, or in the page's own best element if it has none."""
    slot = next((p for p in page.count if _key(p) == key), None) if key else None
    if slot is None:
        own = [p for p in page.count if _usable(p) and p in page.weight]
        slot = max(own, key=lambda p: (_tier(p) == 2, _tier(p), _rank(p) if _tier(p) == 2 else 0, page.weight[p], p), default=None)
        if slot is not None and not _rank(slot):
            slot = None  # nothing is named: the whole page
    inside = [(side > (paths.index(slot) + 1 if slot else 0), line) for paths, side, out, line in page.blocks if not out and (slot is None or slot in paths)]
    kept = [line for marked, line in inside if not marked]
    return "\n".join(kept or [line for _, line in inside])  # marks do not count where they take all text


def host_of(url: str | None) -> str:
    try:
        return (urlsplit(url or "").hostname or "").lower()
    except ValueError:
        return ""


def _pages(pages: DataFrame) -> DataFrame:
    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))


def host_slots(pages: DataFrame) -> DataFrame:
    """host, slot: the key of the main text's path in each host's template."""
    small_batches(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[str, str], list[int]] = {}

        def out() -> pa.RecordBatch:
            keys, values = list(seen), np.array(list(seen.values()), object).reshape(-1, 4)
            columns = [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string())]
            columns += [pa.array([int(v) for v in values[:, i]], pa.int64()) for i in range(4)]
            seen.clear()
            return pa.record_batch(columns, names=["host", "path", "pages", "total", "vector", "weight"])

        for batch in slices(batches, "html"):
            for number, url, source in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html")), strict=True):
                page, host = Page(source or ""), host_of(url)
                mine = xxhash.xxh64_intdigest(f"{number} {url}")
                for path, count in {**page.count, "": 1}.items():
                    token = seen.setdefault((host, path), [0, 0, 0, 0])
                    token[0] += 1
                    token[1] += count
                    mixed = xxhash.xxh64_intdigest(f"{mine} {count}")
                    token[2] ^= mixed - (1 << 64) if mixed >= 1 << 63 else mixed
                    token[3] += page.weight.get(path, 0)
            if len(seen) > 50_000:
                yield out()
        yield out()

    rows = _pages(pages).mapInArrow(run, "host string, path string, pages long, total long, vector long, weight long")
    tokens = rows.groupBy("host", "path").agg(F.sum("pages").alias("pages"), F.sum("total").alias("total"), F.bit_xor("vector").alias("vector"), F.sum("weight").alias("weight"))
    tokens = written(tokens, "tokens")  # read by the classes and by their members
    vector = ["host", "pages", "total", "vector"]
    classes = tokens.groupBy(*vector).agg(F.count(F.lit(1)).alias("members"), F.max(F.col("path") == "").alias("root"))
    valid = classes.filter("members >= 2 AND pages >= 2 AND total = pages")  # occurs once a page: the outer template

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = batch.column("path").to_pylist()
            rank = [_rank(p) if p and _usable(p) else -1 for p in paths]
            tier, key = [_tier(p) for p in paths], [_key(p) for p in paths]
            columns = [batch.column(c) for c in ("host", "path", "pages", "weight")]
            yield pa.record_batch([*columns, pa.array(rank, pa.int32()), pa.array(tier, pa.int32()), pa.array(key, pa.string())], names=["host", "path", "pages", "weight", "rank", "tier", "key"])

    slots = tokens.join(valid, vector).select("host", "path", "pages", "weight").mapInArrow(pick, "host string, path string, pages long, weight long, rank int, tier int, key string")
    best = F.max_by("key", F.struct("tier", "pages", F.when(F.col("tier") == 2, F.col("rank")).otherwise(0), "weight", "path"))
    return slots.filter("rank >= 0 AND weight > 0").groupBy("host").agg(best.alias("slot"), F.max("rank").alias("named")).select("host", "slot")


def extract(pages: DataFrame, broadcast_hosts: int = 100_000, salts: int = 64) -> DataFrame:
    """page_id, url, text, n_chars of every page (see the module)."""
    slots = written(host_slots(pages), "slots")
    few = slots.limit(broadcast_hosts + 1).count() <= broadcast_hosts  # 32 bytes and its name a host
    host = F.coalesce(F.lower(F.regexp_extract("url", r"^[^/?#]*//(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))
    rows = _pages(pages).withColumn("host", host)
    if few:
        rows = rows.join(F.broadcast(slots), "host", "left")
    else:
        salted = slots.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        rows = rows.withColumn("salt", F.pmod(F.hash("page_id", "url"), F.lit(salts))).join(salted, ["host", "salt"], "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            text = [main_text(Page(s or ""), slot) for s, slot in zip(batch.column("html").to_pylist(), batch.column("slot").to_pylist(), strict=True)]
            size = pa.array([len(t) for t in text], pa.int64())
            yield pa.record_batch([batch.column("page_id"), batch.column("url"), pa.array(text, pa.string()), size], names=["page_id", "url", "text", "n_chars"])

    return rows.select("page_id", "url", "html", "slot").mapInArrow(run, "page_id long, url string, text string, n_chars long")
