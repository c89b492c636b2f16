"""Main text of web pages, from their markup and from what repeats on their host.

A page is read as a stream of blocks, each with its zone: the tags and classes around it.
Menus, headers, footers, side bars, notices, adverts, forms, scripts, styles and comments that
the markup names are left out; inside an article only elements whose whole class or id names such a
part are.  The article is the main text; where it is less than half of what the main element
holds, as a teaser is, all of that is.  A page that stands in a form as a whole keeps its text.

What the markup does not name is found by repetition, in two steps.

*Blocks.*  Outside articles and main elements whole blocks are judged by their zone.  The words of
these blocks form one token stream a host, and its suffixes are sorted on their first ``DEPTH`` words,
every one that has so many in its block.  The whole text
of each block is a key, too, so that short blocks are counted exactly.  Keys on at least
``MIN_PAGES`` distinct pages of a host repeat; pages with equal article texts (equal texts, where
nothing is marked as an article) count as one.  A block repeats if its whole text does, or most of
its keys.  A repeated block is removed if it stands on at least ``COVERED`` of the host's pages that
have its zone, or if its zone is mostly repeated, as a mean over these pages and whatever
their length: articles are copied too, and an article on a few pages of many stays.

*Runs.*  The texts that are left, articles included, are joined per host into one stream, whose
suffixes are again compared by their first ``DEPTH`` words, all of them.  Runs are sought on at
least ``COVERED`` of the host's distinct pages (and on ``MIN_PAGES``).  Such a run is on that share of the
pages of some task, too, however pages are dealt over tasks; so each task names the suffixes
that are on that share of its own pages of a host, and only these are counted over all pages.  The words
that such runs cover are removed and the unique runs between are kept; a page whose greater half would
go is a copied article and stays whole.

Pages are parsed once, into a stored table.  The sorts are Spark groupings on (host, key), so a
host with most of the pages is spread over tasks; no page meets another one.

Null html is empty and gives empty text.  Unclosed tags, quotes and truncated pages are read as
far as they go, in time that grows with their length.  Repeated rows each get a row (the same page
twice counts as two pages); null urls are one host.  An empty table gives no rows.  Other
columns are not read.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from functools import cache, lru_cache
from hashlib import blake2b
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtide.llm.common import maybe_broadcast, short_batches, stored, table, tidy
from jobtide.llm.shingles import window_hashes, word_hashes

DEPTH, SPREAD, MIN_PAGES, COVERED = 8, 48, 3, 0.5
# Suffixes that a task compares at once.
HELD = 1 << 22

_SPECIAL, _NAME = re.compile(r"[>\"']"), re.compile(r"/?([a-zA-Z][^\s/>]*)")
_ATTRIBUTE = re.compile(r"""\b(class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)

# Elements that begin a block, that have no end tag, and that hold no article.
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup html legend li main menu nav ol option p pre search section select summary "
    "table tbody td tfoot th thead tr ul".split())
BREAKS = frozenset(["br", "hr"])
RAW = frozenset("script style noscript template textarea svg iframe object canvas title".split())
DROPPED = frozenset("head nav aside footer header menu dialog search select button".split())
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th"}, "th": {"td", "th"},
             "tr": {"tr", "td", "th"}, "option": {"option"}}
_HINT = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisements?|adsense|banner|sponsor(?:ed)?|promo(?:tion)?|side-?bar|menu|nav(?:bar|igation)?|"
    r"breadcrumbs?|footer|header|masthead|cookies?|consent|notices?|gdpr|popup|modal|newsletter|subscribe|sign-?up|login|share|"
    r"sharing|social|comments?|disqus|discussion|replies|reply|respond|related|recommended|widget|toolbar|pagination|pager)"
    r"(?:$|[\s_-])", re.I)
_NAMED_PART = re.compile(
    r"(?:^|\s)(?:ads?|adverts?|advertisements?|sponsored|promo|banner|menu|nav|side-?bar|breadcrumbs?|pagination|newsletter|subscribe|"
    r"cookie-?(?:bar|banner|notice)|(?:social-)?(?:share|sharing)(?:-(?:bar|buttons?|links?|tools))?|social-(?:bar|buttons?|links?)|"
    r"comments?(?:-(?:area|form|list|section))?|disqus_thread|related(?:-(?:articles|links|posts|stories))?)(?:$|\s)", re.I)
_ROLES = frozenset("navigation banner contentinfo complementary search alert dialog menu form".split())


# Why a block is left out: for a form around it, which may hold the whole page, or for what it is.
FORM, PART = 1, 2


class Block(NamedTuple):
    zone: int
    level: int  # 2 inside an article, 1 inside the main element, 0 elsewhere
    dropped: int  # FORM or PART where the markup names it as something else
    text: str


class _Open(NamedTuple):
    tag: str
    zone: int
    level: int
    dropped: int


@lru_cache(maxsize=1 << 14)
def _zone(above: int, tag: str, label: str) -> int:
    return _number(f"{above}>{tag}.{label}")


def _opened(tag: str, attrs: str, above: _Open) -> _Open:
    named = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attrs)} if "=" in attrs else {}
    names = f"{named.get('class', '')} {named.get('id', '')}".strip()
    role = named.get("role", "").lower()
    level = above.level
    if tag == "article" or named.get("itemprop", "").lower() == "articlebody":
        level = 2
    elif tag == "main" or role == "main":
        level = max(level, 1)
    # A header inside an article holds its title.
    own_header = tag == "header" and above.level == 2
    hint = _NAMED_PART if level == 2 else _HINT
    dropped = above.dropped
    if (tag in DROPPED and not own_header) or role in _ROLES or (
            names and tag not in ("body", "html", "main") and not own_header and hint.search(names)):
        dropped = PART
    elif tag == "form":
        dropped = max(dropped, FORM)
    label = re.sub(r"\d+", "", named.get("class", "").split(" ")[0])
    return _Open(tag, _zone(above.zone, tag, label), level, dropped)


class _Tags:
    """The ends of tags, quotes observed, in time that grows with the length of the page.

    A quote that is never closed is a character like others.  A search that fails has passed
    places outside quotes; a later search that comes to one of them fails, too.
    """

    def __init__(self, html: str):
        self.html = html
        self.last = {sign: html.rfind(sign) for sign in ">\"'"}
        self.failed: set[int] = set()
        self.known = (1, 0)  # no special sign from the first place up to the second, which is one

    def _next(self, at: int) -> int:
        if not self.known[0] <= at <= self.known[1]:
            found = _SPECIAL.search(self.html, at)
            self.known = (at, found.start() if found else len(self.html))
        return self.known[1]

    def end(self, at: int) -> int:
        """The place of the sign that closes the tag, or -1."""
        passed = []
        while at <= self.last[">"]:
            place = self._next(at)
            sign = self.html[place]
            if sign == ">":
                return place
            if place in self.failed:
                break
            passed.append(place)
            at = self.html.index(sign, place + 1) + 1 if self.last[sign] > place else place + 1
        self.failed.update(passed)
        return -1


@cache
def _closing(tag: str) -> re.Pattern:
    return re.compile(rf"</{re.escape(tag)}\s*>", re.I)


def _stream(html: str) -> Iterator[tuple[str, str, str]]:
    """(kind, tag or text, attributes): kind is text, open or close.  Comments and raw elements are left out."""
    tags, at = _Tags(html), 0
    while at < len(html):
        if html[at] != "<":
            end = html.find("<", at)
            end = len(html) if end < 0 else end
            yield "text", html[at:end], ""
            at = end
        elif html.startswith("<!--", at):
            end = html.find("-->", at + 4)
            at = len(html) if end < 0 else end + 3
        elif html[at + 1:at + 2] in ("!", "?") or html.startswith("</", at) and not _NAME.match(html, at + 1):
            end = html.find(">", at)
            at = len(html) if end < 0 else end + 1
        elif not (name := _NAME.match(html, at + 1)):
            yield "text", "<", ""
            at += 1
        elif (end := tags.end(name.end())) >= 0:
            tag, closes = name[1].lower(), html[at + 1] == "/"
            at = end + 1
            if tag in RAW and not closes:
                closing = _closing(tag).search(html, at)
                at = closing.end() if closing else len(html)
            else:
                yield "close" if closes else "open", tag, html[name.end():end]
        elif html.find("<", at + 1) < 0 and tags.last[">"] < at:
            at = len(html)  # the page is cut off inside a tag
        else:
            yield "text", "<", ""
            at += 1


def read_blocks(html: str | None) -> list[Block]:
    """All blocks with text, in page order."""
    stack = [_Open("", 0, 0, 0)]
    opened: Counter = Counter()
    blocks: list[Block] = []
    parts: list[str] = []

    def end_block() -> None:
        if parts:
            text = " ".join("".join(parts).split())
            parts.clear()
            if text:
                top = stack[-1]
                blocks.append(Block(top.zone, top.level, top.dropped, text))

    def pop() -> str:
        tag = stack.pop().tag
        opened[tag] -= 1
        return tag

    for kind, tag, attrs in _stream(html or ""):
        if kind == "text":
            parts.append(entities.unescape(tag) if "&" in tag else tag)
        elif tag in BREAKS:
            parts.append(" ")
        elif tag == "button" or tag in BLOCKS:
            end_block()
            if kind == "close":
                while opened[tag] and pop() != tag:
                    pass
            else:
                if stack[-1].tag == "p":
                    pop()
                while stack[-1].tag in CLOSED_BY.get(tag, ()):
                    pop()
                stack.append(_opened(tag, attrs, stack[-1]))
                opened[tag] += 1
    end_block()
    return blocks


def _number(text: str) -> int:
    return int.from_bytes(blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def block_keys(text: str) -> list[int]:
    """The key of the whole block, then those of all its runs of ``DEPTH`` words; a shorter block is its only run."""
    words = text.split(" ")
    runs = (" ".join(words[i:i + DEPTH]) for i in range(max(1, len(words) - DEPTH + 1)))
    return list(dict.fromkeys([_number(text), *map(_number, runs)]))


def main_blocks(blocks: list[Block]) -> list[Block]:
    """What the markup allows: the article, or all of the main element where the article is its smaller part."""
    allowed = [b for b in blocks if not b.dropped] or [b for b in blocks if b.dropped == FORM]
    size = Counter()
    for b in allowed:
        size[b.level] += len(b.text)
    level = 2 if size[2] and size[2] >= size[1] else 1 if size[1] else 0
    return [b for b in allowed if b.level >= level]


def _host(url: str | None) -> str:
    m = re.match(r"(?s).*?://([^/?#]*)", url or "")
    return m[1].lower() if m else ""


_READ = ("host bigint, body bigint, marked boolean, texts array<string>, "
         "zones array<bigint>, outside array<string>")


def read_pages(pages: DataFrame) -> DataFrame:
    """Every page read once: id, page_id, url, then its host, a number of its article text, whether
    the markup names an article, the blocks' texts; and zones and texts of all blocks outside articles,
    which without an article are the texts themselves and not kept twice."""
    page_type = pages.schema["page_id"].dataType
    lists = [pa.list_(pa.string()), pa.list_(pa.int64()), pa.list_(pa.string())]
    types = [pa.int64(), pa.int64(), pa.bool_(), *lists]

    @tidy
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            rows: list[tuple] = []
            for url, html in zip(batch.column("url").to_pylist(), batch.column("html").to_pylist()):
                blocks = read_blocks(html)
                found = main_blocks(blocks)
                marked = any(b.level for b in found)
                outside = [b for b in found if not b.level] if not marked else [b for b in blocks if not b.dropped and not b.level]
                texts = [b.text for b in found]
                rows.append((
                    _number(_host(url)), _number("\n".join(texts)), marked, texts,
                    [b.zone for b in outside], [b.text for b in outside] if marked else None))
            columns = list(zip(*rows)) or [()] * len(types)
            ids = pa.array(range(number, number + len(rows)), pa.int64())
            number += len(rows)
            yield pa.RecordBatch.from_arrays(
                [ids, batch.column("page_id"), batch.column("url"), *(pa.array(c, t) for c, t in zip(columns, types))],
                ["id", "page_id", "url", "host", "body", "marked", "texts", "zones", "outside"])

    return pages.select("page_id", "url", "html").mapInArrow(
        read, f"id bigint, page_id {page_type.simpleString()}, url string, {_READ}")


def _with_keys(pages: DataFrame) -> DataFrame:
    """(id, host, body, marked, place, zone, keys) of the blocks outside articles."""
    blocks = pages.select("id", "host", "body", "marked", F.posexplode(
        F.arrays_zip("zones", F.coalesce("outside", "texts").alias("texts"))).alias("place", "b"))
    read = blocks.select("id", "host", "body", "marked", "place", F.col("b.zones").alias("zone"), F.col("b.texts").alias("text"))

    @tidy
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = pa.array([block_keys(text) for text in batch.column("text").to_pylist()], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], keys], [*batch.schema.names[:-1], "keys"])

    return read.mapInArrow(emit, "id bigint, host bigint, body bigint, marked boolean, place int, zone bigint, keys array<bigint>")


def repeated_blocks(read: DataFrame) -> DataFrame | None:
    """(id, places): the blocks of unmarked pages that are boilerplate of their host; None without such pages.

    ``read`` has to be a stored table.  Only hosts with an unmarked page are looked at.
    """
    unmarked = stored(read.where("not marked").select(F.col("host").alias("_host")).distinct(), "unmarked-hosts")
    n_hosts = unmarked.count()
    if not n_hosts:
        return None
    asked = read.join(maybe_broadcast(unmarked, n_hosts, 16), F.col("host") == F.col("_host"), "left_semi")
    blocks = stored(_with_keys(asked), "block-keys")
    keyed = blocks.select("*", F.explode("keys").alias("key"))
    pages = F.count(F.lit(1)).alias("pages")
    shared = stored(
        keyed.select("host", "zone", "key", "body").distinct().groupBy("host", "zone", "key").agg(pages).where(
            F.col("pages") >= MIN_PAGES), "shared-keys")
    whole = F.max(F.when(F.col("key") == F.col("keys")[0], F.col("pages")))
    repeated = stored(
        keyed.join(maybe_broadcast(shared, shared.count(), 64), ["host", "zone", "key"]).groupBy(
            "id", "place", "host", "zone", "body", "marked").agg(
                F.coalesce(whole, F.avg("pages")).alias("pages"), whole.isNotNull().alias("exact"),
                F.count(F.lit(1)).alias("covered"), F.max(F.size("keys")).alias("of")).where(
                    F.col("exact") | (F.col("covered") > F.col("of") * COVERED)), "repeated-blocks")
    count = F.count(F.lit(1))
    on_page = blocks.groupBy("host", "zone", "body").agg(count.alias("n")).join(
        repeated.groupBy("host", "zone", "body").agg(count.alias("n_repeated")), ["host", "zone", "body"], "left")
    zones = on_page.groupBy("host", "zone").agg(
        count.alias("of_pages"), F.avg(F.coalesce("n_repeated", F.lit(0)) / F.col("n")).alias("share"))
    removed = repeated.where("not marked").join(zones, ["host", "zone"]).where(
        (F.col("pages") >= F.col("of_pages") * COVERED) | (F.col("share") >= COVERED))
    return removed.groupBy("id").agg(F.collect_list("place").alias("places"))


def without_blocks(read: DataFrame) -> DataFrame:
    """The stored pages with ``texts`` cut down to the blocks that are no boilerplate of their host."""
    kept = ["id", "page_id", "url", "host", "body", "texts"]
    found = repeated_blocks(read)
    if found is None:
        return read.select(*kept)
    removed = stored(found, "removed-blocks")
    size = removed.agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("places")).alias("p")).first()
    side = maybe_broadcast(removed.withColumnRenamed("id", "_id"), size["n"] * 4 + (size["p"] or 0), 16)
    left = F.when(F.col("places").isNull(), F.col("texts")).otherwise(
        F.filter("texts", lambda _, i: ~F.array_contains("places", i)))
    unmarked = read.where("not marked").join(side, F.col("id") == F.col("_id"), "left").withColumn("left", left).withColumn(
        "texts", F.when(F.size("left") > 0, F.col("left")).otherwise(F.col("texts")))
    return stored(read.where("marked").select(*kept).union(unmarked.select(*kept)), "left-blocks")


def kept_suffixes(keys: np.ndarray, starts: Sequence[int] = ()) -> np.ndarray:
    """Places of the suffixes that are compared: all, wherever blocks start."""
    return np.arange(len(keys))


def _suffixes(batch: pa.RecordBatch) -> Iterator[tuple[int, int, int, np.ndarray]]:
    """(id, host, body, key of each word's suffix) of the pages of a batch."""
    columns = [batch.column(c).to_pylist() for c in ("id", "host", "body", "texts")]
    for start in range(0, len(columns[0]), 64):
        part = [c[start:start + 64] for c in columns]
        words = word_hashes([" ".join(texts) for texts in part[3]])
        for own, host, body, _, hashes in zip(*part, words):
            yield own, host, body, window_hashes(hashes, DEPTH).view(np.int64)


def _keyed(pages: DataFrame) -> DataFrame:
    """(id, host, body, place, key) of the suffixes of all pages."""
    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = []
        for own, host, body, keys in _suffixes(batch):
            at = kept_suffixes(keys)
            found.append((np.full(len(at), own), np.full(len(at), host), np.full(len(at), body), at, keys[at]))
        columns = [np.concatenate(c) for c in zip(*found)] if found else [np.zeros(0, np.int64)] * 5
        return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], ["id", "host", "body", "place", "key"])

    @tidy
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                yield rows(batch.slice(start, 64))

    return pages.select("id", "host", "body", "texts").mapInArrow(
        emit, "id bigint, host bigint, body bigint, place bigint, key bigint")


def _distinct_pages(pages: DataFrame) -> DataFrame:
    """One page of each body of a host, and whether all its suffixes are to be named.

    Pages of one body differ only where blocks of some were removed; then all of them are given, to be named whole.
    """
    text = F.xxhash64("texts")
    several = pages.groupBy(F.col("host").alias("_host"), F.col("body").alias("_body")).agg(
        F.count(F.lit(1)).alias("n"), F.min("id").alias("first"), (F.min(text) != F.max(text)).alias("differ"))
    copied = stored(several.where("n > 1").drop("n"), "copied-pages")
    same = (F.col("host") == F.col("_host")) & (F.col("body") == F.col("_body"))
    joined = pages.join(maybe_broadcast(copied, copied.count(), 48), same, "left")
    whole = F.coalesce("differ", F.lit(False))
    return joined.where(F.col("first").isNull() | (F.col("first") == F.col("id")) | whole).select(
        "id", "host", "body", "texts", whole.alias("whole"))


def _named(host: int, sets: list[np.ndarray], whole: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    keys, n = np.unique(np.concatenate([*sets, np.zeros(0, np.int64)]), return_counts=True)
    found = np.unique(np.concatenate([keys[n >= COVERED * len(sets)], *whole]))
    return np.full(len(found), host, np.int64), found


def likely_suffixes(pages: DataFrame) -> DataFrame:
    """(host, key), some of them more than once: every suffix on ``COVERED`` of a host's bodies, and few others.

    Were a suffix on a lesser share of the pages in each task, it would be on a lesser share of them all.
    """
    @tidy
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def named() -> Iterator[pa.RecordBatch]:
            for host, (sets, whole) in held.items():
                hosts, keys = _named(host, sets, whole)
                for start in range(0, len(keys), 1 << 16):
                    part = slice(start, start + (1 << 16))
                    yield pa.RecordBatch.from_arrays([pa.array(hosts[part]), pa.array(keys[part])], ["host", "key"])

        held: dict[int, tuple[list, list]] = {}
        size = 0
        for batch in batches:
            whole = batch.column("whole").to_pylist()
            for k, (_, host, _, keys) in enumerate(_suffixes(batch)):
                held.setdefault(host, ([], []))[whole[k]].append(np.unique(keys))
                size += len(keys)
                if size >= HELD:
                    yield from named()
                    held, size = {}, 0
        yield from named()

    return _distinct_pages(pages).mapInArrow(emit, "host bigint, key bigint")


def _of_hosts(pages: DataFrame, found: DataFrame) -> DataFrame:
    """The pages of the hosts of a stored table."""
    own = found.select(F.col("host").alias("_host")).distinct()
    return pages.join(maybe_broadcast(own, own.count(), 32), F.col("host") == F.col("_host"), "left_semi")


def _on_most_pages(keyed: DataFrame, hosts: DataFrame) -> DataFrame:
    """(host, key) on enough of the distinct pages of a host."""
    pages = keyed.select("host", "key", "body").distinct().groupBy("host", "key").agg(F.count(F.lit(1)).alias("n"))
    side = maybe_broadcast(hosts, hosts.count(), 32)
    enough = (F.col("n") >= MIN_PAGES) & (F.col("n") >= COVERED * F.col("bodies"))
    return pages.where(F.col("n") >= MIN_PAGES).join(side, "host").where(enough).select("host", "key")


def repeated_runs(pages: DataFrame) -> DataFrame | None:
    """(id, covered): the words of a page that stand in runs of most pages of its host; None where there are none.

    ``pages`` has to be a stored table.
    """
    bodies = pages.select("host", "body").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("bodies"))
    hosts = stored(bodies.where(F.col("bodies") >= MIN_PAGES), "hosts")
    of_hosts = _of_hosts(pages, hosts)
    likely = stored(likely_suffixes(of_hosts).distinct(), "likely-suffixes")
    n = likely.count()
    if not n:
        return None
    counted = _keyed(_of_hosts(of_hosts, likely)).join(maybe_broadcast(likely, n, 48), ["host", "key"], "left_semi")
    runs = stored(_on_most_pages(counted, hosts), "runs")
    n = runs.count()
    if not n:
        return None
    found = _keyed(_of_hosts(of_hosts, runs)).join(maybe_broadcast(runs, n, 48), ["host", "key"])
    covered = F.array_distinct(F.flatten(F.transform(F.collect_list("place"), lambda p: F.sequence(p, p + DEPTH - 1))))
    return found.groupBy("id").agg(covered.alias("covered"))


def _without(text: Column, covered: Column) -> Column:
    """The words of a text that are not covered; all of them where these are less than half."""
    @F.pandas_udf("string")
    def cut(texts, places):
        out = []
        for t, gone in zip(texts, places):
            words = t.split(" ")
            keep = np.ones(len(words), bool)
            keep[np.array(gone, np.int64)] = False
            out.append(" ".join(w for w, k in zip(words, keep) if k) if 2 * keep.sum() >= len(words) else t)
        return pd.Series(out, dtype=object)

    return cut(text, covered)


def extract_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    short_batches(pages.sparkSession)
    left = without_blocks(stored(read_pages(pages), "read-pages"))
    text = F.array_join("texts", " ")
    runs = repeated_runs(left)
    if runs is None:
        found = left.select("page_id", "url", text.alias("text"))
    else:
        cut = stored(runs.withColumnRenamed("id", "_id"), "covered")
        n = cut.agg(F.count(F.lit(1)) + F.sum(F.size("covered"))).first()[0] or 0
        joined = left.join(maybe_broadcast(cut, n, 16), F.col("id") == F.col("_id"), "left").withColumn("text", text)
        shorter = joined.where("_id IS NOT NULL").withColumn("text", _without(F.col("text"), F.col("covered")))
        found = shorter.select("page_id", "url", "text").union(joined.where("_id IS NULL").select("page_id", "url", "text"))
    return found.withColumn("n_chars", F.char_length("text").cast("bigint"))


def op10_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
