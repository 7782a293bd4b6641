"""Main text of web pages: a suffix array over the token streams of each host tells boilerplate, the page's structure what it stands in.

A page is cut at its tags into a tree of elements with text. Menus, headers, footers, sidebars, notices, adverts, forms and comments are
left out by element, role and class. A class counts by its last word, but for words as "box" behind it and not after one as "no" or "has"; an element
that only its class marks stays if it holds more than half the text of its article, unless it is one of reader comments. An element to be left out
that is never closed ends at its first block.

What remains of every page is a token stream. The suffixes of a host's distinct streams are sorted by their first eight tokens; equal neighbours
from distinct pages are a repeated substring, and longer ones are covered by their shifted beginnings. A substring is boilerplate if
three pages have it, and a tenth of the host's: a quotation is not. Spark deals the streams out in shards: a small host is in one, with others, and a
large one in as many blocks as its size asks for, since a host may have a third of all pages. What a tenth of a host's pages have, a tenth
of the pages of some block have: each block's array gives its candidates, and these are then sorted in with the suffixes of every block of the host and
counted, so the counts are exact.

The tokens outside boilerplate, the unique runs, are the main text of a page that does not mark its article. Of a page that does they choose
among ``main``, the articles in it and those beside it: the articles in ``main`` where these hold half of its own tokens, else ``main``; articles beside it only if they
hold more. The chosen region is the main text as a whole, without articles, lists, tables and divisions that are boilerplate from end to end: a passage or
paragraph that other pages repeat is still part of the article. A page with hardly anything of its own is a copy of others and stays whole.
"""

from __future__ import annotations

import html
import re
from collections.abc import Sequence
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillroll.llm.groups import Batches
from tillroll.llm.words import pieces
from tillroll.runtime import cut

REPEAT = 8  # tokens of the shortest substring that counts as boilerplate
PAGES = 3  # pages of a host that have it, at least
SHARE = 0.1  # of the host's pages that have it, at least
OWN = 0.1  # of a page's tokens that no other has, at least, or it stays whole
SHARD = 4 << 20  # characters of markup whose streams are sorted in one array, about

# Fixed lists of element names, roles and words in class or id.
RAW = "script style noscript template textarea title iframe svg math object".split()
CHROME = "head nav header footer aside form button select dialog menu fieldset option audio video canvas".split()
ROLES = "navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split()
MARKS = (
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion cookie cookies consent gdpr notice nav "
    "navbar navigation menu breadcrumb breadcrumbs header masthead footer sidebar comment comments disqus replies related share "
    "sharing social newsletter subscribe signup popup modal overlay pagination pager widget copyright legal skip"
).split()
COMMENTS = "comment comments disqus replies".split()
NOT = "no non not has have with without hide hides hidden is".split()  # a class that starts so tells of something else
GENERIC = (
    "box wrapper wrap container inner outer bar area section block blocks list item items link links button buttons text title "
    "panel row col column group widget"
).split()
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong "
    "sub sup time tt u var wbr nobr".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(" + "|".join(RAW) + r")\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?/][^>]*>",
    re.IGNORECASE | re.DOTALL,
)
_MARKED = re.compile(r"(?:class|id|role|style|hidden|aria-hidden)\b", re.IGNORECASE)
_ATTRIBUTE = re.compile(r"([A-Za-z-]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_NAMES = re.compile(r"[a-z]+|[0-9]+")
_CHROME, _ROLES, _MARKS, _COMMENTS, _NOT = map(frozenset, (CHROME, ROLES, MARKS, COMMENTS, NOT))
_GENERIC = frozenset(GENERIC) - _MARKS
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)
KEEP, PERHAPS, LEAVE = 0, 1, 2
MAIN, WITHIN, BESIDE, HOLDER = 0, 1, 2, 3
_HOLDERS = frozenset("article section div ul ol dl table".split())  # boilerplate as a whole, or not at all, where a page marks its article
Spans = Sequence[tuple[int, int, int]]


def _marked_class(value: str) -> int:
    """What the words of a class or id attribute say of an element."""
    found = KEEP
    for name in value.split():
        words = [w for w in _NAMES.findall(name.lower()) if not w.isdigit()]
        while len(words) > 1 and words[-1] in _GENERIC:
            words.pop()
        if words and words[0] not in _NOT and words[-1] in _MARKS:
            if words[-1] in _COMMENTS:
                return LEAVE
            found = PERHAPS
    return found


def _verdict(name: str, attributes: str) -> int:
    """Whether an element is left out: by element, role or comment class for certain, by another class if it is not most of its article."""
    if name in _CHROME:
        return LEAVE
    if name in ("body", "html") or not _MARKED.search(attributes):
        return KEEP
    found = KEEP
    for key, *values in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), "".join(values)
        if key == "role" and value.lower() in _ROLES or key == "style" and _HIDDEN.search(value):
            return LEAVE
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            return LEAVE
        if key in ("class", "id"):
            found = max(found, _marked_class(value))
    return found if found == LEAVE or name not in ("article", "main") else KEEP


class _Page:
    """The elements of a page in document order; 0 is the page itself. ``parts`` of an element are texts and numbers of elements."""

    def __init__(self, page: str):
        self.names, self.parents, self.verdicts = [""], [0], [KEEP]
        self.parts: list[list[str | int]] = [[]]
        self.closed = [True]
        open_, counts, at = [0], {}, 0

        def put(text: str) -> None:
            self.parts[open_[-1]].append(html.unescape(text) if "&" in text else text)

        for tag in _TAG.finditer(page):
            if tag.start() > at:
                put(page[at : tag.start()])
            at = tag.end()
            if tag[3] is None:
                continue
            name = tag[3].lower()
            if tag[2]:
                while counts.get(name):
                    top = open_.pop()
                    counts[self.names[top]] -= 1
                    if self.names[top] == name:
                        self.closed[top] = True
                        break
            elif name in VOID or tag[4].endswith("/"):
                if name not in INLINE:
                    self.parts[open_[-1]].append(" ")
            else:
                self.parts[open_[-1]].append(len(self.names))
                self.parents.append(open_[-1])
                open_.append(len(self.names))
                counts[name] = counts.get(name, 0) + 1
                self.names.append(name)
                self.verdicts.append(_verdict(name, tag[4]))
                self.parts.append([])
                self.closed.append(False)
        if at < len(page):
            put(page[at:])
        self._weigh()

    def _weigh(self) -> None:
        """Settle what only a class marks: most of the text of an article or ``main`` is not left out."""
        weights = [sum(len(p.strip()) for p in parts if isinstance(p, str)) for parts in self.parts]
        for i in range(len(self.names) - 1, 0, -1):
            if self.verdicts[i] != LEAVE:
                weights[self.parents[i]] += weights[i]
        region = [0] * len(self.names)
        for i in range(1, len(self.names)):
            up = self.parents[i]
            region[i] = up if self.names[up] in ("article", "main") else region[up]
            if self.verdicts[i] == PERHAPS:
                self.verdicts[i] = KEEP if region[i] and 2 * weights[i] > weights[region[i]] else LEAVE

    def _shown(self, i: int) -> list[str | int]:
        """Parts of an element that are not left out. One to be left out that was never closed ends at its first block."""
        if self.verdicts[i] == KEEP:
            return self.parts[i]
        if self.closed[i]:
            return []
        blocks = (n for n, p in enumerate(self.parts[i]) if isinstance(p, int) and self.names[p] not in INLINE)
        first = next(blocks, None)
        return [] if first is None else self.parts[i][first:]

    def stream(self) -> tuple[list[str], list[tuple[int, int, int]]]:
        """Tokens of what is not left out, and (kind, start, end) of its regions and of what holds several blocks, in order of their ends.

        Block elements part tokens, inline elements do not. Regions are the outermost ``main`` elements, the outermost articles in them and
        the outermost articles elsewhere.
        """
        tokens: list[str] = []
        spans: list[tuple[int, int, int]] = []
        run: list[str] = []
        todo: list[tuple] = [(0, False, False)]

        def flush() -> int:
            tokens.extend("".join(run).split())
            run.clear()
            return len(tokens)

        while todo:
            part, in_main, in_article = todo.pop()
            if isinstance(part, str):
                run.append(part)
                continue
            if isinstance(part, tuple):
                spans.append((*part, flush()))
                continue
            name, kind = self.names[part], None
            if name not in INLINE:
                run.append(" ")
                todo.append((" ", in_main, in_article))
            if name in ("article", "main") and self.verdicts[part] == KEEP and not in_article:
                if name == "article":
                    kind, in_article = WITHIN if in_main else BESIDE, True
                elif not in_main:
                    kind, in_main = MAIN, True
            elif name in _HOLDERS:
                kind = HOLDER
            if kind is not None:
                todo.append(((kind, flush()), in_main, in_article))
            todo += [(p, in_main, in_article) for p in reversed(self._shown(part))]
        flush()
        return tokens, spans


def _marked(tokens: list[str], spans: Spans, own: list[bool]) -> list[int] | None:
    """Places of the text of a page that marks its article, None for others. ``own`` tells which tokens are the page's own."""

    def places(kind: int) -> list[int]:
        return [i for k, a, b in spans if k == kind for i in range(a, b)]

    def weight(of: list[int]) -> int:
        return sum(len(tokens[i]) for i in of if own[i])

    mains, within, beside = map(places, (MAIN, WITHIN, BESIDE))
    best = within if within and 2 * weight(within) >= weight(mains) else mains
    best = beside if weight(beside) > weight(best) else best
    return best or None


def chosen(tokens: list[str], spans: Spans, starts: Sequence[int] = (), repeat: int = REPEAT, own: float = OWN) -> tuple[bool, str]:
    """(whether the page marks its article, main text) of a page's stream, in which substrings of ``repeat`` tokens from ``starts`` on are boilerplate."""
    new = [True] * len(tokens)
    for a in starts:
        new[a : a + repeat] = [False] * repeat
    anywhere = [i for k, a, b in spans if k != HOLDER for i in range(a, b)]
    region = anywhere or range(len(tokens))
    if sum(new[i] for i in region) < own * len(region):
        new = [True] * len(tokens)
    best = _marked(tokens, spans, new)
    if best is None:
        return False, " ".join(t for t, n in zip(tokens, new, strict=True) if n)
    if not all(new):
        gone = {i for k, a, b in spans if k != MAIN and not any(new[a:b]) for i in range(a, b)}
        best = [i for i in best if i not in gone]
    return True, " ".join(tokens[i] for i in best)


def main_blocks(page: str | None) -> tuple[bool, str]:
    """(whether the page marks its article, text of the article or of everything that is not left out), by the page alone."""
    return chosen(*_Page(page or "").stream())


_STREAMS = "host string, shard long, blocks int, stream string"
_PARSED = "host string, stream string, spans array<int>"
_REPEATED = "shard long, blocks int, host string, substring string"
_MET = "host string, pages long, substring long, page long, at int"


def _streams(batches: Batches) -> Batches:
    """Hosts and streams of pages. A task gives equal streams of one host once."""
    seen: set[bytes] = set()
    for batch in pieces(batches, "html"):
        streams = [" ".join(_Page(h or "").stream()[0]) for h in batch.column("html").to_pylist()]
        kept = []
        for i, (host, stream) in enumerate(zip(batch.column("host").to_pylist(), streams, strict=True)):
            digest = blake2b(f"{host} {stream}".encode("utf-8", "surrogatepass"), digest_size=16).digest()
            if stream and digest not in seen:
                seen.add(digest)
                kept.append(i)
        at = pa.array(kept, pa.int64())
        columns = [batch.column(c).take(at) for c in ("host", "shard", "blocks")]
        yield pa.RecordBatch.from_arrays([*columns, pa.array([streams[i] for i in kept], pa.string())], ["host", "shard", "blocks", "stream"])


def _parsed(batches: Batches) -> Batches:
    """Pages with their stream, and its spans one after another."""
    for batch in pieces(batches, "html"):
        found = [_Page(h or "").stream() for h in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                *(batch.column(c) for c in ("page_id", "url", "host")),
                pa.array([" ".join(tokens) for tokens, _ in found], pa.string()),
                pa.array([[n for span in spans for n in span] for _, spans in found], pa.list_(pa.int32())),
            ],
            ["page_id", "url", "host", "stream", "spans"],
        )


def _chosen(repeat: int, own: float):
    """Main texts of parsed pages, with the places where boilerplate starts."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("stream", "spans", "starts"))
            texts = []
            for stream, flat, starts in zip(*columns, strict=True):
                spans = list(zip(flat[::3], flat[1::3], flat[2::3], strict=True))
                texts.append(chosen(stream.split(" ") if stream else [], spans, starts or (), repeat, own)[1])
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    return run


class _Array:
    """Suffix array of the streams of several hosts, in the order of host and first ``repeat`` tokens.

    ``page`` and ``at`` are the stream and the place of each suffix in that order, and ``run`` numbers the equal ones.
    """

    def __init__(self, streams: pa.Array, hosts: np.ndarray, repeat: int):
        lists = pc.split_pattern(streams.cast(pa.large_string()), " ")
        ends = np.asarray(pc.cumulative_sum(pc.list_value_length(lists)))
        self.first = np.concatenate(([0], ends[:-1])).astype(np.int64)
        words = lists.flatten().dictionary_encode()
        place = np.empty(len(words.dictionary), np.int64)
        place[np.asarray(pc.array_sort_indices(words.dictionary))] = np.arange(len(place))
        rank, size = place[np.asarray(words.indices)], 1
        while size < repeat:  # order of beginnings of ``longer`` tokens from that of ``size`` tokens
            longer = min(2 * size, repeat)
            later = rank[longer - size :]
            pairs = rank[: len(later)] * (int(rank.max(initial=0)) + 1) + later
            rank, size = np.unique(pairs, return_inverse=True)[1], longer
        page = np.repeat(np.arange(len(self.first)), ends - self.first)[: len(rank)]
        at = np.arange(len(rank)) - self.first[page]
        whole = np.flatnonzero(np.arange(len(rank)) + repeat <= ends[page])
        key = hosts[page[whole]] * (int(rank.max(initial=0)) + 1) + rank[whole]
        order = np.argsort(key, kind="stable")
        self.page, self.at, key = page[whole][order], at[whole][order], key[order]
        fresh = np.concatenate(([True], key[1:] != key[:-1]))[: len(key)]
        self.run = np.cumsum(fresh) - 1
        other = fresh | np.concatenate(([True], self.page[1:] != self.page[:-1]))[: len(key)]
        self.held = np.bincount(self.run[other])  # distinct streams of each run
        self.begin = np.flatnonzero(fresh)


def _distinct(table: pa.Table) -> tuple[pa.Table, np.ndarray, pa.Array]:
    """Distinct streams of a shard, the number of each one's host, and the hosts."""
    _, first = np.unique(np.asarray(table.column("page")), return_index=True)
    table = table.take(pa.array(np.sort(first))).combine_chunks()
    hosts = table.column("host").combine_chunks().dictionary_encode()
    return table, np.asarray(hosts.indices).astype(np.int64), hosts.dictionary


def _strings(column: pa.ChunkedArray) -> pa.Array:
    return pa.concat_arrays(column.cast(pa.large_string()).chunks)


def _repeated(repeat: int, pages: int, share: float):
    """Candidates of a shard: substrings that the share of a host's pages in it have, and ``pages`` at least if all of the host's are in it."""

    def run(table: pa.Table) -> pa.Table:
        table, host, hosts = _distinct(table)
        streams, blocks = _strings(table.column("stream")), np.asarray(table.column("blocks"))
        array = _Array(streams, host, repeat)
        here = np.bincount(host, minlength=len(hosts))
        lead = array.page[array.begin]
        least = np.maximum(here[host[lead]] * share, np.where(blocks[lead] > 1, 1, pages))
        found = array.begin[array.held >= least]
        texts = {int(p): streams[int(p)].as_py().split(" ") for p in np.unique(array.page[found])}
        strings = [" ".join(texts[p][a : a + repeat]) for p, a in zip(array.page[found].tolist(), array.at[found].tolist(), strict=True)]
        rows = table.select(["shard", "blocks", "host"]).take(pa.array(array.page[found]))
        return rows.append_column("substring", pa.array(strings, pa.string()))

    return run


def _met(repeat: int):
    """Distinct pages of each host in a shard, and the places where candidates stand, which are sorted in with the streams."""

    def run(table: pa.Table, candidates: pa.Table) -> pa.Table:
        table, host, hosts = _distinct(table)
        n = table.num_rows
        none = pa.nulls(len(hosts), pa.int64())
        here = pa.array(np.bincount(host, minlength=len(hosts)).astype(np.int64))
        counts = pa.table({"host": hosts, "pages": here, "substring": none, "page": none, "at": pa.nulls(len(hosts), pa.int32())})
        number = pc.index_in(candidates.column("host"), hosts)
        candidates, number = candidates.filter(pc.is_valid(number)), pc.drop_null(number)
        if not candidates.num_rows:
            return counts
        streams = pa.concat_arrays([_strings(table.column("stream")), _strings(candidates.column("substring"))])
        array = _Array(streams, np.concatenate((host, np.asarray(number).astype(np.int64))), repeat)
        wanted = np.full(len(array.held), -1)
        asked = array.page >= n
        wanted[array.run[asked]] = array.page[asked] - n
        which = np.where(asked, -1, wanted[array.run])
        found = np.flatnonzero(which >= 0)
        rows = table.select(["host", "page"]).take(pa.array(array.page[found]))
        substrings = candidates.column("id").take(pa.array(which[found]))
        at = pa.array(array.at[found].astype(np.int32))
        met = pa.table({"host": rows.column("host"), "pages": pa.nulls(len(found), pa.int64()), "substring": substrings, "page": rows.column("page"), "at": at})
        return pa.concat_tables([counts.cast(met.schema), met])

    return run


def dealt(source: DataFrame, size: int = SHARD) -> DataFrame:
    """Pages (host, html) with ``shard`` and ``blocks``: hosts of up to ``size`` characters share shards of about as many, larger hosts have blocks. Copies count once."""
    seen = F.approx_count_distinct(F.xxhash64("html")) / F.count("*")
    hosts = cut(source.groupBy("host").agg(F.ceil(F.sum(F.length("html")) * F.least(seen, F.lit(1.0))).alias("chars")))
    rest = hosts.where(F.col("chars") <= size).agg(F.sum("chars")).first()[0] or 0
    large = hosts.where(F.col("chars") > size).select("host", F.ceil(F.col("chars") / size).cast("int").alias("blocks"))
    shards = F.lit(-(-int(rest) // size) or 1).cast("long")
    shard = F.when(F.col("blocks").isNull(), F.pmod(F.xxhash64("host"), shards)).otherwise(F.xxhash64("host"))
    return source.join(cut(large), "host", "left").select("host", shard.alias("shard"), F.coalesce("blocks", F.lit(1)).alias("blocks"), "html")


def boilerplate(streams: DataFrame, repeat: int = REPEAT, pages: int = PAGES, share: float = SHARE) -> DataFrame:
    """(page, starts): sorted places of streams (host, shard, blocks, stream) where a substring starts that many pages of the host have.

    ``page`` is the hash of host and stream; equal streams of one host are one page. Substrings on fewer than ``pages`` pages, or than the
    ``share`` of the host's, are not boilerplate.
    """
    page = F.xxhash64("host", "stream")
    rows = streams.withColumn("page", page).withColumn("block", F.pmod("page", F.col("blocks")).cast("int"))
    keys = ["shard", "block"]
    candidates = rows.groupBy(*keys).applyInArrow(_repeated(repeat, pages, share), _REPEATED).dropDuplicates(["host", "substring"])
    candidates = candidates.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    candidates = candidates.select(*keys, "host", "substring", F.xxhash64("host", "substring").alias("id"))
    both = rows.groupBy(*keys).cogroup(candidates.groupBy(*keys))
    found = cut(both.applyInArrow(_met(repeat), _MET))
    hosts = found.where("pages IS NOT NULL").groupBy("host").agg(F.greatest(F.lit(float(pages)), F.sum("pages") * share).alias("least"))
    met = found.where("pages IS NULL")
    held = met.select("host", "substring", "page").distinct().groupBy("host", "substring").agg(F.count("*").alias("held"))
    shared = cut(held.join(hosts, "host").where(F.col("held") >= F.col("least")).select("host", "substring"))
    return met.join(shared, ["host", "substring"], "left_semi").groupBy("page").agg(F.array_sort(F.collect_set("at")).alias("starts"))


def main_text(pages: DataFrame, repeat: int = REPEAT, shard: int = SHARD) -> DataFrame:
    """One row per row of ``pages`` (page_id, url, html): page_id, url, text, n_chars (code points).

    Nulls: null html is an empty page; a null url has the empty host; null ids stay. Empty pages have empty text. Rows that repeat a page are
    answered each; equal streams on a host count once. Other columns are not read. An empty
    table gives no rows. Nothing of an article is dropped or capped but what is boilerplate as a whole element.
    """
    host = F.lower(F.regexp_extract(F.coalesce(F.col("url").cast("string"), F.lit("")), "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    source = pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"), host.alias("host"))
    streams = dealt(source.select("host", "html"), shard).mapInArrow(_streams, _STREAMS)
    starts = cut(boilerplate(streams, repeat))
    ids = [source.schema["page_id"], source.schema["url"]]
    parsed = source.mapInArrow(_parsed, StructType([*ids, *StructType.fromDDL(_PARSED).fields]))
    joined = parsed.withColumn("page", F.xxhash64("host", "stream")).join(starts, "page", "left").select("page_id", "url", "stream", "spans", "starts")
    texts = joined.mapInArrow(_chosen(repeat, OWN), StructType([*ids, *StructType.fromDDL("text string").fields]))
    return texts.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
