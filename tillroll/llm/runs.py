"""Periodic runs of words, with an enhanced suffix array (suffix array, its inverse and common-prefix lengths).

Texts are cut into words and coded by numbers that no two texts share, so that one array serves a piece of about a megabyte of texts
and no match leaves a text. The run of period q that ends before word e holds the square of words e - 2q to e, whose two
halves are followed by different words: the suffixes e - 2q and e - q share exactly q words and lie in different
children of an interval of that common-prefix length. So, for every interval of depth d, each suffix i outside the largest child
looks up whether the array place of i + d, or of i - d, lies in the interval, and whether the next words differ: a branching
square. Leaving the largest child out bounds the look-ups by n log n. Intervals and their children come from the
nearest smaller common-prefix lengths; no tree is built. Squares are rotated to the left while the word before equals the
last word; the stretch that they cover is the run. Of squares that end at the same word, those that are powers of a shorter
one lie in the run of that one and are left out.

Everything is numpy over the words of a piece, with memory in proportion to it; pieces are independent, so nothing is shuffled.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.groups import Batches
from tillroll.llm.words import pieces

LEAST = 6  # words of a run
EXPONENT = 4  # periods that a run holds at least
_BLOCK = 32
_AT_ONCE = 1 << 20


def suffix_array(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(suffixes in order, place of each), by doubling prefixes; only suffixes that are still tied are sorted again."""
    n = len(codes)
    order = np.argsort(codes, kind="stable")
    head = np.ones(n, dtype=bool)
    head[1:] = codes[order[1:]] != codes[order[:-1]]
    place = np.empty(n, dtype=np.int64)
    place[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    tied = np.flatnonzero(~(head & np.append(head[1:], True)))
    known = 1
    while len(tied):
        items = order[tied]
        ahead = items + known
        after = np.where(ahead < n, place[np.minimum(ahead, n - 1)] + 1, 0)
        key = place[items] * (n + 1) + after
        by = np.argsort(key)
        items, key = items[by], key[by]
        order[tied] = items
        head = np.ones(len(tied), dtype=bool)
        head[1:] = key[1:] != key[:-1]
        place[items] = tied[np.maximum.accumulate(np.where(head, np.arange(len(tied)), 0))]
        tied = tied[~(head & np.append(head[1:], True))]
        known *= 2
    return order, place


def _common(codes: np.ndarray, a: np.ndarray, b: np.ndarray, step: int = 1) -> np.ndarray:
    """Equal codes from ``a`` and from ``b`` on, forward or (``step`` -1) backward."""
    n = len(codes)
    out = np.zeros(len(a), dtype=np.int64)
    live, width = np.arange(len(a)), 2
    while len(live):
        still = []
        for lo in range(0, len(live), max(1, _AT_ONCE // width)):
            part = live[lo : lo + max(1, _AT_ONCE // width)]
            shift = out[part, None] * step + np.arange(width)[None, :] * step
            x, y = a[part, None] + shift, b[part, None] + shift
            same = (x >= 0) & (y >= 0) & (x < n) & (y < n)
            same &= codes[np.clip(x, 0, n - 1)] == codes[np.clip(y, 0, n - 1)]
            whole = same.all(axis=1)
            out[part] += np.where(whole, width, same.argmin(axis=1))
            still.append(part[whole])
        live, width = np.concatenate(still), min(width * 4, 1 << 16)
    return out


def common_prefixes(codes: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Words that each suffix shares with the one before it in ``order``; -1 at both ends.

    Only suffixes whose previous word differs from that of their neighbour are compared; each other one shares one word less than the
    suffix that starts a word earlier.
    """
    n = len(codes)
    before = np.full(n, -1, dtype=np.int64)
    before[order[1:]] = order[:-1]
    follows = np.zeros(n, dtype=bool)
    follows[1:] = (before[1:] > 0) & (codes[:-1] == codes[before[1:] - 1])
    at = np.flatnonzero(~follows)
    reach = np.zeros(n, dtype=np.int64)
    some = at[before[at] >= 0]
    reach[at] = at
    reach[some] += _common(codes, some, before[some])
    shared = np.maximum.accumulate(reach) - np.arange(n)
    out = np.full(n + 1, -1, dtype=np.int64)
    out[1:n] = shared[order[1:]]
    return out


def _last_not_larger(values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """For each place in ``wanted`` the last place before it whose value is not larger; values[0] is the smallest of all."""
    found, limit = wanted - 1, values[wanted]
    live = np.arange(len(wanted))
    for _ in range(_BLOCK):
        live = live[values[found[live]] > limit[live]]
        if not len(live):
            return found
        found[live] -= 1
    full = len(values) // _BLOCK
    minima = [values[: full * _BLOCK].reshape(full, _BLOCK).min(axis=1)]
    while len(minima[-1]) > 1:  # minima[k][b] is that of the 2**k blocks from b on
        last, half = minima[-1], 1 << (len(minima) - 1)
        if len(last) <= half:
            break
        minima.append(np.minimum(last[:-half], last[half:]))
    for edge in (True, False):  # to the edge of a block, over whole blocks, into the block that holds the place
        while True:
            live = live[values[found[live]] > limit[live]]
            move = live[found[live] % _BLOCK != _BLOCK - 1] if edge else live
            if not len(move):
                break
            found[move] -= 1
        if edge:
            block = found[live] // _BLOCK + 1
            for k in range(len(minima) - 1, -1, -1):
                fits = block >= 1 << k
                from_block = np.where(fits, block - (1 << k), 0)
                skip = fits & (minima[k][np.minimum(from_block, len(minima[k]) - 1)] > limit[live])
                block = np.where(skip, from_block, block)
            found[live] = block * _BLOCK - 1
    return found


def _squares(codes: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, half) of the branching squares in intervals of ``least`` suffixes or more."""
    n = len(codes)
    order, place = suffix_array(codes)
    shared = common_prefixes(codes, order)
    bounds = np.flatnonzero(shared >= 1)
    left = np.arange(n + 1)
    right = np.arange(n + 1)
    left[bounds] = _last_not_larger(shared, bounds)
    right[bounds] = n - _last_not_larger(shared[::-1], n - bounds)
    ends = []
    for nearest in (left, right):  # the first and the last boundary of each boundary's interval
        end = np.where(shared[nearest] == shared, nearest, np.arange(n + 1))
        while not np.array_equal(further := end[end], end):
            end = further
        ends.append(end)
    first, last = ends
    low, high = left[first], right[last] - 1  # array places of the interval
    bounds = bounds[high[bounds] - low[bounds] + 1 >= least]
    closing = bounds[last[bounds] == bounds]
    owner = np.concatenate((first[bounds], first[closing]))
    begin = np.concatenate((left[bounds], closing))
    sizes = np.concatenate((bounds, right[closing])) - begin
    largest = np.zeros(n + 1, dtype=np.int64)
    ranked = sizes * len(sizes) + np.arange(len(sizes))
    np.maximum.at(largest, owner, ranked)
    small = np.flatnonzero(largest[owner] != ranked)
    owner, begin, sizes = owner[small], begin[small], sizes[small]
    starts, halves = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    upto = np.concatenate(([0], np.cumsum(sizes)))
    lo = 0
    while lo < len(sizes):
        hi = max(lo + 1, int(np.searchsorted(upto, upto[lo] + _AT_ONCE, side="right")) - 1)
        which = np.repeat(np.arange(lo, hi), sizes[lo:hi])
        at = order[begin[which] + np.arange(len(which)) - (upto[which] - upto[lo])]
        own = owner[which]
        depth, low_at, high_at = shared[own], low[own], high[own]
        for start in (at, at - depth):
            other = at + depth if start is at else start
            inside = (other >= 0) & (other < n)
            spot = place[np.where(inside, other, 0)]
            inside &= (spot >= low_at) & (spot <= high_at)
            s, d = start[inside], depth[inside]
            after = s + 2 * d
            branching = (after >= n) | (codes[np.minimum(after, n - 1)] != codes[s + d])
            starts.append(s[branching])
            halves.append(d[branching])
        lo = hi
    return np.concatenate(starts), np.concatenate(halves)


def runs_of(codes: np.ndarray, least: int = LEAST, exponent: int = EXPONENT) -> np.ndarray:
    """Rows (start, length, period) of the runs in ``codes`` by start and period: maximal stretches of ``least`` codes and ``exponent``
    times their smallest period or more."""
    if len(codes) < 2:
        return np.zeros((0, 3), dtype=np.int64)
    start, half = _squares(codes, exponent)
    end = start + 2 * half
    pairs = np.unique(np.stack((end, half), axis=1), axis=0)
    end, half = pairs[:, 0], pairs[:, 1]
    found = [np.zeros((0, 3), dtype=np.int64)]
    while len(end):
        head = np.ones(len(end), dtype=bool)
        head[1:] = end[1:] != end[:-1]
        e, q = end[head], half[head]
        s = e - 2 * q
        s = s - _common(codes, s - 1, s + q - 1, -1)
        found.append(np.stack((s, e - s, q), axis=1))
        group = np.cumsum(head) - 1
        power = (half % q[group] == 0) & (end - 2 * half >= s[group])
        rest = ~head & ~power
        end, half = end[rest], half[rest]
    rows = np.concatenate(found)
    rows = rows[rows[:, 1] >= np.maximum(least, exponent * rows[:, 2])]
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def _runs(least: int, exponent: int):
    kind = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def run(batches: Batches) -> Batches:
        for batch in pieces(batches):
            words, codes, first = [], [], [0]
            for text in batch.column("text"):
                cut_up = (text.as_py() or "").encode().split()  # bytes split at exactly \x20 and \x09-\x0D
                known: dict[bytes, int] = {}
                numbers = np.fromiter((known.setdefault(w, len(known)) for w in cut_up), np.int64, len(cut_up))
                codes.append(numbers + first[-1])
                words.append(cut_up)
                first.append(first[-1] + len(cut_up))
            edges = np.array(first)
            rows = runs_of(np.concatenate(codes), least, exponent)
            home = np.searchsorted(edges, rows[:, 0], side="right") - 1
            offsets = np.searchsorted(home, np.arange(batch.num_rows + 1))
            covered = np.zeros(edges[-1] + 1, dtype=np.int64)
            np.add.at(covered, rows[:, 0] + rows[:, 2], 1)
            np.add.at(covered, rows[:, 0] + rows[:, 1], -1)
            kept = np.cumsum(covered) == 0
            texts = []
            for i, cut_up in enumerate(words):
                if offsets[i] < offsets[i + 1]:
                    cut_up = compress(cut_up, kept[edges[i] : edges[i + 1]].tolist())
                texts.append(b" ".join(cut_up))
            inner = [pa.array(rows[:, 0] - edges[home]), pa.array(rows[:, 1]), pa.array(rows[:, 2])]
            lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.StructArray.from_arrays(inner, fields=list(kind)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), lists, pa.array(texts, pa.binary()).cast(pa.string())], ["key", "runs", "collapsed"]
            )

    return run


def word_runs(
    docs: DataFrame, text: str = "text", key: str = "doc_id", least: int = LEAST, exponent: int = EXPONENT
) -> DataFrame:
    """One row per document: ``key``, ``runs`` (start, length and period in words, by start and period) and ``collapsed``, the words that no run
    holds after its first period, joined by a space.

    Nulls and empty texts have no words, no runs and an empty ``collapsed``; a null key stays. Repeated rows give a row each. Of runs that
    tie in start or period all are listed. Other columns are not read. An empty table gives no rows. A text is one task's work:
    its words are held some twenty times as 64-bit numbers.
    """
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    found = rows.mapInArrow(
        _runs(least, exponent), f"key {kind}, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    )
    return found.withColumnRenamed("key", key)


def with_repeats(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``docs`` (key, text) with a periodic tail in about one text of ten, by the crc32 of the key: of its n words those from a on repeat the
    p words at a. A null key or a text without words stays as it is."""
    number = F.crc32(F.col(key).cast("string").cast("binary"))
    chosen = docs.select(key, text, number.alias("h"))
    words = F.filter(F.split(F.col(text), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    cut_up = chosen.withColumn("w", F.when(F.col("h") % 10 == 0, words)).withColumn("n", F.coalesce(F.size("w"), F.lit(0)))
    placed = cut_up.withColumn("g", F.floor(F.col("h") / 10)).withColumn(
        "a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int")
    )
    placed = placed.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    times = F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")
    tail = F.flatten(F.array_repeat(F.slice("w", F.col("a") + 1, F.col("p")), times))
    whole = F.concat(F.slice("w", F.lit(1), F.col("a")), F.slice(tail, F.lit(1), F.col("n") - F.col("a")))
    return placed.select(key, F.when(F.col("n") > 0, F.array_join(whole, " ")).otherwise(F.col(text)).alias(text))


def digest(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Number of runs, the longest one (of equal ones the first, then the shortest period) and digests, of ``word_runs``' rows."""
    order = F.array_sort(F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"))))
    ranked = found.withColumn("best", F.when(F.size("runs") > 0, F.element_at(order, 1)))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise(F.lit(""))
    start, length, period = F.col("best.start"), -F.col("best.less"), F.col("best.period")
    return ranked.select(
        key,
        F.size("runs").cast("long").alias("n_runs"),
        start.alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(1000 * length / period).cast("long").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


# Runs by their definition: stretches of words that equal those q words on, found where triples of words are equal.
ORACLE = r"""
WITH keyed AS (SELECT doc_id, coalesce(text, '') AS text, encode(CAST(doc_id AS VARCHAR)) AS bytes, CAST(doc_id AS VARCHAR) AS id FROM documents),
    summed AS (SELECT doc_id, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w,
        xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(id) + 1), lambda i: ascii(id[i])::BIGINT)),
            lambda c, b: list_reduce(list_prepend(xor(c, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
                lambda x, z: xor(x >> 1, (x & 1) * 3988292384::BIGINT))), 4294967295::BIGINT) AS h FROM keyed),
    sized AS (SELECT doc_id, w, h, h // 10 AS g, len(w) AS n FROM summed),
    tailed AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN g % n END AS a FROM sized),
    texts AS (SELECT doc_id, n, CASE WHEN a IS NULL THEN w ELSE list_transform(range(0, n),
        lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END]) END AS w FROM tailed),
    words AS (SELECT doc_id, n, unnest(range(0, n)) AS pos, unnest(w) AS word FROM texts),
    threes AS (SELECT doc_id, n, pos, word || ' ' || lead(word) OVER o || ' ' || lead(word, 2) OVER o AS three FROM words WINDOW o AS (PARTITION BY doc_id ORDER BY pos)),
    pairs AS (SELECT x.doc_id, x.pos, y.pos - x.pos AS q FROM threes AS x JOIN threes AS y
        ON x.doc_id = y.doc_id AND x.three = y.three AND y.pos > x.pos AND 4 * (y.pos - x.pos) <= x.n),
    islands AS (SELECT doc_id, q, pos, pos - row_number() OVER (PARTITION BY doc_id, q ORDER BY pos) AS island FROM pairs),
    stretches AS (SELECT doc_id, min(pos) AS start, count(*) + 2 + q AS length, q FROM islands GROUP BY doc_id, q, island HAVING count(*) + 2 + q >= greatest(6, 4 * q)),
    runs AS (SELECT doc_id, start, length, min(q) AS period FROM stretches GROUP BY ALL),
    facts AS (SELECT doc_id, count(*) AS n_runs, first(start ORDER BY length DESC, start, period) AS start, max(length) AS length,
        first(period ORDER BY length DESC, start, period) AS period,
        string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS listed FROM runs GROUP BY doc_id),
    dropped AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS pos FROM runs),
    collapsed AS (SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS text FROM words ANTI JOIN dropped USING (doc_id, pos) GROUP BY doc_id)
SELECT t.doc_id, coalesce(f.n_runs, 0) AS n_runs, CAST(f.start AS BIGINT) AS start, f.length, CAST(f.period AS BIGINT) AS period,
    CAST(1000 * f.length // f.period AS BIGINT) AS exponent_milli, sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(c.text, '')) AS collapsed_sha256
FROM texts AS t LEFT JOIN facts AS f ON f.doc_id = t.doc_id LEFT JOIN collapsed AS c ON c.doc_id = t.doc_id
"""
