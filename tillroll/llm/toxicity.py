"""Toxicity by a factorization machine over hashed terms.

The terms of a document are its distinct words and the beginnings of those words, each hashed to a bucket; beginnings let a word
count that is written in many forms. The machine scores a bias, a weight per bucket and, through a short vector per bucket, every
pair of terms, so that an insult can weigh more beside the mention of a group than either does alone. It is trained on a bounded
sample of labelled documents, over every bucket that two of them have: the executors cut and hash the texts, the
driver descends over the sparse rows. An absolute penalty first takes weights and vectors that do not help to zero, alone or
in pairs, without a look at how a term is distributed by itself; what is left is then fitted without it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from tillroll.llm.groups import Batches
from tillroll.llm.words import SYMBOLS, Words, mixed, pieces

FIT_ROWS = 16_000  # labelled documents in the sample, at most about
BUCKETS = 1 << 20
MOST = 255  # occurrences of a term that count, in training and in scoring
VALUES = 1 + np.log(np.maximum(1, np.arange(MOST + 1))).astype(np.float32)  # of a term that occurs so often
LEAST_DOCUMENTS = 2  # of the sample that have a bucket of the machine
BEGINNINGS = (4, 5, 6, 7, 8)  # bytes
FACTORS = 4
PENALTIES = (0.1, 0.15)  # on weights and factors while terms are chosen, over the root of the documents in a step
REJECT = 0.3


@dataclass
class Terms:
    """Slots and counts of the terms of some documents; document ``i`` has those from ``first[i]`` to ``first[i + 1]``."""

    first: np.ndarray
    slot: np.ndarray
    count: np.ndarray

    @property
    def value(self) -> np.ndarray:
        return VALUES[self.count]

    def of(self, docs: np.ndarray) -> Terms:
        sizes = self.first[docs + 1] - self.first[docs]
        first = np.concatenate(([0], np.cumsum(sizes)))
        at = np.repeat(self.first[docs] - first[:-1], sizes) + np.arange(first[-1])
        return Terms(first, self.slot[at], self.count[at])

    def restrict(self, keep: np.ndarray) -> None:
        """Drop the terms of other slots, in place as they may be many; the slots that are kept are numbered anew."""
        mine = keep[self.slot]
        self.first = np.concatenate(([0], np.cumsum(self.sums(mine, np.int64))))
        self.count = self.count[mine]
        self.slot = self.slot[mine]
        np.take((np.cumsum(keep) - 1).astype(np.int32), self.slot, out=self.slot, mode="clip")

    def sums(self, values: np.ndarray, dtype: type | None = None) -> np.ndarray:
        """Sums of one value per term, by document."""
        out = np.zeros(len(self.first) - 1, dtype=dtype or values.dtype)
        some = np.flatnonzero(np.diff(self.first))
        if len(some):
            out[some] = np.add.reduceat(values, self.first[some], dtype=out.dtype)
        return out


@dataclass
class Machine:
    """``slot`` gives a bucket's row in the weights, or -1."""

    slot: np.ndarray
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def margins(self, terms: Terms) -> tuple[np.ndarray, np.ndarray]:
        """Scores before the logistic function, and the sums of the factors of every document."""
        value = terms.value
        margins = self.bias + terms.sums(self.weights[terms.slot] * value)
        sums = np.zeros((len(margins), self.factors.shape[1]), dtype=self.factors.dtype)
        for f in range(sums.shape[1]):  # one factor at a time, as the terms of a step may be a million
            part = self.factors[:, f][terms.slot] * value
            sums[:, f] = terms.sums(part)
            margins = margins + 0.5 * (sums[:, f] ** 2 - terms.sums(part * part))
        return margins, sums

    def scores(self, terms: Terms) -> np.ndarray:
        return _logistic(self.margins(terms)[0].astype(np.float64))

    def terms(self, texts: pa.Array) -> Terms:
        docs, words, buckets = term_buckets(Words(texts, SYMBOLS))
        kept = self.slot[buckets] >= 0
        docs, buckets, counts = _counted(docs[kept], words[kept], buckets[kept])
        return Terms(np.searchsorted(docs, np.arange(len(texts) + 1)), self.slot[buckets], counts)


def _logistic(margins: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(margins, -30, 30)))


def term_buckets(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, word, bucket) of every term of every word in a piece."""
    docs = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))
    whole = words.hashes()
    at, out = [np.arange(len(words))], [whole]
    for size in BEGINNINGS:
        longer = np.flatnonzero(words.end - words.start > size)
        ends = np.minimum(words.start + size, words.end)
        at.append(longer)
        out.append(mixed(words.hashes(ends)[longer] + np.uint64(size)))
    at = np.concatenate(at)
    bucket = (np.concatenate(out) & np.uint64(BUCKETS - 1)).astype(np.int64)
    return docs[at], whole[at], bucket


def _counted(docs: np.ndarray, words: np.ndarray, buckets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, bucket, distinct words of the document in it, ``MOST`` at most), by document and bucket."""
    order = np.lexsort((words, buckets, docs))
    d, w, b = docs[order], words[order], buckets[order]
    first = np.ones(len(d), dtype=bool)
    first[1:] = (d[1:] != d[:-1]) | (b[1:] != b[:-1])
    new = first.copy()
    new[1:] |= w[1:] != w[:-1]
    counts = np.add.reduceat(new.astype(np.int64), np.flatnonzero(first)) if len(d) else np.zeros(0, np.int64)
    return d[first], b[first], np.minimum(counts, MOST)


def held_out(key: str = "doc_id") -> Column:
    """Rows that training never sees: crc32 of the id as text, modulo 4, is 2. False without an id."""
    return F.coalesce(F.pmod(F.crc32(F.col(key).cast("string")), F.lit(4)) == 2, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """(text, toxic) of about ``fit_rows`` labelled documents outside the held-out part, chosen by a hash of the id."""
    marks = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(~held_out())
    marks = marks.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    share = min(1.0, fit_rows / max(1, marks.count()))
    chosen = F.pmod(F.xxhash64(F.lit(11), "doc_id"), F.lit(1_000_000)) < int(share * 1_000_000)
    texts = docs.where("doc_id IS NOT NULL").select("doc_id", "text").where(chosen)
    return texts.join(marks.where(chosen), "doc_id").select("text", "toxic")


def _sparse_rows(batches: Batches) -> Batches:
    """The terms of every document, packed as bucket * 256 + count."""
    for batch in pieces(batches):
        docs, buckets, counts = _counted(*term_buckets(Words(batch.column("text"), SYMBOLS)))
        first = np.searchsorted(docs, np.arange(batch.num_rows + 1)).astype(np.int32)
        terms = pa.ListArray.from_arrays(pa.array(first), pa.array((buckets * 256 + counts).astype(np.int32)))
        yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("toxic"), terms], ["key", "toxic", "terms"])


def fit(sample: DataFrame, factors: int = FACTORS, steps: tuple[int, int] = (150, 300), seed: int = 5) -> Machine:
    """Train on (text, toxic) rows, of which there is a bounded number, 4 MB each at most. Without both labels the score is a constant.

    ``steps`` are those that choose terms, with ``PENALTIES``, and those that fit the chosen ones.
    """
    keyed = sample.select(F.xxhash64("text").alias("key"), "toxic", "text")
    rows = keyed.mapInArrow(_sparse_rows, "key long, toxic int, terms array<int>").toArrow()
    y, keys = rows["toxic"].to_numpy().astype(np.float32), rows["key"].to_numpy()
    bias = float(np.log((y.sum() + 0.5) / ((1 - y).sum() + 0.5)))
    slot = np.full(BUCKETS, -1, dtype=np.int32)
    if len(np.unique(y)) < 2:
        return Machine(slot, bias, np.zeros(0), np.zeros((0, factors)))
    # Rows come in no certain order; batches are drawn from this one.
    order = np.lexsort((y, keys))
    terms = _of_column(rows["terms"])
    del rows
    seen = np.zeros(BUCKETS, dtype=np.int64)
    for at in range(0, len(terms.slot), BUCKETS):
        seen += np.bincount(terms.slot[at : at + BUCKETS], minlength=BUCKETS)
    known = seen >= LEAST_DOCUMENTS
    terms.restrict(known)
    rng = np.random.default_rng(seed)
    machine = Machine(
        slot, bias, np.zeros(known.sum(), np.float32), rng.normal(0, 0.05, (known.sum(), factors)).astype(np.float32)
    )
    chosen = _descend(machine, terms, y, order, steps[0], 1024, 0.02, PENALTIES, rng)
    buckets = np.flatnonzero(known)[chosen]
    _descend(machine, terms, y, order, steps[1], 256, 0.01, (0.0, 0.0), rng)
    slot[buckets] = np.arange(len(buckets))
    return machine


def _of_column(column: pa.ChunkedArray) -> Terms:
    """Packed rows as terms whose slots are buckets, chunk by chunk as they are large."""
    slots, counts, sizes = [], [], []
    for chunk in column.chunks:
        packed = chunk.flatten().to_numpy(zero_copy_only=False)
        slots.append(packed >> 8)
        counts.append((packed & 255).astype(np.uint8))
        sizes.append(np.diff(chunk.offsets.to_numpy()))
    first = np.concatenate(([0], np.cumsum(np.concatenate(sizes), dtype=np.int64)))
    return Terms(first, np.concatenate(slots), np.concatenate(counts))


def _descend(
    machine: Machine, terms: Terms, y: np.ndarray, order: np.ndarray, steps: int, size: int, rate: float,
    penalties: tuple[float, float], rng: np.random.Generator,
) -> np.ndarray:
    """Adam on the logistic loss in batches of about ``size`` documents, changing ``machine``.

    With absolute penalties slots whose weight and factors are all zero leave machine and ``terms``, every 25 steps from the
    fiftieth and at the end. Returns the slots that are left.
    """
    live = np.arange(len(machine.weights))
    values = [np.array([machine.bias], np.float32), machine.weights, machine.factors]
    mean, square = ([np.zeros_like(v) for v in values] for _ in range(2))
    batches = max(1, len(y) // size)
    shrink = [0.0, *(p / np.sqrt(min(len(y), size)) for p in penalties)]
    queue: list[np.ndarray] = []
    for step in range(1, steps + 1):
        queue = queue or np.array_split(order[rng.permutation(len(order))], batches)
        at = queue.pop()
        some = terms.of(at)
        margins, sums = Machine(machine.slot, values[0][0], *values[1:]).margins(some)
        error = ((_logistic(margins) - y[at]) / len(at)).astype(np.float32)
        value = some.value
        pull = np.repeat(error, np.diff(some.first)) * value
        gradients = [np.array([error.sum()]), 1e-4 * values[1], 1e-4 * values[2]]
        gradients[1] += np.bincount(some.slot, pull, len(live))
        for f, own in enumerate(values[2].T):
            others = np.repeat(sums[:, f], np.diff(some.first)) - value * own[some.slot]
            gradients[2][:, f] += np.bincount(some.slot, pull * others, len(live))
        for i, g in enumerate(gradients):
            mean[i] = 0.9 * mean[i] + 0.1 * g
            square[i] = 0.999 * square[i] + 0.001 * g * g
            speed = rate / (np.sqrt(square[i] / (1 - 0.999**step)) + 1e-5)
            moved = values[i] - speed * mean[i] / (1 - 0.9**step)
            values[i] = np.sign(moved) * np.maximum(0, np.abs(moved) - shrink[i] * speed)
        if any(penalties) and (step == steps or (step >= 50 and step % 25 == 0)):
            keep = (values[1] != 0) | (values[2] != 0).any(1)
            terms.restrict(keep)
            live = live[keep]
            for arrays in (values, mean, square):
                arrays[1], arrays[2] = arrays[1][keep], arrays[2][keep]
    machine.bias, machine.weights, machine.factors = float(values[0][0]), values[1], values[2]
    return live


def score(docs: DataFrame, machine: Machine) -> DataFrame:
    """(doc_id, score, predicted) of every row, over its whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    def run(batches: Batches) -> Batches:
        fm = shared.value
        for batch in pieces(batches):
            value = fm.scores(fm.terms(batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(value), pa.array((value >= REJECT).astype(np.int32))],
                ["doc_id", "score", "predicted"],
            )

    source = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    schema = StructType(
        [source.schema["doc_id"], StructField("score", DoubleType()), StructField("predicted", IntegerType())]
    )
    return source.mapInArrow(run, schema)


def toxicity(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score (0 to 1), predicted (score of 0.3 or more).

    Nulls: a null text counts as empty and scores the bias alone; a null id is scored and not held out; labels without an id or a mark
    are passed over, of several marks of an id the largest counts. Repeated rows score alike. Only doc_id and
    text of ``docs`` are read. Without labels of both kinds every score is the share of toxic labels.
    """
    machine = fit(training_sample(docs, labels, fit_rows))
    scored = score(docs, machine)
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")


def accepted(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """The rows of ``docs`` that score below the limit, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(training_sample(docs, labels, fit_rows)))

    def run(batches: Batches) -> Batches:
        fm = shared.value
        for batch in pieces(batches):
            yield batch.filter(pa.array(fm.scores(fm.terms(batch.column("text"))) < REJECT))

    return docs.mapInArrow(run, docs.schema)
