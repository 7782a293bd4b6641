"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1, drawn from its code point. A trigram binds its letters by multiplying their vectors after
rotating the first by two places and the second by one, so that order counts. A document bundles the vectors of its
trigrams by adding them, a language prototype those of its training documents, each document with the same weight. A document
gets the language whose prototype has the largest cosine with it.

Trigrams have a letter in the middle; their ends may be the gap between words. Counts of a batch times the vectors of its
distinct trigrams are one matrix product.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from tillroll.llm.groups import Batches
from tillroll.llm.toxicity import held_out
from tillroll.llm.words import mixed, pieces

DIMENSIONS = 1024
UNKNOWN = "und"
_ROWS = 512  # documents whose counts are held as one matrix


def letter_vectors(points: np.ndarray) -> np.ndarray:
    """Random signs for code points; the gap between words is code point 0."""
    blocks = np.arange(DIMENSIONS // 64, dtype=np.uint64)
    words = mixed(points.astype(np.uint64)[:, None] * np.uint64(1 << 20) + blocks[None, :] + np.uint64(1))
    return np.unpackbits(mixed(words).view(np.uint8), axis=1).astype(np.int8) * 2 - 1


class Trigrams:
    """Distinct trigrams of a few texts and where they occur."""

    def __init__(self, texts: list[str | None]):
        lowered = [(t or "").lower() for t in texts]
        chars = np.frombuffer(("\n" + "\n".join(lowered) + "\n").encode("utf-32-le"), np.uint32)
        ends = np.cumsum([len(t) + 1 for t in lowered])
        present = np.flatnonzero(np.bincount(chars))
        letters = np.array([p for p in present.tolist() if chr(p).isalpha()], dtype=np.int64)
        index = np.zeros(int(present[-1]) + 1, dtype=np.int64)
        index[letters] = np.arange(1, len(letters) + 1)
        at = index[chars]
        middle = np.flatnonzero(at[1:-1]) + 1
        base = len(letters) + 1
        code = (at[middle - 1] * base + at[middle]) * base + at[middle + 1]
        self.doc = np.searchsorted(ends, middle - 1, side="right")
        self.size = np.bincount(self.doc, minlength=len(texts))
        if base**3 <= 1 << 23:
            used = np.flatnonzero(np.bincount(code, minlength=base**3))
            place = np.zeros(base**3, dtype=np.int64)
            place[used] = np.arange(len(used))
            self.at = place[code]
        else:
            used, self.at = np.unique(code, return_inverse=True)
        self.parts = (used // base**2, used // base % base, used % base)
        self.letters = np.concatenate(([0], letters))

    def vectors(self, rows: np.ndarray, n: int, weights: np.ndarray | None = None) -> np.ndarray:
        """Sums of the trigram vectors by ``rows`` (a number below n for each occurrence, or -1)."""
        out = np.zeros((n, DIMENSIONS), dtype=np.float32)
        single = letter_vectors(self.letters)
        first, second = np.roll(single, 2, axis=1), np.roll(single, 1, axis=1)
        kept = rows >= 0
        at, rows = self.at[kept], rows[kept]
        weights = None if weights is None else weights[kept]
        a, b, c = self.parts
        for lo in range(0, len(a), 4096):
            hi = min(lo + 4096, len(a))
            inside = (at >= lo) & (at < hi)
            flat = rows[inside] * (hi - lo) + at[inside] - lo
            counts = np.bincount(flat, None if weights is None else weights[inside], n * (hi - lo))
            bound = first[a[lo:hi]] * second[b[lo:hi]] * single[c[lo:hi]]
            out += counts.reshape(n, hi - lo).astype(np.float32) @ bound.astype(np.float32)
        return out


def prototypes(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages and their vectors, from all rows (text, lang) that have a language. Each partition adds up its own rows."""

    def run(batches: Batches) -> Batches:
        sums: dict[str, np.ndarray] = {}
        for piece in pieces(batches):
            for lo in range(0, piece.num_rows, _ROWS):
                batch = piece.slice(lo, _ROWS)
                grams = Trigrams(batch.column("text").to_pylist())
                langs = batch.column("lang").to_pylist()
                names = sorted(set(langs))
                number = np.array([names.index(x) for x in langs])
                found = grams.vectors(number[grams.doc], len(names), 1 / grams.size[grams.doc])
                for name, vector in zip(names, found, strict=True):
                    sums[name] = sums.get(name, 0) + vector.astype(np.float64)
        for name, vector in sums.items():
            yield pa.RecordBatch.from_pydict({"lang": [name], "vector": [vector.tolist()]})

    parts = docs.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    parts = parts.where("text IS NOT NULL AND lang IS NOT NULL").mapInArrow(run, "lang string, vector array<double>")
    # Rounded, so that the order in which parts are added does not show.
    total = parts.select("lang", F.posexplode("vector")).groupBy("lang", "pos").agg(F.sum(F.round("col", 6).cast("decimal(30,6)")).alias("v"))
    rows = total.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("pos", F.col("v").cast("double")))).alias("v"))
    found = sorted((r.lang, [x[1] for x in r.v]) for r in rows.collect())
    return [f[0] for f in found], np.array([f[1] for f in found]).reshape(len(found), DIMENSIONS)


def identify(docs: DataFrame, languages: list[str], vectors: np.ndarray) -> DataFrame:
    """(doc_id, lang_pred, score) of every row over its whole text; the score is the cosine, at least 0."""
    sizes = np.linalg.norm(vectors, axis=1, keepdims=True)
    shared = docs.sparkSession.sparkContext.broadcast((vectors / np.maximum(sizes, 1e-12)).astype(np.float32))

    def run(batches: Batches) -> Batches:
        known = shared.value
        for piece in pieces(batches):
            for lo in range(0, piece.num_rows, _ROWS):
                batch = piece.slice(lo, _ROWS)
                names, scores = [UNKNOWN] * batch.num_rows, np.zeros(batch.num_rows)
                grams = Trigrams(batch.column("text").to_pylist())
                if len(known) and len(grams.at):
                    found = grams.vectors(grams.doc, batch.num_rows)
                    cosines = found @ known.T / np.maximum(np.linalg.norm(found, axis=1, keepdims=True), 1e-12)
                    best = cosines.argmax(axis=1)
                    has = grams.size > 0
                    names = [languages[b] if h else UNKNOWN for b, h in zip(best, has, strict=True)]
                    scores = np.where(has, np.clip(cosines.max(axis=1), 0, 1), 0).astype(np.float64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(names), pa.array(scores)], ["doc_id", "lang_pred", "score"]
                )

    source = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    schema = StructType(
        [source.schema["doc_id"], StructField("lang_pred", StringType()), StructField("score", DoubleType())]
    )
    return source.mapInArrow(run, schema)


def language(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score (0 to 1).

    Nulls: a null text, or one without a letter, is ``und`` with score 0; rows without a language teach nothing; a null id
    is predicted and not held out. Ties go to the first language by name. Repeated rows get equal results. Columns but doc_id, text and
    lang are not read. If no row teaches, all are ``und``. An empty table gives no rows.
    """
    found = identify(docs, *prototypes(docs.where(~held_out())))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
