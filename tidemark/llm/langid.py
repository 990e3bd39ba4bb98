"""Language identification: multinomial naive Bayes over hashed character n-grams.

A text is lower-cased and read as code points with a pair of zeros on either side; its
1-, 2- and 3-grams are hashed to ``2 ** BITS`` buckets. Training counts (language, bucket)
inside the tasks, adds the counts up in Spark, and turns them into one matrix of smoothed
log-probabilities, ``2 ** BITS`` by the number of languages, which is broadcast: its size
depends on those two numbers alone, never on the texts. Scoring is sparse: the distinct
buckets of each text, with their counts, times the rows of the matrix.

Null texts and texts without a letter are ``und`` with score 0, as is every text if there
is nothing to learn from. Null labels and null texts teach nothing. Ties go to the
language that sorts first. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import chunks, table

BITS = 15
ORDERS = (1, 2, 3)
SMOOTHING = 0.5
UNDETERMINED = "und"
# Text taken at a time, and places of it whose n-grams are held at a time; a longer text is
# scored in parts, whose counts add up.
TEXT_BYTES, PLACES = 512 << 10, 1 << 16
# Odd multipliers of the n-gram hash, one per place (any odd numbers do).
_MIX = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def ngrams(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text, bucket) of all n-grams, ``PLACES`` places at a time, however long the texts
    are. Two zeros between texts keep a 3-gram from reaching over both."""
    pad = "\0\0"
    line = np.frombuffer("".join([pad + t.lower() for t in texts] + [pad]).encode(
        "utf-32-le", "surrogatepass"), "<u4")
    starts = np.cumsum([0] + [len(t.lower()) + 2 for t in texts])
    for a in range(0, len(line) - 2, PLACES):
        n = min(PLACES, len(line) - 2 - a)
        text = np.searchsorted(starts, np.arange(a, a + n), "right") - 1
        mixed = np.zeros(n, np.uint32)
        out = np.empty((len(ORDERS), n), np.int64)
        for i, mix in enumerate(_MIX):
            at = a + i
            mixed = (mixed ^ (mixed >> 15)) + (line[at:at + n] + np.uint32(i + 1)) * np.uint32(mix)
            out[i] = (mixed * np.uint32(_MIX[0])) >> np.uint32(32 - BITS)
        yield text, out


@dataclass(frozen=True)
class Model:
    """Log-probability of a bucket in each language, and of each language."""

    languages: tuple[str, ...]
    buckets: np.ndarray  # [2 ** BITS, languages], float32
    prior: np.ndarray

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        known = [t for t in texts if has_letter(t)]
        if not known or not self.languages:
            return [UNDETERMINED] * len(texts), [0.0] * len(texts)
        total = np.zeros((len(known), len(self.languages))) + self.prior
        for text, grams in ngrams(known):
            keys = (grams | text << BITS).ravel()
            keys.sort()
            first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
            times = np.diff(np.append(first, len(keys)))
            text, bucket = keys[first] >> BITS, keys[first] & (1 << BITS) - 1
            logs = self.buckets[bucket] * times[:, None]  # float64
            some = np.flatnonzero(np.append(True, text[1:] != text[:-1]))
            total[text[some]] += np.add.reduceat(logs, some, axis=0)
        total -= total.max(axis=1, keepdims=True)
        share = np.exp(total)
        best, top = share.argmax(axis=1), 1 / share.sum(axis=1)
        found = iter(zip(best.tolist(), top.tolist()))
        rows = [next(found) if has_letter(t) else None for t in texts]
        return ([UNDETERMINED if r is None else self.languages[r[0]] for r in rows],
                [0.0 if r is None else r[1] for r in rows])


def train(df: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """Learns from all rows of ``df`` with a text and a label."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        texts_of: dict[str, int] = {}
        for batch in chunks(batches, "text", TEXT_BYTES):
            by: dict[str, list[str]] = {}
            for t, l in zip(*(c.to_pylist() for c in batch.columns)):
                by.setdefault(l, []).append(t)
            for l, texts in by.items():
                own = totals.setdefault(l, np.zeros(1 << BITS, np.int64))
                for _, grams in ngrams(texts):
                    own += np.bincount(grams.ravel(), minlength=1 << BITS)
                texts_of[l] = texts_of.get(l, 0) + len(texts)
        for l, found in totals.items():
            at = np.flatnonzero(found)
            # bucket -1 carries the number of texts
            yield pa.RecordBatch.from_arrays(
                [pa.array([l] * (len(at) + 1)), pa.array(np.append(at, -1), pa.int32()),
                 pa.array(np.append(found[at], texts_of[l]), pa.int64())],
                ["lang", "bucket", "n"])

    rows = (df.select(F.col(text).alias("text"), F.col(lang).alias("lang"))
            .filter(F.col("text").isNotNull() & F.col("lang").isNotNull())
            .mapInArrow(count, "lang string, bucket int, n long")
            .groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
            .toArrow())  # at most (2 ** BITS + 1) rows per language
    names = rows.column("lang").to_numpy(zero_copy_only=False)
    languages = tuple(sorted(set(names)))
    column = np.searchsorted(np.array(languages, dtype=object), names) if languages else names
    bucket, n = rows.column("bucket").to_numpy(), rows.column("n").to_numpy()
    counts = np.zeros((1 << BITS, len(languages)))
    texts_in = np.zeros(len(languages))
    own = bucket >= 0
    counts[bucket[own], column[own].astype(int)] = n[own]
    texts_in[column[~own].astype(int)] = n[~own]
    logs = np.log(counts + SMOOTHING) - np.log(counts.sum(axis=0) + SMOOTHING * (1 << BITS))
    prior = np.log(texts_in / max(texts_in.sum(), 1)) if languages else texts_in
    return Model(languages, logs.astype(np.float32), prior)


def predict(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``df`` with lang_pred and score in front of its own columns."""
    own = df.sparkSession.sparkContext.broadcast(model)
    clash = [c for c in ("lang_pred", "score") if c in df.columns]
    source = df.drop(*clash)
    at = source.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, text, TEXT_BYTES):
            pred, score = own.value.predict(batch.column(at).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [pa.array(pred, pa.string()), pa.array(score, pa.float64()), *batch.columns],
                ["lang_pred", "score", *batch.schema.names])

    schema = "lang_pred string, score double, " + ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema)
    return source.mapInArrow(run, schema)


def held_out(doc_id: Column) -> Column:
    """A quarter of the documents, by the checksum of doc_id as text (null: not held out)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every document, learnt from those that
    are not held out."""
    taught = docs.filter(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull())
    model = train(taught)
    found = predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"),
                        "lang_pred", "score")


def keep_known(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """``docs`` without the rows whose language cannot be told: ``und``, or no language with
    a probability of ``least``. Learnt from the rows that are not held out."""
    taught = docs.filter(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull())
    own = docs.sparkSession.sparkContext.broadcast(train(taught))
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text", TEXT_BYTES):
            pred, score = own.value.predict(batch.column(at).to_pylist())
            yield batch.filter(pa.array([p != UNDETERMINED and s >= least
                                         for p, s in zip(pred, score)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every whole text."""
    return identify(table(spark, sf_dir, "documents"))
