"""Alignment of two tokenizers over a corpus by inverted pair bitmaps.

A text with a space in front is tokenized by A (byte-level BPE) and by B (pieces with byte
fallback). Byte offsets where tokens of both end cut the text into groups; a link is a pair
of token occurrences, one of each, whose bytes overlap. A text has no tokens if it is null
or empty, or if the joined bytes of A's or of B's tokens are not its own.

Between two characters that are not white space, a cut in front of a single space divides
no match of A's pattern and, as the mark for a space stands only at the front of B's pieces,
no piece of B: a token of both ends there. So each stretch " word" is aligned once while it
recurs, and a text's groups and links are those of its stretches one after the other.

Documents are numbered by chunk and position. A task goes through its documents and, for
every pair of token ids and chunk, writes multiplicity planes: plane k is the compressed
bitmap of the documents in which the pair's number of links has bit k. It writes whenever it
holds ``LINKS`` links, so a pair and chunk may have several parts. ``index`` OR-merges them
plane by plane; the OR of the planes, popcounted, is the pair's number of documents in the
chunk, and the popcounts of plane k times 2 ** k add up to its links. ``pairs`` adds both up
over chunks. ``scores`` joins a pair's corpus-wide counts to its postings and sums them per
document, chunk by chunk, in arrays of 65,536 documents.

A hot pair has one row per chunk, each of a few 8 KiB bitmaps, which sort by pair and chunk; no
task needs all of them. Repeated rows are documents of their own. Other columns are not read.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import os
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bitmaps
from tidemark.llm.bpe import Codec
from tidemark.llm.common import chunks, stored, table

A_VOCABULARY, B_VOCABULARY = "byte_bpe_50k.json", "piece_bpe_32k.model"
SPACE = "▁"
LINKS = 8 << 20  # links that a task holds before it writes their bitmaps
CHUNK_LINKS = 1 << 27  # a chunk ends with the document that reaches this
# Stretches kept per Python worker, about 400 bytes each; when there are more of them or
# more characters in them, the store starts anew.
STRETCHES, STRETCH_CHARS = 600_000, 12_000_000
_ID = np.uint64(24)  # bits of a token id in a link: a << 24 | b
_POSITION = np.uint64(16)


class Stretch:
    """What the alignment of a stretch yields; ``links`` are little-endian 64-bit."""

    __slots__ = ("n_a", "n_b", "groups", "links")

    def __init__(self, n_a: int, n_b: int, groups: str, links: bytes):
        self.n_a, self.n_b, self.groups, self.links = n_a, n_b, groups, links


def align(a: list[int], b: list[int], a_size: list[int], b_size: list[int]) -> Stretch:
    """Groups and links of two token rows over the same bytes; sizes are bytes per id."""
    i = j = group_a = group_b = 0
    end_a, end_b = a_size[a[0]], b_size[b[0]]
    groups, links = [], []
    while True:
        links.append(a[i] << int(_ID) | b[j])
        moves_a, moves_b = end_a <= end_b, end_b <= end_a
        i, j = i + moves_a, j + moves_b
        if moves_a and moves_b:
            groups.append(f"{','.join(map(str, a[group_a:i]))}|{','.join(map(str, b[group_b:j]))}")
            group_a, group_b = i, j
            if i == len(a):
                break
        if moves_a:
            end_a += a_size[a[i]]
        if moves_b:
            end_b += b_size[b[j]]
    return Stretch(len(a), len(b), ";".join(groups), np.array(links, "<u8").tobytes())


class Aligner:
    """Two vocabularies and the stretches aligned so far."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has one task per core
        import sentencepiece
        from tokenizers import Tokenizer

        self.a, self.codec = Tokenizer.from_file(a_path), Codec(a_path)
        self.a.encode_special_tokens = True  # their strings are ordinary text
        self.a_bytes = [self.codec.decode(np.array([i])) for i in range(len(self.codec.lengths))]
        self.a_size = list(map(len, self.a_bytes))
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i)
                        else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)]
        self.b_size = list(map(len, self.b_bytes))
        self.divides = not any(SPACE in p.lstrip(SPACE) for p in pieces)
        self.known: dict[str, Stretch | None] = {}
        self.chars = 0

    def _learn(self, stretches: list[str]) -> None:
        of_a = self.a.encode_batch_fast([" " + s for s in stretches], add_special_tokens=False)
        of_b = self.b.encode(stretches, num_threads=1)
        for stretch, a, b in zip(stretches, of_a, of_b):
            a, own = a.ids, (" " + stretch).encode()
            whole = (b"".join([self.a_bytes[i] for i in a]) == own
                     and b"".join([self.b_bytes[i] for i in b]) == own)
            self.known[stretch] = align(a, b, self.a_size, self.b_size) if whole else None
        self.chars += sum(map(len, stretches))

    def aligned(self, texts: list[str | None]) -> list[list[Stretch]]:
        """The stretches of each text; none if it has no tokens."""
        if len(self.known) > STRETCHES or self.chars > STRETCH_CHARS:
            self.known, self.chars = {}, 0
        split = [(self.codec.split(t) if self.divides else [t]) if t else [] for t in texts]
        self._learn(list(set().union(*split).difference(self.known)))
        rows = [list(map(self.known.__getitem__, parts)) for parts in split]
        return [[] if None in row else row for row in rows]


@functools.lru_cache(maxsize=2)
def aligner(a_path: str, b_path: str) -> Aligner:
    return Aligner(a_path, b_path)


def planes(keys: np.ndarray) -> Iterator[tuple[np.ndarray, int, list[bytes]]]:
    """(pairs, plane, bitmaps) of links given as pair << 16 | position, sorted here."""
    keys.sort()
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]][:len(keys)])
    times = np.diff(np.append(first, len(keys)))
    keys = keys[first]
    for plane in range(int(times.max(initial=0)).bit_length()):
        own = keys[(times >> plane) & 1 == 1]
        pair, position = own >> _POSITION, (own & np.uint64(0xFFFF)).astype("<u2")
        start = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1]][:len(pair)])
        ends = np.append(start[1:], len(pair))
        yield pair[start], plane, [bitmaps.pack(position[s:e])
                                   for s, e in zip(start.tolist(), ends.tolist())]


_DOCUMENT = [("no", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()),
             ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string())]
_POSTING = [("a", pa.int32()), ("b", pa.int32()), ("chunk", pa.int64()), ("plane", pa.int32()),
            ("docs", pa.binary())]
_ROWS = pa.schema([("kind", pa.string()), *_DOCUMENT, *_POSTING])
_SPARK = {pa.int64(): "long", pa.int32(): "int", pa.string(): "string", pa.binary(): "binary"}


def _ddl(fields) -> str:
    return ", ".join(f"{name} {_SPARK[kind]}" for name, kind in fields)


def _rows(kind: str, columns: dict) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays(
        [pa.array([kind] * n) if f.name == "kind" else
         pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type)
         for f in _ROWS], schema=_ROWS)


def tokenized(docs: DataFrame, a_path: str, b_path: str) -> tuple[DataFrame, DataFrame]:
    """(documents, postings), written in one pass over the texts: one row per document with
    its own counts and its number, and the planes of every pair."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(a_path, b_path)
        first_chunk = TaskContext.get().partitionId() << 24
        chunk, position, held, n_held, n_chunk = first_chunk, 0, [], 0, 0

        def written() -> Iterator[pa.RecordBatch]:
            keys = np.concatenate(held) if held else np.empty(0, np.uint64)
            for pair, plane, docs in planes(keys):
                n = len(pair)
                yield _rows("posting", {
                    "a": (pair >> _ID).astype(np.int32), "docs": docs,
                    "b": (pair & np.uint64((1 << 24) - 1)).astype(np.int32),
                    "chunk": np.full(n, chunk), "plane": np.full(n, plane, np.int32)})

        for batch in chunks(batches, "text", 1 << 20):
            texts = own.aligned(batch.column(1).to_pylist())
            columns = {name: [] for name, _ in _DOCUMENT}
            for doc_id, row in zip(batch.column(0).to_pylist(), texts):
                links = np.frombuffer(b"".join([s.links for s in row]), "<u8")
                groups = ";".join([s.groups for s in row])
                n_groups = groups.count("|")
                values = ((chunk << 16) + position, doc_id, sum([s.n_a for s in row]),
                          sum([s.n_b for s in row]), n_groups, len(links),
                          hashlib.sha256(groups.encode()).hexdigest() if row else "")
                for column, value in zip(columns.values(), values):
                    column.append(value)
                held.append(links << _POSITION | np.uint64(position))
                n_held, n_chunk, position = n_held + len(links), n_chunk + len(links), position + 1
                ends = position == bitmaps.POSITIONS or n_chunk >= CHUNK_LINKS
                if ends or n_held >= LINKS:
                    yield from written()
                    held, n_held = [], 0
                if ends:
                    chunk, position, n_chunk = chunk + 1, 0, 0
            yield _rows("document", columns)
        yield from written()

    rows = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "kind string, " + _ddl(_DOCUMENT) + ", " + _ddl(_POSTING))
    both = stored(rows, "alignment", ["kind"])
    return (both.filter("kind = 'document'").select(*[n for n, _ in _DOCUMENT]),
            both.filter("kind = 'posting'").select(*[n for n, _ in _POSTING]))


def index(postings: DataFrame) -> DataFrame:
    """(a, b, chunk, n_docs, n_links, planes): the parts of each pair and chunk OR-merged."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
        out: list[tuple] = []
        for key, parts in itertools.groupby(rows, lambda r: r[:3]):
            merged: list[bytes] = []
            for plane, same in itertools.groupby(parts, lambda r: r[3]):
                merged += [b""] * (plane - len(merged))
                merged.append(bitmaps.union([r[4] for r in same]))
            some = [m for m in merged if m]
            out.append((*key, bitmaps.count(bitmaps.union(some)),
                        sum(bitmaps.count(m) << k for k, m in enumerate(merged)), merged))
            if len(out) == 2000:
                yield batch_of(out)
                out = []
        if out:
            yield batch_of(out)

    def batch_of(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*out), kinds)],
            ["a", "b", "chunk", "n_docs", "n_links", "planes"])

    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.binary())]
    return postings.repartition("a", "b", "chunk").sortWithinPartitions(
        "a", "b", "chunk", "plane").mapInArrow(
        run, "a int, b int, chunk long, n_docs long, n_links long, planes array<binary>")


def pairs(indexed: DataFrame) -> DataFrame:
    """(a, b, n_docs, n_links, best): documents and links of each pair in the corpus, and
    whether no other partner of ``b`` has more links."""
    counts = indexed.groupBy("a", "b").agg(F.sum("n_docs").alias("n_docs"),
                                           F.sum("n_links").alias("n_links"))
    most = counts.groupBy("b").agg(F.max("n_links").alias("most"))
    return counts.join(most, "b").select(
        "a", "b", "n_docs", "n_links", (F.col("n_links") == F.col("most")).alias("best"))


def scores(indexed: DataFrame, counted: DataFrame) -> DataFrame:
    """(no, n_best, count_sum) of every document with links: its links that are the best of
    their ``b``, and the corpus-wide counts of all its links added up."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
        for chunk, postings in itertools.groupby(rows, lambda r: r[0]):
            total, best = (np.zeros(bitmaps.POSITIONS, np.int64) for _ in range(2))
            for _, merged, n_links, is_best in postings:
                for plane, docs in enumerate(merged):
                    if docs:
                        own = bitmaps.members(docs)  # no position twice
                        total[own] += n_links << plane
                        if is_best:
                            best[own] += 1 << plane
            own = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array((chunk << 16) + own), pa.array(best[own]), pa.array(total[own])],
                ["no", "n_best", "count_sum"])

    return (indexed.select("a", "b", "chunk", "planes")
            .join(counted.select("a", "b", "n_links", "best"), ["a", "b"])
            .select("chunk", "planes", "n_links", "best")
            .repartition("chunk").sortWithinPartitions("chunk")
            .mapInArrow(run, "no long, n_best long, count_sum long"))


def alignment(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) per document."""
    documents, postings = tokenized(docs, a_path, b_path)
    indexed = stored(index(postings), "pair-index")
    counted = stored(pairs(indexed), "pair-counts")
    zero = F.lit(0).cast("long")
    return documents.join(scores(indexed, counted), "no", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256")


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text aligned, with corpus-wide counts of its links."""
    return alignment(table(spark, sf_dir, "documents"), public_tokenizers.path(A_VOCABULARY),
                     public_tokenizers.path(B_VOCABULARY))
