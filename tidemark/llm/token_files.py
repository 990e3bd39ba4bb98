"""Token ids of documents in binary files of patched frame-of-reference blocks.

Documents are range partitioned and sorted by doc_id (nulls first); rows of one doc_id follow
the hash of their text, then the text. Each task encodes its texts and writes files of about
``FILE_IDS`` ids to the shared folder, on any storage that ``pyarrow.fs`` can open. Its
output rows, one per file, are committed by Spark: a file of a task that was lost or ran twice
is named by no row, so nobody reads it. That table of files, in the order of doc_id, is all that
a reader needs. Positions count over all files: a file starts where those before it end.

    file       b"TDPF0001", blocks (see ``pfor``), document table, block starts u64 [blocks],
               footer
    documents  i64 doc_id [n], u8 null [n], u64 ids [n]
    footer     u64 start of the document table, u64 start of the block starts, u64 documents,
               u64 ids, u64 blocks, b"TDPF0001"

Every document ends with ``END``. Null texts count as empty: they have the end id alone. A
document table without rows gives no files. Repeated rows are documents of their own. Other
columns are not read.
"""

from __future__ import annotations

import functools
import itertools
import json
import os
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm import pfor
from tidemark.llm.common import chunks, stored, table
from tidemark.sources.scratch import scratch_path

VOCABULARY = "word_bpe_49k.json"
END = 1
FILE_IDS = 1 << 24  # a file is closed after the document that reaches this
SLICE_IDS = 1 << 19  # encoded or decoded at a time
LINE = 1000  # words encoded as one line
# Words kept per Python worker, about 220 bytes each; when there are more words or more
# characters in them, the store starts anew.
WORDS, WORD_CHARS = 1_000_000, 20_000_000

_MAGIC = b"TDPF0001"
_FOOTER = struct.Struct("<5Q8s")
_FILES = ("part int, file int, path string, n_docs long, n_ids long, n_bytes long")


# Words of letters that composition leaves alone, with punctuation behind them or none. Where
# a letter and one of these marks meet, a match of the pre-tokenizer's pattern ends.
_MARKS = ".,;:!?"
_LETTERS = "^[A-Za-zÀ-ÖØ-öø-ÿ]+"
_PLAIN = f"{_LETTERS}[{_MARKS}]*$"


class Numbers:
    """An array that grows at its end."""

    def __init__(self, kind):
        self.room, self.n = np.empty(1 << 10, kind), 0

    def add(self, values) -> None:
        end = self.n + len(values)
        if end > len(self.room):
            room = np.empty(max(end, 2 * len(self.room)), self.room.dtype)
            room[:self.n] = self.room[:self.n]
            self.room = room
        self.room[self.n:end] = values
        self.n = end


def runs(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of all runs of numbers, one run after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)


class Encoder:
    """Ids of whole texts.

    The pre-tokenizer drops white space and no match of its pattern holds any, and neither
    composition nor lower-casing looks across it. So a text's ids are those of its words one
    after the other; each is encoded once while it recurs. Only the four commonest white
    space characters divide words here; the library sees the others.

    A word of common letters is lower-cased and needs neither the normaliser nor the pattern:
    the library encodes it as one match. All other words take the vocabulary's whole way.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has one task per core
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        whole = spec["pre_tokenizer"]["pretokenizers"]
        steps = [{"type": "WhitespaceSplit"},
                 next(step for step in whole if step["type"] == "ByteLevel")]
        one_match = {**spec, "normalizer": None, "added_tokens": [],
                     "pre_tokenizer": {"type": "Sequence", "pretokenizers": steps}}
        self.whole = Tokenizer.from_file(path)
        self.one_match = Tokenizer.from_str(json.dumps(one_match))
        # the last token of a match ends with the suffix, no other token does
        tokens, suffix = spec["model"]["vocab"], spec["model"]["end_of_word_suffix"]
        self.ends_match = np.zeros(max(tokens.values()) + 1, bool)
        self.ends_match[[n for token, n in tokens.items() if token.endswith(suffix)]] = True
        self._forget()

    def _forget(self) -> None:
        # a word's number; where its ids start among all, and how many there are
        self.known: dict[str, int] = {}
        self.ids, self.starts, self.sizes = Numbers("<u4"), Numbers(np.int64), Numbers(np.int64)
        self.chars = 0
        self._keep([""], np.empty(0, "<u4"), np.zeros(1, np.int64))

    def _keep(self, words: list[str], ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Keeps words that are not known, each given once, with the ids of all and each one's
        number of ids; returns the words' numbers."""
        numbers = np.arange(self.sizes.n, self.sizes.n + len(words))
        self.known.update(zip(words, numbers.tolist()))
        self.starts.add(self.ids.n + np.cumsum(sizes) - sizes)
        self.sizes.add(sizes)
        self.ids.add(ids)
        self.chars += sum(map(len, words))
        return numbers

    def _find(self, words: list[str], learn) -> np.ndarray:
        """The numbers of words, each given once; ``learn`` gives those of unknown ones."""
        found = np.fromiter(map(self.known.get, words, itertools.repeat(-1)), np.int64, len(words))
        missing = np.flatnonzero(found < 0)
        if len(missing):
            found[missing] = learn([words[n] for n in missing.tolist()])
        return found

    def _learn_whole(self, words: list[str]) -> np.ndarray:
        found = [e.ids for e in self.whole.encode_batch_fast(words, add_special_tokens=False)]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        ids = np.fromiter(itertools.chain.from_iterable(found), "<u4", sizes.sum())
        return self._keep(words, ids, sizes)

    def _learn_letters(self, words: list[str]) -> np.ndarray:
        """Words of letters in lower case, each of which is one match; many are encoded as one
        line, in which the suffix tells where each ends."""
        lines = [" ".join(words[n:n + LINE]) for n in range(0, len(words), LINE)]
        found = self.one_match.encode_batch_fast(lines, add_special_tokens=False)
        ids = np.concatenate([np.empty(0, "<u4"), *[np.array(e.ids, "<u4") for e in found]])
        return self._keep(words, ids, np.diff(np.flatnonzero(self.ends_match[ids]), prepend=-1))

    def _learn_words(self, words: list[str]) -> np.ndarray:
        """Words of letters and marks are put together from these two halves."""
        column = pa.array(words, pa.string())
        match = pc.match_substring_regex(column, _PLAIN)
        plain = column.filter(match)
        letters = pc.utf8_lower(pc.utf8_rtrim(plain, _MARKS)).dictionary_encode()
        marks = pc.replace_substring_regex(plain, _LETTERS, "").dictionary_encode()
        # letters with marks, or not in lower case, are words of their own; all others were looked
        # up as words already
        other = pc.not_equal(plain, letters.dictionary_decode()).to_numpy(zero_copy_only=False)
        first, second = letters.indices.to_numpy(), marks.indices.to_numpy()
        unknown = np.zeros(len(letters.dictionary), bool)
        unknown[first[~other]] = True
        number = np.empty(len(unknown), np.int64)
        number[unknown] = self._learn_letters(letters.dictionary.filter(unknown).to_pylist())
        number[~unknown] = self._find(letters.dictionary.filter(~unknown).to_pylist(),
                                      self._learn_letters)
        own = number[first]
        some = pc.not_equal(marks.dictionary, "").to_numpy(zero_copy_only=False)
        number = np.zeros(len(some), np.int64)  # the empty word's is 0
        number[some] = self._find(marks.dictionary.filter(some).to_pylist(), self._learn_whole)
        halves = np.stack([own, number[second]], axis=1)[other]
        sizes = self.sizes.room[halves]
        ids = self.ids.room[runs(self.starts.room[halves].ravel(), sizes.ravel())]
        own[other] = self._keep(plain.filter(other).to_pylist(), ids, sizes.sum(axis=1))
        found, match = np.empty(len(words), np.int64), match.to_numpy(zero_copy_only=False)
        found[match] = own
        found[~match] = self._learn_whole(column.filter(~match).to_pylist())
        return found

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The texts' ids as little-endian unsigned 32-bit integers."""
        if len(self.known) > WORDS or self.chars > WORD_CHARS:
            self._forget()
        # a word is looked up once per call, however often it stands in the texts
        parts = pc.split_pattern(pa.array([
            (t or "").replace("\n", " ").replace("\t", " ").replace("\r", " ") for t in texts],
            pa.string()), " ")
        places = parts.flatten().dictionary_encode()
        words = places.dictionary.to_numpy(zero_copy_only=False).tolist()
        which = self._find(words, self._learn_words)[places.indices.to_numpy()]
        counts = self.sizes.room[which]
        data = self.ids.room[runs(self.starts.room[which], counts)].tobytes()
        ends = np.append(0, np.cumsum(counts))
        bounds = (4 * ends[parts.offsets.to_numpy()]).tolist()
        return [data[a:b] for a, b in zip(bounds, bounds[1:])]


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def storage(path: str) -> tuple[pa.fs.FileSystem, str]:
    """The file system of a path or address, and the path on it."""
    if path.startswith("file:"):
        path = "/" + path[len("file:"):].lstrip("/")
    return pa.fs.FileSystem.from_uri(path)


class Writer:
    """One file of tokens, written as ids arrive."""

    def __init__(self, path: str):
        files, at = storage(path)
        files.create_dir(os.path.dirname(at), recursive=True)
        self.path, self.out = path, files.open_output_stream(at)
        self.out.write(_MAGIC)
        self.at, self.n_ids = len(_MAGIC), 0
        self.waiting, self.n_waiting = [], 0
        self.starts, self.docs, self.counts = [], [], []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append(doc_id)
        self.counts.append(len(ids))
        self.waiting.append(ids)
        self.n_waiting += len(ids)
        self.n_ids += len(ids)
        if self.n_waiting >= SLICE_IDS:
            self._flush(self.n_waiting // pfor.BLOCK * pfor.BLOCK)

    def _flush(self, n: int) -> None:
        ids = np.concatenate(self.waiting) if self.waiting else np.empty(0, np.uint32)
        for a in range(0, n, SLICE_IDS):
            data, starts = pfor.encode(ids[a:min(a + SLICE_IDS, n)])
            self.out.write(data)
            self.starts.append(starts + self.at)
            self.at += len(data)
        self.waiting, self.n_waiting = [ids[n:]], len(ids) - n

    def close(self) -> dict:
        self._flush(self.n_waiting)
        starts = np.concatenate([np.empty(0, np.int64), *self.starts]).astype("<u8")
        n = len(self.docs)
        documents = (np.array([d or 0 for d in self.docs], "<i8").tobytes()
                     + np.array([d is None for d in self.docs], "u1").tobytes()
                     + np.array(self.counts, "<u8").tobytes())
        self.out.write(documents + starts.tobytes() + _FOOTER.pack(
            self.at, self.at + len(documents), n, self.n_ids, len(starts), _MAGIC))
        size = self.out.tell()
        self.out.close()
        return {"path": self.path, "n_docs": n, "n_ids": self.n_ids, "n_bytes": size}


class Reader:
    """Reads a file: its documents, and ids at any position without those before."""

    def __init__(self, path: str):
        files, at = storage(path)
        self.file = files.open_input_file(at)
        size = self.file.size()
        tail = self.file.read_at(_FOOTER.size, size - _FOOTER.size)
        first, second, n, self.n_ids, blocks, magic = _FOOTER.unpack(tail)
        if magic != _MAGIC:
            raise ValueError(f"{path} is no token file")
        raw = self.file.read_at(second - first, first)
        null = np.frombuffer(raw, "u1", n, 8 * n)
        ids = np.frombuffer(raw, "<i8", n).tolist()
        self.doc_ids = [None if x else d for d, x in zip(ids, null)]
        self.counts = np.frombuffer(raw, "<u8", n, 9 * n).astype(np.int64)
        starts = np.frombuffer(self.file.read_at(8 * blocks, second), "<u8")
        self.starts = np.append(starts.astype(np.int64), first)

    def __enter__(self) -> "Reader":
        return self

    def __exit__(self, *_) -> None:
        self.file.close()

    def read(self, at: int, n: int) -> np.ndarray:
        """``n`` ids from position ``at`` on, from the blocks that hold them."""
        n = max(0, min(n, self.n_ids - at))
        if not n:
            return np.empty(0, np.uint32)
        a, b = at // pfor.BLOCK, -(-(at + n) // pfor.BLOCK)
        data = self.file.read_at(int(self.starts[b] - self.starts[a]), int(self.starts[a]))
        skip = at - a * pfor.BLOCK
        return pfor.decode(data, self.starts[a:b] - self.starts[a], skip + n)[skip:]

    def slices(self) -> Iterator[np.ndarray]:
        for at in range(0, self.n_ids, SLICE_IDS):
            yield self.read(at, SLICE_IDS)

    def checksums(self) -> list[int]:
        """The unsigned crc32 of each document's ids as little-endian 32-bit integers."""
        ends = np.cumsum(self.counts)
        out, doc, crc, at = [], 0, 0, 0
        for ids in self.slices():
            data, a = memoryview(ids.astype("<u4").tobytes()), 0
            while a < len(ids):
                b = min(len(ids), int(ends[doc]) - at)
                crc = zlib.crc32(data[4 * a:4 * b], crc)
                a = b
                if at + b == ends[doc]:  # no document is without ids
                    out.append(crc)
                    doc, crc = doc + 1, 0
            at += len(ids)
        return out


def write(docs: DataFrame, vocabulary: str, folder: str) -> DataFrame:
    """Encodes every text into files below ``folder``; returns the table of files:
    (part, file, path, n_docs, n_ids, n_bytes, start)."""
    # equal rows share doc_id and hash; the random column lets a range end between them
    rows = (docs.select(F.col("doc_id").cast("long"), "text")
            .withColumn("_tie", F.xxhash64("text")).withColumn("_salt", F.rand(11))
            .repartitionByRange("doc_id", "_tie", "_salt")
            .sortWithinPartitions("doc_id", "_tie", "text").select("doc_id", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, file, writer = TaskContext.get().partitionId(), 0, None

        def closed() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([{"part": part, "file": file, **writer.close()}],
                                              schema)

        own, end = encoder(vocabulary), np.array([END], "<u4").tobytes()
        for batch in chunks(batches, "text", 1 << 20):
            doc_ids = batch.column(0).to_pylist()
            for doc_id, raw in zip(doc_ids, own.encode(batch.column(1).to_pylist())):
                writer = writer or Writer(f"{folder}/{part:08d}-{file:06d}-{uuid.uuid4().hex}")
                writer.add(doc_id, np.frombuffer(raw + end, "<u4"))
                if writer.n_ids >= FILE_IDS:
                    yield closed()
                    file, writer = file + 1, None
        if writer:
            yield closed()

    schema = pa.schema([("part", pa.int32()), ("file", pa.int32()), ("path", pa.string()),
                        *[(c, pa.int64()) for c in ("n_docs", "n_ids", "n_bytes")]])
    files = stored(rows.mapInArrow(run, _FILES), "token-files")
    # one row per part, then per file of a part
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (files.groupBy("part").agg(F.sum("n_ids").alias("n"))
             .select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_part")))
    earlier = Window.partitionBy("part").orderBy("file").rowsBetween(
        Window.unboundedPreceding, -1)
    return (files.withColumn("_file", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0)))
            .join(parts, "part").withColumn("start", F.col("_part") + F.col("_file"))
            .drop("_part", "_file"))


def _each_file(files: DataFrame, run, schema: str) -> DataFrame:
    """``run(reader, start)`` for every file, spread over as many tasks as there are files
    (four per core at most)."""
    most = 4 * files.sparkSession.sparkContext.defaultParallelism
    tasks = max(1, min(files.count(), most))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                with Reader(row["path"]) as reader:
                    yield from run(reader, row["start"])

    return files.select("path", "start").repartition(tasks).mapInArrow(read, schema)


def documents(files: DataFrame) -> DataFrame:
    """(doc_id, start, ids) of every document in the files."""
    def run(reader: Reader, start: int) -> Iterator[pa.RecordBatch]:
        at = 0
        for doc_id, n in zip(reader.doc_ids, reader.counts.tolist()):
            yield pa.RecordBatch.from_arrays([
                pa.array([doc_id], pa.int64()), pa.array([start + at], pa.int64()),
                pa.array([reader.read(at, n).astype(np.int32)], pa.list_(pa.int32()))],
                ["doc_id", "start", "ids"])
            at += n

    return _each_file(files, run, "doc_id long, start long, ids array<int>")


def digests(files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files."""
    def run(reader: Reader, start: int) -> Iterator[pa.RecordBatch]:
        counts = reader.counts
        yield pa.RecordBatch.from_arrays([
            pa.array(reader.doc_ids, pa.int64()),
            pa.array(start + np.cumsum(counts) - counts, pa.int64()),
            pa.array(counts, pa.int64()), pa.array(reader.checksums(), pa.int64())],
            ["doc_id", "start", "n_tokens", "ids_crc32"])

    return _each_file(files, run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text written to token files, and what the files hold of it."""
    files = write(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY),
                  scratch_path(spark, "tokens"))
    return digests(files)
