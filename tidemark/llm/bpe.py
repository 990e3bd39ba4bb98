"""Byte-level BPE encoding and decoding with the ``tokenizers`` library.

Texts arrive as Arrow batches. Between two characters that are not white space, a cut in
front of a single space never divides a match of the pre-tokenizer's pattern, so a text is
the sequence of its pieces " word": each is encoded once and kept while it recurs, and a
text's ids are its pieces' ids one after the other. Where white space meets white
space or an end of the text no cut is made.

The vocabulary writes each byte as a printable character. Decoding turns every id back
into its bytes with the reversed byte table and joins those; a character split over
several tokens comes together in the joined bytes. Offsets are kept for bytes and for
characters; the tokens of a split character all cover that character.

Null texts count as empty and have no ids. Other columns are not read.
"""

from __future__ import annotations

import functools
import hashlib
import json
import os
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import chunks, table

VOCABULARY = "byte_bpe_50k.json"
# Pieces kept per Python worker, about 200 bytes each; when full, the store starts anew.
PIECES = 400_000
# Longer pieces are encoded but not kept.
PIECE_CHARS = 200
# Bytes of text taken at a time, and ids decoded at a time.
TEXT_BYTES = 1 << 20
IDS = 1 << 16
# White space other than space and line feed; a text that has any is divided with care.
_RARE = "\t\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(
    map(chr, range(0x2000, 0x200B)))


def byte_characters() -> dict[str, int]:
    """The character that stands for each byte: printable Latin-1 characters stand for
    themselves, the other bytes get the characters from U+0100 on, in order."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    table, extra = {}, 0x100
    for byte in range(256):
        if byte in shown:
            table[chr(byte)] = byte
        else:
            table[chr(extra)] = byte
            extra += 1
    return table


class Pieces(dict):
    """Ids of pieces, as little-endian unsigned 32-bit integers; missing ones are encoded."""

    def __init__(self, encode, lead: str):
        super().__init__()
        self.encode, self.lead = encode, lead

    def __missing__(self, piece: str) -> bytes:
        ids = self.encode(self.lead + piece, add_special_tokens=False).ids
        raw = np.array(ids, "<u4").tobytes()
        if len(piece) <= PIECE_CHARS:
            self[piece] = raw
        return raw


class Codec:
    """A vocabulary, its encoder and the pieces seen so far."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has one task per core
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.encode_special_tokens = True  # their strings are ordinary text
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        special = {t["content"] for t in spec["added_tokens"]}
        vocabulary, byte_of = spec["model"]["vocab"], byte_characters()
        own = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            if token not in special:
                own[i] = bytes(byte_of[c] for c in token)
        self.lengths = np.array([len(b) for b in own])
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(own), np.uint8)
        self.first = Pieces(tokenizer.encode, "")  # pieces at the start of a text
        self.later = Pieces(tokenizer.encode, " ")  # those after a space

    @staticmethod
    def split(text: str) -> list[str]:
        """The pieces of a text, all but the first without the space in front."""
        parts = text.split(" ")
        if not ("" in parts or "\n\n" in text or "\n " in text or " \n" in text
                or text[:1].isspace() or text[-1:].isspace()
                or any(c in text for c in _RARE)):
            return parts
        out = [parts[0]]
        for part in parts[1:]:
            last = out[-1][-1:]
            if part and not part[0].isspace() and last and not last.isspace():
                out.append(part)
            else:
                out[-1] += " " + part
        return out

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if len(self.first) + len(self.later) > PIECES:
            self.first.clear()
            self.later.clear()
        first, *later = self.split(text)
        return self.first[first] + b"".join(map(self.later.__getitem__, later))

    def decode(self, ids: bytes | np.ndarray) -> bytes:
        return b"".join(self.decoded(ids))

    def decoded(self, ids: bytes | np.ndarray) -> Iterator[bytes]:
        """The bytes of a text, so many ids at a time."""
        numbers = np.frombuffer(ids, "<u4") if isinstance(ids, bytes) else ids
        for at in range(0, len(numbers), IDS):
            part = numbers[at:at + IDS]
            sizes = self.lengths[part]
            ends = np.cumsum(sizes)
            places = np.repeat(self.starts[part] - (ends - sizes), sizes)
            yield self.bytes[places + np.arange(len(places))].tobytes()

    def decoded_sha256(self, ids: bytes) -> str:
        digest = hashlib.sha256()
        for part in self.decoded(ids):
            digest.update(part)
        return digest.hexdigest()

    def byte_ends(self, ids: np.ndarray) -> np.ndarray:
        return np.cumsum(self.lengths[ids])


def character_offsets(data: bytes, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First character and the one after the last that each token has bytes of."""
    if not len(ends):
        return ends, ends
    head = (np.frombuffer(data, np.uint8) & 0xC0) != 0x80
    at = np.cumsum(head) - 1  # the character each byte belongs to
    starts = np.concatenate([[0], ends[:-1]])
    return at[starts], at[ends - 1] + 1


@functools.lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def _texts(batch: pa.RecordBatch) -> list[str]:
    return [t or "" for t in batch.column(1).to_pylist()]


def encode(df: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids, byte_ends, char_starts, char_ends): one entry per token each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in chunks(batches, "text", TEXT_BYTES):
            texts = _texts(batch)
            columns = []
            for t in texts:
                ids = np.frombuffer(own.encode(t), "<u4").astype(np.int32)
                ends = own.byte_ends(ids)
                columns.append((ids, ends, *character_offsets(t.encode(), ends)))
            kind = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)] + [pa.array([c[i].astype(np.int32) for c in columns], kind)
                                     for i in range(4)],
                ["doc_id", "ids", "byte_ends", "char_starts", "char_ends"])

    source = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, ids array<int>, byte_ends array<int>, "
                                  "char_starts array<int>, char_ends array<int>")


def decode(df: DataFrame, path: str, doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(doc_id, bytes): the bytes that the ids stand for."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            out = [own.decode(np.asarray(x or [], np.int64)) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(out, pa.binary())], ["doc_id", "bytes"])

    source = df.select(F.col(doc_id).alias("doc_id"), F.col(ids).alias("ids"))
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, bytes binary")


def round_trip(df: DataFrame, path: str, doc_id: str = "doc_id",
               text: str = "text") -> DataFrame:
    """Digests of ``encode`` and of decoding its ids, in one pass over the texts:
    (doc_id, n_tokens, ids_sha256, decoded_sha256)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in chunks(batches, "text", TEXT_BYTES):
            ids = [own.encode(t) for t in _texts(batch)]
            yield pa.RecordBatch.from_arrays([
                batch.column(0),
                pa.array([len(x) // 4 for x in ids], pa.int64()),
                pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()),
                pa.array(map(own.decoded_sha256, ids), pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    source = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(
        run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text encoded and decoded again."""
    return round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))
