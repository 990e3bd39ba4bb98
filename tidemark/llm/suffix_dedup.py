"""Removal of repeated 200-byte strings with suffix arrays over shards.

Every place where a 200-byte string begins is put under that string's anchor: the smallest
scrambled hash among its 32-byte substrings. Equal strings have equal anchors, so shards by
anchor never separate them. Neighbouring places mostly share their anchor; such a run with
the bytes its strings cover is a segment, and segments are all that travels:

1. One pass lists every document's segments by anchor and content digest, without bytes.
   Anchors that occur once cannot hold a repeat, unless the anchor stands twice inside the
   segment itself, which the pass notes.
2. Equal segments under one anchor are one. If it occurs more than once, all its strings
   repeat. Where an anchor has a segment that occurs once, the anchor's different segments
   are cut out of their documents and sorted by anchor.
3. Each shard, whole anchors up to ``SHARD_BYTES``, gets a suffix array by induced sorting
   and permuted common prefixes; a place repeats if it shares 200 bytes with a neighbour.
   An anchor with more than ``HOT_BYTES`` of different segments is dealt out again instead:
   its segments take the place of the documents, and the smallest hashes of several other
   scramblings together are the anchor, which spares a round of its own for each.
4. Repeated places go back to all documents that have their segment, and each document
   drops the bytes they cover.

Null texts count as empty. Texts under 200 bytes keep all. Repeated rows (same doc_id and
text) repeat each other. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.bagminhash import mix
from tidemark.llm.common import chunks, row_hash, stored, table
from tidemark.llm.suffixes import repeated

WIDTH, GRAM = 200, 32
# A segment has at most this many places; a longer run is several segments.
MOST_PLACES = 2_048
SHARD_BYTES = 1 << 20
HOT_BYTES = 256 << 10
# The scramblings whose smallest hashes make the anchor of each round. Dealing out hot anchors
# again ends with the last round; what is left is sorted as it is.
SCRAMBLINGS = ((0,), (1, 2), (3, 4, 5, 6))
LEVELS = len(SCRAMBLINGS) - 1
_U = np.uint64
_STEPS = [_U(int(x) | 1) for x in mix(np.arange(1, 9, dtype=_U))]
_LETTER = mix(np.arange(256, dtype=_U) + _U(0x9E3779B97F4A7C15))


def _sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over every ``width`` neighbouring values."""
    span = 1
    while 2 * span <= width:
        values = pick(values[:-span], values[span:])
        span *= 2
    rest = width - span
    return pick(values[:-rest], values[rest:]) if rest else values


def _scrambled(grams: np.ndarray, k: int) -> np.ndarray:
    return mix(grams + _U(k * 0x632BE59BD9B4E019 % 2 ** 64))


def segments(data: list[bytes], level: int = 0) -> tuple[np.ndarray, ...]:
    """Segments of all texts: (text, start, places, anchor, whether the anchor may stand in
    it twice), in order."""
    sizes = np.array([len(d) for d in data], np.int64)
    empty = np.empty(0, np.int64)
    if not len(sizes) or sizes.sum() < WIDTH or sizes.max() < WIDTH:
        return empty, empty, empty, empty, empty.astype(bool)
    line = np.frombuffer(b"".join(data), np.uint8)
    value = _LETTER[line]
    span = 1
    for step in _STEPS[:GRAM.bit_length() - 1]:
        value = value[:-span] * step + value[span:]
        value ^= value >> _U(29)
        span *= 2
    grams, width = value, WIDTH - GRAM + 1
    first, *others = SCRAMBLINGS[level]
    value = _scrambled(grams, first)
    least = _sliding(value, width, np.minimum)
    anchors = least
    for k in others:
        anchors = mix(anchors * _STEPS[0] + _sliding(_scrambled(grams, k), width, np.minimum))
    ends = np.cumsum(sizes)
    starts = ends - sizes
    mark = np.zeros(len(line) + 1, np.int8)
    long = sizes >= WIDTH
    mark[starts[long]] += 1
    np.add.at(mark, ends[long] - WIDTH + 1, -1)
    valid = np.cumsum(mark[:len(least)], dtype=np.int8) > 0
    change = np.flatnonzero((anchors[1:] != anchors[:-1]) | (valid[1:] != valid[:-1])) + 1
    begin = np.concatenate([[0], change])
    stop = np.append(change, len(least))
    begin, stop = begin[valid[begin]], stop[valid[begin]]
    anchor = anchors[begin]

    # where the first scrambling's anchors themselves stand: no string around has a smaller
    # hash. Strings that repeat inside a segment hold all of its anchors, the first one too
    around = np.zeros(len(value) + width - 1, _U)
    around[width - 1:width - 1 + len(least)] = np.where(valid, least, _U(0))
    stands = np.flatnonzero(_sliding(around, width, np.maximum)[:len(value)] == value)
    # at a distance of width a string holds one of the two, and the run goes on unbroken
    twice = np.flatnonzero((value[stands][1:] == value[stands][:-1])
                           & (np.diff(stands) <= width))
    double = np.isin(least[begin], np.unique(value[stands[twice]]))

    pieces = -(-(stop - begin) // MOST_PLACES)
    part = np.arange(int(pieces.sum())) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    double = np.repeat(double | (pieces > 1), pieces)
    anchor = np.repeat(anchor, pieces)
    first = np.repeat(begin, pieces) + part * MOST_PLACES
    places = np.minimum(MOST_PLACES, np.repeat(stop, pieces) - first)
    text = np.searchsorted(ends, first, "right")
    return text, first - starts[text], places, anchor.view(np.int64), double


def _digest(piece: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(piece, digest_size=8).digest(), "little", signed=True)


def occurrences(sources: DataFrame, level: int) -> DataFrame:
    """(a, b, anchor, digest, start, size) for every segment of ``sources`` (a, b, data);
    size is twice the number of places, plus one if the anchor may stand in it twice."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "data", 2 << 20):
            data = [d or b"" for d in batch.column(2).to_pylist()]
            text, start, places, anchor, double = segments(data, level)
            digests = [_digest(data[t][s:s + n + WIDTH - 1]) for t, s, n in
                       zip(text.tolist(), start.tolist(), places.tolist())]
            at = pa.array(text)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), pa.array(anchor),
                 pa.array(digests, pa.int64()), pa.array(start.astype(np.int32)),
                 pa.array((2 * places + double).astype(np.int32))],
                ["a", "b", "anchor", "digest", "start", "size"])

    kind = sources.schema["a"].dataType.simpleString()
    return sources.select("a", "b", "data").mapInArrow(
        run, f"a {kind}, b long, anchor long, digest long, start int, size int")


def _packed(sources: DataFrame) -> DataFrame:
    """``sources`` compressed, for the way through a shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3)
        for batch in chunks(batches, "data"):
            data = [pack.compress(d or b"") for d in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(data, pa.binary())],
                ["a", "b", "data"])

    kind = sources.schema["a"].dataType.simpleString()
    return sources.select("a", "b", "data").mapInArrow(run, f"a {kind}, b long, data binary")


def _same(x: DataFrame, y: DataFrame) -> Column:
    return x["a"].eqNullSafe(y["a"]) & (x["b"] == y["b"])


def _cut_out(wanted: DataFrame, texts: DataFrame) -> DataFrame:
    """(anchor, digest, n, total, data): the bytes of the segments ``wanted``."""
    lists = wanted.groupBy("a", "b").agg(F.collect_list(
        F.struct("anchor", "digest", "n", "total", "start", "places")).alias("list"))
    rows = lists.join(texts, _same(lists, texts)).select("list", "data")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in chunks(batches, "data"):
            out = []
            for row, packed in zip(*(c.to_pylist() for c in batch.columns)):
                data = unpack.decompress(packed)
                out += [(x["anchor"], x["digest"], x["n"], x["total"],
                         data[x["start"]:x["start"] + x["places"] + WIDTH - 1]) for x in row]
            columns = list(zip(*out)) or [[]] * 5
            kinds = [pa.int64()] * 4 + [pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                ["anchor", "digest", "n", "total", "data"])

    return rows.mapInArrow(run, "anchor long, digest long, n long, total long, data binary")


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.flatnonzero(np.diff(flags, prepend=False, append=False))
    return edge[::2], edge[1::2] - edge[::2]


def _sorted_shards(pieces: DataFrame) -> DataFrame:
    """(anchor, digest, at, many): runs of repeated places in segments that occur once."""
    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
        shard: list[tuple] = []
        size = 0
        for batch in chunks(batches, "data"):
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if size >= SHARD_BYTES and row[0] != shard[-1][0]:
                    yield shard
                    shard, size = [], 0
                shard.append(row)
                size += len(row[3])
        if shard:
            yield shard

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in shards(batches):
            out = []
            for (anchor, digest, n, _), flags in zip(
                    shard, repeated([row[3] for row in shard], WIDTH)):
                if n == 1:
                    out += [(anchor, digest, a, m) for a, m in
                            zip(*(x.tolist() for x in _runs(flags)))]
            columns = list(zip(*out)) or [[]] * 4
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                ["anchor", "digest", "at", "many"])

    return (pieces.select("anchor", "digest", "n", "data").repartition("anchor")
            .sortWithinPartitions("anchor")
            .mapInArrow(run, "anchor long, digest long, at int, many int"))


def repeated_places(sources: DataFrame, level: int = 0, hot_bytes: int = HOT_BYTES
                    ) -> tuple[DataFrame, DataFrame]:
    """(a, b, start, many): runs of places in ``sources`` (a, b, data) where a string begins
    that also begins elsewhere; and the compressed texts that can have any."""
    found = stored(occurrences(sources, level), "segments")
    often = (found.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"),
                                         F.max(F.col("size") % 2).alias("double"))
             .filter((F.col("n") > 1) | (F.col("double") == 1)).select("anchor"))
    again = stored(found.join(often, "anchor"), "repeated")
    kinds = stored(again.groupBy("anchor", "digest").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.col("size") % 2).alias("double"),
        F.min(F.struct("a", "b", "start", F.floor(F.col("size") / 2).cast("int").alias("places"))
              ).alias("at")), "kinds")
    whole = kinds.filter("n > 1").select(
        "anchor", "digest", F.lit(0).alias("at"), F.col("at.places").alias("many"))
    mixed = (kinds.groupBy("anchor").agg(
        F.count(F.lit(1)).alias("kinds"), F.min("n").alias("least"),
        F.max("double").alias("double"), F.sum(F.col("at.places") + WIDTH - 1).alias("total"))
        .filter((F.col("least") == 1) & ((F.col("kinds") > 1) | (F.col("double") == 1)))
        .select("anchor", "total"))
    wanted = kinds.join(mixed, "anchor").select("anchor", "digest", "n", "total", "at.*")
    ids = again.select("a", "b").distinct()
    texts = _packed(sources)
    texts = stored(texts.join(ids, _same(texts, ids), "left_semi").dropDuplicates(["a", "b"]),
                   "texts")
    pieces = stored(_cut_out(wanted, texts), "pieces")
    hot = F.col("total") > (hot_bytes if level < LEVELS else float("inf"))
    places = whole.union(_sorted_shards(pieces.filter(~hot)))
    if level < LEVELS and pieces.filter(hot).limit(1).count():
        inner = pieces.filter(hot).select(F.col("anchor").alias("a"), F.col("digest").alias("b"),
                                          "data", "n")
        runs, _ = repeated_places(inner.drop("n"), level + 1, hot_bytes)
        once = inner.filter("n = 1").select("a", "b")
        runs = runs.join(once, ["a", "b"], "left_semi")
        places = places.union(runs.toDF("anchor", "digest", "at", "many"))
    runs = again.join(places, ["anchor", "digest"]).select(
        "a", "b", (F.col("start") + F.col("at")).alias("start"), "many")
    return runs, texts


def cut(data: bytes, runs: list[tuple[int, int]]) -> tuple[bytes, int]:
    """What is left of ``data`` without the strings that begin in ``runs``, and how many
    pieces were taken out."""
    out, done, pieces = [], 0, 0
    for start, many in sorted(runs):
        if start > done or not pieces:
            out.append(data[done:start])
            pieces += 1
        done = max(done, start + many - 1 + WIDTH)
    return b"".join([*out, data[done:]]), pieces


def remaining(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(a, b, n_bytes, kept, n_spans) for the documents that lose bytes: a is the doc_id, b
    the row's hash, kept the bytes left."""
    sources = docs.select(
        F.col(doc_id).alias("a"), row_hash(F.col(doc_id), F.col(text)).alias("b"),
        F.coalesce(F.col(text), F.lit("")).cast("binary").alias("data"))
    runs, texts = repeated_places(sources)
    # repeated rows list the same runs, once each
    lists = runs.groupBy("a", "b").agg(F.collect_set(F.struct("start", "many")).alias("list"))
    rows = lists.join(texts, _same(lists, texts)).select(lists["a"], lists["b"], "data", "list")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in chunks(batches, "data"):
            data = [unpack.decompress(d) for d in batch.column(2).to_pylist()]
            done = [cut(d, [(x["start"], x["many"]) for x in r])
                    for d, r in zip(data, batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([len(d) for d in data], pa.int64()),
                 pa.array([k for k, _ in done], pa.binary()),
                 pa.array([n for _, n in done], pa.int64())],
                ["a", "b", "n_bytes", "kept", "n_spans"])

    kind = sources.schema["a"].dataType.simpleString()
    return rows.mapInArrow(run, f"a {kind}, b long, n_bytes long, kept binary, n_spans long")


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated strings taken out of every whole text."""
    docs = table(spark, sf_dir, "documents")
    left = remaining(docs).select(
        "a", "b", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"), "n_spans",
        F.sha2("kept", 256).alias("kept_sha256"))
    data = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").alias("a"), row_hash(F.col("doc_id"), F.col("text")).alias("b"),
                       F.octet_length(data).cast("long").alias("n_bytes"),
                       F.sha2(data.cast("binary"), 256).alias("all_sha256"))
    return rows.join(left, _same(rows, left), "left").select(
        rows["a"].alias("doc_id"), "n_bytes",
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("kept_sha256", "all_sha256").alias("kept_sha256"))
