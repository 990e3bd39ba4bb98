"""Near-duplicate documents by BagMinHash, bands and a check of the true overlap.

A text is the multiset of its runs of five words (a text of fewer words is one run). Two
texts are linked if the weighted Jaccard similarity of their multisets, sum of smaller over
sum of larger counts, is at least ``SIMILARITY``; classes are the connected components.

Signatures. Every shingle owns Poisson processes over weight levels: one for the level
(0, 1], one for (1, 2], (2, 4], (4, 8] and so on, each with the rate of its width. A point
has a time, a register and, by successive halvings of its interval, a level; it belongs to
every document whose count of the shingle reaches that level. A register keeps its earliest
point. Two documents agree in a register with exactly the probability of their weighted
Jaccard similarity, and counts need no upper bound. Points later than every register's
earliest are never drawn: times come in order, and a document stops at the time by which
all registers are full, which is tried from an estimate upwards.

Bands. ``BANDS`` groups of ``ROWS`` registers make bucket keys; with 32 by 4 a pair at the
threshold meets in no bucket with probability (1 - 0.8^4)^32 < 5e-8.

Links. Copies of one text are one node, a 64-bit number, from the start. In every bucket
all texts are compared with its smallest node, so a bucket of n texts costs n checks, and
components of the verified links follow. Nearly all buckets then hold one component. Those that hold
several form clusters, and in a cluster all texts are compared in blocks, by products of
shingle matrices inside the tasks: a task has two blocks at most, and reports one link per
text; these links join whole components. So no pair that shares a bucket goes unchecked,
and no bucket is capped.

Null texts are alone in their class. Texts without words are linked to equal texts only.
Repeated rows are copies. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import WORD_BYTES, chunks, stored, table
from tidemark.llm.components import components

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 32, 4
REGISTERS = BANDS * ROWS
# Texts of a cluster that are compared with each other at a time, and their bytes on average.
BLOCK, BLOCK_BYTES = 512, 4 << 20
_U = np.uint64
_GOLD, _MUL1, _MUL2 = _U(0x9E3779B97F4A7C15), _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)
_BASE = _U(0x2545F4914F6CDD1D)  # any odd number does
_NEVER = _U(0xFFFFFFFFFFFFFFFF)


def mix(x: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit numbers one to one."""
    x = (x ^ (x >> _U(30))) * _MUL1
    x = (x ^ (x >> _U(27))) * _MUL2
    return x ^ (x >> _U(31))


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """A number for every word of all texts in turn, and how many words each text has."""
    coded = [(t or "").encode().translate(WORD_BYTES) for t in texts]
    line = np.frombuffer(b" ".join(coded) + b" ", np.uint8)
    inside = line != 0x20
    edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, ends = edge[::2], edge[1::2]
    text_ends = np.cumsum([len(c) + 1 for c in coded])
    upto = np.searchsorted(starts, text_ends)
    counts = np.diff(upto, prepend=0)
    if not len(starts):
        return np.empty(0, _U), counts
    sizes = ends - starts
    power = np.ones(int(sizes.max()), _U)
    np.multiply.accumulate(np.full(len(power) - 1, _BASE), out=power[1:])
    letters = line[inside].astype(_U) + _U(1)
    first = np.cumsum(sizes) - sizes
    place = np.arange(len(letters)) - np.repeat(first, sizes)
    return mix(np.add.reduceat(letters * power[place], first)), counts


def shingles(texts: list[str | None], size: int = SHINGLE
             ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The multisets of all texts: (text, shingle, count), sorted by text and shingle."""
    words, counts = word_hashes(texts)
    begins = np.cumsum(counts) - counts
    runs = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    text = np.repeat(np.arange(len(texts)), runs)
    at = np.arange(len(text)) - np.repeat(np.cumsum(runs) - runs, runs) + begins[text]
    long = np.minimum(counts, size)[text]
    value = long.astype(_U)
    for i in range(size):
        step = mix(value * _GOLD + words[np.minimum(at + i, max(len(words) - 1, 0))])
        value = np.where(i < long, step, value)
    order = np.lexsort((value, text))
    text, value = text[order], value[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (value[1:] != value[:-1])
    first = np.flatnonzero(new)
    return text[first], value[first], np.diff(np.append(first, len(text)))


def signatures(text: np.ndarray, shingle: np.ndarray, count: np.ndarray, n: int,
               m: int = REGISTERS) -> np.ndarray:
    """[n, m] registers; a text without shingles has ``_NEVER`` throughout. A register
    holds the leading bits of its earliest time and, below, bits that name the point."""
    out = np.full((n, m), _NEVER)
    weight = np.bincount(text, weights=count, minlength=n)
    todo = np.flatnonzero(weight)
    margin = 6.0
    while len(todo):
        limit = np.zeros(n)
        limit[todo] = m / weight[todo] * (np.log(m) + margin)
        own = np.isin(text, todo) if len(todo) < n else slice(None)
        out[todo] = _NEVER
        _draw(text[own], shingle[own], count[own], limit, out, m)
        todo = todo[(out[todo] == _NEVER).any(axis=1)]
        margin *= 2
    return out


def _draw(text, shingle, count, limit, out, m) -> None:
    """Draws all points up to each text's limit into the registers."""
    flat = out.reshape(-1)
    low, level = 0, 0
    while len(text):
        width = max(low, 1)  # the levels (low, low + width]
        seed = mix(shingle + _U(int(_GOLD) * (level + 1) % 2**64))
        t, who, cover = np.zeros(len(text)), text, count - low
        drawn, block = 0, 1
        while len(who):
            j = (np.arange(drawn, drawn + block) + 1).astype(_U)
            bits = mix(seed[:, None] + j * _GOLD)
            gap = -np.log((bits >> _U(11)).astype(float) * 2.0 ** -53 + 2.0 ** -54) / width
            gap[:, 0] += t
            times = np.cumsum(gap, axis=1)
            early = times <= limit[who][:, None]
            use = early
            more = mix(bits)
            if width > 1:
                # successive halvings of the interval are the bits of a number below width
                use = early & ((more >> _U(40)) % _U(width) < cover[:, None].astype(_U))
            rows, cols = np.nonzero(use)
            named = more[rows, cols]
            register = (named & _U(0xFFFF)) % _U(m)
            value = (times[rows, cols].view(_U) & ~_U(0xFFFFFF)) | (
                (named >> _U(16)) & _U(0xFFFFFF))
            np.minimum.at(flat, who[rows] * m + register.astype(np.int64), value)
            going = early[:, -1]
            t, who, seed, cover = times[going, -1], who[going], seed[going], cover[going]
            drawn, block = drawn + block, min(2 * block, 256)
        low, level = low + width, level + 1
        higher = count > low
        text, shingle, count = text[higher], shingle[higher], count[higher]


def band_keys(registers: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """[n, bands] bucket keys."""
    n, m = registers.shape
    grouped = registers.reshape(n, bands, m // bands)
    key = np.broadcast_to(np.arange(bands).astype(_U), (n, bands))
    for i in range(m // bands):
        key = mix(key * _GOLD + grouped[:, :, i])
    return key.view(np.int64)


def similarities(left: list[str | None], right: list[str | None],
                 size: int = SHINGLE) -> np.ndarray:
    """Weighted Jaccard similarity of each pair of texts; 0 if neither has words."""
    n = len(left)
    pair, value, count = shingles([*left, *right], size)
    pair = pair % n if n else pair
    order = np.lexsort((value, pair))
    pair, value, count = pair[order], value[order], count[order]
    both = np.flatnonzero((pair[1:] == pair[:-1]) & (value[1:] == value[:-1]))
    smaller = np.bincount(pair[both], np.minimum(count[both], count[both + 1]), minlength=n)
    total = np.bincount(pair, count, minlength=n)
    return smaller / np.maximum(total - smaller, 1)


def sketches(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, content, keys) for every row; content names the text (null: null)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text", 1 << 20):
            texts = batch.column(2).to_pylist()
            keys = band_keys(signatures(*shingles(texts), len(texts)))
            worded = np.zeros(len(texts), bool)
            worded[shingles_present(texts)] = True
            ends = np.concatenate([[0], np.cumsum(np.where(worded, BANDS, 0))])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()),
                                          pa.array(keys[worded].ravel(), pa.int64()))],
                ["doc_id", "content", "keys"])

    source = df.select(F.col(doc_id).alias("doc_id"), F.md5(F.col(text)).alias("content"),
                       F.col(text).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, content string, keys array<long>")


def shingles_present(texts: list[str | None]) -> list[int]:
    return [i for i, t in enumerate(texts) if t and t.encode().translate(WORD_BYTES).strip()]


def verified(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) of nodes whose texts are similar enough."""
    one = texts.withColumnsRenamed({"node": "a", "text": "left"})
    two = texts.withColumnsRenamed({"node": "b", "text": "right"})
    rows = pairs.join(one, "a").join(two, "b").select("a", "b", "left", "right")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(chunks(batches, "left", 1 << 20), "right", 1 << 20):
            score = similarities(batch.column(2).to_pylist(), batch.column(3).to_pylist())
            found = pa.array(score >= similarity)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(found), batch.column(1).filter(found)], ["a", "b"])

    return rows.mapInArrow(run, "a long, b long")


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
            similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, content, root, class_id, class_size) for every row: class_id is the smallest
    doc_id of its class, class_size the number of its rows; root numbers the class (null for
    null texts)."""
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    rows = stored(sketches(docs), "sketches")
    # every different text gets a number, which stands once the table is written
    nodes = stored(rows.filter(F.col("content").isNotNull()).groupBy("content").agg(
        F.first("keys").alias("keys")).withColumn("node", F.monotonically_increasing_id()), "nodes")
    places = nodes.select(F.explode("keys").alias("key"), "node")
    buckets = (places.groupBy("key").agg(F.min("node").alias("b"), F.max("node").alias("c"))
               .filter(F.col("b") != F.col("c")).drop("c"))
    full = stored(places.join(buckets, "key"), "full")  # buckets of two texts at least
    first = full.filter(F.col("node") != F.col("b")).select(F.col("node").alias("a"), "b").distinct()
    asked = nodes.select("content", "node").join(full.select("node").distinct(), "node")
    texts = stored(docs.withColumn("content", F.md5("text")).join(asked, "content")
                   .groupBy("content", "node").agg(F.first("text").alias("text"))
                   .drop("content"), "texts")
    links = verified(first, texts, similarity)
    stars = stored(components(links, "a", "b"), "stars")
    more = stored(_links_across(full, stars, texts, similarity), "links")
    named = nodes.select("content", "node").join(stars, "node", "left").select(
        "content", F.coalesce("root", "node").alias("root"))
    if not more.isEmpty():
        named = named.join(_joined(more, stars), "root", "left").select(
            "content", F.coalesce("whole", "root").alias("root"))
    return _with_classes(rows, named)


def _joined(links: DataFrame, stars: DataFrame) -> DataFrame:
    """(root, whole) for the components that further links make part of a larger one."""
    for end in ("a", "b"):
        links = links.join(stars.toDF(end, "root"), end, "left").withColumn(
            end, F.coalesce("root", end)).drop("root")
    return components(links, "a", "b").toDF("root", "whole")


def overlaps(texts: list[str | None], size: int = SHINGLE) -> np.ndarray:
    """[n, n] similarities of all pairs. The k-th copy of a shingle counts as a shingle of
    its own, so that multisets become sets and overlaps products of 0/1 matrices."""
    n = len(texts)
    text, value, count = shingles(texts, size)
    copy = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    text, value = np.repeat(text, count), mix(np.repeat(value, count) + copy.astype(_U) * _GOLD)
    total = np.bincount(text, minlength=n)
    _, column, times = np.unique(value, return_inverse=True, return_counts=True)
    shared = times > 1
    number = np.cumsum(shared) - 1
    use = shared[column]
    text, column = text[use], number[column[use]]
    order = np.argsort(column, kind="stable")
    text, column = text[order], column[order]
    both = np.zeros((n, n), np.float32)
    for low in range(0, int(shared.sum()), 4096):
        a, b = np.searchsorted(column, [low, low + 4096])
        part = np.zeros((n, 4096), np.float32)
        part[text[a:b], column[a:b] - low] = 1
        both += part @ part.T
    return both / np.maximum(total[:, None] + total[None, :] - both, 1)


def _links_across(full: DataFrame, roots: DataFrame, texts: DataFrame,
                  similarity: float) -> DataFrame:
    """Links between texts that share a bucket and lie in different components. Buckets
    with several components fall into clusters, by the texts they share; all pairs of a
    cluster are compared, a pair of blocks at a time. Of what is linked inside such a pair
    of blocks only the smallest text is reported to each, which says the same."""
    labelled = (full.join(roots, "node", "left")
                .select("key", "node", F.coalesce("root", "node").alias("root")))
    split = (labelled.groupBy("key").agg(F.min("root").alias("x"), F.max("root").alias("y"),
                                         F.min("node").alias("b"))
             .filter(F.col("x") != F.col("y")).select("key", "b"))
    mixed = labelled.join(split, "key").select("node", "b")
    size = texts.select("node", F.octet_length("text").alias("size"))
    clusters = stored(components(mixed, "node", "b").toDF("node", "cluster").join(size, "node"),
                      "clusters")
    sizes = clusters.groupBy("cluster").agg(F.greatest(
        F.ceil(F.count(F.lit(1)) / BLOCK),
        F.ceil(F.sum("size") / BLOCK_BYTES)).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    members = (clusters.join(sizes, "cluster").select(
        "cluster", "node", own.alias("own"),
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
        .select("cluster", "node", F.least("own", "other").alias("i"),
                F.greatest("own", "other").alias("j")))

    def run(rows: pa.Table) -> pa.Table:
        names = rows.column("node").to_numpy()
        order = np.argsort(names)
        names = names[order]
        found = overlaps([rows.column("text")[int(i)].as_py() for i in order])
        linked = found >= similarity
        np.fill_diagonal(linked, True)
        least = np.arange(len(names))
        while True:
            new = np.where(linked, least[None, :], len(names)).min(axis=1)
            if (new == least).all():
                break
            least = new
        at = np.flatnonzero(least != np.arange(len(names)))
        return pa.table({"a": pa.array(names[at], pa.int64()),
                         "b": pa.array(names[least[at]], pa.int64())})

    return (members.join(texts, "node").select("cluster", "i", "j", "node", "text")
            .groupBy("cluster", "i", "j").applyInArrow(run, "a long, b long"))


def _with_classes(rows: DataFrame, roots: DataFrame) -> DataFrame:
    named = rows.select("doc_id", "content").join(roots, "content", "left")
    sizes = named.filter(F.col("root").isNotNull()).groupBy("root").agg(
        F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("size"))
    return named.join(sizes, "root", "left").select(
        "doc_id", "content", "root",
        F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("class_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("class_size"))


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of every class: that of its smallest doc_id."""
    kept = (classes(docs).filter(F.col("doc_id").eqNullSafe(F.col("class_id")))
            .filter(F.col("root").isNotNull()).groupBy("root").agg(
                F.min(F.struct("doc_id", "content")).alias("x")).select("x.*"))
    content = F.md5(docs["text"])
    worded = docs.join(kept, docs["doc_id"].eqNullSafe(kept["doc_id"])
                       & (content == kept["content"]), "left_semi")
    worded = worded.dropDuplicates(["doc_id", "text"])
    return worded.union(docs.filter(F.col("text").isNull()))


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of every document."""
    return classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "class_size")
