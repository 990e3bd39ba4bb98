"""Phrase collocations by prefix-free parsing.

Texts are cut at sentence marks into pieces of words. In a piece, every window of ``WINDOW``
words whose hash is a multiple of ``MODULUS`` triggers: a chunk ends with it and the next one
begins with it, so neighbouring chunks overlap by the window, and equal passages fall into equal
chunks wherever they stand. The dictionary holds the distinct chunks of each language with
the number of times they were parsed. Phrases are counted inside distinct chunks only,
weighted by that number. As a phrase has at most ``WINDOW + 1`` words, each occurrence lies
wholly in the chunk in which it starts; a start in the overlap counts for the later chunk
alone, the last chunk of a piece counts all its starts.

Words are counted while parsing, as every word is a start of one chunk. All parts of a phrase
that occurs often enough do so too. So pairs of frequent words are counted first, by their
hashes; then all phrases whose pairs may be frequent are counted by their words. What may be
frequent is looked up in a Bloom filter of 2 ** ``FILTER_BITS`` bits, of fixed size and without
false negatives, as pairs that share a hash are counted together: when it fills up, more phrases
are counted, the result stays the same.

Null texts count as empty, a null language as ``und``. Repeated rows count each. A table
without frequent phrases gives no rows. Other columns are not read. All arithmetic on counts
is done in integers or decimals of 38 digits.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import chunks, stored, table

LONGEST = 4
WINDOW = LONGEST - 1
MODULUS = 32
LEAST = 30  # occurrences of a candidate
COVERED = 80  # per cent of a phrase's occurrences inside a longer one
BEST = 2000
SCALE = 2_000_000
UNKNOWN = "und"
FILTER_BITS = 26  # 2 ** 26 bits are 8 MiB
# Text parsed at a time, and chunk bytes counted at a time.
PARSED, COUNTED = 4 << 20, 16 << 20

# A-Z to lower case, sentence marks and line ends to 0xFF, which no UTF-8 text holds.
_MARK = 0xFF
_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else
               _MARK if b in b".,;:!?" or 0x0A <= b <= 0x0D else b for b in range(256))
_MIX = tuple(np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


class Words(dict):
    """Numbers for words in the order they come."""

    def __init__(self):
        super().__init__()
        self.names: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self.names)
        self.names.append(word)
        return n


def word_hashes(names: list[bytes]) -> np.ndarray:
    crc = np.fromiter(map(zlib.crc32, names), np.uint64, len(names))
    size = np.fromiter(map(len, names), np.uint64, len(names))
    return mixed(crc + (size << np.uint64(32)), _MIX[0])


def mixed(x: np.ndarray, by: np.uint64) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * by
    return x ^ (x >> np.uint64(29))


def phrase_hashes(of_words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n words from each place on, as far as there are n."""
    size = max(len(of_words) - n + 1, 0)
    out = np.zeros(size, np.uint64)
    for k in range(n):
        out = mixed(out + of_words[k:k + size], _MIX[k % len(_MIX)])
    return out


def parse(texts: list[str]) -> tuple[Counter, Counter]:
    """How often each (chunk, last of its piece) was parsed, and how often each word stands in
    a chunk that counts it; words of a chunk are joined by single spaces."""
    line = b" \xff ".join([t.encode().translate(_BYTES).replace(b"\xff", b" \xff ")
                           for t in texts] + [b""]).split()
    names = Words()
    ids = np.fromiter(map(names.__getitem__, line), np.int64, len(line))
    mark = names.get(b"\xff", -1)
    hashes = phrase_hashes(word_hashes(names.names)[ids] if len(ids) else np.empty(0, np.uint64), WINDOW)
    trigger = np.flatnonzero(hashes % np.uint64(MODULUS) == 0)
    # the window must not reach over the end of its piece
    ends = np.append(np.flatnonzero(ids == mark), len(line))
    trigger = trigger[trigger + WINDOW <= ends[np.searchsorted(ends, trigger)]]
    starts = np.unique(np.concatenate([[0], ends[:-1] + 1, trigger])).astype(np.int64)
    piece_end = ends[np.searchsorted(ends, np.minimum(starts, len(line)))]
    following = np.append(starts[1:], len(line) + 1)
    last = following > piece_end
    stops = np.where(last, piece_end, following + WINDOW)
    some = stops > starts
    data = b" ".join(line)
    at = np.cumsum([0, *map(len, line)]) + np.arange(len(line) + 1)  # where words start
    chunks_of = Counter([(data[a:b], c) for a, b, c in zip(
        at[starts[some]].tolist(), (at[stops[some]] - 1).tolist(), last[some].tolist())])
    # every word is a start of one chunk
    words_of = Counter(dict(zip(names.names, np.bincount(ids, minlength=1).tolist())))
    del words_of[b"\xff"]
    return chunks_of, words_of


# What a row of the dictionary is: a chunk that another one follows, the last one of its
# piece, or a word.
INNER, LAST, WORD = 0, 1, 2


def dictionary(docs: DataFrame) -> DataFrame:
    """(lang, chunk, kind, freq): the distinct chunks of each language, and its words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text", PARSED):
            by: dict[str, list[str]] = {}
            for lang, text in zip(*(c.to_pylist() for c in batch.columns)):
                by.setdefault(lang, []).append(text)
            for lang, texts in by.items():
                found, words = parse(texts)
                names = [k[0] for k in found] + list(words)
                kinds = [LAST if k[1] else INNER for k in found] + [WORD] * len(words)
                yield pa.RecordBatch.from_arrays([
                    pa.array([lang] * len(names), pa.string()),
                    pa.array(names, pa.binary()).cast(pa.string()), pa.array(kinds, pa.int32()),
                    pa.array([*found.values(), *words.values()], pa.int64())],
                    ["lang", "chunk", "kind", "freq"])

    rows = docs.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"),
                       F.coalesce("text", F.lit("")).alias("text"))
    return (rows.mapInArrow(run, "lang string, chunk string, kind int, freq long")
            .groupBy("lang", "chunk", "kind").agg(F.sum("freq").alias("freq")))


def gathered(batches: Iterator[pa.RecordBatch], size: str) -> Iterator[pa.RecordBatch]:
    """Batches put together until the column ``size`` has about ``COUNTED`` bytes: the more
    chunks are counted at a time, the fewer rows leave the task."""
    held, n = [], 0
    for batch in chunks(batches, size, COUNTED):
        held.append(batch)
        n += batch.column(batch.schema.get_field_index(size)).nbytes
        if n >= COUNTED:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, n = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


class Line:
    """The words of several chunks in a row, with their language, weight and place."""

    def __init__(self, langs: pa.Array, texts: pa.Array, last: np.ndarray, freq: np.ndarray):
        # words of a chunk are joined by single spaces
        parts = pc.split_pattern(texts, " ")
        coded = parts.flatten().dictionary_encode()
        self.words = coded.dictionary
        self.ids = coded.indices.to_numpy().astype(np.int64)
        counts = pc.list_value_length(parts).to_numpy()
        row = np.repeat(np.arange(len(texts)), counts)
        coded = langs.dictionary_encode()
        self.langs = coded.dictionary
        self.lang = coded.indices.to_numpy()[row].astype(np.int64)
        self.weight = freq[row]
        self.left = np.cumsum(counts)[row] - np.arange(len(row))  # words from here to the chunk's end
        # starts in the overlap count for the next chunk
        self.own = last[row] | (self.left > WINDOW)
        crc = np.array([zlib.crc32(x.as_py().encode()) for x in self.langs], np.uint64)
        names = self.words.cast(pa.binary()).to_pylist()
        self.hashes = word_hashes(names)[self.ids] + mixed(crc, _MIX[2])[self.lang]

    def starts(self, n: int, frequent: np.ndarray | None, m: int) -> np.ndarray:
        """Where phrases of n words start that this line counts, and whose parts of m words
        may all be frequent."""
        at = np.flatnonzero(self.own & (self.left >= n))
        if frequent is not None and len(at):
            part = in_filter(frequent, phrase_hashes(self.hashes, m))
            for k in range(n - m + 1):
                at = at[part[at + k]]
        return at

    def hashed(self, n: int, at: np.ndarray) -> pa.RecordBatch:
        """(hash, f) of the phrases of n words that start at ``at``."""
        hashes = phrase_hashes(self.hashes, n)[at]
        order = np.argsort(hashes)
        hashes = hashes[order]
        first = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1])[:len(at)])
        weight = self.weight[at[order]]
        total = np.add.reduceat(weight, first) if len(at) else weight
        return pa.RecordBatch.from_arrays(
            [pa.array(hashes[first].view(np.int64)), pa.array(total)], ["hash", "f"])

    def counted(self, n: int, at: np.ndarray) -> pa.RecordBatch:
        """(lang, size, phrase, f) of the phrases of n words that start at ``at``."""
        hashes = phrase_hashes(self.hashes, n)[at]
        at = at[np.argsort(hashes, kind="stable")]
        # rows of one phrase now stand together; where two phrases share a hash, they may
        # alternate and give several rows, which are added up later like all others
        new = self.lang[at[1:]] != self.lang[at[:-1]]
        for k in range(n):
            new |= self.ids[at[1:] + k] != self.ids[at[:-1] + k]
        first = np.flatnonzero(np.append(True, new)[:len(at)])
        total = np.add.reduceat(self.weight[at], first) if len(at) else self.weight[:0]
        at = at[first]
        phrase = pc.binary_join_element_wise(
            *[self.words.take(pa.array(self.ids[at + k])) for k in range(n)], " ")
        return pa.RecordBatch.from_arrays(
            [self.langs.take(pa.array(self.lang[at])), pa.array(np.full(len(at), n, np.int32)),
             phrase, pa.array(total)], ["lang", "size", "phrase", "f"])


def in_filter(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether each hash may be in a filter; both of its bits must be set."""
    hit, mask = np.ones(len(hashes), bool), np.uint64(64 * len(bits) - 1)
    for shift in (0, 32):
        at = (hashes >> np.uint64(shift)) & mask
        hit &= (bits[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1
    return hit


def filter_of(hashes: DataFrame) -> Broadcast:
    """The Bloom filter of a column ``hash``, OR-ed together in Spark."""
    mask = F.lit((1 << FILTER_BITS) - 1)
    places = F.array(F.col("hash").bitwiseAND(mask),
                     F.shiftrightunsigned("hash", 32).bitwiseAND(mask))
    rows = (hashes.select(F.explode(places).alias("at")).groupBy(F.shiftright("at", 6).alias("word"))
            .agg(F.bit_or(F.expr("shiftleft(1L, CAST(at & 63 AS INT))")).alias("bits"))
            .select(F.col("word").cast("int").alias("word"), "bits").toArrow())
    bits = np.zeros(1 << FILTER_BITS - 6, np.uint64)  # at most 2 ** 20 rows of 12 bytes
    bits[rows.column("word").to_numpy()] = rows.column("bits").to_numpy().view(np.uint64)
    return hashes.sparkSession.sparkContext.broadcast(bits)


def hashes_of_words(words: DataFrame) -> DataFrame:
    """(hash) of every (lang, phrase) of one word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches, "phrase"):
            line = Line(batch.column(0), batch.column(1), np.ones(batch.num_rows, bool),
                        np.ones(batch.num_rows, np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(phrase_hashes(line.hashes, 1).view(np.int64))], ["hash"])

    return words.select("lang", "phrase").mapInArrow(run, "hash long")


def _each_line(parsed: DataFrame, run, schema: str) -> DataFrame:
    """``run(line)`` for the chunks of a dictionary, many in a line."""
    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches, "chunk"):
            yield from run(Line(batch.column(0), batch.column(1),
                                batch.column(2).to_numpy() == LAST, batch.column(3).to_numpy()))

    return (parsed.filter(F.col("kind") != WORD).select("lang", "chunk", "kind", "freq")
            .mapInArrow(lines, schema))


def hashes_of_pairs(parsed: DataFrame, words: DataFrame) -> DataFrame:
    """(hash) of the pairs that may occur often enough, given the words that do. Pairs are
    counted by their hashes alone; pairs that share one are counted together."""
    filtered = filter_of(hashes_of_words(words))

    def run(line: Line) -> Iterator[pa.RecordBatch]:
        yield line.hashed(2, line.starts(2, filtered.value, 1))

    return (_each_line(parsed, run, "hash long, f long").groupBy("hash")
            .agg(F.sum("f").alias("f")).filter(F.col("f") >= LEAST).select("hash"))


def phrases(parsed: DataFrame, pairs: DataFrame) -> DataFrame:
    """(lang, size, phrase, f) of the phrases of two words and more over a dictionary that occur
    often enough, given the hashes of all pairs that may."""
    filtered = filter_of(pairs)

    def run(line: Line) -> Iterator[pa.RecordBatch]:
        for n in range(2, LONGEST + 1):
            yield line.counted(n, line.starts(n, filtered.value, 2))

    return (_each_line(parsed, run, "lang string, size int, phrase string, f long")
            .groupBy("lang", "size", "phrase").agg(F.sum("f").alias("f"))
            .filter(F.col("f") >= LEAST))


def frequent_phrases(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(lang, size, phrase, f) of all phrases with ``LEAST`` occurrences, up to ``LONGEST``
    words; and (lang, n), the word occurrences of each language."""
    # sorted by kind, readers skip the pages of the others; a file per kind and task would start
    # three times the processes that local file systems need for a new file
    parsed = stored(dictionary(docs).sortWithinPartitions("kind"), "dictionary")
    words = parsed.filter(F.col("kind") == WORD).select(
        "lang", F.lit(1).alias("size"), F.col("chunk").alias("phrase"), F.col("freq").alias("f"))
    single = words.filter(F.col("f") >= LEAST)
    longer = stored(phrases(parsed, hashes_of_pairs(parsed, single)), "phrases")
    return (single.unionByName(longer),
            words.groupBy("lang").agg(F.sum("f").alias("n")))


def _big(c: str) -> Column:
    return F.col(c).cast("decimal(20,0)")


def _part(words: Column, start: Column, size: Column) -> Column:
    return F.array_join(F.slice(words, start, size), " ")


def scored(frequent: DataFrame) -> DataFrame:
    """(lang, size, phrase, a, l, r, score) of all candidates, at their lowest cut."""
    words = F.split("phrase", " ")
    cuts = (frequent.filter("size > 1").withColumnRenamed("f", "a")
            .select("*", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
            .withColumn("_l", _part(words, F.lit(1), F.col("k")))
            .withColumn("_r", _part(words, F.col("k") + 1, F.col("size") - F.col("k"))))
    # parts of a frequent phrase are frequent
    left = frequent.select("lang", F.col("phrase").alias("_l"), F.col("f").alias("l"))
    right = frequent.select("lang", F.col("phrase").alias("_r"), F.col("f").alias("r"))
    score = F.expr(f"(CAST({SCALE} AS DECIMAL(8,0)) * CAST(a AS DECIMAL(20,0))) "
                   "div (CAST(l AS DECIMAL(20,0)) + CAST(r AS DECIMAL(20,0)))")
    best = F.min(F.struct(score.alias("score"), "k", "l", "r"))
    return (cuts.join(left, ["lang", "_l"]).join(right, ["lang", "_r"])
            .groupBy("lang", "size", "phrase", "a").agg(best.alias("best"))
            .select("lang", "size", "phrase", "a", "best.l", "best.r", "best.score"))


def covered(frequent: DataFrame) -> DataFrame:
    """(lang, phrase, longer): the most occurrences of a longer candidate around a phrase."""
    words = F.split("phrase", " ")
    inner = F.expr("""flatten(transform(sequence(2, size - 1),
        m -> transform(sequence(1, size - m + 1), s -> array_join(slice(_words, s, m), ' '))))""")
    return (frequent.filter("size > 2").withColumn("_words", words)
            .select("lang", F.explode(inner).alias("phrase"), F.col("f").alias("longer"))
            .groupBy("lang", "phrase").agg(F.max("longer").alias("longer")))


def collocations(docs: DataFrame) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best phrases of each language."""
    frequent, totals = frequent_phrases(docs)
    kept = (scored(frequent).join(covered(frequent), ["lang", "phrase"], "left")
            .filter(F.coalesce(F.lit(100) * _big("longer") < F.lit(COVERED) * _big("a"),
                               F.lit(True))))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    top = kept.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= BEST)
    return top.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best phrases of each language over all whole texts."""
    return collocations(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
lines AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS s FROM lines),
phrases AS (SELECT lang, m AS size, array_to_string(w[s:s + m - 1], ' ') AS phrase
  FROM starts, (VALUES (1), (2), (3), (4)) AS sizes(m) WHERE s + m - 1 <= len(w)),
counts AS (SELECT lang, size, phrase, count(*) AS f FROM phrases GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE size = 1 GROUP BY lang),
often AS (SELECT *, string_split(phrase, ' ') AS w FROM counts WHERE f >= 30),
cuts AS (SELECT c.lang, c.size, c.phrase, c.f AS a, k, l.f AS l, r.f AS r,
    (2000000::HUGEINT * c.f) // (l.f + r.f) AS score
  FROM often c, (VALUES (1), (2), (3)) AS ks(k), often l, often r
  WHERE k < c.size AND l.lang = c.lang AND r.lang = c.lang
    AND l.phrase = array_to_string(c.w[1:k], ' ')
    AND r.phrase = array_to_string(c.w[k + 1:], ' ')),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (
  PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_phrases AS (SELECT lang, array_to_string(w[s:s + m - 1], ' ') AS phrase, f
  FROM often, (VALUES (2), (3)) AS sizes(m), (VALUES (1), (2), (3)) AS places(s)
  WHERE m < size AND s + m - 1 <= size),
around AS (SELECT lang, phrase, max(f) AS longer FROM inner_phrases GROUP BY ALL),
ranked AS (SELECT b.*, row_number() OVER (
    PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank
  FROM best b LEFT JOIN around USING (lang, phrase)
  WHERE longer IS NULL OR 100::HUGEINT * longer < 80::HUGEINT * a)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
