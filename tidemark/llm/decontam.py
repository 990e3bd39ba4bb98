"""Benchmark decontamination over a positional inverted index, with DataFrame operations only.

Every window of ten consecutive item words (an item of fewer words is one window) hangs on
its rarest term, counted over the whole corpus. The index holds a posting for each place of
such a term in the documents: row, place, and the nine words on either side. A window's
remaining terms must stand at their offsets from the rarest one, which intersecting their
lists would tell; the posting's own neighbourhood tells it without a further list. A place
whose words agree with the item's over a run of at least one window is a hit, over all of
the run. Windows share rarest terms, so an item has far fewer terms in the index than
words.

The terms to look up are broadcast while they are small (their bytes are measured), and
joined by shuffle otherwise. Postings of one term are spread over the tasks that read the
documents; nothing gathers them.

Null texts have no words, items without words have no windows. Items that share an id
count once; null ids count for hits and are not listed. Repeated document rows get equal
results. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_lower, row_hash, stored, table, words

WINDOW = 10
# What stands between words while capitals are still there.
ANY_GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
# Tables up to this many bytes of words are sent to every executor.
BROADCAST_BYTES = 16 << 20


def token_table(docs: DataFrame) -> DataFrame:
    """(doc_id, h, words, n_words): the documents as words, not yet lower-cased. Stored, as
    counting terms, finding postings and the word counts all start from it."""
    parts = F.array_remove(F.split(F.coalesce(F.col("text"), F.lit("")), ANY_GAP), "")
    return stored(docs.select(
        "doc_id", row_hash(F.col("doc_id"), F.col("text")).alias("h"), parts.alias("words"))
        .withColumn("n_words", F.size("words").cast("long")), "words")


def lowered(word: Column) -> Column:
    """A-Z lower-cased, in words: all-ASCII ones, nearly all, need no character table."""
    return (F.when(F.octet_length(word) == F.char_length(word), F.lower(word))
            .when(word.rlike("[A-Z]"), ascii_lower(word)).otherwise(word))


def _sent_if_small(df: DataFrame, size: Column) -> DataFrame:
    total = df.agg(F.sum(size).alias("n")).first()["n"] or 0
    return F.broadcast(df) if total <= BROADCAST_BYTES else df


def _tokens(items: DataFrame) -> DataFrame:
    """(item_key, item_id, words, p, term); one item_key per distinct (id, text)."""
    rows = items.select(
        row_hash(F.col("item_id"), F.col("text")).alias("item_key"), "item_id",
        words(F.col("text")).alias("words")).dropDuplicates(["item_key", "item_id"])
    return rows.select("*", F.posexplode("words").alias("p", "term"))


def rarest_terms(tokens: DataFrame, counts: DataFrame, window: int) -> DataFrame:
    """(term, item_id, n, before, after): the places of items that are the rarest of some
    window, with the item's words around them (``before`` runs backwards)."""
    by_item = Window.partitionBy("item_key", "item_id").orderBy("p")
    ranked = (tokens.join(counts, "term", "left")
              .withColumn("n", F.size("words"))
              .withColumn("rank", F.struct(F.coalesce("df", F.lit(0)).alias("df"), "p"))
              .withColumn("least", F.min("rank").over(by_item.rowsBetween(0, window - 1))))
    chosen = (ranked.filter(F.col("p") <= F.greatest(F.lit(0), F.col("n") - window))
              .select("item_key", "item_id", "words", "n", F.col("least.p").alias("p"),
                      F.col("least.df").alias("df"))
              # a window with a term that no document has occurs nowhere
              .filter(F.col("df") > 0).drop("df").dropDuplicates(["item_key", "item_id", "p"]))
    return chosen.select(
        F.element_at("words", F.col("p") + 1).alias("term"), "item_id", "n",
        *_around(F.col("words"), F.col("p"), window))


def _around(words: Column, p: Column, window: int) -> list[Column]:
    first = F.greatest(F.lit(0), p - (window - 1))
    return [F.reverse(F.slice(words, first + 1, p - first)).alias("before"),
            F.slice(words, p + 2, F.lit(window - 1)).alias("after")]


def _agree(a: Column, b: Column) -> Column:
    """How many words two arrays have in common at their beginnings."""
    same = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)))
    first = F.array_position(same, False)
    return F.when(first == 0, F.size(same)).otherwise(first - 1).cast("int")


def term_counts(index: DataFrame, tokens: DataFrame) -> DataFrame:
    """How often each word of the items stands in the corpus."""
    asked = stored(tokens.select("term").distinct(), "terms")
    asked = _sent_if_small(asked, F.octet_length("term") + 32)
    places = index.select(F.explode("words").alias("word"))
    return (places.select(lowered(F.col("word")).alias("term")).join(asked, "term")
            .groupBy("term").agg(F.count(F.lit(1)).alias("df")))


def postings(index: DataFrame, terms: DataFrame, window: int = WINDOW) -> DataFrame:
    """The index restricted to ``terms`` and joined with them: (doc_id, h, q, doc_before,
    doc_after) beside the columns of ``terms``. Stored before anything is compared: up to
    here every step is compiled code that passes a document's words on by reference."""
    places = index.select("doc_id", "h", "words", F.posexplode("words").alias("q", "word"))
    around = [c.alias(f"raw_{n}") for c, n in
              zip(_around(F.col("words"), F.col("q"), window), ("before", "after"))]
    found = stored(places.withColumn("term", lowered(F.col("word"))).join(terms, "term")
                   .select("doc_id", "h", "q", *terms.columns, *around), "postings")
    return found.select("doc_id", "h", "q", *terms.columns, *[
        F.transform(f"raw_{n}", lowered).alias(f"doc_{n}") for n in ("before", "after")])


def exact_matches(index: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, h, item_id, first, last): runs of document words that agree with an item
    over at least one window; words from 0, both ends included. Runs may overlap."""
    terms = _terms(index, items, window)
    found = postings(index, terms, window).select(
        "doc_id", "h", "item_id", "q", "n",
        _agree(F.col("doc_before"), F.col("before")).alias("l"),
        _agree(F.col("doc_after"), F.col("after")).alias("r"))
    return (found.filter(F.col("l") + F.col("r") + 1 >= F.least(F.lit(window), F.col("n")))
            .select("doc_id", "h", "item_id", (F.col("q") - F.col("l")).alias("first"),
                    (F.col("q") + F.col("r")).alias("last")).distinct())


def near_matches(index: DataFrame, items: DataFrame, window: int = WINDOW,
                 missing: int = 2) -> DataFrame:
    """(doc_id, h, item_id, n_near): places where a window's rarest term stands and all but
    ``missing`` of the different words around it in the item stand around it in the
    document too, in any order, as far as ``window - 1`` words to either side."""
    terms = _terms(index, items, window)
    around = F.array_distinct(F.concat("before", "after"))
    there = F.array_intersect(around, F.concat("doc_before", "doc_after"))
    return (postings(index, terms, window)
            .filter(F.size(there) >= F.greatest(F.lit(1), F.size(around) - missing))
            .groupBy("doc_id", "h", "item_id").agg(F.count(F.lit(1)).alias("n_near")))


def _terms(index: DataFrame, items: DataFrame, window: int) -> DataFrame:
    tokens = stored(_tokens(items), "tokens")
    terms = stored(rarest_terms(tokens, term_counts(index, tokens), window), "rarest")
    size = F.octet_length(F.concat_ws(" ", "term", F.concat("before", "after"))) + 256
    return _sent_if_small(terms, size)


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) for every document row."""
    index = token_table(docs)
    hits = stored(exact_matches(index, items, window), "hits")
    # how far each run reaches beyond those that begin before it; one document at a time
    earlier = Window.partitionBy("doc_id", "h").orderBy("first", "last").rowsBetween(
        Window.unboundedPreceding, -1)
    reach = F.coalesce(F.max("last").over(earlier), F.lit(-1))
    covered = (hits.select("doc_id", "h", "first", "last").distinct().withColumn("new", F.greatest(
        F.lit(0), F.col("last") - F.greatest(reach, F.col("first") - 1)))
        .groupBy("doc_id", "h").agg(F.sum("new").alias("n_hit")))
    named = (hits.groupBy("doc_id", "h")
             .agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("ids")))
    by_row = covered.join(named, _same_row(covered, named)).select(
        covered["doc_id"], covered["h"], "n_hit", "ids")
    rows = index.select("doc_id", "h", "n_words")
    ids = F.coalesce("ids", F.array().cast("array<string>"))
    return rows.join(by_row, _same_row(rows, by_row), "left").select(
        rows["doc_id"], "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", ids), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"))


def keep_clean(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` without the rows that hold a window of an item."""
    hits = stored(exact_matches(token_table(docs), items, window)
                  .select("doc_id", "h").distinct(), "hits")
    h = row_hash(docs["doc_id"], docs["text"])
    return docs.join(hits, docs["doc_id"].eqNullSafe(hits["doc_id"]) & (h == hits["h"]),
                     "left_anti")


def _same_row(a: DataFrame, b: DataFrame) -> Column:
    return a["doc_id"].eqNullSafe(b["doc_id"]) & (a["h"] == b["h"])


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages in every whole text."""
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS rid, list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w FROM documents),
b AS (
  SELECT item_id, list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS k,
         array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS s
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(1, len(w) - 9))) AS i
        FROM b WHERE len(w) > 0)),
places AS (
  SELECT rid, i, k, array_to_string(w[i:i + k - 1], ' ') AS s
  FROM (SELECT rid, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i
        FROM d, (SELECT DISTINCT k FROM windows) WHERE len(w) >= k)),
hits AS (SELECT p.rid, p.i, x.k, x.item_id FROM places p JOIN windows x ON p.s = x.s AND p.k = x.k),
covered AS (
  SELECT rid, count(DISTINCT j) AS n_hit
  FROM (SELECT rid, unnest(generate_series(i, i + k - 1)) AS j FROM hits) GROUP BY 1),
named AS (
  SELECT rid, list_sort(list_distinct(list(CAST(item_id AS VARCHAR)))) AS ids FROM hits GROUP BY 1)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(c.n_hit, 0) AS n_hit,
       CAST(coalesce(len(n.ids), 0) AS BIGINT) AS n_items,
       sha256(coalesce(array_to_string(n.ids, ','), '')) AS items_sha256,
       coalesce(c.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered c USING (rid) LEFT JOIN named n USING (rid)
"""
