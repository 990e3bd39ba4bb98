"""Collocations against counting by hand, and against the SQL twin on whole tables."""

import random
from collections import Counter

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import collocations as co


def plain_pieces(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for mark in ".,;:!?\n\x0b\x0c\r":
        low = low.replace(mark, "\n")
    for piece in low.split("\n"):
        yield [w for w in piece.replace("\t", " ").split(" ") if w]


def plain_counts(texts):
    found = Counter()
    for text in texts:
        for w in plain_pieces(text):
            found.update(tuple(w[s:s + m]) for m in range(1, 5) for s in range(len(w) - m + 1))
    return found


def plain(rows):
    out = []
    for lang in {x or "und" for x, _ in rows}:
        f = plain_counts([t for x, t in rows if (x or "und") == lang])
        n = sum(c for p, c in f.items() if len(p) == 1)
        often = {p: c for p, c in f.items() if c >= 30 and len(p) > 1}
        found = []
        for p, a in often.items():
            score, k = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            inside = any(len(q) > len(p) and 100 * c >= 80 * a and any(
                q[s:s + len(p)] == p for s in range(len(q))) for q, c in often.items())
            if not inside:
                found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:co.BEST], start=1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n, -score))
    return sorted(out)


words = st.lists(st.sampled_from(["a", "b", "B", "é", "a.b", "x\ty", ",", "\n", "\x1c", "\x85", "\xa0"]),
                 max_size=60)


@given(st.lists(words, max_size=4), st.sampled_from([1, 2, 5]))
@settings(max_examples=150, deadline=None)
def test_chunks_hold_every_phrase_once(rows, modulus):
    texts = [" ".join(r) for r in rows]
    before, co.MODULUS = co.MODULUS, modulus
    try:
        parsed, words_of = co.parse(texts)
    finally:
        co.MODULUS = before
    found = Counter()
    for (chunk, last), times in parsed.items():
        w = chunk.decode().split(" ")
        for s in range(len(w) if last else len(w) - co.WINDOW):
            for m in range(1, min(4, len(w) - s) + 1):
                found[tuple(w[s:s + m])] += times
    assert found == plain_counts(texts)
    assert {(w.decode(),): n for w, n in words_of.items()} == {
        p: n for p, n in found.items() if len(p) == 1}


def test_equal_passages_fall_into_equal_chunks():
    rng = random.Random(4)
    passage = " ".join(rng.choice("abcdefgh") * rng.randint(1, 4) for _ in range(400))
    one, two = (co.parse([f"{lead} {passage} {tail}"])[0] for lead, tail in
                (("the first", "ends so"), ("and quite another one", "with other words")))
    assert sum((one & two).values()) >= 0.5 * sum(one.values()) > 3


def rows_of_words():
    rng = random.Random(7)
    vocabulary = ["new", "york", "city", "hall", "is", "the", "Öl", "x1", "a"]
    rows = [(rng.choice(["en", "en", "de", None]),
             " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 60)))
             + rng.choice(["", ".", "!\n", ";\r"])) for _ in range(900)]
    rows += [("en", "New York city hall, New York City hall")] * 40 + [("en", None), (None, None), ("fr", "")]
    return rows + [("es", "tie one. tie two. " * 31), ("de", "again " * 5000)]


def test_against_counting(spark, monkeypatch):
    monkeypatch.setattr(co, "COUNTED", 3000)
    rows = [(n, lang, text, "clash") for n, (lang, text) in enumerate(rows_of_words())]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string, chunk string")
    found = co.collocations(docs.repartition(3))
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = plain(rows_of_words())
    assert sorted(map(tuple, found.collect())) == want and len(want) > 40


def test_top_list_ends_and_a_full_filter_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(co, "BEST", 5)
    monkeypatch.setattr(co, "FILTER_BITS", 6)
    docs = spark.createDataFrame(rows_of_words(), "lang string, text string")
    assert sorted(map(tuple, co.collocations(docs).collect())) == plain(rows_of_words())


def test_counts_beyond_64_bits(spark):
    big = 2**62
    rows = [("en", 1, "a", big), ("en", 1, "b", big), ("en", 2, "a b", big - 1)]
    frequent = spark.createDataFrame(rows, "lang string, size int, phrase string, f long")
    assert co.scored(frequent).first()["score"] == 2000000 * (big - 1) // (2 * big)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_twin(spark, sf):
    at = f"/root/testdata/{sf}"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS FROM '{at}/documents.parquet'")
    want = con.execute(co.ORACLE).fetchall()
    found = co.op13_collocations(spark, at)
    assert dict(found.dtypes) == {c: "string" if c in ("lang", "phrase") else "bigint"
                                  for c in found.columns}
    assert sorted(map(tuple, found.collect())) == sorted(want) and want


def test_empty_table(spark):
    docs = spark.createDataFrame([], "lang string, text string")
    assert co.collocations(docs).collect() == []


def test_a_task_writes_one_file_of_the_dictionary(spark, monkeypatch):
    written = []

    def stored(df, name, *parts):
        out = own(df, name, *parts)
        written.append((name, df.rdd.getNumPartitions(), len(out.inputFiles())))
        return out

    own = co.stored
    monkeypatch.setattr(co, "stored", stored)
    docs = spark.createDataFrame([(lang, text) for lang, text in rows_of_words()], "lang string, text string")
    frequent, _ = co.frequent_phrases(docs)
    assert frequent.filter("size > 1").count()
    [(tasks, files)] = [x[1:] for x in written if x[0] == "dictionary"]
    assert files <= tasks
