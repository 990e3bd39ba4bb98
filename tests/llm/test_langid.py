"""Language scores against a naive Bayes over dictionaries, and the memory they take."""

import math
import tracemalloc
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import langid


def plain_buckets(text):
    """One bucket per n-gram, by the hash written out."""
    line, out = [0, 0, *map(ord, text.lower()), 0, 0], Counter()
    for i in range(len(line) - 2):
        mixed = 0
        for k, mix in enumerate(langid._MIX):
            mixed = ((mixed ^ (mixed >> 15)) + (line[i + k] + k + 1) * mix) % 2**32
            out[(mixed * langid._MIX[0] % 2**32) >> (32 - langid.BITS)] += 1
    return out


def plain_model(rows):
    counts, texts = {}, Counter()
    for text, lang in rows:
        counts.setdefault(lang, Counter()).update(plain_buckets(text))
        texts[lang] += 1

    def score(text):
        logs = {}
        for lang, own in counts.items():
            whole = sum(own.values()) + langid.SMOOTHING * 2**langid.BITS
            logs[lang] = math.log(texts[lang] / len(rows)) + sum(
                n * math.log((own[b] + langid.SMOOTHING) / whole)
                for b, n in plain_buckets(text).items())
        most = max(logs.values())
        best = min(x for x in logs if logs[x] == most)
        return best, 1 / sum(math.exp(v - most) for v in logs.values())
    return score


ROWS = [("the cat and the hat", "en"), ("with all of them there", "en"), ("der Hund und die Katze", "de"),
        ("Straße über Öl", "de"), ("el perro y la casa", "es"), ("x" * 50, "es"), ("İstanbul ǅ", "tr")]


def test_against_dictionaries(spark):
    model = langid.train(spark.createDataFrame([*ROWS, (None, "en"), ("a", None)], "text string, lang string"))
    plain = plain_model(ROWS)
    texts = ["the dog", "die Straße", "la casa y el perro", "zzz", "İ", "", None, "123", "cat " * 900]
    pred, score = model.predict(texts)
    for text, p, s in zip(texts, pred, score):
        if langid.has_letter(text):
            best, share = plain(text)
            assert p == best and math.isclose(s, share, rel_tol=1e-3)  # the matrix has 32 bits
        else:
            assert (p, s) == ("und", 0.0)


def test_ties_go_to_the_first_language(spark):
    rows = [("same words", "b"), ("same words", "a"), ("same words", "c")]
    model = langid.train(spark.createDataFrame(rows, "text string, lang string"))
    assert model.predict(["same"]) == (["a"], [1 / 3])


@given(st.lists(st.text(max_size=30), max_size=5), st.sampled_from([1, 2, 7, 1000]))
@settings(max_examples=100, deadline=None)
def test_slices_hold_every_ngram_once(texts, places):
    before, langid.PLACES = langid.PLACES, places
    try:
        found = [Counter() for _ in texts]
        for text, grams in langid.ngrams(texts):
            for t, column in zip(text.tolist(), grams.T.tolist()):
                found[t].update(column)
    finally:
        langid.PLACES = before
    assert found == [plain_buckets(t) for t in texts]


def test_memory_does_not_follow_the_text():
    model = langid.Model(("a", "b", "c", "d"), np.zeros((1 << langid.BITS, 4), np.float32), np.zeros(4))
    text = "some words of any kind " * 180_000  # 4.1 MB
    tracemalloc.start()
    model.predict([text])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 12 * len(text)
