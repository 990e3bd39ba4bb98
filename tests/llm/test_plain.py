"""The numpy and Python parts against plain versions, without Spark."""

import base64
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers as public
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import ann, bagminhash, bpe, langid, licenses, pii, secrets, suffix_dedup, suffixes

SMALL = settings(max_examples=150, deadline=None)


def numbers(raw):
    return np.frombuffer(raw, "<u4").tolist()


# -- tokens -----------------------------------------------------------------------------
def reference_encoding():
    path = public.path("byte_bpe_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks,
                             special_tokens={})


CODEC, PLAIN = bpe.Codec(public.path(bpe.VOCABULARY)), reference_encoding()


@SMALL
@given(st.text(alphabet=st.sampled_from(" \n\t\r\x85\xa0　a.'sSé1½😀ſ\x1c"), max_size=40)
       | st.text(max_size=60))
def test_ids_are_those_of_a_plain_encoder_and_decode_to_the_text(text):
    text = text.encode("utf-8", "ignore").decode()
    raw = CODEC.encode(text)
    assert numbers(raw) == PLAIN.encode_ordinary(text)
    assert CODEC.decode(raw) == text.encode()
    ends = CODEC.byte_ends(np.frombuffer(raw, "<u4"))
    first, last = bpe.character_offsets(text.encode(), ends)
    begin = 0
    for a, b, end in zip(first, last, ends):
        assert text.encode()[begin:end] in text[a:b].encode()
        begin = end


def test_special_strings_are_text_and_long_words_work():
    for text in ("<|endoftext|> x", "a" * 20_000, "é" * 5_000):
        assert numbers(CODEC.encode(text)) == PLAIN.encode_ordinary(text)


# -- personal data ----------------------------------------------------------------------
def plain_base(text):
    out = [("email", *m.span()) for m in re.finditer(
        r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(
        r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
        if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        total = sum(int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10))
                    for i, d in enumerate(reversed(digits)))
        if 16 <= len(digits) <= 19 and total % 10 == 0:
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
            if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return out


@SMALL
@given(st.text(alphabet="ab.@%+-0123 ()\n_", max_size=60)
       | st.lists(st.sampled_from(["4111 1111 1111 1111", "1.2.3.4", "300.1.2.3", "a@b.c_d@e.f",
                                   "+1 (988) 555-2485", " ", ".", "5", "é", "4111111111111111"]),
                  max_size=8).map("".join))
def test_base_matches(text):
    assert sorted(pii.base_matches(text)[0]) == sorted(plain_base(text))


def test_the_classifier_follows_the_votes_and_base_spans_stay():
    good = pii.pattern_code("phone", (1, 1, 1, 1, 1), 3)
    bad = pii.pattern_code("phone", (-1, -1, -1, -1, -1), 3)
    model = pii.fit(np.array([good, bad]), np.array([50, 50]))
    chance = dict(zip((good, bad), model.probability(np.array([good, bad]))))
    assert chance[good] > 0.9 > 0.1 > chance[bad]
    rows = [("phone", 0, 9, bad, True), ("phone", 20, 29, bad, False),
            ("phone", 40, 49, good, False), ("phone", 5, 12, good, False)]
    assert pii.choose(rows, chance) == [("phone", 0, 9), ("phone", 40, 49)]
    assert pii.fit(np.empty(0, np.int64), np.empty(0)).weights.any() == 0
    assert pii.masked("call 12345 now", [("phone", 5, 10)]) == "call <PHONE> now"


# -- near duplicates --------------------------------------------------------------------
def multiset(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub(
        "[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return Counter()
    return Counter(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4)))


def plain_similarity(a, b):
    a, b = multiset(a), multiset(b)
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def test_similarities_of_multisets():
    random.seed(1)
    texts = [" ".join(random.choices(["a", "B", "é", "c1"], k=random.randint(0, 30)))
             for _ in range(25)] + [None, "", "!!", "A a a a a a a a"]
    left = [t for t in texts for _ in texts]
    found = bagminhash.similarities(left, texts * len(texts)).reshape(len(texts), -1)
    want = np.array([[plain_similarity(a, b) for b in texts] for a in texts])
    assert np.allclose(found, want)
    off = ~np.eye(len(texts), dtype=bool)
    assert np.allclose(bagminhash.overlaps(texts)[off], want[off])


def test_signatures_are_unbiased_for_counts():
    shares = []
    for n in range(200):
        shingle = bagminhash.mix(np.array([n, n + 10_000, n, n + 10_000], np.uint64))
        a, b = bagminhash.signatures(np.array([0, 0, 1, 1]), shingle, np.array([5, 20, 9, 13]), 2)
        shares.append((a == b).mean())
    assert abs(np.mean(shares) - (5 + 13) / (9 + 20)) < 0.02
    assert (bagminhash.signatures(np.empty(0, int), np.empty(0, np.uint64), np.empty(0, int), 1)
            == np.uint64(2 ** 64 - 1)).all()


# -- repeated strings -------------------------------------------------------------------
@SMALL
@given(st.lists(st.integers(1, 3), max_size=50))
def test_suffix_arrays(symbols):
    s = [*symbols, 0]
    want = sorted(range(len(s)), key=lambda i: s[i:])
    assert suffixes.suffix_array(np.array(s)).tolist() == want
    assert suffixes._doubled(np.array(s)).tolist() == want


@SMALL
@given(st.lists(st.binary(max_size=25).map(lambda b: bytes(x % 2 for x in b)), min_size=1,
                max_size=5), st.integers(1, 6))
def test_repeated_places(segments, width):
    count = Counter(s[i:i + width] for s in segments for i in range(len(s) - width + 1))
    assert [f.tolist() for f in suffixes.repeated(segments, width)] == [
        [count[s[i:i + width]] > 1 for i in range(len(s) - width + 1)] for s in segments]


def test_segments_cover_every_place_once_and_equal_strings_share_their_anchor():
    random.seed(2)
    data = [bytes(random.choices(b"abcd", k=n)) for n in (0, 199, 200, 700)] + [b"a" * 3000]
    data.append(data[3][100:500])
    seen, anchors = Counter(), {}
    for t, s, n, anchor, double in zip(*suffix_dedup.segments(data)):
        for i in range(s, s + n):
            seen[t, i] += 1
            assert anchors.setdefault(data[t][i:i + 200], anchor) == anchor
        assert double or t != 4
    assert seen == {(t, i): 1 for t, d in enumerate(data) for i in range(len(d) - 199)}


@pytest.mark.parametrize("level", range(1, suffix_dedup.LEVELS + 1))
def test_anchors_of_several_scramblings_do_the_same(level):
    random.seed(level)
    line = bytes(random.choices(b"abcdefgh", k=169))
    data = [bytes(random.choices(b"abcd", k=n)) for n in (199, 200, 2000)] + [b"a" * 3000, line * 4]
    data.append(b"x" + data[2][100:900] + b"y")
    seen, anchors, inside = Counter(), {}, Counter()
    for k, (t, s, n, anchor, double) in enumerate(zip(*suffix_dedup.segments(data, level))):
        for i in range(s, s + n):
            seen[t, i] += 1
            assert anchors.setdefault(data[t][i:i + 200], anchor) == anchor
            inside[k, data[t][i:i + 200]] += 1
            assert double or inside[k, data[t][i:i + 200]] == 1
    assert seen == {(t, i): 1 for t, d in enumerate(data) for i in range(len(d) - 199)}


# -- language, licenses, secrets, neighbours --------------------------------------------
def test_languages():
    assert langid.has_letter("1é") and not langid.has_letter("1 !") and not langid.has_letter(None)
    empty = langid.Model((), np.zeros((1 << langid.BITS, 0), np.float32), np.zeros(0))
    assert empty.predict(["abc", None]) == (["und", "und"], [0.0, 0.0])
    [(text, one)] = langid.ngrams(["abc", "", "é"])
    [(_, two)] = langid.ngrams(["abc"])
    assert (one[:, :two.shape[1]] == two).all() and text.tolist() == [0] * 5 + [1] * 2 + [2] * 3


def test_license_templates():
    scan = licenses.Scanner().scan
    words, base, first, last, base_labels, labels, score, accepted = scan(
        "Licensed under the Apache License, Version 2.0. MIT license, mit LICENSE")
    assert (words, base, first, last) == (12, 3, 3, 10)
    assert (base_labels, labels, score) == ("apache,mit", "apache,apache-2.0,mit", 1.0)
    assert accepted == [("apache-2.0", 0, 8)]
    assert scan(None) == (0, 0, None, None, "", "", 0.0, [])
    assert scan("cc by")[4:7] == ("cc-by", "cc-by", 0.5)
    own = licenses.compile_template("x", "a b [c {v:2} d] e")
    for text, end in (("a b e", 3), ("a b c d e", 5), ("a b c x y d e", 7), ("a b c x y z d e", None),
                      ("a b c e", None), ("a b", None)):
        assert own.longest(text.encode().split(), 0) == end


def test_trigram_queries_hold_for_every_match():
    for pattern, want in ((r"AKIA[A-Z0-9]+", [[{"aki", "kia"}]]), (r"[0-9a-f]{32,}", []),
                          (r"ab?cd", [[{"abc", "bcd"}, {"acd"}]]), (r"(foo|bars)x*", [[{"bar", "ars"}, {"foo"}]])):
        assert [[set(s) for s in g] for g in secrets.trigram_query(pattern)] == want


def test_neighbours_of_one_shard():
    rng = np.random.default_rng(4)
    points = rng.standard_normal((600, 8)).astype(np.float32)
    points[100:160] = points[7]
    ids = rng.permutation(600)
    shard = ann.Shard(ids, points, float(np.linalg.norm(points.astype(float), axis=1).max()), leaf=8)
    hits = 0
    for q in range(0, 600, 20):
        own = points[np.flatnonzero(ids == q)[0]].astype(float)
        score = np.cumsum(points.astype(float) * own, axis=1)[:, -1]
        want = sorted((-s, i) for s, i in zip(score.tolist(), ids.tolist()) if i != q)[:20]
        got = shard.search(q, own, 20)
        hits += len({i for i, _ in got} & {i for _, i in want})
    assert hits >= 0.95 * 20 * 30
    assert abs(ann.chi_square(ann.stop_ratio(16, 0.02), 16) - 0.98) < 1e-9


def test_rows_of_the_query_itself_take_no_place_from_others():
    rng = np.random.default_rng(5)
    base = rng.standard_normal((300, 8)).astype(np.float32)
    scale = np.float32(1 + np.arange(30) / 100)
    for own, others in ((np.repeat(base[7:8], 30, axis=0), [400, 401]),
                        (base[7] * 5 * scale[:, None], [])):
        points = np.concatenate([base, own, np.repeat(base[7:8], len(others), axis=0)])
        ids = np.array([*range(300), *[7] * 30, *others])
        greatest = float(np.linalg.norm(points.astype(float), axis=1).max())
        got = [i for i, _ in ann.Shard(ids, points, greatest, leaf=8).search(
            7, base[7].astype(float), 20)]
        assert len(got) == 20 and 7 not in got and set(others) <= set(got)
