"""The registered queries on small tables with every awkward row, against plain versions."""

import hashlib
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from test_plain import PLAIN, numbers, plain_base, plain_similarity

import corpus_pipeline
from tidemark.llm import ann, bagminhash, components, decontam, pii, secrets, suffix_dedup, url_filter
from tidemark.llm.queries import ORACLE, QUERIES

PROSE = ("the quick brown fox jumps over the lazy dog while seven wizards mix a strange potion "
         "near an old castle and nobody knows what will happen when the moon rises tonight ")
LONG = " ".join(f"word{i}" for i in range(3000))
DOCS = [
    (0, PROSE * 2, "en"), (1, PROSE * 2, "en"), (2, PROSE * 2 + "again", "en"), (3, "", None),
    (4, None, "en"), (5, LONG, "de"), (5, LONG, "de"), (None, LONG[:900] + " tail", "de"),
    (7, "a" * 2000, "fr"), (8, "Licensed under CC BY-NC 4.0.", "fr"), (9, "...", "en"), (10, "...", "en"),
    (11, 'mail hans.r@x.example.com or +1 (988) 555-2485, token = "abcdefgh1234" and AKIAABCDEFGHIJKL', "en"),
    (12, "É" * 300 + " " + "0123456789abcdef" * 3 + " password=short secret: é", "es"),
    (13, "start " + " ".join(f"word{i}" for i in range(40, 52)) + " end", "de"),
]
ITEMS = [(1, " ".join(f"Word{i}" for i in range(41, 56))), (2, "potion near"), (3, None), (4, ""),
         (1, "moon rises"), (None, "lazy dog"), (6, "nothing of the kind is in there at all not one bit")]
PAGES = [
    (1, "http://a.example.org/es/x", ""), (2, "https://www.b.net/p?ref=1#t",
     '<link rel="canonical" href="http://a.example.org/es/x">'), (3, "http://b.net/p", None),
    (4, "https://c.com/fr/1", '<meta http-equiv="refresh" content="0; url=http://b.net/p">'),
    (5, None, "x"), (6, "no scheme", None), (7, "HTTP://EXAMPLE.ORG", ""), (8, "http://d.com/de/", None),
    (8, "http://d.com/de/", None), (9, "http://x.net", '<link href="/p" rel=canonical>'),
]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("tables"))
    docs = [(i, t, lang, "s", len(t or ""), "clash") for i, t, lang in DOCS]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, "
                          "n_chars long, n_words string").write.parquet(f"{out}/documents.parquet")
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(f"{out}/benchmark.parquet")
    spark.createDataFrame(PAGES, "page_id long, url string, html string").write.parquet(
        f"{out}/pages.parquet")
    rng = np.random.default_rng(1)
    vectors = [(i, [float(x) for x in np.float32(v)]) for i, v in
               enumerate(rng.standard_normal((60, 6)))]
    vectors += [(61, None), (80, [0.0] * 6), (63, [float("nan")] * 6), (64, [None] * 6), (65, []),
                (66, vectors[0][1]), (67, vectors[0][1]), (20, vectors[3][1])]
    spark.createDataFrame(vectors, "vec_id long, embedding array<float>").write.parquet(
        f"{out}/embeddings.parquet")
    return out


@pytest.fixture(scope="module")
def empty(spark, folder, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("empty"))
    for name in ("documents", "benchmark", "pages", "embeddings"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{out}/{name}.parquet")
    return out


def rows(spark, folder, name):
    return [r.asDict() for r in QUERIES[name](spark, folder).collect()]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, empty, name):
    assert QUERIES[name](spark, empty).collect() == []


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql_twins(spark, folder, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet/*.parquet'")
    want = con.execute(ORACLE[name])
    names = [d[0] for d in want.description]
    want = sorted(map(repr, want.fetchall()))
    assert sorted(repr(tuple(r[n] for n in names)) for r in rows(spark, folder, name)) == want


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def by_doc(found, *names):
    return sorted(repr((r["doc_id"], *(r[n] for n in names))) for r in found)


def expected(plain):
    return sorted(repr((i, *plain(t or ""))) for i, t, _ in DOCS)


def test_personal_data(spark, folder):
    def plain(t):
        spans = plain_base(t)
        n = Counter(k for k, _, _ in spans)
        return *(n[k] for k in pii.BASE), sha(",".join(f"{k}:{a}:{b}" for k, a, b in spans))

    found = rows(spark, folder, "op1_pii")
    assert by_doc(found, "n_email", "n_ip", "n_card", "n_phone", "base_sha256") == expected(plain)


def test_near_duplicates(spark, folder):
    found = {(r["doc_id"], r["class_id"]) for r in rows(spark, folder, "op2_near_duplicates")}
    n = range(len(DOCS))
    label = list(n)
    for i in n:
        for j in n:
            same = DOCS[i][1] is not None and DOCS[i][1] == DOCS[j][1]
            if same or plain_similarity(DOCS[i][1], DOCS[j][1]) >= 0.8:
                a, b = label[i], label[j]
                label = [min(a, b) if x in (a, b) else x for x in label]
    want = {(DOCS[i][0], min((DOCS[j][0] for j in n if label[j] == label[i]
                              and DOCS[j][0] is not None), default=None)) for i in n}
    assert found == want


def test_near_duplicates_compare_clusters_in_blocks(spark, monkeypatch):
    """A chain of texts, each close to the next only, over several blocks."""
    monkeypatch.setattr(bagminhash, "BLOCK", 4)
    words = [f"w{i}" for i in range(140)]
    texts = [" ".join(words[2 * n:2 * n + 60]) for n in range(20)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    found = {r["class_id"] for r in bagminhash.classes(df).collect()}
    assert plain_similarity(texts[0], texts[1]) >= 0.8 > plain_similarity(texts[0], texts[4])
    assert found == {0}
    kept = bagminhash.keep_one(df.union(df)).collect()
    assert [tuple(r) for r in kept] == [(0, texts[0])]


def test_components(spark):
    edges = [(i, i + 1) for i in range(30)] + [(40, 41), (42, 41), (50, 50), (None, 3)]
    df = spark.createDataFrame(edges, "a long, b long")
    found = {tuple(r) for r in components.components(df, "a", "b").collect()}
    assert found == {(i, 0) for i in range(31)} | {(40, 40), (41, 40), (42, 40)}


def plain_cut(texts):
    data = [t.encode() for t in texts]
    count = Counter(d[i:i + 200] for d in data for i in range(len(d) - 199))
    out = []
    for d in data:
        gone = np.zeros(len(d) + 1, bool)
        for i in range(len(d) - 199):
            if count[d[i:i + 200]] > 1:
                gone[i:i + 200] = True
        kept = bytes(x for x, g in zip(d, gone) if not g)
        out.append((len(d), len(d) - len(kept), int((gone[:-1] & ~np.append(False, gone[:-2])).sum())
                    if len(d) else 0, sha(kept)))
    return out


def test_repeated_strings(spark, folder):
    found = rows(spark, folder, "op3_suffix_dedup")
    cut = plain_cut([t or "" for _, t, _ in DOCS])
    want = sorted(repr((d[0], *c)) for d, c in zip(DOCS, cut))
    assert by_doc(found, "n_bytes", "n_removed", "n_spans", "kept_sha256") == want


@pytest.mark.parametrize("period", [168, 169, 170])
def test_lines_repeated_in_one_document_only(spark, period):
    rng = np.random.default_rng(period)
    line = "".join(rng.choice(list("abcdefghij"), period - 1)) + "\n"
    df = spark.createDataFrame([(1, line * 3)], "doc_id long, text string")
    found = suffix_dedup.remaining(df).collect()
    want = plain_cut([line * 3])[0]
    assert [(r["n_bytes"], r["n_bytes"] - len(r["kept"]), r["n_spans"], sha(bytes(r["kept"])))
            for r in found] == [want]


def test_hot_anchors_are_dealt_out_again(spark):
    rng = np.random.default_rng(3)
    letters = np.array(list("abcdefghij"))
    middle = "".join(rng.choice(letters, 230))
    texts = ["".join(rng.choice(letters, 60)) + middle + "".join(rng.choice(letters, 60))
             for _ in range(25)]
    df = spark.createDataFrame([(i, t.encode()) for i, t in enumerate(texts)], "a long, data binary")
    df = df.selectExpr("a", "a AS b", "data")
    runs, _ = suffix_dedup.repeated_places(df, hot_bytes=2_000)
    lists = {}
    for r in runs.distinct().collect():
        lists.setdefault(r["a"], []).append((r["start"], r["many"]))
    for i, (t, want) in enumerate(zip(texts, plain_cut(texts))):
        kept, spans = suffix_dedup.cut(t.encode(), lists.get(i, []))
        assert (len(t) - len(kept), spans, sha(kept)) == want[1:]


def test_anchors_that_stay_hot_take_two_rounds_more(spark, monkeypatch):
    rng = np.random.default_rng(4)
    line = "".join(rng.choice(list("abcdefghij"), 400))
    texts = [line[:200 + i] + str(i) + line[200 + i:] for i in range(0, 12)] + [line]
    df = spark.createDataFrame([(i, t.encode()) for i, t in enumerate(texts)], "a long, data binary")
    levels, own = [], suffix_dedup.occurrences
    monkeypatch.setattr(suffix_dedup, "occurrences",
                        lambda sources, level: levels.append(level) or own(sources, level))
    runs, _ = suffix_dedup.repeated_places(df.selectExpr("a", "a AS b", "data"), hot_bytes=0)
    lists = {}
    for r in runs.distinct().collect():
        lists.setdefault(r["a"], []).append((r["start"], r["many"]))
    assert levels == [0, 1, 2]
    for i, (t, want) in enumerate(zip(texts, plain_cut(texts))):
        kept, spans = suffix_dedup.cut(t.encode(), lists.get(i, []))
        assert (len(t) - len(kept), spans, sha(kept)) == want[1:]


def test_tokens(spark, folder):
    def plain(t):
        ids = PLAIN.encode_ordinary(t)
        return len(ids), sha(np.array(ids, "<u4").tobytes()), sha(t)

    found = rows(spark, folder, "op4_byte_bpe")
    assert by_doc(found, "n_tokens", "ids_sha256", "decoded_sha256") == expected(plain)


def test_proximity(spark, folder):
    docs = spark.createDataFrame([(1, "x alpha gamma beta y"), (2, "alpha x x x x"), (3, None)],
                                 "doc_id long, text string")
    items = spark.createDataFrame([(7, "alpha beta gamma")], "item_id long, text string")
    index = decontam.token_table(docs)
    assert decontam.exact_matches(index, items).count() == 0
    found = decontam.near_matches(index, items, missing=0).collect()
    assert [(r["doc_id"], r["item_id"]) for r in found] == [(1, 7)]


def test_languages_of_held_out_documents(spark):
    found = QUERIES["op6_language_id"](spark, "/root/testdata/sf0.01")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    out = [r for r in found.join(docs, "doc_id").collect() if r["held_out"]]
    assert sum(r["lang"] == r["lang_pred"] for r in out) >= 0.97 * len(out) > 100
    assert all(0 <= r["score"] <= 1 for r in out)


def test_licenses(spark, folder):
    phrases = ["gnu general public license", "apache license", "cc by", "mit license"]

    def plain(t):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub(
            "[A-Z]", lambda m: m[0].lower(), t))
        at = [i for p in phrases for i in range(len(words)) if words[i:i + len(p.split())] == p.split()]
        return len(words), len(at), min(at, default=None), max(at, default=None)

    found = rows(spark, folder, "op7_license_scan")
    assert by_doc(found, "n_words", "n_base", "first_word", "last_word") == expected(plain)
    assert {r["labels"] for r in found if r["doc_id"] == 8} == {"cc-by,cc-by-nc"}


def test_secrets(spark, folder):
    order = {"assign": 0, "access": 1, "hex": 2}

    def plain(t):
        out = [("assign", *m.span()) for m in re.finditer(
            r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
            t, re.ASCII) if len(m[1]) >= 8]
        out += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
        out += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 32]
        out.sort(key=lambda s: (s[1], order[s[0]]))
        n = Counter(k for k, _, _ in out)
        return n["assign"], n["access"], n["hex"], sha(",".join(f"{k}:{a}:{b}" for k, a, b in out))

    found = rows(spark, folder, "op8_secret_scan")
    assert by_doc(found, "n_assign", "n_access", "n_hex", "base_sha256") == expected(plain)


def test_aliases(spark, folder):
    found = {r["page_id"]: (r["rule"], r["verdict"]) for r in rows(spark, folder, "op9_url_filter")}
    assert found[2] == found[3] == (None, "block")  # aliases of a blocked page
    assert found[4] == ("com/fr/", "allow")  # the same, but allowed by a rule
    assert found[5] == found[6] == (None, "allow") and found[8] == ("com/de/", "block")
    assert url_filter.RULES and secrets.RULES


def verdicts(spark, pages):
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    return {r["page_id"]: (r["rule"], r["verdict"], r["alias_of"]) for r in url_filter.judge(df).collect()}


def test_rules_reach_pages_through_links_to_pages_that_are_no_rows(spark):
    found = verdicts(spark, [
        (1, "http://b.net/p", '<meta http-equiv="refresh" content="0; url=http://x.com/de/1">'),
        (2, "http://www.b.net/p?ref=2", None), (3, "http://c.net/", '<link rel=canonical href="http://b.net/p">'),
        (4, "http://y.com/fr/", '<link rel=canonical href="http://b.net/p">'), (5, "http://d.net/", None),
        (6, "no scheme", '<link rel=canonical href="http://d.net/">'),
        (7, "http://e.net/", '<link rel=canonical href="http://x.com/fr/1">')])
    assert found[1] == found[2] == found[3] == (None, "block", "b.net/p")
    assert found[4] == ("com/fr/", "allow", "b.net/p")
    assert found[5] == (None, "allow", "d.net/") and found[6] == (None, "allow", None)
    assert found[7] == (None, "allow", "e.net/")


def test_all_links_of_a_page_are_edges(spark):
    def to(n):
        return f'<meta http-equiv="refresh" content="0; url={n}">'

    links = ["login.php", "./login.php#a", "../a/login.php", "/a/login.php", "/b/../a/login.php",
             "//h.net/a/login.php", "http://h.net/a/login.php"]
    pages = [(0, "http://h.net/a/login.php", None), (1, "http://h.net/?p=2", None),
             (2, "http://i.net", None), (3, "http://j.net/a", None), (4, "http://h.net/a/k?p=2", None),
             (20, "http://h.net", to("?p=2")), (21, "http://h.net/a/k?p=1", to("?p=2")),
             (22, "http://h.net/a/z", to("#top")), (23, "http://h.net/a/y", to("mailto:x")),
             (24, "http://h.net/b/x?u=1", to("/a/?u=http://i.net")),
             (25, "http://l.net", to("http://i.net") + '<link rel="canonical" href="http://j.net/a">')]
    pages += [(100 + i, f"http://h.net/a/{i}", to(x)) for i, x in enumerate(links)]
    alias = {i: a for i, (_, _, a) in verdicts(spark, pages).items()}
    assert {alias[100 + i] for i in range(len(links))} == {alias[0]} == {"h.net/a/0"}
    assert alias[20] == alias[1] == "h.net/" and alias[21] == alias[4] == "h.net/a/k?p=1"
    assert alias[22] == "h.net/a/z" and alias[23] == "h.net/a/y"
    assert alias[24] == "h.net/a/?u=http://i.net"
    assert alias[25] == alias[2] == alias[3] == "i.net/"


def test_neighbours(spark, folder):
    vectors = [r for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    good = [(r[0], np.array(r[1], float)) for r in vectors
            if r[1] and None not in r[1] and np.isfinite(r[1]).all() and any(r[1])]
    found = {}
    for r in rows(spark, folder, "op10_nearest_neighbours"):
        found.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    assert set(found) == {0, 20, 40}
    hits = 0
    for q, got in found.items():
        own = min((v.tolist() for i, v in good if i == q))
        want = sorted((-float(np.cumsum(v * own)[-1]), i) for i, v in good if i != q)[:ann.K]
        assert [got[n][1] for n in sorted(got)] == sorted((s for _, s in got.values()), reverse=True)
        hits += len({i for i, _ in got.values()} & {i for _, i in want})
    assert hits >= 0.9 * 60


def test_pipeline(spark, folder):
    """The stages against plain steps: unknown languages, copies and benchmark passages go."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    known = corpus_pipeline.language(spark, docs, folder)
    assert known.columns == docs.columns
    assert {r["doc_id"] for r in known.collect()} == {0, 1, 2, 5, None, 7, 8, 11, 12, 13}
    single = corpus_pipeline.near_duplicates(spark, known, folder)
    assert {r["doc_id"] for r in single.collect()} == {0, 5, None, 7, 8, 11, 12, 13}
    assert single.count() == 8
    clean = corpus_pipeline.decontamination(spark, single, folder)
    left = sorted(r["doc_id"] for r in clean.collect())
    assert left == [7, 8, 11, 12] and clean.columns == docs.columns
    masked = {r["doc_id"]: r for r in corpus_pipeline.personal_data(spark, clean, folder).collect()}
    assert "<EMAIL>" in masked[11]["text"] and "<PHONE>" in masked[11]["text"]
    assert masked[11]["n_chars"] == len(masked[11]["text"]) and masked[8]["text"] == DOCS[9][1]
    found = corpus_pipeline.run(spark, folder).collect()
    assert {r["doc_id"]: r["decoded_sha256"] for r in found} == {
        i: sha(r["text"]) for i, r in masked.items()}
    assert numbers(np.array([1, 2], "<u4").tobytes()) == [1, 2]
