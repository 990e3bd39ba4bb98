"""Pair bitmaps and alignment against plain loops over whole texts."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm import alignment, bitmaps
from tidemark.llm.bpe import byte_characters

A_PATH, B_PATH = map(public_tokenizers.path, (alignment.A_VOCABULARY, alignment.B_VOCABULARY))
A = Tokenizer.from_file(A_PATH)
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
BYTE = byte_characters()

sets = st.lists(st.one_of(
    st.sets(st.integers(0, 65535), max_size=20),
    st.integers(0, 60000).flatmap(lambda a: st.integers(a, a + 5000).map(
        lambda b: set(range(a, b))))), min_size=1, max_size=4)


@given(sets)
@settings(max_examples=60, deadline=None)
def test_bitmaps(groups):
    packed = [bitmaps.pack(np.array(sorted(g), np.uint16)) for g in groups]
    assert [set(bitmaps.members(p).tolist()) for p in packed] == groups
    assert [bitmaps.count(p) for p in packed] == list(map(len, groups))
    both = bitmaps.union(packed)
    assert set(bitmaps.members(both).tolist()) == set().union(*groups)
    assert all(len(p) <= 8192 for p in [*packed, both])


def plain_tokens(text):
    """Ids and byte ranges by A and B, or nothing."""
    if not text:
        return [], []
    own = (" " + text).encode()
    a = A.encode(" " + text, add_special_tokens=False).ids
    b = B.encode(text)
    a_bytes = [bytes(BYTE[c] for c in A.id_to_token(i)) for i in a]
    b_bytes = [bytes([int(B.id_to_piece(i)[3:5], 16)]) if B.is_byte(i)
               else B.id_to_piece(i).replace("▁", " ").encode() for i in b]
    if b"".join(a_bytes) != own or b"".join(b_bytes) != own:
        return [], []

    def ranges(ids, parts):
        ends = np.cumsum([len(p) for p in parts]).tolist()
        return list(zip(ids, [0, *ends], ends))
    return ranges(a, a_bytes), ranges(b, b_bytes)


def plain(rows):
    tokens = [plain_tokens(t) for _, t in rows]
    links = [[(x, y) for x, s, e in a for y, u, v in b if s < v and u < e] for a, b in tokens]
    count = Counter(p for row in links for p in row)
    most = defaultdict(int)
    for (_, y), n in count.items():
        most[y] = max(most[y], n)
    out = []
    for (doc_id, _), (a, b), own in zip(rows, tokens, links):
        cuts = sorted({e for *_, e in a} & {e for *_, e in b})
        groups = [",".join(str(x) for x, s, e in a if lo <= s < hi) + "|"
                  + ",".join(str(y) for y, s, e in b if lo <= s < hi)
                  for lo, hi in zip([0, *cuts], cuts)]
        out.append((doc_id, len(a), len(b), len(groups), len(own),
                    sum(count[p] == most[p[1]] for p in own), sum(count[p] for p in own),
                    hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""))
    return sorted(out, key=str)


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
texts = st.text(st.one_of(st.sampled_from("  \n\t'stlxé▁<0x41>é\x85"),
                          st.characters(exclude_categories=["Cs"])), max_size=30)


@given(texts)
@settings(max_examples=300, deadline=None)
def test_stretch_by_stretch_is_the_whole_text(text):
    text = f"{text} two words  <s> <|endoftext|> {text}"
    [row] = alignment.aligner(A_PATH, B_PATH).aligned([text])
    a, b = plain_tokens(text)
    assert sum(s.n_a for s in row) == len(a) and sum(s.n_b for s in row) == len(b)
    groups = ";".join(s.groups for s in row)
    digest = hashlib.sha256(groups.encode()).hexdigest() if row else ""
    assert (None, len(a), len(b), groups.count("|"), digest) == tuple(
        plain([(None, text)])[0][i] for i in (0, 1, 2, 3, 7))
    links = np.frombuffer(b"".join(s.links for s in row), "<u8").tolist()
    assert Counter((x >> 24, x & (1 << 24) - 1) for x in links) == Counter(
        (x, y) for x, s, e in a for y, u, v in b if s < v and u < e)


DOCS = [(1, "The quick brown fox."), (1, "The quick brown fox."), (2, None), (3, ""), (4, " "),
        (None, "no id, ünïcödé"), (5, "a mark ▁ that is no space"), (6, "<s> <0x41> <|endoftext|>"),
        (7, "  lead and trail \n"), (8, "x" * 3000), (9, "tie tie tie " * 40), (10, "日本語 text"),
        *[(n, f"the {n % 7} quick foxes jump over {n} dogs " * (n % 5)) for n in range(11, 90)]]


def test_against_plain_loops(spark, monkeypatch):
    monkeypatch.setattr(alignment, "LINKS", 150)  # several parts per chunk to merge
    rows = [(d, t, 1, "clash") for d, t in DOCS]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_a int, chunk string")
    found = alignment.alignment(docs.repartition(3), A_PATH, B_PATH)
    assert found.columns == COLUMNS
    assert sorted(map(tuple, found.collect()), key=str) == plain(DOCS)


def test_chunks_end_and_pairs_count_documents(spark, monkeypatch):
    monkeypatch.setattr(alignment, "CHUNK_LINKS", 40)
    docs = spark.createDataFrame(DOCS, "doc_id long, text string").coalesce(1)
    documents, postings = alignment.tokenized(docs, A_PATH, B_PATH)
    indexed = alignment.index(postings).cache()
    assert indexed.select("chunk").distinct().count() > 10
    links, docs_of = Counter(), Counter()
    for _, text in DOCS:
        a, b = plain_tokens(text)
        own = [(x, y) for x, s, e in a for y, u, v in b if s < v and u < e]
        links.update(own)
        docs_of.update(set(own))
    found = alignment.pairs(indexed).collect()
    assert {(r["a"], r["b"]): r["n_links"] for r in found} == links
    assert {(r["a"], r["b"]): r["n_docs"] for r in found} == docs_of
    assert documents.count() == len(DOCS)


def test_query_over_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    short = [tuple(r) for r in docs if len(r["text"] or "") < 4000]
    found = {r["doc_id"]: r for r in alignment.op12_token_alignment(spark, sf).collect()}
    assert len(found) == len(docs)
    for row in plain(short):  # the corpus-wide columns need all texts; the others do not
        assert tuple(found[row[0]][c] for c in COLUMNS[:5]) == row[:5]
        assert found[row[0]]["groups_sha256"] == row[7]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.alignment(docs, A_PATH, B_PATH).collect() == []
