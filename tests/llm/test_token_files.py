"""Blocks and token files against plain encoding, position by position."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm import pfor, token_files

VOCABULARY = public_tokenizers.path(token_files.VOCABULARY)
ids32 = st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=600)


@given(ids32)
@settings(max_examples=60, deadline=None)
def test_blocks_come_back(values):
    ids = np.array(values, np.uint32)
    data, starts = pfor.encode(ids)
    assert pfor.decode(data, starts, len(ids)).tolist() == values
    assert len(starts) == -(-len(ids) // pfor.BLOCK)


def test_outliers_go_to_the_exception_list():
    small = np.arange(pfor.BLOCK, dtype=np.uint32) % 16 + 1000
    odd = small.copy()
    odd[[3, 77]] = 2**32 - 1
    plain, patched = (len(pfor.encode(x)[0]) for x in (small, odd))
    assert plain == 8 + 4 * pfor.BLOCK // 8 and patched == plain + 2 * 5
    # more outliers than the percentile leaves out widen the block instead
    odd[: pfor.BLOCK // 2] = 2**32 - 1
    assert len(pfor.encode(odd)[0]) == 8 + 4 * pfor.BLOCK


def test_a_file_is_read_at_any_position(tmp_path):
    rng = np.random.default_rng(3)
    docs = [rng.integers(0, 50_000, n).astype(np.uint32) for n in (1, 700, 128, 5, 70_000)]
    writer = token_files.Writer(f"{tmp_path}/f")
    for n, ids in enumerate(docs):
        writer.add(None if n == 1 else n, ids)
    row, line = writer.close(), np.concatenate(docs)
    assert row["n_ids"] == len(line) and row["n_docs"] == 5
    with token_files.Reader(f"file://{tmp_path}/f") as reader:
        assert reader.doc_ids == [0, None, 2, 3, 4]
        assert reader.counts.tolist() == [len(d) for d in docs]
        for at, n in ((0, 1), (127, 3), (500, 600), (len(line) - 2, 50), (len(line), 5)):
            assert reader.read(at, n).tolist() == line[at:at + n].tolist()
        assert reader.checksums() == [zlib.crc32(d.tobytes()) for d in docs]
    (tmp_path / "g").write_bytes(b"x" * 100)
    with pytest.raises(ValueError, match="no token file"):
        token_files.Reader(f"{tmp_path}/g")


texts = st.text(st.one_of(st.sampled_from(" \t\n\r'stlAé́  \x1c\x85<|>"),
                          st.characters(exclude_categories=["Cs"])), max_size=40)


@given(texts)
@settings(max_examples=300, deadline=None)
def test_word_by_word_is_the_whole_text(text):
    text = text + " <|endoftext|> x<|startoftext|>" + text
    got = token_files.encoder(VOCABULARY).encode([text, None])
    assert np.frombuffer(got[0], "<u4").tolist() == WHOLE.encode(text, add_special_tokens=False).ids
    assert got[1] == b""


WHOLE = Tokenizer.from_file(VOCABULARY)


def plain(rows):
    """(doc_id, n_tokens, crc) of (doc_id, text) rows."""
    for doc_id, text in rows:
        ids = WHOLE.encode(text or "", add_special_tokens=False).ids + [token_files.END]
        yield doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())


DOCS = [(4, "Some words, some more."), (2, None), (9, ""), (-3, "é" * 50), (None, "no id"),
        (7, "long " * 30_000), (7, "twin"), (4, "Some words, some more."), (5, "x" * 40_000),
        *[(100 + n, f"text number {n} of many " * (n % 9)) for n in range(200)]]


def test_documents_from_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "FILE_IDS", 300)
    rows = [(d, t, "clash") for d, t in DOCS]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start string").repartition(3)
    files = token_files.write(docs, VOCABULARY, f"{tmp_path}/files").cache()
    assert files.count() > 10
    found = [tuple(r) for r in token_files.digests(files).collect()]
    found.sort(key=lambda r: r[1])
    for (_, start, n, _), (_, following, *_) in zip(found, found[1:]):
        assert start + n == following
    assert found[0][1] == 0
    assert sorted(((d, n, c) for d, _, n, c in found), key=str) == sorted(plain(DOCS), key=str)
    order = [d for d, *_ in found]
    assert order[0] is None and order[1:] == sorted(order[1:])
    whole = {(r["doc_id"], r["start"]): r["ids"] for r in token_files.documents(files).collect()}
    assert {k: zlib.crc32(np.array(v, "<u4").tobytes()) for k, v in whole.items()} == {
        (d, s): c for d, s, _, c in found}


def test_query_over_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    found = token_files.op11_token_files(spark, sf).collect()
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    want, at = [], 0
    for d, n, c in plain(sorted(map(tuple, docs), key=lambda r: r[0])):
        want.append((d, at, n, c))
        at += n
    assert sorted(map(tuple, found)) == want


def test_empty_table(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string")
    files = token_files.write(docs, VOCABULARY, f"{tmp_path}/none")
    assert token_files.digests(files).collect() == [] == token_files.documents(files).collect()


def test_a_word_is_looked_up_once_for_all_texts_of_a_call():
    class Counted(dict):
        asked = 0

        def get(self, *args):
            self.asked += 1
            return super().get(*args)

    path = public_tokenizers.path(token_files.VOCABULARY)
    encoder = token_files.Encoder(path)
    texts = ["Die Zeit, die\tZeit\r\nund mehr ", None, "", " ", "die Zeit 12% é\u0301 \u00a0x"] * 50
    expected = [np.array(encoder.whole.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes()
                for t in texts]
    encoder.known = Counted(encoder.known)
    assert encoder.encode(texts) == expected
    assert encoder.known.asked <= 12
    assert encoder.encode([]) == [] and encoder.encode([None, ""]) == [b"", b""]


def test_words_of_letters_are_encoded_many_to_a_line(monkeypatch):
    monkeypatch.setattr(token_files, "LINE", 7)
    encoder = token_files.Encoder(VOCABULARY)

    class Watched:
        lines = []

        def encode_batch_fast(self, lines, **options):
            self.lines += lines
            return one_match.encode_batch_fast(lines, **options)

    one_match, encoder.one_match = encoder.one_match, Watched()
    letters = [chr(c) for c in range(0x41, 0x100) if chr(c).isalpha() and chr(c) not in "ªµºß"]
    words = [a + b + mark for a, b in zip(letters, letters[3:]) for mark in ("", "?!", ".x", "1")]
    for text in (" ".join(words), " ".join(w.swapcase() for w in words)):
        got = np.frombuffer(encoder.encode([text])[0], "<u4").tolist()
        assert got == WHOLE.encode(text, add_special_tokens=False).ids
    known = {w.lower() for w in words if w.isalpha()}
    assert sorted(w for line in Watched.lines for w in line.split(" ")) == sorted(known)
    assert len(Watched.lines) <= len(known) // 7 + 2
