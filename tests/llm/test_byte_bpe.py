"""Byte-level BPE against the tiktoken library, and exact round trips."""

import base64

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from funnelforge.llm import byte_bpe, queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def ranks():
    with open(public_tokenizers.path(byte_bpe.RANKS), "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def codec():
    return byte_bpe.Codec(byte_bpe.word_patterns())


def ids_of(data):
    return [int.from_bytes(data[i:i + 4], "little") for i in range(0, len(data), 4)]


def test_tokens_encode_to_themselves_by_rising_ranks(ranks):
    """What lets the query for long words take all places of a rank at once."""
    for token, rank in ranks.items():
        parts, last = [token[i:i + 1] for i in range(len(token))], -1
        while len(parts) > 1:
            r, i = min((ranks.get(parts[i] + parts[i + 1], 1 << 30), i) for i in range(len(parts) - 1))
            assert last <= r <= rank
            last, parts[i:i + 2] = r, [parts[i] + parts[i + 1]]


CASES = ["", " ", "  ", "\n", " \n ", "a", " a", "a  b", "a \n b", "it's we'll I'D", "x\t\ty", "1 22  333", "<|endoftext|> <|endoftext|>",
         "日本語のテキスト と ことば", "naïve café — “quotes”", "🙂🙂 👩‍👩‍👧", "a b  c", "՘֋ ₝ x࢏", "\U00011de0 1\U00011de0",
         "\x1c x\x1d \x1ey", "a" * 5000, "ab" * 3000, " " * 700 + "x", "\n" * 300, "=" * 900, "é" * 400, "日" * 500, "xyz" * 50 + " " + "q" * 65,
         "aaaa" * 16, "aaaa" * 16 + "a", "The " * 200]


def test_cases_equal_library(codec, library):
    for text, got in zip(CASES, codec.encode(CASES)):
        assert ids_of(got) == library.encode_ordinary(text), text[:40]
    assert codec.decode(codec.encode(CASES)) == [t.encode() for t in CASES]


@settings(max_examples=60, deadline=None)
@given(texts=st.lists(st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(" \n\tab'sté1!")), max_size=120), max_size=8))
def test_any_text_equals_library(codec, library, texts):
    got = codec.encode(texts)
    assert [ids_of(x) for x in got] == [library.encode_ordinary(t) for t in texts]
    assert codec.decode(got) == [t.encode() for t in texts]


def test_queries_agree_and_restart(library):
    """Both queries, the second restarted within words, give the same ids."""
    words = ["internationalization" * 4, "aaaaaaaaab" * 9, "Donaudampfschifffahrtsgesellschaft" * 40, "pneumonoultramicroscopic" * 100]
    codec = byte_bpe.Codec()
    for word in words:
        for encode in (codec._short, codec._long):
            assert encode([word.encode()])[1].tolist() == library.encode_ordinary(word)


def test_forgetting_changes_nothing(codec, library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "REMEMBERED", 1)
    for text in ("one two three", "two three four", "one  two"):
        assert ids_of(codec.encode([text])[0]) == library.encode_ordinary(text)


def test_rows(frame, library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "GROUP_CHARS", 10)
    long = "Ein sehr langer Text. " * 40_000
    docs = frame([(1, "the cat", 5, "x"), (1, "the cat", 5, "x"), (2, None, 1, "y"), (None, "", 2, "z"), (4, long, 3, None)],
                 "doc_id long, text string, n_tokens int, ids string")
    got = byte_bpe.round_trip(docs).collect()
    assert sorted((r.doc_id or 0, bytes(r.decoded).decode(), ids_of(r.ids) == library.encode_ordinary(bytes(r.decoded).decode()),
                   r.n_tokens == len(r.ids) // 4) for r in got) == [
        (0, "", True, True), (1, "the cat", True, True), (1, "the cat", True, True), (2, "", True, True), (4, long, True, True)]
    again = byte_bpe.decode(byte_bpe.encode(docs)).collect()
    assert sorted((r.doc_id or 0, bytes(r.decoded)) for r in again) == sorted((r.doc_id or 0, bytes(r.decoded)) for r in got)
    assert byte_bpe.round_trip(frame([], "doc_id long, text string")).collect() == []
    assert byte_bpe.decode(frame([(1, None)], "doc_id long, ids binary")).collect()[0].decoded == b""


def test_query_equals_library(spark, library):
    import hashlib

    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    got = queries.op11_byte_bpe(spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        ids = library.encode_ordinary(docs[r.doc_id])
        data = b"".join(i.to_bytes(4, "little") for i in ids)
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(data).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()


def test_words_in_use_are_not_forgotten(library, monkeypatch):
    """A full memory keeps the words of the texts at hand: they are encoded once."""
    monkeypatch.setattr(byte_bpe, "REMEMBERED", 4)
    codec = byte_bpe.Codec(byte_bpe.word_patterns())
    learnt, learn = [], codec._learn
    monkeypatch.setattr(codec, "_learn", lambda words: (learnt.extend(w := list(words)), learn(w)))
    for k in range(3):
        text = f"qzxv wvkq qqzj zzkx jjqv xx{'abc'[k] * 5}yq"
        assert ids_of(codec.encode([text])[0]) == library.encode_ordinary(text)
    assert sorted(learnt.count(w) for w in set(learnt)) == [1] * len(set(learnt))
    texts = ["\x00\x80\xff é日🙂 \n", "", "a\x00b" * 500]
    assert codec.decode(codec.encode(texts)) == [t.encode() for t in texts]
