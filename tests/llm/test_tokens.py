"""Token counts against the library, text by text, and the safety of the cuts."""

import random

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from dwspark.llm import queries, tokens
from . import helpers as h

PATH = public_tokenizers.path(tokens.VOCABULARY)
WHOLE = Tokenizer.from_file(PATH)
PARTS = ["a", "B", "é", "中", "。", " ", "  ", "\n", "\t", "\r\n", "'s", "'ll", "1", "23", "!", "<|endoftext|>", "<|end", "text|>",
         "　", "\xa0", "​", "\x1c", "\x85", "_", "|", "ة", "😀", "́", "½", "᠎", "\x0b", "\x0c", " "]


def count(text):
    return len(WHOLE.encode(text or "", add_special_tokens=False).ids)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=20), st.integers(1, 6))
def test_cuts_never_change_the_count(parts, size):
    text = "".join(parts)
    found = list(tokens.pieces(text, size))
    assert "".join(found) == text
    assert sum(map(count, found)) == count(text)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=40))
def test_cuts_of_any_text(text):
    assert sum(map(count, tokens.pieces(text, 1))) == count(text)


def test_which_tokenizers_may_be_split():
    assert tokens.can_split(open(PATH, "rb").read())
    assert not tokens.can_split(open(public_tokenizers.path("word_bpe_49k.json"), "rb").read())


def test_batches_follow_bytes_and_keep_every_piece():
    r = random.Random(1)
    texts = ["word " * r.choice([0, 1, 30, 5000]) for _ in range(60)]
    seen = {}
    for rows, parts in tokens.batches(texts, [len(t.encode()) for t in texts], 4096, 8192, True):
        assert sum(len(p.encode()) for p in parts) <= 8192
        for row, part in zip(rows, parts):
            seen[row] = seen.get(row, "") + part
    assert seen == {i: t for i, t in enumerate(texts) if t}


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PARTS), max_size=12).map("".join), max_size=8), st.sampled_from([1, 1 << 20]))
def test_counts_by_word_equal_the_library(texts, memo):
    count_words = tokens.by_word(lambda words: [count(w) for w in words], memo)
    for _ in range(2):
        assert count_words(texts) == [count(t) for t in texts]


def test_all_documents(spark):
    want = {d: (len((t or "").encode()), count(t), count(t) > 512) for d, t in h.documents()}
    rows = queries.queries()["op13_token_counts"](spark, h.SF).collect()
    assert {r[0]: tuple(r)[1:] for r in rows} == want and len(rows) == len(want)


def test_edges(spark):
    texts = [None, "", " ", "<|endoftext|>", "a<|endoftext|> b", "x" * 300_000, "中文。" * 40_000, h.prose(4, 60_000), "a\x00b", "\n" * 200_000, "é " * 99_999]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "one"), (3, "<|endoftext|>")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS n_bytes", "'x' AS n_tokens", "'y' AS _text")
    got = sorted(map(tuple, tokens.query(docs).collect()), key=str)
    assert got == sorted(((d, len((t or "").encode()), count(t), count(t) > 512) for d, t in rows), key=str)
    assert tokens.query(docs.limit(0)).collect() == []


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "piece_bpe_32k.model"])
def test_other_vocabularies(spark, name):
    texts = ["Hello  World", None, h.prose(5, 30_000)]
    path = public_tokenizers.path(name)
    if name.endswith(".json"):
        t = Tokenizer.from_file(path)
        want = [len(t.encode(x or "", add_special_tokens=False).ids) for x in texts]
    else:
        import sentencepiece

        want = [len(x) for x in sentencepiece.SentencePieceProcessor(model_file=path).encode([x or "" for x in texts])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.n_tokens for r in tokens.token_counts(docs, path=path).collect()}
    assert got == dict(enumerate(want))
    with pytest.raises(Exception):
        tokens.token_counts(docs, path=__file__).collect()
