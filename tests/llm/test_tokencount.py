"""Token counts against the libraries over whole texts."""

import random

import numpy as np
import public_tokenizers
import pytest

from riverflow.llm import tokencount
from tests.llm.test_operators import SF, edge_docs, empty_docs

JSON, MODEL = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
OTHER = public_tokenizers.path("word_bpe_49k.json")


def whole(path, texts):
    if path.endswith(".model"):
        import sentencepiece
        return [len(x) for x in sentencepiece.SentencePieceProcessor(model_file=path).encode(texts)]
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return [len(t.encode(x, add_special_tokens=False).ids) for x in texts]


def odd_texts(n=400, seed=2):
    rnd = random.Random(seed)
    parts = ["the", " ", "  ", "\n", "\n\n", "\t", "it's", "I'll", "'s", "''", "123", "a1b2", "x.", ".y", "。", "，", "日本語", "テキスト",
             "é", "ß", " ", " ", "​", "<|endoftext|>", "<|endo", "ftext|>", "!", "?!", "…", "—", "(", ")", "]", "word",
             "WORD", "😀", "👨‍👩‍👧", "한국어", "عربى", "हिन्दी", "\x1c", "\x00", "▁", "²", "½", "٣", "ǆ", "’s", "don’t", "<s>", "</s>", "<unk>"]
    return ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 120))) for _ in range(n)]


@pytest.mark.parametrize("path", [JSON, MODEL, OTHER])
@pytest.mark.parametrize("long", [1, 7, 40, 1 << 16])
def test_split_counts_equal_whole_counts(path, long):
    texts = odd_texts() + ["", " ", "a", "a b", " lead", "trail ", "x" * 500]
    got = tokencount.count_texts(tokencount.counter(path), texts, long=long, batch_bytes=300)
    assert got.tolist() == whole(path, texts)


def test_texts_are_really_split():
    count = tokencount.counter(JSON)
    text = "plain words, and more.\n" * 50
    assert len(count.pieces(text, 10)) > 40 and "".join(count.pieces(text, 10)) == text
    assert count.pieces("x" * 100, 10) == ["x" * 100]
    assert len(tokencount.counter(MODEL).pieces(text, 10)) > 40
    assert tokencount.counter(OTHER).pieces(text, 10) == [text]  # white space dropped, lower case: not split


def test_batches_are_balanced():
    sizes = np.array([5, 1, 1, 1, 100, 1, 1, 1, 1, 1])
    cut = tokencount.balanced(sizes, 20)
    assert [a for a, _ in cut] == [0] + [b for _, b in cut][:-1] and cut[-1][1] == 10
    even = tokencount.balanced(np.full(1000, 10), 500)
    assert len(even) == 20 and {b - a for a, b in even} == {50}
    assert tokencount.balanced(np.zeros(0), 10) == []


def test_query_equals_the_library(spark):
    from riverflow.llm.queries import QUERIES
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: tuple(r) for r in QUERIES["op13_token_counts"](spark, SF).collect()}
    assert len(got) == len(docs) == 200
    for r, n in zip(docs, whole(JSON, [r.text or "" for r in docs])):
        assert got[r.doc_id] == (r.doc_id, len((r.text or "").encode()), n, n > 1024)


@pytest.mark.parametrize("path", [JSON, MODEL])
def test_edge_rows(spark, path):
    docs = edge_docs(spark)
    got = sorted((tuple(r) for r in tokencount.count_tokens(docs, path, long=50, batch_bytes=1000).collect()), key=str)
    rows = docs.select("doc_id", "text").collect()
    counts = whole(path, [r.text or "" for r in rows])
    assert got == sorted(((r.doc_id, len((r.text or "").encode()), n, n > 1024) for r, n in zip(rows, counts)), key=str)
    assert tokencount.count_tokens(empty_docs(spark), path).collect() == []
