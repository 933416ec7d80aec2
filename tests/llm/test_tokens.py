"""Token counts and SentencePiece ids against the libraries."""

import random

import public_tokenizers
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from loomspark.llm import sentencepiece_viterbi as S
from loomspark.llm import token_counts as T

WORD, PIECE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", " ", "a", None, "<|startoftext|>a <|endoftext|>", "é é ﬁ", "日本語 テキスト 😀", "x" * 3000, "it's  I'LL\t\n don't", "٣ 1234", "á ́b", "\x00\x01", "▁a  ▁ b", "   lead", "trail  "]


def test_counts(spark, docs_of):
    model = Tokenizer.from_file(WORD)
    long_ = " ".join(random.Random(1).choice(["the", "straße", "naïve,", "42", "it's", "<|endoftext|>"]) for _ in range(30_000))
    texts = [*ODD, long_, "y" * 200_000]
    got = {r.doc_id: r.n_tokens for r in T.count_tokens(docs_of(texts), WORD, piece_bytes=1000, batch_bytes=4000).collect()}
    assert got == {i: len(model.encode(t or "", add_special_tokens=False).ids) for i, t in enumerate(texts)}


def test_counts_of_a_model_file(spark, docs_of):
    model = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    got = {r.doc_id: r.n_tokens for r in T.count_tokens(docs_of(ODD), PIECE, split_long=False).collect()}
    assert got == {i: len(model.encode(t or "")) for i, t in enumerate(ODD)}


def test_counts_edges(spark, docs_of):
    assert T.count_tokens(docs_of([]), WORD).collect() == []
    clash = docs_of(["a b", "a b"]).withColumn("N_Tokens", F.lit("old"))
    out = T.count_tokens(clash, WORD)
    assert [c for c in out.columns if c.lower() == "n_tokens"] == ["n_tokens"] and [r.n_tokens for r in out.collect()] == [2, 2]


@settings(max_examples=50, deadline=None)
@given(st.text(max_size=60), st.integers(1, 9))
def test_pieces_join_again(text, most):
    assert "".join(T.pieces(text, most)) == text


MODEL = S.Vocabulary.load(PIECE)
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PIECE)


def encode(model, text):
    import numpy as np

    return np.frombuffer(model.encode(text), np.int32).tolist()


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]) | st.sampled_from("abcdeilnorstuv  ▁\n.,'0123"), max_size=80))
def test_ids_equal_the_library(text):
    ids = encode(MODEL, text)
    assert ids == LIBRARY.encode(text)
    assert MODEL.decode(ids) == LIBRARY.decode(ids) == text.replace("▁", " ")


def test_ids_of_words_and_long_runs():
    for text in [t for t in ODD if t] + ["a" * 5000, "ab" * 3000, "=" * 999, "the " * 2000, " " * 500, "internationalization" * 40]:
        assert encode(MODEL, text) == LIBRARY.encode(text)


def unigram(pieces):
    return S.Vocabulary([("<unk>", 0.0, S.UNKNOWN), *((p, s, S.NORMAL) for p, s in pieces)], S.UNIGRAM, dummy_prefix=False)


def test_unigram_search_by_brute_force():
    r = random.Random(3)
    for _ in range(200):
        pieces = {"a": -3.0, "b": -3.1, "c": -2.9} | {"".join(r.choice("abc") for _ in range(r.randrange(2, 5))): -r.random() * 9 for _ in range(8)}
        model = unigram(list(pieces.items()))
        text = "".join(r.choice("abc") for _ in range(r.randrange(1, 40)))
        best = [0.0] + [-1e9] * len(text)
        for end in range(1, len(text) + 1):
            best[end] = max(best[end - n] + pieces[text[end - n : end]] for n in range(1, min(4, end) + 1) if text[end - n : end] in pieces)
        parts = list(model.search(text))
        ids = [i for p in parts for i in p]
        assert "".join(model.pieces[i] for i in ids) == text
        assert abs(sum(model.scores[i] for i in ids) - best[-1]) < 1e-9
    assert list(model.search("")) == []


def test_window_is_bounded():
    """Ids come out while the text goes in, so a text without end is no trouble."""
    seen = 0

    def chars():
        nonlocal seen
        for c in "a" + "ba" * 50_000:
            seen += 1
            yield c

    model = unigram([("a", -1.0), ("b", -1.0), ("ab", -1.5), ("ba", -1.6)])
    at_first = next(iter(model.search(chars())))
    assert at_first and seen <= 4 * model.longest + 2


def test_sorted_runs_share_a_window():
    r = random.Random(8)
    words = sorted({"".join(r.choice("abcdeinorst") for _ in range(r.randrange(1, 12))) * r.choice((1, 1, 1, 30)) for _ in range(3000)})
    for model in (MODEL, unigram([("a", -1.0), ("b", -2.0), ("ab", -2.5), ("ba", -2.6), ("aba", -3.0)])):
        window = S.Window()
        for w in words:
            assert [i for ids in model.search(w, window) for i in ids] == [i for ids in model.search(w) for i in ids], w
            assert len(window.begin) <= 4 * model.longest + model.longest + 2


def test_encode_decode_columns(spark, docs_of):
    df = docs_of(ODD + ["a b", "a b"]).withColumn("IDS", F.lit(1))
    coded = S.decode(S.encode(df, PIECE), PIECE)
    for r in coded.collect():
        assert r.ids == LIBRARY.encode(r.text or "") and r.decoded == (r.text or "").replace("▁", " ")
    assert S.encode(docs_of([]), PIECE).collect() == []
    both = S.encode_and_decode(df, PIECE).collect()
    assert all(r.round_trip for r in both) and [r.ids for r in both] == [r.ids for r in coded.collect()]


def test_queries(spark, docs_of, folder_of):
    path = folder_of(documents=docs_of(ODD))
    one = {r.doc_id: r for r in T.op1_token_counts(spark, path).collect()}
    assert one[3].n_bytes == 0 and one[3].n_tokens == 0 and not one[3].over_limit and one[7].n_bytes == 3000
    assert all(r.round_trip for r in S.op10_sentencepiece(spark, path).collect())
