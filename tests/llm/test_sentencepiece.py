"""Token ids against the sentencepiece library, and exact round trips."""

import random

import pytest
import sentencepiece
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2 as proto

from nestwork.llm import sentencepiece_trie as S

from .helpers import docs_frame, prose

MODEL = S.read_model(S.default_model())
HOSTILE = ["", " ", "   ", "a", "\n\n  x", "▁▁a ▁b", "aaaa" * 3000, " \t\x00 é ﬁ 🎉🎉 日本語のテキスト", "the the  the    x",
           "def f(x):\n        return x**2  # ok", "</s><s>[INST] <0x0A>", "w" * 20_000, "ab " * 20_000, "\x00", "á", prose(3000, 4)]


def random_texts(n):
    rng = random.Random(1)
    return ["".join(rng.choice("abcdeinorst ABé\n_-.,▁ 12日") for _ in range(rng.randrange(1, 150))) for _ in range(n)]


def test_bpe_ids_equal_the_library():
    pieces, library = S.Pieces(MODEL), sentencepiece.SentencePieceProcessor(model_proto=MODEL)
    texts = HOSTILE + random_texts(800)
    offsets, ids = pieces.encode(texts)
    for a, b, text in zip(offsets[:-1], offsets[1:], texts):
        assert ids[a:b].tolist() == library.encode(text), text[:60]
        assert pieces.decode(ids[a:b].tolist()) == text.replace("▁", " ")
        assert pieces.decode(ids[a:b].tolist()) == library.decode(ids[a:b].tolist())


def test_unigram_scores_equal_the_library():
    spec = proto.ModelProto.FromString(MODEL)
    spec.trainer_spec.model_type = proto.TrainerSpec.UNIGRAM
    model = spec.SerializeToString()
    pieces, library = S.Pieces(model), sentencepiece.SentencePieceProcessor(model_proto=model)
    score = lambda ids: sum(library.get_score(int(i)) for i in ids)
    for text in [*HOSTILE[:6], *HOSTILE[7:11], *random_texts(200)]:
        _, ids = pieces.encode([text])
        want = library.encode(text)
        assert ids.tolist() == want or score(ids) == pytest.approx(score(want), rel=1e-4)
        assert pieces.decode(ids.tolist()) == text.replace("▁", " ")


def test_states_are_shared_and_the_memo_stays_bounded(monkeypatch):
    monkeypatch.setattr(S, "MEMO_WORDS", 50)
    pieces, library = S.Pieces(MODEL), sentencepiece.SentencePieceProcessor(model_proto=MODEL)
    for text in random_texts(200):
        assert pieces.encode([text])[1].tolist() == library.encode(text)
    words = ["▁share", "▁shared", "▁sharedness", "▁sharing"]
    steps, walk = [], pieces._extend_bpe

    def counted(word, states):
        steps.append(len(word) - len(states))
        walk(word, states)

    pieces._extend_bpe = counted
    pieces.learn(set(words))
    assert steps == [6, 1, 4, 3]  # only what the common prefix with the word before does not have


def test_a_batch_with_more_new_words_than_the_memo(monkeypatch):
    monkeypatch.setattr(S, "MEMO_WORDS", 6)
    pieces, library = S.Pieces(MODEL), sentencepiece.SentencePieceProcessor(model_proto=MODEL)
    batches = [["old words here"], ["a b c d e f g h i j", "old a words b k l"], ["old words here", ""], [], ["old m", "words n here o p", "old q m"]]
    for texts in batches * 2:
        offsets, ids = pieces.encode(texts)
        assert [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:])] == [library.encode(t) for t in texts]


def test_table(spark):
    library = sentencepiece.SentencePieceProcessor(model_proto=MODEL)
    rows = list(enumerate([None, *HOSTILE])) + [(3, HOSTILE[2])] * 2 + [(None, "no id")]
    docs = docs_frame(spark, rows)
    out = S.token_table(docs).collect()
    assert sorted(map(repr, ((r["doc_id"], r["token_ids"], r["n_tokens"], r["round_trip"]) for r in out))) == sorted(
        map(repr, ((d, (ids := library.encode(t or "")), len(ids), True) for d, t in rows)))
    full = S.encode(docs, S.default_model())
    assert full.columns == [c for c in docs.columns if c != "text"] + ["n_tokens", "token_ids"]
    back = full.select("doc_id", S.decode(F.col("token_ids"), spark, S.default_model()).alias("text"))
    assert sorted(map(repr, map(tuple, back.collect()))) == sorted(repr((d, (t or "").replace("▁", " "))) for d, t in rows)
    assert S.token_table(docs_frame(spark, [])).count() == 0


def test_states_of_long_words_try_only_pieces_that_end_there():
    """Pieces of two and three characters are found by their end alone, longer ones by their length."""
    pieces = S.Pieces(MODEL)
    for end, (lengths, short) in pieces.tails.items():
        assert all(n > 3 for n in lengths) and list(lengths) == sorted(lengths, reverse=True)
        assert all(pieces.names[i] in (end, end[1:]) for i, _, _ in short)
    assert all(len(p) < 2 or p[-2:] in pieces.pair_tails or p[-3:] in pieces.tails for p in pieces.ids)
