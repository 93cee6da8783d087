"""SentencePiece encoding and decoding (operator 1): shared-prefix Viterbi over a trie of words.

Texts are cut into marked words: runs of U+2581 and the characters up to the next such mark.
No piece of the model goes across such a cut (this is checked; otherwise a text is one
word), so words are encoded on their own.  Per batch, the distinct words not seen before are
sorted, which is a depth-first walk of their trie: from one word to the next, the forward
states of the common prefix are kept and only the rest is extended.

The forward state of a prefix is its best last piece:

* unigram models: the piece with the best score sum, as in Viterbi's algorithm;
* BPE models, whose scores are merge ranks: a sum of ranks does not give the model's own
  encoding.  There the state is the last piece of the prefix's BPE encoding.  It is the one
  piece ending here that can stand after the state before it, that is, whose pair encodes to
  itself; so every prefix has exactly one state, and prefixes share it just as well.

Each task works on its own rows with bounded memory: a memo of at most ``MEMO_WORDS`` words
(more only for a batch that holds more) is kept for each Python worker and emptied when full,
always before a batch's words are learnt, never while they are used.  Nothing is shuffled.

Defined cases: null and empty texts have no tokens; characters outside the vocabulary
become byte pieces (or the unknown piece); U+2581 itself reads back as a space; repeated rows
are encoded alike; an empty table gives an empty result; all columns of a table stay, and
token columns have names of the caller's choice.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Callable, Iterator
from struct import pack

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import quoted, small_batches

MARK = "▁"
#: Words and piece pairs remembered by a Python worker.
MEMO_WORDS, MEMO_PAIRS = 1_390_000, 1_500_000
#: Factor that joins two piece ids in one key; more than any vocabulary's size.
PAIR = 1 << 24
#: How much less an unknown character scores than the worst piece (unigram models).
UNKNOWN_PENALTY = 10.0


def default_model() -> str:
    """The public piece model of this machine; any other path can be given instead."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Pieces:
    """A model's pieces and the encoder over words.

    ``kind`` is "bpe" or "unigram"; None takes the model's own.
    """

    def __init__(self, model: bytes, kind: str | None = None):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as proto

        spec = proto.ModelProto.FromString(model)
        kinds = {proto.TrainerSpec.BPE: "bpe", proto.TrainerSpec.UNIGRAM: "unigram"}
        self.kind = kind or kinds[spec.trainer_spec.model_type]
        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.sp_normalize = sp.normalize
        self.plain = spec.normalizer_spec.name == "identity" and not spec.normalizer_spec.remove_extra_whitespaces
        self.prefix = spec.normalizer_spec.add_dummy_prefix
        self.ids: dict[str, int] = {}
        self.scores: list[float] = []
        self.raw: list[bytes] = []
        self.bytes_: dict[int, int] = {}
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            self.scores.append(sp.get_score(i))
            if sp.is_byte(i):
                self.bytes_[int(piece[1:-1], 16)] = i
                self.raw.append(bytes([int(piece[1:-1], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i):
                self.raw.append(b"" if sp.is_control(i) else " ⁇ ".encode())
            else:
                self.ids[piece] = i
                self.raw.append(piece.replace(MARK, " ").encode())
        self.names = {i: p for p, i in self.ids.items()}
        self.unk = sp.unk_id()
        self.longest = max(map(len, self.ids))
        self.states = {piece: (i, len(piece), i * PAIR) for piece, i in self.ids.items()}
        pairs = {p: s for p, s in self.states.items() if len(p) == 2}
        ends: dict[str, set[int]] = {}
        for piece in self.ids:
            if len(piece) > 2:
                ends.setdefault(piece[-3:], set()).add(len(piece))
        # what can end in three characters: lengths of longer pieces, longest first, then the states of the pieces of three and two
        self.tails = {end: (tuple(sorted(n - {3}, reverse=True)), tuple(self.states[p] for p in (end, end[1:]) if p in self.states and len(p) > 1))
                      for end, n in ends.items()}
        self.pair_tails = {p: ((), (s,)) for p, s in pairs.items()}
        self.unk_score = min(self.scores) - UNKNOWN_PENALTY
        crossing = any(MARK in p.lstrip(MARK) for p in self.ids)
        self.words_of = re.compile(".+" if crossing else f"{MARK}*[^{MARK}]+|{MARK}+", re.S).findall
        self.pairs: dict[int, bool] = {}
        self.memo: dict[str, bytes] = {}

    def marked(self, text: str) -> str:
        """Normalised text with marks for spaces."""
        if not self.plain:
            return self.sp_normalize(text)
        return (MARK if self.prefix and text else "") + text.replace(" ", MARK)

    def merged(self, text: str) -> list[str]:
        """Plain BPE of a short string: merge the best-scored pair, leftmost first, until none is a piece."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                piece = self.ids.get(parts[k] + parts[k + 1])
                if piece is not None and (best is None or self.scores[piece] > best):
                    best, at = self.scores[piece], k
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def follows(self, key: int) -> bool:
        """Whether a piece can stand after another (-1: a word's start) in a BPE encoding; ``key`` joins the two."""
        last, piece = divmod(key, PAIR)
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) > MEMO_PAIRS:
                self.pairs.clear()
            two = [self.names[piece]] if last < 0 else [self.names[last], self.names[piece]]
            known = self.pairs[key] = self.merged("".join(two)) == two
        return known

    def learn(self, words: set[str]) -> None:
        """Encode new distinct words: sorted, so that neighbours share the states of their common prefix."""
        if len(self.memo) + len(words) > MEMO_WORDS:
            self.memo.clear()
        extend = self._extend_bpe if self.kind == "bpe" else self._extend_unigram
        states: list = []
        before = ""
        for word in sorted(words):
            same = 0
            for a, b in zip(word, before):
                if a != b:
                    break
                same += 1
            del states[same:]
            extend(word, states)
            self.memo[word] = self._path(word, states)
            before = word

    def _extend_bpe(self, word: str, states: list) -> None:
        """States: (piece or -1 - character, its length, the first part of the key of a pair that it begins).

        Only lengths of pieces that end in the prefix's last three characters are tried, longest first.
        """
        get, tails, pair_tails, known, follows = self.states.get, self.tails.get, self.pair_tails.get, self.pairs.get, self.follows
        keys = [-PAIR, *[s[2] for s in states]]  # of the state before each place; a word's start and unknown characters are alike
        for end in range(len(states) + 1, len(word) + 1):
            tail = tails(word[end - 3:end]) if end > 2 else None
            if tail is None and end > 1:
                tail = pair_tails(word[end - 2:end])
            if tail is not None:
                for n in tail[0]:
                    if n > end:
                        continue
                    state = get(word[end - n:end])
                    if state is not None:
                        key = keys[end - n] + state[0]
                        ok = known(key)
                        if ok or ok is None and follows(key):
                            break
                else:
                    for state in tail[1]:
                        key = keys[end - state[1]] + state[0]
                        ok = known(key)
                        if ok or ok is None and follows(key):
                            break
                    else:
                        state = None
                if state is not None:
                    states.append(state)
                    keys.append(state[2])
                    continue
            state = get(word[end - 1]) or (-1 - ord(word[end - 1]), 1, -PAIR)  # one character, which may be unknown
            states.append(state)
            keys.append(state[2])

    def _extend_unigram(self, word: str, states: list) -> None:
        """States: (piece or -1 - character, its length, the best score sum)."""
        for end in range(len(states) + 1, len(word) + 1):
            best = None
            for n in range(min(self.longest, end), 0, -1):
                piece = self.ids.get(word[end - n:end])
                if piece is None and n > 1:
                    continue
                score = self.unk_score if piece is None else self.scores[piece]
                total = score + (states[end - n - 1][2] if end > n else 0.0)
                if best is None or total > best[2]:
                    best = (-1 - ord(word[end - 1]) if piece is None else piece, n, total)
            states.append(best)

    def _path(self, word: str, states: list) -> bytes:
        """The pieces back from the word's end, as 32-bit integers; unknown characters as byte pieces."""
        out, end = [], len(word)
        while end:
            piece, n = states[end - 1][:2]
            if piece >= 0:
                out.append(piece)
            elif self.bytes_:
                out.extend(self.bytes_[b] for b in reversed(chr(-1 - piece).encode("utf-8", "replace")))
            elif not out or out[-1] != self.unk:
                out.append(self.unk)
            end -= n
        out.reverse()
        return pack(f"{len(out)}i", *out)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Offsets and flat ids of a batch of texts."""
        split = [self.words_of(self.marked(t)) for t in texts]
        distinct = set().union(*split)
        new = distinct.difference(self.memo)
        if len(self.memo) + len(new) > MEMO_WORDS:  # it will be emptied: the batch's known words are learnt again
            self.memo.clear()
            new = distinct
        if new:
            self.learn(new)
        get = self.memo.__getitem__
        rows = [b"".join(map(get, words)) for words in split]
        offsets = np.concatenate([[0], np.cumsum([len(r) // 4 for r in rows])]).astype(np.int32)
        return offsets, np.frombuffer(b"".join(rows), np.int32)

    def decode(self, ids: list[int]) -> str:
        """The text of ids: pieces put together, marks to spaces, byte pieces to characters."""
        text = b"".join(map(self.raw.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if self.prefix and text[:1] == " " else text


def _pieces(model: bytes, kind: str | None) -> Pieces:
    """The model of this Python worker, made once and kept with its memo from task to task."""
    kept = sys.__dict__.setdefault("_piece_models", {})
    key = (hash(model), kind)
    if key not in kept:
        kept.clear()
        kept[key] = Pieces(model, kind)
    return kept[key]


def read_model(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def _encoder(spark: SparkSession, model: bytes, kind: str | None, check: bool) -> Callable:
    shared = spark.sparkContext.broadcast(model)  # the vocabulary file, about half a MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(shared.value, kind)
        for batch in batches:
            texts = [t or "" for t in batch.column(batch.num_columns - 1).to_pylist()]
            offsets, ids = pieces.encode(texts)
            columns = [*batch.columns[:-1], pa.array(np.diff(offsets).astype(np.int64)),
                       pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))]
            names = [*batch.schema.names[:-1], "n_tokens", "token_ids"]
            if check:
                same = [pieces.decode(ids[a:b].tolist()) == t.replace(MARK, " ")
                        for a, b, t in zip(offsets[:-1], offsets[1:], texts)]
                columns.append(pa.array(same, pa.bool_()))
                names.append("round_trip")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def encode(df: DataFrame, model_path: str, text: str = "text", kind: str | None = None, check: bool = False,
           names: tuple[str, str, str] = ("n_tokens", "token_ids", "round_trip")) -> DataFrame:
    """All other columns of ``df``, then n_tokens and token_ids; with ``check``, whether decoding gives the text back."""
    spark = df.sparkSession
    small_batches(spark)
    others = [c for c in df.columns if c != text]
    inner = df.select(*[F.col(quoted(c)).alias(f"c{i}") for i, c in enumerate(others)], F.col(quoted(text)).alias("t"))
    fields = [T.StructField(f"c{i}", df.schema[c].dataType) for i, c in enumerate(others)]
    fields += [T.StructField("n_tokens", T.LongType()), T.StructField("token_ids", T.ArrayType(T.IntegerType()))]
    fields += [T.StructField("round_trip", T.BooleanType())] * check
    out = inner.mapInArrow(_encoder(spark, read_model(model_path), kind, check), T.StructType(fields))
    return out.toDF(*others, *names[:2 + check])


def decode(ids: Column, spark: SparkSession, model_path: str, kind: str | None = None) -> Column:
    """A column with the text of a column of token ids (null: null)."""
    shared = spark.sparkContext.broadcast(read_model(model_path))

    def run(column: pd.Series) -> pd.Series:
        pieces = _pieces(shared.value, kind)
        return column.map(lambda x: None if x is None else pieces.decode(list(x)))

    return F.pandas_udf(run, T.StringType())(ids)


def token_table(docs: DataFrame, model_path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, token_ids and round_trip of every document."""
    return encode(docs.select("doc_id", "text"), model_path or default_model(), check=True)
