"""The pipeline: every stage on its own input against brute force."""

from collections import Counter

import sentencepiece

import corpus_pipeline as P
from nestwork.llm import sentencepiece_trie
from nestwork.llm.common import written

from . import test_bagminhash, test_line_dedup, test_mixing, test_quality
from ..conftest import SF_SMALL


def rows_of(df):
    return [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in df.collect()]


def test_stages(spark):
    assert [n for n, _ in P.STAGES] == ["quality rules", "line dedup", "near dedup", "mixing", "tokenize"]
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, seen = docs.columns, [rows_of(docs)]
    for n, (_, stage) in enumerate(P.STAGES):
        docs = written(stage(spark, docs, SF_SMALL), "stage")
        if n < 4:
            assert docs.columns == columns
            seen.append(rows_of(docs))
    start, good, lines, single, mixed = seen
    assert not any(test_quality.brute(r[1])[5] for r in good)
    assert len(good) >= 0.7 * sum(not test_quality.brute(r[1])[5] for r in start)
    assert Counter((d, t) for d, t, *_ in lines) == Counter((d, t) for d, _, _, t in test_line_dedup.brute(good))
    assert Counter(r[0] for r in single) == Counter({c for _, c in test_bagminhash.brute_classes(lines)})
    assert Counter(r[0] for r in mixed) == Counter(d for (d, *_), n in test_mixing.brute(single).items() for _ in range(n))
    library = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_trie.default_model())
    tokens = Counter((r["doc_id"], tuple(r["token_ids"])) for r in docs.collect())
    assert tokens == Counter((d, tuple(library.encode(t))) for d, t, *_ in mixed)


def test_run_and_empty_input(spark):
    whole = P.run(spark, SF_SMALL)
    assert whole.columns == ["doc_id", "lang", "source", "n_tokens", "token_ids"]
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(0)
    for _, stage in P.STAGES:
        docs = written(stage(spark, docs, SF_SMALL), "stage")
        assert docs.count() == 0
