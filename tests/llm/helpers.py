"""Hostile tables for the operators of the subpackage."""

import random
from collections import Counter
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use inside; as extra columns they must not disturb.
CLASH = ["row", "a`b.c", "key", "kept", "node", "bucket", "copy", "ld_doc", "q_words", "n_words", "d2", "c0", "t"]


def docs_frame(spark, rows, extra=True):
    """(doc_id, text[, lang, source]) tuples as a documents table, with clashing extra columns."""
    full = [(r[0], r[1], *(r[2:4] if len(r) > 2 else ("en", "s")), len(r[1] or "")) for r in rows]
    df = spark.createDataFrame(full, SCHEMA).repartition(3)
    if extra:
        from pyspark.sql import functions as F

        df = df.withColumns({c: F.lit(f"extra {c}") for c in CLASH})
    return df


WORDS = ["alpha", "beta", "gamma", "delta", "épsilon", "zeta", "eta", "theta", "iota", "kappa", "lambda", "mu", "nu", "xi"]


def prose(n, seed, line=9):
    rng = random.Random(seed)
    words = [rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(n)]
    return "\n".join(" ".join(words[i:i + line]) for i in range(0, n, line))


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingle_bag(text):
    w = words_of(text)
    if len(w) < 5:
        return Counter([tuple(w)] if w else [])
    return Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))


def overlap(a, b):
    both, any_ = sum((a & b).values()), sum((a | b).values())
    return both / any_ if any_ else 0.0
