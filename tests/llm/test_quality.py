"""Quality rules: base figures against brute force, verdicts on clean and odd texts."""

import random
from collections import Counter

from nestwork.llm import quality

from .helpers import docs_frame, prose, words_of


def brute(text):
    text = text or ""
    words = words_of(text)
    lines = [x for x in text.split("\n") if words_of(x)]
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often = Counter(grams)
    hit = {k for i, g in enumerate(grams) if often[g] > 1 for k in (i, i + 1, i + 2)}
    n, rep = len(words), len(hit)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), rep,
            n < 50 or 100 * rep > 50 * n)


def rows_of(df):
    return {r["doc_id"]: (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"])
            for r in df.collect()}


def test_base_figures_equal_brute_force(spark):
    rng = random.Random(5)
    texts = [None, "", " ", "\n\n", "a", "a a a a", "x\ty\vz\fq\r\nw", "same line\nsame line\n\n \nsame line", "é#ü*ñ <b>|$%&",
             " " * 5000, "word " * 30_000, "y" * 200_000, prose(3000, 1), prose(400, 2) + "\n" + prose(400, 2), "   x"]
    texts += [" ".join(rng.choice("ab") for _ in range(rng.randrange(40))) for _ in range(60)]
    got = rows_of(quality.quality_table(docs_frame(spark, list(enumerate(texts)))))
    assert got == {i: brute(t) for i, t in enumerate(texts)}


def test_clean_stays_and_outliers_go(spark):
    clean = [(i, prose(80 + 7 * (i % 60), i), "en", "big" if i % 3 else None) for i in range(240)]
    odd = [(1000, prose(200, 9).replace(" ", " | "), "en", "big"), (1001, prose(200, 8).replace(" ", "*** "), None, "lone"),
           (1002, prose(300, 7).replace(" ", "%%% "), "en", None), (1003, "short", "en", "big")]
    rows = clean + odd + [clean[0]] * 3  # repeated rows
    docs = docs_frame(spark, rows)
    kept = Counter(r["doc_id"] for r in quality.keep_good(docs).collect())
    assert kept == Counter(r[0] for r in clean) + Counter({0: 3})
    assert quality.keep_good(docs).columns == docs.columns
    assert {r["doc_id"] for r in quality.quality_table(docs).where("kept").collect()} == set(kept)


def one_odd_figure():
    """Statistic -> a text in which only that statistic is far from clean prose."""
    words = prose(300, 21).split()
    pairs = [f"{w} kappa" for w in words[:4]]
    return {
        "s_len": prose(20_000, 20),
        "s_word": "\n".join(" ".join(a + b for a, b in zip(words[i:i + 18:2], words[i + 1:i + 18:2])) for i in range(0, 300, 18)),
        "s_sym": " ".join(w + "#" * (i % 4 == 0) for i, w in enumerate(words)),
        # the repeated lines are two words between lines of their own, so no window of three words repeats
        "s_line": "\n".join(f"{words[i]}z{i}\n{pairs[i % 4]}" for i in range(100)),
        "s_rep": "\n".join(f"{words[i]}z{i} one two three {words[i + 1]}z{i} {words[i + 2]}z{i} {words[i + 3]}z{i}" for i in range(30)),
    }


def test_each_statistic_alone_can_reject(spark):
    clean = [(i, prose(80 + 7 * (i % 60), i), "en", "big") for i in range(240)]
    odd = {1000 + k: (name, text) for k, (name, text) in enumerate(one_odd_figure().items())}
    docs = docs_frame(spark, clean + [(i, text, "en", "big") for i, (_, text) in odd.items()])
    got = {r["doc_id"]: r for r in quality.quality_table(docs).collect()}
    assert not any(got[i]["base_failed"] for i in odd)
    assert [name for i, (name, _) in odd.items() if got[i]["kept"]] == []
    assert all(got[i]["n_repeat_words"] == 0 for i, (name, _) in odd.items() if name == "s_line")
    assert all(got[i]["n_dup_lines"] == 0 for i, (name, _) in odd.items() if name == "s_rep")
    assert all(got[i[0]]["kept"] for i in clean)


def test_one_repeated_line_of_a_short_text_stays(spark):
    clean = [(i, prose(80 + 7 * (i % 60), i), "en", "big") for i in range(240)]
    short = prose(120, 30)
    docs = docs_frame(spark, clean + [(1000, short + "\n" + short.split("\n")[2], "en", "big")])
    assert quality.keep_good(docs).count() == 241


def test_nulls_and_empty_table(spark):
    rows = [(None, None, None, None), (None, prose(90, 1), None, None), (1, prose(90, 2), None, "s")]
    out = quality.quality_table(docs_frame(spark, rows)).collect()
    assert len(out) == 3 and sum(r["kept"] for r in out) == 2
    empty = docs_frame(spark, [])
    assert quality.quality_table(empty).count() == 0
    assert quality.keep_good(empty).count() == 0
