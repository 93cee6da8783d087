"""Quality rules: robust multivariate outliers (operator 8, DataFrame functions only).

Base figures of each text are computed inside its row, without a shuffle.  Every text that
passes the base rules then gets a vector of transformed statistics.  For each language and
source, a minimum-covariance-determinant (MCD) fit gives a robust centre and scatter:
starting from medians and median absolute deviations, each concentration step keeps the
``SUBSET`` share of rows with the smallest Mahalanobis distance (a quantile sketch) and
takes their mean and covariance.  Texts beyond ``CUTOFF`` are rejected.

Scale: moments and quantiles are partial aggregates, so a source with a third of all rows
sends a few rows per task.  Fits are one row per language and source in a written table,
which the planner broadcasts only when its known size is small; otherwise it is a join that
AQE can split.  No group is gathered anywhere.

Defined cases: a null text has no words; null language or source is a group of its own;
small groups lean on the pooled scatter (``PRIOR_ROWS`` rows of weight) and a little on the pooled centre, so a group of one
row is judged by it; repeated rows are judged one by one and alike; an empty table gives an
empty result; extra columns are ignored by the statistics.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, row_struct, text_of, unpacked, written

#: Share of a group's rows that a concentration step keeps.
SUBSET = 0.75
#: Concentration steps after the start from medians.
STEPS = 3
#: Factor that makes the covariance of the inner 75 % of a 5-variate normal consistent.
CONSISTENCY = 1.41
#: Rows of pooled scatter added to each group's own.
PRIOR_ROWS = 50
#: Rows of the pooled centre added to each group's own, so that a lone odd text is not its own measure.
CENTRE_ROWS = 3
#: Squared Mahalanobis distance beyond which a text is rejected (chi-squared of 5 degrees: 1 in 1,000).
CUTOFF = 20.5
#: Statistic -> least standard deviation assumed, which keeps the scatter regular where a statistic
#: is constant: about what one symbol, repeated line or repeated window moves it in a common text.
#: Each statistic alone can reach more than sqrt(CUTOFF) of them.
FLOORS = {"s_len": 0.05, "s_word": 0.03, "s_sym": 0.03, "s_line": 0.04, "s_rep": 0.03}
#: Lines and words without repeats added to each text's shares, so that one repeated line of a
#: short text is no share to judge by.
EVEN_LINES, EVEN_WORDS = 10, 100
STATS = list(FLOORS)


def text_figures(df: DataFrame, text: str = "text") -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_lines, n_dup_lines and n_repeat_words.

    Windows of three words are hashed (64 bits) and sorted with their positions inside the
    row; the union of the repeated windows is counted in one pass over the positions.
    """
    keep = [c for c in df.columns if c != "q_text"]
    has_word = F.lit(f"[^{SPACE}]")
    out = df.withColumn("q_text", text_of(text))
    words = F.regexp_extract_all("q_text", F.lit(f"[^{SPACE}]+"), F.lit(0))
    lines = F.filter(F.split("q_text", "\n", -1), lambda x: F.regexp_like(x, has_word))
    out = out.select(
        *keep, words.alias("q_words"), lines.alias("q_lines"),
        (F.octet_length("q_text") - F.octet_length(F.regexp_replace("q_text", r"[#*$%&|<>]", ""))).cast("long")
        .alias("n_symbols"))
    w = F.col("q_words")
    windows = F.transform(F.slice(w, 1, F.greatest(F.size(w) - 2, F.lit(0))),
                          lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))
    out = out.select(
        *keep, "n_symbols", F.size(w).cast("long").alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        F.size("q_lines").cast("long").alias("n_lines"),
        (F.size("q_lines") - F.size(F.array_distinct("q_lines"))).cast("long").alias("n_dup_lines"),
        windows.alias("q_hashes"))
    placed = F.sort_array(F.transform("q_hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    some = F.size(F.array_distinct("q_hashes")) < F.size("q_hashes")
    out = out.withColumn("q_placed", F.when(some, placed)).drop("q_hashes")
    p = F.col("q_placed")
    again = F.filter(p, lambda x, k: (x["h"] == F.get(p, k - 1)["h"]) | (x["h"] == F.get(p, k + 1)["h"]))
    starts = F.sort_array(F.transform(again, lambda x: x["i"]))
    covered = F.aggregate(
        starts, F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n")),
        lambda a, i: F.struct(i.alias("last"), (a["n"] + F.least(F.lit(3), i - a["last"])).alias("n")),
        lambda a: a["n"])
    return out.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long"))).drop("q_placed")


def base_failed() -> Column:
    """Fewer than 50 words, or more than half of them in repeated windows."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _vector(df: DataFrame) -> DataFrame:
    """Transformed statistics: logarithms of sizes, roots and shares of counts."""
    n, c = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("word_chars"), F.lit(1))
    return df.withColumns({
        "s_len": F.log(n), "s_word": F.log(c / n), "s_sym": F.sqrt(F.col("n_symbols") / c),
        "s_line": F.col("n_dup_lines") / (F.col("n_lines") + EVEN_LINES),
        "s_rep": F.col("n_repeat_words") / (n + EVEN_WORDS)})


def _moments(df: DataFrame, by: list[str]) -> DataFrame:
    """Count, sums and cross products of the statistics: one partial aggregate."""
    pairs = [(a, b) for i, a in enumerate(STATS) for b in STATS[: i + 1]]
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), *[F.avg(s).alias(f"m_{s}") for s in STATS],
        *[F.covar_pop(a, b).alias(f"c_{a}_{b}") for a, b in pairs])


def _inverse(df: DataFrame) -> DataFrame:
    """From c_* (scatter) the entries p_* of its inverse, by a Cholesky factor written out in columns."""
    d = range(len(STATS))
    c = lambda i, j: F.col(f"c_{STATS[i]}_{STATS[j]}")
    lo = lambda i, j: F.col(f"l_{i}_{j}")
    for i in d:
        for j in range(i + 1):
            rest = c(i, j) - sum((lo(i, k) * lo(j, k) for k in range(j)), F.lit(0.0))
            df = df.withColumn(f"l_{i}_{j}", F.sqrt(rest) if i == j else rest / lo(j, j))
    inv = lambda i, j: F.col(f"v_{i}_{j}")
    for i in d:
        for j in range(i + 1):
            top = F.lit(1.0) if i == j else -sum((lo(i, k) * inv(k, j) for k in range(j, i)), F.lit(0.0))
            df = df.withColumn(f"v_{i}_{j}", top / lo(i, i))
    entries = {f"p_{i}_{j}": sum((inv(k, i) * inv(k, j) for k in range(i, len(STATS))), F.lit(0.0))
               for i in d for j in range(i + 1)}
    return df.withColumns(entries).select(
        "g_lang", "g_source", *[F.col(f"m_{s}") for s in STATS], *list(entries))


def _distance(rows: DataFrame, fit: DataFrame) -> DataFrame:
    """Squared Mahalanobis distance ``d2`` of each row to its group's fit."""
    joined = rows.join(fit, ["g_lang", "g_source"], "left")
    x = [F.col(s) - F.col(f"m_{s}") for s in STATS]
    terms = [(1.0 if i == j else 2.0) * F.col(f"p_{i}_{j}") * x[i] * x[j]
             for i in range(len(STATS)) for j in range(i + 1)]
    return joined.withColumn("d2", sum(terms[1:], terms[0])).drop(
        *[f"m_{s}" for s in STATS], *[c for c in fit.columns if c.startswith("p_")])


def _fit(inner: DataFrame, factor: float) -> DataFrame:
    """Centre and inverse scatter per group from the rows of its subset."""
    own = written(_moments(inner, ["g_lang", "g_source"]), "quality-moments")
    pairs = [(a, b) for i, a in enumerate(STATS) for b in STATS[: i + 1]]
    # one row: the mean scatter within groups, weighted by their rows
    pool = own.agg(*[F.coalesce(F.sum(F.col("n") * F.col(f"c_{a}_{b}")) / F.sum("n"), F.lit(0.0)).alias(f"c_{a}_{b}")
                     for a, b in pairs],
                   *[F.coalesce(F.sum(F.col("n") * F.col(f"m_{s}")) / F.sum("n"), F.lit(0.0)).alias(f"m_{s}") for s in STATS])
    prior = pool.select(F.struct("*")).scalar()
    smooth = {f"m_{s}": (F.col("n") * F.col(f"m_{s}") + CENTRE_ROWS * prior[f"m_{s}"]) / (F.col("n") + CENTRE_ROWS) for s in STATS}
    for a, b in pairs:
        name = f"c_{a}_{b}"
        mixed = (F.col("n") * F.col(name) + PRIOR_ROWS * prior[name]) / (F.col("n") + PRIOR_ROWS) * factor
        smooth[name] = mixed + (FLOORS[a] ** 2 if a == b else 0.0)
    return written(_inverse(own.withColumns(smooth)), "quality-fit")


def _start(rows: DataFrame) -> DataFrame:
    """Distances for the first subset: medians and median absolute deviations, per statistic."""
    by = ["g_lang", "g_source"]
    mid = written(rows.groupBy(*by).agg(*[F.percentile_approx(s, 0.5, 1000).alias(f"a_{s}") for s in STATS]),
                  "quality-median")
    off = rows.join(mid, by).withColumns({f"o_{s}": F.abs(F.col(s) - F.col(f"a_{s}")) for s in STATS})
    mad = written(off.groupBy(*by).agg(*[F.percentile_approx(f"o_{s}", 0.5, 1000).alias(f"b_{s}") for s in STATS]),
                  "quality-mad")
    z = [F.pow(F.col(f"o_{s}") / (1.4826 * F.col(f"b_{s}") + FLOORS[s]), 2.0) for s in STATS]
    return off.join(mad, by).withColumn("d2", sum(z[1:], z[0])).select(*rows.columns, "d2")


def _subset(rows: DataFrame) -> DataFrame:
    """Rows within the group's SUBSET quantile of the distance."""
    by = ["g_lang", "g_source"]
    cut = written(rows.groupBy(*by).agg(F.percentile_approx("d2", SUBSET, 2000).alias("cut")), "quality-cut")
    return rows.join(cut, by).where(F.col("d2") <= F.col("cut")).drop("cut", "d2")


def _keyed(figures: DataFrame, lang: Column, source: Column) -> DataFrame:
    none = F.lit("\x00")
    return _vector(figures.withColumns({
        "base_failed": base_failed(), "g_lang": F.coalesce(lang, none), "g_source": F.coalesce(source, none)}))


def group_fits(figures: DataFrame) -> DataFrame:
    """MCD fits per language and source.  ``figures`` is scanned several times: pass a written table."""
    rows = (_keyed(figures, F.col("lang"), F.col("source")).where(~F.col("base_failed"))
            .select("g_lang", "g_source", *STATS))
    near, fit = _start(rows), None
    for _ in range(STEPS):
        fit = _fit(_subset(near), CONSISTENCY)
        near = _distance(rows, fit)
    return fit


def judged(figures: DataFrame, fit: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """Add base_failed, distance and kept to a table of text figures."""
    out = _distance(_keyed(figures, F.col(lang), F.col(source)), fit)
    # one comparison over both sides of the join: a filter on it stays above the join, and the
    # planner does not copy the figures' expressions into a predicate below it
    reach = F.when(F.col("base_failed"), F.lit(float("inf"))).otherwise(F.coalesce(F.col("d2"), F.lit(0.0)))
    return out.withColumn("kept", reach <= CUTOFF).withColumnRenamed("d2", "distance").drop("g_lang", "g_source", *STATS)


def quality_table(docs: DataFrame) -> DataFrame:
    """doc_id, base figures, base_failed, kept and distance of every document.

    The texts are read once; the figures are written and all fits work on them.
    """
    figures = written(text_figures(docs.select("doc_id", "lang", "source", "text")).drop("text"), "quality-figures")
    return judged(figures, group_fits(figures))


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that pass, with all their columns.

    The fits come from a narrow table of figures; a second pass over the texts applies them
    where the rows are, so no text is shuffled.
    """
    narrow = text_figures(docs.select("lang", "source", "text")).drop("text")
    fit = group_fits(written(narrow, "quality-figures"))
    rows = text_figures(docs.select(row_struct(docs)), "row.text")
    kept = judged(rows, fit, "row.lang", "row.source").where("kept")
    return kept.select(*unpacked(kept, docs.columns))
