"""Secret scans (operator 2, DataFrame functions only): patterns plus a randomness test battery.

Base spans come from three patterns.  Positions are found inside the row: the lengths of the
matches and of the gaps between them (``split`` by the same pattern) are summed up.  The
patterns run only on texts that one cheap search each says may hold a match.

The method adds spans of kind ``random``: unbroken runs of at least ``MIN_TOKEN`` characters
that could be base64, base62, hex, or letters of one case with or without digits (all ten or base32's), and
touch no base span.  For each the encoding is inferred from its characters, and three tests ask whether it is
uniformly random in that alphabet: a chi-squared test of its character counts, a runs test of upper against lower half
of the alphabet and a lag-1 serial correlation about the run's own mean.  A run that fails them (Bonferroni) is no
secret.  Against false discoveries, its chi-squared statistic is also held against natural
language of the same length (a non-central chi-squared law whose excess grows with length), and the
mean log share of its letters against that of running text: short runs can hardly reach a small probability, long ones easily.  Benjamini and Hochberg's
step-up rule, over all documents and for each encoding and length class of its own, sets the
threshold, so the share of words or names among the added spans is at most ``FDR``.

Scale: one pass over the texts, nothing but spans is kept (a narrow written table); the
threshold needs counts per class and probability bin, a table of fixed size.

Defined cases: a null text is empty; overlapping kinds are all reported; rows that repeat are
scanned alike; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import text_of, written

# The patterns of the contract; the order of kinds is that of the contract.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{16,}+"
KINDS = ["assign", "access", "hex", "random"]
MIN_VALUE = 12

#: Shortest run that the tests look at; below, no test can tell chance from language.
MIN_TOKEN = 20
TOKEN = r"(?<![A-Za-z0-9+/_\x00-])[A-Za-z0-9+/_-]{%d,}+(?!\x00)={0,2}" % MIN_TOKEN
#: Least combined probability of the three tests for a run to pass as random.
MIN_RANDOM = 1e-4
#: Greatest share of false discoveries among the added spans.
FDR = 0.01
#: Chance that two characters of non-random text are equal (index of coincidence), by encoding:
#: letters of natural language; in hex only digits and six letters are left of it.
COINCIDENCE = {"hex": 0.15, "letters": 0.07, "base32": 0.07, "base36": 0.065, "base62": 0.065, "base64": 0.065}
# Shares (in per mille) of the letters a to z in running text, about the mean of five western European languages.
LETTER_SHARES = [89, 14, 32, 42, 145, 12, 16, 30, 74, 4, 7, 46, 27, 76, 60, 25, 8, 65, 70, 67, 45, 14, 9, 3, 8, 8]
_LOG_SHARES = [math.log(x / sum(LETTER_SHARES)) for x in LETTER_SHARES]
#: Mean and deviation of a letter's log share in text, with room for other languages and identifiers.
TEXT_MEAN = sum(x / sum(LETTER_SHARES) * y for x, y in zip(LETTER_SHARES, _LOG_SHARES)) - 0.1
TEXT_DEVIATION = math.sqrt(sum(x / sum(LETTER_SHARES) * (y - TEXT_MEAN - 0.1) ** 2 for x, y in zip(LETTER_SHARES, _LOG_SHARES)))
#: Least letters of a run for its letters' shares to count.
MIN_LETTERS = 12
#: Probability bins are a tenth of a power of ten wide, down to 10^-300.
BINS, LAST_BIN = 10, 3000

# The alphabets of the encodings, in the order of their codes; those of one case are folded to lower case.
ALPHABETS = {"hex": "0123456789abcdef", "letters": "abcdefghijklmnopqrstuvwxyz", "base32": "abcdefghijklmnopqrstuvwxyz234567",
             "base36": "0123456789abcdefghijklmnopqrstuvwxyz",
             "base62": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
             "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"}
#: Which encoding a run is tested as: the first whose pattern it fits.
INFERRED = {"hex": "^[0-9a-fA-F]+$", "letters": "^(?:[a-z]+|[A-Z]+)$", "base32": "^(?:[a-z2-7]+|[A-Z2-7]+)$",
            "base36": "^(?:[a-z0-9]+|[A-Z0-9]+)$", "base62": "^[A-Za-z0-9]+$", "base64": "^.*$"}
FOLDED = ["hex", "letters", "base32", "base36"]


def _let(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it several times inside ``body``."""
    return F.transform(F.array(value), body)[0]


def _running(values: str, chunk: int = 256) -> Column:
    """Inclusive running sums of an array column, in chunks, so long arrays are not copied for each element."""
    v, zero = F.col(values), F.lit(0).cast("long")
    empty = F.array().cast("array<bigint>")
    piece = lambda c: F.slice(v, c * chunk + 1, F.lit(chunk))
    chunks = F.when(F.size(v) > 0, F.sequence(F.lit(0), F.floor((F.size(v) - 1) / chunk).cast("int"))).otherwise(
        F.array().cast("array<int>"))
    totals = F.transform(chunks, lambda c: F.aggregate(piece(c), zero, lambda a, x: a + x))
    before = F.aggregate(
        totals, F.struct(zero.alias("s"), empty.alias("out")),
        lambda a, x: F.struct((a["s"] + x).alias("s"), F.concat(a["out"], F.array(a["s"])).alias("out")), lambda a: a["out"])
    return F.flatten(F.transform(before, lambda start, c: F.aggregate(
        piece(c), F.struct(start.alias("s"), empty.alias("out")),
        lambda a, x: F.struct((a["s"] + x).alias("s"), F.concat(a["out"], F.array(a["s"] + x)).alias("out")),
        lambda a: a["out"])))


def _blanked(df: DataFrame, pattern: str, hit: Column, group: int = 0, least: int = 0) -> DataFrame:
    """``rest`` with every match of ``pattern`` (of ``least`` characters in its group) as NUL characters; linear in the text."""
    p = F.lit(pattern)
    df = df.withColumns({"b_m": F.when(hit, F.regexp_extract_all("rest", p, F.lit(0))), "b_v": F.when(hit, F.regexp_extract_all("rest", p, F.lit(group))),
                         "b_g": F.when(hit, F.split("rest", pattern, -1))})
    shown = F.zip_with("b_m", "b_v", lambda m, v: F.when(F.length(v) >= least, F.repeat(F.lit("\0"), F.length(m))).otherwise(m))
    rest = F.array_join(F.zip_with("b_g", shown, lambda g, m: F.concat(g, F.coalesce(m, F.lit("")))), "")
    return df.withColumn("rest", F.when(hit, rest).otherwise(F.col("rest"))).drop("b_m", "b_v", "b_g")


def _with_spans(df: DataFrame, name: str, pattern: str, hit: Column, group: int = 0, text: str = "t") -> DataFrame:
    """Add ``name``: an array of (start, end, value) in code points, of every match of ``pattern`` in ``text``."""
    none = F.array().cast("array<string>")
    p = F.lit(pattern)
    found = F.when(hit, F.regexp_extract_all(text, p, F.lit(0))).otherwise(none)
    value = F.when(hit, F.regexp_extract_all(text, p, F.lit(group))).otherwise(none)
    gaps = F.when(hit, F.split(text, pattern, -1)).otherwise(none)
    df = df.withColumns({f"{name}_m": found, f"{name}_v": value, f"{name}_g": gaps})
    lengths = F.zip_with(F.slice(f"{name}_g", 1, F.size(f"{name}_m")), f"{name}_m",
                         lambda g, m: (F.length(g) + F.length(m)).cast("long"))
    df = df.withColumn(f"{name}_l", lengths)
    df = df.withColumn(f"{name}_e", _running(f"{name}_l"))
    spans = F.transform(F.arrays_zip(F.col(f"{name}_m").alias("m"), F.col(f"{name}_v").alias("v"), F.col(f"{name}_e").alias("e")),
                        lambda x: F.struct((x["e"] - F.length(x["m"])).alias("start"), x["e"].alias("end"), x["v"].alias("value")))
    return df.withColumn(name, spans).drop(*[f"{name}_{c}" for c in "mvgle"])


def _upper_tail(z: Column) -> Column:
    """P(standard normal > z), to a third of a percent relatively (Borjesson and Sundberg's form)."""
    x = F.abs(z)
    tail = F.exp(-x * x / 2) / 2.5066282746310002 / (0.661 * x + 0.339 * F.sqrt(x * x + 5.51))
    return F.when(z >= 0, tail).otherwise(1 - tail)


def _tested(span: Column) -> Column:
    """(start, end, class, bin, random) of a run: the test battery."""
    raw = F.rtrim(span["value"], F.lit("="))
    encoding = F.coalesce(*[F.when(F.regexp_like(raw, F.lit(fits)), name) for name, fits in INFERRED.items()])

    def battery(x: Column) -> Column:
        token, k, alphabet = x["token"], x["k"], x["alphabet"]
        n = F.length(token).cast("double")
        codes = F.filter(F.split(token, ""), lambda c: c != "")
        ranks = F.transform(codes, lambda c: F.instr(alphabet, c).cast("double"))
        squares = F.aggregate(F.split(alphabet, ""), F.lit(0.0), lambda a, c: a + F.when(c == "", 0.0).otherwise(
            F.pow((n - F.length(F.replace(token, c, F.lit("")))), F.lit(2.0))))
        halves = F.array_join(F.transform(ranks, lambda r: F.when(r > (k + 1) / 2, "1").otherwise("0")), "")

        def centred(y: Column) -> Column:  # ranks about the token's own mean
            own = F.transform(y["ranks"], lambda r: r - y["mean"])
            return _let(own, lambda r: F.struct(
                F.aggregate(r, F.lit(0.0), lambda a, b: a + b * b).alias("square"),
                F.aggregate(F.zip_with(F.slice(r, 1, F.greatest(F.size(r) - 1, F.lit(0))), F.slice(r, 2, F.greatest(F.size(r), F.lit(1))),
                                       lambda a, b: a * b), F.lit(0.0), lambda a, b: a + F.coalesce(b, F.lit(0.0))).alias("lag")))

        at = F.filter(F.transform(F.split(F.lower(raw), ""), lambda c: F.when(c == "", 0).otherwise(F.instr(F.lit("abcdefghijklmnopqrstuvwxyz"), c))), lambda i: i > 0)
        shares = F.transform(at, lambda i: F.element_at(F.array(*[F.lit(x) for x in _LOG_SHARES]), i))
        mean = F.aggregate(ranks, F.lit(0.0), lambda a, b: a + b) / n
        return _let(F.struct(
            n.alias("n"), k.cast("double").alias("k"), x["same"].alias("same"), shares.alias("shares"), (squares * k / n - n).alias("chi"), halves.alias("bits"),
            _let(F.struct(ranks.alias("ranks"), mean.alias("mean")), centred).alias("serial")), verdict)

    def verdict(s: Column) -> Column:
        n, k, chi = s["n"], s["k"], s["chi"]
        ones = F.length(F.replace(s["bits"], F.lit("0"), F.lit(""))).cast("double")
        both = 2 * ones * (n - ones)
        runs = F.length(F.regexp_replace(s["bits"], r"(.)\1+", "$1")).cast("double")
        z_chi = (F.pow(F.greatest(chi, F.lit(0.0)) / (k - 1), F.lit(1 / 3)) - (1 - 2 / (9 * (k - 1)))) / F.sqrt(2 / (9 * (k - 1)))
        z_runs = F.when(both > n, (runs - both / n - 1) / F.sqrt(both * (both - n) / (n * n * (n - 1)))).otherwise(99.0)
        z_lag = F.when(s["serial"]["square"] > 0, (s["serial"]["lag"] / s["serial"]["square"] + 1 / n) * F.sqrt(n)).otherwise(99.0)
        p = F.least(_upper_tail(z_chi), 2 * _upper_tail(F.abs(z_runs)), 2 * _upper_tail(F.abs(z_lag)))
        excess = n * (k * s["same"] - 1)
        z_text = (chi - (k - 1 + excess)) / F.sqrt(2 * (k - 1) + 4 * excess)
        letters = F.size(s["shares"]).cast("double")
        z_letters = (F.aggregate(s["shares"], F.lit(0.0), lambda a, b: a + b) / letters - TEXT_MEAN) / TEXT_DEVIATION * F.sqrt(letters)
        like_letters = F.when(letters >= MIN_LETTERS, _upper_tail(-z_letters)).otherwise(1.0)
        # a text shows in equal characters and in common letters; either may tell that a run is none
        like_text = F.least(F.lit(1.0), 2 * F.least(_upper_tail(-z_text), like_letters))
        return F.struct((3 * p > MIN_RANDOM).alias("random"),
                        F.least(F.floor(-F.log10(F.greatest(like_text, F.lit(1e-300))) * BINS), F.lit(LAST_BIN)).cast("int").alias("bin"),
                        F.floor(2 * F.log2(n)).cast("int").alias("size"))

    def with_encoding(enc: Column) -> Column:
        pick = lambda make: F.coalesce(*[F.when(enc == e, make(e)) for e in ALPHABETS])
        token = F.when(enc.isin(FOLDED), F.lower(raw)).otherwise(F.translate(raw, "-_", "+/"))
        tested = _let(F.struct(token.alias("token"), pick(lambda e: F.lit(COINCIDENCE[e])).alias("same"), pick(lambda e: F.lit(len(ALPHABETS[e]))).alias("k"),
                               pick(lambda e: F.lit(ALPHABETS[e])).alias("alphabet")), battery)
        return _let(tested, lambda r: F.struct(
            span["start"].alias("start"), span["end"].alias("end"), F.concat_ws(":", enc, r["size"]).alias("class"),
            r["bin"].alias("bin"), r["random"].alias("random")))

    return _let(encoding, with_encoding)


def _rendered(spans: Column) -> Column:
    """kind:start:end, comma-joined, by start and then kind."""
    return F.array_join(F.transform(F.sort_array(spans), lambda s: F.concat_ws(
        ":", F.element_at(F.array(*[F.lit(k) for k in KINDS]), s["kind"] + 1), s["start"], s["end"])), ",")


def _kind(spans: str, kind: str) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), s["end"].alias("end")))


def scanned(docs: DataFrame) -> DataFrame:
    """doc_id, ``base`` spans by kind, and tested ``runs`` of every text (one pass, no shuffle)."""
    df = docs.select("doc_id", text_of().alias("t"))
    hits = {"assign": F.regexp_like("t", F.lit(r"""(?i)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]""")),
            "access": F.contains("t", F.lit("AKIA")), "hex": F.regexp_like("t", F.lit(HEX))}
    df = _with_spans(df, "assign", ASSIGN, hits["assign"], 1)
    df = _with_spans(df, "access", ACCESS, hits["access"])
    df = _with_spans(df, "hex", HEX, hits["hex"])
    # runs that touch a base span are no further finds: base spans are blanked, and runs beside a blank don't match
    df = df.withColumn("rest", F.translate("t", "\0", " "))
    df = _blanked(df, ASSIGN, hits["assign"], 1, MIN_VALUE)
    df = _blanked(df, ACCESS, hits["access"])
    df = _blanked(df, HEX, hits["hex"])
    df = _with_spans(df, "token", TOKEN, F.regexp_like("rest", F.lit(TOKEN)), text="rest")
    df = df.withColumn("assign", F.filter("assign", lambda s: F.length(s["value"]) >= MIN_VALUE))
    base = F.concat(*[_kind(k, k) for k in KINDS[:3]])
    return df.select("doc_id", base.alias("base"), F.transform("token", _tested).alias("runs"))


def thresholds(runs: DataFrame) -> DataFrame:
    """(class, bin): per class the lowest bin that keeps the false discovery rate (step-up rule over all runs)."""
    bins = runs.select(F.explode("runs").alias("r")).groupBy("r.class", "r.bin").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("r.random").alias("passed"))
    by = Window.partitionBy("class")
    beyond = by.orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ruled = bins.select("class", "bin", F.sum("n").over(by).alias("all"), F.sum("passed").over(beyond).alias("found"))
    return ruled.where(F.col("all") * F.pow(F.lit(10.0), -F.col("bin") / BINS) <= FDR * F.col("found")).groupBy("class").agg(
        F.min("bin").alias("bin"))


def find_secrets(docs: DataFrame) -> DataFrame:
    """doc_id, ``base`` and ``added``: arrays of (start, kind, end) of every document."""
    rows = written(scanned(docs), "secret-spans")
    rule = thresholds(rows).agg(F.map_from_entries(F.collect_list(F.struct("class", "bin"))).alias("rule")).scalar()
    passed = F.filter("runs", lambda r: r["random"] & F.coalesce(r["bin"] >= F.element_at(F.col("rule"), r["class"]), F.lit(False)))
    return rows.withColumn("rule", rule).withColumn("passed", passed).select(
        "doc_id", "base", _kind("passed", "random").alias("added"))


def secret_table(docs: DataFrame) -> DataFrame:
    """doc_id, counts of base spans, their digest, all spans and the number of added ones."""
    found = find_secrets(docs)
    n = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == KINDS.index(kind))).cast("long")
    return found.select(
        "doc_id", *[n(k).alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(_rendered(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        _rendered(F.concat("base", "added")).alias("spans"), F.size("added").cast("long").alias("n_random"))
