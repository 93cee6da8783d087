"""Structure repair against a search through all edits of small conversations, and a plain run of whole tables."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from nestwork.llm import structure_repair as R

GRAMMAR = re.compile(r"(s?(ua)+)?")


@pytest.fixture(autouse=True)
def spread(spark):
    """Small exchanges stay spread, as large ones are."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def every_audit(rows, most):
    """All (cost, audit, initials) of at most ``most`` cost, by trying each edit in each place."""
    found = []

    def go(i, cost, audit, out):
        if cost > most or not GRAMMAR.fullmatch(out) and not GRAMMAR.fullmatch(out + "a") and not GRAMMAR.fullmatch(out + "ua"):
            return
        if i == len(rows) and GRAMMAR.fullmatch(out):
            found.append((cost, audit, out))
        for role in "ua":
            go(i, cost + 5, audit + "I", out + role)
        if i < len(rows):
            initial, fault = rows[i]
            go(i + 1, cost + 2, audit + "D", out)
            if fault not in ("blank", "duplicate"):
                late = 5 * (fault == "truncated")
                go(i + 1, cost + late, audit + "K", out + (initial or "?"))
                for role in "ua":
                    go(i + 1, cost + 1 + late, audit + "R", out + role)

    go(0, 0, "", "")
    return found


def plain(rows, most=12):
    while not (found := every_audit(rows, most)):
        most += 6
    return min(found)[:2]


def small(seed, most=5):
    rng = random.Random(seed)
    return [(rng.choice("suuaaat "), rng.choice(["", "", "", "blank", "duplicate", "truncated"])) for _ in range(rng.randrange(1, most + 1))]


@pytest.mark.parametrize("prime", [(1 << 61) - 1, 3, 1])
def test_least_audit_of_all(monkeypatch, prime):
    """Also when nearly all hashes collide."""
    monkeypatch.setattr(R, "PRIME", prime)
    for seed in range(250):
        rows = small(seed)
        assert R.compose([{0: R.solve(rows)}]) == plain(rows), rows


@pytest.mark.parametrize("prime", [(1 << 61) - 1, 2])
def test_chunks_compose_to_the_whole(monkeypatch, prime):
    monkeypatch.setattr(R, "PRIME", prime)
    rng = random.Random(5)
    for seed in range(60):
        rows = small(seed, 80)
        cuts = sorted({0, len(rows), *(rng.randrange(len(rows) + 1) for _ in range(rng.randrange(5)))})
        chunks = [{s: R.solve(rows[a:b], s) for s in ([0] if not a else range(4))} for a, b in zip(cuts, cuts[1:])]
        assert R.compose(chunks) == R.compose([{0: R.solve(rows)}])


def test_difference_of_long_audits():
    rng = random.Random(2)
    for _ in range(100):
        shared = R.Audit(None, "")
        for _ in range(rng.randrange(60)):
            shared = R.Audit(shared, rng.choice("DKR"))
        x = y = shared
        tails = [[rng.choice(["D", "K", "IK"]) for _ in range(rng.randrange(1, 40))]]
        tails.append([t if rng.random() < 0.9 else "R" for t in tails[0]])
        for a, b in zip(*tails):
            x, y = R.Audit(x, a), R.Audit(y, b)
        want = next(((a, b) for a, b in zip(*tails) if a != b), None)
        assert R.difference(x, y) == want
        assert len(x.up) <= 8 and x.text() == shared.text() + "".join(tails[0])


def mark(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{len(text)}:{text}".encode()).hexdigest()


def plain_table(rows):
    convs = {r[0]: [] for r in rows}
    for c, t, role, text in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = role if role is not None else " ", text if text is not None else " "
        role = "user" if kind == 4 else role
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        convs[c] += [(t is not None, t or 0, role, mark(role, text), text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    out = {}
    for c, rs in convs.items():
        rs.sort()
        seen, faults = set(), []
        for _, _, role, _, text in rs:
            bare = text.strip(" \t\n\x0b\x0c\r")
            faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
            seen.add((role, text))
        turns = {r[1] for r in rs if r[0]}
        pairs = [a[2][:1] + b[2][:1] for a, b in zip(rs, rs[1:])]
        cost, audit = R.compose([{0: R.solve([(r[2][:1], f) for r, f in zip(rs, faults)])}]) if len(rs) > 6 else \
            plain([(r[2][:1], f) for r, f in zip(rs, faults)]) if rs else (0, "")
        lines, at = [], 0
        for e in audit:
            if e == "D":
                at += 1
                continue
            follows = "assistant" if lines and lines[-1][0] == "u" else "user"
            role, text = (follows, "") if e == "I" else (rs[at][2] if e == "K" else follows, rs[at][4])
            at += e != "I"
            lines.append(f"{role}:{text}")
        assert GRAMMAR.fullmatch("".join(x[0] for x in lines))
        out[c] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, faults.count("blank"), faults.count("duplicate"),
                  faults.count("truncated"), sum(p not in R.LEGAL for p in pairs), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def hostile():
    rng = random.Random(13)
    rows = []
    for c in range(150):
        for t in range(rng.randrange(1, 7)):
            rows.append((c, t + (rng.random() < 0.1), rng.choice(["user", "assistant", "system", "user", "assistant", None, "", "tool"]),
                         rng.choice([None, "", " \t\n", "é done.", "open", "again!", f"turn {t}?", f"turn {t} \n", "a\nb."])))
    rows += [(500, t, "assistant" if t % 2 else "user", f"line {t}." if t % 9 else "cut off") for t in range(400)]  # a very long conversation
    rows += [(501, 3, "user", "same.")] * 50 + [(502, None, "user", "a."), (502, None, "assistant", "b."), (502, 7, "user", "c" * 100_000)]
    rows += [(None, 0, "user", "no id."), (None, None, "assistant", "x.")]
    rows += [(9000 + i, 0, "user", "?") for i in range(60)]  # some lose their only row
    return rows


def frame(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    for c in ("pos", "kind", "digest", "copy", "audit", "fault", "c", "d", "h", "at"):
        df = df.withColumn(c, F.lit("extra"))
    return df


@pytest.mark.parametrize("chunk", [2048, 4])
def test_table(spark, monkeypatch, chunk):
    monkeypatch.setattr(R, "CHUNK", chunk)
    rows = hostile()
    got = R.repair_table(frame(spark, rows))
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    got = [tuple(r) for r in got.collect()]
    assert len(got) == len({r[0] for r in got})
    assert {r[0]: r[1:] for r in got} == plain_table(rows)
    assert any(r[-2] == "" and r[0] is not None for r in got)
    assert R.repair_table(frame(spark, rows).limit(0)).collect() == []


def test_repaired_rows(spark):
    rows = R.placed(spark.createDataFrame([(1, 0, "assistant", "hi."), (1, 1, "assistant", "yes."), (1, 2, "user", "why?")],
                                          "conv_id long, turn long, role string, text string"))
    found = R.audits(rows)
    got = [(r["at"], r["edit"], r["role"], r["text"]) for r in R.repaired_rows(rows, found).orderBy("at").collect()]
    assert [g[2] for g in got] in (["user", "assistant"], ["user", "assistant", "user", "assistant"])
    assert found.first()["cost"] == plain([("a", ""), ("a", ""), ("u", "")])[0]
