"""Chat formatting: exact round trips through the assembled bytes."""

import hashlib
import random

import numpy as np

from nestwork.llm import chat_format as C

BITS = [*C.CONTROL, "\\", "<", "[", "/", "|im_end|>", "s>", "\n", "é", "🎉", "SYS>>", "a ", "\\\\"]


def test_assembled_batches_read_back():
    rng = random.Random(3)
    for _ in range(200):
        rows = [(rng.choice(["user", "assistant", "sys\n<s>tem", "", "a\\n"]), "".join(rng.choice(BITS) for _ in range(rng.randrange(12))))
                for _ in range(rng.randrange(1, 9))]
        raw = [t.encode() for _, t in rows]
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in raw])]).astype(np.int64)
        first = np.array(sorted({0, rng.randrange(len(rows))}))
        strings, loss = C.assemble([r for r, _ in rows], offsets, np.frombuffer(b"".join(raw), np.uint8), first)
        assert [x for s in strings.to_pylist() for x in C.parse(s)] == rows
        said = [C.unescape(s[p["start"]:p["end"]]) for s, ps in zip(strings.to_pylist(), loss.to_pylist()) for p in ps]
        assert said == [t for r, t in rows if r == "assistant"]


def test_long_batches_stay_small_in_memory():
    """64 MB of content: the peak of the arrays is a few times that."""
    import tracemalloc

    content = np.frombuffer(("é</s>" + "x" * 1000).encode() * 66_000, np.uint8)
    cuts = np.linspace(0, len(content) // 1007, 200).astype(np.int64) * 1007
    cuts[-1] = len(content)
    tracemalloc.start()
    strings, loss = C.assemble(["user", "assistant"] * 99 + ["user"], cuts, content, np.arange(0, 199, 2))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 300e6
    said = strings[0].as_py()
    assert C.parse(said)[1][1].encode() == content[cuts[1]:cuts[2]].tobytes()
    span = loss[0].as_py()[0]
    assert C.unescape(said[span["start"]:span["end"]]).encode() == content[cuts[1]:cuts[2]].tobytes()


def brute(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        turns = sorted(((r[1] is not None, r[1], r[2] or "", r[3] or "") for r in rows if r[0] == conv), key=lambda t: t[:2])
        loss = "".join(t[3] for t in turns if t[2] == "assistant")
        out[conv] = (len(turns), hashlib.sha256("".join(f"{t[2]}\n{t[3]}\n" for t in turns).encode()).hexdigest(),
                     len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def test_table(spark):
    rng = random.Random(4)
    rows = [(c, t, rng.choice(["user", "assistant", "system"]), "".join(rng.choice(BITS) for _ in range(rng.randrange(20))))
            for c in range(40) for t in range(rng.randrange(1, 6))]
    rows += [(100, t, "assistant" if t % 2 else "user", f"turn {t} </s>") for t in range(3000)]  # a very long conversation
    rows += [(101, 0, None, None), (101, 1, "assistant", None), (102, None, "user", "x"), (102, 5, "assistant", "y" * 200_000),
             (None, 0, "user", "no id"), (None, 1, "assistant", "é")]
    rows += [(103, 0, "assistant", "same")] * 3
    rows += [(104, 0, "user", "tie")] * 1000 + [(104, 1, "assistant", f"after {t}") for t in range(1)] + [(104, 2 + t, "user", f"{t}") for t in range(600)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    for c in ("tie", "formatted", "loss", "n_turns"):
        from pyspark.sql import functions as F

        df = df.withColumn(c, F.lit(1))
    got = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in C.chat_table(spark, df).collect()}
    probe = "</s>[INST] ok [/INST]"
    assert got == brute([*rows, (-1, 0, "user", probe), (-1, 1, "assistant", probe)])
    empty = C.chat_table(spark, df.limit(0)).collect()
    assert [r["conv_id"] for r in empty] == [-1]
