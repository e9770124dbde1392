import random
from hashlib import sha256

from pyspark.sql import functions as F

from listing_lake.llm import chat
from listing_lake.llm.common import table

SF = "/root/testdata/sf0.001"


def digest(text):
    return sha256(text.encode()).hexdigest()


def expected(rows):
    """What reading back must give, from the rows themselves."""
    by: dict = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    found = {}
    for conv, turns in by.items():
        turns.sort()
        learned = "".join(t for *_, r, t in turns if r == "assistant")
        told = "".join(f"{r}\n{t}\n" for *_, r, t in turns)
        found[conv] = (len(turns), digest(told), len(learned), digest(learned))
    return found


def read_back(frame):
    return {
        r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256)
        for r in chat.digests(chat.render(frame)).collect()
    }


def test_escapes_are_reversible_and_leave_no_control_string(spark):
    rng, bits = random.Random(5), [*chat.DEFAULT.control, "\\", "\\e", "\\a", "\\b", "<", "[", "|", ">", "x", "\n", "é"]
    texts = ["".join(rng.choices(bits, k=rng.randint(0, 9))) for _ in range(1500)]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    escaped = chat.escape(F.col("t"))
    for r in frame.select("t", escaped.alias("e"), chat.unescape(escaped).alias("back")).collect():
        assert r.back == r.t
        assert not any(c in r.e for c in chat.DEFAULT.control)


def test_documents_and_probe(spark):
    rows = [tuple(r) for r in table(spark, SF, "conversations").select("conv_id", "turn", "role", "text").collect()]
    probe = [(chat.PROBE_ID, n, r, chat.PROBE) for n, r in enumerate(("user", "assistant"))]
    assert read_back(chat.with_probe(spark, SF)) == expected(rows + probe)


def test_odd_rows(spark):
    rows = [
        (1, None, "user", "a"), (1, 2, None, None), (2, 0, "user", "x"), (2, 0, "user", "x"), (2, 1, "assistant", ""),
        (None, 0, "system", "<|turn|>"), (3, 0, "odd <|body|>\nrole", "<|end|>\n"), (4, 0, "assistant", "[" * 50_000),
        (5, 0, "user", "<"), (5, 1, "assistant", "\\"), (5, 2, "assistant", "</s>\\l"),
    ]
    frame = spark.createDataFrame([(*r, "z") for r in rows], "conv_id long, turn long, role string, text string, turns string")
    assert read_back(frame) == expected(rows)
    assert read_back(frame.limit(0)) == {}


def test_turn_order(spark):
    orders = {
        1: ["system", "user", "assistant"], 2: ["user", "assistant", "user", "assistant"], 3: ["user"],
        4: ["assistant"], 5: ["user", "user", "assistant"], 6: ["system", "assistant"], 7: ["user", "system", "x"],
    }
    rows = [(c, n, r, "t") for c, roles in orders.items() for n, r in enumerate(roles)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = {r.conv_id: r.wrong_turn for r in chat.render(frame).collect()}
    assert found == {1: None, 2: None, 3: 1, 4: 0, 5: 1, 6: 1, 7: 1}


def test_segments_and_flags(spark):
    frame = spark.createDataFrame([(1, 0, "user", "hi"), (1, 1, "assistant", "<s>")], "conv_id long, turn long, role string, text string")
    row = chat.render(frame).first()
    assert [(s.text, s.loss) for s in row.segments if s.loss] == [("\\as>", True)]
    assert row.formatted == "<|turn|>user<|body|>hi<|end|>\n<|turn|>assistant<|body|>\\as><|end|>\n"


def test_runs_without_python(spark):
    plan = chat.digests(chat.render(chat.with_probe(spark, SF)))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
