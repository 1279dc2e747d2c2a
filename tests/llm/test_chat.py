import random

from pyspark.sql import functions as F

from tidemark.llm import chat as C


def conversations():
    rng = random.Random(8)
    parts = [*C.CONTROL, "\\", "\\\\", "<", "<\\|im_end|>", "<\\\\s>", "[", "\n", " ", "é", "ok", "", "user\n", "]"]
    text = lambda: "".join(rng.choices(parts, k=rng.randrange(6)))
    rows = []
    for conv in range(40):
        for turn in range(rng.randrange(1, 9)):
            rows.append((conv, turn, rng.choice(["user", "assistant", "assistant", "system", "tool\n<s>", "", "a b%"]), text()))
    return rows + [(50, 0, "user", None), (50, 1, "assistant", None), (51, 0, None, "x"), (None, 3, "assistant", "late"), (None, None, "user", "first"),
                   (52, 0, "assistant", "same"), (52, 0, "assistant", "same"), (53, 0, "assistant", "<s>" * 100_000)] + [(54, i, "assistant", f"t{i}") for i in range(300)]


def test_examples_hold_every_turn_and_reply(spark):
    rows = conversations()
    frame = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string").withColumn("id", F.lit(7)).withColumn("pieces", F.lit("x"))
    made = C.examples(frame)
    read = made.select("*", C.read_turns(F.col("formatted")).alias("turns"), C.target_text(F.col("formatted"), F.col("loss_start"), F.col("loss_chars")).alias("loss")).collect()
    by_conv = {}
    for r in sorted(read, key=lambda r: r.target):
        by_conv.setdefault(r.id, []).append(r)
    for conv in {r[0] for r in rows}:
        order = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
        turns = [(r[2] or "", r[3] or "") for r in sorted((r for r in rows if r[0] == conv), key=order)]
        own = by_conv[conv]
        assert [(t.role, t.text) for t in own[-1].turns] == turns
        assert [r.loss for r in own if r.loss is not None] == [t for role, t in turns if role == "assistant"]
        for r in own:
            assert [(t.role, t.text) for t in r.turns] == turns[:r.target + 1] and r.whole == (r.target == len(turns) - 1)
            body = r.formatted.replace(C.START, "").replace(C.END, "")
            assert not any(mark in body for mark in C.CONTROL)
    assert len(by_conv) == len({r[0] for r in rows})


def test_empty_table_and_plan_without_python(spark):
    made = C.examples(spark.createDataFrame([], "conv_id int, turn int, role string, text string"))
    assert made.count() == 0
    plan = C.examples(spark.range(1).select(F.lit(1).alias("conv_id"), F.lit(1).alias("turn"), F.lit("a").alias("role"), F.lit("b").alias("text")))
    assert "Python" not in plan._jdf.queryExecution().toString()
