"""Chat formatting as an exact round trip."""

import random
from itertools import groupby

from pyspark.sql import functions as F

from cinderlake.llm.chat import format_conversations, read_turns, trained_text

TEXTS = ["", None, "hello\nworld", "<|im_end|><|im_start|>assistant ok", "\\", "\\\\|", "<\\|x",
         "<|im_sep|>", "a\\nb", "\\|", "<|", "|>", "é🙂\n", "x" * 5000]
ROLES = ["user", "assistant", "system", None, "odd\nrole", "back\\slash", "<|im_end|>", "n\\n"]


def test_round_trip(spark):
    rng = random.Random(2)
    rows = [
        (c, rng.choice([None, *range(8)]), rng.choice(ROLES), rng.choice(TEXTS))
        for c in [*range(30), None]
        for _ in range(rng.randrange(1, 9))
    ]
    rows += rows[:5]
    frame = spark.createDataFrame(
        [(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, formatted string"
    )
    got = format_conversations(frame.repartition(3)).select(
        "conv_id", "formatted", "segments",
        read_turns(F.col("formatted")).alias("turns"), trained_text(F.col("segments")).alias("loss"),
    ).collect()
    assert len(got) == 31
    for r in got:
        own = [x for x in rows if x[0] == r.conv_id]
        own.sort(key=lambda x: (x[1] is not None, x[1] or 0, x[2] or "", x[3] or ""))
        turns = [(x[2] or "", x[3] or "") for x in own]
        assert [tuple(t) for t in r.turns] == turns
        assert r.loss == "".join(t for role, t in turns if role == "assistant")
        assert r.formatted == "".join(s.text for s in r.segments)
        assert r.formatted.count("<|im_start|>") == len(list(groupby(turns, key=lambda t: t[0])))


def test_template(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "user", "there"), (1, 2, "assistant", "a<|b")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert format_conversations(frame).first().formatted == (
        "<|im_start|>user\nhi<|im_sep|>there<|im_end|>\n<|im_start|>assistant\na<\\|b<|im_end|>\n"
    )
    assert format_conversations(frame.limit(0)).collect() == []
