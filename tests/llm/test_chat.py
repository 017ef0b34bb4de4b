import random

from pyspark.sql import functions as F

from episodica.llm import chat

BITS = ["<|turn|>", "<|part|>", "<|end|>", "</s>", "<s>", "[INST]", "[/INST]", "\\", "\n", "a", "é\U0001f600", " ", "<", "[", "%3C", ""]


def test_round_trip(spark):
    r = random.Random(3)
    text = lambda: None if r.random() < 0.1 else "".join(r.choice(BITS) for _ in range(r.randrange(8)))
    data = [(c, t, r.choice(["user", "assistant", "system", None, "we<ird\n%"]), text(), "x") for c in [*range(40), None] for t in [*range(r.randrange(1, 7)), None]]
    data += [*data[:5], *((999, t, "assistant" if t % 3 else "user", f"turn {t} é </s>" * 20, "x") for t in range(3000)), (998, 0, "assistant", "long é " * 100_000, "x")]
    df = spark.createDataFrame(data, "conv_id long, turn long, role string, text string, formatted string").selectExpr("*", "1 as loss", "2 as segments")
    out = chat.format_conversations(df)
    got = {x.conv_id: x for x in out.select("conv_id", "formatted", chat.read_turns(F.col("formatted")).alias("turns"), chat.read_loss(F.col("formatted"), F.col("loss")).alias("loss")).collect()}
    for c in {d[0] for d in data}:
        rows = sorted(((d[1] is not None, d[1] or 0, d[2] or "", d[3] or "") for d in data if d[0] == c))
        assert [(t.role, t.text) for t in got[c].turns] == [x[2:] for x in rows]
        assert got[c].loss == "".join(x[3] for x in rows if x[2] == "assistant")
        assert got[c].formatted.count(chat.TURN) == sum(i == 0 or rows[i - 1][2] != x[2] for i, x in enumerate(rows))


def test_empty(spark):
    assert chat.format_conversations(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0
