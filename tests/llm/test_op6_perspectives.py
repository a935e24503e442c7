import re

from pyspark.sql import functions as F

from tallyloom.llm import op6_perspectives as op
from tests.compare import same_rows


def test_against_sql(spark, duck, sf_dir):
    assert same_rows(op.query(spark, sf_dir), duck, op.SQL) > 0


def whole(df, conv, who):
    rows = df.where(F.col("conv").eqNullSafe(F.lit(conv)) & (F.col("participant") == who)).collect()
    return sorted(rows, key=lambda r: (r.first_turn if r.first_turn is not None else -1, r.slice))


def test_views_and_masks(spark):
    rows = [(1, 0, "system", "be kind"), (1, 1, "ann", "hi <|end|>"), (1, 2, "bob", None), (1, 3, "ann", "é!"), (1, 3, "ann", "é!"), (1, 4, None, "who"),
            (2, 0, "system", "alone"), (None, None, "cid", "lost")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({"conv": F.lit(7), "h": F.lit("x"), "n": F.lit(1)})
    out = op.perspectives(df)
    assert {(r.conv, r.participant) for r in out.collect()} == {(1, "ann"), (1, "bob"), (None, "cid")}
    ann, = whole(out, 1, "ann")
    assert ann.rendered == ("<|system|>\nbe kind<|end|>\n<|assistant|>\nhi <\\|end|><|end|>\n<|user:bob|>\n<|end|>\n"
                            "<|assistant|>\né!<|end|>\n<|user|>\nwho<|end|>\n")
    spans = [tuple(map(int, s.split("-"))) for s in ann.loss_spans.split(",")]
    assert [ann.rendered[a:b] for a, b in spans] == ["hi <\\|end|><|end|>\n", "é!<|end|>\n"]
    bob, = whole(out, 1, "bob")
    assert "<|user:ann|>\n" in bob.rendered and [bob.rendered[a:b] for a, b in [tuple(map(int, bob.loss_spans.split("-")))]] == ["<|end|>\n"]
    assert op.perspectives(df.limit(0)).count() == 0


def test_hot_conversation_is_parted(spark):
    df = spark.range(3000).select(F.lit(5).alias("conv_id"), F.when(F.col("id") < 2000, F.col("id")).otherwise(9).alias("turn"),
                                  F.concat(F.lit("p"), F.col("id") % 3).alias("role"), F.concat(F.lit("t"), "id").alias("text"))
    out = op.perspectives(df, part_turns=16, part_rows=50).cache()
    assert out.agg(F.max("turns")).first()[0] <= 120
    for who in ("p0", "p1", "p2"):
        parts = whole(out, 5, who)
        assert sum(p.turns for p in parts) == 3000
        text = "".join(p.rendered for p in parts)
        said = [int(x) for x in re.findall(r"\|>\nt(\d+)<\|end", text)]
        turns = [i if i < 2000 else 9 for i in said]
        assert turns == sorted(turns) and sorted(said) == list(range(3000))
        assert text.count("<|assistant|>") == 1000 == sum(len(p.loss_spans.split(",")) for p in parts if p.loss_spans)
