import pytest
from pyspark.sql import functions as F

from quern.operators import chat, turns
from quern.operators.turns import BEGIN_SOLUTION as BS
from quern.operators.turns import BEGIN_THOUGHT as BT
from quern.operators.turns import END_SOLUTION as ES
from quern.operators.turns import END_THOUGHT as ET
from quern.sources.tables import CONVERSATION, read_jsonl, rows_source, write_jsonl


def row(i, *messages):
    return {"ordinal": i, "conversations": [{"from": who, "value": text} for who, text in messages]}


def marked(i):
    return row(i, ("user", f"q{i}"), ("assistant", f"{BT} r{i} {ET}\n{BS} s{i} {ES}"))


def nested(spark, rows):
    return turns.first_turns_nested(rows_source(spark, rows, CONVERSATION))


def contents(spark, rows, n, *tags):
    made = turns.build_examples(nested(spark, rows), "ordinal", n, *tags).orderBy("ordinal").collect()
    return [[(m.role, m.content) for m in r.messages] for r in made]


def test_scaffold(spark):
    one = spark.range(1).select(turns.scaffold(F.lit("r"), F.lit("4")).alias("a"), turns.scaffold(F.lit("r"), F.lit("4"), "[T]", "[/T]").alias("b"), turns.scaffold(F.lit("r"), F.lit("4"), "X").alias("c")).first()
    assert (one.a, one.b, one.c) == ("r\n\n4", "[T]r[/T]4", "Xr4")


def test_first_n_in_order(spark):
    made = contents(spark, [marked(i) for i in reversed(range(5))], 3, "[T]", "[/T]")
    assert made == [[("user", f"q{i}"), ("assistant", f"[T]r{i}[/T]s{i}")] for i in range(3)]


def test_skips_and_counts_what_was_read(spark):
    bad = row(1, ("user", "q"), ("assistant", ""))
    rows = [marked(0), bad, marked(2), {**bad, "ordinal": 3}]
    assert turns.build_counts(nested(spark, rows), "ordinal", 2).first() == (2, 1)
    assert turns.build_counts(nested(spark, rows), "ordinal", 9).first() == (2, 2)


def test_empty_first_turn_blocks_later_ones(spark):
    assert contents(spark, [row(0, ("user", ""), ("user", "q"), ("assistant", f"a{ET}b"))], 5) == []


def test_second_marker_stays_in_solution(spark):
    assert contents(spark, [row(0, ("user", "q"), ("assistant", f"a{ET} b {ET} c"))], 5)[0][1][1] == f"a\n\nb {ET} c"


def test_unicode_space_null_and_missing(spark):
    rows = [row(0, ("user", "\u00a0q\u3000"), ("assistant", f"\u2003a{ET}b\n")), {"ordinal": 1, "conversations": None}, row(2, ("user", None), ("assistant", "x")), row(3, (None, "q"))]
    assert contents(spark, rows, 5) == [[("user", "q"), ("assistant", "a\n\nb")]]


def test_long_form_equals_nested(spark):
    rows = [marked(0), row(1, ("system", "s"), ("assistant", "a"), ("user", "u")), row(2, ("user", None))]
    flat = [(r["ordinal"], k, t["from"], t["value"]) for r in rows for k, t in enumerate(r["conversations"])]
    long = turns.first_turns(spark.createDataFrame(flat, "conv_id long, turn long, role string, text string")).orderBy("conv_id").collect()
    assert [(r.user, r.assistant) for r in long] == [(r.user, r.assistant) for r in nested(spark, rows).orderBy("ordinal").collect()]


def test_sink_publishes_only_complete_sets(spark, tmp_path):
    made = turns.build_examples(nested(spark, [marked(0)]), "ordinal", 5)
    path = f"file://{tmp_path}/out"
    with pytest.raises(RuntimeError, match="only wrote 1 of 5"):
        write_jsonl(made, path, least=5)
    assert not (tmp_path / "out").exists()
    assert write_jsonl(made, path, least=1, one_file=True) == 1
    assert read_jsonl(spark, path, "ordinal long, messages array<struct<role: string, content: string>>", own=True).first().messages[0].content == "q0"
    with pytest.raises(turns.TooFewRows):
        turns.require_rows(made, 5)


def test_bad_lines_are_kept_apart(spark, tmp_path):
    (tmp_path / "x.json").write_text('{"ordinal": 1}\nnot json\n')
    rows = read_jsonl(spark, f"file://{tmp_path}/x.json", "ordinal long").cache()
    assert rows.filter("_corrupt_record is not null").count() == 1 and rows.filter("ordinal = 1").count() == 1


def test_mask_and_think_history(spark):
    m = [("user", "u1"), ("assistant", "<think>a</think>x"), ("user", "u2"), ("assistant", "<think>b</think>y")]
    df = spark.createDataFrame([([{"role": r, "content": c} for r, c in m],)], "m array<struct<role: string, content: string>>")
    df = df.select(chat.strip_think_history(F.col("m")).alias("m")).select("m", chat.render_messages(F.col("m")).alias("text"))
    one = chat.mask_coverage(df).first()
    assert [x.content for x in one.m] == ["u1", "x", "u2", "<think>b</think>y"]
    assert (one.n_responses, one.trained_chars) == (2, len("x\n") - 1 + len("<think>b</think>y"))
    assert one.text.index("<|im_start|>user") < one.text.index("<|im_start|>assistant")
