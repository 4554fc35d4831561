"""Hand-made rows with the expected text."""

import json
import random

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

import corpusloom as cl

EOS = "</s>"


def one(df, **options):
    rows = cl.render(df, **options).collect()
    return rows[0].text if rows else None


def text(spark, value, **options):
    return one(spark.createDataFrame([(value,)], "text string"), **options)


@pytest.mark.parametrize("value, want", [
    (None, "None</s>"), (" \t", "</s>"), ("\xa0a b\xa0", "a b</s>"), ("a</s>", "a</s>"),
    ("", "</s>"), ("　x \x85", "x</s>"),
])
def test_text(spark, value, want):
    assert text(spark, value, eos=EOS) == want


def test_text_clean(spark):
    assert text(spark, None, eos=EOS, clean=True) is None
    assert text(spark, " \t", eos=EOS, clean=True) is None
    assert text(spark, " \t") == ""


@pytest.mark.parametrize("dtype, value, want", [
    ("boolean", True, "True"), ("bigint", 3, "3"), ("double", 1.5, "1.5"),
    ("array<int>", [1, 2], "[1, 2]"),
])
def test_text_of_other_types(spark, dtype, value, want):
    assert one(spark.createDataFrame([(value,)], f"text {dtype}")) == want


def test_blank_filter_before_and_after_the_end_marker(spark):
    df = spark.createDataFrame([(1, "  "), (2, "x"), (3, None)], "row_id int, text string")
    kept = cl.drop_blank(cl.render(df, "text", eos=EOS))
    assert kept.count() == 3
    assert cl.drop_blank(df).count() == 1


def instruction(spark, schema, *values, **options):
    return one(spark.createDataFrame([values], schema), **options)


def test_instruction(spark):
    plain = "### Instruction:\np\n\n### Response:\nr</s>"
    io = "instruction string, output string"
    assert instruction(spark, io, "p", "r", eos=EOS) == plain
    iio = "instruction string, input string, output string"
    assert instruction(spark, iio, "p", "", "r", eos=EOS) == plain
    assert instruction(spark, iio, "p", None, "r", eos=EOS) == plain
    empty = "### Instruction:\np\n\n### Input:\n\n\n### Response:\nr</s>"
    assert instruction(spark, iio, "p", "  ", "r", eos=EOS) == empty
    assert instruction(spark, iio, "p", "  ", "r", eos=EOS, clean=True) == plain
    assert instruction(spark, iio, "p", " i ", "r") == (
        "### Instruction:\np\n\n### Input:\ni\n\n### Response:\nr")


def test_input_of_other_types(spark):
    schema = "instruction string, context {}, output string"
    assert "### Input" not in instruction(spark, schema.format("int"), "p", 0, "r")
    assert "### Input:\n7" in instruction(spark, schema.format("int"), "p", 7, "r")
    assert "### Input" not in instruction(spark, schema.format("array<string>"), "p", [], "r")
    assert "### Input:\nTrue" in instruction(spark, schema.format("boolean"), "p", True, "r")


def test_input_as_prompt_is_used_twice(spark):
    schema = "input string, output string"
    assert instruction(spark, schema, "p", "r") == (
        "### Instruction:\np\n\n### Input:\np\n\n### Response:\nr")
    assert instruction(spark, schema, "p", "r", clean=True) == (
        "### Instruction:\np\n\n### Response:\nr")


def test_detection(spark):
    def layout(*names, **options):
        return cl.detect_layout(
            spark.createDataFrame([("",) * len(names)], ", ".join(n + " string" for n in names)),
            **options)

    assert layout("prompt", "text") == "instruction"
    assert layout("query", "thinking") == "text"
    assert layout("query", "thinking", prompt="query", response="thinking", clean=True) == (
        "instruction")
    assert layout("messages", "prompt", "text") == "conversation"
    assert layout("chat") == "text"
    assert layout("chat", clean=True) == "conversation"
    assert layout("input", "completion") == "instruction"
    assert layout("whatever") == "text"


def test_columns_found_by_name(spark):
    two = spark.createDataFrame([("a", "b")], "prompt string, text string")
    assert cl.resolve_field(two, "prompt") == "prompt"
    assert cl.resolve_field(two, "response") == "text"
    assert cl.resolve_field(two, "input") is None
    assert cl.resolve_field(two, "text") == "text"
    other = spark.createDataFrame([("a", "b")], "x string, y string")
    assert cl.resolve_field(other, "text") == "x"
    assert cl.resolve_field(other, "response") == "y"
    assert cl.resolve_field(other, "conversation", "y") == "y"
    lone = spark.createDataFrame([("a",)], "x string")
    assert cl.resolve_field(lone, "response") == "x"


def test_unknown_column_fails_when_planned(spark):
    df = spark.createDataFrame([("a",)], "text string")
    with pytest.raises(AnalysisException):
        cl.render(df, "text", text="nope")
    with pytest.raises(AnalysisException):
        cl.render(df, "conversation", conversation="nope")


JSON_ROWS = [
    ('[{"role":"uSER","content":"hi"},{"role":"assistant","content":"yo"}]',
     "User: hi\n\nAssistant: yo"),
    ('[{"from":"human","value":"hi"}]', "Human: hi"),
    ('[{"content":"x"}]', "Unknown: x"),
    ('[{"role":"user"}]', "User: "),
    ('[{"role":"user","content":null}]', "User: None"),
    ('["a",{"role":"user","content":"b"},3]', "a\n\nUser: b\n\n3"),
    ('[true, null]', "True\n\nNone"),
    ("not json", "not json"),
    ('"q"', "q"),
    ("false", "False"),
    ("[]", ""),
    (None, "None"),
    # Text that is no JSON as a whole stays as it is.
    ('[{"role":"user","content":"a"}] trailing', '[{"role":"user","content":"a"}] trailing'),
    ('[{"role":"user","content":"a"}]]', '[{"role":"user","content":"a"}]]'),
    ("[{'role':'user','content':'a'}]", "[{'role':'user','content':'a'}]"),
    ("[1],[2]", "[1],[2]"), ("1],[2", "1],[2"), ("[1],", "[1],"), ("", ""), (" [1] ", "1"),
    ('[1, NaN, "x"]', "1\n\nNaN\n\nx"),
    ('{"a": 1}', '{"a":1}'), ("3", "3"), ("null", "None"),
    # The last of repeated keys counts.
    ('[{"role":"x","content":1,"content":"two","role":"y"},"s",4]', "Y: two\n\ns\n\n4"),
    ('[{"role":"u","content":{"k":1,"k":2}},{"role":"u","role":"v"}]',
     '{"role":"u","content":{"k":1,"k":2}}\n\nV: '),
]


def test_json_messages(spark):
    df = spark.createDataFrame(
        [(i, value) for i, (value, _) in enumerate(JSON_ROWS)], "row_id int, messages string")
    got = {r.row_id: r.text for r in cl.render(df).collect()}
    assert got == {i: want for i, (_, want) in enumerate(JSON_ROWS)}


def test_json_longer_than_a_variant(spark):
    turn = F.concat(F.lit('{"role":"user","content":"'), F.repeat(F.lit("x"), F.lit(10 ** 6)),
                    F.lit('"}'))
    df = spark.range(1).select(F.concat(
        F.lit("["), F.array_join(F.array_repeat(turn, 20), ","), F.lit("]")).alias("messages"))
    sizes = cl.render(df).select(F.length("text"), F.left("text", F.lit(7))).first()
    assert tuple(sizes) == (20 * (10 ** 6 + 6) + 19 * 2, "User: x")


def test_null_role(spark):
    df = spark.createDataFrame([('[{"role":null,"content":"x"}]',)], "messages string")
    with pytest.raises(Exception, match="role is not text"):
        cl.render(df).collect()
    assert one(df, clean=True) == "Unknown: x"
    typed = spark.createDataFrame(
        [([(None, "x")],)], "messages array<struct<role string, content string>>")
    with pytest.raises(Exception, match="null role"):
        cl.render(typed).collect()
    assert one(typed, clean=True) == "Unknown: x"


def test_typed_messages(spark):
    schema = "messages array<struct<role string, content string>>"
    df = spark.createDataFrame([([("uSER", "hi"), ("assistant", None)],)], schema)
    assert one(df, eos=EOS) == "User: hi\n\nAssistant: None</s>"
    df = spark.createDataFrame([([("gpt", " x ")],)], "dialog array<struct<from string, value string>>")
    assert one(df) == "Gpt:  x "
    df = spark.createDataFrame([(["a", "b"],)], "dialogue array<string>")
    assert one(df) == "a\n\nb"
    df = spark.createDataFrame([([1, None],)], "messages array<int>")
    assert one(df) == "1\n\nNone"
    df = spark.createDataFrame([(None,)], schema)
    assert one(df) == "None"
    assert one(df, clean=True) is None


def test_styles(spark):
    schema = "messages array<struct<role string, content string>>"
    df = spark.createDataFrame([([("system", "s"), ("user", "u"), ("assistant", "a")],)], schema)
    assert one(df, style="chatml") == (
        "<|im_start|>system\ns<|im_end|>\n<|im_start|>user\nu<|im_end|>\n"
        "<|im_start|>assistant\na<|im_end|>\n")
    assert one(df, style="inst") == "<<SYS>>\ns\n<</SYS>>\n\n[INST] u [/INST] a "
    assert one(df, style={"user": ("U<", ">"), "system": ("", ""), "assistant": ("A<", ">")}) == (
        "sU<u>A<a>")
    odd = spark.createDataFrame([([("tool", "t"), ("user", "u")],)], schema)
    assert one(odd, style="chatml") == "Tool: t\n\nUser: u"
    text = spark.createDataFrame([('[{"role":"user","content":"u"}]',), ("plain",)],
                                 "messages string")
    assert [r.text for r in cl.render(text, style="chatml").collect()] == [
        "<|im_start|>user\nu<|im_end|>\n", "plain"]


def test_trace(spark):
    schema = ("context string, cot string, output struct<b:int,a:string,c:array<double>,d:boolean>,"
              " completion string")
    df = spark.createDataFrame([("x", "y", (1, 'q"é\n', [0.5, 2.0], None), "z")], schema)
    assert cl.render_trace(df).first().text == (
        'x\ny\n{"b": 1, "a": "q\\"é\\n", "c": [0.5, 2.0], "d": null}\nz')
    text = spark.createDataFrame([("x", "y", "{}", "z")],
                                 "context string, cot string, output string, completion string")
    assert cl.render_trace(text).first().text == 'x\ny\n"{}"\nz'
    assert cl.render_trace(text, json_as_is=True).first().text == "x\ny\n{}\nz"
    null = spark.createDataFrame([(None, "y", "{}", "z")],
                                 "context string, cot string, output string, completion string")
    with pytest.raises(Exception, match="null in text field context"):
        cl.render_trace(null).collect()
    assert cl.render_trace(null, clean=True).count() == 0


def test_prompts(spark):
    df = spark.createDataFrame(
        [("[INST] x",), ("x",), ("<|im_start|>x",), ("a ### Instruction: b",), ("y[INST]",)],
        "prompt string")
    got = [r.prompt for r in cl.wrap_prompts(df).collect()]
    wrapped = "### Instruction:\n{}\n\n### Response:\n"
    assert got == ["[INST] x", wrapped.format("x"), "<|im_start|>x", "a ### Instruction: b",
                   wrapped.format("y[INST]")]


def test_parts_of_a_conversation_are_in_order(spark):
    turns = spark.range(1000).select(
        F.when(F.col("id") < 900, F.lit("long")).otherwise(F.concat(F.lit("c"), F.col("id") % 7))
        .alias("conv"), (F.col("id") * 37 % 1000).alias("turn"), F.lit("user").alias("role"),
        (F.col("id") * 37 % 1000).cast("string").alias("text"))
    rows = cl.conversation_parts(turns, "conv", "turn", turns_per_part=100).collect()
    long = sorted((r for r in rows if r.conv == "long"), key=lambda r: r.part)
    assert len(long) >= 8 and max(len(r.messages) for r in long) < 200
    said = [int(m.content) for r in long for m in r.messages]
    assert said == sorted(said) and len(said) == 900
    assert all(r.part == 0 for r in rows if r.conv != "long")


def test_hot_conversation_from_parts(spark):
    """One conversation holds a third of all turns; put together from parts it is the same."""
    turns = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 700).alias("conv"),
        F.col("id").alias("turn"), F.lit("user").alias("role"),
        F.concat(F.lit("t"), F.col("id")).alias("text"))
    whole = cl.assemble_conversations(turns, "conv", "turn")
    parts = cl.assemble_conversations(turns, "conv", "turn", turns_per_part=50)
    assert sorted(map(str, whole.collect())) == sorted(map(str, parts.collect()))
    hot = parts.where("conv = -1").first().messages
    assert [m.content for m in hot] == [f"t{i}" for i in range(0, 3000, 3)]


def test_keep_only(spark):
    df = spark.createDataFrame([(1, "train", "a", "b")],
                               "row_id int, split string, text string, other string")
    assert cl.keep_only(df, "text").columns == ["row_id", "split", "text"]


def expected(payload):
    """The rendering of a JSON value, said in plain Python."""
    if not isinstance(payload, list):
        return str(payload)
    lines = []
    for item in payload:
        if not isinstance(item, dict):
            lines.append(str(item))
            continue
        role = next((item[k] for k in ("role", "from") if k in item), "unknown")
        body = next((item[k] for k in ("content", "value", "text") if k in item), "")
        lines.append(f"{role.capitalize()}: {body}")
    return "\n\n".join(lines)


def test_random_message_lists(spark):
    rng = random.Random(5)
    words = ["hi", "", " a b ", "é中😀", 'q"\\', "line\nbreak", "\t", "TRUE", "null", "[1]", "{"]

    def value():
        return rng.choice([rng.choice(words), rng.choice(words), 7, -3, True, False, None])

    def item():
        if rng.random() < 0.3:
            return value()
        keys = rng.sample(["role", "from", "content", "value", "text", "other"], rng.randint(0, 5))
        return {k: rng.choice(["user", "ASSISTANT", "sYstem two", "x", ""])
                if k in ("role", "from") else value() for k in keys}

    payloads = [[item() for _ in range(rng.randint(0, 5))] for _ in range(400)]
    payloads += [value() for _ in range(20)]
    rows = [(i, json.dumps(p, ensure_ascii=rng.random() < 0.5)) for i, p in enumerate(payloads)]
    df = spark.createDataFrame(rows, "row_id int, messages string")
    got = {r.row_id: r.text for r in cl.render(df).collect()}
    assert got == {i: expected(p) for i, p in enumerate(payloads)}


def test_random_conversations_typed_and_as_json_agree(spark):
    rng = random.Random(6)
    rows = [(i, [(rng.choice(["user", "ASSISTANT"]), rng.choice(["hi", "", "é\n", None]))
                 for _ in range(rng.randint(0, 4))]) for i in range(200)]
    typed = spark.createDataFrame(
        rows, "row_id int, messages array<struct<role string, content string>>")
    # Nulls are kept as such, as a present key.
    text = typed.withColumn("messages", F.to_json("messages", {"ignoreNullFields": "false"}))
    assert sorted(cl.render(typed).collect()) == sorted(cl.render(text).collect())
