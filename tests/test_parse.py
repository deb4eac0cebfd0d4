"""Parsers of replies and chats."""

from pyspark.sql import functions as F

from corpusloom.functions import parse as P


def each(spark, values, f, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.r for r in rows.select("i", f(F.col("v")).alias("r")).orderBy("i").collect()]


def test_answers(spark):
    replies = ["ABD", "A, B and D", "B. False", "The answer is C", "NONE", "<think>A</think>B", "", None, "A & C", "B", "the option D is", "E", "I say A or B"]
    valid = F.array(*[F.lit(x) for x in "ABCD"])
    assert each(spark, replies, lambda c: P.answer_letters(c, valid)) == ["ABD", "ABD", "B", "C", "", "B", "", "", "AC", "B", "D", "", "AB"]
    assert each(spark, ["NONE", "<think>A</think>B"], lambda c: P.answer_letters(c, drop_thoughts=False)) == ["ENO", "AB"]


def test_pairs(spark):
    good = '[{"instruction": "What is this thing?", "output": "%s", "type": " fact "}, {"instruction": "short", "output": "x"}]' % ("o" * 60)
    replies = [good, f"```json\n{good}\n```", f"Here you are: {good} bye", '{"a": 1}', "[broken", '[{"instruction": "What is this thing?", "output": "too short"}]', None]
    found = each(spark, replies, P.qa_pairs)
    assert [None if x is None else [(p.instruction, p.input, p.type) for p in x] for x in found] == [[("What is this thing?", "", "FACT")]] * 3 + [None] * 4


def test_selections(spark):
    assert each(spark, ['{"selected": [5, 7, 9]}', "take 3, 3, 70 and 1, 2", "1 2", '{"selected": [5]} 1 2 3', None], P.selection) == [[5, 7, 9], [3, 1, 2], None, [5, 1, 2], None]


def test_first_turns(spark):
    chats = [
        [("system", "one"), ("system", "two"), ("user", "hello"), ("assistant", "hi")],
        [("assistant", "first"), ("user", "q"), ("assistant", "a")],
        [("user", " "), ("user", "q"), ("system", "late"), ("assistant", "a")],
        [("user", "q")],
        [("assistant", "a")],
        [],
        None,
    ]
    found = each(spark, chats, P.first_turn, "array<struct<role string, content string>>")
    assert [None if x is None else (x.instruction, x.output) for x in found] == [("two\n\nhello", "hi"), ("q", "a"), ("q", "a"), None, None, None, None]
    decoded = each(spark, ['[{"role": "user", "content": "x"}]', "broken"], P.decoded_messages)
    assert decoded[0][0].role == "user" and not decoded[1]
    gate = each(spark, [("x" * 10, "", "y" * 20), ("x" * 9, "", "y" * 20), ("x" * 10, "", "y" * 8001), None], P.chat_gate, "struct<instruction string, input string, output string>")
    assert gate == [True, False, False, False]


def test_prompts(spark):
    row = spark.createDataFrame([("Q?", {"B": "no", "A": "yes"}, ["p" * 20])], "q string, o map<string, string>, p array<string>")
    assert row.select(P.question_prompt(F.col("q"), F.col("o"), F.col("p"), 3).alias("r")).first().r == "[1] ppp\n\nQuestion: Q?\nA. yes\nB. no\nAnswer:"


def test_exam_prompts_and_templates(spark):
    from corpusloom.plans import pipelines

    rows = spark.createDataFrame([(i, f"Q{i}?", {"B": "no", "A": "yes"}, ["B", "A"] if i == 2 else ["A"]) for i in (1, 2, 3)] + [(None, "Q?", {"A": "x"}, ["A"])], "id int, question string, options map<string, string>, answer array<string>")
    found = {r.id: r.prompt for r in pipelines.exam_prompts(rows, "Do.", [2, 1, 99]).collect()}
    ask = "\nQuestion: Q%s?\nA. yes\nB. no\n\nAnswer:"
    assert found == {3: "Do.\n" + ask % 2 + " AB\n" + ask % 1 + " A\n" + ask % 3, None: "Do.\n" + ask % 2 + " AB\n" + ask % 1 + " A\n\nQuestion: Q?\nA. x\n\nAnswer:"}
    assert pipelines.exam_prompts(rows, "Do.").where("id = 1").first().prompt == "Do.\n" + ask % 1
    one = spark.createDataFrame([("{b}", None)], "a string, b string")
    assert one.select(P.filled("x {a} y {b} z {c} {a}", a=F.col("a"), b=F.col("b")).alias("r")).first().r == "x {b} y  z {c} {b}"
    lines = spark.createDataFrame([(10, 1.0, 2.5), (2, 0.333, 4.0)], "i int, x double, y double")
    told = lines.agg(P.in_lines(P.candidate_line(F.col("i"), {"CE": F.col("x"), "HS": F.col("y")}), F.col("i")).alias("t")).first().t
    assert told == "  # 2: CE=0.33, HS=4.00\n  #10: CE=1.00, HS=2.50"


def test_qa_pairs_name_the_reply_once(spark):
    reply = F.concat(F.col("r"), F.lit("MARK"))
    plan = spark.createDataFrame([("x",)], "r string").select(P.qa_pairs(reply).alias("p"))
    assert plan._jdf.queryExecution().optimizedPlan().toString().count("MARK") == 1
