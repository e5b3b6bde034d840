from pyspark.sql import functions as F

from shelfwise.llm import chat_format as op

NASTY = ["\\### Assistant: </turn> ok", "\\l\\g\\b\\\\<>", "<turn user>\nhi</turn>\n", "", "é😀\n\n<", "\\", ">"]


def turns(df):
    return {r.conv_id: [(t.role, t.text) for t in r.turns] for r in df.collect()}


def test_any_text_comes_back(spark):
    rows = [(i, t, role, text) for i in range(3) for t, (role, text) in enumerate(zip(["user", "assistant", "<x>\\"] * 3, NASTY))]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    read = op.read_chats(op.format_chats(op.canonical_turns(df)))
    want = [(("user", "assistant", "<x>\\")[i % 3], text) for i, text in enumerate(NASTY)]
    assert turns(read) == {i: want for i in range(3)}
    assert {r.loss_text for r in read.collect()} == {NASTY[1] + NASTY[4]}
    assert all(r.formatted == "".join(s.text for s in r.segments) for r in read.collect())


def test_nulls_ties_repeats_and_extra_columns(spark):
    rows = [(1, 0, "user", None, "p"), (1, 0, "user", None, "p"), (1, None, None, "early", "p"), (None, 0, "HUMAN", "x", "p")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, prompt string")
    assert turns(op.canonical_turns(df)) == {1: [("", "early"), ("user", ""), ("user", "")], None: [("user", "x")]}
    assert op.read_chats(op.format_chats(op.canonical_turns(df.limit(0)))).count() == 0


def test_layouts_are_told_by_their_field_paths(spark):
    message = spark.sql("select 1 as id, array(struct('Human' as `from`, 'q' as value), struct('gpt' as `from`, 'a' as value)) as conversations, 'z' as text")
    assert turns(op.canonical_turns(message)) == {1: [("user", "q"), ("assistant", "a")]}
    nested = spark.sql("select 2 as conv_id, struct(array(struct('user' as role, 'q' as content)) as messages) as data")
    assert turns(op.canonical_turns(nested)) == {2: [("user", "q")]}
    instruction = spark.sql("select 3 as id, 'do' as instruction, cast(null as string) as input, 'done' as output")
    assert turns(op.canonical_turns(instruction)) == {3: [("user", "do"), ("assistant", "done")]}


def test_rows_of_different_layouts(spark):
    rows = [
        ('{"id": 1, "prompt": "p", "response": "r"}',), ('{"id": 2, "messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]}',),
        ('{"id": 3, "question": "q", "answer": "a", "extra": {"prompt": 1}}',), ('{"id": 4, "other": 1}',), ("{broken",), (None,),
        ('{"id": 5, "conversations": [{"from": "human", "value": "q"}]}',),
    ]
    df = op.from_json_rows(spark.createDataFrame(rows, "raw string"), "raw")
    got = {r.conv_id: r.turns and [(t.role, t.text) for t in r.turns] for r in df.collect()}
    assert got == {
        1: [("user", "p"), ("assistant", "r")], 2: [("user", "q"), ("assistant", "a")], 3: [("user", "q"), ("assistant", "a")], 4: None, None: None,
        5: [("user", "q")],
    }


def test_plans_stay_in_the_jvm(spark):
    df = spark.sql("select 1L as conv_id, 0L as turn, 'user' as role, 'x' as text")
    plan = op.read_chats(op.format_chats(op.canonical_turns(df)))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and plan.count("Exchange hash") == 1


def test_escaping_is_reversible(spark):
    df = spark.createDataFrame([(x,) for x in NASTY], "t string")
    back = df.select("t", op.unescape(op.escape(F.col("t"))).alias("u"), op.escape(F.col("t")).alias("e")).collect()
    assert all(r.t == r.u and "<" not in r.e and ">" not in r.e for r in back)
