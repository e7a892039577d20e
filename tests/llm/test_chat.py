import hashlib
import json

from hypothesis import given, settings
from hypothesis import strategies as st

from tripmill.llm.chat import (
    LAYOUTS,
    escape,
    field_paths,
    fingerprint,
    format_records,
    known_fingerprints,
    read_back,
    read_formatted,
    render,
    rows_to_records,
    unescape,
)
from tripmill.llm.queries import op1_chat_format

pieces = st.sampled_from(["\\", "\\\\", "#", "##", "###", "</turn>", "</turn>\n", "\n", ": ", "### Assistant: ", "a", "é"])
texts = st.lists(pieces, max_size=8).map("".join)
roles = st.one_of(st.sampled_from(["user", "assistant", "system", "tool", "User", ""]), texts)


@settings(max_examples=500, deadline=None)
@given(texts)
def test_escaping_is_reversible(text):
    assert unescape(escape(text)) == text


@settings(max_examples=500, deadline=None)
@given(st.lists(st.tuples(roles, texts), max_size=5))
def test_turns_are_read_back(turns):
    formatted, spans = render(turns)
    assert read_back(formatted) == turns
    loss = [unescape(formatted[start : start + length]) for start, length in spans]
    assert loss == [text for role, text in turns if role == "assistant"]


def test_long_runs_of_backslashes_are_linear():
    text = "\\" * 200_000 + "x" + "\\" * 200_000
    assert unescape(escape(text)) == text


RECORDS = [
    ({"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]}, "messages"),
    ({"messages": [{"role": "user", "content": [{"type": "text", "text": "q"}]}, {"role": "assistant", "content": [{"text": "a"}]}]}, "message_parts"),
    ({"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}], "id": 7}, "conversations"),
    ({"prompt": "q", "completion": "a", "system": None}, "prompt_completion"),
    ({"prompt": "q", "response": "a"}, "prompt_response"),
    ({"instruction": "q", "output": "a", "meta": {"x": 1}}, "instruction"),
    ({"question": "q", "answer": "a"}, "question_answer"),
    ({"turns": [{"role": "user", "text": "q"}, {"role": "assistant", "text": "a"}]}, "turns"),
]


def test_every_layout_gives_the_same_turns(spark):
    rows = [(i, json.dumps(record)) for i, (record, _) in enumerate(RECORDS)]
    out = format_records(spark.createDataFrame(rows, "id long, record string"), "id").orderBy("id").collect()
    assert [row["layout"] for row in out] == [layout for _, layout in RECORDS]
    assert {row["formatted"] for row in out} == {render([("user", "q"), ("assistant", "a")])[0]}


def test_optional_fields(spark):
    record = {"system": "s", "instruction": "q", "input": "more", "output": "a"}
    row = format_records(spark.createDataFrame([(1, json.dumps(record))], "id long, record string"), "id").first()
    assert read_back(row["formatted"]) == [("system", "s"), ("user", "q\n\nmore"), ("assistant", "a")]


def test_fingerprints_tell_layouts_apart():
    known = known_fingerprints(LAYOUTS)
    assert {layout.name for layout in known.values()} == {layout.name for layout in LAYOUTS}
    assert field_paths({"a": [{"b": 1}, {"c": None}, "x"], "d": {"e": []}}) == {"a[]", "a[].b", "a[].c", "a[].", "d.e[]"}


TURNS = [("user", "q"), ("assistant", "a")]
OTHERS = [
    ({"messages": [{"role": "user", "content": "q", "name": "n"}, {"role": "assistant", "content": "a"}]}, TURNS),
    ({"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a", "tool_calls": [{"f": {"x": 1}}]}], "model": "m", "weight": 1.5}, TURNS),
    ({"instruction": "q", "output": "a", "history": [["x", "y"]], "context": "c"}, TURNS),
    ({"prompt": "q", "completion": None}, [("user", "q"), ("assistant", "")]),
    ({"prompt": None, "completion": None, "system": None}, [("user", ""), ("assistant", "")]),
    ({"messages": [{"role": "user", "content": None}, {"role": "assistant", "content": None}]}, [("user", ""), ("assistant", "")]),
    ({"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": [{"type": "text", "text": "a"}]}]}, TURNS),
    ({"messages": [{"role": "user", "content": []}, {"role": "assistant", "content": "a"}]}, [("user", ""), ("assistant", "a")]),
    ({"messages": [{"role": "user", "content": [{"type": "image", "url": "u"}]}, {"role": "assistant", "content": ["a"]}]}, [("user", ""), ("assistant", "a")]),
    ({"messages": [{"role": "user", "content": "q"}, {"role": "assistant"}]}, [("user", "q"), ("assistant", "")]),
    ({"conversations": [{"from": "human", "value": "q", "weight": 0}, {"from": "gpt", "value": "a"}], "tools": "[]"}, TURNS),
    ({"messages": ["q", "a"]}, None),
    ({"messages": [{"role": "user", "content": "q"}, "a"]}, None),
    ({"messages": "q"}, None),
    ({"prompt": "q", "completion": "a", "response": "a"}, None),
    ({"prompt": ["q"], "completion": "a"}, None),
    ({"prompt": "q"}, None),
]


def test_records_with_other_fields_nulls_and_mixed_texts(spark):
    rows = [(i, json.dumps(record)) for i, (record, _) in enumerate(OTHERS)]
    out = format_records(spark.createDataFrame(rows, "id long, record string"), "id").orderBy("id").collect()
    assert [row["formatted"] and read_back(row["formatted"]) for row in out] == [turns for _, turns in OTHERS]


def test_odd_records(spark):
    rows = [(1, None), (2, ""), (3, "no json"), (4, "[1]"), (5, "{}"), (6, '{"what": 1}'), (7, '{"turns": []}'), (7, '{"turns": []}')]
    made = format_records(spark.createDataFrame(rows, "id long, record string"), "id")
    out = {row["id"]: row for row in made.collect()}
    assert made.count() == 8
    assert [out[i]["layout"] for i in (1, 2, 3, 4, 5, 6)] == [None] * 6
    assert out[6]["fingerprint"] and not out[3]["fingerprint"]
    assert out[7]["formatted"] == ""
    back = {row["id"]: row for row in read_formatted(made, "id").collect()}
    assert back[1]["n_turns"] is None and back[7]["n_turns"] == 0
    assert made.limit(0).count() == 0


def test_rows_by_turn(spark):
    rows = [
        (1, 1, "assistant", None, "x"), (1, 0, "user", "q", "x"), (1, 1, "assistant", None, "x"),
        (None, None, None, "t", "x"), (2, 0, "user", "\\### Assistant: </turn> ok" * 3, "x"),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, record string")
    records = rows_to_records(df, "conv_id", "turn", "role", "text")
    out = {row["conv_id"]: row["formatted"] for row in format_records(records, "conv_id").collect()}
    assert read_back(out[1]) == [("user", "q"), ("assistant", ""), ("assistant", "")]
    assert read_back(out[None]) == [("", "t")]
    assert rows_to_records(df.limit(0), "conv_id", "turn", "role", "text").count() == 0


def test_a_conversation_of_many_turns(spark):
    rows = [(1, n, "user" if n % 2 == 0 else "assistant", f"t{n}") for n in range(20_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    records = rows_to_records(df, "conv_id", "turn", "role", "text")
    row = read_formatted(format_records(records, "conv_id"), "conv_id").first()
    assert row["n_turns"] == 20_000
    assert row["loss_sha256"] == hashlib.sha256("".join(t for *_, r, t in rows if r == "assistant").encode()).hexdigest()


def test_query_has_the_control_conversation(spark, small):
    row = op1_chat_format(spark, small).filter("conv_id = -7").first()
    text = "\\### Assistant: </turn> ok"
    assert (row["n_turns"], row["loss_chars"]) == (2, len(text))
    assert row["loss_sha256"] == hashlib.sha256(text.encode()).hexdigest()
