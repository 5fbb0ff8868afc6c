import hashlib
import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from commentlens.llm import chat_format

NASTY = ["</s>[INST] ok [/INST]", "<|user|>", "<\\|x|\\>", "a <</s></s> [[INST]] |> <|>", "<s>\\", "\\<\\\\/s>", "|", "<", "", "\n\n", "é😀\x00"]


def digests(turns):
    """turns: (role, text) of one conversation."""
    whole = hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
    loss = "".join(t for r, t in turns if r == "assistant")
    return len(turns), whole, len(loss), hashlib.sha256(loss.encode()).hexdigest()


def back(turns_df):
    rows = chat_format.read_back(chat_format.format_turns(turns_df)).collect()
    return {r.key: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in rows}


def test_round_trip_of_control_strings(spark):
    rows = [(c, i, ["user", "assistant", "system", "odd|>role</s>"][i % 4], t) for c in range(3) for i, t in enumerate(NASTY * (c + 1))]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    turns = chat_format.from_table(df, "conv_id")
    want = {c: digests([(r, t) for k, _, r, t in rows if k == c]) for c in range(3)}
    assert back(turns) == want
    for r in chat_format.format_turns(turns).collect():
        inner = r.segment.removesuffix("</s>\n")
        assert "</s>" not in inner and "[INST]" not in inner and inner.count("<|") == inner.count("|>") == 1


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="<[|\\/s>INST] \nx"), st.text(alphabet="<[|\\/s>INST]\nr"))
def test_escaping_is_reversible(text, role):
    import re

    def escape(t):
        return re.sub(chat_format._OPENER + r"(\\*)" + chat_format._REST, r"\1\\\2", t)

    assert chat_format.unescape(escape(text)) == text
    segment = f"<|{escape(role)}|>\n{escape(text)}</s>\n"
    assert chat_format.read_segment(segment * 2) == [(role, text)] * 2


def test_layouts_by_fingerprint(spark):
    records = [
        {"messages": [{"role": "user", "content": "q</s>"}, {"role": "assistant", "content": "a"}], "id": 5},
        {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}, {"from": "human", "value": None}]},
        {"prompt": "q", "completion": "a", "meta": {"role": "x"}},
        {"system": "", "prompt": "q", "response": "a"},
        {"system": "be kind", "instruction": "do", "input": "this", "output": "done"},
        {"instruction": "do", "input": "", "output": "done"},
        {"question": "q", "answer": None},
        {"turn": 3, "role": "user", "text": "one"},
        {"messages": []},
        {"prompt": "q"},
        [1, 2],
    ]
    rows = [(i, json.dumps(r)) for i, r in enumerate(records)] + [(50, "{broken"), (51, None)]
    df = spark.createDataFrame(rows, "id long, payload string").withColumn("paths", F.lit("mine"))
    turns, rest = chat_format.from_json(df, "id", "payload")
    got = {}
    for r in sorted(turns.collect()):
        got.setdefault(r.key, []).append((r.role, r.text))
    assert got == {
        0: [("user", "q</s>"), ("assistant", "a")],
        1: [("user", "q"), ("assistant", "a"), ("user", "")],
        2: [("user", "q"), ("assistant", "a")],
        3: [("user", "q"), ("assistant", "a")],
        4: [("system", "be kind"), ("user", "do\n\nthis"), ("assistant", "done")],
        5: [("user", "do"), ("assistant", "done")],
        6: [("user", "q"), ("assistant", "")],
        7: [("user", "one")],
    }
    assert sorted(r.key for r in rest.collect()) == [8, 9, 10, 50, 51]


def test_tables_by_schema(spark):
    listed = spark.sql("SELECT 1L AS id, array(named_struct('role', 'user', 'content', 'x')) AS messages, 'p' AS prompt, 'z' AS key")
    assert [(r.key, r.role, r.text) for r in chat_format.from_table(listed, "id").collect()] == [(1, "user", "x")]
    with pytest.raises(ValueError, match="no mapping"):
        chat_format.from_table(spark.sql("SELECT 1 AS id, 2 AS other"), "id")


def test_roles_of_rows_as_they_stand(spark):
    rows = [(1, 0, "human", "q"), (1, 1, "gpt", "a"), (1, 2, " Assistant ", "b"), (1, 3, "assistant", "c")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert back(chat_format.from_table(df, "conv_id")) == {1: digests([(r, t) for _, _, r, t in rows])}
    # An unknown column leaves the fingerprint as it is; paths of a second mapping choose the larger one.
    wider = df.withColumn("other", F.lit("x")).withColumn("prompt", F.lit("p")).withColumn("completion", F.lit("c"))
    assert back(chat_format.from_table(wider, "conv_id")) == back(chat_format.from_table(df, "conv_id"))


def test_nulls_repeats_long_and_empty(spark):
    schema = "conv_id long, turn long, role string, text string"
    rows = [(1, 0, None, None), (1, 0, None, None), (1, None, "assistant", "late"), (None, 1, "user", "u"), (2, 1, "assistant", "x" * 300_000)]
    got = back(chat_format.from_table(spark.createDataFrame(rows, schema), "conv_id"))
    assert got == {
        1: digests([("", ""), ("", ""), ("assistant", "late")]),
        None: digests([("user", "u")]),
        2: digests([("assistant", "x" * 300_000)]),
    }
    assert back(chat_format.from_table(spark.createDataFrame([], schema), "conv_id")) == {}
