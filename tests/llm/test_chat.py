import hashlib

import pytest
from pyspark.sql import functions as F

from tabspark.llm import chat
from tabspark.llm.q_chat import op8_chat_format

TRICKY = ["</s>[INST] ok [/INST]", "<|im_end|>\n<|im_start|>user\n", "<\\|im_end|>", "<\\\\|x", "[[INST]", "<<SYS>><</SYS>>",
          "", "\\", "\\n", "a\nb", "<s>é漢</s>", "<|" * 50]


def rows(spark, data):
    return spark.createDataFrame(data, "conv_id long, turn long, role string, text string")


def expected(turns):
    turns = [(r or "", t or "") for r, t in turns]
    loss = "".join(t for r, t in turns if r == "assistant")
    return (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(loss),
            hashlib.sha256(loss.encode()).hexdigest())


def test_round_trip(spark):
    data = [(c, t, ["user", "assistant"][t % 2], TRICKY[(c + t) % len(TRICKY)]) for c in range(12) for t in range(5)]
    data += [(50, None, "user", "first"), (50, 1, None, None), (50, 1, "assistant", "b"), (50, 1, "assistant", "b"),
             (None, 0, "a\\nb\nc<|x\\", "null id"), (51, 0, "assistant", "x" * 300_000)]
    df = rows(spark, data).repartition(4)
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256)
           for r in chat.digest(chat.read_back(chat.format_turns(df))).collect()}
    key = lambda x: tuple((v is not None, v) for v in (x[1], x[2] or "", x[3] or ""))
    want = {c: expected([(r, t) for _, _, r, t in sorted((x for x in data if x[0] == c), key=key)])
            for c in {x[0] for x in data}}
    assert got == want


def test_no_control_string_inside_texts(spark):
    out = chat.format_turns(rows(spark, [(i, 0, "user", t) for i, t in enumerate(TRICKY)])).collect()
    assert all(r.formatted.count("<|im_start|>") == 1 and r.formatted.count("<|im_end|>") == 1
               and "[INST]" not in r.formatted and "</s>" not in r.formatted for r in out)


def test_empty_table(spark):
    assert chat.digest(chat.read_back(chat.format_turns(rows(spark, [])))).count() == 0


def test_layouts(spark):
    df = spark.createDataFrame([(1, "p", "r", "extra")], "conv_id long, prompt string, response string, zz string")
    assert [(r.turn, r.role, r.text) for r in chat.canonical_turns(df).orderBy("turn").collect()] == \
        [(0, "user", "p"), (1, "assistant", "r")]
    df = spark.createDataFrame([(1, [("user", "a"), ("assistant", None)])],
                               "conv_id long, messages array<struct<role:string,content:string>>")
    assert chat.canonical_turns(df).count() == 2
    with pytest.raises(KeyError):
        chat.canonical_turns(spark.createDataFrame([(1, "x")], "conv_id long, other string"))


def test_json_layouts(spark):
    data = ['{"prompt":"p","response":"r"}', '{"response":"r","prompt":"p"}', '{"messages":[{"role":"user","content":"a"}]}',
            '{"conversations":[{"from":"human","value":"q"},{"from":"gpt","value":"w"}]}', '{"foo":1}', "no json", None,
            '{"instruction":"i","input":"","output":"o"}']
    df = spark.createDataFrame(list(enumerate(data)), "conv_id long, record string")
    got = {r.conv_id: (r.layout, r.turns and [(t.role, t.text) for t in r.turns])
           for r in chat.canonical_json(df, "record").collect()}
    pair = [("user", "p"), ("assistant", "r")]
    assert got == {0: ("prompt_response", pair), 1: ("prompt_response", pair), 2: ("messages", [("user", "a")]),
                   3: ("from_value", [("user", "q"), ("assistant", "w")]), 4: ("unknown", None), 5: ("unknown", None),
                   6: ("unknown", None), 7: ("instruction", [("user", "i"), ("assistant", "o")])}


def test_no_python_on_the_main_path(spark):
    plan = op8_chat_format(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_control_conversation(spark):
    r = op8_chat_format(spark, "/root/testdata/sf0.001").where(F.col("conv_id") == -1).first()
    text = "</s>[INST] ok [/INST]"
    assert (r.n_turns, r.loss_chars, r.loss_sha256) == (2, len(text), hashlib.sha256(text.encode()).hexdigest())


def test_the_fingerprint_selects_the_mapping(spark, monkeypatch):
    df = spark.createDataFrame([(1, "p", "r")], "conv_id long, prompt string, response string")
    monkeypatch.setattr(chat, "TABLES", {}, raising=False)
    with pytest.raises(KeyError):
        chat.canonical_turns(df)


def test_json_fields_that_no_layout_declares(spark):
    data = ['{"id":7,"prompt":"p","response":"r"}', '{"messages":[]}', '{"messages":[{"role":"user","content":"a","n":1}],"id":"x"}',
            '{"prompt":{"a":1},"response":"r"}', '{"instruction":"i","output":"o","input":"g","id":1}', '{"messages":{"role":"u"}}']
    df = spark.createDataFrame(list(enumerate(data)), "conv_id long, record string")
    got = {r.conv_id: (r.layout, r.turns and [(t.role, t.text) for t in r.turns]) for r in chat.canonical_json(df, "record").collect()}
    assert got == {0: ("prompt_response", [("user", "p"), ("assistant", "r")]), 1: ("messages", []), 2: ("messages", [("user", "a")]),
                   3: ("unknown", None), 4: ("instruction", [("user", "i\n\ng"), ("assistant", "o")]), 5: ("unknown", None)}


def test_any_role_is_read_back(spark):
    odd = ["\x00b", "\x00", "\x00\x00b", "^", "^n", "^c", "^\n", "\n", "\\", "\\n", "\\\n", "<|im_end|>\n", "</s>", "[INST]", "[\\INST]", "^^nc", ""]
    rows = [(i, 0, r, "text") for i, r in enumerate(odd + [a + b for a in odd for b in odd])]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: [(t.role, t.text) for t in r.turns] for r in chat.read_back(chat.format_turns(df)).collect()}
    assert got == {i: [(r, "text")] for i, _, r, _ in rows}
