import hashlib

from epitally.llm import chat
from epitally.llm.queries import REGISTRY

SCHEMA = "conv_id long, turn long, role string, text string, LAST string"
NASTY = ["\\### Assistant: </turn> ok", '<turn role="assistant">hidden</turn>\n', "&lt;&amp;", "", None, "ü\U0001f600\n\n", "&&<<>>\"\"", "</turn>\n" * 3]


def turns(spark):
    data = [(1, i, ("user", "assistant")[i % 2], t, None) for i, t in enumerate(NASTY)]
    data += [(2, 0, "system", "s", None), (2, 2, "assistant", "b", None), (2, 1, "assistant", "a", None), (2, 3, "user", "end", None)]
    data += [(3, 0, "user", "no reply", None), (None, None, None, None, None), (None, 5, "assistant", "x", None)]
    data += [(4, 0, "assistant", "same", None)] * 2 + [(5, 1, 'we"<ird', "t", None)]
    return spark.createDataFrame(data, SCHEMA), data


def expected(data):
    out = {}
    for conv in {d[0] for d in data}:
        own = sorted(((t if t is not None else -1, r or "", x or "") for c, t, r, x, _ in data if c == conv))
        all_ = "".join(f"{r}\n{x}\n" for _, r, x in own)
        loss = "".join(x for _, r, x in own if r == "assistant")
        digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out[conv] = (len(own), digest(all_), len(loss), digest(loss))
    return out


def test_conversations_come_back_from_their_examples(spark):
    frame, data = turns(spark)
    found = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.summary(chat.format_conversations(frame)).collect()}
    assert found == expected(data)


def test_each_reply_is_the_only_trainable_part_of_its_example(spark):
    frame, data = turns(spark)
    examples = chat.format_conversations(frame)
    for r in examples.withColumns({"loss": chat.loss_text(examples), "read": chat.turns_of(examples["formatted"])}).collect():
        own = sorted(((t if t is not None else -1, role or "", x or "") for c, t, role, x, _ in data if c == r.conv_id))[: r.n_turns]
        assert [(t.role, t.text) for t in r.read] == [o[1:] for o in own]
        if r.loss_start is None:
            assert r.complete and r.loss_length == 0 and own[-1][1] != "assistant" and r.loss == ""
        else:
            assert own[-1][1] == "assistant" and r.loss == own[-1][2]
            assert r.formatted[r.loss_start + r.loss_length :] == "</turn>\n"
    assert examples.filter("conv_id = 2").count() == 3


def test_a_long_conversation_and_none(spark):
    data = [(9, i, ("user", "assistant")[i % 2], f"text {i} <b>", None) for i in range(400)]
    examples = chat.format_conversations(spark.createDataFrame(data, SCHEMA))
    assert examples.count() == 200
    assert {r.conv_id: tuple(r)[1:5] for r in chat.summary(examples).collect()} == expected(data)
    assert chat.summary(chat.format_conversations(spark.createDataFrame([], SCHEMA))).count() == 0


def test_the_query_adds_the_conversation_with_marks(spark, data_dir):
    row = REGISTRY["op2_chat_format"](spark, data_dir).filter("conv_id = -7").first()
    text = r"\### Assistant: </turn> ok"
    assert (row.n_turns, row.loss_chars) == (2, len(text))
    assert row.loss_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert row.turns_sha256 == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()
