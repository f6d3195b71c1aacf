import hashlib

import oracle
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from hypercell.llm import chat

CONTROL = st.lists(st.sampled_from(["<|", "|>", "<s>", "</s>", "[INST]", "[/INST]", "\\", "<", "|", "[", "n", "\n", "x", chat.TURN, chat.END]), max_size=12).map("".join)


@settings(max_examples=300, deadline=None)
@given(CONTROL | st.text(max_size=30))
def test_escape_is_reversible_and_hides_control_strings(text):
    safe = chat.escape(text)
    assert chat.unescape(safe) == text
    assert not any(c in safe for c in ("<|", "|>", "<s>", "</s>", "[INST]", "[/INST]"))


@settings(max_examples=200, deadline=None)
@given(CONTROL, CONTROL)
def test_a_turn_reads_back(role, text):
    turn, a, b, _ = chat.render(role, [{"kind": "text", "text": text[: len(text) // 2]}, {"kind": "text", "text": text[len(text) // 2 :]}])
    assert chat.parse(turn) == (role, text)
    assert chat.unescape(turn[a:b]) == text


def test_parts_become_placeholders():
    parts = [{"kind": "text", "text": "see "}, {"kind": "image", "ref": "s3://a.png", "amount": 4}, {"text": " and <|image:0|> "}, {"kind": "AUDIO", "ref": "b.wav", "amount": 10}, {"kind": "document", "ref": None, "amount": None}]
    turn, a, b, v = chat.render("user", parts)
    assert turn[a:b] == "see <|image:0|> and <\\|image:0|\\> <|audio:1|><|document:2|>"
    assert [(r["kind"], r["ref"], r["tokens"]) for r in v.refs] == [("image", "s3://a.png", 1024), ("audio", "b.wav", 250), ("document", None, 0)]
    assert v.extra_tokens == 1274
    with pytest.raises(ValueError):
        chat.render("user", [{"kind": "video"}])


def expected(rows):
    out = {}
    for c in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == c), key=lambda r: (r[1] is not None, r[1], r[2] or "", r[3] or ""))
        loss = "".join(r[3] or "" for r in mine if r[2] == "assistant")
        text = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in mine)
        out[c] = (len(mine), hashlib.sha256(text.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def test_conversations(spark):
    rows = [(1, 1, "assistant", "hi 🙂 </s>"), (1, 0, "user", "hello\n\\n"), (2, 0, None, None), (2, 1, "assistant", None), (None, 0, "user", "x"), (3, 0, "assistant", "same"), (3, 0, "assistant", "same"), (4, 0, "b", "1"), (4, 0, "a", "2"), (6, 0, "user", "Z"), (6, 0, "user", "\"q"), (5, 0, "user", "long " * 20000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "'x' AS parts", "1 AS formatted")
    formatted = chat.format_turns(df)
    got = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in chat.digests(formatted).collect()}
    assert got == expected(rows)
    assert chat.digests(chat.format_turns(df.where("false"))).collect() == []
    one = {(r["turn"], r["formatted"]): r for r in formatted.where("conv_id = 1").collect()}
    whole = "".join(t for _, t in sorted(one))
    r = one[1, [t for k, t in one if k == 1][0]]
    assert chat.unescape(whole[r["loss_start"] : r["loss_end"]]) == "hi 🙂 </s>"


def test_parts_column(spark):
    df = spark.sql(f"SELECT 1L AS conv_id, 0L AS turn, 'user' AS role, array(named_struct('kind', 'image', 'text', cast(null AS string), 'ref', 'r', 'amount', 2L), null) AS p UNION ALL SELECT 1L, 1L, 'user', null")
    got = sorted(chat.format_turns(df, parts_col="p").collect(), key=lambda r: r["turn"])
    assert got[0]["expanded_tokens"] == 512 and got[0]["attachments"][0]["ref"] == "r" and got[1]["expanded_tokens"] == 0


def test_query(spark):
    from hypercell.llm import queries

    oracle.same(queries.op5_chat(spark, "/root/testdata/sf0.001"), queries.OP5_SQL, "/root/testdata/sf0.001")
