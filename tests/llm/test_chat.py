import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from panelmart.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["<", "s>", "</s>", "[INST]", "[/INST]", "\\", "<<SYS>>", "<</", "x", " ", "\n"])).map("".join))
def test_escape_is_reversible(text):
    out = chat.escape(text)
    assert chat.unescape(out) == text and not any(c in out for c in chat.TEMPLATE.control)


def brute(rows):
    convs = {}
    for c, turn, role, text in rows:
        convs.setdefault(c, []).append((turn if turn is not None else -1, role or "", text or ""))
    out = {}
    for c, turns in convs.items():
        turns.sort()
        said = "".join(t for _, r, t in turns if r == "assistant")
        out[c] = (len(turns), digest("".join(f"{r}\n{t}\n" for _, r, t in turns)), len(said), digest(said))
    return out


def test_round_trip_and_odd_rows(spark):
    marks = "</s>[INST] ok [/INST]\\<s>"
    rows = [(-1, 0, "user", marks), (-1, 1, "assistant", marks), (1, 0, "system", "be"), (1, 1, "user", None),
            (1, 2, "assistant", ""), (2, 0, "assistant", "early"), (2, 0, "assistant", "early"), (3, 0, None, "who"),
            (3, 1, "tool</s>", "[INST]"), (None, 0, "user", "x"), (4, None, "user", "é🙂" * 40_000), (5, 0, "user", " ")]
    convs = spark.createDataFrame(rows, SCHEMA).withColumn("loss", F.lit("clash")).withColumn("part", F.lit(1))
    segments = chat.format_chat(convs)
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.read_back(segments).collect()}
    assert got == brute(rows)
    order = {(r.conv_id, r.turn_no): r.in_order for r in segments.collect()}
    assert order[-1, 0] and order[-1, 1] and order[1, 2]
    assert not order[2, 0] and not order[2, 1] and not order[3, 0] and not order[5, 0]
    assert chat.read_back(chat.format_chat(spark.createDataFrame([], SCHEMA))).count() == 0


def test_formatted_text_and_mask(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "yo")]
    parts = sorted(chat.format_chat(spark.createDataFrame(rows, SCHEMA)).collect())
    assert "".join(r.text for r in parts) == "<s>[INST] hi [/INST] yo</s>"
    assert [r.text for r in parts if r.loss] == ["yo"]
