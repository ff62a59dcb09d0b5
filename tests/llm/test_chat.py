"""Formatting can be undone, whatever the texts hold; attachments are recorded in order."""

import tracemalloc

import pytest
from compare import difference
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from texts import awkward, empty

from revtide.llm import chat


def test_query_equals_sql(spark, con, sf_dir, monkeypatch):
    monkeypatch.setattr("compare.BANNED", [])
    assert difference(spark, con, "op4_typed_chat", sf_dir) is None


def part(kind, text=None, ref=None, units=None):
    return {"kind": kind, "text": text, "ref": ref, "units": units}


def test_parts_in_order():
    parts = [part("text", "see <image 3.1/> #1"), part("image", ref="a.png", units=2.5), part("audio", ref="b", units=3.0),
             part("text", ""), part("document", ref=None), part("text", "end\\")]
    out, loss, attached = chat.format_turn(3, "assistant", parts)
    assert [a[0] for a in attached] == ["<image 3.1/>", "<audio 3.2/>", "<document 3.3/>"]
    assert [a[3] for a in attached] == [3 * 256, 3 * 25, 600]
    (role, found), = chat.parse_turns(out)
    assert role == "assistant"
    assert found == [("text", "see <image 3.1/> #1"), ("image", "<image 3.1/>"), ("audio", "<audio 3.2/>"),
                     ("document", "<document 3.3/>"), ("text", "end\\")]
    assert [chat.unescape(out[s:s + n]) for s, n in loss] == ["see <image 3.1/> #1", "end\\"]
    with pytest.raises(ValueError):
        chat.format_turn(0, "user", [part("video")])


CONTROL = st.lists(st.sampled_from(["\\", "<turn>", "</turn>", "### ", "#", ":", ": ", "\n", "a", "<image 1.1/>", "é"])).map("".join)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(CONTROL, CONTROL), max_size=4))
def test_round_trip(turns):
    out = "".join(chat.format_turn(i, role, [part("text", text)])[0] for i, (role, text) in enumerate(turns))
    found = [(role, "".join(t for _, t in parts)) for role, parts in chat.parse_turns(out)]
    assert found == turns


@pytest.mark.parametrize("piece", ["word ", "a\\<# b", "\\", "<"])
def test_memory_of_a_long_turn(piece):
    text = piece * (2_000_000 // len(piece))
    out = chat.format_turn(0, "user", [part("text", text)])[0]
    tracemalloc.start()
    try:
        turn = chat._TURN.match(out)
        kept = [m.span() for m in chat._PART.finditer(turn[2])]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert kept == [(0, len(turn[2]))] and peak < 4 * len(out) + 1_000_000
    assert list(chat.parse_turns(out)) == [("user", [("text", text)])]


def test_awkward_rows(spark):
    rows = awkward(spark).withColumn("conv_id", F.lit(None).cast("long")).withColumn("turn", F.col("doc_id") % 2)
    out = chat.formatted(rows, chat.text_part(F.col("text")), role="source")
    assert out.count() == rows.count()
    found, = chat.read_back(out).collect()
    assert found["conv_id"] is None and found["n_turns"] == rows.count() and found["loss_chars"] == 0
    none = empty(spark).withColumn("conv_id", F.lit(1)).withColumn("turn", F.lit(1))
    assert chat.read_back(chat.formatted(none, chat.text_part(F.col("text")), role="source")).count() == 0
