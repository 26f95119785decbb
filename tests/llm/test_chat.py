import hashlib

import pytest

from tillroll.llm import chat

ROWS = [
    (1, 0, "system", "be <kind>", 5), (1, 1, "user", None, 5), (1, 2, "assistant", "a\\<b</turn>\n\\", 5),
    (2, 0, "assistant", "", 5), (2, 0, "assistant", "", 5), (3, 1, None, "x" * 50_000, 5), (3, 0, "<odd>", "é🙂", 5),
    (None, None, "user", "no ids", 5), (4, 7, "user", "</turn>\n<turn:user>\n", 5),
]
SCHEMA = "conv_id long, turn long, role string, text string, valid int"


def expected(rows):
    found = {}
    for conv, _, role, text, _ in sorted(rows, key=lambda r: (r[1] is not None, r[1], r[2] or "", r[3] or "")):
        found.setdefault(conv, []).append((role or "", text or ""))
    digest = {}
    for conv, turns in found.items():
        learned = "".join(t for r, t in turns if r == "assistant")
        every = "".join(f"{r}\n{t}\n" for r, t in turns)
        digest[conv] = (
            len(turns), hashlib.sha256(every.encode()).hexdigest(), len(learned), hashlib.sha256(learned.encode()).hexdigest()
        )
    return digest


def test_round_trip(spark):
    formatted = chat.format_conversations(spark.createDataFrame(ROWS, SCHEMA))
    read = {r.conv_id: r for r in chat.read_conversations(formatted).collect()}
    want = expected(ROWS)
    assert read.keys() == want.keys()
    for conv, row in read.items():
        assert tuple(row)[1:5] == want[conv]
    assert {c for c, r in read.items() if r.valid} == {1, None, 4}


def test_empty(spark):
    formatted = chat.format_conversations(spark.createDataFrame([], SCHEMA))
    assert formatted.count() == 0 and chat.read_conversations(formatted).count() == 0


def test_foreign_text_is_refused(spark):
    formatted = chat.format_conversations(spark.createDataFrame(ROWS[:1], SCHEMA))
    with pytest.raises(Exception, match="not a turn"):
        chat.read_conversations(formatted, chat.Template(opening="[{role}]")).collect()
