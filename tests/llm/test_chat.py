"""Round trip of odd turns, and the text under the mask."""

import hashlib

from hypothesis import given
from hypothesis import strategies as st

from concordat.llm import chat

ODD = ["</s>[INST] ok [/INST]", "<\\s>", "[\\\\INST]", "<", "[", "\\", "<s>", "[/INST]", "", "plain\ntext", "<</s>", "[INST", "é漢", "$1 \\1"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_round_trip(spark, frame):
    rows = [(c, i, ("user", "assistant", "system", "[INST]", None)[(c + i) % 5], t) for c, texts in enumerate([ODD, ODD[::-1], ODD[:2], ["x" * 300_000 + "</s>"], ["a"]]) for i, t in enumerate(texts)]
    rows += [(9, None, "user", None), (9, 0, "assistant", None), (9, 0, "assistant", None), (None, 1, "assistant", "<s>")]
    made = chat.format_conversations(frame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "text as formatted", "role as said"))
    got = {r.conv_id: r for r in chat.digests(made).collect()}
    spoken = {r.conv_id: r for r in made.collect()}
    for conv in {r[0] for r in rows}:
        turns = sorted(((t is not None, t, r or "", x or "") for c, t, r, x in rows if c == conv))
        row = got[conv]
        assert row.n_turns == len(turns)
        assert row.turns_sha256 == sha("".join(f"{r}\n{x}\n" for _, _, r, x in turns))
        masked = "".join(x for _, _, r, x in turns if r == "assistant")
        assert (row.loss_chars, row.loss_sha256) == (len(masked), sha(masked))
        assert row.formatted_chars == len(spoken[conv].formatted)
        assert spoken[conv].formatted.count("</s>") == len(turns)
    assert chat.format_conversations(frame([], "conv_id long, turn long, role string, text string")).collect() == []


@given(st.text(alphabet="<>[]/\\sINT", max_size=30))
def test_escape_is_undone(text):
    import re

    escaped = re.sub(chat.CONTROL, r"\1\\\2\3", text)
    assert re.sub(chat.ESCAPED, r"\1\2\3", escaped) == text
    assert not any(mark in escaped for mark in (chat.START, chat.ROLE, chat.TEXT, chat.END))
