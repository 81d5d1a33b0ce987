import hashlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from churnwatch.llm import chat, queries
from tests.conftest import SF01

CODEC = chat.Codec.of(chat.load_tokenizer())
PARTS = st.lists(st.one_of(st.sampled_from([*chat.MARKS, "\\", "<", "s>", "[", "INST]", "\n", " ", "é漢😀", " ", "<\\s>"]), st.text(max_size=5)), max_size=10)


@settings(max_examples=200, deadline=None)
@given(PARTS, st.sampled_from(["user", "assistant", "system", "", "[TEXT]", "tool"]))
def test_turn_round_trip(parts, role):
    text = "".join(parts).encode("utf-8", "ignore").decode()
    ids, loss = CODEC.turn(role, text)
    got_role, got, masked, readable = CODEC.read(ids, loss)
    assert (got_role, got) == (role, text)
    assert masked == (text if role == "assistant" else "")
    inner = readable[len(chat.MARKS[ids[0] - CODEC.first]) : -len(chat.MARKS[ids[-1] - CODEC.first])]
    if role in ("user", "assistant"):
        assert not any(m in inner for m in chat.MARKS) and chat.unescape(inner) == text
    assert (ids >= CODEC.first).sum() == (3 if role not in ("user", "assistant") else 2)


def test_long_texts_are_encoded_whole(monkeypatch):
    words = "some words, 123 of them, aren't\nalike  here 漢字é\t\n " * 8_000
    for text in (words, "ab" * 200_000, words + " " * 300_000 + "x", "y" + "\n " * 200_000, "\u3000" * 300_000 + "\x1c" + words):
        assert CODEC.encode(text) == CODEC.encoding.encode_ordinary(text) and CODEC.decode(CODEC.encode(text)) == text
    text = " " * 1_500_000 + "x"  # more than the library's pattern engine takes
    assert CODEC.decode(CODEC.encode(text)) == text
    monkeypatch.setattr(chat, "LONG_SPACE", 3)  # every longer run apart
    for text in (words, "    ", "a    ", "    a", "a     b      \n\n\n\n\nc", "a\x1c    \x1cb    \u2028", "\x85\xa0    \x1f    's     12"):
        assert CODEC.encode(text) == CODEC.encoding.encode_ordinary(text)


def brute(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        turns = sorted((r for r in rows if r[0] == conv), key=lambda r: r[1])
        body = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in turns)
        loss = "".join(r[3] or "" for r in turns if r[2] == "assistant")
        out[conv] = len(turns), hashlib.sha256(body.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()
    return out


def test_query_matches_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF01}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in queries.op7_chat_format(spark, SF01).collect()}
    assert got == brute(rows)


def test_places_and_starts(spark):
    rows = [(1, 2, "assistant", "b"), (1, 0, "system", "s"), (1, 1, "user", None), (None, None, None, None), (1, 1, "user", None), (2, 5, "user", "x" * 200_000), (2, 6, "assistant", "")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, ids int")
    made = chat.format_conversations(df)
    by = {}
    for r in made.collect():
        by.setdefault(r.conv_id, []).append(r)
    for turns in by.values():
        turns.sort(key=lambda r: r.place)
        assert [r.place for r in turns] == list(range(len(turns)))
        assert [r.start for r in turns] == [0, *np.cumsum([len(r.ids) for r in turns])[:-1]]
        assert turns[0].ids[0] == CODEC.first + chat.BOS and all(len(r.ids) == len(r.loss) for r in turns)
    digests = {r.conv_id: r for r in chat.digests(made).collect()}
    assert {k: v.n_turns for k, v in digests.items()} == {1: 4, None: 1, 2: 2}
    assert digests[1].loss_chars == 1 and digests[2].formatted_chars == len("<s>[INST]" + "x" * 200_000 + "[/INST][ASST]</s>")
    assert chat.format_conversations(df.limit(0)).count() == 0
