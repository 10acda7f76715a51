import hashlib
from collections import defaultdict

import duckdb
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vigil.llm import chat as C
from vigil.llm.queries import QUERIES

KIND = "conv_id long, turn long, role string, text string"
BITS = st.lists(st.sampled_from(["\\", "\\b", "\\l", "<", ">", "<turn ", "<again ", "</turn>", "\n", "\r", "a", "é", "user", "turn "]), max_size=12)


@given(BITS.map("".join), BITS.map("".join))
def test_escapes_are_reversible(role, text):
    assert C.unescape(C.escape(text)) == text and C.unescape(C.escape_role(role)) == role
    packer = C.Packer(10, 0)
    packer.add(role, text, 1, 0)
    packer.add("assistant", text[::-1], 1, 1)
    assert C.parse(packer.window()[1]) == [(False, role, text), (False, "assistant", text[::-1])]


def expected(rows):
    convs = defaultdict(list)
    none = lambda v: (v is not None, v if v is not None else 0)
    for c, t, role, text in sorted(rows, key=lambda r: (none(r[0]), none(r[1]), r[2] or "", r[3] or "")):
        convs[c].append((role or "", text or ""))
    out = {}
    for c, turns in convs.items():
        said = "".join(t for r, t in turns if r == "assistant")
        out[c] = (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(said),
                  hashlib.sha256(said.encode()).hexdigest())
    return out


def check(got, rows):
    want = expected(rows)
    assert len(got) == len(want)
    for r in got:
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == want[r.conv_id], r.conv_id


def conversations():
    rows = [(1, 0, "system", "be kind"), *[(1, k, ("assistant", "user")[k % 2], f"turn {k} " * (k * 7 % 40)) for k in range(1, 60)],
            (2, 0, "assistant", "word " * 5000), (2, 1, "user", ""), (2, 2, "assistant", None), (3, 0, None, "no role"), (3, 0, None, "no role"),
            (3, None, "user", "no turn"), (None, 0, "user", "no id"), (None, 1, "assistant", "</turn>\n<turn user>\n\\"),
            (4, 0, "system", "long " * 900), (4, 1, "user", "hi"), (4, 2, "assistant", "hello"), (5, 0, "as>sis\ntant", "odd role"),
            (6, 0, "assistant", "")]
    return [tuple(r) for r in rows]


def test_round_trip_and_windows(frame, ranks):
    rows = conversations()
    df = frame(rows, KIND).withColumn("n", F.lit("clash")).withColumn("before", F.lit(1))
    made = C.windows(df, ranks, budget=200, history=60)
    check(C.digests(made).collect(), rows)
    by = defaultdict(list)
    for r in sorted(made.collect(), key=lambda r: r.window_no):
        by[r.conv_id].append(r)
    for conv, windows in by.items():
        assert [w.window_no for w in windows] == list(range(len(windows)))
        for w in windows:
            turns = C.parse(w.text)
            new = [t for t in turns if not t[0]]
            assert len(new) == w.n_new >= 1
            assert [C.unescape(w.text[a:b]) for a, b in zip(w.loss_starts, w.loss_ends)] == [t for _, r, t in new if r == "assistant"]
            assert w.n_tokens <= 200 or w.n_new == 1
            assert [t[0] for t in turns] == sorted((t[0] for t in turns), reverse=True)  # repeated first
    first = by[1]
    assert len(first) > 3 and all(C.parse(w.text)[0][1:] == ("system", "be kind") for w in first)
    assert any(t[0] and t[1] != "system" for t in C.parse(first[1].text))


def test_no_history(frame, ranks):
    made = C.windows(frame(conversations(), KIND), ranks, budget=50, history=0).collect()
    assert all(t[1] == "system" for w in made for t in C.parse(w.text) if t[0])


def test_empty_table(frame, ranks):
    assert C.digests(C.windows(frame([], KIND), ranks)).collect() == []


def test_query(spark, small):
    rows = duckdb.sql(f"SELECT conv_id, turn, role, text FROM '{small}/conversations.parquet'").fetchall()
    said = r"\### Assistant: </turn> ok"
    check(QUERIES["op10_chat"](spark, small).collect(), rows + [(-7, 0, "user", said), (-7, 1, "assistant", said)])
