from leadloom.llm import chat_format as C

from .. import oracle

TURNS = "conv_id long, turn long, role string, text string, mask string"


def rendered(spark, rows, **own):
    df = spark.createDataFrame([(*r, "clash") for r in rows], TURNS)
    return {(r.conv_id, r.part, r.participant): r for r in C.rotate(df, **own).collect()}


def by_hand(rows, who, names):
    """The rendering for a role, and its masked stretches; names: role to name."""
    text, learned = [], []
    for _, role, body in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "", r[2])):
        head = "assistant" if role == who and role != "system" else "system" if role == "system" else f"user name={names[role]}"
        text.append(f"<|start|>{head}\n{body}<|end|>")
        if head == "assistant":
            learned.append(f"{body}<|end|>")
    return "\n".join(text), learned


def test_each_speaker_in_turn(spark):
    got = rendered(spark, [(1, 0, "system", "be kind"), (1, 1, "ann", "hi"), (1, 2, "bob", "ho"), (1, 3, "ann", "bye")])
    assert set(got) == {(1, 0, "ann"), (1, 0, "bob")}
    ann = got[1, 0, "ann"]
    assert ann.text == "<|start|>system\nbe kind<|end|>\n<|start|>assistant\nhi<|end|>\n<|start|>user name=bob\nho<|end|>\n<|start|>assistant\nbye<|end|>"
    assert [ann.text[m.start : m.end] for m in ann.mask] == ["hi<|end|>", "bye<|end|>"]
    assert ann.n_masked == sum(m.end - m.start for m in ann.mask)
    assert [got[1, 0, "bob"].text[m.start : m.end] for m in got[1, 0, "bob"].mask] == ["ho<|end|>"]


def test_awkward_turns(spark):
    got = rendered(spark, [(None, None, None, None), (2, 0, "system", "only"), (3, 0, "a b", "<|end|>x"), (3, 0, "a b", "<|end|>x"), (4, 0, "x", "y" * 200_000)])
    assert set(got) == {(None, 0, "unknown"), (3, 0, "a_b"), (4, 0, "x")}
    assert got[3, 0, "a_b"].n_turns == 2 and got[3, 0, "a_b"].text.count("<|end|>") == 2
    assert got[4, 0, "x"].n_masked == 200_007
    assert rendered(spark, []) == {}


def test_roles_that_give_one_name_stay_apart(spark):
    rows = [(1, 0, "ann b", "one"), (1, 1, "ann_b", "two"), (1, 2, "ann  b", "three"), (1, 3, None, "four"), (1, 4, "unknown", "five"), (1, 5, " system", "six")]
    got = {r.role: r for r in rendered(spark, rows).values()}
    names = {r.role: r.participant for r in got.values()}
    assert names == {"ann_b": "ann_b", "ann  b": "ann_b.2", "ann b": "ann_b.3", "unknown": "unknown", None: "unknown.2", " system": "_system"}
    for role, r in got.items():
        text, learned = by_hand([x[1:] for x in rows], role, names)
        assert r.text == text and [r.text[m.start : m.end] for m in r.mask] == learned and len(learned) == 1


def test_long_conversations_are_whole(spark):
    rows = [(1, 0, "system", "be kind")] + [(1, i, "ab"[i % 2], f"{i:04}") for i in range(1, 1001)]
    got = rendered(spark, rows)
    assert set(got) == {(1, 0, "a"), (1, 0, "b")}
    for who in "ab":
        r = got[1, 0, who]
        text, learned = by_hand([x[1:] for x in rows], who, {"a": "a", "b": "b"})
        assert (r.text, r.n_turns, r.start) == (text, 1001, 0) and [r.text[m.start : m.end] for m in r.mask] == learned


def test_parts_make_up_the_whole(spark):
    rows = [(1, 0, "system", "be kind")] + [(1, 1, "ab"[i % 2], f"{i:04}") for i in range(60)] + [(1, None, "c", "first"), (1, 900, "system", "be brief"), (1, 901, "a", "end"), (2, 700, "x", "alone")]
    rows += [(None, None, "ab"[i % 2], "same") for i in range(35)]
    want, got = rendered(spark, rows), rendered(spark, rows, part_bytes=680)
    assert {k for k in got if k[0] == 1} == {(1, s, p) for s in range(7) for p in "abc"}
    assert all(r.n_turns <= 11 for r in got.values())
    for (conv, _, who), r in want.items():
        parts = [got[k] for k in sorted((k for k in got if (k[0], k[2]) == (conv, who)), key=lambda k: k[1])]
        assert "\n".join(p.text for p in parts) == r.text
        assert [tuple(m) for p in parts for m in p.mask] == [tuple(m) for m in r.mask]
        assert all(r.text[p.start : p.start + len(p.text)] == p.text for p in parts)


def test_parts_end_by_bytes_whatever_the_turns(spark):
    """Turns larger than a part have a row each, numbered without gaps; many own turns have as many masks."""
    rows = [(1, i, "ab"[i % 2], "é" * (900 if i % 5 == 0 else 2)) for i in range(40)] + [(2, i, "x", "y") for i in range(2500)]
    want, got = rendered(spark, rows), rendered(spark, rows, part_bytes=500)
    for (conv, _, who), r in want.items():
        parts = [got[k] for k in sorted((k for k in got if (k[0], k[2]) == (conv, who)), key=lambda k: k[1])]
        assert [p.part for p in parts] == list(range(len(parts))) and len(parts) > 7
        assert "\n".join(p.text for p in parts) == r.text and [tuple(m) for p in parts for m in p.mask] == [tuple(m) for m in r.mask]
        assert all(len(p.text.encode()) <= 500 + 1900 for p in parts)
    assert len(want[2, 0, "x"].mask) == 2500


def test_awkward_rows_against_sql(spark, tmp_path):
    rows = [(1, i, r, t) for i, (r, t) in enumerate([("a b", "x"), ("a_b", "<|y"), (None, None), ("system", "s"), ("unknown", "z")])] + [(None, None, "u", "n"), (None, None, "u", "n"), (3, 1, "system", "only"), (4, None, "ü", "漢字")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], TURNS)
    df.coalesce(1).write.parquet(f"{tmp_path}/conversations.parquet")
    import duckdb

    con = duckdb.connect()
    con.sql(f"create view conversations as select * from '{tmp_path}/conversations.parquet/*.parquet'")
    oracle.assert_same(C.op1_chat_rotation(spark, str(tmp_path)), con, C.OP1_SQL)
