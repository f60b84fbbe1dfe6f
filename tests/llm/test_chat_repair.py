import hashlib
import itertools
import re
from collections import defaultdict
from zlib import crc32

import pytest

from leadloom.llm import chat_repair as C

SF = "/root/testdata/sf0.001"


def cheapest(turns):
    """Every edit of every turn by recursion over a plain grammar state, without parser or graph."""
    best = [None]
    goes = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    n = len(turns)

    def walk(k, state, cost, audit, lines, fresh):
        if best[0] is not None and cost > best[0][0]:
            return
        if k == n and state in ("", "a") and (best[0] is None or (cost, audit) < best[0][:2]):
            best[0] = (cost, audit, lines)
        if fresh < 2:
            for t, role in (("u", "user"), ("a", "assistant")):
                if (state, t) in goes:
                    walk(k, goes[state, t], cost + 5, audit + "I", [*lines, role + ":"], fresh + 1)
        if k < n:
            role, text, fault = turns[k]
            walk(k + 1, state, cost + 2, audit + "D", lines, 0)
            if fault not in ("blank", "duplicate"):
                more = 5 * (fault == "truncated")
                if (state, role[:1]) in goes:
                    walk(k + 1, goes[state, role[:1]], cost + more, audit + "K", [*lines, f"{role}:{text}"], 0)
                for t, name in (("u", "user"), ("a", "assistant")):
                    if (state, t) in goes:
                        walk(k + 1, goes[state, t], cost + more + 1, audit + "R", [*lines, f"{name}:{text}"], 0)

    walk(0, "", 0, "", [], 0)
    return best[0]


def summary(rows):
    """rows of (turn, role, text) after damage."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    seen, turns = set(), []
    for _, role, text in rows:
        bare = re.findall(r"[^\x20\x09-\x0D]", text)
        turns.append((role, text, "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""))
        seen.add((role, text))
    cost, audit, lines = cheapest(turns)
    numbers = {t for t, _, _ in rows if t is not None}
    faults = [f for _, _, f in turns]
    pairs = [a[0][:1] + b[0][:1] for a, b in zip(turns, turns[1:], strict=False)]
    gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
    return gaps, *(faults.count(x) for x in ("blank", "duplicate", "truncated")), sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()


def damaged(rows):
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        group = out[conv]
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        role, text, kind = " " if role is None else role, " " if text is None else text, crc32(key.encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        group.extend([(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1))
    return {k: summary(v) for k, v in out.items()}


def as_rows(df):
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in df.collect()}


def test_given_table_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = damaged(rows)
    got = as_rows(C.op13_chat_repair(spark, SF))
    assert got == want and len({r.conv_id for r in spark.read.parquet(f"{SF}/conversations.parquet").collect()}) == len(got)


@pytest.mark.parametrize("n", range(6))
def test_every_short_dialogue(n):
    kinds = [("s", ""), ("u", ""), ("a", ""), ("t", ""), ("u", "truncated"), ("a", "truncated"), ("a", "blank")]
    for case in itertools.product(kinds, repeat=n) if n < 5 else itertools.product(kinds[:3] + kinds[4:6], repeat=n):
        cost, audit, _ = cheapest([(i, "x", f) for i, f in case])
        assert C.best(C.follow({0: (0, "", C.PARSER.start)}, case)) == (cost, audit)


def test_parser_accepts_the_grammar_alone():
    for n in range(8):
        for word in itertools.product("sua", repeat=n):
            stack = C.PARSER.start
            for t in word:
                stack = stack and C.PARSER.shift(stack, t)
            assert bool(stack and C.PARSER.accepts(stack)) == bool(re.fullmatch("(s?(ua)+)?", "".join(word)))


def awkward_rows():
    rows = [(1, 0, "system", "Be kind."), (1, 1, "user", "Hi."), (1, 1, "user", "Hi."), (1, 5, "assistant", "Yes"), (1, None, "assistant", "No number."), (2, 0, None, None), (2, None, None, "x."), (None, 0, "user", "A."), (None, 1, "assistant", "B."), (None, None, "tool", "C.")]
    rows += [(3, t, r, "Same text.") for t, r in enumerate(["user", "assistant"] * 3)] + [(4, 7, "", "")] + [(5, t, "user", f"Line {t}\n two! \x0b") for t in (-3, 9)] + [(6, t, ("user", "assistant")[t % 2], "ünï " * t + ("." if t % 3 else "")) for t in range(9)]
    rows += [(k, t, ("user", "assistant", "system", "ursa")[(k + t * t) % 4], f"t{t % 3}" + ".! "[t % 4 % 3]) for k in range(10, 60) for t in range(k % 8)]
    return rows


@pytest.mark.parametrize("most_rows", [20_000, 3])
def test_awkward_rows_whole_and_in_pieces(spark, monkeypatch, most_rows):
    monkeypatch.setattr(C, "PIECE_BITS", 1)
    rows = awkward_rows()
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as pos", "2 as piece", "'x' as copies", "'y' as id")
    got = as_rows(C.repair_conversations(C.damage(df), copies_col="copies", most_rows=most_rows))
    assert got == damaged(rows)


def test_large_conversation_in_pieces_equals_whole(spark):
    rows = [("big", t // 2, ("user", "assistant", "user")[t % 3], f"text {t % 700}" + (".", "", "!")[t % 3]) for t in range(3000)] + [("big", 5, "user", "again.")] * 700 + [("small", 1, "user", "Hello.")]
    df = spark.createDataFrame(rows, "conv_id string, turn long, role string, text string")
    whole, pieces = as_rows(C.repair_conversations(df)), as_rows(C.repair_conversations(df, most_rows=1000))
    assert whole == pieces and len(whole) == 2 and len(whole["big"][6]) >= 3700
    assert as_rows(C.repair_conversations(df, most_bytes=10_000)) == whole


def test_empty_and_dropped(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert C.repair_conversations(C.damage(none), copies_col="copies").count() == 0
    dropped = next(k for k in range(1000) if crc32(f"{k}:0".encode()) % 20 == 0)
    df = spark.createDataFrame([(dropped, 0, "user", "x.")], none.schema)
    assert as_rows(C.repair_conversations(C.damage(df), copies_col="copies")) == {dropped: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
