"""Conversation structure repair by generalised LR parsing of the role sequence with weighted edits.

The grammar of roles (initials s, u, a) is parsed by SLR tables that are derived from
its rules. Every turn may be kept (K, no cost), reroled to user or assistant (R, 1) or
deleted (D, 2), and empty turns may be inserted anywhere (I, 5); a turn whose text breaks
off costs 5 more unless it is deleted, a blank or repeated one must be. All edits are
followed at once in a graph-structured stack: a layer per turn, whose nodes are parser
stacks with the (cost, audit) that led there. Nodes with equal stack tops are merged and the
minimum stays. That loses nothing: in this grammar the top decides what may follow, and of two audits
of equal cost over the same turns none begins the other, so their order holds whatever comes after.

Conversations go to tasks by id, sorted there, and a task holds one at a time. One of
more than ``most_rows`` turns or ``most_bytes`` of text is instead dealt by ranges of its order to
pieces of ``PIECE`` turns: a piece gives its cheapest edits for every pair of
tops before and after it, these are merged pairwise like the layers, and the
pieces are rewritten with the edits chosen. Repeats are found there by the first place
of each role and text. What one task does for such a conversation is to merge those audits (16 bytes a
turn) and to run its repaired lines through SHA-256, which only goes line after line; it holds a batch of them.

Defined cases: null ids, numbers, roles and texts count as one space in the damage, and roles and texts from then
on; null ids are one conversation. Turns are in the order of their numbers, null first, ties by role and text.
Repeated rows are turns. A role of other initials can't be kept. A conversation
without turns has zeros, an empty audit and the digest of an empty string. An empty table
gives an empty result. Other columns play no part.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, hot_join, live_cuts, table, tidy

#: The grammar of role initials, costs, and the roles that edits give.
RULES = (("dialogue", ()), ("dialogue", ("opening", "pairs")), ("opening", ()), ("opening", ("s",)), ("pairs", ("pair",)), ("pairs", ("pairs", "pair")), ("pair", ("u", "a")))
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
GIVEN = {"u": "user", "a": "assistant"}
LEGAL = {"su", "ua", "au"}
#: Largest conversation that one task repairs as a whole.
MOST_ROWS, MOST_BYTES = 20_000, 16 << 20
#: Turns in a piece of a larger one: 2 to this power.
PIECE_BITS = 9

SPACE = " \t\n\v\f\r"
SUMMARY = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


class RoleParser:
    """SLR tables of a small grammar; stacks are tuples of states."""

    def __init__(self, rules: Sequence[tuple[str, tuple[str, ...]]] = RULES):
        self.rules = [("", (rules[0][0],)), *rules]
        self.heads = {h for h, _ in self.rules}
        self._follow_sets()
        self.states, self.goto = [self._closure({(0, 0)})], {}
        for k, state in enumerate(self.states):  # grows
            for x in {self.rules[r][1][d] for r, d in state if d < len(self.rules[r][1])}:
                to = self._closure({(r, d + 1) for r, d in state if self.rules[r][1][d : d + 1] == (x,)})
                if to not in self.states:
                    self.states.append(to)
                self.goto[k, x] = self.states.index(to)
        self.start = (0,)
        self._moves: dict[tuple, tuple | None] = {}
        #: A stack for every top, by which a piece's edges are named.
        self.tops = {0: self.start}
        queue = [self.start]
        for stack in queue:
            for t in "sua":
                to = self.shift(stack, t)
                if to and to[-1] not in self.tops:
                    self.tops[to[-1]] = to
                    queue.append(to)

    def _closure(self, items: set) -> frozenset:
        items = set(items)
        while True:
            more = {(r, 0) for i, d in items for x in self.rules[i][1][d : d + 1] for r, (h, _) in enumerate(self.rules) if h == x} - items
            if not more:
                return frozenset(items)
            items |= more

    def _follow_sets(self) -> None:
        first: dict[str, set] = {h: set() for h in self.heads}  # "" for the empty string
        self.follow: dict[str, set] = {h: {"$"} if h == "" else set() for h in self.heads}

        def firsts(body) -> set:
            out = {""}
            for x in body:
                out = out - {""} | (first[x] if x in self.heads else {x})
                if "" not in out:
                    break
            return out

        for _ in range(len(self.rules) * 2):
            for h, body in self.rules:
                first[h] |= firsts(body)
                for k, x in enumerate(body):
                    if x in self.heads:
                        after = firsts(body[k + 1 :])
                        self.follow[x] |= after - {""} | (self.follow[h] if "" in after else set())

    def _reduced(self, stack: tuple, ahead: str) -> tuple | None:
        """The stack after all reductions that the terminal ahead allows; None where it can't come next."""
        while (stack[-1], ahead) not in self.goto:
            done = [r for r, d in self.states[stack[-1]] if d == len(self.rules[r][1]) and ahead in self.follow[self.rules[r][0]]]
            if not done:
                return None
            if done == [0]:
                return stack
            head, body = self.rules[done[0]]
            stack = stack[: len(stack) - len(body)]
            stack += (self.goto[stack[-1], head],)
        return stack

    def shift(self, stack: tuple, terminal: str) -> tuple | None:
        key = (stack, terminal)
        if key not in self._moves:
            ready = self._reduced(stack, terminal) if terminal in "sua" and terminal else None
            self._moves[key] = ready and (*ready, self.goto[ready[-1], terminal])
        return self._moves[key]

    def accepts(self, stack: tuple) -> bool:
        return self._reduced(stack, "$") is not None


PARSER = RoleParser()
#: A layer of the graph: per stack top, the cheapest (cost, audit, stack).
Layer = dict[int, tuple[int, str, tuple]]


def _merge(layer: Layer, cost: int, audit: str, stack: tuple | None) -> bool:
    if stack is None:
        return False
    old = layer.get(stack[-1])
    if old is not None and (old[0], old[1]) <= (cost, audit):
        return False
    layer[stack[-1]] = (cost, audit, stack)
    return True


def _inserted(layer: Layer) -> Layer:
    """The layer with what insertions reach from it."""
    layer = dict(layer)
    grown = True
    while grown:
        grown = False
        for cost, audit, stack in list(layer.values()):
            for t in GIVEN:
                grown |= _merge(layer, cost + INSERT, audit + "I", PARSER.shift(stack, t))
    return layer


def follow(layer: Layer, turns: Iterable[tuple[str, str]]) -> Layer:
    """The last layer after turns of (role initial, fault), without insertions after the last of them."""
    for initial, fault in turns:
        after: Layer = {}
        more = TRUNCATED if fault == "truncated" else 0
        for cost, audit, stack in _inserted(layer).values():
            _merge(after, cost + DELETE, audit + "D", stack)
            if fault not in ("blank", "duplicate"):
                _merge(after, cost + more, audit + "K", PARSER.shift(stack, initial))
                for t in GIVEN:
                    _merge(after, cost + REROLE + more, audit + "R", PARSER.shift(stack, t))
        layer = after
    return layer


def best(layer: Layer) -> tuple[int, str]:
    return min((cost, audit) for cost, audit, stack in _inserted(layer).values() if PARSER.accepts(stack))


def replay(stack: tuple, audit: str, turns: Iterable[tuple[str, str]]) -> tuple[list[list[str]], tuple]:
    """Per turn of (role, text) the repaired lines that its edits give, the insertions before it with it; those at the end are one more. And the stack after all."""

    def expected() -> tuple[str, tuple]:
        return next((role, to) for t, role in GIVEN.items() if (to := PARSER.shift(stack, t)))

    out, turns = [[]], iter(turns)
    for edit in audit:
        if edit == "I":
            role, stack = expected()
            out[-1].append(f"{role}:")
            continue
        role, text = next(turns)
        if edit == "R":
            role, stack = expected()
        elif edit == "K":
            stack = PARSER.shift(stack, role[:1])
        if edit != "D":
            out[-1].append(f"{role}:{text}")
        out.append([])
    return out, stack


def blank(text: str) -> bool:
    return not text.strip(SPACE)


def truncated(text: str) -> bool:
    return text.rstrip(SPACE)[-1:] not in (".", "!", "?")


def gaps(numbers: set[int]) -> int:
    return max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0


def repair(turns: Sequence[tuple[int | None, str, str]]) -> tuple:
    """The summary of a conversation of (number, role, text), in order."""
    seen, faults = set(), []
    for _, role, text in turns:
        key = (role, text)
        faults.append("blank" if blank(text) else "duplicate" if key in seen else "truncated" if truncated(text) else "")
        seen.add(key)
    initials = [role[:1] for _, role, _ in turns]
    cost, audit = best(follow({0: (0, "", PARSER.start)}, zip(initials, faults, strict=True)))
    lines = [x for part in replay(PARSER.start, audit, ((r, t) for _, r, t in turns))[0] for x in part]
    illegal = sum(a + b not in LEGAL for a, b in zip(initials, initials[1:], strict=False))
    digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return gaps({n for n, _, _ in turns if n is not None}), faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit, digest


_TYPES = [("gaps", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string())]


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Conversations of sorted rows (id, number, role, text, copies), repaired one by one."""
    key, turns, ids, done, schema = None, None, [], [], None

    def flush(least: int):
        if len(ids) < least:
            return
        cols = list(zip(*done, strict=True)) or [[]] * len(_TYPES)
        yield pa.RecordBatch.from_arrays([pa.array(ids, schema), *(pa.array(c, t) for c, (_, t) in zip(cols, _TYPES, strict=True))], names=["id", *(n for n, _ in _TYPES)])
        ids.clear()
        done.clear()

    for b in batches:
        schema = b.column(0).type
        for at in range(0, b.num_rows, 256):
            for i, n, role, text, copies in zip(*(c.to_pylist() for c in b.slice(at, 256).columns), strict=True):
                if turns is None or i != key:
                    if turns is not None:
                        ids.append(key)
                        done.append(repair(turns))
                        yield from flush(1000)
                    key, turns = i, []
                turns.extend([(n, role, text)] * copies)
    if turns is not None:
        ids.append(key)
        done.append(repair(turns))
    if schema is not None:
        yield from flush(1)


def _piece(rows: pd.DataFrame) -> pd.DataFrame:
    """The edges of one piece: per pair of tops the cheapest edits, and figures that add up over pieces."""
    rows = rows.sort_values("pos")
    turns = list(zip(rows["initial"], rows["fault"], strict=True))
    edges = [{"top": top, "to": to, "cost": cost, "audit": audit} for top, stack in PARSER.tops.items() for to, (cost, audit, _) in follow({top: (0, "", stack)}, turns).items()]
    numbers = [int(n) for n in rows["turn"] if not pd.isna(n)]
    initials = list(rows["initial"])
    fault = rows["fault"]
    illegal = sum(a + b not in LEGAL for a, b in zip(initials, initials[1:], strict=False))
    row = {
        "conv_id": rows["conv_id"].iloc[0], "piece": rows["piece"].iloc[0], "n": len(rows), "edges": edges, "lowest": min(numbers, default=None), "highest": max(numbers, default=None), "numbers": len(set(numbers)),
        "blank": int((fault == "blank").sum()), "duplicate": int((fault == "duplicate").sum()), "truncated": int((fault == "truncated").sum()), "illegal": illegal, "first": initials[0], "last": initials[-1],
    }
    return pd.DataFrame([row])


Edges = dict[tuple[int, int], tuple[int, str]]


def join_edges(a: Edges, b: Edges) -> Edges:
    """The cheapest edits over two neighbouring pieces, for every pair of tops."""
    out: Edges = {}
    for (top, mid), (cost, audit) in a.items():
        for (start, to), (more, rest) in b.items():
            if start == mid:
                found = (cost + more, audit + rest)
                if (top, to) not in out or found < out[top, to]:
                    out[top, to] = found
    return out


def _chosen(pieces: pd.DataFrame) -> pd.DataFrame:
    """Per piece the stack top before it and its share of the audit; the conversation's figures in the row of the first."""
    pieces = pieces.sort_values("piece")
    levels = [{(e["top"], e["to"]): (e["cost"], e["audit"]) for e in edges} for edges in pieces["edges"]]
    own = levels
    levels = [*levels, {(top, to): (cost, audit) for top, stack in PARSER.tops.items() for to, (cost, audit, _) in _inserted({top: (0, "", stack)}).items()}]
    while len(levels) > 1:  # by pairs, so a turn's edits are copied as often as there are levels
        levels = [join_edges(*levels[k : k + 2]) if k + 1 < len(levels) else levels[k] for k in range(0, len(levels), 2)]
    cost, audit = min(v for (top, to), v in levels[0].items() if top == PARSER.start[-1] and PARSER.accepts(PARSER.tops[to]))
    known = pieces[pieces["numbers"] > 0]
    shared = sum(int(a) == int(b) for a, b in zip(known["highest"], known["lowest"].iloc[1:], strict=False))
    missing = int(known["highest"].max()) - int(known["lowest"].min()) + 1 - (int(known["numbers"].sum()) - shared) if len(known) else 0
    illegal = int(pieces["illegal"].sum()) + sum(a + b not in LEGAL for a, b in zip(pieces["last"], pieces["first"].iloc[1:], strict=False))
    out, units, at, top = [], re.finditer("I*[^I]", audit), 0, PARSER.start[-1]
    for piece, n, edges in zip(pieces["piece"], pieces["n"], own, strict=True):
        for _ in range(int(n)):
            until = next(units).end()
        share, before = audit[at:until], top
        top = next(to for (start, to), (_, edits) in edges.items() if start == before and edits == share)
        out.append({"conv_id": pieces["conv_id"].iloc[0], "piece": piece, "top": before, "edits": share})
        at = until
    out[-1]["edits"] += audit[at:]
    out[0] |= {"gaps": missing, **{c: int(pieces[c].sum()) for c in ("blank", "duplicate", "truncated")}, "illegal": illegal, "cost": cost, "audit": audit}
    return pd.DataFrame(out, columns=["conv_id", "piece", "top", "edits", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"])


def _rewritten(rows: pd.DataFrame) -> pd.DataFrame:
    """The repaired lines of one piece, joined per turn; null where a turn gives none."""
    rows = rows.sort_values("pos")
    lines, _ = replay(PARSER.tops[int(rows["top"].iloc[0])], rows["edits"].iloc[0], zip(rows["role"], rows["text"], strict=True))
    lines[-2:] = [lines[-2] + lines[-1]]
    return pd.DataFrame({"conv_id": rows["conv_id"], "pos": rows["pos"], "line": ["\n".join(x) if x else None for x in lines]})


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 per conversation over sorted (id, line), a batch at a time."""
    key, running, n, schema = None, None, 0, None

    def row():
        return pa.RecordBatch.from_arrays([pa.array([key], schema), pa.array([running.hexdigest()])], names=["id", "digest"])

    for b in batches:
        schema = b.column(0).type
        for i, line in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True):
            if running is None or i != key:
                if running is not None:
                    yield row()
                key, running, n = i, hashlib.sha256(), 0
            if line is not None:
                running.update(("\n" if n else "").encode() + line.encode())
                n += 1
    if running is not None:
        yield row()


def _repair_large(turns: DataFrame) -> DataFrame:
    """The summaries of conversations that are too large for one task, from rows of (conv_id, turn, role, text, copies)."""
    id_type = turns.schema["conv_id"].dataType.simpleString()
    known = cut(turns.withColumn("copy", F.explode(F.expr("array_repeat(0, copies)"))).select("conv_id", "turn", "role", "text", F.unhex(F.sha2(F.concat("role", F.lit("\n"), F.sha2("text", 256)), 256)).alias("digest"), F.monotonically_increasing_id().alias("salt")))
    order = ["conv_id", "turn", "role", "text", F.xxhash64("salt")]  # equal rows may go to several tasks
    placed = cut(known.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("pos", F.monotonically_increasing_id()).drop("salt"))
    firsts = placed.groupBy("conv_id", "digest").agg(F.min("pos").alias("first")).select("first")
    bare = F.expr("translate(text, ' \\t\\n\\u000b\\f\\r', '')")
    fault = F.when(bare == "", "blank").when(F.col("first").isNull(), "duplicate").when(~F.right(bare, F.lit(1)).isin(".", "!", "?"), "truncated").otherwise("")
    piece = F.shiftright("pos", PIECE_BITS)
    narrow = placed.join(firsts, placed["pos"] == firsts["first"], "left").select("conv_id", piece.alias("piece"), "pos", "turn", F.left("role", F.lit(1)).alias("initial"), fault.alias("fault"))
    edge = "array<struct<top:int,to:int,cost:long,audit:string>>"
    found = narrow.groupBy("conv_id", "piece").applyInPandas(_piece, f"conv_id {id_type}, piece long, n long, edges {edge}, lowest long, highest long, numbers long, blank long, duplicate long, truncated long, illegal long, first string, last string")
    chosen = cut(found.groupBy("conv_id").applyInPandas(_chosen, f"conv_id {id_type}, piece long, top int, edits string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"))
    share = chosen.select(F.col("conv_id").alias("_conv_id"), F.col("piece").alias("_piece"), "top", "edits")
    with_edits = placed.withColumn("piece", piece).join(share, F.col("conv_id").eqNullSafe(F.col("_conv_id")) & (F.col("piece") == F.col("_piece")))
    lines = with_edits.select("conv_id", "piece", "pos", "role", "text", "top", "edits").groupBy("conv_id", "piece").applyInPandas(_rewritten, f"conv_id {id_type}, pos long, line string")
    digests = lines.repartition("conv_id").sortWithinPartitions("conv_id", "pos").mapInArrow(_digests, f"id {id_type}, digest string")
    figures = chosen.where("audit is not null")
    return figures.join(digests, F.col("conv_id").eqNullSafe(F.col("id"))).select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", F.col("digest").alias("repaired_sha256"))


def repair_conversations(turns: DataFrame, *, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", copies_col: str | None = None, most_rows: int = MOST_ROWS, most_bytes: int = MOST_BYTES) -> DataFrame:
    """A row per id: gaps, blank, duplicate, truncated, illegal, cost, audit and the repaired text's digest.

    ``copies_col`` says how often a row stands there, 0 included; a conversation of none is empty.
    """
    since = live_cuts()
    one = F.lit(1) if copies_col is None else F.col(copies_col)
    turns = turns.select(F.col(id_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), F.coalesce(role_col, F.lit(" ")).alias("role"), F.coalesce(text_col, F.lit(" ")).alias("text"), one.cast("int").alias("copies"))
    sizes = turns.groupBy("conv_id").agg(F.count("*").alias("n"), F.sum("copies").alias("n_turns"), F.sum(F.octet_length("text") * F.col("copies")).alias("n_bytes"))
    large = cut(sizes.where((F.col("n") > most_rows) | (F.col("n_turns") > most_rows) | (F.col("n_bytes") > most_bytes)).select("conv_id", "n", F.lit(True).alias("large")))
    rest, far = turns, None
    if not large.isEmpty():
        marked = cut(hot_join(turns, large, ["conv_id"], "n", turns.count(), "left"))
        rest, far = marked.where("large is null"), _repair_large(marked.where("large").drop("n", "large"))
    schema = f"id {turns.schema['conv_id'].dataType.simpleString()}, {SUMMARY}"
    rest = rest.select("conv_id", "turn", "role", "text", "copies")
    near = rest.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(_whole, schema).withColumnRenamed("id", "conv_id")
    if far is not None:
        near = near.unionByName(far)
    else:
        tidy(turns.sparkSession, since)
    return near.withColumnRenamed("conv_id", id_col)


def damage(turns: DataFrame, *, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Rows of id, number, role, text and copies after the damage that a row's id and number choose."""
    texts = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (id_col, turn_col, role_col, text_col)}
    kind = F.crc32(F.concat(texts[id_col], F.lit(":"), texts[turn_col])) % 20
    role = F.when(kind == 4, "user").otherwise(texts[role_col])
    text = F.when(kind.isin(0, 1), "").when(kind == 2, F.translate(texts[text_col], ".!?", "")).otherwise(texts[text_col])
    copies = F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1)
    return turns.select(F.col(id_col), F.col(turn_col), role.alias(role_col), text.alias(text_col), copies.alias("copies"))


def op13_chat_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_conversations(damage(table(spark, sf_dir, "conversations")), copies_col="copies")
