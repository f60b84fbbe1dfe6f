"""Toxicity by a weighted pattern grammar of composed finite-state transducers.

A text is a sequence of token classes (insult, threat, target, intent, negation, report,
quotation mark, clause end, other). Transducers rewrite it one after the other: each
reads what the one before it wrote and marks insults and threats with

    targeted   a person who isn't the one reported is named up to four tokens before,
    intended   will, shall, deserve ... up to four tokens before a threat,
    reached    a threat whose object, a person, follows up to three tokens later,
    negated    a negation up to three tokens before,
    reported   the rest of a clause after said, wrote ..., or a quotation.

``compose`` joins them to one machine, whose reachable states are tabulated; a text is scanned once.
Only matched clauses count. A match has the probability

    p = p(marks) * p(word),

a word counts once, in the clause where it is likeliest meant, and a text without matches has p0; the
score is 1 - (1 - p0) * product of (1 - p) over the words.

The words are those listed here and what ``learn`` finds: beginnings of longer words (3 to
8 characters) and whole words that are held by toxic rows without a listed word so
much more often than by others that chance among all that were tried doesn't explain
it; the one that stands out most is taken, the rows that hold it are set aside, and so on. The
probabilities are then fitted to the labels by expectation maximisation, so that a word isn't blamed for what another
one explains; they are drawn towards the values given here by some rows' weight, and those of words behind a beginning
towards its own. Labels are learned from at most ``sample_rows`` rows, with at most ``most_stems`` beginnings on the
driver at once; neither grows with the corpus. Scoring runs over every whole text.

Defined cases: a null text counts as an empty one and gets p0; a null id isn't
held out and never learned from; of several labels of one id the highest counts;
rows of one id are learned from once, by the text of the smallest digest. Without labelled
rows the values given here stand. Every row gives a row, an empty table none. Other columns, language and
source among them, play no part.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, free_names, live_cuts, pieces_of, table, tidy

#: Bounds on the labelled rows learned from and on the beginnings compared.
SAMPLE_ROWS, MOST_STEMS = 8000, 200_000
CUT = 0.3
#: A stem is one that chance would give less than once in so many fits; toxic rows are this share of its rows at least.
ODDS, LEAST_SHARE = 10, 0.5
LENGTHS = range(3, 9)
#: Rows whose weight the given probabilities have, for listed and for learned words.
WEIGHT, LEARNED_WEIGHT = 4, 2
P_NONE, NONE_WEIGHT = 0.05, 20

INSULTS = """idiot idiots idiotic moron morons moronic imbecile imbeciles stupid dumb dumbass stupidity scum scumbag scumbags loser losers pathetic worthless disgusting
vermin bastard bastards bitch asshole assholes jerk dimwit retard retards idioten vollidiot dummkopf trottel arschloch versager abschaum imbécile imbéciles crétin crétins connard connards
abruti abrutis idiota idiotas imbécil imbéciles estúpido estúpida escoria""".split()
#: Words that are insults of people and harmless otherwise.
DOUBTFUL = "trash garbage clown clowns fool fools foolish pig pigs ugly useless liar liars freak freaks creep filth filthy coward cowards rat rats ordure basura payaso dreck müll".split()
CLASSES = {
    "threat": "kill murder hurt destroy beat shoot stab strangle burn smash crush hang die töten umbringen tuer matar".split(),
    "target": "you your yours yourself u ur he him his she her they them their people everyone all guys du dich dir ihr euch vous toi tu te usted ustedes ellos".split(),
    "intent": "will ll gonna going shall should must want wants would deserve deserves hope ought werde werden soll vais va voy debe".split(),
    "not": "not no never nor neither nobody hardly without isn aren wasn weren don doesn didn cannot nicht kein keine nie ne pas jamais nunca".split(),
    "said": "said says say saying told tells wrote writes claimed claims called calls reported reports quoted alleged allegedly sagte schrieb dit écrit dijo escribió".split(),
}
OPEN, CLOSE, END, OTHER = "open", "close", "end", "other"
ALPHABET = [OTHER, "insult", *CLASSES, OPEN, CLOSE, END]

#: Probabilities of a match by its marks, before labels are seen.
GIVEN = {
    "insult": 0.75, "insult targeted": 0.97, "insult negated": 0.2, "insult reported": 0.25, "insult targeted negated": 0.25, "insult targeted reported": 0.28, "insult negated reported": 0.1, "insult targeted negated reported": 0.1,
    "threat": 0.9, "threat negated": 0.1, "threat reported": 0.2, "threat negated reported": 0.1, "menace": 0.35, "menace negated": 0.05, "menace reported": 0.1, "menace negated reported": 0.05,
}
MATCHES = ["", *GIVEN]

_TOKEN = re.compile(r"[^\W_]+|[.!?;\n]|[\"“”„«»]")
_WORD = re.compile(r"[^\W_]+")


@dataclass(frozen=True)
class Transducer:
    """A deterministic transducer: step(state, symbol) gives the next state and the symbol written. Symbols are a class and its marks, separated by spaces."""

    start: object
    step: Callable[[object, str], tuple[object, str]]


def scope(openers: set[str], marked: set[str], mark: str, length: int | None, closers: frozenset[str] = frozenset({END})) -> Transducer:
    """Marks what comes up to ``length`` tokens after an opener and before a closer; without a length, all up to there."""

    def step(left: int, symbol: str) -> tuple[int, str]:
        cls = symbol.partition(" ")[0]
        if cls in closers:
            return 0, symbol
        out = f"{symbol} {mark}" if left and cls in marked else symbol
        return (length or 1) if cls in openers else max(0, left - 1) if length else left, out

    return Transducer(0, step)


def quotation(marked: set[str], mark: str) -> Transducer:
    """Marks what stands in quotation marks."""

    def step(inside: bool, symbol: str) -> tuple[bool, str]:
        cls = symbol.partition(" ")[0]
        if cls in (OPEN, CLOSE):
            return cls == OPEN, symbol
        again = inside and cls in marked and mark not in symbol
        return inside, f"{symbol} {mark}" if again else symbol

    return Transducer(False, step)


def reach(length: int) -> Transducer:
    """Writes the match of a threat: at once where it is targeted and intended, else at its object, a person up to ``length`` tokens behind it."""

    def step(state: tuple[int, str], symbol: str) -> tuple[tuple[int, str], str]:
        left, pending = state
        cls, *marks = symbol.split()
        kept = " ".join(m for m in ("negated", "reported") if m in marks)
        if cls == END:
            return (0, ""), symbol
        if cls == "threat":
            if {"targeted", "intended"} <= set(marks):
                return (0, ""), f"threat {kept}".strip()
            return (length, f"{'threat' if 'intended' in marks else 'menace'} {kept}".strip()), OTHER
        if cls == "target" and left:
            return (0, ""), pending
        return (left - 1, pending) if left > 1 else (0, ""), symbol

    return Transducer((0, ""), step)


def compose(first: Transducer, second: Transducer) -> Transducer:
    """The second one reads what the first one writes."""

    def step(state: tuple, symbol: str) -> tuple[tuple, str]:
        a, out = first.step(state[0], symbol)
        b, out = second.step(state[1], out)
        return (a, b), out

    return Transducer((first.start, second.start), step)


def grammar() -> Transducer:
    bad = {"insult", "threat"}
    out = scope({"target"}, bad, "targeted", 4, frozenset({END, OPEN, "said"}))  # who says something is not spoken to
    for part in (scope({"intent"}, {"threat"}, "intended", 4), scope({"not"}, bad, "negated", 3), scope({"said"}, bad, "reported", None), quotation(bad, "reported"), reach(3)):
        out = compose(out, part)
    return out


def tabulate(machine: Transducer, alphabet: list[str] = ALPHABET) -> tuple[list[list[int]], list[list[int]]]:
    """Per reachable state and class: the next state, and the match written (an index of MATCHES)."""
    known, queue, to, out = {machine.start: 0}, [machine.start], [], []
    for state in queue:
        moves = [machine.step(state, symbol) for symbol in alphabet]
        for s, _ in moves:
            if s not in known:
                known[s] = len(known)
                queue.append(s)
        to.append([known[s] for s, _ in moves])
        out.append([MATCHES.index(y) if y in GIVEN else 0 for _, y in moves])
    return to, out


GIVEN_WORDS = {*INSULTS, *DOUBTFUL}
_TO, _OUT = tabulate(grammar())
_CLASS = {c: k for k, c in enumerate(ALPHABET)}
_BREAKS = {**dict.fromkeys(".!?;\n", _CLASS[END]), **dict.fromkeys("“„«", _CLASS[OPEN]), **dict.fromkeys("”»", _CLASS[CLOSE])}


@dataclass
class Lexicon:
    """Classes of words, and with what probability an insult is meant as such."""

    words: dict[str, float] = field(default_factory=lambda: {**dict.fromkeys(INSULTS, 0.97), **dict.fromkeys(DOUBTFUL, 0.35)})
    stems: dict[str, float] = field(default_factory=dict)  # beginnings of longer words
    by_marks: dict[str, float] = field(default_factory=lambda: dict(GIVEN))
    none: float = P_NONE

    def __post_init__(self):
        self._classes = {w: _CLASS[c] for c, ws in CLASSES.items() for w in ws} | dict.fromkeys(self.words, _CLASS["insult"])
        self._found: dict[str, int] = {}

    def stem_of(self, word: str) -> str | None:
        return next((word[:n] for n in LENGTHS if n < len(word) and word[:n] in self.stems), None)

    def class_of(self, word: str) -> int:
        got = self._classes.get(word)
        if got is None:
            got = self._found.get(word)
        if got is None:
            got = _CLASS["insult"] if self.stem_of(word) else _CLASS[OTHER]
            if len(self._found) > 200_000:  # a cache for the worker
                self._found.clear()
            self._found[word] = got
        return got

    def matches(self, text: str) -> list[tuple[int, str, str]]:
        """(clause, marks, word) in order; the word is empty where a threat is matched."""
        text = text.lower()
        bad = (_CLASS["insult"], _CLASS["threat"])
        if not any(self.class_of(w) in bad for w in set(_WORD.findall(text))):
            return []
        out, state, clause = [], 0, 0
        for m in _TOKEN.finditer(text):
            token = m.group()
            if token == '"':  # opens where it leans on what follows
                before, after = text[m.start() - 1 : m.start()], text[m.end() : m.end() + 1]
                cls = _CLASS[OPEN if not before.strip() and after.strip() else CLOSE]
            else:
                cls = _BREAKS[token] if token in _BREAKS else self.class_of(token)
            hit, state = _OUT[state][cls], _TO[state][cls]
            clause += cls == _CLASS[END]
            if hit:
                out.append((clause, MATCHES[hit], token if cls == _CLASS["insult"] else ""))
        return out

    def p_word(self, word: str) -> float:
        return self.words[word] if word in self.words else self.stems[self.stem_of(word)] if word else 1.0

    def found(self, text: str) -> dict[str, tuple[float, str, int]]:
        """Per word (empty: a threat) its likeliest match: probability, marks, clause."""
        best: dict[str, tuple[float, str, int]] = {}
        for clause, marks, word in self.matches(text):
            one = (self.by_marks[marks] * self.p_word(word), marks, -clause)
            best[word] = max(best.get(word, one), one)
        return {w: (p, marks, -clause) for w, (p, marks, clause) in best.items()}

    def score(self, text: str | None) -> float:
        return 1 - math.prod((1 - p for p, _, _ in self.found(text or "").values()), start=1 - self.none)


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def beginnings(text: str) -> set[str]:
    """Beginnings of its longer words (with *), and its words."""
    words = {w for w in _WORD.findall(text.lower()) if len(w) >= LENGTHS[0]}
    return words | {w[:n] + "*" for w in words for n in LENGTHS if n < len(w)}


def surprise(toxic: np.ndarray, clean: np.ndarray, rate: float) -> np.ndarray:
    """How little chance explains so many toxic rows among the rows that hold it: the binomial's large-deviation bound, in nats; 0 where there are fewer than by chance."""
    n = np.maximum(toxic + clean, 1)
    share = toxic / n
    with np.errstate(divide="ignore", invalid="ignore"):
        out = n * (np.where(share > 0, share * np.log(share / rate), 0) + np.where(share < 1, (1 - share) * np.log((1 - share) / (1 - rate)), 0))
    return np.where(share > rate, out, 0.0)


def telling(toxic: np.ndarray, clean: np.ndarray, rate: float, tried: int) -> np.ndarray:
    """Surprise where it is more than chance among so many tried, 0 elsewhere."""
    gain = surprise(toxic, clean, rate)
    return np.where((gain >= math.log(max(tried, 1) * ODDS)) & (toxic >= LEAST_SHARE * (toxic + clean)), gain, 0.0)


def choose_stems(held: list[set[str]], clean: dict[str, int], rate: float, tried: int) -> dict[str, float]:
    """Stems one after the other, with their share of toxic rows: the one that stands out most among the rows (their beginnings) not yet set aside, the longest of equals."""
    out: dict[str, float] = {}
    rows = [h for h in held if h]
    while rows:
        counts = Counter(s for h in rows for s in h)
        names = sorted(counts)
        gain = telling(np.array([counts[s] for s in names], float), np.array([clean.get(s, 0) for s in names], float), rate, tried)
        k = max(range(len(names)), key=lambda i: (round(gain[i], 9), len(names[i]), names[i]))
        if not gain[k]:
            break
        name = names[k]
        out[name] = (counts[name] + 1) / (counts[name] + clean.get(name, 0) + 2)
        rows = [h for h in rows if name not in h]
    return out


def fit(rows: list[tuple[bool, list[str], list[str]]], lexicon: Lexicon, rounds: int = 60) -> Lexicon:
    """Probabilities of words, marks and no match from rows of (toxic, words, their marks), by expectation maximisation of the score's own formula."""
    seen = sorted({w for _, ws, _ in rows for w in ws if w})
    names = ["", *sorted({*lexicon.words, *seen})]
    given = np.array([lexicon.p_word(w) for w in names])
    weight = np.array([WEIGHT if w in GIVEN_WORDS else LEARNED_WEIGHT for w in names], float)
    at = {w: k for k, w in enumerate(names)}
    marks = list(GIVEN)
    given_marks = np.array([GIVEN[m] for m in marks])
    row = np.repeat(np.arange(len(rows)), [len(ws) for _, ws, _ in rows]).astype(np.int64)
    e = np.array([at[w] for _, ws, _ in rows for w in ws], np.int64)
    t = np.array([marks.index(m) for _, _, ms in rows for m in ms], np.int64)
    toxic = np.array([x for x, _, _ in rows], bool)
    stem = [None if w in lexicon.words else lexicon.stem_of(w) for w in names]
    groups = [np.array([k for k, x in enumerate(stem) if x == s], np.int64) for s in lexicon.stems]
    q, m, none = given.copy(), given_marks.copy(), lexicon.none
    for _ in range(rounds):
        p = np.minimum(q[e] * m[t], 0.99)
        whole = 1 - (1 - none) * np.exp(np.bincount(row, np.log1p(-p), len(rows)))
        due = np.where(toxic[row], p / whole[row], 0.0)
        blamed, met = np.bincount(e, due, len(names)), np.bincount(e, m[t], len(names))
        for s, of in zip(lexicon.stems, groups, strict=True):  # words behind one beginning are drawn to what all of them show
            given[of] = (blamed[of].sum() + LEARNED_WEIGHT * lexicon.stems[s]) / (met[of].sum() + LEARNED_WEIGHT)
        q, m = (blamed + weight * given) / (met + weight), (np.bincount(t, due, len(marks)) + WEIGHT * given_marks) / (np.bincount(t, q[e], len(marks)) + WEIGHT)
        none = float((np.where(toxic, none / whole, 0.0).sum() + NONE_WEIGHT * P_NONE) / (len(rows) + NONE_WEIGHT))
        q, m = np.minimum(q, 0.99), np.minimum(m, 1.0)
        q[0] = 1.0
    words = {w: float(q[k]) for w, k in at.items() if w}
    stems = {s: float(given[of[0]]) if len(of) else p for (s, p), of in zip(lexicon.stems.items(), groups, strict=True)}
    return Lexicon(words=words, stems=stems, by_marks={x: float(m[k]) for k, x in enumerate(marks)}, none=none)


def _sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, sample_rows: int) -> DataFrame:
    """(key, text, label) of the labelled ids with the smallest hashes that aren't held out."""
    key, label = free_names(docs, "_key", "_label")
    usable = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(F.col(id_col)))
    ids = usable.groupBy(F.col(id_col).alias(key)).agg(F.max(label_col).cast("int").alias(label)).orderBy(F.xxhash64(key), key).limit(sample_rows)
    found = docs.join(F.broadcast(ids), docs[id_col] == ids[key]).select(F.col(key).alias("key"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.col(label).alias("label"))
    return cut(found.groupBy("key", "label").agg(F.min_by("text", F.md5("text")).alias("text")))


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, str]]:
    for b in batches:
        for p in pieces_of(iter([b]), 64):
            yield from zip(p.column(0).to_pylist(), p.column(1).to_pylist(), strict=True)


def learn(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample_rows: int = SAMPLE_ROWS, most_stems: int = MOST_STEMS) -> Lexicon:
    """A lexicon with stems and probabilities from the labelled rows that are not held out."""
    spark, since, given = docs.sparkSession, live_cuts(), Lexicon()
    sample = _sample(docs, labels, id_col, text_col, label_col, sample_rows).select("label", "text")

    def unexplained(batches):
        for label, text in _texts(batches):
            if not given.matches(text):
                yield pa.RecordBatch.from_arrays([pa.array([label]).cast(pa.int32()), pa.array([sorted(beginnings(text)) if label == 1 else []], pa.list_(pa.string()))], names=["label", "stems"])

    rows = cut(sample.mapInArrow(unexplained, "label int, stems array<string>"))
    sizes = {r["label"] == 1: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    held = rows.where("label = 1").withColumn("row", F.monotonically_increasing_id())
    counted = held.select(F.explode("stems").alias("stem")).groupBy("stem").agg(F.count("*").alias("n")).where("n >= 3")
    tried = [r["stem"] for r in counted.orderBy(F.desc("n"), "stem").limit(most_stems).collect()]
    stems: dict[str, float] = {}
    if tried and sizes.get(False):
        shared = spark.sparkContext.broadcast({s: k for k, s in enumerate(tried)})

        def others(batches):
            known, counts = shared.value, np.zeros(len(shared.value), np.int64)
            for label, text in _texts(batches):
                if label != 1 and not given.matches(text):
                    at = [known[s] for s in beginnings(text) if s in known]
                    counts[at] += 1
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], names=["stem", "n"])

        clean_of = sample.mapInArrow(others, "stem long, n long").groupBy("stem").agg(F.sum("n").alias("n")).collect()  # most_stems at most
        clean = {tried[r["stem"]]: r["n"] for r in clean_of}
        toxic = {r["stem"]: r["n"] for r in counted.collect() if r["stem"] in shared.value}
        rate = sizes.get(True, 0) / (sizes.get(True, 0) + sizes[False])
        gain = telling(np.array([toxic[s] for s in tried], float), np.array([clean.get(s, 0) for s in tried], float), rate, len(tried))
        own = spark.sparkContext.broadcast({s for s, g in zip(tried, gain, strict=True) if g})

        def told(batches):
            for b in batches:
                for got in b.column(1).to_pylist():
                    yield pa.RecordBatch.from_arrays([pa.array([[s for s in got if s in own.value]], pa.list_(pa.string()))], names=["stems"])

        kept = rows.where("label = 1").mapInArrow(told, "stems array<string>").collect()  # sample_rows at most
        stems = choose_stems([set(r["stems"]) for r in kept], clean, rate, len(tried))

    lexicon = Lexicon(stems={s[:-1]: p for s, p in stems.items() if s[-1] == "*"})
    lexicon = Lexicon(words=lexicon.words | {s: p for s, p in stems.items() if s[-1] != "*"}, stems=lexicon.stems)

    def matched(batches):
        for label, text in _texts(batches):
            found = sorted((w, marks) for w, (_, marks, _) in lexicon.found(text).items())
            yield pa.RecordBatch.from_arrays([pa.array([label == 1]), *(pa.array([[x[k] for x in found]], pa.list_(pa.string())) for k in (0, 1))], names=["toxic", "words", "marks"])

    rows = sample.mapInArrow(matched, "toxic boolean, words array<string>, marks array<string>").collect()  # sample_rows at most, each with lexicon words alone
    tidy(spark, since)
    return fit(sorted((r["toxic"], r["words"], r["marks"]) for r in rows), lexicon)


def score(docs: DataFrame, lexicon: Lexicon, *, id_col: str = "doc_id", text_col: str = "text", cut: float = CUT) -> DataFrame:
    """Per row: id, held_out, score, predicted (1 where the score reaches ``cut``), n_words matched, and the likeliest one with its marks and clause (from 0)."""
    src = docs.select(F.col(id_col), F.col(text_col))
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)
    types = {"score": pa.float64(), "n_words": pa.int64(), "word": pa.string(), "marks": pa.string(), "clause": pa.int64()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for b in pieces_of(batches):
            rows = []
            for text in b.column(1).to_pylist():
                found = known.found(text or "")
                top = max(((p, -clause, w, marks) for w, (p, marks, clause) in found.items()), default=(0.0, None, None, None))
                clean = math.prod((1 - p for p, _, _ in found.values()), start=1 - known.none)
                rows.append((1 - clean, len(found), top[2] or None, top[3], None if top[1] is None else -top[1]))
            cols = list(zip(*rows, strict=True)) or [[]] * len(types)
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, t) for c, t in zip(cols, types.values(), strict=True))], names=[id_col, *types])

    out = src.mapInArrow(run, f"`{id_col}` {src.schema[0].dataType.simpleString()}, score double, n_words long, word string, marks string, clause long")
    return out.select(id_col, held_out(F.col(id_col)).alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted"), "n_words", "word", "marks", "clause")


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, learn(docs, table(spark, sf_dir, "labels")))
