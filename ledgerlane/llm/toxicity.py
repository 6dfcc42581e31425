"""Toxicity scores of matched clauses, by a weighted finite-state pattern grammar."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlane.llm.common import give_back, held_out, in_few_files, labelled_sample, stored, utf8

# Labelled rows that insult stems and weights are learned from, at most.
FIT_ROWS = 20_000

# Symbols of the grammar; END stands after the last word of a clause.
OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, LINK, END = range(8)

# Closed word classes of English, German, French and Spanish, and a few open ones to start from.
WORDS = {
    TARGET: "you your yourself he him his she her they them their du dich dir dein ihr euch er ihn sie "
    "tu toi vous votre lui leur usted ustedes vosotros ellos ella",
    NEGATION: "not no never isn't aren't don't nobody kein keine nicht nie ne pas jamais nunca jamás",
    REPORT: "said says say told wrote called calls claimed quoted according sagte schrieb nannte laut dit "
    "disait écrit selon dijo dice escribió según",
    # Words that may stand between a verb of saying and what was said.
    LINK: "that it is are was were be been a an the such as to dass es ist sind war ein eine que est sont était "
    "un une son era una",
    THREAT: "kill killing murder hurt stab strangle töten umbringen tuer matar",
    INSULT: "idiot moron scum imbecile trottel dummkopf imbécile crétin idiota imbécil",
}

# A stem is a word's first bytes; shorter words count as a whole.
STEM_BYTES = (4, 5, 6, 7, 8)

_SPACED = bytes(
    (c + 32 if 65 <= c <= 90 else c) if chr(c).isalnum() or c in (39, *range(128, 256)) else 32
    for c in range(256)
)
_CLAUSE = re.compile(rb"[.!?;:\n]+")


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_SPACED).split()


def fixed_symbols() -> dict[bytes, int]:
    return {w.encode(): symbol for symbol, words in WORDS.items() for w in words.split()}


# --- The grammar: sequential transducers over symbols, composed into one --------------------------
#
# A transducer is a pair of tables: next[state, symbol] and out[state, symbol]. Negation and reported speech
# pass all symbols on and mark attacks in their scope; the insult and the threat transducer read what
# they pass on and put out a matched pattern, with or without a target, once that is settled.

# Words after a negation that it reaches, and words after an attack in which its target may still come.
NEGATION_REACH = 4
TARGET_REACH = 3

# Marks of an attack: bits of a pattern's number.
TARGETED, NEGATED, REPORTED = 1, 2, 4
PATTERNS = 8
NOTHING = 0


@dataclass(frozen=True)
class Transducer:
    next: np.ndarray
    out: np.ndarray


def _marked(symbol: int, marks: int) -> int:
    """Symbols beyond END are marked attacks: kind and marks."""
    return END + 1 + (symbol == THREAT) * PATTERNS + marks


def _unmarked(symbol: int) -> tuple[int, int]:
    if symbol in (INSULT, THREAT):
        return symbol, 0
    if symbol > END:
        kind, marks = divmod(symbol - END - 1, PATTERNS)
        return (THREAT if kind else INSULT), marks
    return symbol, 0


SYMBOLS = END + 1 + 2 * PATTERNS


def _table(states: int, step: Callable[[int, int], tuple[int, int]]) -> Transducer:
    cells = [[step(state, symbol) for symbol in range(SYMBOLS)] for state in range(states)]
    return Transducer(np.array([[c[0] for c in row] for row in cells]), np.array([[c[1] for c in row] for row in cells]))


def negation() -> Transducer:
    """Marks attacks up to NEGATION_REACH words after a negation. A state counts the words that are left."""

    def step(left: int, symbol: int) -> tuple[int, int]:
        kind, marks = _unmarked(symbol)
        if kind == END:
            return 0, symbol
        if kind in (INSULT, THREAT):
            return max(left - 1, 0), _marked(kind, marks | (NEGATED if left else 0))
        return (NEGATION_REACH if kind == NEGATION else max(left - 1, 0)), symbol

    return _table(NEGATION_REACH + 1, step)


def reported_speech() -> Transducer:
    """Marks attacks after a verb of saying, unless another word has come first: that is what was said."""

    def step(inside: int, symbol: int) -> tuple[int, int]:
        kind, marks = _unmarked(symbol)
        if kind in (INSULT, THREAT):
            return inside, _marked(kind, marks | (REPORTED if inside else 0))
        if kind == REPORT:
            return 1, symbol
        return (0 if kind in (OTHER, END) else inside), symbol

    return _table(2, step)


def attack(kind: int) -> Transducer:
    """Matches attacks of one kind; puts out 1 + marks of a matched pattern, or NOTHING.

    An attack has a target if one stands before it in the clause, or up to TARGET_REACH words after it. While
    that is open the attack waits: a state holds whether a target was seen, and the marks and words left of
    what waits. Of two that wait in a row the first had none.
    """
    waiting = [(marks, left) for marks in (0, NEGATED, REPORTED, NEGATED | REPORTED) for left in range(1, TARGET_REACH + 1)]
    states = [(seen, held) for seen in (False, True) for held in (None, *waiting)]
    number = {state: n for n, state in enumerate(states)}

    def step(state: int, symbol: int) -> tuple[int, int]:
        seen, held = states[state]
        own, marks = _unmarked(symbol)
        marks &= NEGATED | REPORTED
        without = NOTHING if held is None else 1 + held[0]
        if own == END:
            return number[False, None], without
        if own == TARGET:
            return number[True, None], NOTHING if held is None else 1 + (held[0] | TARGETED)
        if own == kind and seen:
            return number[True, None], 1 + (marks | TARGETED)
        if own == kind:
            return number[False, (marks, TARGET_REACH)], without
        if held is None:
            return state, NOTHING
        if held[1] == 1:
            return number[seen, None], without
        return number[seen, (held[0], held[1] - 1)], NOTHING

    return _table(len(states), step)


def cascade(first: Transducer, second: Transducer) -> Transducer:
    """What `first` puts out is what `second` reads."""
    a, b = len(first.next), len(second.next)
    passed = np.repeat(first.out, b, axis=0)
    own = np.tile(np.arange(b), a)[:, None]
    return Transducer(np.repeat(first.next, b, axis=0) * b + second.next[own, passed], second.out[own, passed])


def beside(one: Transducer, other: Transducer) -> Transducer:
    """Both read the same; outputs are put into one number."""
    a, b = len(one.next), len(other.next)
    return Transducer(np.repeat(one.next, b, axis=0) * b + np.tile(other.next, (a, 1)),
                      np.repeat(one.out, b, axis=0) * (PATTERNS + 1) + np.tile(other.out, (a, 1)))


GRAMMAR = cascade(cascade(negation(), reported_speech()), beside(attack(INSULT), attack(THREAT)))
# Plain lists: a clause is read symbol by symbol.
_NEXT, _OUT = GRAMMAR.next[:, : END + 1].tolist(), GRAMMAR.out[:, : END + 1].tolist()

# Features of a text: matched patterns by kind (insult, threat) and marks, and how dense they are.
FEATURES = 2 * PATTERNS + 1


def matched(symbols: list[int]) -> list[int]:
    """Numbers of the patterns that a clause matches: marks, plus PATTERNS for threats."""
    state, found = 0, []
    for symbol in (*symbols, END):
        insult, threat = divmod(_OUT[state][symbol], PATTERNS + 1)
        if insult:
            found.append(insult - 1)
        if threat:
            found.append(PATTERNS + threat - 1)
        state = _NEXT[state][symbol]
    return found


@dataclass
class Grammar:
    """Word symbols, insult stems, and the weight of each feature."""

    fixed: dict[bytes, int]
    stems: frozenset[bytes]
    weights: np.ndarray
    bias: float

    def symbol(self, word: bytes) -> int:
        known = self.fixed.get(word, OTHER)
        if known != OTHER:
            return known
        return INSULT if any(word[:n] in self.stems for n in STEM_BYTES) else OTHER

    def features(self, text: bytes) -> np.ndarray:
        out = np.zeros(FEATURES)
        words = words_of(text)
        attacks = {w for w in set(words) if self.symbol(w) in (INSULT, THREAT)}
        if not attacks:
            return out
        for clause in _CLAUSE.split(text):
            inside = words_of(clause)
            if attacks.isdisjoint(inside):
                continue
            for pattern in matched([self.symbol(w) for w in inside]):
                out[pattern] += 1
        total = out.sum()
        out = np.log1p(out)
        out[-1] = total / len(words)
        return out

    def table(self, texts: pa.Array) -> np.ndarray:
        rows = [self.features(t) for t in utf8(texts)]
        return np.array(rows).reshape(len(rows), FEATURES)

    def score(self, table: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.bias + table @ self.weights)))


def prior() -> tuple[np.ndarray, float]:
    """Weights of the patterns before any label is seen: a target adds, negation and reported speech take away."""
    weights = np.zeros(FEATURES)
    for marks in range(PATTERNS):
        targeted, negated, reported = (bool(marks & m) for m in (TARGETED, NEGATED, REPORTED))
        weights[marks] = 4 + targeted - 2 * negated - 2 * reported
        weights[PATTERNS + marks] = 2 + 2 * targeted - 2 * negated - 2 * reported
    weights[-1] = 1
    return weights, -2.0


def fit_weights(x: np.ndarray, y: np.ndarray, pull: float = 0.3) -> tuple[np.ndarray, float]:
    """Logistic regression drawn towards the prior, by Newton steps; without rows, the prior."""
    weights, bias = prior()
    start = np.append(weights, bias)
    beta = start.copy()
    design = np.hstack([x, np.ones((len(x), 1))])
    for _ in range(30 if len(y) else 0):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        slope = design.T @ (p - y) + pull * (beta - start)
        bend = (design * (p * (1 - p))[:, None]).T @ design + pull * np.eye(len(beta))
        step = np.linalg.solve(bend, slope)
        beta -= step
        if np.abs(step).max() < 1e-8:
            break
    return beta[:-1], float(beta[-1])


def _stems(word: bytes) -> set[bytes]:
    return {word[:n] for n in STEM_BYTES}


def _toxic_stems(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per text: each stem with the words beside it."""
    for batch in batches:
        rows: list[tuple[int, bytes, bytes]] = []
        for number, text in zip(batch.column("row").to_pylist(), utf8(batch.column("text")), strict=True):
            words = words_of(text)
            beside = zip([b""] + words[:-1], words, words[1:] + [b""], strict=True)
            found = {(s, a + b" " + b) for a, word, b in beside for s in _stems(word)}
            rows += [(number, *x) for x in found]
        columns = zip(*rows, strict=True) if rows else ([], [], [])
        types = (pa.int64(), pa.binary(), pa.binary())
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(c), t) for c, t in zip(columns, types, strict=True)],
            names=["row", "stem", "beside"],
        )


def _clean_stems(wanted: frozenset[bytes], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found: list[bytes] = []
        for text in utf8(batch.column("text")):
            found += set().union(*map(_stems, set(words_of(text)))) & wanted
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], names=["stem"])


def evidence(toxic: np.ndarray, clean: np.ndarray, share: float) -> np.ndarray:
    """How unlikely (minus the logarithm) so many of a word's texts are toxic by chance, at least.

    `share` of all texts are toxic; Chernoff's bound of the binomial tail.
    """
    n = toxic + clean
    part = toxic / n
    with np.errstate(divide="ignore", invalid="ignore"):
        rest = np.where(clean > 0, (1 - part) * np.log((1 - part) / (1 - share)), 0)
        return np.where(part > share, n * (part * np.log(part / share) + rest), 0)


def learn_stems(
    sample: DataFrame, least: int = 5, followed: float = 0.2, odds: float = 20.0
) -> frozenset[bytes]:
    """Stems that mark toxic texts in the sample, however many insults share these.

    A stem must stand in at least `least` toxic texts, have varied words beside it (at least
    `followed` of its texts and 3; words of a copied passage have not), be `odds` times as
    frequent as in clean texts, and so by more than chance: of all stems that are tested, less
    than one is expected to pass without cause.
    """
    rows = sample.withColumn("row", F.monotonically_increasing_id())
    toxic, clean = rows.filter("label = 1"), rows.filter("label = 0")
    n = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_toxic, n_clean = n.get(1, 0), n.get(0, 0)
    found = (
        toxic.select("row", "text").mapInArrow(_toxic_stems, "row long, stem binary, beside binary")
        .groupBy("stem")
        .agg(F.countDistinct("row").alias("n"), F.countDistinct("beside").alias("followers"))
        .filter((F.col("n") >= least) & (F.col("followers") >= F.greatest(F.lit(3), followed * F.col("n"))))
        .collect()
    )
    toxic_counts = {bytes(r["stem"]): r["n"] for r in found}
    counted = (
        clean.select("text").mapInArrow(partial(_clean_stems, frozenset(toxic_counts)), "stem binary")
        .groupBy("stem").agg(F.count(F.lit(1)).alias("n")).collect()
    )
    clean_counts = {bytes(r["stem"]): r["n"] for r in counted}
    if not toxic_counts:
        return frozenset()
    k = np.array(list(toxic_counts.values()), float)
    c = np.array([clean_counts.get(s, 0) for s in toxic_counts], float)
    sure = evidence(k, c, n_toxic / (n_toxic + n_clean + 1)) > np.log(len(k))
    kept = {s for s, ok in zip(toxic_counts, sure & (k / n_toxic >= odds * (c + 0.5) / (n_clean + 1)), strict=True) if ok}
    # Of nested stems the longer is kept if it has nearly all texts of the shorter, else the shorter.
    kept -= {t[:n] for t in kept for n in STEM_BYTES if n < len(t) and t[:n] in kept
             and toxic_counts[t] >= 0.9 * toxic_counts[t[:n]]}
    return frozenset(s for s in kept if not any(s[:n] in kept for n in STEM_BYTES if n < len(s)))


def _measured(grammar: Grammar, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        table = grammar.table(batch.column("text"))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(table), pa.list_(pa.float64())), batch.column("label")], names=["x", "label"]
        )


def fit_on(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Grammar:
    """Learn stems and weights from at most `rows` labelled rows."""
    sample = stored(in_few_files(labelled_sample(docs, labels, "toxic", rows)), "labelled")
    weights, bias = prior()
    grammar = Grammar(fixed_symbols(), learn_stems(sample), weights, bias)
    found = sample.mapInArrow(partial(_measured, grammar), "x array<double>, label int").toPandas()
    x = np.array(found["x"].tolist(), np.float64).reshape(len(found), FEATURES)
    order = np.lexsort((*x.T, found["label"]))
    weights, bias = fit_weights(x[order], found["label"].to_numpy(np.float64)[order])
    return Grammar(grammar.fixed, grammar.stems, weights, bias)


def score_of(text: Column, grammar: Grammar) -> Column:
    """The score of one text, 0 to 1."""

    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array(grammar.score(grammar.table(texts)), pa.float64())
            # Else they would be held while the next batch is read.
            del texts
            give_back()

    return F.arrow_udf(score, "double", F.ArrowUDFType.SCALAR_ITER)(text)


def score_toxicity(docs: DataFrame, grammar: Grammar, threshold: float = 0.5) -> DataFrame:
    """Score every whole text: all columns of docs, then held_out, score, predicted.

    A clause counts by the patterns it matches: insults and threats, each with or without a target, in the
    scope of a negation or of reported speech before them.
    A null text counts as empty; a text without attacks gets the lowest score. Rows are
    scored one by one, each whole: a text of many megabytes is one task's memory (many times its size).
    Repeated rows get equal scores. A column of docs that is named
    like a result is replaced by the result.
    """

    scored = docs.withColumn("score", score_of(docs["text"], grammar))
    return scored.withColumns({
        "held_out": held_out(F.col("doc_id")),
        "predicted": (F.col("score") >= threshold).cast("int"),
    })
