"""Toxicity by a weighted finite-state grammar over clauses.

Four kinds of small transducers are composed. The lexicon reads a word's letters and tells its symbol: insult (with a weight),
threat, target, negation, report or other. Three machines read a clause's symbols: one marks what follows a
negation within three words, one marks what follows a reporting word or stands in quotes, one remembers whether anyone
is addressed or named. Their product is a single table, run over a clause word by word. Each insult, and each threat that
has a target, leaves it with a context (plain, at a target, negated, reported), and a clause scores the sum of its
weights times their contexts' factors. Only clauses with an insult or a threat are run: an Aho-Corasick automaton of
the lexicon's insults and threats finds them in whole texts.

Weights are learnt. Insults are words, or beginnings of words, that stand in more toxic than clean texts than chance
explains among all candidates; a beginning's weight goes on to words not seen, and a longer beginning or a
whole word with evidence of its own overrides it. Factors start from prior values and move to the share of toxic texts among those that
use a context. A logistic fit turns a text's clause sum, as it is and by length, into a probability; it sees
each text through a lexicon learnt from the other folds of the texts.

Learning takes a bounded sample (``SAMPLE_ROWS`` labelled rows per class, chosen by a hash of the id, one of each group
of near copies); scoring takes every row and whole texts.

Defined results. Null text counts as empty, and empty texts get a score too. Labels other than 0 and 1, without id, or
contradicting each other are not learnt from. Without labels of both classes the seed words and prior
factors score alone.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import product
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from .common import stored, whole_text

SAMPLE_ROWS = 4000
TOXIC_FROM = 0.3
FOLDS = 4
LEAST_TEXTS = 3
SHORTEST, LONGEST = 3, 12
NEGATION_WORDS = 3
CLAUSE_CHARS = 400
MOST_SHARE = 0.998

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, QUOTE = range(7)
NEGATED, REPORTED, TARGETED = 1, 2, 4

# Seed words of the grammar (fixed values).
SEEDS = {
    INSULT: "idiot moron scum loser bastard vermin imbecile idiota imbécile abschaum trottel connard cabrón",
    THREAT: "kill hurt beat strangle shoot stab destroy burn töten umbringen schlagen tuer tuerai frapper matar mataré golpear",
    TARGET: "you your yours u ye he him she her they them those du dich dir dein ihr euch tu toi vous ils eux tú usted ustedes ellos",
    NEGATION: "not no never nobody don't isn't aren't without nicht kein keine nie ne pas jamais sans nunca jamás sin",
    REPORT: "said says called calls wrote quoted reported alleged claimed sagte nannte schrieb dit disait appelle écrit dijo llamó escribió",
}
SEED_WEIGHT = 1.5
# Contexts and the factors they start from: insults, then threats.
CONTEXTS = ("plain", "targeted", "negated", "reported", "threat", "negated threat", "reported threat")
PRIOR_FACTORS = (1.0, 1.3, 0.3, 0.3, 1.3, 0.2, 0.3)
PRIOR_TEXTS = 20
# Intercept and weights of the two numbers, if nothing can be learnt.
PRIOR_FIT = (-2.0, 1.0, 0.8)

_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?|[\"“”„«»]")
_LETTERS = re.compile(r"[^\W\d_]+")
_ENDS = re.compile(r"[.!?;:\n]")
_SYMBOL = {word: symbol for symbol, words in SEEDS.items() if symbol != INSULT for word in words.split()}
_THREATS = SEEDS[THREAT].split()


@dataclass(frozen=True)
class Machine:
    """A transducer over symbols: state and symbol to next state and marks, and marks of the state a clause ends in."""

    start: int
    step: dict[tuple[int, int], tuple[int, int]]
    final: dict[int, int]

    @property
    def states(self) -> list[int]:
        return sorted({s for s, _ in self.step})


def negation() -> Machine:
    """Marks what comes within so many words of a negation."""
    step = {}
    for state, symbol in product(range(NEGATION_WORDS + 1), range(7)):
        left = state if symbol == QUOTE else max(0, state - 1)
        step[state, symbol] = (NEGATION_WORDS, 0) if symbol == NEGATION else (left, NEGATED if state else 0)
    return Machine(0, step, {})


def report() -> Machine:
    """Marks what follows a reporting word, and what stands in quotes."""
    step = {}
    for state, symbol in product(range(4), range(7)):  # bit 0: reported, bit 1: in quotes
        after = state | 1 if symbol == REPORT else state ^ 2 if symbol == QUOTE else state
        step[state, symbol] = (after, REPORTED if state else 0)
    return Machine(0, step, {})


def target() -> Machine:
    """Remembers whether a clause has a target."""
    step = {(state, symbol): (1 if symbol == TARGET else state, 0) for state, symbol in product(range(2), range(7))}
    return Machine(0, step, {1: TARGETED})


def composed(first: Machine, second: Machine) -> Machine:
    """Both machines on the same symbols, their marks together."""
    size = max(second.states) + 1
    step, final = {}, {}
    for a, b in product(first.states, second.states):
        for symbol in range(7):
            (x, marks), (y, more) = first.step[a, symbol], second.step[b, symbol]
            step[a * size + b, symbol] = (x * size + y, marks | more)
        final[a * size + b] = first.final.get(a, 0) | second.final.get(b, 0)
    return Machine(first.start * size + second.start, step, final)


GRAMMAR = composed(composed(negation(), report()), target())


def context(symbol: int, marks: int) -> int | None:
    """The context of an insult or threat; a threat without target is none."""
    if symbol == INSULT:
        return 2 if marks & NEGATED else 3 if marks & REPORTED else 1 if marks & TARGETED else 0
    if not marks & TARGETED:
        return None
    return 5 if marks & NEGATED else 6 if marks & REPORTED else 4


@dataclass(frozen=True)
class Lexicon:
    """Weights of beginnings of words, and of whole words (with "$" behind), by longest match."""

    weights: dict[str, float]
    roots: tuple[str, ...]

    def weight(self, word: str) -> float:
        for part in (word + "$", *(word[:n] for n in range(min(len(word), LONGEST), SHORTEST - 1, -1))):
            if part in self.weights:
                return self.weights[part]
        return 0.0


class Reader:
    """Sums of weights by context in a text."""

    def __init__(self, lexicon: Lexicon) -> None:
        import ahocorasick

        self.lexicon, self.known = lexicon, {}
        self.automaton = ahocorasick.Automaton()
        for start in {*(r.rstrip("$") for r in lexicon.roots), *_THREATS}:
            self.automaton.add_word(start, len(start))
        self.automaton.make_automaton()

    def symbol(self, word: str) -> tuple[int, float]:
        got = self.known.get(word)
        if got is None:
            if len(self.known) > 100_000:
                self.known.clear()
            fixed, weight = QUOTE if len(word) == 1 and not word.isalpha() else _SYMBOL.get(word, OTHER), self.lexicon.weight(word)
            got = self.known[word] = (fixed, 1.0) if fixed else (INSULT, weight) if weight > 0 else (OTHER, 0.0)
        return got

    def clauses(self, text: str) -> Iterator[str]:
        """The clauses that hold the beginning of an insult or threat. They end at stops, and CLAUSE_CHARS from the last such word."""
        done = 0
        for last, size in self.automaton.iter(text):
            start = last - size + 1
            if start < done or (start and text[start - 1].isalpha()):
                continue
            before = max(done, start - CLAUSE_CHARS)
            stops = list(_ENDS.finditer(text, before, start))
            end = _ENDS.search(text, start, start + CLAUSE_CHARS)
            done = end.end() if end else _word_end(text, start + CLAUSE_CHARS)
            yield text[stops[-1].end() if stops else before : done]

    def sums(self, text: str | None) -> list[float]:
        out = [0.0] * len(CONTEXTS)
        for clause in self.clauses((text or "").lower()):
            state, found = GRAMMAR.start, []
            for word in _WORD.findall(clause):
                symbol, weight = self.symbol(word)
                state, marks = GRAMMAR.step[state, symbol]
                if symbol in (INSULT, THREAT):
                    found.append((symbol, marks, weight))
            for symbol, marks, weight in found:
                at = context(symbol, marks | GRAMMAR.final[state])
                if at is not None:
                    out[at] += weight
        return out


def _word_end(text: str, at: int) -> int:
    while at < len(text) and text[at].isalpha():
        at += 1
    return min(at, len(text))


@dataclass(frozen=True)
class Model:
    lexicon: Lexicon
    factors: tuple[float, ...] = PRIOR_FACTORS
    fit: tuple[float, ...] = PRIOR_FIT


def numbers(sums: Sequence[float], factors: Sequence[float], chars: int) -> tuple[float, float]:
    """A text's clause sum, damped, and by its length."""
    total = sum(s * f for s, f in zip(sums, factors, strict=True))
    return log(1 + total), log((total + 0.1) / (chars / 400 + 1))


def probability(model: Model, sums: Sequence[float], chars: int) -> float:
    a, b = numbers(sums, model.factors, chars)
    z = model.fit[0] + model.fit[1] * a + model.fit[2] * b
    return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def nodes(text: str) -> set[str]:
    """Beginnings of the text's words, and whole words with "$" behind."""
    found = set()
    for word in set(_LETTERS.findall(text.lower())):
        if SHORTEST <= len(word) <= 30:
            found.add(word + "$")
            found.update(word[:n] for n in range(SHORTEST, min(len(word), LONGEST) + 1))
    return found


def lexicon(counted: dict[str, tuple[int, int]], toxic: int, clean: int, candidates: int) -> Lexicon:
    """From (toxic, clean) texts of each node. ``candidates`` nodes were looked at: about one may stand out by chance."""
    weights = {w + "$": SEED_WEIGHT for w in SEEDS[INSULT].split()}
    seeds, roots = set(weights), []
    ratio, needed = toxic / max(1, clean), 2 * log(max(1, candidates))

    def share(node: str, above: float) -> float:
        t, n = counted[node]
        return (t + 2 * above) / (t + n * ratio + 2)

    def gain(node: str) -> float:
        (t, n), rate = counted[node], toxic / (toxic + clean)
        return 2 * sum(x * log(x / ((t + n) * r)) for x, r in ((t, rate), (n, 1 - rate)) if x)

    def stands_out(node: str) -> bool:
        return counted[node][0] >= LEAST_TEXTS and share(node, 0.5) >= 0.7 and gain(node) >= needed

    below = defaultdict(list)
    for node in counted:
        if node.endswith("$"):
            below[node[:-1][:LONGEST]].append(node)
        elif len(node) > SHORTEST:
            below[node[:-1]].append(node)

    def learn(node: str, above: float) -> None:
        p = min(share(node, above), MOST_SHARE)
        if sum(counted[node]) >= LEAST_TEXTS:
            weights[node] = max(0.0, log(p / (1 - p)))
            seeds.discard(node)
        for longer in below[node]:
            learn(longer, p)

    def search(node: str) -> None:
        # the longest beginning that tells most, so that no unlike words come with it
        if stands_out(node):
            # one that tells about as much of most texts, or far more of some
            if any(gain(x) >= gain(node) * (1 if counted[x][0] >= 0.75 * counted[node][0] else 1.8) for x in below[node]):
                for x in below[node]:
                    search(x)
            else:
                roots.append(node)
                learn(node, 0.5)
        else:
            for x in below[node]:
                search(x)

    for node in sorted(counted):
        if len(node) == SHORTEST or (len(node) == SHORTEST + 1 and node.endswith("$") and node[:-1] not in counted):
            search(node)
    return Lexicon(weights, tuple(sorted({*roots, *seeds})))


def _fitted(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, ...]:
    """Weighted logistic regression with a slight ridge, by Newton's method."""
    a = np.column_stack([np.ones(len(x)), x])
    w, ridge = np.zeros(a.shape[1]), np.diag([1e-6, 0.1, 0.1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        h = weight * (p * (1 - p) + 1e-6)
        w += np.linalg.solve((a * h[:, None]).T @ a + ridge, a.T @ (weight * (y - p)) - ridge @ w)
    return tuple(w.tolist())


def _copy_key(text: str) -> int:
    """Alike for most near copies: the smallest hash of three words in a row."""
    words = text.lower().split()
    return min((zlib.crc32(" ".join(words[n : n + 3]).encode()) for n in range(max(1, len(words) - 2))), default=0)


def _sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, learn_from: Column | None, rows: int) -> tuple[DataFrame, int, int]:
    """(id, label, fold, text) of the rows to learn from, and how many labels there are of each class."""
    known = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("label")).filter("_id IS NOT NULL AND label IN (0, 1)")
    known = known.groupBy("_id").agg(F.min("label").alias("label"), F.max("label").alias("other")).filter("label = other").drop("other")
    known = stored(known if learn_from is None else known.filter(learn_from))
    count = {r.label: r.n for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    rank = F.xxhash64("_id")
    chosen = [known.filter(F.col("label") == label).orderBy(rank, "_id").limit(rows) for label in (0, 1)]
    texts = docs.select(F.col(id_col).alias("_id"), whole_text(F.col(text_col)).alias("text"))
    found = texts.join(F.broadcast(chosen[0].unionByName(chosen[1])), "_id")

    @arrow_udf("long")
    def copy_key(column: pa.Array) -> pa.Array:
        return pa.array([_copy_key(t.as_py()) for t in column], pa.int64())

    once = found.withColumn("key", copy_key("text")).groupBy("key", "label").agg(F.min_by(F.struct("_id", "text"), F.struct("_id", "text")).alias("row"))
    rows_ = once.select("row._id", "label", F.pmod(F.shiftright(F.xxhash64("row._id"), 8), F.lit(FOLDS)).cast("int").alias("fold"), "row.text")
    return stored(rows_), count.get(1, 0), count.get(0, 0)


def _counted(sample: DataFrame) -> DataFrame:
    """(node, and texts by label and fold)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: Counter[tuple[str, int]] = Counter()
            for label, fold, text in zip(*(batch.column(n).to_pylist() for n in range(3)), strict=True):
                counts.update((node, FOLDS * label + fold) for node in nodes(text))
            yield pa.RecordBatch.from_arrays(
                [pa.array([n for n, _ in counts], pa.string()), pa.array([k for _, k in counts], pa.int32()), pa.array(list(counts.values()), pa.int64())],
                names=["node", "kind", "texts"],
            )

    rows = sample.select("label", "fold", "text").mapInArrow(run, "node string, kind int, texts long")
    return rows.groupBy("node").agg(*[F.sum(F.when(F.col("kind") == k, F.col("texts")).otherwise(0)).alias(f"n{k}") for k in range(2 * FOLDS)])


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", learn_from: Column | None = None,
    sample_rows: int = SAMPLE_ROWS,
) -> Model:
    """The model from labelled rows. ``learn_from`` is a condition on ``_id`` that a label must meet to be learnt from."""
    sample, toxic, clean = _sample(docs, labels, id_col, text_col, label_col, learn_from, sample_rows)
    sizes = {(r.label, r.fold): r.n for r in sample.groupBy("label", "fold").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = {label: sum(n for (x, _), n in sizes.items() if x == label) for label in (0, 1)}
    if not total[0] or not total[1]:
        return Model(lexicon({}, 1, 1, 1))
    n, t = (sum((F.col(f"n{FOLDS * label + fold}") for fold in range(FOLDS)), F.lit(0)) for label in (0, 1))
    all_nodes = stored(_counted(sample).filter(n + t >= LEAST_TEXTS))
    candidates = all_nodes.filter(t + n >= 5).count()
    # beginnings that stand out, and every node that starts like one: a few families out of a bounded sample
    rate, needed = total[1] / (total[0] + total[1]), 2 * log(max(1, candidates))
    gain = 2 * sum((F.when(x > 0, x * F.log(x / ((t + n) * r))).otherwise(0.0) for x, r in ((t, rate), (n, 1 - rate))), F.lit(0.0))
    strong = all_nodes.filter((t >= LEAST_TEXTS) & (t * total[0] > n * total[1]) & (gain >= needed))
    families = sorted(r[0] for r in strong.select(F.substring("node", 1, SHORTEST)).distinct().collect())
    rows = all_nodes.filter(F.substring("node", 1, SHORTEST).isin(families)).collect() if families else []

    def made(without: int | None = None) -> Lexicon:
        folds = [f for f in range(FOLDS) if f != without]
        counted = {r.node: (sum(r[f"n{FOLDS + f}"] for f in folds), sum(r[f"n{f}"] for f in folds)) for r in rows}
        return lexicon(counted, *(sum(sizes.get((label, f), 0) for f in folds) for label in (1, 0)), candidates)

    others, whole = [made(fold) for fold in range(FOLDS)], made()

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        readers = [Reader(other) for other in others]
        for batch in batches:
            labels_, folds, texts = (batch.column(n).to_pylist() for n in range(3))
            sums = [readers[fold].sums(text) for fold, text in zip(folds, texts, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sums, pa.list_(pa.float64())), pa.array([len(x) for x in texts], pa.int64())], names=["label", "sums", "chars"]
            )

    seen = sample.select("label", "fold", "text").mapInArrow(measured, "label int, sums array<double>, chars long").orderBy("label", "sums", "chars").collect()
    y, sums = np.array([r.label for r in seen], float), np.array([r.sums for r in seen])
    share = np.where(y == 1, toxic / total[1], clean / total[0])
    factors = _factors(sums, y, total[1] / total[0])
    x = np.array([numbers(r.sums, factors, r.chars) for r in seen])
    return Model(whole, factors, _fitted(x, y, share / share.mean()))


def _factors(sums: np.ndarray, y: np.ndarray, ratio: float) -> tuple[float, ...]:
    """Prior factors, moved to how much more often a context stands in toxic texts."""
    out = []
    for at, prior in enumerate(PRIOR_FACTORS):
        used = sums[:, at] > 0
        t, n = float((used & (y == 1)).sum()), float((used & (y == 0)).sum()) * ratio
        out.append((prior * PRIOR_TEXTS + max(0.0, t - n)) / (PRIOR_TEXTS + t + n))
    return tuple(out)


def scores(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", toxic_from: float = TOXIC_FROM) -> DataFrame:
    """(doc_id, score, predicted) of every row."""

    @arrow_udf("double")
    def scored(column: pa.Array) -> pa.Array:
        reader = Reader(model.lexicon)
        texts = (t.as_py() for t in column)
        return pa.array([probability(model, reader.sums(t), len(t)) for t in texts], pa.float64())

    got = docs.select(F.col(id_col).alias("doc_id"), scored(whole_text(F.col(text_col))).alias("score"))
    return got.withColumn("predicted", (F.col("score") >= toxic_from).cast("int"))
