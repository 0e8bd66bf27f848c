"""Toxicity by a weighted finite-state pattern grammar over clauses.

Words become symbols: INSULT (with a weight), THREAT, TARGET, NEGATION, REPORT, OTHER. Five small transducers read
the symbols of a clause; each has states and, for an arc, a factor. Their composition is one machine whose factor
multiplies the weight of each insult or threat, so a negated or reported insult counts less and one aimed at somebody
more. Clauses are scored, not isolated words; a document's clause scores go through a logistic curve.

The insult lexicon is a trie of weighted word beginnings and whole words, learned from labelled rows: a node is kept when
it stands in at least ``MIN_TOXIC`` toxic training documents and its log odds reach ``MIN_ODDS``. Both the lexicon and the
curve are fitted on a bounded sample (``TRAIN_DOCS`` labelled rows); every text is scored whole, in a narrow stage.

Defined results: a NULL or empty text has no clause and gets the curve's value for no match; without labelled rows the lexicon
is empty and every score is 0.5 * the smallest rate; repeated rows are scored one by one; a NULL id is never held out; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseflow.llm.common import batches, fold
from caseflow.llm.samples import labelled

TRAIN_DOCS = 20_000
MIN_TOXIC = 6
MIN_ODDS = 3.5
FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.3
SHORTEST, LONGEST = 4, 8
# fixed values: function words of the grammar in the four languages
NEGATION = "not no never nobody nothing nicht kein keine nie niemals pas jamais ne aucun no nunca jamás ningún".split()
REPORT = ("said says claimed called calls wrote quoted sagte sagt schrieb nannte behauptete dit disait écrit "
          "appelle dijo dice escribió llamó").split()
TARGET = ("you your yourself u they them he him she her du dich dein ihr euch sie tu te toi vous ton votre il elle "
          "tú ti usted ustedes él ella").split()
THREAT = ("kill hurt destroy beat burn shoot stab töten umbringen schlagen verbrennen tuer frapper brûler détruire "
          "matar golpear quemar destruir").split()
_CLAUSE = re.compile(r"[.!?;\n]+")
_TOKEN = re.compile(r"[^\W_]+")
THREAT_WEIGHT = 2.0


class Transducer:
    """States 0..n-1 (0 first); ``arcs[state, symbol]`` is (next state, factor); a missing arc keeps the state, factor 1."""

    def __init__(self, size: int, arcs: dict[tuple[int, str], tuple[int, float]]) -> None:
        self.size, self.arcs = size, arcs

    def step(self, state: int, symbol: str) -> tuple[int, float]:
        return self.arcs.get((state, symbol), (state, 1.0))

    def compose(self, other: "Transducer") -> "Transducer":
        """Both read the same symbols side by side; their factors multiply."""
        arcs = {}
        for a in range(self.size):
            for b in range(other.size):
                for symbol in SYMBOLS:
                    (x, f), (y, g) = self.step(a, symbol), other.step(b, symbol)
                    arcs[a * other.size + b, symbol] = (x * other.size + y, f * g)
        return Transducer(self.size * other.size, arcs)


SYMBOLS = ("insult", "threat", "target", "negation", "report", "other")
#: Symbols that add to a clause's score.
SCORED = ("insult", "threat", "target")


def grammar() -> Transducer:
    """insult o threat o target o negation o reported speech."""
    # negation reaches three words far and damps what it meets
    negation = {(s, x): (max(s - 1, 0), 0.5 if s and x in SCORED else 1.0) for s in range(4) for x in SYMBOLS}
    negation |= {(s, "negation"): (3, 1.0) for s in range(4)}
    # what follows a verb of saying is somebody else's word until the clause ends
    reported = {(0, "report"): (1, 1.0)} | {(1, x): (1, 0.6) for x in SCORED}
    # a target makes later insults stronger
    target = {(0, "target"): (1, 1.0), (1, "insult"): (1, 1.25)}
    # a threat counts where its target is known (state 1); before that almost nothing, and it stays pending (state 2) until a
    # target pays what is missing; the symbol of a target scores nothing else
    threat = {(0, "threat"): (2, 0.05), (2, "threat"): (2, 0.05), (0, "target"): (1, 0.0), (1, "target"): (1, 0.0),
              (2, "target"): (1, 0.95)}
    # a second insult in a clause confirms the first
    insult = {(0, "insult"): (1, 1.0), (1, "insult"): (1, 1.1)}
    machine = Transducer(2, insult)
    for size, arcs in ((3, threat), (2, target), (4, negation), (2, reported)):
        machine = machine.compose(Transducer(size, arcs))
    return machine


def inflected(verbs: list[str]) -> set[str]:
    """The verbs with the regular endings of their form: infinitives in -en, -er, -ar and -ir, others as English verbs."""
    out = set(verbs)
    for verb in verbs:
        stem = verb[:-2]
        if verb.endswith("en"):
            out |= {stem + x for x in ("e", "st", "est", "t", "et")}
        elif verb.endswith("er"):
            out |= {stem + x for x in ("e", "es", "ons", "ez", "ent", "erai", "é")}
        elif verb.endswith(("ar", "ir", "re")) and len(verb) > 4:
            out |= {verb + "é", *(stem + x for x in ("o", "as", "a", "an", "amos", "aron") if verb.endswith("ar"))}
        else:
            last = verb[:-1] if verb.endswith("e") else verb
            out |= {verb + "s", last + "ed", last + "ing", verb + verb[-1] + "ed", verb + verb[-1] + "ing"}
    return out


class Scorer:
    """The grammar with a learned lexicon: document text to clause features."""

    def __init__(self, lexicon: dict[str, float]) -> None:
        self.lexicon, self.machine = lexicon, grammar()
        self.fixed = {w: s for words, s in (
            (inflected(THREAT), "threat"), (NEGATION, "negation"), (REPORT, "report"), (TARGET, "target")) for w in words}
        self.automaton = ahocorasick.Automaton()
        for key in {k.rstrip("$") for k in lexicon} | inflected(THREAT):
            self.automaton.add_word(key, len(key))
        if len(self.automaton):
            self.automaton.make_automaton()

    def symbol(self, word: str) -> tuple[str, float]:
        """The word's symbol and weight; the longest known beginning of an insult decides."""
        whole = self.lexicon.get(word + "$")
        if whole is not None:
            return "insult", whole
        for n in range(min(LONGEST, len(word)), SHORTEST - 1, -1):
            weight = self.lexicon.get(word[:n])
            if weight is not None:
                return "insult", weight
        return self.fixed.get(word, "other"), THREAT_WEIGHT

    def clauses(self, text: str | None) -> tuple[list[float], int]:
        """Scores of the clauses that match, and the number of words in them."""
        low = (text or "").lower()
        if not low or not len(self.automaton):
            return [], 0
        if not any(end < n or not low[end - n].isalnum() for end, n in self.automaton.iter(low)):
            return [], 0
        scores, words = [], 0
        for clause in _CLAUSE.split(low):
            state, score, own = 0, 0.0, 0
            for word in _TOKEN.findall(clause):
                kind, weight = self.symbol(word)
                state, factor = self.machine.step(state, kind)
                own += 1
                if kind in SCORED:
                    score += weight * factor
            if score > 0:
                scores.append(score)
                words += own
        return scores, words

    def features(self, text: str | None) -> list[float]:
        scores, words = self.clauses(text)
        if not scores:
            return [0.0] * 4
        return [float(np.log1p(sum(scores))), float(np.log1p(max(scores))), float(np.log1p(len(scores))),
                float(sum(scores) / max(words, 1))]


def _beginnings(text: str | None) -> set[str]:
    words = {w for w in _TOKEN.findall((text or "").lower()) if len(w) >= SHORTEST}
    return {w + "$" for w in words} | {w[:n] for w in words for n in range(SHORTEST, min(LONGEST, len(w)) + 1)}


def _counts(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Document counts of word beginnings by label, summed inside the batch."""
    for batch in batches(rows):
        total = {0: Counter(), 1: Counter()}
        for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
            total[label].update(_beginnings(text))
        keys = list(total[0].keys() | total[1].keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.string()), pa.array([total[1][k] for k in keys], pa.int64()),
             pa.array([total[0][k] for k in keys], pa.int64())], names=["key", "toxic", "clean"])


def learn_lexicon(sample: DataFrame) -> dict[str, float]:
    """Weighted word beginnings and whole words (marked by a final $) that mark toxic documents."""
    sizes = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    counts = sample.select("text", "label").mapInArrow(_counts, "key string, toxic long, clean long").groupBy("key").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    odds = (F.log((F.col("toxic") + 0.5) / (toxic + 1.0)) - F.log((F.col("clean") + 0.5) / (clean + 1.0)))
    kept = counts.withColumn("weight", odds).filter(
        (F.col("toxic") >= MIN_TOXIC) & (F.col("weight") >= MIN_ODDS)).collect()  # bounded by the sample
    weights = {r["key"]: r["weight"] for r in kept}
    # a node whose shorter beginning is already as telling adds nothing
    return {k: w for k, w in weights.items()
            if not any(weights.get(k.rstrip("$")[:n], 0.0) >= w - 0.7
                       for n in range(SHORTEST, len(k.rstrip("$")) + (k[-1] == "$")))}


def fit_curve(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 100) -> np.ndarray:
    """Logistic weights (the intercept last) by damped Newton steps; raises when they don't settle."""
    x = np.hstack([x, np.ones((len(x), 1))])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-3
    beta = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty), x.T @ (y - p) - penalty * beta)
        beta = beta + step * min(1.0, 5.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-6:
            return beta
    raise RuntimeError("the logistic curve did not settle")


def _features(lexicon: dict[str, float]):
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(lexicon)
        for batch in batches(rows):
            x = [scorer.features(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), pa.array(x, pa.list_(pa.float64()))], names=["label", "x"])

    return run


def train(docs: DataFrame, labels: DataFrame) -> tuple[dict[str, float], np.ndarray]:
    """Lexicon and curve from a bounded sample outside the held-out fold.

    The curve is fitted on documents the lexicon wasn't learned from (the other half of the sample).
    """
    sample = labelled(docs, labels, "toxic", FOLDS, HELD_OUT, TRAIN_DOCS).cache()
    half = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(2))
    first = learn_lexicon(sample.filter(half == 0))
    rows = sample.filter(half == 1).select("label", "text").mapInArrow(_features(first), "label int, x array<double>").collect()
    lexicon = learn_lexicon(sample)
    sample.unpersist()
    if not rows:
        return lexicon, np.array([0.0] * 4 + [-5.0])
    return lexicon, fit_curve(np.array([r["x"] for r in rows]), np.array([r["label"] for r in rows], dtype=float))


def scored(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted, matched clauses."""
    lexicon, beta = train(docs, labels)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(lexicon)
        for batch in batches(rows):
            x = np.array([scorer.features(t) for t in batch.column("text").to_pylist()])
            score = 1 / (1 + np.exp(-np.clip(x @ beta[:-1] + beta[-1], -30, 30)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(score), pa.array(np.rint(np.expm1(x[:, 2])).astype(np.int64))],
                names=["doc_id", "score", "n_clauses"])

    out = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double, n_clauses long")
    return out.select(
        "doc_id", F.coalesce(fold("doc_id", FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"), "n_clauses")
