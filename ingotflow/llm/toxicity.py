"""Toxicity by a weighted pattern grammar over clauses.

A text is read as clauses (up to sentence marks, semicolons, line ends). Each word becomes a symbol:

* an insult, with a weight, from a character transducer (a trie of whole words and word beginnings) whose
  weights are learned from labelled documents;
* a threat verb, a target, a negation, a reporting word or a quotation mark, from the fixed lists below.

Four small transducers read the symbols from the left: whether a target stands within ``REACH`` words before,
whether a negation does, whether a reporting word has come, whether a quotation is open. A fifth reads from
the right, for targets that follow. Their tables are composed once into one machine of two directions, whose
pair of states at a word gives the word's context: aimed at a target or not, negated or not, reported or
not. Insults emit their weight into their context, threat verbs a unit if they are aimed; of a clause all
counts the more, the more matches it holds. What the contexts and threats weigh, and how the sum over the clauses
and its density become a score, is fitted to the labelled sample; factors that the sample says nothing
about stay near those given below.

Learning reads a bounded sample: up to ``SAMPLE`` labelled documents of each label value, those with
the lowest hash of their id. Words are counted on the executors.

Edge cases: a null or empty text has no clause and gets the score of no evidence, and so does every
text if there is nothing to learn from (one label value only): 0. Texts are read whole. A document
with several labels counts once with each. Rows are mapped one by one, so repeated rows and ids and
further columns change nothing.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ingotflow.llm.bpe import Recent
from ingotflow.llm.common import bounded_sample, map_slices, slices

SAMPLE = 2500
#: Word beginnings of these lengths are learned besides whole words.
BEGINNINGS = (4, 5, 6)
#: A pattern is learned from at least so many documents, and this log odds ratio (a lower bound).
SUPPORT, ODDS = 4, 2.0
REACH = 3
#: Logarithms of what a match weighs more next to a target, after a negation, in reported speech, and of what a
#: threat weighs, before anything is learned.
PRIOR = (math.log(1.5), math.log(0.3), math.log(0.5), math.log(3.0))
#: How many documents of the sample a factor that differs from its prior by one must be worth.
TRUST = 0.2

TARGETS = frozenset("you your yours yourself they them he him she her".split())
NEGATIONS = frozenset("not never no neither nor isn't aren't wasn't don't nicht kein pas jamais nunca".split())
REPORTS = frozenset("said says wrote quoted called reported claimed alleged".split())
THREATS = frozenset("kill hurt destroy murder beat".split())

CLAUSE = re.compile(r"[^.!?;\n]+")
WORD = re.compile(r"[^\W_]+(?:'[^\W_]+)?|[\"“”«»]")


def patterns(word: str) -> Iterator[str]:
    """The word as a whole, and its beginnings (marked by a star)."""
    yield word
    for n in BEGINNINGS:
        if len(word) > n:
            yield word[:n] + "*"


class WordWeights(Recent):
    """Memo: the strongest learned pattern that accepts a word, or 0."""

    def __init__(self, weights: dict[str, float], limit: int = 400_000):
        super().__init__(limit)
        self.weights = weights

    def make(self, word: str) -> float:
        return max((self.weights[p] for p in patterns(word) if p in self.weights), default=0.0)


OTHER, TARGET, NEGATION, REPORT, QUOTE = range(5)


def symbol(word: str) -> int:
    if word in REPORTS:
        return REPORT
    if word in NEGATIONS:
        return NEGATION
    if word in TARGETS:
        return TARGET
    return OTHER if word[0].isalnum() else QUOTE


@dataclass(frozen=True)
class Transducer:
    """``moves[state][symbol]`` is the next state, ``output[state]`` what holds of the word read next."""

    moves: list[list[int]]
    output: list[tuple[bool, ...]]

    def __matmul__(self, other: Transducer) -> Transducer:
        """Both at once: states are pairs, outputs joined."""
        n = len(other.moves)
        return Transducer(
            [[x * n + y for x, y in zip(mine, theirs)] for mine in self.moves for theirs in other.moves],
            [mine + theirs for mine in self.output for theirs in other.output])

    def states(self, symbols: list[int]) -> list[int]:
        """The state before each symbol."""
        return list(accumulate(symbols[:-1], lambda state, x: self.moves[state][x], initial=0)) if symbols else []


def within_reach(of: int) -> Transducer:
    """Whether the symbol has come within the last ``REACH``."""
    return Transducer([[REACH if x == of else max(left - 1, 0) for x in range(5)] for left in range(REACH + 1)],
                      [(left > 0,) for left in range(REACH + 1)])


def once(after: int) -> Transducer:
    """Whether the symbol has come at all."""
    return Transducer([[max(seen, x == after) for x in range(5)] for seen in (0, 1)], [(False,), (True,)])


def between(mark: int) -> Transducer:
    """Whether the symbol has come an odd number of times."""
    return Transducer([[inside ^ (x == mark) for x in range(5)] for inside in (0, 1)], [(False,), (True,)])


FORWARD = within_reach(TARGET) @ within_reach(NEGATION) @ once(REPORT) @ between(QUOTE)
BACKWARD = within_reach(TARGET)
#: ``CONTEXT[forward state][backward state]``: 1 if aimed, 2 if negated, 4 if reported, added up.
CONTEXT = [[int(aimed or follows) + 2 * negated + 4 * (reported or quoted) for (follows,) in BACKWARD.output]
           for aimed, negated, reported, quoted in FORWARD.output]
CONTEXTS = 8
#: Which of the three hold in each context.
HOLDS = np.array([[c & 1, c >> 1 & 1, c >> 2] for c in range(CONTEXTS)], float)


@dataclass
class Grammar:
    weights: dict[str, float]  # of learned patterns
    factors: tuple[float, ...] = PRIOR
    curve: tuple[float, float, float] = (0.0, 0.0, 0.0)

    def __post_init__(self):
        self.weight_of = WordWeights(self.weights)

    def clause(self, words: list[str]) -> tuple[np.ndarray, int]:
        """The weight of insults in each context, then the number of threats in each, and the number of matches."""
        symbols = list(map(symbol, words))
        forward = FORWARD.states(symbols)
        backward = BACKWARD.states(symbols[::-1])[::-1]
        amounts, matches = np.zeros(2 * CONTEXTS), 0
        for word, kind, left, right in zip(words, symbols, forward, backward):
            if kind != OTHER:
                continue
            context = CONTEXT[left][right]
            if weight := self.weight_of[word]:
                amounts[context] += weight
            elif word in THREATS and context & 1:
                amounts[CONTEXTS + context] += 1
            else:
                continue
            matches += 1
        return amounts, matches

    def evidence(self, text: str | None) -> tuple[np.ndarray, int]:
        """What the clauses of a text emit, and its number of words."""
        lowered = (text or "").lower()
        words, amounts = WORD.findall(lowered), np.zeros(2 * CONTEXTS)
        if THREATS.isdisjoint(words) and not any(map(self.weight_of.__getitem__, words)):
            return amounts, len(words)
        for clause in CLAUSE.findall(lowered):
            emitted, matches = self.clause(WORD.findall(clause))
            if matches:
                amounts += emitted * (1 + math.log(matches))
        return amounts, len(words)

    def score(self, amounts: np.ndarray, words: np.ndarray) -> np.ndarray:
        """The scores of texts from their evidence."""
        bias, a, b = self.curve
        amount, density = shape_of(amounts, words, self.factors)
        return 1 / (1 + np.exp(-np.clip(bias + a * amount + b * density, -30, 30)))


def total_of(amounts: np.ndarray, factors: tuple[float, ...] | np.ndarray) -> np.ndarray:
    """The weighed sum of each text's evidence."""
    context = np.exp(HOLDS @ np.asarray(factors[:3]))
    return amounts[:, :CONTEXTS] @ context + amounts[:, CONTEXTS:] @ context * math.exp(factors[3])


def shape_of(amounts: np.ndarray, words: np.ndarray, factors) -> tuple[np.ndarray, np.ndarray]:
    """Amount and density of each text's evidence."""
    total = total_of(amounts, factors)
    return np.log1p(total), np.log1p(100 * total / np.maximum(words, 1))


def learn_patterns(documents: Counter[tuple[str, int]], sizes: dict[int, int]) -> dict[str, float]:
    """Log odds of patterns, less one standard error, from the number of documents that hold them."""
    out = {}
    for (pattern, label), n in documents.items():
        if label == 1 and n >= SUPPORT:
            other = documents.get((pattern, 0), 0)
            odds = (math.log((n + 0.5) / (sizes[1] + 1)) - math.log((other + 0.5) / (sizes[0] + 1))
                    - math.sqrt(1 / (n + 0.5) + 1 / (other + 0.5)))
            if odds >= ODDS:
                out[pattern] = odds
    return out


def fit_curve(amount: np.ndarray, density: np.ndarray, label: np.ndarray,
              weight: np.ndarray) -> tuple[float, float, float]:
    """Logistic regression by Newton steps, lightly regularised."""
    x = np.column_stack([np.ones_like(amount), amount, density])
    beta = np.zeros(3)
    ridge = np.diag([1e-3, 1e-2, 1e-2]) * weight.sum() * 0.01
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (weight * (label - p)) - ridge @ beta
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + ridge, slope)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(b) for b in beta)


def fit_factors(amounts: np.ndarray, words: np.ndarray, label: np.ndarray, weight: np.ndarray
                ) -> tuple[tuple[float, ...], tuple[float, float, float]]:
    """Factors and curve together: the curve by Newton steps for given factors, these by descent near the prior."""
    prior = np.array(PRIOR)
    trust = TRUST / len(label) * weight.sum()

    def loss(factors: np.ndarray) -> tuple[float, tuple[float, float, float]]:
        amount, density = shape_of(amounts, words, factors)
        curve = fit_curve(amount, density, label, weight)
        p = 1 / (1 + np.exp(-np.clip(curve[0] + curve[1] * amount + curve[2] * density, -30, 30)))
        likely = np.where(label == 1, p, 1 - p)
        return float(-(weight * np.log(likely)).sum() + trust * ((factors - prior) ** 2).sum()), curve

    factors, step = prior, 0.4
    best, curve = loss(factors)
    while step > 0.01:
        tries = [(*loss(moved), moved) for i in range(4) for sign in (1, -1)
                 if (moved := factors + sign * step * np.eye(4)[i]) is not None]
        least, its_curve, moved = min(tries, key=lambda t: t[0])
        if least < best:
            best, curve, factors = least, its_curve, moved
        else:
            step /= 2
    return tuple(map(float, factors)), curve


def sample_of(documents: DataFrame, labels: DataFrame, limit: int) -> DataFrame:
    """``label, text`` of up to ``limit`` labelled documents of each value.

    The ids are ranked on the narrow labels. At most ``2 * limit`` of them are broadcast, so the
    documents are not shuffled.
    """
    ids = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).select(
        "doc_id", F.col("toxic").alias("label"), F.xxhash64("doc_id").alias("hash"))
    taken = bounded_sample(ids, limit).select("doc_id", "label")
    return documents.select("doc_id", "text").join(F.broadcast(taken), "doc_id").select("label", "text")


def fit(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Grammar:
    rows = sample_of(documents, labels, sample)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                found: Counter[tuple[str, int]] = Counter()
                for label, text in zip(*(c.to_pylist() for c in part.columns)):
                    found.update((p, label) for p in {
                        p for w in set(WORD.findall((text or "").lower())) for p in patterns(w)})
                    found["", label] += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p for p, _ in found], pa.string()),
                     pa.array([x for _, x in found], pa.int32()),
                     pa.array(list(found.values()), pa.int64())], ["pattern", "label", "n"])

    counted = (rows.mapInArrow(count, "pattern string, label int, n long").groupBy("pattern")
               .agg(*(F.coalesce(F.sum(F.when(F.col("label") == x, F.col("n"))), F.lit(0)).alias(f"n{x}")
                      for x in (0, 1)))
               .where((F.col("pattern") == "") | (F.col("n1") >= SUPPORT)).toPandas())
    found = Counter({(p, x): int(n) for x in (0, 1) for p, n in zip(counted["pattern"], counted[f"n{x}"])})
    sizes = {x: found.pop(("", x), 0) for x in (0, 1)}
    if not all(sizes.values()):
        return Grammar({}, curve=(-30.0, 0.0, 0.0))
    grammar = Grammar(learn_patterns(found, sizes))
    points = measured(rows, grammar, "text", F.col("label")).toPandas()
    label = points["label"].to_numpy(float)
    all_of = {r["toxic"]: r["count"] for r in labels.groupBy("toxic").count().collect()}
    share = {x: all_of[x] / sizes[x] / (all_of[0] + all_of[1]) for x in (0, 1)}
    grammar.factors, grammar.curve = fit_factors(
        np.stack(points["amounts"].to_list()), points["words"].to_numpy(float), label,
        np.where(label == 1, share[1], share[0]))
    return grammar


def _mapped(df: DataFrame, grammar: Grammar, text: str, keep: tuple[Column, ...], columns: str,
            make: Callable[[Grammar, np.ndarray, np.ndarray], list[pa.Array]]) -> DataFrame:
    """The columns of ``keep``, then those that ``make`` gives from the texts' evidence."""
    shared = df.sparkSession.sparkContext.broadcast(Grammar(grammar.weights, grammar.factors, grammar.curve))
    names = [c.split()[0] for c in columns.split(", ")]

    def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [shared.value.evidence(t) for t in batch.column(0).to_pylist()]
        amounts = np.stack([a for a, _ in found])
        made = make(shared.value, amounts, np.array([n for _, n in found], np.int64))
        return pa.RecordBatch.from_arrays([*batch.columns[1:], *made], [*batch.schema.names[1:], *names])

    rows = df.select(F.col(text).alias("_text"), *keep)
    kept = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema[1:])
    return map_slices(rows, apply, 0, kept + columns)


def measured(df: DataFrame, grammar: Grammar, text: str, *keep: Column) -> DataFrame:
    """The columns of ``keep``, then ``amounts`` and ``words`` of every row's evidence."""
    return _mapped(df, grammar, text, keep, "amounts array<double>, words long", lambda _, amounts, words: [
        pa.FixedSizeListArray.from_arrays(pa.array(amounts.ravel()), 2 * CONTEXTS).cast(pa.list_(pa.float64())),
        pa.array(words)])


def score(df: DataFrame, grammar: Grammar, threshold: float = 0.7, text: str = "text",
          key: str = "doc_id", keep: tuple[Column, ...] = ()) -> DataFrame:
    """``key``, the columns of ``keep``, ``score`` (0 to 1) and ``predicted`` (0 or 1) of every row."""
    return _mapped(df, grammar, text, (F.col(key), *keep), "score double, predicted int", lambda g, amounts, words: [
        pa.array(scores := g.score(amounts, words)), pa.array((scores >= threshold).astype(np.int32))])
