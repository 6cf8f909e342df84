"""Quality classifier from weak labels.

Overlapping heuristics vote good, bad or nothing on each document. The counts of all vote
patterns (no more than 4 to the power of the heuristics, whatever the corpus) go into
expectation-maximisation, which estimates each heuristic's accuracy and from them the
posterior of each pattern. A linear scorer over hashed byte trigrams and hashed ranges of
the statistics is trained on the posteriors of a bounded sample and scores every document.

Edge cases: null texts and texts without a word get no vote, score 0 and are not kept;
equal texts have equal votes and scores; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import eq
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evidmap.llm.catalog import query
from evidmap.llm.tables import row_key, table

BAD, NONE, GOOD, SHORT = 0, 1, 2, 3  # SHORT: the text is too short for the rule
ROUNDS = 50
# The scorer is fitted on about this many documents, drawn evenly by a hash of the row.
TRAIN_DOCS = 4000
GRAM_BITS = 16
EPOCHS, RATE = 30, 0.5


class Rule(NamedTuple):
    statistic: str
    bad: tuple[float, float]  # votes bad outside of this range
    good: tuple[float, float]  # votes good inside of this range
    words: int  # votes on texts of at least so many words


INF = float("inf")
RULES = (
    Rule("symbols", (-INF, 0.10), (-INF, 0.05), 1),
    Rule("capitals", (-INF, 0.30), (-INF, 0.15), 5),
    Rule("columns", (-INF, 0.08), (-INF, 0.01), 1),
    Rule("echoes", (-INF, 0.20), (-INF, 0.05), 5),
    Rule("distinct", (0.20, INF), (0.35, INF), 20),
    Rule("stops", (0.02, INF), (0.04, 0.60), 20),
    Rule("letters", (0.60, INF), (0.75, INF), 1),
    Rule("word_length", (2.0, 14.0), (2.5, 10.0), 5),
)
STATISTICS = tuple(r.statistic for r in RULES)
# What a byte is: other, letter, capital, digit, space, symbol, column sign, stop.
CLASS = np.zeros(256, np.uint8)
CLASS[[b for b in range(256) if chr(b).islower() and b < 128 or b >= 128]] = 1
CLASS[[b for b in range(65, 91)]] = 2
CLASS[[b for b in range(48, 58)]] = 3
CLASS[[9, 10, 11, 12, 13, 32]] = 4
CLASS[[ord(c) for c in "#$%&*+/<=>@[]\\^_`{}~"]] = 5
CLASS[[ord(c) for c in "|\t"]] = 6
CLASS[[ord(c) for c in ".!?"]] = 7


def statistics(text: str) -> tuple[np.ndarray, int] | None:
    """Values of the statistics and number of words; None without a word."""
    words = text.split()
    if not words:
        return None
    n, data = len(words), np.frombuffer(text.encode(), np.uint8)
    count = np.bincount(CLASS[data], minlength=8)
    signs = max(len(data) - count[4], 1)
    letters = max(count[1] + count[2], 1)
    values = [
        (count[5] + count[6]) / signs,
        count[2] / letters,
        count[6] / n,
        sum(map(eq, words, words[1:])) / n,
        len(set(words)) / n * min(1.0, n / 500) ** 0.25,
        count[7] / n,
        (count[1] + count[2]) / signs,
        signs / n,
    ]
    return np.array(values), n


def votes(values: np.ndarray, n: int) -> list[int]:
    found = []
    for rule, value in zip(RULES, values):
        if n < rule.words:
            found.append(SHORT)
        elif not rule.bad[0] <= value <= rule.bad[1]:
            found.append(BAD)
        else:
            found.append(GOOD if rule.good[0] <= value <= rule.good[1] else NONE)
    return found


class LabelModel(NamedTuple):
    prior: float  # share of good documents
    chances: np.ndarray  # of each vote, none included, by (class, rule, vote)

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """Chance of good for rows of votes."""
        like = np.log([1 - self.prior, self.prior])[:, None].repeat(len(patterns), axis=1)
        for rule in range(patterns.shape[1]):
            able = patterns[:, rule] != SHORT
            like[:, able] += np.log(self.chances[:, rule, patterns[able, rule]])
        return 1 / (1 + np.exp(np.clip(like[0] - like[1], -700, 700)))

    def accuracies(self) -> np.ndarray:
        """How often each rule is right when it votes."""
        right = (1 - self.prior) * self.chances[0, :, BAD] + self.prior * self.chances[1, :, GOOD]
        wrong = (1 - self.prior) * self.chances[0, :, GOOD] + self.prior * self.chances[1, :, BAD]
        return right / (right + wrong)


def fit_labels(patterns: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS) -> LabelModel:
    """Expectation-maximisation; patterns (rows, rules) with their counts.

    A document has its defects of different kinds one at a time, so the other rules call it
    good: it starts from "one bad vote makes a bad document", and the estimates then say how
    much a rule's bad vote is worth, and how little its good one.
    """
    width = patterns.shape[1]
    good = np.where((patterns == BAD).any(axis=1), 0.1, 0.9)
    model = LabelModel(0.5, np.full((2, width, 3), 1 / 3))
    for _ in range(rounds):
        weights = np.array([(1 - good) * counts, good * counts])
        chances = np.zeros((2, width, 3))
        for rule in range(width):
            for vote in (BAD, NONE, GOOD):
                chances[:, rule, vote] = 0.1 + weights[:, patterns[:, rule] == vote].sum(axis=1)
        chances /= chances.sum(axis=2, keepdims=True)
        prior = (weights[1].sum() + 1) / (counts.sum() + 2)
        model = LabelModel(float(prior), chances)
        good = model.posterior(patterns)
    return model


def vote_patterns(docs: DataFrame, text: str) -> tuple[np.ndarray, np.ndarray]:
    """All vote patterns of the corpus and how many documents have each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, int] = {}
        for batch in batches:
            for value in batch.column("text"):
                found = statistics(value.as_py() or "")
                if found:
                    key = "".join(map(str, votes(*found)))
                    seen[key] = seen.get(key, 0) + 1
        if seen:
            yield from pa.table({"votes": list(seen), "n": list(seen.values())}).to_batches()

    rows = docs.select(F.col(text).alias("text")).mapInArrow(run, "votes string, n bigint")
    rows = sorted(rows.groupBy("votes").agg(F.sum("n").alias("n")).collect())
    patterns = np.array([[int(v) for v in r.votes] for r in rows], np.int64).reshape(-1, len(RULES))
    return patterns, np.array([r.n for r in rows], np.float64)


def grams(text: str) -> np.ndarray:
    """Hashed byte trigrams."""
    data = np.frombuffer(f"\n{text}\n".encode(), np.uint8).astype(np.uint32)
    mixed = (data[:-2] << 16 | data[1:-1] << 8 | data[2:]) * np.uint32(0x9E3779B1)
    return mixed >> np.uint32(32 - GRAM_BITS)


def ranges(values: np.ndarray) -> np.ndarray:
    """A hashed feature for the range that each statistic lies in."""
    steps = np.minimum(np.floor(np.abs(values) * 20), 199).astype(np.uint32)
    keys = (np.arange(len(values), dtype=np.uint32) * np.uint32(200) + steps + np.uint32(1 << 24))
    return keys * np.uint32(0x85EBCA6B) >> np.uint32(32 - GRAM_BITS)


class Scorer(NamedTuple):
    weights: np.ndarray
    bias: float

    def score(self, text: str, values: np.ndarray) -> float:
        raw = self.weights[grams(text)].mean() + self.weights[ranges(values)].sum() + self.bias
        return float(1 / (1 + np.exp(-np.clip(raw, -500, 500))))


def fit_scorer(rows: list[tuple[np.ndarray, np.ndarray, float]]) -> Scorer:
    """Logistic regression on soft labels: rows of features, their values and the label."""
    weights, bias = np.zeros(1 << GRAM_BITS), 0.0
    squares = np.full(1 << GRAM_BITS, 1e-6)
    rng = np.random.default_rng(11)
    for _ in range(EPOCHS):
        for k in rng.permutation(len(rows)):
            at, value, label = rows[k]
            raw = weights[at] @ value + bias
            error = label - 1 / (1 + np.exp(-np.clip(raw, -500, 500)))
            step = error * value
            squares[at] += step * step
            weights[at] += RATE * step / np.sqrt(squares[at])
            bias += 0.01 * error
    return Scorer(weights.astype(np.float32), bias)


def sample_features(docs: DataFrame, text: str, share: float, most: int):
    """Features and votes of sampled documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for key, value in zip(batch.column("key").to_pylist(), batch.column("text")):
                value = value.as_py() or ""
                found = statistics(value)
                if not found:
                    continue
                at, n = np.unique(grams(value), return_counts=True)
                wide = ranges(found[0])
                at = np.append(at, wide).astype(np.int32)
                n = np.append(n / n.sum(), np.ones(len(wide))).astype(np.float32)
                out.append((key, at.tolist(), n.tolist(), "".join(map(str, votes(*found)))))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) if i != 2 else pa.array(c, pa.list_(pa.float32())) for i, c in enumerate(zip(*out))],
                    ["key", "at", "value", "votes"],
                )

    draw = F.pmod(F.xxhash64("key"), F.lit(1 << 30)) < int(min(share, 1.0) * (1 << 30))
    rows = docs.where(draw).mapInArrow(
        run, "key bigint, at array<bigint>, value array<float>, votes string"
    )
    rows = rows.limit(most).collect()
    for row in sorted(rows, key=lambda r: (r.key, r.votes)):
        yield np.array(row.at), np.array(row.value, np.float64), row.votes


def train(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", train_docs: int = TRAIN_DOCS
) -> tuple[LabelModel, Scorer]:
    patterns, counts = vote_patterns(docs, text)
    model = fit_labels(patterns, counts)
    keyed = docs.select(row_key(F.col(doc_id), F.col(text)).alias("key"), F.col(text).alias("text"))
    rows = []
    # twice the expected number is never reached by an even draw
    for at, value, found in sample_features(keyed, text="text", share=train_docs / max(counts.sum(), 1), most=2 * train_docs):
        label = model.posterior(np.array([[int(v) for v in found]]))[0]
        rows.append((at, value, float(label)))
    return model, fit_scorer(rows)


def quality(
    docs: DataFrame, model: LabelModel, scorer: Scorer, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per row: id, votes (a digit per rule: 0 bad, 1 none, 2 good, 3 too short), weak_label, score."""
    docs = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    schema = T.StructType(
        [docs.schema["id"], *T.StructType.fromDDL("votes string, weak_label double, score double")]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, float] = {}
        for batch in batches:
            names, labels, scores = [], [], []
            for value in batch.column("text"):
                value = value.as_py() or ""
                found = statistics(value)
                own = votes(*found) if found else [SHORT] * len(RULES)
                name = "".join(map(str, own))
                if name not in known:
                    known[name] = float(model.posterior(np.array([own]))[0])
                names.append(name)
                labels.append(known[name])
                scores.append(scorer.score(value, found[0]) if found else 0.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(names), pa.array(labels), pa.array(scores)],
                ["id", "votes", "weak_label", "score"],
            )

    return docs.mapInArrow(run, schema)


@query("op8_quality")
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = quality(docs, *train(docs))
    return found.select(
        F.col("id").alias("doc_id"), "votes", "weak_label", "score", (F.col("score") >= 0.5).alias("keep")
    )
