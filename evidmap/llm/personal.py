"""Personal data by fixed patterns and a semi-Markov conditional random field.

The patterns of the contract give the base spans. Around every digit and "@" a region is
cut into tokens; the field scores whole segments of it (shape, digits, check sum, context)
and a dynamic program over segments of bounded length chooses boundaries and types
together. It learns from regions with base spans (and regions too poor to hold any), with
the tell-tale features left out at random, so that spans which the patterns just miss are
scored by the rest. A segment is added when its marginal chance is high and it overlaps no
base span; base spans always stay.

Edge cases: null texts are empty; offsets count code points, end exclusive; without any
base span in the table nothing is learned and nothing added; very long texts are searched
in time linear in their length.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evidmap.llm.catalog import query
from evidmap.llm.tables import table

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int, int]  # kind, start, end

# The patterns of the contract. Runs of digits are entered at their start
# only, and not given back: where that fails, every later start fails too.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
SIGN = re.compile(r"[0-9@]")

# The field is fitted on this many regions, those of least hash; more change it little.
TRAIN_REGIONS = 600
EPOCHS = 4
RATE, DECAY, DROPOUT = 0.2, 1e-4, 0.35
LEAST_CHANCE = 0.95
REACH = 24  # characters around a digit or "@"
MOST_TOKENS = 16  # of a segment
TOKEN = re.compile(r"[0-9]+|[A-Za-z]+|\s+|.", re.DOTALL)
INSIDE = re.compile(r"[A-Za-z0-9._%+\-@]+|[0-9 ().+\-]+")
MONEY_DIGITS = 9  # fewer digits hold neither a phone nor a card number


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        found = EMAIL.match(text, start) if start < at else None
        if found:
            done = found.end()
            yield start, done
        else:
            done = max(done, at + 1)
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns, by kind, then start."""
    found: list[Span] = []
    if "@" in text:
        found += [(0, s, e) for s, e in _emails(text)]
    if DIGIT.search(text):
        for m in IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
                found.append((1, m.start(), m.end()))
        for m in CARD.finditer(text):
            if 13 <= m.end() - m.start() <= 40:
                digits = re.sub("[ -]", "", m[0])
                if 13 <= len(digits) <= 19 and luhn(digits):
                    found.append((2, m.start(), m.end()))
        for m in PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                found.append((3, m.start(), m.end()))
    return found


def regions(text: str) -> Iterator[tuple[int, int]]:
    """Disjoint stretches around digits and "@", cut at blanks."""
    start = end = None
    for m in SIGN.finditer(text):
        a, b = max(0, m.start() - REACH), min(len(text), m.end() + REACH)
        if end is not None and a <= end:
            end = b
            continue
        if end is not None:
            yield start, end
        start, end = a, b
    if end is not None:
        yield start, end


class Lattice:
    """Tokens of a region and the segments that may be an entity."""

    def __init__(self, text: str) -> None:
        self.text = text
        tokens = [(m.start(), m.end()) for m in TOKEN.finditer(text)]
        self.n = len(tokens)
        self.segments: list[tuple[int, int, int, int]] = []  # tokens from, to; characters from, to
        self.features: list[list[str]] = []
        for i, (start, _) in enumerate(tokens):
            if not (text[start].isascii() and (text[start].isalnum() or text[start] in "+(")):
                continue
            for j in range(i, min(self.n, i + MOST_TOKENS)):
                end = tokens[j][1]
                last = text[end - 1]
                if text[tokens[j][0]] == "\n" or not (last.isascii() and (last.isalnum() or last in " .-@_%+()")):
                    break
                if not last.isalnum():
                    continue
                body = text[start:end]
                if not (DIGIT.search(body) or "@" in body) or not INSIDE.fullmatch(body):
                    continue
                self.segments.append((i, j + 1, start, end))
                self.features.append(self._features(body, start, end))
        self.at = {(s, e): k for k, (_, _, s, e) in enumerate(self.segments)}

    def _features(self, body: str, start: int, end: int) -> list[str]:
        digits = re.sub("[^0-9]", "", body)
        before, after = self.text[start - 1 : start], self.text[end : end + 1]
        words = re.findall(r"[^\W\d_]+", self.text[max(0, start - REACH) : start])
        parts = body.split(".")
        shape = re.sub("[A-Za-z]+", "a", re.sub("[0-9]+", "9", body))

        def side(c: str) -> str:
            return "end" if not c else "space" if c.isspace() else "word" if c.isalnum() else c

        return [
            # the first three tell base spans apart and are left out at times
            f"shape={shape}",
            f"plus={body[0] == '+'}",
            f"luhn={13 <= len(digits) <= 19 and luhn(digits)}",
            f"digits={len(digits)}",
            f"letters={min(len(body) - len(digits), 12)}",
            f"at={body.count('@')}",
            f"dots={min(len(parts) - 1, 5)}",
            f"bytes={len(parts) == 4 and all(p.isdigit() and len(p) <= 3 and int(p) <= 255 for p in parts)}",
            f"before={side(before)}",
            f"after={side(after)}",
            f"word={words[-1].lower() if words else ''}",
            "bias",
        ]


class Field:
    """Weights of the features by kind; the score of a token outside is 0."""

    def __init__(self) -> None:
        self.weights: dict[str, np.ndarray] = {}

    def scores(self, features: list[list[str]]) -> np.ndarray:
        zero = np.zeros(len(KINDS))
        return np.array(
            [sum((self.weights.get(f, zero) for f in row), zero) for row in features]
        ).reshape(-1, len(KINDS))

    def marginals(self, lattice: Lattice, scores: np.ndarray) -> np.ndarray:
        """Chance of each segment and kind, over all ways to cut the region."""
        by_end: list[list[int]] = [[] for _ in range(lattice.n + 1)]
        by_start: list[list[int]] = [[] for _ in range(lattice.n + 1)]
        for k, (i, j, _, _) in enumerate(lattice.segments):
            by_end[j].append(k)
            by_start[i].append(k)
        own = np.logaddexp.reduce(scores, axis=1) if len(scores) else np.zeros(0)
        ahead, behind = np.zeros(lattice.n + 1), np.zeros(lattice.n + 1)
        for j in range(1, lattice.n + 1):
            ways = [ahead[j - 1], *(ahead[lattice.segments[k][0]] + own[k] for k in by_end[j])]
            ahead[j] = np.logaddexp.reduce(ways)
        for i in range(lattice.n - 1, -1, -1):
            ways = [behind[i + 1], *(behind[lattice.segments[k][1]] + own[k] for k in by_start[i])]
            behind[i] = np.logaddexp.reduce(ways)
        edge = np.array([ahead[i] + behind[j] for i, j, _, _ in lattice.segments])
        return np.exp(scores + (edge - ahead[lattice.n])[:, None]) if len(edge) else scores

    def learn(self, lattice: Lattice, truth: dict[tuple[int, int], int], drop: np.ndarray) -> None:
        """A gradient step on the log-likelihood of one region."""
        features = [
            [f for k, f in enumerate(row) if k > 2 or not drop[k]] for row in lattice.features
        ]
        step = -self.marginals(lattice, self.scores(features))
        for (start, end), kind in truth.items():
            step[lattice.at[start, end], kind] += 1
        for row, change in zip(features, step):
            if np.abs(change).max() > 1e-4:
                for f in row:
                    held = self.weights.setdefault(f, np.zeros(len(KINDS)))
                    held *= 1 - DECAY
                    held += RATE * change

    def best(self, lattice: Lattice) -> list[tuple[int, int, int, float]]:
        """The best cut of a region: kind, start, end and chance of its entities."""
        if not lattice.segments:
            return []
        scores = self.scores(lattice.features)
        chance = self.marginals(lattice, scores)
        kind = scores.argmax(axis=1)
        value: list[float] = [0.0] * (lattice.n + 1)
        taken: list[int | None] = [None] * (lattice.n + 1)
        by_end: dict[int, list[int]] = {}
        for k, (_, j, _, _) in enumerate(lattice.segments):
            by_end.setdefault(j, []).append(k)
        for j in range(1, lattice.n + 1):
            value[j] = value[j - 1]
            for k in by_end.get(j, ()):
                reached = value[lattice.segments[k][0]] + scores[k, kind[k]]
                if reached > value[j]:
                    value[j], taken[j] = reached, k
        found, j = [], lattice.n
        while j:
            k = taken[j]
            if k is None:
                j -= 1
                continue
            i, _, start, end = lattice.segments[k]
            found.append((int(kind[k]), start, end, float(chance[k, kind[k]])))
            j = i
        return found


def training_regions(docs: DataFrame, text: str, most: int = TRAIN_REGIONS) -> list[str]:
    """Regions to learn from: with a base span, or with too few digits to hold one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for value in batch.column("text"):
                value = value.as_py() or ""
                for start, end in regions(value) if SIGN.search(value) else ():
                    region = value[start:end]
                    few = sum(c.isdigit() for c in region) < MONEY_DIGITS and "@" not in region
                    if base_spans(region) or few:
                        found.append((region, not few))
            if found:
                a, b = zip(*found)
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["region", "rich"])

    found = docs.select(F.col(text).alias("text")).mapInArrow(run, "region string, rich boolean")
    found = found.where(F.length("region") < 400).withColumn("hash", F.xxhash64("region"))
    rich = found.where("rich").orderBy("hash").limit(most)
    poor = found.where("NOT rich").orderBy("hash").limit(most // 4)
    return sorted(row.region for row in rich.unionByName(poor).select("region").collect())


PREFIX = re.compile(r"\+[0-9]{1,3}[ -]*(?=[(0-9])")


def _case(region: str, spans: list[Span]) -> tuple[Lattice, dict[tuple[int, int], int]]:
    """A region and those of its spans that its segments can express and that do not overlap."""
    lattice, truth, end_of_last = Lattice(region), {}, 0
    for kind, start, end in spans:
        if (start, end) in lattice.at and start >= end_of_last:
            truth[start, end] = kind
            end_of_last = end
    return lattice, truth


def fit(examples: list[str], seed: int = 7) -> Field:
    field, rng = Field(), np.random.default_rng(seed)
    cases = []
    for region in examples:
        base = sorted(base_spans(region), key=lambda s: (s[1], -s[2]))
        cases.append(_case(region, base))
        # a number written without its country's prefix is a phone number all the same
        for kind, start, end in base:
            prefix = PREFIX.match(region, start, end) if kind == 3 else None
            if prefix and sum(x[0] == 3 for x in base) == 1:
                cut = prefix.end() - start
                moved = [
                    (k, s - cut * (s > start), e - cut * (e >= end))
                    for k, s, e in base
                    if k == 3 or e <= start or s >= end
                ]
                cases.append(_case(region[:start] + region[prefix.end() :], moved))
    for _ in range(EPOCHS):
        for k in rng.permutation(len(cases)):
            field.learn(*cases[k], rng.random(3) < DROPOUT)
    return field


def added_spans(text: str, base: list[Span], field: Field, least: float = LEAST_CHANCE) -> list[Span]:
    """Spans of the field that overlap no base span."""
    found = []
    for start, end in regions(text):
        for kind, a, b, chance in field.best(Lattice(text[start:end])):
            a, b = a + start, b + start
            cut = (a == start and start > 0) or (b == end and end < len(text))
            if chance >= least and not cut and all(b <= s or e <= a for _, s, e in base):
                found.append((kind, a, b))
    return found


def personal_data(
    docs: DataFrame, field: Field | None, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per row: id, base and spans, both arrays of (kind, start, end) by kind and start."""
    docs = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
    spans = "array<struct<kind:string,start:bigint,end:bigint>>"
    schema = T.StructType(
        [docs.schema["id"], *T.StructType.fromDDL(f"base {spans}, spans {spans}")]
    )

    def named(found: list[Span]) -> list[dict]:
        return [{"kind": KINDS[k], "start": s, "end": e} for k, s, e in sorted(found)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, every = [], []
            for value in batch.column("text"):
                value = value.as_py() or ""
                found = base_spans(value) if SIGN.search(value) else []
                more = added_spans(value, found, field) if field and SIGN.search(value) else []
                base.append(named(found))
                every.append(named(found + more))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(base, pa.list_(kind)), pa.array(every, pa.list_(kind))],
                ["id", "base", "spans"],
            )

    return docs.mapInArrow(run, schema)


def _joined(spans: str):
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


@query("op7_personal_data")
def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = personal_data(docs, fit(training_regions(docs, "text")))

    def count(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select(
        F.col("id").alias("doc_id"),
        *map(count, KINDS),
        F.sha2(_joined("base"), 256).alias("base_sha256"),
        _joined("spans").alias("spans"),
    )
