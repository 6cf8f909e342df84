"""Language of documents as mixtures, by expectation-maximisation.

Character trigrams of the labelled documents, all of them, give each language a
distribution. A document's share of each language is the mixture of these distributions
that expectation-maximisation fits to its trigrams. Its set of languages grows from the
best single one along the fitted order for as long as the likelihood gains more than
half the logarithm of the sample size per language (trigrams overlap, so three of them
count as one observation).

Edge cases: null texts and texts without a letter are ``und`` with score 0, and so is
every text when no label can be learned from; null labels and null ids are not learned
from; blank or odd labels count as languages like any other.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evidmap.llm.catalog import query
from evidmap.llm.tables import released, table

UNKNOWN = "und"
GRAM_BITS = 14
ROUNDS = 15
SMOOTHING = 0.1
OVERLAP = 3
# The model has 2^14 numbers per language and is held in each task: 100 MB at this many.
MAX_LANGUAGES = 1500
CHUNK = 1 << 19
FOUND = "lang_pred string, score double, shares map<string,double>"


def letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def trigrams(texts: list[str], is_letter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed trigrams of the letters of each text, and the number of the text of each.

    Words stand between single spaces; what is no letter counts as space.
    """
    joined = "".join(f" {t.lower()} " for t in texts)
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.array([len(t.lower()) + 2 for t in texts])
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)
    codes = np.where(is_letter[codes], codes, np.uint32(32))
    space = codes == 32
    keep = ~space
    keep[1:] |= ~space[:-1]  # the first of several spaces stays
    keep[0] = True
    codes, owner = codes[keep], owner[keep]
    # a text's leading space may have been merged with the end of the one before
    a, b, c = codes[:-2], codes[1:-1], codes[2:]
    mixed = (a * np.uint32(0x9E3779B1)) ^ (b * np.uint32(0x85EBCA6B)) ^ (c * np.uint32(0xC2B2AE35))
    mixed = (mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    middle = b != 32
    return (mixed >> np.uint32(32 - GRAM_BITS))[middle], owner[1:-1][middle]


def chunks(column: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """Texts (null: empty) some at a time, with the number of the first."""
    first, texts, size = 0, [], 0
    for number, text in enumerate(column):
        texts.append(text.as_py() or "")
        size += len(texts[-1])
        if size >= CHUNK:
            yield first, texts
            first, texts, size = number + 1, [], 0
    if texts:
        yield first, texts


class Model(NamedTuple):
    languages: list[str]
    chances: np.ndarray  # of each trigram by language, (2^14, languages)


def train(docs: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """Trigram distributions of all languages of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        is_letter, counts = letters(), {}
        for batch in released(batches):
            names = batch.column("lang").to_pylist()
            for first, texts in chunks(batch.column("text")):
                grams, owner = trigrams(texts, is_letter)
                own = np.array(names[first : first + len(texts)], object)
                for name in set(own):
                    mine = grams[(own == name)[owner]]
                    seen = counts.setdefault(name, np.zeros(1 << GRAM_BITS, np.int64))
                    seen += np.bincount(mine, minlength=1 << GRAM_BITS)
        for name, seen in counts.items():
            at = np.flatnonzero(seen)
            yield from pa.table(
                {"lang": [name] * len(at), "gram": at.astype(np.int32), "n": seen[at]}
            ).to_batches()

    known = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    known = known.select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    counts = known.mapInArrow(run, "lang string, gram int, n bigint")
    counts = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rows = counts.groupBy("lang").agg(
        F.collect_list("gram").alias("grams"), F.collect_list("n").alias("counts")
    )
    found = {}
    for row in rows.limit(MAX_LANGUAGES + 1).collect():
        seen = np.full(1 << GRAM_BITS, SMOOTHING)
        seen[row.grams] += row.counts
        found[row.lang] = seen / seen.sum()
    if len(found) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} values of {lang}: is it a language?")
    names = sorted(found)
    chances = np.array([found[n] for n in names]).reshape(len(names), 1 << GRAM_BITS)
    return Model(names, np.ascontiguousarray(chances.T, np.float32))


def fit(
    chance: np.ndarray, n: np.ndarray, owner: np.ndarray, starts: np.ndarray, allowed: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Shares of the allowed languages by document, and the log-likelihood of each document."""
    share = allowed / allowed.sum(axis=1, keepdims=True)
    total = np.add.reduceat(n, starts)
    for _ in range(ROUNDS):
        part = share[owner] * chance
        part *= (n / part.sum(axis=1))[:, None]
        share = np.add.reduceat(part, starts, axis=0) / total[:, None]
    like = np.log((share[owner] * chance).sum(axis=1)) * n
    return share, np.add.reduceat(like, starts)


def mixtures(grams: np.ndarray, owner: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Documents with trigrams, their shares of languages, and the chance of the best one."""
    keys = np.sort(owner.astype(np.int64) << GRAM_BITS | grams)
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    n = np.diff(np.append(first, len(keys))).astype(np.float32)
    gram, doc = keys[first] & (1 << GRAM_BITS) - 1, keys[first] >> GRAM_BITS
    starts = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
    docs, chance = doc[starts], model.chances[gram]
    at = np.repeat(np.arange(len(docs)), np.diff(np.append(starts, len(doc))))
    total, width = np.add.reduceat(n, starts), len(model.languages)

    alone = np.add.reduceat(np.log(chance) * n[:, None], starts, axis=0) / OVERLAP
    best = alone.argmax(axis=1)
    chosen = np.eye(width, dtype=np.float32)[best]
    value = alone.max(axis=1)
    sure = 1 / np.exp(alone - value[:, None]).sum(axis=1)
    penalty = np.log(np.maximum(total / OVERLAP, 2)) / 2
    share, _ = fit(chance, n, at, starts, np.ones((len(docs), width), np.float32))
    # the best single language comes first, then the others by their fitted share
    share[np.arange(len(docs)), best] += 2
    order = np.argsort(-share, axis=1, kind="stable")
    active = np.arange(len(docs))
    for size in range(2, width + 1):
        mine = np.isin(at, active)
        allowed = np.zeros((len(docs), width), np.float32)
        np.put_along_axis(allowed, order[:, :size], 1, axis=1)
        where = np.flatnonzero(mine)
        inner = np.searchsorted(active, at[where])
        begin = np.flatnonzero(np.concatenate([[True], inner[1:] != inner[:-1]]))
        share, like = fit(chance[where], n[where], inner, begin, allowed[active])
        better = like / OVERLAP - penalty[active] * (size - 1) > value[active]
        value[active[better]] = (like / OVERLAP - penalty[active] * (size - 1))[better]
        chosen[active[better]] = share[better]
        active = active[better]
        if not len(active):
            break
    return docs, chosen, sure


def identify(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, lang_pred, score, and ``shares``, a map of the chosen languages.

    The score is the share of the predicted language, or for a text in one language
    the chance of it against each other one alone. ``text`` may be a field of ``doc_id``
    (``row.text``): it goes to the tasks once then.
    """
    inside = text.startswith(f"{doc_id}.")
    field = text[len(doc_id) + 1 :]
    docs = docs.select(F.col(doc_id).alias("id"), *([] if inside else [F.col(text).alias("text")]))
    schema = T.StructType([docs.schema["id"], *T.StructType.fromDDL(FOUND)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        is_letter = letters()
        for batch in released(batches):
            size = len(batch)
            names, scores = [UNKNOWN] * size, np.zeros(size)
            shares: list[list[tuple[str, float]]] = [[] for _ in range(size)]
            column = pc.struct_field(batch.column("id"), [field]) if inside else batch.column("text")
            for first, texts in chunks(column):
                grams, owner = trigrams(texts, is_letter)
                if not len(grams) or not model.languages:
                    continue
                numbers, mixed, sure = mixtures(grams, owner, model)
                for number, row, chance in zip(numbers.tolist(), mixed, sure):
                    top = int(row.argmax())
                    names[first + number] = model.languages[top]
                    several = np.flatnonzero(row > 0)
                    alone = len(several) == 1
                    scores[first + number] = chance if alone else row[top]
                    shares[first + number] = [(model.languages[k], float(row[k])) for k in several]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array(names),
                    pa.array(np.clip(scores, 0.0, 1.0)),
                    pa.array(shares, pa.map_(pa.string(), pa.float64())),
                ],
                ["id", "lang_pred", "score", "shares"],
            )

    return docs.mapInArrow(run, schema)


def held_out(doc_id: Column) -> Column:
    """A quarter of the ids is not learned from."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2


@query("op6_language")
def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = identify(docs, train(docs.where(~held_out(F.col("doc_id")))))
    return found.select(
        F.col("id").alias("doc_id"),
        F.coalesce(held_out(F.col("id")), F.lit(False)).alias("held_out"),
        "lang_pred",
        "score",
    )


def in_a_language(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang"
) -> DataFrame:
    """``docs`` without the rows whose text is in no language; the columns of ``docs``."""
    model = train(docs.where(~held_out(F.col(doc_id))), text, lang)
    fields = docs.schema
    is_row = F.struct(*[F.col(c) for c in docs.columns])
    found = identify(docs.select(is_row.alias("row")), model, "row", f"row.{text}")
    return found.where(F.col("lang_pred") != UNKNOWN).select("id.*").to(fields)
