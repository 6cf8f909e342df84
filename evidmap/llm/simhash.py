"""SimHash near-duplicates, searched by the generalised pigeonhole principle.

Bits that rise and fall together are put into one part, so that the parts tell
different things. Each part's threshold is chosen by dynamic programming over the
number of candidates that it would bring, estimated from the counts of all
fingerprints: collisions of the part's values, carried on to larger distances with
the share of ones of each bit. The cut with the least candidates and filed rows wins.

Edge cases: null, empty and wordless texts have fingerprint zero and are linked like
any other; a null id takes part, and a component of null ids only has a null id; rows
of equal id stay rows of their own. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evidmap.llm import hamming
from evidmap.llm.catalog import query
from evidmap.llm.components import components
from evidmap.llm.hamming import Part, flips, mask_of, unsigned
from evidmap.llm.tables import released, table, written

SHINGLE = 3
MAX_BITS = 3
SEED = 42
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
# A filed row (shuffled and sorted) costs about as much as this many comparisons.
ROW_COST = 50.0
PIECE = 1 << 20


def text_pieces(text: bytes, size: int = PIECE) -> Iterator[bytes]:
    """``text`` in pieces of about ``size`` bytes, cut at white space."""
    at = 0
    while len(text) - at > size:
        piece = text[at : at + size]
        space = max(piece.rfind(s) for s in (b" ", b"\t", b"\n", b"\v", b"\f", b"\r"))
        if space < 0:  # one word over the whole piece
            size *= 2
            continue
        yield piece[:space]
        at += space + 1
    yield text[at:]


def shingle_hashes(text: str | None, length: int = SHINGLE) -> Iterator[np.ndarray]:
    """XXH64 of the word shingles of a text, a piece of it at a time."""
    held: list[bytes] = []
    short = True
    for piece in text_pieces((text or "").encode().translate(LOWER)):
        words = held + piece.split()
        if len(words) >= length:
            short = False
            joined = b" ".join(words)
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
            starts = np.concatenate([[0], ends[:-length] + 1]).tolist()
            spans = zip(starts, ends[length - 1 :].tolist())
            digest = xxhash.xxh64_intdigest
            yield np.array([digest(joined[s:e], SEED) for s, e in spans], np.uint64)
        held = words[max(0, len(words) - length + 1) :]
    if short and held:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(held), SEED)], np.uint64)


def fingerprint(text: str | None, length: int = SHINGLE) -> int:
    """Bit b is 1 if it is set in over half of the shingle hashes."""
    total, ones = 0, np.zeros(64, np.int64)
    for hashes in shingle_hashes(text, length):
        for at in range(0, len(hashes), 1 << 16):
            block = hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8)
            ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        total += len(hashes)
    return int(np.packbits(2 * ones > total, bitorder="little").view(np.uint64)[0])


def with_fingerprints(
    docs: DataFrame, doc_id: str, text: str, length: int = SHINGLE
) -> DataFrame:
    """(id, text_hash, fp) of every row."""
    docs = docs.select(
        F.col(doc_id).alias("id"), F.col(text).alias("text"), F.xxhash64(text).alias("text_hash")
    )
    kind = docs.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in released(batches):
            fps = [fingerprint(t.as_py(), length) for t in batch.column("text")]
            signed = pa.array(np.array(fps, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("text_hash"), signed], ["id", "text_hash", "fp"]
            )

    return docs.mapInArrow(run, f"id {kind}, text_hash bigint, fp bigint")


def bit_counts(fps: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints and, for all pairs of bits, how many have both (64 x 64)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, n = np.zeros((64, 64), np.int64), 0
        for batch in released(batches):
            block = unsigned(batch, "fp").view(np.uint8).reshape(-1, 8)
            bits = np.unpackbits(block, axis=1, bitorder="little").astype(np.float32)
            both += (bits.T @ bits).astype(np.int64)
            n += len(bits)
        if n:
            place = np.arange(64 * 64)
            yield from pa.table(
                {"place": np.append(place, -1), "n": np.append(both.ravel(), n)}
            ).to_batches()

    sums = fps.select("fp").mapInArrow(run, "place bigint, n bigint")
    sums = {row.place: row.n for row in sums.groupBy("place").agg(F.sum("n").alias("n")).collect()}
    counts = np.array([sums.get(i, 0) for i in range(64 * 64)], np.float64).reshape(64, 64)
    return sums.get(-1, 0), counts


def group_bits(n: int, both: np.ndarray, parts: int) -> list[tuple[int, ...]]:
    """Bits in ``parts`` groups of like size, each grown from the strongest correlation left."""
    share = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-9))
    tie = np.abs(both / max(n, 1) - np.outer(share, share)) / np.outer(spread, spread)
    np.fill_diagonal(tie, -1.0)
    free, groups = set(range(64)), []
    for size in [len(p) for p in np.array_split(np.arange(64), parts)]:
        left = sorted(free)
        pair = np.unravel_index(np.argmax(tie[np.ix_(left, left)]), (len(left), len(left)))
        group = [left[int(pair[0])], left[int(pair[1])]]
        while len(group) < size:
            rest = [b for b in left if b not in group]
            group.append(rest[int(np.argmax(tie[np.ix_(rest, group)].mean(axis=1)))])
        free -= set(group)
        groups.append(tuple(sorted(group)))
    return groups


def within(share: np.ndarray, most: int) -> np.ndarray:
    """Chance that two fingerprints differ in at most 0, 1, ... ``most`` of independent bits."""
    chance = np.zeros(most + 1)
    chance[0] = 1.0
    for q in 2 * share * (1 - share):
        chance[1:] = chance[1:] * (1 - q) + chance[:-1] * q
        chance[0] *= 1 - q
    return np.cumsum(chance)


def allocate(costs: np.ndarray, total: int) -> tuple[float, list[int]]:
    """Thresholds (from -1) of least cost with sum ``total``; costs[i, t + 1] of part i at t."""
    parts, width = costs.shape
    best = {0: (0.0, [])}
    for i in range(parts):
        reached: dict[int, tuple[float, list[int]]] = {}
        for spent, (cost, chosen) in best.items():
            for t in range(-1, width - 1):
                now = (cost + costs[i, t + 1], [*chosen, t])
                if spent + t not in reached or now[0] < reached[spent + t][0]:
                    reached[spent + t] = now
        best = reached
    return best[total]


def plan_parts(fps: DataFrame, max_bits: int = MAX_BITS) -> list[Part]:
    """Parts and thresholds for these distinct fingerprints."""
    n, both = bit_counts(fps)
    if not n:
        return hamming.even_parts(max_bits)
    cuts = [group_bits(n, both, m) for m in range(2, max_bits + 2)]
    names = [(m, i) for m, cut in enumerate(cuts) for i in range(len(cut))]
    exact = [Part(cuts[m][i], 0) for m, i in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in released(batches):
            fp = unsigned(batch, "fp")
            for number, part in enumerate(exact):
                value = (fp & np.uint64(mask_of(part.bits))).view(np.int64)
                yield from pa.table(
                    {"part": np.full(len(fp), number, np.int32), "value": value}
                ).to_batches()

    # pairs that share a part's value, over all fingerprints
    met = (
        fps.select("fp").mapInArrow(run, "part int, value bigint")
        .groupBy("part", "value").agg(F.count("*").cast("double").alias("c"))
        .groupBy("part").agg(F.sum(F.expr("c * (c - 1) / 2")).alias("pairs"))
    )
    pairs = {row.part: row.pairs for row in met.collect()}
    share = np.diag(both) / n
    found = []
    for m, cut in enumerate(cuts):
        costs = np.zeros((len(cut), max_bits + 2))
        for i, bits in enumerate(cut):
            chance = within(share[list(bits)], max_bits)
            collide = pairs[names.index((m, i))]
            for t in range(max_bits + 1):
                filed = n * len(flips(Part(bits, t)))
                # a value meets the neighbours' values from both sides
                grown = max(chance[t] / max(chance[0], 1e-30), 1.0)
                costs[i, t + 1] = max(collide, n * n / 2 * chance[0]) * grown * 2 + ROW_COST * filed
        cost, thresholds = allocate(costs, max_bits - len(cut) + 1)
        found.append((cost, [Part(b, t) for b, t in zip(cut, thresholds) if t >= 0]))
    return min(found, key=lambda x: x[0])[1]


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    length: int = SHINGLE,
    max_bits: int = MAX_BITS,
    cell: int = hamming.CELL,
) -> DataFrame:
    """Per row: id, text_hash, fp, group (a fingerprint that names it) and component_id, the
    least id reachable over links of at most ``max_bits`` differing bits."""
    prints = written(with_fingerprints(docs, doc_id, text, length), "fingerprints")
    fps = written(prints.groupBy("fp").agg(F.min("id").alias("least_id")), "distinct")
    links = hamming.links(fps, plan_parts(fps, max_bits), max_bits, cell)
    labels = components(links).select(F.col("node").alias("fp"), F.col("label").alias("group"))
    rooted = fps.join(labels, "fp", "left").withColumn("group", F.coalesce("group", "fp"))
    rooted = written(rooted, "rooted")
    least = rooted.groupBy("group").agg(F.min("least_id").alias("component_id"))
    return prints.join(rooted.join(least, "group").drop("least_id"), "fp")


def one_per_group(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    length: int = SHINGLE,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """``docs`` with one row of each group: of least id, then of least hash of its text."""
    found = near_duplicates(docs, doc_id, text, length, max_bits)
    order = F.struct(F.col("id").isNull().alias("none"), "id", "text_hash")
    kept = found.groupBy("group").agg(F.min(order).alias("kept"))
    kept = kept.select(F.col("kept.id").alias("_kept_id"), F.col("kept.text_hash").alias("_kept_hash"))
    docs = docs.withColumn("_row_hash", F.xxhash64(text))
    same = F.col(doc_id).eqNullSafe(F.col("_kept_id")) & (F.col("_row_hash") == F.col("_kept_hash"))
    # rows repeated as a whole are in one group too
    kept = docs.join(kept, same, "left_semi").dropDuplicates([doc_id, "_row_hash"])
    return kept.drop("_row_hash")


@query("op3_simhash")
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )
