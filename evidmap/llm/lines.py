"""Line dedup that forgives small edits.

Lines are normalised (ASCII: small letters, digits to 0, other signs to a space) and
their words give a SimHash. Lines whose fingerprints differ in at most three bits meet in
pigeonhole blocks; of those, lines with an edit similarity of 0.8 or more are linked, and
of each connected group of lines only the first occurrence stays: least document id,
then least place. Texts of lines travel only where a fingerprint has a neighbour.

A sign of three or four bytes in UTF-8 (Chinese, Japanese, Thai, ...) counts as a word of
its own, as most of these scripts put no spaces between words.

Edge cases: null texts stay null; lines of fewer than five words and fewer than twenty
characters, spaces aside, blank ones included, are always kept; a document may lose all its lines and then has an empty text; rows
with the same id and text share their decisions; null ids come last; lines end at
"\\n" only and join as they were split, so a document without repeats is unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evidmap.llm import hamming
from evidmap.llm.buckets import group_starts, map_groups
from evidmap.llm.catalog import query
from evidmap.llm.components import components
from evidmap.llm.hamming import Part, close_pairs, mask_of, unsigned
from evidmap.llm.tables import released, row_key, rows_fit, table, written

MIN_WORDS = 5
MIN_CHARS = 20  # a line of fewer words that has so many characters is compared as well
WIDE = 0xE0  # first bytes from here on begin signs of three or four bytes
MAX_BITS = 3
SIMILARITY = 0.8
# Keys of documents (8 bytes) are broadcast up to this many; beyond, texts are shuffled.
MAX_BROADCAST_ROWS = 1_000_000
# Normal form of a byte: small letters, 0 for digits, a space for other ASCII; the bytes of
# other signs stay as they are.
FORM = bytes(
    ord("0") if chr(b).isdigit() else b + 32 if 65 <= b <= 90 else b if b >= 97 and b <= 122 else 32
    for b in range(128)
) + bytes(range(128, 256))
LANES = 255  # ones that a byte can count


def words_of(line: bytes) -> list[bytes]:
    """Words of the normalised line, from its UTF-8."""
    return line.translate(FORM).split()


# Bytes worked on at once: some ten arrays of 8 bytes each.
CHUNK = 1 << 20
BYTE_STEP, WORD_STEPS = 0x9E3779B97F4A7C15, (0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


def _powers(step: int, n: int) -> np.ndarray:
    """1, step, step^2, ... modulo 2^64."""
    found = np.full(n, step, np.uint64)
    found[:1] = 1
    return np.cumprod(found, dtype=np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _hashes_of_runs(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, step: int) -> np.ndarray:
    """Polynomial hash of each run of ``values``; all arithmetic is modulo 2^64."""
    powers, back = _powers(step, len(values)), _powers(pow(step, -1, 1 << 64), len(values))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * powers, dtype=np.uint64)])
    return _mixed((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64))


def simhashes(hashes: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Fingerprint of each run of word hashes; a bit is 1 if most words have it."""
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    # each byte counts the ones of one bit: runs are summed in pieces that it can hold
    pieces = -(-sizes // LANES)
    first = np.cumsum(pieces) - pieces
    inside = np.arange(pieces.sum()) - np.repeat(first, pieces)
    at = np.repeat(starts, pieces) + inside * LANES
    last = np.minimum(at + LANES, np.repeat(starts + sizes, pieces))
    # every second run of the sum below is one of these pieces, the others fill the gaps
    edges = np.column_stack([at, last]).ravel()
    edges = edges[: len(edges) - (last[-1] == len(hashes))]
    sums = np.add.reduceat(bits.view(np.uint64), edges, axis=0)[::2]
    ones = np.add.reduceat(sums.view(np.uint8), first, axis=0, dtype=np.int64)
    return np.packbits(2 * ones > sizes[:, None], axis=1, bitorder="little").view(np.uint64).ravel()


def line_prints(
    texts: list[bytes], min_words: int = MIN_WORDS
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lines of enough words or characters: number of the text, place of the line in it, hash of the
    normalised line (two columns of 64 bits), fingerprint."""
    data = np.frombuffer(b"".join(t + b"\n" for t in texts), np.uint8)
    form = np.frombuffer(FORM, np.uint8)[data]
    inside = form != 32
    tail = (form & 0xC0) == 0x80  # bytes after the first of a sign
    heads = np.flatnonzero(inside & ~tail)
    wide = np.zeros(len(heads) + 1, bool)
    wide[:-1] = form[heads] >= WIDE
    # a word begins after a gap, at a wide sign and after one
    begins = wide[:-1] | np.concatenate([[False], wide[:-2]])[: len(heads)]
    begin = inside & ~np.concatenate([[False], inside[:-1]])
    begin[heads[begins]] = True
    starts = np.flatnonzero(begin)
    # it ends where the next one begins or a gap does
    gap = np.flatnonzero(~inside)  # the last byte is one
    ends = gap[np.searchsorted(gap, starts)]
    ends = np.minimum(ends, np.append(starts[1:], len(form)))
    none = np.zeros(0, np.int64)
    if not len(starts):
        return none, none, np.zeros((0, 2), np.uint64), none.view(np.uint64)
    words = _hashes_of_runs(form.astype(np.uint64), starts, ends, BYTE_STEP)
    breaks = np.cumsum(data == 10, dtype=np.int32)
    line = breaks[starts]
    head = group_starts(line)
    sizes = np.diff(np.append(head, len(line)))
    signs = np.concatenate([[0], np.cumsum(inside & ~tail)])
    last = ends[head + sizes - 1]
    long = (sizes >= min_words) | (signs[last] - signs[starts[head]] >= MIN_CHARS)
    head, sizes = head[long], sizes[long]
    if not len(head):
        return none, none, np.zeros((0, 2), np.uint64), none.view(np.uint64)
    names = np.column_stack([_hashes_of_runs(words, head, head + sizes, s) for s in WORD_STEPS])
    lines_before = np.cumsum([0, *(t.count(b"\n") + 1 for t in texts)])
    number = line[head].astype(np.int64)
    owner = np.searchsorted(lines_before, number, side="right") - 1
    return owner, number - lines_before[owner], names, simhashes(words, head, sizes)


def chunks(texts: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """Texts (null: empty) some at a time, with the number of the first."""
    first, held, size = 0, [], 0
    for number, text in enumerate(texts):
        held.append((text.as_py() or "").encode())
        size += len(held[-1])
        if size >= CHUNK:
            yield first, held
            first, held, size = number + 1, [], 0
    if held:
        yield first, held


def occurrences(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(id, doc, at, line, fp) of every line of enough words or characters; ``line``: 128-bit hash."""
    schema = T.StructType(
        [docs.schema["id"], *T.StructType.fromDDL("doc bigint, at int, line binary, fp bigint")]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in released(batches):
            for first, texts in chunks(batch.column("text")):
                owner, at, names, fps = line_prints(texts, min_words)
                rows = pa.array(owner + first)
                ends = pa.py_buffer((np.arange(len(names) + 1) * 16).astype(np.int32))
                lines = pa.Array.from_buffers(
                    pa.binary(), len(names), [None, ends, pa.py_buffer(np.ascontiguousarray(names))]
                )
                columns = [
                    batch.column("id").take(rows),
                    batch.column("doc").take(rows),
                    pa.array(at.astype(np.int32)),
                    lines,
                    pa.array(fps.view(np.int64)),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["id", "doc", "at", "line", "fp"])

    return docs.select("id", "doc", "text").mapInArrow(run, schema)


def _shared_start(a: str, b: str) -> int:
    """Length of the common prefix, by halving."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def edit_distance(a: str, b: str, most: int) -> int:
    """Levenshtein distance, or a number above ``most``; all rows of a column at once."""
    start = _shared_start(a, b)
    a, b = a[start:], b[start:]
    end = _shared_start(a[::-1], b[::-1])
    a, b = a[: len(a) - end], b[: len(b) - end]
    if not a or not b:
        return len(a) + len(b)
    if abs(len(a) - len(b)) > most:
        return most + 1
    at: dict[str, int] = {}
    for i, c in enumerate(a):
        at[c] = at.get(c, 0) | 1 << i
    full, top = (1 << len(a)) - 1, 1 << len(a) - 1
    up, down, score = full, 0, len(a)
    for left, c in zip(range(len(b) - 1, -1, -1), b):
        equal = at.get(c, 0)
        vertical = equal | down
        across = (((equal & up) + up) ^ up) | equal
        rise, fall = down | (full & ~(across | up)), up & across
        if rise & top:
            score += 1
        elif fall & top:
            score -= 1
        if score - left > most:
            return most + 1
        rise, fall = (rise << 1 | 1) & full, fall << 1 & full
        up, down = fall | (full & ~(vertical | rise)), rise & vertical
    return score


def similar(a: str, b: str, least: float = SIMILARITY) -> bool:
    most = int((1 - least) * max(len(a), len(b)) + 1e-9)
    return edit_distance(a, b, most) <= most


def _verified(max_bits: int, least: float, parts: list[Part]):
    masks = [np.uint64(mask_of(p.bits)) for p in parts]

    def links(rows: pa.Table) -> pa.Table:
        keys, fps = unsigned(rows, "key"), unsigned(rows, "fp")
        used = unsigned(rows, "used")
        own = np.argmax([used & m == m for m in masks], axis=0)
        lines = rows.column("line").to_pylist()
        texts: dict[int, str] = {}

        def text(i: int) -> str:
            if i not in texts:
                line = b" ".join(words_of(rows.column("text")[i].as_py().encode()))
                texts[i] = line.decode(errors="replace")
            return texts[i]

        root = list(range(len(lines)))

        def find(i: int) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        a, b = [], []
        for left, right in close_pairs(keys, fps, max_bits):
            # a pair that agrees in several parts is looked at under the first of them only
            differ, seen = fps[left] ^ fps[right], np.zeros(len(left), bool)
            for number, mask in enumerate(masks):
                seen |= (differ & mask == 0) & (number < own[left])
            left, right = left[~seen], right[~seen]
            for i, j in zip(left.tolist(), right.tolist()):
                x, y = find(i), find(j)
                # what is connected already needs no proof
                if x != y and (lines[i] == lines[j] or similar(text(i), text(j), least)):
                    root[max(x, y)] = min(x, y)
                    a.append(lines[i])
                    b.append(lines[j])
            if len(texts) > 50_000:
                texts.clear()
        return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})

    return links


def line_links(
    distinct: DataFrame, docs: DataFrame, max_bits: int, least: float, cell: int
) -> DataFrame:
    """(a, b): linked lines that give the connected groups; ``distinct`` has line, fp, first."""
    parts = hamming.even_parts(max_bits)
    fps = written(distinct.groupBy("fp").agg(F.count("*").alias("n")), "line-fingerprints")
    near = hamming.links(fps, parts, max_bits, cell)
    near = near.select(F.explode(F.array("a", "b")).alias("fp"))
    near = written(near.unionByName(fps.where("n > 1").select("fp")).distinct(), "near")
    # the texts of these lines only, each from its first occurrence
    wanted = distinct.join(near, "fp", "left_semi").select("line", "fp", "first.doc", "first.at")
    places = written(
        wanted.groupBy("doc").agg(F.collect_list(F.struct("line", "fp", "at")).alias("lines")),
        "wanted",
    )
    found = docs.select("doc", "text")
    if rows_fit(places, MAX_BROADCAST_ROWS):
        found = found.join(F.broadcast(places.select("doc")), "doc", "left_semi")
    found = found.dropDuplicates(["doc"]).join(places, "doc")
    found = found.select(F.split("text", "\n", -1).alias("all"), "lines")
    found = found.select(
        F.explode_outer(
            F.transform(
                "lines",
                lambda x: F.struct(x["line"].alias("line"), x["fp"].alias("fp"), F.get("all", x["at"]).alias("text")),
            )
        ).alias("x")
    ).select("x.*")
    found = written(found, "near-lines")
    schema = "a binary, b binary"
    links = [
        map_groups(
            rows.distinct().join(found, "fp"),
            "key", _verified(max_bits, least, parts), schema, "line",
        )
        for rows in hamming.cells(near, parts, max_bits, cell)
    ]
    return reduce(DataFrame.unionByName, links).where("a != b").distinct()


def line_dedup(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    min_words: int = MIN_WORDS,
    max_bits: int = MAX_BITS,
    least: float = SIMILARITY,
    cell: int = hamming.CELL,
) -> DataFrame:
    """``docs`` with its text after the removal, and n_lines, n_removed, removed (places
    from 0, ascending)."""
    rest = docs.withColumn("_doc", row_key(F.col(doc_id), F.col(text)))
    keyed = rest.select(F.col(doc_id).alias("id"), F.col(text).alias("text"), F.col("_doc").alias("doc"))
    found = written(occurrences(keyed, min_words), "occurrences")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "doc", "at"))
    distinct = found.groupBy("line").agg(
        F.min("fp").alias("fp"), first.alias("first"), F.count("*").alias("n")
    )
    distinct = written(distinct, "lines")
    labels = written(components(line_links(distinct, keyed, max_bits, least, cell)), "line-groups")
    labels = labels.select(F.col("node").alias("line"), "label")
    grouped = distinct.join(labels, "line", "left").where("label IS NOT NULL OR n > 1")
    grouped = grouped.select("line", F.coalesce("label", "line").alias("label"), "first")
    grouped = written(grouped, "repeated")
    kept = grouped.groupBy("label").agg(F.min("first").alias("kept"))
    kept = grouped.join(kept, "label").select("line", "kept.doc", "kept.at")
    kept = kept.select("line", F.col("doc").alias("kept_doc"), F.col("at").alias("kept_at"))
    gone = found.select("doc", "at", "line").join(kept, "line")
    # straight into an aggregation by document, so that a very common line can be split
    gone = gone.where("doc != kept_doc OR at != kept_at").groupBy(F.col("doc").alias("_doc")).agg(
        F.array_sort(F.collect_set("at")).alias("removed")
    )
    none = F.array().cast("array<int>")
    rest = rest.join(gone, "_doc", "left").drop("_doc")
    rest = rest.withColumn("removed", F.coalesce("removed", none))
    lines = F.split(text, "\n", -1)
    rest = rest.withColumn("_lines", F.when(F.col(text).isNotNull(), lines))
    places = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), "removed")
    left = F.array_join(F.transform(places, lambda i: F.get("_lines", i)), "\n")
    size = F.coalesce(F.size(F.col("_lines")), F.lit(0))
    return (
        rest.withColumn("n_lines", F.when(F.col("_lines").isNull(), 0).otherwise(size).cast("bigint"))
        .withColumn("n_removed", F.size("removed").cast("bigint"))
        .withColumn(text, F.when(F.size("removed") > 0, left).otherwise(F.col(text)))
        .drop("_lines")
    )


@query("op10_fuzzy_lines")
def op10_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_lines",
        "n_removed",
        F.length(F.coalesce("text", F.lit(""))).cast("bigint").alias("n_chars_kept"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
        F.array_join("removed", ",").alias("removed_lines"),
    )


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without repeated lines; documents of which nothing is left go."""
    found = line_dedup(docs, doc_id, text)
    left = F.regexp_replace(text, r"\s+", "") != ""
    return found.where((F.col("n_removed") == 0) | left).select(*docs.columns)
