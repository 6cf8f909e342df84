"""Suffix-array dedup: bytes covered by a string of 100 bytes that also starts earlier.

Every 100-byte string holds an anchor: the least hash of its 32-byte strings. Equal strings
have equal anchors, so a string can only repeat where its anchor does. The surroundings of
repeated anchors, with each place a string can start at, are dealt out by anchor; there a
suffix order of each block (two-stage sorting) brings equal strings next to each other,
adjacent common prefixes of 100 bytes show them, and all but the earliest are repeats.
Surroundings that are equal as a whole are taken once. A very frequent anchor is dealt
out by the strings around it instead, one by one.

Ids are whole numbers; a null id comes after all others. Edge cases: null texts are empty;
texts under 100 bytes are never touched; rows of equal id and text are one document and
share their result; rows of equal id and different texts are in the order of a hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from evidmap.llm.buckets import group_starts, whole_groups
from evidmap.llm.catalog import query
from evidmap.llm.suffixes import common_prefixes, suffix_order, word_keys
from evidmap.llm.tables import row_key, table, written

LENGTH = 100
GRAM = 32
REACH = LENGTH - GRAM + 1  # 32-byte strings in one of 100 bytes
PLACE_BITS = 23
CHUNK = 1 << 22
BLOCK = 1 << 22
MOST_ROWS = 200_000
# Beyond so many occurrences an anchor's strings are dealt out one by one.
FREQUENT = 100_000


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (a * np.uint64(0x9E3779B97F4A7C15)) ^ (b + np.uint64(0xD6E8FEB86659FD93))
        x *= np.uint64(0xFF51AFD7ED558CCD)
        return x ^ (x >> np.uint64(32))


def anchors(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per start of a 100-byte string of ``data``, in runs of equal anchor: hash of the
    anchor, its place, and the first start."""
    if len(data) < LENGTH:
        none = np.zeros(0, np.int64)
        return none.view(np.uint64), none, none
    hashes, have = data.astype(np.uint64), 1
    while have < GRAM:
        hashes = _mix(hashes[:-have], hashes[have:])
        have *= 2
    mask = np.uint64((1 << PLACE_BITS) - 1)
    least, have = (hashes & ~mask) | np.arange(len(hashes), dtype=np.uint64), 1
    while have < REACH:
        step = min(have, REACH - have)
        least = np.minimum(least[:-step], least[step:])
        have += step
    places = (least & mask).astype(np.int64)
    first = group_starts(places)
    return hashes[places[first]], places[first], first


def pieces(text: bytes) -> Iterator[tuple[int, np.ndarray]]:
    """Pieces of a text such that each 100-byte string lies whole in one, with their place."""
    data = np.frombuffer(text, np.uint8)
    for at in range(0, max(len(data) - LENGTH + 1, 1), CHUNK):
        yield at, data[at : at + CHUNK + LENGTH - 1]


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, hash, places): one row for all places of an anchor in a document, so that a text
    that repeats itself does not make its anchor frequent.

    A place is a number of 8 bytes: the first start above, the number of starts in the last.
    """
    for batch in batches:
        docs, hashes, places = [], [], []
        rows = zip(batch.column("doc").to_pylist(), batch.column("text"), batch.column("copy").to_pylist())
        for doc, text, copy in rows:
            text = b"" if copy or not text.is_valid else text.as_py().encode()
            if len(text) < LENGTH:
                continue
            for at, data in pieces(text):
                found, _, first = anchors(data)
                number = np.diff(np.append(first, len(data) - LENGTH + 1))
                docs.append(np.full(len(found), doc))
                hashes.append(found.view(np.int64))
                places.append((first + at) << 8 | number)
        if docs:
            docs, hashes, places = (np.concatenate(c) for c in (docs, hashes, places))
            order = np.lexsort((places, hashes, docs))
            docs, hashes, places = docs[order], hashes[order], places[order]
            new = np.concatenate([[True], (docs[1:] != docs[:-1]) | (hashes[1:] != hashes[:-1])])
            first = np.flatnonzero(new)
            ends = (np.append(first, len(docs)) * 8).astype(np.int32)
            packed = pa.Array.from_buffers(
                pa.binary(), len(first), [None, pa.py_buffer(ends), pa.py_buffer(places.astype("<i8"))]
            )
            columns = [pa.array(docs[first]), pa.array(hashes[first]), packed]
            yield pa.RecordBatch.from_arrays(columns, ["doc", "hash", "places"])


CONTEXT = pa.schema(
    [("key", pa.int64()), ("id", pa.int64()), ("doc", pa.int64()), ("start", pa.int64()),
     ("number", pa.int64()), ("bytes", pa.binary())]
)
CONTEXT_DDL = "key bigint, id bigint, doc bigint, start bigint, number bigint, bytes binary"


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Surroundings of the repeated anchors of each document.

    Of equal ones in a batch the earliest goes on; for the others ``bytes`` is null, and
    all their starts are repeats.
    """
    for batch in batches:
        batch = pa.Table.from_batches([batch]).sort_by([("id", "ascending"), ("doc", "ascending")])
        rows = zip(*(batch.column(c) for c in ("id", "doc", "text", "found")))
        seen: dict[bytes, tuple[int, int]] = {}
        out: list[tuple] = []
        size = 0
        for id_, doc, text, found in rows:
            id_, doc, text = id_.as_py(), doc.as_py(), text.as_py().encode()
            for key, start, number in _cuts(found.as_py()):
                own = text[start : start + number + LENGTH - 1]
                if key is None:
                    key = xxhash.xxh64_intdigest(own) - (1 << 63)
                first = seen.setdefault(own, (doc, start))
                if first == (doc, start):
                    out.append((key, id_, doc, start, number, own))
                    size += len(own)
                elif out and out[-1][2] == doc and out[-1][5] is None and out[-1][3] + out[-1][4] == start:
                    # repeats side by side become one row
                    out[-1] = (*out[-1][:4], out[-1][4] + number, None)
                else:
                    # no other row has to meet it: it is dealt by its document
                    out.append((doc, id_, doc, start, number, None))
                if size > 4 * CHUNK or len(out) > MOST_ROWS:
                    yield _context_batch(out)
                    out, size, seen = [], 0, {}
        if out:
            yield _context_batch(out)


def _context_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array(c, t) for c, t in zip(zip(*rows), CONTEXT.types)]
    return pa.RecordBatch.from_arrays(columns, schema=CONTEXT)


def _cuts(found: list[dict]) -> Iterator[tuple[int | None, int, int]]:
    """(anchor, first start, number of starts) in order; no anchor for single strings."""
    starts, numbers, keys = [], [], []
    for at in found:
        place = np.frombuffer(at["places"], "<i8")
        start, number = place >> 8, place & 255
        if at["frequent"]:
            inside = np.arange(number.sum()) - np.repeat(np.cumsum(number) - number, number)
            start, number = np.repeat(start, number) + inside, np.ones(len(inside), np.int64)
        starts.append(start)
        numbers.append(number)
        keys += [None if at["frequent"] else at["hash"]]
    owner = np.repeat(np.arange(len(found)), list(map(len, starts)))
    starts, numbers = np.concatenate(starts), np.concatenate(numbers)
    for k in np.argsort(starts, kind="stable"):
        yield keys[owner[k]], int(starts[k]), int(numbers[k])


def repeats(block: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc, start, number) of runs of starts whose string occurs earlier in the block."""
    ids, docs, starts, numbers = (
        block.column(c).to_numpy() for c in ("id", "doc", "start", "number")
    )
    order = np.lexsort((starts, docs, ids))
    new = np.concatenate(
        [[True], (ids[order][1:] != ids[order][:-1]) | (docs[order][1:] != docs[order][:-1])
         | (starts[order][1:] != starts[order][:-1])]
    )
    rank = np.empty(len(order), np.int64)
    rank[order] = np.cumsum(new) - 1
    texts = block.column("bytes").to_pylist()
    # equal surroundings: the earliest stands for all
    first: dict[bytes, int] = {}
    whole = np.zeros(len(texts), bool)
    for k in order.tolist():
        held = first.setdefault(texts[k], k)
        whole[k] = rank[held] != rank[k]
    kept = np.array(sorted(first.values()))
    data = np.frombuffer(b"".join(texts[k] for k in kept), np.uint8)
    sizes = numbers[kept] + LENGTH - 1
    begin = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(kept)), sizes)
    offset = np.arange(len(data)) - begin[owner]
    keys = word_keys(data)
    sa = suffix_order(data, keys)
    sa = sa[offset[sa] < numbers[kept][owner[sa]]]
    shared = common_prefixes(sa, keys, LENGTH)
    runs = np.flatnonzero(shared < LENGTH)
    age = rank[kept][owner[sa]] << 8 | offset[sa]
    least = np.repeat(np.minimum.reduceat(age, runs), np.diff(np.append(runs, len(sa))))
    again = np.sort(sa[age != least])
    # neighbouring starts become one run
    own, off = owner[again], offset[again]
    head = np.ones(len(again), bool)
    head[1:] = (own[1:] != own[:-1]) | (off[1:] != off[:-1] + 1)
    at = np.flatnonzero(head)
    length = np.diff(np.append(at, len(again)))
    found = kept[own[at]]
    return (
        np.concatenate([docs[whole], docs[found]]),
        np.concatenate([starts[whole], starts[found] + off[at]]),
        np.concatenate([numbers[whole], length]),
    )


def _repeat_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc", "start", "number"]
    held: list[pa.Table] = []
    size = 0

    def emit(parts: list[pa.Table]) -> Iterator[pa.RecordBatch]:
        block = pa.concat_tables(parts)
        sure = block.filter(pc.is_null(block.column("bytes")))
        yield from sure.select(names).combine_chunks().to_batches()
        block = block.filter(pc.is_valid(block.column("bytes")))
        if len(block):
            yield pa.RecordBatch.from_arrays(list(map(pa.array, repeats(block))), names)

    for group in whole_groups(batches, "key"):
        held.append(group)
        size += group.nbytes
        if size > BLOCK:
            yield from emit(held)
            held, size = [], 0
    if held:
        yield from emit(held)


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes that stay, and the spans that go."""
    spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        kept, gone, sizes = [], [], []
        rows = zip(batch.column("text"), batch.column("copy").to_pylist(), batch.column("found"))
        for text, copy, found in rows:
            text = text.as_py().encode() if text.is_valid else b""
            sizes.append(len(text))
            if copy:
                runs = [(0, len(text))] if len(text) >= LENGTH else []
            else:
                runs = sorted((x["start"], x["start"] + x["number"] + LENGTH - 1) for x in found.as_py() or ())
            merged: list[list[int]] = []
            for start, end in runs:
                if merged and start <= merged[-1][1]:
                    merged[-1][1] = max(end, merged[-1][1])
                else:
                    merged.append([start, end])
            edges = [0, *(e for run in merged for e in run), len(text)]
            kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2])))
            gone.append([{"start": s, "end": e} for s, e in merged])
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(sizes, pa.int64()), pa.array(kept, pa.binary()), pa.array(gone, spans)],
            ["id", "n_bytes", "kept", "removed"],
        )


def substring_dedup(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", frequent: int = FREQUENT
) -> DataFrame:
    """Per row of ``docs``: id, n_bytes, kept (binary) and removed, the spans (start, end) of
    bytes that went, disjoint and in order."""
    key = row_key(F.col(doc_id), F.col(text))
    docs = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"), key.alias("doc"))
    last = F.lit(2**63 - 1)
    # a text that an earlier document has as a whole needs no search
    hashed = docs.select(
        "doc", F.coalesce("id", last).alias("id"), F.xxhash64("text").alias("a"), F.xxhash64("text", F.lit(1)).alias("b")
    )
    first = hashed.groupBy("a", "b").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    copies = hashed.join(first.where("n > 1"), ["a", "b"]).where("id > first")
    copies = written(copies.select("doc").distinct(), "copies").withColumn("_copy", F.lit(True))
    # three uses of the texts below share one shuffle of them
    dealt = docs.repartition("doc")
    base = dealt.join(copies, "doc", "left").select(
        "id", "doc", "text", F.coalesce("_copy", F.lit(False)).alias("copy")
    )
    rows = base.select("id", "doc", "text", "copy").mapInArrow(
        _anchor_rows, "doc bigint, hash bigint, places binary"
    )
    n = F.sum(F.octet_length("places") / 8).over(Window.partitionBy("hash"))
    again = rows.withColumn("n", n).where("n > 1")
    again = again.groupBy("doc").agg(
        F.collect_set(F.struct("hash", "places", (F.col("n") > frequent).alias("frequent"))).alias("found")
    )
    context = base.join(again, "doc").select(F.coalesce("id", last).alias("id"), "doc", "text", "found")
    context = context.mapInArrow(_contexts, CONTEXT_DDL)
    found = context.repartition("key").sortWithinPartitions("key").mapInArrow(
        _repeat_rows, "doc bigint, start bigint, number bigint"
    )
    found = found.groupBy("doc").agg(F.collect_set(F.struct("start", "number")).alias("found"))
    span = "array<struct<start:bigint,end:bigint>>"
    schema = T.StructType(
        [docs.schema["id"], *T.StructType.fromDDL(f"n_bytes bigint, kept binary, removed {span}")]
    )
    return base.join(found, "doc", "left").select("id", "text", "copy", "found").mapInArrow(_removed, schema)


@query("op9_substrings")
def op9_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("removed").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
