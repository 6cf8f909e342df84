"""Substring dedup by a De Bruijn graph of words: words in a window of 20 that also starts earlier.

Windows of ``window`` words are the edges of a graph, from the node of their first to the node of
their last ``window`` - 1 words; only windows that occur again become edges.

1. *Runs.* Every window has an anchor, the least hash of its 8-word pieces, and equal windows have
   equal anchors. Neighbouring windows with one anchor are a run: a path of edges that travels as
   one row. Runs whose anchor occurs once cannot repeat and never leave their document.
2. *Edges.* Distinct runs are folded before the shuffle; their windows, counted, give the repeated
   edges, each with its earliest place.
3. *Compaction.* A node with one edge in and one edge out joins the two. Edges whose earliest places
   lie side by side in a document form chains there at once; chains are joined to whole paths by
   joins that double the length known (rings are opened at their least chain).
4. *Source coordinates.* Each document's repeats are spans of paths. Spans are cut where any span of
   the path begins or ends, so that all occurrences of a piece have the same windows, and each
   piece is hashed anew from the words at its place in the text. Pieces of equal words are
   repeats of the earliest one; chance collisions of edges drop out here.

Equal texts are searched once, under their least id. Each step ends in a written table, and its
shuffle files go at once. Joins have one row a key on one side, so that a run or a piece of a path
that most documents hold can be split by adaptive execution; counts and minima are combined before
the shuffle. What one task holds whole is one document.

Ids are whole numbers; a null id comes after all others. Edge cases: null and empty texts have no
words; texts of fewer words than a window are never touched; rows of equal id and text are one
document and share their result; texts under one id are in the order of their hash; a very long
text is worked on in pieces, its list of repeats is held by one task. Other columns, whatever
their names, play no part.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evidmap.llm.buckets import map_groups
from evidmap.llm.catalog import query
from evidmap.llm.tables import table
from evidmap.llm.words import hashed_texts, rolled, word_count
from evidmap.runtime import few_rows, new_folder, remove_folder

WINDOW = 20
ANCHOR = 8
PIECE_WORDS = 1 << 20
BLOCK = 64  # of the places of a path: cuts are looked up by block
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


# A place is one whole number, so that minima need no sorting: number of the text, then of the word.
AT_BITS = 31


def _place(number: str, at: str) -> Column:
    return F.shiftleft(number, AT_BITS) + F.col(at)


def _number(place: str) -> Column:
    return F.shiftright(place, AT_BITS)


def numbered(rows: DataFrame) -> DataFrame:
    """Written ``rows`` with ``number``, without gaps, in place of ``sparse``, Spark's increasing id (partition
    above 33 bits for the row in it). The driver holds a count for each partition."""
    part = F.shiftright("sparse", 33).cast("int").alias("part")
    begins, n = [], 0
    for r in rows.groupBy(part).agg(F.count("*").alias("n")).orderBy("part").collect():
        begins.append((r.part, n))
        n += r.n
    if n > 1 << (63 - AT_BITS):
        raise ValueError(f"{n} different texts are more than places can tell apart")
    begins = F.broadcast(few_rows(rows.sparkSession, begins, part=pa.int32(), begin=pa.int64()))
    within = F.col("sparse").bitwiseAND(F.lit((1 << 33) - 1))
    found = rows.withColumn("part", part).join(begins, "part")
    return found.withColumn("number", F.col("begin") + within).drop("sparse", "part", "begin")


class Steps:
    """Written tables of one run, by label. Shuffle files of a step go with it, as nothing reads
    them again; a table goes when no further step reads it."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.paths = spark, {}

    def __call__(self, df: DataFrame, label: str) -> DataFrame:
        conf, path = self.spark.conf, new_folder(self.spark, f"words-{label}")
        before = conf.get(CLEANUP, "false")
        conf.set(CLEANUP, "true")
        try:
            df.write.option("compression", "zstd").parquet(path)
        finally:
            conf.set(CLEANUP, before)
        self.paths.setdefault(label, []).append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def remove(self, *labels: str) -> None:
        for path in (p for label in labels for p in self.paths.pop(label, ())):
            remove_folder(self.spark, path)


# ---- runs of windows with one anchor -------------------------------------------


class Runs:
    """Runs of the windows of some texts: text, first window, number of windows, anchor, and the
    place of the first node in ``nodes``."""

    def __init__(self, counts: list[int], hashes: np.ndarray, window: int) -> None:
        own: list[tuple[np.ndarray, ...]] = []
        nodes, done = [np.zeros(0, np.uint64)], 0
        owners = np.repeat(np.arange(len(counts)), counts)
        begins = np.cumsum([0, *counts])
        for at in range(0, max(len(hashes) - window + 1, 0), PIECE_WORDS):
            piece = hashes[at : at + PIECE_WORDS + window - 1]
            owner = owners[at : at + len(piece)]
            head, number, anchor = self._of_piece(piece, owner, window)
            own.append((owner[head], head + at - begins[owner[head]], number, anchor, head + done))
            nodes.append(rolled(piece, window - 1))
            done += len(nodes[-1])
        columns = zip(*own) if own else [[np.zeros(0, np.int64)]] * 3 + [[nodes[0]], [np.zeros(0, np.int64)]]
        self.owner, self.at, self.n, self.anchor, self.node = (np.concatenate(list(c)) for c in columns)
        self.nodes = np.concatenate(nodes)

    @staticmethod
    def _of_piece(hashes, owner, window):
        size, short = len(hashes) - window + 1, min(ANCHOR, window)
        least = rolled(hashes, short)
        place, seen, wide = np.arange(len(least)), 1, window - short + 1
        while seen < wide:  # the first of the least of ``seen`` pieces; each round twice as many
            shift = min(seen, wide - seen)
            less = least[shift:] < least[:-shift]
            least = np.where(less, least[shift:], least[:-shift])
            place = np.where(less, place[shift:], place[:-shift])
            seen += shift
        whole = owner[:size] == owner[window - 1 :]
        new = whole.copy()
        new[1:] &= ~whole[:-1] | (place[1:] != place[:-1])
        head = np.flatnonzero(new)
        stops = np.append(np.flatnonzero(new | ~whole), size)
        number = stops[np.searchsorted(stops, head, side="right")] - head
        return head, number, least[head]


def _texts(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[tuple[pa.RecordBatch, int, Runs]]:
    for batch in batches:
        for first, counts, hashes in hashed_texts(batch.column("text")):
            yield batch, first, Runs(counts, hashes, window)


def anchors(texts: DataFrame, window: int) -> DataFrame:
    """(number, hash, n): anchors of each text and the number of their places in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, first, runs in _texts(batches, window):
            order = np.lexsort((runs.anchor, runs.owner))
            owner, anchor = runs.owner[order], runs.anchor[order]
            new = np.ones(len(order), bool)
            new[1:] = (owner[1:] != owner[:-1]) | (anchor[1:] != anchor[:-1])
            at = np.flatnonzero(new)
            n = np.diff(np.append(at, len(order)))
            number = batch.column("number").take(pa.array(owner[at] + first))
            yield pa.RecordBatch.from_arrays(
                [number, pa.array(anchor[at].view(np.int64)), pa.array(n)], ["number", "hash", "n"]
            )

    return texts.mapInArrow(run, "number bigint, hash bigint, n bigint")


def repeated_runs(texts: DataFrame, window: int) -> DataFrame:
    """(head, tail, number, at, nodes) of the runs whose anchor is in ``found`` of their text.

    ``nodes``: 64-bit hashes of the nodes on the way, the first of them ``head``, the last ``tail``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, first, runs in _texts(batches, window):
            own = batch.column("found").slice(first, int(runs.owner.max(initial=-1)) + 1)
            # an anchor that repeats does so for all texts
            known = np.unique(own.flatten().to_numpy(zero_copy_only=False).astype(np.int64))
            at = np.flatnonzero(np.isin(runs.anchor.view(np.int64), known))
            sizes, starts = runs.n[at] + 1, runs.node[at]
            ends = np.cumsum(sizes)
            inside = np.arange(sizes.sum()) - np.repeat(ends - sizes, sizes)
            nodes = runs.nodes[np.repeat(starts, sizes) + inside]
            offsets = (np.append(0, ends) * 8).astype(np.int32)
            packed = pa.Array.from_buffers(
                pa.binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(nodes)]
            )
            columns = [
                pa.array(runs.nodes[starts].view(np.int64)),
                pa.array(runs.nodes[starts + sizes - 1].view(np.int64)),
                batch.column("number").take(pa.array(runs.owner[at] + first)),
                pa.array(runs.at[at].astype(np.int32)),
                packed,
            ]
            yield pa.RecordBatch.from_arrays(columns, ["head", "tail", "number", "at", "nodes"])

    return texts.mapInArrow(run, "head bigint, tail bigint, number bigint, at int, nodes binary")


def windows_of(runs: DataFrame) -> DataFrame:
    """(head, tail, j, left, right, place, n): every window of (head, tail, place, n, nodes), an
    edge from node ``left`` to node ``right``, and its place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.array([len(x.as_py()) // 8 - 1 for x in batch.column("nodes")], np.int64)
            nodes = np.frombuffer(b"".join(x.as_py() for x in batch.column("nodes")), np.int64)
            row = np.repeat(np.arange(len(sizes)), sizes)
            j = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            left = np.arange(len(row)) + row  # each row has one node more than windows
            copied = {c: batch.column(c).take(pa.array(row)) for c in ("head", "tail", "n")}
            place = batch.column("place").to_numpy()[row] + j
            yield pa.RecordBatch.from_arrays(
                [copied["head"], copied["tail"], pa.array(j.astype(np.int32)), pa.array(nodes[left]),
                 pa.array(nodes[left + 1]), pa.array(place), copied["n"]],
                ["head", "tail", "j", "left", "right", "place", "n"],
            )

    return runs.select("head", "tail", "place", "n", "nodes").mapInArrow(
        run, "head bigint, tail bigint, j int, left bigint, right bigint, place bigint, n bigint"
    )


# ---- compaction ------------------------------------------------------------------


def _chained(edges: DataFrame) -> DataFrame:
    """``edges`` (left, right, place, before) with ``chain``, the place at which their chain
    begins: edges side by side in their document, each the only way on from the one before."""

    def run(rows: pa.Table) -> pa.Table:
        place = rows.column("place").to_numpy()
        starts = rows.column("before").fill_null(-2).to_numpy() != place - 1
        chain = place[np.flatnonzero(starts)][np.cumsum(starts) - 1]
        return rows.append_column("chain", pa.array(chain)).drop_columns(["number"])

    return map_groups(
        edges.select("left", "right", "place", "before", _number("place").alias("number")),
        "number",
        run,
        "left bigint, right bigint, place bigint, before bigint, chain bigint",
        "place",
    )


def resolved(links: DataFrame, step: Steps) -> DataFrame:
    """(id, root, steps): first chain of the path of every chain, and the edges up to it.

    ``links`` (id, up, steps): the chain before (null: none) and its edges; no two chains have the
    same one before. A round joins every chain with the one it points to, so the way known doubles.
    Chains still open after as many rounds as doublings reach lie on rings.
    """
    links = step(links, "links")
    done: list[DataFrame] = [
        links.where("up IS NULL").select("id", F.col("id").alias("root"), F.lit(0).cast("bigint").alias("steps"))
    ]
    open_ = links.where("up IS NOT NULL").select(
        "id", F.col("up").alias("root"), "steps", F.least("id", "up").alias("least")
    )
    n = open_.count()
    for _ in range(math.ceil(math.log2(n + 1)) + 1 if n else 0):
        ends = reduce(DataFrame.unionByName, done).select(
            F.col("id").alias("root"), F.col("root").alias("to"), F.col("steps").alias("more"),
            F.col("id").alias("far"), F.lit(True).alias("found"),
        )
        ways = open_.select(
            F.col("id").alias("root"), F.col("root").alias("to"), F.col("steps").alias("more"),
            F.col("least").alias("far"), F.lit(False).alias("found"),
        )
        open_ = step(
            open_.join(ends.unionByName(ways), "root").select(
                "id", F.col("to").alias("root"), (F.col("steps") + F.col("more")).alias("steps"),
                F.least("least", "far").alias("least"), "found",
            ),
            "ways",
        )
        done.append(open_.where("found").select("id", "root", "steps"))
        open_ = open_.where("NOT found").drop("found")
        if open_.isEmpty():
            return reduce(DataFrame.unionByName, done)
    if n:
        # rings: the least chain of each becomes its first one
        ring = links.join(open_.select("id", "least"), "id")
        opened = ring.select("id", F.when(F.col("id") != F.col("least"), F.col("up")).alias("up"), "steps")
        done.append(resolved(opened, step))
    return reduce(DataFrame.unionByName, done)


def compacted(edges: DataFrame, step: Steps) -> DataFrame:
    """(left, right, path, offset) of the distinct ``edges`` (left, right, place).

    ``path``: place of the first edge of the longest path without branches through the edge.
    """
    into = edges.groupBy(F.col("right").alias("left")).agg(F.count("*").alias("n"), F.min("place").alias("before"))
    out = edges.groupBy("left").agg(F.count("*").alias("m"))
    inner = into.where("n = 1").join(out.where("m = 1"), "left").select("left", "before")
    chained = step(_chained(edges.join(inner, "left", "left")), "chained")
    chains = chained.where("place = chain").select(F.col("chain").alias("id"), "before")
    # the edge before the first one of a chain is the last one of its own
    last = chained.select(
        F.col("place").alias("before"), F.col("chain").alias("up"), (F.col("place") - F.col("chain") + 1).alias("steps")
    )
    links = chains.join(last, "before", "left").select(
        "id",
        F.when(F.col("up") != F.col("id"), F.col("up")).alias("up"),  # a ring of one chain
        F.coalesce("steps", F.lit(0)).alias("steps"),
    )
    ways = resolved(links, step)
    return (
        chained.withColumnRenamed("chain", "id")
        .join(ways, "id")
        .select("left", "right", F.col("root").alias("path"), (F.col("steps") + F.col("place") - F.col("id")).alias("offset"))
    )


# ---- spans and their pieces ------------------------------------------------------

SPAN = "number bigint, path bigint, offset bigint, at int, n int"


def spans(runs: DataFrame) -> DataFrame:
    """Stretches of one path in one text, from (number, at, windows) of its repeated runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            windows = batch.column("windows")
            row = np.repeat(np.arange(len(batch)), windows.value_lengths().to_numpy(zero_copy_only=False))
            flat = windows.flatten()
            number = batch.column("number").to_numpy()[row]
            at = batch.column("at").to_numpy()[row] + flat.field("j").to_numpy()
            offset = flat.field("offset").to_numpy()
            path = flat.field("path").to_numpy()
            new = np.ones(len(row), bool)
            new[1:] = (
                (number[1:] != number[:-1]) | (at[1:] != at[:-1] + 1) | (offset[1:] != offset[:-1] + 1)
                | (path[1:] != path[:-1])
            )
            head = np.flatnonzero(new)
            n = np.diff(np.append(head, len(row)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(number[head]), pa.array(path[head]), pa.array(offset[head]),
                 pa.array(at[head].astype(np.int32)), pa.array(n.astype(np.int32))],
                ["number", "path", "offset", "at", "n"],
            )

    # a span that reaches over the end of a batch becomes two
    dealt = runs.repartition("number").sortWithinPartitions("number", "at")
    return dealt.select("number", "at", "windows").mapInArrow(run, SPAN)


def pieces(stretches: DataFrame, step: Steps) -> DataFrame:
    """``stretches`` cut wherever one of the same path begins or ends: (number, path, offset, at, n)."""
    end = F.col("offset") + F.col("n")
    block = F.floor(F.col("cut") / BLOCK)
    cuts = stretches.select("path", F.explode(F.array("offset", end)).alias("cut")).distinct()
    cuts = cuts.groupBy("path", block.alias("block")).agg(F.sort_array(F.collect_list("cut")).alias("cuts"))
    cuts = step(cuts, "cuts")
    first, last = F.floor(F.col("offset") / BLOCK), F.floor((end - 1) / BLOCK)
    within = stretches.withColumn("end", end).withColumn("block", F.explode(F.sequence(first, last)))
    low = F.greatest("offset", F.col("block") * BLOCK)
    high = F.least("end", (F.col("block") + 1) * BLOCK)
    within = within.select(
        "number", "path", "block", low.alias("low"), high.alias("high"), (F.col("at") - F.col("offset")).alias("shift")
    )
    inside = F.filter(
        F.coalesce("cuts", F.array().cast("array<bigint>")),
        lambda c: (c > F.col("low")) & (c < F.col("high")),
    )
    bounds = F.concat(F.array("low"), inside, F.array("high"))
    found = within.join(cuts, ["path", "block"], "left").withColumn("bounds", bounds)
    parts = F.transform(
        F.slice("bounds", F.lit(1), F.size("bounds") - 1),
        lambda b, i: F.struct(b.alias("offset"), (F.get("bounds", i + 1) - b).cast("int").alias("n")),
    )
    found = found.select("number", "path", "shift", F.inline(parts))
    return found.select("number", "path", "offset", (F.col("offset") + F.col("shift")).cast("int").alias("at"), "n")


def read_again(texts: DataFrame, window: int) -> DataFrame:
    """Pieces of each text with ``words``, a 128-bit hash of the words at their place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("pieces").value_lengths().to_numpy(zero_copy_only=False)
            flat = batch.column("pieces").flatten()
            at, n = flat.field("at").to_numpy(), flat.field("n").to_numpy()
            digests, done = [], 0
            for text, size in zip(batch.column("text"), sizes):
                words = text.as_py().encode().split()
                for a, m in zip(at[done : done + size].tolist(), n[done : done + size].tolist()):
                    own = b" ".join(words[a : a + m + window - 1])
                    digests.append(hashlib.blake2b(own, digest_size=16).digest())
                done += size
            number = batch.column("number").take(pa.array(np.repeat(np.arange(len(sizes)), sizes)))
            columns = [number, *(flat.field(c) for c in ("path", "offset", "at", "n")), pa.array(digests, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["number", "path", "offset", "at", "n", "words"])

    return texts.select("number", "text", "pieces").mapInArrow(run, SPAN + ", words binary")


def repeats(texts: DataFrame, window: int) -> DataFrame:
    """(number, gone): per text of (number, text) with repeats, the (at, n) of windows that occur
    earlier; a lesser ``number`` is earlier."""
    step = Steps(texts.sparkSession)
    found = step(anchors(texts, window), "anchors")
    # what is written first can be split in the join that follows
    again = step(found.groupBy("hash").agg(F.sum("n").alias("n")).where("n > 1").select("hash"), "again")
    found = found.select("number", "hash").join(again, "hash")
    found = step(found.groupBy("number").agg(F.collect_list("hash").alias("found")), "found")
    step.remove("anchors", "again")
    texts = step(texts.join(found, "number"), "texts")
    step.remove("found")
    runs = step(repeated_runs(texts, window), "runs")
    place = _place("number", "at")
    distinct = runs.groupBy("head", "tail").agg(
        F.min(place).alias("place"), F.count("*").alias("n"), F.first("nodes").alias("nodes")
    )
    distinct = step(distinct, "distinct-runs")
    edges = windows_of(distinct).groupBy("left", "right").agg(F.min("place").alias("place"), F.sum("n").alias("n"))
    edges = step(edges.where("n > 1").select("left", "right", "place"), "edges")
    on_path = windows_of(distinct).select("head", "tail", "j", "left", "right").join(
        compacted(edges, step), ["left", "right"]
    )
    ways = on_path.groupBy("head", "tail").agg(
        F.sort_array(F.collect_list(F.struct("j", "path", "offset"))).alias("windows")
    )
    ways = step(ways, "ways-of-runs")
    step.remove("distinct-runs", "edges", "chained", "links", "ways")
    met = runs.select("head", "tail", "number", "at").join(ways, ["head", "tail"])
    stretches = step(spans(met), "spans")
    step.remove("runs", "ways-of-runs")
    cut = step(pieces(stretches, step), "pieces")
    step.remove("spans", "cuts")
    by_text = cut.groupBy("number").agg(F.collect_list(F.struct("path", "offset", "at", "n")).alias("pieces"))
    read = step(read_again(texts.drop("found").join(by_text, "number"), window), "read")
    step.remove("texts", "pieces")
    of_piece = ["path", "offset", "n", "words"]
    first = read.groupBy(*of_piece).agg(F.min(place).alias("first"), F.count("*").alias("times"))
    first = step(first.where("times > 1").drop("times"), "first")
    later = read.join(first, of_piece).where(place != F.col("first"))
    later = later.groupBy("number").agg(F.collect_list(F.struct("at", "n")).alias("gone"))
    later = step(later, "repeats")
    step.remove("read", "first")
    return later


# ---- documents -------------------------------------------------------------------


REMOVED = "array<struct<start:bigint,end:bigint>>"
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _encoded(batch: pa.RecordBatch) -> Iterator[bytes]:
    return ((text.as_py() or "").encode() for text in batch.column("text"))


def _keys(rows: DataFrame) -> DataFrame:
    """(id, sha, n_words) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(hashlib.sha256(text).digest(), word_count(text)) for text in _encoded(batch)]
            columns = [pa.array([x[k] for x in found], t) for k, t in enumerate((pa.binary(), pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *columns], ["id", "sha", "n_words"])

    schema = T.StructType([rows.schema["id"], *T.StructType.fromDDL("sha binary, n_words bigint")])
    return rows.mapInArrow(run, schema)


def _short(rows: DataFrame, window: int) -> DataFrame:
    """The rows that have fewer words than a window, as they stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, sizes, kept = [], [], []
            for number, text in enumerate(_encoded(batch)):
                # no text of so few words has more of them behind its first ones
                words = text.split(None, window)
                if len(words) < window:
                    at.append(number)
                    sizes.append(len(words))
                    kept.append(b" ".join(words).decode())
            columns = [batch.column("id").take(pa.array(at, pa.int64())), pa.array(sizes, pa.int64())]
            columns += [pa.array(kept, pa.string()), pa.array([[]] * len(at), _SPANS)]
            yield pa.RecordBatch.from_arrays(columns, ["id", "n_words", "kept", "removed"])

    schema = T.StructType([rows.schema["id"], *T.StructType.fromDDL(f"n_words bigint, kept string, removed {REMOVED}")])
    return rows.mapInArrow(run, schema)


def _once_a_task(rows: DataFrame, window: int) -> DataFrame:
    """(sha, text) of the texts of a window or more; of equal ones in a task the first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            at, shas = [], []
            for number, text in enumerate(_encoded(batch)):
                sha = hashlib.sha256(text).digest()
                if sha not in seen and len(text.split(None, window)) >= window:
                    seen.add(sha)
                    at.append(number)
                    shas.append(sha)
            texts = batch.column("text").take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(shas, pa.binary()), texts], ["sha", "text"])

    return rows.select("text").mapInArrow(run, "sha binary, text string")


def _cut_out(rows: DataFrame, window: int) -> DataFrame:
    """(id, rows, n_words, kept, removed) of rows (id, rows, text, gone)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, removed, sizes = [], [], []
            for text, gone in zip(_encoded(batch), batch.column("gone")):
                words = text.split()
                merged: list[list[int]] = []
                for start, end in sorted((g["at"], g["at"] + g["n"] + window - 1) for g in gone.as_py() or ()):
                    if merged and start <= merged[-1][1]:
                        merged[-1][1] = max(end, merged[-1][1])
                    else:
                        merged.append([start, end])
                edges = [0, *(e for span in merged for e in span), len(words)]
                left = [w for a, b in zip(edges[::2], edges[1::2]) for w in words[a:b]] if merged else words
                sizes.append(len(words))
                kept.append(b" ".join(left).decode())
                removed.append([{"start": s, "end": e} for s, e in merged])
            columns = [pa.array(sizes, pa.int64()), pa.array(kept, pa.string()), pa.array(removed, _SPANS)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("rows"), *columns], ["id", "rows", "n_words", "kept", "removed"]
            )

    ddl = f"rows int, n_words bigint, kept string, removed {REMOVED}"
    schema = T.StructType([rows.schema["id"], *T.StructType.fromDDL(ddl)])
    return rows.select("id", "rows", "text", "gone").mapInArrow(run, schema)


def repeated_words(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW
) -> DataFrame:
    """Per row of ``docs``: id, n_words, kept (the words that stay, between single blanks) and
    removed, the spans (start, end) of words that go, disjoint and in order."""
    if window < 2:
        raise ValueError("a window has two words or more")
    step = Steps(docs.sparkSession)
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    # rows of equal id and text are counted as one
    keys = _keys(rows).where(F.col("n_words") >= window)
    keys = step(keys.groupBy("sha", "id").agg(F.first("n_words").alias("n_words"), F.count("*").cast("int").alias("rows")), "keys")
    first = keys.groupBy("sha").agg(F.min("id").alias("first"))
    first = first.repartitionByRange(F.asc_nulls_last("first"), "sha").sortWithinPartitions(
        F.asc_nulls_last("first"), "sha"
    )
    # ids of Spark's rows grow with the partition, then with the place in it
    first = numbered(step(first.withColumn("sparse", F.monotonically_increasing_id()), "numbers"))
    texts = _once_a_task(rows, window).join(first.select("sha", "number"), "sha").dropDuplicates(["sha"])
    texts = step(texts.select("number", "text"), "distinct")
    gone = repeats(texts, window)
    placed = keys.join(first, "sha")
    # one row for each text: its least id
    own = placed.where("id <=> first").select("number", "id", "rows").join(gone, "number", "left")
    searched = _cut_out(texts.join(own, "number"), window)
    whole = F.array(F.struct(F.lit(0).cast("bigint").alias("start"), F.col("n_words").alias("end")))
    copies = placed.where("NOT id <=> first").select(
        "id", "rows", "n_words", F.lit("").alias("kept"), whole.cast(REMOVED).alias("removed")
    )
    every = searched.unionByName(copies).withColumn("row", F.explode(F.sequence(F.lit(1), "rows")))
    return _short(rows, window).unionByName(every.select("id", "n_words", "kept", "removed"))


_SQL = r"""WITH words AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS pos, len(w) AS n
  FROM (SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM documents)),
windows AS (
  SELECT doc_id, pos, n, string_agg(word, ' ') OVER (
    PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING) AS own
  FROM words),
again AS (
  SELECT doc_id, pos, pos AS start FROM (
    SELECT doc_id, pos, row_number() OVER (PARTITION BY own ORDER BY doc_id, pos) AS k
    FROM windows WHERE pos + 20 <= n)
  WHERE k > 1),
marked AS (
  SELECT doc_id, word, pos, coalesce(max(start) OVER (
    PARTITION BY doc_id ORDER BY pos ROWS UNBOUNDED PRECEDING), -20) + 20 > pos AS gone
  FROM words LEFT JOIN again USING (doc_id, pos)),
per_document AS (
  SELECT doc_id, count(*) AS n_words, count(*) FILTER (gone) AS n_removed,
    string_agg(word, ' ' ORDER BY pos) FILTER (NOT gone) AS kept
  FROM marked GROUP BY doc_id)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM documents LEFT JOIN per_document USING (doc_id)"""


@query("op13_repeated_words", _SQL)
def op13_repeated_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeated_words(table(spark, sf_dir, "documents"))
    n_removed = F.aggregate(
        "removed", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"]
    )
    return found.select(
        F.col("id").alias("doc_id"),
        "n_words",
        n_removed.alias("n_removed"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
