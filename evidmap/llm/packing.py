"""Lexical retrieval packing: documents share a window with what a BM25 index finds for them.

Documents are tokenised once into a written table. Token frequencies over all documents
give the weights. Each block of the table (``shard_docs`` documents) is a shard with an
inverted index of its own: the longest unused document is the seed of a window, the index
returns its best unused neighbours, and those that fit are taken in that order; the best
one left is cut to fill the window, and its rest stays in the shard. Texts over a window
first give whole windows. What is left of a shard goes into the next one of the task, and
the last rest into windows of powers of two, so no window needs padding.

Edge cases: a null or empty text has the end token alone; rows of equal id are documents
of their own; an empty table gives no pieces; ids may be null.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evidmap.llm.bpe import BLANK, KIND, LETTER, LONGEST, OTHER, Merges
from evidmap.llm.catalog import query
from evidmap.llm.tables import released, table, written

WINDOW = 2048
END = 1
SHARD_DOCS = 512
SHARD_TOKENS = 1 << 20
K1, B = 1.2, 0.75
PIECE = 1 << 20
GROUP = 1 << 21  # characters of the texts whose words are looked up together

# Controls, which are no plain text; and the start of a special token.
CONTROLS = bytes([*range(9), *range(14, 32), 127])
SPECIAL = "<|"
MARK = "\x01"  # between words that are encoded together; no plain text holds it
# Of each sign of Latin-1: its small letter, and what kind of run it stands in. Zero ends a text.
SMALL = np.array([ord(chr(b).lower()) for b in range(256)], np.uint8)
STOP = 4
RUN_KIND = np.append(np.uint8(STOP), KIND[1:])
SMALL[KIND == BLANK] = ord(" ")


def is_plain(text: str) -> bool:
    """Latin-1 without controls or special tokens."""
    try:
        data = text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return SPECIAL not in text and len(data.translate(None, CONTROLS)) == len(data)


@lru_cache(1)
def rank_table(path: str) -> Merges:
    """Read once by a worker, however many tasks it has."""
    return Merges(path)


class WordTokens:
    """Ids of texts, with the ids of each run of signs kept.

    The tokenizer drops white space and encodes nothing across it, nor across letters, digits
    and other signs, so a run of one kind has the same ids everywhere. Runs are found, told apart
    and looked up as arrays, for many texts together. Those not seen before are merged together,
    from the rank table of the tokenizer's file; words with an apostrophe (one run as a whole) and
    very long runs are encoded by the tokenizer itself. So are texts outside Latin-1 (where small
    letters may depend on neighbours), and those that might hold a special token.
    """

    MOST_WORDS = 500_000  # the table begins anew beyond this, with the runs of the texts at hand
    MOST_IDS = 1 << 23
    TOGETHER = 500

    def __init__(self, path: str, merges: Merges | None = None) -> None:
        self.path = path
        self.merges = merges or rank_table(path)
        self._begin()

    def _begin(self) -> None:
        self.runs = pa.array([b"\0", b" "], pa.binary())
        self.ids = np.array([END], "<u4")
        self.ends = np.array([1, 1], np.int32)  # of the ids of each run

    @cached_property
    def tokenizer(self):
        """Loaded for the first text or word that needs it."""
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    @cached_property
    def mark(self) -> int:
        (mark,) = self._encode(MARK)
        return mark

    def _encode(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _learn(self, runs: pa.Array, sizes: np.ndarray, ids: np.ndarray) -> None:
        self.runs = pa.concat_arrays([self.runs, runs])
        self.ends = np.append(self.ends, self.ends[-1] + np.cumsum(sizes, dtype=np.int32))
        self.ids = np.append(self.ids, ids.astype("<u4"))

    def _by_tokenizer(self, runs: pa.Array) -> None:
        between = f" {MARK} "
        for at in range(0, len(runs), self.TOGETHER):
            part = runs.slice(at, self.TOGETHER)
            ids = np.array(self._encode(between.join(r.decode("latin-1") for r in part.to_pylist())), "<u4")
            cuts = np.flatnonzero(ids == self.mark)
            sizes = np.diff(np.concatenate([[-1], cuts, [len(ids)]])) - 1
            self._learn(part, sizes, np.delete(ids, cuts))

    def places(self, runs: pa.Array) -> np.ndarray:
        """The place of each of some different runs in the table, which learns those it has not."""
        at = pc.index_in(runs, value_set=self.runs)
        full = len(self.runs) + at.null_count > self.MOST_WORDS or len(self.ids) > self.MOST_IDS
        if full and len(self.runs) > 2:
            self._begin()
            at = pc.index_in(runs, value_set=self.runs)
        missing = np.flatnonzero(at.is_null().to_numpy(zero_copy_only=False))
        found = at.fill_null(0).to_numpy().copy()
        if not len(missing):
            return found
        new = runs.take(pa.array(missing))
        by_library = pc.or_(pc.match_substring(new, "'"), pc.greater(pc.binary_length(new), LONGEST))
        by_library = by_library.to_numpy(zero_copy_only=False)
        found[missing[~by_library]] = len(self.runs) + np.arange(len(missing) - by_library.sum())
        plain = new.filter(pa.array(~by_library))
        if len(plain):
            starts, data = spans_of(plain)
            ids, sizes = self.merges.encode_runs(data, starts[:-1])
            self._learn(plain, sizes, ids)
        found[missing[by_library]] = len(self.runs) + np.arange(by_library.sum())
        self._by_tokenizer(new.filter(pa.array(by_library)))
        return found

    def _plain(self, texts: list[str]) -> list[bytes]:
        data = SMALL[np.frombuffer("".join(f"{t}\0" for t in texts).encode("latin-1"), np.uint8)]
        kind = RUN_KIND[data]
        new = np.append(True, (kind[1:] != kind[:-1]) | (kind[1:] != LETTER) & (kind[1:] != OTHER))
        quote = np.flatnonzero(data == ord("'"))
        if len(quote):
            gap = (kind == BLANK) | (kind == STOP)
            word = np.cumsum(gap, dtype=np.int32)
            quoted = np.zeros(int(word[-1]) + 1, bool)
            quoted[word[quote]] = True
            new &= gap | ~quoted[word] | np.append(True, gap[:-1])
        start = np.flatnonzero(new).astype(np.int32)
        cuts = [None, pa.py_buffer(np.append(start, np.int32(len(data)))), pa.py_buffer(data)]
        runs = pa.Array.from_buffers(pa.binary(), len(start), cuts).dictionary_encode()
        place = self.places(runs.dictionary)[runs.indices.to_numpy()]
        begin = np.append(np.int32(0), self.ends[:-1])[place]
        sizes = self.ends[place] - begin
        ends = np.cumsum(sizes, dtype=np.int32)
        begin -= ends - sizes
        at = np.repeat(begin, sizes)
        at += np.arange(len(at), dtype=np.int32)
        ids = self.ids[at].tobytes()
        stops = (np.append(0, ends[data[start] == 0].astype(np.int64)) * 4).tolist()
        return [ids[a:b] for a, b in zip(stops, stops[1:])]

    def texts(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text, then the end token."""
        end = np.array([END], "<u4").tobytes()
        plain = [is_plain(text) for text in texts]
        short = [text for text, own in zip(texts, plain) if own and len(text) <= GROUP]
        known = iter(self._plain(short) if short else [])
        found = []
        for text, own in zip(texts, plain):
            if own and len(text) <= GROUP:
                found.append(next(known))
            elif own:
                found.append(b"".join(self._plain([p])[0][: -len(end)] for p in pieces(text)) + end)
            else:
                found.append(b"".join(np.array(self._encode(p), "<u4").tobytes() for p in pieces(text)) + end)
        return found


def spans_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Where each value begins (and the last ends) in the bytes of a column, and these bytes; no copy."""
    _, ends, data = column.buffers()
    if not len(column):
        return np.zeros(1, np.int32), np.zeros(0, np.uint8)
    ends = np.frombuffer(ends, np.int32)[column.offset : column.offset + len(column) + 1]
    return ends, np.frombuffer(data or b"", np.uint8, count=int(ends[-1]))


def pieces(text: str, size: int = PIECE) -> Iterator[str]:
    """A text in pieces of about ``size``, cut at spaces, which no token reaches over."""
    at = 0
    while len(text) - at > size:
        space = max(text.rfind(s, at, at + size) for s in " \n")
        if space <= at:
            size *= 2
            continue
        yield text[at:space]
        at = space
    yield text[at:]


def grouped(texts: pa.Array, size: int = GROUP) -> Iterator[list[str]]:
    """Texts (null: empty), some of them at a time."""
    held, length = [], 0
    for text in texts:
        held.append(text.as_py() or "")
        length += len(held[-1])
        if length >= size:
            yield held
            held, length = [], 0
    if held:
        yield held


def tokenized(docs: DataFrame, doc_id: str, text: str, tokenizer: str) -> DataFrame:
    """(id, ids) with ids as little-endian 32-bit numbers."""
    docs = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    kind = docs.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = WordTokens(tokenizer)
        for batch in released(batches):
            first = 0
            for some in grouped(batch.column("text")):
                ids = pa.array(tokens.texts(some), pa.binary())
                own = batch.column("id").slice(first, len(some))
                yield pa.RecordBatch.from_arrays([own, ids], ["id", "ids"])
                first += len(some)

    return docs.mapInArrow(run, f"id {kind}, ids binary")


def documents_of(column: pa.Array) -> Iterator[np.ndarray]:
    """The ids of each document, without a copy."""
    ends, data = spans_of(column)
    ids, ends = data.view("<u4"), ends // 4
    for start, end in zip(ends[:-1].tolist(), ends[1:].tolist()):
        yield ids[start:end]


def term_counts(tokens: DataFrame) -> tuple[dict[int, int], int, int]:
    """Documents per token id (no more rows than the vocabulary), documents, tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, here, docs, total = np.zeros(1, np.int64), np.zeros(1, bool), 0, 0
        for batch in released(batches):
            for ids in documents_of(batch.column("ids")):
                most = int(ids.max())
                if most >= len(seen):
                    more = most + 1 - len(seen)
                    seen, here = np.append(seen, np.zeros(more, np.int64)), np.append(here, np.zeros(more, bool))
                here[ids] = True
                own = np.flatnonzero(here)
                seen[own] += 1
                here[own] = False
                docs += 1
                total += len(ids)
        terms = np.flatnonzero(seen)
        yield from pa.table(
            {"term": np.append(terms, [-1, -2]), "n": np.append(seen[terms], [docs, total])}
        ).to_batches()

    sums = tokens.select("ids").mapInArrow(run, "term bigint, n bigint")
    sums = sums.groupBy("term").agg(F.sum("n").alias("n"))
    found = {row.term: row.n for row in sums.collect()}
    return {t: n for t, n in found.items() if t >= 0}, found.get(-1, 0), found.get(-2, 0)


class Shard:
    """Inverted index over the tails of some documents."""

    def __init__(self, tails: list[np.ndarray], weight: np.ndarray, mean_length: float) -> None:
        lengths = np.array([len(t) for t in tails])
        # the terms of all documents are counted by one sort, by document and term
        keys = np.repeat(np.arange(len(tails), dtype=np.int64) << 32, lengths)
        keys |= np.concatenate(tails)
        keys.sort()
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        counts = np.diff(np.append(first, len(keys)))
        keys = keys[first]
        docs, terms = keys >> 32, keys & 0xFFFFFFFF
        heavy = weight[terms] > 0  # the others add nothing to any score
        docs, terms, counts = docs[heavy], terms[heavy], counts[heavy]
        cuts = np.searchsorted(docs, np.arange(1, len(tails)))
        self.n, self.weight, self.own = len(tails), weight, np.split(terms, cuts)
        # 16 bits are sorted by counting
        order = np.argsort(terms.astype(np.uint16) if len(weight) <= 1 << 16 else terms, kind="stable")
        norm = K1 * (1 - B + B * lengths / mean_length)
        self.docs, self.terms = docs[order], terms[order]
        tf = counts[order]
        self.scores = weight[self.terms] * tf * (K1 + 1) / (tf + norm[self.docs])

    def neighbours(self, seed: int) -> np.ndarray:
        """BM25 score of every document for the words of ``seed``."""
        left = np.searchsorted(self.terms, self.own[seed], "left")
        sizes = np.searchsorted(self.terms, self.own[seed], "right") - left
        starts = np.cumsum(sizes) - sizes
        at = np.repeat(left - starts, sizes) + np.arange(sizes.sum())
        return np.bincount(self.docs[at], self.scores[at], self.n)


def powers_of_two(n: int) -> list[int]:
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


Piece = tuple[int, int, int]  # document, start, length


def pack_shard(
    spans: list[tuple[int, int]], index: Shard, window: int
) -> tuple[list[list[Piece]], list[Piece]]:
    """Full windows of pieces, and the pieces left over, together less than a window.

    ``spans``: start and end of what there is to pack of each document.
    """
    start = np.array([s for s, _ in spans])
    left = np.array([e - s for s, e in spans])
    windows = []
    while left.sum() >= window:
        seed = int(np.argmax(left))
        row = [(seed, int(start[seed]), int(left[seed]))]
        space, left[seed] = window - int(left[seed]), 0
        if space:
            order = np.argsort(-index.neighbours(seed), kind="stable")
            order = order[left[order] > 0]
            while space:
                fits = np.flatnonzero((left[order] <= space) & (left[order] > 0))
                if len(fits):
                    doc, size = int(order[fits[0]]), int(left[order[fits[0]]])
                else:  # cut the best one left
                    doc, size = int(order[np.argmax(left[order] > 0)]), space
                row.append((doc, int(start[doc]), size))
                start[doc] += size
                left[doc] -= size
                space -= size
        windows.append(row)
    rest = [(int(d), int(start[d]), int(left[d])) for d in np.flatnonzero(left)]
    return windows, rest


def cut_up(pieces: list[Piece], sizes: list[int]) -> list[list[Piece]]:
    """The pieces one after the other, cut to sequences of the given sizes."""
    rows, pieces = [], list(pieces)
    for size in sizes:
        row = []
        while size:
            doc, start, length = pieces.pop(0)
            take = min(size, length)
            row.append((doc, start, take))
            if take < length:
                pieces.insert(0, (doc, start + take, length - take))
            size -= take
        rows.append(row)
    return rows


def pack(
    docs: DataFrame,
    tokenizer: str,
    doc_id: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    shard_docs: int = SHARD_DOCS,
    shard_tokens: int = SHARD_TOKENS,
) -> DataFrame:
    """Pieces: id, start, length, ids (binary, 32 bits each), doc_tokens, sequence_id, offset.

    A shard ends at ``shard_docs`` documents or ``shard_tokens`` tokens.
    """
    tokens = written(tokenized(docs, doc_id, text, tokenizer), "tokens")
    counts, n, total = term_counts(tokens)
    weight = np.zeros(max(counts, default=0) + 1)
    for term, seen in counts.items():
        weight[term] = max(0.0, np.log((n - seen + 0.5) / (seen + 0.5)))
    mean_length = max(total / max(n, 1), 1.0)
    kind = tokens.schema["id"].dataType.simpleString()
    names = ["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        made = 0
        # documents at hand: (id, ids, from where they are still to be packed, to where)
        held: list[tuple] = []
        out: list[tuple] = []

        def emit(rows: list[list[Piece]]) -> None:
            nonlocal made
            for row in rows:
                offset = 0
                for doc, start, length in row:
                    key, ids, _, _ = held[doc]
                    out.append(
                        (key, start, length, ids[start : start + length].tobytes(), len(ids), first + made, offset)
                    )
                    offset += length
                made += 1

        def pack_held() -> None:
            nonlocal held
            index = Shard([ids[s:e] for _, ids, s, e in held], weight, mean_length)
            rows, rest = pack_shard([(s, e) for _, _, s, e in held], index, window)
            emit(rows)
            held = [(held[d][0], held[d][1], s, s + n) for d, s, n in rest]

        def drained() -> Iterator[pa.RecordBatch]:
            if out:
                columns = list(zip(*out))
                ids = pa.array(columns[0], batch_type)
                yield pa.RecordBatch.from_arrays([ids, *map(pa.array, columns[1:])], names)
                out.clear()

        batch_type = None
        fresh = waiting = 0
        for batch in released(batches):
            batch_type = batch.schema.field("id").type
            for key, ids in zip(batch.column("id"), batch.column("ids")):
                ids = np.frombuffer(ids.as_py(), "<u4")
                whole = len(ids) // window * window
                held.append((key.as_py(), ids, whole, len(ids)))
                emit([[(len(held) - 1, s, window)] for s in range(0, whole, window)])
                if whole == len(ids):
                    held.pop()
                fresh += 1
                waiting += len(ids)
                if fresh >= shard_docs or waiting >= shard_tokens:
                    fresh = waiting = 0
                    if held:
                        pack_held()
                    yield from drained()
        if held:
            pack_held()
            rest = [(d, s, e - s) for d, (_, _, s, e) in enumerate(held)]
            emit(cut_up(rest, powers_of_two(sum(n for _, _, n in rest))))
        yield from drained()

    schema = (
        f"id {kind}, start bigint, length bigint, ids binary, doc_tokens bigint, "
        "sequence_id bigint, offset bigint"
    )
    return tokens.mapInArrow(run, schema)


def public_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query("op5_packing")
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(table(spark, sf_dir, "documents"), public_tokenizer())
    return pieces.select(
        F.col("id").alias("doc_id"),
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )
