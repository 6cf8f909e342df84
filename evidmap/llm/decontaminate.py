"""Benchmark decontamination by winnowing, in DataFrame operations only.

A span is a *window* of an item: 13 consecutive words, or the whole of a shorter
item. Per window length n the method hashes k-grams (k = n // 2, and n itself for
n < 8) and keeps the least one of every n - k + 1 neighbours. Whatever two texts
share a window also share its least k-gram, so the join of both sides' kept
k-grams misses no window. Each hit is then extended word by word, over hashes of
64 bits, and counts when the shared run holds a whole window.

Edge cases: null or wordless texts have no words and no hits; null items never
match; repeated item texts are searched once and reported under each of their
ids; rows with the same id and text share their hits; ids may be null.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from evidmap.llm.catalog import query
from evidmap.llm.tables import row_key, rows_fit, table, written

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 13
# Test hashes and keys of documents are broadcast up to this many: some 50 MB.
# Beyond, they meet the corpus in a shuffle.
MAX_BROADCAST_ROWS = 1_000_000
# A fingerprint is 32 bits of hash over 32 bits of position: its order is the hash's.
POSITION_BITS = 32


def word_hashes(text: Column) -> Column:
    """64-bit hash of every word; ASCII capitals count as small."""
    words = F.regexp_extract_all(F.translate(text, UPPER, UPPER.lower()), F.lit(WORD), F.lit(0))
    return F.coalesce(F.transform(words, lambda w: F.xxhash64(w)), F.array().cast("array<bigint>"))


def gram_size(window: int) -> int:
    return window if window < 8 else window // 2


def _drop_first(values: Column, n: int) -> Column:
    return F.slice(values, F.lit(n + 1), F.greatest(F.size(values) - n, F.lit(0)))


def _drop_last(values: Column, n: int) -> Column:
    return F.slice(values, F.lit(1), F.greatest(F.size(values) - n, F.lit(0)))


def _runs(df: DataFrame, source: str, target: str, length: int, join) -> DataFrame:
    """Column ``target``: ``join`` of every ``length`` neighbours of array ``source``.

    Built by doubling, so each value is touched a logarithmic number of times.
    """
    df, have = df.withColumn(target, F.col(source)), 1
    while have < length:
        step = min(have, length - have)
        df = df.withColumn(
            target,
            F.zip_with(_drop_last(F.col(target), step), _drop_first(F.col(target), step), join),
        )
        have += step
    return df


def fingerprints(df: DataFrame, words: str, window: int) -> DataFrame:
    """``df`` with ``kept``: the winnowed k-grams, hash above, place (from 0) below."""
    k = gram_size(window)
    df = _runs(df, words, "_gram", k, lambda a, b: F.xxhash64(a, b))
    placed = F.transform(
        "_gram",
        lambda h, i: F.shiftleft(h, POSITION_BITS).bitwiseOR(i.cast("bigint")),
    )
    df = _runs(df.withColumn("_placed", placed), "_placed", "_least", window - k + 1, lambda a, b: F.least(a, b))
    return df.withColumn("kept", F.array_distinct("_least")).drop("_gram", "_placed", "_least")


def _hash_of(kept: Column) -> Column:
    return F.shiftright(kept, POSITION_BITS).cast("int")


def _place_of(kept: Column) -> Column:
    return kept.bitwiseAND(F.lit(2**POSITION_BITS - 1)).cast("int")


def _equal_from_start(a: Column, b: Column) -> Column:
    """Number of leading elements that arrays ``a`` and ``b`` share."""
    first = F.array_position(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), False)
    return F.when(first == 0, F.size(a)).otherwise(first - 1).cast("int")


def _contexts(words: str, window: int) -> Column:
    """Per place in array ``places``: words before it backwards, words from it on; as far
    as a window that holds its k-gram can reach."""
    reach = window - gram_size(window)

    def around(place: Column) -> Column:
        before = F.slice(
            words, F.greatest(place - reach, F.lit(0)) + 1, F.least(place, F.lit(reach))
        )
        return F.struct(
            place.alias("place"),
            F.reverse(before).alias("before"),
            F.slice(words, place + 1, F.lit(window)).alias("after"),
        )

    return F.transform("places", around)


def _with_hash(met: DataFrame, window: int) -> DataFrame:
    """Column ``hash`` of the k-gram at the start of ``after``."""
    k = gram_size(window)
    met = met.withColumn("_first", F.slice("after", 1, k))
    met = _runs(met, "_first", "_gram", k, lambda a, b: F.xxhash64(a, b))
    return met.withColumn("hash", _hash_of(F.shiftleft(F.col("_gram")[0], POSITION_BITS))).drop("_first", "_gram")


def window_hits(
    docs: DataFrame, items: DataFrame, window: int, whole: bool
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows (doc, context, start, end): words ``start`` to ``end`` - 1 of a document that
    share at least one window with the items of ``context``; rows (context, item); and
    rows (doc, n_words) of all documents.

    ``docs`` has doc and text; ``items`` has item and words, of which only those
    of exactly ``window`` words are taken when ``whole``, else those of at least as many.
    """
    n = F.size("words")
    tests = fingerprints(items.where(n == window if whole else n >= window), "words", window)
    tests = tests.withColumn("places", F.transform("kept", _place_of))
    tests = tests.select("item", F.explode_outer(_contexts("words", window)).alias("m"))
    tests = _with_hash(tests.select("item", "m.before", "m.after"), window)
    # items often share text: what looks the same around a k-gram is searched once
    tests = tests.withColumn("context", F.xxhash64("hash", "before", "after"))
    tests = written(tests, "test-fingerprints")
    contexts = tests.select("hash", "context", "before", "after").distinct()
    found = tests.select("hash").distinct()
    if rows_fit(found, MAX_BROADCAST_ROWS):
        found = F.broadcast(found)
    # explode_outer: for explode the optimizer adds a filter that computes the array once more
    words = docs.select("doc", word_hashes(F.col("text")).alias("words"))
    kept = fingerprints(words, "words", window)
    # the leading null keeps a row of every document, with its number of words
    kept = kept.select(
        "doc",
        n.cast("bigint").alias("n_words"),
        F.explode_outer(F.concat(F.array(F.lit(None).cast("bigint")), "kept")).alias("kept"),
    )
    places = (
        kept.select(
            "doc",
            "n_words",
            _hash_of(F.col("kept")).alias("hash"),
            _place_of(F.col("kept")).alias("place"),
        )
        .join(found.withColumn("met", F.lit(True)), "hash", "left")
        .where("met OR place IS NULL")
        .groupBy("doc")
        .agg(F.max("n_words").alias("n_words"), F.collect_set("place").alias("places"))
    )
    every = written(places, "places")
    places = every.where(F.size("places") > 0).select("doc", "places")
    # texts are needed again only where a fingerprint was met
    met = docs
    if rows_fit(places, MAX_BROADCAST_ROWS):
        met = docs.join(F.broadcast(places.select("doc")), "doc", "left_semi")
    met = met.dropDuplicates(["doc"]).join(places, "doc")
    met = met.select("doc", "places", word_hashes(F.col("text")).alias("words"))
    met = met.select("doc", F.explode_outer(_contexts("words", window)).alias("m")).select("doc", "m.*")
    met = _with_hash(met, window)
    theirs = contexts.select(
        "hash", "context", F.col("before").alias("its_before"), F.col("after").alias("its_after")
    )
    hits = met.join(theirs, "hash").select(
        "doc",
        "context",
        "place",
        _equal_from_start(F.col("before"), F.col("its_before")).alias("left"),
        _equal_from_start(F.col("after"), F.col("its_after")).alias("right"),
    )
    hits = hits.where((F.col("left") + F.col("right") >= window) & (F.col("right") > 0)).select(
        "doc",
        "context",
        (F.col("place") - F.col("left")).alias("start"),
        (F.col("place") + F.col("right")).alias("end"),
    )
    return hits, tests.select("context", "item").distinct(), every.select("doc", "n_words")


def merged_spans(runs: DataFrame) -> DataFrame:
    """(doc, start, end) -> per doc n_hit and disjoint ``spans`` in order."""
    order = Window.partitionBy("doc").orderBy("start", "end")
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.withColumn("new", F.coalesce((F.col("start") > before).cast("int"), F.lit(1)))
    runs = runs.withColumn("run", F.sum("new").over(order))
    runs = runs.groupBy("doc", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return runs.groupBy("doc").agg(
        F.sum((F.col("end") - F.col("start")).cast("bigint")).alias("n_hit"),
        F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"),
    )


def contamination(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """One row per row of ``docs``: id, doc (key of the row), n_words, n_hit, n_items,
    item_ids, spans.

    ``spans``: disjoint (start, end) of the hit words, in order, end exclusive.
    Other columns of ``docs`` are not read.
    """
    docs = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    docs = docs.withColumn("doc", row_key(F.col("id"), F.col("text")))
    ids = items.where(F.col(item_id).isNotNull()).select(
        F.col(item_id).cast("string").alias("item_id"), word_hashes(F.col(item_text)).alias("words")
    )
    ids = written(
        ids.where(F.size("words") > 0).withColumn("item", F.xxhash64("words")), "items"
    )
    texts = ids.select("item", "words").dropDuplicates(["item"])
    short = ids.where(F.size("words") < window).select(F.size("words").alias("n")).distinct()
    sizes = [(row.n, True) for row in short.collect()] + [(window, False)]  # at most 13
    searched = docs.select("doc", "text")
    found = [window_hits(searched, texts, n, whole) for n, whole in sizes]
    hits = written(reduce(DataFrame.unionByName, [h for h, _, _ in found]), "hits")
    members = reduce(DataFrame.unionByName, [m for _, m, _ in found])
    spans = merged_spans(hits.select("doc", "start", "end").distinct())
    names = (
        hits.select("doc", "context").distinct().join(members, "context")
        .select("doc", "item").distinct()
        .join(ids.select("item", "item_id").distinct(), "item")
        .groupBy("doc").agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"))
    )
    counted = docs.select("id", "doc").join(found[-1][2], "doc")
    none = F.lit(0).cast("bigint")
    return (
        counted.join(spans.join(names, "doc"), "doc", "left")
        .withColumn("item_ids", F.coalesce("item_ids", F.array().cast("array<string>")))
        .select(
            "id",
            "doc",
            "n_words",
            F.coalesce("n_hit", none).alias("n_hit"),
            F.size("item_ids").cast("bigint").alias("n_items"),
            "item_ids",
            F.coalesce("spans", F.array().cast("array<struct<start:int,end:int>>")).alias("spans"),
        )
    )


def is_contaminated() -> Column:
    """The rule of the contract: at least a twentieth of the words are hit."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


ORACLE = r"""
WITH d AS (
    SELECT row_number() OVER () AS rid, doc_id,
        coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
    FROM documents
), i AS (
    SELECT item_id,
        regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark WHERE text IS NOT NULL
), windows AS (
    SELECT DISTINCT item_id, least(len(w), 13) AS n,
        array_to_string(w[p : p + least(len(w), 13) - 1], ' ') AS s
    FROM (SELECT item_id, w, unnest(generate_series(1, greatest(1, len(w) - 12))) AS p
          FROM i WHERE len(w) > 0)
), hits AS (
    SELECT g.rid, g.p, g.n, windows.item_id
    FROM (
        SELECT rid, p, n, array_to_string(w[p : p + n - 1], ' ') AS s
        FROM (SELECT rid, w, n, unnest(generate_series(1, len(w) - n + 1)) AS p
              FROM d, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)
    ) g JOIN windows USING (n, s)
), hit AS (
    SELECT rid, count(DISTINCT q) AS n_hit
    FROM (SELECT rid, unnest(generate_series(p, p + n - 1)) AS q FROM hits) GROUP BY rid
), named AS (
    SELECT rid, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids
    FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS x FROM hits) GROUP BY rid
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
    coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (rid) LEFT JOIN named USING (rid)
"""


@query("op2_decontaminate", ORACLE)
def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("id").alias("doc_id"),
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        is_contaminated().alias("contaminated"),
    )


def decontaminated(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``docs`` without its contaminated rows; the columns of ``docs``."""
    bad = contamination(docs, items, doc_id, text).where(is_contaminated())
    key = row_key(F.col(doc_id), F.col(text))
    bad = bad.select(F.col("doc").alias("_contaminated")).distinct()
    return docs.join(bad, key == F.col("_contaminated"), "left_anti")
