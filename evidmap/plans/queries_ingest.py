"""Catalogue: writes, bookkeeping, incremental ingest (S4-S14) and jobs (B1, B2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from evidmap.functions.files import file_name_of, file_number_of
from evidmap.operators import evidence, extract, ingest
from evidmap.operators.graph import graph_links
from evidmap.plans import jobs, refresh, registry
from evidmap.plans.catalog import query
from evidmap.plans.oracle import with_tables
from evidmap.plans.queries_evidence import PUBLICATION_TRENDS
from evidmap.plans.queries_evidence import a1
from evidmap.runtime import new_folder
from evidmap.sources import testdata
from evidmap.sources.landing import scan_articles
from evidmap.sources.store import Store
from evidmap.streaming.incremental import ingest_new_files

# ---- manifest: a file per supplier, its records are the supplier's order lines ----

_MANIFEST = """
manifest AS (
  SELECT printf('pubmed26n%04d.xml.gz', s_suppkey) AS file_name, md5(s_name) AS md5_checksum,
    CAST(s_nationkey AS BIGINT) AS record_count, TIMESTAMP '2024-01-01 00:00:00' AS ingest_ts
  FROM supplier WHERE s_acctbal > 2000),
files AS (
  SELECT printf('pubmed26n%04d.xml.gz', l_suppkey) AS file_name,
    md5(CAST(l_suppkey AS VARCHAR)) AS md5_checksum, count(*) AS record_count,
    max(CAST(l_shipdate AS TIMESTAMP)) AS ingest_ts
  FROM lineitem GROUP BY l_suppkey)"""


def _manifest(spark, folder):
    suppliers = testdata.table(spark, folder, "supplier").where("s_acctbal > 2000")
    return suppliers.select(
        file_name_of(F.col("s_suppkey")).alias("file_name"),
        F.md5("s_name").alias("md5_checksum"),
        F.col("s_nationkey").cast("bigint").alias("record_count"),
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("ingest_ts"),
    )


def _files(spark, folder):
    lines = testdata.table(spark, folder, "lineitem")
    counted = lines.groupBy("l_suppkey").agg(
        F.count("*").alias("record_count"),
        F.max(F.col("l_shipdate").cast("timestamp")).alias("ingest_ts"),
    )
    return counted.select(
        file_name_of(F.col("l_suppkey")).alias("file_name"),
        F.md5(F.col("l_suppkey").cast("string")).alias("md5_checksum"),
        "record_count",
        "ingest_ts",
    )


def _text_time(df, column):
    return df.withColumn(column, F.date_format(column, "yyyy-MM-dd HH:mm:ss"))


@query(
    "s4_manifest_write",
    f"""WITH {_MANIFEST}
SELECT coalesce(m.file_name, f.file_name) AS file_name,
  coalesce(m.md5_checksum, f.md5_checksum) AS md5_checksum,
  coalesce(f.record_count, m.record_count) AS record_count,
  strftime(coalesce(m.ingest_ts, f.ingest_ts), '%Y-%m-%d %H:%M:%S') AS ingest_ts
FROM manifest m FULL JOIN files f ON m.file_name = f.file_name""",
)
def s4(spark, folder):
    written = ingest.upsert_manifest(_manifest(spark, folder), _files(spark, folder))
    return _text_time(written, "ingest_ts")


@query(
    "s4_manifest_log",
    """SELECT printf('pubmed26n%04d.xml.gz', l_suppkey) AS file_name,
  first(md5(CAST(l_partkey AS VARCHAR)) ORDER BY ts) AS md5_checksum,
  last(l_orderkey ORDER BY ts) AS record_count,
  strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS ingest_ts
FROM (SELECT l_suppkey, CAST(l_shipdate AS TIMESTAMP) + to_seconds(l_orderkey % 86400) AS ts,
    max(l_partkey) AS l_partkey, max(l_orderkey) AS l_orderkey FROM lineitem GROUP BY 1, 2)
GROUP BY l_suppkey""",
)
def s4_log(spark, folder):
    """The manifest as the sum of its writes: each order line writes its supplier's file."""
    moment = F.timestamp_seconds(
        F.unix_timestamp(F.col("l_shipdate").cast("timestamp")) + F.col("l_orderkey") % 86400
    )
    # one write per file and moment, so that the writes have an order
    writes = (
        testdata.table(spark, folder, "lineitem")
        .groupBy("l_suppkey", moment.alias("ingest_ts"))
        .agg(F.max("l_partkey").alias("l_partkey"), F.max("l_orderkey").alias("record_count"))
    )
    changes = writes.select(
        file_name_of(F.col("l_suppkey")).alias("file_name"),
        F.md5(F.col("l_partkey").cast("string")).alias("md5_checksum"),
        "record_count",
        "ingest_ts",
    )
    return _text_time(ingest.current_manifest(changes), "ingest_ts")


@query(
    "s5_files_to_ingest",
    f"""WITH {_MANIFEST}
SELECT file_name, record_count FROM files
WHERE file_name NOT IN (SELECT file_name FROM manifest)""",
)
def s5(spark, folder):
    pending = ingest.files_to_ingest(_files(spark, folder), _manifest(spark, folder))
    return pending.select("file_name", "record_count")


# ---- articles: every order line is a copy of its order's article ------------------


@query(
    "s6_new_articles",
    """SELECT pubmed_id, title, source_file FROM (
  SELECT CAST(l_orderkey AS VARCHAR) AS pubmed_id, p_name AS title,
    printf('pubmed26n%04d.xml.gz', 1200 + l_suppkey) AS source_file,
    row_number() OVER (PARTITION BY l_orderkey
      ORDER BY printf('pubmed26n%04d.xml.gz', 1200 + l_suppkey), l_linenumber, l_partkey) AS n
  FROM lineitem JOIN part ON l_partkey = p_partkey)
WHERE n = 1 AND pubmed_id NOT IN (
  SELECT CAST(o_orderkey AS VARCHAR) FROM orders WHERE o_orderstatus = 'F')""",
)
def s6(spark, folder):
    lines, parts = (testdata.table(spark, folder, t) for t in ("lineitem", "part"))
    copies = lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_orderkey").cast("string").alias("pubmed_id"),
        F.col("p_name").alias("title"),
        file_name_of(1200 + F.col("l_suppkey")).alias("source_file"),
        F.col("l_linenumber").alias("file_offset"),
        F.col("l_partkey").alias("record_no"),
    )
    orders = testdata.table(spark, folder, "orders").where("o_orderstatus = 'F'")
    stored = orders.select(F.col("o_orderkey").cast("string").alias("pubmed_id"))
    return ingest.new_articles(copies, stored).select("pubmed_id", "title", "source_file")


@query(
    "s7_child_rows",
    with_tables(
        "doc_records",
        """SELECT pubmed_id, 'author' AS kind, CAST(0 AS INTEGER) AS place, 'L' || doc_id AS name
FROM doc_records WHERE has_id AND well_formed
UNION ALL SELECT pubmed_id, 'author', 1, NULL FROM doc_records WHERE has_id AND well_formed
UNION ALL SELECT pubmed_id, 'grant', 0, 'Agency ' || source
FROM doc_records WHERE has_id AND well_formed AND doc_id % 3 = 0""",
    ),
)
def s7(spark, folder):
    """Both kinds of children, from records parsed once."""
    path = new_folder(spark, "articles")
    parsed = scan_articles(spark, testdata.landed_documents(spark, folder))
    parsed.select("pubmed_id", "authors", "grants").write.parquet(path)
    articles = spark.read.parquet(path)
    authors = ingest.author_rows(articles).select(
        "pubmed_id", F.lit("author").alias("kind"), F.col("author_no").alias("place"), F.col("last_name").alias("name")
    )
    grants = ingest.grant_rows(articles).select(
        "pubmed_id", F.lit("grant").alias("kind"), F.col("grant_no").alias("place"), F.col("agency").alias("name")
    )
    return authors.unionByName(grants)


# ---- extractions ------------------------------------------------------------------

_INCOMING = """
incoming AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS pubmed_id, 'other' AS study_design,
    0.5 AS extraction_confidence, NULL AS extraction_error,
    CAST(o_orderdate AS TIMESTAMP) + INTERVAL 1 DAY AS extracted_ts
  FROM orders WHERE o_orderstatus <> 'O')"""


@query(
    "s8_extraction_write",
    with_tables("extractions", "").rstrip()
    + ","
    + _INCOMING
    + """
SELECT pubmed_id,
  CASE WHEN i.pubmed_id IS NULL THEN e.study_design ELSE i.study_design END AS study_design,
  CAST(CASE WHEN i.pubmed_id IS NULL THEN e.extraction_confidence
    ELSE i.extraction_confidence END AS DOUBLE) AS extraction_confidence,
  CASE WHEN i.pubmed_id IS NULL THEN e.extraction_error END AS extraction_error,
  CASE WHEN i.pubmed_id IS NULL THEN array_to_string(treatments, '|')
    ELSE 'new' END AS treatments,
  strftime(coalesce(e.extracted_ts, i.extracted_ts), '%Y-%m-%d %H:%M:%S') AS extracted_ts
FROM extractions e FULL JOIN incoming i USING (pubmed_id)""",
)
def s8(spark, folder):
    stored = testdata.extractions(spark, folder)
    pair_type = stored.schema["treatment_outcomes"].dataType
    population_type = stored.schema["population"].dataType
    incoming = (
        testdata.table(spark, folder, "orders")
        .where("o_orderstatus <> 'O'")
        .select(
            F.col("o_orderkey").cast("string").alias("pubmed_id"),
            F.array(F.lit("new")).alias("treatments"),
            F.array().cast("array<string>").alias("outcomes"),
            F.array().cast(pair_type).alias("treatment_outcomes"),
            F.lit("other").alias("study_design"),
            F.lit(None).cast(population_type).alias("population"),
            F.lit(0.5).alias("extraction_confidence"),
            F.lit(None).cast("string").alias("extraction_error"),
            (F.col("o_orderdate") + F.expr("INTERVAL 1 DAY")).cast("timestamp").alias("extracted_ts"),
        )
    )
    written = ingest.upsert_extractions(stored, incoming)
    return written.select(
        "pubmed_id",
        "study_design",
        "extraction_confidence",
        "extraction_error",
        F.array_join("treatments", "|").alias("treatments"),
        F.date_format("extracted_ts", "yyyy-MM-dd HH:mm:ss").alias("extracted_ts"),
    )


@query("s9_saved_result", with_tables("matrix", "SELECT * FROM matrix"))
def s9(spark, folder):
    store = Store(spark, new_folder(spark, "store"))
    store.save_result("treatment_outcome_matrix", a1(spark, folder).limit(0))
    store.save_result("treatment_outcome_matrix", a1(spark, folder))
    return store.load_result("treatment_outcome_matrix")


_DONE = "SELECT CAST(doc_id AS VARCHAR) FROM labels"


def _labelled(spark, folder):
    """Labelled documents stand for abstracts with an extraction, toxic ones for failures."""
    failed = F.when(F.col("toxic") == 1, F.lit("RateLimitError"))
    return testdata.table(spark, folder, "labels").select(
        F.col("doc_id").cast("string").alias("pubmed_id"), failed.alias("extraction_error")
    )


@query(
    "s10_pending_abstracts",
    with_tables(
        "doc_articles",
        f"""SELECT pubmed_id, abstract FROM doc_articles
WHERE abstract IS NOT NULL AND pubmed_id NOT IN ({_DONE}) ORDER BY pubmed_id LIMIT 500""",
    ),
)
def s10(spark, folder):
    return ingest.pending_abstracts(
        testdata.doc_articles(spark, folder), _labelled(spark, folder), limit=500
    )


@query(
    "s10_pending_abstracts_with_retries",
    with_tables(
        "doc_articles",
        f"""SELECT pubmed_id, abstract FROM doc_articles
WHERE abstract IS NOT NULL AND pubmed_id NOT IN ({_DONE} WHERE toxic <> 1)""",
    ),
)
def s10_retries(spark, folder):
    return ingest.pending_abstracts(
        testdata.doc_articles(spark, folder),
        _labelled(spark, folder),
        limit=None,
        retry_failed=True,
    )


# ---- file bookkeeping -------------------------------------------------------------


_SYNC = """WITH wanted AS (SELECT CAST(unnest(range(1200, 1210)) AS INTEGER) AS file_number),
known AS (SELECT DISTINCT CAST(1190 + 2 * s_suppkey AS INTEGER) AS file_number FROM supplier
 )
, actions AS (
SELECT coalesce(w.file_number, k.file_number) AS file_number,
  CASE WHEN k.file_number IS NULL THEN 'add' WHEN w.file_number IS NULL THEN 'remove'
    ELSE 'keep' END AS action
FROM wanted w FULL JOIN known k ON w.file_number = k.file_number)"""


@query("s11_partition_sync", _SYNC + " SELECT * FROM actions")
def s11(spark, folder):
    # every second number is registered
    suppliers = testdata.table(spark, folder, "supplier")
    registered = suppliers.select((1190 + 2 * F.col("s_suppkey")).cast("int").alias("file_number"))
    return ingest.partition_sync(spark, registered, 1200, 1209)


@query(
    "s11_sync_report",
    _SYNC
    + """ SELECT count(*) FILTER (WHERE action = 'remove') AS removed,
  count(*) FILTER (WHERE action = 'add') AS added,
  count(*) FILTER (WHERE action <> 'remove') AS total FROM actions""",
)
def s11_report(spark, folder):
    return ingest.sync_report(s11(spark, folder))


S13_TARGET = 10_000


@query(
    "s13_within_budget",
    f"""SELECT file_number, inserted, CAST(running AS BIGINT) AS running FROM (
  SELECT l_suppkey AS file_number, count(*) AS inserted,
    sum(count(*)) OVER (ORDER BY l_suppkey DESC) AS running
  FROM lineitem GROUP BY l_suppkey) WHERE running - inserted < {S13_TARGET}""",
)
def s13(spark, folder):
    lines = testdata.table(spark, folder, "lineitem")
    files = lines.groupBy(F.col("l_suppkey").alias("file_number")).agg(
        F.count("*").alias("inserted")
    )
    return ingest.within_budget(files, target=S13_TARGET, block=16)


@query(
    "s14_ingest_summary",
    with_tables(
        "doc_articles",
        """, files AS (SELECT DISTINCT source_file AS file_name FROM doc_articles),
skipped AS (SELECT file_name FROM files WHERE file_name LIKE '%3.xml.gz'),
flagged AS (
  SELECT *, list_has_any(list_transform(mesh_terms, lambda t: lower(t)), ['endometriosis'])
    OR regexp_matches(lower(concat_ws(' ', title, abstract)),
      'endometriosis|endometrioma|endometriotic|adenomyosis') AS relevant,
    pubmed_id IN (SELECT CAST(doc_id AS VARCHAR) FROM labels) AS stored
  FROM doc_articles WHERE source_file NOT IN (SELECT file_name FROM skipped))
SELECT f.file_name,
  CASE WHEN s.file_name IS NULL THEN count(d.pubmed_id) END AS total_parsed,
  CASE WHEN s.file_name IS NULL THEN count(*) FILTER (WHERE relevant) END AS filtered,
  CASE WHEN s.file_name IS NULL THEN count(*) FILTER (WHERE relevant AND NOT stored) END AS inserted,
  CASE WHEN s.file_name IS NULL THEN 'ingested' ELSE 'skipped' END AS status
FROM files f LEFT JOIN skipped s ON f.file_name = s.file_name
  LEFT JOIN flagged d ON d.source_file = f.file_name
GROUP BY f.file_name, s.file_name""",
    ),
)
def s14(spark, folder):
    articles = testdata.doc_articles(spark, folder).select(
        "*",
        F.lit(0).alias("file_offset"),
        F.col("pubmed_id").cast("bigint").alias("record_no"),
    )
    files = articles.select(F.col("source_file").alias("file_name")).distinct()
    manifest = files.where(file_number_of(F.col("file_name")) % 10 == 3)
    return ingest.ingest_summary(articles, _labelled(spark, folder), files, manifest)


# ---- incremental ingest and jobs ----------------------------------------------------

_STORED = with_tables(
    "doc_fields",
    """SELECT pubmed_id, title, abstract, source_file FROM doc_fields
WHERE has_id AND well_formed AND relevant""",
)


@query("s12_incremental_ingest", _STORED)
def s12(spark, folder):
    """Two runs over the same files: the second finds nothing new."""
    root = new_folder(spark, "stream")
    for _ in range(2):
        started = ingest_new_files(
            spark, testdata.landed_documents(spark, folder), root, files_per_batch=2
        )
        started.awaitTermination()
    stored = Store(spark, root).read("articles")
    return stored.select("pubmed_id", "title", "abstract", "source_file")


# Words of the generated texts stand for terms and cues.
WORD_RULES = extract.TagRules(
    treatments={"with": "with", "by the": "by the", "by": "by", "les": "les", "und": "und"},
    outcomes={"that": "that", "the that": "the that", "pour": "pour", "nicht": "nicht"},
    positive=("for", "de", "die"),
    negative=("is", "la", "der"),
    neutral=("was", "une"),
    designs=(("cohort_study", ("that the", "dans les")), ("other", ("on the", "que la", "el"))),
    female=("she", "elle"),
    male=("he", "il"),
    subjects=("the", "of", "and"),
    **extract.NO_SCOPE,
)


@query(
    "b1_full_job",
    with_tables(
        "doc_fields",
        """, kept AS (SELECT * FROM doc_fields WHERE has_id AND well_formed AND relevant)
SELECT 'articles' AS table_name, count(*) AS row_count FROM kept
UNION ALL SELECT 'authors', 2 * count(*) FROM kept
UNION ALL SELECT 'grants', count(*) FROM kept WHERE doc_id % 3 = 0
UNION ALL SELECT 'extractions', count(*) FROM kept WHERE abstract IS NOT NULL
UNION ALL SELECT 'manifest', count(DISTINCT source_file) FROM doc_fields WHERE has_id AND well_formed
UNION ALL SELECT 'quarantine', count(*) FROM doc_fields WHERE NOT well_formed
UNION ALL SELECT 'publication_trend_analysis', count(DISTINCT year(pub_date)) FROM kept""",
    ),
)
def b1(spark, folder):
    """The whole job, run twice: the second run has no file and no abstract left to do."""
    root = new_folder(spark, "job")
    path = testdata.landed_documents(spark, folder)
    for batch in ("first", "second"):
        summary = jobs.run_job(
            spark, root, batch, jobs.FULL, path=path, rules=WORD_RULES, limit=None
        )
    compared = [*"articles authors grants extractions manifest quarantine".split()]
    return summary.where(F.col("table_name").isin(*compared, "publication_trend_analysis"))


@query(
    "b2_registered_analytics",
    with_tables(
        "articles extractions geography funding profile",
        """SELECT 'publication_trend_analysis' AS name,
  count(DISTINCT year(pub_date)) AS row_count FROM articles
UNION ALL SELECT 'study_design_trends', count(DISTINCT year(pub_date))
FROM articles JOIN extractions USING (pubmed_id)
UNION ALL SELECT 'research_geography_analysis', count(*) FROM geography
UNION ALL SELECT 'funding_landscape_analysis', count(*) FROM funding
UNION ALL SELECT 'patient_population_profiling', count(*) FROM profile
UNION ALL SELECT 'treatment_outcome_matrix', count(*) FROM (
  SELECT DISTINCT lower(p.treatment), lower(p.outcome) FROM (
    SELECT unnest(treatment_outcomes) AS p FROM extractions WHERE extraction_error IS NULL))
UNION ALL SELECT 'designs_without_year', count(DISTINCT study_design) FROM extractions""",
    ),
)
def b2(spark, folder):
    """The default analytics on the order tables, and one that a caller registers."""
    tables = {
        "articles": testdata.articles(spark, folder),
        "authors": testdata.authors(spark, folder),
        "grants": testdata.grants(spark, folder),
        "extractions": testdata.extractions(spark, folder),
    }
    without_terms = {
        name: analytic
        for name, analytic in registry.ANALYTICS.items()
        if name not in ("mesh_cooccurrence_network", "knowledge_graph_data", "knowledge_graph_links")
    }
    own = {
        "designs_without_year": lambda t: t["extractions"]
        .where("study_design IS NOT NULL")
        .select("study_design")
        .distinct()
    }
    counts = [
        evidence.result_row_count(analytic(tables)).select(F.lit(name).alias("name"), "row_count")
        for name, analytic in {**without_terms, **own}.items()
    ]
    rows = counts[0]
    for more in counts[1:]:
        rows = rows.unionByName(more)
    return rows


@query("b2_refreshed_trends", PUBLICATION_TRENDS)
def b2_refreshed(spark, folder):
    """Trends brought up to date batch by batch; the last one replaces extractions of the others."""
    store = Store(spark, new_folder(spark, "refresh"))
    articles = testdata.articles(spark, folder)
    extractions = testdata.extractions(spark, folder)
    key = F.pmod(F.xxhash64("pubmed_id"), F.lit(2))
    for number in (0, 1):
        batch = f"part-{number}"
        first = extractions.where(key == number).withColumn("study_design", F.lit("case_report"))
        store.write("articles", batch, articles.where(key == number))
        store.write("extractions", batch, first.withColumn("extracted_ts", F.lit("2026-01-01").cast("timestamp")))
        refresh.refresh(store)
    store.write("extractions", "last", extractions.withColumn("extracted_ts", F.lit("2026-01-02").cast("timestamp")))
    refresh.refresh(store)
    return refresh.results(store)["publication_trend_analysis"]


@query(
    "b2_saved_graph_links",
    with_tables("links", "SELECT source, target, effect_direction FROM links"),
)
def b2_graph(spark, folder):
    """An analytic of the registry, saved and loaded again by its name."""
    store = Store(spark, new_folder(spark, "store"))
    links = graph_links(testdata.line_extractions(spark, folder))
    store.save_result("knowledge_graph_links", links)
    return store.load_result("knowledge_graph_links").select("source", "target", "effect_direction")
