"""Catalogue: record scan (S1-S3), record columns (P) and relevance (F)."""

from __future__ import annotations

from pyspark.sql import functions as F

from evidmap.functions import files, records, text
from evidmap.functions.country import CANONICAL, COUNTRY_NAMES, country_of
from evidmap.operators import relevance
from evidmap.plans.catalog import query
from evidmap.plans.oracle import with_tables
from evidmap.runtime import new_folder
from evidmap.sources import landing, testdata

_KEPT = "WHERE has_id AND well_formed"


_FIELDS = """SELECT source_file, pubmed_id, title, abstract, journal,
  strftime(pub_date, '%Y-%m-%d') AS pub_date, lang AS language,
  array_to_string(mesh_terms, '|') AS mesh_terms, 'Journal Article|' || source AS publication_types,
  CAST(2 AS INTEGER) AS authors, CAST(CASE WHEN doc_id % 3 = 0 THEN 1 ELSE 0 END AS INTEGER) AS grants
FROM doc_fields """


def _fields(articles):
    return articles.select(
        "source_file",
        "pubmed_id",
        "title",
        "abstract",
        "journal",
        F.date_format("pub_date", "yyyy-MM-dd").alias("pub_date"),
        "language",
        F.array_join("mesh_terms", "|").alias("mesh_terms"),
        F.array_join("publication_types", "|").alias("publication_types"),
        F.size("authors").alias("authors"),
        F.size("grants").alias("grants"),
    )


@query("s1_record_scan", with_tables("doc_fields", _FIELDS + _KEPT))
def s1(spark, folder):
    return _fields(landing.scan_articles(spark, testdata.landed_documents(spark, folder)))


@query("s1_recovered_records", with_tables("doc_fields", _FIELDS + "WHERE has_id"))
def s1_recovered(spark, folder):
    """All records: those with an element that is never closed come back with their fields."""
    scanned = landing.scan_records(spark, testdata.landed_documents(spark, folder))
    return _fields(landing.parse_records(scanned, recover=True))


@query(
    "s1_quarantine",
    with_tables(
        "doc_records",
        """SELECT source_file, count(*) AS bad_records FROM doc_records
WHERE NOT well_formed GROUP BY 1""",
    ),
)
def s1_quarantine(spark, folder):
    scanned = landing.scan_records(spark, testdata.landed_documents(spark, folder))
    bad = landing.quarantine_of(landing.parse_all(scanned))
    return bad.groupBy("source_file").agg(F.count("*").alias("bad_records"))


@query(
    "s2_file_names",
    """SELECT s_suppkey AS number, printf('pubmed26n%04d.xml.gz', s_suppkey) AS file_name,
  CAST(s_suppkey AS INTEGER) AS number_in_name FROM supplier""",
)
def s2(spark, folder):
    numbers = testdata.table(spark, folder, "supplier").select(F.col("s_suppkey").alias("number"))
    named = numbers.withColumn("file_name", files.file_name_of(F.col("number")))
    return named.withColumn("number_in_name", files.file_number_of(F.col("file_name")))


@query(
    "s3_checksum_audit",
    rf"""WITH files AS (
  SELECT printf('pubmed26n%04d.xml.gz', 1200 + doc_id // {testdata.DOCUMENTS_PER_FILE})
    AS file_name, doc_id // {testdata.DOCUMENTS_PER_FILE} AS n,
    md5(string_agg(regexp_replace(text, '\r', '', 'g') || chr(10), '' ORDER BY doc_id)) AS actual
  FROM documents GROUP BY ALL)
SELECT file_name, actual, expected, coalesce(expected = actual, false) AS ok
FROM (SELECT *, CASE n % 4 WHEN 1 THEN 'wronghash' WHEN 3 THEN NULL ELSE actual END AS expected
  FROM files)""",
)
def s3(spark, folder):
    """Plain text files of the documents, with side files that are right, wrong or missing."""
    root = new_folder(spark, "audit")
    name = testdata.document_file()
    documents = testdata.table(spark, folder, "documents").select(
        name.alias("source_file"), "doc_id", F.regexp_replace("text", "\r", "").alias("value")
    )
    (
        documents.repartition("source_file")
        .sortWithinPartitions("source_file", "doc_id")
        .select("source_file", "value")
        .write.partitionBy("source_file")
        .text(f"{root}/files")
    )
    digests = landing.file_digests(spark, f"{root}/files")
    place = (files.file_number_of(F.col("file_name")) - 1200) % 4
    side = F.concat(
        F.lit("MD5("), "file_name", F.lit(")= "), F.when(place == 1, "wronghash").otherwise(F.col("actual"))
    )
    (
        digests.where(place != 3)
        .select(F.col("file_name").alias("source_file"), side.alias("value"))
        .write.partitionBy("source_file")
        .text(f"{root}/sums")
    )
    return landing.checksum_audit(digests, landing.read_checksums(spark, f"{root}/sums", "*"))


# ---- record columns, on the record text -----------------------------------------


def _records(spark, folder):
    # through generators, so that the condition is not computed once more below
    xml = testdata.document_xml(spark, folder).select("doc_id", F.explode_outer(F.array("xml")).alias("xml"))
    good = F.when(records.is_well_formed(F.col("xml")), F.col("xml"))
    checked = xml.select("doc_id", F.explode_outer(F.array(good)).alias("xml"))
    return checked.where(F.col("xml").isNotNull())


def _field(sql: str) -> str:
    return with_tables("doc_fields", f"SELECT doc_id, {sql} FROM doc_fields WHERE well_formed")


@query("p1_first_text", _field("title"))
def p1(spark, folder):
    return _records(spark, folder).select("doc_id", records.title_of(F.col("xml")).alias("title"))


@query(
    "p1_full_title",
    _field(
        """CASE WHEN doc_id % 2 = 0 THEN 'Report of ' || lang || ' texts'
  ELSE 'Adenomyosis <' || source || '>' END AS title"""
    ),
)
def p1_full(spark, folder):
    return _records(spark, folder).select(
        "doc_id", records.title_of(F.col("xml"), full_title=True).alias("title")
    )


@query(
    "p2_all_texts",
    _field(
        """array_to_string(mesh_terms, '|') AS mesh_terms,
  'Journal Article|' || source AS publication_types"""
    ),
)
def p2(spark, folder):
    xml = F.col("xml")
    return _records(spark, folder).select(
        "doc_id",
        F.array_join(records.mesh_terms_of(xml), "|").alias("mesh_terms"),
        F.array_join(records.publication_types_of(xml), "|").alias("publication_types"),
    )


@query("p3_dates", _field("strftime(pub_date, '%Y-%m-%d') AS pub_date"))
def p3(spark, folder):
    day = records.date_of(F.col("xml"))
    return _records(spark, folder).select(
        "doc_id", F.date_format(day, "yyyy-MM-dd").alias("pub_date")
    )


@query(
    "p3_dates_real_month_ends",
    _field(
        """CASE doc_id % 5 WHEN 0 THEN '2019-12-31' WHEN 1 THEN '2018-03-01'
  WHEN 2 THEN '2016-01-01' WHEN 4 THEN '2015-12-01' END AS pub_date"""
    ),
)
def p3_real(spark, folder):
    day = records.date_of(F.col("xml"), last_day=None, month_names=True)
    return _records(spark, folder).select(
        "doc_id", F.date_format(day, "yyyy-MM-dd").alias("pub_date")
    )


def _sql_list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


_AFFILIATION = f"{_sql_list(testdata.AFFILIATIONS)}[doc_id % {len(testdata.AFFILIATIONS)} + 1]"
_NAMES = "|".join(n.replace(".", "\\.") for n in sorted(COUNTRY_NAMES, key=len, reverse=True))
_CANONICAL = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in CANONICAL.items())


def _country_sql(affiliation: str) -> str:
    """Last part that names a country, with the leftmost name in it."""
    pattern = rf"(?:^|[^\p{{L}}\p{{N}}_])({_NAMES})(?:$|[^\p{{L}}\p{{N}}_])"
    found = f"""list_filter(list_transform(list_reverse(string_split({affiliation}, ',')),
    lambda p: regexp_extract(lower(p), '{pattern}', 1)), lambda n: n <> '')[1]"""
    title = """array_to_string(list_transform(string_split({n}, ' '),
    lambda w: upper(w[1]) || w[2:]), ' ')""".format(n=found)
    return f"CASE {found} {_CANONICAL} ELSE {title} END"


@query(
    "p4_authors",
    with_tables(
        "doc_records",
        f"""SELECT doc_id, CAST(0 AS INTEGER) AS author_no, 'L' || doc_id AS last_name,
  'A & B' AS fore_name, {_AFFILIATION} AS affiliation, {_country_sql(_AFFILIATION)} AS country
FROM doc_records WHERE well_formed
UNION ALL SELECT doc_id, 1, NULL, NULL, NULL, NULL FROM doc_records WHERE well_formed""",
    ),
)
def p4(spark, folder):
    return (
        _records(spark, folder)
        .select("doc_id", F.posexplode(records.authors_of(F.col("xml"))).alias("author_no", "a"))
        .select("doc_id", "author_no", "a.*")
    )


@query(
    "p5_grants",
    with_tables(
        "doc_records",
        """SELECT doc_id, 'G' || doc_id AS grant_id, 'Agency ' || source AS agency,
  CAST(NULL AS VARCHAR) AS country FROM doc_records WHERE well_formed AND doc_id % 3 = 0""",
    ),
)
def p5(spark, folder):
    return _records(spark, folder).select("doc_id", F.inline(records.grants_of(F.col("xml"))))


@query("p6_abstract", _field("abstract"))
def p6(spark, folder):
    return _records(spark, folder).select(
        "doc_id", records.abstract_of(F.col("xml")).alias("abstract")
    )


# Forms in which the affiliations of the suppliers end.
_ENDINGS = (
    "USA.", "U.S.A.", "Italy .", "South Korea. Electronic address: x@y.kr", "scotland",
    "New Zealand and Australia", "Czech Republic", "Atlantis", "Ukraine", "UK",
)


@query(
    "p7_country",
    f"""WITH affiliations AS (
  SELECT s_suppkey, 'Institute ' || s_name || ', ' || n_name || ', '
    || {_sql_list(_ENDINGS)}[s_suppkey % {len(_ENDINGS)} + 1] AS affiliation
  FROM supplier JOIN nation ON s_nationkey = n_nationkey)
SELECT s_suppkey, affiliation, {_country_sql('affiliation')} AS country FROM affiliations""",
)
def p7(spark, folder):
    suppliers, nations = (testdata.table(spark, folder, t) for t in ("supplier", "nation"))
    place = (F.col("s_suppkey") % len(_ENDINGS) + 1).cast("int")
    ending = F.element_at(F.array(*[F.lit(e) for e in _ENDINGS]), place)
    affiliation = F.concat(
        F.lit("Institute "), "s_name", F.lit(", "), "n_name", F.lit(", "), ending
    )
    return (
        suppliers.join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
        .select("s_suppkey", affiliation.alias("affiliation"))
        .withColumn("country", country_of(F.col("affiliation")))
    )


@query(
    "p8_scalar_fields",
    _field("CASE WHEN has_id THEN pubmed_id END AS pubmed_id, journal, lang AS language"),
)
def p8(spark, folder):
    xml = F.col("xml")
    return _records(spark, folder).select(
        "doc_id",
        records.leading_text(xml, "PMID").alias("pubmed_id"),
        records.journal_of(xml).alias("journal"),
        records.leading_text(xml, "Language").alias("language"),
    )


@query(
    "p9_year",
    with_tables(
        "articles", "SELECT pubmed_id, CAST(year(pub_date) AS INTEGER) AS year FROM articles"
    ),
)
def p9(spark, folder):
    return testdata.articles(spark, folder).select(
        "pubmed_id", text.year_of(F.col("pub_date")).alias("year")
    )


@query(
    "p10_normalised_text",
    with_tables(
        "authors",
        r"""SELECT pubmed_id, label, count(*) AS authors FROM (
  SELECT pubmed_id, nullif(lower(regexp_replace(country, '^\s+|\s+$', '', 'g')), '') AS label
  FROM authors) GROUP BY 1, 2""",
    ),
)
def p10(spark, folder):
    labels = testdata.authors(spark, folder).select(
        "pubmed_id", text.normalise(F.col("country")).alias("label")
    )
    return labels.groupBy("pubmed_id", "label").agg(F.count("*").alias("authors"))


@query(
    "p11_first_filled",
    with_tables(
        "extractions",
        """SELECT pubmed_id, coalesce(nullif(disease_stage, ''), nullif(sex, ''), 'general')
  AS population FROM extractions""",
    ),
)
def p11(spark, folder):
    population = text.first_filled(
        F.col("population.disease_stage"), F.col("population.sex"), default="general"
    )
    return testdata.extractions(spark, folder).select(
        "pubmed_id", population.alias("population")
    )


# ---- relevance ------------------------------------------------------------------

_MESH = """list_has_any(list_transform(mesh_terms, lambda t: lower(t)),
  ['d004715', 'endometriosis'])"""
_KEYWORD = """regexp_matches(lower(concat_ws(' ', title, abstract)),
  'endometriosis|endometrioma|endometriotic|adenomyosis')"""


@query(
    "f1_term_match",
    with_tables("doc_articles", f"SELECT pubmed_id, {_MESH} AS matches FROM doc_articles"),
)
def f1(spark, folder):
    return testdata.doc_articles(spark, folder).select(
        "pubmed_id", relevance.matches_terms(F.col("mesh_terms")).alias("matches")
    )


@query(
    "f2_keyword_match",
    with_tables("doc_articles", f"SELECT pubmed_id, {_KEYWORD} AS matches FROM doc_articles"),
)
def f2(spark, folder):
    matches = relevance.matches_keywords(F.col("title"), F.col("abstract"))
    return testdata.doc_articles(spark, folder).select("pubmed_id", matches.alias("matches"))


@query(
    "f3_relevant_articles",
    with_tables(
        "doc_articles", f"SELECT pubmed_id, title FROM doc_articles WHERE {_MESH} OR {_KEYWORD}"
    ),
)
def f3(spark, folder):
    relevant = relevance.relevant_articles(testdata.doc_articles(spark, folder))
    return relevant.select("pubmed_id", "title")


@query(
    "f4_null_predicates",
    with_tables(
        "articles",
        "SELECT pubmed_id, title FROM articles WHERE title IS NOT NULL AND pub_date IS NOT NULL",
    ),
)
def f4(spark, folder):
    kept = relevance.with_value(testdata.articles(spark, folder), "title", "pub_date")
    return kept.select("pubmed_id", "title")


@query(
    "f5_success",
    with_tables(
        "extractions",
        """SELECT pubmed_id, study_design FROM extractions
WHERE coalesce(extraction_error, '') = '' AND len(treatment_outcomes) > 0""",
    ),
)
def f5(spark, folder):
    kept = testdata.extractions(spark, folder).where(relevance.succeeded())
    return kept.select("pubmed_id", "study_design")


@query(
    "f6_failure",
    with_tables(
        "extractions",
        "SELECT pubmed_id, extraction_error FROM extractions WHERE extraction_error <> ''",
    ),
)
def f6(spark, folder):
    kept = testdata.extractions(spark, folder).where(relevance.failed())
    return kept.select("pubmed_id", "extraction_error")
