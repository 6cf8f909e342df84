"""The driver's tables, shaped as the tables of this library.

The driver's files hold no NULLs, blanks or mixed case, so the shapes make them:
otherwise no filter would be tested. ``plans/oracle.py`` states the same shapes
in SQL. Arrays are built inside the row; nothing is collected into groups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evidmap.functions.files import file_name_of
from evidmap.runtime import new_folder, spread

BLANKS = "  "


def table(spark: SparkSession, folder: str, name: str, heavy: bool = False) -> DataFrame:
    """A table of the driver; ``heavy`` says that the work on a row outweighs moving it."""
    rows = spark.read.parquet(f"{folder}/{name}.parquet")
    return spread(rows, spark.sparkContext.defaultParallelism) if heavy else rows


def cases(*branches: tuple[Column, Column], otherwise: Column | None = None) -> Column:
    """CASE WHEN in order of ``branches``."""
    first, *rest = branches
    column = F.when(*first)
    for condition, value in rest:
        column = column.when(condition, value)
    return column if otherwise is None else column.otherwise(otherwise)


def articles(spark: SparkSession, folder: str) -> DataFrame:
    """One article per order."""
    key = F.col("o_orderkey")
    return table(spark, folder, "orders").select(
        key.cast("string").alias("pubmed_id"),
        F.when(key % 97 != 0, F.col("o_orderpriority")).alias("title"),
        F.col("o_orderstatus").alias("journal"),
        F.when(key % 17 != 0, F.to_date("o_orderdate")).alias("pub_date"),
        file_name_of((F.lit(1200) + key % 10).cast("int")).alias("source_file"),
    )


def authors(spark: SparkSession, folder: str) -> DataFrame:
    """One author per order line, from the country of its supplier."""
    lines = table(spark, folder, "lineitem")
    suppliers = table(spark, folder, "supplier")
    nations = table(spark, folder, "nation")
    number, name = F.col("l_linenumber"), F.col("n_name")
    country = cases(
        ((F.col("l_partkey") + number) % 5 == 0, F.lit(None).cast("string")),
        (number == 7, F.lit(BLANKS)),
        (number % 2 == 0, F.concat(F.lit(BLANKS), name, F.lit("\t"))),
        otherwise=name,
    )
    return (
        lines.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(F.col("l_orderkey").cast("string").alias("pubmed_id"), country.alias("country"))
    )


def grants(spark: SparkSession, folder: str) -> DataFrame:
    """One grant per order line: the agency is a brand, the country the supplier's."""
    lines = table(spark, folder, "lineitem", heavy=True)
    parts = table(spark, folder, "part")
    suppliers = table(spark, folder, "supplier")
    nations = table(spark, folder, "nation")
    number = F.col("l_linenumber")
    agency = cases(
        (number % 6 == 0, F.lit(None).cast("string")),
        (F.col("l_partkey") % 41 == 0, F.lit(" ")),
        (number % 2 == 0, F.concat(F.lit(" "), F.col("p_brand"))),
        otherwise=F.col("p_brand"),
    )
    country = cases(
        (F.col("l_suppkey") % 4 == 0, F.lit(None).cast("string")),
        (F.col("l_suppkey") % 4 == 1, F.lit(BLANKS)),
        otherwise=F.concat(F.col("n_name"), F.lit(" ")),
    )
    order = [number.cast("bigint"), F.col("l_partkey"), F.col("l_suppkey")]
    return (
        lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("l_orderkey").cast("string").alias("pubmed_id"),
            agency.alias("agency"),
            country.alias("country"),
            F.struct(*order).alias("grant_no"),
        )
    )


def _pair(treatment: Column, outcome: Column, direction: Column) -> Column:
    return F.struct(
        treatment.alias("treatment"),
        outcome.alias("outcome"),
        direction.alias("effect_direction"),
    )


def _direction(key: Column) -> Column:
    return cases(
        (key % 11 == 0, F.lit("unknown")),
        (key % 13 == 0, F.lit("mixed")),
        (key % 3 == 0, F.lit("positive")),
        (key % 3 == 1, F.lit("negative")),
        otherwise=F.lit("neutral"),
    )


def extractions(spark: SparkSession, folder: str) -> DataFrame:
    """One extraction per order that is not pending; all parts inside the row."""
    key, priority = F.col("o_orderkey"), F.col("o_orderpriority")
    orders = table(spark, folder, "orders").where("o_orderstatus <> 'P'")
    customers = table(spark, folder, "customer")
    rank = F.substring(priority, 1, 1)
    design = cases(
        (rank == "1", F.lit("randomized_controlled_trial")),
        ((rank == "2") & (key % 2 == 0), F.lit("meta_analysis")),
        (rank == "2", F.lit("systematic_review")),
        (rank == "3", F.lit("case_report")),
        (rank == "4", F.lit("cohort_study")),
        (key % 2 == 0, F.lit("")),
    )
    error = cases((key % 10 == 0, F.lit("RateLimitError")), (key % 10 == 5, F.lit("")))
    segment = F.col("c_mktsegment")
    pairs = cases(
        (key % 7 == 0, F.array().cast("array<struct<treatment:string,outcome:string,effect_direction:string>>")),
        (
            key % 7 != 1,
            F.array(
                _pair(segment, priority, _direction(key)),
                _pair(F.lower(segment), F.col("o_orderstatus"), _direction(key + 1)),
            ),
        ),
    )
    customer, nation = F.col("c_custkey"), F.col("c_nationkey")
    population = F.struct(
        cases(
            (customer % 4 == 1, F.lit("Female")),
            (customer % 4 == 2, F.lit(" male ")),
            (customer % 4 == 3, F.lit("")),
        ).alias("sex"),
        F.when(customer % 6 != 0, segment).alias("age_group"),
        cases(
            (nation % 3 == 1, F.lit("")),
            (nation % 3 == 2, F.concat(F.lit("Stage "), nation.cast("string"))),
        ).alias("disease_stage"),
        (customer % 500).cast("int").alias("sample_size"),
        F.lit(None).cast("string").alias("special_population"),
    )
    # TREATMENT 1..9 come without trials
    extra = F.concat(F.lit("treatment "), (customer % 10).cast("string"))
    treatments = F.array(
        segment,
        F.concat(F.lit(" "), F.lower(segment)),
        F.when(rank.isin("3", "4"), extra).otherwise(F.lit(" ")),
    )
    confidence = F.when(key % 211 == 0, F.lit(1.5)).otherwise((key % 101) / F.lit(100.0))
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
        key.cast("string").alias("pubmed_id"),
        treatments.alias("treatments"),
        F.array(priority, F.col("o_orderstatus")).alias("outcomes"),
        pairs.alias("treatment_outcomes"),
        design.alias("study_design"),
        population.alias("population"),
        confidence.alias("extraction_confidence"),
        error.alias("extraction_error"),
        F.col("o_orderdate").cast("timestamp").alias("extracted_ts"),
    )


def _line_id() -> Column:
    return F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def line_extractions(spark: SparkSession, folder: str, heavy: bool = False) -> DataFrame:
    """One extraction per order line. Everything but the time follows from the id,
    so lines that share an id and a time are alike."""
    lines, parts = table(spark, folder, "lineitem", heavy), table(spark, folder, "part")
    key = F.col("l_orderkey") + F.col("l_linenumber")
    kind, brand, name = F.col("p_type"), F.col("p_brand"), F.col("p_name")
    pairs = F.array(
        _pair(F.when(key % 2 == 0, F.lower(kind)).otherwise(kind), brand, _direction(key)),
        _pair(brand, name, _direction(key + 1)),
        _pair(F.when(key % 5 == 0, F.lit("")).otherwise(name), kind, _direction(key + 2)),
    )
    population = F.struct(
        cases(
            (F.col("l_suppkey") % 3 == 1, F.lit("female")),
            (F.col("l_suppkey") % 3 == 2, F.lit("")),
        ).alias("sex"),
        F.lit(None).cast("string").alias("age_group"),
        cases(
            (F.col("l_partkey") % 3 == 1, F.lit("")),
            (F.col("l_partkey") % 3 == 2, F.lit("stage IV")),
        ).alias("disease_stage"),
    )
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        _line_id().alias("pubmed_id"),
        F.when(key % 7 != 0, pairs).alias("treatment_outcomes"),
        population.alias("population"),
        F.when(key % 10 == 0, F.lit("RateLimitError")).alias("extraction_error"),
        F.col("l_shipdate").cast("timestamp").alias("extracted_ts"),
    )


def line_articles(spark: SparkSession, folder: str) -> DataFrame:
    """One article per order line with five index terms, some equal but for case."""
    lines, parts = table(spark, folder, "lineitem", heavy=True), table(spark, folder, "part")
    key = F.col("l_orderkey") + F.col("l_linenumber")
    words = F.split("p_name", " ")
    terms = F.array(
        F.upper(words[0]),
        words[1],
        F.col("p_brand"),
        F.concat(F.lit("size "), F.col("p_size").cast("string")),
        F.when(key % 2 == 0, F.col("p_type")).otherwise(words[0]),
    )
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        _line_id().alias("pubmed_id"), F.when(key % 19 != 0, terms).alias("mesh_terms")
    )


# ---- documents ----------------------------------------------------------------

DOCUMENTS_PER_FILE = 200

# Affiliations as they occur, with the spelling variants of countries.
AFFILIATIONS = (
    "Department of Gynecology, Boston, USA.",
    "Institute of Statistics, Springfield, U.S.A.",
    "Clinica Mangiagalli, Milano, Italy .",
    "Seoul National University, Seoul, South Korea. Electronic address: a@b.kr",
    "King's College, London, England",
    "Ruhr University, Bochum",
    "University of Otago, Dunedin, New Zealand.",
    "France and Germany Research Network, Basel",
    "Hospital de Clinicas, Sao Paulo, BRAZIL. x@y.br, Ward 3",
    "Ukraine State University, Kyiv",
)


def doc_articles(spark: SparkSession, folder: str) -> DataFrame:
    """One article per document, with its whole text."""
    key = F.col("doc_id")
    title = F.when(key % 10 == 0, F.lit("On Adenomyosis")).otherwise(F.col("source"))
    topic = F.when(key % 6 == 0, F.lit("ENDOMETRIOSIS")).when(key % 7 != 0, F.lit("Pain"))
    return table(spark, folder, "documents", heavy=True).select(
        key.cast("string").alias("pubmed_id"),
        title.alias("title"),
        F.when(key % 23 != 0, F.col("text")).alias("abstract"),
        F.array(F.col("lang"), topic).alias("mesh_terms"),
        document_file().alias("source_file"),
    )


def document_file() -> Column:
    number = F.lit(1200) + F.floor(F.col("doc_id") / DOCUMENTS_PER_FILE)
    return file_name_of(number.cast("int"))


def clean_text() -> Column:
    """Document text without the characters XML does not allow, and without CR."""
    # those that are allowed: most signs are in the range that is tried first
    return F.regexp_replace("text", r"[^\x20-\uFFFD\t\n\x{10000}-\x{10FFFF}]", "")


def _escaped(text: Column) -> Column:
    text = F.replace(text, F.lit("&"), F.lit("&amp;"))
    text = F.replace(text, F.lit("<"), F.lit("&lt;"))
    return F.replace(text, F.lit(">"), F.lit("&gt;"))


def _tag(name: str, *content: Column | str, attributes: str = "") -> Column:
    inner = [c if isinstance(c, Column) else F.lit(c) for c in content]
    return F.concat(F.lit(f"<{name}{attributes}>"), *inner, F.lit(f"</{name}>"))


def _date_tag(name: str, year: str, month: str, day: str, attributes: str = "") -> Column:
    parts = _tag("Year", year), _tag("Month", month), _tag("Day", day)
    return _tag(name, *parts, attributes=attributes)


def document_xml(spark: SparkSession, folder: str, by_file: bool = False) -> DataFrame:
    """(doc_id, source_file, xml): a record per document, with the variants of every field.

    The whole text is the abstract, in two parts with inline markup. Some records
    have no id, some do not parse. ``by_file``: the documents of a file lie together, by
    ascending id; they are dealt once, as texts, before the records are made.
    """
    key = F.col("doc_id")
    none = F.lit("")
    first, rest = F.substring("clean", 1, 40), F.expr("substring(clean, 41)")
    abstract = F.concat(
        _tag("AbstractText", _escaped(first), attributes=' Label="BACKGROUND"'),
        F.lit("<AbstractText/>"),
        _tag("AbstractText", "<i>", _escaped(F.substring(rest, 1, 5)), "</i>",
             _escaped(F.expr("substring(clean, 46)"))),
    )
    in_pubmed = cases(
        (key % 5 == 0, _date_tag("PubMedPubDate", "2019", "12", "31", ' PubStatus="pubmed"')),
        (key % 5 == 1, _date_tag("PubMedPubDate", "2018", "Mar", "1", " PubStatus='pubmed'")),
        otherwise=_date_tag("PubMedPubDate", "2001", "1", "1", ' PubStatus="entrez"'),
    )
    in_journal = cases(
        (key % 5 == 1, _date_tag("PubDate", "2017", "07", "09")),
        (key % 5 == 2, _tag("PubDate", _tag("Year", " 2016 "))),
        otherwise=_tag("PubDate", _tag("MedlineDate", "1998 Winter")),
    )
    electronic = F.when(
        key % 5 == 4, _date_tag("ArticleDate", "2015", "13", "0", ' DateType="Electronic"')
    ).otherwise(none)
    affiliation = F.element_at(
        F.array(*[F.lit(a) for a in AFFILIATIONS]), (key % len(AFFILIATIONS) + 1).cast("int")
    )
    authors = _tag(
        "AuthorList",
        _tag(
            "Author",
            _tag("LastName", F.concat(F.lit("L"), key.cast("string"))),
            _tag("ForeName", "A &amp; B"),
            _tag("AffiliationInfo", _tag("Affiliation", affiliation)),
            _tag("AffiliationInfo", _tag("Affiliation", "Oslo, Norway")),
            attributes=' ValidYN="Y"',
        ),
        _tag("Author", _tag("CollectiveName", "Group")),
    )
    grants = F.when(
        key % 3 == 0,
        _tag("GrantList", _tag("Grant", _tag("GrantID", F.concat(F.lit("G"), key.cast("string"))),
                               _tag("Agency", F.concat(F.lit("Agency "), F.col("source"))))),
    ).otherwise(none)
    title = F.when(
        key % 2 == 0, _tag("ArticleTitle", " Report of ", _tag("i", F.col("lang")), " texts")
    ).otherwise(_tag("ArticleTitle", "Adenomyosis &lt;", F.col("source"), "&gt;"))
    topics = _tag(
        "MeshHeadingList",
        _tag("MeshHeading", _tag("DescriptorName", F.col("lang"), attributes=' UI="D1"')),
        _tag("MeshHeading", _tag("DescriptorName", " ")),
        F.when(key % 6 == 0, _tag("MeshHeading", _tag("DescriptorName", "Endometriosis"))).otherwise(none),
    )
    article = _tag(
        "Article",
        _tag("Journal", _tag("JournalIssue", in_journal), _tag("Title", "J &amp; ", F.col("source"))),
        title,
        _tag("Abstract", abstract),
        authors,
        _tag("Language", F.col("lang")),
        grants,
        _tag("PublicationTypeList", _tag("PublicationType", "Journal Article"),
             _tag("PublicationType", F.col("source"))),
        electronic,
    )
    number = F.when(key % 29 != 0, _tag("PMID", key.cast("string"), attributes=' Version="1"'))
    record = _tag(
        "PubmedArticle",
        _tag("MedlineCitation", F.coalesce(number, none), article, topics),
        _tag("PubmedData", _tag("History", in_pubmed)),
    )
    # an element that is never closed
    broken = F.when(key % 31 == 5, F.replace(record, F.lit("</Abstract>"), none)).otherwise(record)
    documents = table(spark, folder, "documents", heavy=not by_file)
    documents = documents.select("*", document_file().alias("source_file"))
    if by_file:
        documents = documents.repartition("source_file").sortWithinPartitions("source_file", "doc_id")
    return documents.withColumn("clean", clean_text()).select("doc_id", "source_file", broken.alias("xml"))


_LANDED: dict[tuple[str, str], str] = {}


def landed_documents(spark: SparkSession, folder: str) -> str:
    """Folder of gzip record files of the documents, written once per session."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _LANDED:
        path = new_folder(spark, "records")
        set_start = F.lit('<?xml version="1.0" encoding="UTF-8"?>\n<PubmedArticleSet>\n')
        place = F.col("doc_id") % DOCUMENTS_PER_FILE
        line = F.concat(
            F.when(place == 0, set_start).otherwise(F.lit("")),
            F.col("xml"),
            F.when(place == DOCUMENTS_PER_FILE - 1, F.lit("\n</PubmedArticleSet>")).otherwise(F.lit("")),
        )
        (
            document_xml(spark, folder, by_file=True)
            .select("source_file", line.alias("value"))
            .write.partitionBy("source_file")
            .option("compression", "gzip")
            .text(path)
        )
        _LANDED[key] = path
    return _LANDED[key]
