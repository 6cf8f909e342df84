"""The table shapes of ``sources/testdata.py`` as SQL, for the oracle queries.

Each constant is one common table expression; ``with_tables`` puts the ones a
query needs in front of it.
"""

from __future__ import annotations

from evidmap.sources.testdata import DOCUMENTS_PER_FILE

_DIRECTION = """CASE WHEN ({k}) % 11 = 0 THEN 'unknown' WHEN ({k}) % 13 = 0 THEN 'mixed'
    WHEN ({k}) % 3 = 0 THEN 'positive' WHEN ({k}) % 3 = 1 THEN 'negative' ELSE 'neutral' END"""


def direction(key: str) -> str:
    return _DIRECTION.format(k=key)


TABLES = {
    "articles": """
  SELECT CAST(o_orderkey AS VARCHAR) AS pubmed_id,
    CASE WHEN o_orderkey % 97 <> 0 THEN o_orderpriority END AS title,
    o_orderstatus AS journal,
    CASE WHEN o_orderkey % 17 <> 0 THEN CAST(o_orderdate AS DATE) END AS pub_date,
    printf('pubmed26n%04d.xml.gz', 1200 + o_orderkey % 10) AS source_file
  FROM orders""",
    "authors": """
  SELECT CAST(l_orderkey AS VARCHAR) AS pubmed_id,
    CASE WHEN (l_partkey + l_linenumber) % 5 = 0 THEN NULL WHEN l_linenumber = 7 THEN '  '
      WHEN l_linenumber % 2 = 0 THEN '  ' || n_name || chr(9) ELSE n_name END AS country
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey""",
    "grants": """
  SELECT CAST(l_orderkey AS VARCHAR) AS pubmed_id,
    CASE WHEN l_linenumber % 6 = 0 THEN NULL WHEN l_partkey % 41 = 0 THEN ' '
      WHEN l_linenumber % 2 = 0 THEN ' ' || p_brand ELSE p_brand END AS agency,
    CASE WHEN l_suppkey % 4 = 0 THEN NULL WHEN l_suppkey % 4 = 1 THEN '  '
      ELSE n_name || ' ' END AS country,
    l_linenumber, l_partkey, l_suppkey
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
    JOIN nation ON s_nationkey = n_nationkey""",
    "extractions": f"""
  SELECT CAST(o_orderkey AS VARCHAR) AS pubmed_id,
    [c_mktsegment, ' ' || lower(c_mktsegment),
      CASE WHEN o_orderpriority[1] IN ('3', '4')
        THEN 'treatment ' || CAST(c_custkey % 10 AS VARCHAR) ELSE ' ' END] AS treatments,
    [o_orderpriority, o_orderstatus] AS outcomes,
    CASE WHEN o_orderkey % 7 = 0 THEN [] WHEN o_orderkey % 7 <> 1 THEN [
      {{'treatment': c_mktsegment, 'outcome': o_orderpriority,
        'effect_direction': {direction('o_orderkey')}}},
      {{'treatment': lower(c_mktsegment), 'outcome': o_orderstatus,
        'effect_direction': {direction('o_orderkey + 1')}}}] END AS treatment_outcomes,
    CASE WHEN o_orderpriority[1] = '1' THEN 'randomized_controlled_trial'
      WHEN o_orderpriority[1] = '2' AND o_orderkey % 2 = 0 THEN 'meta_analysis'
      WHEN o_orderpriority[1] = '2' THEN 'systematic_review'
      WHEN o_orderpriority[1] = '3' THEN 'case_report'
      WHEN o_orderpriority[1] = '4' THEN 'cohort_study'
      WHEN o_orderkey % 2 = 0 THEN '' END AS study_design,
    CASE c_custkey % 4 WHEN 1 THEN 'Female' WHEN 2 THEN ' male ' WHEN 3 THEN '' END AS sex,
    CASE WHEN c_custkey % 6 <> 0 THEN c_mktsegment END AS age_group,
    CASE c_nationkey % 3 WHEN 1 THEN '' WHEN 2
      THEN 'Stage ' || CAST(c_nationkey AS VARCHAR) END AS disease_stage,
    CAST(c_custkey % 500 AS INTEGER) AS sample_size,
    CASE WHEN o_orderkey % 211 = 0 THEN 1.5
      ELSE CAST(o_orderkey % 101 AS DOUBLE) / 100.0 END AS extraction_confidence,
    CASE o_orderkey % 10 WHEN 0 THEN 'RateLimitError' WHEN 5 THEN '' END AS extraction_error,
    CAST(o_orderdate AS TIMESTAMP) AS extracted_ts
  FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus <> 'P'""",
    "line_extractions": f"""
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS pubmed_id,
    CASE WHEN (l_orderkey + l_linenumber) % 7 <> 0 THEN [
      {{'treatment': CASE WHEN (l_orderkey + l_linenumber) % 2 = 0 THEN lower(p_type)
        ELSE p_type END, 'outcome': p_brand,
        'effect_direction': {direction('l_orderkey + l_linenumber')}}},
      {{'treatment': p_brand, 'outcome': p_name,
        'effect_direction': {direction('l_orderkey + l_linenumber + 1')}}},
      {{'treatment': CASE WHEN (l_orderkey + l_linenumber) % 5 = 0 THEN '' ELSE p_name END,
        'outcome': p_type,
        'effect_direction': {direction('l_orderkey + l_linenumber + 2')}}}]
      END AS treatment_outcomes,
    CASE l_suppkey % 3 WHEN 1 THEN 'female' WHEN 2 THEN '' END AS sex,
    CASE l_partkey % 3 WHEN 1 THEN '' WHEN 2 THEN 'stage IV' END AS disease_stage,
    CASE WHEN (l_orderkey + l_linenumber) % 10 = 0 THEN 'RateLimitError' END AS extraction_error,
    CAST(l_shipdate AS TIMESTAMP) AS extracted_ts
  FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "line_articles": """
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS pubmed_id,
    CASE WHEN (l_orderkey + l_linenumber) % 19 <> 0 THEN [
      upper(split_part(p_name, ' ', 1)), split_part(p_name, ' ', 2), p_brand,
      'size ' || CAST(p_size AS VARCHAR),
      CASE WHEN (l_orderkey + l_linenumber) % 2 = 0 THEN p_type
        ELSE split_part(p_name, ' ', 1) END] END AS mesh_terms,
    row_number() OVER () AS row_no
  FROM lineitem JOIN part ON l_partkey = p_partkey""",
    # unnested pairs of successful line extractions, with their place in the row
    "line_pairs": """
  SELECT pubmed_id, sex, disease_stage, extracted_ts, i AS pos,
    lower(treatment_outcomes[i].treatment) AS treatment,
    lower(treatment_outcomes[i].outcome) AS outcome,
    treatment_outcomes[i].effect_direction AS effect_direction
  FROM line_extractions, (SELECT unnest([1, 2, 3]) AS i)
  WHERE extraction_error IS NULL AND treatment_outcomes IS NOT NULL""",
    "matrix": """
  SELECT treatment, outcome, count(*) AS frequency,
    count(*) FILTER (WHERE effect_direction = 'positive') AS positive,
    count(*) FILTER (WHERE effect_direction = 'negative') AS negative,
    count(*) FILTER (WHERE effect_direction = 'neutral') AS neutral,
    count(*) FILTER (WHERE effect_direction = 'mixed') AS mixed
  FROM line_pairs GROUP BY treatment, outcome""",
    # the last pair written decides all attributes of an edge
    "links": """
  SELECT treatment AS source, outcome AS target,
    last(effect_direction ORDER BY extracted_ts, pubmed_id, pos) AS effect_direction,
    last(coalesce(nullif(disease_stage, ''), nullif(sex, ''), 'general')
      ORDER BY extracted_ts, pubmed_id, pos) AS population,
    last(pubmed_id ORDER BY extracted_ts, pubmed_id, pos) AS pubmed_id
  FROM line_pairs WHERE treatment <> '' AND outcome <> '' GROUP BY 1, 2""",
    "nodes": """
  SELECT id, last(type ORDER BY extracted_ts, pubmed_id, pos, role) AS type FROM (
    SELECT treatment AS id, 'treatment' AS type, 0 AS role, extracted_ts, pubmed_id, pos
    FROM line_pairs WHERE treatment <> '' AND outcome <> ''
    UNION ALL SELECT outcome, 'outcome', 1, extracted_ts, pubmed_id, pos
    FROM line_pairs WHERE treatment <> '' AND outcome <> '') GROUP BY id""",
    "term_pairs": """
  SELECT a.term AS term_a, b.term AS term_b, count(*) AS co_occurrence_count
  FROM article_terms a JOIN article_terms b ON a.row_no = b.row_no AND a.term < b.term
  GROUP BY 1, 2""",
    "article_terms": """
  SELECT DISTINCT row_no, lower(unnest(mesh_terms)) AS term
  FROM line_articles WHERE mesh_terms IS NOT NULL""",
    "geography": r"""
  SELECT regexp_replace(country, '^\s+|\s+$', '', 'g') AS country,
    count(DISTINCT pubmed_id) AS article_count,
    CAST(min(year(pub_date)) AS INTEGER) AS earliest_year,
    CAST(max(year(pub_date)) AS INTEGER) AS latest_year
  FROM authors JOIN articles USING (pubmed_id)
  WHERE country IS NOT NULL AND trim(country) <> '' GROUP BY 1""",
    "funding": """
  SELECT trim(agency) AS agency, count(*) AS article_count,
    count(DISTINCT pubmed_id) AS distinct_article_count,
    coalesce(first(trim(country) ORDER BY pubmed_id, l_linenumber, l_partkey, l_suppkey)
        FILTER (WHERE trim(country) <> ''),
      CASE WHEN bool_or(country <> '' AND trim(country) = '') THEN '' END) AS country,
    CAST(min(year(pub_date)) AS INTEGER) AS earliest_year,
    CAST(max(year(pub_date)) AS INTEGER) AS latest_year
  FROM grants JOIN articles USING (pubmed_id)
  WHERE agency IS NOT NULL AND trim(agency) <> '' GROUP BY 1""",
    "profile": r"""
  SELECT d.dimension_no, d.dimension, c.label, coalesce(c.n, 0) AS count
  FROM (VALUES (0, 'age_group'), (1, 'sex'), (2, 'disease_severity')) d(dimension_no, dimension)
  LEFT JOIN (
    SELECT dimension, lower(regexp_replace(value, '^\s+|\s+$', '', 'g')) AS label, count(*) AS n
    FROM (SELECT 'age_group' AS dimension, age_group AS value, extraction_error FROM extractions
      UNION ALL SELECT 'sex', sex, extraction_error FROM extractions)
    WHERE extraction_error IS NULL AND trim(value) <> '' GROUP BY 1, 2) c
  ON d.dimension = c.dimension""",
    # what the record files of the documents hold
    "doc_records": rf"""
  SELECT doc_id, CAST(doc_id AS VARCHAR) AS pubmed_id, lang, source,
    regexp_replace(text, '[\x00-\x08\x0B-\x1F\x{{FFFE}}\x{{FFFF}}]', '', 'g') AS clean,
    printf('pubmed26n%04d.xml.gz', 1200 + doc_id // {DOCUMENTS_PER_FILE}) AS source_file,
    doc_id % 29 <> 0 AS has_id, doc_id % 31 <> 5 AS well_formed
  FROM documents""",
    "doc_fields": r"""
  SELECT *,
    CASE WHEN doc_id % 2 = 0 THEN 'Report of' ELSE 'Adenomyosis <' || source || '>' END AS title,
    nullif(concat_ws(' ',
      'BACKGROUND: ' || nullif(regexp_replace(substring(clean, 1, 40), {edge}, '', 'g'), ''),
      nullif(regexp_replace(substring(clean, 41), {edge}, '', 'g'), '')), '') AS abstract,
    'J & ' || source AS journal,
    CASE doc_id % 5 WHEN 0 THEN DATE '2019-12-28' WHEN 1 THEN DATE '2017-07-09'
      WHEN 2 THEN DATE '2016-01-01' WHEN 4 THEN DATE '2015-12-01' END AS pub_date,
    CASE WHEN doc_id % 6 = 0 THEN [lang, 'Endometriosis'] ELSE [lang] END AS mesh_terms,
    doc_id % 6 = 0 OR doc_id % 2 = 1 OR regexp_matches(lower(clean),
      'endometriosis|endometrioma|endometriotic|adenomyosis') AS relevant
  FROM doc_records""".replace("{edge}", r"'^[\t-\r\x{85}\p{Z}]+|[\t-\r\x{85}\p{Z}]+$'"),
    "doc_articles": f"""
  SELECT CAST(doc_id AS VARCHAR) AS pubmed_id,
    CASE WHEN doc_id % 10 = 0 THEN 'On Adenomyosis' ELSE source END AS title,
    CASE WHEN doc_id % 23 <> 0 THEN text END AS abstract,
    [lang, CASE WHEN doc_id % 6 = 0 THEN 'ENDOMETRIOSIS' WHEN doc_id % 7 <> 0 THEN 'Pain' END]
      AS mesh_terms,
    printf('pubmed26n%04d.xml.gz', 1200 + doc_id // {DOCUMENTS_PER_FILE}) AS source_file
  FROM documents""",
}
# Which other tables a table is made from.
NEEDS = {
    "line_pairs": ["line_extractions"],
    "matrix": ["line_pairs"],
    "links": ["line_pairs"],
    "nodes": ["line_pairs"],
    "article_terms": ["line_articles"],
    "term_pairs": ["article_terms"],
    "geography": ["authors", "articles"],
    "funding": ["grants", "articles"],
    "profile": ["extractions"],
    "doc_fields": ["doc_records"],
}


def with_tables(names: str, query: str, recursive: bool = False) -> str:
    """``query`` after the table expressions ``names`` (blank-separated) and what they need."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for other in NEEDS.get(name, []):
            add(other)
        if name not in ordered:
            ordered.append(name)

    for name in names.split():
        add(name)
    tables = ",\n".join(f"{n} AS MATERIALIZED ({TABLES[n]})" for n in ordered)
    return f"WITH {'RECURSIVE ' if recursive else ''}{tables}\n{query}"
