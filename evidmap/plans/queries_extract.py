"""Catalogue: structured extraction (E) and embeddings (M)."""

from __future__ import annotations

from pyspark.sql import functions as F

from evidmap.operators import embed, extract
from evidmap.plans.catalog import query
from evidmap.plans.oracle import with_tables
from evidmap.plans.queries_ingest import WORD_RULES
from evidmap.sources import testdata

# ---- E1: an answer per order, in all its variants ---------------------------------

_ANSWERS = {
    0: "{not json",
    1: '{"study_design": "trial", "treatments": ["{s}"]}',
    2: '{"treatment_outcomes": [{"treatment": "{s}", "outcome": "o", "effect_direction": null}]}',
    3: '{"extraction_confidence": 1.5, "treatments": ["{s}"]}',
    4: '{"population": {"sample_size": "many"}}',
    5: '{"population": {"sample_size": "100", "sex": "{s}"}, "extraction_confidence": "0.5"}',
    6: '{"treatments": null, "outcomes": null, "treatment_outcomes": null, "population": null}',
    7: (
        '{"treatment_outcomes": [{"treatment": "", "outcome": "x"}, '
        '{"treatment": "{s}", "outcome": "{p}"}, {"outcome": "y"}], "study_design": ""}'
    ),
    8: '{"extraction_error": "LLM timeout", "treatments": [], "extraction_confidence": null}',
    9: (
        '{"treatments": ["{s}", "b"], "outcomes": ["{p}"], "treatment_outcomes": '
        '[{"treatment": "{s}", "outcome": "{p}", "effect_direction": "negative"}, '
        '{"treatment": "b", "outcome": "{p}", "effect_direction": "mixed"}], '
        '"study_design": "cohort_study", "population": {"sex": "female", "age_group": null, '
        '"disease_stage": "III-IV", "sample_size": 100, "special_population": null}, '
        '"extraction_confidence": 0.92}'
    ),
    10: '{"population": {"sample_size": 99999999999}, "treatments": ["{s}"]}',
    11: '{"population": {"sample_size": "2147483648.0"}, "study_design": "other"}',
}


def _answers(spark, folder):
    orders = testdata.table(spark, folder, "orders", heavy=True)
    kinds = F.array(*[F.lit(a) for a in _ANSWERS.values()])
    answer = F.element_at(kinds, (F.col("o_orderkey") % len(_ANSWERS) + 1).cast("int"))
    answer = F.replace(answer, F.lit("{s}"), F.col("o_orderstatus"))
    answer = F.replace(answer, F.lit("{p}"), F.col("o_orderpriority"))
    return orders.select(F.col("o_orderkey").cast("string").alias("pubmed_id"), answer.alias("answer"))


def _flat(df):
    pair = F.transform(
        "treatment_outcomes",
        lambda p: F.concat(p["treatment"], F.lit(">"), p["outcome"], F.lit(":"), p["effect_direction"]),
    )
    return df.select(
        "pubmed_id",
        F.array_join("treatments", "|").alias("treatments"),
        F.array_join("outcomes", "|").alias("outcomes"),
        F.array_join(pair, "|").alias("treatment_outcomes"),
        "study_design",
        F.col("population.sex").alias("sex"),
        F.col("population.disease_stage").alias("disease_stage"),
        F.col("population.sample_size").alias("sample_size"),
        "extraction_confidence",
        "extraction_error",
    )


@query(
    "e1_parse_extraction",
    """SELECT CAST(o_orderkey AS VARCHAR) AS pubmed_id,
  CASE v WHEN 9 THEN o_orderstatus || '|b' ELSE '' END AS treatments,
  CASE v WHEN 9 THEN o_orderpriority ELSE '' END AS outcomes,
  CASE v WHEN 7 THEN o_orderstatus || '>' || o_orderpriority || ':unknown'
    WHEN 9 THEN o_orderstatus || '>' || o_orderpriority || ':negative|b>' || o_orderpriority || ':mixed'
    ELSE '' END AS treatment_outcomes,
  CASE v WHEN 9 THEN 'cohort_study' ELSE 'unknown' END AS study_design,
  CASE v WHEN 5 THEN o_orderstatus WHEN 9 THEN 'female' END AS sex,
  CASE v WHEN 9 THEN 'III-IV' END AS disease_stage,
  CAST(CASE WHEN v IN (5, 9) THEN 100 END AS INTEGER) AS sample_size,
  CAST(CASE v WHEN 5 THEN 0.5 WHEN 9 THEN 0.92 ELSE 0.0 END AS DOUBLE) AS extraction_confidence,
  CASE v WHEN 0 THEN 'validation: answer' WHEN 1 THEN 'validation: study_design'
    WHEN 2 THEN 'validation: effect_direction' WHEN 3 THEN 'validation: extraction_confidence'
    WHEN 4 THEN 'validation: sample_size' WHEN 10 THEN 'validation: sample_size'
    WHEN 11 THEN 'validation: sample_size' WHEN 8 THEN 'LLM timeout' END AS extraction_error
FROM (SELECT *, o_orderkey % 12 AS v FROM orders)""",
)
def e1(spark, folder):
    return _flat(extract.parse_extractions(_answers(spark, folder)))


# ---- E2 -----------------------------------------------------------------------------

MIN_WORDS = 30


@query(
    "e2_apply_extractor",
    with_tables(
        "doc_articles",
        f""", words AS (SELECT pubmed_id, string_split(abstract, ' ') AS w FROM doc_articles
  WHERE abstract IS NOT NULL)
SELECT pubmed_id, CASE WHEN len(w) >= {MIN_WORDS} THEN w[1] ELSE '' END AS treatments,
  CASE WHEN len(w) >= {MIN_WORDS} THEN w[len(w)] ELSE '' END AS outcomes,
  CASE WHEN len(w) >= {MIN_WORDS} THEN 'other' ELSE 'unknown' END AS study_design,
  CASE WHEN len(w) < {MIN_WORDS} THEN 'only ' || len(w) || ' words' END AS extraction_error
FROM words""",
    ),
)
def e2(spark, folder):
    def first_and_last_word(abstract: str) -> dict:
        """A stand-in for the caller's extractor: needs ``MIN_WORDS`` words."""
        words = abstract.split(" ")
        if len(words) < MIN_WORDS:
            raise ValueError(f"only {len(words)} words")
        return {"treatments": [words[0]], "outcomes": [words[-1]], "study_design": "other"}

    # defined here, the function travels to the executors by value
    abstracts = testdata.doc_articles(spark, folder).where(F.col("abstract").isNotNull())
    found = _flat(extract.apply_extractor(abstracts, first_and_last_word))
    return found.select("pubmed_id", "treatments", "outcomes", "study_design", "extraction_error")


# ---- E3: words between double blanks, so that matches never share a blank ------------


def _any(text: str, cues) -> str:
    names = "|".join(c.replace(" ", "  ") for c in sorted(cues, key=lambda c: (-len(c), c)))
    return f"regexp_matches({text}, ' (?:{names}) ')"


def _named(text: str, terms) -> str:
    names = "|".join(t.replace(" ", "  ") for t in sorted(terms, key=lambda t: (-len(t), t)))
    found = f"regexp_extract_all({text}, ' ({names}) ', 1)"
    # the names of WORD_RULES are the terms themselves
    return f"list_transform({found}, lambda t: replace(t, '  ', ' '))"


_DESIGN = " ".join(f"WHEN {_any('t', cues)} THEN '{name}'" for name, cues in WORD_RULES.designs)
_SUBJECTS = "|".join(WORD_RULES.subjects)
_E3 = f"""
, texts AS (
  SELECT pubmed_id, abstract,
    '  ' || trim(regexp_replace(lower(abstract), '[^\\p{{L}}\\p{{N}}]+', '  ', 'g')) || '  ' AS t
  FROM doc_articles WHERE abstract IS NOT NULL),
sentences AS (
  SELECT pubmed_id, '  ' || trim(regexp_replace(lower(s), '[^\\p{{L}}\\p{{N}}]+', '  ', 'g')) || '  ' AS s
  FROM (SELECT pubmed_id,
    unnest(regexp_split_to_array(abstract, '[.!?]+(?:[\\t-\\r ]+|$)|[\\r\\n]+')) AS s FROM texts)),
tagged AS (
  SELECT pubmed_id, {_named('s', WORD_RULES.treatments)} AS treatments,
    {_named('s', WORD_RULES.outcomes)} AS outcomes,
    CASE WHEN {_any('s', WORD_RULES.neutral)} THEN 'neutral'
      WHEN {_any('s', WORD_RULES.positive)} AND {_any('s', WORD_RULES.negative)} THEN 'mixed'
      WHEN {_any('s', WORD_RULES.positive)} THEN 'positive'
      WHEN {_any('s', WORD_RULES.negative)} THEN 'negative' ELSE 'unknown' END AS direction
  FROM sentences),
found AS (
  SELECT pubmed_id, 'treatment' AS kind, unnest(treatments) AS a, '' AS b, '' AS c FROM tagged
  UNION SELECT pubmed_id, 'outcome', unnest(outcomes), '', '' FROM tagged
  UNION SELECT pubmed_id, 'pair', a, unnest(outcomes), direction FROM (
    SELECT pubmed_id, unnest(treatments) AS a, outcomes, direction FROM tagged)
  UNION SELECT pubmed_id, 'design',
    CASE {_DESIGN} ELSE 'unknown' END, '', '' FROM texts
  UNION SELECT pubmed_id, 'sex', CASE WHEN {_any('t', WORD_RULES.female)} THEN 'female'
    WHEN {_any('t', WORD_RULES.male)} THEN 'male' ELSE '' END, '', '' FROM texts
  UNION SELECT pubmed_id, 'sample_size',
    coalesce(CAST(CAST(nullif(regexp_extract(t, ' (\\d{{1,9}})  (?:{_SUBJECTS}) ', 1), '')
      AS INTEGER) AS VARCHAR), ''), '', '' FROM texts)
SELECT * FROM found"""


@query("e3_tag_abstracts", with_tables("doc_articles", _E3))
def e3(spark, folder):
    """All findings of the tagger, one per row."""
    abstracts = testdata.doc_articles(spark, folder).where(F.col("abstract").isNotNull())
    tagged = extract.tag_abstracts(abstracts, WORD_RULES)
    nothing = F.lit("")

    def finding(kind, a, b=nothing, c=nothing):
        return F.struct(F.lit(kind).alias("kind"), a.alias("a"), b.alias("b"), c.alias("c"))

    rows = F.concat(
        F.transform("treatments", lambda t: finding("treatment", t)),
        F.transform("outcomes", lambda t: finding("outcome", t)),
        F.transform(
            "treatment_outcomes",
            lambda p: finding("pair", p["treatment"], p["outcome"], p["effect_direction"]),
        ),
        F.array(
            finding("design", F.col("study_design")),
            finding("sex", F.coalesce("population.sex", nothing)),
            finding(
                "sample_size",
                F.coalesce(F.col("population.sample_size").cast("string"), nothing),
            ),
        ),
    )
    return tagged.select("pubmed_id", F.inline(rows))


# ---- E3, clause by clause: all terms are single words, so that words can be joined ------

SCOPED_RULES = extract.TagRules(
    treatments={w: w for w in ("with", "by", "les", "und", "from")},
    outcomes={w: w for w in ("that", "pour", "nicht", "for", "que", "it")},
    positive=("is", "de", "den"),
    negative=("la", "der", "this"),
    neutral=("une", "than"),
    rises=("to", "des", "zu"),
    falls=("in", "le", "die"),
    wanted=("that", "pour", "que"),
    unwanted=("nicht", "for"),
    negators=("a", "et", "von"),
    breaks=("and", "en", "auf"),
    designs=(),
    female=("she", "elle"),
    male=("he", "il"),
    subjects=("the", "of", "and"),
    age_groups={w: w for w in ("was", "el")},
    stages={w: w for w in ("on", "un")},
    special_populations={w: w for w in ("are", "mit", "los")},
)


def _in(words) -> str:
    return ", ".join(f"'{w}'" for w in words)


_KINDS = {
    "treatment": SCOPED_RULES.treatments,
    "outcome": SCOPED_RULES.outcomes,
    "good": SCOPED_RULES.positive,
    "bad": SCOPED_RULES.negative,
    "neutral": SCOPED_RULES.neutral,
    "rise": SCOPED_RULES.rises,
    "fall": SCOPED_RULES.falls,
    "negator": SCOPED_RULES.negators,
    "break": SCOPED_RULES.breaks,
    "age_group": SCOPED_RULES.age_groups,
    "disease_stage": SCOPED_RULES.stages,
    "special_population": SCOPED_RULES.special_populations,
}
_SCOPED = r"""
, sentences AS (
  SELECT pubmed_id, s, generate_subscripts(parts, 1) AS number, unnest(parts) AS line
  FROM (SELECT pubmed_id, abstract AS s, regexp_split_to_array(lower(abstract), '[.!?]+(?:[\t-\r ]+|$)|[\r\n]+') AS parts
    FROM doc_articles WHERE abstract IS NOT NULL)),
words AS (
  SELECT pubmed_id, number, unnest(w) AS word, generate_subscripts(w, 1) AS pos
  FROM (SELECT pubmed_id, number, regexp_extract_all(line, '[\p{L}\p{N}]+') AS w FROM sentences)),
meaning(word, kind) AS (VALUES <MEANING>),
tokens AS (
  SELECT *, count(*) FILTER (kind = 'break') OVER (PARTITION BY pubmed_id, number ORDER BY pos) AS clause
  FROM words JOIN meaning USING (word)),
negators AS (
  SELECT *, pos - max(pos) FILTER (kind = 'negator') OVER (
    PARTITION BY pubmed_id, number, clause ORDER BY pos) - 1 < <SCOPE> AS negated
  FROM tokens),
told AS (
  SELECT *, kind = 'outcome' AS is_outcome,
    lag(kind = 'outcome') OVER clause_order AS was_outcome,
    first_value(kind = 'outcome') OVER clause_order AS follow
  FROM negators WHERE kind IN ('outcome', 'good', 'bad', 'rise', 'fall', 'neutral')
  WINDOW clause_order AS (PARTITION BY pubmed_id, number, clause ORDER BY pos)),
grouped AS (
  SELECT *, count(*) FILTER (was_outcome IS NOT NULL AND was_outcome <> is_outcome AND is_outcome = follow) OVER (
    PARTITION BY pubmed_id, number, clause ORDER BY pos) AS part
  FROM told),
owned AS (
  SELECT *, CASE
    WHEN follow AND is_outcome AND NOT bool_or(NOT is_outcome) OVER same_part THEN part - 1
    WHEN NOT follow AND NOT is_outcome AND NOT bool_or(is_outcome) OVER same_part THEN part - 1
    ELSE part END AS own
  FROM grouped
  WINDOW same_part AS (PARTITION BY pubmed_id, number, clause, part)),
effects AS (
  SELECT o.pubmed_id, o.number, o.clause, o.pos, o.word AS outcome,
    CASE WHEN c.kind IS NULL THEN NULL
      WHEN c.kind = 'neutral' OR c.negated THEN 0
      WHEN c.kind = 'good' THEN 1 WHEN c.kind = 'bad' THEN -1
      WHEN o.word IN (<WANTED>) THEN CASE c.kind WHEN 'rise' THEN 1 ELSE -1 END
      WHEN o.word IN (<UNWANTED>) THEN CASE c.kind WHEN 'rise' THEN -1 ELSE 1 END END AS effect
  FROM owned o LEFT JOIN (SELECT * FROM owned WHERE NOT is_outcome) c
    ON o.pubmed_id = c.pubmed_id AND o.number = c.number AND o.clause = c.clause AND o.own = c.own
  WHERE o.is_outcome),
directions AS (
  SELECT pubmed_id, number, clause, pos, outcome,
    CASE WHEN bool_or(effect = 0) THEN 'neutral'
      WHEN bool_or(effect = 1) AND bool_or(effect = -1) THEN 'mixed'
      WHEN bool_or(effect = 1) THEN 'positive' WHEN bool_or(effect = -1) THEN 'negative'
      ELSE 'unknown' END AS direction
  FROM effects GROUP BY ALL),
treated AS (SELECT DISTINCT pubmed_id, number, clause, word AS treatment FROM tokens WHERE kind = 'treatment'),
sources AS (
  SELECT d.*, (SELECT max(clause) FROM treated t
    WHERE t.pubmed_id = d.pubmed_id AND t.number = d.number AND t.clause <= d.clause) AS source
  FROM directions d),
pairs AS (
  SELECT s.pubmed_id, t.treatment, s.outcome,
    CASE count(DISTINCT direction) FILTER (direction <> 'unknown') WHEN 0 THEN 'unknown'
      WHEN 1 THEN min(direction) FILTER (direction <> 'unknown') ELSE 'mixed' END AS direction
  FROM sources s JOIN treated t ON s.pubmed_id = t.pubmed_id AND s.number = t.number
    AND (t.clause = s.source OR s.source IS NULL)
  GROUP BY ALL),
fields AS (
  SELECT pubmed_id, kind, arg_min(word, number * 1000000 + pos) AS word
  FROM tokens WHERE kind IN ('age_group', 'disease_stage', 'special_population') GROUP BY ALL),
texts AS (
  SELECT pubmed_id, '  ' || trim(regexp_replace(lower(abstract), '[^\p{L}\p{N}]+', '  ', 'g')) || '  ' AS t
  FROM doc_articles WHERE abstract IS NOT NULL)
SELECT DISTINCT pubmed_id, kind, word AS a, '' AS b, '' AS c FROM tokens WHERE kind IN ('treatment', 'outcome')
UNION ALL SELECT pubmed_id, 'pair', treatment, outcome, direction FROM pairs
UNION ALL SELECT pubmed_id, kind, word, '', '' FROM fields
UNION ALL SELECT pubmed_id, 'sex', CASE WHEN regexp_matches(t, ' (?:<FEMALE>) ') THEN 'female' ELSE 'male' END, '', ''
  FROM texts WHERE regexp_matches(t, ' (?:<FEMALE>|<MALE>) ')
UNION ALL SELECT pubmed_id, 'sample_size',
  CAST(CAST(regexp_extract(t, ' (\d{1,9})  (?:<SUBJECTS>) ', 1) AS INTEGER) AS VARCHAR), '', ''
  FROM texts WHERE regexp_matches(t, ' (\d{1,9})  (?:<SUBJECTS>) ')"""
for _name, _value in {
    "MEANING": ", ".join(f"('{w}', '{kind}')" for kind, words in _KINDS.items() for w in words),
    "SCOPE": str(SCOPED_RULES.scope),
    "WANTED": _in(SCOPED_RULES.wanted),
    "UNWANTED": _in(SCOPED_RULES.unwanted),
    "FEMALE": "|".join(SCOPED_RULES.female),
    "MALE": "|".join(SCOPED_RULES.male),
    "SUBJECTS": "|".join(SCOPED_RULES.subjects),
}.items():
    _SCOPED = _SCOPED.replace(f"<{_name}>", _value)


@query("e3_scoped_tags", with_tables("doc_articles", _SCOPED))
def e3_scoped(spark, folder):
    """Findings with the effect read clause by clause, and all fields of the population."""
    abstracts = testdata.doc_articles(spark, folder).where(F.col("abstract").isNotNull())
    tagged = extract.tag_abstracts(abstracts, SCOPED_RULES)

    def finding(kind, a, b=F.lit(""), c=F.lit("")):
        return F.struct(F.lit(kind).alias("kind"), a.alias("a"), b.alias("b"), c.alias("c"))

    names = ("sex", "age_group", "disease_stage", "sample_size", "special_population")
    fields = F.array(*[finding(n, F.col(f"population.{n}").cast("string")) for n in names])
    rows = F.concat(
        F.transform("treatments", lambda t: finding("treatment", t)),
        F.transform("outcomes", lambda t: finding("outcome", t)),
        F.transform(
            "treatment_outcomes",
            lambda p: finding("pair", p["treatment"], p["outcome"], p["effect_direction"]),
        ),
        F.filter(fields, lambda f: f["a"].isNotNull()),
    )
    return tagged.select("pubmed_id", F.inline(rows))


@query(
    "e4_extraction_summary",
    with_tables(
        "extractions",
        """SELECT count(*) AS total_processed,
  count(*) FILTER (WHERE coalesce(extraction_error, '') = '') AS successful,
  count(*) FILTER (WHERE extraction_error <> '') AS errors,
  round(count(*) FILTER (WHERE extraction_error <> '') / greatest(count(*), 1), 3) AS failure_rate
FROM extractions""",
    ),
)
def e4(spark, folder):
    return extract.extraction_summary(testdata.extractions(spark, folder))


# ---- embeddings -----------------------------------------------------------------------

M2_RADIUS = 0.02
M2_MIN_POINTS = 8


@query(
    "m1_text_embeddings",
    with_tables(
        "doc_articles",
        """SELECT pubmed_id, CAST(256 AS INTEGER) AS dimensions, CAST(1.0 AS DOUBLE) AS length
FROM doc_articles WHERE abstract IS NOT NULL""",
    ),
)
def m1(spark, folder):
    """Every abstract has one vector of length 1; the values are tested against numpy."""
    vectors = embed.text_embeddings(testdata.doc_articles(spark, folder))
    squares = F.aggregate(
        F.transform("embedding", lambda v: v.cast("double") * v.cast("double")),
        F.lit(0.0),
        lambda total, v: total + v,
    )
    return vectors.select(
        "pubmed_id",
        F.size("embedding").alias("dimensions"),
        F.round(F.sqrt(squares), 3).alias("length"),
    )


def _vectors(spark, folder):
    return testdata.table(spark, folder, "embeddings").select(
        F.col("vec_id").cast("string").alias("pubmed_id"), "embedding"
    )


@query("m2_cluster_embeddings")
def m2(spark, folder):
    """Projection and clustering; the sign and solver of the axes have no SQL."""
    return embed.cluster_embeddings(_vectors(spark, folder), 0.05, M2_MIN_POINTS)


_CELL = f"""(CAST(floor(x / {M2_RADIUS}) AS BIGINT) + 1073741824) * 2147483648
  + CAST(floor(y / {M2_RADIUS}) AS BIGINT) + 1073741824"""


@query(
    "m2_density_clusters",
    f"""WITH RECURSIVE points AS (
  SELECT *, {_CELL} AS cell FROM (SELECT CAST(vec_id AS VARCHAR) AS pubmed_id,
    CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y FROM embeddings)),
cells AS (SELECT cell, count(*) AS n FROM points GROUP BY cell),
steps AS (SELECT a * 2147483648 + b AS step FROM (SELECT unnest([-1, 0, 1]) AS a),
  (SELECT unnest([-1, 0, 1]) AS b)),
near AS (SELECT c.cell, sum(d.n) AS n FROM cells c, steps, cells d
  WHERE d.cell = c.cell + step GROUP BY c.cell),
core AS (SELECT cell FROM near WHERE n >= {M2_MIN_POINTS}),
reach AS (SELECT cell, cell AS start FROM core
  UNION SELECT d.cell, r.start FROM reach r, steps, core d WHERE d.cell = r.cell + step),
core_label AS (SELECT cell, min(start) AS label FROM reach GROUP BY cell),
label AS (SELECT c.cell, coalesce(any_value(own.label), min(l.label)) AS label
  FROM cells c, steps, core_label l LEFT JOIN core_label own ON own.cell = c.cell
  WHERE l.cell = c.cell + step GROUP BY c.cell),
large AS (SELECT label, row_number() OVER (ORDER BY label) - 1 AS cluster
  FROM (SELECT label FROM label JOIN cells USING (cell) GROUP BY label HAVING sum(n) >= 10))
SELECT pubmed_id, x, y, coalesce(cluster, -1) AS cluster
FROM points LEFT JOIN label USING (cell) LEFT JOIN large USING (label)""",
)
def m2_density(spark, folder):
    points = _vectors(spark, folder).select(
        "pubmed_id",
        F.col("embedding")[0].cast("double").alias("x"),
        F.col("embedding")[1].cast("double").alias("y"),
    )
    return embed.density_clusters(points, M2_RADIUS, M2_MIN_POINTS)
