"""Table schemas and closed value sets."""

from __future__ import annotations

# The closed vocabularies of the extraction answer.
STUDY_DESIGNS = (
    "randomized_controlled_trial",
    "cohort_study",
    "case_control",
    "meta_analysis",
    "systematic_review",
    "case_report",
    "narrative_review",
    "cross_sectional",
    "other",
    "unknown",
)
EFFECT_DIRECTIONS = ("positive", "negative", "neutral", "mixed", "unknown")
REVIEW_DESIGNS = ("systematic_review", "meta_analysis", "narrative_review")

# What makes a record relevant by default.
CONDITION_TERMS = ("D004715", "Endometriosis")
CONDITION_KEYWORDS = ("endometriosis", "endometrioma", "endometriotic", "adenomyosis")

AUTHOR = "struct<last_name:string,fore_name:string,affiliation:string,country:string>"
GRANT = "struct<grant_id:string,agency:string,country:string>"
PAIR = "struct<treatment:string,outcome:string,effect_direction:string>"
POPULATION = (
    "struct<sex:string,age_group:string,disease_stage:string,"
    "sample_size:int,special_population:string>"
)

ARTICLE = (
    f"pubmed_id string, title string, abstract string, authors array<{AUTHOR}>, "
    f"journal string, pub_date date, mesh_terms array<string>, grants array<{GRANT}>, "
    "source_file string, language string, publication_types array<string>, "
    "ingestion_ts timestamp"
)
EXTRACTED = (
    "treatments array<string>, outcomes array<string>, "
    f"treatment_outcomes array<{PAIR}>, study_design string, population {POPULATION}, "
    "extraction_confidence double"
)
EXTRACTION = f"pubmed_id string, {EXTRACTED}, extraction_error string, extracted_ts timestamp"
FILE_REPORT = (
    "file_name string, total_parsed bigint, filtered bigint, inserted bigint, status string"
)
MANIFEST = "file_name string, md5_checksum string, record_count bigint, ingest_ts timestamp"

EXTRACTION_FIELDS = (
    "treatments",
    "outcomes",
    "treatment_outcomes",
    "study_design",
    "population",
    "extraction_confidence",
    "extraction_error",
)
