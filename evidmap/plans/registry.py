"""B2: named analytics. Add an entry to have a job compute and save one more."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from evidmap.operators import evidence, graph

Tables = dict[str, DataFrame]
Analytic = Callable[[Tables], DataFrame]

ANALYTICS: dict[str, Analytic] = {
    "treatment_outcome_matrix": lambda t: evidence.treatment_outcome_matrix(t["extractions"]),
    "study_design_trends": lambda t: evidence.study_design_maps(t["articles"], t["extractions"]),
    "publication_trend_analysis": lambda t: evidence.publication_trends(
        t["articles"], t["extractions"]
    ),
    "mesh_cooccurrence_network": lambda t: evidence.mesh_cooccurrence(t["articles"]),
    "research_geography_analysis": lambda t: evidence.research_geography(
        t["authors"], t["articles"]
    ),
    # the saved graph is its nodes, as its row count is; the links go beside it
    "knowledge_graph_data": lambda t: graph.graph_nodes(t["extractions"]),
    "knowledge_graph_links": lambda t: graph.graph_links(t["extractions"]),
    "patient_population_profiling": lambda t: evidence.population_profile(t["extractions"]),
    "funding_landscape_analysis": lambda t: evidence.funding_landscape(
        t["grants"], t["articles"]
    ),
}


def register(name: str, analytic: Analytic) -> None:
    ANALYTICS[name] = analytic
