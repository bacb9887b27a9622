"""The full route-recommendation pipeline as one DataFrame lineage.

trips --A1--> pair frequency --N10--> path frequency --A9--> coverage
      --T3/J2--> top-k readable routes --R2--> coverage percentage

Materialised (checkpointed) are only tables bounded by the zones: the pair
frequency, the edge table, each shortest-path round, the path frequency, the
coverage and the top-k.  Pairs without a path are kept apart
(``RouteReport.unreachable``).  Nothing is collected to the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from routecov.operators import coverage as cov
from routecov.operators import frequency as fq
from routecov.operators import graph as gr
from routecov.operators import recommend as rec
from routecov.operators import shortest_path as sp
from routecov.session import cut_lineage

# The reference's top-k settings (k routes, at least m stops).
DEFAULT_K = 10000
DEFAULT_M = 2


@dataclass
class RouteReport:
    trip_frequency: DataFrame
    path_frequency: DataFrame
    coverage: DataFrame
    routes: DataFrame
    route_percentage: DataFrame

    unreachable: DataFrame


def recommend_routes(trips: DataFrame, edges: DataFrame, lookup: DataFrame,
                     zones: DataFrame | None = None, isolated: DataFrame | None = None,
                     k: int = DEFAULT_K, m: int = DEFAULT_M,
                     containment: str = cov.SUBSEQUENCE, short_names: bool = True) -> RouteReport:
    """Run the pipeline.  ``zones`` defaults to the graph's nodes (the
    reference asserts the two are the same set)."""
    if zones is None:
        zones = gr.nodes(edges).select(F.col("node").alias("location_id"))
    freq = cut_lineage(fq.trip_frequency(trips, zones=zones, isolated=isolated))
    paths, unreachable = sp.path_frequency_and_rest(freq, edges)
    paths, unreachable = cut_lineage(paths), cut_lineage(unreachable)
    coverage = cut_lineage(cov.coverage_count(paths, containment))
    routes = rec.top_k_routes(coverage, lookup, k, m, short_names)
    pct = rec.coverage_percentage(routes, paths, unreachable)  # of all trips, also those without a path
    return RouteReport(freq, paths, coverage, routes, pct, unreachable)
