"""Command line: ``python -m routecov <job> [options]``.

Jobs: trips, clean, pairs, zones, neighbors, recommend (see routecov.plans.jobs).  The
session comes from spark-submit / the environment; nothing is hard-coded.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from routecov import seed
from routecov.plans import jobs
from routecov.session import ensure_checkpoint_dir


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="routecov")
    sub = ap.add_subparsers(dest="job", required=True)
    t = sub.add_parser("trips", help="raw provider files -> clean trips")
    t.add_argument("--source", required=True)
    t.add_argument("--output", required=True)
    t.add_argument("--partitions", type=int)
    t.add_argument("--start", help="first month, YYYY-MM (default: all)")
    t.add_argument("--end", help="last month, YYYY-MM (default: all)")
    t.add_argument("--schema-cut", action="append",
                   help="month from which column types changed (repeatable; default: read from the files' footers)")
    t.add_argument("--bucketed", help="also keep the trips in bucketed tables of this name")
    c = sub.add_parser("clean", help="raw provider files -> reduced trips by each provider's cleaning rule")
    c.add_argument("--source", required=True)
    c.add_argument("--output", required=True)
    c.add_argument("--moments", help="folder of the side tables of per-file moments")
    c.add_argument("--start", help="first month, YYYY-MM (default: all)")
    c.add_argument("--end", help="last month, YYYY-MM (default: all)")
    f = sub.add_parser("pairs", help="reduced trips -> pair frequency per provider and year")
    f.add_argument("--pairs", required=True)
    f.add_argument("--distances", required=True)
    f.add_argument("--output", required=True)
    f.add_argument("--borough", default=seed.DEFAULT_BOROUGH)
    z = sub.add_parser("zones", help="zone polygons + lookup -> profiles, centroids, lookup")
    z.add_argument("--zones-csv", required=True)
    z.add_argument("--lookup-csv", required=True)
    z.add_argument("--profile-output", required=True)
    z.add_argument("--clean-output", required=True)
    n = sub.add_parser("neighbors", help="neighbour pairs + centroids -> distances, zone lists")
    n.add_argument("--centroids", required=True)
    n.add_argument("--neighbors-csv", help="pairs of neighbours; default: from the polygons")
    n.add_argument("--zones-csv", help="zone polygons, needed without --neighbors-csv")
    n.add_argument("--lookup", required=True)
    n.add_argument("--output", required=True)
    r = sub.add_parser("recommend", help="clean trips + distances + lookup -> routes")
    r.add_argument("--trips", required=True)
    r.add_argument("--distances", required=True)
    r.add_argument("--lookup", required=True)
    r.add_argument("--output", required=True)
    r.add_argument("--borough", default=seed.DEFAULT_BOROUGH)
    r.add_argument("--k", type=int, default=jobs.DEFAULT_K)
    r.add_argument("--m", type=int, default=jobs.DEFAULT_M)
    a = ap.parse_args(argv)

    spark = SparkSession.builder.appName(f"routecov-{a.job}").getOrCreate()
    ensure_checkpoint_dir(spark)
    if a.job == "trips":
        res = jobs.trip_etl(spark, a.source, a.output, partitions=a.partitions, start=a.start, end=a.end,
                            cuts=tuple(a.schema_cut) if a.schema_cut else None, bucketed=a.bucketed)
    elif a.job == "clean":
        res = jobs.cleaning_etl(spark, a.source, a.output, moments=a.moments, start=a.start, end=a.end)
    elif a.job == "pairs":
        res = jobs.pair_frequency_etl(spark, a.pairs, a.distances, seed.isolated_zones(spark, a.borough), a.output, a.borough)
    elif a.job == "zones":
        res = jobs.zone_etl(spark, a.zones_csv, a.lookup_csv, a.profile_output, a.clean_output)
    elif a.job == "neighbors":
        res = jobs.neighbor_etl(spark, a.centroids, a.neighbors_csv, seed.isolated_zones(spark),
                                a.lookup, a.output, zones_csv=a.zones_csv)
    else:
        res = jobs.recommendation(spark, a.trips, a.distances, a.lookup,
                                  seed.isolated_zones(spark, a.borough), a.output, a.borough, a.k, a.m)
    print(json.dumps({"job": a.job, **res}))


if __name__ == "__main__":
    main()
