"""DuckDB twins of the registered queries (independent SQL, same tables).

Fragments below rebuild the fixture views of FIXTURES.md §3 in SQL; each
query is ``WITH RECURSIVE <fragments> SELECT ...``.  DuckDB lists are
1-based; ``sum`` over BIGINT returns HUGEINT, so sums are cast back.
"""

from __future__ import annotations


def hav_sql(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    dlat = f"radians({lat2} - {lat1})"
    dlon = f"radians({lon2} - {lon1})"
    a = (f"(sin({dlat} / 2) * sin({dlat} / 2) + sin({dlon} / 2) * sin({dlon} / 2)"
         f" * cos(radians({lat1})) * cos(radians({lat2})))")
    return f"CAST(trunc(6378137.0::DOUBLE * (2 * atan2(sqrt({a}), sqrt(1 - {a})))) AS INTEGER)"


def subseq_sql(child_txt: str, parent_txt: str) -> str:
    """Ordered subsequence test on comma-joined text (doubled commas)."""
    return (f"(',' || replace({parent_txt}, ',', ',,') || ',') "
            f"LIKE ('%,' || replace({child_txt}, ',', ',%,') || ',%')")


def txt(list_expr: str) -> str:
    return f"array_to_string({list_expr}, ',')"


V = {}
V["zone_v"] = """zone_v AS (
  SELECT CAST(n.n_nationkey AS BIGINT) AS location_id, concat_ws('/', n.n_name, r.r_name) AS zone,
         r.r_name AS borough
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey)"""
V["trip_v"] = """trip_v AS (
  SELECT l.l_returnflag AS tlc_type, o.o_orderdate AS pu_datetime, l.l_shipdate AS do_datetime,
         CAST(s.s_nationkey AS BIGINT) AS pu_location_id, CAST(c.c_nationkey AS BIGINT) AS do_location_id
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN customer c ON o.o_custkey = c.c_custkey)"""
V["iso_v"] = """iso_v AS (
  SELECT CAST(n_nationkey AS BIGINT) AS location_id FROM nation WHERE n_nationkey % 11 = 3)"""
V["cen_v"] = """cen_v AS (
  SELECT CAST(n.n_nationkey AS BIGINT) AS location_id,
         40.0::DOUBLE + CAST(e.embedding[1] AS DOUBLE) AS avg_lat,
         -73.0::DOUBLE + CAST(e.embedding[2] AS DOUBLE) AS avg_lon
  FROM nation n JOIN embeddings e ON e.vec_id = n.n_nationkey)"""
V["nbr_v"] = """nbr_v AS (
  SELECT CAST(n.n_nationkey AS BIGINT) AS location_id,
         (CAST(n.n_nationkey AS BIGINT) + t.k) % 25 AS neighbor_location_id
  FROM nation n, (VALUES (1), (5), (20), (24)) t(k))"""
V["dist_v"] = f"""dist_v AS (
  SELECT p.location_id, p.neighbor_location_id,
         {hav_sql('a.avg_lat', 'a.avg_lon', 'b.avg_lat', 'b.avg_lon')} AS distance
  FROM nbr_v p JOIN cen_v a ON p.location_id = a.location_id
  JOIN cen_v b ON p.neighbor_location_id = b.location_id)"""
V["edge_v"] = """edge_v AS (
  SELECT location_id AS src, neighbor_location_id AS dst, CAST(distance AS BIGINT) AS weight FROM dist_v)"""
V["freq_v"] = """freq_v AS (
  SELECT pu_location_id, do_location_id, count(*) AS frequency FROM trip_v
  WHERE pu_location_id IN (SELECT src FROM edge_v) AND do_location_id IN (SELECT src FROM edge_v)
    AND pu_location_id NOT IN (SELECT location_id FROM iso_v)
    AND do_location_id NOT IN (SELECT location_id FROM iso_v)
  GROUP BY pu_location_id, do_location_id)"""
V["src_v"] = """src_v AS (
  SELECT DISTINCT pu_location_id AS s FROM freq_v WHERE pu_location_id <> do_location_id)"""
def sp_view(name: str, src_view: str, edge_view: str) -> str:
    """Shortest paths with the (dist, hops, path) order via USING KEY recursion."""
    return f"""{name}(s, n, best) USING KEY (s, n) AS (
  SELECT s, s, {{'dist': 0::BIGINT, 'hops': 0, 'path': [s]}} FROM {src_view}
  UNION
  SELECT c.s, c.n, c.best FROM (
    SELECT w.s, e.dst AS n,
           min({{'dist': w.best.dist + e.weight, 'hops': w.best.hops + 1,
                'path': list_append(w.best.path, e.dst)}}) AS best
    FROM {name} w JOIN {edge_view} e ON w.n = e.src
    WHERE NOT list_contains(w.best.path, e.dst)
    GROUP BY w.s, e.dst) c
  LEFT JOIN recurring.{name} r ON r.s = c.s AND r.n = c.n
  WHERE r.best IS NULL OR c.best < r.best)"""


V["sp"] = sp_view("sp", "src_v", "edge_v")
V["pf_v"] = """pf_v AS (
  SELECT sp.best.path AS trip_path, f.frequency FROM freq_v f
  JOIN sp ON sp.s = f.pu_location_id AND sp.n = f.do_location_id
  WHERE f.pu_location_id <> f.do_location_id)"""
V["pft_v"] = """pft_v AS (SELECT trip_path, array_to_string(trip_path, ',') AS t, frequency FROM pf_v)"""
V["cov_v"] = f"""cov_v AS (
  SELECT p.trip_path, CAST(sum(c.frequency) AS BIGINT) AS coverage_count
  FROM pft_v p JOIN pft_v c ON len(c.trip_path) <= len(p.trip_path) AND {subseq_sql('c.t', 'p.t')}
  GROUP BY p.trip_path)"""

# view dependencies (each view lists what it reads)
DEPS = {
    "zone_v": [], "trip_v": [], "iso_v": [], "cen_v": [], "nbr_v": [],
    "dist_v": ["cen_v", "nbr_v"], "edge_v": ["dist_v"],
    "freq_v": ["trip_v", "edge_v", "iso_v"], "src_v": ["freq_v"], "sp": ["src_v", "edge_v"],
    "pf_v": ["sp", "freq_v"], "pft_v": ["pf_v"], "cov_v": ["pft_v"],
}


V["met_v"] = """met_v AS (
  SELECT o.o_orderdate AS pickup, l.l_shipdate AS dropoff, s.s_nationkey AS pu, c.c_nationkey AS dro,
         l.l_quantity AS passenger_count, l.l_discount AS fare_amount, l.l_extendedprice AS total_amount,
         CAST(l.l_linenumber AS BIGINT) AS payment_type, o.o_custkey % 7 AS ratecode,
         '/trips/yellow_tripdata_' || strftime(l.l_shipdate, '%Y-%m') || '.parquet' AS file_path
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN customer c ON o.o_custkey = c.c_custkey)"""
V["bounds_v"] = """bounds_v AS (
  SELECT file_path, avg(total_amount) - 3 * stddev_samp(total_amount) AS lo,
         avg(total_amount) + 3 * stddev_samp(total_amount) AS hi
  FROM met_v GROUP BY file_path)"""
V["clean_v"] = r"""clean_v AS (
  SELECT CAST(m.pu AS BIGINT) AS pulocationID, CAST(m.dro AS BIGINT) AS dolocationID
  FROM met_v m JOIN bounds_v b ON m.file_path = b.file_path
  WHERE m.pu IS NOT NULL AND m.dro IS NOT NULL AND m.total_amount IS NOT NULL
    AND m.fare_amount IS NOT NULL AND m.payment_type IS NOT NULL AND m.ratecode IS NOT NULL
    AND m.passenger_count <> 0 AND m.pu <> m.dro
    AND strftime(m.pickup, '%Y-%m') = regexp_extract(m.file_path, '(\d{4}-\d{2})', 1)
    AND m.payment_type IN (1, 2, 3) AND m.ratecode IN (1, 5, 6) AND m.fare_amount <> 0
    AND m.total_amount BETWEEN b.lo AND b.hi)"""
V["allfreq_v"] = """allfreq_v AS (
  SELECT pu_location_id, do_location_id, count(*) AS frequency FROM trip_v
  WHERE pu_location_id IS NOT NULL AND do_location_id IS NOT NULL
  GROUP BY pu_location_id, do_location_id)"""
V["eib_v"] = """eib_v AS (
  SELECT e.src, e.dst, e.weight FROM edge_v e
  JOIN zone_v a ON e.src = a.location_id JOIN zone_v b ON e.dst = b.location_id
  WHERE a.borough = b.borough)"""
V["allsrc_v"] = """allsrc_v AS (
  SELECT DISTINCT pu_location_id AS s FROM allfreq_v WHERE pu_location_id <> do_location_id)"""
V["spb"] = sp_view("spb", "allsrc_v", "eib_v")
V["nodes_v"] = """nodes_v AS (SELECT DISTINCT src AS s FROM edge_v)"""
V["spall"] = sp_view("spall", "nodes_v", "edge_v")
# zone polygons rebuilt from embeddings: ring j of zone v has n = 3 + (v + j) % 4
# vertices plus the closing one; rings sorted by size desc, then j.
V["ring_v"] = """ring_v AS (
  SELECT e.vec_id, r.r_name AS borough, e.label,
         list_transform(range(0, e.label % 3 + 1), lambda j: {
           'neg': -(4 + (e.vec_id + j) % 4), 'j': j,
           'pts': list_transform(range(0, 3 + (e.vec_id + j) % 4 + 1), lambda t: {
             'x': CAST(floor(CAST(e.embedding[j * 20 + (t % (3 + (e.vec_id + j) % 4)) * 2 + 1] AS DOUBLE) * 1000000)
                       AS BIGINT) - 73000000,
             'y': CAST(floor(CAST(e.embedding[j * 20 + (t % (3 + (e.vec_id + j) % 4)) * 2 + 2] AS DOUBLE) * 1000000)
                       AS BIGINT) + 40000000})}) AS rings
  FROM embeddings e JOIN region r ON e.vec_id % 5 = r.r_regionkey)"""
V["pz_v"] = """pz_v AS (
  SELECT borough, CAST(vec_id AS BIGINT) AS location_id,
         list_transform(list_sort(rings), lambda g: g.pts) AS boundary
  FROM ring_v WHERE vec_id >= 1)"""
DEPS.update({
    "met_v": [], "bounds_v": ["met_v"], "clean_v": ["met_v", "bounds_v"],
    "allfreq_v": ["trip_v"], "eib_v": ["edge_v", "zone_v"], "allsrc_v": ["allfreq_v"],
    "spb": ["allsrc_v", "eib_v"], "nodes_v": ["edge_v"], "spall": ["nodes_v", "edge_v"],
    "ring_v": [], "pz_v": ["ring_v"],
})

def with_views(*names: str) -> str:
    """``WITH RECURSIVE`` clause holding the named views and their dependencies."""
    order: list[str] = []

    def visit(n: str) -> None:
        for d in DEPS[n]:
            visit(d)
        if n not in order:
            order.append(n)

    for n in names:
        visit(n)
    return "WITH RECURSIVE " + ",\n".join(V[n] for n in order) + "\n"


SQL: dict[str, str] = {}

SQL["a1_trip_frequency"] = with_views("freq_v") + "SELECT * FROM freq_v"

SQL["a3_from_zone_distribution"] = with_views("freq_v") + """
SELECT pu_location_id, CAST(sum(frequency) AS BIGINT) AS frequency,
       sum(frequency) * 100 / (SELECT sum(frequency) FROM freq_v WHERE pu_location_id <> do_location_id)
         AS percentage
FROM freq_v WHERE pu_location_id <> do_location_id GROUP BY pu_location_id"""

SQL["n10_path_frequency"] = with_views("pf_v") + f"""
SELECT {txt('trip_path')} AS trip_path, frequency FROM pf_v"""

SQL["a9_coverage_count"] = with_views("cov_v") + f"""
SELECT {txt('trip_path')} AS trip_path, coverage_count FROM cov_v"""

SQL["r6_route_recommendation"] = with_views("cov_v", "zone_v") + f"""
, top_v AS (
  SELECT trip_path, coverage_count FROM cov_v WHERE len(trip_path) >= 2
  ORDER BY coverage_count DESC, len(trip_path) DESC, trip_path ASC LIMIT 10000),
names AS (SELECT location_id, split_part(zone, '/', 1) AS name FROM zone_v),
stops AS (
  SELECT t.trip_path, t.coverage_count, u.pos, u.id
  FROM top_v t, LATERAL (SELECT unnest(t.trip_path) AS id, generate_subscripts(t.trip_path, 1) AS pos) u),
routes AS (
  SELECT s.trip_path, s.coverage_count, string_agg(coalesce(nm.name, 'NA'), ',' ORDER BY s.pos) AS route
  FROM stops s LEFT JOIN names nm ON nm.location_id = s.id
  GROUP BY s.trip_path, s.coverage_count)
SELECT route, coverage_count,
       round(coverage_count / (SELECT sum(frequency) FROM pf_v) * 100.0, 2) AS coverage_percentage,
       {txt('trip_path')} AS trip_path
FROM routes"""


def _top_routes(cov_view: str, k: int, m: int) -> str:
    return f"""
, top_v AS (
  SELECT trip_path, coverage_count FROM {cov_view} WHERE len(trip_path) >= {m}
  ORDER BY coverage_count DESC, len(trip_path) DESC, trip_path ASC LIMIT {k}),
names AS (SELECT location_id, split_part(zone, '/', 1) AS name FROM zone_v),
stops AS (
  SELECT t.trip_path, t.coverage_count, u.pos, u.id
  FROM top_v t, LATERAL (SELECT unnest(t.trip_path) AS id, generate_subscripts(t.trip_path, 1) AS pos) u),
routes AS (
  SELECT s.trip_path, s.coverage_count, string_agg(coalesce(nm.name, 'NA'), ',' ORDER BY s.pos) AS route
  FROM stops s LEFT JOIN names nm ON nm.location_id = s.id
  GROUP BY s.trip_path, s.coverage_count)"""


def _share_sql(keys: str, where: str) -> str:
    return with_views("freq_v") + f"""
SELECT {keys}, CAST(sum(frequency) AS BIGINT) AS frequency,
       sum(frequency) * 100 / (SELECT sum(frequency) FROM freq_v WHERE {where}) AS percentage
FROM freq_v WHERE {where} GROUP BY {keys}"""


SQL["a2_same_zone_distribution"] = _share_sql("pu_location_id, do_location_id", "pu_location_id = do_location_id")
SQL["a4_to_zone_distribution"] = _share_sql("do_location_id", "pu_location_id <> do_location_id")

SQL["a5_zones_per_borough"] = """
SELECT r.r_name AS borough, count(*) AS location_count
FROM embeddings e JOIN region r ON e.vec_id % 5 = r.r_regionkey
WHERE e.vec_id >= 1 GROUP BY r.r_name"""

SQL["a6_mean_stddev"] = """
SELECT round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS stddev FROM events"""

SQL["a7_total_trips"] = with_views("freq_v") + """
SELECT CAST(coalesce(sum(frequency), 0) AS BIGINT) AS total_trips FROM freq_v"""

SQL["a8_adjacency"] = with_views("edge_v") + """
SELECT src, string_agg(dst || ':' || weight, ',' ORDER BY dst, weight) AS neighbours
FROM edge_v GROUP BY src"""

SQL["a10_covered_sub_paths"] = with_views("pft_v") + f"""
SELECT p.t AS trip_path,
       p.t || coalesce(';' || string_agg(c.t, ';' ORDER BY c.trip_path) FILTER (WHERE c.t <> p.t), '')
         AS sub_paths
FROM pft_v p JOIN pft_v c ON len(c.trip_path) <= len(p.trip_path) AND {subseq_sql('c.t', 'p.t')}
GROUP BY p.t"""

SQL["a11_distinct_pickup_zones"] = with_views("trip_v") + """
SELECT DISTINCT pu_location_id FROM trip_v"""

SQL["a12_column_summary"] = with_views("met_v") + """
SELECT count(passenger_count) AS count, round(avg(passenger_count), 6) AS mean,
       round(stddev_samp(passenger_count), 6) AS stddev, min(passenger_count) AS min,
       max(passenger_count) AS max
FROM met_v"""

SQL["a12_column_percentiles"] = with_views("met_v") + """
SELECT quantile_disc(passenger_count, 0.25) AS p25, quantile_disc(passenger_count, 0.5) AS p50,
       quantile_disc(passenger_count, 0.75) AS p75
FROM met_v"""

# a12_column_percentiles_approx has no twin: Spark's quantile sketch is not
# expressible in DuckDB SQL (see tests/test_clean_frequency.py).
NO_TWIN = {"a12_column_percentiles_approx"}

SQL["a13_top_pickup_zones"] = with_views("clean_v") + """
SELECT pulocationID, count(pulocationID) AS trips,
       round(count(pulocationID) / (SELECT count(*) FROM clean_v) * 100.0, 2) AS percentage
FROM clean_v GROUP BY pulocationID ORDER BY trips DESC, pulocationID ASC LIMIT 5"""

SQL["a14_top_undirected_route"] = with_views("clean_v") + """
, r AS (SELECT CASE WHEN pulocationID < dolocationID THEN [pulocationID, dolocationID]
                   ELSE [dolocationID, pulocationID] END AS route_ids FROM clean_v),
top1 AS (SELECT route_ids, count(*) AS counts FROM r GROUP BY route_ids
         ORDER BY counts DESC, route_ids ASC LIMIT 1)
SELECT array_to_string(route_ids, ',') AS trip_route, counts,
       counts / (SELECT count(*) FROM clean_v) * 100 AS percentage
FROM top1"""

SQL["a15_boundary_stats"] = """
WITH s AS (
  SELECT r.r_name AS borough, CAST(e.vec_id AS BIGINT) AS location_id,
         list_reverse(list_sort(list_transform(range(0, e.label % 3 + 1),
           lambda j: CAST(4 + (e.vec_id + j) % 4 AS INTEGER)))) AS sizes
  FROM embeddings e JOIN region r ON e.vec_id % 5 = r.r_regionkey WHERE e.vec_id >= 1)
SELECT borough, location_id, CAST(list_sum(sizes) AS INTEGER) AS total_coordinate_count,
       CAST(len(sizes) AS INTEGER) AS total_sub_region_count,
       list_max(sizes) AS max_sub_region_coordinate_count,
       array_to_string(sizes, ' ') AS sub_region_coordinate_counts
FROM s"""

SQL["a16_row_count"] = with_views("trip_v") + "SELECT count(*) AS row_count FROM trip_v"

SQL["g1_parse_zones"] = with_views("pz_v") + """
SELECT borough, location_id,
       array_to_string(list_transform(boundary, lambda ring:
         array_to_string(list_transform(ring, lambda p: p.x || ' ' || p.y), ',')), ';') AS boundary
FROM pz_v"""

SQL["g1_rejected_zones"] = """
SELECT CAST(e.vec_id AS INTEGER) AS LocationID, r.r_name AS borough
FROM embeddings e JOIN region r ON e.vec_id % 5 = r.r_regionkey WHERE e.vec_id < 1"""

SQL["g2_zone_centroids"] = with_views("pz_v") + """
SELECT borough, location_id,
       list_sum(list_transform(boundary[1], lambda p: CAST(p.y AS DOUBLE))) / len(boundary[1]) AS avg_lat,
       list_sum(list_transform(boundary[1], lambda p: CAST(p.x AS DOUBLE))) / len(boundary[1]) AS avg_lon
FROM pz_v"""

SQL["g5_neighbor_distance"] = with_views("dist_v") + "SELECT * FROM dist_v"

SQL["g4_distance_km"] = with_views("dist_v") + """
SELECT location_id, neighbor_location_id, distance / 1000.0 AS distance_km FROM dist_v"""

SQL["n1_graph_edges"] = with_views("edge_v") + "SELECT src, dst, weight FROM edge_v"
SQL["n2_graph_nodes"] = with_views("edge_v") + "SELECT DISTINCT src AS node FROM edge_v"
SQL["n3_edge_pairs"] = with_views("edge_v") + "SELECT src, dst FROM edge_v"
SQL["n4_neighbours"] = with_views("edge_v") + "SELECT dst, weight FROM edge_v WHERE src = 7"
SQL["n5_add_edges"] = with_views("edge_v", "iso_v") + """
SELECT src, dst, weight FROM edge_v
WHERE (src, dst) NOT IN (SELECT (location_id, CAST(0 AS BIGINT)) FROM iso_v)
UNION ALL SELECT location_id AS src, CAST(0 AS BIGINT) AS dst, CAST(0 AS BIGINT) AS weight FROM iso_v"""
SQL["n6_undirected"] = with_views("edge_v") + """
, d AS (SELECT * FROM edge_v WHERE src < dst),
b AS (SELECT src, dst, weight FROM d UNION ALL SELECT dst AS src, src AS dst, weight FROM d)
SELECT src, dst, min(weight) AS weight FROM b GROUP BY src, dst"""
SQL["n7_from_adjacency"] = with_views("edge_v") + "SELECT src, dst, weight FROM edge_v"
SQL["n8_shortest_paths"] = with_views("spall") + """
SELECT s AS source, n AS node, best.dist AS dist, best.hops AS hops,
       array_to_string(best.path, ',') AS path FROM spall"""
SQL["n9_unreachable_pairs"] = with_views("allfreq_v", "spb") + """
SELECT f.pu_location_id, f.do_location_id, f.frequency FROM allfreq_v f
WHERE f.pu_location_id <> f.do_location_id
  AND NOT EXISTS (SELECT 1 FROM spb WHERE spb.s = f.pu_location_id AND spb.n = f.do_location_id)"""
SQL["n11_connected_components"] = with_views("eib_v") + """
, und AS (SELECT src AS a, dst AS b FROM eib_v UNION SELECT dst, src FROM eib_v),
reach(a, b) AS (
  SELECT a, a FROM und
  UNION
  SELECT r.a, u.b FROM reach r JOIN und u ON r.b = u.a)
SELECT a AS node, min(b) AS component FROM reach GROUP BY a"""
SQL["n12_graph_check"] = with_views("edge_v", "zone_v") + """
SELECT (SELECT count(DISTINCT src) FROM edge_v) AS node_count,
       (SELECT count(DISTINCT location_id) FROM zone_v) AS zone_count,
       (SELECT count(DISTINCT src) FROM edge_v) = (SELECT count(DISTINCT location_id) FROM zone_v) AS counts_match,
       (SELECT count(*) FROM (SELECT DISTINCT location_id FROM zone_v
                              WHERE location_id NOT IN (SELECT src FROM edge_v))) AS isolated_count"""

SQL["j2_readable_paths"] = with_views("pf_v", "zone_v") + """
, names AS (SELECT location_id, split_part(zone, '/', 1) AS name FROM zone_v),
stops AS (
  SELECT t.trip_path, u.pos, u.id
  FROM pf_v t, LATERAL (SELECT unnest(t.trip_path) AS id, generate_subscripts(t.trip_path, 1) AS pos) u)
SELECT array_to_string(s.trip_path, ',') AS trip_path,
       string_agg(coalesce(nm.name, 'NA'), ',' ORDER BY s.pos) AS route
FROM stops s LEFT JOIN names nm ON nm.location_id = s.id GROUP BY s.trip_path"""

SQL["j3_contained_pairs"] = with_views("pft_v") + f"""
SELECT p.t AS parent, c.t AS child, c.frequency
FROM pft_v p JOIN pft_v c ON len(c.trip_path) <= len(p.trip_path) AND {subseq_sql('c.t', 'p.t')}"""

SQL["t3_top_k_paths"] = with_views("cov_v") + """
, top_v AS (SELECT trip_path AS ids, coverage_count FROM cov_v WHERE len(trip_path) >= 4
            ORDER BY coverage_count DESC, len(trip_path) DESC, trip_path ASC LIMIT 20)
SELECT array_to_string(ids, ',') AS trip_path, coverage_count FROM top_v"""

SQL["r1_top_k_routes"] = with_views("cov_v", "zone_v") + _top_routes("cov_v", 25, 3) + """
SELECT route, coverage_count, array_to_string(trip_path, ',') AS trip_path FROM routes"""

SQL["r3_overall_coverage"] = with_views("cov_v") + f"""
, top_v AS (
  SELECT trip_path, array_to_string(trip_path, ',') AS t FROM cov_v WHERE len(trip_path) >= 3
  ORDER BY coverage_count DESC, len(trip_path) DESC, trip_path ASC LIMIT 25),
covered AS (
  SELECT DISTINCT c.t, c.frequency FROM top_v p JOIN pft_v c
    ON len(c.trip_path) <= len(p.trip_path) AND {subseq_sql('c.t', 'p.t')}),
tot AS (SELECT CAST(coalesce(sum(frequency), 0) AS BIGINT) AS total FROM pf_v),
cv AS (SELECT CAST(coalesce(sum(frequency), 0) AS BIGINT) AS covered FROM covered)
SELECT cv.covered AS covered_trips, tot.total AS total_trips,
       round(cv.covered * 100.0 / tot.total, 2) AS coverage_percentage FROM cv, tot"""

SQL["r4_sub_path_frequency"] = with_views("pf_v") + """
, subs AS (
  SELECT DISTINCT p.trip_path, p.frequency, p.trip_path[i:j] AS sub
  FROM pf_v p, range(1, len(p.trip_path) + 1) a(i), range(1, len(p.trip_path) + 1) b(j)
  WHERE j - i + 1 >= 2)
SELECT array_to_string(sub, ',') AS sub_path, CAST(sum(frequency) AS BIGINT) AS frequency
FROM subs GROUP BY sub"""

SQL["f5_borough_trip_frequency"] = with_views("trip_v", "zone_v") + """
SELECT pu_location_id, do_location_id, count(*) AS frequency FROM trip_v
WHERE pu_location_id IN (SELECT location_id FROM zone_v WHERE borough = 'ASIA')
  AND do_location_id IN (SELECT location_id FROM zone_v WHERE borough = 'ASIA')
GROUP BY pu_location_id, do_location_id"""

SQL["f7_code_list_filter"] = with_views("met_v") + """
SELECT pu AS PULocationID, dro AS DOLocationID, payment_type, ratecode AS RatecodeID,
       passenger_count, fare_amount
FROM met_v WHERE payment_type IN (1, 2, 3) AND ratecode IN (1, 5, 6)
  AND passenger_count <> 0 AND fare_amount <> 0"""

SQL["f9_sigma_filter"] = """
WITH b AS (SELECT avg(value) - 3 * stddev_samp(value) AS lo, avg(value) + 3 * stddev_samp(value) AS hi
           FROM events)
SELECT event_id, value FROM events, b WHERE value BETWEEN b.lo AND b.hi"""

SQL["f10_file_month_filter"] = with_views("met_v") + r"""
SELECT pu AS PULocationID, dro AS DOLocationID, file_path FROM met_v
WHERE strftime(pickup, '%Y-%m') = regexp_extract(file_path, '(\d{4}-\d{2})', 1)"""

SQL["f14_clean_metered_trips"] = with_views("clean_v") + "SELECT * FROM clean_v"

SQL["f15_clean_fhv_trips"] = with_views("trip_v") + """
SELECT pu_location_id AS pulocationID, do_location_id AS dolocationID FROM trip_v
WHERE pu_location_id IS NOT NULL AND do_location_id IS NOT NULL"""

SQL["p8_unify_providers"] = with_views("met_v", "trip_v") + """
SELECT 'yellow' AS tlc_type, pickup AS pu_datetime, dropoff AS do_datetime,
       CAST(pu AS BIGINT) AS pu_location_id, CAST(dro AS BIGINT) AS do_location_id
FROM met_v WHERE pickup IS NOT NULL AND dropoff IS NOT NULL AND pu IS NOT NULL AND dro IS NOT NULL
UNION ALL
SELECT 'fhv', pu_datetime, do_datetime, pu_location_id, do_location_id FROM trip_v
WHERE pu_datetime IS NOT NULL AND do_datetime IS NOT NULL
  AND pu_location_id IS NOT NULL AND do_location_id IS NOT NULL"""

SQL["l1_zone_lookup_clean"] = with_views("zone_v") + """
SELECT location_id, zone, borough FROM zone_v WHERE borough <> 'Unknown'"""

_AREAS = """
, areas AS (SELECT location_id FROM zone_v UNION ALL SELECT location_id FROM zone_v WHERE borough = 'ASIA'),
allowed AS (SELECT location_id FROM zone_v WHERE borough = 'AMERICA'),
excluded AS (SELECT location_id FROM areas WHERE location_id NOT IN (SELECT location_id FROM allowed))"""

SQL["u4_excluded_areas"] = with_views("zone_v") + _AREAS + "\nSELECT location_id FROM excluded"

SQL["u6_service_area_violations"] = with_views("zone_v", "trip_v") + _AREAS + """
SELECT DISTINCT location_id FROM (
  SELECT pu_location_id AS location_id FROM trip_v WHERE pu_location_id IN (SELECT location_id FROM excluded)
  UNION
  SELECT do_location_id FROM trip_v WHERE do_location_id IN (SELECT location_id FROM excluded))"""

SQL["k9_connected_zone_lists"] = with_views("zone_v", "edge_v", "iso_v") + """
, c AS (SELECT borough, location_id FROM zone_v
        WHERE location_id IN (SELECT src FROM edge_v) AND location_id NOT IN (SELECT location_id FROM iso_v))
SELECT b.borough, coalesce(string_agg(CAST(c.location_id AS VARCHAR), ',' ORDER BY c.location_id), '')
         AS location_ids
FROM (SELECT DISTINCT borough FROM zone_v) b LEFT JOIN c ON b.borough = c.borough GROUP BY b.borough"""

SQL["k10_isolated_zone_lists"] = with_views("zone_v", "iso_v") + """
, c AS (SELECT borough, location_id FROM zone_v WHERE location_id IN (SELECT location_id FROM iso_v))
SELECT b.borough, coalesce(string_agg(CAST(c.location_id AS VARCHAR), ',' ORDER BY c.location_id), '')
         AS location_ids
FROM (SELECT DISTINCT borough FROM zone_v) b LEFT JOIN c ON b.borough = c.borough GROUP BY b.borough"""

_UNIFIED = """
, uni_v AS (
  SELECT 'yellow' AS tlc_type, pickup AS pu_datetime, dropoff AS do_datetime,
         CAST(pu AS BIGINT) AS pu_location_id, CAST(dro AS BIGINT) AS do_location_id
  FROM met_v WHERE pickup IS NOT NULL AND dropoff IS NOT NULL AND pu IS NOT NULL AND dro IS NOT NULL
  UNION ALL
  SELECT 'fhv', pu_datetime, do_datetime, pu_location_id, do_location_id FROM trip_v
  WHERE pu_datetime IS NOT NULL AND do_datetime IS NOT NULL
    AND pu_location_id IS NOT NULL AND do_location_id IS NOT NULL)"""

SQL["s1_read_csv"] = with_views("zone_v") + """
SELECT CAST(location_id AS INTEGER) AS LocationID, borough AS Borough, zone AS Zone,
       'Boro Zone' AS service_zone FROM zone_v"""

SQL["s2_read_month_range"] = with_views("met_v", "trip_v") + _UNIFIED + """
SELECT pu_datetime, do_datetime, pu_location_id, do_location_id FROM uni_v
WHERE tlc_type = 'yellow' AND year(pu_datetime) * 100 + month(pu_datetime) BETWEEN 199601 AND 199706"""

SQL["s3_read_provider_year"] = with_views("met_v", "trip_v") + _UNIFIED + """
SELECT pu_datetime, do_datetime, pu_location_id, do_location_id FROM uni_v
WHERE tlc_type = 'fhv' AND year(pu_datetime) = 1996"""

SQL["s4_read_drift_groups"] = with_views("met_v", "trip_v") + _UNIFIED + """
SELECT * FROM uni_v WHERE tlc_type = 'yellow'"""

SQL["s5_read_tagged"] = with_views("met_v") + """
SELECT strftime(dropoff, '%Y-%m') AS file_month, count(*) AS trips FROM met_v GROUP BY 1"""

SQL["s6_reload_clean_trips"] = with_views("trip_v") + "SELECT * FROM trip_v"

SQL["s7_read_borough"] = SQL["g2_zone_centroids"].replace(
    "SELECT borough, location_id,", "SELECT location_id,").rstrip() + "\nWHERE borough = 'ASIA'"

SQL["k1_sorted_csv"] = SQL["a5_zones_per_borough"]
SQL["k2_sorted_tsv"] = SQL["n10_path_frequency"]
SQL["k3_tsv_empty_values"] = SQL["k10_isolated_zone_lists"].replace(
    "SELECT b.borough, coalesce(", "SELECT b.borough || chr(9) || coalesce(").replace(
    "AS location_ids\nFROM (SELECT DISTINCT borough", "AS line\nFROM (SELECT DISTINCT borough") + """
UNION ALL SELECT 'borough' || chr(9) || 'location_ids'"""
SQL["k4_clean_trips_parquet"] = SQL["s6_reload_clean_trips"]
SQL["k5_clean_trips_by_provider"] = with_views("met_v", "trip_v") + _UNIFIED + "\nSELECT * FROM uni_v"
SQL["k6_partitioned_provider_year"] = with_views("met_v", "trip_v") + _UNIFIED + """
SELECT tlc_type AS cab, CAST(year(pu_datetime) AS INTEGER) AS year,
       pu_location_id AS pulocationID, do_location_id AS dolocationID FROM uni_v"""
SQL["k7_borough_fanout"] = SQL["g2_zone_centroids"]
SQL["k8_verify_roundtrip"] = with_views("trip_v") + """
SELECT count(*) AS source_count, count(*) AS written_count, true AS counts_match FROM trip_v"""

SQL["p6_pair_frequency_struct"] = with_views("freq_v") + """
SELECT pu_location_id AS pulocationID, do_location_id AS dolocationID, frequency AS Frequency
FROM freq_v WHERE pu_location_id <> do_location_id"""

SQL["a9_coverage_count_contiguous"] = with_views("pft_v") + """
SELECT p.t AS trip_path, CAST(sum(c.frequency) AS BIGINT) AS coverage_count
FROM pft_v p JOIN pft_v c ON contains(',' || p.t || ',', ',' || c.t || ',')
GROUP BY p.t"""

SQL["x1_x3_path_text_functions"] = with_views("pft_v", "zone_v") + """
SELECT p.t AS trip_path, CAST(len(string_split(p.t, ',')) AS INTEGER) AS n_stops,
       CAST(string_split(p.t, ',')[1] AS BIGINT) AS first_stop,
       array_to_string(list_reverse(string_split(p.t, ',')), ',') AS reversed_path,
       split_part(z.zone, '/', 1) AS first_zone
FROM pft_v p LEFT JOIN zone_v z ON z.location_id = CAST(string_split(p.t, ',')[1] AS BIGINT)"""

SQL["x4_x7_date_text_functions"] = with_views("met_v") + r"""
SELECT regexp_extract(file_path, '(\d{4}-\d{2})', 1) AS file_month,
       CAST(year(pickup) AS INTEGER) AS pickup_year, CAST(month(pickup) AS INTEGER) AS pickup_month,
       strftime(pickup, '%Y-%m') AS pickup_year_month, round(total_amount / 3, 2) AS third_of_total
FROM met_v"""

SQL["st_streaming_trip_frequency"] = with_views("allfreq_v") + "SELECT * FROM allfreq_v"

SQL["g6_shared_point_neighbours"] = """
WITH cell AS (SELECT CAST(vec_id AS BIGINT) AS id, vec_id % 25 AS x, vec_id // 25 AS y FROM embeddings
              WHERE vec_id >= 1 AND vec_id % 5 IN (SELECT r_regionkey FROM region)),
pts AS (SELECT id, x + d.dx AS px, y + d.dy AS py FROM cell, (VALUES (0, 0), (1, 0), (1, 1), (0, 1)) d(dx, dy)
        UNION SELECT id, -9, -9 FROM cell WHERE id % 3 = 0)
SELECT a.id AS location_id, b.id AS neighbor_location_id
FROM pts a JOIN pts b ON a.px = b.px AND a.py = b.py AND a.id <> b.id
GROUP BY a.id, b.id HAVING count(*) >= 2"""

SQL["g6_shared_point_neighbours_default"] = SQL["g6_shared_point_neighbours"]

SQL["n11_find"] = with_views("eib_v", "trip_v") + """
, both_e AS (SELECT src, dst FROM eib_v UNION SELECT dst, src FROM eib_v),
reach(n, m) AS (SELECT src, src FROM both_e UNION SELECT r.n, e.dst FROM reach r JOIN both_e e ON e.src = r.m),
comp AS (SELECT n, min(m) AS c FROM reach GROUP BY n)
SELECT DISTINCT pu_location_id * 2 AS node, coalesce(c, pu_location_id * 2) AS component
FROM trip_v LEFT JOIN comp ON n = pu_location_id * 2"""

SQL["n11_union"] = with_views("eib_v", "allfreq_v") + """
, added AS (SELECT pu_location_id AS src, max_by(do_location_id, {'f': frequency, 'd': do_location_id}) AS dst FROM allfreq_v
            WHERE pu_location_id % 6 = 0 AND pu_location_id <> do_location_id GROUP BY pu_location_id),
all_e AS (SELECT src, dst FROM eib_v UNION SELECT src, dst FROM added),
both_e AS (SELECT src, dst FROM all_e UNION SELECT dst, src FROM all_e),
reach(n, m) AS (SELECT src, src FROM both_e UNION SELECT r.n, e.dst FROM reach r JOIN both_e e ON e.src = r.m)
SELECT n AS node, min(m) AS component FROM reach GROUP BY n"""

SQL["r5_route_clusters"] = with_views("pf_v") + f"""
, zs AS (SELECT trip_path, frequency, list_sort(list_distinct(trip_path)) AS z FROM pf_v WHERE len(list_distinct(trip_path)) >= 4),
s AS (SELECT z, row_number() OVER (ORDER BY z) AS id FROM (SELECT DISTINCT z FROM zs)),
link AS (SELECT a.id AS x, b.id AS y FROM s a JOIN s b ON a.id <> b.id
         WHERE 100 * len(list_intersect(a.z, b.z)) >= 75 * (len(a.z) + len(b.z) - len(list_intersect(a.z, b.z)))),
reach(n, m) AS (SELECT id, id FROM s UNION SELECT r.n, l.y FROM reach r JOIN link l ON l.x = r.m),
comp AS (SELECT n AS id, min(m) AS c FROM reach GROUP BY n),
member AS (SELECT trip_path, frequency, c FROM zs JOIN s USING (z) JOIN comp USING (id)),
cl AS (SELECT c, min(trip_path) AS cluster, count(DISTINCT trip_path) AS cluster_routes, CAST(sum(frequency) AS BIGINT) AS cluster_frequency
       FROM member GROUP BY c)
SELECT DISTINCT {txt('trip_path')} AS trip_path, {txt('cluster')} AS cluster, cluster_routes, cluster_frequency
FROM member JOIN cl USING (c)"""

SQL["f14_clean_green_trips"] = SQL["f14_clean_metered_trips"]

SQL["f9_file_moments"] = with_views("met_v") + r"""
SELECT regexp_extract(file_path, '(\d{4}-\d{2})', 1) AS file_month, count(total_amount) AS n,
       round(avg(total_amount) - 3 * stddev_samp(total_amount), 3) AS lower_bound,
       round(avg(total_amount) + 3 * stddev_samp(total_amount), 3) AS upper_bound
FROM met_v GROUP BY file_month"""

SQL["p8_unify_four_providers"] = with_views("met_v", "trip_v") + """
, shape AS (SELECT pickup AS pu_datetime, dropoff AS do_datetime, CAST(pu AS BIGINT) AS pu_location_id,
                   CAST(dro AS BIGINT) AS do_location_id FROM met_v),
fhv AS (SELECT pu_datetime, do_datetime, pu_location_id, do_location_id FROM trip_v)
SELECT 'yellow' AS tlc_type, * FROM shape UNION ALL SELECT 'green' AS tlc_type, * FROM shape
UNION ALL SELECT 'fhv' AS tlc_type, * FROM fhv UNION ALL SELECT 'fhvhv' AS tlc_type, * FROM fhv"""

SQL["s4_read_by_schema"] = SQL["p8_unify_providers"]

SQL["s2_read_month_folders"] = with_views("met_v") + """
SELECT 'yellow' AS tlc_type, pickup AS pu_datetime, dropoff AS do_datetime, CAST(pu AS BIGINT) AS pu_location_id,
       CAST(dro AS BIGINT) AS do_location_id
FROM met_v WHERE month(pickup) <> 7 AND strftime(pickup, '%Y-%m') BETWEEN '1996-05' AND '1997-02'"""

SQL["k4_bucketed_trip_frequency"] = with_views("allfreq_v") + "SELECT * FROM allfreq_v"
