"""DuckDB SQL for the registered survey queries."""

from __future__ import annotations

_NODES = """
nodes AS (
    SELECT image_id, line, step, 3000 AS rows, 4000 AS cols,
           step * 13.4::DOUBLE * sin(radians(77.0::DOUBLE)) - line * 27.0::DOUBLE * cos(radians(77.0::DOUBLE)) AS e,
           step * 13.4::DOUBLE * cos(radians(77.0::DOUBLE)) + line * 27.0::DOUBLE * sin(radians(77.0::DOUBLE)) AS nn,
           1000.0::DOUBLE + 2.5::DOUBLE * image_id + 60.0::DOUBLE * line AS t,
           CASE WHEN line % 2 = 0 THEN 64.5::DOUBLE ELSE -115.5::DOUBLE END AS yaw
    FROM (SELECT image_id, line, CASE WHEN line % 2 = 0 THEN image_id % 5 ELSE 4 - image_id % 5 END AS step
          FROM (SELECT c_custkey AS image_id, floor(c_custkey / 5.0)::BIGINT AS line FROM customer))
), survey AS (
    SELECT *, 41.25::DOUBLE + degrees(nn / 6371000.0::DOUBLE) AS lat,
           2.125::DOUBLE + degrees(e / (6371000.0::DOUBLE * cos(radians(41.25::DOUBLE)))) AS lon FROM nodes
), pairs AS (
    SELECT a.image_id AS src, b.image_id AS dst, a.lat AS lat_a, a.lon AS lon_a,
           radians(b.lon - a.lon) * 6371000.0::DOUBLE * cos(radians(a.lat)) AS east, radians(b.lat - a.lat) * 6371000.0::DOUBLE AS north,
           a.e AS ea, a.nn AS na, b.e AS eb, b.nn AS nb, a.yaw AS ya, b.yaw AS yb
    FROM survey a JOIN survey b ON a.image_id < b.image_id
    WHERE sqrt(pow(radians(b.lon - a.lon) * 6371000.0::DOUBLE * cos(radians(a.lat)), 2) + pow(radians(b.lat - a.lat) * 6371000.0::DOUBLE, 2)) < 40
), true_edges AS (
    SELECT src, dst, east, north, cos(th) AS p0, -sin(th) AS q0, sin(th) AS r0, cos(th) AS s0,
           2000 + cos(bk) * px - sin(bk) * py - (cos(th) * 2000 - sin(th) * 1500) AS tx0,
           1500 + sin(bk) * px + cos(bk) * py - (sin(th) * 2000 + cos(th) * 1500) AS ty0
    FROM (SELECT *, radians(ya - yb) AS th, radians(-yb) AS bk, 30.25::DOUBLE * (ea - eb) AS px, -30.25::DOUBLE * (na - nb) AS py FROM pairs)
), bent AS (
    SELECT *,
        CASE c WHEN 0 THEN cos(radians(30)) WHEN 1 THEN 1.3::DOUBLE WHEN 2 THEN -1.0::DOUBLE ELSE 1.0::DOUBLE END AS ep,
        CASE c WHEN 0 THEN -sin(radians(30)) WHEN 3 THEN tan(radians(20)) ELSE 0.0::DOUBLE END AS eq,
        CASE c WHEN 0 THEN sin(radians(30)) ELSE 0.0::DOUBLE END AS er,
        CASE c WHEN 0 THEN cos(radians(30)) WHEN 1 THEN 1.3::DOUBLE ELSE 1.0::DOUBLE END AS es
    FROM (SELECT *, (7 * src + 13 * dst) % 29 AS c FROM true_edges)
), false_edges AS (
    SELECT src, dst, east, north, p0 * ep + q0 * er AS p, p0 * eq + q0 * es AS q, r0 * ep + s0 * er AS r, r0 * eq + s0 * es AS s,
           p0 * ux + q0 * uy + tx0 AS tx, r0 * ux + s0 * uy + ty0 AS ty
    FROM (SELECT *, 2000 - ep * 2000 - eq * 1500 AS ux, 1500 - er * 2000 - es * 1500 AS uy FROM bent)
)"""

_MATCHES = """
matches AS (
    SELECT src, dst, k, p0, q0, r0, s0, tx0, ty0, sx, sy, (src + dst + k) % 7 <> 0 AS is_inlier,
           0.8::DOUBLE * (((7 * src + 11 * dst + 5 * k) % 13) / 13.0::DOUBLE - 0.5::DOUBLE) AS wob
    FROM (SELECT *, 1000.0::DOUBLE + 700 * (k % 3) AS sx, 800.0::DOUBLE + 500 * floor(k / 3.0) AS sy FROM true_edges, range(9) t(k))
)"""

_WRAP = "({0} + pi()) - floor(({0} + pi()) / (2 * pi())) * (2 * pi()) - pi()"

_OBS = f"""
geo AS (
    SELECT *, sqrt(east * east + north * north) AS metres,
           (s * (2000 - tx) - q * (1500 - ty)) / (p * s - q * r) - 2000 AS bx, (p * (1500 - ty) - r * (2000 - tx)) / (p * s - q * r) - 1500 AS by_,
           p * 2000 + q * 1500 + tx - 2000 AS fx, r * 2000 + s * 1500 + ty - 1500 AS fy
    FROM EDGES
), raw AS (
    SELECT src, dst, src AS node, atan2(-north, east) - atan2(by_, bx) AS h FROM geo WHERE metres >= 5
    UNION ALL SELECT src, dst, dst, atan2(north, -east) - atan2(fy, fx) FROM geo WHERE metres >= 5
), obs AS (
    SELECT src, dst, node, {_WRAP.format("h")} AS h, row_number() OVER (PARTITION BY node ORDER BY src, dst) AS k FROM raw
)"""

_Z = f"abs({_WRAP.format('(a.h - b.h)')}) / radians(1.691) <= 6.31"
_CONSENSUS = f"""
seeds AS (SELECT b.node, b.k, b.h, count(*) FILTER ({_Z}) AS n FROM obs a JOIN obs b USING (node) GROUP BY b.node, b.k, b.h),
best AS (SELECT node, h FROM (SELECT *, row_number() OVER (PARTITION BY node ORDER BY n DESC, k) AS place FROM seeds) WHERE place = 1),
heads AS (SELECT a.node, atan2(sum(sin(a.h)), sum(cos(a.h))) AS h FROM obs a JOIN best b USING (node) WHERE {_Z} GROUP BY a.node),
consensus AS (
    SELECT a.node, any_value(b.h) AS heading, count(*) FILTER ({_Z}) AS n_agree, count(*) AS n_obs FROM obs a JOIN heads b USING (node) GROUP BY a.node
), trust AS (SELECT *, n_agree >= 3 AND n_agree >= 0.5 * n_obs AS trusted FROM consensus)"""

_JUDGED = f"""
ends AS (
    SELECT a.src, a.dst, bool_and(t.trusted) AS trusted, bool_and(abs({_WRAP.format("(a.h - t.heading)")}) / radians(1.691) <= 6.31) AS agrees
    FROM obs a JOIN trust t USING (node) GROUP BY a.src, a.dst
), known AS (
    SELECT g.*, sqrt(bx * bx + by_ * by_) / metres AS ppm, ta.heading AS theta_a, tb.heading AS theta_b,
           CASE WHEN metres < 5 THEN 'too_short' WHEN NOT coalesce(e.trusted, false) THEN 'untrusted_node'
                WHEN NOT coalesce(e.agrees, false) THEN 'heading_disagrees' END AS early
    FROM geo g LEFT JOIN ends e ON g.src = e.src AND g.dst = e.dst LEFT JOIN trust ta ON ta.node = g.src LEFT JOIN trust tb ON tb.node = g.dst
), logs AS (SELECT ln(ppm) AS lv FROM known WHERE early IS NULL),
dense AS (SELECT lv, count(*) OVER (ORDER BY lv RANGE BETWEEN 0.08 PRECEDING AND 0.08 FOLLOWING) AS n FROM logs),
mode AS (SELECT exp(lv) AS mode FROM dense ORDER BY n DESC, lv LIMIT 1),
judged AS (
    SELECT src, dst, CASE WHEN early IS NOT NULL THEN early
        WHEN NOT coalesce(abs(ln(ppm / (SELECT mode FROM mode))) <= 0.15, false) THEN 'length'
        WHEN p * s - q * r <= 0 THEN 'orientation_reversing'
        WHEN abs({_WRAP.format("(-atan2(r - q, p + s) - (theta_b - theta_a))")}) > radians(12.45) THEN 'rotation' END AS reason
    FROM known
)"""

_SEGMENTED = """
gaps AS (SELECT *, t - lag(t) OVER (ORDER BY t, image_id) AS gap FROM survey),
cut AS (SELECT *, sum(CASE WHEN gap > (SELECT 3 * median(gap) FROM gaps) THEN 1 ELSE 0 END) OVER (ORDER BY t, image_id)::BIGINT AS segment FROM gaps),
near AS (
    SELECT *, coalesce(lag(lat) OVER w, lat) AS plat, coalesce(lag(lon) OVER w, lon) AS plon, coalesce(lead(lat) OVER w, lat) AS qlat, coalesce(lead(lon) OVER w, lon) AS qlon
    FROM cut WINDOW w AS (PARTITION BY segment ORDER BY t, image_id)
), moved AS (SELECT *, radians(qlon - plon) * 6371000.0::DOUBLE * cos(radians(plat)) AS de, radians(qlat - plat) * 6371000.0::DOUBLE AS dn FROM near),
travel AS (
    SELECT image_id, segment, lat, lon, CASE WHEN sqrt(de * de + dn * dn) > 0 THEN de / sqrt(de * de + dn * dn) END AS ux,
           CASE WHEN sqrt(de * de + dn * dn) > 0 THEN dn / sqrt(de * de + dn * dn) END AS uy FROM moved
)"""


def _obs(edges: str) -> str:
    return _OBS.replace("EDGES", edges)


_TRUE = "(SELECT src, dst, east, north, p0 AS p, q0 AS q, r0 AS r, s0 AS s, tx0 AS tx, ty0 AS ty FROM true_edges)"

_PHOTOS = """
photos AS (
    SELECT k AS image_id, k, k % 10 NOT IN (7, 8) AS has_gps, k % 10 NOT IN (7, 8, 9) AS whole, k % 13 <> 0 AS packet,
           CASE WHEN k % 5 = 0 THEN -1 ELSE 1 END * ((36 + k % 3) + (7 * k % 60) / 60.0::DOUBLE + ((k * 137) % 6000) / 100.0::DOUBLE / 3600.0::DOUBLE) AS elat,
           CASE WHEN k % 3 = 1 THEN -1 ELSE 1 END * ((5 + k % 7) + (11 * k % 60) / 60.0::DOUBLE + ((k * 53) % 6000) / 100.0::DOUBLE / 3600.0::DOUBLE) AS elon
    FROM (SELECT s_suppkey::BIGINT AS k FROM supplier)
), fixes AS (
    SELECT *, CASE WHEN whole THEN 'exif' WHEN k % 10 IN (7, 9) AND packet THEN 'xmp' END AS source,
           CASE WHEN whole THEN elat WHEN k % 10 IN (7, 9) AND packet THEN k % 90 + 0.25::DOUBLE END AS lat,
           CASE WHEN whole THEN elon WHEN k % 10 IN (7, 9) AND packet THEN -(k % 180) - 0.5::DOUBLE END AS lon FROM photos
)"""


def _rational(name: str, num: str, den: int, there: str) -> str:
    """A rational in lowest terms, as two columns."""
    return f"CASE WHEN {there} THEN ({num}) // gcd({num}, {den}) END AS {name}_num, CASE WHEN {there} THEN {den} // gcd({num}, {den}) END AS {name}_den"


_LON = "has_gps AND k % 10 <> 9"
_POSES = """
placed AS (
    SELECT image_id, cos(radians(yaw)) AS c, sin(radians(yaw)) AS s, 30.25::DOUBLE * e AS mx, -30.25::DOUBLE * nn AS my FROM survey
), corners AS (
    SELECT image_id, mx + c * (x - 2000) - s * (y - 1500) AS px, my + s * (x - 2000) + c * (y - 1500) AS py
    FROM placed, (VALUES (0.0::DOUBLE, 0.0::DOUBLE), (4000, 0), (4000, 3000), (0, 3000)) v(x, y)
), boxes AS (SELECT image_id AS id, min(px) AS x0, min(py) AS y0, max(px) AS x1, max(py) AS y1 FROM corners GROUP BY image_id)"""
_COUNTED = "counted AS (SELECT src, dst, count(*) FILTER (is_inlier) AS inlier_count, count(*) AS match_count FROM matches GROUP BY src, dst)"
_ORIGIN = """
origin AS (SELECT lat AS lat0, lon AS lon0 FROM survey WHERE image_id = (SELECT min(image_id) FROM survey)),
metres AS (SELECT s.*, radians(lon - lon0) * 6371000.0::DOUBLE * cos(radians(lat0)) AS east, radians(lat - lat0) * 6371000.0::DOUBLE AS north FROM survey s, origin)"""

_WEIGHED = "weighed AS (SELECT node, h, (1 + src % 3) / (radians(1.691) * radians(1.691)) AS base FROM obs)"


def _anchors(rounds: int) -> str:
    """Huber rounds one behind the other."""
    parts = ["round0 AS (SELECT node, atan2(sum(base * sin(h)), sum(base * cos(h))) AS m FROM weighed GROUP BY node)"]
    for k in range(1, rounds + 1):
        z = f"(abs({_WRAP.format('(h - m)')}) / radians(1.691))"
        w = f"base * CASE WHEN {z} <= 1.345 THEN 1 ELSE 1.345 / {z} END"
        parts.append(f"round{k} AS MATERIALIZED (SELECT node, atan2(sum({w} * sin(h)), sum({w} * cos(h))) AS m FROM weighed JOIN round{k - 1} USING (node) GROUP BY node)")
    return ",\n".join(parts)


_LAG = f"""
late AS (SELECT image_id, ux, uy, CASE WHEN ux IS NULL THEN lat ELSE lat + degrees(2.3::DOUBLE * uy / 6371000.0::DOUBLE) END AS lat,
         CASE WHEN ux IS NULL THEN lon ELSE lon + degrees(2.3::DOUBLE * ux / (cos(radians(lat)) * 6371000.0::DOUBLE)) END AS lon FROM travel),
told AS (
    SELECT g.src, g.dst, bx, by_, fx, fy, radians(b.lon - a.lon) * 6371000.0::DOUBLE * cos(radians(a.lat)) AS east, radians(b.lat - a.lat) * 6371000.0::DOUBLE AS north,
           b.ux - a.ux AS dux, b.uy - a.uy AS duy FROM geo g JOIN late a ON a.image_id = g.src JOIN late b ON b.image_id = g.dst WHERE a.ux IS NOT NULL AND b.ux IS NOT NULL
), sides AS (
    SELECT src AS node, 1.0::DOUBLE AS side, atan2(by_, bx) AS alpha, east, north, dux, duy FROM told
    UNION ALL SELECT dst, -1.0::DOUBLE, atan2(fy, fx), east, north, dux, duy FROM told
), turned AS (
    SELECT step, node, {_WRAP.format("(atan2(-side * (north - l * duy), side * (east - l * dux)) - alpha)")} AS h
    FROM sides, (SELECT i AS step, -10.0::DOUBLE + 0.05::DOUBLE * i AS l FROM range(401) t(i))
), means AS (SELECT step, node, atan2(sum(sin(h)), sum(cos(h))) AS m FROM turned GROUP BY step, node HAVING count(*) >= 3),
zs AS (SELECT step, abs({_WRAP.format("(h - m)")}) / radians(1.691) AS z FROM turned JOIN means USING (step, node))"""

def _few(sql: str) -> str:
    """The survey with an image for each supplier."""
    return sql.replace("c_custkey", "s_suppkey").replace("FROM customer", "FROM supplier")


_STRIP = """
strip AS (SELECT n_nationkey::BIGINT AS image_id, n_nationkey * 37 % 200 + 20 AS grey FROM nation),
seams AS (SELECT a.image_id AS src, b.image_id AS dst, 8 * (10 - 6 * (b.image_id - a.image_id)) * 3 AS n, abs(a.grey - b.grey) / 255.0::DOUBLE AS d FROM strip a JOIN strip b ON b.image_id = a.image_id + 1)"""


ORACLES = {
    "inlier_stats_by_pair": "SELECT l_orderkey AS pair, count(*) FILTER (l_returnflag <> 'R') AS inlier_count, count(*) AS match_count, round(count(*) FILTER (l_returnflag <> 'R')::DOUBLE / count(*), 9) AS inlier_ratio FROM lineitem GROUP BY 1",
    "inlier_stats_global": "SELECT count(*) FILTER (l_returnflag <> 'R') AS inlier_count, count(*) AS match_count, round(count(*) FILTER (l_returnflag <> 'R')::DOUBLE / count(*), 9) AS inlier_ratio FROM lineitem",
    "inlier_median_reference": "SELECT median(c)::DOUBLE AS median_inliers FROM (SELECT count(*) FILTER (l_returnflag <> 'R') AS c FROM lineitem GROUP BY l_orderkey)",
    "proximity_pairs": f"WITH {_NODES} SELECT src, dst FROM pairs",
    "sequential_pairs": "SELECT * FROM (SELECT o_custkey, o_orderkey AS src, lead(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS dst FROM orders) WHERE dst IS NOT NULL",
    "all_pairs": "SELECT a.n_nationkey AS src, b.n_nationkey AS dst FROM nation a JOIN nation b ON a.n_nationkey < b.n_nationkey",
    "bbox_overlap_pairs": """
WITH boxes AS (
    SELECT vec_id AS id, least(embedding[1], embedding[2])::DOUBLE AS x0, least(embedding[3], embedding[4])::DOUBLE AS y0,
           greatest(embedding[1], embedding[2])::DOUBLE AS x1, greatest(embedding[3], embedding[4])::DOUBLE AS y1 FROM embeddings
)
SELECT a.id AS src, b.id AS dst FROM boxes a JOIN boxes b ON a.id < b.id AND a.x0 <= b.x1 AND b.x0 <= a.x1 AND a.y0 <= b.y1 AND b.y0 <= a.y1""",
    "reprojection_rmse": f"WITH {_NODES}, {_MATCHES} SELECT round(sqrt(avg(2 * wob * wob)), 6) AS reprojection_error_px FROM matches WHERE is_inlier",
    "pair_metrics": f"""
WITH {_NODES}, {_MATCHES}
SELECT src, dst, count(*) AS match_count, count(*) FILTER (is_inlier) AS inlier_count, round(count(*) FILTER (is_inlier)::DOUBLE / count(*), 9) AS inlier_ratio,
       round(sqrt(avg(2 * wob * wob) FILTER (is_inlier)), 6) AS reprojection_error_px FROM matches GROUP BY src, dst""",
    "cycle_loop_error": f"""
WITH {_NODES}, tri AS (
    SELECT ab.*, bc.p AS p2, bc.q AS q2, bc.r AS r2, bc.s AS s2, bc.tx AS x2, bc.ty AS y2, ac.p AS p3, ac.q AS q3, ac.r AS r3, ac.s AS s3, ac.tx AS x3, ac.ty AS y3
    FROM false_edges ab JOIN false_edges bc ON bc.src = ab.dst JOIN false_edges ac ON ac.src = ab.src AND ac.dst = bc.dst
), pts AS (SELECT * FROM (VALUES (0.0::DOUBLE, 0.0::DOUBLE), (100, 0), (100, 100), (0, 100), (50, 50)) v(x, y)),
one AS (SELECT *, p * x + q * y + tx AS xa, r * x + s * y + ty AS ya, row_number() OVER () AS rn FROM tri, pts),
two AS (SELECT *, p2 * xa + q2 * ya + x2 - x3 AS xb, r2 * xa + s2 * ya + y2 - y3 AS yb, p3 * s3 - q3 * r3 AS d FROM one),
three AS (SELECT *, (s3 * xb - q3 * yb) / d - x AS ex, (p3 * yb - r3 * xb) / d - y AS ey FROM two)
SELECT round(avg(err), 4) AS cycle_loop_error_px FROM (SELECT sqrt(avg(ex * ex + ey * ey)) AS err FROM three GROUP BY src, dst, p2, q2, x2, y2, p3, x3, y3)""",
    "distortion": f"""
WITH {_NODES}, sv AS (
    SELECT (sqrt((p + s) * (p + s) + (q - r) * (q - r)) + sqrt((p - s) * (p - s) + (q + r) * (q + r))) / 2 AS a,
           abs(sqrt((p + s) * (p + s) + (q - r) * (q - r)) - sqrt((p - s) * (p - s) + (q + r) * (q + r))) / 2 AS b FROM false_edges
) SELECT round(avg(abs(ln(a / b))), 9) AS distortion FROM sv WHERE b > 1e-9""",
    "flight_segments": """
WITH e AS (SELECT user_id, event_id, epoch_us(ts) / 1e6::DOUBLE AS t FROM events),
g AS (SELECT *, t - lag(t) OVER (PARTITION BY user_id ORDER BY t, event_id) AS gap FROM e),
m AS (SELECT user_id, 3 * median(gap) AS lim FROM g GROUP BY user_id)
SELECT user_id, (count(*) FILTER (gap > lim) + 1)::BIGINT AS segments, count(*) AS events FROM g JOIN m USING (user_id) GROUP BY user_id""",
    "travel_directions": f"WITH {_NODES}, {_SEGMENTED} SELECT image_id, segment, round(ux, 6) AS ux, round(uy, 6) AS uy FROM travel",
    "shift_by_lag": f"""
WITH {_NODES}, {_SEGMENTED}
SELECT image_id, round(CASE WHEN ux IS NULL THEN lat ELSE lat - degrees(2.3::DOUBLE * uy / 6371000.0::DOUBLE) END, 9) AS lat,
       round(CASE WHEN ux IS NULL THEN lon ELSE lon - degrees(2.3::DOUBLE * ux / (cos(radians(lat)) * 6371000.0::DOUBLE)) END, 9) AS lon FROM travel""",
    "circular_mean_time_of_day": """
WITH h AS (SELECT event_type, value, (epoch_us(ts) % 86400000000) / 1e6::DOUBLE * (2 * pi() / 86400) AS h FROM events)
SELECT event_type, round(atan2(sum((1 + abs(value)) * sin(h)), sum((1 + abs(value)) * cos(h))), 6) AS mean_angle FROM h GROUP BY event_type""",
    "heading_observations": f"WITH {_NODES}, {_obs(_TRUE)} SELECT src, dst, node, round(h, 6) AS h FROM obs",
    "heading_consensus": f"WITH {_NODES}, {_obs('false_edges')}, {_CONSENSUS} SELECT node, round(heading, 6) AS heading, n_agree, n_obs, trusted FROM trust",
    "edge_consistency_reasons": f"WITH {_NODES}, {_obs('false_edges')}, {_CONSENSUS}, {_JUDGED} SELECT src, dst, reason FROM judged",
    "rejection_histogram": f"WITH {_NODES}, {_obs('false_edges')}, {_CONSENSUS}, {_JUDGED} SELECT reason, count(*) AS count FROM judged WHERE reason IS NOT NULL GROUP BY reason",
    "median_px_per_metre": f"WITH {_NODES}, {_obs('false_edges')} SELECT round(median(sqrt(bx * bx + by_ * by_) / metres), 6) AS px_per_m FROM geo WHERE metres >= 5",
    "densest_window": """
WITH v AS (SELECT l_returnflag, ln(l_extendedprice / l_quantity) AS lv FROM lineitem WHERE l_extendedprice / l_quantity > 0),
n AS (SELECT *, count(*) OVER (PARTITION BY l_returnflag ORDER BY lv RANGE BETWEEN 0.08 PRECEDING AND 0.08 FOLLOWING) AS n FROM v)
SELECT l_returnflag, round(exp(lv), 6) AS mode, n AS support FROM (SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY n DESC, lv) AS place FROM n) WHERE place = 1""",
    "connected_components": f"""
WITH RECURSIVE {_NODES}, links AS (
    SELECT src, dst FROM pairs
), both_ways AS (SELECT src, dst FROM links UNION ALL SELECT dst, src FROM links),
reach(image_id, root) AS (SELECT image_id, image_id FROM survey UNION SELECT b.dst, r.root FROM reach r JOIN both_ways b ON b.src = r.image_id)
SELECT image_id, min(root) AS component FROM reach GROUP BY image_id""",
    "attribute_map_extract": r"""
WITH a AS (SELECT page_id, unnest(regexp_extract_all(html, '([A-Za-z][\w:.-]*)="([^"]*)"', 1)) AS k, unnest(regexp_extract_all(html, '([A-Za-z][\w:.-]*)="([^"]*)"', 2)) AS v,
           generate_subscripts(regexp_extract_all(html, '([A-Za-z][\w:.-]*)="([^"]*)"', 1), 1) AS i FROM pages),
l AS (SELECT page_id, k, arg_max(v, i) AS v FROM a GROUP BY page_id, k)
SELECT p.page_id, count(l.k) AS attributes, max(l.v) FILTER (l.k = 'lang') AS lang, max(l.v) FILTER (l.k = 'href') AS href FROM pages p LEFT JOIN l ON l.page_id = p.page_id GROUP BY p.page_id""",
    "provenance_coalesce": """
SELECT d.doc_id, CASE WHEN l.quality IS NOT NULL AND l.toxic IS NOT NULL THEN l.quality::DOUBLE ELSE d.n_chars::DOUBLE END AS x,
       CASE WHEN l.quality IS NOT NULL AND l.toxic IS NOT NULL THEN l.toxic::DOUBLE ELSE 0.0::DOUBLE END AS y,
       CASE WHEN l.quality IS NOT NULL AND l.toxic IS NOT NULL THEN 'label' ELSE 'size' END AS origin FROM documents d LEFT JOIN labels l USING (doc_id)""",
    "run_status": """
SELECT o_custkey, total, ok, CASE WHEN ok = total THEN 'success' WHEN total > 1 AND ok >= 2 THEN 'partial_success' ELSE 'failed' END AS status, round(ok::DOUBLE / total, 9) AS success_rate
FROM (SELECT o_custkey, count(*) AS total, count(*) FILTER (o_orderstatus <> 'F') AS ok FROM orders GROUP BY o_custkey)""",
    "exif_gps_fields": f"""
WITH {_PHOTOS} SELECT image_id, has_gps, CASE WHEN has_gps THEN CASE WHEN k % 5 = 0 THEN 'S' ELSE 'N' END END AS lat_ref,
       CASE WHEN {_LON} THEN CASE WHEN k % 3 = 1 THEN 'W' ELSE 'E' END END AS lon_ref,
       {_rational("lat0", "36 + k % 3", 1, "has_gps")}, {_rational("lat1", "7 * k % 60", 1, "has_gps")}, {_rational("lat2", "(k * 137) % 6000 * 2", 200, "has_gps")},
       {_rational("lon0", "5 + k % 7", 1, _LON)}, {_rational("lon1", "11 * k % 60", 1, _LON)}, {_rational("lon2", "(k * 53) % 6000", 100, _LON)} FROM photos""",
    "gps_positions": f"""
WITH {_PHOTOS} SELECT image_id, round(lat, 9) AS lat, round(lon, 9) AS lon, source,
       round(CASE WHEN source IS NULL THEN NULL WHEN k % 4 = 0 AND packet THEN (k % 300) / 2.0::DOUBLE WHEN has_gps THEN CASE WHEN k % 6 = 0 THEN -1 ELSE 1 END * (k % 400 + 1) / 4.0::DOUBLE END, 6) AS abs_alt_m,
       CASE WHEN source IS NOT NULL AND k % 3 <> 0 AND packet THEN k % 120 + 0.5::DOUBLE END AS rel_alt_m FROM fixes""",
    "exif_latlons": f"WITH {_PHOTOS} SELECT image_id, round(lat, 9) AS lat, round(lon, 9) AS lon FROM fixes WHERE source = 'exif'",
    "capture_times": f"""
WITH {_PHOTOS} SELECT image_id, round(epoch(make_timestamp(2024, 1 + k % 12, 1 + k % 28, k % 24, k * 7 % 60, (k * 13 % 60)::DOUBLE)) + CASE WHEN k % 3 = 0 THEN (k % 1000) / 1000.0::DOUBLE ELSE 0 END, 6) AS t
FROM photos WHERE k % 11 NOT IN (5, 6)""",
    "gimbal_yaws": f"""
WITH {_PHOTOS}, yaws AS (SELECT image_id, (k * 13 % 3600) / 10.0::DOUBLE - 180 AS y FROM photos WHERE k % 7 <> 3 AND packet), least AS (SELECT arg_min(y, image_id) AS y0 FROM yaws)
SELECT image_id, round(y, 6) AS gimbal_yaw_deg, round((y - y0 + 180) - floor((y - y0 + 180) / 360) * 360 - 180, 6) AS relative_deg FROM yaws, least""",
    "camera_attributes": f"""
WITH {_PHOTOS} SELECT image_id, (CASE WHEN packet THEN 2 * (k % 10 IN (7, 9))::INT + (k % 4 = 0)::INT + (k % 3 <> 0)::INT + (k % 7 <> 3)::INT ELSE 0 END)::BIGINT AS attributes,
       CASE WHEN packet AND k % 3 <> 0 THEN '+' || format('{{:.2f}}', k % 120 + 0.5::DOUBLE) END AS relative, NULL::VARCHAR AS other_yaw FROM photos""",
    "projected_positions": f"WITH {_NODES}, {_ORIGIN} SELECT image_id, round(east, 6) + 0.0 AS east, round(north, 6) + 0.0 AS north FROM metres",
    "gps_placement": f"""
WITH {_NODES}, origin AS (SELECT lat AS lat0, lon AS lon0 FROM survey WHERE image_id = 1)
SELECT image_id, image_id % 7 <> 3 AS located, CASE WHEN image_id % 7 <> 3 THEN round(30.25::DOUBLE * radians(lon - lon0) * 6371000.0::DOUBLE * cos(radians(lat0)), 4) + 0.0 END AS x,
       CASE WHEN image_id % 7 <> 3 THEN round(-30.25::DOUBLE * radians(lat - lat0) * 6371000.0::DOUBLE, 4) + 0.0 END AS y FROM survey, origin""",
    "pixels_per_metre": f"WITH {_NODES} SELECT 60.0::DOUBLE + 10 * (image_id % 9) AS altitude, round(max(5000 / (2 * (60.0::DOUBLE + 10 * (image_id % 9)) * tan(radians(77.0::DOUBLE) / 2))), 9) AS px_per_m, count(*) AS images FROM survey GROUP BY 1",
    "usable_edges": f"""
WITH {_NODES}, {_MATCHES} SELECT src, dst, count(*) FILTER (is_inlier AND (src + k) % 3 > 0) AS inlier_count FROM matches
GROUP BY src, dst HAVING count(*) FILTER (is_inlier AND (src + k) % 3 > 0) >= 4 AND (src * 5 + dst) % 17 NOT IN (0, 1, 2)""",
    "edge_weights": f"WITH {_NODES}, {_MATCHES}, {_COUNTED} SELECT src, dst, round(inlier_count / (SELECT median(inlier_count) FROM counted), 9) AS weight FROM counted",
    "heading_anchors": f"WITH {_NODES}, {_obs('false_edges')}, {_WEIGHED}, {_anchors(20)} SELECT node, round(m, 6) AS heading FROM round20",
    "plain_heading_anchors": f"WITH {_NODES}, {_obs('false_edges')}, {_WEIGHED}, {_anchors(0)} SELECT node, round(m, 6) AS heading FROM round0",
    "component_offsets": f"""
WITH {_NODES}, {_obs(_TRUE)}, turns AS (
    SELECT floor(image_id / 5.0)::BIGINT AS component, 1 + src % 3 AS w, h - (radians(yaw) - 0.001::DOUBLE * (image_id % 5)) AS d FROM obs JOIN survey ON image_id = node
) SELECT component, round(atan2(sum(w * sin(d)), sum(w * cos(d))), 6) AS offset FROM turns GROUP BY component""",
    "aligned_poses": f"""
WITH {_NODES}, {_ORIGIN}, p AS (SELECT image_id, cos(radians(yaw)) AS c, sin(radians(yaw)) AS s, 30.25::DOUBLE * east AS x, -30.25::DOUBLE * north AS y FROM metres)
SELECT image_id, round(c, 4) AS t00, round(-s, 4) AS t01, round(x - (c * 2000 - s * 1500), 4) AS t02, round(s, 4) AS t10, round(c, 4) AS t11, round(y - (s * 2000 + c * 1500), 4) AS t12 FROM p""",
    "numbered_components": f"WITH {_NODES} SELECT image_id AS node, (dense_rank() OVER (ORDER BY floor(image_id / 20.0)) - 1)::BIGINT AS component FROM survey",
    "failure_reasons": f"""
WITH {_NODES}, judged AS (
    SELECT image_id, CASE WHEN image_id % 2 = 0 AND image_id % 5 <> 1 AND image_id % 7 <> 2 AND image_id % 3 <> 0 THEN NULL WHEN image_id % 5 = 1 THEN 'no_determined_edge'
           WHEN image_id % 7 = 2 THEN 'unlocated' WHEN image_id % 3 = 0 THEN 'no_consistent_edge' WHEN image_id % 11 < 4 THEN 'unaligned_component' ELSE 'unoriented' END AS reason FROM survey
) SELECT image_id, reason FROM judged WHERE reason IS NOT NULL""",
    "canvas_size": f"WITH {_NODES}, {_POSES} SELECT round(min(x0), 4) AS x0, round(min(y0), 4) AS y0, ceil(max(y1) - min(y0))::BIGINT AS height, ceil(max(x1) - min(x0))::BIGINT AS width FROM boxes",
    "canvas_boxes": f"WITH {_NODES}, {_POSES} SELECT id AS image_id, round(x0, 4) AS x0, round(y0, 4) AS y0, round(x1, 4) AS x1, round(y1, 4) AS y1 FROM boxes",
    "overlapping_footprints": f"WITH {_NODES}, {_POSES} SELECT a.id AS src, b.id AS dst FROM boxes a JOIN boxes b ON a.id < b.id AND a.x0 <= b.x1 AND b.x0 <= a.x1 AND a.y0 <= b.y1 AND b.y0 <= a.y1",
    "finite_transforms": f"WITH {_NODES} SELECT image_id FROM survey WHERE image_id % 9 NOT IN (1, 2, 3)",
    "summary_metrics": f"""
WITH {_NODES}, {_MATCHES}, images AS (SELECT count(*) AS n, count(*) FILTER (image_id % 4 <> 0) AS ok FROM survey)
SELECT CASE WHEN ok = n THEN 'success' WHEN n > 1 AND ok >= 2 THEN 'partial_success' ELSE 'failed' END AS pipeline_status, n AS input_image_count, ok AS successful_image_count, n - ok AS failed_image_count,
       (SELECT count(*) FILTER (is_inlier) FROM matches) AS inlier_count, 'closed form' AS method, round(ok::DOUBLE / n, 6) AS stitch_success_rate, round(60.0::DOUBLE / n, 6) AS avg_processing_time_per_image_sec,
       (SELECT round(sqrt(avg(2 * wob * wob) FILTER (is_inlier)), 6) FROM matches) AS reprojection_error_px, (SELECT round(count(*) FILTER (is_inlier)::DOUBLE / count(*), 6) FROM matches) AS inlier_ratio,
       0.0::DOUBLE AS distortion, n - ok AS failed, true AS no_seam FROM images""",
    "lag_objective": f"WITH {_NODES}, {_SEGMENTED}, {_obs(_TRUE)}, {_LAG} SELECT step::INT AS step, round(sum(CASE WHEN z <= 1.345 THEN z * z / 2 ELSE 1.345 * (z - 0.6725) END), 2) AS objective FROM zs GROUP BY step",
    "huber_losses": "WITH v AS (SELECT l_linestatus, abs(l_discount - 0.05::DOUBLE) / 0.02::DOUBLE AS z FROM lineitem) SELECT l_linestatus, round(sum(CASE WHEN z <= 1.345 THEN z * z / 2 ELSE 1.345 * (z - 0.6725) END), 4) AS loss FROM v GROUP BY l_linestatus",
    "edge_sigmas": f"WITH {_NODES}, {_MATCHES} SELECT src, dst, round(greatest(CASE WHEN src % 2 = 1 THEN 0 ELSE coalesce(sqrt(avg(2 * wob * wob) FILTER (is_inlier)), 0) END, 0.1::DOUBLE), 6) AS sigma FROM matches GROUP BY src, dst",
    "relative_maps": f"""
WITH {_NODES}, {_MATCHES}, {_COUNTED} SELECT src, dst, round(p, 6) + 0.0 AS m00, round(q, 6) + 0.0 AS m01, round(r, 6) + 0.0 AS m10, round(s, 6) + 0.0 AS m11, round(tx, 6) + 0.0 AS mx, round(ty, 6) + 0.0 AS my, round(inlier_count / 4.0::DOUBLE, 6) AS weight
FROM false_edges JOIN counted USING (src, dst)""",
    "node_sets": f"""
WITH {_NODES}, links AS (SELECT src, dst FROM pairs WHERE (src + dst) % 4 = 0 AND src % 6 <> 5), seen AS (SELECT src AS image_id FROM links UNION SELECT dst FROM links),
kinds AS (
    SELECT 'evidenced' AS kind, image_id FROM survey WHERE image_id IN (SELECT image_id FROM seen)
    UNION ALL SELECT 'without_edge', image_id FROM survey WHERE image_id NOT IN (SELECT image_id FROM seen)
    UNION ALL SELECT 'unposed', image_id FROM seen WHERE image_id % 3 = 1
    UNION ALL SELECT 'either', image_id FROM (SELECT image_id FROM seen UNION SELECT image_id FROM survey WHERE image_id % 3 <> 1)
) SELECT k.kind, count(image_id) AS n, sum(image_id)::BIGINT AS ids FROM (VALUES ('evidenced'), ('without_edge'), ('unposed'), ('either')) k(kind) LEFT JOIN kinds USING (kind) GROUP BY k.kind""",
    "edge_endpoints": f"""
WITH {_NODES} SELECT src, dst, round({_WRAP.format("(radians(yb) - radians(ya))")}, 6) AS turn, floor(src / 15.0)::BIGINT AS component
FROM pairs WHERE src % 4 <> 2 AND dst % 4 <> 2 AND floor(src / 15.0) = floor(dst / 15.0)""",
    "rounded_half_even": "SELECT round_even(floor(l_quantity) / 2, 0)::BIGINT AS grey, count(*) AS n FROM lineitem GROUP BY 1",
    "rotation_averages": f"""
WITH {_NODES}, ids AS (SELECT image_id, (image_id % 5)::DOUBLE AS p, floor(image_id / 5.0) AS line FROM survey), firsts AS (SELECT line, min(image_id) AS least, arg_min(p, image_id) AS p0, count(*) AS n FROM ids GROUP BY line)
SELECT image_id AS node, round({_WRAP.format("(0.7::DOUBLE * (p * p - p0 * p0))")}, 6) + 0.0 AS angle, least AS component FROM ids JOIN firsts USING (line) WHERE n > 1""",
    "anchored_rotations": f"""
WITH {_NODES}, ids AS (SELECT image_id, floor(image_id / 5.0) AS line FROM survey), lines AS (SELECT line, min(image_id) AS least, count(*) AS n FROM ids GROUP BY line)
SELECT image_id AS node, round(0.05::DOUBLE * (image_id - least) + CASE WHEN line % 2 = 0 THEN 0.001::DOUBLE * line - 0.5 ELSE 0 END, 6) + 0.0 AS angle
FROM ids JOIN lines USING (line) WHERE n > 1 OR image_id % 10 = 0""",
    "matched_homographies": _few(f"""
WITH {_NODES} SELECT src, dst, round(p, 4) + 0.0 AS h00, round(q, 4) + 0.0 AS h01, round(tx, 4) + 0.0 AS h02, round(r, 4) + 0.0 AS h10, round(s, 4) + 0.0 AS h11, round(ty, 4) + 0.0 AS h12,
       10::BIGINT AS match_count, 9::BIGINT AS inlier_count, NULL::VARCHAR AS error FROM false_edges"""),
    "lag_estimate": "SELECT 2.3::DOUBLE AS lag_m, 'estimated' AS status, NULL::VARCHAR AS reason",
    "global_poses": _few(f"""
WITH {_NODES}, zero AS (SELECT e AS e0, nn AS n0 FROM survey WHERE image_id = (SELECT min(image_id) FROM survey))
SELECT image_id, round(yaw, 1) AS turn, round(e - e0, 0) + 0.0 AS east, round(n0 - nn, 0) + 0.0 AS south FROM survey, zero"""),
    "refined_positions": _few(f"""
WITH {_NODES}, zero AS (SELECT e AS e0, nn AS n0 FROM survey WHERE image_id = (SELECT min(image_id) FROM survey))
SELECT image_id, round(30.25::DOUBLE * (e - e0), 1) + 0.0 AS x, round(30.25::DOUBLE * (n0 - nn), 1) + 0.0 AS y, 'converged' AS status FROM survey, zero"""),
    "pose_graph": _few(f"""
WITH {_NODES}, zero AS (SELECT e AS e0, nn AS n0, yaw AS y0 FROM survey WHERE image_id = 0),
turned AS (SELECT image_id, cos(radians(yaw - y0)) AS c, sin(radians(yaw - y0)) AS s, cos(radians(-y0)) AS bc, sin(radians(-y0)) AS bs, 30.25::DOUBLE * (e - e0) AS px, -30.25::DOUBLE * (nn - n0) AS py FROM survey, zero)
SELECT image_id, round(c, 3) + 0.0 AS a, round(s, 3) + 0.0 AS b, round(2000 + bc * px - bs * py - (c * 2000 - s * 1500), 3) + 0.0 AS tx, round(1500 + bs * px + bc * py - (s * 2000 + c * 1500), 3) + 0.0 AS ty FROM turned"""),
    "yaw_targets": _few(f"""
WITH {_NODES}, zero AS (SELECT yaw AS y0 FROM survey WHERE image_id = (SELECT min(image_id) FROM survey))
SELECT image_id, round(cos(radians(yaw - y0)), 6) + 0.0 AS u, round(sin({_WRAP.format("radians(yaw - y0)")}), 6) + 0.0 AS v FROM survey, zero"""),
    "spread_samples": _few(f"WITH {_NODES}, {_MATCHES} SELECT src, dst, count(*) AS n, sum(k)::BIGINT AS ks FROM matches WHERE is_inlier GROUP BY src, dst"),
    "warped_pixels": f"WITH {_STRIP} SELECT image_id, 80::BIGINT AS pixels, (240 * grey)::BIGINT AS total FROM strip",
    "seam_differences": f"WITH {_STRIP} SELECT src, dst, round(n * d, 4) AS total, n::BIGINT AS n FROM seams",
    "seam_error": f"WITH {_STRIP} SELECT round(sum(n * d) / sum(n), 6) AS seam_error, round(sum(n * d) / sum(n), 6) AS in_band FROM seams",
    "blend_shares": f"WITH {_STRIP} SELECT count(*) AS images, (8 * (6 * max(image_id) + 10))::DOUBLE AS pixels FROM strip",
    "run_pipeline": """
SELECT run, status AS pipeline_status, n AS input_image_count, ok AS successful_image_count, n - ok AS failed_image_count, 0::BIGINT AS inlier_count, n - ok AS listed, 'unmatched' AS method
FROM (SELECT 'none' AS run, 'failed' AS status, 0::BIGINT AS n, 0::BIGINT AS ok UNION ALL SELECT 'one', 'success', 1, 1 UNION ALL SELECT 'unlocated', 'failed', (SELECT count(*) FROM nation), 0)""",
    "capture_sessions": """
WITH g AS (SELECT user_id, epoch_us(ts) AS t, epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts) AS gap FROM events),
s AS (SELECT user_id, t, sum(CASE WHEN gap > 7200000000 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY t) AS k FROM g)
SELECT user_id, min(t)::BIGINT AS first_us, max(t)::BIGINT AS last_us, count(*) AS n FROM s GROUP BY user_id, k""",
    "ordered_edges": f"WITH {_NODES} SELECT row_number() OVER (ORDER BY src, dst) - 1 AS edge_ord, src, dst FROM pairs",
}
