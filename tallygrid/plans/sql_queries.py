"""Queries written in SQL over the table functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sql import tables
from . import mapping as M
from .registry import query, sr

_WAYS = """WITH n AS (SELECT l_orderkey AS way, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_suppkey) AS i, l_suppkey AS node FROM lineitem),
shared AS (SELECT node FROM n GROUP BY node HAVING count(DISTINCT way) >= 2)"""


@query(_WAYS + """, m AS (SELECT *, node IN (SELECT node FROM shared) AS inner_cut, row_number() OVER (PARTITION BY way ORDER BY i) AS first, row_number() OVER (PARTITION BY way ORDER BY i DESC) AS last FROM n),
cuts AS (SELECT way, i, lead(i) OVER (PARTITION BY way ORDER BY i) AS j, row_number() OVER (PARTITION BY way ORDER BY i) - 1 AS piece FROM m WHERE inner_cut OR first = 1 OR last = 1)
SELECT c.way AS way_id, CAST(piece AS INT) AS piece, count(*) AS nodes, min(node) AS least FROM cuts c JOIN n ON n.way = c.way AND n.i BETWEEN c.i AND c.j WHERE j IS NOT NULL GROUP BY ALL""")
def sql_split_ways(spark, d):
    """Orders as ways and suppliers as nodes, cut by the table function from SQL, a batch of many ways at a time."""
    tables.register(spark)
    M.table(spark, d, "lineitem").createOrReplaceTempView("tallygrid_lines")
    return spark.sql("""
        WITH nodes AS (
          SELECT l_orderkey AS way_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_suppkey) AS i, CAST(l_suppkey AS DOUBLE) AS lat, 0D AS lon, l_suppkey IN (
            SELECT l_suppkey FROM tallygrid_lines GROUP BY l_suppkey HAVING count(DISTINCT l_orderkey) >= 2) AS shared
          FROM tallygrid_lines)
        SELECT way_id, piece, CAST(size(coords) AS BIGINT) AS nodes, CAST(array_min(transform(coords, p -> p.lat)) AS BIGINT) AS least
        FROM split_way_batches(TABLE(nodes) PARTITION BY pmod(xxhash64(way_id), 4096) ORDER BY (way_id, i))""")


@query(f"""WITH v AS (SELECT l_orderkey AS way, l_linenumber AS i, (l_suppkey % 50) * 1e-4 * {M._K} AS x, (l_partkey % 40) * 1e-4 * 110540e0 AS y FROM lineitem),
e AS (SELECT *, lag(x) OVER w AS ax, lag(y) OVER w AS ay FROM v WINDOW w AS (PARTITION BY way ORDER BY i, y, x))
SELECT way AS id, CAST(sum(CASE WHEN ax IS NULL THEN 1 ELSE floor(sqrt((x - ax) * (x - ax) + (y - ay) * (y - ay)) / 77.7e0) + 1 END) AS BIGINT) AS points, {sr('max(x)', 3)} AS furthest FROM e GROUP BY way""")
def sql_densify_lines(spark, d):
    """Orders as lines in the plane, points put along them by the table function from SQL."""
    tables.register(spark)
    M.table(spark, d, "lineitem").createOrReplaceTempView("tallygrid_lines")
    out = spark.sql(f"""
        WITH lines AS (
          SELECT l_orderkey AS id, transform(array_sort(collect_list(struct(l_linenumber AS i, 38.5D + (l_partkey % 40) * 1e-4D AS lat, -121.7D + (l_suppkey % 50) * 1e-4D AS lon))), p -> struct(p.lat, p.lon)) AS coords
          FROM tallygrid_lines GROUP BY l_orderkey)
        SELECT id, count(*) AS points, max(x) AS furthest FROM densify_lines(TABLE(lines), 77.7D, {M.PLANE.lat0}D, {M.PLANE.lon0}D) GROUP BY id""")
    from .registry import r

    return out.select("id", "points", r(F.col("furthest"), 3).alias("furthest"))
