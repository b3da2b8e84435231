"""Independent SQL (DuckDB dialect) for every query in :mod:`colline.plans.tables`.

The line queries use the textbook method, not the engine's: every half pair,
its gcd-reduced direction and c = ux*y - uy*x, ``GROUP BY`` the line key
``HAVING count(*) >= 3`` (a k-point line has k(k-1)/2 half pairs).  The tables
are views named after the parquet files.
"""

from __future__ import annotations

# The linear map of the wide query, as in ``colline.plans.tables.WIDE_MAP``.
WIDE_MAP = ((1208925819614629174706189, 604462909807314587353111), (604462909807314587353087, -1208925819614629174706201))


def _txt(x: str, y: str) -> str:
    return f"CAST({x} AS VARCHAR) || ' ' || CAST({y} AS VARCHAR)"


def _points_cte(source: str, x: str, y: str, group: str | None) -> str:
    g = f"{group} AS g, " if group else ""
    return (
        f"SELECT DISTINCT {g}CAST({x} AS BIGINT) AS x, CAST({y} AS BIGINT) AS y "
        f"FROM {source} WHERE {x} IS NOT NULL AND {y} IS NOT NULL"
    )


def _lines_ctes(points_sql: str, grouped: bool) -> str:
    """CTEs ``p``, ``kc`` (keyed half pairs), ``lines`` and ``m`` (members)."""
    g = "g, " if grouped else ""
    ag = "a.g AS g, " if grouped else ""
    on_g = "a.g = b.g AND " if grouped else ""
    using = "g, ux, uy, c" if grouped else "ux, uy, c"
    return f"""
p AS ({points_sql}),
hp AS (
  SELECT {ag}a.x AS ax, a.y AS ay, b.x AS bx, b.y AS by_, b.x - a.x AS dx, b.y - a.y AS dy
  FROM p a JOIN p b ON {on_g}(a.x < b.x OR (a.x = b.x AND a.y < b.y))
),
k AS (SELECT {g}ax, ay, bx, by_, dx // gcd(dx, abs(dy)) AS ux, dy // gcd(dx, abs(dy)) AS uy FROM hp),
kc AS (SELECT {g}ax, ay, bx, by_, ux, uy, CAST(CAST(ux AS HUGEINT) * ay - CAST(uy AS HUGEINT) * ax AS DECIMAL(38, 0)) AS c FROM k),
lines AS (SELECT {g}ux, uy, c FROM kc GROUP BY {g}ux, uy, c HAVING count(*) >= 3),
kl AS (SELECT kc.* FROM kc JOIN lines USING ({using})),
m AS (
  SELECT {g}ux, uy, c, ax AS x, ay AS y FROM kl
  UNION
  SELECT {g}ux, uy, c, bx AS x, by_ AS y FROM kl
),
lt AS (
  SELECT {g}ux, uy, c, count(*) AS n_points,
         string_agg({_txt('x', 'y')}, ';' ORDER BY x, y) AS points
  FROM m GROUP BY {g}ux, uy, c
)"""


def lines_sql(source: str, x: str, y: str, group: str | None = None, group_name: str | None = None) -> str:
    grouped = group is not None
    ctes = _lines_ctes(_points_cte(source, x, y, group), grouped)
    gsel = f"g AS {group_name or group}, " if grouped else ""
    return f"WITH {ctes}\nSELECT {gsel}ux, uy, c, n_points, points FROM lt"


SUPPLIER = ("supplier", "s_nationkey", "round(s_acctbal)")
CUSTOMER = ("customer", "c_nationkey", "round(c_acctbal)")
GRID = ("lineitem", "l_linenumber", "l_quantity")

_SLOPE_UXUY = "CASE WHEN ux = 0 THEN CAST('Infinity' AS DOUBLE) ELSE CAST(uy AS DOUBLE) / CAST(ux AS DOUBLE) + 0.0 END"


PER_PART = ("lineitem", "l_linenumber", "l_quantity", "l_partkey")


def line_params_sql() -> str:
    ctes = _lines_ctes(_points_cte(*PER_PART), True)
    return f"""WITH {ctes}
SELECT g AS l_partkey, ux, uy, c, n_points, points,
       ux = 0 AS is_vertical,
       {_SLOPE_UXUY} AS slope,
       CASE WHEN ux = 0 THEN CAST(-c AS DOUBLE) + 0.0 ELSE CAST(c AS DOUBLE) / CAST(ux AS DOUBLE) + 0.0 END AS intercept
FROM lt"""


def _anchor_rows_sql(anchor_last: bool) -> str:
    ctes = _lines_ctes(_points_cte(*PER_PART), True)
    partners = f"string_agg({_txt('b.x', 'b.y')}, ';' ORDER BY b.x, b.y)"
    anchor = _txt("a.x", "a.y")
    pts = f"{partners} || ';' || {anchor}" if anchor_last else f"{anchor} || ';' || {partners}"
    slope = _SLOPE_UXUY.replace("ux", "a.ux").replace("uy", "a.uy")
    return f"""WITH {ctes}
SELECT a.g AS l_partkey, a.x AS ax, a.y AS ay, a.ux = 0 AS is_vertical, {slope} AS slope,
       lt.n_points AS n_points, {pts} AS points
FROM m a
JOIN m b ON a.g = b.g AND a.ux = b.ux AND a.uy = b.uy AND a.c = b.c AND (a.x <> b.x OR a.y <> b.y)
JOIN lt ON lt.g = a.g AND lt.ux = a.ux AND lt.uy = a.uy AND lt.c = a.c
GROUP BY a.g, a.ux, a.uy, a.c, a.x, a.y, lt.n_points"""


def sets_by_anchor_sql() -> str:
    ctes = _lines_ctes(_points_cte(*PER_PART), True)
    return f"""WITH {ctes}
SELECT lt.g AS l_partkey, lt.n_points AS n_points, lt.points AS points FROM lt JOIN m USING (g, ux, uy, c)"""


def lines_large_sql() -> str:
    """The fixed linear map of :data:`colline.plans.tables.LARGE_MAP`; line constants in HUGEINT."""
    x = "CAST(l_linenumber AS BIGINT) * 8589934593 + CAST(l_quantity AS BIGINT) * 4294967311"
    y = "CAST(l_linenumber AS BIGINT) * 4294967291 - CAST(l_quantity AS BIGINT) * 8589934609"
    points = f"SELECT DISTINCT l_partkey AS g, {x} AS x, {y} AS y FROM lineitem"
    return f"WITH {_lines_ctes(points, True)}\nSELECT g AS l_partkey, ux, uy, c, n_points, points FROM lt"


def lines_wide_sql() -> str:
    """The fixed map of :data:`colline.plans.tables.WIDE_MAP` in HUGEINT; line constants from halves of 16 digits."""
    (a, b), (c, d) = WIDE_MAP
    x, y = (f"CAST(l_linenumber AS HUGEINT) * {p} + CAST(l_quantity AS BIGINT)::HUGEINT * ({q})" for p, q in ((a, b), (c, d)))
    h = "10000000000000000::HUGEINT"
    hh = "100000000000000000000000000000000::HUGEINT"
    parts = ", ".join(f"{n} // {h} AS {n}1, {n} % {h} AS {n}0" for n in ("ux", "uy", "ax", "ay"))
    return f"""WITH p AS (SELECT DISTINCT l_partkey AS g, {x} AS x, {y} AS y FROM lineitem),
hp AS (
  SELECT a.g, a.x AS ax, a.y AS ay, b.x AS bx, b.y AS by_, b.x - a.x AS dx, b.y - a.y AS dy
  FROM p a JOIN p b ON a.g = b.g AND (a.x < b.x OR (a.x = b.x AND a.y < b.y))
),
k AS (SELECT g, ax, ay, bx, by_, dx // gcd(dx, abs(dy)) AS ux, dy // gcd(dx, abs(dy)) AS uy FROM hp),
s AS (SELECT *, {parts} FROM k),
t AS (
  SELECT *, ux1 * ay1 - uy1 * ax1 AS hi, ux1 * ay0 + ux0 * ay1 - uy1 * ax0 - uy0 * ax1 AS mid, ux0 * ay0 - uy0 * ax0 AS lo FROM s
),
n AS (SELECT *, ((mid % {h}) + {h}) % {h} AS m0 FROM t),
r AS (SELECT *, lo + m0 * {h} AS rest FROM n),
z AS (SELECT *, ((rest % {hh}) + {hh}) % {hh} AS c_lo FROM r),
kc AS (SELECT *, hi + (mid - m0) // {h} + (rest - c_lo) // {hh} AS c_hi FROM z),
m AS (
  SELECT g, ux, uy, c_hi, c_lo, ax AS x, ay AS y FROM kc
  UNION
  SELECT g, ux, uy, c_hi, c_lo, bx, by_ FROM kc
)
SELECT g AS l_partkey, CAST(ux AS DECIMAL(38, 0)) AS ux, CAST(uy AS DECIMAL(38, 0)) AS uy,
       CAST(c_hi AS DECIMAL(38, 0)) AS c_hi, CAST(c_lo AS DECIMAL(38, 0)) AS c_lo, count(*) AS n_points,
       string_agg({_txt('x', 'y')}, ';' ORDER BY x, y) AS points
FROM m GROUP BY g, ux, uy, c_hi, c_lo HAVING count(*) >= 3"""


def groups_from_pairs_sql() -> str:
    """Ordered pairs grouped by anchor and double slope, three points or more."""
    return f"""WITH p AS ({_order_points(True)}),
op AS (
  SELECT a.l_orderkey, a.x AS ax, a.y AS ay, b.x AS bx, b.y AS by_, a.x = b.x AS is_vertical,
         CASE WHEN a.x = b.x THEN CAST('Infinity' AS DOUBLE)
              ELSE CAST(a.y - b.y AS DOUBLE) / CAST(a.x - b.x AS DOUBLE) + 0.0 END AS slope
  FROM p a JOIN p b ON a.l_orderkey = b.l_orderkey AND (a.x <> b.x OR a.y <> b.y)
)
SELECT l_orderkey, ax, ay, is_vertical, slope, count(*) + 1 AS n_points,
       {_txt('ax', 'ay')} || ';' || string_agg({_txt('bx', 'by_')}, ';' ORDER BY bx, by_) AS points
FROM op GROUP BY l_orderkey, ax, ay, is_vertical, slope HAVING count(*) >= 2"""


def points_quarantine_sql() -> str:
    whole = "c_nationkey IS NOT NULL AND c_acctbal IS NOT NULL AND c_acctbal = floor(c_acctbal)"
    return f"""SELECT c_custkey, CASE WHEN {whole} THEN CAST(c_nationkey AS BIGINT) END AS x,
       CASE WHEN {whole} THEN CAST(c_acctbal AS BIGINT) END AS y, {whole} AS accepted
FROM customer"""


def same_sets_sql() -> str:
    """Reference method (ordered pairs grouped by anchor and double slope) against
    the line-key method, per part; EXCEPT both ways."""
    ctes = _lines_ctes(_points_cte("lineitem", "l_linenumber", "l_quantity", "l_partkey"), True)
    return f"""WITH {ctes},
op AS (
  SELECT a.g, a.x AS ax, a.y AS ay, b.x AS bx, b.y AS by_,
         CASE WHEN a.x = b.x THEN CAST('Infinity' AS DOUBLE)
              ELSE CAST(a.y - b.y AS DOUBLE) / CAST(a.x - b.x AS DOUBLE) + 0.0 END AS s
  FROM p a JOIN p b ON a.g = b.g AND (a.x <> b.x OR a.y <> b.y)
),
ag AS (SELECT g, ax, ay, s FROM op GROUP BY g, ax, ay, s HAVING count(*) >= 2),
am AS (
  SELECT ag.g, ag.ax, ag.ay, ag.s, op.bx AS x, op.by_ AS y FROM ag JOIN op USING (g, ax, ay, s)
  UNION ALL
  SELECT g, ax, ay, s, ax AS x, ay AS y FROM ag
),
lset AS (
  SELECT DISTINCT g, string_agg({_txt('x', 'y')}, ';' ORDER BY x, y) AS pts FROM am GROUP BY g, ax, ay, s
),
rset AS (SELECT DISTINCT g, points AS pts FROM lt)
SELECT (SELECT count(*) FROM lset) AS n_left,
       (SELECT count(*) FROM rset) AS n_right,
       (SELECT count(*) FROM (SELECT g, pts FROM lset EXCEPT SELECT g, pts FROM rset) t) AS n_only_left,
       (SELECT count(*) FROM (SELECT g, pts FROM rset EXCEPT SELECT g, pts FROM lset) t) AS n_only_right"""


def _order_points(distinct: bool) -> str:
    d = "DISTINCT " if distinct else ""
    return (
        f"SELECT {d}l_orderkey, CAST(l_linenumber AS BIGINT) AS x, CAST(l_quantity AS BIGINT) AS y "
        "FROM lineitem WHERE l_linenumber IS NOT NULL AND l_quantity IS NOT NULL"
    )


def pairs_sql(distinct: bool, slopes: bool = False) -> str:
    cond = " AND (a.x <> b.x OR a.y <> b.y)" if distinct else ""
    extra = ""
    if slopes:
        extra = (
            ", (a.x = b.x AND a.y <> b.y) AS is_vertical, "
            "CASE WHEN a.x = b.x AND a.y = b.y THEN NULL "
            "WHEN a.x = b.x THEN CAST('Infinity' AS DOUBLE) "
            "ELSE CAST(a.y - b.y AS DOUBLE) / CAST(a.x - b.x AS DOUBLE) + 0.0 END AS slope"
        )
    return f"""WITH p AS ({_order_points(distinct)})
SELECT a.l_orderkey AS l_orderkey, a.x AS ax, a.y AS ay, b.x AS bx, b.y AS by_{extra}
FROM p a JOIN p b ON a.l_orderkey = b.l_orderkey{cond}"""


def parse_points_sql() -> str:
    return """SELECT CAST(l_linenumber AS VARCHAR) || ' ' || CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS value,
       CAST(l_linenumber AS BIGINT) AS x, CAST(l_quantity AS BIGINT) AS y
FROM lineitem"""


def parse_points_permissive_sql() -> str:
    return """SELECT CAST(l_linenumber AS VARCHAR) || ' ' ||
         CASE WHEN l_linenumber % 2 = 0 THEN CAST(CAST(l_quantity AS BIGINT) AS VARCHAR)
              ELSE CAST(l_quantity AS VARCHAR) END AS value,
       CASE WHEN l_linenumber % 2 = 0 THEN CAST(l_linenumber AS BIGINT) END AS x,
       CASE WHEN l_linenumber % 2 = 0 THEN CAST(l_quantity AS BIGINT) END AS y,
       l_linenumber % 2 = 0 AS accepted
FROM lineitem"""


def _members_of(points_sql: str, lines: str = "lt") -> str:
    """Points (g, x, y) on each of ``lines`` (g, ux, uy, c)."""
    return f"""SELECT l.g, l.ux, l.uy, l.c, q.x, q.y FROM {lines} l JOIN ({points_sql}) q
  ON q.g = l.g AND CAST(l.ux AS HUGEINT) * q.y - CAST(l.uy AS HUGEINT) * q.x = l.c"""


def points_on_lines_sql() -> str:
    ctes = _lines_ctes(_points_cte("(SELECT * FROM lineitem WHERE l_orderkey % 2 = 1)", "l_linenumber", "l_quantity", "l_partkey"), True)
    return f"""WITH {ctes},
on_line AS ({_members_of(_points_cte(*PER_PART))})
SELECT g AS l_partkey, ux, uy, c, count(*) AS n_points, string_agg({_txt('x', 'y')}, ';' ORDER BY x, y) AS points
FROM on_line GROUP BY g, ux, uy, c"""


def third_points_sql() -> str:
    """Every pair's line by its own two points, then the order's points tested against it."""
    return f"""WITH p AS (SELECT l_orderkey AS g, x, y FROM ({_order_points(True)})),
d AS (SELECT a.g, a.x, a.y, b.x - a.x AS dx, b.y - a.y AS dy FROM p a JOIN p b ON a.g = b.g AND (a.x < b.x OR (a.x = b.x AND a.y < b.y))),
l AS (SELECT DISTINCT g, dx // gcd(dx, abs(dy)) AS ux, dy // gcd(dx, abs(dy)) AS uy,
        CAST((dx // gcd(dx, abs(dy))) * y - (dy // gcd(dx, abs(dy))) * x AS DECIMAL(38, 0)) AS c FROM d)
SELECT l.g AS l_orderkey, l.ux, l.uy, l.c, p.x, p.y FROM l JOIN p ON l.g = p.g AND l.ux * p.y - l.uy * p.x = l.c"""


def lines_paged_sql(size: int) -> str:
    ctes = _lines_ctes(_points_cte("lineitem", "l_linenumber", "l_quantity", "l_suppkey"), True)
    return f"""WITH {ctes},
r AS (SELECT *, count(*) OVER (PARTITION BY g, ux, uy, c) AS n_points,
        (row_number() OVER (PARTITION BY g, ux, uy, c ORDER BY x, y) - 1) // {size} AS page FROM m)
SELECT g AS l_suppkey, ux, uy, c, n_points, page, string_agg({_txt('x', 'y')}, ';' ORDER BY x, y) AS points
FROM r GROUP BY g, ux, uy, c, n_points, page"""


def set_differences_sql() -> str:
    """Both sides' sets by the line-key method, EXCEPT both ways."""
    sides = {
        "l": _lines_ctes(_points_cte(*PER_PART), True),
        "r": _lines_ctes(_points_cte("(SELECT * FROM lineitem WHERE l_linenumber <> 4)", *PER_PART[1:]), True),
    }
    ctes = ", ".join(f"{s} AS (WITH {c} SELECT g, points FROM lt)" for s, c in sides.items())
    return f"""WITH {ctes}
SELECT g AS l_partkey, 'left' AS side, points FROM (SELECT g, points FROM l EXCEPT SELECT g, points FROM r) a
UNION ALL
SELECT g AS l_partkey, 'right' AS side, points FROM (SELECT g, points FROM r EXCEPT SELECT g, points FROM l) b"""


_FILE_KEY = "l_returnflag || '|' || l_linestatus"


def process_files_sql() -> str:
    source = f"(SELECT *, {_FILE_KEY} AS k FROM lineitem WHERE l_orderkey % 50 <> 0)"
    ctes = _lines_ctes(_points_cte(source, "l_linenumber", "l_quantity", "k"), True)
    names = ", ".join(f"split_part(g, '|', {i}) AS {c}" for i, c in ((1, "l_returnflag"), (2, "l_linestatus")))
    return f"WITH {ctes}\nSELECT {names}, ux, uy, c, n_points, points FROM lt"


def process_file_rejects_sql() -> str:
    return """SELECT l_returnflag, l_linestatus, 'not two integers separated by one space' AS reason, true AS names_its_file,
       CAST(l_linenumber AS VARCHAR) || ' ' || CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || '.0' AS value, count(*) AS n
FROM lineitem WHERE l_orderkey % 50 = 0 GROUP BY ALL"""


def write_sets_roundtrip_sql() -> str:
    ctes = _lines_ctes(_points_cte(*PER_PART), True)
    return f"""WITH {ctes},
b AS (SELECT *, CASE WHEN g % 2 = 1 THEN 'odd' ELSE 'even' END AS batch FROM lt)
SELECT g AS l_partkey, ux, uy, c, n_points, points, batch, count(*) OVER (PARTITION BY batch) AS batch_rows,
       CAST(sum(n_points) OVER (PARTITION BY batch) AS BIGINT) AS batch_points
FROM b"""


ORACLE_SQL = {
    "parse_points": parse_points_sql(),
    "parse_points_permissive": parse_points_permissive_sql(),
    "cartesian_per_order": pairs_sql(distinct=False),
    "ordered_pairs_per_order": pairs_sql(distinct=True),
    "pair_slopes_per_order": pairs_sql(distinct=True, slopes=True),
    "anchor_groups": _anchor_rows_sql(anchor_last=False),
    "format_groups": _anchor_rows_sql(anchor_last=True),
    "sets_by_anchor": sets_by_anchor_sql(),
    "lines_supplier": lines_sql(*SUPPLIER),
    "lines_customer": lines_sql(*CUSTOMER),
    "lines_lineitem_grid": lines_sql(*GRID),
    "lines_per_part": lines_sql("lineitem", "l_linenumber", "l_quantity", "l_partkey"),
    "lines_per_supplier": lines_sql("lineitem", "l_linenumber", "l_quantity", "l_suppkey"),
    "lines_large_per_part": lines_large_sql(),
    "lines_wide_per_part": lines_wide_sql(),
    "line_params": line_params_sql(),
    "groups_from_pairs_per_order": groups_from_pairs_sql(),
    "sets_from_text_per_part": sets_by_anchor_sql(),
    "points_quarantine": points_quarantine_sql(),
    "same_sets": same_sets_sql(),
    "set_differences": set_differences_sql(),
    "points_on_lines_per_part": points_on_lines_sql(),
    "third_points_per_order": third_points_sql(),
    "lines_rich_customer": lines_sql(*CUSTOMER) + " WHERE n_points >= 12",
    "extend_lines_per_part": lines_sql(*PER_PART),
    "lines_paged_per_supplier": lines_paged_sql(8),
    "process_files": process_files_sql(),
    "process_file_rejects": process_file_rejects_sql(),
    "write_sets_roundtrip": write_sets_roundtrip_sql(),
}
