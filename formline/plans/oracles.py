"""SQL twins of the registered queries, for checking results in another engine."""

from __future__ import annotations

# --- shared subqueries ---------------------------------------------------------------------

MONTHS = """sm AS (
  SELECT l_suppkey AS entity, CAST(year(l_shipdate) AS INTEGER) AS period,
         CAST(month(l_shipdate) AS INTEGER) AS step,
         sum(l_quantity) AS units,
         count(*) FILTER (WHERE l_returnflag = 'R') AS returned,
         count(*) FILTER (WHERE l_linestatus = 'O') AS pending,
         count(*) AS label
  FROM lineitem
  GROUP BY l_suppkey, year(l_shipdate), month(l_shipdate))"""

ORDER_MONTHS = """om AS (
  SELECT o_custkey AS entity, CAST(year(o_orderdate) AS INTEGER) AS period,
         CAST(month(o_orderdate) AS INTEGER) AS step,
         count(*) FILTER (WHERE o_orderstatus = 'P') AS pending
  FROM orders
  GROUP BY o_custkey, year(o_orderdate), month(o_orderdate))"""

SEASONS = """seasons AS (
  SELECT o_orderkey, o_custkey AS player_id,
         CAST(year(o_orderdate) AS VARCHAR) || '-' ||
           lpad(CAST((year(o_orderdate) + 1) % 100 AS VARCHAR), 2, '0') AS season,
         CAST(month(o_orderdate) AS INTEGER) AS step
  FROM orders)"""

STATS = ("units", "returned", "pending")


def _mean(stat: str, w: int, keys: str = "entity, period", order: str = "step") -> str:
    return (
        f"coalesce(avg({stat}) OVER (PARTITION BY {keys} ORDER BY {order} "
        f"ROWS BETWEEN {w} PRECEDING AND 1 PRECEDING), 0.0)"
    )


def _step_average(stat: str, keys: str = "entity, period", order: str = "step") -> str:
    spec = f"PARTITION BY {keys} ORDER BY {order}"
    return (
        f"CASE WHEN row_number() OVER ({spec}) = 1 THEN 0.0 "
        f"WHEN lag({stat}) OVER ({spec}) IS NULL THEN NULL "
        f"ELSE CAST(sum({stat}) OVER ({spec} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) "
        f"AS DOUBLE) / lag(step) OVER ({spec}) END"
    )


FEATURES = f"""WITH {MONTHS},
described AS (
  SELECT sm.*, s_nationkey AS club, round(s_acctbal) AS value
  FROM sm JOIN supplier ON entity = s_suppkey
  WHERE period >= 1996),
lagged AS (
  SELECT *,
    {", ".join(f"{_step_average(s)} AS gw_avg_{s}" for s in STATS)},
    {", ".join(f"{_mean(s, w)} AS rolling_mean_{w}_{s}" for w in (2, 4, 6) for s in STATS)}
  FROM described),
totals AS (SELECT entity, period, sum(label) AS t FROM described GROUP BY entity, period),
earlier AS (
  SELECT entity, period,
         coalesce(lag(t) OVER (PARTITION BY entity ORDER BY period), 0) AS previous_total
  FROM totals),
later AS (
  SELECT lagged.*, CAST(previous_total AS DOUBLE) AS previous_total
  FROM lagged JOIN earlier USING (entity, period)
  WHERE period >= 1997),
active AS (
  SELECT * FROM later
  WHERE entity NOT IN (SELECT entity FROM later GROUP BY entity
                       HAVING coalesce(sum(gw_avg_units), 0) = 0)),
features AS (
  SELECT entity, period, step, value AS X_value, club AS X_club, step AS X_step,
         previous_total AS X_previous_total,
         {", ".join(f"gw_avg_{s} AS X_gw_avg_{s}" for s in STATS)},
         {", ".join(f"rolling_mean_{w}_{s} AS X_rolling_mean_{w}_{s}"
                    for w in (2, 4, 6) for s in STATS)},
         label
  FROM active)
"""

FEATURE_NAMES = [
    "X_value",
    "X_club",
    "X_step",
    "X_previous_total",
    *[f"X_gw_avg_{s}" for s in STATS],
    *[f"X_rolling_mean_{w}_{s}" for w in (2, 4, 6) for s in STATS],
]

REGRESSION = """rg AS (
  SELECT l_returnflag AS stage, l_suppkey AS supplier, l_extendedprice AS y,
         l_quantity * 1500 AS p
  FROM lineitem)"""

R2 = "1 - avg((y - p) * (y - p)) / var_pop(y)"
MSE = "avg((y - p) * (y - p))"

ROSTERS = """bought AS (
  SELECT o_custkey AS team, l_suppkey AS name, sum(l_quantity) AS units, count(*) AS n_lines
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  GROUP BY o_custkey, l_suppkey),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY team ORDER BY units DESC, name) AS place,
         row_number() OVER (PARTITION BY team ORDER BY n_lines DESC, name) AS place_by_lines
  FROM bought),
ro AS (SELECT team, name FROM ranked WHERE place <= 8),
players AS (
  SELECT s_suppkey AS name, CAST(s_suppkey % 4 + 1 AS INTEGER) AS position,
         CAST(round(s_acctbal) AS BIGINT) AS value, s_nationkey AS club
  FROM supplier),
pool AS (
  SELECT name, position, value, club, points
  FROM players
  JOIN (SELECT l_suppkey AS name, sum(l_quantity) AS points FROM lineitem GROUP BY l_suppkey)
  USING (name)),
members AS (SELECT * FROM ro JOIN pool USING (name)),
full_clubs AS (
  SELECT team, club, count(*) AS n FROM members GROUP BY team, club HAVING count(*) >= 2),
totals AS (
  SELECT team, count(*) AS n_players, CAST(sum(value) AS BIGINT) AS total_value,
         sum(points) AS total_points,
         count(*) FILTER (WHERE position = 1) AS n_position_1,
         count(*) FILTER (WHERE position = 2) AS n_position_2,
         count(*) FILTER (WHERE position = 3) AS n_position_3,
         count(*) FILTER (WHERE position = 4) AS n_position_4
  FROM members GROUP BY team),
fullest AS (
  SELECT team, max(n) AS max_club
  FROM (SELECT team, club, count(*) AS n FROM members GROUP BY team, club) GROUP BY team),
legality AS (
  SELECT team, total_value,
         n_players = 8 AND n_position_1 <= 3 AND n_position_2 <= 3 AND n_position_3 <= 3
           AND n_position_4 <= 3 AS positions_legal,
         total_value <= 40000 AS value_legal,
         max_club <= 2 AS clubs_legal
  FROM totals JOIN fullest USING (team)),
weeks AS (
  SELECT l_suppkey AS name,
         CAST((year(l_shipdate) - 1995) * 12 + month(l_shipdate) AS INTEGER) AS step,
         l_linestatus AS fixture, sum(l_quantity) AS points
  FROM lineitem GROUP BY 1, 2, 3),
first_fixture AS (
  SELECT name, step, points
  FROM (SELECT *, row_number() OVER (PARTITION BY name, step ORDER BY fixture) AS k FROM weeks)
  WHERE k = 1)"""


def _candidates(squad: str) -> str:
    """All legal improving swaps of the teams in ``squad`` (team, name), legal to begin with."""
    return f"""SELECT o.team, o.name AS out, i.name AS "in", i.points - o.points AS gain
  FROM (SELECT * FROM {squad} JOIN pool USING (name)) o
  JOIN (SELECT team, sum(value) AS spent FROM {squad} JOIN pool USING (name) GROUP BY team) t
    ON t.team = o.team
  JOIN pool i ON i.position = o.position AND i.points > o.points
    AND t.spent - o.value + i.value <= 40000
  LEFT JOIN (SELECT team, club, count(*) AS n FROM {squad} JOIN pool USING (name)
             GROUP BY team, club) c ON c.team = o.team AND c.club = i.club
  LEFT JOIN {squad} x ON x.team = o.team AND x.name = i.name
  WHERE x.name IS NULL
    AND coalesce(c.n, 0) + 1 - CASE WHEN i.club = o.club THEN 1 ELSE 0 END <= 2"""


def _best(candidates: str) -> str:
    return f"""SELECT team, out, "in", gain
  FROM (SELECT *, row_number() OVER (PARTITION BY team ORDER BY gain DESC, out, "in") AS k
        FROM {candidates}) WHERE k = 1"""


def _applied(squad: str, swaps: str) -> str:
    return f"""SELECT r.team, coalesce(s."in", r.name) AS name
  FROM {squad} r LEFT JOIN {swaps} s ON s.team = r.team AND s.out = r.name"""


LEGAL = """legal AS (
  SELECT ro.team, ro.name FROM ro JOIN legality USING (team)
  WHERE positions_legal AND value_legal AND clubs_legal)"""

def _climb(start: str, worth: str = "gain", shifted: str = "candidates") -> str:
    """``climb``: squads of ``start`` (team, name) after each best swap, until no team has one of any ``worth``.

    ``shifted`` may name a subquery over ``candidates`` that sees ``first`` (team, name), the squads at the outset.
    """
    return f"""climb AS (
  SELECT team, name, 0 AS swaps FROM {start}
  UNION ALL
  SELECT r.team, CASE WHEN r.name = b.out THEN b."in" ELSE r.name END, r.swaps + 1
  FROM climb r JOIN (
    WITH candidates AS ({_candidates("climb")}),
    worthy AS (SELECT team, out, "in", {worth} AS gain FROM {shifted})
    {_best("(SELECT * FROM worthy WHERE gain > 0)")}) b ON b.team = r.team)"""


#: Gain less what a swap adds to the charge for transfers since ``first``, 500 points each after the first.
PAID_GAIN = "gain - 500 * (greatest(moved - leaves + joins - 1, 0) - greatest(moved - 1, 0))"
MOVED = """(SELECT c.*, m.moved, (o.name IS NULL)::INTEGER AS leaves, (i.name IS NULL)::INTEGER AS joins
      FROM candidates c
      JOIN (SELECT k.team, count(*) FILTER (WHERE f.name IS NULL) AS moved
            FROM climb k LEFT JOIN first f ON f.team = k.team AND f.name = k.name GROUP BY k.team) m ON m.team = c.team
      LEFT JOIN first o ON o.team = c.team AND o.name = c.out
      LEFT JOIN first i ON i.team = c.team AND i.name = c."in")"""


def _settled(climb: str, more: str = "") -> str:
    """All teams: the legal ones where ``climb`` ends, the others as they are."""
    flags = [", TRUE AS settled", ", FALSE"] if more else ["", ""]
    return f"""WITH RECURSIVE {ROSTERS}, {LEGAL}, first AS (SELECT * FROM legal),
{climb}
SELECT team, name, TRUE AS legal, swaps AS n_swaps{flags[0]}
FROM (SELECT *, max(swaps) OVER (PARTITION BY team) AS last FROM climb) WHERE swaps = last
UNION ALL
SELECT team, name, FALSE, 0{flags[1]} FROM ro WHERE team NOT IN (SELECT team FROM legal)"""


def _kicked(squad: str) -> str:
    """``squad`` (team, name, with ten times the team and the start as team) after one member was kicked out."""
    return f"""SELECT s.team, coalesce(k."in", s.name) AS name
  FROM {squad} s LEFT JOIN (
    SELECT team, out, "in" FROM (
      SELECT o.team, o.name AS out, i.name AS "in",
             row_number() OVER (PARTITION BY o.team ORDER BY i.points DESC, i.name) AS k
      FROM (SELECT team, name FROM (
              SELECT q.team, q.name, row_number() OVER (
                PARTITION BY q.team ORDER BY md5('7:' || (q.team % 100) || ':' || q.name)) AS k
              FROM {squad} q JOIN first f USING (team, name)) WHERE k = 1) o
      JOIN pool p ON p.name = o.name
      JOIN (SELECT team, sum(value) AS spent FROM {squad} JOIN pool USING (name) GROUP BY team) t ON t.team = o.team
      JOIN pool i ON i.position = p.position AND t.spent - p.value + i.value <= 40000
      LEFT JOIN (SELECT team, club, count(*) AS n FROM {squad} JOIN pool USING (name) GROUP BY team, club) c
        ON c.team = o.team AND c.club = i.club
      WHERE NOT EXISTS (SELECT 1 FROM {squad} x WHERE x.team = o.team AND x.name = i.name)
        AND NOT EXISTS (SELECT 1 FROM first x WHERE x.team = o.team AND x.name = i.name)
        AND coalesce(c.n, 0) + 1 - CASE WHEN i.club = p.club THEN 1 ELSE 0 END <= 2)
    WHERE k = 1) k ON k.team = s.team AND k.out = s.name"""


RESTARTED = f"""WITH RECURSIVE {ROSTERS}, {LEGAL},
first AS (SELECT team * 100 + start AS team, name FROM legal, (SELECT unnest(range(0, 11)) AS start)),
starting AS (SELECT * FROM first WHERE team % 100 > 0),
one AS ({_kicked("starting")}),
two AS ({_kicked("one")}),
started AS (
  SELECT team, name, 0 AS kicks FROM first WHERE team % 100 = 0
  UNION ALL
  SELECT team, name, (SELECT count(*) FROM starting s WHERE s.team = two.team
                      AND s.name NOT IN (SELECT name FROM two t WHERE t.team = two.team)) AS kicks FROM two),
{_climb("started", PAID_GAIN, MOVED)},
ended AS (SELECT * FROM (SELECT *, max(swaps) OVER (PARTITION BY team) AS last FROM climb) WHERE swaps = last),
scored AS (
  SELECT e.team, e.swaps + any_value(s.kicks) AS n_swaps,
         sum(points) - 500 * greatest(count(*) FILTER (WHERE f.name IS NULL) - 1, 0) AS net_points
  FROM ended e JOIN pool USING (name)
  LEFT JOIN first f ON f.team = e.team AND f.name = e.name
  JOIN (SELECT DISTINCT team, kicks FROM started) s ON s.team = e.team
  GROUP BY e.team, e.swaps),
kept AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY team // 100 ORDER BY net_points DESC, team) AS k FROM scored) WHERE k = 1)
SELECT kept.team // 100 AS team, name, CAST(kept.team % 100 AS INTEGER) AS start,
       CAST(n_swaps AS INTEGER) AS n_swaps, CAST(net_points AS DOUBLE) AS net_points
FROM kept JOIN ended USING (team)"""

REPAIRED = f"""WITH RECURSIVE {ROSTERS},
over AS (
  SELECT team, name FROM ro JOIN legality USING (team)
  WHERE positions_legal AND clubs_legal AND NOT value_legal),
fixed AS (
  SELECT team, name, 0 AS swaps FROM over
  UNION ALL
  SELECT r.team, CASE WHEN r.name = b.out THEN b."in" ELSE r.name END, r.swaps + 1
  FROM fixed r JOIN (
    SELECT team, out, "in" FROM (
      SELECT *, row_number() OVER (PARTITION BY team ORDER BY step, loss, out, "in") AS k FROM (
        SELECT o.team, o.name AS out, i.name AS "in", (t.spent - o.value + i.value > 40000)::INTEGER AS step,
               CASE WHEN t.spent - o.value + i.value <= 40000 THEN o.points - i.points ELSE i.value - o.value END AS loss
        FROM (SELECT * FROM fixed JOIN pool USING (name)) o
        JOIN (SELECT team, sum(value) AS spent FROM fixed JOIN pool USING (name) GROUP BY team) t
          ON t.team = o.team AND t.spent > 40000
        JOIN pool i ON i.position = o.position AND i.value < o.value
        LEFT JOIN (SELECT team, club, count(*) AS n FROM fixed JOIN pool USING (name) GROUP BY team, club) c
          ON c.team = o.team AND c.club = i.club
        LEFT JOIN fixed x ON x.team = o.team AND x.name = i.name
        WHERE x.name IS NULL AND coalesce(c.n, 0) + 1 - CASE WHEN i.club = o.club THEN 1 ELSE 0 END <= 2))
    WHERE k = 1) b ON b.team = r.team)
SELECT team, name, swaps AS n_swaps, TRUE AS repaired
FROM (SELECT *, max(swaps) OVER (PARTITION BY team) AS last FROM fixed) WHERE swaps = last"""

SWAPS = f"""WITH {ROSTERS}, {LEGAL},
candidates AS ({_candidates("legal")}),
best AS ({_best("candidates")})"""

WEEKS = f"""WITH {MONTHS}
SELECT CAST(period AS VARCHAR) || '-' || lpad(CAST((period + 1) % 100 AS VARCHAR), 2, '0')
         AS season,
       step, CAST(entity AS VARCHAR) AS player_id,
       'Supplier_' || CAST(entity AS VARCHAR) AS player_name, units, label,
       CASE WHEN period >= 1998 AND returned > 0 THEN returned END AS returned,
       CASE WHEN period >= 1998 THEN 'supplier,' || chr(10) || CAST(entity AS VARCHAR) END AS note,
       0::INTEGER AS corrupt_cells
FROM sm"""

# The categories of the generic part table.
BRANDS = sorted(f"Brand#{i}" for i in range(1, 26))
TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


def _one_hot(column: str, values: list[str]) -> str:
    return ", ".join(
        f"CASE WHEN {column} = '{v}' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS \"{column}_{v}\""
        for v in values
    )


EVENTS = """ev AS (
  SELECT user_id, event_id, ts, CAST(day(ts) AS INTEGER) AS step,
         CASE WHEN event_type <> 'error' THEN round(value * 100) END AS cents
  FROM events)"""

EVENT_ORDER = "step, ts, event_id"
EVENT_FEATURES = f"""WITH {EVENTS}
SELECT user_id, event_id, step,
       {_mean("cents", 2, "user_id", EVENT_ORDER)} AS rolling_mean_2_cents,
       {_mean("cents", 6, "user_id", EVENT_ORDER)} AS rolling_mean_6_cents,
       {_step_average("cents", "user_id", EVENT_ORDER)} AS gw_avg_cents
FROM ev"""


def _trials() -> str:
    return f"""WITH {REGRESSION},
trials AS (
  SELECT 'run-' || CAST(supplier AS VARCHAR) AS run_id, round({MSE}, 4) AS val_mse,
         round(avg(abs(y - p)), 4) AS val_mae, round({R2}, 4) AS val_r2
  FROM rg GROUP BY supplier)"""


def _fit_report(more: str = "") -> str:
    """Rows of each stage when a fifth of the train years validates."""
    return FEATURES + f"""SELECT stage, CAST(n AS BIGINT) AS n_rows,
  CASE WHEN stage = 'train' THEN TRUE END AS fits{more}
FROM (SELECT 'train' AS stage, n - ceil(0.2 * n) AS n FROM
        (SELECT count(*) AS n FROM features WHERE period IN (1998, 1999, 2000))
      UNION ALL SELECT 'val', ceil(0.2 * n) FROM
        (SELECT count(*) AS n FROM features WHERE period IN (1998, 1999, 2000))
      UNION ALL SELECT 'test', count(*) FROM features WHERE period = 2001)"""


def _metric_names(*more: str) -> str:
    """Names of a run's metrics, sorted."""
    measures = ("mse", "rmse", "mae", "r2", "spearman")
    return ",".join(sorted([*more, *(f"{s}_{m}" for s in ("train", "val", "test") for m in measures)]))


ORACLES: dict[str, str] = {
    "rolling_mean": f"""WITH {MONTHS}
SELECT entity, period, step,
       {", ".join(f"{_mean('units', w)} AS rolling_mean_{w}_units" for w in (2, 4, 6))}
FROM sm""",
    "step_average": f"""WITH {MONTHS}
SELECT entity, period, step, {_step_average("units")} AS gw_avg_units FROM sm""",
    "event_features": EVENT_FEATURES,
    "event_features_split": EVENT_FEATURES,
    "prev_period_total": f"""WITH {MONTHS},
t AS (SELECT entity, period, sum(label) AS total FROM sm GROUP BY entity, period),
e AS (SELECT entity, period, coalesce(lag(total) OVER (PARTITION BY entity ORDER BY period), 0)
        AS previous_total FROM t)
SELECT entity, period, step, CAST(previous_total AS DOUBLE) AS previous_total
FROM sm JOIN e USING (entity, period)""",
    "prev_period_total_joined": """WITH o AS (
  SELECT o_orderkey, o_custkey, CAST(year(o_orderdate) AS INTEGER) AS period,
         CAST(round(o_totalprice) AS BIGINT) AS price FROM orders),
t AS (SELECT o_custkey, period, sum(price) AS total FROM o GROUP BY o_custkey, period),
e AS (SELECT o_custkey, period,
             coalesce(lag(total) OVER (PARTITION BY o_custkey ORDER BY period), 0) AS total FROM t)
SELECT o_orderkey, o_custkey, period, CAST(total AS DOUBLE) AS previous_total
FROM o JOIN e USING (o_custkey, period)""",
    "period_totals": f"""WITH {MONTHS}
SELECT entity, period, sum(units) AS total FROM sm GROUP BY entity, period""",
    "close_gaps": f"""WITH {MONTHS},
g AS (SELECT entity, period,
             CASE WHEN step > 3 AND period % 2 = 1 THEN step + 2 ELSE step END AS step FROM sm),
d AS (SELECT DISTINCT period, step FROM g),
m AS (SELECT period, step, min(step) OVER (PARTITION BY period)
        + dense_rank() OVER (PARTITION BY period ORDER BY step) - 1 AS step_closed FROM d)
SELECT entity, period, CAST(step AS INTEGER) AS step, CAST(step_closed AS INTEGER) AS step_closed
FROM g JOIN m USING (period, step)""",
    "distinct_steps": """SELECT DISTINCT CAST(year(l_shipdate) AS INTEGER) AS period,
       CAST(month(l_shipdate) AS INTEGER) AS step FROM lineitem""",
    "period_check": f"""WITH {ORDER_MONTHS}
SELECT DISTINCT entity, period FROM om
EXCEPT SELECT entity, period FROM om WHERE pending > 0 OR period > 1996""",
    "drop_inactive": f"""WITH {ORDER_MONTHS}
SELECT * FROM om
WHERE entity NOT IN (SELECT entity FROM om GROUP BY entity HAVING sum(pending) = 0)""",
    "feature_table": FEATURES + f"""SELECT entity, period, step,
  {", ".join(FEATURE_NAMES)}, label FROM features""",
    "temporal_split": f"""WITH {MONTHS}
SELECT entity, period, step, CASE WHEN period IN (1998, 1999, 2000) THEN 'train'
  WHEN period = 2001 THEN 'test' ELSE 'master' END AS split FROM sm""",
    "random_split": """WITH ordered AS (
  SELECT o_orderkey,
         row_number() OVER (ORDER BY md5('42:' || CAST(o_orderkey AS VARCHAR))) AS k,
         count(*) OVER () AS n
  FROM orders)
SELECT o_orderkey, CASE WHEN k <= ceil(0.2 * n) THEN 'val' ELSE 'train' END AS split
FROM ordered""",
    "select_prefix": "SELECT l_linenumber, l_returnflag, l_linestatus FROM lineitem",
    "demo_prep": """WITH ordered AS (
  SELECT *, row_number() OVER (ORDER BY md5('42:' || CAST(p_partkey AS VARCHAR))) AS k,
         count(*) OVER () AS n
  FROM part)
SELECT p_partkey AS X_p_partkey, p_size AS X_p_size, p_retailprice AS Y_target,
       CASE WHEN k <= ceil(0.2 * n) THEN 'test' ELSE 'train' END AS split
FROM ordered""",
    "clean_names": """WITH raw AS (
  SELECT c_custkey, CAST(c_custkey AS VARCHAR) AS id,
         c_name || ' A_' || CAST(c_custkey AS VARCHAR) AS raw FROM customer)
SELECT c_custkey,
       lower(replace(left(raw, length(raw) - length(id) - 1), ' ', '_')) AS entity,
       lower(replace(replace(raw, '_' || id, ''), ' ', '_')) AS entity_literal,
       id AS id_from_name
FROM raw""",
    "season_year": f"""WITH {SEASONS}
SELECT o_orderkey, season, CAST(split_part(season, '-', 1) AS INTEGER) AS starting_year
FROM seasons""",
    "assemble": f"""WITH {SEASONS}
SELECT season, CAST(player_id AS VARCHAR) AS player_id, o_orderkey, step,
       c_nationkey AS team, c_mktsegment AS element_type, n_name AS team_name
FROM seasons JOIN customer ON player_id = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
    "homonyms": """SELECT p_brand AS season,
       split_part(p_name, ' ', 1) || '_' || split_part(p_name, ' ', 2) AS name,
       count(*) AS n_ids
FROM part GROUP BY 1, 2 HAVING count(*) > 1""",
    "union_weeks": """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN o_custkey END AS o_custkey,
       CASE WHEN o_orderstatus = 'O' THEN o_orderpriority END AS o_orderpriority,
       CASE WHEN o_orderstatus IN ('F', 'P') THEN o_totalprice END AS o_totalprice
FROM orders WHERE o_orderstatus IN ('F', 'O', 'P')""",
    "one_hot": f"""SELECT p_partkey, {_one_hot("p_brand", BRANDS)}, {_one_hot("p_type", TYPES)}
FROM part""",
    "one_hot_vector": """SELECT c_custkey,
       CAST(dense_rank() OVER (ORDER BY c_name) - 1 AS BIGINT) AS position, 1.0::DOUBLE AS total
FROM customer""",
    "identity_stages": f"""WITH {MONTHS} SELECT * FROM sm""",
    "feature_shape": FEATURES + f"""SELECT count(*) AS n_rows,
  {len(FEATURE_NAMES)}::INTEGER AS n_features, 1::INTEGER AS n_labels FROM features""",
    "standard_scale": """WITH m AS (
  SELECT avg(p_size) AS ms, stddev_pop(p_size) AS ss, avg(p_retailprice) AS mr,
         stddev_pop(p_retailprice) AS sr FROM part)
SELECT p_partkey, round((p_size - ms) / ss, 6) AS p_size,
       round((p_retailprice - mr) / sr, 6) AS p_retailprice, 0.0::DOUBLE AS p_constant
FROM part, m""",
    "assemble_features": FEATURES + f"""SELECT entity, period, step,
  CAST(unnest(range({len(FEATURE_NAMES)})) AS INTEGER) AS pos,
  unnest([{", ".join(f"CAST({c} AS DOUBLE)" for c in FEATURE_NAMES)}]) AS value
FROM features""",
    "regression_metrics": f"""WITH {REGRESSION}
SELECT round({MSE}, 1) AS mse, round(sqrt({MSE}), 4) AS rmse,
       round(avg(abs(y - p)), 4) AS mae, round({R2}, 6) AS r2 FROM rg""",
    "stage_metrics": f"""WITH {REGRESSION},
w AS (SELECT stage, {MSE} AS mse, sqrt({MSE}) AS rmse, avg(abs(y - p)) AS mae, {R2} AS r2
      FROM rg GROUP BY stage)
SELECT stage, stage || '_' || name AS metric,
       CASE WHEN name = 'r2' THEN round(value, 6) ELSE round(value, 1) END AS value
FROM w UNPIVOT (value FOR name IN (mse, rmse, mae, r2))""",
    "spearman": f"""WITH {REGRESSION},
r AS (SELECT rank() OVER (ORDER BY y) + (count(*) OVER (PARTITION BY y) - 1) / 2.0 AS ry,
             rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2.0 AS rp
      FROM rg)
SELECT round(corr(ry, rp), 8) AS rho FROM r""",
    "average_ranks": """SELECT DISTINCT l_extendedprice AS value,
       CAST(rank() OVER (ORDER BY l_extendedprice)
            + (count(*) OVER (PARTITION BY l_extendedprice) - 1) / 2.0 AS DOUBLE) AS rank
FROM lineitem""",
    "ols_trend": f"""WITH {REGRESSION}
SELECT stage, round(regr_slope(p, y), 8) AS slope, round(regr_intercept(p, y), 3) AS intercept,
       round(regr_r2(p, y), 8) AS r2, round(least(min(y), min(p)), 2) AS lo,
       round(greatest(max(y), max(p)), 2) AS hi
FROM rg GROUP BY stage""",
    "scatter_points": """SELECT o_orderkey, o_totalprice, CAST(month(o_orderdate) AS INTEGER) AS month
FROM orders""",
    "scatter_counts": f"""WITH {REGRESSION},
e AS (SELECT min(y) AS yl, max(y) AS yh, min(p) AS pl, max(p) AS ph FROM rg)
SELECT CAST(least(floor((y - yl) / ((yh - yl) / 40)), 39) AS INTEGER) AS x_bin,
       CAST(least(floor((p - pl) / ((ph - pl) / 40)), 39) AS INTEGER) AS y_bin, count(*) AS n
FROM rg, e GROUP BY 1, 2""",
    "player_pool": f"""WITH {ROSTERS}
SELECT DISTINCT CAST(month(l_shipdate) AS INTEGER) AS step, name, position, value, club,
       l_quantity AS points
FROM lineitem JOIN players ON l_suppkey = name""",
    "team_totals": f"""WITH {ROSTERS}
SELECT totals.*, max_club FROM totals JOIN fullest USING (team)""",
    "team_legality": f"""WITH {ROSTERS}
SELECT team, positions_legal, value_legal, clubs_legal,
       positions_legal AND value_legal AND clubs_legal AS legal FROM legality""",
    "week_pool": f"""WITH {ROSTERS}
SELECT DISTINCT name, position, value, club, w.points
FROM weeks w JOIN players USING (name) WHERE step = 40""",
    "legality_any_size": f"""WITH {ROSTERS},
m AS (SELECT team, name, position, value, club FROM bought JOIN pool USING (name)),
c AS (SELECT team, club, count(*) AS n FROM m GROUP BY team, club),
t AS (
  SELECT team, count(*) AS n_players, CAST(sum(value) AS BIGINT) AS total_value,
         (SELECT max(n) FROM c WHERE c.team = m.team) AS max_club,
         count(*) = 8 AND greatest(count(*) FILTER (WHERE position = 1),
           count(*) FILTER (WHERE position = 2), count(*) FILTER (WHERE position = 3),
           count(*) FILTER (WHERE position = 4)) <= 3 AS positions_legal
  FROM m GROUP BY team)
SELECT *, total_value <= 40000 AS value_legal, max_club <= 2 AS clubs_legal,
       positions_legal AND total_value <= 40000 AND max_club <= 2 AS legal FROM t""",
    "open_clubs": f"""WITH {ROSTERS}
SELECT r.team, r.name FROM ranked r JOIN pool USING (name)
ANTI JOIN full_clubs f ON f.team = r.team AND f.club = pool.club
WHERE place > 8""",
    "refresh_points": f"""WITH {ROSTERS}
SELECT ro.team, ro.name, coalesce(points, 0.0) AS points
FROM ro LEFT JOIN (SELECT * FROM first_fixture WHERE step = (SELECT max(step) FROM weeks)) w
USING (name)""",
    "swap_candidates": f"""{SWAPS}
SELECT team, out, n_options, "in", gain
FROM (SELECT *, row_number() OVER (PARTITION BY team, out ORDER BY gain DESC, "in") AS k,
             count(*) OVER (PARTITION BY team, out) AS n_options FROM candidates)
WHERE k = 1""",
    "swap_list": f"""{SWAPS}
SELECT team, out, "in", gain FROM candidates
WHERE team IN (SELECT team FROM ro WHERE name = (SELECT name FROM pool ORDER BY value DESC, name LIMIT 1))""",
    "best_swap": f'{SWAPS}\nSELECT team, out, "in", gain FROM best',
    "apply_swap": f"{SWAPS}\n{_applied('ro', 'best')}",
    "transfer_cost": f"""WITH {ROSTERS},
later AS (SELECT team, name FROM ranked WHERE place_by_lines <= 8),
t AS (
  SELECT later.team, sum(CASE WHEN ro.name IS NULL THEN 1 ELSE 0 END) AS n_transfers,
         sum(points) AS total_points
  FROM later JOIN pool ON pool.name = later.name
  LEFT JOIN ro ON ro.team = later.team AND ro.name = later.name
  GROUP BY later.team)
SELECT team, CAST(n_transfers AS BIGINT) AS n_transfers, total_points,
       CAST(greatest(n_transfers - 1, 0) * 2 AS DOUBLE) AS penalty,
       total_points - CAST(greatest(n_transfers - 1, 0) * 2 AS DOUBLE) AS net_points
FROM t""",
    "weekly_reward": f"""WITH {ROSTERS},
steps AS (SELECT CAST(unnest(range(1, (SELECT max(step) FROM weeks) + 1)) AS INTEGER) AS step),
ledger AS (
  SELECT team, steps.step, sum(coalesce(points, 0.0)) AS reward
  FROM ro CROSS JOIN steps
  LEFT JOIN first_fixture f ON f.name = ro.name AND f.step = steps.step
  GROUP BY team, steps.step)
SELECT team, step, reward,
       sum(reward) OVER (PARTITION BY team ORDER BY step ROWS UNBOUNDED PRECEDING) AS running_total
FROM ledger""",
    "cheaper_options": f"""WITH {ROSTERS},
dearest AS (
  SELECT team, name, position, value
  FROM (SELECT m.*, row_number() OVER (PARTITION BY team ORDER BY value DESC, name) AS k
        FROM members m JOIN legality USING (team)
        WHERE positions_legal AND clubs_legal AND NOT value_legal)
  WHERE k = 1),
options AS (
  SELECT d.team, d.name AS out, i.name AS "in", i.points
  FROM dearest d JOIN pool i ON i.position = d.position AND i.value < d.value
  ANTI JOIN full_clubs f ON f.team = d.team AND f.club = i.club
  WHERE NOT EXISTS (SELECT 1 FROM ro WHERE ro.team = d.team AND ro.name = i.name))
SELECT team, out, n_options, "in"
FROM (SELECT *, row_number() OVER (PARTITION BY team ORDER BY points DESC, "in") AS k,
             count(*) OVER (PARTITION BY team) AS n_options FROM options)
WHERE k = 1""",
    "improve_rosters": _settled(_climb("legal")),
    "improve_with_transfers": _settled(_climb("legal", PAID_GAIN, MOVED)),
    "settled_rosters": _settled(_climb("legal"), "settled"),
    "settled_with_transfers": _settled(_climb("legal", PAID_GAIN, MOVED), "settled"),
    "restarted_rosters": RESTARTED,
    "repair_rosters": REPAIRED,
    "best_trial": f"""{_trials()}
SELECT run_id, val_r2 AS value FROM trials ORDER BY val_r2 DESC, run_id LIMIT 1""",
    "trials_to_drop": f"""{_trials()},
k AS (SELECT *, row_number() OVER (ORDER BY val_mae, run_id) AS place FROM trials)
SELECT run_id, val_mae AS value FROM k WHERE place > 25""",
    "file_catalog": f"""WITH {MONTHS}
SELECT DISTINCT CAST(period AS VARCHAR) || '-' || lpad(CAST((period + 1) % 100 AS VARCHAR), 2, '0')
  AS season, step FROM sm
UNION ALL SELECT '1990-91', 1""",
    "team_list": f"""WITH {SEASONS}
SELECT DISTINCT season, c_nationkey AS team, n_name AS team_name,
       CAST(c_nationkey + 100 AS INTEGER) AS team_id
FROM seasons JOIN customer ON player_id = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
    "season_lists": f"""WITH {SEASONS}
SELECT DISTINCT season, CAST(player_id AS VARCHAR) AS player_id, c_mktsegment AS element_type,
       c_nationkey AS team
FROM seasons JOIN customer ON player_id = c_custkey""",
    "rewritten_table": """SELECT n_nationkey, n_name FROM nation
WHERE n_nationkey < 5 OR n_nationkey >= 20""",
    "weekly_scan": WEEKS,
    "weekly_increments": WEEKS,
    "prepared_export": FEATURES + f"""SELECT entity, period, step,
  {", ".join(FEATURE_NAMES)}, label,
  CASE WHEN period = 2001 THEN 'test' ELSE 'train' END AS split
FROM features WHERE period >= 1998""",
    "train_rf": _fit_report(),
    "train_gbt": _fit_report(", TRUE AS never_rises"),
    "train_linear_svr": _fit_report(", TRUE AS converged, TRUE AS near_least"),
    "score_table": FEATURES + """SELECT entity, period, step, label, TRUE AS same
FROM features WHERE period = 2001""",
    "trial_table": f"""SELECT 'svr' AS experiment, 42::BIGINT AS seed, 270::BIGINT AS n_runs,
  'C,epsilon,regressor,tol' AS params, '{_metric_names("converged", "passes")}' AS metrics
UNION ALL
SELECT 'forest', 42, 10000,
  'criterion,max_features,max_samples,min_samples_split,n_estimators,regressor',
  '{_metric_names()}'""",
    "pipeline_roundtrip": FEATURES + """SELECT entity, period, step, TRUE AS same
FROM features WHERE period = 2001""",
}
