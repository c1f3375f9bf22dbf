"""The same queries in SQL, over the test tables registered as views."""

from __future__ import annotations

_DEALS = """
deal AS (
  SELECT o_orderkey AS deal_id, o_custkey AS agent_id,
         CAST(o_totalprice AS DECIMAL(18,2)) AS amount, o_orderstatus AS status,
         CAST(o_orderdate AS DATE) AS deal_date
  FROM orders),
agent AS (
  SELECT c_custkey AS agent_id, c_name AS agent_name,
         CAST(c_nationkey AS VARCHAR) || '|' || c_mktsegment AS agency_id
  FROM customer),
agency_deal AS (SELECT d.*, a.agency_id FROM deal d LEFT JOIN agent a USING (agent_id)),
ref AS (SELECT max(deal_date) AS day FROM deal)
"""

_EVENTS = """
mark AS (
  SELECT e.event_id, e.user_id AS agent_id, e.ts, CAST(date_trunc('week', e.ts) AS DATE) AS week,
         CASE e.event_type WHEN 'signup' THEN 1 WHEN 'view' THEN 2 WHEN 'click' THEN 3
              WHEN 'purchase' THEN 4 WHEN 'error' THEN 5 END AS stage_no
  FROM events e
  WHERE e.event_type IN ('signup', 'view', 'click', 'purchase', 'error')),
agent AS (
  SELECT c_custkey AS agent_id, CAST(c_nationkey AS VARCHAR) || '|' || c_mktsegment AS agency_id
  FROM customer),
stage AS (SELECT * FROM (VALUES (1), (2), (3), (4), (5)) v(stage_no))
"""


def _reached(dims: str = "") -> str:
    join = "LEFT JOIN agent USING (agent_id)" if "agency_id" in dims else ""
    pick = f"{dims}," if dims else ""
    return f"""
WITH {_EVENTS},
placed AS (SELECT * FROM mark {join}),
grid AS (SELECT {pick} stage_no FROM (SELECT DISTINCT {dims or '1 AS one'} FROM placed) g CROSS JOIN stage),
found AS (
  SELECT {pick} stage_no, count(DISTINCT (agent_id, week)) AS units
  FROM placed GROUP BY {pick} stage_no)
SELECT {pick} CAST(stage_no AS BIGINT) AS stage_no, CAST(coalesce(units, 0) AS BIGINT) AS units
FROM grid LEFT JOIN found USING ({pick} stage_no)"""


def _snapshot(dims: str = "", rename: str = "") -> str:
    join = "LEFT JOIN agent USING (agent_id)" if "agency_id" in dims else ""
    pick = f"{dims}," if dims else ""
    part = f"PARTITION BY {dims}" if dims else ""
    return f"""
WITH {_EVENTS},
furthest AS (
  SELECT {pick} agent_id, week AS unit_week, max(stage_no) AS top FROM mark {join}
  GROUP BY {pick} agent_id, week),
counted AS (
  SELECT {pick} s.stage_no, count(*) FILTER (WHERE top >= s.stage_no) AS units
  FROM furthest CROSS JOIN stage s GROUP BY {pick} s.stage_no)
SELECT {rename or pick} CAST(stage_no AS BIGINT) AS stage_no, CAST(units AS BIGINT) AS units,
       CAST(units AS DOUBLE)
         / nullif(CAST(lag(units) OVER ({part} ORDER BY stage_no) AS DOUBLE), 0) AS conv_prev,
       CAST(units AS DOUBLE)
         / nullif(CAST(first_value(units) OVER ({part} ORDER BY stage_no) AS DOUBLE), 0) AS conv_top
FROM counted"""


def _ordered(by_agency: bool = False) -> str:
    """The greedy chain: the earliest next stage at or after the one before."""
    steps = ["t1 AS (SELECT agent_id, week, min(ts) AS t FROM mark WHERE stage_no = 1 GROUP BY ALL)"]
    for stage in range(2, 6):
        steps.append(f"""
t{stage} AS (
  SELECT m.agent_id, m.week, min(m.ts) AS t FROM mark m
  JOIN t{stage - 1} p ON m.agent_id = p.agent_id AND m.week = p.week AND m.ts >= p.t
  WHERE m.stage_no = {stage} GROUP BY ALL)""")
    passed = " UNION ALL ".join(
        f"SELECT agent_id, week, {stage} AS stage_no FROM t{stage}" for stage in range(1, 6))
    if by_agency:
        tail = """
grid AS (
  SELECT DISTINCT agency_id, s.stage_no FROM mark LEFT JOIN agent USING (agent_id) CROSS JOIN stage s),
found AS (
  SELECT agency_id, stage_no, count(*) AS units FROM passed LEFT JOIN agent USING (agent_id) GROUP BY ALL)
SELECT agency_id, CAST(stage_no AS BIGINT) AS stage_no, CAST(coalesce(units, 0) AS BIGINT) AS units
FROM grid LEFT JOIN found USING (agency_id, stage_no)"""
    else:
        tail = """
found AS (SELECT stage_no, count(*) AS units FROM passed GROUP BY stage_no)
SELECT CAST(stage_no AS BIGINT) AS stage_no, CAST(coalesce(units, 0) AS BIGINT) AS units
FROM stage LEFT JOIN found USING (stage_no)"""
    return f"WITH {_EVENTS}, {','.join(steps)}, passed AS ({passed}), {tail}"


_IN_YEAR = "AND deal_date BETWEEN DATE '2000-01-01' AND DATE '2000-12-31'"


def _rating(by: str, period: str = "") -> str:
    return f"""
WITH {_DEALS},
total AS (
  SELECT {by}, count(*) AS deals, sum(amount) AS volume FROM agency_deal
  WHERE status = 'F' {period} GROUP BY {by})
SELECT {by}, CAST(deals AS BIGINT) AS deals, CAST(volume AS DECIMAL(38,2)) AS volume,
       CAST(rank() OVER (ORDER BY volume DESC) AS BIGINT) AS rnk
FROM total"""


_RATING_WITHIN = f"""
WITH {_DEALS},
total AS (
  SELECT agency_id, agent_id, count(*) AS deals, sum(amount) AS volume
  FROM agency_deal WHERE status = 'F' GROUP BY agency_id, agent_id)
SELECT agency_id, agent_id, CAST(deals AS BIGINT) AS deals, CAST(volume AS DECIMAL(38,2)) AS volume,
       CAST(rank() OVER (PARTITION BY agency_id ORDER BY volume DESC) AS BIGINT) AS rnk
FROM total"""


def _leaderboard(by: str, period: str = "") -> str:
    return f"""
WITH {_DEALS},
total AS (
  SELECT {by}, count(*) AS deals, sum(amount) AS volume FROM agency_deal
  WHERE status = 'F' {period} GROUP BY {by})
SELECT CAST(row_number() OVER (ORDER BY volume DESC, {by}) AS BIGINT) AS place, {by},
       CAST(deals AS BIGINT) AS deals, CAST(volume AS DECIMAL(38,2)) AS volume
FROM total WHERE {by} IS NOT NULL ORDER BY volume DESC, {by} LIMIT 10"""


def _churn(by: str, days: int, asof: str = "") -> str:
    reference = f", day_of AS (SELECT DATE '{asof}' AS day)" if asof else ", day_of AS (SELECT day FROM ref)"
    return f"""
WITH {_DEALS}{reference},
active AS (
  SELECT {by},
         max(CASE WHEN deal_date > day - {2 * days} AND deal_date <= day - {days} THEN 1 ELSE 0 END) AS prev,
         max(CASE WHEN deal_date > day - {days} AND deal_date <= day THEN 1 ELSE 0 END) AS curr
  FROM agency_deal CROSS JOIN day_of GROUP BY {by}),
counted AS (
  SELECT sum(prev) AS active_prev, sum(CASE WHEN prev = 1 AND curr = 0 THEN 1 ELSE 0 END) AS churned FROM active)
SELECT CAST(active_prev AS BIGINT) AS active_prev, CAST(churned AS BIGINT) AS churned,
       CAST(churned AS DOUBLE) / nullif(CAST(active_prev AS DOUBLE), 0) AS churn_rate
FROM counted"""


_ACTIVITY = f"""
WITH {_DEALS},
flags AS (
  SELECT agent_id, any_value(day) AS day, min(deal_date) AS first,
         bool_or(deal_date > day - 360 AND deal_date <= day - 180) AS prev,
         bool_or(deal_date > day - 180) AS curr
  FROM deal CROSS JOIN ref GROUP BY agent_id)
SELECT agent_id,
       CASE WHEN curr AND prev THEN 'retained' WHEN curr AND first > day - 180 THEN 'new'
            WHEN curr THEN 'reactivated' WHEN prev THEN 'churned' ELSE 'dormant' END AS status
FROM flags"""


def _rf(by: str) -> str:
    return f"""
WITH {_DEALS},
measure AS (
  SELECT {by}, date_diff('day', max(deal_date), any_value(day)) AS recency_days, count(*) AS frequency
  FROM agency_deal CROSS JOIN ref GROUP BY {by}),
segment AS (
  SELECT {by}, CAST(recency_days AS BIGINT) AS recency_days, CAST(frequency AS BIGINT) AS frequency,
         CAST(CASE WHEN recency_days <= 90 THEN 1 WHEN recency_days <= 180 THEN 2
                   WHEN recency_days <= 365 THEN 3 ELSE 4 END AS BIGINT) AS r_bin,
         CAST(CASE WHEN frequency >= 12 THEN 1 WHEN frequency >= 9 THEN 2
                   WHEN frequency >= 6 THEN 3 ELSE 4 END AS BIGINT) AS f_bin
  FROM measure)"""


def _rf_matrix(by: str) -> str:
    return _rf(by) + """,
bins AS (SELECT CAST(b AS BIGINT) AS b FROM range(1, 5) t(b)),
counted AS (SELECT r_bin, f_bin, count(*) AS n FROM segment GROUP BY r_bin, f_bin)
SELECT r.b AS r_bin, f.b AS f_bin, CAST(coalesce(n, 0) AS BIGINT) AS n
FROM bins r CROSS JOIN bins f LEFT JOIN counted ON counted.r_bin = r.b AND counted.f_bin = f.b"""


_RF_CUTS = _rf("agent_id") + """,
wanted AS (SELECT CAST(q AS DOUBLE) AS q FROM (VALUES (0.25), (0.5), (0.75)) v(q)),
cuts AS (
  SELECT quantile_cont(recency_days, [0.25, 0.5, 0.75]) AS recency,
         quantile_cont(frequency, [0.25, 0.5, 0.75]) AS frequency FROM segment)
SELECT 'recency_days' AS measure, unnest([0.25, 0.5, 0.75])::DOUBLE AS q, unnest(recency)::DOUBLE AS cut FROM cuts
UNION ALL
SELECT 'frequency' AS measure, unnest([0.25, 0.5, 0.75])::DOUBLE AS q, unnest(frequency)::DOUBLE AS cut FROM cuts"""

_COHORT_SIZE = f"""
WITH {_DEALS},
first AS (SELECT agent_id, CAST(date_trunc('month', min(deal_date)) AS DATE) AS cohort FROM deal GROUP BY agent_id)
SELECT cohort, CAST(count(*) AS BIGINT) AS size FROM first GROUP BY cohort"""


_QUARTERS = """
WITH {deals},
active AS (SELECT DISTINCT agent_id, CAST(date_trunc('quarter', deal_date) AS DATE) AS part FROM deal),
first AS (SELECT agent_id, min(part) AS cohort FROM active GROUP BY agent_id),
size AS (SELECT cohort, count(*) AS size FROM first GROUP BY cohort),
counted AS (
  SELECT cohort, date_diff('quarter', cohort, part) AS k, count(*) AS active
  FROM active JOIN first USING (agent_id) GROUP BY 1, 2)
SELECT cohort, CAST(k AS BIGINT) AS k, CAST(size AS BIGINT) AS size, CAST(active AS BIGINT) AS active,
       CAST(active AS DOUBLE) / CAST(size AS DOUBLE) AS retention
FROM counted JOIN size USING (cohort)""".format(deals=_DEALS)


def _retention(by: str) -> str:
    return f"""
WITH {_DEALS},
active AS (SELECT DISTINCT {by}, CAST(date_trunc('month', deal_date) AS DATE) AS month FROM agency_deal),
first AS (SELECT {by}, min(month) AS cohort FROM active GROUP BY {by}),
size AS (SELECT cohort, count(*) AS size FROM first GROUP BY cohort),
counted AS (
  SELECT cohort, 12 * (year(month) - year(cohort)) + month(month) - month(cohort) AS k, count(*) AS active
  FROM active JOIN first USING ({by}) GROUP BY 1, 2)
SELECT cohort, CAST(k AS BIGINT) AS k, CAST(size AS BIGINT) AS size, CAST(active AS BIGINT) AS active,
       CAST(active AS DOUBLE) / CAST(size AS DOUBLE) AS retention
FROM counted JOIN size USING (cohort)"""


_AGENT_DAY = f"""
WITH {_DEALS}
SELECT agent_id, deal_date, CAST(count(*) AS BIGINT) AS deals,
       CAST(sum(CASE WHEN status = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS won_deals,
       CAST(sum(CASE WHEN status = 'F' THEN amount ELSE 0 END) AS DECIMAL(38,2)) AS volume
FROM deal GROUP BY agent_id, deal_date"""

_AGENT_STAGE_DAY = f"""
WITH {_EVENTS}
SELECT agent_id, CAST(ts AS DATE) AS day, CAST(bit_or(1 << (stage_no - 1)) AS BIGINT) AS mask
FROM mark GROUP BY 1, 2"""

_STAGING_MANAGER = """
SELECT s_suppkey AS manager_id, lower(s_name) AS manager_name, TIMESTAMP '2000-01-01' AS updated_at FROM supplier"""

_STAGING_COMPANY = """
SELECT DISTINCT CAST(c_nationkey AS VARCHAR) || '|' || c_mktsegment AS agency_id,
       lower(n_name || ' ' || c_mktsegment) AS agency_name, TIMESTAMP '2000-01-01' AS updated_at
FROM customer JOIN nation ON c_nationkey = n_nationkey"""

_STAGING_AGENT = """
SELECT c_custkey AS agent_id, lower(c_name) AS agent_name,
       CAST(c_nationkey AS VARCHAR) || '|' || c_mktsegment AS agency_id, CAST(NULL AS VARCHAR) AS phone,
       TIMESTAMP '2000-01-01' AS updated_at
FROM customer"""

_STAGING_AGENT_DIRTY = """
SELECT c_custkey AS agent_id, lower(c_name) AS agent_name,
       CAST(c_nationkey AS VARCHAR) || '|' || c_mktsegment AS agency_id,
       CASE WHEN c_nationkey > 3 THEN '7' || c_nationkey || c_custkey END AS phone, TIMESTAMP '2000-01-01' AS updated_at
FROM customer"""

_DEAL_COLUMNS = """
o_orderkey AS deal_id, o_custkey AS agent_id, CAST(o_totalprice AS DECIMAL(18,2)) AS amount,
CASE o_orderstatus WHEN 'F' THEN 'won' WHEN 'O' THEN 'open' WHEN 'P' THEN 'partial' END AS status,
CAST(o_orderdate AS TIMESTAMP) AS deal_ts, CAST(o_orderdate AS TIMESTAMP) AS updated_at"""

_STAGING_DEAL = f"SELECT {_DEAL_COLUMNS} FROM orders"

_STAGING_DEAL_DIRTY = f"""
SELECT * REPLACE (CASE WHEN status <> 'partial' THEN amount END AS amount) FROM ({_STAGING_DEAL})"""

_STAGING_SHOWING = """
SELECT event_id AS record_id, user_id AS agent_id, CAST(ts AS DATE) AS shown_at,
       CAST(CAST(floor(value) AS BIGINT) AS DECIMAL(18,2)) AS score
FROM events"""

_STAGING_SUPPORT = """
SELECT o_orderkey AS case_id, o_orderkey AS deal_id, o_orderpriority AS status,
       CAST(o_orderdate AS TIMESTAMP) AS updated_at
FROM orders"""

_STAGING_EVENT = """
SELECT event_id, user_id AS agent_id, CAST(ts AS TIMESTAMP) AS ts, event_type AS stage_code,
       CAST(CASE event_type WHEN 'signup' THEN 1 WHEN 'view' THEN 2 WHEN 'click' THEN 3
            WHEN 'purchase' THEN 4 WHEN 'error' THEN 5 END AS BIGINT) AS stage_no,
       CAST(json_extract_string(props, '$.k') AS BIGINT) AS props_k
FROM events"""

_STAGING_MARKET = """
WITH line AS (
  SELECT concat_ws('/', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_shipdate AS DATE),
           CAST(l_extendedprice AS DECIMAL(18,2)), CAST(l_quantity AS DECIMAL(18,2)),
           CAST(l_discount AS DECIMAL(18,2)), CAST(l_tax AS DECIMAL(18,2)), l_returnflag, l_linestatus
         ) AS market_deal_id, lower(p_type) AS object_type,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS price, CAST(l_quantity AS DECIMAL(18,2)) AS area,
         CAST(l_shipdate AS DATE) AS deal_date
  FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT market_deal_id, object_type, price, area, deal_date
FROM line
QUALIFY row_number() OVER (
  PARTITION BY market_deal_id ORDER BY deal_date DESC, price DESC, area DESC, object_type DESC) = 1"""

_STAGING_REJECTS = """
SELECT o_orderkey AS deal_id, 'status' AS "column", o_orderstatus AS cell FROM orders WHERE o_orderstatus = 'P'"""

_FUNNEL_DAILY = f"""
WITH {_EVENTS}
SELECT CAST(ts AS DATE) AS day, CAST(stage_no AS BIGINT) AS stage_no, CAST(count(*) AS BIGINT) AS events
FROM mark GROUP BY 1, 2"""

_LOST = "(o_orderkey % 97 = 0 OR o_orderkey BETWEEN 5000 AND 6000)"

_DELETED_DEALS = f"SELECT o_orderkey AS deal_id FROM orders WHERE {_LOST}"

_WITHOUT_DELETED = _rating("agent_id").replace("FROM orders)", f"FROM orders WHERE NOT {_LOST})")

_RATING_AS_OF = f"""
WITH {_DEALS},
moves AS (SELECT c_custkey AS agent_id, CAST(c_nationkey AS VARCHAR) || '|' || c_mktsegment AS own,
                 CAST((c_nationkey + 1) % 25 AS VARCHAR) || '|' || c_mktsegment AS there,
                 CAST(DATE '1996-01-01' + CAST(c_custkey * 37 % 1800 AS INTEGER) AS DATE) AS moved FROM customer),
period AS (
  SELECT agent_id, own AS agency_id, DATE '0001-01-01' AS a, moved AS b FROM moves
  UNION ALL
  SELECT agent_id, there, moved, CASE WHEN agent_id % 3 = 0 THEN CAST(moved + 400 AS DATE) ELSE DATE '9999-01-01' END FROM moves
  UNION ALL
  SELECT agent_id, own, CAST(moved + 400 AS DATE), DATE '9999-01-01' FROM moves WHERE agent_id % 3 = 0),
total AS (
  SELECT p.agency_id, count(*) AS deals, sum(amount) AS volume
  FROM deal d LEFT JOIN period p ON d.agent_id = p.agent_id AND d.deal_date >= p.a AND d.deal_date < p.b
  WHERE status = 'F' GROUP BY p.agency_id)
SELECT agency_id, CAST(deals AS BIGINT) AS deals, CAST(volume AS DECIMAL(38,2)) AS volume,
       CAST(rank() OVER (ORDER BY volume DESC) AS BIGINT) AS rnk
FROM total"""


def _units(days: str = "", month: bool = False) -> str:
    pick = "CAST(date_trunc('month', ts) AS DATE) AS month," if month else ""
    return f"""
WITH {_EVENTS}
SELECT {pick} CAST(stage_no AS BIGINT) AS stage_no, CAST(count(DISTINCT agent_id) AS BIGINT) AS units
FROM mark {days} GROUP BY ALL"""


ORACLE: dict[str, str] = {
    "funnel_reached": _reached(),
    "funnel_snapshot": _snapshot(),
    "funnel_ordered": _ordered(),
    "funnel_by_agency": _snapshot("agency_id"),
    "funnel_by_week": _snapshot("week", "week AS period,"),
    "funnel_reached_by_agency": _reached("agency_id"),
    "funnel_ordered_by_agency": _ordered(by_agency=True),
    "rating_agent": _rating("agent_id"),
    "rating_agency": _rating("agency_id"),
    "rating_agent_in_agency": _RATING_WITHIN,
    "leaderboard_agent": _leaderboard("agent_id"),
    "leaderboard_agency": _leaderboard("agency_id"),
    "leaderboard_agent_in_year": _leaderboard("agent_id", _IN_YEAR),
    "rating_agency_in_year": _rating("agency_id", _IN_YEAR),
    "churn_agent_as_of": _churn("agent_id", 180, "2000-12-31"),
    "cohort_retention_quarter": _QUARTERS,
    "churn_agent": _churn("agent_id", 180),
    "churn_agency": _churn("agency_id", 30),
    "activity_status": _ACTIVITY,
    "rf_segment": _rf("agent_id") + " SELECT * FROM segment",
    "rf_matrix": _rf_matrix("agent_id"),
    "rf_matrix_agency": _rf_matrix("agency_id"),
    "rf_cuts": _RF_CUTS,
    "cohort_size": _COHORT_SIZE,
    "cohort_retention": _retention("agent_id"),
    "cohort_retention_agency": _retention("agency_id"),
    "agent_day": _AGENT_DAY,
    "agent_stage_day": _AGENT_STAGE_DAY,
    "staging_manager": _STAGING_MANAGER,
    "staging_company": _STAGING_COMPANY,
    "staging_agent": _STAGING_AGENT,
    "staging_deal": _STAGING_DEAL,
    "staging_event": _STAGING_EVENT,
    "staging_market": _STAGING_MARKET,
    "staging_agent_dirty": _STAGING_AGENT_DIRTY,
    "staging_deal_dirty": _STAGING_DEAL_DIRTY,
    "staging_showing": _STAGING_SHOWING,
    "staging_support": _STAGING_SUPPORT,
    "staging_rejects": _STAGING_REJECTS,
    "raw_incremental_latest": _STAGING_DEAL,
    "funnel_daily_stream": _FUNNEL_DAILY,
    "funnel_daily_late": _FUNNEL_DAILY,
    "refreshed_rating_agency": _rating("agency_id"),
    "refreshed_funnel_ordered": _ordered(),
    "refreshed_funnel_snapshot": _snapshot(),
    "refreshed_funnel_by_agency": _snapshot("agency_id"),
    "refreshed_rating_agent": _rating("agent_id"),
    "refreshed_leaderboard_agent": _leaderboard("agent_id"),
    "refreshed_churn_agent": _churn("agent_id", 180),
    "refreshed_rf_matrix": _rf_matrix("agent_id"),
    "refreshed_cohort_retention": _retention("agent_id"),
    "refreshed_funnel_reached": _reached(),
    "refreshed_funnel_by_period": _snapshot("week", "week AS period,"),
    "refreshed_rating_agent_in_agency": _RATING_WITHIN,
    "refreshed_leaderboard_agency": _leaderboard("agency_id"),
    "refreshed_churn_agency": _churn("agency_id", 30),
    "refreshed_activity_status": _ACTIVITY,
    "refreshed_rf_segment": _rf("agent_id") + " SELECT * FROM segment",
    "refreshed_cohort_size": _COHORT_SIZE,
    "refreshed_rating_agency_moved": _rating("agency_id"),
    "refreshed_without_deleted": _WITHOUT_DELETED,
    "deleted_deals": _DELETED_DEALS,
    "rating_agency_as_of": _RATING_AS_OF,
    "funnel_units_in_range": _units("WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-14'"),
    "funnel_units_by_month": _units(month=True),
    "refreshed_company": _STAGING_COMPANY,
    "refreshed_manager": _STAGING_MANAGER,
    "refreshed_market": _STAGING_MARKET,
}

#: A patched warehouse shows what one that was loaded at once does.
ORACLE |= {f"refreshed_patched_{mart}": ORACLE[f"refreshed_{mart}"] for mart in (
    "funnel_snapshot", "funnel_ordered", "funnel_by_agency", "funnel_by_period", "rating_agent", "rating_agency",
    "rating_agent_in_agency", "leaderboard_agency", "churn_agent", "churn_agency", "activity_status", "rf_segment", "rf_matrix",
    "cohort_size", "cohort_retention")}
