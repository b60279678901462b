"""Independent DuckDB SQL for every registered query.

Each statement is written from the metric's definition (one query per
grain, joins that state the condition), while the Spark operators use
rewritten forms, so agreement proves the rewrites. The tables ``lineitem orders part customer`` are pre-registered
views; every statement derives the panel from them (FIXTURES.md).
"""

from __future__ import annotations

from ..sources.config import TEST_CLIENT_FILTERS, TEST_HOLIDAY_RANGES
from ..sources.dims import STATE_CODES, STATE_NAMES, STATE_REGIONS
from ..functions.metrics import INCOME_BANDS

COARSE = ("month", "quarter", "year")
ALL = ("day", "month", "quarter", "year")


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def trunc(col: str, grain: str) -> str:
    if grain == "day":
        return f"CAST({col} AS DATE)"
    return f"CAST(date_trunc('{grain}', {col}) AS DATE)"


BASE_CTE = r"""
base AS (
  SELECT CAST(o.o_orderdate AS DATE) AS date,
         o.o_custkey AS unique_mem_id,
         p.p_brand AS company,
         'Vertical_' || CAST(CAST(regexp_extract(p.p_brand, '(\d+)', 1) AS INTEGER) % 5 AS VARCHAR) AS vertical,
         'Sub_' || CAST(CAST(regexp_extract(p.p_brand, '(\d+)', 1) AS INTEGER) % 10 AS VARCHAR) AS sub_vertical,
         1 + l.l_linenumber % 3 AS transactions,
         CAST(round(l.l_extendedprice * (1 - l.l_discount), 2) AS DECIMAL(18,2)) AS amount
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN part p ON l.l_partkey = p.p_partkey
)"""


def cohort_cte() -> str:
    """Per client: DISTINCT base rows passing all of its predicates."""
    by_client: dict[str, list[str]] = {}
    for client, pred in TEST_CLIENT_FILTERS:
        by_client.setdefault(client, []).append(pred)
    parts = [
        f"SELECT * FROM (SELECT DISTINCT {_q(c)} AS client, b.* FROM base b WHERE {' AND '.join(f'({p})' for p in preds)})"
        for c, preds in sorted(by_client.items())
    ]
    return "cohort AS (\n  " + "\n  UNION ALL ".join(parts) + "\n)"


def panel_cte(grains=ALL) -> str:
    """Per grain, the distinct users of each period."""
    parts = [
        f"SELECT '{g}' AS time_period, {trunc('date', g)} AS date, COUNT(DISTINCT unique_mem_id) AS unique_users "
        f"FROM base GROUP BY 2" for g in grains
    ]
    return "panel AS (\n  " + "\n  UNION ALL ".join(parts) + "\n)"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"


# --------------------------------------------------------------------------- A1, A10, A11, A30


def normalize_base() -> str:
    return with_(BASE_CTE) + "SELECT * REPLACE (CAST(amount AS DOUBLE) AS amount) FROM base"


def panel_users() -> str:
    return with_(BASE_CTE, panel_cte()) + "SELECT time_period, date, CAST(unique_users AS BIGINT) AS unique_users FROM panel"


def period_days() -> str:
    parts = []
    for g in COARSE:
        parts.append(
            f"SELECT DISTINCT '{g}' AS time_period, {trunc('date', g)} AS date FROM base")
    body = " UNION ALL ".join(parts)
    return with_(BASE_CTE) + f"""
SELECT time_period, date,
       CAST(date_diff('day', date, CAST(date + CASE time_period WHEN 'month' THEN INTERVAL 1 MONTH
            WHEN 'quarter' THEN INTERVAL 3 MONTH ELSE INTERVAL 12 MONTH END AS DATE)) AS INTEGER) AS days
FROM ({body})"""


def expand_periods() -> str:
    parts = [
        f"SELECT '{g}' AS time_period, {trunc('date', g)} AS date, CAST(SUM(transactions) AS BIGINT) AS transactions, "
        f"CAST(SUM(amount) AS DOUBLE) AS amount, COUNT(*) AS line_count FROM base GROUP BY 2"
        for g in ALL
    ]
    return with_(BASE_CTE) + "\nUNION ALL\n".join(parts)


# --------------------------------------------------------------------------- A14, A26, A27


def client_cohort() -> str:
    return with_(BASE_CTE, cohort_cte()) + "SELECT * REPLACE (CAST(amount AS DOUBLE) AS amount) FROM cohort"


def user_breakdown() -> str:
    """A user is new at a company in the first period with a purchase there, else returning."""
    parts = []
    for g in COARSE:
        parts.append(f"""
SELECT u.client, u.date, u.company, u.user_type,
       CAST(u.users AS DOUBLE) / p.unique_users AS unique_users,
       CAST(u.transactions AS DOUBLE) / p.unique_users AS transactions,
       CAST(u.amount AS DOUBLE) / p.unique_users AS amount,
       '{g}' AS time_period
FROM (
  SELECT m.client, m.date, m.company,
         CASE WHEN f.first_date = m.date THEN 'New User' ELSE CAST(f.first_date AS VARCHAR) END AS user_type,
         COUNT(DISTINCT m.unique_mem_id) AS users, SUM(m.transactions) AS transactions, SUM(m.amount) AS amount
  FROM (SELECT client, {trunc('date', g)} AS date, unique_mem_id, company, transactions, amount FROM cohort) m
  JOIN (SELECT client, unique_mem_id, company, MIN({trunc('date', g)}) AS first_date
        FROM cohort GROUP BY 1, 2, 3) f USING (client, unique_mem_id, company)
  GROUP BY 1, 2, 3, 4
) u
JOIN panel p ON p.time_period = '{g}' AND p.date = u.date""")
    return with_(BASE_CTE, cohort_cte(), panel_cte(COARSE)) + "\nUNION ALL\n".join(parts)


def transaction_bins(bins=(5, 15, 35, 55)) -> str:
    """A user's purchases are the (day, company) pairs. A company's place is
    one more than the purchases before the last day at that company; the bins
    are ranges of places."""
    edges = [*bins, None]
    rows = [(None, bins[0] - 1, f"1 - {bins[0] - 1} Transactions")]
    rows += [(lo, hi - 1 if hi else None, f"{lo} - {hi - 1} Transactions" if hi else f"> {lo} Transactions")
             for lo, hi in zip(edges, edges[1:])]
    values = ", ".join(f"({-1 if lo is None else lo}, {10**9 if hi is None else hi}, {_q(label)}, {i})"
                       for i, (lo, hi, label) in enumerate(rows, 1))
    return with_(BASE_CTE, cohort_cte(), f"""
bought AS (SELECT DISTINCT client, unique_mem_id, company, date FROM cohort),
placed AS (
  SELECT l.client, l.company, 1 + (
    SELECT COUNT(*) FROM bought b
    WHERE b.client = l.client AND b.unique_mem_id = l.unique_mem_id AND b.date < l.last_date) AS place
  FROM (SELECT client, unique_mem_id, company, MAX(date) AS last_date FROM bought GROUP BY 1, 2, 3) l),
bin(lowest, highest, cohort_bin, cohort_bin_order) AS (VALUES {values}),
users AS (
  SELECT client, cohort_bin, cohort_bin_order, company, COUNT(*) AS n
  FROM placed JOIN bin ON place BETWEEN lowest AND highest GROUP BY 1, 2, 3, 4)""") + """
SELECT client, cohort_bin, company,
       CAST(n AS DOUBLE) / SUM(n) OVER (PARTITION BY client, cohort_bin) AS retention_by_transaction_bin,
       CAST(n AS DOUBLE) / SUM(n) OVER (PARTITION BY client, company) AS retention_by_transaction_company,
       CAST(cohort_bin_order AS INTEGER) AS cohort_bin_order
FROM users"""


# --------------------------------------------------------------------------- A18-A21


def round6(x: str) -> str:
    """Same presentation rounding as ``functions.metrics.round6``."""
    return f"(floor(({x}) * 1000000.0 + 0.5) / 1000000.0)"


def cadence_ctes(window_days: int = 28, max_gap: int = 200) -> list[str]:
    """From the definition: a purchase is paired with the next one if that is
    the only purchase after it up to and including its day; then every pair
    counts on each cohort day of its window."""
    return [
        """bought AS (
  SELECT client, unique_mem_id, company, date, COUNT(*) AS n FROM cohort GROUP BY 1, 2, 3, 4)""",
        """tbo AS (
  SELECT e.client, e.unique_mem_id, e.company, b.date AS date_base, e.date AS date,
         CAST(date_diff('day', e.date, b.date) AS INTEGER) AS days_from_last_order
  FROM cohort e JOIN bought b
    ON b.client = e.client AND b.unique_mem_id = e.unique_mem_id AND b.company = e.company AND b.date > e.date
  WHERE b.n = 1 AND NOT EXISTS (
    SELECT 1 FROM bought x WHERE x.client = e.client AND x.unique_mem_id = e.unique_mem_id
       AND x.company = e.company AND x.date > e.date AND x.date < b.date))""",
        """cohort_days AS (SELECT DISTINCT client, date AS day FROM cohort)""",
        f"""r28 AS (
  SELECT t.client, t.company, d.day AS date,
         CAST(SUM(t.days_from_last_order) AS DOUBLE) / COUNT(*) AS days_between_orders
  FROM tbo t JOIN cohort_days d
    ON t.client = d.client AND t.date_base <= d.day AND t.date_base + {window_days - 1} >= d.day
  WHERE NOT (t.date_base = t.date) AND t.days_from_last_order <= {max_gap}
  GROUP BY 1, 2, 3)""",
        "period_gap AS (\n  " + "\n  UNION ALL ".join(
            f"SELECT client, '{g}' AS time_period, {trunc('date', g)} AS date, company, "
            f"AVG(days_between_orders) AS days_between_orders FROM r28 GROUP BY 1, 3, 4" for g in COARSE) + ")",
    ]


def purchase_pairs() -> str:
    return with_(BASE_CTE, cohort_cte(), *cadence_ctes()[:2]) + """
SELECT client, unique_mem_id, company, date_base, date, days_from_last_order, COUNT(*) AS pairs
FROM tbo GROUP BY ALL"""


def rolling_gap() -> str:
    return with_(BASE_CTE, cohort_cte(), *cadence_ctes()[:4]) + "SELECT * FROM r28"


def period_gap() -> str:
    return with_(BASE_CTE, cohort_cte(), *cadence_ctes()) + f"""
SELECT client, time_period, date, company, {round6('days_between_orders')} AS days_between_orders FROM period_gap"""


def company_metrics() -> str:
    parts = [f"""
SELECT c.client, c.date, c.company, c.vertical, c.sub_vertical,
       CAST(c.transactions AS DOUBLE) / c.users AS transactions_per_user,
       CAST(c.amount AS DOUBLE) / c.users AS amount_per_user,
       CAST(c.amount AS DOUBLE) / c.transactions AS average_transaction,
       {round6('t.days_between_orders')} AS days_between_orders,
       '{g}' AS time_period
FROM (SELECT client, {trunc('date', g)} AS date, company, vertical, sub_vertical,
             SUM(transactions) AS transactions, SUM(amount) AS amount, COUNT(DISTINCT unique_mem_id) AS users
      FROM cohort GROUP BY 1, 2, 3, 4, 5) c
JOIN period_gap t ON t.time_period = '{g}' AND t.client = c.client AND t.date = c.date AND t.company = c.company"""
             for g in COARSE]
    return with_(BASE_CTE, cohort_cte(), *cadence_ctes()) + "\nUNION ALL\n".join(parts)


# --------------------------------------------------------------------------- A3-A9, A13, A29


def _values(rows, cols) -> str:
    body = ", ".join("(" + ", ".join(_q(v) if isinstance(v, str) else str(v) for v in r) + ")" for r in rows)
    return f"(VALUES {body}) AS t({', '.join(cols)})"


def dims_ctes() -> list[str]:
    names = dict(STATE_NAMES)
    codes = "[" + ", ".join(_q(c) for c in STATE_CODES) + "]"
    return [
        f"state_names AS (SELECT * FROM {_values(STATE_NAMES, ['state_abr', 'state'])})",
        f"state_regions AS (SELECT * FROM {_values([(r, names[c]) for c, r in STATE_REGIONS], ['region', 'state'])})",
        f"income_order AS (SELECT * FROM {_values(INCOME_BANDS, ['income_order', 'census_cat'])})",
        f"""geo AS (
  SELECT unique_mem_id, year, month,
         {codes}[((unique_mem_id * 7 + month * 3) % 52) + 1] AS state1,
         CASE WHEN unique_mem_id % 20 = 0 THEN NULL ELSE {codes}[(unique_mem_id % 52) + 1] END AS state2
  FROM (SELECT DISTINCT unique_mem_id, year(date) AS year, month(date) AS month FROM base))""",
        """income AS (
  SELECT u.unique_mem_id, u.month_year, c.c_acctbal * 25 AS income_12_months
  FROM (SELECT DISTINCT unique_mem_id, CAST(date_trunc('month', date) AS DATE) AS month_year FROM base) u
  JOIN customer c ON c.c_custkey = u.unique_mem_id)""",
        """month_state AS (
  SELECT g.unique_mem_id, make_date(CAST(g.year AS BIGINT), CAST(g.month AS BIGINT), 1) AS date, n1.state, r.region
  FROM geo g
  JOIN state_names n1 ON g.state1 = n1.state_abr
  JOIN state_names n2 ON g.state2 = n2.state_abr
  JOIN state_regions r ON r.state = n1.state)""",
    ]


def band_sql(x: str) -> str:
    out = f"CASE WHEN {x} IS NULL THEN NULL "
    for (_, label), (upper, _) in zip(INCOME_BANDS, INCOME_BANDS[1:]):
        out += f"WHEN {x} <= {upper} THEN {_q(label)} "
    return out + f"ELSE {_q(INCOME_BANDS[-1][1])} END"


def tags_ctes(grains=ALL) -> list[str]:
    inc = "\n  UNION ALL ".join(
        f"SELECT '{g}' AS time_period, {trunc('month_year', g)} AS date, unique_mem_id, "
        f"AVG(income_12_months) AS income FROM income GROUP BY 2, 3" for g in grains)
    st = "\n  UNION ALL ".join(
        f"SELECT '{g}' AS time_period, {trunc('date', g)} AS date, unique_mem_id, state, region, "
        f"COUNT(state) AS state_count FROM month_state GROUP BY 2, 3, 4, 5" for g in grains)
    return [
        f"period_income AS (SELECT *, {band_sql('income')} AS census_cat FROM ({inc}))",
        f"""home_state AS (
  SELECT time_period, date, unique_mem_id, state, region FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY time_period, date, unique_mem_id
                                 ORDER BY state_count DESC, state ASC) AS rn
    FROM ({st})) WHERE rn = 1)""",
        """tags AS (
  SELECT i.unique_mem_id, i.date, i.census_cat, i.time_period, h.state, h.region
  FROM period_income i JOIN home_state h USING (time_period, date, unique_mem_id))""",
    ]


def income_band() -> str:
    return with_(BASE_CTE, *dims_ctes()) + f"""
SELECT unique_mem_id, month_year, income_12_months, {band_sql('income_12_months')} AS census_cat FROM income"""


def user_month_state() -> str:
    return with_(BASE_CTE, *dims_ctes()) + "SELECT * FROM month_state"


def user_period_income() -> str:
    return with_(BASE_CTE, *dims_ctes(), *tags_ctes()) + f"""
SELECT time_period, date, unique_mem_id, {round6('income')} AS income, census_cat FROM period_income"""


def user_period_home_state() -> str:
    return with_(BASE_CTE, *dims_ctes(), *tags_ctes()) + "SELECT * FROM home_state"


def geo_income_tags() -> str:
    return with_(BASE_CTE, *dims_ctes(), *tags_ctes()) + "SELECT * FROM tags"


def _state_income_cte() -> str:
    parts = []
    for g in COARSE:
        label = {"month": "CAST(year(m.date) AS VARCHAR) || ' month ' || CAST(month(m.date) AS VARCHAR)",
                 "quarter": "CAST(year(m.date) AS VARCHAR) || ' quarter ' || CAST(quarter(m.date) AS VARCHAR)",
                 "year": "'year'"}[g]
        parts.append(f"""
  SELECT m.census_cat, m.date, m.state, m.company, m.vertical, m.sub_vertical, m.region,
         CAST(m.transactions AS DOUBLE) / p.unique_users AS transactions,
         CAST(m.amount AS DOUBLE) / p.unique_users AS amount,
         o.income_order, '{g}' AS time_period, {label} AS date_category
  FROM (SELECT b.date, t.state, t.census_cat, b.company, b.vertical, b.sub_vertical, t.region,
               SUM(b.transactions) AS transactions, SUM(b.amount) AS amount
        FROM (SELECT {trunc('date', g)} AS date, unique_mem_id, company, vertical, sub_vertical, transactions, amount
              FROM base) b
        LEFT JOIN (SELECT * FROM tags WHERE time_period = '{g}') t
          ON b.date = t.date AND b.unique_mem_id = t.unique_mem_id
        GROUP BY 1, 2, 3, 4, 5, 6, 7) m
  JOIN panel p ON p.time_period = '{g}' AND p.date = m.date
  JOIN income_order o ON o.census_cat = m.census_cat""")
    return "state_income AS (" + "\n  UNION ALL".join(parts) + ")"


def state_income_metrics() -> str:
    return with_(BASE_CTE, panel_cte(COARSE), *dims_ctes(), *tags_ctes(COARSE), _state_income_cte()) + \
        "SELECT * FROM state_income"


def client_metric_slice() -> str:
    by_client: dict[str, list[str]] = {}
    for client, pred in TEST_CLIENT_FILTERS:
        by_client.setdefault(client, []).append(pred)
    parts = [f"SELECT {_q(c)} AS client, s.* FROM state_income s WHERE {' AND '.join(f'({p})' for p in preds)}"
             for c, preds in sorted(by_client.items())]
    return with_(BASE_CTE, panel_cte(COARSE), *dims_ctes(), *tags_ctes(COARSE), _state_income_cte()) + \
        "\nUNION ALL\n".join(parts)


# --------------------------------------------------------------------------- A22, A23, A24


def _elapsed(later: str, earlier: str, grain: str) -> str:
    if grain == "year":
        return f"(year({later}) - year({earlier}))"
    if grain == "month":
        return f"((year({later}) - year({earlier})) * 12 + month({later}) - month({earlier}))"
    return f"((year({later}) - year({earlier})) * 4 + quarter({later}) - quarter({earlier}))"


def retention() -> str:
    """From the definition: a user is retained from period b to d if active
    in both; without gaps, if active in every period from b to d, that is in
    as many periods as there are."""
    parts = []
    for g in COARSE:
        for method in ("drop_nl_users", "keep_nl_users"):
            pairs = f"""(SELECT b.client, b.unique_mem_id, b.company, b.date AS date_base, d.date,
          CAST({_elapsed('d.date', 'b.date', g)} AS INTEGER) AS period_elapsed
   FROM (SELECT DISTINCT client, unique_mem_id, company, {trunc('date', g)} AS date FROM cohort) b
   JOIN (SELECT DISTINCT client, unique_mem_id, company, {trunc('date', g)} AS date FROM cohort) d
     ON b.client = d.client AND b.unique_mem_id = d.unique_mem_id AND b.company = d.company
    AND b.date <= d.date)"""
            if method == "drop_nl_users":
                rd = f"""(SELECT r.client, r.unique_mem_id, r.company, r.date_base, r.date, r.period_elapsed
   FROM {pairs} r JOIN {pairs} m
     ON m.client = r.client AND m.unique_mem_id = r.unique_mem_id AND m.company = r.company
    AND m.date_base = r.date_base AND m.date <= r.date
   GROUP BY ALL HAVING COUNT(*) = r.period_elapsed + 1)"""
            else:
                rd = pairs
            parts.append(f"""
SELECT x.client, x.date_base, x.company,
       CAST(u.base_users AS DOUBLE) / p.unique_users AS unique_users_base,
       x.date, x.period_elapsed, '{g}' AS time_period,
       CAST(x.retained AS DOUBLE) / p.unique_users AS retained_users,
       make_date(2000 + x.period_elapsed, 1, 1) AS period_elapsed_date,
       strftime(x.date_base, '%m/%d/%Y') AS date_base_cat,
       '{method}' AS method
FROM (SELECT client, company, date_base, date, period_elapsed, COUNT(DISTINCT unique_mem_id) AS retained
      FROM {rd} GROUP BY 1, 2, 3, 4, 5) x
JOIN (SELECT client, company, date_base, COUNT(DISTINCT unique_mem_id) AS base_users
      FROM {rd} GROUP BY 1, 2, 3) u USING (client, company, date_base)
JOIN panel p ON p.time_period = '{g}' AND p.date = x.date_base""")
    return with_(BASE_CTE, cohort_cte(), panel_cte(COARSE)) + "\nUNION ALL\n".join(parts)


def crossover() -> str:
    """Per grain, what users of a reference company spend at each company, over
    what they spend at all companies."""
    parts = []
    for g in COARSE:
        parts.append(f"""
SELECT * FROM (
  WITH j AS (
    SELECT r.client, a.date, r.company_ref, a.company, a.vertical, a.sub_vertical, r.transactions_ref,
           a.transactions, a.amount
    FROM (SELECT {trunc('date', g)} AS date, unique_mem_id, company, vertical, sub_vertical,
                 SUM(transactions) AS transactions, SUM(amount) AS amount
          FROM base GROUP BY 1, 2, 3, 4, 5) a
    JOIN (SELECT client, {trunc('date', g)} AS date, unique_mem_id, company AS company_ref,
                 SUM(transactions) AS transactions_ref
          FROM cohort GROUP BY 1, 2, 3, 4) r
      ON a.date = r.date AND a.unique_mem_id = r.unique_mem_id),
  tot AS (SELECT client, date, company_ref, SUM(transactions) AS tt, SUM(amount) AS ta FROM j GROUP BY 1, 2, 3)
  SELECT c.client, c.date, c.company_ref, c.company, c.vertical, c.sub_vertical,
         CAST(c.transactions_ref AS BIGINT) AS transactions_ref,
         CAST(c.transactions AS DOUBLE) / t.tt AS transactions,
         CAST(c.amount AS DOUBLE) / CAST(t.ta AS DOUBLE) AS amount,
         '{g}' AS time_period
  FROM (SELECT client, date, company_ref, company, vertical, sub_vertical, transactions_ref,
               SUM(transactions) AS transactions, SUM(amount) AS amount
        FROM j GROUP BY 1, 2, 3, 4, 5, 6, 7) c
  JOIN tot t USING (client, date, company_ref))""")
    return with_(BASE_CTE, cohort_cte()) + "\nUNION ALL\n".join(parts)


# --------------------------------------------------------------------------- A12, A15-A17, A28


def _holiday_ctes() -> list[str]:
    """The fixture's three rules with their offsets written out by hand."""
    tg = "(make_date(y, 11, 1) + CAST((4 - dayofweek(make_date(y, 11, 1)) + 7) % 7 + 21 AS INTEGER))"
    xmas = "make_date(y, 12, 25)"
    rules = [
        ("alpha", "Thanksgiving", f"{tg} - 7", f"{tg} + 7"),
        ("alpha", "Christmas", f"{xmas} - 7", f"{xmas} + 7"),
        ("beta", "Thanksgiving", f"{tg} - 3", f"{tg}"),
    ]
    assert len(rules) == len(TEST_HOLIDAY_RANGES)
    spans = "\n    UNION ALL ".join(
        f"SELECT {_q(c)} AS client, {_q(h)} AS holiday, {s} AS s, {e} AS e FROM yrs" for c, h, s, e in rules)
    return [
        """yrs AS (SELECT UNNEST(generate_series(CAST(year(MIN(date)) AS BIGINT), CAST(year(MAX(date)) AS BIGINT))) AS y
  FROM base)""",
        f"spans AS (\n    {spans})",
        """calendar AS (
  SELECT client, holiday, CAST(s + CAST(i AS INTEGER) AS DATE) AS date,
         CASE WHEN year(s) = year(e) THEN CAST(year(s) AS VARCHAR)
              ELSE CAST(year(s) AS VARCHAR) || '/' || CAST(year(e) AS VARCHAR) END AS years
  FROM (SELECT *, UNNEST(generate_series(0, date_diff('day', s, e))) AS i FROM spans WHERE e >= s))""",
        "hcohort AS (SELECT c.*, h.holiday, h.years FROM cohort c JOIN calendar h ON c.client = h.client AND c.date = h.date)",
        """hdays AS (SELECT client, holiday, years, COUNT(DISTINCT date) AS days FROM hcohort GROUP BY 1, 2, 3)""",
        """husers AS (
  SELECT h.client, h.holiday, h.years, COUNT(DISTINCT b.unique_mem_id) AS unique_users
  FROM base b JOIN calendar h ON b.date = h.date GROUP BY 1, 2, 3)""",
    ]


def holiday_calendar() -> str:
    return with_(BASE_CTE, cohort_cte(), *_holiday_ctes()) + "SELECT * FROM calendar"


def holiday_cohort() -> str:
    return with_(BASE_CTE, cohort_cte(), *_holiday_ctes()) + \
        "SELECT * REPLACE (CAST(amount AS DOUBLE) AS amount) FROM hcohort"


def holiday_day_count() -> str:
    return with_(BASE_CTE, cohort_cte(), *_holiday_ctes()) + "SELECT * FROM hdays"


def holiday_panel_users() -> str:
    return with_(BASE_CTE, cohort_cte(), *_holiday_ctes()) + "SELECT * FROM husers"


def holiday_metrics() -> str:
    return with_(BASE_CTE, cohort_cte(), *_holiday_ctes()) + """
SELECT m.client, m.years, m.holiday, m.company, m.vertical, m.sub_vertical,
       CAST(m.t AS DOUBLE) / u.unique_users AS transactions,
       CAST(m.a AS DOUBLE) / u.unique_users AS amount,
       CAST(m.a AS DOUBLE) / m.t AS average_transaction,
       CAST(m.t AS DOUBLE) / m.buyers AS transactions_per_user,
       CAST(m.a AS DOUBLE) / m.buyers AS amount_per_user
FROM (SELECT client, years, holiday, company, vertical, sub_vertical, SUM(transactions) AS t, SUM(amount) AS a,
             COUNT(DISTINCT unique_mem_id) AS buyers
      FROM hcohort GROUP BY 1, 2, 3, 4, 5, 6) m
JOIN husers u USING (client, years, holiday)
JOIN hdays d USING (client, years, holiday)"""


# --------------------------------------------------------------------------- A2, A25, A33, A38


def period_diff() -> str:
    """Differences of the calendar numbers of the two periods."""
    return with_(BASE_CTE) + """
SELECT unique_mem_id, company, first_date, last_date,
       CAST((year(last_date) - year(first_date)) * 12 + month(last_date) - month(first_date) AS INTEGER)
         AS months_elapsed,
       CAST((year(last_date) - year(first_date)) * 4 + ceil(month(last_date) / 3.0) - ceil(month(first_date) / 3.0)
         AS INTEGER) AS quarters_elapsed,
       CAST(year(last_date) - year(first_date) AS INTEGER) AS years_elapsed
FROM (SELECT unique_mem_id, company, MIN(date) AS first_date, MAX(date) AS last_date FROM base GROUP BY 1, 2)"""


def layout_parity() -> str:
    return with_(BASE_CTE) + """
SELECT date, unique_mem_id,
       CAST(SUM(transactions) AS BIGINT) AS transactions_flat, CAST(SUM(transactions) AS BIGINT) AS transactions_partitioned,
       CAST(SUM(amount) AS DOUBLE) AS amount_flat, CAST(SUM(amount) AS DOUBLE) AS amount_partitioned, TRUE AS agree
FROM base GROUP BY 1, 2"""


def union_all() -> str:
    return with_(BASE_CTE, panel_cte(COARSE)) + "SELECT * FROM panel"


def append_distinct() -> str:
    return with_(BASE_CTE, *dims_ctes()) + "SELECT DISTINCT unique_mem_id, state, region FROM month_state"


def upsert_user_state() -> str:
    """The last quarter's most frequent state of a year, else the year's."""
    home = """SELECT unique_mem_id, CAST(date_trunc('year', date) AS DATE) AS date, state, region,
         ROW_NUMBER() OVER (PARTITION BY unique_mem_id, year(date) ORDER BY COUNT(*) DESC, state) AS rn
  FROM month_state {where} GROUP BY 1, 2, 3, 4, year(date)"""
    return with_(BASE_CTE, *dims_ctes(), f"whole AS ({home.format(where='')})",
                 f"late AS ({home.format(where='WHERE quarter(date) = 4')})") + """
SELECT w.unique_mem_id, w.date, coalesce(l.state, w.state) AS state, coalesce(l.region, w.region) AS region
FROM (SELECT * FROM whole WHERE rn = 1) w
LEFT JOIN (SELECT * FROM late WHERE rn = 1) l USING (unique_mem_id, date)"""


def remove_clients() -> str:
    from .queries import REMOVED

    return with_(BASE_CTE, cohort_cte()) + \
        f"SELECT DISTINCT client, date FROM cohort WHERE client NOT IN ({', '.join(_q(c) for c in REMOVED)})"


def rename_clients(renames: dict[str, str] | None = None) -> str:
    from .queries import RENAMES

    renames = RENAMES if renames is None else renames
    case = "CASE " + " ".join(f"WHEN client = {_q(a)} THEN {_q(b)}" for a, b in sorted(renames.items())) + \
        " ELSE client END"
    return f"SELECT {case} AS client, * EXCLUDE (client) FROM ({transaction_bins()})"


def drop_client_outputs(removed=None) -> str:
    from .queries import REMOVED

    removed = REMOVED if removed is None else removed
    return f"SELECT * FROM ({transaction_bins()}) WHERE client NOT IN ({', '.join(_q(c) for c in removed)})"


def catalog_cycle() -> str:
    kept = {"saved": "true", "inserted": "year % 2 = 1", "replaced": "year % 2 = 0"}
    parts = [f"SELECT {_q(step)} AS step, *, 0 AS tables_left FROM totals WHERE {rows}" for step, rows in kept.items()]
    return with_(BASE_CTE, """totals AS (
  SELECT company, CAST(year(date) AS INTEGER) AS year, CAST(SUM(transactions) AS BIGINT) AS transactions,
         CAST(SUM(amount) AS DOUBLE) AS amount FROM base GROUP BY 1, 2)""") + "\nUNION ALL\n".join(parts)


def all_sql() -> dict[str, str]:
    return {
        "normalize_base": normalize_base(),
        "expand_periods": expand_periods(),
        "panel_users": panel_users(),
        "period_days": period_days(),
        "client_cohort": client_cohort(),
        "user_breakdown": user_breakdown(),
        "transaction_bins": transaction_bins(),
        "purchase_pairs": purchase_pairs(),
        "rolling_gap": rolling_gap(),
        "period_gap": period_gap(),
        "company_metrics": company_metrics(),
        "income_band": income_band(),
        "user_month_state": user_month_state(),
        "user_period_income": user_period_income(),
        "user_period_home_state": user_period_home_state(),
        "geo_income_tags": geo_income_tags(),
        "state_income_metrics": state_income_metrics(),
        "client_metric_slice": client_metric_slice(),
        "retention": retention(),
        "crossover": crossover(),
        "holiday_calendar": holiday_calendar(),
        "holiday_cohort": holiday_cohort(),
        "holiday_day_count": holiday_day_count(),
        "holiday_panel_users": holiday_panel_users(),
        "holiday_metrics": holiday_metrics(),
        "period_diff": period_diff(),
        "layout_parity": layout_parity(),
        "union_all": union_all(),
        "append_distinct": append_distinct(),
        "upsert_user_state": upsert_user_state(),
        "remove_clients": remove_clients(),
        "rename_clients": rename_clients(),
        "drop_client_outputs": drop_client_outputs(),
        "catalog_cycle": catalog_cycle(),
    }
