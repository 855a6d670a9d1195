"""Shared CTEs for the DuckDB oracles (the same definitions as plans/panel.py,
written independently in SQL)."""

PANEL_CTE = """
cy AS (
  SELECT DISTINCT o.o_custkey AS entity, c.c_nationkey AS unit,
         CAST(year(o.o_orderdate) AS INTEGER) AS period
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
),
pagg AS (
  SELECT a.unit, a.period, COUNT(*) AS members,
         CAST(SUM(CASE WHEN b.entity IS NULL THEN 0 ELSE 1 END) AS BIGINT) AS retained
  FROM cy a LEFT JOIN cy b ON a.entity = b.entity AND b.period = a.period - 1
  GROUP BY a.unit, a.period
),
pprev AS (
  SELECT unit, period, members,
         CAST(COALESCE(LAG(members) OVER (PARTITION BY unit ORDER BY period), 0) AS BIGINT) AS members_prev,
         retained
  FROM pagg
),
panel AS (
  SELECT unit, period, members, members_prev, retained,
         CASE WHEN members_prev > 0
              THEN ROUND(GREATEST(0.0, CAST(members_prev - members AS DOUBLE) * 100.0 / CAST(members_prev AS DOUBLE)), 2)
              ELSE 0.0 END AS leak_rate
  FROM pprev
)"""

FEATURES_CTE = PANEL_CTE + """,
feat0 AS (
  SELECT unit, period, members, leak_rate,
         CAST(LAG(members, 1) OVER w AS DOUBLE) AS members_lag1,
         LAG(leak_rate, 1) OVER w AS leak_rate_lag1,
         (CAST(LAG(members, 1) OVER w AS DOUBLE) - CAST(LAG(members, 2) OVER w AS DOUBLE))
           / NULLIF(CAST(LAG(members, 2) OVER w AS DOUBLE), 0.0) * 100.0 AS growth_rate_lag1,
         CAST(LAG(members, 1) OVER w AS DOUBLE) - CAST(LAG(members, 2) OVER w AS DOUBLE) AS delta_members_lag1,
         AVG(members) OVER (PARTITION BY unit ORDER BY period ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS avg_members_unite_past,
         CAST(ROW_NUMBER() OVER w AS INTEGER) AS season_index
  FROM panel
  WINDOW w AS (PARTITION BY unit ORDER BY period)
),
features AS (
  SELECT *, 1 - leak_rate_lag1 / 100.0 AS retention_rate,
         members_lag1 * (1 - leak_rate_lag1 / 100.0) AS members_x_retention
  FROM feat0 WHERE members_lag1 IS NOT NULL
)"""

REQUESTS_CTE = """
requests AS (
  SELECT event_id, ts,
         'ep' || CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) % 4 AS VARCHAR) AS endpoint,
         CASE WHEN event_type = 'error' THEN '500' ELSE '200' END AS status,
         value / 50.0 AS latency_s, user_id, event_type, value
  FROM events
)"""


def sig_sql(expr: str, digits: int = 10) -> str:
    """DuckDB twin of functions.scalar.round_sig (significant digits)."""
    e = f"floor(log10(abs({expr})))"
    return (f"CASE WHEN {expr} = 0 OR {expr} IS NULL THEN {expr} "
            f"ELSE round({expr} / pow(10.0, {e}), {digits - 1}) * pow(10.0, {e}) END")


def solve_cte(name: str, matrix: str, size: int) -> str:
    """CTE ``name(w)``: the solution of the augmented ``matrix(m)`` of ``size`` rows, a recursive
    elimination without pivoting (the matrix is positive definite)."""
    p = "m[k + 1][k + 1]"
    return f"""
{name}_e(k, m) AS (
  SELECT 0, m FROM {matrix}
  UNION ALL
  SELECT k + 1, list_transform(range(1, {size + 1}), lambda i: list_transform(range(1, {size + 2}), lambda j:
           CASE WHEN i = k + 1 THEN m[i][j] / {p} ELSE m[i][j] - m[i][k + 1] * m[k + 1][j] / {p} END))
  FROM {name}_e WHERE k < {size}),
{name} AS MATERIALIZED (SELECT list_transform(range(1, {size + 1}), lambda i: m[i][{size + 1}]) AS w FROM {name}_e WHERE k = {size})"""


def scaled_cte(name: str, source: str, feats: list[str], y: str) -> str:
    """CTEs ``name_s`` (means and deviations) and ``name`` (list z of scaled features, y)."""
    return f"""
{name}_s AS MATERIALIZED (SELECT """ + ", ".join(
        f"AVG({f}) AS m{i}, CASE WHEN STDDEV_POP({f}) > 0 THEN STDDEV_POP({f}) ELSE 1.0 END AS s{i}" for i, f in enumerate(feats)) + f"""
  FROM {source}),
{name} AS MATERIALIZED (SELECT [""" + ", ".join(f"({f} - m{i}) / s{i}" for i, f in enumerate(feats)) + f"""] AS z, CAST({y} AS DOUBLE) AS y
  FROM {source}, {name}_s)"""


def ridge_cte(name: str, source: str, feats: list[str], y: str, alpha: float) -> str:
    """CTE ``name(w, b)``: ridge coefficients of the raw features and the intercept (normal equations)."""
    p = len(feats)
    rows = ", ".join("[" + ", ".join([f"SUM(z[{i}] * z[{j}])" + (f" + {alpha}" if i == j else "") for j in range(1, p + 1)]
                                     + [f"SUM(z[{i}] * (y - ym))"]) + "]" for i in range(1, p + 1))
    return scaled_cte(f"{name}_z", source, feats, y) + f""",
{name}_g AS MATERIALIZED (SELECT [{rows}] AS m FROM {name}_z, (SELECT AVG(y) AS ym FROM {name}_z)),""" + solve_cte(f"{name}_w", f"{name}_g", p) + f""",
{name} AS MATERIALIZED (SELECT [""" + ", ".join(f"w[{i + 1}] / s{i}" for i in range(p)) + """] AS w,
  (SELECT AVG(y) FROM """ + f"{name}_z) - (" + " + ".join(f"w[{i + 1}] / s{i} * m{i}" for i in range(p)) + f") AS b, w AS w_scaled FROM {name}_w, {name}_z_s)"


def logit_cte(name: str, source: str, feats: list[str], y: str, C: float, steps: int = 10) -> str:
    """CTE ``name(w, b)``: balanced L2 logistic regression by ``steps`` Newton steps from zero."""
    p = len(feats) + 1
    out = scaled_cte(f"{name}_z", source, feats, y) + f""",
{name}_d AS MATERIALIZED (SELECT list_prepend(1.0, z) AS z, y,
  CASE WHEN y = 1 THEN COUNT(*) OVER () / (2.0 * SUM(y) OVER ()) ELSE COUNT(*) OVER () / (2.0 * (COUNT(*) OVER () - SUM(y) OVER ())) END AS wt
  FROM {name}_z),
{name}_w0 AS (SELECT list_transform(range(1, {p + 1}), lambda i: CAST(0.0 AS DOUBLE)) AS w)"""
    for t in range(steps):
        rows = ", ".join("[" + ", ".join(
            [f"SUM(wt * p * (1 - p) * z[{i}] * z[{j}])" + (f" + {1 / C}" if i == j and i > 1 else "") for j in range(1, p + 1)]
            + [f"-SUM(wt * (p - y) * z[{i}])" + (f" - {1 / C} * ANY_VALUE(w)[{i}]" if i > 1 else "")]) + "]" for i in range(1, p + 1))
        out += f""",
{name}_h{t} AS MATERIALIZED (SELECT [{rows}] AS m
  FROM (SELECT z, y, wt, w, 1 / (1 + exp(-list_dot_product(z, w))) AS p FROM {name}_d, {name}_w{t})),""" + solve_cte(f"{name}_x{t}", f"{name}_h{t}", p) + f""",
{name}_w{t + 1} AS MATERIALIZED (SELECT list_transform(range(1, {p + 1}), lambda i: a.w[i] + b.w[i]) AS w FROM {name}_w{t} a, {name}_x{t} b)"""
    return out + f""",
{name} AS MATERIALIZED (SELECT [""" + ", ".join(f"w[{i + 2}] / s{i}" for i in range(p - 1)) + "] AS w, w[1] - (" + \
        " + ".join(f"w[{i + 2}] / s{i} * m{i}" for i in range(p - 1)) + f") AS b FROM {name}_w{steps}, {name}_z_s)"


def train_cte(feats: list[str]) -> tuple[str, list[str]]:
    """CTE ``train``: the features as doubles, missing ones 0, ``members`` and ``losing`` (the unit lost
    members); and the features' names there (``unit`` keeps its type, so it has another)."""
    names = [f if f != "unit" else "unit_f" for f in feats]
    cols = ", ".join(f"COALESCE(CAST({f} AS DOUBLE), 0.0) AS {n}" for f, n in zip(feats, names))
    return f"""
train AS MATERIALIZED (SELECT unit, period, CAST(members AS DOUBLE) AS members, CAST(leak_rate > 0 AS INTEGER) AS losing, {cols} FROM features)""", names
