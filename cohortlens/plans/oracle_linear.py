"""DuckDB statements of the closed-form model queries. Least squares: the cross products of centred columns of unit length are swept one
pivot after the other by a recursive query, which leaves coefficients, inverse and residual sum at once. Columns of which
the pivots before leave nothing are passed over (aliased). Apart from the Spark side, which factors the rows themselves.
Principal components: the covariance is squared until it is the projector on its first component, whose diagonal holds the
squared loadings; that component is taken away, and so on.
"""

from __future__ import annotations

from .oracle import CLEAN, COMP_COLS, HC_COLS, SPEND_CATEGORIES, _class, _players, _wide_ctes, oracle
from .oracle_views import with_views

BASE = ["submissions", "sessions", "avg_rating_received", "united_states", "facebook_connected", "paid_source", "returner"]
SHARES = [f"Spend_Distr_{c}" for c in SPEND_CATEGORIES]
SQUARES = [f"{c}Sqd" for c in ("submissions", "sessions", "avg_rating_received")]
PRODUCTS = {"fb_x_sessions": ("facebook_connected", "sessions"), "fb_x_paid_source": ("facebook_connected", "paid_source"),
            "fb_x_united_states": ("facebook_connected", "united_states")}
COLUMNS = [*BASE, *SHARES, *SQUARES, *PRODUCTS]
RAW, LOG = len(COLUMNS) + 2, len(COLUMNS) + 3  # places of the responses; 1 is the intercept

FULL = BASE + SHARES
REFINED = [c for c in FULL if c not in [f"Spend_Distr_{x}" for x in ("LARGE", "MEDIUM", "PROMO", "SMALL")]] + SQUARES + [
    "fb_x_sessions", "fb_x_united_states"]


def _place(c: str) -> int:
    return COLUMNS.index(c) + 2


def _round(x: str, digits: int = 6) -> str:
    return f"floor(({x}) * {10 ** digits} + 0.5) / {10 ** digits}"


def _swept(specs: dict[str, list[str]], body: str, splits: bool = False) -> str:
    """``body`` after the CTEs ``frame`` (players), ``unit`` (place, mean, size), ``z`` (values less mean, by size) and
    ``done`` (model, fold, m: swept matrix, used: pivots that were swept). ``splits``: one matrix per training split."""
    shares = ",\n         ".join(f"coalesce(max(CASE WHEN sp.category_name = '{c}' THEN sp.pct_spend END), 0) AS Spend_Distr_{c}"
                                for c in SPEND_CATEGORIES)
    products = ", ".join(f"{a} * {b} AS {name}" for name, (a, b) in PRODUCTS.items())
    values = ", ".join(f"CAST({c} AS DOUBLE)" for c in ["1", *COLUMNS, "d365_RPI", "ln(d365_RPI)"])
    models = ",\n    ".join(f"('{name}', {[1, *map(_place, cols)]})" for name, cols in specs.items())
    fold = _class("player_id", 123, 10) if splits else "0"
    train = ("SELECT f.fold, a.i, a.j, a.v - f.v AS v FROM whole a JOIN cross_products f ON a.i = f.i AND a.j = f.j" if splits
             else "SELECT 0 AS fold, i, j, v FROM whole")
    sql = _players(CLEAN + f""",
shares AS (
  SELECT c.player_id, {shares}
  FROM clean c LEFT JOIN f_spend sp ON sp.player_id = c.player_id GROUP BY c.player_id
),
frame AS (
  SELECT *, pow(submissions, 2) AS submissionsSqd, pow(sessions, 2) AS sessionsSqd,
         pow(avg_rating_received, 2) AS avg_rating_receivedSqd, {products}, CAST({fold} AS INT) AS fold
  FROM clean JOIN shares USING (player_id)
),
entry AS (
  SELECT player_id, fold, unnest(range(1, {LOG + 1})) AS i, unnest([{values}]) AS v FROM frame
),
level AS (
  SELECT i, count(*) AS n, CASE WHEN i = 1 THEN 0 ELSE avg(v) END AS mean FROM entry GROUP BY i
),
unit AS (
  SELECT i, any_value(n) AS n, any_value(mean) AS mean, sqrt(sum((v - mean) * (v - mean))) AS size
  FROM entry JOIN level USING (i) GROUP BY i
),
z AS (
  SELECT player_id, fold, i, CASE WHEN size <= 1e-12 * abs(mean) * sqrt(n) OR size = 0 THEN 0 ELSE (v - mean) / size END AS v
  FROM entry JOIN unit USING (i)
),
cross_products AS (
  SELECT a.fold, a.i, b.i AS j, sum(a.v * b.v) AS v FROM z a JOIN z b ON a.player_id = b.player_id GROUP BY ALL
),
whole AS (SELECT i, j, sum(v) AS v FROM cross_products GROUP BY ALL),
train AS ({train}),
matrix AS (
  SELECT fold, list(r ORDER BY i) AS m FROM (SELECT fold, i, list(v ORDER BY j) AS r FROM train GROUP BY fold, i) GROUP BY fold
),
model(model, pivots) AS (
  VALUES {models}
),
sweep AS (
  SELECT model, fold, pivots, 1 AS k, m, CAST([] AS BIGINT[]) AS used FROM matrix CROSS JOIN model
  UNION ALL
  SELECT model, fold, pivots, k + 1,
         CASE WHEN m[p][p] <= 1e-10 THEN m ELSE
           list_transform(m, lambda r, i: list_transform(r, lambda v, j:
             CASE WHEN i = p AND j = p THEN 1 / v WHEN i = p THEN v / m[p][p] WHEN j = p THEN -v / m[p][p]
                  ELSE v - r[p] * m[p][j] / m[p][p] END)) END,
         CASE WHEN m[p][p] <= 1e-10 THEN used ELSE list_append(used, p) END
  FROM (SELECT *, CAST(pivots[k] AS BIGINT) AS p FROM sweep WHERE k <= len(pivots))
),
done AS (SELECT model, fold, m, used FROM sweep WHERE k > len(pivots))
{body}""", ["f_spend"])
    return sql.replace("WITH ", "WITH RECURSIVE ", 1)


@oracle("linear_fit")
def _linear_fit():
    fits = {"model_full": (FULL, RAW), "model_no_spend_distribution": (BASE, RAW), "model_full_log": (FULL, LOG),
            "model_no_spend_distribution_log": (BASE, LOG)}
    response = "CASE " + " ".join(f"WHEN model = '{name}' THEN {y}" for name, (_, y) in fits.items()) + " END"
    return _swept({name: cols for name, (cols, _) in fits.items()}, f""",
fit AS (
  SELECT model, y, m[y][y] AS part, m[y][y] * size * size AS rss, n, len(used) - 1 AS p
  FROM (SELECT *, {response} AS y FROM done) JOIN unit ON unit.i = y
)
SELECT model, CASE y WHEN {RAW} THEN 'd365_RPI' ELSE 'log(d365_RPI)' END AS response, {_round('1 - part')} AS r2,
       {_round('1 - part * (n - 1) / (n - p - 1)')} AS adj_r2, {_round('n * (ln(2 * pi() * rss / n) + 1) + 2 * (p + 2)', 4)} AS aic,
       CAST(n AS INT) AS n, CAST(p AS INT) AS p
FROM fit""")


NAMES = "(VALUES " + ", ".join(f"({_place(c)}, '{c}')" for c in COLUMNS) + ") name(i, term)"
ESTIMATES = f""",
estimate AS (
  SELECT name.i, name.term, m[name.i][{LOG}] * y.size / u.size AS b, y.n - len(used) AS df,
         sqrt(m[{LOG}][{LOG}] / (y.n - len(used)) * m[name.i][name.i]) * y.size / u.size AS se
  FROM (SELECT m, used, unnest(used) AS i FROM done) d JOIN {NAMES} ON name.i = d.i JOIN unit u ON u.i = d.i JOIN unit y ON y.i = {LOG}
)"""


@oracle("vif")
def _vif():
    return _swept({"full": FULL}, f"""
SELECT name.term AS variable, {_round('m[name.i][name.i]', 4)} AS vif
FROM (SELECT m, unnest(used) AS i FROM done) d JOIN {NAMES} ON name.i = d.i""")


@oracle("coefficients")
def _coefficients():
    """The p-value is one less twice the density's integral from 0 to |t|, by Simpson's rule."""
    return _swept({"refined": REFINED}, ESTIMATES + f""",
point AS (
  SELECT i, b, df, least(abs(b / se), 40) AS t, unnest(range(0, 4001)) AS s FROM estimate
),
tail AS (
  SELECT i, 1 - 2 * any_value(exp(lgamma((df + 1) / 2.0) - lgamma(df / 2.0)) / sqrt(df * pi()) * t / 12000)
            * sum((CASE WHEN s IN (0, 4000) THEN 1 WHEN s % 2 = 1 THEN 4 ELSE 2 END)
                  * pow(1 + (t * s / 4000) * (t * s / 4000) / df, -(df + 1) / 2.0)) AS p
  FROM point GROUP BY i
)
SELECT term, {_round('b')} AS estimate, {_round("CASE WHEN contains(term, 'Distr') THEN exp(b) - 1 ELSE (exp(b) - 1) * 100 END")}
       AS transformed_estimate, {_round('se')} AS std_error, {_round('b / se')} AS statistic, {_round('p')} AS p_value
FROM estimate JOIN tail USING (i)""")


@oracle("effect_size")
def _effect_size():
    return _swept({"refined": REFINED}, ESTIMATES + f"""
SELECT v.variable, CAST(0 AS DOUBLE) AS "from", CAST(1 AS DOUBLE) AS "to", {_round('coalesce(b, 0)')} AS slope,
       {_round('(exp(coalesce(b, 0)) - 1) * 100')} AS pct_change
FROM (VALUES ('sessions'), ('submissions'), ('facebook_connected'), ('paid_source')) v(variable)
LEFT JOIN estimate ON estimate.term = v.variable""")


@oracle("predict_backtransformed")
def _predict():
    return _swept({"refined": REFINED}, f""",
line AS (
  SELECT z.player_id, sum(z.v * d.b) AS at FROM z JOIN (SELECT i, m[i][{LOG}] AS b FROM (SELECT m, unnest(used) AS i FROM done)) d
  ON d.i = z.i GROUP BY z.player_id
)
SELECT player_id, d365_RPI, {_round('exp(line.at * y.size + y.mean)', 4)} AS predicted_d365_rpi
FROM frame JOIN line USING (player_id) JOIN unit y ON y.i = {LOG}""")


@oracle("linear_cv")
def _linear_cv():
    models = {"model_full": FULL, "model_quadratic": FULL + SQUARES, "model_interaction": FULL + list(PRODUCTS),
              "model_combo": FULL + SQUARES + list(PRODUCTS), "model_refined": REFINED}
    return _swept(models, f""",
miss AS (
  SELECT d.model, z.fold, z.player_id, sum(z.v * d.b) - max(CASE WHEN z.i = {LOG} THEN z.v END) AS e
  FROM z JOIN (SELECT model, fold, i, CASE WHEN i = {LOG} THEN 0 ELSE m[i][{LOG}] END AS b
               FROM (SELECT model, fold, m, unnest(list_append(used, {LOG})) AS i FROM done)) d ON d.i = z.i AND d.fold = z.fold
  GROUP BY d.model, z.fold, z.player_id
),
part AS (
  SELECT model, fold, sqrt(avg(e * e)) * any_value(y.size) AS rmse FROM miss JOIN unit y ON y.i = {LOG} GROUP BY model, fold
)
SELECT model, {_round('avg(rmse)')} AS rmse FROM part GROUP BY model""", splits=True)


CLUSTER_INPUTS = ["region_USA_Canada", "tenure_days", "avg_daily_sessions", "veteran", "ltv_7d", *HC_COLS, *COMP_COLS]


@oracle("pca_profile")
def _pca_profile():
    names = ", ".join(f"'{c}'" for c in CLUSTER_INPUTS)
    values = ", ".join(f"CAST({c} AS DOUBLE)" for c in ["region = 'USA_Canada'", *CLUSTER_INPUTS[1:]])
    sql = with_views(["f_userbase"], _wide_ctes() + f""",
entry AS (
  SELECT s, unnest(range(1, {len(CLUSTER_INPUTS) + 1})) AS i, unnest([{names}]) AS variable, unnest([{values}]) AS v FROM wide
),
bound AS (
  SELECT i, any_value(variable) AS variable, min(v) AS lo, max(v) AS hi, avg(v) AS mean FROM entry GROUP BY i HAVING min(v) < max(v)
),
place AS (SELECT *, row_number() OVER (ORDER BY i) AS k FROM bound),
x AS (SELECT s, k, (v - mean) / (hi - lo) AS v FROM entry JOIN place USING (i)),
pair AS (SELECT a.k AS i, b.k AS j, sum(a.v * b.v) / (count(*) - 1) AS v FROM x a JOIN x b ON a.s = b.s GROUP BY a.k, b.k),
covariance AS (SELECT list(r ORDER BY i) AS a FROM (SELECT i, list(v ORDER BY j) AS r FROM pair GROUP BY i)),
power(component, t, a, m) AS (
  SELECT 1, 0, a, a FROM covariance
  UNION ALL
  SELECT CASE WHEN t = 60 THEN component + 1 ELSE component END, CASE WHEN t = 60 THEN 0 ELSE t + 1 END, rest,
         CASE WHEN t = 60 THEN rest ELSE list_transform(square, lambda r: list_transform(r, lambda v: v / trace)) END
  FROM (
    SELECT *, list_sum(list_transform(square, lambda r, i: r[i])) AS trace,
           CASE WHEN t = 60 THEN list_transform(a, lambda r, i: list_transform(r, lambda v, j: v - variance * m[i][j])) ELSE a END AS rest
    FROM (SELECT *, list_transform(m, lambda r: list_transform(m, lambda c: list_dot_product(r, c))) AS square,
                 list_sum(list_transform(a, lambda r, i: list_dot_product(r, m[i]))) AS variance FROM power)
  ) WHERE component <= 4
)
SELECT CAST(component AS INT) AS component, variable, {_round('100 * m[k][k]')} AS contribution,
       {_round('list_sum(list_transform(power.a, lambda r, i: list_dot_product(r, m[i]))) / list_sum(list_transform(covariance.a, lambda r, i: r[i]))')}
       AS explained_variance
FROM power CROSS JOIN covariance CROSS JOIN place WHERE t = 60 AND component <= 4""")
    return sql.replace("WITH ", "WITH RECURSIVE ", 1)
