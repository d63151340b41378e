"""DuckDB oracle SQL for the registered queries.

Each oracle is ``WITH <panel CTEs> <operator SQL>``; the panel CTEs rebuild
the review panel from the pre-registered warehouse views (region nation
supplier lineitem) independently of the Spark code.
Literals are written as doubles (``0.3e0``) so that arithmetic is IEEE in
both engines; rnd(x,k) = floor(x*10^k + 0.5)/10^k.
"""

from __future__ import annotations


def rnd(x: str, k: int) -> str:
    s = f"{10 ** k}e0"
    return f"(sign({x}) * floor(abs({x}) * {s} + 0.5e0) / {s})"


def clip(x: str, lo: str, hi: str) -> str:
    return f"least(greatest({x}, {lo}), {hi})"


_KPI = ("(0.30e0 * goal_achievement_pct + 0.20e0 * manager_rating * 20 + 0.15e0 * peer_score * 20"
        " + 0.15e0 * attendance_rate * 100 + 0.10e0 * least(training_hours / 30, 1.0e0) * 100"
        " + 0.05e0 * least(projects_completed / 6, 1.0e0) * 100"
        " + 0.05e0 * (1 - overtime_hours / 50) * 100)")

PANEL_CTES = f"""
agg AS (
  SELECT l_suppkey AS sk,
         CAST(year(l_shipdate) AS INTEGER) AS review_year,
         CAST(quarter(l_shipdate) AS INTEGER) AS review_quarter,
         count(*) AS n,
         CAST(sum(l_quantity) AS BIGINT) AS qty,
         count(*) FILTER (WHERE l_returnflag = 'R') AS r,
         count(*) FILTER (WHERE l_linestatus = 'F') AS f,
         sum(CAST(floor(l_tax * 100 + 0.5e0) AS INTEGER)) AS tx,
         sum(CAST(floor(l_discount * 100 + 0.5e0) AS INTEGER)) AS ds
  FROM lineitem WHERE l_suppkey IS NOT NULL AND l_shipdate IS NOT NULL
  GROUP BY ALL
),
dim AS (
  SELECT s_suppkey AS sk,
         'EMP' || lpad(CAST(s_suppkey AS VARCHAR), CAST(greatest(4, length(CAST(s_suppkey AS VARCHAR))) AS INTEGER), '0') AS employee_id,
         r_name AS department,
         (['High School', 'Bachelor''s', 'Master''s', 'PhD'])[CAST(s_suppkey % 4 AS INTEGER) + 1] AS education,
         n_name AS role,
         CAST(22 + s_suppkey % 36 AS INTEGER) AS age,
         CAST({clip("s_suppkey % 36 + s_suppkey % 6 - 2", "0", "35")} AS INTEGER) AS experience_years,
         CAST(floor(30000 + 10 * greatest(s_acctbal, 0.0e0)) AS INTEGER) AS salary,
         CAST(DATE '1995-01-01' - CAST(30 * (s_suppkey % 36) AS INTEGER) AS DATE) AS join_date
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
),
base AS (
  SELECT a.sk, employee_id, department, education, role, age, experience_years, salary, join_date,
         review_year, review_quarter,
         CAST(review_year AS VARCHAR) || '-Q' || CAST(review_quarter AS VARCHAR) AS quarter_label,
         make_date(review_year, (review_quarter - 1) * 3 + 1, 1) AS review_date,
         {rnd("CAST(qty AS DOUBLE) / CAST(n AS DOUBLE) - 10", 1)} AS training_hours,
         {rnd("1 - 0.4e0 * r / CAST(n AS DOUBLE)", 3)} AS attendance_rate,
         {rnd("6 * tx / CAST(n AS DOUBLE)", 1)} AS overtime_hours,
         CAST(floor(CAST(n AS DOUBLE) / 5) AS INTEGER) AS projects_completed,
         {rnd(clip("3 + 8 * (f / CAST(n AS DOUBLE) - 0.5e0)", "1.0e0", "5.0e0"), 2)} AS manager_rating,
         {rnd(clip("0.6e0 * ds / CAST(n AS DOUBLE)", "1.0e0", "5.0e0"), 2)} AS peer_score,
         {rnd(clip("CAST(qty AS DOUBLE) / 7", "10.0e0", "100.0e0"), 1)} AS goal_achievement_pct,
         (31 * a.sk + review_year * 4 + review_quarter) % 33 AS _h,
         review_year * 4 + review_quarter AS _t
  FROM agg a JOIN dim d ON a.sk = d.sk
),
scored AS (
  SELECT *, {rnd(clip(_KPI, "10.0e0", "100.0e0"), 2)} AS performance_score FROM base
),
full_panel AS (
  SELECT sk, _t, employee_id, department, education, role, age, experience_years, salary, join_date,
         review_year, review_quarter, quarter_label, review_date,
         CASE WHEN _h = 0 THEN NULL ELSE training_hours END AS training_hours,
         attendance_rate,
         CASE WHEN _h = 11 THEN NULL ELSE overtime_hours END AS overtime_hours,
         projects_completed, manager_rating,
         CASE WHEN _h = 17 THEN NULL ELSE peer_score END AS peer_score,
         CASE WHEN _h = 23 THEN NULL ELSE goal_achievement_pct END AS goal_achievement_pct,
         performance_score,
         CASE WHEN performance_score >= 75 THEN 'High' WHEN performance_score >= 50 THEN 'Medium'
              WHEN performance_score IS NOT NULL THEN 'Low' END AS performance_band
  FROM scored
),
panel AS (
  SELECT * EXCLUDE (sk, _t) FROM full_panel
  UNION ALL
  SELECT * EXCLUDE (sk, _t) FROM full_panel WHERE (7 * sk + _t) % 200 = 0
)"""


def with_panel(sql: str, extra_ctes: str = "") -> str:
    """Prefix an operator query with the panel CTEs (plus optional more CTEs)."""
    more = f",\n{extra_ctes}" if extra_ctes else ""
    return f"WITH {PANEL_CTES}{more}\n{sql}"


# ---------------------------------------------------------------------------
# operator SQL (keys match panelsight.plans.queries.REGISTRY)
# ---------------------------------------------------------------------------
PANEL_COLS = ("employee_id, department, education, role, age, experience_years, salary, join_date, "
              "review_year, review_quarter, quarter_label, review_date, training_hours, attendance_rate, "
              "overtime_hours, projects_completed, manager_rating, peer_score, goal_achievement_pct, "
              "performance_score, performance_band")

DEDUP = ("dedup AS (SELECT * FROM panel QUALIFY row_number() OVER "
         "(PARTITION BY employee_id, review_year, review_quarter) = 1)")
CLEAN = DEDUP + ",\nclean AS (SELECT * FROM dedup WHERE performance_band IS NOT NULL)"

ORACLES: dict[str, str] = {}

ORACLES["review_panel"] = with_panel("SELECT * FROM panel")
_NUMBER, _QUARTER = "CAST(substr(employee_id, 4) AS BIGINT)", "(review_year * 4 + review_quarter)"
_AGAIN = f"((7 * {_NUMBER} + {_QUARTER}) % 5 = 0)"
FEED = DEDUP + f""",
feed AS (SELECT dedup.* REPLACE (training_hours + i - 1 AS training_hours,
           CASE WHEN NOT ({_AGAIN} AND {_NUMBER} % 2 = 0 AND i = 1) THEN performance_band END AS performance_band), CAST(i AS INTEGER) AS ingest
         FROM dedup, range(1, 4) r(i) WHERE i = 1 OR {_AGAIN}),
firsts AS (SELECT * FROM feed QUALIFY row_number() OVER (PARTITION BY employee_id, review_year, review_quarter ORDER BY ingest) = 1)"""
ORACLES["dedup_reviews"] = with_panel("SELECT * FROM firsts", FEED)
ORACLES["clean_feed"] = with_panel("SELECT * FROM firsts WHERE performance_band IS NOT NULL", FEED)
ORACLES["clean_panel"] = with_panel("SELECT * FROM clean", CLEAN)
ORACLES["dept_band_pct"] = with_panel(f"""
SELECT department,
  {rnd("count_if(performance_band = 'High') * 100.0e0 / count(*)", 6)} AS high_pct,
  {rnd("count_if(performance_band = 'Medium') * 100.0e0 / count(*)", 6)} AS medium_pct,
  {rnd("count_if(performance_band = 'Low') * 100.0e0 / count(*)", 6)} AS low_pct,
  CAST(count(*) AS BIGINT) AS n
FROM panel WHERE department IS NOT NULL AND performance_band IS NOT NULL
GROUP BY department""")

# --- shared CTE fragments -------------------------------------------------------
QK = ("CAST(split_part(quarter_label, '-Q', 1) AS INTEGER) * 10 "
      "+ CAST(split_part(quarter_label, '-Q', 2) AS INTEGER)")
SPLIT = CLEAN + f""",
sp AS (SELECT *, CASE WHEN {QK} < 20001 THEN 'train' ELSE 'test' END AS split FROM clean),
train AS (SELECT * EXCLUDE (split) FROM sp WHERE split = 'train'),
test AS (SELECT * EXCLUDE (split) FROM sp WHERE split = 'test')"""
TARGET = ("CASE performance_band WHEN 'Low' THEN 0 WHEN 'Medium' THEN 1 "
          "WHEN 'High' THEN 2 END")
PSEUDO = CLEAN + f""",
ps AS (SELECT *, CASE WHEN goal_achievement_pct >= 85 THEN 2 WHEN goal_achievement_pct < 50 THEN 0
                      ELSE 1 END AS prediction, {TARGET} AS label FROM clean)"""
TIER = ("CASE WHEN experience_years > -1 AND experience_years <= 3 THEN 'Junior (0–3 yrs)' "
        "WHEN experience_years > 3 AND experience_years <= 8 THEN 'Mid (4–8 yrs)' "
        "WHEN experience_years > 8 AND experience_years <= 100 THEN 'Senior (9+ yrs)' END")
IMPUTE = ["training_hours", "overtime_hours", "peer_score", "goal_achievement_pct"]
NUMERIC = ["age", "experience_years", "salary", "training_hours", "attendance_rate",
           "overtime_hours", "projects_completed", "manager_rating", "peer_score",
           "goal_achievement_pct"]
CATS = ["department", "education", "role"]
FEATURES = NUMERIC + [f"{c}_enc" for c in CATS]
COERCE = NUMERIC + ["performance_score"]


def union_all(parts):
    return "\nUNION ALL\n".join(parts)


# --- scalar ---------------------------------------------------------------------
ORACLES["kpi_score"] = with_panel(
    "SELECT employee_id, quarter_label, CASE WHEN goal_achievement_pct IS NULL OR manager_rating IS NULL "
    "OR peer_score IS NULL OR attendance_rate IS NULL OR training_hours IS NULL OR projects_completed IS NULL "
    "OR overtime_hours IS NULL THEN NULL "
    f"ELSE {rnd(clip(_KPI, '10.0e0', '100.0e0'), 2)} END AS kpi FROM clean", CLEAN)
ORACLES["performance_band"] = with_panel(
    "SELECT employee_id, quarter_label, performance_score, CASE WHEN performance_score >= 75 THEN 'High' "
    "WHEN performance_score >= 50 THEN 'Medium' WHEN performance_score IS NOT NULL THEN 'Low' END AS band "
    "FROM clean", CLEAN)
ORACLES["quarter_start"] = with_panel(
    "SELECT DISTINCT review_year, review_quarter, make_date(review_year, (review_quarter - 1) * 3 + 1, 1) "
    "AS quarter_start FROM panel")
ORACLES["quarter_label"] = with_panel(
    "SELECT DISTINCT review_year, review_quarter, CAST(review_year AS VARCHAR) || '-Q' || "
    "CAST(review_quarter AS VARCHAR) AS label FROM panel")
ORACLES["quarter_key"] = with_panel(
    f"SELECT DISTINCT quarter_label, CAST({QK} AS INTEGER) AS quarter_key FROM panel")
ORACLES["employee_code"] = ("SELECT s_suppkey, 'EMP' || lpad(CAST(s_suppkey AS VARCHAR), CAST(greatest(4, "
                            "length(CAST(s_suppkey AS VARCHAR))) AS INTEGER), '0') AS employee_id FROM supplier")
ORACLES["tenure_offset_date"] = (
    "SELECT s_suppkey, CAST(DATE '1995-01-01' - CAST(30 * (s_suppkey % 36) AS INTEGER) AS DATE) AS join_date, "
    "strftime(CAST(DATE '1995-01-01' - CAST(30 * (s_suppkey % 36) AS INTEGER) AS DATE), '%Y-%m-%d') "
    "AS join_date_text FROM supplier")
ORACLES["numeric_coerce"] = with_panel(
    "SELECT employee_id, quarter_label, " + ", ".join(
        f"CASE WHEN employee_id NOT LIKE '%3' AND employee_id NOT LIKE '%5' THEN CAST({c} AS DOUBLE) END AS {c}"
        if c == "training_hours" else f"CAST({c} AS DOUBLE) AS {c}" for c in COERCE) + " FROM panel")
ORACLES["drop_missing_target"] = with_panel("SELECT * FROM feed WHERE performance_band IS NOT NULL", FEED)
ORACLES["encode_target"] = with_panel(
    f"SELECT employee_id, quarter_label, performance_band, {TARGET} AS target FROM panel")
ORACLES["decode_band"] = with_panel(
    "SELECT employee_id, quarter_label, prediction, (['Low', 'Medium', 'High'])[prediction + 1] AS band "
    "FROM ps", PSEUDO)
ORACLES["experience_tier"] = with_panel(
    f"SELECT employee_id, quarter_label, experience_years, {TIER} AS experience_tier FROM clean", CLEAN)
ORACLES["quality_profile"] = with_panel(
    "SELECT column_name, CAST(null_count AS BIGINT) AS null_count, null_count / CAST(n AS DOUBLE) AS null_rate, "
    "CAST(rep AS BIGINT) AS repeated_keys FROM ("
    + union_all([f"SELECT '{c}' AS column_name, count_if({c} IS NULL) AS null_count FROM panel" for c in IMPUTE])
    + ") nc, (SELECT count(*) AS n, count(*) - count(DISTINCT (employee_id, review_year, review_quarter)) AS rep "
      "FROM panel) k")
ORACLES["append_rows"] = with_panel("SELECT * FROM panel")

# --- preparation ------------------------------------------------------------------
ORACLES["time_split"] = with_panel("SELECT employee_id, quarter_label, split FROM sp", SPLIT)
ORACLES["distinct_quarters"] = with_panel("SELECT DISTINCT split, quarter_label FROM sp", SPLIT)
ORACLES["fit_median_imputer"] = with_panel(
    union_all([f"SELECT '{c}' AS column_name, median({c}) AS median FROM train" for c in IMPUTE]), SPLIT)
MEDIANS = "med AS (SELECT " + ", ".join(f"median({c}) AS m_{c}" for c in IMPUTE) + " FROM train)"
ORACLES["apply_median_imputer"] = with_panel(
    "SELECT employee_id, quarter_label, " + ", ".join(f"coalesce({c}, m_{c}) AS {c}" for c in IMPUTE)
    + " FROM sp, med", SPLIT + ",\n" + MEDIANS)


def encoder_cte(src: str, name: str = "enc") -> str:
    parts = union_all([f"SELECT DISTINCT '{c}' AS column_name, coalesce(CAST({c} AS VARCHAR), 'nan') AS value "
                       f"FROM {src}" for c in CATS])
    return (f"{name} AS (SELECT column_name, value, CAST(dense_rank() OVER (PARTITION BY column_name "
            f"ORDER BY value) - 1 AS INTEGER) AS code FROM ({parts}) u)")


ORACLES["fit_label_encoder"] = with_panel("SELECT * FROM enc", SPLIT + ",\n" + encoder_cte("train"))


def encoded_select(src: str, zero: bool = False) -> str:
    cols, joins = [], []
    for i, c in enumerate(CATS):
        a = f"e{i}"
        cols.append(f"coalesce({a}.code, 0) AS {c}_enc" if zero else f"{a}.code AS {c}_enc")
        kind = "LEFT JOIN" if zero else "JOIN"
        joins.append(f"{kind} enc {a} ON {a}.column_name = '{c}' AND {a}.value = coalesce(CAST(t.{c} AS VARCHAR), 'nan')")
    return cols, " ".join(joins)


_c, _j = encoded_select("test")
ORACLES["apply_label_encoder"] = with_panel(
    f"SELECT t.employee_id, t.quarter_label, {', '.join(_c)} FROM test t {_j}",
    SPLIT + ",\n" + encoder_cte("train"))
_c, _j = encoded_select("clean", zero=True)
ORACLES["encode_or_zero"] = with_panel(
    f"SELECT t.employee_id, t.quarter_label, {', '.join(_c)} FROM clean t {_j}",
    CLEAN + ",\nsub AS (SELECT * FROM clean WHERE experience_years < 10),\n" + encoder_cte("sub"))


def prepared_ctes() -> str:
    """train/test imputed + encoded (tr_e, te_e) and scaler stats (sc)."""
    imp = lambda src: ("SELECT * REPLACE (" + ", ".join(f"coalesce({c}, m_{c}) AS {c}" for c in IMPUTE)
                       + f") FROM {src}, med")
    c1, j1 = encoded_select("x")
    enc = lambda src: f"SELECT t.*, {', '.join(c1)} FROM {src} t {j1}"
    stats = ", ".join(f"avg(CAST({c} AS DOUBLE)) AS mean_{c}, "
                      f"CASE WHEN stddev_pop(CAST({c} AS DOUBLE)) = 0 THEN 1.0e0 ELSE stddev_pop(CAST({c} AS DOUBLE)) END AS std_{c}"
                      for c in FEATURES)
    return (SPLIT + ",\n" + MEDIANS + f",\ntr_i AS ({imp('train')}),\nte_i AS ({imp('test')}),\n"
            + encoder_cte("tr_i") + f",\ntr_e AS ({enc('tr_i')}),\nte_e AS ({enc('te_i')}),\n"
            f"sc AS (SELECT {stats} FROM tr_e)")


ORACLES["fit_standard_scaler"] = with_panel(
    union_all([f"SELECT '{c}' AS column_name, {rnd(f'mean_{c}', 6)} AS mean, {rnd(f'std_{c}', 6)} AS std FROM sc"
               for c in FEATURES]), prepared_ctes())
_scaled = ", ".join(f"{rnd(f'(CAST({c} AS DOUBLE) - mean_{c}) / std_{c}', 6)} AS {c}" for c in FEATURES)
ORACLES["apply_standard_scaler"] = with_panel(
    f"SELECT employee_id, quarter_label, {_scaled} FROM te_e, sc", prepared_ctes())
ORACLES["prep_pipeline"] = with_panel(
    f"SELECT employee_id, quarter_label, 'train' AS split, {TARGET} AS label, {_scaled} FROM tr_e, sc "
    f"UNION ALL SELECT employee_id, quarter_label, 'test' AS split, {TARGET} AS label, {_scaled} FROM te_e, sc",
    prepared_ctes())
ORACLES["class_balance"] = with_panel(
    f"SELECT {TARGET} AS target, count(*) AS n FROM train GROUP BY 1", SPLIT)
ORACLES["balanced_class_weights"] = with_panel(
    f"SELECT label, n_c, {rnd('sum(n_c) OVER () / (count(*) OVER () * n_c)', 6)} AS weight "
    f"FROM (SELECT {TARGET} AS label, count(*) AS n_c FROM train GROUP BY 1) c", SPLIT)

# --- insights ---------------------------------------------------------------------
_bands = ["High", "Medium", "Low"]
ORACLES["band_distribution"] = with_panel(
    union_all([f"SELECT '{b}' AS band, {i} AS band_order, CAST(c{i} AS BIGINT) AS n, "
               f"{rnd(f'c{i} * 100.0e0 / total', 1)} AS pct FROM c" for i, b in enumerate(_bands)]),
    "c AS (SELECT count(*) AS total, " + ", ".join(
        f"sum(CASE WHEN performance_band = '{b}' THEN 1 END) AS c{i}" for i, b in enumerate(_bands)) + " FROM panel)")
ORACLES["quarterly_trend"] = with_panel(
    f"SELECT quarter_label, {rnd('avg(performance_score)', 6)} AS mean_score, count(performance_score) AS n, "
    f"CAST({QK} AS INTEGER) AS quarter_key FROM panel WHERE quarter_label IS NOT NULL GROUP BY quarter_label")
ORACLES["dept_band_counts"] = with_panel(
    "SELECT department, performance_band, count(*) AS n FROM panel "
    "WHERE department IS NOT NULL AND performance_band IS NOT NULL GROUP BY ALL")
_means = ["training_hours", "attendance_rate", "goal_achievement_pct", "manager_rating", "peer_score",
          "overtime_hours", "experience_years"]
ORACLES["band_feature_means"] = with_panel(
    "SELECT performance_band, " + ", ".join(f"{rnd(f'avg({c})', 2)} AS mean_{c}" for c in _means)
    + " FROM panel WHERE performance_band IS NOT NULL GROUP BY performance_band")
_desc = ["age", "experience_years", "salary", "review_year", "review_quarter", "training_hours",
         "attendance_rate", "overtime_hours", "projects_completed", "manager_rating", "peer_score",
         "goal_achievement_pct", "performance_score"]
ORACLES["describe_numeric"] = with_panel(union_all([
    f"SELECT '{c}' AS column_name, count({c}) AS count, {rnd(f'avg(CAST({c} AS DOUBLE))', 2)} AS mean, "
    f"{rnd(f'stddev_samp(CAST({c} AS DOUBLE))', 2)} AS std, {rnd(f'min(CAST({c} AS DOUBLE))', 2)} AS min, "
    f"{rnd(f'quantile_cont(CAST({c} AS DOUBLE), 0.25)', 2)} AS p25, "
    f"{rnd(f'quantile_cont(CAST({c} AS DOUBLE), 0.5)', 2)} AS p50, "
    f"{rnd(f'quantile_cont(CAST({c} AS DOUBLE), 0.75)', 2)} AS p75, "
    f"{rnd(f'max(CAST({c} AS DOUBLE))', 2)} AS max FROM panel" for c in _desc]))
_panel_types = [("employee_id", "string"), ("department", "string"), ("education", "string"),
                ("role", "string"), ("age", "int"), ("experience_years", "int"), ("salary", "int"),
                ("join_date", "date"), ("review_year", "int"), ("review_quarter", "int"),
                ("quarter_label", "string"), ("review_date", "date"), ("training_hours", "double"),
                ("attendance_rate", "double"), ("overtime_hours", "double"), ("projects_completed", "int"),
                ("manager_rating", "double"), ("peer_score", "double"), ("goal_achievement_pct", "double"),
                ("performance_score", "double"), ("performance_band", "string")]
ORACLES["null_counts"] = with_panel(
    "SELECT * FROM (" + union_all([f"SELECT '{c}' AS column_name, '{t}' AS dtype, CAST(count_if({c} IS NULL) AS BIGINT) AS null_count "
                                   f"FROM panel" for c, t in _panel_types]) + ") WHERE null_count > 0")
_corr = ["training_hours", "attendance_rate", "goal_achievement_pct", "manager_rating", "peer_score",
         "overtime_hours", "experience_years", "salary", "projects_completed", "performance_score"]


def corr_sql(lower_only: bool = False) -> str:
    parts = []
    for i, a in enumerate(_corr):
        for j, b in enumerate(_corr):
            if lower_only and not i > j:
                continue
            x, y = (a, b) if i <= j else (b, a)
            r = f"corr(CAST({x} AS DOUBLE), CAST({y} AS DOUBLE))"
            parts.append(f"SELECT {i} AS i, {j} AS j, '{a}' AS feature_x, '{b}' AS feature_y, "
                         f"CASE WHEN isnan({r}) THEN NULL ELSE {rnd(r, 6)} END AS corr FROM panel")
    return with_panel(union_all(parts))


ORACLES["correlation_matrix"] = corr_sql()
ORACLES["lower_triangle"] = corr_sql(lower_only=True)
ORACLES["pair_correlation"] = with_panel(
    f"SELECT {rnd('corr(training_hours, performance_score)', 6)} AS corr, "
    "count(CASE WHEN training_hours IS NOT NULL AND performance_score IS NOT NULL THEN 1 END) AS n_pairs FROM panel")
ORACLES["paired_nonnull"] = with_panel(
    "SELECT employee_id, quarter_label, training_hours, performance_score FROM panel "
    "WHERE training_hours IS NOT NULL AND performance_score IS NOT NULL")
_regr = ("regr_slope(performance_score, training_hours) AS slope, "
         "regr_intercept(performance_score, training_hours) AS intercept, "
         "CAST(regr_count(performance_score, training_hours) AS BIGINT) AS n_pairs")
ORACLES["trend_line"] = with_panel(
    f"SELECT CASE WHEN n_pairs > 10 THEN {rnd('slope', 6)} END AS slope, "
    f"CASE WHEN n_pairs > 10 THEN {rnd('intercept', 6)} END AS intercept, n_pairs FROM (SELECT {_regr} FROM panel)")
_xv = "(lo + (hi - lo) * idx / 99)"
ORACLES["trend_line_points"] = with_panel(
    f"SELECT CAST(idx AS INTEGER) AS idx, {rnd(_xv, 6)} AS x, {rnd(f'slope * {_xv} + intercept', 6)} AS y "
    f"FROM (SELECT {_regr}, min(training_hours) AS lo, max(training_hours) AS hi FROM panel) g, range(0, 100) r(idx) "
    "WHERE n_pairs > 10")
_hist = ["training_hours", "attendance_rate", "goal_achievement_pct", "manager_rating", "peer_score",
         "overtime_hours"]
_long = union_all([f"SELECT '{c}' AS feature, performance_band AS band, CAST({c} AS DOUBLE) AS value FROM panel "
                   f"WHERE performance_band IS NOT NULL AND {c} IS NOT NULL" for c in _hist])
ORACLES["feature_histogram"] = with_panel(
    f"""SELECT g.feature, g.band, CAST(g.bin AS INTEGER) AS bin,
  {rnd('g.lo + g.bin * g.width', 6)} AS bin_start, {rnd('g.lo + (g.bin + 1) * g.width', 6)} AS bin_end,
  CAST(coalesce(c.n, 0) AS BIGINT) AS n, {rnd('coalesce(c.n, 0) / (g.n_group * g.width)', 6)} AS density
FROM (SELECT r.*, b.bin FROM rng r, range(0, 20) b(bin)) g
LEFT JOIN (SELECT l.feature, l.band, CAST(least(floor((value - lo) / width), 19) AS INTEGER) AS bin, count(*) AS n
           FROM lng l JOIN rng r ON l.feature = r.feature AND l.band = r.band GROUP BY ALL) c
  ON g.feature = c.feature AND g.band = c.band AND g.bin = c.bin""",
    f"""lng AS ({_long}),
rng AS (SELECT feature, band, count(*) AS n_group,
          CASE WHEN min(value) = max(value) THEN min(value) - 0.5e0 ELSE min(value) END AS lo,
          (CASE WHEN min(value) = max(value) THEN max(value) + 0.5e0 ELSE max(value) END
           - CASE WHEN min(value) = max(value) THEN min(value) - 0.5e0 ELSE min(value) END) / 20 AS width
        FROM lng GROUP BY ALL)""")
ORACLES["performer_shortlists"] = with_panel(
    """SELECT list_band, CAST(rank AS INTEGER) AS rank, employee_id, department, experience_years,
  goal_achievement_pct, manager_rating, score FROM (
  SELECT (['Low', 'Medium', 'High'])[prediction + 1] AS list_band, employee_id, department, experience_years,
    goal_achievement_pct, manager_rating, """ + rnd("performance_score", 6) + """ AS score,
    row_number() OVER (PARTITION BY prediction ORDER BY performance_score DESC, employee_id, review_year,
                       review_quarter) AS rank
  FROM ps WHERE prediction IN (0, 2)) WHERE rank <= 10""", PSEUDO)
ORACLES["preview"] = with_panel("SELECT * FROM panel ORDER BY employee_id, review_year, review_quarter LIMIT 5")

# --- decisions ----------------------------------------------------------------------


def decision_cte(src: str, band: str = "performance_band", drop: tuple = ()) -> str:
    """Rule columns over ``src`` (band column = prediction, confidence 1.0).
    Columns listed in ``drop`` are treated as absent (rule defaults)."""
    defaults = {"salary": "50000", "overtime_hours": "10.0e0", "training_hours": "20.0e0", "attendance_rate": "0.90e0", "goal_achievement_pct": "60.0e0",
                "manager_rating": "3.0e0", "peer_score": "3.0e0", "projects_completed": "3", "experience_years": "5"}

    def f(c):
        return defaults[c] if c in drop else c
    th, att, ot, ga = f("training_hours"), f("attendance_rate"), f("overtime_hours"), f("goal_achievement_pct")
    mr, ps, pc, ex, sal = f("manager_rating"), f("peer_score"), f("projects_completed"), f("experience_years"), f("salary")

    def t(cond):
        return f"coalesce({cond}, false)"
    low_goal, low_mgr = t(f"{ga} < 50"), t(f"{mr} < 2.5")
    high_ot, low_att = t(f"{ot} > 30"), t(f"{att} < 0.8e0")
    is_low, is_med, is_high = t(f"{band} = 'Low'"), t(f"{band} = 'Medium'"), t(f"{band} = 'High'")
    topics = (f"list_filter([CASE WHEN {t(f'{th} < 15')} THEN 'LEARN.training_hours' END, "
              f"CASE WHEN {low_goal} THEN 'LEARN.goal_achievement_pct' END, "
              f"CASE WHEN {t(f'{ps} < 2.5')} THEN 'LEARN.peer_score' END, "
              f"CASE WHEN {low_mgr} AND {t(f'{ex} < 10')} THEN 'LEARN.manager_rating' END], lambda x: x IS NOT NULL)")
    promo = f"({is_high} AND {t(f'{ga} >= 85')} AND {t(f'{mr} >= 4.0e0')} AND {t(f'{ex} >= 5')} AND {t(f'{pc} >= 4')})"
    goals = (f"list_filter([CASE WHEN {low_goal} THEN 'PLAN.goal_achievement_pct:' || "
             f"CAST(CAST(round_even(CAST({ga} AS DOUBLE), 0) AS BIGINT) AS VARCHAR) || '>=70' END, "
             f"CASE WHEN {low_mgr} THEN 'PLAN.manager_rating:' || printf('%.1f', round_even(CAST({mr} AS DOUBLE), 1)) "
             f"|| '>=3.0' END, "
             f"CASE WHEN {t(f'{pc} < 2')} THEN 'PLAN.projects_completed:' || CAST(CAST(round_even(CAST({pc} AS DOUBLE), 0) AS BIGINT) AS VARCHAR) || '>=3' END], "
             f"lambda x: x IS NOT NULL)")
    points = (f"(CASE WHEN {is_low} THEN 3 ELSE 0 END + CASE WHEN {t(f'{sal} < 40000')} THEN 2 ELSE 0 END + "
              f"CASE WHEN {low_goal} THEN 1 ELSE 0 END + CASE WHEN {low_mgr} THEN 2 ELSE 0 END + "
              f"CASE WHEN {high_ot} THEN 1 ELSE 0 END)")
    ot_msg = f"'WELLBEING.overtime_hours:' || CAST(CAST(round_even(CAST({ot} AS DOUBLE), 0) AS BIGINT) AS VARCHAR)"
    att_msg = f"'WELLBEING.attendance_pct:' || CAST(CAST(round_even(CAST({att} AS DOUBLE) * 100, 0) AS BIGINT) AS VARCHAR)"
    quick = (f"CASE WHEN {is_med} THEN CASE WHEN {t(f'{th} >= 15')} AND {t(f'{ga} >= 70')} "
             f"THEN 'GROW.stretch' "
             f"ELSE 'GROW.skills' END END")
    return f"""d1 AS (
  SELECT *, {band} AS predicted_band, round_even(1.0e0 * 100, 1) AS confidence_pct,
    {topics} AS topics, {promo} AS promotion_ready, {is_low} AS pip_required,
    CASE WHEN {is_low} THEN (CASE WHEN len({goals}) = 0 THEN ['PLAN.general']
         ELSE {goals} END) ELSE []::VARCHAR[] END AS goals,
    {points} AS retention_points, ({high_ot} OR {low_att}) AS wellbeing_flag,
    {high_ot} AS _hot, {low_att} AS _lat, {quick} AS _quick, {is_med} AS _med
  FROM {src}),
d2 AS (
  SELECT *, len(topics) > 0 AS training_needed,
    CASE WHEN retention_points >= 5 THEN 'High' WHEN retention_points >= 3 THEN 'Medium' ELSE 'Low' END AS retention_risk
  FROM d1),
d3 AS (
  SELECT *, list_filter(flatten([
      CASE WHEN promotion_ready THEN ['PROMOTION.review', 'PROMOTION.succession'] ELSE []::VARCHAR[] END,
      CASE WHEN pip_required THEN ['PLAN.meeting', 'PLAN.mentor'] ELSE []::VARCHAR[] END,
      CASE WHEN retention_risk = 'High' THEN ['RETAIN.escalate', 'RETAIN.interview']
           WHEN retention_risk = 'Medium' THEN ['RETAIN.check_in'] ELSE []::VARCHAR[] END,
      [CASE WHEN _hot THEN {ot_msg} END, CASE WHEN _lat THEN {att_msg} END, _quick]]), lambda x: x IS NOT NULL)[1:6] AS actions,
    CASE WHEN pip_required OR retention_risk = 'High' OR wellbeing_flag THEN 'Urgent'
         WHEN _med AND training_needed THEN 'Medium' ELSE 'Normal' END AS priority
  FROM d2),
dec AS (
  SELECT *, concat_ws('; ', 'priority=' || priority, 'band=' || predicted_band, 'confidence=' || CAST(confidence_pct AS VARCHAR),
    CASE WHEN training_needed THEN 'training=' || array_to_string(topics[1:2], ',') END,
    CASE WHEN promotion_ready THEN 'promotion' END, CASE WHEN pip_required THEN 'plan' END,
    'retention=' || retention_risk) AS hr_summary
  FROM d3)"""


DEC = CLEAN + ",\n" + decision_cte("clean")
ORACLES["training_needs"] = with_panel(
    "SELECT employee_id, quarter_label, training_needed, array_to_string(topics, '; ') AS training_topics FROM dec", DEC)
ORACLES["promotion_ready"] = with_panel("SELECT employee_id, quarter_label, promotion_ready FROM dec", DEC)
ORACLES["pip_plan"] = with_panel(
    "SELECT employee_id, quarter_label, pip_required, array_to_string(goals, '; ') AS pip_goals, "
    "CAST(len(goals) AS INTEGER) AS n_goals FROM dec", DEC)
ORACLES["retention_risk"] = with_panel(
    "SELECT employee_id, quarter_label, retention_points, retention_risk FROM dec", DEC)
ORACLES["wellbeing_flag"] = with_panel("SELECT employee_id, quarter_label, wellbeing_flag FROM dec", DEC)
ORACLES["medium_quick_win"] = with_panel(
    "SELECT employee_id, quarter_label, actions[len(actions)] AS quick_win FROM dec WHERE predicted_band = 'Medium'", DEC)
ORACLES["priority"] = with_panel("SELECT employee_id, quarter_label, priority FROM dec", DEC)
ORACLES["decision_summary"] = with_panel("SELECT employee_id, quarter_label, hr_summary FROM dec", DEC)
ORACLES["action_list"] = with_panel(
    "SELECT employee_id, quarter_label, array_to_string(actions, '; ') AS recommended_actions, "
    "CAST(len(actions) AS INTEGER) AS n_actions FROM dec", DEC)
ORACLES["cap_list"] = with_panel(
    "SELECT employee_id, quarter_label, array_to_string(topics[1:2], '; ') AS first_topics, "
    "CAST(len(actions[1:6]) AS INTEGER) AS n_actions FROM dec", DEC)
REPORT_SELECT = ("SELECT employee_id, quarter_label, predicted_band, confidence_pct, training_needed, "
                 "array_to_string(topics, '; ') AS training_topics, promotion_ready, pip_required, "
                 "array_to_string(goals, '; ') AS pip_goals, retention_risk, wellbeing_flag, "
                 "array_to_string(actions, '; ') AS recommended_actions, priority, hr_summary FROM dec")
ORACLES["decision_report"] = with_panel(REPORT_SELECT, DEC)
ORACLES["rule_feature_defaults"] = with_panel(
    "SELECT employee_id, quarter_label, retention_points, wellbeing_flag FROM dec",
    CLEAN + ",\n" + decision_cte("clean", drop=("salary", "overtime_hours")))
ORACLES["rule_defaults_all"] = with_panel(
    "SELECT employee_id, quarter_label, training_needed, promotion_ready, array_to_string(goals, '; ') AS pip_goals, retention_points, wellbeing_flag, "
    "array_to_string(actions, '; ') AS actions, priority FROM dec",
    CLEAN + ",\n" + decision_cte("clean", drop=("salary", "overtime_hours", "training_hours", "attendance_rate", "goal_achievement_pct", "manager_rating",
                                                "peer_score", "projects_completed", "experience_years")))
ORACLES["priority_counts"] = with_panel("SELECT priority, count(*) AS n FROM dec GROUP BY priority", DEC)
ORACLES["attach_decisions"] = with_panel(
    "SELECT employee_id, quarter_label, predicted_band, training_needed, promotion_ready FROM dec", DEC)

# --- metrics --------------------------------------------------------------------------


def metric_ctes(pred_expr: str, p: str = "", src: str = "clean") -> str:
    return f"""{p}sc AS (SELECT {TARGET} AS label, {pred_expr} AS prediction FROM {src}),
{p}cc AS (SELECT label, prediction, count(*) AS n FROM {p}sc GROUP BY ALL),
{p}pc0 AS (
  SELECT k.cls, coalesce(t.support, 0) AS support, coalesce(pr.predicted, 0) AS predicted, coalesce(tp.tp, 0) AS tp
  FROM (SELECT label AS cls FROM {p}cc UNION SELECT prediction FROM {p}cc) k
  LEFT JOIN (SELECT label AS cls, sum(n) AS support FROM {p}cc GROUP BY 1) t ON k.cls = t.cls
  LEFT JOIN (SELECT prediction AS cls, sum(n) AS predicted FROM {p}cc GROUP BY 1) pr ON k.cls = pr.cls
  LEFT JOIN (SELECT label AS cls, n AS tp FROM {p}cc WHERE label = prediction) tp ON k.cls = tp.cls),
{p}pc1 AS (SELECT *, CASE WHEN predicted > 0 THEN tp / CAST(predicted AS DOUBLE) ELSE 0.0e0 END AS precision,
              CASE WHEN support > 0 THEN tp / CAST(support AS DOUBLE) ELSE 0.0e0 END AS recall FROM {p}pc0),
{p}pc AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall)
              ELSE 0.0e0 END AS f1 FROM {p}pc1),
{p}sm AS (SELECT {rnd('sum(tp) / CAST(sum(support) AS DOUBLE)', 4)} AS accuracy, {rnd('avg(f1)', 4)} AS f1_macro,
              {rnd('sum(f1 * support) / sum(support)', 4)} AS f1_weighted, CAST(sum(support) AS BIGINT) AS n FROM {p}pc)"""


PSEUDO_PRED = "CASE WHEN goal_achievement_pct >= 85 THEN 2 WHEN goal_achievement_pct < 50 THEN 0 ELSE 1 END"
MET = CLEAN + ",\n" + metric_ctes(PSEUDO_PRED)
ORACLES["accuracy"] = with_panel("SELECT accuracy FROM sm", MET)
ORACLES["f1_macro"] = with_panel("SELECT f1_macro FROM sm", MET)
ORACLES["f1_weighted"] = with_panel("SELECT f1_weighted FROM sm", MET)
ORACLES["confusion_matrix"] = with_panel(
    "SELECT CAST(l.label AS INTEGER) AS label, CAST(p.prediction AS INTEGER) AS prediction, "
    "CAST(coalesce(cc.n, 0) AS BIGINT) AS n FROM range(0, 3) l(label) CROSS JOIN range(0, 3) p(prediction) "
    "LEFT JOIN cc ON cc.label = l.label AND cc.prediction = p.prediction", MET)
ORACLES["classification_report"] = with_panel(f"""
SELECT (['Low', 'Medium', 'High'])[cls + 1] AS row_name, CAST(cls AS INTEGER) AS row_order,
  {rnd('precision', 4)} AS precision, {rnd('recall', 4)} AS recall, {rnd('f1', 4)} AS f1,
  CAST(support AS BIGINT) AS support FROM pc
UNION ALL SELECT 'accuracy', 10, NULL, NULL, {rnd('sum(tp) / CAST(sum(support) AS DOUBLE)', 4)},
  CAST(sum(support) AS BIGINT) FROM pc
UNION ALL SELECT 'macro avg', 11, {rnd('avg(precision)', 4)}, {rnd('avg(recall)', 4)}, {rnd('avg(f1)', 4)},
  CAST(sum(support) AS BIGINT) FROM pc
UNION ALL SELECT 'weighted avg', 12, {rnd('sum(precision * support) / sum(support)', 4)},
  {rnd('sum(recall * support) / sum(support)', 4)}, {rnd('sum(f1 * support) / sum(support)', 4)},
  CAST(sum(support) AS BIGINT) FROM pc""", MET)
_pm = [("goal_85_50", 85, 50), ("goal_80_45", 80, 45), ("goal_90_55", 90, 55)]
_cmp = CLEAN + "".join(
    ",\n" + metric_ctes(f"CASE WHEN goal_achievement_pct >= {hi} THEN 2 WHEN goal_achievement_pct < {lo} THEN 0 ELSE 1 END",
                        f"m{i}_") for i, (_, hi, lo) in enumerate(_pm))
_cmp += ",\ncmp AS (" + union_all([f"SELECT '{n}' AS model, {i} AS model_order, accuracy, f1_macro, f1_weighted "
                                   f"FROM m{i}_sm" for i, (n, _, _) in enumerate(_pm)]) + ")"
ORACLES["select_best"] = with_panel(
    "SELECT * FROM cmp ORDER BY f1_macro DESC, model_order LIMIT 1", _cmp)

# --- fairness ---------------------------------------------------------------------------
GRP = PSEUDO + """,
grp AS (SELECT department AS group_name, count(*) AS n_employees,
          avg(CASE WHEN prediction = 2 THEN 1 ELSE 0 END) AS p,
          avg(CASE WHEN performance_band IS NULL THEN NULL WHEN performance_band = 'High' THEN 1 ELSE 0 END) AS a
        FROM ps WHERE department IS NOT NULL GROUP BY department),
aud AS (SELECT group_name, n_employees, """ + rnd("p * 100.0e0", 1) + """ AS predicted_high_pct,
          """ + rnd("a * 100.0e0", 1) + """ AS actual_high_pct, """ + rnd("(p - a) * 100.0e0", 1) + """ AS gap_pts
        FROM grp),
aud2 AS (SELECT *, CASE WHEN max(predicted_high_pct) OVER () > 0 THEN
          """ + rnd("predicted_high_pct / max(predicted_high_pct) OVER ()", 3) + """ END AS adverse_impact_ratio FROM aud),
aud3 AS (SELECT *, CASE WHEN adverse_impact_ratio IS NULL THEN 'NOT_ASSESSABLE' WHEN adverse_impact_ratio < 0.8e0
          THEN 'INVESTIGATE' ELSE 'OK' END AS bias_flag FROM aud2)"""
ORACLES["selection_rate"] = with_panel(
    f"SELECT {rnd('avg(CASE WHEN prediction = 2 THEN 1.0e0 ELSE 0.0e0 END)', 6)} AS selection_rate FROM ps", PSEUDO)
ORACLES["audit_by_group"] = with_panel(
    "SELECT group_name, n_employees, predicted_high_pct, actual_high_pct, gap_pts FROM aud3", GRP)
ORACLES["adverse_impact"] = with_panel("SELECT group_name, adverse_impact_ratio, bias_flag FROM aud3", GRP)
ORACLES["bias_detected"] = with_panel(
    "SELECT coalesce(bool_or(bias_flag = 'INVESTIGATE'), false) AS bias_detected FROM aud3", GRP)
ORACLES["fairness_chart_data"] = with_panel(
    "SELECT group_name, predicted_high_pct, actual_high_pct FROM aud3", GRP)
ORACLES["audit_by_experience"] = with_panel(f"""
SELECT experience_tier, count(*) AS n_employees,
  {rnd('avg(CASE WHEN prediction = 2 THEN 1 ELSE 0 END) * 100.0e0', 1)} AS predicted_high_pct,
  {rnd("avg(CASE WHEN performance_band IS NULL THEN NULL WHEN performance_band = 'High' THEN 1 ELSE 0 END) * 100.0e0", 1)} AS actual_high_pct,
  CASE experience_tier WHEN 'Junior (0–3 yrs)' THEN 0 WHEN 'Mid (4–8 yrs)' THEN 1 ELSE 2 END AS tier_order
FROM (SELECT *, {TIER} AS experience_tier FROM ps) WHERE experience_tier IS NOT NULL GROUP BY experience_tier""", PSEUDO)
ORACLES["statistical_parity"] = with_panel(f"""
SELECT group_name, {rnd('r * 100.0e0', 1)} AS high_rate_pct, {rnd('r - ref', 3)} AS spd,
  CASE WHEN r - ref IS NULL THEN 'NOT_ASSESSABLE' WHEN abs(r - ref) > 0.1e0 THEN 'REVIEW' ELSE 'OK' END AS fairness_flag
FROM (SELECT *, max(CASE WHEN group_name = 'EUROPE' THEN r END) OVER () AS ref FROM (
  SELECT department AS group_name, avg(CASE WHEN prediction = 2 THEN 1 ELSE 0 END) AS r
  FROM ps WHERE department IS NOT NULL GROUP BY department))""", PSEUDO)

# --- joins --------------------------------------------------------------------------------
ORACLES["lookup_constants"] = with_panel("SELECT * EXCLUDE (sk) FROM dim")
ORACLES["densify_panel"] = with_panel("""
SELECT e.employee_id, e.department, e.education, e.role, e.age, e.experience_years, e.salary, e.join_date,
  CAST(t // 4 AS INTEGER) AS review_year, CAST(t % 4 + 1 AS INTEGER) AS review_quarter,
  CAST(t // 4 AS VARCHAR) || '-Q' || CAST(t % 4 + 1 AS VARCHAR) AS quarter_label,
  make_date(CAST(t // 4 AS INTEGER), CAST((t % 4) * 3 + 1 AS INTEGER), 1) AS review_date,
  f.training_hours, f.attendance_rate, f.overtime_hours, f.projects_completed, f.manager_rating, f.peer_score,
  f.goal_achievement_pct, f.performance_score, f.performance_band
FROM (SELECT DISTINCT employee_id, department, education, role, age, experience_years, salary, join_date FROM thinned) e
CROSS JOIN (SELECT unnest(range(min(review_year * 4 + review_quarter - 1)::BIGINT, max(review_year * 4 + review_quarter)::BIGINT)) AS t FROM thinned) r
LEFT JOIN thinned f ON f.employee_id = e.employee_id AND f.review_year = t // 4 AND f.review_quarter = t % 4 + 1""",
    CLEAN + f", thinned AS (SELECT * FROM clean WHERE ({_NUMBER} + {_QUARTER}) % 3 <> 0)")

# --- sources / sinks ---------------------------------------------------------------------
ORACLES["scan_panel_csv"] = with_panel("SELECT * FROM panel")
ORACLES["sink_panel_csv"] = with_panel("SELECT * FROM panel")
ORACLES["sink_reports"] = with_panel(REPORT_SELECT, DEC)
ORACLES["load_report"] = with_panel(
    "SELECT group_name, n_employees, predicted_high_pct, actual_high_pct, gap_pts, adverse_impact_ratio, bias_flag "
    "FROM aud3", GRP)
ORACLES["scan_batch_csv"] = with_panel(
    "SELECT employee_id, " + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in NUMERIC)
    + ", department, education, role FROM test", SPLIT)
ORACLES["id_column_resolution"] = with_panel("SELECT employee_id, quarter_label FROM test", SPLIT)
ORACLES["missing_feature_defaults"] = with_panel(
    "SELECT employee_id, quarter_label, 0.0e0 AS salary, "
    + ", ".join(f"coalesce(CAST({c} AS DOUBLE), m_{c}) AS {c}" for c in IMPUTE) + " FROM test, med",
    SPLIT + ",\n" + MEDIANS)

# --- explanation with the fixed KPI weights --------------------------------------------------
KPI_W = {"goal_achievement_pct": 0.30, "manager_rating": 0.20, "peer_score": 0.15, "attendance_rate": 0.15,
         "training_hours": 0.10, "projects_completed": 0.05, "overtime_hours": -0.05}
RAW_OF = {f: f for f in NUMERIC} | {f"{c}_enc": c for c in CATS}


def contrib_cte() -> str:
    parts = []
    for i, f in enumerate(FEATURES):
        w = KPI_W.get(f, 0.0)
        parts.append(f"SELECT employee_id, quarter_label, {i} AS i, '{f}' AS name, "
                     f"{w!r}e0 * ((CAST({f} AS DOUBLE) - mean_{f}) / std_{f}) AS c, "
                     f"CAST({RAW_OF[f]} AS VARCHAR) AS raw FROM te_e, sc")
    return prepared_ctes() + ",\nlc AS (" + union_all(parts) + ")"


ORACLES["local_contributions"] = with_panel(
    f"SELECT employee_id, quarter_label, i AS feature_index, {rnd('c', 6)} AS contribution FROM lc", contrib_cte())
_RANKED = """,
pos AS (SELECT *, row_number() OVER (PARTITION BY employee_id, quarter_label ORDER BY c DESC, i) AS rk
        FROM lc WHERE c > 0),
neg AS (SELECT *, row_number() OVER (PARTITION BY employee_id, quarter_label ORDER BY c DESC, i) AS rk,
               count(*) OVER (PARTITION BY employee_id, quarter_label) AS m
        FROM lc WHERE c < 0),
tp AS (SELECT employee_id, quarter_label, string_agg(name, '; ' ORDER BY rk) AS drivers, {pos_msg}
       FROM pos WHERE rk <= 3 GROUP BY ALL),
tn AS (SELECT employee_id, quarter_label, string_agg(name, '; ' ORDER BY rk) AS drivers, {neg_msg}
       FROM neg WHERE rk > m - 3 GROUP BY ALL)"""


def _msg_case(positive: bool) -> str:
    sign = "raises:" if positive else "lowers:"
    return f"string_agg('{sign}' || name || '=' || coalesce(raw, '?'), '{{sep}}' ORDER BY rk)"


def explain_ctes() -> str:
    pm = _msg_case(True)
    nm = _msg_case(False)
    return contrib_cte() + _RANKED.format(
        pos_msg=pm.format(sep=" | ") + " AS msgs, " + pm.format(sep=", ") + " AS msgs2",
        neg_msg=nm.format(sep=" | ") + " AS msgs, " + nm.format(sep=", ") + " AS msgs2")


ORACLES["top_positive_drivers"] = with_panel(
    "SELECT t.employee_id, t.quarter_label, coalesce(tp.drivers, '') AS drivers FROM te_e t "
    "LEFT JOIN tp ON tp.employee_id = t.employee_id AND tp.quarter_label = t.quarter_label", explain_ctes())
ORACLES["top_negative_drivers"] = with_panel(
    "SELECT t.employee_id, t.quarter_label, coalesce(tn.drivers, '') AS drivers FROM te_e t "
    "LEFT JOIN tn ON tn.employee_id = t.employee_id AND tn.quarter_label = t.quarter_label", explain_ctes())
ORACLES["explain_rows"] = with_panel(
    """SELECT t.employee_id, t.quarter_label,
  CASE WHEN goal_achievement_pct >= 85 THEN 'High' WHEN goal_achievement_pct < 50 THEN 'Low' ELSE 'Medium' END
    AS predicted_band,
  coalesce(tp.msgs, '') AS strengths, coalesce(tn.msgs, '') AS concerns,
  concat_ws('; ', 'band=' || CASE WHEN goal_achievement_pct >= 85 THEN 'High' WHEN goal_achievement_pct < 50 THEN 'Low'
     ELSE 'Medium' END, tp.msgs2, tn.msgs2) AS summary
FROM te_e t
LEFT JOIN tp ON tp.employee_id = t.employee_id AND tp.quarter_label = t.quarter_label
LEFT JOIN tn ON tn.employee_id = t.employee_id AND tn.quarter_label = t.quarter_label""", explain_ctes())


ORACLES["feature_messages"] = with_panel(
    "SELECT DISTINCT name AS feature, 'raises:' || name AS positive, 'lowers:' || name AS negative FROM lc WHERE c <> 0",
    contrib_cte())

ORACLES["numeric_profile_cols"] = with_panel(
    "SELECT employee_id, quarter_label, age, experience_years, salary, training_hours, attendance_rate, "
    "overtime_hours, projects_completed, manager_rating, peer_score, goal_achievement_pct FROM panel")
ORACLES["fairness_report"] = with_panel(
    """SELECT (SELECT count(*) FROM aud3) AS n_groups,
  (SELECT coalesce(bool_or(bias_flag = 'INVESTIGATE'), false) FROM aud3) AS bias_detected,
  (SELECT coalesce(bool_or(abs(r - ref) > 0.1e0), false) FROM (
     SELECT r, max(CASE WHEN g = 'EUROPE' THEN r END) OVER () AS ref FROM (
       SELECT department AS g, avg(CASE WHEN prediction = 2 THEN 1 ELSE 0 END) AS r
       FROM ps WHERE department IS NOT NULL GROUP BY department))) AS parity_flagged,
  (SELECT count(DISTINCT experience_tier) FROM (SELECT """ + TIER + """ AS experience_tier FROM ps)
   WHERE experience_tier IS NOT NULL) AS n_tiers""", GRP)

ORACLES["clean_counts"] = with_panel(
    "SELECT (SELECT count(*) FROM feed) AS rows_raw, (SELECT count(*) FROM firsts) AS rows_dedup, "
    "(SELECT count(*) FROM firsts WHERE performance_band IS NOT NULL) AS rows_clean", FEED)

# --- the linear model of fixed coefficients -------------------------------------------------


SCALED = {f: f"((CAST({f} AS DOUBLE) - mean_{f}) / std_{f})" for f in FEATURES}


def linear_ctes(src: str = "te_e", p: str = "f") -> str:
    """Softmax of the fixed linear model over the rows of ``src`` (fp: probabilities p0-p2, prediction)."""
    from panelsight.plans.fixed_models import coefficients as fixed_coefficients
    coefficients, intercepts = fixed_coefficients(len(FEATURES))
    z = ", ".join("(" + " + ".join(f"{w!r}e0 * {SCALED[f]}" for w, f in zip(row, FEATURES)) + f" + {b!r}e0) AS z{k}"
                  for k, (row, b) in enumerate(zip(coefficients, intercepts)))
    return f"""{p}z AS (SELECT {src}.*, {z} FROM {src}, sc),
{p}e AS (SELECT *, exp(z0 - greatest(z0, z1, z2)) AS e0, exp(z1 - greatest(z0, z1, z2)) AS e1, exp(z2 - greatest(z0, z1, z2)) AS e2 FROM {p}z),
{p}p AS (SELECT *, e0 / (e0 + e1 + e2) AS p0, e1 / (e0 + e1 + e2) AS p1, e2 / (e0 + e1 + e2) AS p2,
         CASE WHEN e0 >= e1 AND e0 >= e2 THEN 0 WHEN e1 >= e2 THEN 1 ELSE 2 END AS prediction FROM {p}e)"""


def fixed_model_ctes() -> str:
    return prepared_ctes() + ",\n" + linear_ctes()


FIXED = fixed_model_ctes()
_band = "(['Low', 'Medium', 'High'])[prediction + 1]"
_best = "greatest(p0, p1, p2)"
ORACLES["predict"] = with_panel(
    f"SELECT employee_id, quarter_label, CAST(prediction AS INTEGER) AS prediction, {_band} AS predicted_band, "
    f"{rnd('p0', 6)} AS p_low, {rnd('p1', 6)} AS p_medium, {rnd('p2', 6)} AS p_high FROM fp", FIXED)
ORACLES["confidence_pct"] = with_panel(
    f"SELECT employee_id, quarter_label, round_even({_best} * 100, 1) AS confidence_pct FROM fp", FIXED)
ORACLES["argmax_class"] = with_panel(
    "SELECT employee_id, quarter_label, CAST(prediction AS INTEGER) AS argmax_class FROM fp", FIXED)
ORACLES["probability_breakdown"] = with_panel(
    union_all([f"SELECT employee_id, quarter_label, {k} AS class_index, '{b}' AS band, {rnd(f'p{k}', 6)} AS probability FROM fp"
               for k, b in enumerate(("Low", "Medium", "High"))]), FIXED)
ORACLES["align_predictions"] = with_panel(
    f"SELECT employee_id, quarter_label, department, performance_band, {_band} AS predicted_band FROM fp", FIXED)
ORACLES["scored_summary"] = with_panel(
    "SELECT count(*) FILTER (WHERE prediction = 2) AS n_high, count(*) FILTER (WHERE prediction = 1) AS n_medium, "
    "count(*) FILTER (WHERE prediction = 0) AS n_low FROM fp", FIXED)
ORACLES["feature_vector"] = with_panel(f"SELECT employee_id, quarter_label, {_scaled} FROM te_e, sc", prepared_ctes())
ORACLES["model_store"] = with_panel("SELECT employee_id, quarter_label, true AS same FROM te_e", prepared_ctes())
ORACLES["feature_manifest"] = with_panel(
    union_all([f"SELECT {i} AS position, '{f}' AS feature, count({f}) AS n FROM te_e" for i, f in enumerate(FEATURES)]), prepared_ctes())


def _importances() -> list[float]:
    from panelsight.plans.fixed_models import coefficients as fixed_coefficients
    rows = fixed_coefficients(len(FEATURES))[0]
    return [sum(abs(r[j]) for r in rows) / len(rows) for j in range(len(FEATURES))]


ORACLES["linear_importance"] = with_panel(
    union_all([f"SELECT '{f}' AS feature, {rnd(f'{w!r}e0', 6)} AS importance, "
               f"{rnd(f'{w!r}e0 * stddev_pop((CAST({f} AS DOUBLE) - mean_{f}) / std_{f})', 6)} AS in_data FROM te_e, sc"
               for f, w in zip(FEATURES, _importances())]), prepared_ctes())

# the batch: input values as they are in the file, decisions on them, the model's band and confidence
SCORED = FIXED + f""",
sb AS (SELECT t.*, {_band} AS model_band, {_best} AS best
       FROM test t JOIN fp ON fp.employee_id = t.employee_id AND fp.quarter_label = t.quarter_label),
""" + decision_cte("sb", band="model_band").replace("round_even(1.0e0 * 100, 1) AS confidence_pct", "round_even(best * 100, 1) AS confidence_pct")
_inputs = ", ".join(["employee_id"] + [f"CAST({c} AS DOUBLE) AS {c}" for c in FEATURES if not c.endswith("_enc")] + CATS)
ORACLES["score_batch"] = with_panel(
    f"SELECT {_inputs}, predicted_band, confidence_pct, training_needed, promotion_ready, retention_risk, priority FROM dec", SCORED)
ORACLES["sink_scored_csv"] = ORACLES["score_batch"]
_DEPARTMENTS = with_panel("SELECT group_name, predicted_high_pct FROM aud3", GRP)
ORACLES["sort_reports"] = f"""
SELECT 'departments' AS report, CAST(row_number() OVER (ORDER BY predicted_high_pct DESC, group_name) AS INTEGER) AS pos,
  group_name AS name, predicted_high_pct AS value FROM ({_DEPARTMENTS})
UNION ALL SELECT 'parity', CAST(row_number() OVER (ORDER BY spd, group_name) AS INTEGER), group_name, spd FROM ({ORACLES["statistical_parity"]})
UNION ALL SELECT 'importance', CAST(row_number() OVER (ORDER BY in_data DESC, feature) AS INTEGER), feature, in_data FROM ({ORACLES["linear_importance"]})"""

# --- the forest and the boosted trees of given numbers ---------------------------------------


def _tree_sql(spec: dict, leaf) -> str:
    """Value of one tree of two levels; ``leaf`` gives a leaf's number."""
    def below(i: int) -> str:
        return f"{SCALED[FEATURES[spec['nodes'][i]['feature']]]} < {spec['nodes'][i]['threshold']!r}e0"
    q = [f"{leaf(v)!r}e0" for v in spec["leaves"]]
    return f"(CASE WHEN {below(0)} THEN CASE WHEN {below(1)} THEN {q[0]} ELSE {q[1]} END ELSE CASE WHEN {below(2)} THEN {q[2]} ELSE {q[3]} END END)"


def tree_model_ctes() -> str:
    """fo / bo: class scores (s0-s2) of the forest and of the boosted trees over the prepared test rows."""
    from panelsight.plans.fixed_models import stumps
    forest, boosted = stumps(len(FEATURES), 5, 1), stumps(len(FEATURES), 4, 2)
    fo = ", ".join("(" + " + ".join(_tree_sql(t, lambda v, k=k: v[k] / sum(v)) for t in forest) + f") AS s{k}" for k in range(3))
    bo = ", ".join("(" + " + ".join(f"0.25e0 * {_tree_sql(t, lambda v, k=k: v[k] - 5.0)}" for t in boosted) + f") AS s{k}" for k in range(3))
    return f"fo AS (SELECT te_e.*, {fo} FROM te_e, sc),\nbo AS (SELECT te_e.*, {bo} FROM te_e, sc)"


_ARGMAX = "CASE WHEN s0 >= s1 AND s0 >= s2 THEN 0 WHEN s1 >= s2 THEN 1 ELSE 2 END"
ORACLES["compare_models"] = with_panel(
    union_all([f"SELECT '{n}' AS model, {i} AS model_order, accuracy, f1_macro, f1_weighted FROM c{i}_sm"
               for i, n in enumerate(("logistic_regression", "random_forest", "boosted_trees"))]),
    FIXED + ",\n" + tree_model_ctes() + ",\n" + ",\n".join(metric_ctes(e, f"c{i}_", src) for i, (e, src) in enumerate((("prediction", "fp"), (_ARGMAX, "fo"), (_ARGMAX, "bo")))))


def _forest_importances() -> list[tuple[str, float]]:
    """Impurity importance of the given forest: gains by feature, each tree's as shares, the eight largest."""
    from panelsight.plans.fixed_models import stumps
    total = [0.0] * len(FEATURES)
    for t in stumps(len(FEATURES), 5, 1):
        gains = sum(n["gain"] for n in t["nodes"])
        for n in t["nodes"]:
            total[n["feature"]] += n["gain"] / gains
    return sorted(((f, x / sum(total)) for f, x in zip(FEATURES, total)), key=lambda r: (-r[1], r[0]))[:8]


ORACLES["top_k_importance"] = with_panel(
    union_all([f"SELECT '{f}' AS feature, {rnd(f'{w!r}e0', 6)} AS importance, {rnd(f'stddev_pop({SCALED[f]})', 6)} AS spread FROM te_e, sc"
               for f, w in _forest_importances()]), prepared_ctes())

# --- explanation by the fixed linear model ---------------------------------------------------


def model_contrib_cte(raw: str) -> str:
    """lc: coefficient of the predicted class times the value, of every row and feature; ``raw`` is where the values shown come from."""
    from panelsight.plans.fixed_models import coefficients as fixed_coefficients
    rows = fixed_coefficients(len(FEATURES))[0]
    parts = []
    for i, f in enumerate(FEATURES):
        w = "CASE f.prediction " + " ".join(f"WHEN {k} THEN {rows[k][i]!r}e0" for k in range(3)) + " END"
        x = f"((CAST(f.{f} AS DOUBLE) - mean_{f}) / std_{f})"
        parts.append(f"SELECT f.employee_id, f.quarter_label, {i} AS i, '{f}' AS name, {w} * {x} AS c, CAST(r.{RAW_OF[f]} AS VARCHAR) AS raw "
                     f"FROM fp f JOIN {raw} r ON r.employee_id = f.employee_id AND r.quarter_label = f.quarter_label, sc")
    return "lc AS (" + union_all(parts) + ")"


def _ranked_messages() -> str:
    pm, nm = _msg_case(True), _msg_case(False)
    return _RANKED.format(pos_msg=pm.format(sep=" | ") + " AS msgs, " + pm.format(sep=", ") + " AS msgs2",
                          neg_msg=nm.format(sep=" | ") + " AS msgs, " + nm.format(sep=", ") + " AS msgs2")


_MESSAGES = """LEFT JOIN tp ON tp.employee_id = t.employee_id AND tp.quarter_label = t.quarter_label
LEFT JOIN tn ON tn.employee_id = t.employee_id AND tn.quarter_label = t.quarter_label"""
ORACLES["model_contributions"] = with_panel(
    f"SELECT employee_id, quarter_label, i AS feature_index, {rnd('c', 6)} AS contribution FROM lc", FIXED + ",\n" + model_contrib_cte("te_e"))
ORACLES["explain_model_rows"] = with_panel(
    f"""SELECT t.employee_id, t.quarter_label, {_band} AS predicted_band, {rnd('p0', 3)} AS p_low, {rnd('p1', 3)} AS p_medium, {rnd('p2', 3)} AS p_high,
  coalesce(tp.msgs, '') AS strengths, coalesce(tn.msgs, '') AS concerns,
  concat_ws('; ', 'band=' || {_band}, 'confidence=' || printf('%.1f', round_even({_best} * 100, 1)), tp.msgs2, tn.msgs2) AS summary
FROM fp t {_MESSAGES}""", FIXED + ",\n" + model_contrib_cte("te_e") + _ranked_messages())
ORACLES["score_one"] = with_panel(
    f"""SELECT t.employee_id, t.quarter_label, predicted_band, confidence_pct, priority,
  coalesce(tp.msgs, '') AS strengths, coalesce(tn.msgs, '') AS concerns
FROM dec t {_MESSAGES}""", SCORED + ",\n" + model_contrib_cte("test") + _ranked_messages())
ORACLES["model_shortlists"] = with_panel(
    f"""SELECT {_band} AS list_band, CAST(rank AS INTEGER) AS rank, employee_id, department, experience_years, goal_achievement_pct, manager_rating,
  {rnd('best', 6)} AS score FROM (
  SELECT *, {_best} AS best, row_number() OVER (PARTITION BY prediction ORDER BY {_best} DESC, employee_id, review_year, review_quarter) AS rank
  FROM fp WHERE prediction IN (0, 2)) WHERE rank <= 10""", FIXED)


def _linear_weights() -> list[list[float]]:
    from panelsight.plans.fixed_models import coefficients as fixed_coefficients
    return fixed_coefficients(len(FEATURES))[0]


ORACLES["shapley_linear"] = with_panel(
    union_all([f"SELECT employee_id, quarter_label, {i} AS feature_index, " + ", ".join(
        f"{rnd(f'{_linear_weights()[k][i]!r}e0 * {SCALED[f]}', 6)} AS {c}" for k, c in enumerate(("contrib_low", "contrib_medium", "contrib_high")))
        + " FROM te_e, sc" for i, f in enumerate(FEATURES)]), prepared_ctes())
ORACLES["shapley_global"] = with_panel(
    "SELECT feature, " + rnd("m", 6) + " AS mean_abs FROM (" + union_all([
        f"SELECT '{f}' AS feature, avg(abs({_linear_weights()[2][i]!r}e0 * {SCALED[f]})) AS m FROM te_e, sc" for i, f in enumerate(FEATURES)])
    + ") ORDER BY m DESC, feature LIMIT 12", prepared_ctes())

# fill-with-0 scoring: an absent feature and empty cells are 0, unseen categories too
_ZC, _ZJ = encoded_select("test", zero=True)
_ZERO = ", ".join(f"{'0.0e0' if c == 'salary' else f'coalesce({c}, 0)'} AS {c}" for c in NUMERIC)
ORACLES["score_batch_zero"] = with_panel(
    f"SELECT employee_id, quarter_label, {_band} AS predicted_band, round_even({_best} * 100, 1) AS confidence_pct FROM zp",
    prepared_ctes() + f",\nte_z AS (SELECT t.* REPLACE ({_ZERO}), {', '.join(_ZC)} FROM test t {_ZJ}),\n" + linear_ctes("te_z", "z"))

# --- scans with rejects, bucketed tables ------------------------------------------------------
_KIND = f"(({_NUMBER} + {_QUARTER}) % 20)"
ORACLES["scan_rejects"] = with_panel(
    f"""SELECT employee_id, quarter_label, CASE WHEN {_KIND} = 4 THEN role || chr(10) || 'said "yes", twice' ELSE role END AS role, salary,
  CASE WHEN {_KIND} <> 3 THEN goal_achievement_pct END AS goal_achievement_pct
FROM panel WHERE {_KIND} > 2""")
ORACLES["scan_reject_counts"] = with_panel(
    f"""SELECT count(*) AS n_in, count(*) FILTER (WHERE {_KIND} > 2) AS n_out, count(*) FILTER (WHERE {_KIND} <= 2) AS n_rejected,
  count(*) FILTER (WHERE {_KIND} = 3) AS n_bad_cells, count(*) FILTER (WHERE {_KIND} < 2) AS n_ragged, count(*) FILTER (WHERE {_KIND} = 2) AS n_required FROM panel""")
ORACLES["dedup_bucketed"] = with_panel("SELECT * FROM dedup", DEDUP)
ORACLES["attach_bucketed"] = ORACLES["attach_decisions"]
ORACLES["densify_bucketed"] = ORACLES["densify_panel"]
