"""Exact SQL for the registered queries, runnable by DuckDB on the same Parquet tables.

Each statement starts from the ``shipments`` SELECT over ``lineitem`` and ``orders``.
Sequential rules (the 60/5 policy, the IQR filter) are CTE chains, one link per
column. Queries that are not expressible in SQL (large tree ensembles, L1 grids, sweeps)
have no entry here and are checked on row counts and in unit tests; small exact settings of
the same estimators (``rf_exact``, ``gbt_exact``, ``linreg_ridge``, ``cv_grid_ridge``) have one.
"""

from __future__ import annotations

from tarmac.functions.rounding import sql_round_dp as rdp
from tarmac.functions.rounding import sql_round_sig as sig
from tarmac.plans import queries as Q
from tarmac.sources.shipments import CATEGORICAL, COLUMNS, KEYS, shipments_sql

NUMERIC = ["l_orderkey", "l_linenumber", "delay", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
           "o_totalprice", "order_year", "order_month"]
DOUBLES = ["delay", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "o_totalprice"]


def _with(*ctes: str) -> str:
    parts = [f"shipments AS (\n{shipments_sql()}\n)"] + list(ctes)
    return "WITH " + ",\n".join(parts) + "\n"


def _hash(window: int) -> str:
    start = 1 + 8 * window
    return (f"CAST(('0x' || substr(md5(concat_ws('|', {', '.join(KEYS)})), {start}, 8)) AS BIGINT)")


def _is_train() -> str:
    return f"(({_hash(0)} % 10) < 8)"


def _fold(k: int) -> str:
    return f"CAST({_hash(1)} % {k} AS INTEGER)"


def _union(selects: list[str]) -> str:
    return "\nUNION ALL\n".join(selects)


# ---------------------------------------------------------------- sources / projections

def _all_rows() -> str:
    return _with() + "SELECT * FROM shipments"


def preview() -> str:
    return _with() + ("SELECT * FROM shipments ORDER BY l_orderkey, l_linenumber, delay, "
                      "l_extendedprice, o_totalprice LIMIT 5")


def project_features() -> str:
    return _with() + f"SELECT {', '.join(Q.PROJECTED)} FROM shipments"


def drop_columns() -> str:
    keep = [c for c in COLUMNS if c not in Q.DROPPED]
    return _with() + f"SELECT {', '.join(keep)} FROM shipments"


def bulk_cast() -> str:
    cols = [f"CAST({c} AS FLOAT) AS {c}" if c in DOUBLES else c for c in COLUMNS]
    return _with() + f"SELECT {', '.join(cols)} FROM shipments"


def dropna_any() -> str:
    keep = [c for c in COLUMNS if c != "l_discount"]
    cond = " AND ".join(f"{c} IS NOT NULL" for c in keep)
    return _with() + f"SELECT {', '.join(keep)} FROM shipments WHERE {cond}"


def union_sources() -> str:
    full = Q.UNION_PART_COLUMNS[0]
    part = f"CAST({_hash(2)} % 3 AS INTEGER)"
    short = [c if c in Q.UNION_PART_COLUMNS[2] else
             (f"CAST(NULL AS DOUBLE) AS {c}" if c in DOUBLES else f"CAST(NULL AS VARCHAR) AS {c}")
             for c in full]
    return _with(f"sp AS (SELECT *, {part} AS part FROM shipments)") + _union([
        f"SELECT {', '.join(full)} FROM sp WHERE part IN (0, 1)",
        f"SELECT {', '.join(short)} FROM sp WHERE part = 2",
    ])


# ---------------------------------------------------------------- profiling

def null_profile() -> str:
    return _with() + _union([
        f"SELECT '{c}' AS column_name, CAST(count(*) AS BIGINT) AS n_rows, "
        f"CAST(count(*) - count({c}) AS BIGINT) AS n_null, "
        f"{rdp(f'CAST(count(*) - count({c}) AS DOUBLE) / count(*)', 6)} AS null_ratio FROM shipments"
        for c in COLUMNS
    ])


def distinct_counts() -> str:
    return _with() + _union([
        f"SELECT '{c}' AS column_name, CAST(count(DISTINCT {c}) AS BIGINT) AS n_distinct, "
        f"CAST(NULL AS VARCHAR) AS error FROM shipments"
        for c in CATEGORICAL
    ])


def distinct_values() -> str:
    return _with() + "SELECT DISTINCT o_orderpriority FROM shipments"


def correlation_matrix() -> str:
    cols = Q.PROFILE_NUMERIC
    return _with() + _union([
        f"SELECT '{a}' AS col_a, '{b}' AS col_b, {rdp(f'corr({a}, {b})', 9)} AS corr FROM shipments"
        for a in cols for b in cols
    ])


def describe() -> str:
    def one(c):
        return (f"SELECT '{c}' AS column_name, CAST(count({c}) AS BIGINT) AS \"count\", "
                f"{sig(f'avg({c})')} AS mean, {sig(f'stddev_samp({c})')} AS std, "
                f"{sig(f'min({c})')} AS \"min\", {sig(f'quantile_cont({c}, 0.25)')} AS q25, "
                f"{sig(f'quantile_cont({c}, 0.5)')} AS q50, {sig(f'quantile_cont({c}, 0.75)')} AS q75, "
                f"{sig(f'max({c})')} AS \"max\" FROM shipments")
    return _with() + _union([one(c) for c in Q.DESCRIBE_COLS])


def quartiles() -> str:
    return _with() + _union([
        f"SELECT '{c}' AS column_name, quantile_disc({c}, 0.25) AS q1, quantile_disc({c}, 0.75) AS q3, "
        f"{sig(f'quantile_disc({c}, 0.75) - quantile_disc({c}, 0.25)')} AS iqr FROM shipments"
        for c in Q.PROFILE_NUMERIC
    ])


# ---------------------------------------------------------------- cleaning

def _policy_chain(cols: list[str], drop_col: float, drop_rows: float) -> list[str]:
    ctes = ["tot AS (SELECT count(*) AS n FROM shipments)", "r0 AS (SELECT * FROM shipments)"]
    for i, c in enumerate(cols, start=1):
        ctes.append(f"a{i} AS (SELECT count(*) - count({c}) AS miss, avg({c}) AS mu FROM r{i - 1})")
        ctes.append(
            f"d{i} AS (SELECT CASE WHEN a{i}.miss > {drop_col} * tot.n THEN 'drop_column' "
            f"WHEN a{i}.miss <= {drop_rows} * tot.n THEN 'drop_rows' ELSE 'impute' END AS act, "
            f"a{i}.miss, a{i}.mu FROM a{i}, tot)"
        )
        ctes.append(f"r{i} AS (SELECT r{i - 1}.* FROM r{i - 1}, d{i} "
                    f"WHERE NOT (d{i}.act = 'drop_rows' AND r{i - 1}.{c} IS NULL))")
    return ctes


def null_policy_60_5() -> str:
    cols = Q.POLICY_NUMERIC
    return _with(*_policy_chain(cols, 0.6, 0.05)) + _union([
        f"SELECT '{c}' AS column_name, act AS action, CAST(miss AS BIGINT) AS missing, "
        f"CASE WHEN act = 'impute' THEN {sig('mu')} END AS mean_value FROM d{i}"
        for i, c in enumerate(cols, start=1)
    ])


def null_policy_60_5_apply() -> str:
    cols = Q.POLICY_NUMERIC
    last = f"r{len(cols)}"
    iq = cols.index("l_quantity") + 1
    it = cols.index("l_tax") + 1
    return _with(*_policy_chain(cols, 0.6, 0.05)) + (
        f"SELECT {last}.l_orderkey, {last}.l_linenumber, "
        f"CASE WHEN d{iq}.act = 'impute' THEN coalesce({last}.l_quantity, d{iq}.mu) ELSE {last}.l_quantity END "
        f"AS l_quantity, "
        f"{rdp(f'CASE WHEN d{it}.act = {chr(39)}impute{chr(39)} THEN coalesce({last}.l_tax, d{it}.mu) ELSE {last}.l_tax END', 9)} "
        f"AS l_tax FROM {last}, d{iq}, d{it}"
    )


def _ratio_chain() -> tuple[list[str], str]:
    """Counts, means and the 40/10 action of each column; and the condition that keeps a row."""
    cols = Q.POLICY_NUMERIC
    stats = ", ".join(f"count(*) - count({c}) AS m{i}, avg({c}) AS a{i}" for i, c in enumerate(cols))
    acts = ", ".join(
        f"CASE WHEN CAST(m{i} AS DOUBLE) / n > 0.4 THEN 'drop_column' "
        f"WHEN CAST(m{i} AS DOUBLE) / n > 0.1 THEN 'impute' ELSE 'keep' END AS act{i}"
        for i in range(len(cols))
    )
    others = [c for c in COLUMNS if c not in cols]
    cond = " AND ".join(
        [f"(acts.act{i} <> 'keep' OR shipments.{c} IS NOT NULL)" for i, c in enumerate(cols)]
        + [f"shipments.{c} IS NOT NULL" for c in others]
    )
    ctes = [
        f"tot AS (SELECT count(*) AS n, {stats} FROM shipments)",
        f"acts AS (SELECT tot.*, {acts} FROM tot)",
    ]
    return ctes, cond


def null_policy_40_10() -> str:
    cols = Q.POLICY_NUMERIC
    ctes, cond = _ratio_chain()
    ctes += [
        f"ra AS (SELECT CAST(count(*) AS BIGINT) AS rows_after FROM shipments, acts WHERE {cond})",
    ]
    return _with(*ctes) + _union([
        f"SELECT '{c}' AS column_name, act{i} AS action, CAST(m{i} AS BIGINT) AS missing, "
        f"CASE WHEN act{i} = 'impute' THEN {sig(f'a{i}')} END AS mean_value, ra.rows_after "
        f"FROM acts, ra"
        for i, c in enumerate(cols)
    ])


def null_policy_40_10_apply() -> str:
    ctes, cond = _ratio_chain()

    def one(c):
        i = Q.POLICY_NUMERIC.index(c)
        filled = f"CASE WHEN acts.act{i} = 'impute' THEN coalesce(shipments.{c}, acts.a{i}) ELSE shipments.{c} END"
        return f"{rdp(filled, 6)} AS {c}"
    return _with(*ctes) + (f"SELECT {', '.join('shipments.' + k for k in KEYS)}, "
                           f"{', '.join(map(one, Q.RATIO_APPLIED))} FROM shipments, acts WHERE {cond}")


def sweep_records() -> str:
    """Rows that the pipeline's cleaning keeps, for every setting: the 60/5 rule, then no NULL category."""
    cols = Q.POLICY_NUMERIC
    cats = " AND ".join(f"{c} IS NOT NULL" for c in CATEGORICAL)
    settings = ", ".join(f"({n})" for n in Q.SWEEP_EXACT)
    return _with(*_policy_chain(cols, 0.6, 0.05)) + (
        f"SELECT CAST(p AS INTEGER) AS partition_size, 1 AS parallelism, 1 AS task_cpus, k.n AS rows_clean "
        f"FROM (VALUES {settings}) v(p), (SELECT count(*) AS n FROM r{len(cols)} WHERE {cats}) k")


def csv_overridden() -> str:
    return _with() + ("SELECT CAST(l_orderkey AS BIGINT) AS l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, "
                      "o_orderpriority, CAST(order_month AS VARCHAR) AS order_month FROM shipments")


def null_policy_thresh() -> str:
    stats = ", ".join(
        f"count(*) - count({c}) AS m{i}" + (f", avg({c}) AS a{i}" if c in NUMERIC else "")
        for i, c in enumerate(COLUMNS)
    )
    ctes = [f"tot AS (SELECT count(*) AS n, CAST(floor(0.6::DOUBLE * count(*)) AS BIGINT) AS th, "
            f"{stats} FROM shipments)"]

    def one(i, c):
        if c in NUMERIC:
            act = f"CASE WHEN n - m{i} < th THEN 'drop_column' ELSE 'impute' END"
            mean = f"CASE WHEN n - m{i} < th THEN NULL ELSE {sig(f'a{i}')} END"
        else:
            act = f"CASE WHEN n - m{i} < th THEN 'drop_column' ELSE 'keep' END"
            mean = "CAST(NULL AS DOUBLE)"
        return (f"SELECT '{c}' AS column_name, {act} AS action, CAST(m{i} AS BIGINT) AS missing, "
                f"{mean} AS mean_value FROM tot")
    return _with(*ctes) + _union([one(i, c) for i, c in enumerate(COLUMNS)])


def null_policy_thresh_apply() -> str:
    def one(c):
        if c not in DOUBLES:
            return c
        return f"{rdp(f'coalesce({c}, avg({c}) OVER ())', 6)} AS {c}"
    kept = [c for c in COLUMNS if c != "l_discount"]  # 70% NULL
    return _with() + f"SELECT {', '.join(one(c) for c in kept)} FROM shipments"


def column_kinds() -> str:
    def one(c):
        kind = f"(SELECT any_value(typeof({c})) FROM shipments WHERE {c} IS NOT NULL)"
        return (f"SELECT '{c}' AS column_name, CASE WHEN {kind} = 'VARCHAR' THEN 'string' ELSE 'numeric' END AS kind, "
                f"CASE {kind} WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int' ELSE lower({kind}) END AS data_type, "
                f"CAST(count({c}) AS BIGINT) AS n_present FROM shipments")
    return _with() + _union([one(c) for c in COLUMNS])


def mean_impute() -> str:
    return _with() + (
        f"SELECT l_orderkey, l_linenumber, {rdp('coalesce(l_tax, avg(l_tax) OVER ())', 9)} AS l_tax, "
        f"{rdp('coalesce(l_quantity, avg(l_quantity) OVER ())', 6)} AS l_quantity FROM shipments"
    )


def _iqr_chain() -> list[str]:
    f = Q.IQR_FACTOR
    ctes = ["s0 AS (SELECT * FROM shipments)"]
    for i, c in enumerate(Q.IQR_COLS, start=1):
        ctes.append(f"q{i} AS (SELECT quantile_disc({c}, 0.25) AS q1, quantile_disc({c}, 0.75) AS q3 FROM s{i - 1})")
        ctes.append(f"b{i} AS (SELECT q1, q3, q1 - {f} * (q3 - q1) AS lo, q3 + {f} * (q3 - q1) AS hi FROM q{i})")
        ctes.append(f"s{i} AS (SELECT s{i - 1}.* FROM s{i - 1}, b{i} WHERE s{i - 1}.{c} BETWEEN b{i}.lo AND b{i}.hi)")
    return ctes


def iqr_filter() -> str:
    ctes = _iqr_chain()
    ctes += [f"n{i} AS (SELECT CAST(count(*) AS BIGINT) AS rows_after FROM s{i})" for i in range(1, len(Q.IQR_COLS) + 1)]
    return _with(*ctes) + _union([
        f"SELECT '{c}' AS column_name, q1, q3, {sig('lo')} AS lower, {sig('hi')} AS upper, rows_after "
        f"FROM b{i}, n{i}"
        for i, c in enumerate(Q.IQR_COLS, start=1)
    ])


def iqr_filter_apply() -> str:
    return _with(*_iqr_chain()) + f"SELECT {', '.join([*KEYS, *Q.IQR_COLS])} FROM s{len(Q.IQR_COLS)}"


# ---------------------------------------------------------------- encoding

def _freq_labels(cols: list[str], base: str, as_text: bool = False) -> list[str]:
    out = []
    for i, c in enumerate(cols):
        v = f"CAST({c} AS VARCHAR)" if as_text else c
        out.append(
            f"lab{i} AS (SELECT v, CAST(row_number() OVER (ORDER BY cnt DESC, v) - 1 AS DOUBLE) AS idx "
            f"FROM (SELECT {v} AS v, count(*) AS cnt FROM {base} GROUP BY {v}))"
        )
    return out


def _indexed_rows(cols: list[str], as_text: bool = False) -> str:
    cond = " AND ".join(f"{c} IS NOT NULL" for c in cols)
    ctes = [f"base AS (SELECT * FROM shipments WHERE {cond})"] + _freq_labels(cols, "base", as_text)
    joins = " ".join(
        f"JOIN lab{i} ON {('CAST(b.' + c + ' AS VARCHAR)') if as_text else ('b.' + c)} = lab{i}.v"
        for i, c in enumerate(cols)
    )
    sel = ", ".join(f"lab{i}.idx AS {c}" for i, c in enumerate(cols))
    return _with(*ctes) + f"SELECT b.l_orderkey, b.l_linenumber, {sel} FROM base b {joins}"


def string_index() -> str:
    return _indexed_rows(CATEGORICAL)


def string_index_numeric() -> str:
    return _indexed_rows(["order_year", "order_month"], as_text=True)


def string_index_labels() -> str:
    cond = " AND ".join(f"{c} IS NOT NULL" for c in CATEGORICAL)
    ctes = [f"base AS (SELECT * FROM shipments WHERE {cond})"] + _freq_labels(CATEGORICAL, "base")
    return _with(*ctes) + _union([
        f"SELECT '{c}' AS column_name, v AS label, idx FROM lab{i}" for i, c in enumerate(CATEGORICAL)
    ])


def _alpha_codes(cols: list[str], value_expr) -> str:
    ctes = [
        f"lab{i} AS (SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS INTEGER) AS idx "
        f"FROM (SELECT DISTINCT {value_expr(c)} AS v FROM shipments))"
        for i, c in enumerate(cols)
    ]
    joins = " ".join(f"JOIN lab{i} ON {value_expr('s.' + c)} = lab{i}.v" for i, c in enumerate(cols))
    sel = ", ".join(f"lab{i}.idx AS {c}" for i, c in enumerate(cols))
    return _with(*ctes) + f"SELECT s.l_orderkey, s.l_linenumber, {sel} FROM shipments s {joins}"


def label_encode() -> str:
    return _alpha_codes(["l_returnflag", "o_orderpriority"],
                        lambda c: f"coalesce(CAST({c} AS VARCHAR), 'nan')")


def dictionary_encode() -> str:
    return _alpha_codes(["o_orderpriority", "o_orderstatus", "l_linestatus"], lambda c: c)


def dictionary_large() -> str:
    ctes = [
        f"lab{i} AS (SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS INTEGER) AS idx "
        f"FROM (SELECT DISTINCT CAST({c} AS VARCHAR) AS v FROM shipments WHERE {c} IS NOT NULL))"
        for i, c in enumerate(Q.LARGE_CODED)
    ]
    joins = " ".join(f"LEFT JOIN lab{i} ON CAST(s.{c} AS VARCHAR) = lab{i}.v" for i, c in enumerate(Q.LARGE_CODED))
    sel = ", ".join(f"coalesce(lab{i}.idx, CAST((SELECT count(*) FROM lab{i}) AS INTEGER)) AS {c}_code, "
                    f"lab{i}.v AS {c}_decoded" for i, c in enumerate(Q.LARGE_CODED))
    return _with(*ctes) + f"SELECT s.l_orderkey, s.l_linenumber, {sel} FROM shipments s {joins}"


def categorize_roundtrip() -> str:
    ctes = ["lab AS (SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS INTEGER) AS idx "
            "FROM (SELECT DISTINCT o_orderpriority AS v FROM shipments WHERE o_orderpriority IS NOT NULL))"]
    return _with(*ctes) + (
        "SELECT s.l_orderkey, s.l_linenumber, lab.idx AS o_orderpriority_code, "
        "s.o_orderpriority AS o_orderpriority_decoded FROM shipments s JOIN lab ON s.o_orderpriority = lab.v"
    )


def categorize_nulls() -> str:
    return _with() + ("SELECT l_orderkey, l_linenumber, l_returnflag, l_returnflag AS l_returnflag_decoded "
                      "FROM shipments")


# ---------------------------------------------------------------- features / split

def hash_split() -> str:
    return _with() + f"SELECT l_orderkey, l_linenumber, {_is_train()} AS is_train FROM shipments"


def fold_assign() -> str:
    return _with() + f"SELECT l_orderkey, l_linenumber, {_fold(Q.N_FOLDS)} AS fold FROM shipments"


def standard_scale() -> str:
    cols = Q.VECTOR_SCALE_COLS
    stats = ", ".join(f"avg({c}) AS m{i}, stddev_samp({c}) AS s{i}" for i, c in enumerate(cols))
    z = ", ".join(
        f"{rdp(f'CASE WHEN st.s{i} = 0 THEN 0.0 ELSE (sp.{c} - st.m{i}) / st.s{i} END', 6)} AS z_{c}"
        for i, c in enumerate(cols)
    )
    ctes = [f"sp AS (SELECT *, {_is_train()} AS is_train FROM shipments)",
            f"st AS (SELECT {stats} FROM sp WHERE is_train)"]
    return _with(*ctes) + f"SELECT sp.l_orderkey, sp.l_linenumber, sp.is_train, {z} FROM sp, st"


def kfold_scale() -> str:
    cols = Q.SCALE_COLS
    stats = ", ".join(f"avg(fz.{c}) AS m{i}, stddev_pop(fz.{c}) AS s{i}" for i, c in enumerate(cols))
    z = ", ".join(
        f"{rdp(f'CASE WHEN st.s{i} = 0 THEN 0.0 ELSE (fz.{c} - st.m{i}) / st.s{i} END', 6)} AS z_{c}"
        for i, c in enumerate(cols)
    )
    ctes = [f"fz AS (SELECT *, {_fold(Q.N_FOLDS)} AS fold FROM shipments)",
            "folds AS (SELECT DISTINCT fold FROM fz)",
            f"st AS (SELECT f.fold, {stats} FROM folds f JOIN fz ON fz.fold <> f.fold GROUP BY f.fold)"]
    return _with(*ctes) + f"SELECT fz.l_orderkey, fz.l_linenumber, fz.fold, {z} FROM fz JOIN st ON fz.fold = st.fold"


# ---------------------------------------------------------------- models

def _ols2_ctes(train_where: str, source: str = "shipments") -> list[str]:
    x1, x2 = Q.OLS_FEATURES
    return [
        f"tr AS (SELECT delay AS y, {x1} AS x1, {x2} AS x2 FROM {source} WHERE {train_where} "
        f"AND delay IS NOT NULL AND {x1} IS NOT NULL AND {x2} IS NOT NULL)",
        "mo AS (SELECT avg(y) AS my, avg(x1) AS m1, avg(x2) AS m2, var_pop(x1) AS s11, var_pop(x2) AS s22, "
        "covar_pop(x1, x2) AS s12, covar_pop(x1, y) AS s1y, covar_pop(x2, y) AS s2y FROM tr)",
        "bb AS (SELECT (s22 * s1y - s12 * s2y) / (s11 * s22 - s12 * s12) AS b1, "
        "(s11 * s2y - s12 * s1y) / (s11 * s22 - s12 * s12) AS b2, my, m1, m2 FROM mo)",
        "co AS (SELECT my - b1 * m1 - b2 * m2 AS b0, b1, b2 FROM bb)",
    ]


def _test_rows() -> str:
    x1, x2 = Q.OLS_FEATURES
    return (f"te AS (SELECT l_orderkey, l_linenumber, delay AS y, {x1} AS x1, {x2} AS x2 FROM shipments "
            f"WHERE NOT {_is_train()} AND delay IS NOT NULL AND {x1} IS NOT NULL AND {x2} IS NOT NULL)")


def linreg_coeffs() -> str:
    x1, x2 = Q.OLS_FEATURES
    return _with(*_ols2_ctes(_is_train())) + _union([
        f"SELECT 'intercept' AS term, {sig('b0')} AS value FROM co",
        f"SELECT '{x1}' AS term, {sig('b1')} AS value FROM co",
        f"SELECT '{x2}' AS term, {sig('b2')} AS value FROM co",
    ])


def linreg_predict() -> str:
    return _with(*_ols2_ctes(_is_train()), _test_rows()) + (
        f"SELECT te.l_orderkey, te.l_linenumber, te.y AS label, "
        f"{rdp('co.b0 + co.b1 * te.x1 + co.b2 * te.x2', 4)} AS prediction FROM te, co"
    )


def regression_metrics() -> str:
    ctes = _ols2_ctes(_is_train()) + [
        _test_rows(),
        "pr AS (SELECT te.y, co.b0 + co.b1 * te.x1 + co.b2 * te.x2 AS p FROM te, co)",
        "me AS (SELECT count(*) AS n, avg((y - p) * (y - p)) AS mse, avg(abs(y - p)) AS mae, "
        "var_pop(y) AS vy FROM pr)",
    ]
    return _with(*ctes) + (
        f"SELECT CAST(n AS BIGINT) AS n, {sig('mse')} AS mse, {sig('sqrt(mse)')} AS rmse, "
        f"{sig('mae')} AS mae, {sig('1 - mse / vy')} AS r2 FROM me"
    )


def kfold_ols() -> str:
    x1, x2 = Q.OLS_FEATURES
    ctes = [
        f"fz AS (SELECT delay AS y, {x1} AS x1, {x2} AS x2, {_fold(Q.N_FOLDS)} AS fold FROM shipments "
        f"WHERE delay IS NOT NULL AND {x1} IS NOT NULL AND {x2} IS NOT NULL)",
        "folds AS (SELECT DISTINCT fold FROM fz)",
        "mo AS (SELECT f.fold, count(*) AS n_train, avg(y) AS my, avg(x1) AS m1, avg(x2) AS m2, "
        "var_pop(x1) AS s11, var_pop(x2) AS s22, covar_pop(x1, x2) AS s12, covar_pop(x1, y) AS s1y, "
        "covar_pop(x2, y) AS s2y FROM folds f JOIN fz ON fz.fold <> f.fold GROUP BY f.fold)",
        "bb AS (SELECT fold, n_train, (s22 * s1y - s12 * s2y) / (s11 * s22 - s12 * s12) AS b1, "
        "(s11 * s2y - s12 * s1y) / (s11 * s22 - s12 * s12) AS b2, my, m1, m2 FROM mo)",
        "co AS (SELECT fold, n_train, my - b1 * m1 - b2 * m2 AS b0, b1, b2 FROM bb)",
        "pf AS (SELECT fz.fold, co.n_train, fz.y, co.b0 + co.b1 * fz.x1 + co.b2 * fz.x2 AS p "
        "FROM fz JOIN co ON fz.fold = co.fold)",
        "met AS (SELECT fold, n_train, count(*) AS n_test, sqrt(avg((y - p) * (y - p))) AS rmse, "
        "avg(abs(y - p)) AS mae FROM pf GROUP BY fold, n_train)",
    ]
    return _with(*ctes) + (
        f"SELECT CAST(fold AS INTEGER) AS fold, CAST(n_train AS BIGINT) AS n_train, "
        f"CAST(n_test AS BIGINT) AS n_test, {sig('rmse')} AS rmse, {sig('mae')} AS mae, "
        f"{sig('avg(rmse) OVER ()')} AS mean_rmse FROM met"
    )


def tree_stump() -> str:
    feats = Q.STUMP_FEATURES
    nn = " AND ".join(f"{c} IS NOT NULL" for c in ["delay", *feats])
    ctes = [f"tr AS (SELECT delay AS y, {', '.join(feats)} FROM shipments WHERE {_is_train()} AND {nn})",
            "tt AS (SELECT count(*) AS n, sum(y) AS s FROM tr)"]
    cands = []
    for i, f in enumerate(feats):
        ctes.append(f"g{i} AS (SELECT CAST({f} AS DOUBLE) AS v, count(*) AS c, sum(y) AS s FROM tr GROUP BY {f})")
        ctes.append(f"c{i} AS (SELECT v, sum(c) OVER (ORDER BY v) AS nl, sum(s) OVER (ORDER BY v) AS sl, "
                    f"lead(v) OVER (ORDER BY v) AS nv FROM g{i})")
        cands.append(f"SELECT '{f}' AS feature, (v + nv) / 2 AS threshold, nl, sl, tt.n - nl AS nr, "
                     f"tt.s - sl AS sr FROM c{i}, tt WHERE nv IS NOT NULL")
    ctes.append("cand AS (" + " UNION ALL ".join(cands) + ")")
    ctes.append("best AS (SELECT *, sl * sl / nl + sr * sr / nr AS score FROM cand ORDER BY score DESC LIMIT 1)")
    return _with(*ctes) + (
        f"SELECT feature, threshold, {sig('sl / nl')} AS left_mean, {sig('sr / nr')} AS right_mean, "
        "CAST(nl AS BIGINT) AS n_left, CAST(nr AS BIGINT) AS n_right FROM best"
    )


def _ridge_ctes(source: str, tag: str, reg: float, by: str = "") -> list[str]:
    """co{tag}(b0, b1, b2): ridge on variables scaled by their population deviation."""
    pre = f"{by}, " if by else ""
    group = f" GROUP BY {by}" if by else ""
    return [
        f"mo{tag} AS (SELECT {pre}avg(y) AS my, avg(x1) AS m1, avg(x2) AS m2, stddev_pop(y) AS dy, stddev_pop(x1) AS d1, "
        "stddev_pop(x2) AS d2, covar_pop(x1, x2) / (stddev_pop(x1) * stddev_pop(x2)) AS r12, "
        "covar_pop(x1, y) / (stddev_pop(x1) * stddev_pop(y)) AS r1, "
        f"covar_pop(x2, y) / (stddev_pop(x2) * stddev_pop(y)) AS r2 FROM {source}{group})",
        f"di{tag} AS (SELECT *, 1 + {reg} / dy AS g FROM mo{tag})",
        f"bb{tag} AS (SELECT {pre}my, m1, m2, (g * r1 - r12 * r2) / (g * g - r12 * r12) * dy / d1 AS b1, "
        f"(g * r2 - r12 * r1) / (g * g - r12 * r12) * dy / d2 AS b2 FROM di{tag})",
        f"co{tag} AS (SELECT {pre}my - b1 * m1 - b2 * m2 AS b0, b1, b2 FROM bb{tag})",
    ]


def linreg_ridge() -> str:
    x1, x2 = Q.OLS_FEATURES
    ctes = [_ols2_ctes(_is_train())[0], *_ridge_ctes("tr", "", Q.RIDGE)]
    return _with(*ctes) + _union([
        f"SELECT '{t}' AS term, {sig(b)} AS value FROM co" for t, b in (("intercept", "b0"), (x1, "b1"), (x2, "b2"))
    ])


def cv_grid_ridge() -> str:
    x1, x2 = Q.OLS_FEATURES
    ctes = [f"fz AS (SELECT delay AS y, {x1} AS x1, {x2} AS x2, {_fold(Q.CV_FOLDS)} AS fold FROM shipments "
            f"WHERE {_is_train()} AND delay IS NOT NULL AND {x1} IS NOT NULL AND {x2} IS NOT NULL)",
            "ft AS (SELECT f.fold, fz.y, fz.x1, fz.x2 FROM (SELECT DISTINCT fold FROM fz) f JOIN fz ON fz.fold <> f.fold)"]
    for i, reg in enumerate(Q.RIDGE_GRID):
        ctes += _ridge_ctes("ft", f"{i}", reg, "fold")
        ctes.append(f"er{i} AS (SELECT fold, sqrt(avg((y - b0 - b1 * x1 - b2 * x2) * (y - b0 - b1 * x1 - b2 * x2))) AS rmse "
                    f"FROM fz JOIN co{i} USING (fold) GROUP BY fold)")
    return _with(*ctes) + _union([
        f"SELECT 'regParam={reg}' AS params, {sig('avg(rmse)')} AS avg_rmse FROM er{i}" for i, reg in enumerate(Q.RIDGE_GRID)
    ])


def cv_grid_moments() -> str:
    """Elastic net on two standardized variables: of the solutions for every choice of signs the one
    of least objective."""
    x1, x2 = Q.OLS_FEATURES
    points = [f"({reg}, {share}, 'elasticNetParam={share}, regParam={reg}')" for reg in Q.GRID_SIX["regParam"] for share in Q.GRID_SIX["elasticNetParam"]]
    ctes = [f"fz AS (SELECT delay AS y, {x1} AS x1, {x2} AS x2, {_fold(Q.CV_FOLDS)} AS fold FROM shipments "
            f"WHERE {_is_train()} AND delay IS NOT NULL AND {x1} IS NOT NULL AND {x2} IS NOT NULL)",
            "ft AS (SELECT f.fold, fz.y, fz.x1, fz.x2 FROM (SELECT DISTINCT fold FROM fz) f JOIN fz ON fz.fold <> f.fold)",
            _ridge_ctes("ft", "", 0, "fold")[0],
            f"pt AS (SELECT reg::DOUBLE AS reg, share::DOUBLE AS share, params FROM (VALUES {', '.join(points)}) t(reg, share, params))",
            "pen AS (SELECT mo.*, params, reg * share / dy AS l1, 1 + reg * (1 - share) / dy AS g FROM mo, pt)",
            "signs AS (SELECT s1, s2 FROM (VALUES (-1), (0), (1)) a(s1), (VALUES (-1), (0), (1)) b(s2))",
            "sol AS (SELECT *, CASE WHEN s1 = 0 THEN 0 WHEN s2 = 0 THEN (r1 - l1 * s1) / g "
            "ELSE (g * (r1 - l1 * s1) - r12 * (r2 - l1 * s2)) / (g * g - r12 * r12) END AS a1, "
            "CASE WHEN s2 = 0 THEN 0 WHEN s1 = 0 THEN (r2 - l1 * s2) / g "
            "ELSE (g * (r2 - l1 * s2) - r12 * (r1 - l1 * s1)) / (g * g - r12 * r12) END AS a2 FROM pen, signs)",
            "fit AS (SELECT * FROM sol WHERE a1 * s1 >= 0 AND a2 * s2 >= 0 QUALIFY row_number() OVER (PARTITION BY fold, params ORDER BY "
            "g * (a1 * a1 + a2 * a2) / 2 + r12 * a1 * a2 - r1 * a1 - r2 * a2 + l1 * (abs(a1) + abs(a2))) = 1)",
            "co AS (SELECT fold, params, my - b1 * m1 - b2 * m2 AS b0, b1, b2 FROM (SELECT *, a1 * dy / d1 AS b1, a2 * dy / d2 AS b2 FROM fit))",
            "er AS (SELECT fold, params, sqrt(avg((y - b0 - b1 * x1 - b2 * x2) * (y - b0 - b1 * x1 - b2 * x2))) AS rmse FROM fz JOIN co USING (fold) GROUP BY ALL)"]
    return _with(*ctes) + f"SELECT params, {sig('avg(rmse)')} AS avg_rmse FROM er GROUP BY params"


def _stump_ctes(tag: str, source: str, y: str, lam: float = 0) -> list[str]:
    """best{tag}(feature, threshold, ml, mr): the split of least squared error of ``source``, with ``lam``
    added to the rows of each side."""
    ctes = [f"tt{tag} AS (SELECT count(*) AS n, sum({y}) AS s FROM {source})"]
    cands = []
    for i, f in enumerate(Q.STUMP_FEATURES):
        ctes.append(f"g{tag}_{i} AS (SELECT CAST({f} AS DOUBLE) AS v, count(*) AS c, sum({y}) AS s FROM {source} GROUP BY {f})")
        ctes.append(f"c{tag}_{i} AS (SELECT v, sum(c) OVER (ORDER BY v) AS nl, sum(s) OVER (ORDER BY v) AS sl, "
                    f"lead(v) OVER (ORDER BY v) AS nv FROM g{tag}_{i})")
        cands.append(f"SELECT '{f}' AS feature, (v + nv) / 2 AS threshold, sl / (nl + {lam}) AS ml, (t.s - sl) / (t.n - nl + {lam}) AS mr, "
                     f"sl * sl / (nl + {lam}) + (t.s - sl) * (t.s - sl) / (t.n - nl + {lam}) AS score FROM c{tag}_{i}, tt{tag} t WHERE nv IS NOT NULL")
    ctes.append(f"best{tag} AS (SELECT * FROM ({' UNION ALL '.join(cands)}) ORDER BY score DESC LIMIT 1)")
    return ctes


def _left(tag: str) -> str:
    """Whether a row of the tables in scope goes left at best{tag}."""
    return f"(CASE best{tag}.feature " + " ".join(f"WHEN '{f}' THEN {f}" for f in Q.STUMP_FEATURES) + f" END <= best{tag}.threshold)"


def _tree_rows() -> list[str]:
    feats = Q.STUMP_FEATURES
    nn = " AND ".join(f"{c} IS NOT NULL" for c in ["delay", *feats])
    cols = f"l_orderkey, l_linenumber, delay AS y, {', '.join(feats)}"
    return [f"tr AS (SELECT {cols} FROM shipments WHERE {_is_train()} AND {nn})",
            f"te AS (SELECT {cols} FROM shipments WHERE NOT {_is_train()} AND {nn})"]


def deep_tree() -> str:
    feats = ", ".join(Q.DEEP_FEATURES)
    nn = " AND ".join(f"{c} IS NOT NULL" for c in ["delay", *Q.DEEP_FEATURES])
    return _with() + f"SELECT l_orderkey, l_linenumber, {rdp(f'avg(delay) OVER (PARTITION BY {feats})', 6)} AS prediction FROM shipments WHERE {nn}"


def rf_exact() -> str:
    ctes = [*_tree_rows(), *_stump_ctes("0", "tr", "y")]
    for tag, side in (("1", ""), ("2", "NOT ")):
        ctes.append(f"tr{tag} AS (SELECT tr.* FROM tr, best0 WHERE {side}{_left('0')})")
        ctes += _stump_ctes(tag, f"tr{tag}", "y")
    leaf = (f"CASE WHEN {_left('0')} THEN CASE WHEN {_left('1')} THEN best1.ml ELSE best1.mr END "
            f"ELSE CASE WHEN {_left('2')} THEN best2.ml ELSE best2.mr END END")
    return _with(*ctes) + (f"SELECT l_orderkey, l_linenumber, y AS label, {rdp(leaf, 6)} AS prediction "
                           "FROM te, best0, best1, best2")


def gbt_exact() -> str:
    one = f"CASE WHEN {_left('1')} THEN best1.ml ELSE best1.mr END"
    two = f"CASE WHEN {_left('2')} THEN best2.ml ELSE best2.mr END"
    ctes = [*_tree_rows(), *_stump_ctes("1", "tr", "y"),
            f"rs AS (SELECT tr.*, 2 * (y - {one}) AS r FROM tr, best1)",  # the squared loss's negative gradient
            *_stump_ctes("2", "rs", "r")]
    return _with(*ctes) + (f"SELECT l_orderkey, l_linenumber, y AS label, {rdp(f'{one} + 0.1::DOUBLE * ({two})', 6)} AS prediction "
                           "FROM te, best1, best2")


def boosted_regularized() -> str:
    """Each round fits what the sum so far leaves, leaf values shrunk by lambda and the rate."""
    one = f"0.3::DOUBLE * CASE WHEN {_left('1')} THEN best1.ml ELSE best1.mr END"
    two = f"0.3::DOUBLE * CASE WHEN {_left('2')} THEN best2.ml ELSE best2.mr END"
    ctes = [*_tree_rows(), "ba AS (SELECT avg(y) AS base FROM tr)", "r1 AS (SELECT tr.*, y - base AS r FROM tr, ba)",
            *_stump_ctes("1", "r1", "r", 1), f"r2 AS (SELECT r1.* EXCLUDE (r), r - {one} AS r FROM r1, best1)",
            *_stump_ctes("2", "r2", "r", 1)]
    return _with(*ctes) + (f"SELECT l_orderkey, l_linenumber, y AS label, {rdp(f'base + {one} + {two}', 6)} AS prediction "
                           "FROM te, ba, best1, best2")


def stream_score_events() -> str:
    split = ("((CAST(('0x' || substr(md5(CAST(event_id AS VARCHAR)), 1, 8)) AS BIGINT) % 10) < 8)")
    ctes = [
        "ev AS (SELECT event_id, event_type, CAST(hour(ts) AS DOUBLE) AS hour, value AS label FROM events)",
        f"tr AS (SELECT * FROM ev WHERE {split})",
        "lab AS (SELECT v, CAST(row_number() OVER (ORDER BY cnt DESC, v) - 1 AS DOUBLE) AS idx "
        "FROM (SELECT event_type AS v, count(*) AS cnt FROM tr WHERE event_type IS NOT NULL GROUP BY event_type))",
        "nl AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM lab)",
        "xe AS (SELECT ev.event_id, ev.label, coalesce(lab.idx, nl.n) AS x1, ev.hour AS x2 "
        "FROM ev LEFT JOIN lab ON ev.event_type = lab.v, nl)",
        f"xt AS (SELECT xe.* FROM xe JOIN tr ON xe.event_id = tr.event_id)",
        "mo AS (SELECT avg(label) AS my, avg(x1) AS m1, avg(x2) AS m2, var_pop(x1) AS s11, var_pop(x2) AS s22, "
        "covar_pop(x1, x2) AS s12, covar_pop(x1, label) AS s1y, covar_pop(x2, label) AS s2y FROM xt "
        "WHERE label IS NOT NULL AND x2 IS NOT NULL)",
        "bb AS (SELECT (s22 * s1y - s12 * s2y) / (s11 * s22 - s12 * s12) AS b1, "
        "(s11 * s2y - s12 * s1y) / (s11 * s22 - s12 * s12) AS b2, my, m1, m2 FROM mo)",
        "co AS (SELECT my - b1 * m1 - b2 * m2 AS b0, b1, b2 FROM bb)",
    ]
    return "WITH " + ",\n".join(ctes) + "\n" + (
        f"SELECT xe.event_id, xe.label, {rdp('co.b0 + co.b1 * xe.x1 + co.b2 * xe.x2', 4)} AS prediction "
        "FROM xe, co WHERE xe.x2 IS NOT NULL"
    )


def registry() -> dict[str, str]:
    return {
        "null_profile": null_profile(),
        "distinct_counts": distinct_counts(),
        "distinct_values": distinct_values(),
        "correlation_matrix": correlation_matrix(),
        "describe": describe(),
        "quartiles": quartiles(),
        "null_policy_60_5": null_policy_60_5(),
        "null_policy_60_5_apply": null_policy_60_5_apply(),
        "null_policy_40_10": null_policy_40_10(),
        "null_policy_40_10_apply": null_policy_40_10_apply(),
        "sweep_records": sweep_records(),
        "csv_overridden": csv_overridden(),
        "compacted": _all_rows(),
        "null_policy_thresh": null_policy_thresh(),
        "null_policy_thresh_apply": null_policy_thresh_apply(),
        "column_kinds": column_kinds(),
        "mean_impute": mean_impute(),
        "iqr_filter": iqr_filter(),
        "iqr_filter_apply": iqr_filter_apply(),
        "string_index": string_index(),
        "string_index_labels": string_index_labels(),
        "string_index_numeric": string_index_numeric(),
        "label_encode": label_encode(),
        "dictionary_encode": dictionary_encode(),
        "dictionary_large": dictionary_large(),
        "categorize_roundtrip": categorize_roundtrip(),
        "categorize_nulls": categorize_nulls(),
        "hash_split": hash_split(),
        "fold_assign": fold_assign(),
        "standard_scale": standard_scale(),
        "kfold_scale": kfold_scale(),
        "linreg_coeffs": linreg_coeffs(),
        "linreg_predict": linreg_predict(),
        "regression_metrics": regression_metrics(),
        "kfold_ols": kfold_ols(),
        "linreg_ridge": linreg_ridge(),
        "cv_grid_ridge": cv_grid_ridge(),
        "cv_grid_moments": cv_grid_moments(),
        "boosted_regularized": boosted_regularized(),
        "deep_tree": deep_tree(),
        "rf_exact": rf_exact(),
        "gbt_exact": gbt_exact(),
        "tree_stump": tree_stump(),
        "stream_score": linreg_predict(),
        "stream_resume": linreg_predict(),
        "stored_pipeline": linreg_predict(),
        "stream_score_events": stream_score_events(),
        "csv_roundtrip": _all_rows(),
        "convert_once": _all_rows(),
        "parquet_roundtrip": _all_rows(),
        "union_sources": union_sources(),
        "preview": preview(),
        "project_features": project_features(),
        "drop_columns": drop_columns(),
        "bulk_cast": bulk_cast(),
        "dropna_any": dropna_any(),
    }
