"""Independent SQL (DuckDB dialect) for every SQL-expressible query.

Each statement starts from the base tables through the same chain of CTEs
(adapter -> cleaned observations -> features -> model rows -> split), so
the SQL engine recomputes everything on its own.
"""

from __future__ import annotations

from ..schema import CLASS_CUTS, CLASS_LABELS
from ..operators.modeling import STANDIN_NAMES
from ..schema import FEATURES

_CTES: dict[str, tuple[list[str], str]] = {}


def _cte(name: str, deps: list[str], body: str) -> None:
    _CTES[name] = (deps, body)


_cte("raw_obs", [], """
  SELECT concat('ST', cast(l.station_key AS varchar)) AS STATION,
         l.obs_date AS "DATE",
         cast(CASE WHEN l.station_key % 23 = 0 THEN NULL ELSE 20 + s.s_nationkey END AS double) AS LATITUDE,
         cast(CASE WHEN l.station_key % 23 = 0 THEN NULL ELSE 40 + s.s_nationkey END AS double) AS LONGITUDE,
         cast(CASE WHEN l.station_key % 19 = 0 THEN NULL ELSE l.station_key % 500 END AS double) AS ELEVATION,
         s.s_name AS NAME,
         cast(CASE WHEN l.pk % 7 = 0 THEN NULL ELSE l.pk % 300 END AS double) AS PRCP,
         cast(NULL AS varchar) AS PRCP_ATTRIBUTES,
         CASE WHEN l.pk % 11 = 0 THEN NULL ELSE l.q * 10 + round(l.disc * 1000) END AS TMAX,
         cast(NULL AS varchar) AS TMAX_ATTRIBUTES,
         CASE WHEN l.pk % 13 = 0 THEN NULL ELSE l.q * 10 - round(l.tax * 1000) END AS TMIN,
         cast(NULL AS varchar) AS TMIN_ATTRIBUTES,
         CASE WHEN l.pk % 17 = 0 THEN NULL ELSE l.q * 10 END AS TAVG,
         cast(NULL AS varchar) AS TAVG_ATTRIBUTES
  FROM (SELECT l_suppkey AS station_key, cast(l_shipdate AS date) AS obs_date,
               max(l_quantity) AS q, max(l_discount) AS disc,
               max(l_tax) AS tax, max(l_partkey) AS pk
        FROM lineitem
        GROUP BY l_suppkey, cast(l_shipdate AS date)) l
  JOIN supplier s ON s.s_suppkey = l.station_key""")

_cte("obs", ["raw_obs"], """
  SELECT STATION, "DATE", LATITUDE, LONGITUDE, ELEVATION, NAME,
         coalesce(P, 0.0) AS PRCP,
         coalesce(X, T + 5) AS TMAX,
         coalesce(N, T - 5) AS TMIN,
         T AS TAVG,
         cast(year("DATE") AS integer) AS "YEAR",
         cast(month("DATE") AS integer) AS "MONTH",
         cast(dayofyear("DATE") AS integer) AS DAY_OF_YEAR,
         CASE WHEN month("DATE") BETWEEN 3 AND 5 THEN 1
              WHEN month("DATE") BETWEEN 6 AND 8 THEN 2
              WHEN month("DATE") BETWEEN 9 AND 11 THEN 3
              ELSE 0 END AS SEASON,
         cast(year("DATE") // 10 AS integer) * 10 AS "DECADE",
         coalesce(X, T + 5) - coalesce(N, T - 5) AS TEMP_RANGE
  FROM (SELECT *, PRCP / 10.0 AS P, TMAX / 10.0 AS X, TMIN / 10.0 AS N, TAVG / 10.0 AS T
        FROM raw_obs
        WHERE "DATE" IS NOT NULL AND TAVG IS NOT NULL
          AND LATITUDE IS NOT NULL AND LONGITUDE IS NOT NULL) a""")

_cte("feat", ["obs"], """
  SELECT *, avg(TAVG) OVER (PARTITION BY STATION ORDER BY "DATE"
                            ROWS BETWEEN 30 PRECEDING AND CURRENT ROW) AS TAVG_30DAY_AVG
  FROM obs""")

_DOUBLE_FEATURES = ["LATITUDE", "LONGITUDE", "ELEVATION", "PRCP", "TMAX", "TMIN", "TEMP_RANGE",
                    "TAVG_30DAY_AVG", "TAVG"]
_cte("mrows", ["feat"], f"""
  SELECT STATION, "DATE", {", ".join(f'"{c}"' for c in FEATURES)}, TAVG
  FROM feat
  WHERE {" AND ".join(f'"{c}" IS NOT NULL' for c in FEATURES + ["TAVG"])}
    AND {" AND ".join(f"NOT isnan({c})" for c in _DOUBLE_FEATURES)}""")


def hash_unit_sql(salt: str) -> str:
    return ("cast(('0x' || substr(md5(concat_ws('|', '" + salt + "', STATION, "
            "cast(\"DATE\" AS varchar))), 1, 8))::bigint AS double) / 4294967296.0")


_cte("split", ["mrows"], f"""
  SELECT *, {hash_unit_sql('split:42')} < 0.8 AS IS_TRAIN FROM mrows""")

_cte("month_means", ["split"], """
  SELECT "MONTH", avg(TAVG) AS MONTH_MEAN FROM split WHERE IS_TRAIN GROUP BY "MONTH" """)

_cte("scored", ["split", "month_means"], f"""
  SELECT STATION, "DATE", '{STANDIN_NAMES[0]}' AS MODEL, TAVG, (TMAX + TMIN) / 2 AS prediction
  FROM split WHERE NOT IS_TRAIN
  UNION ALL
  SELECT STATION, "DATE", '{STANDIN_NAMES[1]}', TAVG, TAVG_30DAY_AVG FROM split WHERE NOT IS_TRAIN
  UNION ALL
  SELECT s.STATION, s."DATE", '{STANDIN_NAMES[2]}', s.TAVG, m.MONTH_MEAN
  FROM split s LEFT JOIN month_means m ON s."MONTH" = m."MONTH" WHERE NOT s.IS_TRAIN""")


def value_class_sql(x: str) -> str:
    whens = " ".join(f"WHEN {x} <= {float(c)} THEN {i}" for i, c in enumerate(CLASS_CUTS))
    return (f"CASE {whens} WHEN {x} IS NOT NULL AND NOT isnan({x}) "
            f"THEN {len(CLASS_CUTS)} END")


_LABELS = "[" + ", ".join(f"'{x}'" for x in CLASS_LABELS) + "]"

_cte("confusion", ["scored"], f"""
  SELECT MODEL, TRUE_CLASS, PRED_CLASS, count(*) AS "COUNT"
  FROM (SELECT MODEL, {value_class_sql('TAVG')} AS TRUE_CLASS,
               {value_class_sql('prediction')} AS PRED_CLASS FROM scored) c
  WHERE TRUE_CLASS IS NOT NULL AND PRED_CLASS IS NOT NULL
  GROUP BY MODEL, TRUE_CLASS, PRED_CLASS""")

_cte("per_class", ["confusion"], f"""
  SELECT g.MODEL, g.CLASS, {_LABELS}[g.CLASS + 1] AS CLASS_LABEL,
         coalesce(cast(coalesce(t.TP, 0) AS double) / nullif(coalesce(p.PREDICTED, 0), 0), 0.0) AS "PRECISION",
         coalesce(cast(coalesce(t.TP, 0) AS double) / nullif(coalesce(t.SUPPORT, 0), 0), 0.0) AS RECALL,
         coalesce(2 * cast(coalesce(t.TP, 0) AS double)
                  / nullif(coalesce(p.PREDICTED, 0) + coalesce(t.SUPPORT, 0), 0), 0.0) AS F1,
         cast(coalesce(t.SUPPORT, 0) AS bigint) AS SUPPORT,
         cast(coalesce(p.PREDICTED, 0) AS bigint) AS PREDICTED,
         cast(coalesce(t.TP, 0) AS bigint) AS TP
  FROM (SELECT m.MODEL, cast(c.range AS integer) AS CLASS
        FROM (SELECT DISTINCT MODEL FROM confusion) m CROSS JOIN range(0, {len(CLASS_CUTS) + 1}) c) g
  LEFT JOIN (SELECT MODEL, TRUE_CLASS AS CLASS, sum("COUNT") AS SUPPORT,
                    sum(CASE WHEN TRUE_CLASS = PRED_CLASS THEN "COUNT" ELSE 0 END) AS TP
             FROM confusion GROUP BY MODEL, TRUE_CLASS) t
         ON t.MODEL = g.MODEL AND t.CLASS = g.CLASS
  LEFT JOIN (SELECT MODEL, PRED_CLASS AS CLASS, sum("COUNT") AS PREDICTED
             FROM confusion GROUP BY MODEL, PRED_CLASS) p
         ON p.MODEL = g.MODEL AND p.CLASS = g.CLASS""")

_cte("class_metrics", ["per_class"], """
  SELECT MODEL,
         cast(sum(TP) AS double) / nullif(sum(SUPPORT), 0) AS ACCURACY,
         sum("PRECISION" * SUPPORT) / nullif(sum(SUPPORT), 0) AS "PRECISION",
         sum(RECALL * SUPPORT) / nullif(sum(SUPPORT), 0) AS RECALL,
         sum(F1 * SUPPORT) / nullif(sum(SUPPORT), 0) AS F1
  FROM per_class GROUP BY MODEL""")

_cte("reg_metrics", ["scored"], f"""
  SELECT MODEL, N_ROWS, N_SKIPPED, sqrt(MSE) AS RMSE, MSE, MAE, R2,
         1 - (1 - R2) * cast(N_ROWS - 1 AS double) / nullif(cast(N_ROWS - {len(FEATURES)} - 1 AS double), 0) AS ADJ_R2,
         MAPE, TOLERANCE_ACCURACY
  FROM (SELECT MODEL, count(*) FILTER (WHERE TAVG IS NOT NULL AND prediction IS NOT NULL) AS N_ROWS,
               count(*) FILTER (WHERE TAVG IS NULL OR prediction IS NULL) AS N_SKIPPED,
               avg((TAVG - prediction) * (TAVG - prediction)) AS MSE,
               avg(abs(TAVG - prediction)) AS MAE,
               CASE WHEN var_pop(TAVG) = 0
                    THEN CASE WHEN avg((TAVG - prediction) * (TAVG - prediction)) = 0 THEN 1.0 ELSE 0.0 END
                    ELSE 1 - avg((TAVG - prediction) * (TAVG - prediction)) / var_pop(TAVG) END AS R2,
               avg(abs((TAVG - prediction) / nullif(TAVG + 1e-10, 0))) * 100 AS MAPE,
               avg(cast(abs(TAVG - prediction) <= 2.0 AS double)) * 100 AS TOLERANCE_ACCURACY
        FROM scored GROUP BY MODEL) r""")

_MODEL_LIST = "[" + ", ".join(f"'{x}'" for x in STANDIN_NAMES) + "]"
_cte("comparison", ["reg_metrics", "class_metrics"], f"""
  SELECT r.MODEL, cast(list_position({_MODEL_LIST}, r.MODEL) AS integer) AS MODEL_ORDER,
         substr(r.MODEL, 1, 15) AS MODEL_SHORT,
         RMSE, MAE, R2, ADJ_R2, MAPE, ACCURACY, "PRECISION", RECALL, F1, TOLERANCE_ACCURACY, N_ROWS
  FROM reg_metrics r LEFT JOIN class_metrics c ON r.MODEL = c.MODEL""")

_cte("max_year", ["obs"], """SELECT max("YEAR") AS MAX_YEAR FROM obs""")

_cte("baseline", ["obs", "max_year"], """
  SELECT MAX_YEAR, avg(LATITUDE) AS LAT, avg(LONGITUDE) AS LON, avg(ELEVATION) AS ELEV,
         avg(PRCP) AS PRCP_MEAN, avg(TAVG) AS TAVG_BASELINE, count(TAVG) AS N_ROWS
  FROM obs CROSS JOIN max_year WHERE "YEAR" >= MAX_YEAR - 5 GROUP BY MAX_YEAR""")

_cte("clim", ["obs", "max_year"], """
  SELECT "MONTH", avg(TMAX) AS AVG_TMAX, avg(TMIN) AS AVG_TMIN, avg(TAVG) AS AVG_TAVG,
         count(TAVG) AS N_ROWS
  FROM obs CROSS JOIN max_year WHERE "YEAR" >= MAX_YEAR - 10 GROUP BY "MONTH" """)

_GRID_SELECT = """
         cast(dayofyear(make_date(g."YEAR", g."MONTH", 15)) AS integer) AS DAY_OF_YEAR,
         g.LAT AS LATITUDE, g.LON AS LONGITUDE, g.ELEV AS ELEVATION, g.PRCP_MEAN AS PRCP,
         c.AVG_TMAX AS TMAX, c.AVG_TMIN AS TMIN, c.AVG_TMAX - c.AVG_TMIN AS TEMP_RANGE,
         CASE WHEN g."MONTH" BETWEEN 3 AND 5 THEN 1 WHEN g."MONTH" BETWEEN 6 AND 8 THEN 2
              WHEN g."MONTH" BETWEEN 9 AND 11 THEN 3 ELSE 0 END AS SEASON,
         c.AVG_TAVG AS TAVG_30DAY_AVG"""

_cte("grid", ["baseline", "clim"], f"""
  SELECT g."YEAR", g."MONTH", {_GRID_SELECT}
  FROM (SELECT b.*, cast(y.range AS integer) AS "YEAR", cast(m.range AS integer) AS "MONTH"
        FROM baseline b
        CROSS JOIN LATERAL (SELECT unnest(range(b.MAX_YEAR + 1, b.MAX_YEAR + 11)) AS range) y
        CROSS JOIN range(1, 13) m) g
  LEFT JOIN clim c ON c."MONTH" = g."MONTH" """)

_cte("baseline_st", ["obs", "max_year"], """
  SELECT STATION, MAX_YEAR, avg(LATITUDE) AS LAT, avg(LONGITUDE) AS LON, avg(ELEVATION) AS ELEV,
         avg(PRCP) AS PRCP_MEAN
  FROM obs CROSS JOIN max_year WHERE "YEAR" >= MAX_YEAR - 5 GROUP BY STATION, MAX_YEAR""")

_cte("clim_st", ["obs", "max_year"], """
  SELECT STATION, "MONTH", avg(TMAX) AS AVG_TMAX, avg(TMIN) AS AVG_TMIN, avg(TAVG) AS AVG_TAVG
  FROM obs CROSS JOIN max_year WHERE "YEAR" >= MAX_YEAR - 10 GROUP BY STATION, "MONTH" """)

_cte("grid_st", ["baseline_st", "clim_st"], f"""
  SELECT g.STATION, g."YEAR", g."MONTH", {_GRID_SELECT}
  FROM (SELECT b.*, cast(y.range AS integer) AS "YEAR", cast(m.range AS integer) AS "MONTH"
        FROM baseline_st b
        CROSS JOIN LATERAL (SELECT unnest(range(b.MAX_YEAR + 1, b.MAX_YEAR + 11)) AS range) y
        CROSS JOIN range(1, 13) m) g
  LEFT JOIN clim_st c ON c.STATION = g.STATION AND c."MONTH" = g."MONTH" """)

_cte("forecast_yearly", ["grid"], f"""
  SELECT "YEAR", avg((TMAX + TMIN) / 2) AS PREDICTED_TEMP
  FROM grid WHERE {" AND ".join(f'"{c}" IS NOT NULL' for c in FEATURES)}
  GROUP BY "YEAR" """)

_cte("yearly_since_1950", ["obs"], """
  SELECT "YEAR", avg(TAVG) AS AVG_TEMP FROM obs WHERE "DATE" >= DATE '1950-01-01' GROUP BY "YEAR" """)

_cte("yearly_since_2000", ["obs"], """
  SELECT "YEAR", avg(TAVG) AS AVG_TEMP FROM obs WHERE "DATE" >= DATE '2000-01-01' GROUP BY "YEAR" """)


def with_ctes(*names: str) -> str:
    """WITH clause holding ``names`` and everything they depend on, in order."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in _CTES[n][0]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    return "WITH " + ",\n".join(f"{n} AS ({_CTES[n][1]}\n)" for n in order) + "\n"


def rounded(sql: str, double_cols: list[str], digits: int = 6) -> str:
    """Wrap ``sql`` so the listed double columns come out rounded."""
    if not double_cols:
        return sql
    # "+ 0.0" turns a rounded -0.0 into 0.0, as Spark's rounding does
    reps = ", ".join(f'round("{c}", {digits}) + 0.0 AS "{c}"' for c in double_cols)
    return f"SELECT * REPLACE ({reps}) FROM (\n{sql}\n) q"
