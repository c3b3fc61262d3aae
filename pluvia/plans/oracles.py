"""Building blocks of the independent SQL each registered query is checked against."""

from __future__ import annotations

from collections.abc import Sequence

# The model inputs, in order.
FEATURES = (
    "temperature_2m_max",
    "precipitation_lag_1", "precipitation_lag_2", "precipitation_lag_3",
    "temperature_lag_1", "temperature_lag_2", "temperature_lag_3",
)

DAILY = """
d AS (
  SELECT CAST(o_orderdate AS DATE) AS time,
         CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) / 1e6 AS precipitation_sum,
         max(o_totalprice) / 1e4 AS temperature_2m_max
  FROM orders GROUP BY 1
)"""

GAPPY = f"""{DAILY},
g AS (
  SELECT time,
         CASE WHEN day(time) = 17 THEN CAST('NaN' AS DOUBLE) ELSE precipitation_sum END AS precipitation_sum,
         CASE WHEN day(time) <> 13 THEN temperature_2m_max END AS temperature_2m_max
  FROM d
)"""


def event_series(key: str, name: str = "e") -> str:
    return f"""
{name} AS (
  SELECT {key}, CAST(ts AS DATE) AS time,
         CAST(sum(CAST(value AS DECIMAL(18, 2))) AS DOUBLE) AS precipitation_sum,
         max(value) AS temperature_2m_max
  FROM events GROUP BY 1, 2
)"""


def lag_columns(window: str, precipitation: str = "precipitation_sum", temperature: str = "temperature_2m_max", lags: int = 3) -> str:
    columns = [f"lead({precipitation}, 1) OVER ({window}) AS next_day_precipitation"]
    columns += [f"lag({precipitation}, {k}) OVER ({window}) AS precipitation_lag_{k}" for k in range(1, lags + 1)]
    columns += [f"lag({temperature}, {k}) OVER ({window}) AS temperature_lag_{k}" for k in range(1, lags + 1)]
    return ", ".join(columns)


def feature_frame(base: str, window: str, source: str, name: str = "f") -> str:
    """Lag features of ``source`` without the boundary rows, as CTE ``name``."""
    added = ["next_day_precipitation", *FEATURES[1:]]
    present = " AND ".join(f"{c} IS NOT NULL" for c in added)
    return f"""{base},
all_rows AS (SELECT *, {lag_columns(window)} FROM {source}),
{name} AS (SELECT * FROM all_rows WHERE {present})"""


def orthogonal(features: Sequence[str], prefix: str, source: str = "f") -> str:
    """Gram-Schmidt, twice: two CTEs per feature add its part that the earlier ones do not explain. The second pass
    takes away what rounding left of them in the first."""
    ctes, previous = [], source
    for k, x in enumerate(features):
        first, current = f"{prefix}h{k}", f"{prefix}g{k}"
        for name, of, start, made in ((first, x, f"{x} - (SELECT avg({x}) FROM {source})", f"{prefix}r{k}"), (current, f"{prefix}r{k}", f"{prefix}r{k}", f"{prefix}u{k}")):
            explained = "".join(f" - (SELECT regr_slope({of}, {prefix}u{j}) FROM {previous}) * {prefix}u{j}" for j in range(k))
            ctes.append(f"{name} AS MATERIALIZED (SELECT *, {start}{explained} AS {made} FROM {previous})")
            previous = name
    return ",\n".join(ctes)


def predictions(frame: str, keys: Sequence[str]) -> str:
    last = f"g{len(FEATURES) - 1}"
    y = "next_day_precipitation"
    fitted = f"(SELECT avg({y}) FROM f)" + "".join(f" + (SELECT regr_slope({y}, u{j}) FROM {last}) * u{j}" for j in range(len(FEATURES)))
    return f"""WITH {frame},
{orthogonal(FEATURES, "")}
SELECT {", ".join([*keys, *FEATURES])}, {y} AS actual_next_day_precipitation,
       round({fitted}, 6) AS predicted_next_day_precipitation
FROM {last}"""


def coefficients(frame: str) -> str:
    """The coefficient of a feature is the slope on its part not explained by all the others."""
    y, chains, rows = "next_day_precipitation", [], []
    for i, x in enumerate(FEATURES):
        others = [f for f in FEATURES if f != x]
        chains.append(orthogonal([*others, x], f"c{i}"))
        rows.append(f"SELECT '{x}' AS term, (SELECT regr_slope({y}, c{i}u{len(others)}) FROM c{i}g{len(others)}) AS c, (SELECT avg({x}) FROM f) AS m")
    chain, union = ",\n".join(chains), "\nUNION ALL ".join(rows)
    return f"""WITH {frame},
{chain},
terms AS ({union})
SELECT term, round(c, 6) AS coefficient FROM terms
UNION ALL
SELECT 'intercept', round((SELECT avg({y}) FROM f) - sum(c * m), 6) FROM terms"""


def grouped_coefficients(source: str, key: str, features: Sequence[str], y: str, least: float) -> str:
    """Least squares for each ``key``: the coefficient of a feature is the slope on its part not explained by all the others. Groups with a
    feature whose own part has a share of at most ``least`` of its variance are flagged and have none."""
    ctes, joins, terms = [], [], []
    for i, x in enumerate(features):
        previous, made = source, []
        for k, f in enumerate([*[f for f in features if f != x], x]):
            explained = "".join(f" - regr_slope({f}, {u}) OVER g * {u}" for u in made)
            name = f"c{i}_{k}"
            ctes.append(f"{name} AS MATERIALIZED (SELECT *, {f} - avg({f}) OVER g{explained} AS u{i}_{k} FROM {previous} WINDOW g AS (PARTITION BY {key}))")
            previous, made = name, [*made, f"u{i}_{k}"]
        ctes.append(f"t{i} AS (SELECT {key}, regr_slope({y}, {made[-1]}) AS b, avg({x}) AS m, var_pop({made[-1]}) <= {least} * var_pop({x}) AS d FROM {previous} GROUP BY 1)")
        joins.append(f"JOIN t{i} USING ({key})")
        terms.append((f"t{i}", x))
    flagged = " OR ".join(f"{t}.d" for t, _ in terms)
    level = f"avg_y - ({' + '.join(f'{t}.b * {t}.m' for t, _ in terms)})"
    columns = ", ".join(f"CASE WHEN NOT ({flagged}) THEN round({t}.b, 6) END AS {x}" for t, x in terms)
    return f"""{", ".join(ctes)}, n AS (SELECT {key}, CAST(count(*) AS BIGINT) AS n, avg({y}) AS avg_y FROM {source} GROUP BY 1)
SELECT {key}, n, ({flagged}) AS deficient, CASE WHEN NOT ({flagged}) THEN round({level}, 6) END AS intercept, {columns} FROM n {" ".join(joins)}"""
