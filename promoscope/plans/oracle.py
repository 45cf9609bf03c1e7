"""SQL text of the adapter views, shared by every oracle query.

DuckDB runs these over the driver's parquet views.  They state the
same views ``promoscope.sources.driver_tables`` builds with the
DataFrame API; FIXTURES.md documents them.
"""

from __future__ import annotations

USER_LOG = """
user_log AS (
  SELECT o_custkey AS user_id, l_partkey AS item_id, p_type AS cat_id,
         l_suppkey AS seller_id, p_brand AS brand_id,
         CAST(extract(month FROM o_orderdate) * 100 + extract(day FROM o_orderdate) AS INTEGER)
           AS time_stamp,
         CAST(CASE WHEN l_returnflag = 'A' THEN 1 WHEN l_returnflag = 'R' THEN 3
                   WHEN l_linestatus = 'O' THEN 2 ELSE 0 END AS INTEGER) AS action_type
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
       LEFT JOIN part ON l_partkey = p_partkey
       JOIN (VALUES (1), (2)) AS copies(copy) ON copy = 1 OR l_linenumber = 5)"""

USER_INFO = """
user_info AS (
  SELECT c_custkey AS user_id,
         CAST(CASE WHEN c_custkey % 10 = 9 THEN NULL ELSE c_custkey % 10 END AS INTEGER) AS age_range,
         CAST(CASE WHEN c_custkey % 4 = 3 THEN NULL ELSE c_custkey % 4 END AS INTEGER) AS gender
  FROM customer)"""

USER_INFO_TWICE = """
user_info_twice AS (
  SELECT * FROM user_info UNION ALL SELECT * FROM user_info WHERE user_id % 7 = 0)"""

PAIRS = """
later AS (
  SELECT user_id, seller_id % 10 AS class, count(*) AS n
  FROM user_log WHERE action_type = 2 AND time_stamp >= 701 GROUP BY user_id, seller_id % 10),
pairs AS (
  SELECT p.user_id, p.merchant_id,
         CAST(CASE WHEN coalesce(n, 0) >= 2 THEN 1 ELSE 0 END AS INTEGER) AS label
  FROM (SELECT DISTINCT user_id, seller_id AS merchant_id FROM user_log
        WHERE action_type = 2 AND time_stamp BETWEEN 601 AND 831) p
       LEFT JOIN later l ON p.user_id = l.user_id AND p.merchant_id % 10 = l.class),
train AS (SELECT * FROM pairs WHERE user_id % 2 = 0),
test AS (SELECT user_id, merchant_id, CAST(NULL AS DOUBLE) AS prob FROM pairs WHERE user_id % 2 = 1)"""

_FEATS = """
feats AS (
  SELECT user_id, seller_id AS merchant_id,
         count(item_id) AS total_logs,
         count(DISTINCT item_id) AS unique_item_ids,
         count(DISTINCT cat_id) AS categories,
         count(DISTINCT time_stamp) AS browse_days,
         count(CASE WHEN action_type = 0 THEN item_id END) AS one_clicks,
         count(CASE WHEN action_type = 1 THEN item_id END) AS shopping_carts,
         count(CASE WHEN action_type = 2 THEN item_id END) AS purchase_times,
         count(CASE WHEN action_type = 3 THEN item_id END) AS favourite_times
  FROM user_log WHERE {where} GROUP BY user_id, seller_id),
demo AS (
  SELECT user_id, nullif(age_range, 0) AS age_range, nullif(gender, 2) AS gender
  FROM user_info)"""

FEATS = _FEATS.format(where="true")
# Features of the pairs: from the log before the split day.
EARLY_FEATS = _FEATS.format(where="time_stamp < 701")

FEATURE_LIST = ("age_range, gender, total_logs, unique_item_ids, categories, browse_days, "
                "one_clicks, shopping_carts, purchase_times, favourite_times")
FEATURE_NAMES = [c.strip() for c in FEATURE_LIST.split(",")]


def feature_table_sql(pairs: str, name: str, head: str) -> str:
    cols = ", ".join(f"d.{c}" if c in ("age_range", "gender") else f"f.{c}"
                     for c in FEATURE_NAMES)
    return f"""
{name} AS (
  SELECT {head}, {cols}
  FROM {pairs} p LEFT JOIN feats f ON p.user_id = f.user_id AND p.merchant_id = f.merchant_id
       LEFT JOIN demo d ON p.user_id = d.user_id)"""


TRAIN_FEATURES = feature_table_sql("train", "train_features", "p.user_id, p.merchant_id, p.label")
TEST_FEATURES = feature_table_sql("test", "test_features", "p.user_id, p.merchant_id, p.prob")

_ORDER = "ORDER BY user_id, merchant_id"


def forward_fill_sql(source: str, name: str, head: str) -> str:
    w = f"({_ORDER} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    cols = ", ".join(f"last_value({c} IGNORE NULLS) OVER {w} AS {c}" for c in FEATURE_NAMES)
    return f"\n{name} AS (SELECT {head}, {cols} FROM {source})"


def backward_fill_sql(source: str, name: str, head: str) -> str:
    w = f"({_ORDER} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    cols = ", ".join(f"first_value({c} IGNORE NULLS) OVER {w} AS {c}" for c in FEATURE_NAMES)
    return f"\n{name} AS (SELECT {head}, {cols} FROM {source})"


TRAIN_FILLED = forward_fill_sql("train_features", "train_filled", "user_id, merchant_id, label")
TEST_FILLED = (
    backward_fill_sql("test_features", "test_back", "user_id, merchant_id, prob") + ","
    + forward_fill_sql("test_back", "test_fwd", "user_id, merchant_id, prob") + ",\n"
    + "test_filled AS (SELECT user_id, merchant_id, prob, "
    + ", ".join(f"coalesce({c}, 0) AS {c}" for c in FEATURE_NAMES) + " FROM test_fwd)")

# Rows the assembler keeps (no NULL feature), features as doubles.
ASSEMBLED = ("\nassembled AS (SELECT user_id, merchant_id, label, "
             + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in FEATURE_NAMES)
             + " FROM train_filled WHERE "
             + " AND ".join(f"{c} IS NOT NULL" for c in FEATURE_NAMES) + ")")


# Newton steps of the weighted logistic regression.
NEWTON_STEPS = 12


def _dot(z: str, b: str) -> str:
    return f"list_dot_product({z}, {b})"


def newton_ctes() -> str:
    """CTEs ending in ``fit``: its ``b`` holds intercept and coefficients of
    the class-weighted logistic regression on ``assembled``.

    Each step sums the gradient and the Hessian over all rows and solves
    for the step by elimination; a column that depends on those before
    it (a constant one, a sum of others) takes no part.
    """
    n = len(FEATURE_NAMES) + 1
    z = ", ".join(f"CASE WHEN s.{c} > 0 THEN a.{c} / s.{c} ELSE 0.0 END" for c in FEATURE_NAMES)
    out = ["\nsd AS MATERIALIZED (SELECT " + ", ".join(
        f"stddev_samp({c}) AS {c}" for c in FEATURE_NAMES)
        + ", (count(*) - count(*) FILTER (label = 1)) / count(*)::DOUBLE AS ratio FROM assembled)",
        f"\nx AS MATERIALIZED (SELECT a.label::DOUBLE AS y, [1.0, {z}]::DOUBLE[] AS z, "
        "CASE WHEN label = 1 THEN ratio ELSE 1 - ratio END AS w FROM assembled a, sd s)",
        f"\nb0 AS MATERIALIZED (SELECT list_transform(generate_series(1, {n}), lambda i: 0.0::DOUBLE) AS b)"]
    for t in range(1, NEWTON_STEPS + 1):
        rows = ", ".join("[" + ", ".join([f"sum(h * z[{min(i, j)}] * z[{max(i, j)}])" for j in range(1, n + 1)]
                                         + [f"sum(r * z[{i}])"]) + "]" for i in range(1, n + 1))
        out.append(
            f"\ng{t} AS MATERIALIZED (SELECT [{rows}] AS m FROM (SELECT z, w * p * (1 - p) AS h, w * (y - p) AS r "
            f"FROM (SELECT z, w, y, 1 / (1 + exp(-{_dot('z', 'b')})) AS p FROM x, b{t - 1})))")
        out.append(
            f"\ne{t} AS (SELECT 1 AS k, m, list_transform(m, lambda r, i: r[i]) AS d FROM g{t} UNION ALL "
            "SELECT k + 1, CASE WHEN m[k][k] <= 1e-9 * d[k] OR d[k] = 0 "
            "THEN list_transform(m, lambda r, i: CASE WHEN i = k THEN list_transform(r, lambda v: 0.0::DOUBLE) ELSE r END) "
            "ELSE list_transform(m, lambda r, i: CASE WHEN i = k THEN list_transform(r, lambda v: v / m[k][k]) "
            f"ELSE list_transform(r, lambda v, j: v - r[k] * m[k][j] / m[k][k]) END) END, d FROM e{t} WHERE k <= {n})")
        out.append(
            f"\nb{t} AS MATERIALIZED (SELECT list_transform(b, lambda v, i: v + m[i][{n + 1}]) AS b "
            f"FROM e{t}, b{t - 1} WHERE k = {n + 1})")
    # A dependent column leaves one direction in which the coefficients are
    # free.  A solver that starts at 0 does not move in it, measured in
    # features of weighted deviation 1: the least solution in that measure.
    spread = ", ".join(["0.0"] + [f"sum(w * z[{i}] * z[{i}]) - sum(w * z[{i}]) ** 2 / sum(w)" for i in range(2, n + 1)])
    out.append(f"\nwd AS MATERIALIZED (SELECT [{spread}]::DOUBLE[] AS s FROM x)")
    v = "list_transform(m, lambda r, i: CASE WHEN i = k THEN 1.0::DOUBLE ELSE -r[k] END)"
    out.append(
        f"\nfree AS (SELECT 1 AS k, m, s, d, b FROM e{NEWTON_STEPS}, b{NEWTON_STEPS}, wd WHERE k = {n + 1} UNION ALL "
        "SELECT k + 1, m, s, d, CASE WHEN m[k][k] = 0 AND d[k] > 0 THEN list_transform(b, lambda t, i: t - v[i] "
        "* list_sum(list_transform(v, lambda q, j: q * s[j] * b[j])) / list_sum(list_transform(v, lambda q, j: q * q * s[j]))) "
        f"ELSE b END FROM (SELECT *, {v} AS v FROM free WHERE k <= {n}))")
    out.append(f"\nfit AS MATERIALIZED (SELECT b FROM free WHERE k = {n + 1})")
    return ",".join(out)


def probability(row: str, scale: str) -> str:
    """The fit's probability of label 1, features of ``row`` scaled by ``scale``."""
    z = ", ".join(f"CASE WHEN {scale}.{c} > 0 THEN coalesce({row}.{c}, 0) / {scale}.{c} ELSE 0.0 END"
                  for c in FEATURE_NAMES)
    return f"1 / (1 + exp(-{_dot(f'[1.0, {z}]::DOUBLE[]', 'fit.b')}))"


# Users of which every seventh is listed twice, the second time otherwise.
USER_INFO_DIFFERING = """
user_info_differing AS (
  SELECT user_id, age_range, gender FROM user_info
  UNION ALL SELECT user_id, (coalesce(age_range, 0) + 3) % 9, 1 - gender % 2 FROM user_info WHERE user_id % 7 = 0)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


BASE = (USER_LOG, USER_INFO)
