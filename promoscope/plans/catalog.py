"""The query catalogue: every operator as a named query over the driver
tables, each with its DuckDB oracle SQL where one exists.

A query is ``fn(spark, sf_dir) -> DataFrame``.  All of them read the
whole driver tables through the adapter views; none caps, samples or
subsets rows (``limit`` appears only in the top-k queries, where it is
the feature).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promoscope.functions.text import ranked_line
from promoscope.functions.vectors import vector_values
from promoscope.operators import demographics as demo
from promoscope.operators import features as feat
from promoscope.operators import filters as flt
from promoscope.operators import popularity as pop
from promoscope.operators import scoring
from promoscope.plans import oracle as sql
from promoscope.schemas import FEATURES, LOG_COLUMNS, PROMO_DAY, TEXT_CODED_LOG, TOP_K
from promoscope.session import scratch_folder, written
from promoscope.sources import sinks
from promoscope.sources.driver_tables import Tables
from promoscope.sources.files import lines_of, parse_log_lines, parse_user_lines, read_lines

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


DAY = PROMO_DAY
# A wide window, in which more items and merchants compete than k.
NOVEMBER = (1101, 1130)
FEW = 10

# Log columns each family of queries reads; asking only for these keeps
# the part table (category, brand) out of plans that do not use it.
ITEM_COLS = ("user_id", "item_id", "time_stamp", "action_type")
MERCHANT_COLS = ("user_id", "item_id", "seller_id", "time_stamp", "action_type")
BASE = sql.with_ctes(*sql.BASE)
WITH_PAIRS = sql.with_ctes(*sql.BASE, sql.PAIRS)
WITH_TWICE = sql.with_ctes(*sql.BASE, sql.USER_INFO_TWICE)

# ---------------------------------------------------------------- sources
register("user_log_scan", BASE + "SELECT * FROM user_log")(
    lambda spark, d: Tables(spark, d).user_log())
register("user_info_scan", BASE + "SELECT * FROM user_info")(
    lambda spark, d: Tables(spark, d).user_info())
register("train_pairs", WITH_PAIRS + "SELECT * FROM train")(
    lambda spark, d: Tables(spark, d).train_pairs())
register("test_pairs", WITH_PAIRS + "SELECT * FROM test")(
    lambda spark, d: Tables(spark, d).test_pairs())

# ---------------------------------------------------------------- filters
register("promo_non_click",
         BASE + f"SELECT * FROM user_log WHERE time_stamp = {DAY} AND action_type <> 0")(
    lambda spark, d: flt.promo_non_click(Tables(spark, d).user_log(), DAY))
register("promo_purchases",
         BASE + f"SELECT * FROM user_log WHERE time_stamp = {DAY} AND action_type = 2")(
    lambda spark, d: flt.promo_purchases(Tables(spark, d).user_log(), DAY))
register("user_info_twice_scan", WITH_TWICE + "SELECT * FROM user_info_twice")(
    lambda spark, d: Tables(spark, d).user_info_twice())
register("young_users", BASE + "SELECT * FROM user_info WHERE age_range IN (1, 2, 3)")(
    lambda spark, d: flt.young_users(Tables(spark, d).user_info()))
register("known_gender", BASE + "SELECT * FROM user_info WHERE gender IN (0, 1)")(
    lambda spark, d: flt.with_known_gender(Tables(spark, d).user_info()))
register("known_age_strict",
         BASE + "SELECT * FROM user_info WHERE age_range IS NOT NULL AND age_range <> 0")(
    lambda spark, d: flt.with_known_age(Tables(spark, d).user_info(), "drop"))
register("known_age_lenient", BASE + "SELECT * FROM user_info WHERE age_range IS NOT NULL")(
    lambda spark, d: flt.with_known_age(Tables(spark, d).user_info(), "keep_zero"))

# ---------------------------------------------------------------- dedup
register("dedup_user_item_action",
         BASE + f"SELECT DISTINCT user_id, item_id, action_type FROM user_log "
                f"WHERE time_stamp = {DAY} AND action_type <> 0")(
    lambda spark, d: pop.dedup_user_item_action(Tables(spark, d).user_log(ITEM_COLS), DAY))
register("dedup_user_item_seller_action",
         BASE + f"SELECT DISTINCT user_id, item_id, seller_id, action_type FROM user_log "
                f"WHERE time_stamp = {DAY} AND action_type <> 0")(
    lambda spark, d: pop.dedup_user_item_seller_action(
        Tables(spark, d).user_log(MERCHANT_COLS), DAY))

# ---------------------------------------------------------------- A1 popularity
_ITEM_COUNTS = (f"SELECT item_id, count(*) AS number FROM ("
                f"SELECT DISTINCT user_id, item_id, action_type FROM user_log "
                f"WHERE time_stamp = {DAY} AND action_type <> 0) GROUP BY item_id")
register("top_items",
         BASE + _ITEM_COUNTS + f" ORDER BY number DESC, item_id LIMIT {TOP_K}")(
    lambda spark, d: pop.top_items(Tables(spark, d).user_log(ITEM_COLS), DAY))
_RANKED_ITEMS = (f"ranked AS (SELECT CAST(row_number() OVER (ORDER BY number DESC, item_id) "
                 f"AS INTEGER) AS rank, "
                 f"item_id, number FROM ({_ITEM_COUNTS}) ORDER BY number DESC, item_id "
                 f"LIMIT {TOP_K})")
register("top_items_ranked",
         sql.with_ctes(*sql.BASE, _RANKED_ITEMS) + "SELECT * FROM ranked")(
    lambda spark, d: pop.top_items(Tables(spark, d).user_log(ITEM_COLS), DAY, with_rank=True))
register("top_items_raw_counts",
         BASE + f"SELECT item_id, count(*) AS number FROM user_log "
                f"WHERE time_stamp = {DAY} AND action_type <> 0 GROUP BY item_id")(
    lambda spark, d: pop.item_counts(Tables(spark, d).user_log(ITEM_COLS), DAY, dedup=False))


_ITEMS_NOVEMBER = (f"SELECT item_id, count(*) AS number FROM ("
                   f"SELECT DISTINCT user_id, item_id, action_type FROM user_log "
                   f"WHERE time_stamp BETWEEN {NOVEMBER[0]} AND {NOVEMBER[1]} AND action_type <> 0) "
                   f"GROUP BY item_id ORDER BY number DESC, item_id LIMIT {TOP_K}")
register("top_items_november", BASE + _ITEMS_NOVEMBER)(
    lambda spark, d: pop.top_items(Tables(spark, d).user_log(ITEM_COLS), *NOVEMBER))


def _ranked_top_items(spark: SparkSession, d: str) -> DataFrame:
    return pop.top_items(Tables(spark, d).user_log(ITEM_COLS), DAY, with_rank=True)


def _ranked_lines(spark: SparkSession, d: str) -> DataFrame:
    top = _ranked_top_items(spark, d)
    return top.select(ranked_line("rank", "item_id", "number").alias("line"))


register("ranked_lines",
         sql.with_ctes(*sql.BASE, _RANKED_ITEMS)
         + "SELECT CAST(rank AS VARCHAR) || chr(9) || CAST(item_id AS VARCHAR) || ', ' "
           "|| CAST(number AS VARCHAR) AS line FROM ranked")(_ranked_lines)


def _ranked_csv_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_folder(spark, "ranked-csv")
    sinks.write_ranked_csv(_ranked_top_items(spark, d), path, "item_id")
    return (spark.read.option("header", True).schema("item_id long, Number long").csv(path)
            .withColumnRenamed("Number", "number"))


def _ranked_text_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_folder(spark, "ranked-text")
    sinks.write_ranked_text(_ranked_top_items(spark, d), path, "item_id")
    return read_lines(spark, path).withColumnRenamed("value", "line")


register("ranked_csv_roundtrip", ORACLES["top_items"])(_ranked_csv_roundtrip)
register("ranked_text_roundtrip", ORACLES["ranked_lines"])(_ranked_text_roundtrip)

# ---------------------------------------------------------------- A2 merchants
_YOUNG_DEDUP = (f"SELECT DISTINCT user_id, item_id, seller_id, action_type FROM user_log "
                f"WHERE time_stamp = {DAY} AND action_type <> 0")
_MERCHANTS_SEMI = (f"SELECT seller_id AS merchant_id, count(*) AS number FROM ({_YOUNG_DEDUP}) k "
                   f"WHERE user_id IN (SELECT user_id FROM user_info WHERE age_range IN (1, 2, 3)) "
                   f"GROUP BY seller_id")
register("merchants_young_semi", BASE + _MERCHANTS_SEMI)(
    lambda spark, d: pop.merchant_counts(Tables(spark, d).user_log(MERCHANT_COLS), Tables(spark, d).user_info(),
                                         DAY, join="semi"))
register("merchants_young_inner",
         BASE + f"SELECT k.seller_id AS merchant_id, count(*) AS number FROM ({_YOUNG_DEDUP}) k "
                f"JOIN user_info u ON k.user_id = u.user_id WHERE u.age_range IN (1, 2, 3) "
                f"GROUP BY k.seller_id")(
    lambda spark, d: pop.merchant_counts(Tables(spark, d).user_log(MERCHANT_COLS), Tables(spark, d).user_info(),
                                         DAY, join="inner"))
register("top_merchants_young",
         BASE + f"SELECT CAST(row_number() OVER (ORDER BY number DESC, merchant_id) AS INTEGER) "
                f"AS rank, "
                f"merchant_id, number FROM ({_MERCHANTS_SEMI}) "
                f"ORDER BY number DESC, merchant_id LIMIT {TOP_K}")(
    lambda spark, d: pop.top_merchants(Tables(spark, d).user_log(MERCHANT_COLS), Tables(spark, d).user_info(),
                                       DAY))


def _merchants_twice(join: str) -> Query:
    def run(spark: SparkSession, d: str) -> DataFrame:
        t = Tables(spark, d)
        return pop.merchant_counts(t.user_log(MERCHANT_COLS), t.user_info_twice(), *NOVEMBER, join=join)
    return run


_NOVEMBER_DEDUP = _YOUNG_DEDUP.replace(f"time_stamp = {DAY}",
                                       f"time_stamp BETWEEN {NOVEMBER[0]} AND {NOVEMBER[1]}")
_NOVEMBER_SEMI = _MERCHANTS_SEMI.replace(_YOUNG_DEDUP, _NOVEMBER_DEDUP)
# Users listed twice: the semi join counts their rows once, the inner join twice.
register("merchants_twice_semi", BASE + _NOVEMBER_SEMI)(_merchants_twice("semi"))
register("merchants_twice_inner",
         WITH_TWICE + f"SELECT k.seller_id AS merchant_id, count(*) AS number FROM ({_NOVEMBER_DEDUP}) k "
                      f"JOIN user_info_twice u ON k.user_id = u.user_id "
                      f"WHERE u.age_range IN (1, 2, 3) GROUP BY k.seller_id")(_merchants_twice("inner"))
register("top_merchants_november_10",
         BASE + f"SELECT CAST(row_number() OVER (ORDER BY number DESC, merchant_id) AS INTEGER) AS rank, "
                f"merchant_id, number FROM ({_NOVEMBER_SEMI}) ORDER BY number DESC, merchant_id LIMIT {FEW}")(
    lambda spark, d: pop.top_merchants(Tables(spark, d).user_log(MERCHANT_COLS),
                                       Tables(spark, d).user_info(), *NOVEMBER, k=FEW))

# ---------------------------------------------------------------- A3 / A4 demographics
_BUYERS = (f"buyers AS (SELECT * FROM user_info WHERE user_id IN "
           f"(SELECT user_id FROM user_log WHERE time_stamp = {DAY} AND action_type = 2))")
WITH_BUYERS = sql.with_ctes(*sql.BASE, _BUYERS)


def _buyers(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    return demo.buyers(t.user_log(("user_id", "time_stamp", "action_type")), t.user_info(), DAY)


def _share_sql(column: str, where: str) -> str:
    return (WITH_BUYERS
            + f", g AS (SELECT {column}, count(*) AS count FROM buyers WHERE {where} "
              f"GROUP BY {column}), t AS (SELECT *, sum(count) OVER () AS total FROM g), "
              f"h AS (SELECT *, CAST(floor((count * 20000 + total) / (total * 2.0)) AS BIGINT) "
              f"AS hundredths FROM t) "
              f"SELECT {column}, count, CAST(count AS DOUBLE) / CAST(total AS DOUBLE) AS proportion, "
              f"printf('%d.%02d%%', hundredths // 100, hundredths % 100) AS percent FROM h")


register("buyers", WITH_BUYERS + "SELECT * FROM buyers")(_buyers)


def _buyers_one_per_user(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    return demo.buyers(t.user_log(("user_id", "time_stamp", "action_type")), t.user_info(), DAY,
                       one_row_per_user=True)


# user_id is unique in the user view, so any kept row is the only row.
register("buyers_one_per_user",
         WITH_BUYERS + "SELECT user_id, min(age_range) AS age_range, min(gender) AS gender "
                       "FROM buyers GROUP BY user_id")(_buyers_one_per_user)


def _buyers_twice(one_row_per_user: bool) -> Query:
    def run(spark: SparkSession, d: str) -> DataFrame:
        t = Tables(spark, d)
        return demo.buyers(t.user_log(("user_id", "time_stamp", "action_type")), t.user_info_twice(),
                           *NOVEMBER, one_row_per_user=one_row_per_user)
    return run


_BUYERS_TWICE = (f"b AS (SELECT * FROM user_info_twice WHERE user_id IN (SELECT user_id FROM user_log "
                 f"WHERE time_stamp BETWEEN {NOVEMBER[0]} AND {NOVEMBER[1]} AND action_type = 2))")
_WITH_BUYERS_TWICE = sql.with_ctes(*sql.BASE, sql.USER_INFO_TWICE, _BUYERS_TWICE)
register("buyers_twice", _WITH_BUYERS_TWICE + "SELECT * FROM b")(_buyers_twice(False))
register("buyers_twice_one_per_user", _WITH_BUYERS_TWICE + "SELECT DISTINCT * FROM b")(_buyers_twice(True))
# A user's two rows differ here: the least one stays, nulls first.
def _buyers_differing(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    return demo.buyers(t.user_log(("user_id", "time_stamp", "action_type")), t.user_info_differing(),
                       *NOVEMBER, one_row_per_user=True)


register("buyers_differing_one_per_user",
         sql.with_ctes(*sql.BASE, sql.USER_INFO_DIFFERING, _BUYERS_TWICE.replace("_twice", "_differing"))
         + "SELECT user_id, age_range, gender FROM (SELECT *, row_number() OVER (PARTITION BY user_id "
           "ORDER BY age_range NULLS FIRST, gender NULLS FIRST) AS k FROM b) WHERE k = 1")(_buyers_differing)
register("buyers_by_gender",
         WITH_BUYERS + "SELECT gender, count(*) AS count FROM buyers WHERE gender IN (0, 1) "
                       "GROUP BY gender")(
    lambda spark, d: demo.buyers_by_gender(_buyers(spark, d)))
register("gender_ratio",
         WITH_BUYERS + "SELECT male, female, CAST(male AS DOUBLE) / CAST(nullif(female, 0) AS DOUBLE)"
                       " AS ratio FROM (SELECT count(*) FILTER (WHERE gender = 1) AS male, "
                       "count(*) FILTER (WHERE gender = 0) AS female FROM buyers "
                       "WHERE gender IN (0, 1))")(
    lambda spark, d: demo.gender_ratio(_buyers(spark, d)))
register("gender_share", _share_sql("gender", "gender IN (0, 1)"))(
    lambda spark, d: demo.gender_share(_buyers(spark, d)))
register("buyers_by_age_strict",
         WITH_BUYERS + "SELECT age_range, count(*) AS count FROM buyers "
                       "WHERE age_range IS NOT NULL AND age_range <> 0 GROUP BY age_range")(
    lambda spark, d: demo.buyers_by_age(_buyers(spark, d), "drop"))
register("buyers_by_age_lenient",
         WITH_BUYERS + "SELECT age_range, count(*) AS count FROM buyers "
                       "WHERE age_range IS NOT NULL GROUP BY age_range")(
    lambda spark, d: demo.buyers_by_age(_buyers(spark, d), "keep_zero"))
register("age_share", _share_sql("age_range", "age_range IS NOT NULL"))(
    lambda spark, d: demo.age_share(_buyers(spark, d), "keep_zero"))
register("age_share_strict", _share_sql("age_range", "age_range IS NOT NULL AND age_range <> 0"))(
    lambda spark, d: demo.age_share(_buyers(spark, d), "drop"))

# ---------------------------------------------------------------- A5 features
_PER_PAIR = "SELECT user_id, seller_id AS merchant_id, {agg} FROM user_log GROUP BY user_id, seller_id"
register("feat_total_logs", BASE + _PER_PAIR.format(agg="count(item_id) AS total_logs"))(
    lambda spark, d: feat.total_logs(Tables(spark, d).user_log(("user_id", "seller_id", "item_id"))))
register("feat_unique_items",
         BASE + _PER_PAIR.format(agg="count(DISTINCT item_id) AS unique_item_ids"))(
    lambda spark, d: feat.unique_items(Tables(spark, d).user_log(("user_id", "seller_id", "item_id"))))
register("feat_categories", BASE + _PER_PAIR.format(agg="count(DISTINCT cat_id) AS categories"))(
    lambda spark, d: feat.categories(Tables(spark, d).user_log(("user_id", "seller_id", "cat_id"))))
register("feat_browse_days",
         BASE + _PER_PAIR.format(agg="count(DISTINCT time_stamp) AS browse_days"))(
    lambda spark, d: feat.browse_days(
        Tables(spark, d).user_log(("user_id", "seller_id", "time_stamp"))))
register("feat_actions_long",
         BASE + "SELECT user_id, seller_id AS merchant_id, action_type, count(item_id) AS times "
                "FROM user_log GROUP BY user_id, seller_id, action_type")(
    lambda spark, d: feat.action_counts(
        Tables(spark, d).user_log(("user_id", "seller_id", "item_id", "action_type"))))
register("feat_actions_wide",
         BASE + _PER_PAIR.format(agg=", ".join(
             f"count(CASE WHEN action_type = {k} THEN item_id END) AS {n}"
             for n, k in feat.ACTION_FEATURES)))(
    lambda spark, d: feat.action_features(
        Tables(spark, d).user_log(("user_id", "seller_id", "item_id", "action_type"))))
register("behaviour_features", sql.with_ctes(*sql.BASE, sql.FEATS) + "SELECT * FROM feats")(
    lambda spark, d: feat.behaviour_features(Tables(spark, d).user_log()))
register("demographics_clean", sql.with_ctes(*sql.BASE, sql.FEATS) + "SELECT * FROM demo")(
    lambda spark, d: feat.clean_demographics(Tables(spark, d).user_info()))


def _train_features(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    return feat.feature_table(t.train_pairs(), t.user_info(),
                              feat.behaviour_features(t.log_before_split()))


def _test_features(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    return feat.feature_table(t.test_pairs(), t.user_info(),
                              feat.behaviour_features(t.log_before_split()))


WITH_TRAIN_FEATURES = sql.with_ctes(*sql.BASE, sql.PAIRS, sql.EARLY_FEATS, sql.TRAIN_FEATURES)
WITH_TEST_FEATURES = sql.with_ctes(*sql.BASE, sql.PAIRS, sql.EARLY_FEATS, sql.TEST_FEATURES)
register("train_features", WITH_TRAIN_FEATURES + "SELECT * FROM train_features")(_train_features)
register("test_features", WITH_TEST_FEATURES + "SELECT * FROM test_features")(_test_features)

# ---------------------------------------------------------------- fills


def _train_filled(spark: SparkSession, d: str) -> DataFrame:
    return scoring.fill_train(_train_features(spark, d))


def _test_filled(spark: SparkSession, d: str) -> DataFrame:
    return scoring.fill_test(_test_features(spark, d))


WITH_TRAIN_FILLED = sql.with_ctes(*sql.BASE, sql.PAIRS, sql.EARLY_FEATS, sql.TRAIN_FEATURES,
                                  sql.TRAIN_FILLED)
register("train_filled", WITH_TRAIN_FILLED + "SELECT * FROM train_filled")(_train_filled)
register("test_filled",
         sql.with_ctes(*sql.BASE, sql.PAIRS, sql.EARLY_FEATS, sql.TEST_FEATURES, sql.TEST_FILLED)
         + "SELECT * FROM test_filled")(_test_filled)

register("train_skipped_rows",
         WITH_TRAIN_FILLED + "SELECT count(*) FILTER (WHERE "
         + " OR ".join(f"{c} IS NULL" for c in sql.FEATURE_NAMES)
         + ") AS skipped FROM train_filled")(
    lambda spark, d: scoring.skipped_rows(_train_filled(spark, d)))

# ---------------------------------------------------------------- A6 class balance, vectors
register("class_balance",
         WITH_PAIRS + "SELECT total, ones, total - ones AS zeros, "
                      "CAST(ones AS DOUBLE) * 100.0 / total AS percent_ones, "
                      "CAST(total - ones AS DOUBLE) / total AS balancing_ratio FROM ("
                      "SELECT count(*) AS total, count(*) FILTER (WHERE label = 1) AS ones "
                      "FROM train)")(
    lambda spark, d: scoring.class_balance(Tables(spark, d).train_pairs()))
register("class_weights",
         WITH_PAIRS + ", b AS (SELECT CAST(count(*) - count(*) FILTER (WHERE label = 1) AS DOUBLE)"
                      " / count(*) AS r FROM train) "
                      "SELECT user_id, merchant_id, label, "
                      "CASE WHEN label = 1 THEN r ELSE 1 - r END AS classWeights "
                      "FROM train, b")(
    lambda spark, d: scoring.with_class_weights(Tables(spark, d).train_pairs()))


register("fit_weights",
         WITH_TRAIN_FILLED.rstrip() + ", c AS (SELECT * FROM train_filled WHERE "
         + " AND ".join(f"{c} IS NOT NULL" for c in sql.FEATURE_NAMES)
         + "), b AS (SELECT CAST(count(*) - count(*) FILTER (WHERE label = 1) AS DOUBLE) / count(*) AS r "
           "FROM c) SELECT user_id, merchant_id, label, "
           "CASE WHEN label = 1 THEN r ELSE 1 - r END AS classWeights FROM c, b")(
    lambda spark, d: scoring.fit_weights(_train_filled(spark, d)).select(
        "user_id", "merchant_id", "label", "classWeights"))


# The rows a model is fitted on: those without a NULL feature.
def _assembled(spark: SparkSession, d: str) -> DataFrame:
    model_input = scoring.scoring_pipeline().getStages()[0].transform(
        scoring.complete_rows(_train_filled(spark, d)))
    return scoring.feature_columns(model_input, "features")


def _scaled(spark: SparkSession, d: str) -> DataFrame:
    stages = scoring.scoring_pipeline().getStages()
    assembled = stages[0].transform(scoring.complete_rows(_train_filled(spark, d)))
    scaled = stages[1].fit(assembled).transform(assembled)
    return scoring.feature_columns(scaled, "Scaled_features")


WITH_ASSEMBLED = sql.with_ctes(*sql.BASE, sql.PAIRS, sql.EARLY_FEATS, sql.TRAIN_FEATURES,
                               sql.TRAIN_FILLED, sql.ASSEMBLED)
register("assembled_features",
         WITH_ASSEMBLED + "SELECT user_id, merchant_id, "
         + ", ".join(f"round({c}, 6) AS {c}" for c in sql.FEATURE_NAMES) + " FROM assembled")(
    _assembled)
register("scaled_features",
         WITH_ASSEMBLED + ", s AS (SELECT " + ", ".join(
             f"stddev_samp({c}) AS {c}" for c in sql.FEATURE_NAMES) + " FROM assembled) "
         + "SELECT a.user_id, a.merchant_id, " + ", ".join(
             f"round(CASE WHEN s.{c} = 0 OR s.{c} IS NULL THEN 0.0 ELSE a.{c} * (1.0 / s.{c}) END,"
             f" 6) AS {c}" for c in sql.FEATURE_NAMES) + " FROM assembled a, s")(_scaled)



def _test_scaled_refit(spark: SparkSession, d: str) -> DataFrame:
    assembler, scaler, _ = scoring.scoring_pipeline().getStages()
    assembled = assembler.transform(_test_filled(spark, d))
    return scoring.feature_columns(scoring.refit_scaler(scaler, assembled).transform(assembled),
                                   "Scaled_features")


_WITH_TEST_FILLED = sql.with_ctes(*sql.BASE, sql.PAIRS, sql.EARLY_FEATS, sql.TEST_FEATURES, sql.TEST_FILLED)
register("test_scaled_refit",
         _WITH_TEST_FILLED.rstrip() + ", s AS (SELECT " + ", ".join(
             f"stddev_samp({c}) AS {c}" for c in sql.FEATURE_NAMES) + " FROM test_filled) "
         + "SELECT a.user_id, a.merchant_id, " + ", ".join(
             f"round(CASE WHEN s.{c} = 0 OR s.{c} IS NULL THEN 0.0 ELSE a.{c} * (1.0 / s.{c}) END,"
             f" 6) AS {c}" for c in sql.FEATURE_NAMES) + " FROM test_filled a, s")(_test_scaled_refit)

# ---------------------------------------------------------------- raw text lines


def _parsed_log(spark: SparkSession, d: str) -> DataFrame:
    return parse_log_lines(lines_of(Tables(spark, d).user_log(), LOG_COLUMNS), TEXT_CODED_LOG)


_PARSED_LOG = (
    "SELECT TRY_CAST(NULLIF(split_part(v, ',', 1), '') AS BIGINT) AS user_id, "
    "TRY_CAST(NULLIF(split_part(v, ',', 2), '') AS BIGINT) AS item_id, "
    "NULLIF(split_part(v, ',', 3), '') AS cat_id, "
    "TRY_CAST(NULLIF(split_part(v, ',', 4), '') AS BIGINT) AS seller_id, "
    "NULLIF(split_part(v, ',', 5), '') AS brand_id, "
    "TRY_CAST(NULLIF(split_part(v, ',', 6), '') AS INTEGER) AS time_stamp, "
    "TRY_CAST(NULLIF(split_part(v, ',', 7), '') AS INTEGER) AS action_type "
    "FROM (SELECT concat_ws(',', CAST(user_id AS VARCHAR), CAST(item_id AS VARCHAR), "
    "coalesce(cat_id, ''), CAST(seller_id AS VARCHAR), coalesce(brand_id, ''), "
    "CAST(time_stamp AS VARCHAR), CAST(action_type AS VARCHAR)) AS v FROM user_log)")
register("raw_log_parse", BASE + _PARSED_LOG)(_parsed_log)
register("raw_log_promo",
         BASE + f"SELECT * FROM ({_PARSED_LOG}) WHERE time_stamp = {DAY} AND action_type <> 0")(
    lambda spark, d: flt.promo_non_click(_parsed_log(spark, d), DAY))


def _parsed_users(spark: SparkSession, d: str, reject_blank_fields: bool) -> DataFrame:
    lines = lines_of(Tables(spark, d).user_info(), ("user_id", "age_range", "gender"))
    return parse_user_lines(lines, reject_blank_fields)


_USER_LINES = (
    "SELECT CAST(user_id AS VARCHAR) || ',' || coalesce(CAST(age_range AS VARCHAR), '')"
    " || ',' || coalesce(CAST(gender AS VARCHAR), '') AS v FROM user_info")
_PARSED_USERS = (
    "SELECT TRY_CAST(NULLIF(split_part(v, ',', 1), '') AS BIGINT) AS user_id, "
    "TRY_CAST(NULLIF(split_part(v, ',', 2), '') AS INTEGER) AS age_range, "
    "TRY_CAST(NULLIF(split_part(v, ',', 3), '') AS INTEGER) AS gender "
    f"FROM ({_USER_LINES})")
register("raw_user_lines", BASE + _PARSED_USERS)(lambda spark, d: _parsed_users(spark, d, False))
register("raw_user_lines_checked", BASE + _PARSED_USERS + " WHERE NOT contains(v, ',,')")(
    lambda spark, d: _parsed_users(spark, d, True))
register("raw_young_user_lines",
         BASE + f"SELECT * FROM ({_PARSED_USERS} WHERE NOT contains(v, ',,')) WHERE age_range IN (1, 2, 3)")(
    lambda spark, d: flt.young_users(_parsed_users(spark, d, True)))

# ---------------------------------------------------------------- A6 model (rows-only checks)


def _train_scored(spark: SparkSession, d: str) -> DataFrame:
    filled = _train_filled(spark, d)
    return scoring.transform(scoring.fit(filled), filled)


def _train_scores(spark: SparkSession, d: str) -> DataFrame:
    scored = _train_scored(spark, d)
    prob = vector_values("probability")[1].cast("float")
    return scored.select("user_id", "merchant_id", "label", "prediction", prob.alias("prob"))


register("train_scores")(_train_scores)
register("train_accuracy")(lambda spark, d: scoring.accuracy_table(_train_scored(spark, d)))


def _test_scores(scaler: str) -> Query:
    def run(spark: SparkSession, d: str) -> DataFrame:
        t = Tables(spark, d)
        return scoring.repeat_buyer_scores(t.log_before_split(), t.user_info(), t.train_pairs(),
                                           t.test_pairs(), scaler=scaler)
    return run


register("test_scores")(_test_scores("train"))
register("test_scores_refit")(_test_scores("refit"))

# What SQL can state about the scored rows: how many there are, how many
# have no score, and that no score breaks a rule.
_INCOMPLETE = " OR ".join(f"{c} IS NULL" for c in sql.FEATURE_NAMES)
_NONE = "CAST(0 AS BIGINT)"


def _train_score_check(spark: SparkSession, d: str) -> DataFrame:
    p = vector_values("probability")
    return _train_scored(spark, d).select("prediction", p[0].alias("p0"), p[1].alias("p1")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("p1").isNull()).alias("unscored"),
        F.count_if(~F.col("p1").between(0, 1) | (F.abs(F.col("p0") + F.col("p1") - 1) > 1e-9))
        .alias("bad_probability"),
        F.count_if((F.col("p1") > 0.5) != (F.col("prediction") == 1)).alias("bad_prediction"),
        F.count_if(F.col("p1").isNull() != F.col("prediction").isNull()).alias("half_scored"))


register("train_score_check",
         WITH_TRAIN_FILLED + f"SELECT count(*) AS n_rows, count(*) FILTER (WHERE {_INCOMPLETE}) AS unscored, "
                             f"{_NONE} AS bad_probability, {_NONE} AS bad_prediction, {_NONE} AS half_scored "
                             "FROM train_filled")(_train_score_check)
# Right and wrong predictions together are the scored rows.
register("train_accuracy_check",
         WITH_TRAIN_FILLED + f"SELECT count(*) FILTER (WHERE NOT ({_INCOMPLETE})) AS counted, "
                             f"{_NONE} AS other_rows FROM train_filled")(
    lambda spark, d: scoring.accuracy_table(_train_scored(spark, d)).agg(
        F.sum("count").alias("counted"), F.count_if(~F.col("correct").isin(0, 1)).alias("other_rows")))


def _score_check(scores: DataFrame) -> DataFrame:
    return scores.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("prob").isNull()).alias("unscored"),
        F.count_if(~F.col("prob").between(0, 1)).alias("bad_probability"),
        F.sum("user_id").alias("users"), F.sum("merchant_id").alias("merchants"))


_TEST_CHECK = (WITH_PAIRS + f"SELECT count(*) AS n_rows, {_NONE} AS unscored, {_NONE} AS bad_probability, "
                            "CAST(sum(user_id) AS BIGINT) AS users, "
                            "CAST(sum(merchant_id) AS BIGINT) AS merchants FROM test")
register("test_score_check", _TEST_CHECK)(
    lambda spark, d: _score_check(_test_scores("train")(spark, d)))
register("test_score_refit_check", _TEST_CHECK)(
    lambda spark, d: _score_check(_test_scores("refit")(spark, d)))


def _scores_csv_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_folder(spark, "scores-csv")
    sinks.write_scores(_test_scores("train")(spark, d), path)
    return _score_check(spark.read.option("header", True).schema(
        "user_id long, merchant_id long, prob float").csv(path))


register("scores_csv_roundtrip", _TEST_CHECK)(_scores_csv_roundtrip)


def _train_scores_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_folder(spark, "train-scores-csv")
    sinks.write_train_scores(_train_scored(spark, d), path)
    back = spark.read.option("header", True).option("quote", '"').option("escape", "\\").csv(path)
    size = F.size(F.from_json("features", "array<double>"))
    return back.agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.col("label").cast("long")).alias("ones"),
        F.count_if(F.col("prediction").isNull()).alias("unscored"),
        F.count_if(size == len(FEATURES)).alias("with_features"))


register("train_scores_roundtrip",
         WITH_TRAIN_FILLED + "SELECT count(*) AS n_rows, CAST(sum(label) AS BIGINT) AS ones, "
                             f"count(*) FILTER (WHERE {_INCOMPLETE}) AS unscored, "
                             f"count(*) FILTER (WHERE NOT ({_INCOMPLETE})) AS with_features "
                             "FROM train_filled")(_train_scores_roundtrip)

# ---------------------------------------------------------------- A6 model, by value
# The same flow fitted to its optimum, which SQL finds by Newton steps of
# its own; a model of few iterations has no value that SQL could state.
DIGITS = 5


def _converged(spark: SparkSession, d: str) -> scoring.Flow:
    t = Tables(spark, d)
    max_iter, tol = scoring.CONVERGED
    return scoring.repeat_buyer_flow(t.log_before_split(), t.user_info(), t.train_pairs(), t.test_pairs(),
                                     max_iter=max_iter, tol=tol)


def _chance():
    return F.round(vector_values("probability")[1], DIGITS).alias("prob")


def _train_scores_converged(spark: SparkSession, d: str) -> DataFrame:
    flow = _converged(spark, d)
    return scoring.transform(flow.model, flow.train).select(
        "user_id", "merchant_id", "label", F.col("prediction").cast("int").alias("prediction"), _chance())


def _train_accuracy_converged(spark: SparkSession, d: str) -> DataFrame:
    flow = _converged(spark, d)
    return scoring.accuracy_table(scoring.transform(flow.model, flow.train))


def _test_scores_converged(scaler: str) -> Query:
    def run(spark: SparkSession, d: str) -> DataFrame:
        flow = _converged(spark, d)
        return scoring.transform(flow.model, flow.test, scaler).select("user_id", "merchant_id", _chance())
    return run


_WITH_FIT = "WITH RECURSIVE" + sql.with_ctes(
    *sql.BASE, sql.PAIRS, sql.EARLY_FEATS, sql.TRAIN_FEATURES, sql.TRAIN_FILLED, sql.ASSEMBLED,
    sql.newton_ctes()).removeprefix("WITH").rstrip()
_TRAIN_CHANCE = (f", chance AS (SELECT user_id, merchant_id, label, {sql.probability('t', 'sd')} AS p "
                 "FROM train_filled t, sd, fit), "
                 "scored AS (SELECT c.*, CASE WHEN p > 0.5 THEN 1 WHEN p IS NOT NULL THEN 0 END AS prediction FROM "
                 f"(SELECT t.user_id, t.merchant_id, t.label, CASE WHEN NOT ({_INCOMPLETE}) THEN p END AS p "
                 "FROM train_filled t JOIN chance USING (user_id, merchant_id)) c) ")
register("train_scores_converged",
         _WITH_FIT + _TRAIN_CHANCE + "SELECT user_id, merchant_id, label, CAST(prediction AS INTEGER) AS prediction, "
         f"round(p, {DIGITS}) AS prob FROM scored")(_train_scores_converged)
register("train_accuracy_converged",
         _WITH_FIT + _TRAIN_CHANCE + "SELECT CAST(CASE WHEN label = prediction THEN 1 ELSE 0 END AS INTEGER) AS correct, "
         "count(*) AS count FROM scored WHERE prediction IS NOT NULL GROUP BY 1")(_train_accuracy_converged)
_TEST_VIEWS = "," + sql.TEST_FEATURES + "," + sql.TEST_FILLED
_TEST_SD = ", tsd AS (SELECT " + ", ".join(f"stddev_samp({c}) AS {c}" for c in sql.FEATURE_NAMES) + " FROM test_filled) "
register("test_scores_converged",
         _WITH_FIT + _TEST_VIEWS + f" SELECT user_id, merchant_id, round({sql.probability('t', 'sd')}, {DIGITS}) AS prob "
         "FROM test_filled t, sd, fit")(_test_scores_converged("train"))
register("test_scores_refit_converged",
         _WITH_FIT + _TEST_VIEWS + _TEST_SD
         + f"SELECT user_id, merchant_id, round({sql.probability('t', 'tsd')}, {DIGITS}) AS prob "
           "FROM test_filled t, tsd, fit")(_test_scores_converged("refit"))


# ---------------------------------------------------------------- score files, row by row
def _same_rows(before: DataFrame, back: DataFrame, keys: tuple[str, ...], shown: tuple[str, ...]) -> DataFrame:
    """Keys, ``shown`` as read back, and whether all columns equal those written."""
    values = [c for c in before.columns if c not in keys]
    ours = before.select(*keys, F.struct(*values).alias("_written"))
    theirs = back.select(*keys, F.struct(*values).alias("_back"))
    return ours.join(theirs, list(keys), "full").select(
        *keys, *[F.col("_back")[c].alias(c) for c in shown],
        F.col("_written").eqNullSafe(F.col("_back")).alias("same"))


def _scores_csv_rows(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_folder(spark, "scores-csv")
    scores = written(_test_scores("train")(spark, d), "scores")
    sinks.write_scores(scores, path)
    back = spark.read.option("header", True).schema(scores.schema).csv(path)
    return _same_rows(scores, back, ("user_id", "merchant_id"), ())


register("scores_csv_rows", WITH_PAIRS + "SELECT user_id, merchant_id, true AS same FROM test")(_scores_csv_rows)


def _train_scores_rows(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_folder(spark, "train-scores-csv")
    scored = _train_scored(spark, d)
    vectors = ("features", "Scaled_features", "rawPrediction", "probability")
    values = written(scored.withColumns({c: vector_values(c) for c in vectors}), "train-scores")
    sinks.write_train_scores(scored, path)
    back = spark.read.option("header", True).option("quote", '"').option("escape", "\\").csv(path)
    back = back.select(*[F.from_json(f.name, f.dataType.simpleString()).alias(f.name) if f.name in vectors
                         else F.col(f.name).cast(f.dataType).alias(f.name) for f in values.schema.fields])
    return _same_rows(values, back, ("user_id", "merchant_id"), ("label",))


register("train_scores_rows", WITH_TRAIN_FILLED + "SELECT user_id, merchant_id, label, true AS same FROM train_filled")(
    _train_scores_rows)

assert all(name in QUERIES for name in ORACLES)
__all__ = ["QUERIES", "ORACLES", "FEATURES"]
