"""End-to-end jobs: the six analyses from input files to result files.

Each job reads the shop inputs (CSV with header, or parquet) with their
fixed schemas, runs the DataFrame operators and writes with the
distributed writers; the small ranked lists go to one file in rank
order, score tables are written by every task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from promoscope.operators import demographics as demo
from promoscope.operators import popularity as pop
from promoscope.operators import scoring
from promoscope.schemas import PROMO_DAY, TOP_K
from promoscope.session import clear_scratch
from promoscope.sources import files, sinks


def _read(spark: SparkSession, kind: str, path: str, fmt: str, **kw) -> DataFrame:
    """``fmt``: "csv" (with header), "csv_noheader" or "parquet"."""
    if fmt == "csv_noheader":
        return files.read_table(spark, kind, path, fmt="csv", header=False, **kw)
    return files.read_table(spark, kind, path, fmt=fmt, **kw)


def top_items_job(spark: SparkSession, log_path: str, out_path: str, day_from: int = PROMO_DAY,
                  day_to: int | None = None, k: int = TOP_K, fmt: str = "csv",
                  out_format: str = "csv") -> DataFrame:
    """A1: `item_id,Number` CSV (or `rank<TAB>id, count` text) of the top k items."""
    log = _read(spark, "user_log", log_path, fmt)
    top = pop.top_items(log, day_from, day_to, k=k, with_rank=True)
    writer = sinks.write_ranked_csv if out_format == "csv" else sinks.write_ranked_text
    writer(top, out_path, "item_id")
    return top


def top_merchants_job(spark: SparkSession, log_path: str, users_path: str, out_path: str,
                      day_from: int = PROMO_DAY, day_to: int | None = None, k: int = TOP_K,
                      fmt: str = "csv", out_format: str = "csv") -> DataFrame:
    """A2: the k merchants most watched by users under 30."""
    log = _read(spark, "user_log", log_path, fmt)
    users = _read(spark, "user_info", users_path, fmt)
    top = pop.top_merchants(log, users, day_from, day_to, k=k)
    writer = sinks.write_ranked_csv if out_format == "csv" else sinks.write_ranked_text
    writer(top, out_path, "merchant_id")
    return top


def buyer_gender_job(spark: SparkSession, log_path: str, users_path: str,
                     day_from: int = PROMO_DAY, day_to: int | None = None,
                     fmt: str = "csv", out_path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """A3: (gender share table, male/female ratio row), with ``out_path``
    also as CSV in its folders ``share`` and ``ratio``."""
    log = _read(spark, "user_log", log_path, fmt)
    users = _read(spark, "user_info", users_path, fmt)
    b = demo.buyers(log, users, day_from, day_to)
    share, ratio = demo.gender_share(b), demo.gender_ratio(b)
    if out_path:
        sinks.write_table(share, f"{out_path}/share")
        sinks.write_table(ratio, f"{out_path}/ratio")
    return share, ratio


def buyer_age_job(spark: SparkSession, log_path: str, users_path: str,
                  day_from: int = PROMO_DAY, day_to: int | None = None,
                  unknown: str = "keep_zero", fmt: str = "csv",
                  out_path: str | None = None) -> DataFrame:
    """A4: age share table, with ``out_path`` also as CSV;
    ``unknown="drop"`` excludes the unknown code 0."""
    log = _read(spark, "user_log", log_path, fmt)
    users = _read(spark, "user_info", users_path, fmt)
    share = demo.age_share(demo.buyers(log, users, day_from, day_to), unknown)
    if out_path:
        sinks.write_table(share, out_path)
    return share


def repeat_buyer_job(spark: SparkSession, log_path: str, users_path: str, train_path: str,
                     test_path: str, out_path: str, scaler: str = "train",
                     max_iter: int = 10, fmt: str = "csv",
                     train_out_path: str | None = None) -> int:
    """A5 + A6: features, fills, weighted logistic regression, and the
    `user_id,merchant_id,prob` table for the pairs to score.  With
    ``train_out_path`` every training row is written too, those that
    cannot be scored without a score (SNK-3, vector columns as JSON
    arrays).  Returns the number of training rows that were not fitted;
    the scratch tables of the flow are removed."""
    log = _read(spark, "user_log", log_path, fmt)
    users = _read(spark, "user_info", users_path, fmt)
    # Missing features are filled in the pair files' row order.
    train = _read(spark, "train", train_path, fmt, row_order=True)
    test = _read(spark, "test", test_path, fmt, row_order=True)
    flow = scoring.repeat_buyer_flow(log, users, train, test, scaler=scaler,
                                     max_iter=max_iter, order_cols=files.FILE_ORDER)
    sinks.write_scores(flow.scores, out_path)
    if train_out_path:
        weights = scoring.class_weight_table(scoring.complete_rows(flow.train))
        scored = scoring.transform(flow.model, scoring.with_class_weights(flow.train, weights))
        sinks.write_train_scores(scored.drop(*files.FILE_ORDER), train_out_path)
    skipped = flow.skipped.first()["skipped"]
    clear_scratch(spark)
    return skipped
