"""Command line: ``python -m promoscope <job> [options]``.

    top-items      --log L --out O [--day 1111] [--k 100] [--text]
    top-merchants  --log L --users U --out O [--day 1111] [--k 100] [--text]
    gender         --log L --users U [--out O] [--day 1111]
    age            --log L --users U [--out O] [--day 1111] [--strict]
    repeat-buyers  --log L --users U --train T --test S --out O [--refit] [--train-out P]

Inputs are CSV with a header unless ``--parquet``.  On a cluster, run
through spark-submit; ``spark.checkpoint.dir`` must name shared storage
for ``repeat-buyers``.
"""

from __future__ import annotations

import argparse
import sys

from promoscope import jobs
from promoscope.schemas import PROMO_DAY, TOP_K
from promoscope.session import build_session


def main(argv=None) -> int:
    p = argparse.ArgumentParser(prog="promoscope")
    p.add_argument("job", choices=["top-items", "top-merchants", "gender", "age", "repeat-buyers"])
    p.add_argument("--log", required=True)
    p.add_argument("--users")
    p.add_argument("--train")
    p.add_argument("--test")
    p.add_argument("--out")
    p.add_argument("--train-out", help="repeat-buyers: also write the scored training rows")
    p.add_argument("--day", type=int, default=PROMO_DAY)
    p.add_argument("--day-to", type=int)
    p.add_argument("--k", type=int, default=TOP_K)
    p.add_argument("--text", action="store_true", help="ranked text lines instead of CSV")
    p.add_argument("--strict", action="store_true", help="age: drop the unknown code 0")
    p.add_argument("--refit", action="store_true", help="refit the scaler on the scored pairs")
    p.add_argument("--parquet", action="store_true")
    p.add_argument("--no-header", action="store_true", help="CSV inputs without a header line")
    a = p.parse_args(argv)
    fmt = "parquet" if a.parquet else ("csv_noheader" if a.no_header else "csv")
    out_format = "text" if a.text else "csv"
    spark = build_session()
    if a.job == "top-items":
        jobs.top_items_job(spark, a.log, a.out, a.day, a.day_to, a.k, fmt, out_format)
    elif a.job == "top-merchants":
        jobs.top_merchants_job(spark, a.log, a.users, a.out, a.day, a.day_to, a.k, fmt, out_format)
    elif a.job == "gender":
        share, ratio = jobs.buyer_gender_job(spark, a.log, a.users, a.day, a.day_to, fmt, a.out)
        share.show()
        ratio.show()
    elif a.job == "age":
        jobs.buyer_age_job(spark, a.log, a.users, a.day, a.day_to,
                           "drop" if a.strict else "keep_zero", fmt, a.out).show()
    else:
        skipped = jobs.repeat_buyer_job(spark, a.log, a.users, a.train, a.test, a.out,
                                        "refit" if a.refit else "train", fmt=fmt,
                                        train_out_path=a.train_out)
        print(f"training rows left out of the fit: {skipped}")
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
