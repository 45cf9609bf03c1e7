"""End-to-end jobs on CSV inputs written from the sf0.001 adapter views."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL

from __spark_entry__ import queries
from promoscope import jobs
from promoscope.sources.driver_tables import Tables

NOV = (1101, 1130)


@pytest.fixture(scope="module")
def inputs(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("shop"))
    t = Tables(spark, SF_SMALL)
    paths = {}
    log = t.user_log()
    for c in ("cat_id", "brand_id"):  # integer codes, as the real log has
        log = log.withColumn(c, F.abs(F.xxhash64(c)) % 1000)
    for name, df in [("user_log", log), ("user_info", t.user_info()),
                     ("train", t.train_pairs()), ("test", t.test_pairs())]:
        paths[name] = os.path.join(root, name)
        df.write.option("header", True).csv(paths[name])
    paths["root"] = root
    return paths


def _checkpoint_folder(spark):
    from promoscope.session import ensure_checkpoint_dir
    return ensure_checkpoint_dir(spark).removeprefix("file:")


def _lines(path):
    [f] = glob.glob(os.path.join(path, "part-*"))
    with open(f) as fh:
        return fh.read().splitlines()


def test_top_items_job_matches_query(spark, inputs):
    out = os.path.join(inputs["root"], "top_items")
    jobs.top_items_job(spark, inputs["user_log"], out, *NOV)
    lines = _lines(out)
    from promoscope.operators.popularity import top_items
    want = top_items(Tables(spark, SF_SMALL).user_log(), *NOV, with_rank=True).orderBy("rank").collect()
    assert lines[0] == "item_id,Number"
    assert lines[1:] == [f"{r.item_id},{r.number}" for r in want]


def test_top_merchants_job_text(spark, inputs):
    out = os.path.join(inputs["root"], "top_merchants")
    top = jobs.top_merchants_job(spark, inputs["user_log"], inputs["user_info"], out, *NOV,
                                 out_format="text")
    lines = _lines(out)
    rows = top.orderBy("rank").collect()
    assert lines == [f"{r['rank']}\t{r.merchant_id}, {r.number}" for r in rows]


def test_gender_and_age_jobs(spark, inputs):
    share, ratio = jobs.buyer_gender_job(spark, inputs["user_log"], inputs["user_info"], *NOV)
    q = queries()
    assert share.count() == 2
    r = ratio.collect()[0]
    assert r.male + r.female == sum(x["count"] for x in share.collect())
    age = jobs.buyer_age_job(spark, inputs["user_log"], inputs["user_info"], *NOV)
    assert abs(sum(x.proportion for x in age.collect()) - 1.0) < 1e-9
    assert q  # catalogue importable alongside the jobs


def test_repeat_buyer_job_scores_every_pair(spark, inputs):
    out = os.path.join(inputs["root"], "scores")
    train_out = os.path.join(inputs["root"], "train_scores")
    before = set(os.listdir(_checkpoint_folder(spark)))
    skipped = jobs.repeat_buyer_job(spark, inputs["user_log"], inputs["user_info"], inputs["train"],
                                    inputs["test"], out, train_out_path=train_out)
    assert set(os.listdir(_checkpoint_folder(spark))) <= before  # no scratch tables left
    back = spark.read.option("header", True).csv(out)
    assert back.columns == ["user_id", "merchant_id", "prob"]
    assert back.count() == Tables(spark, SF_SMALL).test_pairs().count()
    scored = spark.read.option("header", True).csv(train_out)
    assert {"label", "classWeights", "features", "Scaled_features", "probability",
            "prediction"} <= set(scored.columns)
    assert scored.count() == Tables(spark, SF_SMALL).train_pairs().count()
    assert scored.where("prediction IS NULL").count() == skipped
    assert scored.where("features IS NOT NULL").first().features.startswith("[")


def test_share_jobs_write_their_tables(spark, inputs, tmp_path):
    jobs.buyer_gender_job(spark, inputs["user_log"], inputs["user_info"], *NOV, out_path=f"{tmp_path}/g")
    jobs.buyer_age_job(spark, inputs["user_log"], inputs["user_info"], *NOV, out_path=f"{tmp_path}/a")
    assert _lines(f"{tmp_path}/g/share")[0] == "gender,count,proportion,percent"
    assert _lines(f"{tmp_path}/g/ratio")[0] == "male,female,ratio"
    assert _lines(f"{tmp_path}/a")[0] == "age_range,count,proportion,percent"


def test_sql_over_registered_views(spark):
    Tables(spark, SF_SMALL).register_views()
    got = spark.sql("""
        SELECT item_id, count(*) AS number
        FROM (SELECT DISTINCT user_id, item_id, action_type FROM user_log
              WHERE time_stamp BETWEEN 1101 AND 1130 AND action_type <> 0)
        GROUP BY item_id ORDER BY number DESC, item_id LIMIT 100""").collect()
    from promoscope.operators.popularity import top_items
    want = top_items(Tables(spark, SF_SMALL).user_log(), *NOV).collect()
    assert [tuple(r) for r in got] == [tuple(r) for r in want]
    assert spark.sql("SELECT count(*) FROM train WHERE label = 1").first()[0] == \
        Tables(spark, SF_SMALL).train_pairs().where("label = 1").count()


def test_job_reads_headerless_csv(spark, inputs, tmp_path):
    noheader = str(tmp_path / "log_noheader")
    Tables(spark, SF_SMALL).user_log().write.csv(noheader)
    out = str(tmp_path / "top")
    a = jobs.top_items_job(spark, noheader, out, *NOV, fmt="csv_noheader").collect()
    b = jobs.top_items_job(spark, inputs["user_log"], str(tmp_path / "top2"), *NOV).collect()
    assert a == b


def test_command_line_top_items(spark, inputs, tmp_path):
    import subprocess
    import sys
    out = str(tmp_path / "cli_top")
    env = dict(os.environ, PYSPARK_SUBMIT_ARGS="--master local[2] --conf spark.ui.enabled=false "
                                               "pyspark-shell")
    proc = subprocess.run(
        [sys.executable, "-m", "promoscope", "top-items", "--log", inputs["user_log"],
         "--out", out, "--day", "1101", "--day-to", "1130", "--text"],
        cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
        env=env, capture_output=True, text=True, timeout=300)
    assert proc.returncode == 0, proc.stderr[-2000:]
    lines = _lines(out)
    assert len(lines) == 100 and lines[0].startswith("1\t")
