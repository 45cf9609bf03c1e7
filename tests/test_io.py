"""Readers and writers: CSV inputs with bad lines, result files round-trip."""

import glob
import os

from pyspark.sql import functions as F

from conftest import SF_SMALL

from promoscope.operators import popularity as pop
from promoscope.sources import files, sinks
from promoscope.sources.driver_tables import Tables


def _write(path, text):
    with open(path, "w") as fh:
        fh.write(text)


def test_csv_reader_permissive(spark, tmp_out):
    p = os.path.join(tmp_out, "log.csv")
    _write(p, "user_id,item_id,cat_id,seller_id,brand_id,time_stamp,action_type\n"
              "1,10,3,7,5,1111,2\n"
              "2,11,3,8\n"          # short line
              "3,12,3,9,5,1111,\n"  # blank action
              "4,x,3,9,5,1111,1\n")  # unparsable item
    df = files.read_table(spark, "user_log", p)
    rows = {r.user_id: r for r in df.collect()}
    assert len(rows) == 4  # header skipped
    assert rows[2].time_stamp is None and rows[2].action_type is None
    assert rows[3].action_type is None
    assert rows[4].item_id is None
    # The blank action is dropped by the non-click filter.
    kept = {r.user_id for r in pop.dedup_user_item_action(df, 1111).collect()}
    assert kept == {1, 4}


def test_test_pairs_reader_sets_prob_aside(spark, tmp_out):
    p = os.path.join(tmp_out, "test.csv")
    _write(p, "user_id,merchant_id,prob\n1,2,\n3,4,\n")
    df = files.read_table(spark, "test", p)
    assert df.columns == ["user_id", "merchant_id", "prob"]
    assert [r.prob for r in df.collect()] == [None, None]


def test_raw_lines_header_and_blank_fields(spark, tmp_out):
    p = os.path.join(tmp_out, "users.txt")
    _write(p, "user_id,age_range,gender\n1,2,0\n2,,1\n3,3,\n")
    parsed = files.parse_user_lines(files.read_lines(spark, p))
    rows = sorted((r.user_id, r.age_range, r.gender) for r in parsed.collect()
                  if r.user_id is not None)
    assert rows == [(1, 2, 0), (3, 3, None)]  # ",," line rejected, header -> NULL id


def test_ranked_csv_and_text_roundtrip(spark, tmp_out):
    log = Tables(spark, SF_SMALL).user_log(("user_id", "item_id", "time_stamp", "action_type"))
    top = pop.top_items(log, 1101, 1130, k=100, with_rank=True)
    expect = [(r.item_id, r.number) for r in top.orderBy("rank").collect()]
    csv_dir = os.path.join(tmp_out, "top_csv")
    sinks.write_ranked_csv(top, csv_dir, "item_id")
    files_ = glob.glob(os.path.join(csv_dir, "part-*.csv"))
    assert len(files_) == 1
    with open(files_[0]) as fh:
        lines = fh.read().splitlines()
    assert lines[0] == "item_id,Number"
    assert [tuple(int(x) for x in ln.split(",")) for ln in lines[1:]] == expect
    txt_dir = os.path.join(tmp_out, "top_txt")
    sinks.write_ranked_text(top, txt_dir, "item_id")
    with open(glob.glob(os.path.join(txt_dir, "part-*"))[0]) as fh:
        first = fh.readline().rstrip("\n")
    assert first == f"1\t{expect[0][0]}, {expect[0][1]}"


def test_scores_roundtrip(spark, tmp_out):
    df = spark.createDataFrame([(1, 2, 0.25), (3, 4, 0.5)], "user_id long, merchant_id long, prob float")
    out = os.path.join(tmp_out, "scores")
    sinks.write_scores(df, out)
    back = spark.read.option("header", True).schema(
        "user_id long, merchant_id long, prob double").csv(out)
    assert sorted(tuple(r) for r in back.collect()) == [(1, 2, 0.25), (3, 4, 0.5)]


def test_train_scores_vectors_as_json(spark, tmp_out):
    from pyspark.ml.feature import VectorAssembler
    df = spark.createDataFrame([(1, 2.0, 3.0)], "user_id long, a double, b double")
    v = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)
    out = os.path.join(tmp_out, "train_scores")
    sinks.write_train_scores(v, out)
    back = spark.read.option("header", True).csv(out)
    row = back.collect()[0]
    assert row.features == "[2.0,3.0]"
    assert back.select(F.from_json("features", "array<double>").alias("f")).first().f == [2.0, 3.0]


def test_fill_follows_file_row_order(spark, tmp_out):
    from promoscope.operators.fill import ordered_fill
    p = os.path.join(tmp_out, "train.csv")
    rows = [(9, 1, 0), (2, 1, 1), (7, 1, 0), (1, 1, 0), (5, 1, 1)]
    _write(p, "user_id,merchant_id,label\n" + "".join(f"{u},{m},{lab}\n" for u, m, lab in rows))
    df = files.read_table(spark, "train", p, row_order=True)
    # A value to fill: only the 1st and 4th file rows carry one.
    df = df.withColumn("v", F.when(F.col("user_id").isin(9, 1), F.col("user_id")))
    got = ordered_fill(df, list(files.FILE_ORDER), ["v"], ("forward",), num_ranges=2)
    by_user = {r.user_id: r.v for r in got.collect()}
    # File order 9, 2, 7, 1, 5 -> v 9, 9, 9, 1, 1 (key order would give 1, 1, 1, 1, 9).
    assert by_user == {9: 9, 2: 9, 7: 9, 1: 1, 5: 1}


def test_fill_follows_row_order_across_files(spark, tmp_out):
    from promoscope.operators.fill import ordered_fill
    d = os.path.join(tmp_out, "pairs")
    os.makedirs(d)
    # Two part files; the larger one is named second (Spark reads larger
    # splits first, so the id alone would not give file-name order).
    _write(os.path.join(d, "part-00000.csv"), "user_id,merchant_id,label\n8,1,0\n")
    _write(os.path.join(d, "part-00001.csv"),
           "user_id,merchant_id,label\n" + "".join(f"{u},1,0\n" for u in (3, 6, 1, 4, 2, 7, 5)))
    df = files.read_table(spark, "train", d, row_order=True)
    df = df.withColumn("v", F.when(F.col("user_id").isin(8, 1), F.col("user_id")))
    got = ordered_fill(df, list(files.FILE_ORDER), ["v"], ("forward",), num_ranges=3)
    by_user = {r.user_id: r.v for r in got.collect()}
    assert by_user == {8: 8, 3: 8, 6: 8, 1: 1, 4: 1, 2: 1, 7: 1, 5: 1}


def test_integer_coded_logs_give_equal_features(spark, tmp_out):
    from promoscope.operators.features import behaviour_features
    log = Tables(spark, SF_SMALL).user_log()
    coded = log.withColumn("cat_id", F.abs(F.xxhash64("cat_id")) % 1000).withColumn(
        "brand_id", F.abs(F.xxhash64("brand_id")) % 1000)
    coded.write.parquet(f"{tmp_out}/parquet")
    coded.write.option("header", True).csv(f"{tmp_out}/csv")
    a, b = (sorted(behaviour_features(files.read_table(spark, "user_log", f"{tmp_out}/{f}", fmt=f)).collect())
            for f in ("parquet", "csv"))
    assert a == b and all(r.categories > 0 for r in a)
    assert a == sorted(behaviour_features(coded).collect())
