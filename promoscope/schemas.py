"""Table schemas and the fixed codes of the shopper log."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the source data's coding for right results)
#   promo day (month*100 + day):     1111
#   action_type: 0 click, 1 add to cart, 2 purchase, 3 favourite
#   age_range:   0 or empty unknown; 1, 2, 3 are under 30 ("young")
#   gender:      0 female, 1 male, 2 or empty unknown
#   top-k size:  100
# ---------------------------------------------------------------------------
PROMO_DAY = 1111
CLICK, CART, PURCHASE, FAVOURITE = 0, 1, 2, 3
YOUNG_AGES = (1, 2, 3)
AGE_UNKNOWN = 0
FEMALE, MALE, GENDER_UNKNOWN = 0, 1, 2
TOP_K = 100

USER_LOG = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("item_id", T.LongType()),
    T.StructField("cat_id", T.LongType()),
    T.StructField("seller_id", T.LongType()),
    T.StructField("brand_id", T.LongType()),
    T.StructField("time_stamp", T.IntegerType()),
    T.StructField("action_type", T.IntegerType()),
])
LOG_COLUMNS = tuple(f.name for f in USER_LOG.fields)

# The adapter over the driver tables has category and brand as text.
TEXT_CODED_LOG = T.StructType([
    T.StructField(f.name, T.StringType() if f.name in ("cat_id", "brand_id") else f.dataType)
    for f in USER_LOG.fields])

USER_INFO = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("age_range", T.IntegerType()),
    T.StructField("gender", T.IntegerType()),
])

TRAIN_PAIRS = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("merchant_id", T.LongType()),
    T.StructField("label", T.IntegerType()),
])

TEST_PAIRS = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("merchant_id", T.LongType()),
    T.StructField("prob", T.DoubleType()),
])

# The ten model inputs, named and ordered as the source's
# feature table lays them out (the assembled vector follows this order).
FEATURES = (
    "age_range", "gender",
    "total_logs", "unique_item_ids", "categories", "browse_days",
    "one_clicks", "shopping_carts", "purchase_times", "favourite_times",
)
PAIR_KEYS = ("user_id", "merchant_id")
