"""Raw to clean, on the published fixture rows with hand-derived results."""

import pytest
from pyspark.sql import functions as F

from shelfsight.functions import numbers, text
from shelfsight.operators import clean, relate
from shelfsight.operators.enrich import clean_sentiment
from shelfsight.plans.transforms import clean_products, clean_reviews


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_products_golden(raw_products):
    result = clean_products(raw_products, 950.0, ["seq"])
    assert rows(result, "product_id", "price_usd", "loves_count", "price_clp") == [
        ("P001", 25.0, 1000.0, 23750.0), ("P002", 45.0, 4775.0, 42750.0), ("P003", 25.0, 0.0, 23750.0)]


def test_products_default_rate_is_one(raw_products):
    result = clean_products(raw_products, order=["seq"])
    assert rows(result, "price_clp") == [(25.0,), (25.0,), (45.0,)]


def test_product_names_are_normalised(raw_products):
    renamed = raw_products.withColumnsRenamed({"price_usd": " Price USD", "brand_name": "Brand Name "})
    assert {"price_usd", "brand_name"} <= set(clean_products(renamed, order=["seq"]).columns)


def test_cleaning_products_twice_changes_nothing(raw_products):
    once = clean_products(raw_products, 950.0, ["seq"])
    twice = clean_products(once.drop("price_clp"), 950.0, ["seq"])
    assert sorted(map(tuple, once.collect()), key=str) == sorted(map(tuple, twice.select(once.columns).collect()), key=str)


def test_negative_price_survives_a_positive_fence(spark):
    """Caps come before the price filter, so a stray negative price can be lifted to the lower fence."""
    raw = spark.sql("""select * from values ('a', 100D), ('b', 101D), ('c', 102D), ('d', 103D), ('e', 104D), ('f', -7D)
                       as t(product_id, price_usd)""").selectExpr("product_id", "'n' product_name", "'b' brand_name", "price_usd", "4D rating", "1D loves_count", "'c' primary_category")
    assert clean_products(raw, order=["product_id"]).where("product_id = 'f'").first()["price_usd"] == pytest.approx(100.25 - 1.5 * 2.5)


def test_reviews_golden(raw_reviews):
    result = clean_reviews(raw_reviews, ["seq"])
    assert rows(result, "author_id", "product_id") == [("U001", "P001"), ("U002", "P002"), ("U003", "P003")]
    assert dict(result.dtypes)["is_recommended"] == "double"
    assert rows(result, "total_feedback_count") == [(3.0,), (5.0,), (10.0,)]


def test_reviews_drop_bad_labels_and_ratings(raw_reviews):
    worse = raw_reviews.withColumn("is_recommended", F.when(F.col("seq") == 1, "maybe").otherwise(F.col("is_recommended").cast("string")))
    worse = worse.withColumn("rating", F.when(F.col("seq") == 2, 7.0).otherwise(F.col("rating")))
    assert rows(clean_reviews(worse, ["seq"]), "author_id") == [("U001",)]


def test_sentiment_leaves_out_unknown(raw_sentiment):
    assert rows(clean_sentiment(raw_sentiment), "sentiment", "sentiment_score") == [("negative", 0.82), ("positive", 0.95)]


def test_keep_first_follows_the_order(spark):
    df = spark.sql("select * from values ('a', 2, 'late'), ('a', 1, 'early'), (null, 1, 'x'), (null, 0, 'w') as t(k, seq, v)")
    assert sorted(r["v"] for r in relate.keep_first(df, ["k"], ["seq"]).collect()) == ["early", "w"]


def test_keep_first_limits_groups_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 3 as k", "id")
    plan = relate.keep_first(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


@pytest.mark.parametrize("given, expected", [
    ("12.5", 12.5), (" 7 ", 7.0), ("1d", None), ("2f", None), ("NaN", None), ("abc", None), ("", None), (None, None), ("1e3", 1000.0)])
def test_to_number(spark, given, expected):
    df = spark.createDataFrame([(given,)], "v string")
    assert df.select(numbers.to_number(F.col("v"))).first()[0] == expected


def test_price_text(spark):
    df = spark.createDataFrame([("$1,234.50",), ("free",)], "v string")
    assert [r[0] for r in df.select(numbers.parse_price(F.col("v"))).collect()] == [1234.5, None]


def test_local_price_rounds_half_to_even(spark):
    df = spark.createDataFrame([(2.5,), (3.5,)], "v double")
    assert [r[0] for r in df.select(numbers.convert(F.col("v"), F.lit(1.0))).collect()] == [2.0, 4.0]


def test_clip_keeps_null(spark):
    df = spark.createDataFrame([(None,), (9.0,), (-9.0,), (1.0,)], "v double")
    assert [r[0] for r in df.select(numbers.clip(F.col("v"), 0.0, 5.0)).collect()] == [None, 5.0, 0.0, 1.0]


def test_text_cleaning(spark):
    df = spark.createDataFrame([("  hi \n",), ("nan",), (" None ",), ("  ",), (None,)], "v string")
    assert [r[0] for r in df.select(text.clean_text(F.col("v"))).collect()] == ["hi", None, None, None, None]
    odd = spark.createDataFrame([(" A  b\tC! é",)], "v string")
    assert odd.select(text.plain_words(F.col("v"))).first()[0] == "a b c "


def test_names():
    assert text.full_name("  Price (USD) / net ") == "price_usd_net"
    assert text.simple_name(" Brand Name ") == "brand_name"


def test_unknown_forms(spark):
    df = spark.createDataFrame([("unknown", "x"), (" UNKNOWN ", "unknown")], "a string, b string")
    assert [tuple(r) for r in clean.unknown_to_null(df, ["a"]).collect()] == [(None, "x"), (None, "unknown")]
    assert [r["a"] for r in clean.unknown_to_null(df, ["a"], ignore_case=False).collect()] == [None, " UNKNOWN "]


@pytest.mark.parametrize("search", [
    {"min_price": -1}, {"max_price": -0.5}])
def test_product_search_rejects_bad_prices(raw_products, search):
    with pytest.raises(ValueError):
        clean.find_products(raw_products, **search)


@pytest.mark.parametrize("search", [{"min_rating": 0}, {"min_rating": 6}, {"is_recommended": 2}])
def test_review_search_rejects_bad_values(raw_reviews, search):
    with pytest.raises(ValueError):
        clean.find_reviews(raw_reviews, **search)


@pytest.mark.parametrize("limit, offset", [(0, 0), (501, 0), (10, -1)])
def test_page_rejects_bad_bounds(raw_products, limit, offset):
    with pytest.raises(ValueError):
        relate.page(raw_products, ["product_id"], limit, offset)


@pytest.fixture()
def served(spark):
    return spark.sql("""select * from values ('P001', 'Lipstick A', 'Brand X', 25D, 'Makeup'), ('P002', 'Foundation B', 'Brand Y', 45D, 'Skincare'),
        ('P003', 'Mascara C', 'Brand X', 20D, 'Makeup') as t(product_id, product_name, brand_name, price_usd, primary_category)""")


@pytest.mark.parametrize("search", [{"category": "makeup"}, {"brand": "BRAND x"}, {"min_price": 20, "max_price": 30}])
def test_product_search(served, search):
    assert rows(clean.find_products(served, **search), "product_id") == [("P001",), ("P003",)]


def test_paging_and_lookup(served):
    assert relate.page(served, ["product_id"], limit=1).count() == 1
    assert rows(relate.page(served, ["product_id"], limit=5, offset=2), "product_id") == [("P003",)]
    assert clean.product_by_id(served, "P002").count() == 1 and clean.product_by_id(served, "nope").isEmpty()


def test_served_layouts(served, raw_reviews):
    assert len(clean.served_products(served).columns) == 27
    assert len(clean.served_reviews(raw_reviews).columns) == 18


@pytest.mark.parametrize("salts", [0, 4])
def test_left_join_suffixes_and_salting(raw_reviews, served, salts):
    joined = relate.reviews_with_products(raw_reviews, served.withColumn("rating", F.lit(4.0)), salts=salts)
    assert {"rating_x", "rating_y"} <= set(joined.columns)
    assert rows(joined, "seq", "brand_name") == [(0, "Brand X"), (1, "Brand Y"), (2, "Brand X"), (3, None), (4, None)]


def test_cache_filter_reads_keys_as_text(spark, raw_reviews):
    cache = spark.createDataFrame([("U001",), ("U001",)], "author_id string")
    assert rows(relate.not_in_cache(raw_reviews, cache), "seq") == [(1,), (2,), (3,)]


def test_narrow_types(spark):
    df = spark.createDataFrame([(1, 300, 2**40, 1.5, "a"), (2, 4, 5, 2.5, "a"), (3, 4, 5, 2.5, "a")], "a long, b long, c long, d double, e string")
    narrow, report = clean.narrow_types(df)
    assert [t for _, t in narrow.dtypes] == ["tinyint", "smallint", "bigint", "float", "string"]
    assert report.where("column = 'e'").first()["category"] is True


def test_store_flag_keeps_its_name_in_the_input(spark):
    from shelfsight.operators.features import cap_without_flags

    df = spark.createDataFrame([("p", 1, 0)] + [("q", 0, n % 5) for n in range(9)], "product_id string, shop_exclusive int, loves_count int")
    served = clean.served_products(df, {"store_exclusive": "shop_exclusive"})
    assert [r["store_exclusive"] for r in served.collect()] == [1] + [0] * 9
    assert cap_without_flags().fit(df).transform(df).first()["shop_exclusive"] == 0
    assert cap_without_flags(["shop_exclusive"]).fit(df).transform(df).first()["shop_exclusive"] == 1


def test_duplicate_rows_by_digest(spark):
    from shelfsight.operators import profile

    df = spark.createDataFrame([("a", "b"), ("a", "b"), ("ab", ""), ("", "ab"), (None, "ab"), ("-", None), (None, "-")], "x string, y string")
    assert profile.duplicate_rows(df).first()["duplicates"] == 1
