import pytest
from pyspark.sql import functions as F

from shelfsight.operators.contracts import CLEAN_PRODUCTS, CLEAN_REVIEWS, RAW_PRODUCTS, RAW_REVIEWS, ContractError
from shelfsight.plans.transforms import clean_products, clean_reviews


def test_negative_price_fails(raw_products):
    kept, valid = RAW_PRODUCTS.validate(raw_products)
    assert not valid and kept is raw_products
    assert RAW_PRODUCTS.failure_counts(raw_products) == {("price_usd", "greater_than_or_equal_to(0)"): 1}
    with pytest.raises(ContractError):
        RAW_PRODUCTS.validate(raw_products, strict=True)


def test_label_out_of_range_fails(raw_reviews):
    bad = raw_reviews.withColumn("is_recommended", F.lit(2.0))
    assert RAW_REVIEWS.failure_counts(bad) == {("is_recommended", "isin([0.0, 1.0])"): 5}
    listed = RAW_REVIEWS.violations(bad).collect()
    assert len(listed) == 5 and {r["failure_case"] for r in listed} == {"2.0"}


def test_raw_reviews_pass_and_are_typed(raw_reviews):
    kept, valid = RAW_REVIEWS.validate(raw_reviews)
    assert valid and dict(kept.dtypes)["total_feedback_count"] == "double"


def test_clean_tables_pass(raw_products, raw_reviews):
    # The nameless product is the one thing the strict contract objects to.
    products = clean_products(raw_products, 950.0, ["seq"])
    assert CLEAN_PRODUCTS.failure_counts(products) == {("product_name", "not_nullable"): 1}
    assert CLEAN_PRODUCTS.validate(products.where("product_name is not null"), strict=True)[1]
    assert CLEAN_REVIEWS.validate(clean_reviews(raw_reviews, ["seq"]), strict=True)[1]


def test_uncastable_text_and_missing_columns(spark):
    df = spark.createDataFrame([("x", "dear"), ("y", "3")], "product_id string, price_usd string")
    counts = RAW_PRODUCTS.failure_counts(df)
    assert counts[("price_usd", "coerce_dtype(double)")] == 1
    assert counts[("rating", "column_in_dataframe")] == 1
    assert RAW_PRODUCTS.violations(df).where("check = 'column_in_dataframe'").count() == 5


def test_every_failure_of_a_row_is_listed(spark):
    df = spark.sql("select 'a' product_id, 'n' product_name, 'b' brand_name, -1D price_usd, 9D rating, -2D loves_count, 'c' primary_category")
    assert RAW_PRODUCTS.violations(df).count() == 3
