import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

from shelfsight.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    made = session(
        "tests", master="local[8]",
        **{
            "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    made.sparkContext.setLogLevel("ERROR")
    yield made
    made.stop()


PRODUCTS = """
    select * from values
      ('P001', 'Lipstick A',   'Brand X', 25.0D, 4.5D, 1000.0D, 'Makeup',   0),
      ('P002', 'Foundation B', 'Brand Y', 45.0D, 3.2D, 5000.0D, 'Skincare', 1),
      ('P003', null,           'Brand Z', null,  5.0D, null,    'Makeup',   2),
      ('P004', 'Mascara D',    null,      -5.0D, 2.1D, 200.0D,  null,       3),
      ('P001', 'Lipstick A',   'Brand X', 25.0D, 4.5D, 1000.0D, 'Makeup',   4)
    as t(product_id, product_name, brand_name, price_usd, rating, loves_count, primary_category, seq)"""

REVIEWS = """
    select * from values
      ('U001', 5.0D, 1.0D, 0.9D, 10, 1, 9, '2024-01-01', 'Love this product!',       'Great!', 'fair',   'blue',  'dry',         'blonde', 'P001', 0),
      ('U002', 3.0D, 0.0D, 0.5D, 5,  2, 3, '2024-01-01', 'Not great, disappointed.', 'Meh',    'medium', 'brown', 'oily',        'black',  'P002', 1),
      ('U003', 1.0D, 0.0D, 0.1D, 3,  3, 0, '2024-01-01', 'Terrible quality.',        'Bad',    'dark',   'green', 'combination', 'brown',  'P003', 2),
      (null,   4.0D, 1.0D, null, 0,  0, 0, '2024-01-01', 'Pretty good overall.',     'Good',   null,     'hazel', null,          'red',    'P004', 3),
      ('U001', 5.0D, 1.0D, 0.9D, 10, 1, 9, '2024-01-01', 'Love this product!',       'Great!', 'fair',   'blue',  'dry',         'blonde', null,   4)
    as t(author_id, rating, is_recommended, helpfulness, total_feedback_count, total_neg_feedback_count, total_pos_feedback_count,
         submission_time, review_text, review_title, skin_tone, eye_color, skin_type, hair_color, product_id, seq)"""


@pytest.fixture()
def raw_products(spark):
    return spark.sql(PRODUCTS)


@pytest.fixture()
def raw_reviews(spark):
    return spark.sql(REVIEWS)


@pytest.fixture()
def raw_sentiment(spark):
    return spark.sql("""
        select * from values ('U001', 'Love it!', 1.0D, 'positive', 0.95D), ('U002', 'Not great', 0.0D, 'negative', 0.82D),
          ('U003', 'Terrible', 0.0D, 'unknown', 0.0D) as t(author_id, review_text, is_recommended, sentiment, sentiment_score)""")
