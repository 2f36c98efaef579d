"""A cross-section of the queries with whole-stage code generation, which the other tests run without."""

import pytest
from test_oracles import duck, test_query_equals_sql as equals_sql  # noqa: F401

NAMES = [
    "user_stats", "feat_user_behavior", "feature_frame", "extractor_features", "feature_csv", "running_user_profile", "roc_auc",
    "threshold_sweep", "correlation_with_label", "validation_split", "decode_reject", "alerts", "upserted", "history_document_round_trip",
]


@pytest.mark.parametrize("name", NAMES)
def test_generated_code(spark, data, duck, name):  # noqa: F811
    spark.conf.set("spark.sql.codegen.wholeStage", "true")
    try:
        equals_sql(spark, data, duck, name)
    finally:
        spark.conf.set("spark.sql.codegen.wholeStage", "false")
