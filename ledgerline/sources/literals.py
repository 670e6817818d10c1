"""Small lookup tables given as literal rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Segment names by number of clusters, best position first.
SEGMENT_LABELS = {
    2: ["Champions", "Lost"],
    3: ["Champions", "At Risk", "Lost"],
    4: ["Champions", "Loyal Customers", "At Risk", "Lost"],
    5: ["Champions", "Loyal Customers", "Potential Loyalists", "At Risk", "Lost"],
    6: ["Champions", "Loyal Customers", "Potential Loyalists", "At Risk", "Hibernating", "Lost"],
    7: ["Champions", "Loyal Customers", "Potential Loyalists", "Needs Attention", "At Risk", "Hibernating", "Lost"],
    8: ["Champions", "Loyal Customers", "Potential Loyalists", "New Customers", "Needs Attention", "At Risk",
        "Hibernating", "Lost"],
}

SEGMENT_ACTIONS = {
    "Champions": "reward loyalty and offer new products first",
    "Loyal Customers": "offer upgrades and complementary products",
    "Potential Loyalists": "invite into the loyalty scheme",
    "New Customers": "welcome and guide to a second order",
    "Needs Attention": "win back before the customer leaves",
    "At Risk": "win back before the customer leaves",
    "Hibernating": "re-engage at low cost by mail",
    "Lost": "re-engage at low cost by mail",
}


def segment_label_table(spark: SparkSession) -> DataFrame:
    rows = [(k, i + 1, label) for k, labels in SEGMENT_LABELS.items() for i, label in enumerate(labels)]
    return spark.createDataFrame(rows, "clusters int, position int, label string")


def segment_action_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(SEGMENT_ACTIONS.items()), "segment string, action string")
