"""The derived test tables use their inputs whole and tell variants apart."""

import pytest
from pyspark.sql import functions as F

from casewright import contracts as C
from casewright.plans import fixtures as fx


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_every_document_reaches_a_ticket(spark, sf):
    docs = fx.read(spark, sf, "documents").select("text").distinct()
    texts = fx.tickets(spark, sf, "complaint_text").select(
        F.regexp_replace("complaint_text", "^(PMAY house |Subhadra yojana |Subhadra |Ration Card |land )", "").alias("text"))
    assert docs.join(texts.distinct(), "text", "left_anti").count() == 0


def test_variants_occur(spark):
    rows = fx.tickets(spark, "/root/testdata/sf0.001", "office", "mode", "status_id").cache()
    assert {r[0] for r in rows.select("office").distinct().collect()} == set(C.OFFICES.values())
    modes = {m for group in C.CHANNEL_MODES.values() for m in group}
    assert modes <= {r[0] for r in rows.select("mode").distinct().collect()}
    assert rows.where("office = 'Governor' AND status_id = 2").count() == 0
    assert rows.where(F.col("mode").isin(*C.CHANNEL_MODES["online"]) & (F.col("office") == "DG & IG Police")).count() == 0
    statuses = {r[0] for r in fx.actions(spark, "/root/testdata/sf0.001", "action_status").distinct().collect()}
    assert set(C.ACTION_STATUSES) < statuses


def test_shipping_dates_join_in_as_many_tasks_as_the_session_names(spark):
    rows = fx.tickets(spark, "/root/testdata/sf0.01", "ticket_no", "resolved_on")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sizes = rows.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    assert len(sizes) == parts and sum(r["count"] for r in sizes) == fx.read(spark, "/root/testdata/sf0.01", "orders").count()
