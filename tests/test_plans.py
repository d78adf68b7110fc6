"""What the physical plans look like, and that hot keys do not break them."""

from contextlib import contextmanager
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from catalogue.queries import QUERIES
from blockfee import operators as op
from blockfee import plans, schemas
from tests.lines import TXID, frame, node_line

SF_DIR = "/root/testdata/sf0.001"


@contextmanager
def settings(spark, **values):
    names = {key.replace("_", "."): value for key, value in values.items()}
    before = {key: spark.conf.get(key, None) for key in names}
    for key, value in names.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_and_no_pairwise_joins(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    for operator in ("Python", "Pandas", "CartesianProduct", "NestedLoop", "Scan ExistingRDD"):
        assert operator not in text
    # Windows go over a range of the order each, never over all rows.
    assert all("_part" in line for line in text.splitlines() if "Window [" in line)


def test_lines_are_parsed_once(spark, tmp_path):
    path = str(tmp_path / "lines")
    frame(spark, node_line()).write.text(path)
    lines = spark.read.text(path)
    assert plan(op.block_headers(op.accepted(op.node_blocks(lines)))).count("from_json") == 1
    references = plan(op.accepted(op.node_references(lines)).select("height", "txid"))
    # The height of a flat dict, of flat JSON or of any other line, and the id.
    assert references.count("regexp_extract(") == 4


def test_only_short_rows_reach_the_lookup(spark, tmp_path):
    path = str(tmp_path / "lines")
    frame(spark, node_line()).write.text(path)
    known = spark.createDataFrame([], "txid string, first_value decimal(18,8)")
    with settings(spark, spark_sql_autoBroadcastJoinThreshold="-1"):
        fees = plans.node_fees(spark.read.text(path), known)
        text = fees._jdf.queryExecution().sparkPlan().toString()
    join = text[text.index("Join") :]
    assert "Project [height" in join.split("\n")[1]


def hot_blocks(spark, rows):
    """A third of all blocks name the same transaction."""
    # Distinct long tails keep the shuffled bytes from compressing away.
    return spark.range(rows).select(
        F.col("id").alias("height"),
        F.when(F.col("id") % 3 == 0, F.lit(TXID)).otherwise(F.sha2(F.col("id").cast("string"), 256)).alias("txid"),
    )


def nested_transactions(spark, rows):
    ids = spark.range(rows).select(F.sha2(F.col("id").cast("string"), 256).alias("txid"))
    hot = spark.range(rows).select(F.lit(TXID).alias("txid"))
    output = F.array(F.struct(F.lit(0).alias("n"), F.lit(Decimal("26")).cast(schemas.COIN).alias("value")))
    return ids.unionByName(hot).withColumn("vout", output)


SPLITTING = {
    "spark_sql_autoBroadcastJoinThreshold": "-1",
    "spark_sql_adaptive_autoBroadcastJoinThreshold": "-1",
    "spark_sql_adaptive_skewJoin_skewedPartitionThresholdInBytes": "64KB",
    "spark_sql_adaptive_skewJoin_skewedPartitionFactor": "1.1",
    "spark_sql_adaptive_advisoryPartitionSizeInBytes": "64KB",
    "spark_sql_shuffle_partitions": "64",
}
ROWS = 300_000


def assert_split(counted, *want):
    assert tuple(counted.collect()[0]) == want
    assert "skew=true" in plan(counted)


def test_hot_transaction_is_split(spark):
    with settings(spark, **SPLITTING):
        coinbase = op.coinbase_values(nested_transactions(spark, ROWS))
        fees = op.node_fee(op.attach_coinbase(hot_blocks(spark, ROWS), coinbase))
        assert_split(fees.agg(F.count("*"), F.countDistinct("height")), ROWS, ROWS)


def test_hot_transaction_is_split_in_the_full_lookup(spark):
    with settings(spark, **SPLITTING):
        coinbase = op.coinbase_values(nested_transactions(spark, ROWS))
        refused = F.when(F.col("height") % 2 == 0, "bad_height")
        outcome = op.look_up_coinbase(
            hot_blocks(spark, ROWS).withColumn("reason", refused), coinbase
        )
        assert_split(outcome.agg(F.count("*"), F.count("reason")), ROWS, ROWS // 2)


def test_hot_height_is_split(spark):
    with settings(spark, **SPLITTING):
        hot = F.when(F.col("height") % 3 == 0, F.lit(7)).otherwise(F.col("height"))
        blocks = hot_blocks(spark, ROWS).withColumn("height", hot)
        wanted = spark.range(ROWS).withColumnRenamed("id", "height")
        found = op.blocks_at(wanted, blocks)
        assert_split(found.agg(F.count("*"), F.count("txid")), ROWS, ROWS)


def test_equal_points_are_shared_out_by_the_sort(spark):
    with settings(spark, spark_sql_adaptive_enabled="false", spark_sql_shuffle_partitions="8"):
        same = spark.range(80_000).select(
            F.lit(210_000).cast("bigint").alias("height"), F.lit(1).cast(schemas.COIN).alias("fee_btc")
        )
        parts = op.fee_series(same, 0, 300_000).groupBy(F.spark_partition_id()).count().collect()
        assert sum(r["count"] for r in parts) == 80_000
        assert max(r["count"] for r in parts) < 20_000


def test_hot_keys_merge_before_the_shuffle(spark):
    copies = nested_transactions(spark, 10_000)
    text = plan(op.coinbase_values(copies))
    assert text.count("Aggregate") >= 2 and "partial_min" in text
    assert op.coinbase_values(copies).count() == 10_001
