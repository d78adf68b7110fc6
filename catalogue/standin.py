"""Chain data stood in for by the given tables.

Orders are blocks, lineitems are outputs of generation transactions, events are
JSON records. Lines are rendered in the printed form that the parsers read.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blockfee.functions import to_json_text
from blockfee.operators import output_values
from blockfee.operators.once import with_columns_once
from blockfee.schemas import COIN

FIRST_HEIGHT = 210_000

ORDER_COLUMNS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_totalprice")

# Fixed value: text that a loader prints between the records.
STRAY_TEXT = "No data from Hbase"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Heights one apart, and 60 apart from 0, where a few thousand cross several eras.
DENSE_HEIGHT = f"o_orderkey + {FIRST_HEIGHT}"
WIDE_HEIGHT = "o_orderkey * 60"

# A printed block. {height} is an expression.
_NODE_LINE = """concat(
    "{{u'hash': u'", sha2(concat('h', o_orderkey), 256),
    "', u'confirmations': ", o_custkey + 1,
    ", u'size': ", o_custkey + 1000,
    ", u'bits': u'", lpad(lower(hex(o_custkey)), 8, '0'),
    "', u'nonce': ", o_custkey,
    ", u'tx': [u'", sha2(string(o_orderkey), 256),
    "', u'", sha2(concat(o_orderkey, '-1'), 256),
    "', u'", sha2(concat(o_orderkey, '-2'), 256),
    "'], u'merkleroot': u'", sha2(concat('m', o_orderkey), 256),
    "', u'height': ", {height},
    ", u'version': 2, u'time': ", o_orderkey * 600 + 1354116278,
    ", u'difficulty': Decimal('", cast(o_totalprice AS decimal(18,2)),
    "'), u'chainwork': u'", lpad(lower(hex(o_orderkey)), 64, '0'), "'",
    if(o_orderkey = 0, '',
       concat(", u'previousblockhash': u'", sha2(concat('h', o_orderkey - 1), 256), "'")),
    ", u'nextblockhash': ",
    if(o_orderstatus = 'P', 'None', concat("u'", sha2(concat('h', o_orderkey + 1), 256), "'")),
    "}}")"""

# A printed explorer record: 14 colons before the height, 15 before the fee.
_EXPLORER_LINE = f"""concat(
    "{{u'k0': 0, u't1': u'2012-11-28T15:24:38Z', u'k2': 1, u'k3': 1, u'k4': 1, u'k5': 1,",
    " u'k6': 1, u'k7': 1, u'k8': 1, u'k9': 1, u'k10': 1, u'height': ", {DENSE_HEIGHT},
    ", u'fees': ", cast(cast(o_totalprice AS decimal(18,2)) * 100 AS bigint),
    ", u'difficulty': 1}}")"""


def node_lines(spark: SparkSession, sf_dir: str, height: str = DENSE_HEIGHT) -> DataFrame:
    """One printed block per order, with the order's own columns beside it."""
    orders = table(spark, sf_dir, "orders").select(*ORDER_COLUMNS)
    return with_columns_once(orders, value=F.expr(_NODE_LINE.format(height=height)))


def flawed_node_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Node lines, those of some order priorities and states spoilt in different ways."""
    priority, status = F.col("o_orderpriority"), F.col("o_orderstatus")
    # No whole number, or none of the block itself.
    spoilt = ("'height': -$1", "'height': $1.5", "'height': $1abc", "'next': {u'height': $1}")
    no_height = F.element_at(F.array(*map(F.lit, spoilt)), (F.col("o_orderkey") % 4 + 1).cast("int"))
    value = (
        F.when(priority == "1-URGENT", F.lit(STRAY_TEXT))
        .when(priority == "2-HIGH", F.lit(""))
        .when(priority == "3-MEDIUM", F.substr("value", F.lit(1), F.length("value") - 40))
        .when((priority == "5-LOW") & (status == "F"), F.regexp_replace("value", r"'height': (\d+)", no_height))
        .when((priority == "5-LOW") & (status == "O"), F.regexp_replace("value", r"'tx': \[u'.", "'tx': [u'X"))
        .otherwise(F.col("value"))
    )
    return node_lines(spark, sf_dir).select(value.alias("value"))


def flawed_explorer_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Explorer records, the fee or height of some states spoilt."""
    value = (
        F.when(F.col("o_orderstatus") == "P", F.regexp_replace("value", r"'fees': \d+", "'fees': None"))
        .when(F.col("o_orderstatus") == "F", F.regexp_replace("value", r"'height': \d+", "'height': None"))
        .otherwise(F.col("value"))
    )
    return explorer_lines(spark, sf_dir).select(value.alias("value"))


def flawed_json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON records, those of some event types without an id or broken."""
    kind = F.get_json_object("value", "$.type")
    value = (
        F.when(kind == "click", F.regexp_replace("value", '"id":', '"no":'))
        .when(kind == "view", F.concat("value", F.lit(" junk")))
        .when(kind == "purchase", F.regexp_replace("value", r'"id":(\d+)', r'"id":{"a":$1}'))
        .otherwise(F.col("value"))
    )
    return json_lines(spark, sf_dir).select(value.alias("value"))


def explorer_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One printed explorer record per order; the fee is the order's price."""
    orders = table(spark, sf_dir, "orders").select(*ORDER_COLUMNS)
    return with_columns_once(orders, value=F.expr(_EXPLORER_LINE))


def json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON record per event; ``id`` is the number kept in its properties."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "props")
    record = to_json_text(
        id=F.get_json_object("props", "$.k").cast("bigint"),
        event=F.col("event_id"),
        user=F.col("user_id"),
        type=F.col("event_type"),
    )
    return with_columns_once(events, value=record).select("value")


def coinbase(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Generation transactions: the lineitems of an order are the outputs.

    Aggregated by the short order key; the 64-digit id is made once per
    transaction, after the aggregation.
    """
    outputs = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.col("l_extendedprice").cast("decimal(18,8)").alias("value"),
    )
    values = output_values(outputs, "l_orderkey", ["l_linenumber", "l_partkey", "l_suppkey"])
    return with_columns_once(values, txid=F.sha2(F.col("l_orderkey").cast("string"), 256))


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same transactions in full, with their outputs nested in order; an order has a few lineitems."""
    outputs = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        F.struct(
            "l_linenumber", "l_partkey", "l_suppkey", F.col("l_extendedprice").cast(COIN).alias("value")
        ).alias("output"),
    )
    nested = outputs.groupBy("l_orderkey").agg(F.array_sort(F.collect_list("output")).alias("outputs"))
    vout = F.transform(
        "outputs", lambda x: F.struct(x["l_linenumber"].cast("int").alias("n"), x["value"].alias("value"))
    )
    return nested.select(F.sha2(F.col("l_orderkey").cast("string"), 256).alias("txid"), vout.alias("vout"))


def loaded_heights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Heights with a generation transaction."""
    lines = table(spark, sf_dir, "lineitem")
    return lines.select((F.col("l_orderkey") + FIRST_HEIGHT).alias("height"))


def tip(spark: SparkSession, sf_dir: str) -> int:
    """The first height beyond the chain."""
    last = table(spark, sf_dir, "orders").agg(F.max("o_orderkey")).first()[0]
    return FIRST_HEIGHT + (0 if last is None else last + 1)
