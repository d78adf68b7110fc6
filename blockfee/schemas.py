"""Fixed, declared schemas of every record kind the package handles."""

from pyspark.sql import types as T

COIN = T.DecimalType(18, 8)
TOTAL_COIN = T.DecimalType(28, 8)

#: One decoded block header with its transaction ids. Field names are those of
#: the public node interface, so that a printed record maps onto them directly.
BLOCK = T.StructType(
    [
        T.StructField("hash", T.StringType()),
        T.StructField("confirmations", T.LongType()),
        T.StructField("size", T.LongType()),
        T.StructField("height", T.LongType()),
        T.StructField("version", T.IntegerType()),
        T.StructField("time", T.LongType()),
        T.StructField("nonce", T.LongType()),
        T.StructField("bits", T.StringType()),
        T.StructField("difficulty", T.DecimalType(30, 8)),
        T.StructField("chainwork", T.StringType()),
        T.StructField("previousblockhash", T.StringType()),
        T.StructField("nextblockhash", T.StringType()),
        T.StructField("merkleroot", T.StringType()),
        T.StructField("tx", T.ArrayType(T.StringType())),
    ]
)

#: The two fields used from an explorer record.
EXPLORER_BLOCK = T.StructType(
    [
        T.StructField("height", T.LongType()),
        T.StructField("fees", T.LongType()),
    ]
)

#: A decoded transaction; `vout` keeps the order in which outputs were listed.
TRANSACTION = T.StructType(
    [
        T.StructField("txid", T.StringType()),
        T.StructField(
            "vout",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("n", T.IntegerType()),
                        T.StructField("value", COIN),
                    ]
                )
            ),
        ),
    ]
)

FEE = T.StructType(
    [
        T.StructField("height", T.LongType()),
        T.StructField("fee_btc", COIN),
        T.StructField("fee_sat", T.LongType()),
        T.StructField("source", T.StringType()),
    ]
)

#: A keyed cell: putting the same (rowkey, family, qualifier) again replaces it.
CELL = T.StructType(
    [
        T.StructField("rowkey", T.StringType()),
        T.StructField("family", T.StringType()),
        T.StructField("qualifier", T.StringType()),
        T.StructField("value", T.StringType()),
    ]
)

CELL_KEY = ("rowkey", "family", "qualifier")
