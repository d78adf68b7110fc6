"""Golden lines."""

TXID = "0123456789abcdef" * 4
OTHER = "f" * 64


def node_line(height="210000", tx=(TXID, OTHER), tail=", u'version': 2}"):
    ids = ", ".join(f"u'{t}'" for t in tx)
    return (
        "{u'hash': u'ab', u'confirmations': 1, u'size': 2, u'bits': u'cd', u'nonce': 3, "
        f"u'tx': [{ids}], u'merkleroot': u'ef', u'height': {height}" + tail
    )


FULL_TAIL = (
    ", u'version': 2, u'time': 1354116278, u'difficulty': Decimal('3438908.96015914'), "
    "u'chainwork': u'00ff', u'previousblockhash': u'aa', u'nextblockhash': None}"
)


def explorer_line(height="210000", fees="11294626"):
    return (
        "{u'k0': 0, u't1': u'2012-11-28T15:24:38Z', u'k2': 1, u'k3': 1, u'k4': 1, u'k5': 1, "
        "u'k6': 1, u'k7': 1, u'k8': 1, u'k9': 1, u'k10': 1, "
        f"u'height': {height}, u'fees': {fees}, u'difficulty': 1}}"
    )


def frame(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")
