"""Transaction ids in half the space, for what is shuffled by them."""

from pyspark.sql import Column
from pyspark.sql import functions as F

_BYTES = 32
_DIGITS = rf"\A[0-9a-f]{{{2 * _BYTES}}}\z"
#: Before texts that aren't ids, so that none is as long as one.
_OTHER = bytearray(_BYTES + 1)


def pack_id(txid: Column) -> Column:
    """The 32 bytes of 64 lower-case hexadecimal digits; any other text gives more bytes, null gives null."""
    return F.when(txid.rlike(_DIGITS), F.unhex(txid)).otherwise(F.concat(F.lit(_OTHER), txid.cast("binary")))


def unpack_id(packed: Column) -> Column:
    """The text that ``pack_id`` packed."""
    other = F.substring(packed, len(_OTHER) + 1, 2**31 - 1).cast("string")
    return F.when(F.octet_length(packed) == _BYTES, F.lower(F.hex(packed))).otherwise(other)
