"""Text clean-up of printed records: escapes and non-ASCII characters."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# An escape sequence, a run of plain text, or a lone trailing backslash.
_TOKEN = (
    r"(?s)\\(?:x[0-9a-fA-F]{2}|u[0-9a-fA-F]{4}|U[0-9a-fA-F]{8}|[0-7]{1,3}|.)"
    r"|[^\\]+|\\"
)

# Letters of escapes and the control characters they stand for.
_LETTERS, _CONTROLS = "abfnrtv", "\a\b\f\n\r\t\v"
# Escapes that stand for the character itself.
_PLAIN = "\\'\""


def _character(code: Column, token: Column) -> Column:
    """The character of a code point; half of a surrogate pair gives nothing."""
    wide = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    return (
        F.when(code < 128, F.char(code))
        .when(code.between(0xD800, 0xDFFF), F.lit(""))
        .when(code > 0x10FFFF, token)
        .otherwise(wide)
    )


def _decode_token(token: Column) -> Column:
    kind = F.substring(token, 2, 1)
    hexadecimal = kind.isin("x", "u", "U") & (F.length(token) > 2)
    octal = kind.between("0", "7")
    code = F.when(octal, F.conv(F.substring(token, 2, 3), 8, 10)).otherwise(
        F.conv(F.substring(token, 3, 8), 16, 10)
    )
    return (
        F.when(~token.startswith("\\"), token)
        .when(hexadecimal | octal, _character(code.cast("bigint"), token))
        .when(kind.isin(*_LETTERS), F.translate(kind, _LETTERS, _CONTROLS))
        .when(kind.isin(*_PLAIN), kind)
        .when(kind == "\n", F.lit(""))
        .otherwise(token)
    )


_NON_ASCII = r"[^\x00-\x7F]+"


def _has_escape(text: Column) -> Column:
    return F.contains(text, F.lit("\\"))


def _has_non_ascii(text: Column) -> Column:
    return F.octet_length(text) != F.char_length(text)


def _decoded(text: Column) -> Column:
    tokens = F.regexp_extract_all(text, F.lit(_TOKEN), F.lit(0))
    return F.array_join(F.transform(tokens, _decode_token), "")


def unescape(text: Column) -> Column:
    """Decode backslash escapes (``\\n``, ``\\xhh``, ``\\uhhhh``, octal, ...).

    Unknown and incomplete escapes stay as they are. Text without a backslash,
    the usual case, skips the tokeniser.
    """
    return F.when(_has_escape(text), _decoded(text)).otherwise(text)


def ascii_only(text: Column) -> Column:
    """Drop every non-ASCII character; pure ASCII text passes untouched."""
    return F.when(_has_non_ascii(text), F.regexp_replace(text, _NON_ASCII, "")).otherwise(text)


def normalise_text(text: Column) -> Column:
    """Unescape, then drop what is not ASCII."""
    return (
        F.when(_has_escape(text), F.regexp_replace(_decoded(text), _NON_ASCII, ""))
        .when(_has_non_ascii(text), F.regexp_replace(text, _NON_ASCII, ""))
        .otherwise(text)
    )


def to_json_text(**fields: Column) -> Column:
    """Serialise named columns to one compact JSON object."""
    return F.to_json(F.struct(*[column.alias(name) for name, column in fields.items()]))
