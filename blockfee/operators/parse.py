"""Parsers from text lines to typed columns.

Each parser keeps the columns of its input and adds the parsed ones and
``reason``: null for a usable line, otherwise why it is not usable. All of it is
narrow: no shuffle, and Catalyst drops the fields nobody reads.

``named`` reads fields by name and is the default: of a printed dict or of a JSON
object, and of the record itself, not of anything nested in it. ``positional`` addresses a
field by its place between colons, which only fits lines printed in one exact
field order. Both read whole numbers: what isn't digits up to the next comma or
closing brace is refused.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blockfee.functions import JSON_OPTIONS, list_items, literal_to_json, normalise_text
from blockfee.operators.once import with_columns_once
from blockfee.schemas import BLOCK, EXPLORER_BLOCK

# Places of fields in positional lines, counted in colons from 0.
NODE_TX_SEGMENT = 6
NODE_HEIGHT_SEGMENT = 8
EXPLORER_HEIGHT_SEGMENT = 14
EXPLORER_FEE_SEGMENT = 15

TXID = "^[0-9a-f]{64}$"

# A text in either kind of quotes, and a list or dict that nests a few levels deep. All groups
# are possessive, so they run in a loop, however long the line is.
_QUOTED = r"""'(?:[^'\\]++|\\.)*+'|"(?:[^"\\]++|\\.)*+\""""
_ATOM = rf"""[^'"\[\]{{}}]++|{_QUOTED}"""
_DEEPEST = 6
# A list of ids, nearly all of a line: nothing in it can be a bracket of another kind.
_IDS = r"""\[[0-9a-fu'", ]*+\]"""


def _nested(levels: int) -> str:
    inner = f"|{_nested(levels - 1)}" if levels > 1 else ""
    return rf"[\[{{](?:{_ATOM}{inner})*+[\]}}]"


def _own_pattern(key: str, value: str) -> str:
    field = rf"""['"]{key}['"]\s*:\s*"""
    return rf"^\s*\{{(?:(?!{field})(?:{_ATOM}|{_IDS}|{_nested(_DEEPEST)}))*+{field}{value}"


_FIRST_ITEM = r"""^\s*u?['"]([0-9a-f]*)['"]"""
_HEIGHT, _TXID = r"(\d+)L?\s*[,}]", r"""\[\s*u?['"]([0-9a-f]*)['"]"""


def _own_field(key: str, value: str) -> Column:
    """What the pattern ``value`` captures under ``key`` in the record itself.

    A line with a single brace and one kind of quotes has nothing nested that could have
    keys, nor texts that look like one, so that the key can be searched for right away.
    """
    line = F.col("value")
    flat = line.startswith("{") & ~line.startswith("{{") & ~F.contains(F.ltrim(line, F.lit("{")), F.lit("{"))
    single, double = (F.contains("value", F.lit(quote)) for quote in "'\"")
    usual = F.regexp_extract("value", f"'{key}': {value}", 1)
    json = F.regexp_extract("value", rf'"{key}"\s*:\s*{value}', 1)
    walked = F.regexp_extract("value", _own_pattern(key, value), 1)
    return F.when(flat & ~double, usual).when(flat & ~single, json).otherwise(walked)


def _number(segment: Column, group: int = 1) -> Column:
    """The digits between a colon and the next comma or closing brace; group 0 keeps the blank."""
    return F.nullif(F.regexp_extract(segment, r"^( ?(\d+))L?[,}]", 2 if group else 1), F.lit(""))


def _with_segments(lines: DataFrame) -> DataFrame:
    """The cleaned line, cut at its colons, as ``_segments``."""
    return with_columns_once(lines, _segments=F.split(normalise_text(F.col("value")), ":"))


def _with_list_cut(lines: DataFrame, key: str) -> DataFrame:
    """Take the flat list stored under ``key`` out of a printed dict.

    Adds ``_items``, the text between the brackets, and ``_rest``, the dict with
    an empty list instead. Id lists are nearly the whole of a block line; this
    way only the short rest meets regular expressions and the JSON parser, while
    cutting is plain text search.
    """
    # The usual spelling is a plain text, which is several times faster to find.
    usual = f"'{key}': ["
    begin = F.when(F.contains("value", F.lit(usual)), rf"'{key}': \[").otherwise(rf"""['"]{key}['"]\s*:\s*\[""")
    halves = with_columns_once(lines, _halves=F.split("value", begin, 2))
    cut = with_columns_once(halves, _list=F.split(F.get("_halves", 1), r"\]", 2))
    rest = F.concat_ws(f"'{key}': []", F.get("_halves", 0), F.get("_list", 1))
    return cut.withColumns({"_rest": rest, "_items": F.get("_list", 0)}).drop("_halves", "_list")


def _unreadable(closed: bool) -> str:
    """Reason why a line is no printed record at all, else null."""
    line = "trim(coalesce(value, ''))"
    truncated = f"WHEN NOT endswith({line}, '}}') THEN 'truncated'" if closed else ""
    return f"""CASE WHEN {line} = '' THEN 'empty_line'
        WHEN NOT startswith({line}, '{{') THEN 'stray_text' {truncated} END"""


def _with_reason(parsed: DataFrame, bad: str, closed: bool) -> DataFrame:
    """Add ``reason``: that of an unreadable line, else that of a bad field.

    Where lines need not be closed, readable fields are good enough.
    """
    unreadable = _unreadable(closed)
    reason = f"coalesce({unreadable}, {bad})"
    if not closed:
        reason = f"CASE WHEN ({bad}) IS NOT NULL THEN {reason} END"
    return with_columns_once(parsed, reason=F.expr(reason))


_BAD_REFERENCE = f"""CASE WHEN height IS NULL THEN 'bad_height'
    WHEN NOT coalesce(txid RLIKE '{TXID}', false) THEN 'bad_txid' END"""
_BAD_EXPLORER = """CASE WHEN height IS NULL THEN 'bad_height'
    WHEN fee_sat IS NULL THEN 'bad_fee' END"""


def node_references(lines: DataFrame, mode: str = "named") -> DataFrame:
    """Height and id of the generation transaction of each node block line.

    Adds ``height_text`` (as printed), ``height``, ``txid`` and ``reason``.
    """
    if mode == "positional":
        parsed = with_columns_once(
            _with_segments(lines),
            height_text=_number(F.get("_segments", NODE_HEIGHT_SEGMENT)),
            txid=F.substring(F.get("_segments", NODE_TX_SEGMENT), 5, 64),
        ).withColumn("height", F.col("height_text").try_cast("bigint"))
        return _with_reason(parsed, _BAD_REFERENCE, closed=False).drop("_segments")
    if mode == "named":
        parsed = with_columns_once(
            lines,
            height_text=_own_field("height", _HEIGHT),
            txid=F.regexp_extract("value", _own_pattern("tx", _TXID), 1),  # it ends where the list begins
        ).withColumn("height", F.col("height_text").try_cast("bigint"))
        return _with_reason(parsed, _BAD_REFERENCE, closed=True)
    raise ValueError(f"unknown parse mode: {mode!r}")


def node_blocks(lines: DataFrame) -> DataFrame:
    """Every field of each node block line, by name, plus ``txid`` and ``reason``."""
    parsed = with_columns_once(
        _with_list_cut(lines, "tx"),
        _record=F.from_json(literal_to_json(F.col("_rest")), BLOCK, JSON_OPTIONS),
        txid=F.regexp_extract("_items", _FIRST_ITEM, 1),
    )
    fields = {name: F.col("_record")[name] for name in BLOCK.fieldNames() if name != "tx"}
    # No filter looks at the whole list, so whoever does not read it does not split it.
    fields["tx"] = list_items(F.col("_items"))
    blocks = _with_reason(parsed.withColumns(fields), _BAD_REFERENCE, closed=True)
    return blocks.drop("_record", "_rest", "_items")


def explorer_fields(lines: DataFrame, mode: str = "named") -> DataFrame:
    """Height and ready-made fee of each explorer block line.

    Adds ``height`` and ``fee_sat`` and ``reason``; in positional mode also the
    texts as cut: ``height_text``, ``fee_text`` and ``fee_text_padded`` (which
    keeps the blank in front).
    """
    if mode == "positional":
        segments = with_columns_once(
            _with_segments(lines),
            height_text=_number(F.get("_segments", EXPLORER_HEIGHT_SEGMENT)),
            fee_text=_number(F.get("_segments", EXPLORER_FEE_SEGMENT)),
            fee_text_padded=_number(F.get("_segments", EXPLORER_FEE_SEGMENT), 0),
        )
        parsed = segments.withColumns(
            {
                "height": F.col("height_text").try_cast("bigint"),
                "fee_sat": F.col("fee_text").try_cast("bigint"),
            }
        )
        return _with_reason(parsed, _BAD_EXPLORER, closed=False).drop("_segments")
    if mode == "named":
        record = F.from_json(literal_to_json(F.col("_rest")), EXPLORER_BLOCK, JSON_OPTIONS)
        cut = _with_list_cut(lines, "transaction_hashes")
        parsed = with_columns_once(cut, _record=record).withColumns(
            {"height": F.col("_record")["height"], "fee_sat": F.col("_record")["fees"]}
        )
        blocks = _with_reason(parsed, _BAD_EXPLORER, closed=True)
        return blocks.drop("_record", "_rest", "_items")
    raise ValueError(f"unknown parse mode: {mode!r}")
