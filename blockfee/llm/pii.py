"""Personal data replaced by format-preserving pseudonyms, in SQL functions alone.

Numbers and dates that pass their validation (check digits, ranges, the calendar) are
permuted within their format by a keyed Feistel network: the pseudonym passes the same
validation, keeps separators and length, and equal values get equal pseudonyms in every
document. The network works on pairs (left, right) below (a, b) and adds to one side, in
turn, a keyed hash of the other, modulo its size; each step can be undone with the key.
E-mail addresses and credentials have no number to permute: they get a keyed digest in
their form.

Kinds: e-mail addresses; IPv4 addresses; IBANs (modulo 97); payment cards (Luhn); social
security numbers; telephone numbers; dates from 1800 to 2199 as yyyy-mm-dd, dd/mm/yyyy,
mm/dd/yyyy where the first can't be a month, and dd.mm.yyyy; credentials after a name
such as ``token`` or ``password``, in any case, and access key ids. An IBAN has its country's
length, whatever follows it. What looks alike but doesn't pass is left as it is.

Defined cases: a null text stays null, an empty one empty; a text of any length is read
whole; equal rows give equal rows; an empty table gives an empty result. Each row is worked on
alone, without a shuffle, so a frequent value costs no task more than its rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
#: A domain has 127 labels at most; a group that may repeat without end would cost stack for each of them.
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+){0,125}\.[A-Za-z]{2,}"
IPV4 = rf"(?<![\d.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\d|\.\d)"
#: Countries by the length of their IBANs, as registered.
IBAN_SIZES = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK",
    21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM",
    28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC",
    33: "RU",
}


def _iban_of(size: int, countries: str) -> str:
    groups, rest = divmod(size - 4, 4)
    end = rf" ?[A-Z0-9]{{{rest}}}" if rest else ""
    return rf"(?:{countries.replace(' ', '|')})\d{{2}}(?: ?[A-Z0-9]{{4}}){{{groups}}}{end}"


_REGISTERED = "|".join(IBAN_SIZES.values()).replace(" ", "|")
#: Of the country's length; other lengths and countries are matched as far as they may go.
IBAN = (
    rf"(?<![A-Za-z0-9])(?:(?:{'|'.join(_iban_of(*x) for x in IBAN_SIZES.items())})(?![A-Za-z0-9])"
    r"|[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9]))"
)
ISO_DATE = r"(?<![\d-])\d{4}-\d{2}-\d{2}(?![\d-])"
SLASH_DATE = r"(?<![\d/])\d{1,2}/\d{1,2}/\d{4}(?![\d/])"
DOT_DATE = r"(?<![\d.])\d{1,2}\.\d{1,2}\.\d{4}(?!\d|\.\d)"
SSN = r"(?<![\d-])(?!000|666|9)\d{3}-(?!00)\d{2}-(?!0000)\d{4}(?![\d-])"
PHONE = (
    r"(?<![\d+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){2,4}(?!\d)"
    r"|(?<!\d)\(\d{3}\) ?\d{3}-\d{4}(?!\d)|(?<![\d-])\d{3}-\d{3}-\d{4}(?![\d-])"
)
CARD = (
    r"(?<![\d-])(?:\d{13,19}|\d{4} \d{4} \d{4} \d{1,7}|\d{4}-\d{4}-\d{4}-\d{1,7}|\d{4} \d{6} \d{4,5}|\d{4}-\d{6}-\d{4,5})"
    r"(?![\d-])"
)
ACCESS_KEY = r"(?<![A-Za-z0-9])AKIA[0-9A-Z]{16}(?![A-Za-z0-9])"
CREDENTIAL = r"(?<![A-Za-z0-9])(?i:token|secret|api_key|password|passwd) {0,2}[=:] {0,2}[\"']?[A-Za-z0-9_-]{8,}"
_NUMBERS = rf"{EMAIL}|(?=[0-9+(])(?:{'|'.join((IPV4, ISO_DATE, SLASH_DATE, DOT_DATE, SSN, PHONE, CARD))})"
_NAMED = rf"(?=[TSAPtsap]){CREDENTIAL}"
#: What a text is searched for. Looking at the next character first keeps most places cheap.
ANY = f"{_NUMBERS}|(?=[A-Z])(?:{IBAN}|{ACCESS_KEY})|{_NAMED}"
#: What is looked for in a match of IBAN, or in its end, that is none.
_NOT_IBAN = f"{_NUMBERS}|(?=[A-Z]){ACCESS_KEY}|{_NAMED}"

#: Days from 1800-01-01 to 2199-12-31, a whole cycle of the calendar, as a product.
_DAYS = (189, 773)


def _long(text: Column) -> Column:
    return F.coalesce(text.try_cast("long"), F.lit(0).cast("long"))


def _ten(n: Column) -> Column:
    """10 ** n, up to 10 ** 18."""
    return F.rpad(F.lit("1"), n + 1, F.lit("0")).cast("long")


def permuted(left: Column, right: Column, a: Column, b: Column, kind: str | Column, key: str) -> Column:
    """The pair (left, right) permuted among all pairs below (a, b)."""

    def mixed(i: Column, value: Column) -> Column:
        said = F.concat_ws(":", F.lit(key), F.lit(kind), a.cast("string"), b.cast("string"), i.cast("string"), value.cast("string"))
        return F.conv(F.substring(F.sha2(said.cast("binary"), 256), 1, 15), 16, 10).cast("long")

    def step(pair: Column, i: Column) -> Column:
        even = i % 2 == 0
        return F.struct(
            F.when(even, F.pmod(pair["l"] + mixed(i, pair["r"]), a)).otherwise(pair["l"]).alias("l"),
            F.when(~even, F.pmod(pair["r"] + mixed(i, pair["l"]), b)).otherwise(pair["r"]).alias("r"),
        )

    start = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step)


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def permuted_digits(digits: Column, kind: str | Column, key: str) -> Column:
    """A string of 1 to 18 digits permuted among all of its length."""
    size = F.length(digits)
    first = F.floor(size / 2).cast("int")
    second = (size - first).cast("int")
    pair = permuted(
        _long(F.substr(digits, F.lit(1), first)), _long(F.substr(digits, first + 1)), _ten(first), _ten(second), kind, key
    )
    return _let(
        pair,
        lambda p: F.concat(F.lpad(p["l"].cast("string"), first, F.lit("0")), F.lpad(p["r"].cast("string"), second, F.lit("0"))),
    )


def all_permuted(digits: Column, kind: str, key: str) -> Column:
    """A string of up to 36 digits permuted, each of them.

    Beyond 18, the last 18 are permuted by a network that depends on the others, and these by
    one that depends on the new last 18; both steps can be undone with the key.
    """

    def chained(size: Column) -> Column:
        head, tail = F.substr(digits, F.lit(1), size), F.substr(digits, size + 1)
        new_tail = permuted_digits(tail, F.concat(F.lit(f"{kind}:"), head), key)
        return _let(new_tail, lambda t: F.concat(permuted_digits(head, F.concat(F.lit(f"{kind}<"), t), key), t))

    return F.when(F.length(digits) <= 18, permuted_digits(digits, kind, key)).otherwise(chained(F.length(digits) - 18))


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, r"[^0-9]", "")


def _refilled(form: Column, digits: Column) -> Column:
    """``form`` with its digits replaced, in order, by those of ``digits``."""
    characters = F.transform(
        F.sequence(F.lit(1), F.length(form)),
        lambda i: F.when(
            F.substr(form, i, F.lit(1)).rlike("[0-9]"),
            F.substr(digits, F.length(_digits(F.substr(form, F.lit(1), i))), F.lit(1)),
        ).otherwise(F.substr(form, i, F.lit(1))),
    )
    return F.array_join(characters, "")


def _luhn_sum(digits: Column) -> Column:
    """The sum that a check digit behind ``digits`` completes to a multiple of ten."""

    def add(total: Column, i: Column) -> Column:
        digit = F.substr(F.reverse(digits), i, F.lit(1)).cast("int")
        twice = F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2)
        return total + F.when(i % 2 == 1, twice).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add)


def _card(found: Column, key: str) -> Column:
    digits = _digits(found)
    size = F.length(digits)
    valid = F.pmod(_luhn_sum(F.substr(digits, F.lit(1), size - 1)) + F.substr(digits, size, F.lit(1)).cast("int"), F.lit(10)) == 0
    inner = permuted_digits(F.substr(digits, F.lit(2), size - 2), "card", key)
    new = _let(
        F.concat(F.substr(digits, F.lit(1), F.lit(1)), inner),
        lambda x: F.concat(x, F.pmod(-_luhn_sum(x), F.lit(10)).cast("string")),
    )
    return F.when(valid, _let(new, lambda x: _refilled(found, x)))


def _modulo_97(text: Column) -> Column:
    """Of the number that digits, and letters as 10 to 35, spell."""
    return F.aggregate(
        F.sequence(F.lit(1), F.length(text)),
        F.lit(0),
        lambda total, i: _let(
            F.substr(text, i, F.lit(1)),
            lambda c: F.when(c.rlike("[0-9]"), (total * 10 + _long(c).cast("int")) % 97).otherwise(
                (total * 100 + F.ascii(c) - 55) % 97
            ),
        ),
    )


def _is_iban(found: Column) -> Column:
    plain = F.replace(found, F.lit(" "), F.lit(""))
    head, body = F.substr(plain, F.lit(1), F.lit(4)), F.substr(plain, F.lit(5))
    return (_modulo_97(F.concat(body, head)) == 1) & (F.length(_digits(body)) > 0)


def _iban(found: Column, key: str) -> Column:
    """The first groups of the match that are valid, replaced; what follows them is searched for other kinds."""
    groups = F.split(found, " ")
    # The length of a registered country's IBAN is known, so nothing of its match is neighbouring text.
    least = F.when(found.rlike(f"^(?:{_REGISTERED})"), F.size(groups)).otherwise(F.lit(1))
    starts = F.transform(
        F.sequence(F.size(groups), least, F.lit(-1)), lambda k: F.array_join(F.slice(groups, F.lit(1), k), " ")
    )
    valid = F.filter(starts, lambda s: F.length(F.replace(s, F.lit(" "), F.lit(""))).between(12, 35) & _is_iban(s))

    def replaced(start: Column) -> Column:
        known = F.coalesce(start, F.lit(""))
        new = F.when(start.isNotNull(), _valid_iban(start, key)).otherwise(F.lit(""))
        return F.concat(new, _searched(F.substr(found, F.length(known) + 1), key))

    return _let(F.get(valid, F.lit(0)), replaced)


def _valid_iban(found: Column, key: str) -> Column:
    plain = F.replace(found, F.lit(" "), F.lit(""))
    body, country = F.substr(plain, F.lit(5)), F.substr(plain, F.lit(1), F.lit(2))
    # Letters stay.
    new_body = _let(_digits(body), lambda d: _refilled(body, all_permuted(d, "iban", key)))
    new = _let(
        new_body,
        lambda b: F.concat(
            F.lpad((98 - _modulo_97(F.concat(b, country, F.lit("00")))).cast("string"), 2, "0"), _digits(b)
        ),
    )
    return _let(new, lambda x: _refilled(found, x))


def _searched(text: Column, key: str) -> Column:
    """``text`` with the values of all kinds but IBANs replaced."""
    new = F.transform(F.regexp_extract_all(text, F.lit(_NOT_IBAN), F.lit(0)), lambda m: pseudonym(m, key, ibans=False))
    return _filled(F.split(text, _NOT_IBAN, -1), new)


def _filled(between: Column, new: Column) -> Column:
    return F.array_join(F.flatten(F.zip_with(between, new, lambda a, b: F.array(a, F.coalesce(b, F.lit(""))))), "")


def _ssn(found: Column, key: str) -> Column:
    area, group, serial = (F.split_part(found, F.lit("-"), F.lit(i)).cast("int") for i in (1, 2, 3))
    left = (area - 1 - (area > 666).cast("int")) * 99 + group - 1
    pair = permuted(left, serial - 1, F.lit(898 * 99), F.lit(9999), "ssn", key)

    def written(p: Column) -> Column:
        area = F.floor(p["l"] / 99) + 1
        area = area + (area >= 666).cast("int")
        return F.format_string("%03d-%02d-%04d", area.cast("int"), (p["l"] % 99 + 1).cast("int"), (p["r"] + 1).cast("int"))

    return _let(pair, written)


def _phone(found: Column, key: str) -> Column:
    country = F.regexp_extract(found, r"^\+\d{1,3}(?=[ .(-])", 0)
    rest = F.substr(found, F.length(country) + 1)
    new = _let(_digits(rest), lambda d: all_permuted(d, "phone", key))
    return _let(new, lambda x: F.concat(country, _refilled(rest, x)))


def _ipv4(found: Column, key: str) -> Column:
    octet = [F.split_part(found, F.lit("."), F.lit(i)).cast("int") for i in (1, 2, 3, 4)]
    size = F.lit(65536)
    pair = permuted(octet[0] * 256 + octet[1], octet[2] * 256 + octet[3], size, size, "ipv4", key)
    return _let(
        pair,
        lambda p: F.concat_ws(
            ".", *[x.cast("long").cast("string") for s in ("l", "r") for x in (F.floor(p[s] / 256), p[s] % 256)]
        ),
    )


def _date(found: Column, form: str, key: str) -> Column:
    """Null where the text is no date of the form."""
    first = F.lit("1800-01-01").cast("date")
    day = F.datediff(F.try_to_timestamp(found, F.lit(form)).cast("date"), first)
    a, b = _DAYS
    pair = permuted(F.floor(day / b), day % b, F.lit(a), F.lit(b), "date", key)
    new = _let(pair, lambda p: F.date_format(F.date_add(first, (p["l"] * b + p["r"]).cast("int")), form))
    return F.when(day.between(0, a * b - 1), new)


def _digest(found: Column, kind: str, key: str) -> Column:
    return F.sha2(F.concat_ws(":", F.lit(key), F.lit(kind), found).cast("binary"), 256)


def _credential(found: Column, key: str) -> Column:
    """The name stays; what it names is replaced by as many hexadecimal digits."""
    name = F.regexp_extract(found, r"^\w+ *[=:] *[\"']?", 0)
    size = F.length(found) - F.length(name)
    digits = F.repeat(_digest(F.substr(found, F.length(name) + 1), "credential", key), 1 + F.floor(size / 64).cast("int"))
    return F.concat(name, F.substr(digits, F.lit(1), size))


def pseudonym(found: Column, key: str, ibans: bool = True) -> Column:
    """What stands for a match of ``ANY``: itself if it isn't valid."""

    def whole(pattern: str) -> Column:
        return found.rlike(f"^(?:{pattern})$")

    slashes = F.when(
        F.length(found) == 10,
        F.coalesce(_date(found, "dd/MM/yyyy", key), _date(found, "MM/dd/yyyy", key)),
    ).otherwise(F.coalesce(_date(found, "d/M/yyyy", key), _date(found, "M/d/yyyy", key)))
    dots = F.when(F.length(found) == 10, _date(found, "dd.MM.yyyy", key)).otherwise(_date(found, "d.M.yyyy", key))
    mail = F.concat(F.lit("u"), F.substring(_digest(F.lower(found), "mail", key), 1, 16), F.lit("@example.com"))
    new = (
        (F.when(whole(IBAN), _iban(found, key)).when(whole(EMAIL), mail) if ibans else F.when(whole(EMAIL), mail))
        .when(whole(IPV4), _ipv4(found, key))
        .when(whole(ISO_DATE), _date(found, "yyyy-MM-dd", key))
        .when(whole(SLASH_DATE), slashes)
        .when(whole(DOT_DATE), dots)
        .when(whole(SSN), _ssn(found, key))
        .when(whole(PHONE), _phone(found, key))
        .when(whole(CARD), _card(found, key))
        .when(whole(ACCESS_KEY), F.concat(F.lit("AKIA"), F.upper(F.substring(_digest(found, "access", key), 1, 16))))
        .otherwise(_credential(found, key))
    )
    return F.coalesce(new, found)


def pseudonymised(docs: DataFrame, key: str, found: str | None = None) -> DataFrame:
    """``docs`` with personal data in ``text`` replaced, all columns kept.

    ``key`` is the secret that links and hides the values. ``found`` names a column to
    add: how many values were replaced.
    """
    matches = F.coalesce(F.regexp_extract_all("row.text", F.lit(ANY), F.lit(0)), F.array().cast("array<string>"))
    # Columns of docs travel in a struct, so that none can clash.
    rows = docs.select(F.struct(*docs.columns).alias("row")).select("row", matches.alias("old"))
    rows = rows.select("row", "old", F.transform("old", lambda m: pseudonym(m, key)).alias("new"))
    between = F.split("row.text", ANY, -1)
    text = F.when(F.size("old") > 0, _filled(between, F.col("new"))).otherwise(F.col("row.text"))
    changed = F.size(F.filter(F.zip_with("old", "new", lambda a, b: a != b), lambda x: x)).cast("long")
    columns = [(text if c == "text" else F.col("row").getField(c)).alias(c) for c in docs.columns]
    return rows.select(*columns, *([changed.alias(found)] if found else []))
