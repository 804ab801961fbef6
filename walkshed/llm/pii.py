"""Pseudonyms for personal data that keep its format, by keyed Feistel permutations.

E-mail addresses, IPv4 addresses, dates, social security numbers, phone numbers and card numbers are
found by pattern and validated; what is not valid stays. A value is cut in two
halves, and in each round one half is shifted, place by place, by a keyed hash of the
other. Every place stays within its own range, so the result has the format of the value
and is valid again, different values have different pseudonyms, and equal values have the same
one in all documents.

Everything is column expressions; nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 10

_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
#: What a value of each kind looks like. A value is of the first kind that fits.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,62}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){1,6}",
    "ip": rf"(?<![0-9.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\.?[0-9])",
    "date": r"(?<![0-9/-])(?:19|20)[0-9]{2}([-/])(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12][0-9]|3[01])(?![0-9/-])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "phone": r"(?<![A-Za-z0-9+])(?:\+[1-9][0-9]{0,2}[ .-]?(?:\([0-9]{2,4}\)|[0-9]{2,4})(?:[ .-]?[0-9]{2,4}){2,3}"
    r"|\([0-9]{3}\) ?[0-9]{3}[ -][0-9]{4}|[0-9]{3}([-.])[0-9]{3}\2[0-9]{4})(?![0-9])",
    "card": r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?:([ -])[0-9]{4})(?:\3[0-9]{4}){2})(?![0-9])",
}
PATTERN = "|".join(PATTERNS.values())

#: 200 years from 1900-01-01 are 73,049 days, the product of these two.
DATE_PARTS = (17, 4297)
FIRST_DAY = "1900-01-01"


def _digest(key: str, kind: str, turn: Column, other: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), turn.cast("string"), other, F.lit(key)).cast("binary"), 256)


def _rounds(left: Column, right: Column, shift: Callable[[Column, Column, bool], Column], digest, join) -> Column:
    """The Feistel network: halves take turns, each shifted by a hash of the other."""

    def turn(acc: Column, at: Column) -> Column:
        odd = F.struct(
            shift(acc["left"], digest(at, acc["right"]), True).alias("left"), acc["right"].alias("right")
        )
        even = F.struct(
            acc["left"].alias("left"), shift(acc["right"], digest(at, acc["left"]), False).alias("right")
        )
        return F.when(at % 2 == 1, odd).otherwise(even)

    halves = F.struct(left.alias("left"), right.alias("right"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), halves, turn, join)


def _hex_number(digest: Column, at: Column, digits: int) -> Column:
    return F.conv(F.substring(digest, at * digits + 1, F.lit(digits)), 16, 10).cast("bigint")


def permute_text(value: Column, key: str, kind: str) -> Column:
    """Digits and A-Z, a-z letters (up to 64 characters) permuted in place; others stay."""
    half = F.floor(F.length(value) / 2).cast("int")

    def moved(char: Column, by: Column) -> Column:
        out = char
        for alphabet in ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"):
            at = F.instr(F.lit(alphabet), char)
            to = F.substring(F.lit(alphabet), ((at - 1 + by) % len(alphabet) + 1).cast("int"), F.lit(1))
            out = F.when((at > 0) & (char != ""), to).otherwise(out)
        return out

    def shift(part: Column, digest: Column, _: bool) -> Column:
        return F.array_join(F.transform(F.split(part, ""), lambda c, i: moved(c, _hex_number(digest, i, 2))), "")

    return _rounds(
        F.substring(value, F.lit(1), half), F.substring(value, half + 1, F.length(value)), shift,
        lambda turn, other: _digest(key, kind, turn, other), lambda acc: F.concat(acc["left"], acc["right"]),
    )


def permute_numbers(left: list, right: list, ranges: tuple[tuple, tuple], key: str, kind: str) -> Column:
    """Numbers below ``ranges`` permuted together; an array of the left ones, then the right ones."""

    def numbers(values: list) -> Column:
        return F.array(*[v.cast("bigint") for v in values])

    def shift(part: Column, digest: Column, is_left: bool) -> Column:
        below = F.array(*[F.lit(n).cast("bigint") for n in ranges[0 if is_left else 1]])
        return F.transform(part, lambda x, i: (x + _hex_number(digest, i, 8)) % F.get(below, i))

    return _rounds(
        numbers(left), numbers(right), shift,
        lambda turn, other: _digest(key, kind, turn, F.array_join(other.cast("array<string>"), ",")),
        lambda acc: F.concat(acc["left"], acc["right"]),
    )


def luhn_sum(digits: Column) -> Column:
    """The sum of a digit text in which every second digit from the right counts twice."""
    counted = F.transform(
        F.split(F.reverse(digits), ""),
        lambda c, i: F.when(i % 2 == 0, c.try_cast("int")).otherwise(
            F.floor(c.try_cast("int") * 2 / 10).cast("int") + c.try_cast("int") * 2 % 10
        ),
    )
    return F.aggregate(counted, F.lit(0), lambda acc, n: acc + F.coalesce(n, F.lit(0)))


def _card(value: Column, key: str) -> Column:
    """A card number with its first digit kept, the others permuted and the check digit made anew."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    inner = permute_text(F.substring(digits, F.lit(2), F.length(digits) - 2), key, "card")
    payload = F.concat(F.substring(digits, 1, 1), inner)
    check = (10 - luhn_sum(F.concat(payload, F.lit("0"))) % 10) % 10
    made = F.concat(payload, check.cast("string"))
    fours = [F.substring(made, 1 + 4 * i, 4) for i in range(4)]
    separator = F.substring(value, 5, 1)
    placed = F.when(separator == "-", F.concat_ws("-", *fours)).when(separator == " ", F.concat_ws(" ", *fours)).otherwise(made)
    return F.when(luhn_sum(digits) % 10 == 0, placed)


def _ip(value: Column, key: str) -> Column:
    octets = [F.split_part(value, F.lit("."), F.lit(i)) for i in (1, 2, 3, 4)]
    made = permute_numbers(octets[:2], octets[2:], ((256, 256), (256, 256)), key, "ip")
    return F.array_join(made.cast("array<string>"), ".")


def _date(value: Column, key: str) -> Column:
    separator = F.substring(value, 5, 1)
    day = F.try_to_date(F.regexp_replace(value, "/", "-"), "yyyy-MM-dd")
    at = F.date_diff(day, F.lit(FIRST_DAY).cast("date"))
    left, right = DATE_PARTS
    made = permute_numbers([F.floor(at / right)], [at % right], ((left,), (right,)), key, "date")
    moved = F.date_add(F.lit(FIRST_DAY).cast("date"), (F.get(made, F.lit(0)) * right + F.get(made, F.lit(1))).cast("int"))
    return F.when(day.isNotNull(), F.replace(F.date_format(moved, "yyyy-MM-dd"), F.lit("-"), separator))


def _ssn(value: Column, key: str) -> Column:
    """Areas 001 to 899 without 666, groups from 01 and serials from 0001 are valid."""
    area, group, serial = (F.split_part(value, F.lit("-"), F.lit(i)).cast("int") for i in (1, 2, 3))
    valid = (area > 0) & (area < 900) & (area != 666) & (group > 0) & (serial > 0)
    place = area - F.when(area > 666, 2).otherwise(1)
    made = permute_numbers([place, group - 1], [serial - 1], ((898, 99), (9999,)), key, "ssn")
    new_area = F.get(made, F.lit(0)) + F.when(F.get(made, F.lit(0)) >= 665, 2).otherwise(1)
    parts = ((new_area, 3), (F.get(made, F.lit(1)) + 1, 2), (F.get(made, F.lit(2)) + 1, 4))
    return F.when(valid, F.concat_ws("-", *[F.lpad(p.cast("string"), n, "0") for p, n in parts]))


def _phone(value: Column, key: str) -> Column:
    """The country code stays, the other digits are permuted."""
    code = F.regexp_extract(value, r"^\+[0-9]{1,3}(?=[ .(-])", 0)
    rest = F.substring(value, F.length(code) + 1, F.length(value))
    return F.concat(code, permute_text(rest, key, "phone"))


def _email(value: Column, key: str) -> Column:
    """The part before the @ is permuted, the domain stays."""
    name = F.substring_index(value, "@", 1)
    return F.concat(permute_text(name, key, "email"), F.substring(value, F.length(name) + 1, F.length(value)))


_MADE = {"email": _email, "ip": _ip, "date": _date, "ssn": _ssn, "phone": _phone, "card": _card}


def kind_of(value: Column) -> Column:
    found = F.lit(None).cast("string")
    for kind in reversed(PATTERNS):
        whole = f"^(?:{PATTERNS[kind]})$".replace(r"\2", r"\1").replace(r"\3", r"\1")
        found = F.when(value.rlike(whole), F.lit(kind)).otherwise(found)
    return found


def pseudonym(value: Column, kind: Column, key: str) -> Column:
    """The pseudonym of a value of a kind; null if it is not valid."""
    made = F.lit(None).cast("string")
    for name, make in _MADE.items():
        made = F.when(kind == name, make(value, key)).otherwise(made)
    return made


def pseudonymise(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, pseudo_text, found): every row's text with personal data replaced.

    ``found`` has the kind and pseudonym of each replaced value, in order. The key decides all
    pseudonyms and has to be kept secret. Null texts stay null, with nothing found. Repeated rows each
    return a row. Other columns are not read. An empty table gives none.
    """
    text = F.col("text__")
    values = F.when(text.rlike("[0-9@]"), F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))).otherwise(
        F.array().cast("array<string>")
    )
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text__")).withColumn(
        "values__", F.coalesce(values, F.array().cast("array<string>"))
    )
    kinds = F.transform("values__", lambda v: F.struct(v.alias("value"), kind_of(v).alias("kind")))
    rows = rows.withColumn("kinds__", kinds)
    made = F.transform(
        "kinds__",
        lambda v: F.struct(v["value"].alias("value"), v["kind"].alias("kind"), pseudonym(v["value"], v["kind"], key).alias("pseudonym")),
    )
    rows = rows.withColumn("made__", made)
    between = F.split(text, PATTERN, -1)
    replaced = F.concat(F.transform("made__", lambda m: F.coalesce(m["pseudonym"], m["value"])), F.array(F.lit("")))
    new_text = F.array_join(F.zip_with(between, replaced, lambda a, b: F.concat(F.coalesce(a, F.lit("")), F.coalesce(b, F.lit("")))), "")
    valid = F.filter("made__", lambda m: m["pseudonym"].isNotNull())
    return rows.select(
        "id",
        F.when(F.size("made__") == 0, text).otherwise(new_text).alias("pseudo_text"),
        F.transform(valid, lambda m: F.struct(m["kind"].alias("kind"), m["pseudonym"].alias("pseudonym"))).alias("found"),
    )
