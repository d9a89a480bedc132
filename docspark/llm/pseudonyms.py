"""Format-preserving pseudonyms for personal data, in DataFrame functions only.

Numbers and dates that are valid as what they look like are replaced by others
of the same format, by a keyed Feistel permutation of their domain, so equal
values get equal pseudonyms in all documents and different values different ones:

- payment card numbers: all digits but the last are permuted, the last is the
  check digit again; numbers that fail the check are left alone
- telephone numbers: the digits after the country code
- social security numbers: all nine digits
- IPv4 addresses: all four bytes
- calendar dates from 1700 to 2499: the day within its 400-year cycle, which has
  146097 = 189 * 773 days

The name of an e-mail address and long hexadecimal secrets are no numbers; they
become keyed digests of the same kind. Separators and letters' case stay.

A null text stays null, an empty one empty; texts without such data are returned
as they are; repeated rows and ties need no rule; an empty table gives an empty
result; other columns pass through.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8

EMAIL = r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"

IP = r"(?<![\d.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?!\d|\.\d)"
DATE = r"(?<![\d./-])(?:\d{4}-\d{1,2}-\d{1,2}|\d{1,2}/\d{1,2}/\d{4}|\d{1,2}\.\d{1,2}\.\d{4})(?![\d/-]|\.\d)"
SSN = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])|(?<!\d)(?<!\d[ .-])\d{3} \d{2} \d{4}(?!\d|[.-]\d)"
#: Country codes; no code begins another.
CODE = r"(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})"
#: What may stand between two digits of a telephone number.
GAP = r"[ .()/ ‐-―-]{0,3}"
#: With a plus: groups of 3, 3 and 4 digits in any separators, eleven digits after +1, else 7 to 15 digits; national ones.
PHONE = "|".join(
    (
        r"\+\d{1,3}[^\p{L}\p{N}\n]{1,6}\d{3}[^\p{L}\p{N}\n]{1,6}\d{3}[ .-]?\d{4}(?!\d)",
        rf"\+1(?:{GAP}\d){{10}}(?!\d)",
        rf"\+\d(?:{GAP}\d){{6,14}}(?!\d|[./-]\d)",
        rf"\+\d(?:{GAP}\d){{6,14}}(?!\d)",
        r"(?<![\d(])\(\d{3}\)[ .-]?\d{3}[ .-]\d{4}(?!\d)",
        r"(?<!\d)(?<!\d[.-])(?:1[ .-])?\d{3}[ .-]\d{3}[ .-]\d{4}(?!\d|[.-]\d)",
    )
)
CARD = r"(?<!\d)(?<!\d[.-])(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3}(?:[ -]\d{1,3})?|\d{4}[ -]\d{6}[ -]\d{5})(?!\d|-\d)"
SECRET = r"(?<![\p{L}\p{N}])(?=[A-Fa-f]*\d)(?=\d*[A-Fa-f])[0-9A-Fa-f]{32,128}(?![\p{L}\p{N}])"
#: Every kind starts with a digit, a plus, a bracket or a hexadecimal letter; most places of a text are left at once.
NUMBERS = "(?=[0-9+(A-Fa-f])(?:" + "|".join((SECRET, IP, DATE, PHONE, SSN, CARD)) + ")"


def _draw(key: str, tweak: Column, turn: Column, value: Column, modulus: Column) -> Column:
    """A keyed number below ``modulus``: 60 bits of a SHA-256."""
    text = F.concat_ws("|", F.lit(key), tweak, turn.cast("string"), value.cast("string"))
    return F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("bigint") % modulus


def feistel(key: str, tweak: Column, left: Column, right: Column, left_size: Column, right_size: Column) -> Column:
    """``struct(l, r)``: the pair permuted among ``left_size * right_size`` pairs."""
    start = F.struct(left.cast("bigint").alias("l"), right.cast("bigint").alias("r"))

    def turn(s: Column, i: Column) -> Column:
        odd = i % 2 == 1
        return F.struct(
            F.when(odd, (s["l"] + _draw(key, tweak, i, s["r"], left_size)) % left_size).otherwise(s["l"]).alias("l"),
            F.when(odd, s["r"]).otherwise((s["r"] + _draw(key, tweak, i, s["l"], right_size)) % right_size).alias("r"),
        )

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, turn)


def _bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def permute_digits(key: str, kind: str, digits: Column) -> Column:
    """A string of 2 to 36 digits permuted among those of its length."""
    n = F.length(digits)
    half = F.floor(n / 2).cast("int")
    size = lambda k: F.concat(F.lit("1"), F.repeat(F.lit("0"), k)).cast("bigint")
    moved = feistel(key, F.concat(F.lit(f"{kind}:"), n.cast("string")), F.left(digits, half), F.right(digits, n - half), size(half), size(n - half))
    return _bind(moved, lambda m: F.concat(F.lpad(m["l"].cast("string"), half, "0"), F.lpad(m["r"].cast("string"), n - half, "0")))


def luhn_sum(digits: Column, doubled_last: bool) -> Column:
    """Sum of a digit string by the card rule; ``doubled_last`` where its last digit counts double."""
    backwards = F.split(F.reverse(digits), "")
    first = 1 if doubled_last else 0
    worth = F.transform(
        F.filter(backwards, lambda d: d != ""),
        lambda d, i: F.when(i % 2 == 1 - first, (d.cast("int") * 2) % 10 + F.floor(d.cast("int") / 5).cast("int")).otherwise(d.cast("int")),
    )
    return F.aggregate(worth, F.lit(0), lambda a, b: a + b)


def refill(pattern: Column, digits: Column) -> Column:
    """``pattern`` with its digits replaced in order by those of ``digits``."""
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("k"))

    def put(s: Column, c: Column) -> Column:
        is_digit = c.between("0", "9")
        return F.struct(F.concat(s["out"], F.when(is_digit, F.substr(digits, s["k"], F.lit(1))).otherwise(c)).alias("out"), (s["k"] + is_digit.cast("int")).alias("k"))

    return F.aggregate(F.filter(F.split(pattern, ""), lambda c: c != ""), start, put, lambda s: s["out"])


def _card(key: str, m: Column) -> Column:
    digits = _digits(m)
    valid = luhn_sum(digits, doubled_last=False) % 10 == 0
    payload = permute_digits(key, "card", F.left(digits, F.length(digits) - 1))
    checked = _bind(payload, lambda p: F.concat(p, ((10 - luhn_sum(p, doubled_last=True) % 10) % 10).cast("string")))
    return F.when(valid, refill(m, checked)).otherwise(m)


def _phone(key: str, m: Column) -> Column:
    """The digits after the country code, which is the same in all ways to write a number."""
    digits = _digits(m)
    code = F.when(m.startswith("+"), F.regexp_extract(digits, f"^{CODE}", 0)).when(F.length(digits) == 11, F.lit("1")).otherwise("")
    own = F.substr(digits, F.length(code) + 1)
    return refill(m, F.concat(code, permute_digits(key, "phone", own)))


def _ip(key: str, m: Column) -> Column:
    parts = F.transform(F.split(m, r"\."), lambda p: p.cast("int"))

    def moved(p: Column) -> Column:
        pair = feistel(key, F.lit("ip"), p[0] * 256 + p[1], p[2] * 256 + p[3], F.lit(65536), F.lit(65536))
        return _bind(pair, lambda v: F.concat_ws(".", *[x.cast("string") for h in ("l", "r") for x in (F.floor(v[h] / 256), v[h] % 256)]))

    return _bind(parts, lambda p: F.when(F.forall(p, lambda x: x <= 255), moved(p)).otherwise(m))


def _date(key: str, m: Column) -> Column:
    """Days first where the first number is above 12, else months first; with dots, days first."""
    iso, dotted = m.contains("-"), m.contains(".")
    short = m.rlike(r"(?<!\d)\d(?!\d)")  # 3/7/2021: no zeros are filled in
    a, b, c = (F.regexp_extract(m, r"^(\d+)\D(\d+)\D(\d+)$", i).cast("int") for i in (1, 2, 3))
    parts = F.struct(
        F.when(iso, a).otherwise(c).alias("y"),
        F.when(iso, b).when(dotted | (a > 12), b).otherwise(a).alias("m"),
        F.when(iso, c).when(dotted | (a > 12), a).otherwise(b).alias("d"),
        (dotted | (a > 12)).alias("days_first"),
    )

    def moved(p: Column) -> Column:
        leap = ((p["y"] % 4 == 0) & (p["y"] % 100 != 0)) | (p["y"] % 400 == 0)
        last = F.when(p["m"].isin(4, 6, 9, 11), 30).when(p["m"] == 2, F.when(leap, 29).otherwise(28)).otherwise(31)
        valid = p["y"].between(1700, 2499) & p["m"].between(1, 12) & (p["d"] >= 1) & (p["d"] <= last)
        start = F.when(p["y"] < 2100, F.lit("1700-01-01").cast("date")).otherwise(F.lit("2100-01-01").cast("date"))
        day = F.datediff(F.make_date(p["y"], p["m"], p["d"]), start)
        pair = feistel(key, F.lit("date"), F.floor(day / 773), day % 773, F.lit(189), F.lit(773))
        new = _bind(pair, lambda v: F.date_add(start, (v["l"] * 773 + v["r"]).cast("int")))
        # months first with a day up to 12 reads the same either way, so the result may be read either way too
        def shown(d: Column) -> Column:
            form = lambda long: F.when(short, F.date_format(d, long.replace("MM", "M").replace("dd", "d"))).otherwise(F.date_format(d, long))
            return (
                F.when(iso, form("yyyy-MM-dd"))
                .when(dotted, form("dd.MM.yyyy"))
                .when(p["days_first"], form("dd/MM/yyyy"))
                .otherwise(form("MM/dd/yyyy"))
            )

        return F.when(valid, _bind(new, shown)).otherwise(m)

    return _bind(parts, moved)


def _secret(key: str, m: Column) -> Column:
    """A keyed digest as long as the secret, in its case."""
    long = F.concat(*[F.sha2(F.concat_ws("|", F.lit(key), F.lit(f"secret{i}"), F.lower(m)), 256) for i in range(2)])
    cut = F.left(long, F.length(m))
    return F.when(m == F.upper(m), F.upper(cut)).otherwise(cut)


def number(key: str, m: Column) -> Column:
    """The pseudonym of one match of ``NUMBERS``, or the match itself where it is not valid."""
    whole = lambda pattern: m.rlike(f"^(?:{pattern})$")
    n = F.length(_digits(m))
    return (
        F.when(whole(SECRET), _secret(key, m))
        .when(whole(IP), _ip(key, m))
        .when(whole(DATE), _date(key, m))
        .when(whole(SSN), refill(m, permute_digits(key, "ssn", _digits(m))))
        .when(whole(PHONE), _phone(key, m))
        .when((n >= 13) & (n <= 19), _card(key, m))
        .otherwise(m)
    )


def email(key: str, m: Column) -> Column:
    """The address with a keyed digest for its name."""
    digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit("email"), F.lower(m)), 256)
    return F.concat(F.lit("u"), F.left(digest, F.lit(12)), F.lit("@"), F.substring_index(m, "@", -1))


def _rewrite(text: Column, pattern: str, new: Callable[[Column], Column]) -> Column:
    """``text`` with every match of a pattern replaced by a function of it."""
    found = F.transform(F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1)), new)
    return F.array_join(F.zip_with(F.split(text, pattern, -1), F.concat(found, F.array(F.lit(""))), lambda gap, new_one: F.concat(gap, new_one)), "")


def pseudonymise(docs: DataFrame, key: str, column: str = "text") -> DataFrame:
    """``docs`` with pseudonyms in its text column, and ``n_chars``, where it has one, counted anew."""
    text = F.col(column)
    numbered = docs.withColumn(column, F.when(text.rlike("[0-9]"), _rewrite(text, NUMBERS, lambda m: number(key, m))).otherwise(text))
    out = numbered.withColumn(column, F.when(text.contains("@"), _rewrite(text, EMAIL, lambda m: email(key, m))).otherwise(text))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length(column).cast(docs.schema["n_chars"].dataType))
    return out
