"""Format-preserving pseudonyms for personal numbers, dates and addresses, with Spark SQL functions only.

Candidates are found by format and validated: check digits of cards (Luhn) and accounts (modulo 97),
octets, social security ranges, real calendar days. Where a candidate fails, or is a card or account of
an unusual length, the text is read again and only candidates that pass count: cards in their usual
groups and accounts of their country's length at any place, then the other formats, and last the long
readings of cards. A valid value is replaced by another valid one of
the same format under a keyed Feistel permutation: an alternating network whose halves are added to,
modulo their size, a keyed hash of the other half. It is a permutation, so different values stay
different, and equal values of a format get equal pseudonyms in all documents. Phone numbers whose area and
exchange codes can exist, private addresses and public ones stay so. Values are compared by
their letters and digits; separators stay where they are. What fails validation stays as it is.

Null texts stay null and have no matches; all columns of the input are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
FIRST_DAY = "1900-01-01"
DAY_SIZES = (270, 271)  # 73,170 days from FIRST_DAY; other dates stay
OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
FORMATS = {  # tried in this order at each position
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "account": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "date": r"(?<![0-9./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}([./])[0-9]{2}\1[0-9]{4})(?![0-9]|[./-][0-9])",
    "ip": rf"(?<![0-9.])(?:{OCTET}\.){{3}}{OCTET}(?![0-9]|\.[0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9])",
    "card": r"(?<![0-9])[0-9](?:[ -]?[0-9]){12,18}(?![0-9])",
    "phone": r"(?<![0-9+])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])",
}
ANY = "|".join(FORMATS.values())
# What the formats have around them, and the readings that are tried inside a longer one.
ACCOUNT_ENDS, CARD_ENDS, DATE_ENDS = (
    (r"(?<![A-Za-z0-9])", r"(?![A-Za-z0-9])"), (r"(?<![0-9])", r"(?![0-9])"), (r"(?<![0-9./-])", r"(?![0-9]|[./-][0-9])"))
ACCOUNT_SIZES = {  # letters and digits of an account, and the countries that have so many
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ DZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IR IS TR", 27: "BF BI BJ CF CG CI CM DJ FR GA GN GR IT MC MG ML MR NE SM SN TD TG",
    28: "AL AZ BY CY DO GQ GT GW HN HU LB NI PL SV TH", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC",
    32: "LC", 33: "RU",
}
ACCOUNT = "|".join(f"(?:{'|'.join(countries.split())})[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{{(size - 4) // 4}}}" + (
    f" ?[A-Z0-9]{{{size % 4}}}" if size % 4 else "") for size, countries in ACCOUNT_SIZES.items())
CARD = "|".join("[ -]".join(f"[0-9]{{{n}}}" for n in groups) for groups in (
    ("13,19",), (4, 4, 4, 4), (4, 6, 5), (4, 6, 4), (4, 4, 5), (4, 4, 4, 1), (4, 3, 3, 3)))
LONG_CARD = r"[0-9]{4}(?:[ -][0-9]{4}){3}[ -][0-9]{3}"
LONG_FIRST = "^(?:5[0678]|6)"  # of networks with cards of 19 digits; for others the last three are rather a CVV
DATE = r"[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}([./])[0-9]{2}\2[0-9]{4}"
SSN = r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9]|-[0-9])"
MAYBE = "[@0-9]"


def _keyed(key: str, *parts: Column) -> Column:
    """60 bits of a keyed hash."""
    return F.conv(F.substring(F.sha2(F.concat_ws("|", F.lit(key), *[p.cast("string") for p in parts]).cast("binary"), 256),
                              1, 15), 16, 10).cast("bigint")


def permute_pair(left: Column, right: Column, sizes: tuple, key: str, format: str | Column) -> Column:
    """A permutation of pairs of numbers below ``sizes``, as a struct (l, r)."""
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(ROUNDS)), F.struct(left.cast("bigint").alias("l"), right.cast("bigint").alias("r")),
        lambda s, i: F.when(i % 2 == 0, F.struct(
            s["l"].alias("l"), F.pmod(s["r"] + _keyed(key, F.lit(format), i, s["l"]), F.lit(sizes[1])).alias("r"))).otherwise(
                F.struct(F.pmod(s["l"] + _keyed(key, F.lit(format), i, s["r"]), F.lit(sizes[0])).alias("l"), s["r"].alias("r"))))


def permute_letters(value: Column, key: str, format: str) -> Column:
    """A permutation of strings that keeps each character's class: digits, ASCII capitals and lower-case
    letters move within their class, all others stay."""
    half = F.floor(F.length(value) / 2).cast("int")

    def shifted(part: Column, other: Column, i: Column) -> Column:
        def one(c, at):
            code, by = F.ascii(c), _keyed(key, F.lit(format), i, at, other)
            move = lambda first, size: F.char(first + F.pmod(code - first + by, F.lit(size)))
            return (F.when(c.rlike("^[0-9]$"), move(48, 10)).when(c.rlike("^[A-Z]$"), move(65, 26))
                    .when(c.rlike("^[a-z]$"), move(97, 26)).otherwise(c))
        return F.array_join(F.transform(F.split(part, ""), one), "")

    state = F.struct(F.substring(value, F.lit(1), half).alias("l"),
                     F.substring(value, half + 1, F.length(value)).alias("r"))
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(ROUNDS)), state,
        lambda s, i: F.when(i % 2 == 0, F.struct(s["l"].alias("l"), shifted(s["r"], s["l"], i).alias("r"))).otherwise(
            F.struct(shifted(s["l"], s["r"], i).alias("l"), s["r"].alias("r"))),
        lambda s: F.concat(s["l"], s["r"]))


def once(value: Column, then) -> Column:
    """``then`` of a value that is worked out once, however often it is named."""
    return F.transform(F.array(value), then)[0]


def _code(number: Column) -> Column:
    """Whether three digits are an area or exchange code that can exist (``real``), their place among those
    that can, or else among those that cannot, and how many there are."""
    real = (number >= 200) & (number % 100 != 11)
    place = F.when(real, 99 * (F.floor(number / 100) - 2) + number % 100 - F.when(number % 100 > 11, 1).otherwise(0)).when(
        number < 200, number).otherwise(198 + F.floor(number / 100))
    return F.struct(real.alias("real"), place.cast("bigint").alias("place"), F.when(real, 792).otherwise(208).alias("of"))


def _from_code(real: Column, place: Column) -> Column:
    rest = place % 99
    number = F.when(real, 200 + 100 * F.floor(place / 99) + rest + F.when(rest >= 11, 1).otherwise(0)).otherwise(
        F.when(place < 200, place).otherwise((place - 198) * 100 + 11))
    return F.lpad(number.cast("bigint").cast("string"), 3, "0")


def permute_phone(number: Column, key: str) -> Column:
    """A permutation of ten digits under which codes that can exist stay such, and others others."""
    digits = lambda n, at, size: F.substring(n, at, size).cast("int")
    parts = once(number, lambda n: F.struct(
        _code(digits(n, 1, 3)).alias("a"), _code(digits(n, 4, 3)).alias("b"), digits(n, 7, 4).alias("line")))
    new = lambda x: permute_pair(
        x["a"]["place"], x["b"]["place"] * 10_000 + x["line"], (x["a"]["of"], x["b"]["of"] * 10_000), key,
        F.concat_ws("-", F.lit("phone"), x["a"]["real"].cast("string"), x["b"]["real"].cast("string")))
    return once(parts, lambda x: once(new(x), lambda s: F.concat(
        _from_code(x["a"]["real"], s["l"]), _from_code(x["b"]["real"], F.floor(s["r"] / 10_000)),
        F.lpad((s["r"] % 10_000).cast("string"), 4, "0"))))


# Blocks that no public host has, by first octet, with the range of the second.
RESERVED = {0: (0, 255), 10: (0, 255), 100: (64, 127), 127: (0, 255), 169: (254, 254), 172: (16, 31), 192: (168, 168),
            198: (18, 19)}
LAST_UNICAST = 223


def permute_address(value: Column, key: str) -> Column:
    """A permutation of addresses under which reserved blocks, the rest of their first octets, and each first
    octet beyond unicast stay among themselves, and public addresses public."""
    octets = once(F.transform(F.split(value, r"\."), lambda x: x.cast("int")), lambda x: F.struct(*[
        x[i].alias(name) for i, name in enumerate("abcd")]))

    def placed(x):
        low, high = F.lit(0), F.lit(255)
        for first, (least, most) in RESERVED.items():
            low, high = F.when(x["a"] == first, least).otherwise(low), F.when(x["a"] == first, most).otherwise(high)
        below = sum((F.when(x["a"] > first, 1).otherwise(0) for first in RESERVED), F.lit(0))
        return F.struct(x["a"].alias("a"), x["b"].alias("b"), (x["c"] * 256 + x["d"]).alias("rest"), low.alias("low"), (
            high - low + 1).alias("size"), below.alias("below"), (~x["a"].isin(*RESERVED) & (x["a"] <= LAST_UNICAST)).alias("plain"))

    def classed(x):
        inside = x["b"].between(x["low"], x["low"] + x["size"] - 1)
        left = F.when(x["plain"], (x["a"] - x["below"]) * 256 + x["b"]).when(inside, x["b"] - x["low"]).when(
            x["b"] < x["low"], x["b"]).otherwise(x["b"] - x["size"])
        of = F.when(x["plain"], (LAST_UNICAST + 1 - len(RESERVED)) * 256).when(inside, x["size"]).otherwise(256 - x["size"])
        name = F.when(x["plain"], "ip").otherwise(F.concat_ws("-", F.lit("ip"), x["a"].cast("string"), inside.cast("string")))
        return F.struct(x.alias("x"), inside.alias("inside"), left.cast("bigint").alias("left"), of.alias("of"), name.alias("name"))

    def shown(y, s):
        x, place = y["x"], F.floor(s["l"] / 256)
        # The number of the place among first octets that are not reserved, and of reserved ones up to it.
        first = place + sum((F.when(place >= block - i, 1).otherwise(0) for i, block in enumerate(sorted(RESERVED))), F.lit(0))
        second = F.when(x["plain"], s["l"] % 256).when(y["inside"], s["l"] + x["low"]).when(s["l"] < x["low"], s["l"]).otherwise(
            s["l"] + x["size"])
        return F.concat_ws(".", *[n.cast("bigint").cast("string") for n in (
            F.when(x["plain"], first).otherwise(x["a"]), second, F.floor(s["r"] / 256), s["r"] % 256)])

    new = lambda y: permute_pair(y["left"], y["x"]["rest"], (y["of"], F.lit(65536)), key, y["name"])
    return once(once(once(octets, placed), classed), lambda y: once(new(y), lambda s: shown(y, s)))


def only(value: Column, kept: str) -> Column:
    return F.regexp_replace(value, f"[^{kept}]", "")


def refill(shape: Column, letters: Column, kept: str) -> Column:
    """``shape`` with its ``kept`` characters replaced, in order, by ``letters``."""
    state = F.struct(F.lit("").alias("out"), F.lit(1).alias("next"))
    return F.aggregate(F.split(shape, ""), state, lambda s, c: F.when(
        c.rlike(f"^[{kept}]$"), F.struct(F.concat(s["out"], F.substring(letters, s["next"], F.lit(1))).alias("out"),
                                         (s["next"] + 1).alias("next"))).otherwise(
            F.struct(F.concat(s["out"], c).alias("out"), s["next"].alias("next"))), lambda s: s["out"])


def luhn_digit(payload: Column) -> Column:
    """The check digit that follows ``payload``."""
    total = F.aggregate(
        F.transform(F.split(F.reverse(payload), ""), lambda c, i: F.when(c == "", 0).otherwise(
            F.when(i % 2 == 1, c.cast("int")).when(c.cast("int") > 4, c.cast("int") * 2 - 9).otherwise(c.cast("int") * 2))),
        F.lit(0), lambda acc, x: acc + x)
    return F.pmod(10 - total % 10, F.lit(10)).cast("string")


def account_check(account: Column) -> Column:
    """The two check digits of an account number: country, any two digits, body."""
    moved = F.concat(F.substring(account, F.lit(5), F.length(account)), F.substring(account, 1, 2), F.lit("00"))
    rest = F.aggregate(F.split(moved, ""), F.lit(0), lambda acc, c: F.when(c == "", acc).when(
        c.rlike("[0-9]"), (acc * 10 + c.cast("int")) % 97).otherwise((acc * 100 + F.ascii(c) - 55) % 97))
    return F.lpad((98 - rest).cast("string"), 2, "0")


def pseudonym(kind: str, value: Column, key: str) -> Column:
    """The pseudonym of a value, null if it is not valid."""
    digits = only(value, "0-9")
    if kind == "email":
        name = F.substring_index(value, "@", 1)
        return F.concat(permute_letters(name, key, kind), F.substring(value, F.length(name) + 1, F.length(value)))
    if kind == "phone":
        number = F.right(digits, F.lit(10))
        before = F.substring(digits, F.lit(1), F.length(digits) - 10)
        return refill(value, F.concat(before, permute_phone(number, key)), "0-9")
    if kind == "card":
        payload = F.substring(digits, F.lit(1), F.length(digits) - 1)
        new = permute_letters(payload, key, kind)
        return F.when(F.right(digits, F.lit(1)) == luhn_digit(payload), refill(value, F.concat(new, luhn_digit(new)), "0-9"))
    if kind == "account":
        plain = only(value, "A-Z0-9")
        body = F.substring(plain, F.lit(5), F.length(plain))
        new = F.concat(F.substring(plain, 1, 2), F.lit("00"), permute_letters(body, key, kind))
        new = F.concat(F.substring(plain, 1, 2), account_check(new), F.substring(new, F.lit(5), F.length(new)))
        return F.when(F.substring(plain, 3, 2) == account_check(plain), refill(value, new, "A-Z0-9"))
    if kind == "ssn":
        area, group, serial = (F.substring(digits, a, n).cast("int") for a, n in ((1, 3), (4, 2), (6, 4)))
        number = F.when(area > 666, area - 2).otherwise(area - 1)  # 001 to 899 without 666
        new = permute_pair(number, (group - 1) * 9999 + serial - 1, (898, 99 * 9999), key, kind)
        written = F.transform(F.array(new), lambda s: F.concat_ws(
            "-", F.lpad((s["l"] + F.when(s["l"] >= 665, 2).otherwise(1)).cast("string"), 3, "0"),
            F.lpad((F.floor(s["r"] / 9999) + 1).cast("string"), 2, "0"), F.lpad((s["r"] % 9999 + 1).cast("string"), 4, "0")))
        return F.when((area > 0) & (area < 900) & (area != 666) & (group > 0) & (serial > 0), written[0])
    if kind == "ip":
        return permute_address(value, key)
    orders = {"yyyy-MM-dd": (F.substring(value, 5, 1) == "-"), "dd/MM/yyyy": F.substring(value, 3, 1) == "/",
              "MM/dd/yyyy": F.substring(value, 3, 1) == "/", "dd.MM.yyyy": F.substring(value, 3, 1) == "."}
    tries = []
    for order, fits in orders.items():
        day = F.datediff(F.try_to_timestamp(value, F.lit(order)).cast("date"), F.lit(FIRST_DAY).cast("date"))
        new = permute_pair(F.floor(day / DAY_SIZES[1]), day % DAY_SIZES[1], DAY_SIZES, key, "date")
        shown = F.transform(F.array(new), lambda s: F.date_format(F.date_add(
            F.lit(FIRST_DAY).cast("date"), (s["l"] * DAY_SIZES[1] + s["r"]).cast("int")), order))[0]
        tries.append(F.when(fits & (day >= 0) & (day < DAY_SIZES[0] * DAY_SIZES[1]), shown))
    return F.coalesce(*tries)


def kind_of(value: Column) -> Column:
    kind = F.lit(None).cast("string")
    for name, pattern in reversed(FORMATS.items()):
        kind = F.when(value.rlike(f"^(?:{pattern})$"), name).otherwise(kind)
    return kind


def unusual(x: Column) -> Column:
    """Whether a match is a card or an account that one of its usual readings may be a part of."""
    return ((x["kind"] == "card") & ~x["value"].rlike(f"^(?:{CARD})$")) | (
        (x["kind"] == "account") & ~x["value"].rlike(f"^(?:{ACCOUNT})$"))


def valid(kind: str, value: Column) -> Column:
    """Whether a reading passes its check."""
    digits, plain = only(value, "0-9"), only(value, "A-Z0-9")
    if kind == "card":
        return F.right(digits, F.lit(1)) == luhn_digit(F.substring(digits, F.lit(1), F.length(digits) - 1))
    if kind == "account":
        return F.substring(plain, 3, 2) == account_check(plain)
    return pseudonym(kind, value, "").isNotNull()


def readings(text: Column, kind: str, pattern: str, ends: tuple[str, str]) -> Column:
    """The valid readings of a pattern at every place of a text, also within one another."""
    every = F.regexp_extract_all(text, F.lit(f"{ends[0]}(?=({pattern}){ends[1]})"), F.lit(1))
    return F.filter(F.array_distinct(every), lambda v: valid(kind, v))


def one_of(values: Column) -> Column:
    return F.when(F.size(values) == 0, F.lit("(?!)")).otherwise(F.concat(
        F.lit(r"(?:\Q"), F.array_join(values, r"\E|\Q"), F.lit(r"\E)")))


def with_pattern(docs: DataFrame, value: Column) -> DataFrame:
    """``docs`` with ``__pattern``: ``ANY``, or where one of its matches (``__first``) fails or is unusual,
    that of the formats with the valid readings of cards, accounts and dates in the place of their
    patterns. Valid matches of unusual length stay, after the usual ones."""
    again = F.exists("__first", lambda x: x["new"].isNull() | unusual(x))
    kept = lambda kind: F.array_distinct(F.transform(F.filter(
        "__first", lambda x: (x["kind"] == kind) & x["new"].isNotNull() & unusual(x)), lambda x: x["value"]))
    # Each step is a column of its own, so that it is worked out once.
    docs = docs.withColumn("__long", F.when(again, readings(value, "card", LONG_CARD, CARD_ENDS)))
    docs = docs.withColumn("__usual", F.when(again, one_of(F.concat(
        F.filter("__long", lambda v: v.rlike(LONG_FIRST)), readings(value, "card", CARD, CARD_ENDS),
        F.filter("__long", lambda v: ~v.rlike(LONG_FIRST))))))
    docs = docs.withColumn("__other", F.when(again, kept("card")))
    # An unusual card gives way to a usual one that begins at a later group of its own.
    others = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(18)), lambda n: F.concat(
        F.lit("(?!(?:[0-9]+[ -]){1,"), n.cast("string"), F.lit("}"), F.col("__usual"), F.lit("(?![0-9]))"), one_of(
            F.filter("__other", lambda v: F.size(F.split(v, "[ -]")) == n + 1)))), "|")
    within = lambda ends, middle: F.concat(F.lit(ends[0]), middle, F.lit(ends[1]))
    pattern = F.concat_ws(
        "|", F.lit(FORMATS["email"]), within(ACCOUNT_ENDS, one_of(F.concat(
            readings(value, "account", ACCOUNT, ACCOUNT_ENDS), kept("account")))),
        within(DATE_ENDS, one_of(readings(value, "date", DATE, DATE_ENDS))), F.lit(FORMATS["ip"]), F.lit(SSN),
        within(CARD_ENDS, F.col("__usual")), F.lit(FORMATS["phone"]), F.when(F.size("__other") > 0, within(
            CARD_ENDS, F.concat(F.lit("(?:"), others, F.lit(")")))))
    return docs.withColumn("__pattern", F.when(F.col("__usual").isNotNull(), pattern).otherwise(F.lit(ANY))).drop(
        "__long", "__usual", "__other")


def pseudonymise(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``docs`` with ``text`` rewritten and ``private``: the kinds of its valid values, in order."""
    value = F.col(text)
    replaced = lambda x: F.coalesce(*[F.when(x["kind"] == k, pseudonym(k, x["value"], key)) for k in FORMATS])

    def found(pattern):
        kinds = F.transform(F.regexp_extract_all(value, pattern, F.lit(0)),
                            lambda x: F.struct(x.alias("value"), kind_of(x).alias("kind")))
        return F.transform(kinds, lambda x: F.struct(x["value"].alias("value"), x["kind"].alias("kind"), replaced(x).alias("new")))

    none = F.array().cast("array<struct<value:string,kind:string,new:string>>")
    docs = docs.withColumn("__first", F.when(value.rlike(MAYBE), found(F.lit(ANY))).otherwise(none))
    docs = with_pattern(docs, value)
    docs = docs.withColumn("__found", F.when(F.col("__pattern") == ANY, F.col("__first")).otherwise(found(F.col("__pattern"))))
    parts = F.zip_with(F.split(value, F.col("__pattern"), -1), F.col("__found"), lambda gap, x: F.concat(
        F.coalesce(gap, F.lit("")), F.coalesce(x["new"], x["value"], F.lit(""))))
    return docs.withColumn(text, F.when(F.size("__found") > 0, F.array_join(parts, "")).otherwise(value)).withColumn(
        "private", F.transform(F.filter("__found", lambda x: x["new"].isNotNull()), lambda x: x["kind"])).drop(
            "__first", "__pattern", "__found")
