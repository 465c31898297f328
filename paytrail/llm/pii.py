"""Format-preserving pseudonyms for personal numbers, dates and addresses, in column functions.

Every value found is checked first (Luhn digit, calendar date, octets, dialling pattern).
A keyed Feistel network permutes the values of one format, so equal values get equal
pseudonyms in every document and different values different ones. The permutation used is
``decrypt(encrypt(x) + 1)``: one long cycle, in which no value stands for itself.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paytrail.llm.common import unused

ROUNDS = 8
#: Default key, for demonstrations only: pass your own.
KEY = "paytrail"

#: Patterns of the values, in the order they are tried at a place. Runs are possessive and
#: begin at a boundary, so a long text without a match is read once.
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)*\.[A-Za-z]{2,}+"
PHONE = (
    r"(?<![\w+])(?:\+?1[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?![\w-])"
    r"|(?<![\w+])\+1\d{10}(?!\w)"
)
IPV4 = r"(?<![\w.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?!\w|\.\d)"
DATE = r"(?<![\w/.-])(?:[1-9]\d{3}-\d{2}-\d{2}|\d{2}/\d{2}/[1-9]\d{3}|\d{2}\.\d{2}\.[1-9]\d{3})(?![\w/-])"
CARD = r"(?<![\w-])(?:\d{13,19}|\d{4}([ -])\d{4}\g\d{4}\g\d{4})(?![\w-])"
SSN = r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"


def _pattern() -> str:
    cards = CARD.replace(r"([ -])", "[ -]").replace(r"\g", "[ -]")
    return "|".join(f"(?:{p})" for p in (EMAIL, DATE, IPV4, PHONE, SSN, cards))


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _noise(key: str, kind: Column, *values: Column) -> Column:
    """60 keyed pseudo-random bits."""
    text = F.concat_ws("|", F.lit(key), kind, *(v.cast("string") for v in values))
    return F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("long")


def _feistel(value: Column, a: Column, b: Column, key: str, kind: Column, sign: int) -> Column:
    """Permute 0 .. a*b-1: alternately add noise of one half to the other, each in its modulus."""
    rounds = F.sequence(F.lit(0), F.lit(ROUNDS - 1))
    if sign < 0:
        rounds = F.reverse(rounds)
    start = F.struct((value - value % b).alias("l"), (value % b).alias("r"))
    start = F.struct((start["l"] / b).cast("long").alias("l"), start["r"].alias("r"))

    def one(acc, i):
        left = F.pmod(acc["l"] + sign * (_noise(key, kind, i, acc["r"]) % a), a)
        right = F.pmod(acc["r"] + sign * (_noise(key, kind, i, acc["l"]) % b), b)
        even = i % 2 == 0
        return F.struct(
            F.when(even, left).otherwise(acc["l"]).alias("l"),
            F.when(even, acc["r"]).otherwise(right).alias("r"),
        )

    return F.aggregate(rounds, start, one, lambda acc: acc["l"] * b + acc["r"])


def permute(value: Column, a: Column, b: Column, key: str, kind: Column) -> Column:
    """Keyed permutation of 0 .. a*b-1 without fixed points (a*b below 2**62)."""
    a, b = a.cast("long"), b.cast("long")
    there = _feistel(value.cast("long"), a, b, key, kind, 1)
    return _let(there, lambda x: _feistel((x + 1) % (a * b), a, b, key, kind, -1))


def _shift(ch: Column, by: Column) -> Column:
    """Shift a letter or digit inside its class."""
    code = F.ascii(ch)
    shifted = ch
    for low, high in ((97, 122), (65, 90), (48, 57)):
        moved = F.char(F.lit(low) + F.pmod(code - low + by, F.lit(high - low + 1)))
        shifted = F.when(code.between(low, high), moved).otherwise(shifted)
    return shifted


def _letters(text: Column, key: str, sign: int) -> Column:
    """Feistel over the halves of a string; every character stays in its class."""
    half = F.ceil(F.length(text) / 2).cast("int")
    rounds = F.sequence(F.lit(0), F.lit(ROUNDS - 1))
    if sign < 0:
        rounds = F.reverse(rounds)

    def moved(part, other, i):
        at = F.sequence(F.lit(1), F.length(part))
        shifted = F.transform(
            at, lambda j: _shift(F.substr(part, j, F.lit(1)), sign * (_noise(key, F.lit("text"), i, j, other) % 26))
        )
        return F.when(F.length(part) > 0, F.array_join(shifted, "")).otherwise(part)

    start = F.struct(
        F.substr(text, F.lit(1), half).alias("l"), F.substr(text, half + 1, F.length(text)).alias("r")
    )

    def one(acc, i):
        even = i % 2 == 0
        return F.struct(
            F.when(even, moved(acc["l"], acc["r"], i)).otherwise(acc["l"]).alias("l"),
            F.when(even, acc["r"]).otherwise(moved(acc["r"], acc["l"], i)).alias("r"),
        )

    return F.aggregate(rounds, start, one, lambda acc: F.concat(acc["l"], acc["r"]))


def _next(text: Column) -> Column:
    """The first letter or digit moved on by one."""
    place = F.length(F.regexp_extract(text, r"^([^A-Za-z0-9]*)", 1)) + 1
    return F.concat(
        F.substr(text, F.lit(1), place - 1), _shift(F.substr(text, place, F.lit(1)), F.lit(1)),
        F.substr(text, place + 1, F.length(text)),
    )


def _email(m: Column, key: str) -> Column:
    """The part before the @ is permuted, the domain kept."""
    there = _let(F.regexp_extract(m, r"^([^@]*)@", 1), lambda x: _letters(x, key, 1))
    back = _let(_let(there, _next), lambda x: _letters(x, key, -1))
    return F.concat(back, F.regexp_extract(m, r"(@.*)$", 1))


def _refill(m: Column, digits: Column) -> Column:
    """The text of ``m`` with its digits replaced in order."""
    def one(acc, ch):
        digit = ch.rlike("^[0-9]$")
        return F.struct(
            F.concat(acc["s"], F.when(digit, F.substr(digits, acc["i"], F.lit(1))).otherwise(ch)).alias("s"),
            (acc["i"] + digit.cast("int")).alias("i"),
        )

    return F.aggregate(F.split(m, ""), F.struct(F.lit("").alias("s"), F.lit(1).alias("i")), one,
                       lambda acc: acc["s"])


def _padded(value: Column, width: Column) -> Column:
    return F.lpad(value.cast("string"), width.cast("int"), F.lit("0"))


def _luhn(payload: Column) -> Column:
    """Check digit of a string of digits."""
    numbers = F.transform(
        F.split(F.reverse(payload), ""),
        lambda d, i: F.when(i % 2 == 0, d.cast("int") * 2 - F.when(d > "4", 9).otherwise(0))
        .otherwise(d.cast("int")),
    )
    return F.pmod(-F.aggregate(numbers, F.lit(0), lambda a, d: a + d), F.lit(10)).cast("string")


#: Kinds in the order they are tried, and how a date of each kind is written.
KINDS = {
    "email": EMAIL, "ipv4": IPV4, "phone": PHONE, "ssn": SSN, "card": CARD,
    "yyyy-MM-dd": r"\d{4}-\d\d-\d\d", "dd/MM/yyyy": r"\d\d/\d\d/\d{4}", "dd.MM.yyyy": r"\d\d\.\d\d\.\d{4}",
}
#: A date that is none in the usual order may be one with the month first.
MONTH_FIRST = "MM/dd/yyyy"


def _kind(m: Column) -> Column:
    kind = F.lit(None).cast("string")
    for name, pattern in reversed(KINDS.items()):
        whole = "^(?:" + pattern.replace(r"([ -])", "[ -]").replace(r"\g", "[ -]") + ")$"
        kind = F.when(m.rlike(whole), name).otherwise(kind)
    return kind


def _read(p: Column) -> Column:
    """Digits of a number; for a date its form and the day."""
    m, kind = p["was"], p["kind"]
    dated = kind.rlike("yyyy")
    day = F.when(dated, F.try_to_timestamp(m, F.lit("yyyy-MM-dd")))
    for form in ("dd/MM/yyyy", "dd.MM.yyyy"):
        day = F.when(kind == form, F.try_to_timestamp(m, F.lit(form))).otherwise(day)
    turned = F.when(kind == "dd/MM/yyyy", F.try_to_timestamp(m, F.lit(MONTH_FIRST)))
    return F.struct(
        m.alias("was"),
        F.when(day.isNull() & turned.isNotNull(), MONTH_FIRST).otherwise(kind).alias("kind"),
        F.regexp_replace(m, "[^0-9]", "").alias("digits"),
        F.coalesce(day, turned).cast("date").alias("day"),
    )


def _number(p: Column) -> Column:
    """The value as a number below a * b; null if the check fails."""
    m, kind, digits, day = p["was"], p["kind"], p["digits"], p["day"]
    size = F.length(digits)

    def cut(start, length):
        return F.substr(digits, start if isinstance(start, Column) else F.lit(start),
                        length if isinstance(length, Column) else F.lit(length))

    octets = F.transform(F.split(m, r"\."), lambda o: o.cast("int"))
    canonical = m.rlike(r"^(?:(?:0|[1-9]\d{0,2})(?:\.|$)){4}$") & (F.array_max(octets) < 256)
    address = F.aggregate(octets, F.lit(0).cast("long"), lambda a, o: a * 256 + o)
    # The first digit of area and exchange is kept, so a dialling pattern stays valid.
    phone = F.concat(cut(size - 8, 2), cut(size - 5, 6)).cast("long")
    # Area kept; group and serial are never all zeros.
    named = ~cut(1, 3).isin("000", "666") & (cut(1, 1) < "9") & (cut(4, 2) != "00") & (cut(6, 4) != "0000")
    ssn = (cut(4, 2).cast("long") - 1) * 9999 + cut(6, 4).cast("long") - 1
    # First digit kept, the check digit computed again.
    low = F.floor((size - 2) / 2)
    checked = _luhn(cut(1, size - 1)) == cut(size, 1)
    first = F.make_date(F.year(day) - F.year(day) % 100, F.lit(1), F.lit(1))
    # 36525 = 75 * 487 days in a century that begins with a leap year, else 36524 = 92 * 397.
    leap = F.year(first) % 400 == 0

    def case(*branches):
        out = F.lit(None).cast("long")
        for test, value in reversed(branches):
            out = F.when(test, value.cast("long")).otherwise(out)
        return out

    def ten(n):
        return F.pow(F.lit(10.0), n)

    is_card = (kind == "card") & checked
    return F.struct(
        m.alias("was"), kind.alias("kind"), digits.alias("digits"), first.alias("first"),
        case((day.isNotNull(), F.datediff(day, first)), ((kind == "ipv4") & canonical, address),
             (kind == "phone", phone), ((kind == "ssn") & named, ssn),
             (is_card, cut(2, size - 2))).alias("value"),
        case((day.isNotNull(), F.when(leap, 75).otherwise(92)), (kind == "ipv4", F.lit(1 << 16)),
             (kind == "phone", F.lit(10**4)), (kind == "ssn", F.lit(99)),
             (is_card, ten(size - 2 - low))).alias("a"),
        case((day.isNotNull(), F.when(leap, 487).otherwise(397)), (kind == "ipv4", F.lit(1 << 16)),
             (kind == "phone", F.lit(10**4)), (kind == "ssn", F.lit(9999)),
             (is_card, ten(low))).alias("b"),
    )


def _written(p: Column, moved: Column, key: str) -> Column:
    """The pseudonym in the value's own format."""
    m, kind, digits = p["was"], p["kind"], p["digits"]
    size = F.length(digits)
    address = F.concat_ws(".", *((F.shiftright(moved, n) % 256).cast("string") for n in (24, 16, 8, 0)))
    eight = _padded(moved, F.lit(8))
    phone = F.concat(
        F.substr(digits, F.lit(1), size - 9), F.substr(eight, F.lit(1), F.lit(2)),
        F.substr(digits, size - 6, F.lit(1)), F.substr(eight, F.lit(3), F.lit(6)),
    )
    ssn = F.concat(
        F.substr(digits, F.lit(1), F.lit(3)), _padded((moved / 9999).cast("long") + 1, F.lit(2)),
        _padded(moved % 9999 + 1, F.lit(4)),
    )
    payload = F.concat(F.substr(digits, F.lit(1), F.lit(1)), _padded(moved, size - 2))
    card = F.concat(payload, _luhn(payload))
    day = F.date_add(p["first"], moved.cast("int"))
    text = _refill(m, F.when(kind == "phone", phone).when(kind == "ssn", ssn).otherwise(card))
    return (
        F.when(kind == "email", _email(m, key))
        .when(moved.isNull(), F.lit(None).cast("string"))
        .when(kind == "ipv4", address)
        .when(kind.rlike("yyyy"), F.call_function("date_format", day, kind))
        .otherwise(text)
    )


def _pseudonyms(found: Column, key: str) -> Column:
    """(was, kind, is) of the values found; ``is`` is null for a value that fails its check."""
    kinds = F.transform(found, lambda m: F.struct(m.alias("was"), _kind(m).alias("kind")))
    values = F.transform(F.transform(kinds, _read), _number)
    group = {"yyyy-MM-dd": "date", "dd/MM/yyyy": "date", "dd.MM.yyyy": "date", MONTH_FIRST: "date"}

    def kind_name(kind):
        return F.when(kind.isin(*group), "date").otherwise(kind)

    moved = F.transform(values, lambda p: F.struct(
        p.alias("p"),
        F.when(p["value"].isNotNull(), permute(p["value"], p["a"], p["b"], key, kind_name(p["kind"])))
        .alias("moved"),
    ))
    return F.transform(moved, lambda q: F.struct(
        q["p"]["was"].alias("was"), kind_name(q["p"]["kind"]).alias("kind"),
        _written(q["p"], q["moved"], key).alias("is"),
    ))


def pseudonymize(docs: DataFrame, key: str = KEY) -> DataFrame:
    """``docs`` with pseudonyms in ``text`` and n_values, the number of values replaced.

    All other columns and all other text stay as they are; a column named n_values is
    replaced. A null text stays null with n_values 0, an empty text stays empty, repeated
    rows get equal results. Nothing is shuffled: each text is read where it is.
    """
    text = F.col("text")
    some = F.coalesce(text.rlike("[0-9@]"), F.lit(False))
    pattern = F.lit(_pattern())
    found = F.when(some, F.regexp_extract_all(text, pattern, F.lit(0))).otherwise(
        F.array().cast("array<string>")
    )
    name = unused(docs, "_new")
    marked = docs.withColumn(name, _pseudonyms(found, key))
    gaps = F.split(text, _pattern(), -1)
    new = F.transform(name, lambda p: F.coalesce(p["is"], p["was"]))
    joined = F.array_join(
        F.zip_with(gaps, F.concat(new, F.array(F.lit(""))), lambda gap, p: F.concat(gap, p)), ""
    )
    changed = F.size(name) > 0
    return marked.withColumns({
        "text": F.when(changed, joined).otherwise(text),
        "n_values": F.size(F.filter(name, lambda p: p["is"].isNotNull())).cast("long"),
    }).drop(name)


def mentions(docs: DataFrame, key: str = KEY) -> DataFrame:
    """Rows (doc_id, kind, pseudonym): equal pseudonyms link documents that name the same value."""
    found = F.regexp_extract_all("text", F.lit(_pattern()), F.lit(0))
    rows = docs.where(F.col("text").rlike("[0-9@]")).select(
        "doc_id", F.explode(_pseudonyms(found, key)).alias("p")
    )
    return rows.where("p.is is not null").select(
        "doc_id", F.col("p.kind").alias("kind"), F.col("p.is").alias("pseudonym")
    )
