"""Format-preserving pseudonyms for personal data, by keyed Feistel permutations in SQL functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlane.llm.common import held

ROUNDS = 8

# The formats that are looked for, in order of precedence.
EMAIL = r"[A-Za-z0-9._%+\-]+@(?:[A-Za-z0-9\-]+\.)+[A-Za-z]{2,}"
ADDRESS = r"\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}"
DATE = r"\d{4}-\d{2}-\d{2}|\d{4}/\d{2}/\d{2}|\d{2}\.\d{2}\.\d{4}|\d{2}/\d{2}/\d{4}"
# Ten digits with an area code in brackets or with separators; 7 to 15 digits after a +; numbers that
# begin with a trunk 0, in two or three groups or in pairs.
PHONE = (
    r"(?:\+\d{1,3}[ .\-]?|1[ .\-]?)?\(\d{3}\)[ .\-]?\d{3}[ .\-]?\d{4}"
    r"|(?:\+\d{1,3}[ .\-]?|1[ .\-])?\d{3}[ .\-]\d{3}[ .\-]\d{4}"
    r"|\+\d(?:[ .\-/()]{0,2}\d){6,14}"
    r"|(?:\(0\d{1,4}\)|0\d{1,4})[ /\-]{1,2}\d{3,4}[ \-]?\d{3,5}|0\d(?:[ .\-]\d{2}){4}"
)
SOCIAL = r"\d{3}-\d{2}-\d{4}"
# The country code that stays; where nothing sets it apart, one digit.
COUNTRY = r"^(?:\+\d{1,3}(?=[ .\-/(])|\+\d)?"
CARD = r"\d{4}([ \-])\d{4}\1\d{4}\1\d{4}|\d{4}([ \-])\d{6}\2\d{4,5}|\d{13,19}"
SECRET = r"AKIA[0-9A-Z]{16}|(?:[0-9a-f]{64}|[0-9a-f]{40}|[0-9a-f]{32}|[0-9a-f]{18})"

# A format must not go on into a further letter, digit or number.
BEFORE, AFTER = r"(?<![A-Za-z0-9._%+\-])", r"(?![A-Za-z0-9]|[.\-/][0-9])"
# A secret may follow "password=", a telephone number has its own sign in front.
# A date may go on into a time of day.
ANY = (
    rf"{BEFORE}(?:{EMAIL}|(?:{DATE})(?=[Tt][0-9]{{2}})|(?:{ADDRESS}|{DATE}|{SOCIAL}|{CARD}|{SECRET}){AFTER})"
    rf"|(?<![A-Za-z0-9+])(?<![0-9][.\-/])(?:{PHONE}){AFTER}"
)

# The first format that a value fits is its own; of the last two, days over 12 tell the second.
DATE_FORMATS = (
    (r"^\d{4}-", "yyyy-MM-dd"), (r"^\d{4}/", "yyyy/MM/dd"), (r"^\d{2}\.", "dd.MM.yyyy"), (r"^\d{2}/", "MM/dd/yyyy"),
    (r"^\d{2}/", "dd/MM/yyyy"),
)
FIRST_YEAR, LAST_YEAR = 1900, 2100
# Days after the 28th that every year has.
LATE_DAYS = [(m, d) for m in range(1, 13) for d in (29, 30, 31) if m != 2 and (d < 31 or m in (1, 3, 5, 7, 8, 10, 12))]


def _bound(value: Column, use) -> Column:
    """use(value), with value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _whole(pattern: str, value: Column) -> Column:
    return value.rlike(f"^(?:{pattern})$")


def permuted(symbols: Column, radices: Column, tag: str, key: str) -> Column:
    """Keyed permutation of a list of symbols, each below its radix.

    An alternating Feistel network: in even rounds the symbols at even places are shifted by
    amounts that a keyed hash draws from those at odd places, in odd rounds the reverse. Each round
    can be undone, so values of one format map one to one.
    """

    def turn(state: Column, number: Column) -> Column:
        fixed = F.filter(state, lambda _, i: (i % 2) != (number % 2))
        seed = F.sha2(
            F.concat_ws("|", F.lit(key), F.lit(tag), number.cast("string"),
                        F.concat_ws(",", F.transform(fixed, lambda x: x.cast("string")))).cast("binary"), 256
        )
        return _bound(seed, lambda s: F.transform(
            F.arrays_zip(state.alias("v"), radices.alias("r")),
            lambda x, i: F.when(
                (i % 2) == (number % 2),
                F.pmod(x["v"] + F.pmod(F.xxhash64(s, i), x["r"]), x["r"]),
            ).otherwise(x["v"]),
        ))

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), symbols, turn)


def _characters(value: Column) -> Column:
    return F.filter(F.split(value, ""), lambda c: c != "")


def permuted_characters(value: Column, tag: str, key: str, hexadecimal: bool = False) -> Column:
    """Digits stay digits, small letters small, capitals capital; all else stays.

    With `hexadecimal`, digits and a-f are one alphabet of 16.
    """
    code = F.ascii
    digit = lambda c: c.between("0", "9")
    small = lambda c: c.between("a", "z")
    large = lambda c: c.between("A", "Z")

    def radix(c: Column) -> Column:
        letters = 16 if hexadecimal else 26
        return (F.when(digit(c), 16 if hexadecimal else 10).when(small(c), letters)
                .when(large(c), 26).otherwise(1)).cast("long")

    def symbol(c: Column) -> Column:
        return (F.when(digit(c), code(c) - 48).when(small(c), code(c) - (87 if hexadecimal else 97))
                .when(large(c), code(c) - 65).otherwise(0)).cast("long")

    def shown(c: Column, v: Column) -> Column:
        if hexadecimal:
            return F.when(digit(c) | small(c), F.lower(F.hex(v))).otherwise(c)
        return (F.when(digit(c), F.char(v + 48)).when(small(c), F.char(v + 97))
                .when(large(c), F.char(v + 65)).otherwise(c))

    def mapped(cs: Column) -> Column:
        new = permuted(F.transform(cs, symbol), F.transform(cs, radix), tag, key)
        return F.array_join(F.zip_with(cs, new, shown), "")

    return _bound(_characters(value), mapped)


def _check_digit(digits: Column) -> Column:
    """The digit that makes digits + it pass the Luhn test."""
    total = F.aggregate(
        F.transform(F.reverse(_characters(digits)), lambda c, i: _bound(
            c.cast("int") * F.when(i % 2 == 0, 2).otherwise(1), lambda d: F.when(d > 9, d - 9).otherwise(d))),
        F.lit(0), lambda a, d: a + d,
    )
    return F.pmod(-total, F.lit(10)).cast("string")


def card_pseudonym(value: Column, key: str) -> Column:
    """First digit kept, the others permuted, the check digit made anew; separators stay."""
    digits = F.regexp_replace(value, r"[^0-9]", "")
    n = F.length(digits)
    middle = permuted_characters(F.substring(digits, 2, n - 2), "card", key)

    whole = _bound(F.concat(F.substring(digits, 1, 1), middle), lambda d: F.concat(d, _check_digit(d)))
    def parted(*sizes: int) -> Column:
        parts = [F.substring(whole, 1 + sum(sizes[:i]), size) for i, size in enumerate(sizes)]
        return F.array_join(F.array(*parts), "-")

    spaced = F.when(value.rlike(r"^\d{4}[ \-]\d{6}"), parted(4, 6, 5)).when(value.rlike(r"[ \-]"), parted(4, 4, 4, 4))
    return F.coalesce(F.when(value.contains(" "), F.translate(spaced, "-", " ")).otherwise(spaced), whole)


def address_pseudonym(value: Column, key: str) -> Column:
    parts = F.transform(F.split(value, r"\."), lambda x: x.cast("long"))
    return F.array_join(
        F.transform(permuted(parts, F.array_repeat(F.lit(256).cast("long"), 4), "address", key),
                    lambda x: x.cast("string")), "."
    )


def _read(value: Column, shape: str, form: str) -> Column:
    return F.when(value.rlike(shape), F.try_to_timestamp(value, F.lit(form)).cast("date"))


def _day(value: Column) -> Column:
    """The date a value shows, null if there is none."""
    return F.coalesce(*[_read(value, *shown) for shown in DATE_FORMATS])


def _moved_day(day: Column, key: str) -> Column:
    """Another day of the years from FIRST_YEAR to LAST_YEAR, one to one.

    Days 1 to 12, 13 to 28, the later ones and 29 February are permuted each among themselves, so a
    day over 12, which alone tells dd/MM from MM/dd, stays one.
    """
    whole = lambda x: F.floor(x).cast("long")
    year, month, number = F.year(day).cast("long"), F.month(day).cast("long"), F.dayofmonth(day).cast("long")
    months, years = 12 * (LAST_YEAR - FIRST_YEAR + 1), LAST_YEAR - FIRST_YEAR + 1
    late = F.array(*[F.lit(100 * m + d).cast("long") for m, d in LATE_DAYS])
    kind = F.when(number <= 12, 0).when(number <= 28, 1).when(month != 2, 2).otherwise(3)

    def by_kind(*choices: Column) -> Column:
        return F.when(kind == 0, choices[0]).when(kind == 1, choices[1]).when(kind == 2, choices[2]).otherwise(choices[3])

    in_months = (year - FIRST_YEAR) * 12 + month - 1
    leap = whole((year - (FIRST_YEAR + 4)) / 4)  # 1904 to 2096 have 49 leap years: 7 x 7
    slot = F.array_position(late, month * 100 + number).cast("long") - 1
    symbols = F.array(by_kind(in_months, in_months, year - FIRST_YEAR, whole(leap / 7)),
                      by_kind(number - 1, number - 13, slot, leap % 7))
    sides = [(months, 12), (months, 16), (years, len(LATE_DAYS)), (7, 7)]
    radices = by_kind(*[F.array(F.lit(a).cast("long"), F.lit(b).cast("long")) for a, b in sides])

    def shown(pair: Column) -> Column:
        a, b = F.get(pair, F.lit(0)), F.get(pair, F.lit(1))
        other = F.get(late, b.cast("int"))
        in_year, rest = FIRST_YEAR + whole(a / 12), a % 12 + 1
        parts = (by_kind(in_year, in_year, a + FIRST_YEAR, (a * 7 + b) * 4 + FIRST_YEAR + 4),
                 by_kind(rest, rest, whole(other / 100), F.lit(2)), by_kind(b + 1, b + 13, other % 100, F.lit(29)))
        return F.make_date(*[x.cast("int") for x in parts])

    return _bound(permuted(symbols, radices, "date", key), shown)


def date_pseudonym(value: Column, key: str) -> Column:
    """A day becomes another day in the same notation; equal days stay equal across notations."""

    def mapped(day: Column) -> Column:
        return F.coalesce(*[
            F.when(_read(value, shape, form).isNotNull(), F.date_format(_moved_day(day, key), form))
            for shape, form in DATE_FORMATS
        ], value)

    return _bound(_day(value), mapped)


def pseudonym(value: Column, key: str) -> Column:
    """The pseudonym of a found value; a value that fails its format's test stays as it is."""
    octets = F.transform(F.split(value, r"\."), lambda x: x.cast("int"))
    in_range = F.coalesce(F.year(_day(value)).between(FIRST_YEAR, LAST_YEAR), F.lit(False))
    last = F.substring_index(value, ".", -1)
    return (
        F.when(_whole(EMAIL, value), F.concat(
            permuted_characters(F.substr(value, F.lit(1), F.length(value) - F.length(last)), "email", key), last))
        .when(_whole(ADDRESS, value), F.when(
            F.forall(octets, lambda x: x < 256), address_pseudonym(value, key)).otherwise(value))
        .when(_whole(DATE, value), F.when(in_range, date_pseudonym(value, key)).otherwise(value))
        .when(_whole(SOCIAL, value), permuted_characters(value, "social", key))
        .when(_whole(CARD, value), F.when(
            F.call_function("luhn_check", F.regexp_replace(value, r"[^0-9]", "")), card_pseudonym(value, key)).otherwise(value))
        .when(_whole(PHONE, value), F.concat(
            F.regexp_extract(value, COUNTRY, 0),
            permuted_characters(F.regexp_replace(value, COUNTRY, ""), "phone", key)))
        .when(value.startswith("AKIA"), F.concat(
            F.lit("AKIA"), permuted_characters(F.substring(value, 5, 99), "secret", key)))
        .otherwise(permuted_characters(value, "secret", key, hexadecimal=True))
    )


def pseudonymise(docs: DataFrame, key: str) -> DataFrame:
    """All columns of docs with `text` rewritten, and n_values: how many values were replaced.

    Found and permuted within their format: e-mail addresses (all but the last domain part),
    IPv4 addresses (octets to 255), dates (1900 to 2100, five notations, MM/dd before dd/MM), telephone numbers
    (ten digits with separators, international with a +, national with a trunk 0), social security numbers, payment card numbers (Luhn test, made valid again), access keys and
    hexadecimal secrets. A value of a format that fails its test is left alone, and so is all other text.
    One value has one pseudonym under one key wherever it stands, and two values never share one.
    A null text stays null with n_values 0. Rows are handled one by one; a column n_values
    of docs is replaced, any other column stays.
    """
    done = held(docs, done=rewritten(F.col("text"), key))
    others = [c for c in docs.columns if c not in ("text", "n_values")]
    return done.select(
        *[F.col("done.text") if c == "text" else F.col("row").getField(c).alias(c) for c in ("text", *others)],
        F.col("done.n_values"),
    ).select(*["`" + c.replace("`", "``") + "`" for c in docs.columns if c != "n_values"], "n_values")


def rewritten(text: Column, key: str) -> Column:
    """What `pseudonymise` makes of one text: a struct of text and n_values."""
    found = F.regexp_extract_all(text, F.lit(ANY), F.lit(0))
    # Most texts hold no digit, no @ and no key: these are not searched.
    some = F.coalesce(text.rlike("[0-9@]|AKIA"), F.lit(False))
    searched = F.when(some, found).otherwise(F.array().cast("array<string>"))
    pairs = F.transform(searched, lambda v: F.struct(v.alias("old"), pseudonym(v, key).alias("new")))

    def rebuilt(pairs: Column) -> Column:
        parts = F.zip_with(
            F.split(text, ANY, -1), pairs, lambda gap, pair: F.concat(gap, F.coalesce(pair["new"], F.lit("")))
        )
        changed = F.filter(pairs, lambda pair: pair["old"] != pair["new"])
        return F.struct(
            F.when(F.size(pairs) > 0, F.array_join(parts, "")).otherwise(text).alias("text"),
            F.size(changed).cast("long").alias("n_values"),
        )

    return _bound(pairs, rebuilt)
