"""PII pseudonyms that keep the format, by keyed Feistel permutations in column expressions.

Values are found by pattern and validated: card numbers and IBANs by their check digits, dates by the
calendar, phone numbers, social security numbers, e-mail and network addresses by their form. Cards in
their usual groupings and phone numbers go before digits in other groupings, so they are found beside
other numbers too. A stretch of digits in another grouping, or of capitals and digits like an IBAN, that
fails its check is searched again for the other forms. Where digits can be read as parts of two values,
as in ``567890 4111 1111 1111 1111``, the one that begins first is taken.

A value is turned into a number below the size of its format (an address into two halves of
characters), permuted by a Feistel network whose rounds are keyed hashes, and written back in the same
format, separators included. Equal values get equal pseudonyms in every document, different values
different ones, and the key's holder can invert them. Kept in clear are: the top-level domain and all
signs of an e-mail address, country and area of a phone number, country and bank of an IBAN, all but
the last three parts of an IPv6 address (which is written without ``::``).

Dates are one permutation of the days of 400 years in any form: ``1990-02-28`` with any of ``-/.``, before
a time too, ``28.02.1990``, ``02/28/1990`` and ``Feb 28, 1990`` or ``28 February 1990``. Numbers with ``/`` or ``-``
and the year last are read month first where that is a date. Otherwise they are read day first and
permuted among the days after the twelfth, so that the result reads day first again; those two orders
need not give the same day. Days below ten after or before a month's name are written with one digit.

The key is read by a subquery, so it does not stand in the text of plans. Everything is a built-in
expression: a text is split at its values and put together again.

Cases: null text stays null, empty text empty, very long texts are worked on whole; values that fail
validation are left alone and not counted; repeated rows get the same result; an empty table gives no
rows; columns of the table keep their names and places.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
# Days in 400 years of the calendar, as a product of two numbers of similar size, and
# the first of the 400 years that dates are permuted in.
DAYS = (189, 773)
FIRST_DAY = "1800-01-01"

DAY_COUNT = DAYS[0] * DAYS[1]
# Most steps until a date falls among the days after the twelfth; each does with a chance of 0.6.
WALK = 64

# Patterns, in the order in which they claim a place in the text. A name begins where a run of its
# characters does, or right behind the value before.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
HEX = "[0-9A-Fa-f]{1,4}"
ADDRESS_6 = rf"(?<![\w:])(?=[A-Fa-f:]*\d)(?:(?:{HEX}:){{7}}{HEX}|(?:{HEX}:){{1,6}}(?::{HEX}){{1,6}})(?![\w:])"
ADDRESS = r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?![\w]|\.\d)"
MONTH = (
    "(?:Jan(?:uary)?|Feb(?:ruary)?|Mar(?:ch)?|Apr(?:il)?|May|June?|July?"
    "|Aug(?:ust)?|Sep(?:tember)?|Oct(?:ober)?|Nov(?:ember)?|Dec(?:ember)?)"
)
YEAR_FIRST = r"(?<!\w)\d{4}(?:-\d{2}-|/\d{2}/|\.\d{2}\.)\d{2}(?:(?!\w)|(?=T\d{2}:))"
YEAR_LAST = r"(?<![\w/.-])\d{1,2}(?:/\d{1,2}/|-\d{1,2}-|\.\d{1,2}\.)\d{4}(?!\w)"
DAY_MONTH = rf"(?<!\w)\d{{1,2}} {MONTH} \d{{4}}(?!\w)"
MONTH_DAY = rf"(?<!\w){MONTH} \d{{1,2}},? \d{{4}}(?!\w)"
NUMBER_DATE = "|".join((YEAR_FIRST, YEAR_LAST, DAY_MONTH))
DATE = f"{NUMBER_DATE}|{MONTH_DAY}"
# Forms of a date, and how a day in this form is read and written.
DATE_FORMS = (
    *((rf"\d{{4}}{x}\d{{2}}{x}\d{{2}}", f"yyyy{x[-1]}MM{x[-1]}dd") for x in ("-", "/", r"\.")),
    (r"\d{2}\.\d{2}\.\d{4}", "dd.MM.yyyy"),
    (r"\d{1,2}\.\d{1,2}\.\d{4}", "d.M.yyyy"),
    *((rf"\d{{2}}{x}\d{{2}}{x}\d{{4}}", f"MM{x}dd{x}yyyy") for x in "/-"),
    *((rf"\d{{1,2}}{x}\d{{1,2}}{x}\d{{4}}", f"M{x}d{x}yyyy") for x in "/-"),
    *((rf"[A-Z][a-z]{{{n}}} \d+{x} \d{{4}}", f"{m} d{x} yyyy") for n, m in (("2", "MMM"), ("3,8", "MMMM")) for x in (",", "")),
    *((rf"\d+ [A-Z][a-z]{{{n}}} \d{{4}}", f"d {m} yyyy") for n, m in (("2", "MMM"), ("3,8", "MMMM"))),
)
DAY_FIRST_FORMS = (
    *((rf"\d{{2}}{x}\d{{2}}{x}\d{{4}}", f"dd{x}MM{x}yyyy") for x in "/-"),
    *((rf"\d{{1,2}}{x}\d{{1,2}}{x}\d{{4}}", f"d{x}M{x}yyyy") for x in "/-"),
)
SOCIAL = r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"
SOCIAL_BLANKS = r"(?<![\w-])\d{3} \d{2} \d{4}(?![\w-])"
IBAN = r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)"
PHONE = r"(?<!\w)(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)|\d{3})[ .-]?\d{3}[ .-]?\d{4}(?!\w)"
# With a country before it, of 8 to 15 digits; and with a leading zero.
ABROAD = (
    r"(?<![\w+])\+(?=(?:[ .()-]{0,2}\d){8})"
    r"(?:\d{1,3}(?:[ .-]?(?:\(\d{1,4}\)|\d{2,4})){2,3}|\d{1,3}[ .-]?\d(?:[ .-]?\d{2}){4})(?!\w)"
)
TRUNK = r"(?<![\w+-])0(?:\d{1,4}[ -]\d{3,4}[ -]?\d{3,4}|\d(?:[ .-]\d{2}){4})(?!\w)"
OTHER = "|".join((ADDRESS, NUMBER_DATE, SOCIAL, PHONE))
# Groupings of cards: fours in a row, of which any may begin a card, 4-6-5 and 4-6-4, and unbroken.
FOURS = rf"(?<![\w+])\d{{4}}(?:[ -](?!{OTHER})\d{{4}}(?!\w)){{3,}}+(?:[ -](?!{OTHER})\d{{1,3}}(?!\w))?+"
GROUPED = rf"(?<![\w+])\d{{4}}[ -]\d{{6}}[ -](?!{FOURS}|{OTHER})\d{{4,5}}(?!\w)|(?<![\w+])\d{{13,19}}(?!\w)"
# Any other grouping, as far as no value of another form begins in it.
LOOSE = rf"(?<![\w+])\d(?:[ -]?(?!{FOURS}|{GROUPED}|{OTHER})\d){{12,18}}(?!\w)"
CARD = r"\d(?:[ -]?\d){12,18}"
PHONES = "|".join((PHONE, ABROAD, TRUNK))
NUMBERS = (ADDRESS, ADDRESS_6, NUMBER_DATE, SOCIAL, FOURS, GROUPED, PHONES)
WORDS = rf"(?=[JFMASOND]){MONTH_DAY}|(?=[A-Fa-f]){ADDRESS_6}"


def searched(numbers: tuple[str, ...], words: str) -> str:
    """One pattern for all; most places in a text are told by what stands before or first."""
    return rf"{EMAIL}|(?<!\w)(?:(?=[\d+(])(?:{'|'.join(numbers)})|{words})"


VALUES = searched((*NUMBERS, LOOSE, SOCIAL_BLANKS), f"{WORDS}|{IBAN}")
# What is searched for inside a loose stretch that is no card, or one like an IBAN that is none.
INSIDE = searched((*NUMBERS, SOCIAL_BLANKS), WORDS) + "|(?s:.)"


def keyed(key: Column, label: str, value: Column, size: Column) -> Column:
    """A number below ``size`` from a keyed hash."""
    digest = F.sha2(F.concat_ws("|", key, F.lit(label), size.cast("string"), value.cast("string")), 256)
    return F.pmod(F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"), size)


def permuted(key: Column, label: str, value: Column, left_size: Column, right_size: Column) -> Column:
    """Keyed permutation of the numbers below ``left_size * right_size``.

    Each round adds a keyed hash of one half to the other, modulo the other's size.
    """
    start = F.struct(F.floor(value / right_size).cast("long").alias("l"), F.pmod(value, right_size).alias("r"))

    def one_round(halves: Column, number: Column) -> Column:
        tag = F.concat_ws("|", number.cast("string"), F.lit("l"))
        left = F.pmod(halves["l"] + keyed(key, label, F.concat_ws("|", tag, halves["r"].cast("string")), left_size), left_size)
        right_tag = F.concat_ws("|", number.cast("string"), F.lit("r"))
        right = F.pmod(
            halves["r"] + keyed(key, label, F.concat_ws("|", right_tag, left.cast("string")), right_size), right_size
        )
        return F.struct(left.alias("l"), right.alias("r"))

    done = F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS // 2)), start, one_round)
    return F.transform(F.array(done), lambda x: x["l"] * right_size + x["r"])[0]


def permuted_digits(key: Column, label: str, digits: Column) -> Column:
    """Keyed permutation of the digit strings of one length, up to 18 digits."""
    count = F.length(digits)
    right = F.floor(count / 2)
    left_size = F.pow(F.lit(10), count - right).cast("long")
    right_size = F.pow(F.lit(10), right).cast("long")
    # A single digit has no second half; its right side is the one number below 1.
    return F.lpad(permuted(key, label, digits.cast("long"), left_size, right_size).cast("string"), count, "0")


def permuted_name(key: Column, name: Column) -> Column:
    """Keyed permutation of the texts with letters, digits and signs in the same places.

    The halves shift each other's letters and digits in turn. Capitals stay capitals and make no
    difference, and characters other than letters and digits stay.
    """

    def shifted(half: Column, by: Column, tag: str) -> Column:
        digest = F.sha2(F.concat_ws("|", key, F.lit("name"), F.lit(tag), F.length(half).cast("string"), F.lower(by)), 256)

        def one(char: Column, place: Column, amounts: Column) -> Column:
            amount = F.conv(F.substring(amounts, F.pmod(place, F.lit(32)) * 2 + 1, F.lit(2)), 16, 10).cast("int")
            code = F.ascii(char)

            def turned(first: int, size: int) -> Column:
                return F.char(F.pmod(code - first + amount, F.lit(size)) + first)

            return (
                F.when((code > 96) & (code < 123), turned(97, 26))
                .when((code > 64) & (code < 91), turned(65, 26))
                .when((code > 47) & (code < 58), turned(48, 10))
                .otherwise(char)
            )

        chars = F.transform(F.array(digest), lambda d: F.transform(F.split(half, ""), lambda c, i: one(c, i, d)))[0]
        return F.array_join(chars, "")

    def step(number: int) -> Callable[[Column], Column]:
        if number % 2:
            return lambda h: F.struct(h["l"], shifted(h["r"], h["l"], str(number)).alias("r"))
        return lambda h: F.struct(shifted(h["l"], h["r"], str(number)).alias("l"), h["r"])

    middle = F.floor(F.length(name) / 2).cast("int")
    halves = F.array(
        F.struct(F.substring(name, F.lit(1), middle).alias("l"), F.substring(name, middle + 1, F.length(name)).alias("r"))
    )
    for number in range(ROUNDS):
        halves = F.transform(halves, step(number))
    return F.transform(halves, lambda h: F.concat(h["l"], h["r"]))[0]


def permuted_day(key: Column, since: Column) -> Column:
    """Keyed permutation of days, given as numbers from the first, inside their 400 years."""
    moved = permuted(key, "date", F.pmod(since, F.lit(DAY_COUNT)), F.lit(DAYS[0]).cast("long"), F.lit(DAYS[1]).cast("long"))
    return F.floor(since / F.lit(DAY_COUNT)).cast("long") * DAY_COUNT + moved


def day_of(since: Column) -> Column:
    return F.date_add(F.to_date(F.lit(FIRST_DAY)), since.cast("int"))


def permuted_date(key: Column, value: Column) -> Column:
    """The date's pseudonym in its form; null if it is no day of the years 1400 to 2599."""

    def read(forms: tuple) -> Column:
        days = [F.when(value.rlike(f"^{form}$"), F.try_to_date(value, layout)) for form, layout in forms]
        since = F.datediff(F.coalesce(*days), F.to_date(F.lit(FIRST_DAY))).cast("long")
        return F.when((since >= -DAY_COUNT) & (since < 2 * DAY_COUNT), since)

    def write(forms: tuple, since: Column) -> Column:
        texts = [F.when(value.rlike(f"^{form}$"), F.date_format(day_of(since), layout)) for form, layout in forms]
        return F.coalesce(*texts)

    def walked(since: Column) -> Column:
        # The same permutation over and over, until it comes back to a day after the twelfth.
        return F.aggregate(
            F.sequence(F.lit(1), F.lit(WALK)),
            permuted_day(key, since),
            lambda at, n: F.when(F.dayofmonth(day_of(at)) > 12, at).otherwise(permuted_day(key, at)),
        )

    def once(number: Column, work) -> Column:
        return F.transform(F.array(number), work)[0]

    usual, other = read(DATE_FORMS), read(DAY_FIRST_FORMS)
    day_first = F.when(other.isNotNull(), once(once(other, walked), lambda n: write(DAY_FIRST_FORMS, n)))
    return F.when(
        usual.isNotNull(), once(once(usual, lambda n: permuted_day(key, n)), lambda n: write(DATE_FORMS, n))
    ).otherwise(day_first)


def rest_97(text: Column) -> Column:
    """The remainder by 97 of the number that an IBAN stands for, letters as 10 to 35."""

    def step(rest: Column, char: Column) -> Column:
        code = F.ascii(char)
        return F.when(code > 64, F.pmod(rest * 100 + code - 55, F.lit(97))).otherwise(F.pmod(rest * 10 + code - 48, F.lit(97)))

    return F.aggregate(F.split(text, ""), F.lit(0), step)


def is_iban(value: Column) -> Column:
    plain = F.replace(value, F.lit(" "))
    return rest_97(F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, 1, 4))) == 1


def permuted_iban(key: Column, value: Column) -> Column:
    """The last ten digits permuted, and the check digits that fit."""
    country, rest = F.substring(value, 1, 2), F.substring(value, F.lit(5), F.length(value))
    digits = F.regexp_replace(rest, r"\D", "")
    bank = F.substring(digits, F.lit(1), F.length(digits) - 10)
    moved = poured(rest, F.concat(bank, permuted_digits(key, "iban", F.substring(digits, -10, 10))))
    check = F.transform(
        F.array(moved),
        lambda new: F.concat(
            country,
            F.lpad((98 - rest_97(F.concat(F.replace(new, F.lit(" ")), country, F.lit("00")))).cast("string"), 2, "0"),
            new,
        ),
    )[0]
    return F.when(F.length(digits) > 9, check)


def permuted_address_6(key: Column, value: Column) -> Column:
    """The last three parts permuted; zeros left out by ``::`` are written."""
    ends = F.split(value, "::")
    head, tail = F.split(ends[0], ":"), F.when(F.size(ends) > 1, F.split(F.get(ends, F.lit(1)), ":")).otherwise(F.array())
    zeros = F.array_repeat(F.lit("0"), 8 - F.size(head) - F.size(tail))
    parts = F.concat(head, zeros, tail)
    last = F.conv(F.array_join(F.transform(F.slice(parts, 6, 3), lambda p: F.lpad(p, 4, "0")), ""), 16, 10).cast("long")
    half = F.lit(1 << 24).cast("long")
    moved = F.lpad(F.lower(F.hex(permuted(key, "address6", last, half, half))), 12, "0")
    new = F.transform(F.array(moved), lambda m: F.array(*[F.substring(m, i, 4) for i in (1, 5, 9)]))[0]
    short = F.transform(new, lambda p: F.regexp_replace(p, "^0{1,3}", ""))
    return F.when(F.size(head) + F.size(tail) <= 8, F.array_join(F.concat(F.slice(parts, 1, 5), short), ":"))


def check_digit(body: Column) -> Column:
    """The digit that makes a card number valid when it follows ``body``."""
    digits = F.split(F.reverse(body), "")
    doubled = F.transform(
        digits, lambda d, i: F.when(i % 2 == 0, F.floor(d.cast("int") * 2 / 10) + d.cast("int") * 2 % 10).otherwise(d.cast("int"))
    )
    return F.pmod(-F.aggregate(doubled, F.lit(0).cast("long"), lambda a, d: a + d.cast("long")), F.lit(10)).cast("string")


def poured(form: Column, digits: Column) -> Column:
    """The text ``form`` with its digits replaced in order by ``digits``."""
    pieces = F.split(form, r"\d", -1)
    new = F.split(digits, "")
    both = F.zip_with(pieces, new, lambda p, d: F.concat(F.coalesce(p, F.lit("")), F.coalesce(d, F.lit(""))))
    return F.array_join(both, "")


def is_card(value: Column) -> Column:
    digits = F.regexp_replace(value, r"\D", "")
    body = F.substring(digits, F.lit(1), F.length(digits) - 1)
    return (F.length(digits) > 12) & (check_digit(body) == F.substring(digits, -1, 1))


def values_in(value: Column) -> Column:
    """The cards in a row of groups of four, and what is between them; any other value is whole."""
    # What begins at each group; letters can mark the groups, as there are none in such a row.
    ahead = F.regexp_extract_all(value, F.lit(r"(?<!\d)(?=(\d+(?:[ -]\d+){0,4}))"), F.lit(1))
    groups = F.regexp_extract_all(value, F.lit(r"[ -]?\d+"), F.lit(0))

    def marked(group: Column, rest: Column) -> Column:
        four = F.regexp_extract(rest, r"^\d{4}(?:[ -]\d{4}){3}(?!\d)", 0)
        longer = F.regexp_extract(rest, r"^\d{4}(?:[ -]\d{4}){3}[ -]\d{1,3}(?!\d)", 0)
        mark = F.when(is_card(four), "C").when(is_card(longer), "D").otherwise("A")
        return F.regexp_replace(group, r"(?=\d+$)(?<!\d)", mark)

    row = F.array_join(F.zip_with(groups, ahead, marked), "")
    token = r"D\d+(?:[ -]\w\d+){4}|C\d+(?:[ -]\w\d+){3}|A\d+|[ -]"
    tokens = F.regexp_extract_all(row, F.lit(token), F.lit(0))
    parts = F.transform(tokens, lambda t: F.regexp_replace(t, "[ACD]", ""))
    loose = value.rlike(f"^{CARD}$") & ~is_card(value) | value.rlike(f"^(?:{IBAN})$") & ~is_iban(value)
    return (
        F.when(value.rlike(f"^(?:{FOURS})$"), parts)
        .when(loose, F.regexp_extract_all(value, F.lit(INSIDE), F.lit(0)))
        .otherwise(F.array(value))
    )


def pseudonym(key: Column, value: Column) -> Column:
    """A value's pseudonym in its format; null if it is no valid value of any format."""
    digits = F.regexp_replace(value, r"\D", "")
    # All but the top-level domain.
    top = F.substring_index(value, ".", -1)
    mail = F.concat(permuted_name(key, F.substring(value, F.lit(1), F.length(value) - F.length(top))), top)
    parts = F.split(value, r"\.")
    number = F.aggregate(parts, F.lit(0).cast("long"), lambda a, p: a * 256 + p.cast("long"))
    moved = permuted(key, "address", number, F.lit(65536).cast("long"), F.lit(65536).cast("long"))
    address = F.transform(
        F.array(moved),
        lambda n: F.concat_ws(
            ".", *[F.pmod(F.floor(n / F.lit(256**i)).cast("long"), F.lit(256)).cast("string") for i in (3, 2, 1, 0)]
        ),
    )[0]
    body = F.substring(digits, F.lit(1), F.length(digits) - 1)
    new_body = permuted_digits(key, "card", body)
    card = F.transform(F.array(new_body), lambda b: poured(value, F.concat(b, check_digit(b))))[0]
    # Country and area stay; the subscriber's seven digits are permuted under them.
    area = F.substring(digits, F.lit(1), F.length(digits) - 7)
    subscriber = permuted_digits(key, "phone", F.substring(digits, -7, 7))
    phone = poured(value, F.concat(area, subscriber))
    social = poured(value, permuted_digits(key, "social", digits))

    def whole(pattern: str) -> Column:
        return value.rlike("^(?:" + pattern + ")$")

    return (
        F.when(value.contains("@"), mail)
        .when(value.contains(":"), permuted_address_6(key, value))
        .when(whole(ADDRESS), F.when(F.forall(parts, lambda p: p.cast("int") < 256), address))
        .when(whole(DATE), permuted_date(key, value))
        .when(whole(SOCIAL) | whole(SOCIAL_BLANKS), social)
        .when(whole(IBAN), F.when(is_iban(value), permuted_iban(key, value)))
        .when(whole(CARD) & is_card(value), card)
        .when(whole(PHONES), phone)
    )


def pseudonymize(docs: DataFrame, key: str) -> DataFrame:
    """All columns of the documents, with pseudonyms in ``text``, and the number of them.

    The count is in ``n_pseudonyms``; a column of that name in the table is replaced.
    """
    found = F.regexp_extract_all(F.col("text"), F.lit(VALUES), F.lit(0))
    between = F.split(F.col("text"), VALUES, -1)
    parts = F.transform(F.col("_found"), values_in)
    # Bound as a column first: subqueries may not stand inside of lambda functions.
    secret = docs.sparkSession.sql("select key from values (:key) as given(key)", {"key": key}).scalar()
    swapped = F.transform("_parts", lambda p: F.transform(p, lambda v: F.coalesce(pseudonym(F.col("_secret"), v), v)))
    whole = F.transform("_swapped", lambda p: F.array_join(p, ""))
    joined = F.array_join(
        F.zip_with("_between", whole, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), ""
    )
    hit = F.size(F.filter(F.zip_with(F.flatten("_parts"), F.flatten("_swapped"), lambda a, b: a != b), lambda x: x))
    some = F.size("_found") > 0
    kept = [x for x in docs.columns if x.lower() not in ("n_pseudonyms", "_found", "_between", "_parts", "_swapped", "_secret")]
    return (
        docs.select(*kept, found.alias("_found"), secret.alias("_secret"))
        .withColumn("_between", F.when(some, between))
        .withColumn("_parts", F.when(some, parts))
        .withColumn("_swapped", F.when(some, swapped))
        .withColumn("text", F.when(some, joined).otherwise(F.col("text")))
        .withColumn("n_pseudonyms", F.when(some, hit).otherwise(F.lit(0)))
        .select(*kept, "n_pseudonyms")
    )
