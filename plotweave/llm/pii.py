"""Format-preserving pseudonyms for personal data by keyed Feistel permutations.

Numbers and dates that pass their validity test, e-mail names and secrets are replaced by others
of the same format and validity; one key gives one permutation per format, so equal values stay
equal across documents and different ones stay different. Built-in functions only: a text is
split at the matches, the matches are mapped, and both are put together again, all within the
row. Repeated groups of a pattern are possessive or bounded, so a long text takes no stack.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from plotweave.llm.common import documents

KEY = "plotweave"
ROUNDS = 10
# Dates of these years are permuted among themselves.
FIRST_DAY, LAST_DAY = "1900-01-01", "2099-12-31"
DAYS = 73049
DAY_SIDE = 271  # DAY_SIDE² is the least square not below DAYS
WALKS = 12

_DIGIT_EDGE, _END = r"(?<![0-9A-Za-z.])", r"(?![0-9A-Za-z])"
# Country calling codes; none is the beginning of another.
_COUNTRY = r"(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[2-9][0-9]{2})"
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
# The formats, in the order in which they are tried at a place.
FORMATS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": rf"{_DIGIT_EDGE}{_OCTET}(?:\.{_OCTET}){{3}}(?![0-9A-Za-z]|\.[0-9])",
    "date": rf"{_DIGIT_EDGE}(?:[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}|[0-9]{{2}}[./][0-9]{{2}}[./][0-9]{{4}}){_END}",
    "social": rf"{_DIGIT_EDGE}(?!000|666|9)[0-9]{{3}}-(?!00)[0-9]{{2}}-(?!0000)[0-9]{{4}}{_END}",
    "phone": "(?:" + "|".join(
        [
            rf"(?<![0-9A-Za-z+])\+{_COUNTRY}[ .-]?\(?[0-9]{{1,4}}\)?(?:[ .-]?[0-9]{{2,4}}){{1,3}}",
            rf"{_DIGIT_EDGE}\([0-9]{{3}}\) ?[0-9]{{3}}-[0-9]{{4}}",
            rf"{_DIGIT_EDGE}[0-9]{{3}}-[0-9]{{3}}-[0-9]{{4}}",
            *[rf"{_DIGIT_EDGE}[2-9][0-9]{{2}}{mark}[2-9][0-9]{{2}}{mark}[0-9]{{4}}" for mark in (" ", r"\.")],
        ]
    ) + f"){_END}",
    "iban": rf"{_DIGIT_EDGE}[A-Z]{{2}}[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{2,7}}(?: ?[A-Z0-9]{{1,3}})?{_END}",
    "card": rf"{_DIGIT_EDGE}(?:[0-9]{{4}}(?:[ -]?[0-9]{{4}}){{2}}[ -]?[0-9]{{1,7}}|3[47][0-9]{{2}}[ -][0-9]{{6}}[ -][0-9]{{5}}){_END}",
    "secret": rf"{_DIGIT_EDGE}(?:" + "|".join(
        rf"(?=[0-9]*+[{x}])(?=[{x}]*+[0-9])[0-9{x}]{{32,64}}" for x in ("a-f", "A-F")
    ) + f"){_END}",
}
ANY = "|".join(f"(?:{p})" for p in FORMATS.values())
# What every match has: texts without it are passed over.
_HINT = r"[0-9]{2}|@|[0-9]\.[0-9]|[0-9a-f]{32}|[0-9A-F]{32}"
_LOWER, _UPPER, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` mentions it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _round(key: str, what: str, i: Column, value: Column) -> Column:
    """A keyed 60-bit number."""
    text = F.concat_ws("|", F.lit(key), F.lit(what), i.cast("string"), value.cast("string"))
    return F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("long")


def _feistel(key: str, what: str, left: Column, right: Column, left_size: Column, right_size: Column) -> Column:
    """A permutation of the pairs below (left_size, right_size), as struct a, b."""

    def step(s: Column, i: Column) -> Column:
        size = F.when(i % 2 == 0, left_size).otherwise(right_size)
        return F.struct(s["b"].alias("a"), F.pmod(s["a"] + F.pmod(_round(key, what, i, s["b"]), size), size).alias("b"))

    start = F.struct(left.cast("long").alias("a"), right.cast("long").alias("b"))
    return F.aggregate(F.lit(list(range(ROUNDS))), start, step)


def permuted_digits(key: str, what: str, digits: Column) -> Column:
    """A string of digits as another of the same length (up to 19 digits)."""
    return _let(digits, lambda d: _permuted(key, what, d))


def _permuted(key: str, what: str, digits: Column) -> Column:
    n = F.length(digits)
    left = (n / 2).cast("int")
    right = n - left
    powers = F.lit([10**k for k in range(11)])
    number = lambda s: F.when(F.length(s) == 0, 0).otherwise(s.cast("long"))
    moved = _feistel(
        key, what, number(F.substr(digits, F.lit(1), left)), number(F.substr(digits, left + 1, right)),
        F.get(powers, left), F.get(powers, right),
    )
    pad = lambda x, width: F.when(width == 0, "").otherwise(F.lpad(x.cast("string"), width, "0"))
    return _let(moved, lambda m: F.concat(pad(m["a"], left), pad(m["b"], right)))


def permuted_text(key: str, what: str, text: Column, alphabets: list[str], linked: Callable = lambda c: c) -> Column:
    """A permutation of strings in which every character stays within its alphabet.

    One half's characters are shifted by numbers that depend on the other half, in turn. Texts
    that ``linked`` makes equal are shifted by the same numbers. Other characters stay.
    """

    def shifted(half: Column, other: Column, i: Column) -> Column:
        stream = F.sha2(F.concat_ws("|", F.lit(key), F.lit(what), i.cast("string"), F.length(half).cast("string"), linked(other)), 512)

        def by(mask: Column) -> Column:
            def moved(c: Column, at: Column) -> Column:
                step = F.conv(F.substr(mask, F.pmod(at, F.lit(64)) * 2 + 1, F.lit(2)), 16, 10).cast("int")
                out = None
                for letters in alphabets:
                    place = F.instr(F.lit(letters), c)
                    other = F.substr(F.lit(letters), F.pmod(place - 1 + step, F.lit(len(letters))) + 1, F.lit(1))
                    inside = (place > 0) & (c != "")
                    out = F.when(inside, other) if out is None else out.when(inside, other)
                return out.otherwise(c)

            return F.array_join(F.transform(F.split(half, ""), moved), "")

        return _let(stream, by)

    def step(s: Column, i: Column) -> Column:
        return F.struct(s["b"].alias("a"), shifted(s["a"], s["b"], i).alias("b"))

    half = (F.length(text) / 2).cast("int")
    start = F.struct(F.substr(text, F.lit(1), half).alias("a"), F.substr(text, half + 1, F.length(text)).alias("b"))
    # After an even number of rounds the halves stand where they were.
    return F.aggregate(F.lit(list(range(ROUNDS))), start, step, lambda s: F.concat(s["a"], s["b"]))


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _check_sum(digits: Column, double_last: bool) -> Column:
    """The Luhn sum; ``double_last`` when the check digit is still missing."""
    n = F.length(digits)
    values = F.transform(
        F.sequence(F.lit(1), n),
        lambda i: F.when(
            (n - i) % 2 == (0 if double_last else 1),
            F.get(F.lit([0, 2, 4, 6, 8, 1, 3, 5, 7, 9]), F.substr(digits, i, F.lit(1)).cast("int")),
        ).otherwise(F.substr(digits, i, F.lit(1)).cast("int")),
    )
    return F.aggregate(values, F.lit(0), lambda a, x: a + x)


def _laid_out(like: Column, digits: Column, kept: str = "^[0-9]$") -> Column:
    """``digits`` with the separators of ``like``; ``kept`` tells which characters are none."""

    def laid(digits: Column) -> Column:
        def step(s: Column, c: Column) -> Column:
            digit = c.rlike(kept)
            return F.struct(
                F.concat(s["out"], F.when(digit, F.substr(digits, s["at"], F.lit(1))).otherwise(c)).alias("out"),
                (s["at"] + digit.cast("int")).alias("at"),
            )

        return F.aggregate(F.split(like, ""), F.struct(F.lit("").alias("out"), F.lit(1).alias("at")), step)["out"]

    return _let(digits, laid)


def card(key: str, hit: Column) -> Column:
    """All digits but the check digit are permuted; the check digit is made to fit."""
    check = lambda body: F.pmod(F.lit(10) - _check_sum(body, True) % 10, F.lit(10)).cast("string")
    other = lambda body: _laid_out(hit, F.concat(body, check(body)))
    moved = lambda digits: _let(permuted_digits(key, "card", F.substr(digits, F.lit(1), F.length(digits) - 1)), other)
    return _let(_digits(hit), lambda digits: F.when(_check_sum(digits, False) % 10 == 0, moved(digits)))


def phone(key: str, hit: Column) -> Column:
    """The digits after the country code are permuted."""
    code = F.regexp_extract(hit, rf"^\+{_COUNTRY}", 0)
    rest = F.substr(hit, F.length(code) + 1, F.length(hit))
    digits = _digits(rest)
    return F.when(F.length(digits) >= 4, F.concat(code, _laid_out(rest, permuted_digits(key, "phone", digits))))


def social(key: str, hit: Column) -> Column:
    """The nine digits are permuted again and again until they are valid once more."""
    valid = lambda d: d.rlike("^(?!000|666|9)[0-9]{3}(?!00)[0-9]{2}(?!0000)[0-9]{4}$")
    walk = lambda d, i: F.when((i > 0) & valid(d), d).otherwise(permuted_digits(key, "social", d))
    return _let(F.aggregate(F.lit(list(range(WALKS))), _digits(hit), walk), lambda d: F.when(valid(d), _laid_out(hit, d)))


def _remainder(text: Column) -> Column:
    """``text`` modulo 97, with letters as the numbers from 10 on."""
    value = lambda c: F.when(c.rlike("^[0-9]$"), c.cast("int")).otherwise(F.ascii(c) - 55)
    step = lambda a, c: F.when(c == "", a).otherwise((a * F.when(c.rlike("^[0-9]$"), 10).otherwise(100) + value(c)) % 97)
    return F.aggregate(F.split(text, ""), F.lit(0), step)


def iban(key: str, hit: Column) -> Column:
    """What follows the check digits is permuted within the country; the check digits are made to fit."""

    def moved(plain: Column) -> Column:
        country, account = F.substr(plain, F.lit(1), F.lit(2)), F.substr(plain, F.lit(5), F.length(plain))
        valid = _remainder(F.concat(account, F.substr(plain, F.lit(1), F.lit(4)))) == 1
        new = F.concat(country, F.lit("|"), permuted_text(key, "iban", account, [_DIGITS, _UPPER]))

        def checked(new: Column) -> Column:
            body = F.substr(new, F.lit(4), F.length(new))
            check = F.lpad((F.lit(98) - _remainder(F.concat(body, country, F.lit("00")))).cast("string"), 2, "0")
            return _laid_out(hit, F.concat(country, check, body), "^[0-9A-Z]$")

        return F.when(valid, _let(new, checked))

    return _let(F.replace(hit, F.lit(" "), F.lit("")), moved)


def ip(key: str, hit: Column) -> Column:
    """The 32 bits are permuted."""
    octets = F.transform(F.split(hit, r"\."), lambda x: x.cast("long"))
    side = F.lit(1 << 16)
    moved = lambda o: _feistel(key, "ip", o[0] * 256 + o[1], o[2] * 256 + o[3], side, side)
    shown = lambda m: F.concat_ws(
        ".", *[x.cast("string") for part in ("a", "b") for x in (F.shiftright(m[part], 8), m[part] % 256)]
    )
    return _let(_let(octets, moved), shown)


def date(key: str, hit: Column) -> Column:
    """Calendar days from 1900 to 2099 are permuted among themselves; others stay.

    The permutation is one of a square that is a little larger than the number of days, and is
    applied again until it leads to a day.
    """
    return _let(_day(hit), lambda day: F.when((day >= 0) & (day < DAYS), _moved_date(key, hit, day)))


def _day(hit: Column) -> Column:
    """Days since the first one; null where there is no such date."""
    iso = hit.rlike("^[0-9]{4}-")
    ordered = F.when(iso, hit).otherwise(
        F.concat_ws("-", F.substr(hit, F.lit(7), F.lit(4)), F.substr(hit, F.lit(4), F.lit(2)), F.substr(hit, F.lit(1), F.lit(2)))
    )
    return F.date_diff(ordered.try_cast("date"), F.lit(FIRST_DAY).cast("date")).cast("long")


def _moved_date(key: str, hit: Column, day: Column) -> Column:
    side = F.lit(DAY_SIDE)

    def walk(x: Column, i: Column) -> Column:
        moved = _feistel(key, "date", F.floor(x / DAY_SIDE), x % DAY_SIDE, side, side)
        arrived = (i > 0) & (x < DAYS)
        return F.when(arrived, x).otherwise(_let(moved, lambda m: m["a"] * DAY_SIDE + m["b"]))

    def shown(out: Column) -> Column:
        new = F.date_add(F.lit(FIRST_DAY).cast("date"), out.cast("int"))
        separator = F.substr(hit, F.lit(3), F.lit(1))
        text = F.when(hit.rlike("^[0-9]{4}-"), F.date_format(new, "yyyy-MM-dd")).otherwise(
            F.concat(F.date_format(new, "dd"), separator, F.date_format(new, "MM"), separator, F.date_format(new, "yyyy"))
        )
        return F.when(out < DAYS, text)

    return _let(F.aggregate(F.lit(list(range(WALKS))), day, walk), shown)


def secret(key: str, hit: Column) -> Column:
    """Another string of hexadecimal digits in the same case."""
    lower = permuted_text(key, "secret", F.lower(hit), [_DIGITS + "abcdef"])
    return _let(lower, lambda x: F.when(hit.rlike("[A-F]"), F.upper(x)).otherwise(x))


def email(key: str, hit: Column) -> Column:
    """The local part becomes other letters and digits of the same kinds; the domain stays.

    Names that differ in case only stay so.
    """
    local = F.substring_index(hit, "@", 1)
    new = permuted_text(key, "email", local, [_DIGITS, _LOWER, _UPPER], F.lower)
    return F.concat(new, F.substr(hit, F.length(local) + 1, F.length(hit)))


_PSEUDONYMS = {
    "email": email, "ip": ip, "date": date, "social": social, "phone": phone, "iban": iban, "card": card, "secret": secret,
}


def _mapped(key: str, hit: Column) -> Column:
    """The match and what replaces it: struct kind, text. Kind is null where nothing is replaced."""
    out = None
    for kind, make in _PSEUDONYMS.items():
        is_kind = hit.rlike(f"^(?:{FORMATS[kind]})$")
        pair = _replaced(kind, make(key, hit), hit)
        out = F.when(is_kind, pair) if out is None else out.when(is_kind, pair)
    return out.otherwise(F.struct(F.lit(None).cast("string").alias("kind"), hit.alias("text")))


def _replaced(kind: str, new: Column, hit: Column) -> Column:
    return _let(
        new, lambda x: F.struct(F.when(x.isNotNull(), F.lit(kind)).alias("kind"), F.coalesce(x, hit).alias("text"))
    )


def pseudonymize(docs: DataFrame, key: str = KEY, kinds_as: str = "replaced") -> DataFrame:
    """``docs`` with pseudonyms in ``text``, and ``replaced``, or ``kinds_as``: the kinds replaced, in order.

    Replaced are card numbers that pass the Luhn test, phone numbers with a country code or
    area code, social security numbers, IBANs with the right check digits, IPv4 addresses, valid
    dates, e-mail names and long hexadecimal secrets; numbers that fail their test stay, and so
    does all else. A null text stays null and an empty one empty. Rows are mapped one by one:
    repeated rows, any columns and any length are kept as they are. Where
    ``docs`` has a column ``kinds_as`` already, it stays and the kinds are left out. ``key``
    decides the permutations.
    """
    text = F.col("text")
    hits = F.regexp_extract_all(text, F.lit(ANY), F.lit(0))
    looked = F.when(text.rlike(_HINT), F.transform(hits, lambda h: _mapped(key, h)))
    inner = next(name for name in (f"__mapped{k}" for k in range(len(docs.columns) + 1)) if name not in docs.columns)
    rows = docs.withColumn(inner, looked)
    mapped = F.col(inner)
    between = F.split(text, ANY, -1)
    joined = F.array_join(
        F.zip_with(between, F.transform(mapped, lambda m: m["text"]), lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), ""
    )
    out = {"text": F.when(F.coalesce(F.size(mapped), F.lit(0)) > 0, joined).otherwise(text)}
    if kinds_as not in docs.columns:
        kinds = F.filter(F.transform(mapped, lambda m: m["kind"]), lambda k: k.isNotNull())
        out[kinds_as] = F.coalesce(kinds, F.array().cast("array<string>"))
    return rows.withColumns(out).drop(inner)


def op8_pii(spark, sf_dir):
    out = pseudonymize(documents(spark, sf_dir).select("doc_id", "text"))
    return out.select("doc_id", "text", F.size("replaced").cast("long").alias("n_replaced"), F.array_join("replaced", ",").alias("kinds"))


QUERIES = {"op8_pii": op8_pii}
ORACLES: dict[str, str] = {}
