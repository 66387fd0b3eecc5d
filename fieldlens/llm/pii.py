"""Personal data under format-preserving Feistel pseudonyms, in DataFrame terms.

One pattern finds candidates; each is validated by its kind's rule and, if
valid, permuted with a key within its own format by a Feistel network of
``ROUNDS`` rounds over mixed radices: the value's digits are cut in two halves,
and in turn each half is shifted, digit by digit modulo the digit's radix, by a
SHA-256 of key, kind, round, position and the other half.  A permutation never
merges two values, and equal values get equal pseudonyms in every document,
whatever separators they are written with.  A round hashes the other half once
and derives its shifts from that digest, so the work is linear in the value.

kind    validated by                      permuted
email   its form, 64 characters before the @, labels of 63   letters and digits before the last dot, by class
secret  32 or more hex digits, of both kinds   all
iban    check digits, modulo 97           the account part by class; new check digits
card    13 to 19 digits, Luhn             all but the last; new last digit
ssn     no impossible area, group, serial   area, group and serial
ipv4    octets up to 255                  octets
date    a day of 1800 to 2199             the day, within these years
phone   + and up to 15 digits, or 3-3-4   digits after the country code

Candidates that fail their rule stay as they are, and so does all other text.
There is no Python code on the executors; nothing is shuffled.

No form repeats a group without a bound (such a pattern recurses for each
round and would end the executor on a long text): an email's domain has at most
126 labels, as domains do.

Defined cases: null texts stay null with no findings; texts without findings
stay as they are; of an email beyond the bounds the part within them counts; all rows
and other columns are kept; input columns with the names of outputs are
replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..operators.joins import spare_names
from .common import with_columns

ROUNDS = 10

#: The forms of the kinds, in the order in which they are tried.
FORMS = {
    "email": r"[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@(?:[A-Za-z0-9-]{1,63}\.){1,126}[A-Za-z]{2,63}",
    "secret": r"(?:[0-9a-f]{32,}|[0-9A-F]{32,})",
    "iban": r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}",
    "card": r"(?:[0-9]{13,19}|[0-9]{4}[ -][0-9]{4}[ -][0-9]{4}[ -][0-9]{1,7}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})",
    "ssn": r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
    "ipv4": r"(?:[0-9]{1,3}\.){3}[0-9]{1,3}",
    "date": r"(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}\.[0-9]{2}\.[0-9]{4}|[0-9]{2}/[0-9]{2}/[0-9]{4})",
    "phone": r"(?:\+1[ .-]?\(?[0-9]{3}\)?[ .-]?[0-9]{3}[ .-]?[0-9]{4}"
             r"|\+[0-9]{1,3}[ .-]?(?:\(?[0-9]{2,4}\)?[ .-]?){1,3}[0-9]{2,4}"
             r"|\(?[0-9]{3}\)?[ .-]{1,2}[0-9]{3}[ .-][0-9]{4})",
}
_START, _END = r"(?<![A-Za-z0-9])", r"(?![A-Za-z0-9])"
ANY = _START + "(?:" + "|".join(FORMS.values()) + ")" + _END

#: Fixed value: days of 400 years, which is 189 x 773, and their first day.
FIRST_DAY, DAYS = "1800-01-01", (189, 773)
DATE_FORMATS = ("yyyy-MM-dd", "dd.MM.yyyy", "MM/dd/yyyy")


def _let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once, not at each use in it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def feistel(digits: Column, radix: Column, kind: str, key: str) -> Column:
    """array<long>: the permuted digits, each below its radix."""

    def shifts(s, k):
        """Four digits' shifts to a hash."""
        seen = F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), k.cast("string"),
                                  F.array_join(s["b"].cast("array<string>"), ",")), 256)
        block = lambda d: F.transform(F.sequence(F.lit(0), F.floor(F.size(s["a"]) / 4).cast("int")),
                                      lambda j: F.sha2(F.concat_ws("|", d, j.cast("string")), 256))
        return _let(seen, block)

    def step(s, k):
        def moved(blocks):
            part = lambda i: F.get(blocks, F.floor(i / 4).cast("int")).substr((i % 4) * 15 + 1, F.lit(15))
            return F.transform(s["a"], lambda x, i: F.pmod(x + F.conv(part(i), 16, 10).cast("long"), F.get(s["ra"], i)))

        return F.struct(s["b"].alias("a"), _let(shifts(s, k), moved).alias("b"), s["rb"].alias("ra"), s["ra"].alias("rb"))

    def network(x):
        half = F.floor(F.size(x["d"]) / 2).cast("int")
        left = lambda c: F.slice(c, F.lit(1), half)
        right = lambda c: F.slice(c, half + 1, F.size(x["d"]) - half)
        start = F.struct(left(x["d"]).alias("a"), right(x["d"]).alias("b"), left(x["r"]).alias("ra"),
                         right(x["r"]).alias("rb"))
        return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step, lambda s: F.concat(s["a"], s["b"]))

    return _let(F.struct(digits.cast("array<bigint>").alias("d"), radix.cast("array<bigint>").alias("r")), network)


# -------------------------------------------------------------- pieces of text

def _chars(value: Column) -> Column:
    return F.filter(F.split(value, ""), lambda c: c != "")


def _digits(value: Column) -> Column:
    return F.transform(_chars(F.regexp_replace(value, "[^0-9]", "")), lambda c: c.cast("bigint"))


def _poured(value: Column, digits: Column, skip: Column | int = 0) -> Column:
    """``value`` with its digits, after the first ``skip``, replaced in order."""
    skip = F.lit(skip) if isinstance(skip, int) else skip

    def step(s, c):
        is_digit = c.rlike("[0-9]")
        new = F.when(is_digit & (s["i"] >= skip), F.get(digits, s["i"] - skip).cast("string")).otherwise(c)
        return F.struct(F.concat(s["t"], new).alias("t"), (s["i"] + is_digit.cast("int")).alias("i"))

    return F.aggregate(_chars(value), F.struct(F.lit("").alias("t"), F.lit(0).alias("i")), step, lambda s: s["t"])


def _same(digits: Column, radix: int) -> Column:
    return F.transform(digits, lambda x: F.lit(radix))


def _by_class(value: Column, kind: str, key: str) -> Column:
    """Letters and digits of ``value`` permuted, each within its class."""
    base = lambda c: F.when(c.rlike("[0-9]"), 48).when(c.rlike("[A-Z]"), 65).otherwise(97)

    def permuted(x):
        own = F.filter(x["chars"], lambda c: c.rlike("[A-Za-z0-9]"))
        new = feistel(F.transform(own, lambda c: F.ascii(c) - base(c)),
                      F.transform(own, lambda c: F.when(c.rlike("[0-9]"), 10).otherwise(26)), kind, key)

        def poured(digits):
            def step(s, c):
                ours = c.rlike("[A-Za-z0-9]")
                to = F.when(ours, F.char(base(c) + F.get(digits, s["i"]))).otherwise(c)
                return F.struct(F.concat(s["t"], to).alias("t"), (s["i"] + ours.cast("int")).alias("i"))
            return F.aggregate(x["chars"], F.struct(F.lit("").alias("t"), F.lit(0).alias("i")), step, lambda s: s["t"])

        return _let(new, poured)

    return _let(F.struct(_chars(value).alias("chars")), permuted)


# --------------------------------------------------------------------- kinds

def _luhn_sum(digits: Column) -> Column:
    """The Luhn sum of digits whose last one is to be doubled."""
    n = F.size(digits)
    weighted = F.transform(digits, lambda d, i: F.when((n - i) % 2 == 1, d * 2 - F.when(d > 4, 9).otherwise(0)).otherwise(d))
    return F.aggregate(weighted, F.lit(0).cast("bigint"), lambda s, d: s + d)


def _card(value: Column, key: str) -> Column:
    def new(digits):
        body = F.slice(digits, F.lit(1), F.size(digits) - 1)
        valid = F.pmod(_luhn_sum(body) + F.element_at(digits, -1), F.lit(10)) == 0
        fresh = lambda d: _poured(value, F.concat(d, F.array(F.pmod(-_luhn_sum(d), F.lit(10)))))
        return F.when(valid, _let(feistel(body, _same(body, 10), "card", key), fresh))

    return _let(_digits(value), new)


def _mod97(text: Column) -> Column:
    """The number that IBAN rules read in ``text``, modulo 97."""
    number = lambda c: F.when(c.rlike("[0-9]"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
    return F.aggregate(_chars(text), F.lit(0).cast("bigint"),
                       lambda s, c: F.pmod(F.when(number(c) > 9, s * 100).otherwise(s * 10) + number(c), F.lit(97)))


def _iban(value: Column, key: str) -> Column:
    country, check, account = value.substr(1, 2), value.substr(3, 2), F.substring(value, 5, 64)
    fresh = lambda a: F.concat(country, F.lpad((98 - _mod97(F.concat(a, country, F.lit("00")))).cast("string"), 2, "0"), a)
    return F.when(_mod97(F.concat(account, country, check)) == 1, _let(_by_class(account, "iban", key), fresh))


def _ssn(value: Column, key: str) -> Column:
    area, group, serial = (value.substr(a, n).cast("bigint") for a, n in ((1, 3), (5, 2), (8, 4)))
    valid = (area > 0) & (area != 666) & (area < 900) & (group > 0) & (serial > 0)
    digits = F.array(area - 1 - (area > 666).cast("int"), group - 1, serial - 1)

    def text(d):
        number = F.get(d, F.lit(0)) + 1
        return F.concat_ws("-", F.lpad((number + (number >= 666).cast("int")).cast("string"), 3, "0"),
                           F.lpad((F.get(d, F.lit(1)) + 1).cast("string"), 2, "0"),
                           F.lpad((F.get(d, F.lit(2)) + 1).cast("string"), 4, "0"))

    radix = F.array(F.lit(898), F.lit(99), F.lit(9999))
    return F.when(valid, _let(feistel(digits, radix, "ssn", key), text))


def _ipv4(value: Column, key: str) -> Column:
    def new(octets):
        valid = F.forall(octets, lambda o: o < 256)
        return F.when(valid, F.array_join(feistel(octets, _same(octets, 256), "ipv4", key).cast("array<string>"), "."))

    return _let(F.split(value, r"\.").cast("array<bigint>"), new)


def _date(value: Column, key: str) -> Column:
    first = F.lit(FIRST_DAY).cast("date")
    a, b = DAYS

    def new(parsed):
        day = F.date_diff(parsed["day"], first)

        def text(d):
            fresh = F.date_add(first, (F.get(d, F.lit(0)) * b + F.get(d, F.lit(1))).cast("int"))
            out = F.date_format(fresh, DATE_FORMATS[-1])
            for f in DATE_FORMATS[:-1]:
                out = F.when(parsed["format"] == f, F.date_format(fresh, f)).otherwise(out)
            return out

        digits = F.array(F.floor(day / b), F.pmod(day, F.lit(b)))
        permuted = feistel(digits, F.array(F.lit(a), F.lit(b)), "date", key)
        return F.when(day.between(0, a * b - 1), _let(permuted, text))

    form = F.when(value.contains("-"), DATE_FORMATS[0]).when(value.contains("."), DATE_FORMATS[1]).otherwise(DATE_FORMATS[2])
    year, month, day = (F.when(value.contains("-"), value.substr(*x)).when(value.contains("."), value.substr(*y))
                        .otherwise(value.substr(*z)) for x, y, z in
                        (((1, 4), (7, 4), (7, 4)), ((6, 2), (4, 2), (1, 2)), ((9, 2), (1, 2), (4, 2))))
    parsed = F.concat_ws("-", year, month, day).try_cast("date")
    return _let(F.struct(parsed.alias("day"), form.alias("format")), new)


def _phone(value: Column, key: str) -> Column:
    country = F.length(F.regexp_extract(value, r"^\+([0-9]{1,3}?)(?:[ .()-]|(?=[0-9]{7,12}$))", 1))

    def new(digits):
        own = F.slice(digits, country + 1, F.size(digits))
        fresh = feistel(own, _same(own, 10), "phone", key)
        return F.when(F.size(digits) <= 15, _let(fresh, lambda d: _poured(value, d, country)))

    return _let(_digits(value), new)


def _secret(value: Column, key: str) -> Column:
    def new(low):
        digits = F.transform(_chars(low), lambda c: F.conv(c, 16, 10).cast("bigint"))
        text = F.array_join(F.transform(feistel(digits, _same(digits, 16), "secret", key),
                                        lambda d: F.lit("0123456789abcdef").substr(d.cast("int") + 1, F.lit(1))), "")
        mixed = low.rlike("[a-f]") & low.rlike("[0-9]")
        return F.when(mixed, F.when(value == low, text).otherwise(F.upper(text)))

    return _let(F.lower(value), new)


def _email(value: Column, key: str) -> Column:
    name = F.regexp_extract(value, r"^(.*)\.[^.]*$", 1)
    return F.concat(_by_class(name, "email", key), F.regexp_extract(value, r"(\.[^.]*)$", 1))


_KINDS = {"email": _email, "secret": _secret, "iban": _iban, "card": _card, "ssn": _ssn, "ipv4": _ipv4, "date": _date,
          "phone": _phone}


def _kind(value: Column) -> Column:
    out = F.lit(None).cast("string")
    for kind, form in reversed(FORMS.items()):
        out = F.when(value.rlike(f"^{form}$"), kind).otherwise(out)
    return out


def _pseudonym(value: Column, kind: Column, key: str) -> Column:
    """The pseudonym of a valid candidate, else null."""
    out = F.lit(None).cast("string")
    for name, make in _KINDS.items():
        out = F.when(kind == name, make(value, key)).otherwise(out)
    return out


def pseudonymize(docs: DataFrame, key: str, *, text_col: str = "text") -> DataFrame:
    """``docs`` with the text under pseudonyms and ``findings``:
    array<struct<kind, original, pseudonym>> in order of the text.  Drop the
    originals before the table leaves the protected side."""
    text = F.col(text_col)

    def found(value):
        of_kind = lambda k: F.struct(k.alias("kind"), value.alias("original"), _pseudonym(value, k, key).alias("pseudonym"))
        return _let(_kind(value), of_kind)

    candidates = F.regexp_extract_all(text, F.lit(ANY), F.lit(0))
    name, = spare_names(docs.columns, "found")
    out = docs.withColumn(name, F.when(text.rlike("[0-9@]"), F.transform(candidates, found)))
    between = F.split(text, ANY, -1)
    new_text = _let(F.struct(between.alias("between"), F.col(name).alias("found")), lambda x: F.array_join(
        F.transform(x["between"], lambda t, i: F.concat(t, F.coalesce(
            F.get(x["found"], i)["pseudonym"], F.get(x["found"], i)["original"], F.lit("")))), ""))
    findings = F.coalesce(F.filter(name, lambda f: f["pseudonym"].isNotNull()),
                          F.array().cast("array<struct<kind:string,original:string,pseudonym:string>>"))
    changed = F.exists(name, lambda f: f["pseudonym"].isNotNull())
    new = {text_col: F.when(changed, new_text).otherwise(text), "findings": findings}
    ordered = [c for c in docs.columns if c.lower() != "findings"] + ["findings"]
    return with_columns(out, new).select(*[F.col(f"`{c}`") for c in ordered])
