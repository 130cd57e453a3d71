"""Format-preserving pseudonyms for personal data, in SQL expressions alone.

Candidates are found by one pattern and kept only if they pass the check of their
kind: Luhn for card numbers, mod 97 for IBANs, octets for IPv4 addresses, assigned
ranges for social security numbers, the calendar for dates. A valid number is
written as a pair (a, b) of its format's exact domain and permuted by an alternating
Feistel network: a += F(b) mod |A|, b += F(a) mod |B|, where F is a keyed SHA-256
of round, format and half. Each format's domain is the product of the two, so a
pseudonym is a valid value of the same format and no two values share one. Equal
values get equal pseudonyms in all documents, however they are punctuated.

* cards: the first digit stays, the last is the Luhn digit of the others
* phone numbers: North American ones stay such; of others the country code stays
* IBANs: country and letters stay, the check digits are computed anew
* dates: a date stays in its century and keeps its field order and separators
* e-mail addresses and credentials have no number to permute: a keyed digest
  takes their place (for credentials of the same length)

Numbers beside numbers: card numbers are sought last, in what other kinds left. A run
of digit groups parted by single blanks or hyphens is a card number as a whole or,
else, holds card numbers as successive groups of it: those with a length and first
digits that issuers use, taken from the left, the longest first. Of an IBAN candidate
that fails as a whole, its country's length of it is tried.

Nothing else in a text changes. Null text stays null, empty text empty, and both
count 0 replacements. Rows are treated one by one, so repeated rows and rows
without an id agree. Empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 10

#: Fixed patterns of the candidates, tried in this order. Bounded or possessive, so that no text takes quadratic time.
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![A-Za-z])"
CREDENTIAL = (
    r"\bAKIA(?=[A-Z]*[0-9])[0-9A-Z]{16}\b"
    r"|\b(?i:password|passwd|token|secret|api[_-]?key) ?[=:] ?\"?[A-Za-z0-9+/_.-]{8,256}+\"?"
)
IBAN = r"\b[A-Z]{2}\d{2}(?:[A-Z0-9]{11,30}+|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)\b"
IPV4 = r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\.?\d)"
DATE = r"(?<![\d./-])(?:\d{4}-\d{2}-\d{2}|\d{1,2}/\d{1,2}/\d{4}|\d{1,2}\.\d{1,2}\.\d{4})(?![/-]?\d)"
SSN = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
PHONE = (
    r"(?<![\w+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}(?!\d)"
    r"|(?<![\w.(-])(?:1[ .-])?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?![\w-])"
)
CANDIDATE = (
    f"{EMAIL}|(?=[APSTapst])(?:{CREDENTIAL})|(?=[A-Z]){IBAN}"
    f"|(?=[0-9+(])(?:{'|'.join((IPV4, DATE, SSN, PHONE))})"
)
#: At least 13 digits in groups; the run goes on as long as there are digits, blanks and hyphens.
RUN = r"(?:(?<![\d.+-])|(?<=[A-Za-z][.-]))(?=\d(?:[ -]?\d){12})[\d -]{13,}+"
CARD = r"^\d(?:[ -]?\d){12,18}$"
#: Lengths and first digits that card issuers use.
ISSUED = (
    r"^(?:4\d{12}(?:\d{3}){0,2}|5[1-5]\d{14}|2[2-7]\d{14}|3[47]\d{13}|3[0689]\d{12}|35\d{14}|6(?:011|4[4-9]|5)\d{12,13}|62\d{14,17})$"
)
#: Lengths of IBANs by country, fixed by its registry.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FO GL NL", 19: "MK SI", 20: "AT BA EE KZ LT LU XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS", 23: "AE GI IL IQ TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "PT",
    26: "IS TR", 27: "FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU",
    31: "MT SC", 32: "LC",
}
#: Texts without any of these have no candidate.
SIGNS = "[0-9@=:]"


def _number(digits: Column) -> Column:
    return F.when(digits == "", F.lit(0)).otherwise(digits).cast("bigint")


def _keyed(key: str, *parts: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), *[x.cast("string") for x in parts]), 256)


def feistel(key: str, kind: str, a: Column, b: Column, of_a: Column, of_b: Column) -> Column:
    """``struct(a, b)`` permuted within ``0 <= a < of_a`` and ``0 <= b < of_b``."""

    def step(state: Column, turn: Column) -> Column:
        other = F.when(turn % 2 == 0, state["b"]).otherwise(state["a"])
        digest = _keyed(key, F.lit(kind), of_a, of_b, turn, other)
        added = F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")
        return F.struct(
            F.when(turn % 2 == 0, (state["a"] + added) % of_a).otherwise(state["a"]).alias("a"),
            F.when(turn % 2 == 1, (state["b"] + added) % of_b).otherwise(state["b"]).alias("b"),
        )

    start = F.struct(a.cast("bigint").alias("a"), b.cast("bigint").alias("b"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step)


def _apply(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), use)[0]


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, r"\D", "")


def _permuted_digits(key: str, kind: str, digits: Column) -> Column:
    """As many digits, permuted; at most 36."""
    left = F.floor(F.length(digits) / 2).cast("int")
    right = F.length(digits) - left
    power = lambda n: F.rpad(F.lit("1"), n + 1, "0").cast("bigint")
    pair = feistel(
        key, kind, _number(F.substr(digits, F.lit(1), left)), _number(F.substr(digits, left + 1, right)),
        power(left), power(right),
    )
    return _apply(
        pair,
        lambda p: F.concat(
            F.when(left > 0, F.lpad(p["a"].cast("string"), left, "0")).otherwise(""),
            F.lpad(p["b"].cast("string"), right, "0"),
        ),
    )


def _refilled(text: Column, digits: Column) -> Column:
    """``text`` with its digits replaced in order."""
    state = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"))

    def step(s: Column, char: Column) -> Column:
        digit = char.rlike("^[0-9]$")
        return F.struct(
            F.concat(s["out"], F.when(digit, F.substr(digits, s["at"], F.lit(1))).otherwise(char)).alias("out"),
            (s["at"] + digit.cast("int")).alias("at"),
        )

    return F.aggregate(F.split(text, ""), state, step, lambda s: s["out"])


def _places(length: Column) -> Column:
    return F.sequence(F.lit(1), length)


def _luhn_sum(digits: Column, first_doubled: int) -> Column:
    """Luhn sum from the right; ``first_doubled`` is 0 if the last digit is doubled, else 1."""

    def step(total: Column, place: Column) -> Column:
        digit = F.substr(digits, F.length(digits) - place + 1, F.lit(1)).cast("int")
        twice = digit * 2
        return total + F.when((place - 1) % 2 == first_doubled, twice - F.when(twice > 9, 9).otherwise(0)).otherwise(digit)

    return F.aggregate(_places(F.length(digits)), F.lit(0), step)


def _is_card(digits: Column) -> Column:
    return (_luhn_sum(digits, 1) % 10 == 0) & digits.rlike("[1-9]")


def _new_card(key: str, text: Column) -> Column:
    def new(d: Column) -> Column:
        first, inner = F.substr(d, F.lit(1), F.lit(1)), F.substr(d, F.lit(2), F.length(d) - 2)
        payload = F.concat(first, _permuted_digits(key, "card", inner))
        return F.concat(payload, ((10 - _luhn_sum(payload, 0) % 10) % 10).cast("string"))

    return _apply(_digits(text), lambda d: _refilled(text, new(d)))


def _cards_of_run(key: str, run: Column) -> Column:
    """``struct(text, n)``: a run of digit groups with its card numbers replaced, and how many there are."""
    text = F.rtrim(run)
    tail = F.substr(run, F.length(text) + 1)
    whole = text.rlike(CARD) & _apply(_digits(text), _is_card)
    found = lambda out, n: F.struct(out.alias("text"), n.cast("bigint").alias("n"))
    return F.when(whole, found(F.concat(_new_card(key, text), tail), F.lit(1))).otherwise(
        _apply(F.split(run, r"(?<=\d)(?=[ -])|(?<=[ -])(?=\d)"), lambda tokens: _apply(
            _spans(tokens), lambda spans: found(_respanned(key, tokens, spans), F.size(spans))
        ))
    )


def _joined(tokens: Column, start: Column, size: Column) -> Column:
    return F.array_join(F.slice(tokens, start, size), "")


def _spans(tokens: Column) -> Column:
    """``at, size`` of the card numbers among groups (odd places) and what parts them, from the left."""

    def longest(at: Column) -> Column:
        # a group has a digit at least, so a number has 19 groups at most
        sizes = F.filter(
            F.sequence(F.least(F.lit(37), F.size(tokens) - at + 1 - F.pmod(F.size(tokens) - at, F.lit(2))), F.lit(1), F.lit(-2)),
            lambda n: _apply(_joined(tokens, at, n), lambda x: F.length(x).between(13, 37) & x.rlike(CARD) & _apply(
                _digits(x), lambda d: d.rlike(ISSUED) & _is_card(d))),
        )
        return F.when(F.element_at(tokens, at).rlike("^[2-6]"), F.get(sizes, F.lit(0)))

    starts = F.sequence(F.lit(1), F.size(tokens), F.lit(2))
    possible = F.filter(
        F.transform(starts, lambda at: F.struct(at.alias("at"), longest(at).alias("size"))), lambda x: x["size"].isNotNull()
    )
    none = F.array().cast("array<struct<at:int,size:int>>")
    return F.aggregate(possible, none, lambda taken, x: F.when(
        (F.size(taken) == 0) | (F.get(taken, F.size(taken) - 1)["at"] + F.get(taken, F.size(taken) - 1)["size"] <= x["at"]),
        F.concat(taken, F.array(x)),
    ).otherwise(taken))


def _respanned(key: str, tokens: Column, spans: Column) -> Column:
    end = lambda n: F.when(n > 0, F.get(spans, n - 1)["at"] + F.get(spans, n - 1)["size"]).otherwise(1)
    parts = F.transform(spans, lambda x, n: F.concat(
        _joined(tokens, end(n), x["at"] - end(n)), _new_card(key, _joined(tokens, x["at"], x["size"]))
    ))
    return F.concat(F.array_join(parts, ""), _joined(tokens, end(F.size(spans)), F.size(tokens)))


def _cards(key: str, text: Column) -> Column:
    """``struct(text, n)``: ``text`` with its card numbers replaced, and how many there are."""
    runs = F.transform(F.regexp_extract_all(text, F.lit(RUN), F.lit(0)), lambda x: _cards_of_run(key, x))
    none = F.struct(text.alias("text"), F.lit(0).cast("bigint").alias("n"))
    return F.when(~text.rlike(RUN), none).otherwise(_apply(runs, lambda new: F.struct(
        F.array_join(F.zip_with(F.split(text, RUN), new, lambda gap, x: F.concat(gap, F.coalesce(x["text"], F.lit("")))), "").alias("text"),
        F.aggregate(new, F.lit(0).cast("bigint"), lambda n, x: n + x["n"]).alias("n"),
    )))


def _mod97(text: Column) -> Column:
    """The IBAN number (letters as 10 to 35) modulo 97."""

    def step(rest: Column, char: Column) -> Column:
        digit = char.rlike("^[0-9]$")
        return (F.when(digit, rest * 10 + F.when(digit, char).otherwise("0").cast("int"))
                .otherwise(rest * 100 + F.ascii(char) - 55) % 97).cast("int")

    return F.aggregate(F.split(text, ""), F.lit(0), step)


def _iban(key: str, text: Column) -> Column:
    moved = lambda x: F.concat(F.substr(x, F.lit(5)), F.substr(x, F.lit(1), F.lit(4)))

    def new(bare: Column) -> Column:
        inner = F.substr(bare, F.lit(5))
        filled = _apply(_digits(inner), lambda d: F.when(
            F.length(d) > 0, _refilled(inner, _permuted_digits(key, "iban", d))
        ).otherwise(inner))
        def checked(body: Column) -> Column:
            check = 98 - _mod97(F.concat(body, F.substr(bare, F.lit(1), F.lit(2)), F.lit("00")))
            return F.concat(F.lpad(check.cast("string"), 2, "0"), _digits(body))
        return _apply(filled, checked)

    bare = F.regexp_replace(text, " ", "")
    valid = lambda x: _mod97(moved(x)) == 1
    return _apply(bare, lambda x: F.when(valid(x), _refilled(text, new(x))))


def _iban_and_rest(key: str, text: Column) -> Column:
    """``struct(new, rest)`` of a candidate in groups of four that goes on after its country's length."""
    size = F.lit(0)
    for length, countries in IBAN_LENGTHS.items():
        size = F.when(F.substr(text, F.lit(1), F.lit(2)).isin(countries.split()), length + (length - 1) // 4).otherwise(size)
    blank = lambda at: F.substr(text, at, F.lit(1)) == " "
    return _apply(size, lambda n: F.when(
        (n > 0) & blank(F.lit(5)) & blank(n + 1),
        _apply(_iban(key, F.substr(text, F.lit(1), n)), lambda new: F.when(
            new.isNotNull(), F.struct(new.alias("new"), F.substr(text, n + 1).alias("rest")))),
    ))


def _ipv4(key: str, text: Column) -> Column:
    def new(o: Column) -> Column:
        pair = feistel(key, "ipv4", o[0] * 256 + o[1], o[2] * 256 + o[3], F.lit(65536), F.lit(65536))
        return _apply(pair, lambda p: F.concat_ws(
            ".", *[F.floor(x).cast("string") for x in (p["a"] / 256, p["a"] % 256, p["b"] / 256, p["b"] % 256)]
        ))

    octets = F.transform(F.split(text, r"\."), lambda x: x.cast("int"))
    return _apply(octets, lambda o: F.when(F.forall(o, lambda x: x <= 255), new(o)))


def _ssn(key: str, text: Column) -> Column:
    part = lambda at, n: F.substr(text, F.lit(at), F.lit(n)).cast("int")
    area, group, serial = part(1, 3), part(5, 2), part(8, 4)
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    rank = area - 1 - (area > 666).cast("int")
    pair = feistel(key, "ssn", rank * 99 + group - 1, serial - 1, F.lit(898 * 99), F.lit(9999))

    def new(p: Column) -> Column:
        low = F.floor(p["a"] / 99)
        fill = lambda x, n: F.lpad(x.cast("string"), n, "0")
        return F.concat_ws("-", fill(low + 1 + (low >= 665).cast("int"), 3), fill(p["a"] % 99 + 1, 2), fill(p["b"] + 1, 4))

    return F.when(valid, _apply(pair, new))


def _date(key: str, text: Column) -> Column:
    iso = text.contains("-")

    def new(f: Column) -> Column:
        month_first = (~iso) & (f[1].cast("int") > 12)
        year = F.when(iso, f[0]).otherwise(f[2])
        month = F.when(iso | ~month_first, f[1]).otherwise(f[0])
        day = F.when(iso, f[2]).when(month_first, f[1]).otherwise(f[0])
        date = F.concat_ws("-", year, month, day).try_cast("date")
        start = F.concat(F.substr(year, F.lit(1), F.lit(2)), F.lit("00-01-01")).cast("date")
        leap = (F.substr(year, F.lit(1), F.lit(2)).cast("int") % 4) == 0
        # days of a century: 75 * 487 if its first year is a leap year, else 92 * 397
        of_a, of_b = F.when(leap, 75).otherwise(92), F.when(leap, 487).otherwise(397)
        since = F.datediff(date, start)
        pair = feistel(key, "date", F.floor(since / of_b), since % of_b, of_a, of_b)

        def shown(p: Column) -> Column:
            moved = F.date_add(start, (p["a"] * of_b + p["b"]).cast("int"))
            wide = lambda x, like: F.when(F.length(like) == 2, F.lpad(x.cast("string"), 2, "0")).otherwise(x.cast("string"))
            mark = F.when(text.contains("/"), "/").otherwise(".")
            first, second = wide(F.dayofmonth(moved), f[0]), wide(F.month(moved), f[1])
            other = F.concat(wide(F.month(moved), f[0]), mark, wide(F.dayofmonth(moved), f[1]))
            return F.when(iso, F.date_format(moved, "yyyy-MM-dd")).otherwise(
                F.concat(F.when(month_first, other).otherwise(F.concat(first, mark, second)), mark, F.date_format(moved, "yyyy"))
            )

        return F.when(date.isNotNull() & (F.substr(year, F.lit(1), F.lit(1)) != "0"), _apply(pair, shown))

    return _apply(F.split(text, "[-/.]"), new)


def _phone(key: str, text: Column) -> Column:
    def national(d: Column) -> Column:
        n = F.when(F.length(d) == 11, F.substr(d, F.lit(2))).otherwise(d)
        part = lambda at, size: F.substr(n, F.lit(at), F.lit(size)).cast("int")
        pair = feistel(
            key, "nanp", (part(1, 3) - 200) * 100 + part(7, 2), (part(4, 3) - 200) * 100 + part(9, 2),
            F.lit(80000), F.lit(80000),
        )
        fill = lambda x: F.lpad(x.cast("string"), 2, "0")
        return _apply(pair, lambda p: F.concat(
            F.when(F.length(d) == 11, "1").otherwise(""), (F.floor(p["a"] / 100) + 200).cast("string"),
            (F.floor(p["b"] / 100) + 200).cast("string"), fill(p["a"] % 100), fill(p["b"] % 100),
        ))

    def other(d: Column) -> Column:
        code = F.length(F.regexp_extract(text, r"^\+(\d{1,3})", 1))
        return F.concat(F.substr(d, F.lit(1), code), _permuted_digits(key, "phone", F.substr(d, code + 1)))

    def new(d: Column) -> Column:
        north = d.rlike("^1?[2-9][0-9]{2}[2-9][0-9]{6}$") & (~text.startswith("+") | text.startswith("+1"))
        long = F.length(d).between(8, 15)
        return F.when(north, _refilled(text, national(d))).when(long, _refilled(text, other(d)))

    return _apply(_digits(text), new)


def _email(key: str, text: Column) -> Column:
    return F.concat(F.lit("u"), F.substring(_keyed(key, F.lit("email"), F.lower(text)), 1, 12), F.lit("@example.invalid"))


def _credential(key: str, text: Column) -> Column:
    head = F.regexp_extract(text, r"^(AKIA|(?i:password|passwd|token|secret|api[_-]?key) ?[=:] ?\"?)", 1)
    body = F.regexp_replace(F.substr(text, F.length(head) + 1), "\"$", "")
    digest = _keyed(key, F.lit("credential"), body)
    return F.concat(
        head, F.upper(F.rpad(digest, F.length(body), digest)), F.when(text.endswith("\""), "\"").otherwise("")
    )


def pseudonym(key: str, text: Column) -> Column:
    """The pseudonym of a candidate other than a card number; null if it fails its kind's check."""
    return (
        F.when(text.contains("@"), _email(key, text))
        .when(text.rlike(f"^(?:{CREDENTIAL})$"), _credential(key, text))
        .when(text.rlike("^[A-Z]{2}"), _iban(key, text))
        .when(text.rlike(r"^\d{1,3}(?:\.\d{1,3}){3}$"), _ipv4(key, text))
        .when(text.rlike(r"^(?:\d{4}-\d{2}-\d{2}|\d{1,2}([/.])\d{1,2}\1\d{4})$"), _date(key, text))
        .when(text.rlike(r"^\d{3}-\d{2}-\d{4}$"), _ssn(key, text))
        .otherwise(_phone(key, text))
    )


def pseudonymize(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text, n_replaced``: each text with pseudonyms and how many it has."""
    found = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"),
        F.when(
            F.col(text_col).rlike(SIGNS), F.regexp_extract_all(F.col(text_col), F.lit(CANDIDATE), F.lit(0))
        ).otherwise(F.array().cast("array<string>")).alias("found"),
    )
    def name(x: Column) -> Column:
        return _apply(pseudonym(key, x), lambda new: F.when(
            new.isNotNull(), F.struct(new.alias("new"), F.lit("").alias("rest"))
        ).otherwise(F.coalesce(
            F.when(x.rlike("^[A-Z]{2}\\d"), _iban_and_rest(key, x)),
            F.struct(F.lit(None).cast("string").alias("new"), x.alias("rest")),
        )))

    named = found.withColumn("names", F.transform("found", name))
    # gaps, failed candidates and what follows an account number may hold card numbers
    plain = lambda x: F.struct(F.coalesce(x, F.lit("")).alias("old"), F.lit(None).cast("string").alias("new"))
    pieces = F.flatten(F.zip_with(
        F.split("text", CANDIDATE), "names",
        lambda gap, x: F.array(plain(gap), F.struct(F.lit("").alias("old"), x["new"].alias("new")), plain(x["rest"])),
    ))
    done = F.transform(pieces, lambda x: F.when(
        x["new"].isNotNull(), F.struct(x["new"].alias("text"), F.lit(1).cast("bigint").alias("n"))
    ).otherwise(_cards(key, x["old"])))
    work = F.exists("names", lambda x: x["new"].isNotNull()) | F.col("text").rlike(RUN)
    made = named.withColumn("done", F.when(work, done))
    count = F.aggregate("done", F.lit(0).cast("bigint"), lambda n, x: n + x["n"])
    return made.select(
        "doc_id",
        F.coalesce(F.array_join(F.col("done.text"), ""), F.col("text")).alias("text"),
        F.coalesce(count, F.lit(0).cast("bigint")).alias("n_replaced"),
    )
