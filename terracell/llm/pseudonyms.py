"""Format-preserving pseudonyms for personal data, by keyed Feistel permutations. DataFrame functions only.

One pattern finds candidates: e-mail and IP addresses, card numbers, phone numbers, social security numbers, bank
account numbers, dates, and secrets in quotes. Numbers and dates are validated (Luhn, mod 97, calendar, ranges); what fails
stays as it is. A value becomes an array of places, each with its own base (10 for a digit, 26 for a letter, 256 for an
octet, 898 for an area code). An alternating Feistel network adds to each half, place by place and modulo its base, a keyed hash
of the other half. That is a permutation of all values of the format: equal values get equal pseudonyms in
every document, different values different ones. Check digits are made anew, so the result validates too.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 10

# Lengths of bank account numbers by country.
ACCOUNTS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR",
    27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC",
    32: "LC", 33: "RU",
}
# Country calling codes; those not listed by their first digits have three.
CALLING = r"\+(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{1,3})"


def _accounts() -> str:
    """Account numbers in groups of four as long as their country has them, so that no neighbour is taken for a group."""
    forms = []
    for length, countries in ACCOUNTS.items():
        groups, rest = divmod(length - 4, 4)
        forms.append(f"(?:{countries.replace(' ', '|')})[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{{groups}}}" + (f" ?[A-Z0-9]{{{rest}}}" if rest else ""))
    known = "|".join(ACCOUNTS.values()).replace(" ", "|")
    other = f"(?!{known})[A-Z]{{2}}[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{2,7}}(?: ?[A-Z0-9]{{1,3}})?"
    return f"(?=[A-Z]{{2}}[0-9]{{2}})(?:{'|'.join([*forms, other])})"


NATIONAL = r"(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z])"
INTERNATIONAL = r"\+(?=(?:[ .()-]{0,2}[0-9]){8,15}(?![0-9]))[1-9][0-9]{0,2}(?:[ .-]?\(?[0-9]{1,12}\)?){1,6}"

OCTET = "(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
# What a candidate of each kind looks like, in the order in which they are tried at a place.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![A-Za-z0-9])",
    "iban": rf"(?<![A-Za-z0-9]){_accounts()}(?![A-Za-z0-9])",
    "date": r"(?<![0-9A-Za-z./-])(?:[0-9]{4}(?:-[0-9]{2}-|/[0-9]{2}/)[0-9]{2}|[0-9]{2}(?:\.[0-9]{2}\.|/[0-9]{2}/|-[0-9]{2}-)[0-9]{4})(?![0-9A-Za-z/-])",
    "ip": rf"(?<![0-9A-Za-z.]){OCTET}(?:\.{OCTET}){{3}}(?![0-9A-Za-z]|\.[0-9])",
    "ssn": r"(?<![0-9A-Za-z-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9A-Za-z]|-[0-9])",
    "phone": rf"(?<![0-9A-Za-z+])(?:{NATIONAL}|{INTERNATIONAL})(?![0-9A-Za-z])",
    "card": r"(?<![0-9A-Za-z])(?:[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5}|[0-9]{13,19})(?![0-9A-Za-z])",
    "secret": r"""(?<=(?:token|secret|password|api_key)(?: [=:] |[=:] ?)["'])(?=[0-9_-]{0,127}[A-Za-z])[A-Za-z0-9_-]{16,128}(?=["'])""",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
# No candidate is without one of these.
TRACE = "[0-9@\"']"

CENTURIES = {"19": (92, 397), "20": (75, 487)}


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def feistel(places: Column, bases: Column, tweak: Column, key: str, rounds: int = ROUNDS) -> Column:
    """A permutation of arrays of places, 0 <= places[i] < bases[i]. Base 1 marks a place that stays."""

    def bits(turn: Column, at: Column, half: Column) -> Column:
        """48 bits of a keyed hash of one half, for the place ``at`` of the other."""
        inner = F.sha2(F.concat_ws("|", F.lit(key), tweak, turn.cast("string"), at.cast("string"), half), 256)
        return F.conv(F.substring(F.sha2(F.concat(inner, F.lit(key)), 256), 1, 12), 16, 10).cast("long")

    def turn(state: Column, r: Column, n: Column) -> Column:
        cut, left = F.shiftright(n, 1), r % 2 == 0
        half = F.when(left, F.slice(state, F.shiftright(n, 1) + 1, n)).otherwise(F.slice(state, F.lit(1), cut))
        told = F.array_join(half.cast("array<string>"), ",")
        return _let(
            told, lambda h: F.transform(state, lambda x, i: F.when((i < cut) == left, F.pmod(x + bits(r, i, h), F.element_at(bases, i + 1))).otherwise(x))
        )

    turns = F.sequence(F.lit(0), F.lit(rounds - 1))
    return F.aggregate(turns, places, lambda state, r: _let(F.size(state), lambda n: turn(state, r, n)))


def _chars(text: Column) -> Column:
    return F.split(text, "")


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _put_back(text: Column, fresh: Column) -> Column:
    """``text`` with its letters and digits replaced by the characters of ``fresh``, one after the other."""
    zero = F.struct(F.lit("").alias("out"), F.lit(0).alias("k"))

    def step(acc: Column, c: Column) -> Column:
        own = c.rlike("[A-Za-z0-9]")
        char = F.when(own, F.substring(fresh, acc["k"] + 1, F.lit(1))).otherwise(c)
        return F.struct(F.concat(acc["out"], char).alias("out"), (acc["k"] + own.cast("int")).alias("k"))

    return F.aggregate(_chars(text), zero, step, lambda acc: acc["out"])


def _luhn(digits: Column) -> Column:
    """Luhn sum of a string of digits, the last one counted once."""
    n = F.length(digits)

    def add(acc: Column, i: Column) -> Column:
        x = F.substring(digits, n - i + 1, F.lit(1)).cast("int")
        return acc + F.when(i % 2 == 0, 2 * x - F.when(x > 4, 9).otherwise(0)).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add)


def _mod97(text: Column) -> Column:
    """An account number, country and check digits moved to its end, modulo 97."""
    return F.aggregate(_chars(text), F.lit(0), lambda acc, c: F.when(c <= "9", (acc * 10 + F.ascii(c) - 48) % 97).otherwise((acc * 100 + F.ascii(c) - 55) % 97))


def _account(m: Column) -> Column:
    return F.substring(F.regexp_replace(m, " ", ""), F.lit(5), F.lit(64))


def _rest(m: Column) -> Column:
    return F.regexp_replace(m, f"^{CALLING}", "")


def _name(m: Column) -> Column:
    return F.regexp_replace(m, r"\.[A-Za-z]+$", "")


def _form(text: Column, tweak: Column, small: Column | int = 26) -> Column:
    """Characters as places: digits and ASCII letters within their class; ``small`` is the number of small letters in use."""
    size = (F.lit(small) if isinstance(small, int) else small).cast("long")

    def place(c: Column) -> Column:
        def of(low: str, base: Column) -> Column:
            return F.struct((F.ascii(c) - ord(low)).cast("long").alias("place"), base.alias("base"), F.lit(ord(low)).alias("low"))

        stay = F.struct(F.lit(0).cast("long").alias("place"), F.lit(1).cast("long").alias("base"), F.ascii(c).alias("low"))
        return F.when(c.between("0", "9"), of("0", F.lit(10).cast("long"))).when(c.between("A", "Z"), of("A", F.lit(26).cast("long"))).when(
            c.between("a", "z"), of("a", size)
        ).otherwise(stay)

    return F.struct(tweak.alias("tweak"), F.transform(_chars(text), place).alias("places"))


def _tuple(places: list[Column], bases: list[int], tweak: Column) -> Column:
    cells = [F.struct(p.cast("long").alias("place"), F.lit(b).cast("long").alias("base"), F.lit(0).alias("low")) for p, b in zip(places, bases)]
    return F.struct(tweak.alias("tweak"), F.array(*cells).alias("places"))


def _ssn_form(m: Column) -> Column:
    """Areas 1 to 899 without 666, groups 1 to 99, serials 1 to 9999."""
    area, group, serial = (F.substring(m, a, n).cast("int") for a, n in ((1, 3), (5, 2), (8, 4)))
    return _tuple([area - 1 - (area > 666).cast("int"), group - 1, serial - 1], [898, 99, 9999], F.lit("ssn"))


def _day_form(a: int, b: int, century: str) -> Callable[[Column], Column]:
    return lambda day: _tuple([F.floor(day / b), day % b], [a, b], F.lit("date" + century))


def _date_form(m: Column) -> Column:
    """A date's day within its century; years stand first or last, days before months if years stand last."""
    iso = m.rlike("^[0-9]{4}")
    year = F.when(iso, F.substring(m, 1, 4)).otherwise(F.substring(m, 7, 4)).cast("int")
    month = F.when(iso, F.substring(m, 6, 2)).otherwise(F.substring(m, 4, 2)).cast("int")
    day = F.when(iso, F.substring(m, 9, 2)).otherwise(F.substring(m, 1, 2)).cast("int")
    leap = (year % 4 == 0) & ((year % 100 != 0) | (year % 400 == 0))
    most = F.when(month.isin(4, 6, 9, 11), 30).when(month == 2, F.when(leap, 29).otherwise(28)).otherwise(31)
    valid = month.between(1, 12) & (day >= 1) & (day <= most)
    out = F.lit(None)
    for century, (a, b) in CENTURIES.items():
        at = F.datediff(F.make_date(year, month, day), F.lit(f"{century}00-01-01").cast("date"))
        form = _let(at, _day_form(a, b, century))
        out = F.when(valid & (F.floor(year / 100) == int(century)), form).otherwise(out)
    return out


def _form_of(m: Column, kind: Column) -> Column:
    """Places, bases and what is hashed with them (tweak); null for what does not validate."""
    valid_iban = (_mod97(F.concat(_account(m), F.substring(m, 1, 4))) == 1) & F.length(_account(m)).between(11, 30)
    octets = F.split(m, r"\.")
    forms = {
        "email": _form(_name(m), F.lit("email")),
        "secret": _form(m, F.lit("secret"), F.when(m.rlike("^[0-9a-f]+$"), 6).otherwise(26)),
        "iban": F.when(valid_iban, _form(_account(m), F.concat(F.lit("iban"), F.substring(m, 1, 2)))),
        "date": _date_form(m),
        "ip": _tuple([F.element_at(octets, i) for i in range(1, 5)], [256] * 4, F.lit("ip")),
        "ssn": _ssn_form(m),
        "phone": _form(_digits(_rest(m)), F.lit("phone")),
        "card": _let(_digits(m), lambda d: F.when(_luhn(d) % 10 == 0, _form(F.substring(d, F.lit(1), F.length(d) - 1), F.lit("card")))),
    }
    return F.coalesce(*[F.when(kind == k, f) for k, f in forms.items()])


def _text_of(m: Column, kind: Column, form: Column, moved: Column) -> Column:
    """The pseudonym, in the shape of the value ``m``."""

    def number(i: int, plus: int = 0, width: int = 2) -> Column:
        return F.lpad((F.element_at(moved, i) + plus).cast("string"), width, "0")

    def chars(body: Callable[[Column], Column]) -> Column:
        cells = F.arrays_zip(moved.alias("m"), form["places"]["low"].alias("l"))
        return _let(F.array_join(F.transform(cells, lambda z: F.char(z["m"] + z["l"])), ""), body)

    def iban(fresh: Column) -> Column:
        country = F.substring(m, 1, 2)
        check = F.lpad((98 - _mod97(F.concat(fresh, country, F.lit("00")))).cast("string"), 2, "0")
        return _put_back(m, F.concat(country, check, fresh))

    def card(fresh: Column) -> Column:
        return _put_back(m, F.concat(fresh, F.pmod(10 - _luhn(F.concat(fresh, F.lit("0"))), F.lit(10)).cast("string")))

    def phone(fresh: Column) -> Column:
        return F.concat(F.regexp_extract(m, f"^{CALLING}", 0), _put_back(_rest(m), fresh))

    def date(new: Column) -> Column:
        sign = F.regexp_extract(m, "[-/.]", 0)
        y, mo, d = (F.date_format(new, f) for f in ("yyyy", "MM", "dd"))
        return F.when(m.rlike("^[0-9]{4}"), F.concat(y, sign, mo, sign, d)).otherwise(F.concat(d, sign, mo, sign, y))

    day = (F.element_at(moved, 1) * F.element_at(form["places"]["base"], 2) + F.element_at(moved, 2)).cast("int")
    first = F.concat(F.substring(form["tweak"], 5, 2), F.lit("00-01-01")).cast("date")
    area = _let(F.element_at(moved, 1) + 1, lambda x: F.lpad((x + (x >= 666).cast("int")).cast("string"), 3, "0"))
    texts = {
        "email": chars(lambda x: F.concat(x, F.regexp_extract(m, r"\.[A-Za-z]+$", 0))),
        "secret": chars(lambda x: x),
        "iban": chars(iban),
        "date": _let(F.date_add(first, day), date),
        "ip": F.array_join(moved.cast("array<string>"), "."),
        "ssn": F.concat_ws("-", area, number(2, 1), number(3, 1, 4)),
        "phone": chars(phone),
        "card": chars(card),
    }
    return F.when(form.isNotNull(), F.coalesce(*[F.when(kind == k, t) for k, t in texts.items()]))


def pseudonymize(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_found and n_<kind> (validated values), text with their pseudonyms in place.

    A null text stays null, with nothing found. Null ids stay null, repeated rows each give a row, no rows give no rows, other
    columns are ignored. Whole texts are searched. International
    phone numbers keep their country's code; groups of digits that follow one a blank apart count as its own. Left in clear: dates
    with two-digit years, month first, or outside 1900 to 2099, and phone numbers without country code in other groups than 3-3-4. With the same ``key``
    equal values, however grouped by blanks, dashes or dots, become equal pseudonyms.
    """
    text = F.col("text")
    out = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    found = F.when(text.rlike(TRACE), F.regexp_extract_all("text", F.lit(ANY), F.lit(0)))
    out = out.withColumn("found", F.coalesce(found, F.array().cast("array<string>")))

    def kind_of(m: Column) -> Column:
        # The lookarounds saw the text; the candidate alone is told by what it is made of.
        return reduce(lambda rest, k: F.when(m.rlike(f"^(?:{ALONE[k]})$"), k).otherwise(rest), reversed(ALONE), F.lit(None).cast("string"))

    out = out.withColumn("kinds", F.transform("found", kind_of))
    out = out.withColumn("forms", F.transform(F.arrays_zip("found", "kinds"), lambda z: _form_of(z["found"], z["kinds"])))
    moved = F.transform("forms", lambda f: F.when(f.isNotNull(), feistel(f["places"]["place"], f["places"]["base"], f["tweak"], key)))
    out = out.withColumn("moved", moved)
    cells = F.arrays_zip("found", "kinds", "forms", "moved")
    out = out.withColumn("made", F.transform(cells, lambda z: _text_of(z["found"], z["kinds"], z["forms"], z["moved"])))
    gaps = F.split("text", ANY, -1)
    parts = F.transform(F.arrays_zip(gaps.alias("gap"), F.col("found"), F.col("made")), lambda z: F.concat(z["gap"], F.coalesce(z["made"], z["found"], F.lit(""))))
    told = F.arrays_zip("kinds", "made")

    def count(kind: str) -> Column:
        return F.size(F.filter(told, lambda z: (z["kinds"] == kind) & z["made"].isNotNull())).cast("long").alias(f"n_{kind}")

    counts = [count(k) for k in PATTERNS]
    total = F.size(F.filter("made", lambda m: m.isNotNull())).cast("long").alias("n_found")
    return out.select("doc_id", total, *counts, F.when(F.size("found") > 0, F.array_join(parts, "")).otherwise(text).alias("text"))


def _alone(pattern: str) -> str:
    """A pattern without what must stand before and behind."""
    for sign in ("(?<!", "(?<="):
        if pattern.startswith(sign):
            pattern = pattern[_closing(pattern, 0) + 1 :]
    for sign in ("(?!", "(?="):
        at = pattern.rfind(sign)
        if at > 0 and _closing(pattern, at) == len(pattern) - 1:
            pattern = pattern[:at]
    return pattern


def _closing(pattern: str, at: int) -> int:
    """Where the bracket that opens at ``at`` closes; brackets in classes and escapes do not count."""
    depth, i, inside = 0, at, False
    while True:
        c = pattern[i]
        if c == "\\":
            i += 1
        elif inside:
            inside = c != "]"
        elif c == "[":
            inside = True
        elif c in "()":
            depth += 1 if c == "(" else -1
            if not depth:
                return i
        i += 1


ALONE = {k: _alone(p) for k, p in PATTERNS.items()}
