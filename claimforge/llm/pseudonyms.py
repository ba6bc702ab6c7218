"""Format-preserving pseudonyms for personal data inside texts.

Personal values are found by pattern and validated (check digits, calendar, ranges). A
validated value is a sequence of places, each with its own number of possible values:
ten for a digit, 26 for a letter, 156 for a three-digit octet, and so on. A keyed
Feistel network over these places permutes all values of one format: its rounds add a
keyed digest of one half to the other half, place by place, modulo the place's size. So
equal values get equal pseudonyms in every document, different values of a format get
different ones, lengths and punctuation stay, and check digits are valid again. Who has
the key can invert it.

Everything is a SQL expression: no Python worker sees a text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimforge.llm.shared import let, table

ROUNDS = 8
KEY = "example-key"
FIRST_DAY, DAYS = "1900-01-01", 73_045  # 7 * 10,435 days, to the end of 2099

# Names of secrets that an assignment may follow.
SECRETS = r"(?:password|passwd|pwd|passphrase|secret|token|api[_-]?key|access[_-]?key|auth)"
# Lengths of account numbers in the IBAN registry, and in the list of countries that use
# the format without being in it.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "AO CV GW LY MZ PT ST", 26: "DZ IR IS TR", 27: "BI CF CG CM DJ FR GA GQ GR IT KM MC MG MR SM TD",
    28: "AL AZ BF BJ BY CI CY DO GT HN HU LB MA ML NE NI PL SN SV TG", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
    31: "MT SC", 32: "LC", 33: "RU",
}


def _iban_of(length: int, countries: str) -> str:
    """Numbers of that length, in groups of four or without spaces."""
    groups, rest = divmod(length - 4, 4)
    tail = rf" ?[A-Z0-9]{{{rest}}}" if rest else ""
    return rf"(?:{countries.replace(' ', '|')})[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{{groups}}}{tail}(?![A-Za-z0-9])"


KNOWN_IBAN = f"(?:{'|'.join(_iban_of(length, countries) for length, countries in IBAN_LENGTHS.items())})"
# Patterns of one kind each, tried in this order at every place of a text. All repetitions
# are bounded or possessive, so the search is linear in the text.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@(?:[A-Za-z0-9-]{1,63}+\.){1,8}[A-Za-z]{2,24}(?![A-Za-z0-9])",
    "secret": rf"(?<![A-Za-z])(?i:{SECRETS})[ \t]{{0,3}}[=:][ \t]{{0,3}}[\"']?[A-Za-z0-9_+/=-]{{8,}}+[\"']?",
    "key": r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[0-9A-Z]{16}(?![A-Za-z0-9])",
    "ip": r"(?<![\w.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9])(?!\.[0-9])",
    # North American numbers, other area codes in brackets, then up to the 15 digits of
    # E.164 in groups of any size: a number ends where a group does.
    "phone": r"(?<![\w+])(?:\+1[ .-]?)?\([0-9]{3}\)[ .-]?[0-9]{3}[ .-]?[0-9]{4}(?![0-9])"
    r"|(?<![\w+])(?:\+[0-9]{1,3}[ .-]?)?\([0-9]{1,5}\)(?:[ .-]?[0-9]){6,12}(?![0-9])"
    r"|(?<![\w+])\+[0-9](?:[ .-]?[0-9]){8,14}(?![0-9])"
    r"|(?<![\w+])\+[0-9]{1,3}(?=[ .-])(?:[ .-]?[0-9]){6,13}(?![0-9])"
    r"|(?<![\w+])\+[0-9]{1,3}(?:[ .-][0-9]{2,8}){1,4}(?![0-9])"
    r"|(?<![\w.-])[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}(?![0-9-])",
    "card": r"(?<![0-9])(?:[0-9]{4}-[0-9]{4}-[0-9]{4}-[0-9]{4}|[0-9]{4} [0-9]{4} [0-9]{4} [0-9]{4}"
    r"|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5}|[0-9]{13,19})(?![0-9])",
    "ssn": r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])",
    "date": r"(?<![\w/.-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{2}\.[0-9]{2}\.[0-9]{4})(?![\w/-])",
    # A number of a known country has its length; any other takes no group that begins one.
    "iban": rf"(?<![A-Za-z0-9])(?=[A-Z]{{2}}[0-9]{{2}})(?:{KNOWN_IBAN}"
    rf"|[A-Z]{{2}}[0-9]{{2}}(?:(?! {KNOWN_IBAN}) ?[A-Z0-9]{{4}}){{2,7}}(?: ?[A-Z0-9]{{1,3}})?(?![A-Za-z0-9]))",
}
PATTERN = "|".join(f"(?:{pattern})" for pattern in PATTERNS.values())
# No text without one of these has a match.
POSSIBLE = r"[0-9@=:]"


def luhn_sum(digits: Column) -> Column:
    """Weighted digit sum of an array of digits; valid numbers have a multiple of ten."""
    n = F.size(digits)
    doubled = F.transform(
        digits, lambda d, i: F.when((n - i) % 2 == 0, 2 * d - F.when(d > 4, 9).otherwise(0)).otherwise(d)
    )
    return F.aggregate(doubled, F.lit(0), lambda total, d: total + d)


def digits_of(value: Column) -> Column:
    """The digits of a text as numbers."""
    plain = F.regexp_replace(value, "[^0-9]", "")
    return F.transform(F.sequence(F.lit(1), F.length(plain)), lambda i: F.substring(plain, i, F.lit(1)).cast("int"))


def remainder_97(value: Column) -> Column:
    """ISO 7064: letters count from 10, the whole modulo 97."""
    plain = F.regexp_replace(value, " ", "")

    def add(total: Column, i: Column) -> Column:
        place = F.ascii(F.substring(plain, i, F.lit(1)))
        digit = F.when(place < 58, place - 48).otherwise(place - 55)
        return (total * F.when(digit < 10, 10).otherwise(100) + digit) % 97

    return F.aggregate(F.sequence(F.lit(1), F.length(plain)), F.lit(0), add)


def iban_number(value: Column) -> Column:
    """Account part before country and check digits, as the check wants it."""
    plain = F.regexp_replace(value, " ", "")
    return F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, 1, 4))


def day_number(value: Column) -> Column:
    """Days since FIRST_DAY of a calendar date, day before month where both are possible."""
    slashed = F.regexp_replace(value, r"[.]", "/")
    date = F.coalesce(
        F.try_to_date(value, "yyyy-MM-dd"), F.try_to_date(slashed, "dd/MM/yyyy"), F.try_to_date(slashed, "MM/dd/yyyy")
    )
    return F.datediff(date, F.lit(FIRST_DAY).cast("date"))


def kind_of(match: Column) -> Column:
    """The kind of a matched text whose value is valid, null otherwise."""
    valid = {
        "secret": match.rlike("^[^=:]*[=:][^0-9]*[0-9]"),
        "ip": F.forall(F.split(match, r"\."), lambda octet: (octet.cast("int") <= 255) & ~octet.rlike("^0[0-9]")),
        "card": F.pmod(luhn_sum(digits_of(match)), F.lit(10)) == 0,
        "ssn": ~match.rlike("^(?:000|666|9)") & ~match.rlike("-00-|-0000$"),
        "date": (day_number(match) >= 0) & (day_number(match) < DAYS),
        "iban": remainder_97(iban_number(match)) == 1,
    }
    found = None
    for kind, pattern in PATTERNS.items():
        this = match.rlike(f"^(?:{pattern})$") & F.coalesce(valid.get(kind, F.lit(True)), F.lit(False))
        found = F.when(this, F.lit(kind)) if found is None else found.when(this, F.lit(kind))
    return found


def _span(match: Column, kind: Column) -> tuple[Column, Column]:
    """First place that is permuted, and the first behind the last."""
    head = F.regexp_extract(match, rf"^(?i:{SECRETS})[ \t]*[=:][ \t]*[\"']?", 0)
    code = F.regexp_extract(match, r"^\+[0-9]{1,3}(?=[ .(-])|^\+[0-9]", 0)
    first = (
        F.when(kind == "secret", F.length(head))
        .when(kind == "phone", F.length(code))
        .when(kind.isin("key", "iban"), F.lit(4))
        .otherwise(F.lit(0))
    )
    size = F.length(match)
    behind = (
        F.when(kind == "email", size - F.instr(F.reverse(match), "."))
        .when(kind == "card", size - 1)
        .otherwise(size)
    )
    return first, behind


def places(match: Column, kind: Column) -> Column:
    """The value as an array of ``value, radix, base``; a radix of 1 is a fixed place."""
    first, behind = _span(match, kind)
    # Lower-case hexadecimal secrets stay hexadecimal.
    letters = F.when(
        (kind == "secret") & match.rlike("^[^=:]*[=:][ \t\"']*[0-9a-f]+[\"']?$"), F.lit(6)
    ).otherwise(F.lit(26))
    frame = F.struct(first.alias("first"), behind.alias("behind"), letters.alias("letters"))

    def chars(frame: Column) -> Column:
        # All matches are ASCII; one split, as a place is not found in a long text at once.
        return F.transform(F.split(match, ""), lambda c, i: char(F.ascii(c), i, frame))

    def char(code: Column, i: Column, frame: Column) -> Column:
        inside = (i >= frame["first"]) & (i < frame["behind"])
        base = F.when((code >= 48) & (code <= 57), 48).when((code >= 97) & (code <= 122), 97).when(
            (code >= 65) & (code <= 90), 65
        )
        radix = F.when(base == 48, F.lit(10)).when(base == 97, frame["letters"]).otherwise(F.lit(26))
        open_ = inside & base.isNotNull()
        return F.struct(
            F.when(open_, code - base).otherwise(0).alias("value"),
            F.when(open_, radix).otherwise(1).alias("radix"),
            F.when(open_, base).otherwise(code).alias("base"),
        )

    def octet(text: Column) -> Column:
        low = F.when(F.length(text) == 1, 0).when(F.length(text) == 2, 10).otherwise(100)
        radix = F.when(F.length(text) == 1, 10).when(F.length(text) == 2, 90).otherwise(156)
        return F.struct((text.cast("int") - low).alias("value"), radix.alias("radix"), low.alias("base"))

    day = day_number(match)
    week = F.array(
        F.struct(F.floor(day / 7).cast("int").alias("value"), F.lit(DAYS // 7).alias("radix"), F.lit(0).alias("base")),
        F.struct((day % 7).alias("value"), F.lit(7).alias("radix"), F.lit(0).alias("base")),
    )
    return (
        F.when(kind == "ip", F.transform(F.split(match, r"\."), octet))
        .when(kind == "date", week)
        .otherwise(let(frame, chars))
    )


def feistel(values: Column, radices: Column, secret: Column, rounds: int = ROUNDS) -> Column:
    """Permuted ``values``, each below its radix; ``secret`` is the key and the format's name."""

    def run(radices: Column) -> Column:
        half = F.floor(F.size(radices) / 2).cast("int")

        def one(state: Column, number: Column) -> Column:
            kept = F.when(number % 2 == 0, F.slice(state, half + 1, F.size(state))).otherwise(F.slice(state, 1, half))
            text = F.array_join(kept.cast("array<string>"), ",")
            parts = (secret, number.cast("string"), F.size(state).cast("string"), text)
            return let(F.sha2(F.concat_ws("|", *parts), 256), lambda digest: turned(state, number, digest))

        def turned(state: Column, number: Column, digest: Column) -> Column:
            def place(x: Column, i: Column) -> Column:
                radix = F.get(radices, i)
                more = F.pmod(F.xxhash64(digest, i), radix.cast("long")).cast("int")
                return F.when((i < half) == (number % 2 == 0), F.pmod(x + more, radix)).otherwise(x)

            return F.transform(state, place)

        return F.aggregate(F.sequence(F.lit(0), F.lit(rounds - 1)), values, one)

    return let(radices, run)


def respelled(match: Column, kind: Column, all_places: Column, found: Column) -> Column:
    """A match with the permuted values of its free places, and new check digits."""

    def at(i: Column) -> Column:
        return F.get(all_places, i)

    def coded(i: Column, code: Column) -> Column:
        return F.struct(i.alias("at"), code.alias("code"))

    # The n-th free place takes the n-th permuted value; sorted back between the fixed ones.
    order = F.sequence(F.lit(0), F.size(all_places) - 1)
    free = F.zip_with(
        F.filter(order, lambda i: at(i)["radix"] > 1), found, lambda i, value: coded(i, at(i)["base"] + value)
    )
    fixed = F.transform(F.filter(order, lambda i: at(i)["radix"] == 1), lambda i: coded(i, at(i)["base"]))
    chars = F.array_join(F.transform(F.sort_array(F.concat(free, fixed)), lambda x: F.char(x["code"])), "")
    octets = F.array_join(
        F.transform(all_places, lambda x, i: (x["base"] + F.get(found, i)).cast("string")), "."
    )
    day = F.date_add(F.lit(FIRST_DAY).cast("date"), F.get(found, F.lit(0)) * 7 + F.get(found, F.lit(1)))
    shown = (
        F.when(match.contains("-"), F.date_format(day, "yyyy-MM-dd"))
        .when(match.contains("/"), F.date_format(day, "dd/MM/yyyy"))
        .otherwise(F.date_format(day, "dd.MM.yyyy"))
    )
    return F.when(kind == "ip", octets).when(kind == "date", shown).otherwise(chars)


def _with_check_digit(number: Column) -> Column:
    body = F.substring(number, F.lit(1), F.length(number) - 1)
    total = luhn_sum(digits_of(F.concat(body, F.lit("0"))))
    return F.concat(body, F.pmod(10 - total % 10, F.lit(10)).cast("string"))


def _with_check_number(number: Column) -> Column:
    unset = F.concat(F.substring(number, 1, 2), F.lit("00"), F.substring(number, F.lit(5), F.length(number)))
    check = F.lpad((98 - remainder_97(iban_number(unset))).cast("string"), 2, "0")
    return F.concat(F.substring(number, 1, 2), check, F.substring(number, F.lit(5), F.length(number)))


def pseudonymize(docs: DataFrame, column: str = "text", key: str = KEY) -> DataFrame:
    """``docs`` with all validated personal values in ``column`` replaced.

    Adds ``pii_found`` (matches of a pattern) and ``pii_changed`` (those that were valid
    and are replaced now). A null text stays null with counts of 0, as does a text
    without a match; invalid look-alikes stay as they are. Lengths do not change. All
    rows and other columns stay; columns with the two names are replaced. The key is
    part of the plan: keep event logs as safe as the key.
    """
    names = [name for name in docs.columns if name.lower() not in {"pii_found", "pii_changed"}]
    given = F.col(f"`{column}`")
    found = F.when(given.rlike(POSSIBLE), F.regexp_extract_all(given, F.lit(PATTERN), F.lit(0)))
    # One array of structs grows field by field; a step's lambda sees its own element only.
    rows = docs.select(F.struct("*").alias("row"), found.alias("pii"))
    text = F.col("row")[column]
    secret = F.lit(key)
    steps = [
        lambda m: {"match": m, "kind": kind_of(m)},
        lambda x: {**_kept(x, "match", "kind"), "places": F.when(x["kind"].isNotNull(), places(x["match"], x["kind"]))},
        lambda x: {**_kept(x, "match", "kind", "places"), "free": F.filter(x["places"], lambda p: p["radix"] > 1)},
        lambda x: {
            **_kept(x, "match", "kind", "places"),
            "found": feistel(x["free"]["value"], x["free"]["radix"], F.concat_ws("|", secret, x["kind"])),
        },
        lambda x: {
            **_kept(x, "match", "kind"),
            "text": F.when(
                x["kind"].isNotNull(), respelled(x["match"], x["kind"], x["places"], x["found"])
            ),
        },
        lambda x: {
            **_kept(x, "kind"),
            "text": F.when(x["kind"].isNull(), x["match"])
            .when(x["kind"] == "card", _with_check_digit(x["text"]))
            .when(x["kind"] == "iban", _with_check_number(x["text"]))
            .otherwise(x["text"]),
        },
    ]
    for step in steps:
        rows = rows.withColumn("pii", F.transform("pii", _struct_of(step)))
    between = F.split(text, PATTERN, -1)
    whole = F.array_join(
        F.zip_with(between, F.col("pii")["text"], lambda part, new: F.concat(part, F.coalesce(new, F.lit("")))), ""
    )
    changed = F.size(F.filter("pii", lambda x: x["kind"].isNotNull()))
    count = F.coalesce(F.size("pii"), F.lit(0))
    return rows.select(
        *[
            (F.when(F.size("pii") > 0, whole).otherwise(text) if name == column else F.col("row")[name]).alias(name)
            for name in names
        ],
        F.greatest(count, F.lit(0)).cast("long").alias("pii_found"),
        F.greatest(changed, F.lit(0)).cast("long").alias("pii_changed"),
    )


def _kept(x: Column, *names: str) -> dict[str, Column]:
    return {name: x[name] for name in names}


def _struct_of(step):
    return lambda x: F.struct(*[value.alias(name) for name, value in step(x).items()])


def op6_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonymize(table(spark, sf_dir, "documents").select("doc_id", "text"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents with pseudonyms in their texts."""
    return pseudonymize(docs).select(*docs.columns)
