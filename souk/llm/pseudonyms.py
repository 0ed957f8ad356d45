"""Format-preserving Feistel pseudonyms of personal numbers and dates (DataFrame functions only).

A text is cut at everything that looks like one of the kinds below.  What
passes its kind's check becomes a vector of numbers with a radix each; a keyed
Feistel network permutes the vectors of that kind, and the result is written
back in the same format.  The network adds, in turns, a keyed hash (SHA-256) of
one half to the other half, number by number modulo the radix, so it is a
permutation of exactly the valid values: equal values stay equal in all
documents, different ones stay different, and who has the key can undo it.

Kinds and checks (fixed values): e-mail addresses (letters and digits of the
local part); IBANs (length, mod 97; check digits made anew); IPv4 addresses
(octets up to 255); dates year-month-day, day/month/year and day.month.year (of
the calendar, years 1000 to 9600; permuted within the 400-year cycle); US social
security numbers (valid areas, groups, serials); phone numbers of North America
(area and exchange from 2) and with a country code (the first three digits
stay); payment cards (13 to 19 digits, Luhn; the first digit stays, the check
digit is made anew).  Separators stay as they are.

A card or IBAN that fails its check may have taken in what follows it: the
longest part up to a separator that passes is the value, and the text behind it
is searched anew.  A number with a country code of PLANS ends where the digits
of that country do.

The key is the caller's: an argument, or the Spark setting ``KEY_CONF``.  There
is none in the source, so nobody who reads it can undo a mapping; without a
setting a session draws one, and what it wrote cannot be undone by another.

Defined cases: a null text stays null with 0 replaced; an empty text and one
without such values stay as they are; what fails its check stays; repeated rows
get equal results; an empty table gives no rows.
"""

from __future__ import annotations

import secrets

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import packed, table

ROUNDS = 8
#: the Spark setting that holds the key; a query without one gets a key of its own, kept by the session
KEY_CONF = "spark.souk.pseudonyms.key"

EMAIL = r"(?<![\w.%+-])[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?(?:\.[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?)+"
IBAN = r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)"
IPV4 = r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?!\w|\.\d)"
DATE = r"(?<![\w/.-])(?:\d{4}-\d{2}-\d{2}|\d{1,2}/\d{1,2}/\d{4}|\d{1,2}\.\d{1,2}\.\d{4})(?!\w|[/.-]\d)"
SSN = r"(?<![\w-])\d{3}-\d{2}-\d{4}(?!\w|-\d)"
PHONE = r"(?<![\w+])(?:\+?1[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?!\w|-\d)"
ABROAD = r"(?<![\w+])\+[1-9]\d{0,2}(?:[ .-]?\(?\d{1,4}\)?){2,6}(?!\w)"
CARD = r"(?<![\w-])\d(?:[ -]?\d){12,18}(?!\w|-\d)"
ANY = "|".join((EMAIL, IBAN, IPV4, DATE, SSN, PHONE, ABROAD, CARD))

#: digits after the country code (ITU-T E.164 numbering plans of one or two lengths); other countries: as many as stand together
PLANS = {"1": (10,), "7": (10,), "31": (9,), "32": (8, 9), "33": (9,), "34": (9,), "41": (9,), "44": (9, 10), "45": (8,), "47": (8,), "48": (9,),
         "52": (10,), "55": (10, 11), "61": (9,), "81": (9, 10), "86": (10, 11), "90": (10,), "91": (10,), "351": (9,), "420": (9,)}
#: written behind a value that ends within a match; the first also stands for itself, with the second behind it
MARK, ITSELF, END = "\ufdd0", "\ufdd1", "\ufdd2"

#: a Gregorian cycle of 400 years has 146,097 = 189 * 773 days
CYCLE, CYCLE_A, CYCLE_B = 146097, 189, 773
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _int(c: Column) -> Column:
    return c.cast("int")


def _let(value: Column, use) -> Column:
    """use(value), with value computed once: it becomes the variable of a lambda."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _is_digit(c: Column) -> Column:
    return c.between("0", "9")


def _chars(s: Column) -> Column:
    return F.filter(F.split(s, ""), lambda c: c != "")


def _keyed(key: str, *parts: Column) -> Column:
    """32 bits of SHA-256 of the key and the parts."""
    return F.conv(F.substring(F.sha2(F.concat_ws("|", F.lit(key), *parts).cast("binary"), 256), 1, 8), 16, 10).cast("long")


def feistel(values: Column, radix: Column, key: str, kind: str, inverse: bool = False, rounds: int = ROUNDS) -> Column:
    """Permutation of arrays ``values`` (each number from 0 below its radix), keyed by key and kind."""
    turns = F.sequence(F.lit(rounds - 1), F.lit(0), F.lit(-1)) if inverse else F.sequence(F.lit(0), F.lit(rounds - 1))

    def turn(state: Column, r: Column) -> Column:
        half = _int(F.floor(F.size(state) / 2))
        first = r % 2 == 0  # in even rounds the second half keys the first
        other = F.when(first, F.slice(state, half + 1, F.size(state))).otherwise(F.slice(state, F.lit(1), half))

        def with_seed(seed: Column) -> Column:
            def step(x: Column, i: Column) -> Column:
                k = _keyed(key, F.lit(kind), r.cast("string"), i.cast("string"), seed)
                m = F.get(radix, i).cast("long")
                return F.when((i < half) == first, _int(F.pmod((x - k) if inverse else (x + k), m))).otherwise(x)
            return F.transform(state, step)

        return _let(F.array_join(F.transform(other, lambda x: x.cast("string")), ","), with_seed)

    return F.aggregate(turns, values, turn)


def _digits(s: Column) -> Column:
    return F.transform(F.filter(F.split(s, ""), _is_digit), lambda c: c.cast("int"))


def _refill(s: Column, digits: Column) -> Column:
    """s with its digits replaced, in order."""
    start = F.struct(F.lit("").alias("t"), F.lit(0).alias("k"))
    put = lambda a, c: F.when(_is_digit(c), F.struct(F.concat(a["t"], F.get(digits, a["k"]).cast("string")).alias("t"), (a["k"] + 1).alias("k"))
                              ).otherwise(F.struct(F.concat(a["t"], c).alias("t"), a["k"].alias("k")))
    return F.aggregate(_chars(s), start, put, lambda a: a["t"])


def _luhn(d: Column) -> Column:
    """Luhn sum of an array of digits, the last one weighing 1."""
    twice = lambda x, i: F.when((F.size(d) - i) % 2 == 0, x * 2 - F.when(x > 4, 9).otherwise(0)).otherwise(x)
    return F.aggregate(F.transform(d, twice), F.lit(0), lambda a, x: a + x)


def _mod97(s: Column) -> Column:
    """The number that letters (A = 10 ...) and digits of s spell, modulo 97."""
    value = lambda c: F.when(_is_digit(c), c.cast("int")).otherwise(F.instr(F.lit(LETTERS), c) + 9)
    return F.aggregate(_chars(s), F.lit(0), lambda a, c: (a * F.when(_is_digit(c), 10).otherwise(100) + value(c)) % 97)


def _permute_chars(chars: Column, key: str, kind: str, inverse: bool) -> Column:
    """Letters among letters of their case, digits among digits, other characters as they are; joined."""
    base = lambda c: F.when(_is_digit(c), 48).when(c.between("a", "z"), 97).when(c.between("A", "Z"), 65).otherwise(F.ascii(c))
    radix = lambda cs: F.transform(cs, lambda c: F.when(_is_digit(c), 10).when(base(c).isin(65, 97) & (c.rlike("^[A-Za-z]$")), 26).otherwise(1))
    new = lambda cs: feistel(F.transform(cs, lambda c: F.ascii(c) - base(c)), radix(cs), key, kind, inverse)
    return _let(chars, lambda cs: _let(new(cs), lambda n: F.array_join(F.zip_with(cs, n, lambda c, x: F.char(base(c) + x)), "")))


def _email(m: Column, key: str, inverse: bool) -> Column:
    at = F.instr(m, "@")
    return F.concat(_permute_chars(_chars(F.substring(m, F.lit(1), at - 1)), key, "email", inverse), F.substring(m, at, F.length(m)))


def _iban(m: Column, key: str, inverse: bool) -> Column:
    def of(plain: Column) -> Column:
        land = F.substring(plain, 1, 2)
        valid = F.length(plain).between(15, 34) & (_mod97(F.concat(F.substring(plain, 5, 40), F.substring(plain, 1, 4))) == 1)

        def rebuilt(body: Column) -> Column:
            check = F.lpad((98 - _mod97(F.concat(body, land, F.lit("00")))).cast("string"), 2, "0")
            return F.concat(land, check, body)

        def spaced(whole: Column) -> Column:  # the spaces go back to where they stood
            start = F.struct(F.lit("").alias("t"), F.lit(1).alias("k"))
            put = lambda a, c: F.when(c == " ", F.struct(F.concat(a["t"], c).alias("t"), a["k"].alias("k"))
                                      ).otherwise(F.struct(F.concat(a["t"], F.substring(whole, a["k"], F.lit(1))).alias("t"), (a["k"] + 1).alias("k")))
            return F.aggregate(_chars(m), start, put, lambda a: a["t"])

        body = _permute_chars(_chars(F.substring(plain, 5, 40)), key, "iban", inverse)
        return F.when(valid, _let(_let(body, rebuilt), spaced))

    return _let(F.translate(m, " ", ""), of)


def _ipv4(m: Column, key: str, inverse: bool) -> Column:
    def of(octets: Column) -> Column:
        new = feistel(octets, F.array(*[F.lit(256)] * 4), key, "ipv4", inverse)
        return F.when(F.forall(octets, lambda x: x < 256) & ~m.rlike(r"(^|\.)0\d"), F.array_join(F.transform(new, lambda x: x.cast("string")), "."))
    return _let(F.transform(F.split(m, r"\."), lambda x: x.cast("int")), of)


def _date(m: Column, key: str, inverse: bool) -> Column:
    iso = F.substring(m, 5, 1) == "-"
    mark = F.when(F.instr(m, "/") > 0, "/").otherwise(".")
    first = F.lit("0001-01-01").cast("date")

    def of(part: Column) -> Column:
        at = lambda i: F.get(part, F.lit(i))
        return F.try_to_date(F.concat_ws("-", F.when(iso, at(0)).otherwise(at(2)), F.lpad(at(1), 2, "0"),
                                         F.lpad(F.when(iso, at(2)).otherwise(at(0)), 2, "0")), "yyyy-MM-dd")

    def moved(days: Column) -> Column:
        rest = F.pmod(days, F.lit(CYCLE))
        new = feistel(F.array(_int(F.floor(rest / CYCLE_B)), _int(rest % CYCLE_B)), F.array(F.lit(CYCLE_A), F.lit(CYCLE_B)), key, "date", inverse)
        start = F.floor(days / CYCLE) * CYCLE
        return _let(new, lambda n: F.date_format(F.date_add(first, _int(start + F.get(n, F.lit(0)) * CYCLE_B + F.get(n, F.lit(1)))), "yyyy-MM-dd"))

    def written(t: Column) -> Column:
        return F.when(iso, t).otherwise(F.concat(F.substring(t, 9, 2), mark, F.substring(t, 6, 2), mark, F.substring(t, 1, 4)))

    def checked(real: Column) -> Column:
        return F.when(real.isNotNull() & F.year(real).between(1000, 9600), _let(_let(F.datediff(real, first), moved), written))

    return _let(_let(F.split(m, "[-/.]"), of), checked)


def _ssn(m: Column, key: str, inverse: bool) -> Column:
    pad = lambda c, n: F.lpad(c.cast("string"), n, "0")

    def of(p: Column) -> Column:
        area, group, serial = (F.get(p, F.lit(i)) for i in range(3))
        valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
        new = feistel(F.array(area - F.when(area > 666, 2).otherwise(1), group - 1, serial - 1), F.array(F.lit(898), F.lit(99), F.lit(9999)), key, "ssn", inverse)
        back = lambda n: F.concat_ws("-", pad(F.get(n, F.lit(0)) + F.when(F.get(n, F.lit(0)) >= 665, 2).otherwise(1), 3),
                                     pad(F.get(n, F.lit(1)) + 1, 2), pad(F.get(n, F.lit(2)) + 1, 4))
        return F.when(valid, _let(new, back))

    return _let(F.transform(F.split(m, "-"), lambda x: x.cast("int")), of)


def _phone(m: Column, key: str, inverse: bool) -> Column:
    """North America: ten digits, area and exchange from 2."""
    low = F.array(*[F.lit(2 if i in (0, 3) else 0) for i in range(10)])

    def of(every: Column) -> Column:
        n = F.size(every)
        d = F.slice(every, n - 9, F.lit(10))
        new = feistel(F.zip_with(d, low, lambda x, b: x - b), F.array(*[F.lit(8 if i in (0, 3) else 10) for i in range(10)]), key, "phone", inverse)
        new = F.concat(F.slice(every, F.lit(1), n - 10), F.zip_with(new, low, lambda x, b: x + b))
        valid = n.between(10, 11) & (F.get(every, n - 10) > 1) & (F.get(every, n - 7) > 1)
        return F.when(valid, _let(new, lambda x: _refill(m, x)))

    return _let(_digits(m), of)


def _abroad(m: Column, key: str, inverse: bool) -> Column:
    def of(d: Column) -> Column:
        new = _let(F.slice(d, F.lit(4), F.size(d)), lambda r: feistel(r, F.transform(r, lambda _: F.lit(10)), key, "abroad", inverse))
        return F.when(F.size(d).between(8, 15), _let(F.concat(F.slice(d, 1, 3), new), lambda x: _refill(m, x)))
    return _let(_digits(m), of)


def _card(m: Column, key: str, inverse: bool) -> Column:
    def of(d: Column) -> Column:
        new = _let(F.slice(d, F.lit(2), F.size(d) - 2), lambda r: feistel(r, F.transform(r, lambda _: F.lit(10)), key, "card", inverse))
        check = lambda n: F.concat(n, F.array((10 - _luhn(F.concat(n, F.array(F.lit(0)))) % 10) % 10))
        whole = _let(F.concat(F.slice(d, 1, 1), new), check)
        return F.when(F.size(d).between(13, 19) & (_luhn(d) % 10 == 0), _let(whole, lambda x: _refill(m, x)))
    return _let(_digits(m), of)


def session_key(spark) -> str:
    """The key named by KEY_CONF; where none is set, a random one that the session keeps (equal values stay linked within it)."""
    key = spark.conf.get(KEY_CONF, None)
    if not key:
        key = secrets.token_hex(32)
        spark.conf.set(KEY_CONF, key)
    return key


def pseudonym(m: Column, key: str, inverse: bool = False) -> Column:
    """The pseudonym of one found value; null where it fails its kind's check."""
    whole = lambda p: m.rlike(f"^(?:{p})$")
    return (F.when(F.instr(m, "@") > 0, _email(m, key, inverse))
            .when(whole(IPV4), _ipv4(m, key, inverse))
            .when(whole(DATE), _date(m, key, inverse))
            .when(whole(SSN), _ssn(m, key, inverse))
            .when(m.rlike("^[A-Z]"), _iban(m, key, inverse))
            .otherwise(F.coalesce(F.when(whole(PHONE), _phone(m, key, inverse)), F.when(m.startswith("+"), _abroad(m, key, inverse)),
                                  F.when(~m.startswith("+"), _card(m, key, inverse)))))


def _value_end(m: Column) -> Column:
    """Where the value in a match ends if something else follows it within the match, else 0."""
    apart = lambda k: F.substring(m, k + 1, F.lit(1)).rlike("[ .-]") & ~F.substring(m, k, F.lit(1)).rlike("[ .-]")
    ends = F.filter(F.sequence(F.length(m), F.lit(1), F.lit(-1)), lambda k: (k == F.length(m)) | apart(k))
    to = lambda k: F.substring(m, F.lit(1), k)
    longest = lambda good: F.coalesce(F.get(F.filter(ends, good), F.lit(0)), F.lit(0))
    card = lambda k: _let(_digits(to(k)), lambda d: F.size(d).between(13, 19) & (_luhn(d) % 10 == 0))
    iban = lambda k: _let(F.translate(to(k), " ", ""), lambda s: F.length(s).between(15, 34)
                          & (_mod97(F.concat(F.substring(s, 5, 40), F.substring(s, 1, 4))) == 1))
    plans = "|".join(f"{c}(?:{'|'.join(f'[0-9]{{{n}}}' for n in ns)})" for c, ns in PLANS.items())
    phone = lambda k: F.regexp_replace(to(k), "[^0-9]", "").rlike(f"^(?:{plans})$")
    # a 0 in brackets is dialled at home only: it is no digit of the plan, so the match stays whole
    end = (F.when(m.startswith("+"), F.when(m.contains("(0)"), 0).otherwise(longest(phone)))
           .when(m.contains("@") | m.rlike(f"^(?:{IPV4}|{DATE}|{SSN}|{PHONE})$"), 0)
           .when(m.rlike("^[A-Z]"), longest(iban)).when(m.rlike("^[0-9]"), longest(card)).otherwise(0))
    return _let(end, lambda k: F.when(k < F.length(m), k).otherwise(0))


def _marked(text: Column) -> Column:
    """text with a mark behind every value that ends within a match."""
    def put(found):
        cut = F.transform(found, lambda m: _let(_value_end(m), lambda k: F.when(k > 0, F.concat(F.substring(m, F.lit(1), k), F.lit(MARK + END), F.substring(m, k + 1, F.length(m)))).otherwise(m)))
        return _let(cut, lambda c: F.array_join(F.transform(F.split(text, ANY, -1), lambda g, i: F.concat(g, F.coalesce(F.get(c, i), F.lit("")))), ""))
    return _let(F.regexp_extract_all(text, F.lit(ANY), F.lit(0)), put)


def pseudonymise(docs: DataFrame, key: str | None = None, inverse: bool = False, text_col: str = "text") -> DataFrame:
    """key: the caller's secret, or the session's (``session_key``).  Returns row (the whole row as a struct), masked (the text with pseudonyms), replaced (how many values)."""
    key = key or session_key(docs.sparkSession)
    rows = docs.select(packed(docs, "row"))
    text = F.col(f"row.`{text_col}`")
    # most texts hold nothing of the kind: one plain search decides
    rows = rows.withColumn("_found", F.when(text.rlike("[0-9@]"), F.regexp_extract_all(text, F.lit(ANY), F.lit(0))))
    rows = rows.withColumn("_over", F.coalesce(F.exists("_found", lambda m: _value_end(m) > 0), F.lit(False)))
    # what follows a value is searched anew, and may hold one that ends within a match: at most a round for each separator
    rounds = F.sequence(F.lit(0), F.size(F.regexp_extract_all(text, F.lit("[0-9A-Z)][ .-]"), F.lit(0))))
    start = F.struct(F.replace(text, F.lit(MARK), F.lit(MARK + ITSELF)).alias("t"), F.lit(False).alias("done"))

    def step(a, _):
        return F.when(a["done"], a).otherwise(_let(_marked(a["t"]), lambda t: F.struct(t.alias("t"), (t == a["t"]).alias("done"))))

    rows = rows.withColumn("_text", F.when(F.col("_over"), F.aggregate(rounds, start, step, lambda a: a["t"])).otherwise(text))
    rows = rows.withColumn("_found", F.when(F.col("_over"), F.regexp_extract_all("_text", F.lit(ANY), F.lit(0))).otherwise(F.col("_found")))
    rows = rows.withColumn("_new", F.transform("_found", lambda m: pseudonym(m, key, inverse)))
    gaps = F.split("_text", ANY, -1)
    put = lambda g, i: F.concat(g, F.coalesce(F.get("_new", i), F.get("_found", i), F.lit("")))
    masked = F.when(F.size("_found") > 0, F.array_join(F.transform(gaps, put), "")).otherwise(text)
    masked = F.when(F.col("_over"), F.replace(F.replace(masked, F.lit(MARK + END), F.lit("")), F.lit(MARK + ITSELF), F.lit(MARK))).otherwise(masked)
    return rows.select("row", masked.alias("masked"), F.coalesce(F.size(F.filter("_new", lambda x: x.isNotNull())), F.lit(0)).alias("replaced"))


def op7(spark, sf_dir: str) -> DataFrame:
    """Every document with its personal numbers and dates under format-preserving pseudonyms."""
    out = pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select(F.col("row.doc_id").alias("doc_id"), F.col("masked").alias("text"), F.greatest("replaced", F.lit(0)).alias("replaced"))
