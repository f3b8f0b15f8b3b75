"""Personal data: detected entities get keyed surrogates of the same kind, in DataFrame functions only.

Detected: e-mail addresses, phone numbers (international ones with + or 00 in
any grouping; national ones in American, French, Spanish and German or British
grouping, with blanks, dots or hyphens), IPv4 addresses, card numbers, IBANs,
account numbers of 6 to 12 digits after a word for account, social security
numbers, access tokens, and names after a title. National phone numbers
written as one run of digits are not told from other numbers. A
surrogate is drawn from a hash of the secret key, the kind and the entity's
canonical form (digits of a number, lower-cased address, IBAN or name), so the same
entity has the same surrogate everywhere, whatever its spelling; it keeps the
format character by character (digits, letters of the script, case,
punctuation), the country code, the top-level domain, whether a card number
or IBAN passes its checksum, and a name's title, gender and script. A name's parts are
mapped one by one, so "Mr Smith" and "Mr John Smith" still share a name.

Collision check: over the distinct entities of the whole corpus, surrogates
that two entities share, or that are an entity of the corpus themselves, are
drawn anew with the next attempt number until there are none; so are those in
which a given name or the local part of an address stayed as it was. Given
names alone may be another's of the corpus, as they are drawn from a list of
common ones. Where LATE attempts were in vain (few addresses of one letter
are free, say), addresses, account, telephone and social security numbers get longer. Only entities
drawn anew go into a table that is joined back; all others need no lookup.

Results for odd input: null texts stay null, texts without entities stay as
they are (byte for byte); repeated rows get the same text; other columns are
passed through; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch

# Titles and the gender they tell (m, f), given names by gender, all in Latin script, then in Cyrillic.
TITLES = {"Mr": "m", "Sir": "m", "Herr": "m", "Monsieur": "m", "Señor": "m", "Mrs": "f", "Ms": "f", "Miss": "f", "Madam": "f", "Frau": "f", "Madame": "f", "Señora": "f",
          "Господин": "m", "Госпожа": "f"}
GIVEN = {("m", "latin"): ("Adam", "Bruno", "Carl", "Daniel", "Emil", "Felix", "Hugo", "Ivan", "Jonas", "Leo", "Marco", "Noel", "Oscar", "Paul", "Simon", "Victor"),
         ("f", "latin"): ("Anna", "Bella", "Clara", "Diana", "Emma", "Flora", "Gina", "Helena", "Irene", "Julia", "Laura", "Maria", "Nora", "Olga", "Sara", "Vera"),
         ("m", "cyrillic"): ("Алексей", "Борис", "Виктор", "Глеб", "Денис", "Егор", "Иван", "Кирилл", "Лев", "Максим", "Никита", "Олег", "Павел", "Роман", "Степан", "Юрий"),
         ("f", "cyrillic"): ("Алла", "Вера", "Галина", "Дарья", "Елена", "Жанна", "Зоя", "Инна", "Лидия", "Мария", "Нина", "Ольга", "Полина", "Раиса", "София", "Юлия")}
SYLLABLES = {"latin": ("ba", "be", "bo", "da", "de", "do", "fa", "ga", "ka", "ko", "la", "le", "lo", "ma", "me", "mo", "na", "ne", "no", "ra", "re", "ro", "sa", "so", "ta", "te", "to", "va", "ve", "vo", "wa", "za"),
             "cyrillic": ("ба", "бе", "бо", "ва", "ве", "во", "га", "го", "да", "де", "до", "жа", "за", "зо", "ка", "ко", "ла", "ле", "ло", "ма", "ме", "мо", "на", "не", "но", "ра", "ре", "ро", "са", "со", "та", "то")}

# IBAN lengths by country, and telephone country codes of one and two digits (all others have three).
IBAN_LENGTHS = {15: "NO", 16: "BE", 18: "DK FI FO GL NL", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA",
                23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM",
                28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}
#: the attempt from which on short entities get longer
LATE = 6
COUNTRY = r"^(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})"


def _run(first: str, n: int, step: int = 1) -> str:
    return "".join(chr(ord(first) + step * i) for i in range(n))


#: Letters of the scripts that _letters does not count off: what tells them, and what is drawn instead.
OTHER_SCRIPTS = (
    (r"(?=\p{IsGreek})\p{Lu}", "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ"), (r"\p{IsGreek}", "αβγδεζηθικλμνξοπρστυφχψω"),
    (r"(?=\p{IsCyrillic})\p{Lu}", _run("А", 32)), (r"\p{IsCyrillic}", _run("а", 32)),
    (r"\p{IsHan}", _run("一", 256)), (r"\p{IsHiragana}", _run("か", 40)), (r"\p{IsKatakana}", _run("カ", 40)), (r"\p{IsHangul}", _run("가", 399, 28)),
    (r"\p{IsArabic}", _run("ب", 19)), (r"\p{IsHebrew}", _run("א", 27)), (r"\p{IsDevanagari}", _run("क", 32)), (r"\p{IsThai}", _run("ก", 46)),
    (r"(?=\p{IsArmenian})\p{Lu}", _run("Ա", 38)), (r"\p{IsArmenian}", _run("ա", 38)), (r"\p{IsGeorgian}", _run("ა", 33)),
    (r"\p{Lu}", _run("A", 26)), (r"\p{N}", _run("0", 10)))


def _iban_pattern() -> str:
    """Whole IBANs of their country's length, in one run or in groups of four."""
    def of(n: int, countries: str) -> str:
        groups, rest = divmod(n - 4, 4)
        tail = rf"[ -][0-9A-Z]{{{rest}}}" if rest else ""
        return rf"(?:{'|'.join(countries.split())})\d{{2}}(?:[0-9A-Z]{{{n - 4}}}|(?:[ -][0-9A-Z]{{4}}){{{groups}}}{tail})"
    return r"(?<![0-9A-Za-z])(?=[A-Za-z]{2}\d{2})(?i:" + "|".join(of(n, c) for n, c in IBAN_LENGTHS.items()) + r")(?![0-9A-Za-z])"


def _phone_pattern() -> str:
    # at least eight digits; a group after a separator has two digits or more, but the first may have one
    forms = [r"(?:\+|00(?=[1-9]))(?=(?:[ ./()-]{0,2}\d){8})[1-9]\d{0,2}(?:[ ./-]?\(\d{1,4}\))?(?:[ ./-]\d(?!\d))?(?:\d|[ ./-]\d(?=\d)){5,13}",
             r"\+\d{1,3}[ .-]?(?:\(\d{2,4}\)|\d{2,4})[ .-]?\d{3,4}[ .-]\d{3,4}", r"(?:1[ .-]?)?\(\d{2,4}\)[ .-]?\d{3,4}[ .-]\d{3,4}"]
    for s in (" ", r"\.", "-"):
        forms += [rf"(?:1{s})?\d{{3}}{s}\d{{3}}{s}\d{{4}}", rf"0\d(?:{s}\d{{2}}){{4}}", rf"[6-9]\d{{2}}(?:{s}\d{{2}}){{3}}", rf"[89]\d{s}\d{{3}}(?:{s}\d{{2}}){{2}}"]
    forms += [r"(?<!\d[ .,-])[6-9]\d{2}(?: \d{3}){2}(?![ .,-]?\d)", *[r"(?<!\d[.,/-])(?=(?:[ /()-]{0,3}\d){9})\(?0\d{1,4}\)?(?: ?[ /-] ?)" + own for own in (r"\d{3,4}[ -]\d{2,5}(?:[ -]\d{2,4})?", r"\d{5,9}")]]
    return r"(?<![0-9A-Za-z])(?:" + "|".join(f + r"(?!\d)" for f in forms) + ")"


_ACCOUNT = r"(?:account|acct|konto|kontonummer|kontonr|kto|compte|cuenta)\.?(?: (?:number|no|nr|nummer|num|número|numéro|n°|nº)\.?)?[:#]? ?#?"
_EDGE = r"(?<![\p{L}\p{M}\p{N}._%+-])"
PATTERNS = {
    "email": _EDGE + r"[\p{L}\p{M}\p{N}._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "token": r"(?<![0-9A-Za-z])(?:[0-9a-f]{32,128}|[0-9A-F]{32,128}|AKIA[0-9A-Z]{16}|gh[pousr]_[0-9A-Za-z]{36})(?![0-9A-Za-z])",
    "iban": _iban_pattern(),
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "ip": r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\d|\.\d)",
    "card": r"(?<![0-9A-Za-z])(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3}|3\d{3}[ -]\d{6}[ -]\d{4,5})(?![0-9A-Za-z])",
    "account": r"(?<![0-9A-Za-z])(?=\d{6,12}(?![0-9A-Za-z]))(?<=(?iu:" + _ACCOUNT + r"))\d{6,12}",
    "phone": _phone_pattern(),
    "name": r"(?<![\p{L}])(?:" + "|".join(TITLES) + r")\.? \p{Lu}\p{Ll}+(?:[ -]\p{Lu}\p{Ll}+)?(?!\p{L})",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())


def _kind(m: Column) -> Column:
    """The kind of a match, told from its own characters."""
    digits = F.length(F.regexp_replace(m, r"\D", ""))
    return (F.when(m.contains("@"), "email").when(m.rlike(r"^\p{L}+\.? \p{Lu}"), "name").when(m.rlike(r"^\d+\.\d+\.\d+\.\d+$"), "ip")
            .when(m.rlike(r"^\d{3}-\d{2}-\d{4}$"), "ssn").when(m.rlike(r"^(\d{13,19}|\d{4}([ -]\d{4}){3}|3\d{3}[ -]\d{6}[ -]\d{4,5})$"), "card")
            .when(m.rlike(r"^[A-Za-z]{2}\d{2}") & m.rlike(f"^(?:{PATTERNS['iban']})$"), "iban").when(m.rlike(r"^(?!00[1-9])\d{6,12}$"), "account")
            .when(m.rlike(r"[A-Za-z]") | (digits >= 32), "token").otherwise("phone"))


def _script(m: Column) -> Column:
    return F.when(m.rlike(r"\p{IsCyrillic}"), "cyrillic").otherwise("latin")


def _canon(kind: Column, m: Column) -> Column:
    digits = F.regexp_replace(m, r"\D", "")
    phone = F.when(m.startswith("+"), F.concat(F.lit("+"), digits)).when(m.rlike("^00[1-9]"), F.concat(F.lit("+"), F.substring(digits, F.lit(3), F.length(digits)))).otherwise(digits)
    return (F.when(kind == "phone", phone).when(kind.isin("card", "ssn", "account"), digits)
            .when(kind == "iban", F.lower(F.regexp_replace(m, "[ -]", ""))).otherwise(F.lower(m)))


def _draw(seed: Column, i, n: int) -> Column:
    return F.pmod(F.xxhash64(seed, i if isinstance(i, Column) else F.lit(i)), F.lit(n)).cast("int")


def _pick(values: tuple[str, ...], seed: Column, i) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), _draw(seed, i, len(values)) + 1)


def _chars(m: Column) -> Column:
    return F.split(m, "")


def _letters(c: Column, seed: Column, i: Column, others: bool) -> Column:
    """A letter of the same script and case or a digit; of scripts without a list a Latin letter; anything but letters and numbers as it is."""
    def of(low: str, high: str, base: int, n: int) -> tuple[Column, Column]:
        return c.between(F.lit(low), F.lit(high)), F.char(F.lit(base) + _draw(seed, i, n)) if base < 256 else F.substring(F.lit("".join(chr(base + j) for j in range(n))), _draw(seed, i, n) + 1, F.lit(1))
    out = F.when(c.between("0", "9"), _draw(seed, i, 10).cast("string"))
    for low, high in (("a", "z"), ("A", "Z"), ("а", "я"), ("А", "Я")):
        test, value = of(low, high, ord(low), ord(high) - ord(low) + 1)
        out = out.when(test, value)
    for accented in ("àáâãäçèéêëìíîïñòóôõöùúûüß", "ÀÁÂÃÄÇÈÉÊËÌÍÎÏÑÒÓÔÕÖÙÚÛÜ"):
        out = out.when(F.lit(accented).contains(c) & (c != ""), F.substring(F.lit(accented), _draw(seed, i, len(accented)) + 1, F.lit(1)))
    if not others:
        return out.otherwise(c)
    out = out.when(~c.rlike(r"[\p{L}\p{N}]"), c)
    pick = lambda pool: F.substring(F.lit(pool), _draw(seed, i, len(pool)) + 1, F.lit(1))
    for test, pool in OTHER_SCRIPTS:
        out = out.when(c.rlike(test), pick(pool))
    return out.otherwise(pick("abcdefghijklmnopqrstuvwxyz"))


def _seed(key: str, kind, canon: Column, attempt: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), kind, canon, attempt.cast("string")), 256)


def _same_format(m: Column, seed: Column, others: bool = False) -> Column:
    """others: whether there may be letters outside ASCII, Cyrillic and the accented list."""
    return F.array_join(F.transform(_chars(m), lambda c, i: _letters(c, seed, i, others)), "")


def _digits_only(m: Column, seed: Column, skip: Column, before: Column | None = None) -> Column:
    """Digits redrawn by their number among the digits, from the ``skip``-th on: other spellings get the same digits.

    before: how many of the skipped digits other spellings do not have.
    """
    before = F.lit(0) if before is None else before
    start = F.struct(F.lit("").alias("s"), F.lit(0).alias("i"))
    step = lambda a, c: F.when(c.between("0", "9"), F.struct(
        F.concat(a["s"], F.when(a["i"] < skip, c).otherwise(_draw(seed, a["i"] - before, 10).cast("string"))).alias("s"), (a["i"] + 1).alias("i"))).otherwise(
        F.struct(F.concat(a["s"], c).alias("s"), a["i"].alias("i")))
    return F.aggregate(_chars(m), start, step, lambda a: a["s"])


def _luhn(digits: Column) -> Column:
    """Checksum of a digit string, modulo 10: 0 where it passes."""
    def one(c: Column, i: Column) -> Column:
        d = c.cast("int") * F.when(F.pmod(i, F.lit(2)) == 1, 2).otherwise(1)
        return d - F.when(d > 9, 9).otherwise(0)
    return F.pmod(F.aggregate(F.transform(F.reverse(_chars(digits)), one), F.lit(0), lambda a, x: a + x), F.lit(10))


def _card(m: Column, seed: Column) -> Column:
    drawn = _digits_only(m, seed, F.lit(1))
    body = F.regexp_replace(drawn, r"\D", "")
    without = F.concat(F.substring(body, F.lit(1), F.length(body) - 1), F.lit("0"))
    check = F.pmod(F.lit(10) - _luhn(without), F.lit(10))
    passes = _luhn(F.regexp_replace(m, r"\D", "")) == 0
    last = F.when(passes, check).otherwise(F.pmod(check + 1 + _draw(seed, 99, 9), F.lit(10)))
    return F.concat(F.substring(drawn, F.lit(1), F.length(drawn) - 1), last.cast("string"))


def _mod97(text: Column) -> Column:
    """The number that digits and upper-case letters (A = 10 to Z = 35) spell, modulo 97."""
    step = lambda a, c: F.when(c.between("0", "9"), F.pmod(a * 10 + F.ascii(c) - 48, F.lit(97))).otherwise(F.pmod(a * 100 + F.ascii(c) - 55, F.lit(97)))
    return F.aggregate(_chars(text), F.lit(0), step)


def _iban(m: Column, seed: Column) -> Column:
    plain = F.upper(F.regexp_replace(m, "[ -]", ""))
    country, body = F.substring(plain, 1, 2), F.substring(plain, F.lit(5), F.length(plain))
    drawn = _same_format(body, seed)
    check = F.lit(98) - _mod97(F.concat(drawn, country, F.lit("00")))
    passes = _mod97(F.concat(body, F.substring(plain, 1, 4))) == 1
    given = F.when(passes, check).otherwise(F.pmod(check + 1 + _draw(seed, 99, 96), F.lit(97)))
    new = F.concat(country, F.lpad(given.cast("string"), 2, "0"), drawn)
    start = F.struct(F.lit("").alias("s"), F.lit(1).alias("i"))

    def step(a: Column, c: Column) -> Column:
        own = F.substring(new, a["i"], F.lit(1))
        return F.when(c.isin(" ", "-"), F.struct(F.concat(a["s"], c).alias("s"), a["i"].alias("i"))).otherwise(
            F.struct(F.concat(a["s"], F.when(c.between("a", "z"), F.lower(own)).otherwise(own)).alias("s"), (a["i"] + 1).alias("i")))
    return F.aggregate(_chars(m), start, step, lambda a: a["s"])


def _ip(seed: Column) -> Column:
    return F.concat_ws(".", *[(_draw(seed, i, 254) + 1).cast("string") for i in range(4)])


def _email(m: Column, key: str, seed: Column, attempt: Column) -> Column:
    domain = F.substring_index(m, "@", -1)
    host = F.substring(domain, F.lit(1), F.length(domain) - F.length(F.substring_index(domain, ".", -1)) - 1)
    shared = F.sha2(F.concat_ws("|", F.lit(key), F.lit("host"), F.lower(host)), 256)
    more = F.when(attempt >= LATE, F.concat(*[_pick(SYLLABLES["latin"], seed, 900 + i) for i in range(3)])).otherwise("")
    return F.concat(_same_format(F.substring_index(m, "@", 1), seed, True), more, F.lit("@"), _bound(shared, lambda x: _same_format(host, x)), F.lit("."), F.substring_index(domain, ".", -1))


def _part(gender_kind: Column, canon: Column, seed: Column, attempt: Column) -> Column:
    """A name part: kind "given:m", "given:f" or "surname", in the part's script.

    Syllables are in lower case as they are: lower() of the empty string of attempt 0 would be folded by
    the optimizer, for which the driver loads ICU's tables (2.7 GB of allocations at once).
    """
    cyrillic = canon.rlike(r"\p{IsCyrillic}")

    def by_script(f) -> Column:
        return F.when(cyrillic, f("cyrillic")).otherwise(f("latin"))

    def tail(script: str, n: int, at: int) -> Column:
        return F.concat(*[_pick(SYLLABLES[script], seed, at + i) for i in range(n)])
    more = lambda s: F.when(attempt > 0, tail(s, 3, 20)).otherwise("")
    surname = by_script(lambda s: F.concat(F.initcap(tail(s, 4, 10)), more(s)))
    m, f = (by_script(lambda s, g=g: F.concat(_pick(GIVEN[g, s], seed, 0), more(s))) for g in ("m", "f"))
    return F.when(gender_kind == "given:m", m).when(gender_kind == "given:f", f).otherwise(surname)


def _gender(title: Column) -> Column:
    return F.when(title.isin([t for t, g in TITLES.items() if g == "m"]), "m").otherwise("f")


def _atoms(m: Column) -> Column:
    """The parts of a match that are mapped one by one: (kind, canon, shown)."""
    kind = _kind(m)
    body = F.regexp_replace(m, r"^\p{L}+\.? ", "")
    title = F.regexp_extract(m, r"^(\p{L}+)", 1)
    given, surname = F.regexp_extract(body, r"^(\p{L}+)[ -]", 1), F.regexp_extract(body, r"(\p{L}+)$", 1)
    atom = lambda k, c, s: F.struct(k.alias("kind"), c.alias("canon"), s.alias("shown"))
    two = F.array(atom(F.concat(F.lit("given:"), _gender(title)), F.lower(given), given), atom(F.lit("surname"), F.lower(surname), surname))
    one = F.array(atom(F.lit("surname"), F.lower(surname), surname))
    return F.when(kind == "name", F.when(given != "", two).otherwise(one)).otherwise(F.array(atom(kind, _canon(kind, m), m)))


def _bound(value: Column, f) -> Column:
    """f(value), with the value computed once however often f uses it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def _surrogate(kind: Column, canon: Column, shown: Column, key: str, attempt: Column) -> Column:
    atom = F.struct(kind.alias("kind"), canon.alias("canon"), shown.alias("shown"), attempt.alias("attempt"))
    return _bound(atom, lambda a: _bound(_seed(key, a["kind"], a["canon"], a["attempt"]), lambda seed: _of_seed(a["kind"], a["canon"], a["shown"], key, a["attempt"], seed)))


def _of_seed(kind: Column, canon: Column, shown: Column, key: str, attempt: Column, seed: Column) -> Column:
    before = F.when(shown.rlike("^00[1-9]"), 2).otherwise(0)
    country = F.when(canon.startswith("+"), before + F.length(F.regexp_extract(F.substring(canon, F.lit(2), F.length(canon)), COUNTRY, 0))).otherwise(0)
    more = F.when(attempt >= LATE, F.lpad(_draw(seed, 99, 10000).cast("string"), 4, "0")).otherwise("")
    return (F.when(kind == "email", _email(shown, key, seed, attempt)).when(kind == "ip", _ip(seed)).when(kind == "card", _card(shown, seed))
            .when(kind == "phone", F.concat(_digits_only(shown, seed, country, before), more)).when(kind == "ssn", F.concat(_digits_only(shown, seed, F.lit(0)), more))
            .when(kind == "account", F.concat(_digits_only(shown, seed, F.lit(0)), more))
            .when(kind == "iban", _iban(shown, seed))
            .when(kind == "token", _token(shown, seed)).otherwise(_part(kind, canon, seed, attempt)))


def _token(m: Column, seed: Column) -> Column:
    prefix = F.regexp_extract(m, r"^(AKIA|gh[pousr]_)", 1)
    rest = F.substring(m, F.length(prefix) + 1, F.length(m))
    hexa = rest.rlike(r"^([0-9a-f]+|[0-9A-F]+)$")
    low = F.array_join(F.transform(_chars(rest), lambda c, i: F.lower(F.hex(_draw(seed, i, 16)))), "")
    kept = F.when(rest.rlike(r"[a-f]"), low).otherwise(F.upper(low))
    return F.concat(prefix, F.when(hexa, kept).otherwise(_same_format(rest, seed)))


def assign(atoms: DataFrame, key: str, scratch: Scratch) -> DataFrame:
    """(kind, canon, attempt, surrogate) for every distinct atom: no two of a kind alike, and none an atom itself.

    A given name may be another atom, but never its own; an address has
    another local part than its own, if that has a letter or number at all.
    """
    found = atoms.groupBy("kind", "canon").agg(F.min("shown").alias("shown"))
    now = scratch.keep(_drawn(found.withColumn("attempt", F.lit(0)), key), "assigned")
    while True:
        own = now.groupBy("kind", "same").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("attempt", "canon")).alias("w"))
        own = own.select("kind", "same", "n", F.col("w.canon").alias("winner"))
        real = now.select("kind", F.col("canon").alias("same")).withColumn("real", F.lit(True))
        judged = now.join(own, ["kind", "same"]).join(real, ["kind", "same"], "left")
        clash = (F.col("n") > 1) & (F.col("canon") != F.col("winner")) | (F.coalesce("real", F.lit(False)) & ~F.col("kind").startswith("given:")) | _stayed()
        judged = scratch.keep(judged.withColumn("clash", clash).select("kind", "canon", "shown", "attempt", "surrogate", "same", "clash"), "judged")
        if judged.where("clash").isEmpty():
            scratch.drop(now)
            return judged.drop("clash")
        again = _drawn(judged.where("clash").select("kind", "canon", "shown", (F.col("attempt") + 1).alias("attempt")), key)
        new = scratch.keep(judged.where("not clash").drop("clash").unionByName(again), "assigned")
        scratch.drop(now)
        scratch.drop(judged)
        now = new


def _stayed() -> Column:
    """Whether the surrogate is the atom itself, or an address with its local part."""
    local = F.substring_index("canon", "@", 1)
    address = (F.col("kind") == "email") & (local == F.substring_index("same", "@", 1)) & local.rlike(r"[\p{L}\p{N}]")
    return (F.col("same") == F.col("canon")) | address


def _drawn(atoms: DataFrame, key: str) -> DataFrame:
    out = atoms.withColumn("surrogate", _surrogate(F.col("kind"), F.col("canon"), F.col("shown"), key, F.col("attempt")))
    return out.withColumn("same", _canon(F.col("kind"), F.col("surrogate")))


def pseudonymize(docs: DataFrame, key: str) -> DataFrame:
    """The rows of ``docs`` with text replaced and _entities (in place of a column of that name): the array of (kind, surrogate)
    put in, in order of place."""
    beside = [c for c in docs.columns if c not in ("text", "_entities")]
    done = _replaced(docs.select(F.struct(*[F.col(f"`{c}`") for c in beside]).alias("_row"), "text"), key)
    return done.select(*[F.col("text") if c == "text" else F.col(f"_row.`{c}`") for c in docs.columns if c != "_entities"], "_entities")


def _replaced(docs: DataFrame, key: str) -> DataFrame:
    """``pseudonymize`` of docs(_row, text)."""
    scratch = Scratch(docs.sparkSession, "surrogates")
    text = F.col("text").cast("string")
    columns = docs.columns
    may = text.rlike("[@0-9]")  # what any entity has, names apart: a text without is not searched
    for title in TITLES:
        may = may | text.contains(title)
    matches = F.when(may, F.regexp_extract_all(text, F.lit(ANY), F.lit(0)))
    none = F.coalesce(F.size(matches), F.lit(0)) <= 0
    marked = scratch.keep(docs.where(~none).withColumn("text", text).withColumn("_matches", matches), "marked")
    atoms = marked.select(F.explode(F.flatten(F.transform("_matches", _atoms))).alias("a")).select("a.*")
    assigned = assign(atoms, key, scratch)
    redrawn = assigned.where("attempt > 0").select("kind", "canon", "attempt")
    # of each text that holds an atom drawn anew: which, and its attempt
    texts = marked.select(F.sha2("text", 256).alias("_sha"), F.explode(F.array_distinct(F.flatten(F.transform("_matches", _atoms)))).alias("a"))
    tries = (texts.select("_sha", "a.kind", "a.canon").distinct().join(redrawn, ["kind", "canon"]).groupBy("_sha").agg(
        F.map_from_entries(F.collect_list(F.struct(F.concat_ws("|", "kind", "canon").alias("k"), F.col("attempt")))).alias("_tries")))
    tries = scratch.keep(tries, "tries")
    hit = marked.withColumn("_sha", F.sha2("text", 256)).join(tries, "_sha", "left").drop("_sha")

    def attempt(a: Column) -> Column:
        return F.coalesce(F.try_element_at(F.coalesce("_tries", F.create_map().cast("map<string,int>")), F.concat_ws("|", a["kind"], a["canon"])), F.lit(0))

    def replaced(m: Column) -> Column:
        return _bound(F.transform(_atoms(m), lambda a: _surrogate(a["kind"], a["canon"], a["shown"], key, attempt(a))), lambda drawn: shown(m, drawn))

    def shown(m: Column, drawn: Column) -> Column:
        title = F.regexp_extract(m, r"^(\p{L}+\.? )", 1)
        link = F.when(m.rlike(r"^\p{L}+\.? \p{L}+-"), "-").otherwise(" ")
        kind = _kind(m)
        return F.struct(kind.alias("kind"), F.when(kind == "name", F.concat(title, F.when(F.size(drawn) > 1, F.concat(F.get(drawn, F.lit(0)), link, F.get(drawn, F.lit(1)))).otherwise(F.get(drawn, F.lit(0)))))
                        .otherwise(F.get(drawn, F.lit(0))).alias("surrogate"))
    hit = hit.withColumn("_entities", F.transform("_matches", replaced))
    pieces = F.split("text", ANY, -1)
    joined = F.array_join(F.transform(pieces, lambda s, i: F.concat(s, F.coalesce(F.get("_entities", i)["surrogate"], F.lit("")))), "")
    done = hit.withColumn("text", joined)
    untouched = docs.where(none).withColumn("text", text).withColumn("_entities", F.array().cast("array<struct<kind:string,surrogate:string>>"))
    return done.select(*columns, "_entities").unionByName(untouched.select(*columns, "_entities"))
