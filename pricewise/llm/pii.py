"""PII: keyed, type-consistent surrogates for detected entities.

One regular expression finds all entities of a text, in order. The distinct
entities of the corpus, reduced per task first, get surrogates from a keyed
hash of type and entity: same shape, script, letter case and, for names,
gender; card numbers keep a valid check digit. A surrogate that another entity
has, or that is itself an entity of the corpus, is drawn again with the next
attempt number until all differ, so equal entities stay equal and different
ones different, over the whole corpus. Texts are cut at the entities and put
together with the surrogates; formats (separators, upper case) are those of
each occurrence.

Texts are scanned once, those with names twice. Only texts with entities are joined, by the digest of
their entity list, so copies share their work.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import ROW, cut, pack

# Given names by script and gender.
NAMES = {
    ("latin", "f"): ("Mary", "Patricia", "Jennifer", "Linda", "Elizabeth", "Susan", "Jessica", "Sarah", "Karen",
                     "Anna", "Laura", "Julia", "Sophie", "Maria", "Lucia", "Carmen", "Claire", "Camille", "Greta", "Ingrid"),
    ("latin", "m"): ("James", "Robert", "John", "Michael", "David", "William", "Richard", "Joseph", "Thomas",
                     "Peter", "Klaus", "Stefan", "Pierre", "Jacques", "Antoine", "Carlos", "Javier", "Miguel", "Pablo", "Otto"),
    ("cyrillic", "f"): ("Анна", "Мария", "Елена", "Ольга", "Наталья", "Татьяна", "Ирина", "Светлана"),
    ("cyrillic", "m"): ("Иван", "Александр", "Сергей", "Дмитрий", "Андрей", "Алексей", "Михаил", "Николай"),
}
TITLES = ("Mr", "Mrs", "Ms", "Mr.", "Mrs.", "Ms.", "Herr", "Frau", "Madame", "Monsieur", "Señor", "Señora", "г-н", "г-жа")
# Parts of made-up given names, which take the place of found ones: beginnings, middles, endings by gender.
MADE = {"latin": (("Bel", "Cor", "Dal", "Fer", "Gal", "Hel", "Jor", "Kal", "Lor", "Mer", "Nor", "Or", "Per", "Ros", "Sel", "Tal",
                   "Val", "Wil", "Yar", "Zel"), ("an", "en", "in", "ar", "el", "is", "or", "ad", "ev", "ul"),
                  {"f": ("a", "ia", "ina", "ette", "elle", "isa"), "m": ("o", "us", "on", "ard", "ek", "ian")}),
        "cyrillic": (("Бел", "Вал", "Гал", "Дар", "Зор", "Кам", "Лад", "Мил", "Нев", "Рад", "Сев", "Тим", "Яр", "Вес", "Бор", "Люб"),
                     ("ан", "ен", "ил", "ор", "ад", "ев", "ум", "ис"),
                     {"f": ("а", "ия", "ина", "яна", "ена"), "m": ("ослав", "ей", "ентий", "ир", "ан")})}
LETTERS = {"lower": "abcdefghijklmnopqrstuvwxyz", "upper": "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
           "cyr_lower": "абвгдежзийклмнопрстуфхцчшщъыьэюя", "cyr_upper": "АБВГДЕЖЗИЙКЛМНОПРСТУФХЦЧШЩЪЫЬЭЮЯ",
           "gre_lower": "αβγδεζηθικλμνξοπρστυφχψω", "gre_upper": "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ",
           "arm_lower": "աբգդեզէըթժիլխծկհձղճմյնշոչպջռսվտրցւփքօֆ", "arm_upper": "ԱԲԳԴԵԶԷԸԹԺԻԼԽԾԿՀՁՂՃՄՅՆՇՈՉՊՋՌՍՎՏՐՑՒՓՔՕՖ"}
SCRIPTS = {"Cyrillic": "cyr", "Greek": "gre", "Armenian": "arm"}    # letters of other scripts are drawn as Latin ones
# Endings of surnames that show a gender; they are kept.
ENDINGS = r"(?<=..)(?:ская|цкая|ский|цкий|ова|ева|ёва|ина|ына|ов|ев|ёв|ин|ын|ova|eva|ová|ská|ský|ska|ski)\z"

_GIVEN = "|".join(f"{n}|{n.upper()}" for names in NAMES.values() for n in names)
_TITLE = "|".join(t.replace(".", r"\.") for t in sorted(TITLES, key=len, reverse=True))
# Capitalised words that are no further part of a name.
STOP = (*"""The A An And Or But Of In On At To For From With By As He She It We They You I Is Was Has Had Said Who When
Will Would Can Could May Might Must Shall Should Do Does Did Are Were Be Been Have Not No Yes This That These Those There Then
Than What Which Where Why How If So My Your His Her Our Their Its All Also After Before Now Here Der Die Das Und Ein Eine Ist War
Er Sie Es Wir Ich Ihr Nicht Mit Von Zu Zum Zur Im Am Auf Aus Aber Wenn Wie Was Wer Hat Hatte Dann Auch Le La Les Un Une Des Et Ou
Est Il Elle Nous Vous Ils Elles Dans Pour Avec Mais Que Qui Sur Au Aux Ce Cette El Los Las Una Del Es Por Con Pero Su Ella Но Он
Она Это Как Что Где Когда Мы Вы Они На По За Из""".split(), *TITLES)
_WORD = r"\p{Lu}(?:\p{L}++(?:['’\-]\p{Lu}\p{L}++)*+|(?:['’\-]\p{Lu}\p{L}++)++)"
_STOP = rf"(?:{'|'.join(w.replace('.', chr(92) + '.') for w in STOP)})(?!\p{{L}})"
_PARTS = rf"{_WORD}(?: (?!{_STOP}){_WORD})*+"     # all parts after the given name or title
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
# A last label of a mail host: letters, unless the label goes on after a dash and the host after that.
_TLD = r"[A-Za-z]{2,}+(?![A-Za-z0-9]|-[A-Za-z0-9\-]*+\.(?:[0-9\-][A-Za-z0-9\-]*+\.)*+[A-Za-z])"
HEX = r"\A(?:[0-9a-f]+|[0-9A-F]+)\z"
PATTERNS = {
    "email": rf"(?<![\p{{L}}\p{{N}}._%+\-])[\p{{L}}\p{{N}}._%+\-]++@[A-Za-z0-9\-]++(?:(?:\.(?!{_TLD})[A-Za-z0-9\-]++)*+\.{_TLD})++",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "secret": r"(?<![A-Za-z0-9])(?:[0-9a-f]{32,}+|[0-9A-F]{32,}+|(?:AKIA|ASIA)[0-9A-Z]{16}|"
              r"(?:sk|ghp|gho|xoxb)[-_][A-Za-z0-9_\-]{16,}+)(?![A-Za-z0-9])",
    "ip": rf"(?<![\d.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\.?\d)",
    "ipv6": r"(?<![0-9A-Za-z:.])(?=[0-9A-Fa-f:]*\d)(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}"
            r"|(?=[0-9A-Fa-f]{3,4}:|(?::{0,2}[0-9A-Fa-f]{1,4}){3})(?=[0-9A-Fa-f:]*::)(?![0-9A-Fa-f:]*:::)(?![0-9A-Fa-f:]*::[0-9A-Fa-f:]*::)"
            r"[0-9A-Fa-f]{1,4}(?::{1,2}[0-9A-Fa-f]{1,4}){1,6})(?![0-9A-Za-z:])",
    "phone": r"(?<![\d+])(?:\+\d{1,3}[ .\-]?(?:\(\d{1,4}\)[ .\-]?)?\d{2,4}(?:[ .\-]?\d{2,4}){1,4}"
             r"|\(\d{3}\) ?\d{3}-\d{4}|\d{3}-\d{3}-\d{4}"
             r"|(?<![.,\-])0[1-9](?:\d[ /\-]\d{6,9}|\d{2}[ /\-]\d{6,8}|\d{3}[ /\-]\d{5,7}|(?:[ .]\d{2}){4})(?![ .,\-]?\d))(?!\d)",
    "ssn": r"(?<![\d\-])\d{3}-\d{2}-\d{4}(?![\d\-])",
    # a run of digit groups, which cards are looked for in; it ends before a group that another entity begins with
    "card": "",
    "given": rf"(?=\p{{Lu}})(?:{_GIVEN})(?= {_WORD})",
    # after a title any capitalised word is a name, after a given name ("Mary Will go") a stop word is none
    "surname": rf"(?=\p{{Lu}})(?<= )(?:(?<=(?<!\p{{L}})(?:{_GIVEN}) )(?!{_STOP})|(?<=(?<!\p{{L}})(?:{_TITLE}) )){_PARTS}",
}
_GROUP = r"\d++(?!\.\d|-(?!\d))"
PATTERNS["card"] = (r"(?<![\d.\-])(?=\d(?:[ \-]?\d){12})" + _GROUP + r"(?:[ \-](?!"
                    + "|".join(PATTERNS[k] for k in ("email", "secret", "ip", "phone", "ssn")) + f"){_GROUP})*+")
CARD_GROUPS = ("4-4-4-4", "4-6-5", "4-6-4")      # the ways to write a card, beside one group
# What issuers' numbers begin with, and their lengths.
ISSUERS = (r"\A(?:4(?:\d{12}|\d{15}|\d{18})|5[1-5]\d{14}|2(?:22[1-9]|2[3-9]\d|[3-6]\d\d|7[01]\d|720)\d{12}|3[47]\d{13}"
           r"|3(?:0[0-5]|[689]\d)\d{11}|6(?:011|4[4-9]\d|5\d\d)\d{12,15}|35(?:2[89]|[3-8]\d)\d{12,15}|62\d{14,17}"
           r"|(?:5018|5020|5038|5893|6304|6759|676[1-3])\d{9,15})\z")
# Each pattern has its own condition on what precedes. What may not follow a letter or digit (mail, names) is tried at
# word starts only, the rest first by the characters that it can begin with; this finds the same and is faster.
_WORD_START = r"(?<![\p{L}\p{N}])"


def _entity(names: bool) -> str:
    keyed = f"(?=[A-Za-z0-9])(?:{PATTERNS['iban']}|{PATTERNS['secret']})"
    number = r"(?=[\d+(])(?:" + "|".join(PATTERNS[k] for k in ("ip", "phone", "ssn", "card")) + ")"
    named = f"|{PATTERNS['given']}|{PATTERNS['surname']}" if names else ""
    six = f"(?=[0-9A-Fa-f]{{1,4}}:){PATTERNS['ipv6']}"
    return (f"(?:{_WORD_START}(?:{PATTERNS['email']}|{keyed}|{six}|{number}{named})"
            rf"|(?<=[\p{{L}}\p{{N}}])(?:(?<=[^\x00-\x7F]){keyed}|{number}))")


ENTITY = _entity(True)
# Names need a given name or title before a capital: texts without such a place are searched without them.
NO_NAMES = _entity(False)
NAME_PLACE = rf"(?<!\p{{L}})(?=[\p{{Lu}}г])(?:{_GIVEN}|{_TITLE}) \p{{Lu}}"
# Lengths of account numbers by country.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "BY": 28, "CH": 21,
    "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18, "FO": 18, "FR": 27,
    "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IQ": 23, "IS": 26,
    "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "LY": 25, "MC": 27,
    "MD": 24, "ME": 22, "MK": 19, "MR": 27, "MT": 31, "MU": 30, "NL": 18, "NO": 15, "PK": 24, "PL": 28, "PS": 29, "PT": 25,
    "QA": 29, "RO": 24, "RS": 22, "SA": 24, "SC": 31, "SD": 18, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "ST": 25, "SV": 28,
    "TL": 23, "TN": 24, "TR": 26, "UA": 29, "VA": 22, "VG": 24, "XK": 20}
TABLE_GROUPS = 6            # digit groups in a run from which on it is a line of numbers: then only single groups are cards
SAME_SHAPE = 3              # rounds that draw surrogates of the entity's length; each later one draws one character more


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _luhn_sum(digits: Column, odd: int) -> Column:
    """Check sum of a digit array from its right end; every second one is doubled, from ``odd`` on."""
    return F.aggregate(
        F.transform(F.reverse(digits), lambda x, i: F.when(i % 2 == odd, F.when(x > 4, 2 * x - 9).otherwise(2 * x))
                    .otherwise(x)), F.lit(0), lambda a, x: a + x)


def _digit_array(c: Column) -> Column:
    return F.transform(F.split(c, ""), lambda x: F.coalesce(F.try_to_number(x, F.lit("9")).cast("int"), F.lit(0)))


def kind_of(raw: Column) -> Column:
    """Entity type of a match or of a part of one; null for what is none (a run of digit groups)."""
    def is_(name: str) -> Column:
        return raw.rlike(rf"\A(?:{PATTERNS[name]})\z")

    given = F.when(raw.isin([]), "")
    for (script, gender), names in NAMES.items():
        given = given.when(raw.isin([x for n in names for x in (n, n.upper())]), f"given_{script}_{gender}")
    return (F.when(raw.contains("@"), "email").when(is_("iban"), "iban").when(is_("secret"), "secret")
            .when(is_("ipv6"), "ipv6").when(is_("ip"), "ip").when(is_("phone"), "phone").when(is_("ssn"), "ssn").when(raw.rlike("\\A[0-9]"), None)
            .otherwise(F.coalesce(given, F.lit("surname"))))


def _let(x: Column, f) -> Column:
    """``f(x)`` with ``x`` evaluated once, however often ``f`` uses it."""
    return F.get(F.transform(F.array(x), f), F.lit(0))


def _cards(raw: Column) -> Column:
    """Parts of a run of digit groups, in order: ``(part, kind)``, kind null between cards.

    A card is one group of 13 to 19 digits or, in a run of at most
    ``TABLE_GROUPS``, groups of one of ``CARD_GROUPS``, with an issuer's beginning and length and a valid check digit; so a line of
    numbers stays. Of overlapping ones the first and longest comes first.
    """
    def sub(tokens: Column, i: Column) -> Column:
        def one(k: Column) -> Column:
            own = F.transform(F.slice(tokens, i + 1, k), _digits)
            digits = F.array_join(own, "")
            widths = F.array_join(F.transform(own, lambda g: F.length(g).cast("string")), "-")
            usual = (k == 1) | widths.isin(*CARD_GROUPS) & (F.size(tokens) <= TABLE_GROUPS)
            return F.struct(i.alias("i"), (-k).alias("less"), k.alias("k"), digits.alias("digits"), usual.alias("usual"))

        return F.filter(F.transform(F.sequence(F.lit(1), F.least(F.lit(4), F.size(tokens) - i)), one),
                        lambda c: c.usual & c.digits.rlike(ISSUERS) & (_luhn_sum(_digit_array(c.digits), 1) % 10 == 0))

    def chosen(tokens: Column) -> Column:
        valid = F.transform(F.array_sort(F.flatten(F.transform(tokens, lambda x, i: sub(tokens, i)))),
                            lambda c: F.struct(c.i.alias("i"), c.k.alias("k")))
        return F.aggregate(valid, F.array().cast("array<struct<i:int,k:int>>"), lambda acc, c: F.when(
            F.exists(acc, lambda a: (a.i < c.i + c.k) & (c.i < a.i + a.k)), acc).otherwise(F.concat(acc, F.array(c))))

    def part(text: Column, kind: str | None) -> Column:
        return F.struct(text.alias("part"), F.lit(kind).cast("string").alias("kind"))

    def parts(tokens: Column, cards: Column, x: Column, i: Column) -> Column:
        at = F.get(F.filter(cards, lambda a: (a.i <= i) & (i < a.i + a.k)), F.lit(0))
        text = F.array_join(F.slice(tokens, i + 1, at.k), "")
        return F.when(at.isNull(), F.array(part(x, None))).when(at.i == i, F.array(
            part(F.regexp_extract(text, "^[ -]?", 0), None),
            part(F.regexp_replace(text, "^[ -]", ""), "card"))).otherwise(F.array().cast("array<struct<part:string,kind:string>>"))

    # each token with the separator before it
    return _let(F.regexp_extract_all(raw, F.lit("[ -]?[0-9]+"), F.lit(0)), lambda tokens: _let(
        chosen(tokens), lambda cards: F.flatten(F.transform(tokens, lambda x, i: parts(tokens, cards, x, i)))))


def _mod97(text: Column) -> Column:
    """Remainder by 97 of a number written in digits and letters (A is 10)."""
    def value(c: Column) -> Column:
        return F.when(c.rlike("[0-9]"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55)

    return F.aggregate(F.transform(F.filter(F.split(text, ""), lambda c: c != ""), value), F.lit(0),
                       lambda a, v: (a * F.when(v > 9, 100).otherwise(10) + v) % 97)


def _iban_parts(raw: Column) -> Column:
    """An account number with valid check digits at the start of the match and what follows it; else no entity."""
    def part(text: Column, kind: str | None) -> Column:
        return F.struct(text.alias("part"), F.lit(kind).cast("string").alias("kind"))

    def text(tokens: Column, k: Column, by: str) -> Column:
        return F.array_join(F.slice(tokens, F.lit(1), k), by)

    def valid(tokens: Column, k: Column) -> Column:
        lengths = F.create_map(*[F.lit(x) for pair in IBAN_LENGTHS.items() for x in pair])
        return _let(text(tokens, k, ""), lambda t: F.coalesce(F.length(t) == F.try_element_at(lengths, F.substr(t, F.lit(1), F.lit(2))), F.lit(False)) & (
            _mod97(F.concat(F.substr(t, F.lit(5), F.length(t)), F.substr(t, F.lit(1), F.lit(4)))) == 1))

    return _let(F.split(raw, " "), lambda tokens: _let(F.get(F.filter(
        F.sequence(F.size(tokens), F.lit(1), F.lit(-1)), lambda k: valid(tokens, k)), F.lit(0)),
        lambda k: F.when(k.isNull(), F.array(part(raw, None))).when(k == F.size(tokens), F.array(part(raw, "iban")))
        .otherwise(F.array(part(text(tokens, k, " "), "iban"),
                           part(F.substr(raw, F.length(text(tokens, k, " ")) + 1, F.length(raw)), None)))))


def parts_of(raw: Column) -> Column:
    """The parts of a match, in order: ``(part, kind)``."""
    kind = kind_of(raw)
    words = F.regexp_extract_all(raw, F.lit(" |[^ ]+"), F.lit(0))
    return F.when(raw.rlike(rf"\A(?:{PATTERNS['card']})\z") & kind.isNull(), _cards(raw)) \
        .when(kind == "iban", _iban_parts(raw)) \
        .when((kind == "surname") & raw.contains(" "), F.transform(words, lambda w: F.struct(
            w.alias("part"), F.when(w != " ", kind_of(w)).alias("kind")))) \
        .otherwise(F.array(F.struct(raw.alias("part"), kind.alias("kind"))))


def canonical(kind: Column, raw: Column) -> Column:
    """What two mentions of one entity share."""
    return F.when(kind.isin("phone", "card", "ssn"), _digits(raw)).when(kind == "iban", F.replace(raw, F.lit(" "))) \
        .when(kind.isin("email", "ipv6") | (kind == "secret") & raw.rlike(HEX), F.lower(raw)) \
        .when(kind == "surname", F.lower(raw)).when(kind.startswith("given"), F.initcap(raw)).otherwise(raw)


def _random(seed: Column, i: Column) -> Column:
    """The ``i``-th of a keyed stream of whole numbers below 2^32."""
    block = F.sha2(F.concat_ws("\x1f", seed, (i / 8).cast("int").cast("string")).cast("binary"), 256)
    return F.conv(F.substr(block, (i % 8) * 8 + 1, F.lit(8)), 16, 10).cast("long")


def _pick(letters: str, r: Column) -> Column:
    return F.substr(F.lit(letters), (r % len(letters)).cast("int") + 1, F.lit(1))


def _shaped(text: Column, seed: Column, hex_only: bool = False) -> Column:
    """Random characters of the class of each character of ``text``."""
    low = "abcdef" if hex_only else LETTERS["lower"]

    def one(c: Column, i: Column) -> Column:
        r = _random(seed, i)
        out = (F.when(c.rlike("[0-9]"), (r % 10).cast("string")).when(c.rlike("[a-z]"), _pick(low, r))
               .when(c.rlike("[A-Z]"), _pick(low.upper(), r)))
        for script, name in SCRIPTS.items():
            out = out.when(c.rlike(rf"[\p{{Is{script}}}&&\p{{Lu}}]"), _pick(LETTERS[name + "_upper"], r)) \
                .when(c.rlike(rf"[\p{{Is{script}}}&&\p{{L}}]"), _pick(LETTERS[name + "_lower"], r))
        return (out.when(c.rlike(r"\p{Lu}"), _pick(LETTERS["upper"], r)).when(c.rlike(r"\p{L}"), _pick(LETTERS["lower"], r))
                .otherwise(c))

    return F.array_join(F.transform(F.split(text, ""), one), "")


def surrogate(kind: Column, canon: Column, seed: Column, longer: int = 0) -> Column:
    """A type-consistent replacement of a canonical entity, ``longer`` characters longer where its length is free."""
    at = F.expr("instr(canon, '@')")
    host = F.substr(canon, at + 1, F.length(canon))
    tld = F.regexp_extract(host, r"([^.]*)\z", 1)
    label = F.substr(host, F.lit(1), F.length(host) - F.length(tld) - 1)
    def more(c: Column, char: str) -> Column:
        return F.concat(c, F.lit(char * longer)) if longer else c

    email = F.concat(_shaped(more(F.substr(canon, F.lit(1), at - 1), "a"), seed), F.lit("@"),
                     F.regexp_replace(_shaped(F.regexp_replace(label, r"\.?example\z", ""), F.concat(seed, F.lit("h"))), r"\A-|-\z", "x"),
                     F.when(label.rlike(r"(\.|\A)example\z"), F.when(label == "example", "x.example").otherwise(".example"))
                     .otherwise(".example"), F.lit("."), F.when(tld.isin("com", "net", "org"), tld).otherwise("com"))
    octets = F.array_join(F.array(*[(_random(seed, F.lit(i)) % (223 if i == 0 else 254) + 1).cast("string")
                                    for i in range(4)]), ".")
    body = F.transform(F.sequence(F.lit(0), F.length(canon) - 2),
                       lambda i: F.when((i == 0) | (i < 4) & ~canon.startswith("4"),     # the issuer stays
                                        F.substr(canon, i + 1, F.lit(1)).cast("int"))
                       .otherwise((_random(seed, i) % 10).cast("int")))
    card = F.concat(F.array_join(F.transform(body, lambda x: x.cast("string")), ""),
                    ((10 - _luhn_sum(body, 0) % 10) % 10).cast("string"))
    phone = F.concat(F.substr(canon, F.lit(1), F.lit(1)), _shaped(more(F.substr(canon, F.lit(2), F.length(canon)), "0"), seed))
    prefix = F.regexp_extract(canon, r"\A(?:AKIA|ASIA|(?:sk|ghp|gho|xoxb)[-_])", 0)
    secret = F.when(canon.rlike(HEX), _shaped(more(canon, "0"), seed, hex_only=True)).otherwise(
        F.concat(prefix, _shaped(more(F.substr(canon, F.length(prefix) + 1, F.length(canon)), "a"), seed)))
    country = F.substr(canon, F.lit(1), F.lit(2))
    iban = _let(_shaped(F.substr(canon, F.lit(5), F.length(canon)), seed), lambda b: F.concat(
        country, F.lpad((98 - _mod97(F.concat(b, country, F.lit("00")))).cast("string"), 2, "0"), b))
    six = F.concat(F.lit("2001:db8:"), F.array_join(F.array(*[      # the range kept for examples
        F.lower(F.hex(_random(seed, F.lit(i)) % 65536)) for i in range(6)]), ":"))
    out = F.when(kind == "email", email).when(kind == "ip", octets).when(kind == "secret", secret).when(kind == "card", card).when(kind == "phone", phone) \
        .when(kind == "iban", iban).when(kind == "ipv6", six)
    for script, gender in NAMES:
        first, middle, last = MADE[script][0], MADE[script][1], MADE[script][2][gender]
        texts = [(first, 0), *[(middle, i) for i in range(1, 2 + longer)], (last, 2 + longer)]
        made = F.concat(*[F.get(F.array(*[F.lit(x) for x in xs]), (_random(seed, F.lit(i)) % len(xs)).cast("int")) for xs, i in texts])
        out = out.when(kind == f"given_{script}_{gender}", made)
    ending = F.regexp_extract(canon, ENDINGS, 0)
    stem = F.substr(canon, F.lit(1), F.length(canon) - F.length(ending))
    last = F.substr(stem, F.length(stem), F.lit(1))
    stem = F.concat(stem, F.repeat(F.lower(last), F.lit(longer))) if longer else stem
    return out.when(kind == "surname", F.concat(_shaped(stem, seed), ending)).otherwise(_shaped(canon, seed))


def resolve(entities: DataFrame, key: str) -> DataFrame:
    """``(kind, canon, surr)`` with all surrogates different per type and none an entity.

    A type's short entities can use up the texts of their shape, so surrogates
    grow from round to round and a free one exists in the end. Cards, SSNs, IPs
    and IBANs keep their length; each has over 10^7 texts.
    """
    todo = entities.select("kind", "canon", F.lit(0).alias("attempt"))
    taken = entities.select("kind", F.col("canon").alias("surr"))
    done = None
    for attempt in count():
        seed = F.concat_ws("\x1f", F.lit(key), F.col("kind"), F.col("canon"), F.lit(str(attempt)))
        drawn = todo.select("kind", "canon", F.lit(attempt).alias("attempt")).select(
            "kind", "canon", surrogate(F.col("kind"), F.col("canon"), seed, max(0, attempt + 1 - SAME_SHAPE)).alias("surr"))
        free = drawn.join(taken, ["kind", "surr"], "left_anti")
        if done is not None:
            free = free.join(done.select("kind", "surr"), ["kind", "surr"], "left_anti")
        won = cut(free.groupBy("kind", "surr").agg(F.min("canon").alias("canon")), "pii-won")
        done = won if done is None else done.unionByName(won)
        left = cut(todo.select("kind", "canon").join(won.select("kind", "canon"), ["kind", "canon"], "left_anti"),
                   "pii-left")
        todo = left
        if left.isEmpty():
            return done.select("kind", "canon", "surr")


def _filled(raw: Column, digits: Column) -> Column:
    """``raw`` with its digits replaced in order by ``digits``, further ones at its end."""
    return F.concat(F.array_join(F.transform(
        F.split(raw, ""), lambda c, i: F.when(c.rlike("[0-9]"), F.substr(
            digits, F.length(_digits(F.substr(raw, F.lit(1), i + 1))), F.lit(1))).otherwise(c)), ""),
        F.substr(digits, F.length(_digits(raw)) + 1, F.length(digits)))


def replacement(kind: Column, raw: Column, surr: Column) -> Column:
    """The surrogate in the format of one occurrence."""
    spaced = F.array_join(F.transform(F.split(raw, ""), lambda c, i: F.when(c == " ", " ").otherwise(F.substr(
        surr, F.length(F.replace(F.substr(raw, F.lit(1), i + 1), F.lit(" "))), F.lit(1)))), "")
    upper = (F.upper(raw) == raw) & (F.lower(raw) != raw)
    name = F.array_join(F.transform(F.split(surr, ""), lambda c, i: F.when(
        F.substr(raw, i + 1, F.lit(1)).rlike(r"\p{Lu}"), F.upper(c)).otherwise(c)), "")
    return F.when((kind == "surname") & ~upper, name).when((kind == "surname") | kind.startswith("given") & upper, F.upper(surr)) \
        .when(kind.isin("phone", "card", "ssn"), _filled(raw, surr)).when(kind == "iban", spaced) \
        .when((kind.isin("email", "ipv6") | (kind == "secret") & raw.rlike(HEX)) & upper, F.upper(surr)).otherwise(surr)


def names_of(ents: Column) -> Column:
    """The words of the names among a text's entities, longest first."""
    names = F.filter(ents, lambda x: x.rlike(r"\A\p{Lu}[\p{L}'’\- ]+\z") & ~x.rlike(rf"\A(?:{PATTERNS['secret']})\z"))
    words = F.array_distinct(F.flatten(F.transform(names, lambda x: F.split(x, " "))))
    words = F.filter(words, lambda w: ~w.isin(*STOP))
    return F.transform(F.array_sort(F.transform(words, lambda w: F.struct((-F.length(w)).alias("n"), w.alias("w")))),
                       lambda x: x.w)


def _with_names(names: Column) -> Column:
    """The expression of all entities, then those names standing alone, capitalised or in capitals."""
    return F.concat(F.lit(rf"(?:{ENTITY})|{_WORD_START}(?=\p{{Lu}})(?iu:"), F.array_join(names, "|"),
                    F.lit(r")(?![\p{L}\p{N}])"))


def redact(docs: DataFrame, text: str = "text", *, key: str) -> DataFrame:
    """Packed rows of ``docs`` with ``new_text``, ``n_entities`` (long) and ``kinds`` (sorted, joined).

    Null texts stay null; texts without entities are unchanged. Repeated rows
    keep their rows and get equal results. An empty table gives no rows. Other
    columns pass through, whatever their names. The same key gives the same
    surrogates as long as the set of entities is the same; who knows it can
    test guesses, so it should be secret.
    """
    t = F.col(f"`{text}`")
    def found(pattern: str | Column) -> Column:
        return F.regexp_extract_all(t, F.lit(pattern) if isinstance(pattern, str) else pattern, F.lit(0))

    def both(names: Column, ents: Column) -> Column:
        return F.struct(names.alias("names"), ents.alias("ents"))

    # a text with names is searched again, for their words standing alone
    named = _let(found(ENTITY), lambda e: _let(names_of(e), lambda n: both(
        n, F.when(F.size(n) > 0, found(_with_names(n))).otherwise(e))))
    f = F.when(t.rlike(NAME_PLACE), named).otherwise(both(F.array().cast("array<string>"), found(NO_NAMES)))
    rows = cut(docs.select(pack(docs), f.alias("f")), "pii-rows").select(ROW, "f.names", "f.ents")
    has = F.coalesce(F.size("ents") > 0, F.lit(False))
    digest = F.sha2(F.array_join("ents", "\x1f").cast("binary"), 256)
    lists = cut(rows.filter(has).select("ents").groupBy(digest.alias("list")).agg(F.first("ents").alias("ents")),
                "pii-lists")
    raw = cut(lists.select(F.explode(F.array_distinct("ents")).alias("raw")).distinct(), "pii-raw")
    parts = raw.select("raw", F.posexplode(parts_of(F.col("raw"))).alias("at", "p")).select("raw", "at", "p.part", "p.kind")
    typed = cut(parts.select("*", canonical(F.col("kind"), F.col("part")).alias("canon")), "pii-typed")
    mapping = resolve(typed.filter("kind is not null").select("kind", "canon").distinct(), key)
    new = typed.join(mapping, ["kind", "canon"], "left").select(
        "raw", "at", "kind", F.coalesce(replacement(F.col("kind"), F.col("part"), F.col("surr")), "part").alias("new"))
    repl = cut(new.groupBy("raw").agg(F.sort_array(F.collect_list(F.struct("at", "new", "kind"))).alias("n")).select(
        "raw", F.array_join(F.transform("n", lambda x: x.new), "").alias("repl"),
        F.filter(F.transform("n", lambda x: x.kind), lambda k: k.isNotNull()).alias("kinds")), "pii-map")
    each = lists.select("list", F.posexplode("ents").alias("pos", "raw")).join(repl, "raw")
    filled = cut(each.groupBy("list").agg(
        F.sort_array(F.collect_list(F.struct("pos", F.col("repl").alias("r"), "kinds"))).alias("r")), "pii-filled")
    pieces = F.when(F.size("names") > 0, F.split(F.col(ROW)[text], _with_names(F.col("names")), -1)) \
        .otherwise(F.split(F.col(ROW)[text], ENTITY, -1))
    joined = rows.filter(has).select(ROW, "names", digest.alias("list")).join(filled, "list").select(
        ROW, F.array_join(F.flatten(F.transform(
            pieces, lambda p, i: F.array(p, F.coalesce(F.get("r", i).r, F.lit(""))))), "").alias("new_text"),
        F.size(F.flatten(F.transform("r", lambda x: x.kinds))).cast("long").alias("n_entities"),
        F.array_join(F.sort_array(F.array_distinct(F.flatten(F.transform("r", lambda x: x.kinds)))), ",").alias("kinds"))
    clean = rows.filter(~has).select(ROW, F.col(ROW)[text].alias("new_text"), F.lit(0).cast("long").alias("n_entities"),
                                     F.lit("").alias("kinds"))
    return joined.unionByName(clean)


def report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **params) -> DataFrame:
    """Per row: doc_id, text (with surrogates), n_entities, kinds."""
    return redact(docs, text, **params).select(F.col(ROW)[doc_id].alias("doc_id"), F.col("new_text").alias("text"),
                                               "n_entities", "kinds")


def with_surrogates(docs: DataFrame, text: str = "text", **params) -> DataFrame:
    """``docs`` with the surrogates in its texts, all columns as they were."""
    return redact(docs, text, **params).select(*[
        F.col("new_text").alias(c) if c == text else F.col(ROW)[c].alias(c) for c in docs.columns])
