"""Surrogates for personal data: keyed, of the same type, and distinct for what was distinct.

Entities are found by one pattern: mail addresses, telephone and card numbers, network addresses, account numbers,
secrets, and names after a title or of a listed given name. A surname so found, and a listed given name, is replaced
wherever it stands alone in that text. Each entity has a canonical form (a mail address in
lower case, a telephone number as its country code and digits), so what denotes the same thing gets the same surrogate
wherever it stands. A surrogate is a keyed digest written in the form of the original: digits for digits,
letters of the same script and case, the same separators, country codes kept, card numbers with a right check digit
if they had one, given names of the same gender and script.

Distinctness is checked over the whole table: entities whose surrogate is that of another one, or is itself
an entity of the texts, are drawn again until none is left. Only those drawn again are joined back to texts,
so as a rule nothing is; documents without entities are never shuffled. Everything is DataFrame functions.

Two spellings of one IPv6 address, one with and one without its zeros, are two entities. Names in capitals are not found.

Defined results: NULL and empty texts stay as they are. Repeated rows are replaced alike. Extra columns are
kept, whatever their names. The same key gives the same surrogates; who has the key can test a guess.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.common import free_name, written

# Titles and given names by gender and script, syllables by script.
TITLES = {
    "m": ["Mr", "Mister", "Herr", "Herrn", "Monsieur", "Señor", "Sr", "Signor", "Господин", "Κύριος"],
    "f": ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Mlle", "Señora", "Sra", "Signora", "Госпожа", "Κυρία"],
    "n": ["Dr", "Prof"],
}
GIVEN = {
    ("m", "latin"): [
        "James", "John", "Robert", "Michael", "William", "David", "Thomas", "Daniel", "Peter", "Paul", "Hans", "Karl",
        "Jürgen", "Wolfgang", "Pierre", "Michel", "Luis", "Carlos", "José", "Antonio",
    ],
    ("f", "latin"): [
        "Mary", "Patricia", "Jennifer", "Linda", "Elizabeth", "Susan", "Sarah", "Karen", "Anna", "Maria", "Ursula", "Monika",
        "Sabine", "Claire", "Sophie", "Camille", "Carmen", "Lucía", "Isabel", "Juana",
    ],
    ("n", "latin"): ["Alex", "Chris", "Robin", "Kim", "Sascha", "Dominique"],
    ("m", "cyrillic"): ["Иван", "Алексей", "Дмитрий", "Сергей", "Николай", "Михаил"],
    ("f", "cyrillic"): ["Анна", "Мария", "Елена", "Ольга", "Наталья", "Татьяна"],
    ("n", "cyrillic"): ["Саша", "Женя"],
    ("m", "greek"): ["Γιώργος", "Νίκος", "Δημήτρης", "Κώστας"],
    ("f", "greek"): ["Μαρία", "Ελένη", "Κατερίνα", "Σοφία"],
    ("n", "greek"): ["Άλεξ", "Χάρις"],
}
SYLLABLES = {
    "latin": ["ba", "den", "fer", "gal", "hol", "ker", "lin", "mar", "nor", "pel", "ros", "tam", "ver", "wil", "zan", "cor"],
    "cyrillic": ["ба", "ве", "го", "да", "же", "зи", "ко", "лу", "ма", "не", "по", "ра", "си", "ту", "фе", "хо"],
    "greek": ["βα", "γε", "δη", "κο", "λα", "μι", "νο", "πα", "ρε", "σι", "το", "φα", "χα", "ζη", "θε", "ξα"],
}
ENDINGS = {("m", "cyrillic"): "ов", ("f", "cyrillic"): "ова", ("n", "cyrillic"): "ко"}
LETTERS = {
    "latin": "abcdefghijklmnopqrstuvwxyz", "cyrillic": "абвгдежзиклмнопрстуфхцчшэюя", "greek": "αβγδεζηθικλμνξοπρστυφχψω",
}

# The s of a genitive is no part of a name.
_NAME_WORD = r"\p{Lu}[\p{Ll}\p{Lu}'’-]*\p{Ll}(?<!['’]s)"
_HEX = "[0-9A-Fa-f]{1,4}"
_ANY_TITLE = "|".join(t for group in TITLES.values() for t in group)
_ANY_GIVEN = "|".join(dict.fromkeys(n for group in GIVEN.values() for n in group))
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"

# Kinds in the order in which they are tried at a place of the text.
PATTERNS = {
    "mail": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]+(?:\.[\p{L}\p{N}-]+)*\.\p{L}{2,}",
    "access_key": r"(?<![A-Za-z0-9])A(?:KIA|SIA)[A-Z0-9]{16}(?![A-Za-z0-9])",
    "secret": r"(?<=\b(?i:password|passwd|pwd|secret|token|api_key|apikey) ?[=:] ?[\"']?)[^\s\"']{7,}[^\s\"'.,;:!?)\]}>]",
    "hex": r"(?<![A-Za-z0-9])(?=[a-fA-F]*\d)[0-9a-fA-F]{32,64}(?![A-Za-z0-9])",
    "address": rf"(?<![\d.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\.?\d)",
    "address6": rf"(?<![\w:.])(?=[0-9A-Fa-f:]*\d)(?:(?:{_HEX}:){{7}}{_HEX}|(?=[0-9A-Fa-f]{{3,4}}::|{_HEX}(?::+{_HEX}){{2}}){_HEX}(?::{_HEX}){{0,5}}::(?:{_HEX}(?::{_HEX}){{0,5}})?)(?![\w:])",
    "account": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "card": r"(?<![\d.-])\d{4}([ -]?)\d{4}\1\d{4}\1\d{1,7}(?![\d-])",
    "social": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "phone": r"(?<![\d+.])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?(?!\d{1,3}(?:\.\d{1,3}){3}(?!\.?\d))\d{2,4}){1,4}|\(\d{2,4}\) ?\d{3,4}[ -]?\d{3,4}|\d{3}-\d{3}-\d{4}"
    r"|0\d{2,4}[ /-]\d{3,4}[ -]?\d{2,5}|0\d(?:[ .]\d{2}){4})(?![\d-])",
    "titled": rf"(?<!\p{{L}})(?:{_ANY_TITLE})\.? {_NAME_WORD}(?: {_NAME_WORD})?(?!\p{{L}})",
    "named": rf"(?<!\p{{L}})(?:{_ANY_GIVEN}) {_NAME_WORD}(?!\p{{L}})",
}
# Group references count from the left of the whole pattern; only "card" has a group.
ENTITY = "|".join(PATTERNS.values())
# Texts without any of these hold no entity; a quick test for the many.
HINT = rf"[0-9@]|(?i:password|passwd|pwd|secret|token|api_?key) ?[=:]|(?<!\p{{L}})(?=\p{{Lu}})(?:{_ANY_TITLE}|{_ANY_GIVEN})\.? \p{{Lu}}"
ATTEMPTS_BY_LIST = 4
# What a telephone number keeps: its country code, told by its first digits, or the 0 of a national number.
PHONE_KEPT = r"^(?:\+(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3}|\d)|\(?0)"

_PIECE = "struct<kind:string,original:string,canonical:string>"


def _literals(values: list[str]) -> Column:
    return F.array(*map(F.lit, values))


def _piece(kind: Column, original: Column, canonical: Column) -> Column:
    return F.struct(kind.alias("kind"), original.alias("original"), canonical.alias("canonical"))


def _script(word: Column) -> Column:
    return F.when(word.rlike(r"\p{IsCyrillic}"), "cyrillic").when(word.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")


def _kind(entity: Column) -> Column:
    """By the first pattern that fits; a secret is told by what stands before it, so it is what is left."""
    first, *rest = [(kind, entity.rlike(f"^(?:{pattern})$")) for kind, pattern in PATTERNS.items() if kind != "secret"]
    found = F.when(first[1], first[0])
    for kind, fits in rest:
        found = found.when(fits, kind)
    return found.otherwise("secret")


def let(value: Column, use) -> Column:
    """``use`` of a value that is computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _pieces(entity: Column) -> Column:
    """An entity as parts to replace and parts to keep; the kind of the latter is NULL."""

    def whole(kind: Column) -> Column:
        canonical = (
            F.when(kind.isin("mail", "hex", "address6"), F.lower(entity))
            .when(kind == "phone", _phone(entity))
            .when(kind.isin("card", "social"), F.regexp_replace(entity, "[^0-9]", ""))
            .when(kind == "account", F.regexp_replace(entity, " ", ""))
            .otherwise(entity)
        )
        return F.array(_piece(kind, entity, canonical))

    return let(_kind(entity), lambda kind: F.when(kind.isin("titled", "named"), _person(entity)).otherwise(whole(kind)))


def _phone(entity: Column) -> Column:
    """The digits, after the country code where there is one; what is kept of it is what is kept of the original."""
    code = F.when(entity.startswith("+"), F.concat(F.regexp_extract(entity, PHONE_KEPT, 0), F.lit(" "))).otherwise("")
    rest = F.when(entity.startswith("+"), F.regexp_replace(entity, PHONE_KEPT, "")).otherwise(entity)
    return F.concat(code, F.regexp_replace(rest, "[^0-9]", ""))


def _person(entity: Column) -> Column:
    none = F.lit(None).cast("string")
    keep = lambda text: _piece(none, text, none)
    genders = {t: g for g, titles in TITLES.items() for t in titles if g != "n"}
    genders = {n: g for (g, _), names in GIVEN.items() for n in names if g != "n"} | genders

    def parts(title: Column, name: Column) -> Column:
        given = F.when(name.contains(" "), F.substring_index(name, " ", 1)).otherwise("")
        surname = F.substring_index(name, " ", -1)
        gender = F.coalesce(F.try_element_at(_map(genders), title), F.try_element_at(_map(genders), given), F.lit("n"))
        # Surnames have a gender only where the script writes one.
        surname_gender = F.when(_script(surname) == "cyrillic", gender).otherwise("n")
        return F.array(
            keep(F.substring(entity, F.lit(1), F.char_length(entity) - F.char_length(name))),
            _piece(F.when(given != "", F.concat_ws(":", F.lit("given"), gender, _script(given))), given, F.lower(given)),
            keep(F.when(given != "", " ").otherwise("")),
            _piece(F.concat_ws(":", F.lit("surname"), surname_gender, _script(surname)), surname, F.lower(surname)),
        )

    titled = rf"^(?:({_ANY_TITLE})\.? )?"
    return let(
        F.regexp_extract(entity, titled, 1), lambda title: let(F.regexp_replace(entity, titled, ""), lambda name: parts(title, name))
    )


def _with_names_alone(pieces: Column) -> Column:
    """The pieces of a text, where its surnames and listed given names are entities wherever they stand alone, too."""
    none = F.lit(None).cast("string")
    is_name = lambda p: p["kind"].startswith("surname:") | p["original"].isin(_listed())
    names = F.array_distinct(F.filter(pieces, lambda p: p["kind"].isNotNull() & is_name(p)))

    def parted(text: Column, known: Column) -> Column:
        any_of = F.array_join(F.array_sort(F.transform(known, lambda p: p["original"]), _longer_first), "|")
        # A hyphen or an apostrophe before or a hyphen after makes it part of another name.
        pattern = F.concat(F.lit(r"(?<![\p{L}\p{N}'’-])(?:"), any_of, F.lit(r")(?![\p{L}\p{N}-])"))
        between = F.transform(F.split(text, pattern, -1), lambda t: _piece(none, t, none))
        found = F.transform(
            F.regexp_extract_all(text, pattern, F.lit(0)), lambda n: F.get(F.filter(known, lambda p: p["original"] == n), F.lit(0))
        )
        pairs = F.zip_with(between, found, lambda a, b: F.when(b.isNull(), F.array(a)).otherwise(F.array(a, b)))
        return F.flatten(pairs)

    def in_all(known: Column) -> Column:
        return F.flatten(
            F.transform(pieces, lambda p: F.when(p["kind"].isNull() & (p["original"] != ""), parted(p["original"], known)).otherwise(F.array(p)))
        )

    return let(names, lambda known: F.when(F.size(known) > 0, in_all(known)).otherwise(pieces))


def _listed() -> list[str]:
    return list(dict.fromkeys(name for group in GIVEN.values() for name in group))


def _longer_first(a: Column, b: Column) -> Column:
    return F.char_length(b) - F.char_length(a)


def _map(values: dict[str, str | list[str]]) -> Column:
    entries = [F.lit(k) if i == 0 else (_literals(v) if isinstance(v, list) else F.lit(v)) for k, v in values.items() for i in (0, 1)]
    return F.create_map(*entries)


def _digest(key: str, kind: Column, canonical: Column, attempt: Column) -> Column:
    """128 hexadecimal digits."""
    return F.sha2(F.concat_ws("\x1f", F.lit(key), kind, canonical, attempt.cast("string")), 512)


def _number(digest: Column, at: Column, most: Column) -> Column:
    """A number from 0 to ``most`` - 1 for a place of the digest; places begin anew after its end."""
    part = F.substring(digest, F.pmod(at, F.lit(62)) * 2 + 1, F.lit(4))
    return F.pmod(F.conv(part, 16, 10).cast("int"), most)


def _in_form(original: Column, digest: Column, kept: Column) -> Column:
    """Letters for letters and digits for digits; the first ``kept`` characters as they are.

    The n-th letter or digit depends on n alone, so separators make no difference.
    """

    def character(c: Column, i: Column) -> Column:
        n = F.char_length(F.regexp_replace(F.substring(original, F.lit(1), i), r"[^\p{L}\p{N}]", ""))
        letters = F.element_at(_map(LETTERS), _script(c))
        letter = let(letters, lambda all_: F.substring(all_, _number(digest, n, F.char_length(all_)) + 1, F.lit(1)))
        return (
            F.when(i < kept, c)
            .when(c.rlike(r"^\p{Nd}$"), _number(digest, n, F.lit(10)).cast("string"))
            .when(c.rlike(r"^\p{Lu}$"), F.upper(letter))
            .when(c.rlike(r"^\p{L}$"), letter)
            .otherwise(c)
        )

    return F.array_join(F.transform(F.split(original, ""), character), "")


def _luhn(digits: Column) -> Column:
    """The sum of a card number's digits, of which every second one from the right is doubled."""

    def value(c: Column, i: Column) -> Column:
        d = c.cast("int") * F.when(F.pmod(F.char_length(digits) - i, F.lit(2)) == 0, 2).otherwise(1)
        return F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.transform(F.split(digits, ""), value), F.lit(0), lambda a, b: a + b)


def _checked(original: Column, drawn: Column) -> Column:
    """A card number with a right check digit if the original's was."""

    def right(digits: Column) -> Column:
        body = F.substring(digits, F.lit(1), F.char_length(digits) - 1)
        check = F.pmod(10 - F.pmod(_luhn(F.concat(body, F.lit("0"))), F.lit(10)), F.lit(10)).cast("string")
        return F.concat(F.substring(drawn, F.lit(1), F.char_length(drawn) - 1), check)

    was_right = F.pmod(_luhn(F.regexp_replace(original, "[^0-9]", "")), F.lit(10)) == 0
    return F.when(was_right, let(F.regexp_replace(drawn, "[^0-9]", ""), right)).otherwise(drawn)


def _hex(original: Column, digest: Column) -> Column:
    # Digits may become letters: those are in upper case where the letters of the original are.
    upper = original.rlike("[A-F]") & ~original.rlike("[a-f]")

    def place(c: Column, i: Column) -> Column:
        drawn = F.substring(digest, F.pmod(i, F.lit(128)) + 1, F.lit(1))
        return F.when(c == ":", c).when(upper | c.rlike("[A-F]"), F.upper(drawn)).otherwise(drawn)

    return F.array_join(F.transform(F.split(original, ""), place), "")


def _address(digest: Column) -> Column:
    octets = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: (_number(digest, i, F.lit(254)) + 1).cast("string"))
    return F.array_join(octets, ".")


def _syllables(script: Column, digest: Column) -> Column:
    listed = F.element_at(_map(SYLLABLES), script)
    parts = let(listed, lambda all_: F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: F.get(all_, _number(digest, i, F.size(all_)))))
    return F.initcap(F.array_join(parts, ""))


def _given(kind: Column, digest: Column, attempt: Column) -> Column:
    names = F.element_at(_map({f"given:{g}:{s}": names for (g, s), names in GIVEN.items()}), kind)
    listed = let(names, lambda all_: F.get(all_, _number(digest, F.lit(0), F.size(all_))))
    # A list is soon used up: further names are made from one of it.
    made = F.concat(listed, F.lit("-"), _syllables(F.substring_index(kind, ":", -1), digest))
    return F.when(attempt < ATTEMPTS_BY_LIST, listed).otherwise(made)


def _surname(kind: Column, digest: Column) -> Column:
    endings = _map({f"surname:{g}:{s}": ending for (g, s), ending in ENDINGS.items()})
    return F.concat(_syllables(F.substring_index(kind, ":", -1), digest), F.coalesce(F.try_element_at(endings, kind), F.lit("")))


def surrogate(key: str, kind: Column, original: Column, canonical: Column, attempt: Column) -> Column:
    """What stands for an entity; of two forms of one entity the surrogates are forms of one surrogate."""
    # The last label of a domain stays, and so do the issuer of a card, prefixes and country codes.
    last = F.when(kind == "mail", F.substring_index(original, ".", -1)).otherwise("")
    kept = (
        F.when(kind == "card", 1)
        .when(kind == "access_key", 4)
        .when(kind == "account", 2)
        .when(kind == "phone", F.char_length(F.regexp_extract(original, PHONE_KEPT, 0)))
        .otherwise(0)
    )

    def drawn(digest: Column) -> Column:
        body = F.substring(original, F.lit(1), F.char_length(original) - F.char_length(last))
        in_form = let(body, lambda b: let(kept, lambda k: _in_form(b, digest, k)))
        return (
            F.when(kind == "address", _address(digest))
            .when(kind.isin("hex", "address6") | (kind == "secret") & original.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$"), _hex(original, digest))
            .when(kind.startswith("given:"), _given(kind, digest, attempt))
            .when(kind.startswith("surname:"), _surname(kind, digest))
            .when(kind == "card", let(in_form, lambda x: _checked(original, x)))
            .otherwise(F.concat(in_form, last))
        )

    return let(_digest(key, kind, canonical, attempt), drawn)


def _as_canonical(kind: Column, text: Column) -> Column:
    return F.when(kind.rlike("^(?:mail|hex|address6|given|surname)"), F.lower(text)).otherwise(text)


def redrawn(entities: DataFrame, key: str) -> DataFrame:
    """(kind, canonical, attempt) of the entities whose first surrogate was taken, with the attempt that is not.

    ``entities`` has the distinct (kind, canonical). An attempt is taken by another entity's accepted one, by a
    lesser entity of the same attempt, or by an entity of the texts.
    """
    known = written(entities, "entities")
    pending, accepted, out, attempt = known, None, [], 0
    while True:
        drawn = surrogate(key, F.col("kind"), F.col("canonical"), F.col("canonical"), F.lit(attempt))
        named = pending.withColumn("drawn", _as_canonical(F.col("kind"), drawn))
        first = named.groupBy("kind", "drawn").agg(F.min("canonical").alias("canonical"))
        first = first.join(known.select("kind", F.col("canonical").alias("drawn")), ["kind", "drawn"], "left_anti")
        if accepted is not None:
            first = first.join(accepted, ["kind", "drawn"], "left_anti")
        first = written(first, "accepted")
        accepted = first.select("kind", "drawn") if accepted is None else accepted.unionByName(first.select("kind", "drawn"))
        if attempt:
            out.append(first.select("kind", "canonical", F.lit(attempt).alias("attempt")))
        pending = written(pending.join(first.select("kind", "canonical"), ["kind", "canonical"], "left_anti"), "pending")
        if pending.isEmpty():
            break
        attempt += 1
    if not out:
        return known.select("kind", "canonical", F.lit(0).alias("attempt")).where(F.lit(False))
    found = out[0]
    for part in out[1:]:
        found = found.unionByName(part)
    return written(found, "redrawn")


def replace(df: DataFrame, key: str, text: str = "text", counter: str | None = None) -> DataFrame:
    """The rows with surrogates in their texts; ``counter`` names one more column, the entities replaced."""
    names = {k: free_name(df.columns, f"__{k}") for k in ("row", "pieces", "again")}
    counted = lambda n: [n.cast("long").alias(counter)] if counter else []
    body = F.col(text)
    maybe = F.coalesce(body.rlike(HINT) & body.rlike(ENTITY), F.lit(False))
    clean = df.where(~maybe).select(*df.columns, *counted(F.lit(0)))

    between = F.transform(F.split(body, ENTITY, -1), lambda t: F.array(_piece(F.lit(None).cast("string"), t, F.lit(None).cast("string"))))
    entities = F.transform(F.regexp_extract_all(body, F.lit(ENTITY), F.lit(0)), _pieces)
    # A text between two entities, then the entity; the last text has none after it.
    pieces = F.flatten(F.zip_with(between, entities, lambda a, b: F.concat(a, F.coalesce(b, F.array().cast(f"array<{_PIECE}>")))))
    found = df.where(maybe).withColumn(names["row"], F.monotonically_increasing_id())
    found = found.withColumn(names["pieces"], let(pieces, _with_names_alone))
    found = written(found, "with-entities")

    listed = F.explode(F.filter(names["pieces"], lambda p: p["kind"].isNotNull())).alias("p")
    distinct = found.select(listed).select("p.kind", "p.canonical").distinct()
    again = redrawn(distinct, key)
    attempts = F.lit(None).cast("array<struct<at:int,attempt:int>>")
    if not again.isEmpty():
        places = found.select(names["row"], F.posexplode(names["pieces"]).alias("at", "p")).where("p.kind is not null")
        places = places.select(names["row"], "at", "p.kind", "p.canonical").join(again, ["kind", "canonical"])
        places = places.groupBy(names["row"]).agg(F.collect_list(F.struct("at", "attempt")).alias(names["again"]))
        found = found.join(places, names["row"], "left")
        attempts = F.col(names["again"])

    def shown(piece: Column, at: Column) -> Column:
        own = F.get(F.filter(attempts, lambda x: x["at"] == at), F.lit(0))["attempt"]
        drawn = surrogate(key, piece["kind"], piece["original"], piece["canonical"], F.coalesce(own, F.lit(0)))
        return F.when(piece["kind"].isNull(), piece["original"]).otherwise(drawn)

    new = F.array_join(F.transform(names["pieces"], shown), "")
    number = F.size(F.filter(names["pieces"], lambda p: p["kind"].isNotNull()))
    replaced = found.select(*(new.alias(text) if c == text else F.col(c) for c in df.columns), *counted(number))
    return clean.unionByName(replaced)
