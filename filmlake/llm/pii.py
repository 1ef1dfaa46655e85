"""Personal data replaced by keyed surrogates of the same kind and form, DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filmlake.session import materialize

from .common import as_scan, locator, unused

KEY = "filmlake"
MOST_ATTEMPTS = 60
# From this attempt on, surrogates are drawn from more values than look like the mention at best.
WIDER = 4

# Titles and given names by gender, and the syllables of made-up surnames, by script.
TITLES = {
    "m": "Mr Herr Monsieur Señor Sr Don господин".split(),
    "f": "Mrs Ms Miss Frau Madame Mme Señora Sra Doña госпожа".split(),
}
GIVEN = {
    ("m", "latin"): "James John Robert Michael William David Thomas Peter Paul Hans Jürgen Klaus "
    "Pierre Jean Jacques Carlos José Miguel".split(),
    ("f", "latin"): "Mary Anna Maria Julia Sarah Emma Laura Linda Ursula Sabine Monika Marie Claire "
    "Sophie Carmen Lucía Isabel Elena".split(),
    ("m", "cyrillic"): "Иван Сергей Дмитрий Алексей Николай Павел Андрей".split(),
    ("f", "cyrillic"): "Анна Мария Елена Ольга Наталья Татьяна Ирина".split(),
}
SYLLABLES = {
    "latin": "bar bel bor cal car cor dal den dor fal fer gar gen hal har hol kan kel kor lan len "
    "lor mal mar mer nal nor pal per ral ren ros sal ser sol tal ter tor val ver vor wal wen".split(),
    "cyrillic": "бар бел бор вал вер гор дал дор зан кал кор лан лен мар мер нор пал рос сал сер "
    "тар тер тор фал".split(),
}

_EVERY_TITLE = "|".join(t for names in TITLES.values() for t in names)
_EVERY_GIVEN = "|".join(n for names in GIVEN.values() for n in names)
_CAPITALISED = r"\p{Lu}\p{Ll}+"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"

# What each kind looks like, in the order in which they are tried.
KINDS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@(?:[A-Za-z0-9-]{1,63}\.){1,8}"
    r"[A-Za-z]{2,24}(?![A-Za-z0-9])",
    "secret": r"(?<![A-Za-z0-9])(?i:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key)"
    r"""\s{0,2}[=:]\s{0,2}["']?(?=[A-Za-z+/_-]{0,64}\d)[A-Za-z0-9+/_-]{6,}""",
    "access_key": r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[0-9A-Z]{16}(?![A-Za-z0-9])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ip": rf"(?<![\w.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\w|\.\d)",
    "card": r"(?<![\w.+-])(?:\d{4}([ -]?)\d{4}\1\d{4}\1\d{1,7}|3\d{3}[ -]?\d{6}[ -]?\d{5})(?![\w-])",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "phone": r"(?<![\w.])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){2,4}"
    r"|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4})(?![\w-])",
    "person": rf"(?<!\p{{L}})(?=\p{{Lu}}|г)(?:(?:{_EVERY_TITLE})\.? {_CAPITALISED}(?: {_CAPITALISED})?"
    rf"|(?:{_EVERY_GIVEN}) {_CAPITALISED})(?!\p{{L}})",
}


def _numbered(kinds: dict[str, str]) -> str:
    """All kinds as one pattern; the only back reference is the separator inside a card number."""
    return "|".join(pattern.replace(r"([ -]?)", r"(?<sep>[ -]?)").replace(r"\1", r"\k<sep>") for pattern in kinds.values())


PATTERN = _numbered(KINDS)


# Every kind but a person holds a digit, an at sign or the start of an access key.
BEYOND_PERSONS = "[0-9@]|AKIA|ASIA"


def by_pattern(text: Column, made) -> Column:
    """``made(pattern)`` with the pattern a text is searched by: that of persons where no other kind can be."""
    return F.when(text.rlike(BEYOND_PERSONS), made(PATTERN)).otherwise(made(KINDS["person"]))


def mentions(text: Column) -> Column:
    """Every mention of personal data in the text, in order."""
    return by_pattern(text, lambda pattern: F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))


def kind_of(mention: Column) -> Column:
    """The kind of a mention: the first whose pattern matches it whole."""
    chosen = F.lit("other")
    for kind, pattern in reversed(KINDS.items()):
        chosen = F.when(mention.rlike(f"^(?:{pattern})$"), F.lit(kind)).otherwise(chosen)
    return chosen


def parts_of(kind: Column, mention: Column) -> Column:
    """(kind, value) of the parts that get surrogates of their own.

    A person is a title, a given name and a surname, so that "Mr. Smith" and "John Smith" stay the
    same Smith; a secret is its name and its value; anything else is one part.
    """
    script = F.when(mention.rlike(r"\p{IsCyrillic}"), F.lit("cyrillic")).otherwise(F.lit("latin"))
    plain = lambda part: F.regexp_replace(part, r"\.$", "")

    def person_part(part: Column) -> Column:
        chosen = F.concat(F.lit("surname."), script)
        for (gender, of), names in GIVEN.items():
            chosen = F.when(part.isin(names), F.lit(f"given.{gender}.{of}")).otherwise(chosen)
        every = [t for names in TITLES.values() for t in names]
        return F.struct(
            F.when(plain(part).isin(every), F.lit("kept")).otherwise(chosen).alias("kind"),
            part.alias("value"),
        )

    name = F.regexp_extract(mention, r"""^.*?[=:]\s{0,2}["']?""", 0)
    secret = F.array(
        F.struct(F.lit("kept").alias("kind"), name.alias("value")),
        F.struct(
            F.lit("secret").alias("kind"),
            F.substr(mention, F.length(name) + 1).alias("value"),
        ),
    )
    return (
        F.when(kind == "person", F.transform(F.split(mention, " "), person_part))
        .when(kind == "secret", secret)
        .otherwise(F.array(F.struct(kind.alias("kind"), mention.alias("value"))))
    )


NUMBERS = ("card", "ssn", "phone")


def canonical(kind: Column, value: Column) -> Column:
    """What two mentions of one entity share: the digits of a number, else the text in lower case."""
    return (
        F.when(kind.isin(*NUMBERS), F.regexp_replace(value, r"\D", ""))
        .when(kind == "iban", F.regexp_replace(value, " ", ""))
        .when(kind.isin("secret", "access_key"), value)
        .otherwise(F.lower(value))
    )


def _byte(digest: Column, at: Column) -> Column:
    """A number from 0 to 255 out of a hexadecimal digest, cyclic, shifted at each turn."""
    turn = F.floor(at / 64).cast("int")
    raw = F.conv(F.substr(digest, (2 * (at % 64) + 1).cast("int"), F.lit(2)), 16, 10).cast("int")
    return (raw + 89 * turn) % 256


def _pick(digest: Column, at: int, choices: list[str]) -> Column:
    value = F.conv(F.substr(digest, F.lit(at), F.lit(6)), 16, 10).cast("int")
    return F.element_at(F.array(*map(F.lit, choices)), (value % len(choices) + 1).cast("int"))


def _made_up(digest: Column, count: Column, choices: list[str]) -> Column:
    """``count`` syllables, 16 at most."""
    syllables = F.array(*map(F.lit, choices))

    def syllable(at: Column) -> Column:
        number = F.conv(F.substr(digest, (8 * at + 1).cast("int"), F.lit(6)), 16, 10).cast("int")
        return F.element_at(syllables, (number % len(choices) + 1).cast("int"))

    return F.array_join(F.transform(F.sequence(F.lit(0), F.least(count, F.lit(16)) - 1), syllable), "")


def _same_classes(value: Column, digest: Column, letters: str) -> Column:
    """Each digit becomes a digit and each letter a letter of ``letters``, case kept."""

    def swap(char: Column, at: Column) -> Column:
        n = _byte(digest, at)
        letter = F.substr(F.lit(letters), (n % len(letters) + 1).cast("int"), F.lit(1))
        return (
            F.when(char.rlike("[0-9]"), (n % 10).cast("string"))
            .when(char.rlike("[a-z]"), letter)
            .when(char.rlike("[A-Z]"), F.upper(letter))
            .otherwise(char)
        )

    return F.array_join(F.transform(F.split(value, ""), swap), "")


ALPHABET = "abcdefghijklmnopqrstuvwxyz"


def _digits(value: Column, digest: Column, free: Column | None = None, more: Column | None = None) -> Column:
    """As many digits and ``more``; the first stays and the second is 2 to 9, unless all are ``free``."""
    count = F.length(value) + (F.lit(0) if more is None else more)
    bound = F.lit(True) if free is None else ~free

    def digit(at: Column) -> Column:
        n = _byte(digest, at)
        return (
            F.when(bound & (at == 0), F.substr(value, F.lit(1), F.lit(1)))
            .when(bound & (at == 1), (n % 8 + 2).cast("string"))
            .otherwise((n % 10).cast("string"))
        )

    return F.array_join(F.transform(F.sequence(F.lit(0), count - 1), digit), "")


def _luhn(number: Column) -> Column:
    """The checksum of a card number, 0 for a valid one."""
    digits = F.transform(F.split(F.reverse(number), ""), lambda c: c.cast("int"))
    doubled = F.transform(
        digits,
        lambda d, at: F.when(at % 2 == 1, F.when(d > 4, 2 * d - 9).otherwise(2 * d)).otherwise(d),
    )
    return F.aggregate(doubled, F.lit(0), lambda a, b: a + b) % 10


def surrogate(kind: Column, value: Column, digest: Column, attempt: Column) -> Column:
    """The canonical surrogate of a canonical value, from a hexadecimal SHA-512 of both and the key.

    Few values have the form of a short one, so they become more with the attempt: surnames get a
    syllable at each; e-mail addresses and secrets a character at each from WIDER / 2 on. From WIDER
    on all digits of a telephone or social security number are free, and from 2 * WIDER a telephone
    number gets more of them. An address of a private range is taken from the whole of it, then
    from 10.*, at last, like a public one, from everywhere. Cards, IBANs and access keys have over
    10 ** 10 values at once.
    """
    free = attempt >= WIDER
    added = F.greatest(attempt - (WIDER // 2 - 1), F.lit(0))
    number = _digits(value, digest)
    stem = F.concat(F.substr(number, F.lit(1), (F.length(number) - 1).cast("int")), F.lit("0"))
    last = ((10 - _luhn(stem)) % 10 + F.when(_luhn(value) == 0, 0).otherwise(1)) % 10
    card = F.concat(F.substr(stem, F.lit(1), (F.length(stem) - 1).cast("int")), last.cast("string"))

    octets = F.split(value, r"\.")
    private = value.rlike(r"^(?:10|127|192\.168|172\.(?:1[6-9]|2\d|3[01]))\.")
    kept = F.when(private & ~value.startswith("10.") & ~value.startswith("127."), 2).when(private, 1).otherwise(0)
    ip = F.array_join(
        F.transform(
            octets,
            lambda octet, at: F.when(at < kept, octet).when(
                at == 0, (_byte(digest, at) % 80 + 20).cast("string")
            ).otherwise((_byte(digest, at) % 254 + 1).cast("string")),
        ),
        ".",
    )
    octet = lambda at: _byte(digest, F.lit(at)).cast("string")
    ranged = F.when(
        value.startswith("172."), F.concat(F.lit("172."), (_byte(digest, F.lit(1)) % 16 + 16).cast("string"))
    ).otherwise(F.concat(F.lit("10."), octet(1)))
    ip = (
        F.when(attempt >= 2 * WIDER, F.concat_ws(".", (_byte(digest, F.lit(0)) % 223 + 1).cast("string"), octet(1), octet(2), octet(3)))
        .when(free & private, F.concat_ws(".", ranged, octet(2), octet(3)))
        .otherwise(ip)
    )
    local = F.substring_index(value, ".", -1)
    longer = lambda letters: _same_classes(F.repeat(F.lit(letters[0]), added), F.reverse(digest), letters)
    email = F.concat(
        longer(ALPHABET),
        _same_classes(F.substr(value, F.lit(1), (F.length(value) - F.length(local)).cast("int")), digest, ALPHABET),
        local,
    )
    hexadecimal = value.rlike("^[0-9a-f]+$")
    token = F.when(hexadecimal, F.concat(_same_classes(value, digest, "abcdef"), longer("abcdef"))).otherwise(
        F.concat(_same_classes(value, digest, ALPHABET), longer(ALPHABET))
    )
    prefixed = lambda n: F.concat(
        F.substr(value, F.lit(1), F.lit(n)), _same_classes(F.substr(value, F.lit(n + 1)), digest, ALPHABET)
    )
    chosen = (
        F.when(kind == "card", card)
        .when(kind == "ssn", _digits(value, digest, free))
        .when(kind == "phone", _digits(value, digest, free, F.greatest(attempt - (2 * WIDER - 1), F.lit(0))))
        .when(kind == "ip", ip)
        .when(kind == "email", email)
        .when(kind == "access_key", prefixed(4))
        .when(kind == "iban", prefixed(2))
        .otherwise(token)
    )
    for (gender, script), names in GIVEN.items():
        chosen = F.when(kind == f"given.{gender}.{script}", _pick(digest, 1, [n.lower() for n in names])).otherwise(chosen)
    for script, syllables in SYLLABLES.items():
        made = _made_up(digest, attempt + 3, syllables)
        ending = F.when(value.endswith("а"), F.lit("а")).otherwise(F.lit(""))
        chosen = F.when(kind == f"surname.{script}", F.concat(made, ending)).otherwise(chosen)
    return chosen


def _renamed(kind: Column, made: Column, attempt: Column, digest: Column) -> Column:
    """A given name that is taken gets syllables, since there are few of them."""
    return F.when(
        kind.startswith("given.") & (attempt > 0),
        F.concat(
            made,
            F.when(kind.endswith("cyrillic"), _pick(digest, 25, SYLLABLES["cyrillic"])).otherwise(
                _pick(digest, 25, SYLLABLES["latin"])
            ),
            F.when(attempt <= 3, F.lit(""))
            .when(kind.endswith("cyrillic"), _pick(digest, 33, SYLLABLES["cyrillic"]))
            .otherwise(_pick(digest, 33, SYLLABLES["latin"])),
        ),
    ).otherwise(made)


def surrogates(entities: DataFrame, key: str = KEY, most_attempts: int = MOST_ATTEMPTS) -> DataFrame:
    """(kind, value, surrogate) of distinct (kind, value): one to one, and no surrogate is a value.

    Each is made from a keyed hash. Where two entities got the same surrogate, or one that is a
    real value, all but the first try again with the next attempt in the hash, which has more values
    to draw from; the loop ends when nothing collides. It raises after ``most_attempts``, which only
    a table with a large share of all values that a form can have at all needs: of every IPv4 address,
    or of all numbers of nine digits. Only counts reach the driver.
    """

    def tried(df: DataFrame) -> DataFrame:
        digest = F.sha2(F.concat_ws("\x00", F.lit(key), "kind", "value", F.col("attempt").cast("string")), 512)
        hashed = df.select("kind", "value", "attempt", digest.alias("digest"))
        made = surrogate(F.col("kind"), F.col("value"), F.col("digest"), F.col("attempt"))
        return hashed.select(
            "kind",
            "value",
            "attempt",
            _renamed(F.col("kind"), made, F.col("attempt"), F.col("digest")).alias("surrogate"),
        )

    now = materialize(tried(entities.withColumn("attempt", F.lit(0))), "surrogates")
    for _ in range(most_attempts):
        first = Window.partitionBy("kind", "surrogate").orderBy("attempt", "value")
        real = now.select("kind", F.col("value").alias("surrogate")).withColumn("real", F.lit(True))
        judged = materialize(
            now.withColumn("place", F.row_number().over(first))
            .join(real, ["kind", "surrogate"], "left")
            .withColumn("bad", (F.col("place") > 1) | F.col("real").isNotNull()),
            "judged",
        )
        if judged.filter("bad").isEmpty():
            return now.select("kind", "value", "surrogate")
        again = tried(
            judged.filter("bad").select("kind", "value", (F.col("attempt") + 1).alias("attempt"))
        )
        settled = judged.filter("not bad").select("kind", "value", "attempt", "surrogate")
        now = materialize(settled.unionByName(again), "surrogates")
    raise ValueError("no distinct surrogates were found; a kind has too few possible values")


def _as_mentioned(kind: Column, value: Column, made: Column) -> Column:
    """The canonical surrogate in the form of the mention: its separators, its case."""
    digits = F.split(made, "")
    chars = F.split(value, "")
    # Each character's place among the digits before it.
    refilled = F.array_join(
        F.transform(
            chars,
            lambda char, at: F.when(
                char.rlike("[0-9]"),
                F.element_at(
                    digits,
                    F.length(F.regexp_replace(F.substr(value, F.lit(1), at + 1), r"\D", "")),
                ),
            ).otherwise(char),
        ),
        "",
    )
    # A surrogate may have more digits than the mention.
    refilled = F.concat(refilled, F.substr(made, F.length(F.regexp_replace(value, r"\D", "")) + 1))
    spaced = F.array_join(
        F.transform(
            chars,
            lambda char, at: F.when(char == " ", char).otherwise(
                F.element_at(digits, F.length(F.regexp_replace(F.substr(value, F.lit(1), at + 1), " ", "")))
            ),
        ),
        "",
    )
    cased = (
        F.when(F.upper(value) == value, F.upper(made))
        .when(F.lower(value) == value, made)
        .otherwise(F.concat(F.upper(F.substr(made, F.lit(1), F.lit(1))), F.substr(made, F.lit(2))))
    )
    return (
        F.when(kind.isin(*NUMBERS), refilled)
        .when(kind == "iban", spaced)
        .when(kind.isin("secret", "access_key", "ip"), made)
        .otherwise(cased)
    )


def replacements(found: DataFrame, key: str = KEY) -> DataFrame:
    """(mention, replacement) of every distinct mention in ``found`` (mention)."""
    parts = materialize(
        found.select("mention")
        .distinct()
        .withColumn("kind", kind_of(F.col("mention")))
        .select("mention", F.posexplode(parts_of(F.col("kind"), F.col("mention"))).alias("at", "part"))
        .select("mention", "at", "part.kind", F.col("part.value").alias("raw"))
        .withColumn("value", canonical(F.col("kind"), F.col("raw"))),
        "parts",
    )
    made = surrogates(parts.filter("kind <> 'kept'").select("kind", "value").distinct(), key)
    written = parts.join(made, ["kind", "value"], "left").select(
        "mention",
        "at",
        F.col("kind").startswith("given.") | F.col("kind").startswith("surname."),
        F.when(F.col("kind") == "kept", F.col("raw"))
        .otherwise(_as_mentioned(F.col("kind"), F.col("raw"), F.col("surrogate")))
        .alias("text"),
    ).toDF("mention", "at", "name", "text")
    return written.groupBy("mention").agg(
        F.array_sort(F.collect_list(F.struct("at", "text"))).alias("parts"),
        F.max("name").alias("name"),
    ).select(
        "mention",
        F.when(F.col("name"), F.array_join("parts.text", " "))
        .otherwise(F.array_join("parts.text", ""))
        .alias("replacement"),
    )


def pseudonymise(docs: DataFrame, text: str = "text", key: str = KEY) -> DataFrame:
    """``docs`` with every mention in ``text`` replaced, and a column n_mentions (long).

    Mentions are e-mail addresses, named secrets, access keys, IBANs, IPv4 addresses, card, social
    security and telephone numbers, and persons named with a title or a known given name. One
    entity gets one surrogate in all documents, different ones different surrogates, and no
    surrogate is a value that occurs; it keeps the mention's kind, separators, case, script and
    the gender of a name. Nothing else in a text changes, and a null text stays null. Repeated rows
    and null identifiers are rows like others; a column n_mentions of the input is replaced.
    """
    docs = as_scan(docs)
    columns = [c for c in docs.columns if c != "n_mentions"]
    whole = F.coalesce(F.col(text), F.lit(""))
    found = materialize(
        # The outer form keeps Spark from searching each text once more for a filter.
        docs.select(locator().alias("place"), F.posexplode_outer(mentions(whole)).alias("at", "mention"))
        .filter(F.col("mention").isNotNull()),
        "mentions",
    )
    swaps = found.join(replacements(found, key), "mention")
    filled = swaps.groupBy("place").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("at", "replacement"))), lambda x: x["replacement"]
        )
    )
    place, new = unused(docs, "place"), unused(docs, "new")
    placed = docs.select(locator().alias(place), *columns).join(
        filled.toDF(place, new), place, "left"
    )
    around = by_pattern(F.col(text), lambda pattern: F.split(F.col(text), pattern, -1))
    rebuilt = F.array_join(
        F.transform(around, lambda piece, at: F.concat(F.coalesce(F.get(F.col(new), at - 1), F.lit("")), piece)), ""
    )
    return placed.select(
        *(
            F.when(F.col(new).isNotNull(), rebuilt).otherwise(F.col(text)).alias(c) if c == text else F.col(c)
            for c in columns
        ),
        F.when(F.col(new).isNull(), 0).otherwise(F.size(new)).cast("long").alias("n_mentions"),
    )
