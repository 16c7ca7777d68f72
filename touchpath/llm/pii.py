"""Personal data replaced by surrogates.

Detected entities (mail, IPv4 and IPv6 addresses, card, phone and social security numbers, access keys, and names after a
form of address) get replacements of their own type: digits stay digits, letters letters, separators stay, a card
number has a right check digit, a name keeps its gender and script. A replacement is a keyed function of the entity's
plain form, so that one entity has one replacement throughout, however it is written and wherever it stands.

Detected telephone numbers are international ones (+ or 00) and the national forms of North America, France, Germany,
Spain and Russia, with or without separators; a number of nine to eleven digits in these forms is taken for one.
Not detected: names without a form of address, postal addresses, dates of birth, local numbers without area code,
national forms of other countries, Spanish landlines in one piece, bank account and passport numbers, MAC addresses.
One number written with and without its country's prefix is one entity only where the last ten digits are the same; digits before those stay.

Each word of a name has its replacement, so that "Mr John Smith" and "Mr Smith" stay one person; a surname keeps its stem
after forms of address of either gender.

Distinct entities shall have distinct replacements, and none may be an entity that occurs. The distinct entities are a
written table with their replacements; all are compared, and whoever collides, but for the first, gets that of another
attempt, until none does. Later attempts choose among more replacements (longer ones), so that a free one is always
found. The texts are searched once and put together again from the pieces between entities. Only DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchpath.llm.common import bound, unused, written

# fixed values: forms of address, with the gender they tell
MEN = ("Mr", "Sir", "Herr", "Monsieur", "Señor", "Sr", "господин")
WOMEN = ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "госпожа")
EITHER = ("Mx", "Dr", "Prof", "Professor", "Doctor", "Dott", "Dra", "Maître", "доктор", "профессор")

_HEX = "[0-9A-Fa-f]{1,4}"
_PHONES = (
    r"(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)|\d{2,4})[ .-]\d{3,4}[ .-]\d{4}",
    r"(?:\+|00)[1-9]\d{7,14}",  # international, in one piece or in groups
    r"(?:\+|00)(?=(?:[ ./()-]{0,2}\d){8})[1-9]\d{0,2}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{1,4}(?:[ ./-]?\d{2,8}){1,4}",
    r"(?:1[ .-]?)?(?:\([2-9]\d{2}\)[ .-]?|[2-9]\d{2}[ .-]?)[2-9]\d{2}[ .-]?\d{4}",  # North America
    r"\([2-9]\d{2}\)\d{3}[ .-]?\d{4}",
    r"0[1-9](?:[ .-]?\d{2}){4}",  # France
    r"(?:\(0[1-9]\d{1,4}\) ?|0[1-9]\d{1,4}[ /-])\d{4,8}(?:[ -]\d{1,5})?",  # Germany, in groups or one piece
    r"0[1-9]\d{1,4}[ /-]\d{2,4}(?: \d{2,4}){1,3}|0[1-9]\d{8,10}",
    r"[6-9]\d{2}[ .-]\d{3}[ .-]\d{3}|[6-9]\d{2}(?:[ .-]\d{2}){3}|9\d(?:[ .-]\d{3})(?:[ .-]\d{2}){2}|[67]\d{8}",  # Spain
    r"8[ -]?(?:\(\d{3}\)|\d{3})[ -]?\d{3}[ -]?\d{2}[ -]?\d{2}",  # Russia
)

_NAME = r"\p{Lu}\p{Ll}+(?:-\p{Lu}\p{Ll}+)?"
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip6": rf"(?<![\w:.])(?=[0-9A-Fa-f:]*\d)(?:(?:{_HEX}:){{7}}{_HEX}|(?:{_HEX}:){{1,6}}(?::{_HEX}){{1,6}}|(?:{_HEX}:){{1,7}}:|::{_HEX}(?::{_HEX}){{0,6}})(?![\w:]|\.\d)",
    "ip": r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\w]|\.\d)",
    "card": r"(?<![\w-])\d{4}(?:([ -]?)\d{4}\1\d{4}\1\d{4}|[ -]?\d{6}[ -]?\d{5})(?![\w-])",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "phone": rf"(?<![\w+])(?:{'|'.join(_PHONES)})(?![\w-])",
    "key": r"(?<![A-Za-z0-9])(?:AKIA[0-9A-Z]{16}|[0-9a-f]{40}|(?<=password=)\S+|(?<=token=)\S+)(?![A-Za-z0-9])",
    "name": rf"(?<=\b(?:{'|'.join(MEN + WOMEN + EITHER)})\.? ){_NAME}(?: {_NAME})?",
}
_ANY = "|".join(f"(?:{pattern})" for pattern in PATTERNS.values())
# texts without one of these have no entity
_HINT = rf"[0-9@]|password=|token=|(?:{'|'.join(MEN + WOMEN + EITHER)})\.? \p{{Lu}}"

_LATIN = "ba be bi bo da de di do fa fe ga go ha he ja jo ka ko la le li lo ma me mi mo na ne ni no pa pe ra re ri ro sa se ta te ti to va vi".split()
_CYRILLIC = "ба бе би бо ва ве ви во га го да де ди до ка ке ки ко ла ле ли ло ма ме ми мо на не ни но па по ра ре ри ро са се та те ти то".split()

_CAPITALS = "АБВГДЕЖЗИЙКЛМНОПРСТУФХЦЧШЩЪЫЬЭЮЯ"


def matches_of(text: Column) -> Column:
    return F.when(text.rlike(_HINT), F.regexp_extract_all(text, F.lit(_ANY), F.lit(0))).otherwise(
        F.array().cast("array<string>")
    )


def _is(kind: str, entity: Column) -> Column:
    if kind in ("ip6", "ip", "card", "ssn", "phone"):  # their patterns look around; here the entity stands alone
        return entity.rlike(f"^(?:{PATTERNS[kind]})$")
    if kind == "email":
        return entity.rlike(f"^{PATTERNS[kind]}$")
    return entity.rlike(r"[0-9]|^\S{12,}$")


def kind_of(entity: Column) -> Column:
    kind = F.when(_is("email", entity), "email")
    for name in ("ip6", "ip", "card", "ssn", "phone"):
        kind = kind.when(_is(name, entity), name)
    name = entity.rlike(rf"^{_NAME}(?: {_NAME})?$")
    return kind.when(name, "name").otherwise("key")


def _groups_of(address: Column) -> Column:
    """The eight groups of an IPv6 address, without leading zeros."""
    halves = F.split(F.lower(address), "::")
    some = lambda half: F.filter(F.split(F.coalesce(half, F.lit("")), ":"), lambda g: g != "")
    one, other = some(F.get(halves, F.lit(0))), some(F.get(halves, F.lit(1)))
    zeros = F.array_repeat(F.lit("0"), F.lit(8) - F.size(one) - F.size(other))
    return F.array_join(F.transform(F.concat(one, zeros, other), lambda g: F.regexp_replace(g, "^0+(?=.)", "")), ":")


def plain_form(kind: Column, entity: Column) -> Column:
    """What entities that differ only in writing have in common."""
    digits = F.regexp_replace(entity, r"\D", "")
    return (
        F.when(kind.isin("card", "ssn"), digits)
        .when(kind == "phone", F.substring(digits, -10, 10))
        .when(kind == "email", F.lower(entity))
        .when(kind == "ip6", _groups_of(entity))
        .otherwise(entity)
    )


def _stream(secret: str, kind: Column, plain: Column, attempt: Column) -> Column:
    """128 hexadecimal digits that depend on the key and the entity."""
    return F.sha2(F.concat_ws("|", F.lit(secret), kind, plain, attempt.cast("string")), 512)


def _number(stream: Column, at: Column | int, below: int) -> Column:
    place = at if isinstance(at, Column) else F.lit(at)
    return F.conv(F.substring(stream, F.pmod(place, F.lit(30)) * 4 + 1, F.lit(4)), 16, 10).cast("int") % below


def _pick(choices: list[str], number: Column) -> Column:
    return F.get(F.array(*map(F.lit, choices)), number)


def _recast(entity: Column, stream: Column) -> Column:
    """Letters for letters and digits for digits, in their case; everything else stays. Cyrillic stays Cyrillic, letters
    of other scripts become Latin; so does everything where there is no letter and no digit."""
    characters = F.filter(F.split(entity, ""), lambda c: c != "")
    bare = ~entity.rlike(r"[\p{L}\p{N}]")

    def change(c: Column, i: Column) -> Column:
        return (
            F.when(c.rlike("[0-9]"), _number(stream, i, 10).cast("string"))
            .when(c.rlike("[a-z]"), F.char(_number(stream, i, 26) + 97))
            .when(c.rlike("[A-Z]"), F.char(_number(stream, i, 26) + 65))
            .when(c.rlike(r"(?=\p{IsCyrillic})\p{Lu}"), F.substring(F.lit(_CAPITALS), _number(stream, i, 32) + 1, F.lit(1)))
            .when(c.rlike(r"\p{IsCyrillic}"), F.substring(F.lit(_CAPITALS.lower()), _number(stream, i, 32) + 1, F.lit(1)))
            .when(c.rlike(r"\p{N}"), _number(stream, i, 10).cast("string"))
            .when(bare | c.rlike(r"\p{L}"), F.char(_number(stream, i, 26) + 97))
            .otherwise(c)
        )

    return F.array_join(F.transform(characters, change), "")


def _more(stream: Column, attempt: Column) -> Column:
    """What later attempts append: nothing up to the third, then 8 hexadecimal digits, 4 more each time, 28 at most."""
    return F.when(attempt > 3, F.substring(stream, F.lit(101), F.least(attempt * 4 - 8, F.lit(28)))).otherwise("")


def _digits_from(entity: Column, digits: Column, kept: Column) -> Column:
    """The digits of ``entity`` replaced by ``digits``, aligned at the end, the first ``kept`` left."""
    characters = F.filter(F.split(entity, ""), lambda c: c != "")
    start = F.struct(F.lit("").alias("text"), F.lit(0).alias("seen"))
    total = F.length(F.regexp_replace(entity, r"\D", ""))

    def step(state: Column, c: Column) -> Column:
        place = F.length(digits) - total + state["seen"] + 1
        new = F.when(state["seen"] < kept, c).otherwise(F.substring(digits, place, F.lit(1)))
        is_digit = c.rlike("[0-9]")
        return F.struct(
            F.concat(state["text"], F.when(is_digit, new).otherwise(c)).alias("text"),
            (state["seen"] + F.when(is_digit, 1).otherwise(0)).alias("seen"),
        )

    return F.aggregate(characters, start, step, lambda state: state["text"])


def _random_digits(stream: Column, count: int) -> Column:
    return F.concat(*[_number(stream, i, 10).cast("string") for i in range(count)])


def _check_digit(digits: Column) -> Column:
    """Last digit of a card number, from those before."""
    numbers = F.transform(F.filter(F.split(F.reverse(digits), ""), lambda c: c != ""), lambda c: c.cast("int"))

    def weigh(d: Column, i: Column) -> Column:
        double = d * 2
        return F.when(i % 2 == 1, d).otherwise(F.when(double > 9, double - 9).otherwise(double))

    total = F.aggregate(F.transform(numbers, weigh), F.lit(0), lambda a, b: a + b)
    return ((10 - total % 10) % 10).cast("string")


def surrogate(secret: str, kind: Column, gender: Column, entity: Column, attempt: Column) -> Column:
    """The replacement of an entity on a given attempt. ``gender`` is m, f or null, of names only."""

    def by_stream(stream: Column) -> Column:
        digits = bound(F.regexp_replace(entity, r"\D", ""), lambda d: _number_like(kind, entity, d, stream))
        # a text of ten digits and separators has few forms: later attempts append digits. No table fills those of cards
        spare = F.when(attempt > 7, F.translate(_more(stream, attempt), "abcdef", "012345")).otherwise("")
        digits = F.when(kind == "card", digits).otherwise(F.concat(digits, spare))
        ip = F.concat_ws(".", *[(_number(stream, i, 223) + 1).cast("string") for i in range(4)])
        long = F.concat_ws(":", F.lit("2001:db8"), *[F.substring(stream, 4 * i + 1, 4) for i in range(6)])
        ip = F.when((kind == "ip6") | (attempt > 7), long).otherwise(ip)
        choice = F.when(kind.isin("card", "ssn", "phone"), digits).when(kind.isin("ip", "ip6"), ip)
        name = _name(entity, gender, stream, attempt)
        choice = choice.when(kind == "email", _email(entity, stream, attempt)).when(kind == "name", name)
        same = F.when(entity.rlike("^[0-9a-f]{16,128}$"), F.substring(stream, F.lit(1), F.length(entity)))
        same = same.when(entity.startswith("AKIA"), F.concat(F.lit("AKIA"), _recast(F.substring(entity, 5, 1000), stream)))
        return choice.otherwise(F.concat(same.otherwise(_recast(entity, stream)), _more(stream, attempt)))

    return bound(_stream(secret, kind, plain_form(kind, entity), attempt), by_stream)


def _number_like(kind: Column, entity: Column, digits: Column, stream: Column) -> Column:
    """Card numbers keep their first digit, phone numbers their country; social security numbers begin with 9."""

    def made(random: Column) -> Column:
        body = F.concat(F.substring(digits, 1, 1), F.substring(random, F.lit(1), F.length(digits) - 2))
        card = bound(body, lambda b: F.concat(b, _check_digit(b)))
        new = F.when(kind == "card", card).when(kind == "ssn", F.concat(F.lit("9"), F.substring(random, 1, 8)))
        kept = F.when(kind == "phone", F.greatest(F.length(digits) - 10, F.lit(0))).otherwise(F.lit(0))
        return bound(F.struct(new.otherwise(random).alias("new"), kept.alias("kept")), lambda x: _digits_from(entity, x["new"], x["kept"]))

    return bound(_random_digits(stream, 15), made)


def _email(entity: Column, stream: Column, attempt: Column) -> Column:
    local, domain = F.substring_index(F.lower(entity), "@", 1), F.substring_index(F.lower(entity), "@", -1)
    longer = _more(stream, attempt)  # a short address may have no free replacement of its length
    other = bound(F.reverse(stream), lambda back: _recast(F.substring_index(domain, ".", 1), back))
    return F.concat(_recast(local, stream), longer, F.lit("@"), other, F.lit(".example.org"))


def _name(entity: Column, gender: Column, stream: Column, attempt: Column) -> Column:
    """Words of three syllables, and of one more with each attempt up to ten."""

    def one(part: Column, i: Column) -> Column:
        def syllables(choices: list[str]) -> Column:
            picked = [_pick(choices, _number(stream, i * 5 + j, len(choices))) for j in range(3)]
            places = F.sequence(F.lit(3), F.least(attempt, F.lit(7)) + 2)
            more = F.array_join(F.transform(places, lambda j: _pick(choices, _number(stream, i * 5 + j, len(choices)))), "")
            return F.concat(*picked, F.when(attempt > 0, more).otherwise(""))

        latin = F.concat(syllables(_LATIN), F.when(gender == "f", F.lit("na")).otherwise(F.lit("r")))
        cyrillic = F.concat(syllables(_CYRILLIC), F.when(gender == "f", F.lit("на")).otherwise(F.lit("р")))
        return F.initcap(F.when(part.rlike(r"\p{IsCyrillic}"), cyrillic).otherwise(latin))

    return F.array_join(F.transform(F.split(entity, " "), one), " ")


def _gender(before: Column) -> Column:
    """Gender by the form of address that ends the text before a name."""
    return F.when(before.rlike(rf"\b(?:{'|'.join(WOMEN)})\.? $"), "f").when(before.rlike(rf"\b(?:{'|'.join(MEN)})\.? $"), "m")


def _with_pieces(documents: DataFrame, name: str) -> DataFrame:
    """``documents``, written, with what one reading of the texts finds in the column ``name``: a number of the row, the
    entities, and the pieces of text around them, which then stand for the text."""
    found = documents.withColumn(name, matches_of(F.col("text")))
    pieces = F.when(F.size(name) > 0, F.split("text", _ANY))
    row = F.monotonically_increasing_id()  # fixed by being written
    parts = F.struct(row.alias("row"), F.col(f"`{name}`").alias("entities"), pieces.alias("pieces"))
    found = found.withColumn(name, parts)
    return written(found.withColumn("text", F.when(F.size(f"{name}.entities") == 0, F.col("text"))), "pieces")


def occurrences(texts: DataFrame) -> DataFrame:
    """``row, place, part, kind, gender, entity`` of ``row, entities, pieces``: each word of a name is an entity of its own,
    so that a person keeps the surname however much of the name is said. ``gender`` is empty where it is not told."""

    def occurrence(entity: Column, i: Column) -> Column:
        return F.struct(entity.alias("entity"), F.right(F.get(F.col("pieces"), i), F.lit(12)).alias("before"))

    each = texts.select("row", F.posexplode(F.transform("entities", occurrence)).alias("place", "o"))
    kinds = each.select("row", "place", kind_of(F.col("o.entity")).alias("kind"), "o.entity", "o.before")
    words = F.when(F.col("kind") == "name", F.split("entity", " ")).otherwise(F.array("entity"))
    gender = F.when(F.col("kind") == "name", _gender(F.col("before")))
    told = kinds.select("row", "place", "kind", F.coalesce(gender, F.lit("")).alias("gender"), words.alias("words"))
    return told.select("row", "place", "kind", "gender", F.posexplode("words").alias("part", "entity"))


def _made(secret: str, forms: DataFrame) -> DataFrame:
    made = surrogate(secret, F.col("kind"), F.col("gender"), F.col("entity"), F.col("attempt"))
    return forms.select("who", "kind", "gender", "plain", "entity", "attempt", made.alias("new"))


def replacements(found: DataFrame, secret: str) -> DataFrame:
    """``kind, gender, entity, new``, written: the final replacement of each distinct entity in ``occurrences``.

    Replacements are compared by their plain forms. Of several entities with the same one the first keeps it (one from
    an earlier attempt before later ones, then by name), and nobody keeps what is an entity that occurs; the others
    get those of another attempt, until all differ. A name that occurs with several genders has a replacement for
    each, and all of them are compared.
    """
    forms = found.select("kind", "gender", "entity").distinct()
    forms = forms.withColumn("plain", plain_form(F.col("kind"), F.col("entity")))
    forms = forms.withColumn("who", F.concat_ws("|", "kind", "gender", "plain")).withColumn("attempt", F.lit(0))
    made, attempt = written(_made(secret, forms), "replacements"), 0
    while True:
        first = made.groupBy("who", "kind", "plain", "attempt").agg(F.min(F.struct("entity", "new")).alias("m"))
        new = first.select("who", "kind", "plain", "attempt", plain_form(F.col("kind"), F.col("m.new")).alias("new"))
        owner = new.groupBy("kind", "new").agg(F.count("*").alias("n"), F.min(F.struct("attempt", "plain")).alias("owner"))
        taken = owner.where("n > 1").select("kind", "new", F.col("owner.plain").alias("keeps"))
        twice = new.join(taken, ["kind", "new"]).where("plain <> keeps").select("who")
        real = new.join(made.select("kind", F.col("plain").alias("new")).distinct(), ["kind", "new"], "left_semi")
        attempt += 1
        again = twice.unionAll(real.select("who")).distinct().withColumn("attempt", F.lit(attempt))
        again = written(again, "again")
        if again.isEmpty():
            return made.select("kind", "gender", "entity", "new")
        kept = made.join(again.select("who"), "who", "left_anti")
        other = _made(secret, made.drop("attempt").join(again, "who"))
        made = written(kept.unionByName(other), "replacements")


def replace(documents: DataFrame, secret: str = "touchpath") -> DataFrame:
    """``documents`` with the entities in their texts replaced and ``n_replaced`` after the columns.

    A null or empty text stays as it is. Equal texts get equal results; repeated rows stay; other columns are carried
    along, but for one named n_replaced, which is replaced. An empty table gives an empty table. Who knows
    ``secret`` can recompute replacements: keep it apart.

    The texts are searched once. Only those with entities are shuffled, to meet their replacements.
    """
    plain = documents.drop("n_replaced")
    held, row, new = (unused(plain, name) for name in ("_held", "_row", "_new"))
    texts = _with_pieces(plain, held)
    size = F.size(f"{held}.entities")
    found = written(occurrences(texts.where(size > 0).select(f"{held}.*")), "occurrences")
    told = found.join(replacements(found, secret), ["kind", "gender", "entity"])
    # no more entries than a text has entities
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "new"))), lambda p: p["new"]), " ")
    places = told.groupBy("row", "place").agg(whole.alias("new"))
    by_row = places.groupBy(F.col("row").alias(row)).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("place", "new"))), lambda p: p["new"]).alias(new)
    )
    changed = texts.where(size > 0).join(by_row, F.col(f"{held}.row") == F.col(row), "left")
    parts = F.transform(
        f"{held}.pieces", lambda piece, i: F.concat(piece, F.coalesce(F.get(F.col(new), i), F.lit("")))
    )
    columns = [F.col(f"`{name}`") for name in plain.columns]
    changed = changed.withColumn("text", F.array_join(parts, "")).select(*columns, size.alias("n_replaced"))
    return texts.where(size == 0).select(*columns, size.alias("n_replaced")).unionByName(changed)
