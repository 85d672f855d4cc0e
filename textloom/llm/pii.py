"""PII surrogates: keyed, type-consistent replacements, natively.

Entities are found by one alternation of patterns in one scan. A name is two
units, given name and family name; every other entity is one. A unit's
canonical form (case, spaces and punctuation removed as its type allows) and a
secret key give its surrogate, so all mentions of one unit agree in the whole
corpus: "Mr. John Smith", "Mr. Smith" and a later bare "Smith" get the same
family name. The surrogate keeps type, layout, script, gender of a given name,
country of a phone number or account, and the validity of check digits. A
corpus-wide check finds surrogates that two units share, or that are a unit of
the corpus themselves; these are drawn again until none is left.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._native import let, running_sum
from ._shared import discard, free_names, materialise, own

# Titles before a name.
FEMALE_TITLES = ["Mrs.", "Ms.", "Mrs", "Ms", "Frau", "Madame", "Mme", "Señora", "Госпожа", "Κυρία"]
MALE_TITLES = ["Mr.", "Mr", "Herr", "Monsieur", "Señor", "Господин", "Κύριος"]
# Given names that show a person without a title.
GIVEN = {
    "f": [
        "Alice", "Anna", "Barbara", "Camille", "Carmen", "Catherine", "Clara", "Claire", "Elena", "Elizabeth", "Emily", "Emma", "Eva", "Isabelle",
        "Julia", "Karen", "Katharina", "Laura", "Lena", "Linda", "Lucía", "Margaret", "Maria", "María", "Marie", "Mary", "Nora", "Olivia", "Patricia",
        "Paula", "Petra", "Rosa", "Sabine", "Sandra", "Sara", "Sarah", "Sophie", "Susan", "Ursula", "Vera",
        "Анна", "Вера", "Дарья", "Елена", "Ирина", "Ксения", "Мария", "Надежда", "Наталья", "Ольга", "Светлана", "Юлия",
        "Μαρία", "Ελένη", "Σοφία",
    ],
    "m": [
        "Adam", "Alexander", "Andreas", "Antonio", "Bruno", "Carlos", "Charles", "Daniel", "David", "Emil", "Felix", "François", "Hans", "Henri", "Hugo",
        "James", "Javier", "Jean", "John", "Jonas", "José", "Juan", "Jürgen", "Karl", "Klaus", "Leo", "Luis", "Martin", "Michael", "Miguel", "Oscar",
        "Paul", "Peter", "Pierre", "Robert", "Simon", "Stefan", "Thomas", "Victor", "Walter", "William",
        "Алексей", "Антон", "Борис", "Виктор", "Дмитрий", "Иван", "Михаил", "Никита", "Олег", "Павел", "Сергей", "Фёдор",
        "Γιώργος", "Νίκος", "Κώστας",
    ],
}
# Syllables of made-up names, and endings of given names.
SYLLABLES = {
    "latin": "ba be bo da de do fa ga go ha ka ko la le lo ma mi mo na ne no pa ra re ro sa so ta te to va vi",
    "cyrillic": "ба бе бо да де до за га го жа ка ко ла ле ло ма ми мо на не но па ра ре ро са со та те то ва ви",
    "greek": "βα βε βο γα γο δα δε δο κα κο λα λε λο μα μι μο να νε νο πα ρα ρε ρο σα σο τα τε το φα φι χα χο",
}
ENDINGS = {
    ("latin", "f"): "na la ra sa ia ina ella etta",
    ("latin", "m"): "n r s l d k o us",
    ("cyrillic", "f"): "на ла ра са ия ина ета ова",
    ("cyrillic", "m"): "н р с л д в к м",
    ("greek", "f"): "να λα ρα σα ία ίνα έλη ώνη",
    ("greek", "m"): "νος λος ρος σος δης κης τας ίας",
}
# Calling codes of one and of two digits; all others have three.
CODES_1 = "1 7"
CODES_2 = "20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98"

_WORD = r"\p{Lu}\p{L}*(?:['’-]\p{L}+){0,3}"
_END = r"(?![\p{L}\p{N}])"
#: What marks both ends of a match; texts that hold it are cut otherwise.
MARK = "\ufdd0"


def _any_of(words: list[str]) -> str:
    return "|".join(w.replace(".", r"\.") for w in sorted(words, key=lambda w: (-len(w), w)))


def patterns(given: dict[str, list[str]] = GIVEN) -> dict[str, str]:
    """Pattern of each entity type, in order of precedence.

    No group repeats without a small bound, so the depth of a match does not
    grow with the text: a host has at most 128 labels.
    """
    titles = _any_of(FEMALE_TITLES + MALE_TITLES)
    return {
        "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]+@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){0,126}\.[A-Za-z]{2,63}",
        "ip": r"(?=\d)(?<![\p{L}\p{N}.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\p{L}\p{N}]|\.\d)",
        "phone": r"(?=[+(\d])(?<![\p{L}\p{N}])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}|\(\d{3}\) ?\d{3}-\d{4}|\d{3}-\d{3}-\d{4})" + _END,
        "national": r"(?=\d)(?<![\p{L}\p{N}-])\d{3}-\d{2}-\d{4}(?![\p{L}\p{N}-])",
        "iban": r"(?=[A-Z])(?<![\p{L}\p{N}])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?" + _END,
        "card": r"(?=\d)(?<![\p{L}\p{N}])\d(?:[ -]?\d){12,18}" + _END,
        "name": rf"(?=\p{{Lu}})(?<![\p{{L}}\p{{N}}])(?:(?:{titles}) {_WORD}(?: {_WORD})?|(?:{_any_of(given['f'] + given['m'])}) {_WORD})" + _END,
    }


def _whole(p: str) -> str:
    return rf"\A(?:{p})\z"


def kind_of(match: Column, given: dict[str, list[str]] = GIVEN) -> Column:
    """Type of a match: the first pattern that fits all of it; a bare family
    name fits none."""
    out = F.lit("family")
    for name, p in reversed(list(patterns(given).items())):
        out = F.when(match.rlike(_whole(p)), F.lit(name)).otherwise(out)
    return out


def _tokens(text: Column, pattern: Column) -> Column:
    """Text between matches and matches in turn: [gap, match, gap, ..., gap],
    or null without a match.

    One pass puts marks around the matches, a second one cuts at the marks.
    """
    marked = let(F.regexp_replace(text, pattern, F.lit(MARK + "$0" + MARK)), lambda m: F.when(m.contains(MARK), F.split(m, MARK, -1)))
    by_hand = let(
        F.regexp_extract_all(text, pattern, F.lit(0)),
        lambda found: F.when(
            F.size(found) > 0,
            F.slice(
                F.flatten(F.zip_with(F.split(text, pattern, F.lit(-1)), F.concat(found, F.array(F.lit(""))), lambda gap, m: F.array(gap, m))),
                F.lit(1),
                2 * F.size(found) + 1,
            ),
        ),
    )
    return F.when(text.contains(MARK), by_hand).otherwise(marked)


def _matches(tokens: Column) -> Column:
    """The matches among tokens."""
    return F.transform(F.sequence(F.lit(1), F.size(tokens) - 1, F.lit(2)), lambda i: F.get(tokens, i))


_TITLE = rf"\A(?:{_any_of(FEMALE_TITLES + MALE_TITLES)}) "


def _bare(match: Column) -> Column:
    """A name without its title."""
    return F.regexp_replace(match, _TITLE, "")


def _family(match: Column) -> Column:
    return F.regexp_extract(_bare(match), r"\S+\z", 0)


def _given(match: Column) -> Column:
    """The given name, or empty: of two words, the first."""
    return F.regexp_extract(_bare(match), r"\A(\S+) \S", 1)


def _gender(match: Column, given: dict[str, list[str]]) -> Column:
    female = match.rlike(rf"\A(?:{_any_of(FEMALE_TITLES)}) ") | (~match.rlike(_TITLE) & match.rlike(rf"\A(?:{_any_of(given['f'])}) "))
    return F.when(female, F.lit("f")).otherwise(F.lit("m"))


def find(text: Column, given: dict[str, list[str]] = GIVEN) -> Column:
    """Tokens of a text, or null if it has no entity. Where it has names, the
    family names alone, as whole words or all in capitals, are matches too."""
    # No entity begins inside a word: one look back spares all others there.
    every = r"(?<![\p{L}\p{N}])(?:" + "|".join(f"(?:{p})" for p in patterns(given).values()) + ")"
    name = patterns(given)["name"]

    def again(tokens: Column) -> Column:
        families = F.array_distinct(F.transform(F.filter(_matches(tokens), lambda m: m.rlike(_whole(name))), _family))
        # The longest first, so that one that begins another is not preferred.
        forms = F.array_distinct(F.concat(families, F.transform(families, F.upper)))
        ordered = F.transform(F.array_sort(F.transform(forms, lambda f: F.struct((-F.length(f)).alias("n"), f.alias("f")))), lambda x: F.concat(F.lit(r"\Q"), x["f"], F.lit(r"\E")))
        bare = F.concat(F.lit(every + r"|(?=\p{Lu})(?<![\p{L}\p{N}])(?:"), F.array_join(ordered, "|"), F.lit(")" + _END))
        return F.when(F.size(families) > 0, _tokens(text, bare)).otherwise(tokens)

    return let(_tokens(text, F.lit(every)), lambda tokens: F.when(tokens.isNotNull(), again(tokens)))


def canonical(kind: Column, match: Column) -> Column:
    """One spelling for all mentions of an entity that is no name."""
    return (
        F.when(kind.isin("card", "national"), F.regexp_replace(match, "[^0-9]", ""))
        .when(kind == "phone", F.regexp_replace(match, "[^0-9+]", ""))
        .when(kind == "iban", F.regexp_replace(match, " ", ""))
        .otherwise(F.lower(match))
    )


def units(kind: Column, match: Column, given: dict[str, list[str]] = GIVEN) -> Column:
    """array<struct<kind, entity>> of a match: a name's family name and, if it
    has one, its given name with the gender; else the match itself."""
    unit = lambda k, e: F.struct(k.alias("kind"), e.alias("entity"))
    family = unit(F.lit("family"), F.lower(_family(match)))
    both = F.array(family, unit(F.concat(F.lit("given_"), _gender(match, given)), F.lower(_given(match))))
    return (
        F.when((kind == "name") & (_given(match) != ""), both)
        .when(kind.isin("name", "family"), F.array(family))
        .otherwise(F.array(unit(kind, canonical(kind, match))))
    )


def _bytes(secret: str, kind: Column, entity: Column, attempt: Column) -> Column:
    """128 keyed bytes as 256 hex digits."""
    return F.concat(*(F.sha2(F.concat_ws("\x1f", F.lit(secret), kind, entity, attempt.cast("string"), F.lit(str(i))), 256) for i in range(4)))


def _byte(stream: Column, i: Column) -> Column:
    return F.conv(F.substring(stream, (i % 128) * 2 + 1, F.lit(2)), 16, 10).cast("int")


def _pick(letters: str, n: Column) -> Column:
    return F.substring(F.lit(letters), n % len(letters) + 1, F.lit(1))


def _like(char: Column, n: Column) -> Column:
    """A character of the same class and script, from byte n."""
    return (
        F.when(char.rlike("[0-9]"), (n % 10).cast("string"))
        .when(char.rlike("[A-Z]"), _pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ", n))
        .when(char.rlike(r"\p{IsCyrillic}"), _pick("абвгдежзиклмнопрстуфхцчшэюя", n))
        .when(char.rlike(r"\p{IsGreek}"), _pick("αβγδεζηθικλμνξοπρστυφχψω", n))
        .when(char.rlike(r"\p{L}"), _pick("abcdefghijklmnopqrstuvwxyz", n))
        .otherwise(char)
    )


def _each(text: Column, first: Column | int, stream: Column) -> Column:
    """``text`` with every character from number ``first`` on redrawn."""
    places = F.sequence(F.lit(1), F.greatest(F.length(text), F.lit(1)))
    char = lambda i: F.substring(text, i, F.lit(1))
    drawn = F.transform(places, lambda i: F.when(i < first, char(i)).otherwise(let(char(i), lambda c: let(_byte(stream, i), lambda n: _like(c, n)))))
    return F.array_join(drawn, "")


def _phone(entity: Column, stream: Column) -> Column:
    """All digits redrawn but a calling code after "+"."""
    code = lambda n: F.substring(entity, 2, n)
    known = F.when(code(1).isin(CODES_1.split()), F.lit(3)).when(code(2).isin(CODES_2.split()), F.lit(4)).otherwise(F.lit(5))
    return _each(entity, F.when(entity.startswith("+"), known).otherwise(F.lit(1)), stream)


def _luhn(digits: Column) -> Column:
    """Sum of the Luhn check, modulo 10."""
    size = F.length(digits)

    def add(acc, i):
        d = F.substring(digits, size - i + 1, F.lit(1)).cast("int")
        d = F.when(i % 2 == 0, 2 * d).otherwise(d)
        return acc + F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.greatest(size, F.lit(1))), F.lit(0), add) % 10


def _card(entity: Column, stream: Column) -> Column:
    """Digits that pass the Luhn check if those of the entity do."""

    def checked(drawn: Column) -> Column:
        body = F.substring(drawn, F.lit(1), F.length(drawn) - 1)
        valid = F.concat(body, ((10 - _luhn(F.concat(body, F.lit("0")))) % 10).cast("string"))
        return F.when(_luhn(entity) == 0, valid).otherwise(drawn)

    return let(_each(entity, 1, stream), checked)


def _mod97(account: Column) -> Column:
    """Remainder of an account number whose first four characters go last."""
    turned = F.concat(F.substring(account, F.lit(5), F.length(account)), F.substring(account, 1, 4))

    def add(acc, i):
        value = F.ascii(F.substring(turned, i, F.lit(1)))
        return F.when(value >= 65, acc * 100 + value - 55).otherwise(acc * 10 + value - 48) % 97

    return F.aggregate(F.sequence(F.lit(1), F.greatest(F.length(turned), F.lit(1))), F.lit(0), add)


def _iban(entity: Column, stream: Column) -> Column:
    """Country kept, the rest redrawn; check digits valid if they were."""

    def checked(drawn: Column) -> Column:
        rest = F.substring(drawn, F.lit(5), F.length(drawn))
        country = F.substring(drawn, 1, 2)
        right = F.lpad((98 - _mod97(F.concat(country, F.lit("00"), rest))).cast("string"), 2, "0")
        return F.when(_mod97(entity) == 1, F.concat(country, right, rest)).otherwise(drawn)

    return let(_each(entity, 3, stream), checked)


def _word(list_: str, n: Column) -> Column:
    words = list_.split()
    return F.element_at(F.array(*map(F.lit, words)), n % len(words) + 1)


def _made_up(kind: Column, entity: Column, attempt: Column, stream: Column) -> Column:
    """A name of the entity's script: five syllables for a family name, three
    and an ending of the gender for a given name, one more every third draw."""
    longer = F.least(F.floor(attempt / F.lit(3)).cast("int"), F.lit(20))

    def spelled(script: str) -> Column:
        count = F.when(kind == "family", F.lit(5)).otherwise(F.lit(3)) + longer
        stem = F.array_join(F.transform(F.sequence(F.lit(1), count), lambda i: let(_byte(stream, i), lambda n: _word(SYLLABLES[script], n))), "")
        last = let(_byte(stream, F.lit(0)), lambda n: F.when(kind == "given_f", _word(ENDINGS[script, "f"], n)).when(kind == "given_m", _word(ENDINGS[script, "m"], n)).otherwise(F.lit("")))
        return F.concat(stem, last)

    return F.when(entity.rlike(r"\p{IsCyrillic}"), spelled("cyrillic")).when(entity.rlike(r"\p{IsGreek}"), spelled("greek")).otherwise(spelled("latin"))


def surrogate(secret: str, kind: Column, entity: Column, attempt: Column) -> Column:
    """Canonical surrogate of a canonical unit."""
    return let(_bytes(secret, kind, entity, attempt), lambda stream: _drawn(kind, entity, attempt, stream))


def _drawn(kind: Column, entity: Column, attempt: Column, stream: Column) -> Column:
    local = F.substring_index(entity, "@", 1)
    host = F.array_join(F.transform(F.sequence(F.lit(100), F.lit(107)), lambda i: _pick("abcdefghijklmnopqrstuvwxyz", _byte(stream, i))), "")
    octets = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: (_byte(stream, i) % 254 + 1).cast("string")), ".")
    return (
        F.when(kind == "email", F.concat(_each(local, 1, stream), F.lit("@"), host, F.lit(".example.org")))
        .when(kind == "ip", octets)
        .when(kind == "phone", _phone(entity, stream))
        .when(kind == "iban", _iban(entity, stream))
        .when(kind == "card", _card(entity, stream))
        .when(kind.isin("family", "given_f", "given_m"), _made_up(kind, entity, attempt, stream))
        .otherwise(_each(entity, 1, stream))
    )


def _inflate(match: Column, drawn: Column) -> Column:
    """Put the letters and digits of ``drawn`` in the layout of ``match``."""
    places = F.sequence(F.lit(1), F.greatest(F.length(match), F.lit(1)))

    def at(i):
        seen = F.length(F.regexp_replace(F.substring(match, F.lit(1), i), "[^A-Za-z0-9+]", ""))
        return let(F.substring(match, i, F.lit(1)), lambda c: F.when(c.rlike("[A-Za-z0-9+]"), F.substring(drawn, seen, F.lit(1))).otherwise(c))

    return F.array_join(F.transform(places, at), "")


def _cased(drawn: Column, word: Column) -> Column:
    """All capitals if the word is (and is no single letter), else one."""
    return F.when((F.length(word) > 1) & (word == F.upper(word)), F.upper(drawn)).otherwise(F.initcap(drawn))


def replacement(kind: Column, match: Column, drawn: Column) -> Column:
    """Surrogate of a mention from those of its units, in its format."""
    one = F.get(drawn, F.lit(0))
    family = _cased(one, _family(match))
    full = F.concat(_cased(F.get(drawn, F.lit(1)), _given(match)), F.lit(" "), family)
    return (
        F.when(kind.isin("phone", "card", "national", "iban"), _inflate(match, one))
        .when(kind == "family", _cased(one, match))
        .when(kind == "name", F.concat(F.regexp_extract(match, _TITLE, 0), F.when(F.size(drawn) > 1, full).otherwise(family)))
        .when((kind == "email") & (match == F.upper(match)), F.upper(one))
        .otherwise(one)
    )


def _settle(entities: DataFrame, secret: str, most_rounds: int) -> tuple[DataFrame, int]:
    """(kind, entity, attempt) such that surrogates are distinct and none of
    them is an entity; and how many have an attempt over 0."""
    now = materialise(entities.withColumn("attempt", F.lit(0)), "entities")
    key = lambda kind, text: F.concat_ws(":", kind, text)
    taken = now.select(key(F.col("kind"), F.col("entity")).alias("taken"))
    for _ in range(most_rounds):
        drawn = materialise(now.withColumn("s", key(F.col("kind"), surrogate(secret, F.col("kind"), F.col("entity"), F.col("attempt")))), "drawn")
        first = drawn.groupBy("s").agg(F.min_by("entity", F.struct("attempt", "entity")).alias("first"), F.count("*").alias("n")).where("n > 1").select("s", "first")
        real = drawn.select("s").join(taken.hint("merge"), F.col("s") == F.col("taken"), "left_semi").distinct().withColumn("real", F.lit(True))
        marked = drawn.join(first.hint("merge"), "s", "left").join(real.hint("merge"), "s", "left")
        again = F.coalesce("real", F.lit(False)) | F.coalesce(F.col("first") != F.col("entity"), F.lit(False))
        new = materialise(marked.select("kind", "entity", (F.col("attempt") + again.cast("int")).alias("attempt"), again.alias("again")), "entities")
        moved, late = new.agg(F.count_if("again"), F.count_if(F.col("attempt") > 0)).first()
        discard(drawn)
        now = new.drop("again")
        if not moved:
            return now, late
    raise RuntimeError(f"surrogates still collide after {most_rounds} rounds")


def pseudonymise(documents: DataFrame, secret: str, into: str = "pii", most_rounds: int = 50, given: dict[str, list[str]] | None = None) -> DataFrame:
    """``documents`` with entities of ``text`` replaced, and a column ``into``.

    ``secret`` is the key: who has it can repeat the surrogates, so it has no
    default. ``given`` lists given names by gender ("f", "m") that show a
    person without a title; a bare family name is replaced where its text
    names the person with a title or a listed given name.

    ``into`` is an array of (kind, start, end, surrogate), offsets in code
    points of the original text; it is empty where nothing was found, and
    such a text stays as it is, null and empty ones included. Very long texts
    are searched whole. Other columns keep their values whatever their names;
    an input column named ``into`` is replaced. Repeated rows stay as many as
    they are. Equal units get equal surrogates in all rows, different ones
    different surrogates, and no surrogate is a unit of the input. Where two
    patterns begin at one place, the earlier of ``patterns`` wins. An empty
    table gives an empty one.
    """
    listed = GIVEN if given is None else given
    docs = documents.drop(into)
    found, rid, moved_ = free_names(docs, "found", "rid", "moved")
    text = own("text").cast("string")
    # One scan; a text with entities is stored as its tokens only.
    cut = let(F.when(F.length(text) > 1, find(text, listed)), lambda t: F.struct(t.alias("tokens"), F.when(t.isNull(), text).alias("text")))
    rest = [c for c in docs.columns if c.lower() != "text"]
    rows = materialise(docs.select(*map(own, rest), cut.alias(found), F.monotonically_increasing_id().alias(rid)), "found")

    tokens = own(found)["tokens"]
    named = F.transform(_matches(tokens), lambda m: let(kind_of(m, listed), lambda k: units(k, m, listed)))
    hit = rows.where(tokens.isNotNull())
    each = hit.select(own(rid).alias("rid"), F.explode(F.flatten(named)).alias("x")).select("rid", "x.kind", "x.entity")
    each = materialise(each.distinct(), "units")
    settled, late = _settle(each.select("kind", "entity").distinct(), secret, most_rounds)
    if late:
        # The few units that had to be drawn again, listed by row.
        moved = each.join(settled.where("attempt > 0"), ["kind", "entity"])
        moved = moved.groupBy("rid").agg(F.map_from_entries(F.collect_list(F.struct(F.concat_ws(":", "kind", "entity"), "attempt"))).alias(moved_))
        rows = rows.join(materialise(moved.withColumnRenamed("rid", rid), "moved"), rid, "left")
        attempt = lambda x: F.coalesce(F.try_element_at(own(moved_), F.concat_ws(":", x["kind"], x["entity"])), F.lit(0))
    else:
        attempt = lambda x: F.lit(0)

    def drawn(k: Column, m: Column) -> Column:
        return let(F.transform(units(k, m, listed), lambda x: surrogate(secret, x["kind"], x["entity"], attempt(x))), lambda d: replacement(k, m, d))

    def described(t: Column) -> Column:
        at = running_sum(F.transform(t, F.length))
        one = lambda m, start: let(kind_of(m, listed), lambda k: F.struct(k.alias("kind"), start.alias("start"), (start + F.length(m)).alias("end"), drawn(k, m).alias("surrogate")))
        return let(at, lambda starts: F.transform(F.sequence(F.lit(1), F.size(t) - 1, F.lit(2)), lambda i: let(F.get(t, i), lambda m: one(m, F.get(starts, i)))))

    spans = let(tokens, described)
    kind = rows.select(spans.alias("x")).schema["x"].dataType
    rows = rows.withColumn(found, F.struct(tokens.alias("tokens"), own(found)["text"].alias("text"), F.when(tokens.isNotNull(), spans).otherwise(F.array().cast(kind)).alias("spans")))
    gaps = F.transform(F.sequence(F.lit(0), F.size(tokens) - 1, F.lit(2)), lambda i: F.get(tokens, i))
    joined = F.array_join(F.zip_with(gaps, own(found)["spans"], lambda gap, s: F.concat(gap, F.coalesce(s["surrogate"], F.lit("")))), "")
    new_text = F.when(tokens.isNotNull(), joined).otherwise(own(found)["text"])
    return rows.select(*[new_text.alias(c) if c.lower() == "text" else own(c) for c in docs.columns], own(found)["spans"].alias(into))
