"""Personal data and secrets replaced by surrogates, in SQL expressions throughout.

An entity found in a text is taken apart into parts: an e-mail address is one, a person's name
has one per word. A part's canonical form (lower case, no punctuation) and a key decide its
surrogate, so mentions that differ in form alone agree over the whole table. Candidates for
surrogates are checked against each other and against all real entities before any is used.

Not detected: persons whom no title introduces anywhere in their text, names in a text of which the
title stands in another one, numbers with check digits that do not add up, phone numbers of the
country without a leading 0 or in other groups than below, and postal addresses. Two forms of one
IPv6 address count as two.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, restored, set_aside

_TITLES_F = "Mrs|MRS|Ms|Miss|MISS|Frau|FRAU|Madame|Mme|Señora|Sra|г-жа|госпожа|κυρία"
_TITLES_M = "Mr|MR|Mister|Herr|HERR|Monsieur|Señor|г-н|господин|κύριος"
#: Titles that tell no gender, before any of the others or alone.
_DEGREES = r"(?:(?:Dr|DR|Prof|PROF|Professor)\.? )"
_TITLE = rf"(?:(?:{_TITLES_F}|{_TITLES_M})\.? {_DEGREES}{{0,2}}|{_DEGREES}{{1,2}})"
#: A letter of a name, or an apostrophe inside it; not that of a genitive.
_LETTER = r"(?:\p{L}|['’](?=\p{L})(?![sS](?!\p{L})))"
_NAME = rf"\p{{Lu}}(?:{_LETTER}|-)+"
#: A word that may be a name introduced elsewhere in the text.
_BARE = rf"\p{{Lu}}{_LETTER}++(?:-\p{{Lu}}\p{{Ll}}{_LETTER}*+)*+"
_GROUP = "[0-9A-Fa-f]{1,4}"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
_LABEL = r"(?i:api[_-]?key|access[_-]?key|secret|token|password|passwd|pwd)[\"']?\s{0,3}[:=]\s{0,3}[\"']?"

#: What is detected, in the order in which kinds are tried. None begins inside a word.
PATTERNS = {
    "email": r"(?<![._%+\-])[\p{L}\p{N}_][\p{L}\p{N}._%+\-]*+@(?:[\p{L}\p{N}\-]++\.)+\p{L}{2,}",
    "secret": _LABEL + r"[^\s\"',;]{6,}",
    "apikey": r"(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|sk-[A-Za-z0-9]{20,})(?![\p{L}\p{N}])",
    "hex": r"[0-9A-Fa-f]{32,128}(?![\p{L}\p{N}])",
    "ip": rf"(?<!\.)(?:{_OCTET}\.){{3}}{_OCTET}(?![\p{{L}}\p{{N}}]|\.\d)",
    "ipv6": rf"(?<!:)(?:(?:{_GROUP}:){{7}}{_GROUP}"
    rf"|(?=[0-9A-Fa-f:]{{0,39}}\d)(?:{_GROUP}(?::{_GROUP}){{0,6}})?::(?:{_GROUP}(?::{_GROUP}){{0,6}})?)(?![\p{{L}}\p{{N}}:])",
    "iban": r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])",
    "ssn": r"(?<![\-.])\d{3}-\d{2}-\d{4}(?![\p{L}\p{N}\-])",
    "card": r"(?<![.\-])\d(?:[ \-]?\d){12,18}(?![\p{L}\p{N}])",
    "phone": r"(?:(?:\+\d{1,3}[ .\-]?)?\(\d{2,4}\)[ .\-]?\d{3,4}[ .\-]?\d{3,4}"
    r"|\+\d{1,3}(?:[ .\-]?\d{2,4}){2,5}|(?<![.\-])\d{3}[ .\-]\d{3}[ .\-]\d{4}"
    r"|(?<![.\-/])0\d{1,4}[ /\-]\d{3,4}[ \-]?\d{2,5})(?![\p{L}\p{N}]|[\-/]\d)",
    "person": rf"{_TITLE}{_NAME}(?: {_NAME}){{0,2}}",
}
ANY = r"(?<![\p{L}\p{N}])(?:" + "|".join(PATTERNS.values()) + ")"
#: The same and every capitalised word, for texts that introduce a person.
ANY_OR_WORD = ANY[:-1] + f"|{_BARE})"
#: A text without any of these signs has no entity; a cheap test before the long one.
SIGNS = rf"[0-9@:=]|{_TITLE}\p{{Lu}}"

#: Syllables of invented names, and endings by gender, for each script.
SYLLABLES = {
    "Latin": "ba be da do fa fe ga ka la le ma mi na ne pa ra ri sa ta vi",
    "Cyrillic": "ба бе да до фа фе га ка ла ле ма ми на не па ра ри са та ви",
    "Greek": "βα βε δα δο φα φε γα κα λα λε μα μι να νε πα ρα ρι σα τα βι",
}
ENDINGS = {
    "Latin": {"female": "na", "male": "ron", "neutral": "el", "surname": "sen"},
    "Cyrillic": {"female": "на", "male": "рон", "neutral": "ель", "surname": "сен"},
    "Greek": {"female": "να", "male": "ρον", "neutral": "ελ", "surname": "σεν"},
}


@dataclass(frozen=True)
class SurrogateSettings:
    """``key`` keeps surrogates from being worked out without it, so there is none by default;
    production reads it from a vault.

    ``rounds`` bounds the attempts at a surrogate of the entity's own length that no other entity
    has; whoever has none by then gets a longer one.
    """

    key: str
    rounds: int = 40


def _signs(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0))


def _canonical(kind: Column, raw: Column) -> Column:
    """What mentions of one entity share: letters and digits, in lower case unless case counts."""
    bare = F.regexp_replace(raw, r"[^\p{L}\p{N}]", "")
    return (
        F.when(kind.isin("email", "ip", "ipv6"), F.lower(raw))
        .when(kind.isin("secret", "apikey", "iban"), bare)
        .otherwise(F.lower(bare))
    )


def _script(word: Column) -> Column:
    return (
        F.when(word.rlike(r"\p{IsCyrillic}"), "Cyrillic")
        .when(word.rlike(r"\p{IsGreek}"), "Greek")
        .otherwise("Latin")
    )


def _part(before: Column, kind: Column, raw: Column, canon: Column | None = None) -> Column:
    canon = _canonical(kind, raw) if canon is None else canon
    return F.struct(before.alias("before"), kind.alias("kind"), canon.alias("canon"), raw.alias("raw"))


def _title(entity: Column) -> Column:
    return F.regexp_extract(entity, f"^({_TITLE})", 1)


def _names(entity: Column) -> Column:
    """The parts of a person's name: words with the gender of the title, the last one a surname."""
    title = _title(entity)
    gender = (
        F.when(title.rlike(f"^(?:{_TITLES_F})\\b|^κυρία|^госпожа|^г-жа"), "female")
        .when(title.rlike(f"^{_DEGREES}+$"), "neutral")
        .otherwise("male")
    )
    words = F.split(F.substr(entity, F.char_length(title) + 1), " ")

    def name(word: Column, i: Column) -> Column:
        role = F.when(i == F.size(words) - 1, "surname").otherwise(gender)
        return _part(F.when(i == 0, title).otherwise(" "), F.concat_ws(" ", role, _script(word)), word)

    return F.transform(words, name)


def _parts(entity: Column, known: Column) -> Column:
    """The parts of an entity in order: text before it, kind, canonical form, and the part as it is.

    ``known`` lists canonical names and kinds introduced in the text. A word that is one of them is a
    part of that kind. Other words, and numbers whose check digits do not add up, have no canonical
    form: they are no entities and stay.
    """
    kind = F.lit("person")
    for name, pattern in reversed(list(PATTERNS.items())):
        kind = F.when(entity.rlike(f"^(?:{pattern})$"), name).otherwise(kind)
    label = F.regexp_extract(entity, f"^({_LABEL})", 1)
    value = F.substr(entity, F.char_length(label) + 1)
    hexed = value.rlike(r"^[0-9A-Fa-f]{32,128}$")
    none, bare = F.lit(""), _canonical(F.lit("word"), entity)
    same = F.get(F.filter(known, lambda n: n["canon"] == bare), F.lit(0))["kind"]
    digits = F.regexp_replace(entity, r"[^\p{L}\p{N}]", "")
    wrong = ((kind == "card") & (_luhn(digits) != 0)) | ((kind == "iban") & (_mod97(digits) != 1))
    return (
        F.when((kind == "person") & (_title(entity) != ""), _names(entity))
        .when(kind == "person", F.array(_part(none, F.coalesce(same, F.lit("word")), entity, F.when(same.isNotNull(), bare).otherwise(""))))
        .when(kind == "secret", F.array(_part(label, F.when(hexed, "hex").otherwise("secret"), value)))
        .when(wrong, F.array(_part(none, kind, entity, none)))
        .otherwise(F.array(_part(none, kind, entity)))
    )


def _byte(seed: Column, i: Column) -> Column:
    """Byte i of the endless stream of a seed."""
    block = F.sha2(F.concat(seed, F.floor(i / 32).cast("string")).cast("binary"), 256)
    return F.conv(F.substr(block, 2 * (i % 32) + 1, F.lit(2)), 16, 10).cast("int")


def _mapped(text: Column, seed: Column) -> Column:
    """Letters become letters of their script and numerals digits; all else stays."""

    def sign(c: Column, i: Column) -> Column:
        b = _byte(seed, i)
        letter = (
            F.when(c.rlike(r"\p{IsCyrillic}"), F.substr(F.lit("абвгдежзиклмнопрстуфхцчшэюя"), b % 27 + 1, F.lit(1)))
            .when(c.rlike(r"\p{IsGreek}"), F.substr(F.lit("αβγδεζηθικλμνξοπρστυφχψω"), b % 24 + 1, F.lit(1)))
            .otherwise(F.char(F.lit(97) + b % 26))
        )
        letter = F.when(c != F.lower(c), F.upper(letter)).otherwise(letter)
        digit = (b % 10).cast("string")
        return F.when(c.rlike(r"\p{N}"), digit).when(c.rlike(r"\p{L}"), letter).otherwise(c)

    return F.array_join(F.transform(_signs(text), sign), "")


def _luhn(digits: Column) -> Column:
    """The Luhn sum modulo 10; 0 for a valid number."""

    def worth(c: Column, i: Column) -> Column:
        d = c.cast("int")
        return F.when(i % 2 == 0, d).when(d < 5, 2 * d).otherwise(2 * d - 9)

    return F.aggregate(F.transform(_signs(F.reverse(digits)), worth), F.lit(0), lambda a, x: a + x) % 10


def _mod97(code: Column) -> Column:
    """The remainder of an IBAN, its first four signs moved to the end; 1 for a valid one."""

    def add(rest: Column, c: Column) -> Column:
        value = F.conv(c, 36, 10).cast("int")
        return F.when(value < 10, rest * 10 + value).otherwise(rest * 100 + value) % 97

    turned = F.concat(F.substr(code, F.lit(5)), F.substr(code, F.lit(1), F.lit(4)))
    return F.aggregate(_signs(turned), F.lit(0), add)


def _surrogate(kind: Column, canon: Column, attempt: int, longer: int, settings: SurrogateSettings) -> Column:
    """The canonical form of an attempt's surrogate, of the entity's own kind and shape.

    Numbers and codes get ``longer`` more digits than the entity has.
    """

    def seeded(*parts: Column) -> Column:
        return F.concat_ws("\x1f", F.lit(settings.key), *parts, F.lit(str(attempt)), F.lit(""))

    seed = seeded(kind, canon)
    mapped = _mapped(F.concat(canon, F.lit("0" * longer)), seed)
    hexed = F.transform(_signs(canon), lambda c, i: F.substr(F.lit("0123456789abcdef"), _byte(seed, i) % 16 + 1, F.lit(1)))
    domain = F.sha2(seeded(F.lit("domain"), F.substring_index(canon, "@", -1)).cast("binary"), 256)
    email = F.concat(
        _mapped(F.substring_index(canon, "@", 1), seed), F.lit("@"), F.substr(domain, F.lit(1), F.lit(12)), F.lit(".example")
    )
    octets = [(_byte(seed, F.lit(i)) % (223 if i == 0 else 256) + (1 if i == 0 else 0)).cast("string") for i in range(4)]
    # Each group keeps its length, the first sign of a group is not 0, and "::" stays where it is.
    groups = F.transform(
        F.split(canon, ":"),
        lambda group, g: F.substr(
            F.lower(F.hex(_byte(seed, 2 * g) % 240 * 256 + 4096 + _byte(seed, 2 * g + 1))), F.lit(1), F.char_length(group)
        ),
    )
    head = F.substr(canon, F.lit(1), F.lit(1))
    body = F.concat(head, F.substr(mapped, F.lit(2)))
    stem = F.substr(body, F.lit(1), F.char_length(body) - 1)
    check = ((10 - _luhn(F.concat(stem, F.lit("0")))) % 10).cast("string")
    card = F.when(_luhn(canon) == 0, F.concat(stem, check)).otherwise(body)
    prefixed = F.concat(F.substr(canon, F.lit(1), F.lit(2)), F.substr(mapped, F.lit(3)))
    account = F.substr(prefixed, F.lit(5))
    country = F.substr(canon, F.lit(1), F.lit(2))
    checked = F.lpad((98 - _mod97(F.concat(country, F.lit("00"), account))).cast("string"), 2, "0")
    out = (
        F.when(kind == "email", email)
        .when(kind == "hex", F.array_join(hexed, ""))
        .when(kind == "ip", F.concat_ws(".", *octets))
        .when(kind == "ipv6", F.array_join(groups, ":"))
        .when(kind == "card", card)
        .when(kind == "phone", body)
        .when(kind == "iban", F.concat(country, checked, account))
        .when(kind == "apikey", prefixed)
    )
    for script, listed in SYLLABLES.items():
        syllables = F.array(*[F.lit(x) for x in listed.split()])
        chosen = F.transform(
            F.sequence(F.lit(0), F.lit(2 + attempt)), lambda i: F.get(syllables, _byte(seed, i) % len(listed.split()))
        )
        for role, ending in ENDINGS[script].items():
            out = out.when(kind == f"{role} {script}", F.concat(F.array_join(chosen, ""), F.lit(ending)))
    return out.otherwise(mapped)


def _surrogates(entities: DataFrame, settings: SurrogateSettings) -> DataFrame:
    """(kind, canon, surrogate) with distinct surrogates per kind, none of them a real entity.

    Each round proposes a surrogate for every entity that has none. Of entities that propose the
    same one the least keeps it; whoever proposes a taken one or a real entity tries again. After
    ``rounds`` rounds, or three in which nobody got one, all short forms may be in use: from then on
    each round adds a digit, so there is room for every entity.
    """
    entities = cut_lineage(entities.where(F.col("canon") != "").distinct())
    real = entities.select("kind", F.col("canon").alias("surrogate"))
    pending, done = entities, None
    left, idle, longer = entities.count(), 0, 0
    for attempt in count():
        longer += attempt >= settings.rounds or idle >= 3
        surrogate = _surrogate(F.col("kind"), F.col("canon"), attempt, longer, settings)
        proposed = pending.withColumn("surrogate", surrogate)
        taken = real if done is None else real.unionByName(done.select("kind", "surrogate"))
        fair = (
            proposed.groupBy("kind", "surrogate")
            .agg(F.min("canon").alias("canon"))
            .join(taken, ["kind", "surrogate"], "left_anti")
            .select("kind", "canon", "surrogate")
        )
        fair = cut_lineage(fair)
        done = fair if done is None else done.unionByName(fair)
        pending = cut_lineage(pending.join(fair, ["kind", "canon"], "left_anti"))
        before, left = left, pending.count()
        if not left:
            return done
        idle = idle + 1 if left == before else 0


def _dressed(kind: Column, raw: Column, surrogate: Column) -> Column:
    """The surrogate in the form of the mention: its punctuation and its upper case.

    What a surrogate has beyond the mention's length follows at the end.
    """

    def cased(whole: Column, like: Column) -> Column:
        return F.when((like == F.upper(like)) & (like != F.lower(like)), F.upper(whole)).otherwise(whole)

    def sign(c: Column, i: Column) -> Column:
        before = F.char_length(F.regexp_replace(F.substr(raw, F.lit(1), i), r"[^\p{L}\p{N}]", ""))
        new = F.substr(surrogate, before + 1, F.lit(1))
        new = F.when(c != F.lower(c), F.upper(new)).otherwise(new)
        return F.when(c.rlike(r"[\p{L}\p{N}]"), new).otherwise(c)

    own = F.char_length(F.regexp_replace(raw, r"[^\p{L}\p{N}]", ""))
    shaped = F.concat(F.array_join(F.transform(_signs(raw), sign), ""), F.substr(surrogate, own + 1))
    name = F.when(raw == F.upper(raw), F.upper(surrogate)).otherwise(F.initcap(surrogate))
    return (
        F.when(kind.isin("email", "ipv6", "hex"), cased(surrogate, raw))
        .when(kind == "ip", surrogate)
        .when(kind.rlike("^(female|male|neutral|surname) "), name)
        .otherwise(shaped)
    )


def replace_entities(docs: DataFrame, settings: SurrogateSettings) -> DataFrame:
    """(doc_id, text, rest, n_entities) per row of ``docs``, with every entity replaced.

    Surrogates keep the kind, the script, the length and punctuation of numbers and codes, the
    gender that a person's title tells, the country of an IBAN, the first digit of phone and card
    numbers, and valid check digits of cards and IBANs; mail domains become names under
    ``.example``. Equal canonical forms get equal surrogates in the whole table, different ones
    different surrogates, and no surrogate is an entity of the table.

    A person is found by a title; any later or earlier capitalised word of the same text that is one of
    the name's words is a mention too. A word that two persons of a text have in different places,
    as a first name and a surname, counts as the kind that comes first in the alphabet.

    A surrogate is longer only where all of the entity's own length may be in use. Secrets without a
    letter or digit are masks and stay; they are no entities.

    A text without entities is as it was, a NULL text stays NULL, and both count 0 entities. Rows
    with NULL or repeated ids are rows like others. ``rest`` holds the other columns (see
    ``common.set_aside``); an empty table gives no rows. Only texts with entities are shuffled.
    """
    frame = set_aside(docs)
    found = F.col("text").rlike(SIGNS) & F.col("text").rlike(ANY)
    plain = frame.where(~F.coalesce(found, F.lit(False))).withColumn("n_entities", F.lit(0).cast("bigint"))
    # The few texts with entities are kept, so that the long pattern goes over all texts only to find
    # them and to leave them out.
    marked = cut_lineage(frame.where(found).withColumn("key", F.md5(F.col("text").cast("binary"))))
    # Equal texts have equal entities, so a group of copies is worked on once.
    entities = F.regexp_extract_all("text", F.lit(ANY), F.lit(0))
    persons = F.filter(entities, lambda e: _title(e) != "")
    listed = F.transform(F.flatten(F.transform(persons, _names)), lambda p: F.struct(p["canon"], p["kind"]))
    named = F.size("known") > 0
    mentions = (
        marked.select("key", "text")
        .dropDuplicates(["key"])
        .withColumn("known", F.array_sort(F.array_distinct(listed)))
        .withColumn("entities", F.when(named, F.regexp_extract_all("text", F.lit(ANY_OR_WORD), F.lit(0))).otherwise(entities))
        .select("key", "known", F.posexplode("entities").alias("place", "entity"))
        .select("key", "place", named.alias("named"), F.posexplode(_parts(F.col("entity"), F.col("known"))).alias("part", "p"))
        .select("key", "place", "named", "part", "p.*")
    )
    mentions = cut_lineage(mentions)
    surrogates = _surrogates(mentions.select("kind", "canon"), settings)
    dressed = F.coalesce(_dressed(F.col("kind"), F.col("raw"), F.col("surrogate")), "raw")
    entity = (F.col("part") == 0) & (F.col("canon") != "")
    replaced = (
        mentions.join(surrogates, ["kind", "canon"], "left")
        .select("key", "place", "part", "named", F.concat("before", dressed).alias("new"), entity.alias("entity"))
        .groupBy("key", "named")
        .agg(F.collect_list(F.struct("place", "part", "new")).alias("news"), F.count_if("entity").alias("n_entities"))
    )
    replaced = cut_lineage(replaced)
    between = F.transform(
        F.when(F.col("named"), F.split("text", ANY_OR_WORD, -1)).otherwise(F.split("text", ANY, -1)),
        lambda s, i: F.struct(i.alias("place"), F.lit(-1).alias("part"), s.alias("new")),
    )
    pieces = F.sort_array(F.concat(between, F.col("news")))
    changed = marked.join(replaced, "key").select(
        "doc_id",
        F.array_join(F.transform(pieces, lambda p: p["new"]), "").alias("text"),
        "rest",
        "n_entities",
    )
    return plain.unionByName(changed)


def without_entities(docs: DataFrame, settings: SurrogateSettings) -> DataFrame:
    """``docs`` with every entity replaced, all other columns as they were."""
    return restored(replace_entities(docs, settings), docs.columns)
