"""Personal data replaced by keyed surrogates, with SQL functions only.

Entities are found by one alternation of patterns, and in a text with names also where a part of one of
them stands alone. Distinct entities and distinct parts of names make a table,
in which each gets a surrogate from a keyed hash of itself: digits stay digits,
letters stay letters of their case and script, separators, lengths, country codes,
domains' last parts and issuers' first digits stay, card and bank account numbers keep
their checksums. A name keeps its title; its parts are replaced one by one, by parts of the same script and, for given
names, the title's gender, so that a person's surname is the same with a given name, without it, and
without a title. Surrogates that meet each other or something real
are drawn again until all are distinct, so equal entities stay equal and different ones
different across the corpus. The table is joined back to the texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import Scratch

#: Forms of address that tell a gender, and others.
MALE = ("Mr", "Herr", "Señor", "Sr", "Monsieur", "Sir", "Господин")
FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Señora", "Sra", "Srta", "Madame", "Mme", "Mlle", "Госпожа")
NEUTRAL = ("Dr", "Prof")
#: Particles of surnames, which stay as they are.
PARTICLES = ("von", "van", "de", "der", "den", "di", "da", "del", "della", "la", "le", "du", "dos", "bin", "al", "el", "zu", "zur", "ter", "ten", "af", "фон", "де")
#: Letters, with apostrophes inside but not the one of a possessive.
_LETTERS = r"\p{Lu}(?:(?!['’][sS](?![\p{L}\p{M}]))['’]?[\p{L}\p{M}])++"
_NAME = rf"(?:\p{{Lu}}\. ?)*+(?:(?:{'|'.join(PARTICLES)}) )*+{_LETTERS}(?:-{_LETTERS})*+(?!\p{{N}})"
_LOCAL = r"[\p{L}0-9_+-]++(?:\.[\p{L}0-9_+-]++)*+"
#: Patterns by type, in the order in which they are tried.
PATTERNS = {
    "email": rf"(?<![\p{{L}}0-9_+.-]){_LOCAL}@[\p{{L}}0-9-]+(?:\.[\p{{L}}0-9-]+)+",
    "key": r"\b(?:AKIA|ASIA)[0-9A-Z]{16}\b|\b(?:ghp|gho|ghs)_[A-Za-z0-9]{36}\b|\bsk-[A-Za-z0-9]{20,}+\b",
    "secret": r"(?i:\b(?:password|passwd|pwd|token|secret|api[_-]?key|access[_-]?key)\b)[\"']?\s{0,3}[=:]\s{0,3}[\"']?[^\s\"']{5,}[^\s\"',;.)\]}>]",
    "iban": r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b",
    "ip": r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d.]*\d)",
    "ipv6": r"(?<![\p{L}\p{N}:])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|[0-9A-Fa-f]{3,4}:(?:[0-9A-Fa-f]{1,4}:){0,5}:(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,5})?)(?![\p{L}\p{N}:])",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "card": r"(?<![\d-])\d{4}([ -]?)\d{4}\1\d{4}\1\d{1,7}(?![\d-])",
    "phone": r"(?<![\d\p{L}])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){2,4}(?!\d)|(?<![\d\p{L}])(?:\(\d{3}\) ?|\d{3}[.-])\d{3}[.-]\d{4}(?!\d)|(?<![\d\p{L}.,:/+-])0\d{2,4}[ /-]\d{5,8}(?![\d.,:/-]*\d)",
    "name": rf"\b(?:{'|'.join(MALE + FEMALE + NEUTRAL)})\.? {_NAME}(?: {_NAME})?",
}
#: One alternation; the only numbered group is the card's separator.
ENTITY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: What every entity has: one of these characters, or one of these texts. Texts without, most of all, need no look at the patterns.
HINT_CHARACTERS = "[0-9@=:]"
_STARTS = ("AKIA", "ASIA", "ghp_", "gho_", "ghs_", "sk-", *MALE, *FEMALE, *NEUTRAL)
HINT_TEXTS = tuple(x for x in _STARTS if not any(y in x for y in _STARTS if y != x))
#: Syllables of surrogate names by script, and their endings by gender.
SYLLABLES = {"latin": ("ba", "be", "do", "fa", "ga", "ha", "jo", "ka", "la", "lo", "ma", "mi", "na", "ne", "ra", "so"), "cyrillic": ("ба", "ве", "до", "за", "ко", "ла", "ли", "ма", "ми", "на", "не", "ра", "ро", "са", "та", "фе")}
ENDINGS = {"latin": {"m": "rik", "f": "lina", "n": "ten"}, "cyrillic": {"m": "слав", "f": "мила", "n": "енко"}}
#: Rounds of drawing again.
MOST_ROUNDS = 50


def entity_type(entity: Column) -> Column:
    """The type of a found entity: the first pattern that is all of it. Digits in the shape of a card that no issuer gives out, or whose checksum fails, are none."""
    kind = F.lit(None).cast("string")
    for name, pattern in reversed(PATTERNS.items()):
        kind = F.when(entity.rlike(f"^(?:{pattern})$"), name).otherwise(kind)
    no_card = ~entity.rlike("^[2-6]") | (_luhn(F.regexp_replace(entity, "[^0-9]", "")) != 0)
    return F.when((kind == "card") & no_card, "none").otherwise(F.coalesce(kind, F.lit("other")))


def may_have_entity(text: Column) -> Column:
    found = text.rlike(HINT_CHARACTERS)
    for hint in HINT_TEXTS:
        found = found | text.contains(hint)
    return found


def _byte(seed: Column, i: Column) -> Column:
    """The i-th number from 0 to 65535 of a keyed stream."""
    return F.conv(F.substring(F.sha2(F.concat_ws("|", seed, i.cast("string")), 256), 1, 4), 16, 10).cast("int")


def _characters(text: Column, seed: Column, fixed: Column) -> Column:
    """Each digit and letter after the first `fixed` characters replaced by one of its own kind."""
    small, large, digits = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
    # letters and digits beyond ASCII become ASCII ones
    kinds = ((r"\p{L}", small), (r"\p{Lu}", large), (r"\p{N}", digits), ("[0-9]", digits), ("[a-z]", small), ("[A-Z]", large))

    def one(c: Column, i: Column) -> Column:
        out = c
        for pattern, letters in kinds:
            out = F.when(c.rlike(pattern), F.substring(F.lit(letters), F.pmod(_byte(seed, i), F.lit(len(letters))) + 1, F.lit(1))).otherwise(out)
        return F.when(i < fixed, c).otherwise(out)

    return F.concat_ws("", F.transform(F.split(text, ""), one))


def _luhn(digits: Column) -> Column:
    """The checksum of a string of digits, modulo 10; 0 is valid."""
    doubled = lambda d: F.when(d > 4, 2 * d - 9).otherwise(2 * d)
    values = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(i % 2 == 1, doubled(d.cast("int"))).otherwise(d.cast("int")))
    return F.aggregate(values, F.lit(0), lambda a, b: a + b) % 10


def _card(entity: Column, seed: Column) -> Column:
    drawn = _characters(entity, seed, F.lit(1))
    sum_ = _luhn(F.regexp_replace(drawn, "[^0-9]", ""))
    # the last digit is not doubled: moving it by the sum makes the number valid
    last = F.pmod(F.right(drawn, F.lit(1)).cast("int") - sum_, F.lit(10)).cast("string")
    valid = F.concat(F.substring(drawn, F.lit(1), F.length(drawn) - 1), last)
    return F.when(_luhn(F.regexp_replace(entity, "[^0-9]", "")) == 0, valid).otherwise(drawn)


def _initial(word: Column) -> Column:
    return word.rlike(r"^(?:\p{Lu}\.)+$")


def _kept(word: Column) -> Column:
    """Particles, and the initials that get a letter of their own."""
    return word.isin(*PARTICLES) | _initial(word)


def name_words(entity: Column) -> Column:
    """The words of a name after its title, initials one by one."""
    return F.slice(F.split(F.regexp_replace(entity, r"(?<= \p{Lu}\.|\.\p{Lu}\.)(?=\p{Lu})", " "), " "), 2, F.length(entity))


def name_keys(entity: Column) -> Column:
    """Of a name its parts' keys, in order and for each of its words: the gender of a given name (m, f or n), n for a surname, and the part in lower case.

    Particles and initials have no keys.
    """
    title = F.regexp_replace(F.split(entity, " ")[0], r"\.", "")
    gender = F.when(title.isin(*MALE), "m").when(title.isin(*FEMALE), "f").otherwise("n")
    rest = name_words(entity)
    # of two names the last is the surname, which has no gender; a name alone is a surname too
    of = lambda i: F.when(i == F.size(rest) - 1, F.lit("n")).otherwise(gender)
    return F.transform(rest, lambda w, i: F.when(_kept(w), F.array().cast("array<string>")).otherwise(F.transform(F.split(w, "-"), lambda p: F.concat(of(i), F.lit(":"), F.lower(p)))))


def _cased(surrogate: Column, part: Column) -> Column:
    """A surrogate in upper case if the part is."""
    return F.when((part == F.upper(part)) & (F.length(part) > 1), F.upper(surrogate)).otherwise(surrogate)


def _initials(word: Column, key: str) -> Column:
    """Another letter of the same script, always the same for the same one."""
    seed = F.concat_ws("|", F.lit(key), F.lit("initial"), word)
    return F.concat(F.substring(_part(F.concat(F.lit("n:"), word), seed, F.lit(1)), 1, 1), F.lit("."))


def _part(entity: Column, seed: Column, syllables: Column) -> Column:
    """A part of a name of the script and gender of this one, of so many syllables."""
    digits = F.slice(F.split(F.sha2(seed, 256), ""), F.lit(1), syllables)
    out = F.lit("")
    for script, pattern in (("latin", "^"), ("cyrillic", r"\p{IsCyrillic}")):
        table = F.create_map(*(x for i, v in enumerate(SYLLABLES[script]) for x in (F.lit(f"{i:x}"), F.lit(v))))
        end = F.lit("")
        for gender, ending in ENDINGS[script].items():
            end = F.when(F.substring(entity, 1, 1) == gender, ending).otherwise(end)
        drawn = F.initcap(F.concat(F.array_join(F.transform(digits, lambda d: F.element_at(table, d)), ""), end))  # noqa: B023
        out = F.when(entity.rlike(pattern), drawn).otherwise(out)
    return out


def _mod97(text: Column) -> Column:
    """A bank account number, country code and check digits last, modulo 97; letters count from 10."""
    digits = F.transform(F.filter(F.split(text, ""), lambda c: c.rlike("[0-9A-Z]")), lambda c: F.when(c.rlike("[0-9]"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55))
    return F.aggregate(digits, F.lit(0), lambda a, d: F.pmod(F.when(d > 9, a * 100 + d).otherwise(a * 10 + d), F.lit(97)))


def _iban(entity: Column, seed: Column) -> Column:
    drawn = _characters(entity, seed, F.lit(4))
    turned = lambda x, check: F.concat(F.substring(x, F.lit(5), F.length(x)), F.substring(x, 1, 2), check)
    check = F.lpad((98 - _mod97(turned(drawn, F.lit("00")))).cast("string"), 2, "0")
    valid = F.concat(F.substring(drawn, 1, 2), check, F.substring(drawn, F.lit(5), F.length(drawn)))
    return F.when(_mod97(turned(entity, F.substring(entity, 3, 2))) == 1, valid).otherwise(_characters(entity, seed, F.lit(2)))


def surrogate(entity: Column, kind: Column, key: Column, attempt: Column, syllables: int = 3) -> Column:
    """A surrogate of the entity's type and format, a function of key, entity and attempt; of a part of a name, with a syllable more at each attempt."""
    seed = F.concat_ws("|", key, kind, entity, attempt.cast("string"))
    at = F.instr(entity, "@")
    email = F.concat(_characters(F.substring(entity, F.lit(1), at - 1), seed, F.lit(0)), F.lit("@"), _characters(F.regexp_extract(entity, r"@(.*\.)", 1), F.concat(seed, F.lit("d")), F.lit(0)), F.regexp_extract(entity, r"\.([^.]*)$", 1))
    ip = F.concat_ws(".", *(F.pmod(_byte(seed, F.lit(i)), F.lit(254)) + 1 for i in range(4)))
    # a group keeps its length, and its digits are hexadecimal
    ipv6 = F.concat_ws("", F.transform(F.split(entity, ""), lambda c, i: F.when(c == ":", c).otherwise(F.lower(F.hex(F.pmod(_byte(seed, i), F.lit(16)))))))
    head = F.regexp_extract(entity, r"(?i)^([a-z_-]+[\"']?\s*[=:]\s*[\"']?)", 1)
    secret = F.concat(head, _characters(F.substring(entity, F.length(head) + 1, F.length(entity)), seed, F.lit(0)))
    prefix = F.length(F.regexp_extract(entity, r"^(AKIA|ASIA|gh[pos]_|sk-|\+\d{1,3}(?=\D))", 1))
    plain = _characters(entity, seed, prefix)
    part = _part(entity, seed, attempt + syllables)
    return F.when(kind == "email", email).when(kind == "ip", ip).when(kind == "ipv6", ipv6).when(kind == "secret", secret).when(kind == "card", _card(entity, seed)).when(kind == "iban", _iban(entity, seed)).when(kind == "name", part).otherwise(plain)


def surrogate_table(entities: DataFrame, key: str, scratch: Scratch) -> DataFrame:
    """(entity, kind, surrogate) of distinct (entity, kind): no surrogate twice, and none that is an entity; of names, entities are keys of parts.

    More entities of a format than it has values cannot all differ; such formats share surrogates after MOST_ROUNDS.
    """
    entities = scratch.table(entities, "distinct")
    syllables, names = 3, entities.where("kind = 'name'").count()
    while 16**syllables < 64 * names:
        syllables += 1
    named = lambda t: t.withColumn("surrogate", surrogate(F.col("entity"), F.col("kind"), F.lit(key), F.col("attempt"), syllables))
    word = F.when(F.col("kind") == "name", F.substring("entity", F.lit(3), F.length("entity"))).otherwise(F.col("entity"))
    # keys of names are in lower case, and so are the surrogates that they are compared with
    real = entities.select(word.alias("surrogate")).distinct()
    shown = F.when(F.col("kind") == "name", F.lower("surrogate")).otherwise(F.col("surrogate"))
    now = scratch.table(named(entities.withColumn("attempt", F.lit(0))), "surrogates")
    for _ in range(MOST_ROUNDS):
        twice = now.withColumn("rank", F.row_number().over(Window.partitionBy("surrogate").orderBy("attempt", "entity"))).where("rank > 1").select("entity")
        clash = scratch.table(twice.union(now.withColumn("surrogate", shown).join(real, "surrogate", "left_semi").select("entity")).distinct(), "clashes")
        if not clash.limit(1).count():
            break
        again = named(now.join(clash, "entity", "left_semi").withColumn("attempt", F.col("attempt") + 1).drop("surrogate"))
        now = scratch.table(now.join(clash, "entity", "left_anti").select("entity", "kind", "attempt", "surrogate").unionAll(again.select("entity", "kind", "attempt", "surrogate")), "surrogates")
    return now.select("entity", "kind", "surrogate")


def name_parts(entity: Column) -> Column:
    """The parts of a name as they are written, with the genders of their keys in front."""
    words = F.flatten(F.transform(F.filter(name_words(entity), lambda w: ~_kept(w)), lambda w: F.split(w, "-")))
    return F.zip_with(F.flatten(name_keys(entity)), words, lambda key, word: F.concat(F.substring(key, 1, 2), word))


def _with_entities(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(row, _id, text, found, kinds, parts) per row of docs: entities in order, their types (none stays as it is), and the keys of its names' parts."""
    none = F.array().cast("array<string>")
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.withColumn("found", F.when(may_have_entity(F.col("text")), F.regexp_extract_all("text", F.lit(ENTITY), F.lit(0))).otherwise(none))
    rows = rows.withColumn("kinds", F.transform("found", entity_type))
    of_names = F.filter(F.arrays_zip("found", "kinds"), lambda x: x["kinds"] == "name")
    rows = rows.withColumn("parts", F.when(F.array_contains("kinds", "name"), F.array_distinct(F.flatten(F.transform(of_names, lambda x: name_parts(x["found"]))))).otherwise(none))
    # where there are names, their parts are looked for as well, after the patterns
    rows = rows.withColumn("found", F.when(F.size("parts") > 0, F.regexp_extract_all("text", _pattern(), F.lit(0))).otherwise(F.col("found")))
    kinds = F.transform("found", lambda e: F.when(F.array_contains(_words(), e), "part").otherwise(entity_type(e)))
    return rows.withColumn("kinds", F.when(F.size("parts") > 0, kinds).otherwise(F.col("kinds"))).withColumn("row", F.monotonically_increasing_id())


def _words() -> Column:
    """The parts of a row's names, without their genders, as they are and in upper case."""
    words = F.transform("parts", lambda p: F.substring(p, F.lit(3), F.length(p)))
    return F.array_distinct(F.concat(words, F.transform(words, F.upper)))


def _pattern() -> Column:
    """The patterns and a row's parts of names, which are letters and apostrophes."""
    return F.concat(F.lit(ENTITY + r"|(?<![\p{L}\p{Nd}])(?:"), F.array_join(_words(), "|"), F.lit(r")(?![\p{L}\p{Nd}])"))


def replace_pii(docs: DataFrame, *, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_entities, kinds, text) per row of docs; text has every detected entity replaced.

    kinds maps each type that was found to its count; a part of one of the text's names that stands alone, or in upper case, counts as a name,
    even where the same word means something else. A possessive's ending and the particles of a surname stay; initials become other
    initials, which may meet. The same key gives the same surrogates for the same set of entities. A null text stays null and an empty one empty, with 0 entities
    and no kinds; null ids and repeated rows stay as they are. Other columns are
    ignored. An empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession, "surrogates")
    # texts are searched once; those without an entity are then done, the others go on by the number of their row
    rows = scratch.table(_with_entities(docs, id_col, text_col), "found")
    some = rows.where(F.exists("kinds", lambda k: k != "none"))
    own = F.filter(F.arrays_zip("found", "kinds"), lambda x: ~x["kinds"].isin("name", "part", "none"))
    asked = F.concat(F.transform(own, lambda x: F.struct(x["found"].alias("entity"), x["kinds"].alias("kind"))), F.transform("parts", lambda p: F.struct(F.lower(p).alias("entity"), F.lit("name").alias("kind"))))
    met = scratch.table(some.select("row", F.explode(F.array_distinct(asked)).alias("e")).select("row", "e.*"), "entities")
    table = surrogate_table(met.select("entity", "kind").distinct(), key, scratch)
    maps = met.join(table, ["entity", "kind"]).groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("entity", "surrogate"))).alias("known"))
    out = some.join(maps, "row")

    of = lambda e: F.try_element_at("known", e)
    part = lambda k, p: _cased(of(k), p)
    whole = lambda w, keys: F.when(w.isin(*PARTICLES), w).when(_initial(w), _initials(w, key)).otherwise(F.array_join(F.zip_with(keys, F.split(w, "-"), part), "-"))
    named = lambda e: F.concat_ws(" ", F.concat(F.array(F.substring_index(e, " ", 1)), F.zip_with(name_words(e), name_keys(e), whole)))
    alone = lambda e: _cased(F.coalesce(*(of(F.concat(F.lit(g), F.lower(e))) for g in ("n:", "m:", "f:"))), e)
    changed = F.transform(F.arrays_zip("found", "kinds"), lambda x: F.when(x["kinds"] == "name", named(x["found"])).when(x["kinds"] == "part", alone(x["found"])).when(x["kinds"] == "none", x["found"]).otherwise(of(x["found"])))
    between = F.when(F.size("parts") > 0, F.split("text", _pattern(), -1)).otherwise(F.split("text", F.lit(ENTITY), -1))
    types = F.transform(F.filter("kinds", lambda k: k != "none"), lambda k: F.when(k == "part", "name").otherwise(k))
    out = out.withColumn("changed", changed).withColumn("between", between).withColumn("types", types)
    pieces = F.zip_with("between", "changed", lambda a, e: F.concat(a, F.coalesce(e, F.lit(""))))
    counted = F.map_from_entries(F.transform(F.array_sort(F.array_distinct("types")), lambda k: F.struct(k, F.size(F.filter("types", lambda x: x == k)))))
    replaced = out.select(F.col("_id").alias(id_col), F.size("types").alias("n_entities"), F.to_json(counted).alias("kinds"), F.concat_ws("", pieces).alias("text"))
    # texts without an entity are not shuffled
    return replaced.unionAll(rows.where(~F.exists("kinds", lambda k: k != "none")).select(F.col("_id").alias(id_col), F.lit(0).alias("n_entities"), F.lit(None).cast("string").alias("kinds"), "text"))
