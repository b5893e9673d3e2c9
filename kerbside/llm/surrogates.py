"""Surrogates for personal data: every detected entity is replaced by a keyed one of its kind, script and format.

All work is SQL functions and joins. Texts are cut at their entities; the distinct entities of the corpus, in canonical
form, get surrogates derived from a keyed hash; those that collide with another entity's surrogate or with a real entity
are derived anew until none does. The same entity has the same surrogate everywhere, in whatever format it is written,
and different entities have different ones.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.llm.store import materialize

# Given names by gender and script, as plain words; replacements come from the same list.
NAMES = {
    ("f", "latin"): "Alice Amelia Anna Barbara Carmen Catherine Charlotte Clara Daniela Elena Elizabeth Emily Emma Gabriela Hannah Helena Isabella Jennifer Jessica Julia Karen Katharina Laura Linda Lucia Margaret Maria Mary Michelle Nancy Olivia Patricia Rebecca Sabine Sandra Sarah Sofia Stephanie Susan Ursula Victoria",
    ("m", "latin"): "Alexander Andrew Anthony Benjamin Carlos Charles Christopher Daniel David Edward Felix Francisco George Henry Jacques James Jan Javier Jean Johannes John Joseph Karl Klaus Lukas Martin Matthew Michael Miguel Nicolas Oliver Patrick Paul Pedro Peter Philippe Richard Robert Stefan Thomas William Wolfgang",
    ("f", "cyrillic"): "Александра Анастасия Анна Виктория Дарья Екатерина Елена Ирина Мария Наталья Ольга Светлана Татьяна Юлия",
    ("m", "cyrillic"): "Александр Алексей Андрей Дмитрий Иван Игорь Максим Михаил Николай Олег Павел Сергей Юрий Ярослав",
}
LETTERS = {"latin": "abcdefghijklmnopqrstuvwxyz", "cyrillic": "абвгдежзийклмнопрстуфхцчшщыэюя", "greek": "αβγδεζηθικλμνξοπρστυφχψω"}
OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
CARD = r"(?:\d{4}[ -]?\d{4}[ -]?\d{4}[ -]?\d{1,7}|\d{4}[ -]?\d{6}[ -]?\d{5})(?!\d)"
# Lengths of IBANs by country; others are taken by their form.
IBANS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ DZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
    31: "MT SC", 32: "LC", 33: "RU",
}
COUNTRIES = "|".join(f"(?:{c.replace(' ', '|')})" + r"\d{2}" + f"(?: ?[A-Z0-9]{{4}}){{{(n - 4) // 4}}}" + (f" ?[A-Z0-9]{{{n % 4}}}" if n % 4 else "") + r"(?![\p{L}\p{N}])" for n, c in IBANS.items())
# A national number begins with 0 and has nine digits or more, or follows a word for telephone; dates and cards are none.
NATIONAL = (
    r"(?=[0(])(?<![\p{L}\d.,/-])(?!0\d[./-][01]?\d[./-](?:\d{4}|\d\d)(?![./-]?\d))(?!" + CARD + r")"
    r"(?:(?=(?:[ ()./-]{0,3}\d){9})\(?0\d{1,5}\)?(?:[ ./-]{1,3}\d{2,8}){1,4}|0[1-9]\d{8,9})(?!\d)"
    r"|(?=[\d(])(?<=(?<!\p{L})(?:[Tt]el|[Pp]hone|[Tt]elephone|[Mm]obile|[Ff]ax|[Hh]andy|[Tt]elefon|[Tt]éléphone|[Tt]eléfono|[Tt]elefono)[.:]{0,2} {0,1})(?:\(?\d{1,5}\)?(?:[ ./-]{1,3}\d{2,8}){1,5}|\d{6,12})(?!\d)"
)
TITLES = "Mr|Mrs|Ms|Miss|Mx|Dr|Prof|Professor|Sir|Madam|Herr|Herrn|Frau|Monsieur|Madame|Mme|Mlle|Señor|Señora|Sr|Sra|Signor|Signora|Sig|Mevrouw|Meneer|Pan|Pani|господин|госпожа|Господин|Госпожа"
GREETINGS = "Dear|Hi|Hello|Hey|Hallo|Liebe|Lieber|Bonjour|Cher|Chère|Hola|Estimado|Estimada|Querido|Querida|Caro|Cara|Ciao|Уважаемый|Уважаемая|Дорогой|Дорогая"
NO_NAMES = "All|Both|Colleagues|Customer|Everybody|Everyone|Friend|Friends|Guest|Madame|Member|Reader|Readers|Sirs|Subscriber|Team|There|User|World"
PART = r"\p{Lu}(?:\.(?= \p{Lu})|\p{L}+(?:['’-]\p{Lu}\p{L}*)*|['’]\p{Lu}\p{L}+)"
BETWEEN = "(?:(?:van|von|der|den|de|del|della|di|da|dos|du|la|le|zu|bin|al|el) ){0,3}"
# A name told by the title, salutation or field before it.
TOLD = (
    rf"(?<=[ :=\"'])(?=[\p{{Lu}}vdlzbae])(?:(?<=(?<![\p{{L}}\p{{N}}])(?:{TITLES})\.? )|(?<=(?<![\p{{L}}\p{{N}}])(?:{GREETINGS}) )|(?<=(?<!\p{{L}})(?:[Nn]ame|NAME)[\"']?[:=] ?[\"']?))"
    rf"{BETWEEN}(?!(?:{TITLES}|{NO_NAMES})(?!\p{{L}})){PART}(?: {BETWEEN}{PART}){{0,2}}(?!\p{{L}})"
)
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}])[\p{L}\p{N}][\p{L}\p{N}._%+-]{0,63}+@[\p{L}\p{N}-]{1,63}+(?:\.[\p{L}\p{N}-]{1,63}+){0,20}\.\p{L}{2,24}",
    "secret": r"(?<![\p{L}\p{N}])(?:[0-9a-f]{32,128}|[0-9A-F]{32,128}|AKIA[0-9A-Z]{16})(?![\p{L}\p{N}])",
    "phone": r"\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}(?!\d)|(?<![\d.-])(?:\(\d{3}\) ?|\d{3}[.-])\d{3}[.-]\d{4}(?!\d)|" + NATIONAL,
    "card": r"(?<!\d)(?<!\d[.-])" + CARD,
    "ip": rf"(?<![\d.]){OCTET}(?:\.{OCTET}){{3}}(?!\.?\d)",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "iban": r"(?=[A-Z]{2}\d{2})(?<![\p{L}\p{N}])(?:" + COUNTRIES + r"|[A-Z]{2}\d{2}(?:[A-Z0-9]{11,30}|(?: ?[A-Z0-9]{4}){3,7}(?: \d{1,3})?)(?![\p{L}\p{N}]))",
    "name": r"(?=\p{Lu})(?<![\p{L}\p{N}])(?:" + "|".join(n for names in NAMES.values() for n in names.split()) + r")(?:[ ]\p{Lu}\p{Ll}+)?(?!\p{L})|" + TOLD,
}
# No pattern begins with a letter inside a word, so such places are passed at once.
ANY = r"(?>(?<![\p{L}\p{N}])|(?!\p{L}))(?:" + "|".join(f"(?:{p})" for p in PATTERNS.values()) + ")"
MARK = "\uFDD0"  # no character of Unicode; set around the entities
KEY = "public example key"
FURTHER = 1_000_000  # attempts from which on a surrogate name is made up, not listed


def _kind(entity: Column) -> Column:
    kinds = list(PATTERNS)
    first = F.when(entity.rlike(f"^(?:{PATTERNS[kinds[0]]})$"), kinds[0])
    return reduce(lambda c, k: c.when(entity.rlike(f"^(?:{PATTERNS[k]})$"), k), kinds[1:], first).otherwise(F.when(entity.rlike(r"\p{L}"), "name").otherwise("phone"))  # what is before it told it


def _canonical(kind: Column, entity: Column) -> Column:
    """What is the same for all ways to write an entity."""
    return (
        F.when(kind.isin("phone", "card", "ssn"), F.regexp_replace(entity, r"\D", ""))
        .when(kind == "iban", F.regexp_replace(entity, " ", ""))
        .when(kind.isin("email", "secret"), F.lower(entity))
        .otherwise(entity)
    )


def _number(seed: Column, i: Column | int) -> Column:
    """Hash number of a place; 60 bits."""
    return F.conv(F.substring(F.sha2(F.concat_ws("|", seed, F.lit(i) if isinstance(i, int) else i.cast("string")).cast("binary"), 256), 1, 15), 16, 10).cast("long")


def _disguised(text: Column, seed: Column, hexadecimal: Column | None = None) -> Column:
    """Every digit and letter replaced by one of its script and case, all else kept."""

    def sign(i):
        c, n = F.substring(text, i, F.lit(1)), _number(seed, i)
        out = F.when(c.rlike(r"\d"), F.pmod(n, F.lit(10)).cast("string"))
        if hexadecimal is not None:
            digits = F.substring(F.lit("0123456789abcdef"), (F.pmod(n, F.lit(16)) + 1).cast("int"), F.lit(1))
            out = F.when(hexadecimal & c.rlike("[0-9a-f]"), digits).when(hexadecimal & c.rlike("[0-9A-F]"), F.upper(digits)).when(c.rlike(r"\d"), F.pmod(n, F.lit(10)).cast("string"))
        for letters in LETTERS.values():
            new = F.substring(F.lit(letters), (F.pmod(n, F.lit(len(letters))) + 1).cast("int"), F.lit(1))
            out = out.when(c.rlike(f"[{letters}]"), new).when(c.rlike(f"[{letters.upper()}]"), F.upper(new))
        other = F.substring(F.lit(LETTERS["latin"]), (F.pmod(n, F.lit(26)) + 1).cast("int"), F.lit(1))
        return out.otherwise(F.when(c.rlike(r"\p{Lu}"), F.upper(other)).when(c.rlike(r"\p{L}"), other).otherwise(c))

    return F.array_join(F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(text))), sign), "")


def _surrogate(kind: Column, canon: Column, attempt: Column, key: str) -> Column:
    """The canonical surrogate of a canonical entity."""
    seed = F.concat_ws("|", F.lit(key), kind, canon, attempt.cast("string"))
    host = F.substring_index(canon, "@", -1)
    local = _disguised(F.substring_index(canon, "@", 1), seed)
    domain = F.concat(_disguised(F.regexp_replace(host, r"\.[^.]*$", ""), F.concat_ws("|", F.lit(key), host)), F.lit("."), F.substring_index(host, ".", -1))
    octets = F.concat_ws(".", *((F.pmod(_number(seed, i), F.lit(254)) + 1).cast("string") for i in range(4)))
    given = F.substring_index(canon, " ", 1)
    listed = F.lit(None).cast("string")
    for names in NAMES.values():
        words = names.split()
        place = F.pmod(_number(F.concat_ws("|", F.lit(key), given), 0) + attempt, F.lit(len(words)))
        listed = F.when(given.isin(words), F.element_at(F.array(*map(F.lit, words)), (place + 1).cast("int"))).otherwise(listed)
    surname = F.when(F.instr(canon, " ") > 0, F.concat(F.lit(" "), _disguised(F.substring_index(canon, " ", -1), seed))).otherwise("")
    made = F.concat(listed, F.when((F.instr(canon, " ") == 0) & (attempt >= FURTHER), F.lower(_disguised(F.lit("nanana"), seed))).otherwise(""), surname)
    unlisted = F.concat(_disguised(canon, seed), F.when(attempt >= FURTHER, F.lower(_disguised(F.lit("nanana"), seed))).otherwise(""))  # of unknown gender
    made = F.coalesce(made, unlisted)
    return (
        F.when(kind == "email", F.concat(local, F.lit("@"), domain))
        .when(kind == "ip", octets)
        .when(kind == "phone", F.when(F.length(canon) > 10, F.concat(F.expr("left(canon, length(canon) - 10)"), _disguised(F.expr("right(canon, 10)"), seed))).otherwise(_disguised(canon, seed)))
        .when(kind == "iban", F.concat(F.substring(canon, 1, 2), _disguised(F.expr("substr(canon, 3)"), seed)))
        .when(kind == "name", made)
        .otherwise(_disguised(canon, seed, kind == "secret"))
    )


def _written(kind: Column, entity: Column, surrogate: Column) -> Column:
    """A canonical surrogate in the format and case of the entity as written."""
    spread = F.array_join(
        F.transform(
            F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(entity))),
            lambda i: F.when(F.substring(entity, i, F.lit(1)).rlike(r"[\dA-Z]"), F.substring(surrogate, F.length(F.regexp_replace(F.substring(entity, F.lit(1), i), r"[^\dA-Z]", "")), F.lit(1))).otherwise(F.substring(entity, i, F.lit(1))),
        ),
        "",
    )
    return (
        F.when(kind.isin("phone", "card", "ssn", "iban"), spread)
        .when(kind.isin("email", "secret") & (entity == F.upper(entity)), F.upper(surrogate))
        .otherwise(surrogate)
    )


def assign(entities: DataFrame, key: str) -> DataFrame:
    """``kind``, ``canon``, ``surrogate`` for the distinct ``entities(kind, canon)``, no surrogate twice or a real entity."""
    real = entities.select(F.col("kind").alias("_kind"), F.col("canon").alias("_canon"))
    derive = lambda df: df.withColumn("surrogate", _surrogate(F.col("kind"), F.col("canon"), F.col("attempt"), key))
    settled = None
    todo = derive(entities.withColumn("attempt", F.lit(0).cast("long")))
    while True:
        todo = materialize(todo, "surrogates")
        fresh = todo.join(real, (todo["kind"] == real["_kind"]) & (todo["surrogate"] == real["_canon"]), "left_anti")
        if settled is not None:
            taken = settled.select(F.col("kind").alias("_k"), F.col("surrogate").alias("_s"))
            fresh = fresh.join(taken, (fresh["kind"] == taken["_k"]) & (fresh["surrogate"] == taken["_s"]), "left_anti")
        won = materialize(fresh.groupBy("kind", "surrogate").agg(F.min("canon").alias("canon")).select("kind", "canon", "surrogate"), "won")
        settled = won if settled is None else settled.union(won)
        winners = won.select(F.col("kind").alias("_k"), F.col("canon").alias("_c"))
        lost = materialize(todo.join(winners, (todo["kind"] == winners["_k"]) & (todo["canon"] == winners["_c"]), "left_anti").select("kind", "canon", "attempt"), "lost")
        if lost.isEmpty():
            return settled
        later = F.when((F.col("kind") == "name") & (F.col("attempt") >= 50) & (F.col("attempt") < FURTHER), FURTHER).otherwise(F.col("attempt") + 1)
        todo = derive(lost.withColumn("attempt", later.cast("long")))


def _cut(text: Column) -> Column:
    """Pieces of a text: beside the entities at even places, the entities at odd ones. One scan of a text without ``MARK``."""
    marked = F.split(F.regexp_replace(text, f"({ANY})", f"{MARK}$0{MARK}"), MARK, -1)
    entities = F.concat(F.regexp_extract_all(text, F.lit(f"({ANY})"), 0), F.array(F.lit("")))
    pairs = F.flatten(F.zip_with(F.split(text, f"(?:{ANY})", -1), entities, lambda a, b: F.array(a, b)))
    return F.when(F.instr(text, MARK) == 0, marked).otherwise(F.slice(pairs, F.lit(1), F.size(pairs) - 1))


def replace(docs: DataFrame, key: str = KEY) -> DataFrame:
    """``doc_id``, ``n_entities`` and ``text`` with surrogates of every row of ``docs(doc_id, text)``.

    A null text stays null with 0 entities, a text without entities as it is. Entities are found from left to right, the
    longest kind listed first in ``PATTERNS`` winning at a place. A name is told by its given name, whose gender and
    script the surrogate has, or by a title, salutation or ``name:`` before it; one whose given name is not listed gets
    letters of its script. Repeated rows are treated alike; other columns are not looked at; an empty table gives no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    row = F.struct(F.xxhash64("doc_id", "text").alias("one"), F.xxhash64(F.lit(1), "doc_id", "text").alias("two"))  # 128 bits
    found = materialize(docs.select("doc_id", _cut(F.col("text")).alias("cut"), row.alias("row")), "cut")
    without = found.where("cut IS NULL OR size(cut) = 1").select("doc_id", F.lit(0).cast("long").alias("n_entities"), F.col("cut")[0].alias("text"))
    pieces, entities = F.filter("cut", lambda _, i: i % 2 == 0), F.filter("cut", lambda _, i: i % 2 == 1)
    rows = found.where("size(cut) > 1").select("doc_id", "row", pieces.alias("pieces"), entities.alias("entities"))
    each = rows.select("row", F.posexplode("entities").alias("at", "entity")).distinct()
    each = each.withColumn("kind", _kind(F.col("entity"))).withColumn("canon", _canonical(F.col("kind"), F.col("entity")))
    each = materialize(each, "entities")
    given = materialize(assign(materialize(each.select("kind", "canon").distinct(), "distinct"), key), "given")
    joined = each.join(given.withColumnsRenamed({"kind": "_kind", "canon": "_canon"}), (F.col("kind") == F.col("_kind")) & (F.col("canon") == F.col("_canon")))
    told = joined.groupBy(F.col("row").alias("of")).agg(F.collect_list(F.struct("at", _written(F.col("kind"), F.col("entity"), F.col("surrogate")).alias("new"))).alias("found"))
    told = told.select("of", F.transform(F.array_sort("found"), lambda x: x["new"]).alias("new"))
    pieces = rows.join(told, F.col("row") == F.col("of"))
    text = F.array_join(F.zip_with("pieces", F.concat("new", F.array(F.lit(""))), lambda a, b: F.concat(a, b)), "")
    return without.union(pieces.select("doc_id", F.size("entities").cast("long").alias("n_entities"), text.alias("text")))
