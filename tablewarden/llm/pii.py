"""PII: detected entities get surrogates of the same type, drawn by a secret key.

Detected: e-mail addresses, IPv4 addresses, phone numbers, card and account numbers, social
security numbers, hexadecimal secrets, and names after a title. A surrogate depends on the
key and on the entity's canonical form (lower case, or digits only), so an entity has one
surrogate in all documents and spellings (coreference). It keeps the format: separators,
case, lengths, country codes, valid Luhn sums, octets below 256; surnames keep their script,
the given names of the lists below their script and gender (others become surnames). Mail
addresses go to reserved example domains. A name found after a title is replaced wherever its
document has it as a word of its own, in that spelling, in capitals or with one capital: also
where the same word means something else there.

Collisions: given names of a list swap places within it, by a permutation that moves each, so
they differ by themselves. The other distinct entities are gathered with their surrogates. Where
two entities got one surrogate, or a surrogate is itself an entity of the corpus or a given name,
all but the first draw again with another salt until all differ. Only these exceptions are kept;
every other surrogate is computed in place, so texts are not shuffled. Up to ``INLINE``
exceptions travel as a map literal, more are joined to their texts.

All of it is DataFrame functions. Null and empty texts stay as they are; repeated rows get
the same surrogates.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewarden.llm.common import Scratch, load

KEY = "change-me"
INLINE = 2_000
ROUNDS = 50

TITLES = "Mr|Mrs|Ms|Miss|Dr|Prof|Herr|Frau|Señor|Señora|Sr|Sra|Monsieur|Madame|Mme"
CYRILLIC_TITLES = "г-н|г-жа|господин|госпожа"
JOINED = r"['’-](?!s(?!\p{L}))\p{L}"  # within a name; a possessive 's is no part of it
NAME = rf"(?=\p{{L}}{{2}}|\p{{L}}{JOINED})\p{{Lu}}\p{{L}}*+(?:{JOINED}\p{{L}}*+){{0,9}}+"
BEFORE = rf"(?<=\b(?:{TITLES}|{CYRILLIC_TITLES})\.? )"
BEFORE_SECOND = rf"(?<=\b(?:{TITLES}|{CYRILLIC_TITLES})\.? \p{{Lu}}[\p{{L}}'’-]{{1,30}} )"

# a title is no name ("Herr Dr. ...")
TITLED = rf"(?=\p{{Lu}})(?:{BEFORE}|{BEFORE_SECOND})(?!(?:{TITLES}|{CYRILLIC_TITLES})(?!\p{{L}})){NAME}"

# alternatives in order of precedence
PATTERNS = {
    "email": r"(?<![\w.+-])[\w.+-]{1,64}+@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){1,8}",
    "ip": r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d{1,2})\.){3}(?:25[0-5]|2[0-4]\d|1?\d{1,2})(?!\w|\.\d)",
    "phone": r"(?<![\w+])\+\d{1,3}[ .-]?\(?\d{2,4}\)?(?:[ .-]?\d{2,4}){2,3}(?!\d)",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "secret": r"(?<![0-9A-Za-z])(?:[0-9a-f]{32,128}+|[0-9A-F]{32,128}+)(?![0-9A-Za-z])",
    "card": r"(?<![\w-])\d(?:[ -]?\d){12,18}+(?!\w)",
    "account": r"(?<!\w)[A-Z]{2}\d{2}[A-Z0-9]{11,30}+(?!\w)",
    "name": TITLED,
}
ENTITY = "|".join(PATTERNS.values())
DIGITS = ("phone", "ssn", "card")

# fixed values: given names by gender, and syllables of surnames by script
MALE = (
    "James John Robert Michael William David Richard Joseph Thomas Charles Peter Hans Klaus Jürgen Stefan Pierre"
    " Jean Michel Luc Carlos José Juan Luis Miguel Pedro Paul Mark Daniel Иван Пётр Сергей Алексей"
).split()
FEMALE = (
    "Mary Patricia Jennifer Linda Elizabeth Barbara Susan Jessica Sarah Karen Anna Ursula Petra Sabine Monika Marie"
    " Claire Sophie Julie Camille María Carmen Ana Lucía Elena Laura Emma Alice Ольга Мария Елена Анна"
).split()
GIVEN = MALE + FEMALE
LATIN = "ba be bo da de do fa fe ka ke ko la le lo ma me mo na ne no pa po ra re ro sa so ta te to va vi".split()
CYRILLIC = "ба бе бо да де до ка ке ко ла ле ло ма ме мо на не но па по ра ре ро са со та те то ва ви ду зу".split()


def permuted(key: str) -> dict[str, str]:
    """Each given name of the lists to another one of its gender and script, none to itself and
    no two to one: the names of a list in an order by the key, each to the one after it."""
    out = {}
    for names in (MALE, FEMALE):
        for cyrillic in (False, True):
            chosen = [n for n in names if ("Ѐ" <= n[0] <= "ӿ") == cyrillic]
            chosen.sort(key=lambda n: hashlib.sha512(f"{key}\x1fgiven\x1f{n}".encode()).digest())
            out |= dict(zip(chosen, chosen[1:] + chosen[:1], strict=True))
    return out


def kind_of(atom: Column) -> Column:
    found = None
    for kind in ("email", "ip", "phone", "ssn", "secret", "card", "account"):
        # the look-arounds hold at the ends of the atom as they did in the text
        fits = atom.rlike(f"^(?:{PATTERNS[kind]})$")
        found = F.when(fits, kind) if found is None else found.when(fits, kind)
    return found.otherwise("name")


def canonical(atom: Column, kind: Column) -> Column:
    return F.when(kind.isin(*DIGITS), F.regexp_replace(atom, "[^0-9]", "")).otherwise(F.lower(atom))


def _byte(digest: Column, i: Column) -> Column:
    """The i-th byte (from 0, in turn) of a hexadecimal SHA-512 digest."""
    return F.conv(F.substr(digest, (i % 64) * 2 + 1, F.lit(2)), 16, 10).cast("int")


def _digest(key: str, *parts: Column) -> Column:
    return F.sha2(F.concat_ws("\x1f", F.lit(key), *(p.cast("string") for p in parts)).cast("binary"), 512)


def _pick(choices: list[str], byte: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, choices)), (byte % len(choices) + 1).cast("int"))


def _chars(text: Column, change) -> Column:
    """The text with each character c at place i (from 0) replaced by change(c, i)."""
    places = F.when(F.length(text) > 0, F.sequence(F.lit(0), F.length(text) - 1)).otherwise(F.array().cast("array<int>"))
    return F.array_join(F.transform(places, lambda i: change(F.substr(text, i + 1, F.lit(1)), i)), "")


def _same_class(digest: Column, text: Column) -> Column:
    """Digits for digits, lower-case letters for lower-case letters; the rest stays."""
    letters = F.lit("abcdefghijklmnopqrstuvwxyz")

    def change(c: Column, i: Column) -> Column:
        b = _byte(digest, i)
        letter = F.substr(letters, b % 26 + 1, F.lit(1))
        return F.when(c.rlike("[0-9]"), (b % 10).cast("string")).when(c.rlike(r"\p{L}"), letter).otherwise(c)

    return _chars(text, change)


def _luhn(digits: Column) -> Column:
    """The Luhn sum of a text of digits, modulo 10."""

    def add(total: Column, i: Column) -> Column:
        d = F.substr(digits, F.length(digits) - i, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return total + F.when(i % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add) % 10


def _surname(digest: Column, name: Column) -> Column:
    def made(syllables: list[str], ending: Column) -> Column:
        parts = [_pick(syllables, _byte(digest, F.lit(i))) for i in range(4)]
        third = F.when(F.length(name) > 4, parts[2]).otherwise("")
        fourth = F.when(F.length(name) > 7, parts[3]).otherwise("")
        return F.initcap(F.concat(parts[0], parts[1], third, fourth, ending))

    female = F.when(name.rlike("[ая]$"), "ва").otherwise("в")
    return F.when(name.rlike(r"\p{IsCyrillic}"), made(CYRILLIC, female)).otherwise(made(LATIN, F.lit("n")))


def _own_case(atom: Column, made: Column) -> Column:
    """Upper-case letters where the atom has them; all of them if all of its are."""
    by_place = _chars(
        made, lambda c, i: F.when(F.substr(atom, i + 1, F.lit(1)).rlike(r"\p{Lu}"), F.upper(c)).otherwise(c)
    )
    shouted = (F.upper(atom) == atom) & (F.lower(atom) != atom)
    return F.when(shouted, F.upper(made)).otherwise(by_place)


def _laid_out(atom: Column, digits: Column) -> Column:
    """The atom with its digits replaced in order."""

    def change(c: Column, i: Column) -> Column:
        before = F.length(F.regexp_replace(F.substr(atom, F.lit(1), i + 1), "[^0-9]", ""))
        return F.when(c.rlike("[0-9]"), F.substr(digits, before, F.lit(1))).otherwise(c)

    return _chars(atom, change)


def _with(items: Column, fields: list[str], name: str, made) -> Column:
    """Structs with one more field. Each step names what later ones use more than once."""
    return F.transform(items, lambda s: F.struct(*(s[f].alias(f) for f in fields), made(s).alias(name)))


def described(atoms: Column) -> Column:
    """Structs of atom, kind and plain (the canonical form)."""
    items = F.transform(atoms, lambda a: F.struct(a.alias("atom"), kind_of(a).alias("kind")))
    return _with(items, ["atom", "kind"], "plain", lambda s: canonical(s["atom"], s["kind"]))


def _entity(s: Column) -> Column:
    """What two spellings of one entity share."""
    return F.concat(s["kind"], F.lit("\x1f"), s["plain"])


def _listed(entity: Column) -> Column:
    return entity.isin(*(f"name\x1f{n.lower()}" for n in GIVEN))


def surrogates(items: Column, key: str, salt) -> Column:
    """Structs of atom and made for described atoms; ``salt`` gives an entity's salt."""
    fields = ["atom", "kind", "plain"]

    def step(items: Column, name: str, made) -> Column:
        out = _with(items, fields, name, made)
        fields.append(name)
        return out

    country = lambda s: F.length(F.regexp_extract(s["atom"], r"^\+(\d{1,3})(?=[ .(-])", 1))
    given = F.create_map(*(F.lit(x) for pair in permuted(key).items() for x in pair))
    items = step(items, "h", lambda s: _digest(key, s["kind"], s["plain"], salt(_entity(s))))
    items = step(items, "fixed", lambda s: F.when(s["kind"] == "phone", country(s)).otherwise(0))
    items = step(
        items,
        "digits",
        lambda s: F.when(
            s["kind"].isin(*DIGITS),
            F.concat(
                F.substr(s["plain"], F.lit(1), s["fixed"]), _same_class(s["h"], F.substr(s["plain"], s["fixed"] + 1))
            ),
        ),
    )
    body = lambda s: F.substr(s["digits"], F.lit(1), F.length(s["digits"]) - 1)
    # the check digit that makes the Luhn sum 0
    items = step(
        items,
        "checked",
        lambda s: F.when(
            (s["kind"] == "card") & (F.when(s["kind"] == "card", _luhn(s["plain"])) == 0),
            F.concat(body(s), ((10 - _luhn(F.concat(body(s), F.lit("0")))) % 10).cast("string")),
        ).otherwise(s["digits"]),
    )
    items = step(
        items,
        "domain",
        lambda s: F.when(
            s["kind"] == "email", _digest(key, F.lit("domain"), F.substring_index(s["plain"], "@", -1))
        ),
    )

    def raw(s: Column) -> Column:
        h, plain = s["h"], s["plain"]
        top = _pick(["com", "net", "org"], _byte(s["domain"], F.lit(9)))
        local = _same_class(h, F.substring_index(plain, "@", 1))
        email = F.concat(local, F.lit("@m"), F.substr(s["domain"], F.lit(1), F.lit(8)), F.lit(".example."), top)
        octets = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: (_byte(h, i) % 254 + 1).cast("string"))
        account = F.concat(F.substr(plain, F.lit(1), F.lit(2)), _same_class(h, F.substr(plain, F.lit(3))))
        name = F.coalesce(F.try_element_at(given, F.initcap(plain)), _surname(h, plain))
        return (
            F.when(s["kind"] == "email", email)
            .when(s["kind"] == "ip", F.array_join(octets, "."))
            .when(s["kind"] == "secret", F.substr(h, F.lit(1), F.length(plain)))
            .when(s["kind"] == "account", account)
            .when(s["kind"] == "name", name)
            .otherwise(s["checked"])
        )

    items = step(items, "raw", raw)
    return F.transform(
        items,
        lambda s: F.struct(
            s["atom"].alias("atom"),
            F.when(s["kind"].isin(*DIGITS), _laid_out(s["atom"], s["raw"]))
            .when(s["kind"] == "ip", s["raw"])
            .when((s["kind"] == "name") & ((F.upper(s["atom"]) != s["atom"]) | (F.length(s["atom"]) < 2)), s["raw"])
            .otherwise(_own_case(s["atom"], s["raw"]))
            .alias("made"),
        ),
    )


def atoms_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0))


def with_mentions(found: Column) -> Column:
    """The pattern of a text's entities and of all mentions of the names among those found by
    ``ENTITY``; null where there are none. No character of a name is special in a pattern."""
    names = F.array_distinct(F.filter(found, lambda a: a.rlike(f"^{NAME}$")))
    forms = F.flatten(F.transform(names, lambda a: F.array(a, F.upper(a), F.initcap(F.lower(a)))))
    start = rf"{ENTITY}|(?<![\p{{L}}\p{{N}}_])(?<!\p{{L}}['’-])(?:"
    end = rf")(?![\p{{L}}\p{{N}}_]|{JOINED})"
    return F.when(F.size(names) > 0, F.concat(F.lit(start), F.array_join(F.array_distinct(forms), "|"), F.lit(end)))


def _located(docs: DataFrame) -> DataFrame:
    """With _atoms, the entities of ``text`` and all mentions of its names, and _pattern, which
    finds them; where that is null, ``ENTITY`` does."""
    found = docs.withColumn("_found", atoms_of(F.col("text")))
    found = found.withColumn("_pattern", with_mentions(F.col("_found")))
    mentions = F.regexp_extract_all("text", F.col("_pattern"), F.lit(0))
    return found.withColumn("_atoms", F.when(F.col("_pattern").isNull(), F.col("_found")).otherwise(mentions))


def _between() -> Column:
    """What lies before, between and after the atoms of a located text."""
    return F.when(F.col("_pattern").isNull(), F.split("text", ENTITY, -1)).otherwise(
        F.split("text", F.col("_pattern"), -1)
    )


def stretches(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with one more column: the bytes of ``text`` between entities and of entities (with
    all mentions of names), in turn; null where there are none.

    Surrogates keep the format of what they stand for, so this finds them as well.
    """
    bytes_of = lambda a, b: F.array(F.octet_length(a), F.coalesce(F.octet_length(b), F.lit(0)))
    turns = F.flatten(F.zip_with(_between(), F.col("_atoms"), bytes_of))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return _located(docs).select(*columns, F.when(F.size("_atoms") > 0, turns).alias(name))


def exceptions(docs: DataFrame, key: str, scratch: Scratch) -> DataFrame:
    """(entity, salt) of the entities whose first surrogate was taken.

    The given names of the lists are no entities here, since they keep theirs whatever the
    others draw; a surrogate that is one of them is taken.
    """
    atoms = docs.select(F.explode(F.array_distinct(atoms_of(F.col("text")))).alias("atom")).distinct()

    def drawn(table: DataFrame, salt: str) -> DataFrame:
        """With the entity that the surrogate would be, as ``made``."""
        own = surrogates(described(F.array("atom")), key, lambda _: F.col(salt))
        table = table.withColumn("_own", own).withColumn("_again", described(F.array(F.col("_own")[0]["made"])))
        return table.withColumn("made", _entity(F.col("_again")[0])).drop("_own", "_again")

    table = (
        scratch.save(atoms, "atoms")
        .withColumn("_s", described(F.array("atom"))[0])
        .withColumn("entity", _entity(F.col("_s")))
        .filter(~_listed(F.col("entity")))
        .groupBy("entity")
        .agg(F.min("atom").alias("atom"))
        .withColumn("salt", F.lit(0))
    )
    table = scratch.save(drawn(table, "salt"), "entities_0")
    for turn in range(1, ROUNDS):
        shared = table.groupBy("made").agg(F.count("*").alias("n"), F.min("entity").alias("first")).filter("n > 1")
        second = table.join(shared.select("made", "first"), "made").filter("entity <> first").select("entity")
        real = table.join(table.select(F.col("entity").alias("made")), "made", "left_semi").select("entity")
        given = table.filter(_listed(F.col("made"))).select("entity")
        again = scratch.save(second.union(real).union(given).distinct().withColumn("again", F.lit(1)), f"again_{turn}")
        if again.isEmpty():
            break
        kept = table.join(again, "entity", "left_anti").select("entity", "atom", "salt", "made")
        moved = table.join(again, "entity").select("entity", "atom", (F.col("salt") + 1).alias("salt"))
        redrawn = drawn(moved, "salt").select("entity", "atom", "salt", "made")
        table = scratch.save(kept.union(redrawn), f"entities_{turn}")
    else:
        raise RuntimeError("the surrogates are too few for the entities")
    return table.filter("salt > 0").select("entity", "salt")


def pseudonymise(docs: DataFrame, key: str = KEY) -> DataFrame:
    """The columns of ``docs`` with surrogates in ``text``, and n_entities.

    ``n_entities`` replaces a column of that name.
    """
    scratch = Scratch(docs.sparkSession)
    taken = scratch.save(exceptions(docs, key, scratch), "exceptions")
    columns = [c for c in docs.columns if c != "n_entities"]
    found = _located(docs.select(*columns))
    n = taken.count()
    if n == 0:
        salt = lambda entity: F.lit(0)
    elif n <= INLINE:
        pairs = [F.lit(x) for row in taken.collect() for x in (row.entity, row.salt)]
        salts = F.create_map(*pairs)
        salt = lambda entity: F.coalesce(F.try_element_at(salts, entity), F.lit(0))
    else:
        # texts meet their exceptions by digest
        digest = F.sha2(F.col("text").cast("binary"), 256)
        each = F.explode(described(F.array_distinct("_atoms"))).alias("_s")
        uses = found.select(digest.alias("_digest"), each).select("_digest", _entity(F.col("_s")).alias("entity"))
        uses = uses.distinct().join(taken, "entity")
        maps = uses.groupBy("_digest").agg(F.map_from_entries(F.collect_list(F.struct("entity", "salt"))).alias("_salts"))
        found = found.withColumn("_digest", digest).join(maps, "_digest", "left")
        salt = lambda entity: F.coalesce(F.try_element_at(F.col("_salts"), entity), F.lit(0))
    made = surrogates(described(F.col("_atoms")), key, salt)
    joined = F.array_join(F.zip_with(_between(), made, lambda a, b: F.concat(a, F.coalesce(b["made"], F.lit("")))), "")
    text = F.when(F.size("_atoms") > 0, joined).otherwise(F.col("text"))
    return found.select(
        *(text.alias("text") if c == "text" else F.col(f"`{c}`") for c in columns),
        F.when(F.col("text").isNull(), 0).otherwise(F.size("_atoms")).alias("n_entities"),
    )


def op10_pii(spark, folder: str) -> DataFrame:
    return pseudonymise(load(spark, folder, "documents").select("doc_id", "text"))
