"""Surrogates for personal data and credentials, by DataFrame functions only."""

from __future__ import annotations


from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardhouse.llm.common import without, written

#: Rounds in which entities with equal surrogates draw anew; the draws of the
#: last round carry 64 hexadecimal digits and do not collide.
ROUNDS = 6

_FEMALE = "Mrs|Ms|Miss|Frau|Sra|Mme|Madame|Mademoiselle|Señora|госпожа|Госпожа"
_MALE = "Mr|Herr|Sr|Monsieur|Señor|господин|Господин"
#: A word of a name: capitals may stand inside it, and hyphens or apostrophes before them.
_WORD = r"(?=\p{Lu}[\p{Lu}'’\-]*\p{Ll})\p{Lu}(?:\p{L}|['’\-](?=\p{Lu}))*"
_NAME = rf"\.? {_WORD}(?: {_WORD}){{0,2}}"
#: Names of what holds a credential, in any case, perhaps as the end of a longer name, and what
#: stands between it and the credential. A Bearer credential has digits, or it may be a word.
_CARRIER = (
    r"(?:[a-z0-9]{1,20}[_-]){0,4}(?:password|passwd|passphrase|pwd|token|secret|credentials?"
    r"|(?:api|access|secret|private|auth|account|client)[_-]?key|client[_-]?secret|apikey)"
)
_CARRIED = rf"(?i:{_CARRIER}[\"']?\s{{0,4}}(?::=|=>|[:=])\s{{0,4}}(?:bearer\s{{1,4}})?[\"']?|bearer\s{{1,4}}(?=[^\s\"']{{0,512}}[0-9]))"
#: Prefixes that say that what follows is a key, and whole key blocks.
_PREFIXED = (
    r"(?:AKIA|ASIA)[0-9A-Z]{16}\b|gh[pousr]_[A-Za-z0-9]{20,255}|github_pat_[A-Za-z0-9_]{20,255}"
    r"|glpat-[A-Za-z0-9_-]{20,255}|xox[abprs]-[A-Za-z0-9-]{10,255}|sk-[A-Za-z0-9_-]{20,255}"
    r"|[rs]k_(?:live|test)_[A-Za-z0-9]{16,255}|AIza[A-Za-z0-9_-]{35}"
)
_BLOCK = r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----[^-]{1,20000}-----END [A-Z ]{0,40}PRIVATE KEY-----"

#: What is looked for, in this order: an earlier kind wins where two begin at one
#: place. A mention may begin with words that stay: a form of address, or what a
#: credential is assigned to.
PATTERNS = {
    "email": (
        r"(?<![._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}+"
        r"@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){0,8}\.[A-Za-z]{2,24}"
    ),
    "secret": rf"(?:{_PREFIXED}|{_CARRIED}[^\s\"']{{6,}})",
    "block": _BLOCK,
    "iban": r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b",
    "card": (
        r"(?:(?:[0-9]{4}[ -]?){3}[0-9]{4}(?![0-9])"
        r"|3[47][0-9]{2}[ -]?[0-9]{6}[ -]?[0-9]{5}(?![0-9]))"
    ),
    "ssn": r"(?<!-)[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "phone": (
        r"(?:(?<!\+)\+[0-9]{1,3}[ .-]?\(?[0-9]{2,4}\)?[ .-]?[0-9]{3}[ .-]?[0-9]{3,4}(?![0-9])"
        r"|(?<!\()\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}(?![0-9])"
        r"|(?<![.-])[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}(?![0-9.-]))"
    ),
    "ip": (
        r"(?<!\.)(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}"
        r"(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?![0-9]|\.[0-9])"
    ),
    "name_f": rf"(?:{_FEMALE}){_NAME}",
    "name_m": rf"(?:{_MALE}){_NAME}",
}
# A mention begins where no ASCII letter or digit stands before it. What it begins
# with decides which kinds are tried there.
_FIRST = {"[0-9+(]": ("card", "ssn", "phone", "ip"), "[A-Za-z]": ("secret",), "[A-Z]": ("iban",)}
_FIRST["-"] = ("block",)
_FIRST["[MFSHгГ]"] = ("name_f", "name_m")
PATTERN = "(?<![A-Za-z0-9])(?:" + "|".join(
    [PATTERNS["email"]] + [f"(?={first})(?:{'|'.join(PATTERNS[k] for k in kinds)})" for first, kinds in _FIRST.items()]
) + ")"
#: Every mention has one of these; a text without them is not looked through.
_SIGNS = r"[0-9@=:]|[Bb][Ee][Aa][Rr][Ee][Rr]|PRIVATE KEY|AKIA|ASIA|gh[pousr]_|github_pat_|glpat-|xox[abprs]-|[rs]k[-_]|AIza|(?<![A-Za-z0-9])[MFSHгГ](?:" + "|".join(
    title[1:] for title in f"{_FEMALE}|{_MALE}".split("|")
) + r")(?=[. ])"

# Names that stand in for others, by gender and script.
_GIVEN = {
    ("f", "latin"): "Anna Clara Elena Emma Eva Ida Ines Julia Laura Lena Lucia Maria Marta Mia Nina Nora Olga Paula Rosa Sara Sofia Vera".split(),
    ("m", "latin"): "Adam Albert Anton David Emil Felix Hugo Ivan Jan Jonas Karl Leo Lucas Marco Martin Max Oscar Paul Peter Robert Simon Victor".split(),
    ("f", "cyrillic"): "Анна Вера Галина Дарья Елена Ирина Ксения Лариса Мария Нина Ольга Полина Софья Тамара Юлия".split(),
    ("m", "cyrillic"): "Антон Борис Виктор Глеб Денис Егор Иван Кирилл Лев Максим Никита Олег Павел Роман Сергей".split(),
}
_FAMILY = {
    "latin": "Adler Baker Berg Blanco Brandt Carter Costa Duval Engel Fischer Fuchs Garnier Hahn Keller Klein Lang Leroy Lopez Marin Mercier Molina Moreau Navarro Novak Ortega Parker Petit Rivera Roth Sander Santos Silva Torres Vogel Weber Winter".split(),
    "cyrillic": "Беленко Гончаренко Демченко Зинченко Иваненко Климчук Левченко Мельник Назаренко Остапчук Петренко Романюк Савчук Ткаченко Шевчук Ященко".split(),
}


def parts_of(mention: Column) -> Column:
    """A mention as an array of (kind, form): pieces of kind null stay as they are.

    A person's family name, the last word, and the given names before it are
    entities of their own, so that a shorter mention still names the same person.
    """

    def piece(kind: Column | str | None, form: Column) -> Column:
        named = kind if isinstance(kind, Column) else F.lit(kind).cast("string")
        return F.struct(named.alias("kind"), form.alias("form"))

    def person(gender: str, titles: str) -> Column:
        title = F.regexp_extract(mention, rf"^((?:{titles})\.? )", 1)
        words = F.split(F.substring(mention, F.length(title) + 1, F.length(mention)), " ")
        named = F.transform(
            words,
            lambda w, i: F.array(
                piece(F.when(i == F.size(words) - 1, "family").otherwise(f"given_{gender}"), w),
                piece(None, F.when(i == F.size(words) - 1, "").otherwise(" ")),
            ),
        )
        return F.concat(F.array(piece(None, title)), F.flatten(named))

    known = mention.rlike(rf"^(?:{_PREFIXED}|{_BLOCK})$")
    carried = F.when(known, "").otherwise(F.regexp_extract(mention, rf"^({_CARRIED})", 1))
    secret = F.array(
        piece(None, carried), piece("secret", F.substring(mention, F.length(carried) + 1, F.length(mention)))
    )
    found = F.when(mention.rlike(f"^(?:{PATTERNS['email']})$"), F.array(piece("email", mention)))
    found = found.when(known | mention.rlike(f"^{_CARRIED}"), secret)
    for kind in ("iban", "card", "ssn", "phone", "ip"):
        found = found.when(mention.rlike(f"^(?:{PATTERNS[kind]})$"), F.array(piece(kind, mention)))
    return found.when(mention.rlike(rf"^(?:{_FEMALE})\.? "), person("f", _FEMALE)).otherwise(person("m", _MALE))


def canonical(kind: Column, form: Column) -> Column:
    """What makes two mentions the same entity: digits for numbers (a North American phone number
    without its country), lower case for mail, else the text."""
    digits = F.regexp_replace(form, "[^0-9]", "")
    return (
        F.when(kind.isin("card", "ssn"), digits)
        .when(kind == "phone", F.regexp_replace(digits, "^1([0-9]{10})$", "$1"))
        .when(kind == "email", F.lower(form))
        .when(kind == "iban", F.regexp_replace(form, " ", ""))
        .otherwise(form)
    )


def rendered(kind: Column, form: Column, drawn: Column) -> Column:
    """A surrogate in the form of a mention: separators stay, and digits before the entity's own."""
    sort = F.when(kind == "iban", "[A-Z0-9]").otherwise("[0-9]")
    mine = F.length(F.regexp_replace(form, r"[^A-Z0-9]", ""))
    extra = mine - F.length(canonical(kind, form))

    def one(c: Column, i: Column) -> Column:
        at = F.length(F.regexp_replace(F.substring(form, F.lit(1), i + 1), r"[^A-Z0-9]", "")) - extra
        return F.when(F.regexp_like(c, sort) & (at > 0), F.substring(drawn, at, F.lit(1))).otherwise(c)

    spaced = F.array_join(F.transform(F.split(form, ""), one), "")
    spaced = F.when(F.length(drawn) == F.length(canonical(kind, form)), spaced).otherwise(drawn)
    return F.when(kind.isin("card", "ssn", "phone", "iban"), spaced).otherwise(drawn)


def _draw(key: str, kind: Column, entity: Column, attempt: Column) -> Column:
    """64 hexadecimal digits that depend on the secret key, the entity and the attempt."""
    return F.sha2(F.concat_ws("\u0001", F.lit(key), kind, entity, attempt.cast("string"), F.lit(key)), 256)


def _number(draw: Column, at: Column | int, below: int) -> Column:
    """A number below a bound from four hexadecimal digits of the draw, read in a circle."""
    start = F.pmod(F.lit(at) if isinstance(at, int) else at, F.lit(60)) + 1
    return F.pmod(F.conv(F.substring(draw, start, F.lit(4)), 16, 10).cast("int"), F.lit(below))


def _shaped(text: Column, draw: Column) -> Column:
    """Each letter and digit replaced by another of its sort (case, script); the rest stays."""

    def one(c: Column, i: Column) -> Column:
        def among(letters: str) -> Column:
            return F.substring(F.lit(letters), _number(draw, i * 3, len(letters)) + 1, F.lit(1))

        return (
            F.when(c.rlike("^[0-9]$"), among("0123456789"))
            .when(c.rlike("^[a-z]$"), among("abcdefghijklmnopqrstuvwxyz"))
            .when(c.rlike("^[A-Z]$"), among("ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
            .when(c.rlike("^[а-я]$"), among("абвгдежзиклмнопрстуфхцчшэюя"))
            .when(c.rlike("^[А-Я]$"), among("АБВГДЕЖЗИКЛМНОПРСТУФХЦЧШЭЮЯ"))
            .when(c.rlike(r"^\p{Ll}$"), among("abcdefghijklmnopqrstuvwxyz"))
            .when(c.rlike(r"^\p{Lu}$"), among("ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
            .otherwise(c)
        )

    return F.array_join(F.transform(F.split(text, ""), one), "")


def _name(kind: str, entity: Column, draw: Column, attempt: Column) -> Column:
    """A name of the same sort and script; after the first attempt two, with a hyphen."""

    def of_script(script: str) -> Column:
        names = _FAMILY[script] if kind == "family" else _GIVEN[kind[-1], script]
        listed = F.array(*map(F.lit, names))
        first, second = (F.get(listed, _number(draw, at, len(names))) for at in (0, 20))
        return F.when(attempt > 0, F.concat_ws("-", first, second)).otherwise(first)

    return F.when(entity.rlike("^[А-ЯЁ]"), of_script("cyrillic")).otherwise(of_script("latin"))


def _luhn(digits: Column) -> Column:
    """The check digit that belongs after some digits."""
    each = F.transform(
        F.reverse(F.split(digits, "")),
        lambda c, i: F.when(i % 2 == 1, c.cast("int")).otherwise(
            c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)
        ),
    )
    total = F.aggregate(each, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0)))
    return F.pmod(-total, F.lit(10)).cast("string")


def surrogate(key: str, kind: Column, entity: Column, attempt: Column) -> Column:
    """The stand-in for an entity in its canonical form at one attempt.

    Numbers keep their length; a card its first digit and, where the original
    has one, a right check digit; a phone number a valid first digit or its
    country's; an IP address its private network; mail the shape of its local
    part, at a reserved domain; secrets shape and prefix; names sort, gender and
    script. After the last round a long tail makes it differ from all others.
    """
    draw = _draw(key, kind, entity, attempt)
    octet = [(_number(draw, 5 * n, 254) + 1).cast("string") for n in range(4)]
    private = F.regexp_extract(entity, r"^(10|192\.168|127)\.", 1)
    network = F.when(private == "10", F.concat_ws(".", F.lit("10"), *octet[1:]))
    network = network.when(private == "192.168", F.concat_ws(".", F.lit("192.168"), *octet[2:]))
    network = network.when(private == "127", F.concat_ws(".", F.lit("127"), *octet[1:]))
    domain = F.concat(F.lit("@mail"), (_number(draw, 50, 900) + 100).cast("string"), F.lit(".example.org"))
    rest = F.substring(entity, F.lit(2), F.length(entity))
    whole = F.substring(entity, F.lit(1), F.length(entity) - 1)
    card = F.concat(F.substring(entity, 1, 1), _shaped(rest, draw))
    card_body = F.substring(card, F.lit(1), F.length(entity) - 1)
    checked = F.substring(entity, -1, 1) == _luhn(whole)
    abroad = F.concat(F.substring(entity, 1, 2), _shaped(F.substring(entity, F.lit(3), F.length(entity)), draw))
    drawn = (
        F.when(kind == "email", F.concat(_shaped(F.substring_index(entity, "@", 1), draw), domain))
        .when(kind == "ip", network.otherwise(F.concat_ws(".", *octet)))
        .when(kind == "card", F.when(checked, F.concat(card_body, _luhn(card_body))).otherwise(card))
        .when(kind == "iban", abroad)
        .when(
            kind == "phone",
            F.when(F.length(entity) == 10, F.concat((_number(draw, 40, 8) + 2).cast("string"), _shaped(rest, draw))).otherwise(abroad),
        )
        .when(
            (kind == "secret") & entity.startswith("AKIA"),
            F.concat(F.lit("AKIA"), _shaped(F.substring(entity, F.lit(5), F.length(entity)), draw)),
        )
    )
    for name in ("given_f", "given_m", "family"):
        drawn = drawn.when(kind == name, _name(name, entity, draw, attempt))
    drawn = drawn.otherwise(_shaped(entity, draw))
    tail = F.when(kind == "email", F.concat(draw, F.lit("."), drawn)).otherwise(F.concat(drawn, F.lit("-"), draw))
    return F.when(attempt >= ROUNDS, tail).otherwise(drawn)


def assign(entities: DataFrame, key: str) -> DataFrame:
    """(kind, entity, surrogate): a surrogate of its own for every distinct (kind, entity).

    Each round checks all surrogates: one that is itself an entity of its kind
    is given up, and of those that are equal within a kind one (the earliest
    drawn, then the least entity) stays; the others draw again. Every round is
    written to the shared folder.
    """
    drawn = surrogate(key, F.col("kind"), F.col("entity"), F.col("attempt"))
    now = written(
        entities.distinct().withColumn("attempt", F.lit(0)).withColumn("surrogate", drawn), "surrogates"
    )
    for _ in range(ROUNDS):
        keeper = now.groupBy("kind", "surrogate").agg(F.min(F.struct("attempt", "entity")).alias("keeper"))
        real = now.select("kind", F.col("entity").alias("surrogate"), F.lit(True).alias("real"))
        clash = F.col("real").isNotNull() | (F.col("keeper.entity") != F.col("entity"))
        checked = now.join(keeper, ["kind", "surrogate"]).join(real, ["kind", "surrogate"], "left")
        checked = checked.select("kind", "entity", "surrogate", "attempt", clash.alias("clash"))
        if checked.where("clash").isEmpty():
            break
        again = checked.withColumn("attempt", F.when(F.col("clash"), F.col("attempt") + 1).otherwise(F.col("attempt")))
        kept = F.when(F.col("clash"), drawn).otherwise(F.col("surrogate"))
        now = written(again.select("kind", "entity", "attempt", kept.alias("surrogate")), "surrogates")
    return now.select("kind", "entity", "surrogate")


def replace_pii(docs: DataFrame, key: str, text_col: str = "text", count_col: str = "n_entities") -> DataFrame:
    """Every mention of an entity in the texts replaced by the entity's surrogate.

    The same entity has the same surrogate in all documents, in the form of each
    mention; different entities of a kind have different ones, and none is
    itself an entity of the corpus. It depends on ``key`` and the corpus alone.
    ``count_col`` (replaced if there) is the number of mentions. All other
    columns and rows stay, equal rows too; a null text stays null with 0
    mentions; an empty table gives an empty result.

    Texts without a mention are not shuffled. Mentions are taken from distinct
    texts; the others meet the new text pieces by a key of their text.
    """
    text = F.col(f"`{text_col}`")
    docs = without(docs, [count_col])
    order = [F.col(f"`{c}`") for c in docs.columns]
    has = F.coalesce(text.rlike(_SIGNS) & text.rlike(PATTERN), F.lit(False))
    plain = docs.where(~has).select(*order, F.lit(0).cast("long").alias(count_col))
    text_key = "__text_key"
    hit = docs.where(has).withColumn(text_key, F.md5(text))
    mentions = (
        hit.select(text_key, F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0)).alias("mentions"))
        .groupBy(text_key)
        .agg(F.first("mentions").alias("mentions"))
        .select(text_key, F.posexplode("mentions").alias("place", "mention"))
        .select(text_key, "place", F.posexplode(parts_of(F.col("mention"))).alias("part", "piece"))
        .select(text_key, "place", "part", "piece.kind", "piece.form")
    )
    mentions = written(mentions.withColumn("entity", canonical(F.col("kind"), F.col("form"))), "mentions")
    chosen = assign(mentions.where("kind is not null").select("kind", "entity"), key)
    out = F.when(F.col("surrogate").isNull(), F.col("form")).otherwise(
        rendered(F.col("kind"), F.col("form"), F.col("surrogate"))
    )
    pieces = (
        mentions.join(chosen, ["kind", "entity"], "left")
        .select(text_key, "place", "part", out.alias("out"))
        .groupBy(text_key)
        .agg(F.sort_array(F.collect_list(F.struct("place", "part", "out"))).alias("pieces"))
        .select(text_key, F.expr("transform(pieces, (p, i) -> struct(p.out, p.part = 0 and i > 0))").alias("pieces"))
        .select(text_key, F.aggregate(
            "pieces",
            F.struct(F.array().cast("array<string>").alias("whole"), F.lit("").alias("open")),
            lambda a, p: F.struct(
                F.when(p["col2"], F.concat(a["whole"], F.array(a["open"]))).otherwise(a["whole"]).alias("whole"),
                F.when(p["col2"], p["out"]).otherwise(F.concat(a["open"], p["out"])).alias("open"),
            ),
            lambda a: F.concat(a["whole"], F.array(a["open"])),
        ).alias("__new"))
    )
    gaps = F.split(text, PATTERN, -1)
    joined = F.array_join(F.transform(gaps, lambda g, i: F.concat(g, F.coalesce(F.get("__new", i), F.lit("")))), "")
    changed = hit.join(pieces, text_key).select(
        *[joined.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns],
        F.size("__new").cast("long").alias(count_col),
    )
    return plain.union(changed)
