"""Surrogates for personal data: keyed, type-consistent, distinct and the same at each mention.

Only DataFrame functions are used.

1. Each document is scanned once for e-mail addresses, telephone, card and social security
   numbers, IPv4 addresses and titled names.  Card numbers must pass their check digit and
   octets their range; other digits stay.  A card may stand next to other numbers: its
   groups are looked for inside the whole run of digits.
2. Mentions become entities by a canonical form (case folded, punctuation of numbers
   dropped, country codes known by their digits), so all spellings of an entity share one
   surrogate.  A number without a country code is an entity of its own.
3. The distinct entities get a surrogate from a keyed digest.  It keeps the type: the script
   and length of every letter and digit run, the country code of a number, the check digit of
   a card, the top-level domain, the gender and script of a name.  Equal domains and equal
   family names keep being equal.
4. Surrogates that meet another one, or any real entity, take the next attempt of their
   digest, until none collides; late attempts lengthen the local part of an address, so
   that also a space without free values ends.  Rounds work on the distinct entities only.
5. Mentions are joined with the surrogates and poured into their own format: separators,
   brackets and capitals stay.

A hot entity meets the join as one row per distinct text, and adaptive execution splits it
further.  Documents without an entity are never shuffled.

Edge cases: a null text stays null; texts without entities are unchanged; repeated rows get
equal texts; an empty table gives an empty table; input columns named like a result are
replaced by it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import packed, stored, text_or_empty, with_result

# Titles by the gender of the names they come with.
MALE = ("Mr", "Herr", "Monsieur", "Señor", "г-н", "κύριος")
FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "г-жа", "κυρία")

OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
NAME = r"(?:\p{Lu}['’])?\p{Lu}\p{Ll}+(?:['’-]\p{Lu}?\p{Ll}+){0,4}"
LABEL = r"[\p{L}\p{M}\p{N}-]{1,63}+"
TITLE = "|".join(sorted(MALE + FEMALE, key=len, reverse=True))
PATTERNS = {
    # Bounded and possessive, so that neither time nor stack grows with the length of the text: a
    # local part has 64 characters and a domain 32 labels of 63 at most, which is what mail allows.
    "email": rf"[\p{{L}}\p{{N}}][a-zA-Z0-9._%+\p{{L}}\p{{M}}\p{{N}}-]{{0,63}}+@{LABEL}(?:\.{LABEL}){{0,30}}\.\p{{L}}[\p{{L}}\p{{M}}]{{1,62}}",
    "phone": r"\+\d{1,3}[ .-]?\(?\d{2,4}\)?(?:[ .-]?\d{2,4}){2,4}(?!\d)|(?<!\d)\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\d)|(?<![\d.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\d-])|(?<![\d.-])(?<!\d{3} )\d{3} \d{3} \d{4}(?![\d-]| \d{3})",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "ip": rf"(?<![\d.])(?:{OCTET}\.){{3}}{OCTET}(?!\d|\.\d)",
    # The whole run of digits; it ends before a decimal number, an IPv4 address and numbers
    # with the hyphens of other kinds.
    "card": r"(?<!\d)\d(?:(?! \d+\.\d| \d{3}-\d{2,3}-\d{4}(?![\d-]))[ -]?\d){12,}+",
    "person": rf"(?<!\p{{L}})(?:{TITLE})\.? {NAME}(?: {NAME})?",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
PARTS = "array<struct<text:string,kind:string>>"
#: Country codes: 1 and 7, those of two digits, all others have three.
COUNTRY = r"^\+(1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})"
#: A text in which none of these occurs holds no entity.
HINT = rf"@|\d[\d ().-]{{5}}|(?:{TITLE})\.? \p{{Lu}}"

ALPHABETS = (
    "0123456789",
    "abcdefghijklmnopqrstuvwxyz",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "àáâãäåæçèéêëìíîïñòóôõöøùúûüýÿ",
    "абвгдежзиклмнопрстуфхцчшэюя",
    "АБВГДЕЖЗИКЛМНОПРСТУФХЦЧШЭЮЯ",
    "αβγδεζηθικλμνξοπρστυφχψω",
    "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ",
)
#: Letters and digits outside the alphabets are replaced by one of the first script that has them.
SCRIPTS = (
    (r"\p{IsLatin}", ALPHABETS[3]),
    (r"\p{IsCyrillic}", ALPHABETS[4]),
    (r"\p{IsGreek}", ALPHABETS[6]),
    (r"\p{IsHan}", "安白成大方光国海和华家江金林明宁平青山石水天文西小新阳云中子"),
    (r"\p{IsHiragana}", "あいうえおかきくけこさしすせそたちつてとなにぬねのはひふへほ"),
    (r"\p{IsKatakana}", "アイウエオカキクケコサシスセソタチツテトナニヌネノハヒフヘホ"),
    (r"\p{IsHangul}", "가나다라마바사아자차카타파하고노도로모보소오조초코토포호구누"),
    (r"\p{IsArabic}", "ابتثجحخدذرزسشصضطظعغفقكلمنهوي"),
    (r"\p{IsHebrew}", "אבגדהוזחטיכלמנסעפצקרשת"),
    (r"\p{IsThai}", "กขคงจฉชซดตถทนบปผพฟมยรลวสหอ"),
    (r"\p{IsDevanagari}", "कखगघचछजझटठडढतथदधनपफबभमयरलवशषसह"),
    (r"\p{N}", ALPHABETS[0]),
    (r"\p{L}", ALPHABETS[1]),
)
#: Attempts after which the local part of an address grows, by one letter every second attempt.
LONGER_AFTER = 6
#: Consonants, vowels, male and female ending of invented names, by script.
NAME_PARTS = {
    "cyrillic": ("бвгдзклмнпрст", "аеиоу", "н", "а"),
    "greek": ("βγδκλμνπρστ", "αειου", "ς", "α"),
    "latin": ("bcdfghklmnprstvz", "aeiou", "n", "a"),
}


@dataclass(frozen=True)
class SurrogateRules:
    #: The key decides all surrogates; keep it secret and per data set.
    key: str = "change this key for every data set"
    rounds: int = 40


PRODUCTION = SurrogateRules()


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, r"[^0-9]", "")


def luhn_sum(digits: Column) -> Column:
    """Sum of the digits, every second one from the right doubled and its digits added."""
    n = F.length(digits)
    return F.aggregate(
        F.sequence(F.lit(1), n),
        F.lit(0),
        lambda total, i: total
        + F.when(
            (n - i) % 2 == 1,
            F.element_at(F.array(*[F.lit(x) for x in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]), F.substring(digits, i, F.lit(1)).cast("int") + 1),
        ).otherwise(F.substring(digits, i, F.lit(1)).cast("int")),
    )


def kind_of(match: Column) -> Column:
    """Type of a match; null for a run of digits, see ``parts_of``."""
    return (
        F.when(match.contains("@"), "email")
        .when(match.rlike(rf"^(?:{TITLE})\.? "), "person")
        .when(match.rlike(rf"^(?:{OCTET}\.){{3}}{OCTET}$"), "ip")
        .when(match.rlike(r"^\d{3}-\d{2}-\d{4}$"), "ssn")
        .when(match.rlike(r"^\+|^\(|^\d{3}(?:[.-]\d{3}[.-]| \d{3} )\d{4}$"), "phone")
    )


def parts_of(match: Column) -> Column:
    """array<struct<text, kind>> of a match: one part, or the cards in a run of digits and
    what stands between them.

    A card is a run of whole groups.  Of overlapping ones with a right check digit those with
    a usual first digit are preferred, then the usual lengths (16, then 15, then 13 digits),
    then the longest.  Overlapping ones of equal rank are replaced as one.
    """
    kind = kind_of(match)
    whole = F.array(F.struct(match.alias("text"), kind.alias("kind")))
    groups = F.regexp_extract_all(match, F.lit(r"[ -]?[0-9]+"), F.lit(0))
    # One-element arrays: what they hold is worked out once and not at each use.
    run = F.element_at(F.transform(F.array(groups), _parts_of_run), 1)
    return F.when(kind.isNull(), run).otherwise(whole)


def _parts_of_run(groups: Column) -> Column:
    n = F.size(groups)
    text = lambda first, end: F.array_join(F.slice(groups, first + 1, end - first), "")

    def best(first: Column) -> Column:
        """struct<rank, end> of the best card that starts with this group, or null."""
        ends = F.transform(
            F.sequence(first + 1, F.least(first + 19, n)),
            lambda end: F.struct(end.alias("end"), _digits(text(first, end)).alias("digits")),
        )
        cards = F.filter(
            ends, lambda x: F.length(x["digits"]).between(13, 19) & (luhn_sum(x["digits"]) % 10 == 0)
        )
        size = lambda x: F.length(x["digits"])
        rank = lambda x: F.when(size(x) == 16, 50).when(size(x) == 15, 40).when(size(x) == 13, 30).otherwise(size(x)) + F.when(x["digits"].rlike("^[2-6]"), 100).otherwise(0)
        return F.array_max(F.transform(cards, lambda x: F.struct(rank(x).alias("rank"), x["end"].alias("end"))))

    def part(first: Column, end: Column, kind: Column | None = None) -> Column:
        rest = text(first, end)
        return F.array(F.struct(rest.alias("text"), (kind if kind is not None else kind_of(F.ltrim(rest))).alias("kind")))

    def split(found: Column) -> Column:
        start = F.struct(F.lit(0).alias("done"), F.array().cast(PARTS).alias("parts"))

        def step(acc: Column, i: Column) -> Column:
            mine = F.get(found, i)
            over = F.slice(found, i + 2, F.greatest(mine["end"] - i - 1, F.lit(0)))
            better = F.exists(over, lambda x: F.coalesce(x["rank"] > mine["rank"], F.lit(False)))
            taken = (i >= acc["done"]) & mine.isNotNull() & ~better
            equal = F.transform(F.filter(over, lambda x: x["rank"] == mine["rank"]), lambda x: x["end"])
            end = F.greatest(mine["end"], F.array_max(equal))
            between = F.when(i > acc["done"], part(acc["done"], i)).otherwise(F.array().cast(PARTS))
            return F.when(
                taken,
                F.struct(end.alias("done"), F.concat(acc["parts"], between, part(i, end, F.lit("card"))).alias("parts")),
            ).otherwise(acc)

        return F.aggregate(
            F.sequence(F.lit(0), n - 1), start, step,
            lambda acc: F.when(acc["done"] < n, F.concat(acc["parts"], part(acc["done"], n))).otherwise(acc["parts"]),
        )

    cards = F.array(F.transform(F.sequence(F.lit(0), n - 1), best))
    return F.element_at(F.transform(cards, split), 1)


def country_of(match: Column) -> Column:
    """The country code of a number with a plus sign, else an empty text."""
    return F.regexp_extract(F.concat(F.substring(match, 1, 1), _digits(match)), COUNTRY, 1)


def canonical_of(kind: Column, match: Column) -> Column:
    """One form for all spellings of an entity.

    Numbers keep a country code in front of a bar; names keep gender and words.
    """
    country = country_of(match)
    title = F.regexp_extract(match, rf"^({TITLE})\.? ", 1)
    words = F.lower(F.regexp_replace(match, rf"^(?:{TITLE})\.? ", ""))
    gender = F.when(title.isin(*MALE), "m").otherwise("f")
    return (
        F.when(kind == "email", F.lower(match))
        .when(kind == "person", F.concat(gender, F.lit("|"), words))
        .when(kind == "ip", match)
        .when(kind == "phone", F.concat(country, F.lit("|"), F.substring(_digits(match), F.length(country) + 1, F.length(match))))
        .otherwise(_digits(match))
    )


def _noise(key: str, *parts: Column | str) -> Column:
    values = [F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts]
    return F.sha2(F.concat_ws("\x1f", F.lit(key), *values, F.lit(key)).cast("binary"), 512)


def _pick(noise: Column, i: Column, alphabet: str) -> Column:
    """A character of the alphabet by 16 bits of the noise."""
    drawn = F.conv(F.substring(noise, (i % 31) * 4 + 1, F.lit(4)), 16, 10).cast("int")
    return F.substring(F.lit(alphabet), drawn % len(alphabet) + 1, F.lit(1))


def _like(value: Column, noise: Column) -> Column:
    """Every letter and digit replaced by one of its own alphabet or else of its script."""

    def one(i: Column) -> Column:
        c = F.substring(value, i, F.lit(1))
        other = c
        for script, alphabet in reversed(SCRIPTS):
            other = F.when(c.rlike(script), _pick(noise, i, alphabet)).otherwise(other)
        out = F.when(c.rlike(r"[\p{L}\p{N}]"), other).otherwise(c)
        for alphabet in ALPHABETS:
            out = F.when(F.instr(F.lit(alphabet), c) > 0, _pick(noise, i, alphabet)).otherwise(out)
        return out

    letters = F.transform(F.sequence(F.lit(1), F.length(value)), one)
    return F.when(F.length(value) > 0, F.array_join(letters, "")).otherwise(value)


def _name(word: Column, noise: Column, syllables: int, gender: Column | None) -> Column:
    out = F.lit(None).cast("string")
    for script, (consonants, vowels, male, female) in reversed(NAME_PARTS.items()):
        built = F.concat(
            *[
                _pick(noise, F.lit(2 * k + v), vowels if v else consonants)
                for k in range(syllables)
                for v in (0, 1)
            ]
        )
        if gender is not None:
            built = F.concat(built, F.when(gender == "m", male).otherwise(female))
        letters = {"cyrillic": "[а-яё]", "greek": "[α-ωά-ώ]"}.get(script)
        out = built if letters is None else F.when(word.rlike(letters), built).otherwise(out)
    return out


def surrogate_of(kind: Column, canonical: Column, attempt: Column, rules: SurrogateRules) -> Column:
    """The surrogate in canonical form."""
    noise = _noise(rules.key, kind, canonical, attempt)
    local, domain = F.substring_index(canonical, "@", 1), F.substring_index(canonical, "@", -1)
    top = F.substring_index(domain, ".", -1)
    below = F.substring(domain, F.lit(1), F.length(domain) - F.length(top) - 1)
    # Few or no free values of this length: a longer one is new at every attempt.
    extra = F.greatest(F.lit(0), F.ceil((attempt - LONGER_AFTER) / 2)).cast("int")
    longer = F.translate(F.substring(_noise(rules.key, "longer", canonical, attempt), F.lit(1), extra), "0123456789", "ghijklmnop")
    email = F.concat(_like(local, noise), longer, F.lit("@"), _like(below, _noise(rules.key, "domain", below)), F.lit("."), top)
    tail = F.substring_index(canonical, "|", -1)
    phone = F.concat(
        F.substring_index(canonical, "|", 1), F.lit("|"), _pick(noise, F.lit(30), "23456789"),
        _like(F.substring(tail, F.lit(2), F.length(tail)), noise),
    )
    ssn = F.concat(F.lit("9"), _like(F.substring(canonical, F.lit(2), F.length(canonical)), noise))
    body = F.concat(
        F.substring(canonical, F.lit(1), F.lit(1)),
        _like(F.substring(canonical, F.lit(2), F.length(canonical) - 2), noise),
    )
    check = (10 - luhn_sum(F.concat(body, F.lit("0"))) % 10) % 10
    octet = lambda k: F.conv(F.substring(noise, F.lit(4 * k + 1), F.lit(4)), 16, 10).cast("int") % 254 + 1
    first = F.substring_index(canonical, ".", 1)
    # Addresses of private networks stay private.
    ip = F.concat_ws(
        ".", F.when(first.isin("10", "127"), first).otherwise(octet(0).cast("string")),
        octet(1).cast("string"), octet(2).cast("string"), octet(3).cast("string"),
    )
    gender = F.substring_index(canonical, "|", 1)
    given = F.when(tail.contains(" "), F.substring_index(tail, " ", 1))
    family = F.substring_index(tail, " ", -1)
    # A family name keeps its surrogate wherever it occurs; a lone one also has no other part
    # that could change with the attempt.
    family_noise = _noise(rules.key, "family", family, F.when(given.isNull(), attempt).otherwise(F.lit(0)))
    person = F.concat(
        gender, F.lit("|"),
        F.concat_ws(" ", F.when(given.isNotNull(), _name(given, noise, 3, gender)), _name(family, family_noise, 4, None)),
    )
    return (
        F.when(kind == "email", email)
        .when(kind == "phone", phone)
        .when(kind == "ssn", ssn)
        .when(kind == "card", F.concat(body, check.cast("string")))
        .when(kind == "ip", ip)
        .otherwise(person)
    )


def assigned(entities: DataFrame, rules: SurrogateRules = PRODUCTION) -> DataFrame:
    """kind, canonical, surrogate: no two surrogates and no surrogate and entity are equal."""
    # Few bytes, much work: dealt to all tasks, where adaptive execution would make it one.  By a
    # hash of its own, because a partitioning that the rows have already would be dropped.
    tasks = int(entities.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = F.xxhash64("canonical", "kind")
    state = stored(
        entities.select("kind", "canonical", F.lit(0).alias("attempt")).repartition(tasks, dealt).withColumn(
            "surrogate", surrogate_of(F.col("kind"), F.col("canonical"), F.col("attempt"), rules)
        ),
        "surrogates",
    )
    for _ in range(rules.rounds):
        claims = state.select("kind", F.col("surrogate").alias("value"), F.struct("attempt", "canonical").alias("owner"))
        real = state.select("kind", F.col("canonical").alias("value"), F.lit(None).cast(claims.schema["owner"].dataType).alias("owner"))
        held = (
            claims.unionByName(real)
            .groupBy("kind", "value")
            .agg(
                F.max(F.col("owner").isNull()).alias("real"),
                F.min("owner.canonical").alias("any"),
                F.min("owner").alias("first"),
                F.count("owner").alias("claims"),
            )
            .where("claims > 0 AND (real OR claims > 1)")
            .select("kind", F.col("value").alias("surrogate"), "real", "first")
        )
        if held.isEmpty():
            return state.select("kind", "canonical", "surrogate")
        moved = state.join(held, ["kind", "surrogate"], "left").withColumn(
            "attempt",
            F.col("attempt")
            + (F.coalesce("real", F.lit(False)) | (F.coalesce(F.col("first.canonical"), F.col("canonical")) != F.col("canonical"))).cast("int"),
        )
        state = stored(
            moved.select("kind", "canonical", "attempt").repartition(tasks, dealt).withColumn(
                "surrogate", surrogate_of(F.col("kind"), F.col("canonical"), F.col("attempt"), rules)
            ),
            "surrogates",
        )
    raise RuntimeError(f"surrogates still collide after {rules.rounds} attempts")


def poured(kind: Column, match: Column, surrogate: Column) -> Column:
    """The surrogate in the format of the mention."""
    upper = (F.upper(match) == match) & (F.lower(match) != match)
    digits = F.when(kind == "phone", F.concat(country_of(match), F.substring_index(surrogate, "|", -1))).otherwise(surrogate)
    in_place = F.array_join(
        F.transform(
            F.sequence(F.lit(1), F.length(match)),
            lambda i: F.when(
                F.substring(match, i, F.lit(1)).rlike("[0-9]"),
                F.substring(digits, F.length(_digits(F.substring(match, F.lit(1), i))), F.lit(1)),
            ).otherwise(F.substring(match, i, F.lit(1))),
        ),
        "",
    )
    title = F.regexp_extract(match, rf"^((?:{TITLE})\.? )", 1)
    return (
        F.when(kind.isNull() | surrogate.isNull(), match)
        .when(kind == "email", F.when(upper, F.upper(surrogate)).otherwise(surrogate))
        .when(kind == "person", F.concat(title, F.initcap(F.substring_index(surrogate, "|", -1))))
        .when(kind == "ip", surrogate)
        .otherwise(in_place)
    )


def replaced(docs: DataFrame, rules: SurrogateRules = PRODUCTION, *, text: str = "text") -> DataFrame:
    """All columns, the text with surrogates, and n_entities (mentions replaced)."""
    row = F.col("row")
    t = text_or_empty(row.getField(text))
    whole = F.lit(rf"\G([\s\S]*?)({ANY})")
    nothing = F.array().cast("array<string>")
    scan = packed(docs).withColumn("t", t).withColumn("hint", F.col("t").rlike(HINT))
    scan = scan.select(
        "row", "t",
        F.when(F.col("hint"), F.regexp_extract_all("t", whole, F.lit(1))).otherwise(nothing).alias("gaps"),
        F.when(F.col("hint"), F.regexp_extract_all("t", whole, F.lit(2))).otherwise(nothing).alias("matches"),
    )
    gap = lambda x: F.array(F.struct(x["gap"].alias("text"), F.lit(None).cast("string").alias("kind")))
    scan = scan.withColumn(
        "parts",
        F.flatten(
            F.transform(
                F.arrays_zip(F.col("gaps").alias("gap"), F.col("matches").alias("match")),
                lambda x: F.concat(gap(x), parts_of(x["match"])),
            )
        ),
    )
    scan = scan.withColumn("n", F.size(F.filter("parts", lambda x: x["kind"].isNotNull())))
    some = F.col("n") > 0
    base = stored(
        scan.select(
            "row", "n", F.when(some, F.col("parts")).alias("parts"),
            F.when(some, F.sha2(F.col("t").cast("binary"), 256)).alias("digest"),
        ),
        "scanned-documents",
    )
    with_entities = base.where("n > 0")
    mentions = with_entities.select("digest", F.posexplode("parts")).where("col.kind IS NOT NULL")
    mentions = mentions.select(
        "digest", F.col("pos").alias("pos"), F.col("col.kind").alias("kind"),
        canonical_of(F.col("col.kind"), F.col("col.text")).alias("canonical"),
    ).distinct()
    mentions = stored(mentions, "mentions")
    mapping = assigned(mentions.select("kind", "canonical").distinct(), rules)
    by_text = (
        mentions.join(mapping, ["kind", "canonical"])
        .groupBy("digest")
        .agg(F.map_from_entries(F.collect_list(F.struct("pos", "surrogate"))).alias("surrogates"))
    )
    filled = with_entities.join(by_text, "digest").select("row", "n", "parts", "surrogates")
    pieces = F.transform("parts", lambda x, i: poured(x["kind"], x["text"], F.element_at("surrogates", i)))
    done = F.aggregate("parts", F.lit(0), lambda total, x: total + F.length(x["text"]))
    new_text = F.concat(F.array_join(pieces, ""), F.substring(row.getField(text), done + 1, F.length(row.getField(text))))
    changed = with_result(filled, **{text: new_text, "n_entities": F.col("n").cast("long")})
    same = with_result(base.where("n = 0"), **{text: row.getField(text), "n_entities": F.col("n").cast("long")})
    return same.unionByName(changed)
