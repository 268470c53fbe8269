"""Personal data replaced by keyed surrogates of the same kind (built-in functions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.workspace import Workspace

MALE = ("Mr", "Herr", "Señor", "Monsieur", "Господин", "Κύριος")
FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Señora", "Madame", "Mme", "Госпожа", "Κυρία")
TITLES = "|".join(sorted(MALE + FEMALE, key=lambda t: (-len(t), t)))
#: Kinds of personal data, the first that fits. No pattern can start inside a run that it has just given up.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)*+(?<=\.[A-Za-z]{2,24})",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ip": r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\.?\d)",
    "card": r"(?<![\d-])\d{4}([ -]?)\d{4}\1\d{4}\1\d{1,7}(?!-?\d)",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?!-?\d)",
    "phone": r"(?<![\d+])(?:\+\d{1,3}[ .-]?\d{1,4}(?:[ .-]\d{2}){3,4}|\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{3,4}){2}|(?:\(\d{3}\) ?|\d{3}[.-])\d{3}[.-]\d{4})(?!\d)",
    "name": rf"(?<!\p{{L}})(?:{TITLES})\.? \p{{Lu}}[\p{{L}}'’-]++(?: \p{{Lu}}[\p{{L}}'’-]++)?",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
DIGITS_ONLY = ("card", "ssn", "phone")
ROUNDS = 30
#: Sixteen syllables of each script, one for each hexadecimal digit; last syllables of given names by gender.
SYLLABLES = {
    "latin": ("ba", "de", "fi", "go", "ka", "le", "mi", "no", "pa", "re", "si", "to", "va", "we", "zi", "lu"),
    "cyrillic": ("ба", "де", "фи", "го", "ка", "ле", "ми", "но", "па", "ре", "си", "то", "ва", "ве", "зи", "лу"),
    "greek": ("βα", "δε", "φι", "γο", "κα", "λε", "μι", "νο", "πα", "ρε", "σι", "το", "βε", "θε", "ζι", "λου"),
}
ENDINGS = {"latin": ("n", "na"), "cyrillic": ("н", "на"), "greek": ("ς", "να")}


def kind_of(value: Column) -> Column:
    out = F.lit("name")
    for kind, pattern in reversed(list(PATTERNS.items())[:-1]):
        out = F.when(value.rlike(f"^(?:{pattern})$"), kind).otherwise(out)
    return out


def canonical(value: Column, kind: Column) -> Column:
    """What two mentions of one entity share, however they are written."""
    digits = F.regexp_replace(value, r"\D", "")
    title = F.regexp_extract(value, rf"^({TITLES})", 1)
    name = F.lower(F.regexp_replace(value, rf"^(?:{TITLES})\.? ", ""))
    return (F.when(kind.isin(*DIGITS_ONLY), digits).when(kind == "email", F.lower(value)).when(kind == "iban", F.regexp_replace(value, " ", ""))
            .when(kind == "name", F.concat(F.when(title.isin(*FEMALE), "f ").otherwise("m "), name)).otherwise(value))


def picked(hex_digits: Column, first: int, options: tuple[str, ...]) -> Column:
    """One of sixteen options by the hexadecimal digit at a place of a digest."""
    number = F.conv(F.substring(hex_digits, first, 1), 16, 10).cast("int")
    return F.element_at(F.array(*[F.lit(x) for x in options]), number + 1)


def shaped(value: Column, digest: Column) -> Column:
    """Letters become letters and digits digits, by the digest; all else stays."""
    letters, digits = F.translate(digest, "0123456789", "qrstuvwxyz"), F.translate(digest, "abcdef", "012345")
    one = lambda i: F.substr(value, i, F.lit(1))
    at = lambda i: (i - 1) % 64 + 1
    upper = lambda i: F.upper(F.substr(letters, at(i), F.lit(1)))
    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(value)), lambda i: (
        F.when(one(i).rlike("[0-9]"), F.substr(digits, at(i), F.lit(1))).when(one(i).rlike(r"\p{Lu}"), upper(i))
        .when(one(i).rlike(r"\p{L}"), F.substr(letters, at(i), F.lit(1))).otherwise(one(i)))), "")


def checked(body: Column) -> Column:
    """Digits with their Luhn check digit after them."""
    n = F.length(body)
    def share(i):
        d = F.substr(body, i, F.lit(1)).cast("int")
        twice = d * 2
        return F.when((n - i) % 2 == 0, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(d)
    total = F.aggregate(F.sequence(F.lit(1), n), F.lit(0), lambda sum_, i: sum_ + share(i))
    return F.concat(body, ((10 - total % 10) % 10).cast("string"))


def octet(digest: Column, first: int, below: int) -> Column:
    return (F.conv(F.substring(digest, first, 4), 16, 10).cast("int") % below + 1).cast("string")


def person(known: Column, key: Column, attempt: int) -> Column:
    """A name of the same gender, script and number of words. Its last word depends on the last word alone, so a short mention agrees."""
    parts = F.split(F.substring(known, 3, 1000), " ")
    given, last = F.element_at(parts, 1), F.element_at(parts, -1)
    female = F.substring(known, 1, 1) == "f"
    out = F.lit(None).cast("string")
    for script, pattern in (("greek", r"\p{IsGreek}"), ("cyrillic", r"\p{IsCyrillic}"), ("latin", "")):
        syllables, (male_end, female_end) = SYLLABLES[script], ENDINGS[script]
        d, g = F.sha2(F.concat(key, F.lit("|last|"), last), 256), F.sha2(F.concat(key, F.lit(f"|given|{attempt}|"), F.substring(known, 1, 1), given), 256)
        alone = F.sha2(F.concat(key, F.lit(f"|last|{attempt}|"), last), 256) if attempt else d
        surname = lambda x: F.concat(*[picked(x, i, syllables) for i in range(1, 6)])
        first = F.concat(*[picked(g, i, syllables) for i in range(1, 4)], F.when(female, female_end).otherwise(male_end))
        whole = F.initcap(F.when(F.size(parts) > 1, F.concat(first, F.lit(" "), surname(d))).otherwise(surname(alone)))
        out = F.coalesce(out, F.when(known.rlike(pattern), whole)) if pattern else F.coalesce(out, whole)
    return out


def surrogate(kind: Column, known: Column, secret: str, attempt: int) -> Column:
    """The canonical form of the replacement, from a keyed digest of the entity."""
    key = F.lit(secret)
    d = F.sha2(F.concat(key, F.lit("|"), kind, F.lit(f"|{attempt}|"), known), 256)
    digits, n = F.translate(d, "abcdef", "012345"), F.length(known)
    host = F.substring_index(known, "@", -1)
    domain = F.concat(F.substring(F.translate(F.sha2(F.concat(key, F.lit("|domain|"), host), 256), "0123456789", "qrstuvwxyz"), 1, 8),
                      F.lit(".example."), F.when(host.rlike(r"\.(org|net)$"), F.substring_index(host, ".", -1)).otherwise("com"))
    area = (F.substring(digits, 1, 1).cast("int") % 8 + 2).cast("string")
    kept = F.greatest(n - 10, F.lit(0))
    private = F.regexp_extract(known, r"^(10\.|192\.168\.|172\.(?:1[6-9]|2\d|3[01])\.|127\.)", 1)
    octets = F.concat_ws(".", octet(d, 1, 223), octet(d, 5, 254), octet(d, 9, 254), octet(d, 13, 254))
    dots = F.length(F.regexp_replace(private, r"[^.]", ""))
    return (F.when(kind == "email", F.concat(shaped(F.substring_index(known, "@", 1), d), F.lit("@"), domain))
            .when(kind == "phone", F.concat(F.substr(known, F.lit(1), kept), area, F.substr(digits, F.lit(2), n - kept - 1)))
            .when(kind == "card", checked(F.concat(F.substring(known, 1, 1), F.substr(digits, F.lit(1), n - 2))))
            .when(kind == "ssn", F.concat(F.lit("9"), F.substring(digits, 1, 8)))
            .when(kind == "iban", F.concat(F.substring(known, 1, 2), shaped(F.substr(known, F.lit(3)), d)))
            .when(kind == "ip", F.when(dots == 0, octets).otherwise(F.concat(private, F.array_join(F.slice(F.split(octets, r"\."), dots + 1, 4 - dots), "."))))
            .otherwise(person(known, key, attempt)))


def written(value: Column, kind: Column, known: Column, new: Column) -> Column:
    """The replacement in the format of this mention: separators, title and capitals as they were."""
    count = lambda i: F.length(F.regexp_replace(F.substr(value, F.lit(1), i), r"\D", ""))
    one = lambda i: F.substr(value, i, F.lit(1))
    digits = F.array_join(F.transform(F.sequence(F.lit(1), F.length(value)), lambda i: F.when(one(i).rlike("[0-9]"), F.substr(new, count(i), F.lit(1))).otherwise(one(i))), "")
    spaced = F.regexp_replace(new, "(.{4})(?=.)", "$1 ")
    name = F.regexp_replace(value, rf"^(?:{TITLES})\.? ", "")
    cased = F.when((F.upper(name) == name) & (F.length(name) > 1), F.upper(new)).otherwise(new)
    return (F.when(kind.isin(*DIGITS_ONLY), digits).when((kind == "iban") & value.contains(" "), spaced)
            .when((kind == "email") & (F.upper(value) == value), F.upper(new))
            .when(kind == "name", F.concat(F.regexp_extract(value, rf"^(?:{TITLES})\.? ", 0), cased)).otherwise(new))


def assigned(entities: DataFrame, secret: str, work: Workspace, rounds: int = ROUNDS) -> DataFrame:
    """kind, known, new: one surrogate for each entity, none of them shared and none equal to a real entity of its kind.

    An entity whose surrogate is taken tries again with another digest. Of several that want one, the smallest gets it. Those that found
    none after ``rounds`` (a kind with fewer values than entities) get their digest's letters, which no pattern mistakes for a value.
    """
    pending, done = entities, None
    for attempt in range(rounds):
        tried = work.cut(pending.withColumn("new", surrogate(F.col("kind"), F.col("known"), secret, attempt)), "tried", free=False)
        real = entities.select("kind", F.col("known").alias("new"))
        free = tried.join(real, ["kind", "new"], "left_anti")
        if done is not None:
            free = free.join(done.select("kind", "new"), ["kind", "new"], "left_anti")
        good = work.cut(free.groupBy("kind", "new").agg(F.min("known").alias("known")).select("kind", "known", "new"), "good", free=False)
        done = good if done is None else done.union(good)
        pending = work.cut(tried.select("kind", "known").join(good, ["kind", "known"], "left_anti"), "pending", free=False)
        if pending.isEmpty():
            return done
    return done.union(pending.withColumn("new", F.translate(F.sha2(F.concat(F.lit(secret), F.lit("|"), "kind", F.lit("|"), "known"), 256), "0123456789", "qrstuvwxyz")))


def pseudonymised(docs: DataFrame, work: Workspace, secret: str = "change this key") -> DataFrame:
    """One row per row of ``docs``: doc_id, text with surrogates, n_entities and the number of each kind.

    Mentions of one entity get one surrogate in the whole corpus and different entities different ones. Null text counts as empty; texts
    without personal data come back unchanged; rows that repeat an id or have none are treated each; an empty table gives no rows; other
    columns are not read. Only texts with personal data are written and joined; mentions, not texts, meet the table of surrogates.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    plain = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"))
    has = F.col("text").rlike(ANY)
    rows = plain.filter(has).select("doc_id", F.monotonically_increasing_id().alias("row"), F.split("text", ANY, -1).alias("parts"),
                                    F.regexp_extract_all("text", F.lit(ANY), F.lit(0)).alias("found"))
    rows = work.cut(rows, "rows")
    said = rows.select("row", F.posexplode("found").alias("place", "value")).withColumn("kind", kind_of(F.col("value")))
    said = work.cut(said.withColumn("known", canonical(F.col("value"), F.col("kind"))), "mentions")
    entities = work.cut(said.select("kind", "known").distinct(), "entities")
    table = work.cut(assigned(entities, secret, work), "surrogates")
    new = said.join(table, ["kind", "known"]).select("row", "place", "kind", written(F.col("value"), F.col("kind"), F.col("known"), F.col("new")).alias("new"))
    lists = new.groupBy("row").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "new"))), lambda x: x["new"]).alias("new"),
                                   F.count("*").alias("n_entities"), *[F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in PATTERNS])
    whole = F.array_join(F.zip_with("parts", F.concat("new", F.array(F.lit(""))), lambda a, b: F.concat(a, b)), "")
    counts = ["n_entities", *[f"n_{k}" for k in PATTERNS]]
    changed = rows.join(lists, "row").select("doc_id", whole.alias("text"), *counts)
    same = plain.filter(~has).select("doc_id", "text", *[F.lit(0).cast("bigint").alias(c) for c in counts])
    return same.union(changed)
