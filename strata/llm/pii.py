"""Personal data and secrets replaced by surrogates, in SQL expressions only.

Entities, which lie within a line, are found by one pattern (only lines with a
digit, a sign or a title are searched), brought to a canonical form (letter
case, separators and titles removed) and replaced by a keyed surrogate: a hash of
key, type and canonical form, drawn in the shape of the original.  Digits stay
digits and separators stay; card numbers pass the check-digit test; mail
addresses of one domain stay in one domain; a name keeps its title, number of
parts and script, and its given name is one of the gender its title states.
The same entity thus gets the same surrogate in every document, in every
format it is written in.

Distinctness is checked over the whole corpus: entities of one type that draw
the same surrogate, or one that is itself an entity of the corpus, draw again
(all but the smallest) until no two share one.  A name draws part by part, and
a part has one surrogate wherever it occurs: no two last names share a family
name and none gets one that is a last name of the corpus; of the first names
that draw the same given name beside one last name, all but the smallest get
one with syllables.  Only what was drawn again has to be joined back to the
documents.

Defined results: a null text stays null, an empty one empty, with no
entities.  Repeated rows and ids are rewritten one by one; a null id is kept.
Texts of any length are read whole.  Extra columns pass through.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import cut, fresh, table

KEY = "strata-surrogates"

_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
#: The kinds and their patterns, tried in this order.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+\-])[A-Za-z0-9._%+\-]++@[A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]+)+",
    "secret": r"(?<![A-Za-z0-9])(?i:password|passwd|pwd|token|secret|api[_-]?key)[ \t]{0,3}[=:][ \t]{0,3}[\"']?[A-Za-z0-9+/_\-]{8,}[\"']?",
    "access": r"(?<![A-Za-z0-9])(?:(?:AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36})(?![A-Za-z0-9])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ip": rf"(?<![\d.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\.?\d)",
    "card": r"(?<![\d.+])(?:\d{13,19}|\d{4}(?:[ \-]\d{4}){3}|\d{4}[ \-]\d{6}[ \-]\d{5})(?!\d)",
    "ssn": r"(?<![\d\-])\d{3}-\d{2}-\d{4}(?![\d\-])",
    "phone": r"(?<![\d.\w])(?:\+\d{1,3}[ .\-]?|1[ .\-])?(?:\(\d{2,4}\)|\d{2,4})[ .\-]?\d{3,4}[ .\-]\d{3,4}(?!\d)|(?<![\d\w])\+\d{8,15}(?!\d)",
    "name": (r"(?<!\p{L})(?:Mr|Mrs|Ms|Miss|Herr|Frau|Sir|Señora?|Sra?|Monsieur|Madame|Mme|Господин|Госпожа|Κύριος|Κυρία)\.?"
             r" \p{Lu}[\p{Ll}’'\-]+(?: \p{Lu}[\p{Ll}’'\-]+)?"),
}
PII = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: A line without any of these has no entity.
SIGNS = r"[0-9@=:]"
TITLES = ("Mr", "Ms", "Miss", "Herr", "Frau", "Sir ", "Señor", "Sr", "Monsieur", "Madame", "Mme", "Господин", "Госпожа",
          "Κύριος", "Κυρία", "AKIA", "ASIA", "ghp_", "gho_", "ghu_", "ghs_", "ghr_")
_TITLE = r"^(?:Mr|Mrs|Ms|Miss|Herr|Frau|Sir|Señora?|Sra?|Monsieur|Madame|Mme|Господин|Госпожа|Κύριος|Κυρία)\.? "
_SHE = r"^(?:Mrs|Ms|Miss|Frau|Señora|Sra|Madame|Mme|Госпожа|Κυρία)\b"
_VALUE = r"^(.*?[=:]\s*[\"']?)([A-Za-z0-9+/_\-]+)([\"']?)$"
#: Given names by script and gender, and syllables of family names.
GIVEN = {
    "latin": ("Adam Bruno Carlo David Emil Felix Georg Hugo Ivan Jonas Karl Leon Marco Nils Oscar Paul",
              "Anna Berta Clara Diana Elena Flora Gina Helga Irene Julia Katja Laura Maria Nora Olga Paula"),
    "cyrillic": ("Антон Борис Виктор Глеб Денис Егор Иван Кирилл Лев Максим Никита Олег Павел Роман Семён Тимур",
                 "Алла Белла Вера Галина Дарья Елена Жанна Зоя Инна Кира Лидия Майя Нина Ольга Полина Раиса"),
    "greek": ("Άρης Γιώργος Δήμος Ηλίας Θάνος Κώστας Λάμπρος Μάνος Νίκος Ορέστης Πέτρος Σπύρος Τάσος Φώτης Χάρης Αλέξης",
              "Άννα Βάσω Γεωργία Δήμητρα Ελένη Ζωή Ηρώ Θάλεια Ιωάννα Κατερίνα Λένα Μαρία Νίκη Όλγα Ρένα Σοφία"),
}
SYLLABLES = {
    "latin": "bar cor del fen gar hol jun kel lan mor nev pol ras sol tam vek",
    "cyrillic": "бар вол гор дан зем кол лаб мир нов пол рад сок тар фом хар чер",
    "greek": "βαρ γαλ δημ ζαφ θεο καρ λαμ μαν νικ παν ραλ σαβ τζα φιλ χρι ψαλ",
}


ENTITIES = "array<struct<m:string,kind:string,canon:string>>"


def hinted(line: Column) -> Column:
    return reduce(lambda a, t: a | line.contains(t), TITLES, line.rlike(SIGNS))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def kind_of(m: Column) -> Column:
    """The kind of a match, by the first pattern that covers it whole."""
    out = F.lit("name")
    for kind in reversed([k for k in PATTERNS if k != "name"]):
        # look-arounds see only the match here, so the bare pattern decides
        out = F.when(m.rlike(f"^(?:{PATTERNS[kind]})$"), F.lit(kind)).otherwise(out)
    return out


def digits(c: Column) -> Column:
    return F.regexp_replace(c, r"[^0-9]", "")


def canonical(kind: Column, m: Column) -> Column:
    return (F.when(kind == "email", F.lower(m))
            .when(kind == "phone", F.regexp_replace(digits(m), r"^1(?=\d{10}$)", ""))
            .when(kind.isin("card", "ssn"), digits(m))
            .when(kind == "iban", F.regexp_replace(m, " ", ""))
            .when(kind == "secret", F.regexp_extract(m, _VALUE, 2))
            # the title's gender belongs to the name; the title itself does not
            .when(kind == "name", F.concat(F.when(m.rlike(_SHE), F.lit("f ")).otherwise(F.lit("m ")),
                                           F.lower(F.regexp_replace(m, _TITLE, ""))))
            .otherwise(m))


def keyed(key: str, *parts: Column) -> Column:
    """128 hex digits that depend on the secret key and the parts."""
    whole = F.concat_ws("|", F.lit(key), *parts)
    return F.concat(F.sha2(whole, 256), F.sha2(F.concat(F.lit("2|"), whole), 256))


def shaped(c: Column, h: Column) -> Column:
    """``c`` with each letter and digit replaced by one drawn from ``h``; all else stays."""
    def draw(x: Column, i: Column) -> Column:
        at = F.pmod(i * 2, F.lit(128)) + 1
        n = F.conv(F.substr(h, at, F.lit(2)), 16, 10).cast("int") + F.floor(i / 64).cast("int")
        pick = lambda letters: F.substr(F.lit(letters), F.pmod(n, F.lit(len(letters))) + 1, F.lit(1))
        # the letters of hexadecimal keys stay such letters
        return (F.when(x.rlike("[0-9]"), pick("0123456789"))
                .when(x.rlike("[a-f]"), pick("abcdef")).when(x.rlike("[g-z]"), pick("ghijklmnopqrstuvwxyz"))
                .when(x.rlike("[A-Z]"), pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ")).otherwise(x))
    return F.array_join(F.transform(F.filter(F.split(c, ""), lambda x: x != ""), draw), "")


def check_digit(body: Column) -> Column:
    """The digit that makes ``body`` plus it pass the mod-10 test."""
    n = F.length(body)
    total = F.aggregate(F.sequence(F.lit(1), n), F.lit(0), lambda a, i: a + F.when(
        F.pmod(n - i, F.lit(2)) == 0,
        F.element_at(F.array(*map(F.lit, (0, 2, 4, 6, 8, 1, 3, 5, 7, 9))), F.substr(body, i, F.lit(1)).cast("int") + 1))
        .otherwise(F.substr(body, i, F.lit(1)).cast("int")))
    return F.pmod(10 - F.pmod(total, F.lit(10)), F.lit(10)).cast("string")


def script_of(c: Column) -> Column:
    return F.when(c.rlike(r"\p{IsCyrillic}"), F.lit("cyrillic")).when(c.rlike(r"\p{IsGreek}"), F.lit("greek")) \
        .otherwise(F.lit("latin"))


def hex_at(h: Column, i: int) -> Column:
    return F.conv(F.substr(h, F.lit(i + 1), F.lit(1)), 16, 10).cast("int") + 1


def name_part(canon: Column, part: str) -> Column:
    """The part of a canonical name that draws by itself: the last name, or gender and first name (null: none)."""
    words = F.split(F.substr(canon, F.lit(3), F.length(canon)), " ")
    if part == "family":
        return F.element_at(words, -1)
    return F.when(F.size(words) > 1, F.concat(F.substr(canon, F.lit(1), F.lit(2)), F.element_at(words, 1)))


def drawn_part(key: str, kind: str, canon: Column, attempt: Column) -> Column:
    """The surrogate of a part of a name: syllables, or a listed given name (again: with syllables) of its gender."""
    first = F.substr(canon, F.lit(3), F.length(canon)) if kind == "given" else canon
    h = keyed(key, F.lit(kind), first)
    more = keyed(key, F.lit("again"), F.lit(kind), canon, attempt.cast("string"))

    def of(script: str) -> Column:
        syllables = F.array(*map(F.lit, SYLLABLES[script].split()))
        build = lambda x, n: [F.element_at(syllables, hex_at(x, i)) for i in range(n)]
        if kind == "family":
            return F.initcap(F.concat(*build(h, 4), F.when(attempt > 0, F.concat(*build(more, 3))).otherwise(F.lit(""))))
        he, she = (F.array(*map(F.lit, GIVEN[script][g].split())) for g in (0, 1))
        base = F.when(canon.startswith("f "), F.element_at(she, hex_at(h, 0))).otherwise(F.element_at(he, hex_at(h, 0)))
        return F.concat(base, F.when(attempt > 0, F.concat(*build(more, 5))).otherwise(F.lit("")))
    script = script_of(first)
    return F.when(script == "cyrillic", of("cyrillic")).when(script == "greek", of("greek")).otherwise(of("latin"))


def surrogate_name(key: str, canon: Column, attempt_of: Callable[[Column, Column], Column]) -> Column:
    """Given name by gender and script, family name of syllables; each follows from its own part of the name."""
    def of(kind: str) -> Column:
        part = name_part(canon, kind)
        return F.when(part.isNotNull(), drawn_part(key, kind, part, attempt_of(F.lit(kind), part)))
    return F.concat_ws(" ", of("given"), of("family"))


def surrogate(key: str, kind: Column, canon: Column, attempt: Column, name: Column) -> Column:
    """The canonical surrogate of a canonical entity; ``name`` is that of a name."""
    def of(h: Column) -> Column:
        part = lambda i: F.conv(F.substr(h, F.lit(1 + 6 * i), F.lit(6)), 16, 10).cast("long")
        size = F.length(canon)
        local, domain = F.substring_index(canon, "@", 1), F.substring_index(canon, "@", -1)
        letters = lambda c: F.translate(c, "0123456789", "ghijklmnop")
        mail = F.concat(shaped(local, h),
                        F.when(F.length(local) >= 8, F.lit("")).otherwise(F.concat(F.lit("."), letters(F.substr(h, F.lit(100), F.lit(8))))),
                        F.lit("@"), letters(F.substr(keyed(key, F.lit("domain"), domain), F.lit(1), F.lit(10))), F.lit(".example"))
        ip = F.concat_ws(".", F.pmod(part(0), F.lit(100)) + 20, *(F.pmod(part(i), F.lit(254)) + 1 for i in (1, 2, 3)))
        valid = check_digit(F.substr(canon, F.lit(1), size - 1)) == F.substr(canon, size, F.lit(1))
        plain = let(shaped(canon, h), lambda drawn: (
            F.when((kind == "card") & valid, let(F.substr(drawn, F.lit(1), size - 1), lambda b: F.concat(b, check_digit(b))))
            .when(kind == "iban", F.concat(F.substr(canon, F.lit(1), F.lit(2)), F.substr(drawn, F.lit(3), size)))
            .when(kind == "access", F.concat(F.substr(canon, F.lit(1), F.lit(4)), F.substr(drawn, F.lit(5), size)))
            .otherwise(drawn)))
        return (F.when(kind == "email", mail).when(kind == "ip", ip)
                .when(kind == "name", name).otherwise(plain))
    return let(keyed(key, kind, canon, attempt.cast("string")), of)


def render(kind: Column, m: Column, drawn: Column) -> Column:
    """The canonical surrogate in the format of the match; a country code beyond it stays."""
    place = lambda i: F.length(F.regexp_replace(F.substr(m, F.lit(1), i), "[^A-Za-z0-9]", ""))
    spaced = let(F.length(F.regexp_replace(m, "[^A-Za-z0-9]", "")) - F.length(drawn), lambda extra: F.array_join(F.transform(
        F.filter(F.split(m, ""), lambda x: x != ""),
        lambda x, i: F.when(x.rlike("[A-Za-z0-9]") & (place(i) >= extra), F.substr(drawn, place(i) - extra + 1, F.lit(1)))
        .otherwise(x)), ""))
    upper = (kind == "email") & (m == F.upper(m)) & (m != F.lower(m))
    return (F.when(upper, F.upper(drawn))
            .when(kind.isin("card", "ssn", "phone", "iban"), spaced)
            .when(kind == "secret", F.concat(F.regexp_extract(m, _VALUE, 1), drawn, F.regexp_extract(m, _VALUE, 3)))
            .when(kind == "name", F.concat(F.regexp_extract(m, _TITLE, 0), drawn))
            .otherwise(drawn))


def found(line: Column) -> Column:
    """Entities of a line in order: match, kind, canonical form."""
    kinds = F.transform(F.regexp_extract_all(line, F.lit(PII), F.lit(0)), lambda m: F.struct(m.alias("m"), kind_of(m).alias("kind")))
    return F.transform(kinds, lambda e: F.struct(e["m"].alias("m"), e["kind"].alias("kind"),
                                                 canonical(e["kind"], e["m"]).alias("canon")))


def searched(text: Column) -> Column:
    """Per line: its number and its entities, for the lines that have any."""
    lines = F.transform(F.split(text, "\n", -1), lambda x, i: F.when(hinted(x), F.struct(i.alias("line"), found(x).alias("e"))))
    none = F.array().cast(f"array<struct<line:int,e:{ENTITIES}>>")
    return F.when(hinted(text), F.filter(lines, lambda x: x.isNotNull() & (F.size(x["e"]) > 0))).otherwise(none)


def parts_of(kind: Column, canon: Column) -> Column:
    """What an entity draws: itself, or the parts of a name."""
    parts = F.filter(F.array(*(F.struct(F.lit(k).alias("kind"), name_part(canon, k).alias("canon")) for k in ("family", "given"))),
                     lambda x: x["canon"].isNotNull())
    return F.when(kind == "name", parts).otherwise(F.array(F.struct(kind.alias("kind"), canon.alias("canon"))))


def redrawn(entities: DataFrame, key: str) -> DataFrame:
    """(kind, canon, attempt) of what may not keep its first surrogate: entities, last names ("family") and
    first names with gender ("given").

    Each round redraws the losers of every clash and ends when there is none.
    """
    drawing = entities.select(F.explode(parts_of(F.col("kind"), F.col("canon"))).alias("p")).select("p.kind", "p.canon").distinct()
    whole = cut(drawing.where(F.col("kind") != "given"))

    def clashes(own: DataFrame) -> DataFrame:
        family = F.lower(drawn_part(key, "family", F.col("canon"), F.col("attempt")))
        drawn = own.withColumn("drawn", surrogate(key, F.col("kind"), F.col("canon"), F.col("attempt"), F.lit(None).cast("string")))
        drawn = drawn.withColumn("drawn", F.when(F.col("kind") == "family", family).otherwise(F.col("drawn")))
        # a surrogate taken by two entities, or one that some entity of the corpus really is; with no real last name
        # drawn, no whole name is real under either gender
        real = whole.select("kind", F.col("canon").alias("drawn"), F.lit(1).alias("real"), F.lit(None).cast("string").alias("canon"))
        taken = (drawn.select("kind", "drawn", F.lit(0).alias("real"), "canon").unionByName(real)
                 .groupBy("kind", "drawn").agg(F.max("real").alias("real"), F.count("canon").alias("n"), F.min("canon").alias("first"))
                 .where((F.col("n") > 1) | (F.col("real") == 1) & (F.col("n") > 0)))
        return (drawn.join(taken, ["kind", "drawn"]).where((F.col("real") == 1) | (F.col("canon") != F.col("first")))
                .select("kind", "canon", "attempt"))

    # first names of one gender beside the same last name; families are distinct by themselves
    beside = cut(entities.where((F.col("kind") == "name") & name_part(F.col("canon"), "given").isNotNull())
                 .select(F.lit("given").alias("kind"), name_part(F.col("canon"), "given").alias("canon"),
                         name_part(F.col("canon"), "family").alias("last")))

    def given_clashes(own: DataFrame) -> DataFrame:
        drawn = own.withColumn("drawn", F.concat(F.substr("canon", F.lit(1), F.lit(2)), drawn_part(key, "given", F.col("canon"), F.col("attempt"))))
        taken = (drawn.groupBy("last", "drawn").agg(F.count(F.lit(1)).alias("n"), F.min("canon").alias("first")).where(F.col("n") > 1))
        return (drawn.join(taken, ["last", "drawn"]).where(F.col("canon") != F.col("first"))
                .select("kind", "canon", "attempt").distinct())

    return settled(whole, clashes).unionByName(settled(beside, given_clashes))


def settled(entities: DataFrame, clashes: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(kind, canon, attempt) of the entities that had to draw again until ``clashes`` finds none."""
    spark = entities.sparkSession
    moved = None
    for _ in range(64):
        own = entities.withColumn("attempt", F.lit(0)) if moved is None else entities.join(
            moved, ["kind", "canon"], "left").withColumn("attempt", F.coalesce("attempt", F.lit(0)))
        losers = cut(clashes(own).withColumn("attempt", F.col("attempt") + 1))
        if losers.isEmpty():
            return moved if moved is not None else spark.createDataFrame([], "kind string, canon string, attempt int")
        rest = losers if moved is None else losers.unionByName(moved.join(losers, ["kind", "canon"], "left_anti"))
        moved = cut(rest)
    raise RuntimeError("surrogates still clash after 64 rounds")


def rewrite(docs: DataFrame, key: str = KEY, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, str, str]:
    """``docs`` plus two columns: the rewritten text and the entities found (kind, match, surrogate)."""
    text, ents, again, out = F.col(text_col), fresh("entities"), fresh("again"), fresh("text")
    flat = lambda c: F.flatten(F.transform(c, lambda x: x["e"]))
    spread = (docs.select(F.col(id_col).alias("id"), F.explode(flat(searched(text))).alias("e"))
              .select("id", F.col("e")["kind"].alias("kind"), F.col("e")["canon"].alias("canon")))
    entities = cut(spread.select("kind", "canon").distinct())
    moved = redrawn(entities, key)
    held = docs.withColumn(ents, searched(text))
    if moved.isEmpty():
        held = held.withColumn(again, F.lit(None).cast("map<string,int>"))
    else:
        # attempts belong to entities and parts of names, so one map per id serves all rows of that id
        drawing = spread.select("id", F.explode(parts_of(F.col("kind"), F.col("canon"))).alias("p")).select("id", "p.kind", "p.canon")
        hits = (drawing.distinct().join(moved, ["kind", "canon"]).groupBy(F.col("id").alias(other := fresh("id")))
                .agg(F.map_from_entries(F.collect_list(F.struct(F.concat_ws("|", "kind", "canon"), "attempt"))).alias(again)))
        held = held.join(hits, F.col(id_col).eqNullSafe(F.col(other)), "left").drop(other)

    def attempt_of(kind: Column, canon: Column) -> Column:
        return F.coalesce(F.element_at(F.col(again), F.concat_ws("|", kind, canon)), F.lit(0))

    def replaced(e: Column) -> Column:
        drawn = surrogate(key, e["kind"], e["canon"], attempt_of(e["kind"], e["canon"]), surrogate_name(key, e["canon"], attempt_of))
        return F.struct(e["kind"].alias("kind"), e["m"].alias("entity"), render(e["kind"], e["m"], drawn).alias("surrogate"))

    lines = F.split(text, "\n", -1)
    done = held.withColumn(ents, F.transform(ents, lambda x: F.struct(
        x["line"].alias("line"), F.transform(x["e"], replaced).alias("e"), F.split(lines[x["line"]], PII, -1).alias("between"))))
    rebuilt = lambda x: F.array_join(F.zip_with(x["between"], x["e"], lambda p, e: F.concat(p, F.coalesce(e["surrogate"], F.lit("")))), "")
    numbered = F.map_from_entries(F.transform(ents, lambda x: F.struct(x["line"], rebuilt(x))))
    joined = let(numbered, lambda new: F.array_join(F.transform(lines, lambda x, i: F.coalesce(F.element_at(new, i), x)), "\n"))
    done = done.withColumn(out, F.when(F.size(ents) > 0, joined).otherwise(text))
    return done.withColumn(ents, flat(F.col(ents))).drop(again), out, ents


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done, text, ents = rewrite(docs)
    return done.select("doc_id", F.col(text).alias("text"), F.size(ents).cast("long").alias("n_entities"),
                       F.transform(ents, lambda e: e["kind"]).alias("kinds"))


def stage_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: every document with its rewritten text and that text's length."""
    done, text, _ = rewrite(docs)
    return done.select(*(F.col(text).alias("text") if c == "text" else
                         F.length(text).cast(docs.schema["n_chars"].dataType).alias("n_chars") if c == "n_chars" else F.col(c)
                         for c in docs.columns))


QUERIES = {"op8_pii": op8_pii}
SQL: dict[str, str] = {}
