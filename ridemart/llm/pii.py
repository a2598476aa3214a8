r"""Operator 5, surrogates for personal data, with DataFrame functions only.

One pattern finds entities; each distinct entity (type and canonical value) gets a surrogate that a key
and a hash decide: digits for digits, letters of the same case and script for letters, so lengths,
separators and scripts stay; e-mail addresses keep their top-level label, phone numbers their country
code, card numbers their first digit and a right check digit, names their title's gender and the
script of their letters. Spellings of one value (letter case of an address, separators of a number)
share a surrogate, everywhere in the corpus. Collisions are checked over the whole corpus: of two
values with one surrogate, and where a surrogate is itself a value that occurs, the later one draws
again until none is left, so different values stay different. After some attempts a draw gets longer by
a letter, digit or syllable each time (``PATIENCE``), so there are always enough surrogates.

A text's entities are looked up by a digest of the text, so copies of a text are handled once and texts
without entities are never shuffled.

Defined results: a null text stays null and an empty one empty; repeated rows are replaced alike; an
empty table gives no rows; other columns stay as they are, whatever their names, in ``row``.
"""

from __future__ import annotations

import sys
import unicodedata

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridemart.llm.common import read_table, stored

#: Titles by gender, in Latin and Cyrillic letters.
TITLES = {"m": "Mr|Herr|Monsieur|Señor|Господин|г-н", "f": "Mrs|Ms|Miss|Frau|Madame|Señora|Госпожа|г-жа", "n": "Dr|Prof"}
#: Given names for surrogates, by gender and script.
NAMES = {
    ("m", "latin"): "Adam Bruno Conrad Denis Emil Felix Gustav Hugo Ivan Jonas Karl Leon Martin Noel Oscar Paul".split(),
    ("f", "latin"): "Alma Berta Clara Diana Elena Flora Greta Hanna Irene Julia Klara Laura Marta Nora Olga Paula".split(),
    ("m", "cyrillic"): "Антон Борис Виктор Глеб Денис Егор Иван Кирилл Лев Максим Никита Олег Павел Роман Степан Тимур".split(),
    ("f", "cyrillic"): "Анна Вера Галина Дарья Елена Жанна Зоя Инна Клара Лидия Мария Нина Ольга Полина Раиса София".split(),
}
NAMES[("n", "latin")] = [x for p in zip(NAMES["m", "latin"], NAMES["f", "latin"]) for x in p][:16]
NAMES[("n", "cyrillic")] = [x for p in zip(NAMES["m", "cyrillic"], NAMES["f", "cyrillic"]) for x in p][:16]
#: Syllables that surrogate family names are made of.
SYLLABLES = {"latin": "bal den fer gor hal kim lan mor nev pol ras sel tan ver wil zan".split(),
             "cyrillic": "бал ден фер гор хал ким лан мор нев пол рас сел тан вер лиз зан".split()}

#: The decimal digits of all scripts, ten by ten.
DIGITS = "".join(chr(z + k) for z in range(sys.maxunicode) if unicodedata.decimal(chr(z), 1) == 0 for k in range(10))
#: What stands for the characters of a secret without letters and digits.
SYMBOLS = "!#$%&*+-./:=?@^_~"
#: Attempts of a type before its draws get longer; an address keeps its four numbers for longest.
PATIENCE = {"name": 1, "ipv4": 16}
PATIENCE_ELSE = 6

_ALL_TITLES = "|".join(TITLES.values())
#: Types in the order in which they are tried, with their patterns.
PATTERNS = {
    "secret": r"(?<=[=:\s\"'])(?<=(?i:password|passwd|secret|token|api_key)\s{0,3}[=:]\s{0,3}[\"']?)[^\s\"']{6,}",
    # only from the start of a run of its characters or where the last match ended, and with bounded parts, so that no
    # run is read again and again: a name of 256 characters (mail allows 64), a host of 127 labels (as DNS does)
    "email": r"(?:\G|(?<![\p{L}\p{N}._%+-]))[\p{L}\p{N}._%+-]{1,256}+@[\p{L}\p{N}-]+(?:\.[\p{L}\p{N}-]+){0,126}\.\p{L}{2,}",
    "iban": r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b",
    "awskey": r"\b(?:AKIA|ASIA)[A-Z0-9]{16}\b",
    "hexkey": r"\b(?=[0-9a-f]*[a-f])(?=[0-9a-f]*[0-9])[0-9a-f]{16,64}\b",
    "ipv4": r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d]|\.\d)",
    "card": r"(?<!\d)\d(?:[ -]?\d){12,18}(?!\d)",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    # with a plus sign, with brackets, or in groups that are no thousands, years or decimals
    "phone": r"(?=[+(\d])(?<![\d+])(?:\+\d{1,3}[ .-]?(?:\(\d{2,4}\)|\d{2,4})[ .-]\d{3,4}[ .-]?\d{3,4}(?!\d)|\+\d{7,15}(?!\d)"
             r"|\(\d{2,4}\)[ .-]\d{3,4}[ .-]?\d{3,4}(?!\d)"
             r"|(?<!\d[.,])(?:\d{3}[ .-]\d{3}[ .-]\d{4}|\d{3}[ -]\d{4}[ -]\d{4}|\d{2}-\d{4}-\d{4}|\d{3}-\d{7}"
             r"|0\d{1,3}(?:[ -]\d{3,4}[ -]?|\.\d{3,4}\.)\d{3,4})(?!\d|[.,]\d))",
    "name": rf"(?<!\p{{L}})(?:{_ALL_TITLES})\.? \p{{Lu}}\p{{Ll}}+(?: \p{{Lu}}\p{{Ll}}+)?",
}
ENTITY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: The same; group 1 takes part where a match is a secret.
ENTITY_SECRET = "|".join(f"({p})" if k == "secret" else f"(?:{p})" for k, p in PATTERNS.items())
#: What is looked for in digits whose Luhn sum is wrong: card numbers in their usual groups, and all other types.
INNER = "|".join(f"(?:{p})" for p in ({k: p for k, p in PATTERNS.items() if k != "secret"} | {
    "card": r"(?<!\d)(?:\d{13,19}|\d{4}([ -])\d{4}\1\d{4}\1\d{4}|\d{4}([ -])\d{6}\2\d{5})(?!\d)"}).values())
#: No entity is without one of these.
HINT = rf"[\d@]|A(?:KI|SI)A|(?i:password|passwd|secret|token|api_key)|(?:{_ALL_TITLES})\.? \p{{Lu}}"


def _typed(raw: Column) -> Column:
    """Type of a match. Secrets are told by what stands before them, so they are what fits nothing else."""
    kind = None
    for name, pattern in PATTERNS.items():
        if name != "secret":
            whole = raw.rlike(rf"\A(?:{pattern})\z")
            kind = F.when(whole, F.lit(name)) if kind is None else kind.when(whole, F.lit(name))
    return kind.otherwise(F.lit("secret"))


def _canonical(kind: Column, raw: Column) -> Column:
    return (F.when(kind == "email", F.lower(raw))
            .when(kind.isin("card", "ssn", "phone", "iban"), F.regexp_replace(raw, r"[^\p{L}\p{N}]", ""))
            .when(kind == "name", F.regexp_replace(raw, r"\. ", " ")).otherwise(raw))


def _draw(stream: Column, i: Column) -> Column:
    """A number from 0 to 255 for place i of a hex stream of 256 characters."""
    return F.conv(F.substring(stream, 2 * F.pmod(i, F.lit(120)) + 1, F.lit(2)), 16, 10).cast("int") + i * 7


def _pick(options: str, n: Column) -> Column:
    return F.substring(F.lit(options), F.pmod(n, F.lit(len(options))) + 1, F.lit(1))


def _letters(text: Column, stream: Column, keep: Column | None = None) -> Column:
    """Each letter and digit replaced by one of its class and script; the first ``keep`` stay. A text without any
    has its symbols replaced."""
    bare = ~text.rlike(r"[\p{L}\p{Nd}]")

    def digit(ch: Column, n: Column) -> Column:
        at = F.instr(F.lit(DIGITS), ch) - 1
        return F.substring(F.lit(DIGITS), at - at % 10 + F.pmod(n, F.lit(10)) + 1, F.lit(1))

    def one(ch: Column, i: Column) -> Column:
        n = _draw(stream, i)
        new = (F.when(ch.rlike("[0-9]"), _pick("0123456789", n)).when(ch.rlike("[a-z]"), _pick("abcdefghijklmnopqrstuvwxyz", n))
               .when(ch.rlike("[A-Z]"), _pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ", n))
               .when(ch.rlike(r"\p{IsCyrillic}"), F.when(ch.rlike(r"\p{Lu}"), _pick("АБВГДЕЖЗИКЛМНОПРСТУФХЦЧШЭЮЯ", n))
                     .otherwise(_pick("абвгдежзиклмнопрстуфхцчшэюя", n)))
               .when(ch.rlike(r"\p{IsGreek}"), F.when(ch.rlike(r"\p{Lu}"), _pick("ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ", n))
                     .otherwise(_pick("αβγδεζηθικλμνξοπρστυφχψω", n)))
               .when(ch.rlike(r"\p{Lu}"), _pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ", n))
               .when(ch.rlike(r"\p{L}"), _pick("abcdefghijklmnopqrstuvwxyz", n))
               .when(ch.rlike(r"\p{Nd}"), F.when(F.instr(F.lit(DIGITS), ch) > 0, digit(ch, n)).otherwise(_pick("0123456789", n)))
               .when(bare, _pick(SYMBOLS, n)).otherwise(ch))
        return new if keep is None else F.when(i < keep, ch).otherwise(new)

    return F.array_join(F.transform(F.split(text, ""), one), "")


def _luhn(digits: Column) -> Column:
    """The digits with the last one set so that the Luhn sum is right."""
    body = F.substring(digits, F.lit(1), F.length(digits) - 1)
    marks = F.transform(F.reverse(F.split(body, "")), lambda ch, i: F.when(
        i % 2 == 0, F.when(ch.cast("int") > 4, ch.cast("int") * 2 - 9).otherwise(ch.cast("int") * 2)).otherwise(ch.cast("int")))
    total = F.aggregate(marks, F.lit(0), lambda a, x: a + x)
    return F.concat(body, F.pmod(10 - total % 10, F.lit(10)).cast("string"))


def _no_card(raw: Column) -> Column:
    """Digits that look like a card number, with a wrong Luhn sum."""
    digits = F.regexp_replace(raw, "[ -]", "")
    return F.when(raw.rlike(rf"\A(?:{PATTERNS['card']})\z"), digits != _luhn(digits)).otherwise(F.lit(False))


def _inside(raw: Column) -> Column:
    """Digits that are no card as structs (raw, entity) in their order: other entities, and what is between them."""
    return F.flatten(F.zip_with(F.split(raw, INNER, -1), F.regexp_extract_all(raw, F.lit(INNER), F.lit(0)), lambda p, x: F.array(
        F.struct(F.coalesce(p, F.lit("")).alias("raw"), F.lit(False).alias("entity")),
        F.struct(F.coalesce(x, F.lit("")).alias("raw"), (x.isNotNull() & ~_no_card(x)).alias("entity")))))


def _octets(stream: Column, attempt: Column) -> Column:
    return F.concat_ws(".", *[(1 + F.pmod(_draw(stream, F.lit(4 * i)) * 5 + attempt, F.lit(254))).cast("string")
                              for i in range(4)])


def _more(seed: Column, kind: Column, attempt: Column) -> Column:
    """Hex digits that a draw is longer by: none until the type's patience ends, then one more with each attempt."""
    wait = F.lit(PATIENCE_ELSE)
    for k, n in PATIENCE.items():
        wait = F.when(kind == k, n).otherwise(wait)
    return F.substring(F.sha2(F.concat(seed, F.lit("*")).cast("binary"), 512), F.lit(1), F.greatest(F.lit(0), attempt - wait))


def _person(value: Column, stream: Column, more: Column) -> Column:
    """The title, a given name of its gender if the name has two parts, and a family name, all in the
    script of the name; one more syllable for each hex digit of ``more``."""
    title, rest = F.regexp_extract(value, rf"\A({_ALL_TITLES})", 1), F.regexp_replace(value, rf"\A(?:{_ALL_TITLES})\.? ", "")
    script = F.when(rest.rlike(r"\p{IsCyrillic}"), F.lit("cyrillic")).otherwise(F.lit("latin"))
    gender = F.when(title.rlike(rf"\A(?:{TITLES['m']})\z"), F.lit("m")).when(
        title.rlike(rf"\A(?:{TITLES['f']})\z"), F.lit("f")).otherwise(F.lit("n"))

    def chosen(options: dict, key: Column, place: int) -> Column:
        out = None
        for k, v in options.items():
            name = F.element_at(F.array(*[F.lit(x) for x in v]), F.pmod(_draw(stream, F.lit(place)), F.lit(len(v))) + 1)
            k = "/".join(k) if isinstance(k, tuple) else k
            out = F.when(key == k, name) if out is None else out.when(key == k, name)
        return out

    given = chosen(NAMES, F.concat_ws("/", gender, script), 0)

    def syllable(script: str):
        return lambda h: F.element_at(F.array(*[F.lit(x) for x in SYLLABLES[script]]),
                                      F.conv(F.nullif(h, F.lit("")), 16, 10).cast("int") + 1)

    added = {k: F.array_join(F.transform(F.split(more, ""), syllable(k)), "") for k in SYLLABLES}
    family = F.initcap(F.concat(*[chosen(SYLLABLES, script, i) for i in (3, 5, 9, 11)],
                                F.when(script == "cyrillic", added["cyrillic"]).otherwise(added["latin"])))
    return F.when(rest.contains(" "), F.concat_ws(" ", title, given, family)).otherwise(F.concat_ws(" ", title, family))


def _surrogate(kind: Column, value: Column, attempt: Column, key: str) -> Column:
    """The draw of a value. Its hashes are bound once: inside the functions over characters they would be taken of the
    whole value again for each of its characters."""
    seed = F.concat_ws("\u0001", F.lit(key), kind, value, attempt.cast("string"))
    stream = F.concat(F.sha2(seed.cast("binary"), 512), F.sha2(F.concat(seed, F.lit("+")).cast("binary"), 512))
    bound = F.array(F.struct(stream.alias("stream"), _more(seed, kind, attempt).alias("more")))
    return F.get(F.transform(bound, lambda x: _drawn(kind, value, attempt, x["stream"], x["more"])), F.lit(0))


def _drawn(kind: Column, value: Column, attempt: Column, stream: Column, more: Column) -> Column:
    digits, letters = F.translate(more, "abcdef", "012345"), F.translate(more, "0123456789", "ghijklmnop")
    groups = F.regexp_replace(digits, r"(\d)", ".$1")
    at = F.instr(value, "@")
    host_end = F.length(value) - F.length(F.substring_index(value, ".", -1))
    mail = F.concat(_letters(F.substring(value, F.lit(1), host_end), stream),
                    F.substring(value, host_end + 1, F.length(value)))
    return (F.when(kind == "email", F.when(at > 0, F.concat(letters, mail)))
            .when(kind == "ipv4", F.concat(_octets(stream, attempt), groups))
            .when(kind == "card", _luhn(F.concat(_letters(value, stream, F.lit(1)), digits)))
            # a canonical phone number starts with its country code: keep the digits beyond ten
            .when(kind == "phone", F.concat(_letters(value, stream, F.greatest(F.lit(0), F.least(F.lit(3), F.length(value) - 10))), digits))
            .when(kind == "ssn", F.concat(_letters(value, stream), digits))
            .when(kind == "iban", F.concat(_letters(value, stream, F.lit(2)), digits))
            .when(kind == "awskey", F.concat(_letters(value, stream, F.lit(4)), digits))
            .when(kind == "name", _person(value, stream, more))
            .when(kind == "hexkey", F.concat(F.array_join(F.transform(F.split(value, ""), lambda ch, i: F.when(
                ch.rlike("[0-9]"), _pick("0123456789", _draw(stream, i))).otherwise(_pick("abcdef", _draw(stream, i)))), ""), more))
            .otherwise(F.concat(_letters(value, stream), letters)))


def _formatted(kind: Column, raw: Column, value: Column) -> Column:
    """A surrogate of a canonical value in the format of one occurrence: separators and letter case. What it has
    beyond the places of the occurrence follows at its end."""
    def place(ch: Column, i: Column) -> Column:
        before = F.length(F.regexp_replace(F.substring(raw, F.lit(1), i), r"[^\p{L}\p{N}]", ""))
        return F.when(ch.rlike(r"[\p{L}\p{N}]"), F.substring(value, before + 1, F.lit(1))).otherwise(ch)

    places = F.length(F.regexp_replace(raw, r"[^\p{L}\p{N}]", ""))
    spread = F.concat(F.array_join(F.transform(F.split(raw, ""), place), ""), F.substring(value, places + 1, F.length(value)))
    return (F.when(kind.isin("card", "ssn", "phone", "iban"), spread)
            .when((kind == "email") & (raw == F.upper(raw)), F.upper(value))
            .when((kind == "name") & raw.contains(". "), F.regexp_replace(value, rf"\A({_ALL_TITLES}) ", "$1. "))
            .otherwise(value))


def surrogates(entities: DataFrame, key: str) -> DataFrame:
    """(kind, value, surrogate) for distinct (kind, value): no two values of a kind share a surrogate, and none is
    itself a value of its kind. Rows whose draw is taken draw again; the rest are settled."""
    real = stored(entities.distinct(), "pii-values")
    now = real.withColumn("attempt", F.lit(0))
    while True:
        now = now.withColumn("surrogate", _surrogate(F.col("kind"), F.col("value"), F.col("attempt"), key))
        order = Window.partitionBy("kind", F.lower("surrogate")).orderBy("attempt", "value")
        taken = real.select(F.col("kind"), F.lower("value").alias("_low")).distinct().withColumn("_real", F.lit(1))
        now = stored(now.withColumn("_nth", F.row_number().over(order)).withColumn("_low", F.lower("surrogate"))
                     .join(taken, ["kind", "_low"], "left")
                     .withColumn("again", (F.col("_nth") > 1) | F.col("_real").isNotNull())
                     .select("kind", "value", "attempt", "surrogate", "again"), "pii-surrogates")
        if now.where("again").isEmpty():
            return now.select("kind", "value", "surrogate")
        now = now.select("kind", "value", (F.col("attempt") + F.col("again").cast("int")).alias("attempt"))


def replace_entities(docs: DataFrame, key: str = "surrogates", text_col: str = "text") -> DataFrame:
    """(row, text, entities): all columns of ``docs`` as a struct, the text with surrogates, and the
    replaced entities as structs (kind, raw, surrogate) in their order."""
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row")).select(
        "row", F.col("row")[text_col].cast("string").alias("t"))
    hinted = F.coalesce(F.col("t").rlike(HINT), F.lit(False))
    found = F.regexp_extract_all("t", F.lit(ENTITY), F.lit(0))
    # one row for each different text with entities; texts themselves are not kept
    marked = stored(rows.where(hinted).select(F.md5(F.col("t").cast("binary")).alias("digest"), "t", found.alias("raws"))
                    .where(F.size("raws") > 0)
                    # digits that are no card stay a secret where they are one
                    .select("digest", "raws", F.when(F.exists("raws", _no_card), F.regexp_extract_all(
                        "t", F.lit(ENTITY_SECRET), F.lit(1))).alias("secrets"))
                    .groupBy("digest").agg(F.first("raws").alias("raws"), F.first("secrets").alias("secrets")), "pii-found")
    # each match beside its secret before they become rows, so that no row holds the whole list
    pairs = F.transform("raws", lambda raw, i: F.struct(raw.alias("raw"), F.get("secrets", i).alias("as_secret")))
    parts = marked.select("digest", F.posexplode(pairs).alias("at", "pair")).select("digest", "at", "pair.*")
    secret = F.coalesce(F.col("as_secret") == F.col("raw"), F.lit(False))
    whole = F.array(F.struct(F.col("raw"), F.lit(True).alias("entity")))
    parts = parts.withColumn("no_card", _no_card(F.col("raw"))).select("digest", "at", (F.col("no_card") & secret).alias("secret"), F.posexplode(
        F.when(F.col("no_card") & ~secret, _inside(F.col("raw"))).otherwise(whole)).alias("place", "part"))
    parts = stored(parts.select("digest", "at", "secret", "place", "part.*"), "pii-parts")
    typed = parts.where("entity").withColumn("kind", F.when(F.col("secret"), "secret").otherwise(_typed(F.col("raw"))))
    typed = typed.withColumn("value", _canonical(F.col("kind"), F.col("raw")))
    table = surrogates(typed.select("kind", "value"), key)
    new = _formatted(F.col("kind"), F.col("raw"), F.col("surrogate"))
    between = parts.where("not entity").select("digest", "at", "place", F.lit(None).cast("string").alias("kind"), "raw", F.col("raw").alias("surrogate"))
    done = (typed.join(table, ["kind", "value"]).select("digest", "at", "place", "kind", "raw", new.alias("surrogate")).unionAll(between)
            .groupBy("digest", "at").agg(F.array_sort(F.collect_list(F.struct("place", "kind", "raw", "surrogate"))).alias("p"))
            .select("digest", "at", F.array_join(F.transform("p", lambda x: x["surrogate"]), "").alias("new"), F.transform(
                F.filter("p", lambda x: x["kind"].isNotNull()), lambda x: F.struct(
                    x["kind"].alias("kind"), x["raw"].alias("raw"), x["surrogate"].alias("surrogate"))).alias("held")))
    done = stored(done.groupBy("digest").agg(F.array_sort(F.collect_list(F.struct("at", "new", "held"))).alias("e")), "pii-replaced")
    kind = "array<struct<kind:string,raw:string,surrogate:string>>"
    held = F.flatten(F.transform("e", lambda x: x["held"]))
    pieces = F.split("t", ENTITY, -1)
    woven = F.array_join(F.flatten(F.zip_with(pieces, F.col("e"), lambda p, x: F.array(
        F.coalesce(p, F.lit("")), F.coalesce(x["new"], F.lit(""))))), "")
    some = (rows.where(hinted).withColumn("digest", F.md5(F.col("t").cast("binary"))).join(done, "digest", "left")
            .select("row", F.when(F.col("e").isNull(), F.col("t")).otherwise(woven).alias("text"),
                    F.coalesce(held, F.array().cast(kind)).alias("entities")))
    none = rows.where(~hinted).select("row", F.col("t").alias("text"), F.array().cast(kind).alias("entities"))
    return none.unionAll(some)


def without_personal_data(docs: DataFrame, key: str = "surrogates", text_col: str = "text") -> DataFrame:
    """``docs`` with surrogates in the text column, all other columns as they are."""
    done = replace_entities(docs, key, text_col)
    return done.select(*[F.col("text").alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns])


def op5_pii_surrogates(spark, sf_dir: str) -> DataFrame:
    done = replace_entities(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select(F.col("row.doc_id").alias("doc_id"), "text", F.size("entities").cast("long").alias("n_entities"),
                       F.concat_ws(",", F.array_sort(F.array_distinct(F.transform("entities", lambda e: e["kind"])))).alias("kinds"))
