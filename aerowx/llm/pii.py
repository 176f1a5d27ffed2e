"""Personal data replaced by keyed surrogates.

Detected are e-mail addresses, phone numbers, IPv4 addresses, payment card
numbers, social security numbers, and names after a title.  An entity's
surrogate is drawn from SHA-512 of the key, the entity's kind, the entity and
the attempt: the same entity gets the same surrogate everywhere, and nobody
without the key can tell which it was.  Cards, phones and social security
numbers are drawn by their digits (a phone with or without its + apart), and
the drawn digits are laid into each spelling; other kinds are drawn in small
letters.

Surrogates keep what a reader or a program relies on:

format   a digit stays a digit, a letter a letter, in the same places; the
         last label of a mail domain, a phone's country code and a title stay;
         parts of an address stay below 256; a card number that passed the
         Luhn check passes it again, one that did not fails again
script   Latin, Cyrillic and Greek letters are replaced within their alphabet
case     every letter takes the case of the letter it replaces
gender   a first name has the gender that more of the corpus's texts tell by
         a title, and ends as names of that gender do, after neutral titles
         too; without a majority it is neutral.  Surnames are drawn on their
         own, so "Ms. Ann Lee" and "Ms. Lee" still share theirs

After each draw collisions are checked: no surrogate may be an entity of the
corpus, and no two entities of a kind may share one, in whatever spelling.  The losers draw again
until nobody collides; from ``WIDEN`` attempts on the draw is allowed more
characters, so short formats cannot run out.

Everything is DataFrame functions.  A text is cut at the matches of one
pattern (``split`` gives the pieces between them) and put together again with
the surrogates in place.

A name is found behind a title; its words are then replaced in the rest of that
text as well, wherever they stand alone in the case of a name, so no mention is
left beside its surrogate (a word that is both a surname and a first name there
counts as the surname).  The counts are of names behind titles.

Defined cases: null text stays null; a text of any length is scanned in one
pass; a text without a match stays as it is;
equal texts change alike; empty input gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

KEY = "surrogate-key-1"
WIDEN = 8
WIDER = 6

_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_CAPITAL, _SMALL = "A-ZÀ-ÖØ-ÞΑ-ΩА-ЯЁ", "a-zß-öø-ÿα-ωа-яё"
_NAME = f"[{_CAPITAL}](?:[{_SMALL}]{{1,63}}+|[{_CAPITAL}]{{0,63}}+)(?:['-][{_CAPITAL}][{_SMALL}]{{1,63}}+)?"
#: Titles by the gender they tell.
TITLES = {
    "male": ("Mr", "Herr", "Monsieur", "Señor", "Sr", "Sir", "Господин", "Κύριος"),
    "female": ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Госпожа", "Κυρία"),
    "neutral": ("Dr", "Prof"),
}
#: A name's word that stands alone.
MENTION = rf"(?<![\p{{L}}\p{{N}}]){_NAME}(?![\p{{L}}\p{{N}}])"
#: Patterns by kind.  Parts are bounded: a name's word has 64 letters at most, a
#: mail box 255 characters, its domain 127 labels of 63, as domain names do;
#: longer runs are none.  Where two could match at one place, the earlier wins.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9_%+][A-Za-z0-9._%+-]{0,254}+@(?:[A-Za-z0-9-]{1,63}+\.){1,126}[A-Za-z]{2,24}(?![A-Za-z0-9])",
    "ip": rf"(?<![A-Za-z0-9.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\.?[A-Za-z0-9])",
    "card": r"(?<![A-Za-z0-9])(?<![A-Za-z0-9][.-])(?:[0-9]{13,19}|[0-9]{4}(?:-[0-9]{4}){3}|[0-9]{4}(?:\x20[0-9]{4}){3}"
            r"|3[47][0-9]{2}[\x20-][0-9]{6}[\x20-][0-9]{5})(?![A-Za-z0-9])",
    "ssn": r"(?<![A-Za-z0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![A-Za-z0-9-])",
    "phone": r"(?<![A-Za-z0-9])(?:\+[0-9]{1,3}(?:[\x20.-]?\([0-9]{2,5}\))?(?:[\x20.-]?[0-9]{2,4}){2,5}"
             r"|\([0-9]{3}\)\x20?[0-9]{3}[.-][0-9]{4}|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4})(?![A-Za-z0-9])",
    "name": rf"(?<![\p{{L}}\p{{N}}])(?:{'|'.join(t for g in TITLES.values() for t in g)})\.?\x20"
            rf"(?!(?i:{'|'.join(t for g in TITLES.values() for t in g)})\b){_NAME}(?:\x20{_NAME}){{0,2}}(?![\p{{L}}\p{{N}}])",
}
KINDS = tuple(PATTERNS)
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: Every pattern needs one of these; texts without them skip the long pattern.
POSSIBLE = "[0-9@]|" + "|".join(t for g in TITLES.values() for t in g)

#: The alphabets in which letters are replaced, and the endings
#: that first names take in each, by gender.
ALPHABETS = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "абвгдежзиклмнопрстуфхцчшэюя", "αβγδεζηθικλμνξοπρστυφχψω")
MEMBERS = ("[0-9]", "[a-zß-öø-ÿ]", "[а-яё]", "[ά-ώ]")
ENDINGS = {"male": ("", "nrsdk", "нрсдк", "νσρςξ"), "female": ("", "aaaaa", "ааааа", "αααηη")}

#: The telephone country codes, none of which begins another.
COUNTRY = r"\+(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3})"
#: Kinds whose entities are their digits.
NUMBERS = ("card", "phone", "ssn")

ENTITY = "struct<kind:string,form:string,gender:string>"


def kind_of(match: Column) -> Column:
    """The kind of a whole match of ``ANY``."""
    return F.coalesce(*[F.when(match.rlike(f"^(?:{p})$"), k) for k, p in PATTERNS.items()], F.lit("name"))


def words_of(match: Column, kind: Column) -> Column:
    """The entities in a match, in order, with ``kept`` text between them:
    a name gives title (kept), first names with the gender that the title
    tells, and surname."""
    words = F.split(match, " ")
    title = F.regexp_replace(words[0], r"\.$", "")
    gender = F.coalesce(*[F.when(title.isin(*t), g) for g, t in TITLES.items()], F.lit("neutral"))
    parts = F.transform(words, lambda w, i: F.struct(
        F.when(i == 0, "kept").when(i == F.size(words) - 1, "surname").otherwise("first").alias("kind"),
        w.alias("form"), gender.alias("gender")))
    whole = F.array(F.struct(kind.alias("kind"), match.alias("form"), F.lit("neutral").alias("gender")))
    return F.when(kind == "name", parts).otherwise(whole).cast(f"array<{ENTITY}>")


def canonical(kind: Column, form: Column) -> Column:
    """What all spellings of an entity share: a number's digits, behind the +
    if it has one, other forms in small letters."""
    return F.when(kind.isin(*NUMBERS), F.regexp_replace(form, "[^0-9+]", "")).otherwise(F.lower(form))


def laid_out(form: Column, number: Column) -> Column:
    """The digits of ``number`` in the places of the digits of ``form``; what
    is longer than it follows."""
    digits = F.regexp_replace(number, r"^\+", "")
    # the digits up to a place tell which one stands there
    upto = lambda i: F.length(F.regexp_replace(F.substring(form, F.lit(1), i), "[^0-9]", ""))
    placed = F.transform(F.split(form, ""), lambda c, i: F.when(
        c.rlike("[0-9]"), F.substring(digits, upto(i + 1), F.lit(1))).otherwise(c))
    return F.concat(F.array_join(placed, ""), F.substring(digits, upto(F.length(form)) + 1, F.length(digits)))


def _draw(bytes_hex: Column, i: Column) -> Column:
    """The i-th two bytes of a hash (repeating after 64 places), as a number."""
    return F.conv(F.substring(bytes_hex, F.pmod(i * 4, F.lit(128)) + 1, F.lit(4)), 16, 10).cast("int")


def _replaced(form: Column, seed: Column) -> Column:
    """Every letter and digit replaced within its alphabet."""
    def one(c: Column, i: Column) -> Column:
        # a fresh block of the hash for every 32 places
        n = _draw(F.sha2(F.concat(seed, F.floor(i / 32).cast("string")).cast("binary"), 512), F.pmod(i, F.lit(32)))
        return reduce(lambda rest, am: F.when(c.rlike(am[1]), F.substring(F.lit(am[0]), n % len(am[0]) + 1, F.lit(1)))
                      .otherwise(rest), zip(ALPHABETS, MEMBERS), c)
    return F.array_join(F.transform(F.split(form, ""), one), "")


def _ending(name: Column, seed: Column, gender: str) -> Column:
    """A first name with an ending of its gender, in its script."""
    last, n = F.substring(name, -1, 1), _draw(F.sha2(F.concat(seed, F.lit("end")).cast("binary"), 512), F.lit(0))
    end = reduce(lambda rest, em: F.when(last.rlike(em[1]), F.substring(F.lit(em[0]), n % 5 + 1, F.lit(1)))
                 .otherwise(rest) if em[0] else rest, zip(ENDINGS[gender], MEMBERS), last)
    return F.when(F.length(name) > 1, F.concat(F.substring(name, F.lit(1), F.length(name) - 1), end)).otherwise(name)


def luhn_sum(digits: Column) -> Column:
    """Luhn sum of a string of digits, the last one undoubled."""
    back = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(i % 2 == 0, d.cast("int"))
                       .otherwise((2 * d.cast("int")) % 10 + F.floor(2 * d.cast("int") / 10).cast("int")))
    return F.aggregate(back, F.lit(0), lambda a, x: a + x)


def _card(form: Column, drawn: Column) -> Column:
    """The drawn number with a check digit that passes or fails as before."""
    digits = F.regexp_replace(form, "[^0-9]", "")
    passes = luhn_sum(digits) % 10 == 0
    body = F.substring(drawn, F.lit(1), F.length(drawn) - 1)
    check = (10 - luhn_sum(F.concat(F.regexp_replace(body, "[^0-9]", ""), F.lit("0"))) % 10) % 10
    return F.concat(body, F.when(passes, check).otherwise((check + 1) % 10).cast("string"))


def _address(form: Column, seed: Column, wide: Column) -> Column:
    h = F.sha2(seed.cast("binary"), 512)
    part = lambda p, i: (F.when(wide, _draw(h, i) % 256).when(F.length(p) == 3, 100 + _draw(h, i) % 156)
                         .when(F.length(p) == 2, 10 + _draw(h, i) % 90).otherwise(_draw(h, i) % 10).cast("string"))
    return F.array_join(F.transform(F.split(form, r"\."), part), ".")


def surrogate(kind: Column, form: Column, gender: Column, attempt: Column, key: str = KEY) -> Column:
    """The surrogate of a canonical form at an attempt, in canonical form."""
    seed = F.concat_ws("\x1f", F.lit(key), kind, form, attempt.cast("string"))
    wide = attempt >= WIDEN
    extra = F.when(wide, _replaced(F.lit("x" * WIDER), F.concat(seed, F.lit("more")))).otherwise("")
    digits = F.when(wide, _replaced(F.lit("0" * WIDER), F.concat(seed, F.lit("more")))).otherwise("")
    drawn = _replaced(form, seed)
    top = F.regexp_extract(form, r"\.[a-z]+$", 0)
    mail = F.concat(extra, F.substring(drawn, F.lit(1), F.length(form) - F.length(top)), top)
    code = F.regexp_extract(form, f"^{COUNTRY}", 0)
    phone = F.concat(code, F.substring(drawn, F.length(code) + 1, F.length(form)), digits)
    # a card keeps its first digit, which tells the network
    card = _card(form, F.concat(F.substring(form, 1, 1), F.substring(drawn, F.lit(2), F.length(form)), digits))
    return (F.when(kind == "email", mail).when(kind == "ip", _address(form, seed, wide)).when(kind == "card", card)
            .when(kind == "phone", phone).when(kind == "ssn", F.concat(drawn, digits))
            .when((kind == "first") & (gender == "male"), F.concat(extra, _ending(drawn, seed, "male")))
            .when((kind == "first") & (gender == "female"), F.concat(extra, _ending(drawn, seed, "female")))
            .otherwise(F.concat(extra, drawn)))


def assign(entities: DataFrame, key: str = KEY) -> DataFrame:
    """Entities (kind, form, gender), one row for each text and gender -> kind,
    form, ``surrogate``, no two of a kind alike and none an entity itself."""
    told = F.count(F.when(F.col("gender") == "male", 1)) - F.count(F.when(F.col("gender") == "female", 1))
    known = entities.groupBy("kind", "form").agg(told.alias("told")).select(
        "kind", "form", F.when(F.col("told") > 0, "male").when(F.col("told") < 0, "female").otherwise("neutral")
        .alias("gender"))
    known = materialize(known, "pii-entities")
    taken = known.select(F.col("kind").alias("k"), F.col("form").alias("f"))
    drawn = known.withColumn("attempt", F.lit(0))
    while True:
        drawn = drawn.withColumn("surrogate", surrogate(F.col("kind"), F.col("form"), F.col("gender"),
                                                          F.col("attempt"), key))
        same = Window.partitionBy("kind", "surrogate").orderBy("form")
        checked = (drawn.join(taken, (F.col("kind") == F.col("k")) & (F.col("surrogate") == F.col("f")), "left")
                   .withColumn("clash", F.col("f").isNotNull() | (F.row_number().over(same) > 1)).drop("k", "f"))
        checked = materialize(checked, "pii-drawn")
        if not checked.where("clash").limit(1).count():
            return checked.select("kind", "form", "surrogate")
        drawn = checked.withColumn("attempt", F.col("attempt") + F.col("clash").cast("int")).drop("surrogate", "clash")


def _cased(form: Column, replacement: Column) -> Column:
    """``replacement`` (in small letters) in the case of ``form``; what is
    longer than it stays small."""
    def one(c: Column, i: Column) -> Column:
        # extra characters stand in front, or behind digits, where case is idle
        there = F.substring(form, i + 1 - (F.length(replacement) - F.length(form)), F.lit(1))
        upper = (there != F.lower(there)) & (i >= F.length(replacement) - F.length(form))
        return F.when(upper, F.upper(c)).otherwise(c)
    return F.array_join(F.transform(F.split(replacement, ""), one), "")


def replace_pii(docs: DataFrame, key: str = KEY) -> DataFrame:
    """One row per document: doc_id, text with surrogates, and the number of
    entities found by kind.  ``docs`` needs doc_id and text."""
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    has = F.coalesce(F.when(F.col("text").rlike(POSSIBLE), F.col("text").rlike(ANY)), F.lit(False))
    found = F.transform(F.regexp_extract_all("text", F.lit(ANY), F.lit(0)),
                        lambda m: F.struct(m.alias("match"), kind_of(m).alias("kind")))
    found = F.transform(found, lambda m: F.struct(m["kind"].alias("kind"),
                                                  words_of(m["match"], m["kind"]).alias("parts")))
    hits = materialize(rows.where(has).select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("text_key"),
                                              F.split("text", ANY, -1).alias("gaps"), found.alias("found")), "pii-hits")

    met = hits.select("text_key", F.explode(F.flatten("found.parts")).alias("p")).where("p.kind <> 'kept'")
    met = met.select("text_key", "p.kind", canonical(F.col("p.kind"), F.col("p.form")).alias("form"),
                     "p.gender").distinct()
    named = assign(met, key)
    # the surrogates that one text needs; written, so that the join below deals
    # its rows anew and a text with very many copies can be split
    met = met.select("text_key", "kind", "form").distinct()
    lookup = (met.join(named, ["kind", "form"]).groupBy("text_key")
              .agg(F.map_from_entries(F.collect_list(F.struct(
                  F.concat_ws("|", "kind", "form"), F.col("surrogate")))).alias("names")))
    lookup = materialize(lookup, "pii-lookup")

    def shown(part: Column) -> Column:
        new = F.col("names")[F.concat_ws("|", part["kind"], canonical(part["kind"], part["form"]))]
        return (F.when(part["kind"] == "kept", part["form"])
                .when(part["kind"].isin(*NUMBERS), laid_out(part["form"], new)).otherwise(_cased(part["form"], new)))

    def mentioned(gap: Column) -> Column:
        """The text between matches, where a surname or first name of this text stands without its title."""
        words = F.transform(F.regexp_extract_all(gap, F.lit(MENTION), F.lit(0)), lambda w: F.coalesce(
            _cased(w, F.col("names")[F.concat(F.lit("surname|"), F.lower(w))]),
            _cased(w, F.col("names")[F.concat(F.lit("first|"), F.lower(w))]), w))
        pieces = F.zip_with(F.split(gap, MENTION, -1), words, lambda p, w: F.concat(p, F.coalesce(w, F.lit(""))))
        return F.when(gap.rlike(MENTION), F.array_join(pieces, "")).otherwise(gap)

    filled = F.transform("found", lambda m: F.array_join(F.transform(m["parts"], shown), " "))
    gaps = F.when(F.exists("found", lambda m: m["kind"] == "name"), F.transform("gaps", mentioned)).otherwise(F.col("gaps"))
    text = F.array_join(F.zip_with(gaps, filled, lambda g, r: F.concat(g, F.coalesce(r, F.lit("")))), "")
    kinds = F.col("found.kind")
    counts = {k: (F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long") for k in KINDS}
    changed = hits.join(lookup, "text_key").select("doc_id", text.alias("text"),
                                                   *[c.alias(f"n_{k}") for k, c in counts.items()])
    return changed.unionByName(rows.where(~has).select(
        "doc_id", "text", *[F.lit(0).cast("long").alias(f"n_{k}") for k in KINDS]))
