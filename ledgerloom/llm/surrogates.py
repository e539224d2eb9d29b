"""Surrogates for personal data: each detected entity gets a keyed replacement of the same type and shape.

Detection is by pattern. A surrogate is drawn from SHA-512 of key, type, value and attempt, so the same entity has the same
surrogate wherever it stands (coreference) and nobody without the key can go back. It keeps what readers and parsers
rely on: separators and letter case, the country code of a phone number, whether a card number's check digit is right, the
length of a secret, the script of a name, its gender where the title tells, and the surname shared by "Mr Ann Lee" and "Lee" forms.
A name is detected by its title; the same document's bare uses of its words ("Ann Lee", "Lee", "LEE's") are replaced alike.

Two entities of a type must not share a surrogate, and no surrogate may be a value found in the corpus. All entities of
the corpus are counted once, surrogates are compared across the whole table, and of those in conflict all but one draw
again until none is left. Everything is DataFrame operations.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.tables import row_key, saved

_TITLE_M = "Mr|Sir|Lord|Herr|Monsieur|Señor|Sr|Don|господин|г-н"
_TITLE_F = "Mrs|Ms|Miss|Lady|Frau|Madame|Mme|Mademoiselle|Señora|Sra|Doña|госпожа|г-жа"
_TITLE_N = "Dr|Prof|Doktor|Docteur|Doctor|доктор"
#: Without a possessive s, so that "Lee's" is "Lee".
_NAME_WORD = r"\p{Lu}(?:\p{L}|['’-](?=\p{L})(?!(?<=['’])s(?!\p{L})))+"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"

#: Type and pattern, in the order in which they are tried at a place.
PATTERNS = {
    "email": r"[\p{L}\p{N}._%+-]+@[\p{L}\p{N}-]+(?:\.[\p{L}\p{N}-]+)*\.\p{L}{2,}",
    "secret": r"(?<![0-9A-Za-z])(?:[0-9a-f]{32,128}|[0-9A-F]{32,128}|(?:AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[0-9A-Za-z]{36,}|sk-[0-9A-Za-z_-]{20,})(?![0-9A-Za-z])",
    "ip": rf"(?<![\d.])(?:{_OCTET}\.){{3}}{_OCTET}(?![\d]|\.\d)",
    "iban": r"(?<![0-9A-Za-z])[A-Z]{2}\d{2}(?: ?[0-9A-Z]{4}){3,7}(?: ?[0-9A-Z]{1,3})?(?![0-9A-Za-z])",
    "card": r"(?<![\d+])(?:\d{4}[ -]?){3}\d{1,4}(?!\d)",
    "phone": r"(?<![\p{L}\d+])(?:\+\d{1,3}[ .-]?(?:\(\d{1,5}\)[ .-]?)?\d{2,5}(?:[ .-]?\d{2,5}){1,4}|\(\d{2,5}\)[ .-]?\d{2,5}(?:[ .-]\d{2,5}){1,3}|\d{3}[.-]\d{3}[.-]\d{4})(?![\p{L}\d])",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "name": rf"(?<!\p{{L}})(?:{_TITLE_M}|{_TITLE_F}|{_TITLE_N})\.? {_NAME_WORD}(?: {_NAME_WORD}){{0,2}}",
}
_ALL = "|".join(f"(?:{p})" for p in PATTERNS.values())

#: Parts of made-up names, by script.
_SYLLABLES = {
    "latin": "ba be bo da de do fa fe ga go ka ke ko la le lo ma me mo na ne no pa pe po ra re ro sa se so ta te to va ve vo za".split(),
    "cyrillic": "ба бе бо да де до га го ка ке ко ла ле ло ма ме мо на не но па пе по ра ре ро са се со та те то ва ве во за".split(),
}
_ENDINGS = {
    ("latin", "given_m"): "rin rold mund vin".split(), ("latin", "given_f"): "lina ria nelle sia".split(), ("latin", "given_n"): "ry lin key ren".split(),
    ("latin", "surname"): "mann berg ley son".split(), ("cyrillic", "given_m"): "мир слав рий тан".split(),
    ("cyrillic", "given_f"): "лина рия слава ния".split(), ("cyrillic", "given_n"): "ша ня ся ля".split(), ("cyrillic", "surname"): "ков рин ский нец".split(),
}


def _number(digest: Column, i: Column | int, below: Column | int) -> Column:
    """The i-th number below ``below`` (at most 256 values apart from rounding) of a digest's 32 16-bit pieces."""
    at = F.pmod((i if isinstance(i, Column) else F.lit(i)) * 4, F.lit(124)) + 1
    return F.pmod(F.conv(digest.substr(at, F.lit(4)), 16, 10).cast("int"), below if isinstance(below, Column) else F.lit(below))


def _pick(options: list[str], digest: Column, i: Column | int) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in options]), _number(digest, i, len(options)) + 1)


def _shaped(value: Column, digest: Column) -> Column:
    """Digit for digit and letter for letter, separators as they are. A run of hex digits stays one."""
    hexes = value.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$")

    def one(c: Column, i: Column) -> Column:
        letter = F.when(hexes, _number(digest, i, 6)).otherwise(_number(digest, i, 26))
        return (
            F.when(c.rlike(r"^\d$"), _number(digest, i, 10).cast("string"))
            .when(c.rlike(r"^\p{Lu}$"), F.substring(F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), letter + 1, F.lit(1)))
            .when(c.rlike(r"^\p{L}$"), F.substring(F.lit("abcdefghijklmnopqrstuvwxyz"), letter + 1, F.lit(1)))
            .otherwise(c)
        )

    return F.array_join(F.transform(F.split(value, ""), one), "")


def _luhn(value: Column) -> Column:
    digits = F.reverse(F.split(F.regexp_replace(value, r"\D", ""), ""))
    worth = F.transform(
        digits, lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0))
    )
    return F.pmod(F.aggregate(worth, F.lit(0), lambda a, x: a + x), F.lit(10))


def _name(value: Column, kind: Column, digest: Column) -> Column:
    cyrillic = value.rlike(r"\p{IsCyrillic}")

    def made(script: str) -> Column:
        ending = F.lit("")
        for (s, k), options in _ENDINGS.items():
            if s == script:
                ending = F.when(kind == k, _pick(options, digest, 3)).otherwise(ending)
        # Cyrillic surnames of women keep their ending.
        female = F.when((kind == "surname") & value.rlike("(?:ова|ева|ина|ая|ОВА|ЕВА|ИНА|АЯ)$"), F.lit("ова")).otherwise(ending)
        parts = [_pick(_SYLLABLES[script], digest, i) for i in range(3)]
        return F.initcap(F.concat(parts[0], parts[1], F.when(kind == "surname", parts[2]).otherwise(F.lit("")), female if script == "cyrillic" else ending))

    word = F.when(cyrillic, made("cyrillic")).otherwise(made("latin"))
    return F.when(value == F.upper(value), F.upper(word)).otherwise(word)


def surrogate(kind: Column, value: Column, attempt: Column | int, key: str) -> Column:
    """The replacement of one entity; another ``attempt`` gives another one.

    From the fourth attempt on a shape too small for distinct values grows, one digit with every attempt, so that free values
    are found however many of its own the corpus uses up; an address of the old kind becomes one of the new kind (2001:db8::/32,
    which is for documentation only).
    """
    attempt = attempt if isinstance(attempt, Column) else F.lit(attempt)
    # A name is the same person in capitals.
    named = F.when(kind.rlike("^(?:given|surname)"), F.lower(value)).otherwise(value)
    digest = F.sha2(F.concat_ws("\x1f", F.lit(key), kind, named, attempt.cast("string")).cast("binary"), 512)
    grown = F.concat(value, F.repeat(F.lit("0"), F.greatest(attempt - 2, F.lit(0))))
    shaped = _shaped(grown, digest)
    more = F.when(attempt >= 3, attempt.cast("string")).otherwise(F.lit(""))
    mailbox, host = F.substring_index(value, "@", 1), F.substring_index(value, "@", -1)
    # Names below .example are never given to anybody.
    email = F.concat(_shaped(mailbox, digest), more, F.lit("@"), _shaped(F.regexp_replace(host, r"\.\p{L}+$", ""), F.reverse(digest)), F.lit(".example"))
    # 240.0.0.0/4 is reserved, so such an address is nobody's.
    ip = F.concat_ws(".", (240 + _number(digest, 0, 15)).cast("string"), *[_number(digest, i, 256).cast("string") for i in (1, 2, 3)])
    ip = F.when(attempt >= 3, F.concat_ws(":", F.lit("2001:db8"), *[digest.substr(1 + 4 * i, 4) for i in range(6)])).otherwise(ip)
    last = F.pmod(F.right(shaped, F.lit(1)).cast("int") + _luhn(value) - _luhn(shaped), F.lit(10))
    card = F.concat(shaped.substr(F.lit(1), F.length(shaped) - 1), last.cast("string"))
    code = F.regexp_extract(value, r"^(\+\d{1,3})", 1)
    phone = F.concat(code, shaped.substr(F.length(code) + 1, F.length(shaped)))
    iban = F.concat(value.substr(1, 2), shaped.substr(F.lit(3), F.length(shaped)))
    secret = F.regexp_extract(value, "^(AKIA|ASIA|gh[pousr]_|sk-|)", 1)
    secret = F.concat(secret, shaped.substr(F.length(secret) + 1, F.length(shaped)))
    return (
        F.when(kind == "email", email).when(kind == "ip", ip).when(kind == "card", F.when(value.rlike(r"\d$"), card))
        .when(kind == "phone", phone).when(kind == "iban", iban).when(kind == "secret", secret).when(kind == "ssn", shaped)
        .otherwise(F.concat(_name(value, kind, digest), F.when(attempt >= 3, F.lower(_pick(_SYLLABLES["latin"], digest, attempt))).otherwise(F.lit(""))))
    )


def _parts(entity: Column) -> Column:
    """``array<struct<kind, value>>`` of an entity: itself, or the words of a name."""
    kind = F.lit("name")
    for k, p in reversed([x for x in PATTERNS.items() if x[0] != "name"]):
        kind = F.when(entity.rlike(f"^(?:{p})$"), F.lit(k)).otherwise(kind)
    words = F.slice(F.split(entity, " "), 2, 9)
    given = (
        F.when(entity.rlike(rf"^(?:{_TITLE_M})\.? "), "given_m").when(entity.rlike(rf"^(?:{_TITLE_F})\.? "), "given_f").otherwise("given_n")
    )
    named = F.transform(
        words, lambda w, i: F.struct(F.when(i == F.size(words) - 1, F.lit("surname")).otherwise(given).alias("kind"), w.alias("value"))
    )
    return F.when(kind == "name", named).otherwise(F.array(F.struct(kind.alias("kind"), entity.alias("value"))))


def entities(text: str | Column, pattern: Column | None = None) -> Column:
    """All entities of a text in their order, as they stand there."""
    pattern = F.lit(_ALL) if pattern is None else pattern
    return F.coalesce(F.regexp_extract_all(text, F.concat(F.lit("("), pattern, F.lit(")")), F.lit(1)), F.array().cast("array<string>"))


def _bare(found: Column) -> Column:
    """``array<struct<form, last, new>>`` of a document's name words, also in capitals and with one; longest first.

    ``found`` maps "kind|value" to surrogates; ``last`` is whether the word was a surname.
    """
    names = F.filter(F.map_entries(found), lambda e: e["key"].rlike("^(?:given|surname)"))
    last, value = lambda e: e["key"].startswith("surname"), lambda e: F.regexp_replace(e["key"], r"^[^|]*\|", "")

    def forms(how: Callable[[Column], Column]) -> Column:
        return F.transform(names, lambda e: F.struct(how(value(e)).alias("form"), last(e).alias("last"), how(e["value"]).alias("new")))

    # As they stand comes before other capitals.
    every = F.concat(forms(lambda c: c), forms(F.upper), forms(F.initcap))
    order = lambda a, b: F.length(b["form"]) - F.length(a["form"])
    return F.array_sort(every, order)


def _bare_pattern(bare: Column) -> Column:
    """Runs of up to three of these words, as whole words."""
    word = F.concat(F.lit("(?:"), F.array_join(F.array_distinct(F.transform(bare, lambda b: b["form"])), "|"), F.lit(")"))
    edge = r"(?!\p{L})"
    return F.concat(F.lit(r"(?<!\p{L})"), word, F.lit(f"{edge}(?: "), word, F.lit(f"{edge}){{0,2}}"))


def distinct_surrogates(found: DataFrame, key: str) -> DataFrame:
    """``(kind, value, surrogate)``: one row per distinct entity; no two of a kind share one, and none is a value of the corpus."""
    open_ = saved(found.select("kind", "value").distinct().withColumn("attempt", F.lit(0)), "entities")
    values = open_.select(F.col("value").alias("surrogate")).distinct()
    done, attempt = None, 0
    while True:
        drawn = open_.withColumn("surrogate", surrogate(F.col("kind"), F.col("value"), attempt, key))
        # The smallest value of those that drew the same keeps it, if it isn't taken and stands nowhere in the corpus.
        best = drawn.groupBy("kind", "surrogate").agg(F.min("value").alias("value")).join(values, "surrogate", "left_anti")
        if done is not None:
            best = best.join(done.select("kind", "surrogate"), ["kind", "surrogate"], "left_anti")
        best = best.select("kind", "value", "surrogate")
        done = saved(best if done is None else done.unionByName(best), "surrogates")
        open_ = saved(open_.join(done, ["kind", "value"], "left_anti"), "entities")
        if open_.isEmpty():
            return done
        attempt += 1


def with_surrogates(docs: DataFrame, key: str, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows with ``text`` in which every entity is replaced, and ``n_entities``, ``n_distinct`` added.

    Words of a titled name are replaced everywhere in its document, by the same surrogate; a word that is a given name and a
    surname there counts as a surname unless another of these words follows it. NULL and empty texts stay as they
    are, with 0 entities. Overlapping candidates are taken from the left, at one place
    in the order of ``PATTERNS``. Rows alike in id and text get the same result. Other columns are passed on, but
    ``n_entities`` and ``n_distinct`` replace columns of these names. An empty table gives none.
    """
    k1, k2 = row_key(doc, text)
    held = docs.select(k1, k2, F.explode(F.array_distinct(F.flatten(F.transform(entities(text), _parts)))).alias("part"))
    held = saved(held.select("k1", "k2", "part.kind", "part.value").distinct(), "found")
    table = distinct_surrogates(held, key)
    label = F.concat_ws("|", "kind", "value")
    own = held.join(table, ["kind", "value"]).groupBy("k1", "k2").agg(
        F.map_from_entries(F.collect_list(F.struct(label.alias("label"), F.col("surrogate")))).alias("__map")
    )
    others = [c for c in docs.columns if c not in ("n_entities", "n_distinct")]
    keyed = docs.select(*others, k1.alias("__k1"), k2.alias("__k2"))
    # Both sides are shuffled whatever their size, so a small corpus shows what a large one costs.
    own = own.toDF("__k1", "__k2", "__map").hint("shuffle_merge")
    joined = keyed.join(own, ["__k1", "__k2"], "left").withColumn("__bare", _bare(F.col("__map")))
    # Compiled once for all documents without names.
    joined = joined.withColumn(
        "__pattern", F.when(F.size("__bare") > 0, F.concat(F.lit(f"{_ALL}|"), _bare_pattern(F.col("__bare")))).otherwise(F.lit(_ALL))
    )
    joined = joined.withColumn(
        "__found", F.when(F.col("__map").isNotNull(), entities(text, F.col("__pattern"))).otherwise(F.array().cast("array<string>"))
    )

    def untitled(entity: Column) -> Column:
        words = F.split(entity, " ")

        def new(w: Column, i: Column) -> Column:
            same = F.filter("__bare", lambda b: b["form"] == w)
            fit = F.filter(same, lambda b: b["last"] == (i == F.size(words) - 1))
            return F.element_at(F.concat(fit, same), 1)["new"]

        return F.array_join(F.transform(words, new), " ")

    def written(entity: Column) -> Column:
        typed = "|".join(p for p in PATTERNS.values())
        return F.when(entity.rlike(f"^(?:{typed})$"), detected(entity)).otherwise(untitled(entity))

    def detected(entity: Column) -> Column:
        parts = _parts(entity)
        new = F.transform(parts, lambda p: F.element_at(F.col("__map"), F.concat_ws("|", p["kind"], p["value"])))
        title = F.when(F.element_at(parts, 1)["kind"].rlike("^(?:given|surname)"), F.array(F.substring_index(entity, " ", 1)))
        return F.array_join(F.concat(F.coalesce(title, F.array().cast("array<string>")), new), " ")

    joined = joined.withColumn("__new", F.transform("__found", written))
    replaced = F.array_join(F.zip_with(F.split(text, F.col("__pattern"), -1), "__new", lambda p, n: F.concat(p, F.coalesce(n, F.lit("")))), "")
    new_text = F.when(F.col("__map").isNull(), F.col(text)).otherwise(replaced)
    return joined.select(
        *[new_text.alias(c) if c == text else F.col(c) for c in others], F.size("__found").cast("bigint").alias("n_entities"),
        F.coalesce(F.size(F.map_keys("__map")), F.lit(0)).cast("bigint").alias("n_distinct"),
    ).select(*docs.columns, *[c for c in ("n_entities", "n_distinct") if c not in docs.columns])
