"""Personal data in texts, with DataFrame functions only.

Regular expressions propose spans, checksums confirm them (Luhn for cards, mod-97 for IBANs),
and words near a span adjust its score:

* base kinds (``email``, ``ip``, ``card``, ``phone``) are kept whenever they are well-formed;
* added kinds need more. ``iban``: country letters, the length of that country and mod-97
  (letters without a known length: the whole run, 15 to 34 characters). ``ssn``: the US form
  with a possible area, group and serial number, and a context word before it.
  Their score is 0.5 for the form, 0.5 for a passed checksum and 0.4 for a context word in the
  ``CONTEXT_CHARS`` characters before the span, other spans included; spans from ``MIN_SCORE``
  on stay.

Each pattern marks its matches in one ``regexp_replace``; the text is then split at the marks,
so that positions are running sums of lengths (code points, end exclusive). Patterns use
possessive loops and start only where a run starts, so long runs cost linear time and no deep
recursion. All work stays within a row: no shuffle, nothing to skew.

A null text counts as empty (no spans). Repeated rows give repeated results; other columns pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellar.operators.ordinal import quoted

BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("iban", "ssn")
CONTEXT_CHARS = 40
MIN_SCORE = 0.8
#: Words that make an added kind likelier (fixed values).
CONTEXT_WORDS = {
    "iban": "iban|bank|account|konto|cuenta|compte|transfer|bic|swift",
    "ssn": "ssn|social security|social-security|taxpayer|tax id",
}

#: Characters of an IBAN by country: the registry, and countries that use the form without it.
IBAN_SIZES = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK",
    21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "AO CV GW LY MZ PT ST", 26: "DZ IR IS TR",
    27: "BI CF CG CM DJ FR GA GQ GR IT KM MC MG MR SM TD", 28: "AL AZ BF BJ BY CI CY DO GT HN HU LB MA ML NE NI PL SN SV TG",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}


def _iban() -> str:
    """Groups of four with or without a space, up to the length of the country."""
    group, ways = r"\x20?[A-Z0-9]", []
    for size, countries in IBAN_SIZES.items():
        fours, rest = divmod(size - 4, 4)
        tail = f"{group}{{{rest}}}" if rest else ""
        ways.append(f"(?:{countries.replace(' ', '|')})[0-9]{{2}}(?:{group}{{4}}){{{fours}}}{tail}")
    known = "|".join(IBAN_SIZES.values()).replace(" ", "|")
    ways.append(f"(?!{known})[A-Z]{{2}}[0-9]{{2}}(?:{group}{{4}}){{2,7}}(?:{group}{{1,3}})?")
    return f"(?<![A-Za-z0-9])(?=[A-Z]{{2}}[0-9]{{2}})(?:{'|'.join(ways)})(?![A-Za-z0-9])"


_LOCAL = "[A-Za-z0-9._%+-]"
# A match starts where the run starts or where the match before ended (\G).
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # runs of fewer than 14 digits can't pass, so they are not marked
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){13,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": _iban(),
    "ssn": r"(?<![A-Za-z0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![A-Za-z0-9-])",
}
#: Cheap tests that every text with a match of the kind passes.
HINTS = {"email": r"@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){13}", "phone": r"\+[0-9]",
         "iban": r"[A-Z]{2}[0-9]{2}", "ssn": r"[0-9]{3}-[0-9]{2}-[0-9]{4}"}
_MARK, _STAND_IN = "\x01", "\x02"
_CHUNK = 512


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Luhn checksum of a text of digits."""
    ds = F.split(F.reverse(digits), "")
    # split leaves an empty piece on some versions: only real digits count
    ds = F.filter(ds, lambda c: c != "")
    doubled = F.transform(ds, lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
        F.when(c.cast("int") > 4, c.cast("int") * 2 - 9).otherwise(c.cast("int") * 2)))
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + x) % 10 == 0


def mod97(match: Column) -> Column:
    """The ISO 7064 check of an IBAN: country and check digits last, letters as 10 to 35."""
    plain = F.regexp_replace(match, " ", "")
    turned = F.filter(F.split(F.concat(F.substring(plain, 5, 64), F.substring(plain, 1, 4)), ""), lambda c: c != "")
    rest = F.aggregate(turned, F.lit(0), lambda a, c: F.when(
        c.between("0", "9"), (a * 10 + c.cast("int")) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97))
    return rest == 1


def _valid(kind: str, match: Column, before: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        # at most 255, leading zeros allowed
        return match.rlike(r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})(?:\.|$)){4}$")
    n = F.length(_digits(match))
    if kind == "card":
        return n.between(14, 19) & luhn(_digits(match))
    if kind == "phone":
        return n.between(10, 15)
    context = before.rlike(rf"(?i)(?<![a-z])(?:{CONTEXT_WORDS[kind]})(?![a-z])")
    score = F.lit(0.5) + F.when(context, 0.4).otherwise(0.0)
    if kind == "iban":
        size = F.length(F.regexp_replace(match, " ", ""))
        score = F.when(size.between(15, 34) & mod97(match), score + 0.5).otherwise(0.0)
    return score >= MIN_SCORE


_SPANS = "array<struct<start:int,end:int>>"


def spans(text: Column, kind: str) -> Column:
    """Confirmed spans of one kind, in order. ``text`` must not be null.

    The fold appends to a small array and moves it to a list of arrays when it is full, so that
    a text with very many spans is not copied again for each of them.
    """
    safe = F.translate(text, _MARK, _STAND_IN)
    marked = F.regexp_replace(safe, PATTERNS[kind], _MARK + "$0" + _MARK)
    parts = F.split(marked, _MARK, -1)
    none = F.array().cast(_SPANS)
    start = F.struct(F.lit(0).alias("at"), F.lit(False).alias("inside"), F.lit("").alias("before"),
                     none.alias("some"), F.array().cast(f"array<{_SPANS}>").alias("full"))

    def step(acc: Column, part: Column) -> Column:
        end = acc["at"] + F.length(part)
        span = F.array(F.struct(acc["at"].alias("start"), end.alias("end")))
        hit = acc["inside"] & _valid(kind, part, acc["before"])
        spill = F.size(acc["some"]) >= _CHUNK
        return F.struct(
            end.alias("at"), (~acc["inside"]).alias("inside"),
            (F.right(F.concat(acc["before"], F.right(part, F.lit(CONTEXT_CHARS))), F.lit(CONTEXT_CHARS))
             if kind in ADDED_KINDS else F.lit("")).alias("before"),
            F.when(hit, F.when(spill, span).otherwise(F.concat(acc["some"], span)))
            .otherwise(acc["some"]).alias("some"),
            F.when(hit & spill, F.concat(acc["full"], F.array(acc["some"]))).otherwise(acc["full"]).alias("full"))

    found = F.aggregate(parts, start, step, lambda acc: F.concat(F.flatten(acc["full"]), acc["some"]))
    return F.when(text.rlike(HINTS[kind]), found).otherwise(none)


def find(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with one array of (start, end) per kind: ``email`` ... ``ssn``.

    Columns of ``docs`` with these names are replaced.
    """
    kinds = BASE_KINDS + ADDED_KINDS
    kept = [c for c in docs.columns if c not in kinds or c == text]
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(*kept, *[spans(body, k).alias(k) for k in kinds])


def joined(kinds: tuple[str, ...]) -> Column:
    """All spans of the kinds as ``kind:start:end``, by start, then kind as listed."""
    def tag(i: int, kind: str) -> Column:
        return F.transform(F.col(kind), lambda s: F.struct(
            s["start"].alias("start"), F.lit(i).alias("kind"),
            F.concat_ws(":", F.lit(kind), s["start"].cast("string"), s["end"].cast("string")).alias("said")))

    tagged = F.concat(*[tag(i, k) for i, k in enumerate(kinds)])
    return F.array_join(F.transform(F.array_sort(tagged), lambda s: s["said"]), ",")


def digest(docs: DataFrame) -> DataFrame:
    """One row per document: counts of the base kinds, their digest, and all spans."""
    got = find(docs.select("doc_id", "text"))
    return got.select("doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in BASE_KINDS],
                      F.sha2(joined(BASE_KINDS), 256).alias("base_sha256"),
                      joined(BASE_KINDS + ADDED_KINDS).alias("spans"))


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; overlapping spans become the
    kind of the first. ``n_chars``, where there is one, is counted anew for changed texts."""
    kinds = BASE_KINDS + ADDED_KINDS
    kept = docs.columns
    got = docs.select(*[quoted(c).alias(f"__{i}") for i, c in enumerate(kept)],
                      F.coalesce(F.col(text), F.lit("")).alias("__text"))
    got = find(got, "__text")

    def tag(kind: str) -> Column:
        return F.transform(F.col(kind), lambda s: F.struct(
            s["start"].alias("start"), (-s["end"]).alias("end"), F.lit(f"[{kind.upper()}]").alias("said")))

    tagged = F.array_sort(F.concat(*[tag(k) for k in kinds]))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        fits = s["start"] >= acc["at"]
        return F.struct(F.when(fits, -s["end"]).otherwise(F.greatest(acc["at"], -s["end"])).alias("at"),
                        F.when(fits, F.concat(acc["out"], F.array(
                            F.substring(F.col("__text"), acc["at"] + 1, s["start"] - acc["at"]), s["said"])))
                        .otherwise(acc["out"]).alias("out"))

    body = F.aggregate(F.col("__all"), start, step, lambda acc: F.concat(
        F.array_join(acc["out"], ""), F.substring(F.col("__text"), acc["at"] + 1, F.lit(2147483647))))
    got = got.withColumn("__all", tagged).withColumn(
        "__new", F.when(F.size("__all") > 0, body).otherwise(F.col(f"__{kept.index(text)}")))
    out = []
    for i, c in enumerate(kept):
        value = F.col(f"__{i}")
        if c == text:
            value = F.col("__new")
        elif c == "n_chars":
            value = F.when(F.size("__all") > 0, F.length("__new").cast("long")).otherwise(value)
        out.append(value.alias(c))
    return got.select(*out)
