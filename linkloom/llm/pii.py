"""Personal data: patterns propose spans, checksums confirm them, words nearby adjust the score. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._util import table

# The base patterns. Possessive and anchored forms find what the plain ones find, in linear time: a run of the first
# class only has to be tried from its start, or from where the last match ended.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9]++(?:[\x20-][0-9]++)*+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# Patterns of the kinds that the method adds.
LOCAL_PHONE = r"(?<![0-9+.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[.\x20-])[0-9]{3}[.\x20-][0-9]{4}(?![0-9.-])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
# Secrets: keys whose form tells what they are, and values that stand behind a word for a secret and a sign that assigns them.
KEY = (
    r"(?<![A-Za-z0-9_])(?:(?:AKIA|ASIA)[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36}|github_pat_[A-Za-z0-9_]{22,255}|xox[abeoprs]-[A-Za-z0-9-]{10,250}|AIza[A-Za-z0-9_-]{35}|[sr]k_live_[A-Za-z0-9]{16,250}|sk-[A-Za-z0-9_-]{20,250}"
    r"|eyJ[A-Za-z0-9_-]{8,4000}+\.eyJ[A-Za-z0-9_-]{8,4000}+\.[A-Za-z0-9_-]{8,4000}+)(?![A-Za-z0-9_])|-----BEGIN\x20(?:[A-Z]{2,9}\x20){0,2}PRIVATE\x20KEY-----"
)
_SECRET_WORD = r"(?:password|passwd|passphrase|pwd|secret|token|credential|api[_-]?key|access[_-]?key|private[_-]?key|auth[_-]?key)"
SECRET = rf"(?<=(?i:{_SECRET_WORD})[\x22']?\x20?[:=]{{1,2}}\x20?[\x22']?)[A-Za-z0-9+/_.!@#$%^&*-][A-Za-z0-9+/_.!@#$%^&*=-]{{7,511}}+"

BASE_KINDS = ("email", "ip", "card", "phone")
SECRET_KINDS = ("key", "secret")
KINDS = (*BASE_KINDS, "iban", "local_phone", "ssn", *SECRET_KINDS)

# Lengths of IBANs by country.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "BY": 28, "CH": 21, "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DK": 18,
    "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23,
    "IQ": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MR": 27, "MT": 31,
    "MU": 30, "NL": 18, "NO": 15, "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "SA": 24, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "TN": 24, "TR": 26, "UA": 29,
    "VA": 22, "VG": 24, "XK": 20,
}
# Each country's IBAN at its own length, so that words which follow aren't part of it.
_BY_LENGTH = {n: "|".join(sorted(k for k, v in IBAN_LENGTHS.items() if v == n)) for n in sorted(set(IBAN_LENGTHS.values()))}
IBAN = r"(?<![A-Za-z0-9])(?:" + "|".join(rf"(?:{c})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{n - 4}}}" for n, c in _BY_LENGTH.items()) + r")(?![A-Za-z0-9])"
# Words that speak for a kind when they stand nearby.
CONTEXT = {
    "email": r"\b(?:e-?mail|mail|contact|write|correo|courriel)\b",
    "ip": r"\b(?:ip|address|host|server|login|adresse)\b",
    "card": r"\b(?:card|visa|mastercard|amex|credit|debit|carte|karte|tarjeta)\b",
    "phone": r"\b(?:phone|tel|telephone|call|mobile|cell|fax|telefon|teléfono|téléphone)\b",
    "iban": r"\b(?:iban|account|bank|konto|compte|cuenta)\b",
    "local_phone": r"\b(?:phone|tel|telephone|call|mobile|cell|fax|telefon|teléfono|téléphone)\b",
    "ssn": r"\b(?:ssn|social|security|taxpayer)\b",
    "key": r"\b(?:key|token|aws|secret|credential|bearer|authorization)\b",
    "secret": r"\b(?:login|user|account|config|env|export|auth)\b",
}
#: Score of a confirmed pattern by itself and what a context word within NEAR code points adds; a span needs LEAST. Base spans need nothing.
PRIOR = {"email": 0.8, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.8, "local_phone": 0.35, "ssn": 0.35, "key": 0.75, "secret": 0.6}
BONUS, LEAST, NEAR = 0.2, 0.5, 40

_BLOCK = 256


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes Luhn's check."""
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when((n - i) % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0


def mod97(iban: Column) -> Column:
    """Whether an IBAN without blanks leaves 1 modulo 97 once its first four signs stand last."""
    turned = F.concat(F.substring(iban, F.lit(5), F.length(iban)), F.substring(iban, 1, 4))

    def add(rest: Column, i: Column) -> Column:
        c = F.ascii(F.substring(turned, i, F.lit(1)))
        return F.when(c >= 65, (rest * 100 + c - 55) % 97).otherwise((rest * 10 + c - 48) % 97)

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), add) == 1


def _confirmed(kind: str, x: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(x, r"\."), lambda p: p.rlike(r"^0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9]|)$"))
    if kind == "card":
        d = _digits(x)
        return F.when(F.length(d).between(13, 19), luhn(d)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(_digits(x)).between(9, 15)
    if kind == "iban":
        flat = F.regexp_replace(x, " ", "")
        lengths = F.create_map(*[F.lit(v) for pair in sorted(IBAN_LENGTHS.items()) for v in pair])
        return F.when(F.coalesce(F.try_element_at(lengths, F.substring(flat, 1, 2)) == F.length(flat), F.lit(False)), mod97(flat)).otherwise(F.lit(False))
    if kind == "secret":
        # letters and digits, or letters of both cases and a sign: prose behind the word is neither
        return (x.rlike("[0-9]") & x.rlike("[A-Za-z]")) | (x.rlike("[a-z]") & x.rlike("[A-Z]") & x.rlike("[!@#$%^&*+/=]"))
    if kind == "ssn":
        return ~x.rlike("^(?:000|666|9)|-00-|-0000$")
    return F.lit(True)


_PATTERNS = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE, "iban": IBAN, "local_phone": LOCAL_PHONE, "ssn": SSN, "key": KEY, "secret": SECRET}
#: A text without this has no span of the kind; it is cheap to look for.
_HINTS = {
    "email": lambda t: F.contains(t, F.lit("@")), "ip": lambda t: t.rlike(r"[0-9]\.[0-9]"), "card": lambda t: t.rlike(r"[0-9](?:[\x20-]?[0-9]){12}"),
    "phone": lambda t: t.rlike(r"\+[0-9]"), "key": lambda t: t.rlike(r"AKIA|ASIA|gh[pousr]_|github_pat_|xox[abeoprs]-|AIza|[sr]k_live_|sk-|eyJ|PRIVATE\x20KEY"), "secret": lambda t: t.rlike(rf"(?i){_SECRET_WORD}[\x22']?\x20?[:=]"),
    "iban": lambda t: t.rlike(r"[A-Z]{2}[0-9]{2}\x20?[A-Z0-9]"), "local_phone": lambda t: t.rlike(r"[0-9][.\x20-][0-9]{4}"), "ssn": lambda t: t.rlike(r"[0-9]-[0-9]{2}-[0-9]"),
}
_SPAN = "array<struct<kind:string,start:int,end:int,score:double>>"


def _found(text: Column, kind: str) -> Column:
    """Matches of the kind's pattern with their places, in order, before any check."""
    pattern = F.lit(_PATTERNS[kind])
    parts = F.struct(F.regexp_extract_all(text, pattern, F.lit(0)).alias("m"), F.split(text, _PATTERNS[kind], -1).alias("gaps"))
    return F.when(_HINTS[kind](text), parts)


def _placed(found: Column, text: Column, kind: str) -> Column:
    """Confirmed spans of the matches. A match starts after all gaps and matches before it; sums are kept for every _BLOCK of them."""

    def spans(x: Column) -> Column:
        m, gaps = x["m"], x["gaps"]
        steps = F.transform(m, lambda s, i: F.length(s) + F.length(F.get(gaps, i)))

        def total(a: Column) -> Column:
            return F.aggregate(a, F.lit(0), lambda s, v: s + v)

        zero = F.struct(F.lit(0).alias("s"), F.array().cast("array<int>").alias("a"))
        sums = F.aggregate(
            F.sequence(F.lit(0), F.floor(F.size(m) / _BLOCK).cast("int")), zero,
            lambda acc, b: F.struct((acc["s"] + total(F.slice(steps, b * _BLOCK + 1, F.lit(_BLOCK)))).alias("s"), F.concat(acc["a"], F.array(acc["s"])).alias("a")), lambda acc: acc["a"],
        )

        def place(both: Column) -> Column:
            def one(s: Column, i: Column) -> Column:
                block = F.floor(i / _BLOCK).cast("int")
                start = F.get(both["sums"], block) + total(F.slice(both["steps"], block * _BLOCK + 1, i % _BLOCK)) + F.length(F.get(gaps, i))
                return F.struct(s.alias("s"), start.cast("int").alias("start"))

            return F.transform(m, one)

        # a one-element array stands for a let: its value is computed once
        placed = F.flatten(F.transform(F.array(F.struct(steps.alias("steps"), sums.alias("sums"))), place))
        good = F.filter(placed, lambda p: _confirmed(kind, p["s"]))

        def scored(p: Column) -> Column:
            end = p["start"] + F.length(p["s"])
            around = F.lower(F.concat_ws(" ", F.substring(text, F.greatest(p["start"] - NEAR + 1, F.lit(1)), F.least(p["start"], F.lit(NEAR))), F.substring(text, end + 1, F.lit(NEAR))))
            score = F.lit(PRIOR[kind]) + F.when(around.rlike(CONTEXT[kind]), BONUS).otherwise(0.0)
            return F.struct(F.lit(kind).alias("kind"), p["start"].alias("start"), end.alias("end"), score.alias("score"))

        out = F.transform(good, scored)
        return out if kind in BASE_KINDS else F.filter(out, lambda p: p["score"] >= LEAST)

    return F.when(F.coalesce(F.size(found["m"]), F.lit(0)) > 0, spans(found)).otherwise(F.array().cast(_SPAN)).cast(_SPAN)


def pii_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with the column pii: spans (kind, start, end, score) of each whole text, by kind as in KINDS and then by start.

    Places are code points, ends exclusive. Null and empty texts have no spans. A column pii is replaced; needs no shuffle.
    Matches of one kind don't overlap; those of different kinds may.
    """
    names = {kind: f"pii__{kind}" for kind in KINDS}
    out = docs.withColumn("pii__text", F.coalesce(F.col(text), F.lit("")))
    for kind in KINDS:
        out = out.withColumn(names[kind], _found(F.col("pii__text"), kind))
    out = out.withColumns({names[kind]: _placed(F.col(names[kind]), F.col("pii__text"), kind) for kind in KINDS})
    return out.withColumn("pii", F.concat(*[F.col(n) for n in names.values()])).drop("pii__text", *names.values())


def redacted(text: Column, spans: Column) -> Column:
    """The text with each span's code points replaced by its kind; spans that begin inside an earlier one are part of it."""
    order = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("turn"), s["kind"].alias("kind"))))
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        put = F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit("<"), s["kind"], F.lit(">"))
        return F.when(s["start"] >= acc["at"], F.struct((-s["turn"]).alias("at"), put.alias("out"))).otherwise(F.struct(F.greatest(acc["at"], -s["turn"]).alias("at"), acc["out"].alias("out")))

    return F.aggregate(order, zero, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))


def _digest(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat(s["kind"], F.lit(":"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string"))), ",")


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and spans of every document; after the columns that are asked for: secrets, all spans, and the score of each span in their order."""
    out = pii_spans(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "pii")
    count = lambda kinds, name: F.size(F.filter("pii", lambda s: s["kind"].isin(*kinds))).cast("long").alias(name)
    base = F.filter("pii", lambda s: s["kind"].isin(*BASE_KINDS))
    scores = F.array_join(F.transform("pii", lambda s: F.format_number(s["score"], 2)), ",")
    return out.select("doc_id", *[count([k], f"n_{k}") for k in BASE_KINDS], F.sha2(_digest(base), 256).alias("base_sha256"), _digest(F.col("pii")).alias("spans"), count(SECRET_KINDS, "n_secret"), count(KINDS, "n_spans"), scores.alias("scores"))
