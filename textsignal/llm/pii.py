"""Personal data in text, by built-in functions only.

Regular expressions propose spans, checksums confirm them (Luhn for cards, mod 97 for bank accounts),
and words near a span raise its score. Positions are code points. Every text is split once per kind at
the kind's matches, so starts are running sums of the lengths of what lies between.
"""
from pyspark.sql import functions as F

from textsignal.operators.bounds import bind

# Patterns. Possessive quantifiers and the look-behind only rule out starts and back-tracking that cannot
# match, so that long runs of one class cost linear time: within a run, a later start fails where the first
# one did, unless the search resumes there after a match (\G).
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
BASE = ("email", "ip", "card", "phone")
# Cheap tests that a text without any match fails.
GUARDS = {"email": "@", "ip": ".", "card": None, "phone": "+", "iban": None, "ssn": "-"}
SCORES = {"email": 0.7, "ip": 0.6, "card": 0.7, "phone": 0.6, "iban": 0.8, "ssn": 0.4}
CONTEXT = {
    "email": ("mail", "contact", "write", "kontakt", "correo"), "ip": ("ip", "host", "server", "address", "adresse"),
    "card": ("card", "visa", "mastercard", "credit", "payment", "karte", "carte", "tarjeta"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "telefon"), "iban": ("iban", "bank", "account", "konto", "compte"),
    "ssn": ("ssn", "social", "security"),
}
CONTEXT_CHARS, CONTEXT_BONUS, REPORT_FROM = 40, 0.3, 0.5
CHUNK = 64


def let(value, body):
    """Bind a costly value once inside an expression."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def only_digits(c):
    return F.regexp_replace(c, "[^0-9]", "")


def luhn(digits):
    """True where a digit string passes the Luhn check."""
    def doubled(i):
        d = F.substring(F.reverse(digits), i, F.lit(1)).cast("int")
        return F.when(i % 2 == 1, d).when(d > 4, d * 2 - 9).otherwise(d * 2)
    return F.aggregate(F.transform(F.sequence(F.lit(1), F.length(digits)), doubled), F.lit(0), lambda a, x: a + x) % 10 == 0


def mod97(account):
    """True where an account number, without blanks, has check value 1."""
    turned = F.concat(F.substring(account, F.lit(5), F.length(account)), F.substring(account, 1, 4))
    values = F.transform(F.split(turned, ""), lambda ch: F.when(ch.between("0", "9"), F.ascii(ch) - 48).otherwise(F.ascii(ch) - 55))
    return F.aggregate(values, F.lit(0), lambda a, v: (a * F.when(v > 9, 100).otherwise(10) + v) % 97) == 1


def confirmed(kind, match):
    """The length rule or checksum of a kind."""
    if kind == "ip":
        parts = F.transform(F.split(match, r"\."), lambda p: F.ltrim(p, F.lit("0")))
        return F.forall(parts, lambda p: (F.length(p) < 3) | (F.length(p) == 3) & (p <= "255"))
    if kind == "card":
        return let(only_digits(match), lambda d: F.when(F.length(d).between(13, 19), luhn(d)).otherwise(False))
    if kind == "phone":
        return F.length(only_digits(match)).between(9, 15)
    if kind == "iban":
        return let(F.replace(match, F.lit(" "), F.lit("")), lambda a: F.length(a).between(15, 34) & mod97(a))
    return F.lit(True)


def _possible(kind, text):
    return F.contains(text, F.lit(GUARDS[kind])) if GUARDS[kind] else F.lit(True)


def _cut(kind, text):
    """Matches of a kind, and what lies around them (always one more)."""
    pattern = F.lit(PATTERNS[kind])
    return F.struct(F.split(text, PATTERNS[kind], -1).alias("gaps"), F.regexp_extract_all(text, pattern, F.lit(0)).alias("hits"))


def _starts(cut):
    """Start of each match. Sums run over chunks and then inside one, so many matches stay cheap."""
    sizes = F.transform(cut["hits"], lambda m, i: F.length(F.get(cut["gaps"], i)) + F.length(m))
    add = lambda xs: F.aggregate(xs, F.lit(0), lambda a, x: a + x)

    def placed(sizes):
        chunks = F.sequence(F.lit(0), F.floor((F.size(sizes) - 1) / CHUNK).cast("int"))
        totals = F.transform(chunks, lambda c: add(F.slice(sizes, c * CHUNK + 1, F.lit(CHUNK))))
        return let(totals, lambda t: let(F.transform(chunks, lambda c: add(F.slice(t, F.lit(1), c))), lambda before: F.transform(
            sizes, lambda _, i: F.get(before, F.floor(i / CHUNK).cast("int")) + F.length(F.get(cut["gaps"], i))
            + add(F.slice(sizes, F.floor(i / CHUNK).cast("int") * CHUNK + 1, i % CHUNK)))))
    return let(sizes, placed)


def scored(kind, cut, i):
    """Score of the i-th match: the kind's own, more if a context word stands near."""
    words = r"(?i)\b(?:" + "|".join(CONTEXT[kind]) + r")\b"
    near = F.concat_ws(" ", F.right(F.get(cut["gaps"], i), F.lit(CONTEXT_CHARS)), F.left(F.get(cut["gaps"], i + 1), F.lit(CONTEXT_CHARS)))
    return F.round(F.lit(SCORES[kind]) + F.when(near.rlike(words), CONTEXT_BONUS).otherwise(0.0), 2)


def reported(kind, cut, i):
    """True if the i-th match is confirmed and, outside the base kinds, scores high enough."""
    ok = confirmed(kind, F.get(cut["hits"], i))
    return ok if kind in BASE else ok & (scored(kind, cut, i) >= REPORT_FROM)


def spans(kind, text):
    """Spans of one kind as array<struct<kind, start, end, score>>, by start."""
    def described(cut, starts):
        def one(i):
            start = F.get(starts, i)
            return F.struct(F.lit(kind).alias("kind"), start.alias("start"), (start + F.length(F.get(cut["hits"], i))).alias("end"),
                            scored(kind, cut, i).alias("score"))
        places = F.sequence(F.lit(0), F.size(cut["hits"]) - 1)
        return F.transform(F.filter(places, lambda i: reported(kind, cut, i)), one)

    none = F.array().cast(SPANS)
    found = let(_cut(kind, text), lambda cut: F.when(F.size(cut["hits"]) == 0, none).otherwise(let(_starts(cut), lambda s: described(cut, s))))
    return F.when(_possible(kind, text), found).otherwise(none)


SPANS = "array<struct<kind:string,start:int,end:int,score:double>>"


def scan(docs, text="text", name="pii"):
    """Add the spans of each whole text, by kind in the order of PATTERNS and then by start. Null text counts as empty.

    Base kinds are reported whenever their rule holds; account and insurance numbers only from a score of
    REPORT_FROM. All work stays in the row.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    return bind(docs.drop(name), **{name: F.concat(*[spans(k, whole).cast(SPANS) for k in PATTERNS])})


def _redacted(kind, text):
    def joined(cut):
        def piece(gap, i):
            shown = F.when(reported(kind, cut, i), f"[{kind.upper()}]").otherwise(F.get(cut["hits"], i))
            return F.concat(gap, F.when(i < F.size(cut["hits"]), shown).otherwise(""))
        return F.when(F.size(cut["hits"]) == 0, text).otherwise(F.array_join(F.transform(cut["gaps"], piece), ""))
    return F.when(_possible(kind, text), let(_cut(kind, text), joined)).otherwise(text)


def redact(docs, text="text"):
    """Replace what is reported of each kind by its name in brackets, kind after kind; null text stays null, other columns as they are.

    Cards come first, since their digits may belong to another kind's match.
    """
    columns = docs.columns
    for kind in ("card", "phone", "email", "ip", "iban", "ssn"):
        docs = bind(docs, _redacted=_redacted(kind, F.col(text))).select(*[F.col("_redacted").alias(c) if c == text else F.col(c) for c in columns])
    return docs
