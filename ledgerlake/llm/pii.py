r"""Personal data: patterns propose spans, checksums confirm them, words nearby adjust their score. DataFrame operations only.

Four base kinds are found by fixed patterns, leftmost and not overlapping within a kind, and dropped where the check fails:
e-mail addresses, IP addresses (parts up to 255), payment cards (13 to 19 digits, Luhn), phone numbers (9 to 15 digits). Two kinds are added:
``iban`` (mod 97) and ``national_id`` (three-two-four digits, with the impossible groups excluded), the latter only where a word
nearby speaks for it, since its digits carry no check.

A span's score starts from its kind (0.9 where a checksum or a structure confirms it), gains 0.1 for each word in its favour within CONTEXT
characters before it, at most 0.2, and loses 0.2 if a word before it speaks of samples. A base span stays whatever its score; an
added one is reported at MIN_SCORE and above.

Positions are code points, end exclusive. They come from splitting the text by the pattern: the lengths of the pieces between the
matches add up. The patterns below are the stated ones written so that Java's matcher neither backtracks nor recurses on long runs: a
match may begin only where a run of its first class begins (or where the last match ended), and repetition is possessive. Both find the same
spans, because whether a match follows a run does not depend on where in the run it begins.

Null counts as empty. An empty text has no spans, and base_sha256 is that of the empty string. Repeated rows get a row each, and other columns
are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerlake.llm.common import text_of

_RUN = r"A-Za-z0-9._%+-"
PATTERNS = {
    "email": rf"(?:(?<![{_RUN}])|\G)[{_RUN}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){12,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "national_id": r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])",
}
BASE = ("email", "ip", "card", "phone")
ADDED = ("iban", "national_id")
# What a text must contain for a pattern to be worth running; each is necessary for a match.
NEEDED = {"email": "@", "ip": "[0-9]\\.[0-9]", "card": "[0-9]{2}|[0-9][ -][0-9]", "phone": "\\+[0-9]", "iban": "[A-Z]{2}[0-9]{2}", "national_id": "[0-9]-[0-9]"}
BLOCK = 256
CONTEXT = 40
FOR_IT = {
    "email": r"(?i)\b(?:e-?mail|mail|contact|address|write)\b",
    "ip": r"(?i)\b(?:ip|server|host|address|login)\b",
    "card": r"(?i)\b(?:card|visa|credit|debit|mastercard|payment)\b",
    "phone": r"(?i)\b(?:phone|call|tel|mobile|fax|contact)\b",
    "iban": r"(?i)\b(?:iban|account|bank|transfer|konto|compte)\b",
    "national_id": r"(?i)\b(?:ssn|social|security|id|identity|tax)\b",
}
AGAINST = r"(?i)\b(?:example|sample|dummy|test|version|serial|isbn)\b"
START = {"email": 0.9, "ip": 0.7, "card": 0.9, "phone": 0.7, "iban": 0.9, "national_id": 0.4}
MIN_SCORE = 0.5


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _mod97(value: Column) -> Column:
    """An IBAN's remainder: first four characters last, letters as 10 to 35, digit by digit."""
    bare = F.translate(value, " ", "")
    turned = F.split(F.concat(F.substring(bare, 5, 40), F.substring(bare, 1, 4)), "")
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

    def step(rest: Column, c: Column) -> Column:
        n = F.instr(F.lit(letters), c)
        return F.when(n > 0, (rest * 100 + n + 9) % 97).otherwise((rest * 10 + F.coalesce(c.try_cast("int"), F.lit(0))) % 97)

    return F.aggregate(F.filter(turned, lambda c: c != ""), F.lit(0), step)


def _valid(kind: str, value: Column) -> Column:
    """Whether a match passes its kind's check."""
    n = F.length(_digits(value))
    if kind == "ip":
        # A part of more than three digits, leading zeros aside, is above 255 and may not fit a number.
        parts = F.transform(F.split(value, "[.]"), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", ""))
        return F.forall(parts, lambda p: (F.length(p) <= 3) & (F.lpad(p, 3, "0") <= "255"))
    if kind == "card":
        return n.between(13, 19) & F.call_function("luhn_check", _digits(value))
    if kind == "phone":
        return n.between(9, 15)
    if kind == "iban":
        return F.length(F.translate(value, " ", "")).between(15, 34) & (_mod97(value) == 1)
    return F.lit(True)


def _sums_before(lengths: Column) -> Column:
    """Of an array of numbers, the sum of all that come before each. Two levels of blocks keep the work near linear; what a lambda
    needs reaches it as its own variable, since an outer expression would be computed again for every element."""
    add = lambda part: F.aggregate(part, F.lit(0), lambda s, x: s + x)
    parts = F.transform(F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / BLOCK).cast("int")), lambda b: F.slice(lengths, b * BLOCK + 1, BLOCK))
    start = F.struct(F.lit(0).alias("sum"), F.array().cast("array<struct<before:int,part:array<int>>>").alias("blocks"))

    def step(so_far: Column, part: Column) -> Column:
        block = F.struct(so_far["sum"].alias("before"), part.alias("part"))
        return F.struct((so_far["sum"] + add(part)).alias("sum"), F.concat(so_far["blocks"], F.array(block)).alias("blocks"))

    blocks = F.aggregate(parts, start, step)["blocks"]
    return F.flatten(F.transform(blocks, lambda b: F.transform(b["part"], lambda _, k: b["before"] + add(F.slice(b["part"], 1, k)))))


def _score(kind: str, context: Column) -> Column:
    found = F.size(F.regexp_extract_all(context, F.lit(FOR_IT[kind]), F.lit(0)))
    less = F.when(context.rlike(AGAINST), 0.2).otherwise(0.0)
    return F.round(F.lit(START[kind]) + F.least(found, F.lit(2)) * 0.1 - less, 2)


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id and spans, an array of (kind, start, end, score) by kind as listed, then start."""
    matched = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("body"))
    none = F.array().cast("array<string>")
    matched = matched.select(
        "doc_id",
        "body",
        *[
            F.when(F.col("body").rlike(NEEDED[k]), F.regexp_extract_all("body", F.lit(p), F.lit(0))).otherwise(none).alias(k)
            for k, p in PATTERNS.items()
        ],
    )
    # Only texts with a match are split, to learn where it stands.
    some = {k: F.size(k) > 0 for k in PATTERNS}
    cut = matched.select(
        "doc_id",
        *PATTERNS,
        *[F.when(some[k], F.split("body", p, -1)).otherwise(none).alias(f"{k}_between") for k, p in PATTERNS.items()],
    )
    gaps = cut.select(
        *["doc_id", *PATTERNS, *[f"{k}_between" for k in PATTERNS]],
        *[F.zip_with(k, F.slice(f"{k}_between", 1, F.size(k)), lambda m, b: F.length(m) + F.length(b)).alias(f"{k}_gap") for k in PATTERNS],
    )
    placed = gaps.select(
        "doc_id",
        *[
            F.when(
                some[k],
                F.arrays_zip(F.col(k).alias("value"), F.slice(f"{k}_between", 1, F.size(k)).alias("between"), _sums_before(F.col(f"{k}_gap")).alias("at")),
            ).alias(k)
            for k in PATTERNS
        ],
    )
    return placed.select("doc_id", F.concat(*[_spans(kind) for kind in PATTERNS]).alias("spans"))


def _spans(kind: str) -> Column:
    """The confirmed spans of one kind, from its matches, the pieces between them and the lengths before them."""

    def placed(match: Column) -> Column:
        start = match["at"] + F.length(match["between"])
        return F.struct(
            _valid(kind, match["value"]).alias("valid"),
            F.lit(kind).alias("kind"),
            start.alias("start"),
            (start + F.length(match["value"])).alias("end"),
            _score(kind, F.right(match["between"], F.lit(CONTEXT))).alias("score"),
        )

    least = MIN_SCORE if kind in ADDED else 0.0
    found = F.filter(F.transform(kind, placed), lambda s: s["valid"] & (s["score"] >= least))
    none = F.array().cast("array<struct<kind:string,start:int,end:int,score:double>>")
    return F.coalesce(F.transform(found, lambda s: s.dropFields("valid")), none)


def joined(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def number(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
