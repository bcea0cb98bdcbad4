"""Personal data by pattern, confirmed by checksums and weighed by the words around it. Column expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import text_of

#: The patterns of each kind. A match starts where the one before it ended or where no character of its
#: first part precedes; this and the possessive quantifiers change no match and keep long texts linear.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}+(?![A-Za-z0-9])",
}
#: What a text must hold to be searched for a kind; cheaper than the pattern.
NEEDED = {"email": "@", "phone": "+"}
#: Words that make a kind likelier when they stand before it, in lower case.
CONTEXT = {
    "email": ("mail", "email", "contact", "write"),
    "ip": ("ip", "address", "host", "server"),
    "card": ("card", "visa", "credit", "payment"),
    "phone": ("phone", "tel", "call", "mobile"),
    "iban": ("iban", "account", "bank", "konto"),
}
BASE_KINDS = ("email", "ip", "card", "phone")
#: Score of a span before its surroundings: a checksum says more than a shape.
PRIOR = {"email": 0.9, "ip": 0.7, "card": 0.9, "phone": 0.7, "iban": 0.95}
REACH, BONUS = 40, 0.2


def digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits ends in its Luhn check digit."""
    turned = F.split(F.reverse(number), "")
    worth = F.transform(turned, lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
        F.when(d.cast("int") > 4, d.cast("int") * 2 - 9).otherwise(d.cast("int") * 2)))
    return F.aggregate(worth, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0))) % 10 == 0


def mod97(iban: Column) -> Column:
    """Whether an account number without spaces leaves 1 when divided by 97."""
    moved = F.concat(F.substring(iban, 5, 100), F.substring(iban, 1, 4))
    values = F.transform(F.filter(F.split(moved, ""), lambda c: c != ""), lambda c: F.when(
        c.between("0", "9"), c.cast("int")).otherwise(F.ascii(c) - 55))
    return F.aggregate(values, F.lit(0), lambda a, v: (a * F.when(v > 9, 100).otherwise(10) + v) % 97) == 1


def confirmed(kind: str, match: Column) -> Column:
    if kind == "ip":
        def fits(part: Column) -> Column:
            plain = F.regexp_replace(part, "^0+", "")
            return (F.length(plain) < 3) | ((F.length(plain) == 3) & (plain <= "255"))

        return F.forall(F.split(match, r"\."), fits)
    if kind == "card":
        number = digits(match)
        return F.length(number).between(13, 19) & luhn(number)
    if kind == "phone":
        return F.length(digits(match)).between(9, 15)
    if kind == "iban":
        plain = F.replace(match, F.lit(" "), F.lit(""))
        return F.length(plain).between(15, 34) & mod97(plain)
    return F.lit(True)


SPAN = "struct<kind:string,start:int,end:int,match:string,score:double>"


def _fold(found: Column, kind: str) -> Column:
    """Spans of one kind from the (match, piece before it) pairs of a text."""
    context = r"(?i)\b(?:" + "|".join(CONTEXT[kind]) + r")\b"

    def step(acc: Column, pair: Column) -> Column:
        start = acc["end"] + F.length(pair["piece"])
        end = start + F.length(pair["match"])
        near = F.right(pair["piece"], F.lit(REACH)).rlike(context)
        score = F.least(F.lit(1.0), F.lit(PRIOR[kind]) + F.when(near, BONUS).otherwise(0.0))
        span = F.struct(F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"), pair["match"].alias("match"), score.alias("score"))
        kept = F.when(confirmed(kind, pair["match"]), F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"])
        return F.when(pair["match"].isNull(), acc).otherwise(F.struct(end.alias("end"), kept.alias("spans")))

    zero = F.struct(F.lit(0).alias("end"), F.array().cast(f"array<{SPAN}>").alias("spans"))
    return F.aggregate(found, zero, step)["spans"]


def with_spans(docs: DataFrame, text_col: str = "text", out_col: str = "spans", kinds: tuple[str, ...] = tuple(PATTERNS)) -> DataFrame:
    """Add ``out_col``: an array of (kind, start, end, match, score), by kind as listed and then by start.

    A pattern proposes spans, leftmost and not overlapping per kind; cards must pass the Luhn check, account numbers the
    check modulo 97, addresses have parts up to 255, phones 9 to 15 digits. Failing matches are dropped without a second
    try. Each kind has a prior score, raised by a context word within 40 characters before the match. Places count code
    points, ``end`` is exclusive. The text is split at the matches, so the lengths of pieces and matches give the places.

    A map over the rows without shuffle or Python. Null texts count as empty; empty texts have no spans; the whole text
    is read however long, in time linear in its length (and quadratic in its number of confirmed spans, where 100,000
    take seconds); repeated rows are treated alike; a column named ``out_col`` is replaced, others are kept; no rows
    give no rows.
    """
    kept = [F.col(f"`{c}`") for c in docs.columns if c != out_col]
    text = text_of(text_col)
    parts = {k: (f"__match_{k}", f"__piece_{k}") for k in kinds}
    none = F.array().cast("array<string>")

    def found(kind: str) -> list[Column]:
        match, piece = F.regexp_extract_all(text, F.lit(PATTERNS[kind]), F.lit(0)), F.split(text, PATTERNS[kind], -1)
        if kind in NEEDED:
            some = F.contains(text, F.lit(NEEDED[kind]))
            match, piece = F.when(some, match).otherwise(none), F.when(some, piece).otherwise(none)
        return [match.alias(parts[kind][0]), piece.alias(parts[kind][1])]

    searched = docs.select(*kept, *(c for k in kinds for c in found(k)))
    names = [F.col(f"`{c}`") for c in docs.columns if c != out_col]
    paired = searched.select(*names, *(
        F.zip_with(m, p, lambda a, b: F.struct(a.alias("match"), b.alias("piece"))).alias(m) for m, p in parts.values()))
    return paired.select(*names, F.concat(*(_fold(F.col(parts[k][0]), k) for k in kinds)).alias(out_col))


def listed(spans: Column) -> Column:
    """The spans as text: kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def pii_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: its id, counts per base kind, a digest of the base spans, all spans as text, and the best score."""
    spans = with_spans(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")))
    base = spans.select("doc_id", "spans", F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS)).alias("base"))

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return base.select(
        "doc_id", *(count(k) for k in BASE_KINDS), F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"), F.array_max(F.transform("spans", lambda s: s["score"])).alias("top_score"),
    )


def mask_pii(docs: DataFrame, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """Replace each span with a score of at least ``threshold`` by its kind in angle brackets; overlaps become one.

    Keeps all rows and columns; ``n_chars``, if there, follows the new text. A null text stays null.
    """
    spans = "__pii"
    text = F.col(f"`{text_col}`")
    strong = F.array_sort(F.filter(spans, lambda s: s["score"] >= threshold), lambda a, b: a["start"] - b["start"])

    def step(acc: Column, s: Column) -> Column:
        inside = s["start"] < acc["at"]
        between = F.substring(text, acc["at"] + 1, s["start"] - acc["at"])
        pieces = F.when(inside, acc["pieces"]).otherwise(F.concat(acc["pieces"], F.array(between, F.concat(F.lit("<"), s["kind"], F.lit(">")))))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), pieces.alias("pieces"))

    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("pieces"))
    cut = F.aggregate(strong, zero, step, lambda acc: F.concat(
        F.array_join(acc["pieces"], ""), F.substring(text, acc["at"] + 1, F.length(text))))
    masked = with_spans(docs, text_col, spans).withColumn(text_col, F.when(F.size(spans) > 0, cut).otherwise(text)).drop(spans)
    return masked.withColumn("n_chars", F.length(text_col).cast(dict(docs.dtypes)["n_chars"])) if "n_chars" in docs.columns else masked
