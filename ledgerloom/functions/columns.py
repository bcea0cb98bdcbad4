"""Per-row rules as column expressions. Nothing here leaves the JVM."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

Period = tuple[str, date, date]


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def case_bucket(month: Column | str, periods: Sequence[Period]) -> Column:
    """Label of the first period that holds the month, NULL outside all of them."""
    out = None
    for label, lo, hi in periods:
        hit = _c(month).between(F.lit(lo), F.lit(hi))
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out


def ratio(num: Column, den: Column) -> Column:
    """Division in DOUBLE that gives NULL on a zero denominator instead of an ANSI error."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def sum_ratio(num: Column | str, den: Column | str) -> Column:
    """The certified way to aggregate a ratio: sum over sum, never the mean of row ratios."""
    return ratio(F.sum(_c(num)), F.sum(_c(den)))


def perfect_orders(pct: Column | str = "otif_pct", orders: Column | str = "orders") -> Column:
    """Whole perfect orders of a row, rebuilt from its truncated fraction."""
    return F.round(_c(pct) * _c(orders), 0).cast("bigint")


def otif_pct(digits: int = 1) -> Column:
    """Order-weighted on-time-in-full percentage of a group."""
    return F.round(ratio(F.sum(perfect_orders()), F.sum("orders")) * 100, digits)


def digits_only(text: Column | str, to: str = "bigint") -> Column:
    """Number formed by the digits of a text; NULL when there is none.

    Separators are dropped, so ``1,000.00`` reads as 100000: the rule is meant for whole amounts.
    """
    return F.regexp_replace(_c(text), r"[^0-9]", "").try_cast(to)


def zero_padded(number: Column | str, width: int) -> Column:
    """The number as text with leading zeros up to ``width`` characters, never cut."""
    text = _c(number).cast("string")
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))


def chunk_id(doc_id: Column | str, seq: Column | str, width: int = 6) -> Column:
    """``doc_000007``. Numbers longer than ``width`` keep all their digits, so ids never collide."""
    return F.concat(_c(doc_id).cast("string"), F.lit("_"), zero_padded(seq, width))


def yes_bool(text: Column | str) -> Column:
    return F.lower(_c(text)).isin("true", "yes")


def non_standard_flag(terms_days: Column | str, annual_spend: Column | str,
                      max_days: int = 60, min_spend: int = 1_000_000) -> Column:
    """Payment terms above the limit on a supplier above the spend limit."""
    return (_c(terms_days) > max_days) & (_c(annual_spend) > min_spend)


def strip_fence(text: Column | str) -> Column:
    """Content of the first code fence of a model output, else the trimmed text."""
    inner = F.regexp_extract(_c(text), r"(?s)```[A-Za-z]*\s*(.*?)```", 1)
    return F.trim(F.when(_c(text).rlike(r"(?s)```.*?```"), inner).otherwise(_c(text)), F.lit(" \n\r\t"))


# Keywords of each sales region, tested in this order.
REGION_KEYWORDS = (
    ("EMEA", ("emea", "europe", "rotterdam", "netherlands", "uk", "germany")),
    ("Americas", ("america", "us", "usa", "latam", "canada")),
    ("APAC", ("apac", "asia", "australia", "pacific")),
    ("China", ("china",)),
)


def region_norm(text: Column | str, rules=REGION_KEYWORDS, legacy: bool = False) -> Column:
    """First region one of whose keywords occurs in the text, else the text itself.

    ``legacy=True`` looks for the keyword anywhere, so ``russia`` and ``australia`` hit ``us``.
    The default wants the keyword at a word start and, for keywords of up to three letters, a whole word.
    """
    source = F.coalesce(_c(text), F.lit(""))
    lowered = F.lower(source)
    out = None
    for region, words in rules:
        if legacy:
            pattern = "|".join(words)
        else:
            pattern = "|".join(rf"\b{w}\b" if len(w) <= 3 else rf"\b{w}" for w in words)
        out = F.when(lowered.rlike(pattern), region) if out is None else out.when(lowered.rlike(pattern), region)
    return out.otherwise(source)


def month_horizon(month: Column | str, months: int = 3) -> Column:
    return F.add_months(_c(month), months)


# What an address or a telephone number looks like.
EMAIL_PATTERN = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
PHONE_PATTERN = r"\+[0-9]{1,3} ?\(?[0-9]{2,4}\)?[ -]?[0-9]{3,4}[ -]?[0-9]{4}"


def mask_text(text: Column | str, email: str = "[EMAIL]", phone: str = "[PHONE]") -> Column:
    """Replace e-mail addresses and telephone numbers. Names of people need a model and are left."""
    return F.regexp_replace(F.regexp_replace(_c(text), EMAIL_PATTERN, email), PHONE_PATTERN, phone)


def sentence_count(text: Column | str) -> Column:
    """Sentences that hold at least one character other than spaces and closing marks."""
    parts = F.split(_c(text), r"[.!?]+")
    return F.size(F.filter(parts, lambda s: F.length(F.trim(s)) > 0)).cast("bigint")
