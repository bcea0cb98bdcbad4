"""Quotes: pricing, drafting with guardrail flags, rationale text and product matching."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import ratio
from ..session import cut_lineage
from .ordered import latest_per_key

# Discount limit and margin floor in percent.
MAX_DISCOUNT_PCT = 15.0
MARGIN_FLOOR_PCT = 25.0


def quote_draft(quotes: DataFrame, max_discount: float = MAX_DISCOUNT_PCT, margin_floor: float = MARGIN_FLOOR_PCT) -> DataFrame:
    """Net price, totals and margin of each quote line, with the flags that send it to a person.

    Money is decimal, so a price on half a cent always rounds up.
    """
    listed, cost = F.col("list_price_eur").cast("decimal(12,2)"), F.col("standard_cost_eur").cast("decimal(12,2)")
    keep = F.lit(Decimal("100.00")) - F.col("discount_pct").cast("decimal(5,2)")
    net = F.round(listed * keep * F.lit(Decimal("0.01")), 2).cast("decimal(12,2)")
    qty = F.col("quantity_units").cast("decimal(12,0)")
    rows = quotes.withColumn("_net", net).withColumn("_margin", (F.col("_net") - cost).cast("decimal(12,2)"))
    pct = F.coalesce(F.round(ratio(F.col("_margin"), F.col("_net")) * 100, 1), F.lit(0.0))
    return rows.withColumn("margin_pct", pct).select(
        *quotes.columns,
        F.col("_net").cast("double").alias("net_unit_price_eur"),
        (F.col("_net") * qty).cast("double").alias("extended_price_eur"),
        (cost * qty).cast("double").alias("total_cost_eur"),
        F.col("_margin").cast("double").alias("unit_margin_eur"),
        "margin_pct",
        (F.col("_margin") * qty).cast("double").alias("total_margin_eur"),
        (F.col("discount_pct") > max_discount).alias("discount_flag"),
        (F.col("margin_pct") < margin_floor).alias("margin_flag"),
        ((F.col("discount_pct") > max_discount) | (F.col("margin_pct") < margin_floor)).alias("requires_escalation"),
    )


def quote_rationale(drafts: DataFrame, given: Column | None = None) -> DataFrame:
    """Stated or default reason of a quote, with its guardrail flags appended."""
    standard = F.format_string(
        "%d units of %s, %.2f%% off: %.2f EUR per unit at %.1f%% margin.",
        F.col("quantity_units").cast("bigint"), F.col("sku"), F.col("discount_pct").cast("double"),
        F.col("net_unit_price_eur"), F.col("margin_pct"),
    )
    base = standard if given is None else F.coalesce(F.nullif(given, F.lit("")), standard)
    flags = F.concat_ws(
        " ",
        base,
        F.when(F.col("requires_escalation"), "FLAGGED:"),
        F.when(F.col("discount_flag"), "discount above limit."),
        F.when(F.col("margin_flag"), "margin below floor."),
    )
    return drafts.withColumn("rationale", flags)


def quote_price(products: DataFrame, actuals: DataFrame) -> DataFrame:
    """List price, cost and unit margin of every SKU next to its latest realised price and margin."""
    recent = latest_per_key(actuals, ("sku",), ("month",), ("month", "units", "revenue_eur", "gross_margin_pct")).select(
        "sku", F.col("month").alias("recent_month"),
        F.round(ratio(F.col("revenue_eur"), F.col("units")), 2).alias("realized_price_eur"),
        F.round(F.col("gross_margin_pct") * 100, 1).alias("realized_margin_pct"),
    )
    margin = F.col("list_price_eur").cast("decimal(12,2)") - F.col("standard_cost_eur").cast("decimal(12,2)")
    return products.select(
        "sku", "product_name", "region", "currency", "list_price_eur", "standard_cost_eur",
        margin.cast("double").alias("unit_margin_eur"),
        F.round(ratio(margin, F.col("list_price_eur")) * 100, 1).alias("unit_margin_pct"),
    ).join(recent, "sku", "left")


_MIN_TOKEN = 3
_GRAM = 3


def _grams(text: Column) -> Column:
    """The different sequences of three letters inside the letter runs of a lower-case text."""
    runs = F.filter(F.regexp_extract_all(text, F.lit(r"([a-z]+)"), 1), lambda r: F.length(r) >= _GRAM)
    cut = F.transform(runs, lambda r: F.transform(F.sequence(F.lit(1), F.length(r) - (_GRAM - 1)), lambda i: F.substr(r, i, F.lit(_GRAM))))
    return F.array_distinct(F.flatten(cut))


def _word_matches(words: DataFrame, names: DataFrame) -> DataFrame:
    """Which names (``product_name``, ``low``) contain which words (``token``, each once).

    The index has a posting per name and three letters, so it grows with the length of the names, not with all their
    substrings. A word looks up the rarest three letters it has, and the names found are confirmed to contain the whole word.
    """
    postings = names.select("product_name", "low", F.explode(_grams(F.col("low"))).alias("gram"))
    sizes = postings.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    parts = words.select("token", F.explode(_grams(F.col("token"))).alias("gram")).join(sizes, "gram", "left")
    keyed = parts.groupBy("token").agg(F.min_by("gram", F.struct(F.coalesce("n", F.lit(0)), "gram")).alias("gram"))
    return keyed.join(postings, "gram").filter(F.contains("low", F.col("token"))).select("token", "product_name")


def product_match(requests: DataFrame, products: DataFrame, text: str = "request_text", region: str = "region", common: int = 1000) -> DataFrame:
    """Best product for the words of each request: in the requested region first, else anywhere.

    A product scores one for every word of more than two letters that its name contains. Equal requests are scored once; ties
    go to the lowest SKU.

    A word in up to ``common`` names brings those names up as candidates of the request, which are scored whole: at most
    ``common`` per word. Words in more names would bring up most products, so they are looked at by themselves: names with the
    same such words count as one, with their lowest SKU per region, and so do requests. The best of both is the best of all,
    since a name that has only common words scores what its set scores. So a word that stands in every name costs one row per
    set of words and region, not one per request and product.
    """
    low = F.lower(F.col(text))
    asked = requests.select(text).filter(F.col(text).isNotNull()).distinct()
    words = F.regexp_extract_all(low, F.lit(r"([a-z]+)"), 1)
    tokens = cut_lineage(asked.withColumn("token", F.explode(words)).filter(F.length("token") >= _MIN_TOKEN).groupBy(text, "token").agg(
        F.count(F.lit(1)).alias("times")))
    goods = cut_lineage(products.groupBy("product_name", F.col("region").alias("_region")).agg(F.min("sku").alias("sku")))
    names = goods.filter("product_name IS NOT NULL").select("product_name", F.lower("product_name").alias("low")).distinct()
    matches = cut_lineage(_word_matches(tokens.select("token").distinct(), names))
    spread = matches.groupBy("token").agg((F.count(F.lit(1)) > common).alias("is_common"))
    known = tokens.join(spread, "token")

    # names that a rarer word brings up, scored by all words of the request
    listed = known.groupBy(text).agg(F.collect_list(F.struct("token", "times")).alias("words"))
    near = known.filter(~F.col("is_common")).join(matches, "token").select(text, "product_name").distinct()
    score = F.aggregate("words", F.lit(0).cast("bigint"), lambda n, w: n + F.when(F.contains(F.lower("product_name"), w["token"]), w["times"]).otherwise(0))
    rare = near.join(listed, text).select(text, "product_name", score.alias("score")).join(goods, "product_name").select(text, "_region", "sku", "score")

    # sets of common words, of requests and of names
    pair = F.sort_array(F.collect_list(F.struct("token", "times")))
    sets = known.filter("is_common").groupBy(text).agg(pair.alias("wanted"))
    named = matches.join(spread.filter("is_common"), "token").groupBy("product_name").agg(F.sort_array(F.collect_list("token")).alias("has"))
    cells = goods.join(named, "product_name").groupBy("has", "_region").agg(F.min("sku").alias("sku"))
    want = sets.select("wanted").distinct().select("wanted", F.inline("wanted"))
    have = cells.select("has").distinct().select("has", F.explode("has").alias("token"))
    scored = want.join(have, "token").groupBy("wanted", "has").agg(F.sum("times").alias("score"))
    hit = F.struct("sku", "score")
    order = F.struct((-F.col("score")).alias("o"), F.col("sku"))
    by_set = scored.join(cells, "has").groupBy("wanted", "_region").agg(F.min_by(hit, order).alias("_hit"))
    frequent = sets.join(by_set, "wanted").select(text, "_region", "_hit.sku", "_hit.score")

    in_region = cut_lineage(rare.unionByName(frequent).groupBy(text, "_region").agg(F.min_by(hit, order).alias("_hit")))
    anywhere = in_region.groupBy(text).agg(F.min_by("_hit", F.struct((-F.col("_hit.score")).alias("o"), F.col("_hit.sku"))).alias("_any"))
    local = in_region.withColumnRenamed("_region", region)
    matched = requests.join(local, [text, region], "left").join(anywhere, text, "left")
    best = F.coalesce("_hit", "_any")
    return matched.select(
        *requests.columns, best["sku"].alias("sku"), best["score"].alias("name_score"),
        F.col("_hit").isNotNull().alias("in_region"),
    )
