"""Benchmark decontamination: windows of benchmark words found in training texts. Column expressions only."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import cut_lineage, text_of

#: Bytes of benchmark text up to which its windows are broadcast; above, windows are matched by a shuffle.
BROADCAST_BYTES = 8 << 20
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Words of a text after A-Z became a-z: runs of digits, letters and everything outside ASCII."""
    ascii_only = F.octet_length(text) == F.length(text)
    lower = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))
    return F.regexp_extract_all(lower, F.lit(WORD), F.lit(0))


def _windows(tokens: Column, size: int, of) -> Column:
    """``of(window, place)`` for all windows of ``size`` words; none if there are fewer words."""
    places = F.when(F.size(tokens) >= size, F.sequence(F.lit(0), F.size(tokens) - size)).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: of(F.slice(tokens, i + 1, size), i))


def benchmark_windows(items: DataFrame, size: int, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Distinct windows: ``size``, ``code`` (a hash), ``gram`` (its words), ``items`` (ids that hold it).

    An item with fewer words, but not none, is one window of its own length.
    """
    tokens = items.select(F.col(id_col).alias("item_id"), words(text_of(text_col)).alias("tokens")).filter("size(tokens) > 0")
    n = F.least(F.lit(size), F.size("tokens"))
    grams = tokens.select("item_id", n.alias("size"), F.explode(F.transform(
        F.sequence(F.lit(0), F.size("tokens") - n), lambda i: F.slice("tokens", i + 1, n))).alias("gram"))
    return grams.groupBy("size", F.xxhash64("gram").alias("code"), "gram").agg(F.collect_set("item_id").alias("items"))


def find_overlap(
    docs: DataFrame, items: DataFrame, size: int = 10, id_col: str = "doc_id", text_col: str = "text",
    item_id: str = "item_id", item_text: str = "text", broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Per distinct (id, text): ``id``, ``key``, ``n_words``, ``spans`` (array of (start, n, items), in words).

    The windows of a document are hashed and looked up in a hash set of the benchmark's windows, broadcast if the
    benchmark is below ``broadcast_bytes``. Only matches leave the scan. They are joined to their documents again and
    confirmed word by word.
    """
    grams = cut_lineage(benchmark_windows(items, size, item_id, item_text))
    sizes = sorted(r[0] for r in grams.select("size").distinct().collect())  # at most ``size`` numbers
    held = items.agg(F.coalesce(F.sum(F.octet_length(item_text).cast("long")), F.lit(0))).first()[0]

    def small(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if held <= broadcast_bytes else df

    text = text_of(text_col)
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("key"), text.alias("text"))
    tokens = rows.select("id", "key", words(F.col("text")).alias("tokens"))

    def coded(n: int) -> Column:
        return _windows(F.col("tokens"), n, lambda w, i: F.struct(F.lit(n).alias("size"), i.alias("at"), F.xxhash64(w).alias("code")))

    # one more element per document carries its number of words through the same pass
    none = F.struct(F.lit(0).alias("size"), F.lit(0).alias("at"), F.lit(0).cast("long").alias("code"))
    spread = tokens.select("id", "key", F.size("tokens").alias("n_words"), F.explode(
        F.concat(F.array(none), *map(coded, sizes))).alias("w")).select("id", "key", "n_words", "w.*")
    codes = grams.select("code", F.lit(True).alias("hit")).distinct()
    found = spread.join(small(codes), "code", "left").filter(F.col("hit") | (F.col("size") == 0))
    matched = cut_lineage(found.groupBy("id", "key").agg(
        F.max("n_words").cast("long").alias("n_words"),
        F.collect_set(F.when(F.col("size") > 0, F.struct("size", "at"))).alias("found")))

    # confirm: the words at each place against the words of the window
    suspects = matched.filter("size(found) > 0").select(F.col("id").alias("of"), F.col("key").alias("of_key"), "found")
    same = F.col("id").eqNullSafe(F.col("of")) & (F.col("key") == F.col("of_key"))
    again = rows.join(suspects, same).select("id", "key", words(F.col("text")).alias("tokens"), "found")
    places = again.select("id", "key", F.explode(F.transform("found", lambda f: F.struct(
        f["size"].alias("n"), f["at"].alias("start"), F.slice("tokens", f["at"] + 1, f["size"]).alias("gram")))).alias("w")).select("id", "key", "w.*")
    spans = places.join(small(grams.select("gram", "items")), "gram").groupBy(F.col("id").alias("of"), F.col("key").alias("of_key")).agg(
        F.collect_set(F.struct("start", "n", "items")).alias("spans"))
    empty = F.array().cast(spans.schema["spans"].dataType)
    return matched.join(spans, same, "left").select("id", "key", "n_words", F.coalesce("spans", empty).alias("spans"))


def overlap_report(docs: DataFrame, items: DataFrame, size: int = 10, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Per row: ``doc_id``, ``n_words``, ``n_hit`` (words inside a matching window), ``n_items``, ``items_sha256``, ``contaminated``.

    Null and empty texts have no words and no hits, as have null and empty items. Very long texts are searched whole.
    Repeated rows each get the result of their text. A window held by many items or documents is one row of the hash set
    and leaves the scan once per place. No rows give no rows; an empty benchmark hits nothing. Other columns are not read.
    """
    result = find_overlap(docs, items, size, id_col, text_col, **options)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_of(text_col)).alias("text_key"))
    hit = F.array_distinct(F.flatten(F.transform("spans", lambda s: F.sequence(s["start"], s["start"] + s["n"] - 1))))
    ids = F.array_sort(F.array_distinct(F.flatten(F.transform("spans", lambda s: s["items"].cast("array<string>")))))
    counted = result.select("id", "key", "n_words", F.size(hit).cast("long").alias("n_hit"), ids.alias("ids"))
    return rows.join(counted, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_key") == F.col("key"))).select(
        "doc_id", "n_words", "n_hit", F.size("ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("ids", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def remove_contaminated(docs: DataFrame, items: DataFrame, size: int = 10, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the rows whose text holds a window of a benchmark item."""
    bad = find_overlap(docs, items, size, id_col, text_col, **options).filter("size(spans) > 0").select(
        F.col("id").alias("__of"), F.col("key").alias("__of_key"))
    key = F.xxhash64(text_of(text_col))
    return docs.join(bad, F.col(id_col).eqNullSafe(F.col("__of")) & (key == F.col("__of_key")), "left_anti")
