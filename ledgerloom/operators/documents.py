"""Documents: parse, classify, extract, chunk, embed, score, mask."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator, Mapping, Sequence
from html.parser import HTMLParser

import pandas as pd
import pyarrow as pa
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import chunk_id
from ..session import cut_lineage

_KINDS = {"title": "title", "h1": "heading", "h2": "heading", "h3": "heading", "h4": "heading", "p": "paragraph",
          "li": "list_item", "td": "cell", "th": "cell", "div": "text", "blockquote": "quote", "pre": "code"}
_SILENT = {"script", "style"}
#: As Spark's regular expressions read them: \\s is ASCII only.
_STOPS, _SPACES = re.compile(r"[.!?]+"), re.compile(r"[ \t\n\x0b\f\r]+")


class _Elements(HTMLParser):
    """Text of a page as ordered elements; a block tag starts a new element."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.found: list[tuple[str, str]] = []
        self._kind, self._text, self._muted = "text", [], 0

    def _flush(self) -> None:
        text = " ".join("".join(self._text).split())
        if text:
            self.found.append((self._kind, text))
        self._text = []

    def handle_starttag(self, tag, attrs):
        if tag in _SILENT:
            self._muted += 1
        elif tag in _KINDS:
            self._flush()
            self._kind = _KINDS[tag]
        elif tag == "br":
            self._text.append(" ")

    def handle_endtag(self, tag):
        if tag in _SILENT:
            self._muted = max(0, self._muted - 1)
        elif tag in _KINDS:
            self._flush()
            self._kind = "text"

    def handle_data(self, data):
        if not self._muted:
            self._text.append(data)

    def elements(self, html: str) -> list[dict]:
        self.feed(html or "")
        self.close()
        self._flush()
        return [{"id": i, "type": k, "content": t} for i, (k, t) in enumerate(self.found)]


def doc_parse(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """Ordered elements and the newline-joined text of each page. Pages are independent of each other."""
    key_type = dict(pages.dtypes)[key]

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({key: batch[key], "elements": [_Elements().elements(h) for h in batch[html]]})

    schema = f"{key} {key_type}, elements array<struct<id: bigint, type: string, content: string>>"
    parsed = pages.select(key, html).mapInPandas(parse, schema)
    return parsed.withColumn("parsed_text", F.array_join(F.transform("elements", lambda e: e["content"]), "\n"))


def doc_elements(parsed: DataFrame, key: str = "page_id") -> DataFrame:
    """One row per element."""
    return parsed.select(key, F.inline("elements")).withColumnsRenamed(
        {"id": "element_id", "type": "element_type"}
    )


def words_of(text: Column | str) -> Column:
    return F.filter(F.split(F.lower(text), r"[\s.,;:!?]+"), lambda w: w != "")


def doc_classify(docs: DataFrame, labels: Mapping[str, Sequence[str]], text: str = "text") -> DataFrame:
    """Label whose words occur most often in the whole text; the first label wins a tie, none gives NULL."""
    rows = docs.withColumn("_words", words_of(text))

    def hits(words: Sequence[str]) -> Column:
        return F.size(F.filter("_words", lambda w: w.isin(*words)))

    scores = {label: hits(words) for label, words in labels.items()}
    rows = rows.withColumns({f"_s{i}": s for i, s in enumerate(scores.values())})
    marks = [F.col(f"_s{i}") for i in range(len(scores))]
    best = F.greatest(*marks) if len(marks) > 1 else marks[0]
    label = F.when(best == 0, F.lit(None).cast("string"))
    for name, mark in zip(scores, marks):
        label = label.when(mark == best, name)
    return rows.withColumn("doc_label", label).withColumn("label_score", best.cast("bigint")).drop(
        "_words", *[f"_s{i}" for i in range(len(scores))]
    )


def doc_extract(docs: DataFrame, fields: Mapping[str, str], text: str = "text", only: Column | None = None) -> DataFrame:
    """Named fields from the whole text into the struct ``fields``; a field that is not there is NULL.

    ``fields`` maps a name to a pattern with one group. ``only`` gates the extraction on a label.
    """
    rows = docs if only is None else docs.filter(only)
    found = [F.nullif(F.trim(F.regexp_extract(text, p, 1)), F.lit("")).alias(n) for n, p in fields.items()]
    return rows.withColumn("fields", F.struct(*found))


def field_rows(extracted: DataFrame, key: str, names: Sequence[str]) -> DataFrame:
    """Long form: one row per document and field."""
    pairs = F.array(*[F.struct(F.lit(n).alias("field"), F.col(f"fields.{n}").cast("string").alias("value")) for n in names])
    return extracted.select(key, F.inline(pairs))


def extract_score(found: DataFrame, truth: DataFrame, key: str = "doc_id") -> DataFrame:
    """Accuracy per field against the truth; a field that should be absent counts when it was not found."""
    both = truth.withColumnRenamed("value", "_truth").join(found, [key, "field"], "left")
    hit = F.col("_truth").eqNullSafe(F.col("value"))
    return both.groupBy("field").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(hit).alias("n_match"),
        F.round(F.avg(hit.cast("int")), 4).alias("accuracy"),
    )


def clause_deviation(found: DataFrame, standard: DataFrame, key: str = "doc_id") -> DataFrame:
    """Each clause against the standard terms: standard, deviates or not_found."""
    value = F.col("value").try_cast("bigint")
    verdict = (
        F.when(F.col("value").isNull(), "not_found")
        .when(value.isNull(), "not_found")
        .when((value < F.col("min_value")) | (value > F.col("max_value")), "deviates")
        .otherwise("standard")
    )
    return found.join(standard, "field").select(key, "field", value.alias("term"), verdict.alias("verdict"))


def doc_chunk(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 2000, step: int = 1600,
              carry: Sequence[str] = (), drop_covered_tail: bool = False) -> DataFrame:
    """Overlapping windows over the whole text.

    The windows are cut inside the row before the explode, so the full text is not copied to every
    chunk. The last window may lie inside the one before it; ``drop_covered_tail`` leaves it out.
    """
    n = F.ceil(F.length(text) / F.lit(float(step))).cast("int")
    last = F.greatest(n - 1, F.lit(0))
    if drop_covered_tail:
        covered = F.ceil((F.length(text) - F.lit(size)) / F.lit(float(step))).cast("int")
        last = F.least(last, F.greatest(covered, F.lit(0)))
    windows = F.transform(
        F.sequence(F.lit(0), last),
        lambda i: F.struct(i.cast("bigint").alias("seq"), F.substring(F.col(text), i * step + 1, F.lit(size)).alias("chunk_text")),
    )
    return docs.select(key, *carry, F.inline(windows)).filter(F.length("chunk_text") > 0).select(
        chunk_id(key, "seq").alias("chunk_id"), key, *carry, "seq", "chunk_text"
    )


def doc_embed(chunks: DataFrame, text: str = "chunk_text", dim: int = 64) -> DataFrame:
    """Deterministic stand-in for an embedding model: hashed word counts, scaled to length one."""
    rows = chunks.withColumn("_words", words_of(text))
    hashed = HashingTF(inputCol="_words", outputCol="_tf", numFeatures=dim).transform(rows)
    vector = hashed.withColumn("_v", vector_to_array("_tf"))
    norm = F.sqrt(F.aggregate("_v", F.lit(0.0), lambda a, x: a + x * x))
    unit = F.transform("_v", lambda x: F.coalesce(F.try_divide(x, F.col("_norm")), F.lit(0.0)).cast("float"))
    return vector.withColumn("_norm", norm).withColumn("embedding", unit).drop("_words", "_tf", "_v", "_norm")


def echo_model(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Stub model: answers with the prompt. Replace it with a call to a served model."""
    for batch in batches:
        yield batch.assign(output=["echo: " + p for p in batch["prompt"]])


def ai_map(df: DataFrame, prompt: Column, keys: Sequence[str],
           model: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]] = echo_model) -> DataFrame:
    """Run a prompt over every row. The model gets batches of keys and prompts on the executors."""
    rows = df.select(*keys, prompt.alias("prompt"))
    schema = ", ".join(f"{c} {t}" for c, t in rows.dtypes) + ", output string"
    return rows.mapInPandas(model, schema)


def template_match(tickets: DataFrame, templates: DataFrame, key: str = "category") -> DataFrame:
    """Reply template of the ticket category, or a note that there is none."""
    return tickets.join(templates.select(key, "template"), key, "left").withColumn(
        "template", F.coalesce("template", F.lit("no matching template"))
    )


def _most_telling(text: str, words: int, least: int) -> str | None:
    """The summary of one text; see :func:`text_summarize`."""
    sentences = [[w for w in _SPACES.split(s) if w] for s in _STOPS.split(text)]
    weight = Counter(w for s in sentences for w in s if len(w) > 3)
    best = max(((sum(weight[w] for w in s) * 1000 // max(len(s), least), -n) for n, s in enumerate(sentences) if s), default=None)
    return None if best is None else " ".join(sentences[-best[1]][:words])


def _summaries_by_key(docs: DataFrame, words: int, key: str, text: str, least: int) -> DataFrame:
    """Summaries where rows share a key: their words weigh together, and each row gets the best sentence of every row."""
    parts = docs.select(key, F.posexplode(F.split(text, r"[.!?]+")).alias("_n", "_s"))
    sentences = parts.select(key, "_n", F.filter(F.split("_s", r"\s+"), lambda w: w != "").alias("_words")).filter(F.size("_words") > 0)
    terms = sentences.select(key, "_n", F.explode("_words").alias("_w"))
    weights = terms.filter(F.length("_w") > 3).groupBy(key, "_w").agg(F.count(F.lit(1)).alias("_weight"))
    scored = terms.join(weights, [key, "_w"], "left").groupBy(key, "_n").agg(
        F.coalesce(F.sum("_weight"), F.lit(0)).alias("_sum"), F.count(F.lit(1)).alias("_size"))
    score = F.expr(f"_sum * 1000 div greatest(_size, {least})")
    best = scored.groupBy(key).agg(F.max_by("_n", F.struct(score.alias("s"), (-F.col("_n")).alias("n"))).alias("_n"))
    said = sentences.join(best, [key, "_n"]).select(key, F.array_join(F.slice("_words", 1, words), " ").alias("summary"))
    return docs.select(key).join(said, key, "left")


def text_summarize(docs: DataFrame, words: int, key: str = "doc_id", text: str = "text", least: int = 5) -> DataFrame:
    """The most telling sentence of the whole text, at most ``words`` words of it.

    Words of four letters or more weigh as often as they occur in the text. A sentence scores the weights of its words per
    word, short ones as if they had ``least``; of equal scores the first. A text without words or key has no summary.

    A text alone under its key is read where it lies, without a shuffle; only texts that share a key are brought together.
    """
    shared = cut_lineage(docs.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_rows")).filter("_rows > 1").select(key))
    rows = docs.select(key, text)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            said = [None if t is None else _most_telling(t, words, least) for t in (x.as_py() for x in batch.column(1))]
            yield pa.record_batch([batch.column(0), pa.array(said, pa.string())], [key, "summary"])

    texts = rows.join(shared, key, "left_anti").select(key, F.when(F.col(key).isNotNull(), F.col(text)))
    alone = texts.mapInArrow(read, f"`{key}` {rows.schema[key].dataType.simpleString()}, summary string")
    return alone.unionByName(_summaries_by_key(rows.join(shared, key, "left_semi"), words, key, text, least))
