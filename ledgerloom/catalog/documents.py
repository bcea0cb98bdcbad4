"""Documents and text."""

from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import documents as X
from ..sources import io as IO
from .registry import Registry

REG = Registry()

# Words that mark a language or a document type.
LANGUAGE_WORDS = {
    "en": ("the", "of", "and", "that", "was"), "fr": ("le", "une", "que", "pour", "dans"),
    "de": ("der", "und", "ein", "nicht", "von"), "es": ("el", "los", "por", "para", "una"),
}
TYPE_WORDS = {"SDS": ("safety", "hazard", "flash", "protective"), "contract": ("contract", "agreement", "supplier", "termination")}

CONTRACT_FIELDS = {
    "supplier": r"Supplier: ([^\n]+)",
    "annual_spend_eur": r"Annual spend: ([^\n]+)",
    "payment_terms_days": r"Payment terms: ([^\n]+)",
    "price_escalation_clause": r"Price escalation: ([^\n]+)",
    "termination_notice_days": r"Termination notice: ([^\n]+)",
}
SHEET_FIELDS = {
    "product": r"Product: ([^\n]+)", "hazard_class": r"Hazard class: ([0-9]+)", "flash_point_c": r"Flash point: ([0-9]+) C",
    "storage_temp": r"Storage: keep below ([0-9]+) C", "ppe": r"Protective equipment: ([^\n]+)",
}


@REG.add("doc_parse")
def _(star):
    parsed = X.doc_parse(star.heavy("pages"))
    return parsed.select("page_id", F.size("elements").cast("bigint").alias("elements"),
                         F.length("parsed_text").cast("bigint").alias("parsed_chars"), "parsed_text")


WORDS_SQL = r"list_filter(string_split_regex(lower(text), '[\s.,;:!?]+'), lambda w: w <> '')"


def _hits(words):
    listed = ", ".join(f"'{w}'" for w in words)
    return f"len(list_filter(ws, lambda w: w IN ({listed})))"


@REG.add("doc_classify", sql=f"""
    SELECT doc_id, lang, CASE WHEN best = 0 THEN NULL WHEN en = best THEN 'en' WHEN fr = best THEN 'fr' WHEN de = best THEN 'de' ELSE 'es' END AS doc_label,
           CAST(best AS BIGINT) AS label_score
    FROM (SELECT *, GREATEST(en, fr, de, es) AS best FROM (
        SELECT doc_id, lang, {", ".join(f"{_hits(w)} AS {k}" for k, w in LANGUAGE_WORDS.items())}
        FROM (SELECT doc_id, lang, {WORDS_SQL} AS ws FROM documents) t) s) b""")
def _(star):
    return X.doc_classify(star.heavy("documents").select("doc_id", "lang", "text"), LANGUAGE_WORDS).drop("text")


def _typed_docs(star):
    return X.doc_classify(star.contract_docs().unionByName(star.sheet_docs()), TYPE_WORDS)


@REG.add("doc_classify_types", "contract_docs sheet_docs", f"""
    SELECT doc_type_guess, CASE WHEN a = 0 AND b = 0 THEN NULL WHEN a >= b THEN 'SDS' ELSE 'contract' END AS doc_label, COUNT(*) AS n
    FROM (SELECT doc_type_guess, {_hits(TYPE_WORDS["SDS"])} AS a, {_hits(TYPE_WORDS["contract"])} AS b
          FROM (SELECT doc_type_guess, {WORDS_SQL} AS ws FROM (SELECT * FROM contract_docs UNION ALL SELECT * FROM sheet_docs) u) t) s GROUP BY 1, 2""")
def _(star):
    return _typed_docs(star).groupBy("doc_type_guess", "doc_label").agg(F.count(F.lit(1)).alias("n"))


def _rx(fields):
    return ", ".join(rf"NULLIF(trim(regexp_extract(text, '{p}', 1)), '') AS {n}" for n, p in fields.items())


CONTRACTS_SQL = f"""raw AS (SELECT doc_id, {_rx(CONTRACT_FIELDS)} FROM contract_docs),
  contracts AS (
    SELECT doc_id, supplier, TRY_CAST(regexp_replace(annual_spend_eur, '[^0-9]', '', 'g') AS BIGINT) AS annual_spend_eur,
           TRY_CAST(regexp_replace(payment_terms_days, '[^0-9]', '', 'g') AS BIGINT) AS payment_terms_days,
           lower(price_escalation_clause) IN ('true', 'yes') AS price_escalation_clause,
           TRY_CAST(regexp_replace(termination_notice_days, '[^0-9]', '', 'g') AS BIGINT) AS termination_notice_days FROM raw),
  flagged AS (SELECT *, payment_terms_days > 60 AND annual_spend_eur > 1000000 AS non_standard_flag FROM contracts)"""


def _contracts(star):
    rows = X.doc_extract(_typed_docs(star), CONTRACT_FIELDS, only=F.col("doc_label") == "contract")
    typed = rows.select(
        "doc_id", "fields.supplier", C.digits_only("fields.annual_spend_eur").alias("annual_spend_eur"),
        C.digits_only("fields.payment_terms_days").alias("payment_terms_days"),
        C.yes_bool("fields.price_escalation_clause").alias("price_escalation_clause"),
        C.digits_only("fields.termination_notice_days").alias("termination_notice_days"))
    return typed.withColumn("non_standard_flag", C.non_standard_flag("payment_terms_days", "annual_spend_eur"))


@REG.add("doc_extract", "contract_docs", "SELECT * FROM flagged", extra=CONTRACTS_SQL)
def _(star):
    return _contracts(star)


@REG.add("doc_extract_sheets", "sheet_docs", f"SELECT doc_id, {_rx(SHEET_FIELDS)} FROM sheet_docs")
def _(star):
    return X.doc_extract(_typed_docs(star), SHEET_FIELDS, only=F.col("doc_label") == "SDS").select("doc_id", "fields.*")


PII_FIELDS = {"email": f"({C.EMAIL_PATTERN})", "phone": f"({C.PHONE_PATTERN})", "address": r"\b([0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3})\b"}


def _all_hits(pattern: str) -> str:
    return f"NULLIF(array_to_string(regexp_extract_all(text, '{pattern}', 1), ' '), '')"


@REG.add("doc_extract_contacts", sql="SELECT doc_id, " + ", ".join(f"{_all_hits(p)} AS {n}" for n, p in PII_FIELDS.items()) + " FROM documents")
def _(star):
    def hits(pattern: str):
        return F.nullif(F.array_join(F.regexp_extract_all("text", F.lit(pattern), F.lit(1)), " "), F.lit(""))

    return star.heavy("documents").select("doc_id", *[hits(p).alias(n) for n, p in PII_FIELDS.items()])


@REG.add("fuse_struct_unstruct", "contract_docs", """
    SELECT supplier, annual_spend_eur, payment_terms_days, termination_notice_days FROM flagged
    WHERE payment_terms_days > 60 AND annual_spend_eur > 1000000""", extra=CONTRACTS_SQL)
def _(star):
    return _contracts(star).filter("non_standard_flag").select(
        "supplier", "annual_spend_eur", "payment_terms_days", "termination_notice_days").orderBy(
        F.desc("annual_spend_eur"), "supplier")


@REG.add("extract_score", sql=f"""
    SELECT field, COUNT(*) AS n, COUNT(*) FILTER (hit) AS n_match, ROUND(CAST(COUNT(*) FILTER (hit) AS DOUBLE) / COUNT(*), 4) AS accuracy
    FROM (SELECT 'lang' AS field, COALESCE(lang = CASE WHEN best = 0 THEN NULL WHEN en = best THEN 'en' WHEN fr = best THEN 'fr' WHEN de = best THEN 'de' ELSE 'es' END, FALSE) AS hit
          FROM (SELECT *, GREATEST(en, fr, de, es) AS best FROM (SELECT doc_id, lang, {", ".join(f"{_hits(w)} AS {k}" for k, w in LANGUAGE_WORDS.items())}
                FROM (SELECT doc_id, lang, {WORDS_SQL} AS ws FROM documents) t) s) b
          UNION ALL SELECT 'n_chars', length(text) = n_chars FROM documents) h GROUP BY 1""")
def _(star):
    docs = star.heavy("documents")
    labelled = X.doc_classify(docs.select("doc_id", "text"), LANGUAGE_WORDS)
    found = labelled.select("doc_id", F.struct(F.col("doc_label").alias("lang"), F.length("text").alias("n_chars")).alias("fields"))
    truth = docs.select("doc_id", F.struct("lang", "n_chars").alias("fields"))
    names = ("lang", "n_chars")
    return X.extract_score(X.field_rows(found, "doc_id", names), X.field_rows(truth, "doc_id", names))


@REG.add("clause_deviation", "contract_docs", """
    SELECT doc_id, field, term, CASE WHEN term IS NULL THEN 'not_found' WHEN term < lo OR term > hi THEN 'deviates' ELSE 'standard' END AS verdict
    FROM (SELECT doc_id, 'payment_terms_days' AS field, payment_terms_days AS term, 0 AS lo, 60 AS hi FROM flagged
          UNION ALL SELECT doc_id, 'termination_notice_days', termination_notice_days, 30, 90 FROM flagged) c""", extra=CONTRACTS_SQL)
def _(star):
    standard = IO.read_rows(star.spark, (("payment_terms_days", 0, 60), ("termination_notice_days", 30, 90)),
                            "field string, min_value bigint, max_value bigint")
    rows = _contracts(star)
    names = ("payment_terms_days", "termination_notice_days")
    found = X.field_rows(rows.select("doc_id", F.struct(*names).alias("fields")), "doc_id", names)
    return X.clause_deviation(found, standard)


CHUNKS_SQL = """chunks AS (
    SELECT CAST(doc_id AS VARCHAR) || '_' || CASE WHEN length(CAST(seq AS VARCHAR)) >= 6 THEN CAST(seq AS VARCHAR) ELSE lpad(CAST(seq AS VARCHAR), 6, '0') END AS chunk_id,
           doc_id, seq, substr(text, seq * 1600 + 1, 2000) AS chunk_text
    FROM (SELECT doc_id, text, unnest(range(0, GREATEST(CAST(CEIL(length(text) / 1600.0) AS BIGINT), 1))) AS seq FROM documents) w
    WHERE length(substr(text, seq * 1600 + 1, 2000)) > 0)"""


@REG.add("doc_chunk", sql="SELECT chunk_id, doc_id, seq, chunk_text FROM chunks", extra=CHUNKS_SQL)
def _(star):
    return X.doc_chunk(star.heavy("documents"))


@REG.add("agg_text_stats", sql="""
    SELECT COUNT(*) AS n_chunks, COUNT(DISTINCT doc_id) AS n_docs, ROUND(AVG(length(chunk_text))) AS avg_chunk_chars,
           MIN(length(chunk_text)) AS min_chars, MAX(length(chunk_text)) AS max_chars,
           CAST(CASE WHEN COUNT(*) > 0 THEN 64 END AS BIGINT) AS min_dim, CAST(CASE WHEN COUNT(*) > 0 THEN 64 END AS BIGINT) AS max_dim FROM chunks""", extra=CHUNKS_SQL)
def _(star):
    size, dim = F.length("chunk_text").cast("bigint"), F.size("embedding").cast("bigint")
    return X.doc_embed(X.doc_chunk(star.heavy("documents"))).agg(
        F.count(F.lit(1)).alias("n_chunks"), F.countDistinct("doc_id").alias("n_docs"),
        F.round(F.avg(size), 0).alias("avg_chunk_chars"), F.min(size).alias("min_chars"), F.max(size).alias("max_chars"),
        F.min(dim).alias("min_dim"), F.max(dim).alias("max_dim"))


@REG.add("doc_embed")
def _(star):
    embedded = X.doc_embed(X.doc_chunk(star.heavy("documents")))
    return embedded.select("chunk_id", "doc_id", F.size("embedding").cast("bigint").alias("dim"), "embedding")


@REG.add("text_mask", sql=f"""
    SELECT doc_id, regexp_replace(regexp_replace(text, '{C.EMAIL_PATTERN}', '[EMAIL]', 'g'), '{C.PHONE_PATTERN}', '[PHONE]', 'g') AS masked FROM documents""")
def _(star):
    return star.heavy("documents").select("doc_id", C.mask_text("text").alias("masked"))


@REG.add("text_summarize", sql=r"""
    WITH sentences AS (
        SELECT doc_id, n, [w FOR w IN regexp_split_to_array(s, '\s+') IF w <> ''] AS words
        FROM (SELECT doc_id, unnest(parts) AS s, unnest(range(len(parts))) AS n FROM (SELECT doc_id, regexp_split_to_array(text, '[.!?]+') AS parts FROM documents))
    ), terms AS (
        SELECT doc_id, n, unnest(words) AS w FROM sentences WHERE len(words) > 0
    ), weights AS (
        SELECT doc_id, w, COUNT(*) AS weight FROM terms WHERE length(w) > 3 GROUP BY ALL
    ), scored AS (
        SELECT doc_id, n, COALESCE(SUM(weight), 0) AS score, COUNT(*) AS size FROM terms LEFT JOIN weights USING (doc_id, w) GROUP BY ALL
    ), best AS (
        SELECT doc_id, n FROM scored QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score * 1000 // greatest(size, 5) DESC, n) = 1
    )
    SELECT d.doc_id, array_to_string(words[1:20], ' ') AS summary FROM documents d LEFT JOIN best USING (doc_id) LEFT JOIN sentences USING (doc_id, n)""")
def _(star):
    return X.text_summarize(star.heavy("documents"), 20)


@REG.add("ai_map", sql="""
    SELECT p_partkey, 'Describe ' || p_name || ' of ' || p_brand || '.' AS prompt, 'echo: Describe ' || p_name || ' of ' || p_brand || '.' AS output FROM part""")
def _(star):
    prompt = F.concat(F.lit("Describe "), F.col("p_name"), F.lit(" of "), F.col("p_brand"), F.lit("."))
    return X.ai_map(star.table("part"), prompt, ("p_partkey",))


@REG.add("template_match", sql="""
    SELECT event_id, event_type AS category, CASE event_type WHEN 'error' THEN 'We are looking into the failure.' WHEN 'purchase' THEN 'Thank you for the order.'
           ELSE 'no matching template' END AS template FROM events""")
def _(star):
    templates = IO.read_rows(star.spark, (("error", "We are looking into the failure."), ("purchase", "Thank you for the order.")),
                             "category string, template string")
    return X.template_match(star.table("events").select("event_id", F.col("event_type").alias("category")), templates)
