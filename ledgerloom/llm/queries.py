"""The queries of the numbered operators, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .decontam import overlap_report
from .hnsw import nearest
from .licences import licence_report
from .merkle import manifest, tampered_fifth
from .neardup import near_duplicates
from .packing import pack
from .pii import pii_report
from .quality import score_quality
from .repair import damaged, repair
from .sharding import byte_shards
from .substrings import remove_repeats
from .tables import read
from .topk import search
from .toxicity import score_toxicity


def op1_pack(spark: SparkSession, root: str) -> DataFrame:
    return pack(read(spark, root, "documents"))


def op2_nearest(spark: SparkSession, root: str) -> DataFrame:
    return nearest(read(spark, root, "embeddings"))


def op3_substrings(spark: SparkSession, root: str) -> DataFrame:
    return remove_repeats(read(spark, root, "documents")).drop("kept")


def op4_neardup(spark: SparkSession, root: str) -> DataFrame:
    return near_duplicates(read(spark, root, "documents"), shingle=3, percent=85).drop("text_key")


def op5_pii(spark: SparkSession, root: str) -> DataFrame:
    return pii_report(read(spark, root, "documents"))


def op6_decontam(spark: SparkSession, root: str) -> DataFrame:
    return overlap_report(read(spark, root, "documents"), read(spark, root, "benchmark"))


def op7_licences(spark: SparkSession, root: str) -> DataFrame:
    return licence_report(read(spark, root, "documents")).drop("n_candidates", "reserved")


def op8_toxicity(spark: SparkSession, root: str) -> DataFrame:
    return score_toxicity(read(spark, root, "documents"), read(spark, root, "labels"))


def op9_quality(spark: SparkSession, root: str) -> DataFrame:
    return score_quality(read(spark, root, "documents"), read(spark, root, "labels"))


def op10_shards(spark: SparkSession, root: str) -> DataFrame:
    return byte_shards(read(spark, root, "documents"))


def op11_topk(spark: SparkSession, root: str) -> DataFrame:
    return search(read(spark, root, "embeddings"))


def op12_merkle(spark: SparkSession, root: str) -> DataFrame:
    return manifest(read(spark, root, "documents"), tamper=tampered_fifth())


def op13_repair(spark: SparkSession, root: str) -> DataFrame:
    return repair(damaged(read(spark, root, "conversations")))


QUERIES = {
    "op1_pack": op1_pack,
    "op2_nearest": op2_nearest,
    "op3_substrings": op3_substrings,
    "op4_neardup": op4_neardup,
    "op5_pii": op5_pii,
    "op6_decontam": op6_decontam,
    "op7_licences": op7_licences,
    "op8_toxicity": op8_toxicity,
    "op9_quality": op9_quality,
    "op10_shards": op10_shards,
    "op11_topk": op11_topk,
    "op12_merkle": op12_merkle,
    "op13_repair": op13_repair,
}

#: Words of a text as the contract of operator 6 takes them.
_WORDS = r"regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"



def _crc_table() -> list[int]:
    """The remainders of all bytes for the reflected polynomial of crc32."""
    out = []
    for c in range(256):
        for _ in range(8):
            c = (c >> 1) ^ (0xEDB88320 if c & 1 else 0)
        out.append(c)
    return out


#: crc32 of a text's UTF-8 bytes, byte by byte from their hexadecimal form.
_CRC32 = (
    "xor(list_reduce([CAST('0x' || hex(encode({0}))[2 * i + 1:2 * i + 2] AS BIGINT) FOR i IN range(strlen({0}))], "
    f"lambda c, b: xor(c >> 8, {_crc_table()}[CAST(xor(c & 255, b) AS INTEGER) + 1]), 4294967295), 4294967295)"
)

#: Enough levels for 16**5 leaves of a source; one that is done goes on as it is.
_LEVELS = 5


def _tree_sql(tree: str, levels: int = _LEVELS) -> tuple[str, str]:
    """Levels of the trees in table ``{tree}0`` (grp, i, h), and what joins the siblings ``s`` of a leaf up to the root.

    A tree that has come down to one node stays so. ``{tree}{k}`` holds the nodes, ``{tree}s{k}`` the others of each node's run.
    """
    steps, proof = [], []
    for k in range(levels):
        steps.append(f"""
{tree}n{k} AS (SELECT grp, count(*) AS n FROM {tree}{k} GROUP BY grp),
{tree}r{k} AS (SELECT grp, i // 16 AS up, list({{'i': i, 'h': h}} ORDER BY i) AS run, any_value(n) AS n FROM {tree}{k} JOIN {tree}n{k} USING (grp) GROUP BY ALL),
{tree}{k + 1} AS (SELECT grp, up AS i, CASE WHEN n = 1 THEN run[1].h ELSE sha256(array_to_string(list_transform(run, lambda x: x.h), '')) END AS h FROM {tree}r{k})""")
        proof.append(f"array_to_string(list_transform(list_filter({tree}r{k}.run, lambda x: x.i <> {{0}} // {16 ** k}), lambda x: x.h), '')")
    return ",".join(steps), " || ".join(proof)


def _fold_sql(tree: str, leaf: str, at: str, levels: int = _LEVELS) -> str:
    """The root of the tree if the leaf at a place were another."""
    for k in range(levels):
        before = f"array_to_string(list_transform(list_filter({tree}r{k}.run, lambda x: x.i < {at} // {16 ** k}), lambda x: x.h), '')"
        behind = f"array_to_string(list_transform(list_filter({tree}r{k}.run, lambda x: x.i > {at} // {16 ** k}), lambda x: x.h), '')"
        leaf = f"CASE WHEN {tree}r{k}.n = 1 THEN {leaf} ELSE sha256({before} || {leaf} || {behind}) END"
    return leaf


def _leaf_sql(text: str) -> str:
    values = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text]
    return "sha256(" + " || ".join(f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in values) + ")"


def _manifest_sql() -> str:
    inner, inner_proof = _tree_sql("t")
    outer, outer_proof = _tree_sql("u", 3)
    up = lambda tree, at, levels: " ".join(f"JOIN {tree}r{k} ON {tree}r{k}.grp = {at[0]} AND {tree}r{k}.up = {at[1]} // {16 ** (k + 1)}" for k in range(levels))
    return f"""
WITH leaves AS (
    SELECT doc_id, dense_rank() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS grp, {_leaf_sql("text")} AS leaf,
           CASE WHEN {_CRC32.format("CAST(doc_id AS VARCHAR)")} % 5 = 0
                THEN {_leaf_sql("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS tampered
    FROM documents
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM leaves
), t0 AS (SELECT grp, i, leaf AS h FROM placed), {inner},
u0 AS (SELECT 0 AS grp, grp AS i, h FROM t{_LEVELS}), {outer},
inside AS (
    SELECT doc_id, placed.grp, leaf, {inner_proof.format("placed.i")} AS proof, {_fold_sql("t", "coalesce(tampered, leaf)", "placed.i")} AS folded
    FROM placed {up("t", ("placed.grp", "placed.i"), _LEVELS)}
), whole AS (
    SELECT doc_id, leaf, t{_LEVELS}.h AS subroot, u3.h AS root, sha256(proof || {outer_proof.format("inside.grp")}) AS proof_sha256,
           {_fold_sql("u", "folded", "inside.grp", 3)} AS folded_root
    FROM inside JOIN t{_LEVELS} ON t{_LEVELS}.grp = inside.grp CROSS JOIN u3 {up("u", ("0", "inside.grp"), 3)}
)
SELECT *, folded_root = root AS verified FROM whole
"""


def _moves_sql() -> str:
    """Ways over one row: what stood last, audit, cost, inserted lines, edit, letter kept or given, its role, what stands last then."""
    roles, legal = {"s": "system", "u": "user", "a": "assistant"}, {("", "s"), ("", "u"), ("s", "u"), ("u", "a"), ("a", "u")}
    rows = []
    for last in ("", "s", "u", "a"):
        after, lines = last, []
        for n in range(3):  # insertions before the edit
            said = "[" + ", ".join(f"'{x}:'" for x in lines) + "]"
            ways = [("D", "", after, 2)] + [("K", x, x, 0) for x in "sua" if (after, x) in legal] + [("R", x, x, 1) for x in "ua" if (after, x) in legal]
            rows += [f"('{last}', '{'I' * n + edit}', {5 * n + cost}, {said}::VARCHAR[], '{edit}', '{x}', '{roles.get(x, '')}', '{to}')" for edit, x, to, cost in ways]
            after = "a" if after == "u" else "u"
            lines.append(roles[after])
    return ", ".join(rows)


_REPAIR = rf"""
WITH RECURSIVE said AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name
    FROM conversations
), harm AS (
    SELECT conv_id, turn, role, text, {_CRC32.format("name")} % 20 AS kind FROM said
), harmed AS (
    SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
           CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(range(CASE kind WHEN 3 THEN 2 ELSE 1 END)) AS copy
    FROM harm WHERE kind <> 0
), numbered AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i FROM harmed
), judged AS (
    SELECT *, CASE WHEN NOT regexp_matches(text, '[^ 	-
]') THEN 'blank'
                   WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                   WHEN regexp_extract(text, '([^ 	-
])[ 	-
]*$', 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
           lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair
    FROM numbered
), counts AS (
    SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
           count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
    FROM judged GROUP BY conv_id
), moves(last, sign, cost, lines, edit, letter, given, next) AS (VALUES {_moves_sql()}),
paths AS (
    SELECT DISTINCT conv_id, 0 AS i, '' AS last, 0 AS cost, '' AS audit, []::VARCHAR[] AS lines FROM conversations
    UNION ALL
    SELECT p.conv_id, p.i + 1 AS i, m.next AS last, p.cost + m.cost + CASE WHEN m.edit <> 'D' AND j.fault = 'truncated' THEN 5 ELSE 0 END AS cost,
           p.audit || m.sign AS audit, p.lines || m.lines || CASE m.edit WHEN 'D' THEN [] WHEN 'K' THEN [j.role || ':' || j.text] ELSE [m.given || ':' || j.text] END AS lines
    FROM paths p JOIN judged j ON j.conv_id IS NOT DISTINCT FROM p.conv_id AND j.i = p.i + 1
    JOIN moves m ON m.last = p.last AND (m.edit = 'D' OR j.fault NOT IN ('blank', 'duplicate') AND (m.edit = 'R' OR m.letter = left(j.role, 1)))
    QUALIFY row_number() OVER (PARTITION BY p.conv_id, m.next
        ORDER BY p.cost + m.cost + CASE WHEN m.edit <> 'D' AND j.fault = 'truncated' THEN 5 ELSE 0 END, p.audit || m.sign) = 1
), ends(last, sign, more, added) AS (VALUES ('', '', 0, []::VARCHAR[]), ('s', 'II', 10, ['user:', 'assistant:']), ('u', 'I', 5, ['assistant:']), ('a', '', 0, [])),
ended AS (
    SELECT p.conv_id, p.cost + e.more AS cost, p.audit || e.sign AS audit, sha256(array_to_string(p.lines || e.added, chr(10))) AS repaired_sha256, c.* EXCLUDE (conv_id)
    FROM paths p JOIN ends e USING (last) LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM p.conv_id
    WHERE p.i = coalesce(c.n, 0) QUALIFY row_number() OVER (PARTITION BY p.conv_id ORDER BY p.cost + e.more, p.audit || e.sign) = 1
)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, CAST(cost AS BIGINT) AS cost, audit, repaired_sha256
FROM ended
"""

ORACLES = {
    # a line that is a notice word for word, apart from case and signs
    "op7_licences": """
WITH notices(name, said) AS (VALUES
    ('MIT', 'released under the mit license'), ('Apache-2.0', 'licensed under the apache license version 2.0'),
    ('GPL-3.0', 'this work is licensed under the gnu general public license version 3'), ('CC-BY-NC-4.0', 'licensed under cc by-nc 4.0')
), lines AS (
    SELECT doc_id, array_to_string(regexp_extract_all(lower(unnest(string_split(coalesce(text, ''), chr(10)))), '[\\p{L}\\p{N}]+(?:[.-][\\p{L}\\p{N}]+)*'), ' ') AS said
    FROM documents
), found AS (
    SELECT doc_id, count(DISTINCT name) AS n, string_agg(DISTINCT name, ',' ORDER BY name) AS names
    FROM lines JOIN notices ON contains(' ' || lines.said || ' ', ' ' || notices.said || ' ') GROUP BY doc_id
)
SELECT doc_id, coalesce(n, 0) AS n_licences, coalesce(names, '') AS licences FROM documents LEFT JOIN found USING (doc_id)
""",
    "op4_neardup": r"""
WITH RECURSIVE text_words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + least(3, len(w)) - 1], ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - least(3, len(w)) + 2)) AS i FROM text_words WHERE len(w) > 0)
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
    SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * common >= 85 * (p.n + q.n - common)
), reached AS (
    SELECT doc_id AS x, doc_id AS y FROM documents
    UNION
    SELECT r.x, l.y FROM reached r JOIN links l ON l.x = r.y
)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d LEFT JOIN sizes USING (doc_id) JOIN (SELECT x, min(y) AS component_id FROM reached GROUP BY x) c ON c.x = d.doc_id
""",
    "op6_decontam": f"""
WITH text_words AS (
    SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents
), item_words AS (
    SELECT item_id, {_WORDS.format("coalesce(text, '')")} AS w FROM benchmark
), item_grams AS (
    SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS gram
    FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM item_words WHERE len(w) > 0)
), sizes AS (
    SELECT DISTINCT n FROM item_grams
), text_grams AS (
    SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS gram
    FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM text_words CROSS JOIN sizes WHERE len(w) >= n)
), hits AS (
    SELECT doc_id, i, n, item_id FROM text_grams JOIN item_grams USING (n, gram)
), covered AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id
), listed AS (
    SELECT doc_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS name FROM hits) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM text_words LEFT JOIN covered USING (doc_id) LEFT JOIN listed USING (doc_id)
""",
    # sizes, order and running sums in one pass over the whole table
    "op10_shards": f"""
WITH sized AS (
    SELECT doc_id, CAST(strlen(coalesce(text, '')) + 16 AS BIGINT) AS size, coalesce(text, '') AS body FROM documents
), summed AS (
    SELECT doc_id, size, body,
           sum(size) OVER (ORDER BY doc_id ROWS UNBOUNDED PRECEDING) - size AS before,
           sum(size) OVER () AS total
    FROM sized
), dealt AS (
    SELECT doc_id, size, body, CAST(least(39, (2 * before + size) * 40 // (2 * total)) AS INTEGER) AS shard FROM summed
)
SELECT doc_id, size, {_CRC32.format("body")} AS text_crc32, 'bytes' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM dealt
""",
    "op11_topk": """
WITH held AS (
    SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS w
    FROM embeddings
    WHERE vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.w, c.w) AS BIGINT) AS score
    FROM held q JOIN held c ON q.vec_id <> c.vec_id AND q.vec_id % 20 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored QUALIFY rank <= 20
""",
    "op12_merkle": _manifest_sql(),
    "op13_repair": _REPAIR,
}
