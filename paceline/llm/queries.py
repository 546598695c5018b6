"""One query per operator, over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from paceline.llm.decontamination import contaminated
from paceline.llm.exact_dedup import exact_dedup
from paceline.llm.hard_negatives import hard_negatives
from paceline.llm.jaccard_join import similarity_groups
from paceline.llm.license_scan import TEMPLATES, license_matches, template_table
from paceline.llm.packing import pack_documents
from paceline.llm.secret_scan import secret_scan
from paceline.llm.sharding import shard_documents
from paceline.llm.suffix_dedup import repeated_passages
from paceline.llm.tool_calls import TURN_TOOLS, calls_of_turns, formatted, linked_calls
from paceline.llm.toxicity import toxicity
from paceline.llm.variants import spelling_variants
from paceline.llm.warc import archived_pages

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan(_table(spark, sf_dir, "documents"))


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(_table(spark, sf_dir, "documents")).drop("bucket", "chain")


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity_groups(_table(spark, sf_dir, "documents"), width=3, threshold=0.9).drop("class_id")


def op5_tool_call_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    tools = spark.createDataFrame(TURN_TOOLS, "tool string, schema string")
    return formatted(linked_calls(*calls_of_turns(_table(spark, sf_dir, "conversations")), tools))


def op6_bwt_passage_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(_table(spark, sf_dir, "documents")).drop("kept")


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_matches(_table(spark, sf_dir, "documents"), template_table(spark))


def public_tokenizer() -> tuple[str, str, str]:
    """Vocabulary file, rank file and pattern of the byte-level BPE that packing counts in."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def op8_differencing_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_table(spark, sf_dir, "documents"), public_tokenizer())


def op10_sentence_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_rendezvous_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(_table(spark, sf_dir, "documents"), [1.0] * 40, grown_by=1.0)


def op11_trie_pair_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(_table(spark, sf_dir, "documents"))


def op12_slot_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)


def op13_warc_normaliser(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived_pages(_table(spark, sf_dir, "pages"))


QUERIES: dict[str, Query] = {
    "op1_secret_scan": op1_secret_scan,
    "op2_benchmark_decontamination": op2_benchmark_decontamination,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_ngram_jaccard_join": op4_ngram_jaccard_join,
    "op5_tool_call_chat": op5_tool_call_chat,
    "op6_bwt_passage_dedup": op6_bwt_passage_dedup,
    "op7_license_scan": op7_license_scan,
    "op8_differencing_packing": op8_differencing_packing,
    "op9_rendezvous_sharding": op9_rendezvous_sharding,
    "op10_sentence_toxicity": op10_sentence_toxicity,
    "op11_trie_pair_variants": op11_trie_pair_variants,
    "op12_slot_hard_negatives": op12_slot_hard_negatives,
    "op13_warc_normaliser": op13_warc_normaliser,
}

_FOLDED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _shingle_sql(words: str, width: int) -> str:
    """The word runs of a list column; a shorter list gives all of its words as one."""
    runs = f"list_transform(range(1, len({words}) - {width - 2}), lambda i: array_to_string({words}[i:i + {width - 1}], ' '))"
    return f"CASE WHEN len({words}) = 0 THEN [] WHEN len({words}) < {width} THEN [array_to_string({words}, ' ')] ELSE {runs} END"


def _decontamination_sql() -> str:
    words = r"regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9\x{80}-\x{10FFFF}]+')"
    return f"""
WITH dw AS (SELECT doc_id, {words} AS w FROM documents), iw AS (SELECT item_id, {words} AS w FROM benchmark),
d AS (SELECT DISTINCT doc_id, unnest({_shingle_sql("w", 5)}) AS s FROM dw), i AS (SELECT DISTINCT item_id, unnest({_shingle_sql("w", 5)}) AS s FROM iw),
q AS (SELECT item_id, count(*) AS item_shingles FROM i GROUP BY 1),
n AS (SELECT doc_id, item_id, count(*) AS shared FROM d JOIN i USING (s) GROUP BY 1, 2)
SELECT doc_id, item_id, item_shingles, shared, shared / item_shingles AS containment FROM n JOIN q USING (item_id)
WHERE 5 * shared >= 4 * item_shingles"""


def _jaccard_sql() -> str:
    words = rf"regexp_extract_all({_FOLDED}, '[^\x20\x09-\x0D]+')"
    return f"""
WITH RECURSIVE w AS (SELECT doc_id, {words} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest({_shingle_sql("w", 3)}) AS s FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
pairs AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM pairs JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * c >= 90 * (x.n + y.n - c)),
reach AS (SELECT doc_id, doc_id AS other FROM documents UNION SELECT reach.doc_id, b FROM reach JOIN links ON a = other)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, min(other) AS component_id
FROM documents d LEFT JOIN n USING (doc_id) JOIN reach USING (doc_id) GROUP BY 1, 2"""


def _license_sql() -> str:
    rows = ", ".join("('{}', '{}')".format(name, text.replace("'", "''")) for name, text in TEMPLATES)
    norm = lambda c: f"trim(regexp_replace(lower({c}), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))"
    pairs = "list_distinct(list_transform(range(1, len(w)), lambda i: concat(w[i], ' ', w[i + 1])))"
    return f"""
WITH t AS (SELECT license, string_split({norm("body")}, ' ') AS w FROM (VALUES {rows}) v(license, body)),
tg AS (SELECT license, {pairs} AS g FROM t),
lines AS (SELECT doc_id, coalesce(text, '') AS text, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
units AS (SELECT doc_id, 0 AS unit, text AS raw FROM lines WHERE len(l) > 1
  UNION ALL SELECT doc_id, unnest(range(1, len(l) + 1)) AS unit, unnest(l) AS raw FROM lines),
uw AS (SELECT doc_id, unit, string_split({norm("raw")}, ' ') AS w FROM units),
ug AS (SELECT doc_id, unit, {pairs} AS g FROM uw WHERE len(w) > 1),
m AS (SELECT doc_id, unit, license, len(ug.g) AS a, 2 * len(list_intersect(ug.g, tg.g)) / (len(ug.g) + len(tg.g)) AS dice FROM ug, tg
  WHERE len(ug.g) <= 1.5 * len(tg.g) AND len(tg.g) <= 1.5 * len(ug.g)),
sentences AS (SELECT doc_id, unit AS line, string_split(regexp_replace(raw, '([.!?;:])[ \t]+', '\\1' || chr(10), 'g'), chr(10)) AS l FROM units WHERE unit > 0),
parts AS (SELECT doc_id, line, unnest(range(1, len(l) + 1)) AS nth, unnest(l) AS raw FROM sentences),
pw AS (SELECT doc_id, line, nth, string_split({norm("raw")}, ' ') AS w FROM parts WHERE {norm("raw")} <> ''),
pn AS (SELECT *, row_number() OVER o AS pos, CAST(sum(len(w)) OVER o AS BIGINT) AS upto, count(*) OVER (PARTITION BY doc_id, line) AS of_line,
  count(*) OVER (PARTITION BY doc_id) AS of_text FROM pw WINDOW o AS (PARTITION BY doc_id ORDER BY line, nth)),
dw AS (SELECT doc_id, flatten(list(w ORDER BY pos)) AS w FROM pn GROUP BY 1),
most AS (SELECT CAST(floor(1.5 * max(len(g)) + 1e-9) AS BIGINT) + 1 AS n FROM tg),
rw AS (SELECT x.doc_id, x.line AS unit, y.line AS last_line, x.pos AS f, y.pos AS l, dw.w[x.upto - len(x.w) + 1 : y.upto] AS w,
  (x.line = y.line AND y.pos - x.pos + 1 = x.of_line) OR y.pos - x.pos + 1 = x.of_text AS whole
  FROM pn x JOIN pn y ON y.doc_id = x.doc_id AND y.pos >= x.pos AND y.upto - x.upto + len(x.w) <= (SELECT n FROM most) JOIN dw ON dw.doc_id = x.doc_id),
rg AS (SELECT doc_id, unit, last_line, f, l, whole, {pairs} AS g FROM rw WHERE len(w) > 1),
rm AS (SELECT doc_id, unit, last_line, f, l, whole, license, max(2 * len(list_intersect(rg.g, tg.g)) / (len(rg.g) + len(tg.g))) AS dice, max(len(rg.g)) AS a FROM rg, tg
  WHERE len(rg.g) <= 1.5 * len(tg.g) AND len(tg.g) <= 1.5 * len(rg.g) GROUP BY ALL HAVING dice >= 0.8),
runs AS (SELECT * FROM rm r WHERE NOT whole AND NOT EXISTS (SELECT 1 FROM rm o WHERE o.doc_id = r.doc_id AND o.license = r.license AND o.f <= r.l AND o.l >= r.f
  AND (o.dice > r.dice OR (o.dice = r.dice AND (o.l - o.f < r.l - r.f OR (o.l - o.f = r.l - r.f AND o.f < r.f))))))
SELECT doc_id, CAST(unit AS INT) AS unit, license, max(dice) AS dice, CAST(max(a) AS INT) AS n_bigrams, CAST(NULL AS INT) AS last_line,
  CAST(NULL AS INT) AS first_part, CAST(NULL AS INT) AS last_part FROM m WHERE dice >= 0.8 GROUP BY 1, 2, 3
UNION ALL SELECT doc_id, CAST(unit AS INT), license, dice, CAST(a AS INT), CAST(last_line AS INT), CAST(f AS INT), CAST(l AS INT) FROM runs"""


#: Training, hashing of placements, tokenising and byte runs have no SQL form; tests hold them against brute force.
ORACLES: dict[str, str] = {
    "op2_benchmark_decontamination": _decontamination_sql(),
    "op3_exact_dedup": f"""
WITH d AS (SELECT doc_id, {_FOLDED} AS t FROM documents), g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY 1)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM d JOIN g USING (t)""",
    "op4_ngram_jaccard_join": _jaccard_sql(),
    "op7_license_scan": _license_sql(),
    "op12_slot_hard_negatives": """
WITH r AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, a.label AS mine, b.vec_id, b.label, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM r a JOIN r b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT * FROM s WHERE label = mine QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id, CAST(row_number() OVER w AS INT) AS rank, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND s.label <> s.mine AND 100 * s.score BETWEEN 30 * p.score AND 90 * p.score
WINDOW w AS (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id) QUALIFY row_number() OVER w <= 10""",
    "op13_warc_normaliser": """
WITH p AS (SELECT page_id, coalesce(html, '') AS t FROM pages), g AS (SELECT t, max(page_id) AS keep FROM p WHERE strlen(t) >= 1000 GROUP BY 1)
SELECT page_id, strlen(t) AS payload_bytes, sha1(t) AS payload_digest, CASE WHEN keep <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN keep <> page_id THEN keep END AS refers_to FROM p LEFT JOIN g USING (t)""",
}
