"""The queries op1 to op13 and the pipeline, with their SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from broadsheet.llm import codes, decontaminate, exact, html, minhash, negatives, packing, pieces, pii, quality, repeats, tokenfile, warc

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sentencepiece_nbest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.n_best(table(spark, sf_dir, "documents"), n=3)


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(table(spark, sf_dir, "documents")).drop("n_chars")


OP2_SQL = r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS size, regexp_replace(coalesce(text, ''), '[ \t-\r]', '', 'g') AS body FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY body) AS group_size,
       row_number() OVER w = 1 AS kept, sha256(body) AS text_sha256
FROM d WINDOW w AS (PARTITION BY body ORDER BY size DESC, doc_id)
"""


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_groups(table(spark, sf_dir, "documents"), size=2, percent=80)


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfile.write_and_read(table(spark, sf_dir, "documents"), end_id=1)


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), capacity=2048, end_id=0)


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.write_and_read(table(spark, sf_dir, "pages"))


OP6_SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS size, sha256(coalesce(html, '')) AS digest FROM pages),
f AS (SELECT *, CASE WHEN size >= 100 THEN min(page_id) OVER (PARTITION BY digest) ELSE page_id END AS first FROM p)
SELECT page_id, size AS payload_bytes, digest AS payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM f
"""


def op7_contextual_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(table(spark, sf_dir, "documents"))
    return found.select("doc_id", *[f"n_{k}" for k in pii.KINDS], F.sha2(pii.span_list(F.col("base")), 256).alias("base_sha256"),
                        pii.span_list(F.concat("base", "added")).alias("spans"), F.size("added").cast("long").alias("n_added"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents")).drop("class_distance", "word_distance")


OP8_SQL = rf"""
WITH d AS (
  SELECT doc_id, lang, t AS text, regexp_replace(t, '[ \t-\r]', '', 'g') AS compact,
         [x FOR x IN regexp_split_to_array(t, '[ \t-\r]+') IF x <> ''] AS words,
         [x FOR x IN string_split(t, chr(10)) IF regexp_matches(x, '[^ \t-\r]')] AS lines
  FROM (SELECT doc_id, lang, coalesce(text, '') AS t FROM documents)),
m AS (
  SELECT doc_id, lang, words, len(words) AS n, length(compact) AS word_chars, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         length(text) - length(compact) AS c0, length(text) - length(regexp_replace(text, '[0-9]', '', 'g')) AS c1,
         length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) AS c2,
         length(text) - length(regexp_replace(text, '[.,;:!?''"()-]', '', 'g')) AS c3,
         length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS c4, strlen(text) - length(text) AS c6, length(compact) AS solid
  FROM d),
c AS (SELECT *, solid - c1 - c2 - c3 - c4 AS c5 FROM m),
v AS (SELECT doc_id, lang, unnest([0, 1, 2, 3, 4, 5, 6]) AS k, unnest([c0, c1, c2, c3, c4, c5, c6])::DOUBLE AS x FROM c),
wide AS (SELECT lang, sum(n) AS n FROM c WHERE lang IS NOT NULL GROUP BY lang HAVING sum(n) >= {quality.MIN_REFERENCE_WORDS} ORDER BY n DESC, lang LIMIT {quality.LANGUAGES}),
vl AS (SELECT v.* FROM v JOIN wide USING (lang) UNION ALL SELECT doc_id, NULL AS lang, k, x FROM v),
cref AS (SELECT lang, k, sum(x) / sum(sum(x)) OVER (PARTITION BY lang) AS q FROM vl GROUP BY lang, k),
tok AS (SELECT doc_id, lang, unnest(words) AS word FROM c),
short AS (SELECT doc_id, lang, word FROM tok WHERE length(word) <= {quality.COMMON_CHARS}),
sl AS (SELECT lang, word, count(*) AS n FROM short JOIN wide USING (lang) GROUP BY lang, word UNION ALL SELECT NULL AS lang, word, count(*) AS n FROM short GROUP BY word),
voc AS (SELECT DISTINCT word FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) AS pos FROM sl) WHERE pos <= {quality.COMMON_WORDS}),
wref AS (SELECT lang, word, n / sum(n) OVER (PARTITION BY lang) AS q FROM sl JOIN voc USING (word)),
ref AS (SELECT c.doc_id, wide.lang AS ref FROM c LEFT JOIN wide USING (lang)),
own AS (SELECT v.doc_id, k, x / sum(x) OVER (PARTITION BY v.doc_id) AS p, sum(x) OVER (PARTITION BY v.doc_id) AS size FROM v),
cd AS (
  SELECT own.doc_id, sqrt(greatest(0, sum((CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2))) AS d
  FROM own JOIN ref ON own.doc_id = ref.doc_id JOIN cref ON cref.lang IS NOT DISTINCT FROM ref.ref AND cref.k = own.k WHERE size > 0 GROUP BY own.doc_id),
uses AS (SELECT doc_id, word, count(*) AS n, sum(count(*)) OVER (PARTITION BY doc_id) AS total FROM tok JOIN voc USING (word) GROUP BY doc_id, word),
wd AS (
  SELECT u.doc_id, any_value(total) AS total, sqrt(greatest(0, sum((CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2) + (1 - sum(q)) / 2)) AS d
  FROM (SELECT uses.doc_id, total, n / total AS p, coalesce(wref.q, 0) AS q
        FROM uses JOIN ref ON uses.doc_id = ref.doc_id LEFT JOIN wref ON wref.lang IS NOT DISTINCT FROM ref.ref AND wref.word = uses.word) u GROUP BY u.doc_id),
tokens AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, n + 1)) AS i FROM c),
five AS (SELECT doc_id, i, [word, lead(word, 1) OVER o, lead(word, 2) OVER o, lead(word, 3) OVER o, lead(word, 4) OVER o] AS key FROM tokens WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
win AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, key) AS times FROM five WHERE key[5] IS NOT NULL),
rep AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat FROM win, (SELECT unnest(range(0, 5)) AS k) WHERE times > 1 GROUP BY doc_id),
r AS (SELECT c.doc_id, c.n, word_chars, c4, n_dup_lines, coalesce(n_repeat, 0) AS n_repeat, c.n < 10 OR 100 * coalesce(n_repeat, 0) > 20 * c.n AS base_failed,
             CASE WHEN c.n >= {quality.MIN_WORDS} THEN cd.d ELSE 0 END AS class_d, CASE WHEN c.n >= {quality.MIN_WORDS} AND wd.total >= {quality.MIN_COMMON} THEN wd.d ELSE 0 END AS word_d
      FROM c LEFT JOIN rep ON rep.doc_id = c.doc_id LEFT JOIN cd ON cd.doc_id = c.doc_id LEFT JOIN wd ON wd.doc_id = c.doc_id)
SELECT doc_id, n AS n_words, word_chars, c4 AS n_symbols, n_dup_lines, n_repeat AS n_repeat_words, base_failed,
       NOT base_failed AND NOT (coalesce(class_d, 0) > {quality.MAX_CLASS_DISTANCE} OR coalesce(word_d, 0) > {quality.MAX_WORD_DISTANCE}) AS kept
FROM r
"""

def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


def op10_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.repeated_spans(table(spark, sf_dir, "documents"))
    spans = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ",")
    return found.select("doc_id", "n_units", "n_removed", spans.alias("spans"), "first_doc_ids")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"))
    return negatives.mine(rows, F.col("vec_id") % 100 == 0)


OP11_SQL = """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, a.label = r.label AS same, r.vec_id AS id, list_sum([a.v[i] * r.v[i] FOR i IN range(1, len(a.v) + 1)])::BIGINT AS score
  FROM e a JOIN e r ON a.vec_id <> r.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
n AS (
  SELECT p.*, s.id AS negative_id, s.score AS negative_score, row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.id) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 100 * s.score BETWEEN 80 * positive_score AND 100 * positive_score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.compress(table(spark, sf_dir, "embeddings"), parts=4, entries=256, rounds=4).drop("codebooks")


def _op12_sql(parts: int = 4, entries: int = 256, rounds: int = 4) -> str:
    """Rounds of nearest entries and floored means, one pair of common table expressions for each."""
    steps = []
    for k in range(rounds + 1):
        steps.append(f"""
near{k} AS MATERIALIZED (
  SELECT row, part, min_by(entry, (d, entry)) AS entry, min(d) AS d
  FROM (SELECT p.row, p.part, c.entry, list_sum([(p.x[i] - c.x[i]) * (p.x[i] - c.x[i]) FOR i IN range(1, len(p.x) + 1)])::BIGINT AS d FROM pieces p JOIN book{k} c ON c.part = p.part)
  GROUP BY row, part)""")
        if k < rounds:
            steps.append(f"""
mean{k} AS (
  SELECT part, entry, list(m ORDER BY place) AS x
  FROM (SELECT part, entry, place, floor_div(sum(v), count(*)) AS m
        FROM (SELECT n.part, n.entry, unnest(p.x) AS v, unnest(range(len(p.x))) AS place FROM near{k} n JOIN pieces p ON p.row = n.row AND p.part = n.part) GROUP BY part, entry, place)
  GROUP BY part, entry),
book{k + 1} AS MATERIALIZED (SELECT b.part, b.entry, coalesce(m.x, b.x) AS x FROM book{k} b LEFT JOIN mean{k} m ON m.part = b.part AND m.entry = b.entry)""")
    rows = ",".join(steps).replace("floor_div(sum(v), count(*))", "(CASE WHEN sum(v) < 0 THEN -((-sum(v) + count(*) - 1) // count(*)) ELSE sum(v) // count(*) END)::BIGINT")
    return f"""
WITH e AS (
  SELECT vec_id, label, row_number() OVER (ORDER BY vec_id) AS row, [floor(1024 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
pieces AS MATERIALIZED (SELECT row, part, v[part * (len(v) // {parts}) + 1:(part + 1) * (len(v) // {parts})] AS x FROM e, (SELECT unnest(range({parts})) AS part)),
book0 AS MATERIALIZED (SELECT part, row - 1 AS entry, x FROM pieces WHERE row <= {entries}),{rows},
coded AS (SELECT row, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM near{rounds} GROUP BY row),
hash AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM book{rounds})
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256 FROM e JOIN coded USING (row), hash
"""


def op13_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


OP13_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, unnest([array_to_string(w[i:i + 9], ' ') FOR i IN range(1, greatest(len(w) - 9, 1) + 1)]) AS k FROM b WHERE len(w) > 0),
pos AS (
  SELECT row, n, unnest(range(1, len(w) - n + 2)) AS i, unnest([array_to_string(w[j:j + n - 1], ' ') FOR j IN range(1, len(w) - n + 2)]) AS k
  FROM d JOIN (SELECT DISTINCT n FROM win) ON n <= len(w)),
hit AS (SELECT row, i, n, item_id FROM pos JOIN win USING (n, k)),
words AS (SELECT row, count(DISTINCT p) AS n_hit FROM (SELECT row, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT row, i, n FROM hit)) GROUP BY row),
found AS (SELECT row, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT row, item_id::VARCHAR AS id FROM hit WHERE item_id IS NOT NULL) GROUP BY row)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (row) LEFT JOIN found USING (row)
"""


QUERIES: dict[str, Query] = {
    f.__name__: f for f in (op1_sentencepiece_nbest, op2_exact_dedup, op3_minhash_near_dedup, op4_token_files, op5_best_fit_packing, op6_warc, op7_contextual_pii, op8_quality_rules, op9_html_text, op10_repeated_passages,
                            op11_hard_negatives, op12_vector_codes, op13_decontaminate)}
SQL: dict[str, str] = {"op2_exact_dedup": OP2_SQL.strip(), "op6_warc": OP6_SQL.strip(), "op8_quality_rules": OP8_SQL.strip(), "op11_hard_negatives": OP11_SQL.strip(), "op12_vector_codes": _op12_sql().strip(),
                       "op13_decontaminate": OP13_SQL.strip()}
