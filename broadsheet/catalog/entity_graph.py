"""Rows E01-E15, J05, A11 and A12 on documents, and the graph rows on the supplier-nation-customer tables."""

from pyspark.sql import functions as F

from broadsheet.catalog.relations import rounded
from broadsheet.catalog.tables import articles, table
from broadsheet.operators import entities as e, graph as g
from broadsheet.operators import relational as r
from broadsheet.registry import query

# Capitalised words stand in for names: the kind of entity follows from the last letter of the word.
CAPS = r"\p{Lu}[\p{L}]+"


def mentions(spark, sf):
    d = articles(spark, sf)
    found = e.pattern_mentions(d, "doc_id", "text", {"ENTITY": CAPS}, {"ENTITY": 0.6})
    last = F.substring("text", -1, 1)
    label = F.when(last.isin("n", "s"), "PER").when(last.isin("t", "d"), "organization").when(last == "e", "geopolitical").otherwise("LOC")
    conf = F.length("text") % 10 / 10.0
    return e.normalize_labels(found.withColumn("label", label).withColumn("confidence", conf))


RAW = """SELECT doc_id, text, start, start + length(text) AS "end", CASE WHEN right(text, 1) IN ('n', 's') THEN 'PER' WHEN right(text, 1) IN ('t', 'd') THEN 'organization' WHEN right(text, 1) = 'e' THEN 'geopolitical' ELSE 'LOC' END AS raw,
  (length(text) % 10) / 10.0::DOUBLE AS confidence FROM (
  SELECT doc_id, p[i][1] AS m, regexp_extract(p[i][1], '\\p{Lu}[\\p{L}]+$') AS text, list_sum(list_transform(p[1:i], lambda x: length(x[1]))) - length(regexp_extract(p[i][1], '\\p{Lu}[\\p{L}]+$')) AS start
  FROM (SELECT doc_id, list_transform(regexp_extract_all(text, '(?s)(.*?\\p{Lu}[\\p{L}]+)'), lambda x: [x]) AS p FROM documents), unnest(range(1, len(p) + 1)) AS u(i))"""
MENTIONS = f"""(SELECT doc_id, text, start, "end", confidence, CASE raw WHEN 'PER' THEN 'PERSON' WHEN 'organization' THEN 'ORG' WHEN 'geopolitical' THEN 'GPE' ELSE raw END AS label FROM ({RAW}))"""


@query("E01_E02_mentions", f'SELECT doc_id, text, label, start, "end", confidence FROM {MENTIONS}')
def e01(spark, sf):
    return mentions(spark, sf).drop("source")


@query("E01_extract_mentions")
def e01b(spark, sf):
    d = articles(spark, sf)
    names = table(spark, sf, "benchmark").select(F.expr("regexp_extract(text, '([A-Za-z]+ [a-z]+)', 1)").alias("name"), F.lit("ORG").alias("label")).where("name <> ''")
    return e.extract_mentions(d, "doc_id", "text", names)


@query("J05_entity_pairs", f"""WITH m AS MATERIALIZED (SELECT * FROM {MENTIONS}) SELECT a.doc_id, a.text AS left_text, b.text AS right_text, a.start AS left_start, b.start AS right_start, abs(a.start - b.start) AS distance
FROM m a JOIN m b ON a.doc_id = b.doc_id AND a.label = 'ORG' AND b.label IN ('GPE', 'LOC') AND abs(a.start - b.start) < 100""")
def j05(spark, sf):
    return r.entity_pairs(mentions(spark, sf), ["ORG"], ["GPE", "LOC"], 100).select("doc_id", "left_text", "right_text", "left_start", "right_start", "distance")


# Overlapping mentions: every capitalised word, and the two-word phrase that starts with one.
def overlapping(spark, sf):
    d = articles(spark, sf)
    return e.pattern_mentions(d, "doc_id", "text", {"ENTITY": CAPS, "MONEY": CAPS + r"[ ,.\n]+[\p{L}]+"}, {"ENTITY": 0.6, "MONEY": 0.9})


def spans_sql(pattern, label, conf):
    return f"""SELECT doc_id, text, start, start + length(text) AS "end", '{label}' AS label, {conf}::DOUBLE AS confidence FROM (
  SELECT doc_id, regexp_extract(p[i], '{pattern}$') AS text, list_sum(list_transform(p[1:i], lambda x: length(x))) - length(regexp_extract(p[i], '{pattern}$')) AS start
  FROM (SELECT doc_id, regexp_extract_all(text, '(?s).*?{pattern}') AS p FROM documents), unnest(range(1, len(p) + 1)) AS u(i))"""


@query("E03_resolve_overlaps")
def e03(spark, sf):
    return e.resolve_overlaps(overlapping(spark, sf))


@query("E04_merge_mentions")
def e04(spark, sf):
    return e.merge_mentions(overlapping(spark, sf))


PATTERNS = [("CEO_OF", r"([\p{L}]+) of ([\p{L}]+)"), ("WORKS_FOR", r"([\p{L}]+) (?:de|der) ([\p{L}]+)"), ("LOCATED_IN", r"([\p{L}]+) in ([\p{L}]+)")]


def rules(spark, sf):
    return e.rule_relations(articles(spark, sf), "doc_id", "text", PATTERNS)


RULE_SQL = " UNION ALL ".join(
    f"""SELECT doc_id, '{k}' AS type, a[i] AS entity1, b[i] AS entity2, w[i] AS context, i FROM (SELECT doc_id, regexp_extract_all(text, '(?i){p}', 0) AS w, regexp_extract_all(text, '(?i){p}', 1) AS a, regexp_extract_all(text, '(?i){p}', 2) AS b FROM documents), unnest(range(1, len(w) + 1)) AS u(i)"""
    for k, p in PATTERNS)


@query("E05_rule_relations", f"SELECT doc_id, type, entity1, entity2, context FROM ({RULE_SQL})")
def e05(spark, sf):
    return rules(spark, sf).select("doc_id", "type", "entity1", "entity2", "context")


@query("E06_proximity_relations")
def e06(spark, sf):
    return e.proximity_relations(mentions(spark, sf), articles(spark, sf), "doc_id", "text")


@query("E07_dedup_relations", f"""SELECT type, lower(arg_min(entity1, (doc_id, i))) AS entity1, lower(arg_min(entity2, (doc_id, i))) AS entity2, min(doc_id) AS doc_id FROM ({RULE_SQL}) GROUP BY lower(entity1), lower(entity2), type""")
def e07(spark, sf):
    return e.dedup_relations(rules(spark, sf)).select("type", F.lower("entity1").alias("entity1"), F.lower("entity2").alias("entity2"), "doc_id")


STATS = f"""WITH m AS (SELECT * FROM {MENTIONS}), r AS ({RULE_SQL}), t AS (SELECT (SELECT count(*) FROM documents)::DOUBLE AS texts, (SELECT count(*) FROM m)::DOUBLE AS entities, (SELECT count(*) FROM r)::DOUBLE AS relations)"""


@query("E08_extraction_stats", STATS + """SELECT 'texts' AS metric, texts AS value FROM t UNION ALL SELECT 'entities', entities FROM t UNION ALL SELECT 'relations', relations FROM t UNION ALL SELECT 'entities_per_text', round(entities / texts, 6) FROM t
UNION ALL SELECT 'relations_per_text', round(relations / texts, 6) FROM t UNION ALL SELECT 'entity:' || label, count(*)::DOUBLE FROM m GROUP BY label UNION ALL SELECT 'relation:' || type, count(*)::DOUBLE FROM r GROUP BY type""")
def e08(spark, sf):
    return rounded(e.extraction_stats(articles(spark, sf), mentions(spark, sf), rules(spark, sf)))


@query("A11_entity_rollup", f"""WITH t AS (SELECT label, text, count(*) AS count FROM {MENTIONS} GROUP BY 1, 2), l AS (SELECT label, CAST(sum(count) AS BIGINT) AS mentions, count(*) AS "unique" FROM t GROUP BY 1)
SELECT label, text, count, row_number() OVER (PARTITION BY label ORDER BY count DESC, text) AS rank, mentions, "unique" FROM t JOIN l USING (label) QUALIFY rank <= 10""")
def a11(spark, sf):
    return r.entity_rollup(mentions(spark, sf))


@query("A12_entity_cooccurrence", f"""WITH n AS MATERIALIZED (SELECT DISTINCT doc_id, text FROM {MENTIONS} WHERE length(text) >= 8)
SELECT a.text AS entity_1, b.text AS entity_2, count(*) AS weight FROM n a JOIN n b ON a.doc_id = b.doc_id AND a.text < b.text GROUP BY 1, 2 HAVING count(*) >= 3""")
def a12(spark, sf):
    return r.entity_cooccurrence(mentions(spark, sf).where(F.length("text") >= 8), 3)


@query("A12_entity_cooccurrence_whole")
def a12_whole(spark, sf):
    """All names and every pair of two documents or more; A12_entity_cooccurrence has the bounds of its SQL."""
    return r.entity_cooccurrence(mentions(spark, sf))


# ---- graph: suppliers and customers as relations of nations, parts as hubs

def relations(spark, sf):
    o = table(spark, sf, "lineitem").select("l_suppkey", "l_partkey", "l_quantity", "l_returnflag")
    return o.select(F.concat(F.lit("s"), F.col("l_suppkey")).alias("entity1"), F.concat(F.lit("p"), F.col("l_partkey") % 40).alias("entity2"),
                    F.col("l_returnflag").alias("type"), (F.col("l_quantity") / 50).alias("confidence")).unionByName(
        table(spark, sf, "nation").select(F.concat(F.lit("p"), F.col("n_nationkey")).alias("entity1"), F.concat(F.lit("r"), F.col("n_regionkey")).alias("entity2"),
                                          F.lit("IN").alias("type"), F.lit(1.0).alias("confidence"))).unionByName(
        table(spark, sf, "customer").select(F.concat(F.lit("c"), F.col("c_custkey")).alias("entity1"), F.concat(F.lit("n"), F.col("c_nationkey")).alias("entity2"),
                                            F.col("c_mktsegment").alias("type"), F.lit(0.5).alias("confidence")))


REL = """SELECT 's' || l_suppkey AS a, 'p' || (l_partkey % 40) AS b, l_returnflag AS t, l_quantity / 50 AS c FROM lineitem UNION ALL SELECT 'p' || n_nationkey, 'r' || n_regionkey, 'IN', 1.0 FROM nation
UNION ALL SELECT 'c' || c_custkey, 'n' || c_nationkey, c_mktsegment, 0.5 FROM customer"""
EDGES = f"(SELECT a AS src, b AS dst, arg_max(t, (c, t)) AS type, max(c) AS confidence FROM ({REL}) WHERE a <> b GROUP BY 1, 2)"


def edges(spark, sf):
    return e.build_graph(relations(spark, sf))[1]


@query("E09_build_graph", f"SELECT src, dst, type, round(confidence, 6) AS confidence FROM {EDGES}")
def e09(spark, sf):
    return rounded(edges(spark, sf))


COMP = f"""WITH RECURSIVE e AS MATERIALIZED (SELECT src AS a, dst AS b FROM {EDGES} UNION SELECT dst, src FROM {EDGES}), l(id, c) AS (SELECT DISTINCT a, a FROM e UNION SELECT e.b, l.c FROM l JOIN e ON e.a = l.id),
comp AS (SELECT id, min(c) AS component FROM l GROUP BY 1)"""


@query("E10_graph_stats", COMP + f""", s AS (SELECT count(*) AS nodes, count(DISTINCT component) AS components FROM comp), m AS (SELECT count(*) AS edges FROM {EDGES})
SELECT nodes, components, edges, round(edges::DOUBLE / (nodes * (nodes - 1)), 6) AS density, CAST(components = 1 AS INTEGER) AS weakly_connected FROM s, m""")
def e10(spark, sf):
    return rounded(e.graph_stats(edges(spark, sf))).withColumn("weakly_connected", F.col("weakly_connected").cast("int"))


@query("E11_degree_centrality", f"WITH d AS (SELECT id, count(*) AS degree FROM (SELECT src AS id FROM {EDGES} UNION ALL SELECT dst FROM {EDGES}) GROUP BY 1) SELECT id, degree, round(degree::DOUBLE / (count(*) OVER () - 1), 6) AS centrality FROM d")
def e11(spark, sf):
    return rounded(e.degree_centrality(edges(spark, sf)))


ROUNDS = 20
PR = f"""WITH e AS MATERIALIZED (SELECT src, dst FROM {EDGES}), o AS (SELECT src, count(*) AS k FROM e GROUP BY 1), v AS (SELECT src AS id FROM e UNION SELECT dst FROM e), nn AS (SELECT count(*)::DOUBLE AS n FROM v),
r0 AS MATERIALIZED (SELECT id, 1.0::DOUBLE / n AS rank FROM v, nn)""" + "".join(
    f""", r{i} AS MATERIALIZED (SELECT v.id, 0.15::DOUBLE / n + 0.85::DOUBLE * (coalesce(x.s, 0) + d.lost / n) AS rank FROM v LEFT JOIN (SELECT dst AS id, sum(rank / k) AS s FROM e JOIN o USING (src) JOIN r{i - 1} ON r{i - 1}.id = src GROUP BY 1) x ON x.id = v.id, nn,
(SELECT coalesce(sum(rank), 0) AS lost FROM r{i - 1} WHERE id NOT IN (SELECT src FROM o)) d)""" for i in range(1, ROUNDS + 1)) + f" SELECT id, round(rank, 8) AS rank FROM r{ROUNDS}"


@query("E12_pagerank", PR)
def e12(spark, sf):
    return rounded(g.pagerank(edges(spark, sf), ROUNDS), 8)


@query("E13_components", COMP + " SELECT id, component FROM comp")
def e13(spark, sf):
    return g.components(edges(spark, sf))


@query("E13_communities")
def e13b(spark, sf):
    return g.communities(edges(spark, sf))


@query("E13_communities_by_modularity")
def e13c(spark, sf):
    found, value = g.communities_by_modularity(edges(spark, sf))
    return found.withColumn("modularity", F.lit(round(value, 6)))


@query("E13_modularity", f"""WITH e AS MATERIALIZED (SELECT src AS a, dst AS b FROM {EDGES} UNION SELECT dst, src FROM {EDGES}), p AS (SELECT a, b, left(a, 1) AS ca, left(b, 1) AS cb FROM e),
c AS (SELECT ca, count(*)::DOUBLE AS total, sum((ca = cb)::INT) AS inside FROM p GROUP BY 1) SELECT round(sum(inside) / sum(total) - sum(total * total) / (sum(total) * sum(total)), 6) AS modularity, count(*) AS communities FROM c""")
def e13d(spark, sf):
    both = g.weighted_both_ways(edges(spark, sf))
    return rounded(g.modularity(both, both.select(F.col("a").alias("id")).distinct().withColumn("community", F.left("id", F.lit(1)))))


def pairs(spark, sf):
    return table(spark, sf, "supplier").select(F.concat(F.lit("s"), F.col("s_suppkey")).alias("a"), F.concat(F.lit("r"), F.col("s_suppkey") % 5).alias("b"))


PATHS = f"""WITH e AS MATERIALIZED (SELECT * FROM {EDGES}), p AS (SELECT 's' || s_suppkey AS a, 'r' || (s_suppkey % 5) AS b FROM supplier),
w AS (SELECT p.a, p.b, 1 AS length, p.a || '>' || p.b AS path FROM p JOIN e ON e.src = p.a AND e.dst = p.b
UNION ALL SELECT p.a, p.b, 2, p.a || '>' || x.dst || '>' || p.b FROM p JOIN e x ON x.src = p.a JOIN e y ON y.src = x.dst AND y.dst = p.b WHERE x.dst NOT IN (p.a, p.b)
UNION ALL SELECT p.a, p.b, 3, p.a || '>' || x.dst || '>' || y.dst || '>' || p.b FROM p JOIN e x ON x.src = p.a JOIN e y ON y.src = x.dst JOIN e z ON z.src = y.dst AND z.dst = p.b WHERE x.dst NOT IN (p.a, p.b) AND y.dst NOT IN (p.a, p.b, x.dst))"""


@query("E14_find_connections", PATHS + " SELECT * FROM w")
def e14(spark, sf):
    return g.find_connections(edges(spark, sf), pairs(spark, sf)).select("a", "b", "length", F.array_join("path", ">").alias("path"))


@query("E14_shortest_paths", PATHS + " SELECT a, b, min(length) AS distance, count(*) AS paths FROM w GROUP BY 1, 2")
def e14b(spark, sf):
    return g.shortest_paths(g.find_connections(edges(spark, sf), pairs(spark, sf)))


@query("E14_smallest_paths", PATHS + """, r AS (SELECT *, row_number() OVER (PARTITION BY a, b ORDER BY length, replace(path, '>', chr(1))) AS rank, count(*) OVER (PARTITION BY a, b) AS paths FROM w) SELECT a, b, length, path, rank, paths FROM r WHERE rank <= 10""")
def e14c(spark, sf):
    found = g.smallest_paths(g.find_connections(edges(spark, sf), pairs(spark, sf)))
    return found.select("a", "b", "length", F.array_join("path", ">").alias("path"), "rank", "paths")


@query("E14_common_neighbours", f"WITH e AS (SELECT src, dst FROM {EDGES}), p AS (SELECT 's' || s_suppkey AS a, 's' || (s_suppkey + 1) AS b FROM supplier) SELECT a, b, x.dst AS node FROM p JOIN e x ON x.src = a JOIN e y ON y.src = b AND y.dst = x.dst")
def e14d(spark, sf):
    two = table(spark, sf, "supplier").select(F.concat(F.lit("s"), F.col("s_suppkey")).alias("a"), F.concat(F.lit("s"), F.col("s_suppkey") + 1).alias("b"))
    return g.common_neighbours(edges(spark, sf), two)


@query("E15_relation_distribution", f"SELECT type, count(*) AS count FROM {EDGES} GROUP BY 1")
def e15(spark, sf):
    return e.relation_distribution(edges(spark, sf))
