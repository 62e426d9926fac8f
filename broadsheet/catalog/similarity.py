"""Rows X10-X15, I01-I16 and J07 on documents and embeddings."""

from pyspark.sql import functions as F

from broadsheet.catalog.relations import rounded
from broadsheet.catalog.tables import articles, hits_sql, table, tokens_sql
from broadsheet.functions import text as tx
from broadsheet.operators import features as ft
from broadsheet.operators import semantic as sm
from broadsheet.registry import query

TOK = tokens_sql("text")


def token_table(spark, sf, *extra):
    return articles(spark, sf, "lang").select("doc_id", *extra, tx.word_tokens("text").alias("tokens"))


def emb(spark, sf):
    return table(spark, sf, "embeddings")


GRAMS = f"""t AS (SELECT doc_id, {TOK} AS t FROM documents), g AS (SELECT doc_id, unnest(t) AS term FROM t UNION ALL SELECT doc_id, t[i] || ' ' || t[i + 1] FROM t, unnest(range(1, len(t))) AS u(i)),
tf AS (SELECT doc_id, term, count(*) AS tf FROM g GROUP BY ALL), nn AS (SELECT count(*) AS n FROM documents),
v AS (SELECT term, count(*) AS df, sum(tf) AS total FROM tf GROUP BY 1 HAVING count(*) >= 2 AND count(*) <= 0.95::DOUBLE * (SELECT n FROM nn) ORDER BY total DESC, term LIMIT 5000),
r AS (SELECT doc_id, term, tf, (1 + ln(tf)) * (ln((1 + n) / (1 + df)::DOUBLE) + 1) AS w FROM tf JOIN v USING (term), nn),
w AS (SELECT doc_id, term, tf, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS tfidf FROM r)"""


@query("X10_tfidf", f"WITH {GRAMS} SELECT doc_id, term, tf, round(tfidf, 6) AS tfidf FROM w")
def x10(spark, sf):
    return rounded(ft.tfidf_long(token_table(spark, sf), "doc_id", "tokens"))


@query("X11_counts", f"""WITH tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest({TOK}) AS term FROM documents) GROUP BY ALL),
v AS (SELECT term FROM tf GROUP BY 1 HAVING count(*) >= 2 AND count(*) <= 0.95::DOUBLE * (SELECT count(*) FROM documents) ORDER BY sum(tf) DESC, term LIMIT 1000) SELECT doc_id, term, tf FROM tf JOIN v USING (term)""")
def x11(spark, sf):
    return ft.count_long(token_table(spark, sf), "doc_id", "tokens")


@query("X12_lsa_embeddings")
def x12(spark, sf):
    from broadsheet.operators.topics import lsa_embeddings
    return lsa_embeddings(ft.tfidf_long(token_table(spark, sf), "doc_id", "tokens", lo=1, hi=1, max_features=1000), "doc_id", 8, documents=token_table(spark, sf))


UNIT = "(SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE / sqrt(list_sum(list_transform(embedding, lambda y: y::DOUBLE * y::DOUBLE)))) AS u FROM embeddings)"
DOT = "list_sum(list_transform(list_zip(a.u, b.u), lambda z: z[1] * z[2]))"


@query("X14_similarity_features", f"""WITH e AS {UNIT}, s AS (SELECT a.vec_id, {DOT} AS s FROM e a, e b)
SELECT vec_id, round(max(s), 6) AS max_similarity, round(avg(s), 6) AS mean_similarity, round(stddev_pop(s), 6) AS std_similarity, round(quantile_cont(s, 0.5), 6) AS median_similarity FROM s GROUP BY 1""")
def x14(spark, sf):
    e = emb(spark, sf)
    return rounded(sm.similarity_features(e, e, "vec_id", "embedding"))


@query("X15_assemble_features")
def x15(spark, sf):
    d = articles(spark, sf)
    a = tx.linguistic_features(d, "text").select("doc_id", "char_count", "word_count", "mean_word_length", "upper_share")
    b = tx.news_features(d, "text").select("doc_id", "quote_ratio", "percent_count")
    from pyspark.ml.functions import vector_to_array
    cols = ["char_count", "word_count", "mean_word_length", "upper_share", "quote_ratio", "percent_count"]
    return ft.assemble_features([a, b], "doc_id", cols).select("doc_id", vector_to_array("features").alias("features"))


@query("I01_normalize_vectors", f"SELECT vec_id, i AS pos, round(u[i + 1], 6) AS x FROM {UNIT}, unnest(range(0, 64)) AS t(i)")
def i01(spark, sf):
    return sm.normalize_vectors(emb(spark, sf), "embedding").select("vec_id", F.posexplode("embedding").alias("pos", "x")).withColumn("x", F.round("x", 6))


TOP = f"""WITH e AS {UNIT}, s AS (SELECT a.vec_id AS query_id, b.vec_id AS item_id, {DOT} AS score FROM e a JOIN e b ON a.vec_id <> b.vec_id)
SELECT query_id, item_id, round(score, 6) AS score, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, item_id) AS rank FROM s QUALIFY rank <= 5"""


@query("I02_similar_items", TOP)
def i02(spark, sf):
    e = emb(spark, sf)
    return rounded(sm.similar_items(e, e, "vec_id", "embedding", 5, skip_self=True))


@query("I02_search_index", TOP)
def i02_index(spark, sf):
    e = emb(spark, sf)
    return rounded(sm.search_items(sm.item_cells(e, "vec_id", "embedding"), e, "vec_id", "embedding", 5, skip_self=True).drop("cells"))


def joined_docs(spark, sf):
    return emb(spark, sf).withColumnRenamed("vec_id", "doc_id").join(articles(spark, sf, "lang"), "doc_id")


@query("I03_semantic_search", f"""WITH e AS (SELECT vec_id AS doc_id, u, lang, list_distinct({TOK}) AS t FROM {UNIT} JOIN documents ON vec_id = doc_id),
s AS (SELECT a.doc_id AS query_id, b.doc_id AS item_id, a.t AS q, b.t AS d, {DOT} AS score FROM e a JOIN e b ON b.lang = 'fr' WHERE a.doc_id % 10 = a.doc_id // 50)
SELECT query_id, item_id, round(score, 6) AS score, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, item_id) AS rank,
  round(CASE WHEN len(q) = 0 THEN 0 ELSE len(list_intersect(q, d))::DOUBLE / len(q) END, 6) AS relevance FROM s WHERE score >= 1e-9 QUALIFY rank <= 5""".replace(" WHERE a.doc_id % 10 = a.doc_id // 50", ""))
def i03(spark, sf):
    d = joined_docs(spark, sf)
    return rounded(sm.semantic_search(d, d, "doc_id", "embedding", "text", {"lang": "fr"}, 5))


PAIR_T = 0.4


@query("I04_similar_pairs", f"""WITH dd AS (SELECT min(doc_id) AS doc_id, count(*) AS copies FROM documents GROUP BY array_to_string({TOK}, chr(1))),
{GRAMS.replace("SELECT doc_id, unnest(t) AS term FROM t UNION ALL SELECT doc_id, t[i] || ' ' || t[i + 1] FROM t, unnest(range(1, len(t))) AS u(i)", "SELECT doc_id, unnest(t) AS term FROM t").replace(" HAVING count(*) >= 2 AND count(*) <= 0.95::DOUBLE * (SELECT n FROM nn) ORDER BY total DESC, term LIMIT 5000", "")},
x AS (SELECT w.* FROM w JOIN dd USING (doc_id)), p AS (SELECT a.doc_id AS id_1, b.doc_id AS id_2, sum(a.tfidf * b.tfidf) AS score FROM x a JOIN x b ON a.term = b.term AND a.doc_id < b.doc_id GROUP BY 1, 2 HAVING round(sum(a.tfidf * b.tfidf), 9) >= {PAIR_T})
SELECT id_1, id_2, round(score, 6) AS score, a.copies AS copies_1, b.copies AS copies_2 FROM p JOIN dd a ON a.doc_id = id_1 JOIN dd b ON b.doc_id = id_2
UNION ALL SELECT doc_id, doc_id, 1.0, copies, copies FROM dd WHERE copies > 1""")
def i04(spark, sf):
    d = token_table(spark, sf)
    weights = ft.tfidf_long(d, "doc_id", "tokens", max_features=None, min_df=1, max_df=1.0, lo=1, hi=1)
    return rounded(sm.similar_pairs_of_texts(weights, sm.copy_groups(d, "doc_id", "tokens"), "doc_id", PAIR_T))


@query("I04_copy_groups", f"SELECT doc_id, min(doc_id) OVER k AS rep, count(*) OVER k AS copies FROM documents WINDOW k AS (PARTITION BY array_to_string({TOK}, chr(1)))")
def i04b(spark, sf):
    return sm.copy_groups(token_table(spark, sf), "doc_id", "tokens")


@query("I05_approximate_pairs")
def i05(spark, sf):
    return sm.approximate_pairs(emb(spark, sf), "vec_id", "embedding", 0.4, bucket=1.0, whole=True)


@query("I06_cluster_items")
def i06(spark, sf):
    return sm.cluster_items(emb(spark, sf), "embedding", 10)[0].select("vec_id", "label", "cluster")


@query("I07_choose_k")
def i07(spark, sf):
    e = emb(spark, sf)
    k = sm.choose_k(e, "embedding", 12)
    return e.groupBy().agg(F.lit(k).alias("k"), F.count(F.lit(1)).alias("rows"))


@query("I08_cluster_stats", """SELECT count(*) AS clusters, max(n) AS largest, min(n) AS smallest, round(avg(n), 6) AS mean, round(greatest(0, 1 - stddev_pop(n) / (sum(n) / count(*))), 6) AS balance
FROM (SELECT label, count(*) AS n FROM embeddings GROUP BY 1)""")
def i08(spark, sf):
    return rounded(sm.cluster_stats(emb(spark, sf), "label"))


@query("I09_cluster_coherence", f"""WITH e AS {UNIT} SELECT a.label, max(n) AS items, round(avg({DOT}), 6) AS coherence FROM e a JOIN e b ON a.label = b.label AND a.vec_id < b.vec_id
JOIN (SELECT label, count(*) AS n FROM embeddings GROUP BY 1) c ON c.label = a.label GROUP BY 1""")
def i09(spark, sf):
    return rounded(sm.cluster_coherence(emb(spark, sf), "label", "embedding"))


@query("I10_cluster_terms", f"""WITH tf AS (SELECT lang, doc_id, term, count(*) AS tf FROM (SELECT lang, doc_id, unnest({TOK}) AS term FROM documents) GROUP BY ALL), sz AS (SELECT lang, count(*) AS n FROM documents GROUP BY 1),
v AS (SELECT lang, term, count(*) AS df, sum(tf) AS total, max(n) AS n FROM tf JOIN sz USING (lang) GROUP BY lang, term QUALIFY row_number() OVER (PARTITION BY lang ORDER BY total DESC, term) <= 100),
r AS (SELECT lang, doc_id, term, n, tf * (ln((1 + n) / (1 + df)::DOUBLE) + 1) AS w FROM tf JOIN v USING (lang, term)), w AS (SELECT lang, term, n, w / sqrt(sum(w * w) OVER (PARTITION BY lang, doc_id)) AS x FROM r),
m AS (SELECT lang, term, sum(x) / max(n) AS score FROM w GROUP BY ALL) SELECT lang, term, round(score, 6) AS score, row_number() OVER (PARTITION BY lang ORDER BY round(score, 9) DESC, term) AS rank FROM m QUALIFY rank <= 10""")
def i10(spark, sf):
    return rounded(sm.cluster_terms(token_table(spark, sf, "lang"), "lang", "doc_id", "tokens"))


@query("I11_project_pca")
def i11(spark, sf):
    return sm.project_pca(emb(spark, sf), "embedding", 2)[0].select("vec_id", "coordinates")


BAND = "CASE WHEN label < 4 THEN 'a' WHEN label < 7 THEN 'b' ELSE 'c' END"


@query("I12_group_similarity", f"""WITH e AS (SELECT *, {BAND} AS g FROM {UNIT}), s AS (SELECT a.g AS group_1, b.g AS group_2, round({DOT}, 6) AS s FROM e a JOIN e b ON a.g < b.g),
c AS (SELECT {BAND} AS g, i, avg(embedding[i]::DOUBLE) AS c FROM embeddings, unnest(range(1, 65)) AS u(i) GROUP BY ALL), n AS (SELECT g, sqrt(sum(c * c)) AS n FROM c GROUP BY 1),
cs AS (SELECT a.g AS group_1, b.g AS group_2, sum(a.c * b.c) / max(x.n * y.n) AS centroid_similarity FROM c a JOIN c b ON a.i = b.i AND a.g < b.g JOIN n x ON x.g = a.g JOIN n y ON y.g = b.g GROUP BY 1, 2)
SELECT group_1, group_2, count(*) AS pairs, round(min(s), 4) AS min, round(max(s), 4) AS max, round(avg(s), 4) AS mean, round(quantile_cont(s, 0.25), 4) AS q25, round(quantile_cont(s, 0.5), 4) AS median, round(quantile_cont(s, 0.75), 4) AS q75,
  round(stddev_pop(s), 4) AS std, round(max(centroid_similarity), 4) AS centroid_similarity FROM s JOIN cs USING (group_1, group_2) GROUP BY 1, 2""")
def i12(spark, sf):
    e = emb(spark, sf).withColumn("g", F.when(F.col("label") < 4, "a").when(F.col("label") < 7, "b").otherwise("c"))
    return rounded(sm.group_similarity(e, "g", "vec_id", "embedding"), 4)


@query("I13_mixed_clusters")
def i13(spark, sf):
    clustered = sm.cluster_items(emb(spark, sf), "embedding", 10)[0]
    return sm.mixed_clusters(clustered, "cluster", "label")


@query("I13_mixed_groups_of_sources", """WITH p AS (SELECT source, lang, count(*) AS n FROM documents GROUP BY 1, 2), o AS (SELECT source, sum(n) AS items, count(*) AS groups, max(n)::DOUBLE / sum(n) AS m FROM p GROUP BY 1)
SELECT source, CAST(items AS BIGINT) AS items, groups, round(m, 6) AS main_share, round(avg((groups > 1)::INT) OVER (), 6) AS mixed_ratio FROM o""")
def i13b(spark, sf):
    return rounded(sm.mixed_clusters(articles(spark, sf, "lang").withColumnRenamed("category", "source"), "source", "lang"))


FIRST = "(SELECT * FROM documents QUALIFY row_number() OVER (PARTITION BY substring(text, 1, 100) ORDER BY doc_id) = 1)"
TERMS = ["the", "thion", "oning", "quelle"]


@query("I14_search_articles", f"""SELECT doc_id, array_to_string((list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> ''))[1:10], ' ') || CASE WHEN len(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> '')) > 10 THEN '...' ELSE '' END AS title,
  CASE WHEN length(text) > 400 THEN substring(text, 1, 400) || '...' ELSE text END AS text, source AS category, 3 + {hits_sql('lower(text)', ['thion', 'oning', 'quelle'])} AS score FROM {FIRST} WHERE contains(lower(source), 'src1') ORDER BY score DESC, doc_id LIMIT 20""")
def i14(spark, sf):
    return sm.search_articles(articles(spark, sf), "doc_id", "text", "category", TERMS, ["src1"], n=20)


@query("I15_keyword_search", f"SELECT doc_id, {hits_sql('lower(text)', ['thion', 'oning', 'elle'])} AS relevance FROM documents WHERE {hits_sql('lower(text)', ['thion', 'oning', 'elle'])} > 0 ORDER BY relevance DESC, doc_id LIMIT 50")
def i15(spark, sf):
    return sm.keyword_search(articles(spark, sf), "doc_id", "text", "the thion or oning of elle", 50).select("doc_id", "relevance")


@query("I16_articles_by", f"SELECT count(*) AS total FROM documents WHERE source = 'src3' AND {hits_sql('lower(text)', ['thion', 'elle'])} > 0")
def i16(spark, sf):
    found = sm.articles_by(articles(spark, sf), "doc_id", "text", "category", "SRC3", "positive", 5, positive=["thion", "elle"])
    return found.select("total").distinct()


@query("J07_cross_similarity", f"WITH e AS {UNIT} SELECT a.vec_id AS id_1, b.vec_id AS id_2, round({DOT}, 6) AS score FROM e a JOIN e b ON a.label < 5 AND b.label >= 5 WHERE round({DOT}, 9) >= 0.3")
def j07(spark, sf):
    e = emb(spark, sf)
    return rounded(sm.cross_similarity(e.where("label < 5"), e.where("label >= 5"), "vec_id", "embedding", 0.3))


