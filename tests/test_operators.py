"""Golden tables and properties of single operators on small fixtures."""

import math
import random
import re
import statistics

import pytest
from pyspark.sql import functions as F

from broadsheet.functions import temporal as tm
from broadsheet.functions import text as tx
from broadsheet.functions.stats import student_two_sided
from broadsheet.operators import bias, clean, entities, lang, lexicon, queries, quality, relational, semantic, sentiment, summarize
from broadsheet.plans import ordered
from broadsheet.plans.sized import salted_join
from broadsheet.sources import io

ARTICLES = [
    (1, "Technology companies announce excellent results and great growth.", "tech"),
    (2, "The football team scored a terrible loss in the championship match.", "sport"),
    (3, "Government officials said the new policy will start on Monday.", "politics"),
    (4, "The market fell today and the crisis hit every bank.", "business"),
    (5, "The film won an award and the actor thanked the crowd.", "entertainment"),
]


@pytest.fixture(scope="module")
def articles(spark):
    return spark.createDataFrame(ARTICLES, "doc_id bigint, text string, category string")


def one(df):
    return df.first().asDict()


def test_clean_text_steps(spark):
    d = spark.createDataFrame([("Visit https://a.b/c NOW!!! mail x.y@z.com or 555-123-4567  ok",), (None,), ("Café ①",)], "t string")
    out = [r[0] for r in d.select(tx.clean_text("t")).collect()]
    assert out[0] == "visit now!!! mail or ok"
    assert out[1] == ""
    assert "1" in out[2]
    assert one(d.select(tx.clean_text("t", {"lower": False, "normalize_unicode": False}).alias("x")))["x"].startswith("Visit NOW")
    with pytest.raises(ValueError):
        tx.clean_text("t", {"nope": True})


def test_preprocess_drops_stop_words_and_punctuation(articles):
    rows = {r.doc_id: r.processed for r in tx.preprocess_text(articles, "text", stopwords=["the", "on", "and", "will"]).collect()}
    assert rows[3] == "government officials new policy start"
    assert len(rows) == 5


def test_sentences_ngrams_and_chunks(spark):
    d = spark.createDataFrame([(1, "One two. Three four five! Six?")], "doc_id bigint, text string")
    assert one(d.select(tx.sentences("text").alias("s")))["s"] == ["One two.", "Three four five!", "Six?"]
    t = d.select(tx.word_tokens("text").alias("t"))
    assert one(t.select(tx.ngrams("t", 2, 3).alias("g")))["g"][:2] == ["one two", "two three"]
    assert one(spark.sql("SELECT array('a') AS t").select(tx.ngrams("t", 1, 3).alias("g")))["g"] == ["a"]
    assert [r.text for r in tx.chunk_sentences(d, "doc_id", "text", 5).orderBy("chunk").collect()] == ["One two. Three four five!", "Six?"]


def test_dedup_is_order_free_and_idempotent(spark):
    rows = [(i, "same text" if i % 3 else f"text {i}", "c") for i in range(60)]
    d = spark.createDataFrame(rows, "doc_id bigint, text string, category string")
    first = {r.doc_id for r in clean.dedup_exact(d, "text", "doc_id").collect()}
    again = clean.dedup_exact(clean.dedup_exact(d.repartition(7), "text", "doc_id"), "text", "doc_id")
    assert first == {r.doc_id for r in again.collect()} == {i for i in range(60) if i % 3 == 0} | {1}


def test_prepare_needs_categories(articles):
    with pytest.raises(ValueError):
        clean.prepare_dataset(articles, min_rows=50)
    done, steps = clean.prepare_dataset(articles, min_rows=1)
    assert done.count() == 5
    assert {r.step: r.rows for r in steps.collect()}["letters"] == 5


def test_validation_of_bad_rows(spark):
    d = spark.createDataFrame([(1, "Valid article", "a"), (2, "", "b"), (3, "a", "c"), (4, None, "d")], "doc_id bigint, text string, category string")
    report = {(r.check_name, r.metric): r for r in quality.validate_dataset(d).collect()}
    assert report["text", "empty"].severity == "issue"
    assert report["summary", "valid"].value == 0
    assert report["missing", "text"].value == 1
    fixed, fixes = clean.fix_common_issues(d, min_chars=5, min_rows=1)
    assert [r.doc_id for r in fixed.collect()] == [1]
    assert sum(r.removed for r in fixes.collect()) == 3


def test_sentiment_signs_and_negation(spark):
    d = spark.createDataFrame([("a great and excellent success",), ("a terrible crisis and a bad loss",), ("the table is here",), ("this is not good",)], "text string")
    out = [r.sentiment for r in sentiment.analyze_sentiment(d).collect()]
    assert out[:3] == ["positive", "negative", "neutral"]
    compound = [r.compound for r in sentiment.analyze_sentiment(d).collect()]
    assert compound[3] < 0 and all(-1 <= c <= 1 for c in compound)


def test_sentiment_join_form_agrees(spark, articles):
    lex = {"great": 2.0, "excellent": 3.0, "terrible": -3.0, "loss": -2.0, "crisis": -2.0}
    d = articles.select("doc_id", tx.word_tokens("text").alias("tokens"))
    inline = {r.doc_id: round(r.compound, 9) for r in sentiment.lexicon_sentiment(d, "tokens", lex, ["not"]).collect()}
    table = spark.createDataFrame(list(lex.items()), "word string, valence double")
    joined = {r.doc_id: round(r.compound, 9) for r in sentiment.lexicon_sentiment_table(d, "doc_id", "tokens", table, ["not"]).collect()}
    assert inline == joined


def test_language_samples(spark):
    rows = [("en", "The government said that the new law is for all of the people"), ("fr", "Le gouvernement a dit que la nouvelle loi est pour tous les gens"),
            ("de", "Die Regierung hat gesagt, dass das neue Gesetz für alle ist"), ("es", "El gobierno dijo que la nueva ley es para todos los que viven aquí")]
    out = lang.detect_language(spark.createDataFrame(rows, "lang string, text string"))
    assert all(r.lang == r.language for r in out.collect())
    assert one(lang.detect_language(spark.createDataFrame([("zz",)], "text string")))["language"] == "unknown"


def test_translation_quality_of_identical_text(spark):
    d = spark.createDataFrame([("Paris 2024 games", "Paris 2024 games", "fr")], "o string, t string, dst string")
    r = one(lang.translation_quality(d, "o", "t", "dst"))
    assert r["preservation"] == 1.0 and r["quality"] == 1.0 and r["grade"] == "excellent"


def test_positions_and_frames_match_python(spark):
    rng = random.Random(1)
    rows = [(i, "hot" if rng.random() < 0.6 else f"k{rng.randrange(5)}", rng.randrange(20), rng.random()) for i in range(500)]
    d = spark.createDataFrame(rows, "id bigint, k string, t int, y double").repartition(6)
    got = {r.id: (r.position, r.m) for r in ordered.rolling(d, ["t", "id"], 4, {"m": lambda w: F.avg("y").over(w)}, ["k"], block=7).collect()}
    for key in {r[1] for r in rows}:
        seq = sorted((r for r in rows if r[1] == key), key=lambda r: (r[2], r[0]))
        for pos, r in enumerate(seq):
            want = statistics.fmean(x[3] for x in seq[max(0, pos - 3):pos + 1])
            assert got[r[0]][0] == pos and abs(got[r[0]][1] - want) < 1e-9
    cum = {r.id: r.cumulative for r in ordered.cumulative(d, ["t", "id"], "y", ["k"], block=9).collect()}
    for key in {r[1] for r in rows}:
        total = 0.0
        for r in sorted((r for r in rows if r[1] == key), key=lambda r: (r[2], r[0])):
            total += r[3]
            assert abs(cum[r[0]] - total) < 1e-9


def test_exact_percentiles(spark):
    values = [random.Random(3).randrange(50) / 7 for _ in range(1)] + [random.Random(i).randrange(40) / 7 for i in range(301)]
    d = spark.createDataFrame([(float(v),) for v in values], "v double")
    assert abs(one(ordered.percentiles(d, "v", {"m": 0.5}))["m"] - statistics.median(values)) < 1e-9


def test_salted_join_keeps_all_rows(spark):
    big = spark.range(1000).withColumn("k", F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 7))
    small = spark.createDataFrame([(i, f"v{i}") for i in range(5)], "k bigint, v string")
    assert salted_join(big, small, ["k"], ["id"]).count() == big.join(small, "k").count()
    assert salted_join(big, small, ["k"], ["id"], "left").count() == 1000


def test_split_is_exact_and_stable(spark):
    d = spark.range(400).withColumn("label", F.when(F.col("id") % 4 == 0, "a").otherwise("b"))
    first = {(r.id, r.split) for r in relational.stratified_split(d, "label", "id").collect()}
    assert first == {(r.id, r.split) for r in relational.stratified_split(d.repartition(9), "label", "id").collect()}
    assert sum(1 for r in first if r[1] == "train") == 320


def test_diversify_equals_the_loop(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice("abcd"), rng.randrange(30)) for i in range(80)]
    kept, seen = [], set()
    for r in sorted(rows, key=lambda r: (-r[2], r[0])):
        if r[1] not in seen or len(kept) < 3:
            kept.append(r[0])
            seen.add(r[1])
    out = relational.diversify(spark.createDataFrame(rows, "id int, c string, s int"), "c", "s", "id")
    assert {r.id for r in out.collect()} == set(kept)


def test_sliding_windows(spark):
    d = spark.createDataFrame([(i, f"2024-01-{i:02d}") for i in range(1, 11)], "id int, d string").withColumn("d", F.to_date("d"))
    assert tm.sliding_windows(d, "d", 30, 7, 1).count() == 0
    starts = sorted({r.window_start.day for r in tm.sliding_windows(d, "d", 3, 2, 1).collect()})
    assert starts == [1, 3, 5, 7]


def test_student_tail():
    assert abs(student_two_sided(2.228, 10) - 0.05) < 1e-3
    assert abs(student_two_sided(0.0, 5) - 1.0) < 1e-9
    assert student_two_sided(50.0, 30) < 1e-20


def test_relations_of_sentences(spark):
    texts = [(1, "Tim Cook is the CEO of Apple."), (2, "Mary Jones works for Acme Corp. Later, Foo Inc acquired by Bar Ltd."), (3, "nothing here")]
    found = entities.rule_relations(spark.createDataFrame(texts, "doc_id bigint, text string"), "doc_id", "text")
    got = {(r.doc_id, r.type, r.entity1, r.entity2) for r in found.collect()}
    assert (1, "CEO_OF", "Tim Cook is the", "Apple") in got  # the name pattern is greedy
    assert (2, "WORKS_FOR", "Mary Jones", "Acme Corp") in got
    assert (2, "ACQUIRED_BY", "Foo Inc", "Bar Ltd") in got
    by_id = dict(texts)
    for r in found.collect():
        assert by_id[r.doc_id][r.start:r.start + len(r.context)] == r.context


def test_mentions_offsets_and_overlaps(spark):
    text = "Apple Inc. chief Tim Cook paid $5 million on 2024-05-01 in New York, up 10%."
    d = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    names = spark.createDataFrame([("Tim Cook", "PER"), ("new york", "GPE"), ("Apple Inc", "ORGANIZATION")], "name string, label string")
    found = entities.extract_mentions(d, "doc_id", "text", names).collect()
    assert {(m.text, m.label) for m in found} >= {("Tim Cook", "PERSON"), ("New York", "GPE"), ("Apple Inc", "ORG"), ("$5 million", "MONEY"), ("10%", "PERCENT"), ("2024-05-01", "DATE")}
    for m in found:
        assert text[m.start:m.end] == m.text
    spans = sorted((m.start, m.end) for m in found)
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
    near = entities.proximity_relations(entities.extract_mentions(d, "doc_id", "text", names), d, "doc_id", "text")
    assert ("LEADS", "Tim Cook", "Apple Inc") in {(r.type, r.entity1, r.entity2) for r in near.collect()}


def test_chain_overlaps_follow_the_greedy_rule(spark):
    rng = random.Random(8)
    rows = []
    for doc in range(20):
        for _ in range(12):
            s = rng.randrange(60)
            n = rng.randrange(1, 12)
            rows.append((doc, "x" * n, "A", s, s + n, rng.randrange(5) / 5, "t"))
    rows = list(dict.fromkeys(rows))
    d = spark.createDataFrame(rows, "doc_id int, text string, label string, start int, end int, confidence double, source string")
    got = {(m.doc_id, m.start, m.end, m.confidence) for m in entities.resolve_overlaps(d).collect()}
    want = set()
    for doc in range(20):
        kept = []
        for m in sorted((r for r in rows if r[0] == doc), key=lambda r: (-r[5], -len(r[1]), r[3])):
            if all(m[4] <= k[3] or k[4] <= m[3] for k in kept):
                kept.append(m)
        want |= {(m[0], m[3], m[4], m[5]) for m in kept}
    assert got == want


def test_similar_pairs_equal_brute_force(spark):
    rng = random.Random(11)
    vecs = {}
    for i in range(60):
        v = {f"t{rng.randrange(25)}": rng.random() for _ in range(6)}
        norm = sum(x * x for x in v.values()) ** 0.5
        vecs[i] = {t: x / norm for t, x in v.items()}
    rows = [(i, t, x) for i, v in vecs.items() for t, x in v.items()]
    got = {(r.id_1, r.id_2) for r in semantic.similar_pairs(spark.createDataFrame(rows, "id bigint, term string, tfidf double"), "id", 0.5, 3).collect()}
    want = {(a, b) for a in vecs for b in vecs if a < b and round(sum(x * vecs[b].get(t, 0) for t, x in vecs[a].items()), 9) >= 0.5}
    assert got == want and want


def test_pair_candidates_bound_their_products(spark):
    rng = random.Random(5)
    vecs = {}
    for i in range(150):
        v = {f"t{rng.randrange(400)}": rng.random() + 0.1 for _ in range(rng.randrange(3, 20))} | {"common": 0.2}
        if i % 3 == 0 and i:
            v = dict(list(vecs[rng.randrange(i)].items())[1:]) | {f"t{rng.randrange(400)}": 0.3}  # shares most with another
        norm = sum(x * x for x in v.values()) ** 0.5
        vecs[i] = {t: x / norm for t, x in v.items()}
    rows = spark.createDataFrame([(i, t, x) for i, v in vecs.items() for t, x in v.items()], "id bigint, term string, tfidf double")
    dot = {(a, b): sum(x * vecs[b].get(t, 0) for t, x in vecs[a].items()) for a in vecs for b in vecs if a < b}
    for cell in (2000, 4):  # short lists, and lists cut into levels and cells
        found = {(r.id_1, r.id_2): (r.part, r.rest) for r in semantic.pair_candidates(rows, "id", 0.6, cell).collect()}
        assert all(p - 1e-9 <= dot[k] <= p + rest + 1e-9 for k, (p, rest) in found.items())
        good = {k for k, d in dot.items() if round(d, 9) >= 0.6}
        assert good and good <= set(found) and len(found) < len(dot) / 10
        assert {(r.id_1, r.id_2) for r in semantic.similar_pairs(rows, "id", 0.6, cell).collect()} == good


def test_candidates_of_a_frequent_term_are_multiplied_inside_tasks(spark):
    rng = random.Random(6)  # one term in every row: the join of its postings made a row for each of their products
    vecs = {f"d{i:03}": {"all": 0.7, f"t{i % 40}": 0.5, f"u{rng.randrange(60)}": 0.5} for i in range(120)}
    rows = spark.createDataFrame([(i, t, x) for i, v in vecs.items() for t, x in v.items()] + [("d000", None, 0.5), (None, "all", 0.9), ("d001", "t2", None)], "id string, term string, tfidf double")
    dot = {(a, b): sum(x * vecs[b].get(t, 0) for t, x in vecs[a].items()) for a in vecs for b in vecs if a < b}
    for least in (0.7, 0.0):
        found = semantic.pair_candidates(rows, "id", least, 50)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" in plan and "SortMergeJoin" not in plan and "HashAggregate" not in plan
        assert {(r.id_1, r.id_2): round(r.part + r.rest, 9) for r in found.collect()} == {k: round(d, 9) for k, d in dot.items() if d >= least}


def test_terms_beyond_a_broadcast_are_neither_salted_nor_repeated(spark, monkeypatch):
    from broadsheet.operators import features
    from broadsheet.plans import sized

    rng = random.Random(8)
    df = spark.createDataFrame([(i % 50, [f"t{int(rng.random() ** 3 * 80)}" for _ in range(rng.randrange(30))]) for i in range(60)], "id int, tokens array<string>").cache()
    options = {"max_features": None, "min_df": 1, "max_df": 1.0, "lo": 1, "hi": 1}
    want = sorted((r.id, r.term, r.tf, round(r.tfidf, 9)) for r in features.tfidf_long(df, "id", "tokens", **options).collect())
    monkeypatch.setattr(features, "SMALL_ROWS", 10)
    monkeypatch.setattr(features, "fits", lambda words: sized.fits(words, 10))
    got = features.tfidf_long(df, "id", "tokens", **options)
    assert "_salt" not in got._jdf.queryExecution().analyzed().toString()
    assert sorted((r.id, r.term, r.tf, round(r.tfidf, 9)) for r in got.collect()) == want and len(want) > 200


def clustered(rng, n, centres, width):
    mids = [[rng.gauss(0, 1) for _ in range(width)] for _ in range(centres)]
    return [(i, [c + rng.gauss(0, 0.05) for c in mids[i % centres]]) for i in range(n)]


def test_cells_find_what_the_scan_finds_and_leave_far_cells_out(spark, monkeypatch):
    from broadsheet.plans import blocks, cells
    rng = random.Random(2)
    rows = clustered(rng, 600, 24, 8)
    rows += [(1000 + i, rows[5][1]) for i in range(60)] + [(2000, [0.0] * 8), (2001, [0.0] * 8)]  # copies of one vector, and none
    items = spark.createDataFrame(rows, "id bigint, v array<double>")
    scan = {(r.query_id, r.item_id, r.rank): r.score for r in semantic.similar_items(items, items, "id", "v", 3, skip_self=True).collect()}
    monkeypatch.setattr(cells, "BLOCK_ROWS", 16)
    index = semantic.item_cells(items, "id", "v", cells=24)
    found = semantic.search_items(index, items, "id", "v", 3, skip_self=True).collect()
    assert {(r.query_id, r.item_id, r.rank) for r in found} == set(scan) and all(abs(r.score - scan[r.query_id, r.item_id, r.rank]) < 1e-9 for r in found)
    read = {r.query_id: r.cells for r in found if r.query_id < 2000}
    assert sum(read.values()) / len(read) < 12 and index.rows.sum() == len(rows)
    near = {(r.query_id, r.item_id) for r in semantic.search_items(index, items.where("id < 50"), "id", "v", 4, 0.99, True).collect()}
    assert near == {(r.query_id, r.item_id) for r in semantic.similar_items(items.where("id < 50"), items, "id", "v", 4, 0.99, True).collect()}
    monkeypatch.setattr(blocks, "BLOCK_ROWS", 20)  # more queries than may travel: the cells are used
    assert {(r.query_id, r.item_id, r.rank) for r in semantic.similar_items(items, items, "id", "v", 3, skip_self=True).collect()} == set(scan)
    assert semantic.similar_items(items, items.limit(0), "id", "v", 3).count() == 0


def test_a_query_is_repeated_per_block_not_per_cell(spark, monkeypatch):
    from broadsheet.plans import cells
    rng = random.Random(9)
    rows = spark.createDataFrame([(i, [rng.gauss(0, 1) for _ in range(16)]) for i in range(300)], "id bigint, vec array<double>")
    index = cells.build_cells(rows, 30)
    share = spark.sparkContext.broadcast(cells._Bounds(index))
    asked = cells._probes(share, rows.selectExpr("id", "vec", "CAST(NULL AS DOUBLE) AS kth"), 0, 31, None)
    assert asked.count() == 300 and asked.agg(F.sum("cells")).first()[0] == 300 * int((index.rows > 0).sum())
    first, blocks = cells._shelves(index.rows, 100)
    sizes = [sum(index.rows[first == b]) for b in range(int(first.max()) + 1)]
    assert set(blocks) == {1} and max(sizes) <= 100 and len(sizes) < 8
    first, blocks = cells._shelves([5, 250, 3, 0, 90, 10], 100)
    assert list(first) == [0, 1, 4, 4, 4, 5] and list(blocks) == [1, 3, 1, 1, 1, 1]


def test_searches_repeat_no_vector_in_a_shuffle(spark, monkeypatch):
    import numpy as np
    from broadsheet.plans import cells
    rng = random.Random(3)
    rows = [(None if i in (7, 70) else i, [rng.gauss(0, 1) for _ in range(4)]) for i in range(300)] + [(400 + i, [1.0, 2.0, 3.0, 4.0]) for i in range(90)]
    items = spark.createDataFrame(rows, "id bigint, vec array<float>")
    monkeypatch.setattr(cells, "BLOCK_ROWS", 16)
    monkeypatch.setattr(cells, "QUERY_ROWS", 40)
    index, plans, meet = cells.build_cells(items, 9), [], cells.meet
    monkeypatch.setattr(cells, "meet", lambda *a: plans.append(out := meet(*a)) or out)
    best = cells.search_cells(index, items, 2, skip_self=True)[0]
    near = cells.pairs_above(index, items, 0.9)
    assert len(plans) == 3 and index.kind == "float32"
    for df in plans:
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" in plan and not re.search("Generate|CoGroup|Broadcast|SortMergeJoin|hashpartitioning", plan)
    u = np.array([np.float32(v).astype(float) / np.linalg.norm(np.float32(v).astype(float)) for _, v in rows])
    s = np.round(u @ u.T, 9)
    ids = [i for i, _ in rows]
    assert sorted((r.query_id or -1, r.item_id or -1) for r in near.collect()) == sorted((ids[i] or -1, ids[j] or -1) for i, j in zip(*np.nonzero(s >= 0.9)))
    got = {}
    for r in best.collect():
        got.setdefault(r.query_id, set()).add(r.item_id)
    want = {q: {i for _, i in sorted((-s[a, b], -1 if i is None else i) for b, i in enumerate(ids) if i != q)[:2]} for a, q in enumerate(ids) if q is not None}
    assert {q: {-1 if i is None else i for i in x} for q, x in got.items() if q is not None} == want


def test_approximate_pairs_share_a_bucket(spark):
    """All pairs above the threshold that share a bucket of some table, found once, whatever the blocks."""
    import numpy as np
    rng = random.Random(8)
    rows = clustered(rng, 120, 12, 6) + [(500, [0.5] * 6), (501, [0.5] * 6)]
    u = {i: np.array(v) / np.linalg.norm(v) for i, v in rows if i != 501}
    good = {(a, b) for a in u for b in u if a < b and float(u[a] @ u[b]) > 0.4}
    df = spark.createDataFrame(rows, "id bigint, v array<double>")
    small = semantic.approximate_pairs(df, "id", "v", 0.4, bucket=0.2, block_rows=16).collect()
    got = {(r.id_1, r.id_2): r.score for r in small}
    assert len(got) == len(small) and set(got) < good and all(abs(s - float(u[a] @ u[b])) < 1e-9 for (a, b), s in got.items())
    wide = semantic.approximate_pairs(df, "id", "v", 0.4, bucket=2.0, tables=40, block_rows=16).collect()
    assert {(r.id_1, r.id_2) for r in wide} == good and len(wide) == len(good)
    assert {r.copies_1 for r in wide} | {r.copies_2 for r in wide} == {1, 2}


def test_whole_pairs_share_no_bucket_and_are_found(spark):
    import numpy as np
    rng = random.Random(8)
    rows = clustered(rng, 120, 12, 6) + [(500, [0.5] * 6), (501, [0.5] * 6), (None, [1.0, 0.1, 0.0, 0.0, 0.0, 0.0]), (502, [-1.0] * 6), (502, [-1.0] * 6)]
    u = {i: np.array(v) / np.linalg.norm(v) for i, v in rows if i not in (501, None)}
    good = {(a, b): float(u[a] @ u[b]) for a in u for b in u if a < b and float(u[a] @ u[b]) > 0.4} | {(500, 500): 1.0}
    df = spark.createDataFrame(rows, "id bigint, v array<double>")
    for bucket, block_rows in ((0.2, 16), (1.0, None), (0.05, 5)):
        found = semantic.approximate_pairs(df, "id", "v", 0.4, bucket=bucket, block_rows=block_rows, whole=True).collect()
        got = {(r.id_1, r.id_2): r.score for r in found}
        assert len(got) == len(found) and set(got) == set(good) and all(abs(s - good[k]) < 1e-9 for k, s in got.items())
        assert {(r.id_1, r.id_2): (r.copies_1, r.copies_2) for r in found if r.id_1 == 500} == {k: (2, 2 if k[1] == 500 else 1) for k in good if k[0] == 500}
    names = semantic.approximate_pairs(df.selectExpr("'d' || id AS id", "v"), "id", "v", 0.4, bucket=0.2, whole=True).collect()
    assert {(r.id_1, r.id_2) for r in names} == {tuple(sorted((f"d{a}", f"d{b}"))) for a, b in good}


def test_pairs_of_two_sets_equal_brute_force(spark):
    import numpy as np
    rng = random.Random(4)
    a, b = clustered(rng, 80, 6, 5), clustered(rng, 90, 9, 5)
    u, v = (np.array([x for _, x in t]) / np.linalg.norm([x for _, x in t], axis=1, keepdims=True) for t in (a, b))
    s = np.round(u @ v.T, 9)
    t = float(np.quantile(s, 0.95))
    schema = "id bigint, v array<double>"
    got = {(r.id_1, r.id_2) for r in semantic.cross_similarity(spark.createDataFrame(a, schema), spark.createDataFrame(b, schema), "id", "v", t).collect()}
    assert got == {(int(i), int(j)) for i, j in zip(*np.nonzero(s >= t))} and got


def test_terms_are_counted_where_they_lie(spark, monkeypatch):
    from collections import Counter
    from broadsheet.operators import features
    rng = random.Random(9)
    docs = [(i, [rng.choice("abcdefgh") + "é" * rng.randrange(2) for _ in range(rng.randrange(12))]) for i in range(60)] + [(100, None), (101, [])]
    df = spark.createDataFrame(docs, "id bigint, tokens array<string>")
    monkeypatch.setattr(features, "CHUNK_TOKENS", 30)
    grams = {i: Counter([*t, *(f"{x} {y}" for x, y in zip(t, t[1:]))]) for i, t in docs if t}
    stats = {r.term: (r.n_docs, r.total) for r in features.term_stats(df, "tokens", 1, 2).collect()}
    assert stats == {g: (sum(g in c for c in grams.values()), sum(c[g] for c in grams.values())) for c in grams.values() for g in c}
    top = sorted((g for g in stats if 2 <= stats[g][0] <= 0.95 * len(docs)), key=lambda g: (-stats[g][1], g))[:30]
    got = {(r.id, r.term): (r.tf, round(r.tfidf, 9)) for r in features.tfidf_long(df, "id", "tokens", max_features=30).collect()}
    want = {}
    for i, c in grams.items():
        w = {g: (1 + math.log(c[g])) * (math.log((1 + len(docs)) / (1 + stats[g][0])) + 1) for g in top if g in c}
        norm = math.sqrt(sum(x * x for x in w.values()))
        want |= {(i, g): (c[g], round(x / norm, 9)) for g, x in w.items()}
    assert got == want
    joined = {(r.id, r.term): (r.tf, round(r.tfidf, 9)) for r in features.tfidf_long(df, "id", "tokens", max_features=None).collect()}
    whole = {(r.id, r.term): (r.tf, round(r.tfidf, 9)) for r in features.tfidf_long(df, "id", "tokens", max_features=10_000).collect()}
    assert joined == whole


def test_summaries(spark):
    long = " ".join(f"Sentence number {i} speaks about topic {i % 3} with several common words." for i in range(12))
    d = spark.createDataFrame([(1, long, "g"), (2, "Too short.", "g")], "doc_id bigint, text string, k string")
    for method in ("simple", "centroid", "frequency"):
        s = one(summarize.summarize(d, "doc_id", "text", method=method))
        assert len(s["summary"]) < len(long)
        marks = [int(w) for w in s["summary"].split() if w.isdigit()][::2]
        assert marks == sorted(marks)
    heads = summarize.headlines(d, "doc_id", "text").collect()
    assert max(h["rank"] for h in heads) <= 3


def test_keyword_rules_and_bias(articles):
    assert {r.doc_id: r.keyword_category for r in lexicon.keyword_category(articles, "text").collect()}[3] == "politics"
    out = bias.detect_bias(articles).collect()
    assert all(0 <= r.bias_score <= 1 for r in out) and all(r.explanation for r in out)


def test_query_parsing(spark):
    d = spark.createDataFrame([('show me 50 "green energy" tech articles today',), ("another five positive sports stories",), ("hello",)], "q string")
    a, b, c = (r.p for r in d.select(queries.parse_query("q").alias("p")).collect())
    assert a.quantity == 20 and a.phrases == ["green energy"] and a.time_filter == "recent" and "tech" in a.categories
    assert b.quantity == 5 and b.follow_up and b.sentiments == ["positive"]
    assert c.quantity == 3
    intents = queries.classify_intent(spark.createDataFrame([("compare coverage between english and spanish",)], "q string"), "q")
    assert one(intents)["intent"] == "compare_sources"


def test_feed_parsing_and_exports(spark, tmp_path):
    xml = "<rss><channel><item><title>A title</title><link>u</link><description>&lt;p&gt;Some body text that is long enough&lt;/p&gt;</description></item><item><title> </title><description>no title here at all, dropped</description></item></channel></rss>"
    good, bad = io.parse_feed_items(spark.createDataFrame([(xml,), ("not xml",)], "x string"), "x")
    r = one(good)
    assert good.count() == 1 and r["content"] == "Some body text that is long enough" and r["timestamp"]
    nested = spark.createDataFrame([(1, [1, 2])], "`a b` int, v array<int>")
    for fmt in ("csv", "json", "xml"):
        info = one(io.export_table(nested, str(tmp_path / fmt), fmt))
        assert info["records"] == 1 and info["columns"] == 2


def test_similarity_features_with_a_reference_of_any_size(spark):
    import numpy as np
    from broadsheet.operators import semantic

    v = np.random.default_rng(3).normal(size=(40, 5))
    df = spark.createDataFrame([(i % 39, x.tolist()) for i, x in enumerate(v)], "vec_id bigint, embedding array<double>")
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    for n in (24, 25):
        s = u @ u[:n].T
        ref = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v[:n])], "vec_id bigint, embedding array<double>")
        got = sorted(tuple(round(x, 9) for x in r) for r in semantic.similarity_features(df, ref, "vec_id", "embedding", max_reference=20).collect())
        assert got == sorted((i % 39, *(round(float(x), 9) for x in (s[i].max(), s[i].mean(), s[i].std(), np.median(s[i])))) for i in range(40))


def test_medians_and_group_similarity_equal_brute_force_in_few_bounded_rounds(spark, monkeypatch):
    import numpy as np
    from broadsheet.operators import semantic
    from broadsheet.plans import blocks

    monkeypatch.setattr(blocks, "BLOCK_ROWS", 16)
    monkeypatch.setattr(semantic, "CHUNK_ROWS", 5)
    for name, value in (("GATHERED", 6), ("GUESS_ROWS", 128)):
        monkeypatch.setattr(semantic, name, value)
    rounds, crossed = [], blocks.meet
    monkeypatch.setattr(semantic, "meet", lambda *a: rounds.append(1) or crossed(*a))
    rng = np.random.default_rng(8)
    v = rng.normal(size=(300, 6))
    v[200:240] = v[7]  # copies: many equal cosines
    v[240:270] = -v[7]
    v[270:273] = 0
    df = spark.createDataFrame([(i // 2, x.tolist(), "abc"[i % 3] if i % 10 else None) for i, x in enumerate(v)], "vec_id bigint, embedding array<double>, g string")
    u = v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-300)
    s = u @ u.T
    got = sorted(tuple(round(x, 8) for x in r) for r in semantic.similarity_features(df, df, "vec_id", "embedding", max_reference=20).collect())
    want = sorted((i // 2, *(round(float(x), 8) for x in (s[i].max(), s[i].mean(), s[i].std(), np.median(s[i])))) for i in range(300))
    assert np.abs(np.array(got) - np.array(want)).max() < 3e-8 and len(rounds) < 12
    rounds.clear()
    got = {(r.group_1, r.group_2): r for r in semantic.group_similarity(df, "g", "vec_id", "embedding").collect()}
    group = np.array(["abc"[i % 3] if i % 10 else "" for i in range(300)])
    assert len(rounds) == 1 and set(got) == {("a", "b"), ("a", "c"), ("b", "c")}
    for (a, b), r in got.items():
        x = s[np.ix_(group == a, group == b)].ravel()
        assert r.pairs == len(x)
        for name, value in (("min", x.min()), ("max", x.max()), ("mean", x.mean()), ("q25", np.quantile(x, 0.25)), ("median", np.median(x)), ("q75", np.quantile(x, 0.75)), ("std", x.std())):
            assert abs(r[name] - value) < 2e-6, name


@pytest.mark.parametrize("shard", [200_000, 4])
def test_names_of_any_number_of_words_equal_brute_force(spark, shard):
    import re
    rng = random.Random(12)
    vocabulary = ["north", "South", "bank", "of", "the", "Straße", "O'Neil", "x-1", "é", "日本"]
    names = sorted({" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(1, 8))) for _ in range(12)} | {"bank of the North", "Bank Of", "of the north south bank of the x-1"})
    texts = [(i, "".join(rng.choice(vocabulary) + rng.choice([" ", ", ", "\n", " -> "]) for _ in range(rng.randrange(60)))) for i in range(40)]
    texts += [(90, "the Bank OF THE north; of the north south bank of the X-1"), (91, ""), (92, None)]
    labels = {n.lower(): "L" + str(len(n) % 3) for n in names}
    want = set()
    for i, t in texts:
        w = list(re.finditer(r"[\w'-]+", t or ""))
        for a in range(len(w)):
            for b in range(a, len(w)):
                label = labels.get(" ".join(m[0] for m in w[a:b + 1]).lower())
                if label:
                    want.add((i, " ".join(m[0] for m in w[a:b + 1]), label, w[a].start(), w[b].end()))
    gazetteer = spark.createDataFrame([(n, "L" + str(len(n) % 3)) for n in names] + [("", "none")], "name string, label string")
    got = entities.gazetteer_mentions(spark.createDataFrame(texts, "id bigint, text string"), "id", "text", gazetteer, shard_names=shard)
    assert {tuple(r)[:5] for r in got.collect()} == want and any(len(x[1].split()) > 4 for x in want)
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()


def test_explained_values_are_those_of_the_fitted_vectors(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array
    from broadsheet.operators import features
    rng = random.Random(3)
    df = spark.createDataFrame([(i, [rng.choice("abcdefg") for _ in range(rng.randrange(1, 15))]) for i in range(40)], "id bigint, tokens array<string>")
    model = features.fit_tfidf(df.where("id < 30"), "id", "tokens", max_features=5, lo=1, hi=1, sub=False)
    names = features.vocabulary_list(model)
    vectors = Pipeline(stages=features.vector_stages(model, "tokens")).fit(df).transform(df).select("id", vector_to_array("features").alias("v")).collect()
    want = {(r.id, t): round(x, 9) for r in vectors for t, x in zip(names, r.v) if x}
    assert {(r.id, r.term): round(r.tfidf, 9) for r in model.transform(df, "id", "tokens").collect()} == want


def test_cooccurrence_of_all_names_equals_brute_force(spark):
    from collections import Counter
    from itertools import combinations
    from broadsheet.catalog import entity_graph

    sf = "/root/testdata/sf0.001"
    names = {}
    for row in entity_graph.mentions(spark, sf).select("doc_id", "text").collect():
        names.setdefault(row.doc_id, set()).add(row.text)
    want = Counter(pair for texts in names.values() for pair in combinations(sorted(texts), 2))
    got = {(x.entity_1, x.entity_2): x.weight for x in entity_graph.a12_whole(spark, sf).collect()}
    assert got == {pair: n for pair, n in want.items() if n >= 2} and any(len(a) < 8 for a, _ in got) and 2 in got.values()


def test_cooccurrence_in_blocks_equals_brute_force(spark, monkeypatch):
    from collections import Counter
    from itertools import combinations

    rng = random.Random(4)
    rows = [(rng.choice([None, *range(30)]), rng.choice([None, "Ä", "ä", "z", "Zürich", *(f"n{i}" for i in range(15))])) for _ in range(600)]
    names = {}
    for doc, name in rows:
        if doc is not None and name is not None:
            names.setdefault(doc, set()).add(name)
    counts = Counter(p for x in names.values() for p in combinations(sorted(x, key=str.encode), 2))
    df = spark.createDataFrame(rows, "doc_id int, text string")
    for most, coded in ((7, 0), (1 << 22, 200_000)):  # pairs in small blocks, codes joined by shuffles; all at once, codes broadcast
        monkeypatch.setattr(relational, "PAIRS", most)
        monkeypatch.setattr(relational, "CODED_NAMES", coded)
        for least in (1, 12):
            got = relational.entity_cooccurrence(df, least)
            assert got.columns == ["entity_1", "entity_2", "weight"]
            assert sorted(tuple(r) for r in got.collect()) == sorted((*p, n) for p, n in counts.items() if n >= least) and max(counts.values()) >= 12
    assert relational.entity_cooccurrence(df.where("false")).collect() == []


def test_weights_by_corpus_equal_brute_force_without_a_row_per_document_and_term(spark, monkeypatch):
    from collections import Counter

    from broadsheet.operators import features

    monkeypatch.setattr(features, "CHUNK_TOKENS", 40)  # rows are met in many runs
    sizes = []
    keep = features.materialize
    monkeypatch.setattr(features, "materialize", lambda df: sizes.append((out := keep(df)).count()) or out)
    rng = random.Random(5)
    rows = [(rng.choice(["en", "de", None]), rng.choice([None, *range(25)]), [rng.choice("abcdefghij") for _ in range(rng.randrange(30))]) for _ in range(60)] + [("en", 3, None), ("en", 99, [])]
    for fits in (True, False):
        if not fits:
            monkeypatch.setattr(features, "fits", lambda df: False)
        sizes.clear()
        got = features.tfidf_by_corpus(spark.createDataFrame(rows, "lang string, id int, tokens array<string>").repartition(5), "lang", "id", "tokens", 12)
        got = {(r.lang, r.id, r.term): (r.tf, round(r.tfidf, 9)) for r in got.collect()}
        assert max(sizes) == len(rows)
        tf, n = Counter(), Counter()
        for lang, i, t in rows:
            n[lang] += 1
            for term in [*(t or []), *(f"{a} {b}" for a, b in zip(t or [], (t or [])[1:]))]:
                tf[lang, i, term] += 1
        want = {}
        for lang in ("en", "de"):
            own = {k[1:]: c for k, c in tf.items() if k[0] == lang}
            df, total = Counter(t for _, t in own), Counter()
            for (_, t), c in own.items():
                total[t] += c
            best = sorted((t for t in df if 2 <= df[t] <= 0.8 * n[lang]), key=lambda t: (-total[t], t))[:12]
            w = {(i, t): c * (math.log((1 + n[lang]) / (1 + df[t])) + 1) for (i, t), c in own.items() if t in best}
            norm = Counter()
            for (i, _), x in w.items():
                norm[i] += x * x
            want |= {(lang, i, t): (own[i, t], round(x / math.sqrt(norm[i]), 9)) for (i, t), x in w.items()}
        assert got == want and any(i is None for _, i, _ in got)


def test_weights_within_documents_equal_brute_force(spark, monkeypatch):
    import math
    import random
    from collections import Counter

    from broadsheet.operators import features

    monkeypatch.setattr(features, "CHUNK_TOKENS", 40)  # documents are met in many runs, and lie across batches
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    rng = random.Random(5)
    rows = [(d, p, [rng.choice("abcdefgé") for _ in range(rng.randrange(6))]) for d in (None, *range(40)) for p in range(rng.randrange(9))]
    rows += [rows[20], rows[30], (99, 0, []), (99, 1, None)]  # sentences that come twice, and a document without words
    try:
        for most in (None, 3):
            frame = features.tfidf_within(spark.createDataFrame(rows, "d bigint, p int, t array<string>"), "d", "p", "t", most)
            assert "Window" not in frame._jdf.queryExecution().executedPlan().toString()  # exploded terms are not sorted again for each step
            got = {(r.d, r.p, r.term): r for r in frame.collect()}
            want, firsts = {}, Counter(r.d for r in got.values() if r.first)
            for d in {r[0] for r in rows if r[0] is not None}:
                own = [r for r in rows if r[0] == d]
                tf = Counter((p, w) for _, p, t in own for w in t or [])
                df, total = Counter(w for _, w in tf), Counter(w for _, _, t in own for w in t or [])
                kept = sorted(total, key=lambda w: (-total[w], w))[:most]
                raw = {k: n * (math.log((1 + len(own)) / (1 + df[k[1]])) + 1) for k, n in tf.items() if k[1] in kept}
                unit = {(p, w): x / math.sqrt(sum(y * y for (q, _), y in raw.items() if q == p)) for (p, w), x in raw.items()}
                want |= {(d, p, w): (tf[p, w], x, sum(y for (_, v), y in unit.items() if v == w)) for (p, w), x in unit.items()}
                assert firsts[d] == len({w for _, w in unit})
            assert got.keys() == want.keys()
            assert all(got[k].tf == n and abs(got[k].tfidf - x) < 1e-9 and abs(got[k].centre - c) < 1e-9 for k, (n, x, c) in want.items())
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_topic_usage_reads_the_topics_once(spark):
    from broadsheet.operators import topics
    rows = [(1, [0.5, 0.5, 0.0]), (2, [0.1, 0.2, 0.7]), (3, None), (4, [None, None, None]), (5, [0.0, 0.0, 1.0])]
    out = topics.topic_usage(spark.createDataFrame(rows, "id int, topics array<double>").withColumn("topics", F.reverse("topics")), 4)
    assert {r.topic: (round(r.mean_probability, 9), r.documents) for r in out.collect()} == {0: (round(1.7 / 3, 9), 2), 1: (round(0.7 / 3, 9), 1), 2: (0.2, 0), 3: (0.0, 0)}
    assert optimized(out).count("reverse(") == 1


def test_vowel_shares_search_a_text_once_per_letter(spark):
    from broadsheet.catalog.topic_models import mix
    df = mix(spark.createDataFrame([(1, "Aeea x"), (2, "xyz"), (3, None)], "doc_id int, text string"))
    assert [tuple(r.topics) for r in df.orderBy("doc_id").collect()] == [(0.5, 0.5, 0.0, 0.0, 0.0), (0.0,) * 5, (None,) * 5]
    assert optimized(df.select(F.array_max("topics"), F.array_position("topics", F.array_max("topics")))).count("lower(text") == 1


def test_bias_scores_cut_a_text_into_words_once_per_score(spark):
    from broadsheet.operators import bias
    from broadsheet.operators.sentiment import compound_of, valences
    df = spark.createDataFrame([(1, "Great great awful plain words here"), (2, ""), (3, None)], "doc_id int, text string")
    out = bias.lexical_bias(df, "text", ["great"], ["awful"])
    assert [(r.emotional_ratio, round(r.sentiment_skew, 9)) for r in out.where("text <> ''").collect()] == [(0.5, round(1 / 6, 9))]
    assert optimized(out.select("lexical_score")).count("split(") == 1
    assert optimized(bias.linguistic_bias(df, "text").select("linguistic_score")).count("split(") == 1
    tokens = df.where("doc_id = 1").select(F.split(F.lower("text"), " ").alias("t"))
    scored = tokens.select(compound_of(valences(F.reverse("t"), {"great": 2.0, "awful": -3.0}, [])).alias("c"))
    assert optimized(tokens.select(compound_of(F.reverse("t").cast("array<double>")).alias("c"))).count("reverse(") == 1
    total, p, n, z = 1.0, 6.0, 4.0, 3.0
    assert [round(x, 9) for x in scored.first().c] == [round(x, 9) for x in (total / (total + 15) ** 0.5, p / (p + n + z), n / (p + n + z), z / (p + n + z))]


def test_extraction_stats_find_mentions_and_relations_once(spark):
    from broadsheet.operators import entities
    texts = spark.range(4)
    mentions = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "x string").select(F.reverse("x").alias("label"))
    none = spark.createDataFrame([], "type string")
    out = entities.extraction_stats(texts, mentions, none)
    assert sorted((r.metric or "", r.value) for r in out.collect()) == [("", 1.0), ("entities", 4.0), ("entities_per_text", 1.0), ("entity:a", 2.0), ("entity:b", 1.0), ("relations", 0.0), ("relations_per_text", 0.0), ("texts", 4.0)]
    assert "reverse(" not in optimized(out)  # only kept counts are read
