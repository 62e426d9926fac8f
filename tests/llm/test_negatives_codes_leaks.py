"""Hard negatives, vector codes and decontamination against brute force, and on nulls, ties, repeated rows, empty tables and clashing names."""

import hashlib
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from broadsheet.llm import catalog, codes, decontaminate, negatives, vectors

NAN, INF = float("nan"), float("inf")
CLASH = "id string, vector string, anchor string, part string, salt string, key string, block string, score string"


def vector_rows(spark, rows):
    return spark.createDataFrame([(*r, *["x"] * 8) for r in rows], "vec_id long, label int, embedding array<float>, " + CLASH)


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def whole(v, scale):
    return [math.floor(scale * float(np.float32(x))) for x in v]


# 11 ----------------------------------------------------------------------------------------------

def mined(rows, n=5, percent=80):
    used = [(i, y, whole(v, 256)) for i, y, v in rows if i is not None and y is not None and usable(v)]
    out = []
    for a, label, u in used:
        if a % 100:
            continue
        s = sorted((-sum(x * y for x, y in zip(u, v)), i, y == label) for i, y, v in used if i != a)
        for down, p, _ in [x for x in s if x[2]][:n]:
            fit = [x for x in s if not x[2] and percent * -down <= 100 * -x[0] <= 100 * -down][:n]
            out += [(a, p, k, i, -down, -d) for k, (d, i, _) in enumerate(fit, 1)]
    return sorted(out)


def random_vectors(n, seed, width=8, labels=3, step=1):
    rnd = random.Random(seed)
    centres = [[rnd.gauss(0, 1) for _ in range(width)] for _ in range(labels)]
    return [(i * step, (y := rnd.randrange(labels)), [round(c + rnd.gauss(0, 1.5), 1) for c in centres[y]]) for i in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_hard_negatives_equal_brute_force(spark, seed):
    rows = random_vectors(900, seed)
    rows += [(10_000 + i, seed % 3, rows[7][2]) for i in range(300)]  # copies of one vector
    rows += [(20_000 + i, 9, rows[100][2]) for i in range(40)]  # negatives that tie
    got = negatives.mine(vector_rows(spark, rows).repartition(7), F.col("vec_id") % 100 == 0)
    expected = mined(rows)
    assert sorted(map(tuple, got.collect())) == expected and len(expected) > 100


def test_hard_negatives_with_blocks_of_few_rows(spark, monkeypatch):
    monkeypatch.setattr(negatives, "BLOCK", 64)
    monkeypatch.setattr(negatives, "HELD", 3)
    rows = random_vectors(700, 3)
    assert sorted(map(tuple, negatives.mine(vector_rows(spark, rows), F.col("vec_id") % 100 == 0).collect())) == mined(rows)


def test_anchors_are_neither_repeated_nor_broadcast(spark):
    rows = vector_rows(spark, random_vectors(400, 4)).selectExpr("vec_id AS id", "CAST(label AS long) AS label", "embedding AS vector")
    blocks = negatives._packed(rows, 256).withColumn("block", F.monotonically_increasing_id()).cache()
    anchors = negatives._packed(rows.where("id % 100 = 0").repartition(3), 256).selectExpr("ids AS a_ids", "n AS a_n").cache()
    met = negatives._met(blocks, anchors)
    plan = met._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and not re.search("Broadcast|Generate|SortMergeJoin", plan)
    assert anchors.count() > 1 and met.count() == met.rdd.getNumPartitions() == blocks.count() * anchors.count()
    assert met.select("ids", "a_ids").distinct().count() == met.count()


def test_hard_negatives_of_odd_rows(spark):
    rows = [(0, 1, [1.0, 0.5]), (1, 1, [1.0, 0.25]), (2, 2, [0.9, 0.5]), (3, 2, [0.9, 0.5]), (2, 2, [0.9, 0.5]), (4, None, [1.0, 1.0]), (5, 2, None), (6, 2, [NAN, 1.0]), (7, 2, [INF, 1.0]), (8, 2, [None, 1.0]),
            (None, 2, [1.0, 0.4]), (9, 3, [0.8]), (10, 3, []), (100, 7, [1.0, 1.0]), (200, 2, [-1.0, -1.0]), (300, 4, [0.0, 0.0]), (301, 4, [0.0, 0.0]), (302, 5, [0.0, 0.0])]
    got = sorted(map(tuple, negatives.mine(vector_rows(spark, rows), F.col("vec_id") % 100 == 0).collect()))
    assert got == mined(rows) and (300, 301, 1, 0, 0, 0) in got
    assert negatives.mine(vector_rows(spark, rows[1:3]), F.col("vec_id") % 100 == 0).count() == 0
    assert negatives.mine(vector_rows(spark, []), F.col("vec_id") % 100 == 0).columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    other = negatives.mine(vector_rows(spark, rows), F.col("vec_id") == 0, positives=1, negatives=1, percent=50).collect()
    assert [(r.positive_id, r.negative_id, r["rank"]) for r in other] == [(1, 9, 1)]  # the scores of 2 and 3 are above the positive's


def test_scores_are_exact_for_any_size():
    a, b = np.array([[2.0**40, 3.0]]), np.array([[2.0**13, 7.0], [2.0**52, 1.0]])
    assert negatives.scores(a, b).tolist() == [[2**53 + 21, (1 << 63) - 1]]
    assert [negatives.lowest(p, 80) for p in (0, 1, 5, 6, 2**60)] == [0, 1, 4, 5, -(-(80 * 2**60) // 100)]


# 12 ----------------------------------------------------------------------------------------------

def coded(rows, parts=4, entries=256, rounds=4):
    used = sorted(((i is None, i or 0, v), i, y) for i, y, v in rows if usable(v))
    width = -(-max((len(v) for _, _, v in rows if usable(v)), default=1) // parts)
    ints = [(whole(k[2], 1024) + [0] * (width * parts))[:width * parts] for k, _, _ in used]
    pieces = [[v[p * width:(p + 1) * width] for v in ints] for p in range(parts)]
    books = [[list(x) for x in pieces[p][:entries]] for p in range(parts)]
    near = lambda x, book: min((sum((a - b) ** 2 for a, b in zip(x, c)), k) for k, c in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            at = [near(x, books[p])[1] for x in pieces[p]]
            for k in set(at):
                own = [x for x, y in zip(pieces[p], at) if y == k]
                books[p][k] = [sum(c) // len(own) for c in zip(*own)]
    best = [[near(pieces[p][r], books[p]) for p in range(parts)] for r in range(len(used))]
    error = [sum(d for d, _ in b) for b in best]
    label = [sum(e for e, (_, _, z) in zip(error, used) if z == y) for _, _, y in used]
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    key = lambda t: tuple((x is None, x or 0) for x in t)
    return sorted(((i, "".join(f"{k:02x}" for _, k in b), e, s, digest) for (_, i, _), b, e, s in zip(used, best, error, label)), key=key)


def coded_rows(df):
    return sorted((tuple(r)[:5] for r in df.collect()), key=lambda t: tuple((x is None, x or 0) for x in t))


@pytest.mark.parametrize("width, entries", [(8, 16), (10, 256), (3, 5)])
def test_codes_equal_brute_force(spark, width, entries):
    rows = random_vectors(300, width, width=width)
    assert coded_rows(codes.compress(vector_rows(spark, rows).repartition(5), entries=entries)) == coded(rows, entries=entries)


def test_codes_of_odd_rows(spark):
    rows = [(0, 1, [1.0, 0.5, -0.3]), (1, 1, [1.0, 0.25, -0.0004]), (1, 1, [1.0, 0.25, -0.0004]), (2, None, [0.9, 0.5, 2.0, 7.5, -1.1]), (3, None, [0.9, 0.5]), (4, 2, None), (5, 2, [NAN]), (6, 2, [INF]), (7, 2, [None, 1.0]),
            (None, 2, [1.0, 0.4]), (8, 3, []), (9, 3, [1e5, -3e5, 4.0])]
    got = coded_rows(codes.compress(vector_rows(spark, rows), entries=3))
    assert got == coded(rows, entries=3) and len(got) == 8
    assert codes.compress(vector_rows(spark, rows[5:8])).count() == 0 and codes.compress(vector_rows(spark, [])).count() == 0
    with pytest.raises(ValueError):
        codes.compress(vector_rows(spark, rows), entries=257)


def test_transform_keeps_distances_and_orders_by_sequency():
    rnd = np.random.default_rng(4)
    a, b = rnd.integers(-900, 900, (40, 11)), rnd.integers(-900, 900, (40, 11))
    assert (((codes.walsh(a) - codes.walsh(b)) ** 2).sum(1) == 16 * ((a - b) ** 2).sum(1)).all()
    rows = codes.walsh(np.eye(16, dtype=np.int64)).T
    assert ((np.diff(rows, axis=1) != 0).sum(1) == np.arange(16)).all()
    book = np.concatenate([b, b[:5]])  # equal entries: the lower index is taken
    index, distance = codes.nearest(a, book)
    full = ((a[:, None] - book[None]) ** 2).sum(2)
    assert (index == full.argmin(1)).all() and (distance == full.min(1)).all()
    wide = codes.nearest(a.astype(object) * 2**40, book.astype(object) * 2**40)
    assert (wide[0] == index).all() and wide[1].tolist() == [int(d) << 80 for d in distance]


def test_vectors_scale_down_and_saturate():
    m = vectors.scaled(pa.array([[0.5, -0.0001], [1e300], []], pa.list_(pa.float64())), 1024)
    assert m.tolist() == [[512.0, -1.0], [2.0**53, 0.0], [0.0, 0.0]]


# 13 ----------------------------------------------------------------------------------------------

def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def leaks(docs, items, size=10):
    wanted = {}
    for i, text in items:
        w = words(text)
        for k in range(max(len(w) - size, 0) + 1 if w else 0):
            wanted.setdefault(tuple(w[k:k + size]), set()).add(i)
    sizes, out = {len(k) for k in wanted}, []
    for d, text in docs:
        w, hit, found = words(text), set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if ids := wanted.get(tuple(w[k:k + n])):
                    hit.update(range(k, k + n))
                    found |= ids
        found = sorted(str(i) for i in found if i is not None)
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(",".join(found).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def judged(docs, items):
    found = decontaminate.contaminated(docs, items)
    digest = F.sha2(F.array_join("items", ","), 256)
    return sorted((tuple(r) for r in found.select("doc_id", "n_words", "n_hit", "n_items", digest, F.col("n_hit") > 0).collect()), key=repr)


DOCS, ITEMS = "doc_id long, text string, row string, hash string, window string, at string", "item_id long, text string, hash string, window string"


def test_decontamination_equals_brute_force(spark):
    rnd = random.Random(8)
    vocabulary = [f"w{i}" for i in range(6)] + ["Ünï", "日本語", "x9", "A"]
    text = lambda n: " ".join(rnd.choice(vocabulary) + rnd.choice(["", "", ",", ".\n", "'"]) for _ in range(n))
    items = [(i, text(rnd.choice([1, 2, 3, 5, 9, 10, 11, 30]) if i % 4 == 0 else rnd.randint(9, 40))) for i in range(60)] + [(3, text(25)), (None, text(12)), (None, None), (900, ""), (901, " .,- ")]
    items = [(i, t) for i, t in items if i is None or i > 4 or len(words(t)) > 2]  # a lone common word would hit every document
    docs = []
    for d in range(160):
        parts = [text(rnd.randint(0, 50)) for _ in range(3)]
        if d % 2:
            w = words(rnd.choice(items)[1])
            a = rnd.randint(0, max(0, len(w) - 12))
            parts.insert(rnd.randint(0, 2), " ".join(x.upper() if rnd.random() < 0.2 else x for x in w[a:a + rnd.randint(8, 30)]))
        docs.append((d // 2, rnd.choice([" ", "; ", "\n"]).join(parts)))
    docs += [(None, None), (None, ""), (7, docs[3][1]), (7, docs[3][1]), (8, " ".join(f"u{i}" for i in range(5000)) + " " + items[-6][1] * 3), (9, "tiny")]
    got = judged(spark.createDataFrame([(*d, *"abcd") for d in docs], DOCS).repartition(5), spark.createDataFrame([(*i, "a", "b") for i in items], ITEMS))
    assert got == leaks(docs, items) and 20 < sum(r[5] for r in got) < len(docs)


def test_decontamination_spans_and_empty_tables(spark):
    passage = " ".join(f"p{i}" for i in range(14))
    docs = [(1, f"lead {passage} mid {passage}"), (2, " ".join(f"p{i}" for i in range(9))), (3, f"{passage[:-4]}x p13")]
    d, i = spark.createDataFrame([(*x, *"abcd") for x in docs], DOCS), spark.createDataFrame([(5, passage, "a", "b"), (6, passage, "a", "b")], ITEMS)
    got = {r.doc_id: r for r in decontaminate.contaminated(d, i).collect()}
    assert [tuple(s) for s in got[1].spans] == [(1, 15), (16, 30)] and got[1].n_hit == 28 and got[1]["items"] == ["5", "6"]
    assert got[2].n_hit == 0 and [tuple(s) for s in got[3].spans] == [(0, 12)]
    assert [r.n_hit for r in decontaminate.contaminated(d, i.limit(0)).collect()] == [0, 0, 0]
    assert decontaminate.contaminated(d.limit(0), i).count() == 0


def test_decontamination_joins_where_windows_were_not_counted_few(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "attach", lambda big, small, on, by, how="inner": __import__("broadsheet.plans.sized", fromlist=["salted_join"]).salted_join(big, small, on, by, how))
    docs, items = spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    assert judged(docs, items) == leaks([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])


def test_filter_rejects_nothing_that_it_holds(spark):
    hashes = np.random.default_rng(2).integers(-2**63, 2**63 - 1, 3000)
    f = decontaminate.Filter.of(spark.createDataFrame([(int(h),) for h in hashes], "hash long"))
    assert len(f.passing(hashes.view(np.uint64))) == 3000
    others = np.random.default_rng(3).integers(-2**63, 2**63 - 1, 100_000).view(np.uint64)
    assert len(f.passing(others)) < 300


def test_new_queries_are_registered():
    assert {"op11_hard_negatives", "op12_vector_codes", "op13_decontaminate"} <= set(catalog.QUERIES) & set(catalog.SQL)
