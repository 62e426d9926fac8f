"""The corpus operators against brute force, and on nulls, empty and long texts, ties, repeated rows, empty tables and clashing names."""

import hashlib
import html as entities
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from broadsheet.llm import catalog, exact, html, minhash, packing, pieces, pii, quality, repeats, tokenfile, warc
from broadsheet.llm.common import shared_path, stored
from broadsheet.llm.tokens import Encoder, default_vocabulary

SF = "/root/testdata/sf0.001"
WORD = r"[^ \t-\r]+"
#: Names that the operators use inside.
CLASH = ", key string, row string, id string, text2 string, digest string, node string, words string"


def odd_docs(spark):
    long = " ".join(f"w{i % 977}x{i}" for i in range(20_000))
    rows = [(5, "Equal  text here\tyes", "en"), (3, "Equal text here yes", "en"), (3, "Equal text here yes", "en"), (9, None, None), (8, "", "en"), (None, "Equaltexthereyes", "en"),
            (7, long, "en"), (6, long + " end", "en"), (1, " \n\t ", "de"), (2, "x", "xx"), (None, None, None), (4, "😀 a\x00b <|endoftext|>", "en")]
    schema = "doc_id long, text string, lang string" + CLASH
    return spark.createDataFrame([(*r, *["k"] * 7) for r in rows], schema)


def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string" + CLASH)


def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


# 1 -----------------------------------------------------------------------------------------------

def all_segmentations(p, text):
    m = pieces.SPACE_MARK + text.replace(" ", pieces.SPACE_MARK)

    def rec(i):
        if i == len(m):
            return [(0.0, ())]
        out, single = [], False
        for j in range(i + 1, min(len(m), i + 16) + 1):
            if e := p.edges.get(m[i:j]):
                out += [(e[1] + s, (e[0], *t)) for s, t in rec(j)]
                single |= j == i + 1
        return out if single else out + [(p.unknown + s, (*(p.bytes[b] for b in m[i].encode()), *t)) for s, t in rec(i + 1)]

    return rec(0)


def test_n_best_is_the_best_of_all_segmentations():
    p, rnd = pieces.Pieces(pieces.default_model()), random.Random(1)
    texts = ["".join(rnd.choice(["a", "th", "e", "in", " ", "  ", "é", "☃", "\n", "s", ". "]) for _ in range(rnd.randint(1, 6))) for _ in range(80)]
    for text, (best, decoded) in zip(texts, p.encode(pa.array(texts), 4)):
        every = all_segmentations(p, text)
        assert decoded and [round(s, 6) for s, _ in best] == [round(s, 6) for s, _ in sorted(every, reverse=True)[:4]]
        assert {tuple(i.tolist()) for _, i in best} <= {i for _, i in every} and len({tuple(i.tolist()) for _, i in best}) == len(best)
        assert all(p.decode(i) == text for _, i in best)


def test_n_best_odd_rows(spark):
    rows = pieces.n_best(odd_docs(spark), n=2, keep_ids=True)
    back = {(r.doc_id, r.text) for r in pieces.decode(rows.where("rank = 1")).collect()}
    assert back == {(r.doc_id, r.text or "") for r in odd_docs(spark).collect()}
    assert pieces.n_best(no_docs(spark)).count() == 0
    with pytest.raises(ValueError):
        pieces.n_best(no_docs(spark), n=0)


# 2 -----------------------------------------------------------------------------------------------

def test_exact_groups_odd_rows(spark):
    got = {}
    for r in exact.exact_groups(odd_docs(spark)).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert len(sum(got.values(), [])) == 12
    # four equal rows: the longest stays; empties and nulls are one group, the one with most code points stays
    assert [(r.keep_id, r.group_size, r.kept) for r in got[5]] == [(5, 4, True)]
    assert sorted((r.keep_id, r.group_size, r.kept) for r in got[3]) == [(5, 4, False)] * 2
    assert [(r.keep_id, r.group_size, r.kept, r.text_sha256) for r in got[1]] == [(1, 4, True, hashlib.sha256(b"").hexdigest())]
    assert exact.exact_groups(no_docs(spark)).count() == 0
    kept = exact.drop_exact(odd_docs(spark))
    assert kept.columns == odd_docs(spark).columns and kept.count() == 6
    twice = spark.createDataFrame([(1, "a b"), (1, "a b"), (1, "ab")], "doc_id long, text string")
    assert [r.text for r in exact.drop_exact(twice).collect()] == ["a b"]


# 3 -----------------------------------------------------------------------------------------------

def shingles(text, size):
    w = re.findall(WORD, lower(text or ""))
    return frozenset(zip(*[w[i:] for i in range(size)])) if len(w) >= size else frozenset([tuple(w)] if w else [])


def near_brute(docs, size, percent):
    sets, parent = {d: shingles(t, size) for d, t in docs}, {d: d for d, _ in docs}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in ids}


def test_near_groups_equal_brute_force(spark):
    rnd = random.Random(7)
    base = [" ".join(f"t{rnd.randint(0, 5000)}" for _ in range(120)) for _ in range(4)]
    rows = []
    for i in range(160):  # chains and stars of edited copies, some only similar by way of others
        words = (rnd.choice(base) if i % 5 else rows[rnd.randrange(len(rows))][1] if rows else base[0]).split()
        for _ in range(rnd.randint(0, 9)):
            words[rnd.randrange(len(words))] = f"e{rnd.randint(0, 10**6)}"
        rows.append((i, " ".join(words)))
    rows += [(900, ""), (901, None), (902, "one"), (903, "ONE"), (904, " ")]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_groups(spark.createDataFrame(rows, "doc_id long, text string"), size=2).collect()}
    assert got == near_brute(rows, 2, 80)


def test_near_groups_of_a_chain_of_growing_copies(spark):
    rnd = random.Random(11)
    words, rows = [f"t{rnd.randint(0, 10**6)}" for _ in range(900)], []
    for i in range(60):  # each is the beginning of the next, and similar to the next ones only
        size = int(60 * 1.045 ** i)
        rows.append(((i * 37) % 60, " ".join(words[:size])))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_groups(spark.createDataFrame(rows, "doc_id long, text string"), size=1).collect()}
    assert got == near_brute(rows, 1, 80)


def test_near_groups_of_a_hot_bucket(spark, monkeypatch):
    """Copies of one text with few to many changes: some link to others only by way of a third, some to none; and a second family."""
    monkeypatch.setattr(minhash, "BLOCK", 16)
    monkeypatch.setattr(minhash, "PROPOSALS", 1)
    rnd = random.Random(12)
    rows = []
    for family in range(2):
        base = [f"f{family}w{i}" for i in range(120 + 200 * family)]
        for i in range(60):
            words = [f"x{rnd.randint(0, 60)}" if rnd.random() < (i % 15) / 100 else w for w in base]
            rows.append((family * 100 + i, " ".join(words[:len(words) - rnd.randint(0, 6)])))
    want = near_brute(rows, 2, 80)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_groups(spark.createDataFrame(rows, "doc_id long, text string"), size=2).collect()}
    assert got == want and 4 < len({c for _, c in want.values()}) < 100


def test_parity_bitmaps_bound_the_difference():
    rnd = np.random.default_rng(3)
    for n in (1, 7, 100, 300, 40_000):
        a = rnd.integers(0, 2**63, n).astype(np.uint64)
        for changed in (0, 1, n // 5, n):
            b = np.concatenate([a[changed:], rnd.integers(0, 2**63, changed + n // 4).astype(np.uint64)])
            differ = minhash.differing(minhash.parity_bitmap(a), minhash.parity_bitmap(b))
            apart = len(np.setxor1d(a, b))
            assert differ <= apart and (differ - apart) % 2 == 0 and (apart > n or n > 1000 or differ >= 0.7 * apart)


def test_only_rows_that_a_join_may_need_are_shuffled_and_components_merge(spark):
    texts = spark.createDataFrame([(i, "x" * 50) for i in range(5000)] + [(None, "none")], "id long, text string")
    wanted = spark.createDataFrame([(7,), (4000,), (None,), (9999,)], "low long")
    few = minhash._among(texts, "id", wanted)
    assert few.columns == ["id", "text"] and {7, 4000, None} <= {r.id for r in few.collect()} and few.count() < 20
    rng = random.Random(6)
    links = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)]
    links = [(min(x), max(x)) for x in links if x[0] != x[1]]
    frame = lambda x: spark.createDataFrame(x, "a long, b long")
    want = {r.node: r.comp for r in minhash.components(frame(links)).collect()}
    comps = minhash.components(frame(links[:15]))
    for part in (links[15:30], [], links[30:]):
        comps = minhash._merged(comps, frame(part))
    assert sorted((r.node, r.comp) for r in comps.collect()) == sorted(want.items())


def test_near_groups_odd_rows(spark):
    got = minhash.near_groups(odd_docs(spark)).collect()
    assert len(got) == 12 and all(r.component_id == r.doc_id for r in got if r.n_shingles == 0)
    assert {r.component_id for r in got if r.doc_id in (6, 7)} == {6}
    assert minhash.near_groups(no_docs(spark)).count() == 0
    assert minhash.drop_near(odd_docs(spark)).columns == odd_docs(spark).columns


# 4, 5 --------------------------------------------------------------------------------------------

def test_encoder_equals_library():
    e, rnd = Encoder.of(default_vocabulary()), random.Random(2)
    bits = ["The", "théâtre", "It's", "'RE", "<|endoftext|>", "<|ENDOFTEXT|>", ".", ",,", " ", "\n", "É́", "ﬁ", "İ", "ΑΣ", "42nd", "x_y", "ªº", "ß", "Ÿ", "÷", " ", "😀", "%%%"]
    texts = ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 12))) for _ in range(500)]
    ids, at = e.encode(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == [x.ids for x in e.tokenizer.encode_batch(texts, add_special_tokens=False)]


def whole_ids(rows, end):
    tokenizer = Encoder.of(default_vocabulary()).tokenizer
    return [(d, np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, end], "<u4")) for d, t in rows]


def test_token_files_round_trip(spark):
    docs = documents(spark).select("doc_id", "text").unionByName(odd_docs(spark).select("doc_id", "text").where("doc_id is null or doc_id > 6").withColumn("doc_id", F.col("doc_id") + 10_000))
    folder = shared_path(spark, "tokens")
    tokenfile.write_tokens(docs, folder)
    want = whole_ids([tuple(r) for r in docs.collect()], 1)
    got = tokenfile.read_tokens(spark, folder).orderBy("start").collect()
    assert [(r.doc_id is not None, r.doc_id) for r in got] == sorted((r.doc_id is not None, r.doc_id or 0) if r.doc_id is not None else (False, None) for r in got)
    assert sorted((str(r.doc_id), tuple(r.ids)) for r in got) == sorted((str(d), tuple(i.tolist())) for d, i in want)
    assert [r.start for r in got] == np.cumsum([0, *[len(r.ids) for r in got]])[:-1].tolist()
    assert {(str(r.doc_id), r.ids_crc32) for r in tokenfile.token_digests(spark, folder).collect()} == {(str(d), zlib.crc32(i)) for d, i in want}
    assert tokenfile.write_and_read(no_docs(spark)).count() == 0


def test_training_sample_is_bounded_in_bytes(spark):
    rows = [(i, i, n, bytes(n)) for i, n in enumerate([900, 100, 100, 101, 100, 100])]
    sample = spark.createDataFrame(rows, "h long, row long, size long, ids binary")
    assert sorted(len(r.ids) for r in tokenfile.within_bytes(sample, 10, 808).collect()) == [100, 100, 100, 100, 101]
    assert [len(r.ids) for r in tokenfile.within_bytes(sample, 2, 808).collect()] == [100, 100]
    assert sum(len(r.ids) for r in tokenfile.within_bytes(sample.unionByName(sample.withColumn("row", F.col("row") + 9)), 20, 808).collect()) <= 808


def test_packing_places_every_piece(spark):
    docs = documents(spark).select("doc_id", "text").unionByName(odd_docs(spark).select("doc_id", "text"))
    rows = packing.pack(docs, keep_ids=True).collect()
    want = {}
    for d, i in whole_ids([tuple(r) for r in docs.collect()], 0):
        for p in range(-(-len(i) // 2048)):
            want.setdefault((d, p, tuple(i[p * 2048:(p + 1) * 2048].tolist())), 0)
            want[(d, p, tuple(i[p * 2048:(p + 1) * 2048].tolist()))] += 1
    got, bins = {}, {}
    for r in rows:
        got[(r.doc_id, r.piece, tuple(r.ids))] = got.get((r.doc_id, r.piece, tuple(r.ids)), 0) + 1
        assert r.start == r.piece * 2048 and r.length == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4"))
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert got == want
    for b in bins.values():
        b.sort()
        assert [o for o, _ in b] == np.cumsum([0, *[n for _, n in b]])[:-1].tolist() and sum(n for _, n in b) <= 2048
    counts = np.bincount([r.length for r in rows], minlength=2049)
    assert len(bins) <= packing.lower_bound(counts) + 1
    packed = packing.sequences(packing.pack(docs, keep_ids=True))
    assert packed.agg(F.sum(F.size("ids"))).first()[0] == sum(r.length for r in rows)
    assert packing.pack(no_docs(spark)).count() == 0


def fewest_bins(items, cap):
    items, best = sorted(items, reverse=True), [len(items)]

    def go(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        for j in sorted({b: k for k, b in enumerate(bins)}.values()):
            if bins[j] >= items[i]:
                go(i + 1, [*bins[:j], bins[j] - items[i], *bins[j + 1:]])
        go(i + 1, [*bins, cap - items[i]])

    go(0, [])
    return best[0]


def test_bin_completion_is_optimal_on_small_cases():
    rnd = random.Random(4)
    for _ in range(60):
        cap = rnd.choice([10, 17, 30])
        items = [rnd.randint(1, cap) for _ in range(rnd.randint(1, 9))]
        counts = np.bincount(items, minlength=cap + 1)
        found = packing.complete(counts)
        used = np.zeros(cap + 1, int)
        for times, uses in found:
            assert sum(s * k for s, k in uses) <= cap
            for s, k in uses:
                used[s] += times * k
        assert (used == counts).all() and sum(t for t, _ in found) == fewest_bins(items, cap)


def test_bin_completion_with_many_short_lengths():
    counts = np.zeros(2049, np.int64)
    counts[1:64] = 1
    assert sum(t for t, _ in packing.complete(counts)) == 1


# 6 -----------------------------------------------------------------------------------------------

def test_warc_round_trip_and_revisits(spark):
    x = "é" * 60
    rows = [(3, "http://a\r\nb", x), (1, None, x), (2, "u", x), (None, "u", x), (5, "v", None), (6, "v", ""), (7, "w", "s" * 99), (8, "w", "s" * 99),
            (9, "z", "\r\n\r\nWARC/1.1\r\n\r\n" * 100_000), (1, "q", x)]
    pages = spark.createDataFrame([(*r, "k") for r in rows], "page_id long, url string, html string, digest string")
    folder = shared_path(spark, "warc")
    warc.normalise(warc.write_archives(pages, folder), folder)
    got = warc.read_archives(spark, folder, payloads=True).collect()
    assert sorted((str(r.page_id), r.payload_bytes, r.record_type, r.refers_to) for r in got) == sorted(
        [("1", 120, "response", None)] * 2 + [("2", 120, "revisit", "1"), ("3", 120, "revisit", "1"), ("None", 120, "revisit", "1"), ("5", 0, "response", None), ("6", 0, "response", None),
         ("7", 99, "response", None), ("8", 99, "response", None), ("9", 1_600_000, "response", None)])
    assert all(hashlib.sha256(r.payload).hexdigest() == r.payload_digest for r in got if r.record_type == "response")
    # the normaliser also takes files that are by record already
    again = shared_path(spark, "warc")
    files = spark.read.parquet(f"{folder}/index").select(F.concat(F.lit(folder.rsplit("/", 1)[1] + "/"), "file").alias("file")).distinct()
    parent = folder.rsplit("/", 1)[0]
    index = warc.normalise(files, parent)
    assert index.count() == len(rows) and again
    assert warc.write_and_read(pages.limit(0)).count() == 0


def test_warc_damage_is_noticed():
    import io

    data = zlib.compress(warc.record("1", None, b"x" * 1000, "0", None), wbits=31)
    stream = warc._Stream(io.BytesIO(data[:len(data) // 2]))
    with pytest.raises(ValueError):
        head = stream.head()
        list(stream.copy(int(warc.fields_of(head)["content-length"]) + 4))


# 7 -----------------------------------------------------------------------------------------------

BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def pii_brute(text):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            luhn = sum(int(c) if i % 2 == 0 else 2 * int(c) - 9 * (int(c) > 4) for i, c in enumerate(reversed(digits))) % 10 == 0
            if {"email": True, "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else True, "card": 13 <= len(digits) <= 19 and luhn, "phone": 9 <= len(digits) <= 15}[kind]:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(out)


def test_pii_base_equals_brute_force(spark):
    rnd = random.Random(3)
    bits = ["a", "b.", "@", ".", "-", "+", "1", "23", "255", "256.", " ", "(", ")", "4111111111111111", "x@y.z", "..", "\n", "é", "10.0.0.1", "%", "5500-0000-0000-0004", "+1 (555) 123-4567 ", "😀"]
    rows = [(i, "".join(rnd.choice(bits) for _ in range(rnd.randint(0, 40)))) for i in range(1500)]
    rows += [(9999, "1 " * 20_000), (10000, "a." * 20_000 + "@b.c"), (10001, "a@" + "b." * 20_000), (10002, "x1 " * 9000), (10003, None)]
    got = pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    assert {r.doc_id: r.b for r in got.select("doc_id", pii.span_list(F.col("base")).alias("b")).collect()} == {d: pii_brute(t or "") for d, t in rows}


def test_pii_contexts_discover_and_redact(spark):
    rows = [(i, f"please write to contact mail user{i}@host{i}.org now") for i in range(20)] + [(50, "please write to contact mail user@localhost now"), (51, "he scored 7@home in the game")]
    docs = spark.createDataFrame([(*r, "k", "s") for r in rows], "doc_id long, text string, key string, spans string")
    added = {r.doc_id: r.added for r in pii.find_pii(docs).collect() if r.added}
    assert not added or set(added) <= {50}
    odd = pii.find_pii(odd_docs(spark)).collect()
    assert len(odd) == 12 and pii.find_pii(no_docs(spark)).count() == 0
    mixed = [(1, "mail a.b@c.de now, ip 1.2.3.4 ok 4111 1111 1111 1111", "x", "s"), (2, None, "y", "s"), (None, "+1 (555) 123-4567 é", "z", "s"), (3, "clean", "w", "s"), (3, "ip 9.9.9.9", "w", "s")]
    out = pii.redact(spark.createDataFrame(mixed, docs.schema))
    assert out.columns == docs.columns
    assert sorted(map(str, (r.text for r in out.collect()))) == sorted(["mail [EMAIL] now, ip [IP] ok [CARD]", "None", "[PHONE] é", "clean", "ip [IP]"])


def test_pii_bootstrap_finds_unseen_identifier(spark):
    rows = [(i, f"call line card {4111111111111111} and ref server {i}.{i}.{i}.{i} up") for i in range(30)] + [(99, "now ref server 300.1.1.1 up")]
    found = {r.doc_id: r.spans for r in pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", pii.span_list(F.col("added")).alias("spans")).collect()}
    assert found[99] == "ip:15:24" and not any(v for k, v in found.items() if k != 99)


def test_pii_contexts_discover_other_forms(spark):
    rows = [(i, f"please write to contact mail user{i}@host{i}.org now or call our desk line +1 (555) 123-{4000 + i} today") for i in range(20)]
    rows += [(50, "please write to contact mail user@localhost now"), (51, "he scored 7@home in the game"), (52, "call our desk line 555-0100 today"), (53, "call our desk line 555 0100 22 today"), (54, "of 300 in 1999 he had 12 34")]
    got = pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", pii.span_list(F.col("added")).alias("spans")).collect()
    text = dict(rows)
    assert {r.doc_id: [(k, text[r.doc_id][int(a):int(b)]) for k, a, b in (x.split(":") for x in r.spans.split(","))] for r in got if r.spans} == {
        50: [("email", "user@localhost")], 52: [("phone", "555-0100")], 53: [("phone", "555 0100 22")]}


# 8 -----------------------------------------------------------------------------------------------

def quality_brute(text):
    w = re.findall(WORD, text)
    windows = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    hit = {j for i, x in enumerate(windows) if windows.count(x) > 1 for j in range(i, i + 5)} if len(windows) < 3000 else set()
    lines = [x for x in text.split("\n") if re.search(WORD, x)]
    return len(w), sum(map(len, w)), len(re.findall("[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit), len(w) < 10 or 100 * len(hit) > 20 * len(w)


def test_quality_counts_equal_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in documents(spark).collect()][:120] + [(r.doc_id, r.text) for r in odd_docs(spark).collect() if r.doc_id and r.doc_id not in (6, 7)]
    rows = [(1000 + i, t) for i, (_, t) in enumerate(rows)]
    docs = spark.createDataFrame([(d, t, "en", "k") for d, t in rows], "doc_id long, text string, lang string, words string")
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in quality.judge(docs).collect()}
    assert got == {d: quality_brute(t or "") for d, t in rows}


def test_quality_keeps_good_and_drops_junk(spark):
    verdicts = quality.judge(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id").where("n_words >= 50")
    wrong = verdicts.groupBy("quality").agg((F.count_if("kept") / F.count(F.lit(1))).alias("kept")).collect()
    share = {r.quality: r.kept for r in wrong}
    assert share[1] > 0.9 and share[0] < 0.05
    assert quality.judge(odd_docs(spark)).count() == 12 and quality.judge(no_docs(spark)).count() == 0
    assert quality.drop_bad(odd_docs(spark)).columns == odd_docs(spark).columns


# 9 -----------------------------------------------------------------------------------------------

def test_html_main_text(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    for r in html.extract(pages).join(pages.select("page_id", "html"), "page_id").collect():
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        blocks = [" ".join(entities.unescape(re.sub("<[^>]*>", "", b.replace("<br>", " "))).split()) for b in re.split(r"</?(?:p|h1)>", inner)]
        assert r.text == "\n\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


def test_html_attributes_of_any_length():
    long = "x>" * 5000
    page = (f"<body><nav><div data-props='{long}'>inner menu words one two</div><p>more of the menu three four</p></nav><div class=\"sidebar\" data-a=\"{long}\" {'a=1 ' * 900}>beside it five six</div>"
            "<h1>Head line of it</h1><p title=it's>First words of the text stand here.</p><p>Second words of the text.</p></body>")
    found = html.tokens(page)
    assert [t.strip() for f, t in found if f == "apart"] == ["inner menu words one two", "more of the menu three four", "beside it five six"]
    assert "".join(str(t) for f, t in found if f == "word") == "Head line of itFirst words of the text stand here.Second words of the text."
    assert ("div", None) in html.tokens('<p>a</p><div class="never ends>text')


def test_html_odd_pages(spark):
    page = ('<html><head><title>t</title></head><body><header class="site-header"><h2>Site name here</h2></header><nav><ul><li>a b</li></ul></nav><div class="cookie-notice">We use cookies ok</div>'
            '<h1>Head &amp; line</h1><p>First para with many words in it &lt;b&gt; and so on and on.</p><form><label>Your mail address</label></form><script>if (a<b) x="</p>"</script>'
            '<p>Second <a href="x>y">link</a> text follows here with words<p>Third unclosed paragraph text is here</div><div class="comments"><p>Great post I liked it very much indeed</p></div></body></html>')
    weights = html.fit([r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()])
    assert html.main_text(page, weights) == ("Head & line\n\nFirst para with many words in it <b> and so on and on.\n\nSecond link text follows here with words\n\nThird unclosed paragraph text is here")
    rows = [(1, None, None, "k"), (2, "u", "", "k"), (None, "u", "plain &amp; text", "k"), (2, "u", "", "k"), (3, "u", "<p>" * 50_000 + "x", "k")]
    got = sorted((str(r.page_id), r.text) for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect())
    assert got == [("1", ""), ("2", ""), ("2", ""), ("3", "x"), ("None", "plain & text")]
    assert html.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


# 10 ----------------------------------------------------------------------------------------------

def repeats_brute(docs, least):
    found = []
    for d, t in docs:
        w = [m.span() for m in re.finditer(WORD, t or "")]
        line = [i == 0 or "\n" in t[w[i - 1][1]:w[i][0]] for i in range(len(w))]
        begin = [i for i in range(len(w)) if line[i] or t[w[i - 1][1] - 1] in ".!?" or re.match("[A-ZÀ-ÖØ-Þ]", t[w[i][0]])]
        ends, lines = [*begin[1:], len(w)], [i for i, x in enumerate(line) if x]
        ranges = {(s, e) for s in begin if (e := next((e for e in ends if e >= s + least), None))} | {(s, e) for s, e in zip(lines, [*lines[1:], len(w)]) if e - s >= least}
        found += [(tuple(lower(t[a:b]) for a, b in w[s:e]), d, w[s][0], w[e - 1][1]) for s, e in ranges]
    first, n = {}, {}
    for u, *where in found:
        n[u] = n.get(u, 0) + 1
        first[u] = min(first.get(u, where), where)
    spans = {}
    for u, d, s, e in found:
        if n[u] > 1 and [d, s] != first[u][:2]:
            s = max(s, first[u][2]) if d == first[u][0] else s
            if s < e:
                spans.setdefault(d, set()).update(range(s, e))
    return {d: x | {i for i in range(max(x)) if i - 1 in x and i + 1 in x} for d, x in spans.items()}  # single white spaces between units go too


def test_repeats_equal_brute_force(spark):
    rnd = random.Random(5)
    rows = [(i, " ".join(rnd.choice(["a", "B", "c.", "d!", "é", "É", "\n", " ", "x"]) for _ in range(rnd.randint(0, 60)))) for i in range(300)] + [(400, None), (401, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    spans = {r.doc_id: {i for s in r.spans for i in range(s.start, s.end)} for r in repeats.repeated_spans(docs, least=3).collect()}
    want = repeats_brute(rows, 3)
    assert spans == want
    for r in repeats.remove_repeats(docs, least=3).collect():
        text = dict(rows)[r.doc_id] or ""
        assert r.text == "".join(c for i, c in enumerate(text) if i not in want.get(r.doc_id, ()))
        assert r.text == "".join(text[k.start:k.end] for k in r.kept)


def test_repeats_find_passages_in_mid_line_and_odd_rows(spark):
    passage = " ".join(f"Word{i} goes on with more of these words here." for i in range(7))
    docs = spark.createDataFrame([(1, f"start of one {passage} rest of one", "k"), (2, f"another beginning and {passage} other end", "k"), (3, "no repeats in this clean text of more than eight words", "k")], "doc_id long, text string, key string")
    got = repeats.repeated_spans(docs).collect()
    assert [(r.doc_id, r.first_doc_ids) for r in got] == [(2, [1])] and got[0].n_removed >= len(passage)
    assert repeats.repeated_spans(no_docs(spark)).count() == 0 and repeats.remove_repeats(odd_docs(spark)).count() == 12


def test_repeats_find_passages_without_sentences_or_spaces(spark):
    rnd = random.Random(6)
    lower_case, han, greek = " ".join(f"w{rnd.randint(0, 10**6)}" for _ in range(60)), "".join(chr(rnd.randint(0x4E00, 0x9FFF)) for _ in range(80)), " ".join("α" + chr(rnd.randint(0x3B1, 0x3C9)) * rnd.randint(1, 9) for _ in range(60))
    rows = []
    for i, passage in enumerate((lower_case, han, greek)):
        rows += [(2 * i, f"one lead of its own {i} {passage} and x{i} tail"), (2 * i + 1, f"here stands another{i}lead{passage if passage == han else ' ' + passage} that ends otherwise y{i}")]
    got = {r.doc_id: r for r in repeats.repeated_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert set(got) == {1, 3, 5}
    for d, passage in ((1, lower_case), (3, han), (5, greek)):
        text = dict(rows)[d]
        (span,), at = got[d].spans, text.index(passage)
        assert at <= span.start and span.end <= at + len(passage) and got[d].first_doc_ids == [d - 1]
        inner = passage if passage == han else passage.split()
        left, right = text[at:span.start], text[span.end:at + len(passage)]
        lost = [len(x if passage == han else x.split()) for x in (left, right)]
        assert max(lost) < repeats.NEAR and len(inner) == (80 if passage == han else 60)


# pipeline ----------------------------------------------------------------------------------------

def test_pipeline_stages(spark):
    docs = documents(spark)
    good = stored(corpus_pipeline.keep_good(spark, docs, SF), "stage")
    verdict = {r.doc_id for r in quality.judge(docs).where("kept").collect()}
    assert good.columns == docs.columns and {r.doc_id for r in good.collect()} == verdict
    unique = stored(corpus_pipeline.drop_copies(spark, good, SF), "stage")
    best = {}
    for r in good.collect():
        k = re.sub(r"[ \t-\r]", "", r.text)
        best[k] = min(best.get(k, (0, 10**9)), (-len(r.text), r.doc_id))
    assert unique.columns == docs.columns and {r.doc_id for r in unique.collect()} == {i for _, i in best.values()}
    near = stored(corpus_pipeline.drop_near_copies(spark, unique, SF), "stage")
    brute = near_brute([(r.doc_id, r.text) for r in unique.collect()], 5, 80)
    assert near.columns == docs.columns and {r.doc_id for r in near.collect()} == {d for d, (_, c) in brute.items() if c == d}
    clean = stored(corpus_pipeline.redact(spark, near, SF), "stage")
    assert clean.columns == docs.columns and clean.count() == near.count() and not any(pii_brute(r.text) for r in clean.collect())
    packed = corpus_pipeline.pack(spark, clean, SF)
    assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in clean.collect()}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "exact_dedup", "minhash_near_dedup", "pii", "packing"]


def test_pipeline_odd_rows(spark):
    docs, empty = odd_docs(spark), no_docs(spark)
    for name, stage in corpus_pipeline.STAGES:
        docs, empty = stored(stage(spark, docs, SF), name), stored(stage(spark, empty, SF), name)
    assert docs.count() and empty.count() == 0


def test_native_operators_run_no_python(spark):
    for name in ("op2_exact_dedup", "op7_contextual_pii", "op8_quality_rules"):
        plan = catalog.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)
