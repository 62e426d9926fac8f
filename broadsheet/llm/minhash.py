"""Near-duplicates: MinHash samples folded into odd sketches, banded candidates, exact confirmation, components."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from broadsheet.llm.common import spread, stored
from broadsheet.llm.shingles import mix, seeds, shingle_hashes, word_hashes

#: Bands and rows of the MinHash table: two sets of similarity 0.8 share no band with probability (1 - 0.8^4)^32 < 5e-8.
BANDS, ROWS = 32, 4
SAMPLES = BANDS * ROWS
#: Bits of the odd sketch, in words of 64.
SKETCH_WORDS = 8
#: Most bits of the parity bitmap of a whole set (8 kB); a set has two bits for each shingle, or a few more, up to there.
MOST_BITS = 1 << 16
#: Members outside the largest component of a bucket that are compared with all of it at once: in the first round, and in the second, doubled from there on.
FIRST_REST, REST = 2, 1024
#: Members of a bucket in one block.
BLOCK = 4096
#: Slots of the table that tells which rows a join may need.
SLOTS = 1 << 21
#: Components in which a member proposes partners at once, and partners in each; four times as many from visit to visit.
PROPOSALS = 4


def most_odd_bits(similarity: float, tail: float) -> int:
    """Largest population count of the XOR of two sketches that `similarity` still explains.

    Of the SAMPLES minima about SAMPLES * (1 - J) differ, each flips a bit on either side; z of n bits are then odd with
    the expectation n / 2 * (1 - (1 - 2 / n)^flips). `tail` standard deviations of both steps are allowed.
    """
    n = 64 * SKETCH_WORDS
    differ = SAMPLES * (1 - similarity) + tail * math.sqrt(SAMPLES * similarity * (1 - similarity))
    z = n / 2 * (1 - (1 - 2 / n) ** (2 * min(SAMPLES, differ)))
    return min(n, math.ceil(z + tail * math.sqrt(z) / 2))


def sketches(docs: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """id, n (distinct shingles), digest (of the whole set), bands (longs), odd (longs of the sketch), parity (longs of the bitmap of the whole set); whole texts."""
    narrow = spread(docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")), "id")
    id_type = narrow.schema["id"].dataType
    schema = T.StructType([T.StructField("id", id_type), T.StructField("n", T.LongType()), T.StructField("digest", T.BinaryType()),
                           T.StructField("bands", T.ArrayType(T.LongType())), T.StructField("odd", T.ArrayType(T.LongType())), T.StructField("parity", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch):
                ids, texts = part.column(0), part.column(1)
                n, digests, bands, odd, sets = sketch_texts(texts, size)
                maps = [parity_bitmap(s) for s in sets]
                ends = np.concatenate([[0], np.cumsum([len(m) for m in maps])]).astype(np.int32)
                parity = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int64), *maps])))
                listed = [pa.ListArray.from_arrays(pa.array(np.arange(0, m.size + 1, m.shape[1], dtype=np.int32)), pa.array(m.reshape(-1).view(np.int64))) for m in (bands, odd)]
                yield pa.RecordBatch.from_arrays([ids, pa.array(n), pa.array(digests, pa.binary()), *listed, parity], names=schema.names)

    return narrow.mapInArrow(run, schema)


def parity_bitmap(items: np.ndarray) -> np.ndarray:
    """An odd sketch of a whole set, as longs: each item flips one bit, so two bitmaps differ in at most as many bits as the sets differ in items.

    That bound is exact, whatever collides. Its size is a power of two; a larger one folds to a smaller one by the XOR of its halves.
    """
    bits = min(MOST_BITS, 1 << max(9, (2 * len(items) - 1).bit_length())) if len(items) else 64
    return np.packbits((np.bincount((items & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1).astype(np.uint8), bitorder="little").view(np.int64)


def parts(batch: pa.RecordBatch, most: int = 1 << 23) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of about `most` bytes of text, each a copy: some kernels go wrong on slices that were cast."""
    step = max(1, int(len(batch) * most / max(1, batch.nbytes)))
    for i in range(0, len(batch), step):
        yield batch.take(pa.array(np.arange(i, min(i + step, len(batch)))))


def sketch_texts(texts: pa.Array, size: int, sets_only: bool = False):
    """Per text: set size, digest, band keys, odd sketch, and the sorted distinct shingle hashes."""
    words, at = word_hashes(texts)
    hashes, at = shingle_hashes(words, at, size)
    sets = [np.unique(hashes[a:b]) for a, b in zip(at[:-1], at[1:])]
    n = np.array([len(s) for s in sets], dtype=np.int64)
    digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
    if sets_only:
        return n, digests, None, None, sets
    low = np.full((len(sets), SAMPLES), 0xFFFFFFFF, dtype=np.uint32)
    full = np.flatnonzero(n)
    if len(full):
        flat = np.concatenate([sets[i] for i in full])
        flat = (flat >> np.uint64(32)).astype(np.uint32) ^ flat.astype(np.uint32)
        starts = np.concatenate([[0], np.cumsum(n[full])])
        a, b = seeds(SAMPLES, 1).astype(np.uint32) | np.uint32(1), seeds(SAMPLES, 2).astype(np.uint32)
        mins = np.empty((SAMPLES, len(full)), dtype=np.uint32)
        first = 0
        while first < len(full):  # blocks of shingles that fit the cache
            last = max(first + 1, int(np.searchsorted(starts, starts[first] + 50_000, "right")) - 1)
            block, cut = flat[starts[first]:starts[last]], starts[first:last] - starts[first]
            for k in range(SAMPLES):
                mins[k, first:last] = np.minimum.reduceat((block ^ b[k]) * a[k], cut)
            first = last
        low[full] = mins.T
    with np.errstate(over="ignore"):
        wide = low.astype(np.uint64)
        keys = np.broadcast_to(seeds(BANDS, 3), (len(sets), BANDS)).copy()
        for r in range(ROWS):
            keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + wide[:, r::ROWS])
        bit = (mix(wide + seeds(SAMPLES, 4)) % np.uint64(64 * SKETCH_WORDS)).astype(np.int64)
    odd = np.zeros((len(sets), 64 * SKETCH_WORDS), dtype=np.uint8)
    if len(sets):
        counts = np.bincount((bit + np.arange(len(sets))[:, None] * (64 * SKETCH_WORDS)).reshape(-1), minlength=odd.size)
        odd = (counts & 1).astype(np.uint8).reshape(odd.shape)
    return n, digests, keys, np.packbits(odd, axis=1).view(np.uint64).reshape(len(sets), SKETCH_WORDS), sets


def shingle_sets(rows: DataFrame, size: int) -> DataFrame:
    """rows: node, want (digest), text. Gives node, items (distinct shingle hashes) for rows whose set has the digest."""
    schema = T.StructType([rows.schema["node"], T.StructField("items", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch):
                _, digests, _, _, sets = sketch_texts(part.column("text"), size, sets_only=True)
                want = part.column("want").to_pylist()
                ok = [i for i, d in enumerate(digests) if d == want[i]]
                at = np.concatenate([[0], np.cumsum([len(sets[i]) for i in ok])]).astype(np.int32)
                items = np.concatenate([sets[i] for i in ok]) if ok else np.zeros(0, np.uint64)
                yield pa.RecordBatch.from_arrays([part.column("node").take(pa.array(ok, pa.int64())), pa.ListArray.from_arrays(pa.array(at), pa.array(items.view(np.int64)))],
                                                 names=["node", "items"])

    return rows.select("node", "want", "text").mapInArrow(run, schema)


def components(links: DataFrame) -> DataFrame:
    """node, comp for the nodes of `links` (a, b): the smallest node of each connected component.

    Every round hooks each node to the smallest label among its neighbours (the aggregate combines before it
    shuffles, so a hub costs one row per task) and then jumps over its label's label. The state is written each round.
    """
    both = stored(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))), "links")
    state = stored(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("comp")).withColumnRenamed("a", "node"), "labels")
    while True:
        near = both.join(state.select(F.col("node").alias("b"), F.col("comp").alias("other")), "b").groupBy(F.col("a").alias("node")).agg(F.min("other").alias("other"))
        hooked = state.join(near, "node").select("node", F.col("comp").alias("was"), F.least("comp", "other").alias("low"))
        # the label of the label is at least as small
        jumped = hooked.join(state.select(F.col("node").alias("low"), F.col("comp").alias("lower")), "low", "left").select(
            "node", "was", F.least("low", "lower").alias("comp"))
        following = stored(jumped, "labels")
        moved = following.where("was <> comp").limit(1).count()
        state = following.select("node", "comp")
        if not moved:
            return state


def _merged(comps: DataFrame, links: DataFrame) -> DataFrame:
    """The components after more links: only links between different components are followed, each pair of components once."""
    own = comps.select(F.col("node").alias("end"), F.col("comp").alias("found"))
    for side in ("a", "b"):
        links = links.join(own, F.col(side) == F.col("end"), "left").select(F.coalesce("found", side).alias(side), "b" if side == "a" else F.col("a"))
    joined = components(stored(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct(), "between"))
    kept = comps.join(joined.select(F.col("node").alias("comp"), F.col("comp").alias("low")), "comp", "left").select("node", F.coalesce("low", "comp").alias("comp"))
    return stored(kept.unionByName(joined.join(comps.select("node"), "node", "left_anti")), "labels")


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """Connected components of the texts whose shingle sets have a Jaccard similarity of `percent` / 100 or more.

    Rows with the same set are one class, found by digest and represented by their smallest identifier; only classes
    are compared. Classes that share a band of MinHash values meet in a bucket. A bucket does not emit all its pairs: it
    compares its members with one pivot, the one that shares most bands with others; what is then still outside the
    largest component of the bucket is compared with all members once it is few (REST, doubled each round), else the next pivot
    follows. That comparison runs over blocks of sketches and yields only the best partners of a member in other components; the
    bucket is visited again, with more partners each time, until none was left out. Pairs pass the odd sketches, then a bound
    by parity bitmaps of the whole sets, which is exact, then the full sets; only confirmed pairs link.

    Columns: doc_id, n_shingles, component_id (smallest doc_id reachable), kept (doc_id = component_id). Words are
    runs without white space, A-Z lower-cased; fewer words than `size` are one shingle; a null text or one without words
    has an empty set, is its own component and stays. Null identifiers never represent others unless all are null.
    An empty table gives no rows; rows that repeat an identifier and a text give the same result each.
    """
    seen = stored(sketches(docs, id_col, text_col, size), "sketches")
    # stored once: the row numbers stay what they are
    classes = stored(seen.where("n > 0").groupBy("digest").agg(F.min("id").alias("low"), F.first("n").alias("n"), F.first("bands").alias("bands"), F.first("odd").alias("odd"), F.first("parity").alias("parity"))
                     .withColumn("node", F.monotonically_increasing_id()), "classes")
    members = classes.select("node", F.explode("bands").alias("key"))
    # what is joined by bucket is written first: only then can Spark split the exchange of a hot bucket
    shared = stored(members.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "shared")
    buckets = stored(members.join(shared, "key"), "buckets")
    comps = _links(docs, classes, buckets, id_col, text_col, size, percent)
    named = classes.select("node", "digest", "low")
    if comps is not None:
        labels = comps.join(named.select("node", "low"), "node")
        lowest = labels.groupBy("comp").agg(F.min("low").alias("lowest"))
        named = named.join(labels.join(lowest, "comp").select("node", "lowest"), "node", "left").select("digest", F.coalesce("lowest", "low").alias("component_id"))
    else:
        named = named.select("digest", F.col("low").alias("component_id"))
    found = seen.select("id", "n", "digest").join(named, "digest", "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id"))
    return found.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))


def _links(docs: DataFrame, classes: DataFrame, buckets: DataFrame, id_col: str, text_col: str, size: int, percent: int) -> DataFrame | None:
    """node, comp of the classes that confirmed links connect to others; None if no two classes share a bucket."""
    if buckets.limit(1).count() == 0:
        return None
    sketch = classes.select("node", "n", "odd", "parity")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def sets_of(nodes: DataFrame) -> DataFrame:
        wanted = stored(nodes.join(classes.select("node", "low", F.col("digest").alias("want")), "node"), "wanted")
        return stored(shingle_sets(wanted.join(_among(texts, "id", wanted.select("low")), F.col("id").eqNullSafe(F.col("low"))), size).dropDuplicates(["node"]), "sets")

    limit, far_limit = most_odd_bits(percent / 100, 5.0), most_odd_bits(max(0.0, 2 * percent / 100 - 1), 5.0)
    # a text that others were copied from shares more bands with more of them than the copies do with each other
    degree = stored(buckets.groupBy("node").agg(F.sum("size").alias("degree")), "degree")
    open_ = stored(buckets.join(degree, "node").select("key", "node", "degree", F.lit(0).alias("level"), F.col("node").alias("comp")), "open")
    links, sets, comps, rest, proposals, turn = None, None, None, FIRST_REST, PROPOSALS, 0
    while True:
        # the largest component of a bucket, how many members are outside it, and the pivot: the member with most company
        pivot = F.max(F.struct("degree", "node", "comp")).alias("pivot")
        if turn == 0:  # all components are single members
            whole = open_.groupBy("key").agg(F.count(F.lit(1)).alias("all"), pivot).select("key", "all", F.col("pivot.node").alias("main"), (F.col("all") - 1).alias("outside"), "pivot")
        else:
            sizes = open_.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("c"), pivot)
            whole = sizes.groupBy("key").agg(F.sum("c").alias("all"), F.max(F.struct("c", "comp")).alias("main"), F.max("pivot").alias("pivot")).select(
                "key", "all", F.col("main.comp").alias("main"), (F.col("all") - F.col("main.c")).alias("outside"), "pivot")
        whole = stored(whole.where("outside > 0").select("key", "all", "main", "outside", F.col("pivot.node").alias("pivot"), F.col("pivot.comp").alias("pivot_comp")), "whole")
        placed = stored(open_.join(whole, "key"), "placed")
        few = F.col("outside") <= rest
        others = placed.where(~few & (F.col("node") != F.col("pivot")))
        # what is in the component of the pivot already needs no comparison with it
        star = stored(_scored(others.where(F.col("comp") != F.col("pivot_comp")).select("key", "node", "degree", "level", F.col("pivot").alias("other")), sketch, percent), "star")
        likely = _pairs(star.where(F.col("odd") <= limit))
        inside = placed.where(few).select("key", "node", "comp", "main", "all")
        if turn == 0:  # buckets of two or three members
            second = inside.select("key", F.col("node").alias("other"))
            small = _pairs(inside.select("key", "node").join(second, "key").where(F.col("node") < F.col("other")))
            likely = likely.unionByName(_pairs(_scored(small.select(F.col("a").alias("node"), F.col("b").alias("other")), sketch, percent).where(F.col("odd") <= limit)))
            likely, unfinished = _possible(stored(likely.distinct(), "near"), sketch, percent), None
        else:
            proposed = stored(_proposals(inside, sketch, limit, percent, proposals), "proposed")
            likely = _possible(likely, sketch, percent).unionByName(proposed.where("a IS NOT NULL").select("a", "b")).distinct()
            unfinished = placed.join(proposed.where("more").select("key").distinct(), "key", "left_semi").select("key", "node", "degree", "level")
        likely = stored(likely, "likely")
        nodes = _nodes(likely)
        sets = sets_of(nodes) if sets is None else sets.unionByName(sets_of(nodes.join(sets.select("node"), "node", "left_anti")))
        confirmed = stored(_confirm(likely, sets, percent), "confirmed")
        links = confirmed if links is None else links.unionByName(confirmed)
        comps = components(confirmed) if comps is None else _merged(comps, confirmed)
        # Jaccard distance is a metric: what is twice the distance of a link away from the pivot links to nothing that the pivot
        # links to. It leaves the bucket and goes on in a bucket with all that has no link of its own to the pivot, members of the
        # pivot's component included; from there none leaves, so every two of them are compared or in one component.
        far = star.where((F.col("level") == 0) & (F.col("odd") > far_limit))
        stay = others.join(far.select("key", "node"), ["key", "node"], "left_anti").select("key", "node", "degree", "level")
        unlinked = others.where("level = 0").join(stored(far.select("key").distinct(), "far"), "key", "left_semi").select("key", "node", "degree", F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b"))
        moved = unlinked.join(links.select("a", "b").distinct(), ["a", "b"], "left_anti").select(F.xxhash64("key", F.lit("far"), F.lit(turn)).alias("key"), "node", "degree", F.lit(1).alias("level"))
        moved = stored(moved, "moved")
        again = stored(moved.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1").select("key"), "shared")
        left = stay.unionByName(moved.join(again, "key", "left_semi"))
        left = stored(left if unfinished is None else left.unionByName(unfinished), "left")
        if left.limit(1).count() == 0:
            return comps
        open_ = stored(left.join(comps, "node", "left").select("key", "node", "degree", "level", F.coalesce("comp", "node").alias("comp")), "open")
        rest, proposals, turn = max(REST, rest * 2), proposals * (4 if turn else 1), turn + 1


def _proposals(inside: DataFrame, sketch: DataFrame, limit: int, percent: int, most: int) -> DataFrame:
    """key, a, b, more: pairs of a member outside the main component of its bucket with its best partners in other components.

    inside: key, node, comp, main, all (members of the bucket). A bucket is dealt out in blocks of bounded size, and each member
    outside the main component is held against every member of every block, as arrays: first odd sketches, then the exact
    bound of parity bitmaps, which rules out all but borderline cases. Of what passes, a member proposes the best `most` of each of
    the best `most` components; `more` (a and b null) marks a bucket where others were left for the next visit.
    """
    blocks = F.ceil(F.col("all") / BLOCK).cast("int")
    members = inside.select("key", F.pmod(F.xxhash64("node"), blocks).cast("int").alias("block"), "node", "comp", "main", F.lit(False).alias("asks"))
    asking = inside.where("comp <> main").select("key", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"), "node", "comp", "main", F.lit(True).alias("asks"))
    schema = "key long, a long, b long, more boolean"

    def compare(table: pa.Table) -> pa.Table:
        t = table.combine_chunks()
        node, comp, main, n, asks = (t[c].to_numpy() for c in ("node", "comp", "main", "n", "asks"))
        odd = t["odd"].combine_chunks().flatten().to_numpy().view(np.uint64).reshape(-1, SKETCH_WORDS)
        maps = [x.values.to_numpy() for x in t["parity"]]
        held = np.flatnonzero(~asks)
        pairs, more = [], False
        for o in np.flatnonzero(asks):
            m = held[(comp[held] != comp[o]) & ((comp[held] == main[o]) | (node[held] < node[o]))]  # two outside members meet once
            m = m[100 * np.minimum(n[m], n[o]) >= percent * np.maximum(n[m], n[o])]
            m = m[np.bitwise_count(odd[m] ^ odd[o]).sum(1, dtype=np.int64) <= limit]
            if not len(m):
                continue
            differ = np.array([differing(maps[i], maps[o]) for i in m])
            near = (100 + percent) * differ <= (100 - percent) * (n[m] + n[o])
            m, differ = m[near], differ[near]
            if not len(m):
                continue
            order = np.lexsort((node[m], differ))
            _, first, group = np.unique(comp[m][order], return_index=True, return_inverse=True)
            by_best = np.argsort(np.argsort(first))[group]  # components in the order of their best partner
            kept = np.flatnonzero(by_best < most)
            kept = kept[_rank(group[kept]) < most]
            more |= len(kept) < len(m)
            pairs += [(int(min(node[o], node[i])), int(max(node[o], node[i]))) for i in m[order[kept]]]
        rows = [(a, b, False) for a, b in pairs] + [(None, None, True)] * more
        key = t["key"][0].as_py()
        columns = list(zip(*[(key, *r) for r in rows])) or [[], [], [], []]
        return pa.table([pa.array(c, x) for c, x in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.bool_()))], names=["key", "a", "b", "more"])

    return members.unionByName(asking).join(sketch, "node").groupBy("key", "block").applyInArrow(compare, schema)


def _rank(groups: np.ndarray) -> np.ndarray:
    """How many equal values stand before each."""
    order = np.argsort(groups, kind="stable")
    sizes = np.unique(groups, return_counts=True)[1]
    out = np.empty(len(groups), np.int64)
    out[order] = np.arange(len(groups)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return out


def differing(a: np.ndarray, b: np.ndarray) -> int:
    """Bits in which two parity bitmaps differ, the larger one folded to the size of the smaller."""
    while len(a) != len(b):
        a, b = (a, b) if len(a) > len(b) else (b, a)
        a = a[:len(a) // 2] ^ a[len(a) // 2:]
    return int(np.bitwise_count((a ^ b).view(np.uint64)).sum(dtype=np.int64))  # of signed numbers it would count the bits of the absolute value


def _pairs(rows: DataFrame) -> DataFrame:
    return rows.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()


def _nodes(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()


def _among(rows: DataFrame, column: str, keys: DataFrame) -> DataFrame:
    """All rows whose `column` equals one of the keys (one column), nulls too, and few others: what a join with few keys needs not shuffle stays out.

    Keys are hashed to SLOTS slots, so what is broadcast is bounded; with many more keys than slots the rows pass as they are."""
    def slot(name: str):
        return F.pmod(F.xxhash64(name), F.lit(SLOTS)).alias("slot")

    return rows.select("*", slot(column)).join(F.broadcast(keys.select(slot(keys.columns[0])).distinct()), "slot", "left_semi").drop("slot")


def _side(df: DataFrame, name: str) -> DataFrame:
    return df.select(*[F.col(c).alias(name if c == "node" else f"{c}_{name}") for c in df.columns])


def _scored(rows: DataFrame, sketch: DataFrame, percent: int) -> DataFrame:
    """rows (node, other, ...) with odd: the population count of the XOR of the sketches, the largest where set sizes alone rule the link out."""
    def side(name: str, column: str) -> DataFrame:
        return sketch.select(F.col("node").alias(name), F.col("n").alias(f"n_{column}"), F.col("odd").alias(f"odd_{column}"))

    kept = rows.columns
    joined = rows.join(side("node", "a"), "node").join(side("other", "b"), "other")
    bits = sum((F.bit_count(F.col("odd_a")[i].bitwiseXOR(F.col("odd_b")[i])) for i in range(1, SKETCH_WORDS)), F.bit_count(F.col("odd_a")[0].bitwiseXOR(F.col("odd_b")[0])))
    ruled_out = 100 * F.least("n_a", "n_b") < (2 * percent - 100) * F.greatest("n_a", "n_b")
    return joined.select(*kept, F.when(ruled_out, F.lit(64 * SKETCH_WORDS)).otherwise(bits).alias("odd"))


def _possible(pairs: DataFrame, sketch: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that neither the sizes of their sets nor the exact bound of their parity bitmaps rule out."""
    rows = _among(sketch.select("node", "n", "parity"), "node", _nodes(pairs))
    sized = pairs.join(_side(rows, "a"), "a").join(_side(rows, "b"), "b").where(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))

    def folded(own: str, other: str):
        half = F.size(own) / 2  # sets of similar sizes have bitmaps of one size, or of twice that; others are not judged
        return F.when(F.size(own) <= F.size(other), F.col(own)).otherwise(F.transform(F.slice(own, F.lit(1), half.cast("int")), lambda x, i: x.bitwiseXOR(F.get(F.col(own), i + half.cast("int")))))

    each = F.zip_with(folded("parity_a", "parity_b"), folded("parity_b", "parity_a"), lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    differ = F.aggregate(each, F.lit(0).cast("long"), lambda s, x: s + F.coalesce(x, F.lit(0)))
    unequal = F.greatest(F.size("parity_a"), F.size("parity_b")) > 2 * F.least(F.size("parity_a"), F.size("parity_b"))
    return sized.where(unequal | ((100 + percent) * differ <= (100 - percent) * (F.col("n_a") + F.col("n_b")))).select("a", "b")


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose full sets are similar enough."""
    own = _among(sets, "node", _nodes(pairs))
    met, items = F.size(F.array_intersect("items_a", "items_b")), F.size("items_a") + F.size("items_b")
    return pairs.join(_side(own, "a"), "a").join(_side(own, "b"), "b").where(
        (100 * F.least(F.size("items_a"), F.size("items_b")) >= percent * F.greatest(F.size("items_a"), F.size("items_b"))) & (100 * met >= percent * (items - met))).select("a", "b")


def drop_near(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """Rows of `docs` that represent their component, with all their columns. Rows that repeat an identifier stay together."""
    kept = near_groups(docs, id_col, text_col, size, percent).where("kept").select(F.col("doc_id").alias("kept_id")).distinct()
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), F.col(id_col).alias("row_id"))
    return rows.join(kept, F.col("row_id").eqNullSafe(F.col("kept_id")), "left_semi").select("row.*")
