"""Ranks, components, communities and paths of graphs whose edges are written once in the layout that every round joins in."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from broadsheet.operators.relational import count_all, top_k_per_group
from broadsheet.plans.sized import SALTS, attach, salt
from broadsheet.session import shared_dir, written

#: A source with more edges than this, and than its share of a bucket, is a hub: its edges lie apart, and its value is sent to them.
HUB_EDGES = 10_000


class Buckets:
    """Tables written into the shared folder in buckets of one number, so that joins on their keys move nothing.

    The catalogue holds their names only until the block ends; the files stay for what was read from them."""

    def __init__(self, spark: SparkSession):
        self.spark, self.n = spark, int(spark.conf.get("spark.sql.shuffle.partitions"))
        self._names: list[str] = []

    def __enter__(self) -> Buckets:
        return self

    def __exit__(self, *_) -> None:
        for name in self._names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def write(self, df: DataFrame, key: str) -> DataFrame:
        name = f"broadsheet_{uuid.uuid4().hex}"
        self._names.append(name)
        df.write.bucketBy(self.n, key).option("path", f"{shared_dir(self.spark).rstrip('/')}/{name}").saveAsTable(name)
        return self.spark.table(name)

    def split(self, edges: DataFrame, key: str, degrees: DataFrame, hub_edges: int | None) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Edges of ordinary keys in buckets, those of hubs spread evenly, and the hubs (key, n): at most a few per bucket."""
        total = degrees.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        least = max(HUB_EDGES, total // (8 * self.n)) if hub_edges is None else hub_edges
        hubs = written(degrees.where(F.col("n") > least))
        plain = attach(edges, hubs.select(key), [key], edges.columns, "left_anti")
        many = attach(edges, hubs.select(key), [key], edges.columns, "left_semi")
        return self.write(plain.repartition(self.n, key), key), written(many.repartition(self.n, *edges.columns)), hubs


def _meet(plain: DataFrame, many: DataFrame, hubs: DataFrame, values: DataFrame, key: str) -> DataFrame:
    """Edges beside the values (id, ...) of their `key`: bucket by bucket, and hub values sent to hub edges, which are few by the choice of hubs.

    The hint keeps the values of all nodes, whose files are small beside their rows, from being sent through the driver."""
    values = values.withColumnRenamed("id", key)
    few = values.join(F.broadcast(hubs.select(key)), key, "left_semi")
    return plain.join(values.hint("merge"), key).unionByName(many.join(F.broadcast(few), key))


def pagerank(edges: DataFrame, rounds: int = 20, damping: float = 0.85, residual: float = 0.0, hub_edges: int | None = None) -> DataFrame:
    """id, rank: PageRank with the mass of dangling nodes spread over all nodes; stops early once no more than `residual` moves.

    A rank after t rounds is a sum of c * v over rounds, where v is an all-equal vector pushed along the edges so many times and c a
    number that follows from the mass on dangling nodes. So a round only pushes: edges lie in buckets of their source, the vector in
    buckets of its node, and the one exchange is that of the sums by target, combined before it.
    """
    spark = edges.sparkSession
    e = written(edges.select("src", "dst").distinct())
    degrees = e.groupBy("src").agg(count_all().alias("n"))
    nodes = e.select(F.col("src").alias("id")).union(e.select("dst")).distinct()
    with Buckets(spark) as b:
        everyone = b.write(nodes.join(degrees.select(F.col("src").alias("id"), F.lit(True).alias("leads")), "id", "left").select("id", F.col("leads").isNull().alias("dangling")), "id")
        n, lost = everyone.agg(count_all(), F.count_if("dangling")).first()
        if not n:
            return everyone.select("id", F.lit(0.0).alias("rank")).limit(0)
        weighted = attach(e, degrees, ["src"], ["dst"]).select("src", "dst", (damping / F.col("n")).alias("w"))
        plain, many, hubs = b.split(weighted, "src", degrees, hub_edges)
        vectors, dangling = [everyone.select("id", F.lit(1.0).alias("v"))], [float(lost)]
        constants: list[float] = []  # c of each round
        for _ in range(rounds):
            vectors.append(b.write(pushed_along(plain, many, hubs, vectors[-1]), "id"))
            if residual:
                constants.append(((1 - damping) + damping * _mass(constants, dangling, n)) / n)
                dangling += _on_dangling(vectors[-1:], everyone)
                if len(constants) > 1 and _moved(vectors, constants, n, everyone) <= residual:
                    break
        if not residual:
            dangling += _on_dangling(vectors[1:], everyone)
            for _ in range(rounds):
                constants.append(((1 - damping) + damping * _mass(constants, dangling, n)) / n)
        return written(_combined(vectors, _coefficients(constants, n), everyone).select("id", F.col("x").alias("rank")))


def _on_dangling(vectors: Sequence[DataFrame], everyone: DataFrame) -> list[float]:
    """The sum of each vector over the nodes that lead nowhere, in one pass."""
    both = None
    for i, v in enumerate(vectors):
        part = v.select("id", "v", F.lit(i).alias("i"))
        both = part if both is None else both.unionByName(part)
    found = {} if both is None else {r["i"]: r["v"] for r in attach(both, everyone.where("dangling").select("id"), ["id"], ["i"], "left_semi").groupBy("i").agg(F.sum("v").alias("v")).collect()}
    return [found.get(i, 0.0) for i in range(len(vectors))]


def pushed_along(plain: DataFrame, many: DataFrame, hubs: DataFrame, vector: DataFrame) -> DataFrame:
    """id, v: each node's weighted sum of the values of the nodes that lead to it."""
    return _meet(plain, many, hubs, vector, "src").groupBy(F.col("dst").alias("id")).agg(F.sum(F.col("w") * F.col("v")).alias("v"))


def _coefficients(constants: Sequence[float], n: int) -> list[float]:
    """What each pushed vector counts after so many rounds: the rank is started at 1 / n, and each round adds its constant."""
    return [*reversed(constants), 1.0 / n]


def _mass(constants: Sequence[float], dangling: Sequence[float], n: int) -> float:
    return sum(c * d for c, d in zip(_coefficients(constants, n), dangling))


def _combined(vectors: Sequence[DataFrame], coefficients: Sequence[float], everyone: DataFrame) -> DataFrame:
    terms = None
    for v, c in zip(vectors[1:], coefficients[1:]):
        part = v.select("id", (F.col("v") * c).alias("x"))
        terms = part if terms is None else terms.unionByName(part)
    start = everyone.select("id", F.lit(coefficients[0]).alias("x"))
    return (start if terms is None else start.unionByName(terms)).groupBy("id").agg(F.sum("x").alias("x"))


def _moved(vectors: Sequence[DataFrame], constants: Sequence[float], n: int, everyone: DataFrame) -> float:
    """The sum of the changes of all ranks in the last round."""
    now, before = _coefficients(constants, n), _coefficients(constants[:-1], n)
    change = [a - b for a, b in zip(now, [*before, 0.0])]
    return _combined(vectors, change, everyone).agg(F.sum(F.abs("x"))).first()[0]


def both_ways(edges: DataFrame) -> DataFrame:
    """a, b: every undirected edge from both of its ends, loops left out."""
    e = edges.select(F.col("src").alias("a"), F.col("dst").alias("b"))
    return e.union(e.select("b", "a")).where("a <> b").distinct()


def components(edges: DataFrame, hub_edges: int | None = None) -> DataFrame:
    """id, component: weakly connected components labelled by their smallest node.

    A round takes the smallest label of the neighbours, then that label's own label; it goes on until nothing changes. Edges lie in
    buckets of one end and labels in buckets of their node, so what moves is one label per node and neighbouring task.
    """
    spark = edges.sparkSession
    both = written(both_ways(edges))
    nodes = edges.select(F.col("src").alias("id")).union(edges.select("dst")).distinct()
    with Buckets(spark) as b:
        plain, many, hubs = b.split(both, "a", both.groupBy("a").agg(count_all().alias("n")), hub_edges)
        labels = b.write(nodes.withColumn("component", F.col("id")), "id")
        while True:
            near = _meet(plain, many, hubs, labels, "a").groupBy(F.col("b").alias("id")).agg(F.min("component").alias("near"))
            step = b.write(labels.join(near, "id", "left").select("id", F.col("component").alias("old"), F.least("component", F.coalesce("near", "component")).alias("c")), "id")
            used = step.select(F.col("c").alias("id")).distinct()
            jumps = written(step.join(used, "id").where("c < id").select(F.col("id").alias("c"), F.col("c").alias("next")))
            new = b.write(attach(step, jumps, ["c"], ["id"], "left").select("id", F.coalesce("next", "c").alias("component"), "old"), "id")
            labels = new.select("id", "component")
            if new.where("component <> old").isEmpty():
                return written(labels)


# ---- communities ---------------------------------------------------------------------------------------------

def communities(edges: DataFrame, rounds: int = 10, hub_edges: int | None = None) -> DataFrame:
    """Label propagation with fixed ties: most frequent label among the neighbours, then the smallest. The cheap form."""
    spark = edges.sparkSession
    edges = written(edges.select("src", "dst"))
    both = written(both_ways(edges))
    nodes = edges.select(F.col("src").alias("id")).union(edges.select("dst")).distinct()
    with Buckets(spark) as b:
        plain, many, hubs = b.split(both, "a", both.groupBy("a").agg(count_all().alias("n")), hub_edges)
        labels = b.write(nodes.withColumn("community", F.col("id")), "id")
        for _ in range(rounds):
            votes = _meet(plain, many, hubs, labels, "a").groupBy(F.col("b").alias("id"), "community").agg(count_all().alias("n"))
            best = votes.groupBy("id").agg(F.min_by("community", F.struct((-F.col("n")).alias("n"), "community")).alias("_best"))
            new = b.write(labels.join(best.hint("merge"), "id", "left").select("id", F.coalesce("_best", "community").alias("community"), F.col("community").alias("_old")), "id")
            labels = new.select("id", "community")
            if new.where("community <> _old").isEmpty():
                break
        return written(labels)


def weighted_both_ways(edges: DataFrame) -> DataFrame:
    """a, b, w: undirected edges of weight one from both ends, loops left out."""
    return both_ways(edges).withColumn("w", F.lit(1.0))


def modularity(both: DataFrame, labels: DataFrame) -> DataFrame:
    """One row: modularity and communities of a labelling (id, community) of undirected edges (a, b, w; loops once, others from both ends).

    The share of weight inside communities, less what a graph of the same degrees would have there by chance."""
    placed = attach(both, labels.select(F.col("id").alias("a"), F.col("community").alias("ca")), ["a"], ["b"])
    placed = attach(placed, labels.select(F.col("id").alias("b"), F.col("community").alias("cb")), ["b"], ["a"])
    per = placed.groupBy(F.col("ca").alias("community")).agg(F.sum("w").alias("total"), F.sum(F.when(F.col("ca") == F.col("cb"), F.col("w")).otherwise(0.0)).alias("inside"))
    all_weight = F.sum("total")
    return per.agg((F.sum("inside") / all_weight - F.sum(F.col("total") * F.col("total")) / (all_weight * all_weight)).alias("modularity"), count_all().alias("communities"))


def _near(plain: DataFrame, many: DataFrame, hubs: DataFrame, labels: DataFrame) -> DataFrame:
    """id, community, to: the weight that leads from each node into each neighbouring community."""
    return _meet(plain, many, hubs, labels, "a").groupBy(F.col("b").alias("id"), "community").agg(F.sum("w").alias("to"))


def _reached(near: DataFrame, labels: DataFrame, degrees: DataFrame) -> float:
    """The modularity of a labelling, from the weights between nodes and communities and the nodes' degrees and loops."""
    own = labels.join(degrees.hint("merge"), "id").select("community", F.col("k").alias("total"), F.col("loop").alias("inside"))
    inner = near.join(labels.hint("merge"), ["id", "community"]).select("community", F.lit(0.0).alias("total"), F.col("to").alias("inside"))
    per = own.unionByName(inner).groupBy("community").agg(F.sum("total").alias("total"), F.sum("inside").alias("inside"))
    weight = F.sum("total")
    return per.agg(F.sum("inside") / weight - F.sum(F.col("total") * F.col("total")) / (weight * weight)).first()[0]


def _moved_once(near: DataFrame, labels: DataFrame, degrees: DataFrame, weight: float, turn: int) -> DataFrame:
    """id, community, old: nodes whose turn it is go to the neighbouring community with the largest gain in modularity, if any gains.

    Half of the nodes stand still in each turn, so that neighbours do not swap."""
    own = labels.join(degrees.hint("merge"), "id").select("id", F.col("community").alias("old"), "k")
    totals = written(own.groupBy(F.col("old").alias("community")).agg(F.sum("k").alias("total")))
    stay = own.select("id", F.col("old").alias("community"), F.lit(0.0).alias("to"))
    each = near.unionByName(stay).groupBy("id", "community").agg(F.sum("to").alias("to"))
    options = attach(each, totals, ["community"], ["id"]).join(own.hint("merge"), "id")
    others = F.col("total") - F.when(F.col("community") == F.col("old"), F.col("k")).otherwise(0.0)
    gain = F.col("to") - F.col("k") * others / weight
    scored = options.select("id", "community", "old", F.round(gain, 9).alias("gain"))
    best = scored.groupBy("id", "old").agg(F.max_by("community", F.struct("gain", (F.col("community") == F.col("old")).alias("stays"), F.xxhash64("community").alias("tie"))).alias("best"))
    moves = F.pmod(F.xxhash64("id", F.lit(turn)), F.lit(2)) == 0
    return best.select("id", F.when(moves, F.col("best")).otherwise(F.col("old")).alias("community"), "old")


def communities_by_modularity(edges: DataFrame, levels: int = 10, turns: int = 8, least: float = 1e-3, hub_edges: int | None = None) -> tuple[DataFrame, float]:
    """id, community (named by its smallest node), and the modularity of that division.

    On each level nodes move between neighbouring communities while modularity rises; then every community becomes one node,
    its inner edges a loop, and the next level works on that smaller graph, until a level brings no more than `least`. A level ends after
    two turns that brought less than that, and keeps its best labels. The edges of a level lie in buckets; a turn reads them once, for the weights between
    nodes and communities, from which the modularity, the next moves and the next level follow.
    """
    spark = edges.sparkSession
    both = written(weighted_both_ways(edges))
    place = written(both.select(F.col("a").alias("id")).distinct().withColumn("node", F.col("id")))  # the node of the present level that holds each node
    weight = both.agg(F.coalesce(F.sum("w"), F.lit(0.0))).first()[0]
    if not weight:
        return place.select("id", F.col("node").alias("community")), 0.0
    reached = None
    for _ in range(levels):
        with Buckets(spark) as b:
            loop = F.sum(F.when(F.col("a") == F.col("b"), F.col("w")).otherwise(0.0))
            degrees = b.write(both.groupBy(F.col("a").alias("id")).agg(F.sum("w").alias("k"), loop.alias("loop")), "id")
            apart = both.where("a <> b")
            parts = b.split(apart, "a", apart.groupBy("a").agg(count_all().alias("n")), hub_edges)
            labels = b.write(degrees.select("id", F.col("id").alias("community")), "id")
            near = written(_near(*parts, labels))
            if reached is None:
                reached = _reached(near, labels, degrees)
            best, start, still = labels, reached, 0
            for turn in range(turns):
                new = b.write(_moved_once(near, labels, degrees, weight, turn), "id")
                labels = new.select("id", "community")
                changed = not new.where("community <> old").isEmpty()
                if changed:
                    near = written(_near(*parts, labels))
                value = _reached(near, labels, degrees) if changed else reached
                still = still + 1 if value < reached + least else 0  # each half of the nodes had its turn and little came of it
                if value > reached:
                    best, reached = labels, value
                if still == 2:
                    break
            if reached <= start + least:
                break
            names = written(best.groupBy("community").agg(F.min("id").alias("name")))
            named = b.write(attach(best, names, ["community"], ["id"]).select("id", F.col("name").alias("community")), "id")
            place = written(attach(place, written(named.select(F.col("id").alias("node"), F.col("community").alias("name"))), ["node"], ["id"]).select("id", F.col("name").alias("node")))
            placed = named.withColumnRenamed("community", "name").hint("merge")
            ends = _near(*parts, named).join(placed, "id").select(F.col("community").alias("a"), F.col("name").alias("b"), F.col("to").alias("w"))
            loops = degrees.where("loop > 0").join(placed, "id").select(F.col("name").alias("a"), F.col("name").alias("b"), F.col("loop").alias("w"))
            both = written(ends.unionByName(loops).groupBy("a", "b").agg(F.sum("w").alias("w")))
    smallest = written(place.groupBy("node").agg(F.min("id").alias("community")))
    return attach(place, smallest, ["node"], ["id"]).select("id", "community"), reached


# ---- paths ---------------------------------------------------------------------------------------------------


def _longer(front: DataFrame, edges: DataFrame, hubs: DataFrame, forward: bool) -> DataFrame:
    """Paths of a frontier (end, at, path, types) one edge longer, no node twice; the edges of hubs are dealt over sub-keys."""
    here, there = ("src", "dst") if forward else ("dst", "src")
    e = edges.select(F.col(here).alias("at"), F.col(there).alias("next"), "type")
    hot = hubs.select(F.col("id").alias("at"))
    plain = attach(front, hot, ["at"], ["end", "path"], "left_anti").join(e, "at")
    many = attach(e, hot, ["at"], ["next"], "left_semi").withColumn("_salt", salt(["next"]))
    reach = attach(front, hot, ["at"], ["end", "path"], "left_semi").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    met = plain.unionByName(reach.join(many, ["at", "_salt"]).drop("_salt")).where(~F.array_contains("path", F.col("next")))
    step = F.array(F.col("type"))
    if forward:
        return met.select("end", F.col("next").alias("at"), F.array_append("path", F.col("next")).alias("path"), F.concat("types", step).alias("types"))
    return met.select("end", F.col("next").alias("at"), F.concat(F.array("next"), "path").alias("path"), F.concat(step, "types").alias("types"))


def _work(front: DataFrame, degree: DataFrame) -> int:
    return front.groupBy("at").agg(count_all().alias("n")).join(degree, "at").agg(F.coalesce(F.sum(F.col("n") * F.col("degree")), F.lit(0))).first()[0]


def find_connections(edges: DataFrame, pairs: DataFrame, max_len: int = 3, hub_edges: int = HUB_EDGES) -> DataFrame:
    """Simple directed paths of at most max_len edges for a table of pairs (a, b): a, b, length, path, types.

    Paths grow from the starts along the edges and from the ends against them, at each step on the side where the counted
    degrees promise less, and the halves meet on their common node. Ends that occur in many pairs are followed once.
    """
    e = written(edges.select("src", "dst", "type").dropDuplicates(["src", "dst"]).where("src <> dst"))
    out, into = (written(e.groupBy(F.col(c).alias("at")).agg(count_all().alias("degree"))) for c in ("src", "dst"))
    hubs = {f: written(d.where(F.col("degree") > hub_edges).select(F.col("at").alias("id"))) for f, d in ((True, out), (False, into))}
    asked = written(pairs.select("a", "b").where("a <> b").distinct())
    nothing = F.array().cast("array<string>")

    def ends(column: str) -> DataFrame:
        return written(asked.select(F.col(column).alias("end")).distinct().select("end", F.col("end").alias("at"), F.array("end").alias("path"), nothing.alias("types")))

    ahead, behind = [ends("a")], [ends("b")]  # by length
    found = None
    for length in range(1, max_len + 1):
        if _work(ahead[-1], out) <= _work(behind[-1], into):
            ahead.append(written(_longer(ahead[-1], e, hubs[True], True)))
        else:
            behind.append(written(_longer(behind[-1], e, hubs[False], False)))
        left = ahead[-1].select(F.col("end").alias("a"), "at", F.col("path").alias("p1"), F.col("types").alias("t1"))
        right = behind[-1].select(F.col("end").alias("b"), "at", F.col("path").alias("p2"), F.col("types").alias("t2"))
        later = F.slice("p2", 2, F.greatest(F.size("p2") - 1, F.lit(0)))
        met = left.join(asked, "a").join(right, ["b", "at"]).where(~F.arrays_overlap("p1", later)).select(
            "a", "b", F.lit(length).alias("length"), F.concat("p1", later).alias("path"), F.concat("t1", "t2").alias("types"))
        found = met if found is None else found.unionByName(met)
    return found


def shortest_paths(paths: DataFrame) -> DataFrame:
    return paths.groupBy("a", "b").agg(F.min("length").alias("distance"), count_all().alias("paths"))


def smallest_paths(paths: DataFrame, k: int = 10) -> DataFrame:
    """The k smallest paths of each pair, shorter ones first, then by their nodes: a, b, rank, length, path, types, and paths, how many there are in all."""
    best = top_k_per_group(paths.withColumn("_near", -F.col("length")).withColumn("_name", F.array_join("path", "\u0001")), ["a", "b"], "_near", k, "_name").drop("_near", "_name")
    return best.join(paths.groupBy("a", "b").agg(count_all().alias("paths")), ["a", "b"])


def common_neighbours(edges: DataFrame, pairs: DataFrame) -> DataFrame:
    """a, b, node: nodes to which edges lead from both ends of a pair."""
    e = written(edges.select("src", "dst").distinct())
    asked = pairs.select("a", "b").where("a <> b").distinct()
    one = asked.join(e.select(F.col("src").alias("a"), F.col("dst").alias("node")), "a")
    return one.join(e.select(F.col("src").alias("b"), F.col("dst").alias("node")), ["b", "node"]).select("a", "b", "node")


