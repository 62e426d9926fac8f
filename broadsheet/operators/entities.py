"""Entity mentions, relations and graph measures."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from broadsheet.functions import text as tx
from broadsheet.functions import wordlists as wl
from broadsheet.operators.graph import components
from broadsheet.operators.relational import count_all, entity_pairs
from broadsheet.plans.sized import with_scalars
from broadsheet.session import materialize, written

MENTION_PATTERNS = {
    "MONEY": r"[$€£]\s?\d[\d,.]*(?:\s(?:million|billion))?",
    "PERCENT": r"\d+(?:\.\d+)?\s?(?:%|percent)",
    "DATE": r"\d{4}-\d{2}-\d{2}|\d{1,2}/\d{1,2}/\d{4}|(?:January|February|March|April|May|June|July|August|September|October|November|December)\s\d{1,2}",
    "TIME": r"\d{1,2}:\d{2}(?:\s?[ap]m)?",
    "ORDINAL": r"\d+(?:st|nd|rd|th)",
    "CARDINAL": r"\d+",
    "ENTITY": r"\p{Lu}[\p{L}'-]+(?:\s\p{Lu}[\p{L}'-]+)+",
}
CONFIDENCE = {"MONEY": 0.9, "PERCENT": 0.9, "DATE": 0.9, "TIME": 0.85, "ORDINAL": 0.8, "CARDINAL": 0.7, "ENTITY": 0.6}
MENTION = "doc_id text label start end confidence source".split()


def measured(text: Column, pattern: str) -> Column:
    """Matches of a pattern in order, each with the characters from the end of the match before to its own end.

    \\G ties every search to the end of the last match, so a text without (further) matches is read once.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), 0)
    steps = F.regexp_extract_all(text, F.lit(rf"\G(?s:.*?)(?:{pattern})"), 0)
    return F.zip_with(found, steps, lambda m, g: F.struct(m.alias("text"), F.length(g).alias("step")))


def with_offsets(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """start and end (exclusive) from the running sum of steps. keys and pos identify a match; one text per group."""
    end = F.sum("step").over(Window.partitionBy(*keys).orderBy("pos"))
    return rows.withColumn("end", end.cast("int")).withColumn("start", F.col("end") - F.length("text")).drop("step")


def pattern_mentions(df: DataFrame, id_col: str, text_col: str, patterns: Mapping[str, str] = MENTION_PATTERNS,
                     confidence: Mapping[str, float] = CONFIDENCE) -> DataFrame:
    arrays = [F.transform(measured(F.col(text_col), p), _labelled(label, confidence[label])) for label, p in patterns.items()]
    rows = df.select(F.col(id_col).alias("doc_id"), F.posexplode(F.concat(*arrays)).alias("pos", "m")).select("doc_id", "pos", "m.*")
    return with_offsets(rows, ["doc_id", "label"]).select(*MENTION)


def _labelled(label: str, confidence: float):
    def add(m):
        return F.struct(m["text"].alias("text"), m["step"].alias("step"), F.lit(label).alias("label"),
                        F.lit(confidence).alias("confidence"), F.lit("pattern").alias("source"))
    return add


#: Names whose trie travels to the tasks at once; a larger gazetteer goes in as many passes as it has shards of this size.
SHARD_NAMES = 200_000


class NameTrie:
    """Names as sequences of words. A node is a dictionary of word numbers; its label, if a name ends there, stands under -1."""

    def __init__(self, names: Sequence[tuple[str, str]]):
        numbers: dict[str, int] = {}
        self.root: dict = {}
        for name, label in names:
            node = self.root
            for word in name.split(" "):
                node = node.setdefault(numbers.setdefault(word, len(numbers)), {})
            node[-1] = label
        self.words = pa.array(list(numbers), pa.string())

    def found(self, words: np.ndarray, stop: np.ndarray) -> Iterator[tuple[int, int, str]]:
        """First word, last word and label of every name, overlapping ones too. words: numbers, below zero if in no name; stop: the end of each word's text."""
        leads = np.zeros(len(self.words) + 1, dtype=bool)
        leads[list(self.root)] = True
        for first in np.flatnonzero(leads[words]).tolist():  # -1 looks at the last flag, which is off
            node, at, end = self.root, first, int(stop[first])
            while at < end and (node := node.get(int(words[at]))) is not None and words[at] >= 0:
                if -1 in node:
                    yield first, at, node[-1]
                at += 1


def gazetteer_mentions(df: DataFrame, id_col: str, text_col: str, gazetteer: DataFrame, confidence: float = 0.95, shard_names: int = SHARD_NAMES) -> DataFrame:
    """Names of a (name, label) table, of any number of words and in any letter case, with their offsets.

    Texts are cut into words where they lie and walk a trie of names there; they are never shuffled. The trie is shipped in shards of
    a counted size, one pass over the texts for each.
    """
    names = written(gazetteer.select(F.lower("name").alias("name"), "label").where("name <> ''").dropDuplicates(["name"]))
    shards = max(1, -(-names.count() // shard_names))
    words = F.transform(measured(F.col(text_col), tx.WORD_TOKEN), lambda m: F.struct(m["text"].alias("text"), F.lower(m["text"]).alias("low"), m["step"].alias("step")))
    rows = df.select(F.col(id_col).alias("doc_id"), words.alias("words"))
    schema = T.StructType([rows.schema["doc_id"], *T._parse_datatype_string("text string, label string, start int, end int").fields])
    out = None
    for shard in range(shards):
        own = names.where(F.pmod(F.xxhash64("name"), F.lit(shards)) == shard).collect()  # about shard_names
        share = df.sparkSession.sparkContext.broadcast(NameTrie([(r["name"], r["label"]) for r in own]))

        def run(batches: Iterator[pa.RecordBatch], share=share) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield _names_in(batch, share.value, schema.names)

        found = rows.mapInArrow(run, schema)
        out = found if out is None else out.unionByName(found)
    return out.select("doc_id", "text", "label", "start", "end", F.lit(confidence).alias("confidence"), F.lit("gazetteer").alias("source"))


def _names_in(batch: pa.RecordBatch, trie: NameTrie, columns: list[str]) -> pa.RecordBatch:
    lists = batch.column("words")
    lengths = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten()
    text, low, steps = (flat.field(c) for c in ("text", "low", "step"))
    numbers = pc.fill_null(pc.index_in(low, value_set=trie.words), -1).to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(lengths)), lengths)
    last = np.cumsum(lengths)
    run = np.concatenate([[0], np.cumsum(steps.to_numpy(zero_copy_only=False).astype(np.int64))])
    ends = run[1:] - run[(last - lengths)[row]] if len(row) else run[1:]
    starts = ends - pc.utf8_length(text).to_numpy(zero_copy_only=False)
    hits = list(trie.found(numbers, last[row])) if len(row) else []
    a, b = np.array([h[0] for h in hits], dtype=np.int64), np.array([h[1] for h in hits], dtype=np.int64)
    names = [" ".join(text.slice(i, j - i + 1).to_pylist()) for i, j, _ in hits]
    return pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(row[a])), pa.array(names, pa.string()), pa.array([h[2] for h in hits], pa.string()), pa.array(starts[a].astype(np.int32)),
                                       pa.array(ends[b].astype(np.int32))], names=columns)


def extract_mentions(df: DataFrame, id_col: str, text_col: str, gazetteer: DataFrame | None = None, patterns: Mapping[str, str] = MENTION_PATTERNS) -> DataFrame:
    """All mentions of patterns and gazetteer, normalised and merged."""
    found = pattern_mentions(df, id_col, text_col, patterns)
    if gazetteer is not None:
        found = found.unionByName(gazetteer_mentions(df, id_col, text_col, gazetteer))
    return merge_mentions(normalize_labels(found))


def normalize_labels(mentions: DataFrame, aliases: Mapping[str, str] = wl.LABEL_ALIASES) -> DataFrame:
    table = F.create_map(*[F.lit(x) for kv in aliases.items() for x in kv])
    up = F.upper("label")
    return mentions.withColumn("text", tx.strip("text")).withColumn("label", F.coalesce(F.element_at(table, up), up))


def resolve_overlaps(mentions: DataFrame) -> DataFrame:
    """In every run of overlapping mentions, higher confidence wins, then the longer text, then the earlier start.

    Mentions are first cut into islands (runs of overlap) per document; each island is folded in winning order,
    keeping a mention when it overlaps none kept so far.
    """
    doc = Window.partitionBy("doc_id").orderBy("start", "end")
    reach = F.max("end").over(doc.rowsBetween(Window.unboundedPreceding, -1))
    islands = mentions.withColumn("_new", (reach.isNull() | (F.col("start") >= reach)).cast("int")).withColumn("_island", F.sum("_new").over(doc))
    fields = [c for c in mentions.columns if c != "doc_id"]
    order = F.struct((-F.col("confidence")).alias("a"), (-F.length("text")).alias("b"), F.col("start").alias("c"), F.struct(*fields).alias("m"))
    ranked = islands.groupBy("doc_id", "_island").agg(F.transform(F.array_sort(F.collect_list(order)), lambda x: x["m"]).alias("_all"))
    empty = F.slice(F.col("_all"), 1, 0)

    def step(kept, m):
        clash = F.exists(kept, lambda k: (m["start"] < k["end"]) & (k["start"] < m["end"]))
        return F.when(clash, kept).otherwise(F.array_append(kept, m))

    return ranked.select("doc_id", F.inline(F.aggregate("_all", empty, step))).select(*mentions.columns)


def merge_mentions(mentions: DataFrame) -> DataFrame:
    """Overlaps resolved, then one mention per document and lower-cased text: the most confident, then the first."""
    kept = resolve_overlaps(mentions)
    first = Window.partitionBy("doc_id", F.lower("text")).orderBy(F.col("confidence").desc(), "start")
    return kept.withColumn("_r", F.row_number().over(first)).where("_r = 1").drop("_r")


# ---- relations -----------------------------------------------------------------------------------------------

RELATION = "doc_id type entity1 entity2 confidence source context start".split()


CLAUSE = r"(?U)[\w\s&,]+"


def rule_relations(df: DataFrame, id_col: str, text_col: str, patterns: Sequence[tuple] = tuple(wl.RELATION_PATTERNS), confidence: float = 0.8) -> DataFrame:
    """Relations by patterns with two groups, matched without regard to case: (type, pattern, guard word pattern).

    The patterns hold only words, blanks, & and commas, so each match lies in one clause. Texts are cut into
    clauses first and a pattern is tried only where its guard occurs.
    """
    clauses = df.select(F.col(id_col).alias("doc_id"), F.posexplode(measured(F.col(text_col), CLAUSE)).alias("pos", "m")).select("doc_id", "pos", "m.*")
    clauses = with_offsets(clauses, ["doc_id"]).select("doc_id", F.col("text").alias("clause"), F.col("start").alias("clause_start"))
    parts = []
    for n, (kind, pattern, *guard) in enumerate(patterns):
        c = F.col("clause")
        full = "(?iU)" + pattern
        one, two = (F.regexp_extract_all(c, F.lit(full), g) for g in (1, 2))
        rows = F.transform(F.arrays_zip(measured(c, full).alias("m"), one.alias("entity1"), two.alias("entity2")), _relation(n, kind))
        none = F.slice(rows, 1, 0)
        parts.append(F.when(c.rlike("(?iU)" + guard[0]), rows).otherwise(none) if guard and guard[0] else rows)
    long = clauses.select("doc_id", "clause_start", F.posexplode(F.concat(*parts)).alias("pos", "r")).select("doc_id", "clause_start", "pos", "r.*")
    placed = with_offsets(long, ["doc_id", "clause_start", "rule"])
    return placed.select("doc_id", "type", "entity1", "entity2", F.lit(confidence).alias("confidence"), F.lit("rule_based").alias("source"),
                         F.col("text").alias("context"), (F.col("clause_start") + F.col("start")).alias("start"))


def _relation(n: int, kind: str):
    def make(x):
        return F.struct(F.lit(n).alias("rule"), F.lit(kind).alias("type"), tx.strip(x["entity1"]).alias("entity1"), tx.strip(x["entity2"]).alias("entity2"),
                        x["m"]["text"].alias("text"), x["m"]["step"].alias("step"))
    return make


def proximity_relations(mentions: DataFrame, texts: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Person-organisation pairs within 200 characters and organisation-place pairs within 100, typed by their context."""
    t = texts.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text"))

    def context(pairs: DataFrame, pad: int) -> DataFrame:
        lo = F.greatest(F.least("left_start", "right_start") - pad, F.lit(0))
        hi = F.greatest("left_end", "right_end") + pad
        return pairs.join(t, "doc_id").withColumn("context", F.substring(F.col("_text"), lo + 1, hi - lo)).drop("_text")

    people = context(entity_pairs(mentions, ["PERSON"], ["ORG"], 200), 50)
    low = F.lower("context")
    leads, staff = tx.any_hit(low, wl.LEAD_WORDS), tx.any_hit(low, wl.STAFF_WORDS)
    people = people.withColumn("type", F.when(leads, "LEADS").when(staff, "WORKS_FOR").otherwise("ASSOCIATED_WITH")).withColumn(
        "confidence", F.when(leads, 0.8).when(staff, 0.7).otherwise(0.6))
    places = context(entity_pairs(mentions, ["ORG"], ["GPE", "LOC"], 100), 30).withColumn("type", F.lit("LOCATED_IN")).withColumn("confidence", F.lit(0.7))
    both = people.unionByName(places)
    return both.select("doc_id", "type", F.col("left_text").alias("entity1"), F.col("right_text").alias("entity2"), "confidence",
                       F.lit("entity_proximity").alias("source"), "context", F.col("left_start").alias("start"), "distance")


def dedup_relations(relations: DataFrame) -> DataFrame:
    """First relation per (lower entity1, lower entity2, type): rules before proximity, then document and place."""
    order = F.struct(F.when(F.col("source") == "rule_based", 0).otherwise(1).alias("p"), F.col("doc_id"), F.col("start"))
    keys = [F.lower("entity1").alias("_e1"), F.lower("entity2").alias("_e2"), F.col("type").alias("_t")]
    row = F.struct(*relations.columns)
    return relations.groupBy(*keys).agg(F.min_by(row, order).alias("r")).select("r.*")


def extraction_stats(texts: DataFrame, mentions: DataFrame, relations: DataFrame) -> DataFrame:
    """Long table metric, value: totals, per-text means and counts per type."""
    # mentions and relations are found once: their totals are those of the kept counts per type
    labels, types = (materialize(df.groupBy(c).agg(count_all().cast("double").alias("value"))) for df, c in ((mentions, "label"), (relations, "type")))
    n = texts.agg(count_all().cast("double").alias("texts"))
    m, r = (counts.agg(F.coalesce(F.sum("value"), F.lit(0.0)).alias(name)) for counts, name in ((labels, "entities"), (types, "relations")))
    totals = with_scalars(with_scalars(n, m), r).withColumns({
        "entities_per_text": tx.ratio(F.col("entities"), F.col("texts")), "relations_per_text": tx.ratio(F.col("relations"), F.col("texts"))})
    out = totals.unpivot([], totals.columns, "metric", "value")
    by_label, by_type = (counts.select(F.concat(F.lit(f"{name}:"), F.col(c)).alias("metric"), "value") for counts, name, c in ((labels, "entity", "label"), (types, "relation", "type")))
    return out.unionByName(by_label).unionByName(by_type)


# ---- graph ---------------------------------------------------------------------------------------------------

def build_graph(relations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Vertices, and one directed edge per pair with the type of the highest confidence (ties by type)."""
    edges = relations.where(F.col("entity1") != F.col("entity2")).groupBy(F.col("entity1").alias("src"), F.col("entity2").alias("dst")).agg(
        F.max_by("type", F.struct("confidence", "type")).alias("type"), F.max("confidence").alias("confidence"))
    vertices = edges.select(F.col("src").alias("id")).union(edges.select("dst")).distinct()
    return vertices, edges


def degree_centrality(edges: DataFrame) -> DataFrame:
    """(in + out) / (n - 1) per node."""
    ends = edges.select(F.col("src").alias("id")).union(edges.select("dst"))
    degree = ends.groupBy("id").agg(count_all().alias("degree"))
    n = degree.agg(count_all().alias("_n"))
    return with_scalars(degree, n).select("id", "degree", tx.ratio(F.col("degree"), F.col("_n") - 1).alias("centrality"))


def graph_stats(edges: DataFrame) -> DataFrame:
    parts = components(edges)
    n = parts.agg(count_all().alias("nodes"), F.count_distinct("component").alias("components"))
    m = edges.agg(count_all().alias("edges"))
    out = with_scalars(n, m)
    return out.withColumns({"density": tx.ratio(F.col("edges"), F.col("nodes") * (F.col("nodes") - 1)), "weakly_connected": F.col("components") == 1})


def relation_distribution(edges: DataFrame) -> DataFrame:
    return edges.groupBy("type").agg(count_all().alias("count"))

