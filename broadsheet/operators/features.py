"""TF-IDF and count features in long form (id, term, value), and the vectors made from them."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import CountVectorizer, CountVectorizerModel, ElementwiseProduct, Normalizer, VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from broadsheet.functions.text import ngrams
from broadsheet.operators.relational import count_all, top_k_per_group
from broadsheet.plans.sized import SMALL_ROWS, attach, bounded_rows, fits
from broadsheet.session import materialize

MAX_FEATURES = 5000


def _tf(df: DataFrame, keys: Sequence[str], tokens_col: str, lo: int, hi: int) -> DataFrame:
    grams = df.select(*keys, F.explode(ngrams(tokens_col, lo, hi)).alias("term"))
    return grams.groupBy(*keys, "term").agg(count_all().alias("tf"))


def sublinear(tf: Column) -> Column:
    return 1 + F.ln(tf.cast("double"))


def smooth_idf(n: Column, df: Column) -> Column:
    return F.ln((1 + n) / (1 + df)) + 1


def term_stats(df: DataFrame, tokens_col: str, lo: int = 1, hi: int = 1) -> DataFrame:
    """term, n_docs, total. The terms of a row and its different terms are counted in one aggregate, combined before the shuffle:
    what moves is one row per term and task, never one per document and term."""
    grams = ngrams(tokens_col, lo, hi)

    def marked(terms: Column, different: int) -> Column:
        return F.transform(terms, lambda t: F.struct(t.alias("term"), F.lit(different).alias("different")))

    both = df.select(F.explode(F.concat(marked(grams, 0), marked(F.array_distinct(grams), 1))).alias("g"))
    return both.groupBy("g.term").agg(F.sum("g.different").alias("n_docs"), F.sum(1 - F.col("g.different")).alias("total"))


#: Tokens that a task counts at once.
CHUNK_TOKENS = 1 << 20


def _grams(tokens: pa.Array, row: np.ndarray, n: int) -> tuple[pa.Array, np.ndarray]:
    """The n-grams of a run of tokens, joined by a blank, and their rows."""
    inside = np.flatnonzero(row[:len(row) - n + 1] == row[n - 1:])
    return pc.binary_join_element_wise(*[tokens.take(pa.array(inside + i)) for i in range(n)], " ") if n > 1 else tokens, row[inside]


def count_rows(df: DataFrame, id_col: str, tokens_col: str, terms: Sequence[str], lo: int = 1, hi: int = 1, weights: Sequence[float] | None = None, sub: bool = True) -> DataFrame:
    """Counts of the given terms in every row: id, term, tf, and with `weights` (one per term) tfidf, of unit length per row.

    The terms travel to the tasks, each row is counted where it lies, and nothing is shuffled."""
    share = df.sparkSession.sparkContext.broadcast((pa.array(list(terms), pa.string()), None if weights is None else np.array(weights, dtype=np.float64)))
    schema = T.StructType([T.StructField(id_col, df.schema[id_col].dataType), T.StructField("term", T.StringType()), T.StructField("tf", T.LongType())])
    if weights is not None:
        schema = schema.add("tfidf", T.DoubleType())

    def counted(ids: pa.Array, tokens: pa.Array, lengths: np.ndarray) -> pa.RecordBatch:
        vocabulary, idf = share.value
        row = np.repeat(np.arange(len(lengths)), lengths)
        keys = []
        for n in range(lo, hi + 1):
            if len(tokens) >= n:
                grams, of = _grams(tokens, row, n)
                at = pc.index_in(grams, value_set=vocabulary)
                known = at.is_valid().to_numpy(zero_copy_only=False)
                keys.append(of[known] * max(1, len(vocabulary)) + at.drop_null().to_numpy())
        key, tf = np.unique(np.concatenate(keys) if keys else np.zeros(0, np.int64), return_counts=True)
        of, term = key // max(1, len(vocabulary)), key % max(1, len(vocabulary))
        out = [ids.take(pa.array(of)), vocabulary.take(pa.array(term)), pa.array(tf.astype(np.int64))]
        if idf is not None:
            w = (1 + np.log(tf) if sub else tf) * idf[term]
            norm = np.sqrt(np.bincount(of, w * w, minlength=len(lengths)))
            out.append(pa.array(w / norm[of]))
        return pa.RecordBatch.from_arrays(out, names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, lists = batch.column(0), batch.column(1)
            lengths = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            tokens, ends = lists.flatten(), np.cumsum(lengths)
            first = done = 0
            while first < len(ids):
                last = max(first + 1, int(np.searchsorted(ends, done + CHUNK_TOKENS, "right")))
                yield counted(ids.slice(first, last - first), tokens.slice(done, int(ends[last - 1]) - done), lengths[first:last])
                first, done = last, int(ends[last - 1])

    return df.select(id_col, tokens_col).mapInArrow(run, schema)


@dataclass
class TfidfModel:
    """Vocabulary table (term, n_docs, idf) of at most max_features rows; without that bound weights are joined instead of looked up."""
    vocabulary: DataFrame
    lo: int = 1
    hi: int = 2
    sublinear: bool = True
    max_features: int | None = MAX_FEATURES

    def terms(self) -> list[tuple[str, float]]:
        """Terms with their idf, in order."""
        return sorted((r.term, r.idf) for r in bounded_rows(self.vocabulary.select("term", "idf"), self.max_features or MAX_FEATURES, "vocabulary"))

    def transform(self, df: DataFrame, id_col: str, tokens_col: str) -> DataFrame:
        """id, term, tf, tfidf; rows are weighed where they lie."""
        if self.max_features is None:
            return self.weigh(_tf(df, [id_col], tokens_col, self.lo, self.hi), id_col)
        terms = self.terms()
        return count_rows(df, id_col, tokens_col, [t for t, _ in terms], self.lo, self.hi, [w for _, w in terms], self.sublinear)

    def weigh(self, tf: DataFrame, id_col: str) -> DataFrame:
        """Weights of a counted table (id, term, tf), for a vocabulary of any size."""
        weight = (sublinear(F.col("tf")) if self.sublinear else F.col("tf").cast("double")) * F.col("idf")
        raw = self.look_up(tf).withColumn("_w", weight)
        norm = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(Window.partitionBy(id_col)))  # one document
        return raw.select(id_col, "term", "tf", (F.col("_w") / norm).alias("tfidf"))

    def look_up(self, tf: DataFrame) -> DataFrame:
        """Rows (id, term, tf) of known terms with their idf. The most frequent terms are broadcast, so that the others have no hot key
        and join as they are: neither the vocabulary is repeated, nor the rows of frequent terms shuffled."""
        words = self.vocabulary.select("term", "idf", "n_docs")
        if fits(words):
            return tf.join(F.broadcast(words.drop("n_docs")), "term")
        cut = words.select("n_docs").orderBy(F.col("n_docs").desc()).limit(SMALL_ROWS + 1).agg(F.min("n_docs")).first()[0]
        often = words.where(F.col("n_docs") > cut).select("term", "idf")  # at most SMALL_ROWS
        found = tf.join(F.broadcast(often), "term", "left")
        rest = found.where("idf IS NULL").drop("idf").join(words.where(F.col("n_docs") <= cut).select("term", "idf").hint("merge"), "term")
        return found.where("idf IS NOT NULL").unionByName(rest)


def fit_tfidf(df: DataFrame, id_col: str, tokens_col: str, max_features: int | None = MAX_FEATURES, min_df: int = 2,
              max_df: float = 0.95, lo: int = 1, hi: int = 2, sub: bool = True, small_corpus: bool = False) -> TfidfModel:
    """Vocabulary by total count (ties by term), of any size if max_features is None. With small_corpus, min_df and max_features shrink
    with the rows: to a tenth and to fifty times their number."""
    n_docs = df.count()
    if small_corpus:
        min_df, max_features = min(min_df, max(1, n_docs // 10)), min(max_features or 50 * n_docs, 50 * max(n_docs, 1))
    stats = term_stats(df, tokens_col, lo, hi)
    kept = stats.where((F.col("n_docs") >= min_df) & (F.col("n_docs") <= max_df * n_docs))
    if max_features is not None:
        kept = kept.orderBy(F.col("total").desc(), "term").limit(max_features)
    vocabulary = materialize(kept.select("term", "n_docs", "total", smooth_idf(F.lit(float(n_docs)), F.col("n_docs")).alias("idf")))
    return TfidfModel(vocabulary, lo, hi, sub, max_features)


def tfidf_long(df: DataFrame, id_col: str, tokens_col: str, **options) -> DataFrame:
    """Fit and transform in one: a pass that counts terms, and one that weighs each row where it lies."""
    return fit_tfidf(df, id_col, tokens_col, **options).transform(df, id_col, tokens_col)


def _whole_groups(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.Table]:
    """Sorted rows (corpus, id, tokens) in runs of about `most` tokens that end with the last row of a (corpus, id)."""
    held, n = [], 0
    for batch in batches:
        if not len(batch):
            continue
        held.append(batch)
        n += len(batch.column(2).flatten())
        if n >= most:
            rows = pa.Table.from_batches(held)
            same = np.ones(len(rows), bool)
            for i in range(2):
                of, last = rows.column(i), batch.column(i)[-1]
                same &= (pc.fill_null(pc.equal(of, last), False) if last.is_valid else pc.is_null(of)).to_numpy()
            cut = int(np.argmax(same))  # the last (corpus, id) may go on
            if cut:
                yield rows.slice(0, cut)
            held = rows.slice(cut).to_batches()
            n = sum(len(b.column(2).flatten()) for b in held)
    if held:
        yield pa.Table.from_batches(held)


def _term_counts(rows: pa.Table, lo: int, hi: int, vocabulary: pa.Array | None = None) -> tuple[np.ndarray, np.ndarray, pa.Array, np.ndarray]:
    """Per (corpus, id) and term of sorted rows: the first row of the pair, the number of the term, all terms, and how often it is there.

    With a vocabulary other terms are left out. N-grams lie inside one row."""
    corpora, ids, lists = (rows.column(i).combine_chunks() for i in range(3))
    codes = [x.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False) for x in (corpora, ids)]
    new = np.concatenate([[True], (codes[0][1:] != codes[0][:-1]) | (codes[1][1:] != codes[1][:-1])])
    group, first = np.cumsum(new) - 1, np.flatnonzero(new)
    lengths = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    tokens, row = lists.flatten(), np.repeat(np.arange(len(lists)), lengths)
    parts = [_grams(tokens, row, n) for n in range(lo, hi + 1) if len(tokens) >= n]
    grams, of = pa.concat_arrays([g for g, _ in parts] or [pa.array([], pa.string())]), np.concatenate([r for _, r in parts] or [np.zeros(0, np.int64)])
    if vocabulary is None:
        coded = grams.dictionary_encode()
        terms, number = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    else:
        at = pc.index_in(grams, value_set=vocabulary)
        terms, of, number = vocabulary, of[at.is_valid().to_numpy(zero_copy_only=False)], at.drop_null().to_numpy().astype(np.int64)
    size = max(1, len(terms))
    key, tf = np.unique(group[of] * size + number, return_counts=True)
    return first[key // size], key % size, terms, tf.astype(np.int64)


def tfidf_by_corpus(df: DataFrame, corpus: str, id_col: str, tokens_col: str, max_features: int = 50, min_df: int = 2,
                    max_df: float = 0.8, lo: int = 1, hi: int = 2, sub: bool = False) -> DataFrame:
    """One vocabulary per corpus value (language, cluster, ...), each cut to its max_features terms.

    Tokens are dealt out by (corpus, id) and written once. A first pass counts the terms inside the tasks and shuffles one row per term,
    corpus and run of CHUNK_TOKENS tokens; a second one hands on only terms of the vocabularies, if these were counted small."""
    kinds = df.schema
    corpus_type, id_type = kinds[corpus].dataType, kinds[id_col].dataType
    dealt = materialize(df.select(F.col(corpus).alias("c"), F.col(id_col).alias("i"), F.col(tokens_col).alias("t")).repartition("c", "i").sortWithinPartitions("c", "i"))

    def per_corpus(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _whole_groups(batches, CHUNK_TOKENS):
            at, number, terms, tf = _term_counts(rows, lo, hi)
            coded = rows.column(0).combine_chunks().dictionary_encode(null_encoding="encode")
            size = max(1, len(terms))
            key, group, n_docs = np.unique(coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)[at] * size + number, return_inverse=True, return_counts=True)
            yield pa.RecordBatch.from_arrays([coded.dictionary.take(pa.array(key // size)), terms.take(pa.array(key % size)), pa.array(n_docs.astype(np.int64)),
                                              pa.array(np.bincount(group, tf, minlength=len(key)).astype(np.int64))], names=["c", "term", "n_docs", "total"])

    counted = dealt.mapInArrow(per_corpus, T.StructType([T.StructField("c", corpus_type), *T._parse_datatype_string("term string, n_docs long, total long").fields]))
    stats = counted.groupBy(F.col("c").alias(corpus), "term").agg(F.sum("n_docs").alias("n_docs"), F.sum("total").alias("total"))
    sizes = df.groupBy(corpus).agg(count_all().alias("_n"))
    kept = attach(stats, sizes, [corpus], ["term"]).where(
        (F.col("n_docs") >= min_df) & (F.col("n_docs") <= max_df * F.col("_n")))
    vocabulary = materialize(top_k_per_group(kept, [corpus], "total", max_features, "term").select(
        corpus, "term", smooth_idf(F.col("_n"), F.col("n_docs")).alias("idf")))
    known = None
    if fits(vocabulary):
        known = df.sparkSession.sparkContext.broadcast(pa.array(sorted({r["term"] for r in vocabulary.select("term").distinct().collect()}), pa.string()))

    def per_row(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _whole_groups(batches, CHUNK_TOKENS):
            at, number, terms, tf = _term_counts(rows, lo, hi, known and known.value)
            first = pa.array(at)
            yield pa.RecordBatch.from_arrays([rows.column(0).combine_chunks().take(first), rows.column(1).combine_chunks().take(first), terms.take(pa.array(number)), pa.array(tf)],
                                             names=[corpus, id_col, "term", "tf"])

    tf = dealt.mapInArrow(per_row, T.StructType([T.StructField(corpus, corpus_type), T.StructField(id_col, id_type), *T._parse_datatype_string("term string, tf long").fields]))
    weight = (sublinear(F.col("tf")) if sub else F.col("tf").cast("double")) * F.col("idf")
    raw = attach(tf, vocabulary, [corpus, "term"], [id_col]).withColumn("_w", weight)
    norm = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(Window.partitionBy(corpus, id_col)))  # one document
    return raw.select(corpus, id_col, "term", "tf", (F.col("_w") / norm).alias("tfidf"))


def tfidf_within(df: DataFrame, doc_col: str, pos_col: str, tokens_col: str, max_features: int | None = None,
                 lo: int = 1, hi: int = 1) -> DataFrame:
    """TF-IDF of the sentences of each document, every document being its own corpus: doc, pos, term, tf, tfidf, centre, first.

    `centre` is the sum of a term's weights in its document; `first` marks one row of each term and document.
    Rows are shuffled once by document and counted in runs of whole documents.
    """
    kinds = df.schema
    schema = T.StructType([T.StructField(doc_col, kinds[doc_col].dataType), T.StructField(pos_col, kinds[pos_col].dataType), T.StructField("term", T.StringType()), T.StructField("tf", T.LongType()),
                           T.StructField("tfidf", T.DoubleType()), T.StructField("centre", T.DoubleType()), T.StructField("first", T.BooleanType())])

    def weighed(rows: pa.Table) -> pa.RecordBatch:
        docs, places, lists = (rows.column(i).combine_chunks() for i in range(3))
        doc = np.concatenate([[0], np.cumsum(pc.not_equal(docs.slice(1), docs.slice(0, len(docs) - 1)).to_numpy(zero_copy_only=False))]).astype(np.int64)
        codes = places.dictionary_encode(null_encoding="encode")
        _, at, sentence = np.unique(doc * max(1, len(codes.dictionary)) + codes.indices.to_numpy(zero_copy_only=False), return_index=True, return_inverse=True)
        lengths = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        tokens, row = lists.flatten(), np.repeat(np.arange(len(docs)), lengths)
        parts = [_grams(tokens, row, n) for n in range(lo, hi + 1) if len(tokens) >= n]
        terms = pa.concat_arrays([g for g, _ in parts] or [pa.array([], pa.string())]).dictionary_encode()
        of = np.concatenate([r for _, r in parts] or [np.zeros(0, np.int64)])
        order = pc.sort_indices(terms.dictionary).to_numpy()
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        size = max(1, len(order))
        key, tf = np.unique(sentence[of] * size + place[terms.indices.to_numpy(zero_copy_only=False)], return_counts=True)
        s, t = key // size, key % size
        own, group, n_docs = np.unique(doc[at[s]] * size + t, return_inverse=True, return_counts=True)
        if max_features:
            total = np.bincount(group, tf, minlength=len(own))
            ranked = np.lexsort((own % size, -total, own // size))
            start = np.searchsorted(own // size, own[ranked] // size)  # ranked has the documents in the same order
            kept = np.empty(len(own), bool)
            kept[ranked] = np.arange(len(own)) - start < max_features
            s, t, tf, group = (x[kept[group]] for x in (s, t, tf, group))
        w = tf * (np.log((1 + np.bincount(doc)[doc[at[s]]]) / (1 + n_docs[group])) + 1)
        w = w / np.sqrt(np.bincount(s, w * w, minlength=len(at)))[s]
        first = np.zeros(len(s), bool)
        first[np.unique(group, return_index=True)[1]] = True
        found = pa.array(at[s])
        return pa.RecordBatch.from_arrays([docs.take(found), places.take(found), terms.dictionary.take(pa.array(order[t])), pa.array(tf.astype(np.int64)), pa.array(w),
                                           pa.array(np.bincount(group, w, minlength=len(own))[group]), pa.array(first)], names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            if not len(batch):
                continue
            held.append(batch)
            n += len(batch.column(2).flatten())
            if n >= CHUNK_TOKENS:
                rows = pa.Table.from_batches(held)
                same = pc.equal(rows.column(0), batch.column(0)[-1]).to_numpy()
                last = int(np.argmax(same))  # the last document may go on
                if last:
                    yield weighed(rows.slice(0, last))
                held = rows.slice(last).to_batches()
                n = sum(len(b.column(2).flatten()) for b in held)
        if held:
            yield weighed(pa.Table.from_batches(held))

    rows = df.where(F.col(doc_col).isNotNull()).select(doc_col, pos_col, tokens_col).repartition(doc_col).sortWithinPartitions(doc_col)
    return rows.mapInArrow(run, schema)


def count_model(df: DataFrame, tokens_col: str, out: str = "features", vocab_size: int = 1000, min_df: float = 2,
                max_df: float = 0.95) -> CountVectorizerModel:
    """Vocabulary by total count. Shares of the rows become numbers here: with a share the estimator keeps all tokens in memory to count the rows."""
    if min_df < 1 or max_df < 1:
        n = df.count()
        min_df, max_df = (x if x >= 1 else x * n for x in (min_df, max_df))
    return CountVectorizer(inputCol=tokens_col, outputCol=out, vocabSize=vocab_size, minDF=min_df, maxDF=max_df).fit(df)


def count_long(df: DataFrame, id_col: str, tokens_col: str, vocab_size: int = 1000, min_df: int = 2, max_df: float = 0.95) -> DataFrame:
    """Term counts over the vocab_size most frequent terms, long form."""
    n = df.count()
    stats = term_stats(df, tokens_col).where((F.col("n_docs") >= min_df) & (F.col("n_docs") <= max_df * n))
    vocab = [r.term for r in stats.orderBy(F.col("total").desc(), "term").select("term").limit(vocab_size).collect()]
    return count_rows(df, id_col, tokens_col, sorted(vocab))


def vector_stages(model: TfidfModel, tokens_col: str, out: str = "features") -> list:
    """ML stages giving L2-normalised count x idf vectors, all on the JVM and saved with the pipeline.

    `tokens_col` must hold the n-grams the model was fitted on.
    """
    rows = model.terms()
    counts = CountVectorizerModel.from_vocabulary([t for t, _ in rows], inputCol=tokens_col, outputCol="_counts")
    weighted = ElementwiseProduct(scalingVec=Vectors.dense([w for _, w in rows]), inputCol="_counts", outputCol="_weighted")
    return [counts, weighted, Normalizer(inputCol="_weighted", outputCol=out)]


def vocabulary_list(model: TfidfModel) -> list[str]:
    return [t for t, _ in model.terms()]


def assemble_features(tables: Sequence[DataFrame], id_col: str, columns: Sequence[str], out: str = "features") -> DataFrame:
    """Join feature tables on the id and assemble the named numeric columns."""
    base = tables[0]
    for t in tables[1:]:
        base = base.join(t, id_col)
    return VectorAssembler(inputCols=list(columns), outputCol=out, handleInvalid="keep").transform(base)
