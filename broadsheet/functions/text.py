"""Text expressions: every function takes and returns Columns built from built-in functions (NFKD excepted)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from broadsheet.functions.wordlists import NEWS_LEXICONS, NEWS_STOP_WORDS, TRANSITIONS

TOKEN = r"[\p{L}\p{N}_'-]+|[^\s\p{L}\p{N}]"
WORD_TOKEN = r"[\p{L}\p{N}_'-]+"
URL = r"https?://\S+"
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
PHONE = r"(\+?1[-.\s]?)?\(?[0-9]{3}\)?[-.\s]?[0-9]{3}[-.\s]?[0-9]{4}"
SENTINEL = "\u0001"
VOWELS = "[aeiouy]+"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def words(c: str | Column) -> Column:
    """White-space words, as a split without blanks."""
    return F.filter(F.split(col(c), r"\s+"), lambda w: w != "")


def strip(c: str | Column) -> Column:
    """Trim every kind of white space, not blanks only."""
    return F.regexp_replace(col(c), r"^\s+|\s+$", "")


def ratio(a: Column, b: Column) -> Column:
    """a / b with 0 where b is 0."""
    return F.when(b == 0, F.lit(0.0)).otherwise(a.cast("double") / b)


def at_least_one(c: Column) -> Column:
    return F.greatest(c, F.lit(1))


def sentence_runs(c: str | Column) -> Column:
    return F.regexp_count(col(c), F.lit("[.!?]+")) + 1


def text_counts(c: str | Column) -> Column:
    """struct<chars, words, sentences>; sentences are the runs of final marks plus one."""
    return F.struct(F.length(col(c)).alias("chars"), F.size(words(c)).alias("words"),
                    sentence_runs(c).alias("sentences"))


# ---- cleaning ------------------------------------------------------------------------------------------------

def normalize_unicode(c: str | Column, form: str = "NFKD") -> Column:
    """Unicode normal form. Pure ASCII rows stay on the JVM; only the others take the Arrow batch."""

    @F.pandas_udf("string")
    def normal(s: pd.Series) -> pd.Series:
        return s.str.normalize(form)

    c = col(c)
    return F.when(c.rlike(r"^\p{ASCII}*$"), c).otherwise(normal(c))


def remove_urls(c):
    return F.regexp_replace(col(c), URL, "")


def remove_emails(c):
    return F.regexp_replace(col(c), EMAIL, "")


def remove_phones(c):
    return F.regexp_replace(col(c), PHONE, "")


def collapse_ws(c):
    return F.trim(F.regexp_replace(col(c), r"\s+", " "))


CLEAN_STEPS = {"normalize_unicode": True, "remove_urls": True, "remove_emails": True, "remove_phones": True,
               "lower": True, "collapse_ws": True}


def clean_text(c: str | Column, steps: Mapping[str, bool] | None = None) -> Column:
    """Run the switched-on steps in their fixed order. Null text becomes ''."""
    on = {**CLEAN_STEPS, **(steps or {})}
    unknown = set(on) - set(CLEAN_STEPS)
    if unknown:
        raise ValueError(f"unknown cleaning steps: {sorted(unknown)}")
    actions = {"normalize_unicode": normalize_unicode, "remove_urls": remove_urls, "remove_emails": remove_emails,
               "remove_phones": remove_phones, "lower": F.lower, "collapse_ws": collapse_ws}
    out = F.coalesce(col(c), F.lit(""))
    for name in CLEAN_STEPS:
        if on[name]:
            out = actions[name](out)
    return out


def simple_normalize(c):
    return collapse_ws(F.regexp_replace(F.lower(col(c)), r"[^a-zA-Z0-9\s]", " "))


# ---- tokens --------------------------------------------------------------------------------------------------

def tokenize(c):
    return F.regexp_extract_all(col(c), F.lit(TOKEN), 0)


def word_tokens(c):
    """Lower-case word tokens without punctuation."""
    return F.regexp_extract_all(F.lower(col(c)), F.lit(WORD_TOKEN), 0)


def drop_punct_tokens(tokens, drop_numbers: bool = False):
    keep = F.filter(col(tokens), lambda t: t.rlike(r"[\p{L}\p{N}]"))
    return F.filter(keep, lambda t: ~t.rlike(r"^\p{N}+$")) if drop_numbers else keep


def drop_stopwords(tokens, stopwords: Iterable[str] = (), min_len: int = 2, add: Iterable[str] = (),
                   remove: Iterable[str] = ()):
    stop = sorted((set(stopwords) | set(NEWS_STOP_WORDS) | set(add)) - set(remove))
    return F.filter(col(tokens), lambda t: (F.length(t) >= min_len) & ~F.lower(t).isin(stop))


def lemmatize(df: DataFrame, id_col: str, tokens_col: str, lemma_df: DataFrame, out: str = "tokens") -> DataFrame:
    """Replace tokens by their lemma where the (token, lemma) table has one."""
    from broadsheet.plans.sized import attach
    long = df.select(id_col, F.posexplode(tokens_col).alias("pos", "token"))
    looked = attach(long, lemma_df.select("token", "lemma").dropDuplicates(["token"]), ["token"], [id_col, "pos"], "left")
    back = looked.groupBy(id_col).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", F.coalesce("lemma", "token").alias("t")))),
                    lambda x: x["t"]).alias("_lemmas"))
    return df.drop(out).join(back, id_col, "left").withColumn(
        out, F.coalesce("_lemmas", F.array().cast("array<string>"))).drop("_lemmas")


def preprocess_text(df: DataFrame, text_col: str, steps: Mapping[str, bool] | None = None,
                    stopwords: Iterable[str] = (), lemma_df: DataFrame | None = None, id_col: str = "doc_id",
                    drop_numbers: bool = False, out: str = "processed") -> DataFrame:
    tokens = drop_stopwords(drop_punct_tokens(tokenize(clean_text(text_col, steps)), drop_numbers), stopwords)
    df = df.withColumn("_tokens", tokens)
    if lemma_df is not None:
        df = lemmatize(df, id_col, "_tokens", lemma_df, "_tokens")
    return df.withColumn(out, F.array_join("_tokens", " ")).drop("_tokens")


def sentences(c):
    """Sentences: split after a final mark followed by white space."""
    marked = F.regexp_replace(col(c), r"([.!?])\s+", "$1" + SENTINEL)
    return F.filter(F.split(marked, SENTINEL), lambda s: s.rlike(r"\S"))


def explode_sentences(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.select(id_col, F.posexplode(sentences(text_col)).alias("pos", "sentence"))


def ngrams(tokens, lo: int, hi: int):
    """All n-grams of lo..hi tokens joined by a blank. Pass the tokens as a column: lambdas re-evaluate expressions."""
    t = col(tokens)
    empty = F.array().cast("array<string>")

    def of(n: int) -> Column:
        if n == 1:
            return t
        shorter = of(n - 1)
        heads = F.slice(shorter, F.lit(1), F.size(t) - (n - 1))
        tails = F.slice(t, F.lit(n), F.size(t) - (n - 1))
        return F.when(F.size(t) >= n, F.zip_with(heads, tails, lambda a, b: F.concat(a, F.lit(" "), b))).otherwise(empty)

    return of(lo) if lo == hi else F.concat(*[of(n) for n in range(lo, hi + 1)])


# ---- measures ------------------------------------------------------------------------------------------------

def text_statistics(df: DataFrame, text_col: str) -> DataFrame:
    w = words(text_col)
    s = F.size(sentences(text_col))
    return df.withColumns({
        "chars": F.length(text_col), "words": F.size(w), "sentences": s,
        "words_per_sentence": ratio(F.size(w), s), "unique_words": F.size(F.array_distinct(F.transform(w, F.lower)))})


def total_length(ws: Column) -> Column:
    return F.aggregate(ws, F.lit(0), lambda acc, w: acc + F.length(w))


def linguistic_features(df: DataFrame, text_col: str) -> DataFrame:
    c = F.col(text_col)
    w, s, n = words(c), sentences(c), F.length(c)
    return df.withColumns({
        "char_count": n, "word_count": F.size(w), "sentence_count": F.size(s),
        "mean_word_length": ratio(total_length(w), F.size(w)),
        "mean_sentence_length": ratio(F.size(w), F.size(s)),
        "exclamations": F.regexp_count(c, F.lit("!")), "questions": F.regexp_count(c, F.lit(r"\?")),
        "upper_share": ratio(F.regexp_count(c, F.lit(r"\p{Lu}")), n),
        "digit_share": ratio(F.regexp_count(c, F.lit(r"\p{Nd}")), n)})


def syllables(ws: Column) -> Column:
    return F.aggregate(ws, F.lit(0), lambda acc, w: acc + F.greatest(F.regexp_count(F.lower(w), F.lit(VOWELS)), F.lit(1)))


def _reading(c):
    w = words(c)
    n = at_least_one(F.size(w))
    s = at_least_one(F.size(sentences(c)))
    return n.cast("double") / s, syllables(w).cast("double") / n


def flesch_ease(c):
    per_sentence, per_word = _reading(c)
    return F.lit(206.835) - F.lit(1.015) * per_sentence - F.lit(84.6) * per_word


def flesch_kincaid(c):
    per_sentence, per_word = _reading(c)
    return F.lit(0.39) * per_sentence + F.lit(11.8) * per_word - F.lit(15.59)


def dot_pieces(c):
    """Pieces between full stops that are not blank."""
    return F.filter(F.split(col(c), r"\."), lambda s: s.rlike(r"\S"))


def complex_share(c, w: Column | None = None):
    """w: the words of c, where they are at hand."""
    w = words(c) if w is None else w
    return ratio(F.size(F.filter(w, lambda x: F.length(x) > 6)), F.size(w))


def bias_readability(c, w: Column | None = None):
    w = words(c) if w is None else w
    s = at_least_one(F.size(dot_pieces(c)))
    return F.lit(206.835) - F.lit(1.015) * (F.size(w).cast("double") / s) - F.lit(84.6) * complex_share(c, w)


def banded(score: Column, bands: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """Label of the first bound the score reaches."""
    out = F.when(score >= bands[0][0], bands[0][1])
    for bound, label in bands[1:]:
        out = out.when(score >= bound, label)
    return out.otherwise(otherwise)


READING_BANDS = [(90, "very_easy"), (80, "easy"), (70, "fairly_easy"), (60, "standard"), (50, "fairly_difficult"),
                 (30, "difficult")]


def readability_band(score):
    return banded(col(score), READING_BANDS, "very_difficult")


def occurrences(c: Column, term: str) -> Column:
    """Non-overlapping occurrences of a substring."""
    return ((F.length(c) - F.length(F.replace(c, F.lit(term), F.lit("")))) / len(term)).cast("int")


def news_features(df: DataFrame, text_col: str, lexicons: Mapping[str, Sequence[str]] = NEWS_LEXICONS) -> DataFrame:
    low = F.lower(text_col)
    w = words(text_col)
    n = at_least_one(F.size(w))
    out = {}
    for name, terms in lexicons.items():
        total = F.lit(0)
        for t in terms:
            total = total + occurrences(low, t)
        out[f"{name}_count"] = total
        out[f"{name}_ratio"] = total.cast("double") / n
    quotes = F.floor(occurrences(F.col(text_col), '"') / 2).cast("int")
    out["quote_count"] = quotes
    out["quote_ratio"] = quotes.cast("double") / n
    out["number_tokens"] = F.size(F.filter(w, lambda x: x.rlike(r"\d")))
    out["percent_count"] = occurrences(F.col(text_col), "%") + occurrences(low, "percent")
    return df.withColumns(out)


def vocab_diversity(c):
    w = F.transform(words(c), F.lower)
    return ratio(F.size(F.array_distinct(w)), F.size(w))


def preview(c, n: int):
    c = col(c)
    return F.when(F.length(c) > n, F.concat(F.substring(c, 1, n), F.lit("..."))).otherwise(c)


def title_words(c, n: int = 10):
    w = words(c)
    return F.concat(F.array_join(F.slice(w, 1, n), " "), F.when(F.size(w) > n, "...").otherwise(""))


def extract_numbers(c):
    return F.regexp_extract_all(col(c), F.lit(r"\d+"), 0)


def number_density(c):
    w = words(c)
    return ratio(F.size(F.filter(w, lambda x: x.rlike(r"\d"))), F.size(w))


def chunk_sentences(df: DataFrame, id_col: str, text_col: str, max_words: int) -> DataFrame:
    """Greedy packing of whole sentences into chunks of at most max_words words (a longer sentence stands alone)."""
    empty = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("open"), F.lit(0).alias("n"))

    def step(acc, s):
        k = F.size(words(s))
        full = (acc["n"] > 0) & (acc["n"] + k > max_words)
        return F.struct(
            F.when(full, F.array_append(acc["done"], acc["open"])).otherwise(acc["done"]).alias("done"),
            F.when(full | (acc["n"] == 0), s).otherwise(F.concat_ws(" ", acc["open"], s)).alias("open"),
            F.when(full, k).otherwise(acc["n"] + k).alias("n"))

    packed = F.aggregate(sentences(text_col), empty, step,
                         lambda acc: F.when(acc["n"] > 0, F.array_append(acc["done"], acc["open"])).otherwise(acc["done"]))
    return df.select(id_col, F.posexplode(packed).alias("chunk", "text"))


def segment_text(c, width: int = 200):
    """Sentences if there are two or more, else blank-line paragraphs, else pieces of `width` characters."""
    c = col(c)
    s = F.transform(sentences(c), strip)
    paragraphs = F.filter(F.transform(F.split(c, r"\n\s*\n"), strip), lambda p: p != "")
    starts = F.when(F.length(c) > 0, F.sequence(F.lit(1), F.length(c), F.lit(width))).otherwise(
        F.array().cast("array<int>"))
    pieces = F.transform(starts, lambda i: F.substring(c, i, F.lit(width)))
    return F.when(F.size(s) > 1, s).when(F.size(paragraphs) > 1, paragraphs).otherwise(pieces)


def first_words(c, n: int = 500):
    return F.array_join(F.slice(words(c), 1, n), " ")


def capitalize_sentences(c):
    return F.array_join(F.transform(
        sentences(collapse_ws(c)),
        lambda s: F.concat(F.upper(F.substring(s, 1, 1)), F.substring(s, F.lit(2), F.length(s)))), " ")


def pin(df: DataFrame, cols: Mapping[str, Column]) -> DataFrame:
    """Add columns that later filters must not recompute.

    A filter on a projected column is pushed below the projection with a copy of its whole expression; a
    one-row generator keeps the values where they were computed.
    """
    row = F.struct(*[c.alias(n) for n, c in cols.items()])
    keep = [c for c in df.columns if c not in cols]
    return df.select(*keep, F.inline(F.array(row)))


def one_of(terms: Iterable[str]):
    """Predicate for array filters: the element is in the list."""
    known = list(terms)
    return lambda t: t.isin(known)


def contained(c: Column, terms: Sequence[str]) -> Column:
    """Array of the terms that occur in the (already lower-case) text, in list order."""
    return F.filter(F.array(*[F.lit(t) for t in terms]), lambda t: F.contains(c, t))


def hit_count(c: Column, terms: Sequence[str]) -> Column:
    total = F.lit(0)
    for t in terms:
        total = total + F.contains(c, F.lit(t)).cast("int")
    return total


def any_hit(c: Column, terms: Sequence[str]) -> Column:
    out = F.lit(False)
    for t in terms:
        out = out | F.contains(c, F.lit(t))
    return out


def coherence(sents: Column) -> Column:
    """Mean of transition words per sentence (at most 1) and 1 - CV of the sentence lengths (at least 0)."""
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("h"), F.lit(0.0).alias("s"), F.lit(0.0).alias("q"))

    def add(acc, sent):
        k = F.size(words(sent)).cast("double")
        return F.struct((acc["n"] + 1).alias("n"), (acc["h"] + hit_count(F.lower(sent), TRANSITIONS)).alias("h"),
                        (acc["s"] + k).alias("s"), (acc["q"] + k * k).alias("q"))

    def finish(acc):
        mean = acc["s"] / acc["n"]
        var = F.greatest(acc["q"] / acc["n"] - mean * mean, F.lit(0.0))
        even = F.when(mean > 0, F.greatest(F.lit(0.0), 1 - F.sqrt(var) / mean)).otherwise(F.lit(0.0))
        return F.when(acc["n"] == 0, F.lit(0.0)).otherwise(
            (F.least(acc["h"].cast("double") / acc["n"], F.lit(1.0)) + even) / 2)

    return F.aggregate(sents, zero, add, finish)
