"""Quality rules: counted symptoms, and how far a text lies from the reference of its language."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from broadsheet.llm.common import SPACE, squeezed, stored, text_of, words_of

SYMBOLS = "[#*$%&|<>]"
#: Words of at most so many code points can be common words: function words are short, and there are few short words.
COMMON_CHARS = 4
#: Common words per language.
COMMON_WORDS = 32
#: Slices in which the words of a language are ranked first.
SLICES = 32
#: Languages with a reference of their own, those with most words; the rest is held against the pooled reference.
LANGUAGES = 64
#: Fewer words than these are too short for a histogram: such a text is not judged by distance.
MIN_WORDS = 50
MIN_COMMON = 20
#: Jensen-Shannon distances (0 to 1) above these reject.
MAX_CLASS_DISTANCE = 0.3
MAX_WORD_DISTANCE = 0.76
#: A language needs so many words for a reference.
MIN_REFERENCE_WORDS = 5000
CLASSES = ("space", "digit", "upper", "mark", "symbol", "other", "beyond")


def marked(text: Column) -> Column:
    """The characters of a text that are digits, capitals, marks or symbols: one pass leaves little to count in."""
    return F.regexp_replace(text, r"[^0-9A-Z.,;:!?'\"()\-#*$%&|<>]++", "")


def class_counts(text: Column, compact: Column, special: Column) -> list[Column]:
    """Characters by class, in the order of CLASSES; the last one counts the bytes that UTF-8 needs beyond one per character."""
    chars, solid, found = F.char_length(text), F.char_length(compact), F.char_length(special)
    digit, upper, mark = (found - F.char_length(F.regexp_replace(special, p, "")) for p in ("[0-9]++", "[A-Z]++", r"[.,;:!?'\"()-]++"))
    return [chars - solid, digit, upper, mark, found - digit - upper - mark, solid - found, F.octet_length(text) - chars]


def references(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Reference histograms by language over all rows: lang (null: pooled), classes (shares by CLASSES), shares.

    The vocabulary is the union of the common words of all languages; `shares` is how often the language uses each
    of them. Both aggregates combine before they shuffle; the result has at most LANGUAGES + 1 rows.
    """
    text = text_of(text_col)
    rows = docs.select(F.col(lang_col).cast("string").alias("lang"), text.alias("text"))
    by_class = rows.select("lang", "text", squeezed(F.col("text")).alias("compact"), marked(F.col("text")).alias("special"))
    by_class = by_class.select("lang", *[c.cast("long").alias(f"c{i}") for i, c in enumerate(class_counts(F.col("text"), F.col("compact"), F.col("special")))])
    sums = [F.sum(f"c{i}").alias(f"c{i}") for i in range(len(CLASSES))]
    by_class = stored(by_class.groupBy("lang").agg(*sums), "quality-classes")
    words = rows.select("lang", words_of(F.col("text")).alias("words"))
    # a null word carries the number of all words of the text
    short = F.concat(F.array(F.lit(None).cast("string")), F.filter("words", lambda w: F.char_length(w) <= COMMON_CHARS))
    each = words.select("lang", F.size("words").cast("long").alias("size"), F.explode(short).alias("word"))
    by_word = stored(each.groupBy("lang", "word").agg(F.sum(F.when(F.col("word").isNull(), F.col("size")).otherwise(F.lit(1))).alias("n")), "quality-words")
    main = by_word.where("word is null and lang is not null").where(F.col("n") >= MIN_REFERENCE_WORDS).orderBy(F.desc("n"), "lang").limit(LANGUAGES).select("lang")
    by_word = by_word.where("word is not null")
    nobody = F.lit(None).cast("string").alias("lang")
    counts = by_word.join(F.broadcast(main), "lang").unionByName(by_word.groupBy("word").agg(F.sum("n").alias("n")).select(nobody, "word", "n"))
    # ranked inside slices of a language first, as one language may hold most words
    place, part = F.row_number(), F.pmod(F.xxhash64("word"), F.lit(SLICES)).alias("slice")
    sliced = counts.select("*", part).withColumn("at", place.over(Window.partitionBy("lang", "slice").orderBy(F.desc("n"), "word"))).where(F.col("at") <= COMMON_WORDS)
    ranked = sliced.withColumn("at", place.over(Window.partitionBy("lang").orderBy(F.desc("n"), "word")))
    vocabulary = ranked.where(F.col("at") <= COMMON_WORDS).select("word").distinct()
    # at most (LANGUAGES + 1) * COMMON_WORDS words, so (LANGUAGES + 1) times as many shares
    uses = counts.join(F.broadcast(vocabulary), "word").groupBy("lang").agg(
        F.sum("n").alias("total"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("word", "n")))).alias("uses"))
    uses = uses.select("lang", F.transform_values("uses", lambda _, n: n / F.col("total")).alias("shares"))
    classes = by_class.join(F.broadcast(main), "lang").unionByName(by_class.groupBy(nobody).agg(*sums))
    total = sum((F.col(f"c{i}") for i in range(1, len(CLASSES))), F.col("c0"))
    classes = classes.select("lang", F.array(*[F.when(total > 0, F.col(f"c{i}") / total).otherwise(0.0) for i in range(len(CLASSES))]).alias("classes"))
    return stored(classes.join(uses, classes["lang"].eqNullSafe(uses["lang"]), "left").select(classes["lang"], "classes", "shares"), "quality-references")


def _divergence(p: Column, q: Column) -> Column:
    """One term of the Jensen-Shannon divergence in bits, both sides together."""
    half = (p + q) / 2
    return (F.when(p > 0, p * F.log2(p / half)).otherwise(0.0) + F.when(q > 0, q * F.log2(q / half)).otherwise(0.0)) / 2


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def with_quality(docs: DataFrame, refs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """`row` (the whole row as a struct) and the quality columns; a projection, no shuffle of texts.

    n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words; class_distance and word_distance (null where the
    guards of length say that a histogram means nothing); base_failed, kept. A null text is an empty one and fails
    for want of words; a null or rare language is held against the pooled reference.
    """
    text, row = text_of(text_col), F.struct(*[docs[c] for c in docs.columns])
    small = refs.select(F.col("lang").alias("ref_lang"), "classes", "shares")
    # at most (LANGUAGES + 1) * COMMON_WORDS words: a hash set inside the scan
    vocabulary = sorted({w for r in refs.select(F.map_keys("shares").alias("words")).collect() for w in r["words"] or ()})
    rows = docs.select(row.alias("row"), text.alias("text"), F.col(lang_col).cast("string").alias("lang"))
    own = small.where("ref_lang is not null").select("ref_lang", F.col("classes").alias("own_classes"), F.col("shares").alias("own_shares"))
    pooled = small.where("ref_lang is null").select("classes", "shares")
    rows = rows.join(F.broadcast(own), F.col("lang") == F.col("ref_lang"), "left").join(F.broadcast(pooled), how="left")  # one row
    rows = rows.select("row", "text", squeezed(F.col("text")).alias("compact"), marked(F.col("text")).alias("special"), words_of(F.col("text")).alias("words"),
                       F.coalesce("own_classes", "classes").alias("classes"), F.when(F.col("own_classes").isNotNull(), F.col("own_shares")).otherwise(F.col("shares")).alias("shares"))
    lines = F.filter(F.split("text", "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != "")
    n = F.size("words")
    counted = rows.select(
        "row", "words", "classes", "shares", lines.alias("lines"), n.alias("n"), F.char_length("compact").alias("word_chars"),
        F.array(*class_counts(F.col("text"), F.col("compact"), F.col("special"))).alias("counts"), F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"))
    # windows of two words, of four, of five: each word is hashed once
    for name, left, right, words in (("two", "hashes", "hashes", 2), ("four", "two", "two", 4), ("five", "four", "hashes", 5)):
        last = 1 + words // 2 if words < 5 else 5
        size = F.greatest(F.col("n") - (words - 1), F.lit(0))
        counted = counted.withColumn(name, F.zip_with(F.slice(left, F.lit(1), size), F.slice(right, F.lit(last), size), lambda x, y: F.xxhash64(x, y)))
    counted = counted.withColumnRenamed("five", "windows")
    common = F.sort_array(F.filter("words", lambda w: w.isin(vocabulary)))
    counted = counted.select(
        "row", "n", "word_chars", "counts", "classes", "shares", F.col("counts")[4].alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        common.alias("common"),
        # only texts in which a window returns are sorted
        F.when(F.size(F.array_distinct("windows")) < F.size("windows"),
               F.array_sort(F.transform("windows", lambda x, i: F.struct(x.alias("x"), i.alias("i"))))).alias("sorted"))
    last = F.size("sorted") - 1
    repeated = F.filter("sorted", lambda s, i: ((i > 0) & (F.get("sorted", i - 1)["x"] == s["x"])) | ((i < last) & (F.get("sorted", i + 1)["x"] == s["x"])))
    size = _total(F.transform("counts", lambda c: c.cast("double")))
    starts = F.filter(F.transform("common", lambda x, i: F.when((i == 0) | (F.get("common", i - 1) != x), i)), lambda i: i.isNotNull())  # of the runs of equal words
    counted = counted.select(
        "row", "n", "word_chars", "n_symbols", "n_dup_lines", "classes", "shares", "common", size.alias("size"), starts.alias("starts"),
        F.transform("counts", lambda c: c / F.when(size > 0, size)).alias("own_shares"), F.sort_array(F.transform(repeated, lambda s: s["i"])).alias("at"))
    n_common = F.size("common")
    terms = F.transform("starts", lambda a, i: F.struct(((F.coalesce(F.get("starts", i + 1), n_common) - a) / n_common).alias("p"),
                                                        F.coalesce(F.element_at("shares", F.get("common", a)), F.lit(0.0)).alias("q")))
    counted = counted.select(
        "row", "n", "word_chars", "n_symbols", "n_dup_lines", n_common.alias("n_common"), terms.alias("terms"), "shares",
        F.coalesce(F.aggregate("at", F.struct(F.lit(-5).alias("last"), F.lit(0).alias("n")), lambda a, i: F.struct(i.alias("last"), (a["n"] + F.least(F.lit(5), i - a["last"])).alias("n")),
                               lambda a: a["n"]), F.lit(0)).alias("n_repeat"),
        F.when((F.col("n") >= MIN_WORDS) & (F.col("size") > 0), F.sqrt(F.greatest(F.lit(0.0), _total(F.zip_with("own_shares", "classes", _divergence))))).alias("class_distance"))
    met = _total(F.transform("terms", lambda t: _divergence(t["p"], t["q"])))
    unmet = (1 - _total(F.transform("terms", lambda t: t["q"]))) / 2  # words of the reference that the text lacks
    base = (F.col("n") < 10) | (100 * F.col("n_repeat") > 20 * F.col("n"))
    out = counted.select(
        "row", F.col("n").cast("long").alias("n_words"), *[F.col(c).cast("long").alias(o) for c, o in (
            ("word_chars", "word_chars"), ("n_symbols", "n_symbols"), ("n_dup_lines", "n_dup_lines"), ("n_repeat", "n_repeat_words"))],
        "class_distance",
        F.when((F.col("n") >= MIN_WORDS) & (F.col("n_common") >= MIN_COMMON) & F.col("shares").isNotNull(), F.sqrt(F.greatest(F.lit(0.0), met + unmet))).alias("word_distance"),
        base.alias("base_failed"))
    far = (F.coalesce("class_distance", F.lit(0.0)) > MAX_CLASS_DISTANCE) | (F.coalesce("word_distance", F.lit(0.0)) > MAX_WORD_DISTANCE)
    # always true, but not deterministic: keeps the optimizer from pushing a filter on the verdict, multiplied out, below the projections
    barrier = F.monotonically_increasing_id() >= 0
    return out.withColumn("kept", ~F.col("base_failed") & ~far & barrier)


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per document: its identifier and the quality columns. An empty table gives no rows."""
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    return with_quality(narrow, references(narrow)).select(F.col("row.id").alias("doc_id"), *_OUT)


_OUT = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "class_distance", "word_distance")


def drop_bad(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Rows of `docs` that pass, with all their columns; repeated rows and null identifiers stay as they are."""
    return with_quality(docs, references(docs, text_col, lang_col), text_col, lang_col).where("kept").select("row.*")
