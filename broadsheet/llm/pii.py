"""Personal data: base expressions with positions, and contextual extraction bootstrapped from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from broadsheet.llm.common import SPACE, stored, text_of

KINDS = ("email", "ip", "card", "phone")

#: The contract's expressions, written so that Java's matcher neither recurses nor looks at a run of characters twice:
#: a match starts at the start of its run (or where the last match ended), runs are possessive, groups do not repeat unbounded.
_LOCAL, _LABEL = "A-Za-z0-9._%+-", "A-Za-z0-9-"
PATTERNS = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[{_LABEL}]++\.[{_LABEL}][{_LABEL}.]*?(?=\.(?:[^{_LABEL}]|\z)|[^{_LABEL}.]|\z)",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # only whole runs of 13 to 19 digits: longer and shorter runs would fail the check and are not tried again
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){12,18}+(?![0-9])(?![ -][0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: A cheap test that a text without a match of the kind mostly fails.
HINTS = {"email": r"@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9]", "phone": r"\+[0-9]"}

#: Tokens that could be an identifier: they hold a digit or an at sign, and no more than so many characters.
MAX_TOKEN = 64
#: Neighbouring tokens of digits and marks, up to five short ones, are one candidate: a number may be written in groups.
_GROUP = r"[+(]{0,2}+[0-9][0-9().+/-]{0,9}+"
_TOKEN = rf"(?<![^ \t-\r])(?:{_GROUP}(?: {_GROUP}){{1,4}}+(?![^ \t-\r,;:!?])|[^ \t-\r0-9@]{{0,{MAX_TOKEN}}}+[0-9@][^ \t-\r]*+)"
#: Words on the left that make a context, alone or together, looked for in so many code points before a token.
CONTEXTS, LEFT_CHARS = (1, 2), 48
#: A pattern needs so many different instances that are known, and this share of its instances known, to discover others.
MIN_SUPPORT, MIN_CONFIDENCE, ROUNDS = 3, 0.8, 3

_FOUND = "array<struct<start:int,end:int,found:string,before:string>>"
_SPANS = "array<struct<kind:string,start:int,end:int>>"
#: Elements of a running sum that are folded at once; keeps the sums of very long arrays cheap.
_FOLD = 256


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    values = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(i % 2 == 1, c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)).otherwise(c.cast("int")))
    return F.aggregate(values, F.lit(0), lambda a, v: a + F.coalesce(v, F.lit(0))) % 10 == 0


def _valid(kind: str, found: Column) -> Column:
    digits = F.regexp_replace(found, "[^0-9]", "")
    if kind == "ip":  # leading zeros count for nothing
        return F.forall(F.split(found, r"\."), lambda p: p.rlike(r"\A0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])\z"))
    if kind == "card":
        return F.length(digits).between(13, 19) & luhn(digits)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def _running(values: Column) -> Column:
    """Inclusive running sums of an array column."""
    def total(xs: Column) -> Column:
        return F.aggregate(xs, F.lit(0), lambda a, x: a + x)

    def fold(xs: Column) -> Column:
        start = F.struct(F.lit(0).alias("sum"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(xs, start, lambda a, x: F.struct((a["sum"] + x).alias("sum"), F.concat(a["out"], F.array(a["sum"] + x)).alias("out")), lambda a: a["out"])

    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(values) - 1) / _FOLD).cast("int")), lambda b: F.slice(values, b * _FOLD + 1, F.lit(_FOLD)))
    ends = fold(F.transform(blocks, total))
    sums = F.zip_with(blocks, ends, lambda b, end: F.transform(fold(b), lambda v: v + end - total(b)))
    return F.when(F.size(values) > 0, F.flatten(sums)).otherwise(F.array().cast("array<int>"))


def _with_matches(rows: DataFrame, patterns: dict[str, tuple[str, str]]) -> DataFrame:
    """Add, per name, the matches in column `text` as (start, end, found, before) in code points; patterns: name to (hint, expression).

    Java gives the matches and, split at them, what lies between; their lengths add up to the positions. Each step is a
    projection of its own, so that no expression is evaluated again inside a lambda.
    """
    kept, empty = rows.columns, F.array().cast("array<string>")
    rows = rows.select(*kept, *[F.when(F.col("text").rlike(h), F.regexp_extract_all("text", F.lit(p), F.lit(0))).otherwise(empty).alias(f"_found_{k}") for k, (h, p) in patterns.items()])
    rows = rows.select("*", *[F.when(F.size(f"_found_{k}") > 0, F.slice(F.split("text", p, -1), F.lit(1), F.size(f"_found_{k}"))).otherwise(empty).alias(f"_gaps_{k}") for k, (_, p) in patterns.items()])
    rows = rows.select("*", *[F.zip_with(f"_gaps_{k}", f"_found_{k}", lambda g, f: F.char_length(g) + F.char_length(f)).alias(f"_steps_{k}") for k in patterns])
    rows = rows.select("*", *[_running(F.col(f"_steps_{k}")).alias(f"_ends_{k}") for k in patterns])
    return rows.select(*kept, *[F.zip_with(F.arrays_zip(F.col(f"_found_{k}").alias("f"), F.col(f"_gaps_{k}").alias("g")), F.col(f"_ends_{k}"), lambda m, e: F.struct(
        (e - F.char_length(m["f"])).alias("start"), e.alias("end"), m["f"].alias("found"), m["g"].alias("before"))).cast(_FOUND).alias(k) for k in patterns])


def shape(token: Column) -> Column:
    """The coarse class of a token: with an at sign or without. Its outline is left open, so that a context may discover other forms."""
    return F.when(token.contains("@"), F.lit("@")).otherwise(F.lit("9"))


def _contexts(left: Column) -> Column:
    """The last word before a token, and the last two, lower-cased; none at the start of a text or for a token after a token."""
    words = F.filter(F.split(F.btrim(F.lower(left), F.lit(SPACE)), r"[ \t-\r]+"), lambda w: w != "")
    n = F.size(words)
    return F.filter(F.array(*[F.when(n >= k, F.concat_ws(" ", F.slice(words, F.greatest(n - k + 1, F.lit(1)), F.lit(k)))) for k in CONTEXTS]), lambda c: c.isNotNull())


def _seen(docs: DataFrame) -> DataFrame:
    """Every column of `docs`, one of which is text, with base (kind, start, end) and tokens (start, end, token, seed, patterns); no shuffle."""
    kept = docs.columns
    rows = _with_matches(docs, {k: (HINTS[k], PATTERNS[k]) for k in KINDS} | {"tokens": ("[0-9@]", _TOKEN)})

    def valid(kind: str) -> Column:
        good = F.filter(kind, lambda m: _valid(kind, m["found"]))
        return F.transform(good, lambda m: F.struct(F.lit(kind).alias("kind"), m["start"].alias("start"), m["end"].alias("end")))

    rows = rows.select(*kept, "tokens", F.concat(*[valid(k) for k in KINDS]).cast(_SPANS).alias("base"))

    def entry(t: Column) -> Column:
        over = F.filter("base", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"]))
        kind_of = shape(t["found"])
        return F.struct(t["start"].alias("start"), t["end"].alias("end"), t["found"].alias("token"), F.get(over, F.lit(0))["kind"].alias("seed"),
                        F.transform(_contexts(F.right(t["before"], F.lit(LEFT_CHARS))), lambda c: F.xxhash64(c, kind_of)).alias("patterns"))

    return rows.select(*kept, "base", F.transform(F.filter("tokens", lambda t: F.char_length(t["found"]) <= MAX_TOKEN), entry).alias("tokens"))


def learn(seen: DataFrame, rounds: int) -> DataFrame:
    """pattern, kind of the patterns that may discover, over all rows of `seen`."""
    tokens = seen.select(F.explode("tokens").alias("t")).select(F.xxhash64("t.token").alias("token"), F.col("t.seed").alias("kind"), F.explode("t.patterns").alias("pattern"))
    # the graph: each different pair of pattern and token once, with the kind of a seed
    graph = stored(tokens.groupBy("pattern", "token").agg(F.min("kind").alias("kind")), "pii-graph")
    known = graph.where("kind is not null").groupBy("token").agg(F.min("kind").alias("kind"))
    for turn in range(rounds):
        scored = graph.select("pattern", "token").join(known, "token", "left").groupBy("pattern").agg(
            F.count(F.lit(1)).alias("all"), *[F.count_if(F.col("kind") == k).alias(k) for k in KINDS])
        best = F.greatest(*[F.struct(F.col(k).alias("n"), F.lit(k).alias("kind")) for k in KINDS])
        good = stored(scored.withColumn("best", best).where((F.col("best.n") >= MIN_SUPPORT) & (F.col("best.n") >= MIN_CONFIDENCE * F.col("all"))).select("pattern", F.col("best.kind").alias("kind")), "pii-patterns")
        if turn + 1 < rounds:
            found = graph.select("pattern", "token").join(good.withColumnRenamed("kind", "new"), "pattern").groupBy("token").agg(F.min("new").alias("new"))
            known = stored(known.join(found, "token", "full").select("token", F.coalesce("kind", "new").alias("kind")), "pii-known")
    return good


def _added(seen: DataFrame, good: DataFrame, keys: list[str]) -> DataFrame:
    """keys, added: the spans that the patterns discover outside the base matches, for rows that have any."""
    tokens = seen.select(*keys, F.explode("tokens").alias("t")).where("t.seed is null").select(*keys, "t.start", "t.end", F.explode("t.patterns").alias("pattern"))
    spans = tokens.join(good, "pattern").groupBy(*keys, "start", "end").agg(F.min("kind").alias("kind"))
    return spans.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("kind", "start", "end"))).cast(_SPANS).alias("added"))


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """Base matches of each whole text and what bootstrapped contexts add to them: one row per row of `docs`.

    The base matches are the seeds. Every token that holds a digit or an at sign and lies outside them is a candidate; a
    pattern is the words before a token together with its coarse class (with an at sign or without). In each round Spark scores the graph of
    patterns and instances: confidence = known instances / all instances, each different token counted once; the
    unknown tokens of patterns with at least MIN_SUPPORT known instances of a kind and MIN_CONFIDENCE become known
    as that kind and score the next round. Base matches and candidates are written once, without the texts, and are
    all that the rounds read; counts combine before they shuffle.

    Columns: doc_id, n_email, n_ip, n_card, n_phone (base matches), base (array of kind, start, end), added (the same, from
    patterns, never overlapping a base match). Positions are code points, the end is exclusive. A null text counts as
    empty; rows without matches have empty arrays; rows that repeat an identifier each have their own result; an
    empty table gives no rows; other columns are ignored.
    """
    narrow = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    # row numbers are fixed by writing them
    seen = stored(_seen(narrow).drop("text").withColumn("row", F.monotonically_increasing_id()), "pii-seen")
    added = _added(seen, learn(seen, rounds), ["row"])

    def number(kind: str) -> Column:
        return F.size(F.filter("base", lambda m: m["kind"] == kind)).cast("long")

    return seen.join(added, "row", "left").select(
        F.col("id").alias("doc_id"), *[number(k).alias(f"n_{k}") for k in KINDS],
        "base", F.coalesce("added", F.array().cast(_SPANS)).alias("added"))


def span_list(spans: Column) -> Column:
    """kind:start:end, by kind in the order of KINDS, then start; comma-joined."""
    order = F.array(*[F.lit(k) for k in KINDS])
    keyed = F.array_sort(F.transform(spans, lambda m: F.struct(F.array_position(order, m["kind"]).alias("k"), m["start"].alias("s"), m["end"].alias("e"), m["kind"].alias("kind"))))
    return F.array_join(F.transform(keyed, lambda m: F.concat_ws(":", m["kind"], m["s"].cast("string"), m["e"].cast("string"))), ",")


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """`docs` with every span replaced by its kind in brackets; same columns, same rows. A null text stays null.

    Rows are addressed by identifier and hash of the text, so rows that repeat an identifier keep apart; null
    identifiers are addressed like others.
    """
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    rows = docs.select(*[docs[c].alias(n) for c, n in names.items()], text_of(text_col).alias("text"))
    rows = rows.withColumn("key", F.xxhash64(F.coalesce(F.col(names[id_col]).cast("string"), F.lit("null")), "text"))
    seen = stored(_seen(rows.select("key", "text").where(F.col("text").rlike("[0-9@]"))).drop("text"), "pii-seen").where(F.size("base") + F.size("tokens") > 0)
    added = _added(seen, learn(seen, rounds), ["key"])
    spans = seen.select("key", "base").dropDuplicates(["key"]).join(added, "key", "left").select(
        "key", F.concat("base", F.coalesce("added", F.array().cast(_SPANS))).alias("spans")).where(F.size("spans") > 0)
    ordered = F.array_sort(F.transform("spans", lambda m: F.struct(m["start"].alias("start"), (-m["end"]).alias("minus_end"), m["kind"].alias("kind"))))
    # one copy of the text travels
    joined = rows.drop("text").join(spans, "key", "left").withColumns({"spans": ordered, "text": text_of(names[text_col])})
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(a: Column, m: Column) -> Column:
        fresh = F.concat(a["out"], F.substring("text", a["at"] + 1, m["start"] - a["at"]), F.lit("["), F.upper(m["kind"]), F.lit("]"))
        return F.struct(F.greatest(a["at"], -m["minus_end"]).alias("at"), F.when(m["start"] >= a["at"], fresh).otherwise(a["out"]).alias("out"))

    rewritten = F.aggregate("spans", start, step, lambda a: F.concat(a["out"], F.substring(F.col("text"), a["at"] + 1, F.char_length("text"))))
    return joined.select(*[(F.when(F.col("spans").isNull(), F.col(n)).otherwise(rewritten) if c == text_col else F.col(n)).alias(c) for c, n in names.items()])
