"""Main text of web pages: the contiguous region of maximum score, words for and tags against it."""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from broadsheet.llm.common import spread

#: Pages that carry their own label, one article or main element, are what the weights are fitted on: those with the
#: smallest hashes of the identifier, at most so many, over so many passes.
SAMPLE_PAGES, PASSES = 400, 30
#: A word is worth 1; tags never less than this against.
LEAST = 0.01
OUTSIDE = 4.0

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|svg|iframe|object|canvas|select|textarea|title|head(?=[\s>]))\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-z][a-z0-9:-]*)(?P<attributes>(?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')|=(?!\s*+[\"']))*+)>"
    r"|<(?P<open_close>/?)(?P<open_name>[a-z][a-z0-9:-]*)(?P<open_attributes>[^>]*+)>"  # a quote that never ends
    r"|</?[a-z][^>]*+\Z"  # cut off
    r"|<[!?/][^>]*(?:>|\Z)"
    r"|(?P<text>[^<]+|<)", re.I | re.S)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
#: Elements that begin and end a block of text; others run on inside it.
_BLOCKS = set("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li "
              "main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
#: Elements that are kept on a stack; the others may lack their end.
_CONTAINERS = set("article aside blockquote body details dialog div dl fieldset figure footer form header main menu nav ol section table ul button label".split())
#: Never part of an article: by element, and by a word in class, id or role.
_APART = set("aside dialog fieldset footer form menu nav button label".split())
_APART_WORDS = re.compile(r"(?:\A|[^a-z])(?:ads?|advert\w*|adslot|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notices?|alert|popup|modal|overlay|comments?|disqus|replies|respond|"
                          r"sidebar|widget|menu|nav|navbar|navigation|breadcrumbs?|toolbar|footer|masthead|site-?header|contentinfo|complementary|search|login|signup|subscribe|newsletter|"
                          r"share|sharing|social|related|recommended|pagination|pager|copyright|disclaimer)(?:[^a-z]|\Z)")


def tokens(page: str) -> list[tuple[str, object]]:
    """(feature, value) of a page: ('word', text), ('apart', text), ('/p', None) and the like; comments, scripts and styles are nothing."""
    out: list[tuple[str, object]] = []
    open_: list[tuple[str, bool]] = []
    apart = 0
    for m in _TOKEN.finditer(page):
        if m["text"] is not None:
            out.append(("apart" if apart else "word", m["text"]))
        elif m["name"] or m["open_name"]:
            close, name, attributes = (m["close"], m["name"].lower(), m["attributes"]) if m["name"] else (m["open_close"], m["open_name"].lower(), m["open_attributes"])
            if name in _CONTAINERS or name == "body":
                if not close:
                    away = name in _APART or (name == "header" and not any(n in ("article", "main") for n, _ in open_))
                    if not away and name not in ("article", "main", "body"):
                        away = any(_APART_WORDS.search(" ".join(x).lower()) for x in _NAMES.findall(attributes))
                    open_.append((name, away))
                    apart += away
                elif any(n == name for n, _ in open_):
                    while open_:
                        n, away = open_.pop()
                        apart -= away
                        if n == name:
                            break
            if not apart:  # the inside of an element apart is one stretch, whatever its markup
                out.append((close + name, None))
    return out


def score(found: list[tuple[str, object]], weights: dict[str, float]) -> tuple[int, int]:
    """Region [a, b) of maximum score, by one scan; the first of equal ones, empty if there is no word of worth."""
    unknown = weights.get("", -1.0)
    best, best_at, run, start = 0.0, (0, 0), 0.0, 0
    for i, (feature, text) in enumerate(found):
        if text is None:
            run += weights.get(feature, unknown)
        else:
            run += weights[feature] * len(text.split())  # type: ignore[attr-defined]
        if run <= 0:
            run, start = 0.0, i + 1
        elif run > best:
            best, best_at = run, (start, i + 1)
    return best_at


def labelled(found: list[tuple[str, object]]) -> tuple[int, int] | None:
    """Region of the one article (or main) element of a page, from its first to its last word; None if there is no such."""
    for name in ("article", "main"):
        opened = [i for i, (f, _) in enumerate(found) if f == name]
        if len(opened) == 1:
            closed = [i for i, (f, _) in enumerate(found) if f == f"/{name}"]
            words = [i for i in range(opened[0], closed[-1] if closed else len(found)) if found[i][0] == "word" and str(found[i][1]).split()]
            return (words[0], words[-1] + 1) if words else None
    return None


def fit(pages: list[str]) -> dict[str, float]:
    """Weights by feature from pages that label themselves.

    A tag first costs up to OUTSIDE words, by the share of its occurrences that lie outside the labelled regions; a
    perceptron then moves the tags that are wrongly taken or left. A word counts 1 and never changes; words in elements
    apart and tags are held below zero. '' is the weight of tags that no page had: the mean of the tags seen. Without
    labelled pages each tag costs 2 words.
    """
    weights: dict[str, float] = {"word": 1.0, "apart": -0.2}
    gold = [(t, g) for t in map(tokens, pages) if (g := labelled(t))]
    everywhere, inside = Counter(), Counter()
    for t, (a, b) in gold:
        everywhere.update(f for f, x in t if x is None)
        inside.update(f for f, x in t[a:b] if x is None)
    for f, n in everywhere.items():
        weights[f] = -LEAST - OUTSIDE * (1 - inside[f] / n)
    for _ in range(PASSES):
        wrong = 0
        for t, (a, b) in gold:
            c, d = score(t, weights)
            taken = Counter(f for f, x in t[c:d] if x is None)
            meant = Counter(f for f, x in t[a:b] if x is None)
            # the region may end with tags of no consequence: only words tell
            if [i for i in range(c, d) if t[i][1] is not None and str(t[i][1]).strip()] == [i for i in range(a, b) if t[i][1] is not None and str(t[i][1]).strip()]:
                continue
            wrong += 1
            for f in taken | meant:
                step = (meant[f] > taken[f]) - (meant[f] < taken[f])
                weights[f] = min(-LEAST, weights[f] + 0.1 * step)
        if not wrong:
            break
    tags = [w for f, w in weights.items() if f not in ("word", "apart")]
    weights[""] = sum(tags) / len(tags) if tags else -2.0
    return weights


def main_text(page: str, weights: dict[str, float]) -> str:
    """Blocks of the best region of a page, one white space between words, an empty line between blocks."""
    found = tokens(page)
    a, b = score(found, weights)
    blocks: list[str] = []
    block: list[str] = []
    for feature, text in found[a:b]:
        if text is not None:
            if feature == "word":
                block.append(str(text))
        elif feature.removeprefix("/") in _BLOCKS:
            blocks.append("".join(block))
            block = []
        elif feature == "br":
            block.append(" ")
    blocks.append("".join(block))
    clean = (" ".join(entities.unescape(x).split()) for x in blocks)
    return "\n\n".join(x for x in clean if x)


def labelled_sample(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", most: int = SAMPLE_PAGES) -> list[str]:
    """At most `most` pages that label themselves, for `fit`; the bound is the same at every size."""
    html = F.col(html_col).cast("string")
    rows = pages.select(F.xxhash64(F.col(id_col).cast("string"), F.substring(html, 1, 64)).alias("h"), html.alias("html")).where(F.col("html").rlike("(?i)<(article|main)[ >]"))
    # only hashes are ranked; pages travel once they are chosen
    chosen = rows.select("h").distinct().orderBy("h").limit(most)
    return sorted(r["html"] for r in rows.join(F.broadcast(chosen), "h", "left_semi").dropDuplicates(["h"]).collect())


def extract(pages: DataFrame, weights: dict[str, float] | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars: the main text of every page, whole; no shuffle.

    The weights are fitted on `labelled_sample` unless given. A null or empty page, or one without words, has the
    empty text. Repeated rows give repeated results; other columns are ignored; an empty table gives no rows.
    """
    weights = fit(labelled_sample(pages, id_col, html_col)) if weights is None else weights
    rows = spread(pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).cast("string").alias("html")), "page_id")
    schema = T.StructType([rows.schema["page_id"], rows.schema["url"], T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(x.as_py() or "", weights) for x in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=schema.names)

    return rows.mapInArrow(run, schema)
