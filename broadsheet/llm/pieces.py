"""SentencePiece segmentation: the n best paths through the piece lattice, and decoding."""

from __future__ import annotations

import heapq
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from broadsheet.llm.common import spread
from broadsheet.llm.minhash import parts

SPACE_MARK = "▁"
#: A character without a piece is spelt in bytes and costs so much more than the worst scored piece.
UNKNOWN_PENALTY = 10.0
#: Scores from here down mark pieces that merging never made.
UNSCORED = -1e8
#: Words a worker remembers before it starts afresh.
CACHED_WORDS = 400_000


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Pieces:
    """The vocabulary of a model file as a lattice: pieces and their scores; the best path has the largest sum."""

    _made: dict[str, "Pieces"] = {}

    @classmethod
    def of(cls, path: str) -> "Pieces":
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        plain = [i for i in range(n) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        self.edges = {model.id_to_piece(i): (i, float(model.get_score(i))) for i in plain}
        self.bytes = {int(model.id_to_piece(i)[3:5], 16): i for i in range(n) if model.is_byte(i)}
        self.shown = {i: model.id_to_piece(i).encode() for i in plain} | {i: bytes([b]) for b, i in self.bytes.items()}
        if len(self.bytes) < 256:
            raise ValueError("the model has no byte pieces: unknown characters could not be decoded")
        if any(a != SPACE_MARK and b == SPACE_MARK for p in self.edges for a, b in zip(p, p[1:])):
            raise ValueError("the model has pieces that go on over a space: words could not be segmented one by one")
        self.pairs = {p[i:i + 2] for p in self.edges for i in range(len(p) - 1)}
        # starts of pieces lead on, pieces carry (id, score)
        self.steps: dict[str, tuple[int, float] | None] = {p[:i]: None for p in self.edges for i in range(1, len(p))} | self.edges
        self.unknown = min(s for _, s in self.edges.values() if s > UNSCORED) - UNKNOWN_PENALTY
        self.words: dict[str, tuple] = {}
        self.kept = 0  # alternatives in the cache

    def n_best(self, word: str, n: int) -> list[tuple[float, list[int]]]:
        """(score, ids) of the n best segmentations, best first; equal scores in the order of the search, the same in each run.

        Forward Viterbi gives the best score from the start to each position. Backwards from the end, A* extends
        partial segmentations, the one with the largest score so far plus that forward score first; as it is
        exact, complete segmentations come out in the order of their scores.
        """
        size, steps = len(word), self.steps
        best = [0.0] + [float("-inf")] * size
        into: list[list[tuple[int, float, tuple[int, ...]]]] = [[] for _ in range(size + 1)]  # edges by their end
        for a in range(size):
            at, single = best[a], False
            for b in range(a + 1, size + 1):
                e = steps.get(word[a:b], False)
                if e is False:
                    break
                if e is not None:
                    into[b].append((a, e[1], (e[0],)))
                    single = single or b == a + 1
                    if at + e[1] > best[b]:
                        best[b] = at + e[1]
            if not single:
                into[a + 1].append((a, self.unknown, tuple(self.bytes[x] for x in word[a].encode("utf-8", "replace"))))
                if at + self.unknown > best[a + 1]:
                    best[a + 1] = at + self.unknown
        out: list[tuple[float, list[int]]] = []
        count = 0
        heap: list[tuple[float, int, int, float, tuple | None]] = [(-best[size], 0, size, 0.0, None)]
        while heap and len(out) < n:
            _, _, at, done, tail = heapq.heappop(heap)
            if at == 0:
                ids: list[int] = []
                while tail is not None:
                    ids.extend(tail[0])
                    tail = tail[1]
                out.append((done, ids))
                continue
            for a, s, i in into[at]:
                count += 1
                heapq.heappush(heap, (-(done + s + best[a]), count, a, done + s, (i, tail)))
        return out

    def chunk(self, word: str, n: int) -> tuple:
        """The n best of a word as (decodes, score, ids, score, ids ...), from the cache of the worker."""
        known = self.words.get(word)
        if known is None:
            best = self.n_best(word, n)
            packed = [x for s, i in best for x in (s, struct.pack(f"<{len(i)}I", *i))]
            shown = b"".join(map(self.shown.__getitem__, best[0][1])).decode("utf-8", "replace")
            known = self.words[word] = (shown == word, *packed)
        return known

    def encode(self, texts: pa.Array, n: int) -> Iterator[tuple[list[tuple[float, np.ndarray]], bool]]:
        """Per text its n best segmentations (score, ids), and whether the best one decodes to the text again.

        The lattice of a text is cut wherever no piece holds the two characters at the cut side by side, at spaces first
        of all. It is then a chain of small lattices: each different one is searched once, and the alternatives of a
        text are the smallest sums of what its parts lose.
        A null counts as empty; an empty text has one segmentation without ids.
        """
        texts = texts.fill_null("").cast(pa.large_string())
        marked = pc.match_substring(texts, SPACE_MARK).to_pylist()
        # runs of spaces, with the one that goes before each text, have pieces of their own
        runs = pc.match_substring_regex(texts, "^ |  ").to_numpy(zero_copy_only=False)
        lists = pc.split_pattern(texts, " ")
        at = lists.offsets.to_numpy().astype(np.int64)
        flat = lists.flatten().dictionary_encode()
        if len(self.words) > CACHED_WORDS or self.kept != n:
            self.words, self.kept = {}, n
        different = [SPACE_MARK + w for w in flat.dictionary.to_pylist()]
        index = flat.indices.to_numpy(zero_copy_only=False)
        mine = [index[at[t] - at[0]:at[t + 1] - at[0]] for t in range(len(texts))]
        empty = np.zeros(0, index.dtype)
        for t in np.flatnonzero(pc.equal(texts, "").to_numpy(zero_copy_only=False)):
            mine[t] = empty
        for t in np.flatnonzero(runs):
            words = self._split(texts[int(t)].as_py())
            mine[t] = np.arange(len(different), len(different) + len(words))
            different += words
        numbers: dict[str, int] = {}
        chain, per_word = [], np.empty(len(different), np.int64)
        for i, w in enumerate(different):
            cut = [0, *[j for j in range(1, len(w)) if w[j - 1:j + 1] not in self.pairs], len(w)]
            chain += [numbers.setdefault(w[a:b], len(numbers)) for a, b in zip(cut, cut[1:])]
            per_word[i] = len(cut) - 1
        links, link_at = np.array(chain, np.int64), np.cumsum(per_word) - per_word
        for t, x in enumerate(mine):
            k = per_word[x]
            ends = np.cumsum(k)
            mine[t] = links[np.repeat(link_at[x] - (ends - k), k) + np.arange(ends[-1])] if len(x) else empty
        found = [self.chunk(w, n) for w in numbers]
        score = np.array([f[1] for f in found])
        loss = np.full((len(found), n), np.inf)
        for i, f in enumerate(found):
            for k in range(1, (len(f) - 1) // 2):
                loss[i, k] = f[1] - f[1 + 2 * k]
        good = np.array([f[0] for f in found], dtype=bool)
        coded = [f[2] for f in found]
        size = np.fromiter(map(len, coded), np.int64, len(coded)) // 4
        ids, first = np.frombuffer(b"".join(coded), "<u4"), np.cumsum(size) - size
        for t, x in enumerate(mine):
            sizes = size[x]
            ends = np.cumsum(sizes)
            best = ids[np.repeat(first[x] - (ends - sizes), sizes) + np.arange(ends[-1])] if len(x) else np.zeros(0, np.uint32)
            out = [(float(score[x].sum()), best)]
            if n > 1 and len(x):
                for cost, changes in self._cheapest(loss[x], n):
                    pieces, here = [], 0
                    for word, k in changes:
                        pieces += [best[here:ends[word] - sizes[word]], np.frombuffer(found[x[word]][2 + 2 * k], "<u4")]
                        here = ends[word]
                    out.append((out[0][0] - cost, np.concatenate([*pieces, best[here:]])))
            yield out, bool(good[x].all()) and not marked[t]

    @staticmethod
    def _split(text: str) -> list[str]:
        marked = SPACE_MARK + text.replace(" ", SPACE_MARK)
        cuts = [i for i in range(len(marked)) if i == 0 or (marked[i] == SPACE_MARK and marked[i - 1] != SPACE_MARK)]
        return [marked[a:b] for a, b in zip(cuts, [*cuts[1:], len(marked)])]

    @staticmethod
    def _cheapest(loss: np.ndarray, n: int) -> list[tuple[float, list[tuple[int, int]]]]:
        """The n - 1 smallest sums of losses over words, without the sum of none: (cost, [(word, alternative) ...]).

        At most n - 1 words deviate in any of them, and they are among the n - 1 that lose least by their second best.
        """
        second = loss[:, 1]
        few = np.argpartition(second, n - 2)[:n - 1] if len(second) >= n else np.arange(len(second))
        edge = second[few].max()
        below = np.flatnonzero(second < edge)[:n - 1]
        few = sorted({*below.tolist(), *np.flatnonzero((second == edge) & np.isfinite(second))[:n - 1 - len(below)].tolist()})
        out: list[tuple[float, list[tuple[int, int]]]] = []
        heap, seen = [(0.0, (0,) * len(few))], set()
        while heap and len(out) < n - 1:
            cost, state = heapq.heappop(heap)
            if any(state):
                out.append((cost, [(w, k) for w, k in zip(few, state) if k]))
            for x, w in enumerate(few):
                following = (*state[:x], state[x] + 1, *state[x + 1:])
                if following[x] < n and np.isfinite(loss[w, following[x]]) and following not in seen:
                    seen.add(following)
                    heapq.heappush(heap, (float(sum(loss[v, k] for v, k in zip(few, following) if k)), following))
        return out

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: pieces and bytes joined, marks to spaces, without the one in front."""
        text = b"".join(map(self.shown.__getitem__, ids.tolist())).decode("utf-8", "replace").replace(SPACE_MARK, " ")
        return text.removeprefix(" ")


_FIELDS = [T.StructField("rank", T.IntegerType()), T.StructField("score", T.DoubleType()), T.StructField("n_tokens", T.LongType()), T.StructField("ids_crc32", T.LongType()), T.StructField("decoded", T.BooleanType())]


def n_best(docs: DataFrame, n: int = 3, model: str | None = None, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """The n best segmentations of every whole text: doc_id, rank (from 1), score, n_tokens, ids_crc32 (ids as little-endian
    unsigned 32-bit numbers), decoded (the ids decode to the text again), and ids on request. No shuffle.

    Texts with fewer segmentations have fewer rows, at least one. A null text counts as empty and has one row without
    ids; repeated rows give repeated results; other columns are ignored; an empty table gives no rows. A text
    that holds the space mark itself decodes to a space there.
    """
    if n < 1:
        raise ValueError("n must be 1 or more")
    path = model or default_model()
    rows = spread(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")), "doc_id")
    schema = T.StructType([rows.schema["doc_id"], *_FIELDS] + [T.StructField("ids", T.ArrayType(T.IntegerType()))] * keep_ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces.of(path)
        for batch in batches:
            for part in parts(batch, 1 << 22):
                where, columns = [], []
                for i, (best, decoded) in enumerate(pieces.encode(part.column(1), n)):
                    for rank, (score, ids) in enumerate(best, 1):
                        where.append(i)
                        columns.append((rank, score, len(ids), zlib.crc32(ids), decoded, *([ids.astype(np.int32)] if keep_ids else [])))
                if columns:
                    yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(where)), *[pa.array(c, t) for c, t in zip(
                        zip(*columns), [pa.int32(), pa.float64(), pa.int64(), pa.int64(), pa.bool_(), pa.list_(pa.int32())])]], names=schema.names)

    return rows.mapInArrow(run, schema)


def decode(rows: DataFrame, model: str | None = None, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id, text of rows with arrays of ids; null arrays give a null text."""
    path = model or default_model()
    narrow = rows.select(F.col(id_col).alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids"))
    schema = T.StructType([narrow.schema["doc_id"], T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces.of(path)
        for b in batches:
            texts = [None if x is None else pieces.decode(np.array(x, np.int64)) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=schema.names)

    return narrow.mapInArrow(run, schema)
