"""Token ids of whole texts by the tokenizers library, with a word cache in each worker."""

from __future__ import annotations

import os
import re
import struct

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words a worker remembers before it starts afresh; about 100 MB.
CACHED_WORDS = 400_000

#: Latin letters that are NFC and lower-case one to one, then ASCII marks other than the apostrophe (which may start a contraction).
_PLAIN = re.compile("([a-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\\[-`{-~]*)")


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _byte_letters() -> dict[int, str]:
    """The printable stand-ins of byte-level BPE for the two UTF-8 bytes of U+00C0 to U+00FF."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    letter = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return {c: "".join(letter[b] for b in chr(c).encode()) for c in range(0xC0, 0x100)}


class Encoder:
    """Ids of texts for a vocabulary whose rules never look across white space (lower case, words with an end mark).

    Then the ids of a text are those of its words in order, and each different word needs to be encoded once. Words of
    plain letters go straight to the BPE model; everything else through the library's full pipeline; texts that hold
    `<|`, which could be part of a special token, are encoded whole.
    """

    _made: dict[str, "Encoder"] = {}

    @classmethod
    def of(cls, path: str) -> "Encoder":
        """The worker's encoder for this file."""
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks already use the cores
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self._bytes = _byte_letters()
        self._words: dict[str, bytes] = {"": b""}
        self._marks: dict[str, bytes] = {"": b""}

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [struct.pack(f"<{len(e.ids)}I", *e.ids) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, words: list[str]) -> None:
        known, marks, model, hard = self._words, self._marks, self.tokenizer.model, []
        for w in words:
            m = _PLAIN.fullmatch(w)
            if not m:
                hard.append(w)
                continue
            letters, mark = m.groups()
            if not letters.isascii():
                letters = letters.lower().translate(self._bytes)
            ids = [t.id for t in model.tokenize(letters)]
            if mark not in marks:
                if len(marks) > 10_000:
                    marks.clear()
                marks[mark] = self._whole([mark])[0] if mark else b""
            known[w] = struct.pack(f"<{len(ids)}I", *ids) + marks[mark]
        for i in range(0, len(hard), 5000):
            known.update(zip(hard[i:i + 5000], self._whole(hard[i:i + 5000])))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (uint32) and the offset of each text's first id (n + 1 numbers). A null counts as empty."""
        texts = texts.fill_null("").cast(pa.large_string())
        special = pc.match_substring(texts, "<|").to_numpy(zero_copy_only=False)
        plain = pc.if_else(pa.array(special), "", texts) if special.any() else texts
        words = pc.ascii_split_whitespace(pc.ascii_lower(plain))
        word_at = words.offsets.to_numpy().astype(np.int64)
        flat = words.flatten().dictionary_encode()
        different = flat.dictionary.to_pylist()
        if len(self._words) > CACHED_WORDS:
            self._words = {"": b""}
        fresh = [w for w in different if w not in self._words]
        if fresh:
            self._learn(fresh)
        coded = [self._words[w] for w in different]
        size = np.fromiter(map(len, coded), np.int64, len(coded)) // 4
        ids = np.frombuffer(b"".join(coded), "<u4")
        first = np.cumsum(size) - size
        index = flat.indices.to_numpy(zero_copy_only=False)
        n = size[index]
        ends = np.cumsum(n)
        total = int(ends[-1]) if len(ends) else 0
        out = ids[np.repeat(first[index] - (ends - n), n) + np.arange(total)] if total else np.zeros(0, np.uint32)
        at = np.concatenate([[0], ends])[word_at - word_at[0]]
        if not special.any():
            return out, at
        pieces, counts = [], np.diff(at)
        for i in range(len(texts)):
            got = np.array(self.tokenizer.encode(texts[i].as_py(), add_special_tokens=False).ids, np.uint32) if special[i] else out[at[i]:at[i + 1]]
            pieces.append(got)
            counts[i] = len(got)
        return np.concatenate(pieces), np.concatenate([[0], np.cumsum(counts)])
