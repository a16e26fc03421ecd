"""Token ids by a tokenizers file, with a per-process cache of word pieces.

The file's tokenizer (`word_bpe_49k.json`) drops white space and encodes every
pre-token on its own, so the ids of a text are the joined ids of its pre-tokens.
Texts of plain Latin characters are cut by the same pattern here and looked up in
a cache; every other text, and every text that may hold a special token, goes
through the library whole.  Both ways give the library's ids.
"""

from __future__ import annotations

import os
import re

import numpy as np

CACHE_WORDS = 200_000  # distinct pre-tokens kept per Python process

# Letters, digits and white space of U+0000..U+017F, lower case, as the file's pattern sees them.
_L = "a-zªµºß-öø-ÿĀ-ſ"
_N = "0-9²³¹¼½¾"
_S = "\t\n\x0b\x0c\r \x85\xa0"
_PIECES = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_L}]+|[{_N}]|[^{_S}{_L}{_N}]+")
_PLAIN = re.compile("[\u0000-įı-ſ]*")

_loaded: dict[str, WordIds] = {}


class WordIds:
    """Ids of texts as little-endian unsigned 32-bit buffers."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core; threads would only wait for each other
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.cache: dict[str, bytes] = {}
        vocab = self.tok.get_vocab()
        self.last = np.zeros(max(vocab.values()) + 1, dtype=bool)  # ids that end a pre-token
        self.last[[i for t, i in vocab.items() if t.endswith("</w>")]] = True

    def _ids(self, text: str) -> np.ndarray:
        # the batch call that does not follow the places of ids in the text; the ids are those of encode
        return np.array(self.tok.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")

    def _learn(self, words: list[str]) -> None:
        """Puts the ids of ``words`` into the cache: one call for all, cut after each id that ends a pre-token."""
        ids = self._ids(" ".join(words))
        ends = (4 * (np.flatnonzero(self.last[ids]) + 1)).tolist()
        if len(ends) != len(words):  # a file whose pre-tokens do not end so
            self.cache.update((w, self._ids(w).tobytes()) for w in words)
            return
        buf = ids.tobytes()
        self.cache.update((w, buf[s:e]) for w, s, e in zip(words, [0, *ends], ends, strict=False))

    def encode(self, texts: list[str | None]) -> list[bytes]:
        if len(self.cache) > CACHE_WORDS:
            self.cache.clear()
        cut = [
            _PIECES.findall(t.lower()) if t and "<|" not in t and _PLAIN.fullmatch(t) else None for t in texts
        ]
        cache = self.cache
        new = list({w for ws in cut if ws for w in ws if w not in cache})
        for at in range(0, len(new), 5000):
            self._learn(new[at : at + 5000])
        return [
            b"".join(map(cache.__getitem__, ws)) if ws is not None else self._ids(t).tobytes() if t else b""
            for ws, t in zip(cut, texts, strict=True)
        ]


def word_ids(path: str) -> WordIds:
    if path not in _loaded:
        _loaded[path] = WordIds(path)
    return _loaded[path]


def slices(texts: list[str | None], most: int = 1 << 22):
    """Runs of texts of about ``most`` characters, so that a batch of long texts is worked on in parts."""
    run, size = [], 0
    for t in texts:
        run.append(t)
        size += len(t or "")
        if size >= most:
            yield run
            run, size = [], 0
    if run:
        yield run
