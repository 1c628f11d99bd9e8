"""Token ids of whole texts with a public tokenizer file, fast inside tasks.

Tokenizers that drop white space give each space-separated chunk its ids
whatever stands around it, so chunks are encoded once and looked up after.
``ChunkEncoder`` checks that property on the file's own settings and encodes
whole texts where it does not hold.
"""

from __future__ import annotations

import gc
import json
import os
from array import array

import numpy as np

# Chunks a task's process remembers in each of two generations: what is met
# again moves to the younger one, the older is dropped when that is full.
CACHED_CHUNKS = 450_000


# Byte-level vocabularies write printable bytes as they are and the others as
# the characters from U+0100 on, in order (fixed values).
_PRINTABLE = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_HIDDEN = [b for b in range(256) if b not in _PRINTABLE]
BYTE_CHARS = [chr(b) if b in _PRINTABLE else chr(0x100 + _HIDDEN.index(b)) for b in range(256)]


class ChunkEncoder:
    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        with open(path, encoding="utf-8") as f:
            self.by_chunk = _drops_space(json.load(f))
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _encode(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array(self.dtype.char, x.ids).tobytes() for x in found]

    def _encode_chunks(self, chunks: list[str]) -> dict[str, bytes]:
        """Chunks that are one lower-case Latin word go to the model at once: no other step changes them."""
        found, rest = {}, []
        tokenize, code = self.tokenizer.model.tokenize, self.dtype.char
        for c in chunks:
            if not (c.isalpha() and c.islower()):
                rest.append(c)
            elif c.isascii():
                found[c] = array(code, [t.id for t in tokenize(c)]).tobytes()
            elif max(c) < "\u0100":
                shown = "".join(map(BYTE_CHARS.__getitem__, c.encode()))
                found[c] = array(code, [t.id for t in tokenize(shown)]).tobytes()
            else:
                rest.append(c)
        found.update(zip(rest, self._encode(rest), strict=True))
        return found

    def _learn(self, chunks: set[str]) -> dict[str, bytes]:
        """Ids of chunks that the younger generation lacks."""
        old = self.old
        found = {c: old[c] for c in chunks if c in old} if old else {}
        # A full stop or comma after Latin letters is a token of its own.
        split = [
            c for c in chunks
            if c.endswith((".", ",")) and c not in found and c[:-1].isalpha() and (c.isascii() or max(c) < "\u0100")
        ]
        wanted = chunks.difference(found, split)
        wanted.update(c[:-1] for c in split)
        wanted.update(c[-1] for c in split)
        whole = []
        for c in wanted:
            if (ids := found.get(c) or self.young.get(c) or self.old.get(c)) is not None:
                found[c] = ids
            else:
                whole.append(c)
        found.update(self._encode_chunks(whole))
        for c in split:
            found[c] = found[c[:-1]] + found[c[-1]]
        if len(self.young) + len(found) > CACHED_CHUNKS:
            self.young, self.old = {}, self.young
        self.young.update(found)
        return found

    def batch(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian ids (``dtype`` each) of whole texts; null is empty."""
        if not self.by_chunk:
            return self._encode([t or "" for t in texts])
        collecting = gc.isenabled()
        gc.disable()  # millions of short strings, no cycles
        try:
            return self._batch(texts)
        finally:
            if collecting:
                gc.enable()

    def _batch(self, texts: list[str | None]) -> list[bytes]:
        get = self.young.get
        parts, missing = [], set()
        for text in texts:
            text = text or ""
            if _is_latin(text):
                text = text.lower()
            chunks = text.replace("\n", " ").split(" ")
            ids = list(map(get, chunks))
            gaps = [i for i, x in enumerate(ids) if x is None]
            words = [chunks[i] for i in gaps]
            missing.update(words)
            parts.append((ids, gaps, words))
        found = self._learn(missing) if missing else {}
        for ids, gaps, words in parts:
            for i, c in zip(gaps, words, strict=True):
                ids[i] = found[c]
        return [b"".join(ids) for ids, _, _ in parts]


def _is_latin(text: str) -> bool:
    """Whether lower-casing is the same one-to-one map everywhere."""
    if text.isascii():
        return True
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def _drops_space(config: dict) -> bool:
    """Whether chunks between spaces are encoded independently and without the spaces."""
    steps = config.get("pre_tokenizer") or {}
    steps = steps.get("pretokenizers", [steps])
    first = steps[0] if steps else {}
    pattern = (first.get("pattern") or {}).get("Regex", "")
    removed = first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert")
    plain = all(not s.get("add_prefix_space") for s in steps)
    kinds = {n.get("type") for n in (config.get("normalizer") or {}).get("normalizers", [])}
    lowers = kinds <= {"NFC", "Replace", "Lowercase"} and "Lowercase" in kinds
    no_space = r"[^\s\p{L}\p{N}]+" in pattern and r"\s" not in pattern.replace(r"[^\s", "")
    single = all(" " not in t["content"] and not t["lstrip"] and not t["rstrip"] for t in config.get("added_tokens", []))
    return bool(removed and plain and lowers and no_space and single)


_ENCODERS: dict[str, ChunkEncoder] = {}


def encoder(path: str) -> ChunkEncoder:
    """The process's encoder of a tokenizer file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = ChunkEncoder(path)
    return _ENCODERS[path]


def vocabulary_file(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
