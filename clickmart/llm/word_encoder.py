"""Token ids of whole texts by a tokenizer whose tokens never cross white space.

``word_bpe_49k.json`` drops white space and never joins what stands on its two
sides, so the ids of a text are the ids of its white-space-separated parts in
order. It also lower-cases, and sets a full stop or comma after a letter or
digit apart, so that "The", "the" and "the," share a part. Texts are split on
the bytes of a whole batch at once and their parts numbered by Arrow; only the
distinct parts are looked up, in a bounded cache of the worker process, and only
new ones go through the tokenizers library.
"""

from __future__ import annotations

import os
from array import array

import numpy as np
import pyarrow as pa

from .common import per_process

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core


#: Bytes of text that are split and looked up at once.
AT_ONCE = 8 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[*b" \t\n\r\x0b\x0c"]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: A stop or comma that ends a word begins a token of its own.
_END = np.zeros(256, bool)
_END[[*b".,"]] = True
_ALNUM = np.zeros(256, bool)
_ALNUM[[*b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"]] = True
_AFTER = np.zeros(256, bool)
_AFTER[[*b" \n"]] = True


def split(texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """Parts of all texts (UTF-8) that are encoded each on its own; how many each text has."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    data = np.frombuffer(b"".join(texts), np.uint8)
    n = len(data)
    if not n:
        return pa.array([], pa.binary()), np.zeros(len(texts), np.int64)
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    begins = bounds[:-1][lengths > 0]
    inside = ~_SPACE[data]
    edge = np.zeros(n + 1, bool)  # a text begins here
    edge[begins] = True
    edge[n] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:n]
    stop = _END[data]
    stop[1:] &= _ALNUM[data[:-1]] & ~edge[1:n]
    stop[0] = False
    stop[:-1] &= _AFTER[data[1:]] | edge[1:n]
    first |= stop
    at = np.flatnonzero(first)
    small = _LOWER[data]
    for a, b in _cased(data, bounds):
        small[a:b] = data[a:b]
    # each part goes on to the next one's begin, less the white space between
    offsets = np.append(np.cumsum(inside)[at] - 1, inside.sum()).astype(np.int32)
    parts = pa.Array.from_buffers(pa.binary(), len(at), [
        None, pa.py_buffer(offsets), pa.py_buffer(small[inside])])
    return parts, np.diff(np.searchsorted(at, bounds))


def _cased(data: np.ndarray, bounds: np.ndarray) -> list[tuple[int, int]]:
    """Texts whose capitals stay: with a combining mark, a capital composes unlike its small
    letter, and special tokens (``<|``) are matched before the case is changed."""
    marks = (data == 0xCC) | (data == 0xCD)
    marks[:-1] |= (data[:-1] == ord("<")) & (data[1:] == ord("|"))
    texts = np.unique(np.searchsorted(bounds, np.flatnonzero(marks), "right") - 1)
    return list(zip(bounds[texts].tolist(), bounds[texts + 1].tolist(), strict=True))


class WordEncoder:
    """Encodes texts (UTF-8 bytes) to little-endian uint32 ids."""

    def __init__(self, path: str, cache_words: int = 450_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self.cache_words = cache_words
        # the words met lately, and before: a word that is met again stays
        self.ids: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def learn(self, words: list[bytes]) -> None:
        """Encode new parts, so that ``ids`` has all of ``words``."""
        if len(self.ids) + len(words) > self.cache_words:
            self.old, self.ids = self.ids, {}
        new = []
        for w in words:
            if w not in self.ids:
                got = self.old.get(w)
                if got is None:
                    new.append(w)
                else:
                    self.ids[w] = got
        plain, other = [], []
        for w in new:
            text = w.decode("utf-8", "replace")
            (plain if text.isalpha() else other).append((w, text))
        for at in range(0, len(plain), 20_000):
            part = plain[at:at + 20_000]
            if not self._learn_letters(part):
                other += part
        for at in range(0, len(other), 20_000):
            part = other[at:at + 20_000]
            got = self.tokenizer.encode_batch([t for _, t in part], add_special_tokens=False)
            self.ids.update((w, array("I", e.ids).tobytes())
                            for (w, _), e in zip(part, got, strict=True))

    def _learn_letters(self, words: list[tuple[bytes, str]]) -> bool:
        """Words of letters only, joined by spaces: each ends with the one token that ends a
        word, which is checked. A call for each would cost more than its encoding."""
        lines = [" ".join(t for _, t in words[at:at + 100]) for at in range(0, len(words), 100)]
        ids = np.concatenate([np.array(e.ids, "<u4") for e in
                              self.tokenizer.encode_batch(lines, add_special_tokens=False)])
        last = np.flatnonzero(self.ends[ids])
        if len(last) != len(words):
            return False
        data, ends = ids.tobytes(), (4 * (last + 1)).tolist()
        self.ids.update((w, data[a:b]) for (w, _), a, b in
                        zip(words, [0, *ends[:-1]], ends, strict=True))
        return True

    def _found(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """The number of each part, how many parts each text has, ids by number."""
        parts, per_text = split(texts)
        coded = parts.dictionary_encode()
        words = coded.dictionary.to_pylist()
        self.learn(words)
        return (coded.indices.to_numpy(), per_text, list(map(self.ids.__getitem__, words)))

    def encode(self, texts: list[bytes]) -> list[bytes]:
        out: list[bytes] = []
        for group in _groups(texts):
            place, per_text, ids = self._found(group)
            flat = np.frombuffer(b"".join(ids), "<u4")
            n = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
            of = n[place]
            ends = np.cumsum(of)
            total = int(ends[-1]) if len(ends) else 0
            source = np.repeat((np.cumsum(n) - n)[place] - (ends - of), of) + np.arange(total)
            data = flat[source].tobytes()
            upto = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(per_text)])] * 4
            out += [data[a:b] for a, b in zip(upto[:-1].tolist(), upto[1:].tolist(), strict=True)]
        return out

    def count(self, texts: list[bytes]) -> list[int]:
        out: list[int] = []
        for group in _groups(texts):
            place, per_text, ids = self._found(group)
            n = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
            upto = np.concatenate([[0], np.cumsum(n[place])])
            out += np.diff(upto[np.concatenate([[0], np.cumsum(per_text)])]).tolist()
        return out


def _groups(texts: list[bytes]):
    """Runs of texts of about ``AT_ONCE`` bytes."""
    at = held = 0
    for i, t in enumerate(texts):
        held += len(t)
        if held >= AT_ONCE:
            yield texts[at:i + 1]
            at, held = i + 1, 0
    if at < len(texts):
        yield texts[at:]


def word_encoder(path: str) -> WordEncoder:
    """The encoder of this worker process."""
    return per_process(("words", path), lambda: WordEncoder(path))
