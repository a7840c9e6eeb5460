"""Token ids of texts, by a tokenizer file, with every distinct word encoded once per worker."""

from __future__ import annotations

import re
import sys
import types
from collections import defaultdict
from collections.abc import Callable, Sequence
from itertools import chain, count, islice

import numpy as np
from tokenizers import Tokenizer, normalizers, pre_tokenizers

#: Between words that are encoded together: a word of its own, whose token no other word can have.
MARK = "\x01"
WORD_END = "</w>"
#: Bytes of text after which the words so far are looked up.
STEP = 4 << 20
#: A stop or comma between a letter and a space is a token of its own. Looked for by the stop, which is rarer.
STOP = re.compile(rb"[.,](?=\s)(?<=[a-z].)")


class WordEncoder:
    """Ids as little-endian bytes for a tokenizer that works in lower case, splits at white space and drops it.

    Such a tokenizer also separates letters from what is not, so the ids of a text are those of its words, one after the
    other, even with a stop or comma behind a letter taken for a word of its own. Each new word is encoded once, together
    with many others. Once ``limit`` words are held, further ones are encoded batch by batch and dropped again, so memory
    is bounded. A word is looked up once for each time it occurs; the ids are gathered from one array by its number.
    """

    def __init__(self, path: str, limit: int = 400_000):
        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        # lower-case ASCII letters are their own normal form and one word, so these steps can be left out for them
        self.plain = Tokenizer.from_file(path)
        self.plain.normalizer = normalizers.Sequence([])
        self.plain.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.limit = limit
        #: Numbers of the words held; the ids of all of them, and where those of each number start and how many they are.
        self.index: defaultdict[bytes, int] = defaultdict()
        self.ids, self.starts, self.sizes = np.empty(0, self.dtype), np.empty(0, np.int64), np.empty(0, np.int64)
        self.ends = np.zeros(size, bool)
        for token, i in self.tokenizer.get_vocab(with_added_tokens=True).items():
            self.ends[i] = token.endswith(WORD_END)
        self.mark = self.tokenizer.encode(MARK, add_special_tokens=False).ids
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]

    def _split(self, text: bytes) -> list[bytes]:
        low = text.lower()  # of ASCII letters only
        if any(x in low for x in self.special):  # names of special tokens count as they are written
            return text.split()
        return STOP.sub(rb" \g<0>", low).split()

    @property
    def words(self) -> dict[bytes, bytes]:
        """The words held, with their ids."""
        return {w: self.ids[self.starts[i] : self.starts[i] + self.sizes[i]].tobytes() for w, i in self.index.items()}

    def texts(self, texts: Sequence[bytes]) -> list[bytes]:
        out, part, size = [], [], 0
        for text in texts:
            part.append(text)
            size += len(text)
            if size >= STEP:
                out += self._texts(part)
                part, size = [], 0
        return out + self._texts(part)

    def _texts(self, texts: list[bytes]) -> list[bytes]:
        split = [self._split(x) for x in texts]
        edges = np.r_[0, np.cumsum([len(x) for x in split], dtype=np.int64)]
        index, before = self.index, len(self.index)
        index.default_factory = count(before).__next__  # a word not held yet gets the next number
        codes = np.fromiter(map(index.__getitem__, chain.from_iterable(split)), np.int64, int(edges[-1]))
        new = list(islice(reversed(index), len(index) - before))[::-1]
        try:
            self._hold(new)
        except BaseException:
            for w in new:
                del index[w]
            raise
        sizes = self.sizes[codes]
        ends = np.cumsum(sizes)
        places = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.starts[codes] - (ends - sizes), sizes)
        raw, width = self.ids[places].tobytes(), self.dtype.itemsize
        cuts = (np.r_[0, ends][edges] * width).tolist()
        if len(index) > max(before, self.limit):
            self._drop(new[max(before, self.limit) - before :])
        return [raw[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]

    def _hold(self, new: list[bytes]) -> None:
        made = self._encode(set(new))
        sizes = np.array([len(made[w]) for w in new], np.int64) // self.dtype.itemsize
        self.starts = np.r_[self.starts, len(self.ids) + np.cumsum(sizes) - sizes]
        self.sizes = np.r_[self.sizes, sizes]
        self.ids = np.r_[self.ids, np.frombuffer(b"".join([made[w] for w in new]), self.dtype)]

    def _drop(self, last: list[bytes]) -> None:
        for w in last:
            del self.index[w]
        n = len(self.index)
        self.ids, self.starts, self.sizes = self.ids[: self.starts[n]].copy(), self.starts[:n].copy(), self.sizes[:n].copy()

    def _encode(self, words: set[bytes]) -> dict[bytes, bytes]:
        plain = [w for w in words if w.isalpha() and w.islower()]
        others = words.difference(plain)
        letters = [w for w in others if w.decode("utf-8", "replace").isalpha()]
        odd = others.difference(letters)
        return self._letters(plain, self.plain) | self._letters(letters, self.tokenizer) | self._marked(list(odd))

    def _letters(self, words: list[bytes], tokenizer: Tokenizer, step: int = 2000) -> dict[bytes, bytes]:
        """Ids of words that are one run of letters: the last token of each, and no other, ends a word."""
        out = {}
        for at in range(0, len(words), step):
            part = words[at : at + step]
            asked = [w.decode("utf-8", "replace") for w in part]
            ids = np.array(tokenizer.encode_batch_fast([asked], is_pretokenized=True, add_special_tokens=False)[0].ids, np.int64)
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) != len(part):  # a letter whose normal form is more than one
                out |= self._marked(part)
                continue
            raw, width = ids.astype(self.dtype).tobytes(), self.dtype.itemsize
            edges = (np.r_[0, stops] * width).tolist()
            out.update((w, raw[a:b]) for w, a, b in zip(part, edges[:-1], edges[1:], strict=True))
        return out

    def _marked(self, words: list[bytes], step: int = 2000) -> dict[bytes, bytes]:
        """Ids of any words, with a mark between them; those that hold the mark are encoded alone."""
        out = {w: self._alone(w) for w in words if MARK.encode() in w}
        words = [w for w in words if w not in out]
        for at in range(0, len(words), step):
            part = words[at : at + step]
            ids = self._ids(f" {MARK} ".join(w.decode("utf-8", "replace") for w in part))
            stops = np.flatnonzero(ids == self.mark[0]) if len(self.mark) == 1 else np.array([], int)
            if len(stops) != len(part) - 1:
                out |= {w: self._alone(w) for w in part}
                continue
            pieces = zip(part, np.r_[0, stops + 1], np.r_[stops, len(ids)], strict=True)
            out.update((w, ids[a:b].astype(self.dtype).tobytes()) for w, a, b in pieces)
        return out

    def _alone(self, word: bytes) -> bytes:
        return self._ids(word.decode("utf-8", "replace")).astype(self.dtype).tobytes()

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int64)


class TextEncoder:
    """Ids as little-endian bytes for any tokenizer: whole texts."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4")

    def texts(self, texts: Sequence[bytes]) -> list[bytes]:
        made = self.tokenizer.encode_batch_fast([x.decode("utf-8", "replace") for x in texts], add_special_tokens=False)
        return [np.array(x.ids, self.dtype).tobytes() for x in made]


def shared(key: tuple, make: Callable):
    """``make()``, once per worker process: later tasks in it find the same object."""
    held = sys.modules.setdefault("_tallymark_llm", types.ModuleType("_tallymark_llm"))
    if key not in held.__dict__:
        held.__dict__[key] = make()
    return held.__dict__[key]
