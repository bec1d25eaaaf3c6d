"""Token ids of whole texts with a public tokenizer, by way of a word cache."""

from __future__ import annotations

import os
import re
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words kept per Python worker (about 250 MB); beyond this, those seen once go.
CACHE_WORDS = 1_000_000

#: A blank as byte-level vocabularies write it.
_BLANK = "Ġ"

#: Words given to the tokenizer as one text; much longer texts take it longer a word.
_TOGETHER = 100

#: Marks that close a word, each neither letter, number nor white space.
_MARKS = "!\"#$%&'()*+,-./:;<=>?@[]^`{|}~"

_SPACES = re.compile(r"\s\s|^\s|\s$")
_ODD_EDGE = re.compile(r"\0\0|\s\s|\0\s|\s\0")


def default_tokenizer() -> str:
    """The vocabulary file that the token operators use unless told otherwise."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def joined(flat: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The slices ``flat[start : start + count]`` one after another."""
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat(starts - (ends - counts), counts) + np.arange(total)]


class Encoder:
    """``encode`` of a byte-level BPE file, each distinct word encoded once.

    Such tokenizers cut a text before a lone blank whatever follows, and between
    a letter and the marks after it. So the ids of a text are those of its
    blank-separated words in turn, and the ids of a word those of its letters
    and its closing marks. Texts with two adjacent white spaces, or with a
    special token's text, are encoded whole.

    Cached words stand without the blank before them; a text's first word, which
    has none, is kept under a key that begins with one.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self.vocabulary = self._tokenizer.get_vocab_size()
        added = self._tokenizer.get_added_tokens_decoder().values()
        special = "|".join(re.escape(x.content) for x in added)
        self._special = re.compile(special) if special else None
        self._opens = np.zeros(self.vocabulary, bool)
        for piece, i in self._tokenizer.get_vocab().items():
            self._opens[i] = piece.startswith(_BLANK)
        self._forget()

    def _forget(self) -> None:
        self._places: dict[str, int] = {}
        self._starts = np.zeros(1, np.int64)
        self._ids = np.zeros(0, np.uint32)
        self._seen = np.zeros(0, np.int64)

    def _shrink(self) -> None:
        """Keep the words seen again, or none if those are most of the cache."""
        again = np.flatnonzero(self._seen > 1)
        places, starts, ids = list(self._places), self._starts, self._ids
        self._forget()
        if 2 * len(again) <= CACHE_WORDS:
            counts = starts[again + 1] - starts[again]
            self._add([places[i] for i in again], joined(ids, starts[again], counts), counts)

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        found = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.asarray(x.ids, np.uint32) for x in found]

    def _unclean(self, keys: set[str]) -> set[str]:
        # One search of all at once tells whether there are any.
        plain = [key.removeprefix(" ") for key in keys]
        joined_keys = "\0".join(["x", *plain, "x"])
        odd = set()
        if _ODD_EDGE.search(joined_keys):
            odd = {key for key in keys if len(key) < 2 or _SPACES.search(key.removeprefix(" "))}
            odd -= {key for key in odd if len(key) == 1 and not key.isspace()}
        if self._special and self._special.search(joined_keys):
            odd |= {key for key in keys if self._special.search(key)}
        return odd

    def _encoded(self, keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids and the number of each key's. Words after a blank go together:
        one begins at each id whose piece starts with a blank."""
        if keys[0][0] != " ":
            groups = [" " + " ".join(keys[i : i + _TOGETHER]) for i in range(0, len(keys), _TOGETHER)]
            ids = np.concatenate([self._ids[:0], *self._whole(groups)])
            starts = np.flatnonzero(self._opens[ids])
            if len(starts) == len(keys):
                return ids, np.diff(np.append(starts, len(ids)))
        singly = self._whole([key[1:] if key[0] == " " else " " + key for key in keys])
        return np.concatenate([self._ids[:0], *singly]), np.array([len(x) for x in singly], np.int64)

    def _add(self, keys: list[str], ids: np.ndarray, counts: np.ndarray) -> None:
        base = len(self._places)
        self._places.update(zip(keys, range(base, base + len(keys)), strict=True))
        self._starts = np.concatenate([self._starts, self._starts[-1] + np.cumsum(counts)])
        self._ids = np.concatenate([self._ids, ids])
        self._seen = np.append(self._seen, np.zeros(len(keys), np.int64))

    def _learn(self, keys: set[str]) -> None:
        """Add keys that are not there yet."""
        cut = {}
        for key in [key for key in keys if key[-1] in _MARKS]:
            stem = key.rstrip(_MARKS)
            if stem and stem[-1].isalpha():
                # Marks are stored as a first word is, as no blank stands before them.
                cut[key] = (stem, " " + key[len(stem) :])
        parts = [part for pair in cut.values() for part in pair]
        fresh = keys.difference(cut)
        fresh.update([part for part in parts if part not in self._places])
        for group in ([key for key in fresh if key[0] != " "], [key for key in fresh if key[0] == " "]):
            if group:
                self._add(group, *self._encoded(group))
        if cut:
            at = self._at(parts)
            counts = self._starts[at + 1] - self._starts[at]
            ids = joined(self._ids, self._starts[at], counts)
            self._add(list(cut), ids, counts.reshape(-1, 2).sum(axis=1))

    def _at(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self._places.get, words, repeat(-1)), np.int64, len(words))

    def _known(self, words: list[str]) -> np.ndarray:
        """Places of distinct words, learning the new; -1 for the unclean."""
        at = self._at(words)
        missing = np.flatnonzero(at < 0)
        new = {words[i] for i in missing}
        new -= self._unclean(new)
        # A word with closing marks brings its letters along.
        if len(self._places) + 2 * len(new) > CACHE_WORDS and self._places:
            self._shrink()
            if len(self._places) + 2 * len(new) > CACHE_WORDS:
                self._forget()
            return self._known(words)
        self._learn(new)
        at[missing] = self._at([words[i] for i in missing])
        return at

    def encode(self, texts: list[str] | pa.Array) -> list[np.ndarray]:
        """The ids of each text, as 32-bit unsigned arrays."""
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        if not len(texts):
            return []
        cut = pc.split_pattern(texts, " ")
        starts_of = cut.offsets.to_numpy().astype(np.int64)
        sizes, heads = np.diff(starts_of), starts_of[:-1]
        coded = cut.flatten().dictionary_encode()
        # By way of an array of objects, which makes strings several times as fast as a list of values.
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        at = coded.indices.to_numpy()
        first = [" " + distinct[i] for i in at[heads]]
        places = self._known(distinct + first)
        at = places[at]
        at[heads] = places[len(distinct) :]
        text_of = np.repeat(np.arange(len(texts)), sizes)
        whole = np.unique(text_of[at < 0])
        if len(whole):
            at[np.isin(text_of, whole)] = -1
        kept = at[at >= 0] if len(whole) else at
        self._seen += np.bincount(kept, minlength=len(self._seen))
        starts = self._starts[kept]
        lengths = self._starts[kept + 1] - starts
        ids = joined(self._ids, starts, lengths)
        counts = np.zeros(len(at), np.int64)
        counts[at >= 0] = lengths
        cuts = np.concatenate([[0], np.cumsum(counts)])[starts_of]
        out = [ids[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        for i, found in zip(whole, self._whole([texts[int(i)].as_py() for i in whole]), strict=True):
            out[i] = found
        return out


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder of a file; its cache outlives a task."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def release() -> None:
    """Give the worker's encoders and their memory back; for the stages after."""
    _encoders.clear()
    pa.default_memory_pool().release_unused()
