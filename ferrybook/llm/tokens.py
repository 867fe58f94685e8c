"""Token ids of whole texts, fast where words repeat: every distinct word is encoded once."""

from __future__ import annotations

import re
import threading
from collections.abc import Iterator
from contextlib import contextmanager
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from ferrybook.llm.common import give_back

GROUP = 5000  # words that are encoded at once
_TAIL = r"([A-Za-z0-9])[.,!?;:$%&*#]+$"
# of the Latin, Greek and Cyrillic blocks, where no letter is composed with the one before it
LETTERS = [c for c in map(chr, range(0x41, 0x530)) if c.isalpha()]


class WordEncoder:
    """Encodes texts with a tokenizer whose tokens never hold ASCII white space, as
    ``word_bpe_49k.json``: its normalizer and pre-tokenizer treat the words between white space
    apart, lower-case them but for special tokens, and cut between a letter or digit and the marks of ``_TAIL``. So ids of
    a text are those of its words, one after the other. ``mark`` is a special token that stands
    between words when many are encoded at once. Words are remembered up to about ``limit`` bytes.

    A word of ``LETTERS`` alone is one pre-token, made of what each letter becomes by itself: it goes
    straight to the tokenizer's model. Other words take the whole way through the tokenizer.
    """

    def __init__(self, path: str, mark: str = "<|endoftext|>", limit: int = 128 << 20):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.mark, self.mark_id, self.limit = mark, self.tokenizer.token_to_id(mark), limit
        self.merge = self.tokenizer.model.tokenize
        self.shown = self._letters()
        self.plain = re.compile(f"[{''.join(map(chr, self.shown))}]+").fullmatch
        self._forget()

    def _letters(self) -> dict[int, str]:
        """What normalizer and pre-tokenizer make of each letter that they do not cut from its neighbours."""
        normal, cut, out = self.tokenizer.normalizer.normalize_str, self.tokenizer.pre_tokenizer.pre_tokenize_str, {}
        for letter in LETTERS:
            made = cut(normal(f"a{letter}a"))
            if len(made) == 1:
                out[ord(letter)] = made[0][0][1:-1]
        return out

    def _forget(self) -> None:
        self.known: dict[str, int] = {"": 0}
        self.flat = np.zeros(1 << 18, np.uint32)
        self.ends = np.zeros(1 << 16, np.int64)  # of the pool's words; the empty word is the first
        self.count, self.size = 1, 0

    def _learn(self, words: list[str]) -> None:
        shown, merge = self.shown, self.merge
        plain, mixed = [], []
        for w in words:
            (plain if self.plain(w) else mixed).append(w)
        for i in range(0, len(plain), GROUP):
            group = plain[i : i + GROUP]
            made = [[t.id for t in merge(w.lower() if w.isascii() else w.translate(shown))] for w in group]
            sizes = np.fromiter(map(len, made), np.int64, len(made))
            self._add(group, np.fromiter(chain.from_iterable(made), np.uint32, sizes.sum()), sizes)
        for i in range(0, len(mixed), GROUP):
            group = mixed[i : i + GROUP]
            # without the offsets in the text, which nobody asks for
            made = self.tokenizer.encode_batch_fast([self.mark.join(group)], add_special_tokens=False)
            ids = np.array(made[0].ids, np.uint32)
            cuts = np.flatnonzero(ids == self.mark_id)
            sizes = np.diff(np.concatenate([[-1], cuts, [len(ids)]])) - 1
            self._add(group, ids[ids != self.mark_id], sizes)

    def _add(self, group: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        used = self.ends[self.count - 1]
        if used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(max(len(self.flat), len(ids)), np.uint32)])
        if self.count + len(group) > len(self.ends):
            self.ends = np.concatenate([self.ends, np.zeros(max(len(self.ends), len(group)), np.int64)])
        self.flat[used : used + len(ids)] = ids
        self.ends[self.count : self.count + len(group)] = used + np.cumsum(sizes)
        self.known.update(zip(group, range(self.count, self.count + len(group))))
        self.count += len(group)
        # a text, its entry in the table of words, its number and its ids
        self.size += sum(map(len, group)) + 200 * len(group) + 4 * len(ids)

    def _places(self, distinct: pa.Array) -> np.ndarray:
        words = distinct.to_numpy(zero_copy_only=False).tolist()
        if self.size > self.limit:
            self._forget()
        known = self.known
        places = np.fromiter(map(known.get, words, repeat(-1)), np.int64, len(words))
        missing = np.flatnonzero(places < 0)
        fresh = [words[i] for i in missing.tolist()]
        marked = [w for w in fresh if "<|" in w]  # may hold special tokens themselves
        self._learn([w for w in fresh if "<|" not in w] if marked else fresh)
        for w in marked:
            ids = np.array(self.tokenizer.encode(w, add_special_tokens=False).ids, np.uint32)
            self._add([w], ids, np.array([len(ids)]))
        places[missing] = np.fromiter(map(known.__getitem__, fresh), np.int64, len(fresh))
        return places

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows one after the other, where each row ends). A null text is empty."""
        lists = pc.ascii_split_whitespace(texts.cast(pa.large_string()).fill_null(""))
        flat = lists.flatten().dictionary_encode()
        raw = flat.dictionary
        cores = pc.replace_substring_regex(raw, _TAIL, r"\1")
        skip, sizes = pc.binary_length(cores).to_numpy(), pc.binary_length(raw).to_numpy()
        ended = np.flatnonzero(sizes > skip)
        tails = [w[k:] for w, k in zip(raw.take(pa.array(ended)).cast(pa.large_binary()).to_numpy(zero_copy_only=False), skip[ended].tolist())]
        # special tokens are matched in the text as it is, before the tokenizer lower-cases the rest
        plain = pc.and_not(pc.string_is_ascii(cores), pc.match_substring(cores, "<|"))
        cores = pc.if_else(plain, pc.ascii_lower(cores), cores).dictionary_encode()
        tails = pa.array(tails, pa.large_binary()).cast(pa.large_string()).dictionary_encode()
        learnt = self._places(pa.concat_arrays([cores.dictionary, tails.dictionary]))
        halves = np.zeros((len(raw), 2), np.int64)  # places of a word and of the marks behind it
        halves[:, 0] = learnt[cores.indices.to_numpy()]
        halves[ended, 1] = learnt[len(cores.dictionary) :][tails.indices.to_numpy()]
        begins, lengths = self._bounds(halves.reshape(-1))
        pool, sums = _gathered(self.flat, begins, lengths)
        word_ends = sums[1::2] if len(sums) else sums
        word_begins = np.concatenate([[0], word_ends[:-1]]) if len(sums) else sums
        index = flat.indices.to_numpy()
        out, totals = _gathered(pool, word_begins[index], (word_ends - word_begins)[index])
        offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        return out, np.concatenate([[0], totals])[offsets[1:]]

    def _bounds(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        begins = np.concatenate([[0], self.ends[: self.count - 1]])[places]
        return begins, self.ends[places] - begins


def _gathered(pool: np.ndarray, begins: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stretches of the pool one after the other, and where each ends."""
    ends = np.cumsum(lengths)
    if not len(ends):
        return pool[:0], ends
    at = np.repeat(begins - ends + lengths, lengths)
    at += np.arange(ends[-1])
    return pool[at], ends


IDLE_SECONDS = 4.0

_HELD: dict[str, WordEncoder] = {}
_LOCK = threading.Lock()


def _drop(path: str) -> None:
    with _LOCK:
        _HELD.pop(path, None)
    give_back()


@contextmanager
def encoder(path: str) -> Iterator[WordEncoder]:
    """An encoder for the length of a task. The next task of the worker goes on with it, with the words that it
    remembers; where none comes within ``IDLE_SECONDS``, it is dropped."""
    with _LOCK:
        made = _HELD.pop(path, None)
    made = made or WordEncoder(path)
    try:
        yield made
    finally:
        with _LOCK:
            _HELD[path] = made
        timer = threading.Timer(IDLE_SECONDS, _drop, [path])
        timer.daemon = True
        timer.start()
