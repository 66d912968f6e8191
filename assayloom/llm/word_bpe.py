"""Byte pair merges of many short words at once, for tokenizer files whose words end in a mark."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Letters that the file's normaliser only puts in lower case, and signs that cut off from them as one piece each side.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_BEFORE, _AFTER = r'!"#$%&()*+,\-./:;=?@\[\\\]^_`{}~', r"""!"#$%&'()*+,\-./:;=?@\[\\\]^_`{}~"""
_SHAPE = f"^(?P<before>[{_BEFORE}]*)(?P<word>[{_LETTERS}]+)(?P<after>[{_AFTER}]*)$"
_NONE = np.iinfo(np.int32).max


def byte_letters() -> dict[str, int]:
    """The letter that a byte-level vocabulary writes for each byte: itself if it can be seen, else from U+0100 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in seen]
    return {chr(b): b for b in seen} | {chr(256 + k): b for k, b in enumerate(rest)}


def ragged(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The runs flat[start:start + length], one after the other."""
    ends = np.cumsum(lengths)
    return flat[np.repeat(starts - (ends - lengths), lengths) + np.arange(int(ends[-1]) if len(ends) else 0)]


def parted(distinct: pa.Array) -> tuple[np.ndarray, pa.StructArray]:
    """(which, parts): the units that are letters between signs, and their ``before``, ``word`` and ``after``."""
    parts = pc.extract_regex(distinct, _SHAPE)
    which = parts.is_valid().to_numpy(zero_copy_only=False)
    return which, parts.filter(pa.array(which))


def fits(definition: dict) -> bool:
    """Whether a tokenizer file merges bytes of lower-cased letters, with a mark at the end of each word.

    A merge must come after those that make its parts: only then may all equal
    pairs of a word be merged in one step.
    """
    model, steps = definition["model"], (definition.get("pre_tokenizer") or {}).get("pretokenizers", [])
    normalizer = definition.get("normalizer") or {}
    kinds = [n["type"] for n in normalizer.get("normalizers", [])]
    if (model.get("type") != "BPE" or not model.get("end_of_word_suffix") or model.get("continuing_subword_prefix")
            or model.get("dropout") or model.get("ignore_merges") or kinds != ["NFC", "Replace", "Lowercase"]
            or normalizer["normalizers"][1]["pattern"] != {"Regex": r"\s+"}
            or [s["type"] for s in steps] != ["Split", "ByteLevel"] or steps[1]["add_prefix_space"] or steps[1]["use_regex"]):
        return False
    pairs = _pairs(model)
    made = {a + b: rank for rank, (a, b) in enumerate(pairs)}
    return len(made) == len(pairs) and all(made.get(part, -1) < rank for rank, pair in enumerate(pairs) for part in pair)


def _pairs(model: dict) -> list[tuple[str, str]]:
    return [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]


class WordBpe:
    """Ids of words of letters."""

    def __init__(self, definition: dict):
        model = definition["model"]
        vocabulary, end = model["vocab"], model["end_of_word_suffix"]
        letter = {b: c for c, b in byte_letters().items()}
        self.inner = np.array([vocabulary[letter[b]] for b in range(256)], np.int32)
        self.last = np.array([vocabulary[letter[b] + end] for b in range(256)], np.int32)
        self.size = len(vocabulary)
        pairs = _pairs(model)
        key = np.array([vocabulary[a] * self.size + vocabulary[b] for a, b in pairs], np.int64)
        order = np.argsort(key)
        self.key, self.rank = key[order], order.astype(np.int32)
        self.made = np.array([vocabulary[a + b] for a, b in pairs], np.int32)

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return np.where(self.key[at] == key, self.rank[at], _NONE)

    def encode(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, how many of each word) of words in lower case that are not empty."""
        data = pc.cast(words, pa.large_binary())
        bounds = np.frombuffer(data.buffers()[1], np.int64)[data.offset:data.offset + len(data) + 1] if len(data) else np.zeros(1, np.int64)
        letters = np.frombuffer(data.buffers()[2], np.uint8)[bounds[0]:bounds[-1]] if len(data) else np.zeros(0, np.uint8)
        starts, ends = bounds[:-1] - bounds[0], bounds[1:] - bounds[0]
        symbols = self.inner[letters]
        symbols[ends - 1] = self.last[letters[ends - 1]]
        n = len(starts)
        counts, done = np.zeros(n, np.int64), []
        word = np.arange(n)                          # words still in work
        length = ends - starts
        rank = np.full(len(symbols), _NONE, np.int32)  # of each symbol and the next one of its word
        rank[:-1] = self._ranks(symbols[:-1], symbols[1:])
        rank[ends - 1] = _NONE
        while len(word):
            first = np.cumsum(length) - length
            least = np.minimum.reduceat(rank, first)
            over = least == _NONE
            if over.any():
                counts[word[over]] = length[over]
                gone = np.repeat(over, length)
                done.append((word[over], symbols[gone]))
                symbols, rank, word, length, least = symbols[~gone], rank[~gone], word[~over], length[~over], least[~over]
                if not len(word):
                    break
            hit = rank == np.repeat(least, length)
            # Of equal pairs that overlap, every other one, from the left.
            at = np.flatnonzero(hit)
            run = np.flatnonzero(np.diff(at, prepend=-2) != 1)
            place = np.arange(len(at)) - np.repeat(run, np.diff(np.append(run, len(at))))
            at = at[place % 2 == 0]
            symbols[at] = self.made[rank[at]]
            rank[at] = rank[at + 1]                  # where a word ends, for the merged symbol
            stay = np.ones(len(symbols), bool)
            stay[at + 1] = False
            length = length - np.bincount(np.repeat(np.arange(len(word)), length)[at], minlength=len(word))
            symbols, rank, shift = symbols[stay], rank[stay], np.cumsum(~stay)
            closes = np.zeros(len(symbols), bool)
            closes[np.cumsum(length) - 1] = True
            at = at - shift[at]
            for changed in (at, at[at > 0] - 1):
                inner = changed[~closes[changed]]
                rank[inner] = self._ranks(symbols[inner], symbols[inner + 1])
                rank[changed[closes[changed]]] = _NONE
        order = np.concatenate([w for w, _ in done]) if done else np.zeros(0, np.int64)
        flat = np.concatenate([s for _, s in done]) if done else np.zeros(0, np.int32)
        sizes = counts[order]
        back = np.empty(n, np.int64)
        back[order] = np.cumsum(sizes) - sizes
        return ragged(flat, back, counts).astype("<u4"), counts
