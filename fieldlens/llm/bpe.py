"""Byte-level BPE encoding and decoding by speculation and verification.

A text is split at special tokens and then by the vocabulary's word pattern.
For each new word, greedy longest match proposes tokens.  The proposal is the
BPE encoding exactly if every two adjacent tokens are compatible: merging the
bytes of the two alone gives back just these two.  That check runs vectorised
over all adjacent pairs of all new words at once, by undoing the two tokens'
merges step by step at their common border and looking for a merge across the
border that would have come first.  Words with a failing pair, and only these,
undergo exact merging: short ones in step with each other, long ones with a
heap.  Encodings of short words are kept in a cache of bounded size in each
Python worker.

Whole texts are processed in narrow tasks, nothing is shuffled.  Defined
cases: a null text counts as empty and has no tokens; input columns with the
names of outputs are replaced; all other rows and columns stay as they are.
"""

from __future__ import annotations

import heapq
import json
import re
import sys
import unicodedata
from itertools import chain

import numpy as np
import regex
from pyspark.sql import DataFrame, types as T

from .common import append_columns

#: Fixed value: the word pattern of byte-level vocabularies, over classes of
#: white space, letters and numbers.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?[{L}]+| ?[{N}]+| ?[^{S}{L}{N}]+|[{S}]+(?![^{S}])|[{S}]+"
CACHE_WORDS = 300_000
CACHED_LENGTH = 64
STEPPED_LENGTH = 48
_NONE = np.iinfo(np.int64).max


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte: printable Latin-1 for itself, the
    others in order from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(0x100 + i): b for i, b in enumerate(rest)}


def _spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The indexes start, start + 1, ... of runs of the given sizes, in order."""
    return np.arange(int(size.sum())) + np.repeat(start - (np.cumsum(size) - size), size)


def _latin_pattern() -> re.Pattern:
    """The word pattern for texts within Latin-1."""
    kind = {chr(c): unicodedata.category(chr(c))[0] for c in range(256)}
    of = lambda k: "".join(re.escape(c) for c in kind if kind[c] == k)
    space = "".join(re.escape(c) for c in kind if c.isspace() and not 0x1C <= ord(c) <= 0x1F)
    return re.compile(PATTERN.format(S=space, L=of("L"), N=of("N")))


def _newer_letters() -> str:
    """Characters that the regex library takes for letters or numbers, and the
    tokenizers library, with its older Unicode, does not."""
    from tokenizers.pre_tokenizers import ByteLevel
    every = "".join(map(chr, [*range(0x100, 0xD800), *range(0xE000, sys.maxunicode + 1)]))
    doubtful = [c for c in regex.findall(r"[\p{L}\p{N}]", every) if unicodedata.category(c)[0] not in "LN"]
    # a symbol stays with the "!" before it, a letter or a number does not
    starts = {a for _, (a, _) in ByteLevel(add_prefix_space=False).pre_tokenize_str(
        "".join(f"!{c} " for c in doubtful))}
    return "".join(c for i, c in enumerate(doubtful) if 3 * i + 1 not in starts)


class ByteBpe:
    """A vocabulary file of the tokenizers library with a byte-level model."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, byte = spec["model"], _byte_letters()
        as_bytes = lambda s: bytes(byte[c] for c in s)
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if spec["normalizer"] or spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["pre_tokenizer"]["add_prefix_space"] \
                or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError(f"{path}: only plain byte-level BPE is supported")
        vocab = model["vocab"]
        n = max([*vocab.values(), *special.values()]) + 1
        self.bytes_of: list[bytes] = [b""] * n
        for token, i in vocab.items():
            if token not in special:
                self.bytes_of[i] = as_bytes(token)
        for token, i in special.items():
            self.bytes_of[i] = token.encode()
        self.special = special
        self.special_pattern = regex.compile("(" + "|".join(
            regex.escape(t) for t in sorted(special, key=len, reverse=True)) + ")") if special else None
        self.latin = _latin_pattern()
        self.pattern = regex.compile(PATTERN.format(S=r"\s", L=r"\p{L}", N=r"\p{N}"))
        newer = _newer_letters()
        self.newer = regex.compile(f"[{newer}]") if newer else None
        self.as_symbol = dict.fromkeys(map(ord, newer), "\u2400")
        self.byte_id = [vocab[c] for c, _ in sorted(byte.items(), key=lambda x: x[1])]
        # rank of the merge that makes a token, and its parts; -1 for single bytes
        self.rank, self.left, self.right = (np.full(n, -1, np.int64) for _ in range(3))
        self.merge: dict[tuple[int, int], tuple[int, int]] = {}
        self.one_way = True  # each token has one merge
        for r, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            made = vocab[a + b]
            self.merge.setdefault((vocab[a], vocab[b]), (r, made))
            self.one_way &= bool(self.rank[made] < 0)
            self.rank[made], self.left[made], self.right[made] = r, vocab[a], vocab[b]
        key = np.array([a << 32 | b for a, b in self.merge], np.int64)
        order = np.argsort(key)
        self.pair_key = key[order]
        self.pair_rank = np.array([r for r, _ in self.merge.values()], np.int64)[order]
        # only a token that its own bytes encode to can be proposed
        made = np.flatnonzero(self.rank >= 0)
        whole = self._compatible(self.left[made], self.right[made], self.rank[made])
        good = {*made[whole].tolist(), *self.byte_id}
        while True:  # and its parts, in turn
            bad = {i for i in good if self.rank[i] >= 0 and not (int(self.left[i]) in good and int(self.right[i]) in good)}
            if not bad:
                break
            good -= bad
        self.proposals = {self.bytes_of[i]: i for i in good}
        self.longest: dict[bytes, int] = {}  # by the first three bytes
        for t in self.proposals:
            self.longest[t[:3]] = max(len(t), self.longest.get(t[:3], 0))
        self.made = np.array([m for _, m in sorted(self.merge.values())], np.int64)
        self.byte_ids = np.array(self.byte_id, np.int64)
        self._forget()

    def _forget(self) -> None:
        """Empty the cache: words to slots, and the tokens of each slot."""
        self.cache: dict[str, int] = {}
        self.at, self.size, self.pool = (np.zeros(0, np.int64) for _ in range(3))

    def _pair_ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a << 32 | b
        at = np.minimum(np.searchsorted(self.pair_key, key), len(self.pair_key) - 1)
        return np.where(self.pair_key[at] == key, self.pair_rank[at], _NONE)

    def _compatible(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray | None = None) -> np.ndarray:
        """For each pair: do a's and b's bytes together merge to a and b?  With
        ``limit``: before the merge of that rank."""
        ok = self._pair_ranks(a, b) >= (_NONE if limit is None else limit)
        at = np.flatnonzero(ok)
        a, b = a[at], b[at]
        while len(at):
            ra, rb = self.rank[a], self.rank[b]
            undo_b = rb >= ra  # of one rank, the left merge came first
            open_ = (ra >= 0) | (rb >= 0)
            last = np.maximum(ra, rb)
            a, b = np.where(undo_b, a, self.right[a]), np.where(undo_b, self.left[b], b)
            a, b, at, last, undo_b = (x[open_] for x in (a, b, at, last, undo_b))
            across = self._pair_ranks(a, b)
            fine = np.where(undo_b, across > last, across >= last)  # of one rank, the left one comes first
            ok[at[~fine]] = False
            a, b, at = a[fine], b[fine], at[fine]
        return ok

    def _propose(self, word: bytes) -> list[int]:
        get, longest = self.proposals.get, self.longest.get
        whole = get(word)
        if whole is not None:
            return [whole]
        out, i, n = [], 0, len(word)
        while i < n:
            j = i + longest(word[i:i + 3], 2)
            while (t := get(word[i:j])) is None:
                j -= 1
            out.append(t)
            i = min(n, j)
        return out

    def exact(self, word: bytes) -> list[int]:
        """Merging pair by pair: lowest rank first, of one rank the leftmost."""
        ids = [self.byte_id[b] for b in word]
        after = [*range(1, len(ids)), -1]
        before = [*range(-1, len(ids) - 1)]
        heap = [(m[0], i, m[1], ids[i], ids[i + 1]) for i in range(len(ids) - 1)
                if (m := self.merge.get((ids[i], ids[i + 1])))]
        heapq.heapify(heap)
        while heap:
            _, i, made, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue
            ids[i], ids[j], after[i] = made, -1, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y >= 0 and (m := self.merge.get((ids[x], ids[y]))):
                    heapq.heappush(heap, (m[0], x, m[1], ids[x], ids[y]))
        return [i for i in ids if i >= 0]

    def _exact_many(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """``exact`` for short words, one merge of each word at a time: the
        tokens of all, and how many each word has."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        wide = int(size.max()) + 1
        col = np.arange(wide)
        ids = np.full((len(words), wide), -1, np.int64)
        ids[col < size[:, None]] = self.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        rank = np.full(ids.shape, _NONE)
        two = col + 1 < size[:, None]
        rank[two] = self._pair_ranks(ids[two], np.roll(ids, -1, axis=1)[two])
        rows = np.arange(len(words))
        while True:
            j = rank[rows].argmin(axis=1)
            best = rank[rows, j]
            more = best != _NONE
            rows, j, best = rows[more], j[more], best[more]
            if not len(rows):
                return ids[ids >= 0], (ids >= 0).sum(axis=1)
            source = np.minimum(col + (col > j[:, None]), wide - 1)  # what is right of the merge moves up
            ids[rows] = np.take_along_axis(ids[rows], source, axis=1)
            rank[rows] = np.take_along_axis(rank[rows], source, axis=1)
            ids[rows, j] = self.made[best]
            rank[rows, j] = _NONE
            at = ids[rows, j + 1] >= 0
            rank[rows[at], j[at]] = self._pair_ranks(ids[rows[at], j[at]], ids[rows[at], j[at] + 1])
            at = j > 0
            rank[rows[at], j[at] - 1] = self._pair_ranks(ids[rows[at], j[at] - 1], ids[rows[at], j[at]])

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The tokens of all words, and how many each word has."""
        raw = [w.encode("utf-8", "replace") for w in words]
        out = [self._propose(w) for w in raw]
        size = np.fromiter(map(len, out), np.int64, len(out))
        flat = np.fromiter(chain.from_iterable(out), np.int64, int(size.sum()))
        owner = np.repeat(np.arange(len(out)), size)
        inside = np.flatnonzero(owner[1:] == owner[:-1])
        if self.one_way:
            fails = ~self._compatible(flat[inside], flat[inside + 1])
        else:
            fails = np.ones(len(inside), bool)  # the check needs one merge for each token
        failed = np.zeros(len(out), bool)
        failed[owner[inside[fails]]] = True
        if not failed.any():
            return flat, size
        again = np.flatnonzero(failed)
        length = np.fromiter((len(raw[i]) for i in again), np.int64, len(again))
        again = again[np.argsort(length, kind="stable")]
        length.sort()
        short = int(np.searchsorted(length, STEPPED_LENGTH, "right"))
        runs = [self._exact_many([raw[i] for i in again[k:min(short, k + 8192)]]) for k in range(0, short, 8192)]
        runs += [(np.array(x, np.int64), np.array([len(x)])) for x in (self.exact(raw[i]) for i in again[short:])]
        right, right_size = (np.concatenate(x) for x in zip(*runs))
        # proposals that hold, then the exact ones, back in the words' order
        tokens = np.concatenate([flat, right])
        start = np.cumsum(size) - size
        start[again] = len(flat) + np.cumsum(right_size) - right_size
        size[again] = right_size
        return tokens[_spread(start, size)], size

    def _split(self, text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            if not self.newer or not self.newer.search(text):
                return self.pattern.findall(text)
            return [text[m.start():m.end()] for m in self.pattern.finditer(text.translate(self.as_symbol))]
        return self.latin.findall(text)

    def _words(self, text: str | None) -> list[str]:
        """Words in order; a special token's string is a word of its own."""
        if not text:
            return []
        if not any(t in text for t in self.special):
            return self._split(text)
        return list(chain.from_iterable(
            [part] if part in self.special else self._split(part) for part in self.special_pattern.split(text)))

    def encode_batch(self, texts: list[str | None]) -> list[np.ndarray]:
        """Token ids of each text; special tokens in a text are recognised."""
        listed = [self._words(t) for t in texts]
        words = set(chain.from_iterable(listed))
        if len(self.cache) + len(words) > CACHE_WORDS:
            self._forget()
        cache = self.cache
        new = [w for w in words if w not in cache]
        if new:
            plain = [w for w in new if w not in self.special]
            tokens, size = self.encode_words(plain)
            special = [w for w in new if w in self.special]
            tokens = np.concatenate([tokens, np.array([self.special[w] for w in special], np.int64)])
            size = np.concatenate([size, np.ones(len(special), np.int64)])
            for slot, w in enumerate(plain + special, len(self.at)):
                cache[w] = slot
            self.at = np.concatenate([self.at, len(self.pool) + np.cumsum(size) - size])
            self.size = np.concatenate([self.size, size])
            self.pool = np.concatenate([self.pool, tokens])
        count = np.fromiter(map(len, listed), np.int64, len(listed))
        slots = np.fromiter(map(cache.__getitem__, chain.from_iterable(listed)), np.int64, int(count.sum()))
        size = self.size[slots]
        ids = self.pool[_spread(self.at[slots], size)].astype(np.int32)
        ends = np.concatenate([[0], np.cumsum(size)])[np.cumsum(count)]
        long = [w for w in new if len(w) > CACHED_LENGTH]
        for w in long:
            del cache[w]
        if len(self.pool) > 16 * CACHE_WORDS:
            self._forget()
        return np.split(ids, ends[:-1])

    def decode(self, ids) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


_LOADED: dict[str, ByteBpe] = {}


def load(path: str) -> ByteBpe:
    if path not in _LOADED:
        _LOADED[path] = ByteBpe(path)
    return _LOADED[path]


IDS = T.ArrayType(T.IntegerType())
SLICE = 1 << 20


def encode(docs: DataFrame, vocabulary: str, *, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``docs`` with the token ids of the whole text, array<int>.
    ``vocabulary`` is a file that every executor can read."""
    new = T.StructType().add(ids_col, IDS)
    return append_columns(docs, text_col, new, lambda texts: [load(vocabulary).encode_batch(texts)], SLICE)


def decode(df: DataFrame, vocabulary: str, *, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``df`` with the text of the token ids, special tokens included; bytes
    that are no UTF-8 become U+FFFD.  Null ids give an empty text."""
    new = T.StructType().add(text_col, T.StringType())
    return append_columns(df, ids_col, new, lambda ids: [[load(vocabulary).decode(x or ()) for x in ids]], SLICE)


def round_trip(docs: DataFrame, vocabulary: str, *, text_col: str = "text", ids_col: str = "ids",
               decoded_col: str = "decoded") -> DataFrame:
    """``encode`` and ``decode`` in one pass: the ids, and the text they give."""

    def work(texts):
        bpe = load(vocabulary)
        ids = bpe.encode_batch(texts)
        return [ids, [bpe.decode(x.tolist()) for x in ids]]

    return append_columns(docs, text_col, T.StructType().add(ids_col, IDS).add(decoded_col, T.StringType()), work, SLICE)
