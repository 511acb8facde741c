"""Token ids of whole texts by a public word-level BPE, with a bounded cache of pieces between white space.

The tokenizer drops white space, so the ids of a text are the ids of its pieces. A piece of Latin-1 letters followed by ASCII punctuation splits once
more, and such a word's merges are applied here: most distinct pieces are words, and a call of the library costs more than they do. All pieces of a
batch are looked up at once in a table of their bytes. Texts for which that would not hold (control characters that Python, but not the tokenizer,
takes for white space) are encoded whole.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np

TOKENIZER = "word_bpe_49k.json"
CACHE_PIECES = 400_000  # in a worker; a full cache starts anew
WORD_BYTES = 64  # longer words are the library's

_ODD = re.compile(r"[\x1c-\x1f]")
_SPACES = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")  # beside the ASCII ones
_NONE = 1 << 30
_SPACE, _LETTER, _MARK, _OTHER = range(4)
_SLOT_BITS = 20
_KEY_BYTES = 23  # of a piece in the table, whose 24th byte is its length; longer pieces are kept in a dictionary
_CHUNK = 1 << 18  # pieces looked up at once


def _byte_kinds() -> np.ndarray:
    """The kind of each byte; 0xC3 and the bytes that continue it count as letters, which two of them (× and ÷) are not."""
    kinds = np.full(256, _OTHER, np.uint8)
    for b in range(128):
        c = chr(b)
        kinds[b] = _SPACE if c.isspace() else _LETTER if c.isalpha() else _MARK if c.isprintable() and not c.isdigit() else _OTHER
    kinds[0x80:0xC0] = kinds[0xC3] = _LETTER
    return kinds


_KINDS = _byte_kinds()
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _count_before(flags: np.ndarray) -> np.ndarray:
    """How many flags are set before each place."""
    out = np.zeros(len(flags) + 1, np.int32 if len(flags) < _NONE else np.int64)
    np.cumsum(flags, out=out[1:])
    return out


class Encoder:
    """ids(text) gives a whole text's ids as little-endian uint16."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        if self.model.get_vocab_size() > 1 << 16:
            raise ValueError("ids of this tokenizer need more than 16 bits")
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab, merges = model["vocab"], [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = iter(range(256, 512))
        chars = {b: chr(b) if b in printable else chr(next(others)) for b in range(256)}  # how byte-level vocabularies write bytes
        self.inner, self.final = (np.array([vocab[chars[b] + end] for b in range(256)], np.int32) for end in ("", model["end_of_word_suffix"]))
        self.made = np.array([vocab[a + b] for a, b in merges], np.int32)
        self._hash_pairs(np.array([vocab[a] << 16 | vocab[b] for a, b in merges], np.uint32))
        self._forget()

    def _forget(self) -> None:
        """Start with an empty cache: a table from the bytes of a piece to its number, and the ids of each number."""
        self.table, self.number, self.claim = np.zeros((3, 1 << _SLOT_BITS), np.uint64), np.full(1 << _SLOT_BITS, -1, np.int32), np.zeros(1 << _SLOT_BITS, np.int32)
        self.long: dict[bytes, int] = {}
        self.known, self.offset, self.flat = 0, np.zeros(1 << 16, np.int64), np.zeros(1 << 18, np.uint16)

    def _hash_pairs(self, pairs: np.ndarray) -> None:
        """An open-addressing table from pairs of ids to the ranks of their merges."""
        self.keys, self.ranks, self.probes = np.full(1 << 19, 0xFFFFFFFF, np.uint32), np.full(1 << 19, _NONE, np.int32), 0
        rank = np.arange(len(pairs), dtype=np.int32)
        while len(rank):
            slot = self._slot(pairs[rank], self.probes)
            free = self.keys[slot] == 0xFFFFFFFF
            self.keys[slot[free]] = pairs[rank[free]]
            mine = self.keys[slot] == pairs[rank]
            self.ranks[slot[mine]] = rank[mine]
            rank = rank[~mine]
            self.probes += 1

    @staticmethod
    def _slot(pairs: np.ndarray, probe: int) -> np.ndarray:
        return ((pairs * np.uint32(2654435761) >> np.uint32(13)) + np.uint32(probe)) & np.uint32((1 << 19) - 1)

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of ids; _NONE where they don't merge or one is missing (-1)."""
        pairs = (left.astype(np.uint32) << np.uint32(16)) | right.astype(np.uint32)
        pairs[(left < 0) | (right < 0)] = 0xFFFFFFFE
        slot = self._slot(pairs, 0)
        out = np.where(self.keys[slot] == pairs, self.ranks[slot], _NONE)
        for probe in range(1, self.probes):
            slot = self._slot(pairs, probe)
            out = np.minimum(out, np.where(self.keys[slot] == pairs, self.ranks[slot], _NONE))
        return out

    def _encode(self, text: str) -> np.ndarray:
        return np.array(self.model.encode(text, add_special_tokens=False).ids, "<u2")

    def _merge(self, ids: np.ndarray) -> np.ndarray:
        """Apply the merges to rows of ids, each filled up with -1: in each round the pair with the lowest rank of every row merges."""
        out, at = np.full(ids.shape, -1, np.int32), np.arange(len(ids))
        ranks = self._rank(ids[:, :-1], ids[:, 1:])
        while len(at):
            if not ranks.shape[1]:
                out[at, : ids.shape[1]] = ids
                break
            row = np.arange(len(at))
            best = ranks.argmin(axis=1)
            rank = ranks[row, best]
            done = rank == _NONE
            if done.any():
                out[at[done], : ids.shape[1]] = ids[done]
                at, ids, ranks, best, rank = at[~done], ids[~done], ranks[~done], best[~done], rank[~done]
                row = np.arange(len(at))
            if not len(at):
                break
            ids[row, best] = self.made[rank]
            place = np.arange(ids.shape[1] - 1)
            ids = np.take_along_axis(ids, place + (place > best[:, None]), axis=1)
            place = place[:-1]
            ranks = np.take_along_axis(ranks, place + (place >= best[:, None]), axis=1)
            some = best > 0
            ranks[row[some], best[some] - 1] = self._rank(ids[row[some], best[some] - 1], ids[row[some], best[some]])
            some = best < ranks.shape[1]
            ranks[row[some], best[some]] = self._rank(ids[row[some], best[some]], ids[row[some], best[some] + 1])
        return out

    def _learn(self, raw: np.ndarray, low: np.ndarray, start: np.ndarray, end: np.ndarray, word: np.ndarray) -> None:
        """Put the ids of new pieces into the cache, in this order. word: those of Latin-1 letters alone."""
        size = end - start
        found, low_width = [], 0
        for width in (6, 10, 16, 32, WORD_BYTES):
            at = np.flatnonzero(word & (size > low_width) & (size <= width))
            low_width = width
            if len(at):
                place = np.arange(int(size[at].max()))
                inside = place < size[at][:, None]
                taken = low[np.minimum(start[at][:, None] + place, len(low) - 1)]
                ids = np.where(inside, self.inner[taken], -1)
                ids[np.arange(len(at)), size[at] - 1] = self.final[low[end[at] - 1]]
                merged = self._merge(ids)
                found.append((at, merged, (merged >= 0).sum(axis=1)))
        lengths = np.zeros(len(start), np.int64)
        for at, _, n in found:
            lengths[at] = n
        single = [(i, self._encode(raw[start[i] : end[i]].tobytes().decode("utf-8"))) for i in np.flatnonzero(~word | (size > WORD_BYTES)).tolist()]
        for i, ids in single:
            lengths[i] = len(ids)
        base, first = int(self.offset[self.known]), self.known
        self.known += len(start)
        if len(self.offset) <= self.known:
            self.offset = np.concatenate([self.offset, np.zeros(self.known + len(self.offset), np.int64)])
        offset = self.offset[first : self.known + 1]
        np.cumsum(lengths, out=offset[1:])
        offset[1:] += base
        if len(self.flat) < offset[-1]:
            self.flat = np.concatenate([self.flat, np.zeros(int(offset[-1]) + len(self.flat), np.uint16)])
        for at, merged, _ in found:
            inside = merged >= 0
            self.flat[(offset[at][:, None] + np.arange(merged.shape[1]))[inside]] = merged[inside]
        for i, ids in single:
            self.flat[offset[i] : offset[i] + len(ids)] = ids

    def _numbers(self, raw: np.ndarray, low: np.ndarray, start: np.ndarray, end: np.ndarray, simple: np.ndarray, word: np.ndarray) -> np.ndarray:
        """The number of each piece; those that are not known yet are learned. simple: pieces whose letters' case doesn't matter."""
        size, out, new, count = end - start, np.full(len(start), -1, np.int32), [], self.known
        short = np.flatnonzero(size <= _KEY_BYTES)
        keys = np.empty((len(self.table), len(short)), np.uint64)
        for k in range(len(keys)):
            some = np.clip(size[short] - 8 * k, 0, 8)
            place = np.where(some > 0, start[short] + 8 * k, 0)
            view = [np.ndarray((len(x) - 7,), "<u8", x, strides=(1,))[place] for x in (low, raw)]
            keys[k] = np.where(simple[short], *view) & np.where(some > 0, ~np.uint64(0) >> (np.uint64(64) - np.uint64(8) * np.maximum(some, 1).astype(np.uint64)), np.uint64(0))
        keys[2] |= size[short].astype(np.uint64) << np.uint64(56)
        mixed = keys[0] * np.uint64(0x9E3779B97F4A7C15) ^ (keys[1] + np.uint64(0x7F4A7C15)) * np.uint64(0xC2B2AE3D27D4EB4F) ^ keys[2] * np.uint64(0xFF51AFD7ED558CCD)
        mixed ^= mixed >> np.uint64(29)
        slot = (mixed * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)
        todo = np.arange(len(short), dtype=np.int32)
        while len(todo):
            number = self.number[slot]
            used = number >= 0
            same = used & (self.table[0, slot] == keys[0, todo])
            for k in range(1, len(keys)):
                same &= self.table[k, slot] == keys[k, todo]
            out[short[todo[same]]] = number[same]
            free = np.flatnonzero(~used)
            if len(free):  # of the pieces that want a free slot one gets it; the others look again
                self.claim[slot[free]] = todo[free]
                got = free[self.claim[slot[free]] == todo[free]]
                self.table[:, slot[got]] = keys[:, todo[got]]
                self.number[slot[got]] = np.arange(count, count + len(got))
                new.append(short[todo[got]])
                count += len(got)
            slot = np.where(used, slot + 1 & (1 << _SLOT_BITS) - 1, slot)[~same]
            todo = todo[~same]
        rest = []
        for i in np.flatnonzero(size > _KEY_BYTES).tolist():
            key = (low if simple[i] else raw)[start[i] : end[i]].tobytes()
            if key not in self.long:
                self.long[key] = count
                rest.append(i)
                count += 1
            out[i] = self.long[key]
        at = np.concatenate([*new, np.array(rest, np.int64)]).astype(np.int64)
        if len(at):
            self._learn(raw, low, start[at], end[at], word[at])
        return out

    def _pieces(self, raw: np.ndarray) -> tuple[np.ndarray, ...]:
        """(bytes in lower case, start, end, simple, word) of the pieces, words and the marks after them apart."""
        kinds, low = _KINDS[raw], _LOWER[raw]
        lead = np.flatnonzero(raw[:-1] == 0xC3)
        after = raw[lead + 1]
        kinds[lead[(after == 0x97) | (after == 0xB7)]] = _OTHER
        upper = lead[(after <= 0x9E) & (after != 0x97)]
        low[upper + 1] += 32
        edge = np.diff((kinds != _SPACE).view(np.int8))
        start, end = np.flatnonzero(edge == 1) + 1, np.flatnonzero(edge == -1) + 1
        wrong = kinds == _OTHER
        wrong[1:] |= (kinds[1:] == _LETTER) & (kinds[:-1] == _MARK)
        wrong, letters = _count_before(wrong), _count_before(kinds == _LETTER)
        simple = (wrong[end] == wrong[start]) & (kinds[start] == _LETTER)
        middle = np.where(simple, start + letters[end] - letters[start], end)
        marked = middle < end
        at = np.arange(len(start)) + _count_before(marked)[:-1]
        n = len(start) + int(marked.sum())
        cut, stop, plain, word = np.empty(n, np.int64), np.empty(n, np.int64), np.ones(n, bool), np.zeros(n, bool)
        cut[at], stop[at], plain[at], word[at] = start, middle, simple, simple
        cut[at[marked] + 1], stop[at[marked] + 1] = middle[marked], end[marked]
        return low, cut, stop, plain, word

    def all_ids(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text."""
        cut = [t or "" for t in texts]
        whole = {i: self._encode(t) for i, t in enumerate(cut) if _ODD.search(t)}
        parts = [b"" if i in whole else (t if t.isascii() else _SPACES.sub(" ", t)).encode("utf-8") for i, t in enumerate(cut)]
        raw = np.frombuffer(b" " + b" ".join(parts) + b" " * 32, np.uint8)
        bounds = np.cumsum([1 + len(p) for p in parts])
        low, start, end, simple, word = self._pieces(raw)
        ids, done = [np.zeros(0, np.uint16)], np.zeros(len(start) + 1, np.int64)
        for at in range(0, len(start), _CHUNK):
            if self.known > CACHE_PIECES:
                self._forget()
            part = slice(at, at + _CHUNK)
            number = self._numbers(raw, low, start[part], end[part], simple[part], word[part])
            first = self.offset[number]
            n = self.offset[number + 1] - first
            stop = np.cumsum(n)
            ids.append(self.flat[np.repeat(first - stop + n, n) + np.arange(stop[-1])])
            done[at + 1 : at + 1 + len(n)] = done[at] + stop
        flat = np.concatenate(ids)
        stops = done[np.searchsorted(start, bounds, "left")]
        starts = np.concatenate([[0], stops[:-1]])
        return [whole[i] if i in whole else flat[a:b] for i, (a, b) in enumerate(zip(starts.tolist(), stops.tolist(), strict=True))]

    def ids(self, text: str | None) -> np.ndarray:
        return self.all_ids([text])[0]


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder: it outlives a task when the worker does."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
