"""Token ids of whole texts at the speed of table look-ups.

The tokenizer lowers a text and cuts it into pieces, each of which it encodes by itself. Texts in Latin letters are cut
here, by the tokenizer's own pattern for their characters, a batch at a time in numpy; pieces met before are found by a
128-bit digest in a table of bounded size, new ones are encoded by the tokenizer, many at a time. Any other text is cut
at white space only, and its words go to the tokenizer as they are.
"""

from __future__ import annotations

import functools
import os

import numpy as np

SENTENCE_ENDS = ".!?"
# Bounds of a worker's memory: slots of the table, where a new piece replaces what is there, and ids held for pieces.
SLOTS = 1 << 21
HELD_IDS = 1 << 23
PIECES_AT_ONCE = 256
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)

# Fixed by the tokenizer file: its classes of lower-case ASCII and Latin-1 characters, and its contractions.
SPACE, LETTER, DIGIT, MARK, UNKNOWN = range(5)
CONTRACTIONS = (b"s", b"t", b"re", b"ve", b"m", b"ll", b"d")


def _classes() -> np.ndarray:
    out = np.full(256, UNKNOWN, np.uint8)
    out[0x21:0x7F] = MARK
    out[0x09:0x0E] = SPACE
    out[0x20] = SPACE
    out[ord("0") : ord("9") + 1] = DIGIT
    for first, last in ((ord("a"), ord("z")), (0xDF, 0xF6), (0xF8, 0xFF)):
        out[first : last + 1] = LETTER
    return out


CLASSES = _classes()


def cut_pieces(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every piece of lower-case Latin-1 bytes."""
    kind = CLASSES[text]
    before = np.empty_like(kind)
    before[0], before[1:] = SPACE, kind[:-1]
    solid = kind != SPACE
    start = solid & ((kind != before) | (kind == DIGIT))
    # A contraction starts at an apostrophe outside a run of marks; what follows it is a piece of its own.
    quotes = np.flatnonzero((text == ord("'")) & (before != MARK))
    if len(quotes):
        padded = np.concatenate([text, np.full(4, ord(" "), np.uint8)])
        for tail in CONTRACTIONS:
            at = quotes
            for k, letter in enumerate(tail, 1):
                at = at[padded[at + k] == letter]
            start[at + 1] = False
            after = at + 1 + len(tail)
            after = after[after < len(text)]
            start[after] = solid[after]
    stop = np.empty_like(start)
    stop[-1] = solid[-1]
    stop[:-1] = solid[:-1] & (start[1:] | ~solid[1:])
    return np.flatnonzero(start), np.flatnonzero(stop) + 1


class PieceTokenizer:
    """Ids of texts as arrays of unsigned 32-bit numbers."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends_piece = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_piece[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.ends_sentence = np.zeros_like(self.ends_piece)
        self.ends_sentence[[i for t, i in vocabulary.items() if t.endswith("</w>") and t[:-4] and t[-5] in SENTENCE_ENDS]] = True
        self.forget()

    def forget(self) -> None:
        """Lets go of the pieces met so far."""
        self.powers = [(np.ones(1, np.uint64),) * 2 for _ in BASES]
        self._empty()

    def _empty(self) -> None:
        self.keys = [np.zeros(SLOTS, np.uint64) for _ in BASES]
        self.place = np.zeros(SLOTS, np.int64)
        self.count = np.zeros(SLOTS, np.int32)  # 0: the slot is free
        self.store = np.zeros(1 << 16, "<u4")
        self.stored = 0

    def ids(self, bodies: list[bytes]) -> list[np.ndarray]:
        out: list[np.ndarray] = [np.zeros(0, "<u4")] * len(bodies)
        latin: list[tuple[int, bytes]] = []
        for k, body in enumerate(bodies):
            text = body.decode("utf-8", "replace")
            try:
                low = text.lower().encode("latin-1")
            except UnicodeEncodeError:
                low = None
            if low is None or b"<|" in low or (CLASSES[np.frombuffer(low, np.uint8)] == UNKNOWN).any():
                out[k] = self._by_word(body)
            else:
                latin.append((k, low))
        if latin:
            joined = np.frombuffer(b"\n".join(low for _, low in latin) + b"\n", np.uint8)
            ids, counts, starts = self._encode(joined)
            ends = np.cumsum([len(low) + 1 for _, low in latin])
            upto = np.concatenate([[0], counts.cumsum()])[np.searchsorted(starts, ends)]
            for (k, _), part in zip(latin, np.split(ids, upto[:-1]), strict=True):
                out[k] = part
        return out

    def _encode(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all pieces, their number per piece, and where the pieces start."""
        start, end = cut_pieces(text)
        if not len(start):
            return np.zeros(0, "<u4"), np.zeros(0, np.int64), start
        keys = [self._digests(text, start, end, k) for k in range(len(BASES))]
        slot = (keys[0] >> np.uint64(20)).astype(np.int64) & (SLOTS - 1)
        place, count = self.place[slot], self.count[slot].astype(np.int64)
        missed = np.flatnonzero((self.keys[0][slot] != keys[0]) | (self.keys[1][slot] != keys[1]) | (count == 0))
        if len(missed):
            both = np.stack([key[missed] for key in keys], axis=1).view([("", np.uint64)] * 2)[:, 0]
            _, first, same = np.unique(both, return_index=True, return_inverse=True)
            new = missed[first]
            body = text.tobytes()
            found = self._new_pieces([body[s:e].decode("latin-1") for s, e in zip(start[new].tolist(), end[new].tolist(), strict=True)])
            lengths = np.array([len(x) for x in found], np.int64)
            flat = np.concatenate(found)
            if self.stored + len(flat) > HELD_IDS:
                # Pieces found before are read from the old store, then all start afresh.
                old = self.store
                self._empty()
                hit = np.ones(len(start), bool)
                hit[missed] = False
                kept = _ragged(old, place[hit], count[hit])
                self._grow(len(kept))
                self.store[: len(kept)] = kept
                self.stored = len(kept)
                place[hit] = count[hit].cumsum() - count[hit]
            self._grow(self.stored + len(flat))
            self.store[self.stored : self.stored + len(flat)] = flat
            at = self.stored + lengths.cumsum() - lengths
            self.stored += len(flat)
            place[missed], count[missed] = at[same], lengths[same]
            for table, key in zip(self.keys, keys, strict=True):
                table[slot[new]] = key[new]
            self.place[slot[new]], self.count[slot[new]] = at, lengths
        return _ragged(self.store, place, count), count, start

    def _digests(self, text: np.ndarray, start: np.ndarray, end: np.ndarray, k: int) -> np.ndarray:
        n = len(text)
        powers, inverse = self.powers[k]
        if len(powers) < n:
            step = np.full((2, 2 * n), BASES[k], np.uint64)
            step[1] = pow(BASES[k], -1, 1 << 64)
            step[:, 0] = 1
            powers, inverse = self.powers[k] = tuple(np.multiply.accumulate(step, axis=1))
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((text.astype(np.uint64) + np.uint64(1)) * powers[:n], out=sums[1:])
        key = (sums[end] - sums[start]) * inverse[start]
        key ^= key >> np.uint64(32)
        key *= np.uint64(BASES[1 - k])
        return key ^ (key >> np.uint64(29)) ^ (end - start).astype(np.uint64)

    def _grow(self, size: int) -> None:
        if size > len(self.store):
            self.store = np.concatenate([self.store, np.zeros(max(size - len(self.store), len(self.store)), "<u4")])

    def _new_pieces(self, pieces: list[str]) -> list[np.ndarray]:
        """Tokenises the pieces as one text; the last token of each is one that ends a word."""
        out: list[np.ndarray] = []
        for k in range(0, len(pieces), PIECES_AT_ONCE):
            some = pieces[k : k + PIECES_AT_ONCE]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, "<u4")
            ends = np.flatnonzero(self.ends_piece[ids]) + 1
            if len(ends) != len(some):
                raise ValueError("the tokenizer does not mark the end of every word")
            out += np.split(ids, ends[:-1])
        return out

    def _by_word(self, body: bytes) -> np.ndarray:
        words = body.split()  # at ASCII white space, for bytes
        distinct = list(set(words))
        found = self.tokenizer.encode_batch_fast([w.decode("utf-8", "replace") for w in distinct], add_special_tokens=False)
        ids = {w: np.array(e.ids, "<u4") for w, e in zip(distinct, found, strict=True)}
        return np.concatenate([np.zeros(0, "<u4"), *map(ids.__getitem__, words)])


def _ragged(store: np.ndarray, place: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The stretches of ``store`` at ``place``, one after the other."""
    ends = count.cumsum()
    return store[np.repeat(place - ends + count, count) + np.arange(ends[-1] if len(ends) else 0)]


@functools.cache
def piece_tokenizer(path: str) -> PieceTokenizer:
    return PieceTokenizer(path)
