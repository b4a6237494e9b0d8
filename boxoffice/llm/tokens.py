"""Token ids of many texts at once: every distinct word is encoded once and its ids are copied.

A tokenizer file of the tokenizers library splits text into words before it merges, so a text can
be cut where no word, nor the rule that finds words, looks across: ``cut_words`` (the tokenizer
drops white space) and ``cut_spaced`` (a word keeps the white space before it). Equal pieces have
equal ids; they are found by their 64-bit hash.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

import numpy as np

from boxoffice.llm.words import ASCII_SPACE, distinct, hashes, spans

# Distinct pieces a Python worker remembers; beyond it the memory starts anew. About 60 bytes each.
REMEMBERED = 2_500_000
# The same where a lexicon knows the frequent ones, so that what is remembered is seldom seen again.
REMEMBERED_BESIDE_LEXICON = 250_000

Cut = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]]

# White space beyond ASCII in UTF-8: first bytes of two or three, and the last byte.
_WIDE_SPACE = [
    *[bytes([0xC2, last]) for last in (0x85, 0xA0)],
    b"\xe1\x9a\x80",
    *[bytes([0xE2, 0x80, last]) for last in (*range(0x80, 0x8B), 0xA8, 0xA9, 0xAF)],
    b"\xe2\x81\x9f",
    b"\xe3\x80\x80",
]


_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_MARK = np.zeros(256, bool)
_MARK[list(b'!"#$%&()*+,-./:;=?@[]^_`{}~')] = True


def cut_words(buffer: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of bytes other than ASCII white space, cut again at ``_marks``."""
    starts, ends, _ = spans(buffer, offsets, ASCII_SPACE)
    more = _marks(buffer, offsets)
    starts, ends = (np.sort(np.concatenate([edges, more]), kind="stable") for edges in (starts, ends))
    return starts, ends, np.searchsorted(starts, offsets)


def _marks(buffer: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where an ASCII mark follows an ASCII letter of the same text; every tokenizer rule ends a word there.

    The apostrophe, which begins endings, and the marks of special tokens are left out.
    """
    found = _MARK[buffer[1:]] & _LETTER[buffer[:-1]]
    edges = offsets[(offsets > 0) & (offsets < len(buffer))]
    found[edges - 1] = False
    return np.flatnonzero(found) + 1


def cut_spaced(buffer: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pieces that begin where a run of white space begins, or at ``_marks``; together they are the whole text."""
    if not len(buffer):
        empty = np.zeros(0, np.int64)
        return empty, empty, np.zeros(len(offsets), np.int64)
    space = ASCII_SPACE[buffer]
    # A run that begins with wide white space is not cut: only where ASCII white space follows another byte.
    after = space | _ends_of_wide_space(buffer)
    begins = np.empty(len(buffer), bool)
    begins[0] = True
    np.logical_and(space[1:], ~after[:-1], out=begins[1:])
    begins[offsets[offsets < len(buffer)]] = True
    begins[_marks(buffer, offsets)] = True
    starts = np.flatnonzero(begins)
    return starts, np.append(starts[1:], len(buffer)), np.searchsorted(starts, offsets)


def _ends_of_wide_space(buffer: np.ndarray) -> np.ndarray:
    ends = np.zeros(len(buffer), bool)
    raw = buffer.tobytes()
    for lead in (b"\xc2\x85", b"\xc2\xa0", b"\xe1\x9a\x80", b"\xe2\x80", b"\xe2\x81\x9f", b"\xe3\x80\x80"):
        at = raw.find(lead)
        while at >= 0:
            for wide in _WIDE_SPACE:
                if raw.startswith(wide, at):
                    ends[at + len(wide) - 1] = True
            at = raw.find(lead, at + 1)
    return ends


class Encoder:
    """Ids of pieces, remembered by hash; ``encode`` is asked for unknown pieces only."""

    def __init__(self, encode: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]], known=None) -> None:
        self.encode = encode
        # known: (flat ids, begin of each, count of each, find); a lexicon that is asked first.
        self.known = known
        self.most = REMEMBERED_BESIDE_LEXICON if known else REMEMBERED
        self._clear()

    def _clear(self) -> None:
        self.codes = np.zeros(0, np.uint64)
        self.slots = np.zeros(0, np.int32)
        self.flat = self.known.ids.copy() if self.known else np.zeros(0, np.int32)
        self.used = len(self.flat)
        self.begin = self.known.begin.astype(np.int64) if self.known else np.zeros(0, np.int64)
        self.count = self.known.count.astype(np.int32) if self.known else np.zeros(0, np.int32)
        self.words = len(self.begin)

    def _append(self, ids: np.ndarray, counts: np.ndarray) -> None:
        ends = self.used + np.cumsum(counts)
        self.flat = _put(self.flat, self.used, ids)
        self.begin = _put(self.begin, self.words, ends - counts)
        self.count = _put(self.count, self.words, counts)
        self.used += len(ids)
        self.words += len(counts)

    def _places(self, buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Where the ids of each distinct piece are."""
        if len(self.codes) > self.most:
            self._clear()
        places = np.full(len(codes), -1, np.int64)
        if self.known:
            places = self.known.find(buffer, starts, ends)
        ask = np.flatnonzero(places < 0)
        at = np.searchsorted(self.codes, codes[ask])
        have = at < len(self.codes)
        have[have] = self.codes[at[have]] == codes[ask[have]]
        places[ask[have]] = self.slots[at[have]]
        fresh, at = ask[~have], at[~have]
        if len(fresh):
            raw = buffer.tobytes()
            words = [raw[a:b] for a, b in zip(starts[fresh].tolist(), ends[fresh].tolist())]
            slots = self.words + np.arange(len(fresh), dtype=np.int32)
            self._append(*self.encode(words))
            self.codes = np.insert(self.codes, at, codes[fresh])
            self.slots = np.insert(self.slots, at, slots)
            places[fresh] = slots
        return places

    def __call__(self, buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order, and how many each piece has."""
        codes, first, went = distinct(hashes(buffer, starts, ends))
        places = self._places(buffer, starts[first], ends[first], codes)
        begin, counts = self.begin[places][went], self.count[places][went].astype(np.int64)
        return self.flat[ranges(begin, counts)], counts

    def counts(self, buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """How many ids each piece has."""
        codes, first, went = distinct(hashes(buffer, starts, ends))
        places = self._places(buffer, starts[first], ends[first], codes)  # may replace the table it points into
        return self.count[places][went].astype(np.int64)


def ranges(begin: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The indices begin, begin + 1, ... of every range, one after the other."""
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(begin - (ends - counts), counts) + np.arange(total)


def _put(array: np.ndarray, used: int, values: np.ndarray) -> np.ndarray:
    """The array with values from ``used`` on, in a larger one if they do not fit."""
    if used + len(values) > len(array):
        larger = np.empty(max(2 * len(array), used + len(values), 1 << 16), array.dtype)
        larger[:used] = array[:used]
        array = larger
    array[used : used + len(values)] = values
    return array


# A word of Latin letters, perhaps after a space or line end and before a run of ASCII marks other than
# the apostrophe and "<": the tokenizers' own rules cut it there, and a line end from what follows.
_SIMPLE = re.compile(rb"(\n?)( ?(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+)([!-&(-/:;=-@\[-`{-~]*)")


def _byte_alphabet() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [byte for byte in range(256) if byte not in plain]
    return {byte: chr(byte) for byte in plain} | {byte: chr(256 + at) for at, byte in enumerate(others)}


def library_encode(path: str, separator: str, lower: bool = False) -> Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]:
    """Encodes pieces with the tokenizers library, many in one call.

    Simple words go to the file's own merges at once. All others go through the whole tokenizer:
    they are joined by a special token of the file, which the library takes out before anything
    else, so each piece is encoded on its own; one that contains it is encoded alone. ``lower``
    says that the file lower-cases texts.
    """
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    merges = Tokenizer(tokenizer.model)
    mark, sign = tokenizer.token_to_id(separator), separator.encode()
    alphabet = _byte_alphabet()
    # A piece of its own that no simple word has: the byte 0.
    stop = alphabet[0]
    end = alphabet[10]
    stop_id = merges.encode([stop], is_pretokenized=True, add_special_tokens=False).ids[0]

    def ids_of(raw: bytes) -> np.ndarray:
        return np.array(tokenizer.encode_batch_fast([raw.decode()], add_special_tokens=False)[0].ids, np.int32)

    def whole(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        ids = ids_of(sign.join(b"" if sign in word else word for word in words))
        cuts = np.flatnonzero(ids == mark)
        counts = np.diff(np.concatenate([[-1], cuts, [len(ids)]])) - 1
        ids = np.delete(ids, cuts)
        if any(sign in word for word in words):
            parts = np.split(ids, np.cumsum(counts)[:-1])
            parts = [ids_of(word) if sign in word else part for word, part in zip(words, parts)]
            ids, counts = np.concatenate(parts), np.array([len(part) for part in parts])
        return ids, counts

    def spelt(word: bytes) -> str:
        return (word.decode().lower().encode() if lower else word).decode("latin-1").translate(alphabet)

    def simple(found: list[re.Match]) -> tuple[np.ndarray, np.ndarray]:
        parts = []
        for match in found:
            line, word, marks = match.groups()
            if line and not lower:  # dropped, like all white space, where texts are lower-cased
                parts.append(end)
            parts.append(spelt(word))
            if marks:
                parts.append(marks.decode())
            parts.append(stop)
        made = merges.encode_batch_fast([parts], is_pretokenized=True, add_special_tokens=False)[0]
        ids = np.array(made.ids, np.int32)
        cuts = np.flatnonzero(ids == stop_id)
        return ids[ids != stop_id], np.diff(np.concatenate([[-1], cuts])) - 1

    def runs(words: list, made: Callable) -> list[tuple[np.ndarray, np.ndarray]]:
        return [made(words[at : at + 1024]) for at in range(0, len(words), 1024)]

    def encode(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        found = [_SIMPLE.fullmatch(word) for word in words]
        easy = np.array([match is not None and b"\n " not in match[0] for match in found], bool)
        made = runs([match for match, plain in zip(found, easy.tolist()) if plain], simple)
        made += runs([word for word, plain in zip(words, easy.tolist()) if not plain], whole)
        flat, sizes = (np.concatenate(part) for part in zip(*made))
        # They come simple ones first; put them back in order.
        order = np.concatenate([np.flatnonzero(easy), np.flatnonzero(~easy)])
        counts = np.empty(len(words), np.int64)
        begin = np.empty(len(words), np.int64)
        counts[order] = sizes
        begin[order] = np.cumsum(sizes) - sizes
        return flat[ranges(begin, counts)], counts

    return encode


_ENCODERS: dict[tuple, Encoder] = {}


def encoder_for(key: tuple, make: Callable[[], Encoder]) -> Encoder:
    """One encoder for each Python worker and key, kept between tasks."""
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = make()
    return _ENCODERS[key]


def byte_level_encoder(path: str) -> Encoder:
    return encoder_for(("byte", path), lambda: Encoder(library_encode(path, "<|endoftext|>")))


def per_text(counts: np.ndarray, first: Sequence[int]) -> np.ndarray:
    """Ids of each text, from those of its pieces."""
    sums = np.concatenate([[0], np.cumsum(counts)])
    return np.diff(sums[np.asarray(first)])
