"""Words of Arrow string columns as 64-bit hashes, without a Python object per word.

Texts are UTF-8 bytes. Only A-Z are lower-cased. A word is a maximal run of bytes that are not separators; two separator
sets are in use, both made of ASCII bytes, so a character is never cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes handled at a time; a longer document is taken in pieces cut between words.
CHUNK = 1 << 18

_BYTES = np.arange(256)
#: Lower-cased byte for each byte.
LOWER = np.where((_BYTES >= 0x41) & (_BYTES <= 0x5A), _BYTES + 32, _BYTES).astype(np.uint8)
#: In words split at white space: every byte but 0x20 and 0x09-0x0D.
VISIBLE = ~((_BYTES == 0x20) | ((_BYTES >= 0x09) & (_BYTES <= 0x0D)))
#: In words of digits, letters a-z (after lower-casing) and every non-ASCII character.
LETTERS = ~((LOWER <= 0x2F) | ((LOWER >= 0x3A) & (LOWER <= 0x60)) | ((LOWER >= 0x7B) & (LOWER <= 0x7F)))

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (in place)."""
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and where each row starts (one entry more than rows); null counts as empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, bounds, data = column.buffers()
    offsets = np.frombuffer(bounds, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def groups(offsets: np.ndarray, size: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``size`` bytes; a longer row stands alone."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1)
        yield first, last
        first = last


def _powers_to(n: int) -> None:
    global _powers, _inverses
    if len(_powers) < n:
        n = max(n, CHUNK + 1)
        base = np.full(n, _BASE, np.uint64)
        inverse = np.full(n, _INVERSE, np.uint64)
        base[0] = inverse[0] = 1
        _powers, _inverses = np.multiply.accumulate(base), np.multiply.accumulate(inverse)


def _unspaced(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last bytes of characters that scripts without spaces write: CJK, Thai, Lao, Burmese, Khmer."""
    second = np.append(data[1:], 0) if len(data) else data
    three = (data >= 0xE3) & (data <= 0xE9) | (data == 0xE0) & (second >= 0xB8) & (second <= 0xBB)
    three |= (data == 0xE1) & ((second >= 0x80) & (second <= 0x82) | (second == 0x9E) | (second == 0x9F))
    four = (data == 0xF0) & (second >= 0xA0) & (second <= 0xAF)
    first, last = three | four, np.zeros(len(data), bool)
    for mark, size in ((three, 3), (four, 4)):
        last[np.minimum(np.flatnonzero(mark) + size - 1, len(data) - 1)] = True
    return first, last


def spans(data: np.ndarray, offsets: np.ndarray, table: np.ndarray, apart: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each word; no word crosses a row's bounds. With ``apart``, a character of an unspaced script is a word."""
    inside = table[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    before, after = np.empty_like(inside), np.empty_like(inside)
    if len(inside):
        before[0], before[1:] = False, inside[:-1]
        after[-1], after[:-1] = False, inside[1:]
    opens, closes = cut[:-1] | ~before, cut[1:] | ~after
    if apart and len(data) and int(data.max()) >= 0xE0:
        first, last = _unspaced(data)
        opens[first] = True
        opens[1:] |= last[:-1]
        closes[last] = True
        closes[:-1] |= first[1:]
    return np.flatnonzero(inside & opens), np.flatnonzero(inside & closes) + 1


def _hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    _powers_to(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((LOWER[data].astype(np.uint64) + np.uint64(1)) * _powers[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * _inverses[starts] + (ends - starts).astype(np.uint64))


def _pieces(data: np.ndarray, table: np.ndarray) -> Iterator[np.ndarray]:
    """Parts of one long document, cut after a separator."""
    at = 0
    while at < len(data):
        stop = at + CHUNK
        if stop < len(data):
            blanks = np.flatnonzero(~table[data[at:stop]])
            while not len(blanks) and stop < len(data):
                stop += CHUNK
                blanks = np.flatnonzero(~table[data[at:stop]])
            stop = at + int(blanks[-1]) + 1 if len(blanks) and stop < len(data) else stop
        yield data[at:stop]
        at = stop


def words(column: pa.Array, table: np.ndarray, size: int = CHUNK, heads: tuple[int, ...] = (), apart: bool = False) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For groups of whole rows: the first row, the number of words of each row, and the hashes of all their words.

    With ``heads``, a row of hashes per word: of the word, and of its first bytes, as many as each head says.
    """
    one = (lambda d, s, e: _hashes(d, s, e)) if not heads else (lambda d, s, e: np.column_stack([_hashes(d, s, e), *[_hashes(d, s, np.minimum(e, s + h)) for h in heads]]))
    data, offsets = utf8(column)
    for first, last in groups(offsets, size):
        part, bounds = data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        if last - first == 1 and len(part) > CHUNK:
            found = []
            for piece in _pieces(part, table):
                found.append(one(piece, *spans(piece, np.array([0, len(piece)]), table, apart)))
            hashes = np.concatenate(found)
            yield first, np.array([len(hashes)]), hashes
        else:
            starts, ends = spans(part, bounds, table, apart)
            yield first, np.diff(np.searchsorted(starts, bounds)), one(part, starts, ends)


def hash_word(word: str) -> int:
    """The hash that ``words`` gives this word."""
    column = pa.array([word])
    return int(next(words(column, VISIBLE))[2][0])


_TURNS = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3, 0x1D8E4E27C47D124F], np.uint64)


def shingles(hashes: np.ndarray, counts: np.ndarray, width: int) -> list[np.ndarray]:
    """Sorted distinct shingles of each row; a row with fewer words has its whole sequence as one, an empty row none."""
    turns = np.resize(_TURNS, width) * (np.arange(width, dtype=np.uint64) // np.uint64(len(_TURNS)) * np.uint64(2) + np.uint64(1))
    full = max(0, len(hashes) - width + 1)
    joined = np.full(full, width, np.uint64)
    for k in range(width):
        joined += hashes[k : k + full] * turns[k]
    mix(joined)
    found, at = [], 0
    for n in counts.tolist():
        if n >= width:
            found.append(np.unique(joined[at : at + n - width + 1]))
        elif n:
            found.append(mix(np.array([n], np.uint64) + (hashes[at : at + n] * turns[:n]).sum(dtype=np.uint64)))
        else:
            found.append(np.zeros(0, np.uint64))
        at += n
    return found


def sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of the given lengths (rows of a matrix are added); an empty run gives 0."""
    out = np.zeros((len(counts), *values.shape[1:]), values.dtype if values.dtype != bool else np.int64)
    used = counts > 0
    if used.any():
        starts = np.cumsum(counts) - counts
        out[used] = np.add.reduceat(values, starts[used], axis=0, dtype=out.dtype)
    return out
