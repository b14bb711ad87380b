"""Words of Arrow string batches as numpy arrays.

Texts are cut into tokens by a table of 256 byte classes; a token is a run of
bytes of one class other than 0, within one text.  Tokens are hashed eight
bytes at a time, all of a batch together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_S = np.uint64(32)

#: A piece holds whole texts of about so many bytes (one text at least).
PIECE_BYTES = 1 << 18


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    h = (h ^ (h >> _S)) * _M2
    h = (h ^ (h >> _S)) * _M2
    return h ^ (h >> _S)


def word_table(lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Byte classes and byte values for words of ASCII letters and digits and all other code points.

    The words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z are lower-cased.
    """
    values = np.arange(256, dtype=np.uint8)
    upper = (values >= 65) & (values <= 90)
    if lower:
        values = np.where(upper, values + 32, values).astype(np.uint8)
    codes = np.arange(256)
    word = (codes >= 128) | (codes >= 48) & (codes <= 57) | (codes >= 97) & (codes <= 122) | upper
    return word.astype(np.uint8), values


def pieces(texts: pa.Array, piece_bytes: int = PIECE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of consecutive whole texts; null is empty."""
    texts = texts.fill_null("") if texts.null_count else texts
    texts = texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    row = 0
    while row < len(texts):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + piece_bytes, "right")) - 1)
        yield row, end, data[offsets[row]:offsets[end]], offsets[row:end + 1] - offsets[row]
        row = end
    pa.default_memory_pool().release_unused()  # workers live on between stages


def token_spans(data: np.ndarray, offsets: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, row) of each token, in order."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    cls = classes[data]
    change = np.empty(len(data) + 1, bool)
    change[0] = change[-1] = True
    np.not_equal(cls[1:], cls[:-1], out=change[1:-1])
    change[offsets] = True
    edges = np.flatnonzero(change)
    start, length = edges[:-1], np.diff(edges)
    token = cls[start] > 0
    start, length = start[token], length[token]
    return start, length, np.searchsorted(offsets, start, "right") - 1


def token_hashes(data: np.ndarray, values: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """64-bit hashes of tokens, a function of their (translated) bytes alone."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[:-8] = values[data]
    eights = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))  # the eight bytes from every place on
    h = length.astype(np.uint64) * _M1
    at, left, live = start.copy(), length.copy(), np.arange(len(start))
    while len(live):
        eight = eights[at]
        short = left < 8
        eight[short] &= (np.uint64(1) << (left[short].astype(np.uint64) * np.uint64(8))) - np.uint64(1)
        h[live] = mix(h[live] ^ eight)
        on = left > 8
        live, at, left = live[on], at[on] + 8, left[on] - 8
    return h
