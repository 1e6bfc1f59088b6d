"""Words of Arrow text columns as numbers, without a Python object per word."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from zonalake.llm.hashing import IS_SPACE

SPACE, BREAK = 0x20, 0x0A
#: Bytes of text that are taken at once; a longer text is taken alone.
GROUP_BYTES = 4 << 20


def byte_table(spaces: np.ndarray, breaks: bytes = b"", lower: bool = False) -> np.ndarray:
    """What each byte of a text becomes: SPACE between words, BREAK between pieces, or itself."""
    table = np.arange(256, dtype=np.uint8)
    if lower:
        table[ord("A") : ord("Z") + 1] += 32
    table[spaces] = SPACE
    table[list(breaks)] = BREAK
    return table


#: Words are `[^\x20\x09-\x0D]+`.
PLAIN = byte_table(np.flatnonzero(IS_SPACE))


@dataclass
class Words:
    """All words of some texts, in order."""

    codes: np.ndarray  # place in `known`
    row: np.ndarray  # the text
    piece: np.ndarray  # number of the piece, over all texts
    known: pa.Array  # the distinct words


def coded_words(column: pa.Array, table: np.ndarray = PLAIN) -> Words:
    """The words of a string column; null counts as empty. Words and pieces end with their text."""
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1] if n else np.zeros(1, np.int64)
    size = int(offsets[-1] - offsets[0])
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if size else np.zeros(0, np.uint8)
    lengths = np.diff(offsets)
    text = np.full(size + n + 1, BREAK, np.uint8)  # a break before each text and behind the last
    text[np.arange(size) + np.repeat(np.arange(1, n + 1), lengths)] = table[data]
    is_word = (text != SPACE) & (text != BREAK)
    edges = np.flatnonzero(is_word[1:] != is_word[:-1]) + 1
    starts, ends = edges[::2], edges[1::2]
    first = offsets[:-1] - offsets[0] + np.arange(1, n + 1)
    places = np.concatenate(([0], np.cumsum(ends - starts)))
    letters = np.ascontiguousarray(text[is_word])
    words = pa.Array.from_buffers(
        pa.large_string(), len(starts), [None, pa.py_buffer(places), pa.py_buffer(letters)]
    ).dictionary_encode()
    return Words(
        words.indices.to_numpy(zero_copy_only=False).astype(np.int64),
        np.searchsorted(first, starts, side="right") - 1,
        np.cumsum(text == BREAK, dtype=np.int64)[starts],
        words.dictionary,
    )


def groups(batch: pa.RecordBatch, name: str = "text", most: int = GROUP_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts take `most` bytes together, or one longer text."""
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(batch.column(name)), 0).to_numpy(zero_copy_only=False)
    begin, total = 0, 0
    for at, size in enumerate(sizes.tolist()):
        if at > begin and total + size > most:
            yield batch.slice(begin, at - begin)
            begin, total = at, 0
        total += size
    if begin < batch.num_rows:
        yield batch.slice(begin)
