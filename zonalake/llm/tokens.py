"""Token ids as binary shards with a minimal perfect hash index.

A shard file holds the ids of a range of documents in ascending doc_id:

    payload     ids of all documents, little-endian, 2 or 4 bytes each, end id included
    index       key int64 and repeat uint32 (the how-manieth row of this id), and first id uint64,
                number of ids uint64 and fingerprint uint32, all in order of the hash; bit arrays
    footer      magic, id width, counts and places of the parts

The index is a cascade of bit arrays: keys that fall alone on a bit of a level are done, the others
go on to the next; the rank of a key's bit among all set bits is its slot, so n keys have n slots and
a lookup takes constant time. The stored fingerprint and key reject ids that are not in the shard.

Cases: a null text is an empty one and has the end id only; repeated ids are separate documents,
distinguished by their repeat number; null ids come first; an empty table gives no shards and an
empty result; other columns are ignored.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zonalake.llm.files import new_file, ranges, shared_folder
from zonalake.llm.hashing import U64, mixed
from zonalake.llm.wordcodes import groups
from zonalake.session import settle

END_ID = 0
NO_ID = -(2**63)
MAGIC = b"ZTOK0001"
FOOTER = struct.Struct("<8sQQQQQQ")
#: Pieces whose ids a worker remembers, in each of two generations.
REMEMBERED = 200_000
#: The longest piece that is remembered beyond its group of texts, in bytes.
LONGEST = 64
#: Unknown pieces that are encoded in one call, and bytes of texts that are encoded at once.
AT_ONCE = 100
BYTES_AT_ONCE = 4 << 20
MANIFEST = "shard int, path string, n_docs bigint, n_ids bigint"
READ = "shard int, slot bigint, doc_id bigint, first bigint, n_tokens bigint, ids_crc32 bigint"

#: What bytes of UTF-8 stand for at a cut. BEHIND is the last byte of characters that are certainly no white
#: space (no white space beyond ASCII ends in such a byte); no cut is made at the bytes left OPEN.
OPEN, LETTER, DIGIT, SIGN, APOSTROPHE, BLANK, LINE, BEHIND = range(8)


def _classes() -> np.ndarray:
    table = np.zeros(256, np.uint8)
    table[0x21:0x7F] = SIGN
    table[list(range(0x41, 0x5B)) + list(range(0x61, 0x7B))] = LETTER
    table[0x30:0x3A] = DIGIT
    table[0x27], table[0x20], table[0x0A] = APOSTROPHE, BLANK, LINE
    white = {chr(c).encode()[-1] for c in range(0x80, 0x10000) if chr(c).isspace()}
    table[[b for b in range(0x80, 0xC0) if b not in white]] = BEHIND
    return table


def _cut_table() -> np.ndarray:
    """Whether the tokenizer cuts between bytes of two classes, wherever they stand, at 8 * first + second.

    It cuts before white space that follows anything else, and where a run of letters, digits or signs
    ends; an apostrophe may go with the letters or signs around it.
    """
    table = np.zeros(64, bool)
    for first in (LETTER, DIGIT, SIGN, APOSTROPHE, BEHIND):
        table[[8 * first + BLANK, 8 * first + LINE]] = True
    table[[8 * LETTER + x for x in (DIGIT, SIGN, APOSTROPHE)]] = True
    table[[8 * DIGIT + x for x in (LETTER, SIGN, APOSTROPHE)]] = True
    table[[8 * SIGN + x for x in (LETTER, DIGIT)]] = True
    table[8 * APOSTROPHE + DIGIT] = True
    return table


_CLASS, _CUT = _classes(), _cut_table()


def piece_starts(data: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Where pieces begin that can be encoded one by one, in the UTF-8 of texts that begin at `texts`."""
    kind = _CLASS[data]
    cut = np.zeros(len(data), bool)
    cut[1:] = _CUT[(kind[:-1] << 3) | kind[1:]]
    # A single line end between two pieces is one of its own.
    line = np.flatnonzero(cut[:-1] & (kind[:-1] == LINE))
    after = kind[line + 1]
    cut[line[(after >= LETTER) & (after <= APOSTROPHE)] + 1] = True
    cut[texts[texts < len(data)]] = True
    return np.flatnonzero(cut)


def _cuts_at_words(path: str) -> bool:
    """Whether the tokenizer of this file cuts texts as `Encoder` assumes: byte-level with its own
    expression, no space put before a text, and no normalisation."""
    with open(path, encoding="utf-8") as file:
        own = json.load(file)
    cut = own.get("pre_tokenizer") or {}
    return (
        own.get("normalizer") is None
        and own["model"]["type"] == "BPE"
        and cut.get("type") == "ByteLevel"
        and not cut.get("add_prefix_space")
        and cut.get("use_regex", True)
    )


def _is_line(piece: bytes) -> bool:
    """Whether the piece has no white space but one space in front."""
    bare = piece.removeprefix(b" ")
    return bare.isalnum() or bare.decode().split() == [bare.decode()]


class Memory:
    """Ids of pieces in two generations: a piece that is used again goes into the recent one. When that is
    full it becomes the older one, so that only what has not been used for a while is forgotten."""

    def __init__(self, most: int):
        self.recent: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.most = most

    def missing(self, wanted: list[bytes]) -> list[bytes]:
        """Wanted pieces whose ids are not known; all others are in `recent` from here on."""
        if len(self.recent) > self.most:
            self.older, self.recent = self.recent, {}
        recent, older, new = self.recent, self.older, []
        for piece in wanted:
            if piece not in recent:
                if piece in older:
                    recent[piece] = older[piece]
                else:
                    new.append(piece)
        return new

    def forget_long(self, pieces: Iterable[bytes]) -> None:
        for piece in pieces:
            if len(piece) > LONGEST:
                self.recent.pop(piece, None)


class Encoder:
    """A byte-level BPE tokenizer that remembers the ids of pieces.

    Such a tokenizer first cuts a text and never merges across a cut. `piece_starts` finds most of its cuts
    from the bytes on either side, for a group of texts at once; the distinct pieces between them are
    encoded by the library, and the ids of all pieces are gathered by their numbers. Texts with a special
    token, and all texts of another tokenizer, are encoded as a whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.width = 2 if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4
        self.dtype = np.dtype(f"<u{self.width}")
        self.line_end = self._ids(["\n"])[0]
        self.pieces = Memory(REMEMBERED)
        self.by_pieces = _cuts_at_words(path)
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.special = [token.content.encode() for token in added if token.content]

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype=self.dtype) for e in found]

    def _learn(self, pieces: list[bytes]) -> None:
        """Pieces go through the tokenizer as lines of one text, those with white space inside one by one."""
        known = self.pieces.recent
        words = [p for p in pieces if _is_line(p)]
        for begin in range(0, len(words), AT_ONCE):
            part = words[begin : begin + AT_ONCE]
            ids = self._ids(["\n" + b"\n".join(part).decode()])[0]
            cuts = np.flatnonzero(ids == self.line_end[0])
            if len(self.line_end) == 1 and len(cuts) == len(part):
                ends = np.append(cuts[1:], len(ids))
                data, width = ids.tobytes(), self.width
                for word, a, b in zip(part, (cuts + 1).tolist(), ends.tolist(), strict=True):
                    known[word] = data[a * width : b * width]
        rest = [p for p in pieces if p not in known]
        for begin in range(0, len(rest), 100 * AT_ONCE):
            part = rest[begin : begin + 100 * AT_ONCE]
            known.update(zip(part, (i.tobytes() for i in self._ids([p.decode() for p in part])), strict=True))

    def _of_pieces(self, column: pa.LargeStringArray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and where each text's ids begin and end."""
        _, offsets, data = column.buffers()
        offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
        if offsets[-1] == offsets[0]:
            return np.zeros(0, self.dtype), np.zeros(n + 1, np.int64)
        data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
        offsets = offsets - offsets[0]
        starts = piece_starts(data, offsets[:-1])
        places = np.append(starts, len(data))
        pieces = pa.Array.from_buffers(
            pa.large_binary(), len(starts), [None, pa.py_buffer(places), pa.py_buffer(data)]
        ).dictionary_encode()
        wanted = pieces.dictionary.to_pylist()
        new = self.pieces.missing(wanted)
        self._learn(new)
        known = self.pieces.recent
        found = [known[piece] for piece in wanted]
        self.pieces.forget_long(new)
        ids = np.frombuffer(b"".join(found), self.dtype)
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // self.width
        begins = np.cumsum(sizes) - sizes
        codes = pieces.indices.to_numpy(zero_copy_only=False)
        lengths = sizes[codes]
        ends = np.cumsum(lengths)
        at = np.arange(ends[-1]) + np.repeat(begins[codes] - (ends - lengths), lengths)
        return ids[at], np.append(0, ends)[np.searchsorted(starts, offsets)]

    def encode(self, texts: pa.Array | list[str]) -> list[bytes]:
        """Ids of each text with the end id, as bytes; null counts as empty."""
        column = pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts.cast(pa.large_string())
        column = column.fill_null("")
        end = np.array([END_ID], dtype=self.dtype).tobytes()
        whole = self._whole(column)
        plain = column if not whole else column.take(pa.array(sorted(set(range(len(column))) - set(whole)), pa.int64()))
        ids, places = self._of_pieces(plain, len(plain))
        data, width = ids.tobytes(), self.width
        places = (places * width).tolist()
        out = [data[a:b] + end for a, b in zip(places, places[1:], strict=False)]
        for row in whole:  # in ascending order, so that each comes to its place
            out.insert(row, self._ids([column[row].as_py()])[0].tobytes() + end)
        return out

    def _whole(self, column: pa.Array) -> list[int]:
        """Rows that are encoded as a whole."""
        if not self.by_pieces:
            return list(range(len(column)))
        import pyarrow.compute as pc

        rows: set[int] = set()
        for token in self.special:
            has = pc.match_substring(column, token.decode())
            rows.update(np.flatnonzero(has.to_numpy(zero_copy_only=False)).tolist())
        return sorted(rows)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def _seeded(keys: np.ndarray, repeats: np.ndarray, level: int) -> np.ndarray:
    return mixed(mixed(keys.astype(U64) + U64(level * 0x9E3779B9 + 1)) + repeats.astype(U64))


class PerfectHash:
    """Slots 0..n-1 for n distinct (key, repeat) pairs; about 3 bits a key besides the slots."""

    LOAD = 1.7

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.ranks, base = [], 0
        for bits in levels:
            counts = np.bitwise_count(bits).astype(np.int64)
            self.ranks.append(base + np.concatenate(([0], np.cumsum(counts))))
            base = int(self.ranks[-1][-1])
        self.n = base

    @classmethod
    def build(cls, keys: np.ndarray, repeats: np.ndarray) -> PerfectHash:
        levels, left = [], np.arange(len(keys))
        while len(left):
            words = max(1, int(len(left) * cls.LOAD) // 64 + 1)
            at = _seeded(keys[left], repeats[left], len(levels)) % U64(words * 64)
            hits = np.bincount(at.astype(np.int64), minlength=words * 64)
            bits = np.packbits(hits == 1, bitorder="little").view("<u8").astype(U64)
            levels.append(bits)
            left = left[hits[at.astype(np.int64)] > 1]
        return cls(levels)

    def slots(self, keys: np.ndarray, repeats: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 for some that are not in the set."""
        found = np.full(len(keys), -1, dtype=np.int64)
        left = np.arange(len(keys))
        for level, bits in enumerate(self.levels):
            if not len(left):
                break
            at = _seeded(keys[left], repeats[left], level) % U64(len(bits) * 64)
            word, bit = (at >> U64(6)).astype(np.int64), at & U64(63)
            is_set = (bits[word] >> bit) & U64(1) == 1
            below = bits[word] & ((U64(1) << bit) - U64(1))
            slot = self.ranks[level][word] + np.bitwise_count(below)
            found[left[is_set]] = slot[is_set]
            left = left[~is_set]
        return found

    def to_bytes(self) -> bytes:
        sizes = np.array([len(self.levels), *map(len, self.levels)], dtype="<u4")
        return sizes.tobytes() + b"".join(x.astype("<u8").tobytes() for x in self.levels)

    @classmethod
    def from_bytes(cls, data: bytes) -> PerfectHash:
        n = int(np.frombuffer(data, "<u4", 1)[0])
        sizes = np.frombuffer(data, "<u4", n, 4)
        levels, at = [], 4 + 4 * n
        for size in sizes:
            levels.append(np.frombuffer(data, "<u8", int(size), at).astype(U64))
            at += 8 * int(size)
        return cls(levels)


def _fingerprints(keys: np.ndarray, repeats: np.ndarray) -> np.ndarray:
    return (_seeded(keys, repeats, 1 << 20) >> U64(32)).astype("<u4")


class ShardWriter:
    """Appends documents in order of key; `close` writes the index and the footer."""

    def __init__(self, out, width: int):
        self.out, self.width, self.written = out, width, 0
        self.keys: list[int] = []
        self.lengths: list[int] = []

    def add(self, key: int, ids: bytes) -> None:
        self.out.write(ids)
        self.written += len(ids)
        self.keys.append(key)
        self.lengths.append(len(ids) // self.width)

    def close(self) -> None:
        keys, lengths = np.array(self.keys, np.int64), np.array(self.lengths, np.int64)
        starts = np.cumsum(lengths) - lengths
        new = np.concatenate(([True], keys[1:] != keys[:-1]))[: len(keys)]
        begin = np.maximum.accumulate(np.where(new, np.arange(len(keys)), 0))
        repeats = (np.arange(len(keys)) - begin).astype("<u4")
        index = PerfectHash.build(keys, repeats)
        at = index.slots(keys, repeats)
        order = np.argsort(at)
        parts = [
            keys[order].astype("<i8").tobytes(),
            starts[order].astype("<u8").tobytes(),
            lengths[order].astype("<u8").tobytes(),
            repeats[order].tobytes(),
            _fingerprints(keys, repeats)[order].tobytes(),
        ]
        levels = index.to_bytes()
        pad = -self.written % 8
        self.out.write(b"\0" * pad + b"".join(parts) + levels)
        index_at = self.written + pad
        self.out.write(
            FOOTER.pack(
                MAGIC, self.width, len(keys), int(lengths.sum()), index_at,
                index_at + sum(map(len, parts)), len(levels),
            )
        )


class Shard:
    """Keyed access to a shard through `read(start, length)`."""

    def __init__(self, read):
        self.read = read
        magic, self.width, n, self.n_ids, index_at, levels_at, levels_size = FOOTER.unpack(
            read(read.size - FOOTER.size, FOOTER.size)
        )
        if magic != MAGIC:
            raise ValueError("not a token shard")
        index = read(index_at, levels_at - index_at)
        self.keys = np.frombuffer(index, "<i8", n)
        self.starts = np.frombuffer(index, "<u8", n, 8 * n)
        self.lengths = np.frombuffer(index, "<u8", n, 16 * n)
        self.repeats = np.frombuffer(index, "<u4", n, 24 * n)
        self.fingerprints = np.frombuffer(index, "<u4", n, 28 * n)
        self.hash = PerfectHash.from_bytes(read(levels_at, levels_size))

    def find(self, keys, repeats=None) -> np.ndarray:
        """Slots of keys, -1 where the shard has no such document."""
        keys = np.asarray(keys, dtype=np.int64)
        repeats = np.zeros(len(keys), "<u4") if repeats is None else np.asarray(repeats, "<u4")
        slots = self.hash.slots(keys, repeats)
        at = np.maximum(slots, 0)
        if not len(self.keys):
            return slots
        same = (self.fingerprints[at] == _fingerprints(keys, repeats)) & (self.keys[at] == keys)
        return np.where((slots >= 0) & same & (self.repeats[at] == repeats), slots, -1)

    def ids(self, slot: int) -> np.ndarray:
        """All ids of a slot's document as unsigned 32-bit integers."""
        data = self.read(int(self.starts[slot]) * self.width, int(self.lengths[slot]) * self.width)
        return np.frombuffer(data, f"<u{self.width}").astype("<u4")


def write_shards(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Write all of `docs`; returns (shard, path, n_docs, n_ids), shards in order of doc_id.

    Rows are dealt out by ranges of doc_id, so no shard needs to know another. A shard is a task's
    range; adaptive execution sets their size.
    """
    folder = shared_folder(docs.sparkSession, "tokens")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId()
        coder = encoder(tokenizer_path)
        first = next(batches, None)
        if first is None:
            return
        with new_file(folder, f"shard-{shard:06d}") as (path, out):
            writer = ShardWriter(out, coder.width)
            batch = first
            while batch is not None:
                for part in groups(batch, most=BYTES_AT_ONCE):
                    keys = part.column("id").to_pylist()
                    for key, ids in zip(keys, coder.encode(part.column("text")), strict=True):
                        writer.add(key, ids)
                batch = next(batches, None)
            writer.close()
        values = [shard, path, len(writer.keys), sum(writer.lengths)]
        kinds = [pa.int32(), pa.string(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([v], k) for v, k in zip(values, kinds, strict=True)],
            names=["shard", "path", "n_docs", "n_ids"],
        )

    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    ranged = docs.select(key.alias("id"), F.col("text").cast("string").alias("text"))
    ranged = ranged.repartitionByRange("id").sortWithinPartitions("id", "text")
    return settle(ranged.mapInArrow(write, MANIFEST), "token-shards")


def _read_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for number, path in zip(batch.column("shard").to_pylist(), batch.column("path").to_pylist(), strict=True):
            with ranges(path) as read:
                shard = Shard(read)
                order = np.argsort(shard.starts, kind="stable")
                keys, repeats = shard.keys[order], shard.repeats[order]
                for begin in range(0, len(keys), 5_000):
                    part = slice(begin, begin + 5_000)
                    slots = shard.find(keys[part], repeats[part])
                    sums = [zlib.crc32(shard.ids(s).tobytes()) for s in slots]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(slots), number, np.int32)),
                            pa.array(slots),
                            pa.array(shard.keys[slots]),
                            pa.array(shard.starts[slots].astype(np.int64)),
                            pa.array(shard.lengths[slots].astype(np.int64)),
                            pa.array(sums, pa.int64()),
                        ],
                        names=["shard", "slot", "doc_id", "first", "n_tokens", "ids_crc32"],
                    )


def read_shards(manifest: DataFrame) -> DataFrame:
    """Per document, through the index of its shard: doc_id, start, n_tokens, ids_crc32."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row per shard
    placed = manifest.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
    bases = settle(placed, "token-bases")
    # As many tasks as shards; their number is given, as a few paths would else be put into one task.
    paths = bases.select("shard", "path")
    found = paths.repartition(max(1, paths.count()), "shard").mapInArrow(_read_shards, READ)
    return found.join(bases.select("shard", "base"), "shard").select(
        F.when(F.col("doc_id") != NO_ID, F.col("doc_id")).alias("doc_id"),
        (F.col("base") + F.col("first")).alias("start"),
        "n_tokens",
        "ids_crc32",
        "shard",
        "slot",
    )


def token_report(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Write `docs` as shards and report on every document from the files."""
    return read_shards(write_shards(docs, tokenizer_path))
