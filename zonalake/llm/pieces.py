"""SentencePiece encoding and decoding of whole texts, for BPE models with byte fallback.

Such a model merges, time and again, the two neighbouring symbols whose union has the highest score,
the leftmost of equals. What a prefix of a text becomes is the start of what the text becomes if no
merge goes across its end, so every prefix has exactly one last token, and a row of tokens is an
encoding exactly when each token and each pair of neighbours is one by itself. The encoder therefore
fills a table of each prefix's last token: an automaton names the tokens that end at a position, and
the one of them is taken that is compatible with the last token of the prefix before it. The ids are
then recovered backwards from the end of the text. This takes linear time for any text.

Whether two tokens are compatible is told by their merges: each token's merges are known in order with
the symbol they leave at the token's edge; both sides are replayed in order of score, and the pair is
incompatible if the two edge symbols could at some time be merged before either side's next merge.

A text is first cut where no token of the vocabulary goes across: behind a run of letters, before the
space that precedes a word, and around characters that no longer token holds. Ids of such parts are
remembered by each worker, in two generations of REMEMBERED parts.

Other models (unigram, with normalisation or symbols of a user) are refused.

Cases: null and empty texts have no ids and decode to an empty text; characters that the vocabulary
lacks become bytes; U+2581 is the same as a space, as in the library; repeated ids and rows stay
separate; an empty table gives an empty result; other columns pass through, and those named `ids` or
`decoded` are replaced. A text is held whole, with up to 4 bytes a character for its table.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructType

from zonalake.llm.wordcodes import groups

SPACE = "▁"
#: Parts whose ids a worker remembers, in each of two generations, and the longest of them.
REMEMBERED = 150_000
LONGEST = 64

Steps = list[tuple[float, str]]  # score of a merge, and the edge symbol it leaves


def merges(text: str, score: dict[str, float]) -> tuple[list[str], Steps, Steps]:
    """The symbols a text ends up as, and for its left and its right edge the merges in order."""
    symbols, left, right = list(text), [], []
    while True:
        best = None
        for i in range(len(symbols) - 1):
            value = score.get(symbols[i] + symbols[i + 1])
            if value is not None and (best is None or value > best[0]):
                best = value, i
        if best is None:
            return symbols, left, right
        value, i = best
        symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]
        left.append((value, symbols[0]))
        right.append((value, symbols[-1]))


class Pieces:
    """Encoder and decoder of one model file."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        self._check()
        size = self.library.get_piece_size()
        special = (self.library.is_control, self.library.is_unknown, self.library.is_byte)
        normal = [i for i in range(size) if not any(test(i) for test in special)]
        names = {self.library.id_to_piece(i): i for i in normal}
        self.score = {name: self.library.get_score(i) for name, i in names.items()}
        first_byte = self.library.piece_to_id("<0x00>")
        self.byte_ids = np.arange(first_byte, first_byte + 256, dtype=np.int32)
        longer = [name for name in names if len(name) > 1]
        alphabet = set("".join(longer)) | {SPACE}
        self._set_tokens(names, alphabet)
        self.parts = self._parts(longer, alphabet)
        self.compatible: dict[int, bool] = {}
        self.recent: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _check(self) -> None:
        from sentencepiece import sentencepiece_model_pb2 as model_format

        model = model_format.ModelProto.FromString(self.library.serialized_model_proto())
        trained, normal = model.trainer_spec, model.normalizer_spec
        kinds = model_format.ModelProto.SentencePiece
        if (
            trained.model_type != model_format.TrainerSpec.BPE
            or not trained.byte_fallback
            or trained.treat_whitespace_as_suffix
            or normal.precompiled_charsmap
            or normal.remove_extra_whitespaces
            or not normal.escape_whitespaces
            or model.denormalizer_spec.precompiled_charsmap
            or any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in model.pieces)
        ):
            raise ValueError("only BPE models with byte fallback and without normalisation are supported")
        self.prefix = SPACE if normal.add_dummy_prefix else ""

    def _set_tokens(self, names: dict[str, int], alphabet: set[str]) -> None:
        """Tokens that the merges can produce; characters without an id of their own become bytes."""
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        self.sizes: list[int] = []
        self.edges: list[tuple[str, Steps, str, Steps]] = []
        self.ids: list[bytes] = []
        for name in [*names, *sorted(alphabet - names.keys())]:
            symbols, left, right = merges(name, self.score)
            if len(symbols) > 1:
                continue
            self.automaton.add_word(name, len(self.sizes))
            self.sizes.append(len(name))
            self.edges.append((name[0], left, name[-1], right))
            self.ids.append(self._ids_of(name, names))
        self.names = names
        self.automaton.make_automaton()

    def _ids_of(self, name: str, names: dict[str, int]) -> bytes:
        if name in names:
            return np.int32(names[name]).tobytes()
        return self.byte_ids[list(name.encode())].tobytes()

    def _parts(self, longer: list[str], alphabet: set[str]) -> re.Pattern:
        """Matches the parts of a text that are encoded by themselves."""
        letters = {c for c in alphabet if c.isalpha()}
        others = alphabet - letters - {SPACE}
        kind = dict.fromkeys(letters, 2) | dict.fromkeys(others, 1) | {SPACE: 0}
        one = lambda chars: "".join(map(re.escape, sorted(chars)))
        if any(kind[a] > kind[b] for name in longer for a, b in zip(name, name[1:], strict=False)):
            return re.compile(f"[{one(alphabet)}]+|[^{one(alphabet)}]")
        rest = f"[{one(others)}]" if others else "(?!)"
        word = f"[{one(letters)}]" if letters else "(?!)"
        return re.compile(f"{SPACE}*{rest}*{word}+|{SPACE}*{rest}+|{SPACE}+|[^{one(alphabet)}]")

    def _join(self, a: int, b: int) -> bool:
        """Whether token b may follow token a."""
        _, _, edge, left = self.edges[a]
        other, right, _, _ = self.edges[b]
        i = j = 0
        while True:
            mine = left[i][0] if i < len(left) else -np.inf
            theirs = right[j][0] if j < len(right) else -np.inf
            across = self.score.get(edge + other)
            if across is not None and across > mine and across >= theirs:
                return False
            if mine == theirs == -np.inf:
                return True
            if mine >= theirs:
                edge = left[i][1]
                i += 1
            else:
                other = right[j][1]
                j += 1

    def _encode_part(self, part: str) -> bytes:
        """Ids through the table of each prefix's last token."""
        n = len(part)
        last = np.full(n + 1, -1, np.int32) if n > 1_000 else [-1] * (n + 1)
        sizes, known, total = self.sizes, self.compatible, len(self.sizes)
        for end, token in self.automaton.iter(part):
            if last[end + 1] >= 0:
                continue
            begin = end + 1 - sizes[token]
            if begin:
                before = int(last[begin])
                pair = before * total + token
                fits = known.get(pair)
                if fits is None:
                    fits = known[pair] = self._join(before, token)
                if not fits:
                    continue
            last[end + 1] = token
        out, at = [], n
        while at:
            token = last[at]
            if token < 0:  # a character that no token holds
                return self._ids_of(part, self.names)
            out.append(self.ids[token])
            at -= sizes[token]
        if len(known) > 4 * REMEMBERED:
            known.clear()
        return b"".join(reversed(out))

    def _remember(self, wanted: set[str]) -> dict[str, bytes]:
        """Ids of all wanted parts."""
        if len(self.recent) > REMEMBERED:
            self.older, self.recent = self.recent, {}
        found, recent, older = {}, self.recent, self.older
        for part in wanted:
            ids = recent.get(part)
            if ids is None:
                ids = older.get(part) or self._encode_part(part)
                if len(part) <= LONGEST and len(recent) < 2 * REMEMBERED:
                    recent[part] = ids
            found[part] = ids
        return found

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as int32 bytes."""
        cut = [self.parts.findall(self.prefix + t.replace(" ", SPACE)) if t else [] for t in texts]
        ids = self._remember(set().union(*cut)).__getitem__
        return [b"".join(map(ids, parts)) for parts in cut]

    def decode(self, ids: bytes) -> str:
        return self.library.decode(np.frombuffer(ids, np.int32).tolist()) if ids else ""


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


def _id_lists(encoded: list[bytes]) -> pa.Array:
    ends = np.concatenate(([0], np.cumsum([len(ids) // 4 for ids in encoded]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(encoded), np.int32)))


def _plain(docs: DataFrame, *replaced: str) -> tuple[DataFrame, list[str], list[str]]:
    """`docs` without the columns to be replaced and under names that cannot clash."""
    rest = docs.drop(*replaced)
    names = [f"c{i}" for i in range(len(rest.columns))]
    return rest.toDF(*names), rest.columns, names


def encoded(docs: DataFrame, model_path: str, decode: bool = False) -> DataFrame:
    """`docs` with `ids`, those of the whole text, and with what they decode to if `decode`."""
    plain, columns, names = _plain(docs, "ids", *["decoded"] * decode)
    text = names[columns.index("text")]
    added = ["ids", *["decoded"] * decode]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(model_path)
        for batch in batches:
            for part in groups(batch, text):
                found = model.encode([t or "" for t in part.column(text).to_pylist()])
                new = [_id_lists(found)]
                if decode:
                    new.append(pa.array([model.decode(ids) for ids in found], pa.string()))
                yield pa.RecordBatch.from_arrays([*part.columns, *new], names=[*names, *added])

    schema = StructType([*plain.schema.fields]).add("ids", ArrayType(IntegerType()))
    if decode:
        schema = schema.add("decoded", "string")
    return plain.mapInArrow(encode, schema).toDF(*columns, *added)


def decoded(rows: DataFrame, model_path: str) -> DataFrame:
    """`rows` with `decoded`, the text of `ids`; null ids decode to an empty text."""
    plain, columns, names = _plain(rows, "decoded")
    at = columns.index("ids")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = pieces(model_path).library
        for batch in batches:
            texts = [library.decode(ids) if ids else "" for ids in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*names, "decoded"])

    schema = StructType([*plain.schema.fields]).add("decoded", "string")
    return plain.mapInArrow(decode, schema).toDF(*columns, "decoded")


def piece_report(docs: DataFrame, model_path: str) -> DataFrame:
    """Per document: number of ids, and digests of the ids and of the text they decode to."""
    rows = encoded(docs.select("doc_id", F.col("text").cast("string").alias("text")), model_path, decode=True)
    return rows.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
