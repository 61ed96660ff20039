"""Exact SentencePiece encoding and decoding of merge-type models by backtracking.

The encoding of a text is the one sequence of pieces in which every two neighbours are compatible:
merging their joined characters again, best score first, gives back these two. An Aho-Corasick
automaton finds the pieces that begin at each position. The longest is tried first; where no piece
fits behind the last one, the position is marked in a bitfield of failed positions and the last
piece is replaced by a shorter one. As the encoding of what lies before a position is unique, a
failed position never needs a second look, and the work is linear.

No piece has a word mark behind another character, so a text is encoded word by word, and each
worker remembers a bounded number of encoded words.
"""

import re
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2 as model_proto

from .arrow import row_of, slices

MARK = "▁"
WORDS = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
REMEMBERED = 250_000


class PieceModel:
    """A merge-type model, read from its file; encodes and decodes like the library."""

    def __init__(self, path: str):
        proto = model_proto.ModelProto()
        with open(path, "rb") as file:
            proto.ParseFromString(file.read())
        spec, norm = proto.trainer_spec, proto.normalizer_spec
        if (
            spec.model_type != model_proto.TrainerSpec.BPE
            or not spec.byte_fallback
            or spec.treat_whitespace_as_suffix
            or norm.precompiled_charsmap
            or norm.remove_extra_whitespaces
            or not norm.add_dummy_prefix
            or not norm.escape_whitespaces
        ):
            raise ValueError("a merge-type model with byte fallback and plain normalising is needed")
        library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.end_id = library.eos_id()
        kinds = model_proto.ModelProto.SentencePiece
        self.pieces: list[str] = [p.piece for p in proto.pieces]
        self.kinds = [p.type for p in proto.pieces]
        if kinds.USER_DEFINED in self.kinds or kinds.UNUSED in self.kinds:
            raise ValueError("user-defined and unused pieces are not supported")
        self.ids = {p: i for i, p in enumerate(self.pieces) if self.kinds[i] == kinds.NORMAL}
        self.scores = {p: proto.pieces[i].score for p, i in self.ids.items()}
        self.lengths = [len(p) for p in self.pieces]
        self.bytes = {int(p[3:5], 16): i for i, p in enumerate(self.pieces)
                      if self.kinds[i] == kinds.BYTE}
        self.of_byte = {i: b for b, i in self.bytes.items()}
        self.is_byte = np.array([k == kinds.BYTE for k in self.kinds])
        # Decoded text of each id; control pieces have none.
        self.texts = [
            p.replace(MARK, " ") if k == kinds.NORMAL else " ⁇ " if k == kinds.UNKNOWN else ""
            for p, k in zip(self.pieces, self.kinds)
        ]
        self.by_word = not any(re.search(f"[^{MARK}]{MARK}", p) for p in self.ids)
        self.whole_alphabet = all(c in self.ids for c in set("".join(self.ids)))
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            self.automaton.add_word(piece, i)
        self.automaton.make_automaton()
        self.extra: dict[str, int] = {}  # characters without a piece of their own get ids above
        self.compatible: dict[int, bool] = {}
        # Words of late, and those before them: a word in use survives when the older go.
        self.words: dict[str, bytes] = {}
        self.older_words: dict[str, bytes] = {}

    def merged(self, text: str) -> list[str]:
        """Merge the characters of a short text: best score first, then leftmost."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, 0
            for k in range(len(parts) - 1):
                score = self.scores.get(parts[k] + parts[k + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, k
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def fits(self, last: int, piece: int) -> bool:
        """Whether the piece may follow the last one (-1: none)."""
        key = (last << 32) + piece
        known = self.compatible.get(key)
        if known is None:
            pair = [self.pieces[i] for i in (last, piece) if i >= 0]
            if len(self.compatible) > 400_000:
                self.compatible.clear()
            known = self.compatible[key] = self.merged("".join(pair)) == pair
        return known

    def single(self, character: str) -> int:
        """The id of a character without a piece; it is spelt out in bytes later."""
        i = self.extra.get(character)
        if i is None:
            i = self.extra[character] = len(self.pieces)
            self.pieces.append(character)
            self.lengths.append(1)
        return i

    def backtrack(self, text: str) -> list[int]:
        """The ids of a text whose blanks are marks; no prefix is added."""
        n, lengths, fits, compatible = len(text), self.lengths, self.fits, self.compatible
        starts: list[list[int]] = [[] for _ in range(n)]
        for end, piece in self.automaton.iter(text):
            starts[end - lengths[piece] + 1].append(piece)  # the longest comes last
        if not self.whole_alphabet or not all(starts):
            for k in range(n):
                if not starts[k] or lengths[starts[k][0]] > 1:
                    starts[k].insert(0, self.single(text[k]))
        failed = bytearray(n + 1)
        chosen: list[tuple[int, int]] = []  # place in starts, and piece
        at, last, k = 0, -1, len(starts[0]) - 1
        while at < n:
            choice = starts[at]
            while k >= 0:
                piece = choice[k]
                end = at + lengths[piece]
                if not failed[end]:
                    fit = compatible.get((last << 32) + piece)
                    if fit or fit is None and fits(last, piece):
                        break
                k -= 1
            if k >= 0:
                chosen.append((k, piece))
                at, last = end, piece
                k = len(starts[at]) - 1 if at < n else 0
            else:
                failed[at] = 1
                k, piece = chosen.pop()
                at -= lengths[piece]
                last = chosen[-1][1] if chosen else -1
                k -= 1
        vocabulary = len(self.kinds)
        found = [piece for _, piece in chosen]
        if max(found) >= vocabulary:
            found = [
                i
                for piece in found
                for i in (
                    [piece]
                    if piece < vocabulary
                    else [self.bytes[b] for b in self.pieces[piece].encode()]
                )
            ]
        return found

    def remembered(self, word: str) -> bytes:
        ids = self.older_words.get(word)
        if ids is None:
            ids = array("i", self.backtrack(word)).tobytes()
        if len(self.words) >= REMEMBERED:
            self.older_words, self.words = self.words, {}
        self.words[word] = ids
        return ids

    def encode(self, text: str) -> np.ndarray:
        """The ids of a text, with the end id behind them."""
        end = array("i", [self.end_id]).tobytes()
        if not text:
            return np.frombuffer(end, dtype="i4")
        text = MARK + text.replace(" ", MARK)
        words = WORDS.findall(text) if self.by_word else [text]
        known, slow = self.words.get, self.remembered
        found = [known(w) or slow(w) for w in words]
        found.append(end)
        return np.frombuffer(b"".join(found), dtype="i4")

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: without the mark that encoding puts in front, bytes as characters."""
        if not self.is_byte[ids].any():
            text = "".join(map(self.texts.__getitem__, ids.tolist()))
        else:
            parts, spelt = [], bytearray()
            for i in ids.tolist():
                if i in self.of_byte:
                    spelt.append(self.of_byte[i])
                    continue
                if spelt:
                    parts.append(spelt.decode(errors="replace"))
                    spelt = bytearray()
                parts.append(self.texts[i])
            parts.append(spelt.decode(errors="replace"))
            text = "".join(parts)
        return text[1:] if text.startswith(" ") else text


_models: dict[str, PieceModel] = {}


def piece_model(path: str) -> PieceModel:
    """The model of a file, read once per process."""
    if path not in _models:
        _models[path] = PieceModel(path)
    return _models[path]


def encode_pieces(
    docs: DataFrame, model_path: str, text: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """Every row of ``docs`` as ``row``, with ``ids`` (end id included) and ``decoded`` text.

    ``row`` is a struct of the columns to ``keep``, all unless given, so no name can clash. NULL texts count as
    empty: their only id is the end id, their decoded text is empty. Words are encoded once per
    worker as long as they are remembered; very long texts only need memory for their own ids.
    ``model_path`` must exist on every executor.
    """
    rows = docs.select(
        row_of(docs, keep),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(model_path)
        for batch in slices(batches):
            encoded = [model.encode(t) for t in batch.column(1).to_pylist()]
            ends = np.cumsum([0, *map(len, encoded)])
            ids = pa.ListArray.from_arrays(
                pa.array(ends, pa.int32()), pa.array(np.concatenate(encoded or [[]]), pa.int32())
            )
            decoded = pa.array(map(model.decode, encoded), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), ids, decoded], ["row", "ids", "decoded"])

    schema = f"row {rows.schema['row'].dataType.simpleString()}, ids array<int>, decoded string"
    return rows.mapInArrow(encode, schema)
