"""Token ids in flat binary files, with 64-bit document offsets.

Every partition of the documents, in order of their identifiers, becomes three files:

- ``part-N.tokens``: the ids of its documents one after the other, as little-endian unsigned
  integers of the smallest width that holds the vocabulary;
- ``part-N.offsets``: little-endian unsigned 64-bit integers, one more than documents: where each
  begins among the ids of the file, and the end;
- ``part-N.docs``: little-endian signed 64-bit identifiers.

``manifest.json`` lists the parts with the prefix sums of their ids and documents, so an id has a
place in the whole collection. Files are written under a name of the attempt and then renamed, so
an executor can be lost at any time. The folder may be in any store that pyarrow opens; in a
local or mounted one the ids are memory-mapped.
"""

import json
import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .arrow import slices

REMEMBERED = 400_000
# White space as the pre-tokenizer's pattern takes it.
WHITE = "\t-\r \x85\xa0  -     　"
LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
SIGNS = r"!-&(-/:-@\[-`{-~"  # of ASCII, without the apostrophe
# Pieces whose ends no token of the vocabulary's pattern reaches over: letters before a sign or
# white space; signs before a letter or white space; else all up to white space, each with the
# blank before it; a run of white space without its last character; and that last character.
CHUNKS = re.compile(
    f" ?[{LETTERS}]++(?![^{WHITE}{SIGNS}])| ?[{SIGNS}]++(?![^{WHITE}{LETTERS}])"
    f"| ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]"
)


class ByteTokens:
    """The library's tokenizer with a bounded memory of encoded chunks."""

    def __init__(self, path: str, end_id: int):
        self.tokenizer = Tokenizer.from_file(path)
        with open(path) as file:
            described = json.load(file)
        before = described["pre_tokenizer"] or {}
        self.by_chunk = (
            described["normalizer"] is None
            and before.get("type") == "ByteLevel"
            and before.get("use_regex")
            and not before.get("add_prefix_space")
        )
        self.added = [t["content"] for t in described["added_tokens"]]
        most = max(self.tokenizer.get_vocab_size() - 1, end_id)
        self.dtype = np.dtype("u2" if most < 1 << 16 else "u4")
        self.end = np.array([end_id], self.dtype).tobytes()
        # Chunks of late, and those before them: a chunk in use survives when the older go.
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def ids(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch(texts, add_special_tokens=False)
        return [array(self.dtype.char, x.ids).tobytes() for x in found]

    def encode(self, text: str) -> bytes:
        """Ids of the whole text and the end id, as bytes of the file format."""
        if not self.by_chunk or any(t in text for t in self.added):
            return self.ids([text])[0] + self.end
        chunks = CHUNKS.findall(text)
        missing = set(chunks).difference(self.known)
        if missing:
            self.learn(missing, chunks)
        return b"".join(map(self.known.__getitem__, chunks)) + self.end

    def learn(self, missing: set[str], chunks: list[str]) -> None:
        if len(self.known) + len(missing) > REMEMBERED:
            self.older, self.known = self.known, {}
            missing = set(chunks)
        new = [c for c in missing if c not in self.older]
        self.known.update((c, self.older[c]) for c in missing if c in self.older)
        self.known.update(zip(new, self.ids(new)))


_tokenizers: dict[tuple[str, int], ByteTokens] = {}


def byte_tokens(path: str, end_id: int) -> ByteTokens:
    # Spark runs as many workers as there are cores; threads of their own would compete.
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    if (path, end_id) not in _tokenizers:
        _tokenizers[path, end_id] = ByteTokens(path, end_id)
    return _tokenizers[path, end_id]


PARTS = "part int, docs long, no_ids long, tokens long, dtype string"


def write_token_files(
    docs: DataFrame,
    folder: str,
    tokenizer_path: str,
    end_id: int,
    text: str = "text",
    id: str = "doc_id",
) -> list[dict]:
    """Write the documents' ids in ascending order of the identifier; returns the manifest.

    NULL texts count as empty and have the end id only. NULL identifiers come first; they are
    stored as 0 and counted in the manifest (``no_ids``). Repeated identifiers lie next to each
    other. An empty table gives a manifest without parts. Other columns are not read. The driver
    holds one row per part. ``tokenizer_path`` must exist on every executor.
    """
    rows = docs.select(
        F.col(f"`{id}`").cast("long").alias("id"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    )
    ordered = rows.repartitionByRange("id").sortWithinPartitions("id")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = byte_tokens(tokenizer_path, end_id)
        context = TaskContext.get()
        files, root = pyarrow.fs.FileSystem.from_uri(folder)
        files.create_dir(root)
        part, attempt = context.partitionId(), context.taskAttemptId()
        temporary = f"{root}/attempt-{attempt}.tokens"
        ids, offsets, no_ids, tokens = [], [np.zeros(1, "<u8")], 0, 0
        with files.open_output_stream(temporary) as out:
            for batch in slices(batches):
                encoded = [model.encode(t) for t in batch.column(1).to_pylist()]
                for piece in encoded:
                    out.write(piece)
                lengths = np.array([len(e) for e in encoded], "<u8") // model.dtype.itemsize
                offsets.append((tokens + np.cumsum(lengths)).astype("<u8"))
                tokens += int(lengths.sum())
                no_ids += batch.column(0).null_count
                ids.append(np.asarray(batch.column(0).fill_null(0), "<i8"))
        docs_here = sum(map(len, ids))
        if not docs_here:
            files.delete_file(temporary)
            return
        name = f"{root}/part-{part:06d}"
        for kind, parts in (("offsets", offsets), ("docs", ids)):
            with files.open_output_stream(f"{temporary}.{kind}") as out:
                out.write(np.concatenate(parts).tobytes())
            files.move(f"{temporary}.{kind}", f"{name}.{kind}")
        files.move(temporary, f"{name}.tokens")
        yield pa.RecordBatch.from_pydict(
            {
                "part": pa.array([part], pa.int32()),
                "docs": [docs_here],
                "no_ids": [no_ids],
                "tokens": [tokens],
                "dtype": [model.dtype.str],
            }
        )

    manifest, first_token, first_doc = [], 0, 0
    for row in sorted(ordered.mapInArrow(write, PARTS).collect()):
        manifest.append(row.asDict() | {"first_token": first_token, "first_doc": first_doc})
        first_token += row.tokens
        first_doc += row.docs
    files, root = pyarrow.fs.FileSystem.from_uri(folder)
    files.create_dir(root)
    with files.open_output_stream(f"{root}/manifest.json") as out:
        out.write(json.dumps(manifest).encode())
    return manifest


def read_token_files(spark: SparkSession, folder: str, batch_tokens: int = 1 << 20) -> DataFrame:
    """One row per document: ``doc_id``, ``start`` (ids before it), ``n_tokens``, ``ids``.

    ``ids`` are little-endian unsigned 32-bit integers in binary. Parts are read in parallel.
    """
    files, root = pyarrow.fs.FileSystem.from_uri(folder)
    with files.open_input_file(f"{root}/manifest.json") as file:
        manifest = json.loads(file.read())
    schema = f"{PARTS}, first_token long, first_doc long"
    names = [c.split()[0] for c in schema.split(", ")]
    parts = spark.createDataFrame([[p[n] for n in names] for p in manifest], schema)

    def opened(files, path, dtype):
        if isinstance(files, pyarrow.fs.LocalFileSystem):
            return np.memmap(path, dtype, "r")
        with files.open_input_file(path) as file:
            return np.frombuffer(file.read(), dtype)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = pyarrow.fs.FileSystem.from_uri(folder)
        for part in (p for batch in batches for p in batch.to_pylist()):
            name = f"{root}/part-{part['part']:06d}"
            offsets = opened(files, f"{name}.offsets", "<u8").astype(np.int64)
            ids = opened(files, f"{name}.docs", "<i8")
            tokens = opened(files, f"{name}.tokens", part["dtype"])
            at = 0
            while at < len(ids):
                upto = int(np.searchsorted(offsets, offsets[at] + batch_tokens, "right")) - 1
                upto = min(max(upto, at + 1), len(ids))
                here = np.asarray(tokens[offsets[at] : offsets[upto]]).astype("<u4").tobytes()
                bounds = 4 * (offsets[at : upto + 1] - offsets[at])
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": pa.array(
                            ids[at:upto], pa.int64(), mask=np.arange(at, upto) < part["no_ids"]
                        ),
                        "start": part["first_token"] + offsets[at:upto],
                        "n_tokens": np.diff(offsets[at : upto + 1]),
                        "ids": pa.array(
                            [here[a:b] for a, b in zip(bounds, bounds[1:])], pa.binary()
                        ),
                    }
                )
                at = upto

    spread = parts.repartition(max(1, len(manifest)))
    return spread.mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary")
