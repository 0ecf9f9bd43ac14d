"""Packed token ids: best-fit-decreasing sequences as rows of a matrix.

Each task encodes its documents in blocks of bounded size, ends each document
with an end id, cuts what is longer than a sequence into pieces without loss,
and packs a block's pieces best fit decreasing. Nothing is shuffled; the
sequence numbers depend on the input's partitions only, so a repeated task gives
the same rows.

A row is one sequence: ``ids`` is a matrix row of little-endian unsigned 16-bit
ids (32-bit for larger vocabularies), filled up with the pad id; ``cu_seqlens``
the cumulative lengths of its pieces, from 0; ``position_resets`` where positions
start again at 0; ``doc_ids``, ``pieces`` and ``starts`` say what the pieces are.

``pack`` gives these rows as a table. ``write`` puts them into binary files: each block's
matrix, the cumulative lengths of all its rows in a row, and the position resets, under
names that no other attempt of a task has. The returned manifest names the files of the
attempts that counted, with their shapes and checksums; other files in the folder are
leftovers. The folder is reached through Arrow's file systems, from all executors.

Defined results: a null or empty text is an end id alone; a null id stays null
in ``doc_ids``; repeated rows are packed each for itself; an empty table gives no
rows. Other columns are not read.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import pyarrow.fs
from pyspark.sql import DataFrame, functions as F

from clickstrata.llm.best_fit import best_fit_decreasing, pieces
from clickstrata.llm.tokens import WordIds, slices

SEQUENCE = 4096
END_ID = 49407
PAD_ID = 0
# Tokens packed together: about a thousand sequences, so few are left part empty.
BLOCK_TOKENS = 4_000_000

SCHEMA = (
    "sequence_id long, n_tokens int, ids binary, cu_seqlens array<int>, "
    "position_resets array<int>, doc_ids array<long>, pieces array<int>, starts array<long>"
)
_ARROW = pa.schema(
    [
        ("sequence_id", pa.int64()),
        ("n_tokens", pa.int32()),
        ("ids", pa.binary()),
        ("cu_seqlens", pa.list_(pa.int32())),
        ("position_resets", pa.list_(pa.int32())),
        ("doc_ids", pa.list_(pa.int64())),
        ("pieces", pa.list_(pa.int32())),
        ("starts", pa.list_(pa.int64())),
    ]
)


def packed_block(block: list[tuple], first: int, capacity: int, kind: str) -> list[dict]:
    """Rows for the (doc_id, piece, start, ids) pieces of a block."""
    lengths = [len(ids) // 4 for _, _, _, ids in block]
    rows = []
    for at, items in enumerate(best_fit_decreasing(lengths, capacity)):
        ends = np.cumsum([lengths[i] for i in items])
        ids = np.full(capacity, PAD_ID, dtype=kind)
        ids[: ends[-1]] = np.frombuffer(b"".join(block[i][3] for i in items), dtype="<u4")
        cumulative = [0, *ends.tolist()]
        rows.append(
            {
                "sequence_id": first + at,
                "n_tokens": int(ends[-1]),
                "ids": ids.tobytes(),
                "cu_seqlens": cumulative,
                "position_resets": cumulative[:-1],
                "doc_ids": [block[i][0] for i in items],
                "pieces": [block[i][1] for i in items],
                "starts": [block[i][2] for i in items],
            }
        )
    return rows


def pack(
    docs: DataFrame,
    capacity: int = SEQUENCE,
    tokenizer: str | None = None,
    end_id: int = END_ID,
    block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """Sequences of at most ``capacity`` ids that hold all documents."""
    end = np.asarray([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = WordIds(tokenizer)
        small = max(coder.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16
        kind = "<u2" if small else "<u4"
        block: list[tuple] = []
        size = 0
        following = None

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal following
            rows = packed_block(block, following, capacity, kind)
            following += len(rows)
            for at in range(0, len(rows), 256):
                yield pa.RecordBatch.from_pylist(rows[at : at + 256], schema=_ARROW)

        for batch in batches:
            if following is None and batch.num_rows:
                following = batch.column("partition")[0].as_py() << 40
            ids_of = batch.column("doc_id").to_pylist()
            for first, texts in slices(batch):
                for doc_id, ids in zip(ids_of[first:], coder.encode(texts)):
                    ids += end
                    for piece, (start, length) in enumerate(pieces(len(ids) // 4, capacity)):
                        block.append((doc_id, piece, start, ids[4 * start : 4 * (start + length)]))
                        size += length
                        if size >= block_tokens:
                            yield from flush()
                            block, size = [], 0
        if block:
            yield from flush()

    source = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.spark_partition_id().cast("long").alias("partition"),
    )
    return source.mapInArrow(run, SCHEMA)


MANIFEST = (
    "file string, rows long, capacity int, id_bytes int, n_tokens long, pieces long, "
    "first_sequence long, ids_crc32 long, cu_seqlens_crc32 long, position_resets_crc32 long"
)
# The three files of a block, by their endings.
IDS, LENGTHS, RESETS = ".ids.bin", ".cu_seqlens.bin", ".position_resets.bin"


def write(packed: DataFrame, folder: str, capacity: int = SEQUENCE) -> DataFrame:
    """Write the rows of ``pack`` to files in a folder that all executors share.

    Returns the manifest, a stored table in ``folder/manifest``: a row for each group of
    three files. Ids are as in ``pack``; lengths and resets are little-endian unsigned
    32-bit numbers, each row's after the other's, a row with k pieces having k + 1 and k.
    """
    spark = packed.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = None, ""
        for batch in batches:
            if not batch.num_rows:
                continue
            if files is None:
                files, root = pa.fs.FileSystem.from_uri(folder)
                files.create_dir(root, recursive=True)
            name = uuid.uuid4().hex
            width = len(batch["ids"][0].as_buffer())
            contents = {
                IDS: b"".join(value.as_buffer().to_pybytes() for value in batch["ids"]),
                LENGTHS: batch["cu_seqlens"].flatten().to_numpy().astype("<u4").tobytes(),
                RESETS: batch["position_resets"].flatten().to_numpy().astype("<u4").tobytes(),
            }
            for ending, content in contents.items():
                with files.open_output_stream(f"{root}/{name}{ending}") as out:
                    out.write(content)
            row = [
                name,
                batch.num_rows,
                capacity,
                width // capacity,
                pa.compute.sum(batch["n_tokens"]).as_py(),
                len(contents[RESETS]) // 4,
                batch["sequence_id"][0].as_py(),
                *(zlib.crc32(content) for content in contents.values()),
            ]
            types = [pa.string(), pa.int64(), pa.int32(), pa.int32(), *[pa.int64()] * 6]
            columns = [pa.array([value], kind) for value, kind in zip(row, types)]
            yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in MANIFEST.split(", ")])

    manifest = packed.mapInArrow(run, MANIFEST)
    manifest.write.parquet(f"{folder}/manifest")
    return spark.read.parquet(f"{folder}/manifest")


def read_block(folder: str, entry) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, cumulative lengths, resets) of each row of a manifest's entry, checked."""
    files, root = pa.fs.FileSystem.from_uri(folder)
    parts = []
    for ending, kind, crc in (
        (IDS, f"<u{entry['id_bytes']}", entry["ids_crc32"]),
        (LENGTHS, "<u4", entry["cu_seqlens_crc32"]),
        (RESETS, "<u4", entry["position_resets_crc32"]),
    ):
        with files.open_input_file(f"{root}/{entry['file']}{ending}") as held:
            content = held.read()
        if zlib.crc32(content) != crc:
            raise ValueError(f"{entry['file']}{ending} is not what was written")
        parts.append(np.frombuffer(content, dtype=kind))
    matrix = parts[0].reshape(entry["rows"], entry["capacity"])
    starts = np.flatnonzero(parts[2] == 0)
    ends = np.append(starts[1:], len(parts[2]))
    return [
        (matrix[at], parts[1][a + at : b + at + 1], parts[2][a:b])
        for at, (a, b) in enumerate(zip(starts, ends))
    ]


def unpacked(sequence) -> list[tuple[int | None, int, np.ndarray]]:
    """(doc_id, start, ids) of the pieces in a row of ``pack``."""
    kind = "<u2" if len(sequence["ids"]) == 2 * SEQUENCE else "<u4"
    ids = np.frombuffer(sequence["ids"], dtype=kind)
    bounds = sequence["cu_seqlens"]
    return [
        (doc_id, start, ids[a:b])
        for doc_id, start, a, b in zip(
            sequence["doc_ids"], sequence["starts"], bounds, bounds[1:]
        )
    ]
