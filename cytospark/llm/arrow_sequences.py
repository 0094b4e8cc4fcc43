"""Token ids as Arrow stream-file shards of equal-length sequences.

A shard is an Arrow IPC file (uncompressed, so it can be memory-mapped) whose batches
hold two fixed-size-list columns: ``ids`` (unsigned integers just wide enough for the
vocabulary) and ``mask`` (true for a real token, false for padding). Sequence k of a
shard is found by arithmetic alone, without reading others (``SequenceFile``). Beside it lies an index file
with each document's id, start in the shard and number of tokens. Shards follow one
another in ascending document id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, Window as W, functions as F

from .blocks import ordered_blocks
from ..scratch import materialise
from .textkit import batches_of_bytes, text_bytes, trim
from .tokenise import encoder

BLOCK_BYTES = 8 << 20
BATCH_ROWS = 256

SHARDS = "shard int, path string, documents long, tokens long"
ROWS = "doc_id long, start long, n_tokens long, ids binary"


def sequence_schema(length: int, largest_id: int) -> pa.Schema:
    kind = pa.uint16() if largest_id < 1 << 16 else pa.uint32()
    return pa.schema([("ids", pa.list_(kind, length)), ("mask", pa.list_(pa.bool_(), length))])


def _write(fs: pafs.FileSystem, path: str, schema: pa.Schema, batches: Iterator[pa.RecordBatch]) -> None:
    """One Arrow file under its final name only when whole, so a lost task leaves nothing behind."""
    import os

    part = f"{path}.{os.getpid()}.part"
    with fs.open_output_stream(part) as out, pa.ipc.new_file(out, schema) as writer:
        for batch in batches:
            writer.write_batch(batch)
    fs.move(part, path)


def _sequences(ids: np.ndarray, length: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    kind = schema.field("ids").type.value_type.to_pandas_dtype()
    for at in range(0, len(ids), length * BATCH_ROWS):
        part = ids[at : at + length * BATCH_ROWS]
        rows = -(-len(part) // length)
        flat, mask = np.zeros(rows * length, kind), np.zeros(rows * length, bool)
        flat[: len(part)], mask[: len(part)] = part, True
        yield pa.RecordBatch.from_arrays([pa.FixedSizeListArray.from_arrays(pa.array(flat), length), pa.FixedSizeListArray.from_arrays(pa.array(mask), length)], schema=schema)


def write_sequences(docs: DataFrame, out_dir: str, tokenizer: str, end_id: int = 0, length: int = 2048, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Tokenise whole texts and write the shards; returns one row per shard.

    ``out_dir`` is a URI that every executor can write to. Each document's ids are
    followed by ``end_id``. Null and empty texts consist of that id alone. Rows that share
    an id are separate documents, ordered by a hash of the text; null ids come first. Other columns
    are ignored; an empty table writes no shard.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    blocked, _ = ordered_blocks(docs, "doc_id", "text", block_bytes)

    def shard(table: pa.Table) -> pa.Table:
        trim()
        table = table.take(pc.sort_indices(table, sort_keys=[("doc_id", "ascending"), ("place", "ascending"), ("text", "ascending")], null_placement="at_start"))
        number = table["block"][0].as_py()
        bpe = encoder(tokenizer)
        data, offsets = text_bytes(table["text"])
        ids, ends = bpe.encode(data, offsets)
        ids = np.insert(ids, ends, end_id)
        ends = ends + np.arange(1, len(ends) + 1)
        starts = np.r_[0, ends[:-1]]
        fs, root = pafs.FileSystem.from_uri(out_dir)
        fs.create_dir(root, recursive=True)
        schema = sequence_schema(length, max(end_id, len(bpe.width) - 3))
        _write(fs, f"{root}/shard-{number:08d}.arrow", schema, _sequences(ids, length, schema))
        index = pa.RecordBatch.from_pydict({"doc_id": pa.concat_arrays(table["doc_id"].chunks), "start": pa.array(starts, pa.int64()), "n_tokens": pa.array(ends - starts, pa.int64())})
        _write(fs, f"{root}/shard-{number:08d}.index.arrow", index.schema, iter([index]))
        return pa.table({"shard": pa.array([number], pa.int32()), "path": [f"{root}/shard-{number:08d}"], "documents": pa.array([len(ends)], pa.int64()), "tokens": pa.array([len(ids)], pa.int64())})

    return materialise(blocked.groupBy("block").applyInArrow(shard, SHARDS), "shards")


def with_starts(shards: DataFrame, wide: int = 1024) -> DataFrame:
    """Add ``before``: the tokens of all shards before each one; sums go up in groups of ``wide``."""
    groups = shards.withColumn("grp", F.floor(F.col("shard") / wide))
    tops = groups.groupBy("grp").agg(F.sum("tokens").alias("t"))
    tops = tops.select("grp", (F.sum("t").over(W.orderBy("grp")) - F.col("t")).alias("base"))
    own = F.sum("tokens").over(W.partitionBy("grp").orderBy("shard")) - F.col("tokens")
    return groups.withColumn("own", own).join(tops, "grp").withColumn("before", F.col("base") + F.col("own")).drop("grp", "own", "base")


class SequenceFile:
    """Random access to the sequences of one shard.

    A file on this machine is memory-mapped, so ``sequence(k)`` touches the pages of that
    sequence alone and copies nothing; elsewhere one batch is read.
    """

    def __init__(self, path: str, fs: pafs.FileSystem | None = None):
        self._source = pa.memory_map(path) if fs is None or isinstance(fs, pafs.LocalFileSystem) else fs.open_input_file(path)
        self._file = pa.ipc.open_file(self._source)
        self.length = self._file.schema.field("ids").type.list_size

    def __enter__(self) -> SequenceFile:
        return self

    def __exit__(self, *_) -> None:
        self._source.close()

    def __len__(self) -> int:
        n = self._file.num_record_batches
        return (n - 1) * BATCH_ROWS + self._file.get_batch(n - 1).num_rows if n else 0

    def sequence(self, k: int) -> tuple[np.ndarray, pa.Array]:
        """Ids (a view of the file) and mask of sequence ``k``."""
        if k < 0:
            raise IndexError(k)
        batch, row = self._file.get_batch(k // BATCH_ROWS), k % BATCH_ROWS
        at = slice(row * self.length, (row + 1) * self.length)
        ids, mask = (batch.column(c).values for c in ("ids", "mask"))
        if at.start >= len(ids):
            raise IndexError(k)
        return ids[at].to_numpy(), mask[at]

    def tokens(self, start: int, stop: int) -> np.ndarray:
        """Tokens from ``start`` to ``stop`` of the shard; only the batches that hold them are read."""
        size = self.length * BATCH_ROWS
        parts = [np.zeros(0, np.uint16)]
        for k in range(start // size, -(-stop // size)):
            flat = self._file.get_batch(k).column("ids").values.to_numpy()
            parts.append(flat[max(0, start - k * size) : stop - k * size])
        return np.concatenate(parts)


def read_documents(shards: DataFrame, out_dir: str, most_tasks: int = 20_000) -> DataFrame:
    """Each document's ids (little-endian unsigned 32-bit) and start, cut from the shard files again.

    Shards are read in as many tasks as there are, up to ``most_tasks``, some batches at a time.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = pafs.FileSystem.from_uri(out_dir)
        for batch in batches:
            for before, path in zip(batch.column("before").to_pylist(), batch.column("path").to_pylist()):
                with fs.open_input_file(f"{path}.index.arrow") as f:
                    index = pa.ipc.open_file(f).read_all().combine_chunks()
                start, n = index["start"].to_numpy(), index["n_tokens"].to_numpy()
                ids = pa.concat_arrays(index["doc_id"].chunks)
                with SequenceFile(f"{path}.arrow", fs) as file:
                    for i, j in batches_of_bytes(np.r_[0, np.cumsum(n)], 1 << 20):
                        own = file.tokens(int(start[i]), int(start[j - 1] + n[j - 1])).astype("<u4")
                        at = start[i:j] - start[i]
                        parts = [own[s : s + k].tobytes() for s, k in zip(at.tolist(), n[i:j].tolist())]
                        yield pa.RecordBatch.from_pydict({"doc_id": ids.slice(i, j - i), "start": pa.array(start[i:j] + before), "n_tokens": pa.array(n[i:j]), "ids": pa.array(parts, pa.binary())})

    tasks = max(1, min(most_tasks, shards.count()))
    return with_starts(shards).select("before", "path").repartition(tasks, "path").mapInArrow(read, ROWS)
