"""Token ids as Arrow streams of equal-length sequences with masks.

Documents are range-partitioned by id, every task encodes its range and writes two files:

- ``part-00000.arrow``: an Arrow stream whose batches hold ``input_ids`` and ``mask`` as fixed-size lists. Sequences are
  cut from the unbroken run of ids; only the last one of a file is padded (mask false). All batches but the
  last hold ``BATCH`` sequences, so sequence ``i`` is row ``i % BATCH`` of batch ``i // BATCH``, and a memory-mapped
  file gives it as a view of the mapped bytes.
- ``part-00000.docs.arrow``: an Arrow stream with the id, the first position in the file and the number of ids of
  every document.

Files get their name only when complete, and a task that runs again writes the same bytes under the same name.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terracell.llm.common import text_blocks
from terracell.llm.pretokens import id_cache

# Sequences to a batch of a file.
BATCH = 128

DOCS = pa.schema([("doc_id", pa.int64()), ("first", pa.int64()), ("n_tokens", pa.int64())])


def known_uri(uri: str) -> str:
    """A folder's address as Arrow's file systems know it: Hadoop has names of its own for the same store."""
    scheme, sep, rest = uri.partition("://")
    return f"s3{sep}{rest}" if scheme in ("s3a", "s3n") else uri


def _store(uri: str) -> tuple[pafs.FileSystem, str]:
    uri = known_uri(uri)
    return pafs.FileSystem.from_uri(uri if "://" in uri or not uri.startswith("file:") else "file://" + uri[5:])


class SequenceWriter:
    """Packs runs of ids into batches of equal-length sequences."""

    def __init__(self, sink, length: int, dtype: np.dtype):
        self.length, self.dtype, self.held, self.n, self.written = length, dtype, [], 0, 0
        item = pa.from_numpy_dtype(dtype)
        self.schema = pa.schema([("input_ids", pa.list_(item, length)), ("mask", pa.list_(pa.bool_(), length))])
        self.stream = pa.ipc.new_stream(sink, self.schema)

    def add(self, ids: bytes) -> None:
        self.held.append(ids)
        self.n += len(ids) // self.dtype.itemsize
        if self.n >= BATCH * self.length:
            run = np.frombuffer(b"".join(self.held), self.dtype)
            full = len(run) // (BATCH * self.length) * (BATCH * self.length)
            for at in range(0, full, BATCH * self.length):
                self._put(run[at : at + BATCH * self.length], BATCH * self.length)
            self.held, self.n = [run[full:].tobytes()], len(run) - full

    def close(self) -> int:
        run = np.frombuffer(b"".join(self.held), self.dtype)
        if len(run):
            padded = np.zeros(-(-len(run) // self.length) * self.length, self.dtype)
            padded[: len(run)] = run
            self._put(padded, len(run))
        self.stream.close()
        return self.written

    def _put(self, run: np.ndarray, real: int) -> None:
        lists = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.length) for x in (run, np.arange(len(run)) < real)]
        self.stream.write_batch(pa.RecordBatch.from_arrays(lists, schema=self.schema))
        self.written += len(run) // self.length


def write_token_files(
    docs: DataFrame, out: str, tokenizer_path: str, end_id: int = 0, length: int = 2048, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Encode all documents in ascending order of id into files under ``out``; returns the manifest
    (part, path, n_docs, n_tokens, n_sequences), which is also written there.

    Null ids come first, rows of equal id stay together in the order of the input. A null or empty text is
    the end id alone. No rows give no files and an empty manifest. Other columns are ignored.
    """
    spark = docs.sparkSession

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = id_cache(tokenizer_path)
        end = np.array([end_id], cache.dtype).tobytes()
        part = TaskContext.get().partitionId()
        store, folder = _store(out)
        draft = f"{folder}/_draft-{uuid.uuid4().hex}"
        index: list[pa.RecordBatch] = []
        writer, sink, n_tokens = None, None, 0
        for batch, texts in text_blocks(batches):
            if writer is None:
                store.create_dir(folder, recursive=True)
                sink = store.open_output_stream(draft)
                writer = SequenceWriter(sink, length, cache.dtype)
            runs = [ids + end for ids in cache.encode([t.decode("utf-8", "replace") for t in texts])]
            sizes = np.array([len(r) // cache.dtype.itemsize for r in runs], np.int64)
            firsts = n_tokens + np.cumsum(sizes) - sizes
            index.append(pa.RecordBatch.from_arrays([batch.column(0), pa.array(firsts), pa.array(sizes)], schema=DOCS))
            n_tokens += int(sizes.sum())
            for run in runs:
                writer.add(run)
        if writer is None:
            return
        n_sequences = writer.close()
        sink.close()
        with store.open_output_stream(draft + ".docs") as f, pa.ipc.new_stream(f, DOCS) as s:
            for b in index:
                s.write_batch(b)
        name = f"part-{part:06d}"
        store.move(draft + ".docs", f"{folder}/{name}.docs.arrow")
        store.move(draft, f"{folder}/{name}.arrow")
        row = [part, f"{out}/{name}", sum(b.num_rows for b in index), n_tokens, n_sequences]
        yield pa.RecordBatch.from_pylist([dict(zip(("part", "path", "n_docs", "n_tokens", "n_sequences"), row))])

    chosen = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.monotonically_increasing_id().alias("place")
    )
    ordered = chosen.repartitionByRange("doc_id", "place").sortWithinPartitions("doc_id", "place").select("doc_id", "text")
    manifest = ordered.mapInArrow(write, "part long, path string, n_docs long, n_tokens long, n_sequences long")
    manifest.write.parquet(f"{out}/manifest")
    return spark.read.schema(manifest.schema).parquet(f"{out}/manifest")


def open_stream(path: str) -> pa.RecordBatchReader:
    """The batches of one file; of a local file as views of the mapped bytes."""
    store, name = _store(path)
    local = isinstance(store, pafs.LocalFileSystem)
    return pa.ipc.open_stream(pa.memory_map(name) if local else store.open_input_stream(name))


def sequence(path: str, i: int) -> tuple[np.ndarray, pa.Array]:
    """Sequence ``i`` of a file: its ids as a view without copy, and its mask."""
    for k, batch in enumerate(open_stream(path)):
        if k == i // BATCH:
            length, at = batch.schema.field(0).type.list_size, i % BATCH
            if at >= batch.num_rows:
                break
            return batch.column(0).values.to_numpy()[at * length : (at + 1) * length], batch.column(1).values.slice(at * length, length)
    raise IndexError(i)


def documents_of(path: str) -> Iterator[tuple[int | None, int, np.ndarray]]:
    """(doc_id, first position in the file, ids) of every document of a part, streaming over its sequences."""
    batches = iter(open_stream(f"{path}.arrow"))
    held, begin = np.empty(0, np.uint16), 0
    for rows in open_stream(f"{path}.docs.arrow"):
        for doc, first, n in zip(*(c.to_pylist() for c in rows.columns)):
            if begin + len(held) < first + n:
                parts, have = [held[first - begin :]], len(held) - (first - begin)
                while have < n:
                    batch = next(batches)
                    ids, mask = batch.column(0).values, batch.column(1).values
                    real = mask.true_count
                    parts.append(ids.to_numpy()[:real])
                    have += real
                held, begin = np.concatenate(parts), first
            yield doc, first, held[first - begin : first - begin + n]


def read_token_files(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """Per document, from the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32.

    The driver sees one manifest row for each file and adds up their sizes; the files are read by tasks.
    """
    files, total = [], 0
    for r in sorted(manifest.collect(), key=lambda r: r.part):
        files.append((r.path, total))
        total += r.n_tokens

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "start", "n_tokens", "ids_crc32"]
        kinds = [pa.int64()] * 4
        for batch in batches:
            for path, offset in zip(*(c.to_pylist() for c in batch.columns)):
                rows: list[tuple] = []
                for doc, first, ids in documents_of(path):
                    rows.append((doc, offset + first, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                    if len(rows) == 10_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    table = spark.createDataFrame(files, "path string, offset long")
    return table.repartition(max(1, len(files))).mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")
