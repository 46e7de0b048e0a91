"""Token-id files: flat unsigned integers with 64-bit document offsets.

A dataset is a folder with three files for each partition k of ascending doc_id:

- ``k.ids``: the ids of its documents, one after another, little-endian unsigned
  integers of two bytes (four for vocabularies above 65,536)
- ``k.offsets``: 64-bit positions in it where each document begins, and its length
- ``k.docs``: the 64-bit doc_ids; ``k.nulls``: one byte each, 1 where it is null

and a Parquet ``manifest``: partition, documents, ids, and the base, the number of ids
in all partitions before, which prefix sums over the partitions give. Document d of
partition k begins at base + offset. Files are read by memory-mapping where the
folder is a mounted one.

A task writes under a name of its own and renames, so a repeated attempt replaces its
files by equal ones. The folder must be one that all executors reach: any that
pyarrow can open by its URI.

Defined cases: a null text is an empty one and so has the end id only; null doc_ids
come first; rows with one doc_id are ordered by a hash of their text, and rows equal in
both follow each other; an empty table gives a dataset without partitions.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.pieces import encoder
from tidemark.plans import scratch_path

END_ID, WIDTH = 0, 2
PARTS = ("ids", "offsets", "docs", "nulls")


def _open(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder)


def _write_partition(folder: str, path: str, width: int, end: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, width)
        stop = int(end).to_bytes(width, "little")
        part = TaskContext.get().partitionId()
        where, root = _open(folder)
        where.create_dir(root, recursive=True)
        attempt = f"{root}/_{part}-{uuid.uuid4().hex}"
        out = {}
        docs = total = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if not out:
                out = {p: where.open_output_stream(f"{attempt}.{p}") for p in PARTS}
            lengths = []
            for text in batch.column("text"):
                ids = own.encode(text.as_py()) + stop
                out["ids"].write(ids)
                lengths.append(len(ids) // width)
            begins = total + np.concatenate([[0], np.cumsum(lengths)]).astype("<i8")
            out["offsets"].write(begins[:-1].tobytes())
            keys = batch.column("doc_id")
            out["docs"].write(keys.fill_null(0).to_numpy().astype("<i8").tobytes())
            out["nulls"].write(
                np.asarray(keys.is_null().to_numpy(zero_copy_only=False), np.uint8).tobytes()
            )
            total, docs = int(begins[-1]), docs + batch.num_rows
        if out:
            out["offsets"].write(np.int64(total).astype("<i8").tobytes())
            for name, stream in out.items():
                stream.close()
                where.move(f"{attempt}.{name}", f"{root}/{part:06d}.{name}")
            yield pa.RecordBatch.from_arrays(
                [pa.array([part]), pa.array([docs]), pa.array([total])],
                ["part", "n_docs", "n_ids"],
            )

    return write


def write_token_files(
    docs: DataFrame, folder: str, path: str, width: int = WIDTH, end: int = END_ID
) -> DataFrame:
    """Write the dataset and return its manifest (part, n_docs, n_ids, base)."""
    spark = docs.sparkSession
    ordered = (
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.coalesce("text", F.lit("")).alias("text"),
        )
        .withColumn("mark", F.xxhash64("text"))
        .repartitionByRange("doc_id", "mark")
        .sortWithinPartitions("doc_id", "mark")
        .drop("mark")
    )
    written = ordered.mapInArrow(
        _write_partition(f"{folder}/parts", path, width, end),
        "part bigint, n_docs bigint, n_ids bigint",
    )
    written.write.parquet(f"{folder}/written")
    # one row a partition: the window over all of them is small
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    manifest = spark.read.schema(written.schema).parquet(f"{folder}/written").withColumn(
        "base", F.coalesce(F.sum("n_ids").over(before), F.lit(0))
    )
    manifest.write.parquet(f"{folder}/manifest")
    return spark.read.parquet(f"{folder}/manifest")


def mapped(where: fs.FileSystem, path: str, kind: str) -> np.ndarray:
    """A file as an array: memory-mapped if it is a local or mounted one."""
    if isinstance(where, fs.LocalFileSystem):
        size = where.get_file_info(path).size
        return np.memmap(path, kind, "r") if size else np.zeros(0, kind)
    with where.open_input_file(path) as file:
        return np.frombuffer(file.read(), kind)


def _read_partition(folder: str, width: int, rows: int = 4096):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, root = _open(folder)
        for batch in batches:
            for part, base in zip(batch.column("part").to_pylist(), batch.column("base").to_pylist()):
                name = f"{root}/{part:06d}"
                ids = mapped(where, f"{name}.ids", f"<u{width}")
                offsets = mapped(where, f"{name}.offsets", "<i8")
                docs = mapped(where, f"{name}.docs", "<i8")
                nulls = mapped(where, f"{name}.nulls", "u1")
                for at in range(0, len(docs), rows):
                    cuts = np.array(offsets[at : at + rows + 1])
                    sums = [
                        zlib.crc32(np.ascontiguousarray(ids[a:b], "<u4"))
                        for a, b in zip(cuts, cuts[1:])
                    ]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.array(docs[at : at + rows]), mask=nulls[at : at + rows] == 1),
                            pa.array(cuts[:-1] + base),
                            pa.array(np.diff(cuts)),
                            pa.array(sums, pa.int64()),
                        ],
                        ["doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    return read


def read_token_files(spark: SparkSession, folder: str, width: int = WIDTH) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files.

    The checksum is over the document's ids as little-endian 32-bit integers.
    """
    manifest = spark.read.parquet(f"{folder}/manifest")
    parts = max(1, spark.sparkContext.defaultParallelism)
    return (
        manifest.select("part", "base")
        .repartition(parts, "part")
        .mapInArrow(
            _read_partition(f"{folder}/parts", width),
            "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint",
        )
    )


def token_folder(spark: SparkSession) -> str:
    """A fresh folder in the shared checkpoint folder."""
    return scratch_path(spark, "token-ids")
