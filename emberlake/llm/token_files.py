"""Token counts of flat token files, found by scanning for the end-of-document identifier.

A token file is nothing but identifiers of a fixed width, documents one after the other, each ended by a separator; there
is no index. Ranges of the files are read and searched in parallel, each whole in one array operation. A document may begin in an
earlier block, or lie across several: a prefix scan over the blocks of a file, which carries only the number of
separators before a block and the last one's place, stitches them.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from functools import lru_cache
from urllib.parse import quote, unquote

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from emberlake.llm.common import rows_per_partition, store_once
from emberlake.session import new_work_dir

BLOCK_TOKENS = 1 << 19
TASK_BYTES = 1 << 25
RUN_BLOCKS = 4096
FILE_RECORDS = 20_000
_WIDTHS = {2: "<u2", 4: "<u4"}


@lru_cache(maxsize=2)
def _encoding(path: str, pattern: str):
    import tiktoken

    with open(path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    return tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def _encode(vocabulary: str, pattern: str, width: int, separator: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = _encoding(vocabulary, pattern)
        for batch in batches:
            tokens = [np.asarray(encoding.encode_to_numpy(x.as_py() or "")).astype(_WIDTHS[width]).tobytes() for x in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(tokens, pa.binary())], ["doc_id", "tokens"])
    return run


def write_token_files(docs: DataFrame, path: str, vocabulary: str, pattern: str, separator: int, width: int = 2) -> None:
    """Writes ``path``/kind=tokens (flat token files) and, beside each, kind=ids with the doc_ids in the same order.

    Spark's own writer does it, so any store will do and a lost task is written anew: a text file whose "line end" is the
    separator's bytes is a flat token file. Null texts are empty documents. The ids are no index; they say nothing about
    places.
    """
    end = int(separator).to_bytes(width, "little").decode("latin-1")
    encoded = docs.selectExpr("CAST(doc_id AS LONG) AS doc_id", "CAST(text AS STRING) AS text").mapInArrow(
        _encode(vocabulary, pattern, width, separator), "doc_id long, tokens binary")
    both = encoded.withColumn("row", F.monotonically_increasing_id()).select("row", F.explode(F.array(
        F.struct(F.lit("tokens").alias("kind"), F.col("tokens").cast("string").alias("value")),
        F.struct(F.lit("ids").alias("kind"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("value")))).alias("x"))
    (both.select("row", "x.*").sortWithinPartitions("kind", "row").select("kind", "value")
     .write.partitionBy("kind").option("encoding", "ISO-8859-1").option("lineSep", end)
     .option("maxRecordsPerFile", FILE_RECORDS).text(path))


def _ranges(spark: SparkSession, path: str, width: int, block_tokens: int, task_bytes: int) -> DataFrame:
    """(file, block, n_tokens, is_last): the files cut into ranges of whole identifiers, dealt to tasks by ``task_bytes``.

    Only names and lengths are listed here; each range is read by the task that searches it.
    """
    files = spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"), F.expr(f"length div {width}").alias("total"))
    last = F.expr(f"greatest(0, total - 1) div {block_tokens}")
    blocks = files.select("file", "total", last.alias("last"), F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("block"))
    size = width * (files.agg(F.sum("total")).first()[0] or 0)
    return blocks.select("file", "block", F.expr(f"least({block_tokens}, total - block * {block_tokens})").alias("n_tokens"),
                         (F.col("block") == F.col("last")).alias("is_last")).repartition(rows_per_partition(size, task_bytes), "file", "block")


def _open(path: str):
    """A stored file that can be read from any place, by its name as Spark lists it."""
    scheme, _, rest = path.partition(":")
    if scheme == "file":
        return fs.LocalFileSystem().open_input_file("/" + rest.lstrip("/"))
    store, name = fs.FileSystem.from_uri(quote(path, safe=":/@"))
    return store.open_input_file(unquote(name))


def _search(separator: int, width: int, block_tokens: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, row in enumerate(batch.to_pylist()):
                with _open(row["file"]) as file:
                    file.seek(row["block"] * block_tokens * width)
                    tokens = np.frombuffer(file.read(row["n_tokens"] * width), dtype=_WIDTHS[width])
                ends = np.flatnonzero(tokens == separator) + row["block"] * block_tokens
                yield pa.RecordBatch.from_arrays(
                    [*batch.slice(i, 1).columns, pa.ListArray.from_arrays(pa.array([0, len(ends)], pa.int32()), pa.array(ends, pa.int64()))],
                    [*batch.schema.names, "ends"])
    return run


def _carried(found: DataFrame) -> DataFrame:
    """(file, block, docs_before, open_since): how many separators come before a block, and where its first document began.

    A prefix scan in two levels, within runs of ``RUN_BLOCKS`` blocks and over the runs of a file, so that no task needs
    more than a run's numbers or a file's runs.
    """
    marks = found.select("file", "block", F.expr(f"block div {RUN_BLOCKS}").alias("run"), F.size("ends").cast("long").alias("n"),
                         F.get("ends", F.size("ends") - 1).alias("last"))
    earlier_runs = Window.partitionBy("file").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    earlier_blocks = Window.partitionBy("file", "run").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    runs = (marks.groupBy("file", "run").agg(F.sum("n").alias("n"), F.max("last").alias("last"))
            .select("file", "run", F.sum("n").over(earlier_runs).alias("n_runs"), F.max("last").over(earlier_runs).alias("last_run")))
    blocks = marks.select("file", "run", "block", F.sum("n").over(earlier_blocks).alias("n_blocks"), F.max("last").over(earlier_blocks).alias("last_block"))
    return blocks.join(runs, ["file", "run"]).select(
        "file", "block", (F.coalesce("n_runs", F.lit(0)) + F.coalesce("n_blocks", F.lit(0))).alias("docs_before"),
        F.coalesce(F.greatest("last_run", "last_block") + 1, F.lit(0)).alias("open_since"))


def separator_scan(spark: SparkSession, path: str, separator: int, width: int = 2, block_tokens: int = BLOCK_TOKENS,
                   task_bytes: int = TASK_BYTES) -> DataFrame:
    """(file, doc, start, n_tokens, ended): every document of the token files under ``path``, in file order.

    ``doc`` counts from 0 in each file, ``start`` is the place of its first token, ``n_tokens`` excludes the separator.
    Tokens behind a file's last separator are a document with ``ended`` false. Two separators in a row hold an empty
    document; an empty file holds none. Bytes that don't fill an identifier at a file's end are ignored. A file may have
    any length: its ranges are read by as many tasks as ``task_bytes`` asks for, from a local or shared folder or a store
    that Arrow can open.
    """
    ranges = _ranges(spark, path, width, block_tokens, task_bytes)
    found = store_once(ranges.mapInArrow(_search(separator, width, block_tokens), "file string, block long, n_tokens long, is_last boolean, ends array<long>"), "separators")
    scanned = found.join(_carried(found), ["file", "block"])
    total = F.col("block") * block_tokens + F.col("n_tokens")
    last_end = F.coalesce(F.get("ends", F.size("ends") - 1) + 1, "open_since")
    rest = F.when(F.col("is_last") & (last_end < total), F.array(total)).otherwise(F.array().cast("array<bigint>"))
    documents = scanned.select("file", "docs_before", "open_since", F.size("ends").alias("n_ends"), "ends", F.posexplode(F.concat("ends", rest)))
    start = F.when(F.col("pos") == 0, F.col("open_since")).otherwise(F.get("ends", F.col("pos") - 1) + 1)
    return documents.select("file", (F.col("docs_before") + F.col("pos")).alias("doc"), start.alias("start"),
                            (F.col("col") - start).alias("n_tokens"), (F.col("pos") < F.col("n_ends")).alias("ended"))


def document_tokens(docs: DataFrame, vocabulary: str, pattern: str, separator: int, width: int = 2,
                    block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(doc_id, n_tokens, doc, start): tokens per document of ``docs``, counted in token files written for them.

    One row per row; a null doc_id stays null. An empty table gives an empty one. The files lie in the shared folder.
    """
    spark = docs.sparkSession
    path = new_work_dir(spark, "token-files")
    write_token_files(docs, path, vocabulary, pattern, separator, width)
    if docs.isEmpty():
        return spark.createDataFrame([], "doc_id long, n_tokens long, doc long, start long")
    end = int(separator).to_bytes(width, "little")
    names = spark.read.format("binaryFile").load(f"{path}/kind=ids").select(
        F.element_at(F.split("path", "/"), -1).alias("name"),
        F.posexplode(F.split(F.decode("content", "ISO-8859-1"), "\\Q" + end.decode("latin-1") + "\\E")))
    counted = separator_scan(spark, f"{path}/kind=tokens", separator, width, block_tokens).withColumn(
        "part", F.element_at(F.split("file", "/"), -1))
    return (counted.join(names, (F.col("part") == F.col("name")) & (F.col("doc") == F.col("pos")))
            .select(F.expr("CAST(NULLIF(col, '') AS LONG)").alias("doc_id"), "n_tokens", F.col("doc").cast("long").alias("doc"), "start"))
