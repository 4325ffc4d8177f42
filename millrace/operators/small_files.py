"""Many tiny label files into few well-sized ones, each record once.

Method: balanced longest-first scheduling. The listing (path and size, never the contents) is
split by a hash of the path into shards of bounded length; each shard gives its files, the
longest first, to the least loaded of its fixed number of output groups, held in a heap. Shards
are independent, so neither the driver nor one task ever holds the listing of all files, and the
groups of a shard differ by at most its longest file. Each group is then streamed through pyarrow
into one Parquet file, and the set is published by writing a manifest last, after it has been
verified against what was written.

Defined results: a file with a null path has no place and is left out, one with null content has no
records; a quoted field may hold line breaks; an id is a number of 0 to 2^63 - 1; a record without one of
the five fields is reported as incomplete and not published; a repeated delivery of a record is
kept once (complete before incomplete, then the latest ``modified_at``, then the smallest path);
the last record of a file that is shorter than announced is cut off, therefore incomplete; an
empty listing gives an empty manifest.
"""

from __future__ import annotations

import csv
import heapq
import io
import json
import re
import uuid
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.storage import drop, stage

FIELDS = ("label_id", "filename", "split", "task", "disease")
#: Delimiters of the drops. The first line that has four of one of them decides for its file.
DELIMITERS = ("\t", ";", ",", "|")

RECORD = T.StructType(
    [T.StructField("label_id", T.LongType())]
    + [T.StructField(x, T.StringType()) for x in FIELDS[1:]]
    + [T.StructField("complete", T.BooleanType())]
)


def _split(line: str, delimiter: str) -> list[str] | None:
    """The fields of a line, or None if its quoting is open."""
    try:
        rows = list(csv.reader(io.StringIO(line), delimiter=delimiter, strict=True))
    except csv.Error:
        return None
    return rows[0] if len(rows) == 1 else None


def _delimiter(lines: list[str]) -> str:
    for line in lines:
        best, n = max(((d, len(_split(line, d) or ())) for d in DELIMITERS), key=lambda x: (x[1] == len(FIELDS), x[1]))
        if n == len(FIELDS):
            return best
    counts = {d: sum(line.count(d) for line in lines) for d in DELIMITERS}
    return max(counts, key=counts.get)


def _id(value: object) -> int | None:
    text = str(value).strip() if value is not None and not isinstance(value, bool) else ""
    number = int(text) if re.fullmatch(r"[0-9]{1,40}", text) else -1
    return number if 0 <= number < 1 << 63 else None


def _rows(lines: list[str], delimiter: str, width: int) -> Iterator[tuple[list[str] | None, int, int]]:
    """(fields, first line, last line) of the rows of delimited text.

    A quoted field may hold line breaks: a line whose quoting is open is read together with the ones
    behind it, up to a line that closes it. A line that is a whole record by itself ends the search,
    since then the quote was never closed; the open line is no row and comes as None.
    """
    i = 0
    while i < len(lines):
        row, j = _split(lines[i], delimiter), i
        text = lines[i]
        while row is None and j + 1 < len(lines):
            j += 1
            text += "\n" + lines[j]
            if '"' in lines[j]:
                row = _split(text, delimiter)
            alone = _split(lines[j], delimiter) if row is None else None
            if alone is not None and len(alone) == width and _id(alone[0]) is not None:
                break
        if row is None:
            j = i
        yield row, i, j
        i = j + 1


def parse_fragment(content: str | None, size_bytes: int | None = None) -> list[tuple]:
    """The records of one file as (label_id, filename, split, task, disease, complete)."""
    if not content:
        return []
    cut = size_bytes is not None and size_bytes > len(content.encode("utf-8", "surrogatepass"))
    lines = re.split(r"\r\n|\n|\r", content.lstrip("\ufeff"))
    open_end = cut and bool(lines[-1].strip())
    while lines and not lines[-1].strip():
        lines.pop()
    if not any(x.strip() for x in lines):
        return []
    out: list[tuple] = []
    if next(x for x in lines if x.strip()).lstrip().startswith("{"):
        for i, line in enumerate(lines):
            try:
                row = json.loads(line)
            except ValueError:
                continue
            if isinstance(row, dict) and (key := _id(row.get("label_id"))) is not None:
                whole = all(f in row for f in FIELDS) and not (open_end and i == len(lines) - 1)
                out.append((key, *(None if row.get(f) is None else str(row[f]) for f in FIELDS[1:]), whole))
        return out
    delimiter, order = _delimiter([x for x in lines if x.strip()]), list(FIELDS)
    for row, first, last in _rows(lines, delimiter, len(order)):
        if row is None:  # its quoting stays open: of a record only the id is certain
            if (key := _id(lines[first].split(delimiter, 1)[0].strip('" '))) is not None and order[0] == "label_id":
                out.append((key, *(None for _ in FIELDS[1:]), False))
            continue
        names = [x.strip().lower() for x in row]
        if "label_id" in names:
            order = names
            continue
        got = dict(zip(order, row))
        if (key := _id(got.get("label_id"))) is not None:
            whole = len(row) == len(order) and all(f in got for f in FIELDS) and not (open_end and last == len(lines) - 1)
            out.append((key, *(got.get(f) or None for f in FIELDS[1:]), whole))
    return out


def schedule(files: DataFrame, target_bytes: int = 128 << 20, shard_bytes: int = 64 << 30) -> DataFrame:
    """(path, size_bytes, shard, out_group): every file in exactly one output group.

    ``shard_bytes`` bounds what one heap schedules; the number of groups is fixed beforehand as
    total bytes / ``target_bytes`` of each shard.
    """
    listing = files.groupBy("path").agg(F.max(F.greatest(F.lit(0), F.coalesce("size_bytes", F.lit(0)))).alias("size_bytes")).filter("path is not null")
    total, count = listing.agg(F.coalesce(F.sum("size_bytes"), F.lit(0)), F.count("*")).first()
    shards = max(1, -(-total // shard_bytes), -(-count // 1_000_000))

    def lpt(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["size_bytes", "path"], ascending=[False, True], kind="stable")
        n = max(1, round(int(part["size_bytes"].sum()) / target_bytes))
        heap = [(0, 0, g) for g in range(n)]
        groups = []
        for size in part["size_bytes"]:
            load, held, g = heapq.heappop(heap)
            groups.append(g)
            heapq.heappush(heap, (load + int(size), held + 1, g))
        return part.assign(out_group=groups)

    return (
        listing.withColumn("shard", F.pmod(F.xxhash64("path"), F.lit(shards)).cast("int"))
        .groupBy("shard")
        .applyInPandas(lpt, "path string, size_bytes bigint, shard int, out_group int")
    )


def records(files: DataFrame) -> DataFrame:
    """Every record of every file, in Arrow batches: path, modified_at and RECORD."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, at = [], []
            contents, sizes = batch.column("content").to_pylist(), batch.column("size_bytes").to_pylist()
            for i, (content, size) in enumerate(zip(contents, sizes)):
                got = parse_fragment(content, size)
                rows += got
                at += [i] * len(got)
            columns = list(zip(*rows)) if rows else [[] for _ in RECORD.fields]
            kept = batch.select(["path", "modified_at"]).take(pa.array(at, pa.int64()))
            types = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.bool_()]
            yield pa.RecordBatch.from_arrays(
                kept.columns + [pa.array(c, t) for c, t in zip(columns, types)],
                ["path", "modified_at", *RECORD.names],
            )

    schema = T.StructType([T.StructField("path", T.StringType()), files.schema["modified_at"], *RECORD.fields])
    return files.filter("path is not null").select("path", "size_bytes", "content", "modified_at").mapInArrow(parse, schema)


def unique_records(files: DataFrame) -> DataFrame:
    """One row for each label id with a complete record: the one that is kept and where it lies."""
    kept = records(files).filter("complete")
    rank = F.struct(F.col("modified_at").isNotNull().alias("k"), "modified_at", (-F.xxhash64("path")).alias("h"), "path", *FIELDS[1:])
    return kept.groupBy("label_id").agg(F.max(rank).alias("r")).select("label_id", *(F.col(f"r.{x}").alias(x) for x in (*FIELDS[1:], "path", "modified_at")))


def consolidate(files: DataFrame, target_bytes: int = 128 << 20) -> DataFrame:
    """The kept records with the output group that each is written to."""
    plan = schedule(files, target_bytes).select("path", "shard", "out_group")
    return unique_records(files).join(plan, "path")


DATA = pa.schema([("label_id", pa.int64()), *((x, pa.string()) for x in FIELDS[1:])])
WRITTEN = "file string, shard int, out_group int, records bigint, bytes bigint, ids decimal(38,0)"


def _file_system(folder: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a qualified URI (file, hdfs, s3, gs, ...) and the path in it."""
    return pafs.FileSystem.from_uri(folder)


def _qualified(spark: SparkSession, folder: str) -> str:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    uri = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(at).toString()
    return "file://" + uri[5:] if uri.startswith("file:/") and not uri.startswith("file://") else uri


def _total(ids: pa.Array) -> int:
    return int(pc.sum(ids.cast(pa.decimal128(38, 0))).as_py() or 0)


def write_groups(rows: DataFrame, folder: str, groups: int) -> DataFrame:
    """WRITTEN: rows(label_id, ..., shard, out_group) as one Parquet file for each output group.

    A task streams its groups, one after the other, through a pyarrow writer into files whose names
    no other attempt has; an attempt that fails or is repeated leaves files that nobody lists.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _file_system(folder)
        fs.create_dir(base, recursive=True)
        writer, at, name, n, ids = None, None, "", 0, 0
        done: list[dict] = []

        def close() -> None:
            if writer is not None:
                writer.close()
                size = fs.get_file_info(f"{base}/{name}").size
                done.append({"file": name, "shard": at[0], "out_group": at[1], "records": n, "bytes": size, "ids": Decimal(ids)})

        for batch in batches:
            shard, group = batch.column("shard").to_numpy(), batch.column("out_group").to_numpy()
            data = pa.RecordBatch.from_arrays([batch.column(x).cast(DATA.field(x).type) for x in DATA.names], schema=DATA)
            cuts = np.flatnonzero((np.diff(shard) != 0) | (np.diff(group) != 0)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(shard)]):
                if lo == hi:
                    continue
                here = (int(shard[lo]), int(group[lo]))
                if here != at:
                    close()
                    at, n, ids, name = here, 0, 0, f"group-{here[0]:05d}-{here[1]:05d}-{uuid.uuid4().hex}.parquet"
                    writer = pq.ParquetWriter(f"{base}/{name}", DATA, compression="zstd", filesystem=fs)
                writer.write_batch(data.slice(lo, hi - lo))
                n += hi - lo
                ids += _total(data.column("label_id").slice(lo, hi - lo))
        close()
        yield pa.RecordBatch.from_pylist(done, WRITTEN_ARROW)

    laid = rows.repartition(groups, "shard", "out_group").sortWithinPartitions("shard", "out_group", "label_id")
    return laid.select(*FIELDS, "shard", "out_group").mapInArrow(write, WRITTEN)


WRITTEN_ARROW = pa.schema([("file", pa.string()), ("shard", pa.int32()), ("out_group", pa.int32()), ("records", pa.int64()), ("bytes", pa.int64()), ("ids", pa.decimal128(38, 0))])


def verify_groups(written: DataFrame, folder: str) -> DataFrame:
    """written rows with ``found`` and ``found_ids``: what the files hold when they are read again."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _file_system(folder)
        for batch in batches:
            rows = batch.to_pylist()
            for r in rows:
                r["found"] = r["found_ids"] = None
                try:
                    with fs.open_input_file(f"{base}/{r['file']}") as f:
                        r["found"], total = 0, 0
                        for part in pq.ParquetFile(f).iter_batches(columns=["label_id"]):
                            r["found"] += part.num_rows
                            total += _total(part.column(0))
                        r["found_ids"] = Decimal(total)
                except OSError:
                    pass  # a file that can't be read holds nothing
            yield pa.RecordBatch.from_pylist(rows, WRITTEN_ARROW.append(pa.field("found", pa.int64())).append(pa.field("found_ids", pa.decimal128(38, 0))))

    return written.mapInArrow(read, WRITTEN + ", found bigint, found_ids decimal(38,0)")


def publish(files: DataFrame, folder: str, target_bytes: int = 128 << 20) -> dict:
    """Writes the output groups, verifies them and publishes ``_manifest.json`` by one renaming.

    ``folder`` is a path that executors and driver share, on any file system that pyarrow knows.
    The fragments are parsed once; the kept records are staged, so that a lost executor costs no
    second parse and their number and the sum of their ids are those of the staged table. Every file
    is read again where it was written to, and its rows and ids must be what its writer counted and,
    together, what was staged. Readers look for the manifest, which lists exactly the verified files:
    a failed attempt leaves nothing that counts. The driver holds one entry for each published file
    (about one per ``target_bytes``), as every reader of the folder does. Returns the manifest.
    """
    spark = files.sparkSession
    folder = _qualified(spark, folder)
    fs, base = _file_system(folder)
    if fs.get_file_info(f"{base}/_manifest.json").type != pafs.FileType.NotFound:
        raise FileExistsError(f"{folder} is published already")
    fs.create_dir(base, recursive=True)
    kept = stage(consolidate(files, target_bytes), "records")
    ids = F.coalesce(F.sum(F.col("label_id").cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)"))
    expected, expected_ids = kept.agg(F.count("*"), ids).first()
    groups = kept.select("shard", "out_group").distinct().count()
    written = stage(write_groups(kept, folder, min(max(1, groups), 20_000)), "written")
    found = verify_groups(written.repartition(min(max(1, groups), 20_000), "file"), folder).collect()
    bad = [r.file for r in found if r.found != r.records or r.found_ids != r.ids]
    if bad or sum(r.records for r in found) != expected or sum(r.ids for r in found) != expected_ids:
        raise ValueError(f"{sum(r.found or 0 for r in found)} records are there, {expected} expected; files that differ: {bad[:5]}")
    drop(kept)
    drop(written)
    listed = sorted(({"file": r.file, "records": r.records, "bytes": r.bytes} for r in found), key=lambda f: f["file"])
    manifest = {"records": expected, "files": listed}
    temporary = f"{base}/_tmp-{uuid.uuid4().hex}"
    with fs.open_output_stream(temporary) as out:
        out.write(json.dumps(manifest).encode())
    fs.move(temporary, f"{base}/_manifest.json")
    return manifest


def published(spark: SparkSession, folder: str) -> DataFrame:
    """The records of a published folder: of the files in its manifest and no others."""
    fs, base = _file_system(_qualified(spark, folder))
    with fs.open_input_stream(f"{base}/_manifest.json") as f:
        names = [x["file"] for x in json.loads(f.read())["files"]]
    schema = "label_id bigint, " + ", ".join(f"{x} string" for x in FIELDS[1:])
    reader = spark.read.schema(schema)
    return reader.parquet(*(f"{folder.rstrip('/')}/{n}" for n in names)) if names else spark.createDataFrame([], schema)
