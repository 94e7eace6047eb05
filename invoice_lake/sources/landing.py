"""Monthly zip archives with three delimited files each.

Executors list and unpack the archives, one task per member, streaming record by record from the
archive to a staging folder. Staged records end with a character of their own, so that line breaks
inside quotes stay. The staged files are compressed, and a large member becomes several of them, which
Spark reads in parallel. Records with a field too many or too few go to files of rejects beside them.
Only file names, headers and counts reach the driver.
A task that is repeated writes the same files again under the same names.
"""

from __future__ import annotations

import csv
import gzip
import io
import json
import uuid
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs as arrow_fs
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from invoice_lake.functions.periods import dashed_period
from invoice_lake.schemas import TABLES
from invoice_lake.sources.layers import append_periods

# Names that start with six digits; everything else in the folder is ignored.
ARCHIVE_GLOB = "[0-9][0-9][0-9][0-9][0-9][0-9]*"
ENCODING = "ISO-8859-1"
MEMBERS_PER_ARCHIVE = 3
RECORD_END = "\x1e"
MAX_FIELD = 64 << 20
# Text of one staged file before compression.
PART_BYTES = 128 << 20

MEMBER_SCHEMA = "periodo string, archive string, member string, n_members int"
STAGED_SCHEMA = "periodo string, tabela string, path string, header string, records long, rejected long"
REJECT_SCHEMA = "periodo string, archive string, motivo string, registro long, texto string"


def list_archives(spark: SparkSession, landing: str) -> DataFrame:
    """Archives of the landing folder, one per period: the greatest name wins.

    The archives' content is not read. A missing folder has no archives.
    """
    reader = spark.read.format("binaryFile").option("pathGlobFilter", ARCHIVE_GLOB)
    try:
        files = reader.load(landing)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        empty = spark.createDataFrame([], "path string")
        return with_periods(empty)
    return with_periods(files)


def with_periods(files: DataFrame) -> DataFrame:
    """(path, file name, period) of files named YYYYMM..., one per period."""
    name = F.element_at(F.split("path", "/"), -1)
    named = files.select("path", name.alias("arquivo")).withColumn(
        "periodo_raw", F.regexp_extract("arquivo", r"^(\d{6})", 1)
    )
    latest = Window.partitionBy("periodo_raw").orderBy(F.desc("arquivo"))
    return (
        named.filter("periodo_raw <> ''")
        .withColumn("_place", F.row_number().over(latest))
        .filter("_place = 1")
        .select("path", "arquivo", "periodo_raw", dashed_period(F.col("periodo_raw")).alias("periodo"))
    )


def classify_member(name: Column) -> Column:
    """Table of a member, by its name: item, evento, or else nf."""
    lowered = F.lower(name)
    return (
        F.when(lowered.contains("item"), F.lit("itens"))
        .when(lowered.contains("evento"), F.lit("eventos"))
        .otherwise(F.lit("nf"))
    )


def list_members(archives: DataFrame) -> DataFrame:
    """Members of the archives and the table each belongs to. Reads the archives' directories only."""

    def directory(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for periodo, path in zip(batch["periodo"], batch["path"]):
                with _open(path) as source, zipfile.ZipFile(source) as archive:
                    names = [info.filename for info in archive.infolist() if not info.is_dir()]
                yield pd.DataFrame(
                    {"periodo": periodo, "archive": path, "member": names or [None], "n_members": len(names)}
                )

    members = archives.select("periodo", "path").mapInPandas(directory, MEMBER_SCHEMA)
    return members.withColumn("tabela", classify_member(F.col("member")))


def split_members(members: list[Row]) -> tuple[list[Row], list[Row]]:
    """Members of complete archives, and one reject row (periodo, archive, motivo) per other archive."""
    by_archive: dict[str, list[Row]] = {}
    for row in members:
        by_archive.setdefault(row.archive, []).append(row)
    complete, rejects = [], []
    for archive, rows in by_archive.items():
        count = rows[0].n_members
        if count != MEMBERS_PER_ARCHIVE:
            reason = f"expected {MEMBERS_PER_ARCHIVE} files, found {count}"
        elif {row.tabela for row in rows} != set(TABLES):
            missing = sorted(set(TABLES) - {row.tabela for row in rows})
            reason = f"no file for {', '.join(missing)}"
        else:
            complete += rows
            continue
        rejects.append(Row(periodo=rows[0].periodo, archive=archive, motivo=reason))
    return complete, rejects


def unpack(spark: SparkSession, members: list[Row], staging: str) -> list[Row]:
    """Copy the members to <staging>/<table>/periodo=YYYY-MM/; returns path, header and counts of each file written."""
    rows = [(i, m.periodo, m.archive, m.member, m.tabela) for i, m in enumerate(members)]
    todo = spark.createDataFrame(rows, "n int, periodo string, archive string, member string, tabela string")

    def copy(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                name = row.member.rsplit("/", 1)[-1]
                folder = f"{staging.rstrip('/')}/{row.tabela}/periodo={row.periodo}"
                rejects = f"{staging.rstrip('/')}/rejeitados/periodo={row.periodo}"
                header, parts, rejected = _copy_member(row, f"{folder}/{name}", f"{rejects}/{row.tabela}-{name}.json")
                yield pd.DataFrame(
                    [(row.periodo, row.tabela, path, header, records, 0 if i else rejected) for i, (path, records) in enumerate(parts)],
                    columns=["periodo", "tabela", "path", "header", "records", "rejected"],
                )

    # One partition per row: the rows are tiny, their work is not.
    return todo.repartitionById(max(1, len(rows)), "n").mapInPandas(copy, STAGED_SCHEMA).collect()


def read_rejects(spark: SparkSession, staging: str) -> DataFrame:
    """Records that the staged files leave out, with their text."""
    return spark.read.schema(REJECT_SCHEMA).json(f"{staging.rstrip('/')}/rejeitados")


def read_staged(spark: SparkSession, staged: list[Row], staging: str, table: str) -> DataFrame:
    """Staged files of one table as text columns plus ``periodo``.

    Files with the same header are one scan; months with other headers are matched by column name.
    """
    by_header: dict[str, list[str]] = {}
    for row in staged:
        if row.tabela == table:
            by_header.setdefault(row.header, []).append(row.path)
    scans = [
        read_delimited(spark, paths, header_columns(header), f"{staging.rstrip('/')}/{table}", RECORD_END)
        for header, paths in sorted(by_header.items())
    ]
    return append_periods(scans)


def header_columns(header: str) -> list[str]:
    return next(csv.reader([header], delimiter=";"))


def read_delimited(
    spark: SparkSession, paths: list[str], columns: list[str], base_path: str, record_end: str | None = None
) -> DataFrame:
    """Semicolon-separated Latin-1 files with a header, every column text, empty fields NULL."""
    fields = [T.StructField(name, T.StringType()) for name in (*columns, "periodo")]
    reader = spark.read.schema(T.StructType(fields)).options(sep=";", encoding=ENCODING, header=True, quote='"', escape='"')
    if record_end is not None:
        reader = reader.option("lineSep", record_end)
    raw = reader.option("basePath", base_path).csv(paths)
    return raw.select(*[F.nullif(F.col(f"`{name}`"), F.lit("")).alias(name) for name in raw.columns])


def _file_system(path: str) -> tuple[arrow_fs.FileSystem, str]:
    """File system and plain path; Spark writes local paths as file:/x, which is not a full URI."""
    if path.startswith("file:"):
        path = "/" + path[len("file:"):].lstrip("/")
    if path.startswith("/"):
        return arrow_fs.LocalFileSystem(), path
    return arrow_fs.FileSystem.from_uri(path)


def _open(path: str):
    system, plain = _file_system(path)
    return system.open_input_file(plain)


def _copy_member(row, target: str, rejects: str) -> tuple[str, list[tuple[str, int]], int]:
    """Stream the records of one member to files of ``target``; returns its header, the files with their records, and the number rejected.

    Files appear under their names only when they are whole.
    """
    csv.field_size_limit(MAX_FIELD)
    kept = rejected = 0
    header: list[str] | None = None
    with _open(row.archive) as source, zipfile.ZipFile(source) as archive, archive.open(row.member) as data:
        records = csv.reader(io.TextIOWrapper(data, ENCODING, newline=""), delimiter=";")
        with _Parts(target) as out, _Parts(rejects) as left:
            writer = csv.writer(out, delimiter=";", lineterminator=RECORD_END)
            for fields in records:
                if not fields:
                    continue
                if header is None:
                    header = fields
                    out.head = _line(fields, RECORD_END)
                elif len(fields) == len(header) and not any(RECORD_END in f for f in fields):
                    kept += 1
                    writer.writerow(fields)
                else:
                    rejected += 1
                    reason = f"{row.tabela}: expected {len(header)} fields, found {len(fields)}"
                    if len(fields) == len(header):
                        reason = f"{row.tabela}: a field holds the record separator"
                    left.write(json.dumps({
                        "periodo": row.periodo, "archive": row.archive, "motivo": reason,
                        "registro": kept + rejected, "texto": ";".join(fields)}) + "\n")
    return _line(header or [], ""), out.written, rejected


def _line(fields: list[str], end: str) -> str:
    text = io.StringIO()
    csv.writer(text, delimiter=";", lineterminator=end).writerow(fields)
    return text.getvalue()


class _Parts:
    """Compressed text files <target>-NNNNN.gz of the archives' encoding, each of about PART_BYTES of text below ``head``.

    ``write`` takes one record. A file gets its name when it is closed without an error; there is one at least.
    """

    def __init__(self, target: str):
        self.target, self.head = target, ""
        self.system, plain = _file_system(target)
        self.folder, self.name = plain.rsplit("/", 1)
        self.system.create_dir(self.folder, recursive=True)
        self.written: list[tuple[str, int]] = []
        self.text = None

    def __enter__(self):
        return self

    def write(self, record: str) -> None:
        if self.text is None:
            self._begin()
        self.text.write(record)
        self.records += 1
        self.size += len(record)
        if self.size >= PART_BYTES:
            self._end()

    def _begin(self) -> None:
        self.partial = f"{self.folder}/_{self.name}.{uuid.uuid4().hex}"
        self.stream = self.system.open_output_stream(self.partial)
        self.text = io.TextIOWrapper(gzip.GzipFile(fileobj=self.stream, mode="wb", compresslevel=1, mtime=0), ENCODING, newline="")
        self.records = self.size = 0
        self.text.write(self.head)

    def _end(self, whole: bool = True) -> None:
        self.text.close()
        self.stream.close()
        self.text = None
        if not whole:
            return
        name = f"-{len(self.written):05d}.gz"
        plain = f"{self.folder}/{self.name}{name}"
        if self.system.get_file_info(plain).type == arrow_fs.FileType.File:
            # An earlier attempt or delivery; some file systems do not rename onto a file.
            self.system.delete_file(plain)
        self.system.move(self.partial, plain)
        self.written.append((self.target + name, self.records))

    def __exit__(self, kind, error, trace):
        if kind is None and self.text is None and not self.written:
            self._begin()
        if self.text is not None:
            self._end(kind is None)
