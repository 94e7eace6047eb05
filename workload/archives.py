"""Monthly archives made of the driver's tables, as the landing folder would get them."""

from __future__ import annotations

import codecs
import uuid
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from invoice_lake.session import shared_folder, shuffles_dropped
from invoice_lake.sources import layers
from workload import views

MEMBERS = {"nf": "NFe_NotaFiscal.csv", "itens": "NFe_NotaFiscalItem.csv", "eventos": "NFe_NotaFiscalEvento.csv"}


def raw_invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invoice rows under the raw file's headers, in the months of the items."""
    return views.table(spark, sf_dir, "orders").select(*[F.expr(e).alias(name) for name, e in {
        "CHAVE DE ACESSO": "lpad(cast(o_orderkey as string), 44, '0')",
        "NÚMERO": "cast(o_orderkey as string)",
        "DATA EMISSÃO": "date_format(o_orderdate, 'dd/MM/yyyy')",
        "NATUREZA DA OPERAÇÃO": "concat(o_orderpriority, '; \"', o_orderstatus, '\"\\nfim')",
        "VALOR NOTA FISCAL": "replace(cast(cast(o_totalprice as decimal(18,2)) as string), '.', ',')",
        "periodo": "date_format(o_orderdate, 'yyyy-MM')",
    }.items()])


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two events of every finished order."""
    orders = views.table(spark, sf_dir, "orders").where("o_orderstatus = 'F'")
    return orders.select(*[F.expr(e).alias(name) for name, e in {
        "CHAVE DE ACESSO": "lpad(cast(o_orderkey as string), 44, '0')",
        "DATA EMISSÃO": "date_format(o_orderdate, 'dd/MM/yyyy')",
        "EVENTO": "explode(array('Autorização', 'Cancelamento'))",
        "periodo": "date_format(o_orderdate, 'yyyy-MM')",
    }.items()])


def broken_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First lines whose last field is followed by one too many."""
    items = views.raw_items(spark, sf_dir).where("`NÚMERO PRODUTO` = '1'")
    return items.withColumn("A MAIS", F.lit("x"))


def _lines(df: DataFrame) -> DataFrame:
    fields = [F.concat(F.lit('"'), F.replace(F.coalesce(F.col(f"`{c}`"), F.lit("")), F.lit('"'), F.lit('""')), F.lit('"'))
              for c in df.columns if c != "periodo"]
    return df.select(F.concat_ws(";", *fields).alias("linha"), F.replace("periodo", F.lit("-"), F.lit("")).alias("periodo"))


def deliver(
    spark: SparkSession, landing: str, name: str, tables: dict[str, DataFrame], broken: DataFrame | None = None
) -> None:
    """One zip per month, <landing>/YYYYMM_<name>.zip, with a member per table; ``broken`` are further records of the items.

    The lines are written by all tasks, compressed; then each archive is put together by one task, which streams its parts.
    Nothing but the archives stays on disk.
    """
    landing, parts = (layers.qualified(spark, path) for path in (landing, shared_folder(spark, "partes")))
    months = None
    for table, df in tables.items():
        lines = _lines(df)
        if table == "itens" and broken is not None:
            lines = lines.union(_lines(broken))
        with shuffles_dropped(spark):
            lines.hint("rebalance", "periodo").write.partitionBy("periodo").options(
                lineSep="\r\n", compression="gzip").text(f"{parts}/{table}")
        months = df.select("periodo") if months is None else months.union(df.select("periodo"))
    headers = {table: ";".join(f'"{c}"' for c in df.columns if c != "periodo") for table, df in tables.items()}
    todo = months.select(F.replace("periodo", F.lit("-"), F.lit("")).alias("periodo")).distinct()

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for month in batch["periodo"]:
                _zip(f"{landing}/{month}_{name}.zip", {
                    f"{month}_{MEMBERS[table]}": (header, f"{parts}/{table}/periodo={month}") for table, header in headers.items()})
                yield pd.DataFrame({"periodo": [month]})

    todo.repartition("periodo").mapInPandas(pack, "periodo string").count()
    layers.delete_folder(spark, parts)


def _plain(path: str) -> tuple[arrow_fs.FileSystem, str]:
    if path.startswith("file:"):
        return arrow_fs.LocalFileSystem(), "/" + path[len("file:"):].lstrip("/")
    return arrow_fs.FileSystem.from_uri(path)


def _zip(target: str, members: dict[str, tuple[str, str]]) -> None:
    system, plain = _plain(target)
    folder, name = plain.rsplit("/", 1)
    system.create_dir(folder, recursive=True)
    partial = f"{folder}/_{name}.{uuid.uuid4().hex}"
    with system.open_output_stream(partial) as out, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
        for member, (header, source) in members.items():
            files = system.get_file_info(arrow_fs.FileSelector(_plain(source)[1], allow_not_found=True))
            recode = codecs.getincrementaldecoder("utf-8")()
            with archive.open(member, "w", force_zip64=True) as text:
                text.write(f"{header}\r\n".encode("latin-1"))
                for part in sorted(f.path for f in files if f.path.endswith(".txt.gz")):
                    with system.open_input_stream(part, compression="gzip") as lines:
                        for block in iter(lambda: lines.read(1 << 20), b""):
                            text.write(recode.decode(block).encode("latin-1"))
                    text.write(recode.decode(b"", final=True).encode("latin-1"))
    system.move(partial, plain)
