"""Batch run: python -m invoice_lake load|reports --root DIR ... (--help lists the options)"""

from __future__ import annotations

import argparse
import logging
from collections.abc import Sequence

from invoice_lake.plans import lake
from invoice_lake.session import build_session
from invoice_lake.sources import layers, mappings


def _arguments(argv: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="invoice_lake", description="The invoice lake's batch jobs.")
    jobs = parser.add_subparsers(dest="job", required=True)
    load = jobs.add_parser("load", help="load new archives and rebuild the marts")
    load.add_argument("--landing", required=True, help="folder with the monthly archives")
    load.add_argument("--staging", required=True, help="folder for unpacked files, shared by all executors")
    load.add_argument("--chain-map", help="Parquet table of production chains")
    reports = jobs.add_parser("reports", help="write the reports over the loaded lake")
    reports.add_argument("--group-b", help="CSV of keywords instead of the built-in ones")
    reports.add_argument("--steel", help="CSV ncm_cod,grupo instead of the built-in steel groups")
    reports.add_argument("--signs", help="CSV cfop,sinal; adds the signed totals")
    reports.add_argument("--presence", help="Parquet table of companies abroad; adds the supplier report")
    for job in (load, reports):
        job.add_argument("--root", required=True, help="folder of the lake")
        job.add_argument("--group-a", help="CSV tipo,ncm instead of the built-in product types")
    return parser.parse_args(argv)


def main(argv: Sequence[str] | None = None) -> None:
    args = _arguments(argv)
    logging.basicConfig(level=logging.INFO, format="[%(asctime)s] %(message)s")
    spark = build_session()
    given = lambda name, reader: reader(spark, getattr(args, name)) if getattr(args, name) else None
    group_a = given("group_a", mappings.read_group_a)
    group_a = mappings.group_a(spark) if group_a is None else group_a
    if args.job == "load":
        chains = given("chain_map", mappings.read_chain_map)
        lake.load_bronze(spark, args.landing, args.root, args.staging)
        lake.load_silver(spark, args.root)
        lake.build_gold(spark, args.root, group_a, chains)
        return
    items, invoices = (
        layers.read_table(spark, args.root, "silver", table, schema=layers.silver_schema(table)) for table in ("itens", "nf"))
    tables = {}
    if items is not None:
        tables |= lake.item_reports(
            spark, items, group_a, given("group_b", mappings.read_group_b), given("steel", mappings.read_prefix_groups),
            given("signs", mappings.read_signs))
    if invoices is not None:
        raw = layers.read_table(spark, args.root, "bronze", "nf")
        tables |= lake.invoice_reports(invoices, given("presence", mappings.read_presence), raw)
    lake.publish(spark, args.root, tables)


if __name__ == "__main__":
    main()
