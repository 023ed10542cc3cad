"""Command line: one job per layer, for ``spark-submit`` or ``python -m tidelake.jobs``.

    bronze   --database DB --table T --lake DIR --ds_date DAY [--query Q] [--write_mode M]
    backfill --database DB --table T --lake DIR --from DAY --ds_date DAY
    silver   --table T --lake DIR [--is_incremental --ds_date DAY] [--primary_key K] [--write_mode M]
             [--refresh --ds_date DAY] [--buckets N]
    history  --table T --lake DIR
    stream   --table T --lake DIR --progress DIR
    gold     --lake DIR --ds_date DAY [--as_of DAY]
    report   --lake DIR --ds_date DAY
    preview  --table T --lake DIR --ds_date DAY
    errors   --table T --lake DIR
    run      --database DB --lake DIR --ds_date DAY

Flag names are fixed values: schedulers call the jobs by them.
"""

from __future__ import annotations

import argparse
from collections.abc import Mapping, Sequence
from dataclasses import replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidelake.plans import bronze, gold, history, medallion, report, silver
from tidelake.sinks.lake import MODES
from tidelake.sources.jdbc import jdbc_scan, sqlite_options
from tidelake.sources.lake import describe_columns, preview, read_errors, silver_tables
from tidelake.sources.sqlite import sqlite_scan
from tidelake.specs import LOAD_DATE, SALES, TableSpec, wide_sales
from tidelake.streaming.orders import replace_touched_days
from tidelake.workspace import tune


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="tidelake")
    commands = parser.add_subparsers(dest="command", required=True)

    def command(name: str, *flags: str) -> argparse.ArgumentParser:
        sub = commands.add_parser(name)
        sub.add_argument("--lake", required=True, help="root folder of bronze, silver and gold")
        sub.add_argument("--wide", action="store_true", help="BIGINT ids")
        for flag in flags:
            sub.add_argument(flag, required=True)
        return sub

    def source(sub: argparse.ArgumentParser) -> None:
        sub.add_argument("--reader", choices=("sqlite", "jdbc"), default="sqlite")
        sub.add_argument("--num_partitions", type=int, default=1)
        sub.add_argument("--partition_column", help="unique column to split the source scan on")

    load = command("bronze", "--database", "--table", "--ds_date")
    source(load)
    load.add_argument("--query", default="")
    load.add_argument("--write_mode", choices=MODES)
    wrong = load.add_mutually_exclusive_group()
    wrong.add_argument("--lenient", action="store_true", help="NULL for malformed values")
    wrong.add_argument("--rejects", action="store_true", help="keep rows with malformed values apart, in rejects/")
    past = command("backfill", "--database", "--table", "--from", "--ds_date")
    source(past)
    wrong = past.add_mutually_exclusive_group()
    wrong.add_argument("--lenient", action="store_true", help="NULL for malformed values")
    wrong.add_argument("--rejects", action="store_true", help="keep rows with malformed values apart, in rejects/")
    command("stream", "--table", "--progress")
    clean = command("silver", "--table")
    clean.add_argument("--write_mode", choices=MODES, help="of a table loaded by day")
    clean.add_argument("--is_incremental", action="store_true")
    clean.add_argument("--primary_key", action="append", help="repeat for a composite key")
    clean.add_argument("--ds_date")
    clean.add_argument("--refresh", action="store_true", help="merge one new snapshot only")
    clean.add_argument("--buckets", type=int, help="keep a snapshot table in so many buckets of its key")
    command("history", "--table")
    command("gold", "--ds_date").add_argument("--as_of", type=date.fromisoformat)
    command("report", "--ds_date")
    command("preview", "--table", "--ds_date")
    command("errors", "--table")
    source(command("run", "--database", "--ds_date"))
    return parser


def _source(
    spark: SparkSession,
    args: argparse.Namespace,
    table: str,
    query: str,
    schema: T.StructType | None,
) -> DataFrame:
    """The table as the source has it; SQLite values are parsed to ``schema`` if given."""
    known = SALES.get(table) if args.num_partitions > 1 else None
    options = {
        "query": query or None,
        "partition_column": args.partition_column or (known.split_column if known else None),
        "num_partitions": args.num_partitions,
    }
    if args.reader == "jdbc":
        return jdbc_scan(spark, sqlite_options(args.database), table, **options)
    return sqlite_scan(spark, args.database, table, schema=schema, **options)


def _stored_spec(spark: SparkSession, args: argparse.Namespace, bronze_root: str) -> TableSpec:
    """The spec of a table outside the catalogue, from its bronze files."""
    stored = spark.read.parquet(f"{bronze_root}/{args.table}").schema
    columns = T.StructType([f for f in stored.fields if f.name != LOAD_DATE])
    return TableSpec(
        args.table,
        columns,
        key=tuple(args.primary_key or ()),
        day_column=LOAD_DATE if args.is_incremental else None,
    )


def _silver_spec(
    spark: SparkSession, args: argparse.Namespace, specs: Mapping[str, TableSpec], bronze_root: str
) -> TableSpec:
    """The table's spec, with the key that is asked for."""
    spec = specs.get(args.table) or _stored_spec(spark, args, bronze_root)
    if args.is_incremental and not spec.incremental:
        raise SystemExit(f"{spec.name} is loaded by snapshots; it has no day column")
    if spec.incremental and args.primary_key or not spec.incremental and args.write_mode:
        raise SystemExit("--primary_key is for snapshots, --write_mode for tables loaded by day")
    return replace(spec, key=tuple(args.primary_key)) if args.primary_key else spec


def main(argv: Sequence[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    specs = wide_sales() if args.wide else SALES
    spark = tune(SparkSession.builder.appName(f"tidelake-{args.command}").getOrCreate())
    bronze_root, silver_root, gold_root = (
        f"{args.lake}/{layer}" for layer in ("bronze", "silver", "gold")
    )
    given = getattr(args, "ds_date", None)
    day = date.fromisoformat(given) if given else None

    if args.command == "bronze":
        spec = specs.get(args.table)
        # Lenient casts need the values as text; so do tables of unknown types.
        schema = spec.schema if spec and not args.lenient and not args.rejects else None
        source = _source(spark, args, args.table, args.query, schema)
        spec = spec or TableSpec(args.table, source.schema)
        mode = args.write_mode or "overwrite"
        if args.rejects and mode != "overwrite":
            raise SystemExit("--rejects replaces the day; it has no append")
        rejects = f"{args.lake}/rejects" if args.rejects else None
        print(bronze.load(source, spec, bronze_root, day, mode, args.lenient, rejects))
    elif args.command == "silver":
        spec = _silver_spec(spark, args, specs, bronze_root)
        if (spec.incremental or args.refresh) and day is None:
            raise SystemExit("--ds_date is needed")
        if spec.incremental:
            mode = args.write_mode or "overwrite"
            print(silver.incremental(spark, spec, bronze_root, silver_root, day, mode=mode))
        elif args.refresh:
            print(silver.refresh(spark, spec, bronze_root, silver_root, day, buckets=args.buckets))
        else:
            print(silver.full_load(spark, spec, bronze_root, silver_root, buckets=args.buckets))
    elif args.command == "backfill":
        spec, first = specs[args.table], date.fromisoformat(getattr(args, "from"))
        as_text = args.lenient or args.rejects
        source = _source(spark, args, args.table, "", None if as_text else spec.schema)
        rejects = f"{args.lake}/rejects" if args.rejects else None
        print(bronze.backfill(source, spec, bronze_root, first, day, args.lenient, rejects))
    elif args.command == "stream":
        spec = specs[args.table]
        replace_touched_days(spark, spec, bronze_root, silver_root, args.progress).awaitTermination()
    elif args.command == "gold":
        tables = silver_tables(spark, silver_root, specs)
        if args.as_of is not None:
            for spec in specs.values():
                if not spec.incremental:
                    print(history.refresh(spark, spec, bronze_root, f"{args.lake}/history"))
            tables = history.tables_as_of(spark, specs, silver_root, f"{args.lake}/history", args.as_of)
        for path in gold.build(tables, gold_root, day):
            print(path)
    elif args.command == "history":
        print(history.refresh(spark, specs[args.table], bronze_root, f"{args.lake}/history"))
    elif args.command == "report":
        # A report on half a lake is an error, as gold itself is.
        silver_tables(spark, silver_root, specs)
        report.store(spark, gold_root, f"{args.lake}/report", day).show(truncate=False)
    elif args.command == "preview":
        spec = specs.get(args.table) or TableSpec(
            args.table, spark.read.parquet(f"{bronze_root}/{args.table}").drop(LOAD_DATE).schema
        )
        head = preview(spark, spec, f"{bronze_root}/{args.table}", day, ordered=False)
        describe_columns(head).show(truncate=False)
        head.show(truncate=False)
    elif args.command == "errors":
        read_errors(spark, f"{bronze_root}/{args.table}").show(1000, truncate=False)
    elif args.command == "run":
        sources = {
            name: _source(spark, args, name, spec.query, spec.schema)
            for name, spec in specs.items()
        }
        for audit in medallion.run(spark, sources, args.lake, day, specs):
            print(audit)


if __name__ == "__main__":
    main()
