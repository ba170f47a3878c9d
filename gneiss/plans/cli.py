"""Command line over an archive folder: setup, capture, catalog, plan, discover, sync, backfill, ingest, retry, listed, status, references, verify.

Exit codes: 0 done, 2 partial, 3 bad request.
"""

from __future__ import annotations

import argparse
import json
import sys
from datetime import UTC, datetime

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from gneiss.operators import registry
from gneiss.plans import acquisition
from gneiss.sources import client, portal, readers, regulations, sinks
from gneiss.streaming import incremental


def parser() -> argparse.ArgumentParser:
    """The verbs and their options."""
    out = argparse.ArgumentParser(prog="gneiss")
    out.add_argument("--root", required=True, help="folder of the registry's tables")
    verbs = out.add_subparsers(dest="verb", required=True)
    verbs.add_parser("setup")
    v = verbs.add_parser("capture")
    v.add_argument("--config", help="TOML settings: timeout_seconds, request_delay_seconds, retries")
    v.add_argument("--urls", required=True, help="JSON lines of url, and group, type_id, year, page where known")
    v.add_argument("--pages", required=True, help="folder of captured pages")
    v.add_argument("--agent", default="gneiss")
    v = verbs.add_parser("catalog")
    v.add_argument("--pages", required=True, help="folder of captured pages")
    v.add_argument("--base", required=True)
    for name in ("plan", "discover", "sync", "backfill"):
        v = verbs.add_parser(name)
        v.add_argument("--config", help="TOML settings: pilot_year, overlap_years")
        v.add_argument("--current-year", type=int, default=datetime.now(UTC).year)
        v.add_argument("--pages", required=True, help="folder of captured pages")
        v.add_argument("--base", required=True)
        v.add_argument("--group", default="pusat")
        v.add_argument("--type", action="append", dest="types")
        v.add_argument("--all", action="store_true")
        v.add_argument("--from-year", type=int)
        v.add_argument("--to-year", type=int)
        v.add_argument("--fresh", action="store_true")
        v.add_argument("--max-pages", type=int, default=0, help="pages of a partition; beyond them it stays incomplete")
    for name in ("ingest", "retry", "listed"):
        v = verbs.add_parser(name)
        if name == "listed":
            v.add_argument("--documents", required=True, help="Parquet of source_id, detail_url, title_hint")
            v.add_argument("--year", type=int, required=True)
        else:
            v.add_argument("--run-id", type=int, required=True)
        v.add_argument("--config", help="TOML settings: reserve_bytes")
        v.add_argument("--pages", required=True)
        v.add_argument("--payloads", required=True, help="Parquet of source_url, content, content_type")
        v.add_argument("--types", required=True, help="Parquet of the types that were selected")
        v.add_argument("--limit", type=int, default=0)
    v = verbs.add_parser("status")
    v.add_argument("--run-id", type=int)
    v.add_argument("--output", help="file for the report as JSON")
    verbs.add_parser("references")
    verbs.add_parser("verify").add_argument("--objects", help="folder of stored contents; the archive's own if not given")
    return out


def selected(spark: SparkSession, a: argparse.Namespace):
    """The verified types of a request; ValueError for unknown ids or years that don't fit."""
    if a.all == (a.from_year is not None or a.to_year is not None):
        raise ValueError("either --all or a range of years")
    if not a.all and (a.from_year is None or a.to_year is None or a.from_year > a.to_year):
        raise ValueError("a range needs both years, in order")
    pages = spark.read.format("captured_pages").load(a.pages)
    types = regulations.catalog_types(pages.where("page IS NULL AND group IS NOT NULL"), a.base)
    types = types.where(F.col("group") == a.group)
    if a.types and (wrong := [r[0] for r in registry.unknown_ids(spark, a.types, types).collect()]):
        raise ValueError("unknown types: " + ", ".join(wrong))
    found = registry.in_scope(types, a.group, a.types)
    if not found.limit(1).count():
        raise ValueError("no verified type in the scope")
    return pages, found


def run(spark: SparkSession, argv: list[str]) -> int:
    """One command; prints JSON lines."""
    a = parser().parse_args(argv)
    portal.register(spark)
    archive = acquisition.Archive(spark, a.root)
    now = datetime.now(UTC).isoformat()
    show = lambda df: [print(r) for r in df.toJSON().collect()]
    try:
        if a.verb == "setup":
            with archive.writing():
                archive.write({n: df for n, df in archive.read().items() if not archive.tables[n].versions()})
            print(json.dumps({"tables": len(archive.tables)}))
            return 0
        if a.verb == "capture":
            config = readers.load_config(a.config)
            polite = client.Client(a.agent, config.request_delay_seconds, config.timeout_seconds, config.retries)
            with open(a.urls, encoding="utf-8") as f:
                counts = client.capture(polite, (json.loads(line) for line in f if line.strip()), a.pages)
            print(json.dumps(counts))
            return 2 if counts["failed"] else 0
        if a.verb == "catalog":
            pages = spark.read.format("captured_pages").load(a.pages)
            show(regulations.catalog_types(pages.where("page IS NULL AND group IS NOT NULL"), a.base).orderBy("group", "type_id"))
            return 0
        if a.verb in ("plan", "discover", "sync", "backfill"):
            config = readers.load_config(a.config)
            if a.verb == "sync":  # the years around now are observed again
                years = incremental.sync_scope(config, a.current_year)
                a.from_year, a.to_year, a.all, a.fresh = years["from_year"], years["to_year"], False, True
            elif a.verb == "backfill" and not a.all:
                a.from_year, a.to_year = a.from_year or config.pilot_year, a.to_year or a.current_year
            pages, types = selected(spark, a)
            if a.verb == "plan":
                show(registry.plan(types, None if a.all else a.from_year, a.to_year))
                return 0
            kept = [r.asDict() for r in types.select("group", "type_id", "name", "reported_total").orderBy("type_id").collect()]
            scope = {"groups": [a.group], "types": kept, "all_years": a.all, "from_year": a.from_year, "to_year": a.to_year, "query": None}
            if a.max_pages < 0:
                raise ValueError("a bound of pages can't be negative")
            pages = pages.where(F.col("page") <= a.max_pages) if a.max_pages else pages.where("page IS NOT NULL")
            with archive.writing():
                number, changed = acquisition.discover_run(archive.read(), scope, types, pages, a.base, now, fresh=a.fresh)
                archive.write(changed)
            state = archive.read()["acquisition_runs"].where(F.col("id") == number).first()
            print(json.dumps({"run_id": number, "status": state.status, "frozen_at": state.frozen_at}))
            return 0 if state.frozen_at else 2
        if a.verb in ("ingest", "retry", "listed"):
            if a.limit < 0:
                raise ValueError("a limit can't be negative")
            with archive.writing():
                archive.guard(readers.load_config(a.config).reserve_bytes)
                if a.verb == "listed":
                    a.run_id, changed = acquisition.listed_run(archive.read(), spark.read.parquet(a.documents), a.year, now, a.limit)
                    archive.write(changed)
                return _ingest(spark, archive, a, now)
        tables = archive.read()
        if a.verb == "status":
            report = acquisition.status(tables, a.run_id)
            show(report)
            if a.output:
                sinks.write_json(json.loads(report.toJSON().first()), a.output)
        elif a.verb == "references":
            show(acquisition.references(tables))
        else:
            result = acquisition.verify(tables, readers.read_stored(spark, a.objects).select("sha256", "content") if a.objects else archive.stored())
            show(result)
            r = result.first()
            return 0 if r.missing == r.bad == 0 else 2
        return 0
    except ValueError as e:
        print(f"error: {e}", file=sys.stderr)
        return 3


def _ingest(spark: SparkSession, archive: acquisition.Archive, a: argparse.Namespace, now: str) -> int:
    archive.recover(now)
    tables = archive.read()
    if not tables["acquisition_runs"].where((F.col("id") == a.run_id) & F.col("frozen_at").isNotNull()).limit(1).count():
        raise ValueError("the run is unknown or not frozen")
    pages = spark.read.format("captured_pages").load(a.pages)
    outcomes, changed = acquisition.ingest_run(tables, a.run_id, spark.read.parquet(a.types), pages.select("url", "html"), spark.read.parquet(a.payloads), now, a.verb == "retry", a.limit)
    archive.write(changed)
    state = archive.read()["acquisition_runs"].where(F.col("id") == a.run_id).first().status
    print(json.dumps({"run_id": a.run_id, "status": state}))
    return 0 if state == "complete" else 2


def main() -> None:
    sys.exit(run(SparkSession.builder.appName("gneiss").getOrCreate(), sys.argv[1:]))


if __name__ == "__main__":
    main()
