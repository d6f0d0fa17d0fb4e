"""Run one stage on stored tables; for spark-submit.

    run.py report   --tables T
    run.py audit    --tables T
    run.py discover --tables T --seeds FILE --bodies PATH --as-of TIME --out NEW
    run.py fetch    --tables T --log PATH --as-of TIME --out NEW
    run.py extract  --tables T --out NEW
    run.py embed    --tables T --out NEW
    run.py batch    --tables T --mode create|check|status|full --as-of TIME --out NEW ...

Tables live in one folder each under ``--tables``. A stage writes the next
version of every table it changes, and its outcome rows, under ``--out``, which
must not hold them yet; tables it leaves alone are not copied. Inputs fetched
elsewhere (sitemap bodies, responses, job statuses and results) are given as
parquet or JSON-lines paths. Reports are printed whole, and written too where
``--out`` is given. Request lines are written as text, a folder per batch.
"""

from __future__ import annotations

import argparse
import datetime as dt
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from presslake import configure
from presslake.operators.numbering import report_row_number
from presslake.plans import discover, embed, extract, fetch, reports
from presslake.functions.predicates import MIN_CONTENT_LENGTH
from presslake.operators.audit import EMBEDDING_DIM, constraint_audit
from presslake.operators.batches import write_batch_requests
from presslake.operators.queues import EMBED_LIMIT, PAGES_PER_DOMAIN
from presslake.schemas import BODIES, FETCH_LOG, REGISTRY, STATUSES
from presslake.sources import jobs, seeds
from presslake.sources.tables import crawl_tables_scan, write_snapshot


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines with the declared columns, or Parquet."""
    return spark.read.schema(schema).json(path) if path.endswith((".json", ".jsonl")) else spark.read.parquet(path)


def _show(title: str, df: DataFrame) -> None:
    """Print every row, one batch of rows at a time, and how many there were."""
    print(title)
    print("\t".join(df.columns))
    n = 0
    for n, row in enumerate(df.toLocalIterator(), 1):
        print("\t".join("" if v is None else str(v) for v in row))
    print(f"({n} rows)")


def _hook(name: str | None):
    """A function named as ``module:name``."""
    if name is None:
        return None
    module, _, function = name.partition(":")
    return getattr(import_module(module), function)


def report(spark: SparkSession, args: argparse.Namespace) -> None:
    made = reports.report(*crawl_tables_scan(spark, args.tables).values())
    whole = {
        "monthly": report_row_number(made["monthly"], [made["monthly"].domain.asc(), made["monthly"].month.desc()]),
        "domains": report_row_number(made["domains"], [made["domains"].domain.asc()]), "summary": made["summary"],
    }
    titles = {"monthly": "Texts per domain and month", "domains": "Pages per domain", "summary": "All pages"}
    for name, df in whole.items():
        if args.out:
            write_snapshot(df, f"{args.out}/report_{name}")
            df = spark.read.parquet(f"{args.out}/report_{name}")
        _show(titles[name], df.orderBy(df.columns[0]) if "row_no" in df.columns else df)


def audit(spark: SparkSession, args: argparse.Namespace) -> None:
    """Broken keys, references and required values by rule; with ``--out`` every violation is written."""
    broken = constraint_audit(crawl_tables_scan(spark, args.tables), args.dim)
    if args.out:
        write_snapshot(broken, f"{args.out}/violations")
        broken = spark.read.parquet(f"{args.out}/violations")
    _show("Violations", broken.groupBy("table", "rule").count().orderBy("table", "rule"))


def run_discover(spark: SparkSession, args: argparse.Namespace) -> None:
    sitemaps, pages, _, _ = crawl_tables_scan(spark, args.tables).values()
    made = discover.discover(seeds.seed_scan(spark, args.seeds), _read(spark, args.bodies, BODIES), sitemaps, pages, args.as_of, args.months)
    write_snapshot(made.sitemaps, f"{args.out}/sitemaps")
    write_snapshot(made.pages, f"{args.out}/news_pages")
    write_snapshot(made.outcomes, f"{args.out}/discover_outcomes")
    outcomes = spark.read.parquet(f"{args.out}/discover_outcomes")
    _show("Discovery per domain", reports.discovery_stats(outcomes).orderBy("domain"))
    _show("Discovery in all", reports.discovery_totals(outcomes))
    _show("Sitemaps almost without dates", reports.sitemap_no_date_alert(outcomes).orderBy("sitemap_url"))


def run_fetch(spark: SparkSession, args: argparse.Namespace) -> None:
    sitemaps, pages, content, _ = crawl_tables_scan(spark, args.tables).values()
    made = fetch.fetch_apply(sitemaps, pages, content, _read(spark, args.log, FETCH_LOG), args.as_of, cap=args.cap)
    write_snapshot(made.content, f"{args.out}/news_pages_content")
    write_snapshot(made.pages, f"{args.out}/news_pages")
    write_snapshot(made.outcomes, f"{args.out}/fetch_outcomes")
    outcomes = spark.read.parquet(f"{args.out}/fetch_outcomes")
    _show("Fetching in all", reports.fetch_run_stats(outcomes))
    _show("Fetching per domain", reports.fetch_domain_stats(outcomes))


def run_extract(spark: SparkSession, args: argparse.Namespace) -> None:
    sitemaps, pages, content, _ = crawl_tables_scan(spark, args.tables).values()
    made = extract.extract(sitemaps, pages, content, _hook(args.fn))
    write_snapshot(made.content, f"{args.out}/news_pages_content")
    write_snapshot(made.outcomes, f"{args.out}/extract_outcomes")
    _show("Extraction", reports.extract_parser_stats(spark.read.parquet(f"{args.out}/extract_outcomes")))


def run_embed(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.fn is None and not args.stand_in:
        raise SystemExit("embed needs a model (--fn module:name), or --stand-in for hashed word counts")
    tables = crawl_tables_scan(spark, args.tables).values()
    made = embed.embed_sync(*tables, _hook(args.fn), min_len=args.min_len, limit=args.limit, dim=args.dim, codec=_hook(args.codec))
    write_snapshot(made.embeddings, f"{args.out}/content_embeddings")
    write_snapshot(made.outcomes, f"{args.out}/embed_outcomes")
    outcomes = spark.read.parquet(f"{args.out}/embed_outcomes")
    _show("Embedding in all", reports.embed_run_stats(outcomes))
    _show("Embedding per domain", reports.embed_domain_stats(outcomes))


def run_batch(spark: SparkSession, args: argparse.Namespace) -> None:
    tables = crawl_tables_scan(spark, args.tables)
    if args.registry and args.registry.endswith(".json"):
        registry = jobs.job_registry_scan(spark, args.registry)
    else:
        registry = spark.read.schema(REGISTRY).parquet(args.registry) if args.registry else spark.createDataFrame([], REGISTRY)
    if args.mode in ("create", "full"):
        created = embed.embed_batch_create(*tables.values(), registry, args.as_of, args.run_id, args.min_len, args.limit, codec=_hook(args.codec))
        write_batch_requests(created.requests, f"{args.out}/requests")
        registry = created.registry
    if args.mode in ("check", "full"):
        errors = jobs.batch_error_scan(spark, args.errors) if args.errors else None
        checked = embed.embed_batch_check(
            registry, _read(spark, args.statuses, STATUSES), jobs.batch_result_scan(spark, args.results), errors,
            tables["content_embeddings"], args.as_of, args.dim,
        )
        write_snapshot(checked.embeddings, f"{args.out}/content_embeddings")
        write_snapshot(checked.failures, f"{args.out}/batch_failures")
        write_snapshot(checked.counts, f"{args.out}/batch_counts")
        counts = spark.read.parquet(f"{args.out}/batch_counts")
        _show("Results per job", counts.orderBy("batch_id"))
        write_snapshot(embed.embed_batch_domains(checked.registry, counts), f"{args.out}/batch_domains")
        _show("Results per domain", spark.read.parquet(f"{args.out}/batch_domains").orderBy("domain"))
        registry = checked.registry
    if args.mode != "status":
        write_snapshot(registry, f"{args.out}/registry")
        registry = spark.read.parquet(f"{args.out}/registry")
    status = embed.embed_batch_status(registry, args.as_of)
    _show("Jobs", status["counts"])
    _show("Pending jobs", status["pending"])


STAGES = {
    "report": report, "audit": audit, "discover": run_discover, "fetch": run_fetch, "extract": run_extract, "embed": run_embed, "batch": run_batch,
}


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    args = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    args.add_argument("stage", choices=list(STAGES))
    args.add_argument("--tables", required=True)
    args.add_argument("--out")
    args.add_argument("--as-of", type=dt.datetime.fromisoformat)
    for name in ("seeds", "bodies", "log", "registry", "statuses", "results", "errors"):
        args.add_argument(f"--{name}")
    args.add_argument("--mode", choices=["create", "check", "status", "full"], default="full")
    args.add_argument("--run-id", default="job")
    args.add_argument("--cap", type=int, default=PAGES_PER_DOMAIN, help="pages per domain of a fetch run")
    args.add_argument("--months", type=int, default=12, help="months that a sitemap stays fresh")
    args.add_argument("--limit", type=int, default=EMBED_LIMIT, help="texts of an embedding run")
    args.add_argument("--min-len", type=int, default=MIN_CONTENT_LENGTH, help="characters of a text to embed")
    args.add_argument("--dim", type=int, default=EMBEDDING_DIM, help="values of a vector")
    args.add_argument("--fn", help="extractor or model, as module:name")
    args.add_argument("--codec", help="counts and cuts texts by a model's tokens, as module:name")
    args.add_argument("--stand-in", action="store_true", help="embed by hashed word counts, without a model")
    return args.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    args = parse(argv)
    STAGES[args.stage](configure(SparkSession.builder.appName(f"presslake-{args.stage}").getOrCreate()), args)


if __name__ == "__main__":
    main()
