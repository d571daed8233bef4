"""Runs one job on tables of files: spark-submit run_job.py <job> ...

    session  --actions A --users U                 --out O --params '{"startDate": ...}'
    page     --actions A                           --out O --params '{..., "targetPageFlow": "1,2"}'
    area     --actions A --products P [--cities C] --out O --params '{...}'
    ads      --brokers B --topic T | --feed F      --out O --checkpoint K

Tables are Parquet folders, or catalog tables with --catalog. The batch jobs append to one
table per result; --jdbc-url sends the results to a database instead.
"""

from __future__ import annotations

import argparse
import json
import uuid

from clickloom.operators.ads import DEFAULT_THRESHOLD
from clickloom.operators.sessions import SessionFilter
from clickloom.plans.jobs import area_job, page_job, session_job, write_results
from clickloom.session import build_session
from clickloom.sources import tables
from clickloom.sources.adlog import file_lines, kafka_lines
from clickloom.sources.cities import city_dimension
from clickloom.streaming.ads import start_ad_job
from clickloom.streaming.tables import AdTables


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__.split("\n")[0])
    parser.add_argument("job", choices=("session", "page", "area", "ads"))
    for name in ("actions", "users", "products", "cities", "brokers", "topic", "feed",
                 "checkpoint", "jdbc-url", "jdbc-user", "jdbc-password"):
        parser.add_argument(f"--{name}")
    parser.add_argument("--out")
    parser.add_argument("--params", type=json.loads, default={})
    parser.add_argument("--task-id", default=None)
    parser.add_argument("--sample", type=int, default=100)
    parser.add_argument("--seed", default="")
    parser.add_argument("--threshold", type=int, default=DEFAULT_THRESHOLD)
    parser.add_argument("--catalog", action="store_true")
    parser.add_argument("--until-caught-up", action="store_true", help="ads: stop at the feed's end")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    args = _arguments(argv)
    if args.job == "ads" and args.jdbc_url:
        raise SystemExit("ads: results go to keyed tables of files in --out, not to a database")
    spark = build_session(f"clickloom-{args.job}")
    if args.job == "ads":
        lines = (
            file_lines(spark, args.feed) if args.feed
            else kafka_lines(spark, args.brokers, args.topic)
        )
        start_ad_job(
            lines, AdTables(args.out), args.checkpoint, args.threshold, args.until_caught_up
        ).awaitTermination()
        return

    fmt = None if args.catalog else "parquet"
    actions = tables.read_actions(spark, args.actions, fmt)
    task_id = args.task_id or str(uuid.uuid4())
    first, last = args.params["startDate"], args.params["endDate"]
    if args.job == "session":
        job = session_job(
            actions, tables.read_users(spark, args.users, fmt), task_id, first, last,
            SessionFilter.from_params(args.params), args.sample, args.seed,
        ).persist()
        _write(job.results, args)
        job.unpersist()
    elif args.job == "page":
        _write(page_job(actions, task_id, first, last, args.params["targetPageFlow"]), args)
    else:
        cities = (
            tables.read_table(spark, args.cities, fmt) if args.cities else city_dimension(spark)
        )
        products = tables.read_products(spark, args.products, fmt)
        _write(area_job(actions, cities, products, task_id, first, last), args)


def _write(results, args: argparse.Namespace) -> None:
    if args.jdbc_url:
        write_results(
            results, args.jdbc_url, "jdbc", user=args.jdbc_user, password=args.jdbc_password
        )
    else:
        write_results(results, args.out)


if __name__ == "__main__":
    main()
