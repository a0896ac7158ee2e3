"""Run one step: ``spark-submit … -m layerloom <step>`` or ``python -m layerloom <step>``.

Parameters come from the environment: WAREHOUSE (shared root folder), BRONZE_YEAR (comma-separated
years), BRONZE_LIMIT, BRONZE_LIMIT_POSTS and BRONZE_LIMIT_USERS (row caps, none by default). Master,
catalog and storage settings belong to the submit command.
"""

from __future__ import annotations

import argparse
import os

from layerloom.config import Config, build_session
from layerloom.operators.audit import table_report
from layerloom.plans import bronze, gold, pipeline, serving, silver
from layerloom.schemas import USER_COLUMNS_NARROW
from layerloom.sources import tables
from layerloom.sources.files import read_entity, read_years, rows_per_file, yearly_path

YEAR_FOLDER = "/year={year}"


def _report(spark, *names):
    table_report(spark, names).show(len(names), truncate=False)


def _list(spark, paths):
    for row in rows_per_file(spark, paths).orderBy("file_path").toLocalIterator():
        print(*(row[c] for c in ("file_path", "n_bytes", "n_rows", "error")), sep="\t")


def _bronze_paths(cfg, *entities):
    return [yearly_path(cfg.bronze(e) + YEAR_FOLDER, y) for e in entities for y in cfg.years]


def ingest_posts(spark, cfg, args):
    for year in cfg.years:
        posts = read_entity(spark, yearly_path(args.source, year))
        bronze.ingest_posts(posts, cfg.bronze("posts"), year, cfg.limit_posts)
    _list(spark, _bronze_paths(cfg, "posts"))


def ingest_users(spark, cfg, args):
    users = read_entity(spark, args.source, USER_COLUMNS_NARROW if args.narrow else None)
    bronze.ingest_years(users, cfg.bronze("users"), cfg.years, cfg.limit_users)
    _list(spark, _bronze_paths(cfg, "users"))


def _years(spark, cfg, entity):
    return read_years(spark, cfg.bronze(entity) + YEAR_FOLDER, cfg.years)


def build_users(spark, cfg, args):
    silver.build_users(spark, cfg, _years(spark, cfg, "users"))
    _report(spark, cfg.users_table)


def build_posts(spark, cfg, args):
    silver.build_posts(spark, cfg, _years(spark, cfg, "posts"))
    _report(spark, cfg.posts_table)


def rebuild_posts(spark, cfg, args):
    silver.rebuild_posts_light(spark, cfg, _years(spark, cfg, "posts"))
    _report(spark, cfg.posts_table)


def register(spark, cfg, args):
    silver.register(spark, cfg, cfg.posts_table, _years(spark, cfg, "posts"))
    silver.register(spark, cfg, cfg.users_table, _years(spark, cfg, "users"))
    _report(spark, cfg.posts_table, cfg.users_table)


def build_gold(spark, cfg, args):
    gold.build_gold(spark, cfg).show(5, truncate=False)
    _report(spark, cfg.gold_table)


def build_layers(spark, cfg, args):
    pipeline.build_layers(spark, cfg, run=args.run).show(5, truncate=False)
    _report(spark, cfg.posts_table, cfg.users_table, cfg.gold_table)


def top(spark, cfg, args):
    posts, users = silver.read_table(spark, cfg.posts_table), silver.read_table(spark, cfg.users_table)
    serving.top_owners(posts, users).show(20, truncate=False)


def audit(spark, cfg, args):
    _report(spark, cfg.posts_table, cfg.users_table, cfg.gold_table)


def recover(spark, cfg, args):
    for name in (cfg.posts_table, cfg.users_table, cfg.gold_table):
        print(name, "finished" if tables.recover(spark, name, cfg.tables_root) else "nothing to do", sep="\t")


def list_bronze(spark, cfg, args):
    _list(spark, _bronze_paths(cfg, "posts", "users"))


STEPS = {
    "ingest-posts": ingest_posts,
    "ingest-users": ingest_users,
    "build-users": build_users,
    "build-posts": build_posts,
    "rebuild-posts": rebuild_posts,
    "register": register,
    "build-gold": build_gold,
    "build-layers": build_layers,
    "top-owners": top,
    "audit": audit,
    "list-bronze": list_bronze,
    "recover": recover,
}


def main(argv=None) -> None:
    parser = argparse.ArgumentParser(prog="layerloom")
    parser.add_argument("step", choices=STEPS)
    parser.add_argument("--source", help="raw file; posts take {year} in the name")
    parser.add_argument("--run", help="build-layers: name of a run that goes on where it stopped")
    parser.add_argument("--narrow", action="store_true", help="users: Id, date and reputation only")
    args = parser.parse_args(argv)
    cfg = Config.from_env(os.environ)
    STEPS[args.step](build_session(f"layerloom {args.step}", cfg), cfg, args)


if __name__ == "__main__":
    main()
