"""Command line: chunk, index, build, query and doctor."""

from __future__ import annotations

import argparse
import json
import logging
import os
import re
import sys
import time
from contextlib import contextmanager

from pyspark.sql import SparkSession

from docloom.operators import chunking
from docloom.plans import knowledge_base as plans
from docloom.sources import readers

log = logging.getLogger("docloom")


@contextmanager
def phase(spark: SparkSession, name: str):
    """Logs how long a phase takes, and names its Spark jobs after it."""
    began = time.time()
    spark.sparkContext.setJobDescription(name)
    log.info("%s …", name)
    try:
        yield
    finally:
        spark.sparkContext.setJobDescription(None)
        seconds = int(time.time() - began)
        log.info("%s: %dm%02ds", name, *divmod(seconds, 60))


def resolved(path: str, folder: str) -> str:
    """A path as seen from a folder; absolute ones, and those of a file system that they name, stay as they are."""
    return path if os.path.isabs(path) or "://" in path else os.path.join(folder, path)


def settings_from(path: str | None) -> plans.Settings:
    """Settings from a JSON file of their names; unknown names are an error, ${VAR} stands for an environment variable. The source and target that a
    file names are seen from the file's folder."""
    if path is None:
        return plans.Settings()

    with open(path, encoding="utf-8") as file:
        text = file.read()
    missing = [v for v in re.findall(r"\$\{(\w+)\}", text) if v not in os.environ]
    if missing:
        raise ValueError(f"not set in the environment: {', '.join(sorted(set(missing)))}")
    given = json.loads(re.sub(r"\$\{(\w+)\}", lambda m: json.dumps(os.environ[m[1]])[1:-1], text))
    unknown = set(given) - set(plans.Settings.__dataclass_fields__)
    if unknown:
        raise ValueError(f"unknown settings: {', '.join(sorted(unknown))}")
    settings = plans.Settings(**given).checked()
    for name in ("source", "target"):
        if getattr(settings, name) is not None:
            setattr(settings, name, resolved(getattr(settings, name), os.path.dirname(os.path.abspath(path))))
    return settings


def chunked(spark: SparkSession, source: str, kind: str, settings: plans.Settings):
    sizes = (settings.target_tokens, settings.max_tokens, settings.prepend_breadcrumb)
    if kind == "chunks":
        return chunking.chunk_files(readers.chunk_directory(spark, source), *sizes)
    return chunking.chunk_documents(readers.markdown_files(spark, source), *sizes)


def main(arguments: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="docloom", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)
    for name in ("chunk", "build"):
        one = commands.add_parser(name)
        one.add_argument("source", nargs="?", help="by default that of the settings")
        one.add_argument("target", nargs="?", help="by default that of the settings")
        one.add_argument("--from", dest="kind", choices=["md", "chunks"], default="md")
    one = commands.add_parser("index")
    one.add_argument("source", help="a manifest of chunks that exists already")
    one.add_argument("target")
    one = commands.add_parser("query")
    one.add_argument("text")
    one.add_argument("--db", required=True)
    one.add_argument("--k", type=int)
    commands.add_parser("doctor").add_argument("--db")
    parser.add_argument("--settings")
    asked = parser.parse_args(arguments)
    logging.basicConfig(level=logging.INFO, format="%(message)s")
    settings = settings_from(asked.settings)
    if asked.command in ("chunk", "build"):
        asked.source, asked.target = asked.source or settings.source, asked.target or settings.target
        if not (asked.source and asked.target):
            parser.error("a source and a target are needed, as arguments or in the settings")
    spark = SparkSession.builder.appName("docloom").getOrCreate()
    if asked.command == "chunk":
        with phase(spark, "chunk"):
            chunked(spark, asked.source, asked.kind, settings).write.mode("overwrite").parquet(asked.target)
    elif asked.command == "build":
        with phase(spark, "build"):
            print(plans.build(spark, chunked(spark, asked.source, asked.kind, settings), asked.target, settings).toJSON().first())
    elif asked.command == "index":
        with phase(spark, "index"):
            known = readers.manifest(spark, asked.source).drop("refs_out", "refs_in", "mentioned_entities")
            print(plans.build(spark, known, asked.target, settings).toJSON().first())
    elif asked.command == "query":
        if asked.k is not None:
            settings.k = asked.k
        kb = readers.KnowledgeBase(spark, asked.db)
        found = plans.retrieve(kb, spark.createDataFrame([(0, asked.text)], "query_id long, text string"), settings)
        for row in plans.rendered(found).orderBy("rank").collect():  # k rows
            print(row["line"])
    else:
        return doctor(spark, asked.db)
    return 0


def doctor(spark: SparkSession, db: str | None) -> int:
    """A line for each check; 1 if one fails."""
    checks = {"spark": lambda: spark.range(3).count() == 3, "functions": lambda: spark.sql("SELECT regexp_count('a b', '[a-z]+') = 2").first()[0]}
    if db:
        checks["knowledge base"] = lambda: readers.KnowledgeBase(spark, db).entities is not None
    bad = 0
    for name, check in checks.items():
        try:
            good, why = bool(check()), ""
        except Exception as failure:  # a report, not a handler
            good, why = False, f": {failure}"
        bad += not good
        print(f"{'ok' if good else 'FAILED'} {name}{why[:200]}")
    return int(bad > 0)


if __name__ == "__main__":
    sys.exit(main())
