"""Command line, configuration and log of the jobs."""

from __future__ import annotations

import argparse
import logging
from collections.abc import Callable
from pathlib import Path
from typing import Any

import yaml
from pyspark.sql import SparkSession

Config = dict[str, Any]


def checked(config: Config, needed: set[str], known: set[str]) -> Config:
    """The configuration; what is missing or unknown is an error."""
    lacks, strange = sorted(needed - config.keys()), sorted(config.keys() - needed - known)
    if lacks or strange:
        raise ValueError("; ".join(f"{what}: {', '.join(x)}" for what, x in (("missing", lacks), ("unknown", strange)) if x))
    return config


def main(name: str, run: Callable[[SparkSession, Config], Config], argv: list[str] | None = None) -> None:
    """``CONFIG.yaml [--set KEY=VALUE ...]``: runs a job in a session of its own, which is stopped at the end."""
    parser = argparse.ArgumentParser(prog=f"python -m jobs.{name}", description=run.__doc__)
    parser.add_argument("config", help="YAML file")
    parser.add_argument("--set", action="append", default=[], metavar="KEY=VALUE", help="replaces a key of the file; the value is YAML")
    args = parser.parse_args(argv)
    config = yaml.safe_load(Path(args.config).read_text()) or {}
    config |= {k: yaml.safe_load(v) for k, v in (x.split("=", 1) for x in args.set)}
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    logging.getLogger("py4j").setLevel(logging.WARNING)
    spark = SparkSession.builder.appName(name).getOrCreate()
    try:
        run(spark, config)
    finally:
        spark.stop()
