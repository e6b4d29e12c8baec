"""Batch runs from the command line.

    python -m cinespark statistics --src DIR [--ext tsv.gz] --out DIR
    python -m cinespark ml --src DIR --out DIR [--name df_movie]
    python -m cinespark both --src DIR --out DIR

Reads the five source tables ``{src}/{name}.{ext}``, checks that all are
present, and writes the statistics outputs (CSV, decimal comma) and/or the
ML matrix (CSV, ``;``) under ``--out``. Parameters of the reference's
prompts and constants are options here.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from cinespark.plans import features
from cinespark.plans.catalog import TABLE_FILES
from cinespark.plans.pipeline import FilmPipeline
from cinespark.session import build_session
from cinespark.sources import serving as sv
from cinespark.sources.check import source_check_path
from cinespark.sources.tsv import read_tables, tsv_rejects


def parse(argv: list[str]) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="cinespark")
    p.add_argument("run", choices=["statistics", "ml", "both"])
    p.add_argument("--src", required=True, help="folder of the source tables")
    p.add_argument("--ext", default="tsv.gz")
    p.add_argument("--out", required=True, help="output folder")
    p.add_argument("--name", default="df_movie", help="name of the ML output")
    p.add_argument("--format", default="csv", choices=["csv", "parquet"])
    p.add_argument("--genres", default=None,
                   help="comma list of genre features: the wide ML layout over them; without it one row per (film, feature)")
    p.add_argument("--as-of-year", type=int, default=None, help="year for ages of the living; the current year by default")
    p.add_argument("--actor-min", type=int, default=features.ACTOR_MIN)
    p.add_argument("--director-min", type=int, default=features.DIRECTOR_MIN)
    p.add_argument("--partitions", type=int, default=None,
                   help="spread rows of the unsplittable source files")
    p.add_argument("--keep-bad-rows", action="store_true",
                   help="keep rows with missing or extra cells and list them under {out}/rejects; else they are an error")
    p.add_argument("--master", default=None)
    return p.parse_args(argv)


def main(argv: list[str] | None = None) -> dict[str, str]:
    args = parse(sys.argv[1:] if argv is None else argv)
    # inside an application (or a test) the active session is used as it is
    spark = SparkSession.getActiveSession() or build_session(args.master)
    missing = [r["table_name"] for r in
               source_check_path(spark, args.src, args.ext).filter("NOT present").collect()]
    if missing:
        raise SystemExit(f"missing source tables: {', '.join(missing)}")
    tables = read_tables(spark, args.src, ext=args.ext, partitions=args.partitions, keep_bad_rows=args.keep_bad_rows, ordinal=True)
    if args.keep_bad_rows:
        for file in TABLE_FILES:
            tsv_rejects(spark, f"{args.src.rstrip('/')}/{file}.{args.ext}").write.mode("overwrite").parquet(f"{args.out}/rejects/{file}")
    pipe = FilmPipeline(tables, as_of_year=args.as_of_year, actor_min=args.actor_min,
                        director_min=args.director_min,
                        serving_actor_min=sv.SERVING_MIN_FILMS,
                        serving_director_min=sv.SERVING_MIN_FILMS)
    out: dict[str, str] = {}
    if args.run in ("statistics", "both"):
        out.update(pipe.write_statistics(args.out, fmt=args.format))
    if args.run in ("ml", "both"):
        out["ml"] = pipe.write_ml(args.out, args.name, args.genres.split(",") if args.genres else None)
    return out


if __name__ == "__main__":
    for k, v in main().items():
        print(k, v)
