"""Run the pipeline over a folder of anchored HTML documents: ``python -m tabularium.cli IN OUT``."""

from __future__ import annotations

import argparse

from pyspark.sql import functions as F

from tabularium.plans import pipeline
from tabularium.session import build_session
from tabularium.sources import files


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tabularium")
    parser.add_argument("input", help="folder of <document>/page-NNN.html")
    parser.add_argument("output", help="folder for final rows, groups and ranking (Parquet)")
    parser.add_argument("--fields", help="JSON file of preferred fields")
    args = parser.parse_args(argv)
    spark = build_session()
    pages = files.page_html(spark, args.input)
    listed = F.sort_array(F.collect_list(F.struct("page", "html")))
    docs = pages.groupBy("doc_id").agg(F.array_join(F.transform(listed, lambda p: p["html"]), "\n").alias("html"))
    preferred = files.preferred_fields(spark, args.fields) if args.fields else None
    result = pipeline.run(docs, preferred)
    for name in ("final", "groups", "ranking", "joins"):
        getattr(result, name).write.mode("overwrite").parquet(f"{args.output}/{name}")


if __name__ == "__main__":
    main()
