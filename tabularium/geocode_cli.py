"""Geocode record files: ``python -m tabularium.geocode_cli IN OUT --gazetteer TABLE`` or ``--client module:function``."""

from __future__ import annotations

import argparse

from pyspark.sql import functions as F

from tabularium.operators import enrich
from tabularium.session import build_session, settled
from tabularium.sources import files
from tabularium.verify_cli import client_of


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tabularium.geocode_cli")
    parser.add_argument("input", help="JSON files of records, or with --verified the records folder of verify_cli")
    parser.add_argument("output", help="folder for records and counts (JSON lines), and features (GeoJSON, a feature a line)")
    parser.add_argument("--verified", action="store_true", help="the verified address comes before that of the record")
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--client", help="module:function that gets an address and returns the fields of a geocode")
    source.add_argument("--gazetteer", help="Parquet table (query, formatted_address, lat, lng)")
    parser.add_argument("--concurrency", type=int, default=5, help="calls at once")
    parser.add_argument("--qps", type=float, default=0, help="calls a second of all tasks together; 0: no bound")
    parser.add_argument("--max-attempts", type=int, default=5, help="calls for one address, where it is refused for a while")
    parser.add_argument("--no-geojson", action="store_true")
    args = parser.parse_args(argv)
    spark = build_session()
    records = files.verified_records(spark, args.input) if args.verified else files.record_files(spark, args.input)
    address = enrich.pick_address(F.col("rec"), F.col("verification.matched_address")) if args.verified else enrich.pick_address(F.col("rec"))
    if args.gazetteer:
        lookup = enrich.gazetteer_lookup(spark.read.parquet(args.gazetteer))
    else:
        lookup = enrich.service_lookup(client_of(args.client), args.qps or None, args.max_attempts, args.concurrency)
    found = settled(enrich.geocode(records, lookup, address))
    files.write_json(found, f"{args.output}/records", "overwrite")
    files.write_json(enrich.geocode_meta(found), f"{args.output}/counts", "overwrite")
    if not args.no_geojson:
        enrich.features(found, ("file", "ord")).select(F.col("feature").alias("value")).write.mode("overwrite").text(f"{args.output}/features")


if __name__ == "__main__":
    main()
