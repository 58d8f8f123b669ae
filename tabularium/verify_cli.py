"""Verify the addresses of record files: ``python -m tabularium.verify_cli IN OUT --client module:function``."""

from __future__ import annotations

import argparse
import importlib
from collections.abc import Callable

from pyspark.sql import functions as F

from tabularium.operators import costs, enrich
from tabularium.plans import calls, verification
from tabularium.session import build_session, settled
from tabularium.sources import files


def client_of(name: str) -> Callable:
    """The function that ``module:function`` names; executors import the module too."""
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tabularium.verify_cli")
    parser.add_argument("input", help="JSON files with an array of records, or an object with one under records")
    parser.add_argument("output", help="folder for records, quarantine, ledger, confidences and costs (JSON lines)")
    parser.add_argument("--client", required=True, help="module:function that gets a row of work and returns text, and tokens where it knows them")
    parser.add_argument("--model", help="the model's name in the ledger")
    parser.add_argument("--batch-size", type=int, default=5, help="records a call")
    parser.add_argument("--concurrency", type=int, default=4, help="calls at once")
    parser.add_argument("--name-field", help="field with the entity's name")
    args = parser.parse_args(argv)
    spark = build_session()
    records = settled(files.record_files(spark, args.input).select(F.col("file").alias("doc_id"), F.lit("records").alias("group_name"), "ord", "rec"))
    inputs = verification.record_inputs(records, args.batch_size, args.name_field)
    out = verification.verify(records, inputs, [calls.Client(client_of(args.client), args.model)], partitions=args.concurrency)
    verified = settled(out.records)
    priced = costs.priced(out.ledger, spark.createDataFrame(costs.PRICES, "name string, in_price double, out_price double"))
    tables = {
        "records": verified.select(F.col("doc_id").alias("file"), "ord", "rec", "verification"), "quarantine": out.quarantine, "ledger": out.ledger,
        "confidences": enrich.confidence_histogram(verified).withColumnRenamed("doc_id", "file"),
        "costs": priced.groupBy("stage", "model").agg(F.count("*").alias("calls"), F.sum("input_tokens").alias("input_tokens"), F.sum("output_tokens").alias("output_tokens"), F.sum("cost_usd").alias("cost_usd")),
    }
    for name, frame in tables.items():
        files.write_json(frame, f"{args.output}/{name}", "overwrite")


if __name__ == "__main__":
    main()
