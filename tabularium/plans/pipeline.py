"""From anchored documents to one final table per document: each step's plan comes from a proposer."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabularium.operators import enrich, groups, records, regions, schemas
from tabularium.operators.numbering import HOT_ROWS
from tabularium.plans.proposers import Proposer, Rules
from tabularium.plans.stages import Stages, content_key
from tabularium.session import dealt, settled


@dataclass
class Result:
    groups: DataFrame
    records: DataFrame
    ranking: DataFrame
    final: DataFrame
    #: What was proposed: merges of entities, joins between groups (which are reported, not applied), and one address row per group.
    merges: DataFrame
    joins: DataFrame
    addresses: DataFrame
    #: ``(step, doc_id, group_name, pos, name, type)``: the fields of all groups after each step.
    schemas: DataFrame


def extract(docs: DataFrame) -> DataFrame:
    """``(doc_id, group_name, title, ord, rec)`` of all tables, key/value blocks and lists of anchored documents, which are read once and parsed once."""
    # Each kind of region is read from it, and documents may be costly to make. Parsing costs more than their bytes tell, so adaptive execution must not put them together.
    found = settled(dealt(regions.find_regions(docs), "doc_id", "pos"))
    return records.to_groups(settled(groups.combine(records.table_records(found), records.pair_records(found), records.list_records(found))))


def _keeper(stages: Stages | None, docs: DataFrame, preferred: DataFrame | None, proposer: Proposer) -> Callable[..., DataFrame]:
    """What keeps a step: a checkpoint, or the stage of its name. Steps of ``docs`` alone are told apart from those that a field list and a proposer take part in."""
    if stages is None:
        return lambda name, make, of_docs=False: settled(make())
    own = content_key(docs)
    # A proposer that doesn't say what its plans depend on is asked anew in each run.
    told = getattr(proposer, "key", None) or uuid.uuid4().hex
    planned = [own, told, "" if preferred is None else content_key(preferred)]
    return lambda name, make, of_docs=False: stages.keep(name, make, *([own] if of_docs else planned)).frame


def run(docs: DataFrame, preferred: DataFrame | None = None, proposer: Proposer | None = None, stages: Stages | None = None) -> Result:
    """Extract, harmonise, consolidate, rank, add addresses, and choose the most prominent group of each document.

    What a proposer looks at is settled before: plans and records are made from
    the same rows, which are written as they are parsed, as they are numbered and as they have been merged. Documents without a region have no final rows; nothing fails on an empty corpus.

    With ``stages`` each of these tables is a stage that later runs reuse: those of
    the documents alone whatever the field list, the others for the same list and
    a proposer of the same ``key``. Without, they are checkpoints of this run.
    """
    proposer = proposer or Rules()
    kept = _keeper(stages, docs, preferred, proposer)
    rows = kept("extracted", lambda: extract(docs), of_docs=True)
    # A group is no larger than its document, but for pivots; where no document is large, no group has to be looked for.
    largest = rows.groupBy("doc_id").count().agg(F.max("count")).first()[0] or 0
    hot = HOT_ROWS if largest > HOT_ROWS // 16 else None
    own = kept("inferred", lambda: schemas.infer_groups(rows), of_docs=True)
    titles, rows = own.select("doc_id", "group_name", "title"), rows.drop("title")
    steps = [schemas.after("extracted", own)]

    def took(step: str, changed: DataFrame) -> DataFrame:
        changed = kept(step, lambda: changed)
        steps.append(schemas.after(step, changed))
        return changed

    # Schemas go through the same steps as the records, so that types hold and records are read for nothing but themselves.
    if preferred is not None:
        new, rows = groups.rename_fields(own, rows, proposer.field_maps(own, preferred))
        own = took("renamed", new)
    pivots = kept("pivots", lambda: proposer.pivots(own))
    rows, own = groups.unpivot_group(rows, pivots, hot), took("unpivoted", schemas.pivoted_groups(own, pivots))
    row_merges = kept("row-merges", lambda: proposer.row_merges(own))
    _, rows = groups.merge_groups(own, rows, row_merges, camel=True, hot_rows=hot)
    own = took("row-merged", schemas.merged_groups(own, row_merges, camel=True))
    # Titles are lost on the way through the steps before: a merge is proposed for what the groups were called at first.
    named = own.drop("title").join(titles, ["doc_id", "group_name"], "left").select("doc_id", "group_name", F.coalesce("title", F.lit("")).alias("title"), "fields")
    merges = kept("merges", lambda: proposer.merges(named))
    _, rows = groups.merge_groups(own, rows, merges, camel=False, hot_rows=hot)
    rows = kept("records", lambda: rows)
    own = took("merged", schemas.merged_groups(own, merges, camel=False))
    joins, addresses = proposer.joins(own), kept("addresses", lambda: enrich.complete_address_plan(own, proposer.addresses(own)))
    ranking = groups.rank_groups(own, rows)
    rows = enrich.with_addresses(rows, addresses)
    final = rows.join(ranking.where("rank = 1").select("doc_id", "group_name"), ["doc_id", "group_name"], "left_semi")
    order = Window.partitionBy("doc_id").orderBy("ord")
    every = steps[0]
    for step in steps[1:]:
        every = every.unionByName(step)
    return Result(own, rows, ranking, final.withColumn("ord", (F.row_number().over(order) - 1).cast("long")), merges, joins, addresses, every)


def summary(result: Result) -> DataFrame:
    """``(doc_id, groups, records, merges, joins, with_address, prominent)``: what a run has made of each document."""
    count = lambda rows, name: rows.groupBy("doc_id").agg(F.count("*").alias(name))
    out = count(result.groups, "groups")
    parts = {"records": result.records, "merges": result.merges, "joins": result.joins, "with_address": result.addresses.where("has_address")}
    for name, rows in parts.items():
        out = out.join(count(rows, name), "doc_id", "left").withColumn(name, F.coalesce(name, F.lit(0)))
    return out.join(result.ranking.where("rank = 1").select("doc_id", F.col("group_name").alias("prominent")), "doc_id", "left")
