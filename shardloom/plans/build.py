"""The whole build as Spark jobs.

1. one pass over the input: parse, route, build documents (and quarantine
   rejects), one exchange on (index, shard), write the documents table;
2. one small aggregate over narrow columns of what was written (counts and
   field presence per (index, shard, type)), written as the ``_stats`` table;
3. shard grid, mapping and manifest from that aggregate (tiny);
4. shard and mapping tables written by index, manifest appended last.

Every build has folders of its own; the manifest says which build of an index is
read, so a rebuild replaces whole indices in one step.
"""

from __future__ import annotations

import datetime as _dt
import uuid as _uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..operators.duplicates import duplicate_ids, refuse_duplicates
from ..operators.grid import shard_grid
from ..operators.mapping import merge_mapping, presence_stats
from ..operators.parse import build_rows, build_tagged_rows, default_id_mode, parse_lines
from ..operators.postings import postings_from_documents, term_stats
from ..session import SMALL_SPLITS, build_conf
from ..sinks.documents import by_index, claim_build, write_documents, write_index_table
from ..sinks.layout import DOCUMENTS, MAPPING, POSTINGS, REJECTED_COLUMNS, SCHEMAS, SHARDS, STATS, TERMS, build_path, ddl, quoted
from ..sinks.manifest import append_manifest, index_manifest, publication, shard_manifest
from ..sources.lines import read_index_inputs, read_index_lines, shared_scan
from ..spec import IndexSpec


@dataclass
class BuildResult:
    documents: DataFrame
    rejected: DataFrame
    mapping: DataFrame
    shards: DataFrame
    manifest: DataFrame
    build_id: str
    postings: DataFrame | None = None
    terms: DataFrame | None = None
    duplicates: DataFrame | None = None


def union_rows(inputs: dict[str, DataFrame], ispec: IndexSpec, *, mode: str = "failfast",
               id_mode: str | None = None, build_id: str | None = None) -> DataFrame:
    rows = None
    for t in ispec.types:
        r = build_rows(parse_lines(inputs[t.name], t, ispec, id_mode=id_mode), t, ispec, mode=mode,
                       build_id=build_id)
        rows = r if rows is None else rows.unionByName(r, allowMissingColumns=True)
    return rows


def build_index(spark: SparkSession, ispec: IndexSpec, out: str, *,
                inputs: dict[str, DataFrame] | None = None, mode: str = "failfast",
                id_mode: str | None = None, build_id: str | None = None,
                created_at: _dt.datetime | None = None, postings: bool = False, scan: str = "auto") -> BuildResult:
    """Build every index of ``ispec`` into ``out``.

    Lines are read from the types' input paths (or given as ``inputs``).  Several types
    are read by one scan where their paths tell them apart (a file, or its parent
    folder, is a type's path; any other file fails the build); ``scan="by_type"`` reads
    each type on its own, as is done for patterns and differing record delimiters.

    With ``postings=True`` the index content is written too: the
    ``postings`` table (keyword and analysed terms with their frequency per
    document) and the ``terms`` dictionary, both by index.

    Ids made of key fields are checked: in ``failfast`` mode an id that an
    index holds twice fails the build before anything is published; in
    ``quarantine`` mode ``duplicates`` of the result lists them.
    """
    build_id = build_id or _uuid.uuid4().hex
    if scan not in ("auto", "by_type"):
        raise ValueError("scan must be 'auto' or 'by_type'")
    if inputs is None and not (scan == "auto" and shared_scan(ispec)):
        inputs = read_index_inputs(spark, ispec)
    with build_conf(spark):
        return _build(spark, ispec, out, inputs, mode, id_mode, build_id, created_at, postings)


def _build(spark, ispec, out, inputs, mode, id_mode, build_id, created_at, postings) -> BuildResult:
    if inputs is None:
        rows = build_tagged_rows(read_index_lines(spark, ispec), ispec, mode=mode, id_mode=id_mode)
    else:
        rows = union_rows(inputs, ispec, mode=mode, id_mode=id_mode)
    claim_build(spark, out, build_id)
    write_documents(rows, out, build_id)

    def read(name: str, schema: str) -> DataFrame:
        """This build's rows, by a stated schema (an empty build has no footer to infer from)."""
        return spark.read.schema(f"{schema}, index string").parquet(build_path(out, name, build_id))

    columns = ", ".join(f"{quoted(f.name)} {ddl(f.dataType)}" for f in rows.schema.fields if f.name not in ("index", *REJECTED_COLUMNS))
    docs = read(DOCUMENTS, columns).where("index is not null")
    rejected = read(DOCUMENTS, "type string, value string, reason string").where("index is null").select("type", "value", "reason")
    if mode == "failfast" and any((id_mode or default_id_mode(t)) == "key" for t in ispec.types):
        refuse_duplicates(docs)
    # One small aggregate over narrow columns of what this build wrote,
    # written as a table: lineage cut, and everything below reads a few rows
    # per shard.
    stats = presence_stats(docs, ispec)
    stats_path = build_path(out, STATS, build_id)
    stats.write.parquet(stats_path)
    stats = spark.read.schema(stats.schema).parquet(stats_path)
    grid = shard_grid(stats, ispec.num_shards)
    mapping = merge_mapping(stats, ispec)
    # grid and mapping leave aggregates keyed by index (and type): each index
    # is already in one task, so they are written as they are
    write_index_table(shard_manifest(grid), out, SHARDS, build_id)
    write_index_table(mapping, out, MAPPING, build_id)
    if postings:
        # ordered by term, so that row-group statistics skip what a term lookup does not need
        with build_conf(spark, SMALL_SPLITS):
            terms_of = postings_from_documents(docs, ispec)
            write_index_table(terms_of.sortWithinPartitions("index", "field", "term"), out, POSTINGS, build_id)
        made = term_stats(read(POSTINGS, SCHEMAS[POSTINGS]))
        write_index_table(by_index(made).sortWithinPartitions("index", "field", "term"), out, TERMS, build_id)
    manifest = index_manifest(grid, mapping, ispec, build_id=build_id, columns=columns, created_at=created_at)
    number = append_manifest(spark, manifest, out)
    return BuildResult(
        documents=docs, rejected=rejected, mapping=read(MAPPING, SCHEMAS[MAPPING]), shards=read(SHARDS, SCHEMAS[SHARDS]),
        manifest=publication(spark, out, number), build_id=build_id,
        postings=read(POSTINGS, SCHEMAS[POSTINGS]) if postings else None,
        terms=read(TERMS, SCHEMAS[TERMS]) if postings else None, duplicates=duplicate_ids(docs),
    )
