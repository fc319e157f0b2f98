"""Manifest registry: read, publish, export (IO-3, IO-8, IO-11)."""

from __future__ import annotations

import filecmp
import os
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bundleflow import schemas
from bundleflow.functions.records import manifest_fields


def read_manifests(spark: SparkSession, registry: str, *, keep_corrupt: bool = False,
                   include_empty: bool = False) -> DataFrame:
    """IO-3: every ``*.json`` of the registry folder (not its sub-folders).

    Returns (manifest_file, job_id, name, source, type, files). Invalid JSON
    is skipped (or kept with ``_corrupt_record`` when ``keep_corrupt``). A
    manifest without ``files`` is valid and has NULL files. A zero-byte file
    yields no row from the JSON reader, while the producer's validity test
    accepts it (and it then matches vacuously and fails on its job id); with
    ``include_empty`` such files come back as rows with every field NULL.
    """
    # Each file is one JSON document: read it whole as text and parse it, so
    # validity is decided per file and any subset of columns can be queried.
    raw = (spark.read.option("wholetext", "true").option("pathGlobFilter", "*.json")
           .text(registry.rstrip("/"))
           .select(F.col("_metadata.file_name").alias("manifest_file"), "value"))
    parsed = F.from_json("value", schemas.MANIFEST_WITH_CORRUPT,
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    m = raw.select("manifest_file", parsed.alias("_m"))
    bad = F.col("_m").isNull() | F.col("_m._corrupt_record").isNotNull()
    cols = ["manifest_file"] + [F.col(f"_m.{f.name}").alias(f.name) for f in schemas.MANIFEST.fields]
    if keep_corrupt:
        df = m.select(*cols, F.when(bad, F.coalesce(F.col("_m._corrupt_record"), F.lit(""))).alias("_corrupt_record"))
    else:
        df = m.where(~bad).select(*cols)
    if include_empty:
        from bundleflow.sources.files import list_names
        empty = (list_names(spark, registry, (".json",)).where(F.col("size") == 0)
                 .select(F.col("file_name").alias("manifest_file")))
        for f in df.schema.fields:
            if f.name != "manifest_file":
                empty = empty.withColumn(f.name, F.lit(None).cast(f.dataType))
        df = df.unionByName(empty)
    return df


def parse_manifest_text(df: DataFrame, *, text: str = "manifest_json") -> DataFrame:
    """IO-3 for manifests already held as text (one JSON document per row).

    Adds the jq-style fields of :func:`manifest_fields`: job_id and type as
    'null' text when absent, name '' when absent, hashes [] when absent,
    and ``valid`` (False for text that is not a JSON object).
    """
    parsed = F.from_json(F.col(text), schemas.MANIFEST_WITH_CORRUPT,
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    f = manifest_fields(text)
    return (df.withColumn("_p", parsed)
            .withColumn("valid", F.col("_p").isNotNull() & F.col("_p._corrupt_record").isNull())
            .withColumn("_f", f)
            .select("*", F.col("_f.job_id").alias("job_id"), F.col("_f.name").alias("bundle_name"),
                    F.col("_f.type").alias("type"), F.col("_f.hashes").alias("hashes"))
            .drop("_p", "_f"))


def _publish(registry: str, publish_id: str):
    claims = os.path.join(registry, ".publish")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        os.makedirs(claims, exist_ok=True)
        for pdf in batches:
            status = []
            for tx, body in zip(pdf["tx"], pdf["manifest_json"]):
                final = os.path.join(registry, f"{tx}.json")
                tmp = os.path.join(registry, f".{tx}.json.{uuid.uuid4().hex}.tmp")
                # Marks this publish call's attempt, so a retried task knows its own write.
                mine = os.path.join(claims, f"{tx}.{publish_id}")
                try:
                    if not os.path.exists(final):
                        open(mine, "w").close()
                    with open(tmp, "w", encoding="utf-8") as fh:
                        fh.write(body)
                        fh.write("\n")
                    # link() never replaces an existing name: publish-once, atomically.
                    os.link(tmp, final)
                    status.append("written")
                except FileExistsError:
                    # Either a retried task of this call (its claim exists and
                    # the bytes are the same) or a manifest from before.
                    with open(final, encoding="utf-8") as fh:
                        same = fh.read() == body + "\n"
                    status.append("written" if same and os.path.exists(mine) else "exists")
                finally:
                    if os.path.exists(tmp):
                        os.unlink(tmp)
            yield pd.DataFrame({"tx": pdf["tx"], "status": status})
    return run


def write_manifests(df: DataFrame, registry: str, existing: DataFrame | None = None) -> DataFrame:
    """IO-8: publish ``{tx}.json`` per row, atomically and never over an
    existing manifest. Returns (tx, status) with status 'written', 'exists'
    (a manifest for that tx was already there) — the rejects are the rows
    whose status is not 'written'.

    Ids already known to exist (``existing``: tx column) are rejected by an
    anti join before any file is touched; the file system check covers the
    rest, so a retried task cannot publish twice.
    """
    spark = df.sparkSession
    rows = df.select("tx", "manifest_json")
    known = None
    if existing is not None:
        ex = existing.select("tx").distinct()
        known = rows.join(ex, "tx", "left_semi").select("tx", F.lit("exists").alias("status"))
        rows = rows.join(ex, "tx", "left_anti")
    publish_id = uuid.uuid4().hex  # fixed on the driver: the same for every retry of a task
    written = rows.mapInPandas(_publish(registry.rstrip("/"), publish_id), schema="tx string, status string")
    return written if known is None else written.unionByName(known)


def _stream_writer(registry: str, publish_id: str):
    """Write manifests whose entries arrive sorted by (tx, name), one file
    per tx, entry by entry: memory stays bounded by a batch, however many
    files a bundle has."""
    import json as _json

    claims = os.path.join(registry, ".publish")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        os.makedirs(claims, exist_ok=True)
        cur = {"tx": None, "fh": None, "tmp": None, "first": True}
        done_tx, done_status = [], []

        def finish():
            if cur["fh"] is None:
                return
            cur["fh"].write("]}\n")
            cur["fh"].close()
            tx = cur["tx"]
            final = os.path.join(registry, f"{tx}.json")
            mine = os.path.join(claims, f"{tx}.{publish_id}")
            try:
                if not os.path.exists(final):
                    open(mine, "w").close()
                os.link(cur["tmp"], final)
                status = "written"
            except FileExistsError:
                if os.path.exists(mine):
                    status = "written"
                else:
                    status = "same" if filecmp.cmp(cur["tmp"], final, shallow=False) else "exists"
            finally:
                os.unlink(cur["tmp"])
            done_tx.append(tx)
            done_status.append(status)
            cur["fh"] = None

        for pdf in batches:
            for row in pdf.itertuples(index=False):
                if row.tx != cur["tx"]:
                    finish()
                    cur["tx"] = row.tx
                    cur["tmp"] = os.path.join(registry, f".{row.tx}.json.{uuid.uuid4().hex}.tmp")
                    cur["fh"] = open(cur["tmp"], "w", encoding="utf-8")
                    head = {"job_id": row.tx, "name": row.bundle_name, "source": row.orig_src, "type": None}
                    cur["fh"].write(_json.dumps(head, separators=(",", ":"), ensure_ascii=False)[:-1] + ',"files":[')
                    cur["first"] = True
                if row.name is not None:
                    entry = _json.dumps({"name": row.name, "hash": row.hash}, separators=(",", ":"),
                                        ensure_ascii=False)
                    cur["fh"].write(entry if cur["first"] else "," + entry)
                    cur["first"] = False
            if len(done_tx) >= 10_000:
                yield pd.DataFrame({"tx": done_tx, "status": done_status})
                done_tx.clear()
                done_status.clear()
        finish()
        if done_tx:
            yield pd.DataFrame({"tx": done_tx, "status": done_status})
    return run


def stream_manifests(entries: DataFrame, requests: DataFrame, registry: str) -> DataFrame:
    """AG-1 + IO-8 for registries of any size: one ``{tx}.json`` per request
    written entry by entry from the long form (``manifest_entries``: tx,
    name, hash), so no manifest is ever held as one row or one list. Rows
    are hash-partitioned by tx and sorted by (tx, name) within partitions.
    Same bytes as :func:`bundleflow.operators.aggregates.build_manifest`
    (compact JSON, ``type`` null, empty ``files`` for requests without core
    files). Returns (tx, status) like :func:`write_manifests`; a manifest that is
    there with the same bytes has the status 'same'.
    """
    from bundleflow.functions.paths import with_default
    req = requests.select("tx", with_default("name", "unknown").alias("bundle_name"), "orig_src")
    rows = req.join(entries.select("tx", "name", "hash"), "tx", "left")
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(n, "tx").sortWithinPartitions("tx", "name", "hash")
    publish_id = uuid.uuid4().hex
    return rows.mapInPandas(_stream_writer(registry.rstrip("/"), publish_id), schema="tx string, status string")


def export_manifests(matched: DataFrame, *, job: str = "job_id", text: str = "manifest_json",
                     type_col: str = "type") -> DataFrame:
    """IO-11: the matched manifest, verbatim, keyed ``{job_id}.json``."""
    return matched.select(F.col(job).alias("job_id"), F.concat(F.col(job), F.lit(".json")).alias("export_name"),
                          F.col(text).alias("manifest_json"), F.col(type_col).alias("type"))


def write_exports(exports: DataFrame, path: str) -> None:
    """Sink for IO-11: each manifest as ``{job_id}.json`` in the export folder,
    byte for byte, whatever fields it has. An export replaces an earlier one
    of its job, as the producer's copy does. Jobs are exported once per batch."""
    from bundleflow.sources.named_files import write_named
    write_named(exports, path, name="export_name", body="manifest_json", existing="replace")


__all__ = ["read_manifests", "parse_manifest_text", "write_manifests", "stream_manifests",
           "export_manifests", "write_exports"]
