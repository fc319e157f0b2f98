"""Lenses: queries that turn the driver tables into the tables the operators work on.

Each lens exists twice: as a Spark DataFrame (used by the registered
queries) and as DuckDB SQL (used by the oracle). Both read whole tables; the
modulo expressions below only *derive* values (an extension, a path shape)
and never drop rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bundleflow.session import table

# Fixed values of the files lens: extension by doc_id % 12.
LENS_EXTENSIONS = (".mkv", ".mp4", ".avi", ".mov", ".m4v", ".ts", ".webm",
                   ".srt", ".ass", ".vtt", ".nfo", ".MKV")
DOWNLOAD_ROOT = "/srv/complete"
PROCESSING_ROOT = "/srv/processing"
READY_ROOT = "/ready"


def _ext(col: str) -> F.Column:
    return F.element_at(F.array(*[F.lit(e) for e in LENS_EXTENSIONS]), (F.col(col) % 12 + 1).cast("int"))


def files_lens(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents")
    return d.select(
        F.col("source").alias("bundle"),
        F.concat("lang", F.lit("/"), F.col("doc_id").cast("string"), _ext("doc_id")).alias("rel_path"),
        "doc_id",
        F.col("text").alias("content"),
        F.sha2(F.col("text"), 256).alias("sha256"),
        F.octet_length("text").cast("bigint").alias("length"),
    )


def verdicts_lens(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "labels").select(
        "doc_id", (F.col("toxic") == 1).alias("infected"), (F.col("quality") == 1).alias("ok"))


def manifest_files_lens(spark: SparkSession, sf: str) -> DataFrame:
    """Manifest entries: the core files of each (source, lang) group.

    Core is decided by the classify operator on the lens path, not by a
    filter on ids.
    """
    from bundleflow.functions.paths import is_core
    d = table(spark, sf, "documents")
    rel = F.concat("lang", F.lit("/"), F.col("doc_id").cast("string"), _ext("doc_id"))
    return (d.select(F.concat("source", F.lit("-"), "lang").alias("manifest_id"),
                     F.col("source").alias("bundle"), "doc_id", rel.alias("rel_path"),
                     F.sha2("text", 256).alias("sha256"))
            .where(is_core("rel_path")))


def manifest_ids_lens(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents")
    return d.select(F.concat("source", F.lit("-"), "lang").alias("manifest_id")).distinct()


def order_manifest_lens(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    return li.select(F.col("l_orderkey").alias("manifest_id"), F.col("l_partkey").alias("hash")).distinct()


def customer_bundle_lens(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey")
    return (o.join(li, o.o_orderkey == li.l_orderkey)
            .select(F.col("o_custkey").alias("bundle"), F.col("l_partkey").alias("hash")).distinct())


def requests_lens(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    k = F.col("o_orderkey")
    src = (F.when(k % 10 == 0, F.concat(F.lit("/srv/complete-old/"), k.cast("string")))
           .when(k % 10 == 1, F.lit(""))
           .otherwise(F.concat(F.lit("/srv/complete/"), k.cast("string"), F.lit(".mkv"))))
    state = F.when(F.col("o_orderstatus") == "F", "done").when(F.col("o_orderstatus") == "P", "validate")
    return o.select(k.cast("string").alias("tx"), F.concat(F.lit("job "), k.cast("string")).alias("name"),
                    src.alias("orig_src"), state.alias("state"), k.alias("o_orderkey"))


def ledger_lens(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    return o.where(F.col("o_orderstatus") == "F").select(F.col("o_orderkey").cast("string").alias("job_id"))


def logs_lens(spark: SparkSession, sf: str, src: DataFrame | None = None) -> DataFrame:
    e = src if src is not None else table(spark, sf, "events")
    stage = (F.when(F.col("event_type") == "signup", "ingest").when(F.col("event_type") == "view", "security")
             .when(F.col("event_type") == "click", "validation").when(F.col("event_type") == "purchase", "metadata")
             .otherwise("export"))
    status = F.when(F.col("value") < 5, "failed").when(F.col("value") < 20, "running").otherwise("success")
    return e.select("event_id", "ts", F.col("user_id").cast("string").alias("tx"),
                    F.when(F.col("event_id") % 2 == 0, "vm").otherwise("host").alias("machine"),
                    stage.alias("stage"), status.alias("status"), F.col("props").alias("msg"))


def samples_lens(spark: SparkSession, sf: str, src: DataFrame | None = None) -> DataFrame:
    e = src if src is not None else table(spark, sf, "events")
    return e.select(F.col("user_id").alias("target"), "ts", "event_id",
                    F.floor(F.col("value") / 25).cast("bigint").alias("size"))


def arrivals_lens(spark: SparkSession, sf: str, src: DataFrame | None = None) -> DataFrame:
    e = src if src is not None else table(spark, sf, "events")
    folder = (F.when(F.col("event_type") == "view", "movies/").when(F.col("event_type") == "click", "shows/")
              .otherwise("other/"))
    hidden = F.when(F.col("event_id") % 7 == 0, ".").otherwise("")
    suffix = F.when(F.col("event_id") % 5 == 0, ".part").when(F.col("event_id") % 5 == 1, ".tmp").otherwise("")
    return e.select("event_id", "ts",
                    F.concat(F.lit("/ready/"), folder, hidden, F.col("user_id").cast("string"), suffix).alias("path"),
                    (F.col("event_id") % 3 != 0).alias("is_dir"))


def turns_lens(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "conversations")
    return c.select(F.col("conv_id").alias("tx"), F.col("turn").alias("seq"), F.col("role").alias("state"))


def pages_lens(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "pages")
    return p.select("page_id", "url", F.regexp_replace("url", r"^https?://[^/]+", "/ready").alias("path"))


# ---------------------------------------------------------------- DuckDB SQL
SHA = "sha256(text)"
LEN = "CAST(strlen(text) AS BIGINT)"

LENS_SQL = {
    "files_lens": f"""SELECT source AS bundle, concat(lang, '/', doc_id, CASE doc_id % 12 WHEN 0 THEN '.mkv'
        WHEN 1 THEN '.mp4' WHEN 2 THEN '.avi' WHEN 3 THEN '.mov' WHEN 4 THEN '.m4v' WHEN 5 THEN '.ts'
        WHEN 6 THEN '.webm' WHEN 7 THEN '.srt' WHEN 8 THEN '.ass' WHEN 9 THEN '.vtt' WHEN 10 THEN '.nfo'
        ELSE '.MKV' END) AS rel_path, doc_id, text AS content, {SHA} AS sha256, {LEN} AS length FROM documents""",
    "verdicts_lens": "SELECT doc_id, toxic = 1 AS infected, quality = 1 AS ok FROM labels",
    "manifest_files_lens": """SELECT concat(bundle, '-', split_part(rel_path, '/', 1)) AS manifest_id, bundle,
        doc_id, rel_path, sha256 FROM files_lens
        WHERE regexp_matches(rel_path, '\\.(mkv|mp4|avi|mov|m4v|ts|webm)$')""",
    "manifest_ids_lens": "SELECT DISTINCT concat(source, '-', lang) AS manifest_id FROM documents",
    "order_manifest_lens": "SELECT DISTINCT l_orderkey AS manifest_id, l_partkey AS hash FROM lineitem",
    "customer_bundle_lens": """SELECT DISTINCT o_custkey AS bundle, l_partkey AS hash
        FROM orders JOIN lineitem ON o_orderkey = l_orderkey""",
    "requests_lens": """SELECT CAST(o_orderkey AS VARCHAR) AS tx, concat('job ', o_orderkey) AS name,
        CASE WHEN o_orderkey % 10 = 0 THEN concat('/srv/complete-old/', o_orderkey)
             WHEN o_orderkey % 10 = 1 THEN ''
             ELSE concat('/srv/complete/', o_orderkey, '.mkv') END AS orig_src,
        CASE o_orderstatus WHEN 'F' THEN 'done' WHEN 'P' THEN 'validate' END AS state, o_orderkey
        FROM orders""",
    "ledger_lens": "SELECT CAST(o_orderkey AS VARCHAR) AS job_id FROM orders WHERE o_orderstatus = 'F'",
    "logs_lens": """SELECT event_id, ts, CAST(user_id AS VARCHAR) AS tx,
        CASE WHEN event_id % 2 = 0 THEN 'vm' ELSE 'host' END AS machine,
        CASE event_type WHEN 'signup' THEN 'ingest' WHEN 'view' THEN 'security' WHEN 'click' THEN 'validation'
             WHEN 'purchase' THEN 'metadata' ELSE 'export' END AS stage,
        CASE WHEN value < 5 THEN 'failed' WHEN value < 20 THEN 'running' ELSE 'success' END AS status,
        props AS msg FROM events""",
    "samples_lens": """SELECT user_id AS target, ts, event_id, CAST(floor(value / 25) AS BIGINT) AS size
        FROM events""",
    "arrivals_lens": """SELECT event_id, ts, concat('/ready/', CASE event_type WHEN 'view' THEN 'movies/'
        WHEN 'click' THEN 'shows/' ELSE 'other/' END, CASE event_id % 7 WHEN 0 THEN '.' ELSE '' END, user_id,
        CASE event_id % 5 WHEN 0 THEN '.part' WHEN 1 THEN '.tmp' ELSE '' END) AS path,
        event_id % 3 <> 0 AS is_dir FROM events""",
    "turns_lens": "SELECT conv_id AS tx, turn AS seq, role AS state FROM conversations",
    "pages_lens": """SELECT page_id, url, regexp_replace(url, '^https?://[^/]+', '/ready') AS path
        FROM pages""",
}

# Lenses that are defined over other lenses.
_LENS_DEPS = {"manifest_files_lens": ("files_lens",)}


def with_lenses(body: str, *names: str) -> str:
    """Oracle SQL: ``WITH <lenses> <body>``, dependencies first."""
    order: list[str] = []

    def add(n: str) -> None:
        for dep in _LENS_DEPS.get(n, ()):
            add(dep)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    ctes = ",\n".join(f"{n} AS ({LENS_SQL[n]})" for n in order)
    body = body.strip()
    if body[:15].upper() == "WITH RECURSIVE ":
        return f"WITH RECURSIVE {ctes},\n{body[15:]}"
    if body[:5].upper() == "WITH ":
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
