"""Column functions over JSON records, timestamps, hash arrays and states
(SC-3 .. SC-6, PR-10, DC-1)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from bundleflow import schemas
from bundleflow.functions.paths import _col, with_default

# The VM stage machine, in order. 'none' is the absent state.
STATE_ORDER = ("none", "ingest", "scan", "validate", "manifest", "stage", "done")
# State -> next state. 'none' and 'ingest' both run ingest first.
NEXT_STATE = {
    "none": "scan",
    "ingest": "scan",
    "scan": "validate",
    "validate": "manifest",
    "manifest": "stage",
    "stage": "done",
    "done": "done",
}
# Stage -> marker name written once the stage is done.
STAGE_MARKERS = (
    ("ingest", "ingest"),
    ("scan", "scan"),
    ("validate", "validate"),
    ("manifest", "manifest"),
    ("stage", "export"),
)
# Log 'stage' words and their order within one transaction.
LOG_STAGE_RANK = {
    "ingest": 1,
    "security": 2,
    "validation": 3,
    "metadata": 4,
    "export": 5,
    "promote": 6,
}

JSON_KEEP_NULLS = {"ignoreNullFields": "false"}


def manifest_to_json(job_id, name, source, files, type_=None) -> Column:
    """One manifest as JSON text; ``type`` is written as null like the producer."""
    t = F.lit(None).cast("string") if type_ is None else _col(type_)
    return F.to_json(
        F.struct(_col(job_id).alias("job_id"), _col(name).alias("name"),
                 _col(source).alias("source"), t.alias("type"), _col(files).alias("files")),
        JSON_KEEP_NULLS,
    )


def parse_manifest(text: Column | str) -> Column:
    """Struct of a manifest; malformed text gives NULL (PERMISSIVE)."""
    return F.from_json(_col(text), schemas.MANIFEST, {"mode": "PERMISSIVE"})


#: A name that is the JSON value false (as text it would stand in quotes).
_FALSE_NAME = r'"name"\s*:\s*false\b'


def manifest_fields(text: Column | str) -> Column:
    """SC-3: job_id and type as jq -r prints them ('null' when absent), name
    as ``.name // empty`` ('' when absent, null or false), and the hash list."""
    m = parse_manifest(text)
    return F.struct(
        F.coalesce(m["job_id"], F.lit("null")).alias("job_id"),
        F.when(_col(text).rlike(_FALSE_NAME) & (m["name"] == "false"), F.lit(""))
         .otherwise(F.coalesce(m["name"], F.lit(""))).alias("name"),
        F.coalesce(m["type"], F.lit("null")).alias("type"),
        F.coalesce(F.transform(m["files"], lambda f: f["hash"]),
                   F.array().cast("array<string>")).alias("hashes"),
    )


def json_escape(c: Column | str) -> Column:
    """SC-4: the value as a JSON string literal (quotes included)."""
    j = F.to_json(F.struct(_col(c).alias("v")), JSON_KEEP_NULLS)
    # {"v":<literal>} -> <literal>
    return j.substr(F.lit(6), F.length(j) - 6)


def iso_timestamp(c: Column | str) -> Column:
    """SC-5: ISO-8601 at second resolution with offset, e.g. 2024-01-01T00:00:07+00:00."""
    return F.date_format(_col(c), "yyyy-MM-dd'T'HH:mm:ssxxx")


def parse_iso(c: Column | str) -> Column:
    """SC-5 inverse: NULL for text that is not such a timestamp."""
    return F.try_to_timestamp(_col(c), F.lit("yyyy-MM-dd'T'HH:mm:ssXXX"))


def hash_set_contains(bundle_hashes: Column | str, manifest_hashes: Column | str) -> Column:
    """SC-6: every manifest hash is in the bundle set; an empty list is contained."""
    return F.size(F.array_except(_col(manifest_hashes), _col(bundle_hashes))) == 0


def _map_literal(d: dict) -> Column:
    return F.create_map(*[x for k, v in d.items() for x in (F.lit(k), F.lit(v))])


def normalize_state(c: Column | str) -> Column:
    """Stored state, or 'none' when absent or empty."""
    return with_default(c, "none")


def next_state(c: Column | str) -> Column:
    """DC-1: successor state; NULL for an unknown state (a reject)."""
    return F.try_element_at(_map_literal(NEXT_STATE), normalize_state(c))


def state_rank(c: Column | str) -> Column:
    return F.try_element_at(_map_literal({s: i for i, s in enumerate(STATE_ORDER)}), normalize_state(c))


def log_stage_rank(c: Column | str) -> Column:
    return F.coalesce(F.try_element_at(_map_literal(LOG_STAGE_RANK), _col(c)), F.lit(99))
