"""Pure ``Column`` functions over paths and names (PR and SC operators).

Everything here is a built-in Spark expression, so it stays inside
whole-stage codegen and is pushed around freely by Catalyst.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Media classes by file-name suffix (case-sensitive, whole suffix).
CORE_EXTENSIONS = ("mkv", "mp4", "avi", "mov", "m4v", "ts", "webm")
AUX_EXTENSIONS = ("srt", "ass", "vtt")
# Arrivals that are still being written.
PARTIAL_SUFFIXES = (".part", ".tmp")

CORE, AUX, JUNK = "core", "aux", "junk"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _suffix_regex(exts) -> str:
    # \z and not $: Java's $ also matches before a final newline.
    return r"\.(" + "|".join(exts) + r")\z"


def classify_file(path: Column | str) -> Column:
    """PR-1: 'core', 'aux' or 'junk' by the suffix of the whole path."""
    p = _col(path)
    return (F.when(p.rlike(_suffix_regex(CORE_EXTENSIONS)), F.lit(CORE))
            .when(p.rlike(_suffix_regex(AUX_EXTENSIONS)), F.lit(AUX))
            .otherwise(F.lit(JUNK)))


def is_core(path: Column | str) -> Column:
    return _col(path).rlike(_suffix_regex(CORE_EXTENSIONS))


def file_extension(path: Column | str) -> Column:
    """Text after the last dot of the last path segment ('' when none)."""
    leaf = basename(path)
    return F.when(leaf.contains("."), F.substring_index(leaf, ".", -1)).otherwise(F.lit(""))


def within_boundary(path: Column | str, root: str) -> Column:
    """PR-2: strictly below ``root``: a literal ``root/`` prefix, no normalisation."""
    return F.coalesce(_col(path).startswith(root.rstrip("/") + "/"), F.lit(False))


def classify_type(path: Column | str, incoming: str) -> Column:
    """PR-4: 'movies' or 'shows' by the incoming sub-folder, else NULL (ignored)."""
    p = _col(path)
    base = incoming.rstrip("/")
    return (F.when(p.startswith(base + "/movies/"), F.lit("movies"))
            .when(p.startswith(base + "/shows/"), F.lit("shows")))


def split_drop_path(path: Column | str, base: str) -> tuple[Column, Column]:
    """PR-11: strip the watch root; first segment is the folder, the rest the name."""
    p = _col(path)
    prefix = base.rstrip("/") + "/"
    rel = F.when(p.startswith(prefix), p.substr(F.lit(len(prefix) + 1), F.length(p))).otherwise(p)
    folder = F.substring_index(rel, "/", 1)
    name = F.when(rel.contains("/"), F.regexp_replace(rel, r"^[^/]*/", "")).otherwise(rel)
    return folder, name


def is_partial_or_hidden(name: Column | str) -> Column:
    """PR-5 test: only the first character of the relative name is looked at."""
    n = _col(name)
    cond = n.startswith(".")
    for s in PARTIAL_SUFFIXES:
        cond = cond | n.endswith(s)
    return cond


def valid_job_id(c: Column | str) -> Column:
    """PR-7: non-empty and not the text 'null' (what jq prints for a missing key)."""
    x = _col(c)
    return F.coalesce(x.isNotNull() & (x != F.lit("")) & (x != F.lit("null")), F.lit(False))


def basename(path: Column | str) -> Column:
    """SC-1: last path segment, trailing slashes ignored."""
    return F.element_at(F.split(F.regexp_replace(_col(path), r"/+\z", ""), "/"), -1)


def relative_path(path: Column | str, root: Column | str) -> Column:
    """SC-2: path with the bundle root removed; the root is taken literally."""
    p, r = _col(path), _col(root)
    prefix = F.concat(r, F.lit("/"))
    return F.when(p.startswith(prefix), p.substr(F.length(prefix) + 1, F.length(p))).otherwise(p)


def wrap_bundle_root(path: Column | str, is_dir: Column | str) -> Column:
    """PR-9: a single-file source becomes ``{path}.dir`` holding the file."""
    return F.when(_col(is_dir), _col(path)).otherwise(F.concat(_col(path), F.lit(".dir")))


def with_default(c: Column | str, default: str) -> Column:
    """PR-10: unset *or empty* becomes the default (shell ``${x:-d}``)."""
    return F.coalesce(F.nullif(_col(c), F.lit("")), F.lit(default))


def with_defaults(df, mapping: dict[str, str]):
    """PR-10 over a frame: every column of ``mapping`` (added when missing)
    gets its default when unset or empty."""
    for name, default in mapping.items():
        c = F.col(name) if name in df.columns else F.lit(None).cast("string")
        df = df.withColumn(name, with_default(c, default))
    return df
