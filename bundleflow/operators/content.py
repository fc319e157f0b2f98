"""Content operators (CT-1 .. CT-6) and the validator hook (UD-1).

Hashing, signature search and header probes run on executors. Content that
Spark holds as a column is hashed with the built-in ``sha2``; files too
large for a column are hashed by path in ``mapInPandas``, reading 8 MiB at
a time, so no file is ever held whole in memory.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bundleflow.functions.paths import CORE, classify_file, file_extension
from bundleflow.operators.gram_index import count_patterns
from bundleflow.session import bounded_batches

CHUNK = 8 << 20

# Container signatures by extension (offset is 1-based).
#   mkv, webm: EBML magic 1A 45 DF A3 at offset 1
#   mp4, mov, m4v: 'ftyp' at offset 5
#   avi: 'RIFF' at offset 1 and 'AVI ' at offset 9
#   ts: sync byte 0x47 at offset 1
EBML = bytes([0x1A, 0x45, 0xDF, 0xA3])
FTYP = b"ftyp"
RIFF = b"RIFF"
AVI = b"AVI "
TS_SYNC = bytes([0x47])


def fingerprint(files: DataFrame, *, content: str = "content", out: str = "sha256", path: str = "rel_path",
                only_core: bool = False, by_path: str | None = None) -> DataFrame:
    """CT-1: lower-case hex SHA-256 of each file's content.

    ``only_core`` hashes core files only (the VM side) and leaves NULL for
    the others. The filter is an expression, so Catalyst evaluates it before
    the hash. With ``by_path`` (a column with the file's path) files whose
    content is NULL, being too large for a column, are read there instead.
    """
    h = F.sha2(F.col(content), 256)
    if only_core:
        h = F.when(classify_file(path) == CORE, h)
    held = files.withColumn(out, h)
    if by_path is None:
        return held
    absent = held.where(F.col(content).isNull() & (classify_file(path) == CORE if only_core else F.lit(True)))
    read = fingerprint_paths(absent.drop(out, "sha256"), path=by_path)
    rest = held.where(~(F.col(content).isNull() & (classify_file(path) == CORE if only_core else F.lit(True))))
    return rest.unionByName(read.withColumn(out, F.col("sha256")).select(*rest.columns))


def _hash_file(p: str) -> tuple[str | None, str | None]:
    try:
        d = hashlib.sha256()
        with open(p, "rb") as fh:
            while True:
                b = fh.read(CHUNK)
                if not b:
                    break
                d.update(b)
        return d.hexdigest(), None
    except OSError as e:
        return None, f"{type(e).__name__}: {e}"


def fingerprint_paths(files: DataFrame, *, path: str = "path") -> DataFrame:
    """CT-1 for files of any size, read by path on the executors.

    Adds ``sha256`` and ``read_error`` (NULL when the file was hashed).
    Filter the rows first (e.g. core only): a filter is not pushed through
    ``mapInPandas``.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            res = [_hash_file(p) for p in pdf[path]]
            pdf = pdf.copy()
            pdf["sha256"] = [r[0] for r in res]
            pdf["read_error"] = [r[1] for r in res]
            yield pdf

    return files.mapInPandas(run, schema=_ddl(files.schema, extra="sha256 string, read_error string"))


def fingerprint_tree(spark, root: str, max_bytes: int | None = None) -> DataFrame:
    """CT-1 over a folder: (path, length, sha256) for every file. Files that
    fit a column are hashed by the built-in ``sha2``; larger ones are read by
    path in 8 MiB steps on the executors. Empty files are included."""
    from bundleflow.sources.files import scan_contents
    c = scan_contents(spark, root, max_bytes)
    small = c.where(F.col("content").isNotNull()).select("path", "length", F.sha2("content", 256).alias("sha256"))
    large = fingerprint_paths(c.where(F.col("content").isNull()).select("path", "length"))
    return small.unionByName(large.select("path", "length", "sha256"))


def _ddl(schema, extra: str = "") -> str:
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    return f"{cols}, {extra}" if extra else cols


def verify_readable(files: DataFrame, *, job: str = "job_id", content: str | None = "content",
                    path: str = "path") -> DataFrame:
    """CT-5: every file of a job can be read and hashed; digests are dropped.

    With ``content`` given, a file whose content is NULL is read by path if
    there is a ``path`` column (it may only be too large for a column), else
    it counts as unreadable; without it every file is read by path.
    """
    if content is not None and path in files.columns:
        base = (files.where(F.col(content).isNotNull()).select(job, F.lit(None).cast("string").alias("read_error"))
                .unionByName(fingerprint_paths(files.where(F.col(content).isNull()).select(job, path), path=path)
                             .select(job, "read_error")))
        bad = F.col("read_error").isNotNull()
    elif content is not None:
        bad = F.col(content).isNull()
        base = files
    else:
        base = fingerprint_paths(files, path=path)
        bad = F.col("read_error").isNotNull()
    return base.groupBy(job).agg(F.count(F.lit(1)).alias("n_files"), F.count_if(bad).alias("n_unreadable"))


# ------------------------------------------------------------ signature scan
BROADCAST_PATTERN_BYTES = 1 << 20  # patterns of one automaton; a larger table is searched through its index


def _scan_file(auto, longest: int, p: str) -> int | None:
    """Distinct patterns in a file, read 8 MiB at a time with an overlap of
    the longest pattern; None when it cannot be read."""
    found: set[int] = set()
    tail = b""
    try:
        with open(p, "rb") as fh:
            while data := fh.read(CHUNK):
                text = tail + data
                found.update(i for _, i in auto.iter(text.decode("latin-1")))
                tail = text[-(longest - 1):] if longest > 1 else b""
    except OSError:
        return None
    return len(found)


def _pattern_hits(files: DataFrame, patterns: list[bytes], out: str, content: str, path: str | None) -> DataFrame:
    """Number of distinct patterns in each content value, or in the file at
    ``path`` where content is NULL. Bytes are matched as Latin-1 text by one
    automaton per task; the pattern list is a broadcast of bounded size."""
    import ahocorasick  # noqa: F401  (fail early on the driver if missing)

    bounded_batches(files.sparkSession)
    bc = files.sparkSession.sparkContext.broadcast(patterns)
    longest = max(map(len, patterns))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import ahocorasick as ac
        auto = ac.Automaton()
        for i, p in enumerate(bc.value):
            auto.add_word(p.decode("latin-1"), i)
        auto.make_automaton()
        for pdf in batches:
            counts = []
            for i, data in enumerate(pdf[content]):
                if data is None:
                    counts.append(None if path is None else _scan_file(auto, longest, pdf[path].iat[i]))
                    continue
                data = data.encode() if isinstance(data, str) else bytes(data)
                counts.append(len({k for _, k in auto.iter(data.decode("latin-1"))}))
            pdf = pdf.copy()
            pdf[out] = pd.array(counts, dtype="Int64")
            yield pdf

    return files.mapInPandas(run, schema=_ddl(files.schema, extra=f"{out} long"))


def flag_signatures(files: DataFrame, deny_digests: DataFrame | None = None, patterns: DataFrame | None = None,
                    *, content: str = "content", digest: str = "sha256", pattern_col: str = "text",
                    deny_col: str = "sha256", path: str | None = None) -> DataFrame:
    """Per file: ``deny_hit`` (digest on the deny list), ``pattern_hits``
    (distinct patterns found) and ``flagged``.

    The digest test is an equi join (Spark broadcasts the deny list only when
    its measured size allows). NULL and empty patterns are dropped, as an
    empty pattern is in every file. Files whose content is NULL are read at
    ``path`` if that column is named. The scan fails closed: with a deny list
    a file without a digest is flagged, with patterns one whose content is
    NULL and cannot be read by path.
    """
    f = files
    if deny_digests is not None:
        deny = deny_digests.select(F.col(deny_col).alias("_dd")).where(F.col("_dd").isNotNull()).distinct()
        f = (f.join(deny.withColumn("deny_hit", F.lit(True)), F.col(digest) == F.col("_dd"), "left").drop("_dd")
             .withColumn("deny_hit", F.coalesce("deny_hit", F.lit(False))))
    else:
        f = f.withColumn("deny_hit", F.lit(False))
    # Nothing is known of what could not be read: no digest to look up, no content to search.
    blind = F.col(digest).isNull() if deny_digests is not None else F.lit(False)
    if patterns is None:
        f = f.withColumn("pattern_hits", F.lit(0).cast("long"))
    else:
        f = _search(f, patterns, pattern_col, content, path)
        unseen = F.col("pattern_hits").isNull()
        if path is None:
            unseen = unseen | F.col(content).isNull()
        blind = blind | unseen
    f = f.withColumn("_blind", blind).withColumn("pattern_hits", F.coalesce("pattern_hits", F.lit(0).cast("long")))
    return f.withColumn("flagged", F.col("deny_hit") | (F.col("pattern_hits") > 0) | F.col("_blind")).drop("_blind")


def signature_scan(files: DataFrame, deny_digests: DataFrame | None = None, patterns: DataFrame | None = None,
                   *, bundle: str = "bundle", **kw) -> DataFrame:
    """CT-2: a bundle is infected when any of its files is flagged.

    Stands in for the malware scanner: a file is flagged when its digest is
    in ``deny_digests`` or its content contains one of ``patterns``.
    Returns (bundle, infected, n_digest_hits, n_pattern_hits).
    """
    f = flag_signatures(files, deny_digests, patterns, **kw)
    return f.groupBy(bundle).agg(
        F.bool_or("flagged").alias("infected"),
        F.count_if(F.col("deny_hit")).alias("n_digest_hits"),
        F.count_if(F.col("pattern_hits") > 0).alias("n_pattern_hits"),
    )


def _search(f: DataFrame, patterns: DataFrame, pattern_col: str, content: str, path: str | None) -> DataFrame:
    """``f`` with ``pattern_hits``: by one automaton where all patterns fit
    BROADCAST_PATTERN_BYTES, else through the index of grams. Both count the
    same; the second one takes no more memory for more patterns."""
    pats = patterns.select(F.col(pattern_col).cast("binary").alias("p")).where(F.octet_length("p") > 0).distinct()
    total = pats.agg(F.coalesce(F.sum(F.octet_length("p")), F.lit(0)).alias("bytes")).first()["bytes"]
    if not total:
        return f.withColumn("pattern_hits", F.lit(0).cast("long"))
    if total > BROADCAST_PATTERN_BYTES:
        return count_patterns(f, pats, pattern_col="p", out="pattern_hits", content=content, path=path)
    return _pattern_hits(f, [bytes(r[0]) for r in pats.collect()], "pattern_hits", content, path)


# ------------------------------------------------------------ header probe
def container_probe(content: Column | str, path: Column | str) -> Column:
    """CT-3: header bytes agree with the extension of a core file.

    Stands in for the media prober's pass/fail. NULL for non-core files.
    Reads only the first 12 bytes of the content column.
    """
    c = F.col(content) if isinstance(content, str) else content
    b = c.cast("binary")
    ext = file_extension(path)
    head = lambda pos, n: F.substring(b, pos, n)
    lit = lambda x: F.lit(bytearray(x))
    ok = (F.when(ext.isin("mkv", "webm"), head(1, 4) == lit(EBML))
          .when(ext.isin("mp4", "mov", "m4v"), head(5, 4) == lit(FTYP))
          .when(ext == "avi", (head(1, 4) == lit(RIFF)) & (head(9, 4) == lit(AVI)))
          .when(ext == "ts", head(1, 1) == lit(TS_SYNC)))
    return F.when(classify_file(path) == CORE, F.coalesce(ok, F.lit(False)))


HEADER_BYTES = 12


def _read_headers(path_col: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            heads = []
            for p in pdf[path_col]:
                try:
                    with open(p, "rb") as fh:
                        heads.append(fh.read(HEADER_BYTES))
                except OSError:
                    heads.append(None)
            pdf = pdf.copy()
            pdf["_head"] = heads
            yield pdf
    return run


def probe_paths(files: DataFrame, *, path: str = "path", rel: str = "rel_path") -> DataFrame:
    """CT-3 for files of any size: the first 12 bytes of each core file are
    read by path on the executors (``binaryFile`` would load whole files),
    then checked by :func:`container_probe`. An unreadable file fails.
    Non-core rows are filtered out before the Python step."""
    core = files.where(classify_file(rel) == CORE)
    heads = core.mapInPandas(_read_headers(path), schema=_ddl(core.schema, extra="_head binary"))
    return heads.withColumn("probe_ok", F.coalesce(container_probe("_head", rel), F.lit(False))).drop("_head")


def apply_verdicts(files: DataFrame, verdicts: DataFrame, *, key: str | list[str] = "doc_id",
                   path: str = "rel_path") -> DataFrame:
    """CT-4: decode outcome per file from a verdict table.

    Only core files are tested: ``ok`` is the verdict (absent means it
    decoded), NULL for aux and junk files.
    """
    keys = [key] if isinstance(key, str) else list(key)
    v = verdicts.groupBy(*keys).agg(F.bool_and("ok").alias("_ok"))  # a file passes if all its verdicts do
    out = files.join(v, keys, "left")
    return out.withColumn("ok", F.when(classify_file(path) == CORE, F.coalesce("_ok", F.lit(True)))).drop("_ok")


def reconcile_manifest(manifest_files: DataFrame, files: DataFrame, *, job: str = "job_id",
                       bundle: str = "bundle", digest: str = "sha256") -> DataFrame:
    """CT-6: per (job, hash): 'matched', 'missing' (in manifest, not in the
    bundle) or 'extra' (in the bundle, not in the manifest). The producer
    only tests containment; this states the manifest's purpose as a table.
    """
    mf = manifest_files.select(job, bundle, F.col(digest).alias("h")).distinct()
    jobs = mf.select(job, bundle).distinct()
    bf = files.select(bundle, F.col(digest).alias("h")).where(F.col("h").isNotNull()).distinct()
    have = jobs.join(bf, bundle).select(job, "h")
    joined = mf.select(job, "h", F.lit(True).alias("_m")).join(have.withColumn("_b", F.lit(True)),
                                                              [job, "h"], "full_outer")
    status = (F.when(F.col("_m").isNotNull() & F.col("_b").isNotNull(), "matched")
              .when(F.col("_m").isNotNull(), "missing").otherwise("extra"))
    return joined.select(job, F.col("h").alias(digest), status.alias("status"))


# ------------------------------------------------------------ UD-1
_VALIDATORS: dict[str, Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]] = {}
VALIDATOR_SCHEMA = "tx string, rel_path string, ok boolean"


def register_validator(name: str, fn: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]) -> None:
    """UD-1: register a file check: iterator of pandas batches in, iterator
    of (tx, rel_path, ok) batches out. It runs in ``mapInPandas``."""
    _VALIDATORS[name] = fn


def run_validator(name: str, files: DataFrame, *, core_only: bool = True, path: str = "rel_path") -> DataFrame:
    """Apply a registered validator. Core files are selected *before* the
    Python step (Catalyst cannot push a filter through ``mapInPandas``)."""
    fn = _VALIDATORS[name]
    src = files.where(classify_file(path) == CORE) if core_only else files
    return src.mapInPandas(fn, schema=VALIDATOR_SCHEMA)
