"""Write lens rows out as real files and folders, so that the file-system
sources (listing, binary read, manifest and log readers) run on data Spark
derived from the driver tables. Writes happen on the executors, into a
fresh folder below the shared checkpoint folder."""

from __future__ import annotations

import contextlib
import os
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bundleflow.session import bounded_batches, scratch_path

#: Bytes of a content that further names may be linked to, and how many such
#: contents of a folder are remembered.
LINKED, CONTENTS = 64, 1_000


def write_files(files: DataFrame, root: str, *, bundle: str = "bundle", rel: str = "rel_path",
                content: str = "content", link: bool = False) -> int:
    """One file per row at ``{root}/{bundle}/{rel_path}``; returns the count.

    With ``link`` a short content that the task wrote in a folder before gets a
    further name (a hard link) instead of a file of its own: a file system
    makes and drops names many times faster than files. Only for files that
    nobody changes in place. Where links cannot be made, files are written."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, made = 0, ""
        named: dict[bytes, str] = {}  # content -> a file of this folder that has it
        for pdf in batches:
            for b, r, c in zip(pdf[bundle], pdf[rel], pdf[content]):
                p = os.path.join(root, b, r)
                if os.path.dirname(p) != made:
                    made = os.path.dirname(p)
                    os.makedirs(made, exist_ok=True)
                    named.clear()
                data = c.encode("utf-8") if isinstance(c, str) else (bytes(c) if c is not None else b"")
                n += 1
                if link and data in named and _linked(named[data], p):
                    continue
                if link:
                    with contextlib.suppress(FileNotFoundError):  # a task that was run twice: not through a shared file
                        os.unlink(p)
                    if len(data) <= LINKED and (data in named or len(named) < CONTENTS):
                        named[data] = p
                with open(p, "wb") as fh:
                    fh.write(data)
        yield pd.DataFrame({"n": [n]})

    bounded_batches(files.sparkSession)
    res = files.select(bundle, rel, content).mapInPandas(run, "n long").agg(F.sum("n").alias("n")).first()
    return int(res["n"] or 0)


def _linked(there: str, name: str) -> bool:
    """Whether ``name`` is another name of the file ``there`` now. A file takes
    a bounded number of names, some file systems none."""
    for _ in range(2):
        try:
            os.link(there, name)
            return True
        except FileExistsError:
            with contextlib.suppress(FileNotFoundError):
                os.unlink(name)
        except OSError:
            return False
    return False


def drop_folders(spark: SparkSession, folders: list[str]) -> None:
    """Takes away folders that :func:`write_files` made and that hold files
    alone, one task a folder. For trees that are too large to stand all at once."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for folder in pdf["folder"]:
                with contextlib.suppress(FileNotFoundError):  # a task that was run twice
                    with os.scandir(folder) as entries:
                        for e in entries:
                            with contextlib.suppress(FileNotFoundError):
                                os.unlink(e.path)
                    os.rmdir(folder)
            yield pdf

    spark.createDataFrame([(f,) for f in folders], "folder string").mapInPandas(run, "folder string").agg(F.count(F.lit(1))).first()


def fresh_root(spark, label: str) -> str:
    path = scratch_path(spark, label)
    if path.startswith("file:"):
        path = path[5:]
    os.makedirs(path, exist_ok=True)
    return path
