"""Where documents, tables and raw files go."""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.operators.documents import as_lines

#: (method, url, body, headers) -> status
Send = Callable[[str, str, bytes, dict[str, str]], int]


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", skip_empty: bool = True) -> bool:
    """Snappy Parquet; with skip_empty no file for no rows. Says whether anything was written."""
    if skip_empty and df.isEmpty():
        return False
    df.write.mode(mode).parquet(path)
    return True


def load_table(df: DataFrame, table: str, append: bool = False) -> None:
    """Replaces a table by df, or adds to it."""
    df.write.mode("append" if append else "overwrite").saveAsTable(table)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_lines(documents: DataFrame, path: str, mode: str = "append") -> None:
    """Documents as lines of JSON."""
    as_lines(documents).write.mode(mode).text(path)


def file_sink(path: str) -> Callable[[DataFrame, DataFrame], int]:
    """A sink of lines for a search service that is loaded from files: upserts/ and deletes/ below path."""

    def sink(put: DataFrame, gone: DataFrame) -> int:
        write_lines(put, f"{path}/upserts")
        gone.write.mode("append").json(f"{path}/deletes")
        return 0

    return sink


def send(method: str, url: str, body: bytes, headers: dict[str, str]) -> int:
    request = urllib.request.Request(url, body or None, headers, method=method)
    try:
        with urllib.request.build_opener(urllib.request.ProxyHandler({})).open(request, timeout=30) as answer:
            return answer.status
    except urllib.error.HTTPError as e:
        return e.code


def _tried(call: Callable[[], int], good: Callable[[int], bool], attempts: int, pause: float) -> bool:
    for attempt in range(1, attempts + 1):
        try:
            if good(call()):
                return True
        except OSError:
            pass
        if attempt < attempts:
            time.sleep(pause * attempt)
    return False


def http_sink(base: str, collection: str, key: str, batch_size: int = 200, attempts: int = 3, pause: float = 0.5, sender: Send = send):
    """A search service's bulk upsert and delete by id, from the tasks; a 404 on delete is success.

    A batch whose attempts all fail is counted and the rest go on. The service's status is what counts; it may still have
    refused single documents. Tasks that are repeated send again, which upserts by id allow.
    """
    root = f"{base.rstrip('/')}/collections/{urllib.parse.quote(collection, safe='')}/documents"
    headers = {"X-TYPESENSE-API-KEY": key}

    def put(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for low in range(0, len(batch), batch_size):
                body = "\n".join(batch["value"].iloc[low : low + batch_size]).encode()
                ok = _tried(lambda b=body: sender("POST", f"{root}/import?action=upsert", b, headers), lambda s: 200 <= s < 300, attempts, pause)
                yield pd.DataFrame({"failed": [int(not ok)]})

    def drop(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            bad = 0
            for name in batch["id"]:
                url = f"{root}/{urllib.parse.quote(name, safe='')}"
                bad += not _tried(lambda u=url: sender("DELETE", u, b"", headers), lambda s: 200 <= s < 300 or s == 404, attempts, pause)
            yield pd.DataFrame({"failed": [int(bad > 0)]})

    def sink(documents: DataFrame, gone: DataFrame) -> int:
        done = as_lines(documents).mapInPandas(put, "failed int").unionByName(gone.mapInPandas(drop, "failed int"))
        return int(done.agg(F.coalesce(F.sum("failed"), F.lit(0))).first()[0])

    return sink


def exists(spark, path: str) -> bool:
    top = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(top)


def archive(spark, paths: list[str], folder: str) -> int:
    """Moves files (those that were loaded) into a folder under their flattened names; returns how many."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(folder)
    fs = target.getFileSystem(conf)
    fs.mkdirs(target)
    moved = 0
    for p in paths:
        source = jvm.org.apache.hadoop.fs.Path(p)
        name = urllib.parse.urlparse(p).path.strip("/").replace("/", "__")
        moved += bool(fs.rename(source, jvm.org.apache.hadoop.fs.Path(target, name)))
    return moved


def _folder(spark, path: str):
    top = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return top, top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def remove(spark, path: str) -> None:
    """Deletes a file or folder."""
    top, fs = _folder(spark, path)
    fs.delete(top, True)


def move(spark, path: str, target: str) -> None:
    """A folder under another name, on one file system."""
    source, fs = _folder(spark, path)
    if not fs.rename(source, spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)):
        raise OSError(f"{path} can't become {target}")


def folders(spark, path: str, prefix: str) -> list[str]:
    """Names of the folders below a path that begin so, in order."""
    top, fs = _folder(spark, path)
    names = [x.getPath().getName() for x in fs.listStatus(top)] if fs.exists(top) else []
    return sorted(n for n in names if n.startswith(prefix))


def keep_only(spark, path: str, name: str) -> int:
    """Deletes the folders of other runs below a path; returns how many went."""
    top, fs = _folder(spark, path)
    others = [x.getPath() for x in fs.listStatus(top) if x.getPath().getName().startswith("run=") and x.getPath().getName() != name]
    return sum(bool(fs.delete(x, True)) for x in others)
