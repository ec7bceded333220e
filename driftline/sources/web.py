"""HTTP: one request, and many files fetched by the executors."""

from __future__ import annotations

import json
import urllib.request
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.sinks import files
from driftline.sources.documents import exists

Get = Callable[..., bytes]
ATTEMPTS, TIMEOUT, WORKERS = 3, 30, 32


def get(url: str, headers: dict[str, str] | None = None, timeout: float = TIMEOUT) -> bytes:
    """The body of a 2xx answer. Proxies come from the environment, hosts in no_proxy go direct, TLS is verified."""
    with urllib.request.urlopen(urllib.request.Request(url, headers=headers or {}), timeout=timeout) as reply:  # noqa: S310
        return reply.read()


def stored(spark: SparkSession, folder: str) -> DataFrame:
    """(name, n_bytes) of a folder's files, without reading them; no rows where it is missing."""
    if not exists(spark, folder):
        return spark.createDataFrame([], "name string, n_bytes long")
    found = spark.read.format("binaryFile").load(folder)
    return found.select(F.regexp_extract("path", "[^/]*$", 0).alias("name"), F.col("length").alias("n_bytes"))


def eligible(resources: DataFrame, prefix: str = "adv_", suffix: str = ".txt") -> DataFrame:
    return resources.filter(F.col("name").startswith(prefix) & F.col("name").endswith(suffix))


def missing(wanted: DataFrame, log: DataFrame, held: DataFrame) -> DataFrame:
    """Wanted resources without both an ok in the log (name, state) and a file (name, n_bytes) that isn't empty."""
    done = log.filter("state = 'ok'").join(held.filter("n_bytes > 0"), "name", "left_semi").select("name")
    return wanted.join(done, "name", "left_anti")


def fetch(wanted: DataFrame, url_format: str, folder: str, headers: dict[str, str] | None = None, workers: int = WORKERS, fetcher: Get = get) -> DataFrame:
    """(name, state): each (name, objectName) fetched into a file; ok, or the last of three errors. Write the result before using it twice."""

    def one(name: str, key: str) -> str:
        state = ""
        for _ in range(ATTEMPTS):
            try:
                body = fetcher(url_format.replace("{o}", key), headers, TIMEOUT)
                if not body:
                    raise ValueError("empty answer")
                files.put(f"{folder}/{files.safe_name(name)}", body)
                return "ok"
            except Exception as e:  # noqa: BLE001  a failed file is a row, not a failed job
                state = str(e)[:60] or type(e).__name__
        return state

    def run(frames):
        for frame in frames:
            yield pd.DataFrame({"name": frame["name"], "state": [one(n, k) for n, k in zip(frame["name"], frame["objectName"], strict=True)]})

    return wanted.select("name", "objectName").repartition(workers, "name").mapInPandas(run, "name string, state string")


def logged(log: DataFrame, tried: DataFrame) -> DataFrame:
    """The log after a run: what was tried and failed is no longer in it."""
    return log.join(tried, "name", "left_anti").unionByName(tried.filter("state = 'ok'"))


def refresh_release(api: str, folder: str, fetcher: Get = get) -> tuple[str, bool]:
    """Unpack the newest release of a package unless version.txt names it already; its tag, and whether it is new."""
    release = json.loads(fetcher(api, {"Accept": "application/json"}, TIMEOUT))
    tag, mark = release["tag_name"], f"{folder}/version.txt"
    if files.exists(mark) and files.get(mark).decode().strip() == tag:
        return tag, False
    files.extract_zip(fetcher(release["assets"][0]["browser_download_url"], None, 120), folder)
    files.put(mark, tag.encode())
    return tag, True


def refresh_archive(url: str, folder: str, fetcher: Get = get) -> str | None:
    """Unpack an archive; if that fails and there is an older folder, keep it and return the error."""
    try:
        files.extract_zip(fetcher(url, None, 120), folder)
    except Exception as e:  # noqa: BLE001
        if not files.exists(folder):
            raise
        return str(e)
    return None
