"""The manifest of resources: from its service, from a JSON copy, from an encrypted cache file."""

from __future__ import annotations

import urllib.parse
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.sinks import files
from driftline.sources import web
from driftline.sources.wire import MANIFEST, decode_manifest

SHORTEST = 32


@dataclass
class ManifestOptions:
    """Where the manifest is and how it is encrypted; headers may hold {app_id} and {client_secret}."""

    url: str = ""
    app_id: int = 400
    version: str = ""
    client_secret: str = ""
    api_key_seed: str = ""
    cache_key: str = ""
    cache_iv: str = ""
    headers: dict[str, str] = field(default_factory=dict)

    def list_url(self, revision: int = 0) -> str:
        return urllib.parse.urljoin(self.url, f"v2/pub/a/{self.app_id}/v/{self.version}/list/{revision}")

    def filled_headers(self) -> dict[str, str]:
        return {k: v.replace("{app_id}", str(self.app_id)).replace("{client_secret}", self.client_secret) for k, v in self.headers.items()}


def decrypt_reply(content: Column, seed: str) -> Column:
    """AES-CBC by the seed's SHA-256; the first 16 bytes are the vector."""
    return F.aes_decrypt(content, F.unhex(F.sha2(F.lit(seed), 256)), F.lit("CBC"), F.lit("PKCS"))


def decrypt_cache(content: Column, key: str, vector: str) -> Column:
    """AES-CBC by a fixed key and vector after one byte; the text follows 16 bytes of checksum."""
    plain = F.aes_decrypt(F.concat(F.unhex(F.lit(vector)), F.substring(content, F.lit(2), F.length(content))), F.unhex(F.lit(key)), F.lit("CBC"), F.lit("PKCS"))
    return F.substring(plain, F.lit(17), F.length(plain))


def decoded(rows: DataFrame, plain: Column) -> DataFrame:
    return rows.select(decode_manifest(plain).alias("m")).select("m.*")


def fetch_manifest(spark: SparkSession, options: ManifestOptions, revision: int = 0, fetcher: web.Get = web.get) -> DataFrame:
    """The service's manifest, one row."""
    body = fetcher(options.list_url(revision), options.filled_headers(), web.TIMEOUT)
    if len(body) < SHORTEST:
        raise ValueError("the manifest's answer is too short")
    return decoded(spark.createDataFrame([(bytearray(body),)], "content binary"), decrypt_reply(F.col("content"), options.api_key_seed))


def read_cache(spark: SparkSession, path: str, options: ManifestOptions) -> DataFrame:
    return decoded(spark.read.format("binaryFile").load(path).select("content"), decrypt_cache(F.col("content"), options.cache_key, options.cache_iv))


def read_json(spark: SparkSession, path: str) -> DataFrame:
    """A manifest's JSON copy; fields it doesn't know are left out."""
    return spark.read.text(path, wholetext=True).select(F.from_json("value", MANIFEST, {"mode": "FAILFAST"}).alias("m")).select("m.*")


def write_json(manifest: DataFrame, path: str) -> None:
    """The whole manifest as JSON, 64-bit numbers as texts."""
    rows = manifest
    for name in ("assetBundleList", "resourceList"):
        rows = rows.withColumn(name, F.transform(name, lambda r: r.withField("generation", r["generation"].cast("string"))))
    files.put(path, rows.select(F.to_json(F.struct(*rows.columns)).alias("j")).first()["j"].encode())


def index_json(manifest: DataFrame) -> str:
    """The short index: revision, urlFormat, and both names of each resource."""
    short = F.transform("resourceList", lambda r: F.struct(r["name"].alias("name"), r["objectName"].alias("objectName")))
    return manifest.select(F.to_json(F.struct("revision", "urlFormat", short.alias("resources"))).alias("j")).first()["j"]


def resources(manifest: DataFrame) -> DataFrame:
    return manifest.select(F.explode("resourceList").alias("r")).select("r.*")


def load_manifest(spark: SparkSession, options: ManifestOptions, json_path: str, cache_path: str, fetcher: web.Get = web.get) -> tuple[DataFrame, str]:
    """The manifest and its origin: the service (then kept as JSON), else the JSON copy, else the cache file, else an error."""
    try:
        write_json(fetch_manifest(spark, options, fetcher=fetcher), json_path)
        return read_json(spark, json_path), "service"
    except Exception as e:  # noqa: BLE001  any failure falls back
        if files.exists(json_path):
            return read_json(spark, json_path), "json"
        if files.exists(cache_path):
            return read_cache(spark, cache_path, options), "cache"
        raise RuntimeError(f"no manifest: the service failed ({str(e)[:200]}), and there is no copy") from e
