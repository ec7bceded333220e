"""A ledger of paid replies: a file for each answered batch, written by the task that asked, before anything else is asked."""

from __future__ import annotations

import hashlib
import json
import posixpath
import uuid

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.sinks import files

_ENTRY = "gk string, batch long, texts array<struct<uid:string,jp_sha:string,cn:string>>"


class ReplyLedger:
    """A folder on a store that all executors reach. A batch's key is the hash of its group, number and prompt, so a changed prompt is another batch.

    Each batch has a folder of its own, each attempt a name of its own; a file appears under that name only once it is whole.
    So tasks that run twice, lost executors and jobs that end early lose no reply that was kept, and a batch that has a file
    isn't asked again. Only whole answers are kept.
    """

    def __init__(self, folder: str):
        self.folder = folder

    @staticmethod
    def key(gk: str, batch: int, prompt: str) -> str:
        return hashlib.sha256(f"{gk}\0{batch}\0{prompt}".encode()).hexdigest()

    def _at(self, key: str) -> str:
        return f"{self.folder}/{key[:2]}/{key}"

    def find(self, key: str) -> dict[str, str] | None:
        """A kept batch's texts by uid."""
        store, place = files.located(self._at(key))
        names = [i.path for i in store.get_file_info(fs.FileSelector(place, allow_not_found=True)) if i.path.endswith(".json")]
        if not names:
            return None
        with store.open_input_stream(min(names), compression=None) as f:
            return {t["uid"]: t["cn"] for t in json.loads(f.read())["texts"]}

    def keep(self, key: str, gk: str, batch: int, texts: list[tuple[str, str, str]]) -> None:
        """texts: uid, the hash of the source that was asked for, and the answer."""
        entry = {"gk": gk, "batch": batch, "texts": [dict(zip(("uid", "jp_sha", "cn"), t, strict=True)) for t in texts]}
        files.put(f"{self._at(key)}/{uuid.uuid4().hex}.json", json.dumps(entry, ensure_ascii=False).encode())

    def rows(self, spark: SparkSession) -> DataFrame:
        """(key, attempt, gk, batch, uid, jp_sha, cn): what all files hold; no rows without a folder."""
        if not files.exists(self.folder):
            return spark.createDataFrame([], "key string, attempt string, gk string, batch long, uid string, jp_sha string, cn string")
        found = spark.read.schema(_ENTRY).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").json(self.folder)
        place = F.split(F.col("_metadata.file_path"), "/")
        named = found.select(F.element_at(place, -2).alias("key"), F.element_at(place, -1).alias("attempt"), "gk", "batch", F.explode("texts").alias("t"))
        return named.select("key", "attempt", "gk", "batch", "t.*")

    def clear(self) -> None:
        """Forget everything, once it is kept elsewhere."""
        files.remove(self.folder)

    def __repr__(self) -> str:
        return f"ReplyLedger({posixpath.basename(self.folder)!r})"
