"""Archiving live pages and assets: what is trusted is reused, the rest is fetched and stored."""

from __future__ import annotations

import hashlib
import os
import tempfile
from collections.abc import Callable, Iterator
from datetime import UTC, datetime

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions import urls as U
from quarry.functions.text import text_of
from quarry.lineage import cut
from quarry.operators.dedup import last_wins
from quarry.schemas import TABLES
from quarry.sources.web import Answer, request

SKIPPED = "inventory row is not a live archive target"
EMPTY = "download returned no body"


def should_archive(df: DataFrame) -> Column:
    """Live, with a known status below 400, and a page or an asset."""
    return (F.col("link_state") == "live") & F.coalesce(F.col("http_status") < 400, F.lit(False)) & F.col("resource_kind").isin(*U.HTML_KINDS, "asset")


def store(path: str, body: bytes) -> str:
    """Write a file whole or not at all; its SHA-256."""
    folder = os.path.dirname(path) or "."
    os.makedirs(folder, exist_ok=True)
    handle, temporary = tempfile.mkstemp(dir=folder)
    try:
        with os.fdopen(handle, "wb") as f:
            f.write(body)
        os.replace(temporary, path)
    except BaseException:
        os.unlink(temporary)
        raise
    return hashlib.sha256(body).hexdigest()


def trusted(previous: DataFrame) -> DataFrame:
    """(url, local_path, sha256) that an earlier manifest vouches for; the last row wins."""
    whole = previous.filter((F.col("archive_state") == "archived") & (F.col("url") != "") & (F.col("local_path") != "") & (F.col("sha256") != ""))
    return last_wins(whole.select("url", "local_path", "sha256", "seq"), ["url", "local_path"])


def _row(df: DataFrame, state: str, **columns: Column) -> DataFrame:
    blank = {c: F.lit("") for c in ("downloaded_at_utc", "sha256", "local_path", "error")}
    columns = blank | {"archive_state": F.lit(state)} | columns
    return df.select(*(columns.get(n, F.col(n)).alias(n) for n in TABLES["manifest"].names), "seq")


def archive(inventory: DataFrame, root: str, previous: DataFrame | None = None, files: DataFrame | None = None, download: Callable[[str], Answer] = request, write: Callable[[str, bytes], str] = store, now: Callable[[], datetime] = lambda: datetime.now(UTC)) -> DataFrame:
    """The manifest of an inventory with ``seq``; bodies are written below ``root`` by executors.

    A file is reused if it is not empty and its digest, in ``files``, is the one that
    ``previous`` has for the same URL and path.
    """
    stamp = F.lit(now().isoformat().replace("+00:00", "Z"))
    ok = should_archive(inventory)
    skipped = _row(inventory.filter(~ok), "skipped", error=F.lit(SKIPPED))
    path = U.archive_path(F.col("url"), F.col("resource_kind"), F.col("asset_kind"), F.col("content_type"), root)
    wanted = inventory.filter(ok).withColumn("_error", U.url_error(F.col("url"))).withColumn("_path", path)
    refused = _row(wanted.filter(F.col("_error") != ""), "failed", error=F.col("_error"), downloaded_at_utc=stamp)
    allowed = wanted.filter(F.col("_error") == "").withColumn("_held", F.lit(None).cast("string"))
    if previous is not None and files is not None:
        held = files.filter(F.col("size") > 0).select(F.col("local_path").alias("f_path"), F.col("sha256").alias("f_sha"))
        vouched = trusted(previous).select(F.col("url").alias("t_url"), F.col("local_path").alias("t_path"), F.col("sha256").alias("t_sha"))
        same = vouched.join(held, (F.col("t_path") == F.col("f_path")) & (F.col("t_sha") == F.col("f_sha")))
        allowed = allowed.join(same, (F.col("url") == F.col("t_url")) & (F.col("_path") == F.col("t_path")), "left").withColumn("_held", F.col("t_sha")).drop("t_url", "t_path", "t_sha", "f_path", "f_sha")
    reused = _row(allowed.filter(F.col("_held").isNotNull()), "archived", downloaded_at_utc=stamp, sha256=F.col("_held"), local_path=F.col("_path"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for url, where in zip(batch["url"], batch["_path"]):
                a = download(url)
                bad = a.status is None or a.status >= 400 or not a.body
                rows.append((url, where, a.status, a.content_type or "", "" if bad else write(where, a.body), (a.error or EMPTY) if bad else ""))
            yield pd.DataFrame(rows, columns=["url", "_path", "status", "type", "sha", "why"]).astype({"status": "Int32"})

    asked = allowed.filter(F.col("_held").isNull())
    # Fetched once and written to the shared folder: a lost executor must not download again, and get other bytes.
    answers = cut(asked.select("url", "_path").distinct().mapInPandas(run, "url string, _path string, status int, type string, sha string, why string"))
    back = asked.join(answers.select(F.col("url").alias("_u"), F.col("_path").alias("_p"), "status", "type", "sha", "why"), (F.col("url") == F.col("_u")) & (F.col("_path") == F.col("_p")))
    content = F.when(text_of("type") != "", F.col("type")).otherwise(F.col("content_type"))
    state = {"content_type": content, "http_status": F.col("status"), "downloaded_at_utc": stamp}
    stored = _row(back.filter(F.col("why") == ""), "archived", sha256=F.col("sha"), local_path=F.col("_path"), **state)
    failed = _row(back.filter(F.col("why") != ""), "failed", error=F.col("why"), **state)
    return skipped.unionByName(refused).unionByName(reused).unionByName(stored).unionByName(failed).orderBy("seq")


def counts(manifest: DataFrame) -> dict[str, int]:
    found = {r[0]: r[1] for r in manifest.groupBy("archive_state").count().collect()}
    return {s: found.get(s, 0) for s in ("archived", "skipped", "failed")}
