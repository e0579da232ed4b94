"""Pages and downloads over HTTP, with retries; every caller can bring its own fetcher."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from datetime import UTC, datetime
from email.utils import parsedate_to_datetime
from urllib.error import HTTPError, URLError
from urllib.request import Request, urlopen

import pandas as pd
from pyspark.sql import DataFrame

from quarry.functions.urls import TRANSIENT

AGENT = "Mozilla/5.0 (compatible; quarry)"
ATTEMPTS, PIECE, MOST_BYTES = 3, 1 << 20, 512 << 20


@dataclass(frozen=True)
class Answer:
    """What a request gave; no status: the network failed."""

    url: str
    status: int | None
    content_type: str | None = None
    body: bytes = b""
    error: str = ""


def retry_after(value: str | None, fallback: float, now: Callable[[], datetime] = lambda: datetime.now(UTC)) -> float:
    """Seconds to wait: a number, or the time until an HTTP date; 0 or nonsense gives the fallback."""
    value = (value or "").strip()
    if value.isdigit():
        return float(value) or fallback
    try:
        until = parsedate_to_datetime(value)
    except (TypeError, ValueError):
        return fallback
    until = until if until.tzinfo else until.replace(tzinfo=UTC)
    return max(0.0, (until - now()).total_seconds()) or fallback


def request(url: str, method: str = "GET", timeout: float = 20.0, headers: dict[str, str] | None = None, most: int = MOST_BYTES, opener: Callable = urlopen, sleep: Callable[[float], None] = time.sleep) -> Answer:
    """One request, tried up to three times while the answer is transient or there is none."""
    answer = Answer(url, None, error="not tried")
    for attempt in range(ATTEMPTS):
        wait = float(attempt + 1)
        try:
            with opener(Request(url, method=method, headers={"User-Agent": AGENT} | (headers or {})), timeout=timeout) as r:
                kind = (r.headers.get("Content-Type") or "").split(";")[0].strip().lower() or None
                pieces, size = [], 0
                while method != "HEAD" and (piece := r.read(PIECE)):
                    size += len(piece)
                    if size > most:
                        return Answer(url, r.status, kind, error=f"download is larger than {most} bytes")
                    pieces.append(piece)
                return Answer(url, r.status, kind, b"".join(pieces))
        except HTTPError as e:
            answer = Answer(url, e.code, (e.headers.get("Content-Type") or "").split(";")[0] or None if e.headers else None, error=f"HTTP {e.code}")
            if e.code not in TRANSIENT:
                return answer
            wait = retry_after(e.headers.get("Retry-After") if e.headers else None, wait)
        except (URLError, OSError, ValueError) as e:
            answer = Answer(url, None, error=str(e))
        if attempt < ATTEMPTS - 1:
            sleep(wait)
    return answer


def probe(url: str, timeout: float = 20.0, ask: Callable[..., Answer] = request) -> Answer:
    """HEAD, or the first byte by GET where HEAD is refused or fails."""
    head = ask(url, method="HEAD", timeout=timeout)
    if head.status in (405, 501, None):
        return ask(url, timeout=timeout, headers={"Range": "bytes=0-0"})
    return head


def fetched(urls: DataFrame, get: Callable[[str], Answer] = request, delay: float = 0.0) -> DataFrame:
    """(url, status, content_type, body, error) for each row of (url), on the executors."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for url in batch["url"]:
                if delay:
                    time.sleep(delay)
                a = get(url)
                yield pd.DataFrame({"url": [url], "status": pd.array([a.status], "Int32"), "content_type": [a.content_type], "body": [a.body], "error": [a.error]})

    return urls.select("url").mapInPandas(run, "url string, status int, content_type string, body binary, error string")
