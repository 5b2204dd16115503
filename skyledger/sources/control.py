"""The driver's side of ingestion: request windows, retries, rates, cached responses, pages, and the record of each run.

No HTTP client is part of the engine: ``get`` is any callable that answers a request, and landed payloads are read by Spark.
"""

from __future__ import annotations

import hashlib
import random
import time
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from datetime import datetime, timedelta
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RUNS = "run_id string, source string, status string, requested_start timestamp_ntz, requested_end timestamp_ntz, records_received long, records_written long, records_rejected long, error string"


def retry_delays(attempts: int = 3, base: float = 2.0, jitter: float = 0.1, rng: random.Random | None = None) -> Iterator[float]:
    """Seconds before each further attempt: doubled each time, a tenth more or less, never under a tenth of a second."""
    rng = rng or random.Random()
    for k in range(attempts):
        delay = base * 2**k
        yield max(0.1, delay + rng.uniform(-jitter, jitter) * delay)


def with_retry(call: Callable[[], Any], attempts: int = 3, sleep: Callable[[float], None] = time.sleep, rng: random.Random | None = None) -> Any:
    """The call's answer; timeouts and lost connections are tried anew, other errors are not."""
    delays = list(retry_delays(attempts, rng=rng))
    for k in range(attempts):
        try:
            return call()
        except (TimeoutError, ConnectionError):
            if k + 1 == attempts:
                raise
            sleep(delays[k])


@dataclass
class TokenBucket:
    """At most ``per_minute`` requests at once, refilled evenly."""

    per_minute: int
    clock: Callable[[], float] = time.monotonic
    sleep: Callable[[float], None] = time.sleep
    tokens: float = field(init=False)
    at: float = field(init=False)

    def __post_init__(self) -> None:
        self.tokens, self.at = float(self.per_minute), self.clock()

    def acquire(self, n: int = 1) -> bool:
        now = self.clock()
        self.tokens, self.at = min(self.per_minute, self.tokens + (now - self.at) * self.per_minute / 60), now
        if self.tokens + 1e-9 < n:
            return False
        self.tokens -= n
        return True

    def wait(self, n: int = 1) -> None:
        if n > self.per_minute:
            raise ValueError("more than the bucket holds")
        while not self.acquire(n):
            self.sleep((n - self.tokens) * 60 / self.per_minute)


def cache_key(url: str) -> str:
    return hashlib.md5(url.encode()).hexdigest()


class ResponseCache:
    """Responses in the landing zone, one small table for each URL under its key."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def put(self, url: str, body: str) -> None:
        self.spark.createDataFrame([(url, body)], "url string, body string").coalesce(1).write.mode("overwrite").parquet(f"{self.root}/{cache_key(url)}")

    def get(self, url: str) -> str | None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{cache_key(url)}")
        if not path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path):
            return None
        row = self.spark.read.schema("url string, body string").parquet(path.toString()).where(F.col("url") == url).first()
        return row and row.body


def pages(get: Callable[[str | None], tuple[int, dict]], most: int | None = None) -> Iterator[dict]:
    """Bodies of a cursor's pages. A 404 ends the walk with what there is; other errors raise, and are worth another attempt if transient."""
    cursor, n = None, 0
    while most is None or n < most:
        status, body = get(cursor)
        if status == 404:
            return
        if status in (408, 429, 500, 502, 503, 504):
            raise ConnectionError(f"status {status}")
        if not 200 <= status < 300:
            raise PermissionError(f"status {status}")
        yield body
        n += 1
        cursor = ((body.get("meta") or {}).get("next") or {}).get("cursor")
        if not cursor:
            return


def landed_pages(spark: SparkSession, root: str) -> DataFrame:
    """(payload, ingested_at, and partition columns such as location_id) of whole landed files, one payload each."""
    files = spark.read.text(root, wholetext=True)
    return files.select(F.col("value").alias("payload"), F.col("_metadata.file_modification_time").cast("timestamp_ntz").alias("ingested_at"), *(c for c in files.columns if c != "value"))


def record_run(spark: SparkSession, root: str, run: dict) -> None:
    names = [c.split()[0] for c in RUNS.split(", ")]
    spark.createDataFrame([tuple(run.get(c) for c in names)], RUNS).coalesce(1).write.mode("append").parquet(root)


def ingest(spark: SparkSession, source: str, fetch: Callable[[datetime, datetime], DataFrame], parse: Callable[[DataFrame], DataFrame], write: Callable[[DataFrame, str], None], runs: str, now: datetime, last_event: datetime | None = None, lookback_hours: float = 6.0) -> dict:
    """One run: the window from the watermark, else the lookback, to now; fetch, parse, write, and a record of the run.

    A failed run is recorded as failed and raises; as only successful runs count for the watermark, the next run asks for the same window.
    """
    run = {"run_id": str(uuid.uuid4()), "source": source, "requested_start": last_event or now - timedelta(hours=lookback_hours), "requested_end": now}
    try:
        payloads = fetch(run["requested_start"], run["requested_end"])
        rows = parse(payloads)
        run |= {"records_received": payloads.count(), "records_written": rows.count(), "records_rejected": 0}
        write(rows, run["run_id"])
        run["status"] = "success"
    except Exception as e:
        run |= {"status": "failed", "error": str(e)[:2000]}
        raise
    finally:
        record_run(spark, runs, run)
    return run
