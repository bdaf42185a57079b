"""Fetching over HTTP, outside Spark: what comes back is landed as JSON lines and read from there."""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def _waits(n: int) -> float:
    return 240 if n % 5 == 0 else 30


def get_bytes(url: str, data: bytes | None = None, timeout: float = 30, tries: int = 35, waits: Callable[[int], float] = _waits, opener: Callable = urllib.request.urlopen, sleep: Callable[[float], None] = time.sleep, parse: Callable = bytes):
    """What a URL answers, to a POST if there are data; None if it is not there (404). Other failures, and answers that
    can't be parsed, are tried again after a wait, then raised."""
    asked = url if data is None else urllib.request.Request(url, data=data)
    for n in range(1, tries + 1):
        try:
            with opener(asked, timeout=timeout) as reply:
                return parse(reply.read())
        except urllib.error.HTTPError as error:
            if error.code == 404:
                return None
            last: Exception = error
        except (OSError, ValueError) as error:
            last = error
        if n < tries:
            sleep(waits(n))
    raise last


def get_json(url: str, data: bytes | None = None, **options):
    """JSON that a URL answers; as get_bytes."""
    return get_bytes(url, data, parse=lambda body: json.loads(body.decode("utf-8-sig")), **options)


def fan_out(items: Iterable, fetch: Callable, threads: int = 20) -> list:
    """fetch(item) for all items on some threads, results in the items' order, None left out."""
    with ThreadPoolExecutor(threads) as pool:
        return [r for r in pool.map(fetch, items) if r is not None]


def landed(spark: SparkSession, path: str, schema: str, fetch: Callable[[], Iterable[dict]], force: bool = False) -> DataFrame:
    """The rows below a path; fetched and written first if they are not there, or if forced."""
    if not force:
        try:
            return spark.read.schema(schema).json(path)
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
    lines = [(json.dumps(row, ensure_ascii=False),) for row in fetch()]
    spark.createDataFrame(lines, "value string").write.mode("overwrite").text(path)
    return spark.read.schema(schema).json(path)


def is_forced(key: str, flags: dict[str, bool]) -> bool:
    """Whether a flag whose name is part of the key, or ``all``, is set."""
    return any(on and (name == "all" or name in key) for name, on in flags.items())
