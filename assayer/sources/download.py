"""Attachments over HTTPS, kept by the digest of their address. They are fetched in tasks, each address once."""

from __future__ import annotations

import hashlib
import os
import shutil
import time
import uuid
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from pathlib import Path
from urllib.parse import urlparse

import pandas as pd
from pyspark.sql import DataFrame

from ..operators.validation import Invalid
from .shared import materialised

Fetch = Callable[[str, Path], None]


def https_fetch(url: str, to: Path) -> None:
    with urllib.request.urlopen(url, timeout=300) as reply, to.open("wb") as out:  # noqa: S310  the scheme is checked
        shutil.copyfileobj(reply, out)


def download(url: str, to: Path, fetch: Fetch = https_fetch, attempts: int = 3, sleep: Callable[[float], None] = time.sleep) -> int:
    """Fetches url beside `to` and moves it there; tries again after 1, 2, ... seconds. Gives the number of tries.

    What lies beside has a name of its own, so that two runs of one task don't meet."""
    if urlparse(url).scheme != "https" or not urlparse(url).hostname:
        raise Invalid("attachments come over HTTPS")
    to.parent.mkdir(parents=True, exist_ok=True)
    for n in range(1, attempts + 1):
        part = to.parent / f"{uuid.uuid4().hex}.part"
        try:
            fetch(url, part)
            os.replace(part, to)
            return n
        except (urllib.error.URLError, OSError) as e:
            part.unlink(missing_ok=True)
            reason = f"HTTP {e.code}" if isinstance(e, urllib.error.HTTPError) else type(e).__name__
            if n < attempts:
                sleep(n)
    raise Invalid(f"an attachment can't be fetched ({reason})")


CONTENT = "content"


def kept(url: str, folder: Path) -> Path:
    """Where an address's contents are or will be. A file of any name in the address's own folder is taken for them."""
    own = folder / hashlib.sha256(url.encode()).hexdigest()
    there = sorted(p for p in own.iterdir() if p.suffix != ".part") if own.is_dir() else []
    return there[0] if there else own / CONTENT


def fetched(requests: DataFrame, folder: Path, fetch: Fetch = https_fetch, attempts: int = 3, sleep: Callable[[float], None] = time.sleep, tasks: int | None = None) -> DataFrame:
    """(url, full, attempts, error) of every different address of requests(url): fetched in tasks unless it is kept in
    folder already (0 attempts), which must be one that driver and executors share.

    Rows are grouped by address before they are dealt out, so that an address is fetched once however many ask for it. A
    task that is run again finds what its first run has moved into place, and fetches the rest. The result is stored:
    reading it doesn't fetch. An address that can't be had has an error and no file.
    """
    spark = requests.sparkSession

    def one(url: str) -> tuple[str | None, int, str | None]:
        to = kept(url, folder)
        try:
            return str(to), 0 if to.exists() else download(url, to, fetch, attempts, sleep), None
        except Invalid as e:
            return None, attempts, str(e)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([(url, *one(url)) for url in batch["url"]], columns=["url", "full", "attempts", "error"])

    apart = requests.where("url is not null").select("url").distinct().repartition(tasks or spark.sparkContext.defaultParallelism, "url")
    return materialised(apart.mapInPandas(run, "url string, full string, attempts int, error string"))
