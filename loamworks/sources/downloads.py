"""Fetching files with retries; the transport is given by the caller."""

from __future__ import annotations

import fcntl
import os
import time
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

Fetch = Callable[[str], bytes]


def download(name: str, fetch: Fetch, folder: str, attempts: int = 5, wait: Callable[[float], None] = time.sleep) -> bool:
    """Fetch ``name`` into ``folder`` unless it is there: whole or not at all, waiting 2, 4, 8, ... seconds between attempts."""
    path = os.path.join(folder, name)
    if os.path.exists(path):
        return True
    os.makedirs(folder, exist_ok=True)
    for attempt in range(1, attempts + 1):
        part = f"{path}.{os.getpid()}.tmp"
        try:
            data = fetch(name)
            with open(part, "wb") as f:
                f.write(data)
            os.replace(part, path)
            return True
        except OSError:
            if os.path.exists(part):
                os.remove(part)
            if attempt < attempts:
                wait(2.0**attempt)
    return False


def download_all(names: Iterable[str], fetch: Fetch, folder: str, workers: int = 4, **options) -> dict[str, bool]:
    """Several files at once; which of them are there afterwards."""
    names = list(names)
    with ThreadPoolExecutor(workers) as pool:
        return dict(zip(names, pool.map(lambda n: download(n, fetch, folder, **options), names), strict=True))


def download_locked(name: str, fetch: Fetch, folder: str, after: Callable[[str], None] | None = None) -> str:
    """Fetch once among several processes; ``after`` runs on a fresh file before the lock is left."""
    path = os.path.join(folder, name)
    if os.path.exists(path):
        return path
    os.makedirs(folder, exist_ok=True)
    with open(f"{path}.lock", "w") as lock:
        fcntl.flock(lock, fcntl.LOCK_EX)
        if not os.path.exists(path):
            if not download(name, fetch, folder):
                raise FileNotFoundError(name)
            if after:
                after(path)
    return path
