"""Fetching over HTTP, one task per host, with pacing, retries and a deadline."""

from __future__ import annotations

import time
import urllib.error
import urllib.request
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.functions import text as T
from tablewright.functions.urls import url_host

RESPONSE = "status_code int, body binary, content_type string, error string"


class BudgetExhausted(RuntimeError):
    pass


@dataclass(frozen=True)
class Policy:
    agent: str = "tablewright"
    delay_seconds: float = 1.0
    attempts: int = 3
    timeout_seconds: float = 45
    budget_seconds: float | None = None


#: The older crawler's habits.
OLDER = Policy(agent="Mozilla/5.0 (X11; Linux x86_64)", delay_seconds=0.4)


class HttpClient:
    """fetch(url) gives (code, body, content type, error). 429 waits for Retry-After or 30 s times the attempt,
    5xx and network errors 3 s times the attempt; other errors are final. Code 0: no answer at all."""

    def __init__(self, policy: Policy, sleep: Callable = time.sleep, clock: Callable = time.monotonic, urlopen: Callable = urllib.request.urlopen):
        self.policy, self.sleep, self.clock, self.urlopen = policy, sleep, clock, urlopen
        self.began, self.last = clock(), None

    def _pace(self) -> None:
        now = self.clock()
        if self.policy.budget_seconds is not None and now - self.began > self.policy.budget_seconds:
            raise BudgetExhausted(f"{now - self.began:.0f} s of {self.policy.budget_seconds:.0f} s used")
        if self.last is not None and (wait := self.policy.delay_seconds - (now - self.last)) > 0:
            self.sleep(wait)
        self.last = self.clock()

    def fetch(self, url: str) -> tuple[int, bytes, str, str | None]:
        self._pace()
        request = urllib.request.Request(url, headers={"User-Agent": self.policy.agent})
        seen = (0, b"", "", "no attempt")
        for attempt in range(1, self.policy.attempts + 1):
            last = attempt == self.policy.attempts
            try:
                with self.urlopen(request, timeout=self.policy.timeout_seconds) as r:
                    return r.status, r.read(), r.headers.get("Content-Type", ""), None
            except urllib.error.HTTPError as e:
                seen = (e.code, b"", "", str(e))
                if e.code == 429:
                    after = e.headers.get("Retry-After", "") if e.headers else ""
                    pause = int(after) if after.isdigit() else 30 * attempt
                elif e.code >= 500:
                    pause = 3 * attempt
                else:
                    return seen
            except (urllib.error.URLError, TimeoutError) as e:
                seen, pause = (0, b"", "", str(e)), 3 * attempt
            if not last:
                self.sleep(pause)
        return seen


def http_fetch(policy: Policy, urlopen: Callable = urllib.request.urlopen) -> Callable[[DataFrame], DataFrame]:
    """A fetch for harvest and census, with bodies as they were received: a host's requests stay in one task, so its pace holds, in the order of key (or url). What a spent
    budget leaves out is status `budget_exhausted`, never a lost ledger."""

    def fetch(wanted: DataFrame) -> DataFrame:
        names = wanted.columns

        def work(frames):
            import pandas as pd

            client = HttpClient(policy, urlopen=urlopen)
            for frame in frames:
                got = []
                for url in frame["url"]:
                    try:
                        code, body, kind, error = client.fetch(url)
                        got.append((code, body if 200 <= code < 300 else None, kind, error))
                    except BudgetExhausted as e:
                        got.append((None, None, None, f"budget: {e}"))
                yield pd.concat([frame.reset_index(drop=True), pd.DataFrame(got, columns=["status_code", "body", "content_type", "error"]).astype({"status_code": "Int32"})], axis=1)

        schema = ", ".join(f"`{c}` {t}" for c, t in wanted.dtypes) + ", " + RESPONSE
        asked = wanted.repartition(url_host(F.col("url"))).sortWithinPartitions("key" if "key" in names else "url").mapInPandas(work, schema)
        status = F.when(F.col("status_code").isNull(), "budget_exhausted").when(F.col("status_code") == 0, "network_error").otherwise(T.status_class(F.col("status_code")))
        return asked.select(*names, "status_code", status.alias("status"), "body", "error")

    return fetch
