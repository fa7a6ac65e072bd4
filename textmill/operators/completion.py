"""The boundary to text generators: a protocol, retries, and a deterministic stand-in for tests."""

from __future__ import annotations

import hashlib
import time
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame


class Completer(Protocol):
    """Anything that answers prompts; it is made on the executor, once for each task."""

    def complete(self, prompts: list[str]) -> list[str]: ...


@dataclass(frozen=True)
class Echo:
    """A stand-in: the digest of the prompt, the same on every run."""

    prefix: str = "echo"

    def complete(self, prompts: list[str]) -> list[str]:
        return [f"{self.prefix}:{hashlib.sha256(p.encode()).hexdigest()[:12]}" for p in prompts]


@dataclass(frozen=True)
class Retry:
    """Attempts, and the pause in seconds before the next, doubled each time up to a limit."""

    attempts: int = 4
    first: float = 1.0
    most: float = 60.0

    def call(self, client: Completer, prompts: list[str]) -> list[str]:
        for k in range(self.attempts):
            try:
                return client.complete(prompts)
            except (TimeoutError, ConnectionError):
                if k + 1 == self.attempts:
                    raise
                time.sleep(min(self.first * 2**k, self.most))
        raise AssertionError


def complete(rows: DataFrame, prompt: str, out: str, client: Completer, batch: int = 32, retry: Retry = Retry()) -> DataFrame:
    """``rows`` with the answer in ``out`` and the error, if all attempts failed, in ``out``_error.

    A failed call fails its rows, not the job; partitions bound the calls in flight.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            answers: list[str | None] = []
            errors: list[str | None] = []
            prompts = frame[prompt].fillna("").tolist()
            for at in range(0, len(prompts), batch):
                part = prompts[at : at + batch]
                try:
                    answers += retry.call(client, part)
                    errors += [None] * len(part)
                except Exception as e:  # noqa: BLE001  the row carries it on
                    answers += [None] * len(part)
                    errors += [f"{type(e).__name__}: {e}"] * len(part)
            yield frame.assign(**{out: pd.Series(answers, index=frame.index, dtype="object"), f"{out}_error": pd.Series(errors, index=frame.index, dtype="object")})

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema] + [f"`{out}` string", f"`{out}_error` string"]
    return rows.mapInPandas(run, ", ".join(fields))
