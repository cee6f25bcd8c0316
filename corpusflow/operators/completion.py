"""The text-completion step: a user-supplied callable, run in Arrow batches."""

from __future__ import annotations

import random
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import COMPLETION


@dataclass
class Completion:
    text: str | None
    input_tokens: int = 0
    output_tokens: int = 0


class TransientError(Exception):
    """Raise from a client to be called again, after ``retry_after`` seconds if given.
    ``rate_limited`` (as it is where an endpoint names a pause) is counted by itself."""

    def __init__(
        self, message: str = "", retry_after: float | None = None, rate_limited: bool | None = None
    ) -> None:
        super().__init__(message)
        self.retry_after = retry_after
        self.rate_limited = retry_after is not None if rate_limited is None else rate_limited


#: ``client(system, user, max_tokens) -> Completion``
Client = Callable[[str, str, int], Completion]


@dataclass
class CallPolicy:
    """How calls are made. Retries wait ``base * 2 ** attempt`` plus jitter."""

    max_tokens: int = 120
    max_retries: int = 5
    retry_base_seconds: float = 2.0
    concurrency: int = 8


def _call(client: Client, system: str, user: str, policy: CallPolicy) -> tuple:
    limited = 0
    for attempt in range(policy.max_retries + 1):
        try:
            done = client(system, user, policy.max_tokens)
            return (done.text or "").strip(), done.input_tokens or 0, done.output_tokens or 0, attempt - limited, limited, None
        except TransientError as e:
            if attempt == policy.max_retries:
                return "", 0, 0, attempt - limited, limited, str(e) or type(e).__name__
            limited += e.rate_limited
            pause = policy.retry_base_seconds * 2**attempt + random.uniform(0, 1)
            time.sleep(pause if e.retry_after is None else e.retry_after)
        except Exception as e:  # one bad row must not end the task
            return "", 0, 0, attempt - limited, limited, str(e) or type(e).__name__
    raise AssertionError("unreachable")


def complete(
    user: Column, system: str, make_client: Callable[[], Client], policy: CallPolicy | None = None
) -> Column:
    """``struct(raw, input_tokens, output_tokens, retries, rate_limited, error)`` per row.

    Only the user message crosses to Python; other columns wait in the JVM. The
    client is made once per task. A call that fails for good fills ``error``, and a
    response without text is the empty string. Marked non-deterministic so that the
    optimizer neither repeats calls nor moves filters across them.
    """
    rule = policy or CallPolicy()
    names = COMPLETION.fieldNames()

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        client = make_client()
        with ThreadPoolExecutor(max_workers=rule.concurrency) as pool:
            for batch in batches:
                rows = list(pool.map(lambda text: _call(client, system, text, rule), batch))
                yield pd.DataFrame(rows, columns=names)

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return F.pandas_udf(run, COMPLETION).asNondeterministic()(user)
