"""Connectors of chat and embedding endpoints, for the injected model functions.

They speak the common JSON protocol over the standard library, keep to a rate,
and try again after outcomes that are worth it.  One lives in each task that calls
it, with its share of the global rate.
"""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.request
from collections.abc import Callable
from dataclasses import dataclass, field

from tracequarry.operators.health import AbortMonitor, RETRYABLE, TokenBucket, answer_class, error_class

#: Seconds that each attempt of a request may take.
TIMEOUTS = (60.0, 90.0, 120.0)


class RequestFailed(RuntimeError):
    def __init__(self, outcome: str, said: str):
        super().__init__(f"{outcome}: {said}")
        self.outcome = outcome


@dataclass
class Endpoint:
    """POSTs JSON to paths below ``url`` and returns the parsed answer."""

    url: str
    key: str = ""
    bucket: TokenBucket = field(default_factory=lambda: TokenBucket(20.0))
    monitor: AbortMonitor = field(default_factory=AbortMonitor)
    timeouts: tuple[float, ...] = TIMEOUTS
    clock: Callable[[], float] = time.monotonic
    sleep: Callable[[float], None] = time.sleep

    def _once(self, path: str, payload: dict, seconds: float) -> tuple[str, str, dict | None]:
        """Outcome, error text and answer of one attempt."""
        headers = {"Content-Type": "application/json"} | ({"Authorization": f"Bearer {self.key}"} if self.key else {})
        request = urllib.request.Request(f"{self.url.rstrip('/')}{path}", json.dumps(payload).encode(), headers)
        try:
            with urllib.request.urlopen(request, timeout=seconds) as answer:
                body = answer.read().decode("utf-8", "replace")
                try:
                    return "success", "", json.loads(body)
                except ValueError:
                    return answer_class(answer.status, body, True), body[:200], None
        except urllib.error.HTTPError as e:
            said = e.read().decode("utf-8", "replace")
            return answer_class(e.code, said), said[:200], None
        except OSError as e:  # no answer: refused, reset, too late
            return error_class(e), f"{type(e).__name__}: {e}", None

    def post(self, path: str, payload: dict) -> dict:
        """The answer; ``RequestFailed`` once no further attempt is worth it or the run has to stop."""
        for seconds in self.timeouts:
            if self.monitor.reason:
                raise RequestFailed("aborted", self.monitor.reason)
            self.sleep(self.bucket.wait(self.clock()))
            outcome, said, answer = self._once(path, payload, seconds)
            self.monitor.record(outcome)
            if outcome == "success":
                return answer
            if outcome not in RETRYABLE:
                break
        raise RequestFailed(outcome, said)


def chat_model(endpoint: Endpoint, model: str, **options) -> Callable[[list[dict]], "str | None"]:
    """A chat model: messages to text; None after a failed request."""

    def ask(messages: list[dict]) -> str | None:
        try:
            answer = endpoint.post("/chat/completions", {"model": model, "messages": messages, **options})
            return answer["choices"][0]["message"]["content"]
        except (RequestFailed, KeyError, IndexError, TypeError):
            return None

    return ask


def embedding_model(endpoint: Endpoint, model: str) -> Callable[[list[str]], list[list[float]]]:
    """An embedder: vectors in the order of the texts, whatever the order of the answer."""

    def embed(texts: list[str]) -> list[list[float]]:
        found = sorted(endpoint.post("/embeddings", {"model": model, "input": texts})["data"], key=lambda x: x["index"])
        if len(found) != len(texts):
            raise ValueError(f"{len(found)} vectors for {len(texts)} texts")
        return [x["embedding"] for x in found]

    return embed
