"""Clients of model stages: anything with complete(prompt, attempt=, model=) -> (text, stop_reason). Offline ones and a router."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence


class TransientError(Exception):
    """Worth another try: a lost connection, an overloaded server, a rate limit."""


class UsageLimit(Exception):
    """The account's limit: the run ends, nothing is retried."""


class ScriptedClient:
    """Answers are what script(prompt, attempt, model) returns; for tests and offline runs."""

    def __init__(self, script: Callable[[str, int, str | None], tuple[str, str]]):
        self.script = script

    def complete(self, prompt: str, attempt: int = 1, model: str | None = None) -> tuple[str, str]:
        return self.script(prompt, attempt, model)


class Router:
    """Backends in order. Transient errors are retried, waiting 4 s and twice as long each time, 60 s at most; a backend that
    fails for good is demoted, and the next one asked from then on. Where none is left, the last error is raised. A refusal is
    an answer of its own shape: no text, stop_reason `refusal`."""

    def __init__(self, backends: Sequence, tries: int = 8, first: float = 4.0, longest: float = 60.0, sleep: Callable[[float], None] = time.sleep):
        self.backends, self.tries, self.first, self.longest, self.sleep = list(backends), tries, first, longest, sleep

    def complete(self, prompt: str, attempt: int = 1, model: str | None = None) -> tuple[str, str]:
        while True:
            try:
                text, stop = self._patiently(prompt, attempt, model)
            except UsageLimit:
                raise
            except Exception:
                if len(self.backends) == 1:
                    raise
                self.backends.pop(0)
                continue
            return ("", "refusal") if stop == "refusal" else (text, stop)

    def _patiently(self, prompt: str, attempt: int, model: str | None) -> tuple[str, str]:
        for k in range(self.tries):
            try:
                return self.backends[0].complete(prompt, attempt=attempt, model=model)
            except TransientError:
                if k == self.tries - 1:
                    raise
                self.sleep(min(self.longest, self.first * 2**k))
        raise AssertionError


def evaluated(evals: Sequence[tuple[str, Callable[[], None]]], partial: bool) -> list[tuple[str, str, str | None]]:
    """(name, status, message) of the evaluations after a run: a failure is a warning, a partial run skips them all."""
    out = []
    for name, f in evals:
        if partial:
            out.append((name, "skipped", None))
            continue
        try:
            f()
            out.append((name, "done", None))
        except Exception as e:  # an evaluation never takes the run with it
            out.append((name, "failed", str(e)))
    return out
