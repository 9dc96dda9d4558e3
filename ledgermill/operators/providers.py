"""Completion providers by name. Network calls are injected; nothing here opens a connection."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping


class UnknownProviderError(ValueError):
    pass


class VisionUnsupportedError(ValueError):
    pass


class Pace:
    """At least ``interval`` seconds between calls; the first never waits."""

    def __init__(self, interval: float, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep) -> None:
        self.interval, self.clock, self.sleep, self.last = interval, clock, sleep, None

    def wait(self) -> None:
        if self.last is not None and (left := self.interval - (self.clock() - self.last)) > 0:
            self.sleep(left)
        self.last = self.clock()


PROVIDERS = {"lm_studio": True, "gemini": True, "groq": False}  # name: whether it reads images


def provider(name: str, post: Callable[[str, object, dict], dict], pace: Pace | None = None) -> Callable[[str, object, dict], dict]:
    """complete(prompt, given, schema) that goes through ``post`` at the pace."""
    if name not in PROVIDERS:
        raise UnknownProviderError(name)

    def complete(prompt: str, given: object, schema: dict) -> dict:
        if isinstance(given, (bytes, bytearray)) and not PROVIDERS[name]:
            raise VisionUnsupportedError(name)
        if pace:
            pace.wait()
        return post(prompt, given, gemini_schema(schema) if name == "gemini" else schema)

    return complete


def provider_from_env(env: Mapping[str, str], post) -> Callable[[str, object, dict], dict]:
    return provider(env.get("LLM_FALLBACK_PROVIDER", "lm_studio"), post)


def gemini_schema(schema: dict) -> dict:
    """Nullable unions as ``nullable``, no additionalProperties, all the way down."""
    out = {}
    for key, value in schema.items():
        if key == "additionalProperties":
            continue
        if key == "type" and isinstance(value, list):
            rest = [x for x in value if x != "null"]
            out["type"] = rest[0]
            if len(rest) < len(value):
                out["nullable"] = True
        elif key == "properties":
            out[key] = {k: gemini_schema(v) for k, v in value.items()}
        elif key == "items":
            out[key] = gemini_schema(value)
        else:
            out[key] = value
    return out
