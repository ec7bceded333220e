"""Batch functions that answer a prompt, and how their replies are read."""

from __future__ import annotations

import json
import re
import urllib.request
from dataclasses import dataclass
from typing import Protocol


class Backend(Protocol):
    """Answers prompts; several threads may ask at a time."""

    def translate(self, prompt: str) -> str: ...


def read_reply(reply: str, uids: list[str]) -> dict[str, str]:
    """Texts by uid: segments by their [uid] prefix, the last of a uid; if none has one and their number fits, by position; else none."""
    parts = [p for p in (x.strip() for x in re.split(r"\n\s*---\s*\n", reply)) if p]
    named = {}
    for p in parts:
        uid = next((u for u in uids if p.startswith(f"[{u}]")), None)
        if uid is not None:
            named[uid] = p[len(uid) + 2 :].strip()
    if named:
        return named
    return dict(zip(uids, parts, strict=True)) if len(parts) == len(uids) else {}


def endpoint(base: str, path: str) -> str:
    """The base without a last slash, and the path once."""
    base = base.rstrip("/")
    return base if base.endswith(path) else base + path


def _post(url: str, body: dict, headers: dict[str, str], timeout: float) -> dict:
    request = urllib.request.Request(url, json.dumps(body).encode(), {"Content-Type": "application/json", **headers})
    with urllib.request.urlopen(request, timeout=timeout) as reply:  # noqa: S310  TLS is verified
        return json.load(reply)


@dataclass
class ChatBackend:
    base_url: str
    model: str
    key: str
    timeout: float = 180

    def translate(self, prompt: str) -> str:
        return self.text(_post(endpoint(self.base_url, "/chat/completions"), {"model": self.model, "messages": [{"role": "user", "content": prompt}]}, {"Authorization": f"Bearer {self.key}"}, self.timeout))

    @staticmethod
    def text(reply: dict) -> str:
        """The first choice's text; a reply without one is an error."""
        if not reply.get("choices"):
            raise ValueError(f"no choices: {json.dumps(reply)[:200]}")
        message = reply["choices"][0].get("message") if isinstance(reply["choices"][0], dict) else None
        if not isinstance(message, dict) or not isinstance(message.get("content"), str):
            raise ValueError(f"no text in the first choice: {json.dumps(reply)[:200]}")
        return message["content"].strip()


@dataclass
class MessagesBackend:
    base_url: str
    model: str
    key: str
    timeout: float = 180
    max_tokens: int = 4096
    api_version: str = "2023-06-01"

    def translate(self, prompt: str) -> str:
        body = {"model": self.model, "max_tokens": self.max_tokens, "messages": [{"role": "user", "content": prompt}]}
        return self.text(_post(endpoint(self.base_url, "/v1/messages"), body, {"x-api-key": self.key, "anthropic-version": self.api_version}, self.timeout))

    @staticmethod
    def text(reply: dict) -> str:
        """The first text block; a reply without one is an error."""
        texts = [b["text"] for b in reply.get("content") or () if isinstance(b, dict) and b.get("type") == "text" and isinstance(b.get("text"), str)]
        if not texts:
            raise ValueError(f"no text block: {json.dumps(reply)[:200]}")
        return texts[0].strip()


@dataclass
class EchoBackend:
    """Deterministic, for tests and dry runs: answers each item of a prompt with its text in upper case."""

    def translate(self, prompt: str) -> str:
        return "\n---\n".join(f"[{u}] {t.upper()}" for u, t in re.findall(r"^\[(\S+)\] (?:\([^)]*\) )?(.*)$", prompt, re.M))


def create_backend(kind: str, **options) -> Backend:
    kinds = {"openai": ChatBackend, "anthropic": MessagesBackend, "echo": EchoBackend}
    if kind not in kinds:
        raise ValueError(f"unknown backend {kind!r}; known: {', '.join(kinds)}")
    return kinds[kind](**options)
