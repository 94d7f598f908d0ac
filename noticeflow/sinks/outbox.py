"""Sending from the driver, one payload at a time: a Spark task's retry would send twice."""

from __future__ import annotations

import hashlib
import json
import urllib.error
import urllib.request
from collections.abc import Callable
from dataclasses import dataclass

from .. import rules

Post = Callable[[bytes], tuple[int, bytes]]


@dataclass(frozen=True)
class Payload:
    flow: str
    candidate_id: str
    path: str
    data: bytes
    sha256: str


class NotSent(Exception):
    """Why a payload was not sent, or not confirmed."""


def gate(payload: Payload, mode: str, live: bool, declared: str | None = None) -> None:
    """Raises unless this mode sends this flow, the bytes are those of the manifest, and sending is meant."""
    if payload.flow not in rules.PUSHES.get(mode, ()):
        raise NotSent(f"{mode} does not send {payload.flow}")
    if hashlib.sha256(payload.data).hexdigest() != payload.sha256:
        raise NotSent("the payload is not the manifest's")
    if declared is not None and declared != payload.path:
        raise NotSent("the path is not the manifest's")
    if not live:
        raise NotSent("dry run")


def confirmed(status: int, body: bytes) -> bool:
    try:
        answer = json.loads(body)
    except ValueError:
        return False
    code = answer.get("code") if isinstance(answer, dict) else None
    return status == 200 and code == 0 and not isinstance(code, bool)


def http_post(url: str, timeout: float = 30) -> Post:
    """A POST of the very bytes; the status and body of any answer, and NotSent where there is none."""

    def post(data: bytes) -> tuple[int, bytes]:
        request = urllib.request.Request(url, data, {"Content-Type": "application/json; charset=utf-8"}, method="POST")
        try:
            with urllib.request.urlopen(request, timeout=timeout) as answer:
                return answer.status, answer.read()
        except urllib.error.HTTPError as e:
            return e.code, e.read()
        except OSError as e:
            raise NotSent(f"network: {e}") from e

    return post


def send(payload: Payload, mode: str, post: Post, now: str, live: bool = False, declared: str | None = None) -> dict:
    """The receipt of one confirmed send; raises NotSent otherwise, and then there is no receipt.

    `declared` is the path that the manifest has for the payload.
    """
    gate(payload, mode, live, declared)
    status, body = post(payload.data)
    if not confirmed(status, body):
        raise NotSent(f"not confirmed: HTTP {status}")
    return {
        "schema_version": 1, "flow": payload.flow, "candidate_id": payload.candidate_id, "payload_path": payload.path, "payload_sha256": payload.sha256,
        "http_status": status, "remote_code": 0, "confirmed_at": now,
    }
