"""Signing of requests (HMAC), for connectors. Plain Python: it runs once per request, never per row."""

from __future__ import annotations

import base64
import hashlib
import hmac
from urllib.parse import quote

#: Names of the algorithms.
ALGORITHMS = {"hmac-sha1": hashlib.sha1, "hmac-sha256": hashlib.sha256, "hmac-sha384": hashlib.sha384, "hmac-sha512": hashlib.sha512}


def hexdigest(secret: str, message: str, algorithm: str = "hmac-sha256") -> str:
    return hmac.new(secret.encode(), message.encode(), ALGORITHMS[algorithm]).hexdigest()


def signature(secret: str, parts: dict[str, str], algorithm: str = "hmac-sha256") -> str:
    """The signature of ``name: value`` lines in the order given, base64 and percent-encoded."""
    text = "\n".join(f"{k}: {v}" for k, v in parts.items())
    return quote(base64.b64encode(hmac.new(secret.encode(), text.encode(), ALGORITHMS[algorithm]).digest()).decode(), safe="")
