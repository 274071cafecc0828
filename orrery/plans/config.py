"""Settings from the environment, with defaults and ranges; errors name the variable, never its value."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from urllib.parse import urlsplit

from ..errors import InvalidConfig


class Secret(str):
    """A text that doesn't show itself."""

    def __repr__(self) -> str:
        return "Secret(***)"

    __str__ = __repr__

    def reveal(self) -> str:
        return str.__str__(self) if type(self) is str else "".join(self)


@dataclass(frozen=True)
class Settings:
    root: str
    embedding_base_url: str
    embedding_key: Secret
    embedding_model: str
    dimensions: int
    timeout_s: float
    batch: int


def whole(env: Mapping[str, str], name: str, default: int, low: int, high: int) -> int:
    try:
        found = int(env.get(name, "").strip() or default)
    except ValueError:
        raise InvalidConfig(f"{name} isn't a number") from None
    if not low <= found <= high:
        raise InvalidConfig(f"{name} isn't between {low} and {high}")
    return found


def base_url(env: Mapping[str, str], name: str) -> str:
    """An http(s) address without credentials, query, fragment and final slashes, that isn't the endpoint itself."""
    text = env.get(name, "").strip().rstrip("/")
    if not text:
        return ""
    u = urlsplit(text)
    if u.scheme not in ("http", "https") or not u.hostname or u.username or u.password or u.query or u.fragment or u.path.endswith("/embeddings"):
        raise InvalidConfig(f"{name} isn't a base address")
    return text


def load(env: Mapping[str, str]) -> Settings:
    root = env.get("INDEX_ROOT", "").strip()
    if not root:
        raise InvalidConfig("INDEX_ROOT is missing")
    timeout = env.get("EMBEDDING_TIMEOUT", "").strip().removesuffix("s") or "30"
    try:
        seconds = float(timeout)
    except ValueError:
        raise InvalidConfig("EMBEDDING_TIMEOUT isn't a duration") from None
    if seconds <= 0:
        raise InvalidConfig("EMBEDDING_TIMEOUT isn't positive")
    return Settings(root, base_url(env, "EMBEDDING_BASE_URL"), Secret(env.get("EMBEDDING_KEY", "")), env.get("EMBEDDING_MODEL", "").strip() or "text-embedding-v4", whole(env, "EMBEDDING_DIMENSIONS", 1536, 1, 65_536), seconds, whole(env, "EMBEDDING_BATCH_SIZE", 10, 1, 10))
