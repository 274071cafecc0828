"""Documents by HTTP(S): a data source of Spark's with partitions of addresses, bounded bodies and redirects that the address policy checks."""

from __future__ import annotations

import http.client
import json
import re
import socket
import threading
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from urllib.parse import urljoin, urlsplit

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..errors import InvalidRequest, SourceUnavailable

SCHEMA = "uri string, final_uri string, mime_type string, content binary"
#: Defaults: addresses of a partition, bytes of a body, seconds of a request from connecting to its last byte, redirects followed.
EACH, BODY_BYTES, SECONDS, REDIRECTS = 16, 64 << 20, 30.0, 5


def allowed(uri: str) -> bool:
    """The policy for source addresses, for those that are fetched: http or https with a host; no credentials, query, fragment or white space."""
    try:
        u = urlsplit(uri)
        return u.scheme in ("http", "https") and bool(u.hostname) and u.port != 0 and "@" not in u.netloc and not re.search(r"[?#\s\x00-\x1f\x7f]", uri)
    except ValueError:
        return False


def exchange(method: str, url: str, body: bytes | None, headers: dict[str, str], seconds: float, most: int) -> tuple[int, http.client.HTTPMessage, bytes]:
    """Status, headers and at most `most` + 1 bytes of one answer of this very host, all within `seconds`; OSError, HTTPException or ValueError otherwise.

    Nothing is followed, and no proxy is used.
    """
    u = urlsplit(url)
    connection = (http.client.HTTPSConnection if u.scheme == "https" else http.client.HTTPConnection)(u.hostname or "", u.port, timeout=seconds)
    late = threading.Event()
    held: list[socket.socket] = []  # the connection lets its socket go once the answer owns it

    def end() -> None:
        late.set()
        for s in held:
            try:
                s.shutdown(socket.SHUT_RDWR)
            except OSError:
                pass

    timer = threading.Timer(seconds, end)
    timer.daemon = True
    timer.start()
    try:
        connection.connect()
        held.append(connection.sock)
        connection.request(method, u.path or "/", body, headers)
        answer = connection.getresponse()
        content = answer.read(most + 1)
        if late.is_set():
            raise TimeoutError
        return answer.status, answer.headers, content
    finally:
        timer.cancel()
        connection.close()


def fetched(uri: str, most: int = BODY_BYTES, seconds: float = SECONDS, redirects: int = REDIRECTS) -> tuple[str, str, str, bytes]:
    """uri, the address that answered, its media type and body. Every address on the way keeps the policy, and https is never left for http."""
    at = uri
    for _ in range(redirects + 1):
        if not allowed(at) or (at != uri and uri.startswith("https:") and not at.startswith("https:")):
            raise InvalidRequest("an address breaks the policy for sources")
        try:
            status, headers, content = exchange("GET", at, None, {"Accept-Encoding": "identity"}, seconds, most)
        except (OSError, http.client.HTTPException, ValueError):
            raise SourceUnavailable("a source couldn't be read") from None
        if status in (301, 302, 303, 307, 308) and headers.get("Location"):
            at = urljoin(at, headers["Location"])
            continue
        if status != 200:
            raise SourceUnavailable(f"a source answered with status {status}")
        if len(content) > most:
            raise InvalidRequest(f"a source has more than {most} bytes")
        return uri, at, headers.get_content_type(), content
    raise SourceUnavailable("a source redirects too often")


@dataclass
class Addresses(InputPartition):
    uris: list[str]


class WebReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.uris = json.loads(options.get("addresses", "[]"))
        self.each, self.most = int(options.get("each", EACH)), int(options.get("bodybytes", BODY_BYTES))
        self.seconds, self.redirects = float(options.get("seconds", SECONDS)), int(options.get("redirects", REDIRECTS))
        if self.each < 1 or self.most < 0 or self.seconds <= 0 or self.redirects < 0 or not all(isinstance(u, str) and allowed(u) for u in self.uris):
            raise InvalidRequest("an address breaks the policy for sources, or a limit is out of range")

    def partitions(self) -> Sequence[InputPartition]:
        return [Addresses(self.uris[i : i + self.each]) for i in range(0, len(self.uris), self.each)] or [Addresses([])]

    def read(self, partition: Addresses) -> Iterator[tuple]:
        for uri in partition.uris:
            yield fetched(uri, self.most, self.seconds, self.redirects)


class WebDocuments(DataSource):
    """`spark.read.format("web_documents")`; options: addresses (a JSON array), each, bodyBytes, seconds, redirects."""

    @classmethod
    def name(cls) -> str:
        return "web_documents"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return WebReader({k.lower(): v for k, v in self.options.items()})
