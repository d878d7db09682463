"""Paged JSON APIs as a Python data source: ``spark.read.format("paged_api")``."""

from __future__ import annotations

import importlib
import json
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader


def walk(payload: object, path: str) -> list:
    """The list at a dotted path; anything else is an error."""
    for part in filter(None, path.split(".")):
        if not isinstance(payload, dict) or part not in payload:
            raise ValueError(f"no {part!r} in the response")
        payload = payload[part]
    if not isinstance(payload, list):
        raise ValueError("records are not a list")
    return payload


def pages(fetch: Callable[[dict], tuple[int, dict]], options: dict) -> Iterator[dict]:
    """Records of all pages. Paging: none, page, offset or cursor; an item that is no object becomes {"value": item}."""
    mode, size = options.get("paging", "none"), int(options.get("page_size", 100))
    params: dict = {"updated_since": options["since"]} if options.get("since") else {}
    page, offset = 1, 0
    if mode != "none":
        params["page_size" if mode != "offset" else "limit"] = size
    while True:
        if mode == "page":
            params["page"] = page
        if mode == "offset":
            params["offset"] = offset
        status, payload = fetch(dict(params))
        if status >= 400 or not isinstance(payload, dict):
            raise OSError(f"request failed with status {status}")
        records = walk(payload, options.get("records_path", "data"))
        yield from (r if isinstance(r, dict) else {"value": r} for r in records)
        cursor = payload.get(options.get("cursor_field", "next_cursor"))
        if mode == "none" or mode == "cursor" and not cursor or mode in ("page", "offset") and len(records) < size:
            return
        page, offset = page + 1, offset + size
        params["cursor"] = cursor


def http(options: dict) -> Callable[[dict], tuple[int, dict]]:
    """A fetch over HTTP: options url, method (GET with parameters in the address, POST with them as a JSON body), token (sent as bearer), timeout."""
    url, method = options["url"], options.get("method", "GET").upper()

    def fetch(params: dict) -> tuple[int, dict]:
        given = {k: v for k, v in params.items() if v is not None}
        address = url + ("&" if "?" in url else "?") + urllib.parse.urlencode(given) if method == "GET" and given else url
        request = urllib.request.Request(address, method=method, data=json.dumps(given).encode() if method == "POST" else None, headers={"Accept": "application/json", "Content-Type": "application/json"})
        if options.get("token"):
            request.add_header("Authorization", f"Bearer {options['token']}")
        try:
            with urllib.request.urlopen(request, timeout=float(options.get("timeout", 60))) as answer:
                return answer.status, json.load(answer)
        except urllib.error.HTTPError as e:
            return e.code, {}

    return fetch


class PagedApiReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.options = options

    def read(self, partition) -> Iterator[tuple]:
        if "fetch" in self.options:
            module, _, name = self.options["fetch"].partition(":")
            fetch = getattr(importlib.import_module(module), name)
        else:
            fetch = http(self.options)
        for record in pages(fetch, self.options):
            yield (json.dumps(record, sort_keys=True),)


class PagedApi(DataSource):
    """Options: url, method, token, or fetch (``module:function`` taking parameters, giving status and payload); paging, page_size, records_path, since."""

    @classmethod
    def name(cls) -> str:
        return "paged_api"

    def schema(self) -> str:
        return "record string"

    def reader(self, schema) -> PagedApiReader:
        return PagedApiReader(dict(self.options))
