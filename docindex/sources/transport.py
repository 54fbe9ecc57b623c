"""Transports: how the data source talks to a search server.

A transport has seven calls: ``get_mapping(index)`` (all indices without one), ``open_pit(index,
keep_alive)``, ``close_pit(pit_id)``, ``search(body)``, ``count(index,
query)``, ``stats(index)`` and ``bulk(lines)``.  The default wraps the
installed search client package; none is bundled here, so without it only
other transports (named by ``module:factory``) can be used.
"""

from __future__ import annotations

import os
from typing import Any


def _client_class():
    for mod in ("elasticsearch", "elasticsearch8", "elasticsearch7", "opensearchpy"):
        try:
            m = __import__(mod)
        except ImportError:
            continue
        return getattr(m, "Elasticsearch", None) or getattr(m, "OpenSearch")
    raise ImportError("no search client package is installed; pass transport=module:factory")


class ClientTransport:
    def __init__(self, options: dict[str, str]):
        kwargs: dict[str, Any] = {}
        for k, v in options.items():
            if k.endswith("_env"):
                kwargs[k[:-4]] = os.environ[v]
            elif k == "hosts":
                kwargs[k] = [h.strip() for h in v.split(",")]
            elif v.isdigit():
                kwargs[k] = int(v)
            elif v.lower() in ("true", "false"):
                kwargs[k] = v.lower() == "true"
            else:
                kwargs[k] = v
        self.es = _client_class()(**kwargs)

    def get_mapping(self, index: str | None) -> dict:
        return dict(self.es.indices.get_mapping(index=index or "_all"))

    def open_pit(self, index: str | None, keep_alive: str) -> str:
        return self.es.open_point_in_time(index=index or "_all", keep_alive=keep_alive)["id"]

    def close_pit(self, pit_id: str) -> None:
        self.es.close_point_in_time(body={"id": pit_id})

    def search(self, body: dict) -> dict:
        return dict(self.es.search(body=body))

    def count(self, index: str | None, query: dict | None) -> int:
        body = {"query": query} if query is not None else {}
        return int(self.es.count(index=index, body=body)["count"])

    def stats(self, index: str | None) -> dict:
        return dict(self.es.indices.stats(index=index, metric="store"))

    def bulk(self, lines: list[str]) -> dict:
        try:
            return dict(self.es.bulk(body="\n".join(lines) + "\n"))
        except Exception as e:  # noqa: BLE001
            if getattr(e, "status_code", None) == 429 or getattr(e, "status", None) == 429:
                return {"status": 429}
            raise


def client_transport(options: dict[str, str]) -> ClientTransport:
    return ClientTransport(options)
