"""A fake search server transport for tests (no network, no port).

State lives in a folder (``client.path``): ``docs.json`` (hits),
``mapping.json``, and ``log/`` where every request is appended as one JSON
file, so that worker processes and the test can share it.
"""

from __future__ import annotations

import json
import os
import time
import uuid
import zlib

from test_query import ev


class FakeTransport:
    def __init__(self, options):
        self.path = options["path"]
        self.fail_first = int(options.get("fail_first", "0"))
        self.fail_id = options.get("fail_id")

    def _log(self, kind, body):
        d = os.path.join(self.path, "log")
        os.makedirs(d, exist_ok=True)
        name = f"{kind}-{time.time_ns():020d}-{uuid.uuid4().hex}.json"
        with open(os.path.join(d, name), "w") as f:
            json.dump(body, f)

    def _docs(self):
        with open(os.path.join(self.path, "docs.json")) as f:
            return json.load(f)

    def get_mapping(self, index):
        if index is None:  # the mappings of all indices, by name
            with open(os.path.join(self.path, "mappings.json")) as f:
                return {name: {"mappings": m} for name, m in json.load(f).items()}
        with open(os.path.join(self.path, "mapping.json")) as f:
            return {index: {"mappings": json.load(f)}}

    def open_pit(self, index, keep_alive):
        pit = "pit-" + uuid.uuid4().hex
        self._log("open", {"index": index, "keep_alive": keep_alive, "id": pit})
        return pit

    def close_pit(self, pit_id):
        self._log("close", {"id": pit_id})

    def search(self, body):
        self._log("search", body)
        docs = self._docs()
        q = body.get("query")
        out = []
        for pos, d in enumerate(docs):
            s = body.get("slice")
            if s and zlib.crc32(d["_id"].encode()) % s["max"] != s["id"]:
                continue
            if body.get("search_after") is not None and pos <= body["search_after"][0]:
                continue
            if q is not None and not evaluate(q, d):
                continue
            inc = body.get("_source", {}).get("includes")
            src = {k: v for k, v in d["_source"].items() if inc is None or k in inc}
            out.append({"_index": d.get("_index", "idx"), "_id": d["_id"], "_version": 1,
                        "_seq_no": pos, "_primary_term": 1, "_score": None, "_source": src,
                        "sort": [pos]})
            if len(out) >= body["size"]:
                break
        return {"hits": {"hits": out}}

    def count(self, index, query):
        return sum(1 for d in self._docs() if query is None or evaluate(query, d))

    def stats(self, index):
        return {"_all": {"total": {"store": {"total_data_set_size_in_bytes": 1234}}}}

    def bulk(self, lines):
        d = os.path.join(self.path, "log")
        os.makedirs(d, exist_ok=True)
        calls = len([n for n in os.listdir(d) if n.startswith("bulk-")])
        self._log("bulk", lines)
        if calls < self.fail_first:
            return {"status": 429}
        items = []
        errors = False
        for line in lines:
            h = json.loads(line)
            if len(h) == 1 and next(iter(h)) in ("index", "create", "update", "delete"):
                (op, meta), = h.items()
                status = 201
                if self.fail_id is not None and meta.get("_id") == self.fail_id:
                    status, errors = 409, True
                items.append({op: {"_id": meta.get("_id"), "status": status}})
        return {"errors": errors, "items": items}


def evaluate(q, hit):
    (name, p), = q.items()
    if name == "ids":
        return hit["_id"] in p["values"]
    if name == "bool":
        must = p.get("must", []) + p.get("filter", [])
        return all(evaluate(c, hit) for c in must) and not any(evaluate(c, hit) for c in p.get("must_not", []))
    return ev(q, hit["_source"])


def factory(options):
    return FakeTransport(options)
