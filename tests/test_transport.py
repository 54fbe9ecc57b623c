"""Connection options reach the client typed; secrets come from env vars."""

import sys
import types

from docindex.sources.transport import ClientTransport


def test_client_options(monkeypatch):
    seen = {}

    class FakeClient:
        def __init__(self, **kw):
            seen.update(kw)

    mod = types.ModuleType("elasticsearch")
    mod.Elasticsearch = FakeClient
    monkeypatch.setitem(sys.modules, "elasticsearch", mod)
    monkeypatch.setenv("MY_SECRET", "s3cret")
    ClientTransport({"hosts": "http://a:9200, http://b:9200", "max_retries": "10",
                     "verify_certs": "false", "api_key_env": "MY_SECRET", "request_timeout": "30"})
    assert seen == {"hosts": ["http://a:9200", "http://b:9200"], "max_retries": 10,
                    "verify_certs": False, "api_key": "s3cret", "request_timeout": 30}
