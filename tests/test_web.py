"""Providers over HTTP against a local server."""

import json
import threading
import urllib.error
import urllib.parse
from http.server import BaseHTTPRequestHandler, HTTPServer

import pytest

from textloom.sources import web

PAGE = """<a rel="n" class="result__a" href="//r.example/l/?uddg=https%3A%2F%2Fa.example%2Fx&amp;z=1"><b>A</b> &amp; co</a><a class="result__snippet" href="#">about <b>a</b></a>
<a class="result__a" href="https://duckduckgo.com/y.js?ad=1">Ad</a><a class="result__a" href="https://b.example/">B</a>"""


@pytest.fixture(scope="module")
def server():
    asked = []

    class Handler(BaseHTTPRequestHandler):
        def _answer(self, body=b""):
            asked.append((self.path, body, self.headers.get("Authorization")))
            path, tries = self.path.split("?")[0], sum(a[0] == self.path for a in asked)
            code = 503 if path == "/busy" and tries < 3 else 404 if path == "/gone" else 200
            rows = [{"title": "t", "url": "u", "content": None, "score": 0.5}] * 4
            out = {"/page": PAGE, "/v1/completions": json.dumps({"choices": [{"text": "said"}]})}.get(path, json.dumps({"results": rows}))
            self.send_response(code)
            self.end_headers()
            self.wfile.write(out.encode())

        def do_GET(self):
            self._answer()

        def do_POST(self):
            self._answer(self.rfile.read(int(self.headers["Content-Length"])))

        def log_message(self, *a):
            pass

    s = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=s.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{s.server_port}", asked
    s.shutdown()


def test_posted_search(server):
    base, asked = server
    assert web.PostedSearch(f"{base}/p", key="k", topic="odd", time_range="week").search("q" * 500)[0] == {"title": "t", "url": "u", "content": "", "score": 0.5}
    body = json.loads(asked[-1][1])
    assert body == {"max_results": 5, "topic": "general", "time_range": "week", "query": "q" * 400} and asked[-1][2] == "Bearer k"
    assert "time_range" not in web.PostedSearch(base, time_range="hour").request


def test_get_and_page_search(server):
    base, asked = server
    assert len(web.GetSearch(f"{base}/", k=2).search("ç ü")) == 2
    assert urllib.parse.parse_qs(asked[-1][0].split("?")[1]) == {"q": ["ç ü"], "format": ["json"], "language": ["tr"]}
    assert web.PageSearch(f"{base}/page").search("x") == [{"title": "A & co", "url": "https://a.example/x", "content": "about a"}, {"title": "B", "url": "https://b.example/", "content": ""}]
    assert web.results_of(PAGE, 1)[0]["title"] == "A & co" and web.results_of("") == []


def test_completions_and_retries(server):
    base, asked = server
    assert web.Completions(base, "m", stop=("s",)).complete("p", temperature=0) == "said" == web.Completions(f"{base}/v1", "m").complete("p")
    assert json.loads(web.fetch(f"{base}/busy", wait=0))["results"]
    before = len(asked)
    with pytest.raises(web.Refused):
        web.fetch(f"{base}/gone", wait=0)
    assert len(asked) == before + 1
    with pytest.raises(urllib.error.URLError):
        web.fetch("http://127.0.0.1:9/", times=2, wait=0)
