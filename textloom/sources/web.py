"""Search and completion services over HTTP, as providers for the loops of textloom.operators.agents.

They are built on the executors, one for each partition, and hold nothing but their settings. A busy
or failing server (429, 5xx, no connection) is asked again after growing waits; any other refusal is final.
"""

from __future__ import annotations

import importlib
import importlib.util
import json
import re
import urllib.error
import urllib.parse
import urllib.request
from html import unescape

from textloom.operators.agents import Fallback, Memo, retried

#: What a search may be narrowed to.
TOPICS = ("general", "news")
RANGES = ("day", "week", "month", "year")
BUSY = (429, 500, 502, 503, 504)
LONGEST_QUERY = 400

_RESULT = re.compile(r'<a\b[^>]*\bclass="result__a"[^>]*\bhref="([^"]+)"[^>]*>(.*?)</a>', re.S)
_SNIPPET = re.compile(r'\bclass="result__snippet"[^>]*>(.*?)</a>', re.S)


class Refused(ValueError):
    """A service said no for good."""


def fetch(url: str, body: dict | bytes | None = None, *, key: str | None = None, timeout: float = 20.0, times: int = 3, wait: float = 2.0) -> str:
    """The answer as text. A dict is posted as JSON, bytes as they are; without a body it is a GET."""
    headers = {"Authorization": f"Bearer {key}"} if key else {}
    if isinstance(body, dict):
        headers["Content-Type"] = "application/json"
        body = json.dumps(body).encode()

    def once() -> str:
        try:
            with urllib.request.urlopen(urllib.request.Request(url, data=body, headers=headers), timeout=timeout) as answer:
                return answer.read().decode(errors="replace")
        except urllib.error.HTTPError as e:
            if e.code in BUSY:
                raise
            raise Refused(f"{e.code} from {url}") from e

    return retried(once, times=times, wait=wait)


def _plain(html: str) -> str:
    return unescape(re.sub(r"<[^>]+>", "", html)).strip()


def _hits(rows: list[dict]) -> list[dict]:
    """Answers' rows with the fields that every search gives."""
    return [{"title": r.get("title") or "", "url": r.get("url") or "", "content": r.get("content") or "", **({"score": r["score"]} if "score" in r else {})} for r in rows]


class PostedSearch:
    """A search that takes a JSON request."""

    def __init__(self, url: str, key: str | None = None, k: int = 5, topic: str = "general", time_range: str | None = None, depth: str | None = None, answer: bool | None = None, country: str | None = None, **options):
        self.url, self.key, self.options = url, key, options
        self.request = {"max_results": k, "topic": topic if topic in TOPICS else TOPICS[0]} | ({"time_range": time_range} if time_range in RANGES else {})
        self.request |= {name: x for name, x in (("search_depth", depth), ("include_answer", answer), ("country", country)) if x is not None}

    def search(self, query: str) -> list[dict]:
        return _hits(json.loads(fetch(self.url, self.request | {"query": query[:LONGEST_QUERY]}, key=self.key, **self.options)).get("results") or [])


class GetSearch:
    """A search whose request is a query string and whose answer is JSON."""

    def __init__(self, base: str, k: int = 3, language: str = "tr", **options):
        self.base, self.k, self.language, self.options = base.rstrip("/"), k, language, options

    def search(self, query: str) -> list[dict]:
        asked = urllib.parse.urlencode({"q": query, "format": "json", "language": self.language})
        return _hits((json.loads(fetch(f"{self.base}/search?{asked}", **self.options)).get("results") or [])[: self.k])


def results_of(page: str, k: int = 3) -> list[dict]:
    """The first k results of a results page: redirects resolved, advertisements left out."""
    found, out = list(_RESULT.finditer(page)), []
    for at, m in enumerate(found):
        url = unescape(m[1])
        aim = urllib.parse.parse_qs(urllib.parse.urlparse(url).query).get("uddg")
        url = aim[0] if aim else url
        if "duckduckgo.com/y.js" not in url and len(out) < k:
            snippet = _SNIPPET.search(page, m.end(), found[at + 1].start() if at + 1 < len(found) else len(page))
            out.append({"title": _plain(m[2]), "url": url, "content": _plain(snippet[1]) if snippet else ""})
    return out


class PageSearch:
    """A search whose answer is a page of results."""

    def __init__(self, url: str, k: int = 3, **options):
        self.url, self.k, self.options = url, k, options

    def search(self, query: str) -> list[dict]:
        return results_of(fetch(self.url, urllib.parse.urlencode({"q": query}).encode(), **self.options), self.k)


class Completions:
    """A model behind a text-completion service."""

    def __init__(self, base: str, model: str, key: str | None = None, stop: tuple[str, ...] = (), max_tokens: int = 2048, **options):
        base = base.rstrip("/")
        self.url = f"{base}/completions" if base.endswith("/v1") else f"{base}/v1/completions"
        self.model, self.key, self.stop, self.max_tokens, self.options = model, key, list(stop), max_tokens, options

    def complete(self, prompt: str, temperature: float = 0.7) -> str:
        body = {"model": self.model, "prompt": prompt, "stop": self.stop, "max_tokens": self.max_tokens, "temperature": temperature}
        return json.loads(fetch(self.url, body, key=self.key, **self.options))["choices"][0]["text"]


class LibrarySearch:
    """A search by a library that is installed on the executors; both names it has had are tried."""

    def __init__(self, k: int = 3, region: str = "tr-tr", modules: tuple[str, ...] = ("ddgs", "duckduckgo_search")):
        self.k, self.region, self.modules = k, region, modules

    def search(self, query: str) -> list[dict]:
        found = next((m for m in self.modules if importlib.util.find_spec(m)), None)
        if found is None:
            raise Refused(f"none of {self.modules} is installed")
        with importlib.import_module(found).DDGS() as client:
            rows = list(client.text(query, region=self.region, max_results=self.k))
        return [{"title": r.get("title") or "", "url": r.get("href") or "", "content": r.get("body") or ""} for r in rows[: self.k]]


class LocalCompletions:
    """A model in the executor's own process, by a library that is installed there."""

    def __init__(self, path: str, stop: tuple[str, ...] = (), max_tokens: int = 2048, context: int = 4096, module: str = "llama_cpp"):
        if importlib.util.find_spec(module) is None:
            raise Refused(f"{module} is not installed")
        self.model = importlib.import_module(module).Llama(model_path=path, n_ctx=context, verbose=False)
        self.stop, self.max_tokens = list(stop), max_tokens

    def complete(self, prompt: str, temperature: float = 0.7) -> str:
        return self.model(prompt, stop=self.stop, max_tokens=self.max_tokens, temperature=temperature)["choices"][0]["text"]


class Remembered:
    """A search that remembers its last answers. textloom.operators.searches asks such a one for more hits than are wanted, and makes an error an answer."""

    def __init__(self, search, most: int = 256):
        self.inner, self.memo = search, Memo(most)

    def search(self, query: str) -> list[dict]:
        return self.memo.get_or(query.strip(), lambda: self.inner.search(query.strip()))


def chosen_search(key: str | None, primary, fallback):
    """The primary search, remembered, where there is a key for it, else the fallback; both are functions that make one."""
    return Remembered(primary(key)) if key else Fallback(fallback())
