"""The headline queries as single-threaded loops over rows in plain Python, for comparison with bench.py: one JSON line.

BENCH_SF_DIR chooses the data. Reading the Parquet file into Python rows counts, as it does there; each loop is run twice and the
faster run counts. Results are not compared here: the queries have their SQL for that.
"""

import hashlib
import json
import os
import re
import time
from html import unescape

import pyarrow.parquet as pq

DATA = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
NUMBER = re.compile(r"-?[0-9]+(?:[.,][0-9]+)?(?:/[0-9]+)?")
WORDS = re.compile(r"\W+")


def rows(table, *columns):
    return zip(*(pq.read_table(f"{DATA}/{table}.parquet", columns=list(columns)).column(c).to_pylist() for c in columns))


def key(text):
    return hashlib.md5(WORDS.sub("", text.lower()).encode()).hexdigest()


def merge_documents():
    seen, out = set(), []
    for i, text in rows("documents", "doc_id", "text"):
        k = key(text)
        if len(text) >= 200 and k not in seen and len(text) // 3 <= 2048:
            seen.add(k)
            out.append((i, k, len(text) // 3))
    return out


def merge_split():
    ids = sorted((hashlib.md5(f"42:{i}".encode()).hexdigest(), i) for (i,) in rows("documents", "doc_id"))
    n = max(1, int(len(ids) * 0.02)) if len(ids) > 50 else 0
    return [(i, "val" if k < n else "train") for k, (_, i) in enumerate(ids)]


def talks():
    out = {}
    for c, turn, role, text in rows("conversations", "conv_id", "turn", "role", "text"):
        out.setdefault(c, []).append((turn, role, text))
    return {c: sorted(x) for c, x in out.items()}


def pair_extract():
    out = []
    for c, turns in talks().items():
        for a, b in zip(turns, turns[1:]):
            if a[1] == "user" and b[1] == "assistant":
                out.append((c, a[2], b[2]))
                break
    return out


def render_chat():
    return [(c, "".join(f"<|im_start|>{r}\n{t}<|im_end|>\n" for _, r, t in turns)) for c, turns in talks().items()]


def clean(text, limit):
    s = re.sub(r"\s+", " ", re.sub(r"<[^>]+>", " ", text).translate({60: "‹", 62: "›"})).strip()
    if len(s) <= limit:
        return s
    cut = s[:limit]
    at = cut.rfind(". ")
    return cut[: at + 1] if at >= limit // 2 else cut + "…"


def clean_text_500():
    return [(i, clean(t, 500)) for i, t in rows("documents", "doc_id", "text")]


def alike(x):
    over, _, under = x.replace(",", ".").partition("/")
    try:
        value = float(over) / float(under or 1)
    except (ValueError, ZeroDivisionError):
        return x
    return str(int(value)) if value.is_integer() and abs(value) < 1e15 else f"{value:.4f}".rstrip("0").rstrip(".")


def number_normalise():
    return [(i, x, alike(x)) for i, t in rows("documents", "doc_id", "text") for x in NUMBER.findall(t.replace(" ", ""))]


def answer_consistency():
    out = []
    for c, q, a in pair_extract():
        missing = {alike(x) for x in NUMBER.findall(q)} - {alike(x) for x in NUMBER.findall(a)}
        out.append((c, not missing, len(missing)))
    return out


def tool_call_parse():
    out = []
    for i, props in rows("events", "event_id", "props"):
        k = json.loads(props)["k"]
        arguments = (f'{{"query": "{k}"}}', f'"n{k}"', '"{\\"query\\": \\"%s\\"}"' % k, f'{{"query": "{k}"}}')[i % 4]
        text = f'<tool_call>{{"name": "old"}}</tool_call> then <tool_call>\n{{"name": "s", "arguments": {arguments}{"}}" if i % 4 == 3 else "}"}\n</tool_call>'
        found = re.findall(r"(?s)<tool_call>\s*(\{.*?\})\s*</tool_call>", text)
        try:
            own = json.loads(found[-1])["arguments"]
            if isinstance(own, str):
                try:
                    own = json.loads(own)["query"]
                except ValueError:
                    pass
            out.append((i, own["query"] if isinstance(own, dict) else own))
        except ValueError:
            out.append((i, None))
    return out


def link_extract():
    anchor = re.compile(r'(?is)<a\b[^>]*\bhref="([^"]*)"[^>]*>(.*?)</a>')
    return [(i, k, unescape(h), re.sub(r"<[^>]+>", "", t)) for i, html in rows("pages", "page_id", "html") for k, (h, t) in enumerate(anchor.findall(html or ""))]


def balanced_sample():
    by = {}
    for i, lang in rows("documents", "doc_id", "lang"):
        by.setdefault(lang, []).append((hashlib.md5(str(i).encode()).hexdigest(), i))
    return [(i, lang, k) for lang, own in by.items() for k, (_, i) in enumerate(sorted(own)[:40], 1)]


def op13_middle():
    out = []
    for i, text in rows("documents", "doc_id", "text"):
        units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text or "")
        h = [int(hashlib.sha256(f"1:{i}".encode()).hexdigest()[k : k + 8], 16) for k in range(0, 32, 8)]
        a, b = sorted(x % (len(units) + 1) for x in h[:2])
        made = f"<P>{''.join(units[:a])}<S>{''.join(units[b:])}<M>{''.join(units[a:b])}"
        out.append((i, len(units), hashlib.sha256(made.encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    return out


LOOPS = (merge_documents, merge_split, pair_extract, render_chat, clean_text_500, number_normalise, answer_consistency, tool_call_parse, link_extract, balanced_sample, op13_middle)

if __name__ == "__main__":
    took = {}
    for loop in LOOPS:
        times = []
        for _ in range(2):
            began = time.perf_counter()
            loop()
            times.append(time.perf_counter() - began)
        took[loop.__name__] = round(min(times), 3)
    print(json.dumps({"metric": "total_seconds", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": DATA.rsplit("sf", 1)[-1]}))
