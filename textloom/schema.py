"""Schemas of the records that the operators read and write."""

RECORD = (
    "messages array<struct<role: string, content: string, tool_call: struct<name: string, arguments: struct<query: string, topic: string, time_range: string>>>>, "
    "meta struct<category: string, source: string, needs_search: boolean, difficulty: string, seed_source: string, seed_id: string, approx_tokens: int>"
)
CALL = "struct<name: string, arguments: struct<query: string, topic: string, time_range: string>>"
SEED = "id string, source string, category string, question string, reference string, reasoning_hint string"
HIT = "title string, url string, content string, score double, published_date string"
