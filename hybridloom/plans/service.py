"""The tool surface as plain dictionaries in and out; a transport can be put around it."""

from __future__ import annotations

import json
from collections.abc import Callable

from hybridloom.plans.search import SearchEngine

# Protocol names and the tool argument defaults.
PROTOCOL = "2024-11-05"
TOOLS = {
    "query": {"query": "string", "mode": "string", "top_k": "integer", "group_by": "string", "collection": "string", "collections": "string",
              "filter_by": "string", "sparse_weight": "number", "dense_weight": "number"},
    "get_context": {"source_file": "string", "section_title": "string", "query": "string", "radius": "integer", "collection": "string"},
    "list_collections": {},
    "pick_random_chunk": {"collection": "string", "min_tokens": "integer", "min_total_tokens": "integer", "source_file": "string", "seed": "integer"},
    "list_books": {"collection": "string"},
    "list_sources": {"collection": "string", "offset": "integer", "limit": "integer", "category": "string", "search": "string"},
}
NOTHING_FOUND = "No relevant documents found in the knowledge base."


def parse_filter(value: str | dict | None) -> dict | None:
    """A JSON object of equalities; anything unreadable means no filter."""
    if isinstance(value, dict):
        return value
    try:
        parsed = json.loads(value) if value else None
    except json.JSONDecodeError:
        return None
    return parsed if isinstance(parsed, dict) else None


def first_passage(query: str, prompt_context: str) -> str:
    """Offline answer: the best passage of the prompt."""
    return next((line for line in prompt_context.splitlines() if line.startswith("[score:")), "")


class Service:
    def __init__(self, engine: SearchEngine, answer: Callable[[str, str], str] = first_passage):
        self.engine, self.answer = engine, answer

    def query(self, query: str = "", mode: str = "search", top_k: int = 20, group_by: str = "section", collection: str | None = None,
              collections: str | None = None, filter_by: str | None = None, sparse_weight: float | None = None, dense_weight: float | None = None) -> dict:
        options = {"top_k": top_k, "group_by": group_by, "filter_by": parse_filter(filter_by), "sparse_weight": sparse_weight, "dense_weight": dense_weight}
        listed = [c.strip() for c in (collections or "").split(",") if c.strip()]
        if listed:
            found = self.engine.search_collections(query, collections=listed, **options)
        elif collection or len(self.engine.settings.collections) <= 1:
            found = self.engine.search(query, collection=collection, **options)
        else:
            found = self.engine.search_collections(query, **options)
        if mode != "answer":
            return {**found, "mode": "search"}
        if not found["groups"]:
            return {"query": query, "mode": "answer", "answer": NOTHING_FOUND, "total_chunks": 0}
        try:
            said = self.answer(query, found["prompt_context"])
        except Exception as problem:  # a failing model is an answer, not a crash
            said = f"[error: {problem}]"
        groups = [{k: g[k] for k in ("group_label", "title", "chunk_count")} for g in found["groups"]]
        return {"query": query, "mode": "answer", "answer": said, "total_chunks": found["total_chunks"], "groups": groups, "sources": found["sources"]}

    def get_context(self, source_file: str = "", radius: int = 2, **rest) -> dict:
        return self.engine.get_context(source_file, radius=radius, **rest)

    def list_collections(self) -> dict:
        return {"collections": self.engine.store.info()}

    def pick_random_chunk(self, **rest) -> dict:
        return self.engine.pick_random_chunk(**rest)

    def list_books(self, collection: str | None = None) -> dict:
        return {"books": self.engine.list_books(collection)}

    def list_sources(self, **rest) -> dict:
        return self.engine.list_sources(**rest)

    def call(self, tool: str, arguments: dict | None) -> dict:
        if tool not in TOOLS:
            raise KeyError(tool)
        known = {k: v for k, v in (arguments or {}).items() if k in TOOLS[tool]}
        return getattr(self, tool)(**known)

    def handle(self, request: dict) -> dict:
        """A JSON-RPC request, or the older ``{method, arguments}`` form."""
        if "jsonrpc" not in request:
            try:
                return {"result": self.call(request.get("method", ""), request.get("arguments"))}
            except KeyError:
                return {"error": f"Unknown method: {request.get('method')}"}
        method, params = request.get("method"), request.get("params") or {}
        reply = {"jsonrpc": "2.0", "id": request.get("id")}
        if method == "initialize":
            return {**reply, "result": {"protocolVersion": PROTOCOL, "capabilities": {"tools": {}}, "serverInfo": {"name": "hybridloom", "version": "1"}}}
        if method == "tools/list":
            tools = [{"name": n, "inputSchema": {"type": "object", "properties": {a: {"type": t} for a, t in args.items()}}} for n, args in TOOLS.items()]
            return {**reply, "result": {"tools": tools}}
        if method != "tools/call":
            return {**reply, "error": {"code": -32601, "message": f"Method not found: {method}"}}
        try:
            result = self.call(params.get("name", ""), params.get("arguments"))
        except KeyError:
            return {**reply, "error": {"code": -32602, "message": f"Unknown tool: {params.get('name')}"}}
        except Exception as problem:
            return {**reply, "error": {"code": -32603, "message": str(problem)[:500]}}
        return {**reply, "result": {"content": [{"type": "text", "text": json.dumps(result, default=str)}]}}
