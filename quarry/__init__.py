"""A documentation knowledge engine as DataFrame plans.

The names below are the public surface; each is loaded when it is first used.
"""

from importlib import import_module

_WHERE = {
    "crawl": "plans.crawl", "CrawlConfig": "plans.crawl", "table_web": "plans.crawl", "archive": "plans.archive", "extract": "plans.extract", "parse": "plans.parse",
    "extract_variables": "operators.variables", "Tables": "plans.audit", "findings": "plans.audit", "verdict": "plans.audit", "search": "operators.search", "scores": "operators.search",
    "postings": "operators.search", "union_records": "operators.records", "hits": "plans.context", "context_json": "plans.context", "Tools": "plans.context",
    "chunk_table": "operators.chunking", "chunks_of": "operators.chunking", "read_csv": "sources.tables", "write_csv": "sources.tables", "read_chunks": "sources.tables", "write_chunks": "sources.tables",
    "read_files": "sources.files", "local_session": "session", "Paths": "config", "ChunkConfig": "config",
}
__all__ = sorted(_WHERE)


def __getattr__(name: str):
    if name not in _WHERE:
        raise AttributeError(f"module {__name__!r} has no attribute {name!r}")
    return getattr(import_module(f"{__name__}.{_WHERE[name]}"), name)
