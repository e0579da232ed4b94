"""Search results for agents: each hit with its citation, as rows or as JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators.search import search, tokenized

_HIT = ("record_id", "record_type", "title", "dataset_id", "score", "snippet")
_CITATION = ("source_url", "source_document", "page")


def hits(records: DataFrame, query: str, limit: int = 5, record_types: list[str] | None = None) -> DataFrame:
    """The best records in order, their citation nested."""
    return search(records, query, limit, record_types).select(*_HIT, F.struct(*_CITATION).alias("citation"))


def context_json(records: DataFrame, query: str, limit: int = 5) -> str:
    """{"query": ..., "results": [...]} with NULL pages kept."""
    import json

    lines = hits(records, query, limit).select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"})).collect()
    return json.dumps({"query": query, "results": [json.loads(x[0]) for x in lines]}, indent=2)


class Tools:
    """The five read-only search tools over one set of records, tokenised and cached once."""

    def __init__(self, records: DataFrame, default_limit: int = 5) -> None:
        self.records, self.default_limit = None, default_limit
        self.use(records)

    def use(self, records: DataFrame) -> None:
        """Search these records from now on; what was kept of the last ones is dropped."""
        before, self.records = self.records, tokenized(records).cache()
        if before is not None:
            before.unpersist()

    def _typed(self, kind: str, query: str, limit: int | None) -> str:
        import json

        rows = search(self.records, query, self.default_limit if limit is None else limit, [kind])
        return json.dumps([json.loads(x) for x in rows.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("j")).toPandas()["j"]], indent=2)

    def search_datasets(self, query: str, limit: int | None = None) -> str:
        return self._typed("dataset", query, limit)

    def search_documents(self, query: str, limit: int | None = None) -> str:
        return self._typed("document", query, limit)

    def search_variables(self, query: str, limit: int | None = None) -> str:
        return self._typed("variable", query, limit)

    def search_chunks(self, query: str, limit: int | None = None) -> str:
        return self._typed("chunk", query, limit)

    def get_agent_context(self, query: str, limit: int | None = None) -> str:
        return context_json(self.records, query, self.default_limit if limit is None else limit)
