"""Where the phases read and write, and their settings; bad settings are refused when made."""

from __future__ import annotations

from dataclasses import dataclass, field
from pathlib import Path

from quarry.operators import chunking


@dataclass(frozen=True)
class Paths:
    """All places follow ``base``, each can be given; graph tables follow the metadata folder."""

    base: Path = Path(".")
    metadata: Path | None = None
    graph: Path | None = None
    raw: Path | None = None
    parsed: Path | None = None
    workspace: Path | None = None
    inventory: Path | None = None
    manifest: Path | None = None
    given: dict[str, Path] = field(default_factory=dict)  # tables that stand elsewhere, by name

    def __post_init__(self) -> None:
        base = Path(self.base)
        meta = Path(self.metadata) if self.metadata else base / "data/metadata"
        fixed = {
            "base": base, "metadata": meta, "graph": Path(self.graph) if self.graph else meta.parent / "graph", "raw": Path(self.raw or base / "data/raw"),
            "parsed": Path(self.parsed or base / "data/parsed"), "workspace": Path(self.workspace or base / "_workspace"),
            "inventory": Path(self.inventory or base / "manifests/site_inventory.csv"), "manifest": Path(self.manifest or base / "manifests/archive_manifest.csv"),
        }
        for name, value in fixed.items():
            object.__setattr__(self, name, value)

    def table(self, name: str) -> Path:
        if name in self.given:
            return Path(self.given[name])
        if name in ("inventory", "manifest"):
            return getattr(self, name)
        if name == "chunks":
            return self.parsed / "chunks.jsonl"
        folder = self.graph if name.endswith(("_edges", "_nodes")) else self.metadata
        return folder / f"{name}.csv"


@dataclass(frozen=True)
class ChunkConfig:
    size: int = chunking.SIZE
    overlap: int = chunking.OVERLAP

    def __post_init__(self) -> None:
        chunking.check(self.size, self.overlap)
