"""Typed settings shared by the plans. Every value is a parameter."""

from __future__ import annotations

from dataclasses import dataclass, field

# Results depend on these constants.
RRF_K = 60
DEFAULT_SPARSE_WEIGHT = 1.2
DEFAULT_DENSE_WEIGHT = 1.0
BOOST_WEIGHTS = {"publisher": 0.15, "category": 0.10, "subcategory": 0.10, "doc_type": 0.05}
ZSCORE_EPSILON = 1e-8
SPARSE_WINDOW_WORDS = 512
MIN_TOTAL_TOKENS = 4000
SAE_TOP_FEATURES = 165


@dataclass(frozen=True)
class ChunkSettings:
    """How sections become chunks."""

    chunk_size: int = 500
    overlap_ratio: float = 0.0
    similarity_percentile: float = 95.0
    min_distance_floor: float = 0.1
    min_sentences_for_semantic: int = 10
    min_chunk_tokens: int = 50
    enable_semantic: bool = True

    @classmethod
    def for_service(cls) -> "ChunkSettings":
        """Service ingestion works with larger chunks than a bare config."""
        return cls(chunk_size=2048)


@dataclass(frozen=True)
class SearchSettings:
    """Defaults of the online search surface."""

    collections: tuple[str, ...] = ()
    default_collection: str | None = None
    top_k: int = 20
    context_radius: int = 2
    group_by: str = "section"
    sparse_weight: float = DEFAULT_SPARSE_WEIGHT
    dense_weight: float = DEFAULT_DENSE_WEIGHT
    protected: frozenset[str] = field(default_factory=frozenset)

    @classmethod
    def from_list(cls, collections: str, default: str | None = None, **rest) -> "SearchSettings":
        names = tuple(n.strip() for n in collections.split(",") if n.strip())
        return cls(collections=names, default_collection=default or (names[0] if names else None), **rest)


@dataclass(frozen=True)
class CollectionSpec:
    """One side of a dense/sparse collection pair."""

    name: str
    chunk_size: int
    vector_type: str
    model: str = "hashed-terms"
    min_tokens: int = 0


@dataclass(frozen=True)
class CollectionPair:
    """Explicit pairing: nothing is inferred from names."""

    dense: CollectionSpec
    sparse: CollectionSpec
