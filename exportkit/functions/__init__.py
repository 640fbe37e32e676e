from .arrow import BatchTransform, arrow_batches
from .masking import cast, chain, clamp, derive, drop, full_hash, redact, rename, short_hash
from .schema import align, align_union, audit, coerce_timestamps, differences, drift
from .steps import apply_steps

__all__ = [
    "BatchTransform",
    "align",
    "align_union",
    "apply_steps",
    "arrow_batches",
    "audit",
    "cast",
    "chain",
    "clamp",
    "coerce_timestamps",
    "derive",
    "differences",
    "drift",
    "drop",
    "full_hash",
    "redact",
    "rename",
    "short_hash",
]
