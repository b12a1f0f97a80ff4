"""Column-level building blocks (no UDFs: everything stays in codegen)."""

from vaultmart.functions.hashing import as_text, hash_key, hashdiff
from vaultmart.functions.numeric import (
    avg_rounded,
    div_round_half_away,
    pct_change_rounded,
)

__all__ = [
    "as_text", "hash_key", "hashdiff",
    "avg_rounded", "div_round_half_away", "pct_change_rounded",
]
