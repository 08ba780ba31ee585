"""Loads every operator module, which registers its query."""

from runvault.llm import (alignment, cdc, ce_diff, filter_audit, mixing, pii, quality,  # noqa: F401
                          sentencepiece_bpe, sharding, simhash, toolcalls, topk, warc)
from runvault.llm.registry import ORACLES, QUERIES  # noqa: F401
