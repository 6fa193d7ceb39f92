"""All registered corpus queries."""

from __future__ import annotations

from furrow.llm import jaccard, katz, language, lattice, mixing, packing, repair, rules, secrets, templates, topk, toxicity, whitening  # noqa: F401
from furrow.llm.common import ORACLES, QUERIES  # noqa: F401
