"""One registered query per operator, with equivalent SQL where SQL can say it."""

from __future__ import annotations

import importlib

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

_MODULES = ("q_quality", "q_chat", "q_mixing", "q_simhash", "q_pages", "q_lines", "q_warc", "q_decontaminate", "q_perplexity", "q_suffixes", "q_manifest", "q_whitening", "q_exact", "q_pipeline")


def load() -> None:
    for name in _MODULES:
        module = importlib.import_module(f"parcelweave.llm.{name}")
        QUERIES[module.NAME] = module.query
        if getattr(module, "SQL", None):
            ORACLES[module.NAME] = module.SQL
