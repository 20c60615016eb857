"""Queries over the dealt operators, with SQL checks where SQL can say them."""

from __future__ import annotations

from commonspulse.llm import (
    bpe,
    chat,
    collocations,
    contamination,
    huffman,
    language,
    lines,
    main_text,
    near_duplicates,
    search,
    substrings,
    toxicity,
    vector_codes,
)

MODULES = (lines, huffman, bpe, language, near_duplicates, chat, search, substrings, contamination, main_text,
           vector_codes, toxicity, collocations)
QUERIES = {name: function for module in MODULES for name, function in module.QUERIES.items()}
ORACLES = {name: sql for module in MODULES for name, sql in module.ORACLES.items()}
