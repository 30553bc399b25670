"""Queries and SQL of all operators of this subpackage."""

from __future__ import annotations

from punctualis.llm import chat, collocations, crosstoken, decontaminate, fmindex, hnsw, langid, linededup, minhash, packing, quality, suffixarrays, warc

MODULES = [warc, linededup, packing, decontaminate, langid, chat, minhash, fmindex, quality, suffixarrays, hnsw, crosstoken, collocations]
QUERIES = {name: query for module in MODULES for name, query in module.QUERIES.items()}
SQL = {name: text for module in MODULES for name, text in module.SQL.items()}
