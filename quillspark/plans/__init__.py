"""Catalogues of queries: each module has QUERIES and ORACLES."""

from quillspark.plans import decisions, documents, gates, layout, lines, measures, problems, routing, sequences, tables, texts

CATALOGUES = [problems, tables, sequences, measures, texts, routing, documents, gates, decisions, lines, layout]
