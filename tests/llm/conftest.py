import pytest

pytest.importorskip("quillspark.llm.queries")

DOCS = "doc_id long, text string, lang string, kind string, tokens string"
