"""Training-data operators: ten large-corpus steps over ``documents`` and ``embeddings``.

Nothing outside this subpackage imports it; its queries are collected in
:mod:`driftlake.llm.queries`.
"""
