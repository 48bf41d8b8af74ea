"""Training-data operators: one module each, with their queries in ``llm.queries``.

Nothing outside this subpackage imports it, so it can be removed as a whole.
"""
