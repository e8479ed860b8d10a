"""Spark SQL expressions as text, for ``F.expr`` and ``selectExpr``.

Arguments and results are expression texts, so a large expression costs one parse instead of
thousands of calls into the JVM. Everything resolves to native expressions; nothing calls back into
Python.
"""
