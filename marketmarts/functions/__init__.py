"""Column-expression helpers: every function takes and returns ``Column``.

They stay inside Catalyst (no Python UDFs), so Spark can code-generate
them and push the surrounding filters and projections down to the scan.
"""
