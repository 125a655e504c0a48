"""Registry of the queries and of the SQL that checks each of them."""

QUERIES = {}
CHECKS = {}


def query(name, sql):
    """Register ``fn(spark, sf_dir)`` under ``name`` with its check SQL."""
    def register(fn):
        QUERIES[name] = fn
        CHECKS[name] = " ".join(sql.split())
        return fn

    return register
