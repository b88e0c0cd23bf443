"""Where queries and their SQL counterparts are registered."""

QUERIES = {}
ORACLES = {}


def query(name, sql=None):
    """Register ``function(spark, folder)`` and, if SQL can say it, the SQL."""
    def register(function):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def table(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")
