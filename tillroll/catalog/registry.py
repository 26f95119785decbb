"""Where the queries and their oracles are registered."""

QUERIES = {}
ORACLES = {}


def query(name, sql=None):
    """Register a function of (spark, sf_dir), with SQL that gives the same rows."""

    def register(function):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register
