"""Name -> Spark query and its SQL counterpart."""

from catalog import sql
from catalog.data import data

QUERIES: dict = {}
ORACLES: dict = {}


def query(name: str, body: str | None = None, *needs: str):
    """Register ``build(data) -> DataFrame`` with the SQL that must return the same rows, if there is one."""
    def add(build):
        QUERIES[name] = lambda spark, sf_dir: build(data(spark, sf_dir))
        if body is not None:
            ORACLES[name] = sql.select(body, *needs)
        return build
    return add
