"""Where queries and their SQL are collected."""

import functools

from fleetbook.session import tune

from . import views_sql

QUERIES = {}
SQL = {}


def query(name, sql=None):
    """Register a function (spark, sf_dir) -> DataFrame with its SQL. The SQL may name
    the views of ``views_sql``; those it uses are put in front of it."""
    def add(fn):
        @functools.wraps(fn)
        def run(spark, sf_dir):
            return fn(tune(spark), str(sf_dir).rstrip("/"))

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = views_sql.with_views(sql)
        return fn
    return add
