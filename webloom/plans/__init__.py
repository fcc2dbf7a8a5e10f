"""Registered queries over the driver tables and their SQL oracle."""

from __future__ import annotations


def all_queries():
    from webloom.plans.queries import REGISTRY
    from webloom.session import ensure_checkpoint_dir, ship_package

    def wrap(fn):
        def run(spark, sf_dir):
            ensure_checkpoint_dir(spark)
            ship_package(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        return run

    return {k: wrap(v) for k, v in REGISTRY.items()}


def all_oracle_sql():
    from webloom.plans.oracle import ORACLE
    from webloom.plans.queries import REGISTRY
    return {k: v for k, v in ORACLE.items() if k in REGISTRY}
