"""Session settings for the length of a block."""

import contextlib


@contextlib.contextmanager
def settings(spark, **values):
    values = {"spark.sql." + k.replace("__", "."): v for k, v in values.items()}
    old = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
