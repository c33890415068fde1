"""Cancelling queries from another thread."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


class Token:
    """Cancels the queries that run within its scope; a scope that is entered later refuses."""

    def __init__(self, spark: SparkSession):
        self._spark, self.tag, self.cancelled = spark, f"quadrille-{uuid.uuid4().hex}", False

    def cancel(self) -> None:
        self.cancelled = True
        self._spark.sparkContext.cancelJobsWithTag(self.tag)


class Cancelled(RuntimeError):
    pass


@contextmanager
def cancel_scope(token: Token) -> Iterator[Token]:
    """Jobs of this thread belong to the token until the block ends."""
    if token.cancelled:
        raise Cancelled(token.tag)
    context = token._spark.sparkContext
    context.addJobTag(token.tag)
    try:
        yield token
    except Exception as e:
        if token.cancelled:
            raise Cancelled(token.tag) from e
        raise
    finally:
        context.removeJobTag(token.tag)
