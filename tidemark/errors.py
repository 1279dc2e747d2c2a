"""Errors the library raises, and the ones a Spark job may raise."""

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

# a job that fails on the JVM side may arrive under either type
JOB_ERRORS = (PySparkException, Py4JJavaError)


def first_line(error: Exception) -> str:
    """First line of the innermost message: a failed job wraps the reason in several layers."""
    text, layer = str(error), getattr(error, "java_exception", None)
    while layer is not None:
        text, layer = layer.getMessage() or text, layer.getCause()
    return (text.strip() or type(error).__name__).splitlines()[0]


class TidemarkError(Exception):
    """Base of all library errors."""


class DefinitionError(TidemarkError):
    """A metric definition or a specification is not valid."""


class SourceError(TidemarkError):
    """A source cannot be read."""


class MetricError(TidemarkError):
    """A metric cannot be bound or computed."""
