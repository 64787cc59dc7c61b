"""Whether an exception speaks about the data and the rules, or about the cluster."""

from __future__ import annotations

from collections.abc import Iterator

from py4j.protocol import Py4JError, Py4JJavaError
from pyspark.errors import PySparkException, PythonException

# Classes of SQLSTATE that a value, or a condition written by the user, causes: cardinality,
# data exception, external routine, syntax or access rule, and errors that the user raises.
DATA_CLASSES = ("21", "22", "38", "42", "P0")
# the same for Java exceptions that have no SQLSTATE
DATA_EXCEPTIONS = (
    "java.lang.ArithmeticException",
    "java.lang.NumberFormatException",
    "java.time.DateTimeException",
    "java.util.regex.PatternSyntaxException",
)


def _causes(error: BaseException) -> Iterator[object]:
    """The Java exceptions behind an exception, outermost first."""
    found = error.java_exception if isinstance(error, Py4JJavaError) else getattr(error, "_origin", None)
    while found is not None:
        yield found
        found = found.getCause()


def _sql_state(found: object) -> str | None:
    try:
        return found.getSqlState()
    except Py4JError:  # an exception that has none
        return None


def is_data_error(error: BaseException) -> bool:
    """True if the data or a condition raised; a lost executor, an unreadable file or a lack of
    memory says nothing about either, so this is False for whatever is not known."""
    if isinstance(error, PythonException):  # from a function that a condition calls
        return True
    if isinstance(error, PySparkException) and (error.getSqlState() or "").startswith(DATA_CLASSES):
        return True
    for found in _causes(error):
        state = _sql_state(found)
        if state is not None:
            return state.startswith(DATA_CLASSES)
        kind = found.getClass()
        while kind is not None:
            if kind.getName() in DATA_EXCEPTIONS:
                return True
            kind = kind.getSuperclass()
    return False
