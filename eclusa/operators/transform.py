"""The control row's own SQL statement."""

from __future__ import annotations

import threading
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

from eclusa import journal
from eclusa.errors import TransformError

# The view that statements name, and the word for no statement.
VIEW = "tabela_temp"
NO_QUERY = "na"

# The view only names a plan, and spark.sql resolves it at once. Holding the session's lock
# over both calls lets threads share a session without seeing each other's view; sessions
# don't wait for each other.
_locks: WeakKeyDictionary[SparkSession, threading.Lock] = WeakKeyDictionary()
_locks_lock = threading.Lock()


def skips(query: str | None) -> bool:
    """No statement: nothing at all, or ``na``. Blanks alone are a (broken) statement."""
    return not query or query.strip().lower() == NO_QUERY


def refuse_commands(spark: SparkSession, query: str | None) -> None:
    """Raise for a statement that does more than query, without running any of it."""
    if skips(query):
        return
    try:
        plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(query)
    except Exception as e:
        raise TransformError(f"the control row's SQL failed: {e}") from e
    if _has_command(spark, plan):
        raise TransformError(f"the control row's SQL must be a query here: {query}")


def _has_command(spark: SparkSession, plan) -> bool:
    """Whether a parsed statement, or some part of it, does more than query.

    A common table expression can lead an insert, and one statement can hold several.
    """
    loader = plan.getClass().getClassLoader()
    package = "org.apache.spark.sql.catalyst.plans.logical."
    kinds = [loader.loadClass(package + kind) for kind in ("Command", "ParsedStatement")]
    waiting = [plan]
    while waiting:
        node = waiting.pop()
        if any(kind.isInstance(node) for kind in kinds):
            return True
        # The subqueries of expressions and of WITH are inner children or plans in expressions.
        for more in (node.children(), node.innerChildren(), node.subqueries()):
            waiting += [
                more.apply(i) for i in range(more.size()) if loader.loadClass(package + "LogicalPlan").isInstance(more.apply(i))
            ]
    return False


def own_session(spark: SparkSession) -> SparkSession:
    """A session that starts out with all the given one has; what it adds is its own."""
    return type(spark)(spark.sparkContext, spark._jsparkSession.cloneSession())


def apply_sql(df: DataFrame, query: str | None) -> DataFrame:
    """Result of ``query`` with the frame registered as ``tabela_temp``.

    The statement may use anything else the frame's session knows. It is trusted:
    commands such as DDL run at once. Errors in the data appear when the result is
    written, not here.
    """
    if skips(query):
        return df
    spark = df.sparkSession
    try:
        with _locks_lock:
            own = _locks.setdefault(spark, threading.Lock())
        with own:
            df.createOrReplaceTempView(VIEW)
            return spark.sql(query)
    except Exception as e:
        journal.error("sql failed", query=query, error=str(e))
        raise TransformError(f"the control row's SQL failed: {e}") from e
