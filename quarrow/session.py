"""The engine: SQL text with parameters in, typed Arrow batches out."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .dialect import DialectError, Rewritten, divided, parameters, rewrite
from .errors import QueryError, SchemaError, SessionError
from .streaming.reader import BATCH_ROWS, BatchReader, Extractor
from .types import arrow_schema

#: Session settings that the result contract needs; all can be set at run time.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.timeType.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": str(BATCH_ROWS),
}
DESCRIBE, EXECUTE = "metadata_discovery", "select_execution"
#: Names of types in messages about values that do not convert.
_NAMES = {"INT": "integer", "BIGINT": "bigint", "SMALLINT": "smallint", "DOUBLE": "double precision", "FLOAT": "real", "BOOLEAN": "boolean", "DATE": "date", "DECIMAL": "numeric", "TIMESTAMP": "timestamp with time zone", "TIMESTAMP_NTZ": "timestamp", "TIME": "time"}


_WHOLE = {"tinyint": 1, "smallint": 2, "int": 3, "bigint": 4}


def _integer_divisions(df: DataFrame, text: str, values: dict[str, object]) -> list[tuple[int, int, str]]:
    """Where ``text`` divides integers by integers, and the type of each quotient, as analysis found them.

    Divisions of what such a division gives come up once that one is a whole one.
    """
    places = _places(df.sparkSession, text, values)
    of = df.sparkSession._jvm.java.lang.Class.forName
    expression, subquery = (of(f"org.apache.spark.sql.catalyst.expressions.{c}") for c in ("Expression", "PlanExpression"))
    found, nodes = set(), [df._jdf.queryExecution().analyzed()]
    while nodes:
        node = nodes.pop()
        inner = [node.children()]
        if not expression.isInstance(node):
            inner.append(node.expressions())
        elif subquery.isInstance(node):
            nodes.append(node.plan())
        nodes += [part.apply(k) for part in inner for k in range(part.size())]
        if node.getClass().getSimpleName() != "Divide" or not node.origin().stopIndex().isDefined():
            continue
        sides = [side.child().dataType().simpleString() for side in (node.left(), node.right()) if side.getClass().getSimpleName() == "Cast"]
        span = node.origin().startIndex().get(), node.origin().stopIndex().get()
        if len(sides) == 2 and set(sides) <= set(_WHOLE):
            found.add((*(places[k] for k in span), max(sides, key=_WHOLE.get)))
    return sorted(found)


def _places(spark: SparkSession, text: str, values: dict[str, object]) -> list[int]:
    """Where each character that Spark parses is in ``text``: it puts literals in place of parameters."""
    places, at = [], 0
    for m in parameters(text):
        held = spark.sql("SELECT :p", args={"p": values[m[1]]})._jdf.queryExecution().analyzed().expressions().apply(0).child().origin()
        size = held.stopIndex().get() - held.startIndex().get() + 1
        places += [*range(at, m.start()), *[m.start()] * (size - 1), m.end() - 1]
        at = m.end()
    return [*places, *range(at, len(text))]


def explained(failure: Exception) -> str:
    """A Spark error as a short message."""
    text = str(failure)
    if m := re.search(r"The value '(.*?)' of the type \"STRING\" cannot be cast to \"(\w+)", text, re.S):
        return f'invalid input syntax for type {_NAMES.get(m[2], m[2].lower())}: "{m[1]}"'
    if "DIVIDE_BY_ZERO" in text:
        return "division by zero"
    for sign, kind in (("TABLE_OR_VIEW_NOT_FOUND", "relation"), ("UNRESOLVED_COLUMN", "column"), ("UNRESOLVED_ROUTINE", "function"), ("FIELD_NOT_FOUND", "column")):
        if sign in text:
            name = re.search(r"`([^`]+(?:`\.`[^`]+)*)`", text)
            return f'{kind} "{name[1].replace("`", "") if name else "?"}" does not exist'
    if "PARSE_SYNTAX_ERROR" in text or "PARSE_EMPTY_STATEMENT" in text:
        near = re.search(r"at or near (.*?)(?:\.|: )", text)
        return f"syntax error at or near {near[1] if near else 'end of input'}"
    return text.splitlines()[0] if text else type(failure).__name__


class Engine:
    """Answers queries over one Spark session, :attr:`spark`.

    Without a session one is made and owned. Of a given one the engine takes a
    clone that sees its views, functions and settings of now; the given session
    keeps its own settings and is left running by :meth:`close`. Closing twice is
    fine; queries on a closed engine fail.
    """

    def __init__(self, spark: SparkSession | None = None, *, master: str | None = None, config: dict[str, str] | None = None, batch_rows: int = BATCH_ROWS):
        self._owned = spark is None
        try:
            if spark is None:
                builder = SparkSession.builder.appName("quarrow")
                builder = builder.master(master) if master else builder
                spark = builder.config(map=SETTINGS | (config or {})).getOrCreate()
            else:
                spark = type(spark)(spark._sc, spark._jsparkSession.cloneSession())
            for key, value in (SETTINGS | (config or {})).items():
                spark.conf.set(key, value)
        except Exception as failure:
            raise SessionError(f"failed to acquire a session: {explained(failure)}") from failure
        self.spark, self.batch_rows, self._closed = spark, batch_rows, False

    # Queries --------------------------------------------------------------------

    def query(self, sql: str, *args: object, batch_rows: int | None = None) -> BatchReader:
        """Open a query; parameters ``$1``, ``$2``, ... take ``args`` in order.

        Errors of text, names, types, arity and constants are raised here; errors
        of data come from the reader.
        """
        df, schema = self._described(sql, args)
        try:
            df._jdf.queryExecution().optimizedPlan()
        except Exception as failure:
            raise QueryError(sql, EXECUTE, explained(failure)) from failure
        return BatchReader(df, schema, sql, batch_rows or self.batch_rows, explained)

    def frame(self, sql: str, *args: object) -> DataFrame:
        """The query as a lazy DataFrame, under the same checks but for result types."""
        return self._analysed(sql, args)

    def schema(self, sql: str, *args: object) -> pa.Schema:
        """The Arrow schema of a query, which is not run; arguments may be left out."""
        rewritten = self._rewritten(sql)
        return self._described(sql, args or (None,) * rewritten.parameters)[1]

    def extractor(self, schema: pa.Schema) -> Extractor:
        """Batches of queries under a schema given by the caller."""
        return Extractor(self.frame, schema)

    def _rewritten(self, sql: str) -> Rewritten:
        if self._closed:
            raise SessionError("failed to acquire a session: engine is closed")
        try:
            return rewrite(sql)
        except DialectError as failure:
            raise QueryError(sql, DESCRIBE, str(failure)) from failure

    def _analysed(self, sql: str, args: tuple) -> DataFrame:
        rewritten = self._rewritten(sql)
        if rewritten.parameters != len(args):
            raise QueryError(sql, EXECUTE, f"expected {rewritten.parameters} arguments, got {len(args)}")
        try:
            plan = self.spark._jsparkSession.sessionState().sqlParser().parsePlan(rewritten.sql)
        except Exception as failure:
            raise QueryError(sql, DESCRIBE, explained(failure)) from failure
        if self._is_command(plan):
            raise QueryError(sql, DESCRIBE, "query returned no columns")
        try:
            text, values = rewritten.sql, {f"p{k}": v for k, v in enumerate(args, 1)}
            df = self.spark.sql(text, args=values)
            while "/" in text and (spans := _integer_divisions(df, text, values)):
                text = divided(text, spans)
                df = self.spark.sql(text, args=values)
        except Exception as failure:
            raise QueryError(sql, DESCRIBE, explained(failure)) from failure
        if not df.columns:
            raise QueryError(sql, DESCRIBE, "query returned no columns")
        return df

    def _is_command(self, plan: object) -> bool:
        """Whether a parsed statement does something instead of returning rows."""
        of = self.spark._jvm.java.lang.Class.forName
        logical = "org.apache.spark.sql.catalyst.plans.logical."
        return any(of(logical + name).isInstance(plan) for name in ("Command", "ParsedStatement"))

    def _described(self, sql: str, args: tuple) -> tuple[DataFrame, pa.Schema]:
        df = self._analysed(sql, args)
        schema, bad = arrow_schema(df.schema)
        if schema is None:
            name, kind = bad[0]
            kind = m[1] if (m := re.search(r"unsupported type ([\w\[\]]+)", kind)) else kind
            problem = SchemaError(bad, f"unsupported type {kind} of column {name}")
            raise QueryError(sql, DESCRIBE, str(problem)) from problem
        return df, schema

    # Lifecycle ------------------------------------------------------------------

    def close(self) -> None:
        if not self._closed:
            self._closed = True
            if self._owned:
                self.spark.stop()

    def __enter__(self) -> Engine:
        return self

    def __exit__(self, *_: object) -> None:
        self.close()
