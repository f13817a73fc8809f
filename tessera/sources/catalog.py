"""Tables by name, and read-only SQL over exactly the tables a contract names."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.semantic import SemanticModel, SemanticQuery, run
from tessera.session import move, remove

# Fixed value: the folder in which Spark keeps the rows whose partition column is null.
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"

#: A bucket of more rows than this many times the average, and than ``SMALL_BUCKET``, is hot.
HOT_BUCKET, SMALL_BUCKET = 4, 100_000


def scan(spark: SparkSession, path: str, schema: str | T.StructType | None = None) -> DataFrame:
    """A parquet table; with a schema given, no footer is read to find it."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path)


def conform(df: DataFrame, schema: str) -> DataFrame:
    """The columns of a declared table, in its order and cast to its types."""
    declared = T.StructType.fromDDL(schema)
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in declared.fields])


def save_model(df: DataFrame, path: str, partition_by: Iterable[str] = ()) -> DataFrame:
    """Materialise a model as a table, replacing an older one, and read it back.

    The new table is written beside the old one, which is moved out of the way only once it is whole: a
    failed write leaves the old table, and a model may be made from what it replaces.
    """
    spark, fresh = df.sparkSession, f"{path}.new-{uuid.uuid4().hex}"
    try:
        df.write.partitionBy(*partition_by).parquet(fresh)
    except Exception:
        remove(spark, fresh)
        raise
    old = f"{path}.old-{uuid.uuid4().hex}"
    if move(spark, path, old):
        move(spark, fresh, path)
        remove(spark, old)
    else:
        move(spark, fresh, path)
    return spark.read.schema(df.schema).parquet(path)


def refresh_model(df: DataFrame, path: str, partition: str, values: Iterable) -> DataFrame:
    """Replace the partitions of a stored model that hold these values, and no others; read the model back.

    ``df`` is read once, and only its rows of these partitions are used. They are staged before they take their place, so
    that a failed write leaves the table as it was. A partition that has no rows any more goes. ``values`` are
    the changed periods or keys of one refresh, not the data.
    """
    spark, values = df.sparkSession, list(values)
    if not values:
        return spark.read.schema(df.schema).parquet(path)
    kind = df.schema[partition].dataType.simpleString()
    changed = df.where(F.col(partition).isin([F.lit(v).cast(kind) for v in values if v is not None]) | (F.col(partition).isNull() if None in values else F.lit(False)))
    seen = Observation()
    rows = F.collect_set(F.coalesce(F.col(partition).cast("string"), F.lit(_NO_VALUE)))
    changed = changed.observe(seen, rows.alias("held"))
    changed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)
    held = set(seen.get["held"])
    text = [_NO_VALUE if v is None else spark.range(1).select(F.lit(v).cast(kind).cast("string")).first()[0] for v in values]
    for value in text:
        if value not in held:
            folder = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(value)
            remove(spark, f"{path}/{partition}={folder}")
    return spark.read.schema(df.schema).parquet(path)


def save_colocated(tables: Mapping[str, tuple[DataFrame, Sequence[str]]], buckets: int, folder: str) -> dict[str, DataFrame]:
    """Store tables that are joined on their keys so that the joins, and groupings by the key, need no shuffle.

    ``tables``: catalogue name to (rows, key columns); keys have the same types in the same order. Each table is cut into
    ``buckets`` by its key and has one file for each. A bucket is read by one task, so where any table has a bucket of more than
    ``HOT_BUCKET`` times the average, all are stored uncut: their joins shuffle, and Spark splits the hot key. So it is with
    keys that are often null. Names must be new in the catalogue; a table whose write fails leaves none behind.
    """
    kinds = {name: [df.schema[k].dataType for k in keys] for name, (df, keys) in tables.items()}
    if not kinds or any(not k or k != next(iter(kinds.values())) for k in kinds.values()):
        raise ValueError(f"tables stored together need keys of the same types: {kinds}")
    spark = next(iter(tables.values()))[0].sparkSession
    for name in tables:
        if spark.catalog.tableExists(name):
            raise ValueError(f"the catalogue has a table {name!r}")
    cut = not any(_hot(df, keys, buckets) for df, keys in tables.values())
    stored = {}
    try:
        for name, (df, keys) in tables.items():
            stored[name] = f"{folder}/{name}"
            # Dealt by the hash that buckets use: one task writes a bucket, and so one file.
            rows = df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys) if cut else df.write
            rows.format("parquet").option("path", stored[name]).saveAsTable(name)
    except Exception:
        for name, path in stored.items():
            spark.sql(f"DROP TABLE IF EXISTS `{name}`")
            remove(spark, path)
        raise
    return {name: spark.table(name) for name in tables}


def _hot(df: DataFrame, keys: Sequence[str], buckets: int) -> bool:
    """Whether one bucket is far larger than the average; small tables are as uneven as they like."""
    sizes = df.groupBy(F.pmod(F.hash(*keys), F.lit(buckets)).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    largest, total = sizes.agg(F.max("n"), F.sum("n")).first()
    return bool(total) and largest > max(HOT_BUCKET * total / buckets, SMALL_BUCKET)


@dataclass
class Catalog:
    """Semantic models by name; registering a known name again changes nothing."""

    models: dict[str, SemanticModel] = field(default_factory=dict)

    def register(self, name: str, frame: DataFrame, **options) -> SemanticModel:
        if name not in self.models:
            self.models[name] = SemanticModel.from_frame(name, frame, **options)
        return self.models[name]

    def ingest(self, frames: Mapping[str, DataFrame], include: Iterable[str] | None = None) -> list[str]:
        """Register the chosen tables; return all names known afterwards."""
        for name in include if include is not None else frames:
            self.register(name, frames[name])
        return sorted(self.models)

    def model(self, name: str) -> SemanticModel:
        if name not in self.models:
            raise ValueError(f"unknown model {name!r}; models: {', '.join(sorted(self.models)) or 'none'}")
        return self.models[name]

    def query(self, request: Mapping) -> DataFrame:
        """Answer a request that names its ``source_model``."""
        rest = {k: v for k, v in request.items() if k != "source_model"}
        return run(self.model(request["source_model"]), SemanticQuery.of(**rest))


# The parser's nodes that a read-only query is made of, and the groups of built-in functions that
# compute from their arguments alone. The group of miscellaneous functions, which holds the reflective ones, is not among them.
_NODES = frozenset(
    "Project Filter Aggregate Join SubqueryAlias UnresolvedSubqueryColumnAliases Sort GlobalLimit LocalLimit Offset "
    "Distinct Union Intersect Except UnresolvedWith UnresolvedHaving UnresolvedInlineTable OneRowRelation "
    "UnresolvedRelation Generate WithWindowDefinition Pivot Unpivot LateralJoin Sample LocalRelation".split()
)
_GROUPS = frozenset(
    f"{name}_funcs"
    for name in "agg array bitwise collection conditional conversion datetime generator hash json lambda map math "
    "predicate string struct window".split()
)
#: The parser's expressions that stand for columns, values, operators, subqueries, windows and lambdas. What is named only
#: later, such as IDENTIFIER(...) or a parameter, is not among them.
_EXPRESSIONS = frozenset(
    "UnresolvedAttribute AttributeReference UnresolvedStar UnresolvedStarExceptOrReplace UnresolvedAlias UnresolvedOrdinal UnresolvedExtractValue "
    "UnresolvedFunction UnresolvedGenerator UnresolvedSubqueryColumnAliases Alias MultiAlias Literal Cast Collate "
    "And Or Not EqualTo EqualNullSafe LessThan LessThanOrEqual GreaterThan GreaterThanOrEqual In InSubquery IsNull IsNotNull "
    "IsUnknown IsNotUnknown Like ILike RLike LikeAll NotLikeAll LikeAny NotLikeAny ILikeAll NotILikeAll ILikeAny NotILikeAny "
    "Between Add Subtract Multiply Divide IntegralDivide Remainder UnaryMinus UnaryPositive "
    "BitwiseAnd BitwiseOr BitwiseXor BitwiseNot ShiftLeft ShiftRight ShiftRightUnsigned Concat CaseWhen If Coalesce "
    "CreateStruct CreateNamedStruct NamedExpression Substring Overlay StringLocate StringTrim StringTrimLeft StringTrimRight StringTrimBoth "
    "TimestampAdd TimestampDiff Extract CurrentDate CurrentTimestamp First Last AnyValue PercentileCont PercentileDisc "
    "ScalarSubquery Exists ListQuery LateralSubquery SortOrder Cube Rollup GroupingSets GroupingAnalytics "
    "WindowExpression UnresolvedWindowExpression WindowSpecDefinition WindowSpecReference SpecifiedWindowFrame UnspecifiedFrame "
    "UnboundedPreceding UnboundedFollowing CurrentRow LambdaFunction UnresolvedNamedLambdaVariable".split()
)
_SUBQUERIES = ("ScalarSubquery", "Exists", "ListQuery", "LateralSubquery")
#: Looked for once more after analysis, when every function has its class.
_REFUSED = re.compile(r"Reflect|Reflection|UDF$|UDAF$|UDTF$|InputFile|CurrentUser|CurrentDatabase|CurrentCatalog|SparkVersion|JavaMethod")


def governed_sql(spark: SparkSession, tables: Mapping[str, str], sql: str) -> DataFrame:
    """Run one read-only query over the parquet tables given as name to path.

    The text stands as a subquery, where Spark's grammar admits nothing but a query: a command
    fails to parse and is never run. Before it runs, the parsed plan is walked: its relations
    must be the named tables or its own common table expressions, its nodes and expressions those of a query, and its
    functions built-in ones, named outright, that compute from their arguments. The analysed plan is walked once more
    before it is returned. A session of its own holds only the named tables.
    """
    text = sql.strip().rstrip(";")
    session = spark.newSession()
    for key in ("spark.sql.session.timeZone", "spark.sql.shuffle.partitions", "spark.sql.ansi.enabled"):
        session.conf.set(key, spark.conf.get(key))
    session.conf.set("spark.sql.runSQLOnFiles", "false")
    query = f"SELECT * FROM (\n{text}\n) AS governed"
    try:
        plan = session._jsparkSession.sessionState().sqlParser().parsePlan(query)
    except (Py4JJavaError, PySparkException):
        return session.sql(query)  # raises the parser's error as Spark words it
    _check(session, plan, {name.lower() for name in tables})
    for name, path in tables.items():
        session.read.parquet(path).createOrReplaceTempView(name)
    found = session.sql(query)
    _check_analysed(found._jdf.queryExecution().analyzed())
    return found


def _check_analysed(node, is_plan: bool = True) -> None:
    """Raise PermissionError for an expression that looks outside its arguments, however it got its name."""
    if _REFUSED.search(_kind(node)):
        raise PermissionError(f"not allowed in governed SQL: {node.nodeName()}")
    for child in _items(node.children()):
        _check_analysed(child, is_plan)
    if is_plan:
        for expression in _items(node.expressions()):
            _check_analysed(expression, False)
    elif _kind(node) in _SUBQUERIES:
        _check_analysed(node.plan())


def _items(sequence) -> list:
    return [sequence.apply(i) for i in range(sequence.size())]


def _kind(node) -> str:
    return node.getClass().getSimpleName().rstrip("$")


def _check(session: SparkSession, plan, known: set[str]) -> None:
    """Raise PermissionError for anything in a parsed plan that a governed query may not hold."""
    kind = _kind(plan)
    if kind not in _NODES:
        raise PermissionError(f"not allowed in governed SQL: {plan.nodeName()}")
    if kind == "UnresolvedWith":
        # Names are added one by one: an expression sees those before it.
        for pair in _items(plan.cteRelations()):
            _check(session, pair._2(), known)
            known = known | {pair._1().lower()}
    if kind == "UnresolvedRelation":
        name = ".".join(_items(plan.multipartIdentifier()))
        if name.lower() not in known:
            raise PermissionError(f"not among the governed tables: {name}")
    for child in _items(plan.children()):
        _check(session, child, known)
    for expression in _items(plan.expressions()):
        _check_expression(session, expression, known)


def _check_expression(session: SparkSession, expression, known: set[str]) -> None:
    kind = _kind(expression)
    if kind not in _EXPRESSIONS:
        raise PermissionError(f"not allowed in governed SQL: {expression.nodeName()}")
    if kind == "UnresolvedFunction":
        _check_function(session, ".".join(_items(expression.nameParts())))
    if kind == "UnresolvedGenerator":
        _check_function(session, expression.name().funcName())
    if kind in _SUBQUERIES:
        _check(session, expression.plan(), known)
    for child in _items(expression.children()):
        _check_expression(session, child, known)


def _check_function(session: SparkSession, name: str) -> None:
    state = session._jsparkSession.sessionState()
    identifier = state.sqlParser().parseFunctionIdentifier(f"`{name}`")
    try:
        group = state.catalog().lookupFunctionInfo(identifier).getGroup()
    except (Py4JJavaError, PySparkException):
        group = None
    if group not in _GROUPS:
        raise PermissionError(f"not a function of governed SQL: {name}")
