"""Column profile, rule candidates and most frequent values.

All three stand on value counts: the columns of one type family are stacked into rows
``(column_index, value)`` and counted. Repeats are combined before the shuffle, so a
value that fills a third of a column costs one row per task. Families are scanned
apart, each reading only its own columns, so the table's bytes are read once in all
and values keep their type (no text conversion, narrow shuffle rows). Long texts and nested
values are counted by digest, so no row of a shuffle is wider than about a hundred bytes.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewarden.functions.grading import percentage
from tablewarden.functions.names import TableRef, quote
from tablewarden.operators.keys import short_key
from tablewarden.sources.store import Store, shared_root

NESTED = (T.ArrayType, T.StructType, T.MapType)
INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)

HEAD = 64  # bytes of a text that are counted and ranked as they are

# Wide tables are stacked in slices of this many columns, which keeps generated code small.
COLUMNS_PER_SCAN = 64


def _groupable(name: str, data_type: T.DataType) -> tuple[str, str]:
    """Type family and value, in SQL: equal values stay equal, unequal ones unequal."""
    if isinstance(data_type, INTEGRAL):
        return "bigint", f"CAST({quote(name)} AS BIGINT)"
    if isinstance(data_type, T.VariantType):
        return "string", f"to_json({quote(name)})"
    if _has_map(data_type):
        return f"sorted {data_type.simpleString()}", _sorted(quote(name), data_type)
    return data_type.simpleString(), quote(name)


def _has_map(data_type: T.DataType) -> bool:
    """Whether a map or variant, which Spark cannot group by, is inside."""
    if isinstance(data_type, T.ArrayType):
        return _has_map(data_type.elementType)
    if isinstance(data_type, T.StructType):
        return any(_has_map(f.dataType) for f in data_type.fields)
    return isinstance(data_type, (T.MapType, T.VariantType))


def _sorted(value: str, data_type: T.DataType, depth: int = 0) -> str:
    """The value with maps as entries in order of key and variants as JSON, in SQL."""
    if not _has_map(data_type):
        return value
    item = f"x{depth}"
    if isinstance(data_type, T.ArrayType):
        return f"transform({value}, {item} -> {_sorted(item, data_type.elementType, depth + 1)})"
    if isinstance(data_type, T.MapType):
        entry = f"named_struct('key', {item}.key, 'value', {_sorted(f'{item}.value', data_type.valueType, depth + 1)})"
        return f"array_sort(transform(map_entries({value}), {item} -> {entry}))"
    if isinstance(data_type, T.StructType):
        fields = ", ".join(
            f"'f{i}', {_sorted(f'{value}.{quote(f.name)}', f.dataType, depth)}" for i, f in enumerate(data_type.fields)
        )
        return f"if({value} IS NULL, NULL, named_struct({fields}))"
    return f"to_json({value})"


def canonical(value: str, data_type: T.DataType, depth: int = 0) -> str:
    """A text, in SQL, that is equal for equal values of a type and for no others; never NULL.

    Maps are equal whatever the order of their entries, as are 0.0 and -0.0.
    """
    item = f"y{depth}"
    if isinstance(data_type, T.ArrayType):
        inner = canonical(item, data_type.elementType, depth + 1)
        text = f"concat('[', concat_ws(',', transform({value}, {item} -> {inner})), ']')"
    elif isinstance(data_type, T.MapType):
        key = canonical(f"{item}.key", data_type.keyType, depth + 1)
        inner = canonical(f"{item}.value", data_type.valueType, depth + 1)
        entries = f"transform(map_entries({value}), {item} -> concat({key}, '=', {inner}))"
        text = f"concat('{{', concat_ws(',', array_sort({entries})), '}}')"
    elif isinstance(data_type, T.StructType):
        fields = [canonical(f"{value}.{quote(f.name)}", f.dataType, depth) for f in data_type.fields]
        text = f"concat('(', concat_ws(',', array({', '.join(fields)})), ')')"
        text = f"IF({value} IS NULL, NULL, {text})"
    elif isinstance(data_type, T.BinaryType):
        text = f"hex({value})"
    elif isinstance(data_type, (T.FloatType, T.DoubleType)):
        text = f"CAST(IF({value} = 0, CAST(0 AS {data_type.simpleString()}), {value}) AS STRING)"
    elif isinstance(data_type, T.TimestampType):
        text = f"CAST(unix_micros({value}) AS STRING)"
    elif isinstance(data_type, T.VariantType):
        text = f"to_json({value})"
    elif isinstance(data_type, T.StringType):
        text = f"concat(length({value}), ':', {value})"  # the length, as a text may hold any sign used here
    else:
        text = f"CAST({value} AS STRING)"
    return f"coalesce(concat('v', {text}), 'n')"


def _families(
    df: DataFrame, columns: Sequence[str] | None, digest: bool
) -> dict[tuple[str, int], list[tuple[int, str]]]:
    """Positions and values, in SQL, of the columns by type family and slice."""
    families: dict[tuple[str, int], list[tuple[int, str]]] = {}
    for i, f in enumerate(df.schema.fields):
        if columns is None or f.name in columns:
            if digest and isinstance(f.dataType, NESTED):
                name = quote(f.name)
                family, value = "string", f"IF({name} IS NULL, NULL, sha2({canonical(name, f.dataType)}, 256))"
            else:
                family, value = _groupable(f.name, f.dataType)
                value = short_key(value, family) if digest else value
            families.setdefault((family, i // COLUMNS_PER_SCAN), []).append((i, value))
    return families


def value_counts(df: DataFrame, columns: Sequence[str] | None = None) -> list[DataFrame]:
    """``(column_index, value, n)`` per type family; the index is the position in ``df``.

    Long texts and nested values are counted by their SHA-256 and never shuffled whole.
    """
    return [_counted(df, members) for members in _families(df, columns, digest=True).values()]


def _counted(df: DataFrame, members: Sequence[tuple[int, str]]) -> DataFrame:
    pairs = ", ".join(f"{i}, {value}" for i, value in members)
    stacked = df.selectExpr(f"stack({len(members)}, {pairs}) AS (column_index, value)")
    return stacked.groupBy("column_index", "value").agg(F.count(F.lit(1)).alias("n"))


def profile_table(df: DataFrame, ref: TableRef, run_timestamp: Column | None = None) -> DataFrame:
    """One row per column: type, rows, NULLs and distinct values (NULL being one).

    The per-column sums run as hash aggregates in the tasks that hold the value counts;
    names and types, being known from the schema, are added to the few rows that remain.
    """
    n, zero = F.col("n"), F.lit(0).cast("long")
    parts = [
        counts.select(
            "column_index",
            n,
            F.when(F.col("value").isNull(), n).otherwise(zero).alias("nulls"),
            F.lit(1).cast("long").alias("values"),
        )
        for counts in value_counts(df)
    ]
    # zero rows, so that the columns of an empty table show up too
    every_column = df.sparkSession.range(len(df.columns)).select(
        F.col("id").cast("int").alias("column_index"), *(zero.alias(c) for c in ("n", "nulls", "values"))
    )
    added = (
        reduce(DataFrame.unionByName, parts, every_column)
        .groupBy("column_index")
        .agg(
            F.sum("n").alias("row_count"),
            F.sum("nulls").alias("null_count"),
            F.sum("values").alias("distinct_count"),
        )
    )
    position = F.col("column_index")
    types = [f.dataType.simpleString() for f in df.schema.fields]
    return added.select(
        F.lit(ref.catalog).alias("catalog"),
        F.lit(ref.schema).alias("schema"),
        F.lit(ref.table).alias("table"),
        F.get(F.lit(df.columns), position).alias("column_name"),
        F.get(F.lit(types), position).alias("data_type"),
        "row_count",
        "null_count",
        percentage(F.col("null_count"), F.col("row_count")).alias("null_percentage"),
        "distinct_count",
        (F.current_timestamp() if run_timestamp is None else run_timestamp).alias("profile_timestamp"),
    )


def rule_candidates(profile: DataFrame, null_threshold: float = 1.0) -> DataFrame:
    """Rules the profile suggests; a column may yield several. One pass over the profile."""

    def candidate(applies: Column, rule: str, reason: str) -> Column:
        return F.when(
            applies, F.struct(F.lit(rule).alias("candidate_rule"), F.lit(reason).alias("reason"))
        )

    suggestions = F.array_compact(
        F.array(
            candidate(
                F.col("null_percentage") > float(null_threshold),
                "NULL_CHECK",
                f"Null percentage exceeds {null_threshold}%",
            ),
            candidate(
                (F.col("distinct_count") == 1) & (F.col("row_count") > 1),
                "LOW_CARDINALITY",
                "Column contains one distinct value",
            ),
        )
    )
    return profile.select(
        "catalog",
        "schema",
        "table",
        "column_name",
        F.inline(suggestions),
        F.col("profile_timestamp").alias("created_timestamp"),
    )


def top_values(df: DataFrame, n: int = 10, columns: Sequence[str] | None = None) -> DataFrame:
    """The ``n`` most frequent values of each column, ties in order of value.

    The rank filter lets Spark keep only ``n`` values per column and task before the
    ranking shuffle (group limit), so no task receives a whole column. Texts are counted and
    ranked without moving them, see ``_top_texts``.
    """
    ranked = []
    for (family, _), members in _families(df, columns, digest=False).items():
        counts = _top_texts(df, members, family, n) if family in ("string", "binary") else _counted(df, members)
        ranked.append(_ranked(counts, n, F.col("value").asc_nulls_last()))
    names = F.lit(df.columns)
    parts = [
        counts.select(
            F.get(names, F.col("column_index")).alias("column_name"),
            F.col("value").cast("string").alias("value"),
            F.col("n").alias("value_count"),
            "rank",
        )
        for counts in ranked
    ]
    return reduce(DataFrame.unionByName, parts)


def _ranked(counts: DataFrame, n: int, *ties: Column) -> DataFrame:
    order = W.partitionBy("column_index").orderBy(F.col("n").desc(), *ties)
    return counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= int(n))


def _top_texts(df: DataFrame, members: Sequence[tuple[int, str]], family: str, n: int) -> DataFrame:
    """``(column_index, value, n)``: the most frequent texts and what ties with the last of them.

    A text is counted as its first ``HEAD`` bytes and, if there are more, a digest. The first
    ``n`` pairs of count and head cover the ``n`` most frequent texts, and they are so few that
    they can be broadcast. The counts that have such a pair are written: their number decides
    how Spark joins them with the column, from which the long ones among them are read again.
    """
    spark = df.sparkSession
    parts = ", ".join(
        f"{i}, substring(CAST({value} AS BINARY), 1, {HEAD}),"
        f" IF(octet_length({value}) > {HEAD}, unhex(sha2({value}, 256)), NULL)"
        for i, value in members
    )
    stacked = df.selectExpr(f"stack({len(members)}, {parts}) AS (column_index, head, digest)")
    counts = stacked.groupBy("column_index", "head", "digest").agg(F.count(F.lit(1)).alias("n"))
    pairs = counts.select("column_index", "n", "head").distinct()
    first = _ranked(pairs, n, F.col("head").asc_nulls_last()).drop("rank").toDF("c", "m", "h")
    same = (F.col("column_index") == F.col("c")) & (F.col("n") == F.col("m")) & F.col("head").eqNullSafe(F.col("h"))
    store = Store(shared_root(spark))
    store.write(counts.join(F.broadcast(first), same, "left_semi"), "top_values", "kept")
    kept = store.read(spark, "top_values", "kept")
    long = kept.filter("digest IS NOT NULL").select("column_index", "digest")
    holding = {row[0] for row in long.select("column_index").distinct().toLocalIterator()}
    value = F.col("head").cast(family)
    if holding:
        found = [_texts(df, i, text, long) for i, text in members if i in holding]
        kept = kept.join(reduce(DataFrame.unionByName, found), ["column_index", "digest"], "left")
        value = F.coalesce("text", value)
    return kept.select("column_index", value.alias("value"), "n")


def _texts(df: DataFrame, index: int, value: str, digests: DataFrame) -> DataFrame:
    """The texts of a column that have one of the digests, each once."""
    texts = df.selectExpr(f"{value} AS text").filter(F.octet_length("text") > HEAD)
    texts = texts.withColumn("digest", F.unhex(F.sha2("text", 256)))
    own = digests.filter(F.col("column_index") == index).select("digest")
    once = texts.join(own, "digest", "left_semi").groupBy("digest").agg(F.first("text").alias("text"))
    return once.withColumn("column_index", F.lit(index))
