"""Token arrays mapped word by word through a table of any size."""

from __future__ import annotations

import sys

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from murmura.operators.scale import frequent_values
from murmura.session import materialize

# Executors need not have the package installed: the functions travel with the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _replacer(frequent: dict, kind: T.DataType, keep: bool, default):
    arrow = pa.list_(pa.string() if isinstance(kind, T.StringType) else pa.int64())

    @F.arrow_udf(T.ArrayType(kind))
    def replace(tokens: pa.Array, names: pa.Array, values: pa.Array) -> pa.Array:
        out = []
        for k in range(len(tokens)):
            row = tokens[k].as_py()
            if row is not None:
                own = dict(zip(names[k].as_py() or [], values[k].as_py() or []))
                row = [frequent[t] if t in frequent else own.get(t, t if keep else default) for t in row]
            out.append(row)
        return pa.array(out, arrow)

    return replace


def map_tokens(df: DataFrame, column: str, mapping: DataFrame, keep: bool = False, default=None) -> DataFrame:
    """``df`` with the tokens of an array column replaced by their ``value`` in ``mapping (token, value)``, in place.

    ``value`` is a string or a bigint, each token has one at most. Tokens without one stay (``keep``) or become
    ``default``. A null array stays null, an empty one empty, rows may repeat.

    The most frequent tokens (at most a thousand) travel with the task. Of the others each text sends a token once,
    however often it holds it, so no key dominates the join.
    """
    kind = mapping.schema["value"].dataType
    rows = materialize(df.withColumn("_row", F.monotonically_increasing_id()))
    top = [r[0] for r in frequent_values(rows.select(F.explode(F.array_distinct(column)).alias("token")), "token").collect()]
    known = {r["token"]: r["value"] for r in mapping.filter(F.col("token").isin(*top)).select("token", "value").collect()} if top else {}
    frequent = {t: known.get(t, t if keep else default) for t in top}
    common = F.array(*[F.lit(t) for t in top]).cast("array<string>")
    rare = rows.select("_row", F.explode(F.array_except(column, common)).alias("token")).join(mapping, "token")
    found = rare.groupBy("_row").agg(F.collect_list(F.struct("token", "value")).alias("_found"))
    joined = rows.join(found, "_row", "left")
    mapped = _replacer(frequent, kind, keep, default)(F.col(column), F.col("_found.token"), F.col("_found.value"))
    return joined.withColumn(column, mapped).drop("_row", "_found")
