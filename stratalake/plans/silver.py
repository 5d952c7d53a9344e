"""Bronze text to typed silver."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType

from ..functions import blank_tokens, clean_cast

# Bytes beyond which the JVM (HotSpot) interprets a method for good instead of translating it to machine code.
LONGEST_METHOD = 8000


def to_silver(bronze: DataFrame, columns: Mapping[str, DataType], key: str) -> DataFrame:
    """``key`` and the declared columns, typed, null tokens removed, lower-case names.

    Projections over the scan: no shuffle, and the scan reads only these columns. Fused with the scan into one method,
    the casts of all numbers are longer than the JVM translates. The text columns share one higher-order expression,
    which keeps the projection out of fused code, so that each number's cast compiles to a short method of its own. Where
    later steps drop all text, the session's limit makes Spark leave fused code that is too long.
    """
    bronze.sparkSession.conf.set("spark.sql.codegen.hugeMethodLimit", str(LONGEST_METHOD))
    texts = [name for name, dtype in columns.items() if isinstance(dtype, StringType)]
    cells = {name: F.col("__texts")[place] for place, name in enumerate(texts)}
    shared = [F.transform(F.array(*texts), lambda text: blank_tokens(text)).alias("__texts")] if texts else []
    numbers = [clean_cast(F.col(name), dtype).alias(name) for name, dtype in columns.items() if name not in cells]
    cast = bronze.select(key, *numbers, *shared)
    return cast.select(key, *[cells.get(name, F.col(name)).alias(name.lower()) for name in columns])
