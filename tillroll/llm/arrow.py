"""Arrow functions over a text column, in slices of bounded size."""

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import functions as F

#: Rows of an Arrow batch that are turned into Python objects at a time. Spark bounds a batch (64 MB).
SLICE = 512


def over_texts(spark_type: str, arrow_type: pa.DataType, prepare, raw: bool = False):
    """A column function from texts to values.

    prepare() runs once in each task and gives a function from a list of texts (or of UTF-8
    bytes, if raw) to a list of as many values.
    """

    def apply(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        function = prepare()
        for batch in batches:
            batch = batch.cast(pa.binary()) if raw else batch
            parts = [
                pa.array(function(batch.slice(at, SLICE).to_pylist()), type=arrow_type)
                for at in range(0, len(batch), SLICE)
            ]
            yield pa.concat_arrays(parts) if parts else pa.array([], type=arrow_type)

    return F.arrow_udf(apply, returnType=spark_type)
