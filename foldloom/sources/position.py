"""Where a row of a file source comes from, as a value that orders rows by list and file position."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def file_position(input_no: int) -> Column:
    """Position of the file in the caller's list, file, block within the file, row within the task.

    A block is read by one task from its start to its end, so the counter orders its rows, and
    blocks are ordered by their offset. The order does not depend on how blocks are packed into tasks.
    """
    return F.struct(
        F.lit(input_no).alias("input_no"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),
    )
