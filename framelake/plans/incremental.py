"""Conversion of a growing set of files, each once: what a run converts, and that it did, are one commit."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelake.shared import fixed
from framelake.sources import lake

#: What tells a file: a file that grew or was written anew is another one.
FILE = "path string, length long, modified long"
KEY = ["path", "length", "modified"]


def converted(files: DataFrame, root: str) -> DataFrame:
    """The log of files that rows of the table at root were made from."""
    spark = files.sparkSession
    return lake.load(spark, root, FILE, lake.INPUTS) if lake.exists(spark, root) else spark.createDataFrame([], FILE)


def pending(files: DataFrame, root: str) -> DataFrame:
    """Of files(path, length, modified), those that haven't been converted, each once."""
    own = files.select(*[F.col(c.split()[0]).cast(c.split()[1]) for c in FILE.split(", ")]).where("path IS NOT NULL").distinct()
    return own.join(converted(files, root), KEY, "left_anti")


def run(files: DataFrame, root: str, convert: Callable[[DataFrame], DataFrame]) -> int:
    """Convert the pending files and append the rows with their log in one commit; how many files there were.

    convert takes the table of files and returns rows. A run that fails has converted nothing, and one that is run again
    finds nothing to do. Runs of one table follow each other.
    """
    todo = fixed(pending(files, root))  # asked for three times: counted, converted, logged
    n = todo.count()
    if n:
        lake.append_with_inputs(convert(todo), todo, root)
    return n
