"""Are the outputs of a run there, complete, and of the agreed shape?"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from py4j.protocol import Py4JError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.quality import check_sorted
from tidemark.session import path_exists
from tidemark.sinks.contents import counted, noted, plain
from tidemark.sinks.tables import table_location


@dataclass(frozen=True)
class Output:
    """One expected output: a table name if ``kind`` is "table", else a path of that file format."""

    name: str
    target: str
    kind: str
    schema: T.StructType
    header: bool = True
    may_be_empty: bool = False  # a result without rows is in order
    null: str | None = None  # how text files spell NULL
    sorted_by: tuple[str, ...] = ()  # columns that its files are in the order of

    def read(self, spark: SparkSession) -> DataFrame:
        if self.kind == "table":
            return spark.table(self.target)
        if self.kind == "csv":
            # Text under the file's own names, so that a wrong header shows.
            reader = spark.read.option("header", self.header).option("escape", '"')
            return (reader if self.null is None else reader.option("nullValue", self.null)).csv(self.target)
        return spark.read.format(self.kind).load(self.target)

    def present(self, spark: SparkSession) -> bool:
        if self.kind == "table":
            return spark.catalog.tableExists(self.target)
        return path_exists(spark, self.target)

    def complete(self, spark: SparkSession) -> bool:
        """Whether the writing job committed; a table appears in the catalog only then."""
        if self.kind == "table":
            return self.present(spark)
        return path_exists(spark, f"{self.target}/_SUCCESS")

    def place(self, spark: SparkSession) -> str:
        """The folder of its files."""
        return table_location(spark, self.target) if self.kind == "table" else self.target

    def agrees(self, found: T.StructType) -> bool:
        if self.kind == "csv":
            # The reader numbers columns without a header.
            names = [name or f"_c{i}" for i, name in enumerate(self.schema.fieldNames())]
            return found.fieldNames() == names if self.header else len(found) == len(self.schema)
        return [(f.name, f.dataType) for f in found] == [(f.name, f.dataType) for f in self.schema]


REPORT = "output string, present boolean, complete boolean, schema_ok boolean, has_rows boolean"


def check_outputs(spark: SparkSession, outputs: Sequence[Output]) -> DataFrame:
    """One row per expected output. Reads back metadata and at most one row of each."""
    rows = []
    for output in outputs:
        present = output.present(spark)
        complete = present and output.complete(spark)
        schema_ok = has_rows = False
        if complete:
            try:
                stored = output.read(spark)
                has_rows = not stored.isEmpty()
                # Headerless text without rows has no columns to compare.
                unseen = output.may_be_empty and not has_rows and output.kind == "csv"
                schema_ok = unseen or output.agrees(stored.schema)
            except AnalysisException:
                pass
        rows.append((output.name, present, complete, schema_ok, has_rows))
    return spark.createDataFrame(rows, REPORT)


CONTENTS = "output string, rows long, written long, problem string"


def check_contents(spark: SparkSession, outputs: Sequence[Output]) -> DataFrame:
    """One row per expected output: its rows, those it was written with, and what is wrong, if anything.

    Each output is read once, whole: its values under its types, its rows and their checksum against the note
    taken when it was written, and, where it is to be in an order, its order.
    """
    rows = []
    for output in outputs:
        found = written = None
        if not (output.present(spark) and output.complete(spark)):
            problem = "absent"
        elif (note := noted(spark, output.place(spark))) is None:
            problem = "no note"
        else:
            written = note[0]
            try:
                found, problem = _held_against(spark, output, note)
            except (PySparkException, Py4JError):  # a broken file comes as either
                problem = "unreadable"
        rows.append((output.name, found, written, problem))
    return spark.createDataFrame(rows, CONTENTS)


def _held_against(spark: SparkSession, output: Output, note: tuple[int, str]) -> tuple[int, str | None]:
    stored = output.read(spark)
    names = output.schema.fieldNames()
    if not stored.columns and note[0] == 0:
        return 0, None
    if len(stored.columns) != len(names):
        return stored.count(), "columns"
    rows, checksum, bad = counted(stored, output.schema)
    if bad:
        return rows, f"not of its type: {', '.join(sorted(bad))}"
    if rows != note[0]:
        return rows, "rows"
    if checksum != note[1]:
        return rows, "values"
    if output.sorted_by:
        held = plain(output.schema)
        keys = [held.fields[names.index(c)] for c in output.sorted_by]
        typed = stored.toDF(*held.fieldNames()).withColumns({f.name: F.col(f.name).cast(f.dataType) for f in keys})
        order = check_sorted(typed, [f.name for f in keys]).first()
        if order["breaks_within"] or order["breaks_between"]:
            return rows, "order"
    return rows, None


def missing_outputs(spark: SparkSession, outputs: Sequence[Output], contents: bool = False) -> list[str]:
    """Names of outputs that are absent, unfinished, empty or of another shape; with ``contents`` also those
    that don't hold what was written."""
    if contents:
        wrong = [r["output"] for r in check_contents(spark, outputs).where("problem is not null").collect()]
        return list(dict.fromkeys([*missing_outputs(spark, outputs), *wrong]))
    report = check_outputs(spark, outputs)
    bad = report.where("NOT (present AND complete AND schema_ok AND has_rows)").collect()
    empty_is_fine = {o.name for o in outputs if o.may_be_empty}
    return [
        r["output"]
        for r in bad
        if not (r["present"] and r["complete"] and r["schema_ok"] and r["output"] in empty_is_fine)
    ]


def missing_names(expected: DataFrame, found: DataFrame, name: str) -> DataFrame:
    """Expected names without a counterpart in ``found``."""
    return expected.join(found, name, "left_anti")


def run_if_incomplete(
    spark: SparkSession, outputs: Sequence[Output], job: Callable[[], None], contents: bool = False
) -> bool:
    """Run ``job`` unless every output is in order already; True if it ran.

    The outputs are checked again afterwards, and a run that leaves one missing fails. ``contents`` reads the
    outputs whole, which costs a scan of each and finds what a look at their files does not.
    """
    if not missing_outputs(spark, outputs, contents):
        return False
    job()
    still = missing_outputs(spark, outputs, contents)
    if still:
        raise RuntimeError(f"outputs missing after the run: {still}")
    return True

