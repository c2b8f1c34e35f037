"""Sinks: typed and quarantined rows in `dt=` directories that a rerun replaces."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession

from quayside.functions.names import quoted
from quayside.sources.contract import Contract, writer_schema
from quayside.sources.storage import delete_directory, file_system, read_small, write_small

AVRO = "avro"
PARQUET = "parquet"
# The class behind the short name. The name itself is known only where the external package is deployed.
_AVRO_CLASS = "org.apache.spark.sql.avro.AvroFileFormat"


def table_dir(output_dir: str, table: str, run_partition: str) -> str:
    return f"{output_dir.rstrip('/')}/{table}/dt={run_partition}"


def quarantine_dir(output_dir: str, table: str, run_partition: str) -> str:
    return table_dir(output_dir, f"{table}_err", run_partition)


def storage_format(name: str) -> str:
    """The data source behind `parquet` or `avro`."""
    return _AVRO_CLASS if name == AVRO else name


def clustered(df: DataFrame, columns: Sequence[str] = ()) -> DataFrame:
    """Bring rows of one sub-partition together, so that tasks do not each write a small file for every value.

    Adaptive execution sizes the result: little data shares a task, a value with much of it is split over several.
    Without columns it only evens out the tasks, which suits a few rows left over from many.
    """
    return df.hint("rebalance", *columns)


def staging_dir(path: str) -> str:
    """A new directory beside a partition, with a name that readers of the table pass over."""
    parent, _, name = path.rpartition("/")
    return f"{parent}/.{name.replace('=', '-')}.{uuid.uuid4().hex}"


@dataclass(frozen=True)
class Move:
    """One partition of a commit: where its new files are, where they go, and where the old ones wait meanwhile."""

    path: str
    staged: str
    aside: str
    replaces: bool


def journal_path(output_dir: str, table: str, run_partition: str) -> str:
    return f"{output_dir.rstrip('/')}/.commit-{table}-dt={run_partition}.json"


def _journal(spark: SparkSession, journal: str) -> list[Move]:
    """The moves of a commit that has begun and not ended. Text that was cut off is from one that moved nothing yet."""
    text = read_small(spark, journal)
    try:
        return [Move(**move) for move in json.loads(text)["moves"]] if text else []
    except ValueError:
        return []


def publish(spark: SparkSession, staged: dict[str, str], journal: str) -> None:
    """Put finished directories, `staged` by the partition they are for, in the place of these partitions, all or none.

    The journal, a file, is written before anything moves and removed when everything has. That removal is the commit:
    until then readers that resolve through the journal see all the old partitions, from then on all the new ones. A
    move that fails is undone at once; what a lost driver leaves is undone by the next run, see `recover`.
    """
    moves = []
    for path, new in staged.items():
        fs, target = file_system(spark, path)
        moves.append(Move(path, new, staging_dir(path), fs.exists(target)))
    write_small(spark, journal, json.dumps({"moves": [asdict(m) for m in moves]}))
    try:
        for move in moves:
            if move.replaces:
                _rename(spark, move.path, move.aside)
        for move in moves:
            _rename(spark, move.staged, move.path)
    except Exception:
        recover(spark, journal)
        raise
    delete_directory(spark, journal)
    for move in moves:
        delete_directory(spark, move.aside)


def recover(spark: SparkSession, journal: str) -> None:
    """Undo a commit that did not end: the old partitions come back. Does nothing where there is none, and again no harm."""
    for move in _journal(spark, journal):
        fs, target = file_system(spark, move.path)
        if not move.replaces:
            if not fs.exists(file_system(spark, move.staged)[1]):
                delete_directory(spark, move.path)
        elif fs.exists(file_system(spark, move.aside)[1]):
            # whatever stands there is new; the old files wait aside
            delete_directory(spark, move.path)
            _rename(spark, move.aside, move.path)
        delete_directory(spark, move.staged)
    delete_directory(spark, journal)


def resolved(spark: SparkSession, path: str, journal: str) -> str | None:
    """Where the committed files of a partition are just now; None where it has none."""
    for move in _journal(spark, journal):
        if move.path == path and not move.replaces:
            return None
        if move.path == path:
            fs, aside = file_system(spark, move.aside)
            return move.aside if fs.exists(aside) else path
    fs, target = file_system(spark, path)
    return path if fs.exists(target) else None


def _rename(spark: SparkSession, source: str, target: str) -> None:
    fs, there = file_system(spark, target)
    if not fs.rename(file_system(spark, source)[1], there):
        raise OSError(f"{source} could not be moved to {target}")


def write_partition(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    sink_format: str = PARQUET,
    contract: Contract | None = None,
) -> None:
    """Replace what is under `path`. An empty text partition value is stored, and read back, as null.

    Avro files carry the contract's own schema, with its logical types, enums, fixed lengths and fields without null.
    """
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*partition_by)
    if sink_format == AVRO and contract is not None:
        schema = writer_schema(contract, partition_by)
        if schema is not None:
            writer = writer.option("avroSchema", schema)
        else:
            writer = writer.option("recordName", contract.name)
            if contract.namespace:
                writer = writer.option("recordNamespace", contract.namespace)
    writer.format(storage_format(sink_format)).save(path)


def read_partition(
    spark: SparkSession, path: str, contract: Contract, sink_format: str = PARQUET, as_text: bool = False
) -> DataFrame:
    """Read a written partition with the contract's types, not with types guessed from directory names."""
    schema = contract.text_schema if as_text else contract.schema
    reader = spark.read.format(storage_format(sink_format)).schema(schema)
    return reader.load(path).select(*[quoted(n) for n in contract.names])
