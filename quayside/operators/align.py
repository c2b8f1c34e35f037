"""Alignment: JSON lines become rows of blank-filled text in contract order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions.names import quoted, text_literal, unused
from quayside.sources.contract import Contract
from quayside.sources.storage import scratch_path

Spellings = dict[str, list[str]]

# Fixed value: the separator of JSON texts, which cannot stand in one.
RECORD_END = "\x1e"


def observed_keys(lines: DataFrame, column: str = "value") -> DataFrame:
    """Distinct top-level keys of JSON lines (`col_name`). Malformed lines have none."""
    return lines.select(F.explode(F.json_object_keys(F.col(quoted(column)))).alias("col_name")).distinct()


def schema_diff(keys: DataFrame, contract: Contract) -> DataFrame:
    """Contract against observed keys (`col_name`, `status`): present, missing from the data, or extra in it.

    Names match whatever their case is, and each gives one row; a present column takes the contract's spelling.
    """
    names = ", ".join(text_literal(n) for n in contract.names)
    wanted = keys.sparkSession.range(1).selectExpr(f"explode(array({names})) AS wanted", "CAST(NULL AS string) AS seen")
    found = keys.select(F.lit(None).cast("string").alias("wanted"), F.col("col_name").alias("seen"))
    by_name = (
        wanted.union(found)
        .groupBy(F.lower(F.coalesce("wanted", "seen")).alias("folded"))
        .agg(F.max("wanted").alias("wanted"), F.min("seen").alias("seen"))
    )
    status = F.when(F.col("seen").isNull(), "missing").when(F.col("wanted").isNull(), "extra").otherwise("present")
    return by_name.select(F.coalesce("wanted", "seen").alias("col_name"), status.alias("status"))


def matched_spellings(names: list[str], contract: Contract) -> Spellings:
    """For every contract field, the given spellings of it: its own first, then by code point."""
    by_folded: Spellings = {}
    for name in sorted(names):
        by_folded.setdefault(name.lower(), []).append(name)
    return {n: sorted(by_folded.get(n.lower(), []), key=lambda s: s != n) for n in contract.names}


def discover_spellings(lines: DataFrame, contract: Contract, column: str = "value") -> Spellings:
    """The spellings of the contract's fields in the data. Keys outside the contract stay on the cluster."""
    folded = [n.lower() for n in contract.names]
    known = observed_keys(lines, column).where(F.lower("col_name").isin(folded))
    return matched_spellings([r["col_name"] for r in known.collect()], contract)


def missing_fields(spellings: Spellings) -> list[str]:
    return [name for name, seen in spellings.items() if not seen]


def _text_ddl(names: list[str]) -> str:
    return ", ".join(f"{quoted(n)} STRING" for n in names)


def align_lines(lines: DataFrame, contract: Contract, spellings: Spellings, column: str = "value") -> DataFrame:
    """Parse JSON lines into text columns, the contract's fields in order, followed by the malformed line if it is one.

    Null, absent and missing fields are all blank text; keys outside the contract are dropped. A string gives its
    characters, everything else the very characters that stand in the line: no number or nested value is rewritten. A
    field seen in several spellings takes the first one present in a record. A line that is no single JSON object is
    malformed; blank lines are none at all.

    Only Spark's JSON scan keeps what stands in a line, and it takes no two spellings of one name at one level. So lines
    are written to the shared folder once more, each as the value of a key for every spelling, and the scan reads the
    first spellings below the first key, the second ones below the second.
    """
    spark = lines.sparkSession
    depth = max([len(s) for s in spellings.values()] + [1])
    layers = [[s[i] for s in spellings.values() if len(s) > i] or contract.names[:1] for i in range(depth)]
    keys = [f"p{i}" for i in range(depth)]
    openings = ["{" + f'"{keys[0]}":', *[f',"{key}":' for key in keys[1:]]]
    line = quoted(column)
    closing = ',"end":0}'
    wrapped = f"concat({', '.join(f'{text_literal(o)}, {line}' for o in openings)}, {text_literal(closing)})"
    # a line that ends before its last character would put keys of its own between these, or keep the last one out
    alone = f"coalesce(json_object_keys({wrapped}) = array({', '.join(map(text_literal, [*keys, 'end']))}), true)"
    path = scratch_path(spark, "wrapped")
    copies = lines.where(f"{line} RLIKE r'[^\\x00-\\x20]'").selectExpr(
        f"CASE WHEN {alone} THEN {wrapped} ELSE to_json(named_struct('line', {line})) END AS value"
    )
    copies.write.mode("overwrite").option("lineSep", RECORD_END).text(path)

    read = [f"{key} STRUCT<{_text_ddl(names)}>" for key, names in zip(keys, layers)]
    scan = (
        spark.read.schema(", ".join([*read, "line STRING", "bad STRING"]))
        .option("columnNameOfCorruptRecord", "bad")
        .option("lineSep", RECORD_END)
        .json(path)
    )
    fields = []
    for name, seen in spellings.items():
        found = [f"p{i}.{quoted(s)}" for i, s in enumerate(seen)]
        fields.append(f"coalesce({', '.join([*found, repr('')])}) AS {quoted(name)}")
    around = sum(map(len, openings)) + len(closing)
    given = f"substr(bad, {len(openings[0]) + 1}, (char_length(bad) - {around}) div {depth})"
    bad = quoted(unused("_bad_line", contract.names))
    return scan.selectExpr(
        *fields, f"CASE WHEN p0 IS NULL THEN coalesce({given}, line, 'null') WHEN bad IS NOT NULL THEN {given} END AS {bad}"
    )


def read_aligned(
    spark: SparkSession, path: str, contract: Contract, spellings: Spellings, foreign: bool = False
) -> DataFrame:
    """The same rows as `align_lines`, straight from files of one JSON object per line.

    The JSON scan parses only the contract's fields, without a text row in between. `foreign` files, which may hold
    lines that are no single object, and data with two spellings of one field or with none of the fields are written
    once more first.
    """
    observed = [seen[0] for seen in spellings.values() if seen]
    if foreign or not observed or any(len(seen) > 1 for seen in spellings.values()):
        return align_lines(spark.read.text(path), contract, spellings)
    bad = unused("_bad_line", contract.names)
    scan = spark.read.schema(_text_ddl([*observed, bad])).option("columnNameOfCorruptRecord", bad).json(path)
    fields = [
        (f"coalesce({quoted(seen[0])}, '')" if seen else "''") + f" AS {quoted(name)}"
        for name, seen in spellings.items()
    ]
    # Spark refuses to read the malformed lines alone. The condition never holds; it ties them to a field.
    some, line = quoted(observed[0]), quoted(bad)
    return scan.selectExpr(*fields, f"CASE WHEN octet_length({some}) < 0 THEN {some} ELSE {line} END AS {line}")
