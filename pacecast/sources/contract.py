"""The contract of the metric facts, and the rows that break it.

``check_facts`` reads a folder of facts (``standins.read_facts``) against the declared columns,
types, keys and orders of magnitude, and splits every fact into the rows a forecast may read and
rows set aside, each with the first reason that holds:

* ``no time`` - the fact's time is null;
* ``no member: <column>`` - a key column is null;
* ``unreadable: <column>`` - the stored value is not one of the declared type, or loses digits in it;
* ``negative: <column>`` - a number of users or transactions below zero;
* ``above month to date: <column>`` - a day's or an hour's number above its month's;
* ``repeated row`` - further copies of a row that is kept once (``copies`` says how many);
* ``conflicting key`` - rows of one key that differ: none of them is kept.

A column that is missing, or a type nothing can be read from, is the whole table's fault: ``ContractError``.
Row-grain fees have no key, so equal rows are all kept; nor are members asked for where a fact has no key. A report whose days may come in several rows (the
forecast then takes the largest) is read with ``keys={"card_daily": None}``. Columns that the contract doesn't name are
ignored; empty facts give empty results. A table has one stored type per column: files of a table that differ in it
fail in Spark's reader.

Copies are counted by a grouping over whole rows and differing keys by one over the remaining distinct rows,
both aggregated before their shuffle; only keys that are in conflict are joined back, so a key that
holds a third of all rows is not one task's raw rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, NumericType, StructType

from .standins import FACT_COLUMNS, FACT_TIMES, Inputs, hourly_sources

FEE_COLUMNS = "created_at timestamp_ntz, fee decimal(38,10)"
#: Key columns of each fact; None: rows have no key.
FACT_KEYS: dict[str, list[str] | None] = {
    "card_daily": ["date"],
    "entry_type_daily": ["date", "type_code"],
    "fee_rows": None,
    "acceptor_cube": ["date", "acceptor_id", "category_id", "is_abroad", "is_offline"],
    "bill_hourly": ["hour", "group_id", "company_id"],
    "game_hourly": ["hour", "group_id", "sub_type_id"],
    "travel_hourly": ["hour", "group_id", "company_id"],
}
#: Numbers that cannot be negative.
COUNTS = ["online_count", "offline_count", "users_daily", "users_hourly", "users_mtd", "tx_daily", "tx_hourly", "tx_mtd"]


class ContractError(ValueError):
    """A fact's table does not have the declared columns."""


@dataclass
class Checked:
    """Facts that keep the contract, and the rows that don't (fact, day, reason, copies, row as JSON)."""
    facts: dict[str, DataFrame]
    bad: DataFrame

    def inputs(self) -> Inputs:
        """The good rows as the inputs of a forecast."""
        f = self.facts
        return Inputs(card_daily=f["card_daily"], entry_type_daily=f["entry_type_daily"], fee_rows=f["fee_rows"],
                      acceptor_cube=f["acceptor_cube"],
                      hourly_cube=hourly_sources(*[f[n] for n in ("bill_hourly", "game_hourly", "travel_hourly")]))


def _declared(name: str, stored: StructType) -> StructType:
    """The declared columns of a fact; its table must have each of them."""
    declared = StructType.fromDDL(FACT_COLUMNS.get(name, FEE_COLUMNS))
    missing = [f.name for f in declared if f.name not in stored.fieldNames()]
    if missing:
        raise ContractError(f"{name}: no column {', '.join(missing)}")
    if name == "fee_rows":  # fees keep the decimal type they are stored with
        kind = stored["fee"].dataType
        declared["fee"].dataType = kind if isinstance(kind, DecimalType) else declared["fee"].dataType
        declared["created_at"].dataType = (stored["created_at"].dataType
                                           if "timestamp" in stored["created_at"].dataType.simpleString()
                                           else declared["created_at"].dataType)
    return declared


def _unreadable(col: str, stored: DataType, declared: DataType) -> Column:
    """Whether a stored value cannot be told in the declared type without loss."""
    raw, read = F.col(f"_raw.{col}"), F.col(col)
    lost = read.isNull() & raw.isNotNull()
    if stored != declared and isinstance(stored, NumericType) and isinstance(declared, NumericType):
        lost = lost | (read.isNotNull() & (raw != read))
    return lost


def _reason(name: str, stored: StructType, declared: StructType, key: list[str] | None) -> Column:
    """The first of the row's own faults, or null."""
    time, fields = FACT_TIMES[name], declared.fieldNames()
    reason = F.when(F.col(f"_raw.{time}").isNull(), "no time")
    for f in declared.fields:
        reason = reason.when(_unreadable(f.name, stored[f.name].dataType, f.dataType), f"unreadable: {f.name}")
    for c in key or []:
        if c != time:
            reason = reason.when(F.col(c).isNull(), f"no member: {c}")
    for c in COUNTS:
        if c in fields:
            reason = reason.when(F.col(c) < 0, f"negative: {c}")
    for kind in ("users", "tx"):
        for grain in ("daily", "hourly"):
            c = f"{kind}_{grain}"
            if c in fields:
                reason = reason.when(F.col(c) > F.col(f"{kind}_mtd"), f"above month to date: {c}")
    return reason


def check_rows(name: str, rows: DataFrame, key: list[str] | None) -> tuple[DataFrame, DataFrame]:
    """Rows of one fact that keep its contract, and those set aside."""
    stored = rows.schema
    declared = _declared(name, stored)
    fields, time = declared.fieldNames(), FACT_TIMES[name]
    read = rows.select(F.struct(*[F.col(c) for c in fields]).alias("_raw")).select(
        "_raw", *[F.col(f"_raw.{f.name}").try_cast(f.dataType).alias(f.name) for f in declared.fields])
    told = read.withColumn("_reason", _reason(name, stored, declared, key))

    def aside(df: DataFrame, reason: Column, copies: Column, row: Column) -> DataFrame:
        return df.select(F.lit(name).alias("fact"), F.col(time).cast("date").alias("day"), reason.alias("reason"),
                         copies.cast("long").alias("copies"), F.to_json(row, {"ignoreNullFields": "false"}).alias("row"))

    own = aside(told.where("_reason is not null"), F.col("_reason"), F.lit(1), F.col("_raw"))
    good = told.where("_reason is null").select(*fields)
    if key is None:
        return good, own
    whole = F.struct(*fields)
    once = good.groupBy(*fields).agg(F.count(F.lit(1)).alias("_n"))
    clash = (once.groupBy(*[F.col(c).alias(f"_k_{c}") for c in key]).agg(F.count(F.lit(1)).alias("_rows"))
             .where("_rows > 1").withColumn("_clash", F.lit(True)).drop("_rows"))
    marked = once.join(clash, [F.col(c) == F.col(f"_k_{c}") for c in key], "left")
    conflicts = aside(marked.where("_clash"), F.lit("conflicting key"), F.col("_n"), whole)
    kept = marked.where("_clash is null")
    repeats = aside(kept.where("_n > 1"), F.lit("repeated row"), F.col("_n") - 1, whole)
    return kept.select(*fields), own.unionByName(conflicts).unionByName(repeats)


def _stored(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A fact's table as it is stored; one without any file is empty."""
    try:
        return spark.read.parquet(f"{folder.rstrip('/')}/{name}")
    except AnalysisException as error:
        if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return spark.createDataFrame([], FACT_COLUMNS.get(name, FEE_COLUMNS))


def check_facts(spark: SparkSession, folder: str, keys: dict[str, list[str] | None] | None = None,
                quarantine: str | None = None) -> Checked:
    """Facts of a folder against their contract; see the module's text.

    ``keys`` replaces key columns by fact. With ``quarantine`` the rows set aside are written there as Parquet
    in ``fact=...`` folders, in the place of an earlier check's. Facts may lie in ``date=...`` folders.
    """
    keys = {**FACT_KEYS, **(keys or {})}
    unknown = keys.keys() - FACT_KEYS.keys()
    if unknown:
        raise ValueError(f"no such fact: {sorted(unknown)}")
    facts, bad = {}, None
    for name in FACT_TIMES:
        good, aside = check_rows(name, _stored(spark, folder, name), keys[name])
        facts[name] = good
        bad = aside if bad is None else bad.unionByName(aside)
    if quarantine is not None:
        # static: facts without bad rows lose the folder of an earlier check
        (bad.write.mode("overwrite").option("partitionOverwriteMode", "static")
         .partitionBy("fact").parquet(quarantine))
    return Checked(facts, bad)
